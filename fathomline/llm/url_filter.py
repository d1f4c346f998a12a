"""URL filters: rules on host and path first, else a logistic regression on hashed character n-grams.

The model reads the host (A-Z in lower case) and the path as separate bags of 3- to 5-grams, digits taken as one character, hashed into a
fixed number of buckets. It is trained from a small labelled table of URLs; scoring is the fitted model's own
transformation of the rows, so a page is read once, only its URL, and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm.common import col, packed, unpacked

BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
STRENGTH = 1e-4  # of the squared penalty
BLOCK_FROM = 0.6  # above a half: a page wrongly blocked is lost

# Verdict and rule (host, then path from its slash on).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))

# The labelled table: hosts and paths of common kinds of unwanted pages, and of ordinary ones. All are invented.
BLOCKED_URLS = """
https://ads.bannernet.test/serve/1 https://adserver.mediabuy.test/click https://track.clickcount.test/pixel.gif https://ad-tracker.test/en/20
https://ads-delivery.test/de/11 http://popads.test/fr/90 https://tracking.adsight.test/en/3.html https://www.ads-exchange.test/es/7 https://adtrack.test/t/55
http://trackers.test/en/71 https://casino-royal.test/en/88 http://www.best-casino.test/de/41 https://onlinecasino.test/bonus https://casino-bonus.test/fr/12
https://mega-casino.test/es/5.html https://win-big.test/en/19 https://jackpot-win.test/en/404 https://freespins.test/slots/4 https://sport-bets.test/en/8
https://www.livebets.test/de/90 http://free-betting.test/fr/31 https://bets-today.test/es/17 https://poker-stars-win.test/play https://free-slots.test/en/52
https://cheap-meds.test/en/6 http://www.pills-online.test/de/33 https://cheappills.test/buy https://discount-pills.test/fr/2 https://pharma-pills.test/es/13.html
https://cheap-viagra.test/en/77 https://diet-pills.test/de/64 http://buy-cheap-watches.test/en/45 https://cheap-replica.test/shop/8 https://cheap-loans.test/en/23
https://spam-links.test/en/9 http://www.linkfarm.test/de/14 https://link-farm.test/fr/81 https://spamsite.test/es/60 https://seo-spam.test/en/27
https://article-spam-farm.test/en/16 https://content-farm.test/de/6 http://backlinks-farm.test/fr/38 https://spamblog.test/es/42.html https://adult-video.test/en/69
http://www.adult-chat.test/de/18 https://adultcams.test/fr/24 https://free-adult.test/es/36 https://xxx-movies.test/en/30 https://adult-xx.test/de/7
https://hot-sex-x.test/en/62 https://porn-tube.test/fr/21 https://sexcams.test/es/9 https://free-porn.test/de/1 https://malware-host.test/download.exe
https://free-cracks.test/keygen/3 https://warez-download.test/en/4 https://phish-login.test/verify https://get-rich-quick.test/en/15 https://crypto-giveaway.test/win
"""
ALLOWED_URLS = """
https://www.citynews.test/en/2024 https://library.test/de/120 https://blog.gardening.test/en/17 https://m.weather.test/fr/8 https://docs.python-help.test/en/3
https://www.university.test/en/88 https://museum.test/es/45 https://recipes.test/en/230.html https://m.trains.test/de/14 https://blog.travelnotes.test/fr/61
https://history.test/en/1024/ https://www.townhall.test/es/77 https://encyclopedia.test/en/5 https://science.test/de/99.html https://blog.weaving.test/en/6
https://m.football.test/es/210 https://www.cooking.test/fr/33 https://physics.test/en/512 https://the-times.test/en/18 https://theatre.test/de/7
https://thesis.test/en/40/ https://northern.test/fr/29 https://therapy.test/en/13 https://thunder.test/es/22 https://www.thorn.test/de/350
https://blog.tide.test/en/64 https://tender.test/en/9 https://station.test/fr/172 https://m.nation.test/en/801 https://motion.test/de/26
https://rotation.test/es/90.html https://lotion.test/en/47 https://blog.thistle.test/en/53 https://this.test/fr/4 https://m.other.test/en/38
https://another.test/de/205 https://www.weather-report.test/en/12 https://fishing.test/es/66 https://herring.test/en/84 https://www.string.test/fr/19
https://spring.test/en/31.html https://blog.washing.test/de/48 https://painting.test/en/70 https://table.test/es/3 https://stable.test/en/92
https://m.cable.test/fr/55 https://friend.test/en/10 https://brand.test/de/63 https://www.island.test/en/27 https://lantern.test/es/41
https://earth.test/en/605 https://north.test/fr/78 https://mouth.test/en/36 https://health.test/de/111 https://www.growth.test/en/24
https://blog.river.test/en/58 https://winter.test/fr/43 https://m.letters.test/en/150 https://shore.test/es/87 https://store.test/en/34
https://forest.test/de/28 https://m.test/en/1 https://www.latest.test/fr/96 https://interest.test/en/73.html https://wholesale.test/es/11
https://whale.test/en/160 https://blog.wheat.test/de/39 https://harvest.test/en/82 https://chat-about-books.test/fr/59 https://that.test/en/20
https://england.test/en/67 https://thousand.test/de/94 https://mountain.test/es/15 https://hour.test/en/49 https://route.test/fr/37
https://people.test/en/126 https://noble.test/de/85 https://double.test/en/2/ https://www.ready.test/es/50 https://freedom.test/en/16
https://free-software.test/en/44 https://address.test/de/72 https://advice.test/en/57 https://adventure.test/fr/95 https://betterhomes.test/en/21
https://alphabet.test/es/32 https://window.test/en/68 https://wine.test/de/91 https://farming.test/en/46 https://farmers-market.test/fr/25
https://racetrack-history.test/en/79 https://adults-learning.test/de/56 https://pillow.test/en/30 https://spamalot-musical.test/es/83 https://linking.test/en/65
https://x-ray.test/en/86 https://example.test/de/74 https://www.example.test/fr/51 https://blog.example.test/en/190 https://m.example.test/es/62
"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; null or without ``://``: empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; null or without ``://``: empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(rule: str, host: Column, path: Column) -> Column:
    """Whether a rule's host is the host or ends it after a dot, and its path begins the path."""
    of_host, slash, of_path = rule.partition("/")
    return ((host == of_host) | host.endswith(f".{of_host}")) & path.startswith(slash + of_path)


def matched(rules, host: Column, path: Column) -> Column:
    """(verdict, rule) of the longest fitting rule, else null. Of rules of one length that with the longer host counts; of one rule with both verdicts, block."""
    ranked = sorted(rules, key=lambda r: (-len(r[1]), -len(r[1].partition("/")[0]), r[0] != "block"))
    return F.coalesce(*[F.when(fits(rule, host, path), F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))) for verdict, rule in ranked], F.lit(None).cast("struct<verdict: string, rule: string>"))


def grams(mark: str, text: Column) -> Column:
    """The n-grams of a text between two end marks, digits as 0."""
    whole = F.concat(F.lit("^"), F.translate(text, "123456789", "000000000"), F.lit("$"))

    # A lookahead takes no characters, so each place gives its n-gram, in time linear in the length.
    return F.concat(*[F.transform(F.regexp_extract_all(whole, F.lit(f"(?s)(?=(.{{{n}}}))"), 1), lambda g: F.concat(F.lit(mark), g)) for n in GRAMS])


def features(urls: DataFrame, url: Column) -> DataFrame:
    return urls.withColumn("grams", F.concat(grams("h", host_of(url)), grams("p", F.translate(path_of(url), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))))


def labelled(spark: SparkSession) -> DataFrame:
    """The built-in table (url, label), 1 = blocked."""
    rows = [(u, 1.0) for u in BLOCKED_URLS.split()] + [(u, 0.0) for u in ALLOWED_URLS.split()]
    return spark.createDataFrame(rows, "url string, label double").coalesce(1)


def fit(table: DataFrame, url: str = "url", label: str = "label") -> PipelineModel:
    """The model of a small labelled table (1 = blocked, 0 = allowed); rows without a URL or label teach nothing.

    It is fitted over one partition in the order of the rows, so the weights are the same each time.
    """
    rows = table.filter(col(url).isNotNull() & col(label).isNotNull()).select(col(url).alias("url"), col(label).cast("double").alias("label"))
    steps = [
        HashingTF(numFeatures=BUCKETS, binary=True, inputCol="grams", outputCol="counts"),
        Normalizer(inputCol="counts", outputCol="features"),
        LogisticRegression(regParam=STRENGTH, maxIter=100, standardization=False),
    ]
    return Pipeline(stages=steps).fit(features(rows.coalesce(1), F.col("url")))


def judge(pages: DataFrame, model: PipelineModel, rules=RULES, url: str = "url", block_from: float = BLOCK_FROM) -> DataFrame:
    """Add ``host, path, rule, verdict`` (allow or block) and ``score``, the model's probability of block, to every row.

    The longest fitting rule decides, else the model: ``block`` from ``block_from`` on. A null or empty URL, or one without ``://``, has an empty host and
    path, fits no rule and holds nothing to judge: it is allowed. Long URLs are read whole; repeated rows get the
    same answer; an empty table gives an empty one; added columns take the place of input columns of their names.
    """
    row_url = F.col(f"row.`{url}`")
    scored = model.transform(features(packed(pages), row_url)).withColumn("score", vector_to_array("probability")[1])
    scored = scored.withColumns({"host": host_of(row_url), "path": path_of(row_url)}).withColumn("found", matched(rules, F.col("host"), F.col("path")))
    own = F.when((F.col("score") >= block_from) & (F.col("host") != ""), F.lit("block")).otherwise(F.lit("allow"))
    added = {"host": F.col("host"), "path": F.col("path"), "rule": F.col("found.rule"), "verdict": F.coalesce("found.verdict", own), "score": F.col("score")}
    return unpacked(scored, pages.columns, added)


def op13_url_filter(pages: DataFrame) -> DataFrame:
    """The verdict on every page's URL, with the built-in rules and labelled table. Edge cases as in ``judge``."""
    judged = judge(pages.select("page_id", "url"), fit(labelled(pages.sparkSession)))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")
