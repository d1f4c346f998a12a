"""Matching of names and occupations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.functions.scalar import fuzzy_score, sorted_words
from fathomline.functions.text import norm_name
from fathomline.operators.skew import spread_join
from fathomline.session import cut_lineage

MAX_CHOICES = 10_000
NO_WORD = r"[^\p{L}\p{N}]+"
FIRST_BITS = 1 << 20  # bits that mark the first words of names; a word that hits a mark of another only costs a look-up


def all_names(kyc: DataFrame, emt: DataFrame, wire: DataFrame) -> DataFrame:
    """Every (id, name) pair a party appears under."""

    def parties(df: DataFrame) -> DataFrame:
        """Both ends of each transfer, read once."""
        ends = [F.struct(F.col(f"id_{s}").alias("customer_id"), F.col(f"name_{s}").alias("name")) for s in ("sender", "receiver")]
        return df.select(F.explode(F.array(*ends)).alias("_end")).select("_end.customer_id", "_end.name")

    listed = kyc.select(F.col("cust_id").alias("customer_id"), F.col("Name").alias("name"))
    return listed.union(parties(emt)).union(parties(wire)).distinct()


def fuzzy_match(
    df: DataFrame, choices: Sequence[str], column: str = "Occupation", cutoff: float = 80.0, token_sort: bool = False
) -> DataFrame:
    """Best list entry with a score of at least ``cutoff`` for each value, with score and 0/1 label.

    Each distinct value is scored once against the list, which is a literal array and so
    needs no join; the best of equal scores is the first in the list.
    """
    if len(choices) > MAX_CHOICES:
        raise ValueError(f"more than {MAX_CHOICES} choices: use fuzzy_table_match")
    options = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("choice")) for i, c in enumerate(choices)])

    def scored(option):
        plain = fuzzy_score(F.col("_value"), option["choice"])
        if token_sort:
            plain = F.greatest(plain, fuzzy_score(sorted_words(F.col("_value")), sorted_words(option["choice"])))
        return F.struct(plain.alias("score"), (-option["pos"]).alias("order"), option["choice"].alias("choice"))

    distinct = df.select(F.col(column).alias("_value")).filter(F.col(column).isNotNull()).distinct()
    best = distinct.withColumn("_best", F.array_max(F.transform(options, scored))).filter(F.col("_best.score") >= cutoff)
    found = best.select("_value", F.col("_best.choice").alias("closest_match"), F.col("_best.score").alias("match_score"))
    joined = spread_join(df, found, column, "_value", "left")
    return joined.withColumn("Label_Filtered_By_Occupations", F.col("closest_match").isNotNull().cast("int"))


def _most_edits(length: Column, cutoff: float) -> Column:
    """The most edits between a choice of that length and a text of any length that still reach the cutoff."""
    return F.floor(length * ((100.0 - cutoff) / cutoff) + 1e-9).cast("int")


def _piece(length: Column, edits: Column, i: Column) -> tuple[Column, Column]:
    """Start (from 0) and length of piece ``i`` of ``edits + 1`` nearly equal pieces, the longer ones last."""
    n = edits + 1
    short = F.floor(length / n).cast("int")
    first_long = n - (length % n)
    return i * short + F.greatest(F.lit(0), i - first_long), short + (i >= first_long).cast("int")


def _choice_pieces(choices: DataFrame, cutoff: float) -> DataFrame:
    """(length, piece, part, choice key) of every piece of the choices."""
    sized = choices.withColumns({"length": F.length("_y"), "edits": _most_edits(F.length("_y"), cutoff)})
    each = sized.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("edits"))))
    start, size = _piece(F.col("length"), F.col("edits"), F.col("piece"))
    return each.select("length", "piece", F.col("_y").substr(start + 1, size).alias("part"), "_y")


def _text_pieces(texts: DataFrame, cutoff: float) -> DataFrame:
    """(length, piece, part, text) of every part of a text that can be that piece of a choice of that length.

    Edits before and after a piece add up to the most edits, so with i pieces before it the piece has moved by at most i
    places, counted from the front, or by what is left, counted from the back.
    """
    share = cutoff / 100.0
    lengths = F.sequence(F.ceil(F.length("_x") * share - 1e-9).cast("int"), F.floor(F.length("_x") / share + 1e-9).cast("int"))
    sized = texts.withColumn("length", F.explode(lengths)).withColumn("edits", _most_edits(F.col("length"), cutoff))
    each = sized.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("edits"))))
    start, size = _piece(F.col("length"), F.col("edits"), F.col("piece"))
    each = each.withColumns({"start": start, "size": size, "shift": F.length("_x") - F.col("length")})
    left = F.col("edits") - F.col("piece")
    low = F.greatest(F.lit(0), F.col("start") - F.col("piece"), F.col("start") + F.col("shift") - left)
    high = F.least(F.length("_x") - F.col("size"), F.col("start") + F.col("piece"), F.col("start") + F.col("shift") + left)
    places = each.withColumns({"low": low, "high": high}).filter("low <= high").withColumn("place", F.explode(F.sequence("low", "high")))
    return places.select("length", "piece", F.col("_x").substr(F.col("place") + 1, F.col("size")).alias("part"), "_x").distinct()


def edit_join(texts: DataFrame, choices: DataFrame, cutoff: float = 80.0) -> DataFrame:
    """Pairs (_x, _y, score) of different prepared texts (column ``_x``) and choices (``_y``) with a fuzzy score of at least ``cutoff``.

    A choice is cut into one piece more than the edits the cutoff allows for its length, so at least one piece is found unchanged in
    any text close enough, near its place. Texts and choices meet on (length, piece number, piece) and the edit distance decides; frequent
    pieces are spread. Nothing is compared with everything, and the list of choices has no bound. Null texts pair with nothing.
    """
    if not 50.0 < cutoff <= 100.0:
        raise ValueError("a cutoff above 50 is needed, so that no piece is empty")
    left = _text_pieces(texts.filter("_x is not null").select("_x").distinct(), cutoff)
    right = _choice_pieces(choices.filter("_y is not null").select("_y").distinct(), cutoff)
    keys = ["length", "piece", "part"]
    right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    met = spread_join(left, right, keys, [f"_{k}" for k in keys], "inner", ["_x"]).select("_x", "_y").distinct()
    longest = F.greatest(F.length("_x"), F.length("_y"))
    score = 100.0 * (1.0 - F.coalesce(F.try_divide(F.levenshtein("_x", "_y").cast("double"), longest.cast("double")), F.lit(0.0)))
    return met.withColumn("score", score).filter(F.col("score") >= cutoff)


def fuzzy_table_match(
    df: DataFrame, choices: DataFrame, column: str = "Occupation", choice: str = "choice", cutoff: float = 80.0, token_sort: bool = False
) -> DataFrame:
    """As ``fuzzy_match`` against a table of any size; of equal scores the first choice in the order of the texts."""
    values = df.select(F.col(column).alias("_value")).filter("_value is not null").distinct()
    listed = choices.select(F.col(choice).alias("_choice")).filter("_choice is not null").distinct()

    def pairs(prepared) -> DataFrame:
        x, y = values.withColumn("_x", prepared(F.col("_value"))), listed.withColumn("_y", prepared(F.col("_choice")))
        near = edit_join(x, y, cutoff).withColumnsRenamed({"_x": "_near_x", "_y": "_near_y"})
        joined = near.join(x, F.col("_near_x") == F.col("_x")).join(y, F.col("_near_y") == F.col("_y"))
        return joined.select("_value", "_choice", "score")

    found = pairs(lambda c: F.lower(F.trim(c)))
    if token_sort:
        found = found.unionByName(pairs(sorted_words))
    best = found.groupBy("_value").agg(F.min(F.struct((-F.col("score")).alias("loss"), "_choice")).alias("_best"))
    best = best.select("_value", F.col("_best._choice").alias("closest_match"), (-F.col("_best.loss")).alias("match_score"))
    joined = spread_join(df, best, column, "_value", "left")
    return joined.withColumn("Label_Filtered_By_Occupations", F.col("closest_match").isNotNull().cast("int"))


def words_of(text: Column) -> Column:
    """Words in upper case: runs of letters and digits. A text without one has no words."""
    flat = F.trim(F.regexp_replace(F.upper(text), NO_WORD, " "))
    return F.when(flat != "", F.split(flat, " "))


def _place(word: Column) -> Column:
    return F.xxhash64(word).bitwiseAND(F.lit(FIRST_BITS - 1))


def _marks(words: DataFrame) -> Column:
    """The marks of all words in the only column, as an array of longs of fixed size: a literal, however many words there are."""
    marked = words.select(_place(F.col(words.columns[0])).alias("_at"))
    per = marked.groupBy(F.shiftright("_at", 6).alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, int(_at % 64))")).alias("bits"))
    bits = {r.slot: r.bits for r in per.collect()}
    return F.split(F.lit(",".join(str(bits.get(i, 0)) for i in range(FIRST_BITS >> 6))), ",").cast("array<bigint>")  # folded once, one literal and not thousands


def names_in_texts(texts: DataFrame, names: DataFrame, key: str = "Link", text: str = "Text", name: str = "name") -> DataFrame:
    """Distinct (key, customer_id, name) of every known name that stands in a text as whole words, whatever its case and punctuation.

    Names have few lengths, counted in words. For each length the different runs of that many words of a text meet the names of that
    length by equality. Only runs whose first word is marked as that of a name are formed, and they are written before anything counts
    or joins them, so a text is read and cut into words once. Nothing is searched name by name, and the list of names has no bound; a run in very
    many texts ("hot" names) is spread. A name inside a longer one is found as well. Null and empty names and texts find nothing.
    """
    known = names.select("customer_id", F.col(name).alias("name"), words_of(norm_name(F.col(name))).alias("_w")).filter("_w is not null")
    phrases = cut_lineage(known.select("customer_id", "name", F.array_join("_w", " ").alias("_phrase"), F.size("_w").alias("_n")).distinct())
    lengths = sorted(r[0] for r in phrases.select("_n").distinct().collect())  # of names, in words

    if not lengths:
        return phrases.select(F.lit(None).cast(texts.schema[key].dataType).alias(key), "customer_id", "name").limit(0)
    marks = _marks(phrases.select(F.substring_index("_phrase", " ", 1).alias("_first")))

    def marked(word: Column) -> Column:
        at = _place(word)
        return F.bit_get(F.get(marks, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1

    def runs(at: Column) -> Column:
        """The runs of words from a place (from 0) on."""
        return F.array(*[F.when(at + n <= F.size("_words"), F.array_join(F.slice("_words", at + 1, n), " ")) for n in lengths])

    # An empty word at either end of a text makes runs that begin or end with a space, which no name does.
    worded = texts.select(F.col(key).alias("_key"), F.split(F.upper(F.col(text)), NO_WORD).alias("_words"))
    begun = F.array_compact(F.transform("_words", lambda word, at: F.when(marked(word), runs(at))))
    found = worded.select("_key", F.explode(F.array_distinct(F.array_compact(F.flatten(begun)))).alias("_run"))
    found = cut_lineage(found)
    # Runs that are names, once per text, before each meets all customers of that name: their pairs are the result and move no more.
    told = spread_join(found, phrases.select("_phrase").distinct(), "_run", "_phrase", "left_semi", ["_key"])
    hits = spread_join(cut_lineage(told.distinct()), phrases.drop("_n"), "_run", "_phrase", "inner", ["_key"])
    return hits.select(F.col("_key").alias(key), "customer_id", "name")


def alike(names: DataFrame, name: str = "name") -> DataFrame:
    """(customer_id, name, alike) with names as they are looked for in texts; customers with the same names have the same ``alike``.

    It is made of the number of names and of sums of their hashes, which combine on the map side. What a text says of one customer it says
    of all that are alike, so texts need to meet one of them only.
    """
    known = cut_lineage(names.select("customer_id", F.array_join(words_of(norm_name(F.col(name))), " ").alias("name")).filter("name is not null").distinct())
    sums = [F.sum(F.conv(F.substring(F.sha2("name", 256), at, 15), 16, 10).cast("decimal(20,0)")) for at in (1, 16, 31)]
    sets = known.groupBy(F.col("customer_id").alias("_customer")).agg(F.concat_ws("-", F.count(F.lit(1)), *sums).alias("alike"))
    return spread_join(known, sets, "customer_id", "_customer", "inner", ["name"], null_safe=True)


def named_share(hits: DataFrame, texts: DataFrame, key: str = "Link") -> DataFrame:
    """Customers by the number of texts that name them, and the share of all texts."""
    total = texts.agg(F.count_distinct(key).alias("total")).scalar()
    return hits.groupBy("customer_id").agg(F.count_distinct(key).alias("texts")).withColumn("share", F.col("texts") / total)


def common_names(offenders: DataFrame, names: DataFrame) -> DataFrame:
    """Offender names that are customer names too: upper case, without a title on the customer's side."""
    known = names.select(norm_name(F.col("name")).alias("_known")).distinct()
    upper = offenders.select(F.upper("name").alias("name")).distinct()
    return upper.join(known, F.col("name") == F.col("_known"), "left_semi")


def sanctions(df: DataFrame, listed: DataFrame, column: str = "name") -> DataFrame:
    """Add OS_Results: 1 for a name on the sanctions list, 0 for one that is not, -1 without a name."""
    marks = listed.select(F.upper(F.trim("name")).alias("_listed")).distinct().withColumn("_hit", F.lit(1))
    keyed = df.withColumn("_name", F.upper(F.trim(F.col(column))))
    joined = spread_join(keyed, marks, "_name", "_listed", "left")
    answer = F.when(F.coalesce(F.col("_name"), F.lit("")) == "", -1).otherwise(F.coalesce("_hit", F.lit(0)))
    return joined.withColumn("OS_Results", answer).drop("_name", "_hit")
