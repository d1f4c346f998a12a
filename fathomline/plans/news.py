"""Queries on stored pages and articles."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.functions import text
from fathomline.operators import filters, matching, news
from fathomline.plans.registry import query
from fathomline.session import cut_lineage, scratch_path
from fathomline.sources import tables
from fathomline.sources.fixtures import Bank

# The test prose has capitals at sentence starts only and none of the real trigger words.
PERSON = "[A-Z][a-z]+"
CRIMINAL, SUSPECT = ("was",), ("with",)


def articles(b: Bank) -> DataFrame:
    return b.articles


def named(b: Bank) -> DataFrame:
    return news.mentions(b.articles, person=PERSON)


def answered(b: Bank) -> DataFrame:
    return news.answers(named(b), CRIMINAL, SUSPECT, person=PERSON)


def answer_table(b: Bank) -> DataFrame:
    """Answers are the expensive step, so they are written once, without the texts."""
    return cut_lineage(answered(b).select("Link", "Title", "All_Names", "Q1_Name", "Q2_Name"))


def article_scores(b: Bank) -> DataFrame:
    """Link and Score: the stored vector of an article against that of the first; an article may have none."""
    vectors = b.table("embeddings")
    anchor = vectors.agg(F.min_by("embedding", "vec_id").alias("v")).scalar()
    link = F.concat(F.lit("https://news.example/"), F.col("vec_id").cast("string"))
    return news.similarity(vectors, anchor).select(link.alias("Link"), "Score")


def offender_table(b: Bank) -> DataFrame:
    """One article per offender: the best scored, those without a score last, then by link."""
    scored = news.match_answers(answer_table(b)).join(article_scores(b), "Link", "left")
    return news.offenders(scored, [F.coalesce(-F.col("Score"), F.lit(float("inf"))), F.col("Link")])


NAMES_SQL = f"""list_reduce(list_prepend(cast([] as varchar[]), list_transform(regexp_extract_all(Text, '({PERSON})', 1), lambda x: [x])),
  lambda acc, x: case when len(list_filter(acc, lambda k: contains(k, x[1]) or contains(x[1], k))) > 0 then acc else list_concat(acc, x) end)"""


def _answer_sql(word: str) -> str:
    found = f"regexp_extract(Text, '(?s)(?:^|[^A-Za-z])(?:{word})[^A-Za-z].*?({PERSON})', 1)"
    return f"list_filter(case when contains({found}, 'and ') then string_split({found}, ' and ') else [{found}] end, lambda a: a <> '')"


NEWS_VIEWS = (
    (
        "answered",
        f"select Link, Title, {NAMES_SQL} as All_Names, {_answer_sql('was')} as Q1_Name, {_answer_sql('with')} as Q2_Name from articles",
    ),
    (
        "hits",
        """select Link, Title, question, n, a, substr(All_Names[n], 1, instr(All_Names[n], answers[a]) + length(answers[a]) - 1) as hit
        from (select *, unnest(range(1, len(answers) + 1)) as a from (
          select *, unnest(range(1, len(All_Names) + 1)) as n from (
            select Link, Title, All_Names, 1 as question, Q1_Name as answers from answered
            union all select Link, Title, All_Names, 2, Q2_Name from answered)))
        where contains(All_Names[n], answers[a])""",
    ),
    (
        "matched",
        "select Link, Title, hit as Criminal from hits qualify row_number() over (partition by Link order by question, n, a) = 1",
    ),
    (
        "offenders",
        """select m.Link as Links, m.Title as Titles, m.Criminal from matched m left join (
          select 'https://news.example/' || vec_id as Link, list_inner_product(embedding::double[], (select arg_min(embedding, vec_id)::double[] from embeddings)) as Score
          from embeddings) s on s.Link = m.Link qualify row_number() over (partition by m.Criminal order by s.Score desc nulls last, m.Link, m.Title) = 1""",
    ),
)

LINK_SQL = "select distinct url as link from pages where regexp_matches(url, '[0-9]{3}.{4}$')"


# The references that occur in the pages, the ampersand last so that none is decoded twice.
DECODED = "regexp_replace(x, '(?s)<.*?>', '', 'g')"
for _name, _char in {"lt": "<", "gt": ">", "quot": '"', "copy": "©", "middot": "·", "nbsp": "\u00a0", "amp": "&"}.items():
    DECODED = f"replace({DECODED}, '&{_name};', '{_char}')"


@query("article_link_filter", LINK_SQL)
def _(b: Bank) -> DataFrame:
    return news.article_links(b.table("pages").select(F.col("url").alias("link")))


@query(
    "html_paragraphs",
    rf"""select page_id, array_to_string(list_transform(regexp_extract_all(html, '(?is)<p(?:\s[^>]*)?>(.*?)</p\s*>', 1),
      lambda x: {DECODED}), chr(10)) as Text from pages""",
)
def _(b: Bank) -> DataFrame:
    return news.article_text(b.table("pages")).select("page_id", "Text")


def _h1(extra: str = r"(?:\s[^>]*)?") -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(html, '(?is)<h1{extra}>(.*?)</h1>', 1), lambda x: {DECODED}), chr(10))"
    )


TITLE_RULES = (("prefix", "http://m.", "page-title"), ("prefix", "https://thther.", ""), ("contains", "blog", ""), ("digits", "", ""))


@query(
    "html_title",
    f"""select page_id, case when starts_with(url, 'http://m.') then {_h1('[^>]*class="page-title"[^>]*')}
      when starts_with(url, 'https://thther.') or contains(url, 'blog') or regexp_matches(url, '[0-9]{{3}}.{{4}}$') then {_h1()} end as Title from pages""",
)
def _(b: Bank) -> DataFrame:
    return news.titles(b.table("pages"), TITLE_RULES).select("page_id", "Title")


def records(b: Bank) -> DataFrame:
    """Documents as dict literals with some letters escaped; a quote in the text breaks the record, as in scraped data."""
    literal = F.concat(F.lit("{'Title': '"), F.col("source"), F.lit("', 'Text': '"), F.col("text"), F.lit("'}"))
    flat = F.regexp_replace(literal, "[\\r\\n\\t\\\\]", " ")
    flat = F.replace(F.replace(flat, F.lit("é"), F.lit("\\xe9")), F.lit("ß"), F.lit("\\xdf"))
    return b.table("documents").select("doc_id", flat.alias("Extracted Data"))


FLAT_SQL = r"regexp_replace(text, '[\r\n\t\\]', ' ', 'g')"
QUOTED_SQL = "contains(text, chr(39))"


@query("literal_record_parse", f"select doc_id, source as Title, {FLAT_SQL} as Text from documents where not {QUOTED_SQL}")
def _(b: Bank) -> DataFrame:
    return news.good_records(news.parse_records(records(b))).select("doc_id", "Title", "Text")


@query(
    "literal_record_counts",
    f"select count(*) as total, count(*) filter (where not {QUOTED_SQL}) as successful, count(*) filter (where {QUOTED_SQL}) as failed from documents",
)
def _(b: Bank) -> DataFrame:
    return news.record_counts(news.parse_records(records(b)))


@query(
    "similarity_filter",
    """select e.vec_id, e.label, list_inner_product(e.embedding::double[], a.v) as Score
    from embeddings e, (select arg_min(embedding, vec_id)::double[] as v from embeddings) a where list_inner_product(e.embedding::double[], a.v) >= 0.25""",
    Score=6,
)
def _(b: Bank) -> DataFrame:
    vectors = b.table("embeddings")
    anchor = vectors.agg(F.min_by("embedding", "vec_id").alias("v")).scalar()
    return news.similar_to(vectors, anchor, ties=["vec_id"]).select("vec_id", "label", "Score")


@query("person_mentions", "select Link, array_to_string(All_Names, '|') as names, len(All_Names) as n from answered", NEWS_VIEWS)
def _(b: Bank) -> DataFrame:
    return named(b).select("Link", F.array_join("All_Names", "|").alias("names"), F.size("All_Names").cast("long").alias("n"))


@query(
    "names_fold",
    f"select doc_id, array_to_string({NAMES_SQL.replace('Text', 'text')}, '|') as names from documents".replace(PERSON, "[A-Z][a-z]+ [a-z]+"),
)
def _(b: Bank) -> DataFrame:
    found = text.person_mentions(F.col("text"), "[A-Z][a-z]+ [a-z]+")
    return b.table("documents").select("doc_id", F.array_join(text.fold_names(found), "|").alias("names"))


@query(
    "offender_answers",
    "select Link, array_to_string(Q1_Name, '|') as q1, array_to_string(Q2_Name, '|') as q2 from answered",
    NEWS_VIEWS,
)
def _(b: Bank) -> DataFrame:
    return answered(b).select("Link", F.array_join("Q1_Name", "|").alias("q1"), F.array_join("Q2_Name", "|").alias("q2"))


def longest_words(batch: pd.DataFrame) -> pd.DataFrame:
    """A stand-in for a model: the longest capitalised word answers both questions."""
    words = batch["Text"].str.findall(PERSON)
    best = words.map(lambda ws: max(ws, key=lambda w: (len(w), w)) if len(ws) else "")
    return pd.DataFrame({"q1": best, "q2": best})


@query("offender_answers_scorer")
def _(b: Bank) -> DataFrame:
    said = news.scored_answers(b.articles, longest_words)
    return said.select("Link", F.array_join("Q1_Name", "|").alias("q1"), F.array_join("Q2_Name", "|").alias("q2"))


@query("name_containment_join", "select * from matched", NEWS_VIEWS)
def _(b: Bank) -> DataFrame:
    return news.match_answers(answer_table(b)).select("Link", "Title", "Criminal")


@query("offender_table", "select * from offenders", NEWS_VIEWS)
def _(b: Bank) -> DataFrame:
    return offender_table(b)


@query("offender_lookup", "select * from offenders where Criminal = 'The'", NEWS_VIEWS)
def _(b: Bank) -> DataFrame:
    return filters.offender(offender_table(b), "The")


def known_people(b: Bank) -> DataFrame:
    """Words of the stored page titles play the part of customer names."""
    words = F.explode(F.split(text.headline(F.col("html")), r"[^A-Za-z]+"))
    return b.table("pages").select(words.alias("name")).filter(F.col("name") != "")


KNOWN_SQL = f"select upper(unnest(regexp_split_to_array({_h1()}, '[^A-Za-z]+'))) as name from pages"
FOUND_SQL = f"""select Links, Titles, upper(Criminal) as Criminal from offenders where upper(Criminal) in ({KNOWN_SQL})
  qualify row_number() over (partition by upper(Criminal) order by Links, Titles) = 1"""


@query("offenders_in_kyc", FOUND_SQL, NEWS_VIEWS)
def _(b: Bank) -> DataFrame:
    return news.found_offenders(offender_table(b), known_people(b))


def _norm_sql(column: str) -> str:
    return rf"trim(regexp_replace(upper({column}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


STRIPPED_SQL = r"case when regexp_matches(upper(name), '^(DR\.|MR\.|MRS\.)') then trim(regexp_replace(upper(name), '^(DR\.|MR\.|MRS\.)', '')) else upper(name) end"
NEWS_SQL = """
select 'https://news.example/' || cast(d.doc_id as varchar) as Link,
       case when l.line is not null then coalesce(d.text, '') || chr(10) || 'Police named: ' || l.line || '.' else d.text end as Text
from documents d left join (
  select doc_id, string_agg(name, ', and (' order by name) as line from (
    select distinct w.doc_id, lower(k.Name) as name from (
      select doc_id, unnest([doc_id % n, (doc_id * 31 + 7) % n]) as who from documents, (select count(*) as n from customer) where doc_id % 3 = 0) w
    join kyc k on k.cust_id = 'CUST' || lpad(cast(w.who as varchar), 8, '0')) group by doc_id) l using (doc_id)"""
CUSTOMER_VIEWS = (
    ("customer_news", NEWS_SQL),
    ("hits", f"""select distinct t.Link, n.customer_id, n.name from (select Link, ' ' || {_norm_sql('Text')} || ' ' as words from customer_news) t,
      (select customer_id, name, {_norm_sql(STRIPPED_SQL)} as phrase from all_names) n where n.phrase <> '' and contains(t.words, ' ' || n.phrase || ' ')"""),
)


def customer_hits(b: Bank) -> DataFrame:
    return matching.names_in_texts(b.customer_news, matching.all_names(b.kyc, b.emt, b.wire))


@query("customers_in_news", "select * from hits", CUSTOMER_VIEWS)
def _(b: Bank) -> DataFrame:
    return customer_hits(b)


@query(
    "customer_news_share",
    "select customer_id, count(distinct Link) as texts, count(distinct Link) * 1.0 / (select count(distinct Link) from customer_news) as share from hits group by 1",
    CUSTOMER_VIEWS,
    share=8,
)
def _(b: Bank) -> DataFrame:
    """Texts are counted once for all customers with the same names; pairs of texts and customers are not written out."""
    known = cut_lineage(matching.alike(matching.all_names(b.kyc, b.emt, b.wire)))
    hits = matching.names_in_texts(b.customer_news, known.select(F.col("alike").alias("customer_id"), "name").distinct())
    shares = matching.named_share(hits, b.customer_news).withColumnRenamed("customer_id", "alike")
    return known.select("customer_id", "alike").distinct().join(shares, "alike").select("customer_id", "texts", "share")


@query("manual_check_rate", f"select count(*) as n, avg(case when length(Criminal) > 3 then 1.0 else 0.0 end) as precision from ({FOUND_SQL})", NEWS_VIEWS, precision=6)
def _(b: Bank) -> DataFrame:
    found = news.found_offenders(offender_table(b), known_people(b))
    return news.confirmed_share(found.withColumn("manual_check", (F.length("Criminal") > 3).cast("int")))


@query("article_csv", "select Link, Title from articles")
def _(b: Bank) -> DataFrame:
    path = scratch_path(b.spark, "articles-csv")
    tables.write_csv(b.articles.select("Link", "Title"), path)
    return b.spark.read.schema("Link string, Title string").option("header", True).option("escape", '"').csv(path)


@query("article_text_csv", "select Link, Title, Text from articles")
def _(b: Bank) -> DataFrame:
    """Whole texts in files that can be split, read back."""
    path = scratch_path(b.spark, "texts-csv")
    tables.write_csv(b.articles, path, one_line=True)
    return tables.read_csv(b.spark, path, b.articles.schema, one_line=True)
