"""Queries on the bank tables: sources, filters, joins, aggregates, profiles and statistics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.functions import scalar, text
from fathomline.operators import clusters, encode, evaluate, explore, features, filters, flow, graph, joins, matching, quality, risk, stats
from fathomline.plans.oracle_views import BASIC, n
from fathomline.plans.registry import query
from fathomline.session import cut_lineage, scratch_path
from fathomline.sources import lookups, schemas, tables
from fathomline.sources.fixtures import FUZZY_CHOICES, OCCUPATIONS, WORDS, Bank

MONEY = {
    "wire_total_amnt_sent": 2,
    "wire_total_amnt_received": 2,
    "emt_total_amnt_sent": 2,
    "emt_total_amnt_received": 2,
    "total_cash_deposit": 2,
    "total_cash_withdraw": 2,
}
BALANCES = {"wire_trxn_balance": 2, "emt_trxn_balance": 2, "cash_balance": 2}


def feature_view(b: Bank, totals: bool = True) -> DataFrame:
    return features.kyc_features(b.kyc, b.wire, b.emt, b.cash, totals)


def network_of(b: Bank) -> DataFrame:
    return flow.transaction_network(b.wire, b.emt)


def sql_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# ---- sources and sinks -------------------------------------------------------------------


def _raw(df: DataFrame, name: str) -> DataFrame:
    return df.withColumnsRenamed({v: k for k, v in schemas.RAW_HEADERS[name].items()})


@query("csv_scan", "select * from wire")
def _(b: Bank) -> DataFrame:
    path = scratch_path(b.spark, "wire-csv")
    tables.write_csv(_raw(b.wire, "wire_trxns"), path, one_line=True)
    return tables.read_table(b.spark, "wire_trxns", path, one_line=True)


@query("rename_to_schema", "select * from emt")
def _(b: Bank) -> DataFrame:
    return tables.conform(_raw(b.emt, "emt_trxns"), "emt_trxns")


@query("table_append", "select * from cash")
def _(b: Bank) -> DataFrame:
    name = f"cash_{uuid.uuid4().hex}"
    path = scratch_path(b.spark, name)
    tables.append(b.cash.filter(F.col("type") == "deposit"), name, path)
    tables.append(b.cash.filter(F.col("type") == "withdrawal"), name, path)
    return b.spark.table(name)


@query("table_replace", "select * from cash where type = 'deposit'")
def _(b: Bank) -> DataFrame:
    name = f"cash_{uuid.uuid4().hex}"
    path = scratch_path(b.spark, name)
    tables.replace(b.cash, name, path)
    tables.replace(b.cash.filter(F.col("type") == "deposit"), name, path)
    return b.spark.table(name)


@query(
    "register_views",
    """select f.cust_id, f.total_no_wire_trxns, count(n.name) as names
    from features f left join all_names n on n.customer_id = f.cust_id group by all""",
)
def _(b: Bank) -> DataFrame:
    tables.register(
        {
            "kyc_features": feature_view(b),
            "transaction_network": network_of(b),
            "all_names": matching.all_names(b.kyc, b.emt, b.wire),
        }
    )
    return b.spark.sql(
        """select f.cust_id, f.total_no_wire_trxns, count(n.name) as names
        from kyc_features f left join all_names n on n.customer_id = f.cust_id
        group by f.cust_id, f.total_no_wire_trxns"""
    )


@query(
    "csv_sink",
    """select emt_trxn_id, array_to_string(list_filter(regexp_split_to_array(lower(emt_message), '\\s+'), lambda x: x <> ''), ', ') as words
    from emt where emt_message is not null""",
)
def _(b: Bank) -> DataFrame:
    path = scratch_path(b.spark, "words-csv")
    words = b.emt.filter(F.col("emt_message").isNotNull()).select("emt_trxn_id", text.tokens_plain(F.col("emt_message")).alias("words"))
    tables.write_csv(words, path)
    return b.spark.read.schema("emt_trxn_id string, words string").option("header", True).csv(path)


@query(
    "lookup_tables",
    "select category, count(*) as customers from (" + " union all ".join(
        f"select '{c}' as category, cust_id from kyc where Occupation in {sql_list(v)}" for c, v in OCCUPATIONS.items()
    ) + ") group by 1",
)
def _(b: Bank) -> DataFrame:
    sheet = lookups.lookup(b.spark, "occupation", OCCUPATIONS)
    per_job = b.kyc.groupBy("Occupation").agg(F.count(F.lit(1)).alias("n"))
    joined = sheet.join(per_job, sheet["value"] == per_job["Occupation"])
    return joined.groupBy("category").agg(F.sum("n").alias("customers"))


@query(
    "pk_violations",
    "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1",
)
def _(b: Bank) -> DataFrame:
    return quality.pk_violations(b.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("fk_orphans", "select id_receiver as id, count(*) as n from wire where id_receiver not in (select cust_id from kyc) group by 1")
def _(b: Bank) -> DataFrame:
    return quality.fk_orphans(b.wire, "id_receiver", b.kyc, "cust_id")


_BANK_SQL = {"kyc": "kyc", "kyc_with_open_sanctions": "kyc", "cash_trxns": "cash", "emt_trxns": "emt", "wire_trxns": "wire"}
DECLARED = [quality.Key(t, (c,)) for t, c in schemas.KEYS.items()]
DECLARED += [quality.Key(t, (c,), ("kyc", ("cust_id",))) for t, cs in schemas.FOREIGN_KEYS.items() for c in cs]


def _key_sql(k: quality.Key) -> str:
    (column,) = k.columns
    bad = f"{column} not in (select cust_id from kyc)" if k.refers_to else "true"
    having = "" if k.refers_to else f"having {column} is null or count(*) > 1"
    return f"""select '{k}' as key, '{'foreign' if k.refers_to else 'primary'}' as kind, count(*) as bad_values, coalesce(sum(n), 0)::bigint as bad_rows
      from (select {column}, count(*) as n from {_BANK_SQL[k.table]} where {bad} group by 1 {having})"""


@query("declared_keys", " union all ".join(_key_sql(k) for k in DECLARED))
def _(b: Bank) -> DataFrame:
    tables_ = {"kyc": b.kyc, "kyc_with_open_sanctions": b.kyc_with_open_sanctions, "cash_trxns": b.cash, "emt_trxns": b.emt, "wire_trxns": b.wire}
    return quality.check_keys(tables_, DECLARED)


# ---- projection and filters --------------------------------------------------------------


@query("customer_lookup", "select * from kyc where cust_id = 'CUST00000042'")
def _(b: Bank) -> DataFrame:
    return filters.lookup(b.kyc_with_open_sanctions, "CUST00000042")


@query("derived_totals", "select cust_id, " + ", ".join(features.TOTALS) + " from features", **BALANCES)
def _(b: Bank) -> DataFrame:
    return feature_view(b).select("cust_id", *features.TOTALS)


@query(
    "null_to_zero",
    """select k.cust_id, coalesce(k.Age, 0) as Age, coalesce(w.n, 0) as no_wire_trxns_sent, coalesce(w.v, 0.0) as wire_total_amnt_sent
    from kyc k left join (select id_sender, count(*) as n, sum(wire_value) as v from wire group by 1) w on w.id_sender = k.cust_id""",
    wire_total_amnt_sent=2,
)
def _(b: Bank) -> DataFrame:
    sent = features.wire_sent(b.wire).drop("no_international_wire_trxns_sent")
    joined = b.kyc.select("cust_id", "Age").join(sent, "cust_id", "left")
    return features.zero_fill(joined, ["Age", "no_wire_trxns_sent", "wire_total_amnt_sent"])


@query("drop_null_messages", "select * from emt where emt_message is not null")
def _(b: Bank) -> DataFrame:
    return filters.with_message(b.emt)


@query("isin_filter", "select * from network where id_receiver in (select id from seeds)")
def _(b: Bank) -> DataFrame:
    return filters.keep_ids(network_of(b), b.seeds, "id_receiver")


@query("not_in_filter", "select * from network where id_sender not in (select id from seeds)")
def _(b: Bank) -> DataFrame:
    return filters.minus_ids(network_of(b), b.seeds, "id_sender")


@query("membership_flag", "select cust_id, case when cust_id in (select id from seeds) then 1 else 0 end as is_seed from kyc")
def _(b: Bank) -> DataFrame:
    return filters.flag_in(b.kyc.select("cust_id"), "cust_id", b.seeds, "is_seed")


@query(
    "threshold_flag",
    """select k.cust_id, case when coalesce(w.weight, 0) > 0.2 then 1 else 0 end as Label_Filtered_network
    from kyc k left join weights w on w.id = k.cust_id""",
)
def _(b: Bank) -> DataFrame:
    scored = joins.network_score(b.kyc, flow.weights_to(network_of(b), b.seeds))
    return scored.select("cust_id", scalar.threshold_flag(F.col("network_score"), 0.2).alias("Label_Filtered_network"))


@query(
    "prefix_predicate",
    """select 'party' as kind, id_receiver like 'E%' as hit, count(*) as n from wire group by 2
    union all select 'link', regexp_matches(url, '[0-9]{3}.{4}$')
      or starts_with(url, 'https://www.cbc.ca/news/'), count(*) from pages group by 2""",
)
def _(b: Bank) -> DataFrame:
    def counted(df: DataFrame, kind: str, hit) -> DataFrame:
        return df.groupBy(hit.alias("hit")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "hit", "n")

    parties = counted(b.wire, "party", scalar.is_external(F.col("id_receiver")))
    return parties.unionByName(counted(b.table("pages"), "link", scalar.is_article(F.col("url"))))


def _flagged(b: Bank) -> DataFrame:
    """Every name of every party with its risk and sanctions flags."""
    named = matching.all_names(b.kyc, b.emt, b.wire).withColumn("community", F.lit("all"))
    return matching.sanctions(graph.flag_members(named, b.risk_ids), b.sanctioned_names)


FLAGGED_SQL = """select customer_id, name, case when customer_id in (select id from risk_ids) then 1 else 0 end as Risk,
  case when coalesce(trim(name), '') = '' then -1
    when upper(trim(name)) in (select upper(trim(Name)) from kyc where OpenSanc_query = 1) then 1 else 0 end as OS_Results
  from all_names"""


@query("row_or_flag", f"select * from ({FLAGGED_SQL}) where Risk = 1 or OS_Results = 1")
def _(b: Bank) -> DataFrame:
    return filters.either(_flagged(b)).drop("community")


@query("drop_columns", "select * exclude (Name, cust_id) from features", **MONEY, **BALANCES)
def _(b: Bank) -> DataFrame:
    return filters.features_only(feature_view(b))


@query(
    "risk_tier",
    """select c_custkey, round(round(p, 3) * 100, 2) as risk_percent,
      case when round(round(p, 3) * 100, 2) < 30 then 1 when round(round(p, 3) * 100, 2) < 70 then 2 else 3 end as risk_tier
    from (select c_custkey, (c_acctbal - lo) / (hi - lo) as p
      from customer, (select min(c_acctbal) as lo, max(c_acctbal) as hi from customer))""",
)
def _(b: Bank) -> DataFrame:
    scaled = encode.minmax(b.table("customer").select("c_custkey", "c_acctbal"), "c_acctbal", "p")
    return filters.with_tier(scaled, F.col("p")).select("c_custkey", "risk_percent", "risk_tier")


def _capitals(c: str) -> str:
    word = "upper(x[1]) || lower(x[2:])"
    return rf"array_to_string(list_transform(regexp_extract_all({c}, '\p{{L}}+|[^\p{{L}}]+'), lambda x: {word}), '') as {c}"


@query(
    "display_labels",
    f"""select cust_id, {_capitals('Name')}, {_capitals('Gender')}, {_capitals('Occupation')}, Age, Tenure,
      case label when 1 then 'Yes' else 'No' end as label, case OpenSanc_query when 1 then 'Yes' else 'No' end as OpenSanc_query
    from kyc""",
)
def _(b: Bank) -> DataFrame:
    return filters.present(b.kyc_with_open_sanctions)


def _occupation_columns(pattern: str) -> str:
    segments = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    return ", ".join(
        f"case when Occupation = '{s} {i}' then 1 else 0 end as {pattern.format(s, i)}" for s in segments for i in range(10)
    )


GENDER_COLUMNS = ", ".join(f"case when Gender = '{g}' then 1 else 0 end as Gender_{g}" for g in ("female", "male", "other"))


@query("sanitize_columns", f"select cust_id, {_occupation_columns('Occupation_{}{}')} from kyc")
def _(b: Bank) -> DataFrame:
    return scalar.sanitize_columns(encode.one_hot(b.kyc.select("cust_id", "Occupation"), ["Occupation"]))


# ---- joins -------------------------------------------------------------------------------


@query(
    "kyc_features",
    "select Name, Gender, Occupation, Age, Tenure, cust_id, " + ", ".join((*features.BASIC, *features.TOTALS)) + ", label from features",
    **MONEY,
    **BALANCES,
)
def _(b: Bank) -> DataFrame:
    return feature_view(b)


@query(
    "kyc_features_v1",
    "select Name, Gender, Occupation, Age, Tenure, cust_id, " + ", ".join(features.BASIC) + ", label from features",
    **MONEY,
)
def _(b: Bank) -> DataFrame:
    return feature_view(b, totals=False)


@query(
    "sender_receiver_enrich",
    """select w.*, s.Occupation as sender_occupation, r.Occupation as receiver_occupation
    from wire w left join kyc s on s.cust_id = w.id_sender left join kyc r on r.cust_id = w.id_receiver""",
)
def _(b: Bank) -> DataFrame:
    return features.sender_receiver_enrich(b.wire, b.kyc)


@query(
    "counterparty_join",
    """select k.cust_id, e.* from kyc k left join emt e on e.id_receiver = k.cust_id""",
)
def _(b: Bank) -> DataFrame:
    return features.counterparties(b.kyc, b.emt, "received")


SUSPECT_SQL = """select k.cust_id, k.Name, k.label as Label_Money_Laundry, case when s.id is null then 0 else 1 end as Label_Filtered_By_Wire_EMT,
  case when s.Type = 'buyer' then 1 else 0 end as type_buyer, case when s.Type = 'seller' then 1 else 0 end as type_seller
  from kyc k left join suspects s on s.id = k.cust_id"""


@query("suspect_merge", SUSPECT_SQL)
def _(b: Bank) -> DataFrame:
    return joins.merge_suspects(b.kyc, b.suspects)


@query("indicator_join", f"select *, case when cust_id in (select id from risk_ids) then 1 else 0 end as label_by_clustering from ({SUSPECT_SQL})")
def _(b: Bank) -> DataFrame:
    merged = joins.merge_suspects(b.kyc, b.suspects)
    return joins.mark_in(merged, b.risk_ids.withColumnRenamed("id", "cust_id"), "cust_id", "label_by_clustering")


@query(
    "composite_key_join",
    """select e.*, w.counts as counts_other, w.total_transaction_amount as total_transaction_amount_other
    from edges e left join (select id_sender, id_receiver, count(*) as counts, sum(wire_value) as total_transaction_amount from wire group by 1, 2) w
    on w.id_sender = e.Source and w.id_receiver = e.Target""",
    total_transaction_amount=2,
    total_transaction_amount_other=2,
)
def _(b: Bank) -> DataFrame:
    wires = network_of(b).filter(F.col("transfer_type") == 1)
    return joins.join_edges(flow.edges(network_of(b)), flow.edges(wires))


@query(
    "source_names_join",
    "select s.id as Source, e.* exclude (Source) from seeds s left join edges e on e.Source = s.id",
    total_transaction_amount=2,
)
def _(b: Bank) -> DataFrame:
    return joins.join_names(b.seeds.withColumnRenamed("id", "Source"), flow.edges(network_of(b)))


@query(
    "feature_master_join",
    """select f.*, s.Label_Money_Laundry, s.Label_Filtered_By_Wire_EMT, s.type_buyer, s.type_seller
    from features f left join (""" + SUSPECT_SQL + ") s on s.cust_id = f.cust_id",
    **MONEY,
    **BALANCES,
)
def _(b: Bank) -> DataFrame:
    return joins.master(feature_view(b), joins.merge_suspects(b.kyc, b.suspects))


@query(
    "suffix_join",
    """select r.id as customer_id, k.cust_id as cust_id_x, k.Age as Age_x, k.Tenure as Tenure_x, k.Occupation,
      f.cust_id as cust_id_y, f.Age as Age_y, f.Tenure as Tenure_y, f.total_no_wire_trxns
    from risk_ids r left join kyc k on k.cust_id = r.id left join features f on f.cust_id = r.id""",
)
def _(b: Bank) -> DataFrame:
    members = b.risk_ids.withColumnRenamed("id", "customer_id")
    people = joins.join_suffixed(members, b.kyc.select("cust_id", "Age", "Tenure", "Occupation"), "customer_id", "cust_id")
    view = feature_view(b).select("cust_id", "Age", "Tenure", "total_no_wire_trxns")
    return joins.join_suffixed(people, view, "customer_id", "cust_id")


@query(
    "network_score_lookup",
    "select k.cust_id, coalesce(w.weight, 0.0) as network_score from kyc k left join weights w on w.id = k.cust_id",
    network_score=6,
)
def _(b: Bank) -> DataFrame:
    return joins.network_score(b.kyc.select("cust_id"), flow.weights_to(network_of(b), b.seeds))


@query(
    "common_names",
    """select distinct upper(name_receiver) as name from wire where id_receiver like 'E%' and upper(name_receiver) in
    (select case when regexp_matches(upper(Name), '^(DR\\.|MR\\.|MRS\\.)') then trim(regexp_replace(upper(Name), '^(DR\\.|MR\\.|MRS\\.)', '')) else upper(Name) end from kyc)""",
)
def _(b: Bank) -> DataFrame:
    outside = b.wire.filter(scalar.is_external(F.col("id_receiver"))).select(F.col("name_receiver").alias("name"))
    return matching.common_names(outside, b.kyc.select(F.col("Name").alias("name")))


FUZZY_SQL = """
select cust_id, Occupation, choice as closest_match, score as match_score, case when choice is null then 0 else 1 end as Label_Filtered_By_Occupations
from (select k.cust_id, k.Occupation, c.choice, c.score, row_number() over (partition by k.cust_id order by c.score desc nulls last, c.pos) as rn
  from kyc k left join (
    select occ, pos, choice, 100.0 * (1.0 - levenshtein(lower(trim(occ)), lower(trim(choice))) * 1.0 / greatest(length(trim(occ)), length(trim(choice)))) as score
    from (select distinct Occupation as occ from kyc), (values """ + ", ".join(f"({i}, '{c}')" for i, c in enumerate(FUZZY_CHOICES)) + """) v(pos, choice)
  ) c on c.occ = k.Occupation and c.score >= 80) where rn = 1"""


@query("fuzzy_occupation_match", FUZZY_SQL, match_score=4)
def _(b: Bank) -> DataFrame:
    return matching.fuzzy_match(b.kyc.select("cust_id", "Occupation"), FUZZY_CHOICES)


TABLE_MATCH_SQL = """
select cust_id, Occupation, choice as closest_match, score as match_score, case when choice is null then 0 else 1 end as Label_Filtered_By_Occupations
from (select k.cust_id, k.Occupation, c.choice, c.score, row_number() over (partition by k.cust_id order by c.score desc nulls last, c.choice) as rn
  from kyc k left join (
    select occ, choice, 100.0 * (1.0 - levenshtein(lower(trim(occ)), lower(trim(choice))) * 1.0 / greatest(length(trim(occ)), length(trim(choice)))) as score
    from (select distinct Occupation as occ from kyc), (select distinct p_name || ' ' || c_mktsegment || ' ' || c_custkey % 40 as choice
      from part, customer where p_partkey = c_custkey union select distinct c_mktsegment || c_custkey % 40 from customer)
  ) c on c.occ = k.Occupation and c.score >= 80) where rn = 1"""


@query("fuzzy_occupation_table", TABLE_MATCH_SQL, match_score=4)
def _(b: Bank) -> DataFrame:
    customers, parts = b.table("customer"), b.table("part")
    number = (F.col("c_custkey") % 40).cast("string")
    long = parts.join(customers, F.col("p_partkey") == F.col("c_custkey")).select(F.concat_ws(" ", "p_name", "c_mktsegment", number).alias("choice"))
    choices = long.union(customers.select(F.concat("c_mktsegment", number).alias("choice")))
    return matching.fuzzy_table_match(b.kyc.select("cust_id", "Occupation"), choices)


@query("sanctions_lookup", FLAGGED_SQL)
def _(b: Bank) -> DataFrame:
    return _flagged(b).drop("community")


# ---- aggregates --------------------------------------------------------------------------


def _side_sql(table: str, side: str, word: str) -> str:
    abroad = (
        f", cast(sum(case when country_receiver <> country_sender then 1 else 0 end) as bigint) as no_international_wire_trxns_{word}"
        if table == "wire"
        else ""
    )
    return f"""select id_{side} as cust_id, count({table}_trxn_id) as no_{table}_trxns_{word},
      sum({table}_value) as {table}_total_amnt_{word}{abroad} from {table} group by 1"""


@query("wire_sent_agg", _side_sql("wire", "sender", "sent"), wire_total_amnt_sent=2)
def _(b: Bank) -> DataFrame:
    return features.wire_sent(b.wire)


@query("wire_received_agg", _side_sql("wire", "receiver", "received"), wire_total_amnt_received=2)
def _(b: Bank) -> DataFrame:
    return features.wire_received(b.wire)


@query("emt_sent_agg", _side_sql("emt", "sender", "sent"), emt_total_amnt_sent=2)
def _(b: Bank) -> DataFrame:
    return features.emt_sent(b.emt)


@query("emt_received_agg", _side_sql("emt", "receiver", "received"), emt_total_amnt_received=2)
def _(b: Bank) -> DataFrame:
    return features.emt_received(b.emt)


@query(
    "cash_deposit_agg",
    "select cust_id, count(cash_trxn_id) as no_cash_deposits, sum(amount) as total_cash_deposit from cash where type = 'deposit' group by 1",
    total_cash_deposit=2,
)
def _(b: Bank) -> DataFrame:
    return features.cash_deposits(b.cash)


@query(
    "cash_withdraw_agg",
    "select cust_id, count(cash_trxn_id) as no_cash_withdraws, sum(amount) as total_cash_withdraw from cash where type = 'withdrawal' group by 1",
    total_cash_withdraw=2,
)
def _(b: Bank) -> DataFrame:
    return features.cash_withdrawals(b.cash)


def _country_sql() -> str:
    known = sql_list(lookups.COUNTRIES)
    columns = []
    for c in (*lookups.COUNTRIES, "NAN"):
        test = f"l.own_country = '{c}'" if c != "NAN" else f"(l.own_country is null or l.own_country not in {known})"
        for word, direction in (("send", "sent"), ("receive", "received")):
            columns.append(f"{n('wire', direction, ' and ' + test)} as {word}_{c}")
    return f"select k.cust_id, {', '.join(columns)} from kyc k left join legs l on l.cust_id = k.cust_id group by 1"


@query("country_counters", _country_sql())
def _(b: Bank) -> DataFrame:
    return features.country_counters(b.kyc, b.wire)


LISTS_SQL = """
select cust_id, channel, direction, field, value, count(*) as occurrences from (
  select l.cust_id, l.ch as channel, l.dir as direction, unnest(['id', 'occupation', 'country', 'message']) as field,
    unnest([l.other_id, o.Occupation, l.other_country, l.msg]) as value
  from legs l join kyc k on k.cust_id = l.cust_id left join kyc o on o.cust_id = l.other_id where l.ch <> 'cash') where value is not null
group by all"""


@query("counterparty_lists", LISTS_SQL)
def _(b: Bank) -> DataFrame:
    return features.counterparty_lists(b.kyc, b.wire, b.emt)


@query(
    "counterparty_arrays",
    f"""select cust_id, channel, direction, field, 0 as part, array_to_string(list_sort(flatten(list(list_resize([value], occurrences, value)))), '|') as members
    from ({LISTS_SQL}) group by cust_id, channel, direction, field""",
)
def _(b: Bank) -> DataFrame:
    packed = features.packed_lists(features.counterparty_lists(b.kyc, b.wire, b.emt))
    return packed.withColumn("members", F.array_join("values", "|")).drop("values")


def _category_columns() -> str:
    return ", ".join(
        f"{n(ch, d, f' and o.Occupation in {sql_list(OCCUPATIONS[c])}')} as no_{ch}_{c}_occupation_{d}"
        for ch in ("wire", "emt")
        for c in lookups.OCCUPATION_CATEGORIES
        for d in ("sent", "received")
    )


PER_CUSTOMER = "from kyc k left join legs l on l.cust_id = k.cust_id left join kyc o on o.cust_id = l.other_id group by k.cust_id"


@query("category_counts", f"select k.cust_id, {_category_columns()} {PER_CUSTOMER}")
def _(b: Bank) -> DataFrame:
    return features.category_counts(b.kyc, b.wire, b.emt, OCCUPATIONS)


JURISDICTION_COLUMNS = ", ".join(
    f"{n('wire', d, f' and l.other_country in {codes}')} as no_wire_{d}_{name}"
    for name, codes in (("wildlife_jurisdiction", "('CN', 'AU', 'SA')"), ("north_america", "('CA')"))
    for d in ("sent", "received")
)
EXTERNAL_COLUMNS = ", ".join(
    n(ch, d, " and l.other_id like 'E%'") + f" as no_external_{ch}_trxn_{d}" for ch in ("wire", "emt") for d in ("received", "sent")
)


@query("jurisdiction_counts", f"select k.cust_id, {JURISDICTION_COLUMNS} {PER_CUSTOMER}")
def _(b: Bank) -> DataFrame:
    return features.jurisdiction_counts(b.kyc, b.wire)


@query("external_counts", f"select k.cust_id, {EXTERNAL_COLUMNS} {PER_CUSTOMER}")
def _(b: Bank) -> DataFrame:
    return features.external_counts(b.kyc, b.wire, b.emt)


AVERAGE_COLUMNS = ", ".join(
    f"case when no_{ch}_trxns_{d} = 0 then 0.0 else {ch}_total_amnt_{d} / no_{ch}_trxns_{d} end as average_{ch}_{d}"
    for ch in ("wire", "emt")
    for d in ("sent", "received")
)
AVERAGE_DIGITS = {a: 4 for a in features.AVERAGES}


@query("average_amounts", f"select cust_id, {AVERAGE_COLUMNS} from features", **AVERAGE_DIGITS)
def _(b: Bank) -> DataFrame:
    return features.averages(feature_view(b)).select("cust_id", *features.AVERAGES)


def _message_columns() -> str:
    def words(c: str) -> str:
        return f"len(list_filter(regexp_split_to_array(lower(l.msg), '\\s+'), lambda x: x in {sql_list(WORDS[c])}))"

    return ", ".join(
        f"cast(coalesce(sum({words(c)}) filter (where l.dir = '{d}' and l.msg is not null), 0) as bigint) as no_emt_{c}_msg_{d}"
        for c in lookups.WORD_CATEGORIES
        for d in ("sent", "received")
    )


@query("message_word_counts", f"select k.cust_id, {_message_columns()} {PER_CUSTOMER}")
def _(b: Bank) -> DataFrame:
    return features.message_counts(b.kyc, b.emt, WORDS)


OWN_FLAGS = ", ".join(
    f"case when k.Occupation in {sql_list(OCCUPATIONS[c])} then 1 else 0 end as {c}_occupation" for c in lookups.OCCUPATION_CATEGORIES
)


@query("occupation_flags", f"select k.cust_id, {OWN_FLAGS} from kyc k")
def _(b: Bank) -> DataFrame:
    flags = features.own_occupation_flags(b.kyc, OCCUPATIONS)
    return flags.select("cust_id", *[f"{c}_occupation" for c in lookups.OCCUPATION_CATEGORIES])


@query(
    "customer_profile",
    f"""select p.*, f.* exclude (Name, Occupation, Gender, Age, Tenure, cust_id, label), {AVERAGE_COLUMNS} from (
      select k.cust_id, k.Gender, coalesce(k.Age, 0) as Age, k.Tenure, k.label, k.OpenSanc_query, {OWN_FLAGS}, {EXTERNAL_COLUMNS}, {_category_columns()},
        {JURISDICTION_COLUMNS}, {_message_columns()}
      from kyc k left join legs l on l.cust_id = k.cust_id left join kyc o on o.cust_id = l.other_id
      group by k.cust_id, k.Gender, k.Age, k.Tenure, k.label, k.OpenSanc_query, k.Occupation) p join features f on f.cust_id = p.cust_id""",
    **MONEY,
    **BALANCES,
    **AVERAGE_DIGITS,
)
def _(b: Bank) -> DataFrame:
    return features.customer_profile(b.kyc_with_open_sanctions, b.wire, b.emt, b.cash, OCCUPATIONS, WORDS)


# ---- profiles ----------------------------------------------------------------------------


@query("value_counts", "select Occupation as value, count(*) as n, 100.0 * count(*) / (select count(*) from kyc) as percent from kyc group by 1", percent=6)
def _(b: Bank) -> DataFrame:
    return explore.value_counts(b.kyc, "Occupation")


PROFILE_COLUMNS = ("cust_id", "Name", "Gender", "Occupation", "Age", "Tenure", "label")


@query("distinct_profile", " union all ".join(f"select '{c}' as \"column\", count(distinct {c}) as n_distinct from kyc" for c in PROFILE_COLUMNS))
def _(b: Bank) -> DataFrame:
    return explore.profile(b.kyc, PROFILE_COLUMNS)


@query(
    "distinct_values",
    " union all ".join(f"select '{c}' as \"column\", cast({c} as varchar) as value, count(*) as n from kyc group by 2" for c in PROFILE_COLUMNS),
)
def _(b: Bank) -> DataFrame:
    return explore.distinct_values(b.kyc, PROFILE_COLUMNS)


def _histogram_sql(column: str) -> str:
    return f"""select label, bin, lo + 2 * bin as bin_start, count(*) as n from (
      select label, lo, least(cast(floor(({column} - lo) / 2.0) as bigint), cast(ceil((hi + 2 - lo) / 2.0) as bigint) - 2) as bin
      from kyc, (select min({column}) as lo, max({column}) as hi from kyc) where {column} is not null) group by all"""


@query("histogram_by_label", _histogram_sql("Age"))
def _(b: Bank) -> DataFrame:
    return explore.histogram(b.kyc, "Age", "label")


@query("histogram_by_label_tenure", _histogram_sql("Tenure"))
def _(b: Bank) -> DataFrame:
    return explore.histogram(b.kyc, "Tenure", "label")


def _crosstab_sql(column: str) -> str:
    return f"""select {column}, count(*) filter (where label = 0) as n_0, count(*) filter (where label = 1) as n_1,
      100.0 * count(*) filter (where label = 0) / count(*) as pct_0, 100.0 * count(*) filter (where label = 1) / count(*) as pct_1
      from kyc group by 1"""


@query("crosstab_percent", _crosstab_sql("Gender"), pct_0=6, pct_1=6)
def _(b: Bank) -> DataFrame:
    return explore.crosstab_pct(b.kyc, "Gender", "label", [0, 1])


@query(
    "top_occupations",
    f"select *, least(pct_0, pct_1) as minor_pct from ({_crosstab_sql('Occupation')}) order by minor_pct desc, Occupation limit 10",
    pct_0=6,
    pct_1=6,
    minor_pct=6,
)
def _(b: Bank) -> DataFrame:
    return explore.top_k_minor_share(b.kyc, "Occupation", "label", [0, 1], 10)


@query(
    "repeated_name_labels",
    """select label as value, count(*) as n, 100.0 * count(*) / sum(count(*)) over () as percent from kyc
    where Name in (select Name from kyc group by 1 having count(*) > 1) group by 1""",
    percent=6,
)
def _(b: Bank) -> DataFrame:
    return explore.value_counts(explore.repeated(b.kyc, "Name"), "label")


DIMENSIONS = 64  # of the embeddings


@query(
    "cluster_profile",
    "select label, count(*) as n, " + ", ".join(f"avg(embedding[{i + 1}]::double) as e{i}" for i in range(DIMENSIONS)) + " from embeddings group by 1",
    **{f"e{i}": 6 for i in range(DIMENSIONS)},
)
def _(b: Bank) -> DataFrame:
    wide = b.table("embeddings").select("label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(DIMENSIONS)])
    return explore.group_means(wide, "label", [f"e{i}" for i in range(DIMENSIONS)])


@query("reference_label_mode", "select label, count(*) as n from kyc group by 1 order by n desc, label limit 1")
def _(b: Bank) -> DataFrame:
    return explore.majority(b.kyc, "label")


# ---- order, limit, duplicates ------------------------------------------------------------


@query(
    "dedupe_first",
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from lineitem "
    "qualify row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_extendedprice) = 1",
)
def _(b: Bank) -> DataFrame:
    from fathomline.operators.skew import first_per_key

    rows = b.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return first_per_key(rows, ["l_orderkey", "l_linenumber"], [F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice")])


@query(
    "find_duplicates",
    "select l_orderkey, l_linenumber, l_partkey, l_extendedprice from lineitem qualify count(*) over (partition by l_orderkey, l_linenumber) > 1",
)
def _(b: Bank) -> DataFrame:
    rows = b.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return explore.duplicates(rows, ["l_orderkey", "l_linenumber"])


@query("sort_desc", "select cust_id, total_no_wire_trxns from features order by total_no_wire_trxns desc, cust_id")
def _(b: Bank) -> DataFrame:
    return filters.order_desc(feature_view(b).select("cust_id", "total_no_wire_trxns"), "total_no_wire_trxns", ["cust_id"])


@query("top_k", "select cust_id, cash_balance from features order by cash_balance desc, cust_id limit 20", cash_balance=2)
def _(b: Bank) -> DataFrame:
    view = feature_view(b).select("cust_id", F.round("cash_balance", 2).alias("cash_balance"))
    return filters.top_k(view, "cash_balance", 20, ["cust_id"])


# ---- set operations ----------------------------------------------------------------------


@query("transaction_network", "select * from network")
def _(b: Bank) -> DataFrame:
    return network_of(b)


@query("all_names", "select * from all_names")
def _(b: Bank) -> DataFrame:
    return matching.all_names(b.kyc, b.emt, b.wire)


VOCABULARY_SQL = """select distinct unnest(list_filter(regexp_split_to_array(lower(regexp_replace(emt_message, '[!-/:-@\\[-`{-~]', '', 'g')), '\\s+'), lambda x: x <> '')) as word
  from emt where emt_message is not null"""


@query("unique_words", VOCABULARY_SQL)
def _(b: Bank) -> DataFrame:
    return vocabulary(b)


def vocabulary(b: Bank) -> DataFrame:
    words = text.tokens_clean(F.col("emt_message"))
    return filters.with_message(b.emt).select(F.explode(words).alias("word")).distinct()


STRONG = [w for ws in WORDS.values() for w in ws]


@query("word_list_minus", f"select word from ({VOCABULARY_SQL}) where word not in {sql_list(STRONG)}")
def _(b: Bank) -> DataFrame:
    strong = lookups.lookup(b.spark, "word", WORDS).select(F.col("value").alias("word"))
    return vocabulary(b).join(strong, "word", "left_anti")


@query(
    "append_rows",
    """select trxn_id, id_sender, id_receiver, country_sender, emt_value, wire_value, is_wire, is_emt from (
      select wire_trxn_id as trxn_id, id_sender, id_receiver, country_sender, null::double as emt_value, wire_value, 1 as is_wire, 0 as is_emt from wire
      union all select emt_trxn_id, id_sender, id_receiver, null, emt_value, null, 0, 1 from emt)""",
)
def _(b: Bank) -> DataFrame:
    from fathomline.operators.sampling import stack

    w = b.wire.select(F.col("wire_trxn_id").alias("trxn_id"), "id_sender", "id_receiver", "country_sender", "wire_value", F.lit(1).alias("is_wire"))
    e = b.emt.select(F.col("emt_trxn_id").alias("trxn_id"), "id_sender", "id_receiver", "emt_value", F.lit(1).alias("is_emt"))
    return stack([w, e], zero=["is_wire", "is_emt"])


# ---- scalar and array functions ----------------------------------------------------------


@query(
    "tokenize_bag",
    """select emt_trxn_id, array_to_string(list_filter(regexp_split_to_array(lower(regexp_replace(emt_message, '[!-/:-@\\[-`{-~]', '', 'g')), '\\s+'), lambda x: x <> ''), '|') as words
    from emt where emt_message is not null""",
)
def _(b: Bank) -> DataFrame:
    words = text.tokens_clean(F.col("emt_message"))
    return filters.with_message(b.emt).select("emt_trxn_id", F.array_join(words, "|").alias("words"))


@query(
    "tokenize_plain",
    """select emt_trxn_id, coalesce(array_to_string(list_filter(regexp_split_to_array(lower(emt_message), '\\s+'), lambda x: x <> ''), '|'), '') as words,
      coalesce(len(list_filter(regexp_split_to_array(lower(emt_message), '\\s+'), lambda x: x <> '')), 0) as n from emt""",
)
def _(b: Bank) -> DataFrame:
    words = text.tokens_plain(F.col("emt_message"))
    return b.emt.select("emt_trxn_id", F.array_join(words, "|").alias("words"), F.size(words).cast("long").alias("n"))


@query(
    "flatten_messages",
    """select conv_id, turn // 10000 as part, array_to_string(list_filter(flatten(list(regexp_split_to_array(lower(text), '\\s+') order by turn)), lambda x: x <> ''), ' ') as words
    from conversations group by 1, 2""",
)
def _(b: Bank) -> DataFrame:
    lists = F.transform(F.array_sort(F.collect_list(F.struct("turn", text.tokens_plain(F.col("text")).alias("w")))), lambda x: x["w"])
    # Ten thousand turns a row: a conversation of any length stays whole without a row of any length.
    return b.table("conversations").groupBy("conv_id", F.expr("turn div 10000").alias("part")).agg(F.array_join(text.flatten_tokens(lists), " ").alias("words"))


@query(
    "split_and",
    "select doc_id, len(case when contains(text, 'and ') then string_split(text, ' and ') else [text] end) as parts from documents",
)
def _(b: Bank) -> DataFrame:
    return b.table("documents").select("doc_id", F.size(text.split_and(F.col("text"))).cast("long").alias("parts"))


@query(
    "normalize_person",
    """select cust_id, case when regexp_matches(upper(Name), '^(DR\\.|MR\\.|MRS\\.)') then trim(regexp_replace(upper(Name), '^(DR\\.|MR\\.|MRS\\.)', '')) else upper(Name) end as name
    from kyc""",
)
def _(b: Bank) -> DataFrame:
    return b.kyc.select("cust_id", text.norm_name(F.col("Name")).alias("name"))


@query(
    "amount_coalesce_add",
    "select trxn_id, value as total_amount from network",
)
def _(b: Bank) -> DataFrame:
    both = flow.combined(b.wire, b.emt)
    return both.select("trxn_id", scalar.total_amount(F.col("emt_value"), F.col("wire_value")).alias("total_amount"))


@query(
    "softmax_vec",
    """select Occupation, value, exp(value - max(value) over ()) / sum(exp(value - max)) over () as softmax, value / sum(value) over () as linear,
      1 / (1 + exp(-value)) as sigmoid
    from (select *, max(value) over () as max from (select Occupation, avg(label) * 10 as value from kyc group by 1))""",
    value=6,
    softmax=8,
    linear=8,
    sigmoid=8,
)
def _(b: Bank) -> DataFrame:
    rates = b.kyc.groupBy("Occupation").agg((F.avg("label") * 10).alias("value"))
    return scalar.softmax_vec(rates)


# ---- encoding and scaling ----------------------------------------------------------------


@query(
    "label_encode",
    "select cust_id, cast(dense_rank() over (order by Gender) - 1 as integer) as Gender, cast(dense_rank() over (order by Occupation) - 1 as integer) as Occupation from kyc",
)
def _(b: Bank) -> DataFrame:
    both = b.kyc.select("cust_id", "Gender", "Occupation")
    return encode.label_encode(encode.label_encode(both, "Gender"), "Occupation")


@query("one_hot", f"select cust_id, {GENDER_COLUMNS}, " + _occupation_columns('"Occupation_{} {}"') + " from kyc")
def _(b: Bank) -> DataFrame:
    return encode.one_hot(b.kyc.select("cust_id", "Gender", "Occupation"), ["Gender", "Occupation"])


SCALED = tuple(dict.fromkeys(clusters.TRANSACTION_COLUMNS))


@query(
    "standardize",
    "select cust_id, " + ", ".join(f"({c} - avg({c}) over ()) / stddev_pop({c}) over () as {c}" for c in SCALED) + " from features",
    **{c: 6 for c in SCALED},
)
def _(b: Bank) -> DataFrame:
    return encode.zscore(feature_view(b).select("cust_id", *SCALED), SCALED)


@query(
    "minmax_scale",
    f"select cust_id, coalesce((match_score - min(match_score) over ()) / nullif(max(match_score) over () - min(match_score) over (), 0), 0.0) as similarity_score from (select cust_id, coalesce(match_score, 0.0) as match_score from ({FUZZY_SQL}))",
    similarity_score=6,
)
def _(b: Bank) -> DataFrame:
    matched = matching.fuzzy_match(b.kyc.select("cust_id", "Occupation"), FUZZY_CHOICES)
    scored = matched.select("cust_id", F.coalesce("match_score", F.lit(0.0)).alias("similarity_score"))
    return encode.minmax(scored, "similarity_score")


# ---- evaluation without a model ----------------------------------------------------------


SCORE_SQL = "select c_custkey as id, case when c_nationkey % 4 = 0 then 1 else 0 end as label, (c_acctbal + 1000) / 11000 as score from customer"
COARSE_SQL = "select id, label, round(score, 1) as score from (" + SCORE_SQL + ")"


def scores(b: Bank) -> DataFrame:
    return b.table("customer").select(
        F.col("c_custkey").alias("id"),
        (F.col("c_nationkey") % 4 == 0).cast("int").alias("label"),
        ((F.col("c_acctbal") + 1000) / 11000).alias("score"),
    )


def coarse_scores(b: Bank) -> DataFrame:
    """Scores with many ties."""
    return scores(b).withColumn("score", F.round("score", 1))


def _auc_sql(rows: str) -> str:
    return f"""select (sum(case when label = 1 then r end) - p * (p + 1) / 2.0) / (p * q) as auc, p as n_pos, q as n_neg from (
      select label, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0 as r,
        count(*) filter (where label = 1) over () as p, count(*) filter (where label = 0) over () as q from ({rows})) group by p, q"""


@query("auc_roc", _auc_sql(SCORE_SQL), auc=8)
def _(b: Bank) -> DataFrame:
    return evaluate.auc(scores(b), "label", "score")


@query("auc_roc_ties", _auc_sql(COARSE_SQL), auc=8)
def _(b: Bank) -> DataFrame:
    return evaluate.auc(coarse_scores(b), "label", "score")


@query(
    "roc_curve",
    f"""select distinct score as threshold, sum(case when label = 0 then 1.0 else 0 end) over w / sum(case when label = 0 then 1.0 else 0 end) over () as fpr,
      sum(case when label = 1 then 1.0 else 0 end) over w / sum(case when label = 1 then 1.0 else 0 end) over () as tpr
    from ({SCORE_SQL}) window w as (order by score desc range between unbounded preceding and current row)""",
    threshold=6,
    fpr=6,
    tpr=6,
)
def _(b: Bank) -> DataFrame:
    return evaluate.roc(scores(b), "label", "score")


@query(
    "confusion_stats",
    f"""select tp, fp, tn, fn, tp / n as tp_share, fp / n as fp_share, tn / n as tn_share, fn / n as fn_share, (tp + tn) / n as accuracy,
      tp / (tp + fp) as precision, tp / (tp + fn) as recall, 2.0 * tp / (2.0 * tp + fp + fn) as f1 from (
      select count(*) filter (where label = 1 and score > 0.5) as tp, count(*) filter (where label = 0 and score > 0.5) as fp,
        count(*) filter (where label = 0 and score <= 0.5) as tn, count(*) filter (where label = 1 and score <= 0.5) as fn,
        count(*)::double as n from ({SCORE_SQL}))""",
    **{c: 6 for c in ("tp_share", "fp_share", "tn_share", "fn_share", "accuracy", "precision", "recall", "f1")},
)
def _(b: Bank) -> DataFrame:
    return evaluate.confusion(scores(b).withColumn("p", scalar.threshold_flag(F.col("score"), 0.5)), "label", "p")


# ---- statistics --------------------------------------------------------------------------


@query(
    "five_number_summary",
    """select o_orderpriority, min(o_totalprice) as min, quantile_cont(o_totalprice, 0.25) as q1, quantile_cont(o_totalprice, 0.5) as median,
      quantile_cont(o_totalprice, 0.75) as q3, max(o_totalprice) as max, count(*) as n, avg(o_totalprice) as mean, stddev_pop(o_totalprice) as sd
    from orders group by 1""",
    min=2,
    q1=4,
    median=4,
    q3=4,
    max=2,
    mean=4,
    sd=4,
)
def _(b: Bank) -> DataFrame:
    return stats.five_num(b.table("orders"), "o_totalprice", ["o_orderpriority"])


@query(
    "five_number_summary_whole",
    """select min(l_quantity) as min, quantile_cont(l_quantity, 0.25) as q1, quantile_cont(l_quantity, 0.5) as median,
      quantile_cont(l_quantity, 0.75) as q3, max(l_quantity) as max, count(*) as n, avg(l_quantity) as mean, stddev_pop(l_quantity) as sd from lineitem""",
    mean=6,
    sd=6,
)
def _(b: Bank) -> DataFrame:
    return stats.five_num(b.table("lineitem"), "l_quantity")


SUMMED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "five_number_summary_columns",
    " union all ".join(
        f"""select l_returnflag, '{c}' as "column", min({c}) as min, quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.5) as median,
      quantile_cont({c}, 0.75) as q3, max({c}) as max, count({c}) as n, avg({c}) as mean, stddev_pop({c}) as sd from lineitem group by 1"""
        for c in SUMMED
    ),
    min=4,
    q1=4,
    median=4,
    q3=4,
    max=4,
    mean=4,
    sd=4,
)
def _(b: Bank) -> DataFrame:
    return stats.five_nums(b.table("lineitem"), SUMMED, ["l_returnflag"])


@query(
    "welch_ttest",
    """select m1, m2, s1, s2, n1, n2, (m1 - m2) / sqrt(s1 * s1 / n1 + s2 * s2 / n2) as t,
      power(s1 * s1 / n1 + s2 * s2 / n2, 2) / (power(s1 * s1 / n1, 2) / (n1 - 1) + power(s2 * s2 / n2, 2) / (n2 - 1)) as df from (
      select avg(o_totalprice) filter (where o_orderstatus = 'F') as m1, avg(o_totalprice) filter (where o_orderstatus = 'O') as m2,
        stddev_pop(o_totalprice) filter (where o_orderstatus = 'F') as s1, stddev_pop(o_totalprice) filter (where o_orderstatus = 'O') as s2,
        count(*) filter (where o_orderstatus = 'F') as n1, count(*) filter (where o_orderstatus = 'O') as n2 from orders)""",
    m1=4,
    m2=4,
    s1=4,
    s2=4,
    t=6,
    df=4,
)
def _(b: Bank) -> DataFrame:
    return stats.welch_groups(b.table("orders"), "o_totalprice", "o_orderstatus", "F", "O").drop("p")


@query("welch_p_value")
def _(b: Bank) -> DataFrame:
    return stats.welch_groups(b.table("orders"), "o_totalprice", "o_orderstatus", "F", "O").select("t", "df", "p")


CORRELATED = tuple(c for c in (*features.BASIC, *features.TOTALS))


@query(
    "correlation_rank",
    "select feature, correlation from (" + " union all ".join(f"select '{c}' as feature, corr({c}, label) as correlation from features" for c in CORRELATED)
    + ") order by correlation desc, feature limit 20",
    correlation=6,
)
def _(b: Bank) -> DataFrame:
    return stats.corr_rank(feature_view(b), "label", CORRELATED, 20)


# ---- composite risk ----------------------------------------------------------------------


def signals(b: Bank, flags: DataFrame | None = None) -> DataFrame:
    """The master table of the composite score.

    ``flags`` (cust_id, criminal_cash) come from the cash clusters. Without them cash counts as criminal above the
    mean number of deposits, a rule that SQL can check.
    """
    base = b.kyc_with_open_sanctions.select("cust_id", "Name", "Occupation", "OpenSanc_query")
    labelled = filters.flag_in(base, "cust_id", b.suspects.select("id"), "Label_Filtered")
    matched = matching.fuzzy_match(labelled, FUZZY_CHOICES)
    scaled = encode.minmax(matched.withColumn("similarity_score", F.coalesce("match_score", F.lit(0.0))), "similarity_score")
    weighted = joins.network_score(scaled, flow.weights_to(network_of(b), b.seeds))
    flagged = weighted.withColumn("Label_Filtered_network", scalar.threshold_flag(F.col("network_score"), 0.2))
    if flags is not None:
        return features.zero_fill(flagged.join(flags.select("cust_id", "criminal_cash"), "cust_id", "left"), ["criminal_cash"])
    cash = features.zero_fill(
        flagged.join(features.cash_deposits(b.cash).select("cust_id", "no_cash_deposits"), "cust_id", "left"), ["no_cash_deposits"]
    )
    mean = cash.agg(F.avg("no_cash_deposits").alias("m")).scalar()
    return cash.withColumn("criminal_cash", (F.col("no_cash_deposits") > mean).cast("int"))


SIGNALS_SQL = f"""
select *, (similarity - min(similarity) over ()) / nullif(max(similarity) over () - min(similarity) over (), 0) as similarity_score,
  case when network_score > 0.2 then 1 else 0 end as Label_Filtered_network,
  case when deposits > avg(deposits) over () then 1 else 0 end as criminal_cash from (
  select k.cust_id, k.Name, k.OpenSanc_query, case when k.cust_id in (select id from suspects) then 1 else 0 end as Label_Filtered,
    m.Label_Filtered_By_Occupations, coalesce(m.match_score, 0.0) as similarity, coalesce(w.weight, 0.0) as network_score,
    coalesce(c.d, 0) as deposits
  from kyc k join ({FUZZY_SQL}) m on m.cust_id = k.cust_id left join weights w on w.id = k.cust_id
  left join (select cust_id, count(*) as d from cash where type = 'deposit' group by 1) c on c.cust_id = k.cust_id)"""


def _odds_sql(flag: str) -> str:
    def cell(a: int, c: int) -> str:
        return f"count(*) filter (where Label_Filtered = {a} and {flag} = {c})"

    return f"({cell(1, 1)} * {cell(0, 0)})::double / nullif({cell(1, 0)} * {cell(0, 1)}, 0)"


CORR_ODDS_SQL = "1.0 / nullif(1.0 - corr(network_score, Label_Filtered), 0)"
RATE_SQL = (
    "avg(Label_Filtered_network) filter (where criminal_cash = 1) / nullif(avg(Label_Filtered_network) filter (where criminal_cash = 0), 0)"
)
WEIGHTS_SQL = f"""
select signal, value, exp(value - max(value) over ()) / sum(e) over () as weight from (
  select *, exp(value - max(value) over ()) as e from (
    select 'OpenSanc_query' as signal, coalesce({_odds_sql('OpenSanc_query')}, 0.0) as value from signals
    union all select 'similarity_score', coalesce({_odds_sql('Label_Filtered_By_Occupations')}, 0.0) from signals
    union all select 'network_score', coalesce({CORR_ODDS_SQL}, 0.0) from signals
    union all select 'criminal_cash', coalesce({RATE_SQL}, 0.0) from signals))"""


@query("odds_ratio", f"select {_odds_sql('OpenSanc_query')} as odds_ratio from signals", (("signals", SIGNALS_SQL),), odds_ratio=6)
def _(b: Bank) -> DataFrame:
    return stats.odds_ratio(signals(b), "Label_Filtered", "OpenSanc_query")


@query("correlation_odds", f"select {CORR_ODDS_SQL} as corr_odds from signals", (("signals", SIGNALS_SQL),), corr_odds=6)
def _(b: Bank) -> DataFrame:
    return stats.corr_odds(signals(b), "network_score", "Label_Filtered")


@query("group_rate_ratio", f"select {RATE_SQL} as rate_ratio from signals", (("signals", SIGNALS_SQL),), rate_ratio=6)
def _(b: Bank) -> DataFrame:
    return stats.rate_ratio(signals(b), "criminal_cash", "Label_Filtered_network")


@query("risk_weights", WEIGHTS_SQL, (("signals", SIGNALS_SQL),), value=6, weight=6)
def _(b: Bank) -> DataFrame:
    return risk.risk_weights(signals(b))


@query(
    "risk_score",
    """select cust_id, Name, coalesce(OpenSanc_query, 0) * (select weight from odds where signal = 'OpenSanc_query')
      + similarity_score * (select weight from odds where signal = 'similarity_score')
      + network_score * (select weight from odds where signal = 'network_score')
      + criminal_cash * (select weight from odds where signal = 'criminal_cash') as result from signals""",
    (("signals", SIGNALS_SQL), ("odds", WEIGHTS_SQL)),
    result=6,
)
def _(b: Bank) -> DataFrame:
    table = cut_lineage(signals(b))
    return risk.risk_score(table, risk.risk_weights(table))
