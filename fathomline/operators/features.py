"""Per-customer features from wires, e-mail transfers and cash."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.scalar import EXTERNAL_PREFIX, ratio
from fathomline.functions.text import count_words, tokens_plain
from fathomline.operators.skew import hot_keys, list_parts, spread_join
from fathomline.sources.lookups import (
    COUNTRIES,
    NORTH_AMERICA,
    OCCUPATION_CATEGORIES,
    OTHER_COUNTRY,
    WILDLIFE_JURISDICTION,
    WORD_CATEGORIES,
)

COUNTS = "long"


# The many conditional aggregates are SQL text: one call per column instead of dozens.
def _count_if(cond: str, name: str) -> Column:
    return F.expr(f"count_if({cond}) as {name}")


def _sum_if(cond: str, value: str, zero: str, name: str) -> Column:
    return F.expr(f"coalesce(sum(case when {cond} then {value} end), {zero}) as {name}")


def _in(column: str, values: Sequence[str]) -> str:
    listed = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    return f"{column} in ({listed})"


def wire_legs(wire: DataFrame) -> DataFrame:
    """Each wire twice: once for its sender, once for its receiver. One scan serves both sides."""
    return _legs(
        wire,
        "wire",
        trxn="wire_trxn_id",
        value="wire_value",
        international=F.coalesce(F.col("country_receiver") != F.col("country_sender"), F.lit(False)),
        country=True,
    )


def emt_legs(emt: DataFrame) -> DataFrame:
    """Each e-mail transfer twice: once for its sender, once for its receiver."""
    return _legs(emt, "emt", trxn="emt_trxn_id", value="emt_value", international=F.lit(False), message=True)


def cash_legs(cash: DataFrame) -> DataFrame:
    """Cash as legs: deposits are received, withdrawals are sent."""
    direction = F.when(F.col("type") == "deposit", "received").when(F.col("type") == "withdrawal", "sent")
    none = F.lit(None).cast("string")
    return cash.select(
        F.col("cust_id"),
        none.alias("other_id"),
        F.lit("cash").alias("channel"),
        direction.alias("direction"),
        F.col("cash_trxn_id").alias("trxn_id"),
        F.col("amount"),
        F.lit(False).alias("international"),
        none.alias("own_country"),
        none.alias("other_country"),
        none.alias("message"),
    ).filter(F.col("direction").isNotNull() & F.col("cust_id").isNotNull())


def _legs(
    df: DataFrame, channel: str, trxn: str, value: str, international: Column, country: bool = False, message: bool = False
) -> DataFrame:
    none = F.lit(None).cast("string")

    def side(direction: str, own: str, other: str) -> Column:
        return F.struct(
            F.col(f"id_{own}").alias("cust_id"),
            F.col(f"id_{other}").alias("other_id"),
            F.lit(direction).alias("direction"),
            (F.col(f"country_{own}") if country else none).alias("own_country"),
            (F.col(f"country_{other}") if country else none).alias("other_country"),
        )

    both = F.explode(F.array(side("sent", "sender", "receiver"), side("received", "receiver", "sender")))
    return (
        df.select(
            F.col(trxn).alias("trxn_id"),
            F.col(value).alias("amount"),
            international.alias("international"),
            (F.col("emt_message") if message else none).alias("message"),
            both.alias("leg"),
        )
        .select(
            F.col("leg.cust_id"),
            F.col("leg.other_id"),
            F.lit(channel).alias("channel"),
            F.col("leg.direction"),
            "trxn_id",
            "amount",
            "international",
            F.col("leg.own_country"),
            F.col("leg.other_country"),
            "message",
        )
        .filter(F.col("cust_id").isNotNull())
    )


def _is(channel: str, direction: str) -> str:
    return f"channel = '{channel}' and direction = '{direction}'"


# Per channel and direction: columns for the number, the amount and, for wires, the number that cross a border.
BASIC_NAMES = {
    ("wire", "sent"): ("no_wire_trxns_sent", "wire_total_amnt_sent", "no_international_wire_trxns_sent"),
    ("wire", "received"): ("no_wire_trxns_received", "wire_total_amnt_received", "no_international_wire_trxns_received"),
    ("emt", "sent"): ("no_emt_trxns_sent", "emt_total_amnt_sent"),
    ("emt", "received"): ("no_emt_trxns_received", "emt_total_amnt_received"),
    ("cash", "received"): ("no_cash_deposits", "total_cash_deposit"),
    ("cash", "sent"): ("no_cash_withdraws", "total_cash_withdraw"),
}


def _basic_aggregates(channel: str) -> list[Column]:
    columns = []
    for (ch, direction), names in BASIC_NAMES.items():
        if ch == channel:
            here = f"direction = '{direction}'"
            columns.append(_count_if(f"{here} and trxn_id is not null", names[0]))
            columns.append(_sum_if(here, "amount", "0.0D", names[1]))
            columns += [_count_if(f"{here} and international", n) for n in names[2:]]
    return columns


BASIC = (
    "no_wire_trxns_sent",
    "wire_total_amnt_sent",
    "no_international_wire_trxns_sent",
    "no_wire_trxns_received",
    "wire_total_amnt_received",
    "no_international_wire_trxns_received",
    "no_emt_trxns_sent",
    "emt_total_amnt_sent",
    "no_emt_trxns_received",
    "emt_total_amnt_received",
    "no_cash_deposits",
    "total_cash_deposit",
    "no_cash_withdraws",
    "total_cash_withdraw",
)


def wire_sent(wire: DataFrame) -> DataFrame:
    """Per sender: number of wires, total amount, number that cross a border."""
    return _wire_side(wire, "sender", "sent")


def wire_received(wire: DataFrame) -> DataFrame:
    """The same per receiver."""
    return _wire_side(wire, "receiver", "received")


def _wire_side(wire: DataFrame, side: str, word: str) -> DataFrame:
    abroad = F.coalesce(F.col("country_receiver") != F.col("country_sender"), F.lit(False))
    return wire.groupBy(F.col(f"id_{side}").alias("cust_id")).agg(
        F.count("wire_trxn_id").alias(f"no_wire_trxns_{word}"),
        F.sum("wire_value").alias(f"wire_total_amnt_{word}"),
        F.sum(abroad.cast(COUNTS)).alias(f"no_international_wire_trxns_{word}"),
    )


def emt_sent(emt: DataFrame) -> DataFrame:
    """Per sender: number of transfers and total amount."""
    return _emt_side(emt, "sender", "sent")


def emt_received(emt: DataFrame) -> DataFrame:
    return _emt_side(emt, "receiver", "received")


def _emt_side(emt: DataFrame, side: str, word: str) -> DataFrame:
    return emt.groupBy(F.col(f"id_{side}").alias("cust_id")).agg(
        F.count("emt_trxn_id").alias(f"no_emt_trxns_{word}"), F.sum("emt_value").alias(f"emt_total_amnt_{word}")
    )


def cash_deposits(cash: DataFrame) -> DataFrame:
    return _cash_kind(cash, "deposit", "no_cash_deposits", "total_cash_deposit")


def cash_withdrawals(cash: DataFrame) -> DataFrame:
    return _cash_kind(cash, "withdrawal", "no_cash_withdraws", "total_cash_withdraw")


def _cash_kind(cash: DataFrame, kind: str, count: str, total: str) -> DataFrame:
    return (
        cash.filter(F.col("type") == kind)
        .groupBy("cust_id")
        .agg(F.count("cash_trxn_id").alias(count), F.sum("amount").alias(total))
    )


def zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null to zero, keeping each column's type."""
    types = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(types[c])) for c in columns})


def add_totals(df: DataFrame) -> DataFrame:
    """Totals over both directions and balances (in minus out)."""

    def plus(a: str, b: str) -> Column:
        return F.col(a) + F.col(b)

    return df.withColumns(
        {
            "total_international_trxns": plus("no_international_wire_trxns_sent", "no_international_wire_trxns_received"),
            "total_no_wire_trxns": plus("no_wire_trxns_sent", "no_wire_trxns_received"),
            "total_no_emt_trxns": plus("no_emt_trxns_sent", "no_emt_trxns_received"),
            "total_no_cash_trxns": plus("no_cash_deposits", "no_cash_withdraws"),
            "wire_trxn_balance": F.col("wire_total_amnt_received") - F.col("wire_total_amnt_sent"),
            "emt_trxn_balance": F.col("emt_total_amnt_received") - F.col("emt_total_amnt_sent"),
            "cash_balance": F.col("total_cash_deposit") - F.col("total_cash_withdraw"),
        }
    )


TOTALS = (
    "total_international_trxns",
    "total_no_wire_trxns",
    "total_no_emt_trxns",
    "total_no_cash_trxns",
    "wire_trxn_balance",
    "emt_trxn_balance",
    "cash_balance",
)


def kyc_features(kyc: DataFrame, wire: DataFrame, emt: DataFrame, cash: DataFrame, totals: bool = True) -> DataFrame:
    """The customer feature view: one row per customer, zero where there is no transaction.

    Each table is read once, both directions together, and shuffled as partial sums of
    its own columns only. All four sides are then partitioned by customer, so the joins move nothing more.
    """
    joined = kyc
    for channel, legs in (("wire", wire_legs(wire)), ("emt", emt_legs(emt)), ("cash", cash_legs(cash))):
        joined = joined.join(legs.groupBy("cust_id").agg(*_basic_aggregates(channel)), "cust_id", "left")
    joined = add_totals(zero_fill(joined, BASIC))
    return joined.select(
        "Name", "Gender", "Occupation", "Age", "Tenure", "cust_id", *BASIC, *(TOTALS if totals else ()), "label"
    )


def country_counters(kyc: DataFrame, wire: DataFrame) -> DataFrame:
    """send_XX and receive_XX per customer; the country is the customer's own side of the wire."""
    code = F.when(F.col("own_country").isin(*COUNTRIES), F.col("own_country")).otherwise(OTHER_COUNTRY)
    names = [
        (f"{word}_{c}", direction, c)
        for c in (*COUNTRIES, OTHER_COUNTRY)
        for word, direction in (("send", "sent"), ("receive", "received"))
    ]
    counts = (
        wire_legs(wire)
        .withColumn("_code", code)
        .groupBy("cust_id")
        .agg(*[_count_if(f"direction = '{d}' and _code = '{c}'", n) for n, d, c in names])
    )
    return zero_fill(kyc.select("cust_id").join(counts, "cust_id", "left"), [n for n, _, _ in names])


def own_occupation_flags(kyc: DataFrame, lookup: Mapping[str, Sequence[str]]) -> DataFrame:
    """1 where the customer's own occupation is in a category list; a null occupation is in none."""
    return kyc.withColumns(
        {
            f"{c}_occupation": F.coalesce(F.col("Occupation").isin(list(lookup[c])).cast("int"), F.lit(0))
            for c in OCCUPATION_CATEGORIES
        }
    )


def sender_receiver_enrich(tx: DataFrame, kyc: DataFrame) -> DataFrame:
    """Occupation of both parties of each transaction."""
    jobs = kyc.select("cust_id", "Occupation")
    trxn = tx.columns[0]
    hot = hot_keys(tx, "id_sender", "id_receiver")
    sender, receiver = (jobs.withColumnRenamed("Occupation", f"{side}_occupation") for side in ("sender", "receiver"))
    sent = spread_join(tx, sender, "id_sender", "cust_id", "left", [trxn], hot)
    return spread_join(sent, receiver, "id_receiver", "cust_id", "left", [trxn], hot)


def counterparties(kyc: DataFrame, tx: DataFrame, direction: str) -> DataFrame:
    """Customers with each transaction they sent or received; customers without one keep a row."""
    own = "id_sender" if direction == "sent" else "id_receiver"
    trxn = tx.columns[0]
    # The transactions are the large side, so the customers without any are added on their own.
    with_tx = spread_join(tx, kyc.select("cust_id"), own, "cust_id", "left_semi", [trxn]).withColumn("cust_id", F.col(own))
    active = tx.select(F.col(own).alias("cust_id")).distinct()
    without = kyc.select("cust_id").join(active, "cust_id", "left_anti")
    return with_tx.select("cust_id", *tx.columns).unionByName(without, allowMissingColumns=True)


def counterparty_lists(kyc: DataFrame, wire: DataFrame, emt: DataFrame) -> DataFrame:
    """Who and what each customer dealt with: occupations, countries, ids and messages, per channel and direction.

    A list is kept as rows (value, how often), which holds the same content, combines on
    the map side and stays whole for a customer with billions of transactions.
    """
    legs = wire_legs(wire).unionByName(emt_legs(emt))
    jobs = kyc.select(F.col("cust_id").alias("_id"), F.col("Occupation").alias("occupation"))
    known = kyc.select("cust_id")
    hot = hot_keys(wire, "id_sender", "id_receiver") + hot_keys(emt, "id_sender", "id_receiver")

    # Pairs first: the joins then see each pair of parties once, not each transaction.
    pairs = legs.groupBy("cust_id", "other_id", "channel", "direction").agg(F.count(F.lit(1)).alias("n"))
    with_jobs = spread_join(pairs, jobs, "other_id", "_id", "left", ["cust_id", "channel", "direction"], hot)
    by_pair = with_jobs.select(
        "cust_id",
        "channel",
        "direction",
        "n",
        F.explode(F.create_map(F.lit("id"), F.col("other_id"), F.lit("occupation"), F.col("occupation"))).alias(
            "field", "value"
        ),
    )
    texts = legs.select(
        "cust_id",
        "channel",
        "direction",
        F.lit(1).cast("long").alias("n"),
        F.explode(F.create_map(F.lit("country"), F.col("other_country"), F.lit("message"), F.col("message"))).alias(
            "field", "value"
        ),
    )
    lists = (
        by_pair.unionByName(texts)
        .filter(F.col("value").isNotNull())
        .groupBy("cust_id", "channel", "direction", "field", "value")
        .agg(F.sum("n").alias("occurrences"))
    )
    return spread_join(lists, known, "cust_id", "cust_id", "left_semi", ["field", "value"], hot)


def packed_lists(lists: DataFrame, limit: int = 10_000) -> DataFrame:
    """The lists as sorted arrays with repeats; a list longer than ``limit`` takes several rows (part 0, 1, ...)."""
    key = F.concat_ws("\u0001", "cust_id", "channel", "direction", "field")
    units = (
        lists.withColumn("_key", key)
        # A value that occurs very often becomes several pieces of at most ``limit`` repeats.
        .withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("occurrences") - 1) / F.lit(limit)))))
        .withColumn("_n", F.least(F.lit(limit).cast("long"), F.col("occurrences") - F.col("_piece") * limit))
        .withColumn("_id", F.concat_ws("\u0001", "value", F.col("_piece").cast("string")))
    )
    repeats = F.flatten(F.sort_array(F.collect_list(F.array_repeat(F.col("value"), F.col("_n").cast("int")))))
    return (
        list_parts(units, "_key", "_id", limit)
        .groupBy("cust_id", "channel", "direction", "field", "part")
        .agg(repeats.alias("values"))
    )


def _other_side(kyc: DataFrame, legs: DataFrame, lookup: Mapping[str, Sequence[str]], hot: list[int]) -> DataFrame:
    """Legs with 0/1 marks for the category of the counterparty's occupation."""
    marks = own_occupation_flags(kyc, lookup)
    wanted = F.lit(False)
    for c in OCCUPATION_CATEGORIES:
        wanted = wanted | (F.col(f"{c}_occupation") == 1)
    flagged = marks.filter(wanted).select(F.col("cust_id").alias("_id"), *[F.col(f"{c}_occupation").alias(f"_is_{c}") for c in OCCUPATION_CATEGORIES])
    return spread_join(legs, flagged, "other_id", "_id", "left", ["cust_id", "trxn_id", "direction"], hot)


def _category_aggregates(*channels: str) -> list[Column]:
    return [
        _count_if(f"{_is(ch, d)} and _is_{c} = 1", f"no_{ch}_{c}_occupation_{d}")
        for ch in channels
        for c in OCCUPATION_CATEGORIES
        for d in ("sent", "received")
    ]


def _jurisdiction_aggregates() -> list[Column]:
    return [
        _count_if(f"{_is('wire', d)} and {_in('other_country', codes)}", f"no_wire_{d}_{name}")
        for name, codes in (("wildlife_jurisdiction", WILDLIFE_JURISDICTION), ("north_america", NORTH_AMERICA))
        for d in ("sent", "received")
    ]


def _external_aggregates(*channels: str) -> list[Column]:
    return [
        _count_if(f"{_is(ch, d)} and startswith(other_id, '{EXTERNAL_PREFIX}')", f"no_external_{ch}_trxn_{d}")
        for ch in channels
        for d in ("received", "sent")
    ]


def _message_marks(words: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    tokens = tokens_plain(F.col("message"))
    return {f"_words_{c}": count_words(tokens, words[c]) for c in WORD_CATEGORIES}


def _message_aggregates() -> list[Column]:
    return [
        _sum_if(_is("emt", d), f"_words_{c}", "0L", f"no_emt_{c}_msg_{d}")
        for c in WORD_CATEGORIES
        for d in ("sent", "received")
    ]


def _per_customer(kyc: DataFrame, legs: DataFrame, aggregates: list[Column]) -> DataFrame:
    counts = legs.groupBy("cust_id").agg(*aggregates)
    return zero_fill(kyc.select("cust_id").join(counts, "cust_id", "left"), [c for c in counts.columns if c != "cust_id"])


def category_counts(kyc: DataFrame, wire: DataFrame, emt: DataFrame, lookup: Mapping[str, Sequence[str]]) -> DataFrame:
    """Transactions per channel and direction whose counterparty works in a category."""
    counts = kyc.select("cust_id")
    for channel, tx, legs in (("wire", wire, wire_legs(wire)), ("emt", emt, emt_legs(emt))):
        marked = _other_side(kyc, legs, lookup, hot_keys(tx, "id_sender", "id_receiver"))
        sums = marked.groupBy("cust_id").agg(*_category_aggregates(channel))
        counts = zero_fill(counts.join(sums, "cust_id", "left"), [c for c in sums.columns if c != "cust_id"])
    return counts


def jurisdiction_counts(kyc: DataFrame, wire: DataFrame) -> DataFrame:
    """Wires whose other side is in a wildlife jurisdiction or in North America."""
    return _per_customer(kyc, wire_legs(wire), _jurisdiction_aggregates())


def external_counts(kyc: DataFrame, wire: DataFrame, emt: DataFrame) -> DataFrame:
    """Transactions with external parties per channel and direction."""
    return _per_customer(kyc, wire_legs(wire).unionByName(emt_legs(emt)), _external_aggregates("wire", "emt"))


def message_counts(kyc: DataFrame, emt: DataFrame, words: Mapping[str, Sequence[str]]) -> DataFrame:
    """Words of each category in the messages a customer sent and received, repeats counted."""
    legs = emt_legs(emt.filter(F.col("emt_message").isNotNull())).withColumns(_message_marks(words))
    return _per_customer(kyc, legs, _message_aggregates())


AVERAGES = {
    f"average_{ch}_{d}": (f"{ch}_total_amnt_{d}", f"no_{ch}_trxns_{d}") for ch in ("wire", "emt") for d in ("sent", "received")
}


def averages(features: DataFrame) -> DataFrame:
    """Mean amount per channel and direction; 0 for a customer without such transactions."""
    return features.withColumns({n: ratio(F.col(t), F.col(c)) for n, (t, c) in AVERAGES.items()})


def customer_profile(
    kyc: DataFrame,
    wire: DataFrame,
    emt: DataFrame,
    cash: DataFrame,
    occupations: Mapping[str, Sequence[str]],
    words: Mapping[str, Sequence[str]],
) -> DataFrame:
    """The wide feature table: feature view, own flags, averages, external, category, jurisdiction and message counts.

    Each channel is aggregated per customer once; the lists behind the counts are in
    ``counterparty_lists``.
    """
    wires = _other_side(kyc, wire_legs(wire), occupations, hot_keys(wire, "id_sender", "id_receiver"))
    said = emt_legs(emt).withColumns(_message_marks(words))
    mails = _other_side(kyc, said, occupations, hot_keys(emt, "id_sender", "id_receiver"))
    extra = {
        "wire": [*_external_aggregates("wire"), *_category_aggregates("wire"), *_jurisdiction_aggregates()],
        "emt": [*_external_aggregates("emt"), *_category_aggregates("emt"), *_message_aggregates()],
        "cash": [],
    }
    base, counted = own_occupation_flags(kyc, occupations), []
    for channel, legs in (("wire", wires), ("emt", mails), ("cash", cash_legs(cash))):
        sums = legs.groupBy("cust_id").agg(*_basic_aggregates(channel), *extra[channel])
        base = base.join(sums, "cust_id", "left")
        counted += [c for c in sums.columns if c != "cust_id"]
    filled = averages(add_totals(zero_fill(base, counted)))
    return filled.drop("Name", "Occupation").withColumns({"Age": F.coalesce(F.col("Age"), F.lit(0))})
