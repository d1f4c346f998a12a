"""Row selection, membership flags and presentation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.scalar import risk_percent, risk_tier, yes_no
from fathomline.functions.text import title_case
from fathomline.operators.skew import spread_join


def lookup(kyc: DataFrame, cust_id: str) -> DataFrame:
    """All columns of one customer; nothing for an unknown id. The id is a literal, never part of SQL text."""
    return kyc.filter(F.col("cust_id") == F.lit(cust_id))


def offender(found: DataFrame, name: str) -> DataFrame:
    """News link of a named offender."""
    return found.filter(F.col("Criminal") == F.lit(name))


def with_message(emt: DataFrame) -> DataFrame:
    return emt.filter(F.col("emt_message").isNotNull())


def keep_ids(df: DataFrame, ids: DataFrame, key: str, id_col: str = "id") -> DataFrame:
    """Rows whose key is in the list."""
    return spread_join(df, ids.select(id_col), key, id_col, "left_semi", [df.columns[0]])


def minus_ids(df: DataFrame, ids: DataFrame, key: str, id_col: str = "id") -> DataFrame:
    """Rows whose key is not in the list."""
    return spread_join(df, ids.select(id_col), key, id_col, "left_anti", [df.columns[0]])


def flag_in(df: DataFrame, key: str, ids: DataFrame, name: str, id_col: str = "id") -> DataFrame:
    """Add 1 where the key is in the list, else 0."""
    marks = ids.select(F.col(id_col).alias("_listed")).distinct().withColumn(name, F.lit(1))
    return spread_join(df, marks, key, "_listed", "left", [df.columns[0]]).withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def either(df: DataFrame, a: str = "Risk", b: str = "OS_Results") -> DataFrame:
    """Rows with one of two flags."""
    return df.filter((F.col(a) == 1) | (F.col(b) == 1))


def risky(df: DataFrame, column: str = "Average_Risk") -> DataFrame:
    return df.filter(F.col(column) != 0)


def features_only(df: DataFrame, drop: Sequence[str] = ("Name", "cust_id")) -> DataFrame:
    return df.drop(*drop)


def order_desc(df: DataFrame, column: str, ties: Sequence[str] = ()) -> DataFrame:
    """Sorted by a column, largest first; ties in the order of the tie columns."""
    return df.orderBy(F.desc(column), *ties)


def top_k(df: DataFrame, column: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    """The k largest; the plan keeps k rows per task and merges them."""
    return order_desc(df, column, ties).limit(k)


def present(df: DataFrame) -> DataFrame:
    """Display form of a customer: capitals and Yes/No."""
    title = {c: title_case(F.col(c)) for c in ("Name", "Gender", "Occupation") if c in df.columns}
    flags = {c: yes_no(F.col(c)) for c in ("label", "OpenSanc_query") if c in df.columns}
    return df.withColumns({**title, **flags})


def with_tier(df: DataFrame, probability: Column) -> DataFrame:
    """Add the percentage and the risk tier of a probability."""
    return df.withColumns({"risk_percent": risk_percent(probability), "risk_tier": risk_tier(probability)})
