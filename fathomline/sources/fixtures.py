"""The bank tables and news tables, derived from the TPC-H-like test tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COUNTRY_CODES = "AUCACNGEINMXRUSAUKUSZZ"

# Lookups that select a few of the derived occupations and message words.
OCCUPATIONS = {
    "wildlife": ["BUILDING 0", "BUILDING 1", "BUILDING 2"],
    "trafficking": ["MACHINERY 0", "MACHINERY 1", "MACHINERY 2", "MACHINERY 3", "MACHINERY 4"],
    "transportation": [f"AUTOMOBILE {i}" for i in range(10)],
    "media": ["FURNITURE 1"],
    "law": ["HOUSEHOLD 9"],
}
WORDS = {
    "wildlife": ["ring", "rod"],
    "transportation": ["gear", "plate"],
    "law": ["anvil"],
    "trafficking": ["widget", "gizmo"],
    "accomodation": ["bolt"],
}
FUZZY_CHOICES = ["BUILDING 0", "BUILDNG 12", "MACHINERY X", "AUTOMOBIL", "HOUSE", "FURNITURE 3"]


_SCHEMAS: dict[str, StructType] = {}


def customer_code(key: str) -> str:
    return f"concat('CUST', lpad(string({key}), 8, '0'))"


def _party(key: str) -> str:
    return f"case when {key} >= n then concat('EXTERNAL', lpad(string({key}), 6, '0')) else {customer_code(key)} end"


def _country(key: str, side: str) -> str:
    return f"nullif(substring('{COUNTRY_CODES}', int(2 * ({key} % 12) + 1), 2), '') as country_{side}"


_PARTIES = (
    f"{_party('s')} as id_sender",
    f"{_party('r')} as id_receiver",
    "concat('NAME ', string(s % 1000)) as name_sender",
    "concat('NAME ', string(r % 1000)) as name_receiver",
)


@dataclass
class Bank:
    """Views of one folder of test tables."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        """A test table. Its schema is read from the file once per process, not once per use."""
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    @cached_property
    def kyc_with_open_sanctions(self) -> DataFrame:
        return self.table("customer").selectExpr(
            f"{customer_code('c_custkey')} as cust_id",
            "concat(case when c_custkey % 7 = 0 then 'DR.' when c_custkey % 11 = 0 then 'MRS. ' else '' end,"
            " 'NAME ', string(c_custkey % 1000)) as Name",
            "case when c_custkey % 20 = 0 then 'other' when c_custkey % 2 = 0 then 'male' else 'female' end as Gender",
            "concat(c_mktsegment, ' ', string(c_nationkey % 10)) as Occupation",
            "int(case when c_custkey % 97 = 0 then null else 18 + (c_custkey * 7) % 75 end) as Age",
            "int((c_custkey * 5) % 49) as Tenure",
            "int(c_acctbal < 0) as label",
            "int(c_custkey % 23 = 0) as OpenSanc_query",
        )

    @cached_property
    def kyc(self) -> DataFrame:
        return self.kyc_with_open_sanctions.drop("OpenSanc_query")

    @cached_property
    def _transfers(self) -> DataFrame:
        """Orders read as transfers; receivers beyond the last customer are external parties."""
        customers = self.table("customer").agg(F.count(F.lit(1)).alias("n")).scalar()
        keyed = self.table("orders").select("*", customers.alias("n"))
        return keyed.selectExpr(
            "o_orderkey as k",
            "o_orderstatus as status",
            "o_totalprice as value",
            "o_orderpriority as priority",
            "o_custkey as s",
            "(o_orderkey * 7919 + 13) % (n + floor(n / 10)) as r",
            "n",
        )

    @cached_property
    def wire(self) -> DataFrame:
        return self._transfers.filter("status = 'F'").selectExpr(
            "concat('W', string(k)) as wire_trxn_id", *_PARTIES, "value as wire_value", _country("s", "sender"), _country("r", "receiver")
        )

    @cached_property
    def emt(self) -> DataFrame:
        part = self.table("part").selectExpr("p_partkey", "concat(p_name, '! ', upper(p_type)) as text")
        parts = self.table("part").agg(F.count(F.lit(1)).alias("n")).scalar()
        sent = self._transfers.filter("status = 'O'").withColumn("pk", F.col("k") % parts)
        return sent.join(part, F.col("pk") == F.col("p_partkey")).selectExpr(
            "concat('E', string(k)) as emt_trxn_id",
            *_PARTIES,
            "case when k % 5 <> 0 then text end as emt_message",
            "value as emt_value",
        )

    @cached_property
    def cash(self) -> DataFrame:
        return self._transfers.filter("status = 'P'").selectExpr(
            "concat('C', string(k)) as cash_trxn_id",
            f"{_party('s')} as cust_id",
            "value as amount",
            "case when priority < '3' then 'deposit' else 'withdrawal' end as type",
        )

    @cached_property
    def seeds(self) -> DataFrame:
        return self.table("customer").filter("c_custkey % 50 = 0").selectExpr(f"{customer_code('c_custkey')} as id")

    @cached_property
    def risk_ids(self) -> DataFrame:
        return self.kyc.filter(F.col("label") == 1).select(F.col("cust_id").alias("id"))

    @cached_property
    def sanctioned_names(self) -> DataFrame:
        return self.kyc_with_open_sanctions.filter(F.col("OpenSanc_query") == 1).select(F.col("Name").alias("name"))

    @cached_property
    def suspects(self) -> DataFrame:
        """Every 50th customer; some are listed twice."""
        listed = self.table("customer").filter("c_custkey % 50 = 0")
        first = listed.selectExpr(
            f"{customer_code('c_custkey')} as id", "case when c_custkey % 100 = 0 then 'seller' else 'buyer' end as Type"
        )
        again = listed.filter("c_custkey % 200 = 0").selectExpr(f"{customer_code('c_custkey')} as id", "'buyer' as Type")
        return first.unionByName(again)

    @cached_property
    def articles(self) -> DataFrame:
        """Documents as news articles."""
        return self.table("documents").select(
            F.concat(F.lit("https://news.example/"), F.col("doc_id").cast("string")).alias("Link"),
            F.substring_index("text", "\n", 1).alias("Title"),
            F.col("text").alias("Text"),
        )

    @cached_property
    def customer_news(self) -> DataFrame:
        """Articles, every third with a closing line on one or two customers."""
        customers = self.table("customer").agg(F.count(F.lit(1)).alias("n")).scalar()
        who = self.kyc.select(F.col("cust_id").alias("_id"), F.col("Name").alias("_name"))
        docs = self.table("documents").select("doc_id", "text").withColumn("n", customers)
        named = docs.filter("doc_id % 3 = 0").withColumn("_who", F.explode(F.expr("array(doc_id % n, (doc_id * 31 + 7) % n)")))
        named = named.select("doc_id", F.expr(customer_code("_who")).alias("_id")).join(who, "_id")
        lines = named.groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_set(F.lower("_name"))), ", and (").alias("line"))
        told = docs.join(lines, "doc_id", "left")
        return told.select(
            F.concat(F.lit("https://news.example/"), F.col("doc_id").cast("string")).alias("Link"),
            F.when(F.col("line").isNotNull(), F.concat(F.coalesce("text", F.lit("")), F.lit("\nPolice named: "), "line", F.lit(".")))
            .otherwise(F.col("text")).alias("Text"),
        )
