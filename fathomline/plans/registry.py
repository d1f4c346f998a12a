"""The named queries, each with the SQL that should give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.plans.oracle_views import with_views
from fathomline.sources.fixtures import Bank


@dataclass(frozen=True)
class Query:
    build: Callable[[Bank], DataFrame]
    sql: str | None
    digits: dict[str, int]

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.build(Bank(spark, folder))
        return df.withColumns({c: F.round(F.col(c), d) for c, d in self.digits.items()}) if self.digits else df


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, views: tuple[tuple[str, str], ...] = (), **digits: int):
    """Register a query. ``digits`` names the sums and ratios that are rounded on both sides."""

    def add(build: Callable[[Bank], DataFrame]) -> Callable[[Bank], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        text = sql
        if text and digits:
            rounded = ", ".join(f"round({c}, {d}) as {c}" for c, d in digits.items())
            text = f"select * replace ({rounded}) from ({text}) q"
        QUERIES[name] = Query(build, with_views(text, *views) if text else None, digits)
        return build

    return add


def load() -> dict[str, Query]:
    from fathomline.plans import bank, learning, network, news  # noqa: F401

    return QUERIES
