"""Checks of declared keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pk_violations(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Key values that occur more than once, or are missing."""
    keys = [key] if isinstance(key, str) else key
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | missing)


def fk_orphans(tx: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Values of a foreign key that the parent table lacks, with the number of rows.

    Rows are counted per value first, so a frequent value joins once.
    """
    used = tx.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return used.join(parent.select(F.col(key).alias("id")), "id", "left_anti")


@dataclass(frozen=True)
class Key:
    """Columns of a table; a foreign key also names the table and columns it refers to."""

    table: str
    columns: tuple[str, ...]
    refers_to: tuple[str, tuple[str, ...]] | None = None

    def __str__(self) -> str:
        own = f"{self.table}({', '.join(self.columns)})"
        return f"{own} -> {self.refers_to[0]}({', '.join(self.refers_to[1])})" if self.refers_to else own


def check_keys(tables: Mapping[str, DataFrame], keys: Sequence[Key]) -> DataFrame:
    """(key, kind, bad_values, bad_rows), one row per declared key, also where nothing is wrong.

    Of a primary key the values that occur more than once, and those with a missing part, are bad; of a foreign key the values that
    the other table lacks, those with a missing part refer to nothing and are good. Each table is read once: its rows are
    tagged with every key they take part in and counted per value in the task first, so a frequent value is one row per task. Values
    of one referred-to key meet once for all keys that point there. Values are compared as texts, which suits keys of one type.
    """
    targets = list(dict.fromkeys((k.table, k.columns) if not k.refers_to else k.refers_to for k in keys))
    uses: dict[str, list[tuple[int, int, tuple[str, ...]]]] = {}  # table -> (target, key or -1 for the referred-to side, columns)
    for t, (table, columns) in enumerate(targets):
        uses.setdefault(table, []).append((t, -1, columns))
    for i, k in enumerate(keys):
        if k.refers_to:
            uses.setdefault(k.table, []).append((targets.index(k.refers_to), i, k.columns))

    def tagged(table: str) -> DataFrame:
        entries = []
        for target, source, columns in uses[table]:
            parts = [F.col(f"`{c}`").cast("string") for c in columns]
            missing = F.lit(False)
            for p in parts:
                missing = missing | p.isNull()
            value = F.when(~missing, F.to_json(F.array(*parts)))
            entries.append(F.struct(F.lit(target).alias("target"), F.lit(source).alias("source"), value.alias("value")))
        rows = tables[table].select(F.explode(F.array(*entries)).alias("e")).select("e.*")
        return rows.groupBy("target", "source", "value").agg(F.count(F.lit(1)).alias("n"))

    counts = tagged(next(iter(uses)))
    for table in list(uses)[1:]:
        counts = counts.unionByName(tagged(table))
    held = F.sum(F.when(F.col("source") == -1, F.col("n"))).alias("held")
    used = [F.sum(F.when(F.col("source") == i, F.col("n"))).alias(f"used{i}") for i, k in enumerate(keys) if k.refers_to]
    values = counts.groupBy("target", "value").agg(held, *used)
    verdicts = []
    for i, k in enumerate(keys):
        target = F.col("target") == targets.index(k.refers_to or (k.table, k.columns))
        if k.refers_to:
            bad, rows = F.col("held").isNull() & F.col("value").isNotNull() & F.col(f"used{i}").isNotNull(), F.col(f"used{i}")
        else:
            bad, rows = F.col("held").isNotNull() & (F.col("value").isNull() | (F.col("held") > 1)), F.col("held")
        verdicts += [F.count(F.when(target & bad, 1)).alias(f"values{i}"), F.coalesce(F.sum(F.when(target & bad, rows)), F.lit(0)).alias(f"rows{i}")]
    lines = [
        F.struct(F.lit(str(k)).alias("key"), F.lit("foreign" if k.refers_to else "primary").alias("kind"), F.col(f"values{i}").alias("bad_values"), F.col(f"rows{i}").alias("bad_rows"))
        for i, k in enumerate(keys)
    ]
    return values.agg(*verdicts).select(F.explode(F.array(*lines)).alias("line")).select("line.*")
