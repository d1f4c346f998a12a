"""Summaries and tests."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.operators.skew import HOT_ROWS, HOT_SHARE, key_code, running_totals, spread_join
from fathomline.session import cut_lineage

QUARTILES = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}


ACCURACY = 1000  # of the sketches: a rank is off by a thousandth of the rows
SLACK = 0.004  # a bracket reaches this share of the rows below and above its mark
FEW = 1000  # groups up to this size are bracketed as a whole


def _sketches(picked: DataFrame, width: int, inner: Sequence[float]) -> DataFrame:
    """One row per group, with a number and per column: n, mean, sd, least and largest value and a bracket around each mark."""
    ends = [F.lit(min(max(q + d, 0.0), 1.0)) for q in inner for d in (-SLACK, SLACK)]
    parts = []
    for j in range(width):
        v = F.col(f"_v{j}")
        near = F.percentile_approx(v, F.array(*ends), ACCURACY) if ends else F.array().cast("array<double>")
        parts.append(
            F.struct(
                F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("sd"), F.min(v).alias("least"), F.max(v).alias("most"), near.alias("near")
            ).alias(f"c{j}")
        )
    keys = [F.col(c) for c in picked.columns if c.startswith("_g")]
    made = picked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *parts)
    return cut_lineage(made.withColumn("_group", F.monotonically_increasing_id()))


def _grouped(picked: DataFrame, brackets: DataFrame, rows: DataFrame) -> DataFrame:
    """Every row with the brackets of its group; ``rows`` (group sizes) tells the hot groups without another scan."""
    keys = [c for c in picked.columns if c.startswith("_g")]
    if not keys:
        return picked.withColumn("_b", brackets.select(F.struct("_group", "_lo", "_hi").alias("b")).scalar()).select("*", "_b.*").drop("_b")
    total = rows.agg(F.sum("_rows")).first()[0] or 0
    large = rows.filter((F.col("_rows") > HOT_ROWS) & (F.col("_rows") * HOT_SHARE > total))
    hot = [r[0] for r in large.select(key_code(keys)).collect()]  # fewer than HOT_SHARE of them
    dim = brackets.withColumnsRenamed({k: f"_of{k}" for k in keys})
    return spread_join(picked, dim, keys, [f"_of{k}" for k in keys], "inner", hot=hot, null_safe=True)


def _ranked(picked: DataFrame, sketches: DataFrame, tasks: DataFrame, width: int, inner: Sequence[float]) -> DataFrame:
    """(_group, at, lo, hi) for tasks (_group, at, least, most, n, q): the two values next to the mark, null if outside its bracket.

    One scan: of each row and task, values in the bracket are counted by value and all those below as one.
    """
    cells = range(width * len(inner))

    def side(name: str) -> Column:
        return F.array(*[F.max(F.when(F.col("at") == i, F.col(name))) for i in cells])

    arrays = tasks.groupBy("_group").agg(side("least").alias("_lo"), side("most").alias("_hi"))
    keys = [c for c in sketches.columns if c.startswith("_g") and c != "_group"]
    rows = _grouped(picked, sketches.select(*keys, "_group").join(arrays, "_group"), sketches)
    seen = []
    for i in cells:
        v = F.col(f"_v{i // len(inner)}")
        seen.append(F.when(v <= F.col("_hi")[i], F.struct(F.lit(i).alias("at"), F.when(v >= F.col("_lo")[i], v).alias("value"))))
    hits = rows.select("_group", F.explode(F.filter(F.array(*seen), lambda s: s.isNotNull())).alias("s"))
    counts = cut_lineage(hits.groupBy("_group", "s.at", "s.value").agg(F.count(F.lit(1)).alias("_n")))
    longest = counts.groupBy("_group", "at").agg(F.count(F.lit(1)).alias("_rows")).agg(F.max("_rows")).first()[0] or 0
    if longest <= HOT_ROWS:  # one task can sort the bracket; the row of those below has no value and comes first
        before = Window.partitionBy("_group", "at").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        first = F.sum("_n").over(before) - F.col("_n")
        placed = counts.withColumn("_first", first).join(tasks, ["_group", "at"])
    else:
        below = counts.filter("value is null").select("_group", "at", F.col("_n").alias("_below"))
        known = tasks.join(below, ["_group", "at"], "left").withColumn("_below", F.coalesce("_below", F.lit(0)))
        placed = running_totals(counts.filter("value is not null"), "value", ["_n"], ["_group", "at"]).join(known, ["_group", "at"])
        placed = placed.withColumn("_first", F.col("_below") + F.col("before__n"))
    first = F.col("_first")
    h = (F.col("n") - 1) * F.col("q")

    def at_index(i: Column) -> Column:
        return F.max(F.when((first <= i) & (i < first + F.col("_n")), F.col("value")))

    found = placed.groupBy("_group", "at").agg(at_index(F.floor(h)).alias("lo"), at_index(F.ceil(h)).alias("hi"))
    return tasks.select("_group", "at", "n", "q").join(found, ["_group", "at"], "left")


def summaries(df: DataFrame, columns: Sequence[str], at: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Group, ``column``, exact linearly interpolated quantiles, n, mean and population sd: a row per group and column with values.

    Two scans serve all columns and groups. The first takes sketches, which give a bracket of about a hundredth of the rows around
    each mark; the second counts the values inside the brackets and the rows below. So only a few per cent of the
    values are shuffled, no task holds a group, and a bracket that missed its mark (sketches promise no more than likely errors) is
    taken anew from the least to the largest value. Null groups are groups; null values count nowhere. Without ``by`` a
    column without values gives a row with n = 0.
    """
    inner = [q for q in at.values() if 0 < q < 1]
    names = [f"`{c}`" for c in columns]
    picked = df.select(*[F.col(f"`{c}`").alias(f"_g{i}") for i, c in enumerate(by)], *[F.col(c).cast("double").alias(f"_v{j}") for j, c in enumerate(names)])
    sketches = _sketches(picked, len(columns), inner)
    cells = []
    for j in range(len(columns)):
        c = f"c{j}"
        for m, q in enumerate(inner):
            whole = F.col(f"{c}.n") <= FEW
            least = F.when(whole, F.col(f"{c}.least")).otherwise(F.col(f"{c}.near")[2 * m])
            most = F.when(whole, F.col(f"{c}.most")).otherwise(F.col(f"{c}.near")[2 * m + 1])
            cells.append(F.struct(F.lit(j * len(inner) + m).alias("at"), least.alias("least"), most.alias("most"), F.col(f"{c}.n").alias("n"), F.lit(q).alias("q"),
                                  F.col(f"{c}.least").alias("from"), F.col(f"{c}.most").alias("to")))
    marks = None
    if cells:
        tasks = sketches.select("_group", F.explode(F.array(*cells)).alias("t")).select("_group", "t.*").filter("n > 0")
        ranked = cut_lineage(_ranked(picked, sketches, tasks, len(columns), inner))
        missed = ranked.filter("lo is null or hi is null").select("_group", "at")
        if not missed.isEmpty():
            again = tasks.join(missed, ["_group", "at"], "left_semi").withColumns({"least": F.col("from"), "most": F.col("to")})
            ranked = ranked.filter("lo is not null and hi is not null").unionByName(_ranked(picked, sketches, again, len(columns), inner))
        h = (F.col("n") - 1) * F.col("q")
        value = F.col("lo") + (F.col("hi") - F.col("lo")) * (h - F.floor(h))
        m = F.pmod(F.col("at"), F.lit(len(inner)))
        marks = ranked.groupBy("_group", F.floor(F.col("at") / len(inner)).cast("int").alias("_j")).agg(
            *[F.max(F.when(m == i, value)).alias(f"_m{i}") for i in range(len(inner))]
        )
    each = F.explode(F.array(*[F.struct(F.lit(j).alias("_j"), F.lit(c).alias("column"), F.col(f"c{j}").alias("c")) for j, c in enumerate(columns)])).alias("x")
    base = sketches.select("*", each).select("*", "x._j", "x.column", "x.c.n", "x.c.mean", "x.c.sd", "x.c.least", "x.c.most")
    out = base.join(marks, ["_group", "_j"], "left") if marks is not None else base
    if by:
        out = out.filter("n > 0")
    place = {n: F.col("least") if q <= 0 else F.col("most") if q >= 1 else F.col(f"_m{inner.index(q)}") for n, q in at.items()}
    return out.select(*[F.col(f"_g{i}").alias(c) for i, c in enumerate(by)], "column", *[e.alias(n) for n, e in place.items()], "n", "mean", "sd")


def quantiles(df: DataFrame, column: str, at: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """The group and its exact, linearly interpolated quantiles."""
    return summaries(df, [column], at, by).select(*[F.col(f"`{c}`") for c in by], *at)


def five_nums(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """min, q1, median, q3, max, n, mean and population sd of each column per group."""
    return summaries(df, columns, QUARTILES, by)


def five_num(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """The same of one column, without its name."""
    return five_nums(df, [column], by).drop("column")


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray, steps: int = 300) -> np.ndarray:
    """Continued fraction of the incomplete beta function, for whole columns at once."""
    tiny = 1e-300

    def guard(v: np.ndarray) -> np.ndarray:
        return np.where(np.abs(v) < tiny, tiny, v)

    c = np.ones_like(x)
    d = 1.0 / guard(1.0 - (a + b) * x / (a + 1.0))
    total = d.copy()
    for m in range(1, steps + 1):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1.0 / guard(1.0 + even * d)
        c = guard(1.0 + even / c)
        total = total * c * d
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 / guard(1.0 + odd * d)
        c = guard(1.0 + odd / c)
        total = total * c * d
    return total


def student_p(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p of Student's t."""
    lgamma = np.vectorize(math.lgamma, otypes=[float])
    n, tt = df.to_numpy(float), t.to_numpy(float)
    out = np.full(len(n), np.nan)
    ok = np.isfinite(n) & np.isfinite(tt) & (n > 0)
    if ok.any():
        a, b = n[ok] / 2.0, np.full(ok.sum(), 0.5)
        x = n[ok] / (n[ok] + tt[ok] ** 2)
        front = np.exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * np.log(x) + b * np.log1p(-np.minimum(x, 1 - 1e-16)))
        flip = x > (a + 1) / (a + b + 2)
        direct = front * _beta_fraction(a, b, np.where(flip, 0.5, x)) / a
        mirrored = 1.0 - front * _beta_fraction(b, a, np.where(flip, 1.0 - x, 0.5)) / b
        out[ok] = np.clip(np.where(flip, mirrored, direct), 0.0, 1.0)
    return pd.Series(out)


def welch(df: DataFrame, m1: str, m2: str, s1: str, s2: str, n1: str, n2: str, equal_var: bool = False) -> DataFrame:
    """Add t, degrees of freedom and two-sided p for two means with given sd and size."""
    a = F.col(s1) ** 2 / F.col(n1)
    b = F.col(s2) ** 2 / F.col(n2)
    if equal_var:
        free = (F.col(n1) + F.col(n2) - 2).cast("double")
        pooled = ((F.col(n1) - 1) * F.col(s1) ** 2 + (F.col(n2) - 1) * F.col(s2) ** 2) / free
        error = F.sqrt(pooled * (1 / F.col(n1) + 1 / F.col(n2)))
    else:
        free = F.try_divide((a + b) ** 2, a**2 / (F.col(n1) - 1) + b**2 / (F.col(n2) - 1))
        error = F.sqrt(a + b)
    p_value = F.pandas_udf(student_p, "double")
    return df.withColumns({"t": F.try_divide(F.col(m1) - F.col(m2), error), "df": free}).withColumn(
        "p", F.nanvl(p_value("t", "df"), F.lit(None).cast("double"))
    )


def welch_groups(df: DataFrame, value: str, group: str, a, b) -> DataFrame:
    """Welch's test of a column between two groups of rows."""

    def of(g, f):
        return f(F.when(F.col(group) == g, F.col(value)))

    row = df.agg(
        of(a, F.avg).alias("m1"),
        of(b, F.avg).alias("m2"),
        of(a, F.stddev_pop).alias("s1"),
        of(b, F.stddev_pop).alias("s2"),
        of(a, F.count).alias("n1"),
        of(b, F.count).alias("n2"),
    )
    return welch(row, "m1", "m2", "s1", "s2", "n1", "n2")


def corr_rank(df: DataFrame, label: str, columns: Sequence[str], k: int = 20) -> DataFrame:
    """Correlation of columns with the label in one pass, the k largest first."""
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(c) for c in columns])
    long = wide.unpivot([], list(columns), "feature", "correlation")
    return long.filter(F.col("correlation").isNotNull()).orderBy(F.desc("correlation"), "feature").limit(k)


def _cell(a: str, x: int, b: str, y: int) -> Column:
    return F.count(F.when((F.col(a) == x) & (F.col(b) == y), 1)).cast("double")


def odds_expr(label: str, flag: str) -> Column:
    """Odds ratio of the 2 x 2 table of two flags; null with an empty cell in the divisor."""
    up = _cell(label, 1, flag, 1) * _cell(label, 0, flag, 0)
    return F.try_divide(up, _cell(label, 1, flag, 0) * _cell(label, 0, flag, 1))


def corr_odds_expr(score: str, label: str) -> Column:
    return F.try_divide(F.lit(1.0), F.lit(1.0) - F.corr(F.col(score).cast("double"), F.col(label).cast("double")))


def rate_ratio_expr(group: str, flag: str) -> Column:
    """Mean of a flag in group 1 over its mean in group 0."""
    inside = F.avg(F.when(F.col(group) == 1, F.col(flag).cast("double")))
    return F.try_divide(inside, F.avg(F.when(F.col(group) == 0, F.col(flag).cast("double"))))


def odds_ratio(df: DataFrame, label: str, flag: str) -> DataFrame:
    return df.agg(odds_expr(label, flag).alias("odds_ratio"))


def corr_odds(df: DataFrame, score: str, label: str) -> DataFrame:
    return df.agg(corr_odds_expr(score, label).alias("corr_odds"))


def rate_ratio(df: DataFrame, group: str, flag: str) -> DataFrame:
    return df.agg(rate_ratio_expr(group, flag).alias("rate_ratio"))
