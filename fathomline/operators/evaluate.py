"""Evaluation of scores against labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.operators.skew import running_totals


def _by_score(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score, with the totals of all smaller scores, each group on its own."""
    rows = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = rows.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("pos"), F.sum((F.col(label) != 1).cast("long")).alias("neg")
    )
    return running_totals(counts, "score", ["pos", "neg"], by)


def auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, of each group if any are named; ties count half, null with only one class.

    A positive beats every negative with a smaller score: the rank sum, without ranking rows.
    """
    wins = F.col("pos") * (F.col("before_neg") + F.col("neg") / F.lit(2).cast("double"))
    sums = _by_score(df, label, score, by).groupBy(*by).agg(
        F.sum(wins).alias("wins"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg")
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return sums.select(*by, F.try_divide(F.col("wins"), pairs).alias("auc"), "n_pos", "n_neg")


def roc(df: DataFrame, label: str, score: str) -> DataFrame:
    """False and true positive rate with each distinct score as the threshold."""
    placed = _by_score(df, label, score)
    rows = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    whole = rows.agg(
        F.struct(
            F.sum((F.col(label) == 1).cast("long")).alias("pos"), F.sum((F.col(label) != 1).cast("long")).alias("neg")
        ).alias("w")
    ).scalar()
    return placed.withColumn("_w", whole).select(
        F.col("score").alias("threshold"),
        F.try_divide((F.col("_w.neg") - F.col("before_neg")).cast("double"), F.col("_w.neg").cast("double")).alias("fpr"),
        F.try_divide((F.col("_w.pos") - F.col("before_pos")).cast("double"), F.col("_w.pos").cast("double")).alias("tpr"),
    )


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Cells of the confusion matrix with shares, accuracy, precision, recall and F1."""

    def cell(actual: int, guess: int):
        return F.count(F.when((F.col(label) == actual) & (F.col(predicted) == guess), 1))

    cells = df.agg(cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(0, 0).alias("tn"), cell(1, 0).alias("fn"))
    d = {c: F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn")}
    n = d["tp"] + d["fp"] + d["tn"] + d["fn"]
    precision = F.try_divide(d["tp"], d["tp"] + d["fp"])
    recall = F.try_divide(d["tp"], d["tp"] + d["fn"])
    return cells.select(
        "tp",
        "fp",
        "tn",
        "fn",
        *[F.try_divide(v, n).alias(f"{c}_share") for c, v in d.items()],
        F.try_divide(d["tp"] + d["tn"], n).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        F.try_divide(2 * precision * recall, precision + recall).alias("f1"),
    )
