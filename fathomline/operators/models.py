"""Training, tuning and use of classifiers with Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import product

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomline.functions.scalar import risk_percent, risk_tier
from fathomline.operators import evaluate, sampling
from fathomline.operators.skew import hash_rank
from fathomline.operators.stats import five_num, welch_groups
from fathomline.session import cut_lineage, scratch_path

LABEL = "label"
MAX_BINS = 512  # at least the number of occupations

# Grids of the tuning runs under the names of Spark's parameters.
FOREST_GRID = {
    "numTrees": [50, 100, 200],
    "featureSubsetStrategy": ["auto", "sqrt"],
    "maxDepth": [5, 10],
}
BOOSTING_GRID = {"maxIter": [50, 100, 200], "stepSize": [0.01, 0.1, 0.2], "maxDepth": [5, 10]}


def split_columns(df: DataFrame, drop: Sequence[str] = ("Name", "cust_id", LABEL, "fold", "part")) -> tuple[list[str], list[str]]:
    """Text columns and number columns of a customer table."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in drop]
    number = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in drop]
    return text, number


def encoder(df: DataFrame, one_hot: bool = False) -> list:
    """Pipeline stages from a customer table to one feature vector."""
    text, number = split_columns(df)
    stages: list = []
    inputs = list(number)
    if text:
        codes = [f"_{c}_code" for c in text]
        stages.append(StringIndexer(inputCols=text, outputCols=codes, stringOrderType="alphabetAsc", handleInvalid="keep"))
        if one_hot:
            hot = [f"_{c}_hot" for c in text]
            stages.append(OneHotEncoder(inputCols=codes, outputCols=hot, dropLast=False))
            codes = hot
        inputs += codes
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error"))
    return stages


def spread_rows(df: DataFrame) -> DataFrame:
    """The rows written in as many even files as the cluster has cores: what is fitted on them runs on all cores, however small the table is on disk."""
    return cut_lineage(df.repartition(df.sparkSession.sparkContext.defaultParallelism))


def no_nulls(df: DataFrame) -> DataFrame:
    """Numbers without a value are 0, as everywhere in the feature table."""
    _, number = split_columns(df)
    return df.na.fill(0, subset=number)


def tree(**params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(**{"labelCol": LABEL, "maxBins": MAX_BINS, "seed": 0, **params})


def forest(**params) -> RandomForestClassifier:
    return RandomForestClassifier(**{"labelCol": LABEL, "maxBins": MAX_BINS, "seed": 0, "numTrees": 50, **params})


def boosting(**params) -> GBTClassifier:
    return GBTClassifier(**{"labelCol": LABEL, "maxBins": MAX_BINS, "seed": 0, "maxIter": 50, **params})


def logistic(**params) -> LogisticRegression:
    return LogisticRegression(**{"labelCol": LABEL, "maxIter": 50, "regParam": 0.01, **params})


def balance_weights(df: DataFrame, column: str = "class_weight") -> DataFrame:
    """Weights that make both classes count the same, for data that is not resampled."""
    shares = df.groupBy(F.col(LABEL).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    weighted = df.join(shares, F.col(LABEL) == F.col("_label")).withColumn(column, total / (2.0 * F.col("_n")))
    return weighted.drop("_label", "_n")


def fit(df: DataFrame, estimator: Estimator, one_hot: bool = False) -> PipelineModel:
    """Encoders and classifier as one model."""
    filled = no_nulls(df)
    return Pipeline(stages=[*encoder(filled, one_hot), estimator]).fit(filled)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add the probability of label 1 and the class at threshold 0.5."""
    scored = model.transform(no_nulls(df))
    p = vector_to_array(F.col("probability"))[1]
    kept = [c for c in df.columns if c not in ("score", "predicted")]
    return scored.withColumn("score", p).select(*kept, "score", (F.col("score") > 0.5).cast("int").alias("predicted"))


def auc_of(scored: DataFrame) -> float:
    """One number for the driver."""
    value = evaluate.auc(scored, LABEL, "score").first()["auc"]
    return float("nan") if value is None else value


def _evaluator(metric: str):
    if metric == "accuracy":
        return MulticlassClassificationEvaluator(labelCol=LABEL, metricName="accuracy")
    # A tree's raw prediction is the class counts of a leaf, which do not rank across leaves.
    return BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="probability", metricName="areaUnderROC", numBins=0)


def grid_points(estimator: Estimator, grid: Mapping[str, Sequence]) -> list[dict]:
    """All combinations, in the order of the grid."""
    names = list(grid)
    return [{estimator.getParam(n): v for n, v in zip(names, values)} for values in product(*grid.values())]


def grid_search(
    df: DataFrame,
    estimator: Estimator,
    grid: Mapping[str, Sequence],
    k: int = 3,
    metric: str = "auc",
    one_hot: bool = False,
    id_col: str = "cust_id",
    parallelism: int = 4,
) -> tuple[PipelineModel, DataFrame]:
    """Best model over the grid by the mean metric of k stratified folds, and the table of means.

    The first of equally good points wins. Folds come from a hash, so every point sees the same ones.
    """
    folds = spread_rows(no_nulls(sampling.kfold(df, LABEL, k, id_col)))
    stages = Pipeline(stages=encoder(folds, one_hot)).fit(folds)
    points = grid_points(estimator, grid)
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=points,
        evaluator=_evaluator(metric),
        numFolds=k,
        foldCol="fold",
        parallelism=parallelism,
        seed=0,
    ).fit(stages.transform(folds))
    best = PipelineModel(stages=[*stages.stages, search.bestModel])
    rows = [(i, str({p.name: v for p, v in point.items()}), float(m)) for i, (point, m) in enumerate(zip(points, search.avgMetrics))]
    return best, df.sparkSession.createDataFrame(rows, "point int, params string, metric double")


def nested_cv(
    df: DataFrame,
    estimator: Estimator,
    grid: Mapping[str, Sequence],
    outer: int = 3,
    inner: int = 2,
    one_hot: bool = False,
    balance: Callable[[DataFrame], DataFrame] | None = None,
    id_col: str = "cust_id",
    setting: str = "model",
) -> DataFrame:
    """AUC per outer fold: tuned on the other folds, tested on the one left out. The loop is over folds, not rows."""
    folds = spread_rows(sampling.kfold(df, LABEL, outer, id_col).withColumnRenamed("fold", "outer_fold"))
    results = []
    for i in range(outer):
        dev = folds.filter(F.col("outer_fold") != i).drop("outer_fold")
        test = folds.filter(F.col("outer_fold") == i).drop("outer_fold")
        dev = balance(dev) if balance else dev
        model, _ = grid_search(dev, estimator, grid, inner, one_hot=one_hot, id_col=id_col)
        results.append((setting, i, auc_of(score(model, test))))
    return df.sparkSession.createDataFrame(results, "setting string, fold int, auc double")


def compare(first: DataFrame, second: DataFrame) -> DataFrame:
    """Five-number summaries of two settings' results with Welch's test between them."""
    both = first.unionByName(second)
    names = [r["setting"] for r in both.select("setting").distinct().orderBy("setting").collect()]
    test = welch_groups(both, "auc", "setting", names[0], names[1]).select(F.struct("t", "df", "p").alias("w"))
    return five_num(both, "auc", ["setting"]).withColumn("_w", test.scalar()).select("*", "_w.t", "_w.df", "_w.p").drop("_w")


def best_of(df: DataFrame, estimators: Mapping[str, tuple[Estimator, Mapping[str, Sequence]]], k: int = 3) -> DataFrame:
    """Best point of each estimator family, best family first."""
    tables = []
    for name, (estimator, grid) in estimators.items():
        _, table = grid_search(df, estimator, grid, k)
        top = table.orderBy(F.desc("metric"), "point").limit(1)
        tables.append(top.select(F.lit(name).alias("family"), "params", "metric"))
    whole = tables[0]
    for t in tables[1:]:
        whole = whole.unionByName(t)
    return whole.orderBy(F.desc("metric"), "family")


def size_curve(
    train: DataFrame, test: DataFrame, fractions: Sequence[float], estimator: Estimator, id_col: str = "cust_id"
) -> DataFrame:
    """Training size and test AUC for growing shares of the training set."""
    sets = cut_lineage(sampling.fraction_sets(train, fractions, LABEL, id_col))
    rows = []
    for f in fractions:
        part = sets.filter(F.col("fraction") == F.lit(float(f))).drop("fraction")
        rows.append((float(f), part.count(), auc_of(score(fit(part, estimator), test))))
    return train.sparkSession.createDataFrame(rows, "fraction double, n long, auc double")


def importances(model: PipelineModel, df: DataFrame, one_hot: bool = False) -> DataFrame:
    """Split importance of each input, summed over the categories of a one-hot column."""
    text, number = split_columns(df)
    values = model.stages[-1].featureImportances.toArray()
    attrs = model.transform(no_nulls(df).limit(1)).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    owner = {f"_{c}_code": c for c in text} | {f"_{c}_hot": c for c in text}
    sums: dict[str, float] = {c: 0.0 for c in [*text, *number]}
    for i, v in enumerate(values):
        name = names[i]
        source = next((c for prefix, c in owner.items() if name.startswith(prefix)), name)
        sums[source] += float(v)
    return df.sparkSession.createDataFrame(list(sums.items()), "feature string, importance double")


def permutation_drop(model: PipelineModel, df: DataFrame, columns: Sequence[str] | None = None, id_col: str = "cust_id") -> DataFrame:
    """(feature, auc_drop): the fall of the AUC when one column is shuffled between rows, for each of the columns (default: all inputs).

    A row's other values come from one partner row, by a second hash order. Every row is scored once as it is and once per column with
    the partner's value there, in one pass; the AUCs of all copies are one grouped aggregate.
    """
    names = list(columns) if columns is not None else [c for side in split_columns(df) for c in side]
    given = hash_rank(df.select(id_col, *names), id_col, 2, [], "_from").select("_from", F.struct(*names).alias("_given"))
    mixed = hash_rank(df, id_col, 1, [], "_to").join(given, F.col("_to") == F.col("_from"))
    copies = mixed.withColumn("_copy", F.explode(F.array(F.lit(""), *[F.lit(c) for c in names])))
    swapped = [F.when(F.col("_copy") == c, F.col("_given")[c]).otherwise(F.col(c)).alias(c) if c in names else F.col(c) for c in df.columns]
    aucs = cut_lineage(evaluate.auc(score(model, copies.select(*swapped, "_copy")), LABEL, "score", ["_copy"]))
    whole = aucs.filter(F.col("_copy") == "").select("auc").scalar()
    return aucs.filter(F.col("_copy") != "").select(F.col("_copy").alias("feature"), (whole - F.col("auc")).alias("auc_drop"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def batch_score(model: PipelineModel, features: DataFrame, ids: DataFrame) -> DataFrame:
    """Scores of the listed customers."""
    return score(model, features.join(ids.select(F.col("id").alias("cust_id")), "cust_id", "left_semi"))


def score_customer(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Probability, percentage and risk tier of customers."""
    scored = score(model, df)
    return scored.withColumns({"risk_percent": risk_percent(F.col("score")), "risk_tier": risk_tier(F.col("score"))})


def retrain(
    features: DataFrame,
    path: str,
    grid: Mapping[str, Sequence],
    estimator: Estimator | None = None,
    k: int = 3,
    test_share: float = 0.1,
    metric: str = "auc",
    id_col: str = "cust_id",
) -> DataFrame:
    """Split, balance both sides, tune, test and save the model; returns its parameters and test AUC."""
    parts = cut_lineage(sampling.split(features, test_share, id_col))

    def balanced(part: str) -> DataFrame:
        return sampling.undersample(parts.filter(F.col("part") == part).drop("part"), LABEL, id_col)

    model, table = grid_search(balanced("train"), estimator or boosting(), grid, k, metric, one_hot=True)
    save_model(model, path)
    best = table.orderBy(F.desc("metric"), "point").first()
    auc = auc_of(score(model, balanced("test")))
    return features.sparkSession.createDataFrame([(best["params"], best["metric"], auc)], "params string, cv_metric double, test_auc double")


def model_path(spark, tag: str) -> str:
    return scratch_path(spark, f"model-{tag}")
