"""Queries on sampling, models and clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.operators import clusters, encode, evaluate, features, models, neighbours, risk, sampling, stats
from fathomline.plans.bank import feature_view, signals
from fathomline.plans.registry import query
from fathomline.session import cut_lineage
from fathomline.sources.fixtures import Bank

SEED = 0

RANKED_SQL = f"select *, row_number() over (partition by label order by md5(cust_id || ':{SEED}'), cust_id) as rk from kyc"
SAMPLE_VIEWS = (
    ("ranked", RANKED_SQL),
    ("mode", "select label from kyc group by 1 order by count(*) desc, label limit 1"),
    ("rest", "select count(*) as n from kyc where label <> (select label from mode)"),
    ("used", "select cust_id, label from ranked where label <> (select label from mode) or rk <= (select n from rest)"),
    ("folds", "select cust_id, label, cast((rk - 1) % 10 as integer) as fold from ranked"),
)

# ---- balancing and splitting -------------------------------------------------------------


def labelled(b: Bank) -> DataFrame:
    return b.kyc.select("cust_id", "label")


@query("undersample", "select * from used", SAMPLE_VIEWS)
def _(b: Bank) -> DataFrame:
    return sampling.undersample(labelled(b), "label", "cust_id", SEED)


@query(
    "undersample_with_rest",
    "select cust_id, label, case when cust_id in (select cust_id from used) then 'used' else 'unused' end as part from kyc",
    SAMPLE_VIEWS,
)
def _(b: Bank) -> DataFrame:
    return sampling.undersample_rest(labelled(b), "label", "cust_id", SEED)


@query("unused_majority", "select cust_id, label from kyc where cust_id not in (select cust_id from used)", SAMPLE_VIEWS)
def _(b: Bank) -> DataFrame:
    rows = labelled(b)
    return sampling.unused_majority(rows, sampling.undersample(rows, "label", "cust_id", SEED), "label", "cust_id")


@query(
    "oversample",
    f"""select cust_id, label, cast(0 as bigint) as draw from kyc where label = (select label from mode)
    union all select p.cust_id, p.label, d.rk from (
      select rk, cast('0x' || substr(md5(rk || ':draw:{SEED}'), 1, 12) as bigint) % (select n from rest) + 1 as pick
      from ranked where label = (select label from mode)) d
    join (select cust_id, label, row_number() over (order by md5(cust_id || ':{SEED}'), cust_id) as rk
      from kyc where label <> (select label from mode)) p on p.rk = d.pick""",
    SAMPLE_VIEWS,
)
def _(b: Bank) -> DataFrame:
    return sampling.oversample(labelled(b), "label", "cust_id", SEED)


@query(
    "train_test_split",
    f"""select cust_id, label, case when row_number() over (order by md5(cust_id || ':{SEED}'), cust_id) <= round(0.25 * count(*) over ())
      then 'test' else 'train' end as part from kyc""",
)
def _(b: Bank) -> DataFrame:
    return sampling.split(labelled(b), 0.25, "cust_id", SEED)


@query("stratified_kfold", "select * from folds", SAMPLE_VIEWS)
def _(b: Bank) -> DataFrame:
    return sampling.kfold(labelled(b), "label", 10, "cust_id", SEED)


@query(
    "monte_carlo_splits",
    """select cust_id, label, cast(seed as integer) as seed,
      case when row_number() over (partition by seed order by md5(cust_id || ':' || seed), cust_id) <= round(0.25 * count(*) over (partition by seed))
      then 'test' else 'train' end as part from kyc, range(0, 30) r(seed)""",
)
def _(b: Bank) -> DataFrame:
    return sampling.mc_splits(labelled(b), 30, 0.25, "cust_id")


@query(
    "mega_test",
    f"""select cust_id, label, fold, 'test' as part from folds where fold = 3
    union all select cust_id, label, fold, 'unused' from (
      select *, row_number() over (order by md5(cust_id || ':{SEED}'), cust_id) as r from folds where fold <> 3 and label = 0)
    where r > (select count(*) from folds where fold <> 3 and label <> 0)""",
    SAMPLE_VIEWS,
)
def _(b: Bank) -> DataFrame:
    folds = sampling.kfold(labelled(b), "label", 10, "cust_id", SEED)
    return sampling.mega_test(folds, 3, "label", "cust_id", SEED)


FRACTIONS = tuple(round(0.1 + 0.05 * i, 2) for i in range(19))


@query(
    "training_fraction_sizes",
    "select fraction, label, count(*) as n from (select r.label, f.fraction from (select *, count(*) over (partition by label) as n from ranked) r, "
    "(values " + ", ".join(f"({f}::double)" for f in FRACTIONS) + ") f(fraction) where r.rk <= round(f.fraction * r.n)) group by 1, 2",
    SAMPLE_VIEWS,
)
def _(b: Bank) -> DataFrame:
    sets = sampling.fraction_sets(labelled(b), FRACTIONS, "label", "cust_id", SEED)
    return sets.groupBy("fraction", "label").agg(F.count(F.lit(1)).alias("n"))


@query("smote")
def _(b: Bank) -> DataFrame:
    coded = encode.label_encode(encode.label_encode(b.kyc, "Gender"), "Occupation")
    return neighbours.smote(coded, "label", ["Gender", "Occupation", "Age", "Tenure"], "cust_id", 5, SEED)


# ---- models ------------------------------------------------------------------------------


def customers(b: Bank) -> DataFrame:
    """Encoded customer data without transactions, as for the first models."""
    return b.kyc.drop("Name")


def view(b: Bank) -> DataFrame:
    """The feature view, written once: every fit and every fold reads it."""
    return cut_lineage(feature_view(b).drop("Name"))


def _halves(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    parts = cut_lineage(sampling.split(df, 0.25, "cust_id", SEED))
    return parts.filter(F.col("part") == "train").drop("part"), parts.filter(F.col("part") == "test").drop("part")


def _tested(df: DataFrame, estimator, one_hot: bool = False) -> DataFrame:
    train, test = _halves(df)
    train = sampling.undersample(train, "label", "cust_id", SEED)
    return evaluate.auc(models.score(models.fit(train, estimator, one_hot), test), "label", "score")


@query("decision_tree")
def _(b: Bank) -> DataFrame:
    return _tested(customers(b), models.tree())


@query("random_forest")
def _(b: Bank) -> DataFrame:
    return _tested(customers(b), models.forest(numTrees=20))


@query("gradient_boosting")
def _(b: Bank) -> DataFrame:
    return _tested(view(b), models.boosting(maxIter=10, maxDepth=4))


@query("gradient_boosting_weighted")
def _(b: Bank) -> DataFrame:
    train, test = _halves(view(b))
    model = models.fit(models.balance_weights(train, "class_weight"), models.boosting(maxIter=5, maxDepth=4, weightCol="class_weight"))
    return evaluate.auc(models.score(model, test.withColumn("class_weight", F.lit(1.0))), "label", "score")


SMALL_GRID = {"maxDepth": [3, 5], "minInstancesPerNode": [1, 5]}


@query("grid_search_cv")
def _(b: Bank) -> DataFrame:
    return models.grid_search(customers(b), models.tree(), SMALL_GRID, 3)[1]


@query("accuracy_tuning")
def _(b: Bank) -> DataFrame:
    return models.grid_search(customers(b), models.tree(), SMALL_GRID, 3, "accuracy")[1]


def _balanced(df: DataFrame) -> DataFrame:
    return sampling.undersample(df, "label", "cust_id", SEED)


@query("nested_cv")
def _(b: Bank) -> DataFrame:
    return models.nested_cv(customers(b), models.tree(), {"maxDepth": [3, 5]}, 3, 2, balance=_balanced)


@query("model_comparison")
def _(b: Bank) -> DataFrame:
    whole = models.nested_cv(customers(b), models.tree(), {"maxDepth": [4]}, 3, 2, setting="whole")
    balanced = models.nested_cv(customers(b), models.tree(), {"maxDepth": [4]}, 3, 2, balance=_balanced, setting="balanced")
    return models.compare(whole, balanced)


@query("model_comparison_encoding")
def _(b: Bank) -> DataFrame:
    """Codes against one column per category."""
    coded = models.nested_cv(customers(b), models.tree(), {"maxDepth": [4]}, 3, 2, balance=_balanced, setting="label")
    hot = models.nested_cv(customers(b), models.tree(), {"maxDepth": [4]}, 3, 2, one_hot=True, balance=_balanced, setting="one hot")
    return models.compare(coded, hot)


@query("model_comparison_features")
def _(b: Bank) -> DataFrame:
    """Customer data alone against the features of transactions."""
    plain = models.nested_cv(customers(b), models.tree(), {"maxDepth": [4]}, 3, 2, balance=_balanced, setting="customers")
    built = models.nested_cv(view(b), models.tree(), {"maxDepth": [4]}, 3, 2, balance=_balanced, setting="features")
    return models.compare(plain, built)


@query("best_of_family")
def _(b: Bank) -> DataFrame:
    families = {
        "tree": (models.tree(), {"maxDepth": [3, 5]}),
        "forest": (models.forest(numTrees=10), {"maxDepth": [5]}),
        "logistic": (models.logistic(), {"regParam": [0.01]}),
    }
    return models.best_of(customers(b), families, 3)


@query("training_fraction_curve")
def _(b: Bank) -> DataFrame:
    train, test = _halves(customers(b))
    return models.size_curve(_balanced(train), test, FRACTIONS, models.tree())


@query("feature_importance")
def _(b: Bank) -> DataFrame:
    train, test = _halves(view(b))
    model = models.fit(train, models.tree())
    drops = models.permutation_drop(model, test)
    return models.importances(model, train).join(drops, "feature", "left")


@query("model_save_load", "select cust_id, 0.0::double as change from kyc")
def _(b: Bank) -> DataFrame:
    rows = customers(b)
    path = models.model_path(b.spark, "tree")
    model = models.fit(rows, models.tree(maxDepth=4))
    models.save_model(model, path)
    before = models.score(model, rows).select("cust_id", F.col("score").alias("_first"))
    after = models.score(models.load_model(path), rows).select("cust_id", "score")
    return before.join(after, "cust_id").select("cust_id", (F.col("score") - F.col("_first")).alias("change"))


@query("batch_inference")
def _(b: Bank) -> DataFrame:
    """Listed customers that the model was not fitted on."""
    train, held_out = _halves(view(b))
    path = models.model_path(b.spark, "forest")
    models.save_model(models.fit(train, models.forest(numTrees=10)), path)
    listed = b.seeds.unionByName(b.risk_ids).distinct()
    return models.batch_score(models.load_model(path), held_out, listed).select("cust_id", "label", "score", "predicted")


@query("continuous_training")
def _(b: Bank) -> DataFrame:
    path = models.model_path(b.spark, "retrained")
    return models.retrain(view(b), path, {"maxDepth": [3, 4]}, models.boosting(maxIter=5), 2)


@query("score_customer")
def _(b: Bank) -> DataFrame:
    train, held_out = _halves(customers(b))
    model = models.fit(_balanced(train), models.forest(numTrees=10))
    return models.score_customer(model, held_out).select("cust_id", "score", "risk_percent", "risk_tier")


# ---- clusters ----------------------------------------------------------------------------


@query("reduce_2d")
def _(b: Bank) -> DataFrame:
    return encode.reduce_2d(view(b), clusters.TRANSACTION_COLUMNS).select("cust_id", "dr1", "dr2")


def _points(b: Bank) -> DataFrame:
    reduced = encode.reduce_2d(view(b), clusters.CASH_COLUMNS)
    flagged = reduced.join(b.kyc_with_open_sanctions.select("cust_id", "OpenSanc_query"), "cust_id")
    return cut_lineage(flagged.select("cust_id", "dr1", "dr2", "OpenSanc_query", "label", *features.BASIC))


INPUTS = ("dr1", "dr2", "OpenSanc_query", "label")


@query("kmeans_elbow")
def _(b: Bank) -> DataFrame:
    return clusters.elbow(_points(b), INPUTS)


@query("kmeans_assign")
def _(b: Bank) -> DataFrame:
    return clusters.kmeans(_points(b), INPUTS, 12).select("cust_id", "Clusters")


def cash_flags(b: Bank) -> DataFrame:
    """Customers with their cluster of cash behaviour and whether it is cluster 0; written once, for several uses."""
    return cut_lineage(clusters.cluster_flag(_points(b), INPUTS, 12).select("cust_id", "Clusters", "criminal_cash", *INPUTS))


@query("criminal_cash")
def _(b: Bank) -> DataFrame:
    return cash_flags(b).select("cust_id", "Clusters", "criminal_cash")


@query("criminal_cash_shares")
def _(b: Bank) -> DataFrame:
    return clusters.cluster_shares(cash_flags(b), INPUTS)


@query("criminal_cash_ratio")
def _(b: Bank) -> DataFrame:
    return stats.rate_ratio(signals(b, cash_flags(b)), "criminal_cash", "Label_Filtered_network")


@query("risk_weights_by_cluster")
def _(b: Bank) -> DataFrame:
    return risk.risk_weights(signals(b, cash_flags(b)))


@query("risk_score_by_cluster")
def _(b: Bank) -> DataFrame:
    rows = cut_lineage(signals(b, cash_flags(b)))
    return risk.risk_score(rows, risk.risk_weights(rows))
