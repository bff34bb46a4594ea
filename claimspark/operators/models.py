"""Distributed model training, tuning, evaluation and importances.

Design: the label-free preprocessing (index -> one-hot -> assemble -> scale)
is fitted once on the training split; classifiers run on the prepared vectors, so
tuning does not refit the encoders. Logistic regression is MLlib's; forests
(``forest``) and boosted trees (``boosting``) grow from one binned copy.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from claimspark.operators import boosting, forest
from claimspark.operators.features import encoding_stages
from claimspark.operators.histograms import TASK_ROWS, Ensemble, bin_edges, land_blocks, score_rows
from claimspark.schemas import LABEL

FEATURES = "scaled_features"
WEIGHT = "class_weight"

# --- Fixed values: model hyper-parameters ------------------------------------
LR_PARAMS = dict(maxIter=100, regParam=0.01, elasticNetParam=0.1)
RF_GRID = {"numTrees": [100, 150], "maxDepth": [8, 10], "maxBins": [48]}
RF_FOLDS = 3
GBT_PARAMS = dict(trees=300, depth=8, rate=0.05, subsample=0.8, features=0.8)
SEED = 42
#: Bins of a feature for boosted trees.
GBT_BINS = 64


def class_ratio(df: DataFrame, label: str = LABEL) -> float:
    """Negatives / max(positives, 1), the weight of class 1 (one aggregate)."""
    r = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    return float(r["n"] / max(r["p"], 1))


def add_class_weights(df: DataFrame, label: str = LABEL, ratio: float | None = None) -> DataFrame:
    """weight = ``class_ratio`` for label 1, else 1.0."""
    ratio = class_ratio(df, label) if ratio is None else ratio
    return df.withColumn(WEIGHT, F.when(F.col(label) == 1, F.lit(ratio)).otherwise(F.lit(1.0)))


def fit_preprocessing(train: DataFrame) -> PipelineModel:
    return Pipeline(stages=encoding_stages("raw_features", FEATURES)).fit(train)


def fit_encoder(train: DataFrame) -> PipelineModel:
    """``fit_preprocessing`` without its last stage, the ``scaler``: counts of categories,
    which do not hang on how the rows are dealt."""
    return Pipeline(stages=encoding_stages("raw_features", None)).fit(train)


def scaler():
    return encoding_stages("raw_features", FEATURES)[-1]


def feature_names(prepared: DataFrame, col: str = FEATURES) -> list[str]:
    """Slot names from the assembled vector's ML attribute metadata."""
    meta = prepared.schema[col].metadata.get("ml_attr", {})
    names = {}
    for group in meta.get("attrs", {}).values():
        for a in group:
            names[a["idx"]] = a["name"]
    size = meta.get("num_attrs", len(names))
    return [names.get(i, f"feature_{i}") for i in range(size)]


def logistic_regression(**overrides) -> LogisticRegression:
    return LogisticRegression(featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT,
                              rawPredictionCol="raw_prediction", **{**LR_PARAMS, **overrides})


def blocks_of(prepared: DataFrame, bins: int, task_rows: int) -> tuple[DataFrame, list]:
    """The binned training rows, landed, and the bins' edges. A forest's passes do the
    work of all its trees on the same rows, so their tasks hold more of these than those of boosting."""
    edges = bin_edges(prepared, FEATURES, "claim_id", bins)
    return land_blocks(prepared, FEATURES, LABEL, "claim_id", edges, task_rows), edges


def tune_random_forest(prepared_train: DataFrame, names: list[str], ratio: float, grid: dict | None = None,
                       folds: int = RF_FOLDS) -> forest.Tuned:
    """Grid search x k-fold CV on AUC-ROC; all forests grow in the same passes."""
    grid = grid or RF_GRID
    blocks, edges = blocks_of(prepared_train, max(grid["maxBins"]), 16 * TASK_ROWS)
    return forest.tune(blocks, names, edges, grid, folds, (1.0, ratio), SEED)


def gradient_boosted_trees(prepared_train: DataFrame, names: list[str], ratio: float, bins: int = GBT_BINS, **params) -> Ensemble:
    blocks, edges = blocks_of(prepared_train, bins, TASK_ROWS)
    return boosting.fit(blocks, names, edges, (1.0, ratio), boosting.Boosting(bins=bins, seed=SEED, **{**GBT_PARAMS, **params}))


def best_params(fitted) -> dict:
    """The best combination of a tuned forest's grid, or the parameters that a linear model was fitted with."""
    return dict(fitted.best) if isinstance(fitted, forest.Tuned) else {k: fitted.getOrDefault(k) for k in LR_PARAMS}


def probabilities(model, prepared: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, the raw prediction that rows are ranked by, and P(class 1)."""
    if isinstance(model, Ensemble):
        out = score_rows(prepared, model, FEATURES, keep)
        p = F.col("output") if model.kind == "forest" else F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("output")))
        return out.select(*keep, F.col("output").alias("raw_prediction"), p.alias("p"))
    p = model.transform(prepared)
    return p.select(*keep, vector_to_array("raw_prediction")[1].alias("raw_prediction"), vector_to_array("probability")[1].alias("p"))


def score(model, prepared: DataFrame) -> DataFrame:
    """Slim scored frame: key, label, raw prediction, P(readmit), hard prediction."""
    return probabilities(model, prepared, ["claim_id", LABEL]).select(
        "claim_id", F.col(LABEL).cast("double").alias(LABEL), "raw_prediction",
        (F.col("p") > 0.5).cast("double").alias("prediction"), F.col("p").alias("p_readmit"))


def evaluate(model, prepared_test: DataFrame, name: str) -> DataFrame:
    """Score once (persisted slim frame), then every metric from it.

    Output: (model, metric, value) with values rounded to 4 digits.
    """
    s = score(model, prepared_test).drop("claim_id").persist(StorageLevel.MEMORY_AND_DISK)
    raw = "raw_prediction"
    try:
        vals = {
            "auc_roc": BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol=raw,
                                                     metricName="areaUnderROC", numBins=0).evaluate(s),
            "auc_pr": BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol=raw,
                                                    metricName="areaUnderPR", numBins=0).evaluate(s),
        }
        for key, metric in [("f1_score", "f1"), ("accuracy", "accuracy"),
                            ("precision", "weightedPrecision"), ("recall", "weightedRecall")]:
            vals[key] = MulticlassClassificationEvaluator(labelCol=LABEL, predictionCol="prediction",
                                                          metricName=metric).evaluate(s)
    finally:
        s.unpersist()
    rows = [(name, k, round(float(v), 4)) for k, v in vals.items()]
    return prepared_test.sparkSession.createDataFrame(rows, "model string, metric string, value double")


def feature_importance(classifier, names: list[str], kind: str) -> DataFrame:
    """Gini importances (trees) or |coefficient| (linear), named by slot, sorted."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    if kind == "linear":
        vals = [abs(float(v)) for v in classifier.coefficients.toArray()]
    else:
        vals = [float(v) for v in classifier.importances()]
    rows = [(n, round(v, 6)) for n, v in zip(names, vals)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), F.col("feature"))


def compare_models(metrics: DataFrame) -> DataFrame:
    """metric x model table plus the winner per metric (ties: first model by name).

    Input rows are (model, metric, value): a handful of rows.
    """
    from pyspark.sql import Window

    wide = metrics.groupBy("metric").pivot("model").agg(F.first("value"))
    w = Window.partitionBy("metric").orderBy(F.col("value").desc(), F.col("model"))
    win = (metrics.withColumn("_r", F.row_number().over(w)).where("_r = 1")
           .select("metric", F.col("model").alias("winner")))
    return wide.join(win, "metric")

