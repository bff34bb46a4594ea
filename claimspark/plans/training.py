"""The training job: prepare -> split -> fit preprocessing -> LR / RF(CV) /
GBT -> evaluate -> importances -> save."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from claimspark.operators import models as M
from claimspark.operators.features import complete_rows, incomplete_rows, model_inputs
from claimspark.operators.sampling import with_split
from claimspark.schemas import LABEL
from claimspark.session import LANDING_CODEC, shared_path


#: Rows of a training partition. The number of partitions follows from the table
#: alone, so a model does not hang on the cluster; it is stored with the results.
TRAIN_ROWS = 32_768


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    preprocessing: PipelineModel
    ptrain: DataFrame
    ptest: DataFrame
    names: list[str]
    incomplete: DataFrame
    train_partitions: int
    ratio: float
    models: dict = field(default_factory=dict)


def prepare(features: DataFrame, train_fraction: float = 0.8, seed: int = 42,
            landing: str | None = None, train_rows: int = TRAIN_ROWS) -> Prepared:
    """Fill and hash-split the feature table; land it as Parquet in the shared
    folder (cuts lineage; survives executor loss); split off the rows that
    cannot be encoded; weight the classes from the landed labels; fit the
    preprocessing on the training split only."""
    spark = features.sparkSession
    landing = landing or shared_path(spark, "model-inputs")
    with_split(model_inputs(features), train_fraction, seed) \
        .write.mode("overwrite").option("compression", LANDING_CODEC).partitionBy("split").parquet(landing)
    landed = spark.read.parquet(landing)
    complete = complete_rows(landed)
    train_partitions = max(1, -(-complete.count() // train_rows))
    ratio = M.class_ratio(complete)
    df = M.add_class_weights(complete, ratio=ratio)
    # By key, in order and in a number that the cluster does not decide.
    train = df.where("split = 'train'").repartition(train_partitions, "claim_id").sortWithinPartitions("claim_id")
    test = df.where("split = 'test'")
    # kept for many passes: only what the models read, not yet scaled, so that the rows are dealt once for the
    # scaler and the models; test rows are encoded again from the landing
    encoder, scaler = M.fit_encoder(df.where("split = 'train'")), M.scaler()
    raw = encoder.transform(train).select("claim_id", LABEL, M.WEIGHT, "raw_features").persist(StorageLevel.MEMORY_AND_DISK)
    scaler = scaler.fit(raw)
    pre = PipelineModel([*encoder.stages, scaler])
    used = ["claim_id", LABEL, M.WEIGHT, M.FEATURES]
    ptrain = scaler.transform(raw).select(*used)
    ptest = pre.transform(test).select(*used)
    return Prepared(train, test, pre, ptrain, ptest, M.feature_names(raw, "raw_features"),
                    incomplete_rows(landed), train_partitions, ratio)


def fit(p: Prepared, kind: str, rf_grid: dict | None = None, gbt_params: dict | None = None):
    if kind in p.models:
        return p.models[kind]
    if kind == "logistic_regression":
        model = M.logistic_regression().fit(p.ptrain)
    elif kind == "random_forest":
        model = M.tune_random_forest(p.ptrain, p.names, p.ratio, rf_grid)
    elif kind == "gradient_boosted_trees":
        model = M.gradient_boosted_trees(p.ptrain, p.names, p.ratio, **(gbt_params or {}))
    else:
        raise ValueError(kind)
    p.models[kind] = model
    return model


def classifier(model):
    return model.bestModel if hasattr(model, "bestModel") else model


def importance_kind(kind: str) -> str:
    return "linear" if kind == "logistic_regression" else "tree"


def run_training(features: DataFrame, kinds=("logistic_regression", "random_forest", "gradient_boosted_trees"),
                 out_dir: str | None = None, rf_grid: dict | None = None, gbt_params: dict | None = None):
    """Train and compare models; save results and the winning pipeline (by AUC-PR)."""
    from claimspark.sources import results as R

    p = prepare(features)
    metrics, imps, params = None, None, {}
    for k in kinds:
        clf = classifier(fit(p, k, rf_grid, gbt_params))
        m = M.evaluate(clf, p.ptest, k)
        metrics = m if metrics is None else metrics.unionByName(m)
        imp = M.feature_importance(clf, p.names, importance_kind(k)).withColumn("model", F.lit(k))
        imps = imp if imps is None else imps.unionByName(imp)
        if k == "random_forest":
            params[k] = M.best_params(p.models[k])
    out_dir = out_dir or shared_path(features.sparkSession, "model-results")
    for k in kinds:
        params.setdefault(k, {}).update(train_partitions=p.train_partitions, incomplete_rows=p.incomplete.count())
    p.incomplete.write.mode("overwrite").parquet(f"{out_dir}/incomplete_rows")
    R.save_results(out_dir, metrics, params, imps)
    auc_pr = {r["model"]: r["value"] for r in metrics.where("metric = 'auc_pr'").collect()}
    winner = max(kinds, key=lambda k: (auc_pr.get(k, float("-inf")), -kinds.index(k)))
    R.save_fitted(features.sparkSession, p.preprocessing, classifier(p.models[winner]), f"{out_dir}/model")
    return p, metrics, out_dir, winner
