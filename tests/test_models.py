"""Training, evaluation, attribution and scoring on the smallest tables."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from claimspark.operators import explain, models as M, scoring
from claimspark.plans import pipelines, training
from claimspark.sources import adapter
from claimspark.sources import results as R

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def prepared(spark):
    return training.prepare(pipelines.feature_table(*adapter.load(spark, SF)))


def test_vector_width_and_names(prepared):
    assert len(prepared.names) == 40
    assert prepared.names[0] == "claim_amount" and prepared.names[19] == "claim_sequence"


def test_lr_and_attributions(spark, prepared):
    lr = training.fit(prepared, "logistic_regression")
    m = {r["metric"]: r["value"] for r in M.evaluate(lr, prepared.ptest, "lr").collect()}
    assert 0.5 < m["auc_roc"] <= 1.0
    phis = explain.linear_attributions(prepared.ptest, lr, prepared.names, prepared.ptrain)
    base = explain.base_value(prepared.ptrain, lr)
    one = prepared.ptest.select("claim_id").orderBy("claim_id").first()
    total = phis.where(F.col("claim_id") == one["claim_id"]).agg(F.sum("phi")).first()[0]
    scored = lr.transform(prepared.ptest).where(F.col("claim_id") == one["claim_id"])
    margin = scored.select(vector_to_array("raw_prediction")[1]).first()[0]
    assert total + base == pytest.approx(margin, abs=1e-6)


def test_small_forest_not_constant(spark, prepared):
    rf = M.tune_random_forest(prepared.ptrain, prepared.names, prepared.ratio, {"numTrees": [5], "maxDepth": [4], "maxBins": [48]}, folds=0)
    s = M.score(rf.bestModel, prepared.ptest)
    assert s.select(F.countDistinct("p_readmit")).first()[0] > 1


def test_pipeline_roundtrip_and_scoring(spark, prepared, tmp_path):
    lr = training.fit(prepared, "logistic_regression")
    path = str(tmp_path / "model")
    R.save_model(PipelineModel(stages=[*prepared.preprocessing.stages, lr]), path)
    loaded = R.load_model(path)
    claims = adapter.claims(spark, SF)
    scored, rejected = scoring.score_claims(claims, PipelineModel(stages=loaded.stages[:-1]),
                                            loaded.stages[-1], scoring.fit_history(claims))
    assert scored.count() == claims.count() and rejected.count() == 0
    tiers = {r["risk_tier"] for r in scored.select("risk_tier").distinct().collect()}
    assert tiers <= {"High", "Medium", "Low"}


def test_results_roundtrip(spark, prepared, tmp_path):
    lr = training.fit(prepared, "logistic_regression")
    metrics = M.evaluate(lr, prepared.ptest, "logistic_regression")
    imps = M.feature_importance(lr, prepared.names, "linear").withColumn("model", F.lit("logistic_regression"))
    R.save_results(str(tmp_path), metrics, {"logistic_regression": {"maxIter": 100}}, imps)
    res = R.load_results(spark, str(tmp_path))
    summary = R.stats_summary(res, "logistic_regression", prepared.train).first()
    assert summary["records_processed"] == prepared.train.count()
    assert len(summary["top_features"]) == 5 and "auc_roc" in summary["model_metrics"]


@pytest.mark.parametrize("kind", ["random_forest", "gradient_boosted_trees"])
def test_tree_shap_local_accuracy(spark, prepared, kind):
    from claimspark.operators import treeshap

    if kind == "random_forest":
        grid = {"numTrees": [4], "maxDepth": [4], "maxBins": [16]}
        model = M.tune_random_forest(prepared.ptrain, prepared.names, prepared.ratio, grid, folds=0).bestModel
    else:
        model = M.gradient_boosted_trees(prepared.ptrain, prepared.names, prepared.ratio, trees=4, depth=3)
    rows = prepared.ptest.orderBy("claim_id").limit(40)
    phis, base = treeshap.explain_trees(rows, model)
    total = {r["claim_id"]: r[1] for r in phis.groupBy("claim_id").agg(F.sum("phi")).collect()}
    out = M.probabilities(model, rows, ["claim_id"])
    for r in out.collect():
        assert base + total[r["claim_id"]] == pytest.approx(r["raw_prediction"], abs=1e-9)


@pytest.mark.parametrize("kind", ["random_forest", "gradient_boosted_trees"])
def test_a_stored_ensemble_scores_as_before(spark, prepared, tmp_path, kind):
    grid = {"numTrees": [3], "maxDepth": [4], "maxBins": [16]}
    model = training.classifier(training.fit(prepared, kind, grid, {"trees": 3, "depth": 3}))
    prepared.models.pop(kind)
    R.save_fitted(spark, prepared.preprocessing, model, str(tmp_path / "m"))
    _, again = R.load_fitted(spark, str(tmp_path / "m"))
    rows = lambda m: sorted(map(tuple, M.probabilities(m, prepared.ptest, ["claim_id"]).collect()))
    assert rows(again) == rows(model)
