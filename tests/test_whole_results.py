"""Nothing goes missing: malformed lines, incomplete rows, stored results,
retried micro-batches; and what must not depend on the cluster."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from test_quality import BAD_DATE, EXTRA, GOOD, HEADER

from claimspark import session
from claimspark.operators import features as feat
from claimspark.operators import models as M
from claimspark.operators import scoring
from claimspark.operators.joins import assert_unique_key
from claimspark.operators.scan import PID, ordered_scan
from claimspark.plans import pipelines, registry, training
from claimspark.schemas import NUMERIC_FEATURES, PATIENTS_SCHEMA
from claimspark.sources import adapter, files
from claimspark.sources import results as R
from claimspark.streaming.scoring import claim_stream, start_scoring
from fixtures import ROWS, claims_df, patients_df

SF = "/root/testdata/sf0.001"


def test_ingest_counts_and_returns_bad_lines(spark, tmp_path):
    c, p = tmp_path / "c.csv", tmp_path / "p.csv"
    c.write_text("\n".join([HEADER, GOOD, BAD_DATE, EXTRA]) + "\n")
    p.write_text(",".join(PATIENTS_SCHEMA.fieldNames()) + "\nP1,50,M,AZ,PPO,1\nP2,old,F,AZ,PPO,2\n")
    got = files.ingest(spark, str(c), str(p), str(tmp_path / "out"))
    report = {r.table_name: (r.rows_read, r.rows_good, r.rows_bad) for r in got.report.collect()}
    assert report == {"claims": (3, 1, 2), "patients": (2, 1, 1)}
    assert got.claims.count() == 1 and got.claims_bad.count() == 2
    assert [r[0] for r in got.patients_bad.collect()] == ["P2,old,F,AZ,PPO,2"]
    assert files.read_csv(spark, str(p), PATIENTS_SCHEMA).count() == 2
    profile, outliers = files.quality_report(got.claims)
    assert profile.count() == 19 and outliers.count() > 0


@pytest.fixture(scope="module")
def half(spark):
    """Training inputs when half the patients are unknown."""
    claims, patients = adapter.load(spark, SF)
    table = pipelines.feature_table(claims, patients.where("CAST(patient_id AS BIGINT) % 2 = 0"))
    return training.prepare(table, train_rows=1200)


def test_incomplete_rows_are_split_off_and_counted(half):
    n = adapter.claims(half.train.sparkSession, SF).count()
    assert half.incomplete.count() > 1000
    assert half.incomplete.count() + half.ptrain.count() + half.ptest.count() == n


def test_assembler_raises_on_a_null_that_is_left(half):
    broken = half.train.limit(5).withColumn(NUMERIC_FEATURES[0], F.lit(None).cast("double"))
    with pytest.raises(Exception, match="(?i)null|failed"):
        half.preprocessing.transform(broken).collect()


def test_claims_without_inputs_are_rejected_not_lost(spark, half):
    lr = training.fit(half, "logistic_regression")
    claims = adapter.claims(spark, SF).limit(300)
    no_patient = claims.withColumn("claim_amount", F.when(F.col("length_of_stay") == 3, None).otherwise(F.col("claim_amount")))
    scored, rejected = scoring.score_claims(no_patient, PipelineModel(stages=half.preprocessing.stages), lr)
    assert scored.count() + rejected.count() == 300 and rejected.count() > 0
    assert scored.select("input_summary.*").columns == ["age", "diagnosis", "facility_type", "claim_amount", "comorbidity_count"]


def test_timeline_comes_from_past_claims(spark):
    claims = claims_df(spark)
    past, new = claims.where("admit_date < '2021-08-01'"), claims.where("admit_date >= '2021-08-01'")
    got = {r.claim_id: r for r in scoring.scoring_inputs(new, scoring.fit_history(past), past).collect()}
    one = got["many-4"]
    assert (one.claim_sequence, one.days_since_last_claim, one.prev_claim_amount, one.claim_count_90d) == (4, 91, 64.0, 1)
    assert got["top-1"].claim_sequence == 1 and got["top-1"].days_since_last_claim == -1


def test_a_batch_that_runs_again_repeats_no_row(spark, half, tmp_path):
    claims = adapter.claims(spark, SF).limit(200).cache()
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    claims.write.parquet(src)
    lr, pre = training.fit(half, "logistic_regression"), PipelineModel(stages=half.preprocessing.stages)
    for checkpoint in ("first", "again"):  # a lost checkpoint: batch 0 runs twice
        q = start_scoring(claim_stream(spark, src, claims.schema), pre, lr, scoring.fit_history(claims), out,
                          checkpoint=str(tmp_path / checkpoint), available_now=True)
        q.awaitTermination(300)
    assert spark.read.parquet(out).count() == spark.read.parquet(out).select("claim_id").distinct().count() > 0


def test_trees_do_not_depend_on_the_input_partitions(spark, half):
    grid, found = {"numTrees": [4], "maxDepth": [4], "maxBins": [16]}, []
    for n in (2, 8):
        again = half.ptrain.repartition(n)
        rf = M.tune_random_forest(again, half.names, half.ratio, grid, folds=2)
        gbt = M.gradient_boosted_trees(again, half.names, half.ratio, trees=3, depth=4)
        found.append([rf.avgMetrics, *(a.tolist() for m in (rf.bestModel, gbt) for a in (m.feature, m.cut, m.value))])
    assert found[0] == found[1]


def test_stored_results(spark, half, tmp_path):
    out = str(tmp_path / "r")
    lr = training.fit(half, "logistic_regression")
    imps = M.feature_importance(lr, half.names, "linear").withColumn("model", F.lit("lr"))
    metrics = spark.createDataFrame([("lr", "auc", 0.5)], "model string, metric string, value double")
    R.save_results(out, metrics, {"lr": {"a": 1}}, imps)
    R.append_metrics(out, metrics.withColumn("value", F.lit(0.75)))
    got = R.load_results(spark, out)
    assert got["importances"].count() == len(half.names)
    assert R.stats_summary(got, "lr", metrics).first()["model_metrics"] == {"auc": 0.75}
    assert R.load_results(spark, str(tmp_path / "none"))["metrics"].count() == 0


def test_model_results_are_those_of_both_models(spark, tmp_path, monkeypatch):
    """Metrics, parameters and importances of both models are stored, and each model is summarised."""
    rows = [(f"{r[0]}-{i}", f"{r[1]}-{i}", *r[2:]) for i in range(30) for r in ROWS]
    p = training.prepare(pipelines.feature_table(claims_df(spark, rows), patients_df(spark, rows)))
    monkeypatch.setattr(registry, "_STATE", {(spark.sparkContext.applicationId, "own"): p})
    monkeypatch.setattr(registry, "shared_path", lambda _, name: str(tmp_path / name))
    monkeypatch.setattr(M, "RF_GRID", {"numTrees": [2], "maxDepth": [3], "maxBins": [16]})
    got = {r.model: r for r in registry.QUERIES["model_results"](spark, "own").collect()}
    assert set(got) == {"logistic_regression", "random_forest"}
    assert got["logistic_regression"].best_params == {"maxIter": "100", "regParam": "0.01", "elasticNetParam": "0.1"}
    assert got["random_forest"].best_params == {"numTrees": "2", "maxDepth": "3", "maxBins": "16"}
    stored = R.load_results(spark, str(tmp_path / "model-results"))
    assert {r.model: r["count"] for r in stored["importances"].groupBy("model").count().collect()} == dict.fromkeys(got, len(p.names))
    for model, kind in (("logistic_regression", "linear"), ("random_forest", "tree")):
        want = M.feature_importance(training.classifier(p.models[model]), p.names, kind).limit(5).collect()
        assert [(f["key"], f["num"]) for f in got[model].top_features] == [(r.feature, r.importance) for r in want]
        metrics = {r.metric: r.value for r in M.evaluate(training.classifier(p.models[model]), p.ptest, model).collect()}
        assert got[model].model_metrics == metrics and len(metrics) == 6
        assert got[model].records_processed == len(rows)


def test_read_errors_are_not_empty_tables(spark, monkeypatch):
    class Broken:
        def schema(self, _):
            return self

        def json(self, _):
            raise AnalysisException("boom", errorClass="UNSUPPORTED_DATASOURCE_FOR_DIRECT_QUERY", messageParameters={"dataSourceType": "x"})

    class Session:
        read = Broken()

    with pytest.raises(AnalysisException):
        R._read(Session(), "x", "a int")


def test_duplicate_patients_raise(spark):
    patients = patients_df(spark)
    with pytest.raises(ValueError):
        pipelines.enriched_claims(claims_df(spark), patients.unionByName(patients.limit(1)))
    assert_unique_key(patients, "patient_id")


def test_vector_and_encoding_columns(spark):
    out, inputs, _ = feat.build_feature_vector(feat.complete_rows(feat.model_inputs(
        pipelines.feature_table(claims_df(spark), patients_df(spark)))))
    assert out.first()["features"].size >= len(NUMERIC_FEATURES) and len(inputs) == 24
    assert not [c for c in feat.drop_encoding_columns(out).columns if c.endswith(("_idx", "_ohe")) or c == "features"]


def test_one_range_a_task_in_the_scan(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    tagged = df.repartitionByRange(20, "k", "id").withColumn(PID, F.spark_partition_id()).repartitionById(20, PID)
    per_task = tagged.groupBy(F.spark_partition_id().alias("t")).agg(F.count_distinct(PID).alias("n")).collect()
    assert {r.n for r in per_task} == {1} and len(per_task) == 20
    got = ordered_scan(df, ["k"], [("id", True)], row_number="rn", lags={"before": "id"}, num_partitions=20)
    hot = got.where("k = 0").orderBy("id").collect()  # a third of the rows, over many tasks
    assert [r.rn for r in hot] == list(range(1, len(hot) + 1)) and [r.before for r in hot] == [None, *[r.id for r in hot[:-1]]]


def test_session_rules(spark, monkeypatch, tmp_path):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Cluster:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *_: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster())
    with session.landings_released(spark):
        path = session.materialize(spark.range(3), "short").inputFiles()[0]
    assert not __import__("os").path.exists(path.removeprefix("file://"))
