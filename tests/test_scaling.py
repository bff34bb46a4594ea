"""What keeps shuffles and landings in proportion: one shuffle by patient, small aggregates
broadcast, hot patients apart, splits by counts of hashes, streaming state by group."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.operators import rates, sampling, timeline
from claimspark.operators.joins import among, hot_keys, join_on_keys, join_unique, sized
from claimspark.plans import pipelines, training
from claimspark.schemas import CLAIMS_SCHEMA
from claimspark.session import materialize
from claimspark.sources import files
from claimspark.streaming import timeline as stream
from fixtures import patients_df


def _claims(spark, n=1500):
    rnd, base, rows = random.Random(7), dt.date(2020, 1, 1), []
    for i in range(n):
        pid = rnd.choice(["HOT", "HOT", None, *(f"P{k}" for k in range(40))])
        day = None if rnd.random() < 0.03 else base + dt.timedelta(days=rnd.randint(0, 500))
        amount = None if rnd.random() < 0.1 else float(rnd.randint(1, 1000))
        rows.append((f"C{i:05d}", pid, day, day, "I10", "99213", f"V{i % 7}", "Inpatient", rnd.choice(["Medicare", None]), amount, amount,
                     rnd.randint(0, 1), rnd.randint(0, 1), 1, 50, "M", 1, "AZ", "PPO"))
    return materialize(spark.createDataFrame(rows, T.StructType([T.StructField(f.name, f.dataType) for f in CLAIMS_SCHEMA])), "test-claims")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_hot_patients_apart_give_the_same_timeline(spark):
    """Few, all or no patients beyond the limit, the null one too."""
    claims = _claims(spark)
    cols = ["claim_id", "days_since_last_claim", "prev_denial_flag", "prev_claim_amount", "claim_sequence", "rolling_cost_90d",
            "claim_count_90d", "patient_avg_claim", "patient_total_claims", "cost_ratio_to_patient_avg"]
    found = []
    for most in (10_000, 45, 0):
        hot = timeline.hot_patients(claims, most)
        assert len(hot) == {10_000: 0, 0: 42}.get(most, len(hot)) and (most != 45 or "HOT" in hot)
        found.append(_rows(timeline.add_rolling_claim_cost(timeline.add_lag_features(claims, hot), with_patient_totals=True, hot=hot), *cols))
    assert found[0] == found[1] == found[2]


def test_hot_keys(spark):
    df = spark.createDataFrame([(None,)] * 5 + [("a",)] * 5 + [("b",)] * 4, "k string")
    for buckets in (1, 65_536):
        assert sorted(hot_keys(df, "k", 4, buckets), key=str) == [None, "a"]
    assert df.where(among("k", [None, "a"])).count() == 10 and df.where(~among("k", ["a"])).count() == 9


def test_enriched_claims_are_shuffled_once(spark):
    claims = _claims(spark)
    patients = materialize(patients_df(spark), "test-patients")
    plan = _plan(pipelines.feature_table(claims, patients))
    assert plan.count("Exchange hashpartitioning(") + plan.count("Exchange rangepartitioning(") <= 2  # the claims and at most the patients


def test_small_aggregates_do_not_move_the_claims(spark):
    claims = _claims(spark)
    for df in (rates.add_payer_approval_rate(claims), rates.add_provider_denial_rate(claims), rates.add_rates(claims)):
        assert "hashpartitioning(" not in _plan(df)
    want = claims.groupBy("payer_type").agg((1 - F.avg("denial_flag")).alias("r")).collect()
    got = rates.add_payer_approval_rate(claims).groupBy("payer_type").agg(F.max("payer_approval_rate").alias("r")).collect()
    assert {r[0]: round(r[1], 9) for r in got} == {r[0]: round(r[1], 9) for r in want} and len(want) == 2


def test_join_unique_is_a_null_safe_join(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, v int")
    for rows in ([(None, 7.0), ("a", 8.0)], [("a", 8.0)], [(None, None)]):
        table = sized(spark.createDataFrame(rows, "k string, x double"))
        assert _rows(join_unique(left, table, "k"), "k", "v", "x") == _rows(join_on_keys(left, table, ["k"]), "k", "v", "x")


def test_stratified_split_ranks_few_rows(spark, monkeypatch):
    rows = [(f"c{i}", i % 3 if i % 7 else None) for i in range(3000)] + [("one", 9), (None, 1), (None, 1)]
    df = spark.createDataFrame(rows, "claim_id string, y int")
    own = Window.partitionBy("y")
    want = df.withColumn("n", F.count("*").over(own)).withColumn(
        "r", F.row_number().over(own.orderBy(sampling.seeded_hash("claim_id"), "claim_id")))
    ranked, scan = [], sampling.ordered_scan
    monkeypatch.setattr(sampling, "ordered_scan", lambda d, *a, **k: ranked.append(d.count()) or scan(d, *a, **k))
    for share in (0.8, 0.0, 1.0):
        got = sampling.stratified_split(df, "y", share)
        exp = want.withColumn("split", F.when(F.col("r") <= F.round(F.col("n") * F.lit(share)), "train").otherwise("test"))
        assert _rows(got, "claim_id", "y", "split") == _rows(exp, "claim_id", "y", "split")
    assert max(ranked) < 30


def test_training_keeps_what_models_read(spark):
    claims = _claims(spark).where("patient_id is not null and admit_date is not null and claim_amount is not null")
    ids = [r[0] for r in claims.select("patient_id").distinct().collect()]
    patients = spark.createDataFrame([(p, 50, "M", "AZ", "PPO", 1) for p in ids], patients_df(spark).schema)
    p = training.prepare(pipelines.feature_table(claims, patients))
    assert p.ptrain.columns == p.ptest.columns and len(p.ptrain.columns) == 4
    assert not p.ptest.is_cached and p.ptrain.count() + p.ptest.count() == claims.count()


def test_csv_files_are_compressed(spark, tmp_path):
    files.write_csv(_claims(spark).coalesce(1), str(tmp_path / "c"))
    assert [f.suffix for f in (tmp_path / "c").glob("part-*")] == [".gz"]
    assert files.read_csv(spark, str(tmp_path / "c"), CLAIMS_SCHEMA).count() == 1500


def test_streaming_state_by_group_keeps_patients_apart():
    rnd = random.Random(3)
    claims = sorted((rnd.randrange(300), f"c{i:03}", rnd.choice([None, 5]), rnd.choice([0, 1])) for i in range(200))
    patients = [rnd.choice([None, "a", "b"]) for _ in claims]
    held, got = {}, []
    for low in range(0, 300, 70):  # the claims of a day come together
        some = [i for i, c in enumerate(claims) if low <= c[0] < low + 70]
        got += stream.features_by_patient(held, [patients[i] for i in some], [claims[i] for i in some])
    for p in (None, "a", "b"):
        own = [i for i, x in enumerate(patients) if x == p]
        assert [got[i] for i in own] == stream.features(stream.Timeline(), [claims[i] for i in own])


def test_the_chain_by_patient_runs_in_tasks_of_bounded_rows(spark, monkeypatch):
    """As many partitions as the claims need, not what their compressed bytes are merged to; hot patients apart."""
    claims, patients = _claims(spark), patients_df(spark)
    cols = ["claim_id", "claim_sequence", "prev_claim_amount", "rolling_cost_90d", "patient_total_claims", "age"]
    plain = pipelines.enriched_claims(claims, patients, with_patient_totals=True)
    monkeypatch.setattr(timeline, "TASK_CLAIMS", 100)
    monkeypatch.setattr(pipelines, "hot_patients", lambda c: [])
    many = pipelines.enriched_claims(claims, patients, with_patient_totals=True)
    assert many.rdd.getNumPartitions() == 15
    monkeypatch.setattr(pipelines, "hot_patients", lambda c: ["HOT", None])
    apart = pipelines.enriched_claims(claims, patients, with_patient_totals=True)
    assert _rows(plain, *cols) == _rows(many, *cols) == _rows(apart, *cols)


def test_training_rows_are_dealt_once(spark):
    """The scaler and the models read one kept copy of the dealt rows; the encoders need no dealing."""
    from pyspark.ml.functions import vector_to_array

    claims = _claims(spark).where("patient_id is not null").withColumn("facility_type", F.when(F.col("claim_id") < "C00700", "ER").otherwise("Lab"))
    odd = F.col("patient_id").rlike("[02468]$")
    patients = claims.select("patient_id").distinct().select(
        "patient_id", F.when(odd, 30).otherwise(70).alias("age"), F.when(odd, "M").otherwise("F").alias("gender"), F.lit("AZ").alias("state"),
        F.when(odd, "PPO").otherwise("HMO").alias("insurance_type"), F.lit(1).alias("comorbidity_count"))
    p = training.prepare(pipelines.feature_table(claims, patients), train_rows=300)
    plan = _plan(p.ptrain)
    kept = next(line for line in plan.splitlines() if "InMemoryTableScan" in line)
    assert "raw_features" in kept and "scaled_features" not in kept  # the scaler was fitted on the kept rows
    again = p.preprocessing.transform(p.train)
    arrays = lambda df: {r[0]: r[1] for r in df.select("claim_id", vector_to_array("scaled_features")).collect()}
    assert arrays(p.ptrain) == arrays(again)


def test_a_landing_is_one_job(spark):
    """Its schema is given, not looked up in the files by a job of its own."""
    sc = spark.sparkContext
    frame = spark.range(50).selectExpr("id", "struct(id as a, cast(id as string) as b) as s", "cast(null as binary) as n")
    sc.setJobGroup("landing", "landing")
    try:
        landed = materialize(frame, "landing")
        assert len(sc.statusTracker().getJobIdsForGroup("landing")) == 1
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
    inferred = spark.read.parquet(landed.inputFiles()[0].rsplit("/", 1)[0])
    assert landed.schema == inferred.schema and sorted(landed.collect()) == sorted(frame.collect())
