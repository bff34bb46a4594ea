"""Report operators: FIXTURES goldens and DataFrame == SQL equality."""

import pytest
from pyspark.sql import functions as F

from claimspark.functions import age_bucket
from claimspark.operators import reports
from claimspark.plans.sql import compute_aggregations_sql
from claimspark.schemas import AGE_BUCKET_TOP, AGE_BUCKETS
from fixtures import ROWS, claims_df


def test_denial_by_payer_golden(spark):
    got = {r["payer_type"]: (r["total_claims"], r["total_denials"], r["denial_rate"], r["avg_claim_amount"], r["denial_rank"])
           for r in reports.denial_by_payer(claims_df(spark)).collect()}
    assert got == {"Commercial": (2, 1, 0.5, 46.875, 1), "Medicaid": (4, 2, 0.5, 344.25, 1),
                   "Medicare": (4, 2, 0.5, 814.75, 1), "Self-Pay": (1, 0, 0.0, 64.0, 2)}
    # the payers' totals add up to the table
    assert sum(v[0] for v in got.values()) == len(ROWS)


def test_distinct_buckets_and_roll_up(spark):
    df = claims_df(spark)
    buckets = {r[0] for r in df.select(age_bucket("age")).distinct().collect()}
    assert buckets == {next((b for top, b in AGE_BUCKETS if r[10] < top), AGE_BUCKET_TOP) for r in ROWS}
    total = reports.claims_per_patient(df).agg(F.sum("num_claims"), F.sum("total_claim_amount")).first()
    assert tuple(total) == (df.count(), df.agg(F.sum("claim_amount")).first()[0])


def test_claims_per_patient_golden(spark):
    got = {r["patient_id"]: (r["num_claims"], r["total_claim_amount"], r["avg_claim_amount"], r["ever_readmitted"])
           for r in reports.claims_per_patient(claims_df(spark)).collect()}
    assert got["many"] == (5, 1441.0, 288.2, 1) and got["once"] == (1, 75.5, 75.5, 0)


def test_avg_los_order(spark):
    rows = reports.avg_los_by_diagnosis(claims_df(spark)).collect()
    assert [r["diagnosis_code"] for r in rows[:3]] == ["N18.9", "E11.9", "J18.9"]
    assert rows[0]["avg_los"] == 9.0


@pytest.mark.parametrize("name,func", [
    ("claims_per_patient_sql", reports.claims_per_patient),
    ("avg_los_by_diagnosis_sql", reports.avg_los_by_diagnosis),
    ("denial_by_payer_sql", reports.denial_by_payer),
])
def test_sql_equals_dataframe(spark, name, func):
    df = claims_df(spark)
    a = sorted(map(tuple, func(df).collect()))
    b = sorted(map(tuple, compute_aggregations_sql(spark, df)[name].collect()))
    assert a == b


def test_class_balance(spark):
    r = reports.class_balance(claims_df(spark)).first()
    assert (r["negatives"], r["positives"]) == (8, 3) and r["positive_weight"] == pytest.approx(2.6667, abs=1e-4)


def test_heatmap_and_trends(spark):
    df = claims_df(spark)
    hm = reports.provider_facility_heatmap(df, min_claims=1, top=2).collect()
    assert [r["provider_id"] for r in sorted(hm, key=lambda r: r["provider_id"])] == ["east", "north"]
    assert reports.monthly_trends(df).count() == 8
