"""Ingestion with quarantine, one-pass profiles, outliers and rule checks."""

import os
import tempfile

import pytest

from claimspark.operators import quality
from claimspark.schemas import CLAIMS_SCHEMA
from claimspark.sources import files
from fixtures import claims_df

HEADER = ",".join(CLAIMS_SCHEMA.fieldNames())
GOOD = "C1,P1,2023-01-01,2023-01-03,I10,99213,V1,Inpatient,Medicare,100.0,80.0,0,0,2,50,M,1,AZ,PPO"
BAD_DATE = "C2,P1,2023-13-45,2023-01-03,I10,99213,V1,Inpatient,Medicare,100.0,80.0,0,0,2,50,M,1,AZ,PPO"
BAD_INT = "C3,P1,2023-01-01,2023-01-03,I10,99213,V1,Inpatient,Medicare,100.0,80.0,x,0,2,50,M,1,AZ,PPO"
EXTRA = GOOD.replace("C1", "C4") + ",extra"
MISSING = "C5,P1,2023-01-01"
EMPTY_KEY = ",P1,2023-01-01,2023-01-03,I10,99213,V1,Inpatient,Medicare,100.0,80.0,0,0,2,50,M,1,AZ,PPO"


@pytest.fixture()
def csv_path():
    d = tempfile.mkdtemp(prefix="claimspark-csv-")
    p = os.path.join(d, "claims.csv")
    with open(p, "w") as f:
        f.write("\n".join([HEADER, GOOD, BAD_DATE, BAD_INT, EXTRA, MISSING, EMPTY_KEY]) + "\n")
    return p


def test_quarantine_is_independent_of_projection(spark, csv_path):
    good, bad = files.load_csv_quarantined(spark, csv_path, CLAIMS_SCHEMA)
    ids = sorted(r["claim_id"] or "" for r in good.collect())
    # bad date / bad int / extra / missing fields go to quarantine; the empty key parses
    assert ids == ["", "C1"]
    assert bad.count() == 4
    assert good.select("claim_id").count() == 2          # same answer for a 1-column projection
    rejected = quality.validate(good).where("NOT is_valid").collect()
    assert [r["failed_rules"] for r in rejected] == ["claim_id_required"]


def test_profile_single_pass(spark):
    df = claims_df(spark)
    got = {r["column_name"]: (r["total_rows"], r["null_count"]) for r in quality.profile(df).collect()}
    assert len(got) == 19 and got["claim_id"] == (11, 0)


def test_outliers_both_tails(spark):
    rows = [(float(x),) for x in [10] * 50 + [1000, -1000]]
    df = spark.createDataFrame(rows, "v double")
    r = quality.outliers(df, 3.0).first()
    assert (r["n_upper"], r["n_lower"]) == (1, 1)


def test_schema_check(spark):
    df = claims_df(spark).drop("state")
    bad = [r["column_name"] for r in quality.schema_check(df, CLAIMS_SCHEMA).collect() if not r["ok"]]
    assert bad == ["state"]


def test_parquet_roundtrip(spark, tmp_path):
    df = claims_df(spark)
    files.write_parquet(df, str(tmp_path / "pq"), ["payer_type"])
    back = spark.read.parquet(str(tmp_path / "pq")).select(*df.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
