"""Hot keys: one patient holds ~40 % of the claims.

The timeline operators must give the same answers as the single-task window
and must spread the hot patient over several range partitions.
"""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from claimspark.operators import timeline
from claimspark.schemas import CLAIMS_SCHEMA


def _claims(spark, n=4000, seed=11):
    rnd = random.Random(seed)
    base = dt.date(2020, 1, 1)
    rows = []
    for i in range(n):
        pid = "HOT" if rnd.random() < 0.4 else f"P{rnd.randint(0, 200):03d}"
        d = base + dt.timedelta(days=rnd.randint(0, 700))
        amt = float(rnd.randint(1, 1000))
        rows.append((f"C{i:05d}", pid, d, d, "I10", "99213", "V1", "Inpatient", "Medicare", amt, amt,
                     rnd.randint(0, 1), 0, 1, 50, "M", 1, "AZ", "PPO"))
    return spark.createDataFrame(rows, CLAIMS_SCHEMA)


def test_hot_patient_lags_match_window(spark):
    df = _claims(spark)
    got = timeline.add_lag_features(df)
    w = Window.partitionBy("patient_id").orderBy("admit_date", "claim_id")
    exp = df.select(
        "claim_id",
        F.datediff("admit_date", F.lag("admit_date").over(w)).alias("days_since_last_claim"),
        F.lag("denial_flag").over(w).alias("prev_denial_flag"),
        F.lag("claim_amount").over(w).alias("prev_claim_amount"),
        F.row_number().over(w).alias("claim_sequence"),
    )
    cols = exp.columns
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, exp.collect()))


def test_hot_patient_rolling_matches_window(spark):
    df = _claims(spark)
    got = timeline.add_rolling_claim_cost(df)
    w = (Window.partitionBy("patient_id").orderBy(F.datediff("admit_date", F.lit("1970-01-01").cast("date")))
         .rangeBetween(-90, 0))
    exp = df.select("claim_id", F.sum("claim_amount").over(w).alias("rolling_cost_90d"),
                    F.count("claim_id").over(w).alias("claim_count_90d"))
    a = sorted(map(tuple, got.select(*exp.columns).collect()))
    assert a == sorted(map(tuple, exp.collect()))


def test_hot_patient_is_split_across_partitions(spark):
    df = _claims(spark)
    ranged = df.repartitionByRange(8, "patient_id", "admit_date", "claim_id").withColumn(
        "pid", F.spark_partition_id())
    hot = ranged.where("patient_id = 'HOT'").groupBy("pid").count().collect()
    sizes = [r["count"] for r in ranged.groupBy("pid").count().collect()]
    assert len(hot) >= 3                          # the hot key spans several tasks
    assert max(sizes) < 2.5 * (sum(sizes) / len(sizes))
