"""The distributed scan must equal Spark's single-task Window on skewed keys."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from claimspark.operators.scan import ordered_scan


def _rows(seed, n=3000):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # one hot key with ~40% of rows, a null key, and many small keys
        r = rnd.random()
        key = "hot" if r < 0.4 else (None if r < 0.45 else f"k{rnd.randint(0, 60)}")
        day = rnd.choice([None] + list(range(20)))
        val = None if rnd.random() < 0.1 else rnd.randint(-5, 50)
        rows.append((key, day, f"id{i:05d}", val, float(rnd.randint(0, 9))))
    return rows


@pytest.mark.parametrize("seed,parts", [(1, 7), (2, 16), (3, 1)])
def test_scan_matches_window(spark, seed, parts):
    df = spark.createDataFrame(_rows(seed), "k string, d int, id string, v int, x double")
    got = ordered_scan(
        df, ["k"], [("d", True), ("id", True)],
        row_number="rn", dense_rank="dr", running_sums={"cs": "v"},
        lags={"lv": "v", "ld": "d"}, num_partitions=parts, dense_on=["d"],
    )
    w = Window.partitionBy("k").orderBy(F.col("d").asc_nulls_first(), F.col("id"))
    wd = Window.partitionBy("k").orderBy(F.col("d").asc_nulls_first())
    exp = df.select(
        "*",
        F.row_number().over(w).alias("rn"),
        F.dense_rank().over(wd).alias("dr"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cs"),
        F.lag("v").over(w).alias("lv"),
        F.lag("d").over(w).alias("ld"),
    )
    a = sorted(map(tuple, got.select(*exp.columns).collect()), key=lambda r: r[2])
    b = sorted(map(tuple, exp.collect()), key=lambda r: r[2])
    assert a == b


def test_scan_global_desc(spark):
    df = spark.createDataFrame(_rows(5), "k string, d int, id string, v int, x double")
    got = ordered_scan(df, None, [("x", False), ("id", True)], row_number="rn",
                       dense_rank="dr", running_sums={"cx": "x"}, num_partitions=9,
                       dense_on=["x"])
    w = Window.orderBy(F.col("x").desc(), F.col("id"))
    exp = df.select("*", F.row_number().over(w).alias("rn"),
                    F.dense_rank().over(Window.orderBy(F.col("x").desc())).alias("dr"),
                    F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cx"))
    a = sorted(map(tuple, got.select(*exp.columns).collect()), key=lambda r: r[2])
    b = sorted(map(tuple, exp.collect()), key=lambda r: r[2])
    assert a == b
