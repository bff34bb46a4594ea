"""Reproducible sampling and train/test splits.

Membership is a hash of the row key, so it does not depend on partitioning,
file order or retries (unlike ``randomSplit``/``sample`` on a re-read).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimspark.operators.joins import join_on_keys, sized
from claimspark.operators.scan import ordered_scan

BUCKETS = 10_000


def seeded_hash(key: str, seed: int = 42):
    """md5 of key and seed (null key: empty), the same in any engine."""
    return F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))


def hash_bucket(key: str, seed: int = 42):
    """Stable bucket in [0, BUCKETS) from the key and a seed."""
    return F.conv(F.substring(seeded_hash(key, seed), 1, 13), 16, 10).cast("bigint") % F.lit(BUCKETS)


def hash_sample(df: DataFrame, fraction: float, seed: int = 42, key: str = "claim_id") -> DataFrame:
    """Bernoulli-style sample of about ``fraction`` of the rows (sampling operator)."""
    return df.where(hash_bucket(key, seed) < F.lit(int(round(fraction * BUCKETS))))


def train_test_split(df: DataFrame, train_fraction: float = 0.8, seed: int = 42,
                     key: str = "claim_id") -> tuple[DataFrame, DataFrame]:
    cut = F.lit(int(round(train_fraction * BUCKETS)))
    b = hash_bucket(key, seed)
    return df.where(b < cut), df.where(b >= cut)


def with_split(df: DataFrame, train_fraction: float = 0.8, seed: int = 42, key: str = "claim_id") -> DataFrame:
    cut = F.lit(int(round(train_fraction * BUCKETS)))
    return df.withColumn("split", F.when(hash_bucket(key, seed) < cut, "train").otherwise("test"))


def stratified_split(df: DataFrame, label: str, train_fraction: float = 0.8, seed: int = 42,
                     key: str = "claim_id") -> DataFrame:
    """Exactly floor-rounded ``train_fraction`` of each label class to train.

    The first rows of a class by (hash, key) are its training rows. Rows are counted by class
    and beginning of the hash; these counts decide all rows but those with the
    beginning that the cut falls into. Only these (one of 65,536, or what shares a hash) are ranked,
    with the distributed scan; the others stay where they are.
    """
    h = df.withColumn("_h", seeded_hash(key, seed)).withColumn("_b", F.substring("_h", 1, 4))
    counts = h.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    own = Window.partitionBy(label)
    upto = F.sum("_n").over(own.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cut = F.round(F.sum("_n").over(own).cast("double") * F.lit(train_fraction))
    counts = counts.select(label, "_b", cut.alias("_cut"), (upto - F.col("_n")).alias("_before"), upto.alias("_upto"))
    # a class without training rows has no such beginning
    edges = sized(counts.where((F.col("_before") < F.col("_cut")) & (F.col("_upto") >= F.col("_cut")))
                  .select(label, F.col("_b").alias("_edge"), (F.col("_cut") - F.col("_before")).alias("_rest")))
    h = join_on_keys(h, edges, [label])
    at_edge = F.coalesce(F.col("_b") == F.col("_edge"), F.lit(False))
    sure = h.where(~at_edge).withColumn("split", F.when(F.col("_b") < F.col("_edge"), "train").otherwise("test"))
    ranked = ordered_scan(h.where(at_edge), [label], [("_h", True), (key, True)], row_number="_rk")
    ranked = ranked.withColumn("split", F.when(F.col("_rk") <= F.col("_rest"), "train").otherwise("test"))
    return sure.select(*df.columns, "split").unionByName(ranked.select(*df.columns, "split"))


def split_balance(df: DataFrame, label: str, split_col: str = "split") -> DataFrame:
    """Rows and positive rate per split."""
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.try_divide(F.sum(label).cast("double"), F.count(label).cast("double")).alias("positive_rate"),
    )


def hash_sample_n(df: DataFrame, n: int, seed: int = 42, key: str = "claim_id") -> DataFrame:
    """Exactly min(n, rows) rows without replacement: the n smallest seeded
    hashes (a top-k, evaluated as per-partition top-n then a merge)."""
    return (df.withColumn("_h", seeded_hash(key, seed))
            .orderBy("_h", key).limit(n).drop("_h"))
