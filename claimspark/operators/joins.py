"""Join helpers: null-safe key joins and key checks.

No join is hinted: the planner and AQE broadcast a side by its measured bytes
(``spark.sql.adaptive.autoBroadcastJoinThreshold``) and split skewed keys. An aggregate
is landed first (``sized``): its bytes are known only when it has run, and by then the large
side of the join has been shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.session import materialize


def join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join where null keys match each other (like a window partition).

    The right side's key columns are dropped from the output.
    """
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def sized(table: DataFrame) -> DataFrame:
    """An aggregate, landed: the planner sees its bytes and leaves the other side of a
    join with it where it is if it is small."""
    return materialize(table, "sized")


def join_unique(left: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``join_on_keys`` (left) with a table of one row a key, without moving a left side
    that is dealt by ``key`` already: equality keeps such a dealing, a null-safe one does not. The
    null key's row is one row, broadcast."""
    cols = [c for c in table.columns if c != key]
    own = table.where(F.col(key).isNotNull()).select(F.col(key).alias("__r_key"), *[F.col(c).alias(f"__r_{c}") for c in cols])
    null = table.where(F.col(key).isNull()).limit(1).select(*[F.col(c).alias(f"__n_{c}") for c in cols])
    out = left.join(own, F.col(key) == F.col("__r_key"), "left").join(F.broadcast(null), F.col(key).isNull(), "left")
    return out.select(*left.columns, *[F.coalesce(f"__r_{c}", f"__n_{c}").alias(c) for c in cols])


def hot_keys(df: DataFrame, key: str, most: int, buckets: int = 65_536) -> list:
    """The values of ``key`` (null too) with more than ``most`` rows, at most rows / ``most``
    of them. Rows are counted by a hash of the key first, by the key itself only where
    a hash has too many."""
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets))
    heavy = [r["b"] for r in df.groupBy(bucket.alias("b")).count().where(F.col("count") > most).select("b").collect()]
    if not heavy:
        return []
    counts = df.where(bucket.isin(heavy)).groupBy(key).count()
    return [r[0] for r in counts.where(F.col("count") > most).select(key).collect()]


def among(key: str, values: list) -> Column:
    """Whether ``key`` is one of ``values`` (null may be one); never null."""
    found = F.coalesce(F.col(key).isin([v for v in values if v is not None]), F.lit(False))
    return found | F.col(key).isNull() if None in values else found


def assert_unique_key(df: DataFrame, key: str) -> None:
    """Fail when ``key`` is null or duplicated (a dimension's primary key)."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(key).alias("d"),
        F.count_if(F.col(key).isNull()).alias("nulls"),
    ).first()
    if row["nulls"] or row["n"] != row["d"]:
        raise ValueError(
            f"key {key!r} is not unique/non-null: rows={row['n']} distinct={row['d']} nulls={row['nulls']}"
        )
