"""Skew-safe ordered scans: row_number, dense_rank, lag(1) and running sums.

``Window.partitionBy(k).orderBy(o)`` moves every row of a key into one task,
so a key holding a third of the data would be processed by one task. This
operator range-partitions on ``(k, o)`` instead, which splits a hot key
across many tasks, and then repairs the values at partition boundaries:

1. ``repartitionByRange`` on the full sort key, tag rows with the range
   partition id, and hash-distribute on that id (a bounded group per id).
2. Plain window functions partitioned by ``(id, k)`` compute the scan
   locally; one sort serves every window.
3. The scanned frame is landed once as Parquet in the shared checkpoint
   folder; a JVM aggregate over it keeps one summary row per range
   partition (first key, last group's totals).
4. Offsets are derived from the summaries (one row per partition, so their
   size is bounded by the partition count) and broadcast back.

For a key to be splittable the order must end in a unique tie-breaker.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PID = "_scan_pid"


@dataclass
class ScanSpec:
    partition_by: list[str]
    order_by: list[tuple[str, bool]]          # (column, ascending)
    row_number: str | None = None
    dense_rank: str | None = None
    running_sums: dict[str, str] = field(default_factory=dict)   # out -> source
    lags: dict[str, str] = field(default_factory=dict)           # out -> source
    dense_on: list[str] | None = None        # order prefix that defines ties

    def dense_cols(self) -> list[str]:
        return list(self.dense_on) if self.dense_on else [c for c, _ in self.order_by]


def _sort_cols(spec: ScanSpec) -> list[Column]:
    cols = [F.col(c).asc_nulls_first() for c in spec.partition_by]
    for name, asc in spec.order_by:
        cols.append(F.col(name).asc_nulls_first() if asc else F.col(name).desc_nulls_last())
    return cols


def _order_cols(spec: ScanSpec) -> list[Column]:
    return _sort_cols(spec)[len(spec.partition_by):]


def _sum_type(dt: T.DataType) -> T.DataType:
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    if isinstance(dt, T.DecimalType):
        return T.DecimalType(38, dt.scale)
    return T.DoubleType()


def _null_safe_eq(left: list[Column], right: list[Column]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & a.eqNullSafe(b)
    return cond


def ordered_scan(
    df: DataFrame,
    partition_by: list[str] | None,
    order_by: list[tuple[str, bool]],
    row_number: str | None = None,
    dense_rank: str | None = None,
    running_sums: dict[str, str] | None = None,
    lags: dict[str, str] | None = None,
    num_partitions: int | None = None,
    dense_on: list[str] | None = None,
) -> DataFrame:
    """Distributed ordered scan; see module docstring.

    Semantics equal ``Window.partitionBy(*partition_by).orderBy(*order_by)``
    with ``row_number()``, ``dense_rank()``, ``lag(src, 1)`` and a running
    ``sum(src)`` over ``ROWS UNBOUNDED PRECEDING .. CURRENT ROW``.
    Ascending orders put nulls first, descending orders put them last.
    """
    spec = ScanSpec(list(partition_by or []), list(order_by), row_number, dense_rank,
                    dict(running_sums or {}), dict(lags or {}), dense_on)
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    types = {f.name: f.dataType for f in df.schema.fields}
    sum_types = {o: _sum_type(types[s]) for o, s in spec.running_sums.items()}
    keys = spec.partition_by
    orders = [c for c, _ in spec.order_by]
    dcols = spec.dense_cols()

    tagged = (
        df.repartitionByRange(n, *_sort_cols(spec))
        .withColumn(PID, F.spark_partition_id())
        .repartitionById(n, PID)  # one range a task: hashing the ids would put several into one
    )
    w_grp = Window.partitionBy(PID, *keys).orderBy(*_order_cols(spec))
    w_run = w_grp.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_part = Window.partitionBy(PID).orderBy(*_sort_cols(spec))
    need_rn = bool(spec.row_number or spec.lags)
    # a range partition's first and last rows, found without buffering it
    local_cols = {"_first": F.lag(F.lit(1)).over(w_part).isNull(), "_last": F.lead(F.lit(1)).over(w_part).isNull()}
    if need_rn:
        local_cols["_rn"] = F.row_number().over(w_grp).cast("bigint")
    if spec.dense_rank:
        local_cols["_ldense"] = F.dense_rank().over(
            Window.partitionBy(PID, *keys).orderBy(*_order_cols(spec)[:len(dcols)])).cast("bigint")
    for o, src in spec.running_sums.items():
        local_cols[o] = F.sum(F.col(src)).over(w_run).cast(sum_types[o])
    for o, src in spec.lags.items():
        local_cols[o] = F.lag(F.col(src)).over(w_grp)
    # Range bounds come from sampling and differ between executions, so the
    # locally scanned frame is written once as Parquet under the cluster's
    # shared checkpoint folder: the summary and the final join then read the
    # same partition ids (a stored column), in one compute pass, with column
    # pruning; a lost executor re-reads files instead of re-sampling.
    from claimspark.session import materialize

    local = materialize(tagged.withColumns(local_cols), "scan")

    first, last = F.col("_first"), F.col("_last")
    lag_src = list(dict.fromkeys(spec.lags.values()))
    null = F.lit(None).cast("bigint")
    aggs = [F.max(F.when(last, F.col("_rn") if need_rn else null)).alias("_last_rn"),
            F.max(F.when(last, F.col("_ldense") if spec.dense_rank else null)).alias("_last_dense")]
    for c in keys:
        aggs += [F.max(F.when(first, F.col(c))).alias("_fk_" + c), F.max(F.when(last, F.col(c))).alias("_lk_" + c)]
    for c in orders:
        aggs += [F.max(F.when(first, F.col(c))).alias("_fo_" + c), F.max(F.when(last, F.col(c))).alias("_lo_" + c)]
    for o in spec.running_sums:
        aggs.append(F.max(F.when(last, F.col(o))).alias("_ls_" + o))
    for c in lag_src:
        aggs.append(F.max(F.when(last, F.col(c))).alias("_lv_" + c))
    summary = local.where(first | last).groupBy(PID).agg(*aggs)

    # Offsets per partition: one row per partition, a bounded table.
    w_all = Window.orderBy(PID)
    s = summary
    for c in keys:
        s = s.withColumn("_plk_" + c, F.lag("_lk_" + c).over(w_all))
    for c in orders:
        s = s.withColumn("_plo_" + c, F.lag("_lo_" + c).over(w_all))
    s = s.withColumn("_has_prev", F.lag(F.lit(1)).over(w_all).isNotNull())
    joins_prev = F.col("_has_prev") & _null_safe_eq(
        [F.col("_fk_" + c) for c in keys], [F.col("_plk_" + c) for c in keys]
    )
    whole = _null_safe_eq([F.col("_fk_" + c) for c in keys], [F.col("_lk_" + c) for c in keys])
    straddle = joins_prev & whole & _null_safe_eq(
        [F.col("_fo_" + c) for c in dcols], [F.col("_plo_" + c) for c in dcols]
    )
    s = s.withColumn(
        "_d_contrib", F.col("_last_dense") - F.when(straddle, 1).otherwise(0)
    )
    # Running totals per last key (segments are contiguous in pid order).
    lk_cols = [F.col("_lk_" + c) for c in keys]
    w_seg = (Window.partitionBy(*lk_cols) if lk_cols else Window.partitionBy(F.lit(1)))
    w_seg = w_seg.orderBy(PID).rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("_cum_rn", F.sum("_last_rn").over(w_seg))
    s = s.withColumn("_cum_dense", F.sum("_d_contrib").over(w_seg))
    for o in spec.running_sums:
        s = s.withColumn("_cum_" + o, F.sum("_ls_" + o).over(w_seg))
    # Offsets for partition p come from partition p-1's running totals.
    prev = {
        "_off_rn": F.lag("_cum_rn").over(w_all),
        "_off_dense": F.lag("_cum_dense").over(w_all),
    }
    for o in spec.running_sums:
        prev["_off_" + o] = F.lag("_cum_" + o).over(w_all)
    for src in dict.fromkeys(spec.lags.values()):
        prev["_prev_" + src] = F.lag("_lv_" + src).over(w_all)
    s = s.withColumns(prev)
    s = s.withColumn("_joins_prev", joins_prev)
    tie = F.when(
        _null_safe_eq([F.col("_fo_" + c) for c in dcols], [F.col("_plo_" + c) for c in dcols]), 1
    ).otherwise(0)
    offsets = s.select(
        PID,
        *[F.col("_fk_" + c) for c in keys],
        F.when(F.col("_joins_prev"), F.col("_off_rn")).otherwise(0).alias("_off_rn"),
        F.when(F.col("_joins_prev"), F.col("_off_dense") - tie).otherwise(0).alias("_off_dense"),
        *[F.when(F.col("_joins_prev"), F.col("_off_" + o)).alias("_off_" + o)
          for o in spec.running_sums],
        *[F.when(F.col("_joins_prev"), F.col("_prev_" + src)).alias("_prev_" + src)
          for src in dict.fromkeys(spec.lags.values())],
    )

    # offsets has at most one row per partition: a proven bound for broadcast.
    j = local.join(F.broadcast(offsets), PID, "left")
    in_first = _null_safe_eq([F.col(c) for c in keys], [F.col("_fk_" + c) for c in keys])
    out = {}
    if spec.row_number:
        out[spec.row_number] = F.col("_rn") + F.when(in_first, F.col("_off_rn")).otherwise(0)
    if spec.dense_rank:
        out[spec.dense_rank] = F.col("_ldense") + F.when(in_first, F.col("_off_dense")).otherwise(0)
    for o in spec.running_sums:
        off = F.when(in_first, F.col("_off_" + o))
        out[o] = F.when(
            F.col(o).isNull() & off.isNull(), F.lit(None)
        ).otherwise(F.coalesce(F.col(o), F.lit(0)) + F.coalesce(off, F.lit(0))).cast(sum_types[o])
    for o, src in spec.lags.items():
        out[o] = F.when(
            in_first & (F.col("_rn") == 1), F.col("_prev_" + src)
        ).otherwise(F.col(o))
    j = j.withColumns(out)
    return j.select(*df.columns, *out.keys())

