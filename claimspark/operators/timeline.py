"""Per-patient timeline features: rolling 90-day cost and lag features.

Both are skew-safe: a task holds all claims of one patient only if these are at most
``HOT_CLAIMS``. The others' share one shuffle by patient and plain windows; claims of
patients with more are split over tasks (``ordered_scan``, daily totals).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.functions import days, ratio_or
from claimspark.operators.joins import among, hot_keys, join_on_keys
from claimspark.operators.scan import ordered_scan

DAY = "_admit_day"
#: Claims of one patient that one task may hold.
HOT_CLAIMS = 5_000
#: Claims of a task, about, in a chain of windows by patient: several sorts of wide rows are
#: held at once, and partitions merged by their compressed bytes hold too many of them.
TASK_CLAIMS = 100_000


def hot_patients(claims: DataFrame, most: int | None = None) -> list:
    """Patients with more than ``HOT_CLAIMS`` claims."""
    return hot_keys(claims, "patient_id", HOT_CLAIMS if most is None else most)


def by_patient(df: DataFrame, hot: list, work, rows: int) -> DataFrame:
    """``work(claims, hot)`` of ``df`` (about ``rows`` claims), dealt once by patient into tasks of about
    ``TASK_CLAIMS``, so that no task spills; the claims of ``hot`` patients go apart from the start."""
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_CLAIMS))
    if not hot:
        return work(df.repartition(parts, "patient_id"), [])
    is_hot = among("patient_id", hot)
    return work(df.where(~is_hot).repartition(parts, "patient_id"), []).unionByName(work(df.where(is_hot), hot))


def _apart(df: DataFrame, hot: list | None, together, split) -> DataFrame:
    """``together`` of the claims of most patients and ``split`` of those of ``hot`` ones."""
    hot = hot_patients(df) if hot is None else hot
    if not hot:
        return together(df)
    is_hot = among("patient_id", hot)
    return together(df.where(~is_hot)).unionByName(split(df.where(is_hot)))


def add_rolling_claim_cost(df: DataFrame, window_days: int = 90, with_patient_totals: bool = False,
                           hot: list | None = None) -> DataFrame:
    """``rolling_cost_90d`` / ``claim_count_90d``: sum of claim_amount and
    count of claim_id over the patient's claims admitted in
    ``[admit_date - window_days, admit_date]`` (same-day claims included).

    A range window by patient. For ``hot`` patients (default: counted here) the frame is
    taken from daily totals: it depends only on (patient, day), so their claims are
    first reduced to one row per (patient, day) with a map-side partial aggregate; the range
    window then runs over at most one row per calendar day per patient, and
    the totals are joined back on (patient_id, day).

    ``with_patient_totals`` also attaches ``patient_avg_claim``,
    ``patient_total_claims`` and ``cost_ratio_to_patient_avg`` from the same
    windows or daily table, so both feature groups cost a single pass.
    """
    out = _apart(df, hot, lambda d: _rolling_windows(d, window_days, with_patient_totals),
                 lambda d: _rolling_daily(d, window_days, with_patient_totals))
    if with_patient_totals:
        out = out.withColumn("cost_ratio_to_patient_avg",
                             ratio_or("claim_amount", "patient_avg_claim", 1.0))
    return out


def _rolling_windows(df: DataFrame, window_days: int, with_patient_totals: bool) -> DataFrame:
    near = Window.partitionBy("patient_id").orderBy(DAY).rangeBetween(-window_days, 0)
    cost, amount = F.sum("claim_amount").over(near), df.schema["claim_amount"].dataType
    if isinstance(amount, T.DecimalType):  # the width of a sum of daily sums
        cost = cost.cast(T.DecimalType(min(amount.precision + 20, 38), amount.scale))
    cols = {"rolling_cost_90d": cost, "claim_count_90d": F.count("claim_id").over(near)}
    if with_patient_totals:
        whole = Window.partitionBy("patient_id")
        cols |= {"patient_avg_claim": F.try_divide(F.sum("claim_amount").over(whole).cast("double"),
                                                   F.count("claim_amount").over(whole).cast("double")),
                 "patient_total_claims": F.count("claim_id").over(whole)}
    return df.withColumn(DAY, days("admit_date")).withColumns(cols).drop(DAY)


def _rolling_daily(df: DataFrame, window_days: int, with_patient_totals: bool) -> DataFrame:
    with_day = df.withColumn(DAY, days("admit_date"))
    daily = with_day.groupBy("patient_id", DAY).agg(
        F.sum("claim_amount").alias("_day_cost"),
        F.count("claim_id").alias("_day_n"),
        F.count("claim_amount").alias("_day_amount_n"),
    )
    w = Window.partitionBy("patient_id").orderBy(DAY).rangeBetween(-window_days, 0)
    cols = [
        "patient_id", DAY,
        F.sum("_day_cost").over(w).alias("rolling_cost_90d"),
        F.sum("_day_n").over(w).alias("claim_count_90d"),
    ]
    if with_patient_totals:
        whole = Window.partitionBy("patient_id")
        cols += [
            F.try_divide(F.sum("_day_cost").over(whole).cast("double"),
                         F.sum("_day_amount_n").over(whole).cast("double")).alias("patient_avg_claim"),
            F.sum("_day_n").over(whole).alias("patient_total_claims"),
        ]
    return join_on_keys(with_day, daily.select(*cols), ["patient_id", DAY]).drop(DAY)


def add_lag_features(df: DataFrame, hot: list | None = None) -> DataFrame:
    """Previous claim of the same patient in (admit_date, claim_id) order:
    ``days_since_last_claim``, ``prev_denial_flag``, ``prev_claim_amount``
    and the 1-based ``claim_sequence``. claim_id breaks same-day ties.
    """
    lags = {
        "_prev_admit": "admit_date",
        "prev_denial_flag": "denial_flag",
        "prev_claim_amount": "claim_amount",
    }
    own = Window.partitionBy("patient_id").orderBy(F.col("admit_date").asc_nulls_first(), F.col("claim_id").asc_nulls_first())
    scanned = _apart(
        df, hot,
        lambda d: d.withColumns({"claim_sequence": F.row_number().over(own), **{o: F.lag(c).over(own) for o, c in lags.items()}}),
        lambda d: ordered_scan(
            d,
            partition_by=["patient_id"],
            order_by=[("admit_date", True), ("claim_id", True)],
            row_number="claim_sequence",
            lags=lags,
        ),
    )
    return scanned.withColumns({
        "days_since_last_claim": F.datediff("admit_date", "_prev_admit"),
        "claim_sequence": F.col("claim_sequence").cast("int"),
    }).drop("_prev_admit").select(
        *df.columns, "days_since_last_claim", "prev_denial_flag", "prev_claim_amount", "claim_sequence"
    )
