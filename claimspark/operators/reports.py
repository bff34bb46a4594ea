"""Business reports (aggregations) in the DataFrame API.

All means are exact-sum / count (see ``functions.mean``); every ordered
report carries a key tie-break so its order is total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimspark.functions import mean
from claimspark.schemas import LABEL


def claims_per_patient(df: DataFrame) -> DataFrame:
    return df.groupBy("patient_id").agg(
        F.count("claim_id").alias("num_claims"),
        F.sum("claim_amount").alias("total_claim_amount"),
        mean("claim_amount").alias("avg_claim_amount"),
        F.max("readmission_30day").alias("ever_readmitted"),
    )


def avg_los_by_diagnosis(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("diagnosis_code")
        .agg(
            mean("length_of_stay").alias("avg_los"),
            F.count("claim_id").alias("claim_count"),
            mean("claim_amount").alias("avg_cost"),
        )
        .orderBy(F.col("avg_los").desc(), F.col("diagnosis_code"))
    )


def top_los_diagnoses(df: DataFrame, k: int = 5) -> DataFrame:
    """First k rows of the LOS report (a top-k: TakeOrderedAndProject)."""
    return avg_los_by_diagnosis(df).limit(k)


def denial_by_payer(df: DataFrame, with_rank: bool = True) -> DataFrame:
    """Denial statistics per payer, ordered by denial rate; optional dense rank.

    The rank window runs over the aggregate (one row per payer), never over claims.
    """
    out = df.groupBy("payer_type").agg(
        F.count("claim_id").alias("total_claims"),
        F.sum("denial_flag").cast("bigint").alias("total_denials"),
        mean("denial_flag").alias("denial_rate"),
        mean("claim_amount").alias("avg_claim_amount"),
    )
    if with_rank:
        out = out.withColumn(
            "denial_rank", F.dense_rank().over(Window.orderBy(F.col("denial_rate").desc()))
        )
    return out.orderBy(F.col("denial_rate").desc(), F.col("payer_type"))


def readmit_by_diagnosis(df: DataFrame, min_claims: int = 1000) -> DataFrame:
    """Readmission rate per diagnosis (HAVING claim_count >= min_claims) with a
    display band: > 0.20 high, > 0.15 elevated, else normal."""
    out = (
        df.groupBy("diagnosis_code")
        .agg(mean(LABEL).alias("readmit_rate"), F.count("claim_id").alias("claim_count"))
        .where(F.col("claim_count") >= min_claims)
    )
    band = (F.when(F.col("readmit_rate") > 0.20, "high")
            .when(F.col("readmit_rate") > 0.15, "elevated").otherwise("normal"))
    return out.withColumn("band", band).orderBy(F.col("readmit_rate").desc(), F.col("diagnosis_code"))


def provider_facility(df: DataFrame, min_claims: int = 50) -> DataFrame:
    return (
        df.groupBy("provider_id", "facility_type")
        .agg(mean("denial_flag").alias("denial_rate"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_claims)
    )


def provider_facility_heatmap(
    df: DataFrame, min_claims: int = 50, top: int = 15, facilities: list[str] | None = None
) -> DataFrame:
    """Top providers by claims in the kept (provider, facility) cells, pivoted
    to one denial-rate column per facility (missing cell -> 0).

    The top-k list is tiny (k rows) so its semi-join is broadcast by size.
    """
    from claimspark.schemas import FACILITY_TYPES

    cells = provider_facility(df, min_claims)
    top_ids = (
        cells.groupBy("provider_id").agg(F.sum("n").alias("n"))
        .orderBy(F.col("n").desc(), F.col("provider_id")).limit(top)
        .select("provider_id")
    )
    kept = cells.join(F.broadcast(top_ids), "provider_id", "left_semi")
    facs = facilities or FACILITY_TYPES
    return kept.groupBy("provider_id").pivot("facility_type", facs).agg(F.first("denial_rate")).fillna(0.0)


def monthly_trends(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(F.trunc("admit_date", "month").alias("month"))
        .agg(
            F.count("claim_id").alias("claim_volume"),
            F.sum("claim_amount").alias("total_cost"),
            mean("denial_flag").alias("denial_rate"),
        )
        .orderBy("month")
    )


def insurance_mix(df: DataFrame) -> DataFrame:
    """Claims per insurance type and its percent share (share over the small aggregate)."""
    counts = df.groupBy("insurance_type").agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.withColumn(
        "share_pct", F.col("count").cast("double") * F.lit(100.0) / total.cast("double")
    ).orderBy(F.col("count").desc(), F.col("insurance_type"))


def insurance_cost_denial(df: DataFrame) -> DataFrame:
    return df.groupBy("insurance_type").agg(
        mean("denial_flag").alias("denial_rate"), mean("claim_amount").alias("avg_cost")
    )


def dataset_summary(claims: DataFrame, patients: DataFrame) -> DataFrame:
    """Headline counts and rates as long (metric, value) rows: one global
    aggregate per table, stacked without a join."""
    c = claims.agg(
        F.count(F.lit(1)).cast("double").alias("n_claims"),
        mean("denial_flag").alias("denial_rate"),
        mean(LABEL).alias("readmission_rate"),
        mean("claim_amount").alias("mean_claim_amount"),
    )
    p = patients.agg(
        F.count(F.lit(1)).cast("double").alias("n_patients"), mean("age").alias("mean_age")
    )
    return c.unpivot([], c.columns, "metric", "value").unionByName(
        p.unpivot([], p.columns, "metric", "value")
    )


def class_balance(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Positive/negative counts and the positive-class weight neg / max(pos, 1)."""
    return df.agg(
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
    ).withColumn(
        "positive_weight",
        F.col("negatives").cast("double") / F.greatest(F.col("positives"), F.lit(1)).cast("double"),
    )
