"""Group rates joined back to claims, and provider ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.functions import mean, ratio_or
from claimspark.operators.joins import join_on_keys, sized
from claimspark.operators.scan import ordered_scan


def provider_stats(df: DataFrame, min_claims: int = 10) -> DataFrame:
    return (
        df.groupBy("provider_id")
        .agg(
            F.count("claim_id").alias("total_claims"),
            F.sum("denial_flag").cast("bigint").alias("total_denials"),
            mean("denial_flag").alias("denial_rate"),
        )
        .where(F.col("total_claims") >= min_claims)
    )


def rank_providers_by_denial_rate(df: DataFrame, min_claims: int = 10) -> DataFrame:
    """Providers with >= min_claims claims, ``denial_rank`` = dense rank of
    denial_rate descending. The rank is computed by the distributed scan, so
    no single task receives every provider."""
    stats = provider_stats(df, min_claims)
    ranked = ordered_scan(
        stats, None, [("denial_rate", False), ("provider_id", True)],
        dense_rank="denial_rank", dense_on=["denial_rate"],
    )
    return ranked.withColumn("denial_rank", F.col("denial_rank").cast("int"))


def group_stats(df: DataFrame, keys: list[str], aggs: dict) -> DataFrame:
    """One row per group (map-side partial aggregate, then a small shuffle)."""
    return df.groupBy(*keys).agg(*[e.alias(n) for n, e in aggs.items()])


def add_group_stats(df: DataFrame, keys: list[str], aggs: dict) -> DataFrame:
    """Attach per-group aggregates to every row (window-free): no single task
    ever has to hold a whole group."""
    return join_on_keys(df, sized(group_stats(df, keys, aggs)), keys)


PROVIDER_RATES = {
    "provider_denial_rate": lambda: mean("denial_flag"),
    "provider_claim_volume": lambda: F.count("claim_id"),
}
PAYER_RATES = {"payer_approval_rate": lambda: F.lit(1.0) - mean("denial_flag")}


def provider_rate_table(df: DataFrame) -> DataFrame:
    return group_stats(df, ["provider_id"], {k: f() for k, f in PROVIDER_RATES.items()})


def payer_rate_table(df: DataFrame) -> DataFrame:
    """A handful of payers: a window on payer_type would run in a handful of
    tasks, so the rate is aggregated and joined back."""
    return group_stats(df, ["payer_type"], {k: f() for k, f in PAYER_RATES.items()})


def add_provider_denial_rate(df: DataFrame) -> DataFrame:
    return join_on_keys(df, sized(provider_rate_table(df)), ["provider_id"])


def add_payer_approval_rate(df: DataFrame) -> DataFrame:
    return join_on_keys(df, sized(payer_rate_table(df)), ["payer_type"])


def add_rates(df: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Provider and payer rates, both aggregated from ``df`` itself (not one
    from the other's join output), then joined on. ``rows``: a table with the same
    claims that is cheaper to read than ``df``."""
    return apply_rates(df, fit_rates(df if rows is None else rows))


def fit_rates(train: DataFrame) -> dict[str, DataFrame]:
    """Provider and payer rate tables of the training rows alone."""
    return {"provider_id": provider_rate_table(train), "payer_type": payer_rate_table(train)}


def apply_rates(df: DataFrame, fitted: dict[str, DataFrame]) -> DataFrame:
    """Attach fitted rates; a key that training had not gives nulls."""
    for key, table in fitted.items():
        df = join_on_keys(df, sized(table), [key])
    return df


def add_cost_features(df: DataFrame) -> DataFrame:
    out = add_group_stats(df, ["patient_id"], {
        "patient_avg_claim": mean("claim_amount"),
        "patient_total_claims": F.count("claim_id"),
    })
    return out.withColumn(
        "cost_ratio_to_patient_avg", ratio_or("claim_amount", "patient_avg_claim", 1.0)
    )
