"""End-to-end compositions of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimspark.operators import reports
from claimspark.operators.enrich import join_claims_patients
from claimspark.operators.features import engineer_features
from claimspark.operators.joins import assert_unique_key
from claimspark.operators.timeline import add_lag_features, add_rolling_claim_cost, by_patient, hot_patients
from claimspark.plans.sql import compute_aggregations_sql
from claimspark.schemas import PATIENT_KEY


def enriched_claims(claims: DataFrame, patients: DataFrame, with_patient_totals: bool = False) -> DataFrame:
    """Lag features -> patient join -> rolling 90-day cost.

    All three deal the claims by patient, so they share one shuffle; only patients
    with very many claims go apart (``timeline``). Who these are is counted once, on the
    claims table.
    """
    assert_unique_key(patients, PATIENT_KEY)

    def work(own: DataFrame, hot: list) -> DataFrame:
        df = join_claims_patients(add_lag_features(own, hot), patients)
        return add_rolling_claim_cost(df, with_patient_totals=with_patient_totals, hot=hot)

    return by_patient(claims, hot_patients(claims), work, claims.count())


def compute_aggregations(claims: DataFrame) -> dict[str, DataFrame]:
    return {
        "claims_per_patient": reports.claims_per_patient(claims),
        "avg_los_by_diagnosis": reports.avg_los_by_diagnosis(claims),
        "denial_by_payer": reports.denial_by_payer(claims),
    }


def run_all_transforms(spark: SparkSession, claims: DataFrame, patients: DataFrame):
    """Enriched claims plus both report families (DataFrame and SQL)."""
    enriched = enriched_claims(claims, patients)
    return enriched, {**compute_aggregations(enriched), **compute_aggregations_sql(spark, enriched)}


def feature_table(claims: DataFrame, patients: DataFrame) -> DataFrame:
    """Enriched claims (with patient totals from the same pass), then provider and
    payer rates, which enrichment does not touch, aggregated from ``claims``."""
    return engineer_features(enriched_claims(claims, patients, with_patient_totals=True), claims=claims)
