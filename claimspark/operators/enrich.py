"""Claims x patients enrichment (left outer join on patient_id)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from claimspark.operators.joins import assert_unique_key
from claimspark.schemas import PATIENT_KEY


def join_claims_patients(claims: DataFrame, patients: DataFrame, check_key: bool = False) -> DataFrame:
    """Replace the claim's denormalised demographics by the dimension's.

    Orphan claims keep their row with null demographics. ``check_key`` raises
    on a null or duplicate patient before the join could fan out. Whether the
    dimension is broadcast is left to the planner, which knows its bytes.
    """
    if check_key:
        assert_unique_key(patients, PATIENT_KEY)
    shared = [c for c in patients.columns if c != PATIENT_KEY]
    return claims.drop(*shared).join(patients, on=PATIENT_KEY, how="left")
