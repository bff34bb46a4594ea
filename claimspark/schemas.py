"""Schemas, domain code lists, lookup tables and null-fill contracts.

This module is the single copy of every constant the operators share.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# --- Fixed values: raw input schemas (column names, order and types) ---------
CLAIMS_SCHEMA = StructType([
    StructField("claim_id", StringType(), False),
    StructField("patient_id", StringType(), False),
    StructField("admit_date", DateType(), True),
    StructField("discharge_date", DateType(), True),
    StructField("diagnosis_code", StringType(), True),
    StructField("procedure_code", StringType(), True),
    StructField("provider_id", StringType(), True),
    StructField("facility_type", StringType(), True),
    StructField("payer_type", StringType(), True),
    StructField("claim_amount", DoubleType(), True),
    StructField("paid_amount", DoubleType(), True),
    StructField("denial_flag", IntegerType(), True),
    StructField("readmission_30day", IntegerType(), True),
    StructField("length_of_stay", IntegerType(), True),
    StructField("age", IntegerType(), True),
    StructField("gender", StringType(), True),
    StructField("comorbidity_count", IntegerType(), True),
    StructField("state", StringType(), True),
    StructField("insurance_type", StringType(), True),
])

PATIENTS_SCHEMA = StructType([
    StructField("patient_id", StringType(), False),
    StructField("age", IntegerType(), True),
    StructField("gender", StringType(), True),
    StructField("state", StringType(), True),
    StructField("insurance_type", StringType(), True),
    StructField("comorbidity_count", IntegerType(), True),
])

CLAIMS_KEY = "claim_id"
PATIENT_KEY = "patient_id"

# --- Fixed values: ICD-10 diagnosis codes in the data generator's order -------
DIAGNOSIS_CODES = [
    "E11.9", "I10", "J44.1", "I50.9", "J18.9", "M54.5", "I25.10", "N18.9",
    "J06.9", "E78.5", "F32.9", "K21.0", "G47.33", "M17.11", "E03.9",
    "J45.909", "I48.91", "N39.0", "K59.00", "R10.9",
]

# --- Fixed values: CPT procedure codes in the data generator's order ----------
PROCEDURE_CODES = [
    "99213", "99214", "99215", "99223", "99232", "99233",
    "99281", "99282", "99283", "99284", "99285",
    "43239", "27447", "33533", "47562", "49505",
    "71046", "74177", "93000", "93306", "70553",
]

# --- Fixed values: categorical domains ----------------------------------------
FACILITY_TYPES = ["Inpatient", "Outpatient", "Emergency", "Ambulatory", "SNF"]
INSURANCE_TYPES = [
    "HMO", "PPO", "EPO", "POS", "HDHP", "Medicare Advantage", "Medicaid Managed Care",
]

# --- Fixed values: diagnosis -> risk tier (1 = low .. 5 = high) ---------------
DIAGNOSIS_RISK = {
    "I50.9": 5, "J44.1": 4, "N18.9": 4, "I48.91": 4, "J18.9": 3,
    "I25.10": 3, "E11.9": 3, "I10": 2, "E78.5": 2, "F32.9": 2,
    "J45.909": 2, "N39.0": 2, "M54.5": 1, "M17.11": 1, "K21.0": 1,
    "E03.9": 1, "G47.33": 1, "J06.9": 1, "K59.00": 1, "R10.9": 1,
}
DEFAULT_RISK = 1

# --- Fixed values: diagnosis -> expected length of stay (days) ----------------
EXPECTED_LOS = {
    "E11.9": 3, "I10": 2, "J44.1": 5, "I50.9": 6, "J18.9": 5,
    "M54.5": 2, "I25.10": 4, "N18.9": 4, "J06.9": 1, "E78.5": 1,
    "F32.9": 3, "K21.0": 2, "G47.33": 1, "M17.11": 3, "E03.9": 1,
    "J45.909": 2, "I48.91": 4, "N39.0": 3, "K59.00": 1, "R10.9": 2,
}
DEFAULT_EXPECTED_LOS = 2.0

# --- Fixed values: age buckets (exclusive upper bound, label) -----------------
AGE_BUCKETS = [(30, "18-29"), (45, "30-44"), (55, "45-54"), (65, "55-64"), (75, "65-74")]
AGE_BUCKET_TOP = "75+"

# --- Fixed values: risk tiers on readmission probability ----------------------
RISK_TIERS = [(0.5, "High"), (0.25, "Medium")]
RISK_TIER_BOTTOM = "Low"

# --- Fixed values: null-fill contracts ----------------------------------------
# Applied before vector assembly in feature engineering (temporal features).
TEMPORAL_FILL = {
    "days_since_last_claim": -1,
    "prev_denial_flag": 0,
    "prev_claim_amount": 0.0,
    "rolling_cost_90d": 0.0,
    "claim_count_90d": 0,
}
# Applied before model training (temporal + aggregate features).
TRAINING_FILL = {
    **TEMPORAL_FILL,
    "claim_sequence": 1,
    "provider_denial_rate": 0.0,
    "provider_claim_volume": 0,
    "payer_approval_rate": 0.85,
    "patient_avg_claim": 0.0,
    "patient_total_claims": 1,
    "cost_ratio_to_patient_avg": 1.0,
}

# --- Fixed values: cold-start defaults for scoring claims without history ------
# ``None`` entries take the claim's own claim_amount.
SCORING_DEFAULTS = {
    "provider_denial_rate": 0.12,
    "provider_claim_volume": 100,
    "payer_approval_rate": 0.88,
    "patient_avg_claim": None,
    "patient_total_claims": 1,
    "cost_ratio_to_patient_avg": 1.0,
    "rolling_cost_90d": None,
    "claim_count_90d": 1,
    "days_since_last_claim": -1,
    "prev_denial_flag": 0,
    "prev_claim_amount": 0.0,
    "claim_sequence": 1,
}

# --- Fixed values: model inputs -----------------------------------------------
LABEL = "readmission_30day"
CATEGORICAL_FEATURES = ["facility_type", "insurance_type", "gender", "age_bucket"]
NUMERIC_FEATURES = [
    "claim_amount", "paid_amount", "length_of_stay", "age",
    "comorbidity_count", "diagnosis_risk_score", "los_vs_expected_ratio",
    "provider_denial_rate", "provider_claim_volume", "payer_approval_rate",
    "patient_avg_claim", "patient_total_claims", "cost_ratio_to_patient_avg",
    "comorbidity_index", "rolling_cost_90d", "claim_count_90d",
    "days_since_last_claim", "prev_denial_flag", "prev_claim_amount",
    "claim_sequence",
]

# --- Fixed values: evaluation operating points ---------------------------------
THRESHOLDS = [0.15, 0.20, 0.25, 0.30, 0.35, 0.40, 0.50, 0.60, 0.70]
