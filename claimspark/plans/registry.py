"""Named queries over the shared test tables and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame; the oracle
for the same key is DuckDB SQL over the raw tables (adapter CTEs prefixed).
Column names and types are aligned on both sides: decimal results are
widened to precision 38, averages are exact-sum / count in double.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.operators import features as feat
from claimspark.operators import rates, reports, timeline
from claimspark.operators.enrich import join_claims_patients
from claimspark.plans import pipelines
from claimspark.plans.oracle import oracle
from claimspark.plans.sql import compute_aggregations_sql
from claimspark.sources import adapter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: normalize(fn(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def normalize(df: DataFrame) -> DataFrame:
    """Widen computed decimals (sums: precision > 18) to precision 38, the
    width SQL engines give a decimal sum; stored money columns keep theirs."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 18:
            c = c.cast(T.DecimalType(38, f.dataType.scale))
        out.append(c.alias(f.name))
    return df.select(*out)


def _claims(spark, sf):
    return adapter.landed(spark, sf)[0]


def _tables(spark, sf):
    return adapter.landed(spark, sf)


def _enriched(spark, sf):
    return join_claims_patients(*_tables(spark, sf))


def _mean(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE) / COUNT({x})"


def _wmean(x: str, part: str) -> str:
    return f"CAST(SUM({x}) OVER (PARTITION BY {part}) AS DOUBLE) / COUNT({x}) OVER (PARTITION BY {part})"


# --------------------------------------------------------------------------
# Reports (E1-E14, G2, F3)
# --------------------------------------------------------------------------
_CPP_SQL = oracle(f"""
SELECT patient_id, COUNT(claim_id) AS num_claims,
       CAST(SUM(claim_amount) AS DECIMAL(38,2)) AS total_claim_amount,
       {_mean('claim_amount')} AS avg_claim_amount,
       MAX(readmission_30day) AS ever_readmitted
FROM claims GROUP BY patient_id""")

_LOS_SQL = oracle(f"""
SELECT diagnosis_code, {_mean('length_of_stay')} AS avg_los, COUNT(claim_id) AS claim_count,
       {_mean('claim_amount')} AS avg_cost
FROM claims GROUP BY diagnosis_code ORDER BY avg_los DESC, diagnosis_code""")

_PAYER_SQL = oracle(f"""
SELECT payer_type, COUNT(claim_id) AS total_claims, CAST(SUM(denial_flag) AS BIGINT) AS total_denials,
       {_mean('denial_flag')} AS denial_rate, {_mean('claim_amount')} AS avg_claim_amount,
       CAST(DENSE_RANK() OVER (ORDER BY {_mean('denial_flag')} DESC) AS INTEGER) AS denial_rank
FROM claims GROUP BY payer_type ORDER BY denial_rate DESC, payer_type""")


@register("denial_by_payer", _PAYER_SQL)
def q_denial_by_payer(spark, sf):
    """Denial statistics per payer with a dense rank on the rate."""
    return reports.denial_by_payer(_claims(spark, sf))


@register("claims_per_patient", _CPP_SQL)
def q_claims_per_patient(spark, sf):
    return reports.claims_per_patient(_claims(spark, sf))


@register("avg_los_by_diagnosis", _LOS_SQL)
def q_avg_los(spark, sf):
    return reports.avg_los_by_diagnosis(_claims(spark, sf))


@register("claims_per_patient_sql", _CPP_SQL)
def q_cpp_sql(spark, sf):
    return compute_aggregations_sql(spark, _claims(spark, sf))["claims_per_patient_sql"]


@register("avg_los_by_diagnosis_sql", _LOS_SQL)
def q_los_sql(spark, sf):
    return compute_aggregations_sql(spark, _claims(spark, sf))["avg_los_by_diagnosis_sql"]


@register("denial_by_payer_sql", _PAYER_SQL)
def q_payer_sql(spark, sf):
    return compute_aggregations_sql(spark, _claims(spark, sf))["denial_by_payer_sql"]


@register("top_los_diagnoses", oracle(f"""
SELECT diagnosis_code, {_mean('length_of_stay')} AS avg_los, COUNT(claim_id) AS claim_count,
       {_mean('claim_amount')} AS avg_cost
FROM claims GROUP BY diagnosis_code ORDER BY avg_los DESC, diagnosis_code LIMIT 5"""))
def q_top_los(spark, sf):
    return reports.top_los_diagnoses(_claims(spark, sf), 5)


@register("provider_ranking", oracle(f"""
SELECT provider_id, total_claims, total_denials, denial_rate,
       CAST(DENSE_RANK() OVER (ORDER BY denial_rate DESC) AS INTEGER) AS denial_rank
FROM (SELECT provider_id, COUNT(claim_id) AS total_claims,
             CAST(SUM(denial_flag) AS BIGINT) AS total_denials, {_mean('denial_flag')} AS denial_rate
      FROM claims GROUP BY provider_id HAVING COUNT(claim_id) >= 10) s"""))
def q_provider_ranking(spark, sf):
    """Providers with >= 10 claims ranked by denial rate (distributed dense rank)."""
    return rates.rank_providers_by_denial_rate(_claims(spark, sf), 10)


@register("readmit_by_diagnosis", oracle(f"""
SELECT diagnosis_code, readmit_rate, claim_count,
       CASE WHEN readmit_rate > 0.20 THEN 'high' WHEN readmit_rate > 0.15 THEN 'elevated'
            ELSE 'normal' END AS band
FROM (SELECT diagnosis_code, {_mean('readmission_30day')} AS readmit_rate, COUNT(claim_id) AS claim_count
      FROM claims GROUP BY diagnosis_code) s
WHERE claim_count >= 1000 ORDER BY readmit_rate DESC, diagnosis_code"""))
def q_readmit_by_dx(spark, sf):
    return reports.readmit_by_diagnosis(_claims(spark, sf), 1000)


_PF_SQL = f"""
SELECT provider_id, facility_type, {_mean('denial_flag')} AS denial_rate, COUNT(*) AS n
FROM claims GROUP BY provider_id, facility_type HAVING COUNT(*) >= 50"""


@register("provider_facility", oracle(_PF_SQL))
def q_provider_facility(spark, sf):
    return reports.provider_facility(_claims(spark, sf), 50)


def _heatmap_sql() -> str:
    from claimspark.schemas import FACILITY_TYPES

    cols = ", ".join(
        f"COALESCE(MAX(CASE WHEN facility_type = '{f}' THEN denial_rate END), 0.0) AS \"{f}\""
        for f in FACILITY_TYPES
    )
    return oracle(f"""
SELECT c.provider_id, {cols}
FROM cells c JOIN top_p t ON c.provider_id = t.provider_id
GROUP BY c.provider_id""", ctes=f"""
cells AS ({_PF_SQL}),
top_p AS (SELECT provider_id FROM cells GROUP BY provider_id ORDER BY SUM(n) DESC, provider_id LIMIT 15)""")


@register("provider_facility_heatmap", _heatmap_sql())
def q_heatmap(spark, sf):
    """Top-15 providers x facility denial-rate pivot (missing cells = 0)."""
    return reports.provider_facility_heatmap(_claims(spark, sf), 50, 15)


@register("monthly_trends", oracle(f"""
SELECT CAST(date_trunc('month', admit_date) AS DATE) AS month, COUNT(claim_id) AS claim_volume,
       CAST(SUM(claim_amount) AS DECIMAL(38,2)) AS total_cost, {_mean('denial_flag')} AS denial_rate
FROM claims GROUP BY 1 ORDER BY 1"""))
def q_monthly(spark, sf):
    return reports.monthly_trends(_claims(spark, sf))


@register("insurance_mix", oracle("""
SELECT insurance_type, count,
       CAST(count AS DOUBLE) * 100.0 / CAST(SUM(count) OVER () AS DOUBLE) AS share_pct
FROM (SELECT insurance_type, COUNT(*) AS count FROM claims GROUP BY insurance_type) s
ORDER BY count DESC, insurance_type"""))
def q_insurance_mix(spark, sf):
    return reports.insurance_mix(_claims(spark, sf))


@register("insurance_cost_denial", oracle(f"""
SELECT insurance_type, {_mean('denial_flag')} AS denial_rate, {_mean('claim_amount')} AS avg_cost
FROM claims GROUP BY insurance_type"""))
def q_insurance_cost(spark, sf):
    return reports.insurance_cost_denial(_claims(spark, sf))


@register("dataset_summary", oracle(f"""
SELECT 'n_claims' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM claims
UNION ALL SELECT 'denial_rate', {_mean('denial_flag')} FROM claims
UNION ALL SELECT 'readmission_rate', {_mean('readmission_30day')} FROM claims
UNION ALL SELECT 'mean_claim_amount', {_mean('claim_amount')} FROM claims
UNION ALL SELECT 'n_patients', CAST(COUNT(*) AS DOUBLE) FROM patients
UNION ALL SELECT 'mean_age', {_mean('age')} FROM patients"""))
def q_dataset_summary(spark, sf):
    return reports.dataset_summary(*_tables(spark, sf))


@register("class_weights", oracle("""
SELECT COUNT(*) FILTER (WHERE readmission_30day = 1) AS positives,
       COUNT(*) FILTER (WHERE readmission_30day = 0) AS negatives,
       CAST(COUNT(*) FILTER (WHERE readmission_30day = 0) AS DOUBLE)
         / CAST(GREATEST(COUNT(*) FILTER (WHERE readmission_30day = 1), 1) AS DOUBLE) AS positive_weight
FROM claims"""))
def q_class_weights(spark, sf):
    return reports.class_balance(_claims(spark, sf))


# --------------------------------------------------------------------------
# Join, windows and features (D1j, F1-F10, J1-J7, C6-C9)
# --------------------------------------------------------------------------
_ENRICH_CTE = """
enriched AS (
  SELECT c.claim_id, c.patient_id, c.admit_date, c.discharge_date, c.diagnosis_code, c.procedure_code,
         c.provider_id, c.facility_type, c.payer_type, c.claim_amount, c.paid_amount, c.denial_flag,
         c.readmission_30day, c.length_of_stay,
         p.age, p.gender, p.state, p.insurance_type, p.comorbidity_count
  FROM claims c LEFT JOIN patients p ON c.patient_id = p.patient_id)"""

_TIMELINE_COLS = """
  CAST(SUM(claim_amount) OVER w90 AS DECIMAL(38,2)) AS rolling_cost_90d,
  COUNT(claim_id) OVER w90 AS claim_count_90d,
  CAST(date_diff('day', LAG(admit_date) OVER wseq, admit_date) AS INTEGER) AS days_since_last_claim,
  LAG(denial_flag) OVER wseq AS prev_denial_flag,
  LAG(claim_amount) OVER wseq AS prev_claim_amount,
  CAST(ROW_NUMBER() OVER wseq AS INTEGER) AS claim_sequence"""

_WINDOWS = """
WINDOW w90 AS (PARTITION BY patient_id ORDER BY date_diff('day', DATE '1970-01-01', admit_date)
               RANGE BETWEEN 90 PRECEDING AND CURRENT ROW),
       wseq AS (PARTITION BY patient_id ORDER BY admit_date, claim_id)"""

_TIMELINE_CTE = _ENRICH_CTE + f""",
timeline AS (SELECT *, {_TIMELINE_COLS} FROM enriched {_WINDOWS})"""

def _risk_sql() -> str:
    from claimspark.schemas import DIAGNOSIS_RISK

    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in DIAGNOSIS_RISK.items())
    return f"CAST(CASE diagnosis_code {whens} ELSE 1 END AS INTEGER)"


def _exp_los_sql() -> str:
    from claimspark.schemas import EXPECTED_LOS

    whens = " ".join(f"WHEN '{k}' THEN {float(v)}" for k, v in EXPECTED_LOS.items())
    return f"CAST(CASE diagnosis_code {whens} ELSE 2.0 END AS DOUBLE)"


def _age_bucket_sql() -> str:
    from claimspark.schemas import AGE_BUCKET_TOP, AGE_BUCKETS

    whens = " ".join(f"WHEN age < {u} THEN '{lbl}'" for u, lbl in AGE_BUCKETS)
    return f"CASE {whens} ELSE '{AGE_BUCKET_TOP}' END"


def _row_features_sql() -> str:
    risk = _risk_sql()
    exp = _exp_los_sql()
    return f"""
  {risk} AS diagnosis_risk_score,
  CASE WHEN {exp} > 0 THEN CAST(length_of_stay AS DOUBLE) / {exp} ELSE 1.0 END AS los_vs_expected_ratio,
  {_age_bucket_sql()} AS age_bucket,
  comorbidity_count * CAST(0.5 AS DOUBLE) + {risk} * CAST(0.5 AS DOUBLE) AS comorbidity_index"""


_GROUP_FEATURES_SQL = f"""
  {_wmean('denial_flag', 'provider_id')} AS provider_denial_rate,
  COUNT(claim_id) OVER (PARTITION BY provider_id) AS provider_claim_volume,
  CAST(1.0 AS DOUBLE) - {_wmean('denial_flag', 'payer_type')} AS payer_approval_rate,
  {_wmean('claim_amount', 'patient_id')} AS patient_avg_claim,
  COUNT(claim_id) OVER (PARTITION BY patient_id) AS patient_total_claims,
  CASE WHEN {_wmean('claim_amount', 'patient_id')} > 0
       THEN CAST(claim_amount AS DOUBLE) / ({_wmean('claim_amount', 'patient_id')}) ELSE 1.0 END
    AS cost_ratio_to_patient_avg"""

_FEATURES_CTE = _TIMELINE_CTE + f""",
features AS (SELECT *, {_row_features_sql()}, {_GROUP_FEATURES_SQL} FROM timeline)"""


@register("enrich_claims", oracle("SELECT * FROM enriched", ctes=_ENRICH_CTE))
def q_enrich(spark, sf):
    """Claims left-joined to the patient dimension (demographics replaced)."""
    return _enriched(spark, sf)


@register("rolling_cost_90d", oracle("""
SELECT claim_id, patient_id, admit_date, claim_amount,
       CAST(SUM(claim_amount) OVER w90 AS DECIMAL(38,2)) AS rolling_cost_90d,
       COUNT(claim_id) OVER w90 AS claim_count_90d
FROM claims """ + _WINDOWS.replace(",\n       wseq AS (PARTITION BY patient_id ORDER BY admit_date, claim_id)", "")))
def q_rolling(spark, sf):
    """Per-patient 90-day rolling cost and count (range frame, same day included)."""
    df = timeline.add_rolling_claim_cost(_claims(spark, sf))
    return df.select("claim_id", "patient_id", "admit_date", "claim_amount",
                     "rolling_cost_90d", "claim_count_90d")


@register("claim_lags", oracle("""
SELECT claim_id, patient_id, admit_date,
  CAST(date_diff('day', LAG(admit_date) OVER wseq, admit_date) AS INTEGER) AS days_since_last_claim,
  LAG(denial_flag) OVER wseq AS prev_denial_flag,
  LAG(claim_amount) OVER wseq AS prev_claim_amount,
  CAST(ROW_NUMBER() OVER wseq AS INTEGER) AS claim_sequence
FROM claims WINDOW wseq AS (PARTITION BY patient_id ORDER BY admit_date, claim_id)"""))
def q_lags(spark, sf):
    """Previous-claim features and claim sequence per patient (skew-safe scan)."""
    df = timeline.add_lag_features(_claims(spark, sf))
    return df.select("claim_id", "patient_id", "admit_date", "days_since_last_claim",
                     "prev_denial_flag", "prev_claim_amount", "claim_sequence")


@register("provider_rates", oracle(f"""
SELECT claim_id, provider_id, {_wmean('denial_flag', 'provider_id')} AS provider_denial_rate,
       COUNT(claim_id) OVER (PARTITION BY provider_id) AS provider_claim_volume
FROM claims"""))
def q_provider_rates(spark, sf):
    return rates.add_provider_denial_rate(_claims(spark, sf)).select(
        "claim_id", "provider_id", "provider_denial_rate", "provider_claim_volume")


@register("payer_approval", oracle(f"""
SELECT claim_id, payer_type, CAST(1.0 AS DOUBLE) - {_wmean('denial_flag', 'payer_type')} AS payer_approval_rate
FROM claims"""))
def q_payer_approval(spark, sf):
    return rates.add_payer_approval_rate(_claims(spark, sf)).select(
        "claim_id", "payer_type", "payer_approval_rate")


@register("cost_features", oracle(f"""
SELECT claim_id, patient_id, {_wmean('claim_amount', 'patient_id')} AS patient_avg_claim,
       COUNT(claim_id) OVER (PARTITION BY patient_id) AS patient_total_claims,
       CASE WHEN {_wmean('claim_amount', 'patient_id')} > 0
            THEN CAST(claim_amount AS DOUBLE) / ({_wmean('claim_amount', 'patient_id')}) ELSE 1.0 END
         AS cost_ratio_to_patient_avg
FROM claims"""))
def q_cost_features(spark, sf):
    return rates.add_cost_features(_claims(spark, sf)).select(
        "claim_id", "patient_id", "patient_avg_claim", "patient_total_claims", "cost_ratio_to_patient_avg")


@register("diagnosis_risk", oracle(f"SELECT claim_id, diagnosis_code, {_risk_sql()} AS diagnosis_risk_score FROM claims"))
def q_risk(spark, sf):
    return feat.add_diagnosis_risk_score(_claims(spark, sf)).select(
        "claim_id", "diagnosis_code", "diagnosis_risk_score")


@register("los_ratio", oracle(f"""
SELECT claim_id, diagnosis_code, length_of_stay,
       CASE WHEN {_exp_los_sql()} > 0 THEN CAST(length_of_stay AS DOUBLE) / {_exp_los_sql()} ELSE 1.0 END
         AS los_vs_expected_ratio
FROM claims"""))
def q_los_ratio(spark, sf):
    return feat.add_los_ratio(_claims(spark, sf)).select(
        "claim_id", "diagnosis_code", "length_of_stay", "los_vs_expected_ratio")


@register("age_bucket", oracle(f"SELECT claim_id, age, {_age_bucket_sql()} AS age_bucket FROM enriched",
                               ctes=_ENRICH_CTE))
def q_age_bucket(spark, sf):
    return feat.add_age_bucket(_enriched(spark, sf)).select("claim_id", "age", "age_bucket")


@register("comorbidity_index", oracle(f"""
SELECT claim_id, comorbidity_count, {_risk_sql()} AS diagnosis_risk_score,
       comorbidity_count * CAST(0.5 AS DOUBLE) + {_risk_sql()} * CAST(0.5 AS DOUBLE) AS comorbidity_index
FROM enriched""", ctes=_ENRICH_CTE))
def q_comorbidity(spark, sf):
    df = feat.add_comorbidity_index(feat.add_diagnosis_risk_score(_enriched(spark, sf)))
    return df.select("claim_id", "comorbidity_count", "diagnosis_risk_score", "comorbidity_index")


@register("enriched_claims", oracle("SELECT * FROM timeline", ctes=_TIMELINE_CTE))
def q_enriched_claims(spark, sf):
    """Join -> rolling 90-day window -> lag features, all claim columns."""
    return pipelines.enriched_claims(*_tables(spark, sf))


@register("feature_table", oracle("SELECT * FROM features", ctes=_FEATURES_CTE))
def q_feature_table(spark, sf):
    """The full pre-vector feature table."""
    return pipelines.feature_table(*_tables(spark, sf))


def _fill_sql() -> str:
    from claimspark.schemas import NUMERIC_FEATURES, TRAINING_FILL

    cols = []
    for c in NUMERIC_FEATURES:
        if c in TRAINING_FILL:
            cols.append(f"COALESCE({c}, {TRAINING_FILL[c]!r}) AS {c}")
        else:
            cols.append(c)
    return ", ".join(cols)


@register("features_filled", oracle(
    f"SELECT claim_id, {_fill_sql()} FROM features", ctes=_FEATURES_CTE))
def q_features_filled(spark, sf):
    from claimspark.schemas import NUMERIC_FEATURES

    df = feat.fill_training(pipelines.feature_table(*_tables(spark, sf)))
    return df.select("claim_id", *NUMERIC_FEATURES)


@register("model_inputs", oracle(
    f"""SELECT claim_id, {_fill_sql()}, facility_type, insurance_type, gender, age_bucket,
              CAST(readmission_30day AS INTEGER) AS readmission_30day FROM features""",
    ctes=_FEATURES_CTE))
def q_model_inputs(spark, sf):
    return feat.model_inputs(pipelines.feature_table(*_tables(spark, sf)))


# --------------------------------------------------------------------------
# Quality, ingestion, sinks (A4-A8, B1-B9)
# --------------------------------------------------------------------------
from claimspark.operators import quality, stats  # noqa: E402
from claimspark.operators import evaluate as ev  # noqa: E402
from claimspark.schemas import CLAIMS_SCHEMA, THRESHOLDS  # noqa: E402
from claimspark.sources import files  # noqa: E402
from claimspark.session import shared_path  # noqa: E402

_CLAIM_COLS = [f.name for f in CLAIMS_SCHEMA.fields]


def _profile_sql(cols: list[str]) -> str:
    parts = [
        f"SELECT '{c}' AS column_name, COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) * 100.0 / CAST(COUNT(*) AS DOUBLE) AS null_pct FROM claims"
        for c in cols
    ]
    return oracle("\nUNION ALL ".join(parts))


@register("dq_profile", _profile_sql(_CLAIM_COLS))
def q_dq_profile(spark, sf):
    """Row count, null count and null percent of every claims column (one scan)."""
    return quality.profile(_claims(spark, sf))


_NUMERIC_CLAIM_COLS = ["claim_amount", "paid_amount", "denial_flag", "readmission_30day",
                       "length_of_stay", "age", "comorbidity_count"]


def _outlier_sql() -> str:
    parts = []
    for c in _NUMERIC_CLAIM_COLS:
        m = f"(SELECT CAST(SUM({c}) AS DOUBLE) / COUNT({c}) FROM claims)"
        s = f"(SELECT STDDEV_SAMP(CAST({c} AS DOUBLE)) FROM claims)"
        parts.append(
            f"SELECT '{c}' AS column_name, ROUND({m}, 6) AS mean, ROUND({s}, 6) AS stddev, "
            f"ROUND({m} + 3.0 * {s}, 6) AS upper_threshold, "
            f"COUNT(*) FILTER (WHERE CAST({c} AS DOUBLE) > {m} + 3.0 * {s}) AS n_upper, "
            f"COUNT(*) FILTER (WHERE CAST({c} AS DOUBLE) < {m} - 3.0 * {s}) AS n_lower FROM claims")
    return oracle("\nUNION ALL ".join(parts))


@register("dq_outliers", _outlier_sql())
def q_dq_outliers(spark, sf):
    """Counts beyond mean +- 3 sample stddev for the numeric claim columns."""
    return quality.outliers(_claims(spark, sf), 3.0, _NUMERIC_CLAIM_COLS)


# Values that the declared schema cannot hold, by column: the rows and the value
_UNPARSABLE = {
    "admit_date": ("length_of_stay = 3 AND age < 40", "'not-a-date'"),
    "claim_amount": ("length_of_stay = 5 AND age > 80", "'12,5'"),
    "denial_flag": ("comorbidity_count = 4 AND age > 70", "'x'"),
}


def _raw_sql(columns) -> list[str]:
    """Claims as text, with the unparsable values in their rows."""
    out = []
    for c in columns:
        text = f"CAST({c} AS STRING)"
        out.append(f"CASE WHEN {_UNPARSABLE[c][0]} THEN {_UNPARSABLE[c][1]} ELSE {text} END AS {c}" if c in _UNPARSABLE
                   else f"{text} AS {c}")
    return out


def _raw_claims(spark, sf):
    return _claims(spark, sf).selectExpr(*_raw_sql(_CLAIM_COLS))


_ANY_UNPARSABLE = " OR ".join(f"({cond})" for cond, _ in _UNPARSABLE.values())
_CONFORMITY_SQL = oracle("\nUNION ALL ".join(
    f"SELECT '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS expected_type, COUNT({f.name}) AS n_values, "
    + (f"COUNT(*) FILTER (WHERE {_UNPARSABLE[f.name][0]})" if f.name in _UNPARSABLE else "CAST(0 AS BIGINT)")
    + " AS n_nonconforming, CAST(0 AS BIGINT) AS n_missing FROM claims" for f in CLAIMS_SCHEMA.fields))


@register("dq_schema", _CONFORMITY_SQL)
def q_dq_schema(spark, sf):
    """Values of the raw claims that the declared schema cannot hold, per column."""
    return quality.conformity(_raw_claims(spark, sf), CLAIMS_SCHEMA)


def _rules_sql() -> str:
    return "concat_ws(',', " + ", ".join(
        f"CASE WHEN NOT COALESCE({cond}, FALSE) THEN '{name}' END"
        for name, cond in quality.CLAIM_RULES.items()) + ")"


# Claims that break one rule each, by column: the rows and the value
_BROKEN = {
    "claim_id": ("age = 70 AND length_of_stay = 0", "NULL"),
    "patient_id": ("age = 71 AND length_of_stay = 1", "NULL"),
    "claim_amount": ("length_of_stay = 1 AND age < 30", "0"),
    "paid_amount": ("length_of_stay = 2 AND age < 30", "-1"),
    "length_of_stay": ("age = 50", "400"),
    "age": ("comorbidity_count = 5 AND length_of_stay = 8", "17"),
    "gender": ("length_of_stay = 4 AND age > 80", "'X'"),
    "comorbidity_count": ("age = 60", "16"),
    "state": ("length_of_stay = 6 AND age > 70", "'Azores'"),
    "diagnosis_code": ("length_of_stay = 7 AND age > 75", "NULL"),
    "procedure_code": ("length_of_stay = 7 AND age < 25", "NULL"),
    "facility_type": ("length_of_stay = 9 AND age > 85", "NULL"),
    "payer_type": ("length_of_stay = 10 AND age > 85", "NULL"),
    "insurance_type": ("length_of_stay = 10 AND age < 22", "NULL"),
}
_BROKEN_COLS = [f"CASE WHEN {_BROKEN[c][0]} THEN {_BROKEN[c][1]} ELSE {c} END AS {c}" if c in _BROKEN else c
                for c in _CLAIM_COLS]


@register("validate_claims", oracle(f"""
SELECT claim_id, {_rules_sql()} AS failed_rules, {_rules_sql()} = '' AS is_valid FROM broken""",
                                    ctes=f"broken AS (SELECT {', '.join(_BROKEN_COLS)} FROM claims)"))
def q_validate(spark, sf):
    """Accepted-range rules per claim: failed rule names and a validity flag; the
    claims are given rows that break each rule."""
    broken = _claims(spark, sf).selectExpr(*_BROKEN_COLS)
    return quality.validate(broken).select("claim_id", "failed_rules", "is_valid")


_AS_DOUBLE_SQL = oracle("SELECT " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" if c in ("claim_amount", "paid_amount") else c for c in _CLAIM_COLS
) + " FROM claims")


@register("ingest_csv", _AS_DOUBLE_SQL)
def q_ingest_csv(spark, sf):
    """Claims written as CSV to the shared folder and read back with the
    declared schema; malformed rows would go to quarantine."""
    path = shared_path(spark, "claims-csv")
    files.write_csv(_claims(spark, sf), path)
    good, _bad = files.load_csv_quarantined(spark, path, CLAIMS_SCHEMA)
    return good


@register("ingest_all", _AS_DOUBLE_SQL)
def q_ingest_all(spark, sf):
    """CSV -> quarantine -> profile -> Parquet -> re-read Parquet (claims part)."""
    from claimspark.sources import adapter as ad

    c_csv, p_csv = shared_path(spark, "claims-csv"), shared_path(spark, "patients-csv")
    files.write_csv(ad.claims(spark, sf), c_csv)
    files.write_csv(ad.patients(spark, sf), p_csv)
    return files.ingest(spark, c_csv, p_csv).claims


@register("ingest_report", oracle(f"""
SELECT 'claims' AS table_name, COUNT(*) AS rows_read, COUNT(*) FILTER (WHERE NOT ({_ANY_UNPARSABLE})) AS rows_good,
       COUNT(*) FILTER (WHERE {_ANY_UNPARSABLE}) AS rows_bad FROM claims
UNION ALL
SELECT 'patients', COUNT(*), COUNT(*) FILTER (WHERE age % 10 <> 3), COUNT(*) FILTER (WHERE age % 10 = 3) FROM patients"""))
def q_ingest_report(spark, sf):
    """Lines read, parsed and quarantined when both CSV files hold values that the
    schema cannot hold."""
    from claimspark.sources import adapter as ad

    c_csv, p_csv = shared_path(spark, "claims-csv"), shared_path(spark, "patients-csv")
    files.write_csv(_raw_claims(spark, sf), c_csv)
    patients = ad.patients(spark, sf)
    files.write_csv(patients.withColumn("age", F.when(F.col("age") % 10 == 3, "old").otherwise(F.col("age").cast("string"))), p_csv)
    return files.ingest(spark, c_csv, p_csv).report


@register("incomplete_rows", oracle("SELECT claim_id FROM claims WHERE CAST(patient_id AS BIGINT) % 2 = 1"))
def q_incomplete_rows(spark, sf):
    """Model inputs that cannot be encoded when half the patients are unknown."""
    claims, patients = _tables(spark, sf)
    table = pipelines.feature_table(claims, patients.where("CAST(patient_id AS BIGINT) % 2 = 0"))
    return feat.incomplete_rows(feat.model_inputs(table)).select("claim_id")


@register("parquet_roundtrip", oracle("SELECT * FROM claims"))
def q_parquet_roundtrip(spark, sf):
    """Claims written as Parquet partitioned by payer_type and read back."""
    path = shared_path(spark, "claims-parquet")
    files.write_parquet(_claims(spark, sf), path, ["payer_type"])
    return spark.read.parquet(path).select(*_CLAIM_COLS)


# --------------------------------------------------------------------------
# Statistics (E15-E20)
# --------------------------------------------------------------------------
def _corr_sql() -> str:
    from itertools import combinations

    cols = stats.CORRELATION_COLUMNS
    parts = [f"SELECT '{b}' AS x, '{a}' AS y, ROUND(CORR(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS r FROM claims"
             for a, b in combinations(cols, 2)]
    return oracle("\nUNION ALL ".join(parts))


@register("correlation_matrix", _corr_sql())
def q_corr(spark, sf):
    """Pearson correlations of 7 claim columns over all rows (lower triangle)."""
    return stats.correlation_matrix(_claims(spark, sf))


@register("cost_histogram", oracle("""
SELECT bin, b.lo + CAST(bin AS DOUBLE) * ((b.hi - b.lo) / 80.0) AS bin_lo,
       b.lo + CAST(bin + 1 AS DOUBLE) * ((b.hi - b.lo) / 80.0) AS bin_hi, n
FROM (SELECT CAST(LEAST(FLOOR((CAST(claim_amount AS DOUBLE) - b.lo) / (b.hi - b.lo) * 80.0), 79) AS INTEGER) AS bin,
             COUNT(*) AS n
      FROM claims, bounds b GROUP BY 1) h, bounds b""", ctes="""
bounds AS (SELECT MIN(CAST(claim_amount AS DOUBLE)) AS lo, MAX(CAST(claim_amount AS DOUBLE)) AS hi FROM claims)"""))
def q_hist(spark, sf):
    """80 equal-width bins of claim_amount over [min, max], all rows."""
    return stats.histogram(_claims(spark, sf), "claim_amount", 80)


def _pct_sql(col: str, probs: list[tuple[float, str]], by: str | None) -> str:
    part = f"PARTITION BY {by}" if by else ""
    grp = f"{by}, " if by else ""
    sel = []
    for p, name in probs:
        h = f"(CAST(n - 1 AS DOUBLE) * {p})"
        lo = f"MAX(CASE WHEN i = CAST(FLOOR({h}) AS BIGINT) THEN v END)"
        hi = f"MAX(CASE WHEN i = CAST(CEIL({h}) AS BIGINT) THEN v END)"
        frac = f"MAX({h} - FLOOR({h}))"
        sel.append(f"{lo} + {frac} * ({hi} - {lo}) AS {name}")
    return f"""SELECT {grp}{', '.join(sel)}
FROM (SELECT {grp}CAST({col} AS DOUBLE) AS v,
             ROW_NUMBER() OVER ({part} ORDER BY CAST({col} AS DOUBLE)) - 1 AS i,
             COUNT(*) OVER ({part}) AS n
      FROM claims WHERE {col} IS NOT NULL) s
{'GROUP BY ' + by if by else ''}"""


@register("cost_quantiles", oracle(_pct_sql("claim_amount", [(0.25, "p25"), (0.5, "p50"), (0.75, "p75")], None)))
def q_quantiles(spark, sf):
    """Exact quartiles and median of claim_amount (distributed selection)."""
    return stats.exact_percentiles(_claims(spark, sf), "claim_amount", [0.25, 0.5, 0.75])


@register("cost_boxplot", oracle("""
SELECT q.facility_type, q.q1, q.median, q.q3, q.q3 - q.q1 AS iqr,
       MIN(CASE WHEN CAST(c.claim_amount AS DOUBLE) >= q.q1 - 1.5 * (q.q3 - q.q1) THEN CAST(c.claim_amount AS DOUBLE) END) AS whisker_low,
       MAX(CASE WHEN CAST(c.claim_amount AS DOUBLE) <= q.q3 + 1.5 * (q.q3 - q.q1) THEN CAST(c.claim_amount AS DOUBLE) END) AS whisker_high
FROM claims c JOIN q ON c.facility_type = q.facility_type
GROUP BY q.facility_type, q.q1, q.median, q.q3""", ctes="q AS (" + _pct_sql(
    "claim_amount", [(0.25, "q1"), (0.5, "median"), (0.75, "q3")], "facility_type") + ")"))
def q_boxplot(spark, sf):
    """Per-facility quartiles and 1.5 IQR whiskers of claim_amount."""
    return stats.box_stats(_claims(spark, sf), "claim_amount", ["facility_type"])


@register("age_los_trend", oracle("""
SELECT ROUND(REGR_SLOPE(CAST(length_of_stay AS DOUBLE), CAST(age AS DOUBLE)), 6) AS slope,
       ROUND(REGR_INTERCEPT(CAST(length_of_stay AS DOUBLE), CAST(age AS DOUBLE)), 6) AS intercept,
       CAST(REGR_COUNT(CAST(length_of_stay AS DOUBLE), CAST(age AS DOUBLE)) AS BIGINT) AS n
FROM claims"""))
def q_trend(spark, sf):
    """Least-squares trend of length_of_stay on age over all rows."""
    return stats.linear_trend(_claims(spark, sf))


@register("age_los_grid", oracle(f"""
SELECT age, length_of_stay, COUNT(*) AS n, {_mean('comorbidity_count')} AS avg_comorbidity,
       {_mean('readmission_30day')} AS readmit_rate
FROM claims GROUP BY age, length_of_stay"""))
def q_grid(spark, sf):
    return stats.age_los_grid(_claims(spark, sf))


# --------------------------------------------------------------------------
# Evaluation on a deterministic score (L1-L11, N3)
# --------------------------------------------------------------------------
def _scored(spark, sf) -> DataFrame:
    """label = readmission; score = a ratio of whole numbers with tens of thousands
    of values (model-free, exact): comorbidities, diagnosis risk and cents."""
    df = feat.add_diagnosis_risk_score(_claims(spark, sf))
    whole = (F.col("comorbidity_count") + F.col("diagnosis_risk_score")) * 5000 \
        + (F.col("claim_amount") * 100).cast("bigint") % 1000
    return df.select("claim_id", F.col("readmission_30day").alias("label"),
                     (whole.cast("double") / F.lit(76003.0)).alias("score"))


_SCORED_CTES = f"""
scored AS (SELECT claim_id, readmission_30day AS label,
                  CAST((comorbidity_count + {_risk_sql()}) * 5000 + CAST(claim_amount * 100 AS BIGINT) % 1000 AS DOUBLE)
                  / CAST(76003.0 AS DOUBLE) AS score
           FROM claims),
per AS (SELECT score AS threshold, COUNT(*) FILTER (WHERE label = 1) AS p,
               COUNT(*) FILTER (WHERE label = 0) AS n FROM scored GROUP BY score),
tot AS (SELECT CAST(SUM(p) AS BIGINT) AS pos, CAST(SUM(n) AS BIGINT) AS neg FROM per),
cum AS (SELECT threshold, p, n,
               CAST(SUM(p) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp,
               CAST(SUM(n) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp
        FROM per),
pts AS (SELECT c.*, c.tp - c.p AS prev_tp, c.fp - c.n AS prev_fp,
               CAST(c.tp AS DOUBLE) / CAST(GREATEST(t.pos, 1) AS DOUBLE) AS tpr,
               CAST(c.fp AS DOUBLE) / CAST(GREATEST(t.neg, 1) AS DOUBLE) AS fpr,
               CAST(c.tp AS DOUBLE) / CAST(c.tp + c.fp AS DOUBLE) AS precision,
               CAST(c.tp AS DOUBLE) / CAST(GREATEST(t.pos, 1) AS DOUBLE) AS recall,
               t.pos, t.neg
        FROM cum c, tot t)"""


@register("roc_curve", oracle("SELECT threshold, tp, fp, tpr, fpr FROM pts", ctes=_SCORED_CTES))
def q_roc(spark, sf):
    """ROC points per distinct score (cumulative counts by distributed scan)."""
    return ev.roc_curve(_scored(spark, sf))


@register("pr_curve", oracle("SELECT threshold, tp, fp, precision, recall FROM pts", ctes=_SCORED_CTES))
def q_pr(spark, sf):
    return ev.pr_curve(_scored(spark, sf))


@register("auc_roc", oracle("""
SELECT CAST(SUM((fp - prev_fp) * (tp + prev_tp)) AS DOUBLE)
       / (2.0 * CAST(MAX(pos) AS DOUBLE) * CAST(MAX(neg) AS DOUBLE)) AS auc_roc FROM pts""", ctes=_SCORED_CTES))
def q_auc(spark, sf):
    """Exact trapezoid AUC-ROC of the deterministic score."""
    return ev.auc_roc(_scored(spark, sf))


@register("average_precision", oracle("""
SELECT ROUND(SUM((CAST(tp - prev_tp AS DOUBLE) / CAST(pos AS DOUBLE)) * precision), 10) AS average_precision
FROM pts""", ctes=_SCORED_CTES))
def q_ap(spark, sf):
    return ev.average_precision(_scored(spark, sf))


@register("best_threshold", oracle("""
SELECT threshold, precision, recall, f1 FROM (
  SELECT threshold, precision, recall,
         2.0 * precision * recall / (precision + recall + 1e-10) AS f1 FROM pts)
ORDER BY f1 DESC, threshold ASC LIMIT 1""", ctes=_SCORED_CTES))
def q_best_threshold(spark, sf):
    """F1-optimal operating threshold on the PR curve."""
    return ev.best_threshold(_scored(spark, sf))


def _threshold_sql() -> str:
    parts = []
    for t in THRESHOLDS:
        f = f"COUNT(*) FILTER (WHERE score >= {t})"
        tp = f"COUNT(*) FILTER (WHERE score >= {t} AND label = 1)"
        parts.append(
            f"SELECT CAST({t} AS DOUBLE) AS threshold, "
            f"ROUND(CASE WHEN {f} = 0 THEN 0.0 ELSE CAST({tp} AS DOUBLE) / CAST({f} AS DOUBLE) END, 3) AS precision, "
            f"ROUND(CAST({tp} AS DOUBLE) / CAST(GREATEST(COUNT(*) FILTER (WHERE label = 1), 1) AS DOUBLE), 3) AS recall, "
            f"ROUND(CAST({f} AS DOUBLE) / CAST(COUNT(*) AS DOUBLE), 3) AS flag_rate, "
            f"{f} AS patients_flagged FROM scored")
    return oracle("\nUNION ALL ".join(parts), ctes=_SCORED_CTES)


@register("threshold_table", _threshold_sql())
def q_threshold_table(spark, sf):
    """Precision / recall / flag rate at the fixed operating thresholds."""
    return ev.threshold_table(_scored(spark, sf))


_PRED = "CAST(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS INTEGER)"


@register("confusion_matrix", oracle(f"""
SELECT CAST(label AS INTEGER) AS label, {_PRED} AS prediction, COUNT(*) AS n FROM scored GROUP BY 1, 2""",
                                     ctes=_SCORED_CTES))
def q_confusion(spark, sf):
    s = _scored(spark, sf).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    return ev.confusion_matrix(s)


def _cls_sql() -> str:
    def safe(a, b):
        return f"(CASE WHEN {b} > 0 THEN {a} / {b} ELSE 0.0 END)"

    tp, fp, tn, fn = "tp", "fp", "tn", "fn"
    n = f"({tp} + {fp} + {tn} + {fn})"
    p1, r1 = safe(tp, f"({tp} + {fp})"), safe(tp, f"({tp} + {fn})")
    p0, r0 = safe(tn, f"({tn} + {fn})"), safe(tn, f"({tn} + {fp})")
    f11, f10 = safe(f"2.0 * {p1} * {r1}", f"({p1} + {r1})"), safe(f"2.0 * {p0} * {r0}", f"({p0} + {r0})")
    w1, w0 = f"(({tp} + {fn}) / {n})", f"(({tn} + {fp}) / {n})"
    return oracle(f"""
SELECT ({tp} + {tn}) / {n} AS accuracy, {w0} * {p0} + {w1} * {p1} AS weighted_precision,
       {w0} * {r0} + {w1} * {r1} AS weighted_recall, {w0} * {f10} + {w1} * {f11} AS weighted_f1
FROM (SELECT CAST(COUNT(*) FILTER (WHERE label = 1 AND {_PRED} = 1) AS DOUBLE) AS tp,
             CAST(COUNT(*) FILTER (WHERE label = 0 AND {_PRED} = 1) AS DOUBLE) AS fp,
             CAST(COUNT(*) FILTER (WHERE label = 0 AND {_PRED} = 0) AS DOUBLE) AS tn,
             CAST(COUNT(*) FILTER (WHERE label = 1 AND {_PRED} = 0) AS DOUBLE) AS fn FROM scored) c""",
                  ctes=_SCORED_CTES)


@register("classification_metrics", _cls_sql())
def q_cls(spark, sf):
    """Accuracy and support-weighted precision/recall/F1 at threshold 0.5."""
    s = _scored(spark, sf).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    return ev.classification_metrics(s)


@register("risk_tiers", oracle("""
SELECT claim_id, ROUND(score, 4) AS probability, ROUND(score * 100.0, 1) AS risk_score,
       CASE WHEN score >= 0.5 THEN 'High' WHEN score >= 0.25 THEN 'Medium' ELSE 'Low' END AS risk_tier
FROM scored""", ctes=_SCORED_CTES))
def q_risk_tiers(spark, sf):
    """Risk tier of each claim from the deterministic score."""
    from claimspark.functions import risk_tier

    s = _scored(spark, sf)
    return s.select("claim_id", F.round("score", 4).alias("probability"),
                    F.round(F.col("score") * F.lit(100.0), 1).alias("risk_score"),
                    risk_tier("score").alias("risk_tier"))


# --------------------------------------------------------------------------
# Sampling and splits (G7-G9, B7)
# --------------------------------------------------------------------------
from claimspark.operators import sampling  # noqa: E402


_BUCKET = "CAST('0x' || substr(md5(claim_id || ':42'), 1, 13) AS BIGINT) % 10000"
_SPLIT = f"CASE WHEN {_BUCKET} < 8000 THEN 'train' ELSE 'test' END"


@register("hash_sample", oracle(f"SELECT * FROM claims WHERE {_BUCKET} < 500"))
def q_hash_sample(spark, sf):
    """About 5 % of claims chosen by a seeded hash of claim_id (sampling operator)."""
    return sampling.hash_sample(_claims(spark, sf), 0.05, 42)


@register("train_test_split", oracle(f"SELECT claim_id, readmission_30day, {_SPLIT} AS split FROM claims"))
def q_split(spark, sf):
    """80/20 hash split of claims; returns claim_id, label and split."""
    return sampling.with_split(_claims(spark, sf)).select("claim_id", "readmission_30day", "split")


@register("stratified_split", oracle("""
SELECT claim_id, readmission_30day, CASE WHEN rk <= ROUND(n * 0.8) THEN 'train' ELSE 'test' END AS split
FROM (SELECT claim_id, readmission_30day, COUNT(*) OVER (PARTITION BY readmission_30day) AS n,
             ROW_NUMBER() OVER (PARTITION BY readmission_30day ORDER BY md5(claim_id || ':42'), claim_id) AS rk FROM claims)"""))
def q_stratified(spark, sf):
    """Per-class exact 80/20 split ranked by seeded hash (distributed scan)."""
    return sampling.stratified_split(_claims(spark, sf), "readmission_30day").select(
        "claim_id", "readmission_30day", "split")


@register("sample_n", oracle("SELECT * FROM claims ORDER BY md5(claim_id || ':42'), claim_id LIMIT 100"))
def q_sample_n(spark, sf):
    """Exactly 100 claims without replacement (sampling operator)."""
    return sampling.hash_sample_n(_claims(spark, sf), 100)


@register("rates_train_only", oracle(f"""
SELECT claim_id, provider_denial_rate, provider_claim_volume, payer_approval_rate
FROM s LEFT JOIN pv ON s.provider_id = pv.provider_id LEFT JOIN py ON s.payer_type = py.payer_type WHERE split = 'test'""", ctes=f"""
s AS (SELECT *, {_SPLIT} AS split FROM claims),
pv AS (SELECT provider_id, {_mean('denial_flag')} AS provider_denial_rate, COUNT(claim_id) AS provider_claim_volume
       FROM s WHERE split = 'train' GROUP BY provider_id),
py AS (SELECT payer_type, CAST(1.0 AS DOUBLE) - {_mean('denial_flag')} AS payer_approval_rate
       FROM s WHERE split = 'train' GROUP BY payer_type)"""))
def q_rates_train_only(spark, sf):
    """Provider and payer rates fitted on the training split, applied to the test split."""
    rows = sampling.with_split(_claims(spark, sf))
    fitted = rates.fit_rates(rows.where("split = 'train'"))
    return rates.apply_rates(rows.where("split = 'test'"), fitted).select(
        "claim_id", "provider_denial_rate", "provider_claim_volume", "payer_approval_rate")


@register("split_balance", oracle(f"""
SELECT {_SPLIT} AS split, COUNT(*) AS rows, CAST(SUM(readmission_30day) AS DOUBLE) / COUNT(readmission_30day) AS positive_rate
FROM claims GROUP BY 1"""))
def q_split_balance(spark, sf):
    """Rows and positive rate per split of the hash split."""
    return sampling.split_balance(sampling.with_split(_claims(spark, sf)), "readmission_30day")


# --------------------------------------------------------------------------
# Models, evaluation, attribution, scoring, results (K*, L1-L6, M*, N*, A9-A13)
# --------------------------------------------------------------------------
_STATE: dict = {}


def _prepared(spark, sf):
    """Feature table -> model inputs -> landed split; memoised per sf_dir
    within this process so several queries share one training run."""
    from claimspark.plans import training

    key = (spark.sparkContext.applicationId, sf)
    if key not in _STATE:
        _STATE[key] = training.prepare(pipelines.feature_table(*_tables(spark, sf)))
    return _STATE[key]


def _model(spark, sf, kind):
    from claimspark.plans import training

    return training.classifier(training.fit(_prepared(spark, sf), kind))


def _metrics(spark, sf, kind):
    from claimspark.operators import models as M

    return M.evaluate(_model(spark, sf, kind), _prepared(spark, sf).ptest, kind)


@register("lr_metrics")
def q_lr_metrics(spark, sf):
    """Weighted logistic regression: AUC-ROC/PR, F1, accuracy, precision, recall."""
    return _metrics(spark, sf, "logistic_regression")


@register("rf_cv")
def q_rf_cv(spark, sf):
    """Random forest grid (numTrees x maxDepth x maxBins) with 3-fold CV; best params."""
    from claimspark.operators import models as M
    from claimspark.plans import training

    p = _prepared(spark, sf)
    cv = training.fit(p, "random_forest")
    # the best parameters, then the mean AUC of each combination in grid order
    rows = [(k, float(v)) for k, v in M.best_params(cv).items()]
    rows += [(f"cv_auc_{i}", float(a)) for i, a in enumerate(cv.avgMetrics)]
    return spark.createDataFrame(rows, "param string, value double")


@register("rf_metrics")
def q_rf_metrics(spark, sf):
    return _metrics(spark, sf, "random_forest")


@register("gbt_metrics")
def q_gbt_metrics(spark, sf):
    """Gradient-boosted trees (class-weighted) test metrics."""
    return _metrics(spark, sf, "gradient_boosted_trees")


@register("model_comparison")
def q_model_comparison(spark, sf):
    """metric x model table with the winner per metric."""
    from claimspark.operators import models as M

    m = None
    for k in ("logistic_regression", "random_forest", "gradient_boosted_trees"):
        x = _metrics(spark, sf, k)
        m = x if m is None else m.unionByName(x)
    return M.compare_models(m)


@register("feature_importance")
def q_feature_importance(spark, sf):
    """RF Gini and LR |coef| importances named from vector metadata (top 20 each)."""
    from claimspark.operators import models as M
    from pyspark.sql import Window

    p = _prepared(spark, sf)
    a = M.feature_importance(_model(spark, sf, "random_forest"), p.names, "tree").withColumn("model", F.lit("random_forest"))
    b = M.feature_importance(_model(spark, sf, "logistic_regression"), p.names, "linear").withColumn(
        "model", F.lit("logistic_regression"))
    w = Window.partitionBy("model").orderBy(F.col("importance").desc(), F.col("feature"))
    return a.unionByName(b).withColumn("rank", F.row_number().over(w)).where("rank <= 20")


@register("model_results")
def q_model_results(spark, sf):
    """Save metrics/params/importances for LR and RF, read them back, summarise each."""
    from claimspark.operators import models as M
    from claimspark.plans import training
    from claimspark.sources import results as R

    p, kinds = _prepared(spark, sf), ["logistic_regression", "random_forest"]
    metrics = imps = None
    for k in kinds:
        m = _metrics(spark, sf, k)
        imp = M.feature_importance(_model(spark, sf, k), p.names, training.importance_kind(k)).withColumn("model", F.lit(k))
        metrics, imps = (m, imp) if metrics is None else (metrics.unionByName(m), imps.unionByName(imp))
    out = shared_path(spark, "model-results")
    R.save_results(out, metrics, {k: M.best_params(training.fit(p, k)) for k in kinds}, imps)
    return R.stats_summaries(R.load_results(spark, out), kinds, p.train.unionByName(p.test))


def _lr_phis(spark, sf):
    from claimspark.operators import explain

    p = _prepared(spark, sf)
    return explain.linear_attributions(p.ptest, _model(spark, sf, "logistic_regression"), p.names, p.ptrain)


@register("explain_rows")
def q_explain_rows(spark, sf):
    """Per-claim, per-feature attributions (phi) of the LR margin on the test split."""
    return _lr_phis(spark, sf)


@register("explain_global")
def q_explain_global(spark, sf):
    """Mean |phi| per feature over every test row, top 15."""
    from claimspark.operators import explain

    p = _prepared(spark, sf)
    return explain.global_linear(p.ptest, _model(spark, sf, "logistic_regression"), p.names, p.ptrain, 15)


@register("explain_top_patient")
def q_explain_top(spark, sf):
    """12 largest attributions of the highest-risk test claim."""
    from claimspark.operators import explain
    from claimspark.operators import models as M

    p = _prepared(spark, sf)
    lr = _model(spark, sf, "logistic_regression")
    scored = M.score(lr, p.ptest)
    phis = explain.linear_attributions(explain.highest_row(p.ptest, scored), lr, p.names, p.ptrain)
    return explain.top_row_explanation(phis, scored, 12)


_HISTORY_CUT = "1998-01-01"


def _scoring_sql() -> str:
    from claimspark.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES

    cols = {
        "provider_denial_rate": "COALESCE(pv.provider_denial_rate, 0.12)",
        "provider_claim_volume": "COALESCE(pv.provider_claim_volume, 100)",
        "payer_approval_rate": "COALESCE(py.payer_approval_rate, 0.88)",
        "patient_avg_claim": "COALESCE(pt.patient_avg_claim, CAST(claim_amount AS DOUBLE))",
        "patient_total_claims": "COALESCE(pt.patient_total_claims, 1)",
        "cost_ratio_to_patient_avg": "CASE WHEN COALESCE(pt.patient_avg_claim, CAST(claim_amount AS DOUBLE)) > 0 "
                                     "THEN CAST(claim_amount AS DOUBLE) / COALESCE(pt.patient_avg_claim, "
                                     "CAST(claim_amount AS DOUBLE)) ELSE 1.0 END",
        "rolling_cost_90d": "CAST(t.rolling AS DOUBLE)",
        "claim_count_90d": "CAST(t.near AS BIGINT)",
        "days_since_last_claim": "CAST(COALESCE(t.days, -1) AS INTEGER)",
        "prev_denial_flag": "CAST(COALESCE(t.denied, 0) AS INTEGER)",
        "prev_claim_amount": "CAST(COALESCE(t.amount, 0.0) AS DOUBLE)",
        "claim_sequence": "CAST(t.seq AS INTEGER)",
    }
    sel = []
    for c in NUMERIC_FEATURES:
        sel.append(f"{cols[c]} AS {c}" if c in cols else f"f.{c}")
    return oracle(f"""
SELECT f.claim_id, {', '.join(sel)}, {', '.join('f.' + c for c in CATEGORICAL_FEATURES)}
FROM f
LEFT JOIN py ON f.payer_type = py.payer_type
LEFT JOIN pv ON f.provider_id = pv.provider_id
LEFT JOIN pt ON f.patient_id = pt.patient_id
JOIN t ON f.claim_id = t.claim_id""", ctes=f"""
t AS (SELECT claim_id, SUM(claim_amount) OVER near AS rolling, COUNT(claim_id) OVER near AS near,
             date_diff('day', LAG(admit_date) OVER own, admit_date) AS days, LAG(denial_flag) OVER own AS denied,
             LAG(claim_amount) OVER own AS amount, ROW_NUMBER() OVER own AS seq FROM claims
      WINDOW own AS (PARTITION BY patient_id ORDER BY admit_date, claim_id),
             near AS (PARTITION BY patient_id ORDER BY admit_date RANGE BETWEEN INTERVAL 90 DAY PRECEDING AND CURRENT ROW)),
hist AS (SELECT * FROM claims WHERE admit_date < DATE '{_HISTORY_CUT}'),
py AS (SELECT payer_type, CAST(1.0 AS DOUBLE) - {_mean('denial_flag')} AS payer_approval_rate FROM hist GROUP BY payer_type),
pv AS (SELECT provider_id, {_mean('denial_flag')} AS provider_denial_rate,
              COUNT(claim_id) AS provider_claim_volume FROM hist GROUP BY provider_id),
pt AS (SELECT patient_id, {_mean('claim_amount')} AS patient_avg_claim,
              COUNT(claim_id) AS patient_total_claims FROM hist GROUP BY patient_id),
f AS (SELECT *, {_row_features_sql()} FROM claims WHERE admit_date >= DATE '{_HISTORY_CUT}')""")


@register("scoring_inputs", _scoring_sql())
def q_scoring_inputs(spark, sf):
    """Model inputs for claims admitted from 1998 on: timeline and rates from the
    earlier claims when known, cold-start defaults otherwise."""
    from claimspark.operators import scoring

    c = _claims(spark, sf)
    past = c.where(F.col("admit_date") < F.lit(_HISTORY_CUT).cast("date"))
    new = c.where(F.col("admit_date") >= F.lit(_HISTORY_CUT).cast("date"))
    return scoring.scoring_inputs(new, scoring.fit_history(past), past)


def _trained_history(spark, sf):
    """Rates and means of the claims that the model was trained on."""
    from claimspark.operators import scoring

    return scoring.fit_history(sampling.with_split(_claims(spark, sf)).where("split = 'train'"))


def _score_all(spark, sf):
    """Every claim, scored by the saved and loaded LR pipeline: validation, the timeline
    of its patient's earlier claims, known rates, probability, risk score and tier."""
    from claimspark.operators import scoring
    from claimspark.sources import results as R

    p = _prepared(spark, sf)
    path = shared_path(spark, "scoring-model")
    R.save_fitted(spark, p.preprocessing, _model(spark, sf, "logistic_regression"), path)
    pre, clf = R.load_fitted(spark, path)
    c = _claims(spark, sf)
    # no claims before the table's own: each one's past is its patient's earlier claims in it
    scored, _rejected = scoring.score_claims(c, pre, clf, _trained_history(spark, sf), past=c.limit(0))
    return scored


@register("score_claims")
def q_score_claims(spark, sf):
    """Batch scoring of every claim: probability, risk score, tier, summary."""
    return _score_all(spark, sf)


@register("scored_summary", oracle(f"""
SELECT claim_id, age, diagnosis_code AS diagnosis, facility_type, claim_amount, comorbidity_count
FROM claims WHERE {_rules_sql()} = ''"""))
def q_scored_summary(spark, sf):
    """The input summary of every scored claim."""
    return _score_all(spark, sf).select("claim_id", "input_summary.*") \
        .withColumn("claim_amount", F.col("claim_amount").cast("decimal(18,2)"))


@register("scored_checks", oracle(f"""
SELECT claim_id, TRUE AS in_range, TRUE AS score_fits, TRUE AS tier_fits FROM claims WHERE {_rules_sql()} = ''"""))
def q_scored_checks(spark, sf):
    """Whether each claim's probability, risk score and tier agree: the score is the
    probability in hundredths (both rounded), the tier that of its range."""
    from claimspark.schemas import RISK_TIER_BOTTOM, RISK_TIERS

    p, s = F.col("readmission_probability"), F.col("risk_score")
    names = [(label, lower) for lower, label in RISK_TIERS] + [(RISK_TIER_BOTTOM, 0.0)]
    above = 1.0
    fits = F.lit(False)
    for label, lower in names:
        # a rounded probability may touch the bound of the tier above
        fits = fits | ((F.col("risk_tier") == label) & (p >= lower) & (p <= above))
        above = lower
    return _score_all(spark, sf).select("claim_id", p.between(0, 1).alias("in_range"),
                                        (F.abs(s - 100 * p) <= 0.0551).alias("score_fits"), fits.alias("tier_fits"))


def _rf_phis(spark, sf):
    """TreeSHAP of the tuned random forest's P(readmit) on every test row."""
    from claimspark.operators import treeshap

    p = _prepared(spark, sf)
    key = ("rf_phis", spark.sparkContext.applicationId, sf)
    if key not in _STATE:
        from claimspark.session import materialize

        phis, base = treeshap.explain_trees(p.ptest, _model(spark, sf, "random_forest"))
        _STATE[key] = (materialize(phis, "rf-shap"), base)
    return _STATE[key]


@register("explain_tree_global")
def q_explain_tree_global(spark, sf):
    """Random forest: mean |SHAP| per feature over all test rows, top 15."""
    from claimspark.operators import explain

    return explain.global_importance(_rf_phis(spark, sf)[0], 15)


@register("explain_tree_top_patient")
def q_explain_tree_top(spark, sf):
    """Random forest: base value and the 12 largest SHAP values of the highest-risk test claim."""
    from claimspark.operators import explain
    from claimspark.operators import models as M

    from claimspark.operators import treeshap

    p = _prepared(spark, sf)
    model = _model(spark, sf, "random_forest")
    scored = M.score(model, p.ptest)
    phis, base = treeshap.explain_trees(explain.highest_row(p.ptest, scored), model)
    return explain.top_row_explanation(phis, scored, 12).withColumn("base_value", F.lit(base))


def _claim_files(spark, sf, files: int = 4, periods: int = 3) -> str:
    """The claims as files in the order of their dates: ``files`` for each of ``periods``
    runs of years."""
    claims, src = _claims(spark, sf), shared_path(spark, "incoming-claims")
    year = F.year("admit_date")
    years = [r[0] for r in claims.where(year.isNotNull()).select(year).distinct().orderBy(year).collect()]
    starts = sorted({years[i * len(years) // periods] for i in range(periods)}) if years else []
    for k, low in enumerate(starts):
        some = year >= low if k else year.isNull() | (year >= low)
        if k + 1 < len(starts):
            some = some & (year.isNull() | (year < starts[k + 1]))
        claims.where(some).repartition(files).write.mode("append").parquet(src)
    if not starts:
        claims.write.parquet(src)
    return src


@register("stream_claim_timeline", oracle("""
SELECT claim_id, CAST(SUM(claim_amount) OVER near AS DOUBLE) AS rolling_cost_90d, COUNT(claim_id) OVER near AS claim_count_90d,
       CAST(date_diff('day', LAG(admit_date) OVER own, admit_date) AS INTEGER) AS days_since_last_claim,
       LAG(denial_flag) OVER own AS prev_denial_flag, LAG(claim_amount) OVER own AS prev_claim_amount,
       CAST(ROW_NUMBER() OVER own AS INTEGER) AS claim_sequence FROM claims
WINDOW own AS (PARTITION BY patient_id ORDER BY admit_date, claim_id),
       near AS (PARTITION BY patient_id ORDER BY admit_date RANGE BETWEEN INTERVAL 90 DAY PRECEDING AND CURRENT ROW)"""))
def q_stream_timeline(spark, sf):
    """The timeline of every claim from a stream's keyed state, a micro-batch for each run
    of years; the same as window functions over the whole table."""
    from claimspark.streaming.scoring import claim_stream
    from claimspark.streaming.timeline import add_timeline

    stream = claim_stream(spark, _claim_files(spark, sf), _claims(spark, sf).schema, max_files_per_trigger=4)
    out = shared_path(spark, "streamed-timeline")
    slim = stream.select("claim_id", "patient_id", "admit_date", "claim_amount", "denial_flag")
    q = add_timeline(slim).writeStream.format("parquet").outputMode("append").option("path", out) \
        .option("checkpointLocation", shared_path(spark, "timeline-ckpt")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out).select("claim_id", F.col("rolling_cost_90d").cast("double").alias("rolling_cost_90d"), "claim_count_90d", "days_since_last_claim", "prev_denial_flag",
                                          "prev_claim_amount", "claim_sequence")


@register("stream_score_claims")
def q_stream_score(spark, sf):
    """Structured Streaming scorer over claim files in the order of their dates
    (availableNow trigger, keyed state, checkpointed, foreachBatch sinks); returns the
    scored rows, the same as ``score_claims``."""
    from claimspark.streaming.scoring import claim_stream, start_scoring
    from pyspark.ml import PipelineModel

    p = _prepared(spark, sf)
    out = shared_path(spark, "streamed-scores")
    stream = claim_stream(spark, _claim_files(spark, sf), _claims(spark, sf).schema, max_files_per_trigger=4)
    q = start_scoring(stream, PipelineModel(stages=p.preprocessing.stages), _model(spark, sf, "logistic_regression"),
                      _trained_history(spark, sf), out, available_now=True)
    q.awaitTermination()
    return spark.read.parquet(out).drop("batch")
