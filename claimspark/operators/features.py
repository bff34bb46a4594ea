"""Row-level clinical features, the feature table and its vector encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark import functions as cf
from claimspark.operators.rates import add_cost_features, add_rates
from claimspark.schemas import (
    CATEGORICAL_FEATURES,
    LABEL,
    NUMERIC_FEATURES,
    TEMPORAL_FILL,
    TRAINING_FILL,
)


def add_diagnosis_risk_score(df: DataFrame) -> DataFrame:
    return df.withColumn("diagnosis_risk_score", cf.diagnosis_risk("diagnosis_code"))


def add_los_ratio(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "los_vs_expected_ratio",
        cf.ratio_or("length_of_stay", cf.expected_los("diagnosis_code"), 1.0),
    )


def add_age_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn("age_bucket", cf.age_bucket("age"))


def add_comorbidity_index(df: DataFrame) -> DataFrame:
    """0.5 * comorbidity_count + 0.5 * diagnosis_risk_score (needs the risk score)."""
    return df.withColumn(
        "comorbidity_index",
        F.col("comorbidity_count") * F.lit(0.5) + F.col("diagnosis_risk_score") * F.lit(0.5),
    )


def add_row_features(df: DataFrame) -> DataFrame:
    """All per-row features in one projection (no shuffles)."""
    risk = cf.diagnosis_risk("diagnosis_code")
    return df.withColumns({
        "diagnosis_risk_score": risk,
        "los_vs_expected_ratio": cf.ratio_or("length_of_stay", cf.expected_los("diagnosis_code"), 1.0),
        "age_bucket": cf.age_bucket("age"),
        "comorbidity_index": F.col("comorbidity_count") * F.lit(0.5) + risk * F.lit(0.5),
    })


def engineer_features(enriched: DataFrame, land: bool = True, claims: DataFrame | None = None) -> DataFrame:
    """Feature table: row features, provider/payer rates and patient cost
    features (each group feature is an aggregate joined back, never a
    window over a low-cardinality or hot key).

    ``land`` writes the input once to the shared folder first, so the
    aggregate branches and their size checks read files, not the lineage. Given the
    ``claims`` that were enriched, the rates are aggregated from these and nothing is landed.
    """
    from claimspark.session import materialize

    df = add_row_features(enriched)
    if land and claims is None:
        df = materialize(df, "enriched")
    df = add_rates(df, claims)
    if "patient_avg_claim" not in df.columns:
        df = add_cost_features(df)
    return df


def fill_temporal(df: DataFrame) -> DataFrame:
    return df.fillna({k: v for k, v in TEMPORAL_FILL.items() if k in df.columns})


def fill_training(df: DataFrame) -> DataFrame:
    return df.fillna({k: v for k, v in TRAINING_FILL.items() if k in df.columns})


def model_inputs(features: DataFrame, keep: tuple[str, ...] = ("claim_id",)) -> DataFrame:
    """The model's input columns (20 numeric + 4 categorical + label), filled
    and with the label cast to int."""
    df = fill_training(features)
    cols = [*keep, *NUMERIC_FEATURES, *CATEGORICAL_FEATURES]
    return df.select(*cols, F.col(LABEL).cast("int").alias(LABEL))


def has_null_input():
    """Whether a row lacks a numeric model input (a null category has its own slot)."""
    cond = F.lit(False)
    for c in NUMERIC_FEATURES:
        cond = cond | F.col(c).isNull()
    return cond


def incomplete_rows(df: DataFrame) -> DataFrame:
    """Rows that cannot be encoded: a null in a numeric model input."""
    return df.where(has_null_input())


def complete_rows(df: DataFrame) -> DataFrame:
    return df.where(~has_null_input())


def encoding_stages(output_col: str = "raw_features", scaled_col: str | None = "scaled_features"):
    """StringIndexer(keep) -> OneHotEncoder(dropLast) -> VectorAssembler(error)
    [-> StandardScaler(withStd, no centring)]. Incomplete rows are split off before
    (``incomplete_rows``); the assembler raises on any that is left."""
    from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler

    idx = [f"{c}_idx" for c in CATEGORICAL_FEATURES]
    ohe = [f"{c}_ohe" for c in CATEGORICAL_FEATURES]
    stages = [
        StringIndexer(inputCols=CATEGORICAL_FEATURES, outputCols=idx, handleInvalid="keep"),
        OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True),
        VectorAssembler(inputCols=NUMERIC_FEATURES + ohe, outputCol=output_col, handleInvalid="error"),
    ]
    if scaled_col:
        stages.append(StandardScaler(inputCol=output_col, outputCol=scaled_col, withMean=False, withStd=True))
    return stages


def build_feature_vector(df: DataFrame, output_col: str = "features"):
    """Fit the encoding once on ``df`` and return (encoded df, input names, fitted model)."""
    from pyspark.ml import Pipeline

    df = fill_temporal(df)
    model = Pipeline(stages=encoding_stages(output_col, None)).fit(df)
    inputs = NUMERIC_FEATURES + [f"{c}_ohe" for c in CATEGORICAL_FEATURES]
    return model.transform(df), inputs, model


def drop_encoding_columns(df: DataFrame) -> DataFrame:
    cols = [c for c in df.columns
            if c.endswith("_idx") or c.endswith("_ohe") or c in ("features", "raw_features", "scaled_features")]
    return df.drop(*cols)
