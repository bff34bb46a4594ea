"""The end-to-end batch job: ingest -> transforms -> features -> training.

    python -m claimspark.plans.jobs <claims_csv> <patients_csv> [out_dir]

Every stage writes to (or reads from) the shared folder, so a failed run can
be resumed from the landed Parquet instead of the raw CSV.
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from claimspark.operators.features import engineer_features
from claimspark.plans import training
from claimspark.plans.pipelines import run_all_transforms
from claimspark.session import build_session, landings_released, shared_path
from claimspark.sources import files
from claimspark.sources import results as R

ALL_MODELS = ("logistic_regression", "random_forest", "gradient_boosted_trees")


def run_pipeline(spark: SparkSession, claims_csv: str, patients_csv: str, out_dir: str | None = None,
                 kinds: tuple[str, ...] = ALL_MODELS, rf_grid: dict | None = None,
                 gbt_params: dict | None = None) -> dict:
    out_dir = out_dir or shared_path(spark, "pipeline")
    with landings_released(spark):
        got = files.ingest(spark, claims_csv, patients_csv, f"{out_dir}/ingest")
        got.profile.write.mode("overwrite").parquet(f"{out_dir}/quality_report")
        got.report.write.mode("overwrite").parquet(f"{out_dir}/ingest_report")
        enriched, aggregates = run_all_transforms(spark, got.claims, got.patients)
        for name, df in aggregates.items():
            df.write.mode("overwrite").parquet(f"{out_dir}/reports/{name}")
        features = engineer_features(enriched)
        prepared, metrics, results_dir, winner = training.run_training(
            features, kinds, f"{out_dir}/models", rf_grid, gbt_params)
    metrics = R.load_results(spark, results_dir)["metrics"]
    return {"out_dir": out_dir, "results": results_dir, "winner": winner, "metrics": metrics,
            "prepared": prepared}


def main(argv: list[str]) -> None:
    spark = build_session(app_name="claimspark-pipeline")
    out = run_pipeline(spark, argv[0], argv[1], argv[2] if len(argv) > 2 else None)
    out["metrics"].show(truncate=False)
    print(f"winner: {out['winner']}  results: {out['results']}")


if __name__ == "__main__":
    main(sys.argv[1:])
