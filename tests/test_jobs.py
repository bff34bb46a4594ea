"""End-to-end job on CSV files derived from the smallest tables."""

from claimspark.plans import jobs
from claimspark.sources import adapter, files
from claimspark.sources import results as R


def test_pipeline_end_to_end(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    c_csv, p_csv = str(tmp_path / "claims_csv"), str(tmp_path / "patients_csv")
    files.write_csv(adapter.claims(spark, sf), c_csv)
    files.write_csv(adapter.patients(spark, sf), p_csv)
    out = jobs.run_pipeline(spark, c_csv, p_csv, str(tmp_path / "out"), kinds=("logistic_regression",))
    assert out["winner"] == "logistic_regression"
    res = R.load_results(spark, out["results"])
    assert res["metrics"].count() == 6
    assert spark.read.parquet(f"{out['out_dir']}/reports/denial_by_payer").count() == 4
    model = R.load_model(f"{out['results']}/model")
    assert len(model.stages) == 5
