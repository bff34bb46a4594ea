"""The report queries written in Spark SQL.

Frames are passed as named parameters (``spark.sql(q, claims=df)``), so no
global temp view is registered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CLAIMS_PER_PATIENT = """
SELECT patient_id,
       COUNT(claim_id) AS num_claims,
       SUM(claim_amount) AS total_claim_amount,
       CAST(SUM(claim_amount) AS DOUBLE) / COUNT(claim_amount) AS avg_claim_amount,
       MAX(readmission_30day) AS ever_readmitted
FROM {claims}
GROUP BY patient_id
"""

AVG_LOS_BY_DIAGNOSIS = """
SELECT diagnosis_code,
       CAST(SUM(length_of_stay) AS DOUBLE) / COUNT(length_of_stay) AS avg_los,
       COUNT(claim_id) AS claim_count,
       CAST(SUM(claim_amount) AS DOUBLE) / COUNT(claim_amount) AS avg_cost
FROM {claims}
GROUP BY diagnosis_code
ORDER BY avg_los DESC, diagnosis_code
"""

DENIAL_BY_PAYER = """
SELECT payer_type,
       COUNT(claim_id) AS total_claims,
       CAST(SUM(denial_flag) AS BIGINT) AS total_denials,
       CAST(SUM(denial_flag) AS DOUBLE) / COUNT(denial_flag) AS denial_rate,
       CAST(SUM(claim_amount) AS DOUBLE) / COUNT(claim_amount) AS avg_claim_amount,
       DENSE_RANK() OVER (ORDER BY CAST(SUM(denial_flag) AS DOUBLE) / COUNT(denial_flag) DESC) AS denial_rank
FROM {claims}
GROUP BY payer_type
ORDER BY denial_rate DESC, payer_type
"""


def compute_aggregations_sql(spark: SparkSession, claims: DataFrame) -> dict[str, DataFrame]:
    return {
        "claims_per_patient_sql": spark.sql(CLAIMS_PER_PATIENT, claims=claims),
        "avg_los_by_diagnosis_sql": spark.sql(AVG_LOS_BY_DIAGNOSIS, claims=claims),
        "denial_by_payer_sql": spark.sql(DENIAL_BY_PAYER, claims=claims),
    }
