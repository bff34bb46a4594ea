"""DuckDB SQL that rebuilds the adapter's claims/patients views.

``oracle(body)`` prefixes a query with the two CTEs so that every oracle
query runs on the raw shared tables, exactly like the Spark side.
"""

from __future__ import annotations

from claimspark.schemas import DIAGNOSIS_CODES, FACILITY_TYPES, INSURANCE_TYPES, PROCEDURE_CODES
from claimspark.sources.adapter import HIGH_RISK_CODE_INDEXES, PRIORITY_TO_PAYER, UNMAPPED_DIAGNOSIS


def _list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_PAYER_CASE = "CASE o.o_orderpriority " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITY_TO_PAYER.items()
) + " END"

ADAPTER_CTES = f"""
patients AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS patient_id,
         CAST(18 + c.c_custkey % 78 AS INTEGER) AS age,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         upper(substr(n.n_name, 1, 2)) AS state,
         ({_list(INSURANCE_TYPES)})[CAST(c.c_custkey % 7 AS INTEGER) + 1] AS insurance_type,
         CAST((c.c_custkey * 7) % 11 AS INTEGER) AS comorbidity_count
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
),
claims AS (
  SELECT
    concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
              CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR)) AS claim_id,
    CAST(o.o_custkey AS VARCHAR) AS patient_id,
    CAST(l.l_shipdate AS DATE) AS admit_date,
    CAST(l.l_shipdate AS DATE) + CAST(CAST(l.l_quantity AS INTEGER) % 11 AS INTEGER) AS discharge_date,
    ({_list(DIAGNOSIS_CODES + [UNMAPPED_DIAGNOSIS])})[CAST(l.l_partkey % 21 AS INTEGER) + 1] AS diagnosis_code,
    ({_list(PROCEDURE_CODES)})[CAST(l.l_suppkey % 21 AS INTEGER) + 1] AS procedure_code,
    CAST(l.l_suppkey AS VARCHAR) AS provider_id,
    ({_list(FACILITY_TYPES)})[CAST(l.l_linenumber % 5 AS INTEGER) + 1] AS facility_type,
    {_PAYER_CASE} AS payer_type,
    CAST(l.l_extendedprice AS DECIMAL(18,2)) AS claim_amount,
    CAST(CASE WHEN l.l_returnflag = 'R' THEN 0
              ELSE CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))
         END AS DECIMAL(18,4)) AS paid_amount,
    CAST(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS denial_flag,
    CAST(CASE WHEN (l.l_orderkey * 7 + l.l_linenumber * 31 + l.l_partkey) % 100
                   < 4 + 2 * p.comorbidity_count
                     + CASE WHEN l.l_partkey % 21 IN ({", ".join(map(str, HIGH_RISK_CODE_INDEXES))}) THEN 12 ELSE 0 END
              THEN 1 ELSE 0 END AS INTEGER) AS readmission_30day,
    CAST(CAST(l.l_quantity AS INTEGER) % 11 AS INTEGER) AS length_of_stay,
    p.age, p.gender, p.comorbidity_count, p.state, p.insurance_type
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN patients p ON p.patient_id = CAST(o.o_custkey AS VARCHAR)
)"""


def oracle(body: str, ctes: str = "") -> str:
    """``WITH patients, claims[, extra ctes] <body>``."""
    extra = f",\n{ctes.strip().rstrip(',')}" if ctes.strip() else ""
    return f"WITH {ADAPTER_CTES.strip()}{extra}\n{body.strip()}"
