"""Own claim rows that show one behaviour each, and plain-Python goldens."""

import datetime as dt

from claimspark.schemas import (
    AGE_BUCKET_TOP,
    AGE_BUCKETS,
    CLAIMS_SCHEMA,
    DEFAULT_EXPECTED_LOS,
    DEFAULT_RISK,
    DIAGNOSIS_RISK,
    EXPECTED_LOS,
    PATIENTS_SCHEMA,
)

D = dt.date.fromisoformat

# id, patient, admit, diag, provider, payer, amount, denied, readmit, los, age, comorb, gender, facility
ROWS = [
    # "many": a same-day pair, then a claim 90 days later, then 91, then one after four days
    ("many-1", "many", "2021-03-02", "I10", "east", "Medicaid", 120.0, 0, 0, 2, 47, 3, "F", "Emergency"),
    ("many-2", "many", "2021-03-02", "E11.9", "west", "Medicaid", 310.0, 1, 1, 6, 47, 3, "F", "Inpatient"),
    ("many-3", "many", "2021-05-31", "I10", "east", "Self-Pay", 64.0, 0, 0, 0, 47, 3, "F", "Outpatient"),
    ("many-4", "many", "2021-08-30", "N18.9", "east", "Medicaid", 905.0, 0, 1, 9, 47, 3, "F", "SNF"),
    ("many-5", "many", "2021-09-03", "I50.9", "north", "Medicaid", 42.0, 1, 0, 1, 47, 3, "F", "Outpatient"),
    # "once": one claim, youngest band
    ("once-1", "once", "2020-12-24", "M54.5", "west", "Commercial", 75.5, 1, 0, 0, 21, 0, "M", "Ambulatory"),
    # "code": a diagnosis that no table lists
    ("code-1", "code", "2021-07-05", "X00.0", "south", "Commercial", 18.25, 0, 0, 3, 61, 7, "M", "Outpatient"),
    ("code-2", "code", "2021-07-26", "J44.1", "south", "Medicare", 2650.0, 0, 1, 4, 61, 7, "M", "Inpatient"),
    # "top": the top age band, denied twice by one provider
    ("top-1", "top", "2021-11-11", "J18.9", "north", "Medicare", 480.0, 1, 0, 5, 91, 9, "F", "Inpatient"),
    ("top-2", "top", "2022-01-09", "I48.91", "north", "Medicare", 96.0, 1, 0, 1, 91, 9, "F", "Emergency"),
    ("top-3", "top", "2022-01-10", "I48.91", "east", "Medicare", 33.0, 0, 0, 1, 91, 9, "F", "Outpatient"),
]


def claim_row(r, state="AZ", insurance="PPO"):
    cid, pid, admit, diag, prov, payer, amt, den, re, los, age, com, gender, fac = r
    a = D(admit) if admit else None
    return (cid, pid, a, (a + dt.timedelta(days=los)) if a and los is not None else None, diag, "99213",
            prov, fac, payer, amt, 0.0 if den else (amt * 0.8 if amt is not None else None), den, re, los, age,
            gender, com, state, insurance)


def claims_df(spark, rows=ROWS):
    return spark.createDataFrame([claim_row(r) for r in rows], CLAIMS_SCHEMA)


def patients_df(spark, rows=ROWS):
    seen = {}
    for r in rows:
        seen.setdefault(r[1], (r[1], r[10], r[12], "AZ", "PPO", r[11]))
    return spark.createDataFrame(list(seen.values()), PATIENTS_SCHEMA)


def expected_features(rows=ROWS):
    """Feature goldens by loops over the rows (admit dates not null)."""
    out = {}
    for r in rows:
        cid, pid, admit, diag, prov, payer, amt, _den, _re, los, age, com = r[:12]
        own = sorted((x for x in rows if x[1] == pid), key=lambda x: (x[2], x[0]))
        at = [x[0] for x in own].index(cid)
        before = own[at - 1] if at else None
        near = [x for x in own if 0 <= (D(admit) - D(x[2])).days <= 90]
        provider, pays = [x for x in rows if x[4] == prov], [x for x in rows if x[5] == payer]
        risk, usual = DIAGNOSIS_RISK.get(diag, DEFAULT_RISK), EXPECTED_LOS.get(diag, DEFAULT_EXPECTED_LOS)
        mean = sum(x[6] for x in own) / len(own)
        out[cid] = {
            "rolling_cost_90d": sum(x[6] for x in near), "claim_count_90d": len(near),
            "days_since_last_claim": (D(admit) - D(before[2])).days if before else None,
            "prev_denial_flag": before[7] if before else None, "prev_claim_amount": before[6] if before else None,
            "claim_sequence": at + 1, "diagnosis_risk_score": risk, "los_vs_expected_ratio": los / usual if usual > 0 else 1.0,
            "comorbidity_index": (com + risk) / 2, "age_bucket": next((b for top, b in AGE_BUCKETS if age < top), AGE_BUCKET_TOP),
            "provider_denial_rate": sum(x[7] for x in provider) / len(provider), "provider_claim_volume": len(provider),
            "payer_approval_rate": 1 - sum(x[7] for x in pays) / len(pays), "patient_avg_claim": mean,
            "patient_total_claims": len(own), "cost_ratio_to_patient_avg": amt / mean,
        }
    return out
