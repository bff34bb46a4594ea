"""Classifier evaluation computed in Spark: curves, AUCs, thresholds, counts.

Inputs are (label int 0/1, score double). Curves are built on one row per
distinct score: the cumulative counts come from the distributed scan, so no
single task sorts all predictions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.operators.scan import ordered_scan
from claimspark.schemas import THRESHOLDS


def _totals(scored: DataFrame, label: str) -> tuple[int, int]:
    r = scored.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    return int(r["p"]), int(r["n"])


def curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Cumulative confusion counts per distinct score, descending.

    Output: threshold, tp, fp, tpr, fpr, precision, recall, prev_tp, prev_fp.
    """
    pos, neg = _totals(scored, label)
    per = scored.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n"))
    # one scan: running totals; the previous point is the total minus this row
    s = ordered_scan(per, None, [("threshold", False)], running_sums={"tp": "_p", "fp": "_n"})
    s = s.withColumns({"prev_tp": F.col("tp") - F.col("_p"), "prev_fp": F.col("fp") - F.col("_n")})
    return s.select(
        "threshold", "tp", "fp",
        (F.col("tp").cast("double") / F.lit(float(max(pos, 1)))).alias("tpr"),
        (F.col("fp").cast("double") / F.lit(float(max(neg, 1)))).alias("fpr"),
        (F.col("tp").cast("double") / (F.col("tp") + F.col("fp")).cast("double")).alias("precision"),
        (F.col("tp").cast("double") / F.lit(float(max(pos, 1)))).alias("recall"),
        F.coalesce("prev_tp", F.lit(0)).alias("prev_tp"),
        F.coalesce("prev_fp", F.lit(0)).alias("prev_fp"),
    ).withColumn("_P", F.lit(pos)).withColumn("_N", F.lit(neg))


def roc_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return curve(scored, label, score).select("threshold", "tp", "fp", "tpr", "fpr")


def pr_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return curve(scored, label, score).select("threshold", "tp", "fp", "precision", "recall")


def auc_roc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact trapezoid AUC: an integer numerator divided once by 2·P·N."""
    c = curve(scored, label, score)
    num = F.sum((F.col("fp") - F.col("prev_fp")) * (F.col("tp") + F.col("prev_tp")))
    return c.agg(
        (num.cast("double") / (F.lit(2.0) * F.first("_P").cast("double") * F.first("_N").cast("double")))
        .alias("auc_roc"))


def average_precision(scored: DataFrame, label: str = "label", score: str = "score",
                      digits: int = 10) -> DataFrame:
    """AP = sum over thresholds of (R_n - R_{n-1}) * P_n (step sum)."""
    c = curve(scored, label, score)
    term = ((F.col("tp") - F.col("prev_tp")).cast("double") / F.col("_P").cast("double")) * F.col("precision")
    return c.agg(F.round(F.sum(term), digits).alias("average_precision"))


def best_threshold(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """F1-optimal threshold: max 2PR / (P + R + 1e-10); ties -> lowest threshold."""
    c = pr_curve(scored, label, score).withColumn(
        "f1", F.lit(2.0) * F.col("precision") * F.col("recall")
        / (F.col("precision") + F.col("recall") + F.lit(1e-10)))
    return c.orderBy(F.col("f1").desc(), F.col("threshold").asc()).limit(1).select(
        "threshold", "precision", "recall", "f1")


def threshold_table(scored: DataFrame, label: str = "label", score: str = "score",
                    thresholds: list[float] | None = None) -> DataFrame:
    """Operating points in one aggregate: flagged = score >= t."""
    ts = thresholds or THRESHOLDS
    y, p = F.col(label), F.col(score)
    aggs = [F.count(F.lit(1)).alias("_n"), F.count_if(y == 1).alias("_pos")]
    for i, t in enumerate(ts):
        aggs += [F.count_if(p >= F.lit(t)).alias(f"f{i}"), F.count_if((p >= F.lit(t)) & (y == 1)).alias(f"t{i}")]
    wide = scored.agg(*aggs)
    stack = ", ".join(f"CAST({t} AS DOUBLE), f{i}, t{i}" for i, t in enumerate(ts))
    long = wide.selectExpr("_n", "_pos", f"stack({len(ts)}, {stack}) AS (threshold, flagged, tp)")
    return long.select(
        "threshold",
        F.round(F.when(F.col("flagged") == 0, F.lit(0.0))
                .otherwise(F.col("tp").cast("double") / F.col("flagged").cast("double")), 3).alias("precision"),
        F.round(F.col("tp").cast("double") / F.greatest("_pos", F.lit(1)).cast("double"), 3).alias("recall"),
        F.round(F.col("flagged").cast("double") / F.col("_n").cast("double"), 3).alias("flag_rate"),
        F.col("flagged").cast("bigint").alias("patients_flagged"),
    )


def confusion_matrix(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scored.groupBy(F.col(label).cast("int").alias("label"),
                          F.col(prediction).cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def classification_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted precision / recall / F1 for 0/1 labels."""
    y, yh = F.col(label), F.col(prediction)
    c = scored.agg(
        F.count_if((y == 1) & (yh == 1)).alias("tp"), F.count_if((y == 0) & (yh == 1)).alias("fp"),
        F.count_if((y == 0) & (yh == 0)).alias("tn"), F.count_if((y == 1) & (yh == 0)).alias("fn"))
    d = {k: F.col(k).cast("double") for k in ("tp", "fp", "tn", "fn")}
    n = d["tp"] + d["fp"] + d["tn"] + d["fn"]

    def safe(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    p1, r1 = safe(d["tp"], d["tp"] + d["fp"]), safe(d["tp"], d["tp"] + d["fn"])
    p0, r0 = safe(d["tn"], d["tn"] + d["fn"]), safe(d["tn"], d["tn"] + d["fp"])
    f1_1, f1_0 = safe(F.lit(2.0) * p1 * r1, p1 + r1), safe(F.lit(2.0) * p0 * r0, p0 + r0)
    w1, w0 = (d["tp"] + d["fn"]) / n, (d["tn"] + d["fp"]) / n
    return c.select(
        ((d["tp"] + d["tn"]) / n).alias("accuracy"),
        (w0 * p0 + w1 * p1).alias("weighted_precision"),
        (w0 * r0 + w1 * r1).alias("weighted_recall"),
        (w0 * f1_0 + w1 * f1_1).alias("weighted_f1"),
    )


def base_rate(scored: DataFrame, label: str = "label") -> DataFrame:
    """Share of positives: the precision of a random ranking (PR baseline)."""
    return scored.agg(F.try_divide(F.sum(F.col(label)).cast("double"),
                                   F.count(F.col(label)).cast("double")).alias("base_rate"))


def grouped_auc_roc(scored: DataFrame, keys: list[str], label: str = "label", score: str = "score") -> DataFrame:
    """Exact AUC-ROC of each group: cumulative counts per distinct score from one
    ordered scan for all groups, integer sums divided once. Null where a group has
    one class only."""
    per = scored.groupBy(*keys, F.col(score).cast("double").alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n"))
    s = ordered_scan(per, keys, [("_score", False)], running_sums={"_tp": "_p", "_fp": "_n"})
    area = F.sum(F.col("_n") * (F.lit(2) * F.col("_tp") - F.col("_p")))
    return s.groupBy(*keys).agg(F.try_divide(area.cast("double"), (F.lit(2.0) * F.sum("_p") * F.sum("_n"))).alias("auc_roc"))
