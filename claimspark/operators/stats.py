"""Descriptive statistics over whole tables (no sampling)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.functions import mean
from claimspark.operators.joins import join_on_keys
from claimspark.operators.scan import ordered_scan
from claimspark.session import materialize

CORRELATION_COLUMNS = ["readmission_30day", "age", "length_of_stay", "claim_amount",
                       "paid_amount", "comorbidity_count", "denial_flag"]


def correlation_matrix(df: DataFrame, columns: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Pearson correlation of every column pair (lower triangle), pairwise
    complete (a row counts for a pair when both values are present).

    Two passes of plain sums: the pairwise means (one row of scalars), then
    the centred co-moments. A single aggregate of many ``corr`` functions
    compiles into one oversized method that the JVM will not JIT; plain sums
    stay small, and centring first is the numerically stable form.
    Output: (x, y, r) with r rounded to ``digits``.
    """
    cols = columns or CORRELATION_COLUMNS
    pairs = list(combinations(cols, 2))
    x = {c: F.col(c).cast("double") for c in cols}

    def both(a, b):
        return x[a].isNotNull() & x[b].isNotNull()

    means = df.agg(*[
        e for i, (a, b) in enumerate(pairs) for e in (
            F.avg(F.when(both(a, b), x[a])).alias(f"ma{i}"),
            F.avg(F.when(both(a, b), x[b])).alias(f"mb{i}"),
        )
    ]).first()   # one row: 2 scalars per pair
    sums = []
    for i, (a, b) in enumerate(pairs):
        ma, mb = means[f"ma{i}"], means[f"mb{i}"]
        if ma is None:
            sums += [F.lit(None).cast("double").alias(f"sxy{i}"), F.lit(None).cast("double").alias(f"sxx{i}"),
                     F.lit(None).cast("double").alias(f"syy{i}"), F.lit(0).cast("bigint").alias(f"n{i}")]
            continue
        da, db = x[a] - F.lit(ma), x[b] - F.lit(mb)
        ok = both(a, b)
        sums += [F.sum(F.when(ok, da * db)).alias(f"sxy{i}"), F.sum(F.when(ok, da * da)).alias(f"sxx{i}"),
                 F.sum(F.when(ok, db * db)).alias(f"syy{i}"), F.count_if(ok).alias(f"n{i}")]
    wide = df.agg(*sums)
    rs = [F.when(F.col(f"n{i}") >= 2,
                 F.col(f"sxy{i}") / F.sqrt(F.col(f"sxx{i}") * F.col(f"syy{i}"))).alias(f"c{i}")
          for i in range(len(pairs))]
    wide = wide.select(*rs)
    stack = ", ".join(f"'{b}', '{a}', c{i}" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {stack}) AS (x, y, r)").withColumn(
        "r", F.round("r", digits))


def histogram(df: DataFrame, column: str = "claim_amount", bins: int = 80) -> DataFrame:
    """Equal-width histogram over [min, max]; the max falls in the last bin.

    Output: (bin, bin_lo, bin_hi, n). The bounds are one scalar aggregate.
    """
    x = F.col(column).cast("double")
    b = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = b["lo"], b["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_lo double, bin_hi double, n bigint")
    width = (hi - lo) if hi > lo else 1.0
    idx = F.least(F.floor((x - F.lit(lo)) / F.lit(width) * F.lit(float(bins))), F.lit(bins - 1)).cast("int")
    out = df.where(x.isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return out.select(
        "bin",
        (F.lit(lo) + F.col("bin").cast("double") * F.lit(width / bins)).alias("bin_lo"),
        (F.lit(lo) + (F.col("bin") + 1).cast("double") * F.lit(width / bins)).alias("bin_hi"),
        "n",
    )


def exact_percentiles(df: DataFrame, column: str, probs: list[float], by: list[str] | None = None,
                      names: list[str] | None = None) -> DataFrame:
    """Exact percentiles with linear interpolation (like ``percentile``).

    Distributed selection: values are reduced to (value, count), sorted by a
    range-partitioned scan that carries running counts, and only the rows
    holding the needed ranks are kept. No task receives a whole group.
    Output: by columns + one double column per probability.
    """
    by = list(by or [])
    names = names or [f"p{int(round(p * 100)):02d}" for p in probs]
    v = F.col(column).cast("double")
    counts = (df.where(v.isNotNull()).groupBy(*by, v.alias("_v"))
              .agg(F.count(F.lit(1)).alias("_c")))
    scanned = ordered_scan(counts, by, [("_v", True)], running_sums={"_cum": "_c"})
    # a group's total is its last running count, read from the landed scan
    totals = scanned.groupBy(*by).agg(F.max("_cum").alias("_n"))
    if by:
        scanned = join_on_keys(scanned, totals, by, "inner")
    else:
        n = totals.first()["_n"]    # one scalar
        scanned = scanned.withColumn("_n", F.lit(n))
    start = F.col("_cum") - F.col("_c")       # 0-based rank of the first copy
    aggs = []
    for p, name in zip(probs, names):
        h = (F.col("_n") - 1).cast("double") * F.lit(float(p))
        k_lo, k_hi = F.floor(h), F.ceil(h)
        has_lo = (start <= k_lo) & (k_lo < F.col("_cum"))
        has_hi = (start <= k_hi) & (k_hi < F.col("_cum"))
        scanned = scanned.withColumns({
            f"_lo_{name}": F.when(has_lo, F.col("_v")),
            f"_hi_{name}": F.when(has_hi, F.col("_v")),
            f"_f_{name}": h - k_lo,
        })
        aggs += [F.max(f"_lo_{name}").alias(f"_lo_{name}"), F.max(f"_hi_{name}").alias(f"_hi_{name}"),
                 F.max(f"_f_{name}").alias(f"_f_{name}")]
    keep = None
    for name in names:
        c = F.col(f"_lo_{name}").isNotNull() | F.col(f"_hi_{name}").isNotNull()
        keep = c if keep is None else keep | c
    picked = scanned.where(keep).groupBy(*by).agg(*aggs)
    return picked.select(*by, *[
        (F.col(f"_lo_{n}") + F.col(f"_f_{n}") * (F.col(f"_hi_{n}") - F.col(f"_lo_{n}"))).alias(n)
        for n in names
    ])


def box_stats(df: DataFrame, column: str = "claim_amount", by: list[str] | None = None,
              whisker: float = 1.5) -> DataFrame:
    """Quartiles and whiskers (most extreme values within whisker x IQR)."""
    by = list(by if by is not None else ["facility_type"])
    q = exact_percentiles(df, column, [0.25, 0.5, 0.75], by, ["q1", "median", "q3"])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    x = F.col(column).cast("double")
    if not by:
        # one global box: quartiles and whiskers are a handful of scalars
        r = q.first()
        lo = hi = None
        if r is not None and r["q1"] is not None:
            lo_f, hi_f = r["q1"] - whisker * r["iqr"], r["q3"] + whisker * r["iqr"]
            ends = df.agg(F.min(F.when(x >= F.lit(lo_f), x)).alias("lo"),
                          F.max(F.when(x <= F.lit(hi_f), x)).alias("hi")).first()
            lo, hi = ends["lo"], ends["hi"]
        vals = [None if r is None else r[c] for c in ("q1", "median", "q3", "iqr")]
        return df.sparkSession.createDataFrame(
            [(*vals, lo, hi)],
            "q1 double, median double, q3 double, iqr double, whisker_low double, whisker_high double")
    q = materialize(q, "quartiles")  # one row a group, read three times
    j = join_on_keys(df.select(*by, x.alias("_x")), q, by, "inner")
    lo_fence = F.col("q1") - F.lit(whisker) * F.col("iqr")
    hi_fence = F.col("q3") + F.lit(whisker) * F.col("iqr")
    w = j.groupBy(*by).agg(
        F.min(F.when(F.col("_x") >= lo_fence, F.col("_x"))).alias("whisker_low"),
        F.max(F.when(F.col("_x") <= hi_fence, F.col("_x"))).alias("whisker_high"),
    )
    return q.join(w, by)


def linear_trend(df: DataFrame, x: str = "age", y: str = "length_of_stay", digits: int = 6) -> DataFrame:
    """Least-squares line y = slope * x + intercept over all rows."""
    return df.agg(
        F.round(F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")), digits).alias("slope"),
        F.round(F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double")), digits).alias("intercept"),
        F.regr_count(F.col(y).cast("double"), F.col(x).cast("double")).alias("n"),
    )


def age_los_grid(df: DataFrame) -> DataFrame:
    """Claims per (age, length_of_stay) cell with mean comorbidity and readmission."""
    return df.groupBy("age", "length_of_stay").agg(
        F.count(F.lit(1)).alias("n"),
        mean("comorbidity_count").alias("avg_comorbidity"),
        mean("readmission_30day").alias("readmit_rate"),
    )
