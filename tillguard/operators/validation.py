"""Five-level validation of synthetic against real training rows (VAL-1..9).

Statistics are Spark aggregates over both frames (per-distinct-value counts
and running totals, never a collected column); only the final scalar
statistics reach the driver, where p-values are computed from them.
Results are long-form: ``(level, column, metric, value, rating)``.
"""

from __future__ import annotations

import contextlib
import math
from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillguard.operators.cumulative import melt, running_totals
from tillguard.schemas import CATEGORICAL_COLUMNS, CONTINUOUS_COLUMNS, FEATURE_COLUMNS

# Rating bands used by the reference validation.
MEAN_DIFF_OK, MEAN_DIFF_WARN = 10.0, 20.0
DIST_EXCELLENT, DIST_ACCEPTABLE = 0.05, 0.15
CHI_ALPHA = 0.05
AUC_GAP_EQUIVALENT, AUC_GAP_ACCEPTABLE = 0.02, 0.05
DNNR_PRESERVED, DNNR_BORDERLINE = 1.5, 1.0
CHI_EXPECTED_FLOOR = 1e-6


def distance_rating(x) -> F.Column:
    x = F.col(x) if isinstance(x, str) else x
    return (F.when(x < DIST_EXCELLENT, "excellent").when(x <= DIST_ACCEPTABLE, "acceptable").otherwise("poor"))


def summary_diff(real: DataFrame, synth: DataFrame, cols: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """VAL-1: mean % difference per column; ok <= 10 < warn <= 20 < fail;
    +inf when the real mean is 0."""
    r = real.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols])
    s = synth.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols])
    stack = lambda df, v: df.selectExpr(
        f"stack({len(cols)}, " + ", ".join(f"'{c}', `{c}`" for c in cols) + f") as (column, {v})")
    j = stack(r, "real_mean").join(stack(s, "synthetic_mean"), "column")
    diff = F.when(F.col("real_mean") != 0,
                  F.abs(F.col("real_mean") - F.col("synthetic_mean")) / F.abs(F.col("real_mean")) * 100.0
                  ).otherwise(F.lit(float("inf")))
    j = j.withColumn("mean_pct_diff", diff)
    return j.withColumn("flag", F.when(F.col("mean_pct_diff") <= MEAN_DIFF_OK, "ok")
                        .when(F.col("mean_pct_diff") <= MEAN_DIFF_WARN, "warn").otherwise("fail"))


def two_sample_counts(real: DataFrame, synth: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per (column, distinct value of the union): counts in real (c1)
    and synthetic (c2).  NULLs and NaNs are dropped per column."""
    r = melt(real, cols).withColumns({"c1": F.lit(1).cast("long"), "c2": F.lit(0).cast("long")})
    s = melt(synth, cols).withColumns({"c1": F.lit(0).cast("long"), "c2": F.lit(1).cast("long")})
    both = r.unionByName(s).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return both.groupBy("column", "value").agg(F.sum("c1").alias("c1"), F.sum("c2").alias("c2"))


@contextlib.contextmanager
def _both(real: DataFrame, synth: DataFrame, cols: Sequence[str]):
    """Both samples' columns as doubles, the second marked, computed once."""
    side = lambda d, second: d.select(*[F.col(c).cast("double").alias(c) for c in cols], F.lit(second).alias("_second"))
    both = side(real, False).unionByName(side(synth, True)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield both
    finally:
        both.unpersist()


def _by_sort(exact: DataFrame, col: str):
    return exact.filter(F.col("column") == col).first()


def _ks_rows(real, synth, found: dict, n_buckets) -> list[tuple]:
    rows = []
    for c, of in found.items():
        if of is None:
            r = _by_sort(ks_by_sort(real, synth, [c], n_buckets=n_buckets), c)
            of = (r.ks, r.n1, r.n2)
        if of[1] or of[2]:
            rows.append((c, *of))
    return rows


def ks_statistics(real: DataFrame, synth: DataFrame, cols: Sequence[str], *,
                  n_buckets: int | None = None) -> DataFrame:
    """VAL-3 statistic per column: D = max |F_real(x) - F_synth(x)|, by
    narrowing histograms; no value moves."""
    from tillguard.operators.selection import ks
    with _both(real, synth, cols) as both:
        found = ks(both, list(cols), "_second")
    return real.sparkSession.createDataFrame(_ks_rows(real, synth, found, n_buckets), "column string, ks double, n1 long, n2 long")


def ks_by_sort(real: DataFrame, synth: DataFrame, cols: Sequence[str], *, n_buckets: int | None = None) -> DataFrame:
    """The same from running totals over the distinct values."""
    c = running_totals(two_sample_counts(real, synth, cols), "value", ["c1", "c2"], group="column",
                       n_buckets=n_buckets)
    d = F.abs(F.col("cum_c1") / F.col("tot_c1") - F.col("cum_c2") / F.col("tot_c2"))
    out = c.groupBy("column").agg(F.max(d).alias("ks"), F.first("tot_c1").alias("n1"),
                                  F.first("tot_c2").alias("n2"))
    return out.withColumn("ks", F.when((F.col("n1") > 0) & (F.col("n2") > 0), F.col("ks")))


def ks_statistic(real: DataFrame, synth: DataFrame, col: str, *, n_buckets: int | None = None) -> DataFrame:
    return ks_statistics(real, synth, [col], n_buckets=n_buckets)


def _real_std(both: DataFrame, cols: Sequence[str]):
    return both.filter(~F.col("_second")).agg(*[F.stddev_samp(c).alias(c) for c in cols]).first()


def _wasserstein_rows(real, synth, found: dict, sd, n_buckets) -> list[tuple]:
    rows = []
    for c, raw in found.items():
        raw = _by_sort(wasserstein_by_sort(real, synth, [c], n_buckets=n_buckets), c).raw_distance if raw is None else raw
        rows.append((c, raw, raw / sd[c] if sd[c] is not None and sd[c] > 0 else float("inf")))
    return rows


def wasserstein_distances(real: DataFrame, synth: DataFrame, cols: Sequence[str], *,
                          n_buckets: int | None = None) -> DataFrame:
    """VAL-5 per column: W1 = integral |F_real - F_synth| dx, and W1 / sample
    std of real (+inf when that std is 0), by narrowing histograms."""
    from tillguard.operators.selection import wasserstein as integral
    with _both(real, synth, cols) as both:
        sd, found = _real_std(both, cols), integral(both, list(cols), "_second")
    return real.sparkSession.createDataFrame(_wasserstein_rows(real, synth, found, sd, n_buckets),
                                             "column string, raw_distance double, normalized_score double")


def distances(real: DataFrame, synth: DataFrame, cols: Sequence[str], *,
              n_buckets: int | None = None) -> tuple[list[tuple], list[tuple]]:
    """The rows of ``ks_statistics`` and of ``wasserstein_distances``, from the
    same passes over both samples."""
    from tillguard.operators.selection import ks_and_wasserstein
    with _both(real, synth, cols) as both:
        sd, (gaps, areas) = _real_std(both, cols), ks_and_wasserstein(both, list(cols), "_second")
    return _ks_rows(real, synth, gaps, n_buckets), _wasserstein_rows(real, synth, areas, sd, n_buckets)


def wasserstein_by_sort(real: DataFrame, synth: DataFrame, cols: Sequence[str], *, n_buckets: int | None = None) -> DataFrame:
    """W1 from running totals over the distinct values."""
    c = running_totals(two_sample_counts(real, synth, cols), "value", ["c1", "c2"], group="column",
                       n_buckets=n_buckets, with_next=True)
    step = (F.abs(F.col("cum_c1") / F.col("tot_c1") - F.col("cum_c2") / F.col("tot_c2"))
            * (F.col("next_value") - F.col("value")))
    return c.groupBy("column").agg(F.coalesce(F.sum(step), F.lit(0.0)).alias("raw_distance"))


def wasserstein(real: DataFrame, synth: DataFrame, col: str, *, n_buckets: int | None = None) -> DataFrame:
    return wasserstein_distances(real, synth, [col], n_buckets=n_buckets)


def chi_squares(real: DataFrame, synth: DataFrame, cols: Sequence[str]) -> DataFrame:
    """VAL-4 statistic per column: observed = real counts over the union of
    categories, expected = synthetic share * real total (0 -> 1e-6)."""
    c = two_sample_counts(real, synth, cols)
    tot = c.groupBy("column").agg(F.sum("c1").alias("n1"), F.sum("c2").alias("n2"))
    c = c.join(F.broadcast(tot), "column")  # one row per column: bounded
    exp = F.when(F.col("n2") > 0, F.col("c2") / F.col("n2")).otherwise(F.lit(0.0)) * F.col("n1")
    exp = F.when(exp == 0, F.lit(CHI_EXPECTED_FLOOR)).otherwise(exp)
    return c.groupBy("column").agg(F.sum(F.pow(F.col("c1") - exp, 2) / exp).alias("chi2_statistic"),
                                   F.count(F.lit(1)).alias("categories"))


def chi_square(real: DataFrame, synth: DataFrame, col: str) -> DataFrame:
    return chi_squares(real, synth, [col])


# ---- p-values from scalar statistics (driver-side math on one number) ----

def _gammaincc(a: float, x: float) -> float:
    """Regularized upper incomplete gamma Q(a, x) (series / continued fraction)."""
    if x <= 0:
        return 1.0
    if x < a + 1:
        term = total = 1.0 / a
        ap = a
        for _ in range(10000):
            ap += 1
            term *= x / ap
            total += term
            if abs(term) < abs(total) * 1e-15:
                break
        return max(0.0, 1.0 - total * math.exp(-x + a * math.log(x) - math.lgamma(a)))
    b = x + 1 - a
    c = 1e300
    d = 1 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-15:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def chi2_pvalue(stat: float, dof: int) -> float:
    if dof <= 0 or stat is None or math.isnan(stat):
        return float("nan")
    return _gammaincc(dof / 2.0, stat / 2.0)


#: Sample sizes (their product) up to which the two-sample p-value is exact.
KS_EXACT_CELLS = 250_000


def ks_pvalue_exact(d: float, n1: int, n2: int) -> float:
    """P(D >= d) over all orders of two samples without ties: the share of the
    lattice paths from (0, 0) to (n1, n2) that reach |i/n1 - j/n2| >= d.  The
    paths that stay inside are counted row by row, in whole numbers."""
    reach = round(d * n1 * n2)  # the statistic is a multiple of 1 / (n1 n2)
    if reach <= 0:
        return 1.0
    inside = lambda i, j: abs(i * n2 - j * n1) < reach
    row = [0] * (n2 + 1)
    for j in range(n2 + 1):
        if not inside(0, j):
            break
        row[j] = 1
    for i in range(1, n1 + 1):
        left = 0
        for j in range(n2 + 1):
            left = row[j] = row[j] + left if inside(i, j) else 0
    total = math.comb(n1 + n2, n1)
    return (total - row[n2]) / total


def ks_pvalue(d: float, n1: int, n2: int) -> float:
    """Two-sample Kolmogorov p-value: exact for small samples, else asymptotic."""
    if d is None or n1 == 0 or n2 == 0:
        return float("nan")
    if n1 * n2 <= KS_EXACT_CELLS:
        return ks_pvalue_exact(d, n1, n2)
    en = math.sqrt(n1 * n2 / (n1 + n2))
    lam = (en + 0.12 + 0.11 / en) * d
    if lam < 1e-3:
        return 1.0
    s = sum(2 * (-1) ** (k - 1) * math.exp(-2 * (k * lam) ** 2) for k in range(1, 101))
    return min(1.0, max(0.0, s))


def _distance_band(d: float | None) -> str | None:
    return None if d is None else "excellent" if d < DIST_EXCELLENT else "acceptable" if d <= DIST_ACCEPTABLE else "poor"


def auc_gap_verdict(gap: float) -> str:
    return ("fully_equivalent" if gap < AUC_GAP_EQUIVALENT else
            "acceptable_with_monitoring" if gap <= AUC_GAP_ACCEPTABLE else "investigate_before_deployment")


def validate(real: DataFrame, synth: DataFrame, *, continuous: Sequence[str] = CONTINUOUS_COLUMNS,
             categorical: Sequence[str] = CATEGORICAL_COLUMNS, features: Sequence[str] = FEATURE_COLUMNS,
             level4: dict | None = None, level5: dict | None = None) -> DataFrame:
    """Levels 1, 3a, 3b, 3c (+ optional 4 and 5 results) in long form:
    ``level, column, metric, value, rating, passed``."""
    spark = real.sparkSession
    rows = []
    for r in summary_diff(real, synth, features).collect():  # one row per feature column
        rows.append(("level1", r["column"], "mean_pct_diff", r["mean_pct_diff"], r["flag"], r["flag"] != "fail"))
    ks, ws = ({c: of for c, *of in rows} for rows in distances(real, synth, continuous))  # one row per column
    for c in continuous:
        k = ks.get(c)
        d = None if k is None else k[0]
        rating = _distance_band(d)
        rows.append(("level3a", c, "ks_statistic", d, rating, rating not in (None, "poor")))
        rows.append(("level3a", c, "p_value", ks_pvalue(d, k[1], k[2]) if k else float("nan"), None, None))
        w = ws.get(c)
        ns = None if w is None else w[1]
        wr = _distance_band(ns)
        rows.append(("level3c", c, "raw_distance", None if w is None else w[0], None, None))
        rows.append(("level3c", c, "normalized_score", ns, wr, wr not in (None, "poor")))
    chis = {r["column"]: r for r in chi_squares(real, synth, categorical).collect()}
    for c in categorical:
        x = chis.get(c)
        stat = None if x is None else x["chi2_statistic"]
        p = chi2_pvalue(stat, int(x["categories"]) - 1) if x else float("nan")
        aligned = bool(p > CHI_ALPHA) if not math.isnan(p) else False
        rows.append(("level3b", c, "chi2_statistic", stat, None, None))
        rows.append(("level3b", c, "p_value", p, "aligned" if aligned else "not_aligned", aligned))
    if level4:
        gap = level4["auc_gap"]
        verdict = auc_gap_verdict(gap)
        rows.append(("level4", "model", "auc_gap", gap, verdict, verdict != "investigate_before_deployment"))
    if level5:
        d = level5["dnnr"]
        interp = ("privacy_preserved" if d > DNNR_PRESERVED else
                  "borderline" if d > DNNR_BORDERLINE else "memorization_risk")
        rows.append(("level5", "features", "dnnr", d, interp, interp != "memorization_risk"))
    schema = "level string, column string, metric string, value double, rating string, passed boolean"
    return spark.createDataFrame([(a, b, c, None if v is None else float(v), r, p) for a, b, c, v, r, p in rows],
                                 schema)


#: Levels that must have results before data can be approved.
REQUIRED_LEVELS = ("level1", "level3a", "level3b", "level3c", "level4", "level5")


def approve(results: DataFrame, required: Sequence[str] = REQUIRED_LEVELS) -> DataFrame:
    """VAL-8: approved iff every required level has results and every gating
    check passed; reasons listed, a missing level is one.  Level 1 must be
    there but its ratings are informational (not gating)."""
    failed = F.when(~F.col("passed") & (F.col("level") != "level1"), F.concat_ws(": ", "level", "column", "metric"))
    seen = results.agg(F.collect_set("level").alias("levels"), F.collect_list(failed).alias("failed"))  # a few rows a level
    missing = F.transform(F.array_except(F.array(*map(F.lit, required)), "levels"), lambda x: F.concat(x, F.lit(": no results")))
    reasons = F.array_sort(F.concat("failed", missing))
    return seen.select((F.size(reasons) == 0).alias("approved"), reasons.alias("reasons"))


def validation_summary(results: DataFrame) -> DataFrame:
    """VAL-9: failed checks per level."""
    return (results.filter(F.col("passed").isNotNull())
                   .groupBy("level")
                   .agg(F.count_if(~F.col("passed")).alias("failed"), F.count(F.lit(1)).alias("checks")))


#: Keys under which a level's checks stand in the results document.
DOCUMENT_LEVELS = ("level1", "level3a", "level3b", "level3c", "level4", "level5")


def results_document(results: DataFrame, approved: DataFrame | None = None) -> DataFrame:
    """The nested results document as one row: for each level a map from
    column to its metrics, rating and verdict, then the gate's decision
    (``approved_for_training``, ``gate_failure_reasons``)."""
    gate = (approve(results) if approved is None else approved).select(
        F.col("approved").alias("approved_for_training"), F.col("reasons").alias("gate_failure_reasons"))
    checks = results.groupBy("level", "column").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric", "value")))).alias("metrics"),
        F.max("rating").alias("rating"), F.min("passed").alias("passed"))
    entry = F.struct(F.col("column"), F.struct("metrics", "rating", "passed"))
    levels = checks.agg(*[F.map_from_entries(F.collect_list(F.when(F.col("level") == v, entry))).alias(v) for v in DOCUMENT_LEVELS],
                        gate.select(F.struct("*")).scalar().alias("_gate"))  # a few columns a level
    return levels.select(*DOCUMENT_LEVELS, "_gate.*")


def distribution_tables(real: DataFrame, synth: DataFrame, cols: Sequence[str] = FEATURE_COLUMNS,
                        bins: int = 20) -> DataFrame:
    """VAL-2 as data: equal-width density per column and dataset over the
    common [min, max] range of both datasets (the reference draws these as
    KDE plots; the correlation half is ``profile.correlation_matrix``)."""
    r = melt(real, cols).withColumn("dataset", F.lit("real"))
    s = melt(synth, cols).withColumn("dataset", F.lit("synthetic"))
    both = r.unionByName(s).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    rng = both.groupBy("column").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    both = both.join(F.broadcast(rng), "column")  # one row per column: bounded
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    b = F.when(width > 0, F.least(F.lit(bins - 1), F.floor((F.col("value") - F.col("_lo")) / width))).otherwise(0)
    counts = both.groupBy("column", "dataset", b.cast("int").alias("bin"), "_lo", "_hi").agg(
        F.count(F.lit(1)).alias("n"))
    tot = F.sum("n").over(Window.partitionBy("column", "dataset"))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    return counts.select("column", "dataset", "bin", (F.col("_lo") + F.col("bin") * w).alias("bin_lo"),
                         (F.col("_lo") + (F.col("bin") + 1) * w).alias("bin_hi"), "n",
                         F.when(w > 0, F.col("n") / tot / w).otherwise(F.lit(None).cast("double")).alias("density"))
