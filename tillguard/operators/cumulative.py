"""Exact running totals over a value order without a single-task window.

ROC AUC, average precision, the F1-optimal threshold, the two-sample KS
statistic, the Wasserstein distance, exact percentiles and the exact
stratified split all need running sums over values in sorted order.  A
``Window.orderBy`` without a partition key moves every row into one task.
Here the work is spread instead:

1. the input holds one row per distinct value (see ``weights_by_value``: a
   ``groupBy`` with map-side partial aggregation, so one very frequent value
   is harmless) per optional ``group`` (e.g. a column name);
2. one range partitioning by (group, value) deals the rows to ``n_buckets``
   buckets; the result is checkpointed at once (an eager job), since both
   of the next steps read it;
3. per (group, bucket) totals -> offsets of all earlier buckets and group
   totals, computed on that small table (at most groups x n_buckets rows)
   and broadcast back;
4. running sum inside each (group, bucket) window, plus the offset.

The result is exact; only the balance of the buckets is approximate.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BKT = "_bkt"


def default_buckets(df: DataFrame) -> int:
    try:
        return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    except Exception:  # noqa: BLE001
        return 64


def weights_by_value(df: DataFrame, value: str | Column, weights: dict[str, Column], out: str = "value",
                     group: Sequence[str] = ()) -> DataFrame:
    """One row per (group, distinct non-null non-NaN value) with summed weights."""
    v = F.col(value) if isinstance(value, str) else value
    d = df.select(*group, v.alias(out), *[w.alias(k) for k, w in weights.items()])
    if dict(d.dtypes)[out] in ("double", "float"):
        # NaN -> NULL, so one predicate remains (it is pushed below the
        # projection and would otherwise re-evaluate the value expression)
        d = d.withColumn(out, F.nanvl(F.col(out), F.lit(None).cast("double")))
    d = d.filter(F.col(out).isNotNull())
    return d.groupBy(*group, out).agg(*[F.sum(k).alias(k) for k in weights])


def running_totals(df: DataFrame, key: str, sum_cols: Sequence[str], *, group: str | Sequence[str] | None = None,
                   descending: bool = False, n_buckets: int | None = None, prefix: str = "cum_",
                   with_next: bool = False) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum of ``c`` in ``key`` order within
    the group) and ``tot_<c>`` (group total).

    ``df`` must hold one row per (group, distinct ``key``).  ``with_next``
    also adds ``next_<key>``: the following distinct key of the group.
    """
    from tillguard.session import materialize

    gcols = [group] if isinstance(group, str) else list(group or [])
    n_buckets = n_buckets or default_buckets(df)
    okey = "_okey"
    # Buckets are ranges of (group, key) from one range partitioning.  The
    # per-bucket totals and the running sums both read this table: it is
    # materialised once (shared checkpoint dir), with its bucket numbers.
    d = df.withColumn(okey, -F.col(key) if descending else F.col(key))
    if n_buckets > 1:
        d = d.repartitionByRange(n_buckets, *gcols, okey).withColumn(BKT, F.spark_partition_id())
    else:
        d = d.withColumn(BKT, F.lit(0))
    d = materialize(d)

    part = [*gcols, BKT]
    totals = d.groupBy(*part).agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols], F.min(okey).alias("_bmin"))
    wg = Window.partitionBy(*gcols).orderBy(BKT)
    offsets = totals.select(
        *part,
        *[F.coalesce(F.sum(f"_t_{c}").over(wg.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
          .alias(f"_o_{c}") for c in sum_cols],
        *[F.sum(f"_t_{c}").over(Window.partitionBy(*gcols)).alias(f"tot_{c}") for c in sum_cols],
        F.lead("_bmin").over(wg).alias("_next_bmin"))
    # at most (groups x n_buckets) rows; broadcast outright only without
    # groups (then bounded by n_buckets), else AQE decides by measured size
    d = d.join(offsets if gcols else F.broadcast(offsets), on=part, how="left")
    wl = Window.partitionBy(*part).orderBy(okey)
    cols = {f"{prefix}{c}": F.col(f"_o_{c}") + F.sum(c).over(wl.rowsBetween(Window.unboundedPreceding, 0))
            for c in sum_cols}
    if with_next:
        nxt = F.coalesce(F.lead(okey).over(wl), F.col("_next_bmin"))
        cols[f"next_{key}"] = -nxt if descending else nxt
    d = d.withColumns(cols)
    return d.drop(BKT, okey, "_next_bmin", *[f"_o_{c}" for c in sum_cols])


def _qname(p: float) -> str:
    return f"q{int(round(p * 100))}" if abs(p * 100 - round(p * 100)) < 1e-9 else f"q{p}"


def grouped_quantiles(df: DataFrame, value: str, probs: Sequence[float], *, group: Sequence[str] = (),
                      n_buckets: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy/pandas default) per
    group: one row per group with ``q<pct>`` columns."""
    counts = weights_by_value(df, value, {"n": F.lit(1).cast("long")}, group=list(group))
    cum = running_totals(counts, "value", ["n"], group=list(group) or None, n_buckets=n_buckets)
    exprs = []
    for p in probs:
        h = (F.col("tot_n") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        # value at 0-based rank r = smallest value whose inclusive count > r
        v_lo = F.min(F.when(F.col("cum_n") > lo, F.col("value")))
        v_hi = F.min(F.when(F.col("cum_n") > hi, F.col("value")))
        frac = F.first(h - lo)
        exprs.append((v_lo + frac * (v_hi - v_lo)).cast("double").alias(_qname(p)))
    return cum.groupBy(*group).agg(*exprs)


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], *, n_buckets: int | None = None) -> DataFrame:
    """Exact quantiles of one column (one row; NULL when empty)."""
    names = [_qname(p) for p in probs]
    q = grouped_quantiles(df, col, probs, n_buckets=n_buckets).select(F.struct(*names).alias("_q"))
    # one scalar subquery; an empty input gives a row of NULLs
    return df.sparkSession.range(1).select(q.scalar().alias("_q")).select(*[F.col(f"_q.{n}").alias(n) for n in names])


def melt(df: DataFrame, cols: Sequence[str], name: str = "column", value: str = "value",
         keep: Sequence[str] = ()) -> DataFrame:
    """Wide -> long (column, value) with the values cast to double."""
    expr = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return df.selectExpr(*[f"`{k}`" for k in keep], f"stack({len(cols)}, {expr}) as ({name}, {value})")



def global_positions(df: DataFrame, order: Sequence[str | Column], out: str = "position") -> DataFrame:
    """0-based position of every row in ``order`` (any orderable columns,
    strings included), exact and distributed: a range-partitioned sort,
    materialised once with ``checkpoint()``; then position = rows in earlier
    partitions (a table of one row per partition) + index inside the
    partition."""
    from tillguard.session import materialize
    s = materialize(df.orderBy(*order)
                      .withColumn("_pid", F.spark_partition_id())
                      .withColumn("_mid", F.monotonically_increasing_id()))
    per = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = per.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    # one row per partition: bounded
    s = s.join(F.broadcast(offs), "_pid")
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return s.withColumn(out, F.col("_off") + local).drop("_pid", "_mid", "_off")
