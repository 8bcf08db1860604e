"""Trailing time-window aggregates and previous-row lookups (WIN-1..4, WIN-6).

A trailing window ``RANGE BETWEEN lookback PRECEDING AND CURRENT ROW`` over
whole epoch seconds is a plain Spark window when it is partitioned by the
entity key.  That puts every row of one key into one task, which breaks when
one terminal or card BIN carries a large share of all rows (there are only
ten BINs).  The default ``bucketed`` mode therefore partitions by
``(key, floor(sec / bucket_seconds))``: every row is emitted once in its own
bucket and, when it lies within ``lookback`` seconds of the next bucket's
start, once more as *context* for the next bucket.  With
``bucket_seconds >= lookback`` a row's whole frame lies in its own and the
previous bucket, so the result is exact; rows are duplicated by a factor of
about ``1 + lookback / bucket_seconds`` and a hot key is spread over as many
tasks as it has buckets.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEC = "_sec"
BUCKET = "_bucket"
OWN = "_own"


@dataclass(frozen=True)
class Trailing:
    """One trailing aggregate: ``out = agg(value) over the last lookback seconds``.

    ``agg`` is one of ``count`` (non-null values), ``sum``, ``mean``.
    """

    out: str
    agg: str
    value: str | Column
    lookback: int

    def column(self) -> Column:
        return F.col(self.value) if isinstance(self.value, str) else self.value


def with_epoch_seconds(df: DataFrame, ts_col: str = "timestamp", out: str = SEC) -> DataFrame:
    """Whole epoch seconds of the event time (canonical window clock)."""
    return df.withColumn(out, F.unix_seconds(F.col(ts_col)))


def _agg_over(spec: Trailing, w) -> Column:
    v = spec.column()
    if spec.agg == "count":
        return F.count(v).over(w)
    if spec.agg == "sum":
        return F.sum(v).over(w)
    if spec.agg == "mean":
        return F.avg(v).over(w)
    raise ValueError(f"unknown trailing aggregate {spec.agg!r}")


def null_safe_left_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join in which NULL keys match each other; ``right`` adds its other columns."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    cond = None
    for k in on:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, "left").drop(*[f"_r_{k}" for k in on])


def explode_to_buckets(df: DataFrame, sec_col: str, bucket_seconds: int, lookback: int) -> DataFrame:
    """Tag each row with its own time bucket and duplicate the tail of every
    bucket (rows within ``lookback`` of the next bucket) into the next bucket
    as context rows (``_own = false``)."""
    if bucket_seconds < lookback:
        raise ValueError("bucket_seconds must be >= the longest lookback")
    own = F.floor(F.col(sec_col) / F.lit(bucket_seconds)).cast("long")
    df = df.withColumn("_own_bucket", own)
    needs_context = F.col(sec_col) >= (F.col("_own_bucket") + 1) * F.lit(bucket_seconds) - F.lit(lookback)
    buckets = F.when(needs_context, F.array(F.col("_own_bucket"), F.col("_own_bucket") + 1)).otherwise(
        F.array(F.col("_own_bucket")))
    return (df.withColumn(BUCKET, F.explode(buckets))
              .withColumn(OWN, F.col(BUCKET).eqNullSafe(F.col("_own_bucket"))))  # NULL clocks stay


def trailing_aggregates(df: DataFrame, keys: Sequence[str], specs: Sequence[Trailing], *,
                        sec_col: str = SEC, mode: str = "bucketed",
                        bucket_seconds: int | None = None,
                        prev_cols: Sequence[str] = (), prev_order: Sequence[str] = (),
                        prev_prefix: str = "prev_") -> DataFrame:
    """Add every ``Trailing`` spec (inclusive RANGE frame on ``sec_col``, equal
    seconds are peers) and optionally the previous row's ``prev_cols`` per key
    (ordered by ``sec_col`` then ``prev_order``), in one partitioning of ``df``.

    ``mode='plain'`` uses a window partitioned by ``keys`` only (one task per
    key); ``mode='bucketed'`` (default) is the skew-safe form described in the
    module docstring and returns exactly the same values.
    """
    keys = list(keys)
    lookback = max(s.lookback for s in specs) if specs else 0
    if mode == "prefix":
        if prev_cols:
            raise ValueError("prefix mode computes aggregates only; use 'bucketed' for previous rows")
        return trailing_prefix(df, keys, specs, sec_col=sec_col)
    if mode == "plain":
        part = Window.partitionBy(*keys)
        out = df
        if prev_cols:
            wp = part.orderBy(F.col(sec_col), *[F.col(c) for c in prev_order])
            out = out.withColumns({f"{prev_prefix}{c}": F.lag(c).over(wp) for c in prev_cols})
        wr = part.orderBy(F.col(sec_col))
        return out.withColumns({s.out: _agg_over(s, wr.rangeBetween(-s.lookback, 0)) for s in specs})
    if mode == "blocks":
        return trailing_blocks(df, keys, specs, sec_col=sec_col, prev_cols=prev_cols, prev_order=prev_order, prev_prefix=prev_prefix)
    if mode == "by_second":
        return trailing_by_second(df, keys, specs, sec_col=sec_col, bucket_seconds=bucket_seconds, prev_cols=prev_cols,
                                  prev_order=prev_order, prev_prefix=prev_prefix)
    if mode != "bucketed":
        raise ValueError(f"unknown mode {mode!r}")

    width = int(bucket_seconds or max(2 * lookback, 3600))
    ex = explode_to_buckets(df, sec_col, width, max(lookback, 1))
    part = Window.partitionBy(*keys, BUCKET)
    if prev_cols:
        # Finer order first: the range windows below reuse its sort.
        wp = part.orderBy(F.col(sec_col), *[F.col(c) for c in prev_order])
        ex = ex.withColumns({f"{prev_prefix}{c}": F.lag(c).over(wp) for c in prev_cols})
        ex = ex.withColumn("_has_prev", F.lag(F.lit(True), 1, False).over(wp))
    wr = part.orderBy(F.col(sec_col))
    ex = ex.withColumns({s.out: _agg_over(s, wr.rangeBetween(-s.lookback, 0)) for s in specs})
    ex = ex.filter(F.col(OWN))
    if prev_cols:
        ex = _fill_prev_from_earlier_buckets(df, ex, keys, sec_col, width, prev_cols, prev_order, prev_prefix)
    return ex.drop(BUCKET, OWN, "_own_bucket", "_has_prev")


def _fill_prev_from_earlier_buckets(base: DataFrame, ex: DataFrame, keys, sec_col, width,
                                    prev_cols, prev_order, prev_prefix) -> DataFrame:
    """A row whose bucket partition holds no earlier row gets its predecessor
    from the last row of the key's latest earlier non-empty bucket.

    The lookup table has one row per (key, non-empty bucket), so it is small
    next to the data and its lag window is cheap even for a hot key.
    """
    order = F.struct(F.col(sec_col), *[F.col(c) for c in prev_order])
    last = (base.withColumn("_own_bucket", F.floor(F.col(sec_col) / F.lit(width)).cast("long"))
                .groupBy(*keys, "_own_bucket")
                .agg(F.max_by(F.struct(*[F.col(c) for c in prev_cols]), order).alias("_last")))
    wl = Window.partitionBy(*keys).orderBy("_own_bucket")
    lookup = (last.withColumn("_carry", F.lag("_last").over(wl))
                  .withColumn("_carry_ok", F.lag(F.lit(True), 1, False).over(wl))
                  .select(*keys, F.col("_own_bucket").alias(BUCKET), "_carry", "_carry_ok"))
    joined = null_safe_left_join(ex, lookup, [*keys, BUCKET])
    has_prev = F.col("_has_prev")
    cols = {f"{prev_prefix}{c}": F.when(has_prev, F.col(f"{prev_prefix}{c}")).otherwise(F.col(f"_carry.{c}"))
            for c in prev_cols}
    cols["_has_prev"] = has_prev | F.coalesce(F.col("_carry_ok"), F.lit(False))
    return joined.withColumns(cols).drop("_carry", "_carry_ok")


def trailing_by_second(df: DataFrame, keys: Sequence[str], specs: Sequence[Trailing], *, sec_col: str = SEC,
                       bucket_seconds: int | None = None, prev_cols: Sequence[str] = (),
                       prev_order: Sequence[str] = (), prev_prefix: str = "prev_") -> DataFrame:
    """The same values as ``trailing_aggregates`` for any skew of the keys.

    Rows of one second are peers, so trailing values are a property of
    ``(key, second)``.  Rows are first reduced to one per key and second with
    map-side partial sums; the bucketed windows run over those, so a task's
    rows are bounded by the seconds of its bucket whatever the volume; the
    values go back to the rows by a join on ``(key, second)``.  A row's
    predecessor is the one before it in its second, else the last row of the
    key's previous second.  NULL keys and NULL clocks are groups like others.
    """
    keys = list(keys)
    parts = {}
    for i, s in enumerate(specs):
        if s.agg not in ("count", "sum", "mean"):
            raise ValueError(f"unknown trailing aggregate {s.agg!r}")
        if s.agg in ("count", "mean"):
            parts[f"_n{i}"] = F.count(s.column())
        if s.agg in ("sum", "mean"):
            parts[f"_s{i}"] = F.sum(s.column())
    if prev_cols:
        order = F.struct(*[F.col(c) for c in prev_order])
        parts["_last"] = F.max_by(F.struct(*[F.col(c) for c in prev_cols]), order)
    per_second = df.groupBy(*keys, sec_col).agg(*[c.alias(k) for k, c in parts.items()])
    inner = [Trailing(f"_t{k}", "sum", k, specs[int(k[2:])].lookback) for k in parts if k != "_last"]
    t = trailing_aggregates(per_second, keys, inner, sec_col=sec_col, bucket_seconds=bucket_seconds,
                            prev_cols=["_last"] if prev_cols else (), prev_prefix="_before")
    values = {}
    for i, s in enumerate(specs):
        if s.agg == "count":
            values[s.out] = F.col(f"_t_n{i}")
        elif s.agg == "sum":
            values[s.out] = F.col(f"_t_s{i}")
        else:
            values[s.out] = F.try_divide(F.col(f"_t_s{i}").cast("double"), F.col(f"_t_n{i}").cast("double"))
    t = t.withColumns(values).select(*keys, sec_col, *values, *(["_before_last"] if prev_cols else []))
    out = null_safe_left_join(df, t, [*keys, sec_col])
    if prev_cols:
        w = Window.partitionBy(*keys, sec_col).orderBy(*[F.col(c) for c in prev_order])
        out = out.withColumn("_has_prev", F.lag(F.lit(True), 1, False).over(w))
        out = out.withColumns({f"{prev_prefix}{c}": F.when(F.col("_has_prev"), F.lag(c).over(w))
                              .otherwise(F.col(f"_before_last.{c}")) for c in prev_cols}).drop("_has_prev", "_before_last")
    return out


#: Width of the blocks of ``trailing_blocks``; lookbacks are multiples of it.
#: Narrower blocks spread a hotter key, and cost more small partitions.
BLOCK_SECONDS = 1800


def trailing_blocks(df: DataFrame, keys: Sequence[str], specs: Sequence[Trailing], *, sec_col: str = SEC,
                    block_seconds: int = BLOCK_SECONDS, prev_cols: Sequence[str] = (), prev_order: Sequence[str] = (),
                    prev_prefix: str = "prev_") -> DataFrame:
    """The same values from two-level sums, without a join back to the rows.

    A trailing window that ends in a block of seconds is the block up to the
    row, the whole blocks before it, and the end of the block in which it
    begins.  A (key, block) partition holds the block's rows, thin copies of
    the rows of the block where its windows begin, and one header: the sums of
    the whole blocks between (a window over one row a block) and the key's
    last row before the block.  All frames only grow, so a partition takes
    linear time; a hot key is spread over its blocks.  Only whole numbers are
    subtracted (the end of the oldest block is its total less its beginning);
    other sums run over that block backwards, so they lose no digits.  NULL
    keys and NULL clocks are groups like others.
    """
    keys = list(keys)
    parts: dict[str, tuple[Column, int]] = {}
    for i, s in enumerate(specs):
        if s.agg not in ("count", "sum", "mean"):
            raise ValueError(f"unknown trailing aggregate {s.agg!r}")
        if s.lookback % block_seconds:
            raise ValueError("lookbacks must be multiples of the block")
        if s.agg in ("count", "mean"):
            parts[f"n{i}"] = (F.when(s.column().isNotNull(), F.lit(1).cast("long")), s.lookback)
        if s.agg in ("sum", "mean"):
            parts[f"s{i}"] = (s.column(), s.lookback)
    key_names = [f"_k{j}" for j in range(len(keys))]
    part = [*key_names, "_block"]
    places, order = [F.col(c) for c in prev_cols], F.struct(F.col(sec_col), *[F.col(c) for c in prev_order])
    block = F.floor(F.col(sec_col) / F.lit(block_seconds)).cast("long")
    base = df.select(*[F.col(k).alias(n) for k, n in zip(keys, key_names)], block.alias("_block"),
                     (F.col(sec_col) - block * block_seconds).cast("int").alias("_off"), F.struct(*df.columns).alias("_row"),
                     *[c.alias(f"_p_{k}") for k, (c, _) in parts.items()],
                     *([F.struct(*places).alias("_place"), order.alias("_order")] if prev_cols else []))
    rows = base.withColumn("_kind", F.lit(2))

    last = [F.max_by("_place", "_order").alias("_last")] if prev_cols else []
    blocks = base.groupBy(*part).agg(*[F.sum(f"_p_{k}").alias(f"_b_{k}") for k in parts], *last, F.count(F.lit(1)).alias("_rows"))
    w = Window.partitionBy(*key_names).orderBy("_block")
    between = {f"_h_{k}": F.when(F.col("_block").isNotNull(), F.sum(f"_b_{k}").over(w.rangeBetween(1 - lookback // block_seconds, -1)))
               for k, (_, lookback) in parts.items() if lookback > block_seconds}
    never_null = {k for k in parts if not base.schema[f"_p_{k}"].nullable}
    whole = {k for k in parts if k[0] == "n" or (k in never_null and base.schema[f"_p_{k}"].dataType.typeName() in ("long", "integer"))}
    between.update({f"_e_{k}": F.when(F.col("_block").isNotNull(), F.sum(f"_b_{k}").over(w.rangeBetween(*[-(parts[k][1] // block_seconds)] * 2)))
                    for k in whole})
    headers = blocks.select(*part, F.lit(-1).alias("_off"), F.lit(0).alias("_kind"), *[c.alias(n) for n, c in between.items()],
                            *([F.lag("_last").over(w).alias("_place")] if prev_cols else []))
    merged = rows.unionByName(headers, allowMissingColumns=True)
    lookbacks = sorted({lookback for _, lookback in parts.values()})
    if lookbacks:
        old = base.filter(F.col("_block").isNotNull()).withColumn("_back", F.explode(F.array(*[F.lit(x) for x in lookbacks]))).select(
            *key_names, (F.col("_block") + (F.col("_back") / block_seconds).cast("long")).alias("_block"), "_off", F.lit(1).alias("_kind"),
            *[F.when(F.col("_back") == lookback, F.col(f"_p_{k}")).alias(f"_o_{k}") for k, (_, lookback) in parts.items()])
        # a zero adds nothing; it is kept where a sum may also be NULL
        any_part = F.lit(False)
        for k in parts:
            part_of = F.col(f"_o_{k}")
            any_part = any_part | (part_of.isNotNull() & (part_of != 0) if k in never_null else part_of.isNotNull())
        merged = merged.unionByName(old.filter(any_part), allowMissingColumns=True)

    cols = {}
    if prev_cols:
        fine = Window.partitionBy(*part).orderBy("_off", "_kind", "_order").rowsBetween(Window.unboundedPreceding, -1)
        cols["_before"] = F.last("_place", ignorenulls=True).over(fine)
    up = Window.partitionBy(*part).orderBy("_off").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy(*part).orderBy(F.desc("_off")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    early = Window.partitionBy(*part).orderBy("_off").rangeBetween(Window.unboundedPreceding, -1)
    for k in parts:
        cols[f"_u_{k}"] = F.sum(f"_p_{k}").over(up)
        if k in whole:  # no NULL where the block is not there: nothing is subtracted then
            cols[f"_d_{k}"] = F.max(f"_e_{k}").over(up) - F.coalesce(F.sum(f"_o_{k}").over(early), F.lit(0))
        else:
            cols[f"_d_{k}"] = F.sum(f"_o_{k}").over(down)
        if f"_h_{k}" in between:
            cols[f"_m_{k}"] = F.max(f"_h_{k}").over(up)
    out = merged.withColumns(cols).filter(F.col("_kind") == 2)

    def total(k):
        found = [F.col(f"_{x}_{k}") for x in "umd" if f"_{x}_{k}" in cols]
        zero = F.lit(0)
        every = sum((F.coalesce(c, zero) for c in found[1:]), F.coalesce(found[0], zero))
        return F.when(F.coalesce(*found).isNotNull(), every)

    made = {}
    for i, s in enumerate(specs):
        if s.agg == "count":
            made[s.out] = F.coalesce(total(f"n{i}"), F.lit(0)).cast("long")
        elif s.agg == "sum":
            made[s.out] = total(f"s{i}")
        else:
            made[s.out] = F.try_divide(total(f"s{i}").cast("double"), total(f"n{i}").cast("double"))
    made.update({f"{prev_prefix}{c}": F.col(f"_before.{c}") for c in prev_cols})
    return out.select("_row.*", *[c.alias(n) for n, c in made.items()])


def trailing_window_agg(df: DataFrame, group: Sequence[str] | str, seconds: int, how: str = "sum",
                        value: str | None = None, out: str = "trailing", *, ts_col: str = "timestamp",
                        tie_policy: str = "peers", tie_order: str | None = None,
                        mode: str = "bucketed", bucket_seconds: int | None = None) -> DataFrame:
    """Generic inclusive trailing window (WIN-6).

    ``how``: ``sum`` (of ``value``, or row count when ``value`` is None) or
    ``mean`` of ``value``.  ``tie_policy='peers'`` lets rows with the same
    second see each other; ``'row'`` lets a row see only equal-second rows at
    or before it in ``tie_order``.
    """
    group = [group] if isinstance(group, str) else list(group)
    d = with_epoch_seconds(df, ts_col)
    val = F.lit(1) if value is None else F.col(value)
    d = d.withColumn("_v", val).withColumn("_one", F.when(F.col("_v").isNotNull(), F.lit(1)))
    if tie_policy == "peers":
        d = trailing_aggregates(d, group, [Trailing("_s", "sum", "_v", seconds),
                                           Trailing("_n", "sum", "_one", seconds)],
                                mode=mode, bucket_seconds=bucket_seconds)
        s, n = F.col("_s"), F.col("_n")
    elif tie_policy == "row":
        if tie_order is None:
            raise ValueError("tie_policy='row' needs tie_order")
        # Strictly earlier seconds via the RANGE frame, plus equal-second rows
        # up to the current one.  The peer window is partitioned by a superset
        # of the range window's keys, so it reuses the same shuffle.
        d = _row_policy(d, group, seconds, tie_order, mode, bucket_seconds)
        s, n = F.col("_s"), F.col("_n")
    else:
        raise ValueError(f"unknown tie_policy {tie_policy!r}")
    if how == "sum":
        res = F.coalesce(n, F.lit(0)).cast("long") if value is None else F.when(n > 0, s)
    elif how == "mean":
        res = F.try_divide(s.cast("double"), n.cast("double"))
    else:
        raise ValueError(f"unknown how {how!r}")
    return d.withColumn(out, res).drop("_s", "_n", "_v", "_one", SEC)


def _row_policy(d: DataFrame, group, seconds, tie_order, mode, bucket_seconds) -> DataFrame:
    if mode == "plain":
        part_keys = list(group)
        ex = d
    else:
        width = int(bucket_seconds or max(2 * seconds, 3600))
        ex = explode_to_buckets(d, SEC, width, max(seconds, 1))
        part_keys = list(group) + [BUCKET]
    wr = Window.partitionBy(*part_keys).orderBy(F.col(SEC))
    earlier = wr.rangeBetween(-seconds, -1)
    peers = Window.partitionBy(*part_keys, SEC).orderBy(F.col(tie_order)).rowsBetween(
        Window.unboundedPreceding, 0)
    ex = ex.withColumns({
        "_s": F.coalesce(F.sum("_v").over(earlier), F.lit(0)) + F.coalesce(F.sum("_v").over(peers), F.lit(0)),
        "_n": F.coalesce(F.sum("_one").over(earlier), F.lit(0)) + F.coalesce(F.sum("_one").over(peers), F.lit(0)),
    })
    if mode != "plain":
        ex = ex.filter(F.col(OWN)).drop(BUCKET, OWN, "_own_bucket")
    return ex


def trailing_prefix(df: DataFrame, keys: Sequence[str], specs: Sequence[Trailing], *, sec_col: str = SEC,
                    n_buckets: int | None = None, source: DataFrame | None = None) -> DataFrame:
    """Count/sum/mean trailing windows as differences of per-key prefix sums.

    value(t) = P(t) - P(t - lookback - 1), where P(x) sums the key's rows with
    second <= x.  Rows are first collapsed to one row per (key, second);
    zero-weight probe rows at ``second - lookback - 1`` are added, and
    ``cumulative.running_totals`` (grouped by key, each key split into
    buckets at its own percentiles) gives P at every data and probe point.
    No task ever holds a whole window of a hot key: work is split down to
    single seconds.  Sums use DECIMAL(38, 12), so differences of prefixes are
    exact (no floating-point cancellation) for finite values of at most twelve
    decimals; it is used on request only, never chosen by size.  ``source``:
    the same rows without what joins added to ``df``, so that the sums do not
    run those joins again.
    """
    from tillguard.operators.cumulative import running_totals

    keys = list(keys)
    w = {}
    for i, s in enumerate(specs):
        v = s.column()
        if s.agg in ("count", "mean"):
            w[f"_n{i}"] = F.count(v).cast("long")
        if s.agg in ("sum", "mean"):
            w[f"_s{i}"] = F.coalesce(F.sum(v.cast("decimal(38,12)")), F.lit(0).cast("decimal(38,12)"))
        if s.agg not in ("count", "sum", "mean"):
            raise ValueError(f"prefix mode supports count/sum/mean, not {s.agg!r}")
    per_sec = (df if source is None else source).groupBy(*keys, sec_col).agg(*[c.alias(k) for k, c in w.items()])
    data = per_sec.select(*keys, (F.col(sec_col) * 2).alias("_ok"), *w)
    lookbacks = sorted({s.lookback for s in specs})
    probes = None
    for lb in lookbacks:
        p = per_sec.select(*keys, ((F.col(sec_col) - lb - 1) * 2 + 1).alias("_ok"))
        probes = p if probes is None else probes.unionByName(p)
    zero = {k: (F.lit(0).cast("long") if k.startswith("_n") else F.lit(0).cast("decimal(38,12)")) for k in w}
    probes = probes.distinct().select(*keys, "_ok", *[c.alias(k) for k, c in zero.items()])
    cum = running_totals(data.unionByName(probes), "_ok", list(w), group=keys, n_buckets=n_buckets)
    cum = cum.select(*keys, "_ok", *[F.col(f"cum_{k}").alias(k) for k in w])

    # one pass: a point's sums go to its second, a probe's to the seconds that may ask for them, and meet in one row a second
    point = F.col("_ok") % 2 == 0
    to = F.when(point, F.array(F.struct((F.col("_ok") / 2).cast("long").alias("sec"), F.lit(0).alias("back")))).otherwise(
        F.array(*[F.struct(((F.col("_ok") - 1) / 2 + lb + 1).cast("long").alias("sec"), F.lit(lb + 1).alias("back")) for lb in lookbacks]))
    met = cum.withColumn("_to", F.explode(to)).groupBy(*keys, F.col("_to.sec").alias(sec_col)).agg(*[
        F.max(F.when(F.col("_to.back") == back, F.col(k))).alias(f"{k}{name}")
        for k in w for back, name in [(0, "_now"), *[(lb + 1, f"_then{lb}") for lb in lookbacks]]])
    out = null_safe_left_join(df, met, [*keys, sec_col])
    cols = {}
    for i, s in enumerate(specs):
        def diff(k):
            return F.col(f"{k}_now") - F.coalesce(F.col(f"{k}_then{s.lookback}"), F.lit(0))
        if s.agg == "count":
            cols[s.out] = diff(f"_n{i}").cast("long")
        elif s.agg == "sum":
            cols[s.out] = F.when(diff(f"_n{i}") > 0, diff(f"_s{i}")).cast("double") if f"_n{i}" in w \
                else diff(f"_s{i}").cast("double")
        else:
            n = diff(f"_n{i}")
            cols[s.out] = F.when(n > 0, (diff(f"_s{i}") / n).cast("double"))
    out = out.withColumns(cols)
    drop = [f"{k}_now" for k in w] + [f"{k}_then{lb}" for k in w for lb in lookbacks]
    return out.drop(*drop)
