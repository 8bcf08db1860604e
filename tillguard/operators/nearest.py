"""Exact nearest-neighbour distances without a pair join (VAL-7).

For every query row: the Euclidean distance to the nearest reference point
(optionally not counting the row itself).  The search is exact and avoids
comparing every query with every point:

1. Reference points and queries are collapsed to distinct coordinate tuples
   with both counts, in one aggregate.  A query equal to a reference tuple has
   distance 0 (for the "other point" variant: when the tuple occurs at least
   twice); this also removes clusters of identical rows, the usual source of
   skew.
2. A k-d partition with one leaf for each ``leaf_points`` distinct points, but
   at most ``MOST_LEAVES``, is grown on the driver from about ``sample_size`` of
   them (at most one leaf for eight sampled points) and broadcast.  Every point
   is routed to its leaf; the leaves' bounding boxes come from the data.
3. Each query first visits the leaf that it is routed to.  Most are nearer to a
   point there than to the walls of the leaf and are done: what a query costs
   does not grow with the number of leaves.  Within a leaf points and queries
   are partitioned again, and boxes are ruled out for a group of near queries
   at once.
4. Best-first rounds for the others: each visits its 2, 4, ... next leaves in
   the order of their boxes' distance, as far as they are nearer than its best
   distance so far.  A query closes when its next box is not nearer than its
   best distance.  The bound tightens between rounds, and rounds number the
   logarithm of the most leaves that a query needs; only leaves that some open
   query wants are read again.

Only per-query minima leave a task, never pairs.  ``leaf_visits`` of the
result says how many leaves a query visited.  Queries with a null or
non-finite coordinate have a null distance and no visits; such points do not
count.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _grow_kd(sample: np.ndarray, max_leaves: int):
    """Median splits on the widest dimension, each side with leaves in
    proportion to its points; returns (dim, thr, left, right, leaf) arrays, leaf
    = -1 for inner nodes."""
    dims, thrs, lefts, rights, leaves = [], [], [], [], []
    counter = [0]

    def node(x, budget):
        i = len(dims)
        dims.append(-1); thrs.append(0.0); lefts.append(-1); rights.append(-1); leaves.append(-1)
        if budget <= 1 or len(x) <= 1:
            leaves[i] = counter[0]; counter[0] += 1
            return i
        spread = x.max(axis=0) - x.min(axis=0)
        d = int(np.argmax(spread))
        if spread[d] <= 0:
            leaves[i] = counter[0]; counter[0] += 1
            return i
        t = float(np.median(x[:, d]))
        lo = x[:, d] < t
        if not lo.any():  # half of the points or more have the least value: they are one side
            t = float(x[x[:, d] > t, d].min())
            lo = x[:, d] < t
        below, t = float(x[lo, d].max()), float(x[~lo, d].min())
        mid = below + (t - below) / 2.0  # walls keep off the points
        dims[i], thrs[i] = d, mid if below < mid < t else t
        share = min(max(1, round(budget * int(lo.sum()) / len(x))), budget - 1)
        lefts[i] = node(x[lo], share)
        rights[i] = node(x[~lo], budget - share)
        return i

    node(sample, max_leaves)
    return (np.array(dims), np.array(thrs), np.array(lefts), np.array(rights), np.array(leaves))


def _route(x: np.ndarray, tree) -> np.ndarray:
    dims, thrs, lefts, rights, leaves = tree
    node = np.zeros(len(x), dtype=int)
    inner = leaves[node] < 0
    while inner.any():
        idx = np.where(inner)[0]
        d = dims[node[idx]]
        go_left = x[idx, d] < thrs[node[idx]]
        node[idx] = np.where(go_left, lefts[node[idx]], rights[node[idx]])
        inner = leaves[node] < 0
    return leaves[node]


def _cells(tree, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper walls of each leaf (infinite on the outside)."""
    dim, thr, left, right, leaf = tree
    n = int(leaf.max()) + 1
    lo, hi = np.full((n, dims), -np.inf), np.full((n, dims), np.inf)
    todo = [(0, np.full(dims, -np.inf), np.full(dims, np.inf))]
    while todo:
        i, a, b = todo.pop()
        if leaf[i] >= 0:
            lo[leaf[i]], hi[leaf[i]] = a, b
            continue
        cut = b.copy(), a.copy()
        cut[0][dim[i]] = cut[1][dim[i]] = thr[i]
        todo += [(left[i], a, cut[0]), (right[i], cut[1], b)]
    return lo, hi


#: distances computed at once between points, or between rows and boxes
CACHE_CELLS = 65_536
#: rows for which boxes are ruled out at once
GROUP_ROWS = 512
#: leaves of the partition at most; what is held of each leaf is on the driver and in each task
MOST_LEAVES = 1024


#: points of a leaf, or queries, that are searched without a partition of their own; points of its leaves
BRUTE_POINTS, BRUTE_QUERIES, LOCAL_LEAF = 512, 128, 64


def _cuts(where: np.ndarray, most: int | None = None) -> np.ndarray:
    """Ends of the runs of equal numbers (of at most ``most``), 0 first."""
    ends = np.nonzero(np.diff(where))[0] + 1 if len(where) else np.zeros(0, dtype=int)
    if most is not None:
        ends = np.union1d(ends, np.arange(most, len(where), most))
    return np.concatenate([[0], ends, [len(where)]] if len(where) else [[0]]).astype(int)


def _box_gaps(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distance of each row of x to each box."""
    d2 = np.zeros((len(x), len(lo)))
    for j in range(x.shape[1]):
        gap = np.maximum(lo[None, :, j] - x[:, j, None], x[:, j, None] - hi[None, :, j])
        np.maximum(gap, 0.0, out=gap)
        gap *= gap
        d2 += gap
    return d2


def _possible(x: np.ndarray, best: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Numbers of the boxes that may be nearer than its best to one of the rows."""
    gap = np.maximum(0.0, np.maximum(lo - x.max(axis=0), x.min(axis=0) - hi))
    return np.nonzero((gap ** 2).sum(axis=1) < best.max() ** 2)[0]


def _near_boxes(x: np.ndarray, best: np.ndarray, cuts: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Rows and boxes nearer than the rows' best, with the squared distance;
    rows between two cuts should lie near each other."""
    none = np.zeros(0, dtype=int)
    rows, boxes, gaps = [none], [none], [np.zeros(0)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        some = _possible(x[a:b], best[a:b], lo, hi)
        step = max(1, CACHE_CELLS // max(1, len(some)))
        for s in range(a, b, step) if len(some) else ():
            e = min(b, s + step)
            d2 = _box_gaps(x[s:e], lo[some], hi[some])
            row, at = np.nonzero(d2 < best[s:e, None] ** 2)
            rows.append(row + s)
            boxes.append(some[at])
            gaps.append(d2[row, at])
    return np.concatenate(rows), np.concatenate(boxes), np.concatenate(gaps)


def _min_dist(q: np.ndarray, p: np.ndarray, exclude_equal: bool, best: np.ndarray | None = None) -> np.ndarray:
    """Min distance from each q to the points p, or ``best`` where that is
    less.  Many points are partitioned again within the task (leaves of about
    LOCAL_LEAF points, as many as the points need); a query is searched in its
    own leaf, then in those whose box is nearer than its best distance so far,
    so a leaf that grows with the data stays cheap."""
    best = np.full(len(q), np.inf) if best is None else best
    if len(p) <= BRUTE_POINTS or len(q) <= BRUTE_QUERIES:
        return np.minimum(best, _brute_dist(q, p, exclude_equal))
    tree = _grow_kd(p, len(p) // LOCAL_LEAF)
    leaf = _route(p, tree)
    p = p[np.argsort(leaf, kind="stable")]
    ends = np.cumsum(np.bincount(leaf))  # no leaf is empty: the tree is grown from these points
    starts = np.concatenate([[0], ends[:-1]])
    lo, hi = np.minimum.reduceat(p, starts), np.maximum.reduceat(p, starts)
    home = _route(q, tree)
    by = np.argsort(home, kind="stable")
    q, home, out = q[by], home[by], best[by]
    cuts = _cuts(home)
    for a, b in zip(cuts[:-1], cuts[1:]):
        w = home[a]
        out[a:b] = np.minimum(out[a:b], _brute_dist(q[a:b], p[starts[w]:ends[w]], exclude_equal))
    for s in range(0, len(q), CACHE_CELLS):
        some = slice(s, s + CACHE_CELLS)
        rows, boxes, _ = _near_boxes(q[some], out[some], _cuts(home[some], GROUP_ROWS), lo, hi)
        rows += s
        other = boxes != home[rows]
        rows, boxes = rows[other], boxes[other]
        order = np.argsort(boxes, kind="stable")
        rows, boxes = rows[order], boxes[order]
        turns = _cuts(boxes)
        for a, b in zip(turns[:-1], turns[1:]):
            part, w = rows[a:b], boxes[a]
            out[part] = np.minimum(out[part], _brute_dist(q[part], p[starts[w]:ends[w]], exclude_equal))
    back = np.empty_like(out)
    back[by] = out
    return back


def _brute_dist(q: np.ndarray, p: np.ndarray, exclude_equal: bool) -> np.ndarray:
    """Min distance from each q to the points p; with ``exclude_equal`` a
    point with the very same coordinates does not count (distinct tuples
    always have a positive distance)."""
    out = np.full(len(q), np.inf)
    if len(p) == 0 or len(q) == 0:
        return out
    chunk = max(1, CACHE_CELLS // len(p))
    by_dim = np.ascontiguousarray(p.T)
    for s in range(0, len(q), chunk):
        qs = q[s:s + chunk]
        d2 = np.zeros((len(qs), len(p)))
        for j in range(q.shape[1]):  # a dimension at a time: the block stays in the cache
            gap = qs[:, j, None] - by_dim[None, j]
            gap *= gap
            d2 += gap
        if exclude_equal:
            d2[d2 == 0.0] = np.inf
        out[s:s + chunk] = np.sqrt(d2.min(axis=1))
    return out


def next_leaves(x: np.ndarray, best: np.ndarray, visited: np.ndarray, lo: np.ndarray, hi: np.ndarray,
                take: int, home: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Up to ``take`` next boxes of each row of ``x`` in the order of (distance,
    number), after its first ``visited`` ones and nearer than ``best``: row and
    box numbers, and of each row the distance of the box that would follow
    (infinite if that may be no nearer than ``best``).  ``home``: number of the
    box that comes first, whatever its distance."""
    rows, boxes, after = [], [], np.full(len(x), np.inf)
    first = np.full(len(x), -1) if home is None else home
    by = np.lexsort((best, first))  # rows of one home and of like distances share what is ruled out
    cuts = _cuts(first[by], GROUP_ROWS)
    for a, b in zip(cuts[:-1], cuts[1:]):
        some = _possible(x[by[a:b]], best[by[a:b]], lo, hi)
        if home is not None:
            some = np.union1d(some, first[by[a]])
        step = max(1, CACHE_CELLS // max(1, len(some)))
        for s in range(a, b, step):
            at = by[s:min(b, s + step)]
            gap = np.sqrt(_box_gaps(x[at], lo[some], hi[some]))
            if home is not None:
                gap[:, np.searchsorted(some, first[by[a]])] = -1.0
            order = np.argsort(gap, axis=1, kind="stable")
            gap = np.take_along_axis(gap, order, axis=1)
            rank = np.arange(gap.shape[1])[None, :] - visited[at, None]
            row, place = np.nonzero((rank >= 0) & (rank < take) & (gap < best[at, None]))
            rows.append(at[row])
            boxes.append(some[order[row, place]])
            follow = visited[at] + take
            has = np.nonzero(follow < gap.shape[1])[0]
            after[at[has]] = gap[has, follow[has]]
    none = np.zeros(0, dtype=int)
    return np.concatenate(rows or [none]), np.concatenate(boxes or [none]), after


def _tuples(points: DataFrame, queries: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct coordinate tuples: ``_p`` points and ``_q`` queries have them;
    ``_whole`` if no coordinate is null or not finite (others are no points)."""
    from tillguard.session import materialize
    of = lambda df, p, q: df.select(*[F.col(c).cast("double").alias(c) for c in cols],
                                    F.lit(p).cast("long").alias("_p"), F.lit(q).cast("long").alias("_q"))
    whole = F.lit(True)
    for c in cols:
        whole = whole & F.coalesce(F.abs(F.col(c)) < float("inf"), F.lit(False))  # NaN is above infinity
    both = of(points, 1, 0).unionByName(of(queries, 0, 1)).groupBy(*cols)
    # several passes read these: cut the lineage once (shared checkpoint dir)
    return materialize(both.agg(F.sum("_p").alias("_p"), F.sum("_q").alias("_q")).withColumn("_whole", whole))


def _matrix(batch: pa.RecordBatch | pa.Table, cols: Sequence[str]) -> np.ndarray:
    out = np.empty((batch.num_rows, len(cols)))
    for j, c in enumerate(cols):
        out[:, j] = batch.column(c).to_numpy()
    return out


def _search(asked: DataFrame, points: DataFrame, cols: Sequence[str], *, leaf_points: int = 4096,
            sample_size: int = 200_000, seed: int = 42, max_queries_per_task: int = 50_000) -> DataFrame:
    """The rows of ``asked`` (distinct whole ``cols``, long columns besides) with
    ``_d``, the distance to the nearest of the distinct ``points`` with other
    coordinates (infinite without one), and ``_v``, the leaves visited."""
    from tillguard.session import hash_sample, materialize

    cols, keep = list(cols), [c for c in asked.columns if c not in cols]
    spark = points.sparkSession
    n_p = points.count()
    if n_p == 0:
        return asked.withColumns({"_d": F.lit(float("inf")), "_v": F.lit(0).cast("long")})
    frac = min(1.0, sample_size / n_p)
    # about sample_size rows, a binomial count with a tail that is cut
    sample = _matrix(hash_sample(points, frac, seed).limit(2 * sample_size).toArrow(), cols)
    if len(sample) == 0:  # a sample of next to nothing: any point will do
        sample = _matrix(points.limit(1).toArrow(), cols)
    tree = _grow_kd(sample, int(max(1, min(n_p // leaf_points, sample_size // 8, MOST_LEAVES))))
    btree = spark.sparkContext.broadcast(tree)

    def route(batches):
        for batch in batches:
            leaf = _route(_matrix(batch, cols), btree.value).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], [*batch.schema.names, "_leaf"])

    def routed(df: DataFrame) -> DataFrame:
        return df.mapInArrow(route, T.StructType([*df.schema.fields, T.StructField("_leaf", T.IntegerType())]))

    ends = [f(c) for c in cols for f in (F.min, F.max)]
    boxes = routed(points).groupBy("_leaf").agg(*ends).orderBy("_leaf").toArrow()  # one row a leaf: at most MOST_LEAVES
    held = _matrix(boxes, boxes.column_names)
    bboxes = spark.sparkContext.broadcast((held[:, 0].astype(int), held[:, 1::2], held[:, 2::2], *_cells(tree, len(cols))))
    state = ", ".join([*(f"`{c}` double" for c in cols), *(f"`{c}` long" for c in keep), "_home int, _d double, _v long, _next double"])
    names = [*cols, *keep, "_home", "_d", "_v", "_next"]

    def following(x: np.ndarray, home: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Distance of the nearest box besides that of the own leaf, if nearer than best."""
        leaf, lo, hi, low, high = bboxes.value
        out = np.full(len(x), np.inf)
        wall = np.minimum(x - low[home], high[home] - x).min(axis=1)
        cross = np.nonzero(wall < best)[0]
        cross = cross[np.argsort(best[cross], kind="stable")]
        rows, at, gap = _near_boxes(x[cross], best[cross], _cuts(np.zeros(len(cross)), GROUP_ROWS), lo, hi)
        other = leaf[at] != home[cross[rows]]
        np.minimum.at(out, cross[rows[other]], np.sqrt(gap[other]))
        return out

    def search_in(first: bool):
        def search(q: pa.Table, p: pa.Table) -> pa.Table:
            x = _matrix(q, cols)
            home, best = q.column("_home").to_numpy(), q.column("_d").to_numpy()
            best = _min_dist(x, _matrix(p, cols), True, best)
            ahead = following(x, home, best) if first else q.column("_next").to_numpy()
            return pa.table([*(q.column(c) for c in [*cols, *keep, "_home"]), pa.array(best), q.column("_v"), pa.array(ahead)], names)
        return search

    def visited(visits: DataFrame, first: bool) -> DataFrame:
        """Search the leaf of each row; a leaf with many queries is split into
        sub-groups, each with a copy of that leaf's points, so no task holds
        more than about ``max_queries_per_task`` queries."""
        salts = materialize(visits.groupBy("_leaf").agg(F.count(F.lit(1)).alias("_nq"))
                                  .select("_leaf", F.greatest(F.lit(1), F.ceil(F.col("_nq") / F.lit(max_queries_per_task)))
                                          .cast("int").alias("_ns")))
        qsalt = (visits.join(F.broadcast(salts), "_leaf")  # one row per leaf: at most MOST_LEAVES
                       .withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.col("_ns")).cast("int"))
                       .drop("_ns"))
        psalt = (routed(points).join(F.broadcast(salts), "_leaf")
                               .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_ns") - 1))).drop("_ns"))
        return qsalt.groupBy("_leaf", "_salt").cogroup(psalt.groupBy("_leaf", "_salt")).applyInArrow(search_in(first), state)

    def wanted(take: int):
        def run(batches):
            leaf, lo, hi, *_ = bboxes.value
            for batch in batches:
                home = batch.column("_home").to_numpy()
                rows, at, after = next_leaves(_matrix(batch, cols), batch.column("_d").to_numpy(), batch.column("_v").to_numpy(),
                                              lo, hi, take, np.searchsorted(leaf, home))
                out = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*out.columns[:-1], pa.array(after[rows]), pa.array(leaf[at].astype(np.int32))],
                                                 [*names, "_leaf"])
        return run

    # each query in its own leaf, then best-first rounds over the open ones
    start = routed(asked).select(*cols, *keep, F.col("_leaf").alias("_home"), F.lit(float("inf")).alias("_d"),
                                 F.lit(1).cast("long").alias("_v"), F.lit(0.0).alias("_next"), "_leaf")
    found = materialize(visited(start, True))
    closed, take = [found.filter("_next >= _d")], 2
    todo = found.filter("_next < _d")
    while not todo.isEmpty():
        visits = materialize(todo.mapInArrow(wanted(take), state + ", _leaf int"))
        found = materialize(visited(visits, False).groupBy(*cols, *keep, "_home").agg(
            F.min("_d").alias("_d"), (F.max("_v") + F.count(F.lit(1))).alias("_v"), F.max("_next").alias("_next")))
        closed.append(found.filter("_next >= _d"))
        todo = found.filter("_next < _d")
        take *= 2
    best = closed[0]
    for part in closed[1:]:
        best = best.unionByName(part)
    return best.drop("_home", "_next")


def nearest_distances(queries: DataFrame, points: DataFrame, cols: Sequence[str], *, exclude_self: bool = False,
                      **kw) -> DataFrame:
    """Distance to the nearest point per distinct query tuple:
    ``(<cols>, multiplicity, nn_distance, leaf_visits)``.

    ``exclude_self``: queries and points are the same rows; a row's own
    tuple counts only when it occurs at least twice (distance 0).  Other
    arguments are those of ``_search``.
    """
    cols = list(cols)
    tuples = _tuples(points, queries, cols)
    equal = F.col("_p") >= (2 if exclude_self else 1)
    asked = tuples.filter("_q > 0")
    known = asked.filter(~F.col("_whole") | equal).select(
        *cols, F.col("_q").alias("multiplicity"), F.when(F.col("_whole"), F.lit(0.0)).alias("nn_distance"),
        F.lit(0).cast("long").alias("leaf_visits"))
    found = _search(asked.filter(F.col("_whole") & ~equal).select(*cols, F.col("_q").alias("multiplicity")),
                    tuples.filter("_whole AND _p > 0").select(*cols), cols, **kw)
    return found.select(*cols, "multiplicity", F.when(F.col("_d") < float("inf"), F.col("_d")).alias("nn_distance"),
                        F.col("_v").alias("leaf_visits")).unionByName(known)


def zscore(df: DataFrame, reference: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Standardise ``cols`` with the mean and population std of ``reference``
    (a standard scaler; a zero std leaves the column centred only)."""
    stats = reference.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                          *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()  # 2 x cols scalars
    out = []
    for c in cols:
        m, s = stats[f"m_{c}"], stats[f"s_{c}"]
        v = F.col(c).cast("double") - F.lit(m)
        out.append((v / F.lit(s) if s and s > 0 else v).alias(c))
    return df.select(*out)


#: Queries whose distances are written out at once.
COPIES = 65_536


def dnnr(real: DataFrame, synth: DataFrame, cols: Sequence[str], **kw) -> DataFrame:
    """VAL-7: median synthetic->real NN distance / median real->real NN
    distance (self excluded), on features z-scored by the real data.  Both
    kinds of queries go through one search: one for a real row alone at its
    coordinates, and one for synthetic rows at coordinates without a real row.
    The frames given are read twice."""
    from tillguard.operators.selection import quantiles
    tuples = _tuples(zscore(real, real, cols), zscore(synth, real, cols), cols).filter("_whole")
    asked = tuples.filter("_p < 2").select(
        *cols, F.when(F.col("_p") == 0, F.col("_q")).otherwise(0).alias("_sr"), F.col("_p").alias("_rr"))
    found = _search(asked, tuples.filter("_p > 0").select(*cols), cols, **kw).filter(F.col("_d") < float("inf"))
    zero = tuples.filter("_p > 0").select(
        F.col("_q").alias("_sr"), F.when(F.col("_p") > 1, F.col("_p")).otherwise(0).alias("_rr"), F.lit(0.0).alias("_d"))
    every = found.select("_sr", "_rr", "_d").unionByName(zero)

    def written_out(batches):
        for batch in batches:
            d = batch.column("_d").to_numpy()
            for kind in ("_sr", "_rr"):
                upto = np.cumsum(batch.column(kind).to_numpy())
                for s in range(0, int(upto[-1]) if len(upto) else 0, COPIES):
                    v = pa.array(d[np.searchsorted(upto, np.arange(s, min(s + COPIES, int(upto[-1]))), "right")])
                    none = pa.nulls(len(v), pa.float64())
                    yield pa.RecordBatch.from_arrays([v, none] if kind == "_sr" else [none, v], ["_sr", "_rr"])

    # a row for each query; kept while the passes run
    each = every.mapInArrow(written_out, "_sr double, _rr double").persist(StorageLevel.MEMORY_AND_DISK)
    medians = quantiles(each, ["_sr", "_rr"], [0.5])
    each.unpersist()
    wide = real.sparkSession.createDataFrame([(medians["_sr"][0], medians["_rr"][0])], "median_d_sr double, median_d_rr double")
    return wide.withColumn("dnnr", F.col("median_d_sr") / F.col("median_d_rr")).withColumn(
        "interpretation", F.when(F.col("dnnr") > 1.5, "privacy_preserved").when(F.col("dnnr") > 1.0, "borderline")
                           .otherwise("memorization_risk"))
