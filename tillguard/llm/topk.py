"""Exact top-k search by inner product, norm-bucketed.

Vectors are integers; equal vectors are one, with the ``k + 1`` smallest of
their ids.  They are dealt to groups by falling length; a task holds one group
and cuts it into buckets.  Queries stream past the groups whose longest vector
can still reach the query's k-th best score so far (at first that within a
bounded sample of the vectors, a proven lower bound).  In each bucket the
query's local cosine threshold, that score over both lengths, decides how
vectors are pruned: by length (a prefix of the bucket), or, from a threshold
that is set for each bucket by how much its own vectors' coordinates spread,
by the ranges that the query's largest coordinates allow.  What is left is
verified by integer products.  Only ``k`` rows a query and group leave a task.

Defined results: a vector that is null or holds a null or non-finite entry
takes no part; vectors meet those of their own length only; every row is a
candidate of every query but itself, copies and repeated ids included; equal
scores are ranked by id, null ids last (a null id is no query); a query with
fewer candidates has fewer rows; an empty table has none; other columns are
ignored.  Entries, lengths or products beyond 64 bits raise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, releasing, written

#: Entries of vectors that a group holds at most (8 bytes each).
GROUP_CELLS = 8 << 20
#: Vectors of a bucket, queries that pass it at once.
BUCKET, QUERIES = 2048, 512
#: Entries of the sample that gives the first thresholds.
SAMPLE_CELLS = 1 << 17
#: Coordinates whose ranges are used, share of a bucket that they may leave, and
#: local cosines that are tried for it.
FOCUS, SHARE = 3, 1 / 16
COSINES = (0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.95, 0.98)
#: Rounding of lengths and cosines never prunes what is equal.
SLACK = 1e-9
LEAST = -(1 << 62)


def integers(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, v) of the rows that take part, v = floor(scale * entry)."""
    v = F.col(f"`{vector_col}`")
    fine = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return df.filter(F.coalesce(fine, F.lit(False))).select(
        F.col(f"`{id_col}`").alias("id"),
        F.transform(v, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long")).alias("v"))


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """(v, d, norm2, h, ids): each vector once, with the smallest ids of its rows;
    a task drops further copies before they move."""
    hashed = rows.withColumn("h", F.xxhash64("v"))
    w = Window.partitionBy("h", "v").orderBy(F.col("id").asc_nulls_last())
    least = hashed.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k + 1)
    ids = F.sort_array(F.collect_list(F.struct(F.col("id").isNull().alias("none"), F.col("id").cast("long").alias("id"))))
    return least.groupBy("h", "v").agg(ids.alias("ids")).select(
        "v", F.size("v").alias("d"), F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x * x).alias("norm2"), "h",
        F.transform("ids", lambda s: s["id"]).alias("ids"))


class Matrix:
    """Rows of integers and the exact products with others: in floats while
    every partial sum is a whole number that the type holds."""

    def __init__(self, v: np.ndarray, norm2: np.ndarray):
        self.v, self.norm2 = v, norm2
        self.length = np.sqrt(norm2.astype(np.float64))
        self.most = float(self.length.max(initial=0.0))
        self.held: dict = {}

    def as_type(self, kind):
        if kind not in self.held:
            self.held[kind] = self.v.astype(kind)
        return self.held[kind]

    def kind(self, most: float):
        bound = self.most * most * (1 + SLACK)
        if bound >= 2.0 ** 62:
            raise ArithmeticError("a product goes beyond 64 bits")
        return np.float32 if bound < 2.0 ** 24 else np.float64 if bound < 2.0 ** 53 else np.int64


class Bucket:
    """Vectors by falling length, with sorted coordinates once they are asked for."""

    def __init__(self, v, norm2, first, number):
        self.m = Matrix(v, norm2)
        self.first, self.number = first, number  # order of ties, place in the group
        self.unit = self.order = self.sorted = None
        self.from_cosine = None

    def index(self) -> None:
        if self.order is None:
            self.unit = self.m.v / np.maximum(self.m.length, 1.0)[:, None]
            self.order = np.argsort(self.unit, axis=0, kind="stable")
            self.sorted = np.take_along_axis(self.unit, self.order, axis=0)

    def ranges(self, q: np.ndarray, focus: np.ndarray, cosine: np.ndarray):
        """Least and greatest value of each focus coordinate of a unit vector
        at an angle of at most acos(cosine) to the unit vector q."""
        at = np.take_along_axis(q, focus, axis=1)
        a = np.arccos(np.clip(at, -1, 1))
        b = np.arccos(np.clip(cosine * (1 - SLACK), -1, 1))[:, None]
        return np.cos(np.minimum(np.pi, a + b)) - SLACK, np.cos(np.maximum(0.0, a - b)) + SLACK

    def tune(self) -> float:
        """Least local cosine from which coordinate ranges leave at most
        ``SHARE`` of the bucket, on average over some of its vectors."""
        if self.from_cosine is None:
            n = len(self.m.v)
            self.index()
            q = self.unit[np.linspace(0, n - 1, min(n, 16)).astype(int)]
            focus = np.argsort(-np.abs(q), axis=1, kind="stable")[:, :FOCUS]
            self.from_cosine = np.inf
            for c in COSINES:
                lo, hi = self.ranges(q, focus, np.full(len(q), c))
                left = [min(int(np.searchsorted(self.sorted[:, f], h, "right")) - int(np.searchsorted(self.sorted[:, f], x, "left"))
                            for f, x, h in zip(*row)) for row in zip(focus, lo, hi)]
                if np.mean(left) <= SHARE * n:
                    self.from_cosine = c
                    break
        return self.from_cosine

    def search(self, q: Matrix, floor: np.ndarray):
        """(query, place, score) of the pairs whose score is at least the
        query's ``floor``, and perhaps of more."""
        m, n = self.m, len(self.m.v)
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where(floor <= 0, -1.0, floor / (q.length * m.most))
        alive = ~(local > 1 + SLACK)
        if not alive.any():
            return []
        kind, out = m.kind(q.most), []
        by_coordinate = np.zeros(len(alive), bool)
        strict = alive & (local >= COSINES[0])
        if strict.any() and n > 64 and m.v.shape[1]:
            by_coordinate = strict & (local >= self.tune())
        by_length = np.nonzero(alive & ~by_coordinate)[0]
        if len(by_length):
            need = np.where(floor[by_length] <= 0, 0.0, floor[by_length] * (1 - SLACK) / np.maximum(q.length[by_length], 1e-300))
            prefix = n - np.searchsorted(m.length[::-1], need, "left")
            most = int(prefix.max())
            s = q.as_type(kind)[by_length] @ m.as_type(kind)[:most].T
            hit = s >= floor[by_length, None]
            qi, pi = np.nonzero(hit)
            out.append((by_length[qi], pi, s[qi, pi].astype(np.int64)))
        rows = np.nonzero(by_coordinate)[0]
        if len(rows):
            unit = q.v[rows] / np.maximum(q.length[rows], 1.0)[:, None]
            focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
            lo, hi = self.ranges(unit, focus, local[rows])
            for j, r in enumerate(rows):
                spans = [(int(np.searchsorted(self.sorted[:, f], a, "left")), int(np.searchsorted(self.sorted[:, f], b, "right")))
                         for f, a, b in zip(focus[j], lo[j], hi[j])]
                least = min(range(len(spans)), key=lambda t: spans[t][1] - spans[t][0])
                left = self.order[spans[least][0]:spans[least][1], focus[j, least]]
                for t, f in enumerate(focus[j]):
                    if t != least and len(left):
                        left = left[(self.unit[left, f] >= lo[j, t]) & (self.unit[left, f] <= hi[j, t])]
                if len(left):
                    s = (m.as_type(kind)[left] @ q.as_type(kind)[r]).astype(np.int64)
                    keep = s >= floor[r]
                    out.append((np.full(int(keep.sum()), r), left[keep], s[keep]))
        return out


def _ranked(query, score, first, most: int) -> np.ndarray:
    """Places of the ``most`` best of each query: by score, then by ``first``."""
    order = np.lexsort((first, -score, query))
    q = query[order]
    start = np.concatenate([[True], q[1:] != q[:-1]]) if len(q) else np.zeros(0, bool)
    at = np.arange(len(q))
    return order[at - np.maximum.accumulate(np.where(start, at, 0)) < most]


class Group:
    """The vectors of one group, in buckets of falling length."""

    def __init__(self, v: np.ndarray, norm2: np.ndarray, ids: list[list]):
        order = np.argsort(-norm2, kind="stable")
        v, norm2, self.ids = v[order], norm2[order], [ids[i] for i in order]
        self.norm2 = norm2
        none = np.array([i[0] is None for i in self.ids], bool)
        key = np.array([0 if i[0] is None else i[0] for i in self.ids], np.int64)
        first = np.empty(len(order), np.int64)  # rank of a vector's smallest id
        first[np.lexsort((key, none))] = np.arange(len(order))
        self.buckets = [Bucket(v[i:i + BUCKET], norm2[i:i + BUCKET], first[i:i + BUCKET], np.arange(i, min(i + BUCKET, len(order))))
                        for i in range(0, len(order), BUCKET)]

    def best(self, q: Matrix, floor: np.ndarray, k: int):
        """(query, place, score) of each query's ``k + 1`` best vectors, its own
        included, of those that may be among its ``k`` best rows."""
        floor = floor.copy()
        held = tuple(np.zeros(0, np.int64) for _ in range(4))  # query, place, score, rank of ties
        for b in self.buckets:
            found = b.search(q, floor)
            if not found:
                continue
            qi, pi, s = (np.concatenate(c).astype(np.int64) for c in zip(*found))
            if not len(qi):
                continue
            both = tuple(np.concatenate(c) for c in zip(held, (qi, b.number[pi], s, b.first[pi])))
            keep = _ranked(both[0], both[2], both[3], k + 1)
            held = tuple(c[keep] for c in both)
            # the k-th best other than its own vector bounds the k-th best row
            own = (held[2] == q.norm2[held[0]]) & (self.norm2[held[1]] == q.norm2[held[0]])
            others = tuple(c[~own] for c in held)
            kept = _ranked(others[0], others[2], others[3], k)
            query, score = others[0][kept], others[2][kept]
            n = np.bincount(query, minlength=len(floor))
            lowest = np.full(len(floor), np.iinfo(np.int64).max)
            np.minimum.at(lowest, query, score)
            floor = np.where(n >= k, np.maximum(floor, lowest), floor)
        return held[:3]

    def rows(self, q: Matrix, ids: list, floor: np.ndarray, k: int):
        """(query, score, id): at most ``k`` rows a query."""
        query, place, score = self.best(q, floor, k)
        order = np.argsort(query, kind="stable")
        out: tuple[list, list, list] = ([], [], [])
        i = 0
        while i < len(order):
            j, qi = i, int(query[order[i]])
            found = []
            while j < len(order) and query[order[j]] == qi:
                p, s = int(place[order[j]]), int(score[order[j]])
                of = self.ids[p]
                if s == q.norm2[qi] and self.norm2[p] == s and ids[qi] in of:  # its own vector: one row is its own
                    of = of.copy()
                    of.remove(ids[qi])
                found += [(-s, x is None, x or 0, x) for x in of]
                j += 1
            for s, _, _, x in sorted(found, key=lambda t: t[:3])[:k]:
                out[0].append(qi)
                out[1].append(-s)
                out[2].append(x)
            i = j
        return out


def _array(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.int64)


def _floors(queries: DataFrame, sample: list, k: int) -> DataFrame:
    """Queries with ``floor``: the k-th best score of the sample's vectors other
    than the query's own, from which no result row lies below."""
    by_size: dict = {}
    for r in sample:
        by_size.setdefault(len(r.v), []).append((r.v, r.norm2))
    made = {d: Matrix(np.array([v for v, _ in rows], np.int64).reshape(len(rows), d), np.array([n for _, n in rows], np.int64))
            for d, rows in by_size.items()}

    def run(batches):
        for batch in batches:
            v, d = batch.column("v"), batch.column("d").to_numpy()
            norm2 = batch.column("norm2").to_numpy()
            floor = np.full(batch.num_rows, LEAST, np.int64)
            for size in np.unique(d):
                at = np.nonzero(d == size)[0]
                m = made.get(int(size))
                if m is None or len(m.v) <= k:
                    continue
                for i in range(0, len(at), QUERIES):
                    part = at[i:i + QUERIES]
                    q = Matrix(_array(v.take(pa.array(part))), norm2[part])
                    kind = m.kind(q.most)
                    s = (q.as_type(kind) @ m.as_type(kind).T).astype(np.int64)
                    s[(s == q.norm2[:, None]) & (m.norm2[None, :] == s)] = LEAST
                    floor[part] = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floor)], [*batch.schema.names, "floor"])

    return queries.mapInArrow(releasing(run), "qid long, id long, v array<bigint>, d int, norm2 long, floor long")


def _searched(dealt: DataFrame, k: int) -> DataFrame:
    """Rows (qid, query_id, score, vec_id) of each group's task; ``dealt`` is
    sorted by group, its vectors before its queries."""
    names = ["qid", "query_id", "score", "vec_id"]

    def run(batches):
        now, parts, group = None, [], None
        for batch in batches:
            grp, kind = batch.column("grp").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.concatenate([[0], np.nonzero((grp[1:] != grp[:-1]) | (kind[1:] != kind[:-1]))[0] + 1, [len(grp)]])
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo == hi:
                    continue
                if grp[lo] != now:
                    now, parts, group = grp[lo], [], None
                part = batch.slice(lo, hi - lo)
                if kind[lo] == 0:
                    parts.append(part)
                    continue
                if group is None:
                    if not parts:
                        continue
                    group = Group(np.concatenate([_array(p.column("v")) for p in parts]),
                                  np.concatenate([p.column("norm2").to_numpy() for p in parts]),
                                  [x for p in parts for x in p.column("ids").to_pylist()])
                    parts = []
                for i in range(0, hi - lo, QUERIES):
                    some = part.slice(i, QUERIES)
                    ids = some.column("id").to_pylist()
                    q = Matrix(_array(some.column("v")), some.column("norm2").to_numpy())
                    at, score, found = group.rows(q, ids, some.column("floor").to_numpy(), k)
                    yield pa.RecordBatch.from_arrays(
                        [some.column("qid").take(pa.array(at, pa.int64())), some.column("id").take(pa.array(at, pa.int64())),
                         pa.array(score, pa.int64()), pa.array(found, pa.int64())], names)

    return dealt.mapInArrow(releasing(run), "qid long, query_id long, score long, vec_id long")


def top_products(rows: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """The ``k`` rows of the highest inner product for each row (id, v) of
    ``rows`` that ``is_query`` holds for, itself left out."""
    spark = rows.sparkSession
    bound_batches(spark)
    id_type = rows.schema["id"].dataType.simpleString()
    rows = rows.withColumn("id", F.col("id").cast("long"))
    base = written(_distinct(rows, k), "topk-vectors")
    size = base.agg(F.count("*").alias("n"), F.sum("d").alias("cells"), F.max("d").alias("d")).first()
    groups = max(2 * spark.sparkContext.defaultParallelism, -(-(size.cells or 0) // GROUP_CELLS))
    if size.n == 0:
        groups = 1
    # a group is a partition of a range sort: by vector length, falling norm, then hash, so that ties spread
    vectors = written(base.repartitionByRange(groups, F.col("d"), F.col("norm2").desc(), F.col("h")).withColumn(
        "grp", F.spark_partition_id()), "topk-groups")
    queries = written(rows.filter(F.coalesce(is_query, F.lit(False))).select(
        F.monotonically_increasing_id().alias("qid"), "id", "v", F.size("v").alias("d"),
        F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x * x).alias("norm2")), "topk-queries")
    sample = vectors.orderBy("h").select("v", "norm2").limit(max(k + 1, SAMPLE_CELLS // max(1, size.d or 1))).collect()
    queries = _floors(queries, sample, k)
    # the groups' longest vectors: one row for 64 MB of vectors
    spans = vectors.groupBy("grp", "d").agg(F.max("norm2").alias("longest"))
    reach = F.sqrt(F.col("norm2").cast("double")) * F.sqrt(F.col("longest").cast("double")) * (1 + SLACK)
    met = queries.join(F.broadcast(spans.withColumnRenamed("d", "of")), (F.col("d") == F.col("of"))
                       & ((F.col("floor") <= 0) | (reach >= F.col("floor"))))
    none = lambda kind: F.lit(None).cast(kind)
    dealt = vectors.select("grp", F.lit(0).alias("kind"), "d", "v", "norm2", "ids", none("long").alias("qid"), none("long").alias("id"),
                           none("long").alias("floor")).unionByName(
        met.select("grp", F.lit(1).alias("kind"), "d", "v", "norm2", none("array<bigint>").alias("ids"), "qid", "id", "floor"))
    # a range may hold vectors of several lengths: each (group, length) is searched alone
    dealt = dealt.withColumn("part", F.col("grp")).withColumn("grp", F.col("grp") * F.lit(1 << 31).cast("long") + F.col("d"))
    dealt = dealt.repartitionById(groups, F.col("part").cast("int")).sortWithinPartitions("grp", "kind")
    found = _searched(dealt.select("grp", "kind", "v", "norm2", "ids", "qid", "id", "floor"), k)
    w = Window.partitionBy("qid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(
        F.col("query_id").cast(id_type).alias("query_id"), F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").cast(id_type).alias("vec_id"), "score")


def digest(df: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    return top_products(integers(df), F.col("id") % every == 0, k)
