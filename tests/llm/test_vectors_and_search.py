"""Whitening, top-k products and lexical search against brute force."""
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillguard.llm import lexical, topk, whitening

VECTORS = "vec_id long, embedding array<float>, n string, `rank` int, component int"


def _table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 7, 3) for i, v in rows], VECTORS)


BROKEN = [(900, None), (901, [1.0, None, 0.0, 2.0]), (902, [float("nan")] * 4), (903, [float("inf"), 0.0, 0.0, 0.0])]


# ------------------------------------------------------------------ whitening

@pytest.mark.parametrize("name", ["gauss", "rank", "graded", "tied", "near", "diagonal", "repeated", "zero", "one"])
def test_solver_equals_reference_values_and_gives_orthogonal_directions(name):
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    spread = {"tied": np.r_[10, np.ones(20), .5, np.full(18, .1)], "near": np.r_[10, 1 + 1e-9 * np.arange(20), .5, np.full(18, .1)]}
    a = {"gauss": lambda: rng.standard_normal((300, 40)), "rank": lambda: rng.standard_normal((20, 40)),
         "graded": lambda: rng.standard_normal((300, 40)) * 10.0 ** -np.linspace(0, 6, 40),
         "tied": lambda: np.sqrt(spread["tied"])[:, None] * turn, "near": lambda: np.sqrt(spread["near"])[:, None] * turn,
         "diagonal": lambda: np.diag([1.0] * 10 + [0.0] * 6), "repeated": lambda: np.repeat(rng.standard_normal((300, 8)), 2, axis=1),
         "zero": lambda: np.zeros((6, 5)), "one": lambda: rng.standard_normal((50, 1))}[name]()
    d = a.shape[1]
    r = np.zeros((d, d))
    got = np.linalg.qr(a, mode="r")
    r[:len(got)] = got
    values, z = whitening.principal(r, d)
    want = np.linalg.svd(a, compute_uv=False) ** 2
    top = max(want[0], 1e-300)
    assert np.max(np.abs(values[:len(want)] - want)) <= 1e-13 * top
    assert np.max(np.abs(r.T @ (r @ z) - z * values)) <= 1e-12 * top
    sound = np.sqrt(np.abs(values)) > 1e-13 * math.sqrt(top)
    assert np.max(np.abs(z[:, sound].T @ z[:, sound] - np.eye(sound.sum())), initial=0) < 1e-10


def _whitened(rows, k):
    x = {i: np.floor(64 * np.array(v, np.float64)).astype(np.int64) + 1_000_000 for i, v in enumerate(rows)}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = (n * fit - s) / n
    e, z = np.linalg.eigh(c.T @ c / n)
    e, z = e[::-1], z[:, ::-1]
    return x, n, s, e, z


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.standard_normal((300, 12)) * np.linspace(3, .5, 12)).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(1000 + i, [float(x) for x in vectors[0]]) for i in range(150)]
    rows += [(None, [float(x) for x in vectors[1]])] * 2
    odd = [(900, None), (901, [None] + [1.0] * 11), (902, [float("nan")] * 12), (903, [float("-inf")] * 12), (904, [1.0, 2.0])]
    out = whitening.digest(_table(spark, rows + odd).repartition(5), 5).collect()
    x, n, s, e, z = _whitened([v for _, v in rows], 5)
    assert len(out) == 5 * len(rows) and n == 300
    by = {}
    for r in out:
        by.setdefault((r.vec_id, r.component), []).append(r)
    sign = {}
    for i, (vec_id, _) in enumerate(rows):
        for j in range(5):
            r = by[vec_id, j + 1][0]
            assert r.n == n and r.deviation == int(((n * x[i] - s).astype(object) ** 2).sum())
            want = float(((n * x[i] - s) / n) @ z[:, j] / math.sqrt(e[j]))
            sign.setdefault(j, 1 if abs(r.whitened - want) < abs(r.whitened + want) else -1)
            assert r.whitened == pytest.approx(sign[j] * want, rel=1e-8, abs=1e-8)
            assert r.explained == pytest.approx(e[j] / e.sum(), rel=1e-9) and r.identity_error < 1e-9
    assert len({r.identity_error for r in out}) == 1


def test_triangles_of_many_tasks_merge_to_one(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    x = np.random.default_rng(1).integers(0, 50, (500, 7))
    fit = spark.createDataFrame([(v.tolist(),) for v in x], "x array<bigint>").repartition(11)
    n, sums = whitening._sums(fit)
    assert (n, sums) == (500, x.sum(axis=0).tolist())
    r, c = whitening._triangle(fit, n, sums), x - x.mean(axis=0)
    assert np.allclose(r.T @ r, c.T @ c, rtol=1e-12)
    e, z = np.linalg.eigh(c.T @ c / n)
    assert whitening._identity_error(fit, n, sums, z / np.sqrt(e)) < 1e-12


def test_whitening_defined_results(spark):
    assert whitening.digest(_table(spark, [])).count() == 0
    assert whitening.digest(_table(spark, BROKEN)).count() == 0
    assert whitening.digest(_table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # one distinct vector
    got = whitening.digest(_table(spark, [(1, [1.0, 2.0, 0.0]), (2, [3.0, 2.0, 0.0]), (3, [9.0, 2.0, 0.0]), *BROKEN])).collect()
    assert [r.component for r in got] == [1] * 3  # one direction has variance
    got = whitening.digest(_table(spark, [(i, [float(i == j) for j in range(6)]) for i in range(6)])).collect()  # equal values
    assert len(got) == 30 and got[0].identity_error < 1e-9


# -------------------------------------------------------------------- products

def _products(rows, k, every):
    v = [(i, [math.floor(256 * x) for x in w]) for i, w in rows]
    out = []
    for a, (i, q) in enumerate(v):
        if i is not None and i % every == 0:
            found = sorted((-sum(x * y for x, y in zip(q, p)), j is None, j or 0) for b, (j, p) in enumerate(v) if a != b and len(p) == len(q))
            out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(found[:k])]
    return sorted(out, key=str)


def _lists(matrix):
    return [[float(x) for x in v] for v in np.asarray(matrix, np.float32)]


@pytest.mark.parametrize("shape", ["plain", "copies", "lengths", "ties"])
def test_top_products_equal_brute_force(spark, shape):
    rng = np.random.default_rng(11)
    base = rng.standard_normal((250, 6))
    if shape == "copies":  # a third of the rows are one vector; near copies of another
        base[::3] = base[0]
        base[1:60:4] = base[1] + rng.standard_normal((15, 6)) * 1e-3
    if shape == "lengths":
        base *= 10.0 ** rng.integers(-2, 3, 250)[:, None]
    if shape == "ties":
        base = rng.integers(-1, 2, (250, 6)) / 4
        base[:20] = 0
    rows = list(zip(range(250), _lists(base)))
    rows += [(5, rows[7][1]), (10, rows[10][1]), (10, rows[3][1]), (None, rows[20][1]), (None, rows[21][1]), (995, [1.0, 2.0]), (1000, [2.0, 1.0])]
    odd = [(900, None), (905, [None] * 6), (910, [float("nan")] * 6), (915, [float("inf")] * 6)]
    out = topk.top_products(topk.integers(_table(spark, rows + odd).repartition(6)), F.col("id") % 5 == 0, 4).collect()
    assert sorted([tuple(r) for r in out], key=str) == _products(rows, 4, 5)


def test_buckets_prune_by_coordinates_and_lose_nothing():
    rng = np.random.default_rng(2)
    v = rng.standard_normal((6000, 32))
    v /= np.linalg.norm(v, axis=1)[:, None]
    v[1000:6000] = np.repeat(v[:1000], 5, axis=0) + rng.standard_normal((5000, 32)) * 0.01  # near copies
    v = np.floor(2560 * v * (1 + rng.uniform(0, .05, 6000))[:, None]).astype(np.int64)
    v = np.unique(v, axis=0)
    norm2 = (v * v).sum(axis=1)
    group = topk.Group(v, norm2, [[i] for i in range(len(v))])
    rows = np.arange(0, len(v), 13)
    q = topk.Matrix(v[rows], norm2[rows])
    seen = []
    search = topk.Bucket.search

    def counted(self, q, floor):
        out = search(self, q, floor)
        seen.append(sum(len(s) for _, _, s in out))
        return out

    topk.Bucket.search = counted
    try:
        at, score, found = group.rows(q, rows.tolist(), np.full(len(rows), topk.LEAST), 3)
    finally:
        topk.Bucket.search = search
    s = v[rows] @ v.T
    s[np.arange(len(rows)), rows] = -(1 << 62)
    order = np.lexsort((np.broadcast_to(np.arange(len(v)), s.shape), -s), axis=1)[:, :3]
    assert found == order.ravel().tolist() and score == np.take_along_axis(s, order, axis=1).ravel().tolist()
    assert at == np.repeat(np.arange(len(rows)), 3).tolist()
    assert any(b.order is not None for b in group.buckets)  # coordinates were used
    assert sum(seen) < 0.6 * len(rows) * len(v)


def test_products_beyond_floats_stay_exact(spark):
    rows = [(0, [3e6, 1.0]), (1, [3e6, 2.0]), (2, [3e6, 3.0]), (3, [-3e6, 3.0])]
    out = topk.top_products(topk.integers(_table(spark, rows)), F.col("id") == 0, 3).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in out] == [(2, (768 * 10 ** 6) ** 2 + 256 * 768), (1, (768 * 10 ** 6) ** 2 + 256 * 512), (3, -(768 * 10 ** 6) ** 2 + 256 * 768)]


def test_top_products_of_no_rows(spark):
    assert topk.digest(_table(spark, [])).count() == 0
    assert topk.digest(_table(spark, BROKEN)).count() == 0
    assert topk.digest(_table(spark, [(0, [1.0])])).count() == 0


# ---------------------------------------------------------------------- search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _search(docs, items, k):
    texts = [(i, _terms(t)) for i, t in docs]
    n_docs, total = sum(bool(t) for _, t in texts), sum(len(t) for _, t in texts)
    df = {}
    for _, t in texts:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in items:
        found = []
        for i, t in texts:
            m = 10 + (90 * len(t) * n_docs) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10 ** 9 * t.count(w)) // (1000 * t.count(w) + 8 * m))
                    for w in set(_terms(text)) if w in df and w in t)
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def _documents(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, item_id string, `rank` int")


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(400)] + ["İstanbul", "Straße", "ÉTÉ", "日本", "a b"]
    draw = lambda n: "".join(str(w) + str(rng.choice([" ", ", ", "\n", "_-"])) for w in rng.choice(words, n, p=weights))
    weights = 1 / np.arange(1, len(words) + 1)
    weights /= weights.sum()
    docs = [(i, draw(int(rng.integers(1, 120)))) for i in range(300)]
    docs += [(300 + i, docs[4][1]) for i in range(150)]  # a third are copies
    docs += [(460, None), (461, ""), (462, " -- \n"), (463, draw(30000)), (None, docs[5][1]), (7, docs[9][1]), (464, "W3 w3 W3 w3 w3 w3 w3 w3 w3")]
    items = [(i, draw(20)) for i in range(25)] + [(3, docs[9][1]), (90, None), (91, ""), (92, "unheardof"), (93, docs[4][1]), (94, "w3 w3"), (None, "w7")]
    bench = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id int")
    out = lexical.digest(_documents(spark, docs).repartition(4), bench).collect()
    assert sorted([tuple(r) for r in out], key=str) == _search(docs, items, 10)


def test_search_bounds_hold_and_exclude(spark):
    rng = np.random.default_rng(4)
    docs = [(i, " ".join(f"t{x}" for x in rng.zipf(1.3, 60) % 3000)) for i in range(800)]
    index = lexical.build_index(_documents(spark, docs))
    terms = {0: (0, sorted(set(docs[17][1].split()))), 1: (1, ["t1", "t2", "t2999"])}
    df, n_docs, total = lexical.frequencies(index, sorted({t for _, ts in terms.values() for t in ts}))
    assert n_docs == 800 and total == 48000 and df["t1"] == sum("t1" in t.split() for _, t in docs)
    items = lexical.Items(terms, df, n_docs, total)
    bounds, scores = [], []
    for block in index.collect():
        b = block.asDict()
        bound = lexical.upper_bounds(b, items)
        i, p = np.nonzero(np.ones_like(bound, bool))
        bounds.append(bound)
        scores.append(lexical.exact(b, items, i, p).reshape(bound.shape))
        assert (bounds[-1] >= scores[-1]).all()
    bound, score = np.concatenate(bounds, axis=1), np.concatenate(scores, axis=1)
    assert bound.shape == (2, 800)
    assert (bound[0] < np.sort(score[0])[-10]).mean() > 0.8  # most documents are excluded


def test_search_in_several_item_blocks(spark, monkeypatch):
    docs = [(i, f"alpha w{i % 7} w{i % 11} common") for i in range(60)]
    items = [(i, f"alpha w{i}") for i in range(12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(lexical, "ITEM_TERMS", 7)
    out = lexical.digest(_documents(spark, docs), bench).collect()
    assert sorted([tuple(r) for r in out], key=str) == _search(docs, items, 10)


def test_search_of_no_rows(spark):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.digest(_documents(spark, []), bench).count() == 0
    assert lexical.digest(_documents(spark, [(1, "a")]), bench.limit(0)).count() == 0
