import numpy as np

from tillguard.operators.nearest import dnnr, nearest_distances


def _df(spark, arr):
    return spark.createDataFrame([tuple(map(float, r)) for r in arr], "a double, b double, c double")


def test_nearest_exact_with_duplicates(spark):
    rng = np.random.default_rng(1)
    R = np.round(rng.normal(size=(600, 3)), 1)
    R[:100] = R[0]  # hot duplicate cluster
    Q = np.round(rng.normal(size=(300, 3)) * 1.3, 1)
    got = {tuple(r[:3]): r.nn_distance for r in nearest_distances(_df(spark, Q), _df(spark, R), ["a", "b", "c"],
                                                                   leaf_points=40).collect()}
    want = np.sqrt(((Q[:, None] - R[None]) ** 2).sum(2)).min(1)
    assert all(abs(got[tuple(q)] - w) < 1e-9 for q, w in zip(Q, want))
    self_d = {tuple(r[:3]): r.nn_distance for r in nearest_distances(_df(spark, R), _df(spark, R), ["a", "b", "c"],
                                                                      exclude_self=True, leaf_points=40).collect()}
    D = np.sqrt(((R[:, None] - R[None]) ** 2).sum(2))
    np.fill_diagonal(D, np.inf)
    assert all(abs(self_d[tuple(r)] - w) < 1e-9 for r, w in zip(R, D.min(1)))
    assert self_d[tuple(R[0])] == 0.0


def test_dnnr_identical_sets_is_memorisation(spark):
    rng = np.random.default_rng(2)
    R = np.round(rng.normal(size=(200, 3)), 3)
    row = dnnr(_df(spark, R), _df(spark, R), ["a", "b", "c"], leaf_points=60).first()
    assert row.median_d_sr == 0.0 and row.interpretation == "memorization_risk"


def test_nearest_salted_leaves_stay_exact(spark):
    rng = np.random.default_rng(3)
    R = np.round(rng.normal(size=(300, 3)), 2)
    Q = np.round(rng.normal(size=(200, 3)), 2)
    got = {tuple(r[:3]): r.nn_distance for r in nearest_distances(
        _df(spark, Q), _df(spark, R), ["a", "b", "c"], leaf_points=60, max_queries_per_task=7).collect()}
    want = np.sqrt(((Q[:, None] - R[None]) ** 2).sum(2)).min(1)
    assert all(abs(got[tuple(q)] - w) < 1e-9 for q, w in zip(Q, want))


def test_large_leaf_is_searched_exactly():
    from tillguard.operators.nearest import _brute_dist, _min_dist
    rng = np.random.default_rng(4)
    p = np.unique(np.round(rng.normal(size=(6000, 3)), 2), axis=0)
    q = np.concatenate([np.round(rng.normal(size=(500, 3)) * 3, 2), p[:200]])
    for exclude in (False, True):
        assert np.allclose(_min_dist(q, p, exclude), _brute_dist(q, p, exclude))


def test_rounds_visit_few_leaves_and_stay_exact(spark):
    rng = np.random.default_rng(5)
    R = np.unique(np.round(np.concatenate([rng.normal(size=(4000, 3)), rng.normal(size=(2000, 3)) * 0.01 + 5]), 4), axis=0)
    Q = np.concatenate([np.round(rng.normal(size=(400, 3)), 4), np.round(rng.normal(size=(50, 3)) * 8, 4)])
    rows = nearest_distances(_df(spark, Q), _df(spark, R), ["a", "b", "c"], leaf_points=60).collect()
    got = {tuple(r[:3]): r for r in rows}
    want = np.sqrt(((Q[:, None] - R[None]) ** 2).sum(2)).min(1)
    assert len(got) == len(np.unique(Q, axis=0))
    assert all(abs(got[tuple(q)].nn_distance - w) < 1e-9 for q, w in zip(Q, want))
    visits = np.array([r.leaf_visits for r in rows])
    assert visits.max() <= 100 and np.median(visits) < 20  # of 100 leaves


def test_rows_without_whole_coordinates_are_kept(spark):
    q = spark.createDataFrame([(0.0, 1.0), (None, 1.0), (float("nan"), 2.0), (float("inf"), 0.0), (None, 1.0)], "a double, b double")
    p = spark.createDataFrame([(3.0, 5.0), (None, 1.0), (float("nan"), 2.0)], "a double, b double")
    rows = nearest_distances(q, p, ["a", "b"]).collect()
    assert sum(r.multiplicity for r in rows) == 5
    assert [r.nn_distance for r in rows if r.a == 0.0] == [5.0]
    assert sum(r.nn_distance is None for r in rows) == 3
    none = nearest_distances(q, p.limit(0), ["a", "b"]).collect()
    assert sum(r.multiplicity for r in none) == 5 and all(r.nn_distance is None for r in none)
    alone = nearest_distances(p, p, ["a", "b"], exclude_self=True).filter("a = 3").first()
    assert alone.nn_distance is None and alone.leaf_visits == 1


def test_next_leaves_continues_in_order():
    from tillguard.operators.nearest import next_leaves
    lo = np.array([[0.0], [2.0], [4.0], [4.0]])
    hi = lo + 1
    x, inf = np.array([[0.5], [9.0]]), np.full(2, np.inf)
    rows, at, after = next_leaves(x, inf, np.array([0, 0]), lo, hi, 1)
    assert at.tolist() == [0, 2] and after.tolist() == [1.5, 4.0]  # ties by number
    rows, at, after = next_leaves(x, np.array([2.0, np.inf]), np.array([1, 1]), lo, hi, 4)
    assert list(zip(rows.tolist(), at.tolist())) == [(0, 1), (1, 3), (1, 1), (1, 0)] and np.isinf(after).all()


def test_brute_distances_hold_a_small_block():
    import tracemalloc

    import numpy as np
    from tillguard.operators.nearest import _brute_dist
    rng = np.random.default_rng(2)
    q, p = rng.normal(size=(3000, 6)), rng.normal(size=(2048, 6))
    tracemalloc.start()
    got = _brute_dist(q, p, False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8_000_000
    assert np.array_equal(got[:50], np.sqrt(((q[:50, None] - p[None]) ** 2).sum(axis=2).min(axis=1)))


def test_leaves_hold_like_numbers_of_points():
    from tillguard.operators.nearest import _grow_kd, _route
    rng = np.random.default_rng(7)
    x = np.stack([np.where(rng.random(20000) < 0.97, 0.0, rng.integers(1, 5, 20000) * 9.0), rng.exponential(size=20000)], axis=1)
    held = np.bincount(_route(x, _grow_kd(x, 64)))
    assert held.max() < 2 * 20000 / 64  # an outlier takes no half of the leaves


def test_next_leaves_looks_at_near_boxes_only():
    import tracemalloc

    from tillguard.operators.nearest import next_leaves
    lo = np.stack(np.meshgrid(*[np.arange(16.0)] * 3), axis=-1).reshape(-1, 3)
    x = np.random.default_rng(8).uniform(0, 16, (4000, 3))
    tracemalloc.start()
    rows, at, after = next_leaves(x, np.full(4000, 0.05), np.zeros(4000, dtype=int), lo, lo + 1, 8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40_000_000  # of 4,096 boxes few are within 0.05 of a row
    gap = np.sqrt((np.maximum(0, np.maximum(lo[None] - x[:, None], x[:, None] - lo[None] - 1)) ** 2).sum(axis=2))
    assert sorted(zip(rows.tolist(), at.tolist())) == [tuple(p) for p in np.argwhere(gap < 0.05).tolist()]


def test_dnnr_weighs_copies_and_reads_the_points_once(spark, monkeypatch):
    from tillguard.operators import nearest
    rng = np.random.default_rng(9)
    R = np.round(rng.normal(size=(300, 3)), 2)
    S = np.round(rng.normal(size=(200, 3)), 2)
    R, S = np.concatenate([R, R[:40]]), np.concatenate([S, S[:1].repeat(150, axis=0), R[:30]])
    grown = []
    monkeypatch.setattr(nearest, "_grow_kd", lambda x, n, grow=nearest._grow_kd: grown.append(n) or grow(x, n))
    row = dnnr(_df(spark, R), _df(spark, S), ["a", "b", "c"], leaf_points=50)
    got = row.first()
    r, s = (R - R.mean(axis=0)) / R.std(axis=0), (S - R.mean(axis=0)) / R.std(axis=0)
    sr = np.sqrt(((s[:, None] - r[None]) ** 2).sum(axis=2)).min(axis=1)
    rr = np.sqrt(((r[:, None] - r[None]) ** 2).sum(axis=2))
    np.fill_diagonal(rr, np.inf)
    assert np.isclose(got.median_d_sr, np.median(sr)) and np.isclose(got.median_d_rr, np.median(rr.min(axis=1)))
    assert len(grown) == 1  # one partition serves both kinds of queries
