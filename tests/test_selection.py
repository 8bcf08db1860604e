import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillguard.operators import selection, validation
from tillguard.operators.metrics import average_precision, best_threshold, roc_auc
from tillguard.operators.profile import describe_features


def _frame(spark, columns, second=None):
    n = len(next(iter(columns.values())))
    rows = [tuple(None if v[i] is None else float(v[i]) for v in columns.values()) + (bool(second[i]) if second is not None else False,) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns) + ", two boolean").repartition(3)


def _columns(n=900, seed=4):
    r = np.random.default_rng(seed)
    return {"plain": r.standard_normal(n), "few": r.integers(0, 4, n).astype(float), "wide": r.standard_normal(n) * 10.0 ** r.integers(-200, 200, n),
            "one": np.full(n, 7.25), "zeros": np.where(r.random(n) < .5, 0.0, -0.0), "holes": [None if x < .3 else float("nan") if x < .4 else x for x in r.random(n)],
            "empty": [None] * n}


def _values(v):
    return np.array([x for x in v if x is not None and x == x], float)


def test_quantiles_equal_numpy(spark):
    cols = _columns()
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = selection.quantiles(_frame(spark, cols), list(cols), probs)
    for c, v in cols.items():
        want = _values(v)
        if not len(want):
            assert got[c] == [None] * len(probs)
        else:
            assert got[c] == pytest.approx(np.quantile(want, probs).tolist(), rel=1e-12, abs=1e-300), c


@pytest.mark.parametrize("shift", [0.0, 0.02, 0.5])
def test_distances_equal_the_sorted_way_and_brute_force(spark, shift):
    cols = _columns(700)
    second = np.random.default_rng(9).random(700) < 0.4
    for c in ("plain", "wide", "few"):
        cols[c] = np.where(second, cols[c] + (shift if c != "few" else round(2 * shift)), cols[c])
    del cols["empty"]
    df = _frame(spark, cols, second)
    a, b = df.filter("not two"), df.filter("two")
    ks = {r.column: r for r in validation.ks_statistics(a, b, list(cols)).collect()}
    ws = {r.column: r for r in validation.wasserstein_distances(a, b, list(cols)).collect()}
    slow = {r.column: r for r in validation.ks_by_sort(a, b, list(cols)).collect()}
    for c, v in cols.items():
        x = _values([t for t, s in zip(v, second) if not s])
        y = _values([t for t, s in zip(v, second) if s])
        every = np.unique(np.concatenate([x, y]) + 0.0)
        f = np.array([np.mean(x <= t) - np.mean(y <= t) for t in every])
        assert ks[c].ks == pytest.approx(np.abs(f).max(), abs=1e-12) and (ks[c].n1, ks[c].n2) == (len(x), len(y)) == (slow[c].n1, slow[c].n2)
        assert slow[c].ks == pytest.approx(ks[c].ks, abs=1e-12)
        want = float(np.sum(np.abs(f[:-1]) * np.diff(every)))
        assert ws[c].raw_distance == pytest.approx(want, rel=1e-9, abs=1e-12), c


def test_alike_samples_fall_back_to_the_exact_way(spark, monkeypatch):
    v = np.random.default_rng(1).standard_normal(400)
    df = _frame(spark, {"x": np.concatenate([v, v])}, np.arange(800) >= 400)
    a, b = df.filter("not two"), df.filter("two")
    for most in (selection.MOST_INTERVALS, 3):
        monkeypatch.setattr(selection, "MOST_INTERVALS", most)
        assert validation.ks_statistics(a, b, ["x"]).first().ks == 0.0
        assert validation.wasserstein_distances(a, b, ["x"]).first().raw_distance == pytest.approx(0.0, abs=1e-15)


def test_one_empty_sample(spark):
    df = _frame(spark, {"x": [1.0, 2.0, 4.0]}, [False] * 3)
    r = validation.ks_statistics(df, df.filter("two"), ["x"]).first()
    assert r.ks is None and (r.n1, r.n2) == (3, 0)
    assert validation.wasserstein_distances(df, df.filter("two"), ["x"]).first().raw_distance == 0.0


def test_describe_equals_numpy(spark):
    cols = {k: v for k, v in _columns().items() if k in ("plain", "few", "one")}
    for r in describe_features(_frame(spark, cols), list(cols)).collect():
        v = np.asarray(cols[r.column])
        assert r["count"] == len(v) and r.mean == pytest.approx(v.mean()) and r["std"] == pytest.approx(v.std(ddof=1), abs=1e-12)
        assert (r.min, r.max) == (v.min(), v.max()) and [r.p25, r.p50, r.p75] == pytest.approx(np.quantile(v, [.25, .5, .75]).tolist())


def test_curves_of_rounded_scores_equal_the_general_way(spark):
    r = np.random.default_rng(2)
    rows = [(round(float(s), 4), bool(y)) for s, y in zip(r.random(3000) ** 3, r.random(3000) < .2)]
    df = spark.createDataFrame(rows, "score double, label boolean")
    for f, c in ((roc_auc, "roc_auc"), (average_precision, "average_precision"), (best_threshold, "threshold")):
        assert f(df, "score", "label", decimals=4).first()[c] == pytest.approx(f(df, "score", "label").first()[c], abs=1e-12)
    with pytest.raises(Exception, match="0 to 1"):
        roc_auc(df.withColumn("score", F.col("score") + 1), "score", "label", decimals=4).collect()
    assert math.isclose(roc_auc(df, "score", "label", decimals=4).first().roc_auc, 0.5, abs_tol=0.1)
