import random

import numpy as np

from tillguard.operators import metrics, validation
from tillguard.operators.cumulative import exact_quantiles


def _scored(spark, n=400, seed=3):
    rnd = random.Random(seed)
    rows = [(str(i), round(rnd.random(), 2), int(rnd.random() < 0.3)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "transaction_id string, score double, y int")


def test_auc_ap_threshold_brute_force(spark):
    rows, df = _scored(spark)
    s = np.array([r[1] for r in rows]); y = np.array([r[2] for r in rows])
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(metrics.roc_auc(df, "score", "y", n_buckets=7).first().roc_auc - auc) < 1e-12
    thr = np.unique(s)[::-1]
    tps = np.array([((s >= t) & (y == 1)).sum() for t in thr]); fps = np.array([((s >= t) & (y == 0)).sum() for t in thr])
    prec, rec = tps / (tps + fps), tps / y.sum()
    ap = np.sum(np.diff(np.concatenate([[0], rec])) * prec)
    assert abs(metrics.average_precision(df, "score", "y", n_buckets=5).first().average_precision - ap) < 1e-12
    f1 = 2 * prec * rec / (prec + rec + 1e-12)
    asc = np.argsort(thr)  # ascending thresholds, first max wins
    best = thr[asc][np.argmax(f1[asc])]
    assert metrics.best_threshold(df, "score", "y", n_buckets=6).first().threshold == best


def test_precision_at_k_brute_force(spark):
    rows, df = _scored(spark)
    k = 37
    order = sorted(rows, key=lambda r: (r[1], r[0]))[:k]
    want = sum(r[2] for r in order) / k
    assert abs(metrics.precision_at_k(df, "score", "y", k, n_buckets=4).first().precision_at_k - want) < 1e-12


def test_ks_wasserstein_brute_force(spark):
    rnd = random.Random(5)
    a = [round(rnd.gauss(0, 1), 2) for _ in range(300)]
    b = [round(rnd.gauss(0.2, 1.2), 2) for _ in range(250)]
    ra = spark.createDataFrame([(x,) for x in a], "v double"); rb = spark.createDataFrame([(x,) for x in b], "v double")
    xs = np.unique(np.concatenate([a, b]))
    Fa = np.searchsorted(np.sort(a), xs, side="right") / len(a)
    Fb = np.searchsorted(np.sort(b), xs, side="right") / len(b)
    ks = np.max(np.abs(Fa - Fb))
    w = np.sum(np.abs(Fa - Fb)[:-1] * np.diff(xs))
    assert abs(validation.ks_statistic(ra, rb, "v", n_buckets=6).first().ks - ks) < 1e-12
    got = validation.wasserstein(ra, rb, "v", n_buckets=6).first()
    assert abs(got.raw_distance - w) < 1e-9
    assert abs(got.normalized_score - w / np.std(a, ddof=1)) < 1e-9


def test_exact_quantiles(spark):
    vals = [float(x) for x in [5, 1, 3, 3, 9, 2, 8, 8, 7]]
    q = exact_quantiles(spark.createDataFrame([(v,) for v in vals], "v double"), "v", [0.25, 0.5, 0.75],
                        n_buckets=3).first()
    want = np.percentile(vals, [25, 50, 75])
    assert abs(q.q25 - want[0]) < 1e-12 and abs(q.q50 - want[1]) < 1e-12 and abs(q.q75 - want[2]) < 1e-12


def test_chi2_pvalue_known_values():
    assert abs(validation.chi2_pvalue(3.841458820694124, 1) - 0.05) < 1e-9
    assert abs(validation.chi2_pvalue(5.991464547107979, 2) - 0.05) < 1e-9


def test_gate(spark):
    rnd = random.Random(1)
    rows = [(float(rnd.randint(1, 3)), rnd.random() * 10, rnd.random() * 100, float(rnd.randint(0, 2)),
             rnd.random() * 1000, rnd.random() * 2, int(rnd.random() < 0.1)) for _ in range(400)]
    schema = ("velocity_1h double, geo_jump_km double, bin_spend_rate double, terminal_reversal_count double, "
              "amount_ngn double, amount_vs_bin_avg_ratio double, is_fraud int")
    real = spark.createDataFrame(rows, schema); synth = spark.createDataFrame(list(reversed(rows)), schema)
    res = validation.validate(real, synth, level4={"auc_gap": 0.01}, level5={"dnnr": 2.0})
    g = validation.approve(res).first()
    assert g.approved, g.reasons
    bad = validation.validate(real, synth, level5={"dnnr": 0.5})
    g2 = validation.approve(bad).first()
    assert not g2.approved and any("level5" in r for r in g2.reasons)


def test_gate_fails_closed(spark):
    from tillguard.operators import validation
    schema = "level string, column string, metric string, value double, rating string, passed boolean"
    assert not validation.approve(spark.createDataFrame([], schema)).first().approved
    one = spark.createDataFrame([("level3a", "x", "ks_statistic", 0.01, "excellent", True)], schema)
    g = validation.approve(one).first()
    assert not g.approved and "level4: no results" in g.reasons and "level5: no results" in g.reasons
