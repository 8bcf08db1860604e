import uuid

import numpy as np
import pytest

from test_selection import _columns, _frame, _values
from tillguard import session
from tillguard.operators import selection, validation
from tillguard.plans import features


def _samples(spark, n=3000, seed=3):
    cols = _columns(n, seed)
    second = np.random.default_rng(seed + 1).random(n) < 0.4
    cols["plain"] = np.where(second, cols["plain"] + 0.1, cols["plain"])
    df = _frame(spark, cols, second)
    return cols, second, df.filter("not two"), df.filter("two")


def _want(v, second):
    x, y = _values([t for t, s in zip(v, second) if not s]), _values([t for t, s in zip(v, second) if s])
    every = np.unique(np.concatenate([x, y]) + 0.0)
    f = np.array([np.mean(x <= t) - np.mean(y <= t) for t in every])
    return np.abs(f).max(), len(x), len(y), float(np.sum(np.abs(f[:-1]) * np.diff(every)))


@pytest.mark.parametrize("single, bins, most", [(1 << 17, 1 << 16, 1 << 14), (0, 16, 1 << 14), (40, 64, 1 << 14), (1 << 17, 1 << 16, 2)])
def test_both_distances_equal_brute_force(spark, monkeypatch, single, bins, most):
    monkeypatch.setattr(selection, "SINGLE_VALUES", single)
    monkeypatch.setattr(selection, "COLUMN_BINS", bins)
    monkeypatch.setattr(selection, "MOST_INTERVALS", most)  # 2: most columns go the exact way by sorting
    cols, second, a, b = _samples(spark, 700)
    ks, ws = ({c: of for c, *of in rows} for rows in validation.distances(a, b, list(cols)))
    assert "empty" not in ks and ws.pop("empty") == [0.0, float("inf")]
    assert set(ks) == set(ws) == set(cols) - {"empty"}
    for c in ks:
        d, n1, n2, area = _want(cols[c], second)
        assert ks[c] == [pytest.approx(d, abs=1e-12), n1, n2], c
        assert ws[c][0] == pytest.approx(area, rel=1e-9, abs=1e-12), c


def test_validation_shares_its_passes_and_writes_nothing(spark, monkeypatch):
    passes, run = [], selection._pass
    monkeypatch.setattr(selection, "_pass", lambda *a, **k: passes.append(1) or run(*a, **k))
    monkeypatch.setattr(session, "materialize", lambda df: pytest.fail("a sample was written to the checkpoint folder"))
    cols, _, a, b = _samples(spark)
    c = [x for x in cols if x in ("plain", "few", "wide")]
    results = validation.validate(a, b, continuous=c, categorical=["few"], features=c)
    assert {r.level for r in results.collect()} == {"level1", "level3a", "level3b", "level3c"}
    assert len(passes) <= 2  # the range in bins, then single values


def test_infinite_values_are_ends_of_the_range(spark):
    df = _frame(spark, {"x": [float("-inf"), 1.0, 2.0, float("inf"), 1.0, float("inf")]}, [False] * 4 + [True] * 2)
    assert selection.ks(df, ["x"], "two")["x"] == (pytest.approx(0.25), 4, 2)


def test_tasks_of_a_pass_do_not_grow_with_partitions(spark):
    sc, group = spark.sparkContext, uuid.uuid4().hex
    df = spark.range(4000).selectExpr("cast(id as double) as x", "id % 2 = 0 as two").repartition(64).persist()
    df.count()
    sc.setJobGroup(group, "a pass")
    try:
        bins = selection._pass(df, ["x"], "two", {"x": selection.ALL})["x"]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        df.unpersist()
    assert sum(b.n1 + b.n2 for b in bins) == 4000
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    tasks = [i.numTasks for i in map(tracker.getStageInfo, stages) if i is not None and i.numCompletedTasks]
    assert tasks and max(tasks) <= selection.TASKS_PER_CORE * sc.defaultParallelism


def test_places_do_not_move_with_the_bin_windows(spark, monkeypatch):
    moved, stage = [], features._bin_stage
    monkeypatch.setattr(features, "_bin_stage", lambda df, *a, **k: moved.extend(df.columns) or stage(df, *a, **k))
    tx = spark.sql("select '1' as transaction_id, 't' as terminal_id, 'b' as card_bin, 5.0D as amount_ngn, 6.5D as latitude, 3.4D as longitude, "
                   "timestamp'2024-01-01 00:00:00' as timestamp, '' as fraud_type")
    assert features.build_features(tx).first().bin_spend_rate == 5.0
    assert moved and not {"latitude", "longitude", "fraud_type"} & set(moved)
