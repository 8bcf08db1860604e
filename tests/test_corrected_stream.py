import random

import pytest
from pyspark.sql import functions as F

from helpers import tx_rows
from tillguard.plans.features import build_features
from tillguard.sinks.tables import append_transactions
from tillguard.streaming.corrected import (BINS, TERMINALS, KeyState, change_counts, changes, corrected_features,
                                           late_transactions, run_corrected_features)


def _rows(n=160, seed=5):
    r = random.Random(seed)
    return [{"id": f"x{i}", "t": r.choice([i * 700, i * 700, (i // 5) * 3500]), "terminal": r.choice(["TRM0", "TRM0", "TRM1"]), "bin": f"53998{r.randrange(2)}",
             "amount": r.choice([None, round(r.uniform(1, 900), 2)]), "lat": r.choice([None, 4.0 + r.random()]), "lon": 3.0 + r.random(),
             "fraud_type": r.choice(["", "fake_reversal"])} for i in range(n)]


def _replay(spark, scratch, slices, **how):
    """Slices arrive one after another; the queries stop and start again from
    their checkpoints in between."""
    for rows in slices:
        append_transactions(tx_rows(spark, rows).repartition(2), f"{scratch}/tx")
        queries = run_corrected_features(spark, f"{scratch}/tx", f"{scratch}/out", **how)
        for q in queries:
            q.awaitTermination()
            assert q.exception() is None
    done = changes(spark, f"{scratch}/out")
    return done, corrected_features(spark.read.parquet(f"{scratch}/tx"), done)


def _same(got, want):
    assert set(got) == set(want)
    for k, w in want.items():
        for c in ("velocity_1h", "geo_jump_km", "bin_spend_rate", "terminal_reversal_count", "amount_vs_bin_avg_ratio"):
            assert getattr(got[k], c) == (None if getattr(w, c) is None else pytest.approx(getattr(w, c), rel=1e-9, abs=1e-9)), (k, c)


def _by_id(df):
    return {r.transaction_id: r for r in df.collect()}


def test_shuffled_rows_with_corrections_equal_batch(spark, scratch):
    rows = _rows()
    random.Random(1).shuffle(rows)  # late and equal-second rows over all slices
    done, got = _replay(spark, scratch, [rows[:60], rows[60:110], rows[110:]], horizon=3 * 86400)
    _same(_by_id(got), _by_id(build_features(tx_rows(spark, rows))))
    counts = {r.feature: r for r in change_counts(done).collect()}
    assert counts["velocity_1h"].n_corrections > 0 and counts["geo_jump_km"].n_corrections > 0
    assert counts["geo_jump_km"].n_first == len(rows)
    # each correction's old value is the value before it
    last = {}
    for r in done.orderBy("version").collect():
        k = (r.feature, r.key, r.sec, r.transaction_id)
        assert (r.kind == "first") == (k not in last)
        if k in last:
            assert last[k] == r.old_value != r.new_value
        last[k] = r.new_value


def test_pending_rows_wait_and_leave_by_timer(spark, scratch):
    early = [{"id": 1, "t": 0}, {"id": 2, "t": 600, "terminal": "TRM9"}]
    # row 3 comes late but within the delay; row 4 moves the clock; row 5 is late
    done, got = _replay(spark, scratch, [early, [{"id": 3, "t": 30}], [{"id": 4, "t": 9000, "terminal": "TRM8"}],
                                         [{"id": 5, "t": 40}]], delay=1800, horizon=86400)
    got = _by_id(got)
    assert set(got) == {"1", "2", "3", "5"} and got["1"].velocity_1h == 1 and got["3"].velocity_1h == 2 and got["5"].velocity_1h == 3
    assert [r.transaction_id for r in late_transactions(done).collect()] == ["5"]
    assert done.filter("feature = 'velocity_1h' and kind = 'correction'").count() == 0  # nothing after second 40 was changed
    bins = done.filter("feature = 'bin_spend_rate'").collect()
    assert sum(r.kind == "correction" for r in bins) == 0 or all(r.old_value != r.new_value for r in bins if r.kind == "correction")


def test_rows_behind_the_watermark_are_not_taken(spark, scratch):
    done, got = _replay(spark, scratch, [[{"id": 1, "t": 0}, {"id": 2, "t": 90000}], [{"id": 3, "t": 10}, {"id": 4, "t": 90010}]], horizon=3600)
    assert set(_by_id(got)) == {"1", "2", "4"}


def test_state_is_bounded_by_window_and_horizon():
    import pandas as pd
    for op in (TERMINALS, BINS):
        state, most = KeyState(None), 0
        for t in range(0, 60 * 86400, 7200):
            frame = pd.DataFrame({"_sec": [t], "_micros": [t * 1_000_000], "transaction_id": [str(t)], "latitude": [4.0],
                                  "longitude": [None], "_n": [1], "_s": [2.5]})
            state = KeyState(state.text())
            state.revise(op, state.add(op, frame, t), 1 << 62, max(0, t - 86400), lambda s: True)
            state.evict(op, max(0, t - 86400))
            most = max(most, len(state.panes))
            assert len(state.rows) <= 14 and len(state.out) <= 13 and len(state.jumps) <= 13
        assert most <= (86400 + op.lookback) // 7200 + 1


def test_late_row_across_a_bucket_edge_corrects_the_next_bucket(spark, scratch):
    edge = 4 * 3600 * 10  # T0 is on a whole hour, so some bucket edge lies within these seconds
    first = [{"id": i, "t": i * 900, "amount": 100.0} for i in range(40)]
    late = [{"id": 100 + i, "t": i * 900 + 450, "amount": 10.0} for i in range(40)]
    done, got = _replay(spark, scratch, [first, late], horizon=edge)
    _same(_by_id(got), _by_id(build_features(tx_rows(spark, first + late))))
    assert done.filter("feature = 'bin_spend_rate' and kind = 'correction'").select(F.countDistinct("sec")).first()[0] == 39


class _State:
    """A group's state between calls, as Spark holds it."""
    def __init__(self):
        self.text, self.wake, self.hasTimedOut, self.watermark = None, None, False, 0

    exists = property(lambda self: self.text is not None)
    get = property(lambda self: (self.text,))

    def update(self, row):
        self.text = row[0]

    def remove(self):
        self.text = None

    def getCurrentWatermarkMs(self):
        return self.watermark

    def setTimeoutTimestamp(self, at):
        self.wake = at


def _frame(rows):
    import pandas as pd
    return pd.DataFrame([(k, s, s * 1_000_000, f"{k}{s}", 4.0, 3.0, 1, 0.0) for k, s in rows],
                        columns=["terminal_id", "_sec", "_micros", "transaction_id", "latitude", "longitude", "_n", "_s"])


def test_terminals_share_a_state_and_keep_their_own_clocks():
    from tillguard.streaming.corrected import _stepper
    step, state, day = _stepper(TERMINALS, 3600, 86400), _State(), 86400
    assert not list(step((7,), iter([_frame([("A", day), (None, day + 9000), ("B", day + 10000)])]), state))
    state.hasTimedOut, state.watermark = True, (day + 5000 - 86400) * 1000 + 1  # the clock passed A's wait only
    assert state.wake < state.watermark
    out = list(step((7,), iter([]), state))
    assert [sorted({(r.key, r.sec, r.version) for r in f.itertuples()}) for f in out] == [[("A", day, 1)]]
    state.hasTimedOut = False  # a row for A; NULL and B have waited long enough
    state.watermark = 20000 * 1000
    out = list(step((7,), iter([_frame([("A", day + 30)])]), state))
    assert len(out) == 1 and {(r.key, r.version) for r in out[0].itertuples()} == {("A", 2), (None, 1), ("B", 1)}
    assert out[0].query("key == 'A' and feature == 'velocity_1h'").new_value.tolist() == [2.0]


def test_work_on_touched_seconds_grows_with_seconds_not_with_their_windows():
    import pandas as pd
    asked, n = [], 2000
    state, frame = KeyState(None), pd.DataFrame({"_sec": range(n), "_n": 1, "_s": 1.0})
    changes = state.revise(BINS, state.add(BINS, frame, 0), 1 << 62, 0, lambda s: asked.append(s) or True)
    assert len(changes) == n and len(asked) <= 2 * n
