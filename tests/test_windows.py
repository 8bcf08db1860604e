from pyspark.sql import functions as F

from helpers import tx_rows
from tillguard.operators.trailing import trailing_window_agg
from tillguard.plans.features import build_features


def _feat(spark, rows, **kw):
    return {r.transaction_id: r for r in build_features(tx_rows(spark, rows), **kw).collect()}


def test_one_hour_boundaries(spark):
    rows = [{"id": 1, "t": 0}, {"id": 2, "t": 3600}, {"id": 3, "t": 7201}]
    f = _feat(spark, rows)
    assert f["1"].velocity_1h == 1 and f["2"].velocity_1h == 2 and f["3"].velocity_1h == 1


def test_day_boundaries_reversals(spark):
    rows = [{"id": 1, "t": 0, "fraud_type": "fake_reversal"}, {"id": 2, "t": 86400},
            {"id": 3, "t": 86401 + 86400, "fraud_type": "fake_reversal"}, {"id": 4, "t": 86401 + 86400 + 86401}]
    f = _feat(spark, rows)
    assert [f[str(i)].terminal_reversal_count for i in range(1, 5)] == [1, 1, 1, 0]


def test_equal_timestamps_are_peers(spark):
    rows = [{"id": 1, "t": 10}, {"id": 2, "t": 10}, {"id": 3, "t": 10}]
    f = _feat(spark, rows)
    assert {r.velocity_1h for r in f.values()} == {3}


def test_subsecond_truncates_to_seconds(spark):
    import datetime as dt
    from tillguard.schemas import TRANSACTION_SCHEMA
    from helpers import T0
    rows = [("1", "TRM1", "M", "539983", 1.0, None, None, 1.0, 1.0, T0 + dt.timedelta(seconds=0.9), False, ""),
            ("2", "TRM1", "M", "539983", 1.0, None, None, 1.0, 1.0, T0 + dt.timedelta(seconds=3600.5), False, "")]
    f = {r.transaction_id: r for r in build_features(spark.createDataFrame(rows, TRANSACTION_SCHEMA)).collect()}
    assert f["2"].velocity_1h == 2  # whole seconds: 3600 - 0 is inside the hour


def test_geo_jump_first_row_zero_and_null(spark):
    rows = [{"id": 1, "t": 0, "lat": 6.5244, "lon": 3.3792}, {"id": 2, "t": 10, "lat": 9.0765, "lon": 7.3986},
            {"id": 3, "t": 20, "lat": None}, {"id": 4, "t": 30}]
    f = _feat(spark, rows)
    assert f["1"].geo_jump_km == 0.0
    assert 400 < f["2"].geo_jump_km < 600
    assert f["3"].geo_jump_km is None      # current latitude NULL
    assert f["4"].geo_jump_km == 0.0       # previous latitude NULL


def test_geo_jump_previous_row_in_an_old_bucket(spark):
    # 10 days between the rows: far outside every bucket's context
    rows = [{"id": 1, "t": 0, "lat": 6.5244, "lon": 3.3792}, {"id": 2, "t": 10 * 86400, "lat": 9.0765, "lon": 7.3986}]
    f = _feat(spark, rows)
    assert 400 < f["2"].geo_jump_km < 600


def test_bucketed_equals_plain_with_hot_key(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for i in range(600):
        hot = i % 3 == 0
        rows.append({"id": i, "t": rnd.randint(0, 5 * 86400), "terminal": "TRMHOT" if hot else f"TRM{i % 17}",
                     "bin": "539980" if hot else f"53998{i % 9}", "amount": float(rnd.randint(1, 500)),
                     "lat": 4 + rnd.random(), "lon": 3 + rnd.random(),
                     "fraud_type": "fake_reversal" if i % 11 == 0 else ""})
    a = build_features(tx_rows(spark, rows)).orderBy("transaction_id").collect()
    b = build_features(tx_rows(spark, rows), mode="plain").orderBy("transaction_id").collect()
    for x, y in zip(a, b):
        assert x.velocity_1h == y.velocity_1h and x.terminal_reversal_count == y.terminal_reversal_count
        assert abs(x.bin_spend_rate - y.bin_spend_rate) < 1e-9
        assert abs(x.geo_jump_km - y.geo_jump_km) < 1e-9


def test_null_and_zero_amount(spark):
    rows = [{"id": 1, "t": 0, "amount": 0.0}, {"id": 2, "t": 5, "amount": None}, {"id": 3, "t": 9, "amount": 30.0}]
    df = tx_rows(spark, rows)
    f = {r.transaction_id: r for r in build_features(df).collect()}
    assert f["1"].amount_vs_bin_avg_ratio is None      # 0 / 0 -> NULL, no ANSI error
    assert f["3"].bin_spend_rate == 15.0               # NULL amount skipped


def test_row_tie_policy(spark):
    rows = [{"id": 1, "t": 0}, {"id": 2, "t": 0}, {"id": 3, "t": 0}, {"id": 4, "t": 3601}]
    df = tx_rows(spark, rows)
    peers = {r.transaction_id: r.n for r in trailing_window_agg(df, "card_bin", 3600, out="n").collect()}
    row = {r.transaction_id: r.n for r in trailing_window_agg(df, "card_bin", 3600, out="n", tie_policy="row",
                                                              tie_order="transaction_id").collect()}
    assert peers == {"1": 3, "2": 3, "3": 3, "4": 1}
    assert row == {"1": 1, "2": 2, "3": 3, "4": 1}
    mean = {r.transaction_id: r.m for r in trailing_window_agg(df.withColumn("amount_ngn", F.col("transaction_id")
                                                                              .cast("double")),
                                                               "card_bin", 3600, "mean", value="amount_ngn", out="m",
                                                               tie_policy="row", tie_order="transaction_id").collect()}
    assert mean["2"] == 1.5 and mean["3"] == 2.0


def test_prefix_mode_equals_window(spark):
    import random
    from tillguard.operators.trailing import Trailing, trailing_aggregates, with_epoch_seconds
    rnd = random.Random(5)
    rows = [{"id": i, "t": rnd.randint(0, 3 * 86400) // 7 * 7, "bin": "539980" if i % 2 else f"53998{i % 5}",
             "amount": float(rnd.randint(1, 900)) if i % 13 else None,
             "fraud_type": "fake_reversal" if i % 6 == 0 else ""} for i in range(500)]
    df = with_epoch_seconds(tx_rows(spark, rows)).withColumn("_rev", (F.col("fraud_type") == "fake_reversal").cast("int"))
    specs = [Trailing("n", "count", "transaction_id", 3600), Trailing("r", "sum", "_rev", 86400),
             Trailing("m", "mean", "amount_ngn", 3600)]
    a = {r.transaction_id: r for r in trailing_aggregates(df, ["card_bin"], specs, mode="prefix").collect()}
    b = {r.transaction_id: r for r in trailing_aggregates(df, ["card_bin"], specs, mode="plain").collect()}
    for k, w in b.items():
        g = a[k]
        assert g.n == w.n and g.r == w.r
        assert (g.m is None and w.m is None) or abs(g.m - w.m) < 1e-9
    f1 = build_features(tx_rows(spark, rows), bin_mode="prefix").collect()
    f2 = build_features(tx_rows(spark, rows), bin_mode="by_second").collect()
    rates = [{r.transaction_id: r.bin_spend_rate for r in f} for f in (f1, f2)]
    assert rates[0].keys() == rates[1].keys()
    for k, v in rates[0].items():
        assert (v is None and rates[1][k] is None) or abs(v - rates[1][k]) < 1e-9


def test_hot_terminal_prefix_mode_equals_plain(spark):
    import random
    rnd = random.Random(9)
    rows = [{"id": i, "t": rnd.randint(0, 4 * 86400), "terminal": "TRMHOT" if i % 3 else f"TRM{i % 7}",
             "bin": f"53998{i % 3}", "amount": float(rnd.randint(1, 500)), "lat": 4 + rnd.random(),
             "lon": 3 + rnd.random(), "fraud_type": "fake_reversal" if i % 5 == 0 else ""} for i in range(400)]
    rows.append({"id": 999, "t": 9 * 86400, "terminal": "TRMHOT", "lat": 9.0, "lon": 7.0})  # long gap
    a = {r.transaction_id: r for r in build_features(tx_rows(spark, rows), terminal_mode="prefix",
                                                     bin_mode="prefix").collect()}
    b = {r.transaction_id: r for r in build_features(tx_rows(spark, rows), mode="plain").collect()}
    for k, w in b.items():
        g = a[k]
        assert g.velocity_1h == w.velocity_1h and g.terminal_reversal_count == w.terminal_reversal_count
        assert abs(g.geo_jump_km - w.geo_jump_km) < 1e-9 and abs(g.bin_spend_rate - w.bin_spend_rate) < 1e-9


def test_default_path_equals_plain_on_nulls_nan_and_tiny_amounts(spark):
    import math
    rows = [{"id": 1, "t": 0, "bin": None}, {"id": 2, "t": 60, "bin": None, "terminal": None, "lat": 1.0, "lon": 1.0},
            {"id": 3, "t": 90, "terminal": None, "lat": 2.0, "lon": 1.0}, {"id": 4, "t": 3 * 86400, "terminal": None, "lat": 3.0, "lon": 1.0},
            {"id": 5, "t": 100, "bin": "B", "amount": 1e-13}, {"id": 6, "t": 101, "bin": "B", "amount": 3e-13},
            {"id": 7, "t": 5, "bin": "N", "amount": float("nan")}, {"id": 8, "t": 6, "bin": "N", "amount": 2500.0},
            {"id": 9, "t": 7, "terminal": "T9"}, {"id": 10, "t": 8, "terminal": "T9"}, {"id": 11, "t": 8, "terminal": "T9", "lat": 7.0}]
    df = tx_rows(spark, rows)
    df = df.withColumn("timestamp", F.when(F.col("transaction_id") != "9", F.col("timestamp")))
    plain = {r.transaction_id: r for r in build_features(df, mode="plain").collect()}
    assert len(plain) == len(rows)
    for mode in ("blocks", "by_second", "bucketed"):
        got = {r.transaction_id: r for r in build_features(df, mode=mode).collect()}
        assert set(got) == set(plain), mode
        for k, w in plain.items():
            for c in ("velocity_1h", "terminal_reversal_count", "geo_jump_km", "bin_spend_rate"):
                a, b = got[k][c], w[c]
                same = a == b or (a is not None and b is not None and (math.isclose(a, b, rel_tol=1e-9) or (math.isnan(a) and math.isnan(b))))
                assert same, (mode, k, c, a, b)
    assert plain["2"].bin_spend_rate == 5000.0 and plain["5"].bin_spend_rate == 1e-13


def test_blocks_equal_plain_at_every_edge_of_a_block(spark):
    import random
    from tillguard.operators.trailing import Trailing, trailing_blocks, trailing_aggregates, with_epoch_seconds
    rnd = random.Random(3)
    edges = [0, 1, 1799, 1800, 1801, 3599, 3600, 3601, 5399, 5400, 86399, 86400, 86401, 88200]
    rows = [{"id": i, "t": rnd.choice(edges) + rnd.choice([0, 86400, 600]), "terminal": rnd.choice(["A", "B"]), "lat": rnd.choice([None, rnd.random()]),
             "amount": rnd.choice([None, rnd.uniform(0, 1e6), 1e-9]), "fraud_type": rnd.choice(["", "x", "yy"])} for i in range(400)]
    df = with_epoch_seconds(tx_rows(spark, rows))
    specs = [Trailing("n", "count", "amount_ngn", 3600), Trailing("d", "sum", "amount_ngn", 86400), Trailing("m", "mean", "amount_ngn", 1800), Trailing("r", "sum", F.length("fraud_type"), 5400)]
    how = dict(prev_cols=["latitude"], prev_order=["timestamp", "transaction_id"])
    got = {r.transaction_id: r for r in trailing_blocks(df, ["terminal_id"], specs, **how).collect()}
    for r in trailing_aggregates(df, ["terminal_id"], specs, mode="plain", **how).collect():
        g = got[r.transaction_id]
        assert g.n == r.n and g.r == r.r and g.prev_latitude == r.prev_latitude
        for c in ("d", "m"):
            assert (g[c] is None) == (r[c] is None) and (r[c] is None or abs(g[c] - r[c]) <= 1e-9 * max(1, abs(r[c])))


def test_feature_plan_has_few_exchanges_and_no_join(spark):
    df = tx_rows(spark, [{"id": i, "t": i} for i in range(50)])
    plan = build_features(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 6 and "Join" not in plan


def test_hot_bin_is_spread_over_its_blocks(spark):
    rows = [{"id": i, "t": i * 7, "bin": "539980", "terminal": "T", "amount": 1.0 * (i % 9)} for i in range(4000)]
    df = tx_rows(spark, rows)
    a = {r.transaction_id: r for r in build_features(df).collect()}
    b = {r.transaction_id: r for r in build_features(df, mode="plain").collect()}
    assert all(abs(a[k].bin_spend_rate - w.bin_spend_rate) < 1e-9 and a[k].velocity_1h == w.velocity_1h for k, w in b.items())
    from tillguard.operators.trailing import BLOCK_SECONDS
    assert max(sum(r["t"] // BLOCK_SECONDS == x for r in rows) for x in range(100)) <= BLOCK_SECONDS // 7 + 1  # own rows of a partition


def test_prefix_features_join_each_value_once(spark):
    from helpers import tx_rows
    from tillguard.plans.features import build_features
    rows = [{"id": i, "t": 700 * i, "terminal": f"TRM{i % 3}", "bin": str(i % 2), "amount": i + 0.5, "lat": 4.0 + i % 5,
             "fraud_type": "fake_reversal" if i % 4 == 0 else ""} for i in range(60)]
    tx = tx_rows(spark, rows)
    got = build_features(tx, terminal_mode="prefix", bin_mode="prefix")
    # previous place of an empty bucket, terminal sums, BIN sums; and the offsets of the two sums' buckets
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 5
    want = {r.transaction_id: r for r in build_features(tx, mode="plain").collect()}
    for r in got.collect():
        w = want[r.transaction_id]
        assert (r.velocity_1h, r.geo_jump_km, r.terminal_reversal_count) == (w.velocity_1h, w.geo_jump_km, w.terminal_reversal_count)
        assert abs(r.bin_spend_rate - w.bin_spend_rate) < 1e-9
