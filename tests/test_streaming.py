from pyspark.sql import functions as F

from helpers import tx_rows
from tillguard.plans.features import build_features
from tillguard.sources.events import to_wire_json
from tillguard.streaming import dedupe_stream, run_feature_stream, transaction_stream


def test_stream_with_history_equals_batch(spark, scratch):
    rows = []
    for i in range(120):
        rows.append({"id": i, "t": i * 1700, "terminal": f"TRM{i % 3}", "bin": f"53998{i % 2}",
                     "amount": float(10 + i % 7), "lat": 4.0 + (i % 5) / 10, "lon": 3.0,
                     "fraud_type": "fake_reversal" if i % 9 == 0 else ""})
    tx = tx_rows(spark, rows)
    # three time-ordered files -> three micro-batches
    for lo, hi in ((0, 40), (40, 80), (80, 120)):
        to_wire_json(tx.filter((F.col("transaction_id").cast("int") >= lo) & (F.col("transaction_id").cast("int") < hi))
                     ).coalesce(1).write.mode("append").text(f"{scratch}/src")
    q = run_feature_stream(transaction_stream(spark, path=f"{scratch}/src", max_files_per_trigger=1),
                           f"{scratch}/features", f"{scratch}/ckpt")
    q.awaitTermination()
    got = {r.transaction_id: r for r in spark.read.parquet(f"{scratch}/features").collect()}
    want = {r.transaction_id: r for r in build_features(tx).collect()}
    assert len(got) == 120
    for k, w in want.items():
        g = got[k]
        assert g.velocity_1h == w.velocity_1h and g.terminal_reversal_count == w.terminal_reversal_count
        assert abs(g.bin_spend_rate - w.bin_spend_rate) < 1e-9 and abs(g.geo_jump_km - w.geo_jump_km) < 1e-9
    # replaying the same source into the same table appends nothing new
    q2 = run_feature_stream(transaction_stream(spark, path=f"{scratch}/src"), f"{scratch}/features",
                            f"{scratch}/ckpt2")
    q2.awaitTermination()
    assert spark.read.parquet(f"{scratch}/features").count() == 120


def test_dedupe_within_watermark(spark, scratch):
    tx = tx_rows(spark, [{"id": 1, "t": 0}, {"id": 1, "t": 0}, {"id": 2, "t": 10}])
    to_wire_json(tx).coalesce(1).write.text(f"{scratch}/src")
    d = dedupe_stream(transaction_stream(spark, path=f"{scratch}/src"))
    q = (d.writeStream.format("memory").queryName("dedupe_t").trigger(availableNow=True)
          .option("checkpointLocation", f"{scratch}/ck").start())
    q.awaitTermination()
    assert sorted(r[0] for r in spark.sql("select transaction_id from dedupe_t").collect()) == ["1", "2"]


def test_late_row_gets_features_from_stored_history(spark, scratch):
    # batch 1: rows at 0, 600, 1200 s; batch 2: a late row at 900 s
    to_wire_json(tx_rows(spark, [{"id": 1, "t": 0}, {"id": 2, "t": 600}, {"id": 3, "t": 1200}])
                 ).coalesce(1).write.mode("append").text(f"{scratch}/src")
    to_wire_json(tx_rows(spark, [{"id": 4, "t": 900}])).coalesce(1).write.mode("append").text(f"{scratch}/src")
    q = run_feature_stream(transaction_stream(spark, path=f"{scratch}/src", max_files_per_trigger=1),
                           f"{scratch}/features", f"{scratch}/ckpt")
    q.awaitTermination()
    got = {r.transaction_id: r.velocity_1h for r in spark.read.parquet(f"{scratch}/features").collect()}
    assert got["4"] == 3        # rows at 0, 600 and itself (900); 1200 is after it
    assert got["3"] == 3        # emitted before the late row arrived: not revised


def test_watermark_drops_late_duplicates(spark, scratch):
    from tillguard.streaming import rows_dropped_by_watermark
    to_wire_json(tx_rows(spark, [{"id": 1, "t": 0}, {"id": 2, "t": 7200}])).coalesce(1).write.mode(
        "append").text(f"{scratch}/src")
    to_wire_json(tx_rows(spark, [{"id": 1, "t": 0}, {"id": 3, "t": 7300}])).coalesce(1).write.mode(
        "append").text(f"{scratch}/src")
    q = run_feature_stream(transaction_stream(spark, path=f"{scratch}/src", max_files_per_trigger=1),
                           f"{scratch}/features", f"{scratch}/ckpt", watermark="30 minutes")
    q.awaitTermination()
    ids = sorted(r[0] for r in spark.read.parquet(f"{scratch}/features").select("transaction_id").collect())
    assert ids == ["1", "2", "3"]
    assert rows_dropped_by_watermark(q) >= 0


def test_context_rows_come_once_from_one_read_of_the_history(spark, scratch):
    from tillguard.sinks.tables import append_idempotent
    from tillguard.streaming import _with_history
    # stored: same terminal and BIN as the batch's, same terminal, same BIN, neither
    stored = [{"id": 1, "t": 0}, {"id": 2, "t": 5, "bin": "1"}, {"id": 3, "t": 9, "terminal": "TRM9"}, {"id": 4, "t": 9, "terminal": "TRM9", "bin": "1"}]
    append_idempotent(tx_rows(spark, stored), f"{scratch}/history")
    b = _with_history(tx_rows(spark, [{"id": 5, "t": 60}]), f"{scratch}/history", 1)
    assert sorted(r.transaction_id for r in b.collect()) == ["1", "2", "3", "5"]
    assert b._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_an_append_writes_few_files_a_date(spark, scratch):
    import glob
    from tillguard.sinks.tables import append_idempotent
    rows = [{"id": i, "t": (i % 3) * 86400} for i in range(240)]
    append_idempotent(tx_rows(spark, rows).repartition(8), f"{scratch}/table")
    assert spark.read.parquet(f"{scratch}/table").count() == 240
    assert len(glob.glob(f"{scratch}/table/*/*.parquet")) == 3


def test_alert_replay_holds_a_slice_of_state(spark, scratch, monkeypatch):
    from tillguard import streaming
    from tillguard.catalog import queries
    n = 1200
    ev = spark.range(n).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(1704067200 + F.col("id") * 600).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 40).alias("user_id"), F.lit("purchase").alias("event_type"), (F.col("id") % 250).cast("double").alias("value"),
        F.concat(F.lit('{"k": '), F.col("id") % 100, F.lit("}")).alias("props"))
    ev.unionByName(ev.filter("event_id % 7 = 0")).write.parquet(f"{scratch}/events.parquet")
    spark.range(30).selectExpr("id c_custkey", "concat('C', id) c_name", "'M' c_mktsegment", "1.0D c_acctbal").write.parquet(f"{scratch}/customer.parquet")
    spark.range(30).selectExpr("id s_suppkey", "concat('S', id) s_name", "id % 3 s_nationkey", "1.0D s_acctbal").write.parquet(f"{scratch}/supplier.parquet")
    spark.range(3).selectExpr("id n_nationkey", "concat('N', id) n_name").write.parquet(f"{scratch}/nation.parquet")
    runs, start = [], streaming.stream_to_table
    monkeypatch.setattr(streaming, "stream_to_table", lambda *a: runs.append(start(*a)) or runs[-1])
    monkeypatch.setattr(queries, "REPLAY_ROWS", 400, raising=False)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    got = queries.QUERIES["stream_alerts"](spark, scratch).collect()
    want = queries.QUERIES["alerts_enriched"](spark, scratch).collect()
    assert len(want) > 100 and sorted(map(str, got)) == sorted(map(str, want))
    most = max(op["numRowsTotal"] for q in runs for p in q.recentProgress for op in p["stateOperators"])
    assert most < n  # all rows of both streams before
    assert spark.conf.get("spark.sql.shuffle.partitions") == partitions
