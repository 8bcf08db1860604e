from pyspark.sql import functions as F

from helpers import tx_rows
from tillguard.sinks.tables import append_idempotent, keyed_json
from tillguard.sources.changelog import latest_by_key
from tillguard.sources.events import decode_json, normalize_columns, to_wire_json


def test_replay_is_idempotent(spark, scratch):
    path = f"{scratch}/features"
    a = append_idempotent(tx_rows(spark, [{"id": 1, "t": 0}]), path)
    assert a.count() == 1
    b = append_idempotent(tx_rows(spark, [{"id": 1, "t": 0}, {"id": 2, "t": 5}, {"id": 2, "t": 5}]), path)
    assert b.count() == 1
    assert sorted(r[0] for r in spark.read.parquet(path).select("transaction_id").collect()) == ["1", "2"]


def test_decode_json_flags_bad_rows(spark):
    wire = to_wire_json(tx_rows(spark, [{"id": 1, "t": 0}])).first().value
    df = spark.createDataFrame([(wire,), ("{not json",), ('{"transaction_id": "x"}',)], "value string")
    rows = decode_json(df).collect()
    assert rows[0].is_valid and rows[0].timestamp is not None
    assert not rows[1].is_valid and not rows[2].is_valid and rows[2].transaction_id == "x"


def test_mixed_timestamp_precision(spark):
    df = spark.createDataFrame([('{"transaction_id":"1","timestamp":"2026-08-13T09:00:00+00:00"}',),
                                ('{"transaction_id":"2","timestamp":"2026-08-13T09:00:00.123456+00:00"}',)],
                               "value string")
    ts = [r.timestamp for r in decode_json(df).collect()]
    assert ts[0] is not None and ts[1] is not None and ts[1] > ts[0]


def test_normalize_and_keyed(spark):
    df = spark.createDataFrame([("A", 1)], "Transaction_ID string, AMOUNT int")
    assert normalize_columns(df).columns == ["transaction_id", "amount"]
    k = keyed_json(normalize_columns(df), "transaction_id").first()
    assert k.key == "A" and '"amount":1' in k.value


def test_latest_by_key_with_tombstone(spark):
    df = spark.createDataFrame([("T1", 1, "a", False), ("T1", 2, "b", False), ("T2", 1, "c", False),
                                ("T2", 2, None, True)], "k string, v int, name string, deleted boolean")
    rows = {r.k: r.name for r in latest_by_key(df, "k", "v", tombstone_col="deleted").collect()}
    assert rows == {"T1": "b"}


def test_gated_synthetic_reader(spark, scratch):
    from tillguard.schemas import FEATURE_COLUMNS
    from tillguard.sinks.tables import write_synthetic
    from tillguard.sources.events import read_gated_synthetic
    rows = spark.createDataFrame([(1.0, 0.0, 5.0, 0.0, 100.0, 1.0, 0)],
                                 ", ".join(f"{c} double" for c in FEATURE_COLUMNS) + ", is_fraud int")
    write_synthetic(rows, f"{scratch}/syn", FEATURE_COLUMNS + ["is_fraud"])
    ok = spark.createDataFrame([(True,)], "approved boolean")
    no = spark.createDataFrame([(False,)], "approved boolean")
    df, why = read_gated_synthetic(spark, f"{scratch}/syn", ok, enabled=False)
    assert df.count() == 0 and "not enabled" in why
    df, why = read_gated_synthetic(spark, f"{scratch}/syn", no, enabled=True)
    assert df.count() == 0 and "did not approve" in why
    df, why = read_gated_synthetic(spark, f"{scratch}/syn", ok, enabled=True)
    r = df.first()
    assert why == "approved" and r.amount_ngn == 100.0 and r.transaction_id is None


def test_overwrite_dates_replaces_only_its_dates(spark, scratch):
    from tillguard.sinks.tables import overwrite_dates
    a = tx_rows(spark, [{"id": 1, "t": 0}, {"id": 2, "t": 2 * 86400}])
    overwrite_dates(a, f"{scratch}/t")
    overwrite_dates(tx_rows(spark, [{"id": 3, "t": 10}]), f"{scratch}/t")
    ids = sorted(r[0] for r in spark.read.parquet(f"{scratch}/t").select("transaction_id").collect())
    assert ids == ["2", "3"]


def test_transactions_table_card_and_readers(spark, scratch):
    import json
    import os
    from tillguard.operators.profile import enforce_zero_jump
    from tillguard.sinks.tables import append_transactions, dataset_card
    from tillguard.sources.events import read_table, read_transactions, read_validation_results
    tx = tx_rows(spark, [{"id": 1, "t": 0}, {"id": 2, "t": 90000, "fraud_type": "cloned_card"}])
    append_transactions(tx, f"{scratch}/tx")
    back = read_table(spark, f"{scratch}/tx")
    assert back.count() == 2 and "event_date" in back.columns
    to_wire_json(tx).write.text(f"{scratch}/json")
    assert read_transactions(spark, f"{scratch}/json").filter("timestamp is not null").count() == 2
    card = {r.dataset: r for r in dataset_card(tx, tx.limit(1)).collect()}
    assert card["real"].n_rows == 2 and card["real"].fraud_rate == 0.5
    os.makedirs(scratch, exist_ok=True)
    with open(f"{scratch}/gate.json", "w") as fh:
        json.dump({"approved_for_training": True, "gate_failure_reasons": []}, fh, indent=2)
    assert read_validation_results(spark, f"{scratch}/gate.json").first().approved_for_training
    f = spark.createDataFrame([(2.0, 0.0, 1.0, 0.0, 1.0, 1.0, 0, 0), (1.0, 7.5, 1.0, 0.0, 1.0, 1.0, 1, 0)],
                              "velocity_1h double, geo_jump_km double, bin_spend_rate double, "
                              "terminal_reversal_count double, amount_ngn double, amount_vs_bin_avg_ratio double, "
                              "is_fraud int, has_geo_jump int")
    assert [r.geo_jump_km for r in enforce_zero_jump(f).collect()] == [0.0, 0.0]


def test_record_key_fills_missing_id(spark):
    df = spark.createDataFrame([("k1", '{"terminal_id":"T","merchant_id":"M","card_bin":"5","amount_ngn":1.0,'
                                       '"timestamp":"2026-08-13T09:00:00+00:00"}')], "key string, value string")
    r = decode_json(df, key_col="key").first()
    assert r.transaction_id == "k1" and r.is_valid


def test_written_gate_document_approves_and_names_its_reasons(spark, scratch):
    from tillguard.schemas import MODEL_FRAME_SCHEMA
    from tillguard.sources.events import gate_document, read_gated_synthetic, read_validation_results
    import os
    os.makedirs(scratch, exist_ok=True)
    for name, doc in (("yes", gate_document(True, [])), ("no", gate_document(False, ["level4: no results"]))):
        with open(f"{scratch}/{name}.json", "w") as fh:
            fh.write(doc)
    spark.range(1).select([F.lit(1).cast(f.dataType).alias(f.name) for f in MODEL_FRAME_SCHEMA.fields]).write.option("header", True).csv(f"{scratch}/rows")
    rows, why = read_gated_synthetic(spark, f"{scratch}/rows", read_validation_results(spark, f"{scratch}/yes.json"), True)
    assert why == "approved" and rows.count() == 1
    r = rows.first()
    assert r.transaction_id is None and r.terminal_id is None and r.card_bin is None
    rows, why = read_gated_synthetic(spark, f"{scratch}/rows", read_validation_results(spark, f"{scratch}/no.json"), True)
    assert rows.count() == 0 and "level4" in why


def test_overwrite_replaces_the_table_and_append_sees_other_dates(spark, scratch):
    from tillguard.sinks.tables import append_idempotent, overwrite_dates, overwrite_table
    rows = tx_rows(spark, [{"id": 1, "t": 0}, {"id": 2, "t": 3 * 86400}])
    overwrite_table(rows, f"{scratch}/full")
    overwrite_table(rows.filter("transaction_id = '1'"), f"{scratch}/full")
    assert [r.transaction_id for r in spark.read.parquet(f"{scratch}/full").collect()] == ["1"]
    overwrite_dates(rows.filter("transaction_id = '2'"), f"{scratch}/full")
    assert sorted(r.transaction_id for r in spark.read.parquet(f"{scratch}/full").collect()) == ["1", "2"]
    append_idempotent(tx_rows(spark, [{"id": 1, "t": 0}]), f"{scratch}/log")
    assert append_idempotent(tx_rows(spark, [{"id": 1, "t": 3 * 86400}]), f"{scratch}/log").count() == 0
    assert append_idempotent(tx_rows(spark, [{"id": 1, "t": 2 * 86400}]), f"{scratch}/log", replay_days=2).count() == 0
