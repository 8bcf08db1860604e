import numpy as np
from pyspark.sql import functions as F

from helpers import tx_rows
from tillguard.sinks import key_index
from tillguard.sinks.tables import append_idempotent


def _batch(spark, lo, hi, day=0):
    return tx_rows(spark, [{"id": i, "t": day * 86400 + i} for i in range(lo, hi)])


def test_appends_with_a_sidecar_equal_those_without(spark, scratch):
    batches = [_batch(spark, 0, 300), _batch(spark, 200, 500, 1), _batch(spark, 450, 600, 2), _batch(spark, 0, 100, 9), _batch(spark, 600, 601).limit(0)]
    for b in batches:
        n = append_idempotent(b, f"{scratch}/a", sidecar=True).count()
        assert n == append_idempotent(b, f"{scratch}/b").count()
    a = spark.read.parquet(f"{scratch}/a")
    assert a.count() == 600 == a.select("transaction_id").distinct().count()
    assert sorted(r[0] for r in a.select("transaction_id").collect()) == sorted(r[0] for r in spark.read.parquet(f"{scratch}/b").select("transaction_id").collect())


def test_few_groups_are_read_and_none_is_missed(spark, scratch):
    for day in range(8):
        append_idempotent(_batch(spark, day * 400, day * 400 + 400, day), scratch, sidecar=True)
    filters = key_index.read_filters(spark, scratch)
    assert filters.select(key_index.GROUP).distinct().count() == 8
    fresh = key_index.groups_that_may_hold(_batch(spark, 10_000, 10_050), filters, "transaction_id").count()
    assert fresh <= 2  # false positives are rare
    hits = key_index.groups_that_may_hold(_batch(spark, 1200, 1210), filters, "transaction_id").collect()
    held = {r[0] for r in spark.read.parquet(scratch).filter(F.col("transaction_id").isin([str(i) for i in range(1200, 1210)])).select(key_index.GROUP).collect()}
    assert held <= {r[key_index.GROUP] for r in hits} and len(hits) <= 3


def test_false_positives_change_nothing(spark, scratch, monkeypatch):
    append_idempotent(_batch(spark, 0, 200), scratch, sidecar=True)
    real = key_index.read_filters  # from here on filters that say yes to every key
    monkeypatch.setattr(key_index, "read_filters", lambda spark, path: real(spark, path).withColumn("bits", F.unhex(F.lit("FF" * 8))))
    assert append_idempotent(_batch(spark, 150, 260), scratch, sidecar=True).count() == 60
    assert spark.read.parquet(scratch).count() == 260


def test_filters_hold_every_key():
    r = np.random.default_rng(1)
    h1, h2 = r.integers(-2**63, 2**63 - 1, (2, 5000))
    bits = np.zeros(1 << 17, bool)
    bits[key_index._places(h1, h2, 1 << 17).ravel()] = True
    assert bits[key_index._places(h1, h2, 1 << 17)].all()
    other = r.integers(-2**63, 2**63 - 1, (2, 20000))
    assert bits[key_index._places(*other, 1 << 17)].all(axis=1).mean() < 0.001
