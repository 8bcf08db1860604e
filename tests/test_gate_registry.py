import datetime as dt
import itertools
import json

import pytest
from pyspark.sql import functions as F

from test_ml import _frame
from tillguard.operators import validation as v
from tillguard.plans import registry
from tillguard.plans.training import train_classifier, training_pools
from tillguard.schemas import ALERT_SCHEMA, FEATURE_COLUMNS
from tillguard.sinks.tables import write_synthetic, write_validation_results
from tillguard.sources.events import read_gated_synthetic, read_validation_results


def _statistic(order, n1, n2):
    i = j = d = 0
    for first in order:
        i, j = i + first, j + (not first)
        d = max(d, abs(i * n2 - j * n1))
    return d


@pytest.mark.parametrize("n1,n2", [(1, 1), (3, 5), (4, 4), (8, 5), (8, 8), (2, 7)])
def test_exact_ks_p_value_equals_enumeration(n1, n2):
    seen = []
    for first in itertools.combinations(range(n1 + n2), n1):
        seen.append(_statistic([x in set(first) for x in range(n1 + n2)], n1, n2))
    for d in sorted(set(seen)):
        want = sum(x >= d for x in seen) / len(seen)
        assert v.ks_pvalue(d / (n1 * n2), n1, n2) == pytest.approx(want, abs=1e-12)
    assert v.ks_pvalue(0.0, n1, n2) == 1.0


def test_exact_and_asymptotic_p_values_meet():
    for d in (0.05, 0.08, 0.12):
        exact = v.ks_pvalue_exact(d, 480, 500)
        big = v.ks_pvalue(d, 4800, 5000)
        assert 0 <= big <= exact <= 1
    assert abs(v.ks_pvalue_exact(0.08, 480, 500) - v.ks_pvalue(0.08, 481, 521)) < 0.02  # 250,601 cells: asymptotic


def _samples(spark):
    real = _frame(spark, 300, 1)
    return real, _frame(spark, 300, 2)


def test_results_document_is_written_nested_and_read_back(spark, scratch):
    real, synth = _samples(spark)
    results = v.validate(real, synth, level4={"auc_gap": 0.01}, level5={"dnnr": 2.0})
    write_validation_results(v.results_document(results), f"{scratch}/doc")
    text = json.loads("".join(r.value for r in spark.read.text(f"{scratch}/doc").collect()))
    assert set(text) == {*v.DOCUMENT_LEVELS, "approved_for_training", "gate_failure_reasons"}
    for r in results.collect():
        got = text[r.level][r.column]["metrics"][r.metric]
        assert got == r.value or got == pytest.approx(r.value) or str(got) == str(r.value)
    assert text["level5"]["features"] == {"metrics": {"dnnr": 2.0}, "rating": "privacy_preserved", "passed": True}
    gate = v.approve(results).first()
    assert text["approved_for_training"] == gate.approved and text["gate_failure_reasons"] == gate.reasons
    write_synthetic(synth, f"{scratch}/synth", [*FEATURE_COLUMNS, "is_fraud"])
    back = read_validation_results(spark, f"{scratch}/doc")
    rows, reason = read_gated_synthetic(spark, f"{scratch}/synth", back, True)
    assert rows.count() == (300 if gate.approved else 0) and (gate.approved or gate.reasons[0] in reason)
    # without levels 4 and 5 the gate is closed whatever else passed
    write_validation_results(v.results_document(v.validate(real, real)), f"{scratch}/doc2")
    rows, reason = read_gated_synthetic(spark, f"{scratch}/synth", read_validation_results(spark, f"{scratch}/doc2"), True)
    assert rows.count() == 0 and "level4: no results" in reason


class _Lost(RuntimeError):
    pass


def test_a_driver_lost_between_steps_leaves_one_current_version(spark, scratch, monkeypatch):
    model = train_classifier(_frame(spark, 120), maxIter=2)
    root = f"{scratch}/models"
    assert registry.register_model(spark, model, root, "m") == 1
    create = registry._create

    def die_at(step):
        def lost(spark, path, content):
            if f"/{step}/" in path:
                raise _Lost
            return create(spark, path, content)
        return lost

    monkeypatch.setattr(registry, "_create", die_at("_pointer"))  # saved, not promoted
    with pytest.raises(_Lost):
        registry.register_model(spark, model, root, "m")
    monkeypatch.setattr(registry, "_create", create)
    assert registry.current_version(spark, root, "m") == 1

    class Broken:
        def write(self):
            raise _Lost
    with pytest.raises(_Lost):  # reserved, not saved
        registry.register_model(spark, Broken(), root, "m")
    assert registry.current_version(spark, root, "m") == 1
    fs, p = registry._fs(spark, f"{root}/m/_pointer/00000002")  # lost while the pointer was written
    fs.create(p, False).close()
    assert registry.current_version(spark, root, "m") == 1
    assert registry.register_model(spark, model, root, "m") == 4
    stages = {r.version: r.stage for r in registry.versions(spark, root).collect()}
    assert stages == {1: "Archived", 2: "None", 3: "None", 4: "Production"}
    assert registry.load_model(spark, root, "m") is not None


def test_promotion_is_compare_and_swap(spark, scratch):
    model = train_classifier(_frame(spark, 120), maxIter=2)
    for _ in range(2):
        registry.register_model(spark, model, scratch, "m")
    assert not registry.promote(spark, scratch, "m", 1, expected=1, swap=True)  # 2 is current
    assert registry.promote(spark, scratch, "m", 1, expected=2, swap=True) and registry.current_version(spark, scratch, "m") == 1
    assert not registry._create(spark, f"{scratch}/m/_pointer/00000003", {"version": 2})
    assert registry.register_model(spark, model, scratch, "m", stage="Staging") == 3
    assert registry.current_version(spark, scratch, "m") == 1
    with pytest.raises(LookupError):
        registry.load_model(spark, scratch, "other")


def test_alert_stream_reads_names_in_any_case(spark, scratch):
    from tillguard.streaming import read_alert_stream
    lines = ['{"ALERT_ID":"a","TRANSACTION_ID":"1","FRAUD_PROBABILITY":0.91,"ALERT_TIER":"critical","CREATED_AT":"2026-01-01T00:00:00Z","OTHER":1}',
             '{"alert_id":"b","transaction_id":"2","Fraud_Probability":"x"}', "not json", '{"alert_id":"c"}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{scratch}/events")
    q = (read_alert_stream(spark, path=f"{scratch}/events").writeStream.format("memory").queryName("alerts_read").trigger(availableNow=True)
         .option("checkpointLocation", f"{scratch}/ck").start())
    q.awaitTermination()
    rows = {r.alert_id: r for r in spark.sql("select * from alerts_read").collect()}
    assert set(rows) == {"a", "b"} and list(rows["a"].asDict()) == [f.name for f in ALERT_SCHEMA.fields]
    assert rows["a"].fraud_probability == 0.91 and rows["a"].created_at == dt.datetime(2026, 1, 1) and rows["b"].fraud_probability is None


def test_test_pool_holds_real_rows_only(spark):
    real, synth = _samples(spark)
    d = training_pools(real, synth.withColumn("transaction_id", F.lit(None).cast("string")))
    n = {(r.pool, r.origin): r["count"] for r in d.groupBy("pool", "origin").count().collect()}
    assert sum(n.values()) == 600 and ("test", "synthetic") not in n and abs(n["test", "real"] - 60) <= 1
    assert n["val", "synthetic"] > 0 and n["train", "synthetic"] > 0


def test_gate_runs_levels_4_and_5_at_the_same_time(spark, monkeypatch):
    import threading

    import numpy as np
    from tillguard.catalog import queries
    from tillguard.operators import nearest
    from tillguard.plans import training
    from tillguard.schemas import FEATURE_COLUMNS
    rows = np.random.default_rng(3).uniform(1, 2, (40, 6)).round(3).tolist()
    frame = spark.createDataFrame([(str(i), *r, i % 2) for i, r in enumerate(rows)],
                                  "transaction_id string, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS) + ", is_fraud int")
    both = threading.Barrier(2, timeout=60)
    monkeypatch.setattr(queries, "_real_synth", lambda *_: (frame, frame))
    monkeypatch.setattr(training, "tstr_vs_trtr", lambda *_: both.wait() * 0 or {"auc_gap": 0.01})
    monkeypatch.setattr(nearest, "dnnr", lambda *_: both.wait() * 0 or spark.createDataFrame([(2.0,)], "dnnr double"))
    got = {r.level: r.failed for r in queries.QUERIES["validation_gate"](spark, "").collect()}
    assert got["level4"] == got["level5"] == got["gate"] == 0
