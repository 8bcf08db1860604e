import datetime as dt

from pyspark.sql import functions as F

from tillguard.operators import marts
from tillguard.plans.alerts import build_alerts
from tillguard.schemas import ALERT_SCHEMA, MERCHANT_SCHEMA, TERMINAL_SCHEMA
from tillguard.sinks.tables import fill_alert_defaults
from helpers import T0, tx_rows


def _alerts(spark):
    rows = [
        ("a1", "t1", "TRM1", "MRC1", "539983", 0.93, "critical", "Lagos", dt.datetime(2026, 8, 1, 9, 5)),
        ("a2", "t2", "TRM1", "MRC1", "539983", 0.67, "high", "Lagos", dt.datetime(2026, 8, 3, 9, 30)),
        ("a3", "t3", "TRM3", "MRC3", "539983", 0.80, "high", "Kano", dt.datetime(2026, 8, 5, 14, 0)),
        ("a4", "t4", "TRM4", "MRC4", "539990", 0.35, "medium", "", dt.datetime(2026, 8, 9, 9, 0)),
    ]
    return spark.createDataFrame(rows, ALERT_SCHEMA)


def test_filters(spark):
    a = _alerts(spark)
    assert marts.filter_alerts(a, tiers=["critical"]).count() == 1
    assert marts.filter_alerts(a, states=["Lagos"]).count() == 2
    got = marts.filter_alerts(a, date_range=("2026-08-01", "2026-08-05")).select("terminal_id").distinct()
    assert sorted(r[0] for r in got.collect()) == ["TRM1", "TRM3"]
    assert marts.filter_alerts(a, tiers=[], states=None).count() == 4


def test_counts_and_tops(spark):
    a = _alerts(spark)
    tc = {r.alert_tier: r.alert_count for r in marts.tier_counts(a).collect()}
    assert tc == {"critical": 1, "high": 2, "medium": 1, "low": 0}
    assert marts.top_terminals(a).first().asDict() == {"terminal_id": "TRM1", "alert_count": 2}
    assert [r.state for r in marts.top_states(a).collect()] == ["Lagos", "Kano"]
    bins = marts.top_bins_by_avg_probability(a).collect()
    assert bins[0].card_bin == "539983" and abs(bins[0].avg_fraud_probability - 0.8) < 1e-9
    hours = {r.hour: r.alert_count for r in marts.alerts_by_hour(a).collect()}
    assert len(hours) == 24 and hours[9] == 3 and hours[14] == 1 and hours[0] == 0
    k = marts.alert_kpis(a).first()
    assert (k.total_alerts, k.critical, k.high, k.medium) == (4, 1, 2, 1)


def test_terminal_status_and_at_risk(spark):
    a = _alerts(spark).filter(F.col("terminal_id") == "TRM1")
    terms = spark.createDataFrame([("TRM1", "Term one", "MRC1", "Lagos", "Ikeja", 6.5, 3.3, "op", True),
                                   ("TRM2", "Term two", "MRC2", "Kano", "Nasarawa", 12.0, 8.5, "op", True)],
                                  TERMINAL_SCHEMA)
    merch = spark.createDataFrame([("MRC1", "Merchant one", "retail", "Lagos", "Ikeja", None, False)],
                                  MERCHANT_SCHEMA)
    st = {r.terminal_id: r for r in marts.terminal_status(terms, a, merch).collect()}
    assert st["TRM1"].alert_count == 2 and st["TRM1"].fraud_probability_pct == 93.0
    assert st["TRM1"].tier == "critical" and st["TRM1"].flagged and st["TRM1"].color == [214, 39, 40]
    assert st["TRM2"].merchant_name == "MRC2" and st["TRM2"].alert_count == 0 and st["TRM2"].tier_label == "none"
    ms = marts.map_summary(marts.terminal_status(terms, a, merch)).first()
    assert ms.flagged_terminals == 1 and ms.total_terminals == 2
    top = marts.top_at_risk_terminals(_alerts(spark), terms).collect()
    assert top[0].terminal_id == "TRM1" and top[0].fraud_probability == 0.93 and top[0].terminal_name == "Term one"
    assert [r.terminal_name for r in top if r.terminal_id == "TRM3"] == ["TRM3"]  # unknown terminal -> id


def test_facets(spark):
    f = marts.filter_facets(_alerts(spark)).first()
    assert f.tiers == ["critical", "high", "medium"] and f.states == ["Kano", "Lagos"]
    assert str(f.min_date) == "2026-08-01" and str(f.max_date) == "2026-08-09"


def test_build_alerts_left_joins_and_window(spark):
    tx = tx_rows(spark, [{"id": 1, "t": 0, "merchant": "MRC9"}, {"id": 2, "t": 0}, {"id": 3, "t": 0}])
    scores = spark.createDataFrame(
        [("1", 0.9, "critical", T0 + dt.timedelta(minutes=59)), ("2", 0.9, "critical", T0 + dt.timedelta(minutes=61)),
         ("3", 0.1, "low", T0)], "transaction_id string, fraud_probability double, alert_tier string, scored_at timestamp")
    terms = spark.createDataFrame([("TRM00001", "T", "MRC0001", "Lagos", "x", 1.0, 1.0, "op", True)], TERMINAL_SCHEMA)
    merch = spark.createDataFrame([("MRC0001", "M", "c", "Lagos", "x", None, False)], MERCHANT_SCHEMA)
    rows = build_alerts(scores, tx, terms, merch).collect()
    assert len(rows) == 1  # 61 minutes is outside the join window, low tier is filtered
    assert rows[0].merchant_id == "MRC9" and rows[0].merchant_name is None and rows[0].terminal_name == "T"


def test_alert_defaults(spark):
    df = spark.createDataFrame([("t1", "TRM1", 0.5, "medium")],
                               "transaction_id string, terminal_id string, fraud_probability double, alert_tier string")
    r = fill_alert_defaults(df).first()
    assert r.merchant_id is None and r.alert_id and r.created_at is not None
