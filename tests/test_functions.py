import math

from pyspark.sql import functions as F

from tillguard.functions import (amount_ratio_for_scoring, haversine_km, normalize_anomaly, tier_for_probability,
                                 tier_hex, tier_rgb)
from tillguard.functions.numeric import round_half_up
from tillguard.plans.scoring import blend_scores


def test_haversine(spark):
    df = spark.createDataFrame([(6.5244, 3.3792, 9.0765, 7.3986), (6.5244, 3.3792, 6.5244, 3.3792),
                                (None, 3.3792, 9.0765, 7.3986)], "a double, b double, c double, d double")
    r = df.select(haversine_km("a", "b", "c", "d").alias("x"), haversine_km("c", "d", "a", "b").alias("y")).collect()
    assert 400 < r[0].x < 600 and abs(r[0].x - r[0].y) < 1e-9
    assert r[1].x == 0.0
    assert r[2].x is None  # NULL input -> NULL, not the clamped 20,015 km


def test_tier_probes(spark):
    probes = [0.0, 0.1, 0.29, 0.3, 0.59, 0.6, 0.84, 0.85, 0.99]
    expect = ["low", "low", "low", "medium", "medium", "high", "high", "critical", "critical"]
    df = spark.createDataFrame([(p,) for p in probes] + [(float("nan"),), (None,), (-1.0,)], "p double")
    got = [r.t for r in df.select(tier_for_probability("p").alias("t")).collect()]
    assert got == expect + ["low", "low", "low"]


def test_ratio_guard(spark):
    df = spark.createDataFrame([(6000.0, 3000.0), (5000.0, 0.0), (5000.0, -1.0)], "a double, b double")
    assert [r.r for r in df.select(amount_ratio_for_scoring("a", "b").alias("r")).collect()] == [2.0, 0.0, 0.0]


def test_blend_tier_before_rounding(spark):
    df = spark.createDataFrame([("t1", 0.0, -1.0), ("t2", 1.0, -1.0), ("t3", 0.0, 1.0)],
                               "transaction_id string, xgboost_score double, raw_anomaly double")
    rows = {r.transaction_id: r for r in blend_scores(df).collect()}
    assert rows["t1"].alert_tier == "medium" and rows["t1"].fraud_probability == 0.3
    assert rows["t2"].alert_tier == "critical" and rows["t2"].fraud_probability == 1.0
    assert rows["t3"].alert_tier == "low" and rows["t3"].isolation_forest_score == 0.0


def test_normalize_anomaly_null(spark):
    df = spark.createDataFrame([(None,), (3.0,), (-3.0,)], "r double")
    assert [x.v for x in df.select(normalize_anomaly("r").alias("v")).collect()] == [None, 0.0, 1.0]


def test_round_half_up_matches_python_scaled(spark):
    vals = [0.00815, 0.89175, 1.23456789, -0.5, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r.x for r in df.select(round_half_up("v", 4).alias("x")).collect()]
    for v, g in zip(vals, got):
        if v is None:
            assert g is None
        elif math.isnan(v):
            assert math.isnan(g)
        else:
            assert g == math.floor(v * 10000.0 + 0.5) / 10000.0


def test_tier_colours(spark):
    df = spark.createDataFrame([("critical",), ("low",), (None,), ("bogus",)], "t string")
    r = df.select(tier_rgb("t").alias("rgb"), tier_hex("t").alias("hex")).collect()
    assert r[0].rgb == [214, 39, 40] and r[0].hex == "#d62728"
    assert r[1].rgb == [44, 160, 44]
    assert r[2].rgb == [128, 128, 128] and r[2].hex == "#808080"
    assert r[3].hex == "#808080"


def test_scorer_matches_blend_scores(spark):
    from tillguard.plans.scoring import Scorer, request_frame
    req = {"transaction_id": "t9", "amount_ngn": 180000.0, "bin_spend_rate": 145000.0, "xgboost_score": 0.9,
           "raw_anomaly": -1.0}
    a = Scorer().score(request_frame(spark, req)).first()
    b = blend_scores(request_frame(spark, req)).first()
    assert (a.fraud_probability, a.alert_tier) == (b.fraud_probability, b.alert_tier) == (0.93, "critical")
