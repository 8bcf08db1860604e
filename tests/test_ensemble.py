import json
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_ml import _frame
from tillguard.plans.ensemble import (PARAM_GRID, BoostedTrees, FittedScorer, flatten_classifier, flatten_forest, staged_sweep)
from tillguard.plans.isolation_forest import fit_isolation_forest
from tillguard.plans.scoring import ModelsNotReadyError, score_features
from tillguard.plans.training import grid_sweep, predict_proba, train_classifier
from tillguard.schemas import FEATURE_COLUMNS


@pytest.fixture(scope="module")
def fitted(spark):
    df = _frame(spark, 500).withColumn("timestamp", F.lit("2026-01-01").cast("timestamp"))
    return df, train_classifier(df, maxIter=12), fit_isolation_forest(df.filter("is_fraud = 0"), n_trees=25, sample_size=64)


def _odd(df):
    """Rows with nulls and NaN, for both models."""
    return df.unionByName(df.limit(20).withColumn("velocity_1h", F.lit(None).cast("double"))
                          .withColumn("transaction_id", F.concat(F.lit("n"), "transaction_id"))) \
             .unionByName(df.limit(20).withColumn("geo_jump_km", F.lit(float("nan"))).withColumn("transaction_id", F.concat(F.lit("m"), "transaction_id")))


def test_flat_models_equal_the_fitted_ones(fitted):
    df, gbt, forest = fitted
    rows = _odd(df)
    flat, trees = flatten_classifier(gbt), flatten_forest(forest)
    got = {r.transaction_id: r for r in FittedScorer(flat, trees).outputs(rows.drop("amount_vs_bin_avg_ratio")).collect()}
    from tillguard.plans.scoring import with_scoring_ratio
    want = predict_proba(gbt, forest.transform(with_scoring_ratio(rows))).collect()
    assert len(got) == len(want) == 540
    for w in want:
        assert got[w.transaction_id].xgboost_score == pytest.approx(w.probability_1, abs=1e-12)
        assert got[w.transaction_id].raw_anomaly == w.raw_anomaly


def test_batch_stream_and_request_give_one_score(spark, fitted, scratch):
    df, gbt, forest = fitted
    scorer = FittedScorer(flatten_classifier(gbt), flatten_forest(forest))
    batch = {r.transaction_id: r.asDict() for r in scorer.score(df, scored_at="timestamp").collect()}
    old = {r.transaction_id: r.asDict() for r in score_features(df, gbt, forest).collect()}
    for k, b in batch.items():
        assert all(b[c] == old[k][c] for c in ("fraud_probability", "alert_tier", "xgboost_score", "isolation_forest_score"))
    assert len({b["alert_tier"] for b in batch.values()}) > 1
    df.write.parquet(f"{scratch}/features")
    from tillguard.streaming import run_score_stream
    run_score_stream(spark.readStream.schema(df.schema).parquet(f"{scratch}/features"), f"{scratch}/scores", f"{scratch}/ckpt",
                     lambda d: scorer.score(d, scored_at="timestamp")).awaitTermination()
    stream = {r.transaction_id: r.asDict() for r in spark.read.parquet(f"{scratch}/scores").drop("event_date").collect()}
    assert stream == batch
    for r in df.limit(60).collect():
        one = scorer.score_request(r.asDict())
        assert all(one[c] == batch[r.transaction_id][c] for c in one)


def test_request_needs_no_job_and_takes_missing_values(fitted):
    _, gbt, forest = fitted
    scorer = FittedScorer(flatten_classifier(gbt), flatten_forest(forest))
    t0 = time.time()
    for _ in range(50):
        one = scorer.score_request({"transaction_id": "a", "amount_ngn": 10.0, "bin_spend_rate": 0.0})
    assert time.time() - t0 < 5 and one["alert_tier"] in ("low", "medium", "high", "critical")
    with pytest.raises(ModelsNotReadyError):
        FittedScorer(None, None)


def test_margins_of_fewer_trees_are_those_of_a_shorter_fit(spark, fitted):
    df, gbt, _ = fitted
    x = np.array([[float(r[c]) for c in FEATURE_COLUMNS] for r in df.orderBy("transaction_id").collect()])
    long, short = flatten_classifier(gbt), flatten_classifier(train_classifier(df, maxIter=5))
    assert isinstance(long, BoostedTrees)
    assert np.allclose(long.probabilities(x, [5]), short.probabilities(x), atol=1e-12)


def test_staged_sweep_equals_separate_fits(spark):
    df = _frame(spark, 300)
    grid = {"maxDepth": [2, 3], "stepSize": [0.1], "maxIter": [2, 6]}
    got = {r.params: r for r in staged_sweep(df, grid, k=2).collect()}
    want = {json.dumps(json.loads(r.params), sort_keys=True): r for r in grid_sweep(df, grid, k=2).collect()}
    assert set(got) == set(want) and len(got) == 4
    for k, w in want.items():
        assert got[k].mean_average_precision == pytest.approx(w.mean_average_precision, abs=1e-9)
        assert got[k].mean_f1 == pytest.approx(w.mean_f1, abs=1e-9)
    assert np.prod([len(v) for v in PARAM_GRID.values()]) == 36
