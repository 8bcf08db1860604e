import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tillguard.plans import training
from tillguard.plans.ensemble import flatten_classifier
from tillguard.plans.isolation_forest import fit_isolation_forest

COLS = ["x", "y"]


def _rows(spark, n=3000):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=n).round(2), rng.integers(0, 5, n)
    label = ((x + y + rng.normal(size=n)) > 2.5).astype(int)
    return spark.createDataFrame([(float(a), float(b), int(c)) for a, b, c in zip(x, y, label)], "x double, y double, is_fraud int")


def test_fit_passes_over_binned_rows_and_predicts_as_over_rows(spark, monkeypatch):
    df, seen = _rows(spark), []
    made = training.classifier_pipeline

    def pipeline(*a, **kw):
        p = made(*a, **kw)
        fit = p.fit
        p.fit = lambda d: (seen.append(d.count()), fit(d))[1]
        return p

    monkeypatch.setattr(training, "classifier_pipeline", pipeline)
    model = training.train_classifier(df, COLS, maxIter=4)
    assert seen and seen[0] <= 32 * 5 * 2 < df.count()
    weighted, _ = training.with_class_weight(df)
    plain = Pipeline(stages=[VectorAssembler(inputCols=COLS, outputCol="features"), GBTClassifier(
        labelCol="is_fraud", weightCol="weight", **{**training.GBT_PARAMS, "maxIter": 4})]).fit(weighted)
    of = lambda m: {(r.x, r.y): r.probability_1 for r in training.predict_proba(m, df).distinct().collect()}
    a, b = of(model), of(plain)
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)
    flat = flatten_classifier(model, COLS, spark)
    keys = list(a)
    assert np.allclose(flat.probabilities(np.array(keys))[:, 0], [a[k] for k in keys], atol=1e-9)


def test_split_candidates_are_midpoints_or_near_equal_weights():
    assert training.split_candidates(np.array([1.0, 2.0, 2.0, 4.0]), np.ones(4)) == [1.5, 3.0]
    assert training.split_candidates(np.arange(8.0), np.ones(8), 4) == [1.5, 3.5, 5.5]
    assert training.split_candidates(np.array([5.0, 5.0]), np.ones(2)) == []


def test_forest_rows_walk_all_trees_at_once(spark):
    df = _rows(spark, 500)
    m = fit_isolation_forest(df, COLS, n_trees=10, sample_size=32)
    scored = m.transform(df)
    assert "MapInArrow" in scored._jdf.queryExecution().executedPlan().toString()
    tree = m.trees[0]
    flagged = scored.filter(F.col("raw_anomaly") == -1).count()
    assert len(tree) == 5 and scored.filter((F.col("anomaly_score") < m.offset) != (F.col("raw_anomaly") == -1)).count() == 0
    assert 0 < flagged <= 500 * 0.02 + 1
