import random

from pyspark.sql import functions as F

from tillguard.plans import registry
from tillguard.plans.isolation_forest import fit_isolation_forest
from tillguard.plans.training import (cross_validate, feature_importance, fold_column, predict_proba,
                                      stratified_split, train_classifier)
from tillguard.schemas import FEATURE_COLUMNS


def _frame(spark, n=400, seed=11):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(rnd.random() < 0.2)
        rows.append((str(i), float(rnd.randint(1, 3) + 3 * y), rnd.random() * (5 + 50 * y), rnd.random() * 100,
                     float(rnd.randint(0, 1) + y), rnd.random() * 1000 * (1 + y), rnd.random() * (1 + 2 * y), y))
    schema = "transaction_id string, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS) + ", is_fraud int"
    return spark.createDataFrame(rows, schema)


def test_stratified_split_exact_counts(spark):
    df = _frame(spark)
    s = stratified_split(df, "is_fraud", 0.2)
    n = {(r.is_fraud, r.is_test): r["count"] for r in s.groupBy("is_fraud", "is_test").count().collect()}
    for y in (0, 1):
        total = n.get((y, True), 0) + n.get((y, False), 0)
        assert n.get((y, True), 0) == int(total * 0.2 + 0.5)
    again = stratified_split(df, "is_fraud", 0.2).filter("is_test").select("transaction_id")
    assert again.exceptAll(s.filter("is_test").select("transaction_id")).count() == 0  # deterministic


def test_folds_are_stratified(spark):
    f = fold_column(_frame(spark), "is_fraud", 5)
    counts = [r["count"] for r in f.filter("is_fraud = 1").groupBy("fold").count().collect()]
    assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_classifier_cv_registry(spark, scratch):
    df = _frame(spark)
    model = train_classifier(df, maxIter=5)
    p = predict_proba(model, df)
    assert p.filter((F.col("probability_1") < 0) | (F.col("probability_1") > 1)).count() == 0
    cv = cross_validate(df, k=3, maxIter=3)
    assert cv["cv_n_splits"] == 3 and 0 <= cv["cv_f1_mean"] <= 1
    v1 = registry.register_model(spark, model, scratch, "m")
    v2 = registry.register_model(spark, model, scratch, "m")
    assert (v1, v2) == (1, 2)
    stages = {r.version: r.stage for r in registry.versions(spark, scratch).collect()}
    assert stages == {1: "Archived", 2: "Production"}
    loaded = registry.load_model(spark, scratch, "m")
    assert [r.feature for r in feature_importance(loaded).collect()] != []


def test_isolation_forest(spark):
    df = _frame(spark, 600)
    m = fit_isolation_forest(df.filter("is_fraud = 0"), n_trees=20, sample_size=64)
    sc = m.transform(df)
    assert len(m.trees) == 20
    flagged = sc.filter("raw_anomaly = -1").count()
    assert 0 < flagged < 600
    mean_fraud = sc.filter("is_fraud = 1").agg(F.avg("anomaly_score")).first()[0]
    mean_ok = sc.filter("is_fraud = 0").agg(F.avg("anomaly_score")).first()[0]
    assert mean_fraud < mean_ok  # frauds look more anomalous (lower score)


def test_grid_sweep_and_score_features(spark):
    from tillguard.plans.scoring import score_features, ModelsNotReadyError
    from tillguard.plans.training import grid_sweep
    df = _frame(spark, 300)
    g = grid_sweep(df, {"maxDepth": [2, 3], "maxIter": [2]}, k=2).collect()
    assert len(g) == 2 and g[0].mean_average_precision >= g[1].mean_average_precision
    clf = train_classifier(df, maxIter=3)
    forest = fit_isolation_forest(df.filter("is_fraud = 0"), n_trees=10, sample_size=32)
    feats = df.drop("amount_vs_bin_avg_ratio")
    scored = score_features(feats, clf, forest).collect()
    assert len(scored) == 300 and {r.alert_tier for r in scored} <= {"low", "medium", "high", "critical"}
    assert all(0.0 <= r.fraud_probability <= 1.0 for r in scored)
    try:
        score_features(feats, None, forest)
        raise AssertionError("expected ModelsNotReadyError")
    except ModelsNotReadyError:
        pass


def test_split_and_folds_of_rows_without_ids(spark):
    from pyspark.sql import functions as F
    from tillguard.plans.training import fold_column, stratified_split
    df = spark.range(200).select(F.lit(None).cast("string").alias("transaction_id"), (F.col("id") % 100).cast("double").alias("x"),
                                 (F.col("id") % 2 == 0).alias("is_fraud"))
    s = stratified_split(df, "is_fraud", 0.2)
    assert {(r.is_fraud, r.n) for r in s.filter("is_test").groupBy("is_fraud").agg(F.count("*").alias("n")).collect()} == {(True, 20), (False, 20)}
    assert s.count() == 200
    sizes = {r.n for r in fold_column(df, "is_fraud", 5).groupBy("is_fraud", "fold").agg(F.count("*").alias("n")).collect()}
    assert sizes == {20}


def test_isolation_forest_has_every_tree_whatever_the_repeats(spark):
    from pyspark.sql import functions as F
    from tillguard.plans.isolation_forest import fit_isolation_forest
    df = spark.range(5).select(F.lit(1.0).alias("x"))
    m = fit_isolation_forest(df, ["x"], n_trees=20)
    assert len(m.trees) == 20
    df = spark.range(3000).select(F.when(F.col("id") < 2000, 1.0).otherwise(F.col("id").cast("double")).alias("x"))
    m = fit_isolation_forest(df, ["x"], n_trees=10, sample_size=64)
    assert [t[4][0] for t in m.trees] == [64] * 10 or all(max(t[4]) <= 64 for t in m.trees) and len(m.trees) == 10
