"""Classifier training and evaluation on DataFrames (ML-1..10, ML-15, VAL-6).

Boosted trees are MLlib's ``GBTClassifier`` with the reference's
hyper-parameters (200 rounds, depth 4, step 0.05, seed 42) and the
negative/positive ratio as the weight of positive rows.  Metrics come from
``operators.metrics`` (distributed, exact).

Trees see a feature only through the bin between two split candidates in which
it lies.  So a fit bins the features first (MLlib's ``Bucketizer``) and sums the
weights of rows with the same bins and label: each of the hundreds of passes of
a fit then reads one row for each of these, at most one for each row given.
"""

from __future__ import annotations

import json
import math
from typing import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillguard.operators import metrics
from tillguard.operators.cumulative import running_totals
from tillguard.operators.validation import auc_gap_verdict
from tillguard.schemas import FEATURE_COLUMNS

# Classifier hyper-parameters chosen by the reference's sweep.
GBT_PARAMS = {"maxIter": 200, "maxDepth": 4, "stepSize": 0.05, "seed": 42}
SEED = 42


def hash_key(id_col: str, seed: int = SEED):
    return F.xxhash64(F.col(id_col).cast("string"), F.lit(seed))


def _row_hash(df: DataFrame, id_col: str, seed: int):
    """Hash of the id; of all columns where the id is NULL or there is none
    (synthetic rows have no ids), so that such rows don't share one hash."""
    every = F.xxhash64(*[F.col(c) for c in df.columns], F.lit(seed))
    return F.when(F.col(id_col).isNull(), every).otherwise(hash_key(id_col, seed)) if id_col in df.columns else every


def _class_position(df: DataFrame, label: str, id_col: str, seed: int) -> DataFrame:
    """Adds ``_pos``, each row's place (from 1) in its class's hash order, and
    ``_tot``, the size of its class.  Rows of equal hash are numbered by all
    their columns, so that a plan that runs twice numbers them alike."""
    d = df.withColumn("_h", _row_hash(df, id_col, seed))
    counts = d.groupBy(label, "_h").agg(F.count(F.lit(1)).alias("n"))
    cum = running_totals(counts, "_h", ["n"], group=label).select(
        F.col(label).alias("_l"), F.col("_h").alias("_g"), (F.col("cum_n") - F.col("n")).alias("_before"), F.col("tot_n").alias("_tot"))
    rank = F.row_number().over(Window.partitionBy(label, "_h").orderBy(*[F.col(c) for c in df.columns]))
    return (d.join(cum, F.col(label).eqNullSafe(F.col("_l")) & (F.col("_h") == F.col("_g")))
             .withColumn("_pos", F.col("_before") + rank).drop("_l", "_g", "_h", "_before"))


def stratified_split(df: DataFrame, label: str, test_frac: float, *, id_col: str = "transaction_id",
                     seed: int = SEED, out: str = "is_test") -> DataFrame:
    """ML-1: per class exactly round(test_frac * n_class) rows marked test
    (half up), chosen by a seeded hash of the id: running counts per class,
    no global sort, no driver round trip.  Rows without an id use a hash of
    all columns."""
    d = _class_position(df, label, id_col, seed)
    return d.withColumn(out, F.col("_pos") <= F.round(F.col("_tot") * F.lit(float(test_frac)))).drop("_pos", "_tot")


def fold_column(df: DataFrame, label: str, k: int = 5, *, id_col: str = "transaction_id", seed: int = SEED,
                out: str = "fold") -> DataFrame:
    """ML-3 folds: stratified, fold = (hash rank within class) mod k."""
    d = _class_position(df, label, id_col, seed)
    return d.withColumn(out, ((F.col("_pos") - 1) % k).cast("int")).drop("_pos", "_tot")


def with_class_weight(df: DataFrame, label: str = "is_fraud", out: str = "weight") -> tuple[DataFrame, float]:
    """Weight positives by negatives/positives (1.0 without positives)."""
    c = df.agg(F.sum(F.col(label).cast("long")).alias("p"), F.count(F.lit(1)).alias("n")).first()
    pos, n = (c["p"] or 0), c["n"]
    spw = (n - pos) / pos if pos else 1.0
    return df.withColumn(out, F.when(F.col(label).cast("int") == 1, F.lit(float(spw))).otherwise(F.lit(1.0))), spw


#: Bins of a feature, and rows (about) of which more than that choose their bins.
MAX_BINS, SPLIT_ROWS = 32, 100_000
#: Rows of a partition that a fit passes over.
FIT_ROWS = 25_000


def bin_name(feature: str) -> str:
    return f"_bin_{feature}"


def split_candidates(values: np.ndarray, weights: np.ndarray, max_bins: int = MAX_BINS) -> list[float]:
    """Up to ``max_bins - 1`` split candidates of a feature: midpoints between
    all its distinct values, or those nearest to equal weights."""
    distinct, at = np.unique(values, return_inverse=True)  # NaN last
    held = np.bincount(at.ravel(), weights, len(distinct))
    mid = [float(m) for m in (distinct[:-1] + distinct[1:]) / 2.0]
    if len(mid) >= max_bins:
        upto, stride, kept = np.cumsum(held), float(held.sum()) / max_bins, []
        for i, m in enumerate(mid):
            target = stride * (len(kept) + 1)
            if abs(upto[i] - target) < abs(upto[i + 1] - target):
                kept.append(m)
        mid = kept
    return sorted({m for m in mid if math.isfinite(m)})


def feature_bins(df: DataFrame, features: Sequence[str], weight: str = "weight", seed: int = SEED) -> Bucketizer:
    """Bins of the features by the split candidates of a bounded sample of
    rows, as MLlib's trees choose theirs; all rows when they are few."""
    n = df.count()
    sample = df.select(*features, weight)
    if n > SPLIT_ROWS:
        sample = sample.sample(False, SPLIT_ROWS / n, seed).limit(2 * SPLIT_ROWS)
    held = sample.toPandas()
    w = held[weight].to_numpy(dtype=float)
    splits = []
    for f in features:
        cuts = split_candidates(held[f].to_numpy(dtype=float), w, max(2, min(MAX_BINS, n)))
        # a tree's left side holds its threshold, a bucket its lower bound
        splits.append([-math.inf, *[float(np.nextafter(c, math.inf)) for c in cuts or [0.0]], math.inf])
    return Bucketizer(inputCols=list(features), outputCols=[bin_name(f) for f in features], splitsArray=splits, handleInvalid="keep")


def classifier_pipeline(features: Sequence[str] = FEATURE_COLUMNS, label: str = "is_fraud", **params) -> Pipeline:
    """Boosted trees over the bins of the features."""
    # every bin is a split candidate: room for all rows when MLlib looks for them
    p = {**GBT_PARAMS, "maxBins": 1024, **params}
    assembler = VectorAssembler(inputCols=[bin_name(f) for f in features], outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(featuresCol="features", labelCol=label, weightCol="weight", **p)
    return Pipeline(stages=[assembler, gbt])


def train_classifier(df: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, label: str = "is_fraud",
                     **params) -> PipelineModel:
    """ML-2."""
    from tillguard.session import materialize
    d = materialize(df.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("double").alias(label)))
    d, _ = with_class_weight(d, label)
    bins = feature_bins(d, features)
    names, nan = bins.getOutputCols(), [len(s) - 1.0 for s in bins.getSplitsArray()]
    # a fit refuses NULL and NaN (its bin is one beyond the last), as MLlib does
    binned = bins.transform(d).select(label, "weight", *[F.when(F.col(c) < at, F.col(c)).alias(c) for c, at in zip(names, nan)])
    groups = materialize(binned.groupBy(label, *names).agg(F.sum("weight").alias("weight")))
    n = groups.count()
    groups = groups.repartition(max(1, math.ceil(n / FIT_ROWS)))
    return PipelineModel([bins, *classifier_pipeline(features, label, **params).fit(groups).stages])


#: concurrent fits (each persists its own training input while it runs)
FIT_PARALLELISM = 2


def _fit_concurrently(frames: Sequence[DataFrame], features, label, params,
                      parallelism: int = FIT_PARALLELISM) -> list[PipelineModel]:
    """Independent fits submitted from at most ``parallelism`` driver threads."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(frames)))) as pool:
        futures = [pool.submit(train_classifier, f, features, label, **params) for f in frames]
        return [f.result() for f in futures]


def positive_probability(pred: DataFrame, out: str = "probability_1") -> DataFrame:
    bins = [c for c in pred.columns if c.startswith(bin_name(""))]
    return pred.withColumn(out, vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability",
                                                                      "prediction", *bins)


def predict_proba(model: PipelineModel, df: DataFrame, out: str = "probability_1") -> DataFrame:
    return positive_probability(model.transform(df), out)


def cross_validate(df: DataFrame, k: int = 5, features: Sequence[str] = FEATURE_COLUMNS, label: str = "is_fraud",
                   **params) -> dict:
    """ML-3: stratified k-fold; mean precision/recall/F1 at 0.5 and mean AUC
    over folds that contain both classes."""
    d = fold_column(df, label, k)
    rows = []
    models = _fit_concurrently([d.filter(F.col("fold") != f) for f in range(k)], features, label, params)
    for f, m in enumerate(models):
        test = d.filter(F.col("fold") == f)
        p = predict_proba(m, test)
        bm = metrics.binary_metrics(p, "probability_1", label, 0.5).first()
        auc = metrics.roc_auc(p, "probability_1", label).first()["roc_auc"]
        rows.append((bm["precision"], bm["recall"], bm["f1"], auc))
    aucs = [r[3] for r in rows if r[3] is not None]
    mean = lambda xs: sum(xs) / len(xs) if xs else float("nan")
    return {"cv_precision_mean": mean([r[0] for r in rows]), "cv_recall_mean": mean([r[1] for r in rows]),
            "cv_f1_mean": mean([r[2] for r in rows]), "cv_roc_auc_mean": mean(aucs),
            "cv_folds_with_both_classes": len(aucs), "cv_n_splits": k}


def training_pools(real: DataFrame, synthetic: DataFrame | None = None, label: str = "is_fraud") -> DataFrame:
    """SET-1 / ML-5: every row with its ``pool``: ``test`` is 20 % of the real
    rows; synthetic rows join the others, of which 20 % are ``val`` and the
    rest ``train``.  ``origin`` says where a row is from."""
    from tillguard.session import materialize
    # both splits read it several times
    r = materialize(stratified_split(real, label, 0.2, out="_test").withColumn("origin", F.lit("real")))
    pool = r.filter(~F.col("_test")).drop("_test")
    if synthetic is not None:
        s = synthetic.withColumn("origin", F.lit("synthetic"))
        pool = pool.unionByName(s.select(*pool.columns))
    tv = stratified_split(pool, label, 0.2, out="_val")
    return tv.withColumn("pool", F.when(F.col("_val"), F.lit("val")).otherwise(F.lit("train"))).drop("_val").unionByName(
        r.filter("_test").drop("_test").withColumn("pool", F.lit("test")))


def train_with_holdout(real: DataFrame, synthetic: DataFrame | None = None, features: Sequence[str] = FEATURE_COLUMNS,
                       label: str = "is_fraud", **params) -> tuple[PipelineModel, DataFrame]:
    """ML-5: 20 % real-only test split first; synthetic rows join only the
    train/val pool; threshold picked on a 20 % validation split; final model
    refit on train+val; report at 0.5 and at the tuned threshold.

    Returns (final model, long-form metrics ``metric, value``)."""
    from tillguard.session import materialize
    d = materialize(training_pools(materialize(real), synthetic, label))
    trainval, test = d.filter(F.col("pool") != "test"), d.filter(F.col("pool") == "test")
    train, val = d.filter(F.col("pool") == "train"), d.filter(F.col("pool") == "val")
    # the threshold model and the final model are independent fits: run them
    # as concurrent Spark jobs (as CrossValidator's ``parallelism`` does)
    m_thr, model = _fit_concurrently([train, trainval], features, label, params)
    thr = metrics.best_threshold(materialize(predict_proba(m_thr, val).select("probability_1", label)), "probability_1", label).first()["threshold"]
    p = materialize(predict_proba(model, test).select("probability_1", label))
    out = []
    for name, t in (("default", 0.5), ("tuned", float(thr))):
        bm = metrics.binary_metrics(p, "probability_1", label, t).first()
        out += [(f"{name}_threshold", t), (f"{name}_precision", bm["precision"]), (f"{name}_recall", bm["recall"]),
                (f"{name}_f1", bm["f1"])]
    out.append(("holdout_roc_auc", metrics.roc_auc(p, "probability_1", label).first()["roc_auc"]))
    out.append(("holdout_average_precision",
                metrics.average_precision(p, "probability_1", label).first()["average_precision"]))
    spark = real.sparkSession
    return model, spark.createDataFrame([(k, None if v is None else float(v)) for k, v in out],
                                        "metric string, value double")


def feature_importance(model: PipelineModel, features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """ML-10: importance per feature, descending (one row per feature)."""
    from pyspark.sql import SparkSession
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return SparkSession.getActiveSession().createDataFrame(list(zip(features, [float(x) for x in imp])), "feature string, importance double") \
        .orderBy(F.desc("importance"), "feature")


def grid_sweep(df: DataFrame, grid: dict[str, Sequence], k: int = 5, features: Sequence[str] = FEATURE_COLUMNS,
               label: str = "is_fraud") -> DataFrame:
    """ML-9: k-fold mean average precision and F1@0.5 per parameter combo,
    sorted by AP descending."""
    import itertools
    d = fold_column(df, label, k).cache()
    keys = list(grid)
    rows = []
    for combo in itertools.product(*[grid[x] for x in keys]):
        params = dict(zip(keys, combo))
        aps, f1s = [], []
        models = _fit_concurrently([d.filter(F.col("fold") != f) for f in range(k)], features, label, params)
        for f, m in enumerate(models):
            p = predict_proba(m, d.filter(F.col("fold") == f))
            aps.append(metrics.average_precision(p, "probability_1", label).first()["average_precision"] or 0.0)
            f1s.append(metrics.binary_metrics(p, "probability_1", label, 0.5).first()["f1"])
        rows.append((json.dumps(params, sort_keys=True), sum(aps) / k, sum(f1s) / k))
    d.unpersist()
    return df.sparkSession.createDataFrame(rows, "params string, mean_average_precision double, mean_f1 double") \
        .orderBy(F.desc("mean_average_precision"))


def tstr_vs_trtr(real: DataFrame, synthetic: DataFrame, features: Sequence[str] = FEATURE_COLUMNS,
                 label: str = "is_fraud", **params) -> dict:
    """VAL-6: AUC on a 30 % real test split of models trained on the other
    70 % real (TRTR) and on the synthetic rows (TSTR)."""
    from tillguard.session import materialize
    r = materialize(stratified_split(materialize(real), label, 0.3, out="_test"))
    train, test = r.filter(~F.col("_test")).drop("_test"), r.filter(F.col("_test")).drop("_test")
    m_real, m_synth = _fit_concurrently([train, synthetic], features, label, params)
    scored = lambda m: materialize(predict_proba(m, test).select("probability_1", label))
    trtr = metrics.roc_auc(scored(m_real), "probability_1", label).first()["roc_auc"]
    tstr = metrics.roc_auc(scored(m_synth), "probability_1", label).first()["roc_auc"]
    gap = abs(tstr - trtr)
    verdict = auc_gap_verdict(gap)
    rate = test.agg(F.avg(F.col(label).cast("double"))).first()[0]
    return {"trtr_auc": trtr, "tstr_auc": tstr, "auc_gap": gap, "verdict": verdict, "real_test_fraud_rate": rate}
