"""Fitted tree ensembles as flat node arrays (ML-9, ML-14, STR-4).

Both fitted models are ensembles of binary trees.  Here all trees of a model
are one set of arrays (feature, threshold, children, value of each node; a
leaf is its own child), and all rows of an Arrow batch walk all trees
together, one array step for each level.  The same arrays answer a single
request on the driver without a Spark job, score a batch frame, and score a
stream.  They are bounded by the model, not by the data.

Boosted trees add up: the margins after the first m trees of a fit are those
of a fit with m trees, so one fit gives every tree count of a sweep.
"""

from __future__ import annotations

import functools
import itertools
import json
import math
import uuid
from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillguard.functions.scoring import TIER_ORDER, TIER_THRESHOLDS, XGBOOST_WEIGHT
from tillguard.operators.cumulative import running_totals
from tillguard.plans.isolation_forest import IsolationForestModel, c_factor
from tillguard.plans.scoring import ModelsNotReadyError, blend_scores, with_scoring_ratio
from tillguard.plans.training import FIT_PARALLELISM, fold_column, train_classifier
from tillguard.schemas import FEATURE_COLUMNS
from tillguard.session import checkpoint_path

#: Rows that walk the trees at once.
WALK_ROWS = 256


@dataclass(frozen=True)
class Ensemble:
    """Trees as arrays.  A row goes left where its value is at most the
    threshold (``strict``: below it); NaN goes right."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    strict: bool = False

    @functools.cached_property
    def children(self) -> np.ndarray:
        """Right and left child of each node, one after the other."""
        return np.stack([self.right, self.left], axis=1).ravel()

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Value of the leaf that each row reaches in each tree (rows by trees)."""
        out = np.empty((len(x), len(self.roots)))
        width = x.shape[1]
        for i in range(0, len(x), WALK_ROWS):
            part = np.ascontiguousarray(x[i:i + WALK_ROWS])
            base, flat = np.arange(0, part.size, width, dtype=np.int32)[:, None], part.ravel()
            node = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            for _ in range(self.depth):
                at, cut = flat.take(self.feature.take(node) + base), self.threshold.take(node)
                down = at < cut if self.strict else at <= cut
                node = self.children.take(2 * node + down)
            out[i:i + WALK_ROWS] = self.value.take(node)
        return out


def _flat(trees: Sequence[Sequence[tuple]], strict: bool = False) -> Ensemble:
    """From trees of nodes (feature or -1, threshold, left, right, value)."""
    feature, threshold, left, right, value, roots, depth = [], [], [], [], [], [], 0
    for nodes in trees:
        base = len(feature)
        roots.append(base)
        level = {0: 0}
        for i, (f, t, lo, hi, v) in enumerate(nodes):
            leaf = f < 0
            feature.append(0 if leaf else f)
            threshold.append(math.inf if leaf else t)
            left.append(base + (i if leaf else lo))
            right.append(base + (i if leaf else hi))
            value.append(v)
            if not leaf:
                level[lo] = level[hi] = level[i] + 1
                depth = max(depth, level[i] + 1)
    return Ensemble(np.array(feature, np.int32), np.array(threshold), np.array(left, np.int32), np.array(right, np.int32),
                    np.array(value), np.array(roots, np.int32), depth, strict)


@dataclass(frozen=True)
class BoostedTrees:
    """A boosted-tree classifier; its margin is the weighted sum of its trees."""
    trees: Ensemble
    weights: np.ndarray
    features: tuple[str, ...]

    def margins(self, x: np.ndarray, counts: Sequence[int] | None = None) -> np.ndarray:
        """Margins after the first ``counts`` trees (columns); by default all."""
        steps = np.cumsum(self.trees.leaves(x) * self.weights, axis=1)
        return steps[:, [c - 1 for c in counts or [len(self.weights)]]]

    def probabilities(self, x: np.ndarray, counts: Sequence[int] | None = None) -> np.ndarray:
        with np.errstate(over="ignore"):
            return 1.0 / (1.0 + np.exp(-2.0 * self.margins(x, counts)))


def flatten_classifier(model: PipelineModel, features: Sequence[str] = FEATURE_COLUMNS, spark: SparkSession | None = None) -> BoostedTrees:
    """A fitted pipeline's boosted trees, read from the node table that the
    model writes (one row a node: bounded by trees and depth).  A threshold
    between two bins becomes the split candidate between them."""
    spark = spark or SparkSession.getActiveSession()
    gbt, splits = model.stages[-1], model.stages[0].getSplitsArray()
    cut = lambda f, t: float(np.nextafter(splits[f][int(t) + 1], -math.inf))
    path = checkpoint_path(spark, f"models/flat-{uuid.uuid4().hex}")
    gbt.write().save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    trees = []
    for _, nodes in itertools.groupby(rows, key=lambda r: r.treeID):
        held = []
        for i, r in enumerate(nodes):
            if r.id != i or r.split.numCategories not in (-1, 0):
                raise ValueError("trees of continuous features, with nodes numbered in order, are expected")
            inner = r.leftChild >= 0
            held.append((r.split.featureIndex if inner else -1,
                         cut(r.split.featureIndex, r.split.leftCategoriesOrThreshold[0]) if inner else 0.0,
                         r.leftChild, r.rightChild, r.prediction))
        trees.append(held)
    return BoostedTrees(_flat(trees), np.array(gbt.treeWeights, np.float64), tuple(features))


@dataclass(frozen=True)
class Forest:
    """An isolation forest; a leaf's value is its path length."""
    trees: Ensemble
    sample_size: int
    offset: float
    features: tuple[str, ...]

    def scores(self, x: np.ndarray) -> np.ndarray:
        mean = self.trees.leaves(np.nan_to_num(x, nan=0.0)).mean(axis=1)
        return -np.power(2.0, -mean / float(c_factor([self.sample_size])[0]))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.where(self.scores(x) - self.offset < 0, -1.0, 1.0)


def flatten_forest(model: IsolationForestModel) -> Forest:
    trees = []
    for feat, thr, left, right, size in model.trees:
        depth = [0] * len(feat)
        for i, f in enumerate(feat):
            if f >= 0:
                depth[left[i]] = depth[right[i]] = depth[i] + 1
        extra = c_factor(size)
        trees.append([(f, t, lo, hi, depth[i] + extra[i]) for i, (f, t, lo, hi) in enumerate(zip(feat, thr, left, right))])
    return Forest(_flat(trees, strict=True), model.sample_size, model.offset, tuple(model.features))


def _matrix(columns) -> np.ndarray:
    """Arrow columns as a matrix of doubles, null as NaN."""
    return np.stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64) for c in columns], axis=1)


def with_columns(df: DataFrame, names: Sequence[str], features: Sequence[str], values) -> DataFrame:
    """``df`` with double columns ``names``: ``values(matrix of features)``."""
    at = [df.columns.index(f) for f in features]
    kept = [f for f in df.schema.fields if f.name not in names]
    keep = [df.columns.index(f.name) for f in kept]

    def run(batches):
        for batch in batches:
            made = values(_matrix([batch.column(i) for i in at])) if batch.num_rows else np.zeros((0, len(names)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), *(pa.array(made[:, j]) for j in range(len(names)))],
                                             [*(f.name for f in kept), *names])

    return df.mapInArrow(run, T.StructType([*kept, *(T.StructField(n, T.DoubleType()) for n in names)]))


class FittedScorer:
    """Classifier and isolation forest as arrays, blend and tier on top (ML-14)."""

    def __init__(self, classifier: BoostedTrees | None, forest: Forest | None, *, weight: float = XGBOOST_WEIGHT,
                 model_version: str = "v1"):
        if classifier is None or forest is None:
            raise ModelsNotReadyError("both the classifier and the anomaly model are required")
        self.classifier, self.forest, self.weight, self.model_version = classifier, forest, weight, model_version

    def outputs(self, features: DataFrame) -> DataFrame:
        """Adds ``xgboost_score`` (probability of fraud) and ``raw_anomaly``;
        the ratio is the scorer's own."""
        gbt, forest = self.classifier, self.forest
        names = list(dict.fromkeys([*gbt.features, *forest.features]))
        a, b = [names.index(f) for f in gbt.features], [names.index(f) for f in forest.features]
        return with_columns(with_scoring_ratio(features), ["xgboost_score", "raw_anomaly"], names,
                             lambda x: np.stack([gbt.probabilities(x[:, a])[:, 0], forest.raw(x[:, b])], axis=1))

    def score(self, features: DataFrame, scored_at=None, keep: tuple[str, ...] = ()) -> DataFrame:
        """Score table of a batch or streaming feature frame."""
        return blend_scores(self.outputs(features), weight=self.weight, model_version=self.model_version, scored_at=scored_at, keep=keep)

    def score_request(self, request: dict) -> dict:
        """One request, on the driver, inference included."""
        base, amount = request.get("bin_spend_rate"), request.get("amount_ngn")
        row = {**request, "amount_vs_bin_avg_ratio": None if amount is None or base is None else amount / base if base > 0 else 0.0}
        x = lambda names: np.array([[math.nan if row.get(f) is None else float(row[f]) for f in names]])
        p = float(self.classifier.probabilities(x(self.classifier.features))[0, 0])
        iso = min(1.0, max(0.0, (1.0 - float(self.forest.raw(x(self.forest.features))[0])) / 2.0))
        blend = self.weight * p + (1.0 - self.weight) * iso
        tier = next((t for t in TIER_ORDER if blend >= TIER_THRESHOLDS[t]), TIER_ORDER[-1])
        near = lambda v: math.floor(v * 10_000 + 0.5) / 10_000
        return {"transaction_id": request.get("transaction_id"), "fraud_probability": near(blend), "alert_tier": tier,
                "xgboost_score": near(p), "isolation_forest_score": near(iso), "model_version": self.model_version}


# ----------------------------------------------------------------- grid sweep

# The grid of the reference's sweep (36 combinations).
PARAM_GRID = {"maxDepth": [3, 4, 5, 6], "stepSize": [0.02, 0.05, 0.1], "maxIter": [200, 300, 400]}


def staged_sweep(df: DataFrame, grid: dict[str, Sequence] | None = None, k: int = 5, features: Sequence[str] = FEATURE_COLUMNS,
                 label: str = "is_fraud") -> DataFrame:
    """ML-9: mean average precision and F1 at 0.5 over ``k`` stratified folds,
    one row a combination, best first.

    A fold and each setting other than ``maxIter`` is one fit, with the most
    trees asked for; each of its rows gets the probabilities of all tree
    counts in one walk, and the curves of all folds and combinations come
    from one pass over (fold, combination, score) counts.
    """
    from concurrent.futures import ThreadPoolExecutor

    grid = dict(grid or PARAM_GRID)
    counts = sorted(set(grid.pop("maxIter")))
    keys = list(grid)
    settings = [dict(zip(keys, c)) for c in itertools.product(*[grid[x] for x in keys])]
    d = fold_column(df, label, k).select("fold", label, *features).persist()

    def fit(job):
        params, fold = job
        model = train_classifier(d.filter(F.col("fold") != fold), features, label, maxIter=counts[-1], **params)
        return flatten_classifier(model, features, df.sparkSession)

    jobs = [(p, f) for p in settings for f in range(k)]
    with ThreadPoolExecutor(max_workers=FIT_PARALLELISM) as pool:
        fitted = list(pool.map(fit, jobs))
    scored = None
    for f in range(k):
        mine = [(p, m) for (p, g), m in zip(jobs, fitted) if g == f]
        names = [json.dumps({**p, "maxIter": c}, sort_keys=True) for p, _ in mine for c in counts]
        columns = [f"_p{i}" for i in range(len(names))]
        part = with_columns(d.filter(F.col("fold") == f), columns, list(features),
                             lambda x, mine=mine: np.concatenate([m.probabilities(x, counts) for _, m in mine], axis=1))
        combos = F.explode(F.array(*[F.struct(F.lit(n).alias("params"), F.col(c).alias("p")) for n, c in zip(names, columns)]))
        part = part.select("fold", F.col(label).cast("int").cast("long").alias("y"), combos.alias("c")).select("fold", "y", "c.*")
        scored = part if scored is None else scored.unionByName(part)
    group = ["params", "fold"]
    at = (F.col("p") >= 0.5).cast("long")
    by_score = scored.groupBy(*group, "p").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"),
                                               F.sum(at * F.col("y")).alias("tp"), F.sum(at * (1 - F.col("y"))).alias("fp"))
    c = running_totals(by_score, "p", ["pos", "neg"], group=group, descending=True)
    gain = F.col("pos") * F.col("cum_pos").cast("double") / (F.col("cum_pos") + F.col("cum_neg"))
    folds = c.groupBy(*group).agg(F.sum(gain).alias("gain"), F.sum("pos").alias("pos"), F.sum("tp").alias("tp"), F.sum("fp").alias("fp"))
    # F1 = 2 tp / (2 tp + fp + fn), 0 without a true positive
    f1 = F.when(F.col("tp") > 0, 2 * F.col("tp").cast("double") / (F.col("tp") + F.col("fp") + F.col("pos"))).otherwise(F.lit(0.0))
    ap = F.when(F.col("pos") > 0, F.col("gain") / F.col("pos")).otherwise(F.lit(0.0))
    rows = folds.groupBy("params").agg(F.avg(ap).alias("mean_average_precision"), F.avg(f1).alias("mean_f1")).collect()  # one a combination
    d.unpersist()
    return df.sparkSession.createDataFrame(rows, "params string, mean_average_precision double, mean_f1 double") \
        .orderBy(F.desc("mean_average_precision"), "params")
