"""Isolation forest on Spark (ML-11..13).

Training: a seeded Bernoulli sample of the non-fraud rows is spread over
``n_trees`` trees (each row joins a tree with probability
``sample_size / sampled rows``), so every tree gets about ``sample_size``
rows; ``groupBy(tree).applyInPandas`` grows each tree with numpy (random
feature, random split between the node's min and max, depth limit
ceil(log2(sample_size))).  Only the sample is shuffled, never the full
table.  The forest (n_trees x at most 2^(depth+1) nodes) is small and is
broadcast for scoring, as arrays (``plans.ensemble``).

Scores follow the usual definition: ``anomaly_score = -2^(-E[h(x)]/c(psi))``
(lower is more anomalous); ``decision = anomaly_score - offset`` where the
offset is the ``contamination`` quantile of the training scores; the raw
label is -1 for decision < 0 and +1 otherwise.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillguard.operators.cumulative import exact_quantiles
from tillguard.schemas import FEATURE_COLUMNS

# Forest size, per-tree sample and contamination of the reference model.
N_TREES = 200
SAMPLE_SIZE = 256
CONTAMINATION = 0.02
EULER_GAMMA = 0.5772156649015329


def c_factor(n) -> np.ndarray:
    """Average path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    feat, thr, left, right, size = [], [], [], [], []

    def node(idx, depth):
        i = len(feat)
        feat.append(-1); thr.append(0.0); left.append(-1); right.append(-1); size.append(len(idx))
        if depth >= max_depth or len(idx) <= 1:
            return i
        sub = x[idx]
        lo, hi = np.nanmin(sub, axis=0), np.nanmax(sub, axis=0)
        cand = np.where(hi > lo)[0]
        if len(cand) == 0:
            return i
        f = int(rng.choice(cand))
        t = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] < t
        feat[i], thr[i] = f, t
        li = node(idx[go_left], depth + 1)
        ri = node(idx[~go_left], depth + 1)
        left[i], right[i] = li, ri
        return i

    node(np.arange(len(x)), 0)
    return feat, thr, left, right, size


@dataclass
class IsolationForestModel:
    trees: list
    sample_size: int
    features: Sequence[str]
    offset: float

    def transform(self, df: DataFrame, out: str = "raw_anomaly") -> DataFrame:
        """Adds ``anomaly_score`` and the raw label; rows walk all trees at once
        (``plans.ensemble``)."""
        from tillguard.plans.ensemble import flatten_forest, with_columns
        forest = flatten_forest(self)

        def values(x):
            s = forest.scores(x)
            return np.stack([s, np.where(s - forest.offset < 0, -1.0, 1.0)], axis=1)

        return with_columns(df, ["anomaly_score", out], list(self.features), values)


def training_rows(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """FLT-2: the forest learns from rows that are no fraud."""
    return df.filter(F.col(label).cast("int") == 0)


def fit_isolation_forest(df: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, *, n_trees: int = N_TREES,
                         sample_size: int = SAMPLE_SIZE, contamination: float = CONTAMINATION,
                         seed: int = 42) -> IsolationForestModel:
    """ML-11 (train on the rows given, e.g. non-fraud rows: FLT-2)."""
    feats = list(features)
    from tillguard.session import hash_sample, materialize
    # every row has a position of its own (fixed by the checkpoint), so equal
    # rows are sampled apart from each other
    rows = materialize(df.select(*[F.col(c).cast("double").alias(c) for c in feats])
                       .withColumn("_row", F.monotonically_increasing_id()))
    n = rows.count()
    psi = int(min(sample_size, n))
    pool = min(1.0, 1.5 * psi * n_trees / max(n, 1))
    sample = materialize(hash_sample(rows, pool, seed, cols=["_row"]))
    m = max(1, sample.count())
    # each sampled row joins each tree with a probability that gives psi rows
    # and six standard deviations more; the psi smallest hashes stay
    p_join = min(1.0, (psi + 6 * math.sqrt(psi) + 6) / m)
    draw = lambda t: F.pmod(F.xxhash64(F.col("_row"), t, F.lit(seed)), F.lit(1 << 40))
    trees_col = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)),
                         lambda t: draw(t).cast("double") / float(1 << 40) < F.lit(p_join))
    assigned = sample.withColumn("_tree", F.explode(trees_col)).withColumn("_draw", draw(F.col("_tree")))
    order = Window.partitionBy("_tree").orderBy("_draw", "_row")  # bounded by p_join * m rows a tree
    assigned = assigned.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= psi).drop("_rank", "_draw", "_row")
    depth = int(math.ceil(math.log2(max(psi, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["_tree"].iloc[0])
        rng = np.random.default_rng(seed * 100003 + t)
        x = pdf[feats].to_numpy(dtype=float)
        x = np.nan_to_num(x, nan=0.0)
        f, th, l, r, s = _grow(x, rng, depth)
        return pd.DataFrame({"tree": [t], "feat": [f], "thr": [th], "left": [l], "right": [r], "size": [s]})

    forest = (assigned.groupBy("_tree").applyInPandas(
        grow, "tree int, feat array<int>, thr array<double>, left array<int>, right array<int>, size array<int>")
        .orderBy("tree").collect())  # n_trees small trees: bounded
    trees = [(r.feat, r.thr, r.left, r.right, r.size) for r in forest]
    model = IsolationForestModel(trees, psi, feats, 0.0)
    scored = model.transform(rows.drop("_row"))
    offset = exact_quantiles(scored, "anomaly_score", [contamination]).first()[0]
    model.offset = float(offset) if offset is not None else 0.0
    return model
