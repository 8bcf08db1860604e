"""Binary-classifier metrics as distributed aggregates (ML-4, ML-6..8, WIN-8).

All curve metrics first collapse the scored rows to per-distinct-score
positive/negative counts, then use ``cumulative.running_totals`` (no
single-task sort).  Tie handling follows the usual definitions: equal
scores form one threshold step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillguard.operators.cumulative import global_positions, running_totals, weights_by_value

F1_EPS = 1e-12


def _label(label: str | Column) -> Column:
    c = F.col(label) if isinstance(label, str) else label
    return c.cast("int").cast("long")


def score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row per distinct score: ``pos`` and ``neg`` counts."""
    y = _label(label)
    return weights_by_value(df, score, {"pos": y, "neg": F.lit(1).cast("long") - y}, out="score")


def _curve(df: DataFrame, score: str, label: str, sums, *, descending: bool = False, n_buckets: int | None = None,
           decimals: int | None = None) -> DataFrame:
    """Per-score counts with running totals ``cum_`` and totals ``tot_``.  With
    ``decimals`` the scores are probabilities of so many decimals: then there
    are at most 10**decimals + 1 rows, and one window over them will do."""
    if decimals is None:
        return running_totals(score_counts(df, score, label), "score", sums, descending=descending, n_buckets=n_buckets)
    # scores are grouped as whole numbers; rows without one weigh nothing (a
    # filter on them would make Spark evaluate the score twice)
    s = F.nanvl(F.col(score), F.lit(None).cast("double"))
    step = F.when((s < 0) | (s > 1), F.raise_error(F.lit("scores must lie in 0 to 1")).cast("int")).otherwise(
        F.round(s * 10 ** decimals).cast("int"))
    d = df.select(step.alias("_step"), _label(label).alias("_y"))
    here = F.col("_step").isNotNull()
    c = d.groupBy("_step").agg(F.sum(F.when(here, F.col("_y")).otherwise(0)).alias("pos"),
                               F.sum(F.when(here, 1 - F.col("_y")).otherwise(0)).alias("neg"))
    c = c.select((F.col("_step") / float(10 ** decimals)).alias("score"), "pos", "neg")
    order = Window.orderBy(F.desc("score") if descending else F.asc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy()
    c = c.withColumns({**{f"cum_{x}": F.sum(x).over(order) for x in sums}, **{f"tot_{x}": F.sum(x).over(every) for x in sums}})
    return c.filter(F.col("score").isNotNull())


def binary_metrics(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """ML-6: precision, recall, F1 at ``score >= threshold`` (0 when undefined)."""
    y = _label(label)
    pred = (F.col(score) >= F.lit(float(threshold))).cast("long")
    c = df.agg(F.sum(pred * y).alias("tp"), F.sum(pred * (1 - y)).alias("fp"),
               F.sum((1 - pred) * y).alias("fn"), F.count(F.lit(1)).alias("n"))
    tp, fp, fn = (F.coalesce(F.col(x), F.lit(0)).cast("double") for x in ("tp", "fp", "fn"))
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return (c.select(F.lit(float(threshold)).alias("threshold"), tp.cast("long").alias("tp"),
                     fp.cast("long").alias("fp"), fn.cast("long").alias("fn"),
                     precision.alias("precision"), recall.alias("recall"))
             .withColumn("f1", f1))


def roc_auc(df: DataFrame, score: str, label: str, *, n_buckets: int | None = None, decimals: int | None = None) -> DataFrame:
    """ML-7: exact ROC AUC with ties counted half.  NULL if a class is absent."""
    c = _curve(df, score, label, ["neg"], n_buckets=n_buckets, decimals=decimals)
    below = F.col("cum_neg") - F.col("neg")
    return c.agg(
        (F.sum(F.col("pos") * (below + F.col("neg") / 2.0)) /
         (F.sum("pos").cast("double") * F.sum("neg").cast("double"))).alias("roc_auc"),
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
    ).select(F.when((F.col("positives") > 0) & (F.col("negatives") > 0), F.col("roc_auc")).alias("roc_auc"),
             "positives", "negatives")


def pr_curve(df: DataFrame, score: str, label: str, *, n_buckets: int | None = None) -> DataFrame:
    """Per distinct threshold t: tp/fp for ``score >= t``, precision, recall, F1."""
    c = running_totals(score_counts(df, score, label), "score", ["pos", "neg"], descending=True,
                       n_buckets=n_buckets)
    return _with_pr(c).select(F.col("score").alias("threshold"), F.col("cum_pos").alias("tp"),
                              F.col("cum_neg").alias("fp"), "pos", "neg", "precision", "recall", "f1")


def _with_pr(c: DataFrame) -> DataFrame:
    tp, fp, P = (F.col(x).cast("double") for x in ("cum_pos", "cum_neg", "tot_pos"))
    c = c.withColumns({
        "precision": F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0)),
        "recall": F.when(P > 0, tp / P).otherwise(F.lit(1.0)),
    })
    return c.withColumn("f1", 2 * F.col("precision") * F.col("recall") /
                        (F.col("precision") + F.col("recall") + F.lit(F1_EPS)))


def average_precision(df: DataFrame, score: str, label: str, *, n_buckets: int | None = None,
                      decimals: int | None = None) -> DataFrame:
    """ML-8: step-wise AP = sum over thresholds of (recall gain) * precision."""
    c = _curve(df, score, label, ["pos", "neg"], descending=True, n_buckets=n_buckets, decimals=decimals)
    tp, fp = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    agg = c.agg(F.sum(F.col("pos") * (tp / (tp + fp))).alias("_s"), F.sum("pos").alias("positives"))
    return agg.select(F.when(F.col("positives") > 0, F.col("_s") / F.col("positives")).alias("average_precision"),
                      "positives")


def best_threshold(df: DataFrame, score: str, label: str, *, n_buckets: int | None = None,
                   decimals: int | None = None) -> DataFrame:
    """ML-4: threshold with the highest F1 = 2PR/(P+R+1e-12); on equal F1 the
    lowest threshold wins."""
    c = _with_pr(_curve(df, score, label, ["pos", "neg"], descending=True, n_buckets=n_buckets, decimals=decimals))
    best = F.max_by(F.struct(F.col("score").alias("threshold"), "f1", "precision", "recall"),
                    F.struct(F.col("f1"), -F.col("score")))
    return c.agg(best.alias("b")).select("b.*")


def precision_at_k(df: DataFrame, score: str, label: str, k: int, *, id_col: str = "transaction_id",
                   n_buckets: int | None = None) -> DataFrame:
    """WIN-8: mean label of the k lowest scores (ties at the cut broken by
    ``id_col``); NaN for k <= 0.

    Rows strictly below the cut-off score are summed exactly from running
    counts; only the rows of the single cut-off score are ordered by id.
    """
    spark = df.sparkSession
    if k <= 0:
        return spark.range(1).select(F.lit(float("nan")).alias("precision_at_k"), F.lit(k).alias("k"))
    cnt = weights_by_value(df, score, {"n": F.lit(1).cast("long"), "pos": _label(label)}, out="score")
    c = running_totals(cnt, "score", ["n", "pos"], n_buckets=n_buckets)
    cut = c.filter(F.col("cum_n") >= k).agg(F.min("score").alias("cut")).first()["cut"]  # one scalar
    if cut is None:  # fewer than k rows: all of them
        tot = df.agg(F.avg(_label(label).cast("double")).alias("precision_at_k"))
        return tot.withColumn("k", F.lit(k))
    below = c.filter(F.col("score") < F.lit(cut)).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("pos"), F.lit(0)).alias("pos")).first()
    rest = k - below["n"]
    # only the rows of the cut-off score need an order: exact positions by id
    ties = global_positions(df.filter(F.col(score) == F.lit(cut)).select(id_col, _label(label).alias("_y")),
                            [id_col])
    tie = (ties.filter(F.col("position") < F.lit(int(rest)))
               .agg(F.coalesce(F.sum("_y"), F.lit(0)).alias("pos")).first()["pos"])
    return spark.range(1).select(F.lit((below["pos"] + tie) / float(k)).alias("precision_at_k"),
                                 F.lit(k).alias("k"))
