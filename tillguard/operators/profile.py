"""Data profile of a labelled feature frame (AGG-11..19, PRJ-3, PRJ-11/12).

Long-form outputs (one row per column or column pair) so that the number of
features is a parameter, not a schema change.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillguard.functions import has_geo_jump
from tillguard.schemas import FEATURE_COLUMNS


def to_model_frame(df: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, label: str = "is_fraud",
                   keep: Sequence[str] = ()) -> DataFrame:
    """PRJ-3: features as doubles, label as int."""
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in features],
                     F.col(label).cast("int").alias(label))


def class_balance(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """AGG-11."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def _melt(df: DataFrame, cols: Sequence[str], name: str = "column", value: str = "value") -> DataFrame:
    expr = ", ".join(f"'{c}', `{c}`" for c in cols)
    return df.selectExpr(f"stack({len(cols)}, {expr}) as ({name}, {value})")


def missing_value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-12: NULL or NaN per column."""
    def miss(c):
        t = dict(df.dtypes)[c]
        cond = F.col(c).isNull() | F.isnan(c) if t in ("double", "float") else F.col(c).isNull()
        return F.count_if(cond).alias(c)
    return _melt(df.agg(*[miss(c) for c in cols]), cols, value="missing")


def describe_features(df: DataFrame, cols: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """AGG-13: count, mean, sample std, min, exact 25/50/75 % (linear), max:
    one aggregate for all columns, and their quantiles by selection
    (``operators.selection``: values are counted in place, none moves)."""
    from tillguard.operators.selection import quantiles
    from tillguard.session import materialize
    d = materialize(df.select(*[F.col(c).cast("double").alias(c) for c in cols]))
    how = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    row = d.agg(*[f(c).alias(f"{c}__{k}") for c in cols for k, f in how.items()]).first()
    q = quantiles(d, cols, [0.25, 0.5, 0.75])
    rows = [(c, *[row[f"{c}__{k}"] for k in ("count", "mean", "std", "min")], *q[c], row[f"{c}__max"]) for c in cols]
    return df.sparkSession.createDataFrame(rows, "column string, count long, mean double, std double, min double, p25 double, "
                                                 "p50 double, p75 double, max double")


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-14: Pearson correlation of every ordered pair (pairwise complete),
    all pairs in a single aggregate."""
    aggs = []
    names = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            names.append((a, b))
            aggs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}"))
    row = df.agg(*aggs)
    pairs = []
    for a, b in names:
        pairs.append((a, b, f"{a}__{b}"))
        if a != b:
            pairs.append((b, a, f"{a}__{b}"))
    expr = ", ".join(f"'{a}', '{b}', `{k}`" for a, b, k in pairs)
    return row.selectExpr(f"stack({len(pairs)}, {expr}) as (column_a, column_b, corr)")


def scale_pos_weight(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """AGG-15: negatives / positives, 1.0 without positives."""
    y = F.col(label).cast("int")
    c = df.agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    return c.select(F.coalesce(F.col("pos"), F.lit(0)).alias("positives"),
                    F.coalesce(F.col("neg"), F.lit(0)).alias("negatives"),
                    F.when(F.coalesce(F.col("pos"), F.lit(0)) == 0, F.lit(1.0))
                     .otherwise(F.col("neg") / F.col("pos")).alias("scale_pos_weight"))


def joint_counts(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """AGG-16: rows per (label, reversal count, velocity, has_geo_jump)."""
    return (df.withColumn("has_geo_jump", has_geo_jump("geo_jump_km"))
              .groupBy(F.col(label).cast("int").alias(label),
                       F.col("terminal_reversal_count").cast("long").alias("terminal_reversal_count"),
                       F.col("velocity_1h").cast("long").alias("velocity_1h"), "has_geo_jump")
              .agg(F.count(F.lit(1)).alias("n")))


def enforce_zero_jump(df: DataFrame, label: str = "is_fraud",
                      features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """PRJ-11/12: geo_jump_km = 0 where has_geo_jump = 0; keep features + label."""
    d = df.withColumn("geo_jump_km", F.when(F.col("has_geo_jump") == 0, F.lit(0.0)).otherwise(F.col("geo_jump_km")))
    return d.select(*features, label)


def dataset_rates(df: DataFrame, label: str = "is_fraud", name: str | None = None) -> DataFrame:
    """AGG-17: rows, fraud rows, fraud rate."""
    y = F.col(label).cast("int")
    out = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(y), F.lit(0)).alias("n_fraud"),
                 F.avg(y.cast("double")).alias("fraud_rate"))
    return out if name is None else out.select(F.lit(name).alias("dataset"), "*")


def score_stats(df: DataFrame, score: str, label: str = "is_fraud") -> DataFrame:
    """AGG-18: mean, population std, min, max of a score and its correlation
    with the label."""
    return df.agg(F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"), F.min(score).alias("min"),
                  F.max(score).alias("max"), F.corr(F.col(score), F.col(label).cast("double")).alias("corr_label"))


def eda_report(df: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, label: str = "is_fraud") -> DataFrame:
    """AGG-19: long-form report (section, key, metric, value)."""
    spark = df.sparkSession
    rows = df.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("rows").alias("section"), F.lit("all").alias("key"), F.lit("n").alias("metric"), "value")
    cb = class_balance(df, label).select(F.lit("class_balance").alias("section"),
                                         F.col(label).cast("string").alias("key"), F.lit("n").alias("metric"),
                                         F.col("n").cast("double").alias("value"))
    mv = missing_value_counts(df, list(features)).select(F.lit("missing").alias("section"),
                                                        F.col("column").alias("key"), F.lit("n").alias("metric"),
                                                        F.col("missing").cast("double").alias("value"))
    de = describe_features(df, features)
    de_long = de.selectExpr("column", "stack(8, 'count', cast(count as double), 'mean', mean, 'std', std, "
                                      "'min', min, 'p25', p25, 'p50', p50, 'p75', p75, 'max', max) as (metric, value)")
    de_long = de_long.select(F.lit("describe").alias("section"), F.col("column").alias("key"), "metric", "value")
    co = correlation_matrix(df, [*features, label]).select(
        F.lit("correlation").alias("section"), F.concat_ws("|", "column_a", "column_b").alias("key"),
        F.lit("pearson").alias("metric"), F.col("corr").alias("value"))
    del spark
    return rows.unionByName(cb).unionByName(mv).unionByName(de_long).unionByName(co)


def deterministic_shuffle(df: DataFrame, seed: int = 42, id_col: str | None = None) -> DataFrame:
    """SRT-3: a seeded pseudo-random order (by a hash of the id, or of all
    columns), distributed: range-partitioned sort, no single task."""
    key = F.xxhash64(F.col(id_col), F.lit(seed)) if id_col else F.xxhash64(*df.columns, F.lit(seed))
    return df.withColumn("_shuffle_key", key).orderBy("_shuffle_key").drop("_shuffle_key")
