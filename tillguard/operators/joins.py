"""Joins of the reference (JON-1..9).

Reference tables are joined without a broadcast hint: their size grows with
the number of terminals/merchants, so the planner's measured-size rule
(``spark.sql.autoBroadcastJoinThreshold`` and AQE's runtime conversion)
decides, and a sort-merge join is used beyond it.  Only fixed-size
dimensions built here (tiers, hours) are broadcast explicitly.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillguard.sources.changelog import latest_by_key


def interval_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
                  within_seconds: int = 3600, how: str = "inner") -> DataFrame:
    """JON-1: equi-join on ``key`` with ``|right_time - left_time| <= within``
    (inclusive both sides).  Works for batch and for two watermarked streams."""
    l, r = left.alias("l"), right.alias("r")
    lt, rt = F.col(f"l.{left_time}"), F.col(f"r.{right_time}")
    iv = F.make_dt_interval(secs=F.lit(within_seconds))
    cond = (F.col(f"l.{key}") == F.col(f"r.{key}")) & (rt >= lt - iv) & (rt <= lt + iv)
    return l.join(r, cond, how)


def enrich(df: DataFrame, reference: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """JON-2/3: left join a reference table, adding ``columns`` (NULL on a miss)."""
    ref = reference.select(key, *columns)
    return df.join(ref, on=key, how="left")


def with_name_fallback(df: DataFrame, reference: DataFrame, key: str, name_col: str) -> DataFrame:
    """JON-7: display name with the id as fallback when the key is absent
    from the reference.  A present key with a NULL name keeps NULL."""
    ref = reference.select(key, name_col, F.lit(True).alias("_ref_hit"))
    out = df.join(ref, on=key, how="left")
    return out.withColumn(name_col, F.when(F.col("_ref_hit"), F.col(name_col)).otherwise(F.col(key))).drop("_ref_hit")


def label_join(features: DataFrame, labels: DataFrame, key: str = "transaction_id",
               label_col: str = "is_fraud", order: str | Sequence[str] | None = None) -> DataFrame:
    """JON-5: left join the latest label per key, default False."""
    if order is not None:
        labels = latest_by_key(labels.select(key, label_col, *([order] if isinstance(order, str) else order)),
                               key, order).select(key, label_col)
    else:
        labels = labels.groupBy(key).agg(F.max(F.col(label_col)).alias(label_col))
    out = features.join(labels, on=key, how="left")
    return out.withColumn(label_col, F.coalesce(F.col(label_col), F.lit(False)))


def unseen(batch: DataFrame, target: DataFrame, key: str = "transaction_id") -> DataFrame:
    """JON-6: rows of ``batch`` whose key is not yet in ``target`` (and only
    the first of duplicates inside the batch)."""
    return batch.dropDuplicates([key]).join(target.select(key), on=key, how="left_anti")


def zero_filled(spark: SparkSession, counts: DataFrame, key: str, values: list, count_cols: Sequence[str],
                key_type: str = "string") -> DataFrame:
    """JON-8: left join counts onto a fixed category axis, 0 where absent.
    The axis is a literal list (bounded), so broadcasting it is safe."""
    axis = spark.range(1).select(F.posexplode(F.array(*[F.lit(v).cast(key_type) for v in values]))
                                 .alias("_pos", key))
    out = F.broadcast(axis).join(counts, on=key, how="left")
    return out.select(key, *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in count_cols], "_pos") \
              .orderBy("_pos").drop("_pos")
