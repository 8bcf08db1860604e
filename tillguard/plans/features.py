"""Transaction features (WIN-1..5, PRJ-1, PRJ-7, PRJ-10, PRJ-13).

Per transaction, over whole epoch seconds with inclusive trailing frames:

* ``velocity_1h``: non-null transaction ids of the terminal in the last hour;
* ``geo_jump_km``: distance from the terminal's previous transaction
  (0.0 when there is none or its latitude is NULL);
* ``bin_spend_rate``: mean amount of the card BIN in the last hour;
* ``terminal_reversal_count``: fake reversals of the terminal in the last 24 h;
* ``amount_vs_bin_avg_ratio``: amount / bin_spend_rate (NULL for a 0 base).

Physical shape: rows are dealt by (key, block of seconds), once for terminals
and once for BINs, next to the sums that their windows need from earlier
blocks; nothing joins back, a hot key is spread over its blocks, and there is
no switch by size (see ``operators.trailing.trailing_blocks``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillguard.functions import amount_vs_bin_avg_ratio, haversine_km, is_reversal
from tillguard.operators.trailing import SEC, Trailing, trailing_aggregates, with_epoch_seconds

HOUR = 3600
DAY = 86400

FEATURE_OUTPUT = [
    "transaction_id", "terminal_id", "card_bin", "amount_ngn", "velocity_1h", "geo_jump_km",
    "bin_spend_rate", "terminal_reversal_count", "amount_vs_bin_avg_ratio", "timestamp",
]


def _terminal_stage(df: DataFrame, mode: str, bucket_seconds: int | None, with_geo: bool = True,
                    specs=None) -> DataFrame:
    specs = specs if specs is not None else [
        Trailing("velocity_1h", "count", "transaction_id", HOUR),
        Trailing("terminal_reversal_count", "sum", "_is_reversal", DAY),
    ]
    d = df.withColumn("_is_reversal", is_reversal("fraud_type")) if any(
        s.value == "_is_reversal" for s in specs) else df
    out = trailing_aggregates(
        d, ["terminal_id"], specs, mode=mode, bucket_seconds=bucket_seconds,
        prev_cols=["latitude", "longitude"] if with_geo else (),
        prev_order=["timestamp", "transaction_id"])
    if with_geo:
        out = out.withColumn(
            "geo_jump_km",
            F.when(F.col("prev_latitude").isNotNull(),
                   haversine_km("prev_latitude", "prev_longitude", "latitude", "longitude"))
             .otherwise(F.lit(0.0))).drop("prev_latitude", "prev_longitude")
    return out.drop("_is_reversal")


def _bin_stage(df: DataFrame, mode: str, bucket_seconds: int | None, source: DataFrame | None = None) -> DataFrame:
    specs = [Trailing("bin_spend_rate", "mean", "amount_ngn", HOUR)]
    if mode == "prefix":
        from tillguard.operators.trailing import trailing_prefix
        return trailing_prefix(df, ["card_bin"], specs, source=source)
    return trailing_aggregates(df, ["card_bin"], specs, mode=mode, bucket_seconds=bucket_seconds)


def _terminal_stage_prefix(df: DataFrame, lag_bucket_seconds: int) -> DataFrame:
    """Hot-terminal form: counts/sums from per-second prefix sums, previous
    location from short buckets without context (exact fallback for gaps)."""
    from tillguard.operators.trailing import trailing_prefix
    d = _terminal_stage(df, "bucketed", lag_bucket_seconds, with_geo=True, specs=[])
    d = trailing_prefix(d, ["terminal_id"], [Trailing("velocity_1h", "count", "transaction_id", HOUR),
                                             Trailing("terminal_reversal_count", "sum", "_is_reversal", DAY)],
                        source=df.withColumn("_is_reversal", is_reversal("fraud_type")))
    return d.withColumn("terminal_reversal_count", F.col("terminal_reversal_count").cast("long"))


def build_features(tx: DataFrame, *, mode: str = "blocks", terminal_bucket_seconds: int = 2 * DAY,
                   bin_bucket_seconds: int = 4 * HOUR, bin_mode: str | None = None,
                   terminal_mode: str | None = None, lag_bucket_seconds: int = HOUR) -> DataFrame:
    """WIN-5: all five features, 10 output columns in the fixed order.

    Counts stay integral (bigint); ``to_feature_table`` casts to the declared
    double schema at the table edge.  One lazy plan for every size: two-level
    sums (``operators.trailing.trailing_blocks``).  Other modes run only when
    asked for: ``'by_second'`` values joined back on (key, second),
    ``'bucketed'`` and ``'plain'`` windows over rows, ``'prefix'`` sums.
    """
    base = d = with_epoch_seconds(tx.select("transaction_id", "terminal_id", "card_bin", "amount_ngn",
                                            "latitude", "longitude", "timestamp", "fraud_type"))
    if terminal_mode == "prefix":
        d = _terminal_stage_prefix(d, lag_bucket_seconds)
    else:
        d = _terminal_stage(d, terminal_mode or mode, terminal_bucket_seconds)
    d = d.drop("latitude", "longitude", "fraud_type")  # rows move again: what only terminals need stays behind
    d = _bin_stage(d, bin_mode or mode, bin_bucket_seconds, source=base)
    d = d.withColumn("amount_vs_bin_avg_ratio", amount_vs_bin_avg_ratio("amount_ngn", "bin_spend_rate"))
    return d.select(*FEATURE_OUTPUT)


def with_velocity_1h(tx: DataFrame, *, mode: str = "blocks", bucket_seconds: int = 4 * HOUR) -> DataFrame:
    """WIN-1 alone."""
    d = with_epoch_seconds(tx)
    d = _terminal_stage(d, mode, bucket_seconds, with_geo=False,
                        specs=[Trailing("velocity_1h", "count", "transaction_id", HOUR)])
    return d.drop(SEC)


def with_geo_jump(tx: DataFrame, *, mode: str = "blocks", bucket_seconds: int = DAY) -> DataFrame:
    """WIN-2 alone."""
    d = with_epoch_seconds(tx)
    d = _terminal_stage(d, mode, bucket_seconds, with_geo=True, specs=[])
    return d.drop(SEC)


def with_bin_spend_rate(tx: DataFrame, *, mode: str = "blocks", bucket_seconds: int = 4 * HOUR) -> DataFrame:
    """WIN-3 alone (the BIN key is hot: only a handful of BINs exist)."""
    return _bin_stage(with_epoch_seconds(tx), mode, bucket_seconds).drop(SEC)


def with_terminal_reversal_count(tx: DataFrame, *, mode: str = "blocks",
                                 bucket_seconds: int = 2 * DAY) -> DataFrame:
    """WIN-4 alone."""
    d = with_epoch_seconds(tx)
    d = _terminal_stage(d, mode, bucket_seconds, with_geo=False,
                        specs=[Trailing("terminal_reversal_count", "sum", "_is_reversal", DAY)])
    return d.drop(SEC)


def with_amount_vs_bin_avg_ratio(df: DataFrame) -> DataFrame:
    """PRJ-7: needs ``bin_spend_rate`` first."""
    return df.withColumn("amount_vs_bin_avg_ratio", amount_vs_bin_avg_ratio("amount_ngn", "bin_spend_rate"))


def to_feature_table(features: DataFrame) -> DataFrame:
    """Cast to the declared FEATURE_SCHEMA types (counts become doubles)."""
    return features.select(
        "transaction_id", "terminal_id", "card_bin", F.col("amount_ngn").cast("double").alias("amount_ngn"),
        F.col("velocity_1h").cast("double").alias("velocity_1h"),
        F.col("geo_jump_km").cast("double").alias("geo_jump_km"),
        F.col("bin_spend_rate").cast("double").alias("bin_spend_rate"),
        F.col("terminal_reversal_count").cast("double").alias("terminal_reversal_count"),
        F.col("amount_vs_bin_avg_ratio").cast("double").alias("amount_vs_bin_avg_ratio"),
        "timestamp",
    )
