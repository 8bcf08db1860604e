"""Summary tables over the alert table (AGG-1..10, WIN-7, FLT-1, JON-7..9).

All of them are aggregates with map-side partial aggregation; top-n reports
use ``orderBy().limit()`` which plans as a distributed top-k, and the
per-terminal "worst alert" is a ``min_by`` aggregate, not a window, so a hot
terminal is reduced map-side.
"""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillguard.functions import TIER_ORDER, pct, severity_rank, tier_from_rank, tier_hex, tier_rgb
from tillguard.operators.joins import with_name_fallback, zero_filled


def _spark(df: DataFrame) -> SparkSession:
    return df.sparkSession


def filter_alerts(alerts: DataFrame, tiers: Sequence[str] | None = None, states: Sequence[str] | None = None,
                  date_range: tuple[_dt.date | str, _dt.date | str] | None = None) -> DataFrame:
    """FLT-1: None/empty = no filter; date range inclusive on the UTC date of
    ``created_at``; rows without a date drop only when a range is given."""
    out = alerts
    if tiers:
        out = out.filter(F.col("alert_tier").isin(list(tiers)))
    if states:
        out = out.filter(F.col("state").isin(list(states)))
    if date_range:
        start, end = (F.lit(str(d)).cast("date") for d in date_range)
        d = F.to_date("created_at")
        out = out.filter(d.isNotNull() & (d >= start) & (d <= end))
    return out


def live_alerts(alerts: DataFrame, **filters) -> DataFrame:
    """STR-8 view: filtered alerts, newest first (SRT-1)."""
    return filter_alerts(alerts, **filters).orderBy(F.col("created_at").desc_nulls_last(), "transaction_id")


def tier_counts(alerts: DataFrame) -> DataFrame:
    """AGG-1: all four tiers, 0 when absent; other tiers ignored."""
    counts = alerts.groupBy("alert_tier").agg(F.count(F.lit(1)).alias("alert_count"))
    return zero_filled(_spark(alerts), counts, "alert_tier", TIER_ORDER, ["alert_count"])


def top_terminals(alerts: DataFrame, n: int = 5) -> DataFrame:
    """AGG-2: most alerts per terminal (ties by terminal_id)."""
    return (alerts.groupBy("terminal_id").agg(F.count(F.lit(1)).alias("alert_count"))
                  .orderBy(F.desc("alert_count"), "terminal_id").limit(n))


def top_bins_by_avg_probability(alerts: DataFrame, n: int = 5) -> DataFrame:
    """AGG-3: NULL probability counts as 0.0; empty/NULL BIN skipped."""
    return (alerts.filter(F.col("card_bin").isNotNull() & (F.col("card_bin") != ""))
                  .groupBy("card_bin")
                  .agg(F.avg(F.coalesce(F.col("fraud_probability"), F.lit(0.0))).alias("avg_fraud_probability"))
                  .orderBy(F.desc("avg_fraud_probability"), "card_bin").limit(n))


def top_states(alerts: DataFrame, n: int = 5) -> DataFrame:
    """AGG-4: alert count per non-empty state."""
    return (alerts.filter(F.col("state").isNotNull() & (F.col("state") != ""))
                  .groupBy("state").agg(F.count(F.lit(1)).alias("alert_count"))
                  .orderBy(F.desc("alert_count"), "state").limit(n))


def alerts_by_hour(alerts: DataFrame) -> DataFrame:
    """AGG-5: 24 rows, hour 0..23 of created_at (UTC), zero-filled."""
    counts = (alerts.filter(F.col("created_at").isNotNull())
                    .groupBy(F.hour("created_at").alias("hour")).agg(F.count(F.lit(1)).alias("alert_count")))
    return zero_filled(_spark(alerts), counts, "hour", list(range(24)), ["alert_count"], key_type="int")


def alert_kpis(alerts: DataFrame) -> DataFrame:
    """AGG-6: total and per-tier counts in one row."""
    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(F.col("alert_tier") == "critical").alias("critical"),
        F.count_if(F.col("alert_tier") == "high").alias("high"),
        F.count_if(F.col("alert_tier") == "medium").alias("medium"),
    )


def top_at_risk_terminals(alerts: DataFrame, terminals: DataFrame | None = None, n: int = 5) -> DataFrame:
    """WIN-7: each terminal's worst alert (highest probability; earliest
    created_at then transaction_id on ties), then the top n, with the
    terminal name (id when the terminal is unknown)."""
    order = F.struct(F.coalesce(-F.col("fraud_probability"), F.lit(float("inf"))),
                     F.col("created_at"), F.col("transaction_id"))
    worst = (alerts.groupBy("terminal_id")
                   .agg(F.min_by(F.struct("fraud_probability", "alert_tier"), order).alias("_w"))
                   .select("terminal_id", "_w.fraud_probability", "_w.alert_tier"))
    top = worst.orderBy(F.desc_nulls_last("fraud_probability"), "terminal_id").limit(n)
    if terminals is None:
        top = top.withColumn("terminal_name", F.col("terminal_id"))
    else:
        top = with_name_fallback(top, terminals, "terminal_id", "terminal_name")
    return top.select("terminal_id", "terminal_name", "fraud_probability", "alert_tier")


def terminal_rollup(alerts: DataFrame) -> DataFrame:
    """Per terminal: alert count, max probability (NULL as 0), most severe tier."""
    return (alerts.groupBy("terminal_id")
                  .agg(F.count(F.lit(1)).alias("alert_count"),
                       F.max(F.coalesce(F.col("fraud_probability"), F.lit(0.0))).alias("max_probability"),
                       F.min(severity_rank("alert_tier")).alias("_rank")))


def terminal_status(terminals: DataFrame, alerts: DataFrame, merchants: DataFrame | None = None) -> DataFrame:
    """AGG-7 + JON-7/9 + PRJ-14/15: one row per reference terminal with its
    most severe tier, colour, alert count and max probability (percent)."""
    roll = terminal_rollup(alerts)
    d = terminals.join(roll, on="terminal_id", how="left")
    tier = tier_from_rank(F.col("_rank"))
    d = d.withColumns({
        "tier": tier,
        "alert_count": F.coalesce(F.col("alert_count"), F.lit(0)).cast("long"),
        "fraud_probability_pct": pct(F.coalesce(F.col("max_probability"), F.lit(0.0))),
    })
    d = d.withColumns({
        "flagged": F.col("tier").isNotNull(),
        "color": tier_rgb("tier"),
        "color_hex": tier_hex("tier"),
        "tier_label": F.coalesce(F.col("tier"), F.lit("none")),
    })
    if merchants is not None:
        m = merchants.select("merchant_id", "merchant_name")
        d = d.join(m, on="merchant_id", how="left").withColumn(
            "merchant_name", F.coalesce(F.col("merchant_name"), F.col("merchant_id")))
    else:
        d = d.withColumn("merchant_name", F.col("merchant_id"))
    return (d.drop("_rank", "max_probability")
             .withColumnRenamed("latitude", "lat").withColumnRenamed("longitude", "lon"))


# Fixed value: default map centre (latitude, longitude) when there are no terminals.
DEFAULT_CENTER = (9.0820, 8.6753)


def map_summary(status: DataFrame) -> DataFrame:
    """AGG-8: map centre (mean lat/lon, default centre when empty) and
    flagged vs total terminals."""
    return status.agg(
        F.coalesce(F.avg("lat"), F.lit(DEFAULT_CENTER[0])).alias("center_lat"),
        F.coalesce(F.avg("lon"), F.lit(DEFAULT_CENTER[1])).alias("center_lon"),
        F.count_if(F.col("flagged")).alias("flagged_terminals"),
        F.count(F.lit(1)).alias("total_terminals"),
    )


def filter_facets(alerts: DataFrame) -> DataFrame:
    """AGG-9: tiers present (severity order), non-empty states (sorted),
    first and last alert date."""
    ranks = F.array_sort(F.collect_set(severity_rank("alert_tier")))
    return alerts.agg(
        F.transform(ranks, lambda r: tier_from_rank(r)).alias("tiers"),
        F.array_sort(F.collect_set(F.when(F.col("state") != "", F.col("state")))).alias("states"),
        F.min(F.to_date("created_at")).alias("min_date"),
        F.max(F.to_date("created_at")).alias("max_date"),
    )


def score_histogram(scores: DataFrame, col: str = "fraud_probability", bins: int = 20,
                    lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """AGG-10: fixed-width histogram (values outside [lo, hi] clamp to the
    edge bins; NULL skipped)."""
    width = (hi - lo) / bins
    b = F.floor((F.col(col) - F.lit(lo)) / F.lit(width))
    b = F.greatest(F.lit(0), F.least(F.lit(bins - 1), b)).cast("int")
    return (scores.filter(F.col(col).isNotNull() & ~F.isnan(col))
                  .groupBy(b.alias("bin"))
                  .agg(F.count(F.lit(1)).alias("n"))
                  .withColumn("bin_lo", F.lit(lo) + F.col("bin") * F.lit(width))
                  .withColumn("bin_hi", F.lit(lo) + (F.col("bin") + 1) * F.lit(width)))
