"""Alert table: scores joined back to transactions and reference data (JON-4).

Same statement for batch and streaming inputs.  The tier filter runs before
the join (less join state for streams); the interval condition bounds the
stream-stream join state to the watermark delay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillguard.functions import is_alertable
from tillguard.operators.joins import enrich, interval_join

ALERT_OUTPUT = ["alert_id", "transaction_id", "terminal_id", "merchant_id", "card_bin", "fraud_probability",
                "alert_tier", "state", "terminal_name", "merchant_name", "created_at"]


def alert_id(transaction_id, tier):
    """Deterministic id, so replays of the same alert produce the same row."""
    return F.sha2(F.concat_ws("|", transaction_id, tier), 256)


def build_alerts(scores: DataFrame, transactions: DataFrame, terminals: DataFrame, merchants: DataFrame,
                 *, within_seconds: int = 3600) -> DataFrame:
    s = scores.filter(is_alertable("alert_tier")).select(
        "transaction_id", "fraud_probability", "alert_tier", "scored_at")
    t = transactions.select("transaction_id", "terminal_id", "merchant_id", "card_bin", "state", "timestamp")
    j = interval_join(s, t, "transaction_id", "scored_at", "timestamp", within_seconds)
    j = j.select(
        F.col("l.transaction_id").alias("transaction_id"), F.col("r.terminal_id").alias("terminal_id"),
        F.col("r.merchant_id").alias("merchant_id"), F.col("r.card_bin").alias("card_bin"),
        F.col("l.fraud_probability").alias("fraud_probability"), F.col("l.alert_tier").alias("alert_tier"),
        F.col("r.state").alias("state"), F.col("l.scored_at").alias("created_at"))
    j = enrich(j, terminals, "terminal_id", ["terminal_name"])
    j = enrich(j, merchants, "merchant_id", ["merchant_name"])
    return j.withColumn("alert_id", alert_id(F.col("transaction_id"), F.col("alert_tier"))).select(*ALERT_OUTPUT)
