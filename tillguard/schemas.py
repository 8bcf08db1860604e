"""Declared schemas of every table the engine reads or writes."""

from pyspark.sql import types as T

TRANSACTION_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("terminal_id", T.StringType(), False),
    T.StructField("merchant_id", T.StringType(), False),
    T.StructField("card_bin", T.StringType(), False),
    T.StructField("amount_ngn", T.DoubleType(), False),
    T.StructField("state", T.StringType(), True),
    T.StructField("lga", T.StringType(), True),
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("longitude", T.DoubleType(), True),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("is_fraud", T.BooleanType(), True),
    T.StructField("fraud_type", T.StringType(), True),
])

#: Fields that must be present for a decoded transaction to be valid.
REQUIRED_TRANSACTION_FIELDS = [
    "transaction_id", "terminal_id", "merchant_id", "card_bin", "amount_ngn", "timestamp",
]

FEATURE_COLUMNS = [
    "velocity_1h",
    "geo_jump_km",
    "bin_spend_rate",
    "terminal_reversal_count",
    "amount_ngn",
    "amount_vs_bin_avg_ratio",
]

FEATURE_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("terminal_id", T.StringType(), False),
    T.StructField("card_bin", T.StringType(), False),
    T.StructField("amount_ngn", T.DoubleType(), False),
    T.StructField("velocity_1h", T.DoubleType(), True),
    T.StructField("geo_jump_km", T.DoubleType(), True),
    T.StructField("bin_spend_rate", T.DoubleType(), True),
    T.StructField("terminal_reversal_count", T.DoubleType(), True),
    T.StructField("amount_vs_bin_avg_ratio", T.DoubleType(), True),
    T.StructField("timestamp", T.TimestampType(), False),
])

SCORE_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("fraud_probability", T.DoubleType(), True),
    T.StructField("alert_tier", T.StringType(), True),
    T.StructField("xgboost_score", T.DoubleType(), True),
    T.StructField("isolation_forest_score", T.DoubleType(), True),
    T.StructField("model_version", T.StringType(), True),
    T.StructField("scored_at", T.TimestampType(), True),
])

ALERT_COLUMNS = [
    "alert_id", "transaction_id", "terminal_id", "merchant_id", "card_bin",
    "fraud_probability", "alert_tier", "state", "created_at",
]

ALERT_SCHEMA = T.StructType([
    T.StructField("alert_id", T.StringType(), True),
    T.StructField("transaction_id", T.StringType(), True),
    T.StructField("terminal_id", T.StringType(), True),
    T.StructField("merchant_id", T.StringType(), True),
    T.StructField("card_bin", T.StringType(), True),
    T.StructField("fraud_probability", T.DoubleType(), True),
    T.StructField("alert_tier", T.StringType(), True),
    T.StructField("state", T.StringType(), True),
    T.StructField("created_at", T.TimestampType(), True),
])

TERMINAL_SCHEMA = T.StructType([
    T.StructField("terminal_id", T.StringType(), False),
    T.StructField("terminal_name", T.StringType(), True),
    T.StructField("merchant_id", T.StringType(), True),
    T.StructField("state", T.StringType(), True),
    T.StructField("lga", T.StringType(), True),
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("longitude", T.DoubleType(), True),
    T.StructField("operator", T.StringType(), True),
    T.StructField("is_active", T.BooleanType(), True),
])

MERCHANT_SCHEMA = T.StructType([
    T.StructField("merchant_id", T.StringType(), False),
    T.StructField("merchant_name", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("state", T.StringType(), True),
    T.StructField("lga", T.StringType(), True),
    T.StructField("registration_date", T.DateType(), True),
    T.StructField("is_flagged", T.BooleanType(), True),
])

#: Six features + label: the frame models train on and synthetic CSVs carry.
MODEL_FRAME_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType(), True) for c in FEATURE_COLUMNS]
    + [T.StructField("is_fraud", T.IntegerType(), True)]
)

# Validation column groups.
CONTINUOUS_COLUMNS = ["geo_jump_km", "bin_spend_rate", "amount_ngn", "amount_vs_bin_avg_ratio"]
CATEGORICAL_COLUMNS = ["is_fraud", "velocity_1h", "terminal_reversal_count"]
