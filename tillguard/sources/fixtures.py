"""Views of the driver's test tables in the engine's data model.

The test tables are generic (``events``, ``customer``, ``supplier``...); these
functions map them onto transactions, terminals, merchants and scores as
documented in FIXTURES.md part B.  Every function is a lazy projection over
the whole input table, so its work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillguard.functions.numeric import round_half_up
from tillguard.session import apply_engine_conf

# State names assigned by id modulo 5 in the fixture mapping.
STATE_NAMES = ["Lagos", "FCT", "Kano", "Rivers", "Oyo"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _state(idcol: Column) -> Column:
    m = idcol % len(STATE_NAMES)
    expr = None
    for i, s in enumerate(STATE_NAMES):
        expr = F.when(m == i, F.lit(s)) if expr is None else expr.when(m == i, F.lit(s))
    return expr


def _pad_id(prefix: str, idcol: Column, width: int) -> Column:
    """prefix + zero-padded id; ids wider than ``width`` are kept whole
    (``lpad`` alone would truncate them and collide at larger scales)."""
    s = idcol.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0")))


def terminal_id_of(idcol: Column) -> Column:
    return _pad_id("TRM", idcol, 5)


def merchant_id_of(idcol: Column) -> Column:
    return _pad_id("MRC", idcol, 4)


def _mapped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` mapped to transaction columns plus the helper ``_k``."""
    apply_engine_conf(spark)
    ev = read(spark, sf_dir, "events")
    ev = ev.withColumn("_k", F.get_json_object("props", "$.k").cast("int"))
    fraud_type = (F.when((F.col("event_type") == "error") & (F.col("_k") % 4 == 0), F.lit("fake_reversal"))
                  .when((F.col("event_type") == "purchase") & (F.col("value") > 120), F.lit("cloned_card"))
                  .otherwise(F.lit("")))
    ev = ev.withColumn("_fraud_type", fraud_type)
    is_fraud = F.col("_fraud_type") != ""
    lat = (F.lit(4.0) + (F.col("user_id") % 80) / 10.0
           + F.when(is_fraud, (F.col("event_id") % 10) / 10.0).otherwise(F.lit(0.0)))
    lon = F.lit(3.0) + (F.col("user_id") % 110) / 10.0
    return ev.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        terminal_id_of(F.col("user_id")).alias("terminal_id"),
        merchant_id_of(F.col("user_id") % 120).alias("merchant_id"),
        (F.lit(539980) + F.col("_k") % 10).cast("string").alias("card_bin"),
        F.col("value").alias("amount_ngn"),
        _state(F.col("user_id")).alias("state"),
        F.concat(F.lit("LGA"), (F.col("user_id") % 20).cast("string")).alias("lga"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        is_fraud.alias("is_fraud"),
        F.col("_fraud_type").alias("fraud_type"),
        F.col("event_id").alias("_event_id"),
        F.col("_k"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as card-terminal transactions (12 columns, TRANSACTION_SCHEMA)."""
    return _mapped_events(spark, sf_dir).drop("_event_id", "_k")


def model_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in model outputs per transaction: a classifier probability, a raw
    +-1 anomaly label and a scoring time 0..89 minutes after the transaction
    (so some scores fall outside the 1 h alert join)."""
    ev = _mapped_events(spark, sf_dir)
    return ev.select(
        "transaction_id",
        F.least(F.lit(1.0), round_half_up(F.col("amount_ngn") / 200.0, 4)).alias("xgboost_score"),
        F.when(F.col("_k") >= 90, F.lit(-1.0)).otherwise(F.lit(1.0)).alias("raw_anomaly"),
        (F.col("timestamp") + F.make_dt_interval(mins=(F.col("_event_id") % 90).cast("int"))).alias("scored_at"),
    )


def terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as the terminal reference table, all of it; transactions of
    terminals that it does not hold miss in the alert join."""
    apply_engine_conf(spark)
    c = read(spark, sf_dir, "customer")
    return c.select(
        terminal_id_of(F.col("c_custkey")).alias("terminal_id"),
        F.col("c_name").alias("terminal_name"),
        merchant_id_of(F.col("c_custkey") % 120).alias("merchant_id"),
        _state(F.col("c_custkey")).alias("state"),
        F.concat(F.lit("LGA"), (F.col("c_custkey") % 20).cast("string")).alias("lga"),
        (F.lit(4.0) + (F.col("c_custkey") % 80) / 10.0).alias("latitude"),
        (F.lit(3.0) + (F.col("c_custkey") % 110) / 10.0).alias("longitude"),
        F.col("c_mktsegment").alias("operator"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
    )


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``supplier`` (+ nation name as category) as the merchant reference table."""
    apply_engine_conf(spark)
    s = read(spark, sf_dir, "supplier")
    n = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    # nation is a fixed 25-row dimension: broadcasting it is bounded by construction.
    s = s.join(F.broadcast(n), "s_nationkey", "left")
    return s.select(
        merchant_id_of(F.col("s_suppkey")).alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        F.col("n_name").alias("category"),
        _state(F.col("s_suppkey")).alias("state"),
        F.concat(F.lit("LGA"), (F.col("s_suppkey") % 20).cast("string")).alias("lga"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("s_suppkey") % 1000).cast("int")).alias("registration_date"),
        (F.col("s_acctbal") < 0).alias("is_flagged"),
    )


