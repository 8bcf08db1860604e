"""Event decoding and batch readers (SRC-2..6, SRC-8..10)."""

from __future__ import annotations

import json
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillguard.schemas import MODEL_FRAME_SCHEMA, REQUIRED_TRANSACTION_FIELDS, TRANSACTION_SCHEMA


def wire_schema(schema: T.StructType) -> T.StructType:
    """The JSON wire form: timestamps travel as ISO-8601 text."""
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampType)
                                       else f.dataType, True) for f in schema.fields])


def parse_timestamp(c: Column | str) -> Column:
    """ISO-8601 text with or without fraction/offset -> UTC instant (NULL if
    unparseable)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(c)


def decode_json(df: DataFrame, schema: T.StructType = TRANSACTION_SCHEMA, *, value_col: str = "value",
                key_col: str | None = None, id_field: str = "transaction_id",
                required: Sequence[str] = REQUIRED_TRANSACTION_FIELDS) -> DataFrame:
    """SRC-2/SRC-6: bytes or text -> typed columns + ``is_valid``.

    Malformed JSON or a missing required field gives ``is_valid = false``
    (the row is kept so callers can route it to a dead-letter table).  With
    ``key_col`` the record key fills a missing id.
    """
    raw = F.col(value_col).cast("string")
    parsed = F.from_json(raw, wire_schema(schema), {"mode": "PERMISSIVE"})
    d = df.select(*([F.col(key_col).cast("string").alias("_key")] if key_col else []),
                  parsed.alias("_r"), raw.alias("_raw"))
    cols = []
    for f in schema.fields:
        c = F.col(f"_r.{f.name}")
        if isinstance(f.dataType, T.TimestampType):
            c = parse_timestamp(c)
        if key_col and f.name == id_field:
            c = F.coalesce(c, F.col("_key"))
        cols.append(c.alias(f.name))
    d = d.select(*cols, "_raw")
    valid = F.lit(True)
    for r in required:
        valid = valid & F.col(r).isNotNull()
    return d.withColumn("is_valid", valid).drop("_raw")


def normalize_columns(df: DataFrame) -> DataFrame:
    """SRC-8: lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def read_transactions(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """SRC-3: full table load with the declared schema (no inference);
    ISO-8601 timestamps (mixed precision/offsets) parsed to UTC."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
        ts = dict(df.dtypes).get("timestamp")
        if ts == "timestamp_ntz":
            df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        elif ts == "string":
            df = df.withColumn("timestamp", parse_timestamp("timestamp"))
        return df
    reader = spark.read.schema(wire_schema(TRANSACTION_SCHEMA))
    df = reader.json(path) if fmt == "json" else reader.option("header", True).csv(path)
    return df.withColumn("timestamp", parse_timestamp("timestamp"))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """SRC-4: header-named table reader for features/alerts/scores/reference
    tables."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    r = spark.read.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path) if fmt == "csv" else r.json(path)


def read_validation_results(spark: SparkSession, path: str) -> DataFrame:
    """SRC-10: the gate document (multi-line JSON)."""
    return spark.read.option("multiLine", True).json(path)


def read_gated_synthetic(spark: SparkSession, csv_path: str, gate: DataFrame | None, enabled: bool,
                         ) -> tuple[DataFrame, str]:
    """SRC-9: synthetic rows only when opted in *and* approved by the gate
    (``gate_document`` as read back, or the row of ``validation.approve``).

    Returns ``(rows, reason)``; rows carry the model-frame schema plus NULL
    ids and ``timestamp`` (synthetic rows have no identity).
    """
    empty = spark.createDataFrame([], MODEL_FRAME_SCHEMA)
    if not enabled:
        return _with_null_ids(empty), "synthetic augmentation not enabled"
    if gate is None:
        return _with_null_ids(empty), "no validation results"
    # the written document's key; "approved" is the column of validation.approve
    key = next((c for c in ("approved_for_training", "approved") if c in gate.columns), None)
    row = gate.first() if key else None
    if row is None or row[key] is not True:
        reasons = next((row[c] for c in ("gate_failure_reasons", "reasons") if row is not None and c in gate.columns and row[c]), None)
        return _with_null_ids(empty), "validation gate did not approve the synthetic data" + (
            f": {'; '.join(reasons)}" if reasons else "")
    rows = spark.read.option("header", True).schema(MODEL_FRAME_SCHEMA).csv(csv_path)
    return _with_null_ids(rows), "approved"


def _with_null_ids(df: DataFrame) -> DataFrame:
    return df.withColumns({**{c: F.lit(None).cast("string") for c in ("transaction_id", "terminal_id", "card_bin")},
                           "timestamp": F.lit(None).cast("timestamp")})


def to_wire_json(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rows as JSON text with ISO-8601 timestamps (the producer's wire form);
    ``keep``: columns that stand beside the text and not in it."""
    cols = [F.date_format(F.col(f.name), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias(f.name)
            if isinstance(f.dataType, T.TimestampType) else F.col(f.name) for f in df.schema.fields if f.name not in keep]
    return df.select(F.to_json(F.struct(*cols)).alias("value"), *keep)


def gate_document(approved: bool, reasons: list[str]) -> str:
    return json.dumps({"approved_for_training": approved, "gate_failure_reasons": reasons})
