"""Table sinks (SNK-1..8).

Tables are parquet folders partitioned by event date, so an idempotent append
only scans the target partitions its batch touches (partition pruning) and
never rewrites the table.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tillguard.schemas import ALERT_COLUMNS, TRANSACTION_SCHEMA

DATE_COL = "event_date"


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema  # noqa: B018
        return True
    except AnalysisException:
        return False


def with_event_date(df: DataFrame, ts_col: str) -> DataFrame:
    return df.withColumn(DATE_COL, F.to_date(F.col(ts_col)))


def append_idempotent(batch: DataFrame, path: str, key: str = "transaction_id", ts_col: str = "timestamp",
                      replay_days: int | None = None, sidecar: bool = False) -> DataFrame:
    """SNK-1/SNK-4: append only keys not yet in the table, whatever their date
    (replay-safe); duplicates inside the batch are dropped too.  Returns the
    appended rows.  ``replay_days``: replays come with dates at most this many
    days from the first's, so that only those partitions' keys are read; by
    default the key column of the whole table is.  ``sidecar`` keeps Bloom
    filters of the keys beside the table (``sinks.key_index``; from its first
    append on), and reads the keys of the file groups only that may hold one
    of the batch."""
    spark = batch.sparkSession
    b = with_event_date(batch, ts_col).dropDuplicates([key])
    if sidecar:
        return _append_with_sidecar(b, path, key)
    if _exists(spark, path):
        target = spark.read.parquet(path)
        if replay_days is not None:
            first, last = b.agg(F.min(DATE_COL), F.max(DATE_COL)).first()
            near = F.col(DATE_COL).between(F.date_sub(F.lit(first), replay_days), F.date_add(F.lit(last), replay_days))
            target = target.filter(near | F.col(DATE_COL).isNull())
        b = b.join(target.select(key), on=key, how="left_anti")
    # Fix the rows before writing: evaluated lazily afterwards, the anti-join
    # would see the rows just written.  checkpoint() writes to the shared
    # spark.checkpoint.dir, so the result survives executor loss.
    from tillguard.session import materialize
    b = materialize(b)
    # rows of a date meet in as many tasks as their bytes need, not in a file of every task
    b.hint("rebalance", DATE_COL).write.mode("append").partitionBy(DATE_COL).parquet(path)
    return b


def _append_with_sidecar(b: DataFrame, path: str, key: str) -> DataFrame:
    import uuid

    from tillguard.session import materialize
    from tillguard.sinks import key_index
    spark = b.sparkSession
    b = materialize(b)
    held = key_index.read_filters(spark, path)
    if held is None and _exists(spark, path):
        raise ValueError("the table holds rows without filters: append to it without a sidecar")
    if held is not None and _exists(spark, path):
        groups = key_index.groups_that_may_hold(b, held, key).collect()  # file groups that may hold a key: few
        if groups:
            dates = {g.event_date for g in groups}
            names = sorted({g[key_index.GROUP] for g in groups})
            near = F.col(DATE_COL).isin([d for d in dates if d is not None])
            near = near | F.col(DATE_COL).isNull() if None in dates else near
            known = spark.read.parquet(path).filter(near & F.col(key_index.GROUP).isin(names)).select(key)
            b = materialize(b.join(known, on=key, how="left_anti"))
    b = b.withColumn(key_index.GROUP, F.lit(uuid.uuid4().hex))
    key_index.write_filters(b, path, key)
    b.write.mode("append").partitionBy(DATE_COL, key_index.GROUP).parquet(path)
    return b.drop(key_index.GROUP)


def overwrite_table(df: DataFrame, path: str, ts_col: str = "timestamp") -> None:
    """SNK-2: a full recompute replaces the table; dates it no longer has go."""
    (with_event_date(df, ts_col).write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy(DATE_COL).parquet(path))


def overwrite_dates(df: DataFrame, path: str, ts_col: str = "timestamp") -> None:
    """A rebuild of some dates: replaces the partitions it covers, others stay."""
    (with_event_date(df, ts_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(DATE_COL).parquet(path))


def append_transactions(df: DataFrame, path: str) -> None:
    """SNK-3: raw transactions in the fixed column order."""
    cols = [f.name for f in TRANSACTION_SCHEMA.fields]
    with_event_date(df.select(*cols), "timestamp").write.mode("append").partitionBy(DATE_COL).parquet(path)


def fill_alert_defaults(df: DataFrame) -> DataFrame:
    """SNK-6: the 9 alert columns; missing fields NULL; alert_id and
    created_at filled when absent (deterministic id, current UTC time)."""
    cols = []
    for c in ALERT_COLUMNS:
        cols.append(F.col(c) if c in df.columns else F.lit(None).cast(
            "double" if c == "fraud_probability" else "timestamp" if c == "created_at" else "string").alias(c))
    d = df.select(*cols)
    return d.withColumns({
        "alert_id": F.coalesce(F.col("alert_id"), F.sha2(F.concat_ws("|", "transaction_id", "alert_tier"), 256)),
        "created_at": F.coalesce(F.col("created_at"), F.current_timestamp()),
    })


def append_alerts(df: DataFrame, path: str) -> DataFrame:
    return append_idempotent(fill_alert_defaults(df), path, key="alert_id", ts_col="created_at")


def keyed_json(df: DataFrame, key: str) -> DataFrame:
    """SNK-5: ``key`` (string) + JSON ``value`` of all columns, the message
    form for a topic sink."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def publish_keyed_json(df: DataFrame, key: str, topic: str, servers: str) -> None:
    """Write the keyed JSON form to a Kafka topic (needs the Kafka connector)."""
    (keyed_json(df, key).write.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("topic", topic).save())


def dual_write(batch: DataFrame, table_path: str, publish: Callable[[DataFrame], None] | None,
               key: str = "transaction_id", ts_col: str = "scored_at") -> tuple[DataFrame, str | None]:
    """SNK-7: table append and topic publish from one batch; a publishing
    failure never blocks the table write.  Returns (appended rows, error)."""
    appended = append_idempotent(batch, table_path, key=key, ts_col=ts_col)
    err = None
    if publish is not None:
        try:
            publish(appended.drop(DATE_COL))
        except Exception as e:  # noqa: BLE001 - best effort, like the reference publisher
            err = f"{type(e).__name__}: {e}"
    return appended, err


def write_synthetic(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """SNK-8: synthetic rows as CSV with header."""
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_validation_results(document: DataFrame, path: str) -> None:
    """SNK-8: the nested results document (``validation.results_document``, one
    row) as JSON; ``read_validation_results`` reads it back."""
    document.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def dataset_card(real: DataFrame, synth: DataFrame, label: str = "is_fraud") -> DataFrame:
    """SNK-8 card: record counts and fraud rates of both datasets."""
    def rates(d, name):
        y = F.col(label).cast("int")
        return d.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(y.cast("double")).alias("fraud_rate")).select(
            F.lit(name).alias("dataset"), "*")
    return rates(real, "real").unionByName(rates(synth, "synthetic"))
