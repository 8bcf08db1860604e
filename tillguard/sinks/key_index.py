"""Bloom sidecar of a table's keys (SNK-1, STR-6).

An idempotent append must not add a key that the table holds, whatever its
date.  Reading the key column of the whole table for that grows with the
table.  The sidecar holds, for each file group (one append to one date) and
each of ``BUCKETS`` buckets of key hashes, a Bloom filter of the keys: some
sixteen bits a key.  An append probes its keys against the filters of their
buckets and gets the few (date, group) pairs that may hold one of them; the
exact anti-join then reads the keys of those groups only.  A false positive
costs a group to be read, never a wrong row.

A filter is written before its group's rows are, so a driver lost between the
two leaves a filter without rows, which is harmless: rows without a filter
cannot be.  Groups are known by the column ``GROUP`` of the table's rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

GROUP = "_group"
BUCKETS = 64
#: Bits for each key (rounded up to a power of two in all) and bits set by one.
KEY_BITS, HASHES = 16, 6
FILTERS = "event_date date, _group string, bucket int, n long, bits binary"


def sidecar_path(path: str) -> str:
    return f"{path.rstrip('/')}_keys"


def _hashed(df: DataFrame, key: str):
    """Bucket and two hashes of a key."""
    h = F.xxhash64(F.col(key).cast("string"))
    return df.withColumns({"bucket": F.pmod(h, F.lit(BUCKETS)).cast("int"), "_h1": F.xxhash64(F.col(key).cast("string"), F.lit(1)),
                           "_h2": F.xxhash64(F.col(key).cast("string"), F.lit(2))})


def _places(h1: np.ndarray, h2: np.ndarray, size: int) -> np.ndarray:
    """Bits of keys in a filter of ``size`` bits, a power of two."""
    with np.errstate(over="ignore"):
        a, b = h1.view(np.uint64), h2.view(np.uint64) | np.uint64(1)
        return np.stack([(a + np.uint64(i) * b) & np.uint64(size - 1) for i in range(HASHES)], axis=1).astype(np.int64)


def filters_of(rows: DataFrame, key: str) -> DataFrame:
    """A filter for each date, group and bucket of ``rows``; the hashes of one
    append, date and bucket (a ``BUCKETS``-th of them) meet in a task."""
    d = _hashed(rows.select("event_date", GROUP, key), key)
    sizes = d.groupBy("event_date", GROUP, "bucket").agg(F.count(F.lit(1)).alias("n"))
    # a filter has the same size in every task: a power of two from its number of keys
    size = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.col("n") * KEY_BITS, F.lit(64))))).cast("long")
    d = d.join(sizes.withColumn("size", size), ["event_date", GROUP, "bucket"])

    def run(key, table):
        size = table.column("size")[0].as_py()
        bits = np.zeros(size, bool)
        bits[_places(table.column("_h1").to_numpy(), table.column("_h2").to_numpy(), size).ravel()] = True
        return pa.table({"event_date": pa.array([key[0].as_py()], pa.date32()), GROUP: [key[1].as_py()], "bucket": pa.array([key[2].as_py()], pa.int32()),
                         "n": pa.array([table.num_rows], pa.int64()), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    return d.select("event_date", GROUP, "bucket", "size", "_h1", "_h2").groupBy("event_date", GROUP, "bucket").applyInArrow(run, FILTERS)


def write_filters(rows: DataFrame, path: str, key: str) -> None:
    filters_of(rows, key).write.mode("append").parquet(sidecar_path(path))


def read_filters(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(FILTERS).parquet(sidecar_path(path))
    except AnalysisException:
        return None


def groups_that_may_hold(batch: DataFrame, filters: DataFrame, key: str) -> DataFrame:
    """(event_date, group) pairs of which some key of ``batch`` may be."""
    keys = _hashed(batch.select(key), key).select("bucket", "_h1", "_h2")

    def run(key, left, right):
        h1, h2 = left.column("_h1").to_numpy(), left.column("_h2").to_numpy()
        dates, groups = [], []
        if left.num_rows:
            for date, group, bits in zip(*(right.column(c).to_pylist() for c in ("event_date", GROUP, "bits"))):
                held = np.frombuffer(bits, np.uint8)
                at = _places(h1, h2, 8 * len(held))
                if ((held[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1).any():
                    dates.append(date)
                    groups.append(group)
        return pa.table({"event_date": pa.array(dates, pa.date32()), GROUP: pa.array(groups, pa.string())})

    hits = keys.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(run, f"event_date date, {GROUP} string")
    return hits.distinct()
