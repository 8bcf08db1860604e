"""Feature stream with state, late rows and corrections (STR-3, STR-7).

A trailing value belongs to a key and a second (rows of one second are peers),
so the state of a key holds *panes*, one exact partial sum for each second,
and not rows; only ``geo_jump_km`` needs rows, those that a late row may still
come next to.  Two operators run on ``applyInPandasWithState``:

* terminals, keyed by ``terminal_id``: velocity, reversals, previous place;
  there are many, most with few rows, so a state holds a group of them and a
  task's cost is in its rows, not in its calls;
* card BINs, keyed by (``card_bin``, bucket of seconds): mean amount.  There
  are few BINs and one may hold a third of all rows, so a row goes to its
  bucket and, near its end, to the next one as context.

Times: ``horizon`` is the watermark's delay, how late a row may come at all;
``delay`` is how long a second waits for late rows before its values go out
(``None``: they go out at once).  Panes that wait are *pending* and leave by
an event-time timer.  A row that comes after its second went out is *late*:
every value that it changes goes out again as a correction with the old and
the new value.  First values with all corrections applied are the batch
features, whatever the order of arrival; rows behind the watermark are not
taken, and are counted by ``rows_dropped_by_watermark``.  A key's state is
evicted to the longest window behind the watermark (and, for terminals, to
the last row before it, which is the next row's previous place).

Sums are integers in units of 2**-60, so a value does not depend on the order
of arrival and a correction is a real change; amounts are finite.  The source
must hold each transaction once: read the transaction table that
``append_idempotent`` writes.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from itertools import accumulate
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from tillguard.functions import amount_vs_bin_avg_ratio, is_reversal
from tillguard.functions.geo import EARTH_RADIUS_KM
from tillguard.operators.trailing import BUCKET, explode_to_buckets, null_safe_left_join, with_epoch_seconds
from tillguard.plans.features import DAY, FEATURE_OUTPUT, HOUR
from tillguard.schemas import TRANSACTION_SCHEMA
from tillguard.sinks.tables import DATE_COL

UNIT = 2.0 ** 60
CHANGES = ("feature string, key string, sec long, transaction_id string, kind string, late boolean, "
           "old_value double, new_value double, version long")
CHANGE_COLUMNS = [c.split()[0] for c in CHANGES.split(", ")]


@dataclass(frozen=True)
class Value:
    """``how`` (count, sum or mean) of a pane's ``n`` and ``s`` over ``lookback`` seconds."""
    feature: str
    how: str
    lookback: int


@dataclass(frozen=True)
class Keyed:
    """A keyed operator: its key column, the width of its buckets (None: the
    key is not cut), what its panes sum, its values, whether it holds rows, and
    the number of groups that its keys are dealt to (None: a key is a group)."""
    key: str
    bucket_seconds: int | None
    count_of: str
    sum_of: str
    values: tuple[Value, ...]
    places: bool = False
    groups: int | None = None

    @property
    def lookback(self) -> int:
        return max(v.lookback for v in self.values)

    @property
    def row_columns(self) -> list[str]:
        return ["_sec", "_n", "_s", *(["_micros", "transaction_id", "latitude", "longitude"] if self.places else [])]


TERMINALS = Keyed("terminal_id", None, "transaction_id", "_reversal",
                  (Value("velocity_1h", "count", HOUR), Value("terminal_reversal_count", "sum", DAY)), places=True, groups=1024)
BINS = Keyed("card_bin", 4 * HOUR, "amount_ngn", "amount_ngn", (Value("bin_spend_rate", "mean", HOUR),))


def _distance(lat1, lon1, lat2, lon2) -> float | None:
    if None in (lat1, lon1, lat2, lon2):
        return None
    a = (math.sin((math.radians(lat2) - math.radians(lat1)) / 2) ** 2
         + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin((math.radians(lon2) - math.radians(lon1)) / 2) ** 2)
    return 2.0 * EARTH_RADIUS_KM * math.asin(math.sqrt(min(1.0, a)))


def _plain(x):
    return None if x is None or x != x else x


class KeyState:
    """State of one key: panes {second: [n, s]}, values that went out and may
    still change, rows with their places, and the version of the last change."""

    def __init__(self, text: str | None):
        held = json.loads(text) if text else {}
        self.panes = {int(k): v for k, v in held.get("panes", {}).items()}
        self.out = {int(k): v for k, v in held.get("out", {}).items()}
        self.late = set(held.get("late", []))
        self.rows = [tuple(r) for r in held.get("rows", [])]  # (second, micros, id, latitude, longitude)
        self.jumps = held.get("jumps", {})
        self.late_ids = set(held.get("late_ids", []))
        self.version = held.get("version", 0)

    def text(self) -> str:
        return json.dumps({"panes": self.panes, "out": self.out, "late": sorted(self.late), "rows": self.rows, "jumps": self.jumps,
                           "late_ids": sorted(self.late_ids), "version": self.version})

    def empty(self) -> bool:
        return not self.panes and not self.rows

    def add(self, op: Keyed, frame: pd.DataFrame, gone_out: int) -> set[int]:
        """Takes rows in; the seconds they touch.  Seconds before ``gone_out`` are late."""
        return self.take(op, list(zip(*(frame[c].tolist() for c in op.row_columns))), gone_out)

    def take(self, op: Keyed, rows: Sequence[tuple], gone_out: int) -> set[int]:
        """``add`` for rows of ``op.row_columns``."""
        touched = set()
        for sec, n, s, *_ in rows:
            pane = self.panes.get(sec)
            if pane is None:
                pane = self.panes[sec] = [0, 0]
                if sec < gone_out:
                    self.late.add(sec)
            pane[0] += n
            if s is not None and s == s:
                pane[1] += int(s * UNIT)
            touched.add(sec)
        if op.places:
            new = [(a, b, i, _plain(x), _plain(y)) for a, _, _, b, i, x, y in rows]
            self.late_ids.update(r[2] for r in new if r[0] < gone_out)
            self.rows = sorted(self.rows + new, key=lambda r: r[:3])
        return touched

    def values(self, op: Keyed, seconds: Sequence[int]) -> dict[int, list]:
        at = sorted(self.panes)
        n = [0, *accumulate(self.panes[s][0] for s in at)]
        total = [0, *accumulate(self.panes[s][1] for s in at)]
        got = {}
        for sec in seconds:
            hi, row = bisect_right(at, sec), []
            for v in op.values:
                lo = bisect_left(at, sec - v.lookback)
                count, amount = n[hi] - n[lo], total[hi] - total[lo]
                row.append(float(count) if v.how == "count" else amount / int(UNIT) if v.how == "sum"
                           else amount / (count * int(UNIT)) if count else None)
            got[sec] = row
        return got

    def revise(self, op: Keyed, touched: set[int], due: int, open_from: int, own) -> list[tuple]:
        """Values of seconds before ``due`` that were not out yet, and of those
        that a touched second changed; ``open_from``: earlier ones are closed."""
        changes, at = [], sorted(self.panes)
        ask = {s for s in at if open_from <= s < due and s not in self.out and own(s)}
        done = 0  # panes before it were asked for: windows of near seconds share theirs
        for t in sorted(touched):
            upto = bisect_right(at, t + op.lookback)
            ask.update(s for s in at[max(done, bisect_left(at, t)):upto] if open_from <= s < due and own(s))
            done = max(done, upto)
        for sec, row in sorted(self.values(op, sorted(ask)).items()):
            old = self.out.get(sec)
            for i, v in enumerate(op.values):
                if old is None or old[i] != row[i]:
                    changes.append((v.feature, sec, None, "first" if old is None else "correction", sec in self.late,
                                    None if old is None else old[i], row[i]))
            self.out[sec] = row
        if op.places:
            for before, r in zip([None, *self.rows], self.rows):
                if not open_from <= r[0] < due:
                    continue
                jump = 0.0 if before is None or before[3] is None else _distance(before[3], before[4], r[3], r[4])
                known = r[2] in self.jumps
                if not known or self.jumps[r[2]] != jump:
                    changes.append(("geo_jump_km", r[0], r[2], "correction" if known else "first", r[2] in self.late_ids,
                                    self.jumps.get(r[2]), jump))
                    self.jumps[r[2]] = jump
        return changes

    def evict(self, op: Keyed, open_from: int) -> None:
        """Drops what no row at or after ``open_from`` can read or change."""
        self.panes = {s: p for s, p in self.panes.items() if s >= open_from - op.lookback}
        self.out = {s: v for s, v in self.out.items() if s >= open_from}
        self.late = {s for s in self.late if s >= open_from}
        closed = bisect_left(self.rows, open_from, key=lambda r: r[0])
        for r in self.rows[:closed]:
            self.jumps.pop(r[2], None)
            self.late_ids.discard(r[2])
        self.rows = self.rows[max(0, closed - 1):]  # the last closed row is the next row's previous place


def _held(text: str | None) -> dict:
    """The keys of a group's state: {key: (wake, the key's state as text)}."""
    if text is None:
        return {}
    head, *texts = text.split("\n")  # JSON text has no line ends of its own
    return {k: (wake, t) for (k, wake), t in zip(json.loads(head), texts)}


def _held_text(held: dict) -> str:
    return "\n".join([json.dumps([[k, wake] for k, (wake, _) in held.items()]), *(t for _, t in held.values())])


def _stepper(op: Keyed, delay: int | None, horizon: int):
    def one(text, rows, watermark, bucket):
        """A key's state once ``rows`` came (none: its timer ran out), its next wake and its changes."""
        held = KeyState(text)
        seen = watermark + horizon * 1000 if watermark > 0 else 0  # the greatest event time of earlier batches
        open_from = max(0, watermark) // 1000
        out_before = max(0, seen - (delay or 0) * 1000) // 1000  # seconds before this one are whole and out
        own = (lambda s: s // op.bucket_seconds == bucket) if op.bucket_seconds else (lambda s: True)
        touched = held.take(op, rows, out_before) if rows else set()
        due = out_before if delay is not None else 1 << 62
        changes = held.revise(op, touched, due, open_from, own)
        if changes:
            held.version += 1
        held.evict(op, open_from)
        if held.empty():
            return None, None, held.version, changes
        waiting = [s for s in held.panes if s >= due and own(s)]
        if waiting:  # goes out when the clock has passed its second
            wake = (min(waiting) + 1 + delay - horizon) * 1000
        elif held.panes:  # shrinks when nothing can read its last pane
            wake = (max(held.panes) + op.lookback + 1) * 1000
        else:
            wake = None
        return held.text(), None if wake is None else max(wake, watermark + 1, 1), held.version, changes

    def step(key, frames, state):
        watermark = state.getCurrentWatermarkMs()
        held = _held(state.get[0] if state.exists else None)
        came: dict = {}
        if not state.hasTimedOut:
            for frame in frames:
                for k, *row in zip(*(frame[c].tolist() for c in (op.key, *op.row_columns))):
                    came.setdefault(k, []).append(row)
        woken = [k for k, (wake, _) in held.items() if k not in came and wake is not None and wake < watermark]
        out = []
        for k in (*came, *woken):
            text, wake, version, changes = one(held.pop(k, (None, None))[1], came.get(k), watermark, key[-1])
            if text is not None:
                held[k] = (wake, text)
            out.extend((*change, k, version) for change in changes)
        if not held:
            state.remove()
        else:
            state.update((_held_text(held),))
            wakes = [wake for wake, _ in held.values() if wake is not None]
            if wakes:
                state.setTimeoutTimestamp(max(min(wakes), watermark, 1))
        if out:
            columns = dict(zip(("feature", "sec", "transaction_id", "kind", "late", "old_value", "new_value", "key", "version"), zip(*out)))
            columns.update({c: np.array([np.nan if v is None else v for v in columns[c]], float) for c in ("old_value", "new_value")})
            yield pd.DataFrame(columns, columns=CHANGE_COLUMNS)

    return step


def value_changes(tx: DataFrame, op: Keyed, *, delay: int | None = None, horizon: int = 2 * DAY) -> DataFrame:
    """Streaming changes (``CHANGES``) of an operator's values."""
    if delay is not None and delay > horizon:
        raise ValueError("delay must not go beyond the horizon")
    d = with_epoch_seconds(tx.withColumn("_reversal", is_reversal("fraud_type"))).withWatermark("timestamp", f"{horizon} seconds")
    keys = [op.key]
    if op.groups:
        d, keys = d.withColumn("_group", F.pmod(F.xxhash64(op.key), F.lit(op.groups))), ["_group"]
    if op.bucket_seconds:
        d = explode_to_buckets(d, "_sec", op.bucket_seconds, op.lookback)
        keys.append(BUCKET)
    places = ["transaction_id", "latitude", "longitude"] if op.places else []
    d = d.select(*dict.fromkeys([*keys, op.key]), "timestamp", "_sec", F.unix_micros("timestamp").alias("_micros"), *places,
                 F.when(F.col(op.count_of).isNotNull(), F.lit(1)).otherwise(F.lit(0)).alias("_n"),
                 F.col(op.sum_of).cast("double").alias("_s"))
    return d.groupBy(*keys).applyInPandasWithState(_stepper(op, delay, horizon), CHANGES, "state string", "append",
                                                   GroupStateTimeout.EventTimeTimeout)


def transaction_table_stream(spark: SparkSession, path: str) -> DataFrame:
    """A transaction table (``append_idempotent``) as a stream of its new rows."""
    return spark.readStream.schema(f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in TRANSACTION_SCHEMA.fields)}, "
                                   f"{DATE_COL} date").parquet(path).drop(DATE_COL)


def run_corrected_features(spark: SparkSession, transactions_path: str, base: str, *, delay: int | None = None,
                           horizon: int = 2 * DAY, available_now: bool = True) -> list:
    """Starts both operators over a transaction table; changes go to
    ``base/terminal_id`` and ``base/card_bin``.  Started again with the same
    base they go on from their checkpoints."""
    started = []
    for op in (TERMINALS, BINS):
        w = (value_changes(transaction_table_stream(spark, transactions_path), op, delay=delay, horizon=horizon)
             .writeStream.format("parquet").option("path", f"{base}/{op.key}").option("checkpointLocation", f"{base}/_checkpoint_{op.key}")
             .outputMode("append"))
        started.append((w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")).start())
    return started


def changes(spark: SparkSession, base: str) -> DataFrame:
    """All changes of both operators so far."""
    return spark.read.schema(CHANGES).parquet(f"{base}/{TERMINALS.key}").unionByName(
        spark.read.schema(CHANGES).parquet(f"{base}/{BINS.key}"))


def corrected_features(transactions: DataFrame, done: DataFrame) -> DataFrame:
    """Features of the transactions whose values went out: first values with
    their corrections applied, in the batch's columns."""
    def latest(features, by):
        return done.filter(F.col("feature").isin(list(features))).groupBy(*by).agg(
            *[F.max_by("new_value", F.when(F.col("feature") == f, F.col("version"))).alias(f) for f in features],
            F.lit(True).alias(f"_{features[0]}"))

    d = with_epoch_seconds(transactions)
    for op in (TERMINALS, BINS):
        names = [v.feature for v in op.values]
        d = null_safe_left_join(d, latest(names, ["key", "sec"]).withColumnsRenamed({"key": op.key, "sec": "_sec"}), [op.key, "_sec"])
    d = d.join(latest(["geo_jump_km"], ["transaction_id"]), "transaction_id", "left")
    d = d.filter("_velocity_1h AND _bin_spend_rate AND _geo_jump_km").withColumns({
        "velocity_1h": F.col("velocity_1h").cast("long"), "terminal_reversal_count": F.col("terminal_reversal_count").cast("long"),
        "amount_vs_bin_avg_ratio": amount_vs_bin_avg_ratio("amount_ngn", "bin_spend_rate")})
    return d.select(*FEATURE_OUTPUT)


def late_transactions(done: DataFrame) -> DataFrame:
    """Ids of transactions that came after their second had gone out."""
    return done.filter((F.col("feature") == "geo_jump_km") & (F.col("kind") == "first") & F.col("late")).select("transaction_id", "sec")


def change_counts(done: DataFrame) -> DataFrame:
    """First values, those of late seconds or rows, and corrections, by feature."""
    kind = lambda k: F.count(F.when(F.col("kind") == k, 1))
    return done.groupBy("feature").agg(
        kind("first").alias("n_first"), F.count(F.when((F.col("kind") == "first") & F.col("late"), 1)).alias("n_late"),
        kind("correction").alias("n_corrections"))
