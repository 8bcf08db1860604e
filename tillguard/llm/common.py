"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillguard.session import checkpoint_path

#: A word is a run of characters other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession, rows: int = 4096, size: int = 8 << 20) -> None:
    """At most ``rows`` rows and about ``size`` bytes in an Arrow batch, so that
    batches of long texts stay within a Python worker's memory."""
    for key, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{key}"
        now = int(spark.conf.get(key).rstrip("b"))
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def without(df: DataFrame, names, keep: str) -> DataFrame:
    """``df`` without the columns that an operator is about to add (names
    compare without case); its own input column ``keep`` can't be one."""
    names = {n.lower() for n in names}
    if keep.lower() in names:
        raise ValueError(f"the input column {keep!r} has the name of an output")
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in names])


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder of the shared checkpoint folder (``spark.checkpoint.dir``)."""
    return checkpoint_path(spark, f"llm/{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read back:
    cuts the lineage, and a lost executor takes nothing with it."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tokenizer_path(name: str) -> str:
    """Path of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return os.path.abspath(public_tokenizers.path(name))


def releasing(run):
    """A task function that hands the memory it used back to the system when
    it ends: idle workers live on between stages, next to busy ones."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library: nothing to trim
                pass

    return wrapped


class Recent:
    """Values of recent keys, two generations of about ``limit`` entries at
    most; ``make`` turns a list of unknown keys into their values."""

    def __init__(self, make, limit: int = 150_000):
        self.make, self.limit = make, limit
        self.new: dict = {}
        self.old: dict = {}

    def clear(self) -> None:
        self.new, self.old = {}, {}

    def get(self, keys: list) -> list:
        new, old = self.new, self.old
        out = list(map(new.get, keys))
        ask = []
        for i in [i for i, x in enumerate(out) if x is None]:
            x = old.get(keys[i])
            if x is None:
                ask.append(i)
            else:
                out[i] = new[keys[i]] = x
        if ask:
            for i, x in zip(ask, self.make([keys[i] for i in ask])):
                out[i] = x
                if len(keys[i]) <= 256:
                    new[keys[i]] = x
        if len(new) > self.limit:
            self.old, self.new = new, {}
        return out


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words of a column of texts (null: none): offsets of each text's words,
    the number of each word, and the distinct words by number.  A word of no
    letters stands where white space begins or ends a text."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()


def char_grams(words: list[str], sizes: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the character n-grams of words between boundary marks,
    and the number of the word each is from."""
    codes = np.frombuffer("".join([f"\x02{w}\x03" for w in words]).encode("utf-32-le"), np.uint32)
    word = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    out, of = [], []
    for n in sizes:
        last = len(codes) - n + 1
        if last <= 0:
            continue
        h = np.full(last, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for j in range(n):
            h = (h ^ codes[j:last + j]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(13)
        within = word[:last] == word[n - 1:]
        out.append((h % np.uint32(buckets))[within])
        of.append(word[:last][within])
    if not out:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(of)


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[s:s + n] for each start and size, one after another."""
    ends = np.cumsum(sizes)
    at = np.repeat(starts - (ends - sizes), sizes)
    at += np.arange(len(at))
    return values[at]


def sorted_groups(batches, keys: list[str], rows: int = 4096):
    """Runs of whole groups from batches that are sorted by ``keys``: dicts of
    columns (numpy, or lists for binary) with ``starts``, the groups' offsets
    and the end.  A run is handed out once it has ``rows`` rows."""
    held: list[pa.RecordBatch] = []

    def columns(t: pa.Table) -> dict:
        out = {}
        for name in t.column_names:
            c = t.column(name).combine_chunks()
            out[name] = c.to_pylist() if pa.types.is_binary(c.type) else c.to_numpy(zero_copy_only=False)
        change = np.zeros(max(0, t.num_rows - 1), bool)
        for k in keys:
            change |= out[k][1:] != out[k][:-1]
        out["starts"] = np.concatenate([[0], np.nonzero(change)[0] + 1, [t.num_rows]]) if t.num_rows else np.zeros(1, np.int64)
        return out

    def last_start(t: pa.Table) -> int:
        same = np.ones(t.num_rows, bool)
        for k in keys:
            v = t.column(k).to_numpy()
            same &= v == v[-1]
        return int(np.argmin(same[::-1])) and t.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0

    n = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n >= rows:
            t = pa.Table.from_batches(held)
            cut = last_start(t)  # the last group may go on in the next batch
            if cut:
                yield columns(t.slice(0, cut))
                t = t.slice(cut)
            held, n = t.to_batches(), t.num_rows
    if held:
        yield columns(pa.Table.from_batches(held))
