"""Mixture-controlled packing of tokenised documents into fixed windows.

Each source is a queue of tokens.  Queues are served by deficit round-robin in
quanta: in every round a queue's deficit grows by its target share, a queue
whose deficit reaches the next half quantum sends one, and what it is owed is
carried into the next round, window and partition.  Because deficits are
linear in the rounds, the ``k``-th quantum of a queue with weight ``w`` is due
at time ``(k + 1/2) / w``; its place in the output is the number of quanta of
all queues that are due earlier.  So every task places its own documents from
the queue totals alone, without a scan over windows.  With more sources than
``MAX_QUEUES`` each still has its queue: the quanta are then ranked by one
range sort on (due time, source), with the same places as a result.  A queue that runs out
leaves its share to the others in proportion.  Windows are full but for the
last; each queue's rest below one quantum goes to the end.

Tokenising happens once: ids go to a Parquet table in the shared checkpoint
folder together with each row's place in its partition's queues, so placing
needs no shuffle of tokens, only prefix sums over (partition, queue) totals;
above ``MAX_QUEUES`` sources tokens move once, to meet their places.

Defined results: a null text is the empty text (only the end id); a null
source is a queue of its own; repeated rows are packed each; an empty table
gives no pieces; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillguard.operators.cumulative import global_positions, running_totals

from .common import bound_batches, gather, Recent, releasing, split_words, tokenizer_path, written

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Most queues whose totals every task holds; with more, the quanta are ranked by a sort.
MAX_QUEUES = 256
#: Quanta of one queue that are listed at once.
LISTED = 1 << 16


#: Punctuation that ends a word (a pre-token of its own), and words of letters
#: that normalisation keeps as they are.
TAIL = r"([\p{L}\p{N}])([.,;:!?*#$%&|]+)(?:[ \n]|$)"
LATIN = re.compile("[%s]+" % "".join(c for c in map(chr, range(ord("a"), 0x180)) if c.islower() and c.lower() == c and c not in "\u00aa\u00b5\u00ba")).fullmatch
#: The byte alphabet of byte-level vocabularies: printable bytes stand for
#: themselves, the others for characters from 256 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = dict(zip([b for b in range(256) if b not in _PLAIN], range(256, 512)))


class WordTokens:
    """Ids of the white-space words of texts, remembered between batches.  The
    tokenizer drops white space and joins nothing across it, so words can be
    encoded alone."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        # the same merges without normaliser and pattern, for words that need neither
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.ends = np.zeros(1 << 16, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.known = Recent(self.learn, 200_000)

    def learn_any(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint16).tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def learn_letters(self, words: list[str]) -> list[bytes]:
        """Words of lower-case Latin letters, encoded as one text and cut
        where a token ends a word."""
        if not words:
            return []
        mapped = [w.encode().decode("latin-1").translate(BYTE_CHARS) for w in words]
        ids = np.array(self.merges.encode_batch_fast([" ".join(mapped)], add_special_tokens=False)[0].ids, np.uint16)
        data, at, out = ids.tobytes(), 0, []
        for end in (2 * np.nonzero(self.ends[ids])[0] + 2).tolist():
            out.append(data[at:end])
            at = end
        if len(out) != len(words):
            raise ValueError("a word isn't one run of merges")
        return out

    def learn(self, words: list[str]) -> list[bytes]:
        """16-bit ids of words; those of Latin letters take the short way."""
        plain = [LATIN(w) is not None for w in words]
        ways = {True: iter(self.learn_letters([w for w, p in zip(words, plain) if p])),
                False: iter(self.learn_any([w for w, p in zip(words, plain) if not p]))}
        return [next(ways[p]) for p in plain]

    def encode_batch(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of each text's ids, and all ids; each text's end with ``end``.

        Lower case and a space before punctuation that follows a letter or a
        number change nothing for the tokenizer, and leave far fewer words.  Not
        so with U+0130, whose lower case is two characters: such texts stay."""
        texts = pc.fill_null(texts, "")
        plain = pc.replace_substring_regex(pc.utf8_lower(texts), TAIL, r"\1 \2 ")
        offsets, number, words = split_words(pc.if_else(pc.match_substring(texts, "\u0130"), texts, plain))
        parts = self.known.get(words)
        size = np.array([len(p) // 2 for p in parts] + [1], np.int64)
        start = np.cumsum(size) - size
        values = np.frombuffer(b"".join(parts) + np.uint16(end).tobytes(), np.uint16)
        # the end id goes after the last word of each text
        number = np.insert(number, offsets[1:], len(parts))
        sizes = size[number]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ends[offsets + np.arange(len(offsets))], gather(values, start[number], sizes)


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


def tokenise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             vocabulary: str | None = None) -> DataFrame:
    """Rows (doc_id, source, part, place, n_tokens, ids): ``ids`` are 16-bit
    little-endian and end with the end id; ``place`` counts the tokens of the
    same source before the row in partition ``part``."""
    path = vocabulary or tokenizer_path(VOCABULARY)
    bound_batches(docs.sparkSession)

    def run(batches):
        tok, part, before = word_tokens(path), TaskContext.get().partitionId(), defaultdict(int)
        for b in batches:
            doc_ids, texts, sources = b.columns
            offsets, ids = tok.encode_batch(texts, END_ID)
            sizes, places = np.diff(offsets), []
            for s, n in zip(sources.to_pylist(), sizes.tolist()):
                places.append(before[s])
                before[s] += n
            packed = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(2 * offsets), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays(
                [doc_ids, sources, pa.array([part] * len(sizes), pa.int32()), pa.array(places, pa.int64()),
                 pa.array(sizes, pa.int64()), packed.cast(pa.binary())],
                ["doc_id", "source", "part", "place", "n_tokens", "ids"])
        word_tokens.cache_clear()  # an idle worker holds no vocabulary or words

    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(source_col).cast("string").alias("source"))
    return cols.mapInArrow(releasing(run), "doc_id long, source string, part int, place long, n_tokens long, ids binary")


class Rounds:
    """Places quanta: ``totals`` tokens and target ``weights`` by queue."""

    def __init__(self, totals, weights, quantum: int):
        self.q = quantum
        self.full = np.asarray(totals, np.int64) // quantum
        self.w = np.asarray(weights, np.float64)
        rests = np.asarray(totals, np.int64) - self.full * quantum
        self.rest_at = self.full.sum() * quantum + np.cumsum(rests) - rests

    def rank(self, queue: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Number of quanta that are due before quantum ``k`` of ``queue``."""
        due = (k + 0.5) / self.w[queue]
        out = np.zeros(len(k), np.int64)
        for s, (n, w) in enumerate(zip(self.full, self.w)):
            if not n:
                continue
            # the first quantum of s that isn't earlier; the estimate is off by one at most
            first = np.maximum(np.floor(due * w - 0.5).astype(np.int64) - 1, 0)
            for _ in range(3):
                at = (first + 0.5) / w
                first += (at < due) | ((at == due) & (s < queue))
            out += np.where(queue == s, k, np.minimum(first, n))
        return out

    def pieces(self, queue: np.ndarray, start: np.ndarray, length: np.ndarray, window: int):
        """Cuts rows at ``start`` of their queue into pieces; see ``cut``."""
        def place(row, k):
            s = queue[row]
            return np.where(k < self.full[s], self.rank(s, k) * self.q, self.rest_at[s])

        return cut(start, length, self.q, window, place)


def cut(start: np.ndarray, length: np.ndarray, q: int, window: int, place):
    """Cuts rows at ``start`` of their queue into pieces: (row, start in the
    row, length, window, offset), in the rows' order.  ``place`` gives where
    quantum ``k`` of a row's queue lies."""
    first, last = start // q, (start + length - 1) // q
    n = last - first + 1
    row = np.repeat(np.arange(len(start)), n)
    k = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    lo = np.maximum(k * q, start[row])
    hi = np.minimum((k + 1) * q, (start + length)[row])
    at = place(row, k) + lo - k * q
    split = np.nonzero(at // window != (at + hi - lo - 1) // window)[0]  # only rests lie across windows
    more = (at[split] // window + 1) * window - at[split]
    row, lo, at, hi = (np.insert(row, split + 1, row[split]), np.insert(lo, split + 1, lo[split] + more),
                       np.insert(at, split + 1, at[split] + more), np.insert(hi, split, lo[split] + more))
    joins = (row[1:] == row[:-1]) & (hi[:-1] == lo[1:]) & (at[1:] == at[:-1] + hi[:-1] - lo[:-1]) & (at[1:] // window == at[:-1] // window)
    begin = np.concatenate([[True], ~joins]) if len(row) else np.zeros(0, bool)
    ends = hi[np.concatenate([~joins, [True]])] if len(row) else hi
    row, lo, at = row[begin], lo[begin], at[begin]
    return row, lo - start[row], ends - lo, at // window, at % window


def _places(rows: DataFrame, sources: DataFrame, shares: dict | None, low: float, quantum: int) -> DataFrame:
    """(p_source, p_part, p_place, at, places) for each row (source, part,
    place, n_tokens, base) of any number of queues: where the row begins in its
    queue, and where each of its quanta lies in the output."""
    spark = rows.sparkSession
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    weighed = sources.withColumn("w", F.col("n").cast("double"))
    if shares:
        targets = spark.createDataFrame([(k, float(v)) for k, v in shares.items()], "t_source string, share double")
        weighed = sources.join(targets, same("source", "t_source"), "left").withColumn(
            "w", F.greatest(F.coalesce("share", F.lit(0.0)), F.lit(low)))
    weighed = weighed.select("source", "w", F.expr(f"n div {quantum}").alias("full"), (F.col("n") % quantum).alias("rest"))
    weighed = written(weighed, "packing-weights")
    rests = running_totals(weighed.select("source", "full", "rest"), "source", ["full", "rest"]).select(
        F.col("source").alias("r_source"), (F.col("tot_full") * quantum + F.col("cum_rest") - F.col("rest")).alias("rest_at"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    lists = weighed.filter("full > 0").select("source", "w", "full", F.explode(F.expr(f"sequence(0L, (full - 1) div {LISTED})")).alias("c"))
    quanta = lists.repartition(n, "source", "c").select("source", "w", F.explode(F.expr(
        f"sequence(c * {LISTED}, least(full, (c + 1) * {LISTED}) - 1)")).alias("k"))
    due = quanta.select(F.col("source").alias("q_source"), F.col("k").alias("q_k"), ((F.col("k") + 0.5) / F.col("w")).alias("due"))
    ranked = global_positions(due, [F.col("due"), F.col("q_source").asc_nulls_first()], "rank").select("q_source", "q_k", "rank")
    needs = rows.join(rests, same("source", "r_source")).withColumn("at", F.col("base") + F.col("place"))
    needs = needs.select("source", "part", "place", "at", "rest_at", F.explode(F.expr(
        f"sequence(at div {quantum}, (at + n_tokens - 1) div {quantum})")).alias("k"))
    found = needs.join(ranked, same("source", "q_source") & (F.col("k") == F.col("q_k")), "left").withColumn(
        "lies", F.coalesce(F.col("rank") * quantum, "rest_at"))
    return found.groupBy(F.col("source").alias("p_source"), F.col("part").alias("p_part"), F.col("place").alias("p_place")).agg(
        F.first("at").alias("at"), F.transform(F.sort_array(F.collect_list(F.struct("k", "lies"))), lambda x: x["lies"]).alias("places"))


def pack(docs: DataFrame, shares: dict[str, float] | None = None, window: int = 2048, quantum: int = 128,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         vocabulary: str | None = None) -> DataFrame:
    """One row for each piece: doc_id, source, start, length, doc_tokens,
    sequence_id, offset and the piece's ids (little-endian unsigned 32-bit).

    ``shares``: target token share by source (default: the shares that the
    sources have, so that all queues run out together); a source without a
    positive share is packed after the others have run out."""
    if window % quantum:
        raise ValueError("window must be a multiple of quantum")
    spark = docs.sparkSession
    ids = written(tokenise(docs, id_col, text_col, source_col, vocabulary), "packing-ids")
    parts = ids.groupBy("source", "part").agg(F.sum("n_tokens").alias("n"))
    sources = written(parts.groupBy("source").agg(F.sum("n").alias("n")), "packing-sources")
    few = sources.limit(MAX_QUEUES + 1).count() <= MAX_QUEUES
    low = min([x for x in (shares or {}).values() if x > 0], default=1.0) * 1e-9
    # prefix sums over one row for each (partition, source), written so that the
    # planner knows their size when it chooses the join; never a hint
    base = parts.withColumn("base", F.sum("n").over(Window.partitionBy("source").orderBy("part")) - F.col("n"))
    base = base.select(F.col("source").alias("b_source"), F.col("part").alias("b_part"), "base")
    base = written(base, "packing-base")
    on_base = F.col("source").eqNullSafe(F.col("b_source")) & (F.col("part") == F.col("b_part"))

    def emit(doc_ids, srcs, sizes, tokens, row, start, length, seq, offset):
        data = [np.frombuffer(x, "<u2").astype("<u4").tobytes() for x in tokens.to_pylist()]
        ids_of = [data[r][4 * a:4 * (a + n)] for r, a, n in zip(row.tolist(), start.tolist(), length.tolist())]
        take = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [doc_ids.take(take), srcs.take(take), pa.array(start), pa.array(length), pa.array(sizes.to_numpy()[row]),
             pa.array(seq), pa.array(offset), pa.array(ids_of, pa.binary())],
            ["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    if few:
        totals = [(r.source, r.n) for r in sources.orderBy(F.col("source").asc_nulls_first()).collect()]  # MAX_QUEUES rows at most
        weights = [float(n) if not shares else max(float(shares.get(q, 0.0)), low) for q, n in totals]
        rounds = Rounds([n for _, n in totals], [w or 1.0 for w in weights], quantum)
        queue_of = {q: i for i, (q, _) in enumerate(totals)}

        def run(batches):
            for b in batches:
                doc_ids, srcs, starts, sizes, tokens = b.columns
                if b.num_rows:
                    q = np.array([queue_of[x] for x in srcs.to_pylist()], np.int64)
                    yield emit(doc_ids, srcs, sizes, tokens, *rounds.pieces(q, starts.to_numpy(), sizes.to_numpy(), window))

        placed = ids.join(base, on_base).select("doc_id", "source", (F.col("base") + F.col("place")).alias("at"), "n_tokens", "ids")
    else:
        def run(batches):
            for b in batches:
                doc_ids, srcs, starts, sizes, tokens, places = b.columns
                if b.num_rows:
                    at = places.flatten().to_numpy()
                    yield emit(doc_ids, srcs, sizes, tokens, *cut(starts.to_numpy(), sizes.to_numpy(), quantum, window, lambda row, k: at))

        rows = ids.select("source", "part", "place", "n_tokens").join(base, on_base)
        places = _places(rows, sources, shares, low, quantum)
        placed = ids.join(places, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("part") == F.col("p_part"))
                          & (F.col("place") == F.col("p_place"))).select("doc_id", "source", "at", "n_tokens", "ids", "places")

    return placed.mapInArrow(
        releasing(run), "doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def with_ids_crc32(pieces: DataFrame) -> DataFrame:
    """The pieces with the checksum of their ids instead of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def digest(docs: DataFrame) -> DataFrame:
    return with_ids_crc32(pack(docs))
