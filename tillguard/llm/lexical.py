"""Ranked lexical search with bit-sliced Bloom signatures.

The index is a written table of blocks.  A block holds up to ``BLOCK_DOCS``
documents of like numbers of terms; its signature has one row for each bit of
a Bloom filter and one column for each document.  A term enters at its own
bits once for each step of ``STEPS`` that its count reaches.  For an item, the
AND of a term's rows is the set of documents that may hold it (as often); the
sums of what those terms add at most are upper bounds of all scores of the
block.  A first pass scores the documents of each task with the highest bounds
exactly; the k-th best of all of them is the item's floor.  A second pass
scores exactly every document whose bound reaches the floor: all but those
that provably lie below it.  A block also holds its documents' texts, so no
text moves after the index is written.

Items are searched in blocks of at most ``ITEM_TERMS`` (item, term) pairs, so
what goes to the tasks is bounded however many items there are.

Defined results: a null or empty text has no terms; texts of any length are
taken whole; an item without known terms, or whose terms no document holds,
has no rows; repeated documents and items are ranked each by themselves;
equal scores are ranked by document id, null ids last; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, releasing, scratch, split_words, written

#: Other ASCII than letters and digits parts terms; A to Z are lower-cased.
FOLD = bytes(c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 0x20 for c in range(256))
#: Counts at which a term enters the signature again.
STEPS = (1, 2, 4, 8)
#: Signature bits for each entry (up to twice as many), bits set by one entry.
ENTRY_BITS, HASHES = 8, 3
#: Documents of a block, and bits of its signature at most (one document apart).
BLOCK_DOCS, BLOCK_BITS = 1024, 1 << 25
#: (item, term) pairs that are searched at once.
ITEM_TERMS = 1 << 20
#: A document's length norm: m = 10 + (90 * n * N) div L.
M_LEAST, M_SHARE = 10, 90
GOLD = np.uint64(0x9E3779B97F4A7C15)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What one unit of a term's weight adds at a count of ``tf``."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def norm(n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """m of documents of n terms."""
    if int(n.max(initial=0)) * n_docs * M_SHARE < 1 << 62:
        return M_LEAST + (M_SHARE * n * n_docs) // max(total, 1)
    return np.array([M_LEAST + (M_SHARE * int(x) * n_docs) // max(total, 1) for x in n], np.int64)


def folded(texts: pa.Array) -> pa.Array:
    """Texts with A-Z lower-cased and a space for each character that parts terms."""
    return pa.array([None if t is None else t.encode().translate(FOLD).decode() for t in texts.to_pylist()], pa.large_string()).cast(pa.string())


def counted(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """(n of each text; text, term and count of each distinct pair, by text;
    terms) of folded texts."""
    offsets, numbers, terms = split_words(texts)
    n = np.diff(offsets)
    real = np.array([bool(t) for t in terms], bool)
    text = np.repeat(np.arange(len(n)), n)
    keep = real[numbers] if len(numbers) else np.zeros(0, bool)
    text, numbers = text[keep], numbers[keep]
    n = np.bincount(text, minlength=len(n)).astype(np.int64)
    pairs, tf = np.unique(text * max(len(terms), 1) + numbers, return_counts=True)
    return n, pairs // max(len(terms), 1), pairs % max(len(terms), 1), tf.astype(np.int64), terms


def hashes(terms: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(terms, object), categorize=False) if terms else np.zeros(0, np.uint64)


def bits(h: np.ndarray, step: np.ndarray, width: int) -> np.ndarray:
    """Bits of entries (hash, step) in a signature of ``width`` bits, a power of two."""
    with np.errstate(over="ignore"):
        x = (h + step.astype(np.uint64)) * GOLD
        x ^= x >> np.uint64(29)
        y = (x * np.uint64(0xBF58476D1CE4E5B9)) | np.uint64(1)
        y ^= (y >> np.uint64(32)) << np.uint64(1)
        return np.stack([((x + np.uint64(i) * y) >> np.uint64(7)) & np.uint64(width - 1) for i in range(HASHES)], axis=-1).astype(np.int64)


def _blocks(batch: pa.RecordBatch):
    """Blocks (ids, n, most, width, slices, texts) of a batch (id, text)."""
    texts = folded(batch.column(1))
    n, text, term, tf, terms = counted(texts)
    if not len(text):
        return
    h = hashes(terms)[term]
    steps = [np.nonzero(tf >= s)[0] for s in STEPS]
    at = np.concatenate(steps)
    step = np.repeat(np.arange(len(STEPS)), [len(s) for s in steps])
    owner = text[at]
    entries = np.bincount(owner, minlength=len(n))
    most = np.zeros(len(n), np.int64)
    np.maximum.at(most, text, tf)
    wide = np.where(entries > 0, np.ceil(np.log2(np.maximum(entries, 8))).astype(np.int64), -1)
    for w in np.unique(wide[wide >= 0]):
        width = ENTRY_BITS << int(w)
        docs = np.nonzero(wide == w)[0]
        size = max(1, min(BLOCK_DOCS, BLOCK_BITS // width))
        place = np.full(len(n), -1)
        place[docs] = np.arange(len(docs))
        own = np.nonzero(place[owner] >= 0)[0]
        rows = bits(h[at[own]], step[own], width)
        column = place[owner[own]]
        for i in range(0, len(docs), size):
            some = docs[i:i + size]
            signature = np.zeros((width, len(some)), bool)
            inside = (column >= i) & (column < i + size)
            signature[rows[inside].ravel(), np.repeat(column[inside] - i, HASHES)] = True
            yield (batch.column(0).take(pa.array(some)), n[some], most[some], width, np.packbits(signature, axis=1).tobytes(),
                   [zlib.compress(texts[int(d)].as_py().encode(), 1) for d in some])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written index: one row for each block."""
    bound_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for ids, n, most, width, slices, texts in _blocks(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([n], pa.list_(pa.int64())), pa.array([most], pa.list_(pa.int64())),
                     pa.array([width], pa.int64()), pa.array([slices], pa.binary()), pa.array([texts], pa.list_(pa.binary()))],
                    ["ids", "n", "most", "width", "slices", "texts"])

    return written(docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        releasing(run), "ids array<bigint>, n array<bigint>, most array<bigint>, width long, slices binary, texts array<binary>"), "lexical-index")


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Written (item, item_id, term): each item's terms once; ``item`` tells rows apart."""
    def run(batches):
        for batch in batches:
            _, text, term, _, terms = counted(folded(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(text)), batch.column(1).take(pa.array(text)),
                 pa.array(terms, pa.string()).take(pa.array(term))], ["item", "item_id", "term"])

    id_type = items.schema[id_col].dataType.simpleString()
    rows = written(items.select(F.monotonically_increasing_id().alias("item"), F.col(f"`{id_col}`").alias("item_id"),
                                F.col(f"`{text_col}`").alias("text")), "lexical-items")
    return written(rows.mapInArrow(releasing(run), f"item long, item_id {id_type}, term string"), "lexical-item-terms")


def _texts_of(block: dict, places: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Distinct texts of some documents of a block, and which each has."""
    coded = pa.array([block["texts"][int(p)] for p in places], pa.binary()).dictionary_encode()
    return pa.array([zlib.decompress(t).decode() for t in coded.dictionary.to_pylist()], pa.string()), coded.indices.to_numpy()


def frequencies(index: DataFrame, terms: list[str]) -> tuple[dict[str, int], int, int]:
    """(df by term, N, L): exact counts over all documents; tasks hand out one
    row for each term they met."""
    known = pa.array(terms, pa.string())

    def run(batches):
        df, docs, total = np.zeros(len(terms), np.int64), 0, 0
        for batch in batches:
            for block in batch.to_pylist():
                docs, total = docs + len(block["n"]), total + sum(block["n"])
                if not len(terms):
                    continue
                coded, which = _texts_of(block, np.arange(len(block["n"])))
                copies = np.bincount(which, minlength=len(coded))
                _, text, term, _, found = counted(coded)
                at = pc.fill_null(pc.index_in(pa.array(found, pa.string()), known), -1).to_numpy(zero_copy_only=False).astype(np.int64)[term]
                df += np.bincount(at[at >= 0], weights=copies[text[at >= 0]], minlength=len(terms)).astype(np.int64)
        hit = np.nonzero(df)[0]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([hit, [-1, -2]])), pa.array(np.concatenate([df[hit], [docs, total]]))], ["t", "c"])

    rows = index.select("n", "texts").mapInArrow(releasing(run), "t long, c long").groupBy("t").agg(F.sum("c").alias("c")).collect()
    count = {r.t: r.c for r in rows}  # one row a term of this block of items
    return {t: count.get(i, 0) for i, t in enumerate(terms)}, count.get(-1, 0), count.get(-2, 0)


class Items:
    """Some items: their terms' hashes and weights, one row a distinct term."""

    def __init__(self, items: dict, df: dict, n_docs: int, total: int):
        self.n_docs, self.total = n_docs, total
        self.terms = sorted({t for _, ts in items.values() for t in ts if df[t] and weight(n_docs, df[t])})
        at = {t: i for i, t in enumerate(self.terms)}
        self.weight = np.array([weight(n_docs, df[t]) for t in self.terms], np.int64)
        self.hash = hashes(self.terms)
        self.known = pa.array(self.terms, pa.string())
        self.keys = list(items)
        self.of = [np.array([at[t] for t in items[k][1] if t in at], np.int64) for k in self.keys]


def upper_bounds(block: dict, items: Items) -> np.ndarray:
    """Upper bounds of the scores, items by documents: for each term and step,
    its documents by the AND of signature rows, and what a count below the
    next step adds at most."""
    n = np.array(block["n"], np.int64)
    docs, width = len(n), block["width"]
    slices = np.frombuffer(block["slices"], np.uint8).reshape(width, -1)
    m, most = norm(n, items.n_docs, items.total), np.array(block["most"], np.int64)
    steps = [s for s in range(len(STEPS)) if STEPS[s] <= int(most.max())]
    # what a count in [step, next step) adds at most, as rises over the step below
    tops = [gain(np.minimum(most, STEPS[s + 1] - 1) if s + 1 < len(STEPS) else most, m) for s in steps]
    rises = [t - (tops[i - 1] if i else 0) for i, t in enumerate(tops)]
    out = np.zeros((len(items.keys), docs), np.float64)
    for lo in range(0, len(items.terms), 2048):
        hi = min(lo + 2048, len(items.terms))
        for s, rise in zip(steps, rises):
            rows = bits(items.hash[lo:hi], np.full(hi - lo, s), width)
            maybe = slices[rows[:, 0]]
            for i in range(1, HASHES):
                maybe = maybe & slices[rows[:, i]]
            some = np.nonzero(maybe.any(axis=1))[0]
            if not len(some):
                continue
            held = np.zeros((hi - lo, docs), np.float32)
            held[some] = np.unpackbits(maybe[some], axis=1, count=docs) * items.weight[lo:hi][some, None].astype(np.float32)
            has = np.zeros(hi - lo, bool)
            has[some] = True
            for i, of in enumerate(items.of):
                own = of[(of >= lo) & (of < hi)] - lo
                own = own[has[own]]
                if len(own):
                    out[i] += held[own].sum(axis=0, dtype=np.float64) * rise
    return out


def exact(block: dict, items: Items, item: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Exact scores of (item, document) pairs of a block, by item; a text is read once."""
    docs, at = np.unique(place, return_inverse=True)
    texts, which = _texts_of(block, docs)
    _, text, term, tf, found = counted(texts)
    known = pc.fill_null(pc.index_in(pa.array(found, pa.string()), items.known), -1).to_numpy(zero_copy_only=False).astype(np.int64)[term] if len(found) else term
    counts = [dict() for _ in range(len(texts))]
    for t, k, c in zip(text[known >= 0].tolist(), known[known >= 0].tolist(), tf[known >= 0].tolist()):
        counts[t][k] = c
    m = norm(np.array(block["n"], np.int64)[docs], items.n_docs, items.total)
    same, first, back = np.unique(item * len(texts) + which[at], return_index=True, return_inverse=True)
    out = np.zeros(len(same), np.int64)
    for j, (i, d) in enumerate(zip(item[first].tolist(), at[first].tolist())):
        have = counts[int(which[d])]
        pairs = [(t, have[t]) for t in items.of[i].tolist() if t in have]
        if pairs:
            t, c = np.array(pairs, np.int64).T
            out[j] = int((items.weight[t] * gain(c, m[d])).sum())
    return out[back]


def _scored(index: DataFrame, items: Items, floors: np.ndarray | None, k: int) -> DataFrame:
    """Each task's best rows (item, doc_id, score).  Without floors the
    documents of the highest bounds of each block are scored, as long as these
    reach the task's own k-th best score; with floors, all that reach them."""
    def run(batches):
        best: list[list] = [[] for _ in items.keys]  # (-score, id is null, id) of the task's best
        for batch in batches:
            for block in batch.to_pylist():
                bound = upper_bounds(block, items)
                least = np.array([-b[-1][0] if len(b) == k else 1 for b in best], np.float64)
                if floors is None:
                    top = np.argsort(-bound, axis=1, kind="stable")[:, :k]
                    chosen = np.zeros(bound.shape, bool)
                    np.put_along_axis(chosen, top, True, axis=1)
                    chosen &= bound >= least[:, None]
                else:
                    chosen = bound >= np.maximum(floors, least)[:, None]
                item, place = np.nonzero(chosen)
                if not len(item):
                    continue
                score = exact(block, items, item, place)
                for i, p, s in zip(item.tolist(), place.tolist(), score.tolist()):
                    if s > 0:
                        x = block["ids"][p]
                        best[i].append((-s, x is None, x or 0))
                for i in set(item.tolist()):
                    best[i] = sorted(best[i])[:k]
        rows = [(i, None if none else x, -s) for i, b in enumerate(best) for s, none, x in b]
        cols = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())],
                                         ["item", "doc_id", "score"])

    return index.mapInArrow(releasing(run), "item long, doc_id long, score long")


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def search(index: DataFrame, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item."""
    spark = index.sparkSession
    bound_batches(spark)
    pairs = item_terms(items, id_col, text_col)
    parts = max(1, -(-pairs.count() // ITEM_TERMS))
    id_type = pairs.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
    for part in range(parts):
        mine: dict = {}
        own = pairs if parts == 1 else pairs.filter(F.pmod(F.xxhash64("item"), F.lit(parts)) == part)
        for r in own.orderBy("item", "term").toLocalIterator():  # about ITEM_TERMS rows
            mine.setdefault(r.item, (r.item_id, []))[1].append(r.term)
        df, n_docs, total = frequencies(index, sorted({t for _, ts in mine.values() for t in ts}))
        held = Items(mine, df, n_docs, total)
        first = _ranked(_scored(index, held, None, k), k).filter(F.col("rank") == k).collect()  # a row an item at most
        floors = np.ones(len(held.keys))
        for r in first:
            floors[r.item] = r.score
        ids = spark.createDataFrame([(i, mine[key][0]) for i, key in enumerate(held.keys)], f"item long, item_id {id_type}")
        found = _ranked(_scored(index, held, floors, k), k)
        out = out.unionByName(found.join(F.broadcast(ids), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return out


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(build_index(docs), items)
