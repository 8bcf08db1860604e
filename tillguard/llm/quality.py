"""Quality rules: exact base rules and a learned verdict.

The learned rule is a logistic regression over hashed word 1- and 2-grams and
character 3- and 4-grams, fitted on a bounded sample of labelled rows (features
from Spark tasks, descent on the driver), calibrated on held-out rows (Platt scaling) and scored in Arrow batches against a fixed
threshold.  A word's character n-grams lie within the word, so their summed
weight is a property of the word and is computed once per distinct word.

Defined results: a null or empty text has no words and fails the base rules;
texts of any length are scored whole; repeated rows are scored each, repeated
labels of a document are all used; null labels are ignored.  Without labels of
both kinds there is no model, the probability is null and the base rules
decide.  An empty table gives an empty table; extra columns are kept, one with an
output's name is replaced.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, char_grams, gather, Recent, releasing, split_words, table, without

#: Hash buckets of the features.
BUCKETS = 1 << 16
#: The fit uses a hash sample of at most about this many labelled rows.
MAX_FIT_ROWS = 3_000
#: Feature shares are multiplied by this, so that weights are of order one.
SCALE = 64.0
#: Probability of good quality from which a document is kept.
KEEP_AT = 0.35
#: Base rules (fixed values).
MIN_WORDS, REPEAT_WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30

SYMBOLS = "[#*$%&|<>]"
_MULT = np.uint32(0x9E3779B1)


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words' 1-grams and of their character 3- and 4-grams, and
    the number of the word each is from."""
    whole = np.array([zlib.crc32(b"w" + w.encode()) for w in words], np.uint32) % np.uint32(BUCKETS)
    grams, word = char_grams(words, (3, 4), BUCKETS)
    return np.concatenate([whole, grams]), np.concatenate([np.arange(len(words)), word])


class Lexicon:
    """Figures of a process's recent words: their hash, and the summed weight
    and number of their n-grams."""

    def __init__(self, weights: np.ndarray | None = None):
        self.weights = weights
        self.recent = Recent(self._learn, 150_000)

    def _learn(self, words: list[str]) -> list[tuple[int, float, int]]:
        if self.weights is None:
            return [(zlib.crc32(w.encode()), 0.0, 0) for w in words]
        grams, word = _grams(words)
        sums = np.bincount(word, self.weights[grams], len(words))
        return list(zip([zlib.crc32(w.encode()) for w in words], sums.tolist(), np.bincount(word, minlength=len(words)).tolist()))

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes, sums, sizes = zip(*self.recent.get(words)) if words else ((), (), ())
        return np.array(hashes, np.uint32), np.array(sums, float), np.array(sizes, np.int64)


def real_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """As split_words, without the empty ones at a text's edges."""
    offsets, number, distinct = split_words(texts)
    if "" in distinct:
        real = number != distinct.index("")
        offsets, number = np.concatenate([[0], np.cumsum(real)])[offsets], number[real]
    return offsets, number, distinct


def bigrams(hashes: np.ndarray) -> np.ndarray:
    """Buckets of the word 2-grams, from the words' hashes."""
    h = hashes[:-1] * _MULT + (hashes[1:] ^ np.uint32(0x5BD1E995)) * np.uint32(0x85EBCA6B)
    return (h >> np.uint32(7)) & np.uint32(BUCKETS - 1)


def repeat_words(ids: np.ndarray, size: int = REPEAT_WINDOW) -> int:
    """Words in windows of ``size`` words that occur twice or more."""
    n = len(ids) - size + 1
    if n < 2:
        return 0
    mix = np.zeros(n, np.uint64)
    u = ids.astype(np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            mix = mix * np.uint64(0x9E3779B97F4A7C15) + u[j:j + n] + np.uint64(1)
            mix ^= mix >> np.uint64(29)
    order = np.sort(mix)
    if not (order[1:] == order[:-1]).any():
        return 0  # equal windows have equal hashes: none repeats
    level, span = ids, 1  # exact: numbers of windows of 1, 2, 4, ... words
    while span < size:
        pair = level[:len(level) - span] * (int(level.max()) + 1) + level[span:]
        level, span = np.unique(pair, return_inverse=True)[1], span * 2
    hit = np.bincount(level)[level] > 1
    edge = np.zeros(len(ids) + 1, np.int64)
    at = np.nonzero(hit)[0]
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def duplicate_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    seen, n = set(), 0
    for line in text.split("\n"):
        if line in seen:
            n += 1
        elif line.strip(" \t\n\v\f\r"):
            seen.add(line)
    return n


@dataclass(frozen=True)
class QualityModel:
    """Weights by bucket, intercept, and the calibration slope and offset."""

    weights: np.ndarray
    intercept: float
    slope: float
    offset: float

    def probability(self, total: np.ndarray) -> np.ndarray:
        z = np.clip(self.slope * (total + self.intercept) + self.offset, -700, 700)
        return 1.0 / (1.0 + np.exp(-z))


def _features(rows: DataFrame) -> DataFrame:
    """(label, fold, buckets, counts) of labelled texts: the buckets that occur
    (32 bits each) and how often (16 bits)."""

    def run(batches):
        lex = Lexicon()
        for b in batches:
            offsets, number, distinct = real_words(b.column("text"))
            hashes = lex.of(distinct)[0]
            grams, word = _grams(distinct)
            grams, sizes = grams[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(distinct))
            starts = np.cumsum(sizes) - sizes
            index, count = [], []
            for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                words = number[s:e]
                got = np.concatenate([gather(grams, starts[words], sizes[words]), bigrams(hashes[words])])
                i, n = np.unique(got, return_counts=True)
                index.append(i.astype(np.int32).tobytes())
                count.append(np.minimum(n, 65535).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("label"), b.column("fold"), pa.array(index, pa.binary()), pa.array(count, pa.binary())],
                ["label", "fold", "buckets", "counts"])

    return rows.mapInArrow(releasing(run), "label double, fold int, buckets binary, counts binary")


def fit_logistic(index: np.ndarray, value: np.ndarray, ends: np.ndarray, label: np.ndarray, l2: float = 1e-6,
                 steps: int = 150) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge logistic regression over sparse rows
    (``index`` and ``value`` up to each of ``ends``), by Adam."""
    sizes = np.diff(np.concatenate([[0], ends]))
    row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    p, m, v = (np.zeros(BUCKETS + 1, np.float64) for _ in range(3))
    for t in range(1, steps + 1):
        z = np.bincount(row, p.astype(np.float32)[index] * value, len(sizes)) + p[-1]
        slope = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - label) / len(label)
        g = np.append(np.bincount(index, slope.astype(np.float32)[row] * value, BUCKETS) + l2 * p[:-1], slope.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return p[:-1], float(p[-1])


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS, id_col: str = "doc_id",
                text_col: str = "text", label_col: str = "quality") -> QualityModel | None:
    """A model from labelled documents, or None if either label is missing."""
    bound_batches(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label")).dropna()
    u = F.pmod(F.xxhash64("id", F.lit(6)), F.lit(1 << 20))
    known = known.filter(u < F.lit(int((1 << 20) * min(1.0, max_rows / max(1, known.count())))))
    known = known.withColumn("fold", (F.pmod(F.xxhash64("id", F.lit(7)), F.lit(5)) == 0).cast("int"))
    # the sample is bounded by max_rows, so it may be broadcast, and its features collected
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id")
    sample = _features(rows.select("text", "label", "fold")).collect()
    folds = [[r for r in sample if r.fold == k] for k in (0, 1)]
    del sample
    label = np.array([r.label for r in folds[0]])
    if len(np.unique(label)) < 2:
        return None
    weights, intercept = fit_logistic(*_sparse(folds[0]), label)
    index, value, ends = _sparse(folds[1])
    sizes = np.diff(np.concatenate([[0], ends]))
    margin = np.bincount(np.repeat(np.arange(len(ends)), sizes), weights[index] * value, len(ends)) + intercept
    slope, offset = platt(margin, np.array([r.label for r in folds[1]]))
    return QualityModel(weights, intercept, slope, offset)


def _sparse(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets, scaled shares and ends of rows."""
    index = [np.frombuffer(r.buckets, np.int32) for r in rows]
    share = [(n * (SCALE / max(1, n.sum()))).astype(np.float32) for n in (np.frombuffer(r.counts, np.uint16).astype(np.float32) for r in rows)]
    ends = np.cumsum([len(i) for i in index]).astype(np.int64)
    return (np.concatenate(index), np.concatenate(share), ends) if rows else (np.zeros(0, np.int32), np.zeros(0, np.float32), ends)


def platt(margin: np.ndarray, label: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the calibrated margin, with Platt's smoothed
    targets, by Newton steps; (1, 0) if a label is missing."""
    pos, neg = (label > 0.5).sum(), (label <= 0.5).sum()
    if not pos or not neg:
        return 1.0, 0.0
    target = np.where(label > 0.5, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = np.abs(margin).mean() or 1.0
    x = np.stack([margin / scale, np.ones_like(margin)], 1)
    beta = np.zeros(2)
    loss = lambda b: np.logaddexp(0, x @ b).sum() - target @ (x @ b)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (target - p))
        size = 1.0
        while size > 1e-6 and loss(beta + size * step) > loss(beta):
            size /= 2
        beta = beta + size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return (float(beta[0] / scale), float(beta[1])) if beta[0] > 0 else (1.0, 0.0)


#: Columns that ``score_quality`` adds.
ADDED = (("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
         ("n_repeat_words", "long"), ("base_failed", "boolean"), ("quality_prob", "double"), ("kept", "boolean"))


def score_quality(docs: DataFrame, model: QualityModel | None, text_col: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """Adds the base counts, the calibrated probability and the verdict."""
    docs = without(docs, [n for n, _ in ADDED], text_col)
    bound_batches(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, *T._parse_datatype_string(", ".join(f"{n} {t}" for n, t in ADDED)).fields])

    def run(batches):
        lex = Lexicon(model.weights if model else None)
        for b in batches:
            texts = pc.fill_null(b.column(text_col), "")
            offsets, number, distinct = real_words(texts)
            hashes, sums, sizes = lex.of(distinct)
            chars = pc.utf8_length(pa.array(distinct, pa.string())).to_numpy()
            symbols = pc.count_substring_regex(texts, SYMBOLS).to_pylist()
            out = []
            for text, n_symbols, s, e in zip(texts.to_pylist(), symbols, offsets[:-1].tolist(), offsets[1:].tolist()):
                ids, n, share = number[s:e], e - s, 0.0
                if model and n:
                    pairs = model.weights[bigrams(hashes[ids])]
                    share = SCALE * (sums[ids].sum() + pairs.sum()) / (int(sizes[ids].sum()) + len(pairs))
                again = repeat_words(ids)
                out.append((n, int(chars[ids].sum()), n_symbols, duplicate_lines(text), again,
                            n < MIN_WORDS or 100 * again > MAX_REPEAT_PERCENT * n, share))
            cols = list(zip(*out)) if out else [()] * 7
            prob = model.probability(np.array(cols[6])) if model else [None] * len(out)
            kept = [not f and (p is None or bool(p >= keep_at)) for f, p in zip(cols[5], prob)]
            made = [pa.array(c, k) for c, k in zip([*cols[:6], prob, kept], [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()])]
            yield pa.RecordBatch.from_arrays([*b.columns, *made], [*b.schema.names, *(x for x, _ in ADDED)])

    return docs.mapInArrow(releasing(run), schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    return score_quality(docs, fit_quality(docs, labels)).drop("text")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: keeps the documents that pass, with their columns.
    The model comes from the labelled rows of the stage's own input."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    cols = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    text = f"c{docs.columns.index('text')}"
    scored = score_quality(docs.select(cols), model, text_col=text).filter("kept")
    return scored.select([F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
