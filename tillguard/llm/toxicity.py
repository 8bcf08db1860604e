"""Toxicity: cumulative-link ordinal regression over sparse text features.

``P(grade > k) = sigmoid(w . x - theta_k)``: one weight vector is shared by all
ordered thresholds, and the expected severity is the sum of these over ``k``.
``x`` marks which chosen features occur in the text: hash buckets of lower-case
words and of the character 4- and 5-grams within them, in one word or in two at
least, chosen by their likelihood ratio for the label over the
labelled rows, and by the share of their documents that have it.

The labels say toxic or not.  Grades follow from them: a toxic row's grade is
1, 2 or 3 by the number of its words that hold a chosen bucket; a
label above 1 is taken as the grade itself.

Defined results: null and empty texts have no features (the least severity);
texts of any length are scored whole; labels that are null are ignored; equal
labelled texts count once.  Without labelled rows of both kinds there is no
model, the severity is 0 and nothing is rejected.  An empty table gives an
empty table; extra columns are kept, one with an output's name is replaced.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, char_grams, Recent, releasing, table, without, written

#: Hash buckets: so many that rare and telling n-grams seldom share one.
BUCKETS = 1 << 22
#: The fit uses a hash sample of at most about this many labelled rows.
MAX_FIT_ROWS = 20_000
#: Most chosen buckets, and the least likelihood ratio (G squared) of one.
MAX_FEATURES, LEAST_RATIO = 4096, 30.0
#: Least share of the documents with a chosen bucket that have the label.
LEAST_SHARE = 0.7
#: Grade 2 and 3 begin at so many words with a chosen bucket.
GRADE_CUTS = (4, 8)
#: Expected severity from which a document is rejected.
REJECT_AT = 0.5

_words = re.compile(r"\w+").findall


def buckets_of(words: list[str], among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each word (only those marked in ``among``), and the
    number of the word each is from."""
    whole = np.array([zlib.crc32(b"word " + w.encode()) for w in words], np.int64) % BUCKETS
    grams, word = char_grams(words, (4, 5), BUCKETS)
    word, bucket = np.concatenate([np.arange(len(words)), word]), np.concatenate([whole, grams.astype(np.int64)])
    if among is not None:
        hit = among[bucket]
        word, bucket = word[hit], bucket[hit]
    both = np.unique(word * BUCKETS + bucket)
    return both % BUCKETS, both // BUCKETS


def spread(words: Counter) -> Counter:
    """Number of words of a text that hold each bucket, with repeats."""
    if not words:
        return Counter()
    bucket, word = buckets_of(list(words))
    distinct, at = np.unique(bucket, return_inverse=True)
    counts = np.bincount(at, np.array(list(words.values()))[word])
    return Counter(dict(zip(distinct.tolist(), counts.astype(int).tolist())))


def features_of(words_with: Counter) -> list[int]:
    """Features from the number of words that hold each bucket."""
    return [*words_with, *(b + BUCKETS for b, n in words_with.items() if n > 1)]


class Features:
    """Chosen features (as column numbers) of texts; words are remembered."""

    def __init__(self, chosen: np.ndarray):
        self.column = {int(b): i for i, b in enumerate(chosen)}
        self.telling = np.zeros(BUCKETS, bool)
        self.telling[chosen % BUCKETS] = True
        self.recent = Recent(self._learn)

    def _learn(self, words: list[str]) -> list[tuple[int, ...]]:
        buckets, word = buckets_of(words, self.telling)
        out: list = [()] * len(words)
        for w, b in zip(word.tolist(), buckets.tolist()):
            out[w] += (b,)
        return out

    def of(self, texts: list[str]) -> list[tuple[set[int], int]]:
        """For each text: the columns that occur, and its number of words with
        any chosen bucket."""
        words = [Counter(_words(t.lower())) for t in texts]
        distinct = list(set().union(*words))
        telling = {w: b for w, b in zip(distinct, self.recent.get(distinct)) if b}
        out = []
        for ws in words:
            hits = [w for w in ws if w in telling] if len(ws) < len(telling) else [w for w in telling if w in ws]
            seen: Counter = Counter()
            for w in hits:
                for b in telling[w]:
                    seen[b] += ws[w]
            out.append(({self.column[f] for f in features_of(seen) if f in self.column}, sum(ws[w] for w in hits)))
        return out


@dataclass(frozen=True)
class SeverityModel:
    chosen: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def severity(self, total: float) -> float:
        z = np.clip(self.thresholds - total, -500, 500)
        return float((1.0 / (1.0 + np.exp(z))).sum())


def choose_buckets(rows: DataFrame, max_features: int = MAX_FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Features that occur with the label far more often than without it, the
    most telling first, and their log odds (smoothed by half a document).
    Each task counts documents by bucket (at most ``2 * BUCKETS`` rows leave it)."""

    def run(batches):
        n = np.zeros((2, 2 * BUCKETS), np.int32)
        for b in batches:
            for text, grade in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
                n[int(grade > 0), features_of(spread(Counter(_words((text or "").lower()))))] += 1
        at = np.nonzero(n.sum(0))[0]
        counts = n[:, at].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[0]), pa.array(counts[1])], ["bucket", "clean", "toxic"])

    totals = {bool(r.t): r.n for r in rows.groupBy((F.col("label") > 0).alias("t")).agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return np.zeros(0, np.int64), np.zeros(0)
    n0, n1 = totals[False], totals[True]
    counts = rows.mapInArrow(releasing(run), "bucket long, clean long, toxic long").groupBy("bucket").agg(
        F.sum("clean").alias("a"), F.sum("toxic").alias("b"))
    term = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    a, b, n = F.col("a"), F.col("b"), n0 + n1
    both = a + b
    ratio = 2 * (term(a, both * (n0 / n)) + term(b, both * (n1 / n))
                 + term(n0 - a, (n - both) * (n0 / n)) + term(n1 - b, (n - both) * (n1 / n)))
    best = (counts.filter((b * n0 > a * n1) & (b >= LEAST_SHARE * both)).withColumn("ratio", ratio).filter(F.col("ratio") >= LEAST_RATIO)
            .orderBy(F.desc("ratio"), "bucket").limit(max_features).collect())
    odds = [np.log((r.b + 0.5) / (n1 + 1)) - np.log((r.a + 0.5) / (n0 + 1)) for r in best]
    return np.array([r.bucket for r in best], np.int64), np.array(odds)


def fit_ordinal(x: list[np.ndarray], grade: np.ndarray, n_features: int, l2: float = 1e-5,
                steps: int = 400, prior: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of the cumulative-link model by Adam on
    the mean negative log likelihood, with a ridge towards ``prior`` (zero by
    default); ``x`` has each row's columns.  Starting from a prior keeps the
    weight of telling features that rarely stand alone in the sample."""
    prior = np.zeros(n_features) if prior is None else prior
    levels = int(grade.max())
    row = np.repeat(np.arange(len(x)), [len(c) for c in x])
    col = np.concatenate(x) if len(row) else np.zeros(0, np.int64)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    share = np.array([(grade > k).mean() for k in range(levels)])
    theta0 = -np.log(np.clip(share, 1e-6, 1 - 1e-6) / (1 - np.clip(share, 1e-6, 1 - 1e-6)))
    # thresholds: the first, then gaps exp(g), so that their order holds
    p = np.concatenate([prior, theta0[:1], np.log(np.maximum(np.diff(theta0), 0.1))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    at = np.arange(len(x))
    for t in range(1, steps + 1):
        w, theta = p[:n_features], np.cumsum(np.concatenate([p[n_features:n_features + 1], np.exp(p[n_features + 1:])]))
        eta = np.bincount(row, w[col], len(x))
        above = sigmoid(eta[:, None] - theta[None, :])  # P(grade > k)
        full = np.concatenate([np.ones((len(x), 1)), above, np.zeros((len(x), 1))], 1)
        slope = np.concatenate([np.zeros((len(x), 1)), above * (1 - above), np.zeros((len(x), 1))], 1)
        like = np.maximum(full[at, grade] - full[at, grade + 1], 1e-12)
        d_eta = -(slope[at, grade] - slope[at, grade + 1]) / like / len(x)
        d_theta = np.zeros(levels + 2)
        np.add.at(d_theta, grade, slope[at, grade] / like / len(x))
        np.add.at(d_theta, grade + 1, -slope[at, grade + 1] / like / len(x))
        d_theta = d_theta[1:-1]
        tail = np.cumsum(d_theta[::-1])[::-1]
        g = np.concatenate([np.bincount(col, d_eta[row], n_features) + l2 * (w - prior), tail[:1], tail[1:] * np.exp(p[n_features + 1:])])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return p[:n_features], np.cumsum(np.concatenate([p[n_features:n_features + 1], np.exp(p[n_features + 1:])]))


def fit_severity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS, id_col: str = "doc_id",
                 text_col: str = "text", label_col: str = "toxic") -> SeverityModel | None:
    """A model from labelled documents, or None if either label is missing."""
    bound_batches(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
    u = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1 << 20))
    known = known.filter(u < F.lit(int((1 << 20) * min(1.0, max_rows / max(1, known.count())))))
    # the sample is bounded by max_rows, so it may be broadcast
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id")
    rows = rows.groupBy(F.xxhash64("text").alias("h")).agg(F.max(F.struct("label", "text")).alias("r")).select("r.label", "r.text")
    rows = written(rows, "toxicity-sample")
    chosen, odds = choose_buckets(rows)
    if not len(chosen):
        return None

    def run(batches):
        f = Features(chosen)
        for b in batches:
            got = f.of([t or "" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [b.column("label"), pa.array([sorted(c) for c, _ in got], pa.list_(pa.int32())), pa.array([n for _, n in got], pa.int32())],
                ["label", "cols", "n"])

    sample = rows.mapInArrow(releasing(run), "label int, cols array<int>, n int").toPandas()  # max_rows rows at most
    label, n = sample["label"].to_numpy(), sample["n"].to_numpy()
    if label.max() <= 1:
        label = np.where(label > 0, 1 + sum((n >= c).astype(int) for c in GRADE_CUTS), 0)
    grade = np.unique(label, return_inverse=True)[1]  # grades without rows have no threshold
    weights, thresholds = fit_ordinal([np.asarray(c, np.int64) for c in sample["cols"]], grade, len(chosen), prior=odds / 8)
    return SeverityModel(chosen, weights, thresholds)


def score_severity(docs: DataFrame, model: SeverityModel | None, text_col: str = "text", reject_at: float = REJECT_AT) -> DataFrame:
    """Adds severity (expected grade) and toxic (whether it is rejected)."""
    docs = without(docs, ["severity", "toxic"], text_col)
    if model is None:
        return docs.withColumns({"severity": F.lit(0.0), "toxic": F.lit(False)})
    bound_batches(docs.sparkSession)

    def run(batches):
        f = Features(model.chosen)
        for b in batches:
            found = f.of([t or "" for t in b.column(text_col).to_pylist()])
            s = [model.severity(sum(model.weights[c] for c in sorted(cols))) for cols, _ in found]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64()), pa.array([x >= reject_at for x in s], pa.bool_())],
                                             [*b.schema.names, "severity", "toxic"])

    return docs.mapInArrow(releasing(run), T.StructType([*docs.schema.fields, T.StructField("severity", T.DoubleType()),
                                              T.StructField("toxic", T.BooleanType())]))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    return score_severity(docs, fit_severity(docs, labels)).drop("text")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: keeps the documents that aren't rejected."""
    model = fit_severity(docs, table(spark, sf_dir, "labels"))
    cols = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    scored = score_severity(docs.select(cols), model, text_col=f"c{docs.columns.index('text')}").filter(~F.col("toxic"))
    return scored.select([F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
