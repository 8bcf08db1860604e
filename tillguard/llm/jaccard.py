"""N-gram Jaccard join with Bayesian candidate pruning.

1. Each text's five-word shingles give 128 MinHash values; equal texts are
   grouped and represented once (by the smallest id).
2. Bands of four values bucket the representatives.  Within a bucket, pairs are
   compared incrementally: after every 16 values a pair is dropped if the
   posterior probability that its similarity reaches the threshold (uniform
   prior, binomial matches) is below a tolerance.  A bucket leaves only the
   edges of a spanning forest over its surviving pairs, never all pairs.
3. Connected representatives meet once, with their shingles.  All pairs there
   are pruned in the same way and the rest is verified exactly, in tiles of
   ``GROUP`` texts.  A bucket or group of n > ``GROUP`` texts is dealt out to
   pairs of about sqrt(n / ``GROUP``) chunks, more where a chunk would exceed
   ``CHUNK_BYTES``; each text is sent once for each chunk.
4. Each task leaves a count of links for each text and a spanning forest of
   the verified links, from which classes follow.

A pair at the threshold shares no band with probability 5e-8; the tolerance
is 1e-7 a comparison.

Defined results: words are runs of characters other than ASCII white space; a
text of one to four words is one shingle; texts without words have no shingles
and link to their equals only; null texts are equal to each other and no
others; repeated rows are copies; a null id has no class and no links; rows
that share an id share a class; an empty table gives an empty table; extra
columns are ignored.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, releasing, sorted_groups, split_words, written

SHINGLE, THRESHOLD = 5, (4, 5)  # the similarity as a fraction, compared in integers
VALUES, BAND, STEP = 128, 4, 16
TOLERANCE = 1e-7
#: Texts of a bucket or component that meet in one task undivided, and of a tile.
GROUP = 1024
#: Bytes of signatures and shingles of a chunk on average, and of a tile.
CHUNK_BYTES, TILE_BYTES = 32 << 20, 8 << 20

_rng = np.random.default_rng(20240801)
_MUL = _rng.integers(1, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, VALUES, dtype=np.uint64)
_BAND_SALT = _rng.integers(-(1 << 62), 1 << 62, VALUES // BAND, dtype=np.int64)


def least_matches(threshold: float = THRESHOLD[0] / THRESHOLD[1], tolerance: float = TOLERANCE) -> np.ndarray:
    """For n = STEP, 2 STEP, ... values, the fewest matches that keep a pair.
    With a uniform prior the posterior after m matches is Beta(m + 1, n - m + 1),
    and P(similarity >= t) is the binomial P(X <= m) of n + 1 trials."""
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        tail, m = 0.0, -1
        while True:
            k = m + 1
            tail += comb(n + 1, k) * threshold ** k * (1 - threshold) ** (n + 1 - k)
            if tail >= tolerance:
                break
            m = k
        out.append(m + 1)
    return np.array(out)


_LEAST = least_matches()


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of each text's shingles (with repeats): values, offsets."""
    import xxhash

    offsets, number, distinct = split_words(texts)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct], np.uint64)
    real = np.array([bool(w) for w in distinct], bool)[number] if len(number) else np.zeros(0, bool)
    count = np.concatenate([[0], np.cumsum(real)])[offsets]  # words before each text
    h = hashes[number[real]] if len(number) else np.zeros(0, np.uint64)
    n = np.diff(count)
    mult = np.uint64(0x9E3779B97F4A7C15)

    def mixed(words):
        out = np.zeros(len(words[0]), np.uint64)
        for w in words:
            out = (out ^ w) * mult
            out ^= out >> np.uint64(32)
        return out

    if len(h) >= SHINGLE:
        every = mixed([h[i:len(h) - SHINGLE + 1 + i] for i in range(SHINGLE)])
    else:
        every = np.zeros(0, np.uint64)
    size = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    ends = np.cumsum(size)
    row = np.repeat(np.arange(len(n)), size)
    at = count[:-1][row] + np.arange(len(row)) - (ends - size)[row]
    out = np.zeros(len(row), np.uint64)
    long = (n >= SHINGLE)[row]
    out[long] = every[at[long]]
    for i in np.nonzero((n > 0) & (n < SHINGLE))[0]:
        words = h[count[i]:count[i + 1]]
        out[ends[i] - 1] = mixed([*words[:, None], np.array([n[i]], np.uint64)])[0]
    return out, np.concatenate([[0], ends]).astype(np.int64)


def signatures(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """16 bits of each MinHash value of each text; texts without shingles get 0."""
    sizes = np.diff(offsets)
    full = np.nonzero(sizes)[0]
    out = np.zeros((len(sizes), VALUES), np.uint16)
    if len(full):
        for j in range(VALUES):
            low = np.minimum.reduceat((values * _MUL[j] + _ADD[j]) >> np.uint64(32), offsets[full])
            out[full, j] = (low & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def surviving(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of signatures (rows of ``a`` and ``b``) are not pruned."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for k, least in enumerate(_LEAST):
        part = slice(k * STEP, (k + 1) * STEP)
        matches = matches + (a[alive, part] == b[alive, part]).sum(1)
        keep = matches >= least
        alive, matches = alive[keep], matches[keep]
        if not len(alive):
            break
    return alive


def forest(sig: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest over the surviving pairs of one bucket: each
    reached text is compared with those not yet reached."""
    edges, open_, rest = [], [], np.arange(len(sig))
    while len(rest):
        if not open_:
            open_, rest = [int(rest[0])], rest[1:]
            continue
        x = open_.pop()
        hit = surviving(np.broadcast_to(sig[x], (len(rest), sig.shape[1])), sig[rest])
        found = rest[hit].tolist()
        edges += [(x, y) for y in found]
        open_ += found
        rest = np.delete(rest, hit)
    return edges


def common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of sets of 64-bit hashes."""
    sizes = [len(s) for s in sets]
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    column = np.cumsum(shared) - 1
    row = np.repeat(np.arange(len(sets)), sizes)
    keep = shared[inverse]
    row, col = row[keep], column[inverse[keep]]
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(col, kind="stable")
    row, col, width = row[order], col[order], 8192
    for lo in range(0, int(shared.sum()), width):
        s = slice(*np.searchsorted(col, [lo, lo + width]))
        part = np.zeros((len(sets), width), np.float32)
        part[row[s], col[s] - lo] = 1
        out += part @ part.T
    return out.astype(np.int64)


def tiles(rows: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """``rows`` in runs of at most GROUP rows and about TILE_BYTES."""
    if not len(rows):
        return []
    before = np.cumsum(size[rows]) - size[rows]
    ends = (np.diff(np.arange(len(rows)) // GROUP) > 0) | (np.diff(before // TILE_BYTES) > 0)
    return np.split(rows, np.nonzero(ends)[0] + 1)


def linked(sig: np.ndarray, sets: list[np.ndarray], size: np.ndarray, left: np.ndarray, right: np.ndarray | None = None):
    """Pairs (rows i, j) of two tiles, or of one, that reach the threshold."""
    p, q = THRESHOLD
    if right is None:
        i, j = np.triu_indices(len(left), 1)
        i, j = left[i], left[j]
    else:
        i, j = np.repeat(left, len(right)), np.tile(right, len(left))
    alive = [lo + surviving(sig[i[lo:lo + 65536]], sig[j[lo:lo + 65536]]) for lo in range(0, len(i), 65536)]
    alive = np.concatenate(alive) if alive else np.zeros(0, np.int64)
    i, j = i[alive], j[alive]
    if len(i):
        used = np.unique(np.concatenate([i, j]))
        both = common([sets[u] for u in used])[np.searchsorted(used, i), np.searchsorted(used, j)]
        link = q * both >= p * (size[i] + size[j] - both)
        i, j = i[link], j[link]
    return i, j


def hooked(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """New labels (the least row of a component) after the links (i, j), and
    the links that joined components: a spanning forest of what is new."""
    out_i, out_j = [], []
    while True:
        new = label[i] != label[j]
        i, j = i[new], j[new]
        if not len(i):
            break
        low, high = np.minimum(label[i], label[j]), np.maximum(label[i], label[j])
        top, first = np.unique(high, return_index=True)
        out_i.append(i[first])
        out_j.append(j[first])
        to = np.arange(len(label))
        to[top] = low[first]
        while (to[to] != to).any():
            to = to[to]
        label = to[label]
    none = np.zeros(0, np.int64)
    return label, np.concatenate(out_i or [none]), np.concatenate(out_j or [none])


def _sorted_in(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(*[k for k in keys]).sortWithinPartitions(*keys, "node")


def _chunks(rows: Column, size: Column) -> Column:
    """Number of chunks of a group of ``rows`` members of ``size`` bytes."""
    return F.greatest(F.ceil(F.sqrt(rows / GROUP)), F.ceil(size / CHUNK_BYTES)).cast("int")


def _dealt(df: DataFrame, chunks: Column) -> DataFrame:
    """Adds chunk, lo and hi: the rows of a group are dealt to ``chunks`` chunks,
    and each chunk goes to every pair of chunks that it is part of."""
    df = df.withColumn("_chunks", chunks)
    df = df.withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(3)), F.col("_chunks")).cast("int"))
    df = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))).drop("_chunks")
    return df.withColumn("lo", F.least("chunk", "other")).withColumn("hi", F.greatest("chunk", "other")).drop("other")


def components(edges: DataFrame, name: str, rounds: int = 50) -> DataFrame:
    """(node, root) of all nodes of ``edges`` (a, b): alternating large-star and
    small-star steps, each a minimum by node and a join, until nothing moves."""
    def state(e):
        return tuple(e.agg(F.count("*"), F.sum(F.shiftright(F.xxhash64("a", "b"), 24))).first())

    e = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), name)
    now = state(e)
    for _ in range(rounds):
        # large star: of each node, the larger neighbours move to its least neighbour
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        e = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: the smaller neighbours and the node itself move to the least of them
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        e = e.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))).distinct()
        e = written(e, name)
        before, now = now, state(e)
        if now == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("b").alias("a")).distinct()
    return e.unionByName(roots.select("a", F.col("a").alias("b"))).select(F.col("a").alias("node"), F.col("b").alias("root"))


def signed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h1, h2, sig, weight): a 128-bit hash of the text, its signature
    (null without words) and its number of shingles."""
    import xxhash  # noqa: F401  (needed by the tasks)

    bound_batches(docs.sparkSession)

    def run(batches):
        import xxhash

        for b in batches:
            ids, texts = b.columns
            values, offsets = shingles(texts)
            sig = signatures(values, offsets)
            has = np.diff(offsets) > 0
            digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest("t" + t if t is not None else "") for t in texts.to_pylist()), "<i8")
            sigs = pa.array([s.tobytes() if k else None for s, k in zip(sig, has)], pa.binary())
            yield pa.RecordBatch.from_arrays([ids, pa.array(digests[::2]), pa.array(digests[1::2]), sigs, pa.array(np.diff(offsets))],
                                             ["doc_id", "h1", "h2", "sig", "weight"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        releasing(run), "doc_id long, h1 long, h2 long, sig binary, weight long")


def _bands(reps: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint16).reshape(-1, VALUES)
            keys = sig.reshape(len(sig), -1, BAND).copy().view(np.int64).reshape(len(sig), -1) ^ _BAND_SALT
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), b.column("node").take(pa.array(np.repeat(np.arange(len(sig)), keys.shape[1])))],
                                             ["key", "node"])

    return reps.mapInArrow(releasing(run), "key long, node long")


def _bucket_edges(rows: DataFrame) -> DataFrame:
    """Spanning edges of each sorted bucket (key, lo, hi) of (node, sig)."""
    def run(batches):
        for group in sorted_groups(batches, ["key", "lo", "hi"]):
            sizes = np.diff(group["starts"])
            sig = np.frombuffer(b"".join(group["sig"]), np.uint16).reshape(-1, VALUES)
            node, edges = group["node"], []
            two = group["starts"][:-1][sizes == 2]
            hit = two[surviving(sig[two], sig[two + 1])]
            a, b = [node[hit]], [node[hit + 1]]
            for s, n in zip(group["starts"][:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                if edges := forest(sig[s:s + n]):
                    x, y = np.array(edges).T
                    a.append(node[s + x])
                    b.append(node[s + y])
            a, b = np.concatenate(a), np.concatenate(b)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return rows.mapInArrow(releasing(run), "a long, b long")


def _verified(rows: DataFrame) -> DataFrame:
    """Links of each sorted group (root, lo, hi) of (node, n, chunk, sig,
    shingles): counts for each node, and edges of a spanning forest."""
    def run(batches):
        for group in sorted_groups(batches, ["root", "lo", "hi"]):
            starts = group["starts"]
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
                if e - s < 2:
                    continue
                at = np.arange(s, e)
                if (np.diff(group["node"][s:e]) == 0).any():  # repeated rows count once here
                    at = np.array(sorted({(n, x): k for k, n, x in zip(at[::-1].tolist(), group["node"][at[::-1]].tolist(),
                                                                       group["shingles"][s:e][::-1])}.values()))
                m, node, copies, chunk = len(at), group["node"][at], group["n"][at], group["chunk"][at]
                sig = np.frombuffer(b"".join([group["sig"][k] for k in at]), np.uint16).reshape(-1, VALUES)
                sets = [np.frombuffer(group["shingles"][k], np.uint64) for k in at]
                size = np.array([len(x) for x in sets])
                if group["lo"][s] == group["hi"][s]:
                    runs = tiles(np.arange(m), 8 * size)
                    pairs = [(a, None) for a in runs] + [(a, b) for k, a in enumerate(runs) for b in runs[k + 1:]]
                else:  # pairs within a chunk meet in the chunk's own group
                    low = chunk == group["lo"][s]
                    pairs = [(a, b) for a in tiles(np.nonzero(low)[0], 8 * size) for b in tiles(np.nonzero(~low)[0], 8 * size)]
                label, links, texts, edges = np.arange(m), np.zeros(m), np.zeros(m, np.int64), []
                for a, b in pairs:
                    i, j = linked(sig, sets, size, a, b)
                    if len(i):
                        links += np.bincount(i, copies[j], m) + np.bincount(j, copies[i], m)
                        texts += np.bincount(i, minlength=m) + np.bincount(j, minlength=m)
                        label, x, y = hooked(label, i, j)
                        edges.append((x, y))
                has = np.nonzero(texts)[0]
                if not len(has):
                    continue
                x, y = (np.concatenate(z) for z in zip(*edges))
                zero = np.zeros(len(x), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([node[has], node[x]])),
                     pa.array(np.concatenate([node[has], node[y]]), mask=np.arange(len(has) + len(x)) < len(has)),
                     pa.array(np.concatenate([links[has].astype(np.int64), zero])), pa.array(np.concatenate([texts[has], zero]))],
                    ["node", "to", "links", "text_links"])

    return rows.mapInArrow(releasing(run), "node long, to long, links long, text_links long")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: doc_id, text_id (smallest id of an equal
    text), class_id (smallest id of its connected component of links), n_links
    (other documents linked, copies included), n_text_links (other texts)."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = written(signed(docs.filter(F.col("doc_id").isNotNull())), "jaccard-signatures")
    reps = written(known.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "sig", "weight")).alias("r"), F.count("*").alias("n")).select(
        "h1", "h2", F.col("r.doc_id").alias("node"), "n", F.col("r.sig").alias("sig"), F.col("r.weight").alias("weight")), "jaccard-texts")
    signed_reps = reps.filter(F.col("sig").isNotNull())
    bands = _bands(signed_reps.select("node", "sig"))
    buckets = bands.join(bands.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "key")
    dealt = _dealt(buckets, _chunks(F.col("size"), F.col("size") * 2 * VALUES)).select("key", "lo", "hi", "node")
    with_sig = dealt.join(signed_reps.select("node", "sig"), "node")
    edges = _bucket_edges(_sorted_in(with_sig, "key", "lo", "hi"))
    near = components(edges, "jaccard-near")

    members = written(near.join(reps.select("node", "n", "weight"), "node"), "jaccard-members")
    sizes = members.groupBy("root").agg(F.count("*").alias("size"), F.sum(8 * F.col("weight") + 2 * VALUES).alias("bytes"))
    groups = members.join(sizes, "root").select(F.col("node").alias("g_node"), "root", "n", _chunks(F.col("size"), F.col("bytes")).alias("chunks"))
    groups = written(groups, "jaccard-groups")  # a table of known size: texts stay in place where it may be broadcast
    meet = docs.join(groups, F.col("doc_id") == F.col("g_node")).select("doc_id", "text", "root", "chunks", "n")

    def hashed(batches):
        for b in batches:
            values, offsets = shingles(b.column("text"))
            sig = signatures(values, offsets)
            sets = [np.unique(values[s:e]).tobytes() for s, e in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([b.column("root"), b.column("chunks"), b.column("doc_id"), b.column("n"),
                                              pa.array([s.tobytes() for s in sig], pa.binary()), pa.array(sets, pa.binary())],
                                             ["root", "chunks", "node", "n", "sig", "shingles"])

    sets = meet.mapInArrow(releasing(hashed), "root long, chunks int, node long, n long, sig binary, shingles binary")
    sets = _dealt(sets, F.col("chunks")).select("root", "lo", "hi", "node", "n", "chunk", "sig", "shingles")
    links = written(_verified(_sorted_in(sets, "root", "lo", "hi")), "jaccard-links")
    counts = links.filter(F.col("to").isNull()).groupBy("node").agg(F.sum("links").alias("links"), F.sum("text_links").alias("text_links"))
    classes = components(links.filter(F.col("to").isNotNull()).select(F.col("node").alias("a"), F.col("to").alias("b")), "jaccard-classes")
    texts = reps.select("h1", "h2", "node", "n").join(classes, "node", "left").join(counts, "node", "left").select(
        F.col("h1").alias("t_h1"), F.col("h2").alias("t_h2"), F.col("node").alias("text_id"),
        F.coalesce("root", "node").alias("class_id"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("text_links", F.lit(0)).alias("n_text_links"))
    out = known.join(texts, (F.col("h1") == F.col("t_h1")) & (F.col("h2") == F.col("t_h2")))
    out = out.select("doc_id", "text_id", "class_id", "n_links", "n_text_links")
    none = docs.filter(F.col("doc_id").isNull()).select(
        "doc_id", *[F.lit(None).cast("long").alias(c) for c in ("text_id", "class_id")],
        *[F.lit(0).cast("long").alias(c) for c in ("n_links", "n_text_links")])
    return out.unionByName(none)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each class one document stays (its smallest id); rows
    that repeat its id go too, rows without an id stay."""
    classes = join(docs)
    keep = classes.filter(F.col("doc_id") == F.col("class_id")).select(F.col("doc_id").alias("_jaccard_kept")).distinct()
    kept = docs.filter(F.col("doc_id").isNotNull()).join(written(keep, "jaccard-kept"), F.col("doc_id") == F.col("_jaccard_kept"), "left_semi")
    return kept.dropDuplicates(["doc_id"]).select(docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))
