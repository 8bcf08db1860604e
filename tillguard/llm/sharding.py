"""K-d tree sharding: splits at distributed weighted medians.

A node is split along the dimension in which its rows spread widest, at the
weighted median of bytes, until its share is one leaf; with target bytes, a
leaf that is still above them is split again.  Nodes and cuts are a small table
that rows meet by node.  The medians of all nodes of a level are found together
by histograms that narrow onto the bin where the weight crosses the target:
bins are summed and the crossing is found in Spark, and the driver gets one row
a node.  Equal texts are one point and stay together.

Points that a median could not balance do not take part in the cuts.  Those
above 1 / ``GIANT`` of a leaf (fewer than ``GIANT`` a leaf) go, largest first,
to the emptiest leaf; those above 1 / ``HEAVY`` are ranked by weight with a
range sort and dealt to the leaves to and fro.  The cuts of the others make up
the difference: leaves want bytes up to one level.

Metadata dimensions: language, source (both by their CRC-32, so equal values
are neighbours) and the logarithm of the text's bytes.

Defined results: a null text has no bytes (size 1) and CRC-32 0; all null
texts are one group; null metadata count as empty strings; repeated rows are
sharded each; fewer groups than leaves leave leaves empty; an empty table gives
an empty table; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillguard.operators.cumulative import global_positions

from .common import written

#: Points of more than 1 / HEAVY of a leaf are dealt out singly, those of more
#: than 1 / GIANT of a leaf one by one.
HEAVY, GIANT = 256, 8
#: A key is 20 bits of the dimension's value, then 40 bits of the text's hash.
VALUE_BITS, HASH_BITS, PASS_BITS = 20, 40, 12
#: Bins of the numbering within shards, over all shards.
SLOT_BINS = 8192
#: Tables of nodes or leaves of at most this many rows (under 100 bytes each) are broadcast.
BROADCAST_NODES = 500_000


def points(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           source_col: str = "source") -> DataFrame:
    """A small row for each document: id, size, CRC-32, text hash, dimensions."""
    text = F.col(text_col)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    code = lambda c: F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")).cast("double")
    return docs.select(F.col(id_col).alias("doc_id"), size.alias("size"),
                       F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
                       F.xxhash64(text).alias("h"), code(lang_col).alias("d0"), code(source_col).alias("d1"),
                       F.log2(size.cast("double")).alias("d2"))


def _small(df: DataFrame, rows: list, schema: str) -> DataFrame:
    """A table of a row for each node or leaf, broadcast if it is small."""
    out = df.sparkSession.createDataFrame(rows, schema)
    return F.broadcast(out) if len(rows) <= BROADCAST_NODES else out


def _split(light: DataFrame, nodes: dict[int, tuple[float, int, int]], n_dims: int, enough: float) -> DataFrame:
    """``light`` with each of ``nodes`` (number: bytes wanted on the left, and
    the numbers of both sides) split at its weighted median; written."""
    keys = [F.col(f"k{i}") for i in range(n_dims)]
    own = light.join(_small(light, [(n,) for n in nodes], "of int"), F.col("node") == F.col("of"), "left_semi")
    spread = own.groupBy("node").agg(*[(F.max(k) - F.min(k)).alias(f"s{i}") for i, k in enumerate(keys)])
    dim = {r.node: max(range(n_dims), key=lambda i: (r[f"s{i}"] >> HASH_BITS, -i)) for r in spread.collect()}  # a row a node
    lo, left, done = dict.fromkeys(dim, 0), dict.fromkeys(dim, 0), dict.fromkeys(dim, False)
    pick = F.element_at(F.array(*keys), F.col("dim") + 1)
    for shift in range(VALUE_BITS + HASH_BITS - PASS_BITS, -1, -PASS_BITS):
        active = [(n, dim[n], lo[n], float(nodes[n][0] - left[n])) for n, d in done.items() if not d]
        if not active:
            break
        asked = light.join(_small(light, active, "of int, dim int, lo long, wants double"), F.col("node") == F.col("of"))
        bins = asked.withColumn("bin", F.shiftright(pick - F.col("lo"), shift)).filter(
            (F.col("bin") >= 0) & (F.col("bin") < 1 << PASS_BITS)).groupBy("node", "wants", "bin").agg(F.sum("w").alias("w"))
        upto = F.sum("w").over(Window.partitionBy("node").orderBy("bin"))  # at most 2 ** PASS_BITS rows a node
        crossing = F.when(F.col("upto") > F.col("wants"), F.struct("bin", (F.col("upto") - F.col("w")).alias("before"), "w"))
        for r in bins.withColumn("upto", upto).groupBy("node").agg(F.min(crossing).alias("at"), F.max("upto").alias("every")).collect():
            if r["at"] is None:
                lo[r.node], done[r.node] = lo[r.node] + (1 << (shift + PASS_BITS)), True
                continue
            lo[r.node] += r["at"].bin << shift
            left[r.node] += r["at"].before
            # nearest boundary, once what is left to divide is little
            if r["at"].w <= enough or shift == 0:
                done[r.node] = True
                if nodes[r.node][0] - left[r.node] > r["at"].w / 2:
                    lo[r.node] += 1 << shift
    # a node without points has no cut, and needs none
    cuts = _small(light, [(n, dim[n], lo[n], nodes[n][1], nodes[n][2]) for n in dim], "of int, dim int, cut long, a int, b int")
    moved = light.join(cuts, F.col("node") == F.col("of"), "left")
    side = F.when(pick < F.col("cut"), F.col("a")).otherwise(F.col("b"))
    return written(moved.select("h", "w", *[f"k{i}" for i in range(n_dims)],
                                F.when(F.col("of").isNull(), F.col("node")).otherwise(side).alias("node")), "sharding-level")


def _level(loads: list[float], more: float) -> float:
    """Level up to which leaves with these loads are filled by ``more``."""
    loads = sorted(loads)
    for i, below in enumerate(accumulate(loads)):
        level = (more + below) / (i + 1)
        if i + 1 == len(loads) or level <= loads[i + 1]:
            return level
    return 0.0


def _dealt(groups: DataFrame, shards: int, leaf: float) -> DataFrame:
    """(h, w, node) of the heavy points: giants by room, the others to and fro."""
    load, giants = [(0.0, i) for i in range(shards)], []
    for r in groups.filter(F.col("w") > leaf / GIANT).select("h", "w").orderBy(F.desc("w"), "h").collect():  # under GIANT a leaf
        full, i = heapq.heappop(load)
        giants.append((r.h, r.w, i))
        heapq.heappush(load, (full + r.w, i))
    room = [i for full, i in sorted(load) if full <= leaf / 2] or list(range(shards))
    rest = global_positions(groups.filter((F.col("w") > leaf / HEAVY) & (F.col("w") <= leaf / GIANT)).select("h", "w"), [F.desc("w"), "h"])
    turn, at = F.floor(F.col("position") / len(room)), F.pmod(F.col("position"), F.lit(len(room)))
    rest = rest.withColumn("turn", F.when(turn % 2 == 0, at).otherwise(len(room) - 1 - at).cast("int"))
    rest = rest.join(_small(groups, list(enumerate(room)), "at int, node int"), F.col("turn") == F.col("at")).select("h", "w", "node")
    return written(rest.unionByName(groups.sparkSession.createDataFrame(giants, "h long, w long, node int")), "sharding-heavy")


def assign(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, **columns: str) -> DataFrame:
    """Rows (doc_id, size, text_crc32, shard, slot) of all documents in
    ``shards`` leaves, or in leaves of ``target_bytes`` at most (but for a
    single point that is larger).  ``slot`` numbers each shard's rows from 0
    without gaps."""
    if (shards is None) == (target_bytes is None):
        raise ValueError("give shards or target_bytes")
    rows = written(points(docs, **columns), "sharding-points")
    dims = [c for c in rows.columns if c.startswith("d") and c[1:].isdigit()]
    groups = rows.groupBy("h").agg(F.sum("size").alias("w"), *[F.min(d).alias(d) for d in dims])
    groups = written(groups, "sharding-groups")
    stats = groups.agg(F.sum("w").alias("w"), *[f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)]).first()
    total = stats.w or 0
    shards = shards or max(1, -(-total // target_bytes))
    leaf = total / shards

    def key(i: int, d: str) -> Column:
        low, high = stats[f"min_{d}"] or 0.0, stats[f"max_{d}"] or 0.0
        value = F.floor((F.col(d) - F.lit(low)) * F.lit(((1 << VALUE_BITS) - 1) / ((high - low) or 1.0))).cast("long")
        return F.shiftleft(value, HASH_BITS) + F.pmod(F.xxhash64("h", F.lit(i)), F.lit(1 << HASH_BITS))

    light = groups.filter(F.col("w") <= leaf / HEAVY).select(
        "h", "w", *[key(i, d).alias(f"k{i}") for i, d in enumerate(dims)], F.lit(0).alias("node"))
    heavy = _dealt(groups, shards, leaf)
    load = dict.fromkeys(range(shards), 0) | {r.node: r.w for r in heavy.groupBy("node").agg(F.sum("w").alias("w")).collect()}  # a row a leaf
    level = _level(list(load.values()), total - sum(load.values()))
    wants = [0.0, *accumulate(max(0.0, level - load[i]) for i in range(shards))]  # of the leaves before each
    enough, todo = leaf / HEAVY / 8, [(0, shards)]
    while todo := [(first, n) for first, n in todo if n > 1]:
        light = _split(light, {first: (wants[first + n // 2] - wants[first], first, first + n // 2) for first, n in todo}, len(dims), enough)
        todo = [x for first, n in todo for x in ((first, n // 2), (first + n // 2, n - n // 2))]
    while target_bytes:  # leaves that are still too large are split again
        both = light.select("node", "w", F.lit(0).alias("big")).unionByName(heavy.select("node", "w", F.lit(1).alias("big")))
        over = both.groupBy("node").agg(F.sum("w").alias("w"), F.count("*").alias("n"), F.sum("big").alias("big"),
                                        F.sum(F.col("w") * F.col("big")).alias("big_w"))
        over = sorted(over.filter((F.col("w") > target_bytes) & (F.col("n") > 1)).collect())  # a row a leaf
        if not over:
            break
        # of several heavy points every other one goes, and half of the others; one heavy point keeps what makes up a half
        stays = lambda r: (r.w - r.big_w) / 2 if r.big != 1 else max(0.0, min(r.w - r.big_w, r.w / 2 - r.big_w))
        light = _split(light, {r.node: (float(stays(r)), r.node, shards + i) for i, r in enumerate(over)}, len(dims), enough)
        place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("w"), "h"))  # at most HEAVY + GIANT a leaf
        new = _small(heavy, [(r.node, shards + i) for i, r in enumerate(over)], "of int, other int")
        heavy = written(heavy.withColumn("place", place).join(new, F.col("node") == F.col("of"), "left").select(
            "h", "w", F.when(F.col("place") % 2 == 0, F.coalesce("other", "node")).otherwise(F.col("node")).alias("node")), "sharding-heavy")
        shards += len(over)
    placed = light.select("h", F.col("node").alias("shard")).unionByName(heavy.select("h", F.col("node").alias("shard")))
    out = rows.select("doc_id", "size", "text_crc32", "h").join(placed, "h")
    bins = max(1, SLOT_BINS // shards)
    out = out.withColumn("bin", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(bins)).cast("int"))
    counts = out.groupBy("shard", "bin").agg(F.count("*").alias("n"))
    before = counts.select(F.col("shard").alias("b_shard"), F.col("bin").alias("b_bin"),
                           (F.sum("n").over(Window.partitionBy("shard").orderBy("bin")) - F.col("n")).alias("before"))
    rank = F.row_number().over(Window.partitionBy("shard", "bin").orderBy("doc_id", "h"))
    out = out.withColumn("rank", rank).join(before, (F.col("shard") == F.col("b_shard")) & (F.col("bin") == F.col("b_bin")))
    return out.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("rank") - 1).alias("slot"))


def digest(docs: DataFrame, shards: int = 8) -> DataFrame:
    return assign(docs, shards=shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
