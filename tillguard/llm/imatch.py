"""Document fingerprints by I-Match, in DataFrame operations only.

A text's terms are its distinct lower-case words.  Terms whose inverse document
frequency lies in a band form the lexicon; each of several randomised lexicon
subsets keeps a term with a set probability, and a term that none keeps goes to
one of the densest, so every term counts.  The hash of a text's sorted terms
within a subset is that subset's hash; subsets in which the text has no term
give none.  The fingerprint lists the subset hashes; the likeness of two is the
share of equal hashes among the subsets that either has.  Subsets of several
densities keep the hashes telling for short and for long texts: dense ones hold
terms of a short text, sparse ones outlive edits of a long one.

The band starts at a share of the texts, so the lexicon holds at most (mean
distinct terms a text) / ``LEAST_SHARE`` terms however many texts there are; it
is broadcast only after its size is checked.

Document frequencies are counted over all texts; a group of equal texts of more
than ``GREATEST_SHARE / 10`` of the rows counts once, so that one copied page
does not make its own words common (there are at most 10 / GREATEST_SHARE such
groups).

Defined results: a null text is the empty text; a text without lexicon terms
has a hash of the whole text as its fingerprint, so its likeness to an equal
text is 1 and to any other 0; rows that repeat id and text are one document with a row each; a
null id counts as the least id; one document alone is its own next; an empty table gives an
empty table; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: The inverse-document-frequency band as shares of the texts, and fewest texts.
LEAST_SHARE, GREATEST_SHARE, LEAST_TEXTS = 1 / 2000, 1 / 10, 2
#: Subsets, and the probability with which the subsets of each quarter keep a term.
SUBSETS, DENSITIES = 32, (16, 64, 256, 1024)
#: A lexicon of at most this many terms (about 40 bytes each) is broadcast.
BROADCAST_TERMS = 1_000_000
#: Stands for a null id (so it is the last in descending order), and the term
#: that marks a row, so that texts without lexicon terms stay.
NO_ID, MARK = -(1 << 63), 0
#: Bins of the order by id.
ORDER_BINS = 256
_TERM_BITS, _HASH_BITS = 48, 32


def terms(text: Column) -> Column:
    """64-bit hashes of the distinct lower-case words, their lowest bit clear."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    hashes = F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w).bitwiseAND(F.lit(-2)))
    return F.array_distinct(hashes)


def _case(value: Column, bounds: list, lo: int = 0, hi: int | None = None) -> Column:
    """Number of bounds that are at most ``value``, as a balanced CASE."""
    hi = len(bounds) if hi is None else hi
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(value < F.lit(bounds[mid]), _case(value, bounds, lo, mid)).otherwise(_case(value, bounds, mid + 1, hi))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))


def following(keys: DataFrame) -> DataFrame:
    """(id, h, n, next_id, next_h) for distinct (id, h, n): the next document by
    descending id, after the last the first.  Ids are dealt to bins by their
    percentiles; a bin's last document takes the first of the next bin."""
    keys = written(keys, "imatch-order")
    cut = [i / ORDER_BINS for i in range(1, ORDER_BINS)]
    bounds = sorted(set(keys.agg(F.percentile_approx("id", F.array(*map(F.lit, cut)), F.lit(10000)).alias("p")).first().p or []))
    binned = keys.withColumn("bin", _case(F.col("id"), bounds))
    by_bin = Window.partitionBy("bin").orderBy(F.desc("id"), "h")
    ranked = binned.withColumn("next", F.lead(F.struct("id", "h")).over(by_bin))
    # a row for each bin: the first document of the bin after it, else of the first bin
    firsts = binned.groupBy("bin").agg(F.min(F.struct(F.bitwise_not("id").alias("i"), "h")).alias("f")).select(
        "bin", F.struct(F.bitwise_not(F.col("f.i")).alias("id"), F.col("f.h").alias("h")).alias("f"))
    every = Window.orderBy(F.desc("bin"))  # over ORDER_BINS rows at most
    heads = firsts.select(F.col("bin").alias("b"), F.coalesce(
        F.lead("f").over(every), F.first("f").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("head"))
    got = F.coalesce("next", "head")
    return ranked.join(F.broadcast(heads), F.col("bin") == F.col("b")).select(
        "id", "h", "n", got["id"].alias("next_id"), got["h"].alias("next_h"))


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h, next_id, next_h, text, edited): ``edited`` is the text whose last
    half is replaced by as many first characters of the next document's."""
    rows = _rows(docs, id_col, text_col)
    links = written(following(rows.select("id", "h", F.length("text").alias("n")).distinct()), "imatch-next")
    wants = links.select(F.col("next_id").alias("w_id"), F.col("next_h").alias("w_h"), F.col("id").alias("for_id"),
                         F.col("h").alias("for_h"), F.expr("cast(floor(n / 2) as int)").alias("want"))
    parts = rows.join(wants, (F.col("id") == F.col("w_id")) & (F.col("h") == F.col("w_h"))).select(
        "for_id", "for_h", F.col("id").alias("next_id"), F.col("h").alias("next_h"),
        F.expr("substring(text, 1, want)").alias("part")).dropDuplicates(["for_id", "for_h"])
    out = rows.join(parts, (F.col("id") == F.col("for_id")) & (F.col("h") == F.col("for_h")))
    half = F.expr("substring(text, 1, cast(length(text) - floor(length(text) / 2) as int))")
    return out.select("id", "h", "next_id", "next_h", "text", F.concat(half, F.col("part")).alias("edited"))


def lexicon(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(term, codes): the terms in the band, each with a code for every subset
    that keeps it: the subset's number and 48 bits of the term's hash."""
    rows = _rows(docs, id_col, text_col)
    n = max(1, rows.count())
    hot = rows.groupBy("h").agg(F.count("*").alias("n"), F.min("id").alias("first")).filter(F.col("n") > max(1, n * GREATEST_SHARE / 10))
    hot = written(hot, "imatch-copies")  # at most 10 / GREATEST_SHARE rows
    counted = rows.join(F.broadcast(hot.select(F.col("h").alias("c_h"), "first")), F.col("h") == F.col("c_h"), "left").filter(
        F.col("first").isNull() | (F.col("id") == F.col("first")))
    df = counted.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    band = df.filter((F.col("df") >= max(LEAST_TEXTS, n * LEAST_SHARE)) & (F.col("df") <= max(LEAST_TEXTS, n * GREATEST_SHARE)))
    each = SUBSETS // len(DENSITIES)
    kept = [F.when(F.pmod(F.xxhash64("term", F.lit(k)), F.lit(DENSITIES[k // each])) == 0,
                   F.lit(k << _TERM_BITS) + F.pmod(F.xxhash64("term", F.lit(-1)), F.lit(1 << _TERM_BITS))) for k in range(SUBSETS)]
    codes = F.filter(F.array(*kept), lambda c: c.isNotNull())
    dense = F.shiftleft(F.pmod(F.xxhash64("term", F.lit(SUBSETS)), F.lit(each)), _TERM_BITS) + F.pmod(F.xxhash64("term", F.lit(-1)), F.lit(1 << _TERM_BITS))
    return band.select("term", codes.alias("codes")).withColumn("codes", F.when(F.size("codes") > 0, F.col("codes")).otherwise(F.array(dense)))


_SIDE_BIT = 62  # of a code: set for the edited text


def subset_hashes(codes: Column) -> Column:
    """From sorted codes, one entry for each (side, subset) that has any: the
    side and subset, and 32 bits of the hash of its sorted terms."""
    top = lambda c: F.shiftright(c, _TERM_BITS)
    term = lambda c: c.bitwiseAND(F.lit((1 << _SIDE_BIT) - 1))  # noqa: E731  the same for either side
    none = F.struct(F.lit(-1).cast("long").alias("group"), F.lit(0).cast("long").alias("hash"), F.array().cast("array<long>").alias("done"))
    entry = lambda s: F.shiftleft(s["group"], _HASH_BITS) + F.pmod(s["hash"], F.lit(1 << _HASH_BITS))
    closed = lambda s: F.when(s["group"] < 0, s["done"]).otherwise(F.concat(s["done"], F.array(entry(s))))
    step = lambda s, c: F.when(
        s["group"] == top(c), F.struct(s["group"].alias("group"), F.xxhash64(s["hash"], term(c)).alias("hash"), s["done"].alias("done"))
    ).otherwise(F.struct(top(c).alias("group"), F.xxhash64(term(c)).alias("hash"), closed(s).alias("done")))
    return F.aggregate(F.sort_array(codes), none, step, closed)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that either fingerprint has."""
    subsets = lambda x: F.transform(x, lambda e: F.shiftright(e, _HASH_BITS))
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(subsets(a), subsets(b)))


def as_text(fingerprint: Column) -> Column:
    return F.concat_ws("-", F.transform(fingerprint, lambda e: F.lower(F.hex(e))))


def fingerprints(texts: DataFrame, lex: DataFrame) -> DataFrame:
    """From (id, h, text, edited, ...): a row for each (id, h) with the subset
    hashes of both texts (own, other), the number of equal rows (copies) and
    the first value of each further column.  Where no subset has a hash, that
    of the whole text stands in, as of a subset of its own."""
    texts = texts.withColumn("e_h", F.xxhash64("edited"))
    more = [c for c in texts.columns if c not in ("id", "h", "text", "edited")]
    side = lambda col, bit: F.transform(terms(F.col(col)), lambda t: t + F.lit(bit))
    every = F.concat(F.array(F.lit(MARK)), side("text", 0), side("edited", 1))
    spread = texts.select("id", "h", *more, F.explode(every).alias("t"))
    mark = lex.sparkSession.range(1).select(F.lit(MARK).alias("term"), F.array(F.lit(-1).cast("long")).alias("codes"))
    if lex.count() <= BROADCAST_TERMS:
        lex = F.broadcast(lex.unionByName(mark))  # its size is checked
    else:
        lex = lex.unionByName(mark)
    hits = spread.join(lex, F.col("t").bitwiseAND(F.lit(-2)) == F.col("term"))
    code = F.explode(F.transform("codes", lambda c: c + F.shiftleft(F.col("t").bitwiseAND(F.lit(1)), _SIDE_BIT)))
    codes = hits.select("id", "h", *more, code.alias("code"))
    hashes = codes.groupBy("id", "h").agg(
        F.collect_set("code").alias("codes"), F.count_if(F.col("code") < 0).alias("copies"), *[F.first(c).alias(c) for c in more])
    hashes = hashes.withColumn("all", subset_hashes(F.filter("codes", lambda c: c >= 0)))
    shift = _SIDE_BIT - _TERM_BITS + _HASH_BITS
    own = F.filter("all", lambda e: F.shiftright(e, shift) == 0)
    other = F.transform(F.filter("all", lambda e: F.shiftright(e, shift) == 1), lambda e: e - F.lit(1 << shift))
    whole = lambda found, h: F.when(F.size(found) > 0, found).otherwise(
        F.array(F.lit(SUBSETS << _HASH_BITS) + F.pmod(F.col(h), F.lit(1 << _HASH_BITS))))
    return hashes.select("id", "h", "copies", *[c for c in more if c != "e_h"], whole(own, "h").alias("own"), whole(other, "e_h").alias("other"))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's row for each document."""
    lex = written(lexicon(docs, id_col, text_col), "imatch-lexicon")
    pairs = with_edits(docs, id_col, text_col).select(
        "id", "h", "next_id", "next_h", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "text", "edited")
    found = written(fingerprints(pairs, lex), "imatch-fingerprints")
    nexts = found.select(F.col("id").alias("n_id"), F.col("h").alias("n_h"), F.col("own").alias("n_own"))
    out = found.join(nexts, (F.col("next_id") == F.col("n_id")) & (F.col("next_h") == F.col("n_h")))
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return out.select(F.nullif(F.col("id"), F.lit(NO_ID)).alias("doc_id"), "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"),
                      as_text(F.col("other")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("other")).alias("near_edited"),
                      likeness(F.col("own"), F.col("n_own")).alias("near_next"))
