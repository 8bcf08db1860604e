"""HTML extraction by nearest-URL page differencing.

Pages of a host are ordered by URL path and each is paired with the neighbour
that shares the longer path prefix.  The text lines (blocks) of both are
aligned by a longest common subsequence, and shared lines are deleted, in and
outside of an article element: menus, notices and footers repeat from page to
page, the text does not.  Lines of a page's own stay wherever they lie.

A narrow exact check follows, with the page's neighbour on the other side as
witness.  A shared line of an article is given back if the witness does not
print it (a passage that two pages both print is content; what all neighbours
print is not), or, without a witness, if it is a passage of ``PASSAGE``
characters.  If a pair shares nearly everything (two copies of a page), the
lines that the witness prints are deleted, and without one the markup alone
decides.  A copy of the page is no witness.  Last, a line of its own that lies
in a menu, header, footer, sidebar, notice, advert, form or reader comments is
deleted.

Pairs need no group per host: pages are dealt by ranges of (host, path, id),
and the pages at the ends of a range go along to its neighbours.

Text: character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined by line feeds.  Defined results: a null
html is the empty page (empty text); a null URL is the empty host and path;
repeated rows are pages of their own (each other's nearest); a page alone in
its host has no pair and keeps what the markup leaves; documents of any length
are read whole; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from itertools import chain
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, releasing, written

# Elements by what they do to text.
DROPPED = frozenset("nav header footer aside form script style noscript template iframe svg canvas object select button "
                    "textarea head title dialog menu".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words of class, id or role that mark what is not the article.
NOISE = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|menu|nav\w*|breadcrumbs?|sidebar|aside|footer|header|masthead|"
                   r"cookies?|consent|notice|popup|modal|newsletter|subscribe|signup|login|share|social|related|"
                   r"comments?|disqus|replies|complementary|contentinfo|search)(?:$|[\s_-])", re.I)
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|replies|disqus|related|ads?)(?:$|[\s_-])", re.I)
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_UNQUOTED = re.compile(r"[^>\"']*")
_MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true""", re.I)
#: Zones of a block: what the markup says of it.
NOISY, PLAIN, ARTICLE = 0, 1, 2
#: Share of common lines, of those that are no noise, above which a pair counts as copies.
COPIES = 0.8
#: Least characters of a shared line of an article that stays without a witness.
PASSAGE = 200


def tags(page: str):
    """(start, end, closing, name, attributes) of a page's tags in order;
    comments and declarations have an empty name.  Each character is passed
    once: a quote without its partner is an ordinary character, and a tag
    without an end is text, as is all that follows it."""
    at = 0
    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = len(page) if end < 0 else end + 3
            yield at, end, False, "", ""
        elif page.startswith(("<!", "<?"), at):
            end = page.find(">", at) + 1
            if not end:
                return
            yield at, end, False, "", ""
        else:
            m = _NAME.match(page, at + 1)
            if m is None:
                at += 1
                continue
            end = m.end()
            while (end := _UNQUOTED.match(page, end).end()) < len(page) and page[end] != ">":
                close = page.find(page[end], end + 1)
                end = close + 1 if close >= 0 else end + 1
            if end >= len(page):
                return
            end += 1
            name = m[2].lower()
            yield at, end, bool(m[1]), name, page[m.end():end - 1]
            if name in RAW and not m[1]:  # raw text ends at its own end tag only, and is no text
                close = re.compile(f"</{name}(?=[\\s/>]|$)", re.I).search(page, end)
                end = close.start() if close else len(page)
                yield end, end, False, "", ""
        at = end


class _Open:
    """Open elements, with what they say of the text inside kept at hand."""

    def __init__(self):
        self.names: list[str] = []
        self.count: dict[str, int] = {}
        self.hard: list[int] = []      # places of elements that are noise whatever is in them,
        self.soft: list[int] = []      # of those that are noise unless an article is in them,
        self.articles: list[int] = []  # and of articles

    def push(self, name: str, bad: int, article: bool) -> None:
        place = len(self.names)
        self.names.append(name)
        self.count[name] = self.count.get(name, 0) + 1
        if bad:
            (self.hard if bad == 2 else self.soft).append(place)
        if article:
            self.articles.append(place)

    def pop(self) -> str:
        name = self.names.pop()
        self.count[name] -= 1
        for places in (self.hard, self.soft, self.articles):
            if places and places[-1] == len(self.names):
                places.pop()
        return name

    def close(self, name: str) -> None:
        if self.count.get(name):
            while self.pop() != name:
                pass

    def zone(self) -> int:
        within = self.articles[-1] if self.articles else 0
        if self.hard or (self.soft and self.soft[-1] >= within):
            return NOISY
        return ARTICLE if self.articles else PLAIN


def blocks(page: str) -> list[tuple[str, int]]:
    """Text blocks of a page in order, with their zones; linear in its length."""
    out: list[tuple[str, int]] = []
    stack = _Open()
    text: list[str] = []
    at = 0

    def flush():
        if text:
            words = html.unescape("".join(text)).split()
            text.clear()
            if words:
                out.append((" ".join(words), stack.zone()))

    raw = False
    for start, end, closing, name, marks in tags(page):
        if at < start and not raw:
            text.append(page[at:start])
        at, raw = end, name in RAW and not closing
        if not name:
            continue  # a comment or declaration
        if name in INLINE and name not in VOID:
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in VOID:
            if name == "hr":
                flush()
            continue
        flush()
        if closing:
            stack.close(name)
            continue
        if marks.endswith("/") and name in ("svg", "iframe"):
            raw = False
            continue
        # 2: noise whatever is in it; 1: unless an article is (a wrapper's class may name its parts)
        bad = 2 if name in DROPPED or (marks and _HIDDEN.search(marks)) else 0
        if not bad and marks and name not in ("html", "body", "article", "main"):
            values = [x.strip("\"'") for x in _MARKS.findall(marks)]
            bad = 2 if any(COMMENTS.search(x) for x in values) else int(any(NOISE.search(x) for x in values))
        # a header inside an article holds its title
        if name == "header" and stack.articles:
            bad = 0
        if name == "p" or name == "li":  # these end themselves
            while stack.names and stack.names[-1] == name:
                stack.pop()
        stack.push(name, bad, name in ("article", "main"))
    text.append(page[at:])
    flush()
    return out


def address(url: str | None) -> tuple[str, str]:
    """Host and path of a URL; of one that can't be read, the whole as path."""
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or "").lower(), (parts.path.rstrip("/") or "/") if url else ""
    except ValueError:
        return "", url or ""


def shared_lines(a: list, b: list) -> list[bool]:
    """Which lines of ``a`` are in a longest common subsequence with ``b``."""
    lo, hi = 0, 0  # common ends need no table
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    out = [True] * lo + [False] * (len(a) - lo - hi) + [True] * hi
    there = set(b[lo:len(b) - hi])
    rows = [i for i in range(lo, len(a) - hi) if a[i] in there]
    if not rows:
        return out
    # one bit for each line of b: clear where the subsequence with the lines of
    # a so far grows by it.  Of the rows of bits every step-th is kept, and the
    # others are made again on the way back.
    here, places, width = {a[i] for i in rows}, {}, 0
    for x in b[lo:len(b) - hi]:
        if x in here:
            places.setdefault(x, []).append(width)
            width += 1
    often = {x: sum(1 << p for p in ps) for x, ps in places.items() if len(ps) > 64}  # few lines, so few masks
    full, step = (1 << width) - 1, math.isqrt(len(rows)) + 1

    def after(v, i):
        mask = often.get(a[i])
        if mask is None:
            mask = 0
            for p in places[a[i]]:
                mask |= 1 << p
        u = v & mask
        return ((v + u) | (v - u)) & full

    kept, v = [], full
    for r, i in enumerate(rows):
        if r % step == 0:
            kept.append(v)
        v = after(v, i)
    c = width
    for first in range(len(kept) - 1, -1, -1):
        part = rows[first * step:(first + 1) * step]
        made = [kept[first]]
        for i in part:
            made.append(after(made[-1], i))
        made = [x.to_bytes(width // 8 + 1, "little") for x in made]
        for r in range(len(part), 0, -1):
            now, before = made[r], made[r - 1]
            while c and now[(c - 1) >> 3] >> ((c - 1) & 7) & 1:
                c -= 1
            if c and before[(c - 1) >> 3] >> ((c - 1) & 7) & 1:
                out[part[r - 1]] = True
                c -= 1
    return out


def affinity(a: tuple[str, str], b: tuple[str, str] | None) -> int:
    """Length of the common path prefix of two addresses; -1 in two hosts."""
    if b is None or a[0] != b[0]:
        return -1
    n = 0
    for x, y in zip(a[1], b[1]):
        if x != y:
            break
        n += 1
    return n


def kept_lines(lines: list, zones: list[int], sizes: list[int], other: list | None, third: list | None) -> tuple[list[bool], int, int]:
    """Which lines of a page stay, given its lines (or their hashes) and their
    characters, its pair's lines and those of the neighbour on the other side;
    how many the differencing deleted, and how many of those the check gave
    back."""
    shared = shared_lines(lines, other) if other is not None else [False] * len(lines)
    here = [i for i, z in enumerate(zones) if z != NOISY]
    witness = set(third) if third is not None else None
    if witness is not None and sum(lines[i] in witness for i in here) > COPIES * len(here):
        witness = None
    if sum(shared[i] for i in here) > COPIES * len(here):
        back = [i for i in here if shared[i] and (witness is None or lines[i] not in witness)]
    else:
        back = [i for i in here if shared[i] and zones[i] == ARTICLE
                and (sizes[i] >= PASSAGE if witness is None else lines[i] not in witness)]
    given = set(back)
    return [z != NOISY and (not s or i in given) for i, (s, z) in enumerate(zip(shared, zones))], sum(shared), len(back)


#: Keys that are sampled, by hash, to place the bounds of the ranges, at least
#: and for each range; bytes of pages that a range holds on average at most.
SAMPLED_KEYS, SAMPLED_PER_RANGE = 20_000, 16
RANGE_BYTES = 64 << 20
KEY = ["host", "path", "id"]


def _keys(pages: DataFrame) -> DataFrame:
    """(host, path, id) of each page, from the id and URL columns alone."""
    def run(batches):
        for b in batches:
            ids, urls = b.columns
            where = [address(u) for u in urls.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in where], pa.string()), pa.array([x[1] for x in where], pa.string()),
                                              pc.fill_null(ids, -1)], KEY)

    return pages.select("page_id", "url").mapInArrow(releasing(run), "host string, path string, id long")


def _ranges(pages: DataFrame, n: int) -> tuple[list[tuple], dict[tuple, list[int]]]:
    """Bounds of ``n`` ranges of keys, and the keys that go along to other
    ranges: the last of the range before and the first of the range after
    (ranges without pages are passed over).  Both are bounded by ``n``."""
    keys = written(_keys(pages), "html-keys")
    sampled = max(SAMPLED_KEYS, SAMPLED_PER_RANGE * n)
    share = sampled / max(1, keys.count())
    sample = keys.filter(F.pmod(F.xxhash64(*KEY), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, share))))
    sample = sorted(tuple(r) for r in sample.distinct().limit(4 * sampled).collect())
    bounds = sorted({sample[len(sample) * i // n] for i in range(1, n)}) if sample else []

    def run(batches):
        for b in batches:
            bins = [bisect_right(bounds, k) for k in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.RecordBatch.from_arrays([pa.array(bins, pa.int32()), *b.columns], ["bin", *KEY])

    ends = keys.mapInArrow(releasing(run), "bin int, host string, path string, id long").groupBy("bin").agg(
        F.min(F.struct(*KEY)).alias("first"), F.max(F.struct(*KEY)).alias("last"))
    ends = sorted(ends.collect())  # a row for each range
    guests: dict[tuple, list[int]] = {}
    for a, b in zip(ends, ends[1:]):
        guests.setdefault(tuple(a["last"]), []).append(b["bin"])
        guests.setdefault(tuple(b["first"]), []).append(a["bin"])
    return bounds, guests


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each page: page_id, url, text, pair_url (of the page it was
    compared with), n_deleted (lines the differencing deleted) and n_restored
    (lines that the check gave back).

    Pages move once, as hashes of their lines and the compressed text of the
    lines that may stay."""
    spark = pages.sparkSession
    bound_batches(spark)
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         F.col(html_col).cast("string").alias("html"))
    size = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-size // RANGE_BYTES))
    bounds, guests = _ranges(pages, n)

    def parse(batches):
        import xxhash
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            out = []
            for page_id, url, page in zip(*(c.to_pylist() for c in b.columns)):
                host, path = address(url)
                key = (host, path, -1 if page_id is None else page_id)
                found = blocks(page or "")
                zones = bytes(z for _, z in found)
                hashes = np.array([xxhash.xxh3_64_intdigest(t) for t, _ in found], np.uint64).tobytes()
                text = pack("\n".join(t for t, z in found if z != NOISY).encode())
                out.append((bisect_right(bounds, key), False, page_id, url, *key, hashes, zones, text))
                out += [(g, True, page_id, url, *key, hashes, zones, b"") for g in guests.get(key, ())]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), KINDS)], NAMES)

    rows = pages.mapInArrow(releasing(parse), LINES).repartitionById(n, F.col("bin")).sortWithinPartitions("bin", *KEY, "url", "hashes")

    def pair(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress

        def rows_of():
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns))

        def row(prev, cur, nxt):
            near = [(affinity(cur[4:6], x[4:6]), x) for x in (prev, nxt) if x is not None and x[0] == cur[0]]
            near = sorted((x for x in near if x[0] >= 0), key=lambda x: -x[0])  # the one before comes first on a tie
            best = near[0][1] if near else None
            lines_of = lambda x: np.frombuffer(x[7], np.uint64).tolist()
            zones, texts = list(cur[8]), unpack(cur[9]).decode().split("\n")
            # lines that are noise have no text here, and need no size
            size = iter(texts)
            sizes = [len(next(size)) if z != NOISY else 0 for z in zones]
            keep, deleted, back = kept_lines(lines_of(cur), zones, sizes, *[lines_of(x) for _, x in near], *[None] * (2 - len(near)))
            text = "\n".join(t for t, k in zip(texts, (k for k, z in zip(keep, zones) if z != NOISY)) if k)
            return (cur[2], cur[3], text, best[3] if best else None, deleted, back)

        def batch(out):
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                              ["page_id", "url", "text", "pair_url", "n_deleted", "n_restored"])

        out, prev, cur = [], None, None
        for nxt in chain(rows_of(), [None]):
            if cur is not None and not cur[1]:
                out.append(row(prev, cur, nxt))
                if len(out) >= 256:
                    yield batch(out)
                    out = []
            prev, cur = cur, nxt
        if out:
            yield batch(out)

    return rows.mapInArrow(releasing(pair), "page_id long, url string, text string, pair_url string, n_deleted long, n_restored long")


LINES = "bin int, guest boolean, page_id long, url string, host string, path string, id long, hashes binary, zones binary, text binary"
NAMES = [x.split()[0] for x in LINES.split(", ")]
KINDS = [pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]


def digest(pages: DataFrame) -> DataFrame:
    out = extract(pages)
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "pair_url", "n_deleted", "n_restored")
