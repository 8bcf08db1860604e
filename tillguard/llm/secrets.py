"""Secret scans: fixed patterns, and a token-efficiency test for random strings.

A run of key characters that mixes character classes and yields few characters
per token under a tiktoken vocabulary is a random string: trained merges hold
words, names and numbers together, but not keys.  Known digests (hexadecimal,
of a digest's length) and identifiers (UUIDs, numbers, runs of letters in one
case or in camel case, unless 20 letters of one case stand together, which the
test then tells from words) are excluded from that test; the base patterns stand.
Other runs of hexadecimal digits have a limit of their own, since decimal digits
share tokens.  A run with separators is random as a whole only if its segments
that pass the test are as long as a key.

A run that passes as a whole may hold a key next to words (a path, a prefixed
name).  Its segments between / _ - + are tested each, and neighbours that are
random, or too short to tell, count as one string: keys may hold separators.

Positions are code points, ends exclusive.  Defined results: a null or empty
text has no spans; texts of any length are scanned whole; repeated rows are
scanned each; an empty table gives an empty table; extra columns are kept,
one with the output's name is replaced.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, releasing, tokenizer_path, without

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Kinds in the order that breaks ties at one start.
KINDS = ("assign", "access", "hex", "random")
# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
#: Candidates of the token test: maximal runs, and the most characters per token.
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}")
MAX_CHARS_PER_TOKEN = 1.9
#: The same for hexadecimal runs that are no digests.
MAX_HEX_PER_TOKEN = 2.3
DIGEST_LENGTHS = frozenset((32, 40, 48, 56, 64, 96, 128))
#: Segments of a run: UUIDs, and what lies between separators.
SEGMENT = re.compile(r"(?<![^/_+-])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![^/_+-])|[^/_+-]+")
#: Least characters of a candidate, of a segment that marks one, and most of a word that may be a piece of one.
RUN_LEAST, SEGMENT_LEAST, SHORT = 16, 8, 3
#: Letters of one case without separators are words below this length, whatever their tokens.
ONE_CASE_LEAST = 20
_hex_only = re.compile(r"[0-9a-f]+|[0-9A-F]+").fullmatch
_uuid = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}").fullmatch
_between = re.compile(r"[/_+-]").split
_turns = re.compile(r"[a-z](?=[A-Z])|[A-Z](?=[a-z])").findall

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))


@lru_cache(maxsize=2)
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def is_identifier(run: str) -> bool:
    """Whether a run is a known digest, a UUID, a number, or words."""
    if _uuid(run) or (_hex_only(run) and len(run) in DIGEST_LENGTHS):
        return True
    letters = [c for c in run if c.isalpha()]
    if not letters:
        return True
    if any(c.isdigit() for c in run):
        return False
    # letters only: words, unless their case turns about as often as in random text or they are very long
    return len(_turns(run)) * 3 < len(letters) and max(map(len, _between(run))) < ONE_CASE_LEAST


def is_random(run: str, encode, most: float) -> bool:
    """The token test."""
    if _hex_only(run):
        most = max(most, MAX_HEX_PER_TOKEN)
    return len(run) <= most * len(encode(run))


def holds_key(run: str, encode, most: float) -> bool:
    """Whether the segments with letters that pass the token test are, with the
    separators between them, as long as a key."""
    random = [len(x) + 1 for x in _between(run) if not x.isdigit() and x and is_random(x, encode, most)]
    return sum(random) - 1 >= RUN_LEAST


def keys_within(run: str, encode, most: float) -> list[tuple[int, int]]:
    """Spans of random strings next to words in a run."""
    parts = [(m.start(), m.end(), m[0]) for m in SEGMENT.finditer(run)]
    marks = {a for a, b, x in parts if b - a >= SEGMENT_LEAST and not is_identifier(x)}
    if len(parts) < 2 or not marks:
        return []
    out, held = [], []  # held: neighbours that may be one string, and whether each is random

    def close():
        sure = [(a, b) for a, b, random in held if random]
        # all of them, else from the first to the last that is random, else each of these
        for spans in ([(held[0][0], held[-1][1])], [(sure[0][0], sure[-1][1])], sure) if sure else ():
            good = [(a, b) for a, b in spans if b - a >= RUN_LEAST and any(a <= x < b for x in marks)
                    and not is_identifier(run[a:b]) and is_random(run[a:b], encode, most)]
            if good:
                out.extend(good)
                break
        held.clear()

    for a, b, x in parts:
        known = _uuid(x) or (_hex_only(x) and b - a in DIGEST_LENGTHS)
        random = not known and is_random(x, encode, most)
        if random or (b - a < SEGMENT_LEAST and not is_identifier(x)) or (held and b - a <= SHORT):
            held.append((a, b, random))
        else:
            close()
    close()
    return out


def scan(text: str, encode, most: float = MAX_CHARS_PER_TOKEN) -> list[tuple[int, int, int]]:
    """Spans (start, kind's number, end) of one text in order."""
    out = []
    low = text.lower()
    if "pass" in low or "secret" in low or "token" in low or "api" in low:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    for m in RUN.finditer(text):
        run = m[0]
        if is_identifier(run):
            continue
        if is_random(run, encode, most) and holds_key(run, encode, most):
            out.append((m.start(), 3, m.end()))
        else:
            out += [(m.start() + a, 3, m.start() + b) for a, b in keys_within(run, encode, most)]
    return sorted(out)


def find_secrets(docs: DataFrame, text_col: str = "text", out_col: str = "spans", vocabulary: str | None = None,
                 most: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """Adds ``out_col``: the spans (kind, start, end) of each whole text."""
    path = vocabulary or tokenizer_path(VOCABULARY)
    docs = without(docs, [out_col], text_col)
    bound_batches(docs.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        encode = _encoding(path).encode_ordinary
        for b in batches:
            spans = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scan(t or "", encode, most)]
                     for t in b.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(spans, kind)], [*b.schema.names, out_col])

    return docs.mapInArrow(releasing(run), T.StructType([*docs.schema.fields, T.StructField(out_col, SPANS)]))


def redacted(text: str, spans, mark: str) -> str:
    """``text`` with each span, or run of overlapping spans, replaced."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: s["start"]):
        if s["start"] >= at:
            out += [text[at:s["start"]], mark]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", vocabulary: str | None = None) -> DataFrame:
    """``docs`` with every found secret replaced by ``mark``; null stays null."""
    path = vocabulary or tokenizer_path(VOCABULARY)
    bound_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches):
        encode = _encoding(path).encode_ordinary
        for b in batches:
            new = []
            for t in b.column(at).to_pylist():
                found = scan(t, encode) if t else []
                new.append(redacted(t, [{"start": s, "end": e} for s, _, e in found], mark) if found else t)
            yield b.set_column(at, b.schema.field(at).name, pa.array(new, pa.string()))
        _encoding.cache_clear()  # an idle worker holds no vocabulary

    return docs.mapInArrow(releasing(run), docs.schema)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def digest(docs: DataFrame) -> DataFrame:
    found = find_secrets(docs.select("doc_id", "text")).drop("text")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: keeps every document, with its secrets replaced and
    n_chars counted anew where they were."""
    out = redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out
