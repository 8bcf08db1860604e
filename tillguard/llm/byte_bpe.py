"""Byte-level BPE encoding and decoding with a sentencepiece model that is
serialised directly from a rank file.

Every byte of a vocabulary entry becomes one character (``chr(256 + byte)``),
the piece's score is its negative rank and the normaliser is the identity, so
sentencepiece's best-score merge is the lowest-rank merge.  Each match of the
pre-token pattern is encoded alone; decoding maps ids back to bytes.

Defined results: a null text is the empty text (no ids, empty bytes); repeated
rows each give a row; an empty table gives an empty table; extra columns are
kept, one with an output's name is replaced.
"""

from __future__ import annotations

import base64
import struct
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, gather, Recent, releasing, tokenizer_path, without

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
_SHIFT = {b: 256 + b for b in range(256)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, data: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def _number(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def to_chars(data: bytes) -> str:
    """Bytes as characters, one for each byte."""
    return data.decode("latin-1").translate(_SHIFT)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model whose ids are the ranks; the
    unknown piece, which no input can reach, has the id after the last."""
    order = sorted(ranks, key=ranks.get)
    if [ranks[x] for x in order] != list(range(len(order))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"bytes without a rank: {missing}")
    out = bytearray()
    for rank, piece in enumerate(order):
        out += _field(1, _field(1, to_chars(piece).encode()) + b"\x15" + struct.pack("<f", -float(rank)))
    out += _field(1, _field(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _number(3, 2))
    n = len(order)
    none = (1 << 64) - 1  # -1: the model has no such piece
    out += _field(2, _number(3, 2) + _number(4, n + 1) + _number(40, n) + _number(41, none) + _number(42, none) + _number(43, none))
    out += _field(3, _field(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0))
    return bytes(out)


#: White space (as the pattern has it, or wider) before a space.
ODD_SPACE = "[\\s\\x0b\\x1c-\\x1f\\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}] "


class Codec:
    """Encodes texts to ids and ids to bytes; one for each worker process."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        ranks = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(ranks))
        self.whole = {to_chars(k): array("i", [v]).tobytes() for k, v in ranks.items()}
        self.pre_tokens = regex.compile(pattern).findall
        self.known = Recent(self.learn, 150_000)
        self.spaced = Recent(lambda words: self.encode_chunks([" " + w for w in words]))

    def clear(self) -> None:
        self.known.clear()
        self.spaced.clear()

    def learn(self, pre_tokens: list[str]) -> list[bytes]:
        """Ids of pre-tokens as native 32-bit integers: the rank of one that
        is in the vocabulary, else the model's pieces."""
        chars = [to_chars(x.encode()) for x in pre_tokens]
        out = [self.whole.get(c) for c in chars]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, self.model.encode([chars[i] for i in rest], num_threads=1)):
            out[i] = array("i", ids).tobytes()
        return out

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of texts, each pre-token alone; an unknown one is encoded once."""
        cut = [self.pre_tokens(t) for t in chunks]
        distinct = list(set().union(*cut))
        ids_of = dict(zip(distinct, self.known.get(distinct)))
        return [b"".join([ids_of[x] for x in pre]) for pre in cut]

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of each text's ids, and all ids (null: none).

        No pre-token crosses a space that follows a non-space, so a text whose
        every space does so is cut at its spaces, and its distinct chunks (a
        space and a word) are encoded once; other texts are encoded whole."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, ODD_SPACE)
        whole = self.encode_chunks(texts.filter(odd).to_pylist())
        lists = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        coded = lists.flatten().dictionary_encode()
        words, number = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        # the first word of a text has no space before it: an entry of its own
        first = self.encode_chunks([words[i] for i in number[offsets[:-1]].tolist()])
        for i, x in zip(np.nonzero(odd.to_numpy(zero_copy_only=False))[0].tolist(), whole):
            first[i] = x
        parts = self.spaced.get(words) + first
        number[offsets[:-1]] = len(words) + np.arange(len(texts))
        size = np.array([len(x) // 4 for x in parts], np.int64)
        ends = np.concatenate([[0], np.cumsum(size[number])])
        return ends[offsets], gather(np.frombuffer(b"".join(parts), np.int32), (np.cumsum(size) - size)[number], size[number])

def from_chars(piece: str) -> bytes:
    """Inverse of to_chars."""
    return bytes(ord(c) - 256 for c in piece)


@lru_cache(maxsize=2)
def piece_bytes(path: str) -> list[bytes]:
    """The bytes of each id: the model's pieces, mapped back."""
    ranks = read_ranks(path)
    return [from_chars(to_chars(x)) for x in sorted(ranks, key=ranks.get)]


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def encode(df: DataFrame, text_col: str = "text", ids_col: str = "ids", vocabulary: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """Adds ``ids_col``, an array of token ids, to the rows of ``df``."""
    path, pattern = vocabulary or tokenizer_path(VOCABULARY), pattern or _pattern()
    bound_batches(df.sparkSession)
    df = without(df, [ids_col], text_col)
    schema = T.StructType([*df.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))])

    def run(batches):
        c = codec(path, pattern)
        for b in batches:
            offsets, values = c.encode_batch(b.column(text_col))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns, ids], [*b.schema.names, ids_col])
        c.clear()  # the next task's worker may be another

    return df.mapInArrow(releasing(run), schema)


def decode(df: DataFrame, ids_col: str = "ids", bytes_col: str = "decoded", vocabulary: str | None = None) -> DataFrame:
    """Adds ``bytes_col``, the bytes that the ids stand for (null ids: none)."""
    path = vocabulary or tokenizer_path(VOCABULARY)
    bound_batches(df.sparkSession)
    df = without(df, [bytes_col], ids_col)
    schema = T.StructType([*df.schema.fields, T.StructField(bytes_col, T.BinaryType())])

    def run(batches):
        pieces = piece_bytes(path)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        size = np.array([len(x) for x in pieces], np.int64)
        start = np.cumsum(size) - size
        for b in batches:
            lists = b.column(ids_col)
            ids, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(size[ids])])[offsets - offsets[0]]
            out = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(ends), pa.py_buffer(gather(data, start[ids], size[ids]))])
            out = out.cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, out], [*b.schema.names, bytes_col])

    return df.mapInArrow(releasing(run), schema)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's row for each document, from the ids and decoded bytes."""
    ids = encode(docs.select("doc_id", "text")).drop("text")
    both = decode(ids)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
