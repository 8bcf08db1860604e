"""Byte-level BPE and packing against the tokenizer libraries."""
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillguard.llm import byte_bpe, packing
from tillguard.llm.common import tokenizer_path

TEXTS = ["", None, "a", " a", "a  b", "a \n b\n", "\n\n x\t y  ", "日本語 テキスト  🙂👍🏽 x", "'s don't I'LL we're", "a\x1c b\x1c c",
         "x　 y\xa0z   q", "ab" * 3000, "İstanbul ΣΑΣ ſtraße é é ½x 12ab3, ab.'s <|endoftext|> x", "Ñandú! ŉx ..., $5 %%% a_b",
         "same text", "same text", "µm ªº ÀÉ×Ö÷ \x01 \x01x"]


def _docs(spark, texts=TEXTS, source=lambda i: f"s{i % 3}" if i % 4 else None):
    return spark.createDataFrame([(i, t, source(i), 7) for i, t in enumerate(texts)], "doc_id long, text string, source string, ids int")


def test_bpe_equals_tiktoken_and_round_trips(spark):
    import public_tokenizers
    import tiktoken

    ranks = byte_bpe.read_ranks(tokenizer_path(byte_bpe.VOCABULARY))
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = _docs(spark).drop("ids")
    out = byte_bpe.decode(byte_bpe.encode(docs)).collect()
    assert len(out) == len(TEXTS)
    for r in out:
        assert r.ids == enc.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def test_bpe_clash_and_empty_table(spark):
    clash = byte_bpe.encode(_docs(spark))  # it has a column ids, which is replaced
    assert clash.columns == ["doc_id", "text", "source", "ids"] and clash.filter("doc_id = 2").first().ids != 7
    with pytest.raises(ValueError):
        byte_bpe.encode(_docs(spark), ids_col="text")
    assert byte_bpe.digest(_docs(spark).limit(0)).count() == 0


def test_bpe_model_needs_every_byte():
    with pytest.raises(ValueError):
        byte_bpe.model_proto({b"a": 0})


def _library_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path(packing.VOCABULARY))
    t.encode_special_tokens = True
    return [t.encode(x or "", add_special_tokens=False).ids + [packing.END_ID] for x in texts]


def test_word_ids_equal_the_library():
    tok = packing.WordTokens(tokenizer_path(packing.VOCABULARY))
    offsets, ids = tok.encode_batch(pa.array(TEXTS, pa.string()), packing.END_ID)
    for i, want in enumerate(_library_ids(TEXTS)):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == want, TEXTS[i]


def test_word_ids_of_odd_letters_equal_the_library():
    """Turkish, Greek, extended Latin, combining marks, CJK and separators."""
    import random
    r = random.Random(9)
    letters = "İıŞşĞğŚśŐőŒœŸÿÀéÑßẞſµΣσςΩΆώЖжЁё日本語ªº½\u0301\u0307\u0323\u0130\u0149ﬁǅ١٢\u200d🙂" + "aAzZ09" * 3
    marks = "   \n\t.,;:!?*#$%&|'\"-_/()\u00a0\u2028"
    texts = ["İstanbul Şirket Ğazi", "TARİHİ. Son", "İzmir Şubat ayı.", "İ. İ, İ", "Şubat Ğ Ś", "ΟΔΟΣ. ΣΑΣ", "I\u0307stanbul i\u0307."]
    texts += ["".join(r.choice(letters if r.random() < 0.75 else marks) for _ in range(r.randrange(1, 40))) for _ in range(6000)]
    tok = packing.WordTokens(tokenizer_path(packing.VOCABULARY))
    offsets, ids = tok.encode_batch(pa.array(texts, pa.string()), packing.END_ID)
    wrong = [t for i, (t, want) in enumerate(zip(texts, _library_ids(texts))) if ids[offsets[i]:offsets[i + 1]].tolist() != want]
    assert not wrong, (len(wrong), wrong[:3])


def _check_pieces(rows, texts, window):
    ids = _library_ids(texts)
    docs, seqs = {}, {}
    for r in rows:
        want = ids[r.doc_id][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *want)) and r.doc_tokens == len(ids[r.doc_id])
        docs.setdefault(r.doc_id, []).append((r.start, r.length))
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length, r.source))
    assert set(docs) == set(range(len(texts)))
    for d, pieces in docs.items():
        at = 0
        for s, n in sorted(pieces):
            assert s == at
            at += n
        assert at == len(ids[d])
    full = 0
    for pieces in seqs.values():
        at = 0
        for o, n, _ in sorted(pieces):
            assert o == at
            at += n
        full += at == window
    assert full >= len(seqs) - 1 and sorted(seqs) == list(range(len(seqs)))
    return seqs


def test_packing_covers_every_id_once(spark):
    texts = TEXTS + [" ".join(f"word{i % 97} other" for i in range(50 * (k % 9))) for k in range(60)]
    rows = packing.with_ids_crc32(packing.pack(_docs(spark, texts), window=256, quantum=16)).collect()
    _check_pieces(rows, texts, 256)


def test_packing_keeps_the_mixture_in_every_window(spark):
    texts = ["one two three four " * 400] * 9 + ["five six " * 800] * 3
    docs = _docs(spark, texts, source=lambda i: "big" if i < 9 else "small")
    rows = packing.with_ids_crc32(packing.pack(docs, window=512, quantum=16)).collect()
    seqs = _check_pieces(rows, texts, 512)
    total = sum(n for p in seqs.values() for _, n, _ in p)
    share = sum(n for p in seqs.values() for _, n, s in p if s == "big") / total
    for q in range(len(seqs) - 2):
        assert abs(sum(n for _, n, s in seqs[q] if s == "big") / 512 - share) <= 2 * 16 / 512


def test_packing_by_target_shares_carries_on_when_a_queue_is_empty(spark):
    texts = ["one two three four " * 400] * 6 + ["five six " * 200] * 2
    docs = _docs(spark, texts, source=lambda i: "big" if i < 6 else "small")
    rows = packing.with_ids_crc32(packing.pack(docs, shares={"big": 1, "small": 1}, window=512, quantum=16)).collect()
    seqs = _check_pieces(rows, texts, 512)
    assert abs(sum(n for _, n, s in seqs[0] if s == "small") - 256) <= 32
    assert all(s == "big" for _, _, s in seqs[max(seqs) - 1])


def test_packing_keeps_target_shares_of_300_sources(spark):
    texts = ["one " * (699 if i < 10 else 99) for i in range(300)]
    docs = _docs(spark, texts, source=lambda i: f"s{i}" if i else None)
    shares = {f"s{i}" if i else None: 10 if i < 10 else 1 for i in range(300)}
    rows = packing.with_ids_crc32(packing.pack(docs, shares=shares, window=390 * 16, quantum=16)).collect()
    seqs = _check_pieces(rows, texts, 390 * 16)
    for q in range(4):
        got = {}
        for _, n, s in seqs[q]:
            got[s] = got.get(s, 0) + n
        assert all(abs(got.get(s, 0) - 16 * w) <= 16 for s, w in shares.items())


def test_packing_by_sort_equals_packing_by_totals(spark, monkeypatch):
    texts = TEXTS + [" ".join(f"word{i % 97} other" for i in range(50 * (k % 9))) for k in range(60)]
    for shares in (None, {"s0": 3, "s1": 1, None: 2, "absent": 5}):
        out = []
        for most in (256, 3):
            monkeypatch.setattr(packing, "MAX_QUEUES", most)
            monkeypatch.setattr(packing, "LISTED", 7)
            out.append(sorted(map(str, packing.with_ids_crc32(packing.pack(_docs(spark, texts), shares, window=256, quantum=16)).collect())))
        assert out[0] == out[1] and len(out[0]) > 100


def test_ranks_are_a_permutation():
    r = packing.Rounds([1000, 10, 333, 0, 7777], [1000.0, 10.0, 333.0, 1.0, 7777.0], 8)
    q = np.repeat(np.arange(5), r.full)
    k = np.concatenate([np.arange(n) for n in r.full])
    assert sorted(r.rank(q, k).tolist()) == list(range(len(q)))


def test_packing_empty_table(spark):
    assert packing.digest(_docs(spark).limit(0)).count() == 0
    assert F is not None
