"""Quality, toxicity, secrets, sharding and I-Match on small tables."""
import collections
import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tillguard.llm import imatch, quality, secrets, sharding, toxicity

GOOD = "the river ran past {} old mills and over {} stones while children watched from the {} bank and sang songs of spring there"
BAD = "b$y### {}&&& n0w!! {}%%% ### *** $$$ cl1ck!! {}### fr33&&& w1n%%% ### b$y### n0w*** d3al!! $$$ y3s&&& n0%%% %%% !!"


def _labelled(spark, n=240):
    rows = []
    for i in range(n):
        bad, tox = i % 3 == 0, i % 4 == 1
        t = (BAD if bad else GOOD).format(f"w{i}", f"v{i % 17}", f"u{i % 5}") + (" you stupid awful clown" if tox else "")
        rows.append((i, t, int(not bad), int(tox)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    return docs.select("doc_id", "text"), docs.select("doc_id", "quality", "toxic")


EDGE = [None, "", " \n\t ", "one", "word " * 30000, "line a\nline a\nline b\n\n\nline a"]


def _edge(spark):
    return spark.createDataFrame([(1000 + i, t) for i, t in enumerate(EDGE)] + [(None, "x y z"), (1003, "one")], "doc_id long, text string")


def _base(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    n = collections.Counter(grams)
    hit = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w)


def test_quality_base_counts_equal_brute_force_and_model_separates(spark):
    docs, labels = _labelled(spark)
    out = quality.score_quality(docs.unionByName(_edge(spark)), quality.fit_quality(docs, labels)).collect()
    assert len(out) == 240 + len(EDGE) + 2
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == _base(r.text)
        if r.doc_id is not None and r.doc_id < 240:
            assert r.kept == (r.doc_id % 3 != 0) and 0 <= r.quality_prob <= 1


def test_quality_holds_out(spark):
    docs, labels = _labelled(spark)
    model = quality.fit_quality(docs.filter("doc_id % 5 < 3"), labels)
    held = quality.score_quality(docs.filter("doc_id % 5 >= 3"), model).collect()
    assert sum(r.kept == (r.doc_id % 3 != 0) for r in held) >= 0.95 * len(held)


def test_quality_without_labels_uses_base_rules(spark):
    docs, labels = _labelled(spark, 6)
    assert quality.fit_quality(docs, labels.filter("quality = 1")) is None
    assert quality.fit_quality(docs.limit(0), labels) is None
    out = quality.score_quality(docs, None).collect()
    assert all(r.quality_prob is None and r.kept != r.base_failed for r in out)
    assert quality.score_quality(docs.withColumn("Kept", F.lit(1)), None).first().kept is not None
    assert toxicity.score_severity(docs.withColumn("toxic", F.lit(1)), None).first().toxic is False
    assert secrets.find_secrets(docs.withColumn("spans", F.lit(1))).first().spans == []


def test_secrets_next_to_words():
    import random
    import string

    from tillguard.llm.common import tokenizer_path

    encode = secrets._encoding(tokenizer_path(secrets.VOCABULARY)).encode_ordinary
    rnd = random.Random(8)
    found = lambda t: [(s, e) for s, k, e in secrets.scan(t, encode) if k == 3]
    around = [(a, b) for a in ("/static/resources/javascript/", "https://example.com/download/documents/report/", "session_identifier_",
                               "build-artifact-release-", "") for b in ("", "/index/overview", "_of_customer")]
    for letters, whole in ((string.ascii_letters + string.digits, True), (string.ascii_letters + string.digits + "+/", False)):
        missed = cut = 0
        for a, b in around * 20:
            key = "".join(rnd.choices(letters, k=32))
            text = f"é see {a}{key}{b} there"
            at = text.index(key)
            hits = [(s, e) for s, e in found(text) if s < at + 32 and e > at]
            missed += not hits
            cut += bool(hits) and not any(s <= at and e >= at + 32 for s, e in hits)
        assert missed <= 3 and cut <= (0 if whole else 9), (missed, cut)
    for text in ("/static/resources/javascript/jquery-ui/themes/smoothness", "users/550e8400-e29b-41d4-a716-446655440000/profile", "",
                 "objects/da39a3ee5e6b4b0d3255bfef95601890afd80709/download", "get_user_by_id_v2_from_cache_with_lock",
                 "https://example.com/2024/01/02/some-article-about-things-15", "de-DE_phoneBook/i18n/utf8_general_ci"):
        assert found(text) == [], text


def test_platt_orders_probabilities():
    import numpy as np

    m = np.array([-3.0, -2, -1, -0.5, 0.5, 1, 2, 3] * 10)
    slope, offset = quality.platt(m, (m > 0).astype(float))
    assert slope > 0 and abs(offset) < 1e-6
    assert quality.platt(m, np.ones(len(m))) == (1.0, 0.0)


def test_toxicity_grades_and_edges(spark):
    docs, labels = _labelled(spark)
    model = toxicity.fit_severity(docs, labels.unionByName(spark.createDataFrame([(1, None, None), (None, 1, 1)], labels.schema)))
    out = {r.doc_id: r for r in toxicity.score_severity(docs.unionByName(_edge(spark)), model).collect()}
    for i in range(240):
        assert out[i].toxic == (i % 4 == 1)
    assert not out[1000].toxic and not out[1004].toxic
    assert (model.thresholds[1:] > model.thresholds[:-1]).all()
    assert toxicity.fit_severity(docs, labels.filter("toxic = 0")) is None
    assert not any(r.toxic for r in toxicity.score_severity(docs, None).collect())
    assert toxicity.score_severity(docs.limit(0), model).count() == 0


def test_ordinal_fit_orders_severity():
    import numpy as np

    rng = np.random.default_rng(0)
    grade = rng.integers(0, 4, 2000)
    rows = [np.array(sorted({j for j in range(8) if rng.random() < (0.9 if j < 2 * g else 0.05)}), np.int64) for g in grade]
    w, theta = toxicity.fit_ordinal(rows, grade, 8)
    model = toxicity.SeverityModel(np.arange(8), w, theta)
    mean = [np.mean([model.severity(w[r].sum()) for r, g in zip(rows, grade) if g == k]) for k in range(4)]
    assert all(b > a + 0.5 for a, b in zip(mean, mean[1:]))


def test_secrets_of_one_case_and_names():
    import random
    import string

    from tillguard.llm.common import tokenizer_path

    encode = secrets._encoding(tokenizer_path(secrets.VOCABULARY)).encode_ordinary
    rnd = random.Random(5)
    draw = lambda letters, n: "".join(rnd.choice(letters) for _ in range(n))
    # digests have 32 or 40 characters, so hexadecimal keys of other lengths
    for letters, n, most in ((string.ascii_lowercase, 32, 0.08), (string.ascii_uppercase, 32, 0.02), ("0123456789abcdef", 24, 0.01),
                             ("0123456789ABCDEF", 24, 0.01), (string.ascii_letters + string.digits, 32, 0.01),
                             (string.ascii_letters + string.digits + "-_", 32, 0.01)):
        missed = sum(not any(k == 3 for _, k, _ in secrets.scan(f"the value {draw(letters, n)} is here", encode)) for _ in range(300))
        assert missed <= most * 300, (letters, missed)
    licence = "-".join(draw(string.ascii_uppercase + string.digits, 5) for _ in range(5))
    assert secrets.scan(licence, encode) == [(0, 3, 29)]
    for name in ("LMP2023-04-Q3-rev12-final", "internationalization-of-things", "INTERNATIONALIZATIONOFTHINGS", "2023-04-01T12-00-00Z-run7",
                 "donaudampfschiffahrtsgesellschaftskapitaen", "a-to-z-of-it-in-an-or-by-up", "----------------------"):
        assert secrets.scan(name, encode) == [], name


def test_secret_spans_equal_plain_patterns(spark):
    texts = ["password = 'abcd1234' token:short é api_key=\"A1b2C3d4E5\"", "AKIA" + "Z" * 12 + " AKIAB", "0123456789abcdef" * 2 + " " + "f" * 31,
             "key Zk3vQ9xLw2Rt7YpB5nHs8Dg4 end", "id 123e4567-e89b-12d3-a456-426614174000 word", "supercalifragilisticexpialidocious",
             "SECRET  ==  nothing_here", "PASSWD:" + "x" * 200000, None, "", "toKen=abcdefgh"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = {r.doc_id: r.spans for r in secrets.find_secrets(docs).collect()}
    pat = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for i, t in enumerate(texts):
        t = t or ""
        want = [("assign", *m.span()) for m in pat.finditer(t) if len(m[2]) >= 8]
        want += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        want += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        assert sorted((s.kind, s.start, s.end) for s in out[i] if s.kind != "random") == sorted(want), t[:40]
    assert [(s.kind, texts[3][s.start:s.end]) for s in out[3]] == [("random", "Zk3vQ9xLw2Rt7YpB5nHs8Dg4")]
    assert out[4] == [] and out[5] == [] and out[10] == [("assign", 0, 14)] or out[10] == []
    red = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    assert red[3] == "key [SECRET] end" and red[8] is None and red[5] == texts[5]
    d = {r.doc_id: r for r in secrets.digest(docs).collect()}
    base = ",".join(f"{s.kind}:{s.start}:{s.end}" for s in out[0] if s.kind != "random")
    assert d[0].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and d[0].n_assign == 2


@pytest.mark.parametrize("shards", [8, 5, 1])
def test_shards_are_balanced_gapless_and_keep_equal_texts(spark, shards):
    rows = [(i, "copy of one page " * 20 if i % 3 == 0 else f"text {i} " * (i % 40), f"l{i % 4}", f"s{i % 7}", 1) for i in range(1500)]
    rows += [(2000, None, None, None, 1), (2001, "", None, "s1", 1), (5, "text 5 " * 5, "l1", "s5", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard int")
    out = sharding.assign(docs, shards=shards).collect()
    assert len(out) == len(rows)
    text = {r[0]: r[1] for r in rows}
    size, slots, where = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    for r in out:
        data = (text[r.doc_id] or "").encode()
        assert r.size == len(data) + 1 and r.text_crc32 == zlib.crc32(data)
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
        where[text[r.doc_id]].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(s) == 1 for s in where.values())
    total, hot = sum(size.values()), 500 * (len("copy of one page " * 20) + 1)
    if hot < total / shards or shards == 1:
        assert max(size.values()) <= 1.02 * total / shards
    assert sharding.digest(docs.limit(0)).count() == 0


def test_target_bytes_gives_enough_leaves(spark):
    docs = spark.createDataFrame([(i, "x" * 99, "a", "b") for i in range(100)], "doc_id long, text string, lang string, source string")
    docs = docs.withColumn("text", F.concat("text", F.col("doc_id").cast("string")))
    out = sharding.assign(docs, target_bytes=2048).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    assert len(out) == 5 and max(r.n for r in out) <= 2048


def test_hundreds_of_leaves_are_balanced_and_within_target_bytes(spark):
    import random
    r = random.Random(2)
    texts = ["x" * int(r.paretovariate(1.2) * 20 % 3000) + str(i) for i in range(1500)] + ["copy " * 30] * 300
    docs = spark.createDataFrame([(i, t, f"l{i % 4}", f"s{i % 9}") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    for how in ({"shards": 300}, {"target_bytes": 700}):
        out = sharding.assign(docs, **how).collect()
        assert len(out) == len(texts)
        leaf, held, home = collections.Counter(), collections.defaultdict(set), collections.defaultdict(set)
        for row in out:
            leaf[row.shard] += row.size
            held[row.shard].add(texts[row.doc_id])
            home[texts[row.doc_id]].add(row.shard)
        assert all(len(x) == 1 for x in home.values())  # equal texts stay together
        if "shards" in how:
            level = sorted(leaf.values())[150]  # some leaves hold one large text
            near = [b for s, b in leaf.items() if len(held[s]) > 1]
            assert len(leaf) == 300 and sum(0.75 * level <= b <= 1.25 * level for b in near) >= 0.8 * len(near)
        else:
            assert all(b <= 700 or len(held[s]) == 1 for s, b in leaf.items())


def test_imatch_edits_and_equal_fingerprints(spark):
    texts = [" ".join(f"w{(i * j) % 211}" for j in range(1, 60)) for i in range(1, 60)] + [None, "", "é🙂x", "w1 w2"] * 2
    docs = spark.createDataFrame([(3 * i, t, 1) for i, t in enumerate(texts)] + [(None, "w1 w2", 2), (0, texts[0], 1)], "doc_id long, text string, h int")
    out = imatch.digest(docs).collect()
    assert len(out) == len(texts) + 2
    order = sorted(range(len(texts)), reverse=True)
    nexts = {3 * a: texts[b] or "" for a, b in zip(order, order[1:])} | {0: "w1 w2"}
    seen = collections.defaultdict(set)
    for r in out:
        if r.doc_id is None:
            continue
        t = texts[r.doc_id // 3] or ""
        k = len(t) // 2
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256((t[:len(t) - k] + nexts[r.doc_id][:k]).encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        seen[t].add(r.fingerprint)
    assert all(len(s) == 1 for s in seen.values())
    long = [r for r in out if r.n_chars > 100]
    assert sum(r.near_edited for r in long) > sum(r.near_next for r in long)
    assert imatch.digest(docs.limit(0)).count() == 0


def test_imatch_short_texts_have_fingerprints_of_their_own(spark):
    rows = [(i, f"w{(i * 7) % 500} w{(i * 31) % 493} w{(i * 57) % 479}") for i in range(1500)] + [(2000, ""), (2001, None), (2002, "alone"), (2003, "a\n")]
    rows += [(3000 + i, "w1 w2 w3 copied") for i in range(4)]
    out = {r.doc_id: r for r in imatch.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(out) == len(rows) and all(r.fingerprint and r.edited_fingerprint for r in out.values())
    text, order = dict(rows), sorted(out, reverse=True)
    for a, b in zip(order, order[1:] + order[:1]):
        if (text[a] or "") == (text[b] or ""):
            assert out[a].near_next == 1 and out[a].fingerprint == out[b].fingerprint
        elif not set((text[a] or "").split()) & set((text[b] or "").split()):
            assert out[a].near_next == 0
    assert out[2001].fingerprint == out[2000].fingerprint != out[2002].fingerprint


def test_imatch_hash_equals_a_plain_version(spark):
    codes = [(1 << 48) + 5, (1 << 48) + 3, (7 << 48) + 9, (1 << 62) + (1 << 48) + 3, (1 << 62) + (1 << 48) + 5]
    df = spark.createDataFrame([(codes,)], "codes array<long>")
    r = df.select(imatch.subset_hashes(F.col("codes")).alias("x")).first().x
    top = [e >> 32 for e in r]
    assert top == [1, 7, (1 << 14) + 1] and r[0] & 0xFFFFFFFF == r[2] & 0xFFFFFFFF
