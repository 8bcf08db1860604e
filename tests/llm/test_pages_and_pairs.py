"""HTML differencing, WARC archives, the Jaccard join and the pipeline."""
import collections
import hashlib
import io
import random
import time
import tracemalloc

import numpy as np
import pytest

from tillguard.llm import html_diff, jaccard, warc


def _page(body, foot="same foot"):
    return (f"<html><head><title>t</title><script>if (a<b) x('</p>')</script></head><body><nav><ul><li><a>Menu</a></li></ul></nav>"
            f"<!-- x --><div class='ad'>Buy</div>{body}<footer>{foot}</footer></body></html>")


def test_blocks_and_zones():
    got = html_diff.blocks(_page("<article><h1>A &amp; B</h1><p><b>one<br> two</b>\n three<p>x&eacute;</p><aside>no</aside></article>"))
    assert [t for t, z in got if z == html_diff.ARTICLE] == ["A & B", "one two three", "xé"]
    assert "Menu" in [t for t, z in got if z == html_diff.NOISY] and not any("x(" in t for t, _ in got)
    wrapped = html_diff.blocks("<div class='content with-sidebar'><main><p>In</p><div class='cookie-notice'>no</div></main></div>"
                               "<div id=comments><article><p>Reader</p></article></div>")
    assert [t for t, z in wrapped if z == html_diff.ARTICLE] == ["In"]
    assert html_diff.blocks("") == [] and html_diff.blocks("plain < text") == [("plain < text", html_diff.PLAIN)]


def test_shared_lines_is_a_longest_common_subsequence():
    rnd = random.Random(3)
    for _ in range(200):
        a, b = ([rnd.choice("abcde") for _ in range(rnd.randint(0, 9))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        got = html_diff.shared_lines(a, b)
        kept, at = [x for x, s in zip(a, got) if s], 0
        assert len(kept) == best[len(a)][len(b)]
        for x in kept:
            at = b.index(x, at) + 1


def test_alignment_of_longer_lists_by_blocks_of_rows():
    rnd = random.Random(7)
    for n, letters in ((300, 40), (500, 500), (400, 3)):
        a, b = ([rnd.randrange(letters) for _ in range(n + rnd.randrange(50))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        kept, at = [x for x, s in zip(a, html_diff.shared_lines(a, b)) if s], 0
        assert len(kept) == row[-1]
        for x in kept:
            at = b.index(x, at) + 1


@pytest.mark.parametrize("page", ["<a " * 330_000, "<a " * 330_000 + "'\">\"", "<div>" * 200_000, "<div>" * 90_000 + "</p>" * 90_000, "<a '\"x>" * 140_000,
                                  "<!--" * 250_000, "<!a " * 250_000, "<script>x" * 100_000, "<div class='" + "a " * 500_000 + "'>x", "<p>&amp;" * 120_000])
def test_a_long_odd_page_takes_linear_time(page):
    t0 = time.time()
    html_diff.blocks(page)
    assert time.time() - t0 < 10


def test_many_lines_in_another_order_take_little_time_and_memory():
    a = list(range(40_000))
    b = a[:]
    random.Random(1).shuffle(b)
    t0 = time.time()
    tracemalloc.start()
    assert sum(html_diff.shared_lines(a, b)) > 300
    assert tracemalloc.get_traced_memory()[1] < 300e6 and time.time() - t0 < 60
    tracemalloc.stop()


def test_tags_with_quotes_and_without_ends():
    assert html_diff.blocks("<p title='a>b'>x</p><p title=\"it's\">y<p alt=it's>z") == [(t, html_diff.PLAIN) for t in ("x", "y", "z")]
    assert html_diff.blocks("one <b two") == [("one <b two", html_diff.PLAIN)]
    assert html_diff.blocks("<p>a<!-- <p>b</p> --><!x>c<3 d</p>e") == [("ac<3 d", html_diff.PLAIN), ("e", html_diff.PLAIN)]
    assert html_diff.blocks("<script>a</b></script><p>x</p><textarea><p>y</textarea>z") == [("x", html_diff.PLAIN), ("z", html_diff.PLAIN)]


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_pages_without_article_lose_what_neighbours_share(spark, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = [(i, f"http://h.example/a/{i:03d}", f"<html><body><div>Shared top</div><p>Own text {i}</p><div>Shared end</div></body></html>", 0)
                for i in range(40)]
        rows += [(100, "http://alone.example/x", "<p>Lonely</p>", 0), (101, None, None, 0), (102, "http://[bad", "", 0),
                 (103, "http://h2.example/x", _page("<article><p>Copied</p></article>"), 0),
                 (104, "http://h2.example/y", _page("<article><p>Copied</p></article>"), 0), (104, "http://h2.example/y", _page("<article><p>Copied</p></article>"), 0)]
        out = html_diff.digest(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
        assert len(out) == len(rows)
        text = {r.page_id: r.text for r in out}
        assert all(text[i] == f"Own text {i}" for i in range(40))
        assert text[100] == "Lonely" and text[101] == "" and text[102] == "" and text[103] == text[104] == "Copied"
        assert all(r.n_chars == len(r.text) for r in out)
        assert html_diff.digest(spark.createDataFrame(rows, "page_id long, url string, html string, text int").limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_the_alignment_decides_on_pages_with_an_article(spark):
    passage = "A passage that two pages print. " * 10
    rows = []
    for i in range(12):
        both = f"<p>Quoted by two {i // 2}</p>"
        body = (f"<div>Same strap line</div><div id=content><p>Main text {i}</p></div><article><p>Teaser {i}</p></article>"
                f"<main><p>Printed on every page</p><p>{'Terms of every page. ' * 20}</p><p>Story {i}</p>{both}</main>")
        rows.append((i, f"http://many.example/a/{i // 2}/{i}", _page(body)))
    two = "<main><p>Short and shared</p><p>{}</p><p>Own {}</p></main>"
    rows += [(20 + i, f"http://two.example/{i}", _page(two.format(passage, i))) for i in range(2)]
    twin = "<div id=content><p>One</p><p>Two</p></div><article><p>Tease</p></article>"
    rows += [(30 + i, f"http://twins.example/{i}", _page(twin)) for i in range(2)]
    rows += [(40 + i, f"http://edge.example/a/{x}", _page(f"<main><p>Strap</p>{''.join(f'<p>{y} {k}</p>' for k in range(9))}</main>"))
             for i, (x, y) in enumerate([("0", "Other"), ("10", "Twin"), ("11", "Twin"), ("2", "More")])]
    rows += [(50, "http://alone.example/", _page("<div>Main</div><article><p>Teaser</p></article>"))]
    out = {r.page_id: r for r in html_diff.digest(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(1, 11):  # the pages at the ends have one neighbour
        assert out[i].text == f"Main text {i}\nTeaser {i}\nStory {i}\nQuoted by two {i // 2}" and out[i].n_restored == 1
    for i in range(2):
        assert out[20 + i].text == f"{passage.strip()}\nOwn {i}"
        assert out[30 + i].text == "One\nTwo\nTease"
        assert out[41 + i].text == "\n".join(f"Twin {k}" for k in range(9))
    assert out[50].text == "Main\nTeaser"


def test_any_split_of_an_archive_gives_each_record_once():
    rnd = random.Random(1)
    bodies = [bytes(rnd.choices(b"abc <>", k=rnd.choice([0, 5, 400, 60000]))) for _ in range(60)]
    bodies[3] = warc.member(b"WARC/1.1 not a record") + warc.MAGIC * 50  # looks like members
    data = b"".join(warc.member(warc.record(i, "http://x/é\r\n", p, hashlib.sha256(p).hexdigest(), None), i % 3) for i, p in enumerate(bodies))
    for split in (777, 5000, 1 << 20):
        got = [warc.parse(x) for s in range(0, len(data), split) for x in warc.records_in(io.BytesIO(data), len(data), s, min(len(data), s + split))]
        assert [g[0] for g in got] == list(range(60)) and all(g[2] == p for g, p in zip(got, bodies))


def test_warc_round_trip_with_revisits(spark):
    big = "x" * 150
    rows = [(5, "http://a", big, 1), (2, None, big, 1), (9, "http://b", big, 1), (1, "http://c", "small", 1), (3, "http://d", "small", 1),
            (4, "http://e", None, 1), (6, "http://f", "", 1), (7, "http://g", "é" * 200000, 1), (9, "http://b", big, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    manifest = warc.write(warc.with_revisits(pages), archive_bytes=500)
    out = warc.read(manifest, split_bytes=300).collect()
    assert len(out) == len(rows)
    for r in out:
        data = next((h or "").encode() for i, _, h, _ in rows if i == r.page_id)
        assert r.payload_bytes == len(data) and r.payload_digest == hashlib.sha256(data).hexdigest()
        want = 2 if data == big.encode() and r.page_id != 2 else None
        assert r.refers_to == want and r.record_type == ("revisit" if want else "response")
        assert (r.payload is None) == bool(want)
    assert warc.digest(pages.limit(0)).count() == 0


def test_warc_null_page_id(spark):
    assert warc.parse(warc.record(None, None, b"x", "", None))[0] is None and warc.parse(warc.record(0, None, b"x", "", None))[0] == 0
    big, only = "x" * 150, "y" * 150
    rows = [(None, "http://a", big), (None, None, big), (3, "http://b", big), (4, "http://c", big), (None, "http://d", only),
            (None, "http://e", only), (None, "http://f", None), (-1, "http://g", "small"), (None, "http://h", "small")]
    out = warc.read(warc.write(warc.with_revisits(spark.createDataFrame(rows, "page_id long, url string, html string")))).collect()
    got = collections.Counter((r.page_id, r.url, r.payload and bytes(r.payload).decode(), r.payload_digest, r.record_type, r.refers_to) for r in out)
    want = collections.Counter()
    for i, u, h in rows:
        ref = 3 if i == 4 else None  # a null id is neither referred to nor a revisit
        want[i, u, "" if h is None else None if ref else h, hashlib.sha256((h or "").encode()).hexdigest(), "revisit" if ref else "response", ref] += 1
    assert {(r[0], r[1], r[2] or "", *r[3:]) for r in got} == {(r[0], r[1], r[2] or "", *r[3:]) for r in want} and sum(got.values()) == len(rows)
    assert warc.digest(spark.createDataFrame(rows, "page_id long, url string, html string")).filter("page_id is null").count() == 6


def _shingles(t):
    w = (t or "").split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def test_jaccard_join_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP", 16)  # groups above this are dealt to chunks
    rnd = random.Random(4)
    base = [[f"w{rnd.randint(0, 400)}" for _ in range(80)] for _ in range(12)]
    texts = []
    for k, b in enumerate(base):
        for _ in range(60 if k == 0 else rnd.randint(1, 5)):
            w = list(b)
            for _ in range(rnd.randint(0, 4)):
                w[rnd.randrange(len(w))] = f"n{rnd.randint(0, 9999)}"
            texts.append(" ".join(w))
    texts += [texts[0]] * 20 + ["", "", None, None, "a b", "a  b", "c", "x " * 5000]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "c", 1)], "doc_id long, text string, node int")
    out = {r.doc_id: r for r in jaccard.join(docs).collect()}
    sets = [_shingles(t) for t in texts]
    links, parent = collections.Counter(), list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            same = texts[i] == texts[j]
            if same or (both and 5 * both >= 4 * len(sets[i] | sets[j])):
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    for i in range(len(texts)):
        assert (out[i].class_id, out[i].n_links) == (root(i), links[i]), (i, texts[i] and texts[i][:30])
    assert out[None].class_id is None and out[None].n_links == 0
    assert jaccard.join(docs.limit(0)).count() == 0
    kept = jaccard.stage(spark, docs, None).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({root(i) for i in range(len(texts))})


def test_jaccard_repeated_rows_count_once_as_copies(spark):
    a = " ".join(f"w{i}" for i in range(100))
    b = a + " more"
    docs = spark.createDataFrame([(1, a), (1, a), (2, b), (3, "x y z"), (3, "x y z")], "doc_id long, text string")
    out = sorted((r.doc_id, r.class_id, r.n_links, r.n_text_links) for r in jaccard.join(docs).collect())
    assert out == [(1, 1, 2, 1), (1, 1, 2, 1), (2, 1, 2, 1), (3, 3, 1, 0), (3, 3, 1, 0)]


def test_jaccard_tiles_and_chunks(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(jaccard, "GROUP", 16)
    monkeypatch.setattr(jaccard, "TILE_BYTES", 1000)
    size = np.array([8] * 40 + [5000] + [8] * 9)
    runs = jaccard.tiles(np.arange(50), size)
    assert np.concatenate(runs).tolist() == list(range(50)) and max(len(r) for r in runs) <= 16
    assert jaccard.tiles(np.zeros(0, int), size) == []
    # pairs of tiles give the links of all pairs, and the forest joins what they join
    rnd = np.random.default_rng(1)
    sets = [np.unique(np.concatenate([np.arange(100 * (k % 3), 100 * (k % 3) + 60), rnd.integers(1 << 20, 1 << 30, k % 17)])).astype(np.uint64)
            for k in range(50)]
    size = np.array([len(x) for x in sets])
    sig = jaccard.signatures(np.concatenate(sets), np.concatenate([[0], np.cumsum(size)]))
    runs = jaccard.tiles(np.arange(50), 8 * size)
    label, got, edges = np.arange(50), set(), []
    for k, a in enumerate(runs):
        for b in [None, *runs[k + 1:]]:
            i, j = jaccard.linked(sig, sets, size, a, b)
            got |= set(zip(i.tolist(), j.tolist()))
            label, x, y = jaccard.hooked(label, i, j)
            edges += list(zip(x.tolist(), y.tolist()))
    want = {(i, j) for i in range(50) for j in range(i + 1, 50)
            if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))}
    assert got == want and set(edges) <= want
    assert len(edges) == 50 - len(set(label.tolist())) and all(label[i] == label[j] for i, j in want)
    # a group of n rows is sent sqrt(n / GROUP) times, or as its bytes ask
    rows = spark.range(1600).select(F.col("id").alias("node"), F.lit(1600).alias("size"))
    dealt = jaccard._dealt(rows, jaccard._chunks(F.col("size"), F.lit(1))).cache()
    assert dealt.count() == 1600 * 10 and dealt.select("lo", "hi").distinct().count() == 55
    assert jaccard._dealt(rows, jaccard._chunks(F.col("size"), F.lit(40 * jaccard.CHUNK_BYTES))).count() == 1600 * 40
    both = {}
    for r in dealt.collect():
        both.setdefault((r.lo, r.hi), []).append((r.node, r.chunk))
    times = collections.Counter((min(a, b), max(a, b)) for of in both.values() for a, x in of for b, y in of
                                if a < b < 200 and (x != y or len({c for _, c in of}) == 1))
    assert len(times) == 199 * 100 and set(times.values()) == {1}  # every pair is compared once


def test_pruning_keeps_pairs_at_the_threshold():
    least = jaccard.least_matches()
    assert len(least) == jaccard.VALUES // jaccard.STEP and (least[1:] >= least[:-1]).all()
    assert least[-1] < 0.8 * jaccard.VALUES


def test_pipeline_stages_take_effect(spark, scratch):
    import corpus_pipeline as p
    from test_documents import _labelled

    docs, labels = _labelled(spark, 240)
    extra = [(500, "the river ran past key Zk3vQ9xLw2Rt7YpB5nHs8Dg4 mills and stones while children watched from the bank and sang old songs of spring"),
             (501, None), (502, ""), (503, docs.filter("doc_id = 2").first().text)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    from pyspark.sql import functions as F

    docs = docs.select("doc_id", "text", F.lit("en").alias("lang"), F.concat(F.lit("s"), F.col("doc_id") % 3).alias("source"),
                       F.length("text").cast("long").alias("n_chars"))
    labels.write.parquet(f"{scratch}/labels.parquet")
    docs = docs.withColumns({c: F.lit(1) for c in ("kept", "toxic", "spans", "k", "node", "ids", "queue", "severity", "root")})
    docs.write.parquet(f"{scratch}/documents.parquet")
    now, ids = docs, []
    for i, (_, stage) in enumerate(p.STAGES):
        out = stage(spark, now, scratch)
        if i < len(p.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(f"{scratch}/{i}")
        now = spark.read.parquet(f"{scratch}/{i}")
        ids.append({r.doc_id for r in now.select("doc_id").collect()})
    good = {i for i in range(240) if i % 3}
    assert ids[0] == good | {500, 503}
    assert ids[1] == {i for i in good if i % 4 != 1} | {500, 503}
    assert 503 not in ids[2] and ids[2] <= ids[1] and ids[3] == ids[2] == ids[4]
    assert "[SECRET]" in spark.read.parquet(f"{scratch}/3").filter("doc_id = 500").first().text
    assert p.run(spark, scratch).count() == now.count()
