"""Page extraction, vector search and URL filter against brute force, with odd input."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tablegauge.llm import html_mincut, kd_search, url_bloom
from tablegauge.llm.queries import URL_RULES

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site Name</h1><p>Best tagline in the world today.</p></header>
<nav class="menu"><a href="/">Home</a><a href="/b">About</a></nav><div class="sidebar"><p>Popular posts are listed here.</p></div>
<div class="wrapper"><div class="post"><h1>Title of it</h1><p>First paragraph, of some length &amp; with <b>bold</b> words.
<p>Second&nbsp;one is   here.<div class="advert"><p>Buy now, this is great stuff.</p></div>
<ul><li>item one of the list</li><li>item two of it</li></ul><form><p>Enter your mail to subscribe.</p></form></div>
<SCRIPT>x</SCRIPT><!-- <p>no</p> --><section id="comments"><p>Nice article, thanks for sharing it.</p></section></div>
<div class="cookie-notice"><p>We use cookies on this site.</p></div><footer><p>&copy; 2020 someone.</p></footer></body></html>"""
TEXT = """Title of it
First paragraph, of some length & with bold words.
Second one is here.
item one of the list
item two of it"""


def test_main_text_of_a_page(spark):
    rows = [(i, f"u{i}", PAGE) for i in range(20)] + [(None, None, PAGE), (30, "u", None), (31, "u", ""), (32, "u", "<p"), (33, "u", "<div><p>" * 3000)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = html_mincut.extracted(pages).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.text == (TEXT if r.page_id is None or r.page_id < 20 else r.text) and r.n_chars == len(r.text)
        if r.page_id in (30, 31, 33):
            assert r.text == ""
    assert html_mincut.extracted(pages.limit(0)).count() == 0


def test_blocks_keep_all_text_of_plain_markup():
    blocks = html_mincut.blocks_of("a<b>b</b> c<p>d &lt;e&gt; \n f<br>g</p>h<!-- x --><style>no</style>")
    assert [b.text for b in blocks] == ["ab c", "d <e> f g", "h"]
    long = html_mincut.blocks_of("<p>" + "word " * 50_000 + "</p>" + '<a href="' * 2000)
    assert long[0].text == ("word " * 50_000).strip()


def _without_names(page):
    """The page without class, id and role, and with div for all elements of telling names."""
    page = re.sub(r"""\s(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", "", page, flags=re.I)
    telling = html_mincut.BOILERPLATE_TAGS | {"header", "article", "main", "section"}
    return re.sub(rf"<(/?)({'|'.join(telling)})\b", r"<\1div", page, flags=re.I)


def test_the_cut_decides_where_names_do_not_tell(spark):
    """On the given pages without their names, the cut mends nearly all that the look of a block alone gets wrong."""
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect() if r.html]
    blocks = [b for b in map(html_mincut.blocks_of, pages) if b]
    named = [b for page in blocks for b in page if b.hint]
    weights, cut = html_mincut.fit_weights([b.features for b in named], [int(b.hint > 0) for b in named]), html_mincut.Cut()
    by_look = by_cut = n = 0
    for page in pages:
        known, bare = html_mincut.blocks_of(page), html_mincut.blocks_of(_without_names(page))
        if known and [b.text for b in known] == [b.text for b in bare]:
            assert not any(b.hint for b in bare)
            truth = [b.hint > 0 for b in known]
            # With the names, names, look and neighbours agree.
            assert html_mincut.label_blocks(known, weights, cut) == truth
            look = np.array([b.features for b in bare]) @ weights > 0
            label = html_mincut.label_blocks(bare, weights, cut)
            by_look += sum(a != b for a, b in zip(look, truth))
            by_cut += sum(a != b for a, b in zip(label, truth))
            n += len(known)
    assert n > 2000 and by_look > 0.01 * n and by_cut < 0.2 * by_look


def test_neighbours_outvote_a_name():
    """One block of a telling name amid an article's paragraphs, and the other way round."""
    text = "A sentence of the article that is long enough to look like one, and more of it. "
    page = f"<div><p>{text}</p><p>{text}</p><p>{text}</p></div>"
    blocks = html_mincut.blocks_of(page)
    blocks[1].hint = -1
    weights = np.array(html_mincut.DEFAULT_WEIGHTS)
    look = [float(np.dot(b.features, weights)) for b in blocks]
    assert min(look) > 0
    name = look[1] + 0.5  # the name tells more than the look of its block
    alone = html_mincut.Cut(follows=0, siblings=0, hint=name)
    assert html_mincut.label_blocks(blocks, weights, alone) == [True, False, True]
    assert html_mincut.label_blocks(blocks, weights, html_mincut.Cut(hint=name)) == [True, True, True]


@pytest.mark.parametrize(
    ("page", "kept"),
    [
        ("<div>x" * 24_000, 24_000),
        ("<a " * 40_000, 1),
        ("<a " * 40_000 + ">", 0),
        ("<div>" * 20_000 + "</p>" * 20_000 + "x", 1),
        ("<!--" * 40_000, 0),
        ("<svg>" * 20_000, 0),
        ('<a "' * 20_000 + "<p>x", 1),
        ("<div>x</div>" * 30_000, 30_000),
    ],
)
def test_broken_pages_take_linear_time(page, kept):
    import time

    start = time.perf_counter()
    assert len(html_mincut.blocks_of(page)) == kept
    html_mincut.main_text(page, np.array(html_mincut.DEFAULT_WEIGHTS))
    assert time.perf_counter() - start < 8


def test_steps_between_elements():
    blocks = html_mincut.blocks_of("a<div><p>b</p><ul><li>c</li><li>d</li></ul></div><p>e</p>")
    steps = [y.tree.steps(x.node, y.node) for x, y in zip(blocks, blocks[1:])]
    assert [b.text for b in blocks] == list("abcde") and steps == [2, 3, 2, 4]
    deep = html_mincut.blocks_of("x" + "<div>" * 100 + "y")
    assert deep[1].tree.steps(deep[0].node, deep[1].node) == 64


def test_text_after_elements_without_end_tags():
    def texts(page):
        return [b.text for b in html_mincut.blocks_of(page)]

    assert texts("<html><head><title>T</title><body><article><p>One.<p>Two.</article>") == ["One.", "Two."]
    assert texts("<head><title>T</title><meta charset=utf-8><body><p>One.</p><header>Top</header><p>Two.</p>") == ["One.", "Top", "Two."]
    for tag in ("select", "noscript", "svg", "object", "canvas", "audio", "video", "template", "iframe"):
        assert texts(f"<div><p>One.</p><{tag}>gone<p>Two.</p></div><p>Three.</p>") == ["One.", "Two.", "Three."]
        assert texts(f"<div>One.<{tag}>gone</div>Two.<{tag}><p>gone</p></{tag.upper()} > Three.") == ["One.", "Two. Three."]
    assert texts("<p>Let <math><mi>x</mi></math> be.</p>") == ["Let x be."]
    assert texts("<p>One.</p><title>T</titles><p>gone</p></title><p>Two.</p><script>'</scripts>'</SCRIPT><p>Three.") == ["One.", "Two.", "Three."]
    assert texts("<p>One.<svg><svg><p>gone</p></svg><p>gone</p></svg> more<p>Two.<script>gone") == ["One. more", "Two."]
    assert texts("<svg>" * 20_000 + "<p>One.") == ["One."]


def test_minimum_cut_equals_all_labellings():
    rng = random.Random(2)
    for _ in range(60):
        n = rng.randint(1, 7)
        source, sink = [[rng.choice([0, 1, 2, 3.5]) for _ in range(n)] for _ in range(2)]
        edges = [(a, b, rng.choice([0.5, 1, 2])) for a in range(n) for b in range(a) if rng.random() < 0.5]

        def cost(side):
            own = sum(sink[i] if side[i] else source[i] for i in range(n))
            return own + sum(w for a, b, w in edges if side[a] != side[b])

        least = min(cost([bool(k >> i & 1) for i in range(n)]) for k in range(1 << n))
        assert cost(html_mincut._max_flow_side(n, source, sink, edges)) == pytest.approx(least)


def brute_top(vectors, queries, k):
    whole = {i: np.floor(256 * np.array(v, dtype=float)).astype(np.int64) for i, v in vectors if usable(i, v)}
    out = {}
    for q, v in queries:
        if usable(q, v):
            mine = np.floor(256 * np.array(v, dtype=float)).astype(np.int64)
            best = sorted((-int((mine * x).sum()), i) for i, x in whole.items() if i != q)[:k]
            out |= {(q, rank + 1): (i, -score) for rank, (score, i) in enumerate(best)}
    return out


def usable(i, v):
    return i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(400)]
    rows += [(500 + i, rows[7][1]) for i in range(150)]  # a very common vector: ties
    rows += [(700, None), (701, [1.0, None, 0, 0, 0, 0]), (702, [float("nan")] * 6), (703, [float("inf")] * 6), (None, rows[0][1])]
    data = [(i, None if v is None else [None if x is None else float(x) for x in v], "x", 0) for i, v in [*rows, rows[3], rows[3]]]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<float>, shard string, floor int")
    asked = vectors.filter("vec_id % 50 = 0 OR vec_id BETWEEN 500 AND 510 OR vec_id = 702")
    found = kd_search.top_k(vectors, asked, k=5, shard_rows=64, block_rows=8).collect()
    expected = brute_top(rows, [r for r in rows if r[0] is not None and (r[0] % 50 == 0 or 500 <= r[0] <= 510)], 5)
    assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in found} == expected and len(found) == len(expected)


def test_search_with_few_or_no_candidates(spark):
    vectors = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, -1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    found = kd_search.top_k(vectors, vectors.filter("vec_id = 0"), k=5).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in found] == [(2, 256 * 256 * 5), (1, 128 * 256 - 256 * 512)]
    # A vector without components scores 0 with all.
    more = vectors.unionByName(spark.createDataFrame([(3, []), (4, None)], vectors.schema))
    found = kd_search.top_k(more, more.filter("vec_id IN (0, 3, 4)"), k=5).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in found] == [
        (0, 2, 256 * 256 * 5), (0, 3, 0), (0, 1, 128 * 256 - 256 * 512), (3, 0, 0), (3, 1, 0), (3, 2, 0)
    ]
    empty = more.filter("vec_id = 3")
    assert kd_search.top_k(empty.unionByName(empty.withColumn("vec_id", F.lit(5).cast("long"))), empty).collect()[0].score == 0
    assert kd_search.top_k(vectors.limit(0), vectors).count() == 0
    assert kd_search.top_k(vectors, vectors.limit(0)).count() == 0
    assert kd_search.top_k(vectors.limit(1), vectors.limit(1)).count() == 0


URLS = [
    (1, "https://www.example.com/en/1"), (2, "http://a.example.com/en/2?x=/fr/"), (3, "http://x.net/es/3#top"), (4, "http://net/fr/"),
    (5, "HTTP://X.NeT/FR/"), (6, "https://planet/es/"), (7, "http://example.com"), (8, None), (9, "no scheme"), (10, ""), (11, "a://"),
    (12, "http://h.org/p?u=http://x.net/es/"), (13, "http://www.spam.org/p/index.html"), (14, "http://m.spam.org/p/"),
    (15, "http://spam.org/P"), (16, "http://ÄB.org/x\ny/"), (17, "http://example.com/en/x"), (18, "://x.net/es/"), (None, "http://x.net/es/"),
]


def test_urls_equal_plain_rules(spark):
    rows = [*URLS, URLS[0], URLS[0]]
    pages = spark.createDataFrame([(*r, "h", "k") for r in rows], "page_id long, url string, host string, `key` string")
    listed = spark.createDataFrame([("http://spam.org/p",), ("http://spam.org/p/",), (None,), ("x",)], "url string")
    found = url_bloom.judged(pages, listed, URL_RULES).collect()
    assert len(found) == len(rows)
    by_id = {r.page_id: r for r in found}
    for page_id, url in URLS:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in re.match("[^/?#]*", rest)[0])
        path = re.match("[^?#]*", rest[len(host) :])[0]
        fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        rule = max(fits, key=lambda r: len(r.name), default=None)
        listed_here = page_id in (13, 14)
        verdict = rule.verdict if rule else "block" if listed_here else "allow"
        r = by_id[page_id]
        assert (r.host, r.path, r.rule, r.verdict, r.listed) == (host, path, rule.name if rule else None, verdict, listed_here)


def test_the_filter_passes_every_listed_url_and_few_others(spark):
    listed = spark.range(3000).select(F.concat(F.lit("http://l.org/"), "id").alias("url"))
    pages = spark.range(6000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://l.org/"), "id").alias("url"))
    for size in (8 << 20, 400):  # the smaller filter lets nearly all pass, and the result is the same
        out = url_bloom.judged(pages, listed, (), max_filter_bytes=size)
        assert out.filter("listed").count() == 3000 and out.filter("listed AND page_id >= 3000").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan
    keys = url_bloom.host_and_path(listed).select(url_bloom.canonical(F.col("host"), F.col("path")).alias("key"))
    bits, blocks = url_bloom.bloom_filter(keys, 8 << 20)
    assert bits.count() <= blocks <= 3000 * 16 // 256 + 1
    assert url_bloom.judged(pages.limit(0), listed, URL_RULES).count() == 0
    assert url_bloom.judged(pages, listed.limit(0), URL_RULES).filter("listed").count() == 0
