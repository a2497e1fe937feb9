import itertools
import random

import pytest

from tidemark.llm import kd_shards, mincut_html
from tidemark.llm.mincut_html import Page, Setup, label, minimum_cut


def brute_cut(content, other, edges):
    best = None
    for labels in itertools.product((False, True), repeat=len(content)):
        cost = sum(o if l else c for c, o, l in zip(content, other, labels))
        cost += sum(w for a, b, w in edges if labels[a] != labels[b])
        best = cost if best is None else min(best, cost)
    return best


def test_minimum_cut_equals_brute_force():
    draw = random.Random(8)
    for _ in range(200):
        n = draw.randrange(1, 8)
        content, other = ([draw.randrange(6) for _ in range(n)] for _ in range(2))
        edges = [(draw.randrange(n), draw.randrange(n), draw.randrange(1, 5)) for _ in range(draw.randrange(10))]
        edges = [e for e in edges if e[0] != e[1]]
        labels = minimum_cut(content, other, edges)
        cost = sum(o if l else c for c, o, l in zip(content, other, labels))
        assert cost + sum(w for a, b, w in edges if labels[a] != labels[b]) == pytest.approx(brute_cut(content, other, edges))


def kept(source, beta=(0.0,) * 8):
    import numpy as np
    page = Page(source)
    return [t for t, good in zip(page.texts, label(page, np.array(beta), Setup())) if good]


@pytest.mark.parametrize("source, want", [
    ("", []),
    ("just text", []),
    ("<article>A &lt;b&gt; &amp;amp; c&nbsp; d\n e<br>f</article>", ["A <b> &amp; c d e f"]),
    ("<nav>n</nav><article><h1>T</h1><p><b>One<br><p>Two</article><footer>&copy; f</footer>", ["T", "One", "Two"]),
    ("<body class='nav-open'><header>site</header><main><header><h1>T</h1></header><p>x</main>", ["T", "x"]),
    ("<article><p>a</p><div class='ad'>ad</div><aside>s</aside><form><p>f</p></form><p>b</p></article>", ["a", "b"]),
    ("<article><p>a<section id=comments><article><p>c</article></section></article>", ["a"]),
    ("<article>a<script>if (1 < 2) '</p>'</script><style>p{}</style><!-- c --><p>b</article>", ["a", "b"]),
    ("<article>a<div class='cookie-notice'>n</div><ul><li>1<li>2</ul></article>", ["a", "1", "2"]),
    ("<article>a<script>never closed <p>b", ["a"]),
    ("<article><p title='x > y'>a</p></article>", ["a"]),
    ("<ARTICLE><P>Upper</P></ARTICLE>", ["Upper"]),
])
def test_main_text(source, want):
    assert kept(source) == want


def test_extract_edge_cases(spark):
    rows = [(1, "u", "<article><p>a</p></article>"), (1, "u", "<article><p>a</p></article>"), (2, None, None), (None, "v", ""),
            (3, "w", "<p>" * 3000 + "x" + "<article>" + "<p>long text" * 3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = mincut_html.extract(pages, mincut_html.learn(pages)).collect()
    assert sorted((r.page_id or 0, r.url or "", r.text[:8], r.n_chars) for r in got)[:4] == [
        (0, "v", "", 0), (1, "u", "a", 1), (1, "u", "a", 1), (2, "", "", 0)]
    assert next(r for r in got if r.page_id == 3).text.count("long text") == 3000
    assert mincut_html.extract(pages.limit(0), mincut_html.learn(pages.limit(0))).count() == 0


def test_pages_query_equals_a_pattern(spark):
    import html
    import re

    from tidemark.llm.common import table
    sf = "/root/testdata/sf0.01"
    want = {}
    for r in table(spark, sf, "pages").collect():
        body = re.search("<article>(.*)</article>", r.html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", body)]
        want[r.page_id] = "\n\n".join(b for b in blocks if b)
    got = {r.page_id: r.text for r in mincut_html.op9_mincut_html(spark, sf).collect()}
    assert got == want


def shares(rows, shards):
    return [sum(r.size for r in rows if r.shard == s) for s in range(shards)]


def gapless(rows, shards):
    return all(sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
               for s in range(shards))


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_shards_hold_equal_bytes(spark, shards):
    draw = random.Random(shards)
    docs = [(i, "x" * draw.randrange(200), f"l{i % 3}", f"s{draw.randrange(5)}") for i in range(4000)]
    docs += [(10_000 + i, "copied text of one group", "l0", "hot") for i in range(2000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").repartition(4)
    rows = kd_shards.shard(frame, shards).collect()
    assert len(rows) == 6000 and gapless(rows, shards)
    sizes = shares(rows, shards)
    assert max(sizes) < 1.05 * sum(sizes) / shards and min(sizes) > 0.95 * sum(sizes) / shards


def test_equal_texts_stay_together(spark):
    docs = [(i, f"text {i % 500} " * 3, "en", f"s{i % 7}") for i in range(2000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    rows = kd_shards.shard(frame, 4).collect()
    assert all(len({r.shard for r in rows if r.text_crc32 == c}) == 1 for c in {r.text_crc32 for r in rows})


def test_shard_edge_cases(spark, edge, no_docs):
    import zlib
    rows = kd_shards.shard(edge, 4).collect()
    assert len(rows) == 10 and gapless(rows, 4)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[3].size == by_id[4].size == 1 and by_id[8].size == 60_001
    assert by_id[8].text_crc32 == zlib.crc32(b"x" * 60_000)
    assert kd_shards.shard(no_docs).count() == 0
