"""Main-text extraction: held-out accuracy, given pages, malformed pages."""

import html
import re

import duckdb
import numpy as np

from parcelweave.llm import q_pages
from parcelweave.llm.blocks import leaf_blocks
from parcelweave.llm.crf import train
from parcelweave.llm.pages import composed_pages, default_model, extract, features, main_text

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy():
    model, right, total = default_model(), 0, 0
    for page, main in composed_pages(200, seed=99):
        blocks = leaf_blocks(page)
        marks = model.decode([features(b) for b in blocks])
        right += sum(m == (b.text in set(main)) for b, m in zip(blocks, marks, strict=True))
        total += len(blocks)
    assert right > 0.995 * total


def test_given_pages(spark):
    """The given pages keep their text in one article element."""
    rows = duckdb.connect().execute(f"select page_id, html from '{SF}/pages.parquet'").fetchall()
    want = {}
    for page_id, page in rows:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S).group(1)
        want[page_id] = " ".join(html.unescape(re.sub(r"<[^>]*(>|\Z)", " ", re.sub(r"</?b>", "", inner))).split())
    got = {r.page_id: (r.text, r.n_chars) for r in q_pages.query(spark, SF).collect()}
    assert got == {k: (v, len(v)) for k, v in want.items()}


def test_kinds_of_clutter():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><a href=/>Home</a></nav>
    <div class="cookie-banner">We use cookies.</div><main><h1>A &lt;title&gt;</h1><p>First   para&nbsp;graph, wi<b>th</b> marks
    <p>Second &amp; last.</p><aside>Related things</aside><form><label>Mail</label></form><script>var x = "</p>";</script>
    <section class="comments"><p>A reader says this.</p></section></main><footer>&copy; us</footer></body></html>"""
    assert main_text(page, default_model()) == "A <title> First para graph, with marks Second & last."


def test_malformed():
    texts = lambda page: [b.text for b in leaf_blocks(page)]
    assert texts("a < b <p class='x>y</p>'>c<p>d") == ["a < b", "c", "d"]
    assert texts("<p>one<!-- two") == ["one"]
    assert texts("<p>one</div></p>two<scr") == ["one", "two"]
    assert texts("<script>never") == []
    assert texts("<ul><li>a<li><b>b</b><li>c</ul>") == ["a", "b", "c"]
    assert texts("<div>" * 20_000 + "deep") == ["deep"]
    assert texts("") == []


def test_heads_and_elements_that_are_never_closed():
    texts = lambda page: [b.text for b in leaf_blocks(page)]
    assert texts("<html><head><title>T</title><h1>A</h1><p>Text") == ["A", "Text"]
    assert texts("<head><meta charset=x><title>t</title>plain <b>text</b>") == ["plain text"]
    assert texts("<head> <script>x</script>\n</head><body>b</body>") == ["b"]
    assert texts('<svg viewBox="0 0 1 1"/><p>kept</p><svg><text>mark</text></svg>') == ["kept"]
    for tag in ("noscript", "object", "template"):
        assert texts(f"<p>a<{tag}><p>kept</p>" * 3) == ["a", "kept"] * 3
    for tag in ("script", "style", "title", "textarea", "iframe"):
        assert texts(f"<p>a<{tag}><p>lost</p>") == ["a"]


def test_decode_is_the_best_path():
    rng = np.random.default_rng(5)
    sequences = [[[f"f{rng.integers(4)}", "b"] for _ in range(rng.integers(1, 7))] for _ in range(30)]
    model = train(sequences, [[int(x[0] in ("f1", "f2")) for x in s] for s in sequences], rounds=60)

    def score(s, path):
        total = model.first[path[0]]
        for i, x in enumerate(s):
            total += sum(model.features.get(f, 0) for f in x) * path[i] + (model.pairs[path[i - 1]][path[i]] if i else 0)
        return total

    for s in sequences:
        best = max(([p >> i & 1 for i in range(len(s))] for p in range(2 ** len(s))), key=lambda path: score(s, path))
        assert abs(score(s, model.decode(s)) - score(s, best)) < 1e-9


def test_odd_rows(spark):
    page = "<article><p>Some text here.</p></article>"
    long = "<article>" + "<p>Words of a long page follow here.</p>" * 20_000 + "</article>"
    data = [(1, "u", None, "t", 5), (2, None, "", "t", 5), (None, "u", page, None, None), (3, "u", page, "t", 5), (3, "u", page, "t", 5), (4, "u", long, "t", 5)]
    rows = extract(spark.createDataFrame(data, "page_id long, url string, html string, text string, n_chars int")).collect()
    got = sorted((r.page_id or 0, r.url or "", r.text if r.page_id != 4 else "", r.n_chars) for r in rows)
    assert got == [(0, "u", "Some text here.", 15), (1, "u", "", 0), (2, "", "", 0), (3, "u", "Some text here.", 15), (3, "u", "Some text here.", 15), (4, "u", "", 20_000 * 34 - 1)]


def test_empty(spark):
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
