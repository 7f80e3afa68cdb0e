"""Vector searches and page extraction against brute force, and on awkward tables."""

from __future__ import annotations

import numpy as np
import pytest

from tidewater.llm import ann, html_text, topk
from tidewater.llm.queries import op3_neighbours, op5_html, op6_topk

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


def brute(ids, x, q, k, measure):
    scores = measure(x, x[q])
    others = [i for i in range(len(ids)) if ids[i] != ids[q]]
    return [ids[i] for i in sorted(others, key=lambda i: (-scores[i], ids[i]))[:k]]


def cosine(x, q):
    return (x @ q) / np.linalg.norm(x, axis=1) / np.linalg.norm(q)


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    return [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)


def test_chi_square():
    assert ann.chi_square_below(2.0, 2) == pytest.approx(1 - np.exp(-1.0))
    assert ann.chi_square_point(0.95, 16) == pytest.approx(26.296, abs=1e-3)


@pytest.mark.parametrize("shard_rows, block", [(20_000, 500), (60, 3)])
def test_recall(spark, table, monkeypatch, shard_rows, block):
    """Also with many leaves and blocks."""
    monkeypatch.setattr(ann, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", block)
    monkeypatch.setattr(ann, "BLOCK_BOXES", block)
    ids, x = table
    found = op3_neighbours(spark, SF).collect()
    hits = total = 0
    for q, i in enumerate(ids):
        if i % 50 == 0:
            own = sorted((r for r in found if r.query_id == i), key=lambda r: r["rank"])
            assert [r["rank"] for r in own] == [1, 2, 3, 4, 5]
            for r in own:
                assert r.score == pytest.approx(cosine(x[[ids.index(r.vec_id)]], x[q])[0], abs=1e-12)
            hits += len({r.vec_id for r in own} & set(brute(ids, x, q, 5, cosine)))
            total += 5
    assert hits >= 0.9 * total


def test_same_vectors_and_few_rows(spark):
    rows = [(i, [1.0, 0.0] if i < 90 else [0.0, 2.0], 0) for i in range(100)]
    frame = spark.createDataFrame(rows, VECTORS)
    found = ann.neighbours(frame, frame.where("vec_id = 50"), k=5).collect()
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"])] == [(i + 1, i, 1.0) for i in range(5)]
    few = frame.where("vec_id in (0, 95, 99)")
    assert {r.vec_id for r in ann.neighbours(few, few.where("vec_id = 0")).collect()} == {95, 99}


def awkward_vectors(spark):
    rows = [
        (0, [1.0, 2.0], 1), (50, [1.0, 2.0], 1), (50, [1.0, 2.0], None), (100, None, 1), (150, [], 1), (200, [float("nan"), 1.0], 1),
        (250, [float("inf"), 1.0], 1), (300, [None, 1.0], 1), (350, [0.0, 0.0], 1), (None, [1.0, 1.0], 1), (400, [1.0], 1), (7, [-1.0, 0.5], 1),
    ]
    return spark.createDataFrame(rows, VECTORS)


def test_awkward_vectors(spark):
    from pyspark.sql import functions as F

    frame = awkward_vectors(spark).withColumns({c: F.lit(1) for c in ("leaf", "low", "unit", "score", "rank", "components", "asks", "shard")})
    found = ann.neighbours(frame, frame.where("vec_id % 50 = 0")).collect()
    assert {r.query_id for r in found} == {0, 50, 400}
    assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == 0] == [50, 50, 400, 7]
    scaled = topk.scaled(frame)
    best = topk.top_k(scaled, scaled.where("vec_id % 50 = 0")).collect()
    assert {r.query_id for r in best} == {0, 50, 350, 400}
    none = frame.limit(0)
    assert ann.neighbours(none, none).collect() == [] and ann.neighbours(frame, none).collect() == []
    assert topk.top_k(topk.scaled(none), topk.scaled(none)).collect() == []


@pytest.mark.parametrize("shard_rows, block", [(10_000, 500), (70, 2)])
def test_top_k(spark, table, monkeypatch, shard_rows, block):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", block)
    ids, x = table
    whole = np.floor(1024 * x).astype(np.int64)
    found = op6_topk(spark, SF).collect()
    for q, i in enumerate(ids):
        if i % 100 == 0:
            own = [r.vec_id for r in sorted((r for r in found if r.query_id == i), key=lambda r: r["rank"])]
            assert own == brute(ids, whole, q, 10, lambda a, b: a @ b)


def test_repeated_query_rows(spark):
    """Equal rows are asked once, different ones of an id each, and every rank holds another row."""
    rows = [(i, [float(i % 7), 1.0, float(i % 5)], 0) for i in range(60)] + [(50, [1.0, 1.0, 0.0], 0)] * 2 + [(50, [0.0, 1.0, 4.0], 1)]
    frame = spark.createDataFrame(rows, VECTORS)
    asked = frame.where("vec_id = 50")
    different = asked.select("embedding").distinct().count()
    for found in (ann.neighbours(frame, asked, k=5), topk.top_k(topk.scaled(frame), topk.scaled(asked), k=5)):
        ranks = [r["rank"] for r in found.collect()]
        assert sorted(ranks) == sorted([1, 2, 3, 4, 5] * different) and different > 1
    once = frame.where("vec_id = 3")
    twice = once.unionAll(once)
    for search, shape in ((ann.neighbours, lambda df: df), (topk.top_k, topk.scaled)):
        assert sorted(search(shape(frame), shape(twice)).collect()) == sorted(search(shape(frame), shape(once)).collect())


def test_large_components(spark):
    """Sums past what double precision holds are exact; past 64 bits the search is refused."""
    rng = np.random.default_rng(3)
    x = rng.integers(-(2**29), 2**29, (40, 6))
    x[7] = x[3]
    x[7, 0] += 1
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, components array<long>")
    found = topk.top_k(frame, frame.where("vec_id < 4"), k=6).collect()
    for q in range(4):
        score = {i: sum(int(a) * int(b) for a, b in zip(x[i], x[q])) for i in range(40) if i != q}
        best = sorted(score, key=lambda i: (-score[i], i))[:6]
        assert [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] == [(i, score[i]) for i in best]
    for size in (2.0**40, 1e300):
        huge = topk.scaled(spark.createDataFrame([(1, [size]), (2, [size])], "vec_id long, embedding array<double>"))
        with pytest.raises(ValueError, match="64 bits"):
            topk.top_k(huge, huge)


def test_lists_with_ties():
    rng = np.random.default_rng(2)
    x = rng.integers(-2, 3, (700, 6)).astype(float)
    ids = rng.permutation(700)
    lists = topk.Lists(x, ids)
    for q in range(30):
        got, scores = lists.top(x[q], int(ids[q]), 10)
        order = [i for i in np.lexsort((ids, -(x @ x[q]))) if i != q][:10]
        assert got.tolist() == ids[order].tolist() and scores.tolist() == (x[order] @ x[q]).tolist()


# ---- pages -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tree():
    return html_text.trained()


def test_tree_fits_its_table(tree):
    assert all(tree(row[:-1]) == row[-1] for row in html_text.LABELLED)


def test_pages_like_their_articles(spark):
    """On the given pages the article element holds the main text."""
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = {r.page_id: r for r in op5_html(spark, SF).collect()}
    assert set(found) == set(pages)
    for i, page in pages.items():
        inner = re.sub(r"</?b>", "", re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1])
        parts = [" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]*>", inner)]
        assert found[i].text == " ".join(p for p in parts if p)
        assert found[i].n_chars == len(found[i].text)


@pytest.mark.parametrize(
    "page, text",
    [
        ("<body><nav>Home</nav><article><h1>Title &amp; more</h1><p>One<br>two  <b>th</b>ree</p></article><footer>Foot</footer>", "Title & more One two three"),
        ("<article><p>Text<script>var a = '</p>';</script> goes on</p><!-- not <p>this</p> --></article>", "Text goes on"),
        ("<main><p>Kept text</p><div class='comments'><p>First! I like this article a lot</p></div><form>Your mail</form></main>", "Kept text"),
        ("<article><p title='a > b'>Quoted</p><p>cut off <a href='x", "Quoted cut off"),
        ("<article><aside>More like this</aside><p>&lt;p&gt; is a tag</p></article>", "<p> is a tag"),
        ("", ""),
        ("no markup at all but quite a number of words that make up one paragraph of plain text here", "no markup at all but quite a number of words that make up one paragraph of plain text here"),
        ("<ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul>", ""),
    ],
)
def test_pages(tree, page, text):
    assert html_text.main_text(page, tree) == text


PARAGRAPH = " ".join(f"word{i}" for i in range(40))


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><p>Look</p><figure><img><figcaption>A river</figcaption></figure></article>", "Look A river"),
        ("<article><p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p></article>", "So x=1 holds"),
        ("<article><svg><path class='share' d='M0'/><text>Axis</text></svg><p>Text</p></article>", "Axis Text"),
        ("<article><object>Plain</object> <canvas>words</canvas></article>", "Plain words"),
        ("<article><fieldset><legend>Pick</legend><select><option>One<option>Two</select></fieldset></article>", "Pick One Two"),
        ("<article><div class='entry-header'><h1>Title</h1></div><div class='search-tips'><p>Text</p></div></article>", "Title Text"),
        ("<div class='no-sidebar'><article><p>Text</p></article></div>", "Text"),
        ("<div class='wrap widget'><article><p>Text</p></article><p>Around it</p></div>", "Text"),
        ("<aside><article><p>Teaser</p></article></aside><main><p>Text</p></main>", "Text"),
        ("<div class='comments'><article class='comment'><p>First!</p></article></div><main><p>Text</p></main>", "Text"),
        ("<div class='has-sidebar'><h2>Short heading</h2><p>" + PARAGRAPH + "</p></div>", "Short heading " + PARAGRAPH),
        ("<div class='site-footer'><p>" + PARAGRAPH + "</p></div>", ""),
    ],
)
def test_pages_keep_what_is_in_the_article(tree, page, text):
    assert html_text.main_text(page, tree) == text


WORDS = ["word", *(f"w{i}" for i in range(1, 40))]


@pytest.mark.parametrize("n", [1, 2, 5, 9, 10, 20, 29, 30, 31, 40])
@pytest.mark.parametrize("marked", [True, False])
def test_last_paragraphs_of_any_length(tree, n, marked):
    """Whatever follows the article, its last paragraph stays."""
    last = " ".join(WORDS[:n])
    body = f"<p>{PARAGRAPH}</p><p>{last}</p>"
    page = f"<article>{body}</article>" if marked else f"<div>{body}</div>"
    page += "<nav><a href=/>Home</a> <a href=/news>All the news</a></nav><footer><a href=/x>Imprint</a></footer>"
    assert html_text.main_text(page, tree) == f"{PARAGRAPH} {last}"
    if marked:
        alone = f"<article><p>{last}</p></article><div><a href=/a>One</a></div><div><a href=/b>Two</a></div>"
        assert html_text.main_text(alone, tree) == last


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><p>A</p><p><a href=x>A whole sentence that is a link</a></p><p>B</p></article>", "A A whole sentence that is a link B"),
        ("<article><p>A</p><h2>Sources</h2><ul><li><a href=x>One book</a></li><li><a href=y>Two</a></li></ul></article>", "A Sources One book Two"),
        ("<article><ol><li><a href=x>Only links</a></ol></article><nav><a href=/>Home</a></nav>", "Only links"),
    ],
)
def test_linked_blocks_of_an_article_stay(tree, page, text):
    assert html_text.main_text(page, tree) == text


@pytest.mark.parametrize(
    "start",
    [
        "div class='ad-slot'", "div class='banner-ad'", "div class=newsletter-signup", "ol class='comment-list'", "section id=comments-section",
        "div class='sidebar-left'", "div role=alert", "div class='x related-posts'", "div class=share_buttons", "div class='sponsored'",
        "section class=comments", "article class='comment-body'", "article class='related'",
    ],
)
def test_what_stands_in_an_article_but_is_not_of_it(tree, start):
    name = start.split()[0]
    page = f"<article><p>{PARAGRAPH}</p><{start}><p>{PARAGRAPH} again</p></{name}><p>The end</p></article>"
    assert html_text.main_text(page, tree) == f"{PARAGRAPH} The end"


@pytest.mark.parametrize("page", [
    "<article><p>Text</p></article><section class=comments><article><p>A reader wrote this</p></article></section>",
    "<section class=comments><article><p>A reader wrote this</p></article></section><article><p>Text</p></article>",
    "<article><p>Text</p></article><div class=widget><article><p>Teaser of another article</p></article></div>",
    "<article><p>Text</p><section class='comment-list'><article class=comment><p>One</p><article><p>Answer</p></article></article></section></article>",
    "<article><p>Text</p></article><article class='comment'><p>A reader wrote this</p></article>",
])
def test_comments_and_teasers_in_article_elements(tree, page):
    assert html_text.main_text(page, tree) == "Text"


def test_tree_knows_the_article():
    def splits(node):
        return [node.split[0], *splits(node.split[2]), *splits(node.split[3])] if node.split else []

    assert html_text.FEATURES.index("main") in splits(html_text.trained())


def test_awkward_pages(spark):
    from pyspark.sql import functions as F

    rows = [(1, "u", None), (None, None, "<article><p>Without an id</p></article>"), (2, None, ""), (2, None, ""), (3, "u", "<article>" + "<p>long text</p>" * 20_000), (4, "u", "<" * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("text", "n_chars", "words")})
    found = html_text.extract(pages).collect()
    assert len(found) == len(rows)
    assert {r.page_id: r.n_chars for r in found if r.page_id in (1, 2)} == {1: 0, 2: 0}
    assert [r.text for r in found if r.page_id is None] == ["Without an id"]
    assert [r.n_chars for r in found if r.page_id == 3] == [len("long text ") * 20_000 - 1]
    assert html_text.extract(pages.limit(0)).collect() == []
