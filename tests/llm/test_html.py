import itertools
import re
import time

import numpy as np
import pytest

from tidemark.llm import html_extract, queries
from tidemark.llm.html_pages import labelled_pages

CHAIN = html_extract.default_chain()


def test_held_out_pages():
    """Pages of another seed: blocks are cut as labelled, and nearly all labels are found."""
    right = total = 0
    for page, labels in labelled_pages(80, seed=99):
        found = html_extract.blocks(page)
        assert [b.text for b in found] == [" ".join(t.split()) for t, _ in labels]
        got = CHAIN.decode(html_extract.features(found))
        right += sum(a == y for a, (_, y) in zip(got, labels))
        total += len(labels)
    assert right / total > 0.98


def test_viterbi_finds_the_best_path():
    page, _ = labelled_pages(3, seed=5)[2]
    rows = html_extract.features(html_extract.blocks(page))[:10]
    s = CHAIN.scores(rows)
    value = lambda y: sum(s[i, k] for i, k in enumerate(y)) + sum(CHAIN.t[a, b] for a, b in zip(y, y[1:]))
    best = max(itertools.product((0, 1), repeat=len(rows)), key=value)
    assert tuple(CHAIN.decode(rows)) == best


def test_marginals_against_all_paths():
    rng = np.random.default_rng(0)
    s, t = rng.standard_normal((6, 2)), rng.standard_normal((2, 2))
    z, p, pairs = html_extract._marginals(s, t)
    paths = list(itertools.product((0, 1), repeat=6))
    w = np.array([np.exp(sum(s[i, k] for i, k in enumerate(y)) + sum(t[a, b] for a, b in zip(y, y[1:]))) for y in paths])
    assert z == pytest.approx(np.log(w.sum()))
    assert p[3, 1] == pytest.approx(sum(x for x, y in zip(w, paths) if y[3]) / w.sum())
    assert pairs[0, 1] == pytest.approx(sum(x * sum((a, b) == (0, 1) for a, b in zip(y, y[1:])) for x, y in zip(w, paths)) / w.sum())


def plain_article(page):
    """The test pages' article by its tags (no other markup is in it)."""
    import html

    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    parts = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in parts]
    return " ".join(x for x in texts if x)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in queries.op8_html_extraction(spark, sf).collect():
        assert r["text"] == plain_article(pages[r["page_id"]]["html"])
        assert r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("script", [
    "<script>for(var i=0;i<n;i++)t(i);</script>", "<script>if(a<b){c()}</script>", "<SCRIPT>x='</scripty>';i<n;</Script >",
    "<style>a<b</style\n>", "<script>s='<!--';t=\"<p title='\"</script>",
])
def test_a_hidden_element_ends_at_its_own_closing_tag(script):
    article = "<article><h1>Head</h1><p>The story is told here, at some length.</p></article>"
    for page in (f"<html><head>{script}</head><body>{article}</body></html>", script + article, article + script + "<p>last</p>"):
        texts = [b.text for b in html_extract.blocks(page)]
        assert texts == ["Head", "The story is told here, at some length.", *["last"] * page.endswith("<p>last</p>")]
    assert [b.text for b in html_extract.blocks("<p>i<n<b>x</b></p>")] == ["i<nx"]


@pytest.mark.parametrize("inner, want", [
    ("<p><a href=x title=it's>Here</a> the first ends, it's said.</p><p>And a second isn't lost.</p>", ["Here the first ends, it's said.", "And a second isn't lost."]),
    ("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be given.</p>", ["Let x=1 be given."]),
    ('<p title="unclosed>Some text</p><p>and more</p>', ["Some text", "and more"]),
    ('<p title="unclosed>Some text</p><p title="b">and more</p>', ["and more"]),  # as browsers do: the next quote closes it
    ("<p title='a > b' data-x=\"c > d\">Some</p><p a=b/>text</p>", ["Some", "text"]),
    ("<p a = 'x>y' b>Some</p ><p\nid=\n'q'\n>text</p>", ["Some", "text"]),
    ("<p>a < b and c <3 d</p>", ["a < b and c <3 d"]),
    ("<p>&#0000000065;&#" + "9" * 6000 + ";</p>", ["A\ufffd"]),
    ('<p a="x>one</p><p b=\'y>two</p>', ["one", "two"]),
])
def test_tags_as_browsers_read_them(inner, want):
    assert [b.text for b in html_extract.blocks(inner)] == want


@pytest.mark.parametrize("piece", [
    '<p a="x ', "<p a='x\" ", '<p a=">"', "<!", "<!--", "<p a=b ", "</script ", "<div>x", "<b>x", "<b><div>", "<p><section>x</li>",
    "<x a", "&#1", "<script></script ", "<a href=it's>x ", "<", "<p =", "<p a" + " " * 40,
])
def test_broken_markup_of_a_million_characters(piece):
    start = time.perf_counter()
    html_extract.blocks(piece * (1_000_000 // len(piece)))
    html_extract.blocks("<script>" + piece * (1_000_000 // len(piece)) + ">")
    assert time.perf_counter() - start < 20  # seconds on a busy machine; a rescan would take hours


def test_awkward_pages(spark):
    long = "<article><h1>T</h1>" + "<p>some words of a long story, and more of them.</p>" * 5000 + "</article>"
    rows = [
        (1, None), (2, ""), (3, "<<<>>><a <p"), (4, "<article><p>One &amp; two&nbsp;&#233;\n\t three <b>bold</b>ness of the words here.<p>Next, a second paragraph"),
        (5, "<script>var a='<p>x</p>'</script><style>p{}</style>"), (6, long), (7, "<!-- never closed"), (4, "</p></p></div>"),
        (8, "<header>Site</header><aside>Side</aside><main><p>The story is told here, at some length.</p></main><form><label>Name</label></form>"),
    ]
    df = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "'mine' as text", "1 as n_chars")
    out = html_extract.extract(df).collect()
    got = {r["page_id"]: r["text"] for r in out if r["text"]}
    assert len(out) == 9 and not set(got) & {1, 2, 5, 7}
    assert got[4] == "One & two é three boldness of the words here. Next, a second paragraph"
    assert got[6].count("story") == 5000
    assert got[8] == "The story is told here, at some length."
    assert html_extract.extract(df.limit(0)).count() == 0
