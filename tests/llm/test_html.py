"""Main text of pages: wrapper induction and what is left out."""

import html
import os
import re

import pytest

from clickwave.llm import html_extract as X
from tests.conftest import SF_MID
from tests.llm.fixtures import with_clashing

PAGES = "page_id long, url string, html string"


def page(title, body, notice="All prices include tax. Call 555."):
    return (f"<html><head><title>{title}</title></head><body><div><a href=/>Home</a> <a href=/b>News</a></div>"
            f"<div><h1>{title}</h1>{body}</div><div>{notice}</div><div>Copyright nobody</div></body></html>")


def test_constants_of_a_host_become_template():
    pages = [page(f"Title {k}", f"<p>First part {k}.<p>Second <b>part</b> {k * 7}.") for k in range(6)]
    wrapper = X.load_wrapper(X.induce(pages))
    assert X.extract(pages[2], wrapper) == "Title 2 First part 2. Second part 14."
    assert "Call 555" in X.extract(pages[2])  # nothing but the alignment tells
    assert X.extract(page("New", "<p>Alone", notice="Another notice of the day"), wrapper) == "New Alone Another notice of the day"


def test_alignment_is_the_heaviest_ordered_matching():
    a, b = X.parse("<div>x</div><p>1</p><div>y</div>"), X.parse("<div>new</div><div>x</div><p>2</p><p>1</p><div>y</div>")
    weight, pairs = X.align(a, b, True)
    assert [(p.text, q.text) for p, q in reversed(pairs)] == [("x", "x"), ("1", "1"), ("y", "y")] and weight == 10


@pytest.mark.parametrize("source, text", [
    ("", ""), ("plain &lt;text&gt; &#233;&eacute; a < b", "plain <text> éé a < b"),
    ("<p>a<br>b</p><p>c  \n d</p>", "a b c d"), ("<p>a<b>b</b>c<p>d", "abc d"), ("<!-- x <p>y", ""),
    ("<script>var t='</p>'; if (a<b) {}</script><style>p{}</style><p>k", "k"), ("<script>open", ""),
    ("<article><header><h1>T</h1></header><p>k<form>f</form><aside>s</aside><div class='cookie-notice'>c</div>"
     "<div class=AdBox><p>ad</div><section id=comments><p>no</section><span hidden>h</span></article><p>out", "T k"),
    ("<header><h1>Site</h1><nav>n</nav></header><main><p>in</p></main><footer>f</footer>", "in"),
    ("<div class='layout sidebar-left'><article><p>in</p></article></div><div class=sidebar>no</div>", "in"),
    ("<ul><li><a href=1>one</a><li><a href=2>two</a></ul><p>text with <a href=3>link</a> inside it", "one two text with link inside it"),
    ("<div class='page has-sidebar'><p>a</div>", "a"), ("<div class='content no-comments'><p>a</div>", "a"),
    ("<div class=comments><p>most of the text</div><div class=promo>no</div>", "most of the text"),
    ("<article><p>a<div class='market-share'>b</div><p id=alert-systems>c<div id=share-buttons>no</div></article>", "a b c"),
    ("<div>the main text of it<ul class='related-posts left'><li>no</ul></div>", "the main text of it"),
    ("<article><p>long " + "x " * 5000 + "</article>", "long " + "x " * 4999 + "x"),
    ("<main><article class=post><p>in<article class=comment><p>no</article></article></main>", "in"),
    ("<article><p>in</article><section class=related><article><p>no</article></section><aside><article>no</article></aside>", "in"),
    ("<article class='has-sidebar'><p>in</article><article class=comment><p>no</article>", "in"),
    ("<p title='a>b'>q</p><p title=\"it's\">r</p>", "q r"), ("<div>" * 3000 + "deep", "deep")])
def test_extract(source, text):
    assert X.extract(source) == text


def test_awkward_rows(spark):
    rows = [(1, None, page("A", "<p>a")), (2, "http://h.example/1", None), (3, "no host", "<p>x"), (None, "http://h.example/2", ""),
            (4, "http://H.example:80/3", page("B", "<p>b")), (4, "http://H.example:80/3", page("B", "<p>b")),
            (5, "https://u@h.example/4", page("C", "<p>c")), (6, "//h.example", page("D", "<p>d"))]
    df = with_clashing(spark.createDataFrame(rows, PAGES))
    got = sorted(map(tuple, X.main_text(df).collect()), key=str)
    text = {1: "Home News A a All prices include tax. Call 555. Copyright nobody", 3: "x", 4: "B b", 5: "C c", 6: "D d"}
    assert got == sorted(((i, u, text.get(i, ""), len(text.get(i, ""))) for i, u, _ in rows), key=str)
    assert X.main_text(spark.createDataFrame([], PAGES)).count() == 0


def test_copies_do_not_crowd_out_a_wrapper(spark):
    rows = [(k, "http://h.example/", page("Same", "<p>s")) for k in range(40)]
    rows += [(100 + k, "http://h.example/", page(f"T{k}", f"<p>p{k}")) for k in range(9)]
    got = {r.page_id: r.text for r in X.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[3] == "Same s" and got[104] == "T4 p4"


def test_layouts_of_a_host_have_wrappers_of_their_own(spark):
    first = "<div class=top>Our notice</div><div class=text><p>first {0}<p>part {0}</div>"
    second = "<div><div>Another notice</div></div><div><p>second {0}</div>"
    third = "<section><p>Third notice</section><section><p>third {0}</section>"
    rows = [(k, "http://h.example/", (first, second, third)[k % 3].format(k)) for k in range(60)]
    got = {r.page_id: r.text for r in X.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {k: (f"first {k} part {k}", f"second {k}", f"third {k}")[k % 3] for k in range(60)}


def test_constants_that_some_pages_lack(spark):
    """A notice on four of five pages is template, whichever page is a base."""
    rows = [(k, "http://h.example/", f"<div>{'<p>Our notice' if k % 5 else ''}<p>text {k}</div><p>end {k}") for k in range(50)]
    got = {r.page_id: r.text for r in X.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {k: f"text {k} end {k}" for k in range(50)}


def test_nested_to_any_depth(spark):
    deep = "<div>" * 1200
    rows = [(k, "http://h.example/", f"{deep}text {k}" + "</div>" * 1200 + "<p>notice") for k in range(9)]
    got = {r.page_id: r.text for r in X.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {k: f"text {k}" for k in range(9)}


def test_equal_leaves_at_the_ends_leave_the_weight_as_it_is():
    """The alignment against the plain recurrence, on random trees."""
    import random

    def weight(a, b, same):
        best = [[0] * (len(b.kids) + 1) for _ in range(len(a.kids) + 1)]
        for i, p in enumerate(a.kids):
            for j, q in enumerate(b.kids):
                w = 0
                if p.label == q.label:
                    w = weight(p, q, same) if p.tag != "#" else 2 if p.text == q.text else 0 if same else 1
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + w)
        return best[-1][-1] + 1

    rng = random.Random(3)

    def random_page(depth=0):
        return "".join(f"<{t}>{random_page(depth + 1)}</{t}>" if depth < 3 and rng.random() < 0.5 else f"{rng.choice('abc')}<hr>"
                       f"<!-- --><{t}></{t}>" for t in rng.choices(("div", "section"), k=rng.randint(1, 4)))
    for _ in range(200):
        a, b = X.parse(random_page()), X.parse(random_page())
        for same in (True, False):
            got, pairs = X.align(a, b, same)
            assert got == weight(a, b, same)
            number = [{id(x): n for n, x in enumerate(X.leaves(t))} for t in (a, b)]
            at = [(number[0][id(p)], number[1][id(q)]) for p, q in reversed(pairs)]
            assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(at, at[1:]))


@pytest.mark.skipif(not os.path.isdir(SF_MID), reason="driver tables not present")
def test_articles_of_the_pages_table(spark):
    pages = spark.read.parquet(f"{SF_MID}/pages.parquet")
    got = {r.page_id: r.text for r in X.main_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1|br)>", re.sub(r"</?b>", "", article))
        assert got[r.page_id] == " ".join(" ".join(html.unescape(b).split()) for b in blocks if b.strip())
