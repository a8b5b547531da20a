"""Main text of pages: the tree, exact marginals against all assignments, held-out labelled pages, and given pages."""

import itertools
import re
from html import unescape

import numpy as np
import pytest

from tests.llm.test_contracts import rows_of, source
from trendloom.llm import htmltext as H
from trendloom.llm.htmltree import read_page
from trendloom.llm.layouts import labelled_pages
from trendloom.llm.queries import QUERIES


def blocks(html):
    return [t for t in read_page(html).text if t is not None]


@pytest.mark.parametrize(
    "html, want",
    [
        (None, []), ("", []), ("  \n ", []), ("plain &amp; text", ["plain & text"]), ("a<br>b<b>c</b> d\xa0 e", ["a bc d e"]),
        ("<p>one<p>two<div>three</div>four", ["one", "two", "three", "four"]),
        ("<p><b>one<br><p>two</b> three", ["one", "two three"]),
        ("<script>var a='</p>';if(a<b)x()</script>x<style>p{}</style><!-- <p>no</p> -->y<!---->z", ["xyz"]),
        ("<title>t</title><textarea><p>a</textarea><button>b</button><select><option>c</select>d", ["d"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]), ("<dl><dt>a<dd>b<dt>c</dl>", ["a", "b", "c"]),
        ("<table><tr><td>a<td>b<tr><th>c</table>d", ["a", "b", "c", "d"]), ("<a title='x>y' href=\"a>b\">c</a> <3 d & e < f", ["c <3 d & e < f"]),
        ("<script>never closed <p>a", []), ("a<!-- never closed <p>b", ["a"]), ("a </nothing> b</p>c", ["a bc"]), ("a<p title='never closed>b", ["a", "b"]),
        ("<h1>a</h2>b", ["a", "b"]), ("<svg><title>t</title><text>x</text></svg>a", ["a"]), ("&#65;&#x42;&copy &lt;p&gt;", ["AB© <p>"]),
        ("<head><title>t</title><p>a", ["a"]), ("<a><div>x</div></a>y", ["x", "y"]), ("x<", ["x<"]), ("x<b", ["x"]),
    ],
)
def test_blocks(html, want):
    assert blocks(html) == want


def test_deep_and_long_pages_are_read():
    deep = read_page("<div>" * 5000 + "x" + "</b>" * 5000 + "</div>" * 5000)
    assert len(deep.parent) == 5002 and deep.text[-1] == "x"
    assert blocks('<a href="' + "x" * 10 + "<p>y" * 20_000)[-1:] == ["y"]
    assert len(H.main_blocks(["<article>" + "<p>Some words of a text.</p>" * 20_000 + "</article>"], H.default_model())[0]) == 20_000


def test_links_and_names():
    page = read_page('<div class="siteNav main-menu" id=top2><a href=x>ab</a> cd</div><p hidden>z</p>')
    assert page.names[1] == ["site", "nav", "main", "menu", "top"] and page.linked[2] == 2 and page.names[3] == ["hidden"]


def test_marginals_are_those_of_all_assignments():
    rng = np.random.default_rng(3)
    pages = [read_page("<nav><a>x</a></nav><div><p>one</p><ul><li>two</ul></div>"), read_page("<p>a"), read_page("")]
    vocabulary = {}
    trees = H.forest(pages, vocabulary, grow=True)
    weights, links = rng.normal(size=len(vocabulary)), rng.normal(size=(H.N_KINDS**2, 2, 2))
    got, pairs = H.marginals(trees, weights, links)
    own = np.bincount(trees.node, weights[trees.feature], trees.size)
    total, want, joint = 0.0, np.zeros(trees.size), np.zeros((trees.size, 2, 2))
    for y in itertools.product((0, 1), repeat=trees.size):
        y = np.array(y)
        score = (own * y).sum() + sum(links[trees.kind[i], y[p], y[i]] for i, p in enumerate(trees.parent) if p >= 0)
        weight = np.exp(score)
        total += weight
        want += weight * y
        for i, p in enumerate(trees.parent):
            if p >= 0:
                joint[i, y[p], y[i]] += weight
    assert np.allclose(got, want / total) and np.allclose(pairs, joint / total)


def test_held_out_pages():
    pages = [read_page(p) for p in labelled_pages(150, seed=5)]
    model = H.default_model()
    trees = H.forest(pages, model.vocabulary)
    p, _ = H.marginals(trees, model.weights, model.links)
    y = np.concatenate([H.true_values(x) for x in pages])
    leaf = np.array([t is not None for x in pages for t in x.text])
    assert ((p > 0.5) == y)[leaf].mean() > 0.97


WRITTEN = {
    "<html><body><div id='hd'><a href=/>Home</a> <a href=/x>News</a></div><div id='bd'><h2>A title of a story</h2><p>The first paragraph of the story is "
    "here, and it is long enough to read.</p><p>Second &amp; last one, short.</p><ul><li>One point.</li><li>Another point.</li></ul></div><div "
    "class='user-comments'><div class='comment'><p>I do not agree with this at all, it is wrong.</p></div></div><div>Copyright 2020 Some Company. All rights "
    "reserved.</div></body></html>": [
        "A title of a story", "The first paragraph of the story is here, and it is long enough to read.", "Second & last one, short.", "One point.", "Another point."],
    "<header><h1>Site</h1><nav><ul><li><a href=a>A</a></ul></nav></header><main><article><header><h1>Real title</h1></header><p>Body text that goes on for a "
    "while.<aside class=related><h3>Related</h3><ul><li><a href=c>Other</a></ul></aside><p>Final words.</article><section id=comments><h2>3 Comments</h2>"
    "<article class=comment><p>Great article, thanks for sharing it!</p></article></section></main><footer><p>&copy; 2021</p></footer>": [
        "Real title", "Body text that goes on for a while.", "Final words."],
    "<table><tr><td class=menu><a href=1>One</a><br><a href=2>Two</a></td><td><p>Old style page with its text in a cell, as pages once were.</p></td></tr></table>"
    "<p>Copyright &copy; 1999</p>": ["Old style page with its text in a cell, as pages once were."],
}


@pytest.mark.parametrize("html", WRITTEN)
def test_pages_of_other_kinds(html):
    assert H.main_blocks([html], H.default_model())[0] == WRITTEN[html]


def wanted(html):
    """The given pages have one article of headings and paragraphs; here it is cut out by its tags."""
    inside = re.search(r"<article>(.*?)</article>", html, re.S)[1].replace("<br>", " ")
    parts = (" ".join(unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside))
    return "\n\n".join(x for x in parts if x)


def test_op11(spark, sf_dir):
    got = {r.page_id: r for r in QUERIES["op11_main_text"](spark, sf_dir).collect()}
    pages = source(spark, sf_dir, "pages").collect()
    assert got.keys() == {p.page_id for p in pages}
    assert all(got[p.page_id].url == p.url and got[p.page_id].n_chars == len(got[p.page_id].text) for p in pages)
    assert sum(got[p.page_id].text == wanted(p.html) for p in pages) >= 0.98 * len(pages)


def test_op11_awkward(spark):
    rows = [(1, "u", None, 1), (1, "u", "", 2), (None, None, "<article><p>Some text of a page.</p></article>", 3), (2, None, "<nav><a href=x>y</a></nav>", 4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = rows_of(H.main_text(df))
    assert sorted(got, key=repr) == sorted([(1, "u", "", 0), (1, "u", "", 0), (None, None, "Some text of a page.", 20), (2, None, "", 0)], key=repr)
    assert rows_of(H.main_text(df.limit(0))) == []


def test_own_labelled_pages(spark, monkeypatch):
    monkeypatch.setattr(H, "STEPS", 40)
    marked = spark.createDataFrame([(p,) for p in labelled_pages(40, seed=2)] + [(None,)], "html string")
    model = H.trained_on(marked)
    assert H.main_blocks(["<article><p>A sentence of a text, and some more.</p></article><nav><a href=x>y</a></nav>"], model) == [["A sentence of a text, and some more."]]
