"""Main text of pages: a plain reading of the given template, and pages of other make."""

import html
import json
import random
import re

import pytest

from panelfold.llm import wrappers as W
from panelfold.llm.queries import QUERIES


def plain(page):
    inside = re.search(r"<article>(.*?)(?:</article>|\Z)", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)>", inside[1]) if inside else []
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in parts]
    return "\n\n".join(b for b in blocks if b)


def test_query(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op10_html"](spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, plain(pages[r.page_id].html), len(plain(pages[r.page_id].html)))


def own(page):
    return W.main_text(page, frozenset(W.main_slots(W.stream(page))))


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("just text &amp; more", "just text & more"),
        (
            '<body><header><h1>Site</h1></header><div class="notice">cookies</div><main><div class="post-content"><h1>T &amp; x</h1><p>a  b<br>c</p>'
            '<form><p>mail</p></form><div class="ad-box">ad</div><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></div>'
            '<section id="comments"><article class="comment"><p>bad</p></article></section></main><aside>s</aside><footer>f</footer>',
            "T & x\n\na b c\n\none\n\ntwo\n\nx\n\ny",
        ),
        (
            '<div id="sidebar">s</div><div class="menu"><a href=x>1</a><a href=y>2</a></div><div class="text"><p>Hello <b>w</b>orld &lt;b&gt;</p></div>',
            "Hello world <b>",
        ),
        ("<article><p>a<script>var x = '</p>';</script>b</p><style>p{}</style><!-- no --><p>c &nbsp; d</p><noscript>n</noscript></article>", "ab\n\nc d"),
        ('<div class="ad"><article><p>left open before</p></article>', "left open before"),
        ('<nav><article><p>teaser</p></article></nav><article><p a="x>y">real</p><p>unclosed <b>bold<br><p>next', "real\n\nunclosed bold\n\nnext"),
        ('<article><header><h1>Title</h1></header><p>x</p><div class="share social">s</div><footer>by me</footer></article>', "Title\n\nx"),
        ("<article><p>a < b and c<d</p></article>", "a < b and c<d"),
        ('<article><div class="post-header"><h1>Title</h1></div><p>x</p></article>', "Title\n\nx"),
        ('<div class="content-with-sidebar"><p>the text</p><nav>n</nav></div>', "the text"),
    ],
)
def test_other_pages(page, text):
    assert own(page) == text


def language(item):
    """Whether a stream is described by a wrapper: the wrapper as a regular expression over its symbols."""
    return "".join({"+": "(?:%s)+", "?": "(?:%s)?"}[i[0]] % language(i[1]) if isinstance(i, list) else re.escape(f"<{i}>") for i in item)


def test_streams_fold_repeats():
    assert W.stream("<ul><li>a<li>b<li>c</ul>") == ["ul", ["+", ["li", "#ul/li"]], "/ul"]
    assert W.stream("<p>a</p><p>b</p><h2>x</h2><p>c</p><h2>y</h2><p>d</p>")[0] == ["+", ["p", "#p", "/p"]]


def test_the_wrapper_keeps_every_slot():
    r = random.Random(5)
    part = ["<p>t</p>", "<h2>t</h2>", "<ul><li>a<li>b</ul>", "<ul><li>a</ul>", "<div class=ad>t</div>", "<p><b>t<br>", "<table><tr><td>t</table>"]
    for _ in range(60):
        streams = [W.stream("<article>" + "".join(r.choices(part, k=r.randint(0, 9))) + "</article>") for _ in range(r.randint(1, 8))]
        wrapper = W.fold_streams(streams)
        assert {s for x in streams for s, _ in W._slots(x)} == {s for s, _ in W._slots(wrapper)}
        assert json.loads(json.dumps(wrapper)) == wrapper


def test_alignment_makes_optionals_and_repeats():
    wrapper = W.fold_streams([W.stream(p) for p in ("<h1>a</h1><p>b</p><p>c</p><i>d</i>", "<h1>a</h1><p>b</p><i>d</i>", "<h1>a</h1><i>d</i>")])
    for p in ("<h1>a</h1><p>b</p><p>c</p><p>c</p><i>d</i>", "<h1>a</h1><p>b</p><i>d</i>", "<h1>a</h1><i>d</i>"):
        symbols = "".join(f"<{s}>" for s in W._flat(["", [x if k != "#" else "#" + q for k, x, q in ((k, (x if k == "<" else "/" + x if k == ">" else x), q) for k, x, q in W.tokens(p))]]))
        assert re.fullmatch(language(wrapper), symbols), (wrapper, symbols)


def test_a_page_without_its_hosts_main_element(spark):
    rows = [(k, "http://h.example/", f"<nav>menu</nav><article><p>text {k}</p></article>") for k in range(5)]
    rows += [(5, "http://h.example/", "<nav>menu</nav><div><p>other make</p></div><footer>f</footer>"), (6, "http://h.example/", "<p>beside</p><article></article>")]
    got = {r.page_id: r.text for r in W.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{k: f"text {k}" for k in range(5)}, 5: "other make", 6: ""}


@pytest.mark.parametrize("name", ["social-history", "legal-analysis", "alert-system-review"])
def test_compound_names_are_not_cut(name):
    assert own(f'<article><p>before</p><section class="{name}"><p>main text</p></section></article>') == "before\n\nmain text"


def _strange(k):
    return f'<div class="q1">Home</div><div class="q2">Subscribe today</div><div class="q3"><h2>title {k}</h2><p>text {k} of the page</p><p>And so on.</p></div><div class="q2">All rights reserved</div>'


def test_texts_that_are_the_same_on_all_pages_are_the_template(spark):
    rows = [(k, "http://h.example/", _strange(k)) for k in range(20)] * 2
    rows += [(100 + k, "http://few.example/", _strange(k)) for k in range(W.LEAST_PAGES - 1)] + [(200 + k, "http://same.example/", _strange(1) + f"<!-- {k} -->") for k in range(20)]
    got = {r.page_id: r.text for r in W.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()}
    assert all(got[k] == f"title {k}\n\ntext {k} of the page" for k in range(20))  # "And so on." ends every page
    # Too few pages, and pages that are all alike, tell nothing.
    assert all(got[k].startswith("Home\n\nSubscribe today") and got[k].endswith("All rights reserved") for k in [*range(100, 107), *range(200, 220)])


def test_a_hot_host_is_folded_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(W, "_GROUP", 4)
    r = random.Random(3)
    part = ["<p>t</p>", "<h2>t</h2>", "<ul><li>a<li>b</ul>", "<div class=ad>t</div>", "<table><tr><td>t</table>", "<i>x</i>"]
    rows = [(k, "http://h.example/", f"<nav>n</nav><article><p>text {k}</p>{''.join(r.choices(part, k=8))}</article>") for k in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole = W.infer_wrappers(df.selectExpr("'h' AS host", "html")).collect()
    want = {s for _, _, p in rows for s, _ in W._slots(W.stream(p))}
    assert len(whole) == 1 and {s for s, _ in W._slots(json.loads(whole[0].wrapper))} == want and whole[0].marked
    assert {r.page_id: r.text for r in W.extract(df).collect()} == {k: own(p) for k, _, p in rows}


def test_edge_rows(spark):
    rows = [
        (1, "http://a.example/x", "<article><p>one</p></article>", "k"), (1, "http://a.example/x", "<article><p>one</p></article>", "k"),
        (2, None, "<p>no host</p>", None), (None, "not a url", None, "k"), (3, "HTTPS://u@A.example:80/y", "", "k"),
        (4, "http://a.example/z", "<article>" + "<p>long words here</p>" * 20000 + "</article>", "k"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, wrapper_host string").repartition(3)
    out = W.extract(df)
    assert out.columns == ["page_id", "url", "html", "wrapper_host", "text"]
    got = sorted((r.page_id or 0, r.text) for r in out.collect())
    assert got[:-1] == [(0, ""), (1, "one"), (1, "one"), (2, "no host"), (3, "")] and got[-1][1] == "\n\n".join(["long words here"] * 20000)
    assert W.extract(df.where("false")).count() == 0
    with pytest.raises(ValueError):
        W.extract(df, out="HTML")
