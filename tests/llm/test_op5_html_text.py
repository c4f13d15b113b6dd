"""Extraction against hand-made pages, and the pages of the test data against a plain reading of their article."""

import html
import re

import pytest

from changeloom.llm import op5_html_text as H

PAGE = "page_id bigint, url string, html string, text string"
TREE = H.Tree(*H.labelled())
LONG = " ".join(["word"] * 40)


def test_tree_knows_its_table():
    x, y = H.labelled()
    assert sum(TREE(row) == bool(label) for row, label in zip(x, y)) == len(y)


def test_tree_asks_text_and_links():
    def asked(node):
        return set() if isinstance(node, bool) else {H.FEATURES[node[0]]} | asked(node[2]) | asked(node[3])
    assert {"links", "words_around"} <= asked(TREE.root) and asked(TREE.root) & {"links_before", "links_behind", "words_before", "words_behind"}


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   ", ""), ("<html><head><title>T</title></head><body></body></html>", ""),
    (f"<article><h1>Head</h1><p>One<br>two &amp; three&nbsp;x.<p>{LONG}</article>", f"Head One two & three x. {LONG}"),
    (f"<nav><ul><li><a href='/a'>Home</a></li></ul></nav><header><h1>Site</h1>The site of sites</header><main><p>{LONG}</p><p>Short.</p></main>"
     f"<aside><p>{LONG}</p></aside><footer>&copy; me</footer>", f"{LONG} Short."),
    (f"<article><p>{LONG}</p><section class='comments'><p>I agree {LONG}</p></section></article><div id=cookie-notice>We use cookies {LONG}</div>"
     "<form><p>Your name please</p><button>Send</button></form>", LONG),
    (f"<article><p>a < b, 1<2 {LONG}<script>if (a</b) '</p>'</script><style>p{{}}</style><!-- <p>x</p> --></p></article>", f"a < b, 1<2 {LONG}"),
    (f"<article data-x='>'><p title=\"a > b\">{LONG}</p><p class=\"cut o", LONG),
    (f"<article><p>{LONG}</p><p>&#233;t&eacute; &am", f"{LONG} été &am"),
    (f"<div><p>{LONG}</p><p>{LONG}</p></div><div class='ad'>{LONG}</div>", f"{LONG} {LONG}"),
    # A name marks as a whole only.
    (f"<article><h1>T</h1><p>{LONG}</p><div class='share-price'><p>The share price rose</p></div><section class='related-work'><p>{LONG}</p></section></article>",
     f"T {LONG} The share price rose {LONG}"),
    (f"<article><p>{LONG}</p><p>All rights reserved.</p><div class='ad-box wide'>{LONG}</div></article>", f"{LONG} All rights reserved."),
    # Pages without an article, and a story behind a name that marks.
    (f"<div class='top'><a href='/'>Home</a> <a href='/b'>News</a></div><div><h1>Title here</h1><p>{LONG}</p><p>Ok then.</p><p>{LONG}</p></div>"
     "<div class='foot'>All rights reserved 2020 by the company</div>", f"Title here {LONG} Ok then. {LONG}"),
    (f"<div class='legal-news'><h1>Head line</h1><p>{LONG}</p><p>Short one.</p></div><div class='foot'>&copy; 2020 me</div>", f"Head line {LONG} Short one."),
    (f"<nav><a>Home</a></nav><div class='legal'><h1>Head line</h1><p>{LONG}</p><p>{LONG}</p></div><footer>me</footer>", f"Head line {LONG} {LONG}"),
    (f"<h1>Head line</h1><p>{LONG}</p><p>{LONG}</p>", f"Head line {LONG} {LONG}"),
])
def test_pages(page, text):
    assert H.main_text(page, TREE) == text


def test_table_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = {r.page_id: r.text for r in H.extract_text(pages).collect()}
    for r in pages.collect():
        article = r.html.split("<article>")[1].split("</article>")[0] if "<article>" in r.html else ""
        article = re.sub(r"<[^>]*$", "", article)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b)).split()) for b in re.split(r"</?(?:p|h1|article)[^>]*>", article)]
        assert rows[r.page_id] == " ".join(b for b in blocks if b)


def test_edges(spark):
    long = "<article>" + "<p>x y</p>" * 100_000 + "<a " * 50_000
    pages = [(1, "u", long, "t"), (1, "u", long, "t"), (None, None, None, None), (2, "v", "<" * 200_000, "t"), (3, "v", "<p '" * 50_000, "t"), (4, "v", "<div>" * 50_000 + "x", "t")]
    rows = H.extract_text(spark.createDataFrame(pages, PAGE)).collect()
    assert sorted(r.n_chars for r in rows if r.page_id == 1) == [399_999] * 2 and len(rows) == 6
    assert H.extract_text(spark.createDataFrame([], PAGE)).count() == 0
