"""Class and id names inside an article do not cost it text."""

import pytest

from trueledger.llm import html_text

PAGE = """<html><body><div class="site-header">Site</div><div id="related">elsewhere</div><%(main)s>
<header class="entry-header"><h1>Title</h1></header><div class="post-header">Lead</div><p>First.</p>
<section id="discussion"><p>We discuss it.</p></section><div class="notice">Mind this.</div><div class="market-share">Half.</div>
<div class="search-results">Found.</div><div class="top-banner">Flag.</div><div class="rail">Track.</div>
<div class="ad-slot">buy</div><div class="share-buttons">tweet</div><section id="comments"><p>me too</p></section><form>mail</form>
<div class="newsletter-box">join</div><div class="related-posts"><a href="#">Another story</a></div></%(main)s></body></html>"""
WANT = ["Title", "Lead", "First.", "We discuss it.", "Mind this.", "Half.", "Found.", "Flag.", "Track."]


@pytest.mark.parametrize("main", ["article", "main"])
@pytest.mark.parametrize("pages", [1, 12])
def test_article_keeps_its_text(main, pages):
    page = html_text.parse(PAGE % {"main": main})
    tokens = [(p, pages, pages * page.tokens[p], 1, pages * page.chars[p], pages * page.links[p]) for p in page.tokens.keys() | page.chars.keys()]
    assert html_text.main_text(page, html_text.deduce(tokens, pages)).split("\n\n") == WANT


ODD = """<html><body><article><h1>Title</h1><div id="ad-hoc"><p>For this case.</p></div><section class="comment-on-law"><p>On the law.</p></section>
<p data-x=it's>One.</p><p>Two it's.</p><p title="a > b">Three.</p><p class='x' data-y = "it's">Four <math><mi>x</mi><mo>=</mo><mn>2</mn></math> five.</p>
<p>Six <button>Share</button><label for=n>Name</label> seven.</p><p>Eight <label>open<p>Nine.</p>
<div class="ad_box">buy</div><div class="ads-container">buy</div><section class="comment-list">me too</section></article></body></html>"""


def test_attributes_controls_and_formulas():
    page = html_text.parse(ODD)
    tokens = [(p, 1, page.tokens[p], 1, page.chars[p], page.links[p]) for p in page.tokens.keys() | page.chars.keys()]
    found = html_text.main_text(page, html_text.deduce(tokens, 1)).split("\n\n")
    assert found == ["Title", "For this case.", "On the law.", "One.", "Two it's.", "Three.", "Four x=2 five.", "Six seven.", "Eight", "Nine."]


def test_broken_markup_takes_no_time():
    for text in ("<a " + "b=\"c\" " * 5_000, "<p x='" + "a" * 100_000, "<" * 50_000, "<p " + "=" * 50_000):
        html_text.parse(text)


def test_columns_that_clash(spark):
    rows = [(i, "http://h.net/a", f"<article><p>Text {i}.</p></article>", "x") for i in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, _host string")
    for name in ("_slots", "_page", "host", "slots", "place"):
        pages = pages.withColumn(name, pages["_host"])
    found = html_text.extract(pages, html_text.templates(pages)).collect()
    assert sorted((r.page_id, r.text) for r in found) == [(i, f"Text {i}.") for i in range(3)]
    assert all(r[c] == "x" for r in found for c in ("_host", "_slots", "_page", "host", "slots", "place"))
