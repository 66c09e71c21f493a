"""Main text of hand-labelled pages, hostile markup, and the query's edge cases."""

import time

import pytest

from barloom.llm import html

LEAD = "<p>The council met on Monday, and it decided, after a long debate, to rebuild the old bridge over the river.</p>"
LEAD_TEXT = "The council met on Monday, and it decided, after a long debate, to rebuild the old bridge over the river."
NAV = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"
FOOT = "<footer>&copy; 2024 Example. All rights reserved.</footer>"


def page(body, before=NAV, after=FOOT):
    return f"<!DOCTYPE html><html><head><title>T</title></head><body>{before}<article><h1>A bridge is rebuilt</h1>{LEAD}{body}</article>{after}</body></html>"


def said(more=""):
    return f"A bridge is rebuilt {LEAD_TEXT}{more}"


CASES = {
    "plain": (page(""), said()),
    "entities": (page("<p>Costs were &euro;5&nbsp;million &amp; rising, the mayor said &lt;today&gt;.</p>"), said(" Costs were €5 million & rising, the mayor said <today>.")),
    "self_closing_svg": (page("<svg viewBox='0 0 1 1'/><p>A second paragraph follows the drawing, and it stays in the text.</p>"), said(" A second paragraph follows the drawing, and it stays in the text.")),
    "svg_with_title": (page("<svg><title>Icon</title><text>Label</text></svg><p>A second paragraph follows the drawing, and it stays in the text.</p>"), said(" A second paragraph follows the drawing, and it stays in the text.")),
    "unclosed_math": (page("<math><p>A second paragraph follows the formula, and it stays in the text.</p>"), said(" A second paragraph follows the formula, and it stays in the text.")),
    "unclosed_iframe": (page("<iframe src=x><p>A second paragraph follows the frame, and it stays in the text.</p>"), said(" A second paragraph follows the frame, and it stays in the text.")),
    "bracket_in_text": (page("<p>If a<b then the first one, by our rule, is taken before the second.</p>"), said(" If a<b then the first one, by our rule, is taken before the second.")),
    "unclosed_quote": (page("<p class=\"x>Some words follow the broken attribute, and they stay in the text.</p>"), said(" Some words follow the broken attribute, and they stay in the text.")),
    "quoted_bracket": (page("<p title=\"a > b < c\">Some words follow the odd attribute, and they stay in the text.</p>"), said(" Some words follow the odd attribute, and they stay in the text.")),
    "scripts": (page("<script>if (a < b) document.write('<p>no</p>')</script><style>p{}</style>"), said()),
    "script_with_a_quote": (page("<script>if (a<b) x = \"</script><p>A word \"said\" here, and there, stays in the text.</p>"), said(" A word \"said\" here, and there, stays in the text.")),
    "comment": (page("<!-- <p>hidden words, and more hidden words.</p> -->"), said()),
    "inline_and_breaks": (page("<p>One   <b>bold</b>\n word, and<br>another line, of the very same paragraph.</p>"), said(" One bold word, and another line, of the very same paragraph.")),
    "unclosed_paragraphs": (page("<p>A first open paragraph, with some words in it.<p>A second open paragraph, with some words in it."), said(" A first open paragraph, with some words in it. A second open paragraph, with some words in it.")),
    "advert_and_comments": (page("", after="<div class='advert'><p>Buy now, and save.</p></div><section class='comments'><div class='comment'><b>Bo</b><p>Nice one, really.</p></div></section>" + FOOT), said()),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text_of_labelled_pages(name):
    source, want = CASES[name]
    assert html.extract([source], html.trained()) == [want]


@pytest.mark.parametrize("part", ["<a ", "<a \"", "<a '\"", "<svg>", "<b>", "</p>", "<div><li></li>", "<p", "<!", "<!-", "&", "<a x=\"<", "<hr>", "<a b='\"<a b=\"'"])
def test_hostile_markup_takes_linear_time(part):
    """Twice the length may not take four times as long."""
    took = []
    for n in (100_000, 200_000):
        start = time.process_time()
        html.parse("<b>" * 2000 + part * (n // len(part)))
        took.append(time.process_time() - start)
    assert took[1] < 3 * took[0] + 0.5 and took[1] < 10


def test_the_whole_text_of_a_long_page_is_kept():
    body = "".join(f"<p>Paragraph {i} has a few words, and it ends here.</p>" for i in range(5000))
    assert html.extract([page(body)], html.trained()) == [said("".join(f" Paragraph {i} has a few words, and it ends here." for i in range(5000)))]


def test_the_query_form(spark):
    rows = [(1, "u", CASES["plain"][0], 9), (1, "u", CASES["plain"][0], 9), (2, None, None, 9), (None, "v", "", 9), (3, "w", "<a " * 50_000, 9), (4, "x", "<p>" * 3000, 9)]
    pages = spark.createDataFrame(rows, "page_id long, URL string, html string, text int").withColumnRenamed("URL", "Url")
    got = sorted(((r["page_id"] or 0, r["text"], r["n_chars"]) for r in html.main_text(pages).collect()))
    assert got[:1] + got[1:4] == [(0, "", 0), (1, said(), len(said())), (1, said(), len(said())), (2, "", 0)] and got[5] == (4, "", 0)
    assert html.main_text(pages.limit(0)).count() == 0
