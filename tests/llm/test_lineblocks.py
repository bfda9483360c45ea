from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from caremeld.llm import lineblocks as B

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
    "<header><p>Site</p></header><nav><ul><li><a href=/a>A</a></li></ul></nav><div class='ad box'>Buy now</div>"
    "{body}<aside>More</aside><div id='comments'><p>First!</p></div><form><p>Join</p></form><footer>&copy; me</footer></body></html>"
)


@pytest.mark.parametrize(
    "body, text",
    [
        ("<article><h1>Head &amp; tail</h1><p>One\n  two<br>three<p>X</article>", "Head & tail\nOne two\nthree\nX"),
        ("<main><div><p>A &lt;b&gt; c</p><p></p><ul><li>i<li>ii</ul></div></main>", "A <b> c\ni\nii"),
        ("<article><p>a <b>bold</b><i>er</i> word<!-- no --></p><script>x</script></article>", "a bolder word"),
        ("<article><p>one</p><div class='cookie-notice'>We use</div><p>two</p></article>", "one\ntwo"),
        ("<div class='post'><p>&eacute; &#233; &#x1F600; &amp;lt;</p></div>", "é é \U0001f600 &lt;"),
        ("<article><table><tr><td>c1</td><td>c2</td></tr></table></article>", "c1\nc2"),
        ("<article><header><h1>Title</h1></header><p><a href=/x>a link</a></p></article>", "Title\na link"),
        ("<p>text here</p><ul><li><a href=/x>one</a></li><li><a href=/y>two</a></li></ul>", "text here"),
        ("", ""),
    ],
)
def test_pages(body, text):
    assert B.main_text(PAGE.replace("{body}", body)) == text


def test_surge_and_dive():
    assert B.kept_lines([0, 0, 5, 0, 0, 7, 0, 0, 0, 0, 3], B.Windows()) == [i in (2, 5, 10) for i in range(11)]
    strict = B.Windows(lines=2, surge=50, dive=5)
    assert B.kept_lines([4, 4, 60, 9, 1, 1, 4], strict) == [False, True, True, True, False, False, False]
    assert B.kept_lines([], strict) == []


def test_broken_markup_and_edges(spark):
    odd = [None, "", "plain", "<p>open <b>never <i>closed", "</div></p>x", "<" * 50, "a < b & c", "<article><p>" + "w " * 50_000, "<![CDATA[x]]>", "&#0;&#xD800;"]
    pages = spark.createDataFrame([(i, h) for i, h in enumerate(odd + odd[:2])], "page_id long, html string")
    rows = pages.select("html", B.extracted(F.col("html")).alias("text")).collect()
    assert len(rows) == len(odd) + 2
    got = {r.html: r.text for r in rows}
    assert got[None] == got[""] == "" and got["plain"] == "plain" and got["a < b & c"] == "a < b & c"
    assert got["<p>open <b>never <i>closed"] == "open never closed"
    assert len(got[odd[7]]) == 99_999
    assert pages.limit(0).select(B.extracted(F.col("html")).alias("t")).count() == 0


TEXT = [f"Paragraph {i} of the text, " + "with some more words in it " * 8 + "." for i in range(5)]
PARAGRAPHS = "".join(f"<p>{t}</p>" for t in TEXT)


def test_windows_decide_on_unmarked_pages():
    menu = "".join(f"<div>{w}</div>" for w in "Home News Sports Weather About Contact".split())
    foot = "<p>All rights reserved</p><p>Terms</p><p>Privacy</p><p>Top</p>"
    page = f"<body>{menu}<p>Heading</p>{PARAGRAPHS}{foot}</body>"
    kept = B.main_text(page).split("\n")
    assert kept == ["Contact", "Heading", *TEXT]  # one line before the heading is the stated limit
    assert B.main_text(page, B.Windows(lines=1)).split("\n") == TEXT
    assert "Home" in B.main_text(page, B.Windows(surge=10)) and "Top" in B.main_text(page, B.Windows(dive=0))
    assert B.main_text(page, B.Windows(surge=100_000)).startswith("Home\nNews")


@pytest.mark.parametrize("wrapper", ["div class='content no-sidebar'", "section class='legal-analysis'", "form", "div id=with-comments"])
def test_text_in_a_marked_wrapper_is_rescued(wrapper):
    page = f"<body><div>Home</div><nav>Menu</nav><{wrapper}>{PARAGRAPHS}</{wrapper.split()[0]}><footer>f</footer></body>"
    assert B.main_text(page).split("\n") == TEXT
    short = page.replace(PARAGRAPHS, f"<p>{TEXT[0]}</p>")
    assert B.main_text(short) == TEXT[0]


def test_marked_text_beside_the_text_is_not():
    for tag in ("div", "article"):
        page = f"<body><{tag}>{PARAGRAPHS}</{tag}><div class=comments>{PARAGRAPHS.replace('Paragraph', 'Reply')}</div></body>"
        assert B.main_text(page).split("\n") == TEXT


def plain_stretches(weights, windows):
    """Surge and dive points by adding up every window anew; the text between the first surge and the last dive."""
    sums = [sum(weights[i : i + windows.lines]) for i in range(len(weights))]
    inside, marked = False, []
    for weight, total in zip(weights, sums):
        if inside and total <= windows.dive:
            inside = False
        elif not inside and total >= windows.surge and weight:
            inside = True
        marked.append(inside)
    if True not in marked:
        return [False] * len(weights)
    first, last = marked.index(True), len(marked) - 1 - marked[::-1].index(True)
    return [first <= i <= last and w > 0 for i, w in enumerate(weights)]


def test_windows_against_plain_sums():
    rng = random.Random(6)
    for _ in range(2000):
        weights = [rng.choice([0, 0, 3, 20, 70, 200]) for _ in range(rng.randint(0, 25))]
        windows = B.Windows(lines=rng.randint(1, 5), surge=rng.randint(1, 250), dive=rng.randint(0, 100))
        assert B.stretches(weights, windows) == plain_stretches(weights, windows)


UNMARKED = "<html><body>{before}<div><p>{long}</p>{between}<p>{long}</p></div>{after}</body></html>"
LONG = "This paragraph says something at length about one thing and another, so that it weighs more than a menu or a notice would. " * 2


def test_short_lines_between_paragraphs_stay_and_those_around_go():
    short = "".join(f"<p>{t}</p>" for t in ("Yes.", "No.", "Why?", "Ok then.", "Sure."))
    menu = "".join(f"<div>{t}</div>" for t in ("Home", "News", "Sport", "Weather", "About"))
    text = B.main_text(UNMARKED.format(before=menu, long=LONG, between=short, after=menu))
    assert text.split("\n") == [*(["Weather", "About"]), LONG.strip(), "Yes.", "No.", "Why?", "Ok then.", "Sure.", LONG.strip()]


def test_the_windows_decide_without_an_article():
    page = UNMARKED.format(before="<div>Home</div>" * 6, long=LONG, between="", after="<div>Imprint</div>" * 6)
    narrow, wide = (B.main_text(page, B.Windows(lines=n)) for n in (1, 5))
    assert narrow == "\n".join([LONG.strip()] * 2) and wide.count("Home") == 4 and "Imprint" not in wide
    assert B.main_text(page, B.Windows(surge=1, dive=0)).count("Imprint") == 6


def test_text_of_formulas_and_drawings_stays():
    page = "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math>.</p><svg><text>Axis</text></svg><object>fallback</object></article>"
    assert "x=2" in B.main_text(page) and "Axis" in B.main_text(page) and "fallback" in B.main_text(page)


@pytest.mark.parametrize(
    "page",
    ['<div class="comment">' * 100_000, "<b>" * 50_000 + "</i>" * 50_000, "<a " * 100_000, "<a " * 100_000 + ">", "<ul><li>" * 50_000,
     "<!--" * 100_000, '<a b="' * 100_000, "</" * 100_000 + ">", "<script>" + "</scrip " * 50_000, "&#" * 100_000, "<" * 100_000],
)
def test_hostile_pages_cost_little(page):
    began = time.process_time()
    B.main_text(page + "<p>words</p>")
    assert time.process_time() - began < 8
