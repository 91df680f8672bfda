import html
import re

import pytest

from gatewatch.llm import html as h
from gatewatch.llm.common import table


def marked_article(page):
    """Brute force for pages that mark their article and have no boilerplate in it."""
    body = re.search(r"<article>(.*)</article>", page, re.S)
    blocks = re.split(r"</?(?:p|h1|br)>", body.group(1)) if body else []
    lines = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equals_marked_article(spark, sf):
    sf = f"/root/testdata/{sf}"
    pages = {r.page_id: r for r in table(spark, sf, "pages").collect()}
    got = {r.page_id: r for r in h.op7_html_extraction(spark, sf).collect()}
    assert got.keys() == pages.keys()
    for k, r in got.items():
        assert r.text == marked_article(pages[k].html), k
        assert r.n_chars == len(r.text) and r.url == pages[k].url


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav><div class="cookie-notice">We use cookies</div>
<div id="content"><h2>Big  &amp; <i>bold</i>&nbsp;news</h2><p>First para<script>var a="<p>no</p>";</script> goes
 on.<p>Second &lt;one&gt; &#233;.<div class="ad">Buy now</div><ul><li>item one<li>item two</ul><form><label>mail</label><input></form>
<blockquote>quoted words here</blockquote><section id="comments"><p>Nice post!</p><article class="comment">me too</article></section></div>
<aside>Other stories to read</aside><footer>Copyright</footer><!-- end --></body></html>"""
TEXT = "Big & bold news\nFirst para goes on.\nSecond <one> é.\nitem one\nitem two\nquoted words here"


def test_page_without_article_mark():
    assert h.article_text(PAGE, {}) == TEXT


def test_boilerplate_inside_the_article():
    page = PAGE.replace('<div id="content">', "<article>").replace("</section></div>", "</section></article>")
    assert h.article_text(page, {"w:article": 3.0}) == TEXT


def test_odd_pages(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "<p></p><br>", "x"), (None, "<p>a b</p>", "x"), (4, "plain < words", "x"),
            (4, "plain < words", "x"), (5, "<p>" + "word " * 100_000, "x"), (6, "<!-- <p>open", "x"), (7, "<a '" * 3000 + ">t", "x")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    w = h.learn_weights(pages)
    got = {r.id: r.text for r in h.main_text(pages, w).collect()}
    assert got[1] == got[2] == got[3] == got[6] == ""
    assert got[None] == "a b" and got[4] == "plain < words" and len(got[5].split()) == 100_000
    assert h.main_text(pages.limit(0), w).count() == 0


@pytest.mark.parametrize("mark", [
    '<svg class="i"/>', "<svg-icon>", "<svg-icon></svg-icon>", "<title-bar></title-bar>", "<select-box>", "<script-x>", "<nav-link>", "<label-x>",
    "<svg><path d='M0'>", "<svg><svg><path/></svg>", "<svg><title>t</title><path/></svg>", "<svg><title/><text>no</text></svg>",
    "<svg><foreignObject><p>no</p></foreignObject></svg>", "<svg><![CDATA[<p>no</p>]]></svg>", "<svg><!-- <p> --></svg>", "<SVG>no</SVG >",
    "<select><option>no</select>", "<select><option>no<input>", "<style>no</style foo>", "<template><p>no</p></template>"])
def test_rest_of_the_page_is_read(mark):
    assert h.article_text(f"<p>first words here</p>{mark}<p>rest of the article</p>", {}) == "first words here\nrest of the article"


def test_svg_without_end_before_another_svg():
    page = "<p>one two three</p><svg><path d='M0'><p>four five six</p><svg><path/></svg><p>seven eight</p>"
    assert h.article_text(page, {}) == "one two three\nfour five six\nseven eight"


@pytest.mark.parametrize("mark", ["<script>", "<title/>", "<textarea>", "<iframe>", "<style >", "<select>", "<svg>", "<template/>"])
def test_what_html_reads_to_the_end_stays_out(mark):
    assert h.article_text(f"<p>first words here</p>{mark}not <a>text</a> at all", {}) == "first words here"


PARAGRAPHS = [f"paragraph {i} of the story goes on with some more words so that it counts as text" for i in range(6)]


def test_a_form_around_the_page_is_not_boilerplate():
    body = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    page = f"""<body><form id="aspnetForm" method=post><input type="hidden" name="__VIEWSTATE" value="x"><div id="menu"><a href=/>Home</a></div>
<div id="main-text">{body}</div><div class="search-box"><input name=q><button>Go</button></div></form></body>"""
    assert h.article_text(page, {}) == "\n".join(PARAGRAPHS)
    contact = f"<div><p>{PARAGRAPHS[0]}</p><form><p>Your name and address please</p><input name=a><textarea>x</textarea></form><p>{PARAGRAPHS[1]}</p></div>"
    assert h.article_text(contact, {}) == "\n".join(PARAGRAPHS[:2])


def test_the_header_of_an_article():
    body = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    page = f"<header><h1>Site name</h1></header><article><header><h1>The title</h1></header>{body}</article>"
    assert h.article_text(page, {}) == "\n".join(["The title", *PARAGRAPHS])
    linked = f"<article><header><h2><a href=/>Home</a> <a href=/n>News</a></h2></header>{body}</article>"
    assert h.article_text(linked, {}) == "\n".join(PARAGRAPHS)


def test_class_words_of_paragraphs():
    page = f"""<article><p>{PARAGRAPHS[0]}</p><p class="legal">{PARAGRAPHS[1]}</p><p class="ad">Buy this now</p><p class="tags">{PARAGRAPHS[2]}</p>
<div class="share">Share this</div></article>"""
    assert h.article_text(page, {}) == "\n".join(PARAGRAPHS[:3])


def test_an_empty_table_between_paragraphs():
    table_ = "<table>" + "<tr><td></td><td></td></tr>" * 60 + "</table>"
    assert h.article_text(f"<div><p>{PARAGRAPHS[0]}</p>{table_}<p>{PARAGRAPHS[1]}</p></div>", {}) == "\n".join(PARAGRAPHS[:2])
    assert h.article_text(f"<div><p>{PARAGRAPHS[0]}</p>{table_}<p>{PARAGRAPHS[1]}</p></div>", {"t:td": -3.0, "t:tr": -3.0}) == "\n".join(PARAGRAPHS[:2])


def test_the_region_has_the_largest_sum():
    import random

    rng = random.Random(6)
    for _ in range(500):
        scores = [rng.choice([-3.0, -1.0, -0.5, 0.0, 0.5, 1.0, 4.0]) for _ in range(rng.randint(0, 25))]
        lo, hi = h.best_region(scores)
        sums = [sum(scores[a:b]) for a in range(len(scores) + 1) for b in range(a, len(scores) + 1)]
        assert sum(scores[lo:hi]) == max(sums) and (max(sums) > 0 or lo == hi)
    pieces, scores = h.scored("<p>a b c</p>" + "<hr>" * 100 + "<p>d</p><div class=ad>e f</div>", {})
    assert len(pieces) == len(scores) and sum(scores) == pytest.approx(3 + 1 - 0.1 - h.GAP - 0.2 - 0.2 - 0.1)
