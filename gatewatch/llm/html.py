"""Main text of web pages by a maximum-scoring contiguous region.

A page is a sequence of words and tags. A word scores by the section it stands
in (the nearest enclosing structural element with its classes), a tag by its
name, both as log-odds learnt from labelled pages: pages that mark their article
(``article`` or ``main``) label their own words. Words of sections never seen
score +1, tags always score below zero, those between two words not below a bound
in all. One linear scan finds the contiguous region with the largest sum. Inside it,
sections that are boilerplate by element or class (menus, headers, footers,
sidebars, notices, adverts, reader comments) or by a negative learnt score are left
out. A form is boilerplate by what it holds, few words to a control; the header of
an article is kept if it holds a heading and is not made of links; and a paragraph
goes by its class only where the class can mean nothing else.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_or_empty, with_id

# Elements and the class or id words of what is not the article.
RAW = ("script", "style", "title", "noscript", "template", "iframe", "textarea")
BOILERPLATE_TAGS = {"nav", "header", "footer", "aside", "menu", "dialog", "button", "head", "fieldset", "label"}
BOILERPLATE_WORDS = {
    "ad", "ads", "adbox", "banner", "promo", "popup", "modal", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert",
    "menu", "nav", "navbar", "navigation", "topbar", "toolbar", "sidebar", "aside", "widget", "widgets", "related", "share", "sharing",
    "social", "footer", "header", "masthead", "login", "signup", "search", "form", "pagination", "pager", "replies", "respond", "disqus",
    "feedback", "copyright", "legal", "disclaimer", "skip", "tags", "paywall",
}
BOILERPLATE_STARTS = ("advert", "comment", "sponsor", "breadcrumb", "newsletter", "subscri", "sidebar", "cookie", "promo")
# of these, what a class of a paragraph or of another small element says for sure
SURE_WORDS = {"ad", "ads", "adbox", "banner", "promo", "popup", "modal", "cookie", "cookies", "consent", "gdpr", "sharing", "paywall", "pagination"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert"}
ARTICLE = {"article", "main"}
# Elements that end a block of text, and of these the ones that hold sections.
SECTIONS = {"html", "body", "div", "section", "article", "main", "ul", "ol", "dl", "table", "blockquote", "figure", "details",
            "nav", "header", "footer", "aside", "form", "menu", "dialog", "head", "fieldset"}
BLOCKS = SECTIONS | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "td", "th", "thead", "tbody", "caption", "pre",
                     "br", "hr", "address", "figcaption", "summary", "option", "legend", "button", "label", "center"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
ENDS = {"p": BLOCKS - {"br"}, "li": {"li"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}

# Costs of a word that is left out anyway, of a tag never seen in training, and what
# all tags between two words cost at most.
DROPPED, UNKNOWN_TAG, GAP = 0.1, 0.1, 5.0
# Words that a form must hold for each of its controls not to be boilerplate.
FORM_WORDS = 30

# Raw elements without an end tag reach to the end of the page, as HTML reads them;
# "/>" does not close them. A select also ends at a control that cannot stand in it.
TOKEN = re.compile(
    rf"""<!--(?:.*?-->|.*)|<(?P<raw>{'|'.join(RAW)})(?=[\s/>])[^<>]*>(?:.*?</(?P=raw)(?=[\s/>])[^>]*>|.*)|"""
    r"""<select(?=[\s/>])[^<>]*>(?:.*?(?:</?select(?=[\s/>])[^>]*>|(?=<(?:input|keygen|textarea)[\s/>]))|.*)|"""
    r"""<(?P<svg>svg)(?=[\s/>])[^<>]*>|<[!?][^>]*>|"""
    r"""<(?P<end>/?)(?P<name>[a-z][^\s/<>"']*)(?P<attrs>(?:[^<>"']|"[^"<]*"|'[^'<]*')*+)/?>|</?[a-z][^<>]*>?|(?P<text>[^<]+|<)""",
    re.S | re.I)
# What ends or holds an svg: elements that HTML moves out of it, and the ones in which they may stand.
OUT_OF_SVG = ("b|big|blockquote|body|br|center|code|dd|div|dl|dt|em|embed|h[1-6]|head|hr|i|img|li|listing|menu|meta|nobr|ol|p|pre|ruby|s|small|span|"
              "strong|strike|sub|sup|table|tt|u|ul|var")
IN_SVG = {"foreignobject", "desc", "title"}
SVG_TOKEN = re.compile(
    rf"<!--(?:.*?-->|.*)|<!\[CDATA\[(?:.*?\]\]>|.*)|<(?P<end>/?)(?P<name>svg|{'|'.join(IN_SVG)}|{OUT_OF_SVG})(?=[\s/>])[^<>]*>", re.S | re.I)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
CLASS_WORD = re.compile(r"[a-z]+")


def section_of(name: str, attrs: str) -> tuple[str, bool]:
    """The key of an element and whether it is boilerplate by name or class."""
    words: list[str] = []
    role = False
    for kind, a, b, c in NAMED.findall(attrs) if "=" in attrs else ():
        value = (a or b or c).lower()
        if kind.lower() == "role":
            role |= value in ROLES
        else:
            words += CLASS_WORD.findall(value)
    if name in ("html", "body"):
        return name, False
    listed = BOILERPLATE_WORDS if name in SECTIONS else SURE_WORDS
    bad = role or name in BOILERPLATE_TAGS or (name != "form" and any(w in listed or w.startswith(BOILERPLATE_STARTS) for w in words))
    if name in ARTICLE:
        bad = any(w.startswith("comment") for w in words)
    return ".".join([name, *sorted(set(words))[:4]]), bad


def after_svg(page: str, at: int) -> int:
    """Where an svg whose content starts at ``at`` ends: behind its end tag, or
    before an element that HTML moves out of it."""
    depth, held = 1, 0
    for m in SVG_TOKEN.finditer(page, at):
        name = (m["name"] or "").lower()
        step = -1 if m["end"] else 0 if m.group().endswith("/>") else 1
        if name == "svg":
            depth += step
            if depth == 0:
                return m.end()
        elif name in IN_SVG:
            held = max(0, held + step)
        elif name and not held and (not m["end"] or name in ("p", "br")):
            return m.start()
    return len(page)


def raw_events(page: str) -> Iterator[tuple[str, str, bool, bool, str, int]]:
    """(kind, key, boilerplate, in article, text, holder) of each tag and piece of text.

    Kinds: "text" (key: its section), "link" (the same, inside a link), "tag" (key:
    the name), "block" (a tag that ends a block), "control" and "open" (a form or an
    article's header begins; holder: its number, key: the number around it). holder
    is the innermost of these, 0 outside. Unclosed elements end with their parent;
    an article starts anew whatever was left open before it."""
    stack: list[tuple[str, str, bool, bool, int]] = [("", "page", False, False, 0)]
    at, number, linked = 0, 0, False
    while at < len(page):
        m = TOKEN.match(page, at)
        at = m.end()
        if m["svg"]:
            at = at if m.group().endswith("/>") else after_svg(page, at)
            continue
        text = m["text"]
        if text is not None:
            _, key, bad, inside, holder = stack[-1]
            yield "link" if linked else "text", key, bad, inside, text, holder
            continue
        name = m["name"]
        if name is None:
            if (m["raw"] or "").lower() == "textarea":
                yield "control", "", False, False, "", stack[-1][4]
            continue
        name = name.lower()
        if name == "a":
            linked = not m["end"]
        if m["end"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
                if stack[i][0] in SECTIONS and name not in SECTIONS:
                    break
        elif name in VOID:
            if name == "input" and not HIDDEN.search(m["attrs"] or ""):
                yield "control", "", False, False, "", stack[-1][4]
        else:
            while len(stack) > 1 and name in ENDS.get(stack[-1][0], ()):
                stack.pop()
            key, bad = section_of(name, m["attrs"] or "")
            if name in SECTIONS or bad:
                _, _, was_bad, inside, holder = stack[-1]
                if name == "form" or (name == "header" and inside and not was_bad):
                    number += 1
                    yield "open", str(holder), False, inside, name, number
                    stack.append((name, key if not was_bad else stack[-1][1], was_bad, inside, number))
                elif name in ARTICLE:
                    comments = any(b and k.partition(".")[2].find("comment") >= 0 for _, k, b, _, _ in stack)
                    stack.append((name, key, bad or comments, not (bad or comments), holder))
                else:
                    stack.append((name, key if not was_bad else stack[-1][1], bad or was_bad, inside, holder))
        yield "block" if name in BLOCKS else "tag", name, False, stack[-1][3], "", stack[-1][4]


HIDDEN = re.compile(r"""\btype\s*=\s*["']?hidden""", re.I)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


def events(page: str) -> list[tuple[str, str, bool, bool, str]]:
    """(kind, key, boilerplate, in article, text) of the texts and tags of a page,
    after forms and articles' headers have been judged by what they hold."""
    found = list(raw_events(page))
    around: dict[int, int] = {}
    name: dict[int, str] = {}
    words, links, controls, headings = Counter(), Counter(), Counter(), Counter()
    for kind, key, bad, _, text, holder in found:
        if kind == "open":
            around[holder], name[holder] = int(key), text
        elif holder:
            n = len(text.split()) if not bad else 0
            while holder:
                if kind in ("text", "link"):
                    words[holder] += n
                    links[holder] += n if kind == "link" else 0
                elif kind == "control":
                    controls[holder] += 1
                elif key in HEADINGS:
                    headings[holder] += 1
                holder = around[holder]
    spoilt = {0: False}
    for k in sorted(name):  # the ones around come first
        own = words[k] < FORM_WORDS * controls[k] if name[k] == "form" else not headings[k] or 2 * links[k] > words[k]
        spoilt[k] = own or spoilt[around[k]]
    return [("text" if kind == "link" else kind, key, bad or (kind in ("text", "link") and spoilt[holder]), inside and not spoilt[holder], text)
            for kind, key, bad, inside, text, holder in found if kind not in ("open", "control")]


def best_region(scores: list[float]) -> tuple[int, int]:
    """The contiguous range with the largest sum, of several the first to reach it
    and the longest to the left; empty if no sum is above zero."""
    best = total = 0.0
    start = 0
    region = (0, 0)
    for i, s in enumerate(scores):
        total += s
        if total > best:
            best, region = total, (start, i + 1)
        elif total < 0:
            total, start = 0.0, i + 1
    return region


def scored(page: str, weights: dict[str, float]) -> tuple[list[tuple[str, str]], list[float]]:
    """(kind, text) of the texts and tags of a page, and their scores."""
    pieces: list[tuple[str, str]] = []
    scores: list[float] = []
    gap = 0.0  # what the tags since the last word have cost
    for kind, key, bad, _, text in events(page):
        if kind == "text":
            words = len(text.split())
            score = weights.get("w:" + key, 1.0)
            bad = bad or score < 0
            pieces.append(("bad" if bad else "text", text))
            scores.append(words * (-DROPPED if bad else score))
            gap = 0.0 if words else gap
        else:
            cost = min(-weights.get("t:" + key, -UNKNOWN_TAG), GAP - gap)
            gap += cost
            pieces.append((kind, ""))
            scores.append(-cost)
    return pieces, scores


def article_text(page: str, weights: dict[str, float]) -> str:
    """The blocks of the best region, joined by a newline."""
    pieces, scores = scored(page, weights)
    lo, hi = best_region(scores)
    blocks: list[str] = []
    held: list[str] = []
    for kind, text in [*pieces[lo:hi], ("block", "")]:
        if kind == "text":
            held.append(text)
        elif kind == "block" and held:
            line = " ".join(html.unescape("".join(held)).split())
            if line:
                blocks.append(line)
            held = []
    return "\n".join(blocks)


def learn_weights(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", max_pages: int = 2000,
                  max_keys: int = 5000) -> dict[str, float]:
    """Scores of sections ("w:") and tags ("t:") from at most about
    ``max_pages`` pages (picked by a hash of the id) that mark their article."""
    share = max_pages / max(pages.count(), 1)
    sample = pages.select(F.col(id_col).alias("id"), text_or_empty(html_col).alias("html"))
    if share < 1:
        sample = sample.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000))
    sample = sample.where(F.col("html").rlike("(?i)<(article|main)[\\s/>]"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[Counter] = [Counter(), Counter()]
        for batch in batches:
            for value in batch.column(0):
                for kind, key, bad, inside, text in events(value.as_py()):
                    n = len(text.split()) if kind == "text" else 1
                    seen[inside and not bad][("w:" if kind == "text" else "t:") + key] += n
        keys = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([seen[0][k] for k in keys], pa.int64()), pa.array([seen[1][k] for k in keys], pa.int64())],
            names=["key", "out", "inside"])

    counted = sample.select("html").mapInArrow(work, "key string, out long, inside long").groupBy("key").agg(
        F.sum("out").alias("out"), F.sum("inside").alias("inside"))
    rows = counted.orderBy(F.desc(F.col("out") + F.col("inside")), "key").limit(max_keys).collect()
    out: dict[str, float] = {}
    for r in rows:
        odds = math.log((r.inside + 0.5) / (r.out + 0.5))
        if r.key.startswith("w:"):
            if r.inside + r.out >= 20:  # less says little about a section
                out[r.key] = max(-3.0, min(3.0, odds)) or 0.1
        else:
            out[r.key] = -0.05 if odds > 2 else -min(3.0, max(0.3, 0.5 - odds / 2))
    return out


def main_text(pages: DataFrame, weights: dict[str, float], id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, text): one row per row of ``pages``. Null, empty and tag-only pages
    have the text ''; repeated rows are kept; a null id keeps its row; other
    columns are not read."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([article_text(v.as_py(), weights) for v in batch.column(1)], pa.string())], names=["id", "text"])

    return pages.select(F.col(id_col).alias("id"), text_or_empty(html_col)).mapInArrow(
        work, with_id(pages, id_col, "text string"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every row of ``pages``. The url travels beside the id."""
    pages = table(spark, sf_dir, "pages").select(F.struct("page_id", "url").alias("page"), "html")
    found = main_text(pages, learn_weights(pages, "page"), "page")
    return found.select("id.page_id", "id.url", "text", F.length("text").cast("long").alias("n_chars"))
