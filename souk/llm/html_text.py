"""Main text of web pages, by tag-path ratios.

A page is read into text nodes, each with the path of tags from the root to it.
What can only be furniture by its tag, role or being hidden (menus, headers and
footers of the page, sidebars, forms, scripts, styles) is set aside.  For every
path of what is left, the length of its text and its punctuation per node are
aggregated; along the page both ratios are smoothed with a Gaussian and fused by
their product (with the path's own length ratio); text in links scores nothing.  A class or
id that names furniture makes a path of its own and lowers its score; it deletes
nothing by itself, so a wrapper that is called "has-sidebar" lowers all alike.
The mean score of a path against the page's decides: paths above the threshold
are content.

The article is the smallest element that holds nearly all content, or the
article element around that.  Of its parts, those with content stay, and so does
what lies between them.  Before the first and behind the last, headings and
short paragraphs, lists and tables stay; boxes without content or heading, lists
of links (outside an article element), and what is named as furniture go.  A
headline before the article belongs to it.

Character references are decoded, white space in a block becomes one space,
blocks are trimmed and joined by a blank line.

Defined cases: a null or empty page, or one without text, gives the empty text;
an unclosed tag ends with what holds it; a tag cut off at the end of the page
is no text; repeated rows get equal texts; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import packed, ship, sliced, table

TAG = re.compile(r"""<(?:!--(?:.*?-->|.*\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z))""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
          "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br", "img"}
#: an open paragraph ends where one of these begins
ENDS_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
          "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
#: opening one of these closes an open one of the set, up to the container
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
            "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
FURNITURE = {"head", "nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "svg", "canvas", "object", "audio", "video", "map", "math",
             "fieldset", "datalist", *RAW}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "status", "menu", "menubar", "toolbar", "form",
         "tablist"}
MARKS = {"nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "masthead", "footer", "sidebar", "widget", "ad", "ads", "advert", "adverts",
         "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promotion", "notice", "notices", "cookie", "cookies", "consent", "gdpr",
         "popup", "modal", "overlay", "newsletter", "subscribe", "share", "sharing", "social", "related", "recommended", "comment", "comments",
         "disqus", "discussion", "responses", "reply", "replies", "login", "signup", "search", "toolbar", "pagination", "pager", "alert", "skip", "topbar", "toc"}
ARTICLE = {"article", "main"}
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
#: share of the content text that the article's element must hold
MOST = 0.9
#: what a class or id that names furniture leaves of a path's score
MARKED = 0.02
#: a path is content if its mean score is at least this share of the page's, weighted by text
THRESHOLD = 0.3
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: tags whose class or id says nothing: a paragraph, heading, item or cell is no box of furniture
PLAIN = {"html", "body", "main", "p", "li", "dt", "dd", "td", "th", "tr", "pre", "blockquote", "figure", "figcaption", *HEADINGS}
BOXES = {"div", "section", "center"}
#: elements deeper than this are read as if they stood at this depth, as browsers do
DEPTH = 512


class Node:
    __slots__ = ("tag", "parent", "path", "out", "article", "block", "marked")

    def __init__(self, tag, parent, path, out, article, block, marked=False):
        self.tag, self.parent, self.path, self.out, self.article, self.block, self.marked = tag, parent, path, out, article, block, marked


def _kind(tag: str, attributes: str, inside_article: bool) -> tuple[bool, bool]:
    """Whether an element is furniture, and whether a class or id names it so."""
    if tag in FURNITURE or tag == "header" and not inside_article:
        return True, False
    if not attributes or attributes.isspace():
        return False, False
    marked = False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True, False
        if name == "role" and value.lower() in ROLES:
            return True, False
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, False
        if name in ("class", "id") and tag not in PLAIN and tag not in INLINE:
            words = {w.lower() for w in TOKEN.findall(value)}
            marked = marked or bool(words & MARKS) or "header" in words and not inside_article
    return False, marked


def text_nodes(page: str):
    """(element, block number, decoded text) of every text node that is not furniture."""
    root = Node("", None, "", False, False, 0)
    stack, out, block, pos, n = [root], [], 0, 0, len(page)

    def text(s):
        if s and not stack[-1].out:
            out.append((stack[-1], block, html.unescape(s)))

    while pos < n:
        lt = page.find("<", pos)
        if lt < 0:
            text(page[pos:])
            break
        m = TAG.match(page, lt)
        if m is None:  # a bare '<'
            nxt = page.find("<", lt + 1)
            nxt = n if nxt < 0 else nxt
            text(page[pos:nxt])
            pos = nxt
            continue
        text(page[pos:lt])
        pos = m.end()
        if m[2] is None:
            continue
        closing, tag, attributes = m[1] == "/", m[2].lower(), m[3]
        if tag not in INLINE:
            block += 1
        elif tag == "br":
            text(" ")
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag in INLINE and stack[k].block:  # a stray inline end does not close a block
                    break
            continue
        if tag in VOID:
            continue
        if tag in ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].block:
                    break
        elif tag in SIBLINGS:
            ends, holders = SIBLINGS[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in holders:
                    break
                if stack[k].tag in ends:
                    del stack[k:]
                    break
        top = stack[-1]
        article = top.article or tag in ARTICLE
        furniture, marked = _kind(tag, attributes, top.article)
        node = Node(tag, top, f"{top.path}/{tag}{'!' if marked else ''}", top.out or furniture, article, tag not in INLINE, marked)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, pos)
            pos = end.end() if end else n
        elif len(stack) < DEPTH and not (attributes.endswith("/") and tag in ("svg", "math")):
            stack.append(node)
    return out


def content_scores(nodes) -> np.ndarray:
    """Fused, smoothed ratio of every text node's path: text per node times punctuation per node, less links and marks."""
    size, marks, count = defaultdict(int), defaultdict(int), defaultdict(int)
    for element, _, s in nodes:
        size[element.path] += len(s)
        marks[element.path] += len(PUNCTUATION.findall(s))
        count[element.path] += 1
    paths = [e.path for e, _, _ in nodes]
    text = np.array([size[p] / count[p] for p in paths], float)
    mark = np.array([marks[p] / count[p] for p in paths], float)
    kernel = np.exp(-0.5 * (np.arange(-2, 3) / 1.0) ** 2)
    kernel /= kernel.sum()
    smooth = lambda v: np.convolve(np.pad(v, 2, "edge"), kernel, "valid")
    lowered = np.array([(0.0 if "/a/" in f"{p}/" else 1.0) * MARKED ** p.count("!") for p in paths])
    # a path's own ratio keeps a short box from being carried by its long neighbours
    return np.sqrt(text * smooth(text)) * (1 + smooth(mark)) * lowered


def _up(element):
    while element is not None:
        yield element
        element = element.parent


def content_paths(nodes) -> set[str]:
    """The paths whose nodes' mean score reaches THRESHOLD of the mean over the page's text; all of them if no node has a score."""
    score = content_scores(nodes)
    by = defaultdict(list)
    for (element, _, _), v in zip(nodes, score, strict=True):
        by[element.path].append(v)
    least = THRESHOLD * np.average(score, weights=[len(s) for _, _, s in nodes])
    mean = {p: np.mean(v) for p, v in by.items()}
    # a path that is named as furniture competes with the best of those that are less so, however short these are
    rival = lambda p: max((m for q, m in mean.items() if q.count("!") < p.count("!")), default=0.0)
    return {p for p, m in mean.items() if m >= least and m >= THRESHOLD * rival(p)} or set(mean)


def main_text(page: str | None) -> str:
    every = text_nodes(page) if page else []
    nodes = [x for x in every if x[2].strip()]
    if not nodes:
        return ""
    content = content_paths(nodes)
    good = [(e, block, s) for e, block, s in nodes if e.path in content]
    held, total = defaultdict(int), sum(len(s) for _, _, s in good)
    for element, _, s in good:
        for e in _up(element):
            held[e] += len(s)
    # the smallest element that holds nearly all of it, seen from the longest content node
    longest = max(good, key=lambda x: len(x[2]))[0]
    chain = [e for e in _up(longest) if held[e] >= MOST * total]
    article = next((e for e in chain if e.tag == "article"), None)
    root = article or next((e for e in chain if e.block or e.parent is None), chain[-1])

    # blocks in page order, with their text, its share in links, and the part of the article they stand in
    text, linked, place = defaultdict(list), defaultdict(int), {}
    for element, block, s in every:
        text[block].append(s)
        above = list(_up(element))
        linked[block] += len(s.strip()) if any(e.tag == "a" for e in above) else 0
        if s.strip() and block not in place:
            place[block] = above
    blocks = sorted(place)
    lines = {k: " ".join("".join(text[k]).split()) for k in blocks}
    with_content = {block for _, block, _ in good}
    part = {k: place[k][max(0, place[k].index(root) - 1)] if root in place[k] else None for k in blocks}
    inside = [k for k in blocks if part[k] is not None]
    size, links, heads, full = defaultdict(int), defaultdict(int), set(), set()
    for k in inside:
        for e in place[k]:
            size[e] += len(lines[k])
            links[e] += linked[k]
            if any(x.tag in HEADINGS for x in place[k]):
                heads.add(e)
            if k in with_content:
                full.add(e)
    core = [k for k in inside if k in with_content]

    def stays(k: int) -> bool:
        within = place[k][:place[k].index(root)]
        if any(e.marked and e not in full for e in within):
            return False
        p = part[k]
        if p is root or p in full or core[0] < k < core[-1]:
            return True
        if p.tag in BOXES and article is None and p not in heads:
            return False
        own = p.tag in HEADINGS or p.tag == "p" or article is not None
        return own or links[p] <= 0.5 * size[p]

    out = [k for k in inside if stays(k)]
    if not any(x.tag in HEADINGS for k in out if k < core[0] for x in place[k]):
        # a headline that stands before the article's element
        before = [k for k in blocks if k < core[0] and part[k] is None and any(x.tag == "h1" for x in place[k]) and not any(x.marked for x in place[k] if x not in chain)]
        out = before[-1:] + out
    return "\n\n".join(lines[k] for k in out if lines[k])


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """row (the whole row as a struct) and main_text."""
    ship(pages.sparkSession)
    src = pages.select(packed(pages, "row"))
    schema = T.StructType([*src.schema.fields, T.StructField("main_text", T.StringType())])

    def run(batches):
        for b in sliced(batches):
            found = [main_text(p) for p in b.column("row").field(html_col).to_pylist()]
            yield pa.record_batch([b.column("row"), pa.array(found, pa.string())], names=["row", "main_text"])

    return src.mapInArrow(run, schema)


def op2(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    out = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    text = F.col("main_text")
    return out.select(F.col("row.page_id").alias("page_id"), F.col("row.url").alias("url"), text.alias("text"), F.char_length(text).cast("long").alias("n_chars"))
