"""Main text of web pages by site style trees.

Pages of a host are merged into one style tree: a node is the path of tags with their classes and
ids. A node's presentation importance is the entropy of the ways its pages fill it with children, its
content importance one less the mean entropy with which its texts spread over the host's pages, so a
branch that shows the same everywhere has no importance. Branches of low importance are removed
from each page.

The tree starts from what tags and well-known names say: menus, footers, forms, adverts,
comments and the like have no importance, and the text of an article's own elements has full importance,
also where many pages share a passage. Inside an article or main element only tags, roles, hidden
elements and whole known class names are dropped, and headings never by a name. The statistics decide
on all other branches, and on a main element's own text on a page that has an article. Where a page
has an article or main element (else a content element), text outside it isn't main text.

A null html is an empty page; a null or odd url belongs to the host ''. Markup may be cut off
anywhere. Equal pages of a host count once in the tree.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldoflow.operators.joins import join_splittable
from saldoflow.sources.storage import stored

#: Share of the children's importance in a node's; least importance; least pages of a node for it to be
#: part of the host's template.
DAMPING, LEAST_IMPORTANCE, LEAST_PAGES = 0.9, 0.3, 4

_MARKUP = re.compile(
    r"<!--(?:.*?--!?>|.*)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
    r"|<[!?/][^>]*+>"
    r"|<[a-zA-Z!?/][^>]*+\Z", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)|\b(hidden)\b")
_MODIFIER = re.compile(r"(?:no|has|with|without|is|hide|show)[-_]", re.I)
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")

RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "xmp", "noembed", "noframes", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr",
    "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "section", "summary", "table",
    "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: What an opening tag ends, up to the elements that bound it.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
#: Elements without main text, by tag, role and words of class and id.
DROPPED_TAGS = {"head", "nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "fieldset", "annotation", "annotation-xml"} | RAW
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "search", "complementary", "dialog", "alert", "alertdialog", "menu", "menubar", "form"}
DROPPED_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "alert", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "consent", "cookie", "cookies", "copyright", "disclaimer", "disqus", "footer", "gdpr", "header",
    "login", "masthead", "menu", "menus", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
    "notification", "overlay", "pager", "pagination", "popup", "promo", "promotion", "recommended", "related", "replies",
    "respond", "search", "share", "sharing", "sidebar", "sidebars", "signup", "social", "sponsor", "sponsored", "subscribe",
    "subscription", "teaser", "toolbar", "widget", "widgets",
}
#: Words that stand beside one of DROPPED_NAMES in known class names, as in related-posts; not so related-work.
FILLERS = {
    "area", "articles", "bar", "block", "body", "box", "btn", "button", "buttons", "container", "form", "icons", "inner", "item", "items",
    "label", "link", "links", "list", "outer", "panel", "posts", "slot", "stories", "unit", "wrap", "wrapper",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
COMMENT_NAMES = {"comment", "comments", "reply", "replies", "respond", "disqus"}
CONTENT_NAMES = {"article", "content", "entry", "main", "post", "story"}
#: Elements whose text is content wherever a content element holds them.
TEXT_TAGS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "blockquote", "pre", "table",
             "thead", "tbody", "tfoot", "tr", "td", "th", "figure", "figcaption", "caption", "article", "main", "hgroup", "header"}


class Element(NamedTuple):
    tag: str
    level: int  # 3 in an article, 2 in a main element, 1 in one named content, 0 else
    dropped: bool
    branch: tuple[str, ...]  # paths of the enclosing nodes on which the statistics decide
    asked: tuple[str, ...]  # the same with nodes of a main element's own text, for a page with an article
    path: str


class Text(NamedTuple):
    text: str
    level: int
    branch: tuple[str, ...]
    asked: tuple[str, ...]


def _names(value: str) -> set[str]:
    """Words of class names; a name like no-sidebar or has-comments says what is elsewhere."""
    told = " ".join(x for x in value.split() if not _MODIFIER.match(x))
    return {x.lower() for x in _NAME.findall(told)} | set(re.split(r"[^a-z0-9]+", told.lower()))


def _known(value: str) -> set[str]:
    """Those of DROPPED_NAMES that stand in class names made of nothing but known words."""
    found = set()
    for name in value.split():
        name = re.sub(r"[0-9]+(?:x[0-9]+)?", "", name)
        words = _names(name) - {""}
        if words <= DROPPED_NAMES | FILLERS | {re.sub("[^a-z]+", "", name.lower())}:
            found |= words & DROPPED_NAMES
    return found


def _element(tag: str, attributes: str, parent: Element) -> Element:
    names, classes, own_id, style, role, hidden = set(), "", "", tag, "", False
    if attributes and not attributes.isspace():
        for key, value, flag in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if flag:
                hidden = True
            elif key in ("class", "id"):
                names |= _names(value)
                if key == "class":
                    classes = value
                else:
                    own_id = value.strip().lower()
                style += "." + re.sub(r"[0-9]+", "#", " ".join(sorted(value.split())))
            elif key == "role":
                role = value.lower()
            elif key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
                hidden = True
    level = parent.level
    article = (tag == "article" or role == "article") and not names & COMMENT_NAMES
    if article:
        level = 3
    elif tag == "main" or role == "main":
        level = max(level, 2)
    elif tag in ("div", "section", "td") and names & CONTENT_NAMES and not names & DROPPED_NAMES:
        level = max(level, 1)
    if level and tag in HEADINGS:
        bad = set()
    elif parent.level >= 2 and tag != "article":
        bad = _known(classes) | {own_id} & COMMENT_NAMES & DROPPED_NAMES
    else:
        bad = names & DROPPED_NAMES
    if tag in ("html", "body"):
        dropped = False
    elif article or tag == "main":
        dropped = parent.dropped
    elif level and (tag == "header" or bad == {"header"}):
        dropped = parent.dropped or hidden
    else:
        dropped = parent.dropped or hidden or bool(bad) or tag in DROPPED_TAGS or tag == "header" or role in DROPPED_ROLES
    path = f"{parent.path}/{style}"
    plain = not classes if tag in HEADINGS or tag == "p" else not names
    sure = tag in ("html", "body") or level and tag in TEXT_TAGS and plain or level > parent.level or tag not in BLOCK
    asked = level == 2 and level == parent.level and tag in BLOCK
    return Element(tag, level, dropped, parent.branch if sure else (*parent.branch, path),
                   (*parent.asked, path) if asked or not sure else parent.asked, path)


def page_texts(html: str) -> tuple[list[Text], dict[str, list[str]]]:
    """Blocks of text that aren't dropped, in order, and the children's styles of undecided nodes."""
    stack = [Element("", 0, False, (), (), "")]
    blocks: list[Text] = []
    held: list[str] = []
    children: dict[str, list[str]] = {}
    asked: dict[str, list[str]] = {}
    place, end = 0, len(html)

    def flush() -> None:
        if held:
            text = " ".join(unescape("".join(held)).split())
            if text:
                blocks.append(Text(text, stack[-1].level, stack[-1].branch, stack[-1].asked))
            held.clear()

    def close(depth: int) -> None:
        if any(e.tag in BLOCK for e in stack[depth:]):
            flush()
        del stack[depth:]

    while place < end:
        found = _MARKUP.search(html, place)
        at = found.start() if found else end
        if at > place and not stack[-1].dropped:
            held.append(html[place:at])
        if not found:
            break
        place = found.end()
        closing, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    close(depth)
                    break
                if tag not in BLOCK and tag not in ("select", "button") and stack[depth].tag in BLOCK:
                    break
            continue
        if tag in RAW:
            if not attributes.endswith("/") or tag != "svg":
                stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, place)
                place = stop.end() if stop else end
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif not stack[-1].dropped:
                held.append(" ")
            continue
        if tag in BLOCK:
            ends, bounds = ENDS.get(tag, (set(), set()))
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in ends or stack[depth].tag == "p":
                    close(depth)
                elif stack[depth].tag in bounds or stack[depth].tag in BLOCK and not ends:
                    break
            flush()
        element = _element(tag, attributes, stack[-1])
        if element.branch:
            children.setdefault(element.branch[-1], [])
            if element.path != element.branch[-1]:
                children[element.branch[-1]].append(element.tag)
        if element.level == 2 and element.asked:
            asked.setdefault(element.asked[-1], [])
            if element.path != element.asked[-1]:
                asked[element.asked[-1]].append(element.tag)
        stack.append(element)
    flush()
    if any(b.level == 3 for b in blocks):  # the statistics decide on a main element's text beside an article
        blocks = [b._replace(branch=b.asked) if b.level == 2 else b for b in blocks]
        children = asked | children
    return blocks, children


def main_text(html: str, low: set[str]) -> str:
    """Main text of a page of whose host the nodes of the paths ``low`` are unimportant."""
    blocks, _ = page_texts(html)
    blocks = [b for b in blocks if not low.intersection(b.branch)]
    level = max((b.level for b in blocks), default=0)
    return "\n\n".join(b.text for b in blocks if b.level >= min(level, 2))


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _tree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each page adds to the undecided nodes of its host's tree."""
    for batch in batches:
        hosts, paths, kinds, features, digests = [], [], [], [], []
        for host, html, digest in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            html = html.as_py() or ""
            blocks, children = page_texts(html)
            own = {(p, 0, _hash(b.text)) for b in blocks for p in b.branch}
            own |= {(p, 1, _hash(" ".join(tags))) for p, tags in children.items()}
            for path, kind, feature in own:
                hosts.append(host), paths.append(path), kinds.append(kind), features.append(feature), digests.append(digest)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(kinds, pa.int32()),
             pa.array(features, pa.int64()), pa.array(digests, pa.int64())], ["host", "path", "kind", "feature", "digest"])


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def _digest() -> Column:
    return F.xxhash64(F.coalesce("html", F.lit("")))


def tree_rows(pages: DataFrame) -> DataFrame:
    """What each distinct page adds to its host's tree: ``host``, ``path``, ``kind``, ``feature``, ``digest``."""
    return pages.select(host_of(F.col("url")).alias("host"), "html", _digest().alias("digest")).mapInArrow(
        _tree_rows, "host string, path string, kind int, feature bigint, digest bigint").distinct()


def site_style_tree(pages: DataFrame) -> DataFrame:
    """Undecided nodes of every host's tree: ``host``, ``path``, ``pages``, ``presentation``, ``content``, ``importance``."""
    return _tree(tree_rows(pages))


def _tree(rows: DataFrame) -> DataFrame:
    counts = rows.groupBy("host", "path", "kind", "feature").agg(F.count("*").alias("c"))
    shown, told = F.col("kind") == 1, F.col("kind") == 0
    logs = F.col("c") * F.log("c")
    nodes = counts.groupBy("host", "path").agg(
        F.sum(F.when(shown, F.col("c"))).alias("pages"), F.sum(F.when(shown, logs)).alias("shown"),
        F.avg(F.when(told, F.log("c"))).alias("told"))
    m = F.log("pages")
    many = F.col("pages") > 1
    presentation = F.when(many, (F.col("pages") * m - F.col("shown")) / (F.col("pages") * m)).otherwise(1.0)
    content = F.when(many, 1 - F.coalesce("told", F.lit(0.0)) / m).otherwise(1.0)
    return nodes.select("host", "path", "pages", presentation.alias("presentation"), content.alias("content")).withColumn(
        "importance", (1 - DAMPING) * F.col("presentation") + DAMPING * F.col("content"))


def unimportant(pages: DataFrame) -> DataFrame:
    """``host``, ``digest`` of a page and ``low``, its own paths that show the same on all pages of the host.

    Pages without such paths have no row. Two pages of a host with one digest would share their paths,
    which changes nothing, as each path is low for the whole host.
    """
    rows = stored(tree_rows(pages))
    low = stored(_tree(rows).filter(
        (F.col("importance") < LEAST_IMPORTANCE) & (F.col("pages") >= LEAST_PAGES)).select("host", "path"))
    own = rows.filter("kind = 1").select("host", "path", "digest")  # one row per page and path
    return join_splittable(own, low, ["host", "path"], "inner").groupBy("host", "digest").agg(F.collect_set("path").alias("low"))


def _extracted(kind: pa.DataType | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py() or "", set(low.as_py() or ())) for html, low in zip(
                batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(np.array([len(t) for t in texts], np.int64))], ["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``url``, ``text``, ``n_chars``."""
    low = stored(unimportant(pages))
    named = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"), _digest().alias("digest"))
    rows = join_splittable(named, low, ["host", "digest"])
    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.select("page_id", "url", "html", "low").mapInArrow(
        _extracted(), f"page_id {kind}, url string, text string, n_chars bigint")
