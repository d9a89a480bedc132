"""Main text of raw HTML pages by tag-path ratios.

Text nodes are the blocks of a page. Their root-to-leaf tag paths are collected
per page; a path's text length and punctuation per node are smoothed along the
page, fused, and compared with a threshold. Paths above it carry content. The
article's core is the element that holds most of the content's text, where text in
<article> or <main> counts double. Its bounds are the smallest element that covers
the core and every <article> or <main> with content. Within them, nodes whose path
carries content are kept, and in the core and the articles also the other nodes
that are not mostly links.

Elements that are never article text (footers, controls, scripts and so on, by
tag or role) are left out before. Menus, page headers, asides and forms, and
class names and ids that sound like such an element, are a hint: the element is
left out unless it holds most of the page's unlinked text or an <article> or
<main>, as `_settle` says. So a form around a whole page costs nothing.

A null page is empty; a page without text gives the empty string. Unclosed and
stray tags are repaired as browsers do: what cannot stand in <head> ends it. An
<article> or <main> also ends a menu or page header that is still open.
Repeated rows give repeated results; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math".split())
NEVER = frozenset(
    "audio button canvas datalist dialog embed footer head iframe input label legend menu noscript option script select style svg template"
    " textarea title video".split()
)
#: What may stand in <head>; any other start tag and any text ends it.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: Elements that an <article> or <main> ends.
BEFORE_CONTENT = frozenset("nav header".split())
#: Elements that a new one of the same kind closes, and where the search for it ends.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Words that mark an element as page furniture when they lead or end one of its class names or its id.
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies discussion disqus"
    " feedback footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notification overlay pagination pager popup"
    " promo promotion promoted recommended related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe"
    " subscription toolbar topbar widget widgets".split()
)
KEEPING = frozenset("with has no without".split())
CONTENT = frozenset("content article main post entry story text body".split())
#: Of FURNITURE those whose elements are often longer than the article.
TALK = frozenset("comment comments discussion disqus replies reply respond".split())
#: How strongly class names and id hint: by a compound name, by a name of its own, by one of TALK.
COMPOUND, NAMED, TALKING = 1, 2, 3
#: Elements that hint by their tag; a header does outside of articles.
HINTING = {"form": COMPOUND, "object": COMPOUND, "aside": NAMED, "nav": NAMED, "header": NAMED}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?>[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>"
    r"|[^<]++|<",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
MARKS = re.compile(r"[.,;:!?…。、，；：！？]")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def _furniture(tag: str, rest: str, in_article: bool) -> tuple[bool, int]:
    """Whether an element is surely no part of an article, and how strongly its names hint that it is none."""
    if tag in NEVER:
        return True, 0
    hint = 0 if tag == "header" and in_article else HINTING.get(tag, 0)
    if not rest.strip() or tag in ("html", "body", "main"):
        return False, hint
    found = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(rest)}
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return True, 0
    if found.get("role", "").lower() in ROLES:
        return True, 0
    for name in f"{found.get('class', '')} {found.get('id', '')}".split():
        words = [w for w in re.split(r"[-_:]+|(?<=[a-z])(?=[A-Z])", name) if w]
        words = [w.lower() for w in words]
        if not words or KEEPING & set(words):
            continue
        if words[-1] in FURNITURE or (words[0] in FURNITURE and words[-1] not in CONTENT):
            if tag not in HEADINGS and not (words[-1] == "header" and in_article):
                hint = max(hint, COMPOUND if len(words) > 1 else TALKING if words[0] in TALK else NAMED)
    return False, hint


class _Hint:
    """An element whose names hint at page furniture, and what stands in it."""

    __slots__ = ("parent", "strength", "within", "unlinked", "article", "main", "dropped")

    def __init__(self, parent: _Hint | None, strength: int, within: bool):
        self.parent, self.strength, self.within, self.unlinked = parent, strength, within, 0
        self.article = self.main = self.dropped = False


def _settle(hints: list[_Hint], total: int, outside: bool) -> None:
    """Drop hinted elements, which are listed outer ones first, but not

    - one with <main>;
    - one that is or holds an <article>, if only a compound name hints or no other article stands ``outside`` of all hints;
    - one with most of the page's unlinked text, except where an article stands ``outside``: comments, and what a name of
      its own marks beside it.
    """
    for h in reversed(hints):
        if h.parent:
            h.parent.unlinked += h.unlinked
            h.parent.article |= h.article
            h.parent.main |= h.main
    for h in hints:
        held = h.main or (h.article and (h.strength == COMPOUND or not outside))
        most = 2 * h.unlinked > total and not (outside and (h.strength == TALKING or (h.strength == NAMED and not h.within)))
        h.dropped = bool(h.parent and h.parent.dropped) or not (held or most)


class _Element:
    __slots__ = ("tag", "path", "parent", "dropped", "hint", "link", "article")

    def __init__(self, tag: str, parent: _Element | None, dropped: bool):
        self.tag, self.parent = tag, parent
        block = tag in BLOCK
        up = parent.path if parent else ""
        self.path = f"{up}/{tag}" if block else up
        self.dropped = dropped or bool(parent and parent.dropped)
        self.hint: _Hint | None = parent.hint if parent else None
        self.link = tag == "a" or bool(parent and parent.link)
        self.article = tag in ("article", "main") or bool(parent and parent.article)


class _Node:
    """A block of text and the element it stands in."""

    __slots__ = ("text", "element", "linked")

    def __init__(self, text: str, element: _Element, linked: int):
        self.text, self.element, self.linked = text, element, linked

    @property
    def path(self) -> str:
        return self.element.path + ("/a" if 2 * self.linked > len(self.text) else "")


def text_nodes(page: str) -> list[_Node]:
    """The blocks of a page outside page furniture, in order, white space folded, references decoded."""
    found: list[tuple[list[tuple[str, _Element]], _Element]] = []
    hints: list[_Hint] = []
    total, outside = 0, False
    stack = [_Element("", None, False)]
    buffer: list[tuple[str, _Element]] = []

    def owner() -> _Element:
        e = stack[-1]
        while e.tag not in BLOCK and e.parent:
            e = e.parent
        return e

    def flush() -> None:
        if buffer:
            found.append((buffer.copy(), owner()))
            buffer.clear()

    def close(names: set[str] | frozenset[str], stop: set[str] | frozenset[str], inline_only: bool = False) -> None:
        for i in range(len(stack) - 1, 0, -1):
            tag = stack[i].tag
            if tag in names:
                if tag in BLOCK:
                    flush()
                del stack[i:]
                return
            if tag in stop or (inline_only and tag in BLOCK):
                return

    def end_open(tags: frozenset[str]) -> None:
        """End the outermost open element of these, if there is one."""
        for i in range(1, len(stack)):
            if stack[i].tag in tags:
                flush()
                del stack[i:]
                return

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.match(page, at)
        at = m.end()
        tag = m["tag"]
        if tag is None:
            piece = m[0]
            if piece.startswith("<![CDATA["):
                piece = html.escape(piece[9:].removesuffix("]]>"))
            elif len(piece) > 1 and piece[0] == "<":
                continue
            if stack[-1].tag == "head" and piece.strip():
                stack.pop()
            if not stack[-1].dropped:
                piece = html.unescape(piece) if "&" in piece else piece
                e = stack[-1]
                buffer.append((piece, e))
                if not e.link:
                    size = len(piece.strip())
                    total += size
                    if e.hint:
                        e.hint.unlinked += size
                    elif e.article and size:
                        outside = True
            continue
        tag = tag.lower()
        if m["end"]:
            if tag == "br":
                buffer.append((" ", stack[-1]))
            elif tag in BLOCK:
                close({tag}, frozenset())
            else:
                close({tag}, frozenset(), inline_only=True)
            continue
        if stack[-1].tag == "head" and tag not in IN_HEAD:
            stack.pop()
        if tag in ("article", "main"):
            end_open(BEFORE_CONTENT)
        if tag == "br":
            buffer.append((" ", stack[-1]))
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            if end is None:
                at = n
            else:
                stop = page.find(">", end.start())
                at = n if stop < 0 else stop + 1
            continue
        if tag in BLOCK:
            flush()
            if tag in SIBLINGS:
                close(*SIBLINGS[tag])
            elif tag not in ("html", "body"):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p":
                        del stack[i:]
                        break
                    if stack[i].tag in BLOCK:
                        break
        if tag not in VOID and not (m["rest"].endswith("/") and tag not in BLOCK):
            up = stack[-1]
            dropped, hint = _furniture(tag, m["rest"], up.article)
            e = _Element(tag, up, dropped)
            if hint and not e.dropped:
                e.hint = _Hint(up.hint, hint, up.article)
                hints.append(e.hint)
            if e.hint and not e.dropped and hint <= COMPOUND:
                e.hint.article |= tag == "article"
                e.hint.main |= tag == "main"
            stack.append(e)
    flush()
    _settle(hints, total, outside)
    nodes: list[_Node] = []
    for pieces, element in found:
        kept = [(piece, e) for piece, e in pieces if not (e.hint and e.hint.dropped)]
        text = " ".join("".join(piece for piece, _ in kept).split())
        if text:
            nodes.append(_Node(text, element, sum(len(piece.strip()) for piece, e in kept if e.link)))
    return nodes


def _path_values(nodes: list[_Node], radius: int = 1) -> dict[str, float]:
    """Per tag path the fused ratio of text and punctuation to nodes, after smoothing along the page."""
    sums: dict[str, list[float]] = {}
    for node in nodes:
        s = sums.setdefault(node.path, [0.0, 0.0, 0.0])
        s[0] += len(node.text) - node.linked
        s[1] += len(MARKS.findall(node.text))
        s[2] += 1
    ratios = np.array([[sums[x.path][0] / sums[x.path][2], sums[x.path][1] / sums[x.path][2]] for x in nodes])
    steps = np.arange(-radius, radius + 1)
    kernel = np.exp(-(steps**2) / (2 * (radius / 2) ** 2))
    kernel /= kernel.sum()
    padded = np.pad(ratios, ((radius, radius), (0, 0)), mode="edge")
    smooth = sum(k * padded[i : i + len(nodes)] for i, k in enumerate(kernel))
    fused = np.sqrt(np.maximum(smooth[:, 0], 0)) * np.log1p(1 + smooth[:, 1])
    out: dict[str, list[float]] = {}
    for node, value in zip(nodes, fused):
        out.setdefault(node.path, []).append(float(value))
    return {path: sum(v) / len(v) for path, v in out.items()}


def _chain(element: _Element | None) -> Iterator[_Element]:
    while element is not None:
        yield element
        element = element.parent


def select_nodes(nodes: list[_Node], share: float = 0.4, most: float = 0.75) -> list[_Node]:
    """The nodes of the article."""
    if not nodes:
        return []
    values = _path_values(nodes)
    weights = [len(x.text) for x in nodes]
    mean = sum(values[x.path] * w for x, w in zip(nodes, weights)) / sum(weights)
    content = {path for path, value in values.items() if value >= share * mean}
    carrying = [x for x in nodes if x.path in content] or nodes
    held: dict[int, int] = {}
    elements: dict[int, _Element] = {}
    for x in carrying:
        for e in _chain(x.element):
            held[id(e)] = held.get(id(e), 0) + len(x.text) * (2 if x.element.article else 1)
            elements[id(e)] = e
    total = sum(len(x.text) * (2 if x.element.article else 1) for x in carrying)
    depth = {k: sum(1 for _ in _chain(e)) for k, e in elements.items()}
    core = max((k for k, e in elements.items() if held[k] >= most * total and e.tag != "p"), key=lambda k: depth[k])
    around = list(_chain(elements[core]))
    for e in elements.values():
        if e.tag in ("article", "main") and not e.parent.article:
            up = {id(u) for u in _chain(e)}
            around = [u for u in around if id(u) in up]
    bounds = {id(around[0])}
    whole = {k for k, e in elements.items() if e.tag == "article"} or {k for k, e in elements.items() if e.tag == "main"}
    whole.add(core)
    inside = lambda x, ids: any(id(e) in ids for e in _chain(x.element))
    keep = [inside(x, bounds) and (x.path in content or (2 * x.linked <= len(x.text) and inside(x, whole))) for x in nodes]
    if True in keep and not any(k and x.element.tag == "h1" for k, x in zip(keep, nodes)):
        first = keep.index(True)
        keep[:first] = [x.element.tag == "h1" and x.element.article for x in nodes[:first]]
    return [x for k, x in zip(keep, nodes) if k]


def main_text(page: str | None) -> str:
    """The article's text: its blocks joined by one space."""
    return " ".join(x.text for x in select_nodes(text_nodes(page or "")))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for ``pages(page_id, url, html)``; one pass, no shuffle."""

    names = ["page_id", "url", "text", "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch["html"]]
            counts = [len(x) for x in texts]
            yield pa.RecordBatch.from_arrays([batch["page_id"].cast(pa.int64()), batch["url"], pa.array(texts, pa.string()), pa.array(counts, pa.int64())], names=names)

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
