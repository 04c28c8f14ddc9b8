"""Per-page markup parsing helper (runs inside Arrow-batched Spark tasks).

A small tolerant tree builder on the stdlib ``html.parser``: void elements,
implied end tags for p/li/tr/td/th/option, raw-text elements (handled by
the tokenizer), stray end tags ignored, unclosed tags closed at EOF.  In
XML mode (JATS) CDATA is text and no end tag is implied; tag names are
lower-cased in both.  Only the selectors the extractors need are implemented:
what an element inherits (headings, containers, the last caption-like sibling)
is noted when it opens, so that a page takes time in proportion to its length.
Elements and texts lie in two lists in page order, of which an element has a
stretch of each: what is in it is found without walking a tree.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html import unescape
from html.parser import HTMLParser

from .urls import resolve_url

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr", "keygen"}
_CLOSES_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset",
             "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
             "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
_RAW_TEXT = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
_CAPTION_SIBLINGS = {"p", "div", "h3", "h4", "span"}
# ECMAScript whitespace (Python's \\s also has U+001C-1F and U+0085)
_WS = re.compile("[\\t-\\r \\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]+")


def norm_ws(s: str | None) -> str:
    return _WS.sub(" ", s or "").strip(" ")


# A text and the tag or comment after it as most are written: the tokenizer makes the same of them, by more patterns.
_PLAIN = re.compile(r"""([^<&]*)<(?:(/?)([a-z][a-z0-9-]*)((?:\ [a-z][a-z:-]*="[^"&]*")*)|!--(?![->])[^-]*(?:-[^-]+)*--)>""")
_PLAIN_ATTRIBUTE = re.compile(r' ([a-z][a-z:-]*)="([^"]*)"')
_TAG_OPEN = re.compile("<[a-zA-Z]")


# What an element lies in, itself included
_H3, _ARTICLE, _SEARCH_RESULT = 1, 2, 4
_ARTICLE_H3 = _H3 | _ARTICLE
_INSIDE = {"h3": _H3, "article": _ARTICLE}
# Tags whose start ends something that is open
_CLOSERS = _CLOSES_P | {"li", "td", "th", "tr", "option", "a"}


class _Page:
    """A page's elements and texts in page order, and the places of the elements of each tag."""

    __slots__ = ("nodes", "texts", "places")

    def __init__(self):
        self.nodes, self.texts, self.places = [], [], {}


class Node:
    """An element: ``nodes[first:last]`` and ``texts[text_first:text_last]`` of its page are in it."""

    __slots__ = ("tag", "attrs", "page", "first", "last", "text_first", "text_last", "inside", "container", "last_caption",
                 "caption_before")

    def __init__(self, tag, attrs, parent, page):
        self.tag = tag
        self.attrs = attrs
        self.page = page
        self.last_caption = None
        self.text_first = self.text_last = len(page.texts)
        nodes = page.nodes
        if parent is None:
            self.first = self.last = len(nodes)
            self.inside = 0
            self.container = self.caption_before = None
            return
        at = len(nodes)
        places = page.places.get(tag)
        if places is None:
            page.places[tag] = [at]
        else:
            places.append(at)
        nodes.append(self)
        self.first = self.last = at + 1
        self.inside = parent.inside | _INSIDE.get(tag, 0)
        self.container = self if tag == "figure" else parent.container
        own = attrs.get("class") if attrs else None
        if own:
            if "search-result" in own.split():
                self.inside |= _SEARCH_RESULT
            if "table" in own:
                self.container = self
        self.caption_before = parent.last_caption
        if tag in _CAPTION_SIBLINGS:
            parent.last_caption = self

    def close(self):
        self.last, self.text_last = len(self.page.nodes), len(self.page.texts)

    def text(self) -> str:
        return "".join(self.page.texts[self.text_first:self.text_last])

    def iter(self, tag=None):
        """Descendants in document order (excluding self)."""
        nodes = self.page.nodes
        if tag is None:
            return iter(nodes[self.first:self.last])
        if isinstance(tag, (set, frozenset)):
            return (n for n in nodes[self.first:self.last] if n.tag in tag)
        places = self.page.places.get(tag, ())
        at = bisect_left(places, self.first)
        return (nodes[i] for i in places[at:bisect_left(places, self.last, at)])

    def find(self, tag):
        places = self.page.places.get(tag, ())
        at = bisect_left(places, self.first)
        return self.page.nodes[places[at]] if at < len(places) and places[at] < self.last else None

    def classes(self):
        return (self.attrs.get("class") or "").split()


class _Builder(HTMLParser):
    def __init__(self, xml: bool):
        super().__init__(convert_charrefs=True)
        self.xml = xml
        if not xml:
            self.CDATA_CONTENT_ELEMENTS = _RAW_TEXT
        self.page = _Page()
        self.root = Node("#root", {}, None, self.page)
        self.stack = [self.root]
        self.open = {}
        self.fresh = True

    def updatepos(self, i, j):
        """Lines aren't counted."""
        return j

    def goahead(self, end):
        """Plain tags by one pattern, others each by the tokenizer's own method; what it can't end, and the end of the page, is the tokenizer's."""
        if end or not self.fresh:
            return super().goahead(end)
        self.fresh = False
        rawdata, i = self.rawdata, 0
        page, stack, open_, raw_text = self.page, self.stack, self.open, self.CDATA_CONTENT_ELEMENTS
        nodes, texts, xml, plain = page.nodes, page.texts, self.xml, _PLAIN.match
        while True:
            if self.cdata_elem is None:
                m = plain(rawdata, i)
                if m is not None:
                    text, ends, tag, written = m.groups()
                    i = m.end()
                    if text:
                        texts.append(text)
                    if ends:
                        if written:  # attributes of an end tag aren't plain
                            i = m.start(2) - 1
                        else:
                            if stack[-1].tag == tag:
                                node = stack.pop()
                                open_[tag] -= 1
                                node.last, node.text_last = len(nodes), len(texts)
                            elif open_.get(tag):
                                self.handle_endtag(tag)
                            continue
                    elif tag is None:  # a comment
                        continue
                    else:
                        if not xml and tag in _CLOSERS:
                            self._close_before(tag)
                        node = Node(tag, self._attrs(_PLAIN_ATTRIBUTE.findall(written)) if written else {}, stack[-1], page)
                        if xml or tag not in _VOID:
                            stack.append(node)
                            open_[tag] = open_.get(tag, 0) + 1
                        if tag in raw_text:
                            self.set_cdata_mode(tag)
                        continue
                else:
                    j = rawdata.find("<", i)
                    if j < 0:
                        break
                    if i < j:
                        self.handle_data(unescape(rawdata[i:j]))
                    i = j
            else:
                found = self.interesting.search(rawdata, i)
                if found is None:
                    break
                if i < found.start():
                    self.handle_data(rawdata[i:found.start()])
                i = found.start()
            if _TAG_OPEN.match(rawdata, i):
                k = self.parse_starttag(i)
            elif rawdata.startswith("</", i):
                k = self.parse_endtag(i)
            elif rawdata.startswith("<!--", i):
                k = self.parse_comment(i)
            elif rawdata.startswith("<?", i):
                k = self.parse_pi(i)
            elif rawdata.startswith("<!", i):
                k = self.parse_html_declaration(i)
            else:
                k = -1
            if k < 0:
                break
            i = k
        self.rawdata = rawdata[i:]
        return super().goahead(end)

    def unknown_decl(self, data):
        if self.xml and data.startswith("CDATA["):
            self.handle_data(data[6:])

    def _pop_to(self, i):
        for n in self.stack[i:]:
            self.open[n.tag] -= 1
            n.close()
        del self.stack[i:]

    def _attrs(self, attrs):
        if len(attrs) == 1:
            (k, v), = attrs
            return {k: "" if v is None else v}
        d = {}
        for k, v in attrs:
            if k not in d:
                d[k] = "" if v is None else v
        return d

    def _close_until(self, tags, stop=()):
        for t in tags:
            if self.open.get(t):
                break
        else:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            t = self.stack[i].tag
            if t in tags:
                self._pop_to(i)
                return
            if t in stop:
                return

    def _close_before(self, tag):
        if tag in _CLOSES_P:
            self._close_until({"p"}, stop={"button", "table", "td", "th", "li"})
        if tag == "li":
            self._close_until({"li"}, stop={"ul", "ol"})
        elif tag in ("td", "th"):
            self._close_until({"td", "th"}, stop={"tr", "table"})
        elif tag == "tr":
            self._close_until({"tr"}, stop={"table"})
        elif tag == "option":
            self._close_until({"option"}, stop={"select"})
        elif tag == "a":
            self._close_until({"a"}, stop={"table", "td", "th"})

    def handle_starttag(self, tag, attrs):
        if not self.xml and tag in _CLOSERS:
            self._close_before(tag)
        node = Node(tag, self._attrs(attrs), self.stack[-1], self.page)
        if self.xml or tag not in _VOID:
            self.stack.append(node)
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        Node(tag, self._attrs(attrs), self.stack[-1], self.page)

    def handle_endtag(self, tag):
        if not self.open.get(tag):  # nothing open by that name
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                self._pop_to(i)
                return

    def handle_data(self, data):
        self.page.texts.append(data)


def forget(root: Node) -> None:
    """Frees a page that has been read: its elements refer to each other through it."""
    root.page.nodes.clear()


def parse(markup: str | None, xml: bool = False) -> Node:
    b = _Builder(xml)
    try:
        b.feed(markup or "")
        b.close()
    except Exception:  # noqa: BLE001 - lenient like a browser parser
        pass
    for n in b.stack:
        n.close()
    return b.root


# -- extractors --------------------------------------------------------------

def grid_of(table: Node) -> list[list[str]]:
    """Every descendant tr (nested tables included), cells th/td; empty rows skipped."""
    grid = []
    for tr in table.iter("tr"):
        cells = [norm_ws(c.text()) for c in tr.iter({"th", "td"})]
        if cells:
            grid.append(cells)
    return grid


def _table_caption(table: Node, max_prev: int | None) -> str:
    cap = table.find("caption")
    inner = norm_ws(cap.text()) if cap is not None else ""
    if inner:
        return inner
    if table.container is not None:
        for n in table.container.iter():
            if n.tag == "figcaption" or any(c in ("caption", "table-caption", "title") for c in n.classes()):
                t = norm_ws(n.text())
                if t:
                    return t
                break
    before = table.caption_before
    return norm_ws(before.text())[:max_prev] if before is not None else ""


def html_tables(root: Node, max_prev: int | None = None):
    return [{"dom_index": i, "grid": grid_of(t), "caption": _table_caption(t, max_prev), "source": "html_table"}
            for i, t in enumerate(root.iter("table"))]


def jats_tables(root: Node):
    out = []
    for i, w in enumerate(root.iter("table-wrap")):
        t = w.find("table")
        label = w.find("label")
        cap = w.find("caption")
        parts = [norm_ws(label.text()) if label is not None else "", norm_ws(cap.text()) if cap is not None else ""]
        out.append({"dom_index": i, "grid": grid_of(t) if t is not None else [],
                    "caption": " ".join(p for p in parts if p), "source": "jats_table"})
    return out


def jats_figures(root: Node):
    out = []
    for f in root.iter("fig"):
        label = f.find("label")
        cap = f.find("caption")
        g = f.find("graphic")
        href = ""
        if g is not None:
            href = g.attrs.get("xlink:href") or g.attrs.get("href") or ""
        parts = [norm_ws(label.text()) if label is not None else "", norm_ws(cap.text()) if cap is not None else ""]
        out.append({"caption": " ".join(p for p in parts if p), "graphic": href})
    return out


def html_figures(root: Node, base: str | None):
    out = []
    for f in root.iter("figure"):
        fc = f.find("figcaption")
        caption = norm_ws(fc.text()) if fc is not None else ""
        img = f.find("img")
        raw = ""
        if img is not None:
            raw = img.attrs.get("src") or img.attrs.get("data-src") or ""
        if not caption and not raw:
            continue
        url = (resolve_url(raw, base) or "") if raw else ""
        out.append({"caption": caption, "graphic": "", "image_url": url})
    return out


def anchors(root: Node, base: str | None):
    """``a[href]`` and ``ext-link`` in document order with context flags."""
    out = []
    for n in root.iter({"a", "ext-link"}):
        if n.tag == "a" and "href" not in n.attrs:
            continue
        raw = n.attrs.get("href") or n.attrs.get("xlink:href") or ""
        raw_text = n.text()
        out.append({
            "ord": len(out), "tag": n.tag, "raw_href": raw, "raw_text": raw_text,
            "text": norm_ws(raw_text), "aria_label": n.attrs.get("aria-label") or "",
            "title_attr": n.attrs.get("title") or "", "in_article_h3": n.inside & _ARTICLE_H3 == _ARTICLE_H3,
            "track_action": n.attrs.get("data-track-action") or "",
            "in_search_result": n.inside & _SEARCH_RESULT != 0,
            "url": resolve_url(raw, base) if (raw or n.tag == "a") else None,
        })
    return out


def body_text(root: Node) -> str:
    b = root.find("body")
    return (b if b is not None else root).text()
