"""A page's block elements, their text runs and their features (helper of operator 7).

Text that stands in no element inside html or body, but for inline ones, makes a block of its own
(tag ``BARE``) from one block's edge to the next, with the names of the inline elements around all of it.

Nothing inside an element of ``QUIET`` is main text. Where its end tag is missing, it ends with its
parent and only its label, the text up to the next block or line break, isn't main text.
"""

from __future__ import annotations

import html as _html
import re

import numpy as np

#: Element kinds of HTML.
BLOCKS = set("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Their text ends at their end tag only, whatever stands before it.
RAW = set("script style textarea title iframe".split())
QUIET = set("noscript template svg object select button".split())
#: Blocks whose direct text makes blocks of its own, and the tag of those.
ROOTS, BARE = {"html", "body"}, "#text"
CLOSES_P = BLOCKS - {"html", "body", "tbody", "td", "tfoot", "th", "thead", "tr"}
#: A start tag closes an open element of the second set, up to one of the third.
CLOSERS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}

_OPENS = re.compile(r"<(?:(!--)|([!?])|/?[a-zA-Z])")
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>")
#: A tag where quotes don't pair up any more.
_UNPAIRED = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")


def marks(html: str):
    """(start, end, closing slash, tag, attributes) of each tag; comments and declarations have tag ''.

    Linear: from the first tag whose quotes never pair up, tags end at the next ``>``; without one, what
    follows is text.
    """
    at, paired, n = 0, True, len(html)
    while mark := _OPENS.search(html, at):
        start = mark.start()
        if mark[1] or mark[2]:
            end = html.find("-->" if mark[1] else ">", mark.end())
            at = n if end < 0 else end + (3 if mark[1] else 1)
            at = (yield start, at, "", "", "") or at
            continue
        tag = _TAG.match(html, start) if paired else None
        if tag is None:
            paired = False
            if (tag := _UNPAIRED.match(html, start)) is None:
                return
        at = (yield start, tag.end(), tag[1], tag[2].lower(), tag[3]) or tag.end()


_ATTRIBUTE = re.compile(r"""(?:class|id|role|itemprop|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_TOKEN = re.compile(r"[a-z]+")

#: Attribute tokens and tags that tell what an element is for.
GROUPS: dict[str, set[str]] = {
    "main": set("article content main post entry story body text maintext articlebody hentry".split()),
    "menu": set("nav navigation navbar menu menubar breadcrumb breadcrumbs pagination pager toolbar tabs toc sitemap".split()),
    "header": set("header masthead banner topbar logo branding".split()),
    "footer": set("footer foot copyright colophon legal imprint".split()),
    "side": set("aside sidebar side rail widget complementary related recommended popular trending more".split()),
    "notice": set("cookie cookies consent gdpr notice alert popup modal overlay dialog privacy".split()),
    "advert": set("ad ads advert advertisement adsense sponsor sponsored promo promotion banner outbrain taboola".split()),
    "form": set("form search login signup subscribe newsletter contact input".split()),
    "comment": set("comment comments reply replies disqus discussion respond feedback".split()),
    "share": set("share sharing social follow tags meta byline author".split()),
}
#: An attribute by which the labels of training pages survive the changes made to them.
LABEL = "zqlabel"
#: Names that bare text takes from inline elements.
_KNOWN = frozenset().union({LABEL}, *GROUPS.values())
_TAGS = {"article": "main", "main": "main", "nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "side", "form": "form", "dialog": "notice", "fieldset": "form"}
_KINDS = ["p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "div", "section", "td", "table", "blockquote", "pre", BARE]


def _names(attributes: str) -> set[str]:
    return {t for a in _ATTRIBUTE.findall(attributes) for t in _TOKEN.findall(a.lower())}


class Page:
    """Block elements in page order (a parent before its children) and text runs."""

    def __init__(self, html: str):
        unclosed = self._read(html, frozenset())
        if unclosed:  # once more, as which end tags are missing is known at the end only
            self._read(html, unclosed)

    def _read(self, html: str, unclosed: frozenset[int]) -> frozenset[int]:
        """Read the page; gives the places of QUIET elements without an end tag, besides ``unclosed``."""
        self.tag, self.parent, self.tokens = ["html"], [-1], [set()]
        self.links, self.link_chars, self.marks = [0], [0], [0]
        self.runs: list[tuple[int, str]] = []
        stack = [(0, "html", frozenset())]  # open elements: (block element they belong to, tag, known names if inline in a root)
        held: list[str] = []
        bare, named = -1, False  # the open block of bare text; whether it has names yet
        in_link = 0
        open_of: dict[str, int] = {}
        quiet: list[int] = []  # places of open QUIET elements
        label = False  # inside the label of an unclosed one
        missing: set[int] = set()

        def add(tag, parent, tokens):
            self.tag.append(tag)
            self.parent.append(parent)
            self.tokens.append(tokens)
            for x in (self.links, self.link_chars, self.marks):
                x.append(0)
            return len(self.tag) - 1

        def home():
            """The block that text belongs to here."""
            nonlocal bare
            block = stack[-1][0]
            if self.tag[block] not in ROOTS:
                return block
            if bare < 0:
                bare = add(BARE, block, set())
            return bare

        def flush():
            nonlocal bare, named, label
            label = False
            if held:
                text = " ".join("".join(held).split())
                held.clear()
                if text:
                    self.runs.append((home(), text))
            bare, named = -1, False

        def pop(ended=False):
            nonlocal in_link
            if stack[-1][1] in BLOCKS and not quiet:
                flush()
            tag = stack.pop()[1]
            open_of[tag] -= 1
            in_link -= tag == "a"
            if tag in QUIET:
                at = quiet.pop()
                if not ended:
                    missing.add(at)

        def close(tags, until=(), ended=False):
            """Close up to the innermost of ``tags``, unless one of ``until`` stands inside it."""
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][1] in tags:
                    while len(stack) > k + 1:
                        pop()
                    pop(ended)
                    return
                if stack[k][1] in until:
                    return

        def put(text):
            nonlocal named
            if text and not quiet and not label:
                if self.tag[stack[-1][0]] in ROOTS and not text.isspace():
                    k = home()
                    self.tokens[k] = self.tokens[k] & stack[-1][2] if named else set(stack[-1][2])
                    named = True
                held.append(_html.unescape(text) if "&" in text else text)
                if in_link and (bare >= 0 or self.tag[stack[-1][0]] not in ROOTS):
                    self.link_chars[home()] += len(text)

        at, n = 0, len(html)
        found = marks(html)
        go_on = None  # where the next mark is looked for, if not after the last
        while True:
            try:
                start, end, slash, tag, attributes = found.send(go_on)
            except StopIteration:
                break
            go_on = None
            put(html[at:start])
            at = end
            if not tag:
                continue
            if slash:
                if open_of.get(tag):
                    close({tag}, ended=True)
                elif tag == "p" and not quiet:
                    flush()
                continue
            if tag in RAW:
                if not attributes.rstrip().endswith("/"):
                    closer = re.compile(f"</{re.escape(tag)}", re.I).search(html, at)
                    at = go_on = html.find(">", closer.end()) + 1 or n if closer else n
                continue
            if tag in QUIET:
                if start in unclosed:
                    label = label or not quiet
                elif not attributes.rstrip().endswith("/"):
                    stack.append((stack[-1][0], tag, stack[-1][2]))
                    open_of[tag] = open_of.get(tag, 0) + 1
                    quiet.append(start)
                continue
            if tag == "br":
                held.append(" ")
                label = label and bool(quiet)
                continue
            if tag in CLOSES_P and open_of.get("p"):
                close({"p"}, QUIET | {"table"})
            if tag in CLOSERS and any(open_of.get(t) for t in CLOSERS[tag][0]):
                for _ in range(len(CLOSERS[tag][0])):
                    close(CLOSERS[tag][0], QUIET | CLOSERS[tag][1])
            if quiet:
                if tag not in VOID and not attributes.endswith("/"):
                    stack.append((stack[-1][0], tag, stack[-1][2]))
                    open_of[tag] = open_of.get(tag, 0) + 1
                    in_link += tag == "a"
                continue
            block, names = stack[-1][0], frozenset()
            self.marks[block] += 1
            if tag in BLOCKS:
                flush()
                block = add(tag, block, _names(attributes))
            elif self.tag[block] in ROOTS:
                names = stack[-1][2] | _KNOWN.intersection(_names(attributes).union(_TOKEN.findall(tag)))
                if tag == "a":
                    self.links[home()] += 1
                if bare >= 0:
                    self.marks[bare] += 1
            elif tag == "a":
                self.links[block] += 1
            if tag not in VOID and not attributes.endswith("/"):
                stack.append((block, tag, names))
                open_of[tag] = open_of.get(tag, 0) + 1
                in_link += tag == "a"
        put(html[at:])
        while len(stack) > 1:
            pop()
        flush()
        return frozenset(missing)

    def features(self) -> np.ndarray:
        """(elements, features): own and inherited kind, subtree density, depth and siblings."""
        n = len(self.tag)
        parent = np.array(self.parent)
        chars, stops, runs = np.zeros(n), np.zeros(n), np.zeros(n)
        for k, text in self.runs:
            chars[k] += len(text)
            stops[k] += text.count(".") + text.count(",")
            runs[k] += 1
        own = chars.copy()
        links, link_chars, marks = (np.array(x, dtype=float) for x in (self.links, self.link_chars, self.marks))
        paragraphs = np.array([t == "p" for t in self.tag], dtype=float)
        size = np.ones(n)
        sums = [chars, stops, runs, links, link_chars, marks, paragraphs, size]
        for k in range(n - 1, 0, -1):
            for s in sums:
                s[parent[k]] += s[k]
        names = list(GROUPS)
        said = np.zeros((n, len(names)))
        depth, index, children = np.zeros(n), np.zeros(n), np.zeros(n)
        above = np.zeros((n, len(names)))
        for k in range(n):
            for j, name in enumerate(names):
                said[k, j] = _TAGS.get(self.tag[k]) == name or not GROUPS[name].isdisjoint(self.tokens[k])
            if k:
                p = parent[k]
                depth[k] = depth[p] + 1
                index[k] = children[p]
                children[p] += 1
                above[k] = np.maximum(above[p], said[p])
        up = np.maximum(parent, 0)
        rows = [
            np.log1p(chars), np.log1p(own), link_chars / (chars + 1), links / (size + 1), stops / (chars + 1) * 50, chars / (marks + size), np.log1p(paragraphs),
            np.log1p(runs), depth, index, index / np.maximum(children[up], 1), children, children[up], chars / (chars[up] + 1), chars / (chars[0] + 1), np.minimum(depth, 3), np.log1p(chars[up]), link_chars[up] / (chars[up] + 1),
        ]
        kind = np.array([[t == x for x in _KINDS] for t in self.tag], dtype=float)
        return np.column_stack([*rows, kind, said, above]).astype(np.float32)
