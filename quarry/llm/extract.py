"""HTML extraction (operator 7): boosted trees over DOM nodes, decoded hierarchically.

A page's block elements are scored by gradient-boosted trees from subtree density, attribute tokens of
the element and its ancestors, depth and sibling statistics. Decoding picks, for the whole tree, the
most probable choice in which nothing below a dropped element is kept.

The trees are learnt from at most ``MOST_PAGES`` pages, those with the least hashes, that mark their
article (``article`` or ``main``): the mark is the label. As real pages mark it in many ways or not at
all, each also serves with its mark renamed or removed, and with menus, notices, sidebars, forms,
adverts and reader comments added around and inside the article, and with some of its paragraphs as
lists, quotes, headings, tables or plain boxes. Text that stands directly in html or body makes blocks
of its own, which are judged like others; for that, pages also serve with their article there, as text
with line breaks or in inline elements, with bare menus and notices around it, and without any tag.

Defined cases: where no page of the table marks its article, or labels are all of one kind, no trees
are learnt, and elements named as something else go with what is in them, while all else stays, also
unnamed menus and link lists (``fallback_odds``); a null or empty page has no text; markup that is broken off or not closed is read as
far as it goes; a null ``page_id`` or ``url`` stays null; repeated rows are extracted each; an empty
table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import chunks, rows_of, small_batches
from quarry.llm.dom import GROUPS, Page
from quarry.llm.dom import LABEL as _LABEL
from quarry.llm.trees import Boosted, boost

MOST_PAGES = 300
_OPENED = re.compile(r"<(article|main)\b", re.I)
_CLOSED = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("article", "main")}
_NOT_MAIN = [g for g in GROUPS if g not in ("main", "share")]


def _boilerplate(rng: random.Random, words: list[str]) -> str:
    """An element that is not the article, of a random kind, with words of the page."""
    kind = rng.choice(_NOT_MAIN)
    token = rng.choice(sorted(GROUPS[kind]))
    tag = rng.choice({"menu": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "side": ["aside", "div", "section"], "form": ["form", "div"]}.get(kind, ["div", "section"]))
    some = lambda n: " ".join(rng.choices(words, k=n))
    item = lambda: rng.choice(["<p>{}</p>", "<div>{}</div>", "<li>{}</li>", "<a href='#'>{}</a>", "<p><a href='#'>{}</a></p>", "{}"]).format(some(rng.choice([1, 2, 4, 12, 40])))
    named = "" if tag in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.5 else f' {rng.choice(["class", "id"])}="{rng.choice(["", "site-", "page-", "js-"])}{token}{rng.choice(["", "-box", "-list", " wide"])}"'
    return f"<{tag}{named}>{''.join(item() for _ in range(rng.choice([1, 1, 3, 6])))}</{tag}>"


def _dressed(rng: random.Random, inside: str) -> str:
    """An article whose paragraphs are partly lists, quotes, headings, tables and plain boxes."""

    def other(found: re.Match) -> str:
        text = found[1]
        if rng.random() < 0.6:
            return found[0]
        words = text.split()
        half = len(words) // 2
        a, b = " ".join(words[:half]), " ".join(words[half:])
        return rng.choice([
            f"<ul><li>{a}</li><li>{b}</li></ul>", f"<ol><li>{a}</li><li>{b}</li></ol>", f"<blockquote><p>{text}</p></blockquote>",
            f"<h2>{' '.join(words[:6])}</h2><p>{' '.join(words[6:])}</p>", f"<div>{text}</div>", f"<section><h3>{' '.join(words[:4])}</h3><p>{' '.join(words[4:])}</p></section>",
            f"<table><tr><th>{a}</th><td>{b}</td></tr></table>", f"<pre>{text}</pre>", f"<figure><img src='x'><figcaption>{text}</figcaption></figure>",
            f"<dl><dt>{a}</dt><dd>{b}</dd></dl>", text,
        ])

    return re.sub(r"<p>([^<]*)</p>", other, inside)


def marked_article(html: str) -> tuple[str, str, str, str] | None:
    """Tag, what stands before, inside and after the first article or main element that is closed; linear."""
    at, missing = 0, set()
    while (opened := _OPENED.search(html, at)) and len(missing) < len(_CLOSED):
        name = opened[1].lower()
        if (start := html.find(">", opened.end()) + 1) == 0:
            return None
        if name not in missing:
            if closed := _CLOSED[name].search(html, start):
                return opened[1], html[: opened.start()], html[start : closed.start()], html[closed.end() :]
            missing.add(name)
        at = opened.end()
    return None


def training_pages(html: str, rng: random.Random) -> list[str]:
    """The page with its article labelled, and changed copies of it."""
    found = marked_article(html)
    if found is None:
        return []
    tag, before, inside, after = found
    words = re.sub(r"<[^<>]*>", " ", inside).split()[:400] or ["text"]
    out = [f'{before}<{tag} class="{_LABEL}">{inside}</{tag}>{after}']
    for _ in range(3):
        name = rng.choice(["article", "main", "div", "div", "section"])
        token = rng.choice(sorted(GROUPS["main"])) if rng.random() < 0.7 else ""
        junk = lambda n: "".join(_boilerplate(rng, words) for _ in range(rng.randrange(n)))
        first, last = (before, after) if rng.random() < 0.5 else ("<html><body>", "</body></html>")
        body = f'<{name} class="{_LABEL} {token}">{_dressed(rng, inside)}{junk(2)}</{name}>'
        wrap = rng.choice(["{}", "<div>{}</div>", "<div class='wrap'><div>{}</div></div>"])
        out.append(f"{first}{junk(4)}{wrap.format(junk(2) + body + junk(3))}{junk(3)}{last}")
    return out + bare_pages(inside, rng, words)


def _bare_junk(rng: random.Random, words: list[str]) -> str:
    """What isn't the article, directly in the body: links, or a short named or plain notice; a block ends it."""
    some = lambda n: " ".join(rng.choices(words, k=n))
    links = rng.choice([" ", " | ", "<br>", " - "]).join(f"<a href='#'>{some(rng.choice([1, 2, 3]))}</a>" for _ in range(rng.choice([2, 4, 8])))
    token = rng.choice(sorted(GROUPS[rng.choice(_NOT_MAIN)]))
    named = f'<{(tag := rng.choice(["span", "b", "font", "x-box"]))} {rng.choice(["class", "id"])}="{token}">{some(rng.choice([2, 6, 20]))}</{tag}>'
    return rng.choice([links, links, named]) + "<hr>"


def bare_pages(inside: str, rng: random.Random, words: list[str]) -> list[str]:
    """Pages whose article stands in the body without a block around it, and one of text alone.

    The label is an inline element around each run of text, whose names its block takes.
    """
    blocks = [t for t in (" ".join(re.sub(r"<[^>]*>", " ", b).split()) for b in re.split(r"(?i)</?(?:p|h\d|div|li|ul|ol|section|table|tr|td|blockquote)\b[^>]*>", inside)) if t] or ["text"]
    inline = rng.choice(["span", "font", "b", "x-text"])
    label = lambda t: f'<{inline} class="{_LABEL}">{t}</{inline}>'
    mixed = "".join(rng.choice([label(t), f'<p class="{_LABEL}">{t}</p>', f'<p class="{_LABEL}">{t}</p>']) for t in blocks)
    junk = lambda n: "".join(rng.choice([_bare_junk, _boilerplate])(rng, words) for _ in range(rng.randrange(n)))
    broken = rng.choice(["<br>", "<br><br>"]).join(label(t) for t in blocks)
    few = " ".join(blocks[0].split()[: rng.choice([3, 8, 20, 80])])
    return [f"<html><body>{junk(4)}{body}<hr>{junk(4)}</body></html>" for body in (broken, mixed)] + [label(rng.choice([few, " ".join(blocks)]))]


def labelled(html: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a training page's elements; elements above the article have none."""
    page = Page(html)
    inside, off = np.zeros(len(page.tag), dtype=bool), np.zeros(len(page.tag), dtype=bool)
    above = np.zeros(len(page.tag), dtype=bool)
    for k, tokens in enumerate(page.tokens):
        p = page.parent[k]
        if _LABEL in tokens:
            tokens.discard(_LABEL)
            inside[k] = True
            while p >= 0:
                above[p] = True
                p = page.parent[p]
        elif p >= 0:
            inside[k] = inside[p]
            off[k] = off[p] or inside[p] and _is_junk(page, k)
    y = inside & ~off
    return page.features()[~above], y[~above].astype(float)


def _is_junk(page: Page, k: int) -> bool:
    return page.tag[k] in ("nav", "header", "footer", "aside", "form") or any(not GROUPS[g].isdisjoint(page.tokens[k]) for g in _NOT_MAIN)


def decode(page: Page, odds: np.ndarray) -> np.ndarray:
    """Kept elements: the best choice in which no element below a dropped one is kept.

    An element without text of its own adds little weight, so that its children decide.
    """
    n = len(page.tag)
    own = np.full(n, 0.2)
    for k, text in page.runs:
        own[k] += np.log1p(len(text))
    odds = np.clip(odds, -6, 6)
    open_, parent = own * odds, page.parent  # open_: gain of keeping an element over dropping all of it
    open_[np.array([t in ("html", "body") for t in page.tag])] = 0.0
    for k in range(n - 1, 0, -1):
        if open_[k] > 0:
            open_[parent[k]] += open_[k]
    kept = np.zeros(n, dtype=bool)
    for k in range(n):
        kept[k] = open_[k] > 0 and (k == 0 or kept[parent[k]])
    return kept


def main_text(page: Page, odds: np.ndarray) -> str:
    kept = decode(page, odds)
    return "\n\n".join(text for k, text in page.runs if kept[k])


def fit(pages: DataFrame, most_pages: int = MOST_PAGES) -> Boosted | None:
    """Learn from the bounded sample; a task of its own makes the features."""
    spark = pages.sparkSession
    small_batches(spark)
    marked = pages.select("html", F.xxhash64("html").alias("h")).filter(F.col("html").rlike("(?is)<(article|main)\\b[^>]*>.*</(article|main)\\s*>"))
    # hashes are compared first and only the chosen pages move; copies of a page count once
    chosen = F.broadcast(marked.groupBy("h").agg(F.lit(1)).select("h").orderBy("h").limit(most_pages))
    some = marked.join(chosen, "h", "left_semi").groupBy("h").agg(F.first("html").alias("html")).select("html")

    def run(batches):
        def out():
            for (html,) in rows_of(batches, "html"):
                for changed in training_pages(html, random.Random(html)):
                    x, y = labelled(changed)
                    yield x.astype("<f4").tobytes(), y.astype("<f4").tobytes()

        yield from chunks(out(), pa.schema([("x", pa.binary()), ("y", pa.binary())]))

    rows = sorted((bytes(r["x"]), bytes(r["y"])) for r in some.mapInArrow(run, "x binary, y binary").collect())
    if not rows:
        return None
    y = np.concatenate([np.frombuffer(b, "<f4") for _, b in rows]).astype(float)
    x = np.concatenate([np.frombuffer(a, "<f4") for a, _ in rows]).reshape(len(y), -1)
    return boost(x, y) if 0 < y.sum() < len(y) else None


def fallback_odds(page: Page) -> np.ndarray:
    """Where nothing could be learnt: elements named as something else go, the rest stays."""
    odds = np.ones(len(page.tag))
    for k in range(1, len(odds)):
        odds[k] = -5.0 if odds[page.parent[k]] < 0 or _is_junk(page, k) else 1.0
    return odds


def extract(pages: DataFrame, model: Boosted | None) -> DataFrame:
    """(page_id, url, text, n_chars) per page."""
    spark = pages.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def texts(htmls):
        parsed = [Page(h or "") for h in htmls]
        if sent.value is None:
            return [main_text(p, fallback_odds(p)) for p in parsed]
        odds = sent.value.log_odds(np.concatenate([p.features() for p in parsed])) if parsed else []
        ends = np.cumsum([len(p.tag) for p in parsed])
        return [main_text(p, odds[e - len(p.tag) : e]) for p, e in zip(parsed, ends, strict=True)]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                out = texts(part.column("html").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])

    found = pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
