"""One distributed parse pass per page, then DataFrame algebra.

``parse_pages`` runs the stdlib tree builder inside ``mapInArrow`` (Arrow
batches, no per-row Python UDF, nothing through the driver) and returns ONE
struct per page — ``{n_tables, blocked, tables[], figures[], anchors[]}`` —
so each page is parsed once.  Everything after it (filters, numbering,
first-wins de-dup, long-form cells) is built-in array/generator algebra on
that struct: no shuffle, and each page's work stays in its own task.

Scale: pages are independent, and Arrow batches are kept to a few hundred
pages so that a batch of multi-MB bodies fits in memory.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions import text as X
from ..functions.urls import beyond_ascii_host, resolve_href
from ..session import ship_package, small_batches

TABLE_T = T.StructType([
    T.StructField("dom_index", T.IntegerType()),
    T.StructField("grid", T.ArrayType(T.ArrayType(T.StringType()))),
    T.StructField("caption", T.StringType()),
    T.StructField("source", T.StringType()),
])
FIGURE_T = T.StructType([
    T.StructField("caption", T.StringType()),
    T.StructField("graphic", T.StringType()),
    T.StructField("image_url", T.StringType()),
])
ANCHOR_T = T.StructType([
    T.StructField("ord", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("raw_href", T.StringType()),
    T.StructField("raw_text", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("aria_label", T.StringType()),
    T.StructField("title_attr", T.StringType()),
    T.StructField("in_article_h3", T.BooleanType()),
    T.StructField("track_action", T.StringType()),
    T.StructField("in_search_result", T.BooleanType()),
    T.StructField("url", T.StringType()),
])
PARSED_T = T.StructType([
    T.StructField("n_tables", T.IntegerType()),
    T.StructField("blocked", T.BooleanType()),
    T.StructField("tables", T.ArrayType(TABLE_T)),
    T.StructField("figures", T.ArrayType(FIGURE_T)),
    T.StructField("anchors", T.ArrayType(ANCHOR_T)),
])


def _arrow_type(dt):
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(dt)


def _list_array(lists: list[list[dict]], kind: pa.DataType) -> pa.Array:
    """Lists of structs as an Arrow array, built field by field."""
    ends = [0]
    for one in lists:
        ends.append(ends[-1] + len(one))
    rows = [r for one in lists for r in one]
    fields = [pa.array([r[f.name] for r in rows], f.type) for f in kind.value_type]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(kind.value_type))).cast(kind)


def parse_pages(df: DataFrame, body: str = "html", base: str | None = "url", xml: bool | str = False,
                keep: list[str] | None = None, pmcid: str | None = None,
                max_prev_caption: int | None = None) -> DataFrame:
    """Parse every page once: ``keep`` columns + ``parsed`` (PARSED_T).

    ``xml`` may be a bool or the name of a boolean column (JATS vs HTML per
    row).  Base URLs resolve relative hrefs/srcs; ``pmcid`` (JATS) only
    rides along for the image URL built later.
    """
    keep = list(keep if keep is not None else [c for c in df.columns if c != body])
    small_batches(df.sparkSession)
    ship_package(df.sparkSession)
    xml_col = xml if isinstance(xml, str) else None
    src = df.select(*keep, F.col(body).alias("_body"),
                    (F.col(base) if base else F.lit(None).cast("string")).alias("_base"),
                    (F.col(xml_col) if xml_col else F.lit(bool(xml))).alias("_xml"))
    out_schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("parsed", PARSED_T)])
    parsed_arrow = _arrow_type(PARSED_T)
    n_keep = len(keep)

    def run(batches):
        from quarry.functions import markup as M
        from quarry.functions import constants as KC
        for b in batches:
            bodies = b.column(n_keep).to_pylist()
            bases = b.column(n_keep + 1).to_pylist()
            xmls = b.column(n_keep + 2).to_pylist()
            n_tables, blocked, all_tables, all_figures, all_anchors = [], [], [], [], []
            for html, url, is_xml in zip(bodies, bases, xmls):
                root = M.parse(html, bool(is_xml))
                if is_xml:
                    all_tables.append(M.jats_tables(root))
                    all_figures.append([dict(f, image_url="") for f in M.jats_figures(root)])
                else:
                    all_tables.append(M.html_tables(root, max_prev_caption))
                    all_figures.append(M.html_figures(root, url))
                all_anchors.append(M.anchors(root, url))
                text = M.body_text(root).lower()
                n_tables.append(sum(1 for _ in root.iter("table")))
                blocked.append(any(m in text for m in KC.BLOCK_TEXT_MARKERS))
                M.forget(root)
            lists = [_list_array(x, parsed_arrow.field(i).type) for i, x in enumerate((all_tables, all_figures, all_anchors), 2)]
            parsed = pa.StructArray.from_arrays([pa.array(n_tables, pa.int32()), pa.array(blocked, pa.bool_()), *lists], fields=list(parsed_arrow))
            cols = [b.column(i) for i in range(n_keep)] + [parsed]
            yield pa.RecordBatch.from_arrays(cols, names=keep + ["parsed"])

    return src.mapInArrow(run, out_schema)


# -- generic array helpers (no shuffle) -----------------------------------------------

def first_by(arr: Column, key: str, ord_field: str = "ord") -> Column:
    """W05/W07 inside one row: keep the first element per ``key`` (by ``ord``), ord order kept.

    O(n log n): sort by (key, ord), keep an element whose predecessor has a
    different key, re-sort by ord.
    """
    keyed = F.sort_array(F.transform(arr, lambda x: F.struct(x[key].alias("k"), x[ord_field].alias("o"),
                                                               x.alias("v"))))
    firsts = F.transform(F.array(keyed), lambda s: F.filter(
        s, lambda x, i: (i == 0) | (F.get(s, i - 1)["k"] != x["k"])))[0]
    return F.transform(F.sort_array(F.transform(firsts, lambda x: F.struct(x["o"].alias("o"), x["v"].alias("v")))),
                       lambda x: x["v"])


# -- X01 / N06 ------------------------------------------------------------------------

def extract_anchors(parsed: DataFrame, ids: list[str]) -> DataFrame:
    """One row per ``a[href]`` in document order."""
    return parsed.select(*ids, F.inline(F.filter("parsed.anchors", lambda a: a["tag"] == "a")))


_SEL_ATTR = re.compile(r"^a\[(href|data-track-action)(\*?=)'([^']*)'\]$")


def _selector_pred(sel: str):
    sel = sel.strip()
    if sel == "article h3 a":
        return lambda a: a["in_article_h3"]
    if sel == ".search-result a":
        return lambda a: a["in_search_result"]
    m = _SEL_ATTR.match(sel)
    if m:
        field = "raw_href" if m.group(1) == "href" else "track_action"
        val = m.group(3)
        if m.group(2) == "*=":
            return lambda a: a[field].contains(val)
        return lambda a: a[field] == val
    raise ValueError(f"unsupported selector: {sel}")


def _picked(selectors: list[str], preferred: list[str]) -> Column:
    """A page's anchors by selector order, then the preferred ones; an anchor may be picked more than once."""
    href_a = F.filter(F.col("parsed.anchors"), lambda x: x["tag"] == "a")
    groups = [F.filter(href_a, _selector_pred(s)) for s in selectors]
    groups.append(F.filter(href_a, lambda x: X.any_of([x["raw_href"].contains(p) for p in preferred])))
    return F.flatten(F.array(*groups))


def parse_search_results(parsed: DataFrame, ids: list[str], selectors: list[str] | None = None,
                         preferred: list[str] | None = None, by_source: dict | None = None) -> DataFrame:
    """Result anchors by selector order, then fallback anchors; no de-dup; blocked pages dropped.

    ``by_source`` gives selectors and preferred patterns per value of ``source``
    instead.  title = raw text (if non-empty) else aria-label else title attribute,
    whitespace-normalised; anchors whose href cannot be resolved are dropped.
    """
    if by_source is None:
        picked = _picked(selectors or [], preferred or [])
    else:
        picked = F.filter("parsed.anchors", lambda x: F.lit(False))
        for name, rule in by_source.items():
            picked = F.when(F.col("source") == name, _picked(rule["selectors"], rule["preferred"])).otherwise(picked)
    rows = parsed.filter(~F.col("parsed.blocked")).select(*ids, F.posexplode(picked).alias("item_ord", "a"))
    title = F.coalesce(F.nullif(F.col("a.raw_text"), F.lit("")), F.nullif(F.col("a.aria_label"), F.lit("")),
                       F.col("a.title_attr"))
    return rows.filter(F.col("a.url").isNotNull()).select(
        *ids, "item_ord", X.norm_ws(title).alias("title"), F.col("a.url").alias("url"))


# -- X02 / X03 / F10 / W03 / X13 ----------------------------------------------------------

def _width(grid: Column) -> Column:
    """Widest row of a ragged grid (0 when empty)."""
    return F.coalesce(F.array_max(F.transform(grid, lambda r: F.size(r))), F.lit(0))


def extract_tables(parsed: DataFrame, ids: list[str], min_rows: int = K.MIN_TABLE_ROWS,
                   min_cols: int = K.MIN_TABLE_COLS) -> DataFrame:
    """X02/X03 + F10 + W03: data tables numbered 1.. in DOM order after the size filter."""
    kept = F.filter(F.col("parsed.tables"),
                    lambda t: (F.size(t["grid"]) >= min_rows) & (_width(t["grid"]) >= min_cols))
    out = parsed.select(*ids, F.posexplode(kept).alias("pos", "t"))
    return out.select(*ids, (F.col("pos") + 1).alias("table_number"), F.col("t.dom_index").alias("dom_index"),
                      F.col("t.caption").alias("caption"), F.size("t.grid").alias("rows"),
                      _width(F.col("t.grid")).alias("columns"), F.col("t.source").alias("source"),
                      F.col("t.grid").alias("grid"))


def table_cells(tables: DataFrame, ids: list[str]) -> DataFrame:
    """Long-form cells (…, table_number, row_no, col_no, cell) via two posexplodes."""
    rows = tables.select(*ids, "table_number", F.posexplode("grid").alias("row_no", "r"))
    return rows.select(*ids, "table_number", "row_no", F.posexplode("r").alias("col_no", "cell"))


def grid_csv(grid: Column) -> Column:
    """Ragged grid -> CSV text (C25 per cell, ',' per row, '\\n' per line)."""
    return F.concat(F.array_join(F.transform(grid, lambda r: F.array_join(
        F.transform(r, lambda c: X.csv_escape(c)), ",")), "\n"), F.lit("\n"))


# -- X04 / X05 --------------------------------------------------------------------------

def extract_figures(parsed: DataFrame, ids: list[str], pmcid: str | None = None) -> DataFrame:
    """Figures numbered 1.. in document order (no filter in JATS; HTML skips empty)."""
    out = parsed.select(*ids, *([pmcid] if pmcid and pmcid not in ids else []),
                        F.posexplode("parsed.figures").alias("pos", "f"))
    image = F.col("f.image_url")
    if pmcid:
        image = F.when(F.col("f.graphic") != "", X.jats_image_url(F.col(pmcid), F.col("f.graphic"))) \
            .otherwise(image)
    return out.select(*ids, (F.col("pos") + 1).alias("figure_number"), F.col("f.caption").alias("caption"),
                      F.col("f.graphic").alias("graphic"), F.coalesce(image, F.lit("")).alias("image_url"))


# -- C30 ------------------------------------------------------------------------------

def absolute_links(stored_anchors: DataFrame, href: str = "raw_href", base: str = "url", out: str = "url",
                   foreign_hosts: bool = True) -> DataFrame:
    """C30 over stored anchors: ``out`` = ``href`` resolved against ``base``; null where nothing can be resolved.

    Built-in functions resolve every row; rows whose host goes beyond ASCII, which need IDNA, alone pass through
    Python. ``foreign_hosts=False`` leaves those null, and the plan has no Python stage. The anchors are read
    twice otherwise, so hand in a written table.
    """
    near = stored_anchors.withColumn("_url", resolve_href(F.col(href), F.col(base)))
    if not foreign_hosts:
        return near.withColumn(out, F.col("_url")).drop("_url")
    ship_package(stored_anchors.sparkSession)
    far = beyond_ascii_host(F.col(href), F.col(base))
    names = stored_anchors.columns

    def run(batches):
        from quarry.functions.urls import resolve_url
        for b in batches:
            pairs = zip(b.column(names.index(href)).to_pylist(), b.column(names.index(base)).to_pylist())
            urls = pa.array([resolve_url(h, at) for h, at in pairs], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, urls], names=[*names, "_url"])

    foreign = stored_anchors.filter(far)
    resolved = foreign.mapInArrow(run, T.StructType([*foreign.schema.fields, T.StructField("_url", T.StringType())]))
    return near.filter(~far).unionByName(resolved).withColumn(out, F.col("_url")).drop("_url")


# -- X06 / F12 / F13 / W07 ------------------------------------------------------------------

def dataset_links(parsed: DataFrame, ids: list[str], hosts: list[str] | None = None) -> DataFrame:
    """Repository links (a[href] + ext-link), site chrome excluded, first text per absolute URL."""
    hosts = hosts or K.DATA_REPOSITORY_HOSTS
    cand = F.filter(F.col("parsed.anchors"), lambda a: X.repository_href(a["raw_href"], hosts)
                    & ~X.is_site_chrome_link(a["raw_href"], a["text"]) & a["url"].isNotNull())
    firsts = first_by(cand, "url")
    out = parsed.select(*ids, F.posexplode(firsts).alias("link_ord", "a"))
    return out.select(*ids, "link_ord", F.col("a.url").alias("url"), F.col("a.text").alias("text"))


# -- X10 / F14 / T04 ---------------------------------------------------------------------

def landing_files(parsed: DataFrame, ids: list[str], limit: int | None = None,
                  words: list[str] | None = None) -> DataFrame:
    """Download-ish links (F14) of a landing page, unique by URL, all of them unless ``limit``."""
    text_re = (X.WB_BEFORE + "(?i:(" + "|".join(re.escape(w) for w in words) + "))" + X.WB_AFTER
               if words else X.DOWNLOAD_TEXT_RE)
    cand = F.filter(F.col("parsed.anchors"), lambda a: (a["tag"] == "a") & a["url"].isNotNull()
                    & (X.is_data_file_url(a["url"]) | a["text"].rlike(text_re)))
    firsts = first_by(cand, "url") if limit is None else F.slice(first_by(cand, "url"), 1, limit)
    out = parsed.select(*ids, F.posexplode(firsts).alias("file_ord", "a"))
    name = F.coalesce(F.nullif(X.file_name_from_url(F.col("a.url")), F.lit("")),
                      X.safe_file_name(F.col("a.text"), "dataset-file"))
    return out.select(*ids, "file_ord", F.col("a.url").alias("url"), name.alias("file_name"),
                      F.lit(None).cast("long").alias("size"), F.lit("html_link").alias("source"))
