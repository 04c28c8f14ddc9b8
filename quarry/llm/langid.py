"""Language ID (operator 6) by Bayesian evidence fusion.

Four kinds of evidence are combined per row: the likelihood of its text under character n-gram models
of the languages, the language its markup declares, the suffix of its address, and its host. How far a
declaration can be trusted, and how languages spread over hosts, is counted over all rows by grouped
aggregation of the text's posteriors; the host's prior is smoothed towards its domain's, that towards
its suffix's, and that towards the whole table's. A row's own text is taken out of every count that
judges it, so that no evidence counts twice.

The n-gram models are fitted to at most ``MOST_DOCS`` labelled documents a language, those with the
least hashes; one labelled document makes a language.

Defined cases: a null or empty text has no likelihood and is judged by its other evidence; a null
address or declaration says nothing; without any evidence the table's most frequent language is taken;
ties go to the first language by name; rows are judged each, also repeated ones; null ids stay null;
an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

import html as _html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.llm.common import chunks, rows_of, small_batches, stored

MOST_DOCS = 1500
#: Parts into which a language's ids are dealt before the first are taken.
PARTS = 256
BUCKETS = 1 << 14
#: A text's n-grams depend on each other: its log likelihood counts for this many at most.
WEIGHT_CAP = 60.0
#: Rows that a parent's distribution is worth in its child's.
SMOOTHING = 5.0

_OPENS = re.compile(r"<(?:(script|style|noscript|template)\b|(!--)|[!/?a-zA-Z])", re.I)
_CLOSES = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript", "template")}
_ROOT = re.compile(r"<html\b", re.I)
_LANG = re.compile(r"\blang\s*=\s*[\"']?([A-Za-z]{2,3})", re.I)


def page_text(html: str | None) -> str:
    """The text between the tags, without scripts, styles and comments.

    Linear: what a search didn't find up to the end isn't searched for again.  An element or comment that is
    never closed loses its tag only.
    """
    html = html or ""
    out, at, missing = [], 0, set()
    while (mark := _OPENS.search(html, at)) and ">" not in missing:
        end = -1
        name = (mark[1] or mark[2] or "").lower()
        if name and name not in missing:
            if name == "!--":
                end = html.find("-->", mark.end()) + 3 if html.find("-->", mark.end()) >= 0 else -1
            elif found := _CLOSES[name].search(html, mark.end()):
                end = found.end()
            if end < 0:
                missing.add(name)
        if end < 0 and (end := html.find(">", mark.start() + 2) + 1) == 0:
            missing.add(">")
            break
        out += [html[at : mark.start()], " "]
        at = end
    return _html.unescape("".join([*out, html[at:]]))


def declared_language(html: str | None) -> str | None:
    """The language that an html tag names."""
    html = html or ""
    at = 0
    while root := _ROOT.search(html, at):
        end = html.find(">", root.end())
        if found := _LANG.search(html, root.end(), end if end >= 0 else len(html)):
            return found[1].lower()
        if end < 0:
            return None
        at = end
    return None


def gram_counts(text: str) -> np.ndarray:
    """Counts of hashed runs of one to three bytes of the lower-cased letters of the whole text."""
    data = np.frombuffer(" ".join(re.findall(r"[^\W\d_]+", text.lower())).encode(), dtype=np.uint8).astype(np.uint32)
    out = np.bincount(data, minlength=BUCKETS).astype(np.float64) if len(data) else np.zeros(BUCKETS)
    if len(data) > 1:
        two = data[:-1] * np.uint32(257) + data[1:] + np.uint32(1 << 10)
        out += np.bincount((two * np.uint32(2654435761)) >> np.uint32(18), minlength=BUCKETS)
    if len(data) > 2:
        three = (data[:-2] * np.uint32(257) + data[1:-1]) * np.uint32(257) + data[2:]
        out += np.bincount((three * np.uint32(2246822519)) >> np.uint32(18), minlength=BUCKETS)
    return out


def fit(docs: DataFrame, most_docs: int = MOST_DOCS) -> tuple[list[str], np.ndarray]:
    """Languages, in order, and the log probability of each n-gram bucket (buckets, languages)."""
    spark = docs.sparkSession
    small_batches(spark)
    known = docs.filter("lang is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "lang")
    # a language's first ids of each part, then of those the first: a part holds no more than most_docs of them
    first = known.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(PARTS)))
    for keys in (["lang", "part"], ["lang"]):
        order = W.partitionBy(*keys).orderBy(F.xxhash64("doc_id"), "doc_id")
        first = first.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= most_docs).drop("n")
    ids = [(r["doc_id"], r["lang"]) for r in first.collect()]  # at most most_docs a language
    langs = sorted({lang for _, lang in ids})
    if not ids:
        return [], np.zeros((BUCKETS, 0))
    chosen = F.broadcast(spark.createDataFrame(ids, "doc_id long, own string"))  # at most most_docs a language
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id")

    def run(batches):
        by: dict[str, np.ndarray] = {}
        for lang, text in rows_of(batches, "own", "text"):
            by[lang] = by.get(lang, 0) + gram_counts(text or "")
        rows = ((lang, x.astype("<f8").tobytes()) for lang, x in by.items())
        yield from chunks(rows, pa.schema([("lang", pa.string()), ("counts", pa.binary())]))

    total = {lang: np.full(BUCKETS, 0.2) for lang in langs}
    # the scan keeps its tasks; only the sampled texts, bounded as their ids are, move to a few
    for r in sample.repartition(16).mapInArrow(run, "lang string, counts binary").toLocalIterator():
        total[r["lang"]] += np.frombuffer(r["counts"], "<f8")
    return langs, np.stack([np.log(total[x] / total[x].sum()) for x in langs], axis=1)


def text_evidence(rows: DataFrame, langs: list[str], table: np.ndarray, markup: bool) -> DataFrame:
    """``rows`` (id, host, text) without the text, with ``declared`` and the text's posterior ``p``."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(table)
    names = [n for n in rows.columns if n != "text"]

    def run(batches):
        for batch in batches:
            declared, posterior = [], []
            for (text,) in rows_of([batch], "text"):
                declared.append(declared_language(text) if markup else None)
                counts = gram_counts(page_text(text) if markup else text or "")
                like = counts @ sent.value
                like *= min(1.0, WEIGHT_CAP / max(1.0, counts.sum()))
                e = np.exp(like - like.max())
                posterior.append((e / e.sum()).tolist())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(declared, pa.string()), pa.array(posterior, pa.list_(pa.float64()))], names=[*names, "declared", "p"])

    schema = rows.drop("text").withColumn("declared", F.lit(None).cast("string")).withColumn("p", F.lit(None).cast("array<double>")).schema
    return rows.mapInArrow(run, schema)


def _sums(df: DataFrame, keys: list[str], n: int, name: str) -> DataFrame:
    """Sums of the posteriors by key, as an array; partial sums meet first."""
    sums = df.groupBy(*keys).agg(*(F.sum(F.col("p")[k]).alias(f"s{k}") for k in range(n)))
    return sums.select(*keys, F.array(*(F.col(f"s{k}") for k in range(n))).alias(name))


def fuse(evidence: DataFrame, langs: list[str]) -> DataFrame:
    """Adds ``lang``, ``probability`` and ``text_lang`` to rows of (..., host, declared, p)."""
    n = len(langs)
    parts = F.split("host", "\\.")
    suffix = F.when(F.col("host") != "", F.element_at(parts, -1))
    domain = F.when(F.col("host") != "", F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), "."))
    keyed = evidence.withColumn("suffix", suffix).withColumn("domain", domain).withColumn("everything", F.lit(1))
    # hosts, a row each, with the sums above them; only sums travel, never rows of a host
    hosts = stored(_sums(keyed, ["everything", "suffix", "domain", "host", "declared"], n, "p"), "host-sums")
    add = lambda keys, name: _sums(hosts, keys, n, name)
    totals, declared = add(["everything"], "at_all"), add(["declared"], "at_declared")
    up = add(["suffix", "domain", "host"], "at_host")
    for key, name in (("domain", "at_domain"), ("suffix", "at_suffix")):
        up = up.join(add([key], name).withColumnRenamed(key, "__key"), F.col(key).eqNullSafe(F.col("__key")), "left").drop("__key")
    levels = up.select(F.col("host").alias("__host"), "at_host", "at_domain", "at_suffix")
    joined = keyed.join(levels, F.col("host").eqNullSafe(F.col("__host")), "left").drop("__host")
    joined = joined.join(declared.withColumnRenamed("declared", "__declared"), F.col("declared").eqNullSafe(F.col("__declared")), "left").drop("__declared").join(totals, "everything")
    keep = [c for c in evidence.columns if c != "p"]
    levels = ["at_all", "at_suffix", "at_domain", "at_host"]
    inputs = joined.select(*keep, F.col("suffix").isNotNull().alias("known"), "p", *levels, "at_declared")

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            table = lambda c: np.array(batch.column(c).to_pylist())  # noqa: B023, E731
            p = table("p")
            known = batch.column("known").to_numpy(zero_copy_only=False)[:, None]
            says = np.array([x is not None for x in batch.column("declared").to_pylist()])[:, None]
            best, weight = posterior(p, {c: np.maximum(table(c) - p, 0) for c in levels}, np.maximum(table("at_declared") - p, 0), known, says)
            named = lambda numbers: pa.array([langs[k] for k in numbers], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), named(best), pa.array(weight), named(p.argmax(axis=1))], names=[*keep, "lang", "probability", "text_lang"])

    out = evidence.select(*keep).withColumn("lang", F.lit("")).withColumn("probability", F.lit(0.0)).withColumn("text_lang", F.lit(""))
    return inputs.mapInArrow(run, out.schema)


def posterior(p: np.ndarray, counts: dict[str, np.ndarray], declared: np.ndarray, known: np.ndarray, says: np.ndarray):
    """Best language and its probability; counts are without the row itself, (rows, languages)."""
    n = p.shape[1]
    every = counts["at_all"]
    prior = (every + 1) / (every.sum(axis=1, keepdims=True) + n)
    for level in ("at_suffix", "at_domain", "at_host"):
        own = counts[level]
        prior = np.where(known, (own + SMOOTHING * prior) / (own.sum(axis=1, keepdims=True) + SMOOTHING), prior)
    # how often a language's rows declare this
    told = np.where(says, (declared + 0.1) / (every + 1), 1.0)
    log = np.log(prior) + np.log(told) + np.log(p + 1e-30)
    weight = np.exp(log - log.max(axis=1, keepdims=True))
    return weight.argmax(axis=1), weight.max(axis=1) / weight.sum(axis=1)


def identify(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, page_id, host, declared, lang, probability, text_lang): every document and every page.

    A document's host is its source; models are learnt from the documents' languages.
    """
    langs, table = fit(documents)
    host = F.coalesce(F.translate(F.regexp_extract("url", "://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), F.coalesce("source", F.lit("")).alias("host"), "text")
    web = pages.select(F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"), host.alias("host"), F.col("html").alias("text"))
    if not langs:
        none = [F.lit(None).cast(t).alias(c) for c, t in (("declared", "string"), ("lang", "string"), ("probability", "double"), ("text_lang", "string"))]
        return docs.unionByName(web).select("doc_id", "page_id", "host", *none)
    evidence = stored(text_evidence(docs, langs, table, False).unionByName(text_evidence(web, langs, table, True)), "text-evidence")
    return fuse(evidence, langs)
