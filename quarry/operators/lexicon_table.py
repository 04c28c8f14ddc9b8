"""A lexicon as a table, matched by an equi-join on word n-grams.

``functions.lexicon`` folds a small lexicon into one pattern.  A large one stays a table: every text is cut
into its words and what stands between them, each run of up to the longest term's words is a key, and keys
meet the lexicon's in a join.  The keys spell the separators (white space as one blank), so that an equal key
is a match of the term as whole words.  A term may begin or end in other characters than a-z and 0-9
(``.net``, ``c++``): its key is its words, and the characters around them are compared in the join.  Stems
meet the beginnings of words.

A lexicon whose text is under ``BROADCAST_CHARS`` is broadcast; beyond it the join is shuffled, heavy keys
salted.  Keys are distinct per text before either.  Hits are put together again in lexicon order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.lexicon import Lexicon
from ..functions.text import JSWS, _s, ascii_lower
from .scoring import let
from .skew import salted_join

#: The most characters of terms that are broadcast: a proven bound, as they are counted first.
BROADCAST_CHARS = 8 << 20
_WORD = "[a-z0-9]+"

LEXICON_SCHEMA = "facet string, ord int, term string, kind string"


def lexicon_rows(spark: SparkSession, lexicon: Lexicon) -> DataFrame:
    """A ``Lexicon`` as the table (facet, ord, term, kind 'term'|'stem')."""
    return spark.createDataFrame(lexicon.rows(), LEXICON_SCHEMA)


def _canonical(text: Column) -> Column:
    return F.regexp_replace(ascii_lower(text), JSWS + "+", " ")


@dataclass(frozen=True)
class LexiconIndex:
    """A lexicon by key, and what one aggregate over it says: the bounds that the texts' keys need."""

    terms: DataFrame
    chars: int
    most_words: int
    has_edges: bool
    stem_lengths: tuple[int, int]


def index_lexicon(lexicon: DataFrame) -> LexiconIndex:
    """Key every term of (facet, ord, term, kind); empty terms are left out, the first of equal ones in a facet counts.

    Runs one aggregate over the lexicon.  A term without a letter a-z or digit can't be keyed: ValueError.
    """
    term = F.trim(F.regexp_replace(F.lower(F.col("term")), JSWS + "+", " "))
    own = lexicon.select("facet", F.col("ord").cast("int").alias("ord"), term.alias("term"), "kind").filter("term <> ''")
    own = own.groupBy("facet", "term", "kind").agg(F.min("ord").alias("ord"))
    core = F.regexp_extract("term", f"{_WORD}(?:.*[a-z0-9])?", 0)
    before = F.regexp_extract("term", "^[^a-z0-9]*", 0)
    after = F.regexp_extract("term", "[^a-z0-9]*$", 0)
    keyed = own.select("facet", "ord", "term", "kind", core.alias("key"), before.alias("before"), after.alias("after"))
    stem = F.col("kind") == "stem"
    r = keyed.agg(F.sum(F.length("term")), F.max(F.when(~stem, F.size(F.regexp_extract_all("key", F.lit(_WORD), F.lit(0))))),
                  F.max(~stem & ((F.col("before") != "") | (F.col("after") != ""))), F.min(F.when(stem, F.length("term"))),
                  F.max(F.when(stem, F.length("term"))), F.max(F.col("key") == ""), F.max(stem & ~F.col("term").rlike(f"^{_WORD}$"))).first()
    if r[5] or r[6]:
        raise ValueError("a term without a letter a-z or digit, or a stem with other characters")
    return LexiconIndex(keyed, r[0] or 0, r[1] or 0, bool(r[2]), (r[3] or 0, r[4] or 0))


def _keys(lexicon: LexiconIndex) -> Column:
    """The distinct runs of up to the longest term's words of ``_canon``, read by one pattern a size: from each word on,
    the run that begins there.  Where too few words are left for one, none of that size follows."""
    def runs(size):
        return F.regexp_extract_all("_canon", F.lit(f"(?=([a-z0-9]++(?:[^a-z0-9]++[a-z0-9]++){{{size - 1}}}))[a-z0-9]++"), F.lit(1))
    return F.array_distinct(F.concat(*[runs(k) for k in range(1, lexicon.most_words + 1)]))


def _grams(lexicon: LexiconIndex) -> Column:
    """The runs of words (``_words``, ``_seps``) of one text as structs (kind, key, left, right): what stands
    around a run, if any term asks.  Keys alone are distinct per text; with their surroundings they are after the join."""
    words, seps, n = F.col("_words"), F.col("_seps"), F.size("_words")
    blank = F.lit("")

    def key(i, size):
        return F.array_join(F.transform(F.sequence(i, i + size - 1), lambda j: F.concat(
            F.when(j > i, F.get(seps, j)).otherwise(blank), F.get(words, j))), "")

    def runs(make):
        at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        return F.flatten(F.transform(at, lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(lexicon.most_words), n - i)), lambda k: make(i, k))))

    def surrounded(i, size):
        # a letter stands for the word next to the separator, so that an edge never reaches beyond it
        left = F.concat(F.when(i > 0, F.lit("a")).otherwise(F.lit(" ")), F.get(seps, i))
        right = F.concat(F.get(seps, i + size), F.when(i + size < n, F.lit("a")).otherwise(F.lit(" ")))
        return F.struct(F.lit("term").alias("kind"), key(i, size).alias("key"), left.alias("left"), right.alias("right"))

    def bare(kind, keys):
        return F.transform(F.array_distinct(keys), lambda k: F.struct(F.lit(kind).alias("kind"), k.alias("key"), blank.alias("left"), blank.alias("right")))

    def stems(w):
        least, most = lexicon.stem_lengths
        cuts = F.filter(F.sequence(F.lit(least), F.lit(most)), lambda k: k <= F.length(w))
        return F.transform(cuts, lambda k: w.substr(F.lit(1), k))

    parts = [F.array().cast("array<struct<kind:string,key:string,left:string,right:string>>")]
    if lexicon.most_words:
        parts.append(runs(surrounded) if lexicon.has_edges else bare("term", runs(key)))
    if lexicon.stem_lengths[1]:
        parts.append(bare("stem", F.flatten(F.transform(F.array_distinct(words), stems))))
    return F.concat(*parts)


def lexicon_hits(texts: DataFrame, lexicon: DataFrame | LexiconIndex, keys: list[str], text: str = "text") -> DataFrame:
    """(…keys, facet, kind, ord, term): every term that occurs in a row's text, once; ``keys`` tell rows apart."""
    index = lexicon if isinstance(lexicon, LexiconIndex) else index_lexicon(lexicon)
    canon = let(texts.select(*keys, _s(F.col(text)).alias("_text")), _canonical(F.col("_text")).alias("_canon"))
    if index.most_words and not index.has_edges and not index.stem_lengths[1]:
        blank = F.lit("")
        grams = let(canon, _keys(index).alias("_keys")).select(
            *keys, F.lit("term").alias("kind"), F.explode("_keys").alias("key"), blank.alias("left"), blank.alias("right"))
    else:
        parts = let(canon, F.regexp_extract_all("_canon", F.lit(_WORD), F.lit(0)).alias("_words"), F.split("_canon", _WORD, -1).alias("_seps"))
        grams = parts.select(*keys, F.inline(_grams(index)))
    if index.chars <= BROADCAST_CHARS:
        met = grams.join(F.broadcast(index.terms), ["kind", "key"])
    else:
        met = salted_join(grams, index.terms, ["kind", "key"], keys)
    if index.has_edges:
        met = met.filter(_edge("left", "before", True) & _edge("right", "after", False))
    return met.select(*keys, "facet", "kind", "ord", "term").distinct()


def _edge(around: str, wanted: str, is_left: bool) -> Column:
    """Whether the separator ``around`` ends (begins) with ``wanted`` and no word touches that."""
    a, w = F.col(around), F.col(wanted)
    rest = F.length(a) - F.length(w)
    if is_left:
        return (w == "") | ((rest > 0) & a.endswith(w) & (a.substr(rest, F.lit(1)) != "a"))
    return (w == "") | ((rest > 0) & a.startswith(w) & (a.substr(F.length(w) + 1, F.lit(1)) != "a"))


def matched_by_facet(texts: DataFrame, lexicon: DataFrame | LexiconIndex, keys: list[str], text: str = "text") -> DataFrame:
    """(…keys, facet, terms): a row's terms of a facet in lexicon order; rows without hits have none."""
    hits = lexicon_hits(texts, lexicon, keys, text)
    own = F.array_sort(F.collect_list(F.struct("ord", "term")))
    return hits.groupBy(*keys, "facet").agg(F.transform(own, lambda x: x["term"]).alias("terms"))


def score_by_table(df: DataFrame, lexicon: DataFrame | LexiconIndex, key: str, title: str = "title", abstract: str = "abstract",
                   weights: dict | None = None) -> DataFrame:
    """C11 with a lexicon table: the columns of ``operators.scoring.score_candidates``; ``key`` is unique per row.

    Facets are geography, commodity, measure, penalty and dataset_hints.
    """
    w = weights or K.WEIGHTS
    both = df.select(F.col(key).alias("_k"), F.inline(F.array(F.struct(F.lit(0).alias("_part"), F.col(title).alias("_t")),
                                                              F.struct(F.lit(1).alias("_part"), F.col(abstract).alias("_t")))))
    hits = lexicon_hits(both, lexicon, ["_k", "_part"], "_t")
    names = ["geography", "commodity", "measure", "penalty", "dataset_hints"]

    def of(facet, part):
        return F.array_sort(F.collect_list(F.when((F.col("facet") == facet) & (F.col("_part") == part), F.struct("ord", "term")))).alias(f"_{facet}{part}")
    per = hits.groupBy("_k").agg(*[of(f, p) for f in names for p in (0, 1)])
    j = df.join(per, df[key] == per["_k"], "left")

    def terms(facet, part):
        return F.coalesce(F.transform(f"_{facet}{part}", lambda x: x["term"]), F.array().cast("array<string>"))

    def points(facet, weight):
        return F.when(F.size(terms(facet, 0)) > 0, w[f"title_{weight}"]).when(F.size(terms(facet, 1)) > 0, w[f"abstract_{weight}"]).otherwise(0)
    hint = F.size(terms("dataset_hints", 0)) > 0
    raw = points("geography", "geography") + points("commodity", "commodity") + points("measure", "measure") + points("penalty", "penalty") \
        + F.when(hint, w["dataset_hint"]).otherwise(0)

    def union(facet):
        return F.array_distinct(F.concat(terms(facet, 0), terms(facet, 1)))
    return j.select(*[df[c] for c in df.columns], F.greatest(F.lit(0), F.least(F.lit(100), raw)).cast("int").alias("score"),
                    union("geography").alias("geography"), union("commodity").alias("commodity"), union("measure").alias("measure"),
                    union("penalty").alias("penalties"), hint.alias("has_dataset_hint"), (F.size(terms("commodity", 0)) > 0).alias("commodity_in_title"))
