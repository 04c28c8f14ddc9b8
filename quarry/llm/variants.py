"""Spelling variant grouping (operator 13): permuterm rotations of terminator-marked words.

A word of L code points, marked with a terminator, has L + 1 rotations. Two words differ by one
replaced code point exactly when a rotation of each agrees but for its last code point, and by one
inserted one exactly when a rotation of the longer, without its last code point, is a whole rotation
of the shorter. So every rotation is posted whole and without its last code point (the edited one,
which the prefix skips), all postings are range-partitioned and sorted, and one scan meets each
prefix range as a run of equal keys. A run holds at most one posting for each letter of the alphabet
and one whole rotation, so that runs stay small however common a word is. Neighbours of a run are
counted and the most frequent two are kept; pairs are never written out.

An inserted code point that repeats its neighbour could be any of the run's; only the last one counts.

Defined cases: a null text has no words; a null ``doc_id`` counts as an empty string in the damage;
rows that repeat count again; ties of n go to the smaller word in code-point order; an empty table
gives an empty one; further columns are ignored. A word of L code points is posted 2 L + 1 times
with L + 1 code points, so a very long word that recurs costs the square of its length in shuffled
characters, a posting in memory at a time.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import chunks, small_batches, stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Not a letter, so it marks a word's end.
END = "$"

_NEAR = "word string, n_near long, best_n long, best string"
_NEAR_ARROW = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def runs(documents: DataFrame) -> DataFrame:
    """(doc_id, run) per maximal run of letters, A-Z lower-cased."""
    low = F.translate(F.coalesce(F.col("text"), F.lit("")), _UPPER, _LOWER)
    found = F.regexp_extract_all(low, F.lit(r"[a-zÀ-ÿ]+"), F.lit(0))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(found).alias("run"))


def damaged(runs: DataFrame, every: int = 199) -> DataFrame:
    """(word): runs whose crc32 with the document's id is divisible by ``every`` lose one code point."""
    h = F.crc32(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("run")).cast("binary"))
    at = F.pmod(F.col("h"), F.length("run").cast("long")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return runs.withColumn("h", h).select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def frequent(words: DataFrame, min_chars: int = 6, min_count: int = 5) -> DataFrame:
    """(word, n) of the words that are long and frequent enough; counted map-side first."""
    return words.filter(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def postings(words: DataFrame) -> DataFrame:
    """(key, edited, n): a word's whole rotations (``edited`` empty), and its rotations without the last code point.

    The key is what follows the edited place, the terminator, and what stands before it, so key and
    edited code point give the word back.
    """
    at = F.expr("explode(sequence(-length(word), length(word)))").alias("at")
    each = words.select("word", "n", at)
    word, k, long = F.col("word"), F.col("at"), F.length("word")
    whole = F.concat(word.substr(k + 1, long), F.lit(END), word.substr(F.lit(1), k))
    holed = F.concat(word.substr(1 - k, long), F.lit(END), word.substr(F.lit(1), -k - 1))
    return each.select(F.when(k >= 0, whole).otherwise(holed).alias("key"),
                       F.when(k >= 0, F.lit("")).otherwise(word.substr(-k, F.lit(1))).alias("edited"), "n")


def neighbours(key: str, members: list[tuple[str, int]]):
    """(word, near words, n and text of the most frequent) of one run: ``members`` are (edited, n)."""
    after, before = key.split(END)
    whole = None
    holed = []
    for edited, n in members:
        if edited:
            holed.append((-n, before + edited + after, edited != key[0]))
        else:
            whole = -n, before + after
    holed.sort()
    longer = [m for m in holed if m[2]]
    if whole and longer:
        yield whole[1], len(longer), -longer[0][0], longer[0][1]
    for k, (_, word, last_of_run) in enumerate(holed):
        others = [holed[1 if k == 0 else 0][:2]] if len(holed) > 1 else []
        n = len(holed) - 1
        if whole and last_of_run:
            others.append(whole)
            n += 1
        if others:
            best = min(others)
            yield word, n, -best[0], best[1]


def near(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words that have near words; ``words``: (word, n), each once."""
    small_batches(words.sparkSession)

    def scan(batches):
        def out():
            key, members = None, []
            for batch in batches:
                keys = batch.column("key")
                if len(keys) == 0:
                    continue
                same = pc.equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_pylist()
                edited, n = batch.column("edited"), batch.column("n")
                at = 0
                while at < len(keys):
                    end = at + 1
                    while end < len(keys) and same[end - 1]:
                        end += 1
                    # a run at an edge of the batch may go on in another; any other of one member has no neighbours
                    if at == 0 or end == len(keys) or end > at + 1:
                        now = keys[at].as_py()
                        if now != key:
                            if len(members) > 1:
                                yield from neighbours(key, members)
                            key, members = now, []
                        members.extend(zip(edited.slice(at, end - at).to_pylist(), n.slice(at, end - at).to_pylist(), strict=True))
                    at = end
            if len(members) > 1:
                yield from neighbours(key, members)

        yield from chunks(out(), _NEAR_ARROW)

    sorted_ = postings(words).repartitionByRange("key").sortWithinPartitions("key", "edited")
    found = sorted_.mapInArrow(scan, _NEAR)
    first = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("f")).select("word", "n_near", (-F.col("f.m")).alias("best_n"), F.col("f.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last of the forms that begin at ``word``; pointers are doubled, so the rounds grow with the logarithm of the longest chain."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = moved.select("word", "root")
        if not moved.filter("moved").take(1):
            return now


def group_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for (word, n): the form is the most frequent near word, if ``ratio`` times as frequent."""
    words = stored(words.select("word", "n"), "words")
    is_form = F.col("best_n") >= ratio * F.col("n")
    formed = words.join(near(words), "word", "left").select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n"))
    formed = stored(formed, "forms")
    last = roots(formed.filter("form IS NOT NULL"))
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(documents: DataFrame, min_chars: int = 6, min_count: int = 5, ratio: int = 5) -> DataFrame:
    """The variants among the words of whole texts, after the contract's damage."""
    return group_variants(frequent(damaged(runs(documents)), min_chars, min_count), ratio)
