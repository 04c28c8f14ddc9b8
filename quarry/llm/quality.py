"""Quality classifier (operator 10): attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes (its whole text, cut at no particular place). A
passage's features are shares of bytes and of pairs of byte kinds, how often its document's words recur,
and the shares of common words, of pairs of common neighbours and of all rarer words together. The encoder
gives each word and pair a vector of its own (its row of the first layer) and makes a vector of each
passage; gated attention (tanh times sigmoid) weighs the passages, and the weighted vector is scored.
Encoder, attention and scorer are learnt together from document labels.

Words are runs of letters (bytes beyond ASCII count as such), A-Z lower-cased, known by 64-bit hashes, and
belong to the passage they begin in; texts are read in slices of ``SLICE`` passages, and a word cut by a
slice's edge is two. Common are the ``WORDS`` words and ``PAIRS`` pairs found in the most documents of the
training sample, in ``SHARE`` of them and two at least.

Training takes at most ``MOST_DOCS`` labelled documents, half of each label where there are so many,
those with the least hashes; it never takes rows of the held-out fold (crc32 of the id, mod 5, is 0).
For every ``EVERY`` documents of label 0 one of label 1 also serves with the letters of each of its words shuffled,
as label 0: what is made of no known words isn't good, whatever its letters. It learns from all passages of a document it takes; the least hashes of both labels come first, and a
document that would bring the sample above ``MOST_PASSAGES`` is left out whole (shuffled copies: a tenth of that besides). Scoring reads every
whole text.

Defined cases: a null or empty text is one passage without bytes; a null ``doc_id`` is scored and not
held out; repeated rows score the same; labels that are null or contradict each other in a document
are left out; without both labels to learn from every score is the share of label 1 (1 without any);
an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import rows_of, small_batches, stored

PASSAGE = 512
MOST_DOCS = 4000
#: Passages of all documents of the sample together, which the driver holds.
MOST_PASSAGES = 100_000
#: Passages whose bytes are counted at once.
SLICE = 256
#: Words and pairs of neighbours that have vectors of their own, and the least share of documents that hold one.
WORDS, PAIRS, SHARE = 384, 128, 0.01
#: What shares of words are multiplied by, so that words learn slower than the few plain features.
SCALE = 0.03
#: For so many documents of label 0 there is one shuffled copy of a document of label 1; 0: none.
EVERY = 4
FOLDS = 5
HIDDEN, GATE = 16, 8

_KIND = np.full(256, 7, dtype=np.int64)  # beyond ASCII
for _k, _bytes in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".,;:'\"-?()")):
    _KIND[list(_bytes)] = _k
_KIND[[b for b in range(128) if _KIND[b] == 7]] = 6  # other signs
_SHOWN = np.minimum(np.arange(256), 128)
N_PLAIN = 129 + 64 + 4

_LETTER = np.zeros(256, dtype=np.uint64)  # what a letter adds to its word's hash; 0: no letter
for _b in [*range(97, 123), *range(128, 256)]:
    _LETTER[_b] = _b
_LETTER[65:91] = _LETTER[97:123]
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.multiply.accumulate(np.r_[np.uint64(1), np.full(SLICE * PASSAGE - 1, _BASE, dtype=np.uint64)])
_INVERSE = np.multiply.accumulate(np.r_[np.uint64(1), np.full(SLICE * PASSAGE - 1, pow(_BASE, -1, 1 << 64), dtype=np.uint64)])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))).view(np.int64)


def hashed_words(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of a slice begin, their hashes, and the hashes of pairs of neighbours."""
    letter = _LETTER[part]
    edge = np.flatnonzero(np.diff(np.r_[False, letter > 0, False]))
    starts, ends = edge[::2], edge[1::2]
    sums = np.r_[np.uint64(0), np.cumsum(letter * _POWERS[: len(part)])]
    h = (sums[ends] - sums[starts]) * _INVERSE[starts]
    return starts, _mixed(h), _mixed(h[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[1:])


@dataclass
class Vocabulary:
    """Ascending hashes of the common words and pairs."""

    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def size(self) -> int:
        return len(self.words) + 1 + len(self.pairs)


NO_WORDS = Vocabulary()


def _places(common: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Each hash's place among the common ones, or their number."""
    if not len(common):
        return np.zeros(len(hashes), dtype=np.int64)
    at = np.searchsorted(common, hashes)
    return np.where(common[np.minimum(at, len(common) - 1)] == hashes, at, len(common))


def word_counts(part: np.ndarray, n: int, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(n, words + 1) and (n, pairs + 1): how often a slice's passages hold each, the rarer ones last."""
    starts, words, pairs = hashed_words(part)
    of, out = starts // PASSAGE, []
    for common, hashes in ((vocabulary.words, words), (vocabulary.pairs, pairs)):
        wide = len(common) + 1
        out.append(np.bincount(of[: len(hashes)] * wide + _places(common, hashes), minlength=n * wide).reshape(n, wide))
    return out[0], out[1]


def sliced(text: str | None):
    """(bytes, passages) of a text's slices; an empty text has one passage."""
    data = np.frombuffer((text or "").encode(), dtype=np.uint8)
    for first in range(0, max(1, len(data)), SLICE * PASSAGE):
        part = data[first : first + SLICE * PASSAGE]
        yield part, max(1, -(-len(part) // PASSAGE))


def feature_slices(text: str | None, vocabulary: Vocabulary = NO_WORDS):
    """(passages, features) of some passages at a time, so that long texts need little memory."""
    words = (text or "").split()
    lines = [x for x in (text or "").split("\n") if x]
    whole = [len(set(words)) / max(1, len(words)), len(set(lines)) / max(1, len(lines)), np.log1p(len(words)) / 10, sum(map(len, words)) / max(1, len(words)) / 20]
    before = np.zeros(0, dtype=np.uint8)
    for part, n in sliced(text):
        of = np.arange(len(part)) // PASSAGE
        size = np.maximum(np.bincount(of, minlength=n), 1)[:, None]
        shown = np.bincount(of * 129 + _SHOWN[part], minlength=n * 129).reshape(n, 129) / size
        kind = _KIND[np.r_[before, part]]
        second = of[len(of) - len(kind) + 1 :]
        pair = np.bincount(second * 64 + kind[:-1] * 8 + kind[1:], minlength=n * 64).reshape(n, 64) / size
        common, neighbours = (c / np.maximum(c.sum(1, keepdims=True), 1) for c in word_counts(part, n, vocabulary))
        yield np.hstack([np.sqrt(shown), np.sqrt(pair), np.tile(whole, (n, 1)), SCALE * np.sqrt(common), SCALE * np.sqrt(neighbours[:, :-1])]).astype(np.float32)
        before = part[-1:]


def passage_features(text: str | None, vocabulary: Vocabulary = NO_WORDS) -> np.ndarray:
    """(passages, features) of the whole text."""
    return np.concatenate(list(feature_slices(text, vocabulary)))


@dataclass
class Bag:
    """A document's features, those of words sparse; ``np.asarray`` fills them in."""

    plain: np.ndarray
    words: int
    places: np.ndarray
    values: np.ndarray
    #: The document's copy with shuffled words, where it has one.
    shuffled: Bag | None = None

    def __len__(self):
        return len(self.plain)

    def __array__(self, dtype=None, copy=None):
        filled = np.zeros((len(self.plain), self.words), dtype=np.float32)
        filled.ravel()[self.places] = self.values
        return np.hstack([self.plain.astype(np.float32), filled]).astype(dtype or np.float32, copy=False)


@dataclass
class Model:
    """Weights by name; ``base`` alone scores where nothing could be learnt."""

    weights: dict[str, np.ndarray]
    base: float = 1.0
    vocabulary: Vocabulary = field(default_factory=Vocabulary)

    def bag(self, x: np.ndarray) -> tuple[float, np.ndarray]:
        """Score and attention of one document's passages."""
        if not self.weights:
            return self.base, np.full(len(x), 1 / len(x))
        return self._pooled([x])

    def text(self, text: str | None) -> float:
        """Score of a whole text; of its passages only their vectors are held together."""
        return self._pooled(feature_slices(text, self.vocabulary))[0] if self.weights else self.base

    def _pooled(self, slices) -> tuple[float, np.ndarray]:
        w = self.weights
        h, raw = (np.concatenate(x) for x in zip(*(_encoded(w, x)[1:5:3] for x in slices), strict=True))
        attention = np.exp(raw - raw.max())
        attention /= attention.sum()
        return float(1 / (1 + np.exp(-(attention @ h @ w["o"] + w["b"])))), attention


def _encoded(w, x):
    """Standardised features, vectors, the two gates and the attention before its softmax, of passages."""
    z = (x - w["mean"]) / w["std"]
    h = np.tanh(z @ w["E"] + w["e"])
    t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
    return z, h, t, g, (t * g) @ w["a"]


def _forward(w, x, bag, n_bags):
    """bag: the passages' bags, ascending; every bag has a passage."""
    z, h, t, g, raw = _encoded(w, x)
    starts = np.searchsorted(bag, np.arange(n_bags))
    raw = np.exp(raw - np.maximum.reduceat(raw, starts)[bag])
    attention = raw / np.add.reduceat(raw, starts)[bag]
    m = np.add.reduceat(h * attention[:, None], starts, axis=0)
    score = 1 / (1 + np.exp(-(m @ w["o"] + w["b"])))
    return score, attention, (z, h, t, g, m, starts)


def train(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 30, seed: int = 0) -> Model:
    """Adam on the log loss, both labels weighing the same at first and their true share at last.

    Bags' shuffled copies are learnt as label 0.
    """
    share = float(labels.mean()) if len(labels) else 1.0
    if not 0 < share < 1:
        return Model({}, share)
    copies = [x.shuffled for x in bags if isinstance(x, Bag) and x.shuffled is not None]
    bags, labels = [*bags, *copies], np.concatenate([labels, np.zeros(len(copies))])
    rng = np.random.default_rng(seed)
    n = sum(map(len, bags))  # bag by bag, so that the passages aren't held twice
    mean = sum(np.asarray(x).sum(0, dtype=np.float64) for x in bags) / n
    w = {"mean": mean, "std": np.sqrt(sum(((np.asarray(x) - mean) ** 2).sum(0) for x in bags) / n) + 0.02}
    w = {k: x.astype(np.float32) for k, x in w.items()}
    d = len(mean)
    plain = rng.normal(0, N_PLAIN**-0.5, (N_PLAIN, HIDDEN))  # words start without a say
    w |= {"E": np.vstack([plain, np.zeros((d - N_PLAIN, HIDDEN))]), "e": np.zeros(HIDDEN), "V": rng.normal(0, 0.3, (HIDDEN, GATE)), "U": rng.normal(0, 0.3, (HIDDEN, GATE)), "a": rng.normal(0, 0.3, GATE), "o": rng.normal(0, 0.3, HIDDEN), "b": np.zeros(())}
    learnt = ["E", "e", "V", "U", "a", "o", "b"]
    first, second, step = {k: np.zeros_like(w[k]) for k in learnt}, {k: np.zeros_like(w[k]) for k in learnt}, 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 5e-4
        order = rng.permutation(len(bags))
        for at in range(0, len(order), 64):
            own = order[at : at + 64]
            x = np.concatenate([np.asarray(bags[k], dtype=np.float32) for k in own])
            bag = np.repeat(np.arange(len(own)), [len(bags[k]) for k in own])
            score, attention, (z, h, t, g, m, starts) = _forward(w, x, bag, len(own))
            up = (score - labels[own]) / len(own)
            grad = {"o": m.T @ up, "b": up.sum()}
            dm = up[:, None] * w["o"]
            da = (h * dm[bag]).sum(1)
            draw = attention * (da - np.add.reduceat(attention * da, starts)[bag])
            grad["a"] = (t * g).T @ draw
            dt, dg = draw[:, None] * w["a"] * g * (1 - t * t), draw[:, None] * w["a"] * t * g * (1 - g)
            grad["V"], grad["U"] = h.T @ dt, h.T @ dg
            dh = attention[:, None] * dm[bag] + dt @ w["V"].T + dg @ w["U"].T
            dz = dh * (1 - h * h)
            grad["E"], grad["e"] = z.T @ dz + 1e-4 * w["E"], dz.sum(0)
            step += 1
            for k in learnt:
                first[k] = 0.9 * first[k] + 0.1 * grad[k]
                second[k] = 0.999 * second[k] + 0.001 * grad[k] ** 2
                w[k] = w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(w, share)


def shuffled_words(text: str) -> str:
    """The text with the letters of each word in another order, the same one every time."""
    rng = random.Random(text)
    return re.sub(r"[^\W\d_]+", lambda word: "".join(rng.sample(word[0], len(word[0]))), text)


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def whole_bags(sizes: dict[int, int], order: list[list[int]], most_passages: int) -> list[int]:
    """Documents that are learnt from: labels in turn, each in its order, as long as all their passages fit."""
    out, total = [], 0
    for at in range(max(map(len, order), default=0)):
        for ids in order:
            if at < len(ids) and ids[at] in sizes and total + sizes[ids[at]] <= most_passages:
                out.append(ids[at])
                total += sizes[ids[at]]
    return out


def fit(docs: DataFrame, labels: DataFrame, most_docs: int = MOST_DOCS, most_passages: int = MOST_PASSAGES, every: int = EVERY) -> Model:
    """Learn from the bounded sample; only its features reach the driver."""
    small_batches(docs.sparkSession)
    known = labels.filter("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("y"), F.max("quality").alias("y1"))
    known = known.filter("y = y1").filter(~held_out(F.col("doc_id"))).join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    by_hash = [known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_docs).collect() for y in (0, 1)]
    short = min(len(by_hash[0]), len(by_hash[1]))
    take = [min(len(r), max(most_docs // 2, most_docs - short)) for r in by_hash]
    order = [[r["doc_id"] for r in rows[:n]] for rows, n in zip(by_hash, take, strict=True)]
    twice = set(order[1][: len(order[0]) // every]) if every else set()
    y_of = {d: y for y, ids in enumerate(order) for d in ids}
    chosen = docs.sparkSession.createDataFrame([(k,) for k in sorted(y_of)], "doc_id long")
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id", "left_semi")  # at most most_docs ids
    sample = stored(sample.groupBy("doc_id").agg(F.min("text").alias("text")), "sample")
    vocabulary = learn_words(sample)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        for batch in batches:
            out = []
            for doc, text in rows_of([batch], "doc_id", "text"):
                for copy in (False, True) if doc in twice else (False,):
                    x = passage_features(shuffled_words(text or "") if copy else text, sent.value)
                    words = x[:, N_PLAIN:].ravel()
                    places = np.flatnonzero(words)
                    out.append((doc, copy, len(x), x[:, :N_PLAIN].astype("<f2").tobytes(), places.astype("<i4").tobytes(), words[places].astype("<f2").tobytes()))
            columns = [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "copy", "n", "x", "places", "words"])

    found = stored(sample.mapInArrow(run, "doc_id long, copy boolean, n long, x binary, places binary, words binary"), "bags")
    sizes = {False: {}, True: {}}
    for r in found.select("doc_id", "copy", "n").collect():
        sizes[r["copy"]][r["doc_id"]] = r["n"]
    fits = whole_bags(sizes[False], order, most_passages)
    copied = set(whole_bags({d: sizes[True][d] for d in fits if d in sizes[True]}, order, most_passages // 10))
    fitting = F.broadcast(docs.sparkSession.createDataFrame([(k,) for k in sorted(fits)], "doc_id long"))
    bags = {
        (r["doc_id"], r["copy"]): Bag(np.frombuffer(r["x"], "<f2").reshape(-1, N_PLAIN), vocabulary.size, np.frombuffer(r["places"], "<i4"), np.frombuffer(r["words"], "<f2"))
        for r in found.join(fitting, "doc_id", "left_semi").toLocalIterator()
    }
    ids = sorted(doc for doc, copy in bags if not copy)
    for doc in ids:
        bags[doc, False].shuffled = bags[doc, True] if doc in copied else None
    model = train([bags[doc, False] for doc in ids], np.array([y_of[d] for d in ids], dtype=np.float64))
    model.vocabulary = vocabulary
    return model


def learn_words(sample: DataFrame) -> Vocabulary:
    """The words and pairs that the most documents hold; counts are a grouped aggregate."""

    def run(batches):
        for batch in batches:
            out = []
            for (text,) in rows_of([batch], "text"):
                _, words, pairs = zip(*(hashed_words(part) for part, _ in sliced(text)), strict=True)
                out.append([np.unique(np.concatenate(x)) for x in (words, pairs)])
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.list_(pa.int64())) for k in (0, 1)], names=["words", "pairs"])

    held = sample.mapInArrow(run, "words array<long>, pairs array<long>")
    least = max(2, SHARE * sample.count())

    def common(column, most):
        counts = held.select(F.explode(column).alias("h")).groupBy("h").count().filter(F.col("count") >= least)
        return np.array(sorted(r["h"] for r in counts.orderBy(F.desc("count"), "h").limit(most).collect()), dtype=np.int64)

    return Vocabulary(common("words", WORDS), common("pairs", PAIRS))


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """All columns of ``docs``, then ``score`` (double) and ``predicted`` (replacing namesakes)."""
    small_batches(docs.sparkSession)
    own = [n for n in docs.columns if n not in ("score", "predicted")]
    docs = docs.select(*(F.col(f"`{n}`") for n in own))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = [sent.value.text(t) for (t,) in rows_of([batch], "text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in own), pa.array(scores, pa.float64())], names=[*own, "score"])

    scored = docs.mapInArrow(run, docs.withColumn("score", F.lit(0.0)).schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    found = score(docs.select("doc_id", "text"), fit(docs, labels), threshold)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
