"""Text quality from random-indexing word vectors and a small network.

Every word has a sparse random index vector, derived from its hash. A word's
vector is its own index vector plus what its surroundings in a sample add up to,
so that words of like surroundings come close. Words too rare in the sample to
have surroundings of their own take those of their class (upper case, digits and so
on), and keep their own index vector. A document is the mean and
the spread of its words' vectors. A network of two layers turns that into a
probability, whose temperature is set on documents the network has not seen.

What is learned comes from a bounded sample of labelled documents: at most
SAMPLE of them, and the surroundings of VOCABULARY words. Scoring reads every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadledger.session import scratch, stage_in

SAMPLE = 6000
VOCABULARY = 2048
DIMENSIONS = 64
NONZERO = 6
WINDOW = 2
HIDDEN = 32
CHUNK_WORDS = 1 << 16
WORD = re.compile(r"\w+|[^\w\s]+")
REPEAT = 4  # a word that stood within so many words before it is one said again
# What stands for a word said again, and for words outside the vocabulary.
CLASSES = ("<again>", "<upper>", "<title>", "<lower>", "<mixed>", "<digits>", "<signs>")


def class_of(word: str) -> str:
    if word.isdigit():
        return "<digits>"
    if not (word[0].isalnum() or word[0] == "_"):
        return "<signs>"
    if len(word) > 1 and word.isupper():
        return "<upper>"
    if word.islower():
        return "<lower>"
    return "<title>" if word.istitle() else "<mixed>"


def marks_of(word: str) -> int:
    """The word's hash, of which each of NONZERO groups of bits chooses a place and a sign."""
    return xxhash.xxh3_64_intdigest(word.encode()) >> 16 | 1 << 48


def places_and_signs(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word NONZERO places, one in each part of the vector, and their signs."""
    bits = marks[:, None] >> (8 * np.arange(NONZERO)) & 255
    width = DIMENSIONS // NONZERO
    return np.arange(NONZERO) * width + (bits >> 1) % width, 1 - 2 * (bits & 1)


def index_vector(word: str) -> np.ndarray:
    """A few ones and minus ones at places that the word's hash chooses."""
    places, signs = places_and_signs(np.array([marks_of(word)]))
    vector = np.zeros(DIMENSIONS, np.float32)
    vector[places[0]] = signs[0]
    return vector


class WordIds(dict):
    """Number of a word in the vocabulary, else that of its class with the word's marks above it."""

    BITS = 14

    def __init__(self, names: list[str]) -> None:
        super().__init__({name: n for n, name in enumerate(names)})
        self.names, self.limit = names, len(names) + 100_000
        # Signs repeat in any text.
        self.sign = np.array([n == "<signs>" or n not in CLASSES and class_of(n) == "<signs>" for n in names])

    def __missing__(self, word: str) -> int:
        number = self[class_of(word)] | marks_of(word) << self.BITS
        if len(self) < self.limit:
            self[word] = number
        return number


def _numbers(words: list[str], ids: WordIds, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of words, their marks (0 in the vocabulary, and for a word said again), and
    what the next words of the text must know: the last few words."""
    both = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    numbers, marks = (both & (1 << ids.BITS) - 1).astype(np.int32), both >> ids.BITS
    same = np.concatenate([before, np.fromiter(map(hash, words), np.int64, len(words))])
    again = np.zeros(len(same), bool)
    for gap in range(1, min(REPEAT, len(same) - 1) + 1):
        again[gap:] |= same[gap:] == same[:-gap]
    said = again[len(before) :] & ~ids.sign[numbers]
    numbers[said], marks[said] = ids["<again>"], 0
    return numbers, marks, same[-REPEAT:]


def word_numbers(text: str, ids: WordIds) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers and marks of the words of a text, in chunks that know the words before them."""
    last = np.empty(0, np.int64)
    if len(text) <= CHUNK_WORDS:
        if words := WORD.findall(text):
            yield _numbers(words, ids, last)[:2]
        return
    held: list[str] = []
    for match in WORD.finditer(text):
        held.append(match.group())
        if len(held) == CHUNK_WORDS:
            numbers, marks, last = _numbers(held, ids, last)
            yield numbers, marks
            held = []
    if held:
        yield _numbers(held, ids, last)[:2]


def pooled(text: str | None, ids: WordIds, vectors: np.ndarray) -> np.ndarray:
    """Mean and standard deviation of the vectors of a text's words, zeros without words.

    The vector of a word with marks is that of its class and its own index vector.
    """
    counts = np.zeros(len(vectors), np.int64)
    own = np.zeros(len(CLASSES) * DIMENSIONS, np.int64)  # sums of index vectors by class
    hits = np.zeros(DIMENSIONS, np.int64)
    for numbers, marks in word_numbers(text or "", ids):
        counts += np.bincount(numbers, minlength=len(vectors))
        rare = np.flatnonzero(marks)
        if len(rare):
            places, signs = places_and_signs(marks[rare])
            keys = (numbers[rare][:, None] * DIMENSIONS + places).ravel()
            own += np.bincount(keys, signs.ravel(), minlength=len(own)).astype(np.int64)
            hits += np.bincount(places.ravel(), minlength=DIMENSIONS)
    n = counts.sum()
    if not n:
        return np.zeros(2 * DIMENSIONS, np.float32)
    there = np.flatnonzero(counts)
    share = (counts[there] / n).astype(np.float32)
    mean = share @ vectors[there]
    square = share @ (vectors[there] ** 2)
    if hits.any():
        mine = (own.reshape(len(CLASSES), DIMENSIONS) / (n * np.sqrt(NONZERO))).astype(np.float32)
        mean = mean + mine.sum(0)
        square = square + 2 * (mine * vectors[: len(CLASSES)]).sum(0) + (hits / (n * NONZERO)).astype(np.float32)
    return np.concatenate([mean, np.sqrt(np.maximum(square - mean**2, 0))])


@dataclass
class Network:
    """One hidden layer; ``temperature`` divides the last layer's output."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        # Not by matrix product: that may round a row by where it stands among others.
        hidden = np.einsum("nd,dh->nh", (x - self.mean) / self.scale, self.w1) + self.b1
        return np.einsum("nh,h->n", np.maximum(hidden, 0), self.w2) + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, epochs: int = 60, rate: float = 3e-3) -> Network:
    """Fit by Adam; every fifth row sets the temperature instead."""
    rng = np.random.default_rng(11)
    order = rng.permutation(len(x))
    held, used = order[::5], np.setdiff1d(order, order[::5])
    mean, scale = x[used].mean(0), x[used].std(0) + 1e-3
    net = Network(mean, scale, rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), 0.0)
    moments = [[0.0, 0.0] for _ in range(4)]
    step = 0
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(used), max(1, len(used) // 64)):
            step += 1
            z = (x[batch] - net.mean) / net.scale
            before = z @ net.w1 + net.b1
            hidden = np.maximum(before, 0)
            p = 1 / (1 + np.exp(-np.clip(hidden @ net.w2 + net.b2, -40, 40)))
            out = (p - y[batch]) / len(batch)
            back = np.outer(out, net.w2) * (before > 0)
            slopes = [z.T @ back + 1e-3 * net.w1, back.sum(0), hidden.T @ out + 1e-3 * net.w2, out.sum()]
            moved = []
            for m, slope in zip(moments, slopes):
                m[0] = 0.9 * m[0] + 0.1 * slope
                m[1] = 0.999 * m[1] + 0.001 * slope**2
                moved.append(rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8))
            net.w1 -= moved[0]
            net.b1 -= moved[1]
            net.w2 -= moved[2]
            net.b2 -= moved[3]
    if len(held):
        net.temperature = best_temperature(net.logits(x[held]), y[held])
    return net


def best_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss on rows that training has not seen."""
    choices = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    loss = [np.mean(np.logaddexp(0, np.where(y > 0, -logits, logits) / t)) for t in choices]
    return float(choices[int(np.argmin(loss))])


@dataclass
class Model:
    names: list[str]
    vectors: np.ndarray
    network: Network | None
    prior: float  # the score where there is nothing to learn from

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.prior) if self.network is None else self.network.probability(x)


def held_out(doc_id: Column) -> Column:
    """Whether a document's label must not be learned; a null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, size: int) -> DataFrame:
    """(text, y) of at most ``size`` labelled documents that may be learned from.

    Those with the least hashes of doc_id are taken. Null, conflicting and held-out
    labels are left out. Of a doc_id that several rows of ``docs`` have, the least text counts.
    The sampled ids, bounded by ``size``, are broadcast.
    """
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    known = labels.select(doc_id, F.col(label).cast("int").alias("y")).filter(
        "doc_id IS NOT NULL AND y IN (0, 1)"
    )
    known = known.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("most"))
    chosen = known.filter("y = most").orderBy(F.xxhash64("doc_id"), "doc_id").limit(size).select("doc_id", "y")
    texts = docs.select(doc_id, F.col("text").cast("string").alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("text", "y")


def learn_vectors(sample: DataFrame) -> tuple[list[str], np.ndarray]:
    """Vocabulary and word vectors of a sample: one small matrix per task comes back."""
    words = sample.select(F.explode(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]+"), F.lit(0))).alias("word"))
    top = words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(VOCABULARY).collect()
    names = [*CLASSES, *(r["word"] for r in top if r["count"] > 2)]
    size = len(names)

    def contexts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds(names)
        near = np.zeros((WINDOW, size * size), np.int64)
        for part in parts:
            for text in part.column(0).to_pylist():
                for numbers, _ in word_numbers(text or "", ids):
                    for gap in range(1, WINDOW + 1):
                        key = numbers[:-gap].astype(np.int64) * size + numbers[gap:]
                        found, times = np.unique(key, return_counts=True)
                        near[gap - 1, found] += times
        index = np.stack([index_vector(name) for name in names])
        total = np.zeros((size, DIMENSIONS))
        for gap in range(WINDOW):
            weight = np.log1p(near[gap].reshape(size, size).astype(np.float32))
            # What stands before a word and what stands after it are told apart.
            total += weight @ np.roll(index, gap + 1, 1) + weight.T @ np.roll(index, -gap - 1, 1)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], "binary")], ["total"])

    sums = np.zeros((size, DIMENSIONS))
    for row in sample.select("text").repartition(4).mapInArrow(contexts, "total binary").collect():
        sums += np.frombuffer(row["total"]).reshape(size, DIMENSIONS)
    length = np.linalg.norm(sums, axis=1, keepdims=True)
    own = np.stack([index_vector(name) for name in names]) / np.sqrt(NONZERO)
    return names, (sums / np.maximum(length, 1e-9) + own).astype(np.float32)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", size: int = SAMPLE) -> Model:
    """Fit word vectors and network to a bounded sample of labelled documents.

    Without both labels in the sample there is no network and every score is
    the smoothed share of label 1.
    """
    with scratch(docs.sparkSession, "labelled") as folder:
        sample = stage_in(labelled_sample(docs, labels, label, size), folder, "sample")
        names, vectors = learn_vectors(sample)

        def features(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids = WordIds(names)
            for part in parts:
                rows = [pooled(t, ids, vectors).tobytes() for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(rows, "binary"), part.column(1)], ["x", "y"])

        dealt = sample.repartition(4)
        rows = sorted(map(tuple, dealt.mapInArrow(features, "x binary, y int").collect()))
    y = np.array([r[1] for r in rows], np.float64)
    prior = float((y.sum() + 1) / (len(y) + 2))
    network = None
    if len(rows) >= 10 and 0 < y.sum() < len(y):
        x = np.stack([np.frombuffer(r[0], np.float32) for r in rows])
        network = train(x.astype(np.float64), y)
    return Model(names, vectors, network, prior)


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a ``score`` from 0 to 1 per row; a column of that name is replaced.

    A null or empty text is scored as one without words.
    """

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        ids = _ids_of(tuple(model.names))
        x = np.stack([pooled(t.as_py(), ids, model.vectors) for t in texts]) if len(texts) else np.zeros((0, 2 * DIMENSIONS))
        return pa.array(model.scores(x).astype(np.float64))

    return docs.withColumn("score", score(F.col(text).cast("string")))


_KNOWN: dict[tuple[str, ...], WordIds] = {}


def _ids_of(names: tuple[str, ...]) -> WordIds:
    """The ids of a vocabulary, once per worker."""
    if names not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[names] = WordIds(list(names))
    return _KNOWN[names]


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is ``least`` or more, with their own columns only."""
    narrow = F.struct(*docs.columns).alias("row")
    wrapped = docs.select(narrow, F.col("text").cast("string").alias("text"))
    return scored(wrapped, model).filter(F.col("score") >= least).select("row.*")


def judge_documents(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    A null or empty text is scored as one without words, a text of any length as a
    whole. Repeated rows are scored each on their own and alike. A null doc_id stays
    null and is not held out. Without labels every score is the same; an empty table gives no
    rows. Columns other than doc_id and text are not read.
    """
    model = learn(docs, labels, size=size)
    doc_id = F.col("doc_id").cast("long")
    narrow = docs.select(doc_id.alias("doc_id"), F.col("text").cast("string").alias("text"))
    return scored(narrow, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
