"""Toxicity by multiple-instance learning.

A document is a bag of sentences and only the bag has a label. A sentence is toxic with
probability sigmoid(bias + the sum of its distinct words' weights); a document is, if any of its
sentences is: 1 - prod(1 - p), a noisy-or. The gradient of a document's likelihood falls
on the sentences that explain its label, so weights learned from whole documents also
locate the sentences that offend.

A word's weight is the sum of the weights of its features: the word itself, and its
beginnings of 4 to 8 bytes, so that endings and compounds count. Weights are
hashed into a table of fixed size.

Sentences end at . ! ? or a line break. Null and empty texts have one empty sentence
and score what the bias says. Nothing but the text is an input of a score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqmill.llm.base import map_texts

# Labelled documents of each class that the model is fitted on, at most: those with the
# smallest hashes of their ids. The driver holds their texts.
PER_CLASS = 2_500
LONGEST = 50_000  # characters of a text to learn from; longer ones are scored only
TABLE = 1 << 18  # hashed weights
CHOOSING, FITTING = 12, 60  # passes over the documents
BATCH = 256
RATE = 0.2
EVIDENCE = 2.0  # what fewer documents than these say about a feature is not learned
MEMO = 200_000  # words whose weights a task remembers

SENTENCE = re.compile(r"[^.!?\n]+")
EDGES = " \t\n\x0b\x0c\r,;:\"'()[]{}<>|*#%$&-_"


def features(word: str) -> list[int]:
    """Places in the table for the whole word and for its beginnings of 4 to 8 bytes."""
    raw = word.encode()
    crc = zlib.crc32(raw[:4])
    places = [zlib.crc32(b"=", zlib.crc32(raw)) % TABLE]
    if len(raw) >= 4:
        places.append(crc % TABLE)
        for n in range(5, min(len(raw), 8) + 1):
            crc = zlib.crc32(raw[n - 1:n], crc)
            places.append(crc % TABLE)
    return places


class Model:
    def __init__(self, bias: float, weights: np.ndarray):
        self.bias, self.weights = bias, weights
        self.known = np.flatnonzero(weights)

    def __getstate__(self) -> dict:
        return {"bias": self.bias, "known": self.known, "values": self.weights[self.known]}

    def __setstate__(self, state: dict) -> None:
        self.bias, self.known = state["bias"], state["known"]
        self.weights = np.zeros(TABLE, np.float32)
        self.weights[self.known] = state["values"]


class WordWeights(dict):
    """Word to the sum of its features' weights; emptied when full."""

    def __init__(self, model: Model):
        super().__init__()
        self.table = dict(zip(model.known.tolist(), model.weights[model.known].tolist()))

    def __missing__(self, word: str) -> float:
        if len(self) >= MEMO:
            self.clear()
        bare = word.strip(EDGES)
        weight = self[word] = sum(self.table.get(place, 0.0) for place in features(bare)) if bare else 0.0
        return weight


def sentences(text: str) -> list[tuple[int, int]]:
    """Begin and end of every sentence that holds more than white space."""
    return [m.span() for m in SENTENCE.finditer(text) if not m[0].isspace()] or [(0, len(text))]


def sentence_scores(text: str, model: Model, weights: WordWeights) -> Iterator[tuple[int, int, float]]:
    for begin, end in sentences(text):
        z = model.bias + sum(map(weights.__getitem__, set(text[begin:end].lower().split())))
        yield begin, end, 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def noisy_or(ps: Iterator[float]) -> float:
    return min(1.0, max(0.0, -math.expm1(sum(math.log1p(-min(p, 1 - 1e-12)) for p in ps))))


def _bags(texts: list[str]) -> list[list[np.ndarray]]:
    seen: dict[str, list[int]] = {}
    bags = []
    for text in texts:
        bag = []
        for begin, end in sentences(text):
            places: list[int] = []
            for word in set(text[begin:end].lower().split()):
                bare = word.strip(EDGES)
                if bare:
                    if bare not in seen:
                        seen[bare] = features(bare)
                    places += seen[bare]
            bag.append(np.sort(np.array(places, np.int64)))
        bags.append(bag)
    return bags


def _descend(bags: list[list[np.ndarray]], y: np.ndarray, weights: np.ndarray, bias: float, rounds: int,
             shrink: float, seed: int) -> tuple[np.ndarray, float]:
    """Stochastic gradients of the noisy-or likelihood with per-weight step sizes;
    shrink is a penalty on the sum of weights."""
    squares, bias_square, order = np.full(TABLE, 1e-4), 1e-4, np.random.default_rng(seed)
    for _ in range(rounds):
        todo = order.permutation(len(bags))
        for at in range(0, len(todo), BATCH):
            some = todo[at:at + BATCH]
            lengths = [len(s) for i in some for s in bags[i]]
            flat = np.concatenate([s for i in some for s in bags[i]])
            sentence = np.repeat(np.arange(len(lengths)), lengths)
            doc = np.repeat(np.arange(len(some)), [len(bags[i]) for i in some])
            z = bias + np.bincount(sentence, weights[flat], len(lengths))
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            whole = -np.expm1(np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), len(some)))
            # d(-log likelihood)/dz of a sentence: p for label 0, -p (1 - P) / P for 1.
            factor = np.where(y[some] > 0, -(1 - whole) / np.maximum(whole, 1e-9), 1.0)
            grad = p * factor[doc] / len(some)
            g = np.bincount(flat, grad[sentence], TABLE)
            touched = np.flatnonzero((g != 0) | (weights != 0))
            squares[touched] += g[touched] ** 2
            rate = RATE / np.sqrt(squares[touched])
            moved = weights[touched] - rate * g[touched]
            weights[touched] = np.sign(moved) * np.maximum(0, np.abs(moved) - rate * shrink)
            bias_square += grad.sum() ** 2
            bias -= RATE * grad.sum() / math.sqrt(bias_square)
    return weights, bias


def fit(texts: list[str], labels: list[int], seed: int = 7) -> Model:
    """First with a penalty that leaves most weights at zero, then the weights that
    remain without it, so that the penalty chooses features but doesn't flatten them."""
    y = np.array(labels, float)
    if not 0 < y.sum() < len(y):
        return Model(-10.0 if not y.sum() else 10.0, np.zeros(TABLE, np.float32))
    bags = _bags(texts)
    # At the start every document is toxic with the labels' share.
    typical = max(1.0, float(np.median([len(b) for b in bags])))
    bias = math.log(math.expm1(-math.log1p(-y.mean()) / typical))
    weights, bias = _descend(bags, y, np.zeros(TABLE), bias, CHOOSING, EVIDENCE / len(bags), seed)
    kept = weights > 0  # what speaks for a label of 0 is the absence of these
    bags = [[s[kept[s]] for s in bag] for bag in bags]
    weights, bias = _descend(bags, y, np.where(kept, weights, 0), bias, FITTING, 0.0, seed)
    return Model(float(bias), weights.astype(np.float32))


def train(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = PER_CLASS) -> Model:
    """Fit on labelled ones among docs for which `learn` (of doc_id) holds, at most
    per_class of each label, of LONGEST characters at most. A doc_id with labels that
    differ counts as toxic; of several texts of an id the one with the smallest hash is
    read. Without documents of both labels every score says the one there is, and 0
    without any."""
    label = labels.where(learn & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    label = label.select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"), F.xxhash64("doc_id").alias("_order"))
    # Only labels of documents that are here count. No text is shuffled for that.
    short = docs.where(F.length(F.coalesce("text", F.lit(""))) <= LONGEST)
    label = label.join(short.select("doc_id"), "doc_id", "left_semi")
    # Two bounded sorts of ids alone.
    chosen = label.where("toxic = 0").orderBy("_order", "doc_id").limit(per_class).unionByName(
        label.where("toxic = 1").orderBy("_order", "doc_id").limit(per_class))
    ids = {r.doc_id: r.toxic for r in chosen.select("doc_id", "toxic").collect()}  # 2 * per_class at most
    small = docs.sparkSession.createDataFrame(list(ids.items()), labels.select("doc_id", F.col("toxic").cast("int")).schema)
    text = F.coalesce("text", F.lit(""))
    rows = (short.select("doc_id", text.alias("text")).join(F.broadcast(small), "doc_id")
            .groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text")).collect())
    rows.sort(key=lambda r: r.doc_id)
    return fit([r.text for r in rows], [ids[r.doc_id] for r in rows])


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and score, between 0 and 1, of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        fitted = shared.value
        weights = WordWeights(fitted)

        def work(texts: list) -> dict:
            return {"score": pa.array([noisy_or(p for _, _, p in sentence_scores((x or b"").decode(), fitted, weights))
                                       for x in texts], pa.float64())}
        return work
    return map_texts(docs, make, "score double", keep=keep)


def locate(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """(doc_id, begin, end, sentence, p) of every sentence with p of at least `least`;
    begin and end count code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.select("doc_id").schema[0].simpleString().replace(":", " ", 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        weights = WordWeights(fitted)
        for batch in batches:
            found = [(doc_id, begin, end, text[begin:end], p)
                     for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                     for begin, end, p in sentence_scores(text or "", fitted, weights) if p >= least]
            columns = list(zip(*found)) or [[]] * 5
            kinds = [batch.schema.field("doc_id").type, pa.int32(), pa.int32(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["doc_id", "begin", "end", "sentence", "p"])
    return docs.select("doc_id", "text").mapInArrow(run, f"{kind}, begin int, end int, sentence string, p double")
