"""Quality scores from random Fourier features of document statistics.

Each text is turned into a few statistics. Random cosines of the standardised
statistics approximate a Gaussian kernel; ridge regression on them is fitted from
normal equations that every partition sums over its own rows, so training reads all
labelled documents and moves only matrices of a fixed size. Scores become
probabilities through isotonic regression of the labels on binned raw scores.

Null and empty texts have the statistics of no words and a score like any other. With
no labels, or labels of one kind only, every score is the share of label 1 (0.5 without
any). Rows that repeat an id are scored each for itself; labels that differ for one id
count as their mean.
"""

from __future__ import annotations

import functools
import operator
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqmill.llm.base import map_texts, stored

FEATURES = 256  # random cosines
WIDTH = 2.5  # of the kernel, in standard deviations
RIDGE = 1e-3  # of the number of rows
BINS = 400  # of raw scores, for calibration
CLIP = 6.0  # standard deviations

SYMBOL = re.compile(r"[^\w\s.,;:!?'\"()-]")
STATS = ("log_words", "word_length", "distinct", "top_word", "repeat_next", "trigram_repeats", "symbols",
         "exclaims", "bars", "upper", "digits", "stops", "line_words", "dup_lines", "word_spread")


def statistics(text: str) -> list[float]:
    words = text.split()
    n, size = len(words), max(1, len(text))
    lines = [x for x in text.split("\n") if x.strip()]
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), float, n)
    trigrams = len(set(zip(words, words[1:], words[2:]))) / (n - 2) if n > 2 else 1.0
    return [
        float(np.log1p(n)), float(lengths.mean()) if n else 0.0, len(counts) / n ** 0.8 if n else 0.0,
        max(counts.values()) / n if n else 0.0, sum(map(operator.eq, words, words[1:])) / max(1, n - 1),
        1 - trigrams, len(SYMBOL.findall(text)) / size, text.count("!") / max(1, n), counts["|"] / max(1, n),
        sum(map(str.isupper, text)) / size if not text.islower() else 0.0, sum(map(text.count, "0123456789")) / size,
        sum(map(text.count, ".?")) / max(1, n), float(np.log1p(n / max(1, len(lines)))),
        1 - len(set(lines)) / len(lines) if lines else 0.0, float(lengths.std()) if n else 0.0]


def measured(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and stats, an array of the statistics, of every row."""
    def make():
        return lambda texts: {"stats": pa.array([statistics((x or b"").decode()) for x in texts], pa.list_(pa.float64()))}
    return map_texts(docs, make, "stats array<double>", keep=keep)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    turns: np.ndarray  # statistic, cosine
    phases: np.ndarray
    weights: np.ndarray
    levels: np.ndarray  # calibrated probability of each bin of raw scores

    def cosines(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -CLIP, CLIP)
        waves = np.sqrt(2 / FEATURES) * np.cos(z @ self.turns + self.phases)
        return np.hstack([waves, np.ones((len(waves), 1))])

    def bins(self, stats: np.ndarray) -> np.ndarray:
        """Bins of equal width over raw scores from -0.5 to 1.5."""
        raw = self.cosines(stats) @ self.weights
        return np.clip(np.floor((raw + 0.5) / 2 * BINS), 0, BINS - 1).astype(int)


def _scores(model: Model | float, stats: list[list[float]]) -> pa.Array:
    if isinstance(model, float) or not stats:
        return pa.array([model] * len(stats), pa.float64())
    return pa.array(model.levels[model.bins(np.array(stats))], pa.float64())


def isotonic(n: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Rising share of ones for each bin: neighbours that fall are pooled. Bins without
    rows lie between their neighbours."""
    filled = np.flatnonzero(n)
    blocks: list[list[float]] = []  # rows, ones, how many filled bins
    for i in filled:
        blocks.append([n[i], ones[i], 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    shares = np.concatenate([np.full(int(k), y / m) for m, y, k in blocks])
    return np.interp(np.arange(len(n)), filled, shares)


def _summed(rows: DataFrame, make) -> np.ndarray:
    """Sum of the vectors that each partition makes of its rows, in a few steps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                stats = np.array(batch.column("stats").to_pylist())
                part = make(stats, batch.column("label").to_numpy(zero_copy_only=False))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"v": pa.array([total.astype("<f8").tobytes()], pa.binary())})

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for v in batch.column("v").to_pylist():
                part = np.frombuffer(v, "<f8")
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"v": pa.array([total.tobytes()], pa.binary())})

    # One vector per partition; added as they arrive to 16, which the driver adds.
    sums = rows.select("stats", "label").mapInArrow(run, "v binary").repartition(16).mapInArrow(fold, "v binary").collect()
    return functools.reduce(operator.add, [np.frombuffer(r.v, "<f8") for r in sums]) if sums else np.zeros(0)


def fit(rows: DataFrame, seed: int = 5) -> Model | float:
    """rows: (stats, label). The share of label 1 where there is nothing to tell apart."""
    s = len(STATS)
    sums = _summed(rows, lambda x, y: np.concatenate([[len(x), y.sum()], x.sum(0), (x * x).sum(0)]))
    if not len(sums) or not 0 < sums[1] < sums[0]:
        return float(sums[1] / sums[0]) if len(sums) else 0.5
    mean = sums[2:2 + s] / sums[0]
    scale = np.sqrt(np.maximum(sums[2 + s:] / sums[0] - mean ** 2, 0))
    rng = np.random.default_rng(seed)
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), rng.normal(0, 1 / WIDTH, (s, FEATURES)),
                  rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1), np.zeros(BINS))
    f = FEATURES + 1

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = model.cosines(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    sums = np.asarray(_summed(rows, equations))
    gram, right = sums[:f * f].reshape(f, f), sums[f * f:]
    model.weights = np.linalg.solve(gram + RIDGE * gram[-1, -1] * np.diag([1.0] * FEATURES + [0.0]) / FEATURES, right)

    def histogram(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = model.bins(x)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, BINS)])

    sums = _summed(rows, histogram)
    model.levels = isotonic(sums[:BINS], sums[BINS:])
    return model


def labelled(stats: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """(stats, label) of every document with a label for which `learn` (of doc_id) holds."""
    label = (labels.where(learn & F.col("quality").isNotNull()).groupBy("doc_id")
             .agg(F.avg(F.col("quality").cast("double")).alias("label")))
    return stats.join(label, "doc_id").select("stats", "label")


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> Model | float:
    """Fit on the labelled ones among docs. Texts are measured where they lie; labels are
    joined to the measurements."""
    return fit(stored(labelled(measured(docs), labels, learn), "training"))


def score(stats: DataFrame, model: Model | float) -> DataFrame:
    """stats with score, between 0 and 1, in place of the statistics."""
    shared = stats.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in stats.columns if c != "stats"]
    schema = ", ".join([*(f.simpleString().replace(":", " ", 1) for f in stats.select(*kept).schema), "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _scores(shared.value, batch.column("stats").to_pylist())
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in kept} | {"score": scores})

    return stats.mapInArrow(run, schema)


def score_texts(docs: DataFrame, model: Model | float, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """score() of measured(), in one pass over the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda texts: {"score": _scores(shared.value, [statistics((x or b"").decode()) for x in texts])}
    return map_texts(docs, make, "score double", keep=keep)
