"""Language identification by a convolutional network over bytes.

A text's UTF-8 bytes are cut into windows of fixed length. Each byte becomes a short
vector; filters of several widths run over a window, the largest response of each
filter is kept, and a softmax layer turns these into probabilities. A text's
probabilities are the mean of its windows', each weighted by its share of the bytes, so
every byte of a text counts and a passage in another language has its own share. The network is trained in numpy on windows of labelled
texts; some are shortened at random, as short texts are.

The prediction is UND with score 0 where a text is null or has no letter, or where no
language could be learned. Rows that repeat an id are predicted each for itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reqmill.llm.base import map_texts

UND = "und"
LENGTH = 256  # bytes in a window
WIDTHS = (2, 3, 4, 5)
FILTERS = 10  # of each width
EMBED = 6
# Bounds of what the network is trained on: labelled documents of each language, those
# with the smallest hashes of their ids, and windows of each of these.
PER_LANG = 500
PER_DOC = 4
PARTS = 16
EPOCHS = 14
BATCH = 64
BLOCK = 64  # windows scored at a time
RATE = 0.01


@dataclass
class Network:
    langs: list[str]
    embed: np.ndarray  # byte, vector; the last row is for padding and zero
    conv: np.ndarray  # widest filter x vector, filter
    bias: np.ndarray
    out: np.ndarray  # filter, language
    out_bias: np.ndarray


def windows(raw: bytes) -> np.ndarray:
    """The text as rows of LENGTH byte numbers, 256 where there is none."""
    n = max(1, -(-len(raw) // LENGTH))
    padded = np.full(n * LENGTH, 256, np.int16)
    padded[:len(raw)] = np.frombuffer(raw, np.uint8)
    return padded.reshape(n, LENGTH)


def _responses(net: Network, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inputs under the widest filter at each place, and every filter's response."""
    n, wide = len(rows), max(WIDTHS)
    seen = np.zeros((n, LENGTH + wide - 1, EMBED), np.float32)
    seen[:, :LENGTH] = net.embed[rows]
    flat = np.lib.stride_tricks.sliding_window_view(seen.reshape(n, -1), wide * EMBED, axis=1)[:, ::EMBED]
    flat = np.ascontiguousarray(flat).reshape(n * LENGTH, wide * EMBED)
    return flat, (flat @ net.conv).reshape(n, LENGTH, -1)


def logits(net: Network, rows: np.ndarray) -> np.ndarray:
    parts = []
    for at in range(0, len(rows), BLOCK):
        _, response = _responses(net, rows[at:at + BLOCK])
        parts.append(np.maximum(response.max(axis=1) + net.bias, 0) @ net.out + net.out_bias)
    return np.concatenate(parts)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: np.ndarray, labels: list[str], seed: int = 11) -> Network:
    """Train with Adam on the cross-entropy of single windows."""
    rng = np.random.default_rng(seed)
    langs = sorted(set(labels))
    wide, f = max(WIDTHS), len(WIDTHS) * FILTERS
    allowed = np.zeros((wide, EMBED, f), np.float32)
    for k, width in enumerate(WIDTHS):
        allowed[:width, :, k * FILTERS:(k + 1) * FILTERS] = 1
    allowed = allowed.reshape(-1, f)
    net = Network(langs, rng.normal(0, 0.5, (257, EMBED)).astype(np.float32),
                  (rng.normal(0, 0.3, allowed.shape) * allowed).astype(np.float32), np.zeros(f, np.float32),
                  rng.normal(0, 0.2, (f, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32))
    net.embed[256] = 0
    if len(langs) < 2:
        return net
    y = np.array([langs.index(x) for x in labels])
    share = np.bincount(y) / len(y)
    params = [net.embed, net.conv, net.bias, net.out, net.out_bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(rows))
        rate = RATE * (1 - epoch / EPOCHS)
        for at in range(0, len(order), BATCH):
            some = order[at:at + BATCH]
            x = rows[some].copy()
            short = rng.random(len(some)) < 0.3
            cut = np.where(short, rng.integers(6, LENGTH, len(some)), LENGTH)
            x[np.arange(LENGTH) >= cut[:, None]] = 256
            flat, response = _responses(net, x)
            best = response.argmax(axis=1)
            top = np.take_along_axis(response, best[:, None], 1)[:, 0] + net.bias
            hidden = np.maximum(top, 0)
            p = softmax(hidden @ net.out + net.out_bias)
            p[np.arange(len(some)), y[some]] -= 1
            d = (p / share[y[some], None] / len(langs) / len(some)).astype(np.float32)
            d_hidden = (d @ net.out.T) * (top > 0)
            place = (np.arange(len(some))[:, None] * LENGTH + best).ravel()
            under = flat[place].reshape(len(some), f, -1)
            d_conv = np.einsum("nfk,nf->kf", under, d_hidden) * allowed
            back = (d_hidden[:, :, None] * net.conv.T[None]).reshape(-1, wide, EMBED)
            padded = np.pad(x, ((0, 0), (0, wide - 1)), constant_values=256)
            bytes_under = np.stack([padded[np.arange(len(some))[:, None], best + j].ravel() for j in range(wide)], axis=1)
            d_embed = np.zeros_like(net.embed)
            np.add.at(d_embed, bytes_under.ravel(), back.reshape(-1, EMBED))
            d_embed[256] = 0
            step += 1
            grads = [d_embed, d_conv, d_hidden.sum(0), hidden.T @ d, d.sum(0)]
            for param, grad, (m, v) in zip(params, grads, moments):
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                param -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return net


def _sampled(raw: bytes, doc_id: object) -> list[bytes]:
    """PER_DOC windows from anywhere in the text, the same in every run."""
    rng = np.random.default_rng(zlib.crc32(str(doc_id).encode()))
    starts = rng.integers(0, max(1, len(raw) - LENGTH + 1), PER_DOC if len(raw) > LENGTH else 1)
    return [raw[s:s + LENGTH] for s in starts.tolist()]


def train(docs: DataFrame, learn: Column, per_lang: int = PER_LANG) -> Network:
    """Fit on documents with a lang and some text for which `learn` (of doc_id) holds,
    at most per_lang of each language."""
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = known.select("doc_id", "lang").distinct().withColumn("_part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(PARTS)))
    # First the smallest of each part of a language, then of those: a language that
    # most documents share is ranked in PARTS tasks and at most PARTS * per_lang rows.
    for keys in (["lang", "_part"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        some = some.withColumn("_rank", rank).where(F.col("_rank") <= per_lang).drop("_rank")
    chosen = some.select("doc_id", "lang")
    kind = docs.select("doc_id").schema[0].simpleString().replace(":", " ", 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "lang", "text"))
            found = [(doc_id, lang, w) for doc_id, lang, raw in zip(*columns) for w in _sampled(raw, doc_id)]
            ids, langs, parts = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, batch.schema.field("doc_id").type),
                                              "lang": pa.array(langs, pa.string()), "part": pa.array(parts, pa.binary())})

    texts = known.select("doc_id", "lang", F.col("text").cast("binary").alias("text"))
    # Rows that repeat an id and lang are one document, with the smallest text hash.
    once = (texts.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang")
            .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text")))
    rows = sorted(once.mapInArrow(run, f"{kind}, lang string, part binary").collect())
    if not rows:
        return fit(np.zeros((0, LENGTH), np.int16), [])
    return fit(np.concatenate([windows(r.part) for r in rows]), [r.lang for r in rows])


def predict(docs: DataFrame, net: Network, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, lang_pred and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def make():
        fitted = shared.value

        def work(texts: list) -> dict:
            known = [i for i, t in enumerate(texts) if fitted.langs and t and any(map(str.isalpha, t.decode()))]
            langs, scores = [UND] * len(texts), [0.0] * len(texts)
            for at in range(0, len(known), 16):
                some = known[at:at + 16]
                cut = [windows(texts[i]) for i in some]
                rows = np.concatenate(cut)
                votes = softmax(logits(fitted, rows)) * (rows < 256).sum(axis=1, keepdims=True)
                doc = np.repeat(np.arange(len(some)), [len(c) for c in cut])
                total = np.stack([np.bincount(doc, votes[:, k]) for k in range(votes.shape[1])], axis=1)
                p = np.clip(total / total.sum(axis=1, keepdims=True), 0, 1)
                for i, best, value in zip(some, p.argmax(axis=1), p.max(axis=1)):
                    langs[i], scores[i] = fitted.langs[best], float(value)
            return {"lang_pred": langs, "score": pa.array(scores, pa.float64())}
        return work
    return map_texts(docs, make, "lang_pred string, score double", keep=keep)
