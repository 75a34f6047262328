"""Hard negatives by an inverted multi-index with certified windows.

Vectors are cut into two halves. Each half has a codebook, and a vector lies in the cell
(i, j) of its halves' nearest codewords. A codeword's radius is the largest distance of
a half that lies with it, over all rows. So no row of cell (i, j) has an inner product
with a query q larger than (q1 . c_i + |q1| r_i) + (q2 . c_j + |q2| r_j), a sum of two
half-scores. A heap visits cells in order of that sum without sorting them all: after
(i, j) come (i + 1, j) and (i, j + 1) in the orders of the two halves. The visit stops
once the next cell's bound is below all that is still wanted: certified, so the result
is exact.

It runs twice. First for an anchor's positives, which are the best rows of its label:
wanted is what the last of those found so far scores. Then for the negatives: each
positive opens a window of scores from LOW % of its own up to HIGH % of it. Wanted is
the least that some window may still take, its lower edge or the last of the best found
in it. Windows share the visit, so an anchor's rows are scored once for all of them.

Rows are dealt to blocks of BLOCK_ROWS at most, cell by cell in order; a larger cell is
dealt to several by a hash. Anchors go, in groups of GROUP_ROWS at most, to the blocks
that have a cell with a bound in reach. A task holds one block and one group, and gives
at most the wanted few rows for each anchor: no group, however many copies it has, is
held whole. Codebooks are fitted on SAMPLE rows at most; every row is in a cell.

Components x become floor(256 x). Scores are exact integers: in floating point where
every sum fits 53 bits, else in Python's integers. Ones beyond a long are ordered exactly
within a task and given as the nearest long, which then is what their windows go by.
Rows take no part with a null id, label or vector, or with a null or non-finite
component. Only vectors of the same number of dimensions are compared; empty vectors
score 0 among each other. Rows that are the same in id, label and vector are one row. An
id with different rows has each of them as a candidate, and all of them as anchors,
which give their results side by side; a positive has another id than its anchor.
Ties go to the smaller id. Anchors without positives or without rows in a window give no
rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reqmill.llm.base import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100  # percent of the positive's score
SAMPLE = 16_384  # rows that codebooks are fitted on, at most
CODEWORDS = 64  # of a half, at most: 4,096 cells
CELL_ROWS = 256  # rows for each cell, while there are fewer codewords than that
ROUNDS = 8
BLOCK_ROWS, GROUP_ROWS = 8192, 1024
LONG = 2 ** 63 - 1


# Members.


def members(vectors: DataFrame, changed: Column | None = None, label: Column | None = None) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part. Where `changed` holds, the
    label becomes `label`."""
    x = F.col("vector")
    usable = (vectors.select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
              .where("vec_id is not null and label is not null and vector is not null")
              .where(~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))))
    if changed is not None:
        usable = usable.withColumn("label", F.when(changed, label).otherwise(F.col("label")))
    return usable.distinct()


def scaled(vectors: np.ndarray) -> np.ndarray:
    """floor(256 x), as floats where these are exact, else as Python integers."""
    if not vectors.size or np.abs(vectors).max() < 2.0 ** 44:
        return np.floor(SCALE * vectors)
    return np.array([[floor(SCALE * Fraction(v)) for v in row] for row in vectors.tolist()], object)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(flat), -1 if len(flat.flatten()) else 0)


# The index.


@dataclass
class Codebooks:
    """Of one number of dimensions: codewords and radii of both halves."""
    words: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray] | None = None

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.words[0].shape[1]
        x = x.astype(float)
        return x[:, :cut], x[:, cut:]

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Codeword and distance to it, for both halves."""
        out = []
        for half, words in zip(self.halves(x), self.words):
            own = nearest(half, words)
            out += [own, np.sqrt(((half - words[own]) ** 2).sum(1))]
        return out[0], out[2], out[1], out[3]

    def half_bounds(self, q: np.ndarray) -> list[np.ndarray]:
        """The most that a half with a codeword can add to q's scores; a little more for rounding."""
        out = []
        for half, words, radii in zip(self.halves(q), self.words, self.radii):
            size = np.sqrt((half ** 2).sum(1))[:, None]
            products = half @ words.T
            reach = size * radii * (1 + 1e-9) + 1e-9 * size * np.sqrt((words ** 2).sum(1)) + 1e-3
            out.append(np.where(np.isfinite(products + reach), products + reach, np.inf))
        return out


def nearest(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    own = np.empty(len(x), int)
    for at in range(0, len(x), 4096):
        own[at:at + 4096] = ((words ** 2).sum(1) - 2 * x[at:at + 4096] @ words.T).argmin(1)
    return own


def codebook(x: np.ndarray, n: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    words = x[rng.choice(len(x), n, replace=False)]
    for _ in range(ROUNDS):
        own = nearest(x, words)
        count = np.bincount(own, minlength=n)
        sums = np.stack([np.bincount(own, x[:, k], n) for k in range(x.shape[1])], axis=1) if x.shape[1] else np.zeros((n, 0))
        words = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], words)
    return words


def fit(sample: pa.Array, n_rows: int) -> dict[int, Codebooks]:
    """Codebooks of each number of dimensions in the sample, out of n_rows rows."""
    books, sizes = {}, sample.value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(sizes).tolist():
        x = scaled(_matrix(sample.take(pa.array(np.flatnonzero(sizes == d))))).astype(float)
        n = min(CODEWORDS, len(x), max(1, int(np.sqrt(n_rows / CELL_ROWS))))
        books[d] = Codebooks((codebook(x[:, :d // 2], n, 1), codebook(x[:, d // 2:], n, 2)))
    return books


@dataclass
class Index:
    rows: DataFrame  # (vec_id, label, vector, d, i, j, block, part)
    books: dict[int, Codebooks]
    blocks: dict[int, list[tuple[int, np.ndarray, np.ndarray]]]  # of d: (block, i of its cells, j of them)


def build(rows: DataFrame) -> Index:
    """rows (vec_id, label, vector), read more than once."""
    spark = rows.sparkSession
    sample = rows.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(SAMPLE).select("vector").toArrow()
    books = fit(pa.array([], pa.list_(pa.float64())) if not len(sample) else sample.column("vector").combine_chunks(), rows.count())
    # Numbers of dimensions that the sample lacks have one codeword at the origin.
    for r in rows.select(F.size("vector").alias("d")).distinct().toLocalIterator():
        books.setdefault(r.d, Codebooks((np.zeros((1, r.d // 2)), np.zeros((1, r.d - r.d // 2)))))
    shared = spark.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column("vector").to_pylist()], int)
            for d in np.unique(sizes).tolist():
                some = batch.take(pa.array(np.flatnonzero(sizes == d)))
                i, j, a, b = shared.value[d].cells(scaled(_matrix(some.column("vector"))))
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array([d] * len(i), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(a), pa.array(b)],
                    [*some.schema.names, "d", "i", "j", "r1", "r2"])

    placed = stored(rows.mapInArrow(run, "vec_id long, label long, vector array<double>, d int, i int, j int, r1 double, r2 double"), "cells")
    # One row for each cell: CODEWORDS squared of a number of dimensions at most.
    cells = placed.groupBy("d", "i", "j").agg(F.count("*").alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).orderBy("d", "i", "j").collect()
    for d, book in books.items():
        radii = tuple(np.zeros(len(w)) for w in book.words)
        for c in cells:
            if c.d == d:
                radii[0][c.i], radii[1][c.j] = max(radii[0][c.i], c.r1), max(radii[1][c.j], c.r2)
        book.radii = radii
    dealt, blocks, block, room = [], {}, -1, 0
    for k, c in enumerate(cells):
        parts = -(-c.n // BLOCK_ROWS)
        if parts > 1 or c.n > room or not k or cells[k - 1].d != c.d:
            block, room = block + 1, BLOCK_ROWS
        first = block
        for p in range(parts):
            at = blocks.setdefault(c.d, {}).setdefault(first + p, ([], []))
            at[0].append(c.i)
            at[1].append(c.j)
        block = first + parts - 1
        room = 0 if parts > 1 else room - c.n
        dealt.append((c.d, c.i, c.j, first, parts))
    places = F.broadcast(spark.createDataFrame(dealt, "d int, i int, j int, first int, parts int"))
    put = (placed.drop("r1", "r2").join(places, ["d", "i", "j"])
           .withColumn("block", (F.col("first") + F.pmod(F.xxhash64("vec_id", "label"), F.col("parts"))).cast("int")).drop("first", "parts"))
    return Index(put, books, {d: [(b, np.array(x), np.array(y)) for b, (x, y) in own.items()] for d, own in blocks.items()})


# The visit.


def visit(first: np.ndarray, second: np.ndarray, has: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(bound, i, j) of the cells that exist (has[i, j]), by falling sum of half-bounds."""
    one, two = (-first).argsort(kind="stable"), (-second).argsort(kind="stable")
    heap = [(-(first[one[0]] + second[two[0]]), 0, 0)]
    while heap:
        bound, a, b = heapq.heappop(heap)
        if has[one[a], two[b]]:
            yield -bound, one[a], two[b]
        if b + 1 < len(two):
            heapq.heappush(heap, (-(first[one[a]] + second[two[b + 1]]), a, b + 1))
        if not b and a + 1 < len(one):
            heapq.heappush(heap, (-(first[one[a + 1]] + second[two[0]]), a + 1, 0))


class Block:
    """Rows of one block by cell."""

    def __init__(self, table: pa.Table, d: int, book: Codebooks):
        i, j = table.column("i").to_numpy(), table.column("j").to_numpy()
        order = np.lexsort((j, i))
        self.ids, self.labels = table.column("vec_id").to_numpy()[order], table.column("label").to_numpy()[order]
        self.x = scaled(_matrix(table.column("vector")))[order]
        self.most = max((abs(v) for v in (self.x.min(), self.x.max())), default=0) if self.x.size else 0
        cell = i[order].astype(int) * len(book.words[1]) + j[order]
        names, starts = np.unique(cell, return_index=True)
        self.spans = dict(zip(names.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(cell)])))
        self.width = len(book.words[1])
        self.has = np.zeros((len(book.words[0]), self.width), bool)
        self.has.ravel()[names] = True
        self.i, self.j = np.unique(names // self.width), np.unique(names % self.width)

    def cells(self, bounds: list[np.ndarray]) -> Iterator[tuple[float, int, int]]:
        """(bound, begin, end) of this block's cells."""
        for bound, a, b in visit(bounds[0][self.i], bounds[1][self.j], self.has[np.ix_(self.i, self.j)]):
            begin, end = self.spans[int(self.i[a]) * self.width + int(self.j[b])]
            yield bound, begin, end

    def scores(self, q: np.ndarray, begin: int, end: int) -> np.ndarray:
        x = self.x[begin:end]
        if x.dtype != object and q.dtype != object and self.most * (np.abs(q).max() if q.size else 0) * q.size < 2.0 ** 53:
            return (x @ q).astype(np.int64)
        exact = x.astype(object) if x.dtype == object else np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)
        return exact @ np.array([int(v) for v in q], object) if q.size else np.zeros(len(x), np.int64)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best: by falling score, then id."""
    order = sorted(range(len(scores)), key=lambda p: (-scores[p], ids[p])) if scores.dtype == object else np.lexsort((ids, -scores))
    return np.asarray(order[:k], int)


def positives(block: Block, q: np.ndarray, own: int, label: int, bounds: list[np.ndarray], k: int = POSITIVES) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids) of the block's k best rows of that label with another id."""
    scores, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for bound, begin, end in block.cells(bounds):
        if len(scores) == k and bound < scores[-1]:
            break
        fits = np.flatnonzero((block.labels[begin:end] == label) & (block.ids[begin:end] != own))
        if len(fits):
            scores, ids = np.append(scores, block.scores(q, begin, end)[fits]), np.append(ids, block.ids[begin:end][fits])
            best = best_of(scores, ids, k)
            scores, ids = scores[best], ids[best]
    return scores, ids


def in_windows(block: Block, q: np.ndarray, label: int, tops: list[int], bounds: list[np.ndarray],
               k: int = NEGATIVES) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each positive score: (scores, ids) of the block's k best rows of other labels
    in its window."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in tops]
    for bound, begin, end in block.cells(bounds):
        # A window still takes its lower edge, or what its last row scores once it is full.
        wanted = min((s[-1] if len(s) == k else -(-LOW * t // 100) for t, (s, _) in zip(tops, found)), default=np.inf)
        if bound < wanted:
            break
        fits = np.flatnonzero(block.labels[begin:end] != label)
        if not len(fits):
            continue
        scores, ids = block.scores(q, begin, end)[fits], block.ids[begin:end][fits]
        for w, t in enumerate(tops):
            inside = (scores >= -(-LOW * t // 100)) & (scores <= HIGH * t // 100)
            if inside.any():
                s, x = np.append(found[w][0], scores[inside]), np.append(found[w][1], ids[inside])
                best = best_of(s, x, k)
                found[w] = s[best], x[best]
    return found


# The search.


def _sent(anchors: DataFrame, index: Index) -> DataFrame:
    """anchors (vector, d, and `wanted`: scores below it don't count) once for each block
    that may hold such a score, with their group."""
    shared = anchors.sparkSession.sparkContext.broadcast((index.books, index.blocks))
    schema = ", ".join([*(f.simpleString().replace(":", " ", 1) for f in anchors.schema), "block int"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, blocks = shared.value
        for batch in batches:
            sizes, least = batch.column("d").to_numpy(), batch.column("wanted").to_numpy(zero_copy_only=False)
            for d in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == d)
                some = batch.take(pa.array(at))
                one, two = books[d].half_bounds(scaled(_matrix(some.column("vector"))))
                for block, i, j in blocks[d]:
                    near = np.flatnonzero((one[:, i] + two[:, j]).max(axis=1) >= least[at])
                    if len(near):
                        part = some.take(pa.array(near))
                        yield pa.RecordBatch.from_arrays([*part.columns, pa.array([block] * len(near), pa.int32())],
                                                         [*part.schema.names, "block"])
    sent = stored(anchors.mapInArrow(run, schema), "sent")
    # One row for each block.
    groups = sent.groupBy("block").agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("groups"))
    return sent.join(F.broadcast(groups), "block").withColumn("group", F.pmod(F.xxhash64("anchor"), F.col("groups")).cast("int"))


def _met(index: Index, sent: DataFrame, run, schema: str) -> DataFrame:
    """run(block, anchors) of every block and group of anchors that go there."""
    books = sent.sparkSession.sparkContext.broadcast(index.books)
    groups = F.broadcast(sent.select("block", "groups").distinct())
    rows = (index.rows.join(groups, "block").withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
            .drop("groups"))

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = pa.schema([(n, {"long": pa.int64(), "int": pa.int32()}[t]) for n, t in (c.split() for c in schema.split(", "))])
        if not left.num_rows or not right.num_rows:
            return kinds.empty_table()
        d = right.column("d")[0].as_py()
        block = Block(left, d, books.value[d])
        q = scaled(_matrix(right.column("vector")))
        one, two = books.value[d].half_bounds(q)
        out = []
        for at, row in enumerate(right.drop_columns(["vector"]).to_pylist()):
            out += run(block, q[at], row, [one[at], two[at]])
        columns = list(zip(*out)) or [[] for _ in kinds.names]
        return pa.table([pa.array([max(-LONG, min(LONG, int(v))) for v in c], k) for c, k in zip(columns, kinds.types)], schema=kinds)

    return (rows.groupBy("block", "group").cogroup(sent.drop("groups").groupBy("block", "group")).applyInArrow(task, schema))


def mine(vectors: DataFrame, is_anchor: Column) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for
    the rows of members() for which is_anchor holds, against all of them."""
    index = build(vectors)
    anchors = stored(vectors.where(is_anchor).withColumn("anchor", F.monotonically_increasing_id())
                     .withColumn("d", F.size("vector")), "anchors")

    def best_rows(block: Block, q: np.ndarray, row: dict, bounds: list[np.ndarray]) -> list[tuple]:
        return [(row["anchor"], s, x) for s, x in zip(*positives(block, q, row["vec_id"], row["label"], bounds))]

    everywhere = anchors.withColumn("wanted", F.lit(float("-inf")))
    found = _met(index, _sent(everywhere, index), best_rows, "anchor long, score long, vec_id long")
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id")
    chosen = stored(found.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= POSITIVES), "positives")

    # A window below zero is empty. The lowest edge of an anchor's windows is in reach.
    scores = chosen.where("score >= 0").groupBy("anchor").agg(F.array_distinct(F.collect_list("score")).alias("tops"))  # 5 at most
    asked = anchors.join(scores, "anchor").withColumn("wanted", F.array_min("tops") * (LOW / 100) - 1e-6 * F.array_min("tops") - 1)

    def window_rows(block: Block, q: np.ndarray, row: dict, bounds: list[np.ndarray]) -> list[tuple]:
        return [(row["anchor"], t, s, x) for t, (some, ids) in zip(row["tops"], in_windows(block, q, row["label"], row["tops"], bounds))
                for s, x in zip(some, ids)]

    inside = _met(index, _sent(asked, index), window_rows, "anchor long, top long, score long, vec_id long")
    order = Window.partitionBy("anchor", "top").orderBy(F.desc("score"), "vec_id")
    negatives = inside.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEGATIVES)
    return (chosen.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
            .join(negatives.select("anchor", F.col("top").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"),
                                   F.col("score").alias("negative_score")), ["anchor", "positive_score"])
            .join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
