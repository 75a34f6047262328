"""Nearest neighbours by probing lists with an adaptive scan of dimensions.

Vectors are dealt to lists by their nearest centroid; a query looks into the lists of
its nearest centroids only. Within a list, vectors are turned by a random rotation and
kept in blocks of columns. A candidate's distance over the first m of d rotated columns
estimates the whole: if it is larger than the k-th best distance so far by more than
chance allows (1 + LEEWAY / sqrt(m) times, a test whose error falls with LEEWAY), the
candidate is abandoned. Those that reach the last block get their exact distance from
the original vectors, in double precision.

Vectors take no part if their id is null, if they are null, zero, or hold null or
non-finite numbers, or if they have another number of dimensions than most. An id that
is repeated counts once, with its smallest vector. Equal vectors are searched and
listed once, with the k + 1 smallest of their ids, so no number of copies makes a list
or a query heavy. Ties go to the smaller id. The centroids are fitted on a bounded
sample; every vector is listed. How many lists a query looks into is measured on the
same sample: as many as hold RECALL of the true neighbours of some of its vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reqmill.llm.base import stored

SAMPLE = 32_768  # distinct vectors that the centroids are fitted on, at most
LIST_ROWS = 1024  # distinct vectors for each list, while there are fewer lists than
MAX_LISTS = 4096
RECALL = 0.96  # wanted of the lists that are looked into
MEASURED = 200  # vectors of the sample whose true neighbours say how many these are
GROUP_ROWS = 4096  # vectors of a list that one task scans, and queries it scans them for
BLOCK = 8  # columns
FIRST = 64  # vectors measured in full before any is abandoned
CHUNK = 512
LEEWAY = 2.1
ROUNDS = 8  # of fitting the centroids


@dataclass
class Index:
    lists: DataFrame  # (list, vector, ids)
    centroids: np.ndarray
    rotation: np.ndarray
    probes: int
    k: int


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part, one for each id."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = (vectors.select("vec_id", F.col("embedding").alias("vector"))
              .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~bad & F.exists("vector", lambda x: x != 0)))
    most = usable.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return (usable.where(F.size("vector") == (most.d if most else 0))
            .groupBy("vec_id").agg(F.min("vector").alias("vector")))


def _matrix(column: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)


def _near(x: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the n nearest centroids, nearest first."""
    gap = (centroids ** 2).sum(1) - 2 * x @ centroids.T
    if n >= len(centroids):
        return gap.argsort(axis=1, kind="stable")
    some = np.argpartition(gap, n - 1, axis=1)[:, :n]
    return np.take_along_axis(some, np.take_along_axis(gap, some, 1).argsort(axis=1, kind="stable"), 1)


def _centroids(sample: np.ndarray, n: int, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), n, replace=False)]
    for _ in range(ROUNDS):
        own = np.concatenate([_near(sample[at:at + 2048], centres, 1)[:, 0] for at in range(0, len(sample), 2048)])
        count = np.bincount(own, minlength=n)
        sums = np.stack([np.bincount(own, sample[:, j], n) for j in range(sample.shape[1])], axis=1)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def _probes(sample: np.ndarray, centroids: np.ndarray, k: int, recall: float, seed: int = 9) -> int:
    """The fewest lists that hold `recall` of the k nearest in the sample, on average."""
    own = np.concatenate([_near(sample[at:at + 2048], centroids, 1)[:, 0] for at in range(0, len(sample), 2048)])
    positions = []
    for i in np.random.default_rng(seed).choice(len(sample), min(MEASURED, len(sample)), replace=False):
        gap = ((sample - sample[i]) ** 2).sum(axis=1)
        gap[i] = np.inf
        true = own[gap.argsort(kind="stable")[:min(k, len(sample) - 1)]]
        place = _near(sample[i:i + 1], centroids, len(centroids))[0].argsort()
        positions += place[true].tolist()
    held = np.bincount(np.array(positions, int), minlength=len(centroids)).cumsum() / max(1, len(positions))
    return int(np.searchsorted(held, recall)) + 1 if positions else 1


def build(members: DataFrame, k: int = 10, recall: float = RECALL) -> Index | None:
    """An index of members (vec_id, vector); None if there are none."""
    # The limit on the rank is applied before the shuffle too.
    rank = Window.partitionBy("vector").orderBy("vec_id")
    classes = stored(members.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= k + 1)
                     .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "vectors")
    n = classes.count()
    if not n:
        return None
    rows = classes.orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE).select("vector").collect()
    sample = np.array([r.vector for r in rows], float)
    d = sample.shape[1]
    centroids = _centroids(sample, min(MAX_LISTS, len(sample), max(1, n // LIST_ROWS)))
    rotation = np.linalg.qr(np.random.default_rng(1).normal(size=(d, d)))[0]
    lists = stored(_assigned(classes, centroids, 1), "lists")
    return Index(lists, centroids, rotation, min(len(centroids), _probes(sample, centroids, k, recall)), k)


def _assigned(rows: DataFrame, centroids: np.ndarray, n: int) -> DataFrame:
    """rows (with vector), once for each of their n nearest lists."""
    shared = rows.sparkSession.sparkContext.broadcast(centroids)
    schema = ", ".join(["list int", *(f.simpleString().replace(":", " ", 1) for f in rows.schema)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        for batch in batches:
            if batch.num_rows:
                near = _near(_matrix(batch.column("vector"), centres.shape[1]), centres, n)
                for j in range(near.shape[1]):
                    yield pa.RecordBatch.from_arrays([pa.array(near[:, j], pa.int32()), *batch.columns],
                                                     ["list", *batch.schema.names])
    return rows.mapInArrow(run, schema)


def scan(queries: np.ndarray, vectors: np.ndarray, rotation: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, vectors found, distances): the k nearest of each query, and ties."""
    n, d = vectors.shape
    turned = (vectors @ rotation).T
    columns = [np.ascontiguousarray(turned[at:at + BLOCK]) for at in range(0, d, BLOCK)]
    for i, q in enumerate(queries):
        own = q @ rotation
        found, distance, worst = np.zeros(0, int), np.zeros(0), np.inf
        for begin in [0, *range(FIRST, n, CHUNK)]:
            alive = np.arange(begin, min(n, FIRST if not begin else begin + CHUNK))
            partial, seen = np.zeros(len(alive)), 0
            for b, block in enumerate(columns):
                part = block[:, alive] - own[b * BLOCK:(b + 1) * BLOCK, None]
                partial += np.einsum("ij,ij->j", part, part)
                seen += len(block)
                if worst < np.inf:
                    m = seen if seen < d else np.inf
                    keep = partial * (d / seen) <= (worst * (1 + LEEWAY / np.sqrt(m))) ** 2 + 1e-9
                    alive, partial = alive[keep], partial[keep]
                    if not len(alive):
                        break
            exact = np.sqrt(((vectors[alive] - q) ** 2).sum(axis=1))
            found, distance = np.append(found, alive), np.append(distance, exact)
            if len(found) > k:
                worst = np.partition(distance, k - 1)[k - 1]
                found, distance = found[distance <= worst], distance[distance <= worst]
        yield i, found, distance


def search(index: Index, queries: DataFrame) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query (vec_id,
    vector), without its own id."""
    spark, k, (_, d) = queries.sparkSession, index.k, index.centroids.shape
    asked = stored(queries.select("vector").distinct().withColumn("q", F.monotonically_increasing_id()), "asked")
    probing = stored(_assigned(asked, index.centroids, index.probes), "probing")
    # A row for each list, MAX_LISTS at most: into how many groups its vectors and its
    # queries are dealt.
    parts = (index.lists.groupBy("list").agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("_subs"))
             .join(probing.groupBy("list").agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("_parts")), "list"))
    parts = F.broadcast(parts)
    sub, part = F.pmod(F.xxhash64("vector"), F.col("_subs")), F.pmod(F.xxhash64("vector"), F.col("_parts"))
    vectors = (index.lists.join(parts, "list").withColumn("_sub", sub.cast("int"))
               .withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_subs", "_parts"))
    wanted = (probing.join(parts, "list").withColumn("_part", part.cast("int"))
              .withColumn("_sub", F.explode(F.sequence(F.lit(0), F.col("_subs") - 1))).drop("_subs", "_parts"))
    shared = spark.sparkContext.broadcast(index.rotation)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            q = right.column("q").to_numpy()
            ids = left.column("ids").combine_chunks()
            flat, ends = ids.flatten().to_numpy(), np.asarray(ids.offsets) - ids.offsets[0].as_py()
            for i, found, distance in scan(_matrix(right.column("vector"), d), _matrix(left.column("vector"), d), shared.value, k + 1):
                sizes = ends[found + 1] - ends[found]
                members = np.concatenate([flat[ends[j]:ends[j + 1]] for j in found])
                score = np.repeat(distance, sizes)
                best = np.lexsort((members, score))[:k + 1]
                out.append((np.full(len(best), q[i]), members[best], score[best]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, int), np.zeros(0, int), np.zeros(0)]
        return pa.table({"q": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.float64())})

    keys = ("list", "_sub", "_part")
    found = vectors.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInArrow(run, "q long, vec_id long, score double")
    best = Window.partitionBy("q").orderBy("score", "vec_id")
    top = found.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= k + 1).drop("_rank")
    own = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (queries.withColumnRenamed("vec_id", "query_id").join(asked, "vector").select("query_id", "q")
            .join(top, "q").where("vec_id != query_id")
            .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def neighbours(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """search() of the rows for which is_query holds, against all rows."""
    members = stored(valid(vectors), "members")
    index = build(members, k)
    if index is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return search(index, members.where(is_query))
