"""SimHash near-duplicates through covering locality-sensitive hashing.

A fingerprint has a bit for each of the 64 bits of the hashes of a text's word
shingles, set where more than half of the hashes have it. Fingerprints link when they
differ in `radius` bits or fewer.

Every bit position gets a vector of radius + 1 bits, not zero. Table v, one for each
vector v that is not zero, looks at the positions whose vector has an odd product with
v. For any `radius` positions there is a v whose product with all their vectors is
even, so every pair within the radius agrees in what some table looks at: no pair is
missed, and with radius 2 seven tables do. Fingerprints alone in all their buckets
have no link.

Buckets may hold any number of fingerprints. Their pairs are not compared: each
candidate is sent to itself and to every fingerprint one flip away at a position that
some table it collides in doesn't look at. Two fingerprints meet there exactly if they
are within 2 bits, and at most 65 fingerprints meet in one place.

Texts with the same fingerprint are one node. Null texts count as empty; texts without
words have fingerprint zero, which links like any other. A null id is never a
component's id while the component has another. Rows that repeat an id each get a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqmill.llm.base import map_texts, stored
from reqmill.llm.components import components

SHINGLE = 3
RADIUS = 2
SEED = 42
BLOCK = 16_384  # shingles counted at a time


def hashes(words: list[bytes], shingle: int) -> Iterator[np.ndarray]:
    """Hashes of the shingles, in blocks; all words are one shingle if they are fewer."""
    import xxhash

    hashed = xxhash.xxh64_intdigest
    for at in range(0, max(1, len(words) - shingle + 1) if words else 0, BLOCK):
        block = words[at:at + BLOCK + shingle - 1]
        parts = zip(*(block[i:] for i in range(shingle))) if len(words) >= shingle else [block]
        yield np.array([hashed(b" ".join(x), SEED) for x in parts], "<u8")


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Signed, as Spark's long."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    counts, n = np.zeros(64, np.int64), max(1, len(words) - shingle + 1)
    for block in hashes(words, shingle):
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and fp, a long, of every row."""
    def make():
        return lambda texts: {"fp": pa.array([fingerprint(x, shingle) for x in texts], pa.int64())}
    return map_texts(docs, make, "fp long", keep=keep)


def masks(radius: int = RADIUS) -> list[int]:
    """What each table looks at. Positions take the vectors in turn."""
    vectors = range(1, 2 ** (radius + 1))
    own = [vectors[i % len(vectors)] for i in range(64)]
    return [sum(1 << i for i in range(64) if (own[i] & v).bit_count() % 2) for v in vectors]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that join all those
    within two bits, if not every such pair."""
    looked = [_signed(m) for m in masks()]
    table = F.explode(F.array(*[F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"),
                                         F.lit(_signed(~m & (2 ** 64 - 1))).alias("hidden")) for i, m in enumerate(looked)]))
    keyed = prints.select("fp", table.alias("_t")).select("fp", "_t.*")
    crowded = keyed.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    candidates = (keyed.join(crowded, ["table", "key"]).groupBy("fp").agg(F.bit_or("hidden").alias("hidden")))
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(64)])
    centres = candidates.select("fp", F.explode(F.filter(flips, lambda x: x.bitwiseAND(F.col("hidden")) == x)).alias("_flip"))
    met = (centres.select("fp", F.col("fp").bitwiseXOR(F.col("_flip")).alias("centre"))
           .groupBy("centre").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1))  # 65 at most
    return (met.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where("a != b").distinct())


def groups(docs: DataFrame, shingle: int = SHINGLE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, fp, root (a fingerprint that names the group) and component_id
    (its smallest doc_id) of every row."""
    prints = stored(fingerprints(docs, shingle, keep), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    return labelled(prints, nodes, links(nodes.select("fp")))


def labelled(prints: DataFrame, nodes: DataFrame, linked: DataFrame) -> DataFrame:
    """prints with the root and component_id of each fp among nodes (fp, doc_id)."""
    roots = components(linked).withColumnRenamed("node", "fp")
    named = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return prints.join(named.join(least, "root").select("fp", "root", "component_id"), "fp")


def representatives(docs: DataFrame, shingle: int = SHINGLE, grouping: Callable[..., DataFrame] = groups) -> DataFrame:
    """One row of each group, with all its columns: one with the smallest doc_id, and
    among rows that repeat that id one with the smallest hash of its text."""
    key = F.xxhash64("text")
    grouped = grouping(docs.select("doc_id", "text", key.alias("_key")), shingle, ("doc_id", "_key"))
    chosen = stored(grouped.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
                    .groupBy("root", "doc_id", "_key").agg(F.count("*").alias("_n"))
                    .groupBy("root").agg(F.min(F.struct("_key", "doc_id", "_n")).alias("_c")).select("_c.*"), "chosen")

    def rows_of(some: DataFrame) -> DataFrame:
        return docs.alias("d").join(
            some.alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.xxhash64("d.text") == F.col("c._key")), "left_semi")

    # Only rows that are the same in id and text are left to fold, if there are any.
    repeated = chosen.where("_n > 1")
    if repeated.isEmpty():
        return rows_of(chosen)
    once = (rows_of(repeated).select(F.struct(*docs.columns).alias("doc"), "doc_id", key.alias("_key"))
            .dropDuplicates(["doc_id", "_key"]).select("doc.*"))
    return rows_of(chosen.where("_n = 1")).unionByName(once)


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
