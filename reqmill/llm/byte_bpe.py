"""Byte-level BPE over overlapping chunks.

A text is cut into chunks that overlap. Each chunk is split into pre-tokens on its
own, wherever it runs. Where two neighbours agree on a boundary inside their overlap
they are stitched: a match of the pattern depends only on where it starts and on what
follows, so from a common boundary on both splits are the same. Boundaries too close to
a chunk's end to have seen what follows don't count. The pieces between
two stitches are then encoded apart from each other. Decoding concatenates the bytes
of the ids.

Null texts count as empty. A text without any boundary in an overlap is carried over
to the next one, so a single run of letters of any length is still one pre-token.
"""

from __future__ import annotations

import base64
import functools
import itertools
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reqmill.llm.base import map_texts, stored

CHUNK = 32_768  # code points that a chunk owns
OVERLAP = 512  # code points that it shares with the next one
AHEAD = 8  # code points that must be seen after a boundary; the pattern looks at 2
MEMO = 200_000  # pre-tokens whose ids a Python worker remembers

# Letters, digits and white space below U+0100.
LATIN_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
LATIN_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
LATIN_S = "\\t-\\r \x85\xa0"


@functools.lru_cache(maxsize=4)
def splitter(pattern: str) -> Callable[[str], list[str]]:
    """The pre-tokens of a text: the pattern's matches, which leave nothing out.

    Most texts stay below U+0100, where the character classes are spelled out for
    the standard library, whose matcher is faster on them.
    """
    import regex

    general = regex.compile(pattern)
    latin = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{LATIN_S}{LATIN_L}{LATIN_N}]")
    for name, members in ((r"\p{L}", LATIN_L), (r"\p{N}", LATIN_N), (r"\S", f"^{LATIN_S}"), (r"\s", LATIN_S)):
        latin = latin.replace(name, f"[{members}]")
    if r"\p" in latin:
        return general.findall
    quick = re.compile(latin)

    def matches(text: str) -> list[str]:
        return (quick if text.isascii() or max(text) < "Ā" else general).findall(text)

    return matches


@functools.lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Memo(dict):
    """Pre-token to its ids as little-endian bytes; emptied when full."""

    def __init__(self, encode: Callable[[bytes], list[int]]):
        super().__init__()
        self.encode = encode

    def __missing__(self, token: str) -> bytes:
        if len(self) >= MEMO:
            self.clear()
        ids = array("I", self.encode(token.encode())).tobytes()
        if len(token) < 64:
            self[token] = ids
        return ids


@functools.lru_cache(maxsize=1)
def _memo(path: str, pattern: str) -> Memo:
    """One per Python worker. The library merges one pre-token at a time."""
    import tiktoken

    merges = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})
    return Memo(merges._core_bpe.encode_single_piece)


def _encoder(path: str, pattern: str) -> Callable[[], Callable[[list], dict]]:
    def make() -> Callable[[list], dict]:
        memo, split = _memo(path, pattern), splitter(pattern)

        def work(texts: list) -> dict:
            raw = [b"".join(map(memo.__getitem__, split((x or b"").decode()))) for x in texts]
            ends = np.cumsum([0, *(len(x) // 4 for x in raw)])
            ids = pa.array(np.frombuffer(b"".join(raw), "<i4"))
            return {"ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)}
        return work
    return make


def _cut(chunk: int, overlap: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("_doc", "doc_id", "text"))):
                starts = range(0, len(text), chunk)
                for at in range(0, len(starts), 64):  # a long text leaves in several batches
                    some = starts[at:at + 64]
                    yield pa.RecordBatch.from_pydict({
                        "_doc": pa.array([key] * len(some), pa.int64()),
                        "doc_id": pa.array([doc_id] * len(some), batch.schema.field("doc_id").type),
                        "_k": pa.array([s // chunk for s in some], pa.int64()),
                        "text": [text[s:s + chunk + overlap] for s in some]})
    return run


def _bounds(pattern: str, chunk: int) -> Callable[[], Callable[[list], dict]]:
    """Boundaries of each chunk in the overlap with the one before and, as positions
    in the next chunk, in the overlap with the one after."""
    def make() -> Callable[[list], dict]:
        split = splitter(pattern)

        def work(texts: list) -> dict:
            before, after = [], []
            for raw in texts:
                text = raw.decode()
                starts = list(itertools.accumulate(map(len, split(text)), initial=0))[:-1]
                before.append(starts)
                after.append([s - chunk for s in starts if chunk <= s <= len(text) - AHEAD])
            return {"_before": pa.array(before, pa.list_(pa.int32())), "_after": pa.array(after, pa.list_(pa.int32()))}
        return work
    return make


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, ids) of every text, by the ranks in the file at path."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    encoder = _encoder(path, pattern)
    short = map_texts(docs.where(F.length("text") <= chunk), encoder, "ids array<int>", keep=("doc_id",))

    # _doc tells apart rows that repeat a doc_id. The chunks are stored as soon as it
    # is given, so that all that follows sees the same numbers.
    long = docs.where(F.length("text") > chunk).withColumn("_doc", F.monotonically_increasing_id())
    kind = docs.select("doc_id").schema[0].simpleString().replace(":", " ", 1)
    chunks = stored(long.select("_doc", "doc_id", "text")
                    .mapInArrow(_cut(chunk, overlap), f"_doc long, {kind}, _k long, text string")
                    .repartition("_doc", "_k"), "chunks")
    bounds = map_texts(chunks, _bounds(pattern, chunk), "_before array<int>, _after array<int>", keep=("_doc", "_k"))
    bounds = stored(bounds.withColumn("_before", F.filter("_before", lambda s: s < overlap)), "bounds")
    # The cut into chunk k: the first boundary that its split and the one before share.
    cuts = (bounds.select("_doc", "_k", "_before")
            .join(bounds.select("_doc", (F.col("_k") + 1).alias("_k"), "_after"), ["_doc", "_k"], "left")
            .select("_doc", "_k", F.when(F.col("_k") == 0, 0)
                    .otherwise(F.array_min(F.array_intersect("_before", "_after"))).alias("_cut")))
    # Chunks that no stitch parts form one piece. These rows are three numbers each.
    along = Window.partitionBy("_doc").orderBy("_k")
    cuts = (cuts.withColumn("_next", F.lead("_cut").over(along))
            .withColumn("_more", F.lead(F.lit(True), 1, False).over(along))
            .withColumn("_piece", F.count("_cut").over(along.rowsBetween(Window.unboundedPreceding, 0))))
    end = F.when(~F.col("_more"), F.length("text")).when(F.col("_next").isNull(), chunk).otherwise(chunk + F.col("_next"))
    begin = F.coalesce("_cut", F.lit(0))
    pieces = (chunks.join(cuts, ["_doc", "_k"])
              .select("_doc", "doc_id", "_piece", F.struct("_k", F.substring("text", begin + 1, end - begin).alias("text")).alias("_part"))
              .groupBy("_doc", "doc_id", "_piece").agg(F.sort_array(F.collect_list("_part")).alias("_parts"))
              .select("_doc", "doc_id", "_piece", F.array_join(F.col("_parts.text"), "").alias("text")))
    done = (map_texts(pieces, encoder, "ids array<int>", keep=("_doc", "doc_id", "_piece"))
            .groupBy("_doc", "doc_id").agg(F.sort_array(F.collect_list(F.struct("_piece", "ids"))).alias("_parts"))
            .select("doc_id", F.flatten("_parts.ids").alias("ids")))
    return short.unionByName(done)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """encoded with the column bytes: the bytes of its ids, one after another."""
    schema = ", ".join([*(f.simpleString().replace(":", " ", 1) for f in encoded.schema), "bytes binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: piece for piece, rank in ranks(path).items()}
        for batch in batches:
            out = [b"".join(map(token.__getitem__, ids)) for ids in batch.column("ids").to_pylist()]
            yield batch.append_column("bytes", pa.array(out, pa.binary()))

    return encoded.mapInArrow(run, schema)
