"""Packing of tokenized documents into sequences of a fixed capacity.

A document is its token ids and one end id. Only documents over the capacity are cut,
into pieces of the capacity. Pieces over a third of it are large: a sequence holds two
of them at most, so the large ones are matched greedily, the longest with the longest
that still fits. The others fill the gaps best-fit, longest first, and open sequences
of their own when no gap fits.

Packing depends on lengths alone, and there are at most `capacity` of them: the plan is
made from the number of pieces of each length, in whole runs of equal pieces, and every
piece finds its place by its rank among the pieces of its length. Ranks are counted
within salted parts of a length, so a length that many copies share is not one task.

Null texts count as empty; an empty text is the end id alone. Rows that repeat an id
are packed like any others.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reqmill.llm.base import stored

CAPACITY = 2048
MEMO = 250_000  # words whose ids a Python worker remembers
BATCH_TOKENS = 500_000  # ids in one outgoing batch, about
SALTS = 64  # parts of a length, at least
PART_ROWS = 1_000_000  # pieces for each further part

# The tokenizer's pre-token pattern, spelled out for lower-case text below
# U+0100 without control characters and no-break spaces.
PLAIN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
                   "|[^a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+")
UNUSUAL = re.compile("[^!-~\xa1-\xff]")


class WordIds(dict):
    """Word to its ids as little-endian bytes.

    White space always parts tokens and no normal form reaches across it, so a text
    is the sequence of its words. A word with other than plain characters goes to the
    tokenizer as it is. For plain words the merges of the same file run as byte ranks,
    which is several times faster: the byte 0xff, which no text holds, stands for the
    end of a word and joins the last byte first. Every token of the file has one
    merge, so its rank and its bytes name each other.
    """

    def __init__(self, path: str):
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        # The file's letter for each byte: printable ones stand for themselves, the
        # others follow from U+0100 on.
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}
        with open(path) as file:
            model = json.load(file)["model"]
        last = len(model["merges"]) + 256
        ranks, self.id = {}, {}
        for letter, b in byte.items():
            for raw, rank, token in ((bytes([b, 255]), b, f"{letter}</w>"), (bytes([b]), last + b, letter)):
                ranks[raw], self.id[rank] = rank, model["vocab"][token]
        for k, merge in enumerate(model["merges"]):
            token = "".join(merge.split(" ") if isinstance(merge, str) else merge)
            raw = bytes(byte[c] for c in token.removesuffix("</w>"))
            ranks[raw + b"\xff" * token.endswith("</w>")] = 256 + k
            self.id[256 + k] = model["vocab"][token]
        self.merge = Encoding("merges", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def __missing__(self, raw: bytes) -> bytes:
        if len(self) >= MEMO:
            self.clear()
        word = raw.decode()
        if "<|" in word or UNUSUAL.search(word):  # special tokens start with <|
            found = array("I", self.whole.encode(word, add_special_tokens=False).ids).tobytes()
        else:
            rank_id, merge = self.id, self.merge
            found = array("I", [rank_id[r] for x in PLAIN.findall(word.lower()) for r in merge(x.encode() + b"\xff")]).tobytes()
        if len(raw) < 64:
            self[raw] = found
        return found


@functools.lru_cache(maxsize=1)
def _words(path: str) -> WordIds:
    """One per Python worker."""
    return WordIds(path)


def tokenize(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids, ids_crc32) of every document's pieces."""
    schema = docs.select("doc_id").schema
    kind = schema[0].simpleString().replace(":", " ", 1)
    fields = f"{kind}, piece int, start long, length long, ids array<int>, ids_crc32 long"

    def batch_of(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        doc_id, piece, start, raw = zip(*rows)
        length = np.array([len(x) // 4 for x in raw])
        ids = pa.array(np.frombuffer(b"".join(raw), "<i4"))
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(doc_id, kind), "piece": pa.array(piece, pa.int32()),
            "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
            "ids": pa.ListArray.from_arrays(pa.array(np.append(0, length.cumsum()), pa.int32()), ids),
            "ids_crc32": pa.array([zlib.crc32(x) for x in raw], pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = b"".join(map(words.__getitem__, (text or b"").split())) + end
                for at in range(0, len(ids), 4 * capacity):
                    rows.append((doc_id, at // (4 * capacity), at // 4, ids[at:at + 4 * capacity]))
                    held += len(rows[-1][3]) // 4
                    if held >= BATCH_TOKENS:
                        yield batch_of(rows, batch.schema.field("doc_id").type)
                        rows, held = [], 0
            if rows:
                yield batch_of(rows, batch.schema.field("doc_id").type)

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, fields)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first, n, per, sequence, offset): the pieces of that length with
    ranks from first to first + n - 1 lie in sequences from `sequence` on, per of them
    in each, one after another from offset."""
    left = {k: v for k, v in counts.items() if v > 0}
    ranks, runs, opened = dict.fromkeys(left, 0), [], 0
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # gap: (first sequence, how many)

    def take(length: int, n: int, per: int, sequence: int, offset: int) -> None:
        runs.append((length, ranks[length], n, per, sequence, offset))
        ranks[length] += n
        left[length] -= n

    large = sorted((k for k in left if 3 * k > capacity), reverse=True)
    for i, a in enumerate(large):
        while left[a]:
            n = 0
            for b in large[i:]:
                if a + b <= capacity and (n := min(left[a], left[b]) if a != b else left[a] // 2):
                    break
            used = a + b if n else a
            n = n or left[a]
            take(a, n, 1, opened, 0)
            if used > a:
                take(b, n, 1, opened, a)
            gaps[capacity - used].append((opened, n))
            opened += n

    for s in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        gap = s
        while left[s]:
            while gap <= capacity and not gaps[gap]:
                gap += 1
            if gap > capacity:  # none fits: as many new sequences as the rest needs
                per = capacity // s
                n = -(-left[s] // per)
                gaps[capacity].append((opened, n))
                opened += n
                gap = capacity
            first, n = gaps[gap].pop()
            per = gap // s
            full = min(n, left[s] // per)
            if full:
                take(s, full * per, per, first, capacity - gap)
                gaps[gap - per * s].append((first, full))
            elif left[s]:  # fewer than one sequence can hold
                some = left[s]
                take(s, some, some, first, capacity - gap)
                gaps[gap - some * s].append((first, 1))
                full = 1
            if n > full:
                gaps[gap].append((first + full, n - full))
            gap = s
    return runs


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset. pieces is read more than once."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    runs = spark.createDataFrame(
        plan(counts, capacity), "length long, _first long, _n long, _per long, _sequence long, _offset long")
    salts = max(SALTS, sum(counts.values()) // PART_ROWS)
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = (salted.groupBy("length", "_salt").agg(F.count("*").alias("_count"))
              .select("length", "_salt", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_before")))
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (salted.withColumn("_row", F.row_number().over(within))
              .join(starts, ["length", "_salt"])
              .withColumn("_rank", F.col("_before") + F.col("_row") - 1))
    # Bounded by the number of lengths: a run ends a length or a gap.
    at = F.col("_rank") - F.col("_first")
    return (ranked.join(F.broadcast(runs), "length").where((at >= 0) & (at < F.col("_n")))
            .select(*pieces.columns,
                    (F.col("_sequence") + F.floor(at / F.col("_per"))).alias("sequence_id"),
                    (F.col("_offset") + at % F.col("_per") * F.col("length")).alias("offset")))


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset)."""
    return place(stored(tokenize(docs, path, capacity, end_id), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the training sequences themselves, of `capacity` ids at most."""
    return (packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_parts"))
            .select("sequence_id", F.flatten("_parts.ids").alias("ids")))
