"""Phrase collocations by marginalising the longest windows.

Texts are split into pieces at punctuation and line ends, and pieces into words. Every
word starts one window: the word and its followers in lead columns, up to ORDER words,
padded from the end of the piece on. Only these padded windows are counted, once in
each task and once over all. A ROLLUP over the lead columns then sums the windows that
share a shorter prefix, which is how often that prefix occurs: a phrase of any length
starts a window wherever it occurs. Phrases of all lengths come from one aggregation,
and the words of a text are never exploded into n-grams.

Windows of prose are nearly all different, but hardly any of them can hold a phrase of
`least` occurrences. Words and adjacent pairs are therefore counted first, by a hash into
a fixed number of buckets, then triples of such pairs. What is in a bucket of fewer than
`least` occurs less often than that, and so does every phrase that holds it: windows are
padded from such a word, pair or triple on, from their first word on if need be, when
they only count towards the number of words. Buckets only ever count too much, so no
phrase is lost, and counts of the phrases that remain are exact. In corpora of far more
than `least` pairs a bucket the buckets fill up and pad less; the result stays the same
and more windows are shuffled.

Everything is per language; a null one is `und`, and joins texts that say so. Null and
empty texts have no words. Bytes A-Z are lower-cased and no others. Rows that repeat an
id or a text each count: no id is read. Ties in score and in occurrences are ordered by
the phrase's bytes. Corpora without a phrase of `least` occurrences give no rows. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reqmill.llm.base import stored

ORDER = 5  # words of the longest phrase
LEAST = 100  # occurrences of a candidate
TOP = 2000  # phrases reported for each language
SCALE = 1000  # of a score
COVERED = 100  # a longer phrase covers its parts that occur at most 100 / COVERED times as often
BUCKETS = 1 << 24  # of runs of each size; which ones are full is broadcast, one bit each, 2 MB
PASSES = ((1, 2), (3,))  # sizes of the runs that are counted in each reading of the texts
HELD_WORDS = 1 << 18  # counted at a time in a task
SALTS = 32  # parts in which the phrases of a language are ranked first
UND = "und"

# The characters that part pieces, and those that part words.
_BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b"." * 10)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
LEADS = [f"w{i + 1}" for i in range(ORDER)]


def tokens(text: bytes | None) -> list[bytes]:
    """The words in order, with b"." where pieces end."""
    return (text or b"").lower().translate(_BREAKS).replace(b".", b" . ").split()


class Held:
    """Tokens of many texts: codes into words, and the language of each."""

    def __init__(self, held: list[bytes], sizes: list[int], langs: list[bytes]):
        values = np.empty(len(held), object)
        values[:] = held
        self.codes, words = pd.factorize(values)
        self.words: list[bytes] = words.tolist()
        lang_codes, names = pd.factorize(np.array(langs, object))
        self.langs: list[bytes] = names.tolist()
        self.lang = np.repeat(lang_codes, sizes)
        self.is_word = self.codes != self.words.index(b".")

        self.at = np.flatnonzero(self.is_word)  # where windows start
        self._hash: np.ndarray | None = None

    def follower(self, k: int) -> np.ndarray:
        """Places k tokens on, or at the end."""
        return np.minimum(self.at + k, len(self.codes) - 1)

    def buckets(self, size: int, some: np.ndarray, n_buckets: int) -> np.ndarray:
        """Buckets of the runs of `size` words from these window starts on."""
        import xxhash

        if self._hash is None:
            self._hash = np.array([xxhash.xxh64_intdigest(w) for w in self.words], np.uint64)[self.codes]
            self._hash_lang = np.array([xxhash.xxh64_intdigest(x, 1) for x in self.langs], np.uint64)[self.lang]
        at = self.at[some]
        mixed = self._hash_lang[at] + np.uint64(size)
        for k in range(size):
            mixed = (mixed ^ self._hash[at + k]) * _MIX[0]
            mixed ^= mixed >> np.uint64(32)
        return ((mixed * _MIX[1]) >> np.uint64(64 - n_buckets.bit_length() + 1)).astype(np.int64)

    def runs(self, full: list[np.ndarray], n_buckets: int) -> list[np.ndarray]:
        """For each number of words from 1 to ORDER: whether the window starts have that
        many that can be a phrase. `full` are the buckets of words, of pairs and so on, as
        far as they are known; a longer run can be one if its beginning and its end can."""
        out: list[np.ndarray] = []
        place = np.full(len(self.codes) + 1, -1)
        place[self.at] = np.arange(len(self.at))
        after = place[self.follower(1)]  # the window start that comes next, if the next token is a word
        for size in range(1, ORDER + 1):
            goes = np.ones(len(self.at), bool)
            if size > 1:
                goes = out[-1] & (after >= 0) & (self.at + 1 < len(self.codes)) & out[-1][after]
            if size <= len(full):
                some, bits = np.flatnonzero(goes), full[size - 1]
                bucket = self.buckets(size, some, n_buckets)
                goes[some] = (bits[bucket >> 3] >> (bucket & 7).astype(np.uint8)) & 1
            out.append(goes)
        return out


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[Held]:
    held, sizes, langs = [], [], []
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            some = tokens(text)
            if some:
                some.append(b".")  # windows end with the text
                held += some
                sizes.append(len(some))
                langs.append(lang)
            if len(held) >= HELD_WORDS:
                yield Held(held, sizes, langs)
                held, sizes, langs = [], [], []
    if held:
        yield Held(held, sizes, langs)


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit(UND)).cast("binary").alias("lang"), F.col("text").cast("binary").alias("text"))


def full_buckets(docs: DataFrame, least: int, sizes: tuple[int, ...], known: list[np.ndarray],
                 n_buckets: int = BUCKETS) -> list[np.ndarray]:
    """For each of the sizes, a bit for each bucket: whether its runs occur `least` times or
    more. known are the bits of shorter runs; runs that these rule out are not counted."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.uint16 if least < 1 << 16 else np.int64
        counts = {size: np.zeros(n_buckets, kind) for size in sizes}  # up to `least`
        for held in _held(batches):
            runs = held.runs(shared.value, n_buckets)
            for size in sizes:
                found, n = np.unique(held.buckets(size, np.flatnonzero(runs[size - 1]), n_buckets), return_counts=True)
                counts[size][found] = np.minimum(counts[size][found] + n, least)
        for size in sizes:
            some = np.flatnonzero(counts[size])
            for at in range(0, len(some), 1 << 16):
                part = some[at:at + (1 << 16)]
                yield pa.RecordBatch.from_pydict({"bucket": pa.array(part + size * n_buckets), "n": pa.array(counts[size][part].astype(np.int64))})

    full = (_read(docs).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
            .groupBy(F.bitmap_bucket_number("bucket").alias("part"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bucket")).alias("bits")))
    bits = {size: np.zeros(n_buckets // 8, np.uint8) for size in sizes}
    for row in full.toLocalIterator():  # 2 MB for each size, however many rows there are
        # Part k has the numbers from 32,768 (k - 1) + 1 to 32,768 k; none is 0.
        found = 32_768 * (row.part - 1) + 1 + np.flatnonzero(np.unpackbits(np.frombuffer(row.bits, np.uint8), bitorder="little"))
        for size in sizes:
            own = found[found // n_buckets == size] % n_buckets
            np.bitwise_or.at(bits[size], own >> 3, (1 << (own & 7)).astype(np.uint8))
    return list(bits.values())


def windows(docs: DataFrame, full: list[np.ndarray], n_buckets: int = BUCKETS) -> DataFrame:
    """(lang, w1 .. w5, n): the padded longest windows, counted within a task; "" pads."""
    shared = docs.sparkSession.sparkContext.broadcast(full)

    def counted(held: Held) -> Iterator[pa.RecordBatch]:
        pad = len(held.words)
        columns = {"lang": held.lang[held.at]}
        for k, goes in enumerate(held.runs(shared.value, n_buckets)):
            columns[LEADS[k]] = np.where(goes, held.codes[held.follower(k)], pad)
        sizes = pd.DataFrame(columns).groupby(list(columns), sort=False).size()
        index = sizes.index.to_frame(index=False)
        texts, langs = pa.array([*held.words, b""], pa.binary()), pa.array(held.langs, pa.binary())
        for lo in range(0, len(index), 1 << 16):
            part = index.iloc[lo:lo + (1 << 16)]
            out = {c: (langs if c == "lang" else texts).take(pa.array(part[c].to_numpy())) for c in columns}
            yield pa.RecordBatch.from_pydict(out | {"n": pa.array(sizes.to_numpy()[lo:lo + (1 << 16)], pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _held(batches):
            yield from counted(held)

    raw = _read(docs).mapInArrow(run, ", ".join(f"{c} binary" for c in ("lang", *LEADS)) + ", n long")
    return raw.select(*(F.col(c).cast("string").alias(c) for c in ("lang", *LEADS)), "n")


def phrases(docs: DataFrame, least: int = LEAST, n_buckets: int = BUCKETS) -> DataFrame:
    """(lang, length, phrase, f) of every phrase of up to ORDER words that occurs `least`
    times or more, and for each lang one row of length 0 with the number of its words."""
    full: list[np.ndarray] = []
    for sizes in PASSES:
        full += full_buckets(docs, least, sizes, full, n_buckets)
    counted = windows(docs, full, n_buckets).groupBy("lang", *LEADS).agg(F.sum("n").alias("n"))
    rolled = counted.rollup("lang", *LEADS).agg(F.sum("n").alias("f"), F.grouping_id().alias("_set"))
    # A prefix of k words leaves the last ORDER - k bits set; lang's own bit is above.
    length = F.lit(ORDER) - F.bit_count(F.col("_set"))
    words = rolled.withColumn("length", length.cast("int")).where(F.col("_set") < 1 << ORDER)
    last = F.coalesce(*(F.col(c) for c in reversed(LEADS)), F.lit("-"))
    return (words.where((F.col("length") == 0) | ((F.col("f") >= least) & (last != "")))
            .select("lang", "length", F.concat_ws(" ", *LEADS).alias("phrase"), "f"))


def scored(counts: DataFrame, scale: int = SCALE) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of every candidate in phrases(): the cut with the
    lowest score, and among equal ones the first."""
    parts = counts.where("length between 1 and 4").select("lang", "phrase", "f")
    cuts = (counts.where("length >= 2").select("lang", "phrase", "length", F.col("f").alias("a"), F.split("phrase", " ").alias("_words"))
            .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1)))
            .withColumn("_left", F.array_join(F.slice("_words", F.lit(1), F.col("k")), " "))
            .withColumn("_right", F.array_join(F.slice("_words", F.col("k") + 1, F.col("length") - F.col("k")), " ")))
    both = (cuts.join(parts.select("lang", F.col("phrase").alias("_left"), F.col("f").alias("l")), ["lang", "_left"])
            .join(parts.select("lang", F.col("phrase").alias("_right"), F.col("f").alias("r")), ["lang", "_right"])
            .join(counts.where("length = 0").select("lang", F.col("f").alias("n")), "lang"))
    return (both.withColumn("score", F.expr(f"cast({scale} as decimal(38,0)) * a * n div (cast(l as decimal(38,0)) * r)"))
            .groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("_cut"))
            .select("lang", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score"))


def uncovered(candidates: DataFrame, covered: int = COVERED) -> DataFrame:
    """Those whose words are not in a longer one that occurs about as often."""
    words = candidates.select("lang", F.col("a").alias("_f"), F.split("phrase", " ").alias("_words"))
    size = F.size("_words")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
        F.sequence(F.lit(1), size - m + 1), lambda i: F.array_join(F.slice("_words", i, m), " "))))
    inner = (words.where(size > 2).select("lang", "_f", F.explode(spans).alias("phrase"))
             .groupBy("lang", "phrase").agg(F.max("_f").alias("_longer")))
    return (candidates.join(inner, ["lang", "phrase"], "left")
            .where(F.col("_longer").isNull() | (100 * F.col("_longer").cast("decimal(38,0)") < covered * F.col("a").cast("decimal(38,0)")))
            .drop("_longer"))


def top(candidates: DataFrame, n: int = TOP) -> DataFrame:
    """The first n of each lang with their rank. A language that holds most phrases is
    ranked in parts first."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parted = candidates.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    for keys in (["lang", "_part"], ["lang"]):
        parted = parted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)
    return parted.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, least: int = LEAST, n: int = TOP, n_buckets: int = BUCKETS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first n phrases of each language."""
    counts = stored(phrases(docs, least, n_buckets), "phrases")
    return top(uncovered(scored(counts)), n)
