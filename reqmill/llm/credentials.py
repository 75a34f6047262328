"""Secrets: three kinds of fixed patterns, and values that would be hard to guess.

The base kinds are `assign` (a value given to a password, secret, token or key),
`access` (access key ids) and `hex` (long runs of hexadecimal digits). Matches of a kind
are the leftmost ones that don't overlap; those that are too short go afterwards, so a
short match still hides what it covers. The span of a match is all of it, the name of
the key included.

The added kind is `guess`: the values that stand in a wider set of credential contexts
(`pwd is ...`, `Authorization: Bearer ...`, `private-key => ...`). A value is cut into
segments so that the cost of guessing all of them is least: dictionary words by their
rank, capitals and look-alike characters included, dates, repeats, keyboard walks and
runs of neighbouring code points, and brute force over the kinds of characters that the
value has. The least sum of bits comes from dynamic programming over the value's
positions, in time linear in its length. A value of GUESS_BITS or more is a secret; so
ordinary words after "the password is" are none. Values that overlap a base span are
left to it.

The dictionary is learned from all texts: the DICTIONARY words of plain letters that
most documents use, by falling number and then by the word, if DOCUMENTS or more do.
Words count where they stand alone, so a value written next to its key does not teach
itself. It is broadcast; its size is that bound times 20 letters.

Null texts count as empty; empty ones have no spans and the digest of nothing. Offsets
are code points, ends exclusive; invalid UTF-8 counts as replacement characters. Values
and texts of any length are read whole. Rows that repeat an id are scanned each for
itself, and each counts as a document for the dictionary. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqmill.llm.base import map_texts

KINDS = ("assign", "access", "hex", "guess")  # in the order of spans that start together
GUESS_BITS = 45.0
DICTIONARY = 20_000  # words
DOCUMENTS = 5
HELD = 200_000  # words counted in a task before they are passed on

# The base patterns and the least length of what they find.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGN, LEAST_ACCESS = 12, 18
_ASSIGN_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

# Contexts that a value stands in: a name, a separator, then the value up to a blank,
# a quote or a bracket.
CONTEXT = re.compile(
    r"""(?<![a-z])(?:pass(?:word|wd|phrase|code)?|pwd|pin|login|secret|token|bearer|credentials?|auth(?:orization)?"""
    r"""|(?:api|access|private|secret|client)[ _-]?(?:key|secret|token))["']?"""
    r"""(?:[ \t]*(?:=>|:=|[:=])|[ \t]+is[ \t:])[ \t]*(?:(?:bearer|basic)[ \t]+)?["'`]?([^\s"'`<>()\[\]{},;]{6,})""", re.I | re.A)
_CONTEXT_NAMES = (b"pass", b"pwd", b"pin", b"login", b"secret", b"token", b"bearer", b"credential", b"auth", b"key")

# Words that passwords use more often than texts do.
COMMON = ("password passwd admin administrator root user guest login welcome letmein qwerty secret master default "
          "test demo example changeme hello monkey dragon sunshine princess football baseball shadow superman "
          "iloveyou trustno access token server database public private backup temp").split()
LOOK_ALIKE = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i"}
LONGEST_WORD, LONGEST_UNIT = 20, 8

# Bits. A segment says of which of five kinds it is.
SEGMENT = math.log2(5)
WALK_KEY, WALK_TURN, WALK_STEP = math.log2(94), 3.0, 0.5
YEAR, DAY = math.log2(200), math.log2(366)
_DATES = (
    (re.compile(r"(?:19|20)\d\d$"), YEAR),
    (re.compile(r"(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])$|(?:0[1-9]|[12]\d|3[01])(?:0[1-9]|1[0-2])$"), DAY + 1),
    (re.compile(r"\d\d(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])$|(?:0[1-9]|[12]\d|3[01])(?:0[1-9]|1[0-2])\d\d$"), math.log2(100) + DAY + 1),
    (re.compile(r"(?:19|20)\d\d(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])$|(?:0[1-9]|[12]\d|3[01])(?:0[1-9]|1[0-2])(?:19|20)\d\d$"), YEAR + DAY + 1),
    (re.compile(r"(?:19|20)\d\d([-/._])\d\d?\1\d\d?$|\d\d?([-/._])\d\d?\2(?:19|20)\d\d$"), YEAR + DAY + 3),
)
_DATE_SIZES = (4, 6, 8, 9, 10)

# Keys with their row and place; rows are shifted by half a key.
_ROWS = ("`1234567890-=", "\tqwertyuiop[]\\", "\tasdfghjkl;'", "\tzxcvbnm,./")
_PLACE = {c: (r, x + r / 2) for r, row in enumerate(_ROWS) for x, c in enumerate(row) if c != "\t"}
_SHIFTED = dict(zip('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./"))


def _step(a: str, b: str) -> tuple[float, float] | None:
    """The direction from key a to a key b next to it, or to the next code point."""
    a, b = a.lower(), b.lower()
    p, q = _PLACE.get(_SHIFTED.get(a, a)), _PLACE.get(_SHIFTED.get(b, b))
    if p and q and p != q and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1:
        return q[0] - p[0], q[1] - p[1]
    if a.isalnum() and b.isalnum() and abs(ord(a) - ord(b)) == 1:
        return 9.0, float(ord(b) - ord(a))
    return None


def _alphabet(value: str) -> int:
    """How many characters the kinds have that the value uses."""
    size = 0
    for test, n in ((str.islower, 26), (str.isupper, 26), (str.isdigit, 10)):
        size += n * any(test(c) and c.isascii() for c in value)
    return max(2, size + 33 * any(c.isascii() and not c.isalnum() for c in value) + 100 * any(not c.isascii() for c in value))


class Guesser:
    """Least bits to guess a value, given dictionary words in order of rank."""

    def __init__(self, words: list[str]):
        self.bits: dict[str, float] = {}
        for rank, word in enumerate(dict.fromkeys([*COMMON, *words]), 1):
            self.bits[word] = math.log2(rank) + 1
        self.units: dict[str, float] = {}

    def word_bits(self, segment: str) -> float | None:
        lower = segment.lower()
        bits, swaps = self.bits.get(lower), 0
        if bits is None:
            plain = "".join(LOOK_ALIKE.get(c, c) for c in lower)
            swaps = sum(a != b for a, b in zip(lower, plain))
            bits = self.bits.get(plain) if swaps else None
            if bits is None:
                return None
        upper = sum(c.isupper() for c in segment)
        if upper:
            first_or_all = upper == len(segment) or (upper == 1 and segment[0].isupper())
            bits += 1 if first_or_all else math.log2(math.comb(len(segment), upper)) + 1
        return bits + swaps

    def cost(self, value: str) -> float:
        """Sum of the bits of the cheapest segmentation."""
        n, brute_char = len(value), math.log2(_alphabet(value))
        best = [0.0] + [math.inf] * n
        brute = walk = math.inf  # cheapest with an open last segment of that kind
        direction: tuple[float, float] | None = None
        periods = [0] * (LONGEST_UNIT + 1)  # characters up to here that repeat the ones u before
        for j in range(1, n + 1):
            c = value[j - 1]
            brute = min(brute, best[j - 1] + SEGMENT) + brute_char
            # A walk opens with the step from the key before, or goes on.
            step = _step(value[j - 2], c) if j > 1 else None
            if step is None:
                walk = math.inf
            else:
                opened = best[j - 2] + SEGMENT + WALK_KEY + WALK_TURN
                walk = min(walk + (WALK_STEP if step == direction else WALK_TURN + WALK_STEP), opened)
            direction = step
            least = min(brute, walk)
            for size in range(3, min(LONGEST_WORD, j) + 1):
                bits = self.word_bits(value[j - size:j])
                if bits is not None:
                    least = min(least, best[j - size] + SEGMENT + bits)
            if c.isdigit():
                for size in _DATE_SIZES:
                    if size <= j:
                        for pattern, bits in _DATES:
                            if pattern.match(value, j - size, j):
                                least = min(least, best[j - size] + SEGMENT + bits)
            for u in range(1, min(LONGEST_UNIT, j - 1) + 1):
                periods[u] = periods[u] + 1 if c == value[j - 1 - u] else 0
                count = periods[u] // u + 1
                if count > 1 and u * count > 2:
                    least = min(least, best[j - u * count] + SEGMENT + self.unit_bits(value[j - u:j]) + math.log2(count))
            best[j] = least
        return best[n]

    def unit_bits(self, unit: str) -> float:
        if len(unit) == 1:
            return math.log2(_alphabet(unit))
        if unit not in self.units:
            if len(self.units) > 100_000:
                self.units.clear()
            self.units[unit] = self.cost(unit)
        return self.units[unit]


def base_spans(text: str, raw: bytes | None = None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches. raw, the text as bytes, only spares searches."""
    lower = (text.encode("utf-8", "replace") if raw is None else raw).lower()
    found = []
    if any(name in lower for name in _ASSIGN_NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if b"akia" in lower:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    return found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def guess_spans(text: str, base: list[tuple[int, int, int]], guesser: Guesser, raw: bytes | None = None,
                least: float = GUESS_BITS) -> list[tuple[int, int, int]]:
    """(start, kind, end) of values in credential contexts that cost `least` bits or more
    and overlap no base span."""
    lower = (text.encode("utf-8", "replace") if raw is None else raw).lower()
    if not any(name in lower for name in _CONTEXT_NAMES):
        return []
    found, base, at = [], sorted(base), 0
    ends: list[int] = []  # largest end so far
    for _, _, end in base:
        ends.append(max(end, ends[-1] if ends else 0))
    for m in CONTEXT.finditer(text):
        value = m[1].rstrip(".:!?")
        begin, end = m.start(1), m.start(1) + len(value)
        while at < len(base) and base[at][0] < end:
            at += 1
        if len(value) >= 6 and not (at and ends[at - 1] > begin) and "://" not in value and guesser.cost(value) >= least:
            found.append((begin, 3, end))
    return found


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


_EDGE = b"\"'().,;:!?[]{}<>*_`-"
_PLAIN = re.compile(rb"[a-z]{3,20}$")


def dictionary(docs: DataFrame, n: int = DICTIONARY, least: int = DOCUMENTS) -> list[str]:
    """The n words that most documents use, in that order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array([w.decode() for w in counts], pa.string()),
                                               "n": pa.array(list(counts.values()), pa.int64())})
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update({w for t in set((text or b"").lower().split()) if _PLAIN.match(w := t.strip(_EDGE))})
                if len(counts) > HELD:
                    yield out()
                    counts.clear()
        yield out()

    counted = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r.word for r in counted.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(n).collect()]


def scan(docs: DataFrame, words: list[str], keep: tuple[str, ...] = ("doc_id",), least: float = GUESS_BITS) -> DataFrame:
    """The kept columns, n_assign, n_access, n_hex, n_guess, base_sha256 (of the base
    spans) and spans (all of them) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def make():
        guesser = Guesser(shared.value)

        def work(texts: list) -> dict:
            counts: list[list[int]] = [[], [], [], []]
            digests, spans = [], []
            for raw in texts:
                text = (raw or b"").decode("utf-8", "replace")
                base = base_spans(text, raw or b"")
                every = base + guess_spans(text, base, guesser, raw or b"", least)
                for kind, column in enumerate(counts):
                    column.append(sum(s[1] == kind for s in every))
                digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
                spans.append(listed(every))
            return ({f"n_{KINDS[k]}": pa.array(c, pa.int64()) for k, c in enumerate(counts)}
                    | {"base_sha256": pa.array(digests, pa.string()), "spans": pa.array(spans, pa.string())})
        return work
    return map_texts(docs, make, "n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string", keep=keep)


def secrets(docs: DataFrame) -> DataFrame:
    """scan() with the dictionary of the same documents."""
    return scan(docs, dictionary(docs))
