"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one
bit per failed rule, so that a policy, which is a mask of the rules that count, is
applied without reading a text again, and the effect of leaving a rule out is a count
of bit patterns.

Words are runs of characters other than \\x20 and \\x09-\\x0D. A null text has none. A
rule that divides by the number of words or lines is written as a product, so a text
without words fails only the rule on their number. Rows that repeat an id each have a
row in the ledger. All of it is column expressions; a document is one row throughout.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqmill.llm.base import SPACES

SYMBOLS = "#*$%&|<>"
WINDOW = 3

# Bit of each rule, by its place in this table: failed where the condition holds. A stored
# ledger goes by these places: rules are added at the end and never changed.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 12 * n_words",
    "many_repeated_lines": "n_dup_lines > 2 and 10 * n_dup_lines > 3 * n_lines",
}
BASE = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    """A document is kept if it fails none of these rules."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(r) for r in self.rules)


POLICIES = [
    Policy("base", 1, BASE),
    Policy("prose", 1, (*BASE, "symbols", "repeated_lines")),
    Policy("prose", 2, (*BASE, "symbols", "repeated_lines", "short_words", "long_words")),
    Policy("prose", 3, (*BASE, "symbols", "short_words", "long_words", "many_repeated_lines")),
]


def latest(name: str) -> Policy:
    return max((p for p in POLICIES if p.name == name), key=lambda p: p.version)


def _let(value: Column, then) -> Column:
    """then(value), with value computed once however often it is used."""
    return F.transform(F.array(value), then)[0]


def _words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))


def _repeated(words: Column) -> Column:
    """Number of words in windows that occur twice or more.

    Windows are sorted by hash, then by their words, so equal ones are neighbours
    whatever the hashes; strings are compared only where hashes are equal.
    """
    def window(i: Column) -> Column:
        parts = [words[i + k] for k in range(WINDOW)]
        return F.struct(F.xxhash64(*parts).alias("h"), F.concat_ws(" ", *parts).alias("s"), i.alias("at"))

    def twice(ordered: Column) -> Column:
        n = F.size(ordered)

        def same(i: Column, j: Column) -> Column:
            a, b = ordered[i], ordered[j]
            return (a["h"] == b["h"]) & (a["s"] == b["s"])

        places = F.filter(F.sequence(F.lit(0), n - 1),
                          lambda i: ((i > 0) & same(i, F.greatest(i - 1, F.lit(0))))
                          | ((i < n - 1) & same(i, F.least(i + 1, n - 1))))
        return F.sort_array(F.transform(places, lambda i: ordered[i]["at"]))

    # Each window covers the words that the one before it has not covered.
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        _let(F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), window)), twice), start,
        lambda sofar, at: F.struct(at.alias("last"), (sofar["n"] + F.least(F.lit(WINDOW), at - sofar["last"])).alias("n")),
        lambda sofar: sofar["n"])
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(covered)


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return docs.select("doc_id", F.struct(
        _let(_words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeated(w).alias("n_repeat_words"))).alias("w"),
        _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"),
                                       (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols")).alias("_m"),
    ).select("doc_id", "_m.w.n_words", "_m.word_chars", "_m.n_symbols", "_m.l.n_lines", "_m.l.n_dup_lines", "_m.w.n_repeat_words")


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements and failures, a long with one bit per rule."""
    bits = [F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, rule in enumerate(RULES.values())]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    return measure(docs).withColumn("failures", failures)


def passes(policy: Policy) -> Column:
    return F.col("failures").bitwiseAND(F.lit(policy.mask)) == 0


def ablations(recorded: DataFrame, policies: list[Policy] = POLICIES) -> DataFrame:
    """(policy, version, rule, n_failed, n_only, n_kept, n_kept_without) for every rule
    of every policy: documents that fail it, that fail no other rule of the policy,
    that the policy keeps, and that it would keep without the rule.

    Documents are first folded to their bit patterns, of which there are 2 to the
    number of rules at most.
    """
    spark = recorded.sparkSession
    rows = [(p.name, p.version, r, p.mask, Policy("", 0, (r,)).mask) for p in policies for r in p.rules]
    rules = spark.createDataFrame(rows, "policy string, version int, rule string, _mask long, _bit long")
    patterns = recorded.groupBy("failures").agg(F.count("*").alias("_n"))
    counts = patterns.agg(F.collect_list(F.struct("failures", "_n")).alias("_patterns"))

    def total(condition) -> Column:
        return F.aggregate(F.filter("_patterns", condition), F.lit(0).cast("long"), lambda s, x: s + x["_n"])

    kept = total(lambda x: x["failures"].bitwiseAND(F.col("_mask")) == 0)
    only = total(lambda x: x["failures"].bitwiseAND(F.col("_mask")) == F.col("_bit"))
    return (rules.withColumn("_one", F.lit(1)).join(F.broadcast(counts.withColumn("_one", F.lit(1))), "_one")
            .select("policy", "version", "rule",
                    total(lambda x: x["failures"].bitwiseAND(F.col("_bit")) != 0).alias("n_failed"),
                    only.alias("n_only"), kept.alias("n_kept"), (kept + only).alias("n_kept_without")))
