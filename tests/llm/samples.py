"""Small frames with the cases that every operator must take."""

import random

LONG = "word " * 30_000
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "two words"), (6, LONG), (7, "a b c d e"), (8, "a b c d e"),
    (8, "a b c d e"), (9, "A B\nC  D E"), (None, "no id here"), (None, None), (10, "naïve Straße 日本語 \U0001F600 it's 12½"),
    (11, "\x00\x1c odd\x85control\xa0marks"),
]
# Names that operators use for columns of their own.
CLASHING = {c: "1" for c in ("score", "fp", "ids", "length", "offset", "_doc", "_k", "_key", "stats", "slot", "failures")}


def odd(spark):
    """The odd rows with columns of other names around them."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ODD, "doc_id long, text string")
    return rows.select(*[F.lit(v).alias(k) for k, v in CLASHING.items()], F.lit("en").alias("lang"), "doc_id", "text")


def empty(spark, schema="doc_id long, text string, lang string"):
    return spark.createDataFrame([], schema)


def prose(n, seed=0, words=("the", "of", "and", "river", "stone", "walks", "green", "under", "light", "every", "house")):
    rng = random.Random(seed)
    return [" ".join(rng.choice(words) for _ in range(rng.randint(30, 80))) + "." for _ in range(n)]
