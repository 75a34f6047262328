"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reqmill.session import apply_defaults, shared_dir, ship_package

# Rows per Arrow batch. Texts can be long, and a task holds a few batches at once.
BATCH_ROWS = 512

# The characters that separate words, as the byte methods split() and strip() take them.
SPACES = " \t\n\x0b\x0c\r"


def prepare(spark: SparkSession) -> SparkSession:
    apply_defaults(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, mod n; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written once in the shared folder and read back: what is read twice is
    computed once, and a lost executor costs a read."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_texts(df: DataFrame, make: Callable[[], Callable[[list], dict]], schema: str,
              text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns computed from each text, beside the columns named in keep.

    make is called once per task and returns the function that turns a list of
    texts (bytes or None) into a dict of columns.
    """
    kept = [f.simpleString().replace(":", " ", 1) for f in df.select(*keep).schema] if keep else []
    out = ", ".join([*kept, schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            columns = {k: batch.column(k) for k in keep} | work(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_pydict(columns)

    return df.select(*keep, F.col(text).cast("binary").alias(text)).mapInArrow(run, out)
