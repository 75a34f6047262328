"""Landing, logs, snapshots and lookups of stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqmill.schema import FIELD_NAMES, LINEAGE, LOG_COLUMNS, landing_schema


def ensure_schemas(spark: SparkSession, names: tuple[str, ...] = ("raw", "staging", "analytics")) -> None:
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """The landing table; the fixed schema keeps `_batch_date` a string."""
    return spark.read.schema(landing_schema()).parquet(path).select(FIELD_NAMES + LINEAGE)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """df with its rows counted as they are written. Nothing may be shuffled after it:
    then each row is counted by the one task that writes it, and only once."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _rows(seen: Observation) -> int:
    return seen.get.get("rows", 0)


def replace_batch(df: DataFrame, path: str, batch_date: str) -> int:
    """Make `df` the only rows of its batch date and return their number.

    The rows are written beside the table, counted on the way, and moved to the batch's
    own partition folder once they are all there. So re-runs never double, the other
    batches are not touched, an empty frame empties the batch, and a run that dies while
    it writes leaves the batch as it was.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    foreign = F.raise_error(F.lit(f"row of another batch while replacing {batch_date}"))
    own = F.when(F.col("_batch_date") == batch_date, F.lit(True)).otherwise(foreign)
    rows, seen = _counted(df.select(FIELD_NAMES + LINEAGE).where(own).drop("_batch_date"))
    draft, final = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (
        f"{path}/_draft-{uuid.uuid4().hex}", f"{path}/_batch_date={batch_date}"))
    rows.write.parquet(draft.toString())
    files = final.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(final, True)
    if not files.rename(draft, final):
        raise RuntimeError(f"could not publish batch {batch_date}")
    return _rows(seen)


def replace_batches(df: DataFrame, path: str, dealt: bool = False) -> None:
    """Replace every batch that has rows in `df`, in one job.

    A batch without rows is left alone; use replace_batch to empty one. Rows are dealt out
    by batch date, so that a batch has few files, unless `df` says that its rows already
    are, as when they were dealt while they were still narrower.
    """
    rows = df.select(FIELD_NAMES + LINEAGE)
    ((rows if dealt else rows.hint("rebalance", "_batch_date"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("_batch_date").parquet(path))


def batch_dates(spark: SparkSession, path: str) -> set[str]:
    """The batch dates that a table partitioned by them has a folder for."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    return {n.removeprefix("_batch_date=") for n in names if n.startswith("_batch_date=")}


def read_or_none(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def row_count(spark: SparkSession, relation: str) -> int:
    """Rows of a catalog table, view or Parquet path; -1 if it does not exist."""
    if "/" in relation:
        try:
            return spark.read.parquet(relation).count()
        except AnalysisException:
            return -1
    return spark.table(relation).count() if spark.catalog.tableExists(relation) else -1


def append_decisions(decisions: DataFrame, path: str, batch_date: str, batch_id: str,
                     model: str = "") -> None:
    """Append every header decision to the JSON-lines log, in its run's own folder."""
    if "proposal_outcome" not in decisions.columns:
        decisions = decisions.withColumn("proposal_outcome", F.lit(None).cast("string"))
    (decisions.withColumns({"batch_date": F.lit(batch_date), "batch_id": F.lit(batch_id),
                            "model": F.lit(model)})
     .select([f.name for f in T._parse_datatype_string(LOG_COLUMNS)])
     .write.mode("append").partitionBy("batch_date", "batch_id").json(path))


def read_decisions(spark: SparkSession, path: str, batch_date: str | None = None,
                   batch_id: str | None = None) -> DataFrame:
    """The decision log. Re-runs append, so name the run to count it once.

    A named date or run reads its own folder only.
    """
    schema = T._parse_datatype_string(LOG_COLUMNS)
    log = spark.read.schema(schema).json(path).select([f.name for f in schema])
    if batch_date is not None:
        log = log.where(F.col("batch_date") == batch_date)
    if batch_id is not None:
        log = log.where(F.col("batch_id") == batch_id)
    return log


# Where the fields of a log line are, in the shapes that have been written.
# A line is read by the first place that it has.
LOG_PLACES = {
    "batch_date": ("$.batch_date", "$.run.date"), "batch_id": ("$.batch_id", "$.run.id"),
    "source_system": ("$.source_system", "$.system"), "source_column": ("$.source_column", "$.header"),
    "canonical_field": ("$.canonical_field", "$.decision.field"), "method": ("$.method", "$.decision.tier"),
    "confidence": ("$.confidence", "$.decision.score"), "reasoning": ("$.reasoning", "$.decision.why"),
}


def read_log_lines(spark: SparkSession, path: str, places: Mapping[str, tuple[str, ...]] = LOG_PLACES,
                   kinds: Mapping[str, str] | None = None) -> DataFrame:
    """The fields of JSON lines whose shape has changed over time, and for each line whether
    it could be read (`readable`) and which of its places, counted from 0, named its method
    or else its first field (`shape`).

    Lines become VARIANT values, so no schema is fitted to what happens to be there: a line
    of an older shape, a field of another type and a broken line each give nulls where they
    say nothing, and no line is dropped.
    """
    kinds = {"confidence": "double"} | dict(kinds or {})
    line = F.try_parse_json("value")

    def at(name: str, place: str) -> Column:
        return F.try_variant_get("_line", place, kinds.get(name, "string"))

    lines = spark.read.option("recursiveFileLookup", True).text(path).where("trim(value) <> ''").select(line.alias("_line"))
    named = "method" if "method" in places else next(iter(places))
    shape = F.coalesce(*[F.when(at(named, p).isNotNull(), F.lit(i)) for i, p in enumerate(places[named])])
    readable = F.col("_line").isNotNull() & (F.schema_of_variant("_line").startswith("OBJECT"))
    return lines.select(*[F.coalesce(*[at(name, p) for p in found]).alias(name) for name, found in places.items()],
                        F.coalesce(readable, F.lit(False)).alias("readable"), shape.alias("shape"))


def latest_batch(df: DataFrame, column: str = "batch_date") -> DataFrame:
    """Rows of the newest batch, by a one-row join instead of a driver round trip."""
    newest = df.agg(F.max(column).alias("_newest"))
    return df.join(F.broadcast(newest), F.col(column) == F.col("_newest")).drop("_newest")


def write_summary(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_summary(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def export_tables(tables: Mapping[str, DataFrame], root: str) -> DataFrame:
    """Write each table as Parquet; return and store the row counts, taken during the write."""
    spark = next(iter(tables.values())).sparkSession
    counts = []
    for name, df in tables.items():
        rows, seen = _counted(df)
        rows.write.mode("overwrite").parquet(f"{root}/{name}")
        counts.append((name, _rows(seen)))
    manifest = spark.createDataFrame(counts, "table string, rows bigint")
    manifest.write.mode("overwrite").json(f"{root}/_manifest")
    return manifest


def load_named(spark: SparkSession, name: str, live: Mapping[str, str], snapshot_root: str,
               schema: T.StructType | str, relation: str | None = None) -> DataFrame:
    """A report table: live query if its relation exists, else snapshot, else empty."""
    if name in live and relation and spark.catalog.tableExists(relation):
        return spark.sql(live[name])
    snapshot = read_or_none(spark, f"{snapshot_root}/{name}", schema)
    return spark.createDataFrame([], schema) if snapshot is None else snapshot
