"""CSV batch files: one folder per day and source system, each with its own headers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqmill.session import drop_dir, shared_dir


class EmptyBatch(ValueError):
    pass


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise EmptyBatch(f"no rows for {what}; an empty batch is not landed")
    return df


def day_dir(root: str, day: dt.date | str) -> str:
    return f"{root.rstrip('/')}/dt={day}"


def write_batch(rows: DataFrame, root: str, day: dt.date | str,
                headers: Mapping[str, Mapping[str, str]],
                extras: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Write each system's rows under its own header names; return the manifest.

    `rows` carries `source_system`, `row_index` and the canonical columns;
    `headers` gives canonical field -> header per system, `extras` the operational
    columns, filled with '<system>-<row number within the system>'.

    The rows are dealt out once, to a folder for each system in the shared scratch
    space, which is deleted at the end; each system's files are then written from its own
    folder.
    """
    extras, spark = extras or {}, rows.sparkSession
    dealt = shared_dir(spark) + "/dealt"
    rows.write.partitionBy("source_system").parquet(dealt)
    rows = rows.sparkSession.read.schema(rows.schema).parquet(dealt)
    for system, names in headers.items():
        stamped = [F.concat(F.lit(f"{system}-"),
                            F.floor(F.col("row_index") / len(headers)).cast("string")).alias(c)
                   for c in extras.get(system, ())]
        (rows.where(F.col("source_system") == system)
         .select(*[F.coalesce(F.col(field), F.lit("")).alias(header)
                   for field, header in names.items()], *stamped)
         .write.mode("overwrite").option("header", True).option("escape", '"')
         .option("emptyValue", "")
         # The writer trims values unless told not to.
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(f"{day_dir(root, day)}/source_system={system}"))
    manifest = batch_manifest(rows, day, {
        system: len(names) + len(extras.get(system, ())) for system, names in headers.items()})
    path = f"{day_dir(root, day)}/_manifest"
    manifest.write.mode("overwrite").json(path)
    drop_dir(spark, dealt)
    return spark.read.schema(manifest.schema).json(path)


def batch_manifest(rows: DataFrame, day: dt.date | str, widths: Mapping[str, int]) -> DataFrame:
    """Rows and columns per source system, with the batch total."""
    spark = rows.sparkSession
    systems = spark.createDataFrame(list(widths.items()), "source_system string, columns int")
    counts = rows.groupBy("source_system").agg(F.count("*").alias("n"))
    files = systems.join(counts, "source_system", "left").select(
        "source_system", F.coalesce("n", F.lit(0)).alias("rows"), "columns")
    return files.agg(
        F.lit(str(day)).alias("batch_date"), F.sum("rows").alias("total_rows"),
        F.sort_array(F.collect_list(F.struct("source_system", "rows", "columns"))).alias("files"))


def batch_systems(spark: SparkSession, root: str, day: dt.date | str) -> list[str]:
    """Source systems with files for the day, sorted."""
    folder = day_dir(root, day)
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                 .option("pathGlobFilter", "*.csv").load(folder).select("path"))
    except AnalysisException as err:
        raise FileNotFoundError(f"no raw partition at {folder}") from err
    names = files.select(F.regexp_extract("path", "source_system=([^/]+)/", 1).alias("s"))
    found = sorted(r.s for r in names.distinct().collect() if r.s)
    if not found:
        raise FileNotFoundError(f"no source files in {folder}")
    return found


def read_batch(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One system's files, every column a string, blanks as ''.

    A quoted value may hold a line break, which makes a file one task; the writer
    above leaves many files per system. Pass multi_line=False for large files
    known to be free of such values.
    """
    return (spark.read.option("header", True).option("multiLine", multi_line)
            .option("escape", '"').option("enforceSchema", False)
            .csv(path).na.fill(""))


WIDTH = 256  # columns a file may have


def read_day(spark: SparkSession, root: str, day: dt.date | str, width: int = WIDTH, scratch: str | None = None) -> DataFrame:
    """(source_system, file, line, cells) of every line of the day's files of all systems,
    headers included, in one scan that is the same plan for any number of systems.

    cells is an array of strings, blanks as ''; `line` ascends within a file. A line of
    more than `width` columns is an error, not a cut. The lines are kept in `scratch`, or else
    in the shared scratch space: they are read for their headers first, then landed.
    """
    names = [f"_c{i}" for i in range(width)]
    schema = ", ".join(f"{c} string" for c in [*names, "_whole"])
    folder = day_dir(root, day)
    try:
        lines = (spark.read.schema(schema).option("header", False).option("multiLine", True).option("escape", '"')
                 .option("columnNameOfCorruptRecord", "_whole").option("basePath", folder)
                 .option("pathGlobFilter", "*.csv").csv(f"{folder}/source_system=*"))
    except AnalysisException as err:
        raise FileNotFoundError(f"no source files in {folder}") from err
    file = F.col("_metadata.file_path")
    # A shorter line is marked too; only one that fills every column may have lost some.
    too_wide = F.col("_whole").isNotNull() & F.col(names[-1]).isNotNull()
    cells = F.when(too_wide, F.raise_error(F.concat(F.lit(f"more than {width} columns in "), file)).cast("array<string>")).otherwise(
        F.transform(F.array(*names), lambda c: F.coalesce(c, F.lit(""))))
    path = f"{scratch or shared_dir(spark)}/lines"
    (lines.select(F.regexp_extract(file, "source_system=([^/]+)/", 1).alias("source_system"), file.alias("file"),
                  F.monotonically_increasing_id().alias("line"), cells.alias("cells")).write.parquet(path))
    return spark.read.parquet(path)


def file_headers(lines: DataFrame) -> DataFrame:
    """(source_system, file, first, header) from the first line of every file of read_day()."""
    header = F.reverse(F.min_by("cells", "line"))
    # What lies behind the last name is the width of the scan.
    width = F.size("header") - F.coalesce(F.array_position(F.transform("header", lambda c: c != ""), True), F.lit(1)) + 1
    return (lines.groupBy("source_system", "file").agg(F.min("line").alias("first"), header.alias("header"))
            .select("source_system", "file", "first", F.slice(F.reverse("header"), F.lit(1), width.cast("int")).alias("header")))


def system_headers(headers: DataFrame) -> DataFrame:
    """(source_system, ordinal, source_column) of every column of every system once, at
    its first place."""
    return (headers.select("source_system", F.posexplode("header").alias("ordinal", "source_column")).where("source_column <> ''")
            .groupBy("source_system", "source_column").agg(F.min("ordinal").alias("ordinal"))
            .select("source_system", "ordinal", "source_column"))


def sample_values(df: DataFrame, order: Sequence[str], columns: Sequence[str] | None = None,
                  n: int = 5) -> DataFrame:
    """Per column the first n non-blank values among the first 4n rows."""
    columns = list(columns or df.columns)
    keys = [F.col(c).asc_nulls_last() for c in order]
    head = df.orderBy(*keys).limit(4 * n).select(
        F.struct(*order).alias("_key"), *[F.col(c).cast("string") for c in columns])
    cells = head.unpivot(["_key"], columns, "source_column", "value")
    kept = cells.where(F.col("value").rlike(r"(?U)\S"))
    ordered = F.sort_array(F.collect_list(F.struct("_key", "value")))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "source_column string")
    samples = kept.groupBy("source_column").agg(
        F.slice(F.transform(ordered, lambda x: x["value"]), 1, n).alias("samples"))
    return names.join(samples, "source_column", "left").select(
        "source_column", F.coalesce("samples", F.array().cast("array<string>")).alias("samples"))
