"""Tables of Parquet partitions that change together.

    <path>/<table>/_run=<run>/<partition>/   what one run wrote, once
    <path>/commits/<version>                 a JSON record that says, besides what the caller
                                             keeps in it, from which run every partition is read

A run writes the partitions that it changes into a folder of its own and then its record,
in one rename. Until then readers and later runs see the record before, of all tables, so
a run that dies can be repeated and two runs at once cannot touch each other's files: the
second to commit is refused. The files of the last two records are kept.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Files of one run in a partition that are always good enough, and bytes that a file should
# have on average where there are more.
FILES, FILE_BYTES = 8, 1 << 18


class Versions:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _place(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self, *parts: str) -> list[str]:
        files, path = self._place(*parts)
        return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []

    def _records(self) -> list[str]:
        return [n for n in self._names("commits") if n.isdigit()]

    def _read(self, name: str) -> dict:
        files, path = self._place("commits", name)
        stream = files.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def last(self) -> dict | None:
        """The newest record: {version, tables: table -> partition -> run, ...}."""
        names = self._records()
        return self._read(names[-1]) if names else None

    def begin(self, before: dict | None) -> str:
        """The name of a run that builds on that record."""
        return f"{1 + (before['version'] if before else 0):012d}-{uuid.uuid4().hex[:8]}"

    def write(self, table: str, df: DataFrame, run: str, by: tuple[str, ...] = (), mode: str = "error") -> list[str]:
        """Write df as the run's partitions of the table; returns the names of those that
        the run has now."""
        return self._write(table, df.hint("rebalance", *by) if by else df, run, by, mode)

    def write_in_place(self, table: str, df: DataFrame, run: str, by: tuple[str, ...]) -> list[str]:
        """As write(), for whole rows: each task writes the rows that it has, so that they are
        not shuffled once more. A row in a file has a fraction of its size in a shuffle.
        Only if partitions get many small files that way, they are read and dealt out."""
        loose = f"{table}_loose"
        parts = self._write(loose, df, run, by)
        files, folder = self._place(loose, f"_run={run}")
        number = sum(len(self._names(loose, f"_run={run}", p)) for p in parts)
        if number > FILES * len(parts) and files.getContentSummary(folder).getLength() < FILE_BYTES * number:
            parts = self.write(table, self.read_run(loose, df.schema, run), run, by)
            self.drop(loose, run)
            return parts
        _, place = self._place(table, f"_run={run}")
        files.mkdirs(place.getParent())
        if not files.rename(folder, place):
            raise RuntimeError(f"cannot move {folder} to {place}")
        return parts

    def _write(self, table: str, df: DataFrame, run: str, by: tuple[str, ...], mode: str = "error") -> list[str]:
        folder = f"_run={run}"
        writer = df.write.mode(mode).option("compression", "zstd")
        (writer.partitionBy(*by) if by else writer).parquet(f"{self.path}/{table}/{folder}")
        found = [""]
        for _ in by:
            found = [f"{p}/{n}".lstrip("/") for p in found for n in self._names(table, folder, *filter(None, [p])) if "=" in n]
        return found

    def read(self, table: str, schema: T.StructType, record: dict | None, partitions=None) -> DataFrame:
        """Rows of the table, or of some of its partitions; schema includes the columns
        that it is partitioned by."""
        held = (record or {"tables": {}})["tables"].get(table, {})
        folders = [f"{self.path}/{table}/_run={run}/{p}" for p, run in held.items() if partitions is None or p in partitions]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{table}").parquet(*folders).select(schema.names)

    def read_places(self, table: str, schema: T.StructType, record: dict | None, partitions) -> DataFrame:
        """As read(), with the place of each row: its file and its number in it."""
        rows = self.read(table, schema, record, partitions)
        if not rows.inputFiles():
            return rows.withColumns({"_file": F.lit(""), "_row": F.lit(0).cast("long")})
        return rows.select(*schema.names, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))

    def read_run(self, table: str, schema: T.StructType, run: str) -> DataFrame:
        """What a run has written, committed or not."""
        return (self.spark.read.schema(schema).option("basePath", f"{self.path}/{table}")
                .parquet(f"{self.path}/{table}/_run={run}").select(schema.names))

    def drop(self, table: str, run: str, partitions=None) -> None:
        """Delete what a run that is not committed has written, or some partitions of it."""
        for partition in [None] if partitions is None else partitions:
            self._delete(table, f"_run={run}", *filter(None, [partition]))

    def commit(self, before: dict | None, run: str, written: dict[str, list[str]],
               removed: dict[str, list[str]], kept: dict) -> dict:
        """Make the written partitions the ones that are read, and drop the removed ones."""
        tables = {t: dict(p) for t, p in (before or {"tables": {}})["tables"].items()}
        for table, names in removed.items():
            for name in names:
                tables.get(table, {}).pop(name, None)
        for table, names in written.items():
            tables.setdefault(table, {}).update(dict.fromkeys(names, run))
        record = kept | {"version": int(run[:12]), "run": run, "tables": tables}
        files, draft = self._place("commits", f"_{run}")
        _, final = self._place("commits", run[:12])
        stream = files.create(draft, True)
        stream.write(bytearray(json.dumps(record).encode()))
        stream.close()
        if files.exists(final) or not files.rename(draft, final):
            raise RuntimeError(f"another run has committed version {run[:12]}")
        return record

    def remove_old(self) -> None:
        """Delete what the last two records don't read: partitions that older records name,
        what older runs that died left behind, and older records. Runs that build on the
        record before the newest may still be at work, to be refused when they commit."""
        names = self._records()
        if not names:
            return
        records = [self._read(n) for n in names]
        named = [{(t, r, p) for t, parts in x["tables"].items() for p, r in parts.items()} for x in records]
        kept, runs = set().union(*named[-2:]), {x["run"] for x in records[-2:]}
        alive, tables = runs | {r for _, r, _ in kept}, {t for t, _, _ in set().union(*named)}
        for table in (n for n in self._names() if n != "commits"):
            for folder in self._names(table):
                run = folder.removeprefix("_run=")
                if folder.startswith("_run=") and run not in (alive if table in tables else runs) and int(run[:12]) < int(names[-1]):
                    self._delete(table, folder)
        for table, run, partition in set().union(*named[:-2]) - kept:
            if partition and run in alive:
                self._delete(table, f"_run={run}", partition)
        for name in names[:-2]:
            self._delete("commits", name)

    def _delete(self, *parts: str) -> None:
        files, path = self._place(*parts)
        files.delete(path, True)
