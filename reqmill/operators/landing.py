"""From a system's own columns to the canonical landing rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqmill.schema import FIELD_NAMES, LINEAGE


def apply_mapping(df: DataFrame, columns: Mapping[str, str], source_system: str,
                  batch_date: str, batch_id: str, ingested_at: str | None = None) -> DataFrame:
    """Rename mapped columns, drop the rest, add absent fields, stamp lineage.

    The ingest time is taken once on the driver, so all rows of the frame share it.
    """
    source = {field: header for header, field in columns.items()}
    stamp = ingested_at or dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds")
    fields = [F.col(f"`{source[f]}`").cast("string").alias(f) if f in source
              else F.lit(None).cast("string").alias(f) for f in FIELD_NAMES]
    lineage = [F.lit(v).alias(c) for c, v in
               zip(LINEAGE, (source_system, str(batch_date), batch_id, stamp))]
    return df.select(*fields, *lineage)


def land_lines(lines: DataFrame, headers: DataFrame, decisions: DataFrame, batch_date: str, batch_id: str,
               ingested_at: str | None = None) -> DataFrame:
    """Canonical rows of all systems' lines (read_day), by the header of each line's own
    file (file_headers) and the decided columns.

    Which cell is which field is a small table with a row for each file, joined to the
    lines: neither the plan nor the driver grows with the number of systems. Of a column
    that a file repeats, the first counts.
    """
    stamp = ingested_at or dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds")
    columns = (headers.select("source_system", "file", F.posexplode("header").alias("at", "source_column"))
               .groupBy("source_system", "file", "source_column").agg(F.min("at").alias("at")))
    decided = decisions.where(F.col("canonical_field").isNotNull()).select("source_system", "source_column", "canonical_field")
    places = (columns.join(decided, ["source_system", "source_column"]).groupBy("file")
              .agg(F.map_from_entries(F.collect_list(F.struct("canonical_field", F.col("at") + 1))).alias("place")))  # fields at most
    known = headers.select("file", "first").join(places, "file", "left")
    rows = lines.join(known, "file").where(F.col("line") > F.col("first"))
    place = F.coalesce("place", F.create_map().cast("map<string,int>"))
    fields = [F.try_element_at("cells", F.try_element_at(place, F.lit(f))).alias(f) for f in FIELD_NAMES]
    lineage = [F.col("source_system"), F.lit(str(batch_date)), F.lit(batch_id), F.lit(stamp)]
    return rows.select(*fields, *[c.alias(n) for n, c in zip(LINEAGE, lineage)])


def dropped_columns(df: DataFrame, columns: Mapping[str, str]) -> list[str]:
    return [c for c in df.columns if c not in columns]


def union_systems(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def merge_by_key(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Rows of `incoming`, and those of `existing` whose key it does not carry."""
    keys = incoming.select(key).where(F.col(key).isNotNull()).distinct()
    return existing.join(keys, key, "left_anti").select(existing.columns).unionByName(incoming)
