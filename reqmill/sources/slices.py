"""Reading parts of a request table: a day, the newest rows, bounds, shards."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqmill.session import ensure_checkpoint_dir


def _day_start(df: DataFrame, ts: str, day: dt.date) -> Column:
    dtype = df.schema[ts].dataType
    if isinstance(dtype, T.StringType):
        return F.lit(f"{day.isoformat()}T00:00:00")
    return F.lit(day).cast(dtype)


def day_slice(df: DataFrame, ts: str, day: dt.date, columns: Sequence[str]) -> DataFrame:
    """All rows of one day.

    The bounds are literals of the column's own type, so they reach the scan.
    """
    rows = df.where((F.col(ts) >= _day_start(df, ts, day))
                    & (F.col(ts) < _day_start(df, ts, day + dt.timedelta(days=1))))
    return rows.select(*columns)


def newest(df: DataFrame, ts: str, n: int, tie_break: str) -> DataFrame:
    return df.orderBy(F.col(ts).desc_nulls_last(), F.col(tie_break)).limit(n)


def batch_bounds(df: DataFrame, ts: str) -> DataFrame:
    """Newest and oldest timestamp; blanks count as missing."""
    if isinstance(df.schema[ts].dataType, T.StringType):
        df = df.where(F.col(ts) != "")
    return df.agg(F.max(ts).alias("newest_created_at"), F.min(ts).alias("oldest_created_at"))


def ordered_index(df: DataFrame, order: Sequence[str | Column], name: str = "row_index") -> DataFrame:
    """Add the 0-based position of every row in the order given: names sort upwards
    with nulls last, columns as they say themselves.

    Range partitions are sorted in parallel; a row's position is its place in the
    partition plus the sizes of the partitions before. The sorted rows are
    checkpointed, so the sizes and the rows come from the same split even when an
    executor is lost between the two reads.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    in_partition = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_place", in_partition)
              .checkpoint())
    # One row per partition, so a single-task window and a broadcast are small.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.count("*").alias("n")).select(
        "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    return (placed.join(F.broadcast(starts), "_part")
            .withColumn(name, F.col("_start") + F.col("_place"))
            .drop("_part", "_place", "_start"))


def round_robin(df: DataFrame, order: Sequence[str | Column], names: Sequence[str]) -> DataFrame:
    """Deal the ordered rows out to named shards in turn."""
    indexed = ordered_index(df, order)
    shard = F.element_at(F.array(*[F.lit(n) for n in names]),
                         (F.col("row_index") % len(names) + 1).cast("int"))
    return indexed.withColumn("source_system", shard)
