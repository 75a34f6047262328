"""A range of batch days in one job: what a run on each of the days would have left.

Every row that was the newest of its request for a while is a version with the days it
was valid from and to. Counts for all days follow from the versions' ends: an entry adds
one on its first day and takes one away on the day after its last, and a running sum over
the days gives each day's number. No day is built on its own, and the landing is read
once for the range.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reqmill.plans import models
from reqmill.plans.models import candidate, winner


def versions(staged: DataFrame, first: dt.date, days: int, key: str = "request_id") -> DataFrame:
    """The columns of deduplicate(), valid_from and valid_to (null: still valid) of every
    version in `days` days from first on. What landed before counts as of the first day,
    what lands after the last is left out.

    Rows fold to one per request and day before they are shuffled, so a request with many
    rows is as many rows as there are days, and its window no longer.
    """
    last = first + dt.timedelta(days=days - 1)
    on = F.greatest(F.col("batch_date"), F.lit(first))
    daily = (staged.where((F.col("batch_date") <= F.lit(last)) | F.col("batch_date").isNull())
             .groupBy(key, F.coalesce(on, F.lit(first)).alias("_on"))
             .agg(F.min(candidate(staged, key)).alias("best"), F.count("*").alias("n")))
    by_day = Window.partitionBy(key).orderBy("_on")
    sofar = by_day.rowsBetween(Window.unboundedPreceding, 0)
    state = daily.select(key, "_on", F.min("best").over(sofar).alias("best"), (F.sum("n").over(sofar) > 1).alias("was_relanded"))
    before = F.lag(F.struct("best", "was_relanded")).over(by_day)
    changed = state.withColumn("_same", F.struct("best", "was_relanded").eqNullSafe(before)).where(~F.col("_same"))
    return changed.select(
        *winner(staged, key), "was_relanded", F.col("_on").alias("valid_from"), F.lead("_on").over(by_day).alias("valid_to"))


def fact_versions(staged: DataFrame, first: dt.date, days: int) -> DataFrame:
    """The fact's rows with the days they are valid from and to."""
    return models.build_fact(versions(staged, first, days), extra=("valid_from", "valid_to"))


def as_of(history: DataFrame, day: Column) -> DataFrame:
    """The versions valid on a day."""
    return history.where((F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (F.col("valid_to") > day))).drop("valid_from", "valid_to")


def _entries(history: DataFrame, by: Sequence[Column]) -> DataFrame:
    """(day, n): how many distinct values of `by` the valid versions gain on a day, less
    those that they lose."""
    names = [f"_k{i}" for i in range(len(by))]
    ends = F.inline(F.array(F.struct(F.col("valid_from").alias("day"), F.lit(1).alias("n")),
                            F.struct(F.col("valid_to").alias("day"), F.lit(-1).alias("n"))))
    moved = (history.select(*[c.alias(n) for c, n in zip(by, names)], "valid_from", "valid_to").select(*names, ends)
             .where("day is not null").groupBy(*names, "day").agg(F.sum("n").alias("n")).where("n <> 0"))
    now = F.sum("n").over(Window.partitionBy(*names).orderBy("day").rowsBetween(Window.unboundedPreceding, 0))
    held = moved.select("day", "n", now.alias("now"))
    return held.groupBy("day").agg(F.sum((F.col("now") > 0).cast("int") - (F.col("now") - F.col("n") > 0).cast("int")).alias("n"))


def funnel_by_day(staged: DataFrame, history: DataFrame, first: dt.date, days: int) -> DataFrame:
    """(batch_date, stage, rows): the rows of every stage after the run of each day.
    history is fact_versions() of staged."""
    spark, last = staged.sparkSession, first + dt.timedelta(days=days - 1)
    landed = (staged.where((F.col("batch_date") <= F.lit(last)) | F.col("batch_date").isNull())
              .groupBy(F.coalesce(F.greatest("batch_date", F.lit(first)), F.lit(first)).alias("day")).agg(F.count("*").alias("n")))
    requests = _entries(history, [F.col("request_id")])
    stages = {
        "1_landed": landed, "2_staged": landed, "3_deduped": requests, "4_fact": requests,
        "5_daily_mart": _entries(history, [F.col("created_date"), F.coalesce("borough", F.lit("UNSPECIFIED")), F.col("agency_code")]),
        "5_agency_dim": _entries(history, [F.col("agency_code")])}
    # A row for each day and stage from here on.
    steps = None
    for stage, moved in stages.items():
        step = moved.select("day", "n", F.lit(stage).alias("stage"))
        steps = step if steps is None else steps.unionByName(step)
    every = (spark.range(days).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("day"),
                                      F.explode(F.array(*map(F.lit, stages))).alias("stage")))
    running = Window.partitionBy("stage").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return every.join(steps, ["day", "stage"], "left").select(
        F.col("day").alias("batch_date"), "stage", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("rows"))
