"""The model chain: landing -> staged -> deduplicated -> fact -> dimension and marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqmill.functions.scalars import (approx_median, code, hours_between, ratio, round_half, text,
                                       to_double, to_timestamp, upper_text)
from reqmill.schema import FACT_COLUMNS

FIRST_DATE = dt.date(1900, 1, 1)


def stage(landed: DataFrame) -> DataFrame:
    """Typed and trimmed, one row in, one row out."""
    as_is = {"request_id": F.trim("request_id"), "agency_code": code(F.col("agency_code"))}
    stamps = {c: to_timestamp(F.col(c)) for c in ("created_at", "closed_at", "resolution_updated_at")}
    numbers = {c: to_double(F.col(c)) for c in ("latitude", "longitude")}
    upper = {c: upper_text(F.col(c)) for c in ("borough", "intake_channel")}
    lineage = {
        "source_system": F.col("_source_system"),
        "batch_date": F.col("_batch_date").cast("date"),
        "batch_id": F.col("_batch_id"),
        "ingested_at": to_timestamp(F.col("_ingested_at")),
    }
    typed = as_is | stamps | numbers | upper
    return landed.select(
        *[typed.get(c, text(F.col(c))).alias(c) for c in landed.columns if not c.startswith("_")],
        *[c.alias(name) for name, c in lineage.items()])


def _descending(c: Column, dtype: T.DataType) -> Column:
    """Whole-number sort key for newest first; nulls become last in a minimum."""
    if isinstance(dtype, T.DateType):
        number = F.unix_date(c).cast("bigint")
    else:
        # Microseconds of a zone-free timestamp, by calendar arithmetic.
        micros = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
        number = ((F.unix_date(F.to_date(c)).cast("bigint") * 86400
                   + F.hour(c) * 3600 + F.minute(c) * 60) * 1_000_000 + micros)
    return F.coalesce(-number, F.lit((1 << 63) - 1))


def dedup_order(staged: DataFrame) -> list[Column]:
    """What the newest row of a request is least in."""
    dtypes = {f.name: f.dataType for f in staged.schema}
    order = [_descending(F.col(c), dtypes[c]).alias(f"_{c}") for c in ("ingested_at", "batch_date")]
    return order + [F.col(c).isNull().alias(f"_no_{c}") if missing else F.col(c).alias(f"_{c}")
                    for c in ("source_system", "batch_id") for missing in (True, False)]


def deduplicate(staged: DataFrame, key: str = "request_id") -> DataFrame:
    """The newest row per key, and whether the key landed more than once.

    The winner is a minimum over (order, row), so copies are folded before the
    shuffle: a key that holds a large share of all rows costs one row per task,
    where a ranking window would sort all its rows in one. The rest of the row
    breaks ties the order leaves open.
    """
    best = staged.groupBy(key).agg(F.min(candidate(staged, key)).alias("best"), F.count("*").alias("times_landed"))
    return best.select(*winner(staged, key), (F.col("times_landed") > 1).alias("was_relanded"))


# Columns whose own value is in the order, under the name with a dash before it.
_ORDERED = ("source_system", "batch_id")


def candidate(staged: DataFrame, key: str) -> Column:
    """A row with its order before it. Strings that are in the order are there only."""
    return F.struct(*dedup_order(staged), F.struct(*[c for c in staged.columns if c not in (key, *_ORDERED)]).alias("row"))


def winner(staged: DataFrame, key: str) -> list[Column]:
    """The columns of staged, from the least candidate."""
    return [F.col(key) if c == key else F.col(f"best._{c}" if c in _ORDERED else f"best.row.{c}").alias(c) for c in staged.columns]


def build_fact(requests: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per request with the derived columns, and with extra ones of requests."""
    closed, created = F.col("closed_at"), F.col("created_at")
    backdated = F.coalesce(closed < created, F.lit(False))
    derived = {
        "created_date": created.cast("date"),
        "is_closed": closed.isNotNull(),
        "has_invalid_timestamps": backdated,
        "resolution_hours": F.when(closed.isNotNull() & ~backdated,
                                   round_half(hours_between(created, closed), 3)),
    }
    wanted = [f.name for f in T._parse_datatype_string(FACT_COLUMNS)]
    return requests.withColumns(derived).select(
        [c for c in [*wanted, *extra] if c in requests.columns or c in derived])


def agency_dimension(requests: DataFrame) -> DataFrame:
    """Totals per agency with its most frequent name.

    Everything comes from counts per (code, name), so the requests are read and
    shuffled once, already folded.
    """
    return agency_totals(name_counts(requests))


def name_counts(requests: DataFrame, *by: str) -> DataFrame:
    """Counts and first and last date per agency code and name."""
    return requests.groupBy(*by, "agency_code", "agency_name").agg(
        F.count("*").alias("n"), F.count("closed_at").alias("closed"),
        F.min("created_at").alias("first"), F.max("created_at").alias("last"))


def agency_totals(counts: DataFrame) -> DataFrame:
    """The dimension from name_counts(), which may be in parts."""
    per_name = counts.groupBy("agency_code", "agency_name").agg(
        F.sum("n").alias("n"), F.sum("closed").alias("closed"), F.min("first").alias("first"), F.max("last").alias("last"))
    named = F.when(F.col("agency_name").isNotNull(),
                   F.struct((-F.col("n")).alias("rank"), F.col("agency_name").alias("name")))
    totals = per_name.groupBy("agency_code").agg(
        F.min(named)["name"].alias("name"), F.sum("n").alias("total_requests"),
        F.sum("closed").alias("closed_requests"),
        F.min("first").alias("first_seen_at"), F.max("last").alias("last_seen_at"))
    return totals.select(
        "agency_code", F.coalesce("name", F.lit("UNKNOWN")).alias("agency_name"),
        "total_requests", "closed_requests",
        ratio(F.col("closed_requests"), F.col("total_requests")).alias("closure_rate"),
        "first_seen_at", "last_seen_at")


_DAY = ["created_date", "borough", "agency_code"]


def daily_sla(fact: DataFrame) -> DataFrame:
    """Volume, closure and resolution times per day, borough and agency.

    The exact median and the distinct count both need the values of a group. Each
    request is turned into a (group, complaint type) and a (group, hours) cell and
    the cells are counted, spread over the cluster by cell. What then meets in one
    place per group is its distinct values, ordered by a sort that can spill, not
    its rows. Hours are three-decimal numbers, summed as whole thousandths, so the
    average does not depend on the order of addition.
    """
    return daily_from_cells(daily_cells(fact))


def daily_cells(fact: DataFrame, sign: Column | None = None) -> DataFrame:
    """How many rows of each day, borough and agency have a complaint type (and how many
    of them are closed), and how many a number of hours. Rows count `sign` each, so that
    a row can be taken back."""
    sign = F.lit(1) if sign is None else sign

    def cell(by_type, complaint_type, hours, is_closed):
        return F.struct(F.lit(by_type).alias("by_type"), complaint_type.alias("complaint_type"),
                        hours.alias("hours"), is_closed.alias("closed"))

    none = F.lit(None)
    rows = fact.select(
        "created_date", F.coalesce("borough", F.lit("UNSPECIFIED")).alias("borough"), "agency_code",
        sign.alias("_sign"), F.inline(F.array(
            cell(True, F.col("complaint_type"), none.cast("double"), F.col("is_closed")),
            cell(False, none.cast("string"), F.col("resolution_hours"), F.lit(False)))))
    rows = rows.where(F.col("by_type") | F.col("hours").isNotNull())
    return rows.groupBy(*_DAY, "by_type", "complaint_type", "hours").agg(
        F.sum("_sign").alias("n"), F.sum(F.when(F.col("closed"), F.col("_sign")).otherwise(0)).alias("closed"))


def daily_from_cells(cells: DataFrame) -> DataFrame:
    """The daily mart from daily_cells()."""
    whole = Window.partitionBy(*_DAY)
    timed = F.when(~F.col("by_type"), F.col("n")).otherwise(F.lit(0))
    ranked = cells.withColumns({
        "upto": F.sum(timed).over(whole.orderBy(F.col("hours").asc_nulls_first())
                                  .rowsBetween(Window.unboundedPreceding, 0)),
        "timed": F.sum(timed).over(whole)})
    has = F.col("hours").isNotNull()
    lower = F.min(F.when(has & (F.col("upto") >= F.floor((F.col("timed") + 1) / 2)), F.col("hours")))
    upper = F.min(F.when(has & (F.col("upto") >= F.floor(F.col("timed") / 2) + 1), F.col("hours")))
    milli = F.sum(F.round(F.col("hours") * 1000).cast("bigint") * F.col("n"))
    opened = F.sum(F.when(F.col("by_type"), F.col("n")).otherwise(F.lit(0)))
    # A lone (group, type) cell per type makes the distinct count a plain count.
    return ranked.groupBy(*_DAY).agg(
        opened.alias("requests_opened"), F.sum("closed").alias("requests_closed"),
        ratio(F.sum("closed"), opened).alias("closure_rate"),
        round_half(milli / F.lit(1000.0) / F.max(F.nullif(F.col("timed"), F.lit(0))), 3).alias("avg_resolution_hours"),
        round_half((lower + upper) / 2, 3).alias("median_resolution_hours"),
        F.max("hours").alias("max_resolution_hours"),
        F.count_if(F.col("by_type") & F.col("complaint_type").isNotNull()).alias("distinct_complaint_types"))


def daily_sla_approx(fact: DataFrame) -> DataFrame:
    """Daily medians by estimate: one shuffle, bounded memory per group."""
    return fact.groupBy(
        "created_date", F.coalesce("borough", F.lit("UNSPECIFIED")).alias("borough"), "agency_code"
    ).agg(F.count("*").alias("requests_opened"),
          approx_median(F.col("resolution_hours")).alias("median_resolution_hours"))


def daily_sketches(fact: DataFrame) -> DataFrame:
    """The daily mart with sketches in place of medians and distinct counts: columns of a
    few KB at most that add up, so that any range or group of days is answered from the
    mart. A KLL sketch of the hours, an HLL one of the complaint types."""
    return fact.groupBy("created_date", F.coalesce("borough", F.lit("UNSPECIFIED")).alias("borough"), "agency_code").agg(
        F.count("*").alias("requests_opened"), F.count_if("is_closed").alias("requests_closed"),
        F.count("resolution_hours").alias("timed"),
        F.kll_sketch_agg_double(F.col("resolution_hours")).alias("hours"), F.hll_sketch_agg("complaint_type").alias("types"))


def sketch_totals(sketched: DataFrame, *by: Column | str) -> DataFrame:
    """Counts, the estimated median of the hours (null without any) and the estimated number
    of complaint types of any groups of daily_sketches()."""
    merged = sketched.groupBy(*by)
    timed = F.col("timed") > 0
    totals = merged.agg(
        F.sum("requests_opened").alias("requests_opened"), F.sum("requests_closed").alias("requests_closed"),
        F.sum("timed").alias("timed"), F.kll_merge_agg_double("hours").alias("_hours"),
        F.hll_sketch_estimate(F.hll_union_agg("types")).alias("complaint_types"))
    median = F.when(timed, F.kll_sketch_get_quantile_double("_hours", F.lit(0.5)))
    return totals.withColumn("median_resolution_hours", median).drop("_hours")


# --- incremental fact -----------------------------------------------------

def changed_requests(staged: DataFrame, since: dt.date) -> DataFrame:
    """Deduplicated requests whose winning row is of batch `since` or later.

    Only keys seen in those batches can have such a winner, so the rest is
    filtered out before ranking. The keys are folded first.

    Whole rows are those of the batches alone. An older row never ties with them, as the
    batch date is part of the order, so it wins by its ingest time or not at all: older
    rows are joined and shuffled as a key and that time.
    """
    key = "request_id"
    inside = F.coalesce(F.col("batch_date") >= F.lit(since), F.lit(False))
    batches, newest_first = staged.where(F.col("batch_date") >= F.lit(since)), dedup_order(staged)[0]
    keys = batches.select(F.col(key).alias("_id")).distinct()
    older = staged.where(~inside).select(key, newest_first.alias("_before"))
    seen = older.join(keys, F.col(key).eqNullSafe(F.col("_id")), "left_semi")
    best = (batches.withColumn("_fresh", F.lit(True)).unionByName(seen, allowMissingColumns=True).groupBy(key)
            .agg(F.min(F.when(F.col("_fresh"), candidate(staged, key))).alias("best"),
                 F.min("_before").alias("_before"), F.count("*").alias("times_landed")))
    mine = F.col("_before").isNull() | (F.col("best._ingested_at") <= F.col("_before"))
    return best.where(mine).select(*winner(staged, key), (F.col("times_landed") > 1).alias("was_relanded"))


# --- marts of the run without a warehouse ---------------------------------

def _upper_or_unspecified(c: Column) -> Column:
    return F.coalesce(F.nullif(F.upper(c), F.lit("")), F.lit("UNSPECIFIED"))


def live_marts(landed: DataFrame) -> dict[str, DataFrame]:
    """Marts straight from landed strings: no dedup, no trimming of codes,
    unrounded hours, counts of non-null ids."""
    created, closed = to_timestamp(F.col("created_at")), to_timestamp(F.col("closed_at"))
    work = landed.withColumns({"created_at": created, "closed_at": closed})
    backdated = F.coalesce(F.col("closed_at") < F.col("created_at"), F.lit(False))
    day = F.date_diff(F.to_date("closed_at"), F.to_date("created_at")).cast("double") * 86400

    def clock(c: str) -> Column:
        return (F.hour(c) * 3600 + F.minute(c) * 60) + F.extract(F.lit("SECOND"), F.col(c)).cast("double")

    hours = (day + (clock("closed_at") - clock("created_at"))) / 3600
    fact = work.withColumns({
        "has_invalid_timestamps": backdated,
        "resolution_hours": F.when(~backdated, hours),
        "borough": _upper_or_unspecified(F.col("borough"))})
    agencies = fact.where(F.col("agency_code").isNotNull()).groupBy("agency_code").agg(
        F.count("request_id").alias("total_requests"), F.count("closed_at").alias("closed_requests"))
    return {
        "dim_agency": agencies.withColumn(
            "closure_rate", ratio(F.col("closed_requests"), F.col("total_requests"))),
        "top_complaints": fact.where(F.col("complaint_type").isNotNull())
        .groupBy("complaint_type").agg(F.count("*").alias("requests")),
        "borough_mix": fact.groupBy("borough").agg(F.count("*").alias("requests")),
        "fact": fact,
    }
