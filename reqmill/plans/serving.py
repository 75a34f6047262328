"""Report queries over the fact, the marts, the checks and the header decisions.

Ordered results sort on the report's key and then on a unique one, so that a
top-k is the same on every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqmill.functions.scalars import round_half, utc_now
from reqmill.operators.checks import not_passing
from reqmill.operators.mapping import counts_by_method
from reqmill.schema import METHODS, SOURCE_SYSTEMS


def daily_volume(daily: DataFrame) -> DataFrame:
    return daily.groupBy("created_date", "borough").agg(
        F.sum("requests_opened").alias("requests_opened"),
        F.sum("requests_closed").alias("requests_closed")).orderBy("created_date", "borough")


def agencies_by_volume(dim: DataFrame) -> DataFrame:
    return dim.orderBy(F.desc("total_requests"), "agency_code")


def top_complaints(fact: DataFrame, k: int = 15) -> DataFrame:
    """Complaint types by volume with their average hours.

    Hours have three decimals and are summed as whole thousandths.
    """
    timed = F.count("resolution_hours")
    milli = F.sum(F.round(F.col("resolution_hours") * 1000).cast("bigint"))
    return (fact.groupBy("complaint_type")
            .agg(F.count("*").alias("requests"),
                 round_half(milli / F.lit(1000.0) / F.nullif(timed, F.lit(0)), 2).alias("avg_resolution_hours"))
            .orderBy(F.desc("requests"), F.asc_nulls_last("complaint_type")).limit(k))


# The columns of the report.
NEWEST_COLUMNS = ["request_id", "created_at", "closed_at", "agency_code", "complaint_type",
                  "descriptor", "borough", "status", "resolution_hours", "has_invalid_timestamps",
                  "source_system", "batch_date"]


def newest_facts(fact: DataFrame, k: int = 8000) -> DataFrame:
    return (fact.select([c for c in NEWEST_COLUMNS if c in fact.columns])
            .orderBy(F.desc_nulls_last("created_at"), "request_id").limit(k))


def timestamp_anomalies(fact: DataFrame) -> DataFrame:
    # The columns of the report.
    return (fact.where("has_invalid_timestamps")
            .select("request_id", "agency_code", "complaint_type", "created_at", "closed_at", "borough")
            .orderBy("created_at", "request_id"))


def volume_of_first_boroughs(volume: DataFrame, n: int = 5) -> DataFrame:
    """Daily volume of the first n boroughs by name, UNSPECIFIED left out."""
    first = (volume.select("borough").where(F.col("borough") != "UNSPECIFIED").distinct()
             .orderBy("borough").limit(n))
    return volume.join(first, "borough", "left_semi")


def counts_by(df: DataFrame, column: str, name: str = "requests") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(name)).orderBy(F.desc(name), column)


def live_reports(fact: DataFrame, dim: DataFrame) -> dict[str, DataFrame]:
    """The marts a live run shows."""
    borough = F.coalesce("borough", F.lit("UNSPECIFIED")).alias("borough")
    return {
        "dim_agency": agencies_by_volume(dim).select(
            "agency_code", "total_requests", "closed_requests", "closure_rate"),
        "top_complaints": counts_by(fact, "complaint_type"),
        "borough_mix": counts_by(fact.select(borough), "borough"),
        "fact": fact,
    }


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def known_headers(dialects: DataFrame) -> DataFrame:
    """Every header of every system once, operational ones included, sorted."""
    mapped = dialects.where(F.col("canonical_field").isNotNull()).select("header")
    extra = dialects.where(F.col("canonical_field").isNull()).select("header")
    return mapped.union(extra).distinct().orderBy("header")


def header_comparison(dialects: DataFrame, systems: Sequence[str] = SOURCE_SYSTEMS,
                      fields: Sequence[str] | None = None) -> DataFrame:
    """One row per canonical field, one column per system with its header, the smallest
    if a system has several."""
    rows = dialects.where(F.col("canonical_field").isNotNull())
    if fields is not None:
        rows = rows.where(F.col("canonical_field").isin(list(fields)))
    return (rows.groupBy("canonical_field").pivot("source_system", list(systems))
            .agg(F.min("header")))


def override_listing(overrides: DataFrame) -> DataFrame:
    return overrides.select("source_system", "source_column", "canonical_field")


def schema_listing(fields: DataFrame) -> DataFrame:
    return fields.select(F.col("name").alias("field"), F.col("dtype").alias("type"),
                         "required", "description", "ordinal")


def test_outcomes(results: DataFrame, metadata: DataFrame) -> DataFrame:
    """Checks by type and status; a check without metadata is 'singular'."""
    typed = results.select("unique_id", "status").join(metadata, "unique_id", "left")
    return (typed.groupBy(F.coalesce("type", F.lit("singular")).alias("type"), "status")
            .agg(F.count("*").alias("tests")).orderBy(F.desc("tests"), "type", "status"))


test_outcomes.__test__ = False


def failing_checks(results: DataFrame) -> DataFrame:
    """Checks that did not pass, with their failing rows."""
    return results.where(F.col("status") != "pass").select(
        F.col("test").alias("check"), F.col("failures").alias("failing_rows"))


def _record(one_row: DataFrame) -> Column:
    """A one-row frame as a struct, by scalar subquery."""
    return one_row.select(F.struct("*")).scalar()


def headline(fact: DataFrame, decisions: DataFrame, summary: DataFrame) -> DataFrame:
    """One row of totals over the fact, the decisions with their tiers, and the checks."""
    auto = F.col("method") != "override"
    mapped = auto & F.col("canonical_field").isNotNull()
    rows = fact.agg(F.count("*").alias("rows_loaded"),
                    F.count_distinct("batch_date").alias("batches"))
    tiers = decisions.agg(
        F.count("*").alias("mapping_decisions"),
        (F.count_if(mapped).cast("double") / F.nullif(F.count_if(auto), F.lit(0))).alias("auto_match_rate"),
        *[F.count_if(F.col("method") == m).alias(m) for m in METHODS])
    checks = summary.select("tests_total", "tests_failed", "test_pass_rate")
    return rows.select("*", _record(tiers).alias("m"), _record(checks).alias("q")).select(
        *rows.columns, "m.*", "q.*")


def run_report(batch_date: str, batch_id: str, funnel: DataFrame, summary: DataFrame,
               rollup: DataFrame, histogram: DataFrame, decisions: DataFrame, results: DataFrame,
               written_at: str | None = None, run_seconds: float | None = None,
               checks_seconds: float | None = None) -> DataFrame:
    """The run as one nested record, with how long the run and its checks took."""
    def listed(df, *columns):
        return df.agg(F.sort_array(F.collect_list(F.struct(*columns)))).scalar()

    return funnel.sparkSession.range(1).select(
        F.lit(batch_date).alias("batch_date"), F.lit(batch_id).alias("batch_id"),
        listed(funnel, "stage", "rows").alias("row_counts"),
        _record(summary).alias("tests"), _record(rollup).alias("mapping"),
        listed(histogram, "position", "bucket", "columns").alias("confidence"),
        listed(counts_by_method(decisions), "position", "method", "columns").alias("methods"),
        decisions.agg(F.count("*")).scalar().alias("decisions"),
        listed(not_passing(results), "test", "status", "failures").alias("not_passing"),
        F.lit(run_seconds).cast("double").alias("run_seconds"), F.lit(checks_seconds).cast("double").alias("checks_seconds"),
        F.lit(written_at or utc_now().isoformat(timespec="seconds")).alias("written_at"))
