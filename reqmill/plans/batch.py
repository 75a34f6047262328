"""Batch runs: extract a day, resolve and land its files, build, check, report."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reqmill.functions.scalars import batch_dates, ntz, utc_now
from reqmill.operators import checks as Q
from reqmill.operators import mapping as M
from reqmill.operators.landing import apply_mapping, land_lines, union_systems
from reqmill.plans import models, serving
from reqmill.plans.fact_table import FactTable
from reqmill.session import drop_dir, ensure_checkpoint_dir, shared_dir
from reqmill.sources import batch_files as files
from reqmill.sources import slices, tables


@dataclass(frozen=True)
class Layout:
    """Where a run keeps its files, on storage all executors reach."""
    root: str

    def __getattr__(self, name: str) -> str:
        places = {"raw_files": "files", "landing": "raw/service_requests_raw",
                  "fact": "analytics/service_requests", "decision_log": "reports/mapping_decisions",
                  "reports": "reports", "folds": "staging/check_folds"}
        if name not in places:
            raise AttributeError(name)
        return f"{self.root.rstrip('/')}/{places[name]}"


@dataclass
class Dialects:
    """What the source systems call things; overrides(source_system, source_column,
    canonical_field) and proposals are tables or None."""
    headers: Mapping[str, Mapping[str, str]]                 # system -> field -> header
    extras: Mapping[str, Sequence[str]] = field(default_factory=dict)
    overrides: DataFrame | None = None
    proposals: DataFrame | None = None


def extract_day(source: DataFrame, names: Mapping[str, str], day: dt.date, dialects: Dialects,
                layout: Layout) -> DataFrame:
    """One day of the source as a file set per system; returns the manifest.

    `names` gives source column -> canonical field.
    """
    stamp = next(c for c, f in names.items() if f == "created_at")
    rows = slices.day_slice(source, stamp, day, list(names))
    renamed = rows.select(*[F.col(c).cast("string").alias(f) for c, f in names.items()])
    dealt = slices.round_robin(renamed, ["request_id"], list(dialects.headers))
    files.require_rows(dealt, str(day))
    return files.write_batch(dealt, layout.raw_files, day, dialects.headers, dialects.extras)


def ingest_day(spark: SparkSession, day: dt.date, batch_id: str, dialects: Dialects,
               layout: Layout, strict: bool = True) -> tuple[int, DataFrame]:
    """Resolve the headers of the day's files and land the rows.

    All systems' files are read in one scan, and their headers resolved in one job.
    Returns rows loaded and the decisions, read back from the log they are written to.
    """
    scratch = shared_dir(spark)
    lines = files.read_day(spark, layout.raw_files, day, scratch=scratch)
    headers = files.file_headers(lines)
    overrides = None if dialects.overrides is None else M.validate_overrides(dialects.overrides)
    resolved = M.resolve_headers(files.system_headers(headers), overrides, dialects.proposals)
    tables.append_decisions(resolved, layout.decision_log, str(day), batch_id)
    decisions = tables.read_decisions(spark, layout.decision_log, str(day), batch_id)
    if strict:
        M.require_fields(decisions)
    rows = tables.replace_batch(land_lines(lines, headers, decisions, str(day), batch_id), layout.landing, str(day))
    drop_dir(spark, scratch)
    return rows, decisions


def fold_landing(spark: SparkSession, layout: Layout, day: dt.date, checks: Sequence[Q.Check]) -> dict[str, DataFrame]:
    """Folds of the checks on landed and on staged rows, one for each batch. Only the
    batch of the day, and batches that were never folded, are read."""
    todo = sorted({str(day)} | tables.batch_dates(spark, layout.landing) - tables.batch_dates(spark, f"{layout.folds}/staged"))
    raw = tables.read_landing(spark, layout.landing).where(F.col("_batch_date").isin(todo))
    staged = models.stage(raw).withColumn("_batch_date", F.col("batch_date").cast("string"))
    folds = {}
    for model, rows in (("raw", raw), ("staged", staged)):
        folded = Q.fold(checks, model, rows, "_batch_date")
        path = f"{layout.folds}/{model}"
        (folded.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch_date").parquet(path))
        folds[model] = spark.read.schema(folded.schema).parquet(path)
    return folds


def build_models(spark: SparkSession, layout: Layout, reprocess_from: dt.date | None = None,
                 checks: Sequence[Q.Check] = ()) -> dict[str, DataFrame]:
    """Bring the fact and its marts up to date; all of them change in one commit.

    What a day's run reads of the past is the partitions that can hold a changed request
    and the months that its rows move in. Counting the requests ever landed reads their
    ids alone.
    """
    raw = tables.read_landing(spark, layout.landing)
    staged = models.stage(raw)
    fact = FactTable(spark, layout.fact, checks=checks)
    fact.update(staged, reprocess_from)
    return {"raw": raw, "staged": staged, "deduped": staged.select("request_id").distinct(), "fact": fact.read(),
            "dim": fact.agencies(), "daily": fact.daily()} | ({
                "fact_folds": fact.folds(), "repeated": fact.repeated()} if checks else {})


def _row_counts(spark: SparkSession, layout: Layout, day: dt.date) -> DataFrame:
    """(source_system, rows_read, rows_loaded): rows of the day's files, by their
    manifest, and in the landing."""
    files_of_day = spark.read.schema("files array<struct<source_system:string,rows:bigint>>").json(
        f"{files.day_dir(layout.raw_files, day)}/_manifest")
    read = files_of_day.select(F.inline("files").alias("source_system", "rows_read"))
    loaded = (tables.read_landing(spark, layout.landing).where(F.col("_batch_date") == str(day))
              .groupBy(F.col("_source_system").alias("source_system")).agg(F.count("*").alias("rows_loaded")))
    return read.join(loaded, "source_system", "left")


def run_batch(spark: SparkSession, source: DataFrame, names: Mapping[str, str], day: dt.date,
              dialects: Dialects, layout: Layout, batch_id: str | None = None,
              now: str | None = None, enforce: bool = True,
              reprocess_from: dt.date | None = None) -> DataFrame:
    """One batch date end to end; returns the stored report.

    A batch older than the fact's mark lands but doesn't reach the fact, unless
    `reprocess_from` names its date or an older one.
    """
    batch_id = batch_id or f"local-{day}-{utc_now():%H%M%S}"
    started = time.monotonic()
    extract_day(source, names, day, dialects, layout)
    _, decisions = ingest_day(spark, day, batch_id, dialects, layout)
    moment = ntz(now or utc_now())
    checks = Q.standard_checks(moment)
    built = build_models(spark, layout, reprocess_from, checks)
    folds = fold_landing(spark, layout, day, checks) | {"fact": built["fact_folds"]}
    results = Q.run_checks(checks, built, folds, {
        "unique_fact_request_id": built["repeated"],
        "assert_agg_matches_fact_row_count": Q.reconcile(built["fact_folds"], built["daily"], F.sum("n"))}, moment)
    path = f"{layout.reports}/checks/{day}"
    checking = time.monotonic()
    results.write.mode("overwrite").parquet(path)
    checks_seconds = round(time.monotonic() - checking, 2)
    summary = Q.summarize(spark.read.parquet(path))
    funnel = Q.stage_funnel({
        "1_landed": built["raw"], "2_staged": built["staged"],
        "3_deduped": built["deduped"], "4_fact": built["fact"],
        "5_daily_mart": built["daily"], "5_agency_dim": built["dim"]})
    report = serving.run_report(
        str(day), batch_id, funnel, summary, M.mapping_rollup(M.mapping_stats(decisions), decisions, _row_counts(
            spark, layout, day)), M.confidence_histogram(decisions), decisions, spark.read.parquet(path),
        run_seconds=round(time.monotonic() - started, 2), checks_seconds=checks_seconds)
    target = f"{layout.reports}/quality_report/{day}"
    tables.write_summary(report, target)
    if enforce:
        Q.gate(summary)
    return tables.read_summary(spark, target, report.schema)


def backfill(spark: SparkSession, source: DataFrame, names: Mapping[str, str], first: dt.date,
             days: int, dialects: Dialects, layout: Layout, **options) -> list[DataFrame]:
    """Consecutive days in order, each a full batch; the mark moves with them."""
    return [run_batch(spark, source, names, day, dialects, layout, **options)
            for day in batch_dates(first, days)]


@dataclass
class LiveRun:
    rows_fetched: int = 0
    newest_created_at: str = ""
    oldest_created_at: str = ""
    decisions: DataFrame | None = None
    canonical: DataFrame | None = None
    checks: DataFrame | None = None        # on the untyped rows
    results: DataFrame | None = None       # of the 44 checks on the models
    marts: dict[str, DataFrame] = field(default_factory=dict)
    error: str | None = None
    note: str | None = None                # why the marts are those without models


def _live_models(landed: DataFrame, now: Column) -> tuple[dict[str, DataFrame], DataFrame]:
    """The typed models of a few landed rows, the reports on them, and the 44 checks."""
    staged = models.stage(landed)
    deduped = models.deduplicate(staged).checkpoint()
    fact, dim = models.build_fact(deduped), models.agency_dimension(deduped)
    daily = models.daily_sla(fact)
    results = Q.run_checks(Q.standard_checks(now), {
        "raw": landed, "staged": staged, "fact": fact, "dim": dim, "daily": daily}).checkpoint()
    return serving.live_reports(fact, dim), results


def live_run(source: DataFrame, names: Mapping[str, str], limit: int, dialects: Dialects,
             now: str | None = None) -> LiveRun:
    """The newest rows through mapping, row checks, models, their checks and reports,
    nothing stored. Should the models fail, the marts come from the untyped rows.

    Trouble is reported in `error`, not raised.
    """
    result = LiveRun()
    try:
        spark = source.sparkSession
        key = next(c for c, f in names.items() if f == "request_id")
        stamp = next(c for c, f in names.items() if f == "created_at")
        rows = slices.newest(source.select(*names), stamp, limit, key)
        bounds = slices.batch_bounds(rows, stamp).first()
        result.newest_created_at = str(bounds.newest_created_at or "")
        result.oldest_created_at = str(bounds.oldest_created_at or "")
        renamed = rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f)
                                for c, f in names.items()])
        # Newest first, undated rows last, as they were fetched. The dealt rows are read
        # by everything below, so they are kept.
        order = [F.nullif(F.col("created_at"), F.lit("")).desc_nulls_last(), F.col("request_id").asc()]
        ensure_checkpoint_dir(spark)
        dealt = slices.round_robin(renamed, order, list(dialects.headers)).checkpoint()
        result.rows_fetched = dealt.count()
        files.require_rows(dealt, "the live run")
        headers = spark.createDataFrame(
            [(s, i, c) for s in dialects.headers
             for i, c in enumerate([*dialects.headers[s].values(), *dialects.extras.get(s, ())])],
            "source_system string, ordinal int, source_column string")
        result.decisions = M.require_fields(
            M.resolve_headers(headers, dialects.overrides, dialects.proposals))
        day = result.newest_created_at[:10] or str(utc_now().date())
        maps, frames = M.column_maps(result.decisions), []
        for system, header_of in dialects.headers.items():
            own = dealt.where(F.col("source_system") == system).select(
                *[F.col(f).alias(h) for f, h in header_of.items()],
                *[F.lit(system).alias(c) for c in dialects.extras.get(system, ())])
            frames.append(apply_mapping(own, maps.get(system, {}), system, day, "live-demo"))
        result.canonical = union_systems(frames)
        result.checks = Q.row_checks(result.canonical, ntz(now or utc_now()))
        try:
            result.marts, result.results = _live_models(result.canonical, ntz(now or utc_now()))
        except Exception as err:
            result.note = f"{type(err).__name__}: {err}"
            result.marts = models.live_marts(result.canonical)
    except Exception as err:
        result.error = f"{type(err).__name__}: {err}"
    return result
