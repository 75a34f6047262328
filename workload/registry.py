"""The registered queries: each runs library operators over the whole test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqmill.functions import headers as H
from reqmill.functions import scalars as S
from reqmill.operators import checks as Q
from reqmill.operators import mapping as M
from reqmill.operators.landing import apply_mapping, merge_by_key, union_systems
from reqmill.plans import backfill, models, serving
from reqmill.plans.fact_table import FactTable
from reqmill.schema import FIELD_NAMES, SOURCE_SYSTEMS, canonical_fields
from reqmill.session import shared_dir
from reqmill.sources import batch_files, slices, tables
from workload import dialects as D
from workload import inputs as I

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Checks compare with a fixed moment, so that results do not change by the day.
NOW = "2000-06-30 12:00:00"
DAY = dt.date(2024, 1, 15)
CUT = dt.date(1999, 1, 1)
BACKFILL_FIRST, BACKFILL_DAYS = dt.date(1998, 6, 1), 14


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(I.prepare(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


# --- model chain ----------------------------------------------------------

def _fact(spark, d):
    return models.build_fact(I.requests(spark, d))


def _staged(spark, d):
    return models.stage(I.landed(spark, d))


def _chain(spark, d, raw=None):
    raw = I.landed(spark, d) if raw is None else raw
    staged = models.stage(raw)
    deduped = models.deduplicate(staged)
    fact = models.build_fact(deduped)
    return {"raw": raw, "staged": staged, "deduped": deduped, "fact": fact,
            "dim": models.agency_dimension(deduped), "daily": models.daily_sla(fact)}


def _stored_chain(spark, d):
    """The chain with its tables written, as a run leaves them."""
    root, t = shared_dir(spark), _chain(spark, d, I.stored_landing(spark, d))
    t["deduped"].write.parquet(f"{root}/deduped")
    deduped = spark.read.parquet(f"{root}/deduped")
    models.build_fact(deduped).write.parquet(f"{root}/fact")
    fact = spark.read.parquet(f"{root}/fact")
    models.agency_dimension(deduped).write.parquet(f"{root}/dim")
    models.daily_sla(fact).write.parquet(f"{root}/daily")
    return t | {"deduped": deduped, "fact": fact, "dim": spark.read.parquet(f"{root}/dim"),
                "daily": spark.read.parquet(f"{root}/daily")}


@query
def daily_sla(spark, d):
    return models.daily_sla(_fact(spark, d))


@query
def daily_sla_approx(spark, d):
    """Counts, and whether the estimated medians lie within a hundredth of the rows of the middle."""
    fact, key = _fact(spark, d), ["created_date", "borough", "agency_code"]
    at = "percentile_disc({}) within group (order by resolution_hours)"
    bounds = fact.withColumn("borough", F.coalesce("borough", F.lit("UNSPECIFIED"))).groupBy(*key).agg(
        F.expr(at.format(0.49)).alias("low"), F.expr(at.format(0.51)).alias("high"))
    close = F.col("median_resolution_hours").between(F.col("low"), F.col("high"))
    return models.daily_sla_approx(fact).join(bounds, key).select(
        *key, "requests_opened", F.coalesce(close, F.col("low").isNull()).alias("median_in_bounds"))


@query
def sketch_months(spark, d):
    """Months and boroughs from the sketches of the daily mart: counts, whether the median
    lies between the exact hundredths around the middle, and whether the number of
    complaint types is within a twentieth."""
    month = F.trunc("created_date", "month").alias("month")
    fact = _fact(spark, d).withColumn("borough", F.coalesce("borough", F.lit("UNSPECIFIED")))
    path = f"{shared_dir(spark)}/sketched"
    models.daily_sketches(fact).write.parquet(path)
    at = "percentile_disc({}) within group (order by resolution_hours)"
    exact = fact.groupBy(month, "borough").agg(F.expr(at.format(0.47)).alias("low"), F.expr(at.format(0.53)).alias("high"),
                                               F.count_distinct("complaint_type").alias("types"))
    median, types = F.col("median_resolution_hours"), F.col("complaint_types")
    return models.sketch_totals(spark.read.parquet(path), month, "borough").join(exact, ["month", "borough"]).select(
        "month", "borough", "requests_opened", "requests_closed", "timed",
        F.coalesce(median.between(F.col("low"), F.col("high")), median.isNull() & F.col("low").isNull()).alias("median_in_bounds"),
        (20 * F.abs(types - F.col("types")) <= F.col("types")).alias("types_in_bounds"))


@query
def fact_requests(spark, d):
    return _fact(spark, d)


@query
def stg_typed(spark, d):
    return _staged(spark, d)


@query
def dedup_latest(spark, d):
    return models.deduplicate(_staged(spark, d))


@query
def landed_daily_sla(spark, d):
    return _chain(spark, d)["daily"]


@query
def agency_dim(spark, d):
    return _chain(spark, d)["dim"]


@query
def code_dim(spark, d):
    parts = I.table(spark, d, "part").select(
        "p_partkey", F.col("p_brand").alias("agency_code"), F.col("p_type").alias("agency_name"))
    lines = I.table(spark, d, "lineitem").select(
        "l_partkey", F.col("l_shipdate").alias("created_at"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("closed_at"))
    return models.agency_dimension(
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey")))


@query
def incremental_fact(spark, d):
    """The fact after a first load of the batches before a date, then an update."""
    staged = models.stage(I.stored_landing(spark, d))
    fact = FactTable(spark, f"{shared_dir(spark)}/fact", grain="yyyy")  # few rows a year
    fact.update(staged.where(F.col("batch_date") < F.lit(CUT)))
    fact.update(staged)
    return fact.read()


def _backfill(spark, d):
    staged = models.stage(I.landed(spark, d))
    return staged, backfill.fact_versions(staged, BACKFILL_FIRST, BACKFILL_DAYS)


@query
def backfill_fact(spark, d):
    """Every row that the fact holds after the runs of fourteen days, and from and to when."""
    return _backfill(spark, d)[1].select("request_id", "batch_id", "batch_date", "created_date", "status", "is_closed", "was_relanded",
                                         "valid_from", "valid_to")


@query
def backfill_funnel(spark, d):
    """Rows of every stage after the run of each of the fourteen days."""
    staged, history = _backfill(spark, d)
    path = f"{shared_dir(spark)}/history"  # read once for each kind of group
    history.select("request_id", "created_date", "borough", "agency_code", "valid_from", "valid_to").write.parquet(path)
    return backfill.funnel_by_day(staged, spark.read.parquet(path), BACKFILL_FIRST, BACKFILL_DAYS)


@query
def changed_requests(spark, d):
    """Rows an update takes up, with the keys filtered before ranking."""
    staged = models.stage(I.stored_landing(spark, d))
    return models.build_fact(models.changed_requests(staged, CUT))


@query
def upsert_by_key(spark, d):
    staged = models.stage(I.stored_landing(spark, d))
    fact = models.build_fact(models.deduplicate(staged.where(F.col("batch_date") < F.lit(CUT))))
    path = f"{shared_dir(spark)}/incoming"  # read for its keys and for its rows
    models.build_fact(models.changed_requests(staged, CUT)).write.parquet(path)
    return merge_by_key(fact, spark.read.parquet(path), "request_id")


# --- landing --------------------------------------------------------------

@query
def batch_replace(spark, d):
    """Yearly batches landed, then one year replaced twice by its first half."""
    path = f"{shared_dir(spark)}/landing"
    def yearly(**dealt):
        return I.landed(spark, d, **dealt).withColumn(
            "_batch_date", F.concat(F.substring("_batch_date", 1, 4), F.lit("-01-01")))

    tables.replace_batches(yearly(by=F.year("l_shipdate")), path, dealt=True)
    again = yearly().where((F.col("_batch_date") == "1998-01-01")
                         & (F.col("_ingested_at") < "1998-07-01"))
    for _ in range(2):
        tables.replace_batch(again, path, "1998-01-01")
    return tables.read_landing(spark, path)


@query
def files_round_trip(spark, d):
    """Orders dealt to four systems, written as CSV under their headers, read back,
    resolved and landed."""
    root = shared_dir(spark)
    renamed = I.source_rows(spark, d).select(
        *[F.col(c).alias(f) for c, f in D.SOURCE_NAMES.items()])
    dealt = slices.round_robin(renamed, ["request_id"], list(D.HEADERS))
    batch_files.write_batch(dealt, root, DAY, D.HEADERS, D.EXTRAS)
    frames = {s: batch_files.read_batch(spark, f"{batch_files.day_dir(root, DAY)}/source_system={s}")
              for s in batch_files.batch_systems(spark, root, DAY)}
    headers = spark.createDataFrame(
        [(s, i, c) for s, f in frames.items() for i, c in enumerate(f.columns)],
        "source_system string, ordinal int, source_column string")
    tables.append_decisions(M.resolve_headers(headers, D.override_table(spark)),
                            f"{root}/log", str(DAY), "b1")
    decisions = tables.read_decisions(spark, f"{root}/log", str(DAY), "b1")
    maps = M.column_maps(decisions)
    return union_systems([
        apply_mapping(f, maps[s], s, str(DAY), "b1", "2024-01-16T00:00:00+00:00") for s, f in frames.items()])


@query
def rename_union_stamp(spark, d):
    customers = I.table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    suppliers = I.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    stamp = "2024-01-16T00:00:00+00:00"
    return union_systems([
        apply_mapping(customers, {"c_custkey": "request_id", "c_name": "agency_name",
                                  "c_mktsegment": "agency_code"}, "crm", str(DAY), "b1", stamp),
        apply_mapping(suppliers, {"s_suppkey": "request_id", "s_name": "agency_name",
                                  "s_nationkey": "city"}, "erp", str(DAY), "b1", stamp)])


@query
def day_slice(spark, d):
    return slices.day_slice(I.table(spark, d, "events"), "ts", DAY,
                            ["event_id", "ts", "user_id", "event_type"])


@query
def day_rows(spark, d):
    return slices.day_slice(I.table(spark, d, "events"), "ts", DAY, ["event_id", "ts"])


@query
def newest_n(spark, d):
    return slices.newest(I.table(spark, d, "events").select("event_id", "ts", "event_type"),
                         "ts", 500, "event_id")


@query
def batch_bounds(spark, d):
    return slices.batch_bounds(I.source_rows(spark, d), "closed_date")


@query
def round_robin_split(spark, d):
    events = I.table(spark, d, "events").select("event_id", "event_type")
    return slices.round_robin(events, ["event_type", "event_id"], SOURCE_SYSTEMS)


@query
def batch_manifest(spark, d):
    dealt = slices.round_robin(I.table(spark, d, "events").select("event_id"),
                               ["event_id"], SOURCE_SYSTEMS)
    manifest = batch_files.batch_manifest(dealt, DAY, {s: 2 + i for i, s in enumerate(SOURCE_SYSTEMS)})
    return manifest.select("batch_date", "total_rows", F.inline("files"))


@query
def sample_values(spark, d):
    events = I.table(spark, d, "events").select(
        "event_id", "event_type", F.when(F.col("value") > 10, "").otherwise(F.col("props")).alias("props"))
    return batch_files.sample_values(events, ["event_id"]).select(
        "source_column", F.array_join("samples", "|").alias("samples"))


# --- stored tables --------------------------------------------------------

@query
def table_row_counts(spark, d):
    """Rows of stored relations, -1 for one that does not exist."""
    found = [(n, tables.row_count(spark, f"{d}/{n}.parquet"))
             for n in ("orders", "lineitem", "customer", "no_such_table")]
    return spark.createDataFrame(found, "relation string, rows bigint")


@query
def export_counts(spark, d):
    fact = _fact(spark, d)
    return tables.export_tables({"fact": fact, "complaints": serving.counts_by(fact, "complaint_type")},
                                shared_dir(spark))


@query
def snapshot_table(spark, d):
    """A report read from its snapshot; an unknown one is empty."""
    root = shared_dir(spark)
    fact = _fact(spark, d)
    mix = serving.counts_by(fact, "status")
    tables.export_tables({"status_mix": mix}, root)
    schema = "status string, requests bigint"
    return tables.load_named(spark, "status_mix", {}, root, schema).unionByName(
        tables.load_named(spark, "unknown", {}, root, schema))


@query
def live_table(spark, d):
    """A report whose relation exists is read from it, not from its snapshot."""
    root, schema = shared_dir(spark), "borough string, requests bigint"
    tables.export_tables({"borough_mix": spark.createDataFrame([], schema)}, root)
    _fact(spark, d).createOrReplaceTempView("live_requests")
    live = {"borough_mix": "select borough, count(*) as requests from live_requests group by borough"}
    return tables.load_named(spark, "borough_mix", live, root, schema, "live_requests")


@query
def schema_tables(spark, d):
    """Tables saved in schemas that were made if they were missing, and one that is not there."""
    tables.ensure_schemas(spark)
    fact, tag = _fact(spark, d), uuid.uuid4().hex
    stored = {"staging": fact, "analytics": fact.groupBy("status").count()}
    for schema, df in stored.items():
        df.write.saveAsTable(f"{schema}.t_{tag}")
    found = [(schema, tables.row_count(spark, f"{schema}.t_{tag}")) for schema in (*stored, "raw")]
    for schema in stored:
        spark.sql(f"DROP TABLE {schema}.t_{tag}")
    return spark.createDataFrame(found, "schema string, rows bigint")


@query
def empty_days(spark, d):
    """Days of the year whose batch is refused because no request was opened on them."""
    path, first = f"{shared_dir(spark)}/orders", dt.date(1998, 7, 20)
    I.table(spark, d, "orders").select("o_orderkey", "o_orderdate").write.parquet(path)
    orders, out = spark.read.parquet(path), []
    for day in (first + dt.timedelta(days=30 * k) for k in range(6)):
        try:
            batch_files.require_rows(slices.day_slice(orders, "o_orderdate", day, ["o_orderkey"]), str(day))
            out.append((day, False))
        except batch_files.EmptyBatch:
            out.append((day, True))
    return spark.createDataFrame(out, "day date, refused boolean")


@query
def decision_log(spark, d):
    """Decisions appended by two runs; the last run is counted."""
    path = f"{shared_dir(spark)}/log"
    decisions = _decisions(spark, d)
    for run in ("b1", "b2"):
        tables.append_decisions(decisions, path, str(DAY), run)
    log = tables.read_decisions(spark, path, str(DAY))
    last = tables.read_decisions(spark, path, str(DAY), "b2")
    return last.groupBy("method").agg(F.count("*").alias("columns")).join(
        log.groupBy("method").agg(F.count("*").alias("logged")), "method")


@query
def log_shapes(spark, d):
    """A log of today's lines, of the lines that an older version would have written, and
    of lines that broke off: how many of each, by method."""
    path, decisions = f"{shared_dir(spark)}/log", _decisions(spark, d)
    tables.append_decisions(decisions, f"{path}/new", str(DAY), "b2")
    older = decisions.select(
        F.struct(F.lit(str(DAY)).alias("date"), F.lit("b1").alias("id")).alias("run"), F.col("source_system").alias("system"),
        F.col("source_column").alias("header"),
        F.struct(F.col("canonical_field").alias("field"), F.col("method").alias("tier"), F.col("confidence").cast("string").alias("score")).alias("decision"))
    lines = older.select(F.to_json(F.struct("*")).alias("value"), "header")
    lines.select(F.when(F.col("header") == "city", F.expr("left(value, 40)")).otherwise(F.col("value"))).write.text(f"{path}/old")
    log = tables.read_log_lines(spark, path)
    return log.groupBy("readable", F.coalesce("shape", F.lit(-1)).alias("shape"), F.coalesce("method", F.lit("-")).alias("method")).agg(
        F.count("*").alias("lines"), F.count("canonical_field").alias("mapped"), F.sum(F.round(F.col("confidence") * 10000).cast("bigint")).alias("units"))


@query
def summary_round_trip(spark, d):
    path = f"{shared_dir(spark)}/summary"
    tables.write_summary(M.mapping_stats(_decisions(spark, d)), path)
    return tables.read_summary(
        spark, path, "source_system string, columns_total bigint, auto_match_rate double")


@query
def latest_batch_rows(spark, d):
    return tables.latest_batch(_fact(spark, d).select("request_id", "agency_code", "batch_date"))


# --- scalars --------------------------------------------------------------

@query
def normalise(spark, d):
    urls = I.table(spark, d, "pages").select(F.col("url").alias("header"))
    names = I.table(spark, d, "customer").select("c_name")
    parts = I.table(spark, d, "part").select(F.concat(
        F.initcap("p_name"), F.lit(" "), F.col("p_brand"), F.lower("p_type"), F.initcap("p_type")))
    texts = I.table(spark, d, "conversations").select("text")
    return urls.union(names).union(parts).union(texts).select(
        "header", H.normalize(F.col("header")).alias("normalized"))


@query
def scalar_functions(spark, d):
    o = I.table(spark, d, "orders")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return o.select(
        "o_orderkey", F.substring(stamp, 1, 10).alias("day"), F.substring(stamp, 1, 16).alias("minute"),
        F.startswith("o_orderpriority", F.lit("4")).alias("is_fourth"),
        S.dotted_part(F.concat_ws(".", F.lit("test"), "o_orderstatus", "o_orderpriority")).alias("third"),
        S.dotted_part(F.col("o_orderpriority")).alias("whole"),
        F.date_add(F.to_date("o_orderdate"), 1).alias("day_after"),
        S.round_half(F.col("o_totalprice") / 7, 3).alias("sevenths"),
        S.ratio(F.col("o_custkey"), F.col("o_orderkey")).alias("key_ratio"))


@query
def batch_windows(spark, d):
    """Each event day with the three batch dates that look back on it."""
    days = I.table(spark, d, "events").select(F.to_date("ts").alias("day")).distinct()
    return days.select("day", F.explode(F.sequence(
        "day", F.date_add("day", 2), F.expr("interval 1 day"))).alias("batch_date"))


# --- header resolution ----------------------------------------------------

def _decisions(spark, d):
    return M.resolve_headers(I.feed_headers(spark, d), I.feed_overrides(spark, d))


def _proposed(spark, d):
    return M.resolve_headers(I.feed_headers(spark, d), I.feed_overrides(spark, d),
                             I.feed_proposals(spark, d))


@query
def map_exact(spark, d):
    return M.exact_match(I.feed_headers(spark, d)).select(
        "source_system", "source_column", "norm", "exact_field")


@query
def map_decisions(spark, d):
    return _decisions(spark, d).drop("reasoning", "proposal_outcome")


@query
def map_proposals(spark, d):
    return _proposed(spark, d).drop("reasoning")


@query
def map_proposal_counts(spark, d):
    return M.proposal_counts(_proposed(spark, d))


@query
def map_stats(spark, d):
    return M.mapping_stats(_decisions(spark, d))


@query
def map_errors(spark, d):
    """Systems that stop when no override is recorded."""
    return M.mapping_errors(M.mapping_stats(M.resolve_headers(I.feed_headers(spark, d))))


@query
def map_rollup(spark, d):
    return M.mapping_rollup(M.mapping_stats(_decisions(spark, d)))


@query
def map_accuracy(spark, d):
    truth = I.feeds(spark, d).select("source_system", "source_column", "expected")
    return M.accuracy(_decisions(spark, d), truth)


@query
def map_histogram(spark, d):
    return M.confidence_histogram(_decisions(spark, d))


@query
def map_methods(spark, d):
    return M.counts_by_method(_decisions(spark, d))


@query
def map_live_stats(spark, d):
    return M.live_stats(_decisions(spark, d))


@query
def map_missing_required(spark, d):
    """Required fields left open when no override is recorded."""
    return M.missing_required(M.resolve_headers(I.feed_headers(spark, d)))


@query
def map_flatten(spark, d):
    """Decisions gathered in blocks of eight columns and flattened again."""
    block = F.floor(F.col("ordinal") / 8)
    nested = _decisions(spark, d).groupBy("source_system", block).agg(F.collect_list(F.struct(
        "source_column", "canonical_field", "method", "confidence")).alias("decisions"))
    return M.flatten(nested)


@query
def fuzzy_candidates(spark, d):
    pages = I.table(spark, d, "pages").select("page_id", F.col("url").alias("source_column"))
    return M.fuzzy_candidates(pages, top_n=3)


@query
def fuzzy_feed_candidates(spark, d):
    return M.fuzzy_candidates(I.feed_headers(spark, d), top_n=4)


@query
def header_pivot(spark, d):
    """The smallest header of each field in the four systems that suppliers are, and in parts'."""
    feeds = I.feeds(spark, d).select(
        F.col("dialect").alias("source_system"), F.col("source_column").alias("header"),
        F.col("expected").alias("canonical_field"))
    parts = I.part_headers(spark, d).select(F.lit("parts").alias("source_system"),
                                            F.col("source_column").alias("header"), "canonical_field")
    return serving.header_comparison(feeds.unionByName(parts), [*SOURCE_SYSTEMS, "parts"])


@query
def known_headers(spark, d):
    feeds = I.feeds(spark, d).select(F.col("source_column").alias("header"), F.col("expected").alias("canonical_field"))
    return serving.known_headers(feeds.unionByName(I.part_headers(spark, d).select(
        F.col("source_column").alias("header"), "canonical_field")))


@query
def map_varied_claims(spark, d):
    """The tier and field of headers that follow from the parts, before fields are contested."""
    return M.propose(I.part_headers(spark, d)).select(
        "source_system", "source_column", "canonical_field", "method", "confidence").distinct()


@query
def invalid_overrides(spark, d):
    """Overrides with an unknown field, made of those to a null field of even suppliers."""
    target = F.when(F.col("canonical_field").isNull() & (F.length("source_system") % 2 == 0), "nowhere")
    return M.invalid_overrides(I.feed_overrides(spark, d).withColumn(
        "canonical_field", F.coalesce("canonical_field", target)))


@query
def rollup_with_rows(spark, d):
    """Totals of the header decisions and of the rows of each feed, here its parts."""
    decisions = M.resolve_headers(I.feed_headers(spark, d), I.feed_overrides(spark, d), I.feed_proposals(spark, d))
    lines = I.table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("rows_read"), F.count_if(F.col("l_linestatus") == "F").alias("rows_loaded"))
    rows = I.table(spark, d, "supplier").join(lines, F.col("s_suppkey") == F.col("l_suppkey")).select(
        F.col("s_name").alias("source_system"), "rows_read", "rows_loaded")
    return M.mapping_rollup(M.mapping_stats(decisions), decisions, rows).select(
        "source_systems", "overrides_applied", "proposals_invalid", "proposals_low", "rows_read", "rows_loaded",
        F.size("sources").alias("entries"))


@query
def schema_fields(spark, d):
    """The canonical schema, with how many landed rows fill each field."""
    filled = I.landed(spark, d).agg(*[F.count(F.nullif(F.trim(c), F.lit(""))).alias(c) for c in FIELD_NAMES])
    counts = filled.unpivot([], FIELD_NAMES, "field", "filled")
    return serving.schema_listing(canonical_fields(spark)).join(counts, "field").select("field", "type", "required", "ordinal", "filled")


@query
def override_listing(spark, d):
    return serving.override_listing(I.feed_overrides(spark, d))


# --- checks ---------------------------------------------------------------

def _results(spark, d, tables=None):
    return Q.run_checks(Q.standard_checks(S.ntz(NOW)), tables or _stored_chain(spark, d))


@query
def check_suite(spark, d):
    return _results(spark, d)


@query
def check_summary(spark, d):
    return Q.summarize(_results(spark, d))


@query
def gate_outcome(spark, d):
    """Whether the checks stop the run, and what the gate says."""
    path = f"{shared_dir(spark)}/summary"
    Q.summarize(_results(spark, d)).write.parquet(path)
    try:
        Q.gate(spark.read.parquet(path))
        outcome = ("all", False, "")
    except Q.QualityGateError as error:
        outcome = ("all", True, str(error))
    return spark.createDataFrame([outcome], "model string, stopped boolean, message string")


@query
def failing_checks(spark, d):
    return serving.failing_checks(_results(spark, d))


@query
def test_outcomes(spark, d):
    path = f"{shared_dir(spark)}/results"  # read for the types and for the states
    _results(spark, d).write.parquet(path)
    results = spark.read.parquet(path).withColumn("unique_id", F.col("test"))
    metadata = results.where(F.col("type") != "singular").select("unique_id", "type")
    return serving.test_outcomes(results, metadata)


@query
def stage_funnel(spark, d):
    t = _stored_chain(spark, d)
    return Q.stage_funnel({
        "1_landed": t["raw"], "2_staged": t["staged"], "3_deduped": t["deduped"],
        "4_fact": t["fact"], "5_daily_mart": t["daily"], "5_agency_dim": t["dim"],
        "6_absent": None})


@query
def check_not_null(spark, d):
    return _staged(spark, d).where(Q.not_null("complaint_type")).select(
        "request_id", "batch_id", "complaint_type")


@query
def check_unique(spark, d):
    return Q.unique(I.table(spark, d, "lineitem"), "l_orderkey")


@query
def check_accepted(spark, d):
    return Q.accepted_values(_staged(spark, d), "borough", Q.BOROUGHS)


@query
def check_relationships(spark, d):
    """Order keys of lines against the orders that are not open."""
    parents = I.table(spark, d, "orders").where(F.col("o_orderstatus") != "O")
    return Q.relationships(I.table(spark, d, "lineitem"), "l_orderkey", parents, "o_orderkey")


@query
def check_future(spark, d):
    return I.table(spark, d, "orders").where(Q.not_in_future("o_orderdate", S.ntz(NOW))).select(
        "o_orderkey", F.col("o_orderdate").alias("offending_value"))


@query
def check_range(spark, d):
    return I.table(spark, d, "customer").where(Q.within_range("c_acctbal", 0, 9000)).select(
        "c_custkey", F.col("c_acctbal").alias("offending_value"))


@query
def check_reconcile(spark, d):
    """The fact against a mart that lost the rows of one day."""
    fact = _fact(spark, d)
    mart = fact.where(F.col("created_date") != F.lit(dt.date(1998, 10, 3))).groupBy("created_date").agg(
        F.count("*").alias("requests_opened"))
    return Q.reconcile(fact, mart)


@query
def check_quarantine(spark, d):
    """Anomalies once the flag of one status is lost."""
    fact = _fact(spark, d).withColumn(
        "has_invalid_timestamps", F.col("has_invalid_timestamps") & (F.col("status") != "P"))
    return fact.where(Q.unflagged_anomaly()).select(
        "request_id", "created_at", "closed_at", "resolution_hours", "has_invalid_timestamps")


@query
def check_anomaly(spark, d):
    return Q.anomaly_rate(_fact(spark, d))


@query
def row_checks(spark, d):
    return Q.row_checks(I.landed(spark, d), S.ntz(NOW))


# --- reports --------------------------------------------------------------

@query
def daily_volume(spark, d):
    return serving.daily_volume(models.daily_sla(_fact(spark, d)))


@query
def daily_volume_first_boroughs(spark, d):
    path = f"{shared_dir(spark)}/volume"  # read twice, so stored
    serving.daily_volume(_chain(spark, d)["daily"]).write.parquet(path)
    return serving.volume_of_first_boroughs(spark.read.parquet(path), 2)


@query
def agencies_by_volume(spark, d):
    return serving.agencies_by_volume(_chain(spark, d)["dim"])


@query
def top_complaints(spark, d):
    return serving.top_complaints(_fact(spark, d))


@query
def newest_facts(spark, d):
    return serving.newest_facts(_fact(spark, d), 8000)


@query
def anomalies(spark, d):
    return serving.timestamp_anomalies(_fact(spark, d))


@query
def type_mix(spark, d):
    return serving.counts_by(_fact(spark, d), "complaint_type")


@query
def borough_mix(spark, d):
    t = _chain(spark, d)
    return serving.live_reports(t["fact"], t["dim"])["borough_mix"]


@query
def batch_date_list(spark, d):
    return serving.distinct_sorted(I.landed(spark, d), "_batch_date")


@query
def headline(spark, d):
    return serving.headline(_fact(spark, d), _decisions(spark, d), Q.summarize(_results(spark, d)))


@query
def run_report(spark, d):
    decisions, t = _decisions(spark, d), _stored_chain(spark, d)
    path = f"{shared_dir(spark)}/results"
    _results(spark, d, t).write.parquet(path)
    results = spark.read.parquet(path)
    report = serving.run_report(
        str(DAY), "b1", Q.stage_funnel({"1_landed": t["raw"], "4_fact": t["fact"]}),
        Q.summarize(results), M.mapping_rollup(M.mapping_stats(decisions)),
        M.confidence_histogram(decisions), decisions, results)
    return report.select(
        "batch_date", "batch_id", F.col("row_counts")[0]["rows"].alias("landed"),
        F.col("row_counts")[1]["rows"].alias("fact"), "tests.tests_total", "tests.tests_passed",
        "mapping.columns_total", "mapping.auto_match_rate",
        F.col("confidence")[3]["columns"].alias("unmapped"), "decisions",
        F.col("methods")[0]["columns"].alias("exact"), F.size("not_passing").alias("checks_not_passing"))


@query
def live_agencies(spark, d):
    return models.live_marts(I.landed(spark, d))["dim_agency"]


@query
def live_complaints(spark, d):
    return models.live_marts(I.landed(spark, d))["top_complaints"]


@query
def live_boroughs(spark, d):
    return models.live_marts(I.landed(spark, d))["borough_mix"]


@query
def live_fact(spark, d):
    return models.live_marts(I.landed(spark, d))["fact"].select(
        "request_id", "_batch_id", "created_at", "closed_at", "borough",
        "has_invalid_timestamps", S.round_half(F.col("resolution_hours"), 6).alias("resolution_hours"))
