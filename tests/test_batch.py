import datetime as dt

import pytest
from pyspark.sql import functions as F

from reqmill.functions.scalars import ntz
from reqmill.operators import checks as Q
from reqmill.plans import batch, models
from reqmill.sources import tables
from workload import dialects as D

NOW = "2026-09-10 00:00:00"


@pytest.fixture(scope="module")
def source(spark):
    """Forty requests over three days, in the shape the source serves."""
    rows = [(str(100000 + i), f"2026-09-0{i % 3 + 1}T09:0{i % 10}:00.000", f"2026-09-0{i % 3 + 2}T11:00:00.000",
             "NYPD" if i % 2 else "HPD", "New York City Police Department" if i % 2 else "Housing",
             "Noise - Residential" if i % 2 else "HEAT/HOT WATER", "Loud Music/Party", "Residential Building",
             "11211", "1 MAIN STREET", "BROOKLYN", "BROOKLYN", "Closed" if i % 2 else "Open",
             "The Department responded.", "2026-09-03T11:00:00.000", "01 BROOKLYN", "ONLINE",
             "40.71884", "-73.95448") for i in range(40)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in D.SOURCE_NAMES))


@pytest.fixture(scope="module")
def dialects(spark):
    return batch.Dialects(D.HEADERS, D.EXTRAS, D.override_table(spark))


def test_backfill_and_rerun(spark, source, dialects, tmp_path):
    layout = batch.Layout(str(tmp_path))
    reports = [r.first() for r in batch.backfill(
        spark, source, D.SOURCE_NAMES, dt.date(2026, 9, 1), 2, dialects, layout, now=NOW)]
    again = batch.run_batch(spark, source, D.SOURCE_NAMES, dt.date(2026, 9, 2), dialects, layout,
                            batch_id="again", now=NOW).first()
    landed = [{r.stage: r.rows for r in report.row_counts} for report in [*reports, again]]
    assert [n["1_landed"] for n in landed] == [14, 27, 27]
    assert all(n["1_landed"] == n["2_staged"] == n["3_deduped"] == n["4_fact"] for n in landed)
    last = again
    assert (last.tests.tests_total, last.tests.tests_failed, last.mapping.columns_total) == (44, 0, 83)
    assert last.mapping.auto_match_rate == 0.75
    assert last.run_seconds > last.checks_seconds > 0
    assert [c["columns"] for c in last.confidence] == [46, 15, 2, 20]
    assert (last.decisions, sum(m["columns"] for m in last.methods), last.written_at[:2]) == (83, 83, "20")
    assert last.mapping.rows_read == last.mapping.rows_loaded == 13 and len(last.mapping.sources) == 4
    assert [c.status for c in last.not_passing] == ["warn"] * last.tests.tests_warned
    manifest = spark.read.json(f"{layout.raw_files}/dt=2026-09-02/_manifest").first()
    assert manifest.total_rows == 13 and len(manifest.files) == 4
    assert {r.batch_id for r in models_read(spark, layout).select("batch_id").distinct().collect()} >= {"again"}
    # The log keeps both runs of the day.
    assert tables.read_decisions(spark, layout.decision_log, "2026-09-02").count() == 166


def test_checks_fold_only_the_days_own_rows(spark, source, dialects, tmp_path, monkeypatch):
    """The second day folds its own batch and the partitions of the fact that it wrote, and
    its results are those of a run over everything."""
    layout, days, folded = batch.Layout(str(tmp_path)), [dt.date(2026, 9, d) for d in (1, 2)], []
    fold = Q.fold

    def seen(checks, model, table, *by):
        if model in ("raw", "staged"):
            plan = table._jdf.queryExecution().executedPlan().toString()
            folded.append((model, any("PartitionFilters: [" in x and "2026-09-02" in x and "2026-09-01" not in x for x in plan.splitlines())))
        return fold(checks, model, table, *by)
    bad = source.withColumn("borough", F.when(F.col("unique_key") % 5 == 0, "ATLANTIS").otherwise(F.col("borough"))).withColumn(
        "latitude", F.when(F.col("unique_key") % 4 == 0, "50.5").otherwise(F.col("latitude")))
    batch.run_batch(spark, bad, D.SOURCE_NAMES, days[0], dialects, layout, now=NOW, enforce=False)
    monkeypatch.setattr(Q, "fold", seen)
    batch.run_batch(spark, bad, D.SOURCE_NAMES, days[1], dialects, layout, now=NOW, enforce=False)
    assert folded == [("raw", True), ("staged", True)]
    monkeypatch.undo()
    raw = tables.read_landing(spark, layout.landing)
    staged = models.stage(raw)
    deduped = models.deduplicate(staged)
    fact = models.build_fact(deduped)
    whole = Q.run_checks(Q.standard_checks(ntz(NOW)), {"raw": raw, "staged": staged, "fact": fact, "dim": models.agency_dimension(deduped),
                                                       "daily": models.daily_sla(fact)})
    kept = spark.read.parquet(f"{layout.reports}/checks/{days[1]}")
    assert sorted(map(tuple, kept.select(sorted(kept.columns)).collect())) == sorted(map(tuple, whole.select(sorted(kept.columns)).collect()))
    assert {r.test: r.failures for r in kept.collect()}["accepted_values_staged_borough"] == 1
    assert kept.where("test = 'within_range_staged_latitude' and failures > 2").count() == 1


def test_a_days_update_reads_its_own_batches_for_keys(spark, source, dialects, tmp_path):
    """The mark reaches the landing's scan as a partition filter."""
    layout = batch.Layout(str(tmp_path))
    for day in (dt.date(2026, 9, 1), dt.date(2026, 9, 2)):
        batch.run_batch(spark, source, D.SOURCE_NAMES, day, dialects, layout, now=NOW)
    staged = models.stage(tables.read_landing(spark, layout.landing))
    plan = models.changed_requests(staged, dt.date(2026, 9, 2))._jdf.queryExecution().toString()
    assert any("PartitionFilters: [" in line and ">=" in line for line in plan.splitlines())


def models_read(spark, layout):
    from reqmill.plans.fact_table import FactTable
    return FactTable(spark, layout.fact).read()


def test_a_late_batch_arrives_when_asked_for(spark, source, dialects, tmp_path):
    layout = batch.Layout(str(tmp_path))
    days = [dt.date(2026, 9, d) for d in (1, 2)]
    for day, since, rows in ((days[1], None, 13), (days[0], None, 13), (days[0], days[0], 27)):
        batch.run_batch(spark, source, D.SOURCE_NAMES, day, dialects, layout, now=NOW, reprocess_from=since)
        assert models_read(spark, layout).count() == rows


def test_the_live_run_deals_newest_first(spark, source, dialects):
    result = batch.live_run(source, D.SOURCE_NAMES, 40, dialects, now=NOW)
    rows = result.canonical.select("created_at", "request_id", "_source_system").collect()
    order = sorted(sorted(rows, key=lambda r: r.request_id or ""), key=lambda r: r.created_at, reverse=True)
    assert [r._source_system for r in order[:8]] == list(D.HEADERS) * 2


def test_gate_stops_a_bad_batch(spark, source, dialects, tmp_path):
    with pytest.raises(Q.QualityGateError, match="not_in_future"):
        batch.run_batch(spark, source, D.SOURCE_NAMES, dt.date(2026, 9, 1), dialects,
                        batch.Layout(str(tmp_path)), now="2020-01-01")


def test_day_without_rows_is_refused(spark, source, dialects, tmp_path):
    with pytest.raises(ValueError, match="empty batch"):
        batch.extract_day(source, D.SOURCE_NAMES, dt.date(2030, 1, 1), dialects, batch.Layout(str(tmp_path)))


def test_live_run(spark, source, dialects):
    result = batch.live_run(source, D.SOURCE_NAMES, 40, dialects, now=NOW)
    assert result.error is None
    assert result.rows_fetched == result.canonical.count() == 40
    assert result.decisions.count() == 83
    assert all(r.passed for r in result.checks.collect())
    assert result.note is None and result.results.count() == 44
    assert not result.results.where("status = 'fail'").count()
    assert result.newest_created_at[:10] == "2026-09-03"
    assert {r.agency_code for r in result.marts["dim_agency"].collect()} == {"NYPD", "HPD"}


def test_a_live_run_without_models_still_has_marts(spark, source, dialects, monkeypatch):
    def fail(landed):
        raise ArithmeticError("no models")
    monkeypatch.setattr(batch.models, "stage", fail)
    result = batch.live_run(source, D.SOURCE_NAMES, 40, dialects, now=NOW)
    assert result.error is None and "no models" in result.note and result.results is None
    assert {r.agency_code for r in result.marts["dim_agency"].collect()} == {"NYPD", "HPD"}


def test_trouble_in_a_live_run_is_reported(spark, source, dialects):
    result = batch.live_run(source.drop("agency"), D.SOURCE_NAMES, 40, dialects)
    assert result.error and "agency" in result.error
