import datetime as dt
import random
import statistics

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from reqmill.functions import scalars as S
from reqmill.plans import models
from reqmill.schema import FIELD_NAMES, LINEAGE
from reqmill.session import apply_defaults

TEXTS = ["2024-01-15T10:00:00.000", "2024-01-15", "2024", "2024-01", "10:00:00", "T10:00:00",
         "2024-01-15T10:00:00+00:00", "2024-13-01", "2024-1-5 1:2:3", "2024-01-15 10:00",
         "2024-01-15 10", "x", "", "  ", " 2024-01-15 ", "2024-01-15 10:00:00.123456"]
NUMBERS = ["1.0", "1.0d", "1f", " 1 ", "1e3", "inf", "-Infinity", "0x1F", ".5", "5.", "+1", "1D", "", "abc"]


@pytest.mark.parametrize("texts,fn,sql", [(TEXTS, S.to_timestamp, "timestamp"), (NUMBERS, S.to_double, "double")])
def test_safe_casts_equal_duckdb(spark, texts, fn, sql):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(fn(F.col("t"))).collect()]
    want = [duckdb.execute(f"select try_cast(nullif(trim(?), '') as {sql})", [t]).fetchone()[0] for t in texts]
    assert got == want


def test_results_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2024-03-10T01:30:00", "2024-03-10T03:30:00.900")], "s string, e string")
    hours = df.select(S.hours_between(S.to_timestamp(F.col("s")), S.to_timestamp(F.col("e"))).alias("h"),
                      S.to_timestamp(F.col("s")).cast("string").alias("s"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert tuple(hours.first()) == (2.0, "2024-03-10 01:30:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_rounding_is_half_away_in_double(spark):
    df = spark.sql("select 1809 / 3600.0D as x, 0.0025D as y, -1.5D as z")
    assert tuple(df.select(S.round_half(F.col("x"), 3), S.round_half(F.col("y"), 3),
                           S.round_half(F.col("z"), 0)).first()) == (0.502, 0.003, -2.0)


def landed(spark, rows):
    """Rows of (request_id, created, closed, batch_date, ingested, source, batch)."""
    out = []
    for rid, created, closed, batch, ingested, source, run in rows:
        values = dict.fromkeys(FIELD_NAMES, "") | {
            "request_id": rid, "created_at": created, "closed_at": closed, "agency_code": "A",
            "complaint_type": "c"}
        out.append((*values.values(), source, batch, run, ingested))
    return spark.createDataFrame(out, ", ".join(f"{c} string" for c in FIELD_NAMES + LINEAGE))


def test_newest_row_wins(spark):
    staged = models.stage(landed(spark, [
        ("1", "2024-01-01", "", "2024-01-01", "2024-01-01T05:00:00", "a", "r1"),
        ("1", "2024-01-01", "2024-01-03", "2024-01-02", "2024-01-02T05:00:00", "a", "r2"),
        ("2", "2024-01-01", "", "2024-01-01", "", "b", "r1"),
        ("2", "2024-01-02", "", "2024-01-01", "2024-01-01T05:00:00.000001", "z", "r1"),
        ("3", "2024-01-01", "", "2024-01-01", "2024-01-01", "b", "r1"),
        ("3", "2024-01-02", "", "2024-01-01", "2024-01-01", "a", "r1"),
        ("", "2024-01-02", "", "2024-01-01", "2024-01-01", "a", "r1")]))
    got = {r.request_id: r for r in models.deduplicate(staged).collect()}
    assert set(got) == {"1", "2", "3", ""}
    assert (got["1"].batch_id, got["1"].was_relanded) == ("r2", True)
    assert (got["2"].source_system, got["3"].source_system) == ("z", "a")
    assert not got[""].was_relanded


def test_dedup_equals_the_ranking_window(spark):
    rng = random.Random(5)
    days = [f"2024-01-{d:02d}" for d in range(1, 9)]
    rows = [("hot" if rng.random() < 0.4 else str(rng.randint(0, 60)), rng.choice(days), "",
             rng.choice(days), rng.choice([*days, ""]), rng.choice("abc"), f"r{i}") for i in range(2000)]
    staged = models.stage(landed(spark, rows))
    w = Window.partitionBy("request_id").orderBy(
        F.desc_nulls_last("ingested_at"), F.desc_nulls_last("batch_date"), "source_system", "batch_id")
    want = staged.withColumn("n", F.row_number().over(w)).where("n = 1")
    got = models.deduplicate(staged)
    assert ({(r.request_id, r.batch_id) for r in got.collect()}
            == {(r.request_id, r.batch_id) for r in want.collect()})


def test_copies_are_folded_before_the_shuffle(spark):
    plan = models.deduplicate(models.stage(landed(spark, []))) \
        ._jdf.queryExecution().sparkPlan().toString()
    assert "Window" not in plan and plan.count("Aggregate") == 2


def test_fact_flags_and_quarantines(spark):
    fact = models.build_fact(models.deduplicate(models.stage(landed(spark, [
        ("open", "2024-01-01T10:00:00", "", "2024-01-01", "", "a", "r"),
        ("done", "2024-01-01T10:00:00", "2024-01-01T11:30:00", "2024-01-01", "", "a", "r"),
        ("odd", "2024-01-02", "2024-01-01", "2024-01-01", "", "a", "r"),
        ("undated", "", "2024-01-01", "2024-01-01", "", "a", "r")]))))
    got = {r.request_id: (r.is_closed, r.has_invalid_timestamps, r.resolution_hours) for r in fact.collect()}
    assert got == {"open": (False, False, None), "done": (True, False, 1.5),
                   "odd": (True, True, None), "undated": (True, False, None)}


def test_daily_medians_equal_plain_python(spark):
    rng = random.Random(11)
    rows = []
    for i in range(3000):
        hot = rng.random() < 0.34
        hours = None if rng.random() < 0.2 else rng.randint(0, 90) / rng.choice([1, 8, 1000])
        rows.append((dt.date(2024, 1, 1) if hot else dt.date(2024, 1, rng.randint(2, 20)),
                     None if rng.random() < 0.1 else rng.choice("XY"), rng.choice(["a", "b"]),
                     rng.choice(["t", "u", None]), hours, hours is not None))
    fact = spark.createDataFrame(
        rows, "created_date date, borough string, agency_code string, complaint_type string, "
              "resolution_hours double, is_closed boolean")
    groups = {}
    for day, borough, agency, kind, hours, closed in rows:
        groups.setdefault((day, borough or "UNSPECIFIED", agency), []).append((kind, hours, closed))
    got = {(r.created_date, r.borough, r.agency_code): r for r in models.daily_sla(fact).collect()}
    assert set(got) == set(groups)
    for key, members in groups.items():
        hours, r = [h for _, h, _ in members if h is not None], got[key]
        assert (r.requests_opened, r.requests_closed) == (len(members), sum(c for *_, c in members))
        assert r.distinct_complaint_types == len({k for k, *_ in members if k})
        assert r.max_resolution_hours == (max(hours) if hours else None)
        if hours:
            assert r.median_resolution_hours == pytest.approx(statistics.median(hours), abs=0.00051)
            assert r.avg_resolution_hours == pytest.approx(statistics.mean(hours), abs=0.00051)
        else:
            assert r.median_resolution_hours is None and r.avg_resolution_hours is None


def test_most_frequent_name(spark):
    rows = [("A", "x"), ("A", "y"), ("A", "y"), ("B", "q"), ("B", "p"), ("C", None), ("C", None)]
    df = spark.createDataFrame(rows, "agency_code string, agency_name string").withColumns({
        "created_at": S.ntz("2024-01-01"), "closed_at": F.lit(None).cast("timestamp_ntz")})
    got = {r.agency_code: (r.agency_name, r.total_requests) for r in models.agency_dimension(df).collect()}
    assert got == {"A": ("y", 3), "B": ("p", 2), "C": ("UNKNOWN", 2)}


def test_filtering_keys_first_changes_nothing(spark):
    rng = random.Random(9)
    days = [f"2024-01-{d:02d}" for d in range(1, 15)]
    staged = models.stage(landed(spark, [
        (str(rng.randint(0, 150)), "2024-01-01", "", rng.choice(days), rng.choice(days), "a", f"r{i}")
        for i in range(800)]))
    since = dt.date(2024, 1, 10)
    plain = models.deduplicate(staged).where(F.col("batch_date") >= F.lit(since))
    assert sorted(map(str, models.changed_requests(staged, since).collect())) == sorted(map(str, plain.collect()))


def test_live_marts_keep_codes_as_they_come(spark):
    marts = models.live_marts(landed(spark, [
        ("1", "2024-01-01T00:00:00", "2024-01-01T00:00:01.500", "d", "", "a", "r"),
        ("1", "2024-01-02", "2024-01-01", "d", "", "a", "r")]))
    agency = marts["dim_agency"].first()
    assert (agency.total_requests, agency.closed_requests) == (2, 2)
    hours = sorted(r.resolution_hours or -1 for r in marts["fact"].collect())
    assert hours == [-1, pytest.approx(1.5 / 3600)]
    assert marts["borough_mix"].first().borough == "UNSPECIFIED"


def test_older_rows_are_shuffled_without_their_payload(spark):
    """Whole rows are moved for the batches taken up, not for the history."""
    staged = models.stage(landed(spark, [("1", "2024-01-01", "", "2024-01-02", "2024-01-02", "a", "r")]))
    plan = models.changed_requests(staged, dt.date(2024, 1, 2))
    joins, todo = [], [plan._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        joins += [node] if node.nodeName() == "Join" else []
    assert [j.children().apply(0).output().size() for j in joins] == [2]


def test_changed_requests_with_ties_and_nulls(spark):
    """Equal ingest times, missing dates and ids, and older rows that landed later."""
    rng = random.Random(4)
    stamps, days = ["2024-01-05", "2024-01-09", "", None], ["2024-01-08", "2024-01-09", "2024-01-12", None]
    staged = models.stage(landed(spark, [
        (rng.choice(["1", "2", "3", None, ""]) if i % 3 else str(i % 90), "2024-01-01", "", rng.choice(days), rng.choice(stamps),
         rng.choice(["a", None]), rng.choice(["r1", "r2"])) for i in range(400)]))
    since = dt.date(2024, 1, 9)
    plain = models.deduplicate(staged).where(F.col("batch_date") >= F.lit(since))
    assert sorted(map(str, models.changed_requests(staged, since).collect())) == sorted(map(str, plain.collect()))


def test_strings_of_the_order_are_carried_once(spark):
    staged = models.stage(landed(spark, [("1", "2024-01-01", "", "2024-01-02", "2024-01-02", "a", "r")]))
    best = staged.select(models.candidate(staged, "request_id").alias("best")).schema["best"].dataType
    assert {"_source_system", "_batch_id"} <= set(best.names)
    assert not {"source_system", "batch_id"} & set(best["row"].dataType.names)
    row = models.deduplicate(staged).first()
    assert (row.source_system, row.batch_id) == tuple(staged.select("source_system", "batch_id").first())


def test_wide_rows_are_read_in_small_splits(spark):
    """Unless the session says otherwise, and for requests only."""
    from workload import inputs

    session, size = spark.newSession(), "spark.sql.files.maxPartitionBytes"
    apply_defaults(session)
    assert session.conf.get(size) == spark.newSession().conf.get(size)
    inputs.prepare(session)
    assert session.conf.get(size) == "32m"
    session.conf.set(size, "5m")
    assert inputs.prepare(session).conf.get(size) == "5m"
