import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from reqmill.functions.scalars import ntz
from reqmill.operators import checks as Q
from reqmill.schema import FIELD_NAMES

NOW = "2026-09-10 00:00:00"


def row(spark, **values):
    base = dict.fromkeys(FIELD_NAMES, "") | {
        "request_id": "1", "created_at": "2026-09-01T00:00:00", "agency_code": "NYPD",
        "complaint_type": "Noise", "borough": "BRONX", "latitude": "40.7", "longitude": "-73.9"} | values
    return spark.createDataFrame([tuple(base.values())], ", ".join(f"{c} string" for c in base))


def by_name(df):
    return {r.check: r for r in df.collect()}


def test_bad_row_fails_its_checks(spark):
    bad = row(spark, created_at="2099-01-01T00:00:00", borough="ATLANTIS", latitude="88.0")
    got = by_name(Q.row_checks(bad, ntz(NOW)))
    assert not got["not_in_future: created_at"].passed
    assert not got["within_range: latitude"].passed
    assert not got["accepted_values: borough"].passed
    assert got["within_range: longitude"].passed


def test_good_row_passes_and_blank_counts_as_missing(spark):
    assert all(r.passed for r in Q.row_checks(row(spark), ntz(NOW)).collect())
    got = by_name(Q.row_checks(row(spark, agency_code="", borough=" bronx "), ntz(NOW)))
    assert got["not_null: agency_code"].failures == 1 and got["accepted_values: borough"].passed


def test_backdating_is_reported_but_passes(spark):
    got = by_name(Q.row_checks(row(spark, closed_at="2026-08-01"), ntz(NOW)))
    check = got["closed_at is never before created_at"]
    assert check.passed and check.failures == 1 and "quarantined" in check.detail


def test_surplus_copies(spark):
    df = row(spark).union(row(spark)).union(row(spark)).union(row(spark, request_id="2"))
    assert by_name(Q.row_checks(df, ntz(NOW)))["unique: request_id"].failures == 2


def test_set_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, v int")
    assert [tuple(r) for r in Q.unique(df, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in Q.accepted_values(df, "k", ["b"]).collect()] == [("a", 2)]
    parent = spark.createDataFrame([("b",)], "key string")
    assert [tuple(r) for r in Q.relationships(df, "k", parent, "key").collect()] == [("a", 2)]


def test_range_is_closed_and_nulls_pass(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.01,), (None,), (float("nan"),)], "x double")
    assert df.where(Q.within_range("x", 0, 1)).count() == 2


def test_grace_hours(spark):
    df = spark.createDataFrame([("2026-09-11 00:00:00",), ("2026-09-11 00:00:01",)], "t string") \
        .select(F.col("t").cast("timestamp_ntz"))
    assert df.where(Q.not_in_future("t", ntz(NOW))).count() == 1


def test_reconcile_and_anomaly_rate(spark):
    fact = spark.createDataFrame([(True,), (False,)], "has_invalid_timestamps boolean")
    mart = spark.createDataFrame([(2,)], "requests_opened bigint")
    assert Q.reconcile(fact, mart).count() == 0
    assert tuple(Q.reconcile(fact, mart.union(mart)).first()) == (2, 4)
    assert Q.anomaly_rate(fact).first()[0] == 1
    assert Q.anomaly_rate(fact.where("not has_invalid_timestamps")).count() == 0


def test_warnings_do_not_stop_a_run_and_failures_do(spark):
    df = spark.createDataFrame([("x",), (None,)], "a string")

    def summary(severity):
        return Q.summarize(Q.run_checks([Q.Check("not_null", "m", "a", severity, bad=Q.not_null("a"))], {"m": df}))

    Q.gate(summary("warn"))
    with pytest.raises(Q.QualityGateError, match="not_null_m_a"):
        Q.gate(summary("error"))


def test_suite_by_kind(spark):
    checks = Q.standard_checks(ntz(NOW))
    counts = {}
    for c in checks:
        counts[c.kind] = counts.get(c.kind, 0) + 1
    assert counts == {"not_null": 24, "within_range": 5, "not_in_future": 4, "accepted_values": 4,
                      "unique": 2, "relationships": 2, "singular": 3}
    assert len({c.test for c in checks}) == 44


def test_row_by_row_checks_share_a_pass(spark):
    df = spark.createDataFrame([("x", None)], "a string, b string")
    suite = [Q.Check("not_null", "m", c, bad=Q.not_null(c)) for c in ("a", "b")]
    results = Q.run_checks(suite, {"m": df})
    assert {(r.test, r.status) for r in results.collect()} == {("not_null_m_a", "pass"), ("not_null_m_b", "fail")}
    assert results._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_missing_stage_counts_minus_one(spark):
    got = {r.stage: r.rows for r in Q.stage_funnel({"a": spark.range(3), "b": None}).collect()}
    assert got == {"a": 3, "b": -1}


def test_folds_of_parts_add_up(spark):
    """A table in parts, folded apart, judged later than it was folded."""
    rng = random.Random(2)
    stamps = [dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1), dt.datetime(2024, 6, 2, 0, 0, 1), dt.datetime(2024, 9, 1), None]
    rows = [(i % 3, rng.choice(stamps), rng.choice(["a", "b", "x", "y", None]), rng.choice(["k1", "k2", "k3", None]), rng.choice([1.0, 5.0, None]))
            for i in range(500)]
    table = spark.createDataFrame(rows, "part int, at timestamp_ntz, kind string, code string, size double")
    parents = spark.createDataFrame([("k1",)], "code string")

    def suite(now):
        return [Q.Check("not_null", "t", "kind", bad=Q.not_null("kind")), Q.Check("not_in_future", "t", "at", bad=Q.not_in_future("at", ntz(now))),
                Q.Check("within_range", "t", "size", bad=Q.within_range("size", 0, 3)),
                Q.Check("accepted_values", "t", "kind", "warn", allowed=["a", "b"], rows=lambda t: Q.accepted_values(t["t"], "kind", ["a", "b"])),
                Q.Check("relationships", "t", "code", weight="n_records", parent="p", rows=lambda t: Q.relationships(t["t"], "code", t["p"], "code")),
                Q.Check("singular", "t", name="any_large", bad=F.col("size") > 4, once=True)]

    folds = Q.fold(suite("2024-05-01"), "t", table.where("part = 0"), "part").unionByName(
        Q.fold(suite("2024-05-20"), "t", table.where("part > 0"), "part"))
    later, tables = "2024-06-01", {"t": table, "p": parents}
    kept = Q.run_checks(suite(later), tables, {"t": folds.drop("part")}, now=ntz(later)).collect()
    got = {r.test: (r.failures, r.status) for r in kept}
    assert got == {r.test: (r.failures, r.status) for r in Q.run_checks(suite(later), tables).collect()}
    plain = {c.test: Q.failing_rows(c, tables) for c in suite(later)}
    assert got["not_in_future_t_at"][0] == plain["not_in_future_t_at"].count() > 0
    assert got["accepted_values_t_kind"] == (2, "warn") and got["any_large"] == (1, "fail")
    assert got["relationships_t_code"][0] == plain["relationships_t_code"].agg(F.sum("n_records")).first()[0]
