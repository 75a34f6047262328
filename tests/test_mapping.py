import random

import pytest
from pyspark.sql import functions as F

from reqmill.operators import mapping as M
from reqmill.schema import SOURCE_SYSTEMS
from workload import dialects as D

HEADERS = "source_system string, ordinal int, source_column string"
PROPOSALS = ("source_system string, source_column string, canonical_field string, "
             "confidence double, reasoning string")


def headers(spark, columns, system="t"):
    return spark.createDataFrame([(system, i, c) for i, c in enumerate(columns)], HEADERS)


def proposals(spark, rows):
    return spark.createDataFrame([("t", *r) for r in rows], PROPOSALS)


def by_column(df):
    return {r.source_column: r for r in df.collect()}


@pytest.fixture(scope="module")
def golden(spark):
    all_headers = spark.createDataFrame([r[:3] for r in D.dialect_rows()], HEADERS)
    df = M.resolve_headers(all_headers, D.override_table(spark)).drop("proposal_outcome")
    rows = df.collect()
    return spark.createDataFrame(rows, df.schema)


def test_golden_decisions(golden):
    got = {(r.source_system, r.source_column): (r.method, r.canonical_field, r.confidence)
           for r in golden.collect()}
    assert got == {(s, h): (m, f, c) for s, _, h, _, m, f, c in D.golden_rows()}


def test_published_totals(golden):
    stats = {r.source_system: r for r in M.mapping_stats(golden).collect()}
    assert [stats[s].mean_confidence for s in SOURCE_SYSTEMS] == [0.9464, 0.9875, 0.9526, 1.0]
    assert stats["legacy_crm"].fallback_rate == 0.5333
    total = M.mapping_rollup(M.mapping_stats(golden)).first()
    assert (total.override, total.exact, total.llm, total.fuzzy, total.unmapped) == (3, 43, 0, 17, 20)
    assert (total.columns_total, total.auto_match_rate, total.fallback_rate) == (83, 0.75, 0.2698)
    assert [r["columns"] for r in M.confidence_histogram(golden).orderBy("position").collect()] == [46, 15, 2, 20]
    truth = golden.sparkSession.createDataFrame(
        [(s, h, f) for s, _, h, f in D.dialect_rows()],
        "source_system string, source_column string, expected string")
    acc = M.accuracy(golden, truth).where("source_system = 'TOTAL'").first()
    assert (acc.should_map, acc.correct, acc.mis_mapped, acc.operational, acc.declined) == (76, 63, 0, 7, 7)


def test_losing_a_field_says_to_whom(golden):
    lost = golden.where("source_column = 'assignedAgencyLabel'").first()
    assert lost.reasoning == "agency_code is held by 'assignedAgencyCode', at 0.90"
    low = golden.where("source_column = 'ROW_CHECKSUM'").first()
    assert "of the 0.82 needed" in low.reasoning


def test_column_map_holds_each_field_once(golden):
    mapped = M.column_map(golden, "legacy_crm")
    assert mapped["SR_NUMBER"] == "request_id" and len(set(mapped.values())) == len(mapped) == 15


def test_exact_names_and_synonyms(spark):
    got = by_column(M.resolve_headers(headers(spark, ["created_at", "Incident Zip"])))
    assert (got["created_at"].canonical_field, got["created_at"].method) == ("created_at", "exact")
    assert got["Incident Zip"].canonical_field == "postal_code"


def test_proposals(spark):
    got = by_column(M.resolve_headers(
        headers(spark, ["INTK_SRC", "ZIP_CD", "CITY_NM", "ROW_CHECKSUM", "BORO_X", "DT_OPENED"]),
        proposals=proposals(spark, [
            ("INTK_SRC", "intake_channel", 0.93, "r" * 400),
            ("ZIP_CD", "borough", 0.11, "unsure"),
            ("CITY_NM", "no_such_field", 0.99, "sure"),
            ("ROW_CHECKSUM", None, 0.97, "audit column")])))
    assert (got["INTK_SRC"].canonical_field, got["INTK_SRC"].method) == ("intake_channel", "llm")
    assert got["INTK_SRC"].reasoning == "r" * 400
    assert (got["ZIP_CD"].canonical_field, got["ZIP_CD"].method) == ("postal_code", "fuzzy")
    assert (got["CITY_NM"].canonical_field, got["CITY_NM"].method) == ("city", "fuzzy")
    assert (got["ROW_CHECKSUM"].canonical_field, got["ROW_CHECKSUM"].method) == (None, "llm")
    assert got["DT_OPENED"].method == "fuzzy" and got["DT_OPENED"].proposal_outcome is None


def test_collision_goes_to_the_higher_confidence(spark):
    got = by_column(M.resolve_headers(
        headers(spark, ["col_a", "col_b"]),
        proposals=proposals(spark, [("col_a", "borough", 0.80, "a"), ("col_b", "borough", 0.95, "b")])))
    assert got["col_b"].canonical_field == "borough"
    assert got["col_a"].canonical_field is None and got["col_a"].method == "unmapped"
    assert got["col_a"].reasoning == "borough went to 'col_b', at 0.95"


def test_of_repeated_overrides_the_last_counts(spark):
    overrides = spark.createDataFrame(
        [("t", "Kind", "complaint_type", 0), ("t", "Kind", "descriptor", 1)],
        "source_system string, source_column string, canonical_field string, ordinal int")
    got = M.resolve_headers(headers(spark, ["Kind"]), overrides).collect()
    assert [(r.canonical_field, r.method) for r in got] == [("descriptor", "override")]
    both = spark.createDataFrame([("t", "Kind", "descriptor")] * 2, "source_system string, source_column string, expected string")
    total = M.accuracy(M.resolve_headers(headers(spark, ["Kind"]), overrides), both).where("source_system = 'TOTAL'").first()
    assert (total["columns"], total.correct) == (1, 1)


def test_findings_name_how_many_there_are(spark):
    gaps = spark.createDataFrame([(f"s{i}", 0, "x") for i in range(6)], "source_system string, ordinal int, source_column string")
    with pytest.raises(M.MappingError, match="in 6 system.*1 more"):
        M.require_fields(M.resolve_headers(gaps))
    bad = spark.createDataFrame([("s", f"c{i}", "nowhere") for i in range(3)], "source_system string, source_column string, canonical_field string")
    assert M.invalid_overrides(bad).count() == 3
    with pytest.raises(M.MappingError, match="^3 override"):
        M.validate_overrides(bad)


def test_override_beats_a_proposal(spark):
    overrides = spark.createDataFrame(
        [("t", "Issue Category", "complaint_type"), ("t", "Internal", None)],
        "source_system string, source_column string, canonical_field string")
    got = by_column(M.resolve_headers(
        headers(spark, ["Issue Category", "Internal"]), overrides,
        proposals(spark, [("Issue Category", "descriptor", 0.99, "x")])))
    assert (got["Issue Category"].canonical_field, got["Issue Category"].method) == ("complaint_type", "override")
    assert (got["Internal"].canonical_field, got["Internal"].method) == (None, "override")


def test_unknown_override_target_is_an_error(spark):
    bad = spark.createDataFrame([("s", "c", "not_a_real_field")],
                                "source_system string, source_column string, canonical_field string")
    with pytest.raises(M.MappingError, match="unknown"):
        M.validate_overrides(bad)


def test_required_fields_gate(spark):
    with pytest.raises(M.MappingError, match="required canonical fields left unmapped"):
        M.require_fields(M.resolve_headers(headers(spark, ["ROW_CHECKSUM"])))


def test_candidates(spark):
    got = M.fuzzy_candidates(headers(spark, ["CMPLNT_TYP"]), top_n=4).orderBy("candidate_rank").collect()
    assert len(got) == 4 and got[0].canonical_field == "complaint_type" and got[0].score == 0.8333


def _one_by_one(claims):
    """Commit claims in turn, keeping a holder per field."""
    holder, out = {}, {}
    for system, field, conf, tier, ordinal, column in sorted(claims, key=lambda c: c[3:5]):
        key, held = (system, field), holder.get((system, field)) if field else None
        if held and conf <= held[0]:
            out[system, ordinal] = (None, f"{field} is held by '{held[1]}', at {held[0]:.2f}")
            continue
        if held:
            out[system, held[2]] = (None, f"{field} went to '{column}', at {conf:.2f}")
        out[system, ordinal] = (field, "own")
        if field:
            holder[key] = (conf, column, ordinal)
    return out


def test_assignment_equals_committing_one_by_one(spark):
    rng = random.Random(3)
    claims = [(f"s{s}", rng.choice(["city", "status", "borough", None]), rng.randint(70, 78) / 100,
               rng.randint(0, 3), i, f"c{i}") for s in range(40) for i in range(15)]
    df = spark.createDataFrame(
        claims, "source_system string, canonical_field string, confidence double, tier int, "
                "ordinal int, source_column string").withColumns({
                    "method": F.lit("fuzzy"), "reasoning": F.lit("own"),
                    "proposal_outcome": F.lit(None).cast("string")})
    got = {(r.source_system, r.ordinal): (r.canonical_field, r.reasoning) for r in M.assign(df).collect()}
    assert got == _one_by_one(claims)


def test_log_counts_one_run(spark, golden, tmp_path):
    from reqmill.sources import tables
    for run in ("a", "b"):
        tables.append_decisions(golden, str(tmp_path / "log"), "2024-01-15", run)
    assert tables.read_decisions(spark, str(tmp_path / "log"), "2024-01-15").count() == 166
    assert tables.read_decisions(spark, str(tmp_path / "log"), "2024-01-15", "b").count() == 83
    assert tables.read_decisions(spark, str(tmp_path / "log"), "2024-01-16").count() == 0
