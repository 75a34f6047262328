import datetime as dt

import pytest
from pyspark.sql import functions as F

from reqmill.operators.landing import apply_mapping, dropped_columns, land_lines
from reqmill.schema import FIELD_NAMES, LINEAGE, canonical_fields
from reqmill.sources import batch_files, slices, tables
from workload import dialects as D


def landing(spark, day, ids):
    df = spark.createDataFrame([(i,) for i in ids], "request_id string")
    return apply_mapping(df, {"request_id": "request_id"}, "a", day, f"b-{day}")


def test_rename_drop_stamp(spark):
    df = spark.createDataFrame([("1", "NYPD", "abc"), ("2", "DSNY", "def")],
                               "SR_NUMBER string, AGCY string, ROW_CHECKSUM string")
    columns = {"SR_NUMBER": "request_id", "AGCY": "agency_code"}
    out = apply_mapping(df, columns, "test_src", "2024-01-15", "batch-1")
    assert out.columns == FIELD_NAMES + LINEAGE
    rows = out.collect()
    assert [r.request_id for r in rows] == ["1", "2"]
    assert {(r._source_system, r._batch_id) for r in rows} == {("test_src", "batch-1")}
    assert all(r.borough is None for r in rows) and len({r._ingested_at for r in rows}) == 1
    assert dropped_columns(df, columns) == ["ROW_CHECKSUM"]


def test_a_write_that_dies_leaves_the_batch(spark, tmp_path):
    path = str(tmp_path / "landing")
    tables.replace_batch(landing(spark, "2024-01-15", ["1", "2"]), path, "2024-01-15")
    bad = F.when(F.col("request_id") == "4", F.raise_error(F.lit("gone"))).otherwise(F.col("city"))
    with pytest.raises(Exception, match="gone"):
        tables.replace_batch(landing(spark, "2024-01-15", ["3", "4"]).withColumn("city", bad), path, "2024-01-15")
    assert sorted(r.request_id for r in tables.read_landing(spark, path).collect()) == ["1", "2"]


def test_counts_come_from_the_write(spark, tmp_path, monkeypatch):
    """Nothing is read back to be counted."""
    monkeypatch.setattr(tables, "read_landing", None)
    assert tables.replace_batch(landing(spark, "2024-01-15", map(str, range(1000))).repartition(7), str(tmp_path), "2024-01-15") == 1000
    frames = {"a": spark.range(30).repartition(3), "none": spark.range(0), "sorted": spark.range(20).orderBy(F.desc("id"))}
    counts = tables.export_tables(frames, str(tmp_path / "out"))
    assert {r.table: r.rows for r in counts.collect()} == {"a": 30, "none": 0, "sorted": 20}


def write_files(folder, files):
    for system, name, text in files:
        (folder / f"dt=2024-01-15/source_system={system}").mkdir(parents=True, exist_ok=True)
        (folder / f"dt=2024-01-15/source_system={system}/{name}.csv").write_text(text)


def test_one_scan_reads_all_systems(spark, tmp_path):
    """Files with headers of their own, in another order, with quotes and line breaks, a
    short line, a repeated column, and one without rows."""
    write_files(tmp_path, [
        ("a", "one", 'SR_NUMBER,AGCY,BORO\n1,NYPD,"BRONX, N"\n2,"say ""x""\nthere",\n'),
        ("a", "two", "BORO,SR_NUMBER\nQUEENS,3\n"),
        ("b", "one", "id,city,note,city\n4,Rome,n,Oslo\nid,city,note,city\n5\n"),
        ("c", "none", "id,city\n")])
    lines = batch_files.read_day(spark, str(tmp_path), "2024-01-15", width=8)
    headers = batch_files.file_headers(lines)
    assert sorted(map(tuple, batch_files.system_headers(headers).collect())) == [
        ("a", 0, "BORO"), ("a", 0, "SR_NUMBER"), ("a", 1, "AGCY"), ("b", 0, "id"), ("b", 1, "city"), ("b", 2, "note"), ("c", 0, "id"), ("c", 1, "city")]
    decided = [("a", "SR_NUMBER", "request_id"), ("a", "AGCY", "agency_code"), ("a", "BORO", "borough"), ("b", "id", "request_id"),
               ("b", "city", "city"), ("b", "note", None), ("c", "id", "request_id")]
    decisions = spark.createDataFrame(decided, "source_system string, source_column string, canonical_field string")
    landed = land_lines(lines, headers, decisions, "2024-01-15", "b1", "now")
    assert landed.columns == FIELD_NAMES + LINEAGE
    got = sorted((r._source_system, r.request_id, r.agency_code, r.borough, r.city) for r in landed.collect())
    assert got == [("a", "1", "NYPD", "BRONX, N", None), ("a", "2", 'say "x"\nthere', "", None), ("a", "3", None, "QUEENS", None),
                   ("b", "4", None, None, "Rome"), ("b", "5", None, None, ""), ("b", "id", None, None, "city")]
    with pytest.raises(Exception, match="more than 2 columns"):
        batch_files.read_day(spark, str(tmp_path), "2024-01-15", width=2)
    with pytest.raises(FileNotFoundError):
        batch_files.read_day(spark, str(tmp_path), "2024-01-16")


def test_two_hundred_systems_are_one_plan(spark, tmp_path):
    def plan(n):
        write_files(tmp_path / str(n), [(f"s{i:03d}", "f", f"key {i},city\n{i},c{i}\n") for i in range(n)])
        lines = batch_files.read_day(spark, str(tmp_path / str(n)), "2024-01-15", width=4)
        decisions = spark.createDataFrame([(f"s{i:03d}", f"key {i}", "request_id") for i in range(n)],
                                          "source_system string, source_column string, canonical_field string")
        landed = land_lines(lines, batch_files.file_headers(lines), decisions, "2024-01-15", "b1")
        assert sorted(int(r.request_id) for r in landed.collect()) == list(range(n))
        return len(landed._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert plan(200) == plan(3)


def test_samples_skip_blanks(spark):
    df = spark.createDataFrame([(1, ""), (2, "  "), (3, "\t"), (4, "real"), (5, "also real"), (6, "late")],
                               "k int, col string")
    got = batch_files.sample_values(df, ["k"], ["col"], n=2).first()
    assert got.samples == ["real", "also real"]


def test_replacing_a_batch(spark, tmp_path):
    path = str(tmp_path / "landing")
    assert tables.replace_batch(landing(spark, "2024-01-15", ["1", "2"]), path, "2024-01-15") == 2
    assert tables.replace_batch(landing(spark, "2024-01-16", ["3"]), path, "2024-01-16") == 1
    assert tables.replace_batch(landing(spark, "2024-01-15", ["1", "2"]), path, "2024-01-15") == 2
    assert tables.row_count(spark, path) == 3
    assert tables.replace_batch(landing(spark, "2024-01-15", ["1"]).where("false"), path, "2024-01-15") == 0
    assert [r.request_id for r in tables.read_landing(spark, path).collect()] == ["3"]
    assert dict(tables.read_landing(spark, path).dtypes)["_batch_date"] == "string"
    with pytest.raises(Exception, match="row of another batch"):
        tables.replace_batch(landing(spark, "2024-01-17", ["9"]), path, "2024-01-18")


def test_missing_relation_counts_minus_one(spark, tmp_path):
    assert tables.row_count(spark, str(tmp_path / "none")) == -1
    assert tables.row_count(spark, "no_such_table") == -1
    spark.range(3).createOrReplaceTempView("three")
    assert tables.row_count(spark, "three") == 3


def test_named_table_order(spark, tmp_path):
    schema = "n bigint"
    live = {"t": "select id + 100 as n from three"}
    spark.range(3).createOrReplaceTempView("three")
    assert tables.load_named(spark, "t", live, str(tmp_path), schema, "three").count() == 3
    assert tables.load_named(spark, "t", live, str(tmp_path), schema, "gone").count() == 0
    tables.export_tables({"t": spark.range(2).withColumnRenamed("id", "n")}, str(tmp_path))
    assert tables.load_named(spark, "t", live, str(tmp_path), schema, "gone").count() == 2


def test_schemas_exist_after_ensure(spark):
    tables.ensure_schemas(spark)
    assert {"raw", "staging", "analytics"} <= {d.name for d in spark.catalog.listDatabases()}


@pytest.mark.parametrize("n", [1, 10, 1003])
def test_row_index_is_the_sorted_position(spark, n):
    df = spark.createDataFrame([((i * 7919) % n, f"v{i}") for i in range(n)], "k int, v string").repartition(5)
    got = slices.ordered_index(df, ["k", "v"]).collect()
    assert [r.row_index for r in sorted(got, key=lambda r: (r.k, r.v))] == list(range(n))


def test_csv_keeps_quotes_breaks_and_blanks(spark, tmp_path):
    values = ['say "hi", twice', "two\nlines", "", "back\\slash", "comma, only", " padded "]
    rows = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "request_id string, city string")
    dealt = slices.round_robin(rows, ["request_id"], ["one"])
    batch_files.write_batch(dealt, str(tmp_path), "2024-01-15", {"one": {"request_id": "ID", "city": "Town Name"}},
                            {"one": ["ref"]})
    assert batch_files.batch_systems(spark, str(tmp_path), "2024-01-15") == ["one"]
    back = batch_files.read_batch(spark, f"{tmp_path}/dt=2024-01-15/source_system=one")
    assert back.columns == ["ID", "Town Name", "ref"]
    assert [r["Town Name"] for r in back.orderBy("ID").collect()] == values
    assert back.where("ID = '3'").first().ref == "one-3"


def test_missing_files_and_empty_batches_are_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        batch_files.batch_systems(spark, str(tmp_path), "2024-01-15")
    with pytest.raises(batch_files.EmptyBatch):
        batch_files.require_rows(spark.range(0), "today")


def test_day_slice_on_text_and_typed_columns(spark):
    rows = [(1, "2024-01-14T23:59:59.000"), (2, "2024-01-15T00:00:00.000"), (3, "2024-01-16T00:00:00.000"), (4, "")]
    text = spark.createDataFrame(rows, "k int, ts string")
    typed = text.withColumn("ts", F.expr("try_cast(ts as timestamp_ntz)"))
    for df in (text, typed):
        assert [r.k for r in slices.day_slice(df, "ts", dt.date(2024, 1, 15), ["k"]).collect()] == [2]
    bounds = slices.batch_bounds(text, "ts").first()
    assert bounds.oldest_created_at == "2024-01-14T23:59:59.000"


def test_schema_listing(spark):
    from reqmill.plans.serving import schema_listing
    rows = schema_listing(canonical_fields(spark)).orderBy("ordinal").collect()
    assert len(rows) == 19 and [r.field for r in rows if r.required] == [
        "request_id", "created_at", "agency_code", "complaint_type"]
    assert len(D.SOURCE_NAMES) == 19


def test_rows_already_dealt_out_are_written_where_they_are(spark, tmp_path):
    """Without another shuffle: each task writes a file for each of its batches."""
    day = F.when(F.col("id") % 2 == 0, "2024-01-01").otherwise("2024-01-02")
    rows = spark.range(0, 40, 1, 2).select(*[
        (day if c == "_batch_date" else F.col("id").cast("string")).alias(c) for c in [*FIELD_NAMES, *LINEAGE]])
    for name, dealt, files in (("dealt", True, 2), ("not", False, 1)):
        path = f"{tmp_path}/{name}"
        tables.replace_batches(rows, path, dealt=dealt)
        assert len(list((tmp_path / name / "_batch_date=2024-01-01").glob("*.parquet"))) == files
        assert sorted(map(tuple, tables.read_landing(spark, path).collect())) == sorted(map(tuple, rows.collect()))


def test_landed_rows_are_dealt_out_before_they_are_widened(spark, tmp_path):
    from workload import inputs as I

    orders = [(k, dt.datetime(1996, 1, k), "1-URGENT", "O", "unread") for k in (1, 2, 3)]
    lines = [(k, n, 97 + n, k, 10.5, "R", "F", dt.datetime(1996 + n, 2, k)) for k, *_ in orders for n in (1, 2)]
    spark.createDataFrame(orders, "o_orderkey int, o_orderdate timestamp_ntz, o_orderpriority string, o_orderstatus string, "
                          "o_comment string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey int, l_linenumber int, l_partkey int, l_suppkey int, l_extendedprice double, l_returnflag string, "
                          "l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    dealt = I.landed(spark, str(tmp_path), by=F.year("l_shipdate"))
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, I.landed(spark, str(tmp_path)).collect()))
    node = dealt._jdf.queryExecution().optimizedPlan()
    assert node.output().size() == len(dealt.columns)
    while node.nodeName() != "RebalancePartitions":
        node = node.children().apply(0)
    assert node.output().size() <= 12
