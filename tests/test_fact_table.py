"""The fact and its marts under updates."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from reqmill.functions import scalars as S
from reqmill.plans import models
from reqmill.plans.fact_table import BY, FACT, ROWS, FactTable, _partition
from reqmill.sources.versions import Versions
from test_models import landed


def _ids(fact):
    return {r.request_id: (str(r.created_date), r.batch_id) for r in fact.collect()}


def test_incremental_fact(spark, tmp_path):
    fact = FactTable(spark, str(tmp_path / "fact"))
    rows = [("1", "2024-01-01", "", "2024-01-01", "2024-01-01", "a", "b1"),
            ("2", "2024-01-02", "", "2024-01-02", "2024-01-02", "a", "b2")]
    fact.update(models.stage(landed(spark, rows)))
    assert _ids(fact.read()) == {"1": ("2024-01-01", "b1"), "2": ("2024-01-02", "b2")}
    assert fact.mark() == dt.date(2024, 1, 2)

    # '1' comes again with another creation date.
    rows += [("1", "2024-01-05", "", "2024-01-03", "2024-01-03", "a", "b3"),
             ("3", "2024-01-02", "", "2024-01-03", "2024-01-03", "a", "b3")]
    for _ in range(2):   # the second time changes nothing
        fact.update(models.stage(landed(spark, rows)))
        assert _ids(fact.read()) == {"1": ("2024-01-05", "b3"), "2": ("2024-01-02", "b2"),
                                     "3": ("2024-01-02", "b3")}

    # A late batch lands below the mark: skipped, unless asked for.
    rows.append(("4", "2024-01-01", "", "2024-01-01", "2024-01-09", "a", "late"))
    fact.update(models.stage(landed(spark, rows)))
    assert "4" not in _ids(fact.read())
    fact.update(models.stage(landed(spark, rows)), reprocess_from=dt.date(2024, 1, 1))
    assert _ids(fact.read())["4"] == ("2024-01-01", "late")


@pytest.mark.parametrize("step", ["_write_cells", "_write_names", "_commit", "_remove_old", "partly written"])
def test_an_interrupted_update_can_be_repeated(spark, tmp_path, monkeypatch, step):
    """A backlog of two batches; the run dies before or after each step."""
    rows = [("1", "2024-01-01", "", "2024-01-10", "2024-01-10", "a", "b10")]
    fact = FactTable(spark, str(tmp_path / "fact"), buckets=2)
    fact.update(models.stage(landed(spark, rows)))
    rows += [("2", "2024-01-02", "", "2024-01-11", "2024-01-11", "a", "b11"),
             ("3", "2024-01-03", "", "2024-01-12", "2024-01-12", "a", "b12")]
    staged = models.stage(landed(spark, rows))
    if step == "partly written":
        fact.versions.write("rows", fact.versions.read("rows", ROWS, fact.versions.last()), "000000000002-deadbeef", BY)
        (tmp_path / "fact" / "commits" / "_000000000002-deadbeef").write_text("{")
    else:
        with monkeypatch.context() as patch:
            def die(*args):
                raise OSError("gone")
            patch.setattr(fact, step, die)
            with pytest.raises(OSError, match="gone"):
                fact.update(staged)
        done = {"1", "2", "3"} if step == "_remove_old" else {"1"}
        assert set(_ids(fact.read())) == done and fact.mark() == dt.date(2024, 1, 12 if len(done) > 1 else 10)
    for _ in range(3):
        fact.update(staged)
        assert _ids(fact.read()) == {"1": ("2024-01-01", "b10"), "2": ("2024-01-02", "b11"), "3": ("2024-01-03", "b12")}
    rows.append(("2", "2024-01-02", "2024-02-01", "2024-01-13", "2024-01-13", "a", "b13"))
    fact.update(models.stage(landed(spark, rows)))
    assert len(list((tmp_path / "fact" / "commits").glob("0*"))) == 2
    runs = {p.name for p in (tmp_path / "fact" / "rows").iterdir()}
    assert "_run=000000000002-deadbeef" not in runs and len(runs) <= 3



def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def assert_equal_to_a_rebuild(fact, staged):
    deduped = models.deduplicate(staged)
    want = models.build_fact(deduped)
    assert rows_of(fact.read()) == rows_of(want)
    assert rows_of(fact.daily()) == rows_of(models.daily_sla(want))
    assert rows_of(fact.agencies()) == rows_of(models.agency_dimension(deduped))


def random_batch(rng, day, n, ids):
    """Landed rows of a day: new requests and old ones that change, move or lose their date."""
    out = []
    for i in range(n):
        created = rng.choice(["", f"2024-0{rng.randint(1, 4)}-{rng.randint(1, 28):02d}T0{rng.randint(0, 9)}:00:00"])
        closed = rng.choice(["", f"2024-0{rng.randint(1, 6)}-{rng.randint(1, 28):02d}T10:30:00"])
        out.append((str(rng.randint(0, ids)), created, closed, f"2024-07-{day:02d}", f"2024-07-{day:02d}T0{rng.randint(0, 9)}:00:00", "a", f"r{day}-{i}"))
    return out


def with_names(landed_rows):
    """Agencies and types by request and batch, so that both change between batches."""
    pick = F.abs(F.xxhash64("request_id", "_batch_date"))
    return landed_rows.withColumns({
        "agency_code": F.concat(F.lit("A"), pick % 3), "agency_name": F.when(pick % 5 > 0, F.concat(F.lit("name "), pick % 4)),
        "complaint_type": F.when(pick % 7 > 0, F.concat(F.lit("type "), pick % 6)),
        "borough": F.when(pick % 11 > 2, F.lit("Bronx")).otherwise("")})


def test_marts_follow_inserts_updates_and_moved_days(spark, tmp_path):
    rng, rows = random.Random(3), []
    fact = FactTable(spark, str(tmp_path / "fact"), buckets=2, positions=1 << 10)
    for day in (1, 2, 3, 4):
        rows += random_batch(rng, day, 60, 90)
        staged = models.stage(with_names(landed(spark, rows)))
        fact.update(staged)
        assert_equal_to_a_rebuild(fact, staged)
    before = fact.versions.last()
    fact.update(staged)  # nothing has changed
    assert fact.versions.last() == before


def test_an_agencys_last_request_moves_away(spark, tmp_path):
    rows = [("1", "2024-01-01", "", "2024-07-01", "2024-07-01", "a", "r"), ("2", "2024-02-01", "", "2024-07-01", "2024-07-01", "a", "r")]
    fact = FactTable(spark, str(tmp_path / "fact"), buckets=1)
    fact.update(models.stage(landed(spark, rows)))
    rows += [("1", "2024-03-05", "2024-03-06", "2024-07-02", "2024-07-02", "a", "r2")]
    staged = models.stage(landed(spark, rows))
    fact.update(staged)
    assert_equal_to_a_rebuild(fact, staged)
    record = fact.versions.last()
    assert {t: sorted(p) for t, p in record["tables"].items() if t in ("rows", "daily")} == {
        "rows": ["_period=2024-02/_bucket=0", "_period=2024-03/_bucket=0"], "daily": ["_period=2024-02", "_period=2024-03"]}
    assert record["parts"]["_period=2024-03/_bucket=0"] == [1, "2024-03-05", "2024-03-05"]


def test_requests_without_an_id_are_one_request(spark, tmp_path):
    """A null id stands for one request, as it does in a rebuild."""
    rows = [("", "2024-01-01", "", "2024-07-01", "2024-07-01", "a", "r1"), ("5", "2024-01-01", "", "2024-07-01", "2024-07-01", "a", "r1")]
    no_id = F.when(F.col("request_id") != "", F.col("request_id"))
    fact = FactTable(spark, str(tmp_path / "fact"))
    fact.update(models.stage(landed(spark, rows).withColumn("request_id", no_id)))
    rows += [("", "2024-02-01", "", "2024-07-02", "2024-07-02", "a", "r2")]
    staged = models.stage(landed(spark, rows).withColumn("request_id", no_id))
    fact.update(staged)
    assert_equal_to_a_rebuild(fact, staged)


def test_two_updates_at_once(spark, tmp_path):
    """Both build on the same commit; the second to finish is refused and harms nothing."""
    rows = [("1", "2024-01-01", "", "2024-07-01", "2024-07-01", "a", "r1")]
    fact = FactTable(spark, str(tmp_path / "fact"), buckets=1)
    fact.update(models.stage(landed(spark, rows)))
    first = models.stage(landed(spark, [*rows, ("1", "2024-01-02", "", "2024-07-02", "2024-07-02", "a", "first")]))
    second = models.stage(landed(spark, [*rows, ("1", "2024-01-03", "", "2024-07-03", "2024-07-03", "a", "second")]))
    other, write_names = FactTable(spark, str(tmp_path / "fact"), buckets=1), fact._write_names

    def meanwhile(*args):
        other.update(second)
        return write_names(*args)
    fact._write_names = meanwhile
    with pytest.raises(RuntimeError, match="another run"):
        fact.update(first)
    assert_equal_to_a_rebuild(fact, second)


def many(spark, n, first_batch, batch):
    """n staged requests over 24 months; those of a later batch are of its last month."""
    day = F.date_add(F.lit(dt.date(2022, 1, 1)), F.col("id").cast("int") % 730)
    staged = spark.range(first_batch, first_batch + n).select(
        F.concat(F.lit("r"), "id").alias("request_id"), (day if batch == 1 else F.lit(dt.date(2023, 12, 1))).cast("timestamp_ntz").alias("created_at"))
    empty = models.stage(landed(spark, []))
    return staged.select(*[F.col(f.name) if f.name in staged.columns else F.lit({"batch_date": dt.date(2024, 1, batch)}.get(f.name))
                           .cast(f.dataType).alias(f.name) for f in empty.schema])


def test_a_small_batch_rewrites_few_parts(spark, tmp_path):
    """A million requests, then a thousand: 900 new ones and 100 that were there in the last month."""
    fact = FactTable(spark, str(tmp_path / "fact"), buckets=8)
    rows = many(spark, 1_000_000, 0, 1)
    fact.update(rows)
    before = fact.versions.last()
    last = (rows.where("created_at >= '2023-12-01'").orderBy(F.xxhash64("request_id")).limit(100)
            .withColumns({"batch_date": F.lit(dt.date(2024, 1, 2)), "closed_at": S.ntz("2024-01-05")}))
    batch = many(spark, 900, 2_000_000, 2).unionByName(last)
    read = []
    whole, fact.versions.read = fact.versions.read, lambda table, schema, record, partitions=None: (
        read.append((table, None if partitions is None else len(partitions))), whole(table, schema, record, partitions))[1]
    fact.update(rows.unionByName(batch))
    after = fact.versions.last()
    parts = before["tables"]["rows"]
    rewritten = [p for p, run in after["tables"]["rows"].items() if parts.get(p) != run]
    assert len(parts) == 24 * 8 and len(rewritten) <= len(parts) // 10
    assert all(n is not None for table, n in read if table in ("rows", "cells", "names"))  # no table is read whole
    assert max(n for table, n in read if table == "cells") == 1
    assert fact.read().count() == 1_000_900 and fact.read().where("is_closed").count() == 100
    daily = fact.daily().agg(F.sum("requests_opened"), F.sum("requests_closed")).first()
    assert tuple(daily) == (1_000_900, 100)


def test_bitmaps_find_every_part_that_holds_an_id(spark, tmp_path):
    fact = FactTable(spark, str(tmp_path / "fact"), buckets=4, positions=1 << 16)
    rows = many(spark, 20_000, 0, 1)
    fact.update(rows)
    record = fact.versions.last()
    some = fact.versions.read("rows", ROWS, record).orderBy(F.xxhash64("request_id", F.lit(5))).limit(40)
    holding = {_partition(r) for r in some.select(*BY).collect()}
    maybe = fact._may_hold(record, some)
    assert holding <= maybe and len(maybe) < len(record["tables"]["rows"])
    assert sorted(r.request_id for r in fact.read().select(FACT.names).orderBy("request_id").limit(3).collect()) == ["r0", "r1", "r10"]


def wide_shuffles(plan):
    """Shuffles in an explained plan that carry whole rows, other than the fold by request."""
    inputs = re.findall(r"\) Exchange\nInput \[(\d+)\]: \[(.*)\]", plan)
    return sum(int(n) >= len(FACT.names) or re.search(r"\b(new|old)#", columns) is not None for n, columns in inputs)


def test_a_large_update_shuffles_no_whole_rows_but_those_that_stay(spark, tmp_path, monkeypatch):
    """Most requests change, and nothing is small enough to be broadcast by itself."""
    rng = random.Random(7)
    fact, rows, shuffled = FactTable(spark, str(tmp_path / "fact"), grain="yyyy"), [], []
    parquet = DataFrameWriter.parquet

    def explained(self, path, *args, **options):
        shuffled.append(wide_shuffles(self._df._sc._jvm.PythonSQLUtils.explainString(self._df._jdf.queryExecution(), "formatted")))
        return parquet(self, path, *args, **options)
    monkeypatch.setattr(DataFrameWriter, "parquet", explained)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for day, most in ((1, 0), (2, 1)):
            rows += random_batch(rng, day, 80, 60)
            staged, shuffled[:] = models.stage(with_names(landed(spark, rows))), []
            fact.update(staged)
            assert len(shuffled) > 4 and sum(shuffled) <= most
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert_equal_to_a_rebuild(fact, staged)


def test_rows_of_equal_hashes_are_compared(spark, tmp_path, monkeypatch):
    """Only a status changes, then nothing, then an id is added to a part that is otherwise the same."""
    monkeypatch.setattr(FactTable, "_hash", lambda self: F.lit(0).cast("long"))
    fact = FactTable(spark, str(tmp_path / "fact"))
    rows = [(i, "2024-01-01", "", "2024-07-01", "2024-07-01", "a", "r") for i in ("1", "2")]
    staged = models.stage(landed(spark, rows))
    fact.update(staged)
    changed = staged.withColumn("status", F.when(F.col("request_id") == "2", F.lit("Closed")).otherwise(F.col("status")))
    for _ in range(2):
        fact.update(changed)
        assert_equal_to_a_rebuild(fact, changed)
    assert fact.versions.last()["version"] == 2
    more = changed.unionByName(changed.where("request_id = '1'").withColumn("request_id", F.lit("3")))
    fact.update(more)
    assert_equal_to_a_rebuild(fact, more)


def test_a_swap_with_a_null_is_a_change(spark, tmp_path):
    fact = FactTable(spark, str(tmp_path / "fact"))
    staged = models.stage(landed(spark, [("1", "2024-01-01", "", "2024-07-01", "2024-07-01", "a", "r")]))
    text, none = F.lit("same"), F.lit(None).cast("string")
    for city, street in ((text, none), (none, text)):
        rows = staged.withColumns({"city": city, "street_address": street})
        fact.update(rows)
        assert_equal_to_a_rebuild(fact, rows)


def test_rows_are_written_where_they_are_unless_files_are_many_and_small(spark, tmp_path):
    versions, rows = Versions(spark, str(tmp_path / "t")), spark.range(0, 4000, 1, 20).selectExpr("id", "id % 2 as part")
    for run, frame, most in (("000000000001-few", rows.coalesce(3), 6), ("000000000002-many", rows, 4)):
        assert versions.write_in_place("rows", frame, run, ("part",)) == ["part=0", "part=1"]
        files = list((tmp_path / "t" / "rows" / f"_run={run}").glob("part=*/*.parquet"))
        assert len(files) == most if frame is not rows else len(files) <= most
        assert sorted(versions.read_run("rows", rows.schema, run).collect()) == sorted(rows.collect())
        assert not (tmp_path / "t" / "rows_loose" / f"_run={run}").exists()
