"""The fact and its marts, brought up to date by what changed.

Rows lie in partitions by the period of creation and a hash of the request id. A record
of each partition says its rows and their first and last creation date, and a bitmap for
each says which hashes of ids it may hold. So an update reads only the partitions that
can hold one of its ids, and rewrites only those that lose or gain a row.

What changes is a table of images: the row of a request before and after. The daily mart
is kept as counted cells, from which medians and distinct counts are read; before-images
count as -1 and after-images as +1, so only cells of changed rows are touched and only
their periods' cells are read. The agency table is kept as counts per period, code and
name in the same way; a first or last date is looked up again only in the periods where
the row that held it went.

The quality checks go the same way: a fold (operators/checks.py) is kept for each
partition, and ids are looked for a second time only if their request changed.

Rows, bitmaps, cells, folds and marts are committed in one record (sources/versions.py): they
agree with each other whatever dies in between, and no image is ever counted twice.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqmill.operators import checks as Q
from reqmill.plans import models
from reqmill.plans.models import FIRST_DATE
from reqmill.schema import FACT_COLUMNS
from reqmill.sources.versions import Versions

BY = ("_period", "_bucket")


def _type(text: str) -> T.StructType:
    """Without a session, so that schemas can be constants."""
    names = {"int": "integer", "bigint": "long"}
    schema = T.StructType()
    for column in text.split(", "):
        name, kind = column.split()
        schema.add(name, names.get(kind, kind))
    return schema


FACT = _type(FACT_COLUMNS)
ROWS = _type(f"{FACT_COLUMNS}, agency_name string, _period string, _bucket int")
REPEATS = _type("unique_field string, n_records bigint")
KEYS = _type("word long, bits binary, _period string, _bucket int")
HITS = _type("_file string, word long, bits binary, n bigint, same bigint, _period string, _bucket int")
CELLS = _type("created_date date, borough string, agency_code string, by_type boolean, complaint_type string, "
              "hours double, n bigint, closed bigint, _period string")
DAILY = _type("created_date date, borough string, agency_code string, requests_opened bigint, requests_closed bigint, "
              "closure_rate double, avg_resolution_hours double, median_resolution_hours double, "
              "max_resolution_hours double, distinct_complaint_types bigint, _period string")
NAMES = _type("agency_code string, agency_name string, n bigint, closed bigint, first timestamp_ntz, last timestamp_ntz, _period string")


# Bitmaps of rows that are sent to all executors.
BITMAP_BYTES = 128 << 20


def _is_set(position: str) -> str:
    """SQL that says if `bits` has that position."""
    return (f"shiftright(cast(conv(hex(substring(bits, cast({position} div 8 as int) + 1, 1)), 16, 10) as int), "
            f"cast({position} % 8 as int)) & 1 = 1")


def _partition(row) -> str:
    return f"_period={row['_period']}/_bucket={row['_bucket']}"


def _period(partition: str) -> str:
    return partition.split("/")[0]


class FactTable:
    """`grain` is the format of the creation date that names a period, a month or a year;
    `buckets` are the parts of a period, and `positions` those of the bitmap of one part:
    about sixteen a row let few other ids look as if they were there. All three go by how
    many rows a period has, and stay as they are for the life of a table."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 1, positions: int = 1 << 20, checks: Sequence[Q.Check] = (),
                 grain: str = "yyyy-MM"):
        self.spark, self.versions = spark, Versions(spark, path)
        self.buckets, self.positions = buckets, positions
        self.grain = grain
        self.checks = [c for c in checks if c.model == "fact"]

    # What is there.

    def read(self) -> DataFrame | None:
        """The fact, or None before the first update."""
        record = self.versions.last()
        return None if record is None else self.versions.read("rows", ROWS, record).select(FACT.names)

    def daily(self) -> DataFrame:
        return self.versions.read("daily", DAILY, self.versions.last()).drop("_period")

    def agencies(self) -> DataFrame:
        return models.agency_totals(self.versions.read("names", NAMES, self.versions.last()).drop("_period"))

    def folds(self) -> DataFrame:
        """Folds of the checks on the fact, one for each partition."""
        record = self.versions.last()
        tables = (record or {"tables": {}})["tables"]
        schema = Q.fold(self.checks, "fact", self.spark.createDataFrame([], ROWS), *BY).schema
        kept = self.versions.read("folds", schema, record)
        # Partitions of a time without checks are folded now.
        lacking = set(tables.get("rows", {})) - set(tables.get("folds", {}))
        return kept.unionByName(Q.fold(self.checks, "fact", self.versions.read("rows", ROWS, record, lacking), *BY)) if lacking else kept

    def repeated(self) -> DataFrame:
        """Ids that are there more than once, and how often."""
        return self.versions.read("repeats", REPEATS, self.versions.last())

    def mark(self) -> dt.date:
        """Newest batch date the fact has taken in."""
        record = self.versions.last()
        return FIRST_DATE if record is None else dt.date.fromisoformat(record["mark"])

    # Changing it.

    def _period_of(self) -> Column:
        return F.coalesce(F.date_format("created_date", self.grain), F.lit("none"))

    def _placed(self, requests: DataFrame, record: dict) -> DataFrame:
        return (models.build_fact(requests, extra=("agency_name",))
                .withColumn("_period", self._period_of())
                .withColumn("_bucket", F.pmod(F.xxhash64("request_id"), F.lit(record["buckets"])).cast("int"))
                .select(ROWS.names))

    def _position(self, record: dict) -> Column:
        return F.pmod(F.xxhash64("request_id", F.lit(1)), F.lit(record["positions"])) + 1

    def full_refresh(self, staged: DataFrame) -> None:
        """Build everything from all landed rows."""
        before = self.versions.last()
        record = {"mark": FIRST_DATE.isoformat(), "buckets": self.buckets, "positions": self.positions, "parts": {}}
        run = self.versions.begin(before)
        rows = self._placed(models.deduplicate(staged), record)
        parts = self.versions.write_in_place("rows", rows, run, BY)
        written = {"rows": parts} | self._described(record, run)
        fact = self.versions.read_run("rows", ROWS, run)
        cells = models.daily_cells(fact).withColumn("_period", self._period_of())
        written["cells"] = self.versions.write("cells", cells.select(CELLS.names), run, ("_period",))
        written["daily"] = self._write_daily(run)
        names = models.name_counts(fact, "_period")
        written["names"] = self.versions.write("names", names.select(NAMES.names), run, ("_period",))
        written["repeats"] = self.versions.write("repeats", Q.unique(fact, "request_id"), run)
        gone = {} if before is None else {t: list(p) for t, p in before["tables"].items()}
        self._commit(before, run, written, gone, record)

    def update(self, staged: DataFrame, reprocess_from: dt.date | None = None) -> None:
        """Bring in batches from the mark on; build the fact if there is none.

        Batches below the mark are skipped, as a late batch is by default; name
        its date in `reprocess_from` to include it.
        """
        before = self.versions.last()
        if before is None:
            self.full_refresh(staged)
            return
        since = reprocess_from or dt.date.fromisoformat(before["mark"])
        run = self.versions.begin(before)
        came = self.versions.write_in_place("rows", self._placed(models.changed_requests(staged, since), before), run, BY)
        incoming = {"tables": {"rows": dict.fromkeys(came, run)}}
        hits, touched = self._changes(before, incoming, run)
        self.versions.drop("rows", run, set(came) - touched if touched else None)
        if not touched:
            return
        # The files of a frame are those at the time it is made: rows that stay are no part of it.
        new = self.versions.read("rows", ROWS, incoming, touched)
        changed = new.select("request_id")
        rows = self._marked(before, hits, touched)
        old, stay = rows.where("_hit").select(ROWS.names), rows.where("not _hit").select(ROWS.names)
        record = {k: before[k] for k in ("mark", "buckets", "positions", "parts")}
        written = {"rows": self.versions.write("rows", stay, run, BY, "append")}
        written |= self._described(record, run)
        gone = [p for p in touched if p not in written["rows"]]
        for p in gone:
            record["parts"].pop(p, None)
        months = {_period(p) for p in touched}
        written["cells"] = self._write_cells(before, run, old, new, months)
        written["daily"] = self._write_daily(run) if written["cells"] else []
        written["names"] = self._write_names(before, run, old, new, months, written["rows"], gone)
        written["repeats"] = self._write_repeats(before, run, changed, written, gone)
        removed = {"rows": gone, "keys": gone, "folds": gone} | {t: sorted(months) for t in ("cells", "daily", "names")}
        self._commit(before, run, written, removed, record)

    def _commit(self, before: dict | None, run: str, written: dict, removed: dict, record: dict) -> None:
        self.versions.commit(before, run, written, removed, record)
        self._remove_old()

    def _remove_old(self) -> None:
        self.versions.remove_old()

    def _changes(self, before: dict, incoming: dict, run: str) -> tuple[DataFrame, set[str]]:
        """Which old rows the incoming ones take the place of, as bitmaps of their places in
        their files, and the parts where a row is not what it was.

        Incoming rows lie where they will be read from and old ones are filtered where they
        are: what is shuffled of a row is its id, its place and a hash of it. Rows that
        are the same before and after cancel out in the marts, so it only matters whether
        all of a part's are: then rows are compared, not hashes.
        """
        rows = self.versions.read("rows", ROWS, incoming, set(incoming["tables"]["rows"]))
        ids = rows.select(F.col("request_id").alias("_id"))
        same = F.col("request_id").eqNullSafe(F.col("_id"))
        # First the parts that may hold one of the ids by their bitmaps, then those that
        # do by their ids alone, then the rows.
        maybe = self._may_hold(before, rows)
        holding = (self.versions.read("rows", ROWS, before, maybe).select("request_id", *BY)
                   .join(ids, same, "left_semi").select(*BY).distinct().collect())  # as many as parts at most
        old = self.versions.read_places("rows", ROWS, before, {_partition(r) for r in holding}).select(
            "request_id", *BY, self._hash().alias("_hash"), "_file", (F.col("_row") + 1).alias("_at"))
        new = rows.select(F.col("request_id").alias("_id"), self._hash().alias("_new"))
        hits = (old.join(new, same).groupBy(*BY, "_file", F.bitmap_bucket_number("_at").alias("word"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("bits"), F.count("*").alias("n"),
                     F.count_if(F.col("_hash") == F.col("_new")).alias("same")))
        self.versions.write("hits", hits.select(HITS.names), run)
        hits = self.versions.read_run("hits", HITS, run)
        arrived = {_partition(r): r["n"] for r in rows.groupBy(*BY).agg(F.count("*").alias("n")).collect()}
        left = {_partition(r): (r["n"], r["same"]) for r in hits.groupBy(*BY).agg(F.sum("n").alias("n"), F.sum("same").alias("same")).collect()}
        parts = {*arrived, *left}
        touched = {p for p in parts if left.get(p) != (arrived.get(p),) * 2}
        if alike := parts - touched:
            was = self._marked(before, hits, alike).where("_hit").select(ROWS.names)
            other = self.versions.read("rows", ROWS, incoming, alike).subtract(was)
            touched |= {_partition(r) for r in other.select(*BY).distinct().collect()}
        return hits, touched

    def _hash(self) -> Column:
        """Of a whole row, with its part and with which of its values are null."""
        nulls = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in ROWS.names])
        return F.xxhash64(nulls, *ROWS.names)

    def _marked(self, before: dict, hits: DataFrame, partitions: set[str]) -> DataFrame:
        """The rows of these parts as they were, and in `_hit` whether another has come for
        their request."""
        rows = self.versions.read_places("rows", ROWS, before, partitions).withColumn("_at", F.col("_row") + 1)
        rows = rows.withColumns({"word": F.bitmap_bucket_number("_at"), "_bit": F.bitmap_bit_position("_at")})
        bits = hits.select("_file", "word", "bits")
        # A bit for each row of the parts, whose rows are known.
        if sum(before["parts"][p][0] for p in partitions if p in before["parts"]) < 8 * BITMAP_BYTES:
            bits = F.broadcast(bits)
        return rows.join(bits, ["_file", "word"], "left").withColumn("_hit", F.coalesce(F.expr(_is_set("_bit")), F.lit(False)))

    def _may_hold(self, before: dict, incoming: DataFrame) -> set[str]:
        """The parts whose bitmap has the position of one of the ids."""
        position = self._position(before)
        asked = (incoming.select("_bucket", F.bitmap_bucket_number(position).alias("word"), F.bitmap_bit_position(position).alias("bit"))
                 .groupBy("_bucket", "word").agg(F.collect_set("bit").alias("_bits")))  # 32,768 at most
        has = F.expr(f"exists(_bits, p -> {_is_set('p')})")
        hits = self.versions.read("keys", KEYS, before).join(asked, ["_bucket", "word"]).where(has).select(*BY).distinct()
        return {_partition(r) for r in hits.collect()}

    def _described(self, record: dict, run: str) -> dict[str, list[str]]:
        """Write the bitmaps of the parts that the run wrote; take their rows, first and
        last creation date and the mark into the record."""
        rows = self.versions.read_run("rows", ROWS, run).select("request_id", "created_date", "batch_date", *BY)
        stats = rows.groupBy(*BY).agg(F.count("*").alias("rows"), F.min("created_date").alias("first"),
                                      F.max("created_date").alias("last"), F.max("batch_date").alias("mark")).collect()
        for r in stats:
            record["parts"][_partition(r)] = [r.rows, *(None if d is None else d.isoformat() for d in (r["first"], r["last"]))]
        record["mark"] = max([record["mark"], *(r.mark.isoformat() for r in stats if r.mark)])
        position = self._position(record)
        keys = (rows.select(*BY, F.bitmap_bucket_number(position).alias("word"), F.bitmap_bit_position(position).alias("bit"))
                .groupBy(*BY, "word").agg(F.bitmap_construct_agg("bit").alias("bits")))
        written = {"keys": self.versions.write("keys", keys.select(KEYS.names), run, BY)}
        if self.checks:
            fact = self.versions.read_run("rows", ROWS, run)
            written["folds"] = self.versions.write("folds", Q.fold(self.checks, "fact", fact, *BY), run, BY)
        return written

    def _write_repeats(self, before: dict, run: str, changed: DataFrame, written: dict, gone: list[str]) -> list[str]:
        """The ids that are there more than once: those known of requests that have not
        changed, and those of changed requests, looked for where they may be."""
        after = {"tables": {t: {p: r for p, r in {**before["tables"].get(t, {}), **dict.fromkeys(written[t], run)}.items() if p not in gone}
                            for t in ("rows", "keys")}}
        ids = changed.where("request_id is not null").withColumn("_bucket", F.pmod(F.xxhash64("request_id"), F.lit(before["buckets"])).cast("int"))
        inside = self._may_hold(before | after, ids)
        found = self.versions.read("rows", ROWS, after, inside).join(ids.select("request_id"), "request_id", "left_semi")
        known = self.versions.read("repeats", REPEATS, before).join(
            ids.select(F.col("request_id").alias("unique_field")), "unique_field", "left_anti")
        return self.versions.write("repeats", Q.unique(found, "request_id").unionByName(known), run)

    # The marts.

    def _write_cells(self, before: dict, run: str, old: DataFrame, new: DataFrame, months: set[str]) -> list[str]:
        """Cells of these months with the images counted in."""
        signed = new.withColumn("_sign", F.lit(1)).unionByName(old.withColumn("_sign", F.lit(-1)))
        change = models.daily_cells(signed, F.col("_sign")).withColumn("_period", self._period_of())
        cells = (self.versions.read("cells", CELLS, before, months).unionByName(change.select(CELLS.names))
                 .groupBy([c for c in CELLS.names if c not in ("n", "closed")])
                 .agg(F.sum("n").alias("n"), F.sum("closed").alias("closed")).where("n > 0"))
        return self.versions.write("cells", cells.select(CELLS.names), run, ("_period",))

    def _write_daily(self, run: str) -> list[str]:
        daily = models.daily_from_cells(self.versions.read_run("cells", CELLS, run).drop("_period"))
        return self.versions.write("daily", daily.withColumn("_period", self._period_of()).select(DAILY.names), run, ("_period",))

    def _write_names(self, before: dict, run: str, old: DataFrame, new: DataFrame, months: set[str],
                     written: list[str], gone: list[str]) -> list[str]:
        """Counts of these months with the images counted in, and first and last dates."""
        key = ["_period", "agency_code", "agency_name"]
        signed = new.withColumn("_sign", F.lit(1)).unionByName(old.withColumn("_sign", F.lit(-1)))
        # A date that one row loses and another gains is not lost.
        net = signed.groupBy(*key, "created_at").agg(
            F.sum("_sign").alias("n"), F.sum(F.when(F.col("closed_at").isNotNull(), F.col("_sign")).otherwise(0)).alias("closed"))
        lost, won = F.when(F.col("n") < 0, F.col("created_at")), F.when(F.col("n") > 0, F.col("created_at"))
        change = net.groupBy(*key).agg(
            F.sum("n").alias("n"), F.sum("closed").alias("closed"), F.min(won).alias("first"), F.max(won).alias("last"),
            F.min(lost).alias("lost_first"), F.max(lost).alias("lost_last"))
        state = self.versions.read("names", NAMES, before, months)
        none = F.lit(None).cast("timestamp_ntz")
        merged = (state.withColumns({"lost_first": none, "lost_last": none}).unionByName(change, allowMissingColumns=True)
                  .groupBy(*key).agg(F.sum("n").alias("n"), F.sum("closed").alias("closed"), F.min("first").alias("first"),
                                     F.max("last").alias("last"), F.min("lost_first").alias("lost_first"), F.max("lost_last").alias("lost_last"))
                  .where("n > 0"))
        open_end = F.coalesce((F.col("lost_first") <= F.col("first")) | (F.col("lost_last") >= F.col("last")), F.lit(False))
        self.versions.write("merged", merged.withColumn("open_end", open_end), run)
        merged = self.versions.read_run("merged", T.StructType([*NAMES, T.StructField("open_end", T.BooleanType())]), run)
        again = {r["_period"] for r in merged.where("open_end").select("_period").distinct().collect()}
        if again:
            inside = {p for p in {*before["tables"].get("rows", {}), *written} if _period(p)[len("_period="):] in again} - set(gone)
            after = {"tables": {"rows": {**before["tables"].get("rows", {}), **dict.fromkeys(written, run)}}}
            dates = (self.versions.read("rows", ROWS, after, inside).groupBy(*key)
                     .agg(F.min("created_at").alias("_first"), F.max("created_at").alias("_last")))
            same = [F.col(f"m.{c}").eqNullSafe(F.col(f"d.{c}")) for c in key]
            merged = (merged.alias("m").join(dates.alias("d"), same, "left")
                      .select(*(F.when(F.col("open_end"), F.col(f"d._{c}")).otherwise(F.col(f"m.{c}")).alias(c) if c in ("first", "last")
                                else F.col(f"m.{c}") for c in NAMES.names)))
        return self.versions.write("names", merged.select(NAMES.names), run, ("_period",))
