"""Data-quality checks. Each one has failing rows; their number decides.

All checks on a table but uniqueness and reconciliation come from one fold of it: rows are
counted by the few values that matter as values (those outside a list, those in the
future, keys of a parent), with a count for each rule that looks at one row. Folds of
parts of a table add up to the fold of the whole, so a run can keep them and fold only
what it changed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqmill.functions.scalars import hours_later, ratio, to_double, to_timestamp
from reqmill.schema import BOROUGHS, REQUIRED_FIELDS, SOURCE_SYSTEMS, STATUSES

Tables = Mapping[str, DataFrame]


class QualityGateError(RuntimeError):
    pass


# --- failing rows ---------------------------------------------------------

def not_null(column: str) -> Column:
    return F.col(column).isNull()


def not_in_future(column: str, now: Column, grace_hours: int = 24) -> Column:
    return F.col(column) > hours_later(now, grace_hours)


def within_range(column: str, low: float, high: float) -> Column:
    """Outside the closed interval; nulls pass."""
    return (F.col(column) < low) | (F.col(column) > high)


def unflagged_anomaly() -> Column:
    """Closed before created, but not flagged or still with a duration."""
    return (F.col("closed_at") < F.col("created_at")) & (
        ~F.col("has_invalid_timestamps") | F.col("resolution_hours").isNotNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated keys with their number of rows; nulls are ignored."""
    return (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
            .agg(F.count("*").alias("n_records")).where(F.col("n_records") > 1))


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Distinct values outside the list with their number of rows; nulls pass."""
    return (df.where(~F.col(column).isin(list(values)))
            .groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_records")))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child keys without a parent and their number of rows.

    Child rows are folded per key before the join, so a key on a large share of
    the rows is one row of it.
    """
    keys = (child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("from_field"))
            .agg(F.count("*").alias("n_records")))
    return keys.join(parent.select(F.col(field).alias("from_field")), "from_field", "left_anti")


def reconcile(fact: DataFrame, mart: DataFrame, rows: Column | None = None) -> DataFrame:
    """Fact rows and rows the mart accounts for, if they differ. `rows` counts the fact's
    rows where it is given as counts."""
    accounted = mart.agg(F.sum("requests_opened").alias("agg_rows"))
    return (fact.agg((F.count("*") if rows is None else F.coalesce(rows, F.lit(0))).alias("fact_rows"))
            .withColumn("agg_rows", accounted.scalar())
            .where(F.col("fact_rows") != F.col("agg_rows")))


def anomaly_rate(fact: DataFrame) -> DataFrame:
    """One row with the number of anomalies, none if there are none."""
    return (fact.where("has_invalid_timestamps").agg(F.count("*").alias("anomalous_requests"))
            .where(F.col("anomalous_requests") > 0))


# --- the suite ------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    kind: str
    model: str
    column: str = ""
    severity: str = "error"
    bad: Column | None = None                              # row by row
    rows: Callable[[Tables], DataFrame] | None = None      # failing rows of the whole table
    weight: str | None = None                              # rows a failing row stands for
    allowed: Sequence[str] | None = None                   # accepted values
    parent: str | None = None                              # table whose column of that name has the keys
    once: bool = False                                     # any number of bad rows is one failure
    name: str = ""

    @property
    def test(self) -> str:
        return self.name or f"{self.kind}_{self.model}_{self.column}"


def standard_checks(now: Column, models: Mapping[str, str] | None = None) -> list[Check]:
    """The 44 checks on the landing table and the models.

    Fixed values: which checks there are, their limits and their names.
    """
    m = {k: k for k in ("raw", "staged", "dim", "fact", "daily")} | dict(models or {})

    def nn(model, *columns):
        return [Check("not_null", m[model], c, bad=not_null(c)) for c in columns]

    def future(model, *columns):
        return [Check("not_in_future", m[model], c, bad=not_in_future(c, now)) for c in columns]

    def between(model, column, low, high):
        return [Check("within_range", m[model], column, bad=within_range(column, low, high))]

    def values(model, column, allowed, severity="error"):
        return [Check("accepted_values", m[model], column, severity,
                      allowed=allowed,
                      rows=lambda t: accepted_values(t[m[model]], column, allowed))]

    def distinct(model, column):
        return [Check("unique", m[model], column, rows=lambda t: unique(t[m[model]], column))]

    def parent(model, column):
        return [Check("relationships", m[model], column, weight="n_records", parent=m["dim"],
                      rows=lambda t: relationships(t[m[model]], column, t[m["dim"]], column))]

    return [
        *nn("raw", "request_id", "_batch_id"), *values("raw", "_source_system", SOURCE_SYSTEMS),
        *nn("staged", "request_id", "created_at", "agency_code", "complaint_type",
            "source_system", "batch_date"),
        *future("staged", "created_at", "closed_at"),
        *values("staged", "borough", BOROUGHS, "warn"),
        *between("staged", "latitude", 40.4, 41.0), *between("staged", "longitude", -74.3, -73.6),
        *nn("dim", "agency_code", "agency_name", "total_requests"), *distinct("dim", "agency_code"),
        *between("dim", "closure_rate", 0, 1),
        *nn("fact", "request_id", "created_at", "created_date", "agency_code", "complaint_type",
            "is_closed", "has_invalid_timestamps", "source_system", "batch_date"),
        *distinct("fact", "request_id"), *future("fact", "created_at", "closed_at"),
        *parent("fact", "agency_code"), *values("fact", "status", STATUSES, "warn"),
        *values("fact", "source_system", SOURCE_SYSTEMS),
        *between("fact", "resolution_hours", 0, 200000),
        *nn("daily", "created_date", "borough", "agency_code", "requests_opened"),
        *parent("daily", "agency_code"), *between("daily", "closure_rate", 0, 1),
        Check("singular", m["daily"], name="assert_agg_matches_fact_row_count",
              rows=lambda t: reconcile(t[m["fact"]], t[m["daily"]])),
        Check("singular", m["fact"], name="assert_closed_after_created", bad=unflagged_anomaly()),
        Check("singular", m["fact"], name="assert_timestamp_anomaly_rate", severity="warn",
              bad=F.col("has_invalid_timestamps"), once=True, rows=lambda t: anomaly_rate(t[m["fact"]])),
    ]


def failing_rows(check: Check, tables: Tables) -> DataFrame:
    return check.rows(tables) if check.rows else tables[check.model].where(check.bad)


def _labels(check: Check) -> list[Column]:
    return [F.lit(check.test).alias("test"), F.lit(check.kind).alias("type"),
            F.lit(check.model).alias("model"), F.lit(check.severity).alias("severity")]


# --- folds ----------------------------------------------------------------

def _value(check: Check) -> tuple[str, Column] | None:
    """The column of a fold that holds the values a check needs, and null for all others."""
    column = F.col(check.column) if check.column else None
    if check.kind == "not_in_future":
        return f"future_{check.column}", F.when(check.bad, column)
    if check.allowed is not None:
        return f"other_{check.column}", F.when(~column.isin(list(check.allowed)), column)
    if check.parent is not None:
        return f"key_{check.column}", column
    return None


def _of(checks: Sequence[Check], model: str) -> tuple[list[Check], list[Check]]:
    """A table's checks that go by a value, and those that are a rule of one row."""
    mine = [c for c in checks if c.model == model]
    return [c for c in mine if _value(c)], [c for c in mine if c.bad is not None and not _value(c)]


def fold(checks: Sequence[Check], model: str, table: DataFrame, *by: str) -> DataFrame:
    """The table as counts, all that its checks need but for unique and singular rows.
    Few groups, as long as few rows are bad; more bad values are more rows, in any
    number of tasks."""
    by_value, by_row = _of(checks, model)
    return table.groupBy(*by, *[v[1].alias(v[0]) for v in map(_value, by_value)]).agg(
        F.count("*").alias("n"), *[F.count_if(c.bad).alias(c.test) for c in by_row])


def add_up(folds: DataFrame) -> DataFrame:
    """One fold of the folds of parts."""
    values = [c for c in folds.columns if c.startswith(("future_", "other_", "key_"))]
    counts = [c for c in folds.columns if c not in values and not c.startswith("_")]
    return folds.groupBy(*values).agg(*[F.sum(c).alias(c) for c in counts])


def _failed(check: Check, rows: Column) -> Column:
    rows = F.coalesce(rows, F.lit(0)).cast("bigint")
    return (F.least(rows, F.lit(1).cast("bigint")) if check.once else rows).alias("failures")


def _from_fold(checks: Sequence[Check], model: str, folded: DataFrame, tables: Tables, now: Column | None) -> list[DataFrame]:
    by_value, by_row = _of(checks, model)
    if not by_value:  # one row
        return [folded.select(F.inline(F.array(*[F.struct(*_labels(c), _failed(c, F.col(f"`{c.test}`"))) for c in by_row])))]
    measures = [(c, F.coalesce(F.sum(F.col(f"`{c.test}`")), F.lit(0))) for c in by_row]
    for c in by_value:
        value = F.col(_value(c)[0])
        if c.kind == "not_in_future":
            # What was in the future when it was folded may be no more.
            still = value.isNotNull() if now is None else value > hours_later(now, 24)
            measures.append((c, F.coalesce(F.sum(F.when(still, F.col("n"))), F.lit(0))))
    out = []
    if measures:
        totals = folded.agg(*[m.alias(f"m{i}") for i, (_, m) in enumerate(measures)])
        out.append(totals.select(F.inline(F.array(*[
            F.struct(*_labels(c), _failed(c, F.col(f"m{i}"))) for i, (c, _) in enumerate(measures)]))))
    for c in by_value:
        name = _value(c)[0]
        if c.allowed is not None:
            out.append(folded.where(F.col(name).isNotNull()).select(name).distinct().agg(F.count("*").alias("failures"))
                       .select(*_labels(c), "failures"))
        elif c.parent is not None:
            keys = folded.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("key")).agg(F.sum("n").alias("n"))
            orphans = keys.join(tables[c.parent].select(F.col(c.column).alias("key")), "key", "left_anti")
            out.append(orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures")).select(*_labels(c), "failures"))
    return out


def run_checks(checks: Sequence[Check], tables: Tables, folds: Mapping[str, DataFrame] | None = None,
               failing: Mapping[str, DataFrame] | None = None, now: Column | None = None) -> DataFrame:
    """One row per check: failures and status (pass, warn, fail).

    folds are those of tables whose parts were folded before, failing the failing rows of
    checks that are known; other tables are folded and looked through here. `now` is the
    moment that kept folds are judged by.
    """
    folds, failing = folds or {}, failing or {}
    parts = []
    for model in dict.fromkeys(c.model for c in checks):
        if any(_of(checks, model)):
            folded = add_up(folds[model]) if model in folds else fold(checks, model, tables[model])
            parts += _from_fold(checks, model, folded, tables, now)
    for c in checks:
        if c.bad is None and not _value(c):
            total = F.count("*") if c.weight is None else F.coalesce(F.sum(c.weight), F.lit(0))
            rows = failing[c.test] if c.test in failing else c.rows(tables)
            parts.append(rows.agg(total.alias("failures")).select(*_labels(c), "failures"))
    results = reduce(DataFrame.unionByName, parts)
    return results.withColumn(
        "status", F.when(F.col("failures") == 0, "pass")
        .when(F.col("severity") == "warn", "warn").otherwise("fail"))


def summarize(results: DataFrame) -> DataFrame:
    """One row: counts by status, pass rate and the checks that did not pass."""
    def status(s):
        return F.count_if(F.col("status") == s)

    return results.agg(
        F.count("*").alias("tests_total"), status("pass").alias("tests_passed"),
        status("fail").alias("tests_failed"), status("warn").alias("tests_warned"),
        status("error").alias("tests_errored"),
        ratio(status("pass"), F.count("*")).alias("test_pass_rate"),
        F.array_join(F.sort_array(F.collect_list(
            F.when(F.col("status") != "pass", F.col("test")))), ",").alias("failing_tests"))


def not_passing(results: DataFrame) -> DataFrame:
    return results.where(F.col("status") != "pass").select("test", "status", "failures")


def gate(summary: DataFrame) -> None:
    """Raise on failed or errored checks; warnings do not stop a run."""
    s = summary.first()
    if s.tests_failed or s.tests_errored:
        raise QualityGateError(
            f"{s.tests_failed} failed, {s.tests_errored} errored: {s.failing_tests}")


def stage_funnel(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Rows per stage; a missing table counts as -1."""
    spark = next(t for t in tables.values() if t is not None).sparkSession
    parts = []
    for stage, df in tables.items():
        counts = spark.range(1).select(F.lit(-1).cast("bigint").alias("rows")) if df is None \
            else df.agg(F.count("*").alias("rows"))
        parts.append(counts.select(F.lit(stage).alias("stage"), "rows"))
    return reduce(DataFrame.unionByName, parts)


# --- checks on landed strings ---------------------------------------------

def row_checks(landed: DataFrame, now: Column) -> DataFrame:
    """The same guarantees on untyped rows: blanks are missing, and bad rows are
    counted, not bad values.

    The rules are counted in one global aggregate, which moves a row per task. Surplus
    copies are a second one, over the ids alone, folded before they are shuffled.
    """
    created, closed = to_timestamp(F.col("created_at")), to_timestamp(F.col("closed_at"))
    limit = hours_later(now, 24)

    def outside(c, low, high):
        value = to_double(F.col(c))
        return ((value < low) | (value > high)) & ~F.isnan(value)

    borough = F.trim(F.upper(F.coalesce("borough", F.lit(""))))
    backdated = closed < created
    # The names of the checks, those they mirror, and the limits.
    rules = [(f"not_null: {c}", f"not_null_{c}", F.col(c).isNull() | (F.col(c) == ""), "")
             for c in REQUIRED_FIELDS]
    rules += [
        ("not_in_future: created_at", "not_in_future_created_at", created > limit, ""),
        ("not_in_future: closed_at", "not_in_future_closed_at", closed > limit, ""),
        ("within_range: latitude", "within_range_latitude",
         outside("latitude", 40.4, 41.0), "expected 40.4 to 41.0"),
        ("within_range: longitude", "within_range_longitude",
         outside("longitude", -74.3, -73.6), "expected -74.3 to -73.6"),
        ("accepted_values: borough", "accepted_values_borough", ~borough.isin(BOROUGHS + [""]), ""),
        ("closed_at is never before created_at", "assert_closed_after_created", backdated, ""),
    ]
    copies = landed.groupBy("request_id").agg((F.count("*") - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)))
    totals = landed.agg(*[F.count_if(bad).alias(f"c{i}") for i, (_, _, bad, _) in enumerate(rules)]).withColumn(
        "dup", copies.scalar())
    counted = [(name, mirrors, f"c{i}", detail) for i, (name, mirrors, _, detail) in enumerate(rules)]
    counted.append(("unique: request_id", "unique_fct_request_id", "dup", ""))
    out = [F.struct(F.lit(name).alias("check"), F.lit(mirrors).alias("mirrors"),
                    F.col(c).alias("failures"), F.lit(detail).alias("detail"))
           for name, mirrors, c, detail in counted]
    backdated_row = F.col("mirrors") == "assert_closed_after_created"
    return totals.select(F.inline(F.array(*out))).select(
        "check", "mirrors", "failures",
        (backdated_row | (F.col("failures") == 0)).alias("passed"),
        F.when(backdated_row & (F.col("failures") > 0), F.format_string(
            "%d row(s) quarantined: flagged, without a duration", "failures"))
        .when(backdated_row, "no such row").otherwise(F.col("detail")).alias("detail"))
