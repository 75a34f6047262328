"""A range of days at once against one run for each day."""

import datetime as dt
import random

from pyspark.sql import functions as F

from reqmill.plans import backfill, models
from reqmill.plans.fact_table import FactTable
from test_fact_table import rows_of, with_names
from test_models import landed


def landings(seed=4):
    """Rows of nine batch days; some arrive in a batch after a newer one of their request."""
    rng, rows = random.Random(seed), []
    for i in range(400):
        day = rng.choice([1, 2, 3, 5, 6, 7, 8, 9])
        request = "hot" if rng.random() < 0.3 else str(rng.randint(0, 70))
        rows.append((request, rng.choice(["", f"2024-06-{rng.randint(1, 9):02d}T01:00:00"]), rng.choice(["", "2024-06-20"]),
                     f"2024-07-{day:02d}", f"2024-07-{rng.randint(1, day):02d}T0{rng.randint(0, 9)}:00:00", "a", f"r{i}"))
    return rows


def test_every_day_equals_its_own_run(spark):
    staged = models.stage(with_names(landed(spark, landings()))).cache()
    first, days = dt.date(2024, 7, 3), 5
    history = backfill.fact_versions(staged, first, days).cache()
    funnel = {(r.batch_date, r.stage): r.rows for r in backfill.funnel_by_day(staged, history, first, days).collect()}
    assert len(funnel) == 6 * days
    for day in (first + dt.timedelta(days=k) for k in range(days)):
        landed_by = staged.where(F.col("batch_date") <= F.lit(day))
        deduped = models.deduplicate(landed_by)
        fact = models.build_fact(deduped)
        assert rows_of(backfill.as_of(history, F.lit(day))) == rows_of(fact)
        want = {"1_landed": landed_by, "2_staged": landed_by, "3_deduped": deduped, "4_fact": fact,
                "5_daily_mart": models.daily_sla(fact), "5_agency_dim": models.agency_dimension(deduped)}
        assert {s: funnel[day, s] for s in want} == {s: df.count() for s, df in want.items()}


def test_daily_updates_end_where_the_backfill_does(spark, tmp_path):
    """One update for each day against one pass, where every batch is newer than those before."""
    rows = [(r, c, e, b, b + i[10:], s, n) for r, c, e, b, i, s, n in landings(8)]
    staged = models.stage(with_names(landed(spark, rows))).cache()
    fact = FactTable(spark, str(tmp_path / "fact"), buckets=2)
    days = [dt.date(2024, 7, k) for k in range(1, 5)]
    history = backfill.fact_versions(staged, days[0], len(days)).cache()
    for day in days:
        fact.update(staged.where(F.col("batch_date") <= F.lit(day)))
        assert rows_of(fact.read()) == rows_of(backfill.as_of(history, F.lit(day)))


def test_days_without_batches_and_empty_landings(spark):
    staged = models.stage(landed(spark, landings()))
    quiet = backfill.fact_versions(staged, dt.date(2025, 1, 1), 3)
    counts = backfill.funnel_by_day(staged, quiet, dt.date(2025, 1, 1), 3).collect()
    assert {r.rows for r in counts if r.stage == "1_landed"} == {400} and len(counts) == 18
    none = models.stage(landed(spark, []))
    empty = backfill.funnel_by_day(none, backfill.fact_versions(none, dt.date(2025, 1, 1), 2), dt.date(2025, 1, 1), 2).collect()
    assert {r.rows for r in empty} == {0} and len(empty) == 12
