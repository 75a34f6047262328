"""Column functions shared by the models, checks and reports.

Timestamps are zone-free (TIMESTAMP_NTZ), as in the source data, so no result
depends on the session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# A date, alone or followed by at least hours and minutes. Spark would also read
# '2024', '2024-01' and '2024-01-15 10'.
_TIMESTAMP_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}($|[ T]\d{1,2}:\d{1,2})"


def text(c: Column) -> Column:
    """Trimmed, blank to null."""
    return F.nullif(F.trim(c), F.lit(""))


def code(c: Column) -> Column:
    """Trimmed and upper-cased; a blank stays a blank."""
    return F.upper(F.trim(c))


def upper_text(c: Column) -> Column:
    return F.upper(text(c))


def to_timestamp(c: Column) -> Column:
    value = text(c)
    return F.when(value.rlike(_TIMESTAMP_SHAPE), value.try_cast("timestamp_ntz"))


def to_double(c: Column) -> Column:
    value = text(c)
    # Java number suffixes, which Spark accepts: '1.0d', '1f'.
    suffixed = (F.substring(value, -1, 1).isin("d", "D", "f", "F")
                & ~F.endswith(F.lower(value), F.lit("inf")))
    return F.when(~suffixed, value.try_cast("double"))


def ntz(value: dt.datetime | dt.date | str) -> Column:
    """A literal zone-free timestamp."""
    return F.lit(str(value)).cast("timestamp_ntz")


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed, fractions ignored."""
    days = F.date_diff(F.to_date(end), F.to_date(start)).cast("bigint")
    return days * 86400 + (_second_of_day(end) - _second_of_day(start))


def hours_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(3600.0)


def round_half(c: Column, digits: int) -> Column:
    """Scale, round half away from zero, scale back, all in double.

    `round(x, n)` rounds the decimal rendering instead and differs in the last
    digit for about one value in two thousand.
    """
    scale = F.lit(float(10 ** digits))
    return F.round(c * scale) / scale


def ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    """part / whole to `digits` places, null when whole is 0."""
    return round_half(part.cast("double") / F.nullif(whole, F.lit(0)), digits)


def hours_later(ts: Column, hours: int) -> Column:
    return ts + F.make_dt_interval(hours=F.lit(hours))


def dotted_part(c: Column, index: int = 2) -> Column:
    """Element of a dotted name, the whole name if it is too short."""
    return F.coalesce(F.get(F.split(c, r"\."), F.lit(index)), c)


def confidence_bucket(field: Column, confidence: Column) -> Column:
    conf = F.coalesce(confidence, F.lit(0.0))
    return (F.when(F.coalesce(field, F.lit("")) == "", CONFIDENCE_BUCKETS[3])
            .when(conf >= 1.0, CONFIDENCE_BUCKETS[0])
            .when(conf >= 0.90, CONFIDENCE_BUCKETS[1])
            .otherwise(CONFIDENCE_BUCKETS[2]))


# Labels of the confidence report. The third takes every mapped
# value below 0.90.
CONFIDENCE_BUCKETS = ["1.00 (exact/override)", "0.90-0.99", "0.82-0.89",
                      "below threshold (unmapped)"]


def batch_dates(first: dt.date, days: int) -> list[dt.date]:
    """`days` consecutive dates from `first`."""
    return [first + dt.timedelta(days=i) for i in range(days)]


def approx_median(c: Column) -> Column:
    """Single-pass median for groups where an estimate is enough."""
    return F.percentile_approx(c, 0.5)
