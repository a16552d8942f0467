"""Calendar buckets and their labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeloom.params import Period

# How many months the buckets of a calendar lie apart.
CALENDAR_MONTHS = {"month": 1, "quarter": 3}


RESOLUTIONS = ("day", "week", "month", "quarter", "year")


def bucket(clock: Column, resolution: str) -> Column:
    """First day of the day, ISO week, month, quarter or year that holds the clock value."""
    if resolution not in RESOLUTIONS:
        raise ValueError(f"time resolution must be one of {RESOLUTIONS}, got {resolution!r}")
    day = clock.cast("date")
    return day if resolution == "day" else F.trunc(day, resolution)


def calendar(first: Column, last: Column, resolution: str) -> Column:
    """Array of all bucket starts from the bucket of `first` to that of `last`."""
    step = F.make_ym_interval(F.lit(0), F.lit(CALENDAR_MONTHS[resolution]))
    return F.sequence(bucket(first, resolution), bucket(last, resolution), step)


def period_calendar(period: Period, resolution: str) -> Column:
    return calendar(F.lit(period.start), F.lit(period.end), resolution)


def day_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def week_label(day: Column) -> Column:
    week = F.lpad(F.weekofyear(day).cast("string"), 2, "0")
    return F.concat(day_label(day), F.lit(" (Week "), week, F.lit(")"))


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def quarter_label(day: Column) -> Column:
    return F.date_format(day, "QQQ yyyy")


def period_label(day: Column, resolution: str) -> Column:
    """Label of a time-series bucket; resolutions without a label format give NULL."""
    labels = {"day": day_label, "week": week_label, "month": month_label}
    return labels[resolution](day) if resolution in labels else F.lit(None).cast("string")
