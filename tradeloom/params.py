"""Periods, defaults and the fixed rule values of the analytics."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Period:
    """Inclusive date window.

    Bounds are dates: on a timestamp column a row after 00:00 of the last day lies outside.
    """

    start: date
    end: date

    @classmethod
    def of(cls, start: str, end: str) -> Period:
        return cls(date.fromisoformat(start), date.fromisoformat(end))

    @classmethod
    def last(cls, days: int, today: date) -> Period:
        return cls(today - timedelta(days=days), today)

    @property
    def days(self) -> int:
        return (self.end - self.start).days + 1

    @property
    def previous(self) -> Period:
        """The window of equal length that ends the day before this one starts."""
        return Period(self.start - timedelta(days=self.days), self.start - timedelta(days=1))

    def holds(self, clock: Column) -> Column:
        return clock.between(F.lit(self.start), F.lit(self.end))


@dataclass(frozen=True)
class QueryParams:
    """The knobs a user may set; a filter left at None is off."""

    period: Period
    top_n: int = 10
    time_resolution: str | None = None
    categories: tuple[str, ...] | None = None
    channels: tuple[str, ...] | None = None

    def with_period(self, start: str | None = None, end: str | None = None) -> QueryParams:
        """Explicit dates win over those already set."""
        period = Period(
            date.fromisoformat(start) if start else self.period.start,
            date.fromisoformat(end) if end else self.period.end,
        )
        return replace(self, period=period)


# Default window lengths, rank cut-offs and selectable presets.
DASHBOARD_DAYS = 90
HISTORY_DAYS = 365
PRESET_DAYS = (30, 90, 180, 365)
DASHBOARD_TOP_N = {"buyer": 10, "seller": 20}
HISTORY_TOP_N = {"buyer": 20, "seller": 30}
HISTORY_TIME_RESOLUTION = {"buyer": None, "seller": "month"}
ENTITY_TYPES = ("buyer", "seller")

# Priority thresholds in percent, insight counts and validation limits.
HIGH_SELF, HIGH_BENCHMARK = 30, 50
MEDIUM_SELF, MEDIUM_BENCHMARK = 15, 25
OUTLIER_Z = 2
TARGET_INSIGHTS = 6
PRIORITIES = ("high", "medium", "low")
COMPARISONS = ("self", "benchmark", "both")
TITLE_LENGTH = (10, 100)
MIN_OBSERVATION_LENGTH = 20
MIN_RECOMMENDATION_LENGTH = 20
MAX_METRICS = 5


def check_entity_type(entity_type: str) -> str:
    if entity_type not in ENTITY_TYPES:
        raise ValueError(f"entity type must be one of {ENTITY_TYPES}, got {entity_type!r}")
    return entity_type


def dashboard_params(
    entity_type: str,
    today: date,
    days: int | None = None,
    start: str | None = None,
    end: str | None = None,
    top_n: int | None = None,
) -> QueryParams:
    """Current-period parameters: explicit dates win over `days`, which wins over the default."""
    check_entity_type(entity_type)
    base = QueryParams(Period.last(days or DASHBOARD_DAYS, today), top_n or DASHBOARD_TOP_N[entity_type])
    return base.with_period(start, end)


def history_params(entity_type: str, today: date) -> QueryParams:
    check_entity_type(entity_type)
    return QueryParams(
        Period.last(HISTORY_DAYS, today), HISTORY_TOP_N[entity_type], HISTORY_TIME_RESOLUTION[entity_type]
    )
