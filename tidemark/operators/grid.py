"""The metric grid: one measurement time every ``step_days`` from the first event's date.

An event at time ``t`` lies in the look-back window ``[m - N days, m)`` of a grid
time ``m`` exactly when its *day* lies in ``[m - N, m - 1]``, because grid times are
midnights. Counting days from the first day of the log, the grid positions that see
an event on day ``x`` are therefore the whole range

    x // step + 1   ...   (x + N) // step

so "which windows contain this event" is integer arithmetic, and no join is needed.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import as_timestamp, timestamp_literal
from tidemark.spec import ChurnSpec


MANDATORY = ("account_id", "event_time", "event_type")


def unless_null(value: Column) -> Column:
    """An aggregate over the log that fails the job if a mandatory value is missing anywhere."""
    nulls = sum((F.count_if(F.col(c).isNull()) for c in MANDATORY), F.lit(0))
    return F.when(nulls > 0, F.raise_error(F.lit(f"event log: NULL values where none may be: {', '.join(MANDATORY)}"))).otherwise(value)


def complete(events: DataFrame) -> Column:
    """A scalar subquery that is true, or fails the job if a mandatory value is missing. It leaves filters on the log alone."""
    return events.agg(unless_null(F.lit(True)).alias("complete")).scalar()


def log_bounds(events: DataFrame) -> DataFrame:
    """One row: date of the first and of the last event (NULLs for an empty log). A missing mandatory value fails the job."""
    return events.agg(
        unless_null(F.to_date(F.min("event_time"))).alias("first_day"),
        unless_null(F.to_date(F.max("event_time"))).alias("last_day"),
    )


def checked_bounds(events: DataFrame) -> tuple[dt.date | None, dt.date | None, int]:
    """The bounds and the number of events, after making sure in the same job that no mandatory value is missing.

    The check is not part of later plans, so their filters still reach the scan.
    """
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in MANDATORY]
    bounds = F.to_date(F.min("event_time")).alias("a"), F.to_date(F.max("event_time")).alias("b")
    row = events.agg(*bounds, F.count(F.lit(1)).alias("n"), *nulls).first()
    missing = [f"{row[c]} in {c}" for c in MANDATORY if row[c]]
    if missing:
        raise ValueError(f"event log: NULL values where none may be: {', '.join(missing)}")
    return row["a"], row["b"], row["n"]


@dataclass(frozen=True)
class Grid:
    """Where the grid of one event log lies.

    The two dates are fetched once (a one-row aggregate, which also checks for missing values) and
    enter every plan as literals, so time filters reach the scan and prune files.
    Build it once per log and pass it on.
    """

    origin: dt.date
    last_position: int
    step_days: int
    #: How large the log is; decides on the number of tasks only.
    n_events: int = 0

    @classmethod
    def of(cls, events: DataFrame, spec: ChurnSpec) -> Grid:
        first, last, n = checked_bounds(events)
        if first is None:
            return cls(dt.date(1970, 1, 1), -1, spec.step_days)
        return cls(first, (last - first).days // spec.step_days, spec.step_days, n)

    @property
    def is_empty(self) -> bool:
        return self.last_position < 0

    def time(self, position: int) -> dt.datetime:
        return dt.datetime.combine(self.origin, dt.time()) + dt.timedelta(days=position * self.step_days)

    @property
    def end(self) -> Column:
        """Events from here on are seen by no grid time."""
        return timestamp_literal(self.time(self.last_position))

    def day(self, t: Column) -> Column:
        return F.datediff(F.to_date(t), F.lit(self.origin))

    def first_seen(self, t: Column) -> Column:
        return self._whole(self.day(t)) + 1

    def last_seen(self, t: Column, lookback_days: int) -> Column:
        """Not clipped to the end of the grid."""
        return self._whole(self.day(t) + lookback_days)

    def time_at(self, position: Column) -> Column:
        return as_timestamp(F.date_add(F.lit(self.origin), (position * self.step_days).cast("int")))

    def position_of(self, day: dt.date) -> int:
        """The last grid position not after ``day`` (negative before the grid)."""
        return min((day - self.origin).days // self.step_days, self.last_position)

    def _whole(self, days: Column) -> Column:
        return F.floor(days / F.lit(self.step_days)).cast("int")


def metric_grid(events: DataFrame, spec: ChurnSpec) -> DataFrame:
    """``metric_time``: every grid time, no row for an empty log."""
    days = F.sequence("first_day", "last_day", F.expr(f"interval {spec.step_days} day"))
    return log_bounds(events).select(F.explode(days).alias("day")).select(
        as_timestamp("day").alias("metric_time")
    )
