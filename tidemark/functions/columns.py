"""Small column helpers shared by the operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def as_timestamp(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def timestamp_literal(t: dt.datetime) -> Column:
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def window_start(t: Column, days: int) -> Column:
    """``t`` minus a fixed number of days."""
    return t - F.make_dt_interval(F.lit(days))


def lookback_lower_bound(t: Column, days: Column) -> Column:
    """``t`` minus a number of days held in a column."""
    return t - F.make_dt_interval(days.cast("int"))


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """NULL instead of an error when the denominator is zero."""
    return F.try_divide(as_double(numerator), as_double(denominator))


def numeric_or_zero(c: str) -> Column:
    """Read a column as double; anything that is not a number becomes 0 (infinities stay)."""
    value = F.col(c).try_cast("double")
    return F.when(value.isNull() | F.isnan(value), F.lit(0.0)).otherwise(value)


def required(c: str, message: str) -> Column:
    """The column itself, failing the job on the first NULL."""
    return F.when(F.col(c).isNull(), F.raise_error(F.lit(message))).otherwise(F.col(c))


def label_to_int(c: str) -> Column:
    """Boolean or 0/1 label (also as text) to 0/1; anything else, a missing label too, fails the job."""
    given = required(c, f"{c} must not be NULL")
    number, text = given.try_cast("double"), F.lower(F.trim(given.cast("string")))
    wrong = F.raise_error(F.concat(F.lit(f"{c} must be boolean, 0 or 1, not "), given.cast("string")))
    return F.when((number == 1) | (text == "true"), 1).when((number == 0) | (text == "false"), 0).otherwise(wrong)


def quantile_name(p: float) -> str:
    return f"{round(p * 100):d}pct"
