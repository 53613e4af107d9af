"""Predicates that reach the scan, and filters against another frame."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.functions import datetime_of, now_ms, previous_month_of


def _day(value: str | date) -> date:
    return date.fromisoformat(value) if isinstance(value, str) else value


def since(df: DataFrame, column: str, day: str | datetime) -> DataFrame:
    """Rows at or after a point in time."""
    return df.where(F.col(column) >= datetime_of(day))


def on_date(df: DataFrame, column: str, day: str | date) -> DataFrame:
    """Rows of one day, as a range on the raw column so that it is pushed to the scan."""
    start = _day(day)
    end = start + timedelta(days=1)
    return df.where(
        (F.col(column) >= datetime_of(start.isoformat())) & (F.col(column) < datetime_of(end.isoformat()))
    )


def last_days(df: DataFrame, day: str | date, depth: int, column: str = "date") -> DataFrame:
    """Rows whose date lies in the ``depth`` days before ``day`` or on it; literals, so partitions are pruned."""
    end = _day(day)
    start = end - timedelta(days=int(depth))
    return df.where(F.col(column).between(F.lit(start), F.lit(end)))


def previous_month(df: DataFrame, day: str | date, year: str, month: str) -> DataFrame:
    """Rows of the calendar month before ``day``."""
    y, m = previous_month_of(day)
    return df.where((F.col(year) == y) & (F.col(month) == m))


def active_at(df: DataFrame, start: str, end: str, now: str | datetime | None = None) -> DataFrame:
    """Rows whose closed interval of epoch milliseconds contains the time; None means the batch time."""
    at = now_ms(now)
    return df.where((F.col(start) <= at) & (F.col(end) >= at))


def with_status(orders: DataFrame, statuses: DataFrame, key: str, status: str = "status") -> DataFrame:
    """Orders whose status id carries the given lower-case key."""
    ids = statuses.where(F.lower("key") == key.lower()).select(F.col("id").alias(status))
    return orders.join(ids, status, "left_semi")


def high_water(df: DataFrame, column: str, name: str = "high_water", empty: str = "1900-01-01") -> DataFrame:
    """One row with the largest value of a date or time column in its own type, or the fallback when there is none."""
    kind = df.schema[column].dataType
    return df.agg(F.coalesce(F.max(F.col(column)), F.lit(empty).cast(kind)).alias(name))


def newer_than(df: DataFrame, target: DataFrame, column: str, target_column: str | None = None) -> DataFrame:
    """Rows above the target's high-water mark; an empty target lets everything through.

    The mark is one value, read first, so the filter is a literal that reaches
    the scan. It keeps its clock time; a target that stores days only is compared
    by day, so a loaded day is not loaded again.
    """
    target_column = target_column or column
    mark = high_water(target, target_column).first()[0]
    kind = target.schema[target_column].dataType
    if isinstance(kind, T.DateType) and not isinstance(df.schema[column].dataType, T.DateType):
        return df.where(F.col(column) >= F.date_add(F.lit(mark), 1).cast(df.schema[column].dataType))
    return df.where(F.col(column) > F.lit(mark).cast(kind))


def having(df: DataFrame, keys: Sequence[str], condition: Column) -> DataFrame:
    """Keys whose aggregate condition holds."""
    return df.groupBy(*keys).agg(condition.alias("__keep")).where("__keep").drop("__keep")


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL numbers become 0."""
    return df.fillna(0, subset=list(cols))
