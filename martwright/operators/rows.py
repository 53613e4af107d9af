"""Row choice, duplicates and grouped values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in a total order.

    Spark plans the rank filter as a group limit before the shuffle, so each
    task sends at most one row per key and a hot key does not pile up.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def dedupe(df: DataFrame, cols: Sequence[str], keep: str) -> DataFrame:
    """One row per combination of ``cols`` (NULLs are equal): the one with the lowest ``keep``."""
    return first_by(df, cols, [F.col(keep).asc()])


def distinct_rows(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    """Distinct combinations of the columns."""
    return df.select(*cols).distinct()


def ordered_list(
    df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], name: str
) -> DataFrame:
    """Values of each key as an array in the given order; the array is the asked result cell."""
    items = F.array_sort(F.collect_list(F.struct(*order, value)))
    return df.groupBy(*keys).agg(F.transform(items, lambda item: item[value]).alias(name))


def milestone(state: str, value: str, ts: str) -> Column:
    """Aggregate: the latest time at which the state column had the value."""
    return F.max(F.when(F.col(state) == value, F.col(ts)))


def count_flags(
    df: DataFrame, keys: Sequence[str], column: str, names: Mapping[str, str]
) -> DataFrame:
    """Rows per key for each listed value of a column, one output column per value."""
    counts = [
        F.sum(F.when(F.col(column) == value, 1).otherwise(0)).alias(name)
        for value, name in names.items()
    ]
    return df.groupBy(*keys).agg(*counts)
