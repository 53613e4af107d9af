"""Staging, new dimension members and upserts as set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.operators.joins import exclude
from martwright.operators.rows import dedupe, first_by


def insert_new(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch whose keys the target lacks, one per key; NULL keys are skipped."""
    known = target.select(*keys).distinct()
    fresh = batch.dropna(subset=list(keys)).dropDuplicates(list(keys))
    return exclude(fresh, known, keys)


def new_members(
    log: DataFrame, dim: DataFrame, key: str, attrs: Sequence[str], pick: Sequence[str] = ()
) -> DataFrame:
    """Dimension rows for keys not yet in ``dim``.

    Rows are grouped by key and ``attrs``; for the ``pick`` columns the largest
    value of the group is taken.
    """
    grouped = log.where(F.col(key).isNotNull()).groupBy(key, *attrs)
    rows = grouped.agg(*[F.max(c).alias(c) for c in pick]) if pick else log.where(
        F.col(key).isNotNull()
    ).select(key, *attrs).distinct()
    return exclude(rows, dim.select(key).distinct(), [key])


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The target after the batch: batch rows replace target rows of the same key.

    ``order`` picks one row per key within the batch. The same batch again
    gives the same result.
    """
    latest = first_by(batch, keys, order)
    return exclude(target, latest.select(*keys), keys).unionByName(latest, allowMissingColumns=True)


def upsert_add(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    names: Sequence[str] = (),
) -> DataFrame:
    """Add the batch's measures to the target's; ``names`` are carried attributes."""
    sums = [F.sum(m).alias(m) for m in measures]
    kept = [F.max(c).alias(c) for c in names]
    return target.unionByName(batch).groupBy(*keys).agg(*kept, *sums)


def promote_staging(level1: DataFrame, cols: Sequence[str], keep: str) -> DataFrame:
    """First-level staging without duplicates; nothing is stored in between."""
    return dedupe(level1, cols, keep)


def with_default(df: DataFrame, column: str, value: object) -> DataFrame:
    """Add a column with a default, or fill its NULLs when it exists."""
    if column not in df.columns:
        return df.withColumn(column, F.lit(value))
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def with_load_meta(df: DataFrame, src: str, load_dt: Column | None = None) -> DataFrame:
    """Load time and source tag."""
    return df.withColumn("load_dt", F.current_timestamp() if load_dt is None else load_dt).withColumn(
        "load_src", F.lit(src)
    )


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return df.sparkSession.createDataFrame([], df.schema)
