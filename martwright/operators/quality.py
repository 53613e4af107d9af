"""Constraints as queries that return violations."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martwright.session import land


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def check(df: DataFrame, name: str, condition: Column) -> DataFrame:
    """Rows that break the condition; as in SQL CHECK, an unknown outcome passes."""
    return df.where(~condition).withColumn("rule", F.lit(name))


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of the columns."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]))


def references(df: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a full key that the parent lacks."""
    return df.dropna(subset=list(keys)).join(parent.select(*keys), list(keys), "left_anti")


def defaults(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill missing values by column."""
    return df.fillna(dict(values))


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows, NULLs, distinct values, smallest and largest value per column (as text).

    Distinct values are counted over (column, value) pairs that combine on the
    map side, so no task has to hold all values of a column.
    """
    one_row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[f(c).alias(f"{f.__name__}_{i}") for i, c in enumerate(cols) for f in (F.count, F.min, F.max)],
    )
    bounds = one_row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.col("n").alias("row_count"),
                        (F.col("n") - F.col(f"count_{i}")).alias("null_count"),
                        F.col(f"min_{i}").cast("string").alias("min_value"),
                        F.col(f"max_{i}").cast("string").alias("max_value"),
                    )
                    for i, c in enumerate(cols)
                ]
            )
        )
    )
    pairs = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                    for c in cols
                ]
            )
        )
    )
    values = pairs.distinct().groupBy("column_name").agg(F.count("value").alias("distinct_values"))
    return bounds.join(values, "column_name", "left").fillna(0, subset=["distinct_values"])


def quality_report(
    table: str,
    df: DataFrame,
    not_nulls: Sequence[str] = (),
    checks: Mapping[str, Column] | None = None,
    keys: Sequence[Sequence[str]] = (),
    parents: Mapping[str, tuple[DataFrame, Sequence[str]]] | None = None,
) -> DataFrame:
    """Number of violations per rule; ``df`` is evaluated once.

    Row rules are counted while the columns of keys and parents are written, and
    those rules read what has been written.
    """
    counted, kept = _watched(df, not_nulls, checks, keys, parents)
    return _report(table, df.sparkSession, counted, kept, keys, parents)


def write_checked(
    table: str,
    df: DataFrame,
    write: Callable[[DataFrame], None],
    read: Callable[[], DataFrame],
    not_nulls: Sequence[str] = (),
    checks: Mapping[str, Column] | None = None,
    keys: Sequence[Sequence[str]] = (),
    parents: Mapping[str, tuple[DataFrame, Sequence[str]]] | None = None,
) -> DataFrame:
    """Write a mart and count the violations of its rules in the same pass; returns ``quality_report``.

    Keys and parents are checked on the written mart, which ``read`` reads.
    """
    watched, observation = _observed(df, not_nulls, checks)
    write(watched)
    return _report(table, df.sparkSession, observation.get if observation else {}, read(), keys, parents)


def _row_rules(not_nulls: Sequence[str], checks: Mapping[str, Column] | None) -> dict[str, Column]:
    rules = {f"{c} not null": F.col(c).isNull() for c in not_nulls}
    return rules | {name: ~cond for name, cond in (checks or {}).items()}


def _observed(df: DataFrame, not_nulls: Sequence[str], checks: Mapping[str, Column] | None) -> tuple[DataFrame, Observation | None]:
    rules = _row_rules(not_nulls, checks)
    if not rules:
        return df, None
    observation = Observation()
    return df.observe(observation, *(F.count_if(broken).alias(rule) for rule, broken in rules.items())), observation


def _watched(df, not_nulls, checks, keys, parents) -> tuple[dict[str, int], DataFrame | None]:
    watched, observation = _observed(df, not_nulls, checks)
    columns = list(dict.fromkeys(c for key in [*keys, *(key for _, key in (parents or {}).values())] for c in key))
    if columns:
        kept = land(watched.select(*columns))
        return (observation.get if observation else {}), kept
    if observation is None:
        return {}, None
    return df.agg(*(F.count_if(broken).alias(rule) for rule, broken in _row_rules(not_nulls, checks).items())).first().asDict(), None


def _report(table: str, spark: SparkSession, counted: Mapping[str, int], kept: DataFrame | None, keys, parents) -> DataFrame:
    rows = [(rule, int(n or 0)) for rule, n in counted.items()]
    parts = [spark.createDataFrame(rows, "rule string, violations long")]
    for key in keys:
        name = f"unique ({', '.join(key)})"
        parts.append(unique(kept, key).agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("rule"), "violations"))
    for name, (parent, key) in (parents or {}).items():
        found = references(kept, parent, key).agg(F.count(F.lit(1)).alias("violations"))
        parts.append(found.select(F.lit(name).alias("rule"), "violations"))
    return reduce(DataFrame.unionByName, parts).select(F.lit(table).alias("table_name"), "rule", "violations")
