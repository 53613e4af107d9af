"""Previous values and change points per key, safe for a key that holds most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.operators.joins import broadcast_if_small
from martwright.session import materialize

# A key with more rows than this is not sorted by one task.
HOT_KEY_ROWS = 1_000_000
# Default of ``hot``: look for hot keys first. None says that there are none.
CHECK = "check"


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_KEY_ROWS) -> DataFrame | None:
    """Keys with more rows than allowed, or None; there are at most rows / hot_rows of them.

    Only the key column is read, and counts combine before the shuffle.
    """
    crowded = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot_rows).select(key)
    found = materialize(crowded)
    return None if found.isEmpty() else found


def previous_value(
    df: DataFrame,
    key: str,
    ts: str,
    tie: Sequence[str],
    values: Sequence[str],
    hot: DataFrame | str | None = CHECK,
) -> DataFrame:
    """Add ``prev_<value>`` from the preceding row of the key, NULL for the first row.

    ``hot`` is the result of ``hot_keys``; by default it is looked up here. Rows of
    hot keys are scanned in segments: ranges of key, time and tie that are about
    equally long, however few keys or times there are.
    """
    if isinstance(hot, str):
        hot = hot_keys(df, key)
    packed = F.struct(*values)
    named = [F.col(f"__prev.{v}").alias(f"prev_{v}") for v in values]

    def plain(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy(key).orderBy(ts, *tie)
        return rows.withColumn("__prev", F.lag(packed).over(order)).select(*df.columns, *named)

    if hot is None:
        return plain(df)
    # The hot keys have been written, so their measure is one cheap pass.
    marks = broadcast_if_small(hot.select(F.col(key).alias("__key")))
    is_hot = F.col(key).eqNullSafe(F.col("__key"))
    crowded = _segment_scan(df.join(marks, is_hot, "left_semi"), key, [ts, *tie], packed)
    return plain(df.join(marks, is_hot, "left_anti")).unionByName(crowded.select(*df.columns, *named))


def _segment_scan(df: DataFrame, key: str, order: Sequence[str], packed: Column) -> DataFrame:
    """``__prev`` (the preceding row's ``packed``) by sorted ranges whose last rows are carried over.

    Rows that are equal in all of ``order`` are told apart by a hash and a running
    number, so that they can be cut anywhere too.
    """
    sort = [key, *order, "__hash", "__number"]
    numbered = df.withColumn("__hash", F.xxhash64(*df.columns)).withColumn("__number", F.monotonically_increasing_id())
    # Written once, as a second sampling of the ranges would cut them elsewhere.
    cut = materialize(numbered.repartitionByRange(*sort).withColumn("__segment", F.spark_partition_id()))
    row = F.struct(F.col(key).alias("key"), packed.alias("row"))
    # One row per segment: the last row of the segment before it.
    tails = cut.groupBy("__segment").agg(F.max_by(row, F.struct(*sort)).alias("tail"))
    carried = tails.select("__segment", F.lag("tail").over(Window.orderBy("__segment")).alias("__carried"))
    local = cut.withColumn("__before", F.lag(row).over(Window.partitionBy("__segment").orderBy(*sort)))
    joined = local.join(F.broadcast(carried), "__segment").withColumn("__before", F.coalesce("__before", "__carried"))
    return joined.withColumn("__prev", F.when(F.col("__before.key").eqNullSafe(F.col(key)), F.col("__before.row")))


def change_points(
    df: DataFrame,
    key: str,
    value: str,
    ts: str,
    tie: Sequence[str] = (),
    keep_first: bool = False,
    hot: DataFrame | str | None = CHECK,
) -> DataFrame:
    """Rows whose value differs from the row before; the first row of a key only if asked."""
    linked = previous_value(df, key, ts, tie, [value], hot)
    changed = F.col(f"prev_{value}") != F.col(value)
    if keep_first:
        changed = changed | F.col(f"prev_{value}").isNull()
    return linked.where(changed)
