"""Joins by name, dimension lookups, and a measured broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast by hint only when it was measured and takes at most this many bytes.
BROADCAST_BYTES = 32 << 20


def measured_bytes(df: DataFrame) -> int:
    """Bytes that the rows take as Spark holds them, from one aggregate with one row per task."""
    width = F.lit(8)
    for f in df.schema.fields:
        width += 8
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width += F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            # Text is at least half as long as the numbers it shows.
            width += 2 * F.coalesce(F.octet_length(F.to_json(f.name)), F.lit(0))
    return df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()[0]


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES, otherwise: str | None = None) -> DataFrame:
    """Hint a broadcast after measuring; larger frames go to the shuffled, skew-splitting join.

    Only for frames whose size Spark would guess wrongly, such as exploded rows;
    ``otherwise`` is the join hint for them when they are larger.
    """
    if measured_bytes(df) <= max_bytes:
        return F.broadcast(df)
    return df.hint(otherwise) if otherwise else df


def inner(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join on shared column names."""
    return a.join(b, list(keys), "inner")


def left(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left outer equi-join on shared column names."""
    return a.join(b, list(keys), "left")


def full(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer equi-join; the keys are merged."""
    return a.join(b, list(keys), "full")


def keep_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys occur in the other frame (IN)."""
    return df.join(other, list(keys), "left_semi")


def exclude(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys do not occur in the other frame; unlike NOT IN, a NULL there hides nothing."""
    return df.join(other, list(keys), "left_anti")


def lookup(
    df: DataFrame, dim: DataFrame, keys: Sequence[str], values: Sequence[str], how: str = "left"
) -> DataFrame:
    """Fetch columns of a dimension by its unique keys; Spark broadcasts it if its bytes are few."""
    return df.join(dim.select(*keys, *values), list(keys), how)


def star(fact: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str], Sequence[str]]]) -> DataFrame:
    """Left-join a fact to several dimensions given as (dim, keys, values)."""
    for dim, keys, values in dims:
        fact = lookup(fact, dim, keys, values)
    return fact
