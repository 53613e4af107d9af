"""Strings, JSON text, flags and defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def split_part(text: Column | str, sep: str, n: int) -> Column:
    """Part ``n`` (1-based) of a separated text; NULL when the text has fewer parts."""
    return F.get(F.split(_col(text), f"\\Q{sep}\\E"), n - 1)


def json_field(text: Column | str, name: str) -> Column:
    """One top-level field of a JSON text as a string."""
    return F.get_json_object(_col(text), f"$.{name}")


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def default(value: Column | str, fallback: object) -> Column:
    """The value, or a constant where it is NULL."""
    return F.coalesce(_col(value), F.lit(fallback))


def fill_blank(value: Column | str, fallback: str) -> Column:
    """A text column with NULL and the empty string replaced."""
    text = _col(value)
    return F.when(text.isNull() | (text == ""), F.lit(fallback)).otherwise(text)
