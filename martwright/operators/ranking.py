"""Global numbering, quintiles and top rows without a one-task window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.operators.joins import lookup
from martwright.session import materialize

# monotonically_increasing_id keeps the partition number above this bit.
_PARTITION_BIT = 33


def _positions(
    df: DataFrame, order: Sequence[Column | str], within: Sequence[str], few_groups: bool = True
) -> DataFrame:
    """Add ``__rn`` (row number in a total order per group) and ``__total`` (group size).

    Group columns must not be NULL.

    The rows are range-partitioned and sorted once and written to the shared
    folder, so even a group of equal values that holds most rows is spread by
    the tie-break columns. Each partition then only needs the number of rows
    in the partitions before it.
    """
    keys = list(within)
    columns = [*(F.col(k).asc_nulls_first() for k in keys), *order]
    placed = materialize(
        df.repartitionByRange(*columns)
        .sortWithinPartitions(*columns)
        .withColumn("__pos", F.monotonically_increasing_id())
    ).withColumn("__block", F.shiftright("__pos", _PARTITION_BIT))

    blocks = placed.groupBy(*keys, "__block").agg(
        F.min("__pos").alias("__first"), F.count(F.lit(1)).alias("__size")
    )
    group = Window.partitionBy(*keys)
    before = group.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        *keys,
        "__block",
        (F.coalesce(F.sum("__size").over(before), F.lit(0)) - F.col("__first") + 1).alias("__shift"),
        F.sum("__size").over(group).alias("__total"),
    )
    if few_groups:
        # At most (partitions + groups) rows: bounded by the session, not by the data.
        offsets = F.broadcast(offsets)
    return (
        placed.join(offsets, [*keys, "__block"])
        .withColumn("__rn", F.col("__pos") + F.col("__shift"))
        .drop("__pos", "__block", "__shift")
    )


def _bucket(n: int) -> Column:
    """ntile bucket of ``__rn`` among ``__total`` rows; the first ``total % n`` buckets get one more row."""
    size = F.expr(f"__total div {n}")
    extra = F.col("__total") % n
    wide = extra * (size + 1)
    in_wide = F.floor((F.col("__rn") - 1) / (size + 1)) + 1
    in_narrow = extra + F.floor((F.col("__rn") - wide - 1) / F.greatest(size, F.lit(1))) + 1
    return F.when(F.col("__rn") <= wide, in_wide).otherwise(in_narrow).cast("int")


def number_rows(
    df: DataFrame, order: Sequence[Column | str], name: str, within: Sequence[str] = ()
) -> DataFrame:
    """Exact row numbers over a total order, per group if asked."""
    return (
        _positions(df, order, within, few_groups=not within).withColumn(name, F.col("__rn").cast("long")).drop("__rn", "__total")
    )


def list_parts(
    df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], name: str, size: int = 10_000, part: str = "part"
) -> DataFrame:
    """Values of each key in the given order, in arrays of ``size`` and their number ``part`` from 0.

    Positions come from sorted ranges, so neither a task nor a cell holds a key of
    many values; readers go on from part to part.
    """
    numbered = number_rows(df.select(*dict.fromkeys([*keys, *order, value])), list(order), "__n", list(keys))
    parted = numbered.withColumn(part, F.floor((F.col("__n") - 1) / size).cast("long"))
    items = F.array_sort(F.collect_list(F.struct("__n", value)))
    return parted.groupBy(*keys, part).agg(F.transform(items, lambda item: item[value]).alias(name))


def surrogate_id(df: DataFrame, order_cols: Sequence[str], name: str, existing: DataFrame | None = None) -> DataFrame:
    """Ids 1..n for distinct rows, ordered by all their key columns (NULL first).

    With an ``existing`` dimension (key columns and id), known members keep their
    ids and only new ones are numbered, from the largest id on.
    """
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    if existing is None:
        return number_rows(df, order, name)
    known = existing.select(*[F.col(c).alias(f"__{c}") for c in order_cols], F.col(name).cast("long"))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in order_cols]
    old = df.join(known, same).drop(*[f"__{c}" for c in order_cols])
    last = known.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
    new = number_rows(df.join(known, same, "left_anti"), order, name)
    return old.unionByName(new.withColumn(name, F.col(name) + last))


def ntile_score(
    df: DataFrame, order: Column, id_col: str, name: str, n: int = 5
) -> DataFrame:
    """Quantile bucket 1..n by one measure, ties broken by id."""
    placed = _positions(df, [order, F.col(id_col).asc()], ())
    return placed.withColumn(name, _bucket(n)).drop("__rn", "__total")


def ntile_scores(
    df: DataFrame,
    id_col: str,
    measures: Mapping[str, Column],
    n: int = 5,
    nulls_first: bool = True,
    null_score: int | None = None,
) -> DataFrame:
    """Several quantile scores of the same ids, in one range shuffle per type of measure.

    ``measures`` maps score names to columns. The rows are stacked by measure,
    ranked within each measure and folded back to one row per id. Whole and
    decimal numbers share one shuffle as long as a common type holds all their
    digits; no measure is rounded. ``null_score`` replaces the score of missing
    measures, which still take part in the ranking.
    """
    value = F.col("__value").asc_nulls_first() if nulls_first else F.col("__value").asc_nulls_last()
    score = _bucket(n)
    if null_score is not None:
        score = F.when(F.col("__value").isNull(), null_score).otherwise(score)
    scored = None
    for kind, names in _common_types(df, measures).items():
        entries = [F.struct(F.lit(m).alias("__measure"), measures[m].cast(kind).alias("__value")) for m in names]
        stacked = df.select(id_col, F.inline(F.array(*entries)))
        ranked = _positions(stacked, [value, F.col(id_col).asc()], ["__measure"]).select(id_col, "__measure", score.alias("__score"))
        scored = ranked if scored is None else scored.unionByName(ranked)
    picks = [F.max(F.when(F.col("__measure") == name, F.col("__score"))).alias(name) for name in measures]
    return scored.groupBy(id_col).agg(*picks)


def _common_types(df: DataFrame, measures: Mapping[str, Column]) -> dict[str, list[str]]:
    """Score names by the type their measures are ranked in; every cast keeps all digits."""
    fields = df.select(*[value.alias(name) for name, value in measures.items()]).schema.fields
    # Digits before and after the point of whole and decimal numbers.
    whole = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
    digits = {}
    for f in fields:
        if isinstance(f.dataType, T.DecimalType):
            digits[f.name] = (f.dataType.precision - f.dataType.scale, f.dataType.scale)
        elif f.dataType.simpleString() in whole:
            digits[f.name] = (whole[f.dataType.simpleString()], 0)
    before, after = (max((d[i] for d in digits.values()), default=0) for i in (0, 1))
    groups: dict[str, list[str]] = {}
    for f in fields:
        shared = f.name in digits and before + after <= 38
        groups.setdefault(f"decimal({before + after},{after})" if shared else f.dataType.simpleString(), []).append(f.name)
    return groups


def period_rank(df: DataFrame, col: str, name: str) -> DataFrame:
    """Dense rank of a period column, ranked over the distinct periods and joined back."""
    periods = number_rows(df.select(col).where(F.col(col).isNotNull()).distinct(), [F.col(col)], name)
    return lookup(df, periods.withColumn(name, F.col(name).cast("int")), [col], [name])


def top(df: DataFrame, order: Sequence[Column | str], n: int | None = None) -> DataFrame:
    """Sorted rows, or the first n of them; n turns the sort into a top-k."""
    ordered = df.orderBy(*order)
    return ordered if n is None else ordered.limit(n)
