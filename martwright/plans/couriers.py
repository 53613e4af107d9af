"""Courier staging, dimensions, deliveries and the monthly pay ledger."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.functions import courier_pay, json_field, previous_month_of, rounded_ratio, time_of
from martwright.operators import first_by, lookup, on_date, surrogate_id

# Fields of a delivery object in JSON staging.
DELIVERY_FIELDS = T.StructType(
    [
        T.StructField("delivery_id", T.StringType()),
        T.StructField("courier_id", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("order_ts", T.TimestampNTZType()),
        T.StructField("delivery_ts", T.TimestampNTZType()),
        T.StructField("rate", T.IntegerType()),
        T.StructField("sum", T.DecimalType(14, 2)),
        T.StructField("tip_sum", T.DecimalType(14, 2)),
    ]
)


def parse_staging_json(staging: DataFrame, schema: T.StructType) -> DataFrame:
    """Fields of the JSON object next to its id; a broken object gives NULL fields."""
    return staging.select("object_id", F.from_json("object_value", schema).alias("o")).select("object_id", "o.*")


def _entities(staging: DataFrame, name: str, day: str | date | None) -> DataFrame:
    """Id and name of JSON or typed staging rows, latest row per id."""
    rows = staging if day is None else on_date(staging, "update_ts", day)
    if "object_value" in rows.columns:
        rows = rows.withColumn(f"{name}_name", json_field("object_value", "name")).withColumnRenamed(
            "object_id", f"{name}_id"
        )
    order = [F.col("update_ts").desc()] if "update_ts" in rows.columns else []
    latest = first_by(rows, [f"{name}_id"], [*order, F.col(f"{name}_name").asc()])
    return latest.select(f"{name}_id", f"{name}_name")


def couriers(staging: DataFrame, day: str | date | None = None) -> DataFrame:
    """Courier ids and names, of one load day if given."""
    return _entities(staging, "courier", day)


def restaurants(staging: DataFrame, day: str | date | None = None) -> DataFrame:
    """Restaurant ids and names, of one load day if given."""
    return _entities(staging, "restaurant", day)


def timestamps(deliveries: DataFrame, day: str | date | None = None) -> DataFrame:
    """Distinct order times with their calendar parts, of deliveries of one day if given."""
    rows = deliveries if day is None else on_date(deliveries, "delivery_ts", day)
    ts = F.col("ts")
    return rows.select(F.col("order_ts").alias("ts")).dropna().distinct().select(
        "ts",
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        time_of(ts).alias("time"),
        F.to_date(ts).alias("date"),
    )


def with_ids(dim: DataFrame, key: str, existing: DataFrame | None = None) -> DataFrame:
    """A dimension with surrogate ids in key order; members of an ``existing`` dimension keep theirs."""
    return surrogate_id(dim, [key], "id", existing)


def deliveries(
    staging: DataFrame, courier_dim: DataFrame, timestamp_dim: DataFrame, day: str | date | None = None
) -> DataFrame:
    """Delivery facts with the ids of courier and order time; unmatched rows are left out."""
    rows = staging if day is None else on_date(staging, "delivery_ts", day)
    who = courier_dim.select("courier_id", F.col("id").alias("courier_key"))
    when = timestamp_dim.select(F.col("ts").alias("order_ts"), F.col("id").alias("timestamp_id"))
    rows = lookup(rows, who, ["courier_id"], ["courier_key"], "inner")
    rows = lookup(rows, when, ["order_ts"], ["timestamp_id"], "inner")
    return rows.select(
        "order_id",
        "timestamp_id",
        "delivery_id",
        F.col("courier_key").alias("courier_id"),
        "address",
        "delivery_ts",
        F.coalesce("rate", F.lit(0)).alias("rate"),
        F.coalesce("sum", F.lit(0)).cast("decimal(14,2)").alias("sum"),
        F.coalesce("tip_sum", F.lit(0)).cast("decimal(14,2)").alias("tip_sum"),
    )


def courier_ledger(
    facts: DataFrame,
    courier_dim: DataFrame,
    timestamp_dim: DataFrame,
    month_of: str | date | None = None,
    base: str = "tips",
) -> DataFrame:
    """Monthly pay per courier, for all months or the one before ``month_of``.

    Fee and pay are shares of ``base``: the tips (default) or the order sum.
    """
    times = timestamp_dim.select(F.col("id").alias("timestamp_id"), "year", "month")
    how = "left"
    if month_of is not None:
        year, month = previous_month_of(month_of)
        times, how = times.where((F.col("year") == year) & (F.col("month") == month)), "inner"
    who = courier_dim.select(F.col("id").alias("courier_key"), "courier_id", "courier_name")
    rows = facts.withColumnRenamed("courier_id", "courier_key")
    rows = lookup(rows, times, ["timestamp_id"], ["year", "month"], how)
    rows = lookup(rows, who, ["courier_key"], ["courier_id", "courier_name"])
    grouped = rows.groupBy("courier_id", "courier_name", "year", "month").agg(
        F.count_distinct("order_id").alias("orders_count"),
        F.sum("sum").alias("total"),
        F.avg("rate").alias("rate"),
        F.sum("rate").alias("rate_sum"),
        F.count("rate").alias("rate_n"),
        F.sum("tip_sum").alias("tips"),
    )
    amount = F.col("tips" if base == "tips" else "total")
    pay = courier_pay("rate", amount)
    reward = pay + F.col("tips") * F.lit(Decimal("0.95"))

    def money(value):
        return value.cast("decimal(14,2)")

    return grouped.select(
        "courier_id",
        "courier_name",
        F.col("year").alias("settlement_year"),
        F.col("month").alias("settlement_month"),
        "orders_count",
        money(F.col("total")).alias("orders_total_sum"),
        rounded_ratio(F.col("rate_sum"), F.col("rate_n")).alias("rate_avg"),
        money(amount * F.lit(Decimal("0.25"))).alias("order_processing_fee"),
        money(pay).alias("courier_order_sum"),
        money(F.col("tips")).alias("courier_tips_sum"),
        money(reward).alias("courier_reward_sum"),
    )
