"""Order log, dimensions, sales fact and weekly retention per item."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions import default, iso_week, signed_amount
from martwright.operators import lookup, new_members, on_date, period_rank, promote_staging
from martwright.session import materialize

LOG_KEY = ["date_time", "city_id", "customer_id", "item_id", "quantity", "payment_amount", "status"]


def calendar(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """One row per day: date id, date and ISO week."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))).alias("date_actual")
    )
    return days.select(
        F.date_format("date_actual", "yyyyMMdd").cast("int").alias("date_id"),
        "date_actual",
        iso_week("date_actual").alias("week_of_year_iso"),
    )


def prepare_order_log(level1: DataFrame, default_status: str = "shipped") -> DataFrame:
    """Duplicates removed, missing status filled, refunds negative."""
    rows = promote_staging(level1, LOG_KEY, "id")
    rows = rows.withColumn("status", default("status", default_status))
    return rows.withColumn("payment_amount", signed_amount("status", "payment_amount"))


def new_cities(log: DataFrame, known: DataFrame) -> DataFrame:
    """Cities of the log that the dimension lacks."""
    return new_members(log, known, "city_id", ["city_name"])


def new_customers(log: DataFrame, known: DataFrame) -> DataFrame:
    """Customers of the log that the dimension lacks, with their highest city id."""
    return new_members(log, known, "customer_id", ["first_name", "last_name"], pick=["city_id"])


def new_items(log: DataFrame, known: DataFrame) -> DataFrame:
    """Items of the log that the dimension lacks."""
    return new_members(log, known, "item_id", ["item_name"])


def with_date_id(df: DataFrame, days: DataFrame, ts: str) -> DataFrame:
    """Calendar id of a timestamp's day."""
    keyed = df.withColumn("date_actual", F.to_date(ts))
    return lookup(keyed, days, ["date_actual"], ["date_id"]).drop("date_actual")


def fact_sales(log: DataFrame, days: DataFrame, day: str | date | None = None) -> DataFrame:
    """Sales of one day, or of the whole log, with date ids."""
    rows = log if day is None else on_date(log, "date_time", day)
    columns = ["date_id", "item_id", "customer_id", "city_id", "quantity", "payment_amount", "status"]
    return with_date_id(rows, days, "date_time").select(*columns)


def customer_retention(sales: DataFrame, days: DataFrame, strict: bool = False) -> DataFrame:
    """New, returning and refunding customers with their revenue per ISO week and item.

    New customers have one sale in the history, returning ones more. Refunds
    are the refunded rows of the week. ``strict`` counts all rows of customers
    who ever refunded instead, and keeps only items that have all three classes.

    Rows are first summed per (customer, week, item), so a customer with a huge
    history shrinks before any join and each class is one conditional count.
    """
    dated = lookup(sales, days, ["date_id"], ["week_of_year_iso"])
    refunded = F.when(F.col("status") == "refunded", 1).otherwise(0)
    cells = dated.groupBy("customer_id", "week_of_year_iso", "item_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("quantity") * F.col("payment_amount")).alias("revenue"),
        F.sum(refunded).alias("refunds"),
    )
    people = sales.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total"), F.sum(refunded).alias("total_refunds")
    )
    joined = cells.join(people, "customer_id")
    is_new, is_back = F.col("total") == 1, F.col("total") > 1
    refunding = F.col("total_refunds") > 0 if strict else F.col("refunds") > 0
    refund_rows = F.col("n") if strict else F.col("refunds")

    def people_in(condition):
        return F.count(F.when(condition, 1))

    def money_in(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("revenue"))), F.lit(0)).cast("decimal(18,2)")

    result = joined.groupBy("week_of_year_iso", "item_id").agg(
        people_in(is_new).alias("new_customers_count"),
        people_in(is_back).alias("returning_customers_count"),
        people_in(refunding).alias("refunded_customer_count"),
        money_in(is_new).alias("new_customers_revenue"),
        money_in(is_back).alias("returning_customers_revenue"),
        F.coalesce(F.sum(F.when(refunding, refund_rows)), F.lit(0)).alias("customers_refunded"),
    )
    if strict:
        result = result.where(
            "new_customers_count > 0 and returning_customers_count > 0 and refunded_customer_count > 0"
        )
    # The result is read twice, for its weeks and for its rows.
    ranked = period_rank(materialize(result), "week_of_year_iso", "period_id")
    return ranked.select(
        "new_customers_count",
        "returning_customers_count",
        "refunded_customer_count",
        F.col("week_of_year_iso").alias("period_name"),
        "period_id",
        "item_id",
        "new_customers_revenue",
        "returning_customers_revenue",
        "customers_refunded",
    )
