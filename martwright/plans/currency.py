"""Daily turnover per currency in one base currency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.functions import rounded_ratio

BASE_CURRENCY = 420


def _done(tx: DataFrame) -> DataFrame:
    rows = tx.where((F.col("status") == "done") & (F.col("account_number_from") > 0) & (F.col("account_number_to") > 0))
    return rows.withColumn("date_update", F.to_date("transaction_dt")).withColumnRenamed(
        "currency_code", "currency_from"
    )


def _rates(rates: DataFrame, base: int) -> DataFrame:
    """Rate per day and currency; several rates of a day add up, as joining each of them would."""
    return (
        rates.where(F.col("currency_code_with") == base)
        .groupBy(F.to_date("date_update").alias("date_update"), F.col("currency_code").alias("currency_from"))
        .agg(F.sum("currency_with_div").alias("rate"))
    )


def high_water_mark(metrics: DataFrame | None, fallback: str = "1900-01-01") -> str:
    """Latest loaded day of the mart, or the fallback when it is empty."""
    row = metrics.agg(F.max("date_update").cast("date").alias("d")).first() if metrics is not None else None
    return fallback if row is None or row["d"] is None else row["d"].isoformat()


def global_metrics(tx: DataFrame, rates: DataFrame, base: int = BASE_CURRENCY, after: str = "1900-01-01") -> DataFrame:
    """Turnover, transactions and accounts per day and currency after a day.

    The rate is the same for a whole (day, currency) group, so transactions
    are summed first and only the day totals meet the rates: the transactions
    are never joined. The base currency has rate 1; a currency without a rate
    has a NULL amount.
    """
    fresh = _done(tx).where(F.col("transaction_dt") >= F.date_add(F.lit(after).cast("date"), 1).cast("timestamp_ntz"))
    totals = fresh.groupBy("date_update", "currency_from").agg(
        F.sum(F.abs("amount")).alias("moved"),
        F.count_distinct("operation_id").alias("cnt_transactions"),
        F.count_distinct("account_number_from").alias("cnt_accounts_make_transactions"),
    )
    rate = F.coalesce(F.col("rate"), F.when(F.col("currency_from") == base, F.lit(1).cast("decimal(14,2)")))
    rows = totals.join(_rates(rates, base), ["date_update", "currency_from"], "left").withColumn(
        "amount_total", (F.col("moved").cast("decimal(20,0)") * rate).cast("decimal(22,2)")
    )
    return rows.select(
        "date_update",
        "currency_from",
        "amount_total",
        "cnt_transactions",
        rounded_ratio(F.col("amount_total"), F.col("cnt_transactions")).alias("avg_transactions_per_account"),
        "cnt_accounts_make_transactions",
    ).orderBy("date_update", "currency_from")


def missing_rates(tx: DataFrame, rates: DataFrame, base: int = BASE_CURRENCY) -> DataFrame:
    """Days and currencies of done transactions that have no rate, with their number of transactions."""
    days = _done(tx).where(F.col("currency_from") != base).groupBy("date_update", "currency_from")
    counts = days.agg(F.count(F.lit(1)).alias("cnt_transactions"))
    return counts.join(_rates(rates, base), ["date_update", "currency_from"], "left_anti")
