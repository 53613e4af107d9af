"""Recency, frequency and monetary scores per user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.operators import (
    first_by,
    left,
    ntile_score,
    ntile_scores,
    since as since_day,
    top,
    with_status,
)

SCORES = ("recency", "frequency", "monetary_value")


def orders_with_status(orders: DataFrame, log: DataFrame, tie: tuple[str, ...] = ()) -> DataFrame:
    """Orders with the latest status of the log; orders without a log row are left out."""
    latest_first = [F.col("dttm").desc_nulls_first(), *[F.col(c).desc() for c in tie]]
    latest = first_by(log, ["order_id"], latest_first).select("order_id", F.col("status_id").alias("status"))
    return orders.drop("status").join(latest, "order_id")


def _closed(orders: DataFrame, statuses: DataFrame, closed: str, since: str | None) -> DataFrame:
    rows = with_status(orders, statuses, closed)
    return rows if since is None else since_day(rows, "order_ts", since)


def _quantities(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with their number of ordered pieces; items are summed first so orders do not multiply."""
    pieces = items.groupBy("order_id").agg(F.sum("quantity").alias("quantity"))
    return left(orders, pieces, ["order_id"])


def _per_user(users: DataFrame, aggregated: DataFrame) -> DataFrame:
    return left(users.select(F.col("id").alias("user_id")), aggregated, ["user_id"])


def rfm_recency(
    users: DataFrame,
    orders: DataFrame,
    statuses: DataFrame,
    since: str,
    closed: str = "closed",
    strict: bool = False,
) -> DataFrame:
    """Quintile of the last closed order; users without one get 1.

    Users without orders are ranked lowest. ``strict`` ranks them highest
    before giving them 1, which leaves the top scores to nobody else.
    """
    last = _closed(orders, statuses, closed, since).groupBy("user_id").agg(F.max("order_ts").alias("last_ts"))
    base = _per_user(users, last)
    order = F.col("last_ts").asc_nulls_last() if strict else F.col("last_ts").asc_nulls_first()
    scored = ntile_score(base, order, "user_id", "score")
    return scored.select("user_id", F.when(F.col("last_ts").isNull(), 1).otherwise(F.col("score")).alias("recency"))


def rfm_frequency(
    users: DataFrame, orders: DataFrame, items: DataFrame, statuses: DataFrame, since: str, closed: str = "closed"
) -> DataFrame:
    """Quintile of the number of pieces in closed orders."""
    bought = _quantities(_closed(orders, statuses, closed, since), items)
    totals = bought.groupBy("user_id").agg(F.sum("quantity").alias("quantity"))
    base = _per_user(users, totals).fillna(0, subset=["quantity"])
    return ntile_score(base, F.col("quantity").asc(), "user_id", "frequency").select("user_id", "frequency")


def rfm_monetary(
    users: DataFrame, orders: DataFrame, statuses: DataFrame, since: str, closed: str = "closed"
) -> DataFrame:
    """Quintile of the amount of closed orders."""
    totals = _closed(orders, statuses, closed, since).groupBy("user_id").agg(F.sum("cost").alias("amount"))
    base = _per_user(users, totals).fillna(0, subset=["amount"])
    return ntile_score(base, F.col("amount").asc(), "user_id", "monetary_value").select("user_id", "monetary_value")


def rfm_segments(
    users: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    statuses: DataFrame,
    since: str,
    closed: str = "closed",
) -> DataFrame:
    """The three scores per user: orders are aggregated once and all scores share one range shuffle."""
    bought = _quantities(_closed(orders, statuses, closed, since), items)
    totals = bought.groupBy("user_id").agg(
        F.max("order_ts").alias("last_ts"), F.sum("quantity").alias("quantity"), F.sum("cost").alias("amount")
    )
    base = _per_user(users, totals)
    micros = F.unix_micros(F.col("last_ts").cast("timestamp"))
    scores = ntile_scores(
        base.select("user_id", micros.alias("last"), "quantity", "amount"),
        "user_id",
        {
            "recency": F.col("last"),
            "frequency": F.coalesce("quantity", F.lit(0)),
            "monetary_value": F.coalesce("amount", F.lit(0)),
        },
        null_score=1,
    )
    return scores.select("user_id", *SCORES)


def rfm_top(segments: DataFrame, n: int = 10) -> DataFrame:
    """First users by id."""
    return top(segments, ["user_id"], n)


def rfm_closed_only(
    orders: DataFrame, items: DataFrame, statuses: DataFrame, today: str, closed: str = "closed"
) -> DataFrame:
    """Earlier variant: buyers only, all time; recency runs from the fewest days since the last order (1) upward."""
    bought = _quantities(_closed(orders, statuses, closed, None), items)
    totals = bought.groupBy("user_id").agg(
        F.max("order_ts").alias("last_ts"), F.sum("quantity").alias("quantity"), F.sum("cost").alias("amount")
    )
    days = F.datediff(F.lit(today).cast("date"), F.col("last_ts"))
    scores = ntile_scores(
        totals.select("user_id", days.alias("days"), "quantity", "amount"),
        "user_id",
        {"recency": F.col("days"), "frequency": F.col("quantity"), "monetary_value": F.col("amount")},
        nulls_first=False,
    )
    return scores.select("user_id", *SCORES)
