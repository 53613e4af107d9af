"""Campaign messages to triggers: feedback table and outgoing topic."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.functions import now_ms
from martwright.plans.promotions import (
    TRIGGER_COLUMNS,
    TRIGGER_KEY,
    active_campaigns,
    decode,
    feedback_rows,
    trigger_payload,
)
from martwright.streaming.jobs import Sink, dedupe_stream, enrich_stream, fan_out, first_in_batch


def promotion_triggers(
    messages: DataFrame, subscribers: DataFrame, now: str | datetime | None = None, keep: str = "1 hour"
) -> DataFrame:
    """Stream of triggers: readable, active campaigns joined with clients, repeats dropped.

    Repeats are judged per (restaurant, campaign, client), so a client who
    subscribes between two copies of a message still gets the trigger. A trigger
    is remembered for ``keep`` after it was sent, by the clock of the cluster;
    a message that arrives late is judged like any other.
    """
    return _triggers(decode(messages)[0], subscribers, now, keep)


def promotion_outputs(
    messages: DataFrame, subscribers: DataFrame, now: str | datetime | None = None, keep: str = "1 hour"
) -> DataFrame:
    """Stream of triggers and of unreadable messages, whose raw text is in ``unreadable``; for ``send_triggers``.

    The number of unreadable messages is the observed metric ``messages`` under ``unreadable``.
    """
    good, bad = decode(messages)
    bad = bad.observe("unreadable", F.count(F.lit(1)).alias("messages"))
    return _triggers(good, subscribers, now, keep).unionByName(
        bad.select(F.coalesce("value", F.lit("")).alias("unreadable")), allowMissingColumns=True
    )


def _triggers(campaigns: DataFrame, subscribers: DataFrame, now: str | datetime | None, keep: str) -> DataFrame:
    active = active_campaigns(campaigns, now)
    if "timestamp" not in active.columns:
        active = active.withColumn("timestamp", F.current_timestamp())
    clients = subscribers.select("restaurant_id", "client_id").distinct()
    # Repeats within a batch go before the join, or each would be repeated for every client.
    first = first_in_batch(active, TRIGGER_KEY[:2], "timestamp", [F.lit(0).alias("client_id")])
    joined = enrich_stream(first, clients, ["restaurant_id"])
    once = dedupe_stream(joined, TRIGGER_KEY, "timestamp", keep, "triggers")
    return once.withColumn("trigger_datetime_created", now_ms(now)).select(*TRIGGER_COLUMNS)


def send_triggers(
    feedback: Callable[[DataFrame, int], None],
    topic: Callable[[DataFrame, int], None],
    unreadable: Callable[[DataFrame, int], None] | None = None,
) -> Sink:
    """Batch function that writes the feedback table and the outgoing messages from one computed batch.

    ``unreadable`` gets the raw texts (``value``) of the messages of ``promotion_outputs`` that are no campaigns.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        def good(rows: DataFrame) -> DataFrame:
            return rows.where("unreadable is null") if "unreadable" in rows.columns else rows

        sinks = [
            lambda rows, n: feedback(feedback_rows(good(rows)), n),
            lambda rows, n: topic(trigger_payload(good(rows)), n),
        ]
        if unreadable is not None:
            sinks.append(lambda rows, n: unreadable(rows.where("unreadable is not null").select(F.col("unreadable").alias("value")), n))
        fan_out(df, batch_id, sinks)

    return batch
