"""Advertising campaigns matched with restaurant subscribers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.functions import now_ms
from martwright.operators import active_at, first_by

# Fields of a campaign message.
CAMPAIGN_FIELDS = T.StructType(
    [
        T.StructField("restaurant_id", T.StringType()),
        T.StructField("adv_campaign_id", T.StringType()),
        T.StructField("adv_campaign_content", T.StringType()),
        T.StructField("adv_campaign_owner", T.StringType()),
        T.StructField("adv_campaign_owner_contact", T.StringType()),
        T.StructField("adv_campaign_datetime_start", T.LongType()),
        T.StructField("adv_campaign_datetime_end", T.LongType()),
        T.StructField("datetime_created", T.LongType()),
    ]
)
CAMPAIGN_COLUMNS = [f for f in CAMPAIGN_FIELDS.fieldNames() if f != "adv_campaign_owner"]
TRIGGER_KEY = ["restaurant_id", "adv_campaign_id", "client_id"]
TRIGGER_COLUMNS = [*CAMPAIGN_COLUMNS, "client_id", "trigger_datetime_created"]


def decode(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Campaign columns of readable messages, and the raw text of those that are not.

    A ``timestamp`` of the messages (their arrival) is kept in both.
    """
    arrival = [c for c in messages.columns if c == "timestamp"]
    parsed = messages.select(F.col("value").cast("string").alias("value"), *arrival).withColumn(
        "event", F.from_json("value", CAMPAIGN_FIELDS)
    )
    readable = F.col("event").isNotNull() & F.col("event.restaurant_id").isNotNull() & F.col(
        "event.adv_campaign_id"
    ).isNotNull()
    good = parsed.where(readable).select(*[F.col(f"event.{c}").alias(c) for c in CAMPAIGN_COLUMNS], *arrival)
    return good, parsed.where(~readable).select("value", *arrival)


def active_campaigns(campaigns: DataFrame, now: str | datetime | None = None) -> DataFrame:
    """Campaigns whose closed time span contains the given UTC time, or the time of the batch."""
    return active_at(campaigns, "adv_campaign_datetime_start", "adv_campaign_datetime_end", now)


def campaign_triggers(
    campaigns: DataFrame, subscribers: DataFrame, now: str | datetime | None = None
) -> DataFrame:
    """One row per restaurant, campaign and client.

    Both sides are made unique before the join, so the joined rows need no
    further shuffle to be unique.
    """
    order = [F.col(c).asc_nulls_last() for c in ["datetime_created", *CAMPAIGN_COLUMNS[2:-1]]]
    first = first_by(campaigns, ["restaurant_id", "adv_campaign_id"], order)
    clients = subscribers.select("restaurant_id", "client_id").distinct()
    joined = clients.join(first, "restaurant_id")
    return joined.withColumn("trigger_datetime_created", now_ms(now)).select(*TRIGGER_COLUMNS)


def trigger_payload(triggers: DataFrame) -> DataFrame:
    """Message key and JSON value of each trigger."""
    return triggers.select(
        F.col("trigger_datetime_created").cast("string").alias("key"),
        F.to_json(F.struct(*TRIGGER_COLUMNS)).alias("value"),
    )


def feedback_rows(triggers: DataFrame) -> DataFrame:
    """Triggers with an empty feedback column, for the feedback table."""
    return triggers.select(*TRIGGER_COLUMNS, F.lit(None).cast("string").alias("feedback"))

