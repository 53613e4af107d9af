"""Jobs for spark-submit: ``python -m martwright.jobs <job> key=value ...``.

Each job reads tables or topics, builds a mart and writes it; the paths and
connection options are arguments.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martwright.functions.dates import previous_month_of
from martwright.plans import couriers as co
from martwright.plans import currency as cu
from martwright.plans import geo, rfm
from martwright.plans import messenger as me
from martwright.plans.promotions import TRIGGER_KEY
from martwright.plans.retention import calendar, fact_sales, prepare_order_log
from martwright.plans.retention_load import RetentionMart
from martwright.plans.shipping import shipping_tables
from martwright.plans.vault import MESSAGE
from martwright.session import build_session, materialize
from martwright.sources import (
    append,
    copy_partitions,
    full_refresh,
    kafka_options,
    mart_path,
    read_events,
    read_geo_csv,
    read_jdbc,
    read_kafka_stream,
    read_order_log_csv,
    replace_period,
    write_jdbc_batch,
    write_kafka,
    write_mart,
    write_partitioned,
)
from martwright.sources.folders import has_files
from martwright.streaming import fan_out, load_counters, load_vault, promotion_outputs, run_stream, send_triggers
from martwright.streaming.jobs import Sink


def copy_events(spark: SparkSession, day: str, depth: str, source: str, target: str) -> None:
    """Raw events of the last days to the cleaned layer."""
    copy_partitions(spark, source, target, day, int(depth))


def geo_users(spark: SparkSession, day: str, depth: str, cities: str, events: str, out: str) -> None:
    """Located events, and the mart of user cities built from the written events."""
    located = geo.assign_city(read_events(spark, events, day, int(depth)), read_geo_csv(spark, cities))
    folder = mart_path(out, "geo_event", day, int(depth))
    write_partitioned(located, folder, ["date", "event_type"], mode="overwrite")
    visits = geo.flatten(spark.read.parquet(folder))
    write_mart(geo.user_geo(visits, run_date=day), out, "geo_event_users", day, int(depth))


def geo_zones(spark: SparkSession, day: str, depth: str, out: str) -> None:
    """Zone activity from the located events."""
    visits = geo.flatten(spark.read.parquet(mart_path(out, "geo_event", day, int(depth))))
    write_mart(geo.zone_metrics(visits), out, "geo_event_zones", day, int(depth))


def geo_friends(spark: SparkSession, day: str, depth: str, out: str) -> None:
    """Friend suggestions from the located events."""
    located = spark.read.parquet(mart_path(out, "geo_event", day, int(depth)))
    write_mart(geo.recommend_friends(located), out, "geo_recommend_friends", day, int(depth))


def _tables(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{folder}/{name}") for name in names]


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A table that an earlier load has written, or None."""
    return spark.read.parquet(path) if has_files(spark, path) else None


def scores(spark: SparkSession, tables: str, out: str, since: str) -> None:
    """Recency, frequency and monetary scores from users, orders, orderitems and orderstatuses."""
    full_refresh(rfm.rfm_segments(*_tables(spark, tables, "users", "orders", "orderitems", "orderstatuses"), since), f"{out}/rfm_segments")


def shipping(spark: SparkSession, log: str, out: str) -> None:
    """All shipping tables from the shipping log; ids of earlier loads are kept."""
    known = [_stored(spark, f"{out}/{name}") for name in ("shipping_transfer", "shipping_country_rates")]
    known = [None if dim is None else materialize(dim) for dim in known]
    for name, table in shipping_tables(spark.read.parquet(log), *known).items():
        full_refresh(materialize(table), f"{out}/{name}")


def retention(spark: SparkSession, increment: str, out: str, number: str) -> None:
    """An increment of the order log (files with or without a status) into the weekly retention mart.

    ``number`` counts the increments; one that comes again changes nothing. Only the weeks that it changes are rewritten.
    """
    log = materialize(prepare_order_log(read_order_log_csv(spark, increment)))
    first, last = log.agg(F.min(F.to_date("date_time")), F.max(F.to_date("date_time"))).first()
    if first is None:
        return
    days = calendar(spark, first, last)
    mart = RetentionMart(spark, f"{out}/state")
    weeks = mart.load(fact_sales(log, days), days, int(number))
    if weeks:
        mart.publish(f"{out}/mart", weeks)


def courier_ledger(spark: SparkSession, staging: str, out: str, day: str) -> None:
    """Courier pay of the month before ``day`` from staged couriers and deliveries, replacing that month."""
    courier_rows, delivery_rows = _tables(spark, staging, "couriers", "deliveries")
    known = {name: _stored(spark, f"{out}/{name}") for name in ("dim_couriers", "dim_timestamps")}
    couriers_dim = materialize(co.with_ids(co.couriers(courier_rows), "courier_id", known["dim_couriers"]))
    times = materialize(co.with_ids(co.timestamps(delivery_rows), "ts", known["dim_timestamps"]))
    full_refresh(couriers_dim, f"{out}/dim_couriers")
    full_refresh(times, f"{out}/dim_timestamps")
    ledger = co.courier_ledger(co.deliveries(delivery_rows, couriers_dim, times), couriers_dim, times, day)
    year, month = previous_month_of(day)
    replace_period(ledger, f"{out}/ledger", ["settlement_year", "settlement_month"], [(year, month)])


def messenger(spark: SparkSession, tables: str, out: str) -> None:
    """New links of users and groups, and their events, from group_log and the hubs users and groups."""
    log, users, groups = _tables(spark, tables, "group_log", "users", "groups")
    append(materialize(me.link_user_group(log, users, groups, _stored(spark, f"{out}/link"))), f"{out}/link")
    link = spark.read.parquet(f"{out}/link")
    append(materialize(me.sat_auth_history(log, users, groups, link, _stored(spark, f"{out}/auth"))), f"{out}/auth")


def currency(spark: SparkSession, tables: str, out: str) -> None:
    """Turnover per day and currency after the last loaded day, from transactions and currencies."""
    path = f"{out}/global_metrics"
    after = cu.high_water_mark(_stored(spark, path))
    append(materialize(cu.global_metrics(*_tables(spark, tables, "transactions", "currencies"), after=after)), path)


def _prefixed(options: Mapping[str, str], prefix: str) -> dict[str, str]:
    return {k.removeprefix(prefix): v for k, v in options.items() if k.startswith(prefix)}


def promotions(
    spark: SparkSession, servers: str, source: str, topic: str, state: str, unreadable: str = "", at_once: str = "20", keep: str = "1 hour", **options: str
) -> StreamingQuery:
    """Campaign topic and subscriber table to the feedback table and the trigger topic.

    ``kafka.*`` options go to Kafka, ``in.*`` (url, table, ...) to the
    subscriber table and ``out.*`` to the feedback table. Messages that are no
    campaigns go to the topic ``unreadable`` where one is given; they are counted in any case.
    """
    security = {k: v for k, v in options.items() if k.startswith("kafka.")}
    read, write = _prefixed(options, "in."), _prefixed(options, "out.")
    clients = read_jdbc(spark, read.pop("url"), read.pop("table"), read)
    url, table = write.pop("url"), write.pop("table")
    messages = read_kafka_stream(spark, kafka_options(servers, source, int(at_once), security))
    sinks = send_triggers(
        lambda df, n: write_jdbc_batch(df, url, table, write, n, TRIGGER_KEY),
        lambda df, _: write_kafka(df, servers, topic, security),
        _texts_to(servers, unreadable, security),
    )
    return run_stream(promotion_outputs(messages, clients, keep=keep), sinks, state, every="10 seconds", name="promotions")


def _texts_to(servers: str, topic: str, security: Mapping[str, str]) -> Sink | None:
    """A sink for raw texts, if there is a topic for them."""
    if not topic:
        return None
    return lambda df, _: write_kafka(df.select(F.lit(None).cast("string").alias("key"), "value"), servers, topic, security)


def _json_values(stream: DataFrame, fields) -> DataFrame:
    text = F.col("value").cast("string")
    loaded = F.col("timestamp").cast("timestamp_ntz").alias("load_dt")
    return stream.select(F.from_json(text, fields).alias("m"), loaded, text.alias("text")).select("m.*", "load_dt", "text")


def order_vault(
    spark: SparkSession, servers: str, source: str, topic: str, out: str, state: str, unreadable: str = "", at_once: str = "25", **kafka: str
) -> StreamingQuery:
    """Order topic to vault tables and the topic of enriched messages, some messages every 25 seconds.

    Messages without an ``object_id`` go to the topic ``unreadable`` where one is given.
    """
    messages = _json_values(read_kafka_stream(spark, kafka_options(servers, source, int(at_once), kafka)), MESSAGE)
    messages = messages.observe("order_messages", F.count_if(F.col("object_id").isNull()).alias("unreadable"))

    def send(df: DataFrame, _: int) -> None:
        body = F.to_json(F.struct("object_id", "object_type", "payload"))
        write_kafka(df.select(F.col("object_id").alias("key"), body.alias("value")), servers, topic, kafka)

    load, reject = load_vault(out, send), _texts_to(servers, unreadable, kafka)

    def batch(df: DataFrame, batch_id: int) -> None:
        sinks = [lambda rows, n: load(rows.where("object_id is not null").drop("text"), n)]
        if reject is not None:
            sinks.append(lambda rows, n: reject(rows.where("object_id is null").select(F.col("text").alias("value")), n))
        fan_out(df, batch_id, sinks)

    return run_stream(messages, batch, state, "25 seconds", "order_vault")


def order_counters(spark: SparkSession, servers: str, source: str, out: str, state: str, at_once: str = "50", **kafka: str) -> StreamingQuery:
    """Topic of enriched messages to the counters, some messages every 25 seconds."""
    fields = "object_id string, object_type string, payload string"
    enriched = _json_values(read_kafka_stream(spark, kafka_options(servers, source, int(at_once), kafka)), fields)
    return run_stream(enriched.drop("text"), load_counters(out), state, "25 seconds", "order_counters")


JOBS = {
    f.__name__: f
    for f in (
        copy_events, geo_users, geo_zones, geo_friends, scores, shipping, retention, courier_ledger, messenger, currency,
        promotions, order_vault, order_counters,
    )
}


def main(arguments: list[str]) -> None:
    name, *pairs = arguments
    options = dict(pair.split("=", 1) for pair in pairs)
    query = JOBS[name](build_session(name), **options)
    if query is not None:
        query.awaitTermination()


if __name__ == "__main__":
    main(sys.argv[1:])
