"""Registered queries: every mart and write mode on the benchmark tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.catalog.adapters import Inputs
from martwright.functions import from_ms, hash_key, local_time
from martwright.operators import (
    empty_like,
    exclude,
    having,
    insert_new,
    newer_than,
    period_rank,
    profile,
    quality_report,
    upsert,
    upsert_add,
)
from martwright.plans import couriers as co
from martwright.plans import currency as cu
from martwright.plans import geo as ge
from martwright.plans import messenger as me
from martwright.plans import promotions as pr
from martwright.plans import retention as re
from martwright.plans import rfm
from martwright.plans import shipping as sh
from martwright.plans import vault as va
from martwright.plans.retention_load import RetentionMart
from martwright.session import land, materialize, release, shared_dir
from martwright.sources import (
    append,
    append_batch,
    copy_partitions,
    full_refresh,
    read_batches,
    read_csv_typed,
    read_events,
    read_geo_csv,
    read_landed_json,
    read_order_log_csv,
    replace_period,
    stream_new_files,
    write_partitioned,
)
from martwright.sources.state_table import StateTable, summed_rows
from martwright.streaming import load_counters, load_vault, promotion_outputs, run_stream, send_triggers
from martwright.streaming.orders import category_counters, product_counters, vault_state

# Parameters of the runs.
SINCE = "2000-01-01"
TODAY = "2002-01-01"
SALES_DAY = "2000-03-15"
LEDGER_DAY = "2000-06-02"
PROMO_NOW = "2024-01-15 00:00:00"
GEO_DAY, GEO_DEPTH = "2024-01-30", 30
COPY_DAY, COPY_DEPTH = "2024-01-20", 9
MIN_DAYS = 5
AFTER = "1999-12-31"
GEO_ZONES = {"NATION_0": "Australia/Perth", "NATION_1": "Australia/Brisbane"}
LOADED = "2024-02-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _presented(df: DataFrame) -> DataFrame:
    """Decimals as doubles and whole numbers as longs, so that engines print them alike."""

    def shown(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.IntegerType):
            return column.cast("long").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.array_join(field.name, ",").alias(field.name)
        return column

    return df.select(*[shown(f) for f in df.schema.fields])


def _query(build: Callable[[Inputs], DataFrame], name: str | None = None) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _presented(build(Inputs(spark, folder)))

    run.__name__ = name or build.__name__
    QUERIES[run.__name__] = run


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    _query(build)
    return build


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder for written tables next to the checkpoints."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def landed(t: Inputs, df: DataFrame, name: str) -> DataFrame:
    """Write a derived input as a table and read it back, as its job would find it."""
    folder = fresh_folder(t.spark, name)
    full_refresh(df, folder)
    return t.spark.read.parquet(folder)


# Scores per user


@query
def orders_current_status(t: Inputs) -> DataFrame:
    orders = rfm.orders_with_status(t.orders_src, t.status_log, ("n", "p", "status_id"))
    return orders.select("order_id", "order_ts", "user_id", "cost", "status")


@query
def rfm_recency(t: Inputs) -> DataFrame:
    return rfm.rfm_recency(t.users, t.orders_src, t.orderstatuses, SINCE)


@query
def rfm_recency_strict(t: Inputs) -> DataFrame:
    return rfm.rfm_recency(t.users, t.orders_src, t.orderstatuses, SINCE, strict=True)


@query
def rfm_frequency(t: Inputs) -> DataFrame:
    return rfm.rfm_frequency(t.users, t.orders_src, t.orderitems, t.orderstatuses, SINCE)


@query
def rfm_monetary(t: Inputs) -> DataFrame:
    return rfm.rfm_monetary(t.users, t.orders_src, t.orderstatuses, SINCE)


@query
def rfm_segments(t: Inputs) -> DataFrame:
    return rfm.rfm_segments(t.users, t.orders_src, t.orderitems, t.orderstatuses, SINCE)


@query
def rfm_top(t: Inputs) -> DataFrame:
    return rfm.rfm_top(rfm_segments(t))


@query
def rfm_closed_only(t: Inputs) -> DataFrame:
    return rfm.rfm_closed_only(t.orders_src, t.orderitems, t.orderstatuses, TODAY)


# Shipping


@query
def ship_country_rates(t: Inputs) -> DataFrame:
    return sh.country_rates(t.shipping)


@query
def ship_agreement(t: Inputs) -> DataFrame:
    return sh.agreements(t.shipping)


@query
def ship_transfer(t: Inputs) -> DataFrame:
    return sh.transfers(t.shipping)


@query
def ship_info(t: Inputs) -> DataFrame:
    log = landed(t, t.shipping, "shipping")
    return sh.shipping_info(log, sh.transfers(log), sh.country_rates(log))


@query
def ship_status(t: Inputs) -> DataFrame:
    return sh.shipping_status(t.shipping)


@query
def ship_latest_states(t: Inputs) -> DataFrame:
    return sh.latest_states(t.shipping).select("shippingid", "status", "state", "state_datetime")


@query
def ship_mart(t: Inputs) -> DataFrame:
    return sh.shipping_tables(landed(t, t.shipping, "shipping"))["shipping_datamart"]


# Retention


def _days(t: Inputs) -> DataFrame:
    """Calendar of all days between the first and the last of the order log."""
    day = F.to_date("date_time")
    first, last = t.user_order_log.agg(F.min(day), F.max(day)).first()
    return re.calendar(t.spark, first or "2000-01-01", last or "2000-01-01")


@query
def uol_prepare(t: Inputs) -> DataFrame:
    return re.prepare_order_log(t.user_order_log)


@query
def dim_calendar(t: Inputs) -> DataFrame:
    days = t.orders_src.select(F.to_date("order_ts").alias("date_actual")).distinct()
    return _days(t).join(days, "date_actual", "left_semi").select("date_id", "date_actual", "week_of_year_iso")


@query
def dim_city(t: Inputs) -> DataFrame:
    return re.new_cities(t.user_order_log, t.known_cities)


@query
def dim_customer(t: Inputs) -> DataFrame:
    return re.new_customers(t.user_order_log, t.known_customers)


@query
def dim_item(t: Inputs) -> DataFrame:
    return re.new_items(t.user_order_log, t.known_items)


@query
def fact_sales(t: Inputs) -> DataFrame:
    return re.fact_sales(re.prepare_order_log(t.user_order_log), _days(t), SALES_DAY)


def _sales(t: Inputs) -> DataFrame:
    return materialize(re.fact_sales(re.prepare_order_log(t.user_order_log), _days(t)))


@query
def customer_retention(t: Inputs) -> DataFrame:
    return re.customer_retention(_sales(t), _days(t))


@query
def customer_retention_strict(t: Inputs) -> DataFrame:
    return re.customer_retention(_sales(t), _days(t), strict=True)


def _log_by_order(t: Inputs) -> DataFrame:
    """The order log with orders as customers, so that some buy once and some more often."""
    return re.prepare_order_log(t.user_order_log.withColumn("customer_id", F.expr("(id % 1000000000000) div 8")))


@query
def customer_retention_by_order(t: Inputs) -> DataFrame:
    return re.customer_retention(materialize(re.fact_sales(_log_by_order(t), _days(t))), _days(t))


@query
def customer_retention_strict_by_order(t: Inputs) -> DataFrame:
    return re.customer_retention(materialize(re.fact_sales(_log_by_order(t), _days(t))), _days(t), strict=True)


@query
def customer_retention_loaded(t: Inputs) -> DataFrame:
    """The same from three increments that split customers and weeks; some come twice. Published by week."""
    columns = ["id", "date_time", "item_id", "customer_id", "city_id", "quantity", "payment_amount", "status"]
    log, days, out = land(_log_by_order(t).select(*columns)), _days(t), fresh_folder(t.spark, "retention")
    mart = RetentionMart(t.spark, f"{out}/state", buckets=4)
    touched = set()
    for part in (0, 1, 0, 2, 2):
        touched.update(mart.load(re.fact_sales(log.where(F.col("id") % 3 == part), days), days, part))
    mart.publish(f"{out}/mart", sorted(touched))
    return period_rank(materialize(t.spark.read.parquet(f"{out}/mart")), "period_name", "period_id")


@query
def fact_sales_reloaded(t: Inputs) -> DataFrame:
    """A month loaded twice into the fact table leaves its rows once."""
    folder = fresh_folder(t.spark, "fact_sales")
    sales = re.fact_sales(re.prepare_order_log(t.user_order_log), _days(t))
    sales = sales.withColumn("month_id", F.expr("date_id div 100"))
    replace_period(sales, folder, ["month_id"])
    month = t.spark.read.parquet(folder).where(F.col("month_id") == int(SALES_DAY[:7].replace("-", "")))
    replace_period(materialize(month), folder, ["month_id"])
    rows = t.spark.read.parquet(folder)
    return rows.groupBy("date_id").agg(F.count(F.lit(1)).alias("n"), F.sum("payment_amount").alias("amount"))


# Couriers


@query
def dim_couriers(t: Inputs) -> DataFrame:
    return co.couriers(t.couriers_stg)


@query
def dim_restaurants(t: Inputs) -> DataFrame:
    return co.restaurants(t.restaurants_stg, "2022-01-02")


@query
def dim_timestamps(t: Inputs) -> DataFrame:
    return co.timestamps(t.deliveries_stg)


def _courier_names(t: Inputs) -> DataFrame:
    name = F.concat(F.lit("courier "), F.col("courier_id")).alias("courier_name")
    return co.couriers(t.deliveries_stg.select("courier_id", name).distinct())


def _delivery_tables(t: Inputs) -> tuple[DataFrame, DataFrame, DataFrame]:
    who = co.with_ids(_courier_names(t), "courier_id")
    when = co.with_ids(co.timestamps(t.deliveries_stg), "ts")
    return co.deliveries(t.deliveries_stg, who, when), who, when


@query
def fact_deliveries(t: Inputs) -> DataFrame:
    return _delivery_tables(t)[0]


@query
def fact_deliveries_json(t: Inputs) -> DataFrame:
    """Deliveries from JSON staging rows."""
    typed = t.deliveries_stg
    body = F.to_json(F.struct("delivery_id", "courier_id", "address", "order_ts", "delivery_ts", "rate", "sum", "tip_sum"))
    staging = typed.select(F.col("order_id").alias("object_id"), body.alias("object_value"))
    parsed = co.parse_staging_json(staging, co.DELIVERY_FIELDS).withColumnRenamed("object_id", "order_id")
    return parsed.select("order_id", "delivery_id", "courier_id", "order_ts", "delivery_ts", "rate", "sum", "tip_sum")


@query
def courier_ledger(t: Inputs) -> DataFrame:
    return co.courier_ledger(*_delivery_tables(t))


@query
def courier_ledger_month(t: Inputs) -> DataFrame:
    return co.courier_ledger(*_delivery_tables(t), month_of=LEDGER_DAY)


@query
def courier_ledger_by_sum(t: Inputs) -> DataFrame:
    return co.courier_ledger(*_delivery_tables(t), base="sum")


# Messenger


def _group_vault(t: Inputs) -> dict[str, DataFrame]:
    log, written = t.group_log, t.group_messages
    users = log.select("user_id").unionByName(written.select("user_id")).distinct()
    users = users.withColumn("hk_user_id", hash_key("user_id"))
    groups = log.groupBy("group_id").agg(F.min("event_dt").alias("registration_dt"))
    groups = groups.withColumn("hk_group_id", hash_key("group_id"))
    loaded = F.lit(LOADED).cast("timestamp_ntz")
    link = me.link_user_group(log, users, groups, load_dt=loaded)
    message = hash_key("message_id").alias("hk_message_id")
    return {
        "log": log,
        "users": users,
        "groups": groups,
        "link": link,
        "auth": me.sat_auth_history(log, users, groups, link),
        "dialogs": written.select(hash_key("group_id").alias("hk_group_id"), message),
        "messages": written.select(message, hash_key("user_id").alias("hk_user_id")),
    }


@query
def vault_link_user_group(t: Inputs) -> DataFrame:
    return _group_vault(t)["link"]


@query
def vault_link_user_group_new(t: Inputs) -> DataFrame:
    """Links that only the events after the first week bring."""
    v = _group_vault(t)
    known = me.link_user_group(v["log"].where("event_dt < timestamp_ntz'2024-01-08 00:00:00'"), v["users"], v["groups"])
    return me.link_user_group(v["log"], v["users"], v["groups"], known, F.lit(LOADED).cast("timestamp_ntz"))


@query
def vault_sat_auth_history(t: Inputs) -> DataFrame:
    return _group_vault(t)["auth"]


@query
def group_added_users(t: Inputs) -> DataFrame:
    v = _group_vault(t)
    return me.fewest(me.added_users(v["groups"], v["link"], v["auth"]), "cnt_added_users")


@query
def group_active_users(t: Inputs) -> DataFrame:
    v = _group_vault(t)
    return me.fewest(me.active_users(v["groups"], v["dialogs"], v["messages"]), "cnt_users_in_group_with_messages")


@query
def group_conversion(t: Inputs) -> DataFrame:
    v = _group_vault(t)
    return me.group_conversion(v["groups"], v["link"], v["auth"], v["dialogs"], v["messages"])


@query
def group_conversion_all(t: Inputs) -> DataFrame:
    """With the row that stands for events of all other groups."""
    v = _group_vault(t)
    return me.group_conversion(v["groups"], v["link"], v["auth"], v["dialogs"], v["messages"], keep_unmatched=True)


# Geo


def _located(t: Inputs) -> DataFrame:
    return ge.assign_city(t.geo, t.cities)


def _visits(t: Inputs) -> DataFrame:
    return ge.flatten(_located(t))


@query
def events_partitioned(t: Inputs) -> DataFrame:
    raw, copy = fresh_folder(t.spark, "raw"), fresh_folder(t.spark, "ods")
    write_partitioned(t.sql("geo_events"), raw, ["date", "event_type"], mode="overwrite")
    copy_partitions(t.spark, raw, copy, COPY_DAY, COPY_DEPTH)
    rows = read_events(t.spark, copy, GEO_DAY, GEO_DEPTH)
    return rows.select("message_id", "message_from", "message_to", "message_ts", "date", "event_type", "lat", "lon")


@query
def geo_event_city(t: Inputs) -> DataFrame:
    return ge.flatten(_located(t)).select("message_id", "user_id", "date", "event_type", "zone_id", "city")


@query
def geo_event_city_grid(t: Inputs) -> DataFrame:
    """The search for many cities: growing grid joins instead of one expression per city."""
    from martwright.operators import nearest

    places = t.cities.select(F.col("id").alias("zone_id"), "city", "lat", F.col("lng").alias("lon"))
    found = nearest(t.sql("geo_events"), places, "zone_id", ["city"], inline_points=0)
    return found.select("message_id", F.col("message_from").alias("user_id"), "date", "event_type", "zone_id", "city")


@query
def geo_actual_city(t: Inputs) -> DataFrame:
    return ge.actual_city(_visits(t))


@query
def geo_home_city(t: Inputs) -> DataFrame:
    return ge.home_city(_visits(t), MIN_DAYS)


@query
def geo_home_city_open(t: Inputs) -> DataFrame:
    return ge.home_city(_visits(t), MIN_DAYS, GEO_DAY, include_open_stay=True)


@query
def geo_user_city(t: Inputs) -> DataFrame:
    visits = _visits(t)
    return ge.user_city(ge.actual_city(visits), ge.home_city(visits, MIN_DAYS)).drop("message_ts")


@query
def geo_travel(t: Inputs) -> DataFrame:
    return ge.travel(_visits(t))


@query
def geo_travel_parts(t: Inputs) -> DataFrame:
    return ge.travel_parts(_visits(t), size=3)


@query
def geo_user_mart(t: Inputs) -> DataFrame:
    return ge.user_geo(_visits(t), MIN_DAYS, GEO_ZONES)


@query
def geo_zone_week(t: Inputs) -> DataFrame:
    return ge.zone_week(_visits(t))


@query
def geo_zone_month(t: Inputs) -> DataFrame:
    return ge.zone_month(_visits(t))


@query
def geo_zone_mart(t: Inputs) -> DataFrame:
    return ge.zone_metrics(_visits(t))


@query
def geo_friends(t: Inputs) -> DataFrame:
    return ge.recommend_friends(_located(t), 1.0, GEO_ZONES, processed=LOADED)


@query
def geo_friends_by_channel(t: Inputs) -> DataFrame:
    """Suggestions with narrow channels, two per user, where positions meet channel by channel."""
    channel = F.col("event.message_from") % 40 + F.col("event.message_id") % 2
    located = _located(t).withColumn("event", F.col("event").withField("subscription_channel", channel))
    return ge.recommend_friends(located, 1.0, GEO_ZONES, processed=LOADED)


# Promotions


@query
def promo_active(t: Inputs) -> DataFrame:
    return pr.active_campaigns(t.campaigns, PROMO_NOW)


def _triggers(t: Inputs) -> DataFrame:
    return pr.campaign_triggers(pr.active_campaigns(t.campaigns, PROMO_NOW), t.subscribers, PROMO_NOW)


@query
def promo_triggers(t: Inputs) -> DataFrame:
    return _triggers(t)


@query
def promo_payload(t: Inputs) -> DataFrame:
    return pr.trigger_payload(_triggers(t))


@query
def promo_feedback(t: Inputs) -> DataFrame:
    return pr.feedback_rows(_triggers(t)).select(*pr.TRIGGER_KEY, F.coalesce("feedback", F.lit("none")).alias("feedback"))


@query
def promo_decoded(t: Inputs) -> DataFrame:
    """Campaigns sent as JSON bytes and read back; broken messages go to the second output."""
    sent = t.campaigns.select(F.to_json(F.struct("*")).alias("value"))
    broken = t.campaigns.select(F.concat(F.lit("{"), F.col("adv_campaign_id")).alias("value"))
    good, bad = pr.decode(sent.unionByName(broken).select(F.encode("value", "UTF-8").alias("value")))
    counted = bad.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("unreadable").alias("kind"), "rows")
    kept = good.groupBy("restaurant_id").agg(F.count(F.lit(1)).alias("rows"))
    return kept.select(F.col("restaurant_id").alias("kind"), "rows").unionByName(counted)


# Orders vault

for _name, _build in [
    *((n, va.hub) for n in va.HUBS),
    *((n, va.link) for n in va.LINKS),
    *((n, va.satellite) for n in va.SATELLITES),
]:
    _kind = {"h": "hub", "l": "link", "s": "sat"}[_name[0]] + _name[1:]
    _query(lambda t, n=_name, b=_build: b(t.vault_rows, n), _kind)


@query
def vault_order_message(t: Inputs) -> DataFrame:
    fields = T.StructType(
        [
            T.StructField("h_order", T.StructType([T.StructField("h_order_pk", T.StringType())])),
            T.StructField("l_order_user", T.StructType([T.StructField("hk_order_user_pk", T.StringType())])),
            T.StructField("s_order_cost", T.StructType([T.StructField("hk_order_cost_pk", T.StringType())])),
            T.StructField("s_restaurant_names", T.StructType([T.StructField("hk_restaurant_names_pk", T.StringType())])),
            T.StructField("h_product", T.ArrayType(T.StructType([T.StructField("h_product_pk", T.StringType())]))),
            T.StructField("l_order_product", T.ArrayType(T.StructType([T.StructField("hk_order_product_pk", T.StringType())]))),
            T.StructField("s_product_names", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
        ]
    )
    out = va.order_message(t.messages).select("object_id", "object_type", F.from_json("payload", fields).alias("p"))
    return out.select(
        "object_id",
        "object_type",
        "p.h_order.h_order_pk",
        "p.l_order_user.hk_order_user_pk",
        "p.s_order_cost.hk_order_cost_pk",
        "p.s_restaurant_names.hk_restaurant_names_pk",
        F.array_join("p.h_product.h_product_pk", ",").alias("products"),
        F.array_join("p.l_order_product.hk_order_product_pk", ",").alias("order_products"),
        F.array_join("p.s_product_names.name", ",").alias("names"),
    )


@query
def user_product_counters(t: Inputs) -> DataFrame:
    return va.user_product_counters(va.natural_counter_rows(t.vault_rows))


@query
def user_category_counters(t: Inputs) -> DataFrame:
    return va.user_category_counters(va.natural_counter_rows(t.vault_rows))


# Currency


@query
def currency_metrics(t: Inputs) -> DataFrame:
    return cu.global_metrics(t.transactions, t.currencies, after=AFTER)


@query
def currency_missing_rates(t: Inputs) -> DataFrame:
    return cu.missing_rates(t.transactions, t.currencies)


CURRENCY_FILE = T.StructType(
    [
        T.StructField("currency_code", T.IntegerType()),
        T.StructField("currency_code_with", T.IntegerType()),
        T.StructField("date_update", T.TimestampNTZType()),
        T.StructField("currency_with_div", T.DecimalType(14, 2)),
    ]
)
TRANSACTION_FILE = T.StructType(
    [
        T.StructField("operation_id", T.StringType()),
        T.StructField("account_number_from", T.LongType()),
        T.StructField("account_number_to", T.LongType()),
        T.StructField("currency_code", T.IntegerType()),
        T.StructField("country", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("amount", T.LongType()),
        T.StructField("transaction_dt", T.TimestampNTZType()),
    ]
)


@query
def stg_currencies(t: Inputs) -> DataFrame:
    """Rates landed as headerless CSV and loaded twice as a full refresh."""
    landed, table = fresh_folder(t.spark, "landed"), fresh_folder(t.spark, "stg_currencies")
    t.currencies.write.csv(landed)
    rates = read_csv_typed(t.spark, landed, CURRENCY_FILE)
    full_refresh(rates, table)
    full_refresh(rates, table)
    return t.spark.read.parquet(table)


@query
def stg_transactions(t: Inputs) -> DataFrame:
    """Transactions landed as CSV in two increments; the second repeats rows of the first."""
    landed, table = fresh_folder(t.spark, "landed"), fresh_folder(t.spark, "stg_transactions")
    rows = t.transactions
    half = F.lit("1998-01-01").cast("timestamp_ntz")
    rows.where(F.col("transaction_dt") < half).write.csv(f"{landed}/part=1")
    rows.where((F.col("transaction_dt") >= half) | (F.col("status") == "done")).write.csv(f"{landed}/part=2")
    append(read_csv_typed(t.spark, f"{landed}/part=1", TRANSACTION_FILE), table)
    second = read_csv_typed(t.spark, f"{landed}/part=2", TRANSACTION_FILE).dropDuplicates(["operation_id"])
    append(exclude(second, t.spark.read.parquet(table), ["operation_id"]), table)
    return t.spark.read.parquet(table)


# Files and write modes


@query
def order_log_csv(t: Inputs) -> DataFrame:
    """One folder of increments from before and after the status column was added."""
    folder, log = fresh_folder(t.spark, "increments"), t.user_order_log
    log.where("status is null").drop("status").write.option("header", True).mode("append").csv(folder)
    log.where("status is not null").select("status", *[c for c in log.columns if c != "status"]).write.option("header", True).mode("append").csv(folder)
    return read_order_log_csv(t.spark, folder)


@query
def geo_csv(t: Inputs) -> DataFrame:
    folder = fresh_folder(t.spark, "cities")
    comma = [F.regexp_replace(F.col(c).cast("string"), "[.]", ",").alias(c) for c in ("lat", "lng")]
    t.cities.select("id", "city", *comma).write.option("header", True).option("sep", ";").csv(folder)
    return read_geo_csv(t.spark, folder)


@query
def landed_deliveries(t: Inputs) -> DataFrame:
    """Deliveries landed as JSON lines."""
    folder = fresh_folder(t.spark, "landed")
    t.deliveries_stg.write.json(folder)
    schema = T.StructType([T.StructField("order_id", T.StringType()), *co.DELIVERY_FIELDS.fields])
    return read_landed_json(t.spark, folder, schema)


@query
def streamed_transactions(t: Inputs) -> DataFrame:
    """New files only: the second run of the stream reads what came after the first."""
    landed_in, out, state = (fresh_folder(t.spark, n) for n in ("landed", "streamed", "state"))
    rows = t.transactions

    def load() -> None:
        stream = stream_new_files(t.spark, landed_in, TRANSACTION_FILE)
        run_stream(stream, lambda df, n: append_batch(df, out, n), state).awaitTermination()

    for condition in ("status = 'done'", "status <> 'done'"):
        rows.where(condition).write.mode("append").csv(landed_in)
        load()
    return read_batches(t.spark, out).drop("batch_id")


@query
def order_status_upsert(t: Inputs) -> DataFrame:
    """Orders with the log's statuses written over them, the latest row of an order winning."""
    target = t.orders_src.select("order_id", F.col("status").alias("status_id"), F.col("order_ts").alias("dttm"))
    target = target.dropDuplicates(["order_id"]).select("order_id", F.lit(0).alias("status_id"), F.lit(None).cast("timestamp_ntz").alias("dttm"))
    order = [F.col(c).desc() for c in ("dttm", "n", "p", "status_id")]
    return upsert(target, t.status_log, ["order_id"], order).select("order_id", "status_id", "dttm")


@query
def item_counter_upsert(t: Inputs) -> DataFrame:
    """Pieces per item added up over two loads."""
    sold = t.orderitems.groupBy("product_id", (F.col("quantity") > 25).alias("large")).agg(F.sum("quantity").alias("pieces"))
    first, second = (sold.where(c).select("product_id", "pieces") for c in ("not large", "large"))
    return upsert_add(upsert_add(empty_like(first), first, ["product_id"], ["pieces"]), second, ["product_id"], ["pieces"])


@query
def item_counter_replayed(t: Inputs) -> DataFrame:
    """Pieces per item as running sums; batches that come again, old or last, change nothing."""
    sold = t.orderitems.groupBy("product_id", (F.col("quantity") % 5).alias("load")).agg(F.sum("quantity").alias("pieces"))
    table = StateTable(t.spark, fresh_folder(t.spark, "pieces"), "product_id long, pieces long", ["product_id"], summed_rows(["product_id"], ["pieces"]), buckets=4)
    for load in (0, 1, 2, 1, 3, 4, 4, 0):
        table.commit(sold.where(F.col("load") == load).select("product_id", F.col("pieces").cast("long")), load)
    table.compact()
    table.commit(sold.where("load = 4").select("product_id", F.col("pieces").cast("long")), 4)
    return table.read()


@query
def new_city_insert(t: Inputs) -> DataFrame:
    """The city dimension after the log's unknown cities were added."""
    known = t.known_cities
    return known.unionByName(insert_new(known, t.user_order_log.select("city_id", "city_name"), ["city_id"]))


@query
def newer_transactions(t: Inputs) -> DataFrame:
    """Transactions after the last day with a turnover of a queued kind."""
    loaded = t.transactions.where("transaction_dt < timestamp_ntz'2000-01-01 00:00:00'")
    rows = newer_than(t.transactions, loaded, "transaction_dt")
    return rows.select("operation_id", "transaction_dt")


@query
def repeat_customers(t: Inputs) -> DataFrame:
    """Customers with more than one row in the order log."""
    return having(t.user_order_log, ["customer_id"], F.count("id") > 1)


# Streams


@query
def stream_promo_triggers(t: Inputs) -> DataFrame:
    """Campaign messages as a stream: feedback rows, outgoing messages and unreadable ones.

    The second run brings the first one's messages again, and older ones that have lagged.
    """
    folder, out, state = (fresh_folder(t.spark, n) for n in ("campaigns", "triggers", "state"))
    sent = t.campaigns.select("restaurant_id", F.to_json(F.struct("*")).alias("value"))
    sinks = send_triggers(*(lambda df, n, k=kind: append_batch(df, f"{out}/{k}", n) for kind in ("feedback", "topic", "unreadable")))
    for rows in (sent.where("restaurant_id > '3'").select("value"), sent.select(F.explode(F.array("value", F.concat(F.lit("{"), "restaurant_id"))))):
        rows.write.mode("append").text(folder)
        messages = stream_new_files(t.spark, folder, T.StructType([T.StructField("value", T.StringType())]), "text")
        arrived = F.timestamp_millis(F.get_json_object("value", "$.datetime_created").cast("long"))
        outputs = promotion_outputs(messages.withColumn("timestamp", arrived), t.subscribers, PROMO_NOW)
        run_stream(outputs, sinks, state).awaitTermination()
    feedback = read_batches(t.spark, f"{out}/feedback").select(
        F.lit("feedback").alias("output"), F.col("client_id").cast("string").alias("key"), F.concat_ws("|", *pr.TRIGGER_COLUMNS).alias("value")
    )
    topic = read_batches(t.spark, f"{out}/topic").select(F.lit("topic").alias("output"), "key", "value")
    unreadable = read_batches(t.spark, f"{out}/unreadable").select(F.lit("unreadable").alias("output"), F.lit("").alias("key"), "value")
    return feedback.unionByName(topic).unionByName(unreadable)


@query
def promo_trigger_times(t: Inputs) -> DataFrame:
    """When each trigger was made and its campaign starts, as times and on the restaurant's clock."""
    zones = {"3": "Asia/Tokyo", "7": "America/New_York"}
    started, made = from_ms("adv_campaign_datetime_start"), from_ms("trigger_datetime_created")
    local = local_time(started, "restaurant_id", zones, "Europe/Berlin")
    return _triggers(t).select(*pr.TRIGGER_KEY, started.alias("started_at"), made.alias("created_at"), local.alias("started_local"))


def _streamed_vault(t: Inputs) -> str:
    """Order messages streamed in bounded batches into the vault and the counters."""
    folder, out, state = (fresh_folder(t.spark, n) for n in ("orders", "vault", "state"))
    t.messages.select(F.to_json(F.struct("object_id", "payload")).alias("value")).write.text(folder)
    # The landed messages are a copy: its shuffle files go now, its files once they have been streamed.
    release(t.spark)
    lines = stream_new_files(
        t.spark, folder, T.StructType([T.StructField("value", T.StringType())]), "text", maxFilesPerTrigger="4", cleanSource="delete"
    )
    messages = lines.select(F.from_json("value", va.MESSAGE).alias("m")).select("m.*")
    messages = messages.withColumn("load_dt", F.col("payload.date"))
    batch = load_vault(out, lambda df, n: append_batch(df, f"{out}/topic", n, "zstd"))
    run_stream(messages, batch, f"{state}/vault").awaitTermination()
    topic = f"{out}/topic"
    enriched = t.spark.readStream.schema("object_id string, object_type string, payload string").option("basePath", topic)
    enriched = enriched.option("maxFilesPerTrigger", "4")
    run_stream(enriched.parquet(topic), load_counters(out), f"{state}/counters").awaitTermination()
    return out


@query
def stream_vault_tables(t: Inputs) -> DataFrame:
    """Rows of all vault tables after the stream."""
    return vault_state(t.spark, _streamed_vault(t)).read().drop("load_dt", "load_src", "userlogin")


@query
def stream_counters(t: Inputs) -> DataFrame:
    """Orders per user and product, and per user and category, from the enriched messages."""
    out = _streamed_vault(t)
    shown = [
        counters(t.spark, out).toDF("user_id", "thing_id", "name", "order_cnt") for counters in (product_counters, category_counters)
    ]
    return shown[0].unionByName(shown[1])


# Quality


@query
def quality_violations(t: Inputs) -> DataFrame:
    segments = rfm_segments(t)
    scores = {f"{c} between 1 and 5": F.col(c).between(1, 5) for c in rfm.SCORES}
    ledger = courier_ledger(t)
    sums = ["orders_total_sum", "courier_order_sum", "courier_tips_sum", "order_processing_fee", "courier_reward_sum"]
    reports = [
        quality_report("rfm", segments, ["user_id", *rfm.SCORES], scores, [["user_id"]]),
        quality_report(
            "orderitems",
            t.orderitems,
            ["order_id", "product_id", "quantity", "price"],
            {"quantity > 0": F.col("quantity") > 0, "price >= 0": F.col("price") >= 0, "discount <= price": F.col("discount") <= F.col("price")},
            [["order_id", "product_id"]],
            {"order exists": (t.orders_src, ["order_id"])},
        ),
        quality_report(
            "ledger",
            ledger,
            ["courier_id", "courier_name"],
            {**{f"{c} >= 0": F.col(c) >= 0 for c in sums}, "month": F.col("settlement_month").between(1, 12), "year": F.col("settlement_year").between(1950, 2500)},
            [["courier_id", "settlement_month", "settlement_year"]],
        ),
        quality_report("order_log", t.user_order_log, ["status"], {"refund": F.col("status") != "refunded"}, [re.LOG_KEY]),
    ]
    return reduce(DataFrame.unionByName, reports)


@query
def quality_profile(t: Inputs) -> DataFrame:
    return profile(t.orders_src, ["order_id", "user_id", "status", "cost", "order_ts"])


__all__ = ["QUERIES"]
