"""Mart inputs as SQL over the benchmark tables; the text is valid in Spark and in ANSI engines.

``{table}`` stands for a base table; every adapter reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

ADAPTERS = {
    "users": "select c_custkey as id, c_name as login from {customer}",
    "orders_src": """
        select o_orderkey as order_id, cast(o_orderdate as timestamp) as order_ts, o_custkey as user_id,
               cast(o_totalprice as decimal(14,2)) as cost,
               case o_orderstatus when 'F' then 4 when 'O' then 5 else 1 end as status
        from {orders}""",
    "orderstatuses": "select * from (values (4,'Closed'),(5,'Cancelled'),(1,'Open')) as t(id, key)",
    "orderitems": """
        select l_orderkey as order_id, l_partkey as product_id, cast(l_quantity as int) as quantity,
               cast(l_extendedprice as decimal(14,2)) as price, cast(l_discount as decimal(14,2)) as discount
        from {lineitem}""",
    "status_log": """
        select l_orderkey as order_id, case l_linestatus when 'F' then 4 else 5 end as status_id,
               l_shipdate as dttm, l_linenumber as n, l_partkey as p
        from {lineitem}""",
    "shipping": """
        with base as (
            select o.o_orderkey as shippingid, o.o_custkey % 50 as vendorid, o.o_orderdate as d0, x.d1,
                   o.o_orderstatus as st, cast(o.o_totalprice as decimal(14,2)) as payment_amount,
                   n.n_name as shipping_country, cast(n.n_nationkey as decimal(14,3)) / 100 as rate0,
                   concat(case when o.o_orderkey % 2 = 0 then '1p' else '3p' end, ':',
                          case o.o_orderkey % 3 when 0 then 'train' when 1 then 'ship' else 'airplane' end)
                       as shipping_transfer_description,
                   o.o_orderkey % 6 as tr,
                   concat(cast(o.o_custkey % 50 as varchar(10)), ':vsp-', cast(o.o_custkey % 50 % 20 as varchar(10)),
                          ':0.', cast(10 + o.o_custkey % 5 as varchar(10)),
                          ':0.0', cast(1 + o.o_custkey % 5 as varchar(10))) as vendor_agreement_description
            from {orders} o
            join (select l_orderkey, max(l_shipdate) as d1 from {lineitem} group by l_orderkey) x
              on x.l_orderkey = o.o_orderkey
            join {customer} c on c.c_custkey = o.o_custkey
            join {nation} n on n.n_nationkey = c.c_nationkey)
        select shippingid, vendorid, 'in_progress' as status, 'booked' as state, d0 as state_datetime,
               d0 + interval '60' day as shipping_plan_datetime, payment_amount, shipping_country,
               cast(rate0 as decimal(14,3)) as shipping_country_base_rate, shipping_transfer_description,
               cast(tr * 0.01 as decimal(14,3)) as shipping_transfer_rate, vendor_agreement_description
        from base
        union all
        select shippingid, vendorid, case st when 'F' then 'finished' else 'in_progress' end, 'recieved', d1,
               d0 + interval '60' day, payment_amount, shipping_country, cast(rate0 as decimal(14,3)),
               shipping_transfer_description, cast(tr * 0.01 as decimal(14,3)), vendor_agreement_description
        from base""",
    # Refund lines are delivered twice, under other ids.
    "user_order_log": """
        with b as (
            select l_orderkey * 8 + l_linenumber as id, o_orderdate as date_time, c_nationkey as city_id,
                   n_name as city_name, c_custkey as customer_id, c_name as first_name, c_mktsegment as last_name,
                   l_partkey % 20 as item_id, concat('item-', cast(l_partkey % 20 as varchar(10))) as item_name,
                   cast(l_quantity as int) as quantity, cast(l_extendedprice as decimal(14,2)) as payment_amount,
                   case l_returnflag when 'R' then 'refunded' when 'N' then 'shipped' end as status
            from {lineitem} join {orders} on o_orderkey = l_orderkey
            join {customer} on c_custkey = o_custkey join {nation} on n_nationkey = c_nationkey)
        select * from b
        union all
        select id + 1000000000000, date_time, city_id, city_name, customer_id, first_name, last_name, item_id,
               item_name, quantity, payment_amount, status
        from b where status = 'refunded'""",
    "known_cities": "select n_nationkey as city_id, n_name as city_name from {nation} where n_regionkey = 0",
    "known_customers": """
        select c_custkey as customer_id, c_name as first_name, c_mktsegment as last_name, c_nationkey as city_id
        from {customer} where c_mktsegment = 'BUILDING'""",
    "known_items": """
        select distinct p_size % 20 as item_id, concat('item-', cast(p_size % 20 as varchar(10))) as item_name
        from {part} where p_type = 'LARGE' and p_size % 20 < 5""",
    "deliveries_stg": """
        select cast(o_orderkey as varchar(20)) as order_id, o_orderdate as order_ts,
               concat('d', cast(o_orderkey as varchar(20))) as delivery_id,
               cast(o_custkey % 10 as varchar(20)) as courier_id, 'addr' as address,
               o_orderdate + interval '1' day as delivery_ts,
               case when (o_orderkey * 7) % 10 < o_custkey % 10 then 3 else 5 end as rate,
               cast(o_totalprice as decimal(14,2)) as sum, cast(o_orderkey % 500 as decimal(14,2)) as tip_sum
        from {orders}""",
    "couriers_stg": """
        select cast(s_suppkey as varchar(20)) as object_id,
               concat('{{"_id": "', cast(s_suppkey as varchar(20)), '", "name": "', s_name, '"}}') as object_value,
               timestamp '2022-01-01 00:00:00' as update_ts
        from {supplier}""",
    "restaurants_stg": """
        select cast(c_custkey as varchar(20)) as restaurant_id, c_name as restaurant_name,
               case when c_acctbal < 0 then timestamp '2022-01-02 10:00:00' else timestamp '2022-01-01 10:00:00' end as update_ts
        from {customer}""",
    "group_log": """
        select (user_id * 13 + event_id % 3) % 20 as group_id, user_id, (user_id * 7 + 1) % 150 as user_id_from,
               case event_type when 'signup' then 'add' when 'error' then 'leave' else 'create' end as event,
               ts as event_dt
        from {events} where event_type <> 'view'""",
    "group_messages": """
        select event_id as message_id, (user_id * 13 + event_id % 2) % 20 as group_id, user_id
        from {events} where event_type = 'view'""",
    "cities": """
        select n_nationkey as id, n_name as city, cast(-38 + n_nationkey as double) as lat,
               115 + n_nationkey * cast(1.5 as double) as lng
        from {nation}""",
    "geo_events": """
        select event_id as message_id, user_id as message_from, (user_id * 7 + 1) % 150 as message_to,
               ts as message_ts, cast(ts as date) as date, event_id % 10 as subscription_channel,
               case event_type when 'click' then 'reaction' when 'signup' then 'subscription' else 'message' end
                   as event_type,
               cast(-38 + (user_id + cast(floor(day(ts) / 10.0) as int)) % 25 as double)
                   + (event_id % 1000) * cast(0.0001 as double) as lat,
               115 + ((user_id + cast(floor(day(ts) / 10.0) as int)) % 25) * cast(1.5 as double) as lon
        from {events}""",
    "campaigns_src": """
        select cast(event_id % 20 as varchar(20)) as restaurant_id,
               concat('c', cast(event_id % 200 as varchar(20))) as adv_campaign_id,
               concat('content ', event_type) as adv_campaign_content,
               cast(user_id as varchar(20)) as adv_campaign_owner_contact, ts as start_ts,
               ts + interval '5' day as end_ts
        from {events} where event_type = 'purchase'""",
    "subscribers": """
        select cast(c_custkey % 20 as varchar(20)) as restaurant_id, c_custkey as client_id from {customer}""",
    "order_products": """
        select o_orderkey as order_id, o_orderdate as order_dt, cast(o_totalprice as decimal(14,2)) as cost,
               cast(o_totalprice as decimal(14,2)) as payment, o_orderstatus as status,
               o_orderkey % 10 as restaurant_id, s_name as restaurant_name, c_custkey as user_id,
               c_name as user_name, l_partkey as product_id, p_name as product_name, p_brand as category,
               o_orderdate as load_dt
        from {lineitem} join {orders} on o_orderkey = l_orderkey join {customer} on c_custkey = o_custkey
        join {part} on p_partkey = l_partkey join {supplier} on s_suppkey = o_orderkey % 10""",
    "transactions": """
        select o_orderkey as operation_id, o_custkey as account_number_from,
               (o_custkey * 3) % 1500 as account_number_to, 400 + c_nationkey as currency_code, n_name as country,
               case o_orderstatus when 'F' then 'done' else 'queued' end as status,
               'payment' as transaction_type,
               cast(floor(o_totalprice) as bigint) * case when o_orderkey % 5 = 0 then -1 else 1 end as amount,
               o_orderdate as transaction_dt
        from {orders} join {customer} on c_custkey = o_custkey join {nation} on n_nationkey = c_nationkey""",
    "currencies": """
        select 400 + n_nationkey as currency_code, 420 as currency_code_with, o_orderdate as date_update,
               cast(1 + (n_nationkey % 7) * 0.1 as decimal(14,2)) as currency_with_div
        from {orders} join {customer} on c_custkey = o_custkey join {nation} on n_nationkey = c_nationkey
        where n_nationkey not in (5, 20) group by o_orderdate, n_nationkey""",
}


class Inputs:
    """Adapters of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables = {t: f"parquet.`{self.folder}/{t}.parquet`" for t in BASE_TABLES}

    def sql(self, name: str) -> DataFrame:
        return self.spark.sql(ADAPTERS[name].format(**self._tables))

    __getattr__ = sql

    @property
    def geo(self) -> DataFrame:
        """Located events with the message fields in a struct."""
        return self.sql("geo_events").select(
            F.struct(
                "message_id",
                "message_from",
                "message_to",
                "message_ts",
                "subscription_channel",
                F.col("message_from").alias("user"),
            ).alias("event"),
            "event_type",
            "date",
            "lat",
            "lon",
        )

    @property
    def campaigns(self) -> DataFrame:
        """Campaign messages with epoch milliseconds."""
        start = F.unix_millis(F.col("start_ts").cast("timestamp"))
        end = F.unix_millis(F.col("end_ts").cast("timestamp"))
        return self.sql("campaigns_src").select(
            "restaurant_id",
            "adv_campaign_id",
            "adv_campaign_content",
            "adv_campaign_owner_contact",
            start.alias("adv_campaign_datetime_start"),
            end.alias("adv_campaign_datetime_end"),
            start.alias("datetime_created"),
        )

    @property
    def vault_rows(self) -> DataFrame:
        """Ordered products."""
        return self.sql("order_products")

    @property
    def messages(self) -> DataFrame:
        """Order messages: an order with the array of its products."""
        rows = self.vault_rows
        text = {c: F.col(c).cast("string") for c in ("order_id", "restaurant_id", "user_id", "product_id")}
        product = F.struct(
            text["product_id"].alias("id"), F.col("category").alias("category"), F.col("product_name").alias("name")
        )
        heads = ["order_id", "order_dt", "cost", "payment", "status", "restaurant_id", "restaurant_name", "user_id", "user_name", "load_dt"]
        orders = rows.groupBy(*heads).agg(F.array_sort(F.collect_list(product)).alias("products"))
        payload = F.struct(
            text["order_id"].alias("id"),
            F.col("order_dt").alias("date"),
            "cost",
            "payment",
            "status",
            F.struct(text["restaurant_id"].alias("id"), F.col("restaurant_name").alias("name")).alias("restaurant"),
            F.struct(text["user_id"].alias("id"), F.col("user_name").alias("name")).alias("user"),
            "products",
        )
        return orders.select(text["order_id"].alias("object_id"), payload.alias("payload"), "load_dt")
