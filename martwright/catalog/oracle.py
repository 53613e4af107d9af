"""The registered queries as plain SQL over the base tables, written on their own (no shared logic)."""

from __future__ import annotations

from martwright.catalog.adapters import ADAPTERS, BASE_TABLES

_NAMES = {t: t for t in BASE_TABLES}


def _with(inputs: str, body: str) -> str:
    """The adapters as CTEs in front of a query that may start with further CTEs."""
    ctes = ",\n".join(f"{n} as ({ADAPTERS[n].format(**_NAMES)})" for n in inputs.split())
    return f"with {ctes}\n{body}"


def _uuid3(text: str) -> str:
    h = f"md5(unhex('6ba7b8129dad11d180b400c04fd430c8') || encode({text}))"
    return (
        f"concat(substr({h}, 1, 8), '-', substr({h}, 9, 4), '-3', substr({h}, 14, 3), '-', "
        f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab'), substr({h}, 18, 3), '-', substr({h}, 21, 12))"
    )


ORACLE: dict[str, str] = {}

# Scores per user

_CLOSED = "status = (select id from orderstatuses where lower(key) = 'closed')"
_LAST = f"""(select user_id, max(order_ts) as m from orders_src
    where {_CLOSED} and order_ts >= timestamp '2000-01-01' group by user_id)"""
_PIECES = """(select order_id, sum(quantity) as q from orderitems group by order_id)"""
_QUANTITY = f"""(select o.user_id, sum(i.q) as q from orders_src o left join {_PIECES} i on i.order_id = o.order_id
    where {_CLOSED} and order_ts >= timestamp '2000-01-01' group by o.user_id)"""
_COST = f"""(select user_id, sum(cost) as c from orders_src
    where {_CLOSED} and order_ts >= timestamp '2000-01-01' group by user_id)"""

ORACLE["orders_current_status"] = _with(
    "orders_src status_log",
    """select o.order_id, o.order_ts, o.user_id, cast(o.cost as double) as cost, s.status_id as status
    from orders_src o join (select *, row_number() over (partition by order_id
        order by dttm desc, n desc, p desc, status_id desc) as rn from status_log) s
      on s.order_id = o.order_id and s.rn = 1""",
)


def _recency(nulls: str) -> str:
    return f"""select id as user_id, case when m is null then 1 else bucket end as recency
    from (select u.id, o.m, ntile(5) over (order by o.m asc nulls {nulls}, u.id) as bucket
          from users u left join {_LAST} o on o.user_id = u.id)"""


_FREQUENCY = f"""select u.id as user_id, ntile(5) over (order by coalesce(o.q, 0), u.id) as frequency
    from users u left join {_QUANTITY} o on o.user_id = u.id"""
_MONETARY = f"""select u.id as user_id, ntile(5) over (order by coalesce(o.c, 0), u.id) as monetary_value
    from users u left join {_COST} o on o.user_id = u.id"""
_RFM_INPUTS = "users orders_src orderstatuses orderitems"
_SEGMENTS = f"""select r.user_id, r.recency, f.frequency, m.monetary_value
    from ({_recency('first')}) r join ({_FREQUENCY}) f on f.user_id = r.user_id join ({_MONETARY}) m on m.user_id = r.user_id"""

ORACLE["rfm_recency"] = _with(_RFM_INPUTS, _recency("first"))
ORACLE["rfm_recency_strict"] = _with(_RFM_INPUTS, _recency("last"))
ORACLE["rfm_frequency"] = _with(_RFM_INPUTS, _FREQUENCY)
ORACLE["rfm_monetary"] = _with(_RFM_INPUTS, _MONETARY)
ORACLE["rfm_segments"] = _with(_RFM_INPUTS, _SEGMENTS)
ORACLE["rfm_top"] = _with(_RFM_INPUTS, f"select * from ({_SEGMENTS}) order by user_id limit 10")
ORACLE["rfm_closed_only"] = _with(
    _RFM_INPUTS,
    f"""select user_id, ntile(5) over (order by days, user_id) as recency, ntile(5) over (order by q, user_id) as frequency,
        ntile(5) over (order by c, user_id) as monetary_value
    from (select o.user_id, date_diff('day', cast(max(order_ts) as date), date '2002-01-01') as days,
                 sum(i.q) as q, sum(cost) as c
          from orders_src o left join {_PIECES} i on i.order_id = o.order_id where {_CLOSED} group by o.user_id)""",
)

# Shipping

_COUNTRY = """(select row_number() over (order by shipping_country, shipping_country_base_rate) as shipping_country_id, *
    from (select distinct shipping_country, shipping_country_base_rate from shipping))"""
_TRANSFER = """(select row_number() over (order by transfer_type, transfer_model, shipping_transfer_rate) as transfer_type_id, *
    from (select distinct split_part(shipping_transfer_description, ':', 1) as transfer_type,
                 split_part(shipping_transfer_description, ':', 2) as transfer_model, shipping_transfer_rate from shipping))"""
_AGREEMENT = """(select distinct cast(split_part(vendor_agreement_description, ':', 1) as bigint) as agreementid,
        split_part(vendor_agreement_description, ':', 2) as agreement_number,
        cast(split_part(vendor_agreement_description, ':', 3) as decimal(14,3)) as agreement_rate,
        cast(split_part(vendor_agreement_description, ':', 4) as decimal(14,3)) as agreement_commission from shipping)"""
_INFO = f"""(select distinct s.shippingid, s.vendorid, s.shipping_plan_datetime, s.payment_amount, t.transfer_type_id,
        c.shipping_country_id, a.agreementid
    from shipping s
    left join {_TRANSFER} t on split_part(s.shipping_transfer_description, ':', 1) = t.transfer_type
        and split_part(s.shipping_transfer_description, ':', 2) = t.transfer_model
    left join {_COUNTRY} c on c.shipping_country = s.shipping_country
    left join {_AGREEMENT} a on cast(split_part(s.vendor_agreement_description, ':', 1) as bigint) = a.agreementid)"""
_STATUS = """(select shippingid, status, state, s_dt as shipping_start_fact_datetime, e_dt as shipping_end_fact_datetime
    from (select distinct shippingid, status, state, state_datetime,
            max(case when state = 'booked' then state_datetime end) over (partition by shippingid) as s_dt,
            max(case when state = 'recieved' then state_datetime end) over (partition by shippingid) as e_dt
          from shipping) t
    where (shippingid, state_datetime) in (select shippingid, max(state_datetime) from shipping group by shippingid))"""

ORACLE["ship_country_rates"] = _with(
    "shipping",
    f"select shipping_country_id, shipping_country, cast(shipping_country_base_rate as double) as shipping_country_base_rate from {_COUNTRY}",
)
ORACLE["ship_agreement"] = _with(
    "shipping",
    f"""select agreementid, agreement_number, cast(agreement_rate as double) as agreement_rate,
        cast(agreement_commission as double) as agreement_commission from {_AGREEMENT}""",
)
ORACLE["ship_transfer"] = _with(
    "shipping",
    f"""select transfer_type_id, transfer_type, transfer_model,
        cast(shipping_transfer_rate as double) as shipping_transfer_rate from {_TRANSFER}""",
)
ORACLE["ship_info"] = _with(
    "shipping", f"select * replace (cast(payment_amount as double) as payment_amount) from {_INFO}"
)
ORACLE["ship_status"] = _with("shipping", f"select * from {_STATUS}")
ORACLE["ship_latest_states"] = _with(
    "shipping",
    """select shippingid, status, state, state_datetime from shipping
    where (shippingid, state_datetime) in (select shippingid, max(state_datetime) from shipping group by shippingid)""",
)
ORACLE["ship_mart"] = _with(
    "shipping",
    f"""select i.shippingid, i.vendorid, t.transfer_type,
        cast(trunc(epoch(s.shipping_end_fact_datetime - s.shipping_start_fact_datetime) / 86400) as bigint) as full_day_at_shipping,
        case when s.shipping_end_fact_datetime > i.shipping_plan_datetime then 1 else 0 end as is_delay,
        case when s.status = 'finished' then 1 else 0 end as is_shipping_finish,
        s.shipping_end_fact_datetime, i.shipping_plan_datetime,
        case when s.shipping_end_fact_datetime > i.shipping_plan_datetime
            then cast(trunc(epoch(s.shipping_end_fact_datetime - i.shipping_plan_datetime) / 86400) as bigint) else 0 end
            as delay_day_at_shipping,
        cast(i.payment_amount as double) as payment_amount,
        cast(i.payment_amount * (c.shipping_country_base_rate + a.agreement_rate + t.shipping_transfer_rate) as double) as vat,
        cast(i.payment_amount * a.agreement_commission as double) as profit
    from {_INFO} i join {_STATUS} s on s.shippingid = i.shippingid
    left join {_TRANSFER} t on t.transfer_type_id = i.transfer_type_id
    left join {_AGREEMENT} a on a.agreementid = i.agreementid
    left join {_COUNTRY} c on c.shipping_country_id = i.shipping_country_id""",
)

# Retention

_LOG = """(select * exclude (payment_amount, status, rn),
        case when coalesce(status, 'shipped') = 'refunded' then -payment_amount
             when coalesce(status, 'shipped') = 'shipped' then payment_amount end as payment_amount,
        coalesce(status, 'shipped') as status
    from (select *, row_number() over (partition by date_time, city_id, customer_id, item_id, quantity, payment_amount, status
            order by id) as rn from user_order_log) where rn = 1)"""
_SALES = f"""(select cast(strftime(date_time, '%Y%m%d') as int) as date_id, strftime(date_time, '%G-W%V') as week, item_id,
        customer_id, city_id, quantity, payment_amount, status from {_LOG})"""
ORACLE["uol_prepare"] = _with(
    "user_order_log", f"select * replace (cast(payment_amount as double) as payment_amount) from {_LOG}"
)
ORACLE["dim_calendar"] = _with(
    "orders_src",
    """select distinct cast(strftime(order_ts, '%Y%m%d') as int) as date_id, cast(order_ts as date) as date_actual,
        strftime(order_ts, '%G-W%V') as week_of_year_iso from orders_src""",
)
ORACLE["dim_city"] = _with(
    "user_order_log known_cities",
    "select city_id, city_name from user_order_log where city_id not in (select city_id from known_cities) group by all",
)
ORACLE["dim_customer"] = _with(
    "user_order_log known_customers",
    """select customer_id, first_name, last_name, max(city_id) as city_id from user_order_log
    where customer_id not in (select customer_id from known_customers) group by customer_id, first_name, last_name""",
)
ORACLE["dim_item"] = _with(
    "user_order_log known_items",
    "select item_id, item_name from user_order_log where item_id not in (select item_id from known_items) group by all",
)
ORACLE["fact_sales"] = _with(
    "user_order_log",
    f"""select date_id, item_id, customer_id, city_id, quantity, cast(payment_amount as double) as payment_amount, status
    from {_SALES} where date_id = 20000315""",
)
ORACLE["fact_sales_reloaded"] = _with(
    "user_order_log",
    f"select date_id, count(*) as n, cast(sum(payment_amount) as double) as amount from {_SALES} group by date_id",
)


def _retention(strict: bool) -> str:
    refund = (
        "where customer_id in (select customer_id from sales where status = 'refunded')" if strict else "where status = 'refunded'"
    )
    join = "join" if strict else "full join"
    return f"""
    , sales as {_SALES}
    , n as (select week, item_id, count(distinct customer_id) as people, sum(quantity * payment_amount) as money from sales
        where customer_id in (select customer_id from sales group by customer_id having count(*) = 1) group by week, item_id)
    , r as (select week, item_id, count(distinct customer_id) as people, sum(quantity * payment_amount) as money from sales
        where customer_id in (select customer_id from sales group by customer_id having count(*) > 1) group by week, item_id)
    , b as (select week, item_id, count(distinct customer_id) as people, count(*) as rows from sales {refund} group by week, item_id)
    , j as (select week, item_id, n.people as a1, r.people as a2, b.people as a3, n.money as m1, r.money as m2, b.rows as k
        from n {join} r using (week, item_id) {join} b using (week, item_id))
    select coalesce(a1, 0) as new_customers_count, coalesce(a2, 0) as returning_customers_count,
        coalesce(a3, 0) as refunded_customer_count, week as period_name, dense_rank() over (order by week) as period_id, item_id,
        cast(coalesce(m1, 0) as double) as new_customers_revenue, cast(coalesce(m2, 0) as double) as returning_customers_revenue,
        coalesce(k, 0) as customers_refunded
    from j"""


ORACLE["customer_retention"] = _with("user_order_log", _retention(False))
ORACLE["customer_retention_strict"] = _with("user_order_log", _retention(True))


def _retention_by_order(strict: bool) -> str:
    """Orders as customers."""
    orders = ", by_order as (select * replace ((id % 1000000000000) // 8 as customer_id) from user_order_log)"
    return _with("user_order_log", orders + _retention(strict).replace("from user_order_log)", "from by_order)"))


ORACLE["customer_retention_by_order"] = _retention_by_order(False)
ORACLE["customer_retention_strict_by_order"] = _retention_by_order(True)
ORACLE["customer_retention_loaded"] = ORACLE["customer_retention_by_order"]

# Couriers

ORACLE["dim_couriers"] = _with(
    "couriers_stg",
    "select object_id as courier_id, json_extract_string(object_value, '$.name') as courier_name from couriers_stg",
)
ORACLE["dim_restaurants"] = _with(
    "restaurants_stg",
    "select restaurant_id, restaurant_name from restaurants_stg where cast(update_ts as date) = date '2022-01-02'",
)
_TIMES = "(select row_number() over (order by ts) as id, ts from (select distinct order_ts as ts from deliveries_stg))"
_COURIERS = """(select row_number() over (order by courier_id) as id, courier_id, concat('courier ', courier_id) as courier_name
    from (select distinct courier_id from deliveries_stg))"""
_FACTS = f"""(select d.order_id, t.id as timestamp_id, d.delivery_id, c.id as courier_id, d.address, d.delivery_ts, d.rate, d.sum,
        d.tip_sum
    from deliveries_stg d join {_COURIERS} c on c.courier_id = d.courier_id join {_TIMES} t on t.ts = d.order_ts)"""
ORACLE["dim_timestamps"] = _with(
    "deliveries_stg",
    """select ts, year(ts) as year, month(ts) as month, day(ts) as day, strftime(ts, '%H:%M:%S') as time, cast(ts as date) as date
    from (select distinct order_ts as ts from deliveries_stg)""",
)
ORACLE["fact_deliveries"] = _with(
    "deliveries_stg",
    f"select * replace (cast(sum as double) as sum, cast(tip_sum as double) as tip_sum) from {_FACTS}",
)
ORACLE["fact_deliveries_json"] = _with(
    "deliveries_stg",
    """select order_id, delivery_id, courier_id, order_ts, delivery_ts, rate, cast(sum as double) as sum,
        cast(tip_sum as double) as tip_sum from deliveries_stg""",
)


def _ledger(base: str, where: str = "") -> str:
    tier = " ".join(
        f"when {cond} then case when {share} * amount > {floor} then {share} * amount when {share} * amount <= {floor} then {floor} end"
        for cond, share, floor in [
            ("rate < 4", "0.05", 100),
            ("rate between 4 and 4.5", "0.07", 150),
            ("rate between 4.5 and 4.9", "0.08", 175),
            ("rate >= 4.9", "0.10", 200),
        ]
    )
    return f"""
    , g as (select c.courier_id, c.courier_name, year(t.ts) as y, month(t.ts) as m, count(distinct d.order_id) as orders_count,
            sum(d.sum) as total, avg(d.rate) as rate, cast(sum(d.rate) as bigint) as rs, count(d.rate) as rn, sum(d.tip_sum) as tips
        from {_FACTS} d left join {_COURIERS} c on c.id = d.courier_id left join {_TIMES} t on t.id = d.timestamp_id
        {where} group by all)
    , p as (select *, {base} as amount from g)
    , q as (select *, case {tier} end as pay from p)
    select courier_id, courier_name, y as settlement_year, m as settlement_month, orders_count,
        cast(cast(total as decimal(14,2)) as double) as orders_total_sum,
        ((200 * rs + rn) // (2 * rn)) / 100.0::double as rate_avg,
        cast(cast(0.25 * amount as decimal(14,2)) as double) as order_processing_fee,
        cast(cast(pay as decimal(14,2)) as double) as courier_order_sum,
        cast(cast(tips as decimal(14,2)) as double) as courier_tips_sum,
        cast(cast(pay + tips * 0.95 as decimal(14,2)) as double) as courier_reward_sum
    from q"""


ORACLE["courier_ledger"] = _with("deliveries_stg", _ledger("tips"))
ORACLE["courier_ledger_month"] = _with("deliveries_stg", _ledger("tips", "where year(t.ts) = 2000 and month(t.ts) = 5"))
ORACLE["courier_ledger_by_sum"] = _with("deliveries_stg", _ledger("total"))

# Messenger

_MESSENGER = """
    , h_groups as (select md5(cast(group_id as varchar)) as hk_group_id, group_id, min(event_dt) as registration_dt
        from group_log group by group_id)
    , h_users as (select md5(cast(user_id as varchar)) as hk_user_id, user_id
        from (select user_id from group_log union select user_id from group_messages))
    , link as (select distinct md5(concat(u.hk_user_id, ':', g.hk_group_id)) as hk_l_user_group_activity, u.hk_user_id, g.hk_group_id,
            timestamp '2024-02-01' as load_dt, 's3' as load_src
        from group_log l join h_users u on u.user_id = l.user_id join h_groups g on g.group_id = l.group_id)
    , auth as (select distinct k.hk_l_user_group_activity, l.user_id_from, l.event, l.event_dt, k.load_dt, k.load_src
        from group_log l join h_users u on u.user_id = l.user_id join h_groups g on g.group_id = l.group_id
        join link k on k.hk_user_id = u.hk_user_id and k.hk_group_id = g.hk_group_id)
    , dialogs as (select md5(cast(group_id as varchar)) as hk_group_id, message_id from group_messages)
    , written as (select message_id, md5(cast(user_id as varchar)) as hk_user_id from group_messages)
    , oldest as (select hk_group_id from h_groups order by registration_dt, hk_group_id limit 10)
    , added_all as (select o.hk_group_id, count(distinct k.hk_user_id) filter (o.hk_group_id is not null) as cnt_added_users
        from auth a left join link k on k.hk_l_user_group_activity = a.hk_l_user_group_activity
        left join oldest o on o.hk_group_id = k.hk_group_id where a.event = 'add' group by o.hk_group_id)
    , added as (select * from added_all where hk_group_id is not null)
    , active as (select g.hk_group_id, count(distinct w.hk_user_id) as cnt_users_in_group_with_messages
        from h_groups g left join dialogs d on d.hk_group_id = g.hk_group_id left join written w on w.message_id = d.message_id
        group by g.hk_group_id)
"""
_MSG_INPUTS = "group_log group_messages"
ORACLE["vault_link_user_group"] = _with(_MSG_INPUTS, f"{_MESSENGER} select * from link")
ORACLE["vault_link_user_group_new"] = _with(
    _MSG_INPUTS,
    f"""{_MESSENGER} select * from link where (hk_user_id, hk_group_id) not in (select md5(cast(user_id as varchar)),
        md5(cast(group_id as varchar)) from group_log where event_dt < timestamp '2024-01-08')""",
)
ORACLE["vault_sat_auth_history"] = _with(_MSG_INPUTS, f"{_MESSENGER} select * from auth")
ORACLE["group_added_users"] = _with(
    _MSG_INPUTS, f"{_MESSENGER} select * from added order by cnt_added_users, hk_group_id limit 10"
)
ORACLE["group_active_users"] = _with(
    _MSG_INPUTS, f"{_MESSENGER} select * from active order by cnt_users_in_group_with_messages, hk_group_id limit 10"
)
for _name, _source in [("group_conversion", "added"), ("group_conversion_all", "added_all")]:
    ORACLE[_name] = _with(
        _MSG_INPUTS,
        f"""{_MESSENGER} select a.hk_group_id, a.cnt_added_users, b.cnt_users_in_group_with_messages,
            cast(b.cnt_users_in_group_with_messages as double) / nullif(a.cnt_added_users, 0) as group_conversion
        from {_source} a left join active b on b.hk_group_id = a.hk_group_id""",
    )

# Geo


def _km(a: str, b: str, lon_a: str = "lon", lon_b: str = "lon") -> str:
    return f"""2 * 6371.0 * asin(sqrt(least(1.0, pow(sin((radians({b}.lat) - radians({a}.lat)) / 2), 2)
        + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin((radians({b}.{lon_b}) - radians({a}.{lon_a})) / 2), 2))))"""


_GEO = f"""
    , located as (select * from (select e.*, c.id as zone_id, c.city,
            row_number() over (partition by e.message_id order by {_km('e', 'c', 'lon', 'lng')}, c.id) as rn
        from geo_events e cross join cities c) where rn = 1)
    , visits as (select message_from as user_id, message_id, message_ts, date, event_type, zone_id, city from located)
    , actual as (select user_id, message_ts, city as act_city from (select *, row_number() over (partition by user_id
        order by message_ts desc, message_id desc) as k from visits) where k = 1)
    , lagged as (select *, lag(city) over (partition by user_id order by message_ts, message_id) as prev_city from visits)
    , moves as (select *, lag(date) over (partition by user_id order by message_ts, message_id) as prev_date
        from lagged where prev_city is null or prev_city <> city)
    , home as (select user_id, prev_city as home_city from (select *, row_number() over (partition by user_id
        order by message_ts desc, message_id desc) as k from moves where date_diff('day', prev_date, date) >= 5) where k = 1)
    , open_stay as (select user_id, city as open_city from (select *, row_number() over (partition by user_id
        order by message_ts desc, message_id desc) as k from moves) where k = 1 and date_diff('day', date, date '2024-01-30') >= 5)
    , trips as (select user_id, count(*) as travel_count, string_agg(city, ',' order by message_ts, message_id) as travel_array
        from moves where prev_city is not null group by user_id)
    , periods as (select *, cast(date_trunc('month', date) as date) as month, cast(date_trunc('week', date) as date) as week from visits)
    , starters as (select * from (select *, row_number() over (partition by user_id order by date, message_id) as k
        from periods where event_type = 'message') where k = 1)
    , weekly as (select month, week, zone_id, coalesce(a.m, 0) as week_message, coalesce(a.r, 0) as week_reaction,
            coalesce(a.s, 0) as week_subscription, coalesce(b.n, 0) as week_user
        from (select month, week, zone_id, count(*) filter (event_type = 'message') as m, count(*) filter (event_type = 'reaction') as r,
                count(*) filter (event_type = 'subscription') as s from periods group by all) a
        full join (select month, week, zone_id, count(*) as n from starters group by all) b using (month, week, zone_id))
    , monthly as (select month, zone_id, coalesce(a.m, 0) as month_message, coalesce(a.r, 0) as month_reaction,
            coalesce(a.s, 0) as month_subscription, coalesce(b.n, 0) as month_user
        from (select month, zone_id, count(*) filter (event_type = 'message') as m, count(*) filter (event_type = 'reaction') as r,
                count(*) filter (event_type = 'subscription') as s from periods group by all) a
        full join (select month, zone_id, count(*) as n from starters group by all) b using (month, zone_id))
"""
_GEO_INPUTS = "geo_events cities"


def _clock(ts: str, city: str) -> str:
    return f"""{ts} at time zone 'UTC' at time zone case {city} when 'NATION_0' then 'Australia/Perth'
        when 'NATION_1' then 'Australia/Brisbane' else 'Australia/ACT' end"""


def _geo(body: str) -> str:
    return _with(_GEO_INPUTS, f"{_GEO} {body}")


ORACLE["events_partitioned"] = _with(
    "geo_events",
    """select message_id, message_from, message_to, message_ts, date, event_type, lat, lon from geo_events
    where date between date '2024-01-11' and date '2024-01-20'""",
)
ORACLE["geo_event_city"] = _geo("select message_id, user_id, date, event_type, zone_id, city from visits")
ORACLE["geo_event_city_grid"] = ORACLE["geo_event_city"]
ORACLE["geo_actual_city"] = _geo("select * from actual")
ORACLE["geo_home_city"] = _geo("select * from home")
ORACLE["geo_home_city_open"] = _geo(
    "select user_id, coalesce(open_city, home_city) as home_city from home full join open_stay using (user_id)"
)
ORACLE["geo_user_city"] = _geo("select user_id, act_city, home_city from actual full join home using (user_id)")
ORACLE["geo_travel"] = _geo("select * from trips")
ORACLE["geo_travel_parts"] = _geo(
    """select user_id, (n - 1) // 3 as part, string_agg(city, ',' order by n) as cities
    from (select *, row_number() over (partition by user_id order by message_ts, message_id) as n from moves where prev_city is not null)
    group by user_id, (n - 1) // 3"""
)
ORACLE["geo_user_mart"] = _geo(
    f"""select user_id, act_city, home_city, coalesce(travel_count, 0) as travel_count, coalesce(travel_array, '') as travel_array,
        {_clock('message_ts', 'act_city')} as local_time
    from actual full join home using (user_id) full join trips using (user_id)"""
)
ORACLE["geo_zone_week"] = _geo("select * from weekly")
ORACLE["geo_zone_month"] = _geo("select * from monthly")
ORACLE["geo_zone_mart"] = _geo("select * from weekly join monthly using (month, zone_id)")
ORACLE["geo_friends"] = _geo(
    f""", spots as (select user_id, date, lat, lon, min(zone_id) as zone_id, min(city) as city, min(message_ts) as message_ts
        from (select message_from as user_id, date, lat, lon, zone_id, city, message_ts from located
              union all select message_to, date, lat, lon, zone_id, city, message_ts from located) group by all)
    , met as (select a.user_id as user_left, b.user_id as user_right, a.*, {_km('a', 'b')} as km
        from spots a join spots b on a.date = b.date and a.user_id < b.user_id where {_km('a', 'b')} <= 1)
    , best as (select * from (select *, row_number() over (partition by user_left, user_right
        order by round(km * 1000000), date, message_ts, zone_id, lat, lon) as k from met) where k = 1)
    , channels as (select distinct message_from as user_id, subscription_channel from geo_events where event_type = 'subscription')
    select user_left, user_right, timestamp '2024-02-01' as processed_dttm, zone_id, {_clock('message_ts', 'city')} as local_time
    from best p
    where not exists (select 1 from geo_events e where e.message_from = p.user_left and e.message_to = p.user_right)
      and not exists (select 1 from geo_events e where e.message_from = p.user_right and e.message_to = p.user_left)
      and exists (select 1 from channels x join channels y using (subscription_channel)
                  where x.user_id = p.user_left and y.user_id = p.user_right)"""
)
ORACLE["geo_friends_by_channel"] = ORACLE["geo_friends"].replace(
    "event_id % 10 as subscription_channel", "user_id % 40 + event_id % 2 as subscription_channel"
)

# Promotions

_CAMPAIGNS = """
    , campaigns as (select restaurant_id, adv_campaign_id, adv_campaign_content, adv_campaign_owner_contact,
        epoch_us(start_ts) // 1000 as adv_campaign_datetime_start, epoch_us(end_ts) // 1000 as adv_campaign_datetime_end,
        epoch_us(start_ts) // 1000 as datetime_created from campaigns_src)
    , active as (select * from campaigns where adv_campaign_datetime_start <= 1705276800000
        and adv_campaign_datetime_end >= 1705276800000)
    , once as (select * from (select *, row_number() over (partition by restaurant_id, adv_campaign_id
        order by datetime_created, adv_campaign_content, adv_campaign_owner_contact, adv_campaign_datetime_start) as k from active)
        where k = 1)
    , triggers as (select o.* exclude (k), s.client_id, 1705276800000 as trigger_datetime_created
        from once o join (select distinct restaurant_id, client_id from subscribers) s using (restaurant_id))
"""
_PROMO_INPUTS = "campaigns_src subscribers"


def _promo(body: str) -> str:
    return _with(_PROMO_INPUTS, f"{_CAMPAIGNS} {body}")


ORACLE["promo_active"] = _promo("select * from active")
ORACLE["promo_triggers"] = _promo("select * from triggers")
ORACLE["promo_payload"] = _promo(
    """select cast(trigger_datetime_created as varchar) as key, concat('{"restaurant_id":"', restaurant_id, '","adv_campaign_id":"',
        adv_campaign_id, '","adv_campaign_content":"', adv_campaign_content, '","adv_campaign_owner_contact":"',
        adv_campaign_owner_contact, '","adv_campaign_datetime_start":', adv_campaign_datetime_start,
        ',"adv_campaign_datetime_end":', adv_campaign_datetime_end, ',"datetime_created":', datetime_created,
        ',"client_id":', client_id, ',"trigger_datetime_created":', trigger_datetime_created, '}') as value from triggers"""
)
ORACLE["promo_feedback"] = _promo("select restaurant_id, adv_campaign_id, client_id, 'none' as feedback from triggers")
ORACLE["promo_decoded"] = _promo(
    """select restaurant_id as kind, count(*) as rows from campaigns group by restaurant_id
    union all select 'unreadable', count(*) from campaigns"""
)

# Orders vault

_SRC = "'dds-layer-orders-kafka' as load_src"
_IDS = {
    "restaurant": ("restaurant_id", "restaurant_id"),
    "user": ("user_id", "user_id"),
    "product": ("product_id", "product_id"),
    "category": ("category", "category_name"),
    "order": ("order_id", "order_id"),
}


def _pk(thing: str) -> str:
    return _uuid3(f"cast({_IDS[thing][0]} as varchar)")


for _thing, (_source, _out) in _IDS.items():
    _extra = "max(order_dt) as order_dt, " if _thing == "order" else ""
    ORACLE[f"hub_{_thing}"] = _with(
        "order_products",
        f"""select {_pk(_thing)} as h_{_thing}_pk, {_source} as {_out}, {_extra}min(load_dt) as load_dt, {_SRC}
        from order_products group by {_source}""",
    )
for _a, _b in [("order", "user"), ("product", "category"), ("product", "restaurant"), ("order", "product")]:
    ORACLE[f"link_{_a}_{_b}"] = _with(
        "order_products",
        f"""select {_uuid3('concat(a, b)')} as hk_{_a}_{_b}_pk, a as h_{_a}_pk, b as h_{_b}_pk, min(load_dt) as load_dt, {_SRC}
        from (select {_pk(_a)} as a, {_pk(_b)} as b, load_dt from order_products) group by a, b""",
    )
for _name, _hub, _value, _shown in [
    ("user_names", "user", "user_name", "user_name as username, 'userlogin' as userlogin"),
    ("order_cost", "order", "cast(cost as varchar)", "cast(cost as double) as cost, cast(payment as double) as payment"),
    ("order_status", "order", "status", "status"),
    ("restaurant_names", "restaurant", "restaurant_name", "restaurant_name as name"),
    ("product_names", "product", "product_name", "product_name as name"),
]:
    ORACLE[f"sat_{_name}"] = _with(
        "order_products",
        f"""select {_uuid3(f'concat(h, {_value})')} as hk_{_name}_pk, h as h_{_hub}_pk, {_shown}, load_dt, {_SRC}
        from (select *, {_pk(_hub)} as h, row_number() over (partition by {_IDS[_hub][0]}, {_value}
            order by load_dt desc, payment desc) as k from order_products) where k = 1""",
    )
ORACLE["vault_order_message"] = _with(
    "order_products",
    f""", keyed as (select *, {_pk('order')} as o, {_pk('user')} as u, {_pk('restaurant')} as r, {_pk('product')} as p,
        cast(product_id as varchar) as pid from order_products)
    select cast(order_id as varchar) as object_id, 'order' as object_type, o as h_order_pk,
        {_uuid3('concat(o, u)')} as hk_order_user_pk, {_uuid3('concat(o, cast(any_value(cost) as varchar))')} as hk_order_cost_pk,
        {_uuid3('concat(r, any_value(restaurant_name))')} as hk_restaurant_names_pk,
        string_agg(p, ',' order by pid, category, product_name) as products,
        string_agg({_uuid3('concat(o, p)')}, ',' order by pid, category, product_name) as order_products,
        string_agg(product_name, ',' order by pid, category, product_name) as names
    from keyed group by order_id, o, u, r""",
)
for _thing, _value in [("product", "product_name"), ("category", "category")]:
    ORACLE[f"user_{_thing}_counters"] = _with(
        "order_products",
        f"""select {_pk('user')} as user_id, {_pk(_thing)} as {_thing}_id, max({_value}) as {_thing}_name,
            count(distinct order_id) as order_cnt
        from order_products group by order_products.user_id, order_products.{_IDS[_thing][0]}""",
    )

# Currency

_MOVED = """
    , moved as (select cast(t.transaction_dt as date) as date_update, t.currency_code as currency_from, account_number_from,
            operation_id, abs(amount) * coalesce(c.currency_with_div, case when t.currency_code = 420 then 1.00 end) as amount,
            c.currency_with_div as rate
        from transactions t left join currencies c on cast(t.transaction_dt as date) = cast(c.date_update as date)
            and t.currency_code = c.currency_code and c.currency_code_with = 420
        where status = 'done' and account_number_from > 0 and account_number_to > 0)
"""
ORACLE["currency_metrics"] = _with(
    "transactions currencies",
    f"""{_MOVED}
    , g as (select date_update, currency_from, sum(amount) as s, count(distinct operation_id) as n,
            count(distinct account_number_from) as accounts from moved where date_update > date '1999-12-31' group by all)
    select date_update, currency_from, cast(s as double) as amount_total, n as cnt_transactions,
        ((2 * cast(s * 100 as hugeint) + n) // (2 * n)) / 100.0::double as avg_transactions_per_account,
        accounts as cnt_accounts_make_transactions
    from g""",
)
ORACLE["currency_missing_rates"] = _with(
    "transactions currencies",
    f"""{_MOVED} select date_update, currency_from, count(*) as cnt_transactions from moved
    where rate is null and currency_from <> 420 group by all""",
)
ORACLE["stg_currencies"] = _with(
    "currencies", "select * replace (cast(currency_with_div as double) as currency_with_div) from currencies"
)
ORACLE["stg_transactions"] = _with(
    "transactions", "select * replace (cast(operation_id as varchar) as operation_id) from transactions"
)

# Files, write modes and streams

ORACLE["order_log_csv"] = _with(
    "user_order_log", "select * replace (cast(payment_amount as double) as payment_amount) from user_order_log"
)
ORACLE["geo_csv"] = _with("cities", "select * from cities")
ORACLE["landed_deliveries"] = _with(
    "deliveries_stg",
    "select * replace (cast(sum as double) as sum, cast(tip_sum as double) as tip_sum) from deliveries_stg",
)
ORACLE["streamed_transactions"] = ORACLE["stg_transactions"]
ORACLE["order_status_upsert"] = _with(
    "orders_src status_log",
    """select order_id, coalesce(s.status_id, 0) as status_id, s.dttm
    from (select distinct order_id from orders_src union select order_id from status_log) o
    left join (select *, row_number() over (partition by order_id order by dttm desc, n desc, p desc, status_id desc) as k
        from status_log) s using (order_id) where coalesce(k, 1) = 1""",
)
ORACLE["item_counter_upsert"] = _with(
    "orderitems", "select product_id, cast(sum(quantity) as bigint) as pieces from orderitems group by product_id"
)
ORACLE["new_city_insert"] = _with(
    "known_cities user_order_log",
    "select * from known_cities union select city_id, city_name from user_order_log",
)
ORACLE["newer_transactions"] = _with(
    "transactions",
    """select operation_id, transaction_dt from transactions
    where cast(transaction_dt as date) > (select max(cast(transaction_dt as date)) from transactions
        where transaction_dt < timestamp '2000-01-01')""",
)
ORACLE["repeat_customers"] = _with(
    "user_order_log", "select customer_id from user_order_log group by customer_id having count(id) > 1"
)
ORACLE["item_counter_replayed"] = ORACLE["item_counter_upsert"]
ORACLE["stream_promo_triggers"] = _promo(
    ORACLE["promo_payload"].removeprefix(_promo("")).replace("select cast", "select 'topic' as output, cast", 1)
    + """ union all select 'feedback', cast(client_id as varchar), concat_ws('|', restaurant_id, adv_campaign_id, adv_campaign_content,
        adv_campaign_owner_contact, adv_campaign_datetime_start, adv_campaign_datetime_end, datetime_created, client_id, trigger_datetime_created)
        from triggers union all select 'unreadable', '', concat('{', restaurant_id) from campaigns"""
)
ORACLE["promo_trigger_times"] = _promo(
    """select restaurant_id, adv_campaign_id, client_id, epoch_ms(adv_campaign_datetime_start) as started_at,
        epoch_ms(trigger_datetime_created) as created_at,
        timezone(case restaurant_id when '3' then 'Asia/Tokyo' when '7' then 'America/New_York' else 'Europe/Berlin' end,
            timezone('UTC', epoch_ms(adv_campaign_datetime_start))) as started_local from triggers"""
)
_VAULT_COLUMNS = {
    **{c: "varchar" for thing in _IDS for c in (f"h_{thing}_pk", _IDS[thing][1])},
    **{c: "varchar" for c in ("username", "status", "name")},
    **{"cost": "double", "payment": "double", "order_dt": "timestamp"},
}


def _vault_part(query: str, prefix: str, key: str) -> str:
    """The SQL of one vault table (without the inputs in front) with the columns of all."""
    body = ORACLE[query].removeprefix(_with("order_products", ""))
    shown = ", ".join(f"cast({c} as {kind}) as {c}" for c, kind in _VAULT_COLUMNS.items())
    nulls = ", ".join(f"cast(null as {kind}) as {c}" for c, kind in _VAULT_COLUMNS.items())
    return f"select '{prefix}{query.split('_', 1)[1]}' as vault_table, {key} as key, {shown} from (select * from ({body}) union all by name select {nulls} where false)"


ORACLE["stream_vault_tables"] = _with(
    "order_products",
    " union all ".join(
        [
            *(_vault_part(f"hub_{t}", "h_", f"h_{t}_pk") for t in _IDS),
            *(_vault_part(f"link_{n}", "l_", f"hk_{n}_pk") for n in ("order_user", "product_category", "product_restaurant", "order_product")),
            *(_vault_part(f"sat_{n}", "s_", f"hk_{n}_pk") for n in ("user_names", "order_cost", "order_status", "restaurant_names", "product_names")),
        ]
    ),
)
ORACLE["stream_counters"] = _with(
    "order_products",
    " union all ".join(
        f"""select {_pk('user')} as user_id, {_pk(thing)} as thing_id, max({name}) as name, count(distinct order_id) as order_cnt
        from order_products group by order_products.user_id, order_products.{_IDS[thing][0]}"""
        for thing, name in [("product", "product_name"), ("category", "category")]
    ),
)

# Quality


def _rule(table: str, rule: str, count: str) -> str:
    return f"select '{table}' as table_name, '{rule}' as rule, ({count}) as violations"


def _rules(table: str, source: str, not_nulls: list[str], checks: dict[str, str], key: list[str]) -> list[str]:
    cols = ", ".join(key)
    return [
        *[_rule(table, f"{c} not null", f"select count(*) from {source} where {c} is null") for c in not_nulls],
        *[_rule(table, name, f"select count(*) from {source} where not ({cond})") for name, cond in checks.items()],
        _rule(table, f"unique ({cols})", f"select count(*) from (select 1 from {source} group by {cols} having count(*) > 1)"),
    ]


_SCORES = ["recency", "frequency", "monetary_value"]
_SUMS = ["orders_total_sum", "courier_order_sum", "courier_tips_sum", "order_processing_fee", "courier_reward_sum"]
ORACLE["quality_violations"] = _with(
    f"{_RFM_INPUTS} deliveries_stg user_order_log",
    f", segments as ({_SEGMENTS}), ledger as (with none as (select 1) {_ledger('tips')}) "
    + " union all ".join(
        [
            *_rules("rfm", "segments", ["user_id", *_SCORES], {f"{c} between 1 and 5": f"{c} between 1 and 5" for c in _SCORES}, ["user_id"]),
            *_rules(
                "orderitems",
                "orderitems",
                ["order_id", "product_id", "quantity", "price"],
                {"quantity > 0": "quantity > 0", "price >= 0": "price >= 0", "discount <= price": "discount <= price"},
                ["order_id", "product_id"],
            ),
            _rule("orderitems", "order exists", "select count(*) from orderitems where order_id not in (select order_id from orders_src)"),
            *_rules(
                "ledger",
                "ledger",
                ["courier_id", "courier_name"],
                {
                    **{f"{c} >= 0": f"{c} >= 0" for c in _SUMS},
                    "month": "settlement_month between 1 and 12",
                    "year": "settlement_year between 1950 and 2500",
                },
                ["courier_id", "settlement_month", "settlement_year"],
            ),
            *_rules(
                "order_log",
                "user_order_log",
                ["status"],
                {"refund": "status <> 'refunded'"},
                ["date_time", "city_id", "customer_id", "item_id", "quantity", "payment_amount", "status"],
            ),
        ]
    ),
)
ORACLE["quality_profile"] = _with(
    "orders_src",
    " union all ".join(
        f"""select '{c}' as column_name, count(*) as row_count, count(*) - count({c}) as null_count,
            cast(min({c}) as varchar) as min_value, cast(max({c}) as varchar) as max_value, count(distinct {c}) as distinct_values
        from orders_src"""
        for c in ["order_id", "user_id", "status", "cost", "order_ts"]
    ),
)
