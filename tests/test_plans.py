from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from martwright.functions import hash_key
from martwright.plans import couriers as co
from martwright.plans import currency as cu
from martwright.plans import geo as ge
from martwright.plans import messenger as me
from martwright.plans import promotions as pr
from martwright.plans import retention as re
from martwright.plans import rfm
from martwright.plans import shipping as sh
from martwright.plans import vault as va


def ts(day, hour=0, month=1, year=2024):
    return datetime(year, month, day, hour)


# Scores


@pytest.fixture
def shop(table):
    users = table("id int", [(i,) for i in range(1, 8)])
    orders = table(
        "order_id int, order_ts timestamp_ntz, user_id int, cost decimal(14,2), status int",
        [(i, ts(i), i, D(i * 10), 4) for i in range(1, 6)] + [(6, ts(9), 6, D(99), 5), (7, ts(1, year=2021), 7, D(99), 4)],
    )
    items = table("order_id int, product_id int, quantity int", [(1, 1, 5), (1, 2, 5), (2, 1, 1), (3, 1, 2), (4, 1, 3)])
    statuses = table("id int, key string", [(4, "Closed"), (5, "Cancelled")])
    return users, orders, items, statuses


def test_scores(shop, rows):
    users, orders, items, statuses = shop
    # Users 6 and 7 have no closed order in the period: they rank lowest and score 1.
    recency = rfm.rfm_recency(users, orders, statuses, "2022-01-01")
    assert rows(recency) == [(1, 2), (2, 2), (3, 3), (4, 4), (5, 5), (6, 1), (7, 1)]
    strict = rfm.rfm_recency(users, orders, statuses, "2022-01-01", strict=True)
    assert rows(strict) == [(1, 1), (2, 1), (3, 2), (4, 2), (5, 3), (6, 1), (7, 1)]
    # Quantity 0: users 5, 6, 7; items of an order are summed.
    frequency = rfm.rfm_frequency(users, orders, items, statuses, "2022-01-01")
    assert rows(frequency) == [(1, 5), (2, 2), (3, 3), (4, 4), (5, 1), (6, 1), (7, 2)]
    monetary = rfm.rfm_monetary(users, orders, statuses, "2022-01-01")
    assert rows(monetary) == [(1, 2), (2, 2), (3, 3), (4, 4), (5, 5), (6, 1), (7, 1)]
    segments = rfm.rfm_segments(users, orders, items, statuses, "2022-01-01")
    expected = [(u, dict(rows(recency))[u], dict(rows(frequency))[u], dict(rows(monetary))[u]) for u in range(1, 8)]
    assert rows(segments) == expected
    assert [r["user_id"] for r in rfm.rfm_top(segments, 3).collect()] == [1, 2, 3]
    only = rfm.rfm_closed_only(orders, items, statuses, "2024-02-01")
    assert dict(rows(only, "user_id", "recency"))[5] == 1 and dict(rows(only, "user_id", "recency"))[7] == 5


def test_latest_status(table, rows):
    orders = table("order_id int, cost int", [(1, 10), (2, 20), (3, 30)])
    log = table("order_id int, status_id int, dttm timestamp_ntz", [(1, 4, ts(1)), (1, 5, ts(2)), (2, 4, ts(1)), (2, 5, ts(1))])
    assert rows(rfm.orders_with_status(orders, log, ("status_id",))) == [(1, 10, 5), (2, 20, 5)]


# Shipping

SHIPPING = (
    "shippingid long, vendorid long, status string, state string, state_datetime timestamp_ntz, shipping_plan_datetime timestamp_ntz,"
    "payment_amount decimal(14,2), shipping_country string, shipping_country_base_rate decimal(14,3),"
    "shipping_transfer_description string, shipping_transfer_rate decimal(14,3), vendor_agreement_description string"
)


def shipment(i, status, state, at, plan, agreement="1:vsp-1:0.1:0.02"):
    return (i, 1, status, state, at, plan, D("100.00"), "usa", D("0.050"), "1p:train", D("0.020"), agreement)


@pytest.fixture
def log(table):
    plan = ts(10)
    return table(
        SHIPPING,
        [
            shipment(1, "in_progress", "booked", ts(1), plan),
            shipment(1, "finished", "recieved", ts(11, 12), plan),
            shipment(2, "in_progress", "booked", ts(2), plan, "2:vsp-2:0.2"),
            shipment(3, "in_progress", "booked", ts(1), plan),
            shipment(3, "finished", "recieved", ts(10), plan),
            shipment(4, "in_progress", "booked", ts(5), plan, ""),
            shipment(4, "finished", "recieved", ts(2, 12), plan, ""),
        ],
    )


def test_shipping_dimensions(log, rows):
    assert rows(sh.country_rates(log), "shipping_country_id", "shipping_country") == [(1, "usa")]
    assert rows(sh.transfers(log), "transfer_type_id", "transfer_type", "transfer_model") == [(1, "1p", "train")]
    assert rows(sh.agreements(log)) == [
        (1, "vsp-1", D("0.100"), D("0.020")),
        (2, "vsp-2", D("0.200"), None),
        (None, None, None, None),
    ]


def test_shipping_mart(log, rows):
    mart = sh.shipping_tables(log)["shipping_datamart"]
    columns = ["shippingid", "full_day_at_shipping", "is_delay", "is_shipping_finish", "delay_day_at_shipping", "vat", "profit"]
    got = rows(mart, *columns)
    # 36 hours late is one full day; without an end there is no delay; exactly on plan is no delay.
    assert [r[:5] for r in got] == [(1, 10, 1, 1, 1), (2, None, 0, 0, 0), (3, 9, 0, 1, 0), (4, -2, 0, 0, 0)]
    assert got[0][5:] == (D("17.00000"), D("2.00000"))
    assert got[1][6] is None and got[3][5:] == (None, None)


def test_latest_shipping_status_keeps_equal_times(table, rows):
    df = table(SHIPPING, [shipment(1, "a", "booked", ts(1), ts(9)), shipment(1, "b", "x", ts(2), ts(9)), shipment(1, "c", "y", ts(2), ts(9)), shipment(1, "c", "y", ts(2), ts(9))])
    assert rows(sh.shipping_status(df), "status", "shipping_start_fact_datetime") == [("b", ts(1)), ("c", ts(1))]
    assert len(rows(sh.latest_states(df))) == 3


# Retention

LOG = (
    "id long, date_time timestamp_ntz, city_id int, city_name string, customer_id long, first_name string, last_name string,"
    "item_id int, item_name string, quantity int, payment_amount decimal(14,2), status string"
)


def sale(i, at, customer, item, status, amount="10.00", quantity=1):
    return (i, at, 1, "c", customer, "f", "l", item, "i", quantity, D(amount), status)


def test_order_log(table, rows):
    df = table(LOG, [sale(5, ts(1), 1, 1, None), sale(4, ts(1), 1, 1, None), sale(6, ts(1), 1, 1, "refunded"), sale(7, ts(1), 1, 1, "shipped")])
    assert rows(re.prepare_order_log(df), "id", "payment_amount", "status") == [
        (4, D("10.00"), "shipped"),
        (6, D("-10.00"), "refunded"),
        (7, D("10.00"), "shipped"),
    ]


def test_weekly_retention(spark, table, rows):
    days = re.calendar(spark, "2020-12-01", "2021-02-01")
    log = table(
        LOG,
        [
            sale(1, ts(31, month=12, year=2020), 1, 1, "shipped"),
            sale(2, ts(3, year=2021), 2, 1, "shipped", quantity=2),
            sale(3, ts(4, year=2021), 2, 1, "refunded"),
            sale(4, ts(4, year=2021), 3, 2, "refunded"),
            sale(5, ts(3, year=2021), 2, 1, "shipped", "1.00"),
        ],
    )
    sales = re.fact_sales(re.prepare_order_log(log), days)
    assert rows(sales, "date_id") == [(20201231,), (20210103,), (20210103,), (20210104,), (20210104,)]
    got = rows(re.customer_retention(sales, days))
    assert got == [
        (0, 1, 1, "2021-W01", 2, 1, D("0.00"), D("-10.00"), 1),
        (1, 0, 1, "2021-W01", 2, 2, D("-10.00"), D("0.00"), 1),
        (1, 1, 0, "2020-W53", 1, 1, D("10.00"), D("21.00"), 0),
    ]
    strict = rows(re.customer_retention(sales, days, strict=True))
    # Customer 2 refunded later, so all its rows of the week count.
    assert strict == [(1, 1, 1, "2020-W53", 1, 1, D("10.00"), D("21.00"), 2)]
    assert len(rows(re.fact_sales(re.prepare_order_log(log), days, "2021-01-03"))) == 2


# Couriers


def test_ledger_tiers_and_shared_order_times(table, rows):
    staging = table(
        "order_id string, order_ts timestamp_ntz, delivery_id string, courier_id string, address string, delivery_ts timestamp_ntz,"
        "rate int, sum decimal(14,2), tip_sum decimal(14,2)",
        [
            ("1", ts(1), "d1", "a", "x", ts(2), 4, D("10"), D("1000")),
            ("2", ts(1), "d2", "a", "x", ts(2), 5, D("20"), D("2000")),
            ("3", ts(5, month=2), "d3", "a", "x", ts(6, month=2), None, D("5"), None),
            ("4", ts(1), "d4", "unknown", "x", ts(2), 4, D("10"), D("1000")),
        ],
    )
    who = co.with_ids(co.couriers(table("courier_id string, courier_name string", [("a", "Ann")])), "courier_id")
    when = co.with_ids(co.timestamps(staging), "ts")
    assert when.count() == 2
    facts = co.deliveries(staging, who, when)
    assert facts.count() == 3
    got = rows(co.courier_ledger(facts, who, when))
    assert got == [
        ("a", "Ann", 2024, 1, 2, D("30.00"), D("4.50"), D("750.00"), D("210.00"), D("3000.00"), D("3060.00")),
        ("a", "Ann", 2024, 2, 1, D("5.00"), D("0.00"), D("0.00"), D("100.00"), D("0.00"), D("100.00")),
    ]
    month = rows(co.courier_ledger(facts, who, when, month_of="2024-02-02"), "settlement_month")
    assert month == [(1,)]
    by_sum = rows(co.courier_ledger(facts, who, when, base="sum"), "settlement_month", "order_processing_fee")
    assert by_sum == [(1, D("7.50")), (2, D("1.25"))]


def test_json_staging(table, rows):
    df = table("object_id string, object_value string, update_ts timestamp_ntz", [("1", '{"name": "A"}', ts(1)), ("1", '{"name": "B"}', ts(2)), ("2", "broken", ts(1))])
    assert rows(co.couriers(df)) == [("1", "B"), ("2", None)]
    assert rows(co.couriers(df, "2024-01-01")) == [("1", "A"), ("2", None)]
    parsed = co.parse_staging_json(table("object_id string, object_value string", [("7", '{"rate": 5, "sum": 1.5, "order_ts": "2024-01-01 10:00:00"}'), ("8", "x")]), co.DELIVERY_FIELDS)
    assert rows(parsed, "object_id", "rate", "sum", "order_ts") == [("7", 5, D("1.50"), ts(1, 10)), ("8", None, None, None)]


# Messenger


def test_groups(table, rows):
    log = table(
        "group_id int, user_id int, user_id_from int, event string, event_dt timestamp_ntz",
        [(g, u, 1, "add", ts(g)) for g in range(1, 12) for u in (1, 2)] + [(2, 1, 1, "add", ts(2)), (3, 3, None, "leave", ts(20)), (99, None, 1, "add", ts(1))],
    )
    users = table("user_id int", [(1,), (2,), (3,)]).withColumn("hk_user_id", hash_key("user_id"))
    groups = log.where("group_id < 99").groupBy("group_id").agg(F.min("event_dt").alias("registration_dt")).withColumn("hk_group_id", hash_key("group_id"))
    link = me.link_user_group(log, users, groups)
    assert link.count() == 23
    assert me.link_user_group(log, users, groups, link).count() == 0
    auth = me.sat_auth_history(log, users, groups, link)
    assert auth.count() == 23
    assert me.sat_auth_history(log, users, groups, link, auth).count() == 0
    added = me.added_users(groups, link, auth)
    assert sorted(r["cnt_added_users"] for r in added.collect()) == [2] * 10
    assert (None, 0) in rows(me.added_users(groups, link, auth, keep_unmatched=True))
    written = table("group_id int, message_id int, user_id int", [(1, 1, 1), (1, 2, 1), (2, 3, 2), (2, 4, 1)])
    dialogs = written.select(hash_key("group_id").alias("hk_group_id"), F.col("message_id").alias("hk_message_id"))
    messages = written.select(F.col("message_id").alias("hk_message_id"), hash_key("user_id").alias("hk_user_id"))
    conversion = me.group_conversion(groups, link, auth, dialogs, messages).collect()
    assert [r["group_conversion"] for r in conversion[:3]] == [1.0, 0.5, 0.0] and len(conversion) == 10
    assert len(me.fewest(me.active_users(groups, dialogs, messages), "cnt_users_in_group_with_messages").collect()) == 10


# Geo


def visits(table, data):
    schema = "user_id int, message_id int, message_ts timestamp_ntz, date date, event_type string, zone_id int, city string"
    full = [(u, i, t, t.date(), kind, ord(c), c) for i, (u, t, kind, c) in enumerate(data)]
    return table(schema, full)


def test_home_city_and_travel(table, rows):
    def stay(user, days):
        first = datetime(2024, 1, 1)
        return [(user, first, "message", "A"), (user, first.replace(month=1 + days // 31, day=1 + days % 31), "message", "B")]

    data = stay(1, 26) + stay(2, 27) + stay(3, 28) + [(4, ts(1), "message", "A"), (4, ts(30), "message", "A")]
    data += [(5, ts(1), "message", "A"), (5, ts(2), "message", "B"), (5, ts(31), "message", "A"), (5, ts(31, 1), "message", "A")]
    df = visits(table, data)
    # 26 days are too short; user 4 never moves; user 5 stayed longest in B.
    assert ge.busy_users(df) is None
    every = df.select("user_id").distinct()
    for hot in (None, every):
        assert rows(ge.home_city(df, hot=hot)) == [(2, "A"), (3, "A"), (5, "B")]
    assert rows(ge.home_city(df, 27, "2024-03-15", include_open_stay=True)) == [(1, "B"), (2, "B"), (3, "B"), (4, "A"), (5, "A")]
    assert rows(ge.travel(df)) == [(1, 1, ["B"]), (2, 1, ["B"]), (3, 1, ["B"]), (5, 2, ["B", "A"])]
    mart = {r["user_id"]: r for r in ge.user_geo(df, zones={"A": "Australia/Perth"}).collect()}
    assert mart[4]["travel_count"] == 0 and mart[4]["travel_array"] == [] and mart[4]["home_city"] is None
    assert mart[4]["local_time"] == ts(30, 8) and mart[1]["local_time"] == datetime(2024, 1, 27, 11)


def test_zone_metrics(table, rows):
    df = visits(
        table,
        [
            (1, datetime(2024, 1, 31), "message", "A"),
            (1, datetime(2024, 2, 1), "message", "A"),
            (2, datetime(2024, 2, 1), "message", "A"),
            (3, datetime(2024, 2, 1), "reaction", "B"),
        ],
    )
    got = rows(ge.zone_metrics(df), "month", "week", "zone_id", "week_message", "week_reaction", "week_user", "month_message", "month_user")
    week = date(2024, 1, 29)
    # One ISO week across two months; a zone without messages has zeros.
    assert got == [
        (date(2024, 1, 1), week, 65, 1, 0, 1, 1, 1),
        (date(2024, 2, 1), week, 65, 2, 0, 1, 2, 1),
        (date(2024, 2, 1), week, 66, 0, 1, 0, 0, 0),
    ]
    assert rows(ge.zone_month(df), "month", "zone_id", "month_message") == [(date(2024, 1, 1), 65, 1), (date(2024, 2, 1), 65, 2), (date(2024, 2, 1), 66, 0)]


def test_friends(spark, table, rows):
    step = 1 / 111.19492664
    day = date(2024, 1, 2)
    moved = [
        # sender, receiver, latitude in km, kind, channel
        (1, 90, 0.0, "message", None),
        (2, 91, 0.99, "message", None),
        (3, 92, 1.985, "message", None),
        (4, 93, 0.5, "message", None),
        (4, 1, 50.0, "message", None),
        (5, 94, 0.2, "message", None),
    ]
    subscribed = [(1, 7), (1, 8), (2, 7), (2, 8), (3, 7), (4, 7), (5, 9)]
    data = [((i, a, b, ts(2, i), None, a), kind, day, lat * step, 10.0) for i, (a, b, lat, kind, _) in enumerate(moved)]
    data += [((100 + i, u, None, ts(3), c, u), "subscription", date(2024, 1, 3), None, None) for i, (u, c) in enumerate(subscribed)]
    events = table(
        "event struct<message_id:int,message_from:int,message_to:int,message_ts:timestamp_ntz,subscription_channel:int,user:int>,"
        "event_type string, date date, lat double, lon double",
        data,
    )
    cities = table("id int, city string, lat double, lng double", [(1, "Perth", 0.0, 10.0), (2, "Sydney", 40.0, 10.0)])
    located = ge.assign_city(events, cities)
    got = rows(ge.recommend_friends(located, processed="2024-02-01 00:00:00"), "user_left", "user_right", "zone_id", "local_time")
    # 1-2 are 0.99 km apart; 2-3 0.995 km; 1-4 wrote to each other; 5 shares no channel; two shared channels give one row.
    assert [(r[0], r[1]) for r in got] == [(1, 2), (2, 3), (2, 4)]
    assert got[0] == (1, 2, 1, ts(2, 8))


# Promotions


def test_campaigns(table, rows):
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pr.CAMPAIGN_FIELDS if f.name != "adv_campaign_owner")
    now = 1705276800000
    campaigns = table(
        columns,
        [
            ("r", "start", "c", "o", now, now + 5, 1),
            ("r", "end", "c", "o", now - 5, now, 1),
            ("r", "late", "c", "o", now + 1, now + 5, 1),
            ("r", "seconds", "c", "o", now // 1000 - 5, now // 1000 + 5, 1),
            ("r", "start", "again", "o", now, now + 5, 2),
        ],
    )
    active = pr.active_campaigns(campaigns, "2024-01-15 00:00:00")
    assert rows(active, "adv_campaign_id") == [("end",), ("start",), ("start",)]
    clients = table("restaurant_id string, client_id long", [("r", 1), ("r", 1), ("r", 2), ("q", 3)])
    triggers = pr.campaign_triggers(active, clients, "2024-01-15 00:00:00")
    assert rows(triggers, "adv_campaign_id", "client_id", "adv_campaign_content") == [("end", 1, "c"), ("end", 2, "c"), ("start", 1, "c"), ("start", 2, "c")]
    payload = pr.trigger_payload(triggers).first()
    assert payload["key"] == str(now) and payload["value"].startswith('{"restaurant_id":"r"')
    assert pr.feedback_rows(triggers).columns[-1] == "feedback"


# Vault


@pytest.fixture
def messages(table):
    product = [("p1", "soup", "Borscht"), ("p1", "soup", "Borscht"), ("p2", "tea", "Green")]
    data = [
        ("1", ("1", ts(1), D("10.00"), D("9.00"), "CLOSED", ("r", "Rest"), ("u", "Ann"), product), ts(1, 1)),
        ("1", ("1", ts(1), D("10.00"), D("9.00"), "CLOSED", ("r", "Rest"), ("u", "Ann"), product), ts(1, 2)),
        ("2", ("2", ts(2), D("5.00"), D("5.00"), "CLOSED", ("r", "Rest"), ("u", "Anna"), product[2:]), ts(2, 1)),
    ]
    return table(f"object_id string, payload {va.PAYLOAD.simpleString()}, load_dt timestamp_ntz", data)


def test_vault_tables(messages, rows):
    tables = va.vault_tables(va.explode_products(messages))
    assert len(tables) == 14
    assert {n: t.count() for n, t in tables.items()} == {
        "h_restaurant": 1,
        "h_user": 1,
        "h_product": 2,
        "h_category": 2,
        "h_order": 2,
        "l_order_user": 2,
        "l_product_category": 2,
        "l_product_restaurant": 2,
        "l_order_product": 3,
        "s_user_names": 2,
        "s_order_cost": 2,
        "s_order_status": 2,
        "s_restaurant_names": 1,
        "s_product_names": 2,
    }
    assert rows(tables["h_order"], "order_id", "load_dt") == [("1", ts(1, 1)), ("2", ts(2, 1))]
    for name, table in tables.items():
        key = table.columns[0]
        assert table.select(key).distinct().count() == table.count(), name


def test_order_message_agrees_with_the_tables(messages, rows):
    out = va.order_message(messages)
    tables = va.vault_tables(va.explode_products(messages))
    body = out.select(F.from_json("payload", "l_order_product array<struct<hk_order_product_pk:string>>, s_product_names array<struct<hk_product_names_pk:string,name:string>>").alias("b"))
    keys = body.select(F.explode("b.l_order_product.hk_order_product_pk").alias("k")).distinct()
    assert rows(keys) == rows(tables["l_order_product"], "hk_order_product_pk")
    names = body.select(F.explode("b.s_product_names").alias("n")).select("n.*").distinct()
    assert rows(names) == rows(tables["s_product_names"], "hk_product_names_pk", "name")
    counted = va.counter_rows(out)
    direct = va.natural_counter_rows(va.explode_products(messages))
    assert rows(va.user_product_counters(counted, hashed=True)) == rows(va.user_product_counters(direct))
    assert rows(va.user_category_counters(counted, hashed=True)) == rows(va.user_category_counters(direct))


def test_counters_count_an_order_once(messages, rows):
    got = va.natural_counter_rows(va.explode_products(messages))
    assert rows(va.user_product_counters(got), "product_name", "order_cnt") == [("Borscht", 1), ("Green", 2)]
    assert rows(va.user_category_counters(got), "category_name", "order_cnt") == [("soup", 1), ("tea", 2)]
    assert rows(va.user_category_counters(got, per_product=True), "category_name", "order_cnt") == [("soup", 1), ("tea", 2)]


# Currency


def test_turnover(table, rows):
    tx = table(
        "operation_id string, account_number_from int, account_number_to int, currency_code int, status string, amount int, transaction_dt timestamp_ntz",
        [
            ("a", 1, 2, 430, "done", -100, ts(1, 5)),
            ("b", 1, 2, 430, "done", 51, ts(1)),
            ("c", 3, 2, 420, "done", 7, ts(1)),
            ("d", 3, 2, 440, "done", 7, ts(1)),
            ("e", -3, 2, 430, "done", 7, ts(1)),
            ("f", 3, 2, 430, "queued", 7, ts(1)),
            ("g", 3, 2, 430, "done", 7, ts(2)),
        ],
    )
    rates = table(
        "currency_code int, currency_code_with int, date_update timestamp_ntz, currency_with_div decimal(14,2)",
        [(430, 420, ts(1), D("1.10")), (430, 421, ts(1), D("9.00")), (430, 420, ts(2), D("2.00"))],
    )
    got = rows(cu.global_metrics(tx, rates))
    day = date(2024, 1, 1)
    assert got == [
        (day, 420, D("7.00"), 1, D("7.00"), 1),
        (day, 430, D("166.10"), 2, D("83.05"), 1),
        (day, 440, None, 1, None, 1),
        (date(2024, 1, 2), 430, D("14.00"), 1, D("14.00"), 1),
    ]
    assert len(rows(cu.global_metrics(tx, rates, after="2024-01-01"))) == 1
    assert rows(cu.missing_rates(tx, rates)) == [(day, 440, 1)]
    done = cu.global_metrics(tx, rates)
    assert cu.high_water_mark(done) == "2024-01-02"
    assert cu.high_water_mark(None) == cu.high_water_mark(done.where("false")) == "1900-01-01"


def test_vault_tables_bound_what_a_task_reads(spark, table):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rows = table("order_id long, product_id long, load_dt date", [(1, 2, date(2024, 1, 1))])
    spark.conf.unset(key)
    try:
        assert va.link(rows, "l_order_product").count() == 1
        assert spark.conf.get(key) in ("16m", "16777216b")
        spark.conf.set(key, "8m")
        va.link(rows, "l_order_product")
        assert spark.conf.get(key) in ("8m", "8388608b")
    finally:
        spark.conf.unset(key)
