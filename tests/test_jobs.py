"""The geo jobs one after the other on files, as a scheduler would start them."""

from datetime import date, datetime, timedelta

from martwright.catalog.adapters import Inputs
from martwright.jobs import JOBS
from martwright.plans import currency, geo, retention
from martwright.sources import mart_path, write_partitioned

FOLDER = "/root/testdata/sf0.001"


def test_geo_jobs(spark, tmp_path, rows):
    t = Inputs(spark, FOLDER)
    raw, ods, out, cities = (str(tmp_path / n) for n in ("raw", "ods", "marts", "cities"))
    write_partitioned(t.geo, raw, ["date", "event_type"], mode="overwrite")
    t.cities.selectExpr("id", "city", "replace(cast(lat as string), '.', ',') lat", "replace(cast(lng as string), '.', ',') lng").write.csv(
        cities, header=True, sep=";"
    )
    when = {"day": "2024-01-20", "depth": "9"}
    JOBS["copy_events"](spark, source=raw, target=ods, **when)
    JOBS["geo_users"](spark, cities=cities, events=ods, out=out, **when)
    JOBS["geo_zones"](spark, out=out, **when)
    JOBS["geo_friends"](spark, out=out, **when)

    def mart(name):
        return spark.read.parquet(mart_path(out, name, "2024-01-20", 9))

    recent = t.geo.where(f"date between date'{date(2024, 1, 11)}' and date'{date(2024, 1, 20)}'")
    located = geo.assign_city(recent, t.cities)
    visits = geo.flatten(located)
    assert rows(mart("geo_event_users")) == rows(geo.user_geo(visits, run_date=when["day"]))
    assert rows(mart("geo_event_zones")) == rows(geo.zone_metrics(visits))
    friends = mart("geo_recommend_friends")
    assert rows(friends.drop("processed_dttm")) == rows(geo.recommend_friends(located).drop("processed_dttm"))
    assert friends.where("processed_dttm is null").count() == 0
    assert mart("geo_event").count() == recent.count()
    assert datetime(2024, 1, 11) <= mart("geo_event").selectExpr("min(event.message_ts)").first()[0]


def test_loads_run_twice(spark, tmp_path, rows):
    t, out = Inputs(spark, FOLDER), str(tmp_path / "out")

    def put(**frames):
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/in/{name}")

    put(users=t.users, orders=t.orders_src, orderitems=t.orderitems, orderstatuses=t.orderstatuses)
    put(shipping=t.shipping, early=t.shipping.where("shippingid % 3 = 0"), transactions=t.transactions, currencies=t.currencies)
    folder = f"{tmp_path}/in"
    JOBS["scores"](spark, tables=folder, out=out, since="2000-01-01")
    assert spark.read.parquet(f"{out}/rfm_segments").count() == t.users.count()

    JOBS["shipping"](spark, log=f"{folder}/early", out=out)
    first = rows(spark.read.parquet(f"{out}/shipping_country_rates"))
    JOBS["shipping"](spark, log=f"{folder}/shipping", out=out)
    second = spark.read.parquet(f"{out}/shipping_country_rates")
    # Ids of the first load are kept, and ids stay unique.
    assert set(first) <= set(rows(second)) and second.count() == second.select("shipping_country_id").distinct().count()

    for _ in range(2):
        JOBS["currency"](spark, tables=folder, out=out)
    assert rows(spark.read.parquet(f"{out}/global_metrics")) == rows(currency.global_metrics(t.transactions, t.currencies))

    first_day = t.user_order_log.selectExpr("min(to_date(date_time))").first()[0]
    last_day = first_day + timedelta(days=100)
    log = t.user_order_log.where(f"to_date(date_time) <= date'{last_day}'")
    log.where("status is null").drop("status").write.option("header", True).csv(f"{tmp_path}/log/1")
    log.where("status is not null").write.option("header", True).csv(f"{tmp_path}/log/2")
    for number in ("1", "2", "2"):
        JOBS["retention"](spark, increment=f"{tmp_path}/log/{number}", out=out, number=number)
    days = retention.calendar(spark, first_day, last_day)
    full = retention.customer_retention(retention.fact_sales(retention.prepare_order_log(log), days), days).drop("period_id")
    assert rows(spark.read.parquet(f"{out}/mart"), *full.columns) == rows(full)
