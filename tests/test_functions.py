import uuid
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from martwright import functions as fn


def one(df, column):
    return df.select(column.alias("x")).first()["x"]


def test_uuid3_equals_the_standard_library(table):
    names = ["1", "", "Öl", "a" * 300, "7f3c"]
    df = table("name string", [(n,) for n in names])
    got = {r["name"]: r["u"] for r in df.select("name", fn.uuid3("name").alias("u")).collect()}
    assert got == {n: str(uuid.uuid3(uuid.NAMESPACE_OID, n)) for n in names}
    both = df.agg(F.collect_list("name").alias("l")).select("l", fn.uuid3_each(F.col("l")).alias("u")).first()
    assert both["u"] == [str(uuid.uuid3(uuid.NAMESPACE_OID, n)) for n in both["l"]]


def test_hash_key_is_null_with_a_null_part(table):
    df = table("a string, b string", [("x", None), ("x", "y")])
    got = [r[0] for r in df.orderBy("b").select(fn.hash_key("a", "b")).collect()]
    assert got[0] is None and len(got[1]) == 32


@pytest.mark.parametrize(
    "text, n, expected",
    [("a:b:c", 3, "c"), ("a:b:c", 4, None), ("", 1, ""), ("a:b:c:d:e", 4, "d"), (None, 1, None)],
)
def test_split_part(table, text, n, expected):
    assert one(table("t string", [(text,)]), fn.split_part("t", ":", n)) == expected


def test_split_part_takes_the_separator_literally(table):
    assert one(table("t string", [("a|b.c",)]), fn.split_part("t", "|", 2)) == "b.c"


@pytest.mark.parametrize(
    "day, week",
    [("2020-12-31", "2020-W53"), ("2021-01-03", "2020-W53"), ("2021-01-04", "2021-W01"), ("2018-12-31", "2019-W01")],
)
def test_iso_week_at_new_year(table, day, week):
    assert one(table("d string", [(day,)]), fn.iso_week(F.to_date("d"))) == week


@pytest.mark.parametrize(
    "rate, tips, pay",
    [
        (3.99, "1000", "100"),
        (3.99, "4000", "200"),
        (3.99, "2000", "100"),
        (4.0, "1000", "150"),
        (4.5, "10000", "700"),
        (4.51, "10000", "800"),
        (4.9, "10000", "800"),
        (4.91, "10000", "1000"),
        (5.0, "1000", "200"),
        (None, "1000", None),
        (4.2, None, None),
    ],
)
def test_courier_pay_tiers(table, rate, tips, pay):
    df = table("r double, t decimal(14,2)", [(rate, None if tips is None else D(tips))])
    got = one(df, fn.courier_pay("r", "t"))
    assert got == (None if pay is None else D(pay))


def test_amounts(table):
    df = table("s string, a decimal(14,2)", [("refunded", D("5.00")), ("shipped", D("5.00")), ("lost", D("5.00")), (None, D("5.00"))])
    got = {r["s"]: r["x"] for r in df.select("s", fn.signed_amount("s", "a").alias("x")).collect()}
    assert got == {"refunded": D("-5.00"), "shipped": D("5.00"), "lost": None, None: None}
    assert one(df.limit(1), fn.rounded_ratio(F.lit(D("1.01")), F.lit(2))) == D("0.51")
    assert one(df.limit(1), fn.rounded_ratio(F.lit(D("1.01")), F.lit(0))) is None
    assert one(df.limit(1), fn.to_base(F.lit(-7), F.lit(D("1.50")))) == D("10.50")


def test_days_are_cut_toward_zero(table):
    df = table("a timestamp_ntz, b timestamp_ntz", [(datetime(2024, 1, 1), datetime(2024, 1, 3, 12)), (datetime(2024, 1, 3, 12), datetime(2024, 1, 1))])
    assert sorted(r[0] for r in df.select(fn.whole_days("a", "b")).collect()) == [-2, 2]
    assert sorted(r[0] for r in df.select(fn.delay_days("b", "a")).collect()) == [0, 2]


def test_distance(table):
    df = table("a double, b double, c double, d double", [(-33.8688, 151.2093, -37.8136, 144.9631), (0.0, 0.0, 0.0, 180.0)])
    got = [r[0] for r in df.select(fn.haversine_km("a", "b", "c", "d")).collect()]
    assert got[0] == pytest.approx(713.4, abs=0.5) and got[1] == pytest.approx(20015.09, abs=0.01)


def test_decimal_comma(table):
    df = table("t string", [("-33,8650",), ("x",)])
    assert sorted((r[0] for r in df.select(fn.parse_decimal_comma("t")).collect()), key=str) == [-33.865, None]


def test_local_time_falls_back_to_the_default_zone(table):
    df = table("ts timestamp_ntz, city string", [(datetime(2024, 1, 1), "Perth"), (datetime(2024, 1, 1), "Nowhere"), (datetime(2024, 7, 1), None)])
    got = df.select("city", fn.local_time("ts", "city", {"Perth": "Australia/Perth"}, "Australia/ACT").alias("t")).collect()
    assert {r["city"]: r["t"] for r in got} == {
        "Perth": datetime(2024, 1, 1, 8),
        "Nowhere": datetime(2024, 1, 1, 11),
        None: datetime(2024, 7, 1, 10),
    }


def test_clock_helpers(table):
    df = table("ts timestamp_ntz", [(datetime(2024, 1, 1, 7, 5, 9),)])
    assert one(df, fn.time_of("ts")) == "07:05:09"
    assert one(df, fn.now_ms("2024-01-15 00:00:00")) == 1705276800000
    assert abs(one(df, fn.now_ms()) / 1000 - datetime.now().timestamp()) < 60
    assert one(df, fn.at_day("2024-02-29")) == date(2024, 2, 29)
    assert fn.previous_month_of("2024-01-31") == (2023, 12)
    assert fn.previous_month_of("2024-03-31") == (2024, 2)


def test_text_helpers(table):
    df = table("t string, j string", [("", '{"name": "A"}')])
    assert one(df, fn.fill_blank("t", "0")) == "0"
    assert one(df, fn.json_field("j", "name")) == "A"
    assert one(df, fn.json_field("j", "none")) is None
    assert one(df, fn.default(F.lit(None).cast("string"), "d")) == "d"
    assert one(df, fn.flag(F.lit(None).cast("boolean"))) == 0
