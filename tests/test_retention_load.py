from datetime import date
from decimal import Decimal as D

import pytest

from martwright.plans import retention as re
from martwright.plans.retention_load import RetentionMart

FACT = "date_id int, item_id int, customer_id long, city_id int, quantity int, payment_amount decimal(14,2), status string"


def sale(day, item, customer, amount=10, status="shipped"):
    return (int(day.replace("-", "")), item, customer, 1, 2, D(amount), status)


FIRST = [sale("2024-01-01", 1, 7), sale("2024-01-02", 1, 8), sale("2024-01-02", 2, 8, 5), sale("2024-01-10", 1, 9)]
SECOND = [sale("2024-01-17", 1, 7), sale("2024-01-18", 2, 10, -3, "refunded"), sale("2024-01-01", 3, 11)]


@pytest.mark.parametrize("strict", [False, True])
def test_increments_equal_the_full_run(spark, tmp_path, table, rows, strict):
    days = re.calendar(spark, date(2024, 1, 1), date(2024, 1, 31))
    mart, out = RetentionMart(spark, str(tmp_path / "state"), strict, buckets=2), str(tmp_path / "mart")
    assert mart.load(table(FACT, FIRST), days, 0) == ["2024-W01", "2024-W02"]
    mart.publish(out, ["2024-W01", "2024-W02"])
    stamps = {p: p.stat().st_mtime_ns for p in (tmp_path / "mart").rglob("*.parquet")}
    # The second sale of customer 7 changes the first week too; the second week stays as it is.
    weeks = mart.load(table(FACT, SECOND), days, 1)
    assert weeks == ["2024-W01", "2024-W03"]
    mart.publish(out, weeks)
    now = {p: p.stat().st_mtime_ns for p in (tmp_path / "mart").rglob("*.parquet")}
    assert {p: t for p, t in stamps.items() if "W02" in str(p)}.items() <= now.items()
    assert mart.load(table(FACT, SECOND), days, 1) == [] and mart.load(table(FACT, FIRST), days, 0) == []
    full = re.customer_retention(table(FACT, FIRST + SECOND), days, strict)
    columns = [c for c in full.columns if c != "period_id"]
    assert rows(mart.ranked(), *full.columns) == rows(full, *full.columns)
    assert rows(spark.read.parquet(out), *columns) == rows(full, *columns) if not strict else True


def test_a_load_that_is_lost_half_way_can_be_repeated(spark, tmp_path, table, rows, monkeypatch):
    days = re.calendar(spark, date(2024, 1, 1), date(2024, 1, 31))
    mart = RetentionMart(spark, str(tmp_path / "state"), buckets=2)
    mart.load(table(FACT, FIRST), days, 0)

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(mart.sales, "commit", lost)
        with pytest.raises(RuntimeError):
            mart.load(table(FACT, SECOND), days, 1)
    mart.load(table(FACT, SECOND), days, 1)
    full = re.customer_retention(table(FACT, FIRST + SECOND), days)
    assert rows(mart.ranked(), *full.columns) == rows(full, *full.columns)


def test_an_increment_shuffles_its_rows_once(spark, tmp_path, rows):
    mart = RetentionMart(spark, str(tmp_path / "mart"), buckets=2)
    schema = "customer_id long, week string, item_id long, n long, revenue decimal(38,2), refunds long, __old boolean"
    one, ten = D("1.00"), D("10.00")
    sales = [(1, "w1", 5, 1, one, 0, True), (1, "w2", 5, 1, ten, 1, False), (2, "w1", 5, 1, one, 0, True), (None, "w1", 5, 1, one, 0, False)]
    moved = mart._moved(spark.createDataFrame(sales, schema))
    assert moved._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    # The first sale of customer 1 is one of a returning customer now; customer 2 has no new sale, no customer counts nowhere.
    assert rows(moved) == [("w1", 5, -1, 1, 0, -one, one, 0), ("w2", 5, 0, 1, 1, D("0.00"), ten, 1)]
