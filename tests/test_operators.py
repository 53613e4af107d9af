import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martwright import operators as op
from martwright.operators.changes import _segment_scan


@pytest.mark.parametrize("n_rows", [0, 1, 3, 5, 7, 1003])
def test_ntile_equals_the_window_function(spark, rows, n_rows):
    rng = random.Random(n_rows)
    data = [(i, rng.choice([None, 0, 0, 0, 1, 2, rng.randint(0, 99)])) for i in range(n_rows)]
    df = spark.createDataFrame(data, "id long, v int")
    order = F.col("v").asc_nulls_first()
    expected = df.withColumn("b", F.ntile(5).over(Window.orderBy(order, "id")))
    assert rows(op.ntile_score(df, order, "id", "b"), "id", "b") == rows(expected, "id", "b")


def test_ntile_spreads_one_value_over_partitions(spark):
    df = spark.range(10_000).select("id", F.lit(0).alias("v"))
    sizes = [r["count"] for r in op.ntile_score(df, F.col("v").asc(), "id", "b", 7).groupBy("b").count().collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1


def test_scores_of_several_measures(spark, rows):
    df = spark.range(1003).select("id", (F.col("id") * 37 % 101).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("b"))
    got = op.ntile_scores(df, "id", {"x": F.col("a"), "y": F.col("b")}, null_score=1)
    wx = Window.orderBy("a", "id")
    wy = Window.orderBy(F.col("b").asc_nulls_first(), "id")
    expected = df.select(
        "id", F.ntile(5).over(wx).alias("x"), F.when(F.col("b").isNull(), 1).otherwise(F.ntile(5).over(wy)).alias("y")
    )
    assert rows(got, "id", "x", "y") == rows(expected)


def test_scores_keep_all_digits_and_types(spark, rows):
    df = spark.range(5).select(
        "id",
        ((4 - F.col("id")).cast("decimal(10,4)") / 1000).cast("decimal(12,6)").alias("small"),
        (F.lit(1.0) - F.col("id") * 1e-7).alias("real"),
        (F.lit(5) - F.col("id")).cast("int").alias("whole"),
        F.date_sub(F.lit("2024-01-09").cast("date"), F.col("id").cast("int")).alias("day"),
    )
    measures = {f"s_{c}": F.col(c) for c in ("small", "real", "whole", "day")}
    got = op.ntile_scores(df, "id", measures)
    assert rows(got, *["id", *measures]) == [(i, *[5 - i] * 4) for i in range(5)]


def test_number_rows_per_group_with_a_hot_group(spark, rows):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("g"))
    expected = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("id"))))
    assert rows(op.number_rows(df, [F.desc("id")], "n", ["g"]), "id", "n") == rows(expected, "id", "n")


def test_surrogate_ids_are_stable_and_dense(table, rows):
    df = table("a string, b int", [("x", 2), ("x", None), ("a", 9), (None, 1)])
    assert rows(op.surrogate_id(df, ["a", "b"], "id"), "id", "a", "b") == [(1, None, 1), (2, "a", 9), (3, "x", None), (4, "x", 2)]


def test_period_rank(table, rows):
    df = table("w string, v int", [("b", 1), ("a", 2), ("b", 3), (None, 4)])
    assert rows(op.period_rank(df, "w", "r"), "v", "r") == [(1, 2), (2, 1), (3, 2), (4, None)]


def test_first_by_takes_ties_by_order(table, rows):
    df = table("k int, t int, v string", [(1, 5, "a"), (1, 5, "b"), (2, None, "c"), (None, 1, "d"), (None, 2, "e")])
    got = op.first_by(df, ["k"], [F.col("t").desc_nulls_first(), F.col("v").desc()])
    assert rows(got) == [(1, 5, "b"), (2, None, "c"), (None, 2, "e")]


def test_first_by_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = op.first_by(df, ["k"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Partial") > plan.index("Exchange")


def test_dedupe_keeps_the_lowest_id_and_equal_nulls(table, rows):
    df = table("id int, a int, b string", [(3, 1, None), (1, 1, None), (2, 1, "x")])
    assert rows(op.dedupe(df, ["a", "b"], "id")) == [(1, 1, None), (2, 1, "x")]


def test_previous_value_equals_lag_for_a_hot_key(spark, rows):
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    data = [
        (0 if i % 3 == 0 else rng.randint(1, 60), start + timedelta(minutes=rng.randint(0, 4000)), i, rng.choice("abc"))
        for i in range(4000)
    ]
    df = spark.createDataFrame(data, "k int, ts timestamp_ntz, id int, v string")
    expected = df.withColumn("prev_v", F.lag("v").over(Window.partitionBy("k").orderBy("ts", "id")))
    assert op.hot_keys(df, "k") is None
    hot = op.hot_keys(df, "k", 1000)
    assert rows(hot) == [(0,)]
    for found in (None, hot, "check"):
        got = op.previous_value(df, "k", "ts", ["id"], ["v"], found)
        assert rows(got, "id", "prev_v") == rows(expected, "id", "prev_v")


def test_previous_value_of_one_key_at_one_time(spark, rows):
    """All rows have one key and one timestamp: no task holds them all, and the plain lag comes out."""
    df = spark.range(20_000).select(
        F.lit(7).alias("k"), F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("ts"), F.col("id").alias("n"), (F.col("id") * 7 % 13).alias("v")
    )
    more = spark.range(30).select((F.col("id") % 3).cast("int").alias("k"), F.lit(None).cast("timestamp_ntz").alias("ts"), F.col("id").alias("n"), F.col("id").alias("v"))
    df = df.unionByName(more).repartition(5)
    hot = spark.createDataFrame([(7,), (2,)], "k int")
    found = op.previous_value(df, "k", "ts", ["n"], ["v"], hot)
    assert rows(found) == rows(op.previous_value(df, "k", "ts", ["n"], ["v"], None))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        scan = _segment_scan(df, "k", ["ts", "n"], F.struct("v"))
        longest = scan.groupBy("__segment").count().agg(F.max("count")).first()[0]
        assert rows(scan.where("k = 7").select("n", "v", "__prev.v").toDF("n", "v", "p")) == rows(
            op.previous_value(df, "k", "ts", ["n"], ["v"], None).where("k = 7").select("n", "v", "prev_v")
        )
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert longest < 20_000 * 0.6
    # Rows that are equal in everything are cut too.
    same = spark.range(5_000).select(F.lit(1).alias("k"), F.lit(None).cast("timestamp_ntz").alias("ts"), F.lit(3).alias("v")).repartition(4)
    linked = op.previous_value(same, "k", "ts", [], ["v"], spark.createDataFrame([(1,)], "k int"))
    assert linked.where("prev_v is null").count() == 1 and linked.count() == 5_000



def test_change_points(table, rows):
    day = [datetime(2024, 1, d) for d in range(1, 6)]
    df = table("k int, ts timestamp_ntz, v string", [(1, day[0], "a"), (1, day[1], "a"), (1, day[2], "b"), (1, day[3], "a"), (2, day[0], "z")])
    assert rows(op.change_points(df, "k", "v", "ts"), "ts", "prev_v", "v") == [(day[2], "a", "b"), (day[3], "b", "a")]
    assert len(rows(op.change_points(df, "k", "v", "ts", keep_first=True))) == 4


def test_lists_in_parts(spark, rows):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), (-F.col("id")).alias("t"), F.col("id").alias("v")).repartition(4)
    parts = op.list_parts(df, ["k"], "v", ["t"], "l", size=40)
    found = {(r.k, r.part): r.l for r in parts.collect()}
    assert max(map(len, found.values())) == 40
    for k in range(3):
        joined = [v for part in range(9) for v in found[k, part]]
        assert joined == [v for v in range(999, -1, -1) if v % 3 == k]
    assert rows(op.list_parts(df.limit(0), ["k"], "v", ["t"], "l")) == []


def test_ordered_list_and_flags(table, rows):
    df = table("k int, t int, v string", [(1, 2, "b"), (1, 1, "c"), (1, 3, "b")])
    assert rows(op.ordered_list(df, ["k"], "v", ["t"], "l")) == [(1, ["c", "b", "b"])]
    assert rows(op.count_flags(df, ["k"], "v", {"b": "nb", "x": "nx"})) == [(1, 2, 0)]


def test_new_members_skip_known_and_null_keys(table, rows):
    log = table("id int, name string, city int", [(1, "a", 5), (2, "b", 1), (2, "b", 7), (None, "n", 1), (3, "c", 2)])
    dim = table("id int, name string", [(1, "a"), (None, None)])
    assert rows(op.new_members(log, dim, "id", ["name"])) == [(2, "b"), (3, "c")]
    assert rows(op.new_members(log, dim, "id", ["name"], pick=["city"])) == [(2, "b", 7), (3, "c", 2)]


def test_insert_new_and_upserts(table, rows):
    target = table("k int, v string", [(1, "a"), (2, "b")])
    batch = table("k int, v string, n int", [(2, "c", 1), (2, "d", 2), (3, "e", 1), (3, "e", 1)])
    assert rows(op.insert_new(target, batch.drop("n"), ["k"])) == [(3, "e")]
    once = op.upsert(target, batch, ["k"], [F.desc("n")]).drop("n")
    twice = op.upsert(once, batch, ["k"], [F.desc("n")]).drop("n")
    assert rows(once) == rows(twice) == [(1, "a"), (2, "d"), (3, "e")]
    counts = table("k int, name string, n long", [(1, "a", 2)])
    more = table("k int, name string, n long", [(1, "a", 3), (2, "b", 1)])
    assert rows(op.upsert_add(counts, more, ["k"], ["n"], ["name"])) == [(1, "a", 5), (2, "b", 1)]


def test_staging_helpers(table, rows):
    df = table("a int, s string", [(1, None), (2, "x")])
    assert rows(op.with_default(df, "s", "shipped")) == [(1, "shipped"), (2, "x")]
    assert rows(op.with_default(df.drop("s"), "s", "shipped")) == [(1, "shipped"), (2, "shipped")]
    assert op.empty_like(df).count() == 0 and op.empty_like(df).schema == df.schema
    meta = op.with_load_meta(df, "s3").first()
    assert meta["load_src"] == "s3" and meta["load_dt"] is not None


def test_exclude_is_not_blinded_by_nulls(table, rows):
    df, other = table("k int", [(1,), (2,), (None,)]), table("k int", [(1,), (None,)])
    assert rows(op.exclude(df, other, ["k"])) == [(2,), (None,)]
    assert rows(op.keep_in(df, other, ["k"])) == [(1,)]


def test_joins_and_lookup(table, rows):
    fact, dim = table("k int, v int", [(1, 10), (9, 90)]), table("k int, name string", [(1, "a"), (2, "b")])
    assert rows(op.lookup(fact, dim, ["k"], ["name"])) == [(1, 10, "a"), (9, 90, None)]
    assert rows(op.lookup(fact, dim, ["k"], ["name"], "inner")) == [(1, 10, "a")]
    assert rows(op.star(fact, [(dim, ["k"], ["name"])])) == rows(op.left(fact, dim, ["k"]))
    assert len(rows(op.full(fact, dim, ["k"]))) == 3 and len(rows(op.inner(fact, dim, ["k"]))) == 1


def test_broadcast_only_when_counted_small(spark):
    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    assert hinted(op.broadcast_if_small(spark.range(10), 160))
    assert not hinted(op.broadcast_if_small(spark.range(11), 160))
    long_text = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert not hinted(op.broadcast_if_small(long_text, 9_000)) and hinted(op.broadcast_if_small(long_text, 11_000))


def test_lookup_needs_no_count(spark):
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup
    before = len(jobs())
    joined = op.lookup(spark.range(10), spark.range(5).withColumn("v", F.lit(1)), ["id"], ["v"])
    assert len(jobs()) == before and "GlobalLimit" not in joined._jdf.queryExecution().toString()


def test_filters(table, rows):
    df = table("ts timestamp_ntz, date date, n int", [(datetime(2024, 1, d, 23, 59), date(2024, 1, d), d) for d in range(1, 6)])
    assert rows(op.on_date(df, "ts", "2024-01-02"), "n") == [(2,)]
    assert rows(op.since(df, "ts", "2024-01-05"), "n") == [(5,)]
    assert rows(op.last_days(df, "2024-01-04", 2), "n") == [(2,), (3,), (4,)]
    assert rows(op.newer_than(df, df.where("n < 3"), "date"), "n") == [(3,), (4,), (5,)]
    assert len(rows(op.newer_than(df, op.empty_like(df), "date"))) == 5
    assert rows(op.having(df.union(df.where("n = 1")), ["n"], F.count(F.lit(1)) > 1)) == [(1,)]
    months = table("y int, m int", [(2023, 12), (2024, 12), (2024, 1)])
    assert rows(op.previous_month(months, "2024-01-15", "y", "m")) == [(2023, 12)]
    spans = table("a long, b long, n int", [(10, 20, 1), (20, 30, 2), (31, 40, 3)])
    at = datetime(1970, 1, 1) + timedelta(milliseconds=20)
    assert rows(op.active_at(spans, "a", "b", at), "n") == [(1,), (2,)]


def test_day_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(datetime(2024, 1, 1), 1)], "ts timestamp_ntz, n int").write.parquet(path)
    plan = op.on_date(spark.read.parquet(path), "ts", "2024-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_status_filter(table, rows):
    orders = table("id int, status int", [(1, 4), (2, 5)])
    statuses = table("id int, key string", [(4, "Closed"), (5, "Cancelled")])
    assert rows(op.with_status(orders, statuses, "closed"), "id") == [(1,)]


def test_quality_rules(table, rows):
    df = table("id int, q int, p int", [(1, 1, 5), (1, 0, None), (None, -1, 7)])
    assert rows(op.unique(df, ["id"])) == [(1, 2)]
    assert rows(op.check(df, "q", F.col("q") > 0), "q") == [(-1,), (0,)]
    assert len(rows(op.not_null(df, ["id", "p"]))) == 2
    assert rows(op.references(df, table("p int", [(5,)]), ["p"]), "p") == [(7,)]
    assert rows(op.defaults(df, {"p": 0}), "p") == [(0,), (5,), (7,)]
    report = op.quality_report("t", df, ["id"], {"q > 0": F.col("q") > 0, "p = 5": F.col("p") == 5}, [["id"]], {"p known": (table("p int", [(5,)]), ["p"])})
    assert rows(report, "rule", "violations") == [
        ("id not null", 1),
        ("p = 5", 1),
        ("p known", 1),
        ("q > 0", 2),
        ("unique (id)", 1),
    ]
    assert rows(op.profile(df, ["id", "q"]), "column_name", "row_count", "null_count", "distinct_values", "min_value", "max_value") == [
        ("id", 3, 1, 1, "1", "1"),
        ("q", 3, 0, 3, "-1", "1"),
    ]


def test_top(table, rows):
    df = table("n int", [(3,), (1,), (2,)])
    assert [r[0] for r in op.top(df, ["n"], 2).collect()] == [1, 2]
    assert [r[0] for r in op.top(df, [F.desc("n")]).collect()] == [3, 2, 1]
    assert rows(op.distinct_rows(df.union(df), ["n"])) == [(1,), (2,), (3,)]
    assert rows(op.fill_zero(table("n int", [(None,)]), ["n"])) == [(0,)]


def test_newer_than_keeps_clock_times(spark, rows):
    df = spark.sql("select * from values (1, timestamp'2000-01-05 09:00'), (2, timestamp'2000-01-05 14:00'), (3, timestamp'2000-01-05 14:01'), (4, timestamp'2000-01-06') t(n, at)")
    assert rows(op.newer_than(df, df.where("n = 2"), "at"), "n") == [(3,), (4,)]
    days = spark.sql("select date'2000-01-05' as at")
    assert rows(op.newer_than(df, days, "at"), "n") == [(4,)]


def test_known_members_keep_their_ids(table, rows):
    first = op.surrogate_id(table("k string", [("b",), (None,)]), ["k"], "id")
    assert rows(first) == [("b", 2), (None, 1)]
    again = op.surrogate_id(table("k string", [("b",), ("a",), (None,), ("c",)]), ["k"], "id", first)
    assert rows(again) == [("a", 3), ("b", 2), ("c", 4), (None, 1)]


def test_rules_are_counted_while_writing(spark, tmp_path, rows):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            runs.add(len(batch))
            yield batch

    df = spark.createDataFrame([(1, 5), (1, None), (2, -1), (9, 3)], "id int, v int").coalesce(1).mapInPandas(count, "id int, v int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    path = str(tmp_path / "mart")
    report = op.write_checked(
        "mart", df, lambda rows: rows.write.parquet(path), lambda: spark.read.parquet(path), ["v"], {"v > 0": F.col("v") > 0}, [["id"]], {"known": (parent, ["id"])}
    )
    expected = [("mart", "known", 1), ("mart", "unique (id)", 1), ("mart", "v > 0", 1), ("mart", "v not null", 1)]
    assert rows(report) == expected and runs.value == 4
    assert rows(op.quality_report("mart", df, ["v"], {"v > 0": F.col("v") > 0}, [["id"]], {"known": (parent, ["id"])})) == expected
    assert runs.value == 8
