import math
import random
import re

import pytest
from pyspark.sql import functions as F

from martwright.operators import close_pairs, grid_join, nearest, sharing_pairs, spatial


def km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(min(1.0, h)))


def points(seed, n, spread):
    rng = random.Random(seed)
    return [(i, *spread(rng)) for i in range(n)]


SPREADS = {
    "city": lambda r: (r.uniform(-33.9, -33.8), r.uniform(151.1, 151.3)),
    "antimeridian": lambda r: (r.uniform(-17, -16), r.choice([-1, 1]) * r.uniform(179.9, 180)),
    "north pole": lambda r: (r.uniform(89.5, 90), r.uniform(-180, 180)),
    "south pole": lambda r: (-r.uniform(89.5, 90), r.uniform(-180, 180)),
    "equator": lambda r: (r.uniform(-0.1, 0.1), r.uniform(-0.1, 0.1)),
}


def pairs(spark, a, b, distance, **options):
    left = spark.createDataFrame(a, "i int, lat double, lon double")
    right = spark.createDataFrame(b, "j int, lat_b double, lon_b double")
    return sorted((r["i"], r["j"]) for r in grid_join(left, right, distance, **options).select("i", "j").collect())


@pytest.mark.parametrize("name", SPREADS)
@pytest.mark.parametrize("distance", [0.5, 3.0, 60.0])
def test_grid_join_equals_brute_force(spark, name, distance):
    a, b = points(1, 150, SPREADS[name]), points(2, 150, SPREADS[name])
    expected = sorted((x[0], y[0]) for x in a for y in b if km(x[1:], y[1:]) <= distance)
    assert pairs(spark, a, b, distance) == expected


@pytest.mark.parametrize("distance", [2000.0, 9000.0, 15000.0, 20016.0])
def test_grid_join_over_the_globe(spark, distance):
    def globe(r):
        return (r.uniform(-90, 90), r.uniform(-180, 180))

    a, b = points(3, 60, globe), points(4, 60, globe)
    expected = sorted((x[0], y[0]) for x in a for y in b if km(x[1:], y[1:]) <= distance)
    assert pairs(spark, a, b, distance) == expected


def test_crowded_cells_are_split_without_losing_pairs(spark):
    a, b = points(5, 300, SPREADS["city"]), points(6, 300, SPREADS["city"])
    expected = sorted((x[0], y[0]) for x in a for y in b if km(x[1:], y[1:]) <= 5)
    assert pairs(spark, a, b, 5.0, hot_rows=7) == expected


def test_same_columns_are_required(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0, "x")], "i int, lat double, lon double, d string")
    b = spark.createDataFrame([(1, 0.0, 0.0, "x"), (2, 0.0, 0.0, "y")], "j int, lat_b double, lon_b double, d string")
    assert [r["j"] for r in grid_join(a, b, 1.0, ["d"]).collect()] == [1]


def test_distance_threshold(spark):
    step = 1 / 111.19492664
    a = [(0, 0.0, 0.0)]
    b = [(1, 0.99 * step, 0.0), (2, 1.01 * step, 0.0)]
    assert pairs(spark, a, b, 1.0) == [(0, 1)]


@pytest.mark.parametrize("inline", [0, 200])
def test_nearest_equals_brute_force(spark, inline):
    def globe(r):
        return (r.uniform(-90, 90), r.uniform(-180, 180))

    events, cities = points(7, 200, globe), points(8, 150, globe)
    df = spark.createDataFrame([*events, (999, None, None), (998, math.nan, 1.0), (997, 1.0, math.nan)], "i int, lat double, lon double")
    places = spark.createDataFrame([(i, f"c{i}", *at) for i, *at in cities], "id int, city string, lat double, lon double")
    found = nearest(df, places, "id", ["city"], inline_points=inline)
    got = {r["i"]: (r["id"], r["city"], r["distance_km"]) for r in found.collect()}
    assert [got.pop(i) for i in (997, 998, 999)] == [(None, None, None)] * 3
    for i, *at in events:
        best = min(cities, key=lambda c: km(at, c[1:]))
        assert got[i][:2] == (best[0], f"c{best[0]}")
        assert got[i][2] == pytest.approx(km(at, best[1:]), abs=1e-6)


@pytest.mark.parametrize("inline", [0, 10])
def test_equal_distances_go_to_the_lower_id(spark, inline):
    df = spark.createDataFrame([(1, 0.0, 0.0)], "i int, lat double, lon double")
    places = spark.createDataFrame([(9, "b", 0.0, 1.0), (4, "a", 0.0, -1.0)], "id int, city string, lat double, lon double")
    assert nearest(df, places, "id", ["city"], inline_points=inline).first()["city"] == "a"


def test_both_ways_agree_on_near_ties(spark):
    rng = random.Random(3)
    spots = [(i, round(rng.uniform(50, 51), 2), 10.0) for i in range(200)]
    # Mirrored points: each position has two at nearly the same distance.
    places = [(2 * i + s, f"p{2 * i + s}", 50 + i / 20, 10 + (0.1 if s else -0.1)) for i in range(20) for s in (0, 1)]
    df = spark.createDataFrame(spots, "i int, lat double, lon double")
    cities = spark.createDataFrame(places, "id int, city string, lat double, lon double")
    one, two = (sorted(nearest(df, cities, "id", ["city"], inline_points=n).collect()) for n in (0, 100))
    assert one == two and len(one) == 200


def test_many_points_in_one_city_do_not_meet_all_positions(spark, monkeypatch):
    spots, places = points(11, 4000, SPREADS["city"]), points(12, 1000, SPREADS["city"])
    # Also one place far from all others, so that the search must go on.
    spots.append((4000, 60.0, 20.0))
    df = spark.createDataFrame(spots, "i int, lat double, lon double")
    cities = spark.createDataFrame([(i, f"c{i}", *at) for i, *at in places], "id int, city string, lat double, lon double")
    met, plain = [], spatial._pairs_within

    def counted(*args, **options):
        found = plain(*args, **options)
        met.append(found.count())
        return found

    monkeypatch.setattr(spatial, "_pairs_within", counted)
    got = {r["i"]: r["id"] for r in nearest(df, cities, "id", ["city"], inline_points=0).collect()}
    # The far position meets each of the 1,000 points in the last round.
    assert sum(met) < 0.05 * 4000 * 1000
    for i, *at in spots[::40]:
        assert got[i] == min(places, key=lambda c: km(at, c[1:]))[0]


def test_nearest_without_points(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0)], "i int, lat double, lon double")
    places = spark.createDataFrame([], "id int, city string, lat double, lon double")
    assert nearest(df, places, "id", ["city"]).first()["city"] is None


def test_inline_search_has_no_join_and_no_shuffle(spark):
    df = spark.range(10).select("id", F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"))
    places = spark.createDataFrame([(1, "a", 0.0, 1.0), (2, "b", 0.0, 2.0)], "zone int, city string, lat double, lon double")
    plan = nearest(df, places, "zone", ["city"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_people_of_a_crowded_cell_meet_by_tag(spark, rows):
    """3,000 people at one place in pairs of a tag: 1,500 pairs instead of 4.5 million."""
    spots = spark.range(3000).select(F.col("id").alias("user"), F.lit(0.001).alias("lat"), (F.col("id") % 7 * 0.0001).alias("lon"), F.lit(1).alias("day"))
    members = spark.range(3000).select(F.col("id").alias("user"), (F.col("id") % 1500).alias("tag"))
    cells = spots.withColumn("__band", F.lit(0)).withColumn("__cell", F.lit(0))
    assert sharing_pairs(cells, cells, members, "user", "tag", ["day", "__band", "__cell"]).count() == 1500
    found = close_pairs(spots, members, 1.0, "user", "tag", ["day"])
    assert rows(found, "user_left", "user_right") == sorted(((i, i + 1500) for i in range(1500)), key=repr)


@pytest.mark.parametrize("hot_rows", [20_000, 5])
def test_close_pairs_equal_brute_force(spark, rows, hot_rows):
    r = random.Random(8)
    spots = [(r.randrange(25), r.choice([0, 1]), r.uniform(-0.02, 0.02), r.choice([179.995, -179.995, 0.0]) + r.uniform(-0.01, 0.01)) for _ in range(150)]
    spots += [(None, 0, 0.0, 0.0), (3, 0, None, 0.0)]
    tags = sorted({(r.randrange(25), r.randrange(6)) for _ in range(40)})
    without = [(1, 2), (3, 9)]
    df = spark.createDataFrame(spots, "user int, day int, lat double, lon double").distinct()
    members = spark.createDataFrame(tags, "user int, tag int")
    found = close_pairs(df, members, 1.0, "user", "tag", ["day"], without=spark.createDataFrame(without, "user_left int, user_right int"), hot_rows=hot_rows)
    shared = {(a, b) for a, x in tags for b, y in tags if x == y and a < b} - set(without)
    right = df.toDF("user_right", "day", "lat_b", "lon_b")
    every = grid_join(df.dropna().withColumnRenamed("user", "user_left"), right.dropna(), 1.0, ["day"])
    expected = [x for x in rows(every, "user_left", "user_right", "day", "lat", "lon") if x[:2] in shared]
    assert expected and rows(found, "user_left", "user_right", "day", "lat", "lon") == expected


def test_spots_of_close_pairs_are_never_broadcast(spark):
    # Their sizes are guessed from before they were repeated per cell.
    spots = spark.range(2).select(F.col("id").alias("user"), F.lit("a").alias("day"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"))
    members = spark.range(2).select(F.col("id").alias("user"), F.lit("x").alias("tag"))
    found = close_pairs(spots, members, 1.0, "user", "tag", ["day"])
    plan = found._jdf.queryExecution().sparkPlan().toString()
    joins = re.findall(r"(\w*Join) \[user_(?:left|right)#", plan)
    assert joins == ["SortMergeJoin", "SortMergeJoin"], plan
    assert found.count() == 1


def test_meetings_of_pairs_are_not_shuffled(spark):
    spots = spark.range(20).select(F.col("id").alias("user"), F.lit("a").alias("day"), (F.col("id") * 0.001).alias("lat"), F.lit(0.0).alias("lon"))
    members = spark.range(20).select(F.col("id").alias("user"), (F.col("id") % 2).alias("tag"))
    blocks = spatial.PairBlocks(spots, "user", hot_rows := 4)
    assert blocks.groups == 20 // hot_rows
    met = close_pairs(spots, members, 1.0, "user", "tag", ["day"], blocks=blocks)
    pair = [blocks.column, "user_left", "user_right"]
    found = met.groupBy(*pair).agg(F.min("distance_km")).join(blocks.pairs(spark.createDataFrame([(0, 2)], "user_left long, user_right long")), pair, "left_anti")
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    join = next(line for line in plan.splitlines() if "SortMergeJoin [__hash" in line)
    # What stands above the join of spots, and what it is fed with besides sorts and columns, is dealt by block only.
    above = plan[: plan.index(join)]
    assert "Exchange" not in above and plan.count("shufflepartitionidpassthrough") == 3, plan
    km_of = {(a, b): (b - a) * 0.1112 for a in range(20) for b in range(a + 1, 20)}
    assert {r[1:3] for r in map(tuple, found.collect())} == {p for p, km in km_of.items() if km <= 1 and (p[1] - p[0]) % 2 == 0} - {(0, 2)}


@pytest.mark.parametrize("bits", [0, 2, 63])
def test_broad_and_rare_tags_meet_by_place(spark, rows, monkeypatch, bits):
    monkeypatch.setattr(spatial, "BITS", bits)
    r = random.Random(5)
    spots = spark.createDataFrame(sorted({(r.randrange(12), r.uniform(0, 0.02)) for _ in range(60)}), "user int, lat double").withColumn("lon", F.lit(0.0)).withColumn("day", F.lit(1))
    tags = sorted({(u, t) for u in range(12) for t in ("x", "y", *"abcdefgh"[u % 8]) if t > "h" and u % 3 or t <= "h"})
    held = {u: {t for v, t in tags if v == u} for u in range(12)}
    members = spark.createDataFrame(tags, "user int, tag string")
    assert spatial._tags(members, spots, "user", "tag")[1]
    shared = {(a, b) for a in range(12) for b in range(a + 1, 12) if held[a] & held[b]}
    assert len(shared) < 66
    found = close_pairs(spots, members, 1.0, "user", "tag", ["day"], hot_rows=20)
    right = spots.toDF("user_right", "lat_b", "lon_b", "day")
    every = grid_join(spots.withColumnRenamed("user", "user_left"), right, 1.0, ["day"])
    expected = [x for x in rows(every, "user_left", "user_right", "lat", "distance_km") if x[:2] in shared]
    assert expected and rows(found, "user_left", "user_right", "lat", "distance_km") == expected
