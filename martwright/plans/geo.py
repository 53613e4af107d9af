"""Cities, travel, zone activity and friend suggestions from located events."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.functions import local_time
from martwright.operators import (
    change_points,
    count_flags,
    exclude,
    fill_zero,
    first_by,
    full,
    close_pairs,
    hot_keys,
    list_parts,
    nearest,
    number_rows,
    ordered_list,
    previous_value,
)
from martwright.operators.changes import CHECK
from martwright.operators.spatial import PairBlocks
from martwright.session import land, materialize

DEFAULT_ZONE = "Australia/ACT"

# IANA zones of the larger Australian cities.
CITY_ZONES = {
    "Sydney": "Australia/Sydney",
    "Melbourne": "Australia/Melbourne",
    "Brisbane": "Australia/Brisbane",
    "Perth": "Australia/Perth",
    "Adelaide": "Australia/Adelaide",
    "Gold Coast": "Australia/Brisbane",
    "Newcastle": "Australia/Sydney",
    "Canberra": "Australia/ACT",
    "Wollongong": "Australia/Sydney",
    "Geelong": "Australia/Melbourne",
    "Hobart": "Australia/Hobart",
    "Townsville": "Australia/Brisbane",
    "Cairns": "Australia/Brisbane",
    "Toowoomba": "Australia/Brisbane",
    "Darwin": "Australia/Darwin",
    "Ballarat": "Australia/Melbourne",
    "Bendigo": "Australia/Melbourne",
    "Launceston": "Australia/Hobart",
    "Mackay": "Australia/Brisbane",
    "Rockhampton": "Australia/Brisbane",
}

FLAGS = {"message": "message", "reaction": "reaction", "subscription": "subscription"}


def assign_city(events: DataFrame, cities: DataFrame) -> DataFrame:
    """Nearest city of every event, with the zone id; position, time and message fields stay."""
    places = cities.select(F.col("id").alias("zone_id"), "city", "lat", F.col("lng").alias("lon"))
    return nearest(events, places, "zone_id", ["city"])


def flatten(located: DataFrame) -> DataFrame:
    """User, time and place of located events."""
    return located.select(
        F.col("event.message_from").alias("user_id"),
        F.col("event.message_id").alias("message_id"),
        F.col("event.message_ts").alias("message_ts"),
        "date",
        "event_type",
        "zone_id",
        "city",
    )


def actual_city(visits: DataFrame) -> DataFrame:
    """City and time of each user's last event."""
    order = [F.col("message_ts").desc(), F.col("message_id").desc()]
    return first_by(visits.select("user_id", "message_ts", "message_id", "city"), ["user_id"], order).select(
        "user_id", "message_ts", F.col("city").alias("act_city")
    )


def busy_users(visits: DataFrame) -> DataFrame | None:
    """Users with too many events for one task, or None; pass the answer to the functions below."""
    return hot_keys(visits, "user_id")


def _moves(visits: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Rows where a user appears in another city than before, first row included."""
    rows = visits.select("user_id", "message_ts", "message_id", "date", "city")
    return change_points(rows, "user_id", "city", "message_ts", ["message_id"], keep_first=True, hot=hot)


def home_city(
    visits: DataFrame,
    min_days: int = 27,
    run_date: str | date | None = None,
    include_open_stay: bool = False,
    hot: DataFrame | str | None = CHECK,
) -> DataFrame:
    """City of the latest stay of at least ``min_days`` days.

    A stay is known once the user leaves it. ``include_open_stay`` also counts
    the last stay, up to the run date. ``hot`` is the result of ``busy_users``,
    which is asked when it is not given.
    """
    hot = busy_users(visits) if isinstance(hot, str) else hot
    moves = _moves(visits, hot)
    linked = previous_value(moves, "user_id", "message_ts", ["message_id"], ["date"], hot)
    stayed = linked.where(F.datediff("date", "prev_date") >= min_days)
    order = [F.col("message_ts").desc(), F.col("message_id").desc()]
    closed = first_by(stayed, ["user_id"], order).select("user_id", F.col("prev_city").alias("home_city"))
    if not include_open_stay:
        return closed
    last = first_by(moves, ["user_id"], order).where(
        F.datediff(F.lit(str(run_date)).cast("date"), F.col("date")) >= min_days
    )
    now = last.select("user_id", F.col("city").alias("open_city"))
    return full(closed, now, ["user_id"]).select(
        "user_id", F.coalesce("open_city", "home_city").alias("home_city")
    )


def user_city(actual: DataFrame, home: DataFrame) -> DataFrame:
    """Actual and home city per user."""
    return full(actual, home, ["user_id"]).select("user_id", "act_city", "home_city", "message_ts")


def travel(visits: DataFrame, hot: DataFrame | str | None = CHECK) -> DataFrame:
    """Number and list of city changes per user, in time order."""
    hot = busy_users(visits) if isinstance(hot, str) else hot
    moved = _moves(visits, hot).where(F.col("prev_city").isNotNull())
    listed = ordered_list(moved, ["user_id"], "city", ["message_ts", "message_id"], "travel_array")
    return listed.withColumn("travel_count", F.size("travel_array")).select("user_id", "travel_count", "travel_array")


def travel_parts(visits: DataFrame, size: int = 10_000, hot: DataFrame | str | None = CHECK) -> DataFrame:
    """City changes per user in time order, in parts of at most ``size`` cities, for users of any number of moves."""
    hot = busy_users(visits) if isinstance(hot, str) else hot
    moved = _moves(visits, hot).where(F.col("prev_city").isNotNull())
    return list_parts(moved, ["user_id"], "city", ["message_ts", "message_id"], "cities", size)


def user_geo(
    visits: DataFrame,
    min_days: int = 27,
    zones: Mapping[str, str] = CITY_ZONES,
    default_zone: str = DEFAULT_ZONE,
    run_date: str | date | None = None,
    include_open_stay: bool = False,
) -> DataFrame:
    """Actual city, home city, travel and local time of the last event per user."""
    hot = busy_users(visits)
    home = home_city(visits, min_days, run_date, include_open_stay, hot)
    rows = full(user_city(actual_city(visits), home), travel(visits, hot), ["user_id"])
    return rows.select(
        "user_id",
        "act_city",
        "home_city",
        F.coalesce("travel_count", F.lit(0)).alias("travel_count"),
        F.coalesce("travel_array", F.array().cast("array<string>")).alias("travel_array"),
        local_time("message_ts", "act_city", zones, default_zone).alias("local_time"),
    )


def _zone_counts(visits: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """Events per kind and first-time writers, per zone and period."""
    names = {kind: f"{prefix}_{name}" for kind, name in FLAGS.items()}
    counts = count_flags(visits, keys, "event_type", names)
    order = [F.col("date").asc(), F.col("message_id").asc()]
    wrote = visits.where(F.col("event_type") == "message")
    first = first_by(wrote.select("user_id", "message_id", "date", *keys), ["user_id"], order)
    users = first.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"{prefix}_user"))
    both = full(counts, users, keys)
    return fill_zero(both, [*names.values(), f"{prefix}_user"])


def _with_periods(visits: DataFrame) -> DataFrame:
    return visits.withColumn("month", F.trunc("date", "month")).withColumn("week", F.trunc("date", "week"))


def zone_week(visits: DataFrame) -> DataFrame:
    """Weekly activity per zone; a week across two months counts in each."""
    return _zone_counts(_with_periods(visits), ["month", "week", "zone_id"], "week")


def zone_month(visits: DataFrame) -> DataFrame:
    """Monthly activity per zone."""
    return _zone_counts(_with_periods(visits), ["month", "zone_id"], "month")


def zone_metrics(visits: DataFrame) -> DataFrame:
    """Weekly next to monthly activity per zone.

    Month totals are sums of the week rows of the same month, so the events
    are aggregated once.
    """
    weeks = materialize(zone_week(visits))
    kinds = [*FLAGS.values(), "user"]
    months = weeks.groupBy("month", "zone_id").agg(*[F.sum(f"week_{k}").alias(f"month_{k}") for k in kinds])
    return weeks.join(months, ["month", "zone_id"]).select(
        "month", "week", "zone_id", *[f"week_{k}" for k in kinds], *[f"month_{k}" for k in kinds]
    )


def participants(located: DataFrame) -> DataFrame:
    """Places of senders and receivers per day; repeats of a user at one place on one day are merged."""
    sides = [
        located.select(
            F.col(f"event.{who}").alias("user_id"),
            "date",
            "lat",
            "lon",
            "zone_id",
            "city",
            F.col("event.message_ts").alias("message_ts"),
        )
        for who in ("message_from", "message_to")
    ]
    both = sides[0].unionByName(sides[1]).dropna(subset=["user_id", "lat", "lon"])
    return both.groupBy("user_id", "date", "lat", "lon").agg(
        F.min("zone_id").alias("zone_id"), F.min("city").alias("city"), F.min("message_ts").alias("message_ts")
    )


def recommend_friends(
    located: DataFrame,
    km: float = 1.0,
    zones: Mapping[str, str] = CITY_ZONES,
    default_zone: str = DEFAULT_ZONE,
    processed: str | None = None,
) -> DataFrame:
    """Pairs who were within ``km`` on one day, never wrote to each other and share a channel.

    Each pair comes once (lower id left) with zone and local time of its
    closest meeting. Distances are taken only for people who share a channel, and
    meetings are found, reduced to the closest one and checked for messages in the
    task of the pair (``PairBlocks``): neither meetings nor pairs are shuffled.
    """
    subscribed = located.where(F.col("event_type") == "subscription").select(
        F.col("event.user").alias("user"), F.col("event.subscription_channel").alias("channel_id")
    )
    membership = materialize(subscribed.dropna().distinct())
    members = membership.select(F.col("user").alias("user_id")).distinct()
    spots = participants(located).join(members, "user_id", "left_semi").withColumnRenamed("user_id", "user")
    spots = spots.withColumn("local_time", local_time("message_ts", "city", zones, default_zone))
    # Of equally close meetings the one at the earlier of the left person's spots counts: the place in this order stands for the spot.
    order = [F.col(c) for c in ("date", "message_ts", "zone_id", "lat", "lon", "city", "user")]
    spots = land(number_rows(spots, order, "spot").select("user", "date", "lat", "lon", "spot", "zone_id", "local_time"))
    wrote = located.select(
        F.least("event.message_from", "event.message_to").alias("user_left"),
        F.greatest("event.message_from", "event.message_to").alias("user_right"),
    ).distinct()
    blocks = PairBlocks(spots, "user")
    met = close_pairs(spots, membership, km, "user", "channel_id", ["date"], blocks=blocks)
    # Distances are compared in millimetres so that rounding noise does not pick the meeting. As one number, as structs would make Spark sort instead of hash.
    millimetres = F.round(F.col("distance_km") * 1_000_000).cast("long")
    bits = 63 - int(km * 1_000_000 + 1).bit_length()
    whole = "long" if spots.count() < 2**bits else "decimal(38,0)"
    closeness = millimetres.cast(whole) * F.lit(2**bits if whole == "long" else 10**20).cast(whole) + F.col("spot")
    pair = [blocks.column, "user_left", "user_right"]
    friends = met.withColumn("closeness", closeness).groupBy(*pair).agg(*(F.min_by(c, "closeness").alias(c) for c in ("zone_id", "local_time")))
    stamp = F.current_timestamp() if processed is None else F.lit(processed)
    return exclude(friends, blocks.pairs(wrote).hint("merge"), pair).select(
        "user_left", "user_right", stamp.cast("timestamp_ntz").alias("processed_dttm"), "zone_id", "local_time"
    )
