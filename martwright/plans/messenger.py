"""Users in groups as link and satellite, and the conversion of the oldest groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions import hash_key
from martwright.operators import exclude, insert_new, keep_in, left, top, with_load_meta

LINK = "hk_l_user_group_activity"


def link_user_group(
    log: DataFrame,
    users: DataFrame,
    groups: DataFrame,
    existing: DataFrame | None = None,
    load_dt: Column | None = None,
    src: str = "s3",
) -> DataFrame:
    """New user-group links: one row per pair known to both hubs and not linked yet."""
    pairs = log.select("user_id", "group_id").distinct()
    rows = (
        pairs.join(users.select("user_id", "hk_user_id"), "user_id", "left")
        .join(groups.select("group_id", "hk_group_id"), "group_id", "left")
        .select(hash_key("hk_user_id", "hk_group_id").alias(LINK), "hk_user_id", "hk_group_id")
        .dropna(subset=[LINK])
    )
    fresh = rows if existing is None else insert_new(existing, rows, [LINK])
    return with_load_meta(fresh, src, load_dt)


def sat_auth_history(
    log: DataFrame, users: DataFrame, groups: DataFrame, link: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """Group events on the link, without repeats.

    The link is first resolved to natural ids, so the large log is shuffled once.
    """
    known = (
        link.join(users.select("hk_user_id", "user_id"), "hk_user_id")
        .join(groups.select("hk_group_id", "group_id"), "hk_group_id")
        .select("user_id", "group_id", LINK, "load_dt", "load_src")
    )
    rows = log.join(known, ["user_id", "group_id"]).select(
        LINK, "user_id_from", "event", "event_dt", "load_dt", "load_src"
    ).distinct()
    if existing is None:
        return rows
    keys = [LINK, "user_id_from", "event", "event_dt"]
    same = [rows[k].eqNullSafe(existing[k]) for k in keys]
    return rows.join(existing, same, "left_anti")


def oldest_groups(groups: DataFrame, n: int = 10) -> DataFrame:
    """The n groups registered first; equal times by key."""
    return top(groups, [F.col("registration_dt").asc(), F.col("hk_group_id").asc()], n).select("hk_group_id")


def added_users(
    groups: DataFrame, link: DataFrame, auth: DataFrame, n: int = 10, keep_unmatched: bool = False
) -> DataFrame:
    """Users added to each of the n oldest groups.

    ``keep_unmatched`` adds the row without group that stands for events of
    all other groups.
    """
    # At most n rows, so the hint is safe at any size.
    oldest = F.broadcast(oldest_groups(groups, n))
    adds = auth.where(F.col("event") == "add").select(LINK).distinct()
    rows = link.join(oldest, "hk_group_id").join(adds, LINK, "left_semi")
    counts = rows.groupBy("hk_group_id").agg(F.count_distinct("hk_user_id").alias("cnt_added_users"))
    if not keep_unmatched:
        return counts
    inside = link.join(oldest, "hk_group_id").select(LINK)
    other = exclude(adds, inside, [LINK]).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    unmatched = other.select(F.lit(None).cast("string").alias("hk_group_id"), F.lit(0).cast("long").alias("cnt_added_users"))
    return counts.unionByName(unmatched)


def active_users(groups: DataFrame, dialogs: DataFrame, messages: DataFrame) -> DataFrame:
    """Users who wrote in each group, 0 for silent groups.

    Messages are reduced to distinct (group, user) pairs before the hub joins.
    """
    pairs = (
        dialogs.select("hk_group_id", "hk_message_id")
        .join(messages.select("hk_message_id", "hk_user_id"), "hk_message_id")
        .select("hk_group_id", "hk_user_id")
        .distinct()
    )
    counts = pairs.groupBy("hk_group_id").agg(F.count("hk_user_id").alias("n"))
    return left(groups.select("hk_group_id"), counts, ["hk_group_id"]).select(
        "hk_group_id", F.coalesce("n", F.lit(0)).alias("cnt_users_in_group_with_messages")
    )


def fewest(counts: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The n groups with the lowest count; ties by key."""
    return top(counts, [F.col(column).asc(), F.col("hk_group_id").asc()], n)


def group_conversion(
    groups: DataFrame,
    link: DataFrame,
    auth: DataFrame,
    dialogs: DataFrame,
    messages: DataFrame,
    n: int = 10,
    keep_unmatched: bool = False,
) -> DataFrame:
    """Share of added users who wrote a message, for the n oldest groups, best first."""
    added = added_users(groups, link, auth, n, keep_unmatched)
    # Only the n oldest groups can appear, so the message side is cut before its joins.
    oldest = F.broadcast(oldest_groups(groups, n))
    inside = dialogs.join(oldest, "hk_group_id", "left_semi")
    active = active_users(keep_in(groups, oldest, ["hk_group_id"]), inside, messages)
    ratio = F.col("cnt_users_in_group_with_messages") / F.nullif(F.col("cnt_added_users"), F.lit(0))
    rows = left(added, active, ["hk_group_id"]).withColumn("group_conversion", ratio)
    return top(rows, [F.col("group_conversion").desc_nulls_last(), F.col("hk_group_id").asc()])


__all__ = [
    "LINK",
    "active_users",
    "added_users",
    "fewest",
    "group_conversion",
    "link_user_group",
    "oldest_groups",
    "sat_auth_history",
]
