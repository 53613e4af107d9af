import json
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.functions import uuid3
from martwright.plans.promotions import decode
from martwright.plans.vault import explode_products, natural_counter_rows, user_product_counters, vault_tables
from martwright.sources import append_batch, read_batches, stream_new_files
from martwright.streaming import (
    StreamCounts,
    dedupe_stream,
    fan_out,
    first_in_batch,
    load_counters,
    load_vault,
    promotion_outputs,
    run_stream,
    send_triggers,
    vault_table,
)
from martwright.streaming.orders import KEYS, category_counters, counter_state, product_counters, vault_state

NOW = 1705276800000
LINE = T.StructType([T.StructField("value", T.StringType())])


def drop(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def campaign(name, created=NOW, start=NOW - 5, end=NOW + 5, restaurant="r", arrived=NOW):
    fields = {
        "restaurant_id": restaurant,
        "adv_campaign_id": name,
        "adv_campaign_content": "c",
        "adv_campaign_owner": "o",
        "adv_campaign_owner_contact": "p",
        "adv_campaign_datetime_start": start,
        "adv_campaign_datetime_end": end,
        "datetime_created": created,
        "arrived": arrived,
    }
    return json.dumps(fields)


@pytest.fixture
def promotions(spark, tmp_path, rows):
    folder = tmp_path / "in"
    clients = spark.createDataFrame([("r", 1), ("r", 2), ("q", 3), ("r", 1)], "restaurant_id string, client_id long")
    sent = send_triggers(
        lambda df, n: append_batch(df, str(tmp_path / "feedback"), n),
        lambda df, n: append_batch(df, str(tmp_path / "topic"), n),
        lambda df, n: append_batch(df, str(tmp_path / "unreadable"), n),
    )

    def run(keep="1 hour"):
        lines = stream_new_files(spark, str(folder), LINE, "text")
        arrived = F.timestamp_millis(F.coalesce(F.get_json_object("value", "$.arrived").cast("long"), F.lit(NOW)))
        stream = promotion_outputs(lines.withColumn("timestamp", arrived), clients, "2024-01-15 00:00:00", keep)
        query = run_stream(stream, sent, str(tmp_path / "state"))
        query.awaitTermination()
        return rows(read_batches(spark, str(tmp_path / "feedback")), "adv_campaign_id", "client_id")

    return folder, run


def test_triggers_without_repeats(promotions, spark, tmp_path):
    folder, run = promotions
    drop(folder, "1.txt", [campaign("a"), campaign("a"), campaign("old", end=NOW - 1), "{broken", campaign("q", restaurant="none")])
    assert run() == [("a", 1), ("a", 2)]
    # A repeat within a minute in a later run is dropped, a new campaign is not.
    drop(folder, "2.txt", [campaign("a", NOW + 30_000), campaign("b", NOW + 30_000)])
    assert run() == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]
    topic = read_batches(spark, str(tmp_path / "topic"))
    assert topic.count() == 4 and topic.first()["key"] == str(NOW)
    assert read_batches(spark, str(tmp_path / "feedback")).where("feedback is null").count() == 4


def test_late_partitions_and_expired_keys(promotions, spark):
    folder, run = promotions
    counts = StreamCounts()
    spark.streams.addListener(counts)
    try:
        drop(folder, "1.txt", [campaign("a"), campaign("b", arrived=NOW + 300_000)])
        run()
        # Messages of a partition that lags five minutes, new and repeated.
        drop(folder, "2.txt", [campaign("c", arrived=NOW), campaign("b", arrived=NOW + 1_000), campaign("a")])
        run()
        drop(folder, "3.txt", [campaign("d", arrived=NOW - 600_000), campaign("c", arrived=NOW)])
        assert run() == [(name, client) for name in "abcd" for client in (1, 2)]
        # The state of all keys expires by the clock; then a repeat is a trigger again.
        time.sleep(3)
        drop(folder, "4.txt", [campaign("a", arrived=NOW)])
        assert run("1 second").count(("a", 1)) == 1
        time.sleep(1)
    finally:
        spark.streams.removeListener(counts)
    assert counts.counts["triggers"]["first_rows"] == 8


def test_state_expires_by_the_clock(promotions):
    folder, run = promotions
    drop(folder, "1.txt", [campaign("a")])
    run("1 second")
    time.sleep(2)
    drop(folder, "2.txt", [campaign("b")])
    run("1 second")
    drop(folder, "3.txt", [campaign("a")])
    assert run("1 second").count(("a", 1)) == 2


def test_keys_share_calls_and_state(spark, tmp_path, rows):
    """2,000 keys that come five times: one state for each group, the least time and text of a key first."""
    drop(tmp_path / "in", "1.txt", [f"{k},{'' if v == 0 else f'2024-01-0{max(2, v)}'},{9 - v}" for v in range(5) for k in range(2000)])
    lines = stream_new_files(spark, str(tmp_path / "in"), LINE, "text")
    parts = F.split("value", ",")
    stream = dedupe_stream(lines.select(parts[0].alias("k"), parts[1].try_cast("timestamp").alias("at"), parts[2].alias("v")), ["k"], "at", groups=16)
    query = run_stream(stream, lambda df, n: append_batch(df, str(tmp_path / "out"), n), str(tmp_path / "state"))
    query.awaitTermination()
    # Times 2 and 1 are both the second of January, where the text 7 comes before 8; a missing time comes last.
    assert rows(read_batches(spark, str(tmp_path / "out")).groupBy("v").count()) == [("7", 2000)]
    assert sum(p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress if p["numInputRows"]) <= 16


def test_repeats_of_a_batch_are_reduced_before_the_join(spark, rows):
    data = [("r", "a", "z", 3), ("r", "a", "y", 2), ("r", "a", "x", 2), ("r", "b", None, None), ("r", "b", "w", None), (None, "a", "v", 1)]
    df = spark.createDataFrame(data, "r string, c string, text string, s long").repartition(3)
    df = df.select("r", "c", "text", F.timestamp_seconds("s").alias("at"))
    assert rows(first_in_batch(df, ["r", "c"], "at"), "r", "c", "text") == [("r", "a", "x"), ("r", "b", "w"), (None, "a", "v")]


def test_unreadable_messages_have_their_own_output(promotions, spark, tmp_path, rows):
    folder, run = promotions
    drop(folder, "1.txt", [campaign("a"), "{broken", "{}"])
    run()
    assert rows(read_batches(spark, str(tmp_path / "unreadable")), "value") == [("{broken",), ("{}",)]


def test_campaigns_created_long_ago_are_not_late(promotions):
    folder, run = promotions
    drop(folder, "1.txt", [campaign("a")])
    run()
    drop(folder, "2.txt", [campaign("b", NOW - 3_600_000, arrived=NOW + 5_000), campaign("c", NOW - 7_200_000, arrived=NOW + 5_000)])
    run()
    drop(folder, "3.txt", [campaign("d", NOW - 9_000_000, arrived=NOW + 9_000)])
    assert run() == [(name, client) for name in "abcd" for client in (1, 2)]


def test_unreadable_messages_are_kept_apart(table, rows):
    good, bad = decode(table("value string", [(campaign("a"),), ("{broken",), ("{}",), (None,)]))
    assert rows(good, "adv_campaign_id") == [("a",)]
    assert rows(bad) == [("{broken",), ("{}",), (None,)]


def test_a_batch_is_computed_once_for_all_sinks(spark):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            runs.add(1)
            yield batch

    df = spark.range(0, 5, 1, 1).mapInPandas(count, "id long")
    fan_out(df, 0, [lambda rows, n: rows.count(), lambda rows, n: rows.count()])
    assert runs.value == 1


def order(i, user_name, products):
    return (
        str(i),
        {
            "id": str(i),
            "date": "2024-01-01 10:00:00",
            "cost": 10.5,
            "payment": 10.5,
            "status": "CLOSED",
            "restaurant": {"id": "r", "name": "Rest"},
            "user": {"id": "u", "name": user_name},
            "products": [{"id": p, "category": c, "name": p} for p, c in products],
        },
    )


def test_orders_to_vault_and_counters(spark, tmp_path, rows):
    from martwright.plans.vault import MESSAGE

    folder, vault, state = tmp_path / "in", str(tmp_path / "vault"), tmp_path / "state"

    def orders(run, data, load_dt):
        drop(folder, f"{run}.txt", [json.dumps({"object_id": i, "payload": p}) for i, p in data])
        lines = stream_new_files(spark, str(folder), LINE, "text")
        messages = lines.select(F.from_json("value", MESSAGE).alias("m")).select(
            "m.*", F.lit(load_dt).cast("timestamp_ntz").alias("load_dt")
        )
        batch = load_vault(vault, lambda df, n: append_batch(df, f"{vault}/topic", n))
        run_stream(messages, batch, str(state / "dds")).awaitTermination()
        enriched = spark.readStream.schema("object_id string, object_type string, payload string").option(
            "basePath", f"{vault}/topic"
        ).parquet(f"{vault}/topic")
        run_stream(enriched, load_counters(vault), str(state / "cdm")).awaitTermination()

    first = order(1, "Ann", [("p1", "x"), ("p1", "x"), ("p2", "y")])
    second = order(2, "Anna", [("p1", "x")])
    orders(1, [first], "2024-01-01 00:00:00")
    orders(2, [second, first], "2024-01-02 00:00:00")

    hub = vault_table(spark, vault, "h_order")
    assert rows(hub, "order_id", "load_dt") == [("1", datetime(2024, 1, 1)), ("2", datetime(2024, 1, 2))]
    assert vault_table(spark, vault, "l_order_product").count() == 3
    assert rows(vault_table(spark, vault, "s_user_names"), "username", "load_dt") == [
        ("Ann", datetime(2024, 1, 2)),
        ("Anna", datetime(2024, 1, 2)),
    ]
    # The first message came twice and still counts once.
    assert rows(product_counters(spark, vault), "product_name", "order_cnt") == [("p1", 2), ("p2", 1)]
    assert sorted(r["order_cnt"] for r in category_counters(spark, vault).collect()) == [1, 2]
    user = spark.range(1).select(uuid3(F.lit("u")).alias("u")).first()["u"]
    assert product_counters(spark, vault).first()["user_id"] == user

    # The batch form over all messages gives the same tables.
    lines = spark.read.text(str(folder)).select(F.from_json("value", MESSAGE).alias("m")).select("m.*", F.lit(None).cast("timestamp_ntz").alias("load_dt"))
    exploded = explode_products(lines)
    for name, batch in vault_tables(exploded).items():
        columns = [c for c in batch.columns if c != "load_dt"]
        assert batch.columns[0] == KEYS[name]
        assert rows(vault_table(spark, vault, name), *columns) == rows(batch, *columns)
    assert rows(user_product_counters(natural_counter_rows(exploded))) == rows(product_counters(spark, vault))


def test_a_replayed_batch_changes_nothing(spark, tmp_path, table, rows):
    from martwright.plans.vault import PAYLOAD

    i, payload = order(1, "Ann", [("p1", "x")])
    text = table("object_id string, p string", [(i, json.dumps(payload))])
    messages = text.select("object_id", F.from_json("p", PAYLOAD).alias("payload"), F.lit("2024-01-01").cast("timestamp_ntz").alias("load_dt"))
    batch = load_vault(str(tmp_path), buckets=2)
    for number in (4, 4, 3, 5):
        batch(messages, number)
    assert vault_table(spark, str(tmp_path), "h_user", 2).count() == 1
    assert [v.version for v in vault_state(spark, str(tmp_path), 2).pointer().versions] == [0, 1]


def test_counters_remember_digests_only(spark, tmp_path, table, rows):
    target = str(tmp_path / "t")

    def message(order, *things):
        fields = {
            "h_user": {"h_user_pk": "u"}, "h_order": {"h_order_pk": order}, "h_category": [{"h_category_pk": c, "category_name": c} for _, c in things],
            "l_product_category": [{"h_product_pk": p, "h_category_pk": c} for p, c in things], "s_product_names": [{"h_product_pk": p, "name": p} for p, _ in things],
        }
        return ("o", "order", json.dumps(fields))

    sink = load_counters(target)
    batches = [[message("1", ("a", "x"), ("b", "x"))], [message("2", ("a", None)), message("1", ("a", "x"))], [message("2", ("a", None))]]
    for n, batch in enumerate(batches):
        sink(table("object_id string, object_type string, payload string", batch), n)
    # A row without a key cannot be recognised, so it counts each time.
    assert rows(product_counters(spark, target), "product_id", "order_cnt") == [("a", 2), ("b", 1)]
    assert rows(category_counters(spark, target), "category_id", "order_cnt") == [("x", 1), (None, 2)]
    seen = counter_state(spark, target).read().where("kind = 'seen'")
    assert {len(r.user_id) for r in seen.collect()} == {24} and seen.where("thing_id is not null or name is not null").isEmpty()
    assert seen.count() == 4
