from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright import sources as so
from martwright.session import materialize, shared_dir
from martwright.streaming import run_stream

SMALL = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_order_log_with_and_without_status(spark, tmp_path, rows):
    head = "id,date_time,city_id,city_name,customer_id,first_name,last_name,item_id,item_name,quantity,payment_amount"
    old = write(tmp_path / "old.csv", f"{head}\n1,2024-01-01 10:00:00,5,c,7,f,l,3,i,2,1.50\n")
    new = write(tmp_path / "new.csv", f"{head},status\n2,2024-01-02 10:00:00,5,c,7,f,l,3,i,2,2.50,refunded\n")
    both = so.read_order_log_csv(spark, old).unionByName(so.read_order_log_csv(spark, new))
    assert rows(both, "id", "date_time", "payment_amount", "status") == [
        (1, datetime(2024, 1, 1, 10), D("1.50"), None),
        (2, datetime(2024, 1, 2, 10), D("2.50"), "refunded"),
    ]


def test_typed_csv_and_geo_csv(spark, tmp_path, rows):
    path = write(tmp_path / "t.csv", "1,nan\nnan,b\n")
    assert rows(so.read_csv_typed(spark, path, SMALL, null="nan")) == [(1, None), (None, "b")]
    geo = write(tmp_path / "geo.csv", "id;city;lat;lng\n1;Sydney;-33,865;151,2094\n2;Broken;x;\n")
    assert rows(so.read_geo_csv(spark, geo)) == [(1, "Sydney", -33.865, 151.2094), (2, "Broken", None, None)]


def test_partitions_are_pruned_and_replaced(spark, tmp_path, rows):
    data = [(i, date(2024, 1, d), k) for i, (d, k) in enumerate([(1, "a"), (2, "a"), (2, "b"), (3, "a")])]
    df = spark.createDataFrame(data, "id int, date date, event_type string")
    raw, copy = str(tmp_path / "raw"), str(tmp_path / "copy")
    so.write_partitioned(df, raw, ["date", "event_type"], mode="overwrite")
    plan = so.read_events(spark, raw, "2024-01-03", 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-02" in plan
    for _ in range(2):
        so.copy_partitions(spark, raw, copy, "2024-01-03", 1)
    assert rows(spark.read.parquet(copy), "id") == [(1,), (2,), (3,)]
    so.replace_period(df.where("id = 1").withColumn("id", F.lit(9)), copy, ["date", "event_type"])
    assert rows(spark.read.parquet(copy), "id") == [(2,), (3,), (9,)]
    so.write_partitioned(df.limit(1), copy, ["date", "event_type"], mode="append")
    assert spark.read.parquet(copy).count() == 4


def test_append_and_refresh(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(3)
    so.append(df, path)
    so.append(df, path)
    assert spark.read.parquet(path).count() == 6
    so.full_refresh(df, path)
    assert spark.read.parquet(path).count() == 3


def test_mart_folder(spark, tmp_path):
    assert so.mart_path("/m/", "users", "2024-01-30", 20) == "/m/users_30_01_2024_20"
    path = so.write_mart(spark.range(10).repartition(4), str(tmp_path), "users", "2024-01-30", 20, files=1)
    assert len(spark.read.parquet(path).inputFiles()) == 1


def test_batches_replay_and_compact(spark, tmp_path, rows):
    path, target = str(tmp_path / "t"), str(tmp_path / "c")
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, at int")
    second = spark.createDataFrame([(2, "c", 2)], "k int, v string, at int")
    for df, batch in [(first, 0), (second, 1), (second, 1)]:
        so.append_batch(df, path, batch)
    order = [F.desc("at"), F.desc("batch_id")]
    assert so.read_batches(spark, path).count() == 3
    assert rows(so.current_rows(so.read_batches(spark, path), ["k"], order)) == [(1, "a", 1), (2, "c", 2)]
    so.compact(spark, path, target, ["k"], order)
    assert rows(so.read_batches(spark, target), "k", "v") == [(1, "a"), (2, "c")]


def test_new_files_are_read_once(spark, tmp_path, rows):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def load():
        stream = so.stream_new_files(spark, str(folder), SMALL)
        run_stream(stream, lambda df, n: so.append_batch(df, out, n), state).awaitTermination()
        return rows(so.read_batches(spark, out), "id")

    write(folder / "1.csv", "1,a\n")
    assert load() == [(1,)]
    assert load() == [(1,)]
    write(folder / "2.csv", "2,b\n")
    assert load() == [(1,), (2,)]


def test_landed_json(spark, tmp_path, rows):
    path = write(tmp_path / "l.json", '{"id": 3, "v": "x"}\n{"id": 7}\n')
    df = so.read_landed_json(spark, path, SMALL)
    assert rows(df) == [(3, "x"), (7, None)]
    assert so.landed_offset(df, "id") == 7 and so.landed_offset(df.where("false"), "id") == 0


def test_view(spark):
    assert so.table_view(spark.range(2), "two_rows").count() == 2


def test_connector_options(spark):
    assert so.kafka_options("h:1", "t", 20, {"kafka.security.protocol": "SSL"}) == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "kafka.security.protocol": "SSL",
        "maxOffsetsPerTrigger": "20",
    }
    # The connector jars are not here; the calls must get as far as looking for them.
    with pytest.raises(Exception, match="(?i)kafka"):
        so.read_kafka_stream(spark, so.kafka_options("h:1", "t"))
    with pytest.raises(Exception, match="(?i)kafka"):
        so.write_kafka(spark.createDataFrame([("k", "v")], "key string, value string"), "h:1", "t")
    with pytest.raises(Exception, match="(?i)driver|jdbc"):
        so.read_jdbc(spark, "jdbc:none:x", "t", {}, ("id", 0, 10, 2))
    with pytest.raises(Exception, match="(?i)driver|jdbc"):
        so.write_jdbc(spark.range(1), "jdbc:none:x", "t", {})


def test_checkpoints_go_to_the_shared_folder(spark):
    folder = shared_dir(spark)
    assert folder == shared_dir(spark) and spark.sparkContext.getCheckpointDir() == folder
    assert materialize(spark.range(3)).count() == 3


def test_stated_periods_without_rows_are_cleared(spark, tmp_path):
    path = str(tmp_path / "periods")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "n int, p string")
    so.replace_period(df, path, ["p"])
    so.replace_period(df.where("n = 1").withColumn("n", F.lit(9)), path, ["p"], [("a",), ("b",)])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(3, "c"), (9, "a")]


def test_files_of_different_headers_side_by_side(spark, tmp_path, rows):
    head = "id,date_time,city_id,city_name,customer_id,first_name,last_name,item_id,item_name,quantity,payment_amount"
    old = "\n".join(f"{i},2024-01-01 10:00:00,5,c,7,f,l,3,i,2,1.50" for i in range(1, 200))
    write(tmp_path / "in" / "a.csv", f"{head}\n{old}\n")
    write(tmp_path / "in" / "sub" / "b.csv", f"status,{head}\nrefunded,200,2024-01-02 10:00:00,5,c,7,f,l,3,i,2,2.50\n")
    write(tmp_path / "in" / "empty.csv", "")
    write(tmp_path / "in" / "only_header.csv", f"{head},status,more\n")
    found = so.read_order_log_csv(spark, str(tmp_path / "in"))
    assert found.columns == so.ORDER_LOG.fieldNames() if hasattr(so, "ORDER_LOG") else len(found.columns) == 12
    assert rows(found.where("status is not null"), "id", "payment_amount", "status") == [(200, D("2.50"), "refunded")]
    assert found.count() == 200 and found.where("city_name = 'c' and quantity = 2").count() == 200


def test_stated_periods_without_rows_are_cleared(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    data = [(1, datetime(2024, 1, 1, 10, 30), "a b"), (2, datetime(2024, 1, 2, 11, 45), "a=b"), (3, datetime(2024, 1, 3), "c")]
    df = spark.createDataFrame(data, "id int, at timestamp_ntz, name string")
    so.replace_period(df, path, ["at", "name"])
    so.replace_period(df.where("id = 3").withColumn("id", F.lit(9)), path, ["at", "name"], [(at, name) for _, at, name in data[1:]])
    assert rows(spark.read.parquet(path), "id") == [(1,), (9,)]
