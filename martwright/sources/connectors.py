"""Kafka and JDBC; hosts and credentials always come from the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.operators import exclude


def kafka_options(
    servers: str, topic: str, max_offsets: int | None = None, security: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Options of a Kafka source; ``max_offsets`` bounds one micro-batch."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, **(security or {})}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_kafka_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A Kafka topic as a stream."""
    return spark.readStream.format("kafka").options(**options).load()


def write_kafka(df: DataFrame, servers: str, topic: str, security: Mapping[str, str] | None = None) -> None:
    """Send ``key`` and ``value`` columns to a topic."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, **(security or {})}
    df.select("key", "value").write.format("kafka").options(**options).save()


def read_jdbc(
    spark: SparkSession, url: str, table: str, props: Mapping[str, str], split: tuple[str, int, int, int] | None = None
) -> DataFrame:
    """A database table; ``split`` = (column, lower, upper, parts) reads it in parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **props)
    if split is not None:
        column, lower, upper, parts = split
        reader = reader.options(
            partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(parts)
        )
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, props: Mapping[str, str]) -> None:
    """Append rows to a database table."""
    df.write.format("jdbc").options(url=url, dbtable=table, **props).mode("append").save()


def write_jdbc_batch(
    df: DataFrame, url: str, table: str, props: Mapping[str, str], batch_id: int, keys: Sequence[str], mark: str = "batch_id"
) -> None:
    """Append one micro-batch under its id; a batch that comes again adds only the rows that are missing.

    The table needs the whole-number column ``mark``. The database is asked for the keys of this batch only.
    """
    columns = ", ".join(keys)
    there = df.sparkSession.read.format("jdbc").options(url=url, query=f"select {columns} from {table} where {mark} = {int(batch_id)}", **props).load()
    write_jdbc(exclude(df, there, keys).withColumn(mark, F.lit(int(batch_id)).cast("long")), url, table, props)
