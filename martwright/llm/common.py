"""Reading the tables, cutting lineage and small shared expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.session import release, shared_dir  # noqa: F401

# Words of the plain contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One input table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def land(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as parquet to the folder all executors share and read it back.

    This cuts the lineage: what follows starts from files, so a lost executor
    can neither change nor repeat the work before it.
    """
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def md5_key(*parts: Column | str) -> Column:
    """60 bits of the MD5 of the parts as a non-negative long; SQL engines agree on it."""
    joined = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, 15), 16, 10).cast("bigint")


def prune_with_bloom(spark: SparkSession) -> None:
    """Let Spark put a Bloom filter of the small side of a join on the scan of texts.

    The join stays a shuffled join; texts without a partner are mostly not
    shuffled. Spark bounds the filter's size by itself.
    """
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold", "1g")
