"""Proportional stratified interleaving: shards that all have the mixture of the whole.

Rows are put in a seeded random order within their source. The k-th of n rows
stands at the fraction (k - 1 + u) / n, with one random shift u per source, and
all rows sorted by fraction are cut into shards of equal row counts. Each shard
then holds each source in its share, to within about as many rows as there are
sources.

Neither rank is a one-task window: rows are dealt into hash buckets (rank within
the source) and fraction buckets (place among all), a small table of bucket
counts gives the rows before each bucket, and rows are numbered in their bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import land, md5_key

SEED = "interleave"
# Buckets of both ranks; a bucket holds 1/4096 of a source, however large it is.
BUCKETS = 4096


def interleave(docs: DataFrame, shards: int = 16, seed: str = SEED) -> DataFrame:
    """Deal ``docs`` (doc_id, text, source) into shards with counts at most one apart.

    Returns doc_id, source, size, text_crc32, law, shard, slot and grown_shard
    (null: this law deals by rank). Null text counts as empty, a null source is a
    source of its own, rows that agree in doc_id, size and checksum are
    interchangeable. An empty table gives no rows. Other columns are ignored.
    """
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(
        "doc_id",
        "source",
        md5_key(seed, F.col("doc_id")).alias("key"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("stratum"),
    ).withColumn("bucket", F.shiftright("key", 48))
    # The counts read two columns only, not the texts.
    counts = (
        docs.select(
            F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("stratum"),
            F.shiftright(md5_key(seed, F.col("doc_id")), 48).alias("bucket"),
        )
        .groupBy("stratum", "bucket")
        .count()
        .withColumn("earlier", F.coalesce(F.sum("count").over(before.partitionBy("stratum")), F.lit(0)))
        .withColumn("n", F.sum("count").over(Window.partitionBy("stratum")))
        .drop("count")
    )
    in_bucket = Window.partitionBy("stratum", "bucket").orderBy("key", "doc_id", "size", "text_crc32")
    shift = md5_key(seed, F.col("stratum")).cast("double") / F.lit(float(1 << 60))
    placed = land(
        keyed.withColumn("nth", F.row_number().over(in_bucket))
        .join(counts, ["stratum", "bucket"])
        .withColumn("fraction", (F.col("earlier") + F.col("nth") - 1 + shift) / F.col("n"))
        .withColumn("bucket", F.floor(F.col("fraction") * BUCKETS).cast("long"))
        .select("doc_id", "source", "size", "text_crc32", "stratum", "key", "fraction", "bucket")
    )
    # At most BUCKETS rows.
    starts = (
        placed.groupBy("bucket")
        .count()
        .withColumn("earlier", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .withColumn("total", F.sum("count").over(Window.partitionBy(F.lit(1))))
        .drop("count")
    )
    in_order = Window.partitionBy("bucket").orderBy("fraction", "stratum", "key", "doc_id", "size", "text_crc32")
    place = F.col("earlier") + F.col("nth") - 1
    return (
        placed.withColumn("nth", F.row_number().over(in_order))
        .join(F.broadcast(starts), "bucket")
        .withColumn("place", place)
        .withColumn("shard", F.expr(f"cast(place * {shards} div total as int)"))
        .select(
            "doc_id",
            "source",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            "shard",
            F.expr(f"place - (shard * total + {shards - 1}) div {shards}").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
