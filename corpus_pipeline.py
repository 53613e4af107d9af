"""From raw documents to balanced shards: five stages, each written and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last
keep the columns of ``documents``. Null texts count as empty texts, rows that are
repeated are judged alike, and other columns pass through the filtering stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martwright.llm import interleave, minhash, raking, toxicity, wumanber
from martwright.llm.common import land, table


# Words of a shingle of the near-duplicates stage; two, as in op2, would drop more.
SHINGLE = 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each component of near-duplicates, by shingles of five words."""
    return minhash.deduplicate(docs, size=SHINGLE)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark passages."""
    return wumanber.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics meet their target weights."""
    return raking.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and place of every document."""
    return interleave.interleave(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# The first stage is a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
