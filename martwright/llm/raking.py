"""Mixing sources to target weights by iterative proportional fitting (raking).

Documents fall into cells of source, language and topic. Starting from one rate
for all, the inclusion probability of each cell is scaled until the expected
tokens of every source, language and topic meet their targets; no probability
passes 1, so no document is repeated. Documents are then drawn by comparing the
probability of their cell with a number hashed from their id.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import WORD, land, md5_key

DIMENSIONS = ("source", "lang", "topic")
# Target share of a label: its token share to this power. Below 1 flattens the mixture.
POWERS = {"source": 0.7, "lang": 0.7, "topic": 0.9}
RATE = 0.6  # expected share of all tokens that is kept
SWEEPS = 8  # of the three dimensions; raking contracts by a factor per sweep
SEED = "mix"


def topic() -> Column:
    """A coarse topic of ``text``: contact data, tables, symbol noise, short or plain prose."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (
        F.when(text.contains("@"), "contact")
        .when(text.contains(" | "), "table")
        .when(text.contains("***") | text.contains("%%%"), "noise")
        .when(F.length(text) < 400, "brief")
        .otherwise("prose")
    )


def tokens() -> Column:
    """Number of words of ``text``; null counts as none."""
    return F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")


def cell_columns(docs: DataFrame, topics: Column | None = None) -> DataFrame:
    """``docs`` with cell_source, cell_lang and cell_topic; null labels count as ''."""
    labels = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic() if topics is None else topics}
    return docs.withColumns({f"cell_{d}": F.coalesce(labels[d].cast("string"), F.lit("")) for d in DIMENSIONS})


def rake(
    cells: DataFrame,
    targets: Mapping[str, Mapping[str, float] | float] = POWERS,
    rate: float = RATE,
    sweeps: int = SWEEPS,
) -> DataFrame:
    """Inclusion probability per cell of ``cells`` (cell_source, cell_lang, cell_topic, tokens).

    A target is a power of the token share or a mapping of label to share; labels
    without tokens are left out and the shares of the rest are scaled to one, a
    label missing from a mapping gets none. Cells without tokens keep the rate.
    Returns the three labels, tokens and probability (rounded to nine digits, so
    that the order of sums does not show).
    """
    whole = Window.partitionBy(F.lit(1))
    totals = cells.agg(F.sum("tokens").cast("double").alias("all_tokens")).scalar()
    cells = cells.select(
        *[f"cell_{d}" for d in DIMENSIONS], F.col("tokens").cast("double").alias("mass"), F.lit(float(rate)).alias("probability")
    )
    for d in DIMENSIONS:
        wanted = targets[d]
        margin = cells.groupBy(f"cell_{d}").agg(F.sum("mass").alias("label_mass"))
        if isinstance(wanted, Mapping):
            share = F.coalesce(*[F.when(F.col(f"cell_{d}") == F.lit(k), F.lit(float(v))) for k, v in wanted.items()], F.lit(0.0))
            share = F.when(F.col("label_mass") > 0, share).otherwise(0.0)
        else:
            share = F.pow("label_mass", F.lit(float(wanted)))
        # One row per label of this dimension.
        margin = margin.withColumn("share", share).withColumn("share", F.col("share") / F.sum("share").over(whole))
        cells = cells.join(margin.select(f"cell_{d}", F.col("share").alias(f"share_{d}")), f"cell_{d}")
    cells = land(cells.withColumn("wanted", totals * F.lit(float(rate))))
    for _ in range(sweeps):
        for d in DIMENSIONS:
            expected = F.sum(F.col("mass") * F.col("probability")).over(Window.partitionBy(f"cell_{d}"))
            factor = F.when(expected > 0, F.col(f"share_{d}") * F.col("wanted") / expected).otherwise(1.0)
            cells = cells.withColumn("probability", F.least(F.lit(1.0), F.col("probability") * factor))
        # One short plan per sweep: the plan of all sweeps together would fill the driver.
        cells = land(cells)
    return cells.select(
        *[f"cell_{d}" for d in DIMENSIONS], F.col("mass").cast("long").alias("tokens"), F.round("probability", 9).alias("probability")
    )


def mixture(docs: DataFrame, seed: str = SEED, **raking) -> DataFrame:
    """The decision for every row of ``docs`` (doc_id, text, lang, source).

    Returns doc_id, source, lang, topic, n_tokens, probability and kept. Equal
    doc_ids get equal numbers, so rows of one cell and id are kept or left
    together. An empty table gives no rows. Other columns are ignored.
    """
    rows = land(
        cell_columns(docs.select("doc_id", "text", "lang", "source")).select(
            "doc_id", "source", "lang", F.col("cell_topic").alias("topic"), *[f"cell_{d}" for d in DIMENSIONS], tokens().alias("n_tokens")
        )
    )
    cells = land(rake(_cells(rows), **raking))
    return _drawn(rows.join(cells, [f"cell_{d}" for d in DIMENSIONS]), seed).select(
        "doc_id", "source", "lang", "topic", "n_tokens", "probability", "kept"
    )


def mix(docs: DataFrame, seed: str = SEED, **raking) -> DataFrame:
    """The drawn rows of ``docs``, all columns as they were."""
    keyed = cell_columns(docs)
    cells = land(rake(_cells(keyed.select(*[f"cell_{d}" for d in DIMENSIONS], tokens().alias("n_tokens"))), **raking))
    return _drawn(keyed.join(cells, [f"cell_{d}" for d in DIMENSIONS]), seed).where("kept").select(docs.columns)


def _cells(rows: DataFrame) -> DataFrame:
    return land(rows.groupBy([f"cell_{d}" for d in DIMENSIONS]).agg(F.sum("n_tokens").alias("tokens")))


def _drawn(rows: DataFrame, seed: str) -> DataFrame:
    u = md5_key(seed, F.col("doc_id")).cast("double") / F.lit(float(1 << 60))
    return rows.withColumn("kept", u < F.col("probability"))
