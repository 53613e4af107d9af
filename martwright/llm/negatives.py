"""Hard negatives by Kronecker-packed inner products.

Components become whole numbers. Of several candidates one component each is
shifted by a bias, so that none is below zero, and put into separated fields of
one wide integer. Multiplying that integer once by an anchor's component
multiplies all of them; the sum over the components, less the anchor's share of
the bias, holds the exact inner products of all these candidates, one in each
field. Fields are as wide as the largest possible score (by Cauchy and Schwarz);
they go into 64-bit words, or into one unbounded integer per candidate where a
score needs more than 64 bits.

Anchors and candidates are dealt into blocks of a fixed size and meet block by
block, so no task gets more than one block of each side. A first pass scores the
candidates of the anchor's own label and keeps its best as positives, a second
one scores the others and keeps those within the margins of each positive. Each
meeting passes on a few rows per anchor, which are ranked again over all blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import land

# Rows of a block, and anchors that meet it at a time inside the task.
BLOCK = 8192
SLICE = 256
ANCHOR_EVERY = 50
POSITIVES, NEGATIVES = 5, 3
# Margins in percent of the positive's score.
LOW, HIGH = 50, 95
SCALE = 256


def prepared(rows: DataFrame) -> DataFrame:
    """row (a number of its own), vec_id, label and parts of the rows of ``rows`` (vec_id, label, embedding) that take part."""
    vec_id = F.col("vec_id").cast("long")
    label = F.col("label").cast("long")
    parts = F.col("embedding").cast("array<double>")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return (
        rows.select(vec_id.alias("vec_id"), label.alias("label"), parts.alias("parts"), moved.alias("moved"))
        .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("parts").isNotNull())
        .where(F.forall("parts", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
        .select(
            F.monotonically_increasing_id().alias("row"),
            "vec_id",
            F.col("moved").alias("label"),
            F.transform("parts", lambda x: F.floor(x * SCALE)).alias("parts"),
        )
    )


class Packed:
    """Candidates whose components lie in fields of wide integers."""

    def __init__(self, parts: np.ndarray, largest: float) -> None:
        """``parts`` has a row per candidate; ``largest`` bounds the length of the vectors that are multiplied with them."""
        self.count, width = parts.shape
        lengths = float(np.sqrt((parts.astype(float) ** 2).sum(1).max(initial=0.0)))
        score = lengths * largest * (1 + 1e-9) + 2
        self.bias = int(-parts.min(initial=0))
        self.bits = int(np.ceil(np.log2(max(score, float(parts.max(initial=0)) + self.bias)))) + 1
        self.exact = self.bits <= 62
        self.fields = 64 // self.bits if self.exact else 1
        biased = (parts + self.bias).astype(np.uint64) if self.exact else parts.astype(object) + self.bias
        rows = -(-self.count // self.fields)
        padded = np.zeros((rows * self.fields, width), biased.dtype)
        padded[: self.count] = biased
        # Candidates i, i + rows, i + 2 rows, ... share the integers of row i; integers wrap at 2^64, which the exact fields don't notice.
        self.words = padded[:rows].copy()
        for field in range(1, self.fields):
            self.words += padded[field * rows : (field + 1) * rows] << np.uint64(field * self.bits)
        self.words = np.ascontiguousarray(self.words.T)
        self.ones, self.half = sum(1 << (field * self.bits) for field in range(self.fields)), 1 << (self.bits - 1)

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner products of each anchor (row) with each candidate (column)."""
        if not self.exact:
            exact = anchors.astype(object) @ self.words - self.bias * anchors.astype(object).sum(1)[:, None]
            edge = np.iinfo(np.int64)
            return np.clip(exact, edge.min, edge.max).astype(np.int64)
        total = np.zeros((len(anchors), self.words.shape[1]), np.uint64)
        sums = np.zeros(len(anchors), np.uint64)
        for component, word in zip(np.ascontiguousarray(anchors.T).view(np.uint64), self.words, strict=True):
            total += component[:, None] * word
            sums += component
        total += ((np.uint64(self.half) - sums * np.uint64(self.bias)) * np.uint64(self.ones))[:, None]
        mask = np.uint64((1 << self.bits) - 1)
        out = [(total >> np.uint64(field * self.bits) & mask) for field in range(self.fields)]
        return np.concatenate(out, 1)[:, : self.count].astype(np.int64) - self.half


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    """The components of a block, shorter vectors filled up with zeros."""
    parts = table.column("parts").combine_chunks()
    lengths, flat = parts.value_lengths().to_numpy(), parts.flatten().to_numpy()
    out = np.zeros((len(table), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _sides(anchors: pa.Table, candidates: pa.Table) -> tuple[np.ndarray, np.ndarray, float]:
    """Components of both sides and the length of the longest anchor."""
    width = max(1, *(max(t.column("parts").combine_chunks().value_lengths().to_numpy(), default=0) for t in (anchors, candidates)))
    one, two = _matrix(anchors, width), _matrix(candidates, width)
    return one, two, float(np.sqrt((one.astype(float) ** 2).sum(1).max(initial=0.0)))


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _positives(count: int):
    """Best candidates of each anchor's label in a block."""

    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        found = []
        if len(anchors) and len(candidates):
            one, two, largest = _sides(anchors, candidates)
            row, vec_id, label = (_column(candidates, c) for c in ("row", "vec_id", "label"))
            a_row, a_id, a_label = (_column(anchors, c) for c in ("row", "vec_id", "label"))
            for value in np.unique(a_label):
                same = np.flatnonzero(label == value)
                if not len(same):
                    continue
                packed, mine = Packed(two[same], largest), np.flatnonzero(a_label == value)
                for at in range(0, len(mine), SLICE):
                    part = mine[at : at + SLICE]
                    for anchor, scores in zip(part, packed.scores(one[part]), strict=True):
                        others = vec_id[same] != a_id[anchor]
                        for i in _best(scores[others], vec_id[same][others], row[same][others], count):
                            found.append((a_row[anchor], row[same][others][i], vec_id[same][others][i], scores[others][i]))
        return _table(found, ("anchor", "positive", "positive_id", "positive_score"))

    return run


def _best(scores: np.ndarray, vec_id: np.ndarray, row: np.ndarray, count: int) -> np.ndarray:
    """Places of the first ``count`` by score, then smaller id, then row."""
    places = np.arange(len(scores))
    if len(scores) > count:
        places = np.flatnonzero(scores >= np.partition(scores, -count)[-count])
    return places[np.lexsort((row[places], vec_id[places], -scores[places]))][:count]


def _negatives(count: int, low: int, high: int):
    """First candidates of other labels in a block within the margins of each positive."""

    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        found = []
        if len(anchors) and len(candidates):
            one, two, largest = _sides(anchors, candidates)
            row, vec_id, label = (_column(candidates, c) for c in ("row", "vec_id", "label"))
            a_row, a_label, wanted = _column(anchors, "row"), _column(anchors, "label"), anchors.column("positives").to_pylist()
            packed = Packed(two, largest)
            for at in range(0, len(anchors), SLICE):
                for anchor, scores in enumerate(packed.scores(one[at : at + SLICE]), at):
                    bounds = [(p["positive"], -(-low * p["positive_score"] // 100), high * p["positive_score"] // 100) for p in wanted[anchor]]
                    least, most = min(b[1] for b in bounds), max(b[2] for b in bounds)
                    near = np.flatnonzero((scores >= least) & (scores <= most) & (label != a_label[anchor]))
                    near = near[np.lexsort((row[near], vec_id[near], -scores[near]))]
                    falling = -scores[near]
                    for positive, floor, ceiling in bounds:
                        first = int(np.searchsorted(falling, -ceiling))
                        for i in near[first : first + count]:
                            if scores[i] >= floor:
                                found.append((a_row[anchor], positive, row[i], vec_id[i], scores[i]))
        return _table(found, ("anchor", "positive", "negative", "negative_id", "negative_score"))

    return run


def _table(found: list[tuple], names: tuple[str, ...]) -> pa.Table:
    columns = list(zip(*found, strict=True)) or [()] * len(names)
    return pa.table({name: pa.array(column, pa.int64()) for name, column in zip(names, columns, strict=True)})


def _blocks(rows: DataFrame, block: int) -> tuple[Column, int]:
    """The block of a row and the number of blocks."""
    count = max(1, -(-rows.count() // block))
    return F.pmod(F.xxhash64("row"), F.lit(count)).cast("int"), count


def _meet(anchors: DataFrame, candidates: DataFrame, run, schema: str, block: int) -> DataFrame:
    """``run`` on every block of anchors and every block of candidates."""
    a_block, a_count = _blocks(anchors, block)
    c_block, c_count = _blocks(candidates, block)
    left = anchors.withColumn("a_block", a_block).withColumn("c_block", F.explode(F.sequence(F.lit(0), F.lit(c_count - 1))))
    right = candidates.withColumn("c_block", c_block).withColumn("a_block", F.explode(F.sequence(F.lit(0), F.lit(a_count - 1))))
    return left.groupBy("a_block", "c_block").cogroup(right.groupBy("a_block", "c_block")).applyInArrow(run, schema)


def _first(rows: DataFrame, keys: list[str], order: list[Column], count: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= count)


def mine(rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block: int = BLOCK) -> DataFrame:
    """Hard negatives of the anchors among ``rows`` (vec_id, label, embedding).

    Returns anchor_id, positive_id, rank, negative_id, positive_score and negative_score.
    Rows with a null id, label or vector, or with a null or non-finite component, take no
    part; a shorter vector counts as filled up with zeros. Rows that repeat an id are
    rows of their own (among positives only where the id is not the anchor's), and
    those with equal score and id are ordered by their place in the table. Empty tables, anchors without
    positives and positives without negatives give no rows. Scores are exact; those beyond
    64 bits are returned as the nearest 64-bit number. Other columns are ignored.
    """
    table = land(prepared(rows))
    anchors = table.where(F.col("vec_id") % ANCHOR_EVERY == 0)
    near = _meet(anchors, table, _positives(positives), "anchor long, positive long, positive_id long, positive_score long", block)
    best = [F.desc("positive_score"), F.col("positive_id"), F.col("positive")]
    chosen = land(_first(near, ["anchor"], best, positives).drop("rank"))
    listed = chosen.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct("positive", "positive_score")).alias("positives"))
    asking = land(anchors.join(listed, "row"))
    schema = "anchor long, positive long, negative long, negative_id long, negative_score long"
    far = _meet(asking, table, _negatives(negatives, low, high), schema, block)
    ranked = _first(far, ["anchor", "positive"], [F.desc("negative_score"), F.col("negative_id"), F.col("negative")], negatives)
    names = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (
        ranked.join(chosen, ["anchor", "positive"])
        .join(names, "anchor")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )
