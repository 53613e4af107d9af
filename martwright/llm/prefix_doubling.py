"""Repeated passages by distributed prefix doubling over names of byte strings.

Prefix doubling names the strings of one length, and the pair of names at an
offset names the strings of twice (or up to twice) that length. Here a name is a
64-bit hash, so names of all positions are made in the task that holds the text
(8, 16, then ``LAYOUT.k`` bytes, then the threshold), and Spark sorts names with
their documents at growing lengths and drops what is unique:

1. Every string of threshold length holds one anchor, picked by its content
   alone (a mod-minimizer, about 6 of 100 positions). Names of the anchors'
   k bytes are grouped; those of one document only are dropped.
2. Neighbouring strings with one anchor form a segment. Equal segments are
   grouped: all but those of the smallest document are repeats as a whole.
3. Where one anchor stands in different segments, the strings of the threshold
   length in one copy of each are grouped. Past the threshold nothing is left
   to tell apart, and the rounds end.

A task first groups what it holds itself: only the smallest document of a name
goes on, so a passage in a third of all documents is one row per batch. Texts
are shuffled by document in rounds 2 and 3 and for the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import land, release

THRESHOLD = 50
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LOW = np.uint64((1 << 32) - 1)
BATCH_BYTES = 8 << 20  # of text that a task groups at once


class Layout(NamedTuple):
    """Threshold, bytes of an anchor, and bytes whose order picks it (k = t modulo the windows of a string)."""

    threshold: int
    k: int
    t: int


def layout(threshold: int = THRESHOLD) -> Layout:
    """The layout with the fewest anchors among those whose two anchors' lengths reach the threshold."""
    if not 32 <= threshold < 1 << 12:
        raise ValueError("the threshold must be from 32 to 4095 bytes")
    best = None
    for k in range((threshold + 1) // 2, threshold * 3 // 4):
        w = threshold - k + 1
        t = 4 + (k - 4) % w
        density = ((threshold - t) // w + 2) / (threshold - t + 2)
        if t <= 8 and (best is None or density < best[0]):
            best = (density, Layout(threshold, k, t))
    if best is None:
        raise ValueError("no layout for this threshold")
    return best[1]


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Names of pairs of names."""
    y = b * _B
    y ^= y >> np.uint64(29)
    y += a * _A
    y ^= y >> np.uint64(32)
    y *= _A
    y ^= y >> np.uint64(29)
    return y


def names(raw: bytes, length: int) -> np.ndarray:
    """Names of all strings of ``length`` (8 or more) bytes in ``raw``, by doubling from 8 bytes."""
    n = len(raw)
    if n < length:
        return np.empty(0, np.uint64)
    have = 8
    name = np.ndarray((n - 7,), "<u8", buffer=raw, strides=(1,)) * _A
    name ^= name >> np.uint64(31)
    while have < length:
        step = min(have, length - have)
        name = _pair(name[: len(name) - step], name[step:])
        have += step
    return name


def anchors(raw: bytes, plan: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Anchor position of every string of threshold length, and the names of all strings of k bytes."""
    n, w = len(raw), plan.threshold - plan.k + 1
    small = np.ndarray((n,), "<u8", buffer=raw + b"\0" * 8, strides=(1,)) & np.uint64((1 << 8 * plan.t) - 1)
    small = small * _B
    small ^= small >> np.uint64(30)
    small *= _A
    # The position in the low bits makes the leftmost of equal ones the smallest.
    count = n - plan.t + 1
    best = (small[:count] & ~_LOW) | (np.arange(count, dtype=np.uint64) & _LOW)
    width, have = plan.threshold - plan.t + 1, 1
    while have < width:
        step = min(have, width - have)
        best = np.minimum(best[: len(best) - step], best[step:])
        have += step
    start = np.arange(n - plan.threshold + 1, dtype=np.int64)
    offset = (best & _LOW).astype(np.int64) - start
    return start + offset % w, names(raw, plan.k)


def _first_of(key: np.ndarray, doc: np.ndarray, second: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each row: the smallest document and the largest with its key."""
    columns = (doc, key) if second is None else (doc, second, key)
    order = np.lexsort(columns)
    new = np.r_[True, key[order][1:] != key[order][:-1]] if len(key) else np.empty(0, bool)
    if second is not None and len(key):
        new |= np.r_[True, second[order][1:] != second[order][:-1]]
    start = np.flatnonzero(new)
    length = np.diff(np.append(start, len(key)))
    low, high = np.empty_like(doc), np.empty_like(doc)
    low[order] = np.repeat(doc[order][start], length)
    high[order] = np.repeat(doc[order][start + length - 1], length)
    return low, high


def _spread(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A key of its own for rows that need no partner."""
    return _pair(a ^ _B, b.view(np.uint64))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    step = max(1, int(len(batch) * BATCH_BYTES / max(1, batch.nbytes)))
    for at in range(0, len(batch), step):
        yield batch.slice(at, step)


def _texts(docs: DataFrame) -> DataFrame:
    """Rows with an id, their text and its hash (rows that repeat an id are told apart by it)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc"), text.alias("text"), F.hash(text).cast("long").alias("text_key"))


def _shared_anchors(docs: DataFrame, plan: Layout) -> DataFrame:
    """Round 1: per document the names of its anchors that other documents have too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole):
                found, owner = [], []
                for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    raw = text.encode()
                    if len(raw) >= plan.threshold:
                        at, name = anchors(raw, plan)
                        found.append(np.unique(name[at[np.r_[True, at[1:] != at[:-1]]]]))
                        owner.append(np.full(len(found[-1]), doc, np.int64))
                if not found:
                    continue
                name, doc = np.concatenate(found), np.concatenate(owner)
                low, high = _first_of(name, doc)
                here, alone = low < high, doc == low
                slot = np.concatenate((name[alone], _spread(name[here], doc[here])))
                known = np.concatenate((np.zeros(alone.sum(), np.uint64), name[here])).view(np.int64)
                mask = np.concatenate((np.ones(alone.sum(), bool), np.zeros(here.sum(), bool)))
                yield pa.record_batch(
                    [pa.array(slot.view(np.int64)), pa.array(np.concatenate((doc[alone], doc[here]))), pa.array(known, mask=mask)],
                    ["slot", "doc", "name"],
                )

    rows = _texts(docs).where("doc is not null").select("doc", "text").mapInArrow(run, "slot long, doc long, name long")
    group = Window.partitionBy("slot")
    shared = rows.withColumns({"low": F.min("doc").over(group), "high": F.max("doc").over(group)}).where("name is not null or low < high")
    return land(shared.groupBy("doc").agg(F.collect_set(F.coalesce("name", "slot")).alias("names")))


def _segments(docs: DataFrame, shared: DataFrame, plan: Layout) -> DataFrame:
    """Round 2: segments that are repeats as a whole, and those to be looked into (both by document)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole):
                rows: list[list[np.ndarray]] = []
                for doc, key, text, kept in zip(
                    batch.column("doc").to_pylist(), batch.column("text_key").to_pylist(), batch.column("text"), batch.column("names"), strict=True
                ):
                    raw = text.as_py().encode()
                    if len(raw) < plan.threshold:
                        continue
                    at, name = anchors(raw, plan)
                    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                    last = np.append(first[1:], len(at)) - 1
                    name = name[at[first]]
                    ok = np.isin(name, kept.values.to_numpy(zero_copy_only=False).view(np.uint64))
                    first, last, name = first[ok], last[ok], name[ok]
                    content = [xxhash.xxh3_64_intdigest(raw[a : b + plan.threshold]) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                    n = len(first)
                    rows.append([name, np.array(content, np.uint64), np.full(n, doc, np.int64), np.full(n, key, np.int64), first, last])
                if not rows:
                    continue
                name, content, doc, key, first, last = (np.concatenate(c) for c in zip(*rows, strict=True))
                low, _ = _first_of(name, doc, content)
                done = doc > low
                slot = np.where(done, _spread(name, doc), name)
                yield pa.record_batch(
                    [pa.array(x) for x in (slot.view(np.int64), content.view(np.int64), doc, key, first.astype(np.int32), last.astype(np.int32), done)],
                    ["slot", "content", "doc", "text_key", "first", "last", "done"],
                )

    schema = "slot long, content long, doc long, text_key long, first int, last int, done boolean"
    rows = _texts(docs).join(shared, "doc").select("doc", "text_key", "text", "names").mapInArrow(run, schema)
    # Dealt by anchor, so that both groupings come from one shuffle and one sort.
    anchor, segment = Window.partitionBy("slot"), Window.partitionBy("slot", "content")
    judged = (
        rows.repartition("slot")
        .withColumn("low", F.min("doc").over(segment))
        .withColumn("done", F.col("done") | (F.col("doc") > F.col("low")))
        .withColumn("open", ~F.col("done") & (F.min("content").over(anchor) < F.max("content").over(anchor)))
        .where("done or open")
    )
    return land(judged.select("doc", "text_key", "first", "last", "done"))


def _strings(docs: DataFrame, segments: DataFrame, plan: Layout) -> DataFrame:
    """Round 3: spans of strings of threshold length that a smaller document has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole):
                rows: list[list[np.ndarray]] = []
                for doc, key, text, opened in zip(
                    batch.column("doc").to_pylist(), batch.column("text_key").to_pylist(), batch.column("text"), batch.column("opened"), strict=True
                ):
                    raw = text.as_py().encode()
                    inside = opened.values.flatten()
                    first, last = (x.to_numpy(zero_copy_only=False) for x in inside)
                    if len(raw) < plan.threshold:
                        continue
                    length = last - first + 1
                    at = np.repeat(first - np.cumsum(length) + length, length) + np.arange(length.sum())
                    name = names(raw, plan.threshold)[at]
                    anchor, part = anchors(raw, plan)
                    n = len(at)
                    rows.append([name, part[anchor[at]], np.full(n, doc, np.int64), np.full(n, key, np.int64), at.astype(np.int64)])
                if not rows:
                    continue
                name, part, doc, key, at = (np.concatenate(c) for c in zip(*rows, strict=True))
                low, _ = _first_of(name, doc, part)
                done = doc > low
                slot = np.where(done, _spread(name, doc), name)
                columns = (slot.view(np.int64), part.view(np.int64), doc, key, at.astype(np.int32), done)
                yield pa.record_batch([pa.array(x) for x in columns], ["slot", "part", "doc", "text_key", "first", "done"])

    opened = segments.where("not done").groupBy("doc", "text_key").agg(F.collect_list(F.struct("first", "last")).alias("opened"))
    schema = "slot long, part long, doc long, text_key long, first int, done boolean"
    rows = _texts(docs).join(opened, ["doc", "text_key"]).select("doc", "text_key", "text", "opened").mapInArrow(run, schema)
    low = F.min("doc").over(Window.partitionBy("slot", "part"))
    found = rows.withColumn("low", low).where("done or doc > low")
    # One row per text: strings that follow each other become spans in the last step.
    return land(found.groupBy("doc", "text_key").agg(F.collect_list("first").alias("starts")))


def repeats(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc, text_key and spans (starts, lengths of the string starts in a row) of all repeats."""
    plan = layout(threshold)
    shared = _shared_anchors(docs, plan)
    release(docs.sparkSession)
    segments = _segments(docs, shared, plan)
    release(docs.sparkSession)
    single = _strings(docs, segments, plan)
    release(docs.sparkSession)
    whole = segments.where("done").groupBy("doc", "text_key").agg(F.collect_list(F.struct("first", "last")).alias("whole"))
    return whole.join(single, ["doc", "text_key"], "full")


def _covered(n: int, threshold: int, whole: list | None, starts: np.ndarray) -> np.ndarray:
    """Mask of the removed bytes."""
    edge = np.zeros(n + 1, np.int64)
    if whole is not None:
        first, last = (x.to_numpy(zero_copy_only=False) for x in whole.flatten())
        np.add.at(edge, first, 1)
        np.add.at(edge, last + threshold, -1)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + threshold, -1)
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame, threshold: int = THRESHOLD, keep_bytes: bool = False) -> DataFrame:
    """Take repeated bytes out of every row of ``docs`` (doc_id, text).

    A byte goes if a string of ``threshold`` bytes that covers it starts in a
    document with a smaller doc_id as well. Returns doc_id, n_bytes, n_removed,
    n_spans and kept_sha256, and kept_bytes if asked for. Null text is empty. Rows
    without a doc_id come before and after nothing: they stay whole. Rows that
    repeat a doc_id are judged each by its text and never against each other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, whole, single in zip(batch.column("text"), batch.column("whole"), batch.column("starts"), strict=True):
                raw = text.as_py().encode()
                if not whole.is_valid and not single.is_valid:
                    out.append((len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), raw))
                    continue
                starts = single.values.to_numpy(zero_copy_only=False) if single.is_valid else np.empty(0, np.int64)
                gone = _covered(len(raw), threshold, whole.values if whole.is_valid else None, starts)
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            made = [batch.column("doc"), *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))]
            yield pa.record_batch(made[: 6 if keep_bytes else 5], result[: 6 if keep_bytes else 5])

    result = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"]
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept_bytes binary" if keep_bytes else "")
    found = repeats(docs, threshold)
    return _texts(docs).join(found, ["doc", "text_key"], "left").select("doc", "text", "whole", "starts").mapInArrow(run, schema)
