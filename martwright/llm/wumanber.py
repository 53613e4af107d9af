"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are windows of 13 consecutive words of benchmark items (all words of a
shorter item). A table gives for each block of two words how far the search may
move on, as no pattern can end nearer; blocks that end a pattern select the
patterns to compare word by word. Words play the part of characters, so one
step skips up to 12 words.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 13
# Benchmark bytes that are searched for at once; more are taken in further passes.
BLOCK_BYTES = 16 << 20
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of UTF-8 in lower case: all but ASCII signs


def words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case; null has none."""
    return _WORD.findall(text.encode().lower()) if text else []


class Patterns:
    """Shift tables and suffix buckets per pattern length."""

    def __init__(self, items: list[tuple]) -> None:
        found: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            w = words(text)
            m = min(len(w), WINDOW)
            for i in range(len(w) - m + 1 if m else 0):
                found[m][tuple(w[i : i + m])].add(item)
        self.tables = [self._table(m, windows) for m, windows in sorted(found.items())]

    @staticmethod
    def _table(m: int, windows: dict[tuple, set]) -> tuple:
        block = min(2, m)
        shift: dict[tuple, int] = {}
        buckets: dict[tuple, dict[bytes, list]] = defaultdict(lambda: defaultdict(list))
        for window, items in windows.items():
            for j in range(block, m + 1):
                key = window[j - block : j]
                shift[key] = min(shift.get(key, m), m - j)
            # The first word narrows a bucket further before words are compared.
            buckets[window[m - block :]][window[0]].append((list(window), sorted(i for i in items if i is not None)))
        return m, block, shift, {k: dict(v) for k, v in buckets.items()}

    def search(self, w: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged spans of words that occur in patterns, and the items they are from."""
        spans: list[tuple[int, int]] = []
        items: set = set()
        n = len(w)
        for m, block, shift, buckets in self.tables:
            step, at = m - block + 1, m
            while at <= n:
                key = tuple(w[at - block : at])
                move = shift.get(key, step)
                if move:
                    at += move
                    continue
                for window, ids in buckets[key].get(w[at - m], ()):
                    if w[at - m : at] == window:
                        spans.append((at - m, at))
                        items.update(ids)
                at += 1
        merged: list[tuple[int, int]] = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        return merged, items


def contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Benchmark hits for every row of ``docs`` (doc_id, text); ``benchmark`` has item_id, text.

    Returns doc_id, n_words, n_hit, n_items, items_sha256 and contaminated. Null
    text has no words; items without words match nothing; hits of an item with a
    null id count as hits but name no item. The benchmark is searched for in
    blocks of bounded bytes; for one block there is no shuffle at all.
    """
    bench = benchmark.select("item_id", "text").where("text is not null")
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = math.ceil(size / block_bytes) or 1
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    if n_blocks == 1:
        return rows.mapInArrow(_hits(bench, 1, 0), _RESULT)
    return _in_blocks(rows, bench, n_blocks)


_RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
_NAMES = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def _row(n_words: int, spans: list, items: set) -> tuple:
    hit = sum(b - a for a, b in spans)
    digest = hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
    return n_words, hit, len(items), digest, bool(hit) and 20 * hit >= n_words


def _patterns(bench: DataFrame, n_blocks: int, block: int):
    part = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block)
    built = Patterns([(r["item_id"], r["text"]) for r in part.collect()])  # about block_bytes
    return bench.sparkSession.sparkContext.broadcast(built.tables)


def _hits(bench: DataFrame, n_blocks: int, block: int):
    shared = _patterns(bench, n_blocks, block)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Patterns([])
        search.tables = shared.value
        for batch in batches:
            found = [_row(len(w), *search.search(w)) for w in map(words, (t.as_py() for t in batch.column("text")))]
            columns = [list(c) for c in zip(*found, strict=True)] or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            yield pa.record_batch(
                [batch.column("doc_id").cast(pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], _NAMES
            )

    return scan


def _in_blocks(rows: DataFrame, bench: DataFrame, n_blocks: int) -> DataFrame:
    """Spans and items of each block per distinct text that has any, joined per text."""
    spans_type = "text_key string, starts array<long>, ends array<long>, items array<string>"
    keyed = rows.withColumn("text_key", F.sha2(F.coalesce("text", F.lit("")), 256))

    def scan_of(shared):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            search = Patterns([])
            search.tables = shared.value
            for batch in batches:
                out = []
                for key, text in zip(batch.column("text_key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    spans, items = search.search(words(text))
                    if spans:
                        out.append((key, [a for a, _ in spans], [b for _, b in spans], list(map(str, items))))
                if out:
                    kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())]
                    yield pa.record_batch(
                        [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                        ["text_key", "starts", "ends", "items"],
                    )

        return scan

    found = None
    for block in range(n_blocks):
        part = keyed.select("text_key", "text").mapInArrow(scan_of(_patterns(bench, n_blocks, block)), spans_type)
        found = part if found is None else found.union(part)
    # Copies of a text bring the same spans; one of each block and content is enough.
    per_text = found.distinct().groupBy("text_key").agg(
        F.flatten(F.collect_list("starts")).alias("starts"),
        F.flatten(F.collect_list("ends")).alias("ends"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                merged: list[list[int]] = []
                for a, b in sorted(zip(r["starts"] or [], r["ends"] or [], strict=True)):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                out.append((r["doc_id"], *_row(r["n_words"], merged, set(r["items"] or []))))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], _NAMES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(words(t)) for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [batch.column("doc_id").cast(pa.int64()), batch.column("text_key"), pa.array(n, pa.int64())], ["doc_id", "text_key", "n_words"]
            )

    counted = keyed.mapInArrow(count, "doc_id long, text_key string, n_words long")
    return counted.join(per_text, "text_key", "left").drop("text_key").mapInArrow(finish, _RESULT)


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, all columns as they were.

    Each row is judged by its own text. One block of benchmark items needs no
    shuffle; with more, rows meet the verdict on their text by its hash.
    """
    bench = benchmark.select("item_id", "text").where("text is not null")
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = math.ceil(size / block_bytes) or 1
    if n_blocks == 1:
        shared = _patterns(bench, 1, 0)

        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            search = Patterns([])
            search.tables = shared.value
            for batch in batches:
                keep = []
                for text in batch.column("text"):
                    w = words(text.as_py())
                    keep.append(not _row(len(w), *search.search(w))[-1])
                yield batch.filter(pa.array(keep, pa.bool_()))

        return docs.mapInArrow(clean, docs.schema)
    # Null and empty texts have no words and stay.
    key = F.sha2(F.coalesce("text", F.lit("")), 256)
    by_text = docs.select(F.lit(0).cast("long").alias("doc_id"), "text").distinct()
    marked = by_text.withColumn("doc_id", F.xxhash64("text"))
    bad = contamination(marked, bench, block_bytes).where("contaminated").select("doc_id").distinct()
    texts = marked.join(bad, "doc_id", "left_semi").select(key.alias("__text_key"))
    return docs.withColumn("__text_key", key).join(texts, "__text_key", "left_anti").select(docs.columns)
