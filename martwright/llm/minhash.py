"""Near-duplicate documents by circulant MinHash, banding and exact verification.

A document is its set of word shingles, of two words unless stated. Two permutations make all signature
coordinates: sigma scatters the shingles once, and coordinate k is the minimum of
pi over the scattered values shifted circularly by k. Bands of coordinates give
buckets. Equal sets are one class from the start; classes meet in buckets.

Pairs within a bucket are not listed. Each round takes a few members of every
bucket (hubs) and compares them with the members that are not yet in their
component; then the hubs leave the bucket. Members of the smallest components
are hubs first, so a bucket closes as soon as only its largest component is
left. No link between different components is missed, and thousands of copies
cost one comparison each.

Lengths and the parities of the sets rule out most pairs inside the bucket join
without losing a link; what is left is decided on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import land, prune_with_bloom, release

# With 40 bands of 6, a pair at similarity 0.8 meets in no bucket with probability 5e-6.
BANDS, ROWS = 40, 6
SHINGLE = 2
PERCENT = 80
# Per bucket and round after the first, which has one; the last number goes on. Up to 1000, Spark plans a group limit.
HUBS = (32, 1000)
WORDS = 4  # 64-bit words of a set's parities
CACHE = 200_000  # words whose hashes a worker remembers
SLOTS = 1 << 17  # words of 64 bits that tell which rows may have been dropped

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x *= _A
    x ^= x >> np.uint64(27)
    x *= _B
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, cache: dict[bytes, int] | None = None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit shingle ids of a text; fewer words make one shingle, no words none."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    cache = {} if cache is None else cache
    if len(cache) > CACHE:
        cache.clear()
    ids = []
    for w in words:
        h = cache.get(w)
        if h is None:
            h = cache[w] = xxhash.xxh3_64_intdigest(w)
        ids.append(h)
    hashes = np.array(ids, np.uint64)
    width = min(size, len(words))
    value = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        value = _mix(value * _A + hashes[i : len(hashes) - width + 1 + i])
    return np.unique(value)


def signature(ids: np.ndarray, coordinates: int = BANDS * ROWS) -> np.ndarray:
    """Circulant MinHash: minimum over pi(sigma(x) + k) for k = 0, 1, ... on a circle of 2^32."""
    scattered = (_mix(ids ^ _B) >> np.uint64(32)).astype(np.uint32)
    shifts = np.arange(coordinates, dtype=np.uint32)[:, None]
    best = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(scattered), 1024):
        x = scattered[None, at : at + 1024] + shifts
        # pi: the finalizer of MurmurHash3, a permutation of 32-bit numbers.
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        x *= np.uint32(0xC2B2AE35)
        x ^= x >> np.uint32(16)
        np.minimum(best, x.min(1), out=best)
    return best


def _band_keys(best: np.ndarray) -> np.ndarray:
    rows = best.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        key = _mix(key * _A + rows[:, i])
    return key.view(np.int64)


def parities(ids: np.ndarray) -> np.ndarray:
    """Bit b tells whether an odd number of shingles fall on b, so two sets differ in at least as many shingles as bits."""
    odd = np.bincount((ids & np.uint64(64 * WORDS - 1)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def signatures(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, a 128-bit key of the shingle set, its band keys and parities, and a key of the text for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        for batch in batches:
            sizes, keys, bands, bits = [], [], [], []
            for text in batch.column("text"):
                ids = shingles(text.as_py(), cache, size)
                sizes.append(len(ids))
                keys.append(xxhash.xxh3_128_digest(ids.tobytes()))
                bands.append(_band_keys(signature(ids)) if len(ids) else np.empty(0, np.int64))
                bits.append(parities(ids))
            yield pa.record_batch(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(bits, pa.list_(pa.int64())),
                    batch.column("text_key"),
                ],
                ["doc_id", "n_shingles", "set_key", "bands", "bits", "text_key"],
            )

    text = F.col("text").cast("string")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    return plain.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, bands array<long>, bits array<long>, text_key long")


def _sets(texts: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        for batch in batches:
            packed = [shingles(t.as_py(), cache, size).tobytes() for t in batch.column("text")]
            yield pa.record_batch([*(batch.column(c) for c in ("node", "as_a", "as_b")), pa.array(packed, pa.binary())], ["node", "as_a", "as_b", "ids"])

    return texts.mapInArrow(run, "node long, as_a boolean, as_b boolean, ids binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ids_a"), batch.column("ids_b"), strict=True):
                one, two = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.sort(np.concatenate((one, two)))
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.where("as_a").select(F.col("node").alias("a"), F.col("ids").alias("ids_a"))
    right = sets.where("as_b").select(F.col("node").alias("b"), F.col("ids").alias("ids_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ids_a", "ids_b").mapInArrow(run, "a long, b long")


def _confirmed(docs: DataFrame, pairs: DataFrame, percent: int, size: int) -> DataFrame:
    """The links among ``pairs`` (a, b); only texts of classes in a pair are shuffled and become sets."""
    pairs = land(pairs)
    if pairs.isEmpty():
        return pairs
    ends = [pairs.select(F.col(end).alias("node"), F.lit(end == "a").alias("as_a"), F.lit(end == "b").alias("as_b")) for end in ("a", "b")]
    nodes = land(ends[0].union(ends[1]).groupBy("node").agg(F.max("as_a").alias("as_a"), F.max("as_b").alias("as_b")))
    # ``as_a or as_b`` holds for all; as a stated condition it lets Spark build the Bloom filter.
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text")).join(nodes.where("as_a or as_b"), "node")
    return land(_verified(pairs, land(_sets(texts, size)), percent))


def components(edges: DataFrame) -> DataFrame:
    """node and component (smallest node reachable) for the ends of ``edges`` (a, b).

    Each step takes the smallest label among neighbours and then the label of
    that label, so chains shorten by halves. No list of neighbours is built.
    """
    both = land(edges.select("a", "b").union(edges.select("b", "a")).toDF("node", "other").distinct())
    labels = land(both.groupBy("node").agg(F.min("other").alias("near")).select("node", F.least("node", "near").alias("component")))
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("other"), F.col("component").alias("seen")), "other")
            .groupBy("node")
            .agg(F.min("seen").alias("seen"))
        )
        least = land(labels.join(near, "node").select("node", "component", F.least("component", "seen").alias("least")))
        roots = least.select(F.col("node").alias("least"), F.col("least").alias("root"))
        labels_next = land(
            least.join(roots, "least").select("node", F.least("least", "root").alias("component"), (F.least("least", "root") < F.col("component")).alias("moved"))
        )
        labels = labels_next.select("node", "component")
        if labels_next.where("moved").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """Component of every row of ``docs`` (doc_id, text) under the similarity of shingles of ``size`` words.

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable over links,
    itself included) and kept (doc_id = component_id). Texts that are null or have
    no words, and rows without a doc_id, are linked with nothing; a null doc_id is
    kept. Rows that repeat a doc_id share its component if their texts agree.
    Empty tables give no rows; other columns are ignored.
    """
    return _verdicts(docs, percent, size).drop("text_key")


def _verdicts(docs: DataFrame, percent: int, size: int) -> DataFrame:
    """``near_duplicates`` with the key of each row's text."""
    spark = docs.sparkSession
    prune_with_bloom(spark)
    signed = land(signatures(docs, size))
    usable = signed.where("n_shingles > 0 and doc_id is not null")
    same = [F.first(c).alias(name) for c, name in (("n_shingles", "n"), ("bands", "bands"), ("bits", "bits"))]
    classes = land(usable.groupBy("set_key").agg(F.min("doc_id").alias("node"), *same))
    labels = _link(docs, classes, percent, size)
    named = classes.select("set_key", "node").join(labels, "node", "left").select("set_key", F.coalesce("component", "node").alias("component"))
    return signed.join(named, "set_key", "left").select(
        "doc_id",
        "n_shingles",
        F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.least("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "text_key",
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _possible(percent: int) -> str:
    """Length and parity filters for a member and a hub (hub_) of its bucket; they hold for all similar pairs."""
    needed = f"(({percent} * (n + hub_n) + {99 + percent}) div {100 + percent})"
    differ = " + ".join(f"bit_count(bits_{i} ^ hub_bits_{i})" for i in range(WORDS))
    return f"100 * least(n, hub_n) >= {percent} * greatest(n, hub_n) and {differ} <= n + hub_n - 2 * {needed}"


def _link(docs: DataFrame, classes: DataFrame, percent: int, size: int) -> DataFrame:
    """node and component of all classes that have a link."""
    spark = docs.sparkSession
    columns = ["bucket", "node", "n", *(f"bits_{i}" for i in range(WORDS))]
    # Only bucket and node are shuffled for all classes; the rest joins those that share a bucket.
    entries = classes.select(F.explode("bands").alias("bucket"), "node")
    shared = entries.groupBy("bucket").agg(F.min("node").alias("hub_node"), F.max("node").alias("last")).where("hub_node < last").select("bucket", "hub_node")
    facts = classes.select("node", "n", *(F.col("bits")[i].alias(f"bits_{i}") for i in range(WORDS)))
    of_hub = facts.select(*(F.col(c).alias(f"hub_{c}") for c in facts.columns))
    # The first round: every class is a component of its own, and the first class of a bucket is the hub.
    met = entries.join(shared, "bucket").join(facts, "node").join(of_hub, "hub_node")
    members = land(met.select(*columns, "hub_node", F.expr(f"node != hub_node and {_possible(percent)}").alias("possible")))
    involved = members.select("node").distinct()
    links = _confirmed(docs, members.where("possible").select(F.col("hub_node").alias("a"), F.col("node").alias("b")).distinct(), percent, size)
    members = members.where("node != hub_node").select(columns)
    # 31 bits of each band key tell which bucket of a pair is the first; they agree by chance far less often than bands miss a link.
    names = land(classes.join(involved, "node", "left_semi").select("node", F.expr("transform(bands, b -> cast(b & 2147483647 as int))").alias("names")))
    # No rows yet; made without the Python workers that a local list would start.
    labels = spark.range(0).select(F.col("id").alias("node"), F.col("id").alias("component"))
    rounds = 0
    while True:
        if not links.isEmpty():
            labels = _merge(labels, links)
        named = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        sizes = named.groupBy("bucket", "component").agg(F.count("*").alias("size"))
        open_ = sizes.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("bucket")
        placed = land(named.join(sizes.join(open_, "bucket"), ["bucket", "component"]).select(*columns, "component", "size"))
        release(spark)
        if placed.isEmpty():
            return labels
        count = HUBS[min(rounds, len(HUBS) - 1)]
        rounds += 1
        rank = F.row_number().over(Window.partitionBy("bucket").orderBy("size", "node"))
        chosen = placed.withColumn("rank", rank).where(F.col("rank") <= count)
        hubs = land(chosen.select("bucket", *(F.col(c).alias(f"hub_{c}") for c in [*columns[1:], "component"])))
        # A pair may share many buckets; it counts in the first of them only.
        first_shared = "get(array_intersect(names, hub_names), 0) = cast(bucket & 2147483647 as int)"
        pairs = (
            placed.join(names, "node")
            .join(hubs.join(names.select(F.col("node").alias("hub_node"), F.col("names").alias("hub_names")), "hub_node"), "bucket")
            .where(f"component != hub_component and {_possible(percent)} and {first_shared}")
            .select(F.least("node", "hub_node").alias("a"), F.greatest("node", "hub_node").alias("b"))
            .distinct()
        )
        links = _confirmed(docs, pairs, percent, size)
        # Hubs have been compared with all others of their bucket.
        members = placed.select(columns).join(hubs.select("bucket", F.col("hub_node").alias("node")), ["bucket", "node"], "left_anti")


def _merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components after new links: links between components are solved and the labels replaced."""
    named = links
    for end in ("a", "b"):
        old = labels.select(F.col("node").alias(end), F.col("component").alias(f"{end}_in"))
        named = named.join(old, end, "left").withColumn(end, F.coalesce(f"{end}_in", end)).drop(f"{end}_in")
    merged = components(named.where("a != b").distinct()).toDF("component", "merged")
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    known = ends.join(labels, "node", "full").select("node", F.coalesce("component", "node").alias("component"))
    return land(known.join(merged, "component", "left").select("node", F.coalesce("merged", "component").alias("component")))


def deduplicate(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """Rows of ``docs`` that are the first of their component, all columns as they were.

    Rows that repeat a doc_id are judged by their own texts; rows with the same doc_id and text go or stay together.
    """
    dropped = land(_verdicts(docs, percent, size).where("not kept").select(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__text")).distinct())
    hashed = F.xxhash64("__doc", "__text")
    place = {"__slot": hashed.bitwiseAND(F.lit(SLOTS - 1)), "__bit": F.shiftrightunsigned(hashed, 40).bitwiseAND(F.lit(63)).cast("int")}
    # At most SLOTS rows of 64 bits. A row without its bit stays for sure; only texts of the others are shuffled.
    slots = dropped.withColumns(place).groupBy("__slot").agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__bits"))
    keyed = docs.withColumns({"__doc": F.col("doc_id").cast("long"), "__text": F.xxhash64(F.col("text").cast("string"))}).withColumns(place)
    marked = keyed.join(F.broadcast(slots), "__slot", "left").withColumn("__open", F.expr("coalesce(shiftright(__bits, __bit) & 1, 0) = 1"))
    open_ = marked.where("__open").join(dropped, ["__doc", "__text"], "left_anti")
    return marked.where("not __open").select(docs.columns).union(open_.select(docs.columns))
