"""Near-duplicate lines by an exact set-similarity join, in DataFrame functions only.

The words of a line are a set, ordered from rare to common. Two sets of the
asked similarity must share a word in their prefixes, so lines meet on prefix
words; lengths, the places of the shared word and parities of the sets (64 bits, 128 of long ones)
rule out most pairs, and the Jaccard similarity of the full sets decides. A line goes if an earlier line
(smaller doc_id, then line number) is similar.

Equal sets are one class from the start. The join is done in two steps, as only
one earlier match is needed: first every line meets the earliest line of each of
its sketches, which are its smallest and its largest word hashes. This settles
most lines of large groups of near copies, and loses nothing if it settles none.
Then all lines meet on prefix words, but for pairs whose later line is settled.
The shorter line of a pair shares more of its words, so it needs a prefix of half
the length only.

Words are 58-bit hashes below a 5-bit rarity, so a set is a sorted array of
longs. Rarity is the logarithm of how often words of one of 65,536 hash buckets
occur in the whole table; any order gives right results, this one short joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import land, prune_with_bloom, release

PERCENT = 80
SKETCH, STARTS = 2, (1, -2, 3, -4)  # words of a sketch, and where it starts in a line's sorted hashes
PARTS = 3  # all words are met in so many turns, each of which has its shuffle files deleted
WIDE = 56  # sets of more words have 128 bits
BUCKETS = 1 << 16  # bounds the table of rarities that all tasks get: 65,536 numbers


def _blanks() -> Column:
    """The text with a blank for each space, so that words are split without a regular expression."""
    text = F.col("text").cast("string")
    return F.when(text.rlike(r"[\t\r\x0B\f]"), F.translate(text, "\t\r\x0b\f", "    ")).otherwise(text)


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no and line of all lines of rows that have an id and a text; all spaces in a line are blanks."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _blanks().alias("text")).where("doc_id is not null")
    return rows.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def rarities(docs: DataFrame) -> Column:
    """An array literal: for each of the BUCKETS hash buckets the logarithm of its words' count, as the upper bits of a key."""
    words = docs.select(F.explode(F.split(F.lower(F.replace(_blanks(), F.lit("\n"), F.lit(" "))), " ")).alias("word"))
    counts = words.groupBy(F.xxhash64("word").bitwiseAND(F.lit(BUCKETS - 1)).cast("int").alias("bucket")).count()
    level = F.least(F.lit(31), F.floor(F.log2(F.col("count") + 1)).cast("int"))
    # At most BUCKETS small numbers, however large the table; the optimizer folds them to one array.
    known = dict(counts.select("bucket", level.alias("level")).collect())
    return F.split(F.lit(",".join(str(known.get(b, 0) << 58) for b in range(BUCKETS))), ",").cast("array<long>")


def _encoded(lines: DataFrame, levels: Column) -> DataFrame:
    """doc_id, line_no, the distinct hashes of the line's words and their sorted keys, for lines with words."""
    hashes = F.transform(F.split(F.lower(F.col("line")), " "), lambda word: F.xxhash64(word))
    distinct = F.array_distinct(F.array_remove(hashes, F.xxhash64(F.lit(""))))

    def key(h: Column) -> Column:
        return F.get(levels, h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")) + F.shiftrightunsigned(h, 6)

    # The filter is on the line: one on the keys would make Spark work them out twice.
    worded = lines.where(F.trim("line") != "").select("doc_id", "line_no", distinct.alias("hashes"))
    return worded.select("doc_id", "line_no", "hashes", F.sort_array(F.transform("hashes", key)).alias("keys"))


def _overlap(n: Column | str, percent: int) -> str:
    """Fewest words that a set of ``n`` words shares with any similar set."""
    return f"({percent} * {n} + 99) div 100"


def _classes(encoded: DataFrame, percent: int) -> DataFrame:
    """One row per class of equal sets: place (doc_id, line_no) of the earliest, n, prefix, bits, half and sketches."""
    ordered = encoded.select("doc_id", "line_no", "keys", F.size("keys").alias("n"), F.sort_array("hashes").alias("hashes"))
    return (
        ordered.select(
            F.xxhash64("keys").alias("k1"),
            F.xxhash64(F.lit(1), F.col("keys")).alias("k2"),
            F.struct("doc_id", "line_no").alias("place"),
            "n",
            F.expr(f"slice(keys, 1, cast(n - {_overlap('n', percent)} + 1 as int))").alias("prefix"),
            # Bit b tells whether an odd number of words fall on b; half does so for every second word only.
            F.expr("aggregate(keys, 0L, (bits, k) -> bits ^ shiftleft(1L, cast(k & 63 as int)))").alias("bits"),
            F.expr(f"if(n > {WIDE}, aggregate(keys, 0L, (bits, k) -> if(k & 64 = 0, bits, bits ^ shiftleft(1L, cast(k & 63 as int)))), 0L)").alias("half"),
            F.array(*[F.xxhash64(F.lit(i), F.slice("hashes", start, SKETCH)) for i, start in enumerate(STARTS)]).alias("sketches"),
        )
        .groupBy("k1", "k2")
        .agg(F.min("place").alias("place"), *[F.first(c).alias(c) for c in ("n", "prefix", "bits", "half", "sketches")])
        .select("place", "place.doc_id", "place.line_no", "n", "prefix", "bits", "half", "sketches")
    )


def _alike(percent: int) -> str:
    """Length and bit filters for rows x and y, y not the longer one.

    Two sets differ in at least as many words as their bits differ, so no similar
    pair is dropped. Of long sets the halves of the words differ separately: 128 bits.
    """
    most = f"<= {100 - percent} * (x_n + y_n)"
    wide = f"{100 + percent} * (bit_count(x_half ^ y_half) + bit_count(x_bits ^ x_half ^ y_bits ^ y_half)) {most}"
    return f"{percent} * x_n <= 100 * y_n and {100 + percent} * bit_count(x_bits ^ y_bits) {most} and (y_n <= {WIDE} or {wide})"


def _named(rows: DataFrame, side: str, *columns: str) -> DataFrame:
    return rows.select("word", *[F.col(c).alias(f"{side}_{c}") for c in columns])


def _sketched(classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a_place, b_place) of each class and the earliest one of each of its sketches, as far as they may be similar."""
    index = classes.select(F.explode("sketches").alias("word"), "place", "n", "bits", "half")
    first = index.groupBy("word").agg(F.min(F.struct("place", "n", "bits", "half")).alias("first")).select("word", "first.*")
    columns = ("place", "n", "bits", "half")
    both = _named(index, "x", *columns).join(_named(first, "y", *columns), "word").where("y_place < x_place")
    # The filters take the lengths in order, the bits in any order.
    ordered = both.withColumns({"x_n": F.greatest("x_n", "y_n"), "y_n": F.least("x_n", "y_n")})
    return ordered.where(_alike(percent)).select(F.col("y_place").alias("a_place"), F.col("x_place").alias("b_place")).distinct()


def _met(classes: DataFrame, percent: int, part: int) -> DataFrame:
    """Pairs (a_place, b_place) of classes that share a prefix word of a part and may be similar; b is the later one and open."""
    columns = ("doc_id", "line_no", "n", "at", "bits", "half", "open")
    index = classes.select("doc_id", "line_no", "n", "bits", "half", "open", F.posexplode("prefix").alias("at", "word"))
    index = index.where(F.pmod("word", F.lit(PARTS)) == part)
    # The shorter set y shares at least 2 * percent / (100 + percent) of its words.
    short = index.where(f"{100 + percent} * (n - at) >= {2 * percent} * n")
    met = _named(index, "x", *columns).join(_named(short, "y", *columns), "word")
    possible = (
        f"x_n >= y_n and {_alike(percent)} and {100 + percent} * least(x_n - x_at, y_n - y_at) >= {percent} * (x_n + y_n) "
        "and case when x_doc_id < y_doc_id or x_doc_id = y_doc_id and x_line_no < y_line_no then y_open "
        "when x_doc_id = y_doc_id and x_line_no = y_line_no then false else x_open and x_n > y_n end"
    )
    x, y = [F.struct(F.col(f"{side}_doc_id").alias("doc_id"), F.col(f"{side}_line_no").alias("line_no")) for side in "xy"]
    return met.where(possible).select(F.least(x, y).alias("a_place"), F.greatest(x, y).alias("b_place")).distinct()


def _similar(docs: DataFrame, levels: Column, pairs: DataFrame, percent: int) -> DataFrame:
    """Places of the later lines of ``pairs`` (a_place, b_place) whose full sets are similar."""
    ends = pairs.select(F.col("a_place").alias("place")).union(pairs.select("b_place")).distinct()
    places = land(ends.select("place", F.col("place.doc_id").alias("doc_id"), F.col("place.line_no").alias("line_no")))
    # The condition holds for all rows; stating it lets Spark build the Bloom filter.
    wanted = _lines(docs).join(places.where("line_no >= 0 and doc_id is not null"), ["doc_id", "line_no"])
    # Rows that repeat a doc_id bring several lines for one place; any of them counts.
    sets = land(_encoded(wanted.select("doc_id", "line_no", "line"), levels).select(F.struct("doc_id", "line_no").alias("place"), "keys"))
    release(docs.sparkSession)
    both = F.size(F.array_intersect("a_keys", "b_keys"))
    union = F.size("a_keys") + F.size("b_keys") - both
    return (
        pairs.join(sets.select(F.col("place").alias("a_place"), F.col("keys").alias("a_keys")), "a_place")
        .join(sets.select(F.col("place").alias("b_place"), F.col("keys").alias("b_keys")), "b_place")
        .where(100 * both >= percent * union)
        .select(F.col("b_place").alias("place"))
        .distinct()
    )


def kept_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id and line_no of the lines with words that stay in ``docs`` (doc_id, text).

    Words are split at ASCII white space and compared in lower case. Lines without
    words, null texts and rows without a doc_id take no part. Rows that repeat a
    doc_id count as one document.
    """
    spark = docs.sparkSession
    prune_with_bloom(spark)
    levels = rarities(docs)
    classes = land(_classes(_encoded(_lines(docs), levels), percent))
    release(spark)
    # Sets of fewer words are similar to equal ones only.
    joined = classes.where(f"100 * n >= {percent} * (n + 1)")
    settled = land(_similar(docs, levels, land(_sketched(joined, percent)), percent))
    release(spark)
    gone = settled.select("place.*", F.lit(True).alias("gone"))
    marked = joined.drop("place", "sketches").join(gone, ["doc_id", "line_no"], "left")
    marked, rest = land(marked.withColumn("open", F.col("gone").isNull()).drop("gone")), []
    for part in range(PARTS):
        rest.append(land(_met(marked, percent, part)))
        release(spark)
    rest = land(reduce(DataFrame.union, rest).distinct())
    later = land(settled.union(_similar(docs, levels, rest, percent)))
    return classes.join(later, "place", "left_anti").select("place.doc_id", "place.line_no")


def line_verdicts(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines (with words), n_removed and kept_md5 (the numbers of the kept lines, from 0)."""
    kept = kept_lines(docs, percent).groupBy("doc_id").agg(F.sort_array(F.collect_list("line_no")).alias("kept"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    n_lines = F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t\r\x0B\f]"))))
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), n_lines.cast("long").alias("n_lines"))
    numbers = F.coalesce("kept", F.array().cast("array<int>"))
    return counted.join(kept, "doc_id", "left").select(
        "doc_id", "n_lines", (F.col("n_lines") - F.size(numbers)).alias("n_removed"), F.md5(F.array_join(numbers, ",").cast("binary")).alias("kept_md5")
    )


def remove_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with later similar lines taken out of ``text``; lines without words and rows without an id stay."""
    kept = kept_lines(docs, percent).groupBy("doc_id").agg(F.collect_list("line_no").alias("__kept"))
    left = F.filter(F.split("text", "\n"), lambda x, i: ~x.rlike(r"[^ \t\r\x0B\f]") | F.array_contains(F.coalesce("__kept", F.array().cast("array<int>")), i))
    text = F.when(F.col("doc_id").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return docs.join(kept, "doc_id", "left").withColumn("text", text).select(docs.columns)
