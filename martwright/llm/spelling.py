"""Spelling variants by one-edit neighbourhoods over a reduced alphabet.

Letters are hashed to a few symbols. Two words that differ by one inserted,
deleted or replaced code point have reduced forms that are equal or differ by one
such edit, so the full one-edit neighbourhood of every reduced word (with few
symbols it is small) meets the reduced form of each near word. Neighbourhoods
are joined with the reduced vocabulary and the original strings decide.

Everything from counting on works on distinct words: occurrences are added up
before the shuffle, so neither a frequent word nor a long text makes a hot group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import land

SYMBOLS = "abcdef"
MIN_LENGTH = 7
MIN_COUNT = 2
# A word takes the form of a near word that is at least so many times as frequent.
TIMES = 10
# One occurrence in so many loses a letter.
ONE_IN = 31
# Fixed values of the contract: the letters of a run, and those that change case.
LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABET = LOWER + "".join(map(chr, range(0xC0, 0x100)))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word and n, its occurrences in all texts of ``docs`` (doc_id, text).

    Where ONE_IN divides the checksum of ``<doc_id>:<word>``, the occurrence counts for
    the word without one letter, so that a text without errors has some. Words are
    folded per document first; a null text has none and a null doc_id counts as empty.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(F.translate(F.col("text").cast("string"), UPPER, LOWER), F.lit(LETTERS), F.lit(0))).alias("run"),
    ).where(F.length("run") >= min_length)
    checksum = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    at = (checksum % F.length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    words = runs.select(F.when(checksum % ONE_IN == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def reduced(word: Column) -> Column:
    """``word`` with each letter hashed to one of SYMBOLS."""
    return F.translate(word, ALPHABET, "".join(SYMBOLS[(ord(c) * 0x9E3779B1 >> 16) % len(SYMBOLS)] for c in ALPHABET))


def neighbourhoods(forms: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of reduced words of one length: own, and of all strings over SYMBOLS within one edit, with the place of their word.

    A code is the polynomial of a string's symbols modulo 2^64, so codes of edited strings
    come from those of prefixes and suffixes. Each neighbour of a word occurs once.
    """
    length = len(forms[0])
    symbols = np.frombuffer("".join(forms).encode(), np.uint8).reshape(len(forms), length).astype(np.uint64)
    power = np.cumprod(np.append(np.uint64(1), np.full(length + 1, _BASE)))
    before = np.zeros((len(forms), length + 1), np.uint64)
    after = np.zeros((len(forms), length + 1), np.uint64)
    for i in range(length):
        before[:, i + 1] = before[:, i] * _BASE + symbols[:, i]
        after[:, length - 1 - i] = after[:, length - i] + symbols[:, length - 1 - i] * power[i]
    own = before[:, length]
    around = [own]
    for i in range(length + 1):
        rest = length - i
        letters = [np.array([ord(s)], np.uint64) for s in SYMBOLS]
        around += [before[:, i] * power[rest + 1] + s * power[rest : rest + 1] + after[:, i] for s in letters]
        if rest:
            around.append(before[:, i] * power[rest - 1] + after[:, i + 1])
            around += [before[:, i] * power[rest] + s * power[rest - 1 : rest] + after[:, i + 1] for s in letters]
    table = np.sort(np.stack(around, 1), axis=1)
    new = np.ones(table.shape, bool)
    new[:, 1:] = table[:, 1:] != table[:, :-1]
    return own, table[new], np.nonzero(new)[0]


def _by_length(forms: list[str]) -> Iterator[list[int]]:
    places: dict[int, list[int]] = {}
    for i, form in enumerate(forms):
        places.setdefault(len(form), []).append(i)
    # A slice bounds memory: its neighbourhoods take some 32 MB.
    for length, found in places.items():
        step = max(1, (4 << 20) // ((2 * length + 2) * (len(SYMBOLS) + 1)))
        for at in range(0, len(found), step):
            yield found[at : at + step]


def _coded(words: DataFrame) -> DataFrame:
    """word, n and the code of the reduced word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch.column("form").to_pylist()
            for places in _by_length(forms):
                symbols = np.frombuffer("".join(forms[i] for i in places).encode(), np.uint8).reshape(len(places), -1)
                code = np.zeros(len(places), np.uint64)
                for i in range(symbols.shape[1]):
                    code = code * _BASE + symbols[:, i]
                rows = batch.take(pa.array(places))
                yield pa.record_batch([rows.column("word"), rows.column("n"), pa.array(code.view(np.int64))], ["word", "n", "code"])

    return words.withColumn("form", reduced(F.col("word"))).mapInArrow(run, "word string, n long, code long")


def _around(words: DataFrame) -> DataFrame:
    """code and near_code: the neighbourhoods of the distinct reduced words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch.column("form").to_pylist()
            for places in _by_length(forms):
                own, near, at = neighbourhoods([forms[i] for i in places])
                own = own[at]
                # Being one edit apart holds both ways, so the larger code of two finds the pair.
                later = own >= near
                yield pa.record_batch([pa.array(own[later].view(np.int64)), pa.array(near[later].view(np.int64))], ["code", "near_code"])

    return words.select(reduced(F.col("word")).alias("form")).distinct().mapInArrow(run, "code long, near_code long")


def near_words(words: DataFrame) -> DataFrame:
    """word, n, near and near_n for all pairs of different words of ``words`` (word, n) that are one edit apart, in both directions."""
    coded = land(_coded(words))
    other = coded.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("code").alias("near_code"))
    met = _around(words).join(other, "near_code").join(coded, "code")
    # Of two words with one code each finds the other, so one way is enough there too.
    once = (F.col("code") != F.col("near_code")) | (F.col("word") < F.col("near"))
    found = met.where(once).where(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n")
    turned = F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return found.select(F.inline(F.array(F.struct("word", "n", "near", "near_n"), turned)))


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, times: int = TIMES) -> DataFrame:
    """Words of ``docs`` (doc_id, text) and the forms they are variants of.

    Returns word, form (the most frequent near word, the smaller of equals, if it is
    at least ``times`` as frequent; else null), root (the end of the chain of forms),
    n, n_near and form_n. Repeated rows count again; null texts, texts without
    letters and empty tables give no words; other columns are ignored.
    """
    words = land(vocabulary(docs, min_length, min_count))
    # The struct orders by frequency first, and among equals by code points, smaller last.
    best = F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), F.col("near")))
    found = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    wide = F.col("best.near_n") >= times * F.col("n")
    named = land(
        words.join(found, "word", "left").select(
            "word",
            F.when(wide, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(wide, F.col("best.near_n")).alias("form_n"),
        )
    )
    return named.join(_roots(named), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(named: DataFrame) -> DataFrame:
    """word and root of all words that have a form; steps double, and frequencies grow along a chain, so it ends."""
    heads = land(named.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        ahead = heads.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = land(heads.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if stepped.where("moved").isEmpty():
            return stepped.select("word", "root")
        heads = stepped.select("word", "root")
