"""Quality rules with risk-controlled cutoffs.

Each rule is a number per document, larger for worse. For every stratum and
rule, candidate cutoffs are tested on labelled good documents: an exact binomial
test asks whether a cutoff rejects more than the allowed share of them. The
lowest cutoff with a significant answer is taken. All tests share one error
level (Bonferroni over strata, rules and candidates), and the allowed share is
split over the rules. So with probability 1 - ``delta`` over the holdout, at
most ``alpha`` of the good documents of each stratum are rejected by the rules.
A stratum with too few labels gets no cutoffs and keeps its documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import land

ALPHA, DELTA = 0.05, 0.05
# Candidate cutoffs per rule; a document fails a rule above its cutoff.
GRID = {
    "symbol_rate": [0.02 * 1.35**i for i in range(16)],  # symbols per word
    "dup_line_rate": [0.02 * 1.3**i for i in range(15)],  # repeated lines per line
    "repeat_rate": [0.02 * 1.3**i for i in range(15)],  # words in repeated windows, per word
    "shout_rate": [0.05 * 1.22**i for i in range(15)],  # upper-case letters per letter
    "long_word": [8 * 1.15**i for i in range(15)],  # code points per word
}
_SYMBOLS = set("#*$%&|<>")
_DROP_SYMBOLS = str.maketrans("", "", "#*$%&|<>")


def measure(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the rules' values."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    symbols = len(text) - len(text.translate(_DROP_SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = {w for w, c in Counter(windows).items() if c > 1}
        end = 0  # words before it are counted
        for i, w in enumerate(windows):
            if w in often:
                repeated += i + 3 - max(i, end)
                end = i + 3
    letters = sum(map(str.isalpha, text)) if n else 0
    upper = sum(map(str.isupper, text)) if n else 0
    rules = (
        symbols / n if n else 0.0,
        dup_lines / len(lines) if lines else 0.0,
        repeated / n if n else 0.0,
        upper / letters if letters else 0.0,
        chars / n if n else 0.0,
    )
    return (n, chars, symbols, dup_lines, repeated, *rules)


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, stratum, the counts and the rules' values of every row of ``docs`` (doc_id, text, stratum)."""
    kinds = [pa.int64()] * 5 + [pa.float64()] * len(GRID)
    names = [*_COUNTS, *GRID]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [measure(t.as_py()) for t in batch.column("text")]
            columns = [pa.array([r[i] for r in made], k) for i, k in enumerate(kinds)]
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), batch.column("stratum"), *columns], ["doc_id", "stratum", *names])

    schema = ", ".join(["doc_id long, stratum string", *[f"{c} long" for c in _COUNTS], *[f"{r} double" for r in GRID]])
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("stratum").cast("string").alias("stratum")).mapInArrow(
        run, schema
    )


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X from Binomial(n, p), exact: the terms of the lighter side are summed from k outwards."""
    if k >= n:
        return 1.0
    below = k <= n * p
    j = k if below else k + 1
    term = math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log1p(-p))
    total = 0.0
    while 0 <= j <= n and term > total * 1e-17:
        total += term
        if below:
            term *= j * (1 - p) / ((n - j + 1) * p)
            j -= 1
        else:
            term *= (n - j) * p / ((j + 1) * (1 - p))
            j += 1
    return min(1.0, total) if below else max(0.0, 1.0 - total)


def base_failed() -> "F.Column":
    """Fewer than 50 words, or over half of the words repeated."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Certified cutoff per stratum and rule: stratum, rule, cutoff, n_good, n_rejected, p_value.

    ``labels`` has doc_id and quality (1: good). A doc_id with several labels is
    good if one says so. Documents that fail the base rules are no part of the
    holdout, as the cutoffs do not decide on them.
    """
    good = labels.where("quality = 1").select("doc_id").distinct()
    holdout = measured.where(~base_failed()).join(good, "doc_id", "left_semi")
    # Bucket b of a rule: b candidates are below the value, so they reject it.
    bucket = [
        F.struct(
            F.lit(rule).alias("rule"),
            sum([(F.col(rule) > F.lit(c)).cast("int") for c in grid], F.lit(0)).alias("bucket"),
        )
        for rule, grid in GRID.items()
    ]
    counts = land(
        holdout.select("stratum", F.explode(F.array(*bucket)).alias("x")).groupBy("stratum", "x.rule", "x.bucket").agg(F.count("*").alias("n"))
    )
    tests = counts.select("stratum").distinct().count() * sum(map(len, GRID.values()))
    level, share = delta / max(1, tests), alpha / len(GRID)

    def choose(part: pd.DataFrame) -> pd.DataFrame:
        # One stratum and rule: at most one row per candidate and one more.
        rule = part["rule"].iloc[0]
        n = int(part["n"].sum())
        for i, cut in enumerate(GRID[rule]):
            k = int(part.loc[part["bucket"] > i, "n"].sum())
            p = binomial_tail(k, n, share)
            if p <= level:
                return pd.DataFrame([(part["stratum"].iloc[0], rule, cut, n, k, p)], columns=_CUTS)
        return pd.DataFrame([], columns=_CUTS)

    return counts.groupBy("stratum", "rule").applyInPandas(
        choose, "stratum string, rule string, cutoff double, n_good long, n_rejected long, p_value double"
    )


_CUTS = ["stratum", "rule", "cutoff", "n_good", "n_rejected", "p_value"]


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Counts, base verdict and verdict of every row of ``docs`` (doc_id, text and the stratum's column).

    Returns doc_id, the five counts, base_failed, kept and failed_rule (the first
    rule above its cutoff, else null). Null text has no words; a null stratum is a
    stratum of its own; without labels only the base rules decide.
    """
    named = docs.select("doc_id", "text", F.coalesce(F.concat(F.lit("s"), F.col(stratum).cast("string")), F.lit("")).alias("stratum"))
    measured = land(measures(named))
    chosen = land(cutoffs(measured, labels, alpha, delta))
    # A pivot by hand: one row per stratum.
    wide = chosen.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in GRID])
    failed = F.coalesce(*[F.when(F.col(r) > F.col(f"cut_{r}"), F.lit(r)) for r in GRID])
    return (
        measured.join(wide, "stratum", "left")
        .withColumn("base_failed", base_failed())
        .withColumn("failed_rule", failed)
        .select("doc_id", *_COUNTS, "base_failed", (~F.col("base_failed") & F.col("failed_rule").isNull()).alias("kept"), "failed_rule")
    )
