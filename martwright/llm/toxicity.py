"""Toxic spans and document scores by a linear-chain conditional random field.

Labels exist per document, so tokens are labelled first: in toxic documents, a
token is toxic if its word or the beginning of it is far more frequent in toxic
than in clean documents. On lines with these token labels a chain of two states
is trained, with words, word beginnings and endings as features; its transitions
start from the observed ones and are trained with them. Forward and backward
messages give each token's marginal; their sum and maximum give the
score of a document, and runs of likely tokens are the offending spans.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOKEN = re.compile(r"[^\W_]+")
LINE = re.compile(r"[^\n]+")
# Bound of the training sample: labelled documents of each class. Each class is weighted to its true count.
SAMPLE = {1: 2000, 0: 3000}
# And bytes of each class, so that long documents don't make it larger.
SAMPLE_BYTES = 8 << 20
FEATURES = 1 << 18
# Lines of the sample that the chain is trained on, spread evenly; each stands for as many as were left out.
MAX_LINES = 20_000
CACHE = 200_000  # words whose potentials a worker remembers


def features(word: str) -> list[int]:
    """Hashed features of a word in lower case."""
    names = ["b", f"w{word}", f"n{min(len(word), 12)}", f"e{word[-3:]}"]
    names += [f"p{word[:k]}" for k in range(3, 8) if len(word) > k]
    return [zlib.crc32(n.encode()) % FEATURES for n in names]


def _stems(word: str) -> list[str]:
    """What a token label may rest on: the word, or its beginning."""
    return [word + "$", *[word[:k] for k in (5, 6, 7) if len(word) > k]]


@dataclass
class Chain:
    """Node weights, transition scores (2 x 2) and the calibration of document scores."""

    weights: np.ndarray
    moves: np.ndarray
    calibration: tuple[float, float, float]

    def potential(self, word: str) -> float:
        """Odds of the toxic state from the word alone."""
        return math.exp(max(-30.0, min(30.0, float(self.weights[features(word)].sum()))))

    def marginals(self, odds: list[float]) -> list[float]:
        """Probability of the toxic state per token, by messages in both directions."""
        (cc, ct), (tc, tt) = np.exp(self.moves).tolist()
        forward, a = [], None
        for w in odds:
            a = w if a is None else w * (ct + tt * a) / (cc + tc * a)
            a = 1e-30 if a < 1e-30 else 1e30 if a > 1e30 else a
            forward.append(a)
        b, out = 1.0, [0.0] * len(odds)
        for i in range(len(odds) - 1, -1, -1):
            r = forward[i] * b
            out[i] = r / (1.0 + r)
            v = odds[i] * b
            b = (tc + tt * v) / (cc + ct * v)
        return out

    def score(self, marginals: list[float]) -> float:
        """Calibrated probability that the document is toxic; without tokens that of no evidence."""
        bias, by_sum, by_max = self.calibration
        z = bias + by_sum * math.log(1e-4 + sum(marginals)) + by_max * max(marginals, default=0.0)
        return 1.0 / (1.0 + math.exp(max(-30.0, min(30.0, -z))))


def _marking(texts: list[str], toxic: list[int]) -> set[str]:
    """Words and beginnings that are far more frequent in toxic texts than in clean ones."""

    def count(label: int, only: set[str] | None) -> Counter:
        counts: Counter = Counter()
        for text, kind in zip(texts, toxic, strict=True):
            if kind == label:
                stems = {s for w in set(map(str.lower, TOKEN.findall(text))) for s in _stems(w)}
                counts.update(stems if only is None else stems & only)
        return counts

    often = {s: c for s, c in count(1, None).items() if c >= 4}
    clean = count(0, set(often))
    n1, n0 = sum(toxic), len(toxic) - sum(toxic)
    return {s for s, c in often.items() if math.log((c + 0.5) / (n1 + 1)) - math.log((clean[s] + 0.5) / (n0 + 1)) > 3.0}


def _labelled_lines(
    texts: list[str], toxic: list[int], by_class: dict[int, float]
) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, list[str]]:
    """Word numbers, token labels and weight of the lines to train on, and the words by number.

    Lines are chosen by their places; only the words of chosen lines are kept, as numbers.
    """
    marking = _marking(texts, toxic)

    def is_marked(word: str) -> bool:
        return any(s in marking for s in _stems(word))

    marked, plain = array("q"), array("q")  # text, start and end of each line with words
    for i, (text, label) in enumerate(zip(texts, toxic, strict=True)):
        for line in LINE.finditer(text):
            if TOKEN.search(text, line.start(), line.end()):
                some = label and any(is_marked(w.lower()) for w in TOKEN.findall(line[0]))
                (marked if some else plain).extend((i, line.start(), line.end()))
    # Lines with toxic tokens have the room that is free, and half of it at least.
    room = max(MAX_LINES // 2, MAX_LINES - len(plain) // 3)
    chosen = _spread(marked, room)
    chosen += _spread(plain, MAX_LINES - len(chosen))
    numbers: dict[str, int] = {}
    words, marks, weights = [], [], []
    for i, start, end, more in chosen:
        found = [w.lower() for w in TOKEN.findall(texts[i][start:end])]
        words.append(np.array([numbers.setdefault(w, len(numbers)) for w in found], np.int32))
        marks.append(np.array([bool(toxic[i]) and is_marked(w) for w in found], np.int8))
        weights.append(by_class[toxic[i]] * more)
    return words, marks, np.array(weights), list(numbers)


def _spread(places: array, limit: int) -> list[tuple[int, int, int, float]]:
    """At most ``limit`` lines at even distances, weighted so that they stand for all."""
    count = len(places) // 3
    more = max(1.0, count / max(1, limit))
    at = [int((i + 0.5) * more) for i in range(min(count, limit))] if count > limit else range(count)
    return [(*places[3 * k : 3 * k + 3], more) for k in at]


def _class_weights(toxic: list[int], totals: dict[int, int] | None) -> dict[int, float]:
    """Weight of a sampled document per class, so that the classes stand as in ``totals``; the mean is one."""
    sampled = Counter(toxic)
    totals = {k: max(n, (totals or sampled).get(k, 0)) for k, n in sampled.items()}
    return {k: totals[k] / n * len(toxic) / sum(totals.values()) for k, n in sampled.items()}


def fit(
    texts: list[str],
    toxic: list[int],
    totals: dict[int, int] | None = None,
    epochs: int = 60,
    rate: float = 0.15,
    decay: float = 1e-5,
) -> Chain:
    """Train on documents in memory, a bounded sample that stands for ``totals`` documents per class.

    Without ``totals`` the sample stands for itself. Without both classes every score is the share of label 1.
    """
    if not texts or len(set(toxic)) < 2:
        share = (sum(toxic) + 0.5) / (len(toxic) + 1)
        return Chain(np.zeros(FEATURES, np.float32), np.zeros((2, 2)), (math.log(share / (1 - share)), 0.0, 0.0))
    by_class = _class_weights(toxic, totals)
    ids, marks, weight, vocabulary = _labelled_lines(texts, toxic, by_class)
    longest = sorted(range(len(ids)), key=lambda i: -len(ids[i]))
    ids, marks, weight = [ids[i] for i in longest], [marks[i] for i in longest], weight[longest]
    lists = [np.array(features(w), np.int32) for w in vocabulary]
    flat = np.concatenate(lists)
    owner = np.repeat(np.arange(len(lists), dtype=np.int32), [len(x) for x in lists])
    # One column per line, longest first: at step t only the first alive[t] lines go on.
    lengths = np.array([len(x) for x in ids])
    steps = int(lengths[0])
    alive = [int((lengths > t).sum()) for t in range(steps)]
    token = [np.array([ids[i][t] for i in range(alive[t])]) for t in range(steps)]
    truth = [np.array([marks[i][t] for i in range(alive[t])]) for t in range(steps)]
    n_words = len(vocabulary)
    del ids, marks, lists, vocabulary
    n_tokens = float((lengths * weight).sum())
    counts = np.zeros((2, 2))
    for t in range(1, steps):
        np.add.at(counts, (truth[t - 1][: alive[t]], truth[t]), weight[: alive[t]])
    moves = np.log((counts + 1) / (counts + 1).sum(1, keepdims=True))
    move_grads = np.zeros((2, 2)) + 1e-8
    weights = np.zeros(FEATURES)
    weights[zlib.crc32(b"b") % FEATURES] = -3.0
    grads = np.zeros(FEATURES) + 1e-8
    tokens, truths, heavy = np.concatenate(token), np.concatenate(truth), np.concatenate([weight[:n] for n in alive])
    for _ in range(epochs):
        node = np.bincount(owner, weights[flat], n_words).clip(-30, 30)
        marginals, pairs = _batch_marginals(np.exp(moves), [np.exp(node[x]) for x in token], alive, weight)
        per_word = np.bincount(tokens, heavy * (np.concatenate(marginals) - truths), n_words)
        gradient = np.bincount(flat, per_word[owner], FEATURES) / n_tokens + decay * weights
        grads += gradient**2
        weights -= rate * gradient / np.sqrt(grads)
        gradient = (pairs - counts) / n_tokens + decay * moves
        move_grads += gradient**2
        moves -= rate * gradient / np.sqrt(move_grads)
    chain = Chain(weights.astype(np.float32), moves, (0.0, 1.0, 0.0))
    cache: dict[str, float] = {}
    seen = []
    for text in texts:
        if len(cache) > CACHE // 4:
            cache.clear()
        m = chain.marginals([cache.get(w) or cache.setdefault(w, chain.potential(w.lower())) for w in TOKEN.findall(text)])
        seen.append((1.0, math.log(1e-4 + sum(m)), max(m, default=0.0)))
    chain.calibration = tuple(_logistic(np.array(seen), np.array(toxic, float), np.array([by_class[t] for t in toxic])))
    return chain


def _batch_marginals(move: np.ndarray, odds: list[np.ndarray], alive: list[int], weight: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Marginals of all tokens, and the expected transitions (2 x 2) of the weighted lines."""
    (cc, ct), (tc, tt) = move
    forward = [odds[0]]
    for t in range(1, len(odds)):
        a = forward[-1][: alive[t]]
        forward.append((odds[t] * (ct + tt * a) / (cc + tc * a)).clip(1e-30, 1e30))
    back, out, pairs = np.ones(alive[-1]), [None] * len(odds), np.zeros((2, 2))
    for t in range(len(odds) - 1, -1, -1):
        if len(back) < alive[t]:
            back = np.concatenate((back, np.ones(alive[t] - len(back))))
        r = forward[t] * back
        out[t] = r / (1 + r)
        v = odds[t] * back
        if t:
            a = forward[t - 1][: alive[t]]
            each = np.array([[np.full_like(v, cc), ct * v], [tc * a, tt * a * v]])
            pairs += (each * (weight[: alive[t]] / each.sum((0, 1)))).sum(2)
        back = (tc + tt * v) / (cc + ct * v)
    return out, pairs


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression on weighted rows by damped Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ w).clip(-30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (weight * (y - p)) - ridge * w)
        w += step / max(1.0, np.abs(step).max() / 2)
    return w


def held_out() -> "F.Column":
    """Rows whose labels are never learnt from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _labelled(labels: DataFrame) -> DataFrame:
    """doc_id and toxic of all documents whose label may be learnt from."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return known.where(~held_out())


def class_totals(docs: DataFrame, labels: DataFrame) -> dict[int, int]:
    """Number of rows of ``docs`` with a text per class of all labels that may be learnt from."""
    rows = docs.where("text is not null and doc_id is not null").groupBy("doc_id").count()
    counted = rows.join(_labelled(labels), "doc_id").groupBy("toxic").agg(F.sum("count").alias("n"))
    return {r["toxic"]: r["n"] for r in counted.collect()}


def sample(docs: DataFrame, labels: DataFrame, limits: dict[int, int] = SAMPLE, size: int = SAMPLE_BYTES) -> tuple[list[str], list[int]]:
    """Texts and labels of at most ``limits`` documents and ``size`` bytes per class, in the order of a hash of their ids."""
    labelled = _labelled(labels)
    texts, toxic = [], []
    for label, limit in limits.items():
        # The bounds keep the broadcasts and the collected texts small.
        chosen = labelled.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
        rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
        found = rows.join(F.broadcast(chosen.select("doc_id")), "doc_id").select(
            F.xxhash64("doc_id").alias("place"), "doc_id", F.xxhash64("text").alias("text_key"), F.octet_length("text").cast("long").alias("bytes")
        )
        order = ["place", "doc_id", "text_key"]
        first = found.orderBy(*order).limit(limit)
        room = F.sum("bytes").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
        taken = first.withColumn("room", room).where(F.col("room") <= size).select("doc_id", "text_key").distinct()
        kept = rows.withColumn("text_key", F.xxhash64("text")).join(F.broadcast(taken), ["doc_id", "text_key"]).select("doc_id", "text").distinct()
        got = [r.text for r in kept.sort("doc_id", "text").collect()]
        texts += got
        toxic += [label] * len(got)
    return texts, toxic


def train(docs: DataFrame, labels: DataFrame, limits: dict[int, int] = SAMPLE) -> Chain:
    """A chain from labelled documents that are not held out, with the classes in the ratio of all of them.

    Rows that repeat a document with its text are one in the sample.
    """
    return fit(*sample(docs, labels, limits), class_totals(docs, labels))


def _scan(chain: Chain):
    shared = chain

    def make() -> "callable":
        model, cache = shared.value, {}

        def scan(text: str | None) -> tuple[list[float], float]:
            odds = []
            if len(cache) > CACHE:
                cache.clear()
            for w in TOKEN.findall(text or ""):
                o = cache.get(w)
                if o is None:
                    o = cache[w] = model.potential(w.lower())
                odds.append(o)
            m = model.marginals(odds)
            return m, model.score(m)

        return scan

    return make


def score(docs: DataFrame, chain: Chain, likely: float = 0.5) -> DataFrame:
    """Score and offending spans of every row of ``docs`` (doc_id, text).

    Returns doc_id, held_out, score, predicted, span_starts and span_ends (code
    points of runs of tokens with a marginal of ``likely`` or more). A text that is
    null or has no tokens gets the score of a text without evidence. Equal texts
    get equal scores. Other columns are ignored.
    """
    make = _scan(docs.sparkSession.sparkContext.broadcast(chain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = make()
        for batch in batches:
            scores, starts, ends = [], [], []
            for value in batch.column("text"):
                text = value.as_py()
                m, s = scan(text)
                scores.append(s)
                spans: list[list[int]] = []
                if any(p >= likely for p in m):
                    last = -2
                    for i, (p, found) in enumerate(zip(m, TOKEN.finditer(text), strict=True)):
                        if p >= likely:
                            if i == last + 1:
                                spans[-1][1] = found.end()
                            else:
                                spans.append([found.start(), found.end()])
                            last = i
                starts.append([a for a, _ in spans])
                ends.append([b for _, b in spans])
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (starts, ends)]
            yield pa.record_batch(
                [batch.column("doc_id").cast(pa.int64()), pa.array(scores, pa.float64()), *lists], ["doc_id", "score", "span_starts", "span_ends"]
            )

    scored = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, score double, span_starts array<long>, span_ends array<long>"
    )
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "span_starts", "span_ends"
    )


def drop_toxic(docs: DataFrame, chain: Chain, cutoff: float = 0.5) -> DataFrame:
    """Rows of ``docs`` with a score below ``cutoff``, all columns as they were."""
    make = _scan(docs.sparkSession.sparkContext.broadcast(chain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = make()
        for batch in batches:
            yield batch.filter(pa.array([scan(t.as_py())[1] < cutoff for t in batch.column("text")], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
