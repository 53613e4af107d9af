"""Personal data by fixed patterns and a skip-chain conditional random field.

The patterns give the base spans. The field labels tokens that can be personal
data at all (they hold a digit or @): neighbours in the text share a potential,
and so do tokens that repeat each other, wherever they stand. Its weights are
learnt from the base spans of a bounded sample by pseudo-likelihood. Loopy
belief propagation runs over all documents of a batch at once, in each until its
own messages settle, and runs of
tokens with a certain label become further spans where no base span is. A token
without digit and @ is never personal data, so it cuts the chain and costs
nothing; this is exact, as its label is known.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
SAMPLE = 2000  # documents with a digit or @ that the weights are learnt from
SURE = 0.95  # marginal from which a token counts
ROUNDS = 25  # of message passing that any document may take, besides four per token
SETTLED = 1e-4  # change of a document's messages from which it is done

_CANDIDATE = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is taken from its start; the possessive forms match the same and never go back.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_EDGES = " \t\n\r.,;:!?\"'()[]{}<>="


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from their @, so that long runs of letters cost nothing."""
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text, start - 1):
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append((start, match.end()))
            free = match.end()
        free = max(free, at + 1)
        at = text.find("@", free)
    return found


def base_spans(text: str) -> tuple[dict[str, list[tuple[int, int]]], list[tuple[int, int, str]]]:
    """Valid matches per kind, and the matches that a check has dropped."""
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    failed = []
    if "@" in text:
        spans["email"] = _emails(text)
    for kind, pattern, valid in (
        ("ip", _IP, lambda m: all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or "0") <= 255 for x in m.groups())),
        ("card", _CARD, lambda m: 13 <= len(d := _digits(m[0])) <= 19 and _luhn(d)),
        ("phone", _PHONE, lambda m: 9 <= len(_digits(m[0])) <= 15),
    ):
        for m in pattern.finditer(text):
            if valid(m):
                spans[kind].append(m.span())
            else:
                failed.append((*m.span(), kind))
    return spans, failed


@dataclass
class Graph:
    """Candidate tokens of some texts with their features and edges."""

    spans: list[tuple[int, int]] = field(default_factory=list)
    owner: list[int] = field(default_factory=list)  # text of a token
    features: list[list[str]] = field(default_factory=list)
    label: list[int] = field(default_factory=list)  # from the base spans
    barred: list[int] = field(default_factory=list)  # a kind whose check has failed here, or 0
    chain: list[tuple[int, int]] = field(default_factory=list)
    skip: list[tuple[int, int]] = field(default_factory=list)

    def add(self, text: str, owner: int, spans: dict, failed: list) -> None:
        marks = sorted([(a, b, LABELS.index(k), 0) for k, v in spans.items() for a, b in v] + [(a, b, 0, LABELS.index(k)) for a, b, k in failed])
        last_seen: dict[str, int] = {}
        reach = 0
        for m in _CANDIDATE.finditer(text):
            i, token = len(self.spans), m.group()
            while reach < len(marks) and marks[reach][1] <= m.start():
                reach += 1
            label = barred = 0
            for a, b, kind, bar in marks[reach:]:
                if a >= m.end():
                    break
                if b > m.start():
                    label, barred = label or kind, barred or bar
            self.spans.append(m.span())
            self.owner.append(owner)
            self.label.append(label)
            self.barred.append(0 if label else barred)
            core = token.strip(_EDGES)
            shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", core))[:24]
            n = min(20, len(_digits(core)))
            self.features.append(["", f"s{shape}", f"d{n}", f"@{core.count('@')}", f".{min(5, core.count('.'))}", f"+{token[0] == '+'}", f"s{shape}d{n}"])
            if i and self.owner[i - 1] == owner and text[self.spans[i - 1][1] : m.start()].isspace():
                self.chain.append((i - 1, i))
            key = re.sub(r"[\W_]+", "", token).lower()
            if len(key) > 3:
                # The next token of the same letters and digits: k copies make k - 1 edges.
                if key in last_seen and self.chain[-1:] != [(last_seen[key], i)]:
                    self.skip.append((last_seen[key], i))
                last_seen[key] = i


@dataclass
class Field:
    """Weights of features, of neighbours (ordered) and of repeated tokens (symmetric)."""

    index: dict[str, int]
    weights: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def node_scores(self, graph: Graph) -> np.ndarray:
        out = np.zeros((len(graph.spans), len(LABELS)))
        for i, names in enumerate(graph.features):
            for n in names:
                j = self.index.get(n)
                if j is not None:
                    out[i] += self.weights[j]
        barred = np.array(graph.barred)
        rows = np.flatnonzero(barred)
        out[rows, barred[rows]] = -30.0
        return out

    def marginals(self, graph: Graph) -> np.ndarray:
        """Loopy belief propagation: all messages at once, damped, until those of a document settle.

        A document with n candidate tokens may take ROUNDS + 4 n rounds, enough for
        evidence to reach the far end of a path; other documents play no part.
        """
        scores = self.node_scores(graph)
        node = np.exp(scores - scores.max(1, keepdims=True))
        edges = np.array(graph.chain + graph.skip, np.int64).reshape(-1, 2)
        if not len(edges):
            return node / node.sum(1, keepdims=True)
        tables = np.concatenate(
            [np.broadcast_to(np.exp(t), (n, len(LABELS), len(LABELS))) for t, n in ((self.chain, len(graph.chain)), (self.skip, len(graph.skip)))]
        )
        source, target = np.concatenate((edges[:, 0], edges[:, 1])), np.concatenate((edges[:, 1], edges[:, 0]))
        tables = np.concatenate((tables, tables.transpose(0, 2, 1)))
        half = len(edges)
        reverse = np.concatenate((np.arange(half, 2 * half), np.arange(half)))
        messages = np.full((2 * half, len(LABELS)), 1.0 / len(LABELS))
        # Edges stay within a document, so each one is followed by itself.
        owner = np.array(graph.owner, np.int64)[source]
        rounds = ROUNDS + 4 * np.bincount(graph.owner)
        evidence, live, taken = np.log(node + 1e-30), np.arange(2 * half), 0
        while len(live):
            taken += 1
            belief = evidence.copy()
            np.add.at(belief, target[live], np.log(messages[live]))
            out = belief[source[live]] - np.log(messages[reverse[live]])
            out = np.exp(out - out.max(1, keepdims=True))
            new = np.einsum("ei,eij->ej", out, tables[live])
            new = 0.5 * messages[live] + 0.5 * new / new.sum(1, keepdims=True)
            moved = np.zeros(len(rounds))
            np.maximum.at(moved, owner[live], np.abs(new - messages[live]).max(1))
            messages[live] = new.clip(1e-12)
            live = live[((moved >= SETTLED) & (taken < rounds))[owner[live]]]
        belief = np.log(node + 1e-30)
        np.add.at(belief, target, np.log(messages))
        belief = np.exp(belief - belief.max(1, keepdims=True))
        return belief / belief.sum(1, keepdims=True)


def fit(texts: list[str], epochs: int = 150, rate: float = 0.5, decay: float = 1e-4) -> Field:
    """Pseudo-likelihood on texts in memory: each label given its neighbours' labels."""
    graph = Graph()
    for i, text in enumerate(texts):
        graph.add(text, i, *base_spans(text))
    index: dict[str, int] = {}
    flat = [(i, index.setdefault(n, len(index))) for i, names in enumerate(graph.features) for n in names]
    k = len(LABELS)
    weights, chain, skip = np.zeros((max(1, len(index)), k)), np.zeros((k, k)), np.zeros((k, k))
    weights[index.get("", 0), 0] = 3.0  # without evidence: other
    if not flat:
        return Field(index, weights, chain, skip)
    rows, columns = np.array(flat).T
    truth = np.eye(k)[graph.label]
    left, right = np.array(graph.chain, np.int64).reshape(-1, 2).T
    one, two = np.array(graph.skip, np.int64).reshape(-1, 2).T
    squares = [np.full_like(x, 1e-6) for x in (weights, chain, skip)]
    n = len(truth)
    for _ in range(epochs):
        z = np.zeros((n, k))
        np.add.at(z, rows, weights[columns])
        np.add.at(z, right, chain[graph_label(graph, left)])
        np.add.at(z, left, chain.T[graph_label(graph, right)])
        np.add.at(z, two, skip[graph_label(graph, one)])
        np.add.at(z, one, skip[graph_label(graph, two)])
        p = np.exp(z - z.max(1, keepdims=True))
        error = p / p.sum(1, keepdims=True) - truth
        by_feature = np.zeros_like(weights)
        np.add.at(by_feature, columns, error[rows])
        by_chain = truth[left].T @ error[right] + error[left].T @ truth[right]
        by_skip = truth[one].T @ error[two] + error[one].T @ truth[two]
        by_skip = by_skip + by_skip.T
        for w, g, s in zip((weights, chain, skip), (by_feature, by_chain, by_skip), squares, strict=True):
            g = g / n + decay * w
            s += g**2
            w -= rate * g / np.sqrt(s)
    return Field(index, weights, chain, skip)


def graph_label(graph: Graph, nodes: np.ndarray) -> np.ndarray:
    return np.array(graph.label, np.int64)[nodes]


def train(docs: DataFrame, limit: int = SAMPLE) -> Field:
    """A field from at most ``limit`` documents with a digit or @, in the order of a hash of their ids."""
    ids = docs.where(F.col("text").rlike("[0-9@]") & F.col("doc_id").isNotNull()).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    # The bound keeps the broadcast of ids and the collected texts small.
    picked = docs.select("doc_id", "text").join(F.broadcast(ids.distinct()), "doc_id").where("text is not null").orderBy("doc_id", "text").limit(2 * limit)
    return fit([r["text"] for r in picked.collect()])


def _added(text: str, at: list[int], graph: Graph, sure: np.ndarray, label: np.ndarray, spans: dict) -> list[tuple[str, int, int]]:
    """Runs of sure tokens of one kind in one text, where no base span is."""
    runs: list[list] = []
    for i in at:
        if not label[i] or not sure[i] or graph.label[i]:
            continue
        a, b = graph.spans[i]
        if runs and runs[-1][0] == label[i] and text[runs[-1][2] : a].isspace():
            runs[-1][2] = b
        else:
            runs.append([label[i], a, b])
    taken = [s for v in spans.values() for s in v]
    out = []
    for kind, a, b in runs:
        a, b = a + len(text[a:b]) - len(text[a:b].lstrip(_EDGES)), b - len(text[a:b]) + len(text[a:b].rstrip(_EDGES))
        if a < b and all(b <= x or y <= a for x, y in taken):
            out.append((LABELS[kind], a, b))
    return out


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def find(docs: DataFrame, model: Field, sure: float = SURE) -> DataFrame:
    """Personal data of every row of ``docs`` (doc_id, text).

    Returns doc_id, n_email, n_ip, n_card, n_phone and base_sha256 (base spans only)
    and spans (all, in code points). Null and empty texts have none. A token whose
    pattern matched but failed its check never gets that kind. Other columns are
    ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field_ = shared.value
        for batch in batches:
            graph, base, texts = Graph(), [], []
            for i, value in enumerate(batch.column("text")):
                text = value.as_py() or ""
                plain = re.search("[0-9@]", text) is None
                spans, failed = ({k: [] for k in KINDS}, []) if plain else base_spans(text)
                base.append(spans)
                texts.append("" if plain else text)
                if not plain:
                    graph.add(text, i, spans, failed)
            of: dict[int, list[int]] = {}
            if graph.spans:
                marginal = field_.marginals(graph)
                label, certain = marginal.argmax(1), marginal.max(1) >= sure
                for node, owner in enumerate(graph.owner):
                    of.setdefault(owner, []).append(node)
            rows = []
            for i, spans in enumerate(base):
                fixed = [(k, a, b) for k in KINDS for a, b in spans[k]]
                more = _added(texts[i], of[i], graph, certain, label, spans) if i in of else []
                digest = hashlib.sha256(_joined(fixed).encode()).hexdigest()
                rows.append((*(len(spans[k]) for k in KINDS), digest, _joined(fixed + more)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))], names)

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
