"""The training-text operators against brute force, on small tables with odd rows."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import corpus_pipeline
from martwright.llm import chat, interleave, line_join, minhash, prefix_doubling, raking, skipchain, thresholds, toxicity, wumanber

DOCS = "doc_id long, text string, lang string, source string, n_chars long, slot string, word string, node string, shard string, bucket string"
WORDS = [a + b + c for a in ("ba", "de", "ki", "lo", "mu") for b in ("na", "re", "si", "to") for c in ("", "n", "ts")]


def _words(n, seed):
    r = random.Random(seed)
    return [r.choice(WORDS) for _ in range(n)]


def _texts():
    """Texts by id: plain, copies, near copies, shared passages, short, blank, null and one very long."""
    base = _words(60, 1)
    passage = " ".join(_words(14, 2))
    out = {1: " ".join(base), 2: " ".join(base), 3: " ".join([*base[:30], "CHANGED", *base[31:]]), 4: None, 5: "", 6: " \n\t ", 7: "one", 8: "One"}
    out[9] = " ".join(_words(20, 3)) + "\n" + passage + "\n" + " ".join(_words(20, 4))
    out[10] = " ".join(_words(9, 5)) + "\n" + passage + "\n\n" + passage
    out[11] = "ünïcödé " * 40
    out[12] = "xx ünïcödé ünïcödé " + "ünïcödé " * 30
    out[13] = "\n".join(" ".join(_words(12, 100 + i % 40)) for i in range(400))
    out[14] = "aaaa" * 60
    out[15] = "a" * 130
    for i in range(16, 46):  # a group of near copies that differ from each other
        w = list(base)
        w[i % 60] = f"edit{i}"
        out[i] = " ".join(w)
    return out


@pytest.fixture(scope="module")
def texts():
    return _texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, None if i % 7 == 0 else "en", None if i % 5 == 0 else f"s{i % 3}", 0, "x", "x", "x", "x", "x") for i, t in texts.items()]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def _shingles(text, size=2):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def _groups(sets, percent=80):
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {i: top(i) for i in sets}


def test_near_duplicates_equal_brute_force(docs, texts, none):
    sets = {i: _shingles(t) for i, t in texts.items()}
    want = {i: (len(sets[i]), c, c == i) for i, c in _groups(sets).items()}
    got = {r[0]: (r[1], r[2], r[3]) for r in minhash.near_duplicates(docs).collect()}
    assert got == want
    assert minhash.near_duplicates(none).collect() == []
    kept = minhash.deduplicate(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, x in want.items() if x[2]}


def test_near_duplicates_stage_takes_five_words(spark):
    base = _words(100, 3)
    more = [*base[:20], "one", *base[21:50], "two", *base[51:80], "three", *base[81:]]
    texts = {1: " ".join(base), 2: " ".join(base), 3: " ".join(more), 4: " ".join([*base[:99], "end"])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")

    def close(a, b, size):
        x, y = (set(zip(*(t.split()[i:] for i in range(size)))) for t in (texts[a].lower(), texts[b].lower()))
        return len(x & y) >= 0.8 * len(x | y)

    assert close(1, 3, 2) and not any(close(i, 3, 5) for i in (1, 2, 4)) and close(1, 4, 5)
    assert {x.doc_id for x in minhash.deduplicate(docs).collect()} == {1}
    assert {x.doc_id for x in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()} == {1, 3}


def test_hubs_of_a_bucket_are_a_group_limit(spark):
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("id"))
    for count in minhash.HUBS:
        ranked = spark.range(5000).withColumn("bucket", F.col("id") % 2).withColumn("rank", rank).where(F.col("rank") <= count)
        assert "WindowGroupLimit" in ranked._jdf.queryExecution().optimizedPlan().toString()


def test_near_duplicates_without_id(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (3, "a b c"), (4, None)], "doc_id long, text string")
    got = sorted(map(tuple, minhash.near_duplicates(df).collect()), key=str)
    assert got == [(3, 2, 3, True), (4, 0, 4, True), (None, 2, None, True), (None, 2, None, True)]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {tuple(r) for r in minhash.components(edges).collect()} == {(i, 0) for i in range(41)} | {(100, 100), (101, 100)}


def test_repeats_equal_brute_force(docs, texts, none):
    first, want = {}, {}
    for i in sorted(texts):
        raw = (texts[i] or "").encode()
        gone = bytearray(len(raw))
        strings = [raw[s : s + 50] for s in range(len(raw) - 49)]
        for s, x in enumerate(strings):
            if first.get(x, i) < i:
                gone[s : s + 50] = b"\1" * 50
        for x in strings:
            first.setdefault(x, i)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        want[i] = (len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    got = {r[0]: tuple(r)[1:] for r in prefix_doubling.remove_repeats(docs).collect()}
    assert got == want
    assert prefix_doubling.remove_repeats(none).collect() == []


def test_repeats_of_rows_with_one_id_or_none(spark):
    text = " ".join(_words(30, 9))
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text + "!"), (2, "other")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in prefix_doubling.remove_repeats(df).collect())
    n = len(text)
    assert got == sorted([("1", n, 0), ("1", n, 0), ("None", n, 0), ("2", n + 1, n), ("2", 5, 0)])


def test_anchor_names_depend_on_the_string_alone():
    plan = prefix_doubling.layout()
    raw = " ".join(_words(200, 5)).encode()
    shifted = b"0123456789abc" + raw
    one, two = prefix_doubling.anchors(raw, plan), prefix_doubling.anchors(shifted, plan)
    assert (one[1][one[0]] == two[1][two[0]][13:]).all()


def test_lines_equal_brute_force(docs, texts, none):
    seen, want = [], {}
    for i in sorted(texts):
        kept, n = [], 0
        for k, line in enumerate((texts[i] or "").split("\n")):
            s = frozenset(w for w in re.split(r"[ \t\r\x0b\f]+", line.lower()) if w)
            if s:
                n += 1
                if not any(100 * len(s & o) >= 80 * len(s | o) for o in seen):
                    kept.append(k)
                seen.append(s)
        want[i] = (n, n - len(kept), hashlib.md5(",".join(map(str, kept)).encode()).hexdigest())
    got = {r[0]: tuple(r)[1:] for r in line_join.line_verdicts(docs).collect()}
    assert got == want
    assert line_join.line_verdicts(none).collect() == []
    left = {r.doc_id: r.text for r in line_join.remove_lines(docs).collect()}
    assert left[1] == texts[1] and left[2] == "" and left[4] is None and left[6] == texts[6]


def test_lines_without_id_stay(spark):
    df = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (1, "a b c"), (2, "a b c\nd")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_lines, r.n_removed) for r in line_join.line_verdicts(df).collect())
    assert got == [("1", 1, 0), ("1", 1, 0), ("2", 2, 1), ("None", 0, 0)]
    assert sorted(str(r.text) for r in line_join.remove_lines(df).collect()) == ["a b c", "a b c", "a b c", "d"]


def test_long_lines_that_share_few_words_are_not_compared(spark, monkeypatch):
    rows = []
    land = line_join.land
    monkeypatch.setattr(line_join, "land", lambda df: (rows.append((df.columns, land(df))), rows[-1][1])[1])
    texts = [" ".join(random.Random(i).sample([f"w{k}" for k in range(600)], 150)) for i in range(30)]
    df = spark.createDataFrame([*enumerate(texts), (30, texts[3] + " more")], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in line_join.line_verdicts(df).collect()}
    assert got == {i: int(i == 30) for i in range(31)}
    pairs = {tuple(r) for columns, frame in rows if columns == ["a_place", "b_place"] for r in frame.collect()}
    assert pairs == {((3, 0), (30, 0))}


def test_similar_lines_of_all_lengths_and_spaces_equal_brute_force(spark):
    r, lines = random.Random(5), []
    for n in [2, 4, 5, 8, 9, 30, 55, 56, 57, 60, 70, 120, 200] * 3:
        base = [f"{r.choice('abcdef')}{r.randrange(300)}" for _ in range(n)]
        for share in (0, 0.05, 0.1, 0.15, 0.25):
            words = [w if r.random() >= share else f"z{r.randrange(10**6)}" for w in base]
            r.shuffle(words)
            lines.append("".join(w.upper() + r.choice([" ", "\t", "  ", "\x0b", "\r"]) for w in words))
    lines += ["", " \t ", *lines[:3]]
    r.shuffle(lines)
    seen, want = [], []
    for line in lines:
        s = frozenset(w for w in re.split(r"[ \t\r\x0b\f]+", line.lower()) if w)
        want += [int(any(100 * len(s & o) >= 80 * len(s | o) for o in seen))] if s else [0]
        seen += [s] if s else []
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in line_join.line_verdicts(df).collect()}
    assert [got[i] for i in range(len(lines))] == want and 60 < sum(want) < len(lines) - 30


def _hits(text, items):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, found = set(), set()
    for item, passage in items:
        p = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), passage or ""))
        m = min(13, len(p))
        for i in range(len(p) - m + 1 if m else 0):
            for s in range(len(w) - m + 1):
                if w[s : s + m] == p[i : i + m]:
                    hit |= set(range(s, s + m))
                    found.add(item)
    ids = sorted(map(str, found - {None}))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("block_bytes", [1 << 20, 120])
def test_contamination_equals_brute_force(spark, docs, texts, none, block_bytes):
    passage = texts[9].split("\n")[1]
    items = [(1, passage), (20, passage.upper() + " more"), (3, "One"), (4, None), (5, "..."), (None, texts[11][:60]), (6, " ".join(_words(60, 1)[5:40]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in wumanber.contamination(docs, bench, block_bytes).collect()}
    want = {i: _hits(t, items) for i, t in texts.items()}
    assert got == want
    assert wumanber.contamination(none, bench, block_bytes).collect() == []
    clean = wumanber.decontaminate(docs, bench, block_bytes)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {i for i, x in want.items() if not x[-1]}


def test_contamination_without_benchmark(spark, docs):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert wumanber.contamination(docs, empty).where("contaminated or n_hit > 0").isEmpty()


def test_conversations_round_trip(spark):
    odd = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<", "|", "\\", "", None, "a<|b<\\\\|c\n", "é<|ü", "ends with <"]
    rows = [(c, t, random.Random(c * 99 + t).choice(["user", "assistant", "a\\nb\n<|", None]), odd[(c + t) % len(odd)]) for c in range(12) for t in range(c)]
    rows += [(None, 1, "user", "x"), (None, None, "assistant", "y"), (5, 1, "user", "same turn")]
    made = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in chat.read_back(made).collect()}
    length = {r.conv_id: len(r.text) for r in made.collect()}
    assert set(got) == {r[0] for r in rows}
    for c, r in got.items():
        turns = sorted((x for x in rows if x[0] == c), key=lambda x: (x[1] is not None, x[1] or 0, x[2] is not None, (x[2] or "").encode(), x[3] is not None, (x[3] or "").encode()))
        said = "".join(x[3] or "" for x in turns if x[2] == "assistant")
        full = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in turns)
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(full.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert r.formatted_chars == length[c]


def test_long_conversation_comes_in_parts(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART_BYTES", 1000)
    import pyarrow as pa

    batch = pa.record_batch(
        [pa.array([1] * 50 + [2]), pa.array(list(range(50)) + [0]), pa.array(["assistant"] * 51), pa.array(["é" * 40] * 51)], ["conv_id", "turn", "role", "text"]
    )
    parts = [r for b in chat._format(batch.slice(i, 7) for i in range(0, 51, 7)) for r in b.to_pylist()]
    assert [p["part"] for p in parts if p["conv_id"] == 1] == list(range(len(parts) - 1)) and len(parts) > 3
    back = [r for b in chat._digests(pa.RecordBatch.from_pylist([p], schema=b.schema) for p in parts) for r in b.to_pylist()] if (b := next(chat._format(iter([batch])))) else []
    assert [(r["conv_id"], r["n_turns"], r["loss_chars"]) for r in back] == [(1, 50, 2000), (2, 1, 40)]


def test_shards_are_even_and_proportional(spark, none):
    rows = [(i, "x" * (i % 50), "hot" if i % 3 else None if i % 9 else f"rare{i % 4}") for i in range(3001)]
    got = interleave.interleave(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    counts = got.groupby("shard").size()
    assert sorted(got.doc_id) == list(range(3001)) and counts.max() - counts.min() <= 1 and len(counts) == 16
    hot = got[got.source == "hot"].groupby("shard").size()
    assert hot.max() - hot.min() <= 6  # as many as there are other sources
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert (got["size"] == got.doc_id % 50 + 1).all()
    assert all(zlib.crc32(b"x" * (i % 50)) == c for i, c in zip(got.doc_id, got.text_crc32, strict=True))
    assert interleave.interleave(none).collect() == []


def test_shards_of_odd_rows(docs, texts):
    got = {r.doc_id: r for r in interleave.interleave(docs).collect()}
    assert {i: (r.size, r.text_crc32) for i, r in got.items()} == {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts.items()}


def test_raking_meets_the_targets(spark, none, docs):
    r = random.Random(3)
    cells = [(s, g, t, r.randint(50, 5000)) for s in "abcd" for g in ("x", "y") for t in ("p", "q")] + [("e", "x", "p", 0)]
    df = spark.createDataFrame(cells, "cell_source string, cell_lang string, cell_topic string, tokens long")
    targets = {"source": {"a": 1, "b": 1, "c": 2, "gone": 5}, "lang": 0.5, "topic": {"p": 1, "q": 1}}
    got = raking.rake(df, targets, rate=0.2, sweeps=25).toPandas()
    got["kept"] = got.tokens * got.probability
    total = got.tokens.sum() * 0.2
    by = got.groupby("cell_source").kept.sum() / total
    assert by["a"] == pytest.approx(0.25, abs=1e-4) and by["c"] == pytest.approx(0.5, abs=1e-4) and by["d"] == 0
    assert got.groupby("cell_topic").kept.sum()["p"] == pytest.approx(total / 2, rel=1e-4)
    assert got.probability.between(0, 1).all()
    assert raking.mixture(none).collect() == []
    drawn = raking.mixture(docs).where("kept")
    assert {x.doc_id for x in raking.mix(docs).collect()} == {x.doc_id for x in drawn.collect()}


def test_toxic_chain_learns_words_and_beginnings(spark):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        w = _words(r.randint(8, 60), 1000 + i)
        bad = i % 6 == 0
        if bad:
            w[r.randrange(len(w))] = r.choice(["nasty", "vileword"]) if i % 12 else "gruzzo" + r.choice(["n", "ts", "ka", "lu"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    rows += [(9000, None), (9001, ""), (9002, "so gruzzomi here"), (9003, "...")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    chain = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {x.doc_id: x for x in toxicity.score(docs, chain, likely=0.2).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert sum(got[i].predicted == dict(labels)[i] for i in held) / len(held) > 0.95
    assert got[9002].predicted == 1 and got[9002].span_ends == [11]
    assert got[9000].score == got[9001].score == got[9003].score < 0.5 and got[9000].span_starts == []
    assert {x.doc_id for x in toxicity.drop_toxic(docs, chain).collect()} == {i for i, x in got.items() if not x.predicted}


def test_toxic_verdicts_do_not_hang_on_the_sample_limits(spark):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(20_000):  # one in 50 is toxic; the word stands in all of these and in one of 30 others
        bad = i % 50 == 0
        rows.append((i, " ".join([*_words(5, 5000 + i), *(["nasty"] if bad or r.random() < 1 / 30 else [])])))
        labels.append((i, int(bad)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    new = spark.createDataFrame([(1, " ".join([*_words(5, 1), "nasty"])), (2, " ".join(_words(5, 1))), (3, None)], "doc_id long, text string")
    limits = {1: 250, 0: 2000}
    assert all(toxicity.class_totals(docs, labels)[k] > n for k, n in limits.items())
    got = []
    for chain in (toxicity.train(docs, labels, {1: 10**6, 0: 10**6}), toxicity.train(docs, labels, limits)):
        got.append({x.doc_id: x for x in toxicity.score(new, chain).collect()})
    free, bound = got
    assert 0.2 < free[1].score < 0.5
    for i in free:
        assert bound[i].predicted == free[i].predicted and bound[i].score == pytest.approx(free[i].score, abs=0.1)


def _chain_lines(texts, toxic):
    words, marks, weights, vocabulary = toxicity._labelled_lines(texts, toxic, {0: 1.0, 1: 1.0})
    return [([vocabulary[i] for i in w], m.tolist(), weight) for w, m, weight in zip(words, marks, weights, strict=True)]


@pytest.mark.parametrize("marked, plain", [(40, 70), (300, 200), (300, 20), (20, 300)])
def test_lines_of_the_toxic_chain_come_from_the_whole_sample(monkeypatch, marked, plain):
    monkeypatch.setattr(toxicity, "MAX_LINES", 100)
    texts = [f"nasty t{i}" for i in range(marked)] + [f"fine c{i}" for i in range(plain)]
    toxic = [1] * marked + [0] * plain
    lines = _chain_lines(texts, toxic)
    assert len(lines) == min(100, marked + plain)
    for mark, total in (("t", marked), ("c", plain)):
        picked = [(int(words[1][1:]), weight) for words, _, weight in lines if words[1][0] == mark]
        assert len(picked) >= min(50, total)
        assert sum(w for _, w in picked) == pytest.approx(total)
        # No stretch of the sample is left out.
        at = [-1, *sorted(i for i, _ in picked), total]
        assert max(b - a for a, b in zip(at, at[1:])) <= total // len(picked) + 2


def test_toxic_chain_without_labels(spark, docs, none):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    chain = toxicity.train(docs, labels)
    assert toxicity.score(docs, chain).where("predicted = 1 and score < 0.5").isEmpty()
    assert toxicity.score(none, chain).collect() == []


def test_chain_marginals_equal_enumeration():
    import itertools

    import numpy as np

    chain = toxicity.Chain(np.zeros(1), np.log(np.array([[0.9, 0.1], [0.3, 0.7]])), (0, 1, 0))
    odds = [0.2, 3.0, 0.5, 1.5]
    total, one = 0.0, [0.0] * 4
    for path in itertools.product((0, 1), repeat=4):
        p = np.prod([o if y else 1.0 for o, y in zip(odds, path)]) * np.prod([np.exp(chain.moves[a, b]) for a, b in zip(path, path[1:])])
        total += p
        one = [x + p * y for x, y in zip(one, path)]
    assert chain.marginals(odds) == pytest.approx([x / total for x in one])


def test_expected_transitions_equal_enumeration():
    import itertools

    import numpy as np

    move, odds, weight = np.array([[0.9, 0.1], [0.3, 0.7]]), [[0.2, 3.0, 0.5, 1.5], [2.0, 0.4]], np.array([1.5, 0.5])
    want = np.zeros((2, 2))
    for line, w in zip(odds, weight):
        total, one = 0.0, np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=len(line)):
            steps = list(zip(path, path[1:]))
            p = np.prod([o if y else 1.0 for o, y in zip(line, path)]) * np.prod([move[s] for s in steps])
            total += p
            for s in steps:
                one[s] += p
        want += w * one / total
    _, got = toxicity._batch_marginals(move, [np.array([0.2, 2.0]), np.array([3.0, 0.4]), np.array([0.5]), np.array([1.5])], [2, 2, 1, 1], weight)
    assert got == pytest.approx(want)


def test_transitions_of_the_chain_are_trained():
    import numpy as np

    # The word stands twice in toxic documents and once in some clean ones.
    r = random.Random(6)
    texts, toxic = [], []
    for i in range(3000):
        w = _words(6, 7000 + i)
        if i % 30 == 0:
            w[2:4] = ["nasty", "nasty"]
        elif r.random() < 0.03:
            w[2] = "nasty"
        texts.append(" ".join(w))
        toxic.append(int(i % 30 == 0))
    chain = toxicity.fit(texts, toxic, epochs=200)
    observed = np.array([[0.0, 0.0], [0.0, 0.0]])
    lines = _chain_lines(texts, toxic)
    for _, marks, weight in lines:
        for step in zip(marks, marks[1:]):
            observed[step] += weight
    expected = np.zeros((2, 2))
    for words, _, weight in lines:
        odds = [np.array([chain.potential(w)]) for w in words]
        expected += toxicity._batch_marginals(np.exp(chain.moves), odds, [1] * len(odds), np.array([weight]))[1]
    # The expected transitions of a trained chain are the observed ones.
    assert observed.min() > 50
    assert expected == pytest.approx(observed, rel=0.1)
    start = np.log((observed + 1) / (observed + 1).sum(1, keepdims=True))
    assert np.abs(chain.moves - start).max() > 0.1


PII = [
    "mail a.b+c@x-1.example.com and z@y, 1.2.3.4.5.6.7.8 or 300.1.1.1",
    "card 4111 1111 1111 1111 no 4111 1111 1111 1112, +1 (414) 555-7134. +12 3",
    "@@a@b.c@d.e.f é x@é.com 0001.002.03.4", "9" * 300, None, "", "+1((((((", "a@b.c" * 50, "1-2-3-4-5-6-7-8-9-0-1-2-3 +1-2-3-4-5-6-7-8-9",
]


def _base(text):
    out = []
    patterns = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(re.sub(r"[^0-9]", "", s)) <= 19 and _luhn(re.sub(r"[^0-9]", "", s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(re.sub(r"[^0-9]", "", s)) <= 15),
    }
    for kind, (pattern, valid) in patterns.items():
        out += [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, text or "") if valid(m[0])]
    return out


def _luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def test_base_spans_stay(spark):
    df = spark.createDataFrame(list(enumerate(PII)), "doc_id long, text string")
    for r in skipchain.find(df, skipchain.train(df)).collect():
        base = _base(PII[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(",")) | {""}
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b.startswith(k) for b in base) for k in skipchain.KINDS]


def test_evidence_reaches_far_copies_whatever_the_batch_holds():
    import numpy as np

    k, copies = len(skipchain.LABELS), 80
    tie = np.full((k, k), -6.0) + 12.0 * np.eye(k)
    model = skipchain.Field({"mail": 0}, np.array([[0, 12.0, 0, 0, 0]]), np.zeros((k, k)), tie)

    def add(graph, owner, n):
        at = len(graph.spans)
        graph.spans += [(i, i + 1) for i in range(n)]
        graph.owner += [owner] * n
        graph.features += [["mail"] if i == 0 else [] for i in range(n)]
        graph.barred += [0] * n
        graph.skip += [(at + i, at + i + 1) for i in range(n - 1)]
        return graph

    alone = model.marginals(add(skipchain.Graph(), 0, copies))
    # On a path the marginal is exact: the first token's evidence, moved on by each tie.
    move = np.exp(tie) / np.exp(tie).sum(1, keepdims=True)
    start = np.exp([0, 12.0, 0, 0, 0])
    assert alone[-1] == pytest.approx(start / start.sum() @ np.linalg.matrix_power(move, copies - 1), abs=0.01)
    assert alone[-1].argmax() == 1 and alone[-1].max() > 0.95
    # A short document has the same marginals with and without a long one in its batch.
    short = model.marginals(add(skipchain.Graph(), 0, 3))
    assert (model.marginals(add(add(skipchain.Graph(), 0, 3), 1, copies))[:3] == short).all()


def test_repeated_tokens_share_evidence():
    import numpy as np

    graph = skipchain.Graph()
    graph.add("id 123456 x id 123456", 0, {k: [] for k in skipchain.KINDS}, [])
    graph.features = [["a"], ["b"]]
    k = len(skipchain.LABELS)
    weights = np.zeros((2, k))
    weights[0, 3] = 3.0
    model = skipchain.Field({"a": 0, "b": 1}, weights, np.zeros((k, k)), 2 * np.eye(k))
    assert graph.skip == [(0, 1)]
    assert model.marginals(graph)[1, 3] > 0.5
    model.skip[:] = 0
    assert model.marginals(graph)[1, 3] == pytest.approx(1 / k)


def test_quality_counts_equal_brute_force(spark, docs, texts, none):
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "doc_id long, quality int")
    for r in thresholds.judge(docs, labels).collect():
        text = texts[r.doc_id] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        repeated = {i + j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(3)} if len(w) < 1000 else None
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars) == (len(w), sum(map(len, w)))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text)) and r.n_dup_lines == len(lines) - len(set(lines))
        assert repeated is None or r.n_repeat_words == len(repeated)
        assert r.base_failed == (len(w) < 50 or 100 * r.n_repeat_words > 50 * len(w)) and (not r.kept or not r.base_failed)
        assert r.base_failed or r.kept  # three labels certify nothing
    assert thresholds.judge(none, labels).collect() == []


def test_cutoffs_reject_few_good_documents(spark):
    r = random.Random(7)
    rows, labels = [], []
    for i in range(4000):
        good = i % 4 != 0
        w = _words(60, 5000 + i)
        for _ in range(r.randint(0, 2) if good else 30):
            w[r.randrange(60)] += "#"
        rows.append((i, " ".join(w), "en"))
        labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = thresholds.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int")).join(spark.createDataFrame(labels, "doc_id long, quality int"), "doc_id")
    rate = {q: n for q, n in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()}
    assert rate[1] >= 0.95 and rate[0] < 0.1


def test_binomial_tail_is_exact():
    from math import comb

    for n, p in ((10, 0.25), (50, 0.0625), (200, 0.03125), (1000, 0.0078125)):
        top, whole = p.as_integer_ratio()
        for k in (0, 1, 5, n // 3, n - 1, n):
            exact = sum(comb(n, j) * top**j * (whole - top) ** (n - j) for j in range(k + 1)) / whole**n
            assert thresholds.binomial_tail(k, n, p) == pytest.approx(exact, rel=1e-9)


def test_pipeline_stages_keep_the_columns(spark, docs, none, tmp_path, monkeypatch):
    tables = {
        "labels": spark.createDataFrame([(i, 0, i % 2) for i in range(1, 40)], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(1, " ".join(_words(14, 2)))], "item_id long, text string"),
        "documents": docs,
    }
    monkeypatch.setattr(corpus_pipeline, "table", lambda s, d, name: tables[name])
    for given in (docs, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, given, "").columns == docs.columns
    assert corpus_pipeline.run(spark, "").columns[0] == "doc_id"


def test_texts_of_classes_without_a_possible_pair_are_not_shuffled(spark, monkeypatch):
    # 0.6 similar by inclusion: they meet in buckets, but their lengths rule all pairs out.
    words = [[f"w{i}x{j}" for j in range(101)] for i in range(12)]
    docs = spark.createDataFrame([(2 * i + k, " ".join(w[: 61 + 40 * k])) for i, w in enumerate(words) for k in (0, 1)], "doc_id long, text string")
    seen = []
    monkeypatch.setattr(minhash, "_sets", lambda texts, size, sets=minhash._sets: seen.append(texts.count()) or sets(texts, size))
    assert {r.kept for r in minhash.near_duplicates(docs).collect()} == {True}
    assert sum(seen) == 0


def test_only_rows_that_may_go_meet_the_dropped_ones(spark):
    text = " ".join(f"w{j}" for j in range(40))
    rows = [(i, text if i % 3 == 0 else f"{i} only {i * i} here") for i in range(90)] + [(None, text), (None, None), (200, None), (3, "other words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = minhash.deduplicate(docs)
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        # All texts met the dropped rows in a shuffled join before.
        assert "Join LeftOuter" in plan and "shiftright" in plan.split("Join LeftAnti")[1]
        got = sorted((tuple(r) for r in kept.collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted((r for r in rows if r[0] in (0, None) or r[1] != text), key=str)
