"""Repeated ids and bounded samples of the operators that learn or delete."""

from martwright.llm import minhash, toxicity

TEXT = " ".join(f"word{i}" for i in range(40))


def test_rows_of_one_id_are_judged_by_their_own_texts(spark, rows):
    other = " ".join(f"else{i}" for i in range(40))
    data = [(1, TEXT), (5, TEXT), (5, other), (5, TEXT), (None, TEXT), (6, None), (6, "")]
    docs = spark.createDataFrame([(*d, "x", "x") for d in data], "doc_id long, text string, text_key string, component_id string")
    expected = [(1, TEXT), (5, other), (None, TEXT), (6, None), (6, "")]
    assert rows(minhash.deduplicate(docs, size=5), "doc_id", "text") == sorted(expected, key=repr)


def test_sample_is_bounded_by_rows_and_bytes(spark):
    texts = [(i, f"{'long ' * (2000 if i % 9 == 0 else 5)}{i}") for i in range(200)] * 2
    docs = spark.createDataFrame([*texts, (1, None), (None, "x")], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    found = toxicity.sample(docs, labels, {1: 30, 0: 20}, 20_000)
    assert found == toxicity.sample(docs.repartition(5), labels, {1: 30, 0: 20}, 20_000)
    for label, limit in ((1, 30), (0, 20)):
        chosen = [t for t, kind in zip(*found, strict=True) if kind == label]
        assert 0 < len(chosen) <= limit and sum(map(len, chosen)) <= 20_000 and len(set(chosen)) == len(chosen)
    assert toxicity.sample(docs.limit(0), labels) == ([], [])


def test_words_train_as_they_score():
    words, _, _, vocabulary = toxicity._labelled_lines(["İSTANBUL Straße\n\nno"], [0], {0: 1.0, 1: 1.0})
    assert vocabulary == ["İSTANBUL".lower(), "straße", "no"] and [w.tolist() for w in words] == [[0, 1], [2]]
