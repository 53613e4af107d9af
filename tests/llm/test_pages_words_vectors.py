"""Main text, spelling variants and hard negatives against brute force and on odd rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from martwright.llm import main_text, negatives, spelling

P = "A paragraph of the article that is long enough to stand out from what surrounds it on the page."
Q = "Another paragraph with as many words as the first one, so that both of them are certainly content."


def _page(body):
    return f"<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{body}</body></html>"


NAV = "<nav><ul><li><a href='/a'>Home</a><li><a href='/b'>News and more of them</a></ul></nav>"
PAGES = {
    "article": (_page(f"{NAV}<article><h1>Title</h1><p><b>{P}<br><p>Is.</p><p>{Q}</p></article><footer>&copy; no</footer>"), ["Title", P, "Is.", Q]),
    "cut off": (f"{NAV}<article><h1>Title</h1><p>{P}</p><p>{Q}", ["Title", P, Q]),
    "references": (_page(f"<article><p>{P} a &amp; b &lt;i&gt; &eacute;&#233;&#xe9;&nbsp; \n\t c &amp;amp;</p></article>"), [P + " a & b <i> ééé c &amp;"]),
    "names": (
        _page(
            f"<div id='cookie-notice'><p>{P}</p></div><div class='page'><div class='postBody'><h1>T</h1><p>{P}</p><p>So.</p><p>{Q}</p>"
            f"<form><p>{Q}</p></form><div class=\"ad\">{Q}</div></div><div class='side-bar sidebar'><p>{Q}</p></div></div>"
            f"<section id='comments'><article class='comment'><p>{P} {Q}</p></article></section>"
        ),
        ["T", P, "So.", Q],
    ),
    "reactions": (_page(f"<article><p>{P}</p><article><p>{Q}</p></article></article>"), [P]),
    "header inside": (_page(f"<header><h1>Site</h1></header><main><article><header><h1>T</h1></header><p>{P}</p><aside>{Q}</aside></article></main>"), ["T", P]),
    "wrapped in a form": (_page(f"<form class='has-sidebar'><article><p>{P}</p></article></form>"), [P]),
    "unclosed menu": (_page(f"<nav><ul><li><a href='/'>Home</a><article><p>{P}</p></article>"), [P]),
    "hidden": (_page(f"<article><p>{P}</p><p hidden>{Q}</p><div style='display: none'>{Q}</div><p aria-hidden=true>{Q}</p></article>"), [P]),
    "table": (_page(f"<article><p>{P}</p><table><tr><td>one<td>two<tr><td>three</table><!-- no --></article>"), [P, "one two", "three"]),
    "plain": (f"{P}\n {Q}", [f"{P} {Q}"]),
    "paragraphs of the body": (_page(f"<h1>T</h1><p>{P}</p><p>Is.</p><p>{Q}</p><div>all rights</div>"), ["T", P, "Is.", Q]),
    "only menu": (_page(NAV), []),
    "empty": ("", []),
    "null": (None, []),
    "broken": ("<<>><a <b>&#xFFFFFFF; <!-- <![CDATA[ </", None),
    "long": (_page("<article>" + f"<p>{P}</p>" * 3000 + "</article>"), [P] * 3000),
}


@pytest.mark.parametrize("name", list(PAGES))
def test_main_text_of_a_page(name):
    html, expected = PAGES[name]
    text, n = main_text.extract(html)
    if expected is not None:
        assert text == "\n\n".join(expected) and n == len(expected)


def test_main_text_is_the_same_in_any_pieces(monkeypatch):
    whole = {name: main_text.extract(html) for name, (html, _) in PAGES.items() if name != "long"}
    monkeypatch.setattr(main_text, "FEED", 7)
    assert whole == {name: main_text.extract(html) for name, (html, _) in PAGES.items() if name != "long"}


def test_smoothing_is_a_weighted_mean():
    ratios = np.array([0.0, 10.0, 0.0, 0.0, 30.0])
    kernel = [np.exp(-0.5 * d * d) for d in range(-3, 4)]
    expected = [sum(ratios[i + d] * kernel[d + 3] for d in range(-3, 4) if 0 <= i + d < 5) / sum(kernel) for i in range(5)]
    assert np.allclose(main_text.smooth(ratios), expected)


def test_main_text_rows(spark, rows):
    schema = "page_id long, url string, html string, text string, n_chars string"
    table = spark.createDataFrame([(1, "u", PAGES["article"][0], "x", "x"), (1, "u", PAGES["article"][0], "x", "x"), (None, None, None, None, None)], schema)
    text = "\n\n".join(PAGES["article"][1])
    assert rows(main_text.main_text(table)) == sorted([(1, "u", text, len(text), 4)] * 2 + [(None, None, "", 0, 0)], key=repr)
    assert rows(main_text.main_text(table.limit(0))) == []


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _brute_variants(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: sorted((v for v in words if _near(w, v)), key=lambda v: (-words[v], v)) for w in words}
    form = {w: near[w][0] if near[w] and words[near[w][0]] >= 10 * words[w] else None for w in words}

    def root(w):
        return w if form[w] is None else root(form[w])

    return [(w, form[w], root(w), n, len(near[w]), form[w] and words[form[w]]) for w, n in words.items()]


@pytest.fixture(scope="module")
def misspelt():
    r = random.Random(4)
    base = ["spelling", "variant", "ünïcødé÷", "aaaaaaaa", "grouping", "Straßenbahn"]
    docs = [(None, None), (1, ""), (2, "1 2 3 short"), (3, "long" * 5000 + " " + "long" * 5000), (4, "ANSEHEN ansehen ÀNSEHEN"), (4, "ANSEHEN ansehen ÀNSEHEN")]
    for i in range(120):
        words = []
        for _ in range(60):
            w = r.choice(base)
            for _ in range(r.choice([0] * 12 + [1, 1, 2])):
                at = r.randrange(len(w) + 1)
                w = r.choice([w[:at] + r.choice("aeßxyz") + w[at:], w[:at] + w[at + 1 :], w[:at] + r.choice("aeßxyz") + w[at + 1 :]])
            words.append(w)
        docs.append((None if i == 7 else 10 + i // 2, ", ".join(words)))
    return docs


def test_variants_equal_brute_force(spark, rows, misspelt):
    schema = "doc_id long, text string, word string, n string, code string, near string, form string"
    table = spark.createDataFrame([(*d, "x", "x", "x", "x", "x") for d in misspelt], schema).repartition(3)
    found = spelling.variants(table)
    expected = _brute_variants(misspelt)
    assert rows(found, "word", "form", "root", "n", "n_near", "form_n") == sorted(expected, key=repr)
    assert any(e[1] and e[1] != e[2] for e in expected) and sum(e[4] for e in expected) > 200


def test_variants_of_nothing(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_neighbourhoods_are_full_and_have_no_repeats():
    forms = ["abcabca", "aaaaaaa", "ffffffe"]

    def code(form):
        value = 0
        for c in form:
            value = (value * int(spelling._BASE) + ord(c)) % 2**64
        return value

    own, near, at = spelling.neighbourhoods(forms)
    assert own.tolist() == [code(f) for f in forms]
    for i, form in enumerate(forms):
        edits = {form, *(form[:k] + form[k + 1 :] for k in range(len(form)))}
        edits |= {form[:k] + s + form[k + gap :] for k in range(len(form) + 1) for s in spelling.SYMBOLS for gap in (0, 1)}
        assert sorted(near[at == i].tolist()) == sorted(map(code, edits))


def _vectors(seed=2, n=260):
    r = random.Random(seed)
    out = []
    for i in range(n):
        vector = [r.gauss(0.1 * (i % 3), 0.3) for _ in range(12)]
        out.append((i * 5, r.randrange(4), vector))
    out += [(50 * 700, None, [0.1] * 12), (3, 1, None), (8, 1, [0.1, None, *[0.0] * 10]), (9, 1, [float("nan")] * 12), (11, 1, [float("inf")] * 12)]
    out += [(None, 1, [0.5] * 12), (12, 1, []), (13, 2, [9.5, 0.25]), (14, 2, [0.5] * 12), (14, 2, [0.5] * 12), (15, 3, [0.5] * 12), (16, 3, [0.5] * 12)]
    return out


def _brute_negatives(vectors):
    table = []
    for vec_id, label, v in vectors:
        if vec_id is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        table.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [int(np.floor(256 * x)) for x in v]))
    out = []
    for a, a_label, x in table:
        if a % 50:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y, strict=False)), b, label) for b, label, y in table)
        positives = [(b, -s) for s, b, label in scored if label == a_label and b != a][:5]
        for p, ps in positives:
            found = [(b, -s) for s, b, label in scored if label != a_label and 50 * ps <= -100 * s <= 95 * ps][:3]
            out += [(a, p, k, b, ps, s) for k, (b, s) in enumerate(found, 1)]
    return out


@pytest.mark.parametrize("scale,block", [(1.0, 8192), (1.0, 37), (2.0**22, 100), (2.0**31, 8192)])
def test_negatives_equal_brute_force(spark, rows, scale, block):
    vectors = [(i, label, v and [None if x is None else x * scale for x in v]) for i, label, v in _vectors()]
    schema = "vec_id long, label int, embedding array<double>, row string, anchor string, positive string, c_block string, rank string"
    table = spark.createDataFrame([(*v, "x", "x", "x", "x", "x") for v in vectors], schema).repartition(3)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    found = rows(negatives.mine(table, block=block), *names)
    expected = _brute_negatives(vectors)
    assert len(expected) > 50
    if scale <= 2.0**22:
        assert found == sorted(expected, key=repr)
    else:  # scores beyond 64 bits are cut to the range
        assert all(abs(r[4]) < 2**63 for r in found)


def test_negatives_of_nothing(spark):
    schema = "vec_id long, label int, embedding array<float>"
    assert negatives.mine(spark.createDataFrame([], schema)).collect() == []
    assert negatives.mine(spark.createDataFrame([(50, 1, [1.0]), (51, 1, [1.0])], schema)).collect() == []


@pytest.mark.parametrize("size", [1, 150, 2**20, 2**29, 2**45])
def test_packed_products_are_exact(size):
    r = np.random.default_rng(size)
    anchors, others = r.integers(-size, size + 1, (7, 9)), r.integers(-size, size + 1, (23, 9))
    packed = negatives.Packed(others, float(np.sqrt((anchors.astype(float) ** 2).sum(1).max())))
    exact = anchors.astype(object) @ others.T.astype(object)
    assert packed.scores(anchors).tolist() == np.clip(exact, -(2**63), 2**63 - 1).tolist()
    assert packed.fields >= 3 if size == 150 else packed.fields >= 1
