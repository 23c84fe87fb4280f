"""Ranked search, whitening and line rules against brute force, and on odd rows."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import COLUMNS, prose, rows_for
from tidemark.llm import lexical, linecrf, whitening

# -- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
A_TO_Z = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def ranked(texts, items, k):
    """``(item, rank, doc, score)`` straight from the definition; texts and items are lists of pairs."""
    bags = [(doc, Counter(TERM.findall((t or "").translate(A_TO_Z)))) for doc, t in texts]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for doc, bag in bags:
            m = n_terms and 100 - 25 + 25 * sum(bag.values()) * n_docs // n_terms
            score = 0
            for term in TERM.findall((text or "").translate(A_TO_Z)):
                if bag[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += w * (1_000_000_000 * bag[term] // (1000 * bag[term] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


ODD = [
    (50, "Ünter STRASSE straße é́ x² y"), (51, "a-b_c.d`e{f}g~h\x7fi@j"), (52, "İstanbul ΣΑΣ K"),
    (53, "0 00 000 0"), (54, None), (55, ""), (None, "ba ke dra"), (None, None),
]


@pytest.fixture(scope="module")
def asked(odd_texts):
    words = [t.split() for _, t in odd_texts if t and len(t.split()) > 20]
    items = [(k, " ".join(w[3 * k : 3 * k + 12])) for k, w in enumerate(words[:9])]
    return [*items, (20, "straße Strasse É́ x²"), (21, "A b c D e h i J"), (22, None), (23, "..."), (24, "nowhere"), (None, "0 0 00")]


def searched(spark, texts, items, k=20):
    docs = spark.createDataFrame(rows_for(texts), COLUMNS).repartition(3)
    rows = lexical.search(docs, spark.createDataFrame(items, "item_id long, text string"), k)
    assert rows.schema.simpleString() == "struct<item_id:bigint,rank:int,doc_id:bigint,score:bigint>"
    return sorted((tuple(r) for r in rows.collect()), key=repr)


@pytest.mark.parametrize("k", [3, 20])
def test_search_is_the_definition(spark, odd_texts, asked, k):
    texts = [(i, t) for i, t in odd_texts] + [(i or 900 + n, t) for n, (i, t) in enumerate(ODD)]
    assert searched(spark, texts, asked, k) == ranked(texts, asked, k)


def test_search_expands_a_big_class_by_ascending_id(spark):
    """Most documents are one class, and some of another text have the same bag."""
    texts = [(i, "Fox fox, dog!") for i in range(400, 0, -1)] + [(1000 + i, "dog fox FOX") for i in range(9)]
    texts += [(2000 + i, f"cat {'fox ' * i}") for i in range(6)] + [(3000, None)]
    items = [(1, "fox"), (2, "cat dog"), (3, "fox cat fox")]
    assert searched(spark, texts, items) == ranked(texts, items, 20)
    docs = spark.createDataFrame(rows_for(texts), COLUMNS)
    bags = lexical.bags(docs, {b"cat": 0, b"dog": 1, b"fox": 2}, "doc_id", "text")
    alike = lexical.classes(bags, 415, 1290, 20).collect()
    assert len(alike) == 7 and max(len(r["members"]) for r in alike) == 20


def test_search_on_odd_tables(spark, odd_texts, asked, documents, nothing, clashing):
    some = spark.createDataFrame(asked, "item_id long, text string")
    assert lexical.search(nothing, some).count() == 0
    assert lexical.search(documents, some.where("false")).count() == 0
    assert lexical.search(documents.where("text is null or text = ''"), some).count() == 0
    texts = [*odd_texts, (None, None)]
    extra = some.withColumns({n: F.lit("x") for n in ("rank", "score", "item", "term")})
    rows = lexical.search(clashing, extra).collect()
    assert sorted(map(tuple, rows), key=repr) == ranked(texts, asked, 20)


def test_search_in_blocks_of_items(spark, monkeypatch, odd_texts, asked):
    """Small blocks and small steps give the same rows."""
    monkeypatch.setattr(lexical, "BLOCK", 200)
    monkeypatch.setattr(lexical, "CELLS", 50)
    assert searched(spark, odd_texts, asked) == ranked(odd_texts, asked, 20)


def test_rows_without_an_id_come_last(spark):
    docs = spark.createDataFrame([(None, "one two", "en", "s", 7), (5, "one two", "en", "s", 7), (None, "one two", "en", "s", 7)], COLUMNS)
    items = spark.createDataFrame([(1, "two")], "item_id long, text string")
    assert [r["doc_id"] for r in lexical.search(docs, items).orderBy("rank").collect()] == [5, None, None]


# -- whitening


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)


def numpy_whitened(rows, k):
    """``n``, deviations by id, whitened by id (columns up to sign), shares."""
    fine = [(i, np.asarray(v, np.float32).astype(float)) for i, v, _ in rows if v is not None and None not in v and np.isfinite(v).all()]
    x = {i: np.floor(64 * v) + 1_000_000 for i, v in fine}
    once = np.unique(np.stack(list(x.values())), axis=0)
    values, found = np.linalg.eigh(np.cov(once.T, bias=True))
    order = np.argsort(-values)[:k]
    n, total = len(once), once.sum(axis=0)
    deviation = {i: int(((n * v - total) ** 2).sum()) for i, v in x.items()}
    white = {i: (v - total / n) @ found[:, order] / np.sqrt(values[order]) for i, v in x.items()}
    return n, deviation, white, values[order] / values.sum()


def checked(frame, rows, k):
    n, deviation, white, shares = numpy_whitened(rows, k)
    assert len(frame) == len(white) * k and set(frame.n) == {n}
    assert frame.identity_error.nunique() == 1 and frame.identity_error.iloc[0] < 1e-9
    assert frame.drop_duplicates("vec_id").set_index("vec_id").deviation.to_dict() == deviation
    got = frame.pivot(index="vec_id", columns="component", values="whitened").sort_index().to_numpy()
    want = np.stack([white[i] for i in sorted(white)])
    assert np.abs(got * np.sign((got * want).sum(axis=0)) - want).max() < 1e-8
    assert np.abs(frame.groupby("component").explained.first().to_numpy() / shares - 1).max() < 1e-9


@pytest.mark.parametrize(("count", "width", "k"), [(300, 40, 6), (50, 8, 8), (400, 12, 5)])
def test_whitening_agrees_with_numpy(spark, count, width, k):
    rng = np.random.default_rng(width)
    made = rng.standard_normal((count, width)) * np.linspace(3, 0.5, width)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(made)]
    rows += [(1000 + i, made[i % 7].tolist(), 1) for i in range(count // 2)]  # copies count once
    rows += [(5000, None, 0), (5001, [None, *made[0][1:].tolist()], 0), (5002, [math.nan, *made[0][1:].tolist()], 0)]
    rows += [(5003, [math.inf, *made[0][1:].tolist()], 0), (5004, [0.0] * width, 0)]
    checked(whitening.whiten(vectors(spark, rows), k).toPandas(), rows, k)


def test_filter_finds_the_top_of_a_flat_spectrum():
    rng = np.random.default_rng(3)
    basis = np.linalg.qr(rng.standard_normal((90, 90)))[0]
    values = np.concatenate([[40.0, 12.0, 12.0, 11.9], np.linspace(11.5, 9, 86)])
    matrix = basis * values @ basis.T
    passes = []

    def times(q):
        passes.append(q.shape)
        return matrix @ q

    found, turn, residual = whitening.leading(times, 90, 4)
    assert np.allclose(found, values[:4], rtol=1e-12) and residual <= 1e-10
    assert np.abs(matrix @ turn - turn * found).max() < 1e-9 and set(passes) == {(90, 1), (90, 12)}
    assert passes.count((90, 1)) == whitening.LANCZOS


@pytest.mark.parametrize("guess", [0.0, 8.9, 9.4, 10.5, 11.7, 50.0])
def test_a_wrong_guess_of_the_least_value_does_no_harm(monkeypatch, guess):
    rng = np.random.default_rng(4)
    basis = np.linalg.qr(rng.standard_normal((90, 90)))[0]
    values = np.concatenate([[40.0, 12.5, 12.4, 12.1], np.linspace(11.5, 9, 86)])
    matrix = basis * values @ basis.T
    monkeypatch.setattr(whitening, "least", lambda *_: guess)
    found, turn, residual = whitening.leading(lambda q: matrix @ q, 90, 4)
    assert np.allclose(found, values[:4], rtol=1e-12) and residual <= 1e-10


def test_least_value_is_met_from_below():
    rng = np.random.default_rng(5)
    basis = np.linalg.qr(rng.standard_normal((60, 60)))[0]
    values = np.linspace(50, 75, 60)
    assert 40 < whitening.least(lambda q: (basis * values @ basis.T) @ q, 60, 8) < 51
    assert np.isclose(whitening.least(lambda q: 3.0 * q, 60, 8), 3.0)


def test_whitening_of_odd_tables(spark):
    def whitened(rows, k=4):
        return whitening.whiten(vectors(spark, rows), k)

    assert whitened([]).count() == 0
    assert whitened([(1, None, 0), (2, [math.nan, 1.0], 0), (3, [], 0)]).count() == 0
    assert whitened([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)]).count() == 0  # no variance
    line = whitened([(1, [1.0, 2.0, 0.0], 0), (2, [3.0, 2.0, 0.0], 0), (2, [3.0, 2.0, 0.0], 0), (None, [5.0, 2.0, 0.0], 0)])
    rows = line.collect()
    assert [r["component"] for r in rows] == [1] * 4 and {r["n"] for r in rows} == {3}
    assert {(r["vec_id"], r["deviation"]) for r in rows} == {(1, 384**2), (2, 0), (None, 384**2)}
    assert np.isclose(rows[0]["explained"], 1.0) and {round(abs(r["whitened"]), 9) for r in rows} == {0.0, round(1.5**0.5, 9)}
    mixed = whitened([(1, [1.0, 2.0], 0), (2, [3.0, 1.0], 0), (3, [0.0, 7.0], 0), (4, [1.0, 2.0, 3.0], 0)])
    assert {r["vec_id"] for r in mixed.collect()} == {1, 2, 3}
    huge = whitened([(1, [1e30, 2.0], 0), (2, [3.0, 1.0], 0), (3, [2.0**40, 7.0], 0), (4, [0.0, 1.0], 0)])
    assert {(r["vec_id"], r["deviation"] is None) for r in huge.collect()} == {(2, True), (3, True), (4, True)}
    clash = vectors(spark, [(1, [1.0, 2.0], 0), (2, [3.0, 1.0], 0), (3, [0.0, 7.0], 0)])
    clash = clash.withColumns({c: F.lit("x") for c in ("id", "v", "n", "component", "whitened", "length", "code", "rows")})
    assert whitening.whiten(clash, 2).columns == [c.split()[0] for c in whitening.RESULT.split(", ")]


def test_vectors_of_all_widths_keep_their_entries():
    q = np.array([[1, -128, 127], [1, -129, 0], [2**31 - 1, 0, 0], [-(2**31) - 1, 5, 2**52]])
    codes = whitening._codes(q)
    assert [c[0] for c in codes] == [1, 2, 4, 8] and (whitening._block(codes) == q).all()


# -- line rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:], words[3:], words[4:]))
    inside = {p + k for p, w in enumerate(zip(words, words[1:], words[2:], words[3:], words[4:])) if windows[w] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), failed


def test_base_counts(spark, odd_texts, nothing, clashing):
    more = ["a b c d e " * 3, "x\n\nx\nx \n x", "a b c d e f a b c d e g", "é ü |#<> \x85 \x0b\x1c", "\n" * 9, "# " * 40, "a\r\nb\r\na\r\n"]
    texts = odd_texts + [(100 + i, t) for i, t in enumerate(more)]
    rows = linecrf.report(spark.createDataFrame(rows_for(texts), COLUMNS).repartition(2), None).collect()
    got = [(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in rows]
    assert sorted(got) == sorted((i, *base(t)) for i, t in texts)
    assert all(r["kept"] != r["base_failed"] for r in rows)
    assert linecrf.report(nothing, None).count() == 0
    assert linecrf.report(clashing, None).where("doc_id is null and n_words = 0 and base_failed").count() == 1


def test_chunks_do_not_change_a_result(monkeypatch, spark, documents):
    def counts():
        return sorted(map(tuple, linecrf.report(documents, None).collect()), key=repr)

    whole = counts()
    monkeypatch.setattr(linecrf, "CHUNK", 300)
    assert counts() == whole


def every_labelling(scores, pair):
    """``(score, labels)`` of all labellings of one document."""
    for labels in itertools.product((0, 1), repeat=len(scores)):
        inner = sum(pair[a, b] for a, b in zip(labels, labels[1:]))
        yield sum(s[y] for s, y in zip(scores, labels)) + inner, labels


def chain(seed, sizes):
    rng = np.random.default_rng(seed)
    features = rng.standard_normal((sum(sizes), 3))
    return features, np.repeat(np.arange(len(sizes)), sizes), linecrf.Field(rng.standard_normal(3), rng.standard_normal((2, 2)))


@pytest.mark.parametrize("seed", range(4))
def test_viterbi_finds_the_best_labelling(seed):
    sizes = [5, 1, 8, 2, 3]
    features, document, field = chain(seed, sizes)
    found = field.decode(features, document)
    for d in range(len(sizes)):
        own = document == d
        assert max(every_labelling(field.scores(features[own]), field.pair))[1] == tuple(found[own])
    assert len(field.decode(features[:0], document[:0])) == 0


def test_likelihood_and_gradient(monkeypatch):
    monkeypatch.setattr(linecrf, "RIDGE", 0.0)
    sizes = [4, 1, 6, 6]
    features, document, field = chain(9, sizes)
    labels = np.random.default_rng(2).integers(0, 2, len(document))
    weights = np.concatenate([field.unary, field.pair.ravel()])
    value, slope = linecrf.likelihood(weights, features, document, labels)
    want = 0.0
    for d in range(len(sizes)):
        own = document == d
        scores = dict((y, s) for s, y in every_labelling(field.scores(features[own]), field.pair))
        want += np.logaddexp.reduce(list(scores.values())) - scores[tuple(labels[own])]
    assert np.isclose(value, want / len(document))
    for k in range(len(weights)):
        step = np.zeros(len(weights))
        step[k] = 1e-6
        ends = [linecrf.likelihood(weights + s * step, features, document, labels)[0] for s in (1, -1)]
        assert np.isclose(slope[k], (ends[0] - ends[1]) / 2e-6, atol=1e-6)


def noisy(text):
    return "\n".join(f"{line}### ".replace(" ", "%%% ") for line in text.split("\n"))


def sentences(seed, lines):
    rng = random.Random(seed)
    return "\n".join(" ".join(prose(rng.random(), rng.randint(12, 30)).split()) + "." for _ in range(lines))


def test_rules_learn_from_documents_and_hold_on_others(spark):
    """Fitted on a third, right on nearly all others; a page is kept as long as most of it is content."""
    texts = [(i, sentences(i, 1 + i % 6) if i % 3 else noisy(sentences(i, 1 + i % 6))) for i in range(240)]
    docs = spark.createDataFrame(rows_for(texts), COLUMNS)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(80)] + [(7, None, 0), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    field = linecrf.learn(docs, labels)
    rows = {r["doc_id"]: r for r in linecrf.report(docs, field).collect()}
    right = [rows[i]["kept"] == (i % 3 > 0 and not rows[i]["base_failed"]) for i in range(80, 240)]
    assert sum(right) >= 156
    mostly = sentences(1, 6) + "\n" + noisy(sentences(2, 1))
    hardly = sentences(3, 1) + "\n" + noisy(sentences(4, 6))
    mixed = linecrf.report(spark.createDataFrame(rows_for([(1, mostly), (2, hardly)]), COLUMNS), field).collect()
    assert {r["doc_id"]: r["kept"] for r in mixed} == {1: True, 2: False}


def test_without_labels_of_both_kinds_no_field_is_fitted(spark, documents):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    assert linecrf.learn(documents, labels) is None
    assert linecrf.learn(documents, labels.where("false")) is None
