"""Manifest, whitening and language identification against plain versions, on awkward input."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsdesk.llm import language_id, merkle, whitening
from newsdesk.llm import textbatch as tb
from tests.llm import brute

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"
EXTRA = ("tree", "pos", "total", "digest", "block", "root", "x", "w", "score", "at", "n", "part")


def manifest_rows(frame):
    got = merkle.verified(merkle.tampered(frame)).collect()
    assert all(r.verified == (r.folded_root == r.root) for r in got)
    return sorted((tuple(r)[:6] for r in got), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    langs = ["en"] * 600 + ["fr"] * 64 + ["de"] * 65 + ["é"] * 9 + [None] * 8 + ["x", ""]
    out = [(i * 7, rng.choice(["a", None, "b"]), lang, rng.choice([None, 5, 70]), rng.choice([None, "", "Text É", "plain", "A" * 50])) for i, lang in enumerate(langs)]
    return out + [(3, "a", "fr", 1, "Long WORDS " * 60_000), (None, None, "fr", None, "No Id"), (None, None, None, None, None), out[5], out[5], (out[6][0], "other", "en", 1, "same id")]


def test_manifest(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in EXTRA}).repartition(7)
    assert manifest_rows(frame) == sorted(brute.manifest(rows), key=str)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 513])
def test_manifest_sizes(spark, n):
    rows = [(i, None, "en", 1, f"T{i}") for i in range(n)]
    assert manifest_rows(spark.createDataFrame(rows, SCHEMA)) == sorted(brute.manifest(rows), key=str)


def test_manifest_of_many_languages(spark):
    """The tree of the languages grows over several layers of blocks as well."""
    rows = [(i, None, f"l{i % 700}", 1, "t") for i in range(1000)]
    assert manifest_rows(spark.createDataFrame(rows, SCHEMA)) == sorted(brute.manifest(rows), key=str)


def test_manifest_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.verified(merkle.tampered(empty)).collect() == [] and merkle.manifest(empty).count() == 0


def test_manifest_witnesses(spark):
    """The witness itself leads from the leaf to the root, and from another leaf elsewhere."""
    docs = spark.createDataFrame([(i, None, "en", 1, f"T{i}") for i in range(100)], SCHEMA)
    got = merkle.manifest(docs).collect()
    for r in got:
        path = list(zip(map(bytes, r.befores), map(bytes, r.afters)))
        assert merkle.folded(bytes(r.leaf), path) == bytes(r.root) != merkle.folded(b"0" * 32, path)


@given(st.integers(1, 64))
@settings(max_examples=30, deadline=None)
def test_appended_witnesses(n):
    """Every leaf's witness covers all other leaves of an aligned block."""
    leaves = [merkle.hashed(bytes([i])) for i in range(n)]
    tree = merkle.Subtrees()
    for leaf in leaves:
        tree.append(leaf)
    root = tree.finish(merkle.levels_of(n))
    spans = [x for e in tree.extensions for x in e[:2]]
    for leaf, path in zip(leaves, merkle.witnesses(spans, [e[2] for e in tree.extensions], [e[3] for e in tree.extensions], n, [])):
        assert merkle.folded(leaf, path) == root


@given(st.integers(1, 200), st.integers(1, 5), st.integers(0, 30), st.integers(0, 2**32))
@settings(max_examples=60, deadline=None)
def test_scatter_is_exact(n, dims, bits, seed):
    x = np.random.default_rng(seed).integers(-(1 << bits), (1 << bits) + 1, (n, dims))
    products, sums = whitening.scatter(x)
    plain = x.astype(object)
    assert (products == plain.T.dot(plain)).all() and (sums == plain.sum(axis=0)).all()


def whitened_rows(frame):
    return {(r.vec_id, r.component): r for r in whitening.whiten(frame).collect()}


def test_whitening(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(300, 6)) * [3, 2, 1, 0.5, 0.2, 0.1] @ rng.normal(size=(6, 6))
    good = [(i, v.tolist()) for i, v in enumerate(base)] + [(1000 + i, base[0].tolist()) for i in range(200)] + [(5, base[7].tolist())]
    bad = [(2000, None), (2001, [None] + [1.0] * 5), (2002, [float("nan")] + [1.0] * 5), (2003, [float("inf")] + [1.0] * 5), (2004, [-float("inf")] * 6), (2005, []), (2006, [1.0]), (2007, [1e300] * 6)]
    frame = spark.createDataFrame(good + bad, "vec_id bigint, embedding array<double>").withColumns({c: F.lit(c) for c in EXTRA}).repartition(5)
    rows = whitening.whiten(frame).collect()
    assert len(rows) == 4 * len(good) and {r.vec_id for r in rows} == {i for i, _ in good}
    x = np.floor(256 * np.array([v for _, v in good])).astype(np.int64)
    fit = np.unique(x, axis=0)
    n = len(fit)
    centred = fit - fit.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    top = values[::-1][:4]
    want = (x - fit.mean(axis=0)) @ vectors[:, ::-1][:, :4] / np.sqrt(top)
    by_id = {}
    for r in rows:
        by_id.setdefault((r.vec_id, r.component), []).append(r)
    signs = [np.sign(by_id[0, c][0].whitened * want[0, c - 1]) for c in (1, 2, 3, 4)]
    for (i, _), row, w in zip(good, x, want):
        for c in (1, 2, 3, 4):
            found = by_id[i, c]
            assert any(r.whitened == pytest.approx(signs[c - 1] * w[c - 1], abs=1e-9) for r in found)
            assert all(r.n == n and r.explained == pytest.approx(top[c - 1] / values.sum(), rel=1e-9) and r.identity_error < 1e-9 for r in found)
            deviation = sum(int(v) ** 2 for v in n * row - fit.sum(axis=0))
            assert any(r.deviation == deviation for r in found)


def test_whitening_without_components(spark):
    for rows in ([], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])], [(1, None)]):
        assert whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect() == []


def test_whitening_of_low_rank(spark):
    """Components without variance do not exist; one-dimensional vectors have one."""
    rows = [(i, [float(i), float(2 * i)]) for i in range(20)] + [(None, [1.0, 2.0])]
    got = whitened_rows(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    assert {c for _, c in got} == {1} and (None, 1) in got and got[0, 1].explained == pytest.approx(1)


def test_whitening_of_large_integers(spark):
    """Deviations beyond a long are NULL; the rest stays exact."""
    rows = [(i, [float(v) for v in ((-1) ** i * 2**50 + i, i)]) for i in range(8)]
    got = whitened_rows(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    assert got[0, 1].deviation is None and got[0, 1].identity_error < 1e-4


def sign_vector(trigram):
    """The vector of one trigram, letter by letter."""
    letters = [language_id.letter_vectors(np.array([ord(c) if c else 0]))[0] for c in trigram]
    bits = np.roll(letters[0], 2) ^ np.roll(letters[1], 1) ^ letters[2]
    return 1.0 - 2.0 * bits


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(4)
    sounds = {"aa": "kalamu", "bb": "strenç", "cc": "жабвуш"}
    word = lambda lang: "".join(rng.choice(sounds[lang]) for _ in range(rng.randint(1, 7)))
    out = [(i, lang, " ".join(word(lang) for _ in range(rng.randint(1, 40)))) for i, lang in enumerate(rng.choice(list(sounds)) for _ in range(150))]
    odd = [None, "", " 12 34 !", "\0\1\0", "İstanbul ΣΑΣ", "a", "a\1b\1", "日本語 テキスト", "x" * 30]
    return out + [(1000 + i, None if i % 2 else "aa", t) for i, t in enumerate(odd)]


def test_languages(spark, spoken):
    frame = spark.createDataFrame(spoken, "doc_id bigint, lang string, text string").withColumns({c: F.lit(c) for c in EXTRA}).repartition(4)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(frame, *language_id.learn(frame)).collect()}
    want = brute.language(spoken, sign_vector)
    assert set(got) == set(want)
    for d, (lang, score) in want.items():
        assert got[d][0] == lang and got[d][1] == pytest.approx(max(score, 0), abs=1e-5)
    held = [(got[d][0], lang) for d, lang, _ in spoken[:150] if brute.fold(d, 4) == 2]
    assert np.mean([p == lang for p, lang in held]) > 0.95


def test_pieces_lose_no_trigram(monkeypatch):
    rng = random.Random(9)
    text = " ".join("".join(rng.choice("abcdef") for _ in range(rng.choice([1, 3, 90]))) for _ in range(40))
    whole = language_id.bundles([text, "other", None, ""])
    monkeypatch.setattr(language_id, "PIECE", 50)
    monkeypatch.setattr(language_id, "SLICE_TRIGRAMS", 7)
    assert (language_id.bundles([text, "other", None, ""]) == whole).all() and not whole[2:].any()
    assert sum(brute.trigrams(text).values()) == sum(brute.trigrams(w)[t] for w in text.split() for t in brute.trigrams(w))


def test_languages_ties_nulls_and_nothing_learned(spark):
    schema = "doc_id bigint, lang string, text string"
    ids = [i for i in range(50) if brute.fold(i, 4) != 2]
    held = next(i for i in range(50) if brute.fold(i, 4) == 2)
    frame = spark.createDataFrame([(ids[0], "bb", "same text"), (ids[1], "aa", "same text"), (None, None, "same text"), (held, "zz", "same text"), (held, "zz", "same text")], schema)
    got = language_id.identify(frame, *language_id.learn(frame)).collect()
    assert len(got) == 5 and {r.lang_pred for r in got} == {"aa"} and {r.doc_id for r in got} == {ids[0], ids[1], None, held}
    for rows in ([], [(ids[0], None, "text")], [(held, "aa", "text")], [(ids[0], "aa", "12")]):
        frame = spark.createDataFrame(rows, schema)
        assert all((r.lang_pred, r.score) == ("und", 0) for r in language_id.identify(frame, *language_id.learn(frame)).collect())


def test_language_names_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 3)
    frame = spark.createDataFrame([(i, f"l{i}", "text") for i in range(20)], "doc_id bigint, lang string, text string")
    with pytest.raises(ValueError):
        language_id.learn(frame)


def test_letter_vectors_are_balanced():
    bits = language_id.letter_vectors(np.arange(200))
    assert abs(bits.mean() - 0.5) < 0.01 and len({b.tobytes() for b in bits}) == 200
    assert tb.mix(np.zeros(1, np.uint64)).shape == (1,)
