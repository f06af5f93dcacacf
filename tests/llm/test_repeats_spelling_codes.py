from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sunloom.llm import repeats, spelling, vector_codes
from tests.llm import brute

ODD = brute.ODD_TEXTS


def _kept(frame):
    rows = frame.select("doc_id", "n_words", "n_removed", "kept_text").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def _plain_repeats(docs, window=13):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    return sorted(brute.repeats(rows, window), key=repr)


# --- passages that repeat


@pytest.mark.parametrize("chunk_bytes", [1, 3000, 1 << 20])
def test_repeats_are_as_brute_force(spark, chunk_bytes):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(40)]
    passage = [" ".join(rng.choices(words, k=n)) for n in (12, 13, 14, 40, 200)]
    texts = list(ODD)
    for k in range(60):
        parts = [" ".join(rng.choices(words, k=rng.randrange(30)))]
        for p in rng.sample(passage, rng.randrange(3)):
            parts += [p, " ".join(rng.choices(words, k=rng.randrange(4)))]
        texts.append("\n".join(parts))
    docs = brute.documents(spark, texts).unionByName(brute.odd_documents(spark)).repartition(5)
    assert _kept(repeats.remove_repeats(docs, chunk_bytes=chunk_bytes, range_words=100)) == _plain_repeats(docs)


def test_runs_and_periods_repeat(spark):
    texts = ["a " * n + tail for n in (11, 12, 13, 14, 30) for tail in ("", "b", "b c d", "b a " * 9)]
    texts += ["x y " * n for n in (5, 6, 7, 20)] + ["z " + "x y " * 8, "a " * 12 + "b", "c " + "a " * 12 + "b"]
    docs = brute.documents(spark, texts)
    assert _kept(repeats.remove_repeats(docs)) == _plain_repeats(docs)


def test_repeats_of_the_same_id_and_of_none_stay(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(5, text), (5, text), (None, text), (None, "x " + text), (2, "short"), (9, text + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _kept(repeats.remove_repeats(docs)) == _plain_repeats(docs)
    found = {(r.doc_id, r.n_removed) for r in repeats.remove_repeats(docs).collect()}
    assert found == {(5, 0), (None, 30), (2, 0), (9, 30)}


def test_repeats_of_an_empty_table(spark):
    assert _kept(repeats.remove_repeats(brute.empty_documents(spark))) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=13, max_size=40), st.lists(st.integers(0, 3), max_size=6), st.lists(st.integers(0, 3), max_size=6))
def test_symbols_of_a_passage_do_not_depend_on_what_surrounds_it(passage, before, after):
    names = np.random.default_rng(1).integers(0, 1 << 63, 4).astype(np.uint64)

    def inside(words, a, b):
        first = np.zeros(len(words), dtype=bool)
        first[0] = True
        name, at, since, until = repeats.symbols(names[np.array(words)], first)
        held = (since >= a) & (until <= b)
        return list(zip(name[held], at[held] - a, since[held] - a, until[held] - a))

    here = inside(before + passage + after, len(before), len(before) + len(passage))
    there = inside([3, *passage, 2], 1, 1 + len(passage))
    if before and after:
        assert here == there
    # At a document's end symbols lack their context; what is left stands elsewhere too.
    assert set(here) <= set(there)


# --- spelling


def test_spelling_is_as_brute_force(spark):
    rng = random.Random(5)
    texts = list(ODD)
    stems = ["kanal", "banal", "kanale", "resumé", "résumé", "strasse", "aaaaa", "aaaaaa", "aaaaab", "abcdefghijkl"]
    for _ in range(150):
        line = []
        for word in rng.choices(stems, k=12):
            if rng.random() < 0.4:
                at = rng.randrange(len(word) + 1)
                cut = rng.randrange(2)
                word = word[:at] + rng.choice(["", "x", "É", "é", "n"]) + word[at + cut :]
            line.append(word if rng.random() < 0.7 else word.upper())
        texts.append(" ".join(line))
    docs = brute.documents(spark, texts).unionByName(brute.odd_documents(spark))
    expected = brute.spelling([tuple(r) for r in docs.select("doc_id", "text").collect()])
    found = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.variants(docs).collect()}
    assert found == expected and sum(v[1] for v in found.values()) > 100


def test_spelling_of_an_empty_table(spark):
    assert spelling.variants(brute.empty_documents(spark)).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text("ab", min_size=5, max_size=9), st.integers(0, 8), st.sampled_from("abc"), st.integers(0, 2), st.integers(0, 3))
def test_words_one_edit_apart_share_a_list(word, at, letter, kind, seed):
    at = min(at, len(word) - 1)
    other = word[:at] + ("", letter, letter)[kind] + word[at + (1, 1, 0)[kind] :]
    if len(other) < spelling.LEAST_LENGTH or other == word:
        return
    # Any set of frequent grams will do.
    codes, _ = spelling.padded_matrix([word, other, "abababab", "aaaabbbb"])
    grams = np.unique(np.concatenate([n.ravel() for _, n in spelling._gram_names(codes)]))
    rng = np.random.default_rng(seed)
    frequent = np.sort(rng.choice(grams, len(grams) // 2, replace=False))
    taken = spelling.Grams([word, other], frequent, rng.integers(16, 20, len(frequent)))
    assert (taken.taken.sum(axis=1) > taken.affected()).all()
    row, key = taken.merged()
    assert set(key[row == 0]) & set(key[row == 1])


# --- vector codes


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 9), st.integers(1, 16), st.sampled_from([2, 7, 90, 20_000]), st.integers(0, 999))
def test_search_finds_the_nearest_entry(dim, entries, scale, seed):
    rng = np.random.default_rng(seed)
    book, parts = rng.integers(-scale, scale, (entries, dim)), rng.integers(-scale, scale, (40, dim))
    index, distance = vector_codes.nearest(parts, book)
    plain = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    assert (index == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()


def _vectors(spark, rows):
    table = [(k, v, n % 3 if n % 4 else None, 1.0, "x") for n, (k, v) in enumerate(rows)]
    return spark.createDataFrame(table, "vec_id long, embedding array<float>, label int, error double, code string")


@pytest.mark.parametrize("n", [0, 1, 9, 120])
def test_codes_are_as_brute_force(spark, n):
    rng = np.random.default_rng(n)
    rows = [(int(k), [float(x) for x in rng.normal(0, 0.2, 16).astype(np.float32)]) for k in rng.permutation(n)]
    if n > 9:
        rows += rows[:20] + [(500 + k, rows[k][1]) for k in range(10)] + [(None, rows[3][1])]
        bad = [None, float("nan"), float("inf"), float("-inf")]
        rows += [(600 + k, rows[0][1][:5] + [x] + rows[0][1][6:]) for k, x in enumerate(bad)]
        rows += [(700, None), (701, []), (-1, [-0.0, -1e-7] * 8), (702, [0.25] * 16)]
    expected, books = brute.vector_codes([(k, v) for k, v in rows])
    coded, found = vector_codes.compress(_vectors(spark, rows))
    coded = coded.collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, bytes(r.code), r.error) for r in coded) == sorted(
        (k is None, k or 0, c, e) for k, c, e in expected
    )
    assert (found is None and not books) or found.tolist() == books
    sums: dict = {}
    for r in coded:
        sums[r.label] = sums.get(r.label, 0) + r.error
    assert all(r.label_error == sums[r.label] for r in coded)


def test_vectors_of_another_length_are_left_out(spark):
    rows = [(1, [0.5] * 8), (2, [0.25] * 16), (3, [0.75] * 8)]
    coded, books = vector_codes.compress(_vectors(spark, rows))
    assert {r.vec_id for r in coded.collect()} == {1, 3} and books.shape == (8, 2, 1)


def test_components_beyond_the_range_are_an_error(spark):
    with pytest.raises(Exception, match="a component is"):
        vector_codes.compress(_vectors(spark, [(1, [1e6] * 16)]))


def test_lists_of_words_are_not_broadcast(spark):
    words = spark.range(2).selectExpr("IF(id = 0, 'harbour', 'harbor') AS word", "9 - 6 * id AS n")
    near = spelling.near_words(words)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    assert [tuple(r) for r in near.collect()] == [("harbor", "harbour", 3, 9)]
