"""Periodic runs against their definition, and the digest of the query."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm.runs import _last_not_larger, common_prefixes, digest, runs_of, suffix_array, with_repeats, word_runs


def plain_runs(codes, least=6, exponent=4):
    """Maximal stretches for each period; of one stretch the smallest period."""
    found = {}
    for q in range(1, len(codes) // exponent + 1):
        x = 0
        while x + q < len(codes):
            start = x
            while x + q < len(codes) and codes[x] == codes[x + q]:
                x += 1
            if x > start and x + q - start >= max(least, exponent * q):
                found.setdefault((start, x + q - start), q)
            x += 1
    return sorted((s, n, q) for (s, n), q in found.items())


LETTERS = st.lists(st.integers(0, 2), max_size=12)


@settings(max_examples=150, deadline=None)
@given(LETTERS, st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 11), LETTERS)
def test_runs_are_those_of_the_definition(head, unit, times, tail):
    codes = head + unit * times + tail
    for least, exponent in ((6, 4), (2, 2)):
        got = [tuple(r) for r in runs_of(np.array(codes, dtype=np.int64), least, exponent).tolist()]
        assert sorted(got) == plain_runs(codes, least, exponent)


def test_arrays_against_sorted_suffixes():
    rng = np.random.default_rng(3)
    codes = np.concatenate((rng.integers(0, 3, 400), np.arange(90) % 2)).astype(np.int64)
    order, place = suffix_array(codes)
    plain = sorted(range(len(codes)), key=lambda i: codes[i:].tolist())
    assert order.tolist() == plain and order[place].tolist() == list(range(len(codes)))
    shared = common_prefixes(codes, order)
    for r in range(1, len(codes)):
        a, b = codes[plain[r - 1] :].tolist(), codes[plain[r] :].tolist()
        n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert shared[r] == n


def test_nearest_not_larger_over_many_blocks():
    values = np.concatenate(([-1], np.arange(5000) + 10, np.full(900, 3), np.arange(700)[::-1])).astype(np.int64)
    wanted = np.arange(1, len(values))
    stack, expected = [0], []
    for i in wanted:
        while values[stack[-1]] > values[i]:
            stack.pop()
        expected.append(stack[-1])
        stack.append(int(i))
    assert _last_not_larger(values, wanted).tolist() == expected


@pytest.mark.parametrize("period", [1, 7])
def test_a_very_long_run_takes_time_in_proportion(period):
    assert runs_of(np.arange(200_000, dtype=np.int64) % period).tolist() == [[0, 200_000, period]]


def test_rows_of_documents(spark):
    rows = [
        (1, "a b a b a b a b c", "x"), (1, "a b a b a b a b c", "x"), (None, "q q q q q q", "x"), (2, None, None), (3, " \t\n", "x"),
        (4, "A a A a A a", "x"), (5, "d " * 3 + "e " * 6 + "d " * 6, "x"), (6, "é é é é " * 3, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    found = {(r.doc_id, r.collapsed): [tuple(x) for x in r.runs] for r in word_runs(docs).collect()}
    assert found == {
        (1, "a b c"): [(0, 8, 2)], (None, "q"): [(0, 6, 1)], (2, ""): [], (3, ""): [], (4, "A a A a A a"): [],
        (5, "d d d e d"): [(3, 6, 1), (9, 6, 1)], (6, "é é"): [(0, 6, 1)],
    }
    assert word_runs(docs).count() == 8
    assert word_runs(docs.limit(0)).count() == 0
    shown = {r.doc_id: r for r in digest(word_runs(docs)).collect()}
    assert (shown[5].n_runs, shown[5].start, shown[5].length, shown[5].period, shown[5].exponent_milli) == (2, 3, 6, 1, 6000)
    assert (shown[2].n_runs, shown[2].start, shown[2].exponent_milli) == (0, None, None)
    assert shown[2].runs_sha256 == shown[2].collapsed_sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_a_long_text_in_one_row(spark):
    docs = spark.createDataFrame([(1, "lorem ipsum dolor " * 100_000 + "sit")], "doc_id long, text string")
    row = word_runs(docs).first()
    assert [tuple(r) for r in row.runs] == [(0, 300_000, 3)] and row.collapsed == "lorem ipsum dolor sit"


def test_tails_that_repeat(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 10 == 0]
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(i, text) for i in range(60)] + [(None, text), (ids[0], None), (ids[0], " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for row in with_repeats(docs).collect():
        if row.doc_id not in ids or row.text is None or row.text == " ":
            assert row.text in (None, " ", text)
            continue
        g = zlib.crc32(str(row.doc_id).encode()) // 10
        a, words = g % 50, text.split()
        p = 1 + (50 - a) // (3 + g % 8)
        assert row.text.split() == [words[i] if i < a else words[a + (i - a) % p] for i in range(50)]
