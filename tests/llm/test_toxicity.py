import random

import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm import toxicity
from tillroll.llm.words import SPACES, SYMBOLS, Words

LABELLED = "doc_id long, text string, score string"


def corpus(n=1500, seed=2):
    dice = random.Random(seed)
    plain = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "tu") for b in ("bar", "den", "fel", "gor", "hin", "jas")]
    rows, labels = [], []
    for i in range(n):
        words = [dice.choice(plain) for _ in range(dice.randint(5, 60))]
        toxic = i % 6 == 0
        if toxic:
            words[dice.randrange(len(words))] = dice.choice(["zork", "Vexx!", f"blurg{dice.choice(plain)}"])
        rows.append((i, " ".join(words), "clash"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_documents_and_new_forms_are_told_apart(spark):
    rows, labels = corpus()
    docs, marks = spark.createDataFrame(rows, LABELLED), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, marks).collect()}
    held = [i for i, _ in labels if got[i].held_out]
    assert 200 < len(held) < 550
    wrong = [i for i in held if got[i].predicted != labels[i][1]]
    assert len(wrong) <= 0.02 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    kept = toxicity.accepted(docs, marks)
    assert kept.columns == docs.columns and kept.count() == sum(not r.predicted for r in got.values())


def test_nulls_repeats_and_long_texts(spark):
    rows, labels = corpus(600)
    rows += [(None, "zork", ""), (None, None, ""), (7, "", ""), (8, "kabar " * 30_000 + "zork", ""), (10_009, "ZORK zork", "")]
    marks = [*labels, (None, 1), (1, None), (0, 0), (0, 1)]
    found = toxicity.toxicity(spark.createDataFrame(rows, LABELLED), spark.createDataFrame(marks, "doc_id long, toxic int")).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert not any(r.held_out for r in found if r.doc_id is None)
    assert next(r for r in found if r.doc_id == 10_009).score > 0.3


@pytest.mark.parametrize("marks", [[], [(1, 0), (2, 0)], [(1, 1)]])
def test_without_labels_of_both_kinds_scores_are_constant(spark, marks):
    docs = spark.createDataFrame([(1, "a b", ""), (2, None, "")], LABELLED)
    found = toxicity.toxicity(docs, spark.createDataFrame(marks, "doc_id long, toxic int")).collect()
    assert len({r.score for r in found}) == 1


def test_empty_documents(spark):
    docs = spark.createDataFrame([], LABELLED)
    assert toxicity.toxicity(docs, spark.createDataFrame([(1, 1)], "doc_id long, toxic int")).count() == 0


def sparse(x):
    first = np.concatenate(([0], np.cumsum((x > 0).sum(1))))
    return toxicity.Terms(first, np.nonzero(x)[1].astype(np.int32), x[x > 0].astype(np.uint8))


def test_pairs_can_outweigh_single_terms():
    """Two terms that are harmless alone: no additive weights can tell their meeting from either."""
    dice = np.random.default_rng(0)
    x = dice.integers(0, 2, (3000, 2)).astype(np.uint8)
    y = (x[:, 0] & x[:, 1]).astype(np.float32)
    x = np.concatenate((x, dice.integers(0, 2, (3000, 3)).astype(np.uint8)), axis=1)
    start = dice.normal(0, 0.05, (5, 4)).astype(np.float32)
    machine = toxicity.Machine(np.zeros(1), -1.0, np.zeros(5, np.float32), start)
    toxicity._descend(machine, sparse(x), y, np.arange(3000), 600, 256, 0.02, (0.0, 0.0), dice)
    assert ((machine.scores(sparse(x)) > 0.5) == y).mean() > 0.99


def paired(n, seed):
    """An insult hurts only beside a group mention and another only without it: the mention is neutral alone."""
    dice = random.Random(seed)
    plain = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "tu") for b in ("bar", "den", "fel", "gor", "hin", "jas")]
    for i in range(n):
        words = [dice.choice(plain) for _ in range(20)]
        one, other, group = dice.random() < 0.25, dice.random() < 0.25, dice.random() < 0.5
        for word in ["zork"] * one + ["blug"] * other + ["quari"] * group:
            words.insert(dice.randrange(len(words)), word)
        yield i, " ".join(words), int((one and group) or (other and not group)), group


def test_a_group_word_that_is_neutral_alone_tells_beside_an_insult(spark):
    train, unseen = list(paired(2000, 3)), list(paired(500, 9))
    share = [np.mean([y for *_, y, g in train if g == group]) for group in (True, False)]
    assert abs(share[0] - share[1]) < 0.05
    machine = toxicity.fit(spark.createDataFrame([(t, y) for _, t, y, _ in train], "text string, toxic int"))
    docs = spark.createDataFrame([(i, t) for i, t, *_ in unseen], "doc_id long, text string")
    found = {r.doc_id: r.score > 0.5 for r in toxicity.score(docs, machine).collect()}
    assert np.mean([found[i] == bool(y) for i, _, y, _ in unseen]) > 0.97


def test_sparse_rows_equal_plain_counts(spark):
    """Distinct words by bucket, a word and its beginnings, against sets."""
    texts = ["abcdefghij abcde abcdx ab", "", None, "ab AB ab cd", "x " * 400 + " ".join(f"sameroot{i}" for i in range(400))]
    for i, text in enumerate(texts):
        docs, words, buckets = toxicity.term_buckets(Words(pa.array(texts), SYMBOLS))
        _, b, n = toxicity._counted(docs[docs == i], words[docs == i], buckets[docs == i])
        plain = {}
        for word in set((text or "").lower().split()):
            for term in {(word, True)} | {(word[:k], False, k) for k in toxicity.BEGINNINGS if len(word) > k}:
                plain[term] = plain.get(term, 0) + 1
        assert sorted(n) == sorted(min(v, 255) for v in plain.values()) and len(b) == len(set(b))


def test_machine_equals_the_sum_over_pairs():
    dice = np.random.default_rng(1)
    w, v, c = dice.normal(size=6), dice.normal(size=(6, 3)), dice.integers(0, 3, (5, 6))
    machine = toxicity.Machine(np.zeros(1), 0.3, w, v)
    for row, got in zip(np.where(c, toxicity.VALUES[c], 0), machine.scores(sparse(c)), strict=True):
        z = 0.3 + row @ w + sum(v[i] @ v[j] * row[i] * row[j] for i in range(6) for j in range(i))
        assert got == pytest.approx(1 / (1 + np.exp(-z)))


def test_terms_keep_their_documents_when_slots_leave():
    x = np.random.default_rng(2).integers(0, 3, (30, 8)).astype(float)
    keep = np.array([1, 0, 1, 1, 0, 0, 1, 1], dtype=bool)
    left, plain = sparse(x), sparse(x[:, keep])
    left.restrict(keep)
    at = np.array([4, 0, 29, 4])
    for got, want in ((left, plain), (left.of(at), sparse(x[at][:, keep]))):
        assert all((a == b).all() for a, b in ((got.first, want.first), (got.slot, want.slot), (got.count, want.count)))
    assert (left.sums(left.count.astype(int)) == x[:, keep].sum(1)).all()


@pytest.mark.parametrize("separators", [SPACES, SYMBOLS])
def test_words_are_those_of_a_plain_split(separators):
    texts = ["Ab  cD\té-f", None, "", " ", "x", "a\n\nB", "ß ÀÉ a", "a b", "\x00 q"]
    words = Words(pa.array(texts), separators)
    for i, t in enumerate(texts):
        plain = bytes(32 if separators[b] else b for b in (t or "").encode().lower()).split(b" ")
        at = words.of(i)
        assert [words.data[a:b].tobytes() for a, b in zip(words.start[at], words.end[at], strict=True)] == [p for p in plain if p]
    a, b = Words(pa.array(["one two one"]), SPACES), Words(pa.array(["zz TWO"]), SPACES)
    h = a.hashes()
    assert h[0] == h[2] != h[1] == b.hashes()[1]


def test_a_term_counts_alike_in_training_and_scoring_however_often_it_stands(spark):
    """Three hundred occurrences are more than a byte holds."""
    bad, good = "grobzig " * 300, "freundlich " * 300
    rows = [(bad, 1)] * 40 + [(good, 0)] * 120
    machine = toxicity.fit(spark.createDataFrame(rows, "text string, toxic int"))
    docs = spark.createDataFrame([(1, bad), (2, good), (3, "grobzig " * 256)], "doc_id long, text string")
    found = {r.doc_id: r.predicted for r in toxicity.score(docs, machine).collect()}
    assert found == {1: 1, 2: 0, 3: 1}
