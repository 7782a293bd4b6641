import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm import suffix_dedup


def brute(texts, least=50):
    """Word positions of each document in windows that another document has too."""
    words = {k: (t or "").encode().lower().split() for k, t in texts.items()}
    seen = defaultdict(set)
    for k, w in words.items():
        for i in range(len(w) - least + 1):
            seen[tuple(w[i : i + least])].add(k)
    out = {}
    for k, w in words.items():
        hit = set()
        for i in range(len(w) - least + 1):
            if len(seen[tuple(w[i : i + least])]) > 1:
                hit.update(range(i, i + least))
        if hit:
            out[k] = hit
    return out


def places(spans):
    return {p for s in spans.split(",") for p in range(*map(int, s.split(":")))}


def found(spark, texts, parts=3):
    docs = spark.createDataFrame([(k, t, "clash") for k, t in texts.items()], "doc_id long, text string, pos string")
    return {r.doc_id: r for r in suffix_dedup.repeats(docs.repartition(parts)).collect()}


def passages(seed):
    dice = random.Random(seed)

    def words(n):
        return [f"w{dice.randrange(100_000)}" for _ in range(n)]

    shared = [words(n) for n in (49, 50, 51, 60, 130, 400)]
    short = words(20)
    texts = {}
    for i in range(120):
        body = words(dice.randint(0, 90))
        for p in dice.sample(shared, dice.choice([0, 0, 1, 2])):
            body += [*p, *words(dice.randint(1, 60))]
        texts[i] = " ".join([*body, *(short if i % 3 == 0 else []), *words(30)])
    texts |= {200: texts[0], 201: texts[0].upper(), 202: None, 203: "", 204: "few words"}
    texts[205] = " ".join([*shared[3], "x", *shared[3]])
    texts[206] = " ".join(["a"] * 300)
    texts[207] = " ".join(["a"] * 70)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_spans_equal_brute_force(spark, seed):
    texts = passages(seed)
    got = {k: places(r.spans) for k, r in found(spark, texts).items()}
    expected = brute(texts)
    assert set(got) == set(expected)
    assert {k: v for k, v in got.items() if v != expected[k]} == {}


def test_nested_repeats_are_found_from_either_side(spark):
    dice = random.Random(7)
    a, b, c = ([f"{n}{i}" for i in range(k)] for n, k in (("a", 30), ("b", 40), ("c", 30)))
    pad = lambda: [f"p{dice.randrange(10**6)}" for _ in range(40)]
    texts = {i: " ".join([*pad(), *x, *pad()]) for i, x in enumerate([a + b, a + b, b + c, b + c, b, a + b + c])}
    got = {k: places(r.spans) for k, r in found(spark, texts).items()}
    assert got == brute(texts)


def test_a_common_line_in_very_many_documents(spark):
    """Short lines that thousands share are no passage, and a passage that thousands share is one for each."""
    line, passage = " ".join(f"l{i}" for i in range(30)), " ".join(f"q{i}" for i in range(55))
    texts = {i: f"{line} u{i} " + " ".join(f"u{i}x{j}" for j in range(30)) + (f" {passage} v{i}" if i % 2 else "") for i in range(3000)}
    got = found(spark, texts, 8)
    assert set(got) == {i for i in texts if i % 2} and all(r.n_repeated == 55 for r in got.values())
    assert sum(r.n_removable > 0 for r in got.values()) >= 1000 and got[1].n_removable == 0


def test_repeated_rows_null_ids_and_repeats_within_a_document(spark):
    text = " ".join(f"t{i}" for i in range(60))
    rows = [(1, text), (1, text), (2, f"{text} {text}"), (None, text), (3, f"{'z ' * 200}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.repeats(docs).collect()}
    assert set(got) == {1, 2, None} and got[1].spans == "0:60" and places(got[2].spans) == set(range(120))
    assert got[1].partners in ([2], []) and got[2].n_repeated == 120


def test_empty_table(spark):
    assert suffix_dedup.repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_every_window_holds_a_minimiser():
    grams = np.random.default_rng(0).integers(0, 50, 2000).astype(np.uint64)
    at = set(suffix_dedup.minimisers(grams, 9).tolist())
    assert all(at & set(range(i, i + 9)) for i in range(2000 - 8))


def test_of_copies_all_but_the_first_are_removable(spark):
    """Exact copies, and a passage in different surroundings, in more documents than a batch has rows."""
    text, passage = " ".join(f"t{i}" for i in range(90)), " ".join(f"q{i}" for i in range(55))
    texts = {i: text for i in range(700)} | {1000 + i: f"u{i} {passage} v{i * 7 % 701}" for i in range(700)}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = found(spark, texts, 8)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {k: r.n_removable for k, r in got.items() if r.n_removable != r.n_repeated} == {0: 0, 1000: 0}
    assert len(got) == 1400 and all(r.n_repeated == (90 if k < 1000 else 55) for k, r in got.items())


def test_a_passage_whose_partners_are_no_neighbours_in_either_order(spark):
    """Two documents share 50 words around a common phrase, which is their only minimiser; other documents match either of them farther
    to the right or farther to the left, but in fewer than 50 words."""
    phrases = [" ".join(f"c{n}x{i}" for i in range(8)) for n in range(4000)]
    words = suffix_dedup.Words(pa.array(phrases), suffix_dedup.SPACES)
    phrase = phrases[int(suffix_dedup.gram_hashes(words.hashes(), 8)[::8].argmin())]
    left, right = " ".join(f"l{i}" for i in range(22)), " ".join(f"r{i}" for i in range(20))
    own = lambda name, n: " ".join(f"{name}_{j}" for j in range(n))
    texts = {}
    for i in range(2):
        texts[i] = f"x{i} {left} {phrase} {right} y{i}"
        for k in range(3):
            texts[100 + 10 * i + k] = f"{own(f'a{i}{k}', 50)} {phrase} {right} y{i} {own(f'b{i}{k}', 9)}"
            texts[200 + 10 * i + k] = f"{own(f'd{i}{k}', 9)} x{i} {left} {phrase} {own(f'e{i}{k}', 50)}"
    got = found(spark, texts)
    assert {k: places(r.spans) for k, r in got.items()} == brute(texts) == {i: set(range(1, 51)) for i in range(2)}
    assert {k: (r.n_removable, r.partners) for k, r in got.items()} == {0: (0, [1]), 1: (50, [0])}


def test_a_phrase_in_more_documents_than_a_batch_has_rows(spark):
    """Passages that end in a common phrase, whose holders lie far apart in the order of what follows."""
    many = " ".join(f"m{i}" for i in range(12))
    own = lambda name, n: " ".join(f"{name}_{j}" for j in range(n))
    texts = {i: f"{own(f'p{i}', 45)} {many} {own(f'q{i}', 45)}" for i in range(600)}
    for i in range(40):
        texts[1000 + i] = f"{own(f'k{i // 2}', 42)} {many} {own(f'e{i}', 50)}"
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        got = found(spark, texts, 8)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {k: places(r.spans) for k, r in got.items()} == brute(texts) and len(got) == 40
