"""Ranked search against scores added up for every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tillroll.llm import ranked
from tillroll.llm.ranked import Shard, ranked_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain_ranks(docs, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            size = 25 + (75 * sum(c.values()) * n) // total
            score = sum(
                times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * size))
                for t, times in Counter(terms(text)).items()
                if t in c
            )
            scores.append((-score, -math.inf if i is None else i, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(x for x in scores if x[0] < 0)[:k], 1)]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    words = [f"{c}{i}" for i in range(40) for c in ("x", "É", "Q")]
    draw = lambda n: " ".join(rng.choices(words, [1 / (1 + i) for i in range(len(words))], k=n))
    docs = [(i, draw(rng.randint(0, 60))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)]  # copies tie
    docs += [(5, None), (6, ""), (7, " -- "), (None, docs[3][1]), (8, docs[9][1].lower()), (8, docs[9][1].lower())]
    items = [(i, draw(rng.randint(1, 25))) for i in range(30)] + [(90, None), (91, "..."), (92, "nowhere"), (None, "x1 q2"), (3, "x0 x0 x0 É1")]
    return docs, items


@pytest.mark.parametrize(("shard", "block"), [(4096, 512), (23, 4)])
def test_ranks_are_those_of_all_scores(spark, corpus, monkeypatch, shard, block):
    monkeypatch.setattr(ranked, "SHARD", shard)
    monkeypatch.setattr(ranked, "ITEMS", block)
    docs, items = corpus
    found = ranked_documents(
        spark.createDataFrame([(*d, "n") for d in docs], "doc_id long, text string, terms string"),
        spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, query int"),
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(found) == plain_ranks(docs, items)


def test_empty_tables(spark, corpus):
    docs = spark.createDataFrame(corpus[0], "doc_id long, text string")
    items = spark.createDataFrame(corpus[1], "item_id long, text string")
    assert ranked_documents(docs, items.limit(0)).count() == 0
    assert ranked_documents(docs.limit(0), items).count() == 0


def test_a_search_stops_before_the_lists_end_but_not_among_equals():
    """Half of 2 000 documents hold both terms; twelve of these are equally good."""
    n = 2000
    held = np.concatenate([[1, 2] if i % 2 else [1, 3] for i in range(n)]).astype(np.int64)
    counts = np.ones(2 * n, dtype=np.int64)
    m = np.full(n, 100, dtype=np.int64)
    m[100:124] = 50
    shard = Shard(np.array([1, 2, 3]), np.array([1, 9000, 9000]), np.arange(0, 2 * n + 1, 2), m, held, counts)
    ids = np.arange(n)[::-1].copy()
    seen = []
    real = ranked._ranges
    ranked._ranges = lambda a, b: seen.append(int(np.sum(b - a))) or real(a, b)
    try:
        found, scores = shard.best(np.array([0, 1]), np.array([1, 1]), 10, ids)
    finally:
        ranked._ranges = real
    assert sorted(ids[found].tolist()) == sorted(ids[101:124:2].tolist())[:10] and len(set(scores.tolist())) == 1
    assert sum(seen) < n / 4
    # A limit from elsewhere that nothing here reaches ends the search at once.
    few = []
    ranked._ranges = lambda a, b: few.append(int(np.sum(b - a))) or real(a, b)
    try:
        shard.best(np.array([0, 1]), np.array([1, 1]), 10, ids, floor=10**12)
    finally:
        ranked._ranges = real
    assert sum(few) < sum(seen)


def test_a_long_text_and_a_common_word(spark):
    docs = [(i, "the " * 30 + f"w{i}") for i in range(50)] + [(99, "the word " * 200_000 + "needle")]
    items = [(1, "needle"), (2, "the w7")]
    found = ranked_documents(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert rows_of(found) == plain_ranks(docs, items)
