import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tillroll.llm import simhash
from tillroll.llm.words import SPACES, Words, mixed


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    value = sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def roots(values, radius=3):
    """Smallest index that each fingerprint reaches."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    bits = np.array(values, dtype=np.int64).view(np.uint64)
    for i in range(len(bits)):
        for j in np.flatnonzero(np.bitwise_count(bits ^ bits[i]) <= radius):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(bits))]


def near(dice, value, bits):
    for b in dice.sample(range(64), bits):
        value ^= 1 << b
    return value


@pytest.mark.parametrize("leaf", [4, 64, 100_000])
def test_links_equal_brute_force(spark, leaf):
    dice = random.Random(leaf)
    values = [dice.getrandbits(64) for _ in range(300)]
    for v in values[:120]:
        values += [near(dice, v, k) for k in (1, 2, 3, 4)]
    chain = dice.getrandbits(64)
    for _ in range(40):
        chain = near(dice, chain, 3)
        values.append(chain)
    values = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    points = spark.createDataFrame([(v,) for v in values], "fp long")
    found = simhash.components(simhash.linked_fingerprints(points, 3, leaf)).collect()
    got = {}
    for r in found:
        got[r.node] = r.root
    groups = {}
    for v, root in zip(values, roots(values), strict=True):
        groups.setdefault(root, set()).add(v)
    made = {}
    for v in values:
        made.setdefault(got.get(v, v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, made.values()))


def test_large_shards_are_dealt_out_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 40)
    dice = random.Random(1)
    base = dice.getrandbits(62)
    values = sorted({near(dice, base, dice.choice([1, 2, 5, 6])) for _ in range(500)})
    values = [v - (1 << 64) if v >> 63 else v for v in values]
    points = spark.createDataFrame([(v,) for v in values], "fp long")
    found = {r.node: r.root for r in simhash.components(simhash.linked_fingerprints(points, 3, 8)).collect()}
    expected = roots(values)
    made = [found.get(v, v) for v in values]
    assert len(set(made)) == len(set(expected))
    assert all((made[i] == made[j]) == (expected[i] == expected[j]) for i in range(0, 500, 7) for j in range(i) if j < len(values) and i < len(values))


TEXTS = ["A b  c\td e f g h", "a B c d e f g h", None, "", " \n ", "one", "two words", "ÀB c D é", "x " * 50_000, "a b c d e f g h i j k l m n"]


def test_fingerprints_and_components_of_documents(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "clash", 1), (None, TEXTS[0], None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, root int")
    found = simhash.simhash_components(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        text = TEXTS[0] if r.doc_id is None else TEXTS[r.doc_id]
        assert r.fp == fingerprint(text)
    component = {r.doc_id: r.component_id for r in found}
    assert component[1] == component[0] == component[None] == 0 and component[4] == component[3] == component[2] == 2


def test_one_document_of_each_group_stays(spark):
    rows = [(3, "a b c d", "x"), (1, "A b c D", "y"), (1, "A b c D", "y"), (None, "a b c d", "z"), (9, "other words here now", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["1", "9", "None"]


def test_rows_of_one_id_with_other_texts_stay(spark):
    many = "every word of this text differs from those of the others by far".split()
    a, b = " ".join(many), " ".join(reversed(many))
    rows = [(1, a, {"k": 1}), (1, b, {"k": 2}), (2, a.upper(), {"k": 3}), (3, "c d e f", None), (3, "c d e f", None), (4, None, None), (5, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, more map<string,int>")
    kept = simhash.keep_one(docs)
    assert kept.schema == docs.schema
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted([(1, a), (1, b), (3, "c d e f"), (4, "")])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_components(docs).count() == 0 and simhash.keep_one(docs).count() == 0


def changed(dice, words, number):
    out = list(words)
    for at in dice.sample(range(10, len(words) - 10, 12), number):
        out[at] = "new" + str(dice.random())
    return out


def test_texts_with_two_of_a_hundred_words_changed_merge(spark):
    dice = random.Random(8)
    rows = []
    for i in range(100):
        text = [f"w{dice.randrange(5000)}" for _ in range(100)]
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(changed(dice, text, 2)))]
    shared = " ".join(f"s{i}" for i in range(50))  # a common passage alone makes no near copy
    rows += [(1000 + i, shared + " " + " ".join(f"u{dice.randrange(10**6)}" for _ in range(50))) for i in range(60)]
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i for i in range(0, 200, 2)} <= kept and {1000 + i for i in range(60)} <= kept
    assert sum(i not in kept for i in range(1, 200, 2)) >= 90


def wide(texts):
    """Prints in plain loops over bits."""
    out = []
    for text in texts:
        hashes, first = simhash._shingles(Words(pa.array([text]), SPACES))
        row = []
        for seed in mixed(np.arange(1, simhash.PRINTS + 1, dtype=np.uint64)):
            mine = [int(h) for h in mixed(hashes ^ seed)]
            row.append(sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in mine) > len(mine)))
        out.append(np.array(row, dtype="<u8").tobytes())
    return out


def test_wide_prints_equal_plain_majorities(spark):
    texts = [None, "", "one", "A two", "a b c d", "a b c d e", "x " * 700, " ".join(str(i * i) for i in range(2000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = {r.doc_id: bytes(r.wide) for r in simhash.wide_prints(docs).collect()}
    assert [found[i] for i in range(len(texts))] == wide(texts)
    assert found[0] == found[1] == bytes(48) and found[4] != found[5]


@pytest.mark.parametrize(("leaf", "block"), [(50, 32_768), (100_000, 60), (100_000, 32_768)])
def test_wide_links_connect_what_brute_force_connects(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(simhash, "WIDE_BLOCK", block)
    dice = random.Random(leaf + block)
    values = [dice.getrandbits(384) for _ in range(150)]
    for v in values[:60]:
        for bits in (3, 20, 62, 66, 120):
            values.append(v ^ sum(1 << b for b in dice.sample(range(384), bits)))
    base = values[0]
    values += [base ^ sum(1 << b for b in dice.sample(range(384), 12)) for _ in range(120)]
    values = sorted(set(values))
    prints = np.array([np.frombuffer(v.to_bytes(48, "little"), "<u8") for v in values])
    masks = [(p, 21 * b) for p in range(6) for b in range(3)]
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(values)), 2):
        x = prints[i] ^ prints[j]
        if np.bitwise_count(x).sum() <= simhash.APART and any(((int(x[p]) >> s) & 0x1FFFFF).bit_count() <= 1 for p, s in masks):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    points = spark.createDataFrame([(i, bytearray(v.to_bytes(48, "little"))) for i, v in enumerate(values)], "node long, wide binary")
    found = {r.node: r.root for r in simhash.components(simhash.linked_prints(points, leaf)).collect()}
    assert [found.get(i, i) for i in range(len(values))] == [find(i) for i in range(len(values))]


def test_a_repeated_line_alone_makes_no_near_copy(spark):
    line = "the same line again and again " * 80
    rows = [(i, line + " ".join(f"u{i}x{j}" for j in range(30))) for i in range(6)] + [(9, line), (10, line.upper())]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == [0, 1, 2, 3, 4, 5, 9]
