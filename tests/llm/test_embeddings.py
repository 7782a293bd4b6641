import math

import numpy as np
import pytest

from tillroll.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, id long"


def brute(rows, limit=0.9):
    good = {}
    for n, (_, v, _) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=np.float32).astype(np.float64)
            good[n] = x / np.linalg.norm(x)
    links = {n: set() for n in range(len(rows))}
    for a in good:
        for b in good:
            if a < b and len(good[a]) == len(good[b]) and good[a] @ good[b] >= limit:
                links[a].add(b)
                links[b].add(a)
    component, seen = {}, set()
    for n in links:
        if n in seen:
            continue
        group, todo = {n}, [n]
        while todo:
            for m in links[todo.pop()] - group:
                group.add(m)
                todo.append(m)
        seen |= group
        ids = [rows[m][0] for m in group if rows[m][0] is not None]
        component |= dict.fromkeys(group, min(ids, default=None))
    return sorted((str(rows[n][0]), len(links[n]), str(component[n])) for n in links)


def result(spark, rows):
    found = embeddings.linked_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in found)
    return sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in found)


def vectors(seed, n, groups, noise):
    dice = np.random.default_rng(seed)
    base = list(dice.normal(size=(n, 16)))
    for size in groups:
        centre = dice.normal(size=16)
        base += [centre + noise * dice.normal(size=16) for _ in range(size)]
    return [(i, [float(x) for x in v], 0) for i, v in enumerate(base)]


def test_links_equal_brute_force_in_close_groups(spark):
    rows = vectors(1, 150, [2, 3, 5, 40], 0.05)
    rows += [(1000 + i, rows[150][1], 0) for i in range(4)] + [(1010, [2 * x for x in rows[3][1]], 0)]
    assert result(spark, rows) == brute(rows)


def test_large_windows_are_dealt_out_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 30)
    rows = vectors(2, 60, [200], 0.08)
    assert result(spark, rows) == brute(rows)


def test_recall_of_pairs_near_the_limit(spark):
    """Pairs between 0.9 and 0.93 are the hardest to bring together."""
    dice = np.random.default_rng(3)
    rows = []
    for i in range(600):
        a, b = dice.normal(size=(2, 32))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        cosine = dice.uniform(0.9001, 0.93)
        rows += [(2 * i, a.tolist(), 0), (2 * i + 1, (cosine * a + math.sqrt(1 - cosine**2) * b).tolist(), 0)]
    got = sum(n for _, n, _ in result(spark, rows))
    assert got >= 0.9 * 1200 and got <= sum(n for _, n, _ in brute(rows))


def test_unusable_vectors_nulls_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [1.0, 1.0], 1),
        (8, [2.0, 2.0], 1), (9, [1.0, 1.0, 0.0], 1), (None, [1.0, 1.0], 1), (7, [1.0, 1.0], 1), (10, [-1.0, -1.0], 1), (None, None, 1),
        (11, [1e-30, 1e-30], 1), (12, [3e38, 3e38], 1),
    ]
    assert result(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 0)], [(1, None, 0)]])
def test_empty_and_single(spark, rows):
    assert result(spark, rows) == brute(rows)
