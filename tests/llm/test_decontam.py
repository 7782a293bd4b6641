import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tillroll.llm import decontam

DATA = "/root/testdata/sf0.001"


def brute(text, items):
    def words(t):
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)

    own, hit, found = words(text), set(), set()
    for item, t in items:
        w = words(t)
        n = min(10, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(own) - n + 1) if w else ():
            if tuple(own[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(item)
    listed = sorted(str(i) for i in found if i is not None)
    return len(own), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest()


ITEMS = [
    (1, "a b c d e f g h i j k l"), (2, "one two"), (3, "Solo"), (4, None), (5, "..."), (6, "x x x x x x x x x x x x"),
    (10, "a b c d e f g h i j k l"), (7, "q a b c d e f g h i"), (None, "nameless item text"), (8, "é ß 9z"),
]
TEXTS = [
    "a b c d e f g h i j", "A, B. c d e f g h i j k l m", "zz one two zz SOLO", None, "", "x " * 40, "a b c d e f g h i q a b c d e f g h i",
    "nameless item text", "É ß 9Z é ß 9z", "nothing here", "a b c d e f g h i j a b c d e f g h i j k l", "solo " * 3000,
]


def result(spark, rows, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string, item string")
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    return decontam.contamination(docs, table)


def test_equals_brute_force_with_nulls_short_items_and_overlaps(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)]
    for r in result(spark, rows, ITEMS).collect():
        n_words, n_hit, n_items, digest = brute(TEXTS[r.doc_id], ITEMS)
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n_words, n_hit, n_items, digest), TEXTS[r.doc_id]
        assert r.contaminated == (n_hit > 0)


def test_repeated_rows_and_ids(spark):
    rows = [(1, TEXTS[0], "")] * 3 + [(1, "clean", ""), (None, TEXTS[0], ""), (None, None, "")]
    got = sorted((str(r.doc_id), r.n_hit) for r in result(spark, rows, ITEMS + ITEMS[:1]).collect())
    assert got == [("1", 0), ("1", 10), ("1", 10), ("1", 10), ("None", 0), ("None", 10)]


@pytest.mark.parametrize(("rows", "items", "n"), [([], ITEMS, 0), ([(1, "a", "")], [], 1), ([], [], 0)])
def test_empty_tables(spark, rows, items, n):
    found = result(spark, rows, items).collect()
    assert len(found) == n and not any(r.contaminated for r in found)


def test_clean_documents_keep_columns_and_repeats(spark):
    docs = spark.createDataFrame([(1, "a", TEXTS[0]), (2, "b", "fine"), (2, "b", "fine"), (None, "c", None)], "doc_id long, term string, text string")
    kept = decontam.clean_documents(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert kept.columns == docs.columns and sorted(map(str, (r.doc_id for r in kept.collect()))) == ["2", "2", "None"]


def test_proximity_finds_a_passage_with_a_changed_word(spark):
    words = [f"w{i}" for i in range(40)]
    changed = [*words[:20], "other", *words[21:]]
    items = decontam.item_terms(spark.createDataFrame([(1, " ".join(words))], "item_id long, text string"))
    docs = spark.createDataFrame([(5, "start " + " ".join(changed)), (6, "w1 w2 w3")], "doc_id long, text string")
    found = decontam.proximity_matches(decontam.build_index(docs, items), items).collect()
    assert [(r.doc, r.item, r["shift"], r.hits) for r in found] == [(5, 1, 1, 35)]


def test_same_rows_as_sql(spark):
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    result_ = connection.execute(decontam.ORACLE)
    columns = [c[0] for c in result_.description]
    expected = sorted(result_.fetchall(), key=repr)
    docs, items = (spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("documents", "benchmark"))
    assert sorted(map(tuple, decontam.contamination(docs, items).select(*columns).collect()), key=repr) == expected


def test_runs_no_python_on_executors(spark):
    docs, items = (spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("documents", "benchmark"))
    plan = decontam.contamination(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
