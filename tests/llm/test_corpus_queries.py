"""Registered corpus queries on the smallest tables, against SQL where there is some, and the pipeline stage by stage."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from tillroll.llm import decontam, mixing, queries, secrets, simhash, toxicity
from tillroll.sources.star import table

DATA = "/root/testdata/sf0.001"
COLUMNS = {
    2: ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    3: ["doc_id", "size", "source_size", "target", "taken"],
    5: ["doc_id", "fingerprint", "component_id"],
    6: ["page_id", "url", "text", "n_chars"],
    7: ["vec_id", "n_links", "component_id", "kept"],
    8: ["doc_id", "held_out", "score", "predicted"],
    9: ["doc_id", "held_out", "lang_pred", "score"],
    10: ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    11: ["item_id", "rank", "doc_id", "score"],
    12: ["query_id", "rank", "vec_id", "score"],
    13: ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
}


def test_every_operator_and_the_pipeline_are_registered():
    names = entry_points.queries()
    assert set(queries.QUERIES) <= set(names) and "pipeline" in names
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert set(queries.ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, name):
    frame = queries.QUERIES[name](spark, DATA)
    number = int(name[2:].split("_")[0])
    assert frame.columns[: len(COLUMNS.get(number, []))] == COLUMNS.get(number, [])
    rows = frame.collect()
    assert rows
    if name in queries.ORACLES:
        connection = duckdb.connect()
        for path in Path(DATA).glob("*.parquet"):
            connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        result = connection.execute(queries.ORACLES[name])
        columns = [c[0] for c in result.description]
        assert set(columns) == set(frame.columns)
        assert sorted((tuple(r[c] for c in columns) for r in rows), key=repr) == sorted(result.fetchall(), key=repr)


def test_stages_of_the_pipeline(spark):
    """Each stage against what its operator says of the stage's own input."""
    docs = table(spark, DATA, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "secrets", "mix"]
    outputs = []
    for _, stage in corpus_pipeline.STAGES:
        before = docs
        docs = spark.createDataFrame(stage(spark, docs, DATA).collect(), stage(spark, before, DATA).schema)
        outputs.append((before, docs))
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    for before, after in outputs[:4]:
        assert after.columns == before.columns
    before, after = outputs[0]
    scored = toxicity.toxicity(before, table(spark, DATA, "labels"))
    assert ids(after) == ids(scored.where("predicted = 0"))
    before, after = outputs[1]
    assert ids(after) == ids(simhash.simhash_components(before).where("doc_id = component_id"))
    before, after = outputs[2]
    assert ids(after) == ids(decontam.contamination(before, table(spark, DATA, "benchmark")).where("NOT contaminated"))
    before, after = outputs[3]
    assert ids(after) == ids(before)
    assert not any(secrets.base_spans(r.text or "") for r in after.collect())
    before, after = outputs[4]
    assert sum(r.mix_taken for r in after.collect()) == sum(r.taken for r in mixing.mixed(before).collect())


def test_run_is_its_stages(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0 and corpus_pipeline.ORACLE_SQL is None


def test_stages_take_nulls_repeats_and_clashing_columns(spark):
    clash = "fp string, mix_taken long, places string, doc string, content long, key int, pos int, head string"
    names = [c.split()[0] for c in clash.split(", ")]
    rows = [(1, "one two three four", "en", "a", 4), (1, "one two three four", "en", "a", 4), (None, None, None, None, None), (2, "", "en", None, 0), (3, "token = 'abcdefgh1234'", None, "b", 1)]
    docs = spark.createDataFrame(
        [(*r, *[None] * len(names)) for r in rows],
        f"doc_id long, text string, lang string, source string, n_chars long, {clash.replace('mix_taken', 'taken')}",
    )
    for _, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, DATA)
        found = made.collect()
        docs = spark.createDataFrame(found, made.schema)
    assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count() >= 1
    empty = table(spark, DATA, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, DATA).count() == 0
