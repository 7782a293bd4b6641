"""The corpus operators as queries over the given tables, and the same in DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontam, embeddings, html, langid, mixing, neighbours, ranked, runs, secrets, simhash, suffix_dedup, toxicity, warc
from tillroll.sources.star import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.repeats(table(spark, folder, "documents"))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, folder, "documents")))


def op3_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.mixed(table(spark, folder, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source")


def op4_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.resolve_revisits(warc.page_captures(table(spark, folder, "pages")))
    entries = F.array_sort(F.map_entries("headers"))
    text = F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return found.withColumn("headers", text)


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.simhash_components(table(spark, folder, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.main_text(table(spark, folder, "pages"))


def op7_embedding_links(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.linked_vectors(table(spark, folder, "embeddings"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.language(table(spark, folder, "documents"))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.ranked_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest_vectors(table(spark, folder, "embeddings"))


def op13_word_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.digest(runs.word_runs(runs.with_repeats(table(spark, folder, "documents"))))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_secret_scan,
        op3_source_mix,
        op4_warc_revisits,
        op5_simhash,
        op6_html_text,
        op7_embedding_links,
        op8_toxicity,
        op9_language,
        op10_decontamination,
        op11_ranked_search,
        op12_nearest_vectors,
        op13_word_runs,
    )
}

ORACLES: dict[str, str] = {
    "op4_warc_revisits": warc.ORACLE,
    "op7_embedding_links": embeddings.ORACLE,
    "op10_decontamination": decontam.ORACLE,
    "op11_ranked_search": ranked.ORACLE,
    "op13_word_runs": runs.ORACLE,
}
