"""Benchmark decontamination by a positional inverted index of the training tokens.

A posting is a training token at its position, with the two tokens after it (a next-word index: single common words would
have more postings than can be intersected). The index stores the postings whose three words some test item has in a row, as other
postings take part in no match; items of one or two words are looked up by those. Position less item position is the alignment of a
document with an item. A query starts from the rarest terms: of every window of ten item words the entry with the fewest postings is
the anchor, and the alignments of anchor postings are the only ones at which the window can stand. The other postings, shifted by
their offsets, are intersected with these. Runs of consecutive common positions are phrases; common positions of an alignment that
cover most of an item are proximity matches. Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.runtime import cut

WINDOW = 10
NEXT = 3  # words of a posting
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text, lower-cased in ASCII; null has none."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _UPPER.lower())
    return F.filter(F.split(lowered, _BREAK), lambda w: w != "")


def _entries(spread: Column, size: int) -> Column:
    """Hashes of every ``size`` consecutive word hashes of an array, none if it is shorter."""
    at = F.sequence(F.lit(1), F.size(spread) - size + 1)
    keys = F.transform(at, lambda i: F.xxhash64(F.lit(size), *[F.element_at(spread, i + k) for k in range(size)]))
    return F.when(F.size(spread) >= size, keys).otherwise(F.array().cast("array<bigint>"))


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def item_terms(items: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, copy, at, term, size, n, span): the index entries of every distinct item by position. ``size`` is the words of an
    entry, ``n`` the entries of the item and ``span`` those of a window."""
    cut_up = items.select(F.col(item).alias("item"), _hashes(F.col(text)).alias("w")).distinct().where(F.size("w") > 0)
    cut_up = cut_up.withColumn("copy", F.xxhash64("w")).withColumn("size", F.least(F.lit(min(NEXT, window)), F.size("w")))
    entries = F.lit(None).cast("array<bigint>")
    for size in range(1, NEXT + 1):
        entries = F.when(F.col("size") == size, _entries(F.col("w"), size)).otherwise(entries)
    span = F.least(F.size("w"), F.lit(window)) - F.col("size") + 1
    spread = cut_up.select("item", "copy", "size", (F.size("w") - F.col("size") + 1).alias("n"), span.alias("span"), F.posexplode(entries))
    return spread.withColumnsRenamed({"pos": "at", "col": "term"})


def build_index(docs: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Store and return the postings (doc, content, pos, term) of the entries in ``terms`` (term, size).

    ``content`` is a hash of the text: rows that repeat a key with another text stay apart, equal rows are one.
    """
    sizes = sorted(r[0] for r in terms.select("size").distinct().collect())  # three at most
    hashed = docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("content"), _hashes(F.col(text)).alias("w"))
    vocabulary = terms.select("term").distinct()
    postings = None
    for size in sizes or [1]:
        spread = hashed.select("doc", "content", F.posexplode(_entries(F.col("w"), size))).withColumnRenamed("col", "term")
        found = spread.join(vocabulary, "term", "left_semi")
        postings = found if postings is None else postings.unionByName(found)
    return cut(postings.select("doc", "content", "pos", "term"))


def _anchors(terms: DataFrame, index: DataFrame) -> DataFrame:
    """(item, copy, at, term): the entries that are the rarest of some window of their item."""
    counts = index.groupBy("term").agg(F.count("*").alias("df"))
    known = cut(terms.join(counts, "term", "left").withColumn("df", F.coalesce("df", F.lit(0))))
    first = F.greatest(F.lit(0), F.col("at") - F.col("span") + 1)
    starts = known.withColumn("start", F.explode(F.sequence(first, F.least(F.col("at"), F.col("n") - F.col("span")))))
    rarest = starts.groupBy("item", "copy", "start").agg(F.min(F.struct("df", "at", "term")).alias("rarest"))
    # A window with an entry that no document has does not occur.
    return rarest.where("rarest.df > 0").select("item", "copy", "rarest.at", "rarest.term").distinct()


def aligned(index: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc, content, item, copy, size, n, span, shift, at): item positions whose entry the document has at ``at + shift``,
    for every alignment at which an anchor matches."""
    by = ("doc", "content", "item", "copy", "shift")
    shift = (F.col("pos") - F.col("at")).alias("shift")
    # Written, so that both sides of the join are plain shuffles and a very common entry can be split.
    shifts = index.join(cut(_anchors(terms, index)), "term").select("doc", "content", "item", "copy", shift).distinct()
    pairs = index.join(terms, "term").select("doc", "content", "item", "copy", "size", "n", "span", shift, "at")
    return pairs.join(shifts, _same(pairs, shifts, *by), "left_semi").distinct()


def _same(a: DataFrame, b: DataFrame, *columns: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & a[c].eqNullSafe(b[c])
    return out


def phrase_matches(index: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc, content, item, start, end): document positions of the maximal runs of an item's words, a window or longer."""
    by = ("doc", "content", "item", "copy", "shift")
    order = Window.partitionBy(*by).orderBy("at")
    runs = aligned(index, terms).withColumn("island", F.col("at") - F.row_number().over(order))
    runs = runs.groupBy(*by, "size", "span", "island").agg(
        (F.min("at") + F.col("shift")).alias("start"),
        (F.max("at") + F.col("shift") + F.col("size") - 1).alias("end"),
        F.count("*").alias("length"),
    )
    return runs.where("length >= span").select("doc", "content", "item", "start", "end")


def proximity_matches(index: DataFrame, terms: DataFrame, share: float = 0.8) -> DataFrame:
    """(doc, content, item, shift, hits): alignments at which at least ``share`` of an item's entries stand in place."""
    by = ("doc", "content", "item", "copy", "shift", "n")
    counted = aligned(index, terms).groupBy(*by).agg(F.count("*").alias("hits"))
    return counted.where(F.col("hits") >= share * F.col("n")).drop("copy", "n")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_words, n_hit, n_items, items_sha256, contaminated.

    Nulls: a null text has no words; a null doc_id is a key like any other; an item without words never occurs, and an item
    without an id counts as a hit but is not listed. Repeated rows get equal results. Other columns of either
    table are not read. Without items every document is clean; without documents there are no rows.
    """
    terms = cut(item_terms(items, window=window))
    index = build_index(docs, terms)
    spans = phrase_matches(index, terms)
    by = ("doc", "content")
    before = Window.partitionBy(*by).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.col("start"), F.coalesce(F.max("end").over(before) + 1, F.lit(0)))
    found = spans.withColumn("fresh", F.greatest(F.lit(0), F.col("end") - reached + 1))
    found = found.groupBy(*by).agg(
        F.sum("fresh").alias("hit"), F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("found_items")
    )
    found = found.withColumnsRenamed({"doc": "found_doc", "content": "found_content"})
    sized = docs.select("doc_id", F.xxhash64("text").alias("content"), F.size(words(F.col("text"))).alias("n_words"))
    same = sized["doc_id"].eqNullSafe(found["found_doc"]) & (sized["content"] == found["found_content"])
    listed = F.coalesce(F.col("found_items"), F.array().cast("array<string>"))
    n_hit = F.coalesce("hit", F.lit(0)).cast("long")
    return sized.join(found, same, "left").select(
        "doc_id",
        F.col("n_words").cast("long"),
        n_hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents without a word inside an item's window, all columns; a repeated row stays repeated."""
    terms = cut(item_terms(items, window=window))
    hits = phrase_matches(build_index(docs, terms), terms).select("doc", "content").distinct()
    same = docs["doc_id"].eqNullSafe(hits["doc"]) & (F.xxhash64(docs["text"]) == hits["content"])
    return docs.join(hits, same, "left_anti")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
        list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
    i AS (SELECT item_id,
        list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
    sized AS (SELECT item_id, w, least(10, len(w)) AS span FROM i WHERE len(w) > 0),
    grams AS (SELECT DISTINCT item_id, span, array_to_string(w[s:s + span - 1], ' ') AS gram
        FROM (SELECT item_id, w, span, unnest(range(1, len(w) - span + 2)) AS s FROM sized)),
    spans AS (SELECT DISTINCT span FROM grams),
    found AS (SELECT r, s, g.span, item_id
        FROM (SELECT r, s, span, array_to_string(w[s:s + span - 1], ' ') AS gram
            FROM (SELECT r, w, span, unnest(range(1, len(w) - span + 2)) AS s FROM d, spans WHERE len(w) >= span)) AS x
        JOIN grams AS g ON g.span = x.span AND g.gram = x.gram),
    hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + span)) AS p FROM found) GROUP BY r),
    listed AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""
