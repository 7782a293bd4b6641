"""Ranked search of words with the Best Position Algorithm over shards of the documents.

The forward index holds, for every document, its number of terms and those terms that some item may ask for. A task takes a shard of some thousand
documents and makes the impact lists of the items' terms: a term's documents by falling impact, its share of a score. An
item reads its lists from the top. Each document met is looked up in all of the item's lists (direct access), which gives its score and marks
its places in them. The best position of a list is the last of its unbroken marked places; no document that is not met yet can
score more than the sum of the impacts at the best positions. Reading goes on behind the best positions, and stops when that sum is
strictly below the score of the k-th best document so far, so that equal scores are settled by id. The best documents of the
shards that a task has done set the limit for its next ones. The few best of every task are ranked at the end.

Scores are whole numbers: the impact of a term is w * ((10**9 * tf) div (1000 * tf + 8 * m)), with w = floor(1000 * ln((2N + 2) / (2df + 1))) and
m = 25 + (75 * n * N) div L for N documents with L terms in all, of which n in the document and df documents hold the term.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.groups import Batches, by_group
from tillroll.llm.words import SYMBOLS, Words, mixed, pieces
from tillroll.runtime import cut

TOP = 10
SHARD = 4096  # documents
ITEMS = 512  # items that a task searches for at once
_FILTER_BITS = 23
_NO_ID = np.iinfo(np.int64).min


def _ranges(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The numbers from each start up to its stop, joined."""
    sizes = stop - start
    ends = np.cumsum(sizes)
    return np.repeat(start - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def _counted(wanted: np.ndarray | None):
    """(id, spread, n, terms, counts) of a batch of (id, text): hashes of a text's terms and how often it holds them. Only terms whose
    leading bits are marked in ``wanted`` are kept; ``n`` counts all. ``spread`` deals rows out evenly, whatever their ids."""

    def run(batches: Batches) -> Batches:
        row = 0
        for batch in pieces(batches):
            words = Words(batch.column("text"), SYMBOLS)
            hashes = words.hashes()
            home = np.repeat(np.arange(batch.num_rows), np.diff(words.first))
            if wanted is not None:
                bucket = hashes >> np.uint64(64 - _FILTER_BITS)
                some = (wanted[(bucket >> np.uint64(6)).astype(np.int64)] >> (bucket & np.uint64(63))) & np.uint64(1) > 0
                hashes, home = hashes[some], home[some]
            by = np.lexsort((hashes, home))
            hashes, home = hashes[by], home[by]
            head = np.ones(len(home), dtype=bool)
            head[1:] = (home[1:] != home[:-1]) | (hashes[1:] != hashes[:-1])
            at = np.flatnonzero(head)
            counts = np.diff(np.append(at, len(home)))
            offsets = np.searchsorted(home[at], np.arange(batch.num_rows + 1))
            ids = np.asarray(batch.column("id").fill_null(_NO_ID)).view(np.uint64)
            spread = mixed(mixed(ids) + np.arange(row, row + batch.num_rows, dtype=np.uint64))
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array((spread >> np.uint64(1)).view(np.int64)),
                    pa.array(np.diff(words.first).astype(np.int64)),
                    _lists(offsets, hashes[at].view(np.int64)),
                    _lists(offsets, counts.astype(np.int64)),
                ],
                ["id", "spread", "n", "terms", "counts"],
            )

    return run


def _terms(rows: DataFrame, wanted: np.ndarray | None) -> DataFrame:
    return rows.mapInArrow(_counted(wanted), "id long, spread long, n long, terms array<long>, counts array<long>")


def _term_filter(terms: DataFrame) -> np.ndarray:
    """One bit for every value of a term's leading bits; at most 2**17 numbers whatever the number of terms."""
    bucket = F.shiftrightunsigned("term", 64 - _FILTER_BITS)
    marked = terms.select(F.shiftright(bucket, 6).alias("word"), F.expr("shiftleft(1L, CAST(term >>> 41 & 63 AS INT))").alias("bit"))
    out = np.zeros(1 << (_FILTER_BITS - 6), dtype=np.uint64)
    for word, bits in marked.groupBy("word").agg(F.bit_or("bit")).collect():
        out[word] = np.uint64(bits & (2**64 - 1))
    return out


class Shard:
    """Impact lists of some terms over some documents, with direct access by document."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, first: np.ndarray, m: np.ndarray, held: np.ndarray, counts: np.ndarray):
        """``terms`` is sorted; document ``i`` holds the terms ``held[first[i]:first[i + 1]]`` so often as ``counts`` says."""
        at = np.minimum(np.searchsorted(terms, held), max(len(terms) - 1, 0))
        known = terms[at] == held if len(terms) else np.zeros(len(held), dtype=bool)
        home = np.repeat(np.arange(len(m)), np.diff(first))[known]
        self.term, tf = at[known], counts[known]
        self.first = np.searchsorted(home, np.arange(len(m) + 1))
        self.impact = weights[self.term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[home]))
        by = np.lexsort((home, -self.impact, self.term))
        self.documents, self.falling = home[by], self.impact[by]
        self.begin = np.searchsorted(self.term[by], np.arange(len(terms) + 1))
        self.place = np.empty(len(by), dtype=np.int64)
        self.place[by] = np.arange(len(by)) - self.begin[self.term[by]]
        self.terms = terms

    def best(self, asked: np.ndarray, times: np.ndarray, k: int, order: np.ndarray, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) that can be among the ``k`` best for the terms numbered ``asked``; equal scores go by ``order``.

        ``floor`` is a score that ``k`` other documents reach: those below it may be left out.
        """
        sizes = self.begin[asked + 1] - self.begin[asked]
        asked, times, sizes = asked[sizes > 0], times[sizes > 0], sizes[sizes > 0]
        begin = self.begin[asked]
        number = np.full(len(self.terms), -1)
        number[asked] = np.arange(len(asked))
        offset = np.cumsum(sizes + 1) - sizes - 1  # a list's places, with one after its end that is never marked
        marked = np.zeros(int(np.sum(sizes + 1)), dtype=bool)
        met = np.zeros(len(self.first) - 1, dtype=bool)
        position = np.zeros(len(asked), dtype=np.int64)  # of the first place that is not marked
        documents, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        step = 8
        while len(asked):
            read = _ranges(begin + position, begin + np.minimum(position + step, sizes))
            new = np.unique(self.documents[read])
            new = new[~met[new]]
            met[new] = True
            lo, hi = self.first[new], self.first[new + 1]
            postings = _ranges(lo, hi)
            which = number[self.term[postings]]
            gain = np.where(which >= 0, times[which] * self.impact[postings], 0)
            total = np.add.reduceat(gain, np.cumsum(hi - lo) - (hi - lo)) if len(new) else gain
            hit = which >= 0
            marked[offset[which[hit]] + self.place[postings[hit]]] = True
            documents, scores = np.concatenate((documents, new)), np.concatenate((scores, total))
            top = np.lexsort((order[documents], -scores))[:k]
            documents, scores = documents[top], scores[top]
            gaps = np.flatnonzero(~marked)
            position = gaps[np.searchsorted(gaps, offset + position)] - offset
            behind = self.falling[begin + np.maximum(position, 1) - 1]
            limit = int(np.sum(np.where(position < sizes, times * behind, 0)))
            kth = int(scores[-1]) if len(scores) == k else 0
            if limit < max(kth, floor) or not limit:
                break
            step *= 2
        some = scores > 0
        return documents[some], scores[some]


def _search(k: int):
    """The best documents of all shards of a task, for a sorted stream of shards with their items."""

    def run(batches: Batches) -> Batches:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        names: dict[int, int | None] = {}
        nothing = pa.table({"query": pa.array([], pa.int64())})

        def work(table: pa.Table) -> pa.Table:
            items = table.filter(table.column("query").is_valid()).combine_chunks()
            docs = table.filter(table.column("query").is_null()).combine_chunks()
            if not items.num_rows or not docs.num_rows:
                return nothing

            def flat(of: pa.Table, column: str) -> np.ndarray:
                return np.asarray(of.column(column).combine_chunks().flatten())

            def edges(of: pa.Table) -> np.ndarray:
                return np.concatenate(([0], np.cumsum(np.asarray(pc.list_value_length(of.column("terms"))))))

            terms, at = np.unique(flat(items, "terms"), return_index=True)
            weights = flat(items, "weights")[at]
            shard = Shard(terms, weights, edges(docs), np.asarray(docs.column("m")), flat(docs, "terms"), flat(docs, "counts"))
            ids = np.asarray(docs.column("id").fill_null(_NO_ID))
            asked, times, of = np.searchsorted(terms, flat(items, "terms")), flat(items, "counts"), edges(items)
            for i, (query, name) in enumerate(zip(items.column("query").to_pylist(), items.column("id").to_pylist(), strict=True)):
                known, reached = best.get(query, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                floor = int(reached[-1]) if len(reached) == k else 0
                found, scores = shard.best(asked[of[i] : of[i + 1]], times[of[i] : of[i + 1]], k, ids, floor)
                known, reached = np.concatenate((known, ids[found])), np.concatenate((reached, scores))
                top = np.lexsort((known, -reached))[:k]
                best[query], names[query] = (known[top], reached[top]), name
            return nothing

        for _ in by_group(["shard", "block"], work)(batches):
            pass
        for query, (known, reached) in best.items():
            ids = pa.array(known, mask=known == _NO_ID)
            yield pa.RecordBatch.from_arrays(
                [pa.array([query] * len(known), pa.int64()), pa.array([names[query]] * len(known), pa.int64()), ids, pa.array(reached)],
                ["query", "item", "doc", "score"],
            )

    return run


def ranked_documents(
    docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id", k: int = TOP
) -> DataFrame:
    """The ``k`` best documents of each item: ``item``, ``rank``, ``key`` and ``score``, best first, equal scores by rising id.

    Nulls and empty texts have no terms: such a document is not counted nor found, such an item finds nothing. Ids are integers; a null id
    stays and precedes others. Each row is a document or an item of its own, so repeated documents are listed each, and repeated items have
    a list each. Fewer than ``k`` documents with a score above 0: all of them. Other columns are not read. Empty tables give no rows.
    Terms are told apart by 64-bit hashes.
    """

    def source(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(F.col(name).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    asked = cut(_terms(source(items, item), None).where("n > 0").withColumn("query", F.monotonically_increasing_id()))
    asked_terms = asked.select("query", "id", F.explode(F.arrays_zip("terms", "counts")).alias("t"))
    asked_terms = asked_terms.select("query", "id", F.col("t.terms").alias("term"), F.col("t.counts").alias("times"))
    index = cut(_terms(source(docs, key), _term_filter(asked_terms)).where("n > 0"))
    facts = index.agg(F.count("*").alias("N"), F.sum("n").alias("L"), F.count_if(F.size("terms") > 0).alias("some")).first()
    shards, blocks = max(1, -(-facts.some // SHARD)), max(1, -(-asked.count() // ITEMS))
    held = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * facts.N + 2) / (2 * F.col("df") + 1))).cast("long")
    # Written, so that the planner knows how many terms there are.
    weighted = asked_terms.join(cut(held), "term").withColumn("w", weight)
    queries = weighted.groupBy("query").agg(F.min("id").alias("id"), F.collect_list(F.struct("term", "times", "w")).alias("t"))
    queries = queries.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1))).alias("shard"),
        F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("long").alias("block"),
        "query",
        "id",
        F.lit(0).cast("long").alias("m"),
        F.col("t.term").alias("terms"),
        F.col("t.times").alias("counts"),
        F.col("t.w").alias("weights"),
    )
    size = F.lit(25).cast("long") + F.expr(f"(75L * n * {facts.N}L) div {facts.L or 1}L")
    dealt = index.where(F.size("terms") > 0).select(
        F.pmod("spread", F.lit(shards)).alias("shard"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1))).alias("block"),
        F.lit(None).cast("long").alias("query"),
        "id",
        size.alias("m"),
        "terms",
        "counts",
        F.lit(None).cast("array<long>").alias("weights"),
    )
    keys = ["shard", "block"]
    together = dealt.unionByName(queries).repartition(*keys).sortWithinPartitions(*keys)
    found = together.mapInArrow(_search(k), "query long, item long, doc long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc"))
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.select(F.col("item").alias(item), "rank", F.col("doc").alias(key), "score")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
    i AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
    facts AS (SELECT count(*) AS c, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
    tf AS (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d),
    counts AS (SELECT doc_id, n, term, count(*) AS tf FROM tf GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM counts GROUP BY term),
    terms AS (SELECT item_id, unnest(w) AS term FROM i),
    asked AS (SELECT item_id, term, count(*) AS times FROM terms GROUP BY ALL),
    weights AS (SELECT term, CAST(floor(1000 * ln((2 * c + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, facts),
    scores AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * c) // l)))) AS BIGINT) AS score
        FROM asked JOIN weights USING (term) JOIN counts USING (term), facts GROUP BY ALL),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
