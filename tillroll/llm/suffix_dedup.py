"""Passages repeated across documents, with a sparse suffix array.

Suffixes of the corpus are kept only where a document has a minimiser: the smallest hash of eight consecutive words among 43 neighbours.
Any 50 consecutive words hold one, at the same word in every copy. Suffixes whose eight words stand in one document only match nothing
and are left out before anything wide is made. A kept suffix is a row with the words that follow
and, backwards, the words that precede it, as 32-bit hashes, up to the farthest word that can belong to such a passage. Spark sorts
these rows by content in ranges, so that a passage of which there are very many copies spans several tasks, and
each row is compared with its neighbours of another document: the match is extended to the right and to the left, and a match of 50 words or more is
reported for both. Within a batch, rows with the same eight words are also compared in the order of what precedes them.
The first and last rows of every range are compared in a second, small pass.

A match longer than its context is covered by the next minimisers, which lie at most 43 words on.

Neighbours settle eight words that stand twice. Of eight words that stand more often a row may match others than its neighbours, partly to
the left and partly to the right, and its neighbours do not tell the smallest document of a run of copies. So every window of 50 words
around such a minimiser is hashed and grouped with its smallest and greatest id. Both together give every repeated window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tillroll.llm.groups import Batches
from tillroll.llm.words import SPACES, Words, gram_hashes, pieces
from tillroll.runtime import cut

LEAST = 50  # words of a passage
GRAM = 8
SUFFIX = "gram long, after binary, before binary, doc long, pos int"


def minimisers(grams: np.ndarray, width: int) -> np.ndarray:
    """Places that are the smallest (the last of equal ones) of some ``width`` consecutive hashes."""
    if len(grams) < width:
        return np.zeros(0, dtype=np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(grams, width)
    out = []
    for lo in range(0, len(windows), 4096):
        block = windows[lo : lo + 4096]
        out.append(lo + np.arange(len(block)) + width - 1 - block[:, ::-1].argmin(axis=1))
    return np.unique(np.concatenate(out))


def _context(tags: np.ndarray, at: np.ndarray, first: int, last: int, step: int, size: int) -> np.ndarray:
    """Word tags from ``at`` on in steps, 0 beyond the document's words ``first`` to ``last``; big-endian, to sort as bytes."""
    places = at[:, None] + step * np.arange(size)[None, :]
    inside = (places >= first) & (places < last)
    return np.where(inside, tags[np.where(inside, places, 0)], 0).astype(">u4")


def _binary(rows: np.ndarray) -> pa.Array:
    size = rows.shape[1] * 4
    data = pa.py_buffer(np.ascontiguousarray(rows).tobytes())
    offsets = pa.py_buffer((np.arange(len(rows) + 1, dtype=np.int32) * size).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, data])


def _places(least: int):
    """(doc, pos, gram) of the minimisers of a batch of (doc, text)."""

    def run(batches: Batches) -> Batches:
        for batch in pieces(batches):
            words = Words(batch.column("text"), SPACES)
            hashes = words.hashes()
            rows, places, grams = [], [], []
            for i in range(batch.num_rows):
                found = gram_hashes(hashes[words.of(i)], GRAM)
                at = minimisers(found, least - GRAM + 1)
                rows.append(np.full(len(at), i))
                places.append(at)
                grams.append(found[at])
            docs = batch.column("doc").take(pa.array(np.concatenate(rows)))
            at = pa.array(np.concatenate(places).astype(np.int32))
            yield pa.RecordBatch.from_arrays([docs, at, pa.array(np.concatenate(grams).view(np.int64))], ["doc", "pos", "gram"])

    return run


def _windows(least: int):
    """(window, doc, pos, key) of the windows of ``least`` words around the places in ``wide``, for a batch of (key, doc, text, wide)."""

    def run(batches: Batches) -> Batches:
        for batch in pieces(batches):
            words = Words(batch.column("text"), SPACES)
            hashes = words.hashes()
            rows, starts, found = [], [], []
            for i, wide in enumerate(batch.column("wide")):
                grams = gram_hashes(hashes[words.of(i)], least)
                at = np.array(wide.as_py(), dtype=np.int64)[:, None] - np.arange(least - GRAM + 1)[None, :]
                at = np.unique(at[(at >= 0) & (at < len(grams))])
                rows.append(np.full(len(at), i))
                starts.append(at)
                found.append(grams[at])
            at = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(found).view(np.int64)),
                    batch.column("doc").take(at),
                    pa.array(np.concatenate(starts).astype(np.int32)),
                    batch.column("key").take(at),
                ],
                ["window", "doc", "pos", "key"],
            )

    return run


def _suffixes(least: int):
    """Rows of SUFFIX and the key for a batch of (key, doc, text, places)."""
    reach = least - GRAM

    def run(batches: Batches) -> Batches:
        for batch in pieces(batches):
            words = Words(batch.column("text"), SPACES)
            hashes = words.hashes()
            tags = (hashes >> np.uint64(32)).astype(np.uint32)
            tags[tags == 0] = 1
            grams, rows, places, after, before = [], [], [], [], []
            for i, wanted in enumerate(batch.column("places")):
                own, at = words.of(i), np.array(wanted.as_py(), dtype=np.int64)
                grams.append(gram_hashes(hashes[own], GRAM)[at])
                rows.append(np.full(len(at), i))
                places.append(at)
                after.append(_context(tags, at + own.start + GRAM, own.start, own.stop, 1, reach))
                before.append(_context(tags, at + own.start - 1, own.start, own.stop, -1, reach))
            at = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(grams).view(np.int64)),
                    _binary(np.concatenate(after)),
                    _binary(np.concatenate(before)),
                    batch.column("doc").take(at),
                    pa.array(np.concatenate(places).astype(np.int32)),
                    batch.column("key").take(at),
                ],
                ["gram", "after", "before", "doc", "pos", "key"],
            )

    return run


class _Rows:
    """Columns of suffix rows as arrays."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        self.table = table
        self.gram, self.doc = np.asarray(table.column("gram")), np.asarray(table.column("doc"))
        self.pos = np.asarray(table.column("pos")).astype(np.int64)
        self.after, self.before = (self._tags(table.column(c)) for c in ("after", "before"))

    @staticmethod
    def _tags(column: pa.ChunkedArray) -> np.ndarray:
        joined = b"".join(column.to_pylist())
        return np.frombuffer(joined, ">u4").reshape(len(column), -1)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each pair of rows; 0 ends a document."""
    differ = (a != b) | (a == 0)
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def _matches(rows: _Rows, i: np.ndarray, j: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(row, start, end, other row) in words, both ways round, of the pairs that match in ``least`` words or more."""
    same = (rows.gram[i] == rows.gram[j]) & (rows.doc[i] != rows.doc[j])
    i, j = i[same], j[same]
    right = GRAM + _common(rows.after[i], rows.after[j])
    left = _common(rows.before[i], rows.before[j])
    long = left + right >= least
    i, j, right, left = i[long], j[long], right[long], left[long]
    row, other = np.concatenate((i, j)), np.concatenate((j, i))
    right, left = np.concatenate((right, right)), np.concatenate((left, left))
    return row, rows.pos[row] - left, rows.pos[row] + right, other


def _neighbours(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of each row with the nearest rows of another document before and after it in order."""
    starts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    run = np.searchsorted(starts, np.arange(len(doc)), side="right") - 1
    ends = np.concatenate((starts[1:], [len(doc)])) - 1
    at = np.arange(len(doc))
    back, forth = at[run > 0], at[run < len(starts) - 1]
    pairs = np.concatenate(
        (np.stack((starts[run[forth] + 1], forth)), np.stack((back, ends[run[back] - 1]))), axis=1
    )
    return pairs[0], pairs[1]


def _by_preceding(rows: _Rows) -> np.ndarray:
    """Rows whose eight words stand three times or more, by gram and what precedes."""
    change = np.flatnonzero(np.concatenate(([True], rows.gram[1:] != rows.gram[:-1])))
    size = np.diff(np.concatenate((change, [len(rows.gram)])))
    some = np.flatnonzero(np.repeat(size >= 3, size))
    key = np.concatenate((rows.gram[some, None].astype(">i8").view(np.uint8), rows.before[some].view(np.uint8)), axis=1)
    flat = np.ascontiguousarray(key).view(f"S{key.shape[1]}").ravel() if len(some) else np.zeros(0, "S1")
    return some[np.argsort(flat, kind="stable")]


def _found(rows: _Rows, found: tuple[np.ndarray, ...]) -> pa.Table:
    row, start, end, other = found
    keys = rows.table.column("key")
    none = pa.nulls(len(row), pa.binary())
    return pa.table(
        {
            "key": keys.take(pa.array(row)), "other": keys.take(pa.array(other)), "doc": rows.doc[row],
            "start": start.astype(np.int32), "end": end.astype(np.int32), "gram": rows.gram[row],
            "after": none, "before": none, "pos": rows.pos[row].astype(np.int32), "edge": np.zeros(len(row), bool),
        }
    )


def _edges(table: pa.Table) -> pa.Table:
    n, none = table.num_rows, pa.nulls(table.num_rows, pa.int32())
    return pa.table(
        {
            "key": table.column("key"), "other": pa.nulls(n, table.schema.field("key").type), "doc": table.column("doc"),
            "start": none, "end": none, "gram": table.column("gram"), "after": table.column("after"),
            "before": table.column("before"), "pos": table.column("pos"), "edge": np.ones(n, bool),
        }
    )


def _compare(least: int, edges: bool):
    """Matches of neighbours in a sorted stream; with ``edges`` also its first and last row.

    The rows from the last document of a batch on, and the row before them, are held back for the next batch.
    """

    def run(batches: Batches) -> Batches:
        held: pa.Table | None = None
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if edges and last is None:
                yield from _edges(table.slice(0, 1)).to_batches()
            last = table.slice(table.num_rows - 1)
            table = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
            rows = _Rows(table)
            yield from _found(rows, _matches(rows, *_neighbours(rows.doc), least)).to_batches()
            order = _by_preceding(rows)
            i, j = _neighbours(rows.doc[order]) if len(order) else (order, order)
            yield from _found(rows, _matches(rows, order[i], order[j], least)).to_batches()
            change = np.flatnonzero(rows.doc[1:] != rows.doc[:-1])
            held = table.slice(int(change[-1])) if len(change) else table
        if edges and last is not None:
            yield from _edges(last).to_batches()

    return run


def _located(docs: DataFrame, least: int) -> DataFrame:
    """(key, doc, text, places, wide): documents with their minimisers that another document has too, and those whose
    eight words stand more than twice."""
    source = docs.select(
        F.col("doc_id").alias("key"), F.xxhash64("doc_id", "text").alias("doc"), F.col("text").cast("string").alias("text")
    )
    minimal = cut(source.select("doc", "text").mapInArrow(_places(least), "doc long, pos int, gram long"))
    shared = minimal.groupBy("gram").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.count("*").alias("n"))
    shared = shared.where("a <> b").select("gram", (F.col("n") > 2).alias("many"))
    # Written, so that both sides of the join are plain shuffles and a very common gram can be split.
    kept = minimal.join(cut(shared), "gram").groupBy("doc").agg(
        F.array_sort(F.collect_set("pos")).alias("places"),
        F.array_sort(F.collect_set(F.when(F.col("many"), F.col("pos")))).alias("wide"),
    )
    return source.join(kept, "doc").select("key", "doc", "text", "places", "wide")


def repeated_windows(located: DataFrame, least: int = LEAST) -> DataFrame:
    """(key, doc, pos, other): starts of the windows around ``wide`` places that another document has too. ``other`` is the smallest id
    that has the window if it is below ``key``, else the greatest."""
    schema = StructType([*StructType.fromDDL("window long, doc long, pos int").fields, located.schema["key"]])
    windows = located.where(F.size("wide") > 0).select("key", "doc", "text", "wide").mapInArrow(_windows(least), schema)
    holders = windows.groupBy("window").agg(
        F.min("doc").alias("a"), F.max("doc").alias("b"), F.min("key").alias("first"), F.max("key").alias("last")
    )
    holders = cut(holders.where("a <> b").select("window", "first", "last"))
    smaller = F.col("key").isNull() | (F.col("first") < F.col("key"))
    return windows.join(holders, "window").select("key", "doc", "pos", F.when(smaller, F.col("first")).otherwise(F.col("last")).alias("other"))


def _joined(starts: np.ndarray, least: int) -> np.ndarray:
    """Spans (start, end) of the windows at ``starts``, windows that overlap or touch as one."""
    starts = np.sort(starts.astype(np.int64))
    gap = np.flatnonzero(np.diff(starts) > least)
    if not len(starts):
        return np.zeros((0, 2), dtype=np.int64)
    return np.stack((starts[np.concatenate(([0], gap + 1))], starts[np.concatenate((gap, [len(starts) - 1]))] + least), axis=1)


def _window_spans(least: int):
    """Rows (key, doc, start, end, less) for a batch of (key, doc, all, less), arrays of starts of windows."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows, spans, less = [], [], []
            for name in ("all", "less"):
                for i, starts in enumerate(batch.column(name)):
                    found = _joined(np.asarray(starts.values), least)
                    rows.append(np.full(len(found), i))
                    spans.append(found)
                    less.append(np.full(len(found), name == "less"))
            if not rows:
                continue
            at, found = pa.array(np.concatenate(rows)), np.concatenate(spans).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(at), batch.column("doc").take(at), pa.array(found[:, 0]), pa.array(found[:, 1]),
                    pa.array(np.concatenate(less)),
                ],
                ["key", "doc", "start", "end", "less"],
            )

    return run


def repeated_spans(located: DataFrame, least: int = LEAST) -> DataFrame:
    """(key, doc, start, end, other): word spans, start included and end not, that document ``other`` has too, by neighbours."""
    key = located.schema["key"]
    suffixes = located.select("key", "doc", "text", "places").mapInArrow(
        _suffixes(least), StructType([*StructType.fromDDL(SUFFIX).fields, key])
    )
    order = ("gram", "after", "before", "doc", "pos")
    result = StructType(
        [
            key, StructField("other", key.dataType),
            *StructType.fromDDL("doc long, start int, end int, gram long, after binary, before binary, pos int, edge boolean").fields,
        ]
    )
    ranged = suffixes.repartitionByRange(*order).sortWithinPartitions(*order)
    found = cut(ranged.mapInArrow(_compare(least, True), result))
    ends = found.where("edge").select(*order, "key").coalesce(1).sortWithinPartitions(*order)
    across = ends.mapInArrow(_compare(least, False), result)
    columns = ("key", "doc", "start", "end", "other")
    return found.where("NOT edge").select(*columns).unionByName(across.select(*columns))


def repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Documents (doc_id, text) that share a passage of ``least`` words with another document, one row each.

    Columns: doc_id, n_repeated (words in such passages), n_removable (words in passages that a document of smaller id has too; without
    them every passage still stands in the first document that has it, and in no other), spans (merged word spans start:end, comma-joined),
    partners (ids of documents next to it in the order of suffixes, and the smallest or greatest that shares a passage, sorted).
    Nulls: a null text has no words; a null id stays and is no partner. Rows with equal id and text are one document;
    repeats within a document do not count. Documents below ``least`` words have no passage. Other columns are not read. An empty
    table gives no rows. Whole texts are read.
    """
    located = cut(_located(docs, least))
    spans = cut(repeated_spans(located, least))
    smaller = F.coalesce(F.col("other") < F.col("key"), F.lit(False))
    windows = repeated_windows(located, least).groupBy("doc", "key").agg(
        F.collect_set("pos").alias("all"), F.collect_set(F.when(smaller, F.col("pos"))).alias("less"), F.collect_set("other").alias("others")
    )
    windows = cut(windows)
    schema = StructType([located.schema["key"], *StructType.fromDDL("doc long, start int, end int, less boolean").fields])
    wide = cut(windows.select("key", "doc", "all", "less").mapInArrow(_window_spans(least), schema))
    columns = ("key", "doc", "start", "end")
    merged = _merged(spans.select(*columns).unionByName(wide.where("NOT less").select(*columns)))
    removable = _merged(spans.where(smaller).select(*columns).unionByName(wide.where("less").select(*columns)))
    length = F.sum(F.col("end") - F.col("start")).cast("long")
    text = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("start", "end"))), lambda s: F.concat_ws(":", s["start"], s["end"])), ","
    )
    by = ("doc",)
    total = merged.groupBy(*by, "key").agg(length.alias("n_repeated"), text.alias("spans"))
    less = removable.groupBy(*by).agg(length.alias("n_removable"))
    others = spans.select("doc", "other").unionByName(windows.select("doc", F.explode_outer("others").alias("other")))
    partners = others.groupBy(*by).agg(F.array_sort(F.collect_set("other")).alias("partners"))
    return total.join(less, "doc", "left").join(partners, "doc").select(
        F.col("key").alias("doc_id"), "n_repeated", F.coalesce("n_removable", F.lit(0)).alias("n_removable"), "spans", "partners"
    )


def _merged(spans: DataFrame) -> DataFrame:
    """Overlapping or touching spans of a document as one."""
    order = Window.partitionBy("doc").orderBy("start", "end")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fresh = spans.distinct().withColumn("fresh", F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True)).cast("int"))
    island = fresh.withColumn("island", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy("doc", "key", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
