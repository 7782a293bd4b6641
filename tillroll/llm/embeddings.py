"""Near-duplicate vectors by cosine, with sorted projection passes.

A pass draws random planes; the sides on which a vector lies are concatenated to a key, in an order (of the Gray code) in which neighbouring keys differ in
one plane. Vectors are compared within the window of their key and the next key. A key has about log2(n / 32) planes, so windows
hold some tens of vectors, and as many passes are made as pairs at the limit need to meet with the wanted chance.
Windows that hold more, as of copies, are dealt out in blocks in which all their pairs meet: none is cut.

Equal vectors are one class with a count. Links are counted, not listed: a pair counts in the first pass in which its
keys meet, which both vectors know from the keys they carry, and a window returns a count and a link towards its smallest member.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.groups import Batches, by_group, components, local_roots, meeting_blocks
from tillroll.runtime import cut

LIMIT = 0.9
WINDOW = 32
RECALL = 0.95  # of pairs at the limit; closer pairs are found more surely
BLOCK = 1024


def plan(n: int, limit: float = LIMIT, recall: float = RECALL) -> tuple[int, int]:
    """(planes of a key, passes) for ``n`` vectors."""
    planes = max(1, math.ceil(math.log2(max(n, 2) / WINDOW)))
    side = 1 - math.acos(limit) / math.pi
    meet = min(0.999, side**planes + 2 * side ** (planes - 1) * (1 - side))
    return planes, max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def _matrix(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, values padded with zeros as doubles) of a column of lists without nulls."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = np.asarray(column.offsets).astype(np.int64)
    values = np.asarray(column.values)[offsets[0] : offsets[-1]].astype(np.float64)
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = values
    return sizes, out


def _keys(planes: int, passes: int, seed: int = 29):
    """(id, copies, vector, keys) of a batch of classes; vectors of another length have other planes and keys."""

    def run(batches: Batches) -> Batches:
        drawn: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes, values = _matrix(batch.column("vector"))
            keys = np.zeros((batch.num_rows, passes), dtype=np.int64)
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                if size not in drawn:
                    drawn[size] = np.random.default_rng(seed + size).normal(size=(size, planes * passes))
                x = values[rows, :size]
                side = ((x / np.abs(x).max(axis=1, keepdims=True)) @ drawn[size] > 0).reshape(len(rows), passes, planes)
                plain = np.logical_xor.accumulate(side, axis=2)  # from the Gray code to its place in order
                keys[rows] = plain @ (1 << np.arange(planes - 1, -1, -1, dtype=np.int64))
            lists = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * passes, pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("copies"), batch.column("vector"), lists], ["id", "copies", "vector", "keys"]
            )

    return run


def _window_links(limit: float):
    """Count the links of a window that no earlier pass has counted, and link each member to the smallest it reaches."""

    def work(table: pa.Table) -> pa.Table:
        empty = pa.table({"id": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        number, place = table.column("pass")[0].as_py(), table.column("place")[0].as_py()
        table = table.sort_by("id")
        ids, copies = np.asarray(table.column("id")), np.asarray(table.column("copies"))
        keys = _matrix(table.column("keys"))[1].astype(np.int64)  # planes are far fewer than a double's digits
        sizes, x = _matrix(table.column("vector"))
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= limit
        near &= sizes[:, None] == sizes[None, :]
        home = keys[:, number] == place
        near &= home[:, None] | home[None, :]
        part = np.asarray(table.column("part"))
        if table.column("block_a")[0].as_py() != table.column("block_b")[0].as_py():
            near &= part[:, None] != part[None, :]
        np.fill_diagonal(near, False)
        a, b = np.nonzero(np.triu(near))
        if not len(a):
            return empty
        fresh = np.ones(len(a), dtype=bool)
        for earlier in range(number):
            fresh &= np.abs(keys[a, earlier] - keys[b, earlier]) > 1
        links = np.bincount(a[fresh], copies[b[fresh]], len(ids)) + np.bincount(b[fresh], copies[a[fresh]], len(ids))
        root = local_roots(lambda rows: near[rows] | (np.arange(len(ids))[rows, None] == np.arange(len(ids))), len(ids))
        told = (links > 0) | (root != np.arange(len(ids)))
        return pa.table({"id": ids[told], "links": links[told].astype(np.int64), "root": ids[root[told]]})

    return work


def linked_vectors(vectors: DataFrame, limit: float = LIMIT, recall: float = RECALL) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Nulls: a vector that is null, empty or zero, or holds a null or a non-finite component, links with nothing and is its own component;
    vectors of different length do not link. A null id stays; a component is named by its smallest id that is not null.
    Repeated vectors link with each other. Other columns are not read. An empty table gives no rows.
    """
    source = vectors.select("vec_id", F.col("embedding").alias("vector"))
    kind = source.schema["vector"].dataType.simpleString()
    sound = F.expr(
        "vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL OR isnan(x) OR abs(double(x)) = double('infinity'))"
        " AND exists(vector, x -> x <> 0)"
    )
    usable = source.where(F.coalesce(sound, F.lit(False)))
    classes = usable.groupBy("vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    classes = cut(classes.withColumn("id", F.monotonically_increasing_id()))
    planes, passes = plan(classes.count(), limit, recall)
    keyed = classes.select("id", "copies", "vector").mapInArrow(
        _keys(planes, passes), f"id long, copies long, vector {kind}, keys array<long>"
    )
    # A window is the vectors of a key and of the next key.
    placed = cut(keyed.select("id", "keys").select("id", F.posexplode("keys").alias("pass", "key")).select(
        "id", "pass", F.explode(F.array("key", F.col("key") - 1)).alias("place")
    ))
    blocks = meeting_blocks(placed, ["pass", "place"], "id", BLOCK)
    keys = ["pass", "place", "block_a", "block_b"]
    dealt = blocks.select("id", "part", *keys).join(keyed, "id")
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys)
    found = cut(dealt.mapInArrow(by_group(keys, _window_links(limit)), "id long, links long, root long"))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "id")
    named = cut(
        classes.join(counts, "id", "left").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    )
    smallest = named.groupBy("root").agg(F.min("least").alias("component"))
    facts = named.join(smallest, "root").select(
        F.col("vector").alias("of"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), "component"
    )
    joined = source.join(facts, F.col("vector") == F.col("of"), "left")
    component = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


ORACLE = """
WITH RECURSIVE good AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
    sized AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS n FROM good),
    links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM sized AS a JOIN sized AS b ON a.vec_id <> b.vec_id
        WHERE list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.9),
    reach AS (SELECT vec_id AS x, vec_id AS y FROM sized UNION SELECT r.x, l.y FROM reach AS r JOIN links AS l ON r.y = l.x),
    least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
    counted AS (SELECT x, count(*) AS c FROM links GROUP BY x)
SELECT vec_id, CAST(coalesce(c, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM sized JOIN least ON least.x = vec_id LEFT JOIN counted ON counted.x = vec_id
"""
