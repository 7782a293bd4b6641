"""Nearest neighbours by inner product, over partitions that are learned from a neighbour graph.

A bounded sample of the vectors is joined to its nearest neighbours, and the graph is cut into partitions of equal size with few
edges between them: from halves along principal directions, nodes that have more neighbours elsewhere are swapped in pairs. A small network
learns from a vector's direction how its neighbours are shared among the partitions. It puts every vector into its most probable
partition, and sends a query to its several most probable ones, as many as held-out vectors of the sample need to meet the
wanted share of their neighbours. There the original vectors are compared in double precision.

Equal vectors are one class that keeps its smallest ids, as many as a result can hold. A partition with many vectors or queries is dealt out in
blocks in which each of its queries meets each of its vectors.
"""

from __future__ import annotations

import io
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.groups import Batches, by_group
from tillroll.runtime import cut

TOP = 20
EVERY = 20  # ids divisible by this are queries
FIT_ROWS = 16384  # vectors of the sample at most
PER_PART = 128  # vectors of the sample for a partition
TARGET = 0.95  # share of neighbours that held-out vectors meet in the partitions they are sent to
BLOCK = 4096


def partitions(n: int, fit_rows: int = FIT_ROWS) -> int:
    """Partitions for ``n`` vectors: a power of two near sqrt(n) / 4 that the sample can tell apart."""
    wanted = 2 ** max(1, round(math.log2(max(1.0, math.sqrt(n) / 4))))
    return min(wanted, max(1, fit_rows // PER_PART)) if n >= 32 else 1


def _padded(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows of doubles, with zeros up to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(pc.list_value_length(column))
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = np.asarray(column.flatten())
    return out


def _directions(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _nearest(queries: np.ndarray, points: np.ndarray, k: int, own: np.ndarray) -> np.ndarray:
    """Numbers of the ``k`` points with the largest inner product for each query, without the point ``own``."""
    out = []
    for lo in range(0, len(queries), 512):
        score = queries[lo : lo + 512] @ points.T
        score[np.arange(len(score)), own[lo : lo + 512]] = -np.inf
        out.append(np.argpartition(score, -k, axis=1)[:, -k:])
    return np.concatenate(out)


def balanced_parts(points: np.ndarray, near: np.ndarray, parts: int, rounds: int = 40, seed: int = 5) -> np.ndarray:
    """A partition number per point, with equal shares (to one point) and few of the edges (point, ``near``) between partitions."""
    n = len(points)
    part = np.zeros(n, dtype=np.int64)
    for _ in range(int(math.log2(parts))):  # halves along the main direction of each partition
        halved = part * 2
        for p in np.unique(part):
            own = np.flatnonzero(part == p)
            x = points[own] - points[own].mean(axis=0)
            line = np.linalg.eigh(x.T @ x)[1][:, -1]
            halved[own[np.argsort(x @ line, kind="stable")[len(own) // 2 :]]] += 1
        part = halved
    a = np.concatenate((np.repeat(np.arange(n), near.shape[1]), near.ravel()))
    b = np.concatenate((near.ravel(), np.repeat(np.arange(n), near.shape[1])))
    rng, best, fewest = np.random.default_rng(seed), part, math.inf
    for _ in range(rounds):
        crossing = int(np.sum(part[a] != part[b]))
        if crossing < fewest:
            best, fewest = part.copy(), crossing
        held = np.bincount(a * parts + part[b], minlength=n * parts).reshape(n, parts)
        there = held.argmax(axis=1)
        gain = held[np.arange(n), there] - held[np.arange(n), part]
        movers = np.flatnonzero((gain > 0) & (rng.random(n) < 0.6))  # not all at once: neighbours may swap past each other
        way = part[movers] * parts + there[movers]
        by = np.lexsort((-gain[movers], way))
        movers, way = movers[by], way[by]
        rank = np.arange(len(way)) - np.searchsorted(way, way)
        back = there[movers] * parts + part[movers]
        _, x, y = np.intersect1d(way * n + rank, back * n + rank, return_indices=True)
        movers = np.concatenate((movers[x], movers[y]))  # the r-th of either direction change places
        part[movers] = there[movers]
    return best


def _network(x: np.ndarray, shares: np.ndarray, hidden: int = 96, epochs: int = 40, seed: int = 11) -> list[np.ndarray]:
    """Weights of one hidden layer that gives ``shares`` (probabilities of partitions) for the directions ``x``."""
    rng = np.random.default_rng(seed)
    d, parts = x.shape[1], shares.shape[1]
    weights = [rng.normal(size=(d, hidden)) * math.sqrt(2.0), np.zeros(hidden), rng.normal(size=(hidden, parts)) / math.sqrt(hidden), np.zeros(parts)]
    mean, square, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(epochs):
        rate = 0.004 * (1 - epoch / epochs)
        order = rng.permutation(len(x))
        for lo in range(0, len(x), 256):
            rows = order[lo : lo + 256]
            layer = np.maximum(x[rows] @ weights[0] + weights[1], 0)
            wrong = (_softmax(layer @ weights[2] + weights[3]) - shares[rows]) / len(rows)
            below = (wrong @ weights[2].T) * (layer > 0)
            step += 1
            for i, slope in enumerate((x[rows].T @ below, below.sum(axis=0), layer.T @ wrong, wrong.sum(axis=0))):
                mean[i] += 0.1 * (slope - mean[i])
                square[i] += 0.01 * (slope * slope - square[i])
                fair = mean[i] / (1 - 0.9**step), square[i] / (1 - 0.99**step)
                weights[i] -= rate * fair[0] / (np.sqrt(fair[1]) + 1e-8)
    return weights


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def probabilities(weights: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """Of the partitions, for vectors that are not zero."""
    return _softmax(np.maximum(_directions(x) @ weights[0] + weights[1], 0) @ weights[2] + weights[3])


def fitted(sample: np.ndarray, parts: int, k: int = TOP, target: float = TARGET) -> tuple[list[np.ndarray], int]:
    """(weights, probes): the network for ``parts`` partitions of a sample, and to how many a query goes."""
    k = min(k, len(sample) - 1)
    fit = max(parts, len(sample) - max(1, min(1024, len(sample) // 8)))
    known = min(k, fit - 1)
    near = _nearest(sample[:fit], sample[:fit], known, np.arange(fit))
    part = balanced_parts(_directions(sample[:fit]), near, parts)
    shares = np.zeros((fit, parts))
    np.add.at(shares, (np.repeat(np.arange(fit), known), part[near].ravel()), 1)
    shares[np.arange(fit), part] += 1
    weights = _network(_directions(sample[:fit]), shares / shares.sum(axis=1, keepdims=True))
    home = probabilities(weights, sample).argmax(axis=1)
    tried = np.arange(fit, len(sample)) if fit < len(sample) else np.arange(fit)
    order = np.argsort(-probabilities(weights, sample[tried]), axis=1, kind="stable")
    visit = np.empty_like(order)
    np.put_along_axis(visit, order, np.arange(parts)[None, :].repeat(len(tried), axis=0), axis=1)
    truth = _nearest(sample[tried], sample, k, tried)
    needed = np.take_along_axis(visit, home[truth], axis=1).ravel()
    reached = np.cumsum(np.bincount(needed, minlength=parts)) / len(needed)
    return weights, int(np.searchsorted(reached, target)) + 1


def _fit(width: int, parts: int, k: int, target: float):
    def run(batches: Batches) -> Batches:
        held = [b for b in batches if b.num_rows]
        if held:
            weights, probes = fitted(_padded(pa.Table.from_batches(held).column("vector"), width), parts, k, target)
            file = io.BytesIO()
            np.savez(file, *weights)
            yield pa.RecordBatch.from_arrays([pa.array([file.getvalue()]), pa.array([probes], pa.int32())], ["weights", "probes"])

    return run


def _routes(weights: list[np.ndarray] | None, width: int, probes: int, names: np.ndarray, least: int):
    """The batches with ``parts`` added: the ``probes`` most probable partitions of each row's vector, and further ones until these have ``least``
    of the ``names`` (ids in each partition)."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.zeros((batch.num_rows, 1), dtype=np.int32)
            if weights is not None:
                chance = probabilities(weights, _padded(batch.column("vector"), width))
                order = np.argsort(-chance, axis=1, kind="stable").astype(np.int32)
            before = np.cumsum(names[order], axis=1) - names[order]
            wanted = (np.arange(order.shape[1])[None, :] < probes) | (before < least)
            offsets = np.concatenate(([0], np.cumsum(wanted.sum(axis=1)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(order[wanted]))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "parts"])

    return run


def _best(width: int, k: int):
    """(query, near, score): the ``k`` best ids of a block's vectors for each of its queries."""

    def work(table: pa.Table) -> pa.Table:
        asking = table.filter(table.column("ids").is_null()).combine_chunks()
        points = table.filter(table.column("ids").is_valid()).combine_chunks()
        parts = []
        if asking.num_rows and points.num_rows:
            x, names = _padded(points.column("vector"), width), points.column("ids").combine_chunks()
            first = np.concatenate(([0], np.cumsum(np.asarray(pc.list_value_length(names)))))
            names, longest = np.asarray(names.flatten()), np.linalg.norm(x, axis=1).max()
            everything, ids = _padded(asking.column("vector"), width), np.asarray(asking.column("id"))
            for lo in range(0, len(ids), 256):
                q = everything[lo : lo + 256]
                score = q @ x.T
                least = np.partition(score, max(0, len(x) - k), axis=1)[:, max(0, len(x) - k)]
                slack = 1e-9 * longest * np.linalg.norm(q, axis=1)  # products of matrices may round otherwise
                a, b = np.nonzero(score >= (least - slack)[:, None])
                exact = (q[a] * x[b]).sum(axis=1)
                sizes = first[b + 1] - first[b]
                pair = np.repeat(np.arange(len(a)), sizes)
                name = names[first[b][pair] + np.arange(len(pair)) - (np.cumsum(sizes) - sizes)[pair]]
                a, exact = a[pair], exact[pair]
                by = np.lexsort((name, -exact, a))
                a, exact, name = a[by], exact[by], name[by]
                top = np.arange(len(a)) - np.searchsorted(a, a) < k
                parts.append((ids[lo + a[top]], name[top], exact[top]))
        query, near, score = (np.concatenate(c) if parts else np.zeros(0) for c in (zip(*parts, strict=True) if parts else ((), (), ())))
        return pa.table({"query": pa.array(query, pa.int64()), "near": pa.array(near, pa.int64()), "score": pa.array(score, pa.float64())})

    return work


def sound(vector: str) -> Column:
    """True for lists of finite numbers that are not all zero."""
    return F.coalesce(
        F.expr(
            f"{vector} IS NOT NULL AND NOT exists({vector}, x -> x IS NULL OR isnan(x) OR abs(double(x)) = double('infinity'))"
            f" AND exists({vector}, x -> x <> 0)"
        ),
        F.lit(False),
    )


def nearest_vectors(
    vectors: DataFrame, every: int = EVERY, k: int = TOP, fit_rows: int = FIT_ROWS, target: float = TARGET, block: int = BLOCK
) -> DataFrame:
    """The ``k`` nearest found of each query: query_id, rank, vec_id and score (inner product), nearest first, ties by smaller id.

    Queries are the rows of ``vectors`` (vec_id, embedding) whose id ``every`` divides; all rows but those of the query's own id are
    candidates, or all of them where there are fewer than ``k``. Rows whose vector is null, empty, zero, or holds a null or a non-finite component,
    and rows without an id, take no part. Shorter vectors count as if zeros followed. Rows that repeat an id and a vector count once; an id with
    several vectors is a query with each. Other columns are not read. An empty table gives no rows. The network is fitted
    on ``fit_rows`` vectors at most; there are at most fit_rows / 128 partitions.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    rows = rows.where("vec_id IS NOT NULL").where(sound("vector")).distinct()
    kind = rows.schema["vector"].dataType.simpleString()
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    smallest = rows.withColumn("rank", rank).where(F.col("rank") <= k + 1)
    classes = smallest.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    classes = cut(classes.withColumn("id", F.monotonically_increasing_id()))
    n, width = classes.agg(F.count("*"), F.max(F.size("vector"))).first()
    parts, weights, probes = partitions(n, fit_rows), None, 1
    if parts > 1:
        sample = classes.orderBy(F.xxhash64("vector"), "id").limit(min(fit_rows, parts * PER_PART)).select("vector")
        model = sample.coalesce(1).mapInArrow(_fit(width, parts, k, target), "weights binary, probes int").first()
        weights, probes = [w for _, w in sorted(np.load(io.BytesIO(model.weights)).items())], model.probes
    # No more than the partitions' numbers, sizes and weights come to the driver.
    home = _routes(weights, width or 1, 1, np.zeros(parts, np.int64), 0)
    placed = classes.mapInArrow(home, f"vector {kind}, ids array<long>, id long, parts array<int>")
    placed = cut(placed.select("id", "ids", "vector", F.get("parts", F.lit(0)).alias("part")))
    facts = placed.groupBy("part").agg(F.sum(F.size("ids")).alias("names"), F.count("*").alias("n")).collect()
    sizes, names = {r.part: r.n for r in facts}, np.zeros(parts, np.int64)
    for row in facts:
        names[row.part] = row.names
    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector")
    same = (F.xxhash64(asked["vector"]) == F.xxhash64(classes["vector"])) & (asked["vector"] == classes["vector"])
    asked = cut(asked.join(classes, same).select("query_id", F.col("id").alias("query")))
    # A query goes on to further partitions until it has met enough ids for a whole result.
    queries = classes.select("id", "vector").join(asked.select(F.col("query").alias("id")), "id", "left_semi")
    routed = queries.mapInArrow(_routes(weights, width or 1, probes, names, k + 1), f"id long, vector {kind}, parts array<int>")
    routed = cut(routed.select("id", "vector", F.explode("parts").alias("part")))
    asking = {r["part"]: r["count"] for r in routed.groupBy("part").count().collect()}
    shape = [(p, -(-sizes.get(p, 0) // block) or 1, -(-asking.get(p, 0) // block) or 1) for p in range(parts)]
    shape = F.broadcast(spark.createDataFrame(shape, "part int, blocks int, query_blocks int"))
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    points = placed.join(shape, "part").select(
        "part", F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("block"), upto("query_blocks").alias("query_block"), "id", "ids", "vector"
    )
    dealt = routed.join(shape, "part").select(
        "part",
        upto("blocks").alias("block"),
        F.pmod(F.xxhash64("id"), "query_blocks").cast("int").alias("query_block"),
        "id",
        F.lit(None).cast("array<long>").alias("ids"),
        "vector",
    )
    keys = ["part", "block", "query_block"]
    meeting = points.unionByName(dealt).repartition(*keys).sortWithinPartitions(*keys)
    found = meeting.mapInArrow(by_group(keys, _best(width or 1, k + 1)), "query long, near long, score double")
    nearest = Window.partitionBy("query").orderBy(F.desc("score"), "near")
    found = cut(found.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k + 1))
    own = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "near")
    listed = asked.join(found, "query").where("near <> query_id").withColumn("rank", F.row_number().over(own))
    return listed.where(F.col("rank") <= k).select("query_id", "rank", F.col("near").alias("vec_id"), "score")
