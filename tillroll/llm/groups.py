"""Groups in sorted streams, blocks of large groups, and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.runtime import cut

Batches = Iterator[pa.RecordBatch]


def meeting_blocks(rows: DataFrame, keys: list[str], member: str, size: int) -> DataFrame:
    """Deal groups of more than ``size`` rows out in blocks, so that any two rows of a group meet in a block.

    Members of a group of n rows are dealt to c = ceil(n / size) parts by a hash of ``member``; a row goes to the c
    blocks that its part has with the parts. Adds ``block_a`` and ``block_b`` (part numbers, a <= b; 0, 0 for other groups)
    and ``part``.
    """
    large = rows.groupBy(*keys).count().where(F.col("count") > size)
    large = large.select(*keys, F.ceil(F.col("count") / size).cast("int").alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    # Written, so that both sides of the join are plain shuffles and a large group can be split.
    dealt = rows.join(cut(large), keys, "left").withColumn("part", F.pmod(F.xxhash64(F.lit(7), member), parts).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))))
    return dealt.withColumns(
        {"block_a": F.least("part", "other"), "block_b": F.greatest("part", "other")}
    ).drop("parts", "other")


def by_group(keys: list[str], work: Callable[[pa.Table], pa.Table]) -> Callable[[Batches], Batches]:
    """For ``mapInArrow`` over rows sorted by integer ``keys``: call ``work`` with each run of equal keys."""

    def run(batches: Batches) -> Batches:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [np.asarray(batch.column(k)) for k in keys]
            change = np.zeros(batch.num_rows, dtype=bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            head = tuple(c[0] for c in columns)
            change[0] = last is not None and head != last
            last = tuple(c[-1] for c in columns)
            at = 0
            for b in np.flatnonzero(change):
                if b > at:
                    held.append(batch.slice(at, int(b) - at))
                if held:
                    yield from work(pa.Table.from_batches(held)).to_batches()
                held, at = [], int(b)
            held.append(batch.slice(at))
        if held:
            yield from work(pa.Table.from_batches(held)).to_batches()

    return run


def local_roots(near: Callable[[slice], np.ndarray], n: int, rows: int = 512) -> np.ndarray:
    """The smallest index that each of ``n`` points reaches; ``near(block)`` gives the rows of the link matrix."""
    labels = np.arange(n)
    blocks = [slice(i, min(i + rows, n)) for i in range(0, n, rows)]
    kept = near(blocks[0]) if len(blocks) == 1 else None
    while True:
        new = labels.copy()
        for block in blocks:
            links = near(block) if kept is None else kept
            if links.any():
                least = np.where(links, labels[None, :], n).min(axis=1)
                np.minimum.at(new, labels[block], least)
                new[block] = np.minimum(new[block], least)
        while not np.array_equal(jump := new[new], new):
            new = jump
        if np.array_equal(new, labels):
            return labels
        labels = new


def components(edges: DataFrame) -> DataFrame:
    """Smallest node that each node of ``edges`` (a, b) reaches, as (node, root), by alternating star contraction.

    A large star links a node's larger neighbours to its smallest one, a small star its smaller neighbours and itself;
    the rounds grow with the logarithm of the number of nodes. Every round is written as a table. Minima combine
    before the shuffle and the joins are plain equi-joins, which adaptive execution splits at a hub.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = cut(large.where("a <> b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut(small.where("a <> b").unionByName(least.withColumnRenamed("m", "b")).distinct())
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
