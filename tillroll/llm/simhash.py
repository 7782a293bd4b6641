"""SimHash near-duplicates: 64-bit fingerprints of shingles, linked within a Hamming radius by vantage-point trees.

Distances between unrelated fingerprints lie within a few bits of 32, so a radius of three prunes little in a tree over all
64 bits. Two fingerprints within ``r`` bits are within ``r // 2`` bits in their upper or their lower half, and the Hamming
distance of a half is a metric too. So there is a tree for each half, with the smaller radius. All nodes of a level share a
vantage point; a fingerprint goes inside or outside of the level's radius (the median distance). By the triangle inequality a
pair that a level separates has its outer member within ``r // 2`` bits of the boundary, so the outer points of that band
are also sent inside, and no pair is lost. Leaves are shards: a task compares the fingerprints of a shard in full and returns
a spanning forest of the links, never all pairs. Shards that stay large, as of near copies, are dealt out in blocks.

``keep_one`` looks for texts whose shingles of five words have a similarity of 0.8, which differ in about every seventh bit: far beyond a
radius that a tree can prune with. It takes six fingerprints of other seeds and cuts each into three bands of 21 bits. Two such
texts are within one bit in some of the 18 bands, which has a tree each; a pair that meets in a shard and is near in
all 384 bits is linked if its shingles are that similar.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tillroll.llm.groups import Batches, by_group, components, local_roots, meeting_blocks
from tillroll.llm.words import SPACES, Words, gram_hashes, mixed, pieces
from tillroll.runtime import cut

RADIUS = 3
LEAF = 256
BLOCK = 4096

PRINTS = 6  # fingerprints of a wide print
SHINGLE = 5  # words
BAND = 21  # bits; three bands a fingerprint
SIMILAR = 0.8
APART = 68  # bits of 384. A similarity of 0.8 is an angle of acos(0.889): 58 bits in the mean, and one and a half deviations
WIDE_LEAF = 16_384
WIDE_BLOCK = 32_768
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprint(shingles: list[int]) -> int:
    """Bits set in over half of the 64-bit hashes, as a signed integer."""
    if not shingles:
        return 0
    bits = np.unpackbits(np.array(shingles, dtype="<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
    majority = bits.sum(axis=0, dtype=np.int64) * 2 > len(shingles)
    return int(np.packbits(majority, bitorder="little").view("<i8")[0])


def shingle_hashes(words: list[bytes], n: int = 3, seed: int = 42) -> list[int]:
    """XXH64 of every ``n`` consecutive words, of all words together where there are fewer."""
    if not words:
        return []
    text, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    if len(words) <= n:
        return [digest(text, seed)]
    return [digest(text[a:b], seed) for a, b in zip(starts.tolist(), (ends[n - 1 :] - 1).tolist())]  # noqa: B905


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fp) of every row. Null and empty texts have the fingerprint zero."""

    def run(batches: Batches) -> Batches:
        for batch in pieces(batches):
            out = []
            for t in batch.column("text").to_pylist():
                # bytes.lower and bytes.split know ASCII letters and ASCII white space only
                out.append(fingerprint(shingle_hashes((t or "").encode().lower().split())))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.int64())], ["key", "fp"])

    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = StructType([source.schema["key"], StructField("fp", LongType())])
    return source.mapInArrow(run, schema).withColumnRenamed("key", key)


def _half(column: str, half: int) -> F.Column:
    value = F.shiftrightunsigned(column, 32) if half else F.col(column)
    return value.bitwiseAND(0xFFFFFFFF)


def _radii(points: DataFrame, vantage: np.ndarray) -> np.ndarray:
    """Median distance to every vantage point in each half, from one aggregate with two rows of counts a level."""
    levels = vantage.shape[1]
    distances = [
        F.percentile_approx(F.bit_count(_half("fp", h).bitwiseXOR(int(vantage[h, i]))), 0.5, 1000)
        for h in (0, 1)
        for i in range(levels)
    ]
    return np.array(points.agg(*[d.alias(f"d{i}") for i, d in enumerate(distances)]).first()).reshape(2, levels)


def _shards(vantage: np.ndarray, radii: np.ndarray, reach: int):
    """Rows (half, leaf, fp) for a batch of fingerprints; band points are in more than one leaf."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            fp = np.asarray(batch.column("fp")).astype(np.int64)
            for half in (0, 1):
                value = (fp.view(np.uint64) >> np.uint64(32 * half)).astype(np.uint32)
                at, leaf = np.arange(len(fp)), np.ones(len(fp), dtype=np.int64)
                for v, m in zip(vantage[half], radii[half], strict=True):
                    d = np.bitwise_count(value[at] ^ np.uint32(v)).astype(np.int64)
                    band = (d > m) & (d <= m + reach)
                    at = np.concatenate((at, at[band]))
                    leaf = np.concatenate((leaf * 2 + (d > m), leaf[band] * 2))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), half, np.int32)), pa.array(leaf), pa.array(fp[at])], ["half", "leaf", "fp"]
                )

    return run


def _links(radius: int):
    def work(table: pa.Table) -> pa.Table:
        fp = np.unique(np.asarray(table.column("fp")))
        bits = fp.view(np.uint64)
        root = local_roots(lambda rows: np.bitwise_count(bits[rows, None] ^ bits[None, :]) <= radius, len(fp))
        tied = root != np.arange(len(fp))
        return pa.table({"a": fp[tied], "b": fp[root[tied]]})

    return work


def linked_fingerprints(points: DataFrame, radius: int = RADIUS, leaf: int = LEAF) -> DataFrame:
    """Links (a, b) that connect what pairs of distinct ``points`` (fp) within ``radius`` bits connect."""
    count = points.count()
    levels = max(1, math.ceil(math.log(max(count, 2) / leaf) / math.log(1 / 0.57))) if count > leaf else 1
    vantage = (mixed(np.arange(1, 2 * levels + 1, dtype=np.uint64)) & np.uint64(0xFFFFFFFF)).reshape(2, levels)
    radii = _radii(points, vantage) if count else np.zeros((2, levels))
    shards = points.mapInArrow(_shards(vantage, radii.astype(np.int64), radius // 2), "half int, leaf long, fp long")
    keys = ["half", "leaf"]
    blocks = meeting_blocks(cut(shards), keys, "fp", BLOCK).select(*keys, "block_a", "block_b", "fp")
    keys += ["block_a", "block_b"]
    dealt = blocks.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(by_group(keys, _links(radius)), "a long, b long")


def _components(marked: DataFrame, key: str, radius: int) -> DataFrame:
    """(fp, root, component_id) of every fingerprint of ``marked`` (key, fp): ``root`` names its component, which always has one."""
    classes = cut(marked.groupBy("fp").agg(F.min(key).alias("least")))
    roots = components(linked_fingerprints(classes.select("fp"), radius))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    rooted = cut(rooted)
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("fp", "root").join(smallest, "root").select("fp", "root", "component_id")


def simhash_components(docs: DataFrame, text: str = "text", key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """One row per document: ``key``, ``fp`` and ``component_id``, the smallest key that it reaches by links.

    Nulls: a null text counts as empty; a null key stays, and its component is the smallest other key, if any. Repeated rows
    and texts share a fingerprint. Other columns are not read. An empty table gives no rows.
    """
    marked = cut(fingerprints(docs, text, key))
    named = _components(marked, key, radius)
    return marked.join(named.drop("root"), "fp").select(key, "fp", "component_id")


# -- wide prints ----------------------------------------------------------------------------------------------------


def _majorities(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Bits set in over half of the hashes ``first[i]`` to ``first[i + 1]``, as unsigned integers; none set without hashes."""
    counts = np.zeros((len(first) - 1, 64), dtype=np.int64)
    filled = np.flatnonzero(np.diff(first))
    # Eight counters of a byte each are added at once, for 255 hashes at most.
    edges = np.unique(np.concatenate((first[filled], np.arange(0, len(hashes), 255))))
    group = np.searchsorted(first[filled], edges, side="right") - 1
    for at in range(0, len(edges), 256):
        inside = edges[at : at + 257]
        end = inside[256] if len(inside) > 256 else len(hashes)
        lanes = _SPREAD[hashes[inside[0] : end].view(np.uint8).reshape(-1, 8)]
        sums = np.add.reduceat(lanes, inside[:256] - inside[0], axis=0).view(np.uint8).reshape(-1, 64)
        np.add.at(counts, filled[group[at : at + 256]], sums)
    return np.packbits(counts * 2 > np.diff(first)[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts of a piece, and where each text's begin. Fewer words than a shingle has are one."""
    hashes, sizes = words.hashes(), np.diff(words.first)
    number = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    first = np.concatenate(([0], np.cumsum(number)))
    out = np.zeros(first[-1], dtype=np.uint64)
    grams = gram_hashes(hashes, SHINGLE)
    of = np.repeat(np.arange(len(sizes)), number)
    start = words.first[of] + np.arange(len(of)) - first[of]
    whole = sizes[of] >= SHINGLE
    out[whole] = grams[start[whole]]
    for i in np.flatnonzero(~whole):
        mine = hashes[start[i] : start[i] + sizes[of[i]]]
        out[i] = mixed(gram_hashes(mine, len(mine)) + np.uint64(len(mine)))[0]
    return out, first


def wide_prints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, wide) of every row: PRINTS fingerprints of the shingles of five words, in 48 bytes. Null and empty texts are all zeros."""
    seeds = mixed(np.arange(1, PRINTS + 1, dtype=np.uint64))

    def run(batches: Batches) -> Batches:
        for batch in pieces(batches):
            hashes, first = _shingles(Words(batch.column("text"), SPACES))
            prints = np.stack([_majorities(mixed(hashes ^ seed), first) for seed in seeds], axis=1)
            wide = pa.array([row.tobytes() for row in prints], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key"), wide], ["key", "wide"])

    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = StructType([source.schema["key"], StructField("wide", BinaryType())])
    return source.mapInArrow(run, schema).withColumnRenamed("key", key)


def _numbers(wide: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(wide.to_pylist()), dtype="<u8").reshape(-1, PRINTS)


def _band(prints: np.ndarray, band: int) -> np.ndarray:
    return ((prints[:, band // 3] >> np.uint64(BAND * (band % 3))) & np.uint64((1 << BAND) - 1)).astype(np.int64)


def _wide_shards(vantage: np.ndarray):
    """Rows (band, leaf, node, wide) for a batch of wide prints; ``vantage`` has a point for each level of each band's tree."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            prints = _numbers(batch.column("wide"))
            for band in range(3 * PRINTS):
                value = _band(prints, band)
                at, leaf = np.arange(len(value)), np.ones(len(value), dtype=np.int64)
                for v in vantage[band]:
                    # Half the distances of random bits are up to BAND // 2.
                    d = np.bitwise_count(value[at] ^ v).astype(np.int64) - BAND // 2
                    edge = d == 1
                    at = np.concatenate((at, at[edge]))
                    leaf = np.concatenate((leaf * 2 + (d > 0), leaf[edge] * 2))
                rows = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), band, np.int32)), pa.array(leaf), rows.column("node"), rows.column("wide")],
                    ["band", "leaf", "node", "wide"],
                )

    return run


def _unite(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the members ``a`` and ``b`` the smaller of their labels, which are the least member of a group each."""
    while len(a):
        high, low = np.maximum(labels[a], labels[b]), np.minimum(labels[a], labels[b])
        open_ = high != low
        a, b = a[open_], b[open_]
        np.minimum.at(labels, high[open_], low[open_])
        while not np.array_equal(jump := labels[labels], labels):
            labels[:] = jump


def _wide_links(table: pa.Table, apart: int = APART, most: int = 1 << 18) -> pa.Table:
    """Links that connect a shard's near pairs (within a bit in the band and ``apart`` bits in all), the nearest pairs of groups."""
    band = int(table.column("band")[0].as_py())
    prints = _numbers(table.column("wide"))
    value = _band(prints, band)
    order = np.argsort(value, kind="stable")
    prints, value, node = prints[order], value[order], np.asarray(table.column("node"))[order]
    labels = np.arange(len(value))
    kept: list[np.ndarray] = []

    def meet(a: np.ndarray, b: np.ndarray) -> None:
        new = labels[a] != labels[b]
        a, b = a[new], b[new]
        far = np.bitwise_count(prints[a] ^ prints[b]).sum(axis=1, dtype=np.int64)
        near = np.flatnonzero(far <= apart)
        near = near[np.argsort(far[near], kind="stable")]
        a, b = a[near], b[near]
        # The nearest pair of any two groups that meet here.
        groups = np.minimum(labels[a], labels[b]) * len(labels) + np.maximum(labels[a], labels[b])
        nearest = np.unique(groups, return_index=True)[1]
        kept.append(np.stack((a[nearest], b[nearest])))
        _unite(labels, a, b)

    beside = np.flatnonzero(value[1:] == value[:-1])
    meet(beside, beside + 1)
    values, first = np.unique(value, return_index=True)
    size = np.diff(np.append(first, len(value)))
    for flip in (0, *(1 << b for b in range(BAND))):
        at = np.minimum(np.searchsorted(values, values ^ flip), len(values) - 1)
        run = np.flatnonzero((values[at] == values ^ flip) & (values[at] >= values))
        other = at[run]
        # Runs of one value that are one group already, as of near copies, need no look at their pairs.
        low, high = np.minimum.reduceat(labels, first), np.maximum.reduceat(labels, first)
        todo = (low[run] != high[run]) | (low[other] != high[other]) | (low[run] != low[other])
        run, other = run[todo], other[todo]
        a = np.repeat(first[run], size[run]) + _steps(size[run])
        other = np.repeat(other, size[run])
        ends = np.cumsum(size[other])
        cuts = np.flatnonzero(np.diff(ends // most, prepend=0))
        for start, end in zip([0, *cuts], [*cuts, len(a)], strict=True):
            theirs = other[start:end]
            meet(np.repeat(a[start:end], size[theirs]), np.repeat(first[theirs], size[theirs]) + _steps(size[theirs]))
    pairs = np.concatenate(kept, axis=1)
    return pa.table({"a": node[pairs[0]], "b": node[pairs[1]]})


def _steps(sizes: np.ndarray) -> np.ndarray:
    """0 to size - 1 for every size."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def linked_prints(points: DataFrame, leaf: int = WIDE_LEAF) -> DataFrame:
    """Links (a, b) between nodes of ``points`` (node, wide), one node for a print, that connect what near pairs connect."""
    count = points.count()
    levels = math.ceil(math.log(count / leaf) / math.log(1 / 0.58)) if count > leaf else 0
    vantage = (mixed(np.arange(1, 3 * PRINTS * levels + 1, dtype=np.uint64)) & np.uint64((1 << BAND) - 1)).astype(np.int64)
    vantage = vantage.reshape(3 * PRINTS, levels)
    # Not written: shards are several times their points, which are, and a second look at these costs less.
    shards = points.mapInArrow(_wide_shards(vantage), "band int, leaf long, node long, wide binary")
    keys = ["band", "leaf"]
    blocks = meeting_blocks(shards, keys, "node", WIDE_BLOCK).select(*keys, "block_a", "block_b", "node", "wide")
    keys += ["block_a", "block_b"]
    dealt = blocks.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(by_group(keys, _wide_links), "a long, b long")


def _shingle_sets(batches: Batches) -> Batches:
    for batch in pieces(batches):
        hashes, first = _shingles(Words(batch.column("text"), SPACES))
        sets = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(first[:-1], first[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("of"), pa.array(sets, pa.list_(pa.int64()))], ["of", "shingles"])


def similar(links: DataFrame, texts: DataFrame, least: float = SIMILAR) -> DataFrame:
    """The rows of ``links`` (a, b) whose ``texts`` (of, text) share ``least`` of their distinct shingles of five words."""
    named = links.select(F.col("a").alias("of")).unionByName(links.select(F.col("b").alias("of"))).distinct()
    # Written, so that a node of many links can be split.
    linked = texts.join(named, "of", "left_semi").dropDuplicates(["of"])
    sets = cut(linked.mapInArrow(_shingle_sets, "of long, shingles array<long>"))
    both = links.join(sets.toDF("a", "of_a"), "a").join(sets.toDF("b", "of_b"), "b")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return both.where(shared >= least * (F.size("of_a") + F.size("of_b") - shared)).select("a", "b")


def _row(docs: DataFrame) -> F.Column:
    """Tells rows apart by id and text: an id may come with several texts."""
    return F.xxhash64(docs["doc_id"], docs["text"])


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component of the rows with an id: that of the smallest id, and of several texts of this id one.

    Texts link if their wide prints are equal, or near and the texts share 0.8 of their distinct shingles of five words. Rows of one id with texts that do not link are in components of their own and all stay. Of rows that repeat an id and a text one stays, the
    smallest in its other columns as JSON, which may have any type. A null text is empty and links with empty ones. Rows without an id cannot
    be named in a group: they stay. Columns stay as they are. An empty table gives no rows.
    """
    known = docs.where("doc_id IS NOT NULL")
    marked = cut(wide_prints(known.select(_row(known).alias("of"), "text"), key="of").distinct())
    classes = cut(marked.groupBy("wide").agg(F.min("of").alias("node")))
    texts = known.select(_row(known).alias("of"), F.col("text").cast("string").alias("text"))
    roots = components(similar(cut(linked_prints(classes).distinct()), texts))
    rooted = classes.join(roots, "node", "left").select("wide", F.coalesce("root", "node").alias("root"))
    ids = known.select(_row(known).alias("of"), F.col("doc_id").alias("id"))
    heads = ids.join(marked, "of").join(cut(rooted), "wide").groupBy("root").agg(F.min(F.struct("id", "of")).alias("head"))
    heads = cut(heads.select(F.col("head.id").alias("head_id"), F.col("head.of").alias("head_of")))
    kept = known.join(heads, (known["doc_id"] == heads["head_id"]) & (_row(known) == heads["head_of"]), "left_semi")
    whole = F.struct(*docs.columns)
    one = kept.groupBy(F.col("doc_id").alias("id"), _row(kept).alias("of")).agg(F.min_by(whole, F.to_json(whole)).alias("row"))
    return one.select("row.*").unionByName(docs.where("doc_id IS NULL"))
