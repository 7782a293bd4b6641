"""NTILE over all rows without sorting them in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tillroll.runtime import cut

_METRIC = "decimal(38,10)"


def _position(metric: str, descending: bool, key: Sequence[str]) -> Column:
    """A struct that sorts ascending the way (metric, key) should; nulls lead, or trail when descending."""
    value = F.col(metric).cast(_METRIC)
    missing = F.col(metric).isNull()
    return F.struct(
        (missing if descending else ~missing).cast("int").alias("nulls"),
        (-value if descending else value).cast(_METRIC).alias("value"),
        *key,
    )


def _literal(position: Row, key: Sequence[str]) -> Column:
    return F.struct(
        F.lit(position["nulls"]).cast("int").alias("nulls"),
        F.lit(position["value"]).cast(_METRIC).alias("value"),
        *[F.lit(position[c]).cast("string").alias(c) for c in key],
    )


def _tile_starts(rows: int, tiles: int) -> list[int]:
    """0-based rank at which tiles 2, 3, ... start; the first tiles take one extra row each."""
    size, extra = divmod(rows, tiles)
    starts = (j * size + min(j, extra) for j in range(1, tiles))
    return [s for s in starts if s < rows]


def _ranged(positions: DataFrame) -> DataFrame:
    """Positions dealt out in ranges of their order, with the number of the range, as a written table.

    Positions include the key, so equal metrics are split as well. Range numbers rise with the order.
    """
    ranged = positions.repartitionByRange("score", "position")
    return cut(ranged.withColumn("range", F.spark_partition_id()))


def add_tiles(
    df: DataFrame,
    scores: Mapping[str, tuple[str, bool]],
    key: Sequence[str],
    tiles: int = 5,
) -> DataFrame:
    """Add NTILE(tiles) columns: ``scores`` maps a new column to (numeric metric, descending).

    ``key`` columns are text, identify a row, and break ties. ``df`` is read a few times, so pass a frame that
    is cheap to read again.

    A tile number depends only on how a row compares with the rows at which the tiles start. Spark deals the
    positions out in ranges, a sort without its last step; the driver reads one count per range and knows which ranges hold a start
    and at what place. Only those are ranked, each in its task, and return the starts; then each row of ``df`` is compared with them
    and does not move. The plan is the same for any number of rows.
    """
    rows = df.count()
    starts = _tile_starts(rows, tiles)
    if not starts:
        return df.withColumns({score: F.lit(1) for score in scores})

    where = {score: _position(metric, descending, key) for score, (metric, descending) in scores.items()}
    each = F.array(*[F.struct(F.lit(n).alias("score"), p.alias("position")) for n, p in enumerate(where.values())])
    positions = df.select(F.inline(each))
    ranged = _ranged(positions)
    sizes: dict[int, list[tuple[int, int]]] = {}
    for row in ranged.groupBy("score", "range").count().orderBy("score", "range").collect():
        sizes.setdefault(row["score"], []).append((row["range"], row["count"]))

    names = list(scores)
    wanted = []
    for number, counts in sizes.items():
        ends = list(accumulate(count for _, count in counts))
        for start in starts:
            at = next(i for i, end in enumerate(ends) if start < end)
            wanted.append((number, counts[at][0], start - (ends[at] - counts[at][1]) + 1))
    in_wanted_range = F.struct("score", "range").isin(
        [F.struct(F.lit(s), F.lit(b)) for s, b in sorted({(s, b) for s, b, _ in wanted})]
    )
    is_start = F.struct("score", "range", "rank").isin(
        [F.struct(F.lit(s), F.lit(b), F.lit(r)) for s, b, r in wanted]
    )
    ranked = ranged.filter(in_wanted_range).withColumn(
        "rank", F.row_number().over(Window.partitionBy("score", "range").orderBy("position"))
    )
    found: dict[str, list[Row]] = {score: [] for score in scores}
    for row in ranked.filter(is_start).select("score", "position").collect():
        found[names[row["score"]]].append(row["position"])

    def tile(score: str) -> Column:
        reached = [(where[score] >= _literal(p, key)).cast("int") for p in found[score]]
        return sum(reached, F.lit(1))

    return df.withColumns({score: tile(score) for score in scores})
