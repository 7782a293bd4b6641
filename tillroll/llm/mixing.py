"""Mixing sources to target word counts by pivotal dependent rounding.

Every document of a source is wanted the same number of times: target words over the source's words. The whole part is taken
outright; the fraction is rounded by pivotal steps. A step pairs two documents and moves expected words from one to the other, in a
random direction with the probabilities that keep both expectations, until one fraction is 0 or 1. Sums of
expected words never change, so a source ends within one document of its target.

Steps run in a reduction tree: documents are dealt by hash into small chunks, every chunk is folded to at most one document that is still
fractional, and these residuals are dealt and folded again until a source has one. A document that holds over a
thousandth of its source's words would leave a large last residual. These, under a thousand for any source, are folded first, by falling size;
what their rounding adds or lacks is then spread over the other documents of the source before those are folded. Everything is
DataFrame operations; random numbers are hashes of ids, so reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tillroll.runtime import cut

SHARE = 1.5  # words taken, as a share of all words
MOST = 2.0  # copies of a source at most
WEIGHTS = (3.0, 1.0, 2.0)
CHUNK = 32
SALTS = 64
LARGE = 1000  # a document of over 1 / LARGE of its source's words is folded first
_NOT_SPACE = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(_NOT_SPACE)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """Number sources (source, ...) from 0 by code point, null last, without a sort in one task: ranges are sorted apart and
    the sizes of the earlier ranges, one row a partition, are added."""
    null_last = F.col("source").isNull().cast("int")
    placed = sources.repartitionByRange(null_last, F.col("source")).withColumn("range", F.spark_partition_id())
    placed = cut(placed)
    sizes = sorted(placed.groupBy("range").count().collect())
    offsets, total = [], 0
    for part, count in sizes:
        offsets.append((part, total))
        total += count
    starts = sources.sparkSession.createDataFrame(offsets or [(0, 0)], "range int, offset long")
    inside = F.row_number().over(_window("range").orderBy(null_last, "source")) - 1
    return placed.withColumn("inside", inside).join(F.broadcast(starts), "range").withColumn(
        "rank", F.col("offset") + F.col("inside")
    ).drop("range", "inside", "offset")


def _window(*by: str) -> WindowSpec:
    return Window.partitionBy(*by)


def targets(sources: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Add ``target`` to sources (source, source_size): shares by weight, stopped at ``most`` times the size, the excess
    reshared by weight among the others until none is above. A round is one aggregate; it returns two sums."""
    cases = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    weighed = cut(ranked(sources).withColumn("weight", cases).drop("rank"))
    total = (weighed.agg(F.sum("source_size")).first()[0] or 0) * share
    level, cap = 0.0, F.col("source_size") * most
    while True:
        stopped = cap <= F.col("weight") * level
        fixed, open_weight = weighed.agg(
            F.sum(F.when(stopped, cap).otherwise(0.0)), F.sum(F.when(~stopped, F.col("weight")).otherwise(0.0))
        ).first()
        new = (total - (fixed or 0.0)) / open_weight if open_weight else math.inf
        if new <= level or math.isinf(new):
            level = new if math.isinf(new) else level
            break
        level = new
    if math.isinf(level):
        return weighed.select("source", "source_size", cap.alias("target"))
    return weighed.select("source", "source_size", F.least(cap, F.col("weight") * level).alias("target"))


# -- pivotal steps --------------------------------------------------------------------------------------------------

_ITEM = "struct<doc:{key},nth:bigint,size:bigint,p:double>"
_DONE = "array<struct<doc:{key},nth:bigint,size:bigint,p:double>>"
_FACTS = "struct<source_size:bigint,target:double,taken:bigint>"


def _random(item: Column, seed: Column) -> Column:
    """Uniform in [0, 1), from the ids of a document and a seed."""
    return F.pmod(F.xxhash64(seed, item["doc"], item["nth"]), F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def _with_p(item: Column, p: Column) -> Column:
    return F.struct(item["doc"].alias("doc"), item["nth"].alias("nth"), item["size"].alias("size"), p.alias("p"))


def _pivot(a: Column, b: Column, seed: Column) -> tuple[Column, Column]:
    """One step on the fractional items a and b: (the one that is now 0 or 1, the one that may still be fractional)."""
    up = F.least((1 - a["p"]) * a["size"], b["p"] * b["size"])  # words that can move from b to a
    down = F.least(a["p"] * a["size"], (1 - b["p"]) * b["size"])
    gains = _random(b, seed) < down / (up + down)
    moved = F.when(gains, up).otherwise(-down)
    to_a, to_b = a["p"] + moved / a["size"], b["p"] - moved / b["size"]
    a_done = F.when(gains, (1 - a["p"]) * a["size"] <= b["p"] * b["size"]).otherwise(
        a["p"] * a["size"] <= (1 - b["p"]) * b["size"]
    )
    ended = F.when(a_done, _with_p(a, F.round(to_a))).otherwise(_with_p(b, F.round(to_b)))
    return ended, F.when(a_done, _with_p(b, to_b)).otherwise(_with_p(a, to_a))


def _open(p: Column) -> Column:
    return (p > 1e-9) & (p < 1 - 1e-9)


def _fold(items: Column, key: str, seed: Column) -> Column:
    """Fold an array of items to (done: items of fraction 0 or 1, left: the fractional one or null)."""
    none = F.lit(None).cast(_ITEM.format(key=key))
    start = F.struct(F.array().cast(_DONE.format(key=key)).alias("done"), none.alias("left"))

    def step(state: Column, item: Column) -> Column:
        ended, left = _pivot(state["left"], item, seed)
        closed = F.struct(F.concat(state["done"], F.array(_with_p(item, F.round(item["p"])))).alias("done"), state["left"].alias("left"))
        first = F.struct(state["done"].alias("done"), item.alias("left"))
        paired = F.struct(F.concat(state["done"], F.array(ended)).alias("done"), left.alias("left"))
        return F.when(~_open(item["p"]), closed).when(state["left"].isNull(), first).when(
            ~_open(state["left"]["p"]),
            F.struct(F.concat(state["done"], F.array(_with_p(state["left"], F.round(state["left"]["p"])))).alias("done"), item.alias("left")),
        ).otherwise(paired)

    return F.aggregate(items, start, step)


def _fold_large(items: Column, key: str, rest: Column, wanted: Column) -> Column:
    """Fold the large documents of a source by falling size; returns (done, wanted: words still to take from the rest).

    A pair of documents of like size takes a pivotal step. A residual over twice the next document's size is rounded
    at random, and the words that this adds or lacks change the fraction of all smaller documents.
    """
    none = F.lit(None).cast(_ITEM.format(key=key))
    start = F.struct(
        F.array().cast(_DONE.format(key=key)).alias("done"), none.alias("left"), wanted.alias("wanted"), rest.alias("rest")
    )

    def settled(state: Column) -> tuple[Column, Column]:
        """The residual rounded, and the words wanted from the documents after it."""
        item = state["left"]
        # Rounding up must leave at least nothing to want, rounding down no more than there is.
        must = state["wanted"] + item["p"] * item["size"] > state["rest"]
        cannot = state["wanted"] + (item["p"] - 1) * item["size"] < 0
        up = F.when(must & ~cannot, True).when(cannot & ~must, False).otherwise(_random(item, F.lit(3)) < item["p"])
        bit = F.when(up, 1.0).otherwise(0.0)
        return _with_p(item, bit), state["wanted"] + (item["p"] - bit) * item["size"]

    def step(state: Column, item: Column) -> Column:
        flushed, wanted_after = settled(state)
        flush = state["left"].isNotNull() & (state["left"]["size"] > 2 * item["size"])
        base = F.when(flush, wanted_after).otherwise(state["wanted"])
        p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), base / F.greatest(state["rest"], F.lit(1.0))))
        fresh = _with_p(item, p)
        wanted_now, rest_now = base - p * item["size"], state["rest"] - item["size"]
        ended, left = _pivot(state["left"], fresh, F.lit(5))

        def after(done: Column, residual: Column) -> Column:
            return F.struct(done.alias("done"), residual.alias("left"), wanted_now.alias("wanted"), rest_now.alias("rest"))

        closed = F.concat(state["done"], F.array(_with_p(item, F.round(p))))
        return (
            F.when(flush, after(F.concat(state["done"], F.array(flushed)), fresh))
            .when(state["left"].isNull(), after(state["done"], fresh))
            .when(~_open(p), after(closed, state["left"]))
            .when(
                ~_open(state["left"]["p"]),
                after(F.concat(state["done"], F.array(_with_p(state["left"], F.round(state["left"]["p"])))), fresh),
            )
            .otherwise(after(F.concat(state["done"], F.array(ended)), left))
        )

    def end(state: Column) -> Column:
        last, wanted_after = settled(state)
        return F.when(
            state["left"].isNull(), F.struct(state["done"].alias("done"), state["wanted"].alias("wanted"))
        ).otherwise(F.struct(F.concat(state["done"], F.array(last)).alias("done"), wanted_after.alias("wanted")))

    return F.aggregate(items, start, step, end)


def rounded(fractions: DataFrame, key: str) -> DataFrame:
    """(source, doc, nth, size, p) of the rows (source, doc, nth, size, p, chunks), p now 0 or 1, by the reduction tree.

    ``chunks`` is the number of chunks of the row's source at the first level; a level has a chunk for every CHUNK chunks of the level before.
    """
    done, level, left = [], 0, fractions
    widest = fractions.agg(F.max("chunks")).first()[0] or 0
    while widest:
        chunk = F.pmod(F.xxhash64(F.lit(100 + level), "doc", "nth"), F.col("chunks"))
        folded = left.groupBy("source", "chunks", chunk.alias("chunk")).agg(
            F.array_sort(F.collect_list(F.struct("doc", "nth", "size", "p"))).alias("items")
        )
        folded = cut(folded.select("source", "chunks", _fold(F.col("items"), key, F.lit(200 + level)).alias("f")))
        done.append(folded.select("source", F.inline("f.done")))
        left = folded.where("f.left IS NOT NULL").select(
            "source", F.ceil(F.col("chunks") / CHUNK).alias("chunks"), "f.left.*"
        )
        if widest == 1:
            break
        widest, level = math.ceil(widest / CHUNK), level + 1
    last = F.struct("doc", "nth", "size", "p")
    bit = F.when(_random(last, F.lit(9)) < F.col("p"), 1.0).otherwise(0.0)
    done.append(left.select("source", "doc", "nth", "size", bit.alias("p")))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _with_source(frame: DataFrame, facts: DataFrame) -> DataFrame:
    """Join facts by source. A source may hold a third of the documents, so each is dealt to SALTS keys by document."""
    facts = facts.withColumnRenamed("source", "of").withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = frame.withColumn("salt", F.pmod(F.xxhash64(F.lit(1), "doc", "nth"), F.lit(SALTS)).cast("int"))
    return salted.join(facts, F.col("source").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("of_salt"))).drop("of", "of_salt", "salt")


def mixed(docs: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, source, nth, size, source_size, target, taken.

    ``nth`` numbers rows that are equal in doc_id, source and size; these are interchangeable. Nulls: a null text has size 0, null is a
    source of its own, a null id is an id like any other. Documents of size 0 are taken 0 words. Other columns are not
    read. An empty table gives no rows; if no document has words, all targets are 0.
    """
    key = docs.schema["doc_id"].dataType.simpleString()
    sized = docs.select(F.col("doc_id").alias("doc"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    repeats = sized.groupBy("doc", "source", "size").count()
    rows = cut(repeats.select("doc", "source", "size", F.explode(F.sequence(F.lit(1).cast("long"), "count")).alias("nth")))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    goals = targets(sizes.select("source", "source_size"), share, most, weights)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = goals.join(sizes.select(F.col("source").alias("s"), "rows"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    goals = cut(goals.withColumn("whole", F.floor(ratio + 1e-12)).withColumn("frac", F.greatest(F.lit(0.0), ratio - F.col("whole"))))

    large = F.col("size") * LARGE >= F.col("source_size")
    open_rows = _with_source(rows.where("size > 0"), goals.select("source", "source_size", "frac"))
    by_size = F.array_sort(
        F.collect_list(F.struct((-F.col("size")).alias("order"), "doc", "nth", "size", F.lit(0.0).alias("p")))
    )
    heavy = open_rows.where(large).groupBy("source", "source_size", "frac").agg(by_size.alias("items"))
    items = F.transform("items", lambda i: _with_p(i, i["p"]))
    whole_size = F.col("source_size").cast("double")
    heavy = cut(heavy.select("source", _fold_large(items, key, whole_size, F.col("frac") * whole_size).alias("f")))
    heavy_rows = heavy.select("source", F.inline("f.done"))
    heavy_size = heavy_rows.groupBy("source").agg(F.sum("size").alias("heavy_size"))
    rest = heavy.select("source", F.col("f.wanted").alias("wanted")).join(
        heavy_size.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))
    ).drop("s").withColumnRenamed("source", "s")
    light_size = F.col("source_size") - F.coalesce("heavy_size", F.lit(0))
    light_p = F.when(light_size > 0, F.coalesce("wanted", F.col("frac") * F.col("source_size")) / light_size).otherwise(0.0)
    light = goals.join(rest, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source",
        "source_size",
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), light_p)).alias("p"),
        F.ceil(F.col("rows") / CHUNK).alias("chunks"),
    )
    light_rows = _with_source(rows.where("size > 0"), light).where(~large)
    bits = rounded(light_rows.select("source", "doc", "nth", "size", "p", "chunks"), key)
    columns = ("source", "doc", "nth", "size", "p")
    idle = rows.where("size = 0").withColumn("p", F.lit(0.0))
    every = bits.select(*columns).unionByName(heavy_rows.select(*columns)).unionByName(idle.select(*columns))
    taken = (F.col("size") * (F.col("whole") + F.round("p").cast("long"))).cast("long")
    named = _with_source(every, goals.select("source", "source_size", "target", "whole"))
    return named.select(F.col("doc").alias("doc_id"), "source", "nth", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with all columns and mix_size, mix_source_size, mix_target, mix_taken.

    Nulls: a null text or one without words is never taken; null ids and sources are values like others. Rows that are equal in id, source and size are
    numbered by their other columns, so ties go the same way in each run; repeated rows are taken each for itself. A column of ``docs`` that is
    named like an added one stays, and the added one gets a trailing underscore. Columns may have any type. An empty table gives no rows.
    """
    rest = [F.col(c) for c in docs.columns if c not in ("doc_id", "source", "text")]
    whole = docs.select(
        F.struct(*docs.columns).alias("row"), "doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
        F.xxhash64("text").alias("content"), F.to_json(F.struct(*rest)).alias("others") if rest else F.lit("").alias("others"),
        F.lit(None).cast("long").alias("nth"), F.lit(None).cast(_FACTS).alias("facts"),
    )
    chosen = mixed(docs.select("doc_id", "text", "source")).where("taken > 0").select(
        F.lit(None).cast(whole.schema["row"].dataType).alias("row"), "doc_id", "source", "size", F.lit(None).cast("long").alias("content"),
        F.lit(None).cast("string").alias("others"), "nth", F.struct("source_size", "target", "taken").alias("facts"),
    )
    # Dealt out by the columns that rows and facts share, which both windows take as it is, so a text moves once; a join would move it again.
    same = ("doc_id", "source", "size")
    both = whole.unionByName(chosen).repartition(*same)
    counted = F.row_number().over(_window(*same, "is_row").orderBy("content", "others")).cast("long")
    both = both.withColumn("is_row", F.col("row").isNotNull()).withColumn("nth", F.when(F.col("is_row"), counted).otherwise(F.col("nth")))
    facts = F.first("facts", ignorenulls=True).over(_window(*same, "nth"))
    added = []
    for column in ("size", "source_size", "target", "taken"):
        name = f"mix_{column}"
        while name in docs.columns:
            name += "_"
        added.append(F.col("size" if column == "size" else f"taken_as.{column}").alias(name))
    return both.withColumn("taken_as", facts).where("is_row AND taken_as IS NOT NULL").select("row.*", *added)
