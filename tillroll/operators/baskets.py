"""Baskets, frequent itemsets, rules and pair counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import columns as C
from tillroll.operators.products import descriptions
from tillroll.runtime import cut

_MIN_ITEMS = 2


def _occurrences(lines: DataFrame) -> DataFrame:
    """Distinct (InvoiceNo, StockCode). Both columns are the shuffle key, so a huge invoice is spread out."""
    return lines.select("InvoiceNo", "StockCode").distinct()


def baskets(lines: DataFrame) -> DataFrame:
    """Invoices with at least two different stock codes, as sorted arrays (B1)."""
    collected = _occurrences(lines).groupBy("InvoiceNo").agg(F.array_sort(F.collect_list("StockCode")).alias("items"))
    return collected.filter(F.size("items") >= _MIN_ITEMS)


def basket_segments(lines: DataFrame, most: int = 4096) -> DataFrame:
    """The baskets of ``baskets`` in numbered segments: InvoiceNo, Width (codes of the invoice), Segment and items, a sorted array.

    Codes are dealt to ceil(2 * Width / most) segments by a hash, so an array holds about ``most`` / 2 of them however wide its invoice is, and the invoice is
    the work of many tasks. ``whole_baskets`` puts them together for readers that need whole arrays.
    """
    occurrences = cut(_occurrences(lines))
    widths = occurrences.groupBy("InvoiceNo").agg(F.count("*").alias("Width")).filter(F.col("Width") >= _MIN_ITEMS)
    parts = F.when(F.col("Width") <= most, 1).otherwise(F.ceil(2 * F.col("Width") / most))
    placed = occurrences.join(cut(widths), "InvoiceNo").withColumn("Segment", F.pmod(F.xxhash64("StockCode"), parts).cast("int"))
    return placed.groupBy("InvoiceNo", "Width", "Segment").agg(F.array_sort(F.collect_list("StockCode")).alias("items"))


def whole_baskets(segments: DataFrame) -> DataFrame:
    """Baskets as one sorted array each, from ``basket_segments``. A narrow invoice is one segment already and does not move."""
    whole = segments.filter(F.size("items") == F.col("Width")).select("InvoiceNo", "items")
    parts = segments.filter(F.size("items") < F.col("Width")).groupBy("InvoiceNo")
    return whole.unionByName(parts.agg(F.array_sort(F.flatten(F.collect_list("items"))).alias("items")))


def mining_baskets(lines: DataFrame, min_support: float) -> DataFrame:
    """The baskets of ``baskets`` without stock codes that are too rare to be in any frequent itemset.

    A frequent code is in at least ``min_support`` of the baskets, so there are at most (mean basket size /
    min_support) of them. That bounds every array, whatever the largest invoice holds, and the frequent codes.
    Baskets left empty stay, so supports keep their denominator. Occurrences are made distinct once; they and both aggregates are written
    before they are joined, so that adaptive execution can split a code or an invoice with very many lines.
    """
    occurrences = cut(_occurrences(lines))
    sizes = occurrences.groupBy("InvoiceNo").agg(F.count("*").alias("items_bought"))
    eligible = cut(sizes.filter(F.col("items_bought") >= _MIN_ITEMS).select("InvoiceNo"))
    bought = occurrences.join(eligible, "InvoiceNo", "left_semi")
    least = F.ceil(F.lit(min_support) * eligible.agg(F.count("*")).scalar())
    frequent = bought.groupBy("StockCode").agg(F.count("*").alias("found")).filter(F.col("found") >= least)
    kept = bought.join(cut(frequent), "StockCode", "left_semi")
    collected = kept.groupBy("InvoiceNo").agg(F.array_sort(F.collect_list("StockCode")).alias("items"))
    empty = F.array().cast("array<string>")
    return eligible.join(collected, "InvoiceNo", "left").withColumn("items", F.coalesce("items", empty))


@dataclass(frozen=True)
class Mined:
    """Itemsets (items, freq) and rules (antecedent, consequent, confidence, lift, support)."""

    itemsets: DataFrame
    rules: DataFrame


def mine(
    lines: DataFrame, min_support: float = 0.01, min_confidence: float = 0.3, partitions: int | None = None
) -> Mined:
    """Frequent itemsets and association rules by FP-Growth.

    Arrays are written out before mining, because the algorithm reads them more than once.
    """
    growth = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence)
    if partitions is not None:
        growth = growth.setNumPartitions(partitions)
    model = growth.fit(cut(mining_baskets(lines, min_support).select("items")))
    return Mined(model.freqItemsets, model.associationRules)


def _codes(top: DataFrame, *columns: str) -> DataFrame:
    return top.select(F.explode(F.array(*columns)).alias("StockCode")).distinct()


def _describe(top: DataFrame, lines: DataFrame, names: dict[str, str]) -> DataFrame:
    """Left-join descriptions for each code column (J2). ``top`` and the descriptions are written tables of known size."""
    known = cut(descriptions(lines, _codes(top, *names)))
    for code, text in names.items():
        labelled = known.select(F.col("StockCode").alias(code), F.col("Description").alias(text))
        top = top.join(labelled, code, "left")
    return top


def item_pairs(itemsets: DataFrame, lines: DataFrame, top_n: int = 100) -> DataFrame:
    """Most frequent pairs, each code in text order, with descriptions.

    Support is relative to the most frequent itemset, not to the number of baskets.
    """
    largest = itemsets.agg(F.max("freq")).scalar()
    codes = F.array_sort("items")
    top = (
        itemsets.filter(F.size("items") == 2)
        .select(
            F.get(codes, 0).alias("StockCode1"),
            F.get(codes, 1).alias("StockCode2"),
            F.col("freq").alias("CoOccurrence"),
            C.count_ratio(F.col("freq"), largest, 4).alias("Support"),
        )
        .orderBy(F.desc("CoOccurrence"), "StockCode1", "StockCode2")
        .limit(top_n)
    )
    named = _describe(cut(top), lines, {"StockCode1": "Description1", "StockCode2": "Description2"})
    return named.select(
        "StockCode1", "Description1", "StockCode2", "Description2", "CoOccurrence", "Support"
    ).orderBy(F.desc("CoOccurrence"), "StockCode1", "StockCode2")


def product_rules(rules: DataFrame, lines: DataFrame, top_n: int = 100) -> DataFrame:
    """Strongest rules from one product to another, with descriptions."""
    order: list[str | Column] = [F.desc("Confidence"), F.desc("Lift"), "SourceProduct", "RecommendedProduct"]
    top = (
        rules.filter(F.size("antecedent") == 1)
        .select(
            F.get("antecedent", 0).alias("SourceProduct"),
            F.get("consequent", 0).alias("RecommendedProduct"),
            *[F.round(name.lower(), 4).alias(name) for name in ("Confidence", "Lift", "Support")],
        )
        .orderBy(*order)
        .limit(top_n)
    )
    names = {"SourceProduct": "SourceDescription", "RecommendedProduct": "RecommendedDescription"}
    return _describe(cut(top), lines, names).orderBy(*order)


def _joined_pairs(rows: DataFrame, *on: str) -> DataFrame:
    """Pairs of codes within the groups given by ``on``, with the product of their line counts summed."""
    a, b = rows.alias("a"), rows.alias("b")
    same = F.col("a.StockCode") < F.col("b.StockCode")
    for column in on:
        same &= F.col(f"a.{column}") == F.col(f"b.{column}")
    return _summed(a.join(b, same))


def _summed(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(F.col("a.StockCode").alias("Product1"), F.col("b.StockCode").alias("Product2")).agg(
        F.sum(F.col("a.lines") * F.col("b.lines")).alias("Frequency"),
        F.min(F.least("a.wide_bound", "b.wide_bound")).alias("wide_bound"),
    )


def _paired_rows(lines: DataFrame, more_than: int, wide_basket: int) -> DataFrame:
    """Line counts per (invoice, code) with the invoice's width and the code's bounds; hopeless codes are left out.

    ``peak`` being the largest line count in an invoice, sum(lines x peak) bounds the frequency of every pair of a
    code: ``bound`` over all invoices, ``wide_bound`` over those wider than ``wide_basket`` codes.
    """
    known = lines.filter(F.col("InvoiceNo").isNotNull() & F.col("StockCode").isNotNull())
    bought = cut(known.groupBy("InvoiceNo", "StockCode").agg(F.count("*").alias("lines")))
    invoices = (
        bought.groupBy("InvoiceNo")
        .agg(F.count("*").alias("width"), F.max("lines").alias("peak"))
        .filter(F.col("width") >= _MIN_ITEMS)
    )
    sized = bought.join(cut(invoices), "InvoiceNo")
    most = F.col("lines") * F.col("peak")
    in_wide = F.when(F.col("width") > wide_basket, most).otherwise(0)
    bounds = (
        sized.groupBy("StockCode")
        .agg(F.sum(most).alias("bound"), F.sum(in_wide).alias("wide_bound"))
        .filter(F.col("bound") > more_than)
    )
    columns = ("InvoiceNo", "StockCode", "lines", "width", "bound", "wide_bound")
    return cut(sized.join(cut(bounds), "StockCode").select(*columns))


def _counted_pairs(rows: DataFrame, more_than: int, wide_basket: int, lane_items: int) -> DataFrame:
    """Pairs of ``_paired_rows`` above a frequency, exact; see ``pair_frequencies``."""
    rows = rows.filter(F.col("bound") > more_than)
    is_wide = F.col("width") > wide_basket
    wide = rows.filter(is_wide)
    total = _joined_pairs(rows.filter(~is_wide).select("InvoiceNo", "StockCode", "lines", "wide_bound"), "InvoiceNo")
    seen = cut(total)
    gains = _heavy_wide_pairs(wide, more_than, lane_items).unionByName(_wide_lookups(seen, wide, more_than))
    total = seen.unionByName(gains).groupBy("Product1", "Product2").agg(F.sum("Frequency").alias("Frequency"))
    return total.filter(F.col("Frequency") > more_than).select("Product1", "Product2", "Frequency")


def pair_frequencies(
    lines: DataFrame, more_than: int = 50, wide_basket: int = 1000, lane_items: int = 500
) -> DataFrame:
    """Pairs of codes bought together on more than ``more_than`` pairs of lines (J3, exact).

    A repeated line counts again, so a pair's frequency is the sum over invoices of (lines of one code x lines
    of the other). Work is kept down without losing a pair:

    * lines are counted per (invoice, code) first, so repeats do not multiply rows;
    * codes whose bound is too small are dropped;
    * invoices wider than ``wide_basket`` codes are not paired in full. A pair can gain from them at most the
      smaller of its two codes' bounds over wide invoices. If that alone is not enough, the pair must also occur
      in a narrow invoice, and only pairs seen there are looked up in the wide ones. Pairs of codes that are both
      heavy in wide invoices are joined there directly, in lanes of ``lane_items`` codes so that one invoice is
      shared by many tasks.
    """
    rows = _paired_rows(lines, more_than, wide_basket)
    return _counted_pairs(rows, more_than, wide_basket, lane_items)


def _heavy_wide_pairs(wide: DataFrame, more_than: int, lane_items: int) -> DataFrame:
    """Pairs within wide invoices of codes whose wide bound is large enough by itself."""
    lanes = F.ceil(F.col("width") / lane_items).cast("int")
    heavy = wide.filter(F.col("wide_bound") > more_than).withColumn("lanes", lanes)
    a = heavy.withColumn("lane", F.pmod(F.hash("StockCode"), F.col("lanes"))).alias("a")
    b = heavy.withColumn("lane", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1))).alias("b")
    same = (
        (F.col("a.InvoiceNo") == F.col("b.InvoiceNo"))
        & (F.col("a.lane") == F.col("b.lane"))
        & (F.col("a.StockCode") < F.col("b.StockCode"))
    )
    return _summed(a.join(b, same))


def _wide_lookups(seen: DataFrame, wide: DataFrame, more_than: int) -> DataFrame:
    """What pairs seen in narrow invoices gain from wide ones, when one of their codes is not heavy there."""
    bound = F.col("wide_bound")
    open_pairs = seen.filter((bound > 0) & (bound <= more_than) & (F.col("Frequency") + bound > more_than))
    a = wide.select("InvoiceNo", F.col("StockCode").alias("Product1"), F.col("lines").alias("lines1"))
    b = wide.select("InvoiceNo", F.col("StockCode").alias("Product2"), F.col("lines").alias("lines2"))
    return (
        open_pairs.select("Product1", "Product2", "wide_bound")
        .join(a, "Product1")
        .join(b, ["InvoiceNo", "Product2"])
        .groupBy("Product1", "Product2")
        .agg(F.sum(F.col("lines1") * F.col("lines2")).alias("Frequency"), F.min("wide_bound").alias("wide_bound"))
    )


def _nth_frequency(rows: DataFrame, more_than: int, top_n: int, seed_codes: int) -> int | None:
    """A frequency that at least ``top_n`` pairs reach: the n-th best among the codes with the largest bounds.

    Few codes take part, so no invoice adds more than seed_codes^2 / 2 pairs.
    """
    codes = rows.select("StockCode", "bound").distinct().orderBy(F.desc("bound"), "StockCode").limit(seed_codes)
    among = rows.join(F.broadcast(codes.select("StockCode")), "StockCode", "left_semi")
    best = _joined_pairs(among, "InvoiceNo").filter(F.col("Frequency") > more_than)
    reached = best.orderBy(F.desc("Frequency")).limit(top_n).agg(F.count("*").alias("n"), F.min("Frequency").alias("f"))
    found = reached.first()
    return found["f"] if found["n"] == top_n else None


def top_line_pairs(
    lines: DataFrame,
    more_than: int = 50,
    top_n: int = 100,
    wide_basket: int = 1000,
    lane_items: int = 500,
    seed_codes: int = 200,
) -> DataFrame:
    """The most frequent pairs of ``pair_frequencies``.

    The codes with the largest bounds are paired first. What their n-th best pair reaches is a floor for the
    result, and all codes and pairs that cannot reach it are left out of the full count.
    """
    rows = _paired_rows(lines, more_than, wide_basket)
    floor = _nth_frequency(rows, more_than, top_n, seed_codes)
    pairs = _counted_pairs(rows, more_than if floor is None else floor - 1, wide_basket, lane_items)
    return pairs.orderBy(F.desc("Frequency"), "Product1", "Product2").limit(top_n)
