import itertools
import random
from collections import Counter

import pytest

from tillroll.operators import baskets

HAND = [("1", "ab"), ("2", "abc"), ("3", "ac"), ("4", "de"), ("5", "a")]


def frame(spark, invoices):
    rows = [(i, c, f"name {c}") for i, codes in invoices for c in codes]
    return spark.createDataFrame(rows, "InvoiceNo string, StockCode string, Description string")


def brute_force(invoices, more_than):
    found = Counter()
    for _, codes in invoices:
        n = Counter(codes)
        for a, b in itertools.combinations(sorted(n), 2):
            found[a, b] += n[a] * n[b]
    return {pair: f for pair, f in found.items() if f > more_than}


def test_baskets_of_one_item_are_dropped(spark):
    found = {r.InvoiceNo: r["items"] for r in baskets.baskets(frame(spark, HAND + [("6", "bb")])).collect()}
    assert found == {"1": ["a", "b"], "2": ["a", "b", "c"], "3": ["a", "c"], "4": ["d", "e"]}


def test_itemsets_and_rules_by_hand(spark):
    mined = baskets.mine(frame(spark, HAND), 0.25, 0.3)
    sets = {"".join(sorted(r["items"])): r.freq for r in mined.itemsets.collect()}
    assert sets == {"a": 3, "b": 2, "c": 2, "d": 1, "e": 1, "ab": 2, "ac": 2, "bc": 1, "abc": 1, "de": 1}
    rules = {("".join(r.antecedent), r.consequent[0]): r for r in mined.rules.collect()}
    rule = rules["b", "a"]
    assert (rule.confidence, round(rule.lift, 6), rule.support) == (1.0, round(4 / 3, 6), 0.5)
    assert all(0 <= r.confidence <= 1 for r in rules.values())


def test_rare_items_leave_the_mining_baskets_but_baskets_are_still_counted(spark):
    kept = {r.InvoiceNo: r["items"] for r in baskets.mining_baskets(frame(spark, HAND), 0.5).collect()}
    assert kept == {"1": ["a", "b"], "2": ["a", "b", "c"], "3": ["a", "c"], "4": []}
    mined = baskets.mine(frame(spark, HAND), 0.5, 0.3)
    assert {"".join(sorted(r["items"])): r.freq for r in mined.itemsets.collect()} == {
        "a": 3, "b": 2, "c": 2, "ab": 2, "ac": 2
    }


def test_pair_support_is_relative_to_the_largest_itemset(spark):
    lines = frame(spark, HAND)
    pairs = baskets.item_pairs(baskets.mine(lines, 0.25, 0.3).itemsets, lines).collect()
    assert tuple(pairs[0]) == ("a", "name a", "b", "name b", 2, 0.6667)
    assert len(pairs) == 4


def test_top_rules_are_described(spark):
    lines = frame(spark, HAND)
    rows = baskets.product_rules(baskets.mine(lines, 0.25, 0.3).rules, lines, top_n=3).collect()
    assert [(r.SourceProduct, r.RecommendedProduct) for r in rows[:2]] == [("d", "e"), ("e", "d")]
    assert rows[0].SourceDescription == "name d" and rows[0].Lift == 4.0 and len(rows) == 3


def test_repeated_lines_multiply(spark):
    found = baskets.pair_frequencies(frame(spark, [("1", "aabbb"), ("2", "ab")]), more_than=6).collect()
    assert [tuple(r) for r in found] == [("a", "b", 7)]
    assert baskets.pair_frequencies(frame(spark, [("1", "aabbb"), ("2", "ab")]), more_than=7).isEmpty()


@pytest.mark.parametrize(("more_than", "wide_basket"), [(0, 5), (1, 2), (3, 5), (8, 2), (8, 1000)])
def test_pairs_equal_brute_force_with_one_invoice_holding_a_third_of_the_lines(spark, more_than, wide_basket):
    dice = random.Random(more_than * 7 + wide_basket)
    codes = "abcdefghijklmnopqrstuvwxyz"
    invoices = [(str(i), [dice.choice(codes[:12]) for _ in range(dice.randrange(1, 9))]) for i in range(60)]
    invoices += [(f"wide{i}", dice.sample(codes, 14)) for i in range(4)]
    invoices += [("huge", [dice.choice(codes) for _ in range(150)])]
    found = baskets.pair_frequencies(frame(spark, invoices), more_than, wide_basket=wide_basket, lane_items=3)
    assert {(r.Product1, r.Product2): r.Frequency for r in found.collect()} == brute_force(invoices, more_than)


@pytest.mark.parametrize("seed_codes", [3, 20])
@pytest.mark.parametrize("top_n", [1, 10, 500])
def test_top_pairs_equal_brute_force(spark, top_n, seed_codes):
    dice = random.Random(top_n)
    codes = "abcdefghijklmnopqrst"
    invoices = [(str(i), [dice.choice(codes) for _ in range(dice.randrange(1, 7))]) for i in range(80)]
    invoices += [("huge", [dice.choice(codes) for _ in range(90)])]
    found = baskets.top_line_pairs(
        frame(spark, invoices), more_than=1, top_n=top_n, wide_basket=6, lane_items=4, seed_codes=seed_codes
    )
    ranked = sorted(brute_force(invoices, 1).items(), key=lambda item: (-item[1], item[0]))[:top_n]
    assert [((r.Product1, r.Product2), r.Frequency) for r in found.collect()] == ranked


def test_an_invoice_of_very_many_codes_is_held_in_bounded_segments(spark):
    from pyspark.sql import functions as F

    from tillroll.operators.baskets import basket_segments, baskets, whole_baskets

    wide = spark.range(1_000_000).select(F.lit("w").alias("InvoiceNo"), F.concat(F.lit("s"), "id").alias("StockCode"))
    few = spark.createDataFrame([("n", "b"), ("n", "a"), ("n", "a"), ("one", "a")], "InvoiceNo string, StockCode string")
    segments = basket_segments(wide.unionByName(few)).cache()
    sizes = segments.groupBy("InvoiceNo").agg(F.count("*").alias("n"), F.max(F.size("items")).alias("most"), F.sum(F.size("items")).alias("all"))
    found = {r.InvoiceNo: (r.n, r["most"], r["all"]) for r in sizes.collect()}
    assert set(found) == {"w", "n"} and found["n"] == (1, 2, 2)
    assert found["w"][0] > 400 and found["w"][1] <= 4096 and found["w"][2] == 1_000_000
    narrow = basket_segments(few, most=1)
    assert whole_baskets(narrow).collect() == baskets(few).collect()
    assert whole_baskets(segments).filter("InvoiceNo = 'n'").first()["items"] == ["a", "b"]
    assert whole_baskets(segments).filter("InvoiceNo = 'w'").select(F.size("items")).first()[0] == 1_000_000
