import itertools

import pytest
from pyspark.sql import functions as F

from tillroll.operators import clean, customers

SCALE = range(1, 6)


def six(r, f, m):
    if min(r, f, m) >= 4:
        return "Champions"
    if min(r, f, m) >= 3:
        return "Loyal Customers"
    if r >= 4 and f <= 2:
        return "New Customers"
    if r <= 2 and f >= 3:
        return "At Risk"
    return "Lost" if max(r, f, m) <= 2 else "Regular"


def eight(r, f, m):
    if r >= 4:
        return "New Customers" if f <= 2 else ("Champions" if f >= 4 and m >= 4 else "Loyal Customers")
    if r <= 2:
        if f <= 2:
            return "Lost Customers"
        return "At Risk" if f >= 4 and m >= 4 else "Hibernating"
    return "Big Spenders" if m >= 4 else "Regular"


@pytest.fixture(scope="module")
def every_score(spark):
    return spark.createDataFrame(list(itertools.product(SCALE, SCALE, SCALE)), "R_Score int, F_Score int, M_Score int")


@pytest.mark.parametrize(("ladder", "expected"), [(customers.six_label_segment, six), (customers.eight_label_segment, eight)])
def test_ladders_for_every_score(every_score, ladder, expected):
    rows = every_score.withColumn("label", ladder()).collect()
    assert [(r[:3], r.label) for r in rows] == [(r[:3], expected(*r[:3])) for r in rows]


def test_documented_ladder(every_score):
    labels = {r[:3]: r.label for r in every_score.withColumn("label", customers.documented_segment()).collect()}
    assert labels[(5, 1, 5)] == "Potential Loyalist" and labels[(5, 3, 1)] == "Recent Customers"
    assert labels[(1, 5, 1)] == "At Risk" and labels[(1, 1, 1)] == "Lost" and labels[(3, 3, 3)] == "Regular"


def test_recency_variants(raw):
    by_lines = {(r.CustomerID, r.Country): r for r in customers.rfm_by_lines(clean.ledger_lines(raw)).collect()}
    assert by_lines[("unknown", "France")].Recency == 1 and by_lines[("17850", "United Kingdom")].Recency == 2
    by_invoices = {(r.CustomerID, r.Country): r for r in customers.rfm_by_invoices(clean.member_lines(raw)).collect()}
    late = by_invoices[("14527", "France")]
    assert late.Recency == 1 and late.RFM_Segment == f"{late.R_Score}{late.F_Score}{late.M_Score}"
    assert by_invoices[("17850", "United Kingdom")].Frequency == 1


def test_recency_without_any_date_is_zero_or_null(raw):
    undated = raw.withColumn("InvoiceDate", F.lit("?"))
    assert {r.Recency for r in customers.rfm_by_lines(clean.ledger_lines(undated)).collect()} == {0}
    assert {r.Recency for r in customers.rfm_by_invoices(clean.member_lines(undated)).collect()} == {None}


def test_shopper_base_needs_two_invoices(raw):
    rows = customers.shopper_base(clean.shopper_lines(raw, "yyyy-MM-dd HH:mm:ss")).collect()
    assert {r.CustomerID: (r.Country, r.Frequency, r.Monetary, r.UniqueProducts) for r in rows} == {
        "17850": ("United Kingdom", 2, 27.80, 2),
        "14527": ("United Kingdom", 2, 4.39, 1),
    }
    assert {r.CustomerID: r.Recency for r in rows} == {"17850": 0, "14527": 1}
    assert {r.CustomerID: r.AvgOrderValue for r in rows}["17850"] == 9.27


def test_one_label_and_cluster_per_customer(raw):
    base = customers.shopper_base(clean.shopper_lines(raw, "yyyy-MM-dd HH:mm:ss"), min_invoices=1)
    segmented = customers.shopper_segments(customers.shopper_scores(base))
    assert segmented.count() == segmented.select("CustomerID").distinct().count() == 3
    for row in segmented.collect():
        assert row.Cluster == customers.CLUSTER_IDS[row.Segment]
    assert customers.cluster_statistics(segmented).agg(F.sum("CustomerCount")).first()[0] == 3
    notes = {r.Segment: r.Note for r in customers.with_segment_note(segmented).collect()}
    assert all(notes.values())
