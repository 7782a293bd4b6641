"""Spark's K-Means from given centres, run until no customer changes cluster."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.operators import clusters


@pytest.fixture(scope="module")
def rfm(spark):
    rng = random.Random(2)
    rows = [(f"c{i}", rng.gauss(200 - 150 * (i % 3 == 0), 25), rng.gauss(4 + 9 * (i % 3 == 1), 2), rng.gauss(90 + 400 * (i % 3 == 2), 60)) for i in range(240)]
    return spark.createDataFrame(rows, "CustomerID string, Recency double, Frequency double, Monetary double")


@pytest.fixture(scope="module")
def points(rfm):
    return clusters.standardised(rfm).persist()


def as_array(points):
    return np.array(points.select(*[f"{m}Scaled" for m in clusters.METRICS]).collect())


def one_step(x, centres):
    near = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    return np.array([x[near == i].mean(axis=0) if (near == i).any() else c for i, c in enumerate(centres)])


def test_a_further_step_moves_no_centre(points):
    x = as_array(points)
    for k, centres in clusters.fitted_centres(points, [2, 3, 5]).items():
        assert len(centres) == k and np.abs(one_step(x, np.array(centres)) - np.array(centres)).max() < 1e-9


def test_rounds_and_tolerance_end_a_fit_early(points):
    x, starts = as_array(points), np.array(clusters._starts(5))
    once = np.array(clusters.fitted_centres(points, [5], rounds=1)[5])
    assert np.allclose(once, one_step(x, starts))
    loose = np.array(clusters.fitted_centres(points, [5], tolerance=10.0)[5])
    assert np.allclose(loose, once)


def test_given_starts_and_a_centre_without_customers(points):
    far = [(0.0, 0.0, 0.0), (50.0, 50.0, 50.0)]
    centres = clusters.fitted_centres(points, [2], starts={2: far})[2]
    assert np.allclose(centres[0], as_array(points).mean(axis=0)) and centres[1] == far[1]


def test_customers_are_in_the_nearest_of_three_plain_groups(rfm):
    found = clusters.clustered(rfm, 3)
    assert found.columns == [*rfm.columns, "Cluster"]
    groups = found.groupBy((F.substring("CustomerID", 2, 9).cast("int") % 3).alias("of")).agg(F.collect_set("Cluster").alias("in"))
    assert sorted(len(r["in"]) for r in groups.collect()) == [1, 1, 1]
    assert clusters.cluster_profile(found).agg(F.sum("CustomerCount")).first()[0] == 240


def test_elbow(spark, rfm):
    costs = clusters.elbow(rfm)
    rows = costs.collect()
    assert [r.K for r in rows] == list(range(2, 9)) and rows[0].Cost > rows[1].Cost
    assert clusters.elbow_k(costs).first().K == 3
    made = spark.createDataFrame([(2, 100.0), (3, 90.0), (4, 20.0), (5, 15.0), (6, 10.0)], "K int, Cost double")
    assert clusters.elbow_k(made).first().K == 4
    assert clusters.elbow_k(made.limit(1)).first().K == 2
