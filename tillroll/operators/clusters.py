"""Clustering of customers by standardised recency, frequency and value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.clustering import KMeans, KMeansModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import columns as C
from tillroll.runtime import cut
from tillroll.schema import MONEY

METRICS = ("Recency", "Frequency", "Monetary")
ROUNDS = 300
TOLERANCE = 1e-9  # of standard deviations


def _features(rfm: DataFrame) -> DataFrame:
    """``rfm`` with a vector of standardised metrics (zero mean, unit sample deviation)."""
    source = cut(rfm)
    gathered = VectorAssembler(inputCols=list(METRICS), outputCol="metrics", handleInvalid="skip").transform(source)
    scaler = StandardScaler(inputCol="metrics", outputCol="features", withMean=True, withStd=True)
    return scaler.fit(gathered).transform(gathered).drop("metrics")


def standardised(rfm: DataFrame) -> DataFrame:
    """Customers with a standardised copy of each metric."""
    values = vector_to_array("features")
    named = {f"{name}Scaled": F.get(values, i) for i, name in enumerate(METRICS)}
    return _features(rfm).withColumns(named).drop("features")


Centre = tuple[float, ...]


def _starts(k: int) -> list[Centre]:
    """Starting centres on the line from lapsed customers to the best: no chance, and no dependence on how rows are dealt out."""
    places = [-1 + 2 * i / max(1, k - 1) for i in range(k)]
    return [(-t, t, t) for t in places]


def _nearest(centres: Sequence[Centre]) -> Column:
    """(distance, number) of the nearest centre, the lower number winning a tie."""
    away = []
    for number, centre in enumerate(centres):
        parts = [(F.col(f"{m}Scaled") - x) * (F.col(f"{m}Scaled") - x) for m, x in zip(METRICS, centre, strict=True)]
        away.append(F.struct(sum(parts[1:], parts[0]).alias("distance"), F.lit(number).alias("number")))
    return F.array_min(F.array(*away))


def fitted_centres(
    points: DataFrame, ks: Sequence[int], rounds: int = ROUNDS, tolerance: float = TOLERANCE, starts: Mapping[int, Sequence[Centre]] | None = None
) -> dict[int, list[Centre]]:
    """Centres of Spark's K-Means for each k, from ``starts`` or the diagonal.

    The fit ends when no centre moves by more than ``tolerance``, at the latest after ``rounds`` steps. The default tolerance is
    that of rounding: customers no longer change their cluster. A centre without customers stays where it is.
    """
    vectors = points.select(F.array(*[f"{m}Scaled" for m in METRICS]).alias("x")).rdd.map(lambda row: row.x)
    vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = {}
        for k in ks:
            first = KMeansModel((starts or {}).get(k) or _starts(k))
            model = KMeans.train(vectors, k, maxIterations=rounds, epsilon=tolerance, initialModel=first)
            found[k] = [tuple(map(float, c)) for c in model.clusterCenters]
        return found
    finally:
        vectors.unpersist()


def elbow(rfm: DataFrame, ks: Sequence[int] = range(2, 9), rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Within-cluster cost for each k, to choose k by the elbow (X4); all costs come from one pass."""
    points = cut(standardised(rfm))
    centres = fitted_centres(points, ks, rounds, tolerance)
    costs = points.agg(*[F.sum(_nearest(c)["distance"]).alias(str(k)) for k, c in centres.items()])
    return costs.select(F.explode(F.array(*[F.struct(F.lit(k).alias("K"), F.col(str(k)).alias("Cost")) for k in ks])).alias("of")).select("of.*").orderBy("K")


def elbow_k(costs: DataFrame) -> DataFrame:
    """The k at the elbow: where the cost lies farthest below the line from the first cost to the last, of equal ones the smallest.

    ``costs`` has one row for each k.
    """
    all_costs = F.array_sort(F.collect_list(F.struct("K", "Cost")))  # a row for each k that was tried
    first, last = F.get("costs", 0), F.element_at("costs", -1)
    slope = F.when(last["K"] > first["K"], (last["Cost"] - first["Cost"]) / (last["K"] - first["K"])).otherwise(0.0)

    def below(c: Column) -> Column:
        return F.struct((c["Cost"] - first["Cost"] - slope * (c["K"] - first["K"])).alias("gap"), c["K"].alias("K"))

    return costs.agg(all_costs.alias("costs")).select(F.array_min(F.transform("costs", below))["K"].alias("K"))


def clustered(rfm: DataFrame, k: int = 4, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Customers with their K-Means cluster."""
    points = cut(standardised(rfm))
    centres = fitted_centres(points, [k], rounds, tolerance)[k]
    return points.withColumn("Cluster", _nearest(centres)["number"]).drop(*[f"{m}Scaled" for m in METRICS])


def cluster_profile(customers: DataFrame) -> DataFrame:
    """Size, average metrics and revenue of each cluster."""
    money = F.col("Monetary").cast(MONEY)
    return (
        customers.groupBy("Cluster")
        .agg(
            F.count("*").alias("CustomerCount"),
            C.count_ratio(F.sum("Recency"), F.count("Recency")).alias("AvgRecency"),
            C.count_ratio(F.sum("Frequency"), F.count("Frequency")).alias("AvgFrequency"),
            C.ratio(F.sum(money), F.count(money)).alias("AvgMonetary"),
            C.as_double(F.sum(money)).alias("TotalRevenue"),
        )
        .orderBy("Cluster")
    )
