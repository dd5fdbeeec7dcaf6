"""Clustering of scored users and the naming of the clusters."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from tagweave.operators.features import assemble_features
from tagweave.operators.lookup import is_small, join_lookup
from tagweave.operators.numbering import number_rows, number_small
from tagweave.operators.match import match_rules
from tagweave.storage import literal_rows, stage

# Score combinations in a partition, whatever the partitions of the users: the fit
# sees the same points in the same order.
POINTS = 10_000
# Starts of a clustering; the one with the least cost counts.
SEEDS = (42, 43, 44)


class Segmentation(NamedTuple):
    """Users with their cluster and rank, and how the clusters came out.

    Clusters are numbered by their rank, so the numbers do not depend on the fit.
    """

    assigned: DataFrame  # the input columns, ``cluster`` and ``rank``
    ranks: DataFrame  # cluster, center, center_sum, rank
    scores: list[str]
    cost: float
    points: DataFrame  # score combinations, the number of users ``w`` and ``cluster``
    skipped: int  # users that lack a score

    def silhouette(self) -> float | None:
        """Mean silhouette over all users, from the score combinations; none for a single cluster."""
        if self.ranks.count() < 2:
            return None
        return silhouette(assemble_features(self.points, self.scores), "cluster", "features", "w")


def rank_clusters(centers: DataFrame, small: bool = False) -> DataFrame:
    """Rank clusters by the sum of their centre, best first.

    ``centers`` has one row per cluster: ``cluster`` and the array ``center``.
    Equal sums are ordered by the centre and then by the cluster. ``small``: it is
    known to be small.
    """
    total = F.aggregate("center", F.lit(0.0), lambda acc, x: acc + x)
    summed = centers.select("cluster", "center", total.alias("center_sum"))
    ranked = (number_small if small else number_rows)(summed, "rank", F.desc("center_sum"), F.desc("center"), "cluster")
    return ranked.withColumn("rank", F.col("rank").cast("int"))


def name_ranks(ranks: DataFrame, rules: DataFrame) -> DataFrame:
    """Add the tag whose rule is the rank. Ranks beyond the rules stay without a tag."""
    return match_rules(ranks, "rank", rules, "left")


def cluster_centers(df: DataFrame, cluster: str, features: str) -> DataFrame:
    """Mean vector of each given cluster."""
    return df.groupBy(F.col(cluster).alias("cluster")).agg(
        vector_to_array(Summarizer.mean(F.col(features))).alias("center")
    )


def cluster_score_range(df: DataFrame, cluster: str, scores: list[str]) -> DataFrame:
    """Greatest and least score sum of each cluster."""
    total = sum((F.col(s) for s in scores[1:]), F.col(scores[0]))
    return df.groupBy(cluster).agg(F.max(total).alias("max_score"), F.min(total).alias("min_score"))


def within_cluster_error(df: DataFrame, cluster: str, features: str) -> DataFrame:
    """Sum of squared distances to the cluster means, in one aggregation.

    Per cluster and slot it is the sample variance times the row count less one.
    """
    stats = Summarizer.metrics("variance", "count").summary(F.col(features))
    spread = df.groupBy(cluster).agg(stats.alias("s")).select(
        F.aggregate(vector_to_array("s.variance"), F.lit(0.0), lambda acc, x: acc + x).alias("v"),
        F.col("s.count").alias("n"),
    )
    return spread.agg(F.sum(F.col("v") * (F.col("n") - 1)).alias("wssse"))


def silhouette(df: DataFrame, cluster: str, features: str, weight: str | None = None) -> float:
    """Mean silhouette by squared Euclidean distance; needs two clusters.

    A row of weight w counts as w equal rows. The mean squared distance of a point
    x to a cluster with n rows, mean m and mean squared norm q is
    ``|x|^2 - 2 x.m + q``, so one grouping for the clusters and one pass over the
    rows do. The clusters' means come to the driver, one row each.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    square = lambda x: F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v * v)
    x = vector_to_array(features)
    rows = df.select(F.col(cluster).cast("string").alias("c"), F.col(features).alias("f"), w.alias("w"), square(x).alias("xx"))
    known = rows.groupBy("c").agg(
        F.sum("w").alias("n"),
        (F.sum(F.col("w") * F.col("xx")) / F.sum("w")).alias("q"),
        vector_to_array(Summarizer.mean(F.col("f"), F.col("w"))).alias("m"),
    ).orderBy("c").collect()
    if len(known) < 2:
        raise ValueError("a silhouette needs two clusters")
    width = len(known[0].m)
    names = F.array(*[F.lit(r.c) for r in known])
    sizes, norms = F.lit(np.array([r.n for r in known])), F.lit(np.array([r.q for r in known]))
    means = F.lit(np.array([r.m for r in known], float).ravel())

    def apart(i: Column) -> Column:
        dots = F.zip_with(vector_to_array("f"), F.slice(means, i * width + 1, width), lambda a, b: a * b)
        return F.col("xx") - 2 * F.aggregate(dots, F.lit(0.0), lambda acc, v: acc + v) + F.get(norms, i)

    measured = rows.select(
        "w",
        (F.array_position(names, F.col("c")).cast("int") - 1).alias("own"),
        F.transform(F.sequence(F.lit(0), F.lit(len(known) - 1)), apart).alias("d"),
    )
    size = F.get(sizes, F.col("own"))
    others = F.array_min(F.filter(F.transform("d", lambda d, i: F.when(i != F.col("own"), d)), lambda d: d.isNotNull()))
    inside = F.get("d", F.col("own")) * size / (size - 1)
    pair = measured.select("w", size.alias("n"), F.when(size > 1, inside).alias("a"), others.alias("b"))
    largest = F.greatest("a", "b")
    value = F.when((F.col("n") > 1) & (largest > 0), (F.col("b") - F.col("a")) / largest).otherwise(0.0)
    return pair.agg(F.sum(F.col("w") * value) / F.sum("w")).first()[0]


def fit_kmeans(
    df: DataFrame,
    features: str = "features",
    *,
    k: int,
    max_iter: int,
    seed: int = 42,
    weight: str | None = None,
) -> KMeansModel:
    """K-means on any vector column; ``prediction`` is the cluster."""
    kmeans = KMeans(
        featuresCol=features, predictionCol="prediction", k=k, maxIter=max_iter, seed=seed
    )
    return (kmeans.setWeightCol(weight) if weight else kmeans).fit(df)


def tag_clusters(rows: DataFrame, cluster: str, features: str, rules: DataFrame) -> DataFrame:
    """Rank the given clusters of ``rows`` and add ``center_sum``, ``rank`` and the tag of the rank.

    The centres cost a pass over the rows and are staged: one row per cluster.
    """
    centers = stage(cluster_centers(rows, cluster, features), "centers")
    small = is_small(centers)
    named = name_ranks(rank_clusters(centers, small), rules).withColumnRenamed("cluster", "_cluster")
    joined = join_lookup(rows, F.col(cluster), named, "_cluster", "inner", small)
    return joined.select(*rows.columns, "center_sum", "rank", "tag_id", "tag_name")


def segment(
    scored: DataFrame,
    scores: list[str],
    *,
    k: int,
    max_iter: int,
    seed: int | None = None,
    seeds: tuple[int, ...] = SEEDS,
    handle_invalid: str = "error",
) -> Segmentation:
    """Cluster users by their scores and rank the clusters.

    Users with equal scores are one weighted point, which leaves the objective as
    it is. The points are counted, dealt to a fixed number of partitions by their
    scores and sorted there, so that the fit does not depend on how the users are
    partitioned, and there may be any number of them. Of several starts the one
    with the least cost counts; users get their cluster from the model itself.
    ``scored`` is read twice, for the count and for the result, so stage it first.
    """
    counted = scored.groupBy(*scores).agg(F.count(F.lit(1)).cast("double").alias("w"))
    lacking = F.lit(False)
    for name in scores:
        lacking = lacking | F.col(name).isNull()
    unscored = counted.filter(lacking).agg(F.sum("w")).first()[0]
    if unscored and handle_invalid != "skip":
        raise ValueError(f"{int(unscored)} users lack a score")
    points = stage(counted.filter(~lacking), "points")
    # Up to k points are clusters of their own: nothing to fit, and nothing better to find.
    first = points.select(*scores).limit(k + 1).collect()
    if not first:
        raise ValueError("no user has all scores")
    users = scored.filter(~lacking)
    if len(first) <= k:
        centers, cost, model = [[float(x) for x in row] for row in first], 0.0, None
    else:
        dealt = points.repartition(-(-points.count() // POINTS), *scores).sortWithinPartitions(*scores)
        vectors = assemble_features(dealt, scores).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            starts = seeds if seed is None else (seed,)
            fits = [fit_kmeans(vectors, k=k, max_iter=max_iter, seed=start, weight="w") for start in starts]
            model = min(fits, key=lambda m: m.summary.trainingCost)
            centers, cost = [[float(x) for x in center] for center in model.clusterCenters()], model.summary.trainingCost
        finally:
            vectors.unpersist()
    # One entry per cluster; as in rank_clusters.
    order = sorted(range(len(centers)), key=lambda c: (-sum(centers[c]), [-x for x in centers[c]], c))
    ranked = [centers[c] for c in order]
    place = {c: rank for rank, c in enumerate(order)}
    spark = scored.sparkSession
    columns = {"cluster": list(range(len(ranked))), "center": ranked, "center_sum": [sum(c) for c in ranked]}
    ranks = literal_rows(spark, columns).withColumn("rank", F.col("cluster").cast("int"))

    def clustered(rows: DataFrame) -> DataFrame:
        if model is None:
            own = {**{s: [c[i] for c in ranked] for i, s in enumerate(scores)}, "cluster": list(range(len(ranked)))}
            return rows.join(F.broadcast(literal_rows(spark, own)), scores)
        found = model.transform(assemble_features(rows, scores, "_features"))
        places = F.array(*[F.lit(place[c]) for c in range(len(centers))])
        return found.withColumn("cluster", F.get(places, F.col("_predicted")))

    if model is not None:
        model.setFeaturesCol("_features").setPredictionCol("_predicted")
    cluster = F.col("cluster").cast("bigint").alias("cluster")
    assigned = clustered(users).select(*scored.columns, cluster, F.col("cluster").cast("int").alias("rank"))
    return Segmentation(assigned, ranks, scores, cost, clustered(points).select(*scores, "w", cluster), int(unscored or 0))
