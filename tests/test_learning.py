"""Features, clusters and classifiers."""

import math
import random

import pytest
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tagweave.operators import classify, features, lookup, segments
from tagweave.plans import classifiers

SCORES = ["r_score", "f_score", "m_score"]


def scored(spark, rows, partitions=3):
    data = [(f"u{i}", *map(float, row)) for i, row in enumerate(rows)]
    return spark.createDataFrame(data, "userId string, r_score double, f_score double, m_score double").repartition(partitions)


def varied(spark, n=600, partitions=3):
    draw = random.Random(7)
    return scored(spark, [[draw.randint(1, 5) for _ in SCORES] for _ in range(n)], partitions)


# Features


@pytest.mark.parametrize("rows", [100_000, 0])
def test_string_index(spark, monkeypatch, rows):
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", rows)
    words = ["b", "b", "c", "a", "a", "d"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    found = features.string_index(df, "w", "i")
    assert found.columns == ["w", "i"]
    assert sorted(map(tuple, found.collect())) == sorted(zip(words, [1.0, 1.0, 2.0, 0.0, 0.0, 3.0]))
    expected = StringIndexer(inputCol="w", outputCol="i").fit(df).transform(df)
    assert sorted(map(tuple, expected.collect())) == sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("rows", [100_000, 0])
def test_null_label_is_an_error(spark, monkeypatch, rows, failing):
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", rows)
    df = spark.createDataFrame([("a",), (None,)], "w string")
    failing(features.string_index(df, "w", "i"), "(?i)null")


def test_assemble(spark, failing):
    df = spark.createDataFrame([(1.0, 2), (None, 3)], "a double, b int")
    failing(features.assemble_features(df, ["a", "b"]), "(?i)null")
    found = features.assemble_features(df, ["a", "b"], handle_invalid="skip").collect()
    assert [list(r.features.toArray()) for r in found] == [[1.0, 2.0]]


def test_l2_normalize(spark):
    df = spark.createDataFrame([(Vectors.dense([3.0, 4.0]),)], ["raw"])
    assert list(features.l2_normalize(df, "raw").first().features.toArray()) == [0.6, 0.8]


def test_vector_index(spark):
    rows = [(Vectors.dense([float(i), float(i % 3 - 1)]),) for i in range(9)]
    df = spark.createDataFrame(rows, ["raw"])
    model = features.fit_vector_index(df, "raw", "x")
    assert set(model.categoryMaps) == {1}
    found = {tuple(r.x.toArray()) for r in model.transform(df).collect()}
    # Zero keeps index 0, the other values follow in their order.
    assert {(i, x) for i, x in found if i < 3} == {(0.0, 1.0), (1.0, 0.0), (2.0, 2.0)}


def test_stable_split(spark):
    df = spark.range(5000)
    train, test = features.stable_split(df, "id")
    kept = {r.id for r in train.collect()}
    assert kept | {r.id for r in test.collect()} == set(range(5000)) and kept.isdisjoint(r.id for r in test.collect())
    assert 0.77 < len(kept) / 5000 < 0.83
    assert kept == {r.id for r in features.stable_split(df.repartition(13), "id")[0].collect()}


# Clusters


def test_segments_do_not_depend_on_partitioning(spark):
    results = []
    for partitions in (1, 4, 9):
        found = segments.segment(varied(spark, partitions=partitions), SCORES, k=5, max_iter=10)
        assert found.assigned.count() == 600
        results.append(sorted(map(tuple, found.assigned.collect())))
    assert results[0] == results[1] == results[2]


def test_segments_are_ranked_and_nearest(spark):
    found = segments.segment(varied(spark), SCORES, k=5, max_iter=10)
    ranks = found.ranks.orderBy("rank").collect()
    assert [r["rank"] for r in ranks] == [0, 1, 2, 3, 4]
    sums = [r.center_sum for r in ranks]
    assert sums == sorted(sums, reverse=True) and len(set(sums)) == 5
    assert all(math.isclose(r.center_sum, sum(r.center)) for r in ranks)
    centers = {r.cluster: r.center for r in ranks}
    cost, by_triple = 0.0, {}
    for row in found.assigned.collect():
        point = [row[s] for s in SCORES]
        distance = {c: sum((a - b) ** 2 for a, b in zip(point, x)) for c, x in centers.items()}
        assert math.isclose(distance[row.cluster], min(distance.values()))
        assert by_triple.setdefault(tuple(point), row.cluster) == row.cluster
        cost += distance[row.cluster]
    # The weighted points cost what the users cost.
    assert math.isclose(found.cost, cost, rel_tol=1e-9)


def brute_silhouette(rows):
    total = 0.0
    for i, (x, own) in enumerate(rows):
        sums = {}
        for j, (y, cluster) in enumerate(rows):
            if i != j:
                sums.setdefault(cluster, []).append(sum((a - b) ** 2 for a, b in zip(x, y)))
        means = {c: sum(d) / len(d) for c, d in sums.items()}
        a = means.pop(own)
        b = min(means.values())
        total += (b - a) / max(a, b)
    return total / len(rows)


def test_segment_quality_equals_that_of_the_users(spark):
    found = segments.segment(varied(spark), SCORES, k=4, max_iter=20)
    users = features.assemble_features(found.assigned, SCORES)
    rows = [([r[s] for s in SCORES], r.cluster) for r in found.assigned.collect()]
    assert math.isclose(found.silhouette(), brute_silhouette(rows), rel_tol=1e-9)
    error = segments.within_cluster_error(users, "cluster", "features").first().wssse
    assert error <= found.cost * (1 + 1e-9)


def test_weighted_silhouette_equals_the_evaluator_on_copies(spark):
    draw = random.Random(12)
    rows = [(draw.randint(0, 3), Vectors.dense([draw.gauss(3 * c, 1) for c in range(3)]), draw.choice([1, 1, 2, 7])) for _ in range(60)]
    rows.append((9, Vectors.dense([0.0, 0.0, 0.0]), 1))  # a cluster of one
    weighted = spark.createDataFrame(rows, ["c", "x", "w"])
    copies = spark.createDataFrame([(c, x) for c, x, w in rows for _ in range(w)], ["c", "x"])
    expected = ClusteringEvaluator(predictionCol="c", featuresCol="x").evaluate(copies)
    assert math.isclose(segments.silhouette(weighted, "c", "x", "w"), expected, rel_tol=1e-9)
    assert math.isclose(segments.silhouette(copies, "c", "x"), expected, rel_tol=1e-9)


def test_silhouette_of_equal_points_and_of_one_cluster(spark):
    same = spark.createDataFrame([(c, Vectors.dense([1.0])) for c in (0, 0, 1, 1)], ["c", "x"])
    assert segments.silhouette(same, "c", "x") == 0
    with pytest.raises(ValueError, match="two clusters"):
        segments.silhouette(same.filter("c = 0"), "c", "x")


def best_clustering(points, k):
    """Least cost of k clusters of weighted numbers: contiguous in order, by dynamic programming."""
    points = sorted(points)

    def cost(i, j):
        n = sum(w for _, w in points[i:j])
        mean = sum(x * w for x, w in points[i:j]) / n
        return sum(w * (x - mean) ** 2 for x, w in points[i:j])

    best = {0: [0.0] + [math.inf] * len(points)}
    for c in range(1, k + 1):
        best[c] = [min((best[c - 1][i] + cost(i, j) for i in range(j)), default=0.0) for j in range(len(points) + 1)]
    return best[k][len(points)]


def test_one_score_reaches_the_least_cost(spark):
    """Eleven score sums of uneven weight in four clusters."""
    weights = {1: 40, 2: 3, 3: 25, 6: 1, 7: 30, 8: 9, 12: 50, 13: 2, 14: 17, 20: 5, 21: 12}
    df = spark.createDataFrame([(float(x), f"u{x}-{i}") for x, w in weights.items() for i in range(w)], ["total", "userId"])
    found = segments.segment(df, ["total"], k=4, max_iter=20)
    assert math.isclose(found.cost, best_clustering([(float(x), w) for x, w in weights.items()], 4), rel_tol=1e-9)
    assert [r.center_sum for r in found.ranks.collect()] == sorted((r.center_sum for r in found.ranks.collect()), reverse=True)


def test_clusters_are_numbered_by_rank(spark):
    found = segments.segment(varied(spark), SCORES, k=5, max_iter=10)
    assert found.assigned.filter("cluster <> rank").isEmpty() and found.skipped == 0
    assert found.points.agg(F.sum("w")).first()[0] == found.assigned.count()


def test_fewer_points_than_clusters(spark):
    found = segments.segment(scored(spark, [(1, 1, 1), (3, 3, 3), (5, 5, 5), (5, 5, 5)]), SCORES, k=5, max_iter=10)
    assert {r.m_score: r["rank"] for r in found.assigned.collect()} == {5: 0, 3: 1, 1: 2}


def test_single_cluster_has_no_silhouette(spark):
    assert segments.segment(scored(spark, [(1, 1, 1)] * 3), SCORES, k=5, max_iter=10).silhouette() is None


def test_unscored_users(spark):
    df = scored(spark, [(1, 1, 1), (5, 5, 5)]).union(spark.sql("select 'n', 1.0D, null, 2.0D"))
    with pytest.raises(ValueError, match="1 users lack a score"):
        segments.segment(df, SCORES, k=2, max_iter=10)
    found = segments.segment(df, SCORES, k=2, max_iter=10, handle_invalid="skip")
    assert {r.userId for r in found.assigned.collect()} == {"u0", "u1"}
    with pytest.raises(ValueError, match="no user"):
        segments.segment(df.filter("f_score is null"), SCORES, k=2, max_iter=10, handle_invalid="skip")


def test_any_number_of_points_and_partitions(spark):
    """Scores that are not banded: 100,000 distinct points, the same clusters for every partitioning."""
    wide = spark.range(100_000).selectExpr(
        "cast(id as string) userId", "id / 7.0D + (id % 4) * 1e6 r_score", "(id % 4) * 1e6D f_score", "cast(id % 11 as double) m_score"
    )
    found = []
    for n in (1, 4, 9):
        assigned = segments.segment(wide.repartition(n), SCORES, k=4, max_iter=10).assigned
        found.append({tuple(r) for r in assigned.groupBy(F.col("userId").cast("int") % 4, "rank").count().collect()})
    assert found[0] == found[1] == found[2] == {(i, 3 - i, 25_000) for i in range(4)}


def test_equal_sums_are_ordered_by_center(spark):
    centers = [(0, [1.0, 3.0]), (1, [3.0, 1.0]), (2, [3.0, 1.0]), (3, [9.0, 0.0])]
    frame = spark.createDataFrame(centers, "cluster int, center array<double>").repartition(3)
    found = segments.rank_clusters(frame)
    assert dict(found.dtypes)["rank"] == "int"
    assert {r.cluster: r["rank"] for r in found.collect()} == {3: 0, 1: 1, 2: 2, 0: 3}


def test_ranks_without_a_rule_have_no_tag(spark):
    ranks = spark.createDataFrame([(7, 0), (8, 1)], "cluster int, rank int")
    rules = spark.createDataFrame([("0", 362, "high")], "rule string, tag_id long, tag_name string")
    found = {r.cluster: (r.tag_id, r.tag_name) for r in segments.name_ranks(ranks, rules).collect()}
    assert found == {7: (362, "high"), 8: (None, None)}


@pytest.mark.parametrize("limit", [100_000, 0])
def test_given_clusters_are_ranked_and_tagged(spark, monkeypatch, limit):
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", limit)
    rows = [(i, float(i % 3), Vectors.dense([float(i % 3), 1.0])) for i in range(30)]
    rules = spark.createDataFrame([("0", 9, "top"), ("1", 8, "next")], "rule string, tag_id long, tag_name string")
    df = spark.createDataFrame(rows, ["id", "label", "features"])
    found = segments.tag_clusters(df, "label", "features", rules).collect()
    assert {r.id: (r["rank"], r.tag_name, r.center_sum) for r in found} == {
        i: {0: (2, None, 1.0), 1: (1, "next", 2.0), 2: (0, "top", 3.0)}[i % 3] for i in range(30)
    }


def test_kmeans_on_vectors(spark):
    rows = [(Vectors.dense([x + 0.1 * i, x]),) for x in (0.0, 10.0) for i in range(5)]
    df = spark.createDataFrame(rows, ["features"])
    model = segments.fit_kmeans(df, k=2, max_iter=20)
    found = model.transform(df).groupBy("prediction").count().collect()
    assert sorted(r["count"] for r in found) == [5, 5]
    assert math.isclose(segments.within_cluster_error(model.transform(df), "prediction", "features").first().wssse, 0.2)


def test_score_range(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0), (0, 5.0, 4.0), (1, 3.0, 3.0)], "c int, a double, b double")
    found = segments.cluster_score_range(df, "c", ["a", "b"])
    assert {tuple(r) for r in found.collect()} == {(0, 9.0, 3.0), (1, 6.0, 6.0)}


# Classifiers


def flowers(spark):
    """Three kinds that differ in the ratio of their measurements."""
    draw = random.Random(3)
    rows = []
    for kind, base in {"long": (6, 1, 1, 1), "wide": (1, 6, 1, 1), "tall": (1, 1, 6, 1)}.items():
        rows += [(*[x + draw.uniform(-0.4, 0.4) for x in base], kind) for _ in range(50)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, category string")


def test_measurement_classifier(spark, tmp_path):
    df = flowers(spark)
    df.write.csv(str(tmp_path / "in"))
    trained = classifiers.measurement_classifier(spark, str(tmp_path / "in"), df.schema, str(tmp_path / "model"))
    assert trained.accuracy > 0.95 and trained.predictions.count() == 150
    assert {r.prediction for r in trained.predictions.collect()} == {0.0, 1.0, 2.0}
    loaded = classify.load_logistic(str(tmp_path / "model"))
    new = spark.createDataFrame([(Vectors.dense([0.98, 0.1, 0.1, 0.1]),)], ["features"])
    first = trained.predictions.filter("category = 'long'").first().label
    assert loaded.transform(new).first().prediction == first


def test_tree_classifier(spark, tmp_path):
    draw = random.Random(5)
    rows = [(float(x > 5), Vectors.dense([x, float(i % 3)])) for i in range(400) for x in [draw.uniform(0, 10)]]
    spark.createDataFrame(rows, ["label", "features"]).write.format("libsvm").save(str(tmp_path / "in"))
    trained = classifiers.tree_classifier(spark, str(tmp_path / "in"), 2)
    assert trained.accuracy > 0.95
    assert 40 < trained.predictions.count() < 130
    assert trained.model.depth <= 5 and "If (feature 0 <=" in trained.model.toDebugString
    classify.save_model(trained.model, str(tmp_path / "model"))
    before = trained.predictions.select("index_features", F.col("prediction").alias("before"))
    after = classify.load_tree(str(tmp_path / "model")).transform(before)
    assert after.filter("before <> prediction").count() == 0


@pytest.mark.parametrize("classifier", ["logistic", "tree"])
def test_a_stored_pipeline_scores_raw_rows(spark, tmp_path, classifier):
    df = flowers(spark)
    known, new = df.filter("a < 6.2"), df.filter("a >= 6.2 or b >= 6.2")
    known.write.csv(str(tmp_path / "in"))
    new.drop("category").write.csv(str(tmp_path / "new"))
    trained = classifiers.train_pipeline(spark, str(tmp_path / "in"), df.schema, str(tmp_path / "model"), classifier)
    measures = new.drop("category").schema
    found = classifiers.score_csv(spark, str(tmp_path / "new"), measures, str(tmp_path / "model"))
    assert found.columns == ["a", "b", "c", "d", "predicted"] and found.count() == new.count()
    expected = {(r.a, r.b): r.category for r in new.collect()}
    assert {(r.a, r.b): r.predicted for r in found.collect()} == expected
    same = {(r.a, r.b): r.predicted for r in trained.transform(new).collect()}
    assert same == expected
    with pytest.raises(ValueError, match="forest"):
        classify.classifier_pipeline(df, ["a"], "category", "forest")


def test_copies_are_numbered_in_lots(spark, monkeypatch):
    """A third of the rows are equal; they are numbered 1 to n and dealt to many tasks."""
    monkeypatch.setattr(features, "LOT", 64)
    for key, value in (("autoBroadcastJoinThreshold", "-1"), ("adaptive.enabled", "false")):
        spark.conf.set(f"spark.sql.{key}", value)
    try:
        df = spark.range(24_000, numPartitions=6).selectExpr("case when id % 3 = 0 then 0 else id div 2 end x", "'z' n")
        found = features.numbered_copies(df, ["x"], "key", "copy")
        assert found.columns == ["x", "n", "key", "copy"] and dict(found.dtypes)["copy"] == "int"
        by_x = {}
        for r in found.collect():
            by_x.setdefault(r.x, []).append(r["copy"])
        assert all(sorted(copies) == list(range(1, len(copies) + 1)) for copies in by_x.values())
        assert len(by_x[0]) >= 8000
        sizes = sorted(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    finally:
        for key in ("autoBroadcastJoinThreshold", "adaptive.enabled"):
            spark.conf.unset(f"spark.sql.{key}")


def test_accuracy_equals_the_evaluator(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)], ["label", "prediction"])
    expected = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy").evaluate(df)
    assert math.isclose(classify.accuracy(df, "label").first().accuracy, expected)


def test_vectors_from_arrays(spark):
    df = spark.sql("select array(1f, 2f) as e")
    vector = features.vector_from_array(df, "e")
    assert vector.select(vector_to_array("features").alias("x")).first().x == [1.0, 2.0]
