import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from conftest import rows
from paceline.operators import segments, sessions as ses


def test_user_features(spark, made):
    steps = ["view_homepage", "search_product", "view_product_details", "add_to_cart", "checkout_initiated",
             "purchase_completed"]
    for i, s in enumerate(steps):
        made.add("s1", s, i * 10)
    made.add("s2", "view_homepage", 86_400 * 3 + 5)
    made.add("s3", "view_homepage", 0, user_id=None)
    got = rows(segments.user_features(ses.int_sessions(made.df(spark))))
    assert got == [{"user_id": "u1", "days_since_signup": 3, "max_funnel_depth": 6, "bounce_rate": 0.5,
                    "total_sessions": 2, "avg_duration": 25.0, "total_purchase": 1, "cart_additions": 1}]


def test_scaling_uses_the_population_deviation_and_survives_constants(spark):
    df = spark.createDataFrame([(i, float(i * i), 7.0) for i in range(5)], "id int, a double, b double")
    got = rows(segments.standardize(df, ["a", "b"]), "id")
    a = np.array([float(i * i) for i in range(5)])
    np.testing.assert_allclose([r["a"] for r in got], (a - a.mean()) / a.std())
    assert {r["b"] for r in got} == {0.0}


def brute_silhouette(points, labels):
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    out = []
    for i, own in enumerate(labels):
        same = (labels == own) & (np.arange(len(labels)) != i)
        if not same.any():
            out.append(0.0)
            continue
        a = d[i, same].mean()
        b = min(d[i, labels == o].mean() for o in set(labels) - {own})
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return np.array(out)


def test_silhouette_equals_all_pairs(spark):
    rng = np.random.default_rng(0)
    points = rng.normal(size=(700, 4))
    labels = rng.integers(0, 3, 700)
    labels[:1] = 9  # a cluster of one scores zero
    df = spark.createDataFrame([(i, p.tolist(), int(k), 0) for i, (p, k) in enumerate(zip(points, labels))],
                               "id long, v array<double>, k int, same int")
    got = {r["labelling"]: r for r in rows(segments.silhouette_sampled(df, "id", "v", ["k", "same"]))}
    assert got["k"]["silhouette"] == pytest.approx(brute_silhouette(points, labels).mean(), abs=1e-5)
    assert (got["k"]["points"], got["k"]["clusters"]) == (700, 4)
    assert got["same"]["silhouette"] is None


def test_sample_is_repeatable_and_bounded(spark):
    df = spark.range(1000).repartition(7)
    a = [r["id"] for r in segments.hash_sample(df, "id", 50).collect()]
    b = [r["id"] for r in segments.hash_sample(df.repartition(3), "id", 50).collect()]
    assert a == b and len(set(a)) == 50


def test_silhouette_of_nothing(spark):
    none = spark.createDataFrame([], "id long, v array<double>, k int")
    assert rows(segments.silhouette_sampled(none, "id", "v", ["k"])) == []
    assert rows(segments.silhouette_all(none, "v", ["k"])) == [{"labelling": "k", "silhouette": None}]


def test_fits_settle_on_the_means_of_their_members(spark):
    rng = np.random.default_rng(5)
    data = [(f"u{i}", *map(float, rng.normal(size=2))) for i in range(300)]
    df = spark.createDataFrame(data, "user_id string, a double, b double")
    got = rows(segments.kmeans_check(df, "user_id", ["a", "b"], ks=(2, 3), restarts=3), "k")
    assert [(r["users"], r["clusters"], r["settled"], r["displaced_centres"], r["cost_falls"]) for r in got] == [
        (300, 2, True, 0, True), (300, 3, True, 0, True)]
    labelled, fits = segments.kmeans_labels(df, "user_id", ["a", "b"], ks=(3,), restarts=2)
    for r in labelled.collect():
        gaps = ((np.array(r["vector"]) - fits[3][1]) ** 2).sum(axis=1)
        assert gaps[r["k3"]] == pytest.approx(gaps.min())


def test_seeds_are_drawn_from_all_rows_and_repeat(spark):
    rng = np.random.default_rng(9)
    far = np.array([[0.0, 0.0], [50.0, 0.0], [0.0, 50.0], [50.0, 50.0]])
    data = [(f"u{i}", *map(float, far[0] + rng.normal(size=2))) for i in range(1000)]
    data += [(f"v{j}", *map(float, far[j] + rng.normal(size=2))) for j in (1, 2, 3)]  # three rows of a thousand
    df = spark.createDataFrame(data, "user_id string, a double, b double")
    seeds = segments.parallel_seeds(df.repartition(4), "user_id", ["a", "b"], {f: 4 for f in range(6)}, 42)
    found = [all(((s - c) ** 2).sum(axis=1).min() < 30 for c in far) for s in seeds.values()]
    assert sum(found) >= 5
    again = segments.parallel_seeds(df.repartition(2), "user_id", ["a", "b"], {f: 4 for f in range(6)}, 42)
    assert all(np.allclose(seeds[f], again[f], atol=1e-6) for f in seeds)


def test_sweep_over_no_users_and_more_clusters_than_users(spark):
    none = spark.createDataFrame([], "user_id string, a double")
    scores, labelled = segments.kmeans_sweep(none, "user_id", ["a"], ks=(2, 3), restarts=2)
    assert [r["training_cost"] for r in rows(scores, "k")] == [None, None] and labelled.count() == 0
    two = spark.createDataFrame([("u1", 1.0), ("u2", 5.0)], "user_id string, a double")
    assert segments.kmeans_sweep(two, "user_id", ["a"], ks=(3,), restarts=2)[1].count() == 2


def test_sweep_labels_every_user_and_finds_planted_groups(spark):
    rng = np.random.default_rng(1)
    centers = [(0, 0), (12, 0), (0, 12)]
    data = [(f"u{i}", *map(float, rng.normal(centers[i % 3], 0.5))) for i in range(90)]
    df = spark.createDataFrame(data, "user_id string, a double, b double")
    scores, labelled = segments.kmeans_sweep(df, "user_id", ["a", "b"], ks=(2, 3, 4), restarts=2)
    table = rows(scores, "k")
    assert [r["k"] for r in table if r["best"]] == [3]
    costs = [r["training_cost"] for r in table]
    assert costs == sorted(costs, reverse=True)
    assert labelled.count() == 90 and labelled.select("user_id").distinct().count() == 90
    groups = labelled.withColumn("g", F.substring("user_id", 2, 9).cast("int") % 3)
    assert groups.groupBy("g", "cluster").count().count() == 3


def test_scores_may_stand_beside_the_columns(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 3.0)], "id int, a double")
    assert rows(segments.standardize(df, ["a"], prefix="z_"), "id") == [
        {"id": 0, "a": 1.0, "z_a": -1.0}, {"id": 1, "a": 3.0, "z_a": 1.0}]


def test_squared_silhouette_covers_all_rows(spark):
    df = spark.createDataFrame([(Vectors.dense(float(x)), int(x > 5)) for x in (0, 1, 10, 11)], ["v", "k"])
    assert 0.9 < segments.silhouette_squared(df, "v", "k") <= 1


def test_profile(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0), (1, 9.0)], "cluster int, a double")
    assert rows(segments.segment_profile(df, "cluster", ["a"]), "cluster") == [
        {"cluster": 0, "users": 2, "a": 1.5}, {"cluster": 1, "users": 1, "a": 9.0}]
