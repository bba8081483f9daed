"""Components against numpy, k-means against a plain version, bounded categories."""

import random

import numpy as np
import pytest
from conftest import plan_of

from zonelake.plans import analysis, clusters


def plain_k_means(points, k):
    centres = [list(max(points, key=lambda p: (-sum(x * x for x in p), p)))]
    far = lambda p: min(sum((x - y) ** 2 for x, y in zip(p, c)) for c in centres)
    while len(centres) < k:
        centres.append(list(max(points, key=lambda p: (far(p), p))))
    for _ in range(30):
        groups = [[] for _ in centres]
        for p in points:
            gaps = [sum((x - y) ** 2 for x, y in zip(p, c)) for c in centres]
            groups[gaps.index(min(gaps))].append(p)
        centres = [[round(sum(x) / len(g), 9) for x in zip(*g)] if g else c for g, c in zip(groups, centres)]
    return sorted(centres)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_k_means_equals_a_plain_version(spark, seed):
    rnd = random.Random(seed)
    points = [(float(rnd.randrange(50)), float(rnd.randrange(50))) for _ in range(200)]
    df = spark.createDataFrame(points, "x DOUBLE, y DOUBLE").repartition(7)
    assert np.allclose(clusters.k_means(df, ["x", "y"], 4), plain_k_means(points, 4), atol=1e-8)


def test_equal_points_and_more_clusters_than_points(spark):
    df = spark.createDataFrame([(1.0, 1.0)] * 5 + [(2.0, 2.0)], "x DOUBLE, y DOUBLE")
    centres = clusters.k_means(df, ["x", "y"], 3)
    assert sorted(map(tuple, centres))[0] == (1.0, 1.0) and len(centres) == 3
    with pytest.raises(ValueError, match="no points"):
        clusters.k_means(df.limit(0), ["x", "y"], 2)


def test_components_equal_numpy(spark):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(500, 4)) @ rnd.normal(size=(4, 4)) + 5
    df = spark.createDataFrame(x.tolist(), "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    found = clusters.principal_components(df, ["a", "b", "c", "d"], 3)
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T, bias=True)))[::-1]
    assert np.allclose(found.variances, values[:3]) and np.allclose(np.array(found.vectors) @ np.array(found.vectors).T, np.eye(3))
    placed = np.array(clusters.project(df, found, ["p", "q", "r"]).select("p", "q", "r").collect())
    assert np.allclose(np.cov(placed.T, bias=True), np.diag(values[:3]), atol=1e-8)
    assert all(np.allclose(clusters.fixed_sign(-np.array(v)), v) for v in found.vectors)
    with pytest.raises(ValueError, match="no values"):
        clusters.principal_components(df.limit(0), ["a"], 1)


def test_covariances_take_one_pass(spark):
    df = spark.range(10).selectExpr("id AS a", "id * 2 AS b")
    assert clusters.principal_components(df, ["a", "b"], 1).variances[0] == pytest.approx(8.25 * 5)
    assert "Python" not in plan_of(df.select(clusters.nearest(["a", "b"], [[0.0, 0.0], [9.0, 9.0]])))


def test_categories_are_found_and_bounded(spark, rows):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a")], "id INT, k STRING")
    hot = analysis.one_hot(df, "k")
    assert hot.columns == ["id", "k_a", "k_b"] and rows(hot) == [(1, 0, 1), (2, 0, 0), (3, 1, 0)]
    with pytest.raises(ValueError, match="over 2 categories in id"):
        analysis.categories(df, ["id", "k"], 2)


def test_too_many_labels_are_an_error(spark):
    df = spark.range(1100).selectExpr("CAST(id AS STRING) AS type", "id AS x")
    with pytest.raises(Exception, match="labels"):
        analysis.classification_frame(df, ["x"]).collect()
