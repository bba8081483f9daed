"""Stored sketches: merged profiles against exact ones, with the stated errors."""

import os

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from zonelake.operators import sketches, stats


@pytest.fixture(scope="module")
def table(spark):
    n = F.col("id")
    return spark.range(0, 60_000, 1, 6).select(
        (n % 3).cast("string").alias("day"), F.when(n % 10 > 0, n % 20_011).alias("k"), (n / 7 - 1000).alias("x"),
        F.concat(F.lit("v"), n % 50).alias("v"), F.array(n % 5).alias("list"), F.lit(None).cast("int").alias("empty"),
    )


@pytest.fixture(scope="module")
def stored(spark, table, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sketches"))
    for day in "012":
        sketches.store_sketches(table.filter(F.col("day") == day), path, day, ["k", "x", "v", "list", "empty"])
    return path


def by_column(df):
    return {r.column: r for r in df.collect()}


def test_merged_equals_exact_within_the_stated_error(spark, table, stored):
    found = by_column(sketches.profile(sketches.merge_sketches(sketches.read_sketches(spark, stored))))
    exact = by_column(stats.column_profile(table, ["k", "x", "v", "empty"]))
    for name, want in exact.items():
        got = found[name]
        assert (got.rows, got.nulls, got.type) == (want.rows, want.nulls, want.type)
        assert abs(got.distinct - want.distinct) <= 5 * 0.017 * want.distinct
        if name in ("k", "x"):
            assert (float(got.least), float(got.most)) == tuple(table.agg(F.min(name), F.max(name)).first())
            count = want.rows - want.nulls
            for q, value in zip(sketches.QUANTILES, got.quantiles):
                assert abs(table.filter(F.col(name) <= value).count() / count - q) < 0.014
    assert found["v"].quantiles is None and found["list"].distinct == 5 and found["v"].least == "v0"
    assert (found["empty"].distinct, found["empty"].least, found["empty"].quantiles) == (0, None, None)


def test_merge_of_merges_and_of_some(spark, table, stored):
    rows = sketches.read_sketches(spark, stored)
    some = sketches.profile(sketches.merge_sketches(sketches.read_sketches(spark, stored, ["0", "2"])))
    assert by_column(some)["x"].rows == 40_000
    twice = sketches.merge_sketches(sketches.merge_sketches(rows, ["snapshot"]))
    once = sketches.merge_sketches(rows)
    keep = ["column", "rows", "nulls", "distinct", "least", "most"]
    assert sorted(map(str, sketches.profile(twice).select(keep).collect())) == sorted(map(str, sketches.profile(once).select(keep).collect()))


def test_a_snapshot_sketched_again_replaces_itself(spark, table, tmp_path):
    for _ in range(2):
        sketches.store_sketches(table.filter("day = '1'"), str(tmp_path), "1", ["k"])
    assert [r.rows for r in sketches.read_sketches(spark, str(tmp_path)).collect()] == [20_000]


def test_size_and_plan(spark, table, stored):
    plan = plan_of(sketches.sketch_columns(table))
    assert plan.count("Exchange") == 1 and "Python" not in plan
    size = sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(stored) for f in files)
    assert size < 3 * 5 * 12_000
    assert "k" not in by_column(sketches.sketch_columns(table, ["x"]))
    assert by_column(sketches.profile(sketches.sketch_columns(table.limit(0), ["x"])))["x"].rows == 0
