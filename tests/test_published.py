"""Tables are found by the manifest: staged folders are invisible, exports are complete or not there."""

import os

import pytest

from zonelake.sources.manifests import Manifests
from zonelake.sources.published import Published


@pytest.fixture
def lake(spark, tmp_path):
    return Published(spark, str(tmp_path / "lake"))


def test_only_named_folders_are_tables(spark, lake, rows):
    assert rows(lake.tables()) == [] and rows(lake.counts()) == []
    lake.publish({"ops/a": spark.range(3), "ops/b": spark.range(5).selectExpr("id", "id % 2 AS p")}, {"ops/b": ["p"]})
    spark.range(9).write.parquet(f"{lake.root}/ops/c")  # staged, never named
    spark.range(9).write.parquet(f"{lake.root}/ops/a/v9-staged")
    assert rows(lake.tables(), "table", "columns", "version") == [("ops/a", ["id"], 0), ("ops/b", ["id", "p"], 0)]
    assert rows(lake.counts()) == [("ops/a", 3), ("ops/b", 5)]
    assert rows(lake.read("ops/b").filter("p = 1")) == [(1, 1), (3, 1)]
    with pytest.raises(KeyError):
        lake.read("ops/c")
    with pytest.raises(ValueError, match="no table name"):
        lake.publish({"../x": spark.range(1)})


def test_versions(spark, lake, rows):
    folders = []
    for n in (1, 2, 3):
        lake.publish({"a": spark.range(n)})
        folders.append(lake.tables().first().path)
    lake.publish({"b": spark.range(7)})
    assert rows(lake.counts()) == [("a", 3), ("b", 7)]
    # The version before stays for those who still read it, the one before that goes.
    assert [os.path.exists(f) for f in folders] == [False, True, True]
    lake.withdraw("a")
    assert lake.names() == ["b"]
    with pytest.raises(KeyError):
        lake.withdraw("a")


def test_a_sweep_that_dies_leaves_the_last_export(spark, lake, rows, tmp_path, monkeypatch):
    lake.publish({"ops/a": spark.range(3), "ops/b": spark.range(4)})
    out = lake.export_all(str(tmp_path / "export"))
    assert rows(out.counts()) == [("ops_a", 3), ("ops_b", 4)]
    lake.publish({"ops/a": spark.range(30)})

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Manifests, "write", die)
        with pytest.raises(RuntimeError, match="lost"):
            lake.export_all(str(tmp_path / "export"))
    assert rows(out.counts()) == [("ops_a", 3), ("ops_b", 4)]
    lake.withdraw("ops/b")
    lake.export_all(str(tmp_path / "export"))
    assert rows(out.counts()) == [("ops_a", 30)]


def test_views_of_damaged_tables_are_reported(spark, lake, rows):
    lake.publish({"views/good": spark.range(3), "views/gone": spark.range(4)})
    assert {s for _, s in rows(lake.register())} == {"registered"}
    path = lake.tables().filter("table = 'views/gone'").first().path
    Manifests(spark, lake.root).remove(path)
    assert rows(lake.register()) == [("views_gone", "skipped: PATH_NOT_FOUND"), ("views_good", "registered")]
    assert spark.table("views_good").count() == 3 and not spark.catalog.tableExists("views_gone")


def test_two_tables_of_one_flat_name(spark, lake, tmp_path):
    lake.publish({"a/b_c": spark.range(1), "a_b/c": spark.range(1)})
    with pytest.raises(ValueError, match="flat name"):
        lake.export_all(str(tmp_path / "export"))
