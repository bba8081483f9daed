"""A store that fails is no store without the object."""

import functools
import io

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from test_files import store  # noqa: F401
from zonelake.operators import integrity, quality
from zonelake.plans import migrate as m
from zonelake.sources import catalog
from zonelake.sources.objects import Store, ask_objects, probe_objects


def fake(down=False):
    """A store in memory.  ``slow`` answers the third time only, ``lost`` never; with ``down`` nothing does."""

    def connect():
        import types
        from collections import Counter

        from pyarrow.fs import FileType

        data, asked = {"b/good.pdf": b"%PDF-1.7", "b/empty.pdf": b"", "b/slow.pdf": b"%PDF-1.4", "b/raced.pdf": None}, Counter()

        class Client:
            def get_file_info(self, key):
                asked[key] += 1
                if down or "lost" in key or ("slow" in key and asked[key] < 3):
                    raise OSError("no answer")
                if "denied" in key:
                    raise PermissionError("no access")
                kind = FileType.File if key in data else FileType.NotFound
                return types.SimpleNamespace(type=kind, size=len(data.get(key) or b""))

            def open_input_file(self, key):
                if data[key] is None:
                    raise FileNotFoundError(key)
                return io.BytesIO(data[key])

        return Client()

    return Store("fake://b/", connect=connect)


def frame(spark, *names):
    return spark.createDataFrame([(f"fake://b/{n}" if n and ":" not in n else n,) for n in names], "path STRING")


def test_three_outcomes(spark, rows, store):  # noqa: F811
    paths = frame(spark, "good.pdf", "empty.pdf", "slow.pdf", "lost.pdf", "denied.pdf", "none.pdf", "raced.pdf", "nonsense:", "zzz://x/y", f"{store}/c.pdf", None)
    found = {r.path.rpartition("/")[2]: (r.outcome, r.size, r.error) for r in ask_objects(paths, [fake()], pause=0.01).collect()}
    assert found == {
        "good.pdf": ("found", 8, None), "empty.pdf": ("found", 0, None), "slow.pdf": ("found", 8, None),
        "lost.pdf": ("failed", None, "OSError: no answer"), "denied.pdf": ("failed", None, "PermissionError: no access"),
        "none.pdf": ("missing", None, None), "raced.pdf": ("missing", None, None), "nonsense:": ("missing", None, None),
        "y": ("missing", None, None), "c.pdf": ("found", 13, None),
    }


def test_more_paths_than_a_batch(spark):
    paths = spark.range(25_000).select(F.concat(F.lit("fake://b/"), F.when(F.col("id") % 5 == 0, "good.pdf").otherwise("none"), F.lit("")).alias("path"))
    counts = {r.outcome: r["count"] for r in ask_objects(paths, [fake()]).groupBy("outcome").count().collect()}
    assert counts == {"found": 5000, "missing": 20_000}


def test_the_longest_prefix_counts(spark):
    inner = Store("fake://b/", connect=fake().connect)
    outer = Store("fake://", connect=fake(down=True).connect)
    found = {r.path: r.outcome for r in ask_objects(frame(spark, "good.pdf", "fake://c/good.pdf"), [outer, inner], pause=0.01).collect()}
    assert found == {"fake://b/good.pdf": "found", "fake://c/good.pdf": "failed"}


def test_a_probe_fails_with_its_store(spark, rows):
    assert rows(probe_objects(frame(spark, "good.pdf", "none.pdf"), [fake()]), "path", "size") == [("fake://b/good.pdf", 8)]
    with pytest.raises(PySparkException, match="no answer about fake://b/lost.pdf"):
        probe_objects(frame(spark, "good.pdf", "lost.pdf"), [fake()], pause=0.01).collect()


def test_a_snapshot_waits_for_its_store(spark, tmp_path, rows):
    dataset = m.Dataset("ops", "docs", ("k",), quality.Suite("d", (quality.NotNull("k"),)), file_columns=("path",))
    base = str(tmp_path)
    landed = spark.createDataFrame([("a", "fake://b/good.pdf"), ("b", "fake://b/none.pdf")], "k STRING, path STRING")
    landed.write.parquet(f"{dataset.landing_root(base)}/{catalog.SNAPSHOT}=20240101T000000")
    with pytest.raises(PySparkException, match="no answer"):
        m.migrate(spark, base, dataset, functools.partial(probe_objects, stores=[fake(down=True)], pause=0.01))
    # Nothing went to quarantine; the snapshot is still pending.
    assert len(m.pending_snapshots(spark, base, dataset)) == 1
    assert rows(m.migrate(spark, base, dataset, functools.partial(probe_objects, stores=[fake()])), "k") == [("a",)]
    assert rows(m.read_quarantine(spark, base, dataset), "k") == [("b",)]


def test_a_path_is_asked_once(spark):
    df = spark.createDataFrame([("x", "x")] * 9, "a STRING, b STRING")
    assert integrity.referenced_paths(df, ["a", "b"]).count() == 1


def test_secrets_are_not_shown():
    assert "hush" not in repr(Store("s3a://b/", "http://host:9000", "key", "hush"))
