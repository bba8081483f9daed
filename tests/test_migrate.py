import json

import pytest
from pyspark.sql import functions as F

from test_files import store  # noqa: F401
from zonelake.operators import quality
from zonelake.plans import migrate as m
from zonelake.sources import catalog, readers

SUITE = quality.Suite("s", (quality.NotNull("v"), quality.Between("v", 0, 10)))
PLAIN = m.Dataset("ops", "plain", ("k",), SUITE)


def land(spark, base, dataset, day, rows, schema="k STRING, v INT"):
    spark.createDataFrame(rows, schema).write.parquet(f"{dataset.landing_root(base)}/{catalog.SNAPSHOT}=2024010{day}T000000")


def test_second_run_adds_nothing(spark, tmp_path, rows):
    base = str(tmp_path)
    land(spark, base, PLAIN, 1, [("a", 1), ("a", 1), (None, 2)])
    land(spark, base, PLAIN, 2, [("a", 5), ("b", 3), (None, 4)])
    expected = [(None, 2), ("a", 1), ("b", 3)]
    assert rows(m.migrate(spark, base, PLAIN)) == expected
    assert m.pending_snapshots(spark, base, PLAIN) == []
    assert rows(m.migrate(spark, base, PLAIN)) == expected
    land(spark, base, PLAIN, 3, [("b", 9), ("c", 1)])
    assert rows(m.migrate(spark, base, PLAIN)) == [*expected, ("c", 1)]
    audit = {r.landing_table[-8]: r for r in m.read_audit(spark, base, PLAIN).collect()}
    assert [(audit[d].cnt_orig, audit[d].cnt_dedup, audit[d].success) for d in "123"] == [(3, 2, True), (3, 1, True), (2, 1, True)]
    assert [f["name"] for f in json.loads(audit["1"].outgoing_schema)["fields"]] == ["k", "v"]


def test_bad_snapshot_is_quarantined_and_later_ones_are_not_affected(spark, tmp_path, rows):
    base = str(tmp_path)
    land(spark, base, PLAIN, 1, [("a", 1)])
    land(spark, base, PLAIN, 2, [("b", 2), ("c", 99)])
    land(spark, base, PLAIN, 3, [("b", 7), ("c", 8)])
    land(spark, base, PLAIN, 4, [("d", -1)])
    assert rows(m.migrate(spark, base, PLAIN)) == [("a", 1), ("b", 7), ("c", 8)]
    quarantine = m.read_quarantine(spark, base, PLAIN)
    assert rows(quarantine, "k", "v", "reason") == [("b", 2, "failed validation"), ("c", 99, "failed validation"), ("d", -1, "failed validation")]
    audit = {r.landing_table[-8]: r for r in m.read_audit(spark, base, PLAIN).collect()}
    assert [audit[d].quarantine for d in "1234"] == [False, True, False, True]
    assert {r["rule"]: r["unexpected"] for r in json.loads(audit["2"].rule_results)} == {"not_null:v": 0, "between:v": 1}
    assert m.pending_snapshots(spark, base, PLAIN) == []


def test_staged_rows_of_a_dead_run_stay_invisible(spark, tmp_path, rows, monkeypatch):
    base = str(tmp_path)
    land(spark, base, PLAIN, 1, [("a", 1)])
    settle = m._settle
    monkeypatch.setattr(m, "_settle", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        m.migrate(spark, base, PLAIN)
    assert m.read_trusted(spark, base, PLAIN).isEmpty()
    failed = m.read_audit(spark, base, PLAIN).first()
    assert failed.success is False and failed.error == "lost"
    monkeypatch.setattr(m, "_settle", settle)
    assert rows(m.migrate(spark, base, PLAIN)) == [("a", 1)]


def test_a_run_that_dies_around_the_naming_keeps_one_record(spark, tmp_path, rows, monkeypatch):
    base = str(tmp_path)
    land(spark, base, PLAIN, 1, [("a", 1)])
    land(spark, base, PLAIN, 2, [("b", 99)])

    class Dead(BaseException):
        """The process ends: nothing is caught."""

    def die(*_):
        raise Dead

    settle = m._settle
    with monkeypatch.context() as patch:  # between the record and the name
        patch.setattr(m, "_settle", die)
        with pytest.raises(Dead):
            m.migrate(spark, base, PLAIN)
    assert m.read_audit(spark, base, PLAIN).isEmpty()
    with monkeypatch.context() as patch:  # right after the name
        patch.setattr(m, "_settle", lambda *a: (settle(*a), die()))
        with pytest.raises(Dead):
            m.migrate(spark, base, PLAIN)
    assert rows(m.read_trusted(spark, base, PLAIN)) == [("a", 1)]
    m.migrate(spark, base, PLAIN)
    assert sorted((r.landing_table[-8], r.success, r.quarantine) for r in m.read_audit(spark, base, PLAIN).collect()) == [("1", True, False), ("2", False, True)]


def test_row_quarantine_by_files(spark, tmp_path, rows, store):  # noqa: F811
    dataset = m.Dataset("ops", "docs", ("k",), quality.Suite("d", (quality.NotNull("k"),)), file_columns=("path",))
    base = str(tmp_path / "lake")
    land(spark, base, dataset, 1, [("a", f"{store}/c.pdf"), ("b", f"{store}/empty.pdf"), ("c", None)], "k STRING, path STRING")
    assert rows(m.migrate(spark, base, dataset), "k") == [("a",)]
    assert rows(m.read_quarantine(spark, base, dataset), "k", "reason") == [("b", "unusable file"), ("c", "unusable file")]
    assert m.read_audit(spark, base, dataset).first().cnt_invalid_file == 2


def test_all_duplicates(spark, tmp_path, rows):
    base = str(tmp_path)
    land(spark, base, PLAIN, 1, [("a", 1)])
    m.migrate(spark, base, PLAIN)
    land(spark, base, PLAIN, 2, [("a", 2)])
    assert rows(m.migrate(spark, base, PLAIN)) == [("a", 1)]


def dataset_named(name):
    return next(d for d in m.DATASETS if d.name == name)


def test_indicators_of_different_years(spark, tmp_path, rows):
    base, data = str(tmp_path), dataset_named("indicators")
    land = lambda name, doc: readers.land_api_payload(spark, doc, f"{data.landing_root(base)}/{name}")
    land("USA_LP/snapshot_ts=1", {"2000": 1.0, "2001": 2, "note": 7})
    land("ESP_LP/snapshot_ts=1", {"2001": 3.0})
    land("ITA_LP/snapshot_ts=1", {"2001": None})
    land("USA_LP/snapshot_ts=2", {"2001": 2, "2002": 5.5})
    trusted = m.migrate(spark, base, data)
    assert rows(trusted) == [(2000, "USA_LP", 1.0), (2001, "ESP_LP", 3.0), (2001, "USA_LP", 2.0), (2002, "USA_LP", 5.5)]
    assert {r.landing_table for r in m.read_audit(spark, base, data).collect() if r.quarantine} == {"ITA_LP/snapshot_ts=1"}


def test_news_documents(spark, tmp_path):
    base, data = str(tmp_path), dataset_named("financial_news")
    article = {"date": "2024-05-01T10:00:00+00:00", "title": "a", "link": "https://x", "sentiment": {"neg": 0, "neu": 1, "pos": 0, "polarity": 0}}
    readers.land_api_payload(spark, [article, article], f"{data.landing_root(base)}/snapshot_ts=1")
    assert m.migrate(spark, base, data).count() == 1


def test_all_datasets_have_suites():
    assert {d.suite.name for d in m.DATASETS} == set(quality.SUITES)
    assert all(F is not None and d.keys for d in m.DATASETS)
