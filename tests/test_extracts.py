"""Pending rows land exactly once, whatever step a run dies at."""

import pytest
from conftest import plan_of

from zonelake.plans import extracts
from zonelake.plans.ingest import Extract
from zonelake.sources.manifests import Manifests

JOBS = Extract("jobs", "jobs_metadata", "id", "id BIGINT, v STRING")
SCHEMA = "id BIGINT, v STRING, status STRING, extra INT"


@pytest.fixture
def landing(spark, tmp_path):
    return extracts.Landing(spark, str(tmp_path), JOBS, 4)


def source(spark, *rows):
    return spark.createDataFrame([(i, v, s, 0) for i, v, s in rows], SCHEMA)


def test_pending_rows_land_once(spark, landing, rows):
    assert rows(landing.read()) == [] and rows(landing.counts()) == []
    first = source(spark, (1, "a", "new"), (2, "b", "exported"), (3, "c", None), (None, "d", "new"), (4, "f", "new"), (4, "e", "new"))
    assert rows(landing.to_mark(first)) == []
    assert landing.run(first, "d1", ["v"])
    assert rows(landing.read()) == [(1, "a", "d1"), (4, "e", "d1")]
    assert rows(landing.to_mark(first)) == [(1,), (4,)] and rows(landing.unidentified(first)) == [(None, "d")]
    # The source has taken one of the marks only, and has a new row.
    second = source(spark, (1, "a", "exported"), (4, "e", "new"), (5, "g", "new"))
    assert landing.run(second, "d2") and not landing.run(second, "d2")
    assert rows(landing.read()) == [(1, "a", "d1"), (4, "e", "d1"), (5, "g", "d2")]
    assert rows(landing.to_mark(second)) == [(4,), (5,)]
    assert landing.run(second, "003") and rows(landing.counts()) == [("003", 0), ("d1", 2), ("d2", 1)]


def test_a_run_that_dies_between_landing_and_naming(spark, landing, rows, monkeypatch):
    pending = source(spark, (1, "a", "new"), (2, "b", "new"))

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Manifests, "write", die)
        with pytest.raises(RuntimeError, match="lost"):
            landing.run(pending, "d1")
    # Staged, not named: no row has landed and none is to be marked.
    assert rows(landing.read()) == [] and rows(landing.to_mark(pending)) == []
    more = source(spark, (1, "a", "new"), (2, "b", "new"), (3, "c", "new"))
    assert landing.run(more, "d1")
    assert rows(landing.read()) == [(1, "a", "d1"), (2, "b", "d1"), (3, "c", "d1")]
    # Named, not marked in the source: nothing lands twice.
    assert landing.run(more, "d2") and rows(landing.counts()) == [("d1", 3), ("d2", 0)]


def test_landed_ids_are_not_shuffled(spark, landing):
    pending = source(spark, (1, "a", "new"))
    landing.run(pending, "d1")
    plan = plan_of(landing.table.absent(pending))
    assert plan.count("Exchange hashpartitioning") <= 1


def test_splits():
    assert extracts.split_of("id", 1, 100, 100, 1000) is None
    assert extracts.split_of("id", 1, 5_000_000, 2_500_000) == ("id", 1, 5_000_001, 3)
    assert extracts.split_of("id", 1, 2, 9, 1) == ("id", 1, 3, 2)
    assert extracts.bounds_query(JOBS) == "SELECT MIN(id) AS low, MAX(id) AS high, COUNT(*) AS n FROM jobs WHERE status <> 'exported'"
