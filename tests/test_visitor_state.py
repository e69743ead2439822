"""The bucketed visitor state against the rebuild from all events."""

import os
from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from siltstone_checks import inputs
from siltstone_checks.inputs import derive
from siltstone.__main__ import main
from siltstone.plans import gold, silver, visitor_state
from siltstone.sources import partitions
from tests.conftest import SMALL, rows

DAY = date(2024, 1, 1)


def events(spark, *found):
    return spark.createDataFrame(list(found), "visitor_key string, ip string, country string, at string").selectExpr(
        "visitor_key", "ip", "country", "cast(at as timestamp) as received_at"
    )


def files(root):
    """Every data file with its time of writing."""
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(root)
        for name in names
        if name.endswith(".parquet")
    }


def bucket_of(path):
    return int(path.split("bucket=")[1].split("/")[0])


def test_an_update_touches_only_its_buckets(spark, tmp_path):
    root = str(tmp_path / "state")
    many = [(f"v{i}", "1.1.1.1", "SE", "2024-01-01") for i in range(200)]
    all_buckets = visitor_state.update(spark, root, events(spark, *many), DAY, buckets=32)
    assert len(all_buckets) > 20
    before = files(root)
    late = [("v1", "0.0.0.0", None, "2023-01-01"), ("new", None, "NO", None), (None, "9", "DK", "2020-01-01")]
    touched = visitor_state.update(spark, root, events(spark, *late), DAY + timedelta(1), buckets=32)
    assert 1 <= len(touched) <= 2
    after = files(root)
    kept = {path for path in before if "/parts/" in path or bucket_of(path) not in touched}
    assert all(after[path] == before[path] for path in kept)
    assert {bucket_of(path) for path in after.keys() - before.keys()} == touched
    expected = gold.dim_visitor(events(spark, *many, *late))
    assert rows(visitor_state.dimension(spark, root)) == rows(expected)


def test_a_rerun_takes_back_what_its_date_said(spark, tmp_path):
    root = str(tmp_path / "state")
    first = [("a", "1", "SE", "2024-01-01"), ("b", "2", "NO", "2024-01-01")]
    second = [("a", "0", "DK", "2023-01-01"), ("c", "3", None, "2024-01-02")]
    visitor_state.update(spark, root, events(spark, *first), DAY, buckets=8)
    visitor_state.update(spark, root, events(spark, *second), DAY + timedelta(1), buckets=8)
    assert ("a", "0", "DK") in rows(visitor_state.dimension(spark, root))
    visitor_state.update(spark, root, events(spark, ("b", "9", "FI", "2022-01-01")), DAY + timedelta(1), buckets=8)
    assert rows(visitor_state.dimension(spark, root)) == [("a", "1", "SE"), ("b", "9", "FI")]
    for day in (DAY, DAY + timedelta(1)):  # a date without rows empties its part
        visitor_state.update(spark, root, events(spark), day, buckets=8)
    assert rows(visitor_state.dimension(spark, root)) == []
    assert visitor_state.update(spark, root, events(spark), DAY, buckets=8) == set()


def test_a_repeated_run_mends_one_that_failed_after_its_parts(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "state")
    first = [("a", "1", "SE", "2024-01-01"), ("b", "2", "NO", "2024-01-01")]
    visitor_state.update(spark, root, events(spark, *first), DAY, buckets=8)
    rerun = events(spark, ("a", "5", "SE", "2024-01-01"))

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(visitor_state, "merge_known", fail)
        with pytest.raises(OSError):
            visitor_state.update(spark, root, rerun, DAY, buckets=8)
    visitor_state.update(spark, root, rerun, DAY, buckets=8)
    assert rows(visitor_state.dimension(spark, root)) == [("a", "5", "SE")]


def test_the_number_of_buckets_stays(spark, tmp_path):
    root = str(tmp_path / "state")
    assert rows(visitor_state.dimension(spark, root)) == []
    visitor_state.update(spark, root, events(spark), DAY, buckets=8)
    with pytest.raises(ValueError, match="another number of buckets"):
        visitor_state.update(spark, root, events(spark), DAY, buckets=16)


def test_the_command_line_updates_a_date(spark, tmp_path):
    root = str(tmp_path)
    silver_events = silver.events(derive(spark, SMALL, inputs.EVENTS)).drop("ingested_date")
    partitions.write_partition(silver_events, f"{root}/silver/events", DAY)
    main(["visitor_state", "--root", root, "--ingested_date", DAY.isoformat()])
    got = rows(visitor_state.dimension(spark, f"{root}/gold/visitor_state"))
    assert got == rows(gold.dim_visitor(silver_events))


STAMPS = [None, "2024-01-01", "2024-01-02", "2024-01-03"]
ROW = st.tuples(
    st.sampled_from(["a", "b", "c", None]),
    st.sampled_from([None, "1", "2"]),
    st.sampled_from([None, "SE", "NO"]),
    st.sampled_from(STAMPS),
)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 2), st.lists(ROW, max_size=4)), min_size=2, max_size=4))
def test_any_runs_equal_the_rebuild(spark, tmp_path_factory, runs):
    root = str(tmp_path_factory.mktemp("state"))
    last = {}
    for day, found in runs:
        visitor_state.update(spark, root, events(spark, *found), DAY + timedelta(day), buckets=4)
        last[day] = found
    there = [row for found in last.values() for row in found]
    assert rows(visitor_state.dimension(spark, root)) == rows(gold.dim_visitor(events(spark, *there)))
