"""Registered streams: what a task of a grouping holds and reads, and no micro-batch after the end."""

import glob

import pytest

from heliograph import session
from heliograph.operators import training
from heliograph.plans import catalog


def _events(spark, path, count=240):
    """Events in no order of time, some at one time, some sent twice, one without a time."""
    rows = spark.range(count).selectExpr(
        "id AS event_id",
        "CASE WHEN id <> 7 THEN timestamp_ntz'2024-01-05 00:00:00' + make_dt_interval(0, 0, 0, (id * 37 % 120) * 20) END AS ts",
        "id % 5 AS user_id",
        "element_at(array('view', 'error', 'click'), cast(id % 3 AS int) + 1) AS event_type",
        "id % 90 + 5.5D AS value",
        """concat('{"k": ', 10 + id % 80, '}') AS props""",
    )
    rows.unionAll(rows.where("event_id % 50 = 3")).repartition(3).write.parquet(f"{path}/events.parquet")
    return str(path)


def _texts(df):
    return sorted(map(str, df.collect()))


NAMES = [
    "stream_window_stats_by_grouping",
    "stream_window_stats_resent",
    "stream_job_window_stats",
    "stream_job_stats_from_enriched",
]


@pytest.mark.parametrize("name", NAMES)
def test_grouping_streams_hold_less_in_a_partition(spark, tmp_path, monkeypatch, name):
    folder = _events(spark, tmp_path)
    few = _texts(catalog.QUERIES[name](spark, folder))
    monkeypatch.setattr(catalog, "GROUPED_EVENTS", 40)
    seen, own = [], session.state_partitions
    monkeypatch.setattr(session, "state_partitions", lambda spark, number: seen.append(number) or own(spark, number))
    assert _texts(catalog.QUERIES[name](spark, folder)) == few and few
    assert 7 in seen  # 245 events


def test_tasks_of_streams_read_small_splits(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    with session.small_splits(spark):
        assert spark.conf.get(name) == f"{16 << 20}b"
        spark.conf.set(name, "1m")
        with session.small_splits(spark):
            assert spark.conf.get(name) == f"{1 << 20}b"
    assert spark.conf.get(name) == before


def test_joined_readings_end_with_their_last_rows(spark, tmp_path):
    """No micro-batch follows that only clears the state."""
    before = set(glob.glob(f"{session.shared_root(spark)}/stream_enriched_features-*"))
    assert catalog.QUERIES["stream_enriched_features"](spark, _events(spark, tmp_path)).count()
    (base,) = set(glob.glob(f"{session.shared_root(spark)}/stream_enriched_features-*")) - before
    assert len(glob.glob(f"{base}/checkpoint/commits/[0-9]*")) == 1


def _message_files(spark, tmp_path, name):
    before = set(glob.glob(f"{session.shared_root(spark)}/{name}-*"))
    assert catalog.QUERIES[name](spark, _events(spark, tmp_path)).count()
    (base,) = set(glob.glob(f"{session.shared_root(spark)}/{name}-*")) - before
    return glob.glob(f"{base}/topics/**/part-*", recursive=True)


@pytest.mark.parametrize("name", ["stream_job_enriched", "stream_refit_control", "refit_predictions"])
def test_large_topics_are_compressed(spark, tmp_path, monkeypatch, name):
    monkeypatch.setattr(training, "FINE", {"maxIter": 1, "maxDepth": 2})
    files = _message_files(spark, tmp_path, name)
    assert files and all(file.endswith(".json.gz") for file in files)
