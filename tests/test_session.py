"""State of the registered streams: its partitions follow the table, its memory is bounded."""

from heliograph import session
from heliograph.plans import catalog


def _events(spark, path, count):
    rows = spark.range(count).selectExpr(
        "id AS event_id",
        "timestamp_ntz'2024-01-05 00:00:00' + make_dt_interval(0, 0, 0, id * 600) AS ts",
        "id % 5 AS user_id",
        "'view' AS event_type",
        "id % 90 + 5.5D AS value",
        """concat('{"k": ', 10 + id % 80, '}') AS props""",
    )
    rows.write.parquet(f"{path}/events.parquet")
    return str(path)


def test_state_partitions_grow_with_the_events(spark, tmp_path, monkeypatch):
    """A task's state stays as it is when the table grows; the windows are the same."""
    folder, cores = _events(spark, tmp_path, 200), spark.sparkContext.defaultParallelism
    assert catalog._state_partitions(spark, folder) == cores
    few = sorted(map(str, catalog.QUERIES["stream_window_stats_resent"](spark, folder).collect()))
    monkeypatch.setattr(catalog, "STATE_EVENTS", 20)
    assert catalog._state_partitions(spark, folder) == max(cores, 10) > cores
    seen, own = [], session.state_partitions
    monkeypatch.setattr(session, "state_partitions", lambda spark, number: seen.append(number) or own(spark, number))
    assert sorted(map(str, catalog.QUERIES["stream_window_stats_resent"](spark, folder).collect())) == few and few
    assert seen == [10]


def test_stores_share_a_bound_of_memory_and_write_without_reading(spark):
    prefix = "spark.sql.streaming.stateStore.rocksdb"
    with session.state_settings(spark):
        assert spark.conf.get(f"{prefix}.boundedMemoryUsage") == "true"
    with session.uncounted_state(spark):
        assert spark.conf.get(f"{prefix}.trackTotalNumberOfRows") == "false"
    assert spark.conf.get(f"{prefix}.trackTotalNumberOfRows", None) != "false"  # jobs of their own still count
    assert spark.conf.get(f"{prefix}.boundedMemoryUsage", None) != "true"


def test_topics_are_written_without_a_sort(spark, tmp_path):
    rows = spark.range(40).selectExpr("concat('t', id % 5) AS topic", "id")
    rows.write.partitionBy("topic").parquet(f"{tmp_path}/out")
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 5
    assert spark.read.parquet(f"{tmp_path}/out").count() == 40
