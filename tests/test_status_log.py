"""Panel status as a base and changes: equal to the whole table, small writes, repeats, compaction."""

import os
import random

from helpers import rows, stats_frame

from heliograph import schemas
from heliograph.operators import health, stats
from heliograph.sources import brokers, status_log, tables
from heliograph.streaming import jobs

ONCE = {"availableNow": True}


def _history(seed, panels=40, minutes=24):
    rng = random.Random(seed)
    return [
        (f"p{p}", m, rng.choice([3.0, 7.0, 50.0, None]), rng.choice([20.0, 90.0]), rng.choice([5.0, 500.0]))
        for p in range(panels)
        for m in range(minutes)
        if rng.random() < 0.5
    ]


def _size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-"))


def test_the_log_follows_the_stream_through_new_bases(spark, tmp_path):
    source, base, checkpoints = brokers.Folder(f"{tmp_path}/in"), f"{tmp_path}/status", f"{tmp_path}/checkpoints"
    windows = _history(1)
    for low in range(0, 24, 4):
        part = [w for w in windows if low <= w[1] < low + 4]
        late = [w for w in windows if w[1] == low - 3][:5]  # the same windows again, too late by now
        source.write(stats.to_messages(stats_frame(spark, part + part[:3] + late)), schemas.TOPICS["window_stats"])
        started = jobs.start_status_log(spark, source, base, checkpoints, buckets=4, compact_every=2, **ONCE)
        started.awaitTermination()
        seen = stats_frame(spark, [w for w in windows if w[1] < low + 4])
        assert rows(status_log.read_status(spark, base)) == rows(health.latest_status(seen))
    # Bases after micro-batches 1, 3 and 5; two before the newest stay, with the changes after the older of them.
    assert status_log.bases(spark, base) == [1, 3, 5]
    assert status_log.changes(spark, base) == [2, 3, 4, 5]


def test_a_micro_batch_writes_and_reads_its_own_panels(spark, tmp_path):
    root = f"{tmp_path}/status"
    fleet = [(f"p{p}", 0, 50.0, 20.0, 500.0) for p in range(5000)]
    status_log.advance(stats_frame(spark, fleet), root, 0, 16)
    status_log.compact(spark, root, 0, 16)
    status_log.advance(stats_frame(spark, [("p7", 1, 3.0, 20.0, 500.0)]), root, 1, 16)
    assert _size(f"{root}/changes/batch=1") * 20 < _size(f"{root}/base=0")
    only = spark.createDataFrame([("p7",)], "p STRING").select(status_log.bucket("p", 16)).first()[0]
    chosen = status_log.read(spark, root, only=[only])
    scans = chosen._jdf.queryExecution().executedPlan().toString().split("FileScan")[1:]
    assert len(scans) == 2 and all(f"(bucket#" in s and f" = {only})" in s.split("PartitionFilters: ")[1] for s in scans)
    assert chosen.count() < 1000
    found = {r[0]: r for r in status_log.read_status(spark, root).collect()}
    assert len(found) == 5000 and found["p7"]["is_broken"] and not found["p8"]["is_broken"]


def test_repeats_and_cut_off_writes(spark, tmp_path):
    """A micro-batch that is done again after its base was written reads the state before it; half a base is no base."""
    root = f"{tmp_path}/status"
    drops = [[("a", 0, 3.0, 20.0, 500.0), ("b", 0, 50.0, 20.0, 500.0)], [("a", 1, 3.0, 20.0, 500.0)], [("b", 2, 3.0, 20.0, 500.0)]]
    for n, drop in enumerate(drops):
        status_log.advance(stats_frame(spark, drop), root, n, 4)
        status_log.compact(spark, root, n, 4)
        before = rows(status_log.read_status(spark, root))
        status_log.advance(stats_frame(spark, drop), root, n, 4)
        status_log.compact(spark, root, n, 4)
        assert rows(status_log.read_status(spark, root)) == before
    assert before == rows(health.latest_status(stats_frame(spark, sum(drops, []))))
    os.remove(f"{root}/base=2/_SUCCESS")
    assert status_log.bases(spark, root) == [0, 1]
    assert rows(status_log.read_status(spark, root)) == before


def test_empty_folder_and_empty_batches(spark, tmp_path):
    root = f"{tmp_path}/status"
    assert status_log.read_status(spark, root).collect() == []
    status_log.advance(stats_frame(spark, []), root, 0, 4)
    status_log.advance(stats_frame(spark, [("", 0, 3.0, 20.0, 1.0), (None, 0, 3.0, 20.0, 1.0)]), root, 1, 4)
    status_log.compact(spark, root, 1, 4)
    assert status_log.read_status(spark, root).collect() == []
    assert status_log.read_status(spark, root).columns == tables.read_status(spark, root).columns
