"""Model versions: numbers given once, readers that follow, old versions removed."""

import os

from helpers import readings_frame, rows
from pyspark.sql import functions as F

from heliograph import schemas
from heliograph.functions import wire
from heliograph.operators import tilt, training
from heliograph.sources import brokers, registry
from heliograph.streaming import jobs


def _model(spark, best):
    """A model whose best tilt is known: power is high at one tilt only."""
    data = [(f"p{n}", n, 500.0, 1.0, 1.0, 25.0) for n in range(20)]
    records = tilt.candidates(readings_frame(spark, data)).drop("power_dc_w")
    label = (F.col("tilt_deg") == best).cast("double") * 100
    return training.fit(records.withColumn("power_dc_w", label), maxIter=1, maxDepth=3)


def test_readers_follow_what_is_published(spark, tmp_path):
    root = f"{tmp_path}/models"
    assert registry.current(spark, root) is None and registry.versions(spark, root) == []
    newest = registry.follow(spark, root)
    assert newest() is newest() and newest() == training.starting_model()
    readings = readings_frame(spark, [("a", 1, 700.0, 1.0, 1.0, 30.0)])
    for number, best in ((1, 35.0), (2, 50.0)):
        assert registry.publish(spark, _model(spark, best), root) == number
        assert training.optimal_tilt(readings, newest()).first()["optimal_tilt"] == best
        assert newest() is newest()
    assert registry.current(spark, root)[0] == 2


def test_a_number_is_given_once_and_unpublished_models_are_not_seen(spark, tmp_path):
    root = f"{tmp_path}/models"
    model = _model(spark, 20.0)
    os.makedirs(f"{root}/claimed")
    open(f"{root}/claimed/1", "w").close()  # another refit that is still under way
    training.save(model, root, 1)
    assert registry.versions(spark, root) == []
    assert not registry._create(spark, f"{root}/claimed/1")
    assert registry.publish(spark, model, root) == 2
    for _ in range(3):
        registry.publish(spark, model, root, keep=2)
    assert registry.versions(spark, root) == [4, 5]
    assert not os.path.exists(f"{root}/version=3") and os.path.exists(f"{root}/version=4")


def test_a_running_job_takes_the_new_model(spark, tmp_path):
    """One job, one checkpoint: readings before and after a model is published."""
    root, out = f"{tmp_path}/models", brokers.Folder(f"{tmp_path}/out")
    registry.publish(spark, _model(spark, 10.0), root)
    first = readings_frame(spark, [("a", 1, 700.0, 1.0, 1.0, 30.0)])
    first.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(first.schema).parquet(f"{tmp_path}/in")
    query = jobs.start_tilt_control(stream, registry.follow(spark, root), out, f"{tmp_path}/checkpoints")
    try:
        query.processAllAvailable()
        registry.publish(spark, _model(spark, 45.0), root)
        readings_frame(spark, [("b", 2, 700.0, 1.0, 1.0, 30.0)]).write.mode("append").parquet(f"{tmp_path}/in")
        query.processAllAvailable()
    finally:
        query.stop()
    found = wire.decode(out.history(spark, schemas.TOPICS["control"]), "panel_id STRING, target_tilt DOUBLE")
    assert rows(found) == [("a", 10.0), ("b", 45.0)]
