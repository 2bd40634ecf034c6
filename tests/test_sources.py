import glob

import pytest
from helpers import at, rows

from heliograph import schemas, session
from heliograph.sources import brokers
from heliograph.streaming import jobs


def test_kafka_options():
    kafka = brokers.Kafka("kafka:9092", max_per_batch=100, options={"failOnDataLoss": "false"})
    assert kafka.read_options("t", streaming=True) == {
        "kafka.bootstrap.servers": "kafka:9092",
        "subscribe": "t",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "100",
        "failOnDataLoss": "false",
    }
    assert kafka.read_options("t", streaming=False)["startingOffsets"] == "earliest"
    assert brokers.Kafka("k", starting="earliest").read_options("t", True)["startingOffsets"] == "earliest"
    assert kafka.write_options("t") == {"kafka.bootstrap.servers": "kafka:9092", "topic": "t"}
    assert "topic" not in kafka.write_options(None)


def _messages(spark, topics):
    data = [(t, f"k{i}", f"v{i}") for i, t in enumerate(topics)]
    return spark.createDataFrame(data, "topic STRING, key STRING, value STRING")


def test_folder_routes_by_topic(spark, tmp_path):
    folder = brokers.Folder(str(tmp_path / "topics"))
    folder.write(_messages(spark, ["a", "b", "a"]))
    folder.write(_messages(spark, ["a"]).drop("topic"), "a")
    assert rows(folder.history(spark, "a"), "key", "value") == [("k0", "v0"), ("k0", "v0"), ("k2", "v2")]
    assert rows(folder.history(spark, "b"), "topic", "key") == [("b", "k1")]


@pytest.mark.parametrize("topic", ["a", None])
@pytest.mark.parametrize("batch", [None, 3])
def test_compressed_folder_holds_the_same_messages(spark, tmp_path, monkeypatch, topic, batch):
    monkeypatch.setattr(brokers, "FILE_MESSAGES", 40)
    folder = brokers.Folder(str(tmp_path / "topics"), compression="gzip")
    messages = _messages(spark, ["a"] * 100).coalesce(1)
    folder.write(messages.drop("topic") if topic else messages, topic, batch)
    files = glob.glob(f"{tmp_path}/topics/**/part-*", recursive=True)
    assert len(files) == 3 and all(name.endswith(".json.gz") for name in files)
    assert rows(folder.history(spark, "a")) == rows(messages, "key", "value", "topic")
    out = brokers.Folder(str(tmp_path / "out"), compression="gzip")
    sent = folder.stream(spark, "a")
    out.start(sent.drop("topic") if topic else sent, topic, f"{tmp_path}/checkpoint", availableNow=True).awaitTermination()
    assert all(".json.gz" in name for name in glob.glob(f"{tmp_path}/out/topic=a/part-*"))
    assert rows(out.history(spark, "a")) == rows(messages, "key", "value", "topic")


def test_console_shows_messages(spark, capfd):
    brokers.Console(rows=1).write(_messages(spark, ["a", "b"]))
    shown = capfd.readouterr().out
    assert "k0" in shown and "k1" not in shown


@pytest.mark.parametrize("topic", ["a", None])
def test_a_repeated_batch_replaces_itself(spark, tmp_path, topic):
    folder = brokers.Folder(str(tmp_path / "topics"))
    for batch in (0, 1, 1):
        messages = _messages(spark, ["a"])
        folder.write(messages.drop("topic") if topic else messages, topic, batch)
    assert folder.history(spark, "a").count() == 2


def test_training_history_takes_the_earliest(spark, tmp_path):
    folder = brokers.Folder(str(tmp_path / "topics"))
    texts = [f'{{"panel_id":"p{i}","timestamp":"2024-01-01T12:00:0{9 - i}Z","power":{i}}}' for i in range(5)] + ["junk"]
    topic = schemas.TOPICS["sensors"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], schemas.WIRE)
    folder.write(df, topic)
    assert jobs.training_history(spark, folder).count() == 5
    found = jobs.training_history(spark, folder, max_messages=2)
    assert rows(found, "panel_id", "timestamp") == [("p3", at(6)), ("p4", at(5))]
    assert found.columns == [field.split()[0] for field in schemas.TRAINING.split(", ")]


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_root(spark) == root
    assert session.run_dir(spark, "x").startswith(f"{root}/x-")
    table = session.materialise(spark.range(3).toDF("n"), "numbers")
    assert rows(table) == [(0,), (1,), (2,)]
    assert table.inputFiles()[0].replace("file://", "").startswith(root)


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        @staticmethod
        def get(key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_root(Session())


def test_state_settings_are_given_back(spark):
    key, number = "spark.sql.streaming.stateStore.providerClass", "spark.sql.shuffle.partitions"
    before = spark.conf.get(key), spark.conf.get(number)
    spark.conf.set(number, "200")
    try:
        with session.state_settings(spark):
            assert (spark.conf.get(key), spark.conf.get(number)) == (session.ROCKSDB, "200")
            with session.state_partitions(spark, 7):
                assert spark.conf.get(number) == "7"
        assert spark.conf.get(number) == "200"
    finally:
        spark.conf.set(number, before[1])
    assert spark.conf.get(key) == before[0]
