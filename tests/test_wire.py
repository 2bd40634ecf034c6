import json

from helpers import at, rows

from heliograph import schemas
from heliograph.functions import wire

SCHEMA = "panel_id STRING, timestamp TIMESTAMP, x DOUBLE"


def _messages(spark, values):
    return spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], schemas.WIRE)


def test_permissive_parsing(spark):
    values = [
        '{"panel_id":"a","timestamp":"2024-01-01T12:00:00+00:00","x":1.5}',
        '{"panel_id":"b","timestamp":"soon","x":2}',
        '{"panel_id":"c","timestamp":"2024-01-01T12:00:00Z","x":"3"}',
        "junk",
        "[1]",
    ]
    found = [tuple(r) for r in wire.decode(_messages(spark, values), SCHEMA).collect()]
    nothing = (None, None, None)
    assert found == [("a", at(0), 1.5), ("b", None, 2.0), ("c", at(0), None), nothing, nothing]


def test_binary_values_are_read_as_text(spark):
    df = spark.createDataFrame([(bytearray(b'{"panel_id":"a"}'),)], "value BINARY")
    assert wire.decode(df, "panel_id STRING").first()[0] == "a"


def test_rejects_are_kept_whole(spark):
    values = ['{"panel_id":"a","timestamp":"2024-01-01T12:00:00Z","x":1}', "junk", '{"panel_id":"b","x":1}']
    good, bad = wire.decode_with_rejects(_messages(spark, values), SCHEMA, ["panel_id", "timestamp"])
    assert rows(good) == [("a", at(0), 1.0)]
    assert rows(bad) == [("1", "junk"), ("2", '{"panel_id":"b","x":1}')]


def test_encoding_leaves_nulls_out_and_cuts_to_milliseconds(spark):
    df = spark.createDataFrame([("a", at(0.123456), None)], SCHEMA)
    row = wire.encode(df, key="panel_id").first()
    assert row.key == "a"
    assert json.loads(row.value) == {"panel_id": "a", "timestamp": "2024-01-01T12:00:00.123Z"}
    whole = wire.encode(df, timestamp_format=wire.MESSAGE_TIME).first()
    assert json.loads(whole.value)["timestamp"] == "2024-01-01T12:00:00.123456+00:00"


def test_filters_do_not_parse_again(spark):
    plan = wire.decode(_messages(spark, ["{}"]), SCHEMA).where("panel_id IS NOT NULL AND x > 1")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1
