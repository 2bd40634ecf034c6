"""JSON wire format: parsing with rejects, writing, and presence-aware field lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliograph import schemas
from heliograph.functions import scalars

MESSAGE_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def message_id(topic: str) -> Column:
    """Id of a message, made from its topic, panel and event time: a repeated micro-batch sends the ids it sent before.

    Messages that agree in all three have one id, as they speak of one thing. NULLs count as empty.
    """
    time = F.unix_micros(F.col(schemas.EVENT_TIME)).cast("string")
    parts = [F.lit(topic), F.coalesce(schemas.PANEL, F.lit("")), F.coalesce(time, F.lit(""))]
    return scalars.name_uuid(F.concat_ws("\n", *parts))


def text_value(messages: DataFrame) -> DataFrame:
    """Message values as text, whatever binary type the source gave them."""
    return messages.withColumn("value", F.col("value").cast("string"))


def computed_once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a column that costs much to compute and is then tested.

    Spark moves filters below projections and computes the tested column there again, once per mention. It does not
    move them below a generator, so the value comes out of one that makes a single row.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def parsed(messages: DataFrame, schema: str) -> DataFrame:
    """Messages with the struct `data` parsed from the JSON in `value`.

    Parsing is permissive: junk gives a row of NULLs, a bad field gives NULL in that field alone.
    """
    return computed_once(text_value(messages), F.from_json("value", schema), "data")


def decode(messages: DataFrame, schema: str) -> DataFrame:
    """Flat columns parsed from the JSON in `value`."""
    return parsed(messages, schema).select("data.*")


def decode_with_rejects(messages: DataFrame, schema: str, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Split messages into parsed rows and rejected texts.

    A message is rejected when any `required` field is missing or unreadable; the reject keeps key and value whole.
    """
    rows = parsed(messages, schema)
    usable = F.lit(True)
    for name in required:
        usable = usable & F.col(f"data.{name}").isNotNull()
    return rows.where(usable).select("data.*"), rows.where(~usable).drop("data")


def encode(df: DataFrame, key: str | None = None, timestamp_format: str | None = None) -> DataFrame:
    """`value` = JSON of all columns, with an optional `key` column.

    NULL fields are left out. Times have milliseconds unless `timestamp_format` says otherwise.
    """
    options = {"timestampFormat": timestamp_format} if timestamp_format else {}
    value = F.to_json(F.struct("*"), options).alias("value")
    return df.select(F.col(key).alias("key"), value) if key else df.select(value)


def fields(text: Column) -> Column:
    """JSON object as a map of texts; NULL when the text is no JSON object."""
    return F.from_json(text, "map<string,string>")


def present(found: Column, name: str, alias: str | None, default: Column) -> Column:
    """Text under `name`, else under `alias`, else the default.

    Presence decides, not NULL: a key that is there with a JSON null yields NULL and hides alias and default.
    """
    choice = F.when(F.map_contains_key(found, name), F.element_at(found, name))
    if alias:
        choice = choice.when(F.map_contains_key(found, alias), F.element_at(found, alias))
    return choice.otherwise(default)
