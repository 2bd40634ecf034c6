"""Telemetry derived from the `events` table, one wide reading per event, as batch or stream.

Every rule below has its SQL twin in `heliograph.plans.oracle`. A sensor that has nothing to report leaves a gap: the
measurement frames leave out such readings, and the join then loses them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph import schemas
from heliograph.functions import wire
from heliograph.operators import telemetry, tilt

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"

# Time used where a message or request has none, so that results can be repeated.
NO_TIME = "2024-02-01 12:00:00"

# Added to the whole percents of efficiency, so that no average of a few lies on a limit of the health rules, where
# the last digits of a sum would decide.
OFF_LIMITS = 0.371

# Odd number texts and how often they occur.
ODD_NUMBERS = {"0x1p3": 60, "1_0": 70}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table."""
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of files. The pattern lets the table be one file or a folder of files."""
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/event[s].parquet")


def _wide(rows: DataFrame) -> DataFrame:
    k = F.from_json("props", "k INT")["k"]
    dc = F.when(F.col("event_id") % 20 == 0, 0.0).otherwise(F.col("value"))
    return rows.select(
        F.concat(F.lit("panel-"), F.col("user_id")).alias("panel_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.least(F.col("value") * 10, F.lit(1200.0)).alias("irradiance_w_m2"),
        (dc * (k + OFF_LIMITS) / 100).alias("power_ac_w"),
        dc.alias("power_dc_w"),
        (15 + F.col("event_id") % 80).cast("double").alias("temperature_c"),
        (20 + 10 * (F.col("user_id") % 3)).cast("double").alias("tilt_deg"),
        (180 + 15 * (F.col("user_id") % 4)).cast("double").alias("azimuth_deg"),
        "event_id",
        "event_type",
        "value",
        k.alias("k"),
    )


def readings(rows: DataFrame) -> DataFrame:
    """One wide reading per event."""
    return _wide(rows).select(*schemas.KEYS, *[name for kind in schemas.KINDS for name in schemas.measure_names(kind)])


def _reports(kind: str) -> Column:
    return {
        "irradiance": F.col("value") <= 200,
        "power_ac": F.col("k") >= 3,
        "power_dc": F.col("value") >= 1,
        "temperature": ~((F.col("event_type") == "error") & (F.col("k") > 90)),
        "orientation": ~((F.col("event_type") == "signup") & (F.col("value") > 150)),
    }[kind]


def measurements(rows: DataFrame) -> dict[str, DataFrame]:
    """The five measurement frames, with gaps."""
    wide = _wide(rows)
    return {
        kind: wide.where(_reports(kind)).select(*schemas.KEYS, *schemas.measure_names(kind))
        for kind in schemas.KINDS
    }


def resent(rows: DataFrame) -> dict[str, DataFrame]:
    """The measurement frames of a feed that sends error readings twice on every topic."""
    once, twice = measurements(rows), measurements(rows.where("event_type = 'error'"))
    return {kind: once[kind].unionAll(twice[kind]) for kind in schemas.KINDS}


def with_hot_readings(rows: DataFrame, copies: int) -> dict[str, DataFrame]:
    """The measurement frames of a feed in which every 500th reading's temperature is sent `copies` more times."""
    frames = measurements(rows)
    often = F.explode(F.sequence(F.lit(1), F.lit(copies)))
    sent = measurements(rows.where("event_id % 500 = 1"))["temperature"].withColumn("copy", often).drop("copy")
    return {**frames, "temperature": frames["temperature"].unionAll(sent)}


def in_drops(rows: DataFrame, numbers: int) -> list[DataFrame]:
    """The events in stretches of time of equal width, as they would arrive."""
    time = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = rows.agg(F.min(time), F.max(time)).first()
    place = F.floor((time - F.lit(first)) * numbers / F.lit(last - first + 1))
    return [rows.where(place == n) for n in range(numbers)]


def events_by_drops(spark: SparkSession, sf_dir: str, path: str, numbers: int = 5) -> DataFrame:
    """The events table as a stream that arrives in drops, one file and one micro-batch each. Drops split hours."""
    for drop in in_drops(events(spark, sf_dir), numbers):
        drop.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(path)


def messages(rows: DataFrame, kinds: list[str] = schemas.KINDS) -> DataFrame:
    """JSON messages of every reading, the event id standing in for the random message id."""
    return telemetry.fan_out(_wide(rows), F.col("event_id").cast("string"), kinds)


def raw_messages(rows: DataFrame) -> DataFrame:
    """Temperature messages of which some are junk, untimed or of the wrong type, depending on the event type."""
    wide = _wide(rows)
    time = F.date_format("timestamp", wire.MESSAGE_TIME)
    good = F.to_json(F.struct("panel_id", time.alias("timestamp"), "temperature_c"))
    quoted = F.to_json(F.struct("panel_id", time.alias("timestamp"), F.lit("3").alias("temperature_c")))
    untimed = F.to_json(F.struct("panel_id", F.lit("soon").alias("timestamp"), "temperature_c"))
    value = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("junk "), "event_id"))
        .when((F.col("event_type") == "click") & (F.col("k") < 50), quoted)
        .when((F.col("event_type") == "view") & (F.col("k") < 50), untimed)
        .otherwise(good)
    )
    return wide.select(F.col("event_id").cast("string").alias("key"), value.alias("value"))


def training_messages(rows: DataFrame) -> DataFrame:
    """Training messages in all the shapes that occur: canonical, aliased, with gaps, with nulls, unreadable."""
    wide = _wide(rows).withColumn("time", F.date_format("timestamp", wire.MESSAGE_TIME))
    time = F.col("time").alias("timestamp")
    canonical = F.struct("panel_id", time, *[F.col(n) for kind in schemas.KINDS for n in schemas.measure_names(kind)])
    aliased = F.struct(
        "panel_id",
        time,
        F.col("irradiance_w_m2").alias("irradiance"),
        F.col("power_dc_w").alias("power"),
        F.col("temperature_c").alias("temp"),
        F.col("tilt_deg").alias("tilt"),
        F.col("azimuth_deg").alias("azimuth"),
    )
    sparse = F.struct("panel_id", time, "irradiance_w_m2")
    null_number = F.struct("panel_id", time, F.lit(None).cast("double").alias("temperature_c"))
    hexadecimal, underscored = ODD_NUMBERS
    number = (
        F.when(F.col("k") < ODD_NUMBERS[hexadecimal], hexadecimal)
        .when(F.col("k") < ODD_NUMBERS[underscored], underscored)
        .otherwise(F.col("power_dc_w").cast("string"))
    )
    quoted = F.struct("panel_id", time, number.alias("power_dc_w"))
    bad_number = F.struct("panel_id", time, F.lit("abc").alias("irradiance"))
    nameless = F.struct(F.lit("yesterday").alias("timestamp"), "power_dc_w")
    kind, k = F.col("event_type"), F.col("k")
    value = (
        F.when(kind == "view", F.to_json(canonical))
        .when(kind == "click", F.to_json(aliased))
        .when(kind == "purchase", F.to_json(sparse))
        .when((kind == "signup") & (k < 50), F.to_json(null_number, {"ignoreNullFields": "false"}))
        .when(kind == "signup", F.to_json(quoted))
        .when(k < 30, F.to_json(bad_number))
        .when(k < 60, F.concat(F.lit("{broken "), "event_id"))
        .otherwise(F.to_json(nameless))
    )
    return wide.select(F.col("event_id").cast("string").alias("key"), value.alias("value"))


def labelled_messages(rows: DataFrame, label: Column) -> DataFrame:
    """Training messages that state a given power for every candidate tilt of every reading."""
    # Dealt anew first, as a table of one small file would make its many messages in few tasks.
    spread = readings(rows).repartition(4 * rows.sparkSession.sparkContext.defaultParallelism)
    # A reading's candidates have one text of its time.
    timed = spread.withColumn("_time", F.date_format("timestamp", wire.MESSAGE_TIME))
    powered = tilt.candidates(timed).withColumn("power_dc_w", label.cast("double"))
    measures = [name for kind in schemas.KINDS for name in schemas.measure_names(kind) if name != "power_ac_w"]
    body = F.struct("panel_id", F.col("_time").alias("timestamp"), *measures)
    return powered.select(F.col("panel_id").alias("key"), F.to_json(body).alias("value"))


def prediction_requests(rows: DataFrame) -> DataFrame:
    """Prediction requests, some without light, temperature, panel, time or send flag."""
    kind, k = F.col("event_type"), F.col("k")
    return _wide(rows).select(
        "event_id",
        F.when((kind != "signup") | (k >= 20), F.col("panel_id")).alias("panel_id"),
        (F.col("value") * 10 - 20).alias("irradiance_w_m2"),
        F.when((kind != "error") | (k >= 10), F.col("temperature_c")).alias("temperature_c"),
        F.when((kind != "view") | (k >= 5), F.col("timestamp")).alias("timestamp"),
        F.when(k < 95, k % 2 == 0).alias("send_to_kafka"),
        (2.5 * (k % 25)).alias("ideal_tilt"),
    )


def no_time() -> Column:
    """The stand-in time as a column."""
    return F.lit(NO_TIME).cast("timestamp")


def anonymous() -> dict[str, Column]:
    """What a request has besides its numbers, all of it missing."""
    return {
        "panel_id": F.lit(None).cast("string"),
        "timestamp": F.lit(None).cast("timestamp"),
        "send_to_kafka": F.lit(None).cast("boolean"),
    }


def read_together(rows: DataFrame) -> DataFrame:
    """Each reading three times at its exact time, by panels of their own, with 0, 60 and 120 W more."""
    extra = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("n")
    return rows.select("*", extra).select(
        F.concat("panel_id", F.lit("/"), "n").alias("panel_id"),
        "timestamp",
        "irradiance_w_m2",
        (F.col("power_dc_w") + 60 * F.col("n")).alias("power_dc_w"),
    )
