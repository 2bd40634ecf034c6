"""Measurement streams: joining the five kinds, derived features, and fan-out to one message per kind."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from heliograph import schemas, session
from heliograph.functions import scalars, wire
from heliograph.operators import skew
from heliograph.streaming import reading_state

COPIES = "copies"
WHOLE = "decimal(38, 0)"


def watermarked(frame: DataFrame, delay: str = schemas.WATERMARK) -> DataFrame:
    """Bound how late a measurement may be. Has no effect on a batch frame."""
    return frame.withWatermark(schemas.EVENT_TIME, delay)


def join_measurements(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Inner join of the five measurement frames on panel and exact event time; batch or streaming.

    All four joins use one key, so each frame is shuffled once and no join result is shuffled again. A busy panel
    spreads over its event times. NULL keys never match, and Spark drops them before the shuffle. For a table that may
    have one reading sent very many times see `enrich_table`. Streams with watermarks give the same rows by one keyed
    state in place of four joins (see `reading_state`).
    """
    if reading_state.joinable(frames):
        return reading_state.joined(frames)
    ordered = [frames[kind] for kind in schemas.KINDS]
    return reduce(lambda left, right: left.join(right, schemas.KEYS), ordered)


def add_features(joined: DataFrame) -> DataFrame:
    """Efficiency and temperature per DC watt for every joined reading."""
    return joined.withColumns(
        {
            "efficiency": scalars.efficiency(F.col("power_ac_w"), F.col("power_dc_w")),
            "temp_per_power": scalars.temp_per_power(F.col("temperature_c"), F.col("power_dc_w")),
        }
    )


def match_measurements(frames: Mapping[str, DataFrame]) -> DataFrame:
    """The rows of `join_measurements` for feeds that send each measurement once; batch or streaming.

    The frames are stacked and grouped by panel and time, and groups with all five kinds are kept. That is one shuffle
    and, in a stream, one state store in place of four joins with two sides each. A stream gives a reading out when
    the watermark passes it. Copies of a measurement are taken once here, where the join would multiply them.
    """
    measures = [name for kind in schemas.KINDS for name in schemas.measure_names(kind)]

    def padded(number: int, kind: str) -> DataFrame:
        own = schemas.measure_names(kind)
        nothing = F.lit(None).cast("double")
        columns = [(F.col(name) if name in own else nothing).alias(name) for name in measures]
        return frames[kind].select(*schemas.KEYS, *columns, F.lit(1 << number).alias("_kinds"))

    stacked = reduce(DataFrame.unionAll, [padded(number, kind) for number, kind in enumerate(schemas.KINDS)])
    known = stacked.where(F.col(schemas.PANEL).isNotNull() & F.col(schemas.EVENT_TIME).isNotNull())
    values = [F.max(name).alias(name) for name in measures]
    # Kinds are told by bits and not by their values, as a measurement may carry a NULL.
    grouped = known.groupBy(*schemas.KEYS).agg(*values, F.bit_or("_kinds").alias("_kinds"))
    return grouped.where(F.col("_kinds") == (1 << len(schemas.KINDS)) - 1).drop("_kinds")


def enrich(frames: Mapping[str, DataFrame], once_each: bool = False) -> DataFrame:
    """Joined readings with their derived features; `once_each` promises a feed without resent measurements."""
    return add_features(match_measurements(frames) if once_each else join_measurements(frames))


def _doubles(frame: DataFrame) -> list[str]:
    return [f.name for f in frame.schema.fields if isinstance(f.dataType, DoubleType)]


def collapse_copies(frame: DataFrame) -> DataFrame:
    """One row per distinct message with the number of its `copies`.

    Counting is partial on the map side, so a message sent over and over reaches the shuffle once per task. Grouping
    takes -0.0 for 0.0, so the sign of a zero is grouped by as well and put back.
    """
    # Spark's numeric functions make no difference between the zeros; only their texts differ.
    below_zero = {
        f"_sign_{n}": F.when(F.col(n) == 0, F.col(n).cast("string") == "-0.0").otherwise(False) for n in _doubles(frame)
    }
    signed = frame.withColumns(below_zero)
    counted = signed.groupBy(*signed.columns).agg(F.count(F.lit(1)).alias(COPIES))
    restored = {n: F.when(F.col(f"_sign_{n}"), F.lit(-0.0)).otherwise(F.col(n)) for n in _doubles(frame)}
    return counted.withColumns(restored).drop(*below_zero)


def enrich_counted(frames: Mapping[str, DataFrame]) -> DataFrame:
    """`enrich` for feeds with resent messages (batch): one row per distinct joined reading.

    `copies` says how many rows the plain join would have made of it, which is the product of the copies on each side,
    as a whole number of up to 38 digits. Repeated messages are counted before the join, so n copies on each of the
    five sides stay one row.
    """
    counted = {
        kind: collapse_copies(frame).withColumnRenamed(COPIES, f"{kind}_copies") for kind, frame in frames.items()
    }
    joined = join_measurements(counted)
    per_kind = [f"{kind}_copies" for kind in schemas.KINDS]
    product = reduce(lambda a, b: (a * b).cast(WHOLE), [F.col(name).cast(WHOLE) for name in per_kind])
    return add_features(joined.withColumn(COPIES, product).drop(*per_kind))


def match_counted(frames: Mapping[str, DataFrame]) -> DataFrame:
    """The rows of `enrich_counted` from streams (or tables): one row per distinct joined reading, with `copies`.

    Copies of a message are counted in keyed state first: however often it is sent, it is one state row. The distinct
    messages of a panel and time are then gathered per kind, and combined when the watermark passes them. So resent
    messages multiply neither state nor rows, where every copy would wait in all later joins. A zero counts as 0.0.
    """
    measures = [name for kind in schemas.KINDS for name in schemas.measure_names(kind)]

    def padded(number: int, kind: str) -> DataFrame:
        own, nothing = schemas.measure_names(kind), F.lit(None).cast("double")
        columns = [(F.col(name) if name in own else nothing).alias(name) for name in measures]
        return frames[kind].select(*schemas.KEYS, F.lit(number).alias("_kind"), *columns)

    stacked = reduce(DataFrame.unionAll, [padded(number, kind) for number, kind in enumerate(schemas.KINDS)])
    known = stacked.where(F.col(schemas.PANEL).isNotNull() & F.col(schemas.EVENT_TIME).isNotNull())
    distinct = known.groupBy(*schemas.KEYS, "_kind", *measures).agg(F.count(F.lit(1)).alias("_n"))
    lists = [
        F.collect_list(F.when(F.col("_kind") == number, F.struct(*schemas.measure_names(kind), "_n"))).alias(f"_{kind}")
        for number, kind in enumerate(schemas.KINDS)
    ]
    rows = distinct.groupBy(*schemas.KEYS).agg(*lists)
    for kind in schemas.KINDS:  # a kind without a message leaves nothing
        rows = rows.withColumn(f"_{kind}", F.explode(f"_{kind}"))
    product = reduce(lambda a, b: (a * b).cast(WHOLE), [F.col(f"_{kind}._n").cast(WHOLE) for kind in schemas.KINDS])
    values = [F.col(f"_{kind}.{name}").alias(name) for kind in schemas.KINDS for name in schemas.measure_names(kind)]
    return add_features(rows.select(*schemas.KEYS, *values, product.alias(COPIES)))


def expand_copies(counted: DataFrame, block: int = 10_000) -> DataFrame:
    """Plain rows from counted rows.

    Rows with up to `block` copies are repeated where they are. Rows with more are cut into blocks, and the blocks are
    spread over the cluster before they are repeated, so no task makes a hot reading's rows alone. More than `block`
    blocks are cut in two steps, so that no row ever holds a long list.
    """
    counted = session.materialise(counted, "counted").withColumn("_left", F.col(COPIES))
    few = counted.where(F.col(COPIES) <= block)
    many = counted.where(F.col(COPIES) > block)
    for size in (block * block, block):
        part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_left") - 1) / size).cast("long")))
        left = F.least(F.lit(size).cast(WHOLE), F.col("_left") - F.col("_part").cast(WHOLE) * size).cast(WHOLE)
        many = many.withColumn("_part", part).withColumn("_left", left)
        many = many.repartition(*schemas.KEYS, "_part").drop("_part")
    spread = few.unionByName(many)
    repeated = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_left").cast("long")))
    return spread.withColumn("_copy", repeated).drop("_left", "_copy", COPIES)


def enrich_table(frames: Mapping[str, DataFrame], hot_rows: int = skew.HOT_ROWS) -> DataFrame:
    """The rows of `enrich` for tables of any content: the plain join, or, where some key has so many rows that it may
    fill a task, the counted one expanded again. Both give the same rows to the bit. Keys are counted when this is
    called, whatever the size of the tables."""
    if skew.has_hot_key([frames[kind] for kind in schemas.KINDS], schemas.KEYS, hot_rows):
        return expand_copies(enrich_counted(frames))
    return enrich(frames)


def split_measurements(readings: DataFrame) -> dict[str, DataFrame]:
    """The five measurement frames of a wide reading frame."""
    return {kind: readings.select(*schemas.KEYS, *schemas.measure_names(kind)) for kind in schemas.KINDS}


def _message(kind: str, message_id: Column) -> Column:
    body = F.struct(
        message_id.alias("measurement_id"),
        F.col("panel_id"),
        F.date_format(schemas.EVENT_TIME, wire.MESSAGE_TIME).alias("timestamp"),
        *[F.col(name) for name in schemas.measure_names(kind)],
    )
    return F.struct(
        F.lit(schemas.TOPICS[kind]).alias("topic"), F.col("panel_id").alias("key"), F.to_json(body).alias("value")
    )


def fan_out(
    readings: DataFrame, message_id: Column | None = None, kinds: list[str] = schemas.KINDS
) -> DataFrame:
    """Five keyed messages per wide reading (or those of some `kinds`): `topic`, `key`, `value`.

    Each message has an id, that of `wire.message_id` unless `message_id` is given. A Kafka sink routes by `topic`.
    """
    ids = [wire.message_id(schemas.TOPICS[kind]) if message_id is None else message_id for kind in kinds]
    messages = F.array(*[_message(kind, number) for kind, number in zip(kinds, ids)])
    return readings.select(F.explode(messages).alias("message")).select("message.*")


def measurements_from_messages(messages: DataFrame) -> dict[str, DataFrame]:
    """Typed measurement frames from a frame of `topic`, `key`, `value` messages."""
    return {
        kind: wire.decode(messages.where(F.col("topic") == schemas.TOPICS[kind]), schemas.measurement_schema(kind))
        for kind in schemas.KINDS
    }


def expected_against_actual(readings: DataFrame) -> DataFrame:
    """Noise-free DC power next to the measured one."""
    expected = scalars.expected_dc_power(F.col("irradiance_w_m2"), F.col("tilt_deg"))
    return readings.withColumn("expected_power_w", expected).withColumn(
        "shortfall_w", F.col("expected_power_w") - F.col("power_dc_w")
    )
