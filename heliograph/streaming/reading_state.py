"""Five measurement streams joined in one keyed state."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from heliograph import schemas

# The processor travels to the executors whole, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Panels and times are dealt by hash to so many groups. A checkpoint holds them, so the number must stay.
GROUPS = 1024

# Joined rows that are handed on at once.
PART = 10_000

# The measurements that wait, as one compressed Arrow stream, and the time at which a timer clears them.
STATE = "waiting BINARY, timer BIGINT"

_MEASURES = {kind: schemas.measure_names(kind) for kind in schemas.KINDS}
_NUMBERS = range(len(_MEASURES))
_FLAT = [name for names in _MEASURES.values() for name in names]
_WIDEST = max(map(len, _MEASURES.values()))
_VALUES = [f"v{n}" for n in range(_WIDEST)]
_COLUMNS = ["panel", "micros", "kind", "missing", *_VALUES]
_JOINED = ", ".join(["panel BINARY", "micros BIGINT", *[f"{name} DOUBLE" for name in _FLAT], "missing BIGINT"])


class JoinedReadings(StatefulProcessor):
    """Gives out the readings that a micro-batch completes, at once, and keeps every measurement until the watermark
    has passed it.

    The rows are those of an inner join of the five streams on panel and time: measurements of a kind, panel and time
    that come more than once multiply. A measurement that the watermark has passed already, which Spark lets in for one
    micro-batch, meets what waits and no other new one, as in Spark's join. A group holds very many panels and times, so
    they are matched by columns; what a group keeps is one value of the state, where Spark's join keeps every
    measurement and every partial reading as two rows in each of four stores.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("measurements", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        new = pd.concat([part.set_axis(["group", *_COLUMNS], axis=1)[_COLUMNS] for part in rows], ignore_index=True)
        waiting, timer = self._waiting()
        known = pd.concat([waiting, new], ignore_index=True) if len(waiting) else new
        is_new = np.arange(len(known)) >= len(waiting)
        kept = known[known["micros"].to_numpy() > passed]
        self._keep(kept, timer)
        yield from _joined(known, is_new, passed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # The one timer of a group is at its latest measurement, so nothing waits any more.
        self._state.clear()
        return iter(())

    def _waiting(self) -> tuple[pd.DataFrame, int | None]:
        found = self._state.get()
        if found is None:
            return pd.DataFrame(columns=_COLUMNS), None
        with pa.ipc.open_stream(pa.py_buffer(bytes(found[0]))) as stream:
            table = stream.read_all()
        columns = {name: table[name].to_numpy() for name in _COLUMNS[1:]}
        panels = table["panel"].combine_chunks()
        names = np.array(panels.dictionary.to_pylist(), dtype=object)
        return pd.DataFrame({"panel": names[panels.indices.to_numpy()], **columns}), found[1]

    def _keep(self, rows: pd.DataFrame, timer: int | None) -> None:
        """Remember these rows, with one timer at the latest."""
        if rows.empty:
            if timer is not None:
                self._handle.deleteTimer(timer)
            self._state.clear()
            return
        at = -(-int(rows["micros"].max()) // 1000)
        if at != timer:
            if timer is not None:
                self._handle.deleteTimer(timer)
            self._handle.registerTimer(at)
        codes, names = pd.factorize(rows["panel"].to_numpy())
        panels = pa.DictionaryArray.from_arrays(pa.array(codes, pa.int32()), pa.array(list(names), pa.binary()))
        batch = pa.record_batch([panels, *[pa.array(rows[name].to_numpy()) for name in _COLUMNS[1:]]], names=_COLUMNS)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_batch(batch)
        self._state.update((sink.getvalue().to_pybytes(), at))

    def close(self) -> None:
        pass


def _joined(known: pd.DataFrame, is_new: np.ndarray, passed: int) -> Iterator[pd.DataFrame]:
    """Every combination of measurements of the five kinds with one panel and time, of which one at least is new."""
    micros, kind = known["micros"].to_numpy(), known["kind"].to_numpy()
    panel, panels = pd.factorize(known["panel"].to_numpy())
    time, times = pd.factorize(micros)
    reading, readings = pd.factorize(panel * len(times) + time)
    touched = np.zeros(len(readings), bool)
    touched[reading[is_new]] = True
    kinds = np.zeros(len(readings), "int64")
    np.bitwise_or.at(kinds, reading, 1 << kind.astype("int64"))
    complete = touched & (kinds == (1 << len(_NUMBERS)) - 1)
    sides = []
    for number in _NUMBERS:
        rows = np.flatnonzero((kind == number) & complete[reading])
        sides.append(pd.DataFrame({"reading": reading[rows], f"row_{number}": rows}))
    matched = reduce(lambda left, right: left.merge(right, on="reading"), sides)
    rows = [matched[f"row_{number}"].to_numpy() for number in _NUMBERS]
    fresh = sum(is_new[found].astype("int64") for found in rows)
    wanted = (fresh > 0) & ((micros[rows[0]] > passed) | (fresh == 1))
    values, missing = known[_VALUES].to_numpy("float64"), known["missing"].to_numpy().astype("int64")
    chosen = np.flatnonzero(wanted)
    for start in range(0, len(chosen), PART):
        part = [found[chosen[start : start + PART]] for found in rows]
        made = {"panel": panels[panel[part[0]]], "micros": micros[part[0]]}
        for found, names in zip(part, _MEASURES.values(), strict=True):
            made |= {name: values[found, place] for place, name in enumerate(names)}
        yield pd.DataFrame({**made, "missing": reduce(np.bitwise_or, [missing[found] for found in part])})


def joinable(frames: Mapping[str, DataFrame]) -> bool:
    """Whether these are five streams as `joined` takes them: with watermarks, and no columns but their own."""

    def fits(kind: str) -> bool:
        frame = frames[kind]
        types = {schemas.PANEL: "string", schemas.EVENT_TIME: "timestamp", **dict.fromkeys(_MEASURES[kind], "double")}
        return frame.isStreaming and dict(frame.dtypes) == types and bool(frame.schema[schemas.EVENT_TIME].metadata)

    return all(map(fits, schemas.KINDS))


def joined(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Inner join of the five watermarked measurement streams on panel and exact event time.

    The rows come as soon as their five measurements are there. Needs the RocksDB state store on the query.
    """
    watermark = frames[schemas.KINDS[0]].schema[schemas.EVENT_TIME].metadata

    def stacked(number: int, kind: str) -> DataFrame:
        names = _MEASURES[kind]
        # By bits, since NULL and NaN are one in the columns that Python sees.
        missing = reduce(
            lambda a, b: a + b,
            [F.when(F.col(name).isNull(), F.lit(1 << _FLAT.index(name))).otherwise(F.lit(0)) for name in names],
        )
        empty = [F.lit(0.0)] * (_WIDEST - len(names))
        return frames[kind].where(F.col(schemas.PANEL).isNotNull() & F.col(schemas.EVENT_TIME).isNotNull()).select(
            F.pmod(F.xxhash64(*schemas.KEYS), F.lit(GROUPS)).alias("group"),
            F.col(schemas.PANEL).cast("binary").alias("panel"),
            # Microseconds, which no worker's time zone changes; the column tells Spark late measurements as the time did.
            F.unix_micros(schemas.EVENT_TIME).alias("micros", metadata=watermark),
            F.lit(number).cast("long").alias("kind"),
            missing.cast("long").alias("missing"),
            *[value.alias(name) for value, name in zip([*map(F.col, names), *empty], _VALUES, strict=True)],
        )

    rows = reduce(DataFrame.unionAll, [stacked(number, kind) for number, kind in enumerate(schemas.KINDS)])
    found = rows.groupBy("group").transformWithStateInPandas(
        statefulProcessor=JoinedReadings(), outputStructType=_JOINED, outputMode="Append", timeMode="EventTime"
    )
    return found.select(
        F.col("panel").cast("string").alias(schemas.PANEL),
        F.timestamp_micros("micros").alias(schemas.EVENT_TIME, metadata=watermark),
        *[
            F.when(F.col("missing").bitwiseAND(F.lit(1 << place)) == 0, F.coalesce(name, F.lit(float("nan")))).alias(name)
            for place, name in enumerate(_FLAT)
        ],
    )
