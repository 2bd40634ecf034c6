"""Panel health as keyed state: create, break, hold, recover."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from heliograph.operators import health

# The processor travels to the executors whole, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Times are kept in microseconds, which no worker's time zone changes.
STATE = "is_broken BOOLEAN, broken_since BIGINT, reason STRING, last_window BIGINT"

# The windows of one micro-batch that wait, each as JSON of what _WINDOW names, in one line of text each.
WAITING = "windows STRING"
_WINDOW = ["start", "end", "avg_efficiency", "avg_temp", "avg_irradiance", "reason_code", "reason", "as_of"]

CHANGES = (
    "panel_id STRING, window_start TIMESTAMP, window_end TIMESTAMP, avg_efficiency DOUBLE, avg_temperature DOUBLE, "
    "avg_irradiance DOUBLE, is_broken BOOLEAN, reason_code INT, broken_since TIMESTAMP, reason STRING, change STRING"
)

# How numpy writes a missing time.
NO_TIME = np.iinfo("int64").min

_COLUMNS = [field.split()[0] for field in CHANGES.split(", ")]

# Changes with times in microseconds, as plain rows.
_CHANGES_IN_MICROS = CHANGES.replace("TIMESTAMP", "BIGINT")
_change = Row(*_COLUMNS)


class PanelHealth(StatefulProcessor):
    """Emits a panel's status after each of its windows and remembers the last one.

    The rules have been applied in the JVM already; here is only what depends on the panel's past. A micro-batch may
    deliver windows in any order, so they are put in time order first. A window that does not begin after the last one
    of an earlier micro-batch came too late, or was sent again, and is rejected. What is held at once is one row per
    new window of the panel in the micro-batch, which `max_per_batch` of the source bounds.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState("last", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self._last.get() if self._last.exists() else None
        broken, since, reason, seen = state or (False, None, None, None)
        # Plain rows, as a panel has few and pandas would cost more for each step than they do.
        windows: dict[tuple, None] = {}  # a window sent twice counts once
        for part in rows:
            times = [_whole_micros(part[name]) for name in ("window_start", "window_end", "as_of")]
            means = [_plain(part[name]) for name in ("avg_efficiency", "avg_temp", "avg_irradiance")]
            rules = [part["is_broken"].astype(bool).tolist(), part["reason_code"].tolist(), _plain(part["reason"])]
            for row in zip(*times, *means, *rules, strict=True):
                if seen is None or row[0] > seen:
                    windows[row] = None
        if not windows:
            return

        made = []
        for start, end, as_of, *means, is_broken, code, why in sorted(windows, key=lambda r: (r[0] == NO_TIME, r[0])):
            change = None
            if is_broken and not broken:
                since, reason, change = as_of, why, "broken"
            elif not is_broken:
                change = "recovered" if broken else None
                since = reason = None
            broken = is_broken
            made.append((key[0], start, end, *means, broken, code, NO_TIME if since is None else since, reason, change))

        found = dict(zip(_COLUMNS, zip(*made, strict=True), strict=True))
        for name in ("window_start", "window_end", "broken_since"):
            found[name] = np.array(found[name], "int64").view("datetime64[us]").astype("datetime64[ns]")
        for name in ("avg_efficiency", "avg_temperature", "avg_irradiance"):
            found[name] = np.array(found[name], "float64")
        self._last.update((broken, since, reason, made[-1][1]))
        yield pd.DataFrame(found)

    def close(self) -> None:
        pass


def _whole_micros(times: pd.Series) -> list[int]:
    return times.to_numpy().astype("datetime64[us]").astype("int64").tolist()


def _plain(values: pd.Series) -> list:
    return [None if pd.isna(v) else v for v in values]


class OrderedPanelHealth(StatefulProcessor):
    """Emits a panel's status after each of its windows, in the order of time, once no earlier window can come.

    Windows wait in a list, which every micro-batch appends to without reading it. A timer at the earliest one waiting
    fires when the watermark has passed it. The windows up to the watermark are then put in order and judged one by
    one, and the others wait on. So what a panel holds is what came within the delay, one row per window; its size is
    set by the delay and the width of the windows, however the rows were cut into micro-batches.

    It takes and gives plain rows with times in microseconds, as a panel has few rows at a time and a pandas frame for
    each panel would cost far more than they do. A micro-batch's windows of a panel are one text in the list, since each
    value of a list is sent to the state store, and back, by itself.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", "is_broken BOOLEAN, broken_since BIGINT, reason STRING")
        self._waiting = handle.getListState("waiting", WAITING)
        self._timer = handle.getValueState("timer", "at BIGINT")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        waiting = [(start, window) for _, _, start, window in rows]
        if waiting:
            self._waiting.appendValue(("\n".join(window for _, window in waiting),))
            self._wake_at(min(start for start, _ in waiting))
        return iter(())

    def _wake_at(self, micros: int) -> None:
        """One timer per panel, at the earliest window that waits."""
        at = -(-micros // 1000)
        known = self._timer.get()[0] if self._timer.exists() else None
        if known is not None and known <= at:
            return
        if known is not None:
            self._handle.deleteTimer(known)
        self._handle.registerTimer(at)
        self._timer.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        self._timer.clear()
        due: dict[tuple, tuple] = {}  # a window sent twice counts once
        later = []
        for (lines,) in self._waiting.get():
            for line in lines.split("\n"):
                found = json.loads(line)
                if found["start"] > passed:
                    later.append((found["start"], line))
                    continue
                row = tuple(found.get(name) for name in _WINDOW)
                due.setdefault(row[:5], row)
        if later:
            self._waiting.put([("\n".join(line for _, line in later),)])
            self._wake_at(min(start for start, _ in later))
        else:
            self._waiting.clear()

        broken, since, reason = self._last.get() if self._last.exists() else (None, None, None)
        made = []
        for row in sorted(due.values(), key=lambda r: r[:2]):
            start, end, *means, code, why, as_of = row
            means = [None if mean is None else float(mean) for mean in means]  # JSON has infinity as text
            breaks = code != health.HEALTHY and not broken
            recovers = code == health.HEALTHY and bool(broken)
            broken = code != health.HEALTHY
            if not broken:
                since = reason = None
            elif breaks:
                since, reason = as_of, why
            change = "broken" if breaks else "recovered" if recovers else None
            made.append(_change(key[0], start, end, *means, broken, code, since, reason, change))
        if made:
            self._last.update((broken, since, reason))
        yield from made

    def close(self) -> None:
        pass


def panel_changes(stats: DataFrame, clock: Column | None = None) -> DataFrame:
    """Status of every panel after each of its windows, from a stream of window statistics.

    Same rows as `health.timeline` gives for a table of the accepted windows: those that begin after every window of
    their panel in earlier micro-batches. Needs the RocksDB state store on the session.
    """
    return (
        health.classify(stats, clock)
        .groupBy("panel_id")
        .transformWithStateInPandas(
            statefulProcessor=PanelHealth(), outputStructType=CHANGES, outputMode="Append", timeMode="None"
        )
    )


def ordered_changes(stats: DataFrame, lateness: str, clock: Column | None = None) -> DataFrame:
    """The same with windows that come late, by up to `lateness`, put in their place.

    A window is judged when the watermark, `lateness` behind the latest start of a window, has reached its start. Up to
    there the rows are those that `health.timeline` gives for a table of all windows, in whatever order they came.
    Windows later than that are dropped and counted by Spark (`numRowsDroppedByWatermark`); those without a start are
    left out. Needs the RocksDB state store on the session.
    """
    timed = stats.where("window_start IS NOT NULL AND window_end IS NOT NULL").withWatermark("window_start", lateness)
    # The start stays as a time as well, by which Spark tells late windows.
    micros = {"start": "window_start", "end": "window_end", "as_of": "as_of"}
    judged = health.classify(timed, clock).withColumns({name: F.unix_micros(time) for name, time in micros.items()})
    means = ("avg_efficiency", "avg_temp", "avg_irradiance")
    told = judged.withColumns({name: F.nanvl(name, F.lit(None)) for name in means}).select(
        "panel_id", "window_start", "start", F.to_json(F.struct(*_WINDOW)).alias("window")
    )
    changes = told.groupBy("panel_id").transformWithState(
        statefulProcessor=OrderedPanelHealth(),
        outputStructType=_CHANGES_IN_MICROS,
        outputMode="Append",
        timeMode="EventTime",
    )
    times = ("window_start", "window_end", "broken_since")
    return changes.withColumns({name: F.timestamp_micros(name) for name in times})
