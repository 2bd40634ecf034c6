"""Windows that wait in the state of a panel: sent as one, judged in order."""

import json
from types import SimpleNamespace

from pyspark.sql import Row

from heliograph.streaming import panel_state


class _Kept:
    """State of one panel; counts what is sent to it."""

    def __init__(self):
        self.rows, self.sent = [], 0

    def exists(self):
        return bool(self.rows)

    def get(self):
        return iter(self.rows)

    def appendValue(self, row):
        self.rows.append(row)
        self.sent += 1

    def put(self, rows):
        self.rows = rows

    def clear(self):
        self.rows = []


class _Value(_Kept):
    def get(self):
        return self.rows[0]

    def update(self, row):
        self.rows = [row]


def test_windows_that_wait_are_sent_to_the_state_as_one():
    kept = {"last": _Value(), "waiting": _Kept(), "timer": _Value()}
    handle = SimpleNamespace(
        getValueState=lambda name, _: kept[name],
        getListState=lambda name, _: kept[name],
        registerTimer=lambda at: None,
        deleteTimer=lambda at: None,
    )
    panel = panel_state.OrderedPanelHealth()
    panel.init(handle)
    incoming = Row("panel_id", "window_start", "start", "window")

    def window(start, **values):
        told = {"start": start, "end": start + 60, "reason_code": 0, "as_of": start + 60, **values}
        return incoming("p", None, start, json.dumps(told))

    broken = {"avg_efficiency": 3.0, "reason_code": 1, "reason": "Low\nefficiency"}
    rows = [window(2000, **broken), window(1000, avg_temp="Infinity"), window(2000, **broken), window(9000)]
    assert list(panel.handleInputRows(("p",), iter(rows), None)) == []
    assert kept["waiting"].sent == 1 and kept["timer"].get() == (1,)
    made = list(panel.handleExpiredTimer(("p",), SimpleNamespace(getCurrentWatermarkInMs=lambda: 5), None))
    assert [(m.window_start, m.avg_temperature, m.change) for m in made] == [(1000, float("inf"), None), (2000, None, "broken")]
    assert (made[1].reason, made[1].broken_since) == ("Low\nefficiency", 2060)
    (left,) = kept["waiting"].rows
    assert json.loads(left[0])["start"] == 9000 and kept["timer"].get() == (9,)
