import random
from datetime import datetime

import pytest
from helpers import at, rows, stats_frame
from pyspark.sql import functions as F

from heliograph import schemas
from heliograph.operators import fleet, health
from heliograph.sources import tables

RULE_CASES = [
    (4.0, 20.0, 500.0, 1, "Low efficiency: 4.00%"),
    (7.0, 20.0, 500.0, 2, "Low efficiency (7.00%) despite adequate irradiance (500 W/m²)"),
    (7.0, 20.0, 50.0, 0, None),
    (50.0, 90.0, 500.0, 3, "Temperature anomaly: 90.0°C"),
    (None, 30.0, 5.0, 4, "No irradiance detected despite warm temperature (30.0°C)"),
    (None, 20.0, 5.0, 0, None),
    (4.125, 90.0, 5.0, 1, "Low efficiency: 4.12%"),
    (5.0, 20.0, 100.0, 0, None),
    (5.0, 20.0, 100.5, 2, "Low efficiency (5.00%) despite adequate irradiance (100 W/m²)"),
    (10.0, 85.0, 500.0, 0, None),
    (50.0, 25.0, 9.0, 0, None),
    (50.0, 85.25, 500.0, 3, "Temperature anomaly: 85.2°C"),
    (None, None, None, 0, None),
    (-1.005, None, None, 1, "Low efficiency: -1.00%"),
]


def test_rules(spark):
    stats = stats_frame(spark, [(f"p{n:02}", 0, e, t, i) for n, (e, t, i, _, _) in enumerate(RULE_CASES)])
    found = rows(health.classify(stats), "panel_id", "reason_code", "is_broken", "reason")
    assert found == [(f"p{n:02}", code, code > 0, text) for n, (*_, code, text) in enumerate(RULE_CASES)]


def test_rows_without_a_panel_are_left_out(spark):
    stats = stats_frame(spark, [(None, 0, 1.0, 1.0, 1.0), ("", 0, 1.0, 1.0, 1.0), ("p", 0, 50.0, 1.0, 200.0)])
    assert rows(health.classify(stats), "panel_id") == [("p",)]


STICKY = [
    ("p", 0, 4.0, 20.0, 500.0),
    ("p", 1, 50.0, 90.0, 500.0),
    ("p", 2, 50.0, 20.0, 500.0),
    ("p", 3, 50.0, 95.0, 500.0),
]


def test_reason_and_time_hold_until_recovery(spark):
    columns = ["window_start", "is_broken", "reason", "broken_since", "change"]
    found = rows(health.timeline(stats_frame(spark, STICKY)), *columns)
    assert found == [
        (at(0), True, "Low efficiency: 4.00%", at(60), "broken"),
        (at(60), True, "Low efficiency: 4.00%", at(60), None),
        (at(120), False, None, None, "recovered"),
        (at(180), True, "Temperature anomaly: 95.0°C", at(240), "broken"),
    ]
    assert health.transitions(stats_frame(spark, STICKY)).count() == 3


def test_latest_values_are_taken_with_their_nulls(spark):
    stats = stats_frame(spark, [("p", 1, None, None, 500.0), ("p", 0, 50.0, 20.0, 400.0)])
    found = health.latest_status(stats)
    assert found.columns == schemas.STATUS_COLUMNS
    assert rows(found) == [("p", False, None, None, 500.0, at(120), None, None)]


def test_a_clock_can_stamp_the_status(spark):
    clock = F.lit("2030-01-01 00:00:00").cast("timestamp")
    found = health.latest_status(stats_frame(spark, STICKY), clock).first()
    assert found.last_updated == found.broken_since == datetime(2030, 1, 1)


def test_timeline_shuffles_once(spark):
    plan = health.latest_status(stats_frame(spark, STICKY))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def _random_windows(seed, panels=12, minutes=40):
    rng = random.Random(seed)
    pick = lambda: rng.choice([3.0, 7.0, 50.0, None])
    return [
        (f"p{p}", m, pick(), rng.choice([20.0, 30.0, 90.0, None]), rng.choice([5.0, 50.0, 500.0, None]))
        for p in range(panels)
        for m in range(minutes)
        if rng.random() < 0.6
    ]


def _walk(windows):
    """Status by hand: one message after the other."""
    known = {}
    for panel, minute, eff, temp, irr in sorted(windows, key=lambda w: (w[0], w[1])):
        if eff is not None and eff < 5:
            reason = f"Low efficiency: {eff:.2f}%"
        elif irr is not None and irr > 100 and eff is not None and eff < 10:
            reason = f"Low efficiency ({eff:.2f}%) despite adequate irradiance ({irr:.0f} W/m²)"
        elif temp is not None and temp > 85:
            reason = f"Temperature anomaly: {temp:.1f}°C"
        elif irr is not None and irr < 10 and temp is not None and temp > 25:
            reason = f"No irradiance detected despite warm temperature ({temp:.1f}°C)"
        else:
            reason = None
        end = at(60 * minute + 60)
        before = known.get(panel)
        if reason is None:
            held = (None, None)
        elif before and before[1]:
            held = before[6:]
        else:
            held = (end, reason)
        known[panel] = (panel, reason is not None, eff, temp, irr, end, *held)
    return sorted(known.values(), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_latest_status_against_a_walk(spark, seed):
    windows = _random_windows(seed)
    assert rows(health.latest_status(stats_frame(spark, windows))) == _walk(windows)


@pytest.mark.parametrize("cut", [0, 1, 13, 40])
def test_advancing_equals_starting_over(spark, cut):
    windows = _random_windows(3)
    early = stats_frame(spark, [w for w in windows if w[1] < cut])
    late = stats_frame(spark, [w for w in windows if w[1] >= cut])
    assert rows(health.advance_status(health.latest_status(early), late)) == _walk(windows)


def test_upsert_replaces_and_inserts(spark):
    current = health.latest_status(stats_frame(spark, [("a", 0, 4.0, 20.0, 500.0), ("b", 0, 50.0, 20.0, 500.0)]))
    updates = health.latest_status(stats_frame(spark, [("a", 1, 50.0, None, 500.0), ("c", 1, 50.0, 20.0, 500.0)]))
    assert rows(health.upsert_status(current, updates), "panel_id", "is_broken", "avg_temperature", "reason") == [
        ("a", False, None, None),
        ("b", False, 20.0, None),
        ("c", False, 20.0, None),
    ]


@pytest.fixture(scope="module")
def status(spark):
    windows = [("p1", 0, 4.0, 20.0, 604.5), ("p2", 0, 50.125, None, 500.0), ("p3", 0, None, 20.25, 500.0)]
    return health.latest_status(stats_frame(spark, windows))


def test_fleet_questions(status):
    assert rows(fleet.list_panels(status, skip=1, limit=1), "panel_id") == [("p2",)]
    assert rows(fleet.get_panel(status, "p3"), "panel_id") == [("p3",)]
    assert rows(fleet.get_panel(status, "nobody")) == []
    assert rows(fleet.broken_panels(status), "panel_id") == [("p1",)]
    assert rows(fleet.fleet_statistics(status)) == [(3, 1, 2, 27.0625, 20.125)]


def test_fleet_of_nobody(spark):
    assert rows(fleet.fleet_statistics(tables.empty_status(spark))) == [(0, 0, 0, None, None)]


def test_reports(status):
    assert rows(fleet.panel_report(status)) == [
        ("p1", "Broken", "4.00", "20.0", "605", "Low efficiency: 4.00%"),
        ("p2", "Working", "50.13", "N/A", "500", None),
        ("p3", "Working", "N/A", "20.3", "500", None),
    ]
    nameless = status.withColumn("reason", F.lit(None).cast("string"))
    assert rows(fleet.broken_report(nameless)) == [("p1", at(60), "Unknown issue", "4.00", "20.0")]
    assert rows(fleet.fleet_report(status)) == [(3, 1, 2, "27.06", "20.1")]


def test_zero_is_shown(spark):
    zero = health.latest_status(stats_frame(spark, [("p", 0, 0.0, 0.0, 0.0)]))
    assert rows(fleet.panel_report(zero), "efficiency", "temperature", "irradiance") == [("0.00", "0.0", "0")]


def test_status_versions(spark, status, tmp_path):
    base = str(tmp_path / "status")
    assert tables.latest_version(spark, base) is None
    assert rows(tables.read_status(spark, base)) == []
    tables.write_version(tables.empty_status(spark), base, 0)
    assert rows(tables.read_version(spark, base, 0)) == []
    tables.write_version(status, base, 1)
    tables.write_version(status.where("is_broken"), base, 2)
    assert tables.latest_version(spark, base) == 2
    assert rows(tables.read_status(spark, base), "panel_id") == [("p1",)]
    assert tables.read_version(spark, base, 1).count() == 3


def test_nan_fires_no_rule(spark):
    nan = float("nan")
    windows = [("p0", 0, nan, 90.0, 5.0), ("p1", 0, 50.0, nan, 5.0), ("p2", 0, 7.0, 20.0, nan), ("p3", 0, nan, nan, nan)]
    found = health.classify(stats_frame(spark, windows)).select("panel_id", "reason_code")
    assert rows(found) == [("p0", 3), ("p1", 0), ("p2", 0), ("p3", 0)]


def test_advance_rejects_older_and_resent_windows(spark):
    first = [("p0", 5, 50.0, 20.0, 500.0), ("p1", 5, 3.0, 20.0, 500.0)]
    again = [("p0", 2, 3.0, 20.0, 500.0), ("p0", 5, 50.0, 20.0, 500.0), ("p1", 6, 50.0, 20.0, 500.0)]
    current = health.latest_status_by_window(stats_frame(spark, first))
    found = health.advance_status(current, stats_frame(spark, again)).drop(health.LAST_WINDOW)
    assert rows(found) == rows(health.latest_status(stats_frame(spark, [*first, again[2]])))


@pytest.mark.parametrize("piece", ["2 minutes", "7 minutes", "1 day"])
def test_pieces_give_the_timeline(spark, piece):
    chance = random.Random(piece)
    data = []
    for panel in range(12):
        level = chance.random()
        for minute in range(60):
            if chance.random() < 0.8:
                level = chance.random() if chance.random() < 0.3 else level
                efficiency = None if chance.random() < 0.05 else 3.0 if level < 0.5 else 50.0 + minute
                data.append((f"p{panel}", minute, efficiency, 20.0 + minute, 500.0))
    windows = stats_frame(spark, data)
    expected = health.timeline(windows)
    found = health.timeline_in_pieces(windows, piece)
    assert found.columns == expected.columns and rows(found) == rows(expected)


def test_pieces_of_nothing_and_of_nameless_panels(spark):
    assert rows(health.timeline_in_pieces(stats_frame(spark, []))) == []
    windows = stats_frame(spark, [(None, 0, 3.0, 20.0, 500.0), ("", 1, 3.0, 20.0, 500.0), ("p0", 2, 3.0, 20.0, 500.0)])
    assert [r[0] for r in rows(health.timeline_in_pieces(windows))] == ["p0"]
