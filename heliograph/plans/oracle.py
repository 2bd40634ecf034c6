"""DuckDB SQL with the same results as the registered queries.

Each text starts from the `events` view and uses only what it needs of the common table expressions below. The SQL is
written for checking: it joins plainly and uses whole-partition windows where the queries avoid both.
"""

from __future__ import annotations

from heliograph.operators import training, trees

WIDE = """
wide AS (
  SELECT 'panel-' || user_id AS panel_id, ts AS "timestamp", least(value * 10, 1200.0::DOUBLE) AS irradiance_w_m2,
         (CASE WHEN event_id % 20 = 0 THEN 0.0::DOUBLE ELSE value END)
           * (CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) + 0.371::DOUBLE) / 100 AS power_ac_w,
         CASE WHEN event_id % 20 = 0 THEN 0.0::DOUBLE ELSE value END AS power_dc_w,
         CAST(15 + event_id % 80 AS DOUBLE) AS temperature_c,
         CAST(20 + 10 * (user_id % 3) AS DOUBLE) AS tilt_deg,
         CAST(180 + 15 * (user_id % 4) AS DOUBLE) AS azimuth_deg,
         event_id, event_type, value, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
  FROM events)"""

def _r(value: str) -> str:
    """Six decimals; the nudge is the one of the query catalog."""
    return f"round({value} + 3.17e-8, 6)"


_GAPS = {
    "irr": ("irradiance_w_m2", "value <= 200"),
    "ac": ("power_ac_w", "k >= 3"),
    "dc": ("power_dc_w", "value >= 1"),
    "temp": ("temperature_c", "NOT (event_type = 'error' AND k > 90)"),
    "orient": ("tilt_deg, azimuth_deg", "NOT (event_type = 'signup' AND value > 150)"),
}

FRAMES = ",\n".join(
    f'{name} AS (SELECT panel_id, "timestamp", {measures} FROM wide WHERE {reports})'
    for name, (measures, reports) in _GAPS.items()
)

RESENT_FRAMES = ",\n".join(
    f'{name} AS (SELECT panel_id, "timestamp", {measures} FROM wide WHERE {reports} UNION ALL '
    f"SELECT panel_id, \"timestamp\", {measures} FROM wide WHERE {reports} AND event_type = 'error')"
    for name, (measures, reports) in _GAPS.items()
)

_JOINED = """
joined AS (
  SELECT * FROM irr JOIN ac USING (panel_id, "timestamp") JOIN dc USING (panel_id, "timestamp")
    JOIN temp USING (panel_id, "timestamp") JOIN orient USING (panel_id, "timestamp")),
enriched AS (
  SELECT *, CASE WHEN power_dc_w > 0 THEN power_ac_w / power_dc_w * 100 END AS efficiency,
         CASE WHEN power_dc_w > 0 THEN temperature_c / power_dc_w END AS temp_per_power
  FROM joined)"""

ENRICHED = f"{WIDE},\n{FRAMES},{_JOINED}"
RESENT = f"{WIDE},\n{RESENT_FRAMES},{_JOINED}"

# The join without gaps, as the messages of whole readings give it.
WHOLE = f"""{WIDE},
enriched AS (
  SELECT *, CASE WHEN power_dc_w > 0 THEN power_ac_w / power_dc_w * 100 END AS efficiency FROM wide)"""


def _stats(base: str, width: str) -> str:
    return f"""{base},
stats AS (
  SELECT panel_id, time_bucket(INTERVAL '{width}', "timestamp") AS window_start,
         time_bucket(INTERVAL '{width}', "timestamp") + INTERVAL '{width}' AS window_end,
         avg(efficiency) AS avg_efficiency, avg(temperature_c) AS avg_temp, avg(irradiance_w_m2) AS avg_irradiance
  FROM enriched GROUP BY ALL)"""


MINUTE_STATS = _stats(ENRICHED, "1 minute")
DAY_STATS = _stats(ENRICHED, "1 day")

# A window is closed when its end is 10 seconds behind the latest time of the slowest measurement frame.
CLOSED_STATS = f"""{MINUTE_STATS.replace("stats AS (", "all_stats AS (")},
mark AS (
  SELECT least((SELECT max("timestamp") FROM irr), (SELECT max("timestamp") FROM ac),
               (SELECT max("timestamp") FROM dc), (SELECT max("timestamp") FROM temp),
               (SELECT max("timestamp") FROM orient)) - INTERVAL '10 seconds' AS t),
stats AS (SELECT * FROM all_stats WHERE window_end <= (SELECT t FROM mark))"""

CLOSED_RESENT = CLOSED_STATS.replace(FRAMES, RESENT_FRAMES)

_STATS_COLUMNS = f"""panel_id, window_start, window_end, {_r("avg_efficiency")} AS avg_efficiency,
  {_r("avg_temp")} AS avg_temp, {_r("avg_irradiance")} AS avg_irradiance"""

# Windows that reach the status jobs in drops: one held back is accepted only if its panel has seen no later one.
DROPPED_STATS = f"""{CLOSED_STATS.replace("stats AS (SELECT * FROM all_stats", "closed AS (SELECT * FROM all_stats")},
tagged AS (
  SELECT *, window_start < TIMESTAMP '2024-01-10 00:00:00' AS early,
         window_start < TIMESTAMP '2024-01-10 00:00:00' AND epoch_us(window_start) // 60000000 % 7 = 0 AS held
  FROM closed),
firsts AS (SELECT panel_id, max(window_start) AS seen FROM tagged WHERE early AND NOT held GROUP BY panel_id),
stats AS (
  SELECT tagged.* FROM tagged LEFT JOIN firsts USING (panel_id)
  WHERE NOT held OR seen IS NULL OR window_start > seen)"""

# Windows of a job over message topics without gaps, and of one that reads what the first has written: the readings
# that the watermark has passed, with times in milliseconds.
JOB_STATS = f"""{_stats(WHOLE, "1 minute").replace("stats AS (", "all_stats AS (")},
stats AS (
  SELECT * FROM all_stats WHERE window_end <= (SELECT max("timestamp") FROM wide) - INTERVAL '10 seconds')"""
REJOINED_STATS = f"""{_stats(WHOLE.replace("enriched AS (", "whole AS (") + """,
enriched AS (
  SELECT * REPLACE (date_trunc('milliseconds', "timestamp") AS "timestamp") FROM whole
  WHERE "timestamp" <= (SELECT max("timestamp") FROM wide) - INTERVAL '10 seconds')""", "1 minute").replace("stats AS (", "all_stats AS (")},
stats AS (
  SELECT * FROM all_stats WHERE window_end <= (SELECT max("timestamp") FROM enriched) - INTERVAL '10 seconds')"""


def _health(stats: str) -> str:
    return f"""{stats},
coded AS (
  SELECT *, CASE WHEN avg_efficiency < 5 THEN 1 WHEN avg_irradiance > 100 AND avg_efficiency < 10 THEN 2
                 WHEN avg_temp > 85 THEN 3 WHEN avg_irradiance < 10 AND avg_temp > 25 THEN 4 ELSE 0 END AS reason_code
  FROM stats),
health AS (
  SELECT * REPLACE ({_r("avg_efficiency")} AS avg_efficiency, {_r("avg_temp")} AS avg_temp,
                    {_r("avg_irradiance")} AS avg_irradiance), reason_code > 0 AS is_broken,
         CASE reason_code
           WHEN 1 THEN printf('Low efficiency: %.2f%%', coded.avg_efficiency)
           WHEN 2 THEN printf('Low efficiency (%.2f%%) despite adequate irradiance (%.0f W/m²)',
                              coded.avg_efficiency, coded.avg_irradiance)
           WHEN 3 THEN printf('Temperature anomaly: %.1f°C', coded.avg_temp)
           WHEN 4 THEN printf('No irradiance detected despite warm temperature (%.1f°C)', coded.avg_temp) END AS reason
  FROM coded)"""


def _timeline(stats: str) -> str:
    return f"""{_health(stats)},
turned AS (
  SELECT *, lag(is_broken) OVER by_time AS was_broken,
         is_broken AND NOT coalesce(lag(is_broken) OVER by_time, FALSE) AS breaks
  FROM health WINDOW by_time AS (PARTITION BY panel_id ORDER BY window_start)),
runs AS (
  SELECT *, sum(breaks::INTEGER) OVER (PARTITION BY panel_id ORDER BY window_start) AS run FROM turned),
timeline AS (
  SELECT panel_id, window_start, window_end, avg_efficiency, avg_temp AS avg_temperature, avg_irradiance, is_broken,
         reason_code,
         CASE WHEN is_broken THEN first_value(window_end) OVER broken END AS broken_since,
         CASE WHEN is_broken THEN first_value(reason) OVER broken END AS reason,
         CASE WHEN breaks THEN 'broken' WHEN NOT is_broken AND was_broken THEN 'recovered' END AS change
  FROM runs WINDOW broken AS (PARTITION BY panel_id, run, is_broken ORDER BY window_start)),
status AS (
  SELECT panel_id, is_broken, avg_efficiency, avg_temperature, avg_irradiance, window_end AS last_updated,
         broken_since, reason
  FROM (SELECT *, row_number() OVER (PARTITION BY panel_id ORDER BY window_start DESC) AS place FROM timeline)
  WHERE place = 1)"""


_STATUS_COLUMNS = """panel_id, is_broken, avg_efficiency, avg_temperature, avg_irradiance, last_updated, broken_since,
  reason"""

_TIMELINE_COLUMNS = """panel_id, window_start, window_end, avg_efficiency, avg_temperature, avg_irradiance, is_broken,
  reason_code, broken_since, reason, change"""

CUT = "TIMESTAMP '2024-01-20 00:00:00'"
_EARLIER = _timeline(
    MINUTE_STATS.replace("stats AS (", "all_stats AS (")
    + f",\nstats AS (SELECT * FROM all_stats WHERE window_start < {CUT})"
)
_LATER = _timeline(
    MINUTE_STATS.replace("stats AS (", "all_stats AS (")
    + f",\nstats AS (SELECT * FROM all_stats WHERE window_start >= {CUT})"
)

ISO = """strftime("timestamp", '%Y-%m-%dT%H:%M:%S')
  || CASE WHEN epoch_us("timestamp") % 1000000 = 0 THEN '' ELSE strftime("timestamp", '.%f') END"""


def _peers(bucket: str, mean: str = "avg(power_dc_w) OVER (PARTITION BY peer_time)") -> str:
    return f"""{WIDE},
peers AS (
  SELECT panel_id, "timestamp", irradiance_w_m2, power_dc_w, peer_time, {mean} AS avg_power
  FROM (SELECT *, {bucket} AS peer_time FROM wide)),
deviations AS (SELECT *, abs(power_dc_w - avg_power) AS deviation FROM peers),
found AS (SELECT * FROM deviations WHERE deviation > 50)"""


_HOUR_OF_DAY = 'CAST(extract(hour FROM "timestamp") AS INTEGER)'
_HOUR = "time_bucket(INTERVAL '1 hour', \"timestamp\")"
_FAULT_COLUMNS = """panel_id, "timestamp", irradiance_w_m2, power_dc_w, peer_time,
  round(avg_power + 3.17e-8, 6) AS avg_power,
  round(deviation + 3.17e-8, 6) AS deviation"""


def _to_fixed(name: str, places: int) -> str:
    # printf sends true ties to even; a tie is an odd multiple of 1/8, 1/4 or 1/2, and belongs up here.
    parts, nudge = {2: (8, 0.001), 1: (4, 0.01), 0: (2, 0.1)}[places]
    tied = f"({name} * {parts} = floor({name} * {parts}) AND CAST({name} * {parts} AS BIGINT) % 2 <> 0)"
    moved = f"CASE WHEN {tied} THEN {name} + sign({name}) * {nudge} ELSE {name} END"
    return f"coalesce(printf('%.{places}f', {moved}), 'N/A')"


_FLEET = """count(*) AS total_panels, count(*) FILTER (WHERE is_broken) AS broken_panels,
  count(*) FILTER (WHERE NOT is_broken) AS working_panels"""

_RAW = f"""{WIDE},
raw AS (
  SELECT *, CASE WHEN event_type = 'error' THEN 'junk' WHEN event_type = 'click' AND k < 50 THEN 'quoted'
                 WHEN event_type = 'view' AND k < 50 THEN 'untimed' ELSE 'good' END AS shape
  FROM wide)"""

_TIME6 = "strftime(\"timestamp\", '%Y-%m-%dT%H:%M:%S.%f+00:00')"

_TRAINING = f"""{WIDE},
shaped AS (
  SELECT *, CASE WHEN event_type = 'signup' AND k < 50 THEN 'null' WHEN event_type = 'signup' AND k < 60 THEN 'text'
                 WHEN event_type = 'signup' THEN 'quoted'
                 WHEN event_type <> 'error' THEN event_type WHEN k < 30 THEN 'text' WHEN k < 60 THEN 'broken'
                 ELSE 'nameless' END AS shape
  FROM (SELECT * REPLACE (CASE WHEN event_type = 'signup' AND k BETWEEN 60 AND 69 THEN 10.0::DOUBLE ELSE power_dc_w END
                          AS power_dc_w) FROM wide)),
records AS (
  SELECT CASE WHEN shape = 'nameless' THEN 'p1' ELSE panel_id END AS panel_id,
         CASE WHEN shape = 'nameless' THEN TIMESTAMP '2024-02-01 12:00:00' ELSE "timestamp" END AS "timestamp",
         CASE WHEN shape IN ('view', 'click', 'purchase') THEN irradiance_w_m2 ELSE 0.0::DOUBLE END AS irradiance_w_m2,
         CASE WHEN shape = 'view' THEN power_ac_w
              WHEN shape IN ('click', 'quoted', 'nameless') AND power_dc_w <> 0 THEN power_dc_w * 0.9::DOUBLE
              ELSE 0.0::DOUBLE END AS power_ac_w,
         CASE WHEN shape = 'purchase' THEN 0.0::DOUBLE ELSE power_dc_w END AS power_dc_w,
         CASE WHEN shape IN ('view', 'click') THEN temperature_c ELSE 25.0::DOUBLE END AS temperature_c,
         CASE WHEN shape IN ('view', 'click') THEN tilt_deg ELSE 30.0::DOUBLE END AS tilt_deg,
         CASE WHEN shape IN ('view', 'click') THEN azimuth_deg ELSE 180.0::DOUBLE END AS azimuth_deg
  FROM shaped WHERE shape NOT IN ('null', 'text', 'broken'))"""

_REQUESTS = f"""{WIDE},
requests AS (
  SELECT event_id, CASE WHEN event_type = 'signup' AND k < 20 THEN 'panel-1' ELSE panel_id END AS panel_id,
         value * 10 - 20 AS irradiance_w_m2,
         CASE WHEN event_type = 'error' AND k < 10 THEN NULL ELSE temperature_c END AS temperature_c,
         CASE WHEN event_type = 'view' AND k < 5 THEN TIMESTAMP '2024-02-01 12:00:00' ELSE "timestamp" END
           AS "timestamp",
         k < 95 AND k % 2 = 0 AS send_to_kafka, 2.5::DOUBLE * (k % 25) AS ideal_tilt
  FROM wide),
valid AS (SELECT * FROM requests WHERE irradiance_w_m2 > 0 AND temperature_c IS NOT NULL)"""



def _modelled(source: str, start: str) -> str:
    """Candidates of a source's rows with the predictions of the starting model, as its trees say, and the best."""
    return f"""{start},
candidates AS (
  SELECT r.*, CAST(t.tilt AS DOUBLE) AS tilt_deg, 180.0::DOUBLE AS azimuth_deg,
         {_HOUR_OF_DAY} AS hour
  FROM ({source}) r
  CROSS JOIN generate_series(0, 60, 5) AS t(tilt)),
scored AS (SELECT *, {trees.sql(training.starting_model(), training.FEATURES)} AS prediction FROM candidates),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY prediction DESC, tilt_deg) = 1)"""


_SCORED = f"""{_REQUESTS},
scored AS (
  SELECT valid.*, CAST(t.tilt AS DOUBLE) AS tilt_deg, {_HOUR_OF_DAY} AS hour,
         irradiance_w_m2 * cos(radians(t.tilt - ideal_tilt)) AS prediction
  FROM valid CROSS JOIN generate_series(0, 60, 5) AS t(tilt)),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY prediction DESC, tilt_deg) AS place
                 FROM scored) WHERE place = 1)"""

_FANOUT = {
    "kafka_solar_irradiance": "irradiance_w_m2",
    "kafka_solar_power_ac": "power_ac_w",
    "kafka_solar_power_dc": "power_dc_w",
    "kafka_solar_temperature": "temperature_c",
    "kafka_solar_orientation": "tilt_deg, azimuth_deg",
}
_MEASURES = ["irradiance_w_m2", "power_ac_w", "power_dc_w", "temperature_c", "tilt_deg", "azimuth_deg"]


def _fanout() -> str:
    parts = []
    for topic, own in _FANOUT.items():
        columns = [m if m in own.split(", ") else f"NULL::DOUBLE AS {m}" for m in _MEASURES]
        parts.append(
            f"SELECT '{topic}' AS topic, panel_id AS key, CAST(event_id AS VARCHAR) AS measurement_id, panel_id, "
            f'{_TIME6} AS "timestamp", {", ".join(columns)} FROM wide'
        )
    return "\nUNION ALL\n".join(parts)


def _message_ids() -> str:
    """Ids by name: SHA-1 of the name space of URLs and of topic, panel and time, with version and variant put in."""
    parts = [
        f"""SELECT '{topic}' AS topic, panel_id AS key, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8')
  || encode('{topic}' || chr(10) || panel_id || chr(10) || epoch_us("timestamp"))) AS h FROM wide"""
        for topic in [*_FANOUT, "kafka_solar_control"]
    ]
    return "\nUNION ALL\n".join(parts)


def _with(tables: str, body: str) -> str:
    return f"WITH {tables.strip()}\n{body}"


SQL: dict[str, str] = {
    "enriched_features": _with(ENRICHED, "SELECT * FROM enriched"),
    "enriched_by_grouping": _with(ENRICHED, "SELECT * FROM enriched"),
    "enriched_messages": _with(
        ENRICHED,
        """SELECT panel_id AS key, CASE WHEN efficiency IS NULL THEN 8 ELSE 10 END AS n_fields,
  date_trunc('milliseconds', "timestamp") AS "timestamp", power_ac_w, efficiency, temp_per_power FROM enriched""",
    ),
    "enriched_resent": _with(RESENT, "SELECT * FROM enriched"),
    "enriched_hot_readings": _with(
        ENRICHED.replace("joined AS (", """hot AS (
  SELECT * FROM temp UNION ALL
  SELECT t.* FROM (SELECT panel_id, "timestamp", temperature_c FROM wide
                   WHERE event_id % 500 = 1 AND NOT (event_type = 'error' AND k > 90)) t CROSS JOIN range(1500)),
joined AS (""").replace("JOIN temp USING", "JOIN hot USING"),
        "SELECT * FROM enriched",
    ),
    "window_stats_1m": _with(MINUTE_STATS, f"SELECT {_STATS_COLUMNS} FROM stats"),
    "window_stats_1d": _with(DAY_STATS, f"SELECT {_STATS_COLUMNS} FROM stats"),
    "window_stats_resent": _with(_stats(RESENT, "1 day"), f"SELECT {_STATS_COLUMNS} FROM stats"),
    "window_stats_messages": _with(DAY_STATS, f"SELECT {_STATS_COLUMNS} FROM stats"),
    "window_stats_from_messages": _with(_stats(WHOLE, "1 minute"), f"SELECT {_STATS_COLUMNS} FROM stats"),
    "expected_power": _with(
        WIDE,
        """SELECT panel_id, "timestamp", irradiance_w_m2, tilt_deg, power_dc_w, expected_power_w,
  round(expected_power_w - power_dc_w + 3.17e-8, 6) AS shortfall_w
FROM (SELECT *, CAST(printf('%.2f', greatest(0.0::DOUBLE, irradiance_w_m2 * (1.6::DOUBLE * 0.18::DOUBLE
        * greatest(0.5::DOUBLE, cos(radians(tilt_deg)))))) AS DOUBLE) AS expected_power_w FROM wide)""",
    ),
    "angle_helpers": _with(
        WIDE,
        """SELECT panel_id, "timestamp",
  round(least(90.0, greatest(0.0, tilt_deg * temperature_c / 20 - 30)) + 3.17e-8, 6) AS clamped_tilt,
  round(azimuth_deg * temperature_c - 9000 - 360 * floor((azimuth_deg * temperature_c - 9000) / 360) + 3.17e-8, 6)
    AS wrapped_azimuth,
  round(phase + 3.17e-8, 6) AS day_phase
FROM (SELECT *, epoch_us("timestamp") % 86400000000 / 86400000000.0::DOUBLE AS phase FROM wide)""",
    ),
    "peer_faults_exact": _with(
        _peers('"timestamp"').replace("FROM wide)),", """FROM (
    SELECT * REPLACE (panel_id || '/' || n AS panel_id, power_dc_w + 60 * n AS power_dc_w)
    FROM wide CROSS JOIN range(3) AS copies(n)))),"""),
        f"SELECT {_FAULT_COLUMNS} FROM found",
    ),
    "peer_faults_hourly": _with(_peers(_HOUR), f"SELECT {_FAULT_COLUMNS} FROM found"),
    "peer_faults_leave_one_out": _with(
        _peers(
            _HOUR,
            "(sum(power_dc_w) OVER (PARTITION BY peer_time) - power_dc_w)"
            " / nullif(count(power_dc_w) OVER (PARTITION BY peer_time) - 1, 0)",
        ),
        f"SELECT {_FAULT_COLUMNS} FROM found",
    ),
    "peer_deviation_daily": _with(
        _peers("time_bucket(INTERVAL '1 day', \"timestamp\")"),
        """SELECT panel_id, "timestamp", power_dc_w, peer_time, round(avg_power + 3.17e-8, 6) AS avg_power,
  round(deviation + 3.17e-8, 6) AS deviation FROM deviations""",
    ),
    "fault_count": _with(_peers(_HOUR), "SELECT count(*) AS fault_count FROM found"),
    "fault_preview": _with(
        _peers(_HOUR),
        """SELECT panel_id, power_dc_w, round(avg_power + 3.17e-8, 6) AS avg_power,
  round(deviation + 3.17e-8, 6) AS deviation FROM found""",
    ),
    "fault_alerts": _with(
        _peers(_HOUR),
        f"""SELECT panel_id AS key, 'FAULT_DETECTED' AS event_type, panel_id, {ISO} AS "timestamp",
  'Inspect Panel Immediately' AS action_required, power_dc_w AS current_power,
  round(avg_power + 3.17e-8, 6) AS average_others, round(deviation + 3.17e-8, 6) AS deviation,
  50.0::DOUBLE AS threshold FROM found""",
    ),
    "panel_health": _with(
        _health(DAY_STATS), "SELECT panel_id, window_start, window_end, reason_code, is_broken FROM health"
    ),
    "panel_health_1m": _with(
        _health(MINUTE_STATS), "SELECT panel_id, window_start, window_end, reason_code, is_broken, reason FROM health"
    ),
    "panel_timeline": _with(_timeline(MINUTE_STATS), f"SELECT {_TIMELINE_COLUMNS} FROM timeline"),
    "one_panel_timeline": _with(
        _timeline(_stats(ENRICHED, "1 second").replace("SELECT panel_id, time_b", "SELECT 'fleet' AS panel_id, time_b")),
        f"SELECT {_TIMELINE_COLUMNS} FROM timeline",
    ),
    "status_transitions": _with(
        _timeline(MINUTE_STATS),
        """SELECT panel_id, window_start, change, reason_code, reason, broken_since FROM timeline
WHERE change IS NOT NULL""",
    ),
    "panel_status_latest": _with(_timeline(MINUTE_STATS), f"SELECT {_STATUS_COLUMNS} FROM status"),
    "panel_status_daily": _with(_timeline(DAY_STATS), f"SELECT {_STATUS_COLUMNS} FROM status"),
    "status_upsert": f"""WITH earlier AS ({_with(_EARLIER, "SELECT * FROM status")}),
later AS ({_with(_LATER, "SELECT * FROM status")}),
merged AS (SELECT * FROM later UNION ALL SELECT * FROM earlier WHERE panel_id NOT IN (SELECT panel_id FROM later))
SELECT {_STATUS_COLUMNS} FROM merged""",
    "status_advance": _with(_timeline(MINUTE_STATS), f"SELECT {_STATUS_COLUMNS} FROM status"),
    "status_table": _with(_timeline(MINUTE_STATS), f"SELECT {_STATUS_COLUMNS} FROM status"),
    "panel_page": _with(
        _timeline(DAY_STATS), f"SELECT {_STATUS_COLUMNS} FROM status ORDER BY panel_id LIMIT 20 OFFSET 5"
    ),
    "timeline_page": _with(
        _timeline(MINUTE_STATS),
        f"SELECT {_TIMELINE_COLUMNS} FROM timeline ORDER BY panel_id, window_start LIMIT 120 OFFSET 750",
    ),
    "panel_page_after": _with(
        _timeline(DAY_STATS),
        f"SELECT {_STATUS_COLUMNS} FROM status WHERE panel_id > 'panel-3' ORDER BY panel_id LIMIT 20",
    ),
    "nan_guards": """SELECT event_id, CASE
    WHEN event_id % 3 = 2 OR value <= 50 THEN -1
    WHEN event_id % 3 <> 0 AND value / 10 < 5 THEN 1
    WHEN event_id % 3 <> 0 AND value * 3 > 100 AND value / 10 < 10 THEN 2
    WHEN event_id % 3 <> 1 AND value > 85 THEN 3
    WHEN value * 3 < 10 AND event_id % 3 <> 1 AND value > 25 THEN 4 ELSE 0 END AS reason_code
FROM events""",
    "panel_lookup": _with(_timeline(DAY_STATS), f"SELECT {_STATUS_COLUMNS} FROM status WHERE panel_id = 'panel-7'"),
    "broken_panels": _with(_timeline(DAY_STATS), f"SELECT {_STATUS_COLUMNS} FROM status WHERE is_broken"),
    "fleet_statistics": _with(
        _timeline(DAY_STATS),
        f"""SELECT {_FLEET}, round(avg(avg_efficiency) + 3.17e-8, 6) AS average_efficiency,
  round(avg(avg_temperature) + 3.17e-8, 6) AS average_temperature FROM status""",
    ),
    "panel_report": _with(
        _timeline(DAY_STATS),
        f"""SELECT panel_id, CASE WHEN is_broken THEN 'Broken' ELSE 'Working' END AS status,
  {_to_fixed("avg_efficiency", 2)} AS efficiency, {_to_fixed("avg_temperature", 1)} AS temperature,
  {_to_fixed("avg_irradiance", 0)} AS irradiance, reason FROM status""",
    ),
    "broken_report": _with(
        _timeline(DAY_STATS),
        f"""SELECT panel_id, broken_since, coalesce(reason, 'Unknown issue') AS reason,
  {_to_fixed("avg_efficiency", 2)} AS efficiency, {_to_fixed("avg_temperature", 1)} AS temperature
FROM status WHERE is_broken""",
    ),
    "fleet_report": _with(
        _timeline(DAY_STATS),
        f"""SELECT total_panels, broken_panels, working_panels, {_to_fixed("e", 2)} AS efficiency,
  {_to_fixed("t", 1)} AS temperature
FROM (SELECT {_FLEET}, avg(avg_efficiency) AS e, avg(avg_temperature) AS t FROM status)""",
    ),
    "measurement_fanout": _with(WIDE, _fanout()),
    "message_ids": _with(
        f"{WIDE},\nhashed AS ({_message_ids()})",
        """SELECT topic, key, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-'
  || translate(h[17:17], '0123456789abcdef', '89ab89ab89ab89ab') || h[18:20] || '-' || h[21:32] AS id FROM hashed""",
    ),
    "json_parse": _with(
        _RAW,
        """SELECT panel_id, CASE WHEN shape <> 'untimed' THEN "timestamp" END AS "timestamp",
  CASE WHEN shape <> 'quoted' THEN temperature_c END AS temperature_c FROM raw WHERE shape <> 'junk'""",
    ),
    "json_complete": _with(_RAW, """SELECT panel_id, "timestamp", temperature_c FROM raw WHERE shape = 'good'"""),
    "json_rejects": _with(
        _RAW,
        """SELECT CAST(event_id AS VARCHAR) AS key, CAST(CASE shape
    WHEN 'junk' THEN length('junk ' || event_id)
    WHEN 'quoted' THEN length('{"panel_id":"","timestamp":"2024-01-01T00:00:00.000000+00:00","temperature_c":"3"}')
      + length(panel_id)
    ELSE length('{"panel_id":"","timestamp":"soon","temperature_c":.0}') + length(panel_id)
      + length(CAST(CAST(temperature_c AS BIGINT) AS VARCHAR)) END AS INTEGER) AS n_chars
FROM raw WHERE shape <> 'good'""",
    ),
    "training_records": _with(_TRAINING, f"SELECT *, {_HOUR_OF_DAY} AS hour FROM records"),
    "training_rejects": _with(
        _TRAINING, "SELECT CAST(event_id AS VARCHAR) AS key FROM shaped WHERE shape IN ('null', 'text', 'broken')"
    ),
    "training_window": _with(_TRAINING, 'SELECT * FROM records ORDER BY "timestamp", panel_id LIMIT 500'),
    "prediction_requests_valid": _with(_REQUESTS, "SELECT * FROM valid"),
    "prediction_requests_rejected": _with(
        _REQUESTS,
        """SELECT *, CASE WHEN irradiance_w_m2 > 0 THEN 'temperature_c is required'
  ELSE 'irradiance_w_m2 must be greater than 0' END AS rejected_because
FROM requests WHERE NOT (irradiance_w_m2 > 0 AND temperature_c IS NOT NULL)""",
    ),
    "tilt_candidates": _with(
        WIDE,
        f"""SELECT panel_id, "timestamp", irradiance_w_m2, temperature_c, {_HOUR_OF_DAY} AS hour,
  CAST(t.tilt AS DOUBLE) AS tilt_deg, 180.0::DOUBLE AS azimuth_deg
FROM wide CROSS JOIN generate_series(0, 60, 5) AS t(tilt)""",
    ),
    "best_tilt": _with(
        _SCORED,
        """SELECT event_id, panel_id, tilt_deg AS optimal_tilt, round(prediction + 3.17e-8, 6) AS predicted_power
FROM best""",
    ),
    "best_candidates": _with(
        _SCORED, "SELECT event_id, panel_id, hour, tilt_deg, round(prediction + 3.17e-8, 6) AS prediction FROM best"
    ),
    "top_candidates": _with(
        _SCORED,
        """SELECT event_id, tilt_deg, round(prediction + 3.17e-8, 6) AS prediction FROM scored
ORDER BY round(prediction + 3.17e-8, 6) DESC, tilt_deg, panel_id, "timestamp" LIMIT 25""",
    ),
    "control_commands": _with(
        _SCORED,
        f"""SELECT CAST(event_id AS VARCHAR) AS message_id, panel_id, 'SET_ANGLE' AS command_type,
  tilt_deg AS target_tilt, 180.0::DOUBLE AS target_azimuth, 'Maximized power output' AS reason, {ISO} AS "timestamp"
FROM best WHERE send_to_kafka""",
    ),
    "prediction_responses": _with(
        _SCORED,
        f"""SELECT panel_id, tilt_deg AS optimal_tilt, round(prediction + 3.17e-8, 6) AS predicted_power,
  {ISO} AS "timestamp", send_to_kafka AS kafka_sent FROM best""",
    ),
    "optimal_tilt_starting": _with(
        _modelled("SELECT * EXCLUDE (tilt_deg, azimuth_deg) FROM wide", WIDE),
        f"""SELECT panel_id, "timestamp", tilt_deg AS optimal_tilt, {_r("prediction")} AS predicted_power FROM best""",
    ),
    "candidate_scores_starting": _with(
        _modelled("SELECT * EXCLUDE (tilt_deg, azimuth_deg) FROM wide", WIDE), f"""SELECT panel_id, "timestamp", tilt_deg, {_r("prediction")} AS prediction FROM scored"""
    ),
    "compiled_scores_agreement": _with(
        WIDE,
        """SELECT 13 * count(*) AS n_candidates, 0::BIGINT AS n_different FROM wide
WHERE irradiance_w_m2 IS NOT NULL AND temperature_c IS NOT NULL""",
    ),
    "model_commands": _with(
        _REQUESTS,
        f"""SELECT CAST(event_id AS VARCHAR) AS message_id, panel_id, 'SET_ANGLE' AS command_type, TRUE AS tilt_on_grid,
  180.0::DOUBLE AS target_azimuth, 'Maximized power output' AS reason, {ISO} AS "timestamp"
FROM valid WHERE send_to_kafka""",
    ),
    "starting_commands": _with(
        _modelled("SELECT * FROM valid", _REQUESTS),
        f"""SELECT CAST(event_id AS VARCHAR) AS message_id, panel_id, 'SET_ANGLE' AS command_type, tilt_deg AS target_tilt,
  180.0::DOUBLE AS target_azimuth, 'Maximized power output' AS reason, {ISO} AS "timestamp"
FROM best WHERE send_to_kafka""",
    ),
    "model_responses": _with(
        _REQUESTS,
        f"""SELECT panel_id, TRUE AS tilt_on_grid, TRUE AS has_power, {ISO} AS "timestamp", send_to_kafka AS kafka_sent
FROM valid""",
    ),
    "starting_responses": _with(
        _modelled("SELECT * FROM valid", _REQUESTS),
        f"""SELECT panel_id, tilt_deg AS optimal_tilt, {_r("prediction")} AS predicted_power, {ISO} AS "timestamp",
  send_to_kafka AS kafka_sent
FROM best""",
    ),
    "optimal_tilt_agreement": _with(
        _REQUESTS,
        """SELECT count(*) AS n_readings, 0::BIGINT AS n_different FROM requests
WHERE irradiance_w_m2 IS NOT NULL AND temperature_c IS NOT NULL""",
    ),
    "retrain_status": _with(_TRAINING, "SELECT 'retrained' AS status, count(*) AS num_records FROM records"),
    "optimal_tilt_known": _with(
        WIDE,
        f"""SELECT panel_id, "timestamp", CASE WHEN {_HOUR_OF_DAY} < 12 THEN 25.0::DOUBLE ELSE 0.0::DOUBLE END AS optimal_tilt,
  round(CASE WHEN {_HOUR_OF_DAY} < 12 THEN 30.0::DOUBLE ELSE 50.0::DOUBLE END + 3.17e-8, 6) AS predicted_power
FROM wide""",
    ),
    "candidate_scores_known": _with(
        WIDE,
        f"""SELECT panel_id, "timestamp", CAST(t.tilt AS DOUBLE) AS tilt_deg,
  round(CAST(CASE WHEN t.tilt < 22 THEN 10 WHEN t.tilt < 42 THEN 30 ELSE 20 END
    + CASE WHEN {_HOUR_OF_DAY} < 12 THEN 0 WHEN t.tilt < 8 THEN 40 ELSE 4 END AS DOUBLE) + 3.17e-8, 6) AS prediction
FROM wide CROSS JOIN generate_series(0, 60, 5) AS t(tilt)""",
    ),
    "stream_enriched_features": _with(ENRICHED, "SELECT * FROM enriched"),
    "stream_window_stats": _with(CLOSED_STATS, f"SELECT {_STATS_COLUMNS} FROM stats"),
    "stream_window_stats_by_grouping": _with(CLOSED_STATS, f"SELECT {_STATS_COLUMNS} FROM stats"),
    "stream_window_stats_resent": _with(CLOSED_RESENT, f"SELECT {_STATS_COLUMNS} FROM stats"),
    "stream_panel_changes": _with(_timeline(DROPPED_STATS), f"SELECT {_TIMELINE_COLUMNS} FROM timeline"),
    # All windows, late or not, as far as the watermark has come: a day before the last start.
    "stream_panel_changes_in_order": _with(
        _timeline(CLOSED_STATS),
        f"""SELECT {_TIMELINE_COLUMNS} FROM timeline
WHERE window_start <= (SELECT max(window_start) FROM stats) - INTERVAL '1 day'""",
    ),
    "stream_panel_status": _with(_timeline(DROPPED_STATS), f"SELECT {_STATUS_COLUMNS} FROM status"),
    "stream_status_log": _with(_timeline(DROPPED_STATS), f"SELECT {_STATUS_COLUMNS} FROM status"),
    "stream_faults": _with(
        _peers(_HOUR),
        f"""SELECT panel_id AS key, panel_id, {ISO} AS "timestamp", power_dc_w AS current_power,
  round(avg_power + 3.17e-8, 6) AS average_others, round(deviation + 3.17e-8, 6) AS deviation FROM found
WHERE peer_time + INTERVAL '1 hour' <= (SELECT max("timestamp") FROM wide) - INTERVAL '10 seconds'""",
    ),
    "stream_job_enriched": _with(
        WHOLE,
        """SELECT panel_id, date_trunc('milliseconds', "timestamp") AS "timestamp", power_ac_w, efficiency,
  CASE WHEN power_dc_w > 0 THEN temperature_c / power_dc_w END AS temp_per_power FROM enriched""",
    ),
    "stream_job_window_stats": _with(JOB_STATS, f"SELECT {_STATS_COLUMNS} FROM stats"),
    "stream_job_stats_from_enriched": _with(REJOINED_STATS, f"SELECT {_STATS_COLUMNS} FROM stats"),
    "stream_job_rejects": _with(
        _RAW,
        """SELECT CAST(event_id AS VARCHAR) AS key, CAST(CASE shape WHEN 'junk' THEN length('junk ' || event_id)
    ELSE length('{"panel_id":"","timestamp":"soon","temperature_c":.0}') + length(panel_id)
      + length(CAST(CAST(temperature_c AS BIGINT) AS VARCHAR)) END AS INTEGER) AS n_chars
FROM raw WHERE shape IN ('junk', 'untimed')""",
    ),
    "stream_control_commands": _with(
        WIDE,
        f"""SELECT panel_id AS key, panel_id, 'SET_ANGLE' AS command_type, TRUE AS tilt_on_grid,
  180.0::DOUBLE AS target_azimuth, {ISO} AS "timestamp" FROM wide""",
    ),
    "stream_starting_commands": _with(
        _modelled("SELECT * EXCLUDE (tilt_deg, azimuth_deg) FROM wide", WIDE),
        f"""SELECT panel_id AS key, panel_id, 'SET_ANGLE' AS command_type, tilt_deg AS target_tilt,
  180.0::DOUBLE AS target_azimuth, {ISO} AS "timestamp" FROM best""",
    ),
    "refit_predictions": _with(
        WIDE,
        f"""SELECT morning, tilt_deg, count(*) AS n, min(w) AS lowest, max(w) AS highest FROM (
  SELECT {_HOUR_OF_DAY} < 12 AS morning, CAST(t.tilt AS DOUBLE) AS tilt_deg, CAST(
    CASE WHEN {_HOUR_OF_DAY} < 12 THEN CASE WHEN t.tilt < 35 THEN 25 WHEN t.tilt = 35 THEN 125 ELSE 50 END
    ELSE CASE WHEN t.tilt < 15 THEN 50 WHEN t.tilt = 15 THEN 150 ELSE 75 END END AS BIGINT) AS w
  FROM wide CROSS JOIN generate_series(0, 60, 5) AS t(tilt)) GROUP BY ALL""",
    ),
    "stream_refit_control": _with(
        _modelled("SELECT * EXCLUDE (tilt_deg, azimuth_deg) FROM wide", WIDE),
        f"""SELECT panel_id, {ISO} AS "timestamp", CASE
    WHEN (epoch_us("timestamp") - lo) * 2 // (hi - lo + 1) = 0 THEN tilt_deg
    WHEN {_HOUR_OF_DAY} < 12 THEN 35.0::DOUBLE ELSE 15.0::DOUBLE END AS target_tilt
FROM best, (SELECT min(epoch_us("timestamp")) AS lo, max(epoch_us("timestamp")) AS hi FROM wide)""",
    ),
    "stream_fanout": _with(_stats(WHOLE, "1 day"), f"SELECT {_STATS_COLUMNS} FROM stats"),
}
