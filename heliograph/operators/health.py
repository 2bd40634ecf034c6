"""Panel health: rules, break and recovery, latest status, and merging into a status table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliograph import schemas, session
from heliograph.functions.scalars import round_exact

# Limits of the four rules.
VERY_LOW_EFFICIENCY = 5.0
LOW_EFFICIENCY = 10.0
ADEQUATE_IRRADIANCE = 100.0
HIGH_TEMPERATURE = 85.0
NO_IRRADIANCE = 10.0
WARM_TEMPERATURE = 25.0

HEALTHY = 0

# Start of the last window that a status has seen.
LAST_WINDOW = "last_window"


def reason_code() -> Column:
    """Number of the first rule that fires, 0 for a healthy window. A rule with a NULL or NaN operand does not fire."""
    # Spark orders NaN above all numbers.
    eff, temp, irr = (F.nanvl(F.col(n), F.lit(None)) for n in ("avg_efficiency", "avg_temp", "avg_irradiance"))
    return (
        F.when(eff < VERY_LOW_EFFICIENCY, 1)
        .when((irr > ADEQUATE_IRRADIANCE) & (eff < LOW_EFFICIENCY), 2)
        .when(temp > HIGH_TEMPERATURE, 3)
        .when((irr < NO_IRRADIANCE) & (temp > WARM_TEMPERATURE), 4)
        .otherwise(HEALTHY)
    )


def reason_text() -> Column:
    """Reason of the rule in `reason_code`, from the rounded values in `_value` and `_light`."""
    code, value, light = F.col("reason_code"), F.col("_value"), F.col("_light")
    # Reason texts.
    return (
        F.when(code == 1, F.format_string("Low efficiency: %.2f%%", value))
        .when(
            code == 2,
            F.format_string("Low efficiency (%.2f%%) despite adequate irradiance (%.0f W/m²)", value, light),
        )
        .when(code == 3, F.format_string("Temperature anomaly: %.1f°C", value))
        .when(code == 4, F.format_string("No irradiance detected despite warm temperature (%.1f°C)", value))
    )


def classify(stats: DataFrame, clock: Column | None = None) -> DataFrame:
    """Window statistics with `reason_code`, `is_broken`, `reason` and `as_of`; rows without a panel id are left out.

    `as_of` is the time a status begins or is updated at: the end of the window, so that results can be repeated, or a
    `clock` such as `current_timestamp()`.

    A reason quotes the efficiency or the temperature, and in one case the irradiance. These are chosen and rounded
    in steps of their own, which keeps the generated code small enough to be compiled.
    """
    code = F.col("reason_code")
    by_efficiency = code <= 2
    return (
        stats.where(F.col("panel_id").isNotNull() & (F.col("panel_id") != ""))
        .withColumn("reason_code", reason_code())
        .withColumn("is_broken", code != HEALTHY)
        .withColumn("_value", F.when(by_efficiency, F.col("avg_efficiency")).otherwise(F.col("avg_temp")))
        .withColumn("_places", F.when(by_efficiency, 2).otherwise(1))
        .withColumn("_value", round_exact(F.col("_value"), F.col("_places")))
        .withColumn("_light", round_exact(F.col("avg_irradiance"), 0))
        .withColumn("reason", reason_text())
        .withColumn("as_of", F.col("window_end") if clock is None else clock)
        .drop("_value", "_places", "_light")
    )


def timeline(stats: DataFrame, clock: Column | None = None) -> DataFrame:
    """Status of every panel after each of its windows.

    `reason` and `broken_since` are those of the window that broke the panel and hold until it recovers. `change` is
    'broken' or 'recovered' on the window where the status turns, and NULL elsewhere. `from_start` tells that the
    status has not turned since the panel's first window here. Resent window statistics go through
    `stats.distinct_windows` first.

    One shuffle by panel and one sort serve all window functions. A panel has one row per window, so the size of its
    group is set by the calendar (525,600 one-minute windows a year), not by how many readings it sent. The frames run
    from the first row to the current one and keep no rows in memory.
    """
    by_time = Window.partitionBy("panel_id").orderBy("window_start")
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    was_broken = F.lag("is_broken").over(by_time)
    breaking = F.struct(F.col("reason"), F.col("as_of").alias("broken_since"))
    marked = (
        classify(stats, clock)
        .withColumn("_was_broken", was_broken)
        .withColumn("_breaks", F.col("is_broken") & ~F.coalesce("_was_broken", F.lit(False)))
        .withColumn("_run", F.last(F.when(F.col("_breaks"), breaking), ignorenulls=True).over(so_far))
        .withColumn(
            "from_start", F.count(F.when(F.col("is_broken") != F.col("_was_broken"), 1)).over(so_far) == 0
        )
    )
    return _statuses(marked)


def _statuses(marked: DataFrame) -> DataFrame:
    """Timeline rows from windows that know the status before them, whether they break it, and the run they are in."""
    return marked.select(
        "panel_id",
        "window_start",
        "window_end",
        "avg_efficiency",
        F.col("avg_temp").alias("avg_temperature"),
        "avg_irradiance",
        "is_broken",
        "reason_code",
        F.when(F.col("is_broken"), F.col("_run.broken_since")).alias("broken_since"),
        F.when(F.col("is_broken"), F.col("_run.reason")).alias("reason"),
        F.when(F.col("_breaks"), "broken").when(~F.col("is_broken") & F.col("_was_broken"), "recovered").alias("change"),
        "as_of",
        "from_start",
    )


def timeline_in_pieces(stats: DataFrame, piece: str = "1 day", clock: Column | None = None) -> DataFrame:
    """The rows of `timeline` for panels with more windows than a task should sort, such as years of seconds.

    A panel's history is cut into pieces of time, and each piece goes to a task of its own. What a piece does to a
    status is told by four things: its first window, its last status, its last break and whether it turned. These
    compose, so one row per piece goes through the panel's order (365 a year for days), and every piece is then told
    what was before it. The windows are written once to the shared folder, as both steps read them. Times need not be
    without gaps. No windows give no rows.
    """
    keys = ["panel_id", "_piece"]
    in_piece = Window.partitionBy(*keys).orderBy("window_start")
    so_far = in_piece.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    breaking = F.struct(F.col("reason"), F.col("as_of").alias("broken_since"))
    inner_break = F.when(F.col("is_broken") & ~F.col("_before"), breaking)
    inner_turn = F.when(F.col("is_broken") != F.col("_before"), 1)
    windows = (
        classify(stats, clock)
        .withColumn("_piece", F.window("window_start", piece)["start"])
        .withColumn("_before", F.lag("is_broken").over(in_piece))
        .withColumn("_break", F.last(inner_break, ignorenulls=True).over(so_far))
        .withColumn("_turned", F.count(inner_turn).over(so_far) > 0)
    )
    windows = session.materialise(windows, "timeline_pieces")
    marked = windows.join(_before_pieces(windows, keys, breaking), keys).withColumns(
        {
            "_was_broken": F.coalesce("_before", "_broken_earlier"),
            "_breaks": F.col("is_broken") & ~F.coalesce("_before", "_broken_earlier", F.lit(False)),
            "_run": F.coalesce("_break", "_opening", "_break_earlier"),
            "from_start": ~(F.col("_turned") | F.col("_turned_earlier")),
        }
    )
    return _statuses(marked)


def _before_pieces(windows: DataFrame, keys: list[str], breaking: Column) -> DataFrame:
    """What each piece finds: the status before it, the break it opens with or else the last one before it, and whether
    the panel has turned up to and with its first window."""
    by_piece = Window.partitionBy("panel_id").orderBy("_piece")
    earlier = by_piece.rowsBetween(Window.unboundedPreceding, -1)
    ends = windows.groupBy(*keys).agg(
        F.min_by(F.struct("is_broken", breaking.alias("breaking")), "window_start").alias("_first"),
        F.max_by(F.struct("is_broken", "_break", "_turned"), "window_start").alias("_last"),
    )
    first_broken, before = F.col("_first.is_broken"), F.col("_broken_earlier")
    return (
        ends.withColumn("_broken_earlier", F.lag("_last.is_broken").over(by_piece))
        .withColumn("_opening", F.when(first_broken & ~F.coalesce(before, F.lit(False)), F.col("_first.breaking")))
        .withColumn("_opening_turn", F.coalesce(first_broken != before, F.lit(False)))
        .withColumn("_break_earlier", F.last(F.coalesce("_last._break", "_opening"), ignorenulls=True).over(earlier))
        .withColumn("_turns", F.max(F.col("_last._turned") | F.col("_opening_turn")).over(earlier))
        .withColumn("_turned_earlier", F.col("_opening_turn") | F.coalesce("_turns", F.lit(False)))
        .select(*keys, "_broken_earlier", "_opening", "_break_earlier", "_turned_earlier")
    )


def transitions(stats: DataFrame) -> DataFrame:
    """Only the windows where a panel broke or recovered."""
    return timeline(stats).where(F.col("change").isNotNull())


def _latest(stats: DataFrame, clock: Column | None) -> DataFrame:
    """Last row of each panel's timeline. The values are taken as they are, NULLs too."""
    kept = [name for name in schemas.STATUS_COLUMNS if name not in ("panel_id", "last_updated")]
    row = F.struct(*kept, F.col("as_of").alias("last_updated"), F.col("window_start").alias(LAST_WINDOW), "from_start")
    last = timeline(stats, clock).groupBy("panel_id").agg(F.max_by(row, "window_start").alias("row"))
    return last.select("panel_id", "row.*")


def latest_status(stats: DataFrame, clock: Column | None = None) -> DataFrame:
    """Panel status table: one row per panel after its last window."""
    return _latest(stats, clock).select(*schemas.STATUS_COLUMNS)


def latest_status_by_window(stats: DataFrame, clock: Column | None = None) -> DataFrame:
    """The same with the start of the last window as `last_window`, as `advance_status` wants it to reject older ones."""
    return _latest(stats, clock).select(*schemas.STATUS_COLUMNS, LAST_WINDOW)


def later_windows(current: DataFrame, stats: DataFrame) -> DataFrame:
    """The windows that begin after the last one a panel's status has seen; others came too late or were sent again."""
    seen = current.select(F.col("panel_id").alias("_panel"), F.col(LAST_WINDOW).alias("_seen"))
    known = stats.join(seen, F.col("panel_id") == F.col("_panel"), "left")
    return known.where(F.col("_seen").isNull() | (F.col("window_start") > F.col("_seen"))).drop("_panel", "_seen")


def advance_status(current: DataFrame, stats: DataFrame, clock: Column | None = None) -> DataFrame:
    """The status table after further windows: known panels are updated, new ones inserted, the rest kept.

    A panel that was broken, and has been broken in all further windows, keeps its reason and time of breaking. With
    the column `last_window` in `current`, windows that do not begin after a panel's last one are rejected: a status
    never goes back in time, and a window counts once. The result has that column too. Without it, the windows must
    all be later ones.
    """
    guarded = LAST_WINDOW in current.columns
    new = _latest(later_windows(current, stats) if guarded else stats, clock).alias("new")
    old = current.alias("old")
    updated = F.col("new.panel_id").isNotNull()
    holds = F.col("old.is_broken") & F.col("new.is_broken") & F.col("new.from_start")
    sticky = {"broken_since", "reason"}
    columns = [F.coalesce("old.panel_id", "new.panel_id").alias("panel_id")]
    for name in schemas.STATUS_COLUMNS[1:] + [LAST_WINDOW] * guarded:
        take_new = updated & ~F.coalesce(holds, F.lit(False)) if name in sticky else updated
        columns.append(F.when(take_new, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name))
    return old.join(new, F.col("old.panel_id") == F.col("new.panel_id"), "full_outer").select(*columns)


def upsert_status(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Match-or-insert by panel: rows of `updates` replace rows of `current` with the same panel id."""
    old, new = current.alias("old"), updates.alias("new")
    updated = F.col("new.panel_id").isNotNull()
    columns = [F.coalesce("old.panel_id", "new.panel_id").alias("panel_id")] + [
        F.when(updated, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)
        for name in schemas.STATUS_COLUMNS[1:]
    ]
    return old.join(new, F.col("old.panel_id") == F.col("new.panel_id"), "full_outer").select(*columns)
