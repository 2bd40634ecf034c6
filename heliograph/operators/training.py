"""Training records from loosely shaped JSON, model fitting, scoring and refitting."""

from __future__ import annotations

import math
import sys
from collections import Counter
from functools import reduce
from itertools import pairwise

from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph import schemas, session
from heliograph.functions import scalars, wire
from heliograph.operators import tilt, trees

# Feature order and label.
FEATURES = ["irradiance_w_m2", "temperature_c", "hour", "tilt_deg", "azimuth_deg"]
LABEL = "power_dc_w"
SEED = 7

# The quick model of the control loop, and the finer one of the prediction service.
QUICK = {"maxIter": 10}
FINE = {"maxIter": 50, "maxDepth": 3, "stepSize": 0.1}

# Target, first key, other key, default.
NUMBERS = [
    ("irradiance_w_m2", "irradiance_w_m2", "irradiance", "0"),
    ("power_dc_w", "power_dc_w", "power", "0"),
    ("temperature_c", "temperature_c", "temp", "25.0"),
    ("tilt_deg", "tilt_deg", "tilt", "30.0"),
    ("azimuth_deg", "azimuth_deg", "azimuth", "180.0"),
]
BINS = [f"_bin_{name}" for name in FEATURES]

# Regressor parameters that do not look at single rows, so that rows of one cell may go as one.
BY_CELL = {"maxIter", "maxDepth", "stepSize", "maxBins", "minInfoGain"}

COLUMNS = [field.split()[0] for field in schemas.TRAINING.split(", ")]
DEFAULT_PANEL = "p1"
AC_SHARE = 0.9

MAX_RECORDS = 500

# Spark's own values: bins of a feature, and rows that place their cuts.
MAX_BINS, CUT_SAMPLE = 32, 10_000

# Tables of up to so many rows are fitted row by row.
FEW_ROWS = 1_000_000


def _mapped(messages: DataFrame, now: Column | None) -> DataFrame:
    """Messages with the JSON fields in `_found` and the training row in `_record`.

    The steps are kept apart so that each text is looked up once and parsed once, in code small enough to be compiled.
    """
    found = F.col("_found")
    texts = [wire.present(found, key, alias, F.lit(default)).alias(name) for name, key, alias, default in NUMBERS]
    texts += [
        wire.present(found, "panel_id", None, F.lit(DEFAULT_PANEL)).alias("panel_id"),
        F.element_at(found, "timestamp").alias("timestamp"),
        F.element_at(found, "power_ac_w").alias("power_ac_w"),
        F.map_contains_key(found, "power_ac_w").alias("has_ac"),
    ]
    numeric = [*(row[0] for row in NUMBERS), "power_ac_w"]
    numbers = [scalars.parse_number(F.col(f"_text.{name}")).alias(name) for name in numeric]
    time = scalars.parse_iso(F.col("_text.timestamp")).alias("timestamp")
    rows = wire.computed_once(wire.text_value(messages), wire.fields(F.col("value")), "_found")
    rows = wire.computed_once(rows, F.struct(*texts), "_text")
    rows = wire.computed_once(rows, F.struct(*numbers, time), "_number")

    dc = F.col("_number.power_dc_w")
    ac = F.when(F.col("_text.has_ac"), F.col("_number.power_ac_w")).otherwise(
        F.when(dc != 0, dc * AC_SHARE).otherwise(F.lit(0.0))
    )
    fields = {
        "panel_id": F.col("_text.panel_id"),
        "timestamp": F.coalesce("_number.timestamp", F.current_timestamp() if now is None else now),
        **{name: F.col(f"_number.{name}") for name, *_ in NUMBERS},
        "power_ac_w": ac,
    }
    return rows.withColumn("_record", F.struct(*[fields[name].alias(name) for name in COLUMNS]))


def _usable() -> Column:
    usable = F.col("_found").isNotNull()
    for name in COLUMNS[2:]:
        usable = usable & F.col(f"_record.{name}").isNotNull()
    return usable


def training_records(messages: DataFrame, now: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Training rows from JSON messages with other key names, missing keys and defaults.

    A message that is no JSON object, or has a number that is null or unreadable, is left out (see
    `training_rejects`). A time that is missing or unreadable becomes `now`. `keep` names message columns to carry on.
    """
    return _mapped(messages, now).where(_usable()).select("_record.*", *keep)


def training_rejects(messages: DataFrame) -> DataFrame:
    """The messages that `training_records` leaves out, unchanged."""
    return _mapped(messages, None).where(~_usable()).select(*messages.columns)


def earliest(records: DataFrame, order: list[str], limit: int = MAX_RECORDS) -> DataFrame:
    """The first `limit` records in the given order, a top-k that never sorts the whole input."""
    return records.orderBy(*order).limit(limit)


def add_hour(records: DataFrame) -> DataFrame:
    """Hour of day of the event time."""
    return records.withColumn("hour", F.hour(schemas.EVENT_TIME))


def fit(records: DataFrame, seed: int = SEED, **params) -> PipelineModel:
    """Boosted trees predicting DC power from the five features. Rows without a full set of numbers are skipped.

    The fit reads its input several times, so the features are written to the shared folder first, and whatever made
    `records` runs once. `params` go to the regressor; see `QUICK` and `FINE`.
    """
    spark = records.sparkSession
    with session.scratch(spark):
        ready = session.materialise(_featured(records), "training")
        return _fit(ready, seed, params or QUICK)


def _featured(records: DataFrame) -> DataFrame:
    return add_hour(records).select(*FEATURES, LABEL).dropna()


def _fit(ready: DataFrame, seed: int, params: dict) -> PipelineModel:
    """Fit on a table of features and label, all rows of it.

    A tree tells rows apart by the bins of their features alone, and squared error by count and sum of the labels. So the
    rows of a cell, which lie in the same bins, go to every round as one: their mean label, weighted by their number. The
    trees are those of the rows, and the rounds cost what there are cells, whose number the bins bound. Where two splits
    part the rows alike, the last digits of sums decide between them, and those may differ; few rows are fitted one by one.
    """
    spark = ready.sparkSession
    session.use_checkpoints(spark)
    number = ready.count()
    bucketizer = _bucketizer(ready, number, params.get("maxBins", MAX_BINS), seed)
    # Without the bucketizer's metadata, by which bins would have no order.
    bins = [F.col(name).alias(name, metadata={}) for name in BINS]
    binned = bucketizer.transform(ready).select(*bins, LABEL)
    if number > FEW_ROWS and set(params) <= BY_CELL:
        cells = binned.groupBy(*BINS).agg(F.count(F.lit(1)).cast("double").alias("_weight"), F.avg(LABEL).alias(LABEL))
    else:
        cells = binned.select(*BINS, F.lit(1.0).alias("_weight"), LABEL)
    cells = session.materialise(cells, "cells")
    assembler = VectorAssembler(inputCols=BINS, outputCol="features")
    regressor = GBTRegressor(featuresCol="features", labelCol=LABEL, weightCol="_weight", seed=seed, **params)
    return PipelineModel([bucketizer, assembler, regressor.fit(assembler.transform(cells))])


def _bucketizer(ready: DataFrame, number: int, max_bins: int, seed: int) -> Bucketizer:
    """Bins of the features, cut where Spark's trees would cut them: between all values, or, where there are more than
    bins, at quantiles. As there, a large table's cuts are placed by a sample; every row is then binned and fitted."""
    wanted = max(max_bins**2, CUT_SAMPLE)
    sample = ready if number <= wanted else ready.sample(wanted / number, seed)
    rows = sample.select(*[F.col(name).cast("double") for name in FEATURES]).collect()
    most = min(max_bins, max(number, 1)) - 1
    splits = []
    for place in range(len(FEATURES)):
        values = Counter(row[place] for row in rows)
        # A bin of the bucketizer begins at its cut, a tree's ends there. Without a cut all values are in the first bin.
        found = cuts(values, most) or [max(values, default=0.0)]
        inner = sorted({math.nextafter(cut, math.inf) for cut in found} - {math.inf})
        splits.append([-math.inf, *(inner or [sys.float_info.max]), math.inf])
    return Bucketizer(splitsArray=splits, inputCols=FEATURES, outputCols=BINS, handleInvalid="skip")


def cuts(values: dict[float, int], most: int) -> list[float]:
    """At most `most` cuts between counted values, in bins of about the same count; all cuts where these are few."""
    ordered = sorted(values.items())
    between = [max((low + high) / 2, -sys.float_info.max) for (low, _), (high, _) in pairwise(ordered)]
    if len(between) <= most:
        return between
    stride = sum(values.values()) / (most + 1)
    found, seen, target = [], ordered[0][1], stride
    for cut, (_, count) in zip(between, ordered[1:], strict=True):
        if abs(seen - target) < abs(seen + count - target):
            found.append(cut)
            target += stride
        seen += count
    return found


def score(candidates: DataFrame, model: PipelineModel) -> DataFrame:
    """Candidate rows with their `prediction`."""
    return model.transform(candidates).drop("features", *BINS)


def starting_model() -> trees.Ensemble:
    """Trees for the time before there is anything to fit: the noise-free DC power of `scalars.expected_dc_power` on a grid
    of irradiance and tilt, less a little for warm panels and for the hours away from noon."""
    light = [100.0 * k for k in range(1, 12)]
    power = [
        trees.steps(FEATURES.index("tilt_deg"), [7.5, 22.5, 37.5, 52.5], [_cell(50.0 + low, 15.0 * k) for k in range(5)])
        for low in [0.0, *light]
    ]
    warm = trees.steps(FEATURES.index("temperature_c"), [25.0, 45.0, 65.0], [0.0, -4.0, -9.0, -15.0])
    facing = [trees.steps(FEATURES.index("tilt_deg"), [12.5, 32.5], own) for own in ([2.0, 11.0, 6.0], [9.0, 3.0, 1.0])]
    day = trees.steps(FEATURES.index("hour"), [8.5, 15.5], [facing[0], facing[1], facing[0]])
    return trees.Ensemble([trees.steps(FEATURES.index("irradiance_w_m2"), light, power), warm, day], [1.0, 0.5, 0.25])


def _cell(irradiance: float, angle: float) -> float:
    share = max(scalars.LOWEST_TILT_FACTOR, math.cos(math.radians(angle)))
    return round(irradiance * scalars.PANEL_AREA_M2 * scalars.CELL_EFFICIENCY * share, 2)


def score_trees(candidates: DataFrame, model: PipelineModel | trees.Ensemble) -> DataFrame:
    """Candidate rows with their `prediction`, NULL where a feature is; without vectors."""
    found = trees.prediction(_trees(model), [F.col(name) for name in FEATURES])
    known = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in FEATURES])
    return candidates.withColumn("prediction", F.when(known, found))


def _trees(model: PipelineModel | trees.Ensemble) -> trees.Ensemble:
    return model if isinstance(model, trees.Ensemble) else trees.of(model)


def optimal_tilt(readings: DataFrame, model: PipelineModel | trees.Ensemble) -> DataFrame:
    """Best candidate tilt and its predicted power for every reading.

    The model's trees are compiled into the plan. Among the 13 candidates of a reading only the tilt varies, so each tree
    is a step function of the tilt: what is left of it between two steps is computed once, and a candidate's score adds up
    the steps that it is on. There is no explode and no shuffle, so this scales with the scan. Readings that lack a feature
    are answered with NULL.
    """
    model = _trees(model)
    own = readings.drop("tilt_deg", "azimuth_deg").withColumn("hour", F.hour(schemas.EVENT_TIME))
    scorable = F.col("irradiance_w_m2").isNotNull() & F.col("temperature_c").isNotNull() & F.col("hour").isNotNull()
    features = [F.col(name) if name in ("irradiance_w_m2", "temperature_c", "hour") else F.lit(None) for name in FEATURES]
    tilt_at, azimuth_at = FEATURES.index("tilt_deg"), FEATURES.index("azimuth_deg")
    rest: dict[trees.Tree, str] = {}
    places = []
    for angle in tilt.TILTS:
        left = [trees.given(tree, {tilt_at: angle, azimuth_at: tilt.TARGET_AZIMUTH}) for tree in model.trees]
        places.append([rest.setdefault(tree, f"_part_{len(rest)}") for tree in left])
    # Parts that several candidates share are columns of their own, which Spark does not compute again for each of them.
    rows = own.withColumns({name: trees.value(tree, features) for tree, name in rest.items()} | {"_scorable": scorable})
    scores = [
        (angle, F.when(F.col("_scorable"), trees.total([F.col(name) for name in names], model.weights)))
        for angle, names in zip(tilt.TILTS, places, strict=True)
    ]
    chosen = tilt.with_best(rows, scores, (*rest.values(), "hour"))
    return chosen.withColumn("optimal_tilt", F.when(F.col("_scorable"), F.col("optimal_tilt"))).drop("_scorable")


def answer(requests: DataFrame, model: PipelineModel | trees.Ensemble, now: Column | None = None) -> DataFrame:
    """Best tilt for every valid prediction request; see `tilt.prediction_response` and `tilt.commands`."""
    return optimal_tilt(tilt.valid_requests(requests, now), model)


def retrain(records: DataFrame, max_rows: int | None = None, **params) -> tuple[PipelineModel | None, DataFrame]:
    """Fit on all records, or on the earliest `max_rows` by event time, and report `status` and `num_records`.

    The status is 'no_data' without records, 'no_label' without a label column or value, else 'retrained'.
    """
    spark = records.sparkSession
    chosen = records if max_rows is None else earliest(records, [schemas.EVENT_TIME, schemas.PANEL], max_rows)
    with session.scratch(spark):
        # Of the records, what the fit needs.
        chosen = add_hour(chosen)
        chosen = session.materialise(chosen.select(*[n for n in chosen.columns if n in (*FEATURES, LABEL)]), "retrain")
        labels = F.count(LABEL) if LABEL in chosen.columns else F.lit(0).cast("long")
        number, labelled = chosen.agg(F.count(F.lit(1)), labels).first()
        if number == 0:
            return None, _status(spark, "no_data", 0)
        if labelled == 0:
            return None, _status(spark, "no_label", number)
        return _fit(chosen.select(*FEATURES, LABEL).dropna(), SEED, params or FINE), _status(spark, "retrained", number)


def _status(spark: SparkSession, status: str, number: int) -> DataFrame:
    return spark.createDataFrame([(status, number)], "status STRING, num_records BIGINT")


def save(model: PipelineModel, base: str, version: int) -> str:
    """Write one model version; earlier versions stay, so a reader is never cut off."""
    path = f"{base}/version={version}"
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    """Read a model version back."""
    return PipelineModel.load(path)
