import json
import math
import random

import pytest
from helpers import START, at, rows
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from heliograph import schemas, session
from heliograph.functions import wire
from heliograph.operators import tilt, training, trees


def _now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def _requests(spark, data):
    return spark.createDataFrame(data, schemas.PREDICTION_REQUEST)


def test_requests_get_defaults_and_are_checked(spark):
    df = _requests(
        spark,
        [
            (None, 800.0, 20.0, None, None),
            ("p2", 0.0, 20.0, at(0), True),
            ("p3", 10.0, None, at(0), True),
            ("p4", None, None, at(0), True),
            ("p5", 1.0, -5.0, at(0), True),
        ],
    )
    assert rows(tilt.valid_requests(df, _now())) == [
        ("p5", 1.0, -5.0, at(0), True),
        ("panel-1", 800.0, 20.0, at(31 * 86400 - 43200), False),
    ]
    assert rows(tilt.rejected_requests(df, _now()), "panel_id", "rejected_because") == [
        ("p2", "irradiance_w_m2 must be greater than 0"),
        ("p3", "temperature_c is required"),
        ("p4", "irradiance_w_m2 must be greater than 0"),
    ]


def test_candidates(spark):
    df = _requests(spark, [("p", 800.0, 20.0, at(0), False)])
    found = rows(tilt.candidates(df), "tilt_deg", "azimuth_deg", "hour")
    assert sorted(found) == [(float(t), 180.0, 12) for t in range(0, 61, 5)]


def test_ties_go_to_the_lowest_tilt(spark):
    df = spark.createDataFrame([("flat", 0.0), ("between", 32.5), ("top", 60.0)], "panel_id STRING, ideal DOUBLE")

    def score(angle):
        return F.when(F.col("panel_id") == "flat", 1.0).otherwise(-F.abs(F.lit(angle) - F.col("ideal")))

    assert rows(tilt.best_tilt(df, score), "panel_id", "optimal_tilt", "predicted_power") == [
        ("between", 30.0, -2.5),
        ("flat", 0.0, 1.0),
        ("top", 60.0, 0.0),
    ]
    written = tilt.candidates(df.withColumn("timestamp", F.lit(START))).withColumn(
        "prediction", F.when(F.col("panel_id") == "flat", 1.0).otherwise(-F.abs(F.col("tilt_deg") - F.col("ideal")))
    )
    found = rows(tilt.best_candidates(written, ["panel_id"]), "panel_id", "tilt_deg")
    assert found == [("between", 30.0), ("flat", 0.0), ("top", 60.0)]
    top = tilt.ranked_candidates(written, 2).select("panel_id", "tilt_deg").collect()
    assert [tuple(r) for r in top] == [("flat", 0.0), ("flat", 5.0)]


def test_commands_and_responses(spark):
    df = spark.createDataFrame(
        [("p1", at(0.5), True, 30.0, 9.0), ("p2", at(0), False, 35.0, 8.0), ("p3", at(0), True, None, None)],
        "panel_id STRING, timestamp TIMESTAMP, send_to_kafka BOOLEAN, optimal_tilt DOUBLE, predicted_power DOUBLE",
    )
    (message,) = wire.encode(tilt.commands(df), key="panel_id").collect()
    body = json.loads(message.value)
    assert message.key == "p1" and body.pop("message_id")
    assert body == {
        "panel_id": "p1",
        "command_type": "SET_ANGLE",
        "target_tilt": 30.0,
        "target_azimuth": 180.0,
        "reason": "Maximized power output",
        "timestamp": "2024-01-01T12:00:00.500000",
    }
    assert tilt.commands(df.drop("send_to_kafka")).count() == 2
    assert rows(tilt.prediction_response(df))[:2] == [
        ("p1", 30.0, 9.0, "2024-01-01T12:00:00.500000", True),
        ("p2", 35.0, 8.0, "2024-01-01T12:00:00", False),
    ]


def _facing_records(spark, n=400):
    """Seeded training rows whose power steps up to the tilts around 30 degrees and down again, and grows with the light."""
    rng = random.Random(5)
    data = []
    for i in range(n):
        light, angle = rng.choice([300.0, 600.0, 900.0]), rng.choice([0.0, 10.0, 20.0, 30.0, 40.0, 50.0, 60.0])
        power = light / 10 + 20.0 * (3 - abs(angle - 30.0) / 10)
        data.append((f"p{i % 7}", at(3600 * (i % 24)), light, power - 1, power, 10.0 + i % 30, angle, 180.0))
    return spark.createDataFrame(data, schemas.TRAINING)


@pytest.fixture(scope="module")
def model(spark):
    return training.fit(_facing_records(spark))


def _live(spark):
    data = [(f"p{i}", at(3600 * i), 800.0 + 20 * i, 0.0, 0.0, 30.0, 12.0, 90.0) for i in range(10)]
    return spark.createDataFrame(data, schemas.TRAINING)


def test_best_tilt_is_near_the_truth(spark, model):
    found = [r.optimal_tilt for r in training.optimal_tilt(_live(spark), model).collect()]
    assert all(20 <= t <= 45 for t in found) and set(found) <= set(tilt.TILTS)


def test_optimal_tilt_equals_brute_force(spark, model):
    chosen = training.optimal_tilt(_live(spark), model).collect()
    found = {r.panel_id: (r.optimal_tilt, r.predicted_power) for r in chosen}
    best = {}
    for r in training.score(tilt.candidates(_live(spark)), model).collect():
        mark = (r.prediction, -r.tilt_deg)
        if r.panel_id not in best or mark > best[r.panel_id]:
            best[r.panel_id] = mark
    assert {p: t for p, (t, _) in found.items()} == {p: -t for p, (_, t) in best.items()}
    assert {p: power for p, (_, power) in found.items()} == pytest.approx({p: power for p, (power, _) in best.items()})


@pytest.mark.parametrize("params", [training.QUICK, training.FINE])
def test_compiled_trees_equal_the_model(spark, params):
    fitted = training.fit(_facing_records(spark), **params)
    assert len(trees.of(fitted).trees) == params["maxIter"]
    rows_ = training.score(tilt.candidates(_live(spark)), fitted).withColumnRenamed("prediction", "walked")
    found = training.score_trees(rows_, fitted).collect()
    assert [r.prediction for r in found] == pytest.approx([r.walked for r in found], rel=1e-12)


@pytest.mark.parametrize("params", [training.QUICK, training.FINE, {"maxIter": 3, "minInstancesPerNode": 5}])
@pytest.mark.parametrize("few", [0, 10_000])
def test_a_fit_by_cells_equals_a_fit_on_all_rows(spark, monkeypatch, params, few):
    """Light has more values than bins, so it is cut at quantiles; the cuts and trees are Spark's own."""
    monkeypatch.setattr(training, "FEW_ROWS", few)
    power = (F.col("irradiance_w_m2") / 10 - F.abs(F.col("tilt_deg") - 30) + F.col("n") % 7).alias("power_dc_w")
    light = (F.col("n") * 37 % 1009 + 0.5).alias("irradiance_w_m2")
    made = spark.range(4000).select(
        F.lit("p").alias("panel_id"),
        F.timestamp_seconds(F.col("id") * 3600).alias("timestamp"),
        F.col("id").alias("n"),
        (F.col("id") % 9 + 10.0).alias("temperature_c"),
        (F.col("id") % 5 * 12.0).alias("tilt_deg"),
        F.lit(180.0).alias("azimuth_deg"),
    )
    records = made.select("*", light).select("*", power).drop("n")
    known = training.add_hour(records)
    by_cells = training.score(known, training.fit(records, **params)).withColumnRenamed("prediction", "found")
    assembler = VectorAssembler(inputCols=training.FEATURES, outputCol="features")
    own = GBTRegressor(labelCol="power_dc_w", seed=7, **params).fit(assembler.transform(known))
    both = own.transform(assembler.transform(by_cells)).select("found", "prediction").collect()
    assert len(both) == 4000
    assert [r.found for r in both] == pytest.approx([r.prediction for r in both], rel=1e-9)


def test_rounds_of_a_fit_cost_what_there_are_cells(spark, monkeypatch):
    monkeypatch.setattr(training, "FEW_ROWS", 100)
    seen, own = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, df: seen.append(df.count()) or own(self, df))
    for copies in (1, 20):
        training.fit(_facing_records(spark, 200).withColumn("c", F.explode(F.sequence(F.lit(1), F.lit(copies)))), maxIter=2)
    assert seen[0] == seen[1] <= 200


def test_values_at_a_cut_go_where_the_model_sends_them(spark, model):
    """Compiled trees and the model agree on readings that lie on a threshold and beside it."""
    edges = [e for e in model.stages[0].getSplitsArray()[0] if math.isfinite(e)]
    lights = [light for e in edges for light in (math.nextafter(e, -math.inf), e, math.nextafter(e, math.inf))]
    live = spark.createDataFrame([("p", at(n), x, 0.0, 0.0, 30.0, 12.0, 90.0) for n, x in enumerate(lights)], schemas.TRAINING)
    walked = training.score(tilt.candidates(live), model).withColumnRenamed("prediction", "walked")
    found = training.score_trees(walked, model).collect()
    assert len(found) == 13 * len(lights)
    assert [r.prediction for r in found] == pytest.approx([r.walked for r in found], rel=1e-12)


def test_trees_shrink_to_what_is_left():
    tree = (3, 10.0, (0, 5.0, 1.0, 2.0), (3, 20.0, (0, 5.0, 1.0, 2.0), 7.0))
    assert trees.given(tree, {3: 15.0}) == trees.given(tree, {3: 10.0}) == (0, 5.0, 1.0, 2.0)
    assert trees.given(tree, {3: 21.0}) == 7.0 and trees.given(tree, {0: 1.0, 3: 1.0}) == 1.0
    assert trees.given((3, 1.0, (0, 5.0, 4.0, 4.0), 4.0), {}) == 4.0


def test_trees_take_nan_like_the_model(spark):
    fitted = training.fit(_facing_records(spark, 200))
    nan = tilt.candidates(_live(spark).withColumn("temperature_c", F.lit(float("nan"))))
    found = training.score_trees(nan, fitted)
    known = training.score_trees(nan.withColumn("temperature_c", F.lit(1e300)), fitted)
    assert rows(found, "panel_id", "tilt_deg", "prediction") == rows(known, "panel_id", "tilt_deg", "prediction")


def test_unscorable_readings_stay_without_an_answer(spark, model):
    df = spark.createDataFrame([("p", at(0), None, 1.0, 1.0, 20.0, 1.0, 1.0)], schemas.TRAINING)
    assert rows(training.optimal_tilt(df, model), "optimal_tilt", "predicted_power") == [(None, None)]


def test_scoring_does_not_shuffle(spark, model):
    plan = training.optimal_tilt(_live(spark), model)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan


def test_model_is_saved_by_version(spark, model, tmp_path):
    path = training.save(model, str(tmp_path), 3)
    assert path.endswith("version=3")
    again = training.optimal_tilt(_live(spark), training.load(path))
    assert rows(again) == rows(training.optimal_tilt(_live(spark), model))


def test_retrain_writes_what_the_fit_needs(spark, monkeypatch):
    records = spark.range(60).selectExpr(
        "'p' AS panel_id", "timestamp_seconds(id * 4000) AS timestamp", "id * 5D AS irradiance_w_m2", "1D AS power_ac_w",
        "if(id = 7, NULL, id % 9 * 10D) AS power_dc_w", "20D + id % 4 AS temperature_c", "id % 13 * 5D AS tilt_deg", "180D AS azimuth_deg",
    )
    kept, own = {}, session.materialise
    monkeypatch.setattr(session, "materialise", lambda df, name: kept.update({name: df.columns}) or own(df, name))
    model, status = training.retrain(records, maxIter=3)
    assert kept["retrain"] and set(kept["retrain"]) == {*training.FEATURES, training.LABEL}
    assert rows(status) == [("retrained", 60)]
    whole = training.fit(records, maxIter=3)
    assert model.stages[-1].toDebugString.split("\n")[1:] == whole.stages[-1].toDebugString.split("\n")[1:]


def test_retrain_statuses(spark):
    records = _facing_records(spark, 60)
    none, status = training.retrain(records.limit(0))
    assert none is None and rows(status) == [("no_data", 0)]
    none, status = training.retrain(records.drop("power_dc_w"))
    assert none is None and rows(status) == [("no_label", 60)]
    fitted, status = training.retrain(records, max_rows=40, maxIter=2)
    assert fitted.stages[-1].getNumTrees == 2 and rows(status) == [("retrained", 40)]


def test_training_records(spark):
    number = {"irradiance_w_m2": 800, "power_dc_w": 100}
    cases = [
        {"panel_id": "a", "timestamp": "2024-01-01T12:00:00+00:00", **number, "power_ac_w": 95, "temperature_c": 20},
        {
            "panel_id": "b",
            "timestamp": "2024-01-01T12:00:00Z",
            "irradiance": "700",
            "power": 50,
            "temp": 1,
            "tilt": 2,
            "azimuth": 3,
        },
        {},
        {"panel_id": None, "timestamp": "whenever", "irradiance_w_m2": 1, "irradiance": "abc"},
        {"panel_id": 7, "timestamp": 1704110400},
        {"panel_id": "x", "temperature_c": None, "temp": 20},
        {"panel_id": "x", "irradiance": "abc"},
        {"panel_id": "x", "power_ac_w": None},
    ]
    texts = [json.dumps(c) for c in cases] + ["not json", "[1]", "3"]
    messages = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], schemas.WIRE)
    late = at(31 * 86400 - 43200)
    assert rows(training.training_records(messages, _now())) == sorted(
        [
            ("a", at(0), 800.0, 95.0, 100.0, 20.0, 30.0, 180.0),
            ("b", at(0), 700.0, 45.0, 50.0, 1.0, 2.0, 3.0),
            ("p1", late, 0.0, 0.0, 0.0, 25.0, 30.0, 180.0),
            (None, late, 1.0, 0.0, 0.0, 25.0, 30.0, 180.0),
            ("7", late, 0.0, 0.0, 0.0, 25.0, 30.0, 180.0),
        ],
        key=repr,
    )
    assert [r[0] for r in rows(training.training_rejects(messages), "key")] == ["10", "5", "6", "7", "8", "9"]


def test_earliest_records(spark):
    df = spark.createDataFrame([("a", at(i % 7 * 10 + i)) for i in range(50)], "panel_id STRING, timestamp TIMESTAMP")
    found = training.earliest(df, ["timestamp"], 5)
    assert sorted(r.timestamp for r in found.collect()) == sorted(r.timestamp for r in df.collect())[:5]
