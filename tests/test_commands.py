"""Commands and answers by a fitted model, on events made here."""

import pytest

from heliograph.operators import training
from heliograph.plans import catalog


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    made = str(tmp_path_factory.mktemp("events"))
    rows = spark.range(300).selectExpr(
        "id AS event_id",
        "timestamp_ntz'2024-01-05 00:00:00' + make_dt_interval(0, 0, 0, id * 7000) AS ts",
        "id % 7 AS user_id",
        "element_at(array('view', 'click', 'error'), cast(id % 3 AS INT) + 1) AS event_type",
        "id % 90 + 5.5D AS value",
        """concat('{"k": ', id % 100, '}') AS props""",
    )
    rows.write.parquet(f"{made}/events.parquet")
    return made


@pytest.mark.parametrize("name", ["model_commands", "model_responses", "stream_control_commands"])
def test_answers_come_from_a_fit_on_all_enriched_readings(spark, folder, monkeypatch, name):
    fits, own = [], training.fit
    monkeypatch.setattr(training, "fit", lambda records, **kw: fits.append((records.count(), kw)) or own(records, **kw))
    found = catalog.QUERIES[name](spark, folder).collect()
    readings = catalog.QUERIES["enriched_features"](spark, folder).count()
    assert fits == [(readings, training.QUICK)] and readings > 200
    assert found and all(r.tilt_on_grid for r in found)
    if name == "model_responses":
        assert all(r.has_power for r in found)
