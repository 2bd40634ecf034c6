"""Embedding whitening against plain arithmetic."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from heliograph.llm import whitening

FIELDS = "vec_id bigint, embedding array<float>, n string, component int"


def _frame(spark, vectors):
    return spark.createDataFrame([(i, v, "x", 7) for i, v in enumerate(vectors)], FIELDS)


def _brute(vectors, components=16):
    """Rows by id: deviation and projections, from exact fractions' worth of whole numbers."""
    good = {
        i: tuple(math.floor(64 * np.float64(np.float32(c))) + 1_000_000 for c in v)
        for i, v in enumerate(vectors)
        if v and all(c is not None and math.isfinite(c) for c in v)
    }
    fit = sorted(set(good.values()))
    n, x = len(fit), np.array(fit, dtype=object)
    sums = x.sum(axis=0)
    centred = np.array([[n * a - s for a, s in zip(row, sums)] for row in fit], dtype=object)
    v = (centred.T.dot(centred)).astype(float) / n**3
    values, columns = np.linalg.eigh(v)
    values, columns = values[::-1][:components], columns[:, ::-1][:, :components]
    deviation = {i: sum(int(n * a - s) ** 2 for a, s in zip(row, sums)) for i, row in good.items()}
    white = {i: (np.array(row, float) - sums.astype(float) / n) @ columns / np.sqrt(values) for i, row in good.items()}
    return n, deviation, white, values / np.trace(v)


def test_equals_plain_arithmetic(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(300, 20)) * np.linspace(0.2, 3, 20)).tolist()
    vectors += [vectors[0]] * 200 + [None, [], [None] * 20, [float("nan")] * 20, [1.0] * 19 + [float("inf")], [1.0, 2.0]]
    n, deviation, white, explained = _brute(vectors[:-1])
    rows = whitening.whiten(_frame(spark, vectors)).collect()
    assert len(rows) == 16 * len(deviation)
    found = defaultdict(dict)
    for r in rows:
        found[r["vec_id"]][r["component"]] = r
    signs = np.sign([found[1][c]["whitened"] * white[1][c - 1] for c in range(1, 17)])
    for i, own in found.items():
        assert {r["n"] for r in own.values()} == {n} and {int(r["deviation"]) for r in own.values()} == {deviation[i]}
        assert np.allclose([own[c]["whitened"] for c in range(1, 17)], signs * white[i], rtol=0, atol=1e-8)
        assert np.allclose([own[c]["explained"] for c in range(1, 17)], explained, rtol=1e-9)
    assert {r["identity_error"] for r in rows} == {rows[0]["identity_error"]} and 0 <= rows[0]["identity_error"] < 1e-9


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_scatter_is_exact(data):
    width = data.draw(st.integers(1, 5))
    entry = st.one_of(st.integers(-70, 70), st.integers(-(2**52), 2**52), st.just(0))
    rows = data.draw(st.lists(st.lists(entry, min_size=width, max_size=width), min_size=1, max_size=140))
    sums, cross = whitening.scatter(np.array(rows, np.int64))
    exact = np.array(rows, dtype=object)
    assert sums.tolist() == exact.sum(axis=0).tolist()
    assert cross.tolist() == exact.T.dot(exact).tolist()


@pytest.mark.parametrize("vectors", [[], [None, []], [[float("nan")]]])
def test_nothing_remains(spark, vectors):
    assert whitening.whiten(_frame(spark, vectors)).collect() == []


def test_directions_without_spread(spark):
    rows = whitening.whiten(_frame(spark, [[1.0, 2.0, 3.0]] * 5)).collect()
    assert len(rows) == 15 and {r["n"] for r in rows} == {1} and {int(r["deviation"]) for r in rows} == {0}
    assert all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None for r in rows)
    flat = whitening.whiten(_frame(spark, [[float(i), 0.0, -float(i)] for i in range(9)])).collect()
    assert {r["component"] for r in flat if r["whitened"] is not None} == {1}
    assert max(r["explained"] for r in flat) == pytest.approx(1) and flat[0]["identity_error"] < 1e-9


def test_large_entries_and_other_types(spark):
    vectors = [[1e30, -1e30, 1.0], [1e9, 2.0, 3.0], [-1e9, 5.0, 1e12], [0.5, 0.25, 0.125]]
    frame = spark.createDataFrame([(None, v) for v in vectors], "vec_id bigint, embedding array<double>")
    rows = whitening.whiten(frame).collect()
    assert len(rows) == 12 and all(r["vec_id"] is None and r["n"] == 4 for r in rows)
    whole = spark.createDataFrame([("a", [1, 2]), ("b", [3, 5])], "vec_id string, embedding array<int>")
    assert {(r["vec_id"], r["component"]) for r in whitening.whiten(whole).collect()} == {(x, c) for x in "ab" for c in (1, 2)}


def test_query_equals_plain_arithmetic(spark, tmp_path):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(400, 64)).tolist()
    _frame(spark, vectors).write.parquet(str(tmp_path / "embeddings.parquet"))
    n, deviation, _, _ = _brute(vectors)
    rows = whitening.op11_embedding_whitening(spark, str(tmp_path)).collect()
    assert {r["vec_id"]: r["deviation"] for r in rows} == deviation and {r["n"] for r in rows} == {n}
    white = np.zeros((400, 16))
    for r in rows:
        white[r["vec_id"], r["component"] - 1] = r["whitened"]
    assert np.abs(white.T @ white / n - np.eye(16)).max() < 1e-9
