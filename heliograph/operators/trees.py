"""Boosted trees as column expressions and as SQL text.

A fitted model is read once, on the driver. Its trees become nested conditions, which Spark compiles together with the rest
of a query: no vectors, no model walk per row. Where features are known in advance, trees shrink to what is left of them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column
from pyspark.sql import functions as F

# A leaf is its value; a split is (feature, threshold, tree up to the threshold, tree beyond it).
Tree = float | tuple[int, float, "Tree", "Tree"]

_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)")


@dataclass(frozen=True)
class Ensemble:
    """Trees and their weights; a prediction is the weighted sum, in order."""

    trees: Sequence[Tree]
    weights: Sequence[float]


def of(model: PipelineModel) -> Ensemble:
    """The trees of a fitted regressor with continuous features, the last stage of `model`.

    Where a stage before bins the features, the trees' thresholds are put back to those of the features themselves.
    """
    fitted = model.stages[-1]
    trees = []
    for text in fitted.toDebugString.split("\n  Tree ")[1:]:
        # Every line is a condition, its "Else", or a leaf; the order alone tells the tree.
        lines = (line.strip() for line in text.splitlines()[1:])
        trees.append(_parsed(line for line in lines if line and not line.startswith("Else")))
    for stage in model.stages[:-1]:
        if isinstance(stage, Bucketizer):
            splits = stage.getSplitsArray()
            trees = [_unbinned(tree, splits) for tree in trees]
    return Ensemble(trees, list(fitted.treeWeights))


def _unbinned(tree: Tree, splits: Sequence[Sequence[float]]) -> Tree:
    if not isinstance(tree, tuple):
        return tree
    feature, threshold, low, high = tree
    # Values of the bins up to the threshold lie below the start of the next bin.
    below = math.nextafter(splits[feature][math.floor(threshold) + 1], -math.inf)
    return feature, below, _unbinned(low, splits), _unbinned(high, splits)


def _parsed(lines) -> Tree:
    line = next(lines)
    if line.startswith("Predict: "):
        return float(line.removeprefix("Predict: "))
    found = _SPLIT.fullmatch(line)
    if not found:
        raise ValueError(f"not a split of a continuous feature: {line}")
    return int(found[1]), float(found[2]), _parsed(lines), _parsed(lines)


def given(tree: Tree, known: Mapping[int, float]) -> Tree:
    """What is left of a tree whose features `known` have these values."""
    if not isinstance(tree, tuple):
        return tree
    feature, threshold, low, high = tree
    if feature in known:
        return given(low if known[feature] <= threshold else high, known)
    low, high = given(low, known), given(high, known)
    return low if low == high else (feature, threshold, low, high)


def value(tree: Tree, features: Sequence[Column]) -> Column:
    """A tree as a column. Like the model, it takes a NaN to lie beyond every threshold."""
    if not isinstance(tree, tuple):
        return F.lit(tree)
    feature, threshold, low, high = tree
    return F.when(features[feature] <= F.lit(threshold), value(low, features)).otherwise(value(high, features))


def total(parts: Sequence[Column], weights: Sequence[float]) -> Column:
    """The weighted sum of the trees' values."""
    return reduce(lambda a, b: a + b, [part * F.lit(weight) for part, weight in zip(parts, weights, strict=True)])


def prediction(ensemble: Ensemble, features: Sequence[Column]) -> Column:
    """The model's prediction as a column."""
    return total([value(tree, features) for tree in ensemble.trees], ensemble.weights)


def sql(ensemble: Ensemble, features: Sequence[str]) -> str:
    """The model's prediction as an SQL expression over the given expressions, none of which may be NaN."""

    def written(tree: Tree) -> str:
        if not isinstance(tree, tuple):
            return f"({tree!r})::DOUBLE"
        feature, threshold, low, high = tree
        return f"CASE WHEN {features[feature]} <= {threshold!r}::DOUBLE THEN {written(low)} ELSE {written(high)} END"

    return " + ".join(
        f"({written(tree)}) * {weight!r}::DOUBLE" for tree, weight in zip(ensemble.trees, ensemble.weights, strict=True)
    )


def steps(feature: int, edges: Sequence[float], parts: Sequence[Tree]) -> Tree:
    """A balanced tree that goes to `parts[k]` between the edges k - 1 and k of a feature."""
    if len(parts) == 1:
        return parts[0]
    half = len(parts) // 2
    low, high = steps(feature, edges[: half - 1], parts[:half]), steps(feature, edges[half:], parts[half:])
    return feature, edges[half - 1], low, high
