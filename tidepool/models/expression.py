"""A fitted tree ensemble as one expression over its feature columns (PRD2, PRD3).

What ``transform`` computes row by row is written as nested conditions, so that a
model can be called inside SQL and on columns, in the JVM, without Python workers
and without a vector column.  Only the models' public interface is read: the trees'
printed structure (``toDebugString``), their weights, and, for a forest's leaves,
``predictProbability`` at a point that falls into the leaf.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column
from pyspark.sql import functions as F

_IF = re.compile(r"^(If|Else) \(feature (\d+) (<=|>|in|not in) (.+)\)$")


@dataclass
class Split:
    """A row goes left where its feature is at most ``threshold`` (missing: right); leaves are tuples of numbers."""

    feature: int
    threshold: float
    left: Split | tuple
    right: Split | tuple


def parse(text: str) -> Split | float:
    """The tree that ``toDebugString`` prints: splits, and predictions at the leaves."""
    lines = [line.strip() for line in text.splitlines()[1:] if line.strip()]
    at = 0

    def node() -> Split | float:
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict:"):
            return float(line.removeprefix("Predict:"))
        kind, feature, test, value = _IF.match(line).groups()
        if kind != "If" or test != "<=":
            raise NotImplementedError(f"a split that is no threshold: {line}")
        left = node()
        at += 1  # the Else line
        return Split(int(feature), float(value), left, node())

    return node()


def _at_leaves(tree: Split | float, n_features: int, value, low=None, high=None) -> Split | tuple:
    """``tree`` with ``value(a point of the leaf, prediction)`` at its leaves."""
    low = np.full(n_features, -math.inf) if low is None else low
    high = np.full(n_features, math.inf) if high is None else high
    if not isinstance(tree, Split):
        point = np.where(np.isfinite(high), high, np.where(np.isfinite(low), np.nextafter(low, math.inf), 0.0))
        return value(point, tree)
    inner_high, inner_low = high.copy(), low.copy()
    inner_high[tree.feature] = min(high[tree.feature], tree.threshold)
    inner_low[tree.feature] = max(low[tree.feature], tree.threshold)
    return Split(tree.feature, tree.threshold, _at_leaves(tree.left, n_features, value, low, inner_high), _at_leaves(tree.right, n_features, value, inner_low, high))


@dataclass
class Ensemble:
    """Trees whose leaves hold what is summed, and the kind of the sum's reading."""

    kind: str  # "forest": probabilities of the classes; "boosted": weighted margin
    features: int
    trees: list

    def sql(self, columns: list[str]) -> str:
        """The class as a SQL expression over double columns (or parameters) of these names."""
        if len(columns) != self.features:
            raise ValueError(f"the model has {self.features} features, {len(columns)} columns are given")

        def walk(node: Split | tuple, k: int) -> str:
            if not isinstance(node, Split):
                return f"{node[k]!r}D"
            return f"CASE WHEN {columns[node.feature]} <= {node.threshold!r}D THEN {walk(node.left, k)} ELSE {walk(node.right, k)} END"

        def total(k: int) -> str:
            return f"aggregate(array({', '.join(walk(t, k) for t in self.trees)}), 0D, (held, x) -> held + x)"

        if self.kind == "boosted":
            return f"CASE WHEN {total(0)} > 0 THEN 1D ELSE 0D END"
        classes = len(_leaf(self.trees[0]))
        scores = f"array({', '.join(total(k) for k in range(classes))})"
        return f"CAST(array_position({scores}, array_max({scores})) - 1 AS DOUBLE)" if classes != 2 else f"CASE WHEN {total(1)} > {total(0)} THEN 1D ELSE 0D END"


def _leaf(node: Split | tuple) -> tuple:
    return node if not isinstance(node, Split) else _leaf(node.left)


def ensemble(model: PipelineModel) -> Ensemble:
    """The last stage of a fitted pipeline: a random forest or boosted trees."""
    stage = model.stages[-1]
    n, name = stage.numFeatures, type(stage).__name__
    if name == "GBTClassificationModel":
        trees = [_at_leaves(parse(t.toDebugString), n, lambda _, predicted, w=w: (w * predicted,)) for t, w in zip(stage.trees, stage.treeWeights)]
        return Ensemble("boosted", n, trees)
    if name != "RandomForestClassificationModel":
        raise TypeError(f"no expression for {name}")

    def shares(tree):
        return lambda point, _: tuple(float(p) for p in tree.predictProbability(Vectors.dense(point)))

    return Ensemble("forest", n, [_at_leaves(parse(t.toDebugString), n, shares(t)) for t in stage.trees])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def class_of(found: Ensemble, columns: list[str]) -> Column:
    """The predicted class as a column, from numeric columns of any type."""
    return F.expr(found.sql([f"CAST({quoted(c)} AS DOUBLE)" for c in columns]))
