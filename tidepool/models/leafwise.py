"""Histogram gradient boosting that grows its trees best leaf first (TRN3).

Features are binned once (at most ``max_bin`` bins; edges from a bounded sample,
see ``BIN_ROWS``) and rows are packed into blocks of small integers.  A tree needs
the sums of gradient, hessian and rows by (leaf, feature, bin): one distributed
aggregation over the blocks, of which only the histograms reach the driver
(leaves x features x bins, whatever the rows).

Best-first growth splits the leaf with the largest gain, and the next choice needs
the histograms of its two children.  A round therefore asks at once for the
children of every leaf that can still be chosen: with r splits left, those are
the r leaves of largest gain, as a leaf's rank only falls while others are split.
What is not chosen in the end is dropped, so the tree is the leaf-wise one, in as
many rounds as it is deep.

Gradients and hessians are summed as integers (2^20 to the unit): the sums, and so
the model, are the same for every partitioning of the input.

Losses and limits follow the usual leaf-wise booster: logistic loss, start at the
log-odds, leaf value -G / (H + lambda) cut to ``max_delta_step``, gains of the cut
values, ``min_child_samples`` and ``min_sum_hessian`` per leaf.  Missing values
(null, NaN) are in the last bin and go right.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.models.expression import quoted
from tidepool.session import stored

# The reference's configuration, and the defaults that it relies on.
PARAMS = {"learning_rate": 0.07, "max_delta_step": 2.0, "n_estimators": 100, "max_depth": 10,
          "num_leaves": 31, "min_child_samples": 20, "min_sum_hessian": 1e-3, "max_bin": 255, "reg_lambda": 0.0}

#: Rows whose values set the bin edges: those with the smallest hashes of their values (all, up to this number).
BIN_ROWS = 200_000
BLOCK_ROWS = 65_536
#: Trees whose sums are recomputed in every pass before the blocks are written with them.
TREES_PER_TABLE = 10
UNIT = float(1 << 20)
#: Partial histograms of so many partitions are added up on the driver; of more, by a shuffle before it (the same sums).
DIRECT_PARTITIONS = 16

_BLOCK = "n int, bins binary, y binary, margin binary"


@dataclass
class Tree:
    """Node arrays; ``feature`` is -1 at a leaf.  A row goes left where its bin is at most ``bin``, its value at most ``threshold``."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float = 0.0) -> int:
        for column, v in ((self.feature, -1), (self.bin, 0), (self.threshold, math.nan), (self.left, -1), (self.right, -1), (self.value, value)):
            column.append(v)
        return len(self.feature) - 1

    def parts(self, bins: np.ndarray, rows: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, its rows) of a matrix of bins, or of some ``rows`` of it, node by node; leaves without rows are left out."""
        waiting = [(0, np.arange(len(bins)) if rows is None else rows)]
        while waiting:
            node, rows = waiting.pop()
            if not len(rows):
                continue
            if self.feature[node] < 0:
                yield node, rows
                continue
            left = bins[:, self.feature[node]][rows] <= self.bin[node]
            waiting += [(self.right[node], rows[~left]), (self.left[node], rows[left])]

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """Leaf of each row of a matrix of bins."""
        node = np.zeros(len(bins), dtype=np.int64)
        for leaf, rows in self.parts(bins):
            node[rows] = leaf
        return node


def _in_sql(name: str) -> str:
    """What ``F.col(name)`` reads, in SQL: parts between dots quoted, those in backticks as they are."""
    return ".".join(part if part.startswith("`") else quoted(part) for part in re.findall(r"(?:`[^`]*`)+|[^.`]+", name))


@dataclass
class LeafwiseModel:
    """A fitted booster: probabilities and classes as columns."""

    features: list[str]
    start: float
    trees: list[Tree]

    def margin(self) -> Column:
        """Log-odds, as one expression over the feature columns (no Python in the plan), parsed at once: a call per node takes longer than to score."""
        names = [_in_sql(c) for c in self.features]

        def number(v: float) -> str:
            return f"{v!r}D" if math.isfinite(v) else f"CAST('{v!r}' AS DOUBLE)"

        def walk(tree: Tree, node: int) -> str:
            if tree.feature[node] < 0:
                return number(tree.value[node])
            x = f"CAST({names[tree.feature[node]]} AS DOUBLE)"
            return f"CASE WHEN {x} <= {number(tree.threshold[node])} THEN {walk(tree, tree.left[node])} ELSE {walk(tree, tree.right[node])} END"

        if not self.trees:
            return F.lit(self.start)
        return F.expr(f"aggregate(array({', '.join(walk(t, 0) for t in self.trees)}), {number(self.start)}, (held, v) -> held + v)")

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``score`` (probability of class 1) and ``prediction``."""
        margin = self.margin()
        return df.withColumn("score", 1 / (1 + F.exp(-margin))).withColumn("prediction", (F.col("score") > 0.5).cast("double"))


    def save(self, spark: SparkSession, path: str) -> None:
        """Write the model as a table: a row per node (a tree's leaves included), and the start in each."""
        rows = [(i, node, t.feature[node], t.bin[node], t.threshold[node], t.left[node], t.right[node], t.value[node]) for i, t in enumerate(self.trees) for node in range(len(t.feature))]
        head = [(-1, -1, -1, 0, self.start, -1, -1, float(len(self.trees)))]
        table = spark.createDataFrame(head + rows, "tree int, node int, feature int, bin int, threshold double, left int, right int, value double")
        table.withColumn("features", F.array(*[F.lit(c) for c in self.features]).cast("array<string>")).coalesce(1).write.mode("errorifexists").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LeafwiseModel:
        rows = sorted(spark.read.parquet(path).collect(), key=lambda r: (r.tree, r.node))  # nodes of the model, whatever it was fitted on
        trees = [Tree() for _ in range(int(rows[0].value))]
        for r in rows[1:]:
            for column in ("feature", "bin", "threshold", "left", "right", "value"):
                getattr(trees[r.tree], column).append(r[column])
        return cls(list(rows[0].features), rows[0].threshold, trees)


@dataclass
class _Node:
    """A node of the tree that is being grown, with what its histogram told."""

    sums: tuple[int, int, int]  # gradient, hessian, rows
    depth: int
    gain: float = -math.inf
    feature: int = -1
    bin: int = -1
    children: tuple[int, int] | None = None
    child_sums: tuple = ()
    histogram: np.ndarray | None = None  # until its children have theirs


def bin_edges(sample: np.ndarray, max_bin: int) -> list[np.ndarray]:
    """Upper edges of the bins of each feature; the bin behind them holds what is larger."""
    out = []
    for x in sample.T:
        x = x[~np.isnan(x)]
        distinct = np.unique(x)
        if len(distinct) <= max_bin:
            out.append((distinct[:-1] + distinct[1:]) / 2 if len(distinct) > 1 else distinct[:0])
        else:
            out.append(np.unique(np.quantile(x, np.linspace(0, 1, max_bin + 1)[1:-1], method="lower")))
    return out


def _binned(df: DataFrame, features: list[str], label: str, edges: list[np.ndarray], start: float) -> DataFrame:
    """Rows as blocks (bins feature by feature), with their margin so far."""
    missing = np.array([len(e) + 1 for e in edges])

    def block(x: np.ndarray, y: np.ndarray) -> tuple:
        bins = np.empty(x.T.shape, dtype=np.uint16)
        for j, e in enumerate(edges):
            bins[j] = np.where(np.isnan(x[:, j]), missing[j], np.searchsorted(e, x[:, j], side="left"))
        return len(y), bins.tobytes(), y.astype(np.uint8).tobytes(), np.full(len(y), start).tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(np.column_stack([b.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(b.num_columns)]))
            n += b.num_rows
            while n >= BLOCK_ROWS:
                rows = np.concatenate(held)
                yield _batch([block(rows[:BLOCK_ROWS, :-1], rows[:BLOCK_ROWS, -1])])
                held, n = [rows[BLOCK_ROWS:]], n - BLOCK_ROWS
        if n:
            rows = np.concatenate(held)
            yield _batch([block(rows[:, :-1], rows[:, -1])])

    return df.select(*[F.col(c).cast("double") for c in features], F.col(label).cast("double")).mapInArrow(pack, _BLOCK)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    n, bins, y, margin = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(n, pa.int32()), pa.array(bins, pa.binary()), pa.array(y, pa.binary()), pa.array(margin, pa.binary())], names=["n", "bins", "y", "margin"])


def _unpacked(batch: pa.RecordBatch, n_features: int):
    """(bins, y, margin as it is stored) of each block; a feature's bins lie together."""
    for n, bins, y, margin in zip(*(c.to_pylist() for c in batch.columns)):
        yield np.frombuffer(bins, np.uint16).reshape(n_features, n).T, np.frombuffer(y, np.uint8), np.frombuffer(margin, np.float64)


def _raised(margin: np.ndarray, bins: np.ndarray, trees: list[Tree], rows: np.ndarray | None = None) -> np.ndarray:
    """The margins with the values of ``trees`` added, at ``rows`` only if these are stated."""
    out = margin.copy()
    for t in trees:
        for leaf, part in t.parts(bins, rows):
            out[part] += t.value[leaf]
    return out


def _histograms(blocks: DataFrame, partitions: int, n_features: int, width: int, trees: list[Tree], grown: Tree, wanted: list[int]) -> np.ndarray:
    """Sums [node, feature, bin, (gradient, hessian, rows)] of the nodes ``wanted`` of ``grown``, over all rows."""
    slot = np.full(len(grown.feature), -1)
    slot[wanted] = np.arange(len(wanted))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(wanted), n_features, width, 3), dtype=np.int64)
        for batch in batches:
            for bins, y, margin in _unpacked(batch, n_features):
                found = [(slot[leaf], rows) for leaf, rows in grown.parts(bins) if slot[leaf] >= 0]
                if not found:
                    continue
                rows = np.concatenate([r for _, r in found])
                first_cell = np.repeat([s * width for s, _ in found], [len(r) for _, r in found])
                p = 1 / (1 + np.exp(-_raised(margin, bins, trees, rows)[rows]))
                # Whole numbers in doubles: exact below 2^53, as a block's sums are.
                weights = np.rint((p - y[rows]) * UNIT), np.rint(p * (1 - p) * UNIT), None
                for j in range(n_features):
                    index = first_cell + bins[:, j][rows]
                    for k, w in enumerate(weights):
                        total[:, j, :, k] += np.bincount(index, w, len(wanted) * width).astype(np.int64).reshape(len(wanted), width)
        some = np.argwhere(total[..., 2] > 0)
        cells = total[some[:, 0], some[:, 1], some[:, 2]]
        yield pa.RecordBatch.from_arrays([pa.array((some[:, 0] * n_features + some[:, 1]) * width + some[:, 2])] + [pa.array(cells[:, k]) for k in range(3)], names=["cell", "g", "h", "n"])

    parts = blocks.mapInArrow(sums, "cell bigint, g bigint, h bigint, n bigint")
    if partitions > DIRECT_PARTITIONS:
        parts = parts.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
    found = parts.toArrow()
    out = np.zeros((len(wanted) * n_features * width, 3), dtype=np.int64)
    if found.num_rows:
        cell = found["cell"].to_numpy()
        for k, c in enumerate(("g", "h", "n")):
            np.add.at(out[:, k], cell, found[c].to_numpy())
    return out.reshape(len(wanted), n_features, width, 3)


def leaf_value(g: np.ndarray, h: np.ndarray, p: dict) -> np.ndarray:
    """Best value of a leaf, cut to ``max_delta_step`` (0: not cut)."""
    value = -g / np.maximum(h + p["reg_lambda"], 1e-300)
    return np.clip(value, -p["max_delta_step"], p["max_delta_step"]) if p["max_delta_step"] > 0 else value


def leaf_gain(g: np.ndarray, h: np.ndarray, p: dict) -> np.ndarray:
    """What a leaf takes off the loss (twice): -(2 g w + (h + lambda) w^2) at its value w."""
    w = leaf_value(g, h, p)
    return -(2 * g * w + (h + p["reg_lambda"]) * w * w)


def best_split(histogram: np.ndarray, sums: tuple[int, int, int], p: dict) -> tuple:
    """(gain, feature, bin, left sums) of a node's histogram [feature, bin, 3]; the first of equal gains."""
    left = np.cumsum(histogram, axis=1)[:, :-1, :]
    right = np.asarray(sums) - left
    (gl, hl), (gr, hr) = ((s[..., 0] / UNIT, s[..., 1] / UNIT) for s in (left, right))
    allowed = (left[..., 2] >= p["min_child_samples"]) & (right[..., 2] >= p["min_child_samples"]) & (hl >= p["min_sum_hessian"]) & (hr >= p["min_sum_hessian"])
    if not allowed.any():
        return -math.inf, -1, -1, ()
    gain = leaf_gain(gl, hl, p) + leaf_gain(gr, hr, p) - leaf_gain(np.float64(sums[0] / UNIT), np.float64(sums[1] / UNIT), p)
    gain = np.where(allowed, gain, -math.inf)
    feature, cut = np.unravel_index(int(gain.argmax()), gain.shape)
    return float(gain[feature, cut]), int(feature), int(cut), tuple(int(v) for v in left[feature, cut])


def _order(nodes: list[_Node], p: dict) -> tuple[list[int], list[int]]:
    """Splits that best-first growth makes as far as the known nodes tell, and the leaves it can still choose (largest gain first).

    What the unknown children of a leaf will add only moves later splits back, so a
    leaf that is not among the next ``num_leaves`` - 1 of the known nodes is never chosen.
    """
    heap, made, expand = [(-nodes[0].gain, 0)], [], []
    while heap and len(made) + len(expand) < p["num_leaves"] - 1:
        gain, i = heapq.heappop(heap)
        if -gain <= 0:
            break
        if nodes[i].children is None:
            expand.append(i)
            continue
        made.append(i)
        for c in nodes[i].children:
            if nodes[c].gain > 0:
                heapq.heappush(heap, (-nodes[c].gain, c))
    return made, expand


def _grow(blocks: DataFrame, partitions: int, edges: list[np.ndarray], width: int, trees: list[Tree], p: dict) -> Tree:
    """One tree on the current margins."""
    speculative = Tree()  # every node whose histogram was asked for
    speculative.add()
    first = _histograms(blocks, partitions, len(edges), width, trees, speculative, [0])[0]
    sums = tuple(int(v) for v in first[0].sum(axis=0))
    nodes = [_Node(sums, 0)]

    def learn(i: int, histogram: np.ndarray) -> None:
        if nodes[i].depth < p["max_depth"]:
            nodes[i].histogram = histogram
            nodes[i].gain, nodes[i].feature, nodes[i].bin, nodes[i].child_sums = best_split(histogram, nodes[i].sums, p)

    learn(0, first)
    while True:
        made, expand = _order(nodes, p)
        if not expand:
            break
        counted = {}  # the child of fewer rows, of its parent; the other child has the rest of the parent's sums, exactly
        for i in expand:
            n, left = nodes[i], nodes[i].child_sums
            pair = []
            for s in (left, tuple(a - b for a, b in zip(n.sums, left))):
                pair.append(speculative.add())
                nodes.append(_Node(s, n.depth + 1))
            n.children = tuple(pair)
            speculative.feature[i], speculative.bin[i], speculative.left[i], speculative.right[i] = n.feature, n.bin, *pair
            if n.depth + 1 < p["max_depth"] and any(nodes[c].sums[2] >= 2 * p["min_child_samples"] for c in pair):
                counted[min(pair, key=lambda c: nodes[c].sums[2])] = i
        if counted:
            for w, histogram in zip(counted, _histograms(blocks, partitions, len(edges), width, trees, speculative, list(counted))):
                parent = nodes[counted[w]]
                for c in parent.children:
                    if nodes[c].sums[2] >= 2 * p["min_child_samples"]:
                        learn(c, histogram if c == w else parent.histogram - histogram)
        for i in expand:
            nodes[i].histogram = None
    chosen = set(made)
    out = Tree()

    def copy(i: int) -> int:
        n = nodes[i]
        value = float(leaf_value(np.float64(n.sums[0] / UNIT), np.float64(n.sums[1] / UNIT), p)) * p["learning_rate"] if n.sums[2] else 0.0
        at = out.add(value)
        if i in chosen:
            out.feature[at], out.bin[at], out.threshold[at] = n.feature, n.bin, _threshold(edges[n.feature], n.bin)
            out.left[at], out.right[at] = copy(n.children[0]), copy(n.children[1])
        return at

    copy(0)
    return out


def _threshold(edges: np.ndarray, cut: int) -> float:
    """Values up to this are in the bins up to ``cut``; behind the last edge only missing values are."""
    return float(edges[cut]) if cut < len(edges) else math.inf


def fit(df: DataFrame, features: list[str], label: str, params: dict | None = None) -> LeafwiseModel:
    """Fit on all rows of ``df``, whose ``label`` is 0 or 1.

    A frame without rows, or of one class only, gives a model of no trees.
    """
    p = dict(PARAMS, **(params or {}))
    values = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(f"x{i}") for i, c in enumerate(features)], F.col(label).cast("int").alias("y"))
    table = stored(values, "fit-rows")
    n, ones, bad = table.agg(F.count(F.lit(1)), F.sum("y"), F.count_if(F.col("y").isNull() | ~F.col("y").isin(0, 1))).first()
    if bad:
        raise ValueError("labels must be 0 or 1")
    if not n or ones in (0, n):
        share = (ones + 0.5) / (n + 1.0) if n else 0.5
        return LeafwiseModel(list(features), math.log(share / (1 - share)), [])
    start = math.log(ones / (n - ones))
    names = [f"x{i}" for i in range(len(features))]
    chosen = table.select(*names).orderBy(F.xxhash64(*names), *names).limit(BIN_ROWS)  # a bounded sample, the same for every layout
    edges = bin_edges(np.column_stack([c.to_numpy() for c in chosen.toArrow().columns]), p["max_bin"])
    width = max(len(e) for e in edges) + 2
    model, fresh = LeafwiseModel(list(features), start, []), []
    blocks = stored(_binned(table, names, "y", edges, start), "fit-blocks").persist(StorageLevel.MEMORY_AND_DISK)
    partitions = blocks.rdd.getNumPartitions()
    try:
        for _ in range(p["n_estimators"]):
            tree = _grow(blocks, partitions, edges, width, fresh, p)
            if len(tree.feature) == 1:
                break  # no split is worth it any more
            model.trees.append(tree)
            fresh.append(tree)
            if len(fresh) == TREES_PER_TABLE:
                after = stored(_with_trees(blocks, len(edges), fresh), "fit-blocks").persist(StorageLevel.MEMORY_AND_DISK)
                blocks.unpersist()
                blocks, fresh, partitions = after, [], after.rdd.getNumPartitions()
    finally:
        blocks.unpersist()
    return model


def _with_trees(blocks: DataFrame, n_features: int, trees: list[Tree]) -> DataFrame:
    """The blocks with the trees' values added to their margins."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(len(y), bins.T.tobytes(), y.tobytes(), _raised(margin, bins, trees).tobytes()) for bins, y, margin in _unpacked(batch, n_features)]
            if rows:
                yield _batch(rows)

    return blocks.mapInArrow(add, _BLOCK)
