"""Leaf-wise boosting: splits by brute force, the same model for every layout, quality, and the expression against the arrays."""

import heapq
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.models import expression, leafwise, train
from tidepool.operators import evaluate
from tidepool.plans import REGISTRY, modelling

P = dict(leafwise.PARAMS, min_child_samples=3, num_leaves=6, max_depth=3)


def rows_of(n=300, seed=4):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 1)
    x[rng.random(n) < 0.1, 1] = np.nan
    x[:, 2] = rng.integers(0, 3, n)  # few values, many ties
    y = ((x[:, 0] + np.nan_to_num(x[:, 1], nan=2.0) * x[:, 2] + rng.normal(scale=0.3, size=n)) > 0.5).astype(int)
    return x, y


def frame(spark, x, y):
    return spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y)], "a double, b double, c double, y int")


def brute_tree(x, y, margin, p):
    """Best leaf first, every cut of every feature tried on the rows themselves."""
    prob = 1 / (1 + np.exp(-margin))
    g, h = np.rint((prob - y) * leafwise.UNIT) / leafwise.UNIT, np.rint(prob * (1 - prob) * leafwise.UNIT) / leafwise.UNIT

    def value(rows):
        return float(np.clip(-g[rows].sum() / h[rows].sum(), -p["max_delta_step"], p["max_delta_step"]))

    def gain(rows):
        w = value(rows)
        return -(2 * g[rows].sum() * w + h[rows].sum() * w * w)

    def best(rows, depth):
        found = (-math.inf,)
        if depth == p["max_depth"]:
            return found
        for j in range(x.shape[1]):
            v = x[rows, j]
            distinct = np.unique(v[~np.isnan(v)])
            cuts = [(a + b) / 2 for a, b in zip(distinct, distinct[1:])] + ([math.inf] if np.isnan(v).any() else [])
            for cut in cuts:
                left, right = rows[v <= cut], rows[~(v <= cut)]
                if min(len(left), len(right)) < p["min_child_samples"] or min(h[left].sum(), h[right].sum()) < p["min_sum_hessian"]:
                    continue
                got = gain(left) + gain(right) - gain(rows)
                if got > found[0] + 1e-9:
                    found = (got, left, right)
        return found

    heap, leaves, count = [], [], 0
    def push(rows, depth):
        nonlocal count
        found = best(rows, depth)
        heapq.heappush(heap, (-found[0], count, rows, depth, found))
        count += 1

    push(np.arange(len(y)), 0)
    splits = 0
    while heap and splits < p["num_leaves"] - 1 and -heap[0][0] > 0:
        _, _, rows, depth, found = heapq.heappop(heap)
        push(found[1], depth + 1)
        push(found[2], depth + 1)
        splits += 1
    out = np.zeros(len(y))
    for _, _, rows, _, _ in heap:
        out[rows] = value(rows) * p["learning_rate"]
    return out


def test_trees_by_brute_force(spark):
    x, y = rows_of()
    model = leafwise.fit(frame(spark, x, y), ["a", "b", "c"], "y", dict(P, n_estimators=4))
    margin = np.full(len(y), math.log(y.sum() / (len(y) - y.sum())))
    assert model.start == pytest.approx(margin[0]) and len(model.trees) == 4
    edges = leafwise.bin_edges(x, 255)
    bins = np.column_stack([np.where(np.isnan(x[:, j]), len(e) + 1, np.searchsorted(e, x[:, j], side="left")) for j, e in enumerate(edges)])
    for tree in model.trees:
        want = brute_tree(x, y, margin, P)
        got = np.asarray(tree.value)[tree.leaves(bins)]
        assert got == pytest.approx(want, abs=1e-6)
        margin = margin + got
    # The expression gives what the arrays give, for missing values too.
    scored = model.transform(frame(spark, x, y).withColumn("b", F.when(~F.isnan("b"), F.col("b"))))
    assert sorted(r.score for r in scored.collect()) == pytest.approx(sorted(1 / (1 + np.exp(-margin))), rel=1e-9)


def test_the_same_model_for_every_layout(spark):
    x, y = rows_of(500, 8)
    df = frame(spark, x, y)
    one, two = (leafwise.fit(df.repartition(n), ["a", "b", "c"], "y", dict(n_estimators=4)) for n in (4, 16))
    assert one == two and len(one.trees) == 4


def test_one_of_two_children_is_counted(spark, monkeypatch):
    """The other child's sums are the rest of the parent's: rows of both are never counted in one pass."""
    asked, count = [], leafwise._histograms

    def noted(*args):
        asked.append((args[-2], args[-1]))
        return count(*args)

    monkeypatch.setattr(leafwise, "_histograms", noted)
    x, y = rows_of(400, 5)
    leafwise.fit(frame(spark, x, y), ["a", "b", "c"], "y", dict(n_estimators=2, min_child_samples=5, num_leaves=12))
    pairs = [{grown.left[i], grown.right[i]} <= set(wanted) for grown, wanted in asked for i in range(len(grown.feature)) if grown.feature[i] >= 0]
    assert len(asked) > 4 and not any(pairs)


def test_the_query_fits_and_scores_every_round(spark, monkeypatch):
    """the reference's 100 rounds, none left out."""
    x, y = rows_of(60, 6)
    df = frame(spark, x, y).select(F.monotonically_increasing_id().alias("CustomerId"), "a", "b", "c", F.col("y").alias("Exited")).localCheckpoint()
    scored, load = [], leafwise.LeafwiseModel.load
    monkeypatch.setattr(modelling, "prepared", lambda spark, sf_dir: (df, df.where("a > 0"), None, ["a", "b", "c"]))
    monkeypatch.setattr(leafwise.LeafwiseModel, "load", lambda spark, path: scored.append(load(spark, path)) or scored[-1])
    rows = REGISTRY["train_leafwise"].fn(spark, "").collect()
    assert sorted(r.CustomerId for r in rows) == sorted(r.CustomerId for r in df.where("a > 0").collect()) and all(r.fits for r in rows)
    assert [len(m.trees) for m in scored] == [100] and all(len(t.feature) > 1 for t in scored[0].trees)


def test_a_tree_takes_a_pass_a_level(spark, monkeypatch):
    """Every leaf that can still be chosen is asked for at once, those behind leaves of unknown children too."""
    asked, count = [], leafwise._histograms
    monkeypatch.setattr(leafwise, "_histograms", lambda *args: asked.append(len(args[-1])) or count(*args))
    x, y = rows_of(600, 5)
    leafwise.fit(frame(spark, x, y), ["a", "b", "c"], "y", dict(n_estimators=2, min_child_samples=4, num_leaves=14, max_depth=5))
    assert len(asked) <= 2 * 5


def test_columns_of_any_name_are_scored(spark):
    x, y = rows_of(80, 7)
    df = frame(spark, x, y).select(F.col("a").alias("a b"), F.struct(F.col("b").alias("in")).alias("s"), F.col("c").alias("c.`d"), "y")
    model = leafwise.fit(df, ["a b", "s.in", "`c.``d`"], "y", dict(n_estimators=3, min_child_samples=3))
    want = leafwise.LeafwiseModel(["a", "b", "c"], model.start, model.trees).transform(frame(spark, x, y))
    assert {f for t in model.trees for f in t.feature} == {-1, 0, 1, 2}
    assert sorted(r.score for r in model.transform(df).collect()) == sorted(r.score for r in want.collect())


def test_rows_of_leaves_are_those_of_the_tree():
    tree = leafwise.Tree([0, -1, 1, -1, -1], [3, 0, 7, 0, 0], [0.0] * 5, [1, -1, 3, -1, -1], [2, -1, 4, -1, -1], [0.0] * 5)
    bins = np.random.default_rng(1).integers(0, 12, (200, 2)).astype(np.uint16)
    want = np.where(bins[:, 0] <= 3, 1, np.where(bins[:, 1] <= 7, 3, 4))
    for layout in (bins, np.asfortranarray(bins)):
        assert (tree.leaves(layout) == want).all()
    some = np.arange(0, 200, 3)
    assert sorted((int(r), leaf) for leaf, rows in tree.parts(bins, some) for r in rows) == [(int(r), int(want[r])) for r in some]


def test_saved_and_loaded(spark, tmp_dir):
    x, y = rows_of(200)
    model = leafwise.fit(frame(spark, x, y), ["a", "b", "c"], "y", dict(n_estimators=3))
    model.save(spark, f"{tmp_dir}/m")
    back = leafwise.LeafwiseModel.load(spark, f"{tmp_dir}/m")
    assert (back.features, back.start, [t.value for t in back.trees], [t.feature for t in back.trees]) == (model.features, model.start, [t.value for t in model.trees], [t.feature for t in model.trees])
    df = frame(spark, x, y)
    assert [r.score for r in back.transform(df).collect()] == [r.score for r in model.transform(df).collect()]


def test_not_worse_than_the_level_wise_booster(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1200, 3))
    y = ((x[:, 0] * x[:, 1] + 0.5 * x[:, 2] + rng.normal(scale=0.4, size=1200)) > 0).astype(int)
    fit, test = frame(spark, x[:800], y[:800]), frame(spark, x[800:], y[800:])
    model = leafwise.fit(fit, ["a", "b", "c"], "y", dict(n_estimators=30))
    gbt = train.train_gbt(fit, ["a", "b", "c"], "y", dict(maxIter=30, maxDepth=5))
    scores = {"leafwise": model.transform(test).select("y", "score")}
    scores["gbt"] = test.withColumn("p", expression.class_of(expression.ensemble(gbt), ["a", "b", "c"])).select("y", F.col("p").alias("score"))
    auc = {n: evaluate.roc_auc(s.withColumn("model", F.lit(n))).first()["roc_auc"] for n, s in scores.items()}
    assert auc["leafwise"] > 0.85 and auc["leafwise"] >= auc["gbt"]


def test_speculation_changes_nothing(spark):
    """Growth that asks for the children of one leaf a round gives the same trees."""
    x, y = rows_of(400, 9)
    df = frame(spark, x, y)
    params = dict(n_estimators=3, min_child_samples=5, num_leaves=12)
    want = leafwise.fit(df, ["a", "b", "c"], "y", params)
    order = leafwise._order
    leafwise._order = lambda nodes, p: (lambda made, expand: (made, expand[:1]))(*order(nodes, p))
    try:
        assert leafwise.fit(df, ["a", "b", "c"], "y", params) == want
    finally:
        leafwise._order = order


def test_limits_and_odd_inputs(spark):
    x, y = rows_of(120)
    df = frame(spark, x, y)
    stump = leafwise.fit(df, ["a"], "y", dict(n_estimators=2, num_leaves=2, min_child_samples=1))
    assert all(sum(f >= 0 for f in t.feature) == 1 for t in stump.trees)
    assert leafwise.fit(df, ["a"], "y", dict(n_estimators=3, min_child_samples=100)).trees == []
    one_class = leafwise.fit(df.withColumn("y", F.lit(1)), ["a"], "y")
    assert one_class.trees == [] and one_class.transform(df).where("prediction = 1").count() == 120
    assert leafwise.fit(df.limit(0), ["a"], "y").trees == []
    constant = leafwise.fit(df.withColumn("a", F.lit(1.0)), ["a"], "y", dict(n_estimators=2))
    assert constant.trees == []
    with pytest.raises(ValueError, match="0 or 1"):
        leafwise.fit(df.withColumn("y", F.lit(2)), ["a"], "y")
    capped = leafwise.fit(df, ["a", "b", "c"], "y", dict(n_estimators=1, max_delta_step=0.01, min_child_samples=2))
    assert max(abs(v) for v in capped.trees[0].value) <= 0.01 * 0.07 + 1e-12


def test_printed_tree_is_read():
    text = "DecisionTreeModel: depth=2, numNodes=5\n  If (feature 3 <= -1.5E-7)\n   Predict: 0.25\n  Else (feature 3 > -1.5E-7)\n   If (feature 0 <= 2.0)\n    Predict: -1.0\n   Else (feature 0 > 2.0)\n    Predict: 4.0\n"
    tree = expression.parse(text)
    assert (tree.feature, tree.threshold, tree.left) == (3, -1.5e-7, 0.25) and (tree.right.feature, tree.right.left, tree.right.right) == (0, -1.0, 4.0)
    with pytest.raises(NotImplementedError):
        expression.parse("x\n If (feature 0 in {0.0})\n  Predict: 0.0\n Else (feature 0 not in {0.0})\n  Predict: 1.0\n")
