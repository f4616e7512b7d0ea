"""The tree of boxes: exact neighbours, and candidates that grow slower than the rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepool.operators import neighbours


def frame(spark, ids, vecs, groups=None):
    return spark.createDataFrame([(g, int(i), [float(x) for x in v]) for g, i, v in zip(groups or [None] * len(ids), ids, vecs)], "g string, id long, v array<double>")


def brute(ids, vecs, groups, k):
    out = {}
    for i, v, g in zip(ids, vecs, groups):
        d = [(float(np.sqrt(((w - v) ** 2).sum())), j) for j, w, h in zip(ids, vecs, groups) if h == g and j != i]
        out[g, i] = [j for _, j in sorted(d)[:k]]
    return out


def found(df, **how):
    out = {}
    for r in neighbours.knn(df, "id", "v", group_cols=["g"], **how).collect():
        out.setdefault((r.g, r.id), []).append((r.nbr_rank, r.nbr_id))
    return {key: [n for _, n in sorted(v)] for key, v in out.items()}


@pytest.mark.parametrize("leaf_rows", [4, 16, 1000])
def test_exact_on_grids_copies_and_clusters(spark, leaf_rows):
    """Integer grids have ties everywhere; copies, one far point, groups of one to many rows, a null group."""
    rng = np.random.default_rng(1)
    vecs = np.vstack([rng.integers(0, 6, (150, 3)), np.zeros((40, 3)), rng.normal(size=(60, 3)) * [1, 100, 0.01], [[1e6, 0, 0]], rng.integers(0, 2, (30, 3))])
    groups = ["a"] * 120 + [None] * 130 + ["b"] * 3 + ["c"] + ["d"] * (len(vecs) - 254)
    ids = rng.permutation(len(vecs))
    assert found(frame(spark, ids, vecs, groups), k=4, leaf_rows=leaf_rows) == {k: v for k, v in brute(ids, vecs, groups, 4).items() if v}


def test_one_value_has_most_points_of_a_side(spark):
    """Quantiles that fall on one value don't cut: the middle does."""
    rng = np.random.default_rng(2)
    vecs = np.column_stack([np.where(rng.random(300) < 0.97, 5.0, rng.random(300) * 1000), rng.random(300)])
    ids = list(range(300))
    assert found(frame(spark, ids, vecs), k=3, leaf_rows=8) == brute(ids, vecs, [None] * 300, 3)


def test_a_third_of_all_rows_is_one_vector(spark):
    ids, vecs = list(range(900)), np.vstack([np.ones((300, 2)), np.random.default_rng(3).normal(size=(600, 2))])
    got = found(frame(spark, ids, vecs), k=5, leaf_rows=64)
    assert got == brute(ids, vecs, [None] * 900, 5)


def test_no_rows(spark):
    assert neighbours.knn(frame(spark, [], []), "id", "v", group_cols=["g"]).count() == 0


def test_candidates_grow_slower_than_the_rows(spark):
    """Leaves that a point looks into, at 1,500 and 12,000 rows and the same leaf size: nearly as many, so candidates per row are sublinear."""
    visited = []
    for n in (1_500, 12_000):
        points = spark.range(n).select(F.lit("").alias("_g"), F.array(F.rand(1), F.rand(2), F.rand(3)).alias("_v"), F.array("id").alias("_ids"))
        leaves, levels = neighbours.build_tree(points.checkpoint(), 64)
        # A point's sixth neighbour is about so far away in a unit cube of n points.
        bounds = leaves.select("_g", "_v", F.lit((6 / n / 4.19) ** (1 / 3)).alias("_bound"))
        visited.append(neighbours.visits(leaves, levels, bounds).count() / n)
        assert max(c.agg(F.max(F.when(F.col("_leaf"), F.col("_n")))).first()[0] or 0 for c in levels) <= 64
    assert visited[1] < 2 * visited[0] and visited[1] < 12_000 / 64 / 8


def test_candidates_of_many_dimensions_are_few_and_hold_the_nearest():
    """One product picks what is measured: a small share of all pairs, whatever the offset, with the exact distances of a sequential sum."""
    rng = np.random.default_rng(4)
    for offset, scale in ((0.0, 1.0), (1e6, 1e-3), (0.0, 1e160)):
        points = offset + scale * rng.normal(size=(800, 64))
        points[400:420] = points[:20]  # ties
        lists = [[i, 10_000 + i] if i % 3 else [i] for i in range(800)]
        got = neighbours._best(pd.DataFrame({"_g": "", "_v": list(points)}), pd.DataFrame({"_v": list(points), "_ids": lists}), 6)
        with np.errstate(over="ignore"):
            exact = neighbours.distances(points, points)
        for i in range(800):
            best = sorted((exact[i, j], n) for j in range(800) for n in lists[j])[:6]
            assert (got["_dist"][i], got["_near"][i]) == ([d for d, _ in best], [n for _, n in best])
        if scale < 1e100:
            assert neighbours._candidates(points, points, 6).mean() < 0.02


def test_leaves_of_many_dimensions_are_larger(spark, monkeypatch):
    """Without a stated size, vectors of more dimensions than boxes can tell apart lie in fewer leaves."""
    sizes = []
    build = neighbours.build_tree
    monkeypatch.setattr(neighbours, "build_tree", lambda points, leaf_rows: sizes.append(leaf_rows) or build(points, leaf_rows))
    rng = np.random.default_rng(5)
    for dims in (3, 32):
        vecs = rng.normal(size=(60, dims))
        assert found(frame(spark, range(60), vecs), k=3) == brute(range(60), vecs, [None] * 60, 3)
    assert sizes == [neighbours.LEAF_ROWS, neighbours.WIDE_LEAF_ROWS] and sizes[0] < sizes[1]


def test_points_that_leave_for_no_other_leaf_are_not_carried_down(spark, monkeypatch):
    """Lines far apart, of close points: only those near a cut look into another leaf, and only they are stored on the way."""
    carried = []
    stored = neighbours.stored

    def counted(df, name="stage"):
        out = stored(df, name)
        if name == "visits":
            carried.append(out.count())
        return out

    monkeypatch.setattr(neighbours, "stored", counted)
    rng = np.random.default_rng(6)
    vecs = np.column_stack([rng.random(1500) * 100, rng.integers(0, 3, 1500) * 50.0])
    ids = list(range(1500))
    assert found(frame(spark, ids, vecs), k=3, leaf_rows=100) == brute(ids, vecs, [None] * 1500, 3)
    assert carried and sum(carried) < 1500 / 4
