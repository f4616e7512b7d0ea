"""Exact k nearest neighbours within groups by a tree of boxes (SMP2).

No cross join, no list of all pairs, and nothing that grows with the rows on the
driver or in one task:

1. equal vectors become one point with its ``k + 1`` smallest ids, which is all
   that can be a neighbour of anything, so a group of copies is one point;
2. the points are cut into cells, level by level: a cell of more than
   ``leaf_rows`` points is cut at quantiles of its longest side into up to
   ``FAN`` cells, until none is larger.  Cells, with their boxes, are a table;
3. each leaf finds the neighbours of its points among themselves, which bounds
   how far a point has to look: no farther than its ``k + 1``-th neighbour there, or
   (in a leaf of few) than the far corner of the cell above;
4. at every level points leave the way to their own leaf for each other cell whose
   box is within that bound, and go on down from there: the only leaves that can
   hold a nearer one.  Most points leave for none and are not carried along;
5. each (leaf, block of visitors) finds candidates by one matrix product, measures
   these exactly and keeps the best of each visitor, merged with those of its own leaf.

The number of leaves that a point visits depends on how the points lie, not on how
many there are (for a few dimensions): candidates per point grow far slower
than the rows.  Ties on distance are broken by neighbour id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.session import stored

#: Cells that one cell is cut into at most (a power of two).
FAN = 16
#: Levels after which cells that still hold more points are searched as they are, in blocks.
MAX_LEVELS = 48
#: Points of a leaf.  Boxes of many dimensions exclude next to nothing: a point visits most leaves, so these are few and large.
LEAF_ROWS, WIDE_LEAF_ROWS, FEW_DIMS = 2_048, 8_192, 16
#: Distances that a task holds at once.
BLOCK_CELLS = 1 << 21
_SLACK = 1 + 1e-9  # on bounds, against rounding
_POINT = ["_g", "_v"]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairwise Euclidean distances, summing squared differences dimension by
    dimension in order (the same arithmetic as a sequential SQL sum)."""
    acc = np.zeros((a.shape[0], b.shape[0]))
    for j in range(a.shape[1]):
        d = a[:, j][:, None] - b[:, j][None, :]
        acc += d * d
    return np.sqrt(acc)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.vstack([np.asarray(v, dtype=np.float64) for v in vectors])


def _gap(near: bool, dims: int | None = None) -> Column:
    """Distance from ``_v`` to the nearest or farthest point of the box ``_lo``, ``_hi``; of ``dims`` known and few as one compiled expression."""
    def squared(v: Column, side: Column) -> Column:
        d = (F.greatest(side["lo"] - v, v - side["hi"], F.lit(0.0)) if near else F.greatest(F.abs(v - side["lo"]), F.abs(v - side["hi"])))
        return d * d

    if dims and dims <= FEW_DIMS:
        total = F.lit(0.0)
        for j in range(dims):
            v, lo, hi = (F.get(c, F.lit(j)) for c in ("_v", "_lo", "_hi"))
            total = total + squared(v, {"lo": lo, "hi": hi})
        return F.sqrt(total)
    sides = F.zip_with("_lo", "_hi", lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi")))
    return F.sqrt(F.aggregate(F.zip_with("_v", sides, squared), F.lit(0.0), lambda held, x: held + x))


def _cells(points: DataFrame, dims: int) -> DataFrame:
    """Number of points and box of every cell."""
    sides = [f(F.get("_v", F.lit(j))) for f in (F.min, F.max) for j in range(dims)]
    found = points.groupBy("_g", "_cell").agg(F.count(F.lit(1)).alias("_n"), *[s.alias(f"_s{i}") for i, s in enumerate(sides)])
    return found.select("_g", "_cell", "_n", F.array(*[f"_s{i}" for i in range(dims)]).alias("_lo"), F.array(*[f"_s{i}" for i in range(dims, 2 * dims)]).alias("_hi"))


def build_tree(points: DataFrame, leaf_rows: int) -> tuple[DataFrame, list[DataFrame]]:
    """(points with the leaf ``_cell``, cells per level: ``_g``, ``_cell``, ``_parent``, ``_n``, ``_lo``, ``_hi``, ``_leaf``).

    Cell names are paths ``/3/0/12``; every level's tables are stored, so a lost
    executor costs a part of one level.
    """
    dims = points.select(F.max(F.size("_v"))).first()[0] or 0
    inner, leaves, levels = points.withColumn("_cell", F.lit("")), None, []
    for _ in range(MAX_LEVELS):
        cells = _cells(inner, dims)
        parent = F.when(F.col("_cell") != "", F.regexp_replace("_cell", "/[0-9]+$", ""))
        cells = stored(cells.select("_g", "_cell", parent.alias("_parent"), "_n", "_lo", "_hi", (F.col("_n") <= leaf_rows).alias("_leaf")), "cells")
        levels.append(cells)
        large = cells.where(~F.col("_leaf"))
        done = inner.join(cells.where("_leaf").select("_g", "_cell"), ["_g", "_cell"]).select("_g", "_v", "_ids", "_cell")
        leaves = done if leaves is None else leaves.unionByName(done)
        if large.isEmpty():
            return stored(leaves, "leaves"), levels
        # The longest side of each large cell, and where it is cut.
        spread = F.zip_with("_hi", "_lo", lambda hi, lo: hi - lo)
        pieces = F.least(F.lit(FAN), F.pow(F.lit(2), F.ceil(F.log2(F.col("_n") / F.lit(leaf_rows))))).cast("int")
        large = large.withColumn("_axis", F.array_position(spread, F.array_max(spread)).cast("int")).withColumn("_step", (F.lit(FAN) / pieces).cast("int"))
        side = large.select("_g", "_cell", "_axis", "_step", F.element_at("_lo", F.col("_axis")).alias("_from"), F.element_at("_hi", F.col("_axis")).alias("_to"))
        rows = inner.join(side.select("_g", "_cell", "_axis"), ["_g", "_cell"]).withColumn("_x", F.element_at("_v", F.col("_axis")))
        cuts = rows.groupBy("_g", "_cell").agg(F.percentile_approx("_x", [i / FAN for i in range(1, FAN)], 2_000).alias("_q"))
        chosen = F.array_distinct(F.filter("_q", lambda x, i: ((i + 1) % F.col("_step") == 0) & (x < F.col("_to"))))
        middle = F.array((F.col("_from") + F.col("_to")) / 2)  # where one value has most of the points
        cuts = stored(cuts.join(side, ["_g", "_cell"]).select("_g", "_cell", "_axis", F.when(F.size(chosen) > 0, chosen).otherwise(middle).alias("_cuts")), "cuts")
        x = F.element_at("_v", F.col("_axis"))
        place = F.size(F.filter("_cuts", lambda c: c < x))
        inner = stored(inner.join(cuts, ["_g", "_cell"]).select("_g", "_v", "_ids", F.concat("_cell", F.lit("/"), place.cast("string")).alias("_cell")), "points")
    cells = _cells(inner, dims)
    levels.append(stored(cells.select("_g", "_cell", F.regexp_replace("_cell", "/[0-9]+$", "").alias("_parent"), "_n", "_lo", "_hi", F.lit(True).alias("_leaf")), "cells"))
    return stored(leaves.unionByName(inner.select("_g", "_v", "_ids", "_cell")), "leaves"), levels


def _best(visitors: pd.DataFrame, members: pd.DataFrame, m: int) -> pd.DataFrame:
    """For each visitor's vector its ``m`` nearest ids (distance, then id) among the members' ids."""
    lists = [np.asarray(i) for i in members["_ids"]]
    sizes = np.array([len(i) for i in lists])
    ids, starts = np.concatenate(lists), np.concatenate([[0], np.cumsum(sizes)[:-1]])
    place = np.empty(len(ids), dtype=np.int64)
    place[np.argsort(ids, kind="stable")] = np.arange(len(ids))  # ties by distance are in id order
    points, queries, near, dist = _matrix(members["_v"]), _matrix(visitors["_v"]), [], []
    step = max(1, BLOCK_CELLS // len(points))
    for s in range(0, len(queries), step):
        q = queries[s:s + step]
        row, col = np.nonzero(_candidates(q, points, m))
        d = np.zeros(len(row))
        for j in range(points.shape[1]):  # the arithmetic of ``distances``
            diff = q[row, j] - points[col, j]
            d += diff * diff
        d = np.sqrt(d)
        # A point stands for all of its ids.
        n = sizes[col]
        at = np.repeat(starts[col] - np.cumsum(n) + n, n) + np.arange(n.sum())
        row, d = np.repeat(row, n), np.repeat(d, n)
        order = np.lexsort((place[at], d, row))
        row, d, at = row[order], d[order], at[order]
        first = np.searchsorted(row, np.arange(len(q)))
        last = np.minimum(first + m, np.append(first[1:], len(row)))
        near += [ids[at[i:j]].tolist() for i, j in zip(first, last)]
        dist += [d[i:j].tolist() for i, j in zip(first, last)]
    return pd.DataFrame({"_g": visitors["_g"].to_numpy(), "_v": visitors["_v"].to_numpy(), "_near": near, "_dist": dist})


def _candidates(q: np.ndarray, points: np.ndarray, m: int) -> np.ndarray:
    """For each row of ``q`` a mask of the points that can be among its ``m`` nearest.

    Squared distances come from one matrix product; its rounding error is bounded,
    and what lies within the bound of the ``m``-th stays, to be measured exactly.
    """
    if len(points) <= m:
        return np.ones((len(q), len(points)), dtype=bool)
    with np.errstate(over="ignore", invalid="ignore"):
        centre = points.mean(axis=0)  # about it the numbers, and so the error, are small
        x, y = q - centre, points - centre
        a, b = (x * x).sum(axis=1), (y * y).sum(axis=1)
        error = 8 * (q.shape[1] + 8) * np.finfo(float).eps * (a + b.max()) + np.finfo(float).tiny
        if np.isfinite(error).all():
            near = x @ y.T
            near *= -2
            near += a[:, None]
            near += b
            found = near <= (np.partition(near, m - 1, axis=1)[:, m - 1] + 2 * error)[:, None]
            if np.count_nonzero(found) <= found.size // 8:
                return found
        exact = distances(q, points)  # the product can't tell these apart
    return ~(exact > np.partition(exact, m - 1, axis=1)[:, m - 1:m])


def knn(df: DataFrame, id_col: str, vec_col: str, k: int = 5, group_cols: list[str] | None = None, leaf_rows: int | None = None) -> DataFrame:
    """Exact k nearest neighbours of every row among the rows of its group.

    Returns (group..., id, nbr_rank, nbr_id, dist); a row is not its own
    neighbour.  Ids are unique in a group; vectors have one length and hold no
    null or NaN.  Rows of a group of k or fewer have as many neighbours as there are.
    """
    group_cols = group_cols or []
    id_type = df.schema[id_col].dataType.simpleString()
    group = F.to_json(F.struct(*group_cols), {"ignoreNullFields": "false"}) if group_cols else F.lit("")
    rows = stored(df.select(group.alias("_g"), *group_cols, F.col(id_col).alias("_id"), F.col(vec_col).cast("array<double>").alias("_v")), "knn-rows")
    if leaf_rows is None:
        first = rows.select(F.size("_v")).first()
        leaf_rows = LEAF_ROWS if first is None or first[0] <= FEW_DIMS else WIDE_LEAF_ROWS
    # 1. One point per different vector (-0.0 is 0.0), with its smallest ids: a top-k before the shuffle.
    rank = F.row_number().over(Window.partitionBy(*_POINT).orderBy("_id"))
    points = (rows.select("_g", "_v", "_id").withColumn("_r", rank).where(F.col("_r") <= k + 1)
              .groupBy(*_POINT).agg(F.sort_array(F.collect_list("_id")).alias("_ids")))
    leaves, levels = build_tree(stored(points, "knn-points"), leaf_rows)
    found = stored(_search(leaves, levels, k + 1, leaf_rows, id_type), "knn-found")
    # Back to rows: each drops itself from its vector's list.  A vector of very many copies is a hot key, which the skew join splits.
    near = rows.join(found, _POINT).withColumn("_others", F.slice(F.filter("_found", lambda x: x["id"] != F.col("_id")), 1, k))
    return near.select(*group_cols, F.col("_id").alias(id_col), F.posexplode("_others").alias("_pos", "_n")).select(
        *group_cols, id_col, (F.col("_pos") + 1).alias("nbr_rank"), F.col("_n.id").alias("nbr_id"), F.col("_n.dist").alias("dist"))


def visits(leaves: DataFrame, levels: list[DataFrame], bounds: DataFrame) -> DataFrame:
    """(``_g``, ``_v``, ``_cell``) of the leaves that each point must look into: boxes within its ``_bound``.

    Where ``bounds`` names the ``_home`` leaf of each point, that leaf is left out,
    and only points that leave the way to it are carried down.
    """
    dims = (levels[0].select(F.size("_lo")).first() or [None])[0]
    homes, frontier, out = "_home" in bounds.columns, None, None
    for level, cells in enumerate(levels):
        side = cells.select("_g", F.coalesce("_parent", F.lit("")).alias("_at"), "_cell", "_lo", "_hi", "_leaf")
        near = _gap(near=True, dims=dims) <= F.col("_bound") * _SLACK
        parts = [] if frontier is None else [frontier.join(side, ["_g", "_at"]).where(near)]
        if homes or frontier is None:
            # The way home: the cell above it at this level ("/3/0" is two levels down), and below that the next one.
            at, onward = (F.substring_index("_home", "/", n) if homes else F.lit("") for n in (max(level, 1), level + 1))
            leaving = bounds.select("_g", "_v", "_bound", at.alias("_at"), onward.alias("_onward")).join(side, ["_g", "_at"])
            parts.append(leaving.where((F.col("_cell") != F.col("_onward")) & near if homes else near))
        inside = None
        for part in parts:
            part = part.select("_g", "_v", "_bound", "_cell", "_leaf")
            inside = part if inside is None else inside.unionByName(part)
        if level + 1 < len(levels):
            inside = stored(inside, "visits")
            frontier = inside.where(~F.col("_leaf")).select("_g", "_v", "_bound", F.col("_cell").alias("_at"))
        reached = inside.where("_leaf").select("_g", "_v", "_cell")
        out = reached if out is None else out.unionByName(reached)
    return out


def _search(leaves: DataFrame, levels: list[DataFrame], m: int, leaf_rows: int, id_type: str) -> DataFrame:
    """The ``m`` nearest (distance, id) of every point's vector: ``_g``, ``_v``, ``_found`` (its own ids among them)."""
    schema = f"_g string, _v array<double>, _near array<{id_type}>, _dist array<double>"

    def own(members: pd.DataFrame) -> pd.DataFrame:
        return _best(members, members, m).assign(_cell=members["_cell"].to_numpy(), _block=members["_block"].to_numpy())

    # 3. In the own leaf (of at most ``leaf_rows`` points, or a block of an uncut one).
    block = F.pmod(F.xxhash64("_v"), F.ceil(F.col("_n") / leaf_rows)).cast("int")
    sizes = None
    for cells in levels:
        part = cells.where("_leaf").select("_g", "_cell", "_n")
        sizes = part if sizes is None else sizes.unionByName(part)
    members = stored(leaves.join(sizes, ["_g", "_cell"]).withColumn("_block", block), "members")
    here = stored(members.select("_g", "_v", "_ids", "_cell", "_block").groupBy("_g", "_cell", "_block").applyInPandas(own, f"{schema}, _cell string, _block int"), "own-leaf")
    # A bound for each point: its m-th there, or (of fewer) the far corner of the cell above its leaf, which has m points or more.
    above = None
    for upper in levels[:-1]:
        part = upper.select("_g", F.col("_cell").alias("_parent"), "_lo", "_hi")
        above = part if above is None else above.unionByName(part)
    found = here.select("_g", "_v", F.when(F.size("_dist") >= m, F.element_at("_dist", m)).alias("_bound"), F.col("_cell").alias("_home"), F.col("_block").alias("_home_block"))
    few, inf = found.where("_bound IS NULL"), F.lit(float("inf"))
    if above is not None:
        parent = F.when(F.col("_home") != "", F.regexp_replace("_home", "/[0-9]+$", ""))
        few = few.withColumn("_parent", parent).join(above, ["_g", "_parent"], "left").withColumn("_bound", _gap(near=False))
    bounds = found.where("_bound IS NOT NULL").unionByName(few.select("_g", "_v", F.coalesce("_bound", inf).alias("_bound"), "_home", "_home_block"))
    bounds = stored(bounds, "bounds")
    # 4. Other leaves, and other blocks of an uncut one.
    blocks = sizes.select("_g", "_cell", "_n", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("_n") / leaf_rows) - 1).cast("int"))).alias("_block"))
    beside = (bounds.select("_g", "_v", F.col("_home").alias("_cell"), "_home_block").join(blocks.where(F.col("_n") > leaf_rows), ["_g", "_cell"])
              .where("_block <> _home_block").select("_g", "_v", "_cell", "_block"))
    away = visits(leaves, levels, bounds).join(blocks, ["_g", "_cell"]).select("_g", "_v", "_cell", "_block").unionByName(beside)
    # 5. Visitors of a leaf in blocks of about ``leaf_rows``, each with a copy of the leaf.
    away = stored(away, "away")
    counts = away.groupBy("_g", "_cell", "_block").agg(F.ceil(F.count(F.lit(1)) / leaf_rows).cast("int").alias("_turns"))
    visitors = away.join(counts, ["_g", "_cell", "_block"]).withColumn("_turn", F.pmod(F.xxhash64("_v", F.lit(1)), F.col("_turns")).cast("int")).drop("_turns")
    hosts = members.join(counts.withColumnsRenamed({"_g": "_hg", "_cell": "_hc", "_block": "_hb"}),
                         (F.col("_g") == F.col("_hg")) & (F.col("_cell") == F.col("_hc")) & (F.col("_block") == F.col("_hb")))
    hosts = hosts.select(F.col("_g").alias("_hg"), F.col("_cell").alias("_hc"), F.col("_block").alias("_hb"), F.explode(F.sequence(F.lit(0), F.col("_turns") - 1)).alias("_ht"),
                         F.col("_v").alias("_hv"), F.col("_ids").alias("_hids"))

    def visit(guests: pd.DataFrame, host: pd.DataFrame) -> pd.DataFrame:
        if not len(guests) or not len(host):
            return pd.DataFrame({c: pd.Series([], dtype=object) for c in ("_g", "_v", "_near", "_dist")})
        return _best(guests[["_g", "_v"]].reset_index(drop=True), host.rename(columns={"_hv": "_v", "_hids": "_ids"}), m)

    there = visitors.groupBy("_g", "_cell", "_block", "_turn").cogroup(hosts.groupBy("_hg", "_hc", "_hb", "_ht")).applyInPandas(visit, schema)
    own_best = F.arrays_zip(F.col("_dist").alias("dist"), F.col("_near").alias("id"))
    more = there.groupBy(*_POINT).agg(F.flatten(F.collect_list(own_best)).alias("_more"))  # m of each leaf visited
    both = F.when(F.col("_more").isNull(), own_best).otherwise(F.concat(own_best, "_more"))
    return here.join(more, _POINT, "left").select("_g", "_v", F.slice(F.sort_array(both), 1, m).alias("_found"))
