"""Approximate nearest neighbours by inner product: an HNSW graph per shard, shard results merged.

Equal vectors are one node that lists its smallest ids (one more than a search
returns: no other copy can be among the nearest, since ties go to smaller ids).
Nodes are dealt to shards by a hash (``rows_of_shard``).  Each shard's graph
is built by one task, in batches that double up to ``BATCH``: a batch searches
the graph so far in lockstep, picks diverse neighbours, and the neighbours are
linked back and pruned.  Inner product becomes a metric through one more
coordinate that gives all nodes the same norm.  The index is a table: a row per
node with its vector, ids and a flat neighbour array per layer.

A search task holds one shard and streams a group of queries through it; the
candidates are scored in double precision on the original vectors, and each id
counts once, with its best.  A query for which the list holds fewer ids than
wanted is searched again with a longer one.  The merge is
a ranking per query over a bounded number of rows per shard.

Defined cases: vectors that are null, all zero, or hold a null, NaN or infinite
component take no part, nor do those of another length than the commonest
(ties: the longer); equal rows count once; other columns are not read; one id with several vectors has them
all as candidates, and all as queries (each result then is of the best of them);
a null id takes no part; no valid vectors give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm import common

#: Nodes of a shard: the larger the table the more, so that each query meets fewer shards, within what one task can hold.
LEAST_SHARD, MOST_SHARD = 8192, 131_072
#: Queries that are worth a copy of a shard of their own, at least.
QUERY_GROUP = 2_000
#: Neighbours of a node in the upper layers (twice as many in the lowest), and list lengths of building and searching.
LINKS = 16
EF_BUILD = 80
EF_SEARCH = 128
BATCH = 256
#: Nodes of a list expanded per step.
EXPAND = 4

NODE = "shard int, node int, vec array<double>, ids array<bigint>, layers array<array<int>>"


class Graph:
    """Vectors in order of falling level; layer ``l`` holds the first ``counts[l]`` nodes."""

    def __init__(self, vectors: np.ndarray, levels: np.ndarray | None = None, layers: list[np.ndarray] | None = None):
        self.vectors = vectors.astype(np.float64)
        norm = (self.vectors**2).sum(axis=1)
        lift = np.sqrt(np.maximum(norm.max(initial=0.0) - norm, 0.0))
        self.points = np.concatenate([self.vectors, lift[:, None]], axis=1).astype(np.float32)
        if layers is None:
            top = int(levels.max(initial=0))
            self.counts = [int((levels >= layer).sum()) for layer in range(top + 1)]
            self.layers = [np.full((n, LINKS * (2 if layer == 0 else 1)), -1, dtype=np.int32) for layer, n in enumerate(self.counts)]
            self._build()
        else:
            self.layers, self.counts = layers, [len(a) for a in layers]

    def _beam(self, queries: np.ndarray, entry: np.ndarray, layer: int, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``ef`` nearest nodes found from ``entry`` (a column of nodes) for each query, nearest first; -1 pads."""
        links, rows = self.layers[layer], len(queries)
        ids = np.full((rows, ef), -1, dtype=np.int64)
        near = np.full((rows, ef), -np.inf, dtype=np.float32)
        open_ = np.zeros((rows, ef), dtype=bool)
        seen = np.zeros((rows, self.counts[layer]), dtype=bool)
        line = np.arange(rows)
        for j in range(min(entry.shape[1], ef)):
            new = (entry[:, j] >= 0) & ~seen[line, entry[:, j]]
            ids[new, j] = entry[new, j]
            seen[line[new], entry[new, j]] = True
            near[new, j] = np.einsum("ad,ad->a", queries[new], self.points[entry[new, j]])
            open_[new, j] = True
        active = line
        while len(active):
            width = min(EXPAND, ef)
            value = np.where(open_[active], near[active], -np.inf)
            pick = np.argpartition(-value, width - 1, axis=1)[:, :width] if width < ef else np.tile(np.arange(ef), (len(active), 1))
            alive = np.isfinite(np.take_along_axis(value, pick, axis=1))
            more = alive.any(axis=1)
            active, pick, alive = active[more], pick[more], alive[more]
            if not len(active):
                break
            chosen = np.where(alive, np.take_along_axis(ids[active], pick, axis=1), -1)
            for j in range(width):
                open_[active[alive[:, j]], pick[alive[:, j], j]] = False
            found = np.full((len(active), width, links.shape[1]), -1, dtype=np.int64)
            for j in range(width):  # one after the other, so that a node is new once
                at = links[np.maximum(chosen[:, j], 0)]
                new = (at >= 0) & (chosen[:, j] >= 0)[:, None] & ~seen[active[:, None], np.maximum(at, 0)]
                r, c = np.nonzero(new)
                seen[active[r], at[r, c]] = True
                found[r, j, c] = at[r, c]
            found = found.reshape(len(active), -1)
            r, c = np.nonzero(found >= 0)
            value = np.full(found.shape, -np.inf, dtype=np.float32)
            value[r, c] = np.einsum("ad,ad->a", queries[active[r]], self.points[found[r, c]])
            all_ids = np.concatenate([ids[active], found], axis=1)
            all_near = np.concatenate([near[active], value], axis=1)
            all_open = np.concatenate([open_[active], found >= 0], axis=1)
            best = np.argpartition(-all_near, ef - 1, axis=1)[:, :ef]
            ids[active] = np.take_along_axis(all_ids, best, axis=1)
            near[active] = np.take_along_axis(all_near, best, axis=1)
            open_[active] = np.take_along_axis(all_open, best, axis=1)
        order = np.argsort(-near, axis=1, kind="stable")
        return np.take_along_axis(ids, order, axis=1), np.take_along_axis(near, order, axis=1)

    def _diverse(self, ids: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates (nearest first) those nearer to the row's node than to any chosen before; -1 pads."""
        points = self.points[np.maximum(ids, 0)]
        between = np.einsum("aid,ajd->aij", points, points, optimize=True)
        kept = np.zeros(ids.shape, dtype=bool)
        for j in range(ids.shape[1]):
            closer = (kept & (between[:, j, :] >= near[:, j, None])).any(axis=1)
            kept[:, j] = (ids[:, j] >= 0) & ~closer & (kept.sum(axis=1) < most)
        spare = (ids >= 0) & ~kept  # room left is filled with the nearest of the others
        fill = spare & (np.cumsum(spare, axis=1) <= (most - kept.sum(axis=1))[:, None])
        rank = np.argsort(~(kept | fill), axis=1, kind="stable")[:, :most]
        out = np.where(np.take_along_axis(kept | fill, rank, axis=1), np.take_along_axis(ids, rank, axis=1), -1)
        return np.pad(out, ((0, 0), (0, max(0, most - out.shape[1]))), constant_values=-1)

    def _link(self, layer: int, new: np.ndarray, ids: np.ndarray, near: np.ndarray) -> None:
        """Give the nodes ``new`` neighbours among ``ids``, and those their links back."""
        links = self.layers[layer]
        most = links.shape[1]
        chosen = self._diverse(ids, near, min(most, LINKS))
        links[new, : chosen.shape[1]] = chosen
        r, c = np.nonzero(chosen >= 0)
        source, target = new[r], chosen[r, c]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        for i in range(0, len(nodes), BATCH):
            part, width = nodes[i: i + BATCH], int(count[i: i + BATCH].max())
            added = np.full((len(part), width), -1, dtype=np.int64)
            for k in range(width):
                has = count[i: i + BATCH] > k
                added[has, k] = source[first[i: i + BATCH][has] + k]
            all_ids = np.concatenate([links[part].astype(np.int64), added], axis=1)
            value = np.einsum("ad,aid->ai", self.points[part], self.points[np.maximum(all_ids, 0)])
            value[all_ids < 0] = -np.inf
            order = np.argsort(-value, axis=1, kind="stable")
            all_ids, value = np.take_along_axis(all_ids, order, axis=1), np.take_along_axis(value, order, axis=1)
            full = (all_ids >= 0).sum(axis=1) > most
            links[part[~full]] = all_ids[~full][:, :most]
            if full.any():
                links[part[full]] = self._diverse(all_ids[full], value[full], most)

    def _descend(self, queries: np.ndarray, to: int) -> np.ndarray:
        """Entry nodes for layer ``to``: one, the nearest found greedily from the top."""
        entry = np.zeros((len(queries), 1), dtype=np.int64)
        for layer in range(len(self.layers) - 1, to, -1):
            entry = self._beam(queries, entry, layer, 1)[0]
        return entry

    def _build(self) -> None:
        n, done = len(self.points), 1
        while done < n:
            size = min(done, BATCH, n - done)
            new = np.arange(done, done + size)
            queries = self.points[new]
            found = []  # in all layers before any link to the new nodes leads a search to them
            for layer, count in enumerate(self.counts):
                here = new[new < count]
                if len(here):
                    asked = queries[: len(here)]
                    found.append((layer, here, *self._beam(asked, self._descend(asked, layer), layer, EF_BUILD)))
            for each in found:
                self._link(*each)
            done += size

    def search(self, queries: np.ndarray, ef: int = EF_SEARCH) -> np.ndarray:
        """Nodes found for each query (rows of the original dimension); -1 pads."""
        if len(self.points) <= ef:
            return np.tile(np.arange(len(self.points)), (len(queries), 1))
        lifted = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1).astype(np.float32)
        return self._beam(lifted, self._descend(lifted, 0), 0, ef)[0]


def valid(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id``, ``vec`` (array of doubles) of the different rows that take part."""
    rows = vectors.select(common.column(vectors, id_col).cast("bigint").alias("id"), common.column(vectors, vec_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull()).where(finite & F.exists("vec", lambda x: x != 0))
    length = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("vec") == (length["n"] if length else 0))


def rows_of_shard(nodes: int) -> int:
    """Nodes of a shard for a table of so many: 64 times the root, within bounds."""
    return min(MOST_SHARD, max(LEAST_SHARD, int(64 * nodes**0.5)))


def build_index(rows: DataFrame, k: int, shard_rows: int | None = None) -> DataFrame:
    """The stored index over ``valid`` rows for searches of ``k`` nearest: a row per node."""
    spark = rows.sparkSession
    common.prepare(spark)
    copies = Window.partitionBy("vec").orderBy("id")
    nodes = common.stored(common.gathered(
        rows.distinct().withColumn("nth", F.row_number().over(copies)).where(F.col("nth") <= k + 1)
        .groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")), rows.count()), "hnsw-nodes")
    n_nodes = nodes.count()
    n_shards = max(1, -(-n_nodes // (shard_rows or rows_of_shard(n_nodes))))
    dealt = nodes.select(F.pmod(F.xxhash64("vec"), F.lit(n_shards)).cast("int").alias("shard"), "vec", "ids")
    schema = pa.schema([("shard", pa.int32()), ("node", pa.int32()), ("vec", pa.list_(pa.float64())), ("ids", pa.list_(pa.int64())),
                        ("layers", pa.list_(pa.list_(pa.int32())))])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for shard, vectors, ids in _shards(batches):
                first = np.array([x[0] for x in ids])
                # Levels are drawn from the ids, so that the graph is the same in every run.
                draw = (_mixed(first) >> np.uint64(11)).astype(np.float64) / 2**53
                levels = np.floor(-np.log(np.maximum(draw, 1e-300)) / np.log(LINKS)).astype(int)
                order = np.lexsort((first, -levels))
                graph = Graph(vectors[order], levels[order])
                for node, at in enumerate(order.tolist()):
                    yield shard, node, vectors[at], ids[at], [a[node][a[node] >= 0] for a in graph.layers if node < len(a)]

        yield from common.batches(rows(), schema, 512)

    placed = dealt.repartitionByRange(n_shards, "shard").sortWithinPartitions("shard")
    return common.stored(placed.mapInArrow(build, NODE), "hnsw-index")


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each number."""
    with np.errstate(over="ignore"):
        x = (x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, list[list[int]]]]:
    """(shard, vectors, ids) of each shard in rows sorted by shard."""
    now, vectors, ids = None, [], []
    for batch in batches:
        for shard, vec, own in zip(batch["shard"].to_pylist(), batch["vec"].to_numpy(zero_copy_only=False), batch["ids"].to_pylist()):
            if shard != now and ids:
                yield now, np.stack(vectors), ids
                vectors, ids = [], []
            now = shard
            vectors.append(vec)
            ids.append(own)
    if ids:
        yield now, np.stack(vectors), ids


def nearest(index: DataFrame, queries: DataFrame, k: int, ef: int = EF_SEARCH) -> DataFrame:
    """The ``k`` nearest rows found for every query (``id``, ``vec``), without the query's own id."""
    n_shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    n_queries = queries.count()
    # A task streams its queries through one loaded shard.  Copies of a shard only fill the cores, however many the queries.
    cores = queries.sparkSession.sparkContext.defaultParallelism
    groups = max(1, min(-(-2 * cores // n_shards), -(-n_queries // QUERY_GROUP)))
    asked = (
        queries.distinct().withColumn("part", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
        .select(F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"), "part", F.lit(None).cast("int").alias("node"), "vec", F.array("id").alias("ids"), F.lit(None).cast("array<array<int>>").alias("layers"))
    )
    held = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).select(*asked.columns)
    cell = ["shard", "part"]
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            now, nodes, graph, ids = None, [], None, []
            for batch in batches:
                waiting = []
                for shard, part, node, vec, own, layers in zip(*(batch[c].to_pylist() for c in cell), batch["node"].to_pylist(), batch["vec"].to_numpy(zero_copy_only=False), batch["ids"].to_pylist(), batch["layers"].to_pylist()):
                    if (shard, part) != now:
                        yield from answers(graph, ids, waiting)
                        now, nodes, graph, ids, waiting = (shard, part), [], None, [], []
                    if node is not None:
                        nodes.append((vec, layers))
                        ids.append(own)
                    else:
                        if graph is None and nodes:
                            graph, nodes = _graph(nodes), []
                        waiting.append((own[0], vec))
                yield from answers(graph, ids, waiting)

        def answers(graph, ids, waiting):
            for i in range(0, len(waiting) if graph else 0, BATCH):
                part = waiting[i: i + BATCH]
                width = ef
                while part:
                    again = []
                    for (own, vec), found in zip(part, graph.search(np.stack([v for _, v in part]), width)):
                        found = found[found >= 0]
                        best = best_ids(graph.vectors[found] @ vec, [ids[at] for at in found.tolist()], own, k)
                        if len(best) < k and len(found) < len(graph.points) and width < len(graph.points):
                            again.append((own, vec))  # few ids hold all that was found: a longer list
                        else:
                            yield from ((own, i, s) for s, i in best)
                    part, width = again, width * 4

        yield from common.batches(rows(), schema)

    met = held.unionByName(asked).repartitionByRange(n_shards * groups, *cell).sortWithinPartitions(*cell, F.col("node").asc_nulls_last())
    found = met.mapInArrow(search, "query_id bigint, vec_id bigint, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return common.gathered(found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), n_queries * k)


def best_ids(score: np.ndarray, ids: list[list[int]], own: int, k: int) -> list[tuple[float, int]]:
    """The ``k`` best (score, id), each id once with its best score, without ``own``; ties to smaller ids."""
    best: dict[int, float] = {}
    for s, held in zip(score.tolist(), ids):
        for i in held:
            if i != own and s > best.get(i, -np.inf):
                best[i] = s
    return sorted(((s, i) for i, s in best.items()), key=lambda x: (-x[0], x[1]))[:k]


def _graph(nodes: list[tuple[np.ndarray, list[list[int]]]]) -> Graph:
    """A graph from its nodes' vectors and neighbours, in node order."""
    layers = []
    for layer in range(max(len(own) for _, own in nodes)):
        held = [own[layer] for _, own in nodes if len(own) > layer]
        links = np.full((len(held), max(1, max(map(len, held)))), -1, dtype=np.int32)
        for at, neighbours in enumerate(held):
            links[at, : len(neighbours)] = neighbours
        layers.append(links)
    return Graph(np.stack([v for v, _ in nodes]), layers=layers)
