"""Best-fit packing: a configuration LP over the length histogram, rounded.

Documents are encoded and cut into pieces of at most ``capacity`` tokens.  Only
the histogram of piece lengths (at most ``capacity`` numbers, whatever the
number of documents) comes to the driver, where

1. each step fills the table of a knapsack dynamic programme under the current
   weights of the lengths, which prices the best filling of every room;
2. every length that is not yet covered is put into a configuration (a multiset of
   lengths that fits a sequence) with the best filling of the room it leaves, and
   that configuration takes a share of the length's demand, as far as its other
   lengths last; multiplicative weights then lower the weight of each length by
   the share of it that is covered.  Steps go on until all demand is covered,
   with shares that grow, so their number follows from the histogram;
3. the configurations' fractional counts are rounded down, those that waste
   least first, and best fit decreasing packs what is left, whole classes of
   equal bins at a time.  How much waste a configuration may have is tried at
   several levels; the plan of fewest sequences stays.

Each length then has a list of runs of places.  A piece's rank among the pieces
of its length (its count inside its task, plus those of earlier tasks) names
its place: a lookup, with no sort and nothing that depends on one hot length.

Defined cases: a null text is an empty one, of the end token alone; null and
repeated ids are carried along, each row a document of its own; texts of any
length are cut whole; pieces of one length are alike, so ties between them are
settled by where they lie in the input; an empty table gives no pieces; other
columns are not read, so their names don't matter.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm import common
from tidepool.llm.encoding import encoder

Config = tuple[tuple[int, int], ...]  # (length, copies)

#: Share of a length's demand that a step covers at first (one sequence at least), and by how much it grows with each step.
SHARE = 0.05
GROWTH = 1.06
#: How fast the weight of a length falls with the share of it that is covered.
RATE = 8.0

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"
PLACED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


def knapsack(lengths: np.ndarray, values: np.ndarray, capacity: int) -> np.ndarray:
    """For every room up to ``capacity``, the index of ``lengths`` (ascending) that its best filling begins with; -1 where nothing adds value."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(int(lengths[0]), capacity + 1):
        k = fitting[room]
        value = best[room - lengths[:k]] + values[:k]
        top = int(value.argmax())
        if value[top] > 0:
            best[room], took[room] = value[top], top
    return took


def filling(lengths: list[int], took: list[int], room: int) -> list[int]:
    """Indices of the best filling of a room."""
    out = []
    while took[room] >= 0:
        out.append(took[room])
        room -= lengths[took[room]]
    return out


def fractional(histogram: np.ndarray, share: float = SHARE) -> dict[Config, float]:
    """Fractional configuration counts that cover all demand."""
    capacity = len(histogram) - 1
    lengths = np.flatnonzero(histogram)
    sizes = lengths.tolist()
    demand = histogram[lengths].astype(float)
    room = demand.copy()  # pieces not yet covered
    out: dict[Config, float] = {}
    while (left := room > 1e-9 * demand).any():
        # Weights start at a piece's length, squared: long pieces have few partners and choose first.
        took = knapsack(lengths, lengths.astype(float) ** 2 * np.exp(-RATE * (1 - room / demand)) * left, capacity).tolist()
        for i in np.flatnonzero(left)[::-1].tolist():
            if room[i] <= 1e-9 * demand[i]:
                continue
            # Of the filling, lengths that this step has used up drop out: the next step prices the others higher.
            copies = Counter([i, *(j for j in filling(sizes, took, capacity - sizes[i]) if room[j] > 1e-9 * demand[j])])
            times = min(max(1.0, share * demand[i] / copies[i]), *(room[j] / n for j, n in copies.items()))
            for j, n in copies.items():
                room[j] -= times * n
            config = tuple(sorted((sizes[j], n) for j, n in copies.items()))
            out[config] = out.get(config, 0.0) + times
        share = min(1.0, share * GROWTH)
    return out


def best_fit(histogram: np.ndarray) -> Counter[Config]:
    """Best fit decreasing on counts: bins of the same content are one class."""
    capacity = len(histogram) - 1
    classes: dict[int, list[tuple[int, Config]]] = {}  # by free space
    free = np.zeros(capacity + 1, dtype=bool)
    for length in range(capacity, 0, -1):
        n = int(histogram[length])
        while n:
            room = np.flatnonzero(free[length:])
            if len(room):
                at = int(room[0]) + length
                bins, content = classes[at].pop()
                if not classes[at]:
                    free[at] = False
            else:
                at, bins, content = capacity, -(-n // (capacity // length)), ()
            fit = at // length
            whole = min(bins, n // fit)
            part = 0 if whole == bins else n - whole * fit  # pieces in one more, not full bin
            for count, copies in ((whole, fit), (1 if part else 0, part), (bins - whole - (1 if part else 0), 0)):
                if count and (copies or content):
                    space = at - copies * length
                    classes.setdefault(space, []).append((count, (*content, (length, copies)) if copies else content))
                    free[space] = True
            n -= whole * fit + part
    out: Counter[Config] = Counter()
    for held in classes.values():
        for count, content in held:
            out[tuple(sorted(content))] += count
    return out


def rounded(histogram: np.ndarray, found: dict[Config, float], spare: int) -> Counter[Config]:
    """Whole counts: of configurations that waste at most ``spare``, rounded down, then best fit for the rest."""
    capacity = len(histogram) - 1
    rest = histogram.copy()
    out: Counter[Config] = Counter()
    waste = {config: capacity - sum(length * n for length, n in config) for config in found}
    for config in sorted((c for c in found if waste[c] <= spare), key=lambda c: (waste[c], -found[c], c)):
        count = min(int(found[config] + 1e-9), *(int(rest[length]) // n for length, n in config))
        if count > 0:
            out[config] += count
            for length, n in config:
                rest[length] -= count * n
    out.update(best_fit(rest))
    return out


def plan(histogram: np.ndarray) -> list[tuple[Config, int]]:
    """Configurations with whole counts that pack exactly ``histogram`` (index: length, up to the capacity)."""
    capacity = len(histogram) - 1
    rest = histogram.astype(np.int64).copy()
    full = int(rest[capacity])
    rest[capacity] = 0
    found = fractional(rest)
    bound = -(-int((rest * np.arange(capacity + 1)).sum()) // capacity)
    best: Counter[Config] | None = None
    for spare in [0, *(2**k for k in range(capacity.bit_length())), -1]:  # -1: best fit alone
        tried = rounded(rest, found, spare)
        if best is None or tried.total() < best.total():
            best = tried
        if best.total() == bound:
            break
    return sorted(best.items()) + ([(((capacity, 1),), full)] if full else [])


def runs(packed: list[tuple[Config, int]], capacity: int) -> dict[str, np.ndarray]:
    """Runs of places by length: ranks [rank, next rank) of a length lie in sequences from ``sequence`` on, ``copies`` to each, from ``offset`` on."""
    rows: list[tuple[int, int, int, int, int]] = []
    used: Counter[int] = Counter()
    first = 0
    for config, count in packed:
        offset = 0
        for length, copies in config:
            rows.append((length, used[length], first, offset, copies))
            used[length] += copies * count
            offset += copies * length
        first += count
    rows.sort()
    names = ("length", "rank", "sequence", "offset", "copies")
    return dict(zip(names, np.array(rows, dtype=np.int64).reshape(-1, 5).T))


def place(table: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of pieces by length and rank."""
    span = int(max(rank.max(initial=0), table["rank"].max(initial=0))) + 1
    if span * (int(table["length"].max(initial=0)) + 1) >= 2**62:
        raise OverflowError("too many pieces for one lookup key")
    k = np.searchsorted(table["length"] * span + table["rank"], length * span + rank, side="right") - 1
    since, copies = rank - table["rank"][k], table["copies"][k]
    return table["sequence"][k] + since // copies, table["offset"][k] + since % copies * length


def pieces(df: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False) -> DataFrame:
    """Pieces of every document, stored: at most ``capacity`` ids each, only a first piece shorter.

    ``part`` and ``nth`` number the pieces of a length: task, and count inside it.
    """
    common.prepare(df.sparkSession)
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64()), ("part", pa.int32()), ("nth", pa.int64())] + [("ids", pa.binary())] * with_ids
    schema = pa.schema(fields)
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seen = encoder(tokenizer), TaskContext.get().partitionId(), Counter()

        def rows(batch):
            for doc_id, ids in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1))):
                raw = ids.tobytes() + end
                n = len(raw) // 4
                ends = [*range(n % capacity or capacity, n, capacity), n]
                for k, (a, b) in enumerate(zip([0, *ends], ends)):
                    ids = raw[4 * a: 4 * b]
                    yield (doc_id, k, a, b - a, zlib.crc32(ids), part, seen[b - a], ids)[: len(fields)]
                    seen[b - a] += 1

        for batch in batches:
            if batch.num_rows:
                yield from common.batches(rows(batch), schema)

    rows = df.select(common.column(df, id_col).cast("bigint").alias("k"), common.column(df, text_col).alias("t"))
    return common.stored(rows.mapInArrow(cut, PIECE + ", ids binary" * with_ids), "pieces")


def pack(cut: DataFrame, capacity: int) -> DataFrame:
    """``sequence_id`` and ``offset`` for every row of ``pieces``."""
    counts = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in cut.groupBy("length").count().collect():  # at most `capacity` rows
        histogram[length] = n
    table, n_pieces = runs(plan(histogram), capacity), int(histogram.sum())
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row per task
    first = counts.select("length", "part", F.coalesce(before, F.lit(0)).alias("first"))
    with_ids = "ids" in cut.columns
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sequence, offset = place(table, batch["length"].to_numpy(), batch["rank"].to_numpy())
                out = {c: batch[c] for c in kept} | {"sequence_id": sequence, "offset": offset}
                if with_ids:
                    out["ids"] = batch["ids"]
                yield pa.RecordBatch.from_pydict(out)

    ranked = cut.join(first, ["length", "part"]).withColumn("rank", F.col("first") + F.col("nth"))
    return common.gathered(ranked.select(*kept, "rank", *["ids"] * with_ids), n_pieces).mapInArrow(lookup, PLACED + ", ids binary" * with_ids)


def pack_documents(df: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """Encode, cut and pack ``documents``; with ``with_ids``, each piece's ids as little-endian 32-bit bytes."""
    return pack(pieces(df, tokenizer, end_id, capacity, with_ids=with_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: ids (little-endian 32-bit bytes, at most ``capacity``) by ``sequence_id``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda all_, x: F.concat(all_, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
