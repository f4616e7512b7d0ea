"""SimHash near-duplicates: 64-bit fingerprints joined on pigeonhole blocks.

A fingerprint is cut into ``max_bits + KEPT_BLOCKS`` blocks: two fingerprints
at most ``max_bits`` bits apart agree on at least ``KEPT_BLOCKS`` of them, so
each choice of that many blocks gives one key, and every close pair shares a
key.  With three of six blocks a key has about 32 bits, which keeps groups
small up to billions of different fingerprints.

Equal fingerprints are one row from the start.  Keys that one fingerprint has
alone are dropped by a count; a group of more than ``CHUNK`` is dealt into
chunks, and every pair of chunks is a cell of its own.  Inside a cell all pairs
are verified by Hamming distance, but only links to the smallest member that
each one reaches there leave it: at most one row per member, no pair lost to
the components that follow.

Defined cases: a null text is an empty one; a text of no words has fingerprint
zero and is linked like any other; null ids never become a ``component_id``
unless the whole component has none; repeated ids are rows of their own, and of
repeated rows ``deduplicated`` keeps one; texts of any length are read whole; of
equally good rows the smallest id, then the smallest hash of the text is kept; an
empty table gives no rows; extra columns are kept by ``deduplicated``, whatever
their names, and not read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm import common
from tidepool.llm.graph import components

SEED = 42
KEPT_BLOCKS = 3
CHUNK = 2048
#: Shingles counted at once; longer texts are counted in turns.
TURN = 200_000


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Fingerprint (unsigned) of one text: bit set where over half the shingles' XXH64 have it."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8").lower().split()  # bytes.lower: A-Z only
    if not words:
        return 0
    if len(words) < shingle:
        return xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1:].tolist()
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(starts), TURN):
        hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[i: i + TURN], ends[i: i + TURN])]
        octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_hash, fp)`` of every row, stored; ``fp`` is the fingerprint's 64 bits as a bigint."""
    common.prepare(df.sparkSession)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b["t"].to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_pydict({"doc_id": b["doc_id"], "text_hash": b["text_hash"], "fp": pa.array(fps.view(np.int64))})

    text = common.column(df, text_col)
    rows = df.select(common.column(df, id_col).cast("bigint").alias("doc_id"), text.alias("t"), F.xxhash64(text).alias("text_hash"))
    return common.stored(rows.mapInArrow(compute, "doc_id bigint, text_hash bigint, fp bigint"), "fingerprints")


def masks(max_bits: int, kept: int = KEPT_BLOCKS) -> list[int]:
    """One signed 64-bit mask per choice of ``kept`` of ``max_bits + kept`` blocks."""
    n = max_bits + kept
    edge = [64 * i // n for i in range(n + 1)]
    block = [((1 << edge[i + 1]) - 1) & ~((1 << edge[i]) - 1) for i in range(n)]
    out = [sum(block[i] for i in chosen) for chosen in combinations(range(n), kept)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def reach(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """For each of a cell's fingerprints the smallest that it reaches by links inside the cell."""
    root = np.full(len(fps), -1, dtype=np.int64)
    order = np.argsort(fps)
    rest = order
    for first in order:
        if root[first] >= 0:
            continue
        root[first] = first
        rest = rest[rest != first]
        queue = [first]
        while queue and len(rest):
            near = np.bitwise_count(fps[rest] ^ fps[queue.pop()]) <= max_bits
            if near.any():
                found, rest = rest[near], rest[~near]
                root[found] = first
                queue.extend(found.tolist())
    return fps[root]


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Links ``(u, v)`` between fingerprints (column ``fp``, each once) that give the components of all close pairs."""
    keyed = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks(max_bits))
    ])).alias("k")).select("fp", "k.choice", "k.key")
    shared = keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    # The hint keeps the keys from a broadcast: Spark knows their size from before the explode.
    member = (
        keyed.hint("merge").join(shared, ["choice", "key"])
        .withColumn("mine", F.pmod(F.xxhash64("fp"), chunks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .select("choice", "key", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "fp")
    )
    cell = ["choice", "key", "a", "b"]
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the last cell's members so far: at most two chunks
        last = None

        def linked(fps: np.ndarray):
            if len(fps) == 2:
                if int(fps[0] ^ fps[1]).bit_count() <= max_bits:
                    yield int(fps[0].view(np.int64)), int(fps[1].view(np.int64))
            elif len(fps) > 2:
                to = reach(fps, max_bits)
                for k in np.flatnonzero(to != fps):
                    yield int(fps[k].view(np.int64)), int(to[k].view(np.int64))

        def rows():
            nonlocal held, last
            for batch in batches:
                if not batch.num_rows:
                    continue
                columns = np.stack([batch[c].to_numpy().astype(np.int64) for c in cell])
                fps = batch["fp"].to_numpy().view(np.uint64)
                cuts = np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1
                for i, j in zip([0, *cuts], [*cuts, len(fps)]):
                    here = tuple(columns[:, i])
                    if here != last:
                        if held:
                            yield from linked(np.concatenate(held))
                        held, last = [], here
                    held.append(fps[i:j])
            if held:
                yield from linked(np.concatenate(held))

        yield from common.batches(rows(), schema)

    return member.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(verify, "u bigint, v bigint")


def near_duplicates(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """``fingerprints`` with ``component_id``, the smallest id that a row reaches over links of at most ``max_bits`` bits, and ``root``, the smallest such fingerprint."""
    distinct = common.stored(common.gathered(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), fps.count()), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), max_bits), distinct.count()).withColumnRenamed("node", "fp")
    linked = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = linked.select("fp", "root").join(lowest, "root")
    return common.gathered(fps.join(by_fp, "fp"), fps.count())


def deduplicated(df: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every component: that with the smallest id (of rows without ids, or with one id, the smallest hash of the text)."""
    fps = fingerprints(df, shingle, id_col, text_col)
    found = near_duplicates(fps, max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    kept = found.groupBy("root").agg(first.alias("row")).select(F.xxhash64("row.doc_id", "row.text_hash").alias("key"), F.col("row.doc_id").alias("kept_id"))
    # The key of a row is known before and after: nothing has to number the rows.
    id_, text = common.column(df, id_col).cast("bigint"), common.column(df, text_col)
    others = [common.column(df, c) for c in df.columns if c not in (id_col, text_col)]
    rest = F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0)
    rows = df.select(F.struct("*").alias("document"), id_.alias("id"), F.xxhash64(id_, F.xxhash64(text)).alias("key"), rest.alias("others"))
    same = Window.partitionBy("key", "id").orderBy("others")
    return common.gathered(
        rows.join(kept, "key").where(F.col("id").eqNullSafe(F.col("kept_id")))
        .withColumn("nth", F.row_number().over(same)).where("nth = 1").select("document.*"), fps.count())


def hexadecimal(fp):
    """16 lower-case digits of a bigint's 64 bits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
