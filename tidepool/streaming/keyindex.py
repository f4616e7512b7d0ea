"""Which keys a table holds, without reading the table (STR2, SNK7).

The index is a folder of two tables.  ``keys`` holds every key once per
generation (one append to the table), in ``BUCKETS`` folders by its hash.
``filters`` holds a Bloom filter over each bucket of each generation, cut into
blocks of ``BLOCK_BITS`` bits: a key has one block, and ``PROBES`` bits in it.
Both are built and probed by DataFrame functions only.

A batch is looked up in two steps.  Its keys are joined to the filter blocks by
bucket and block; a key whose bits are all set may be known.  Only the buckets
(folder names, bounded by generations x buckets) for which such a key exists are
read, and decide.  A batch of new keys thus reads filter blocks, about a
tenth of the keys' size, and hardly any keys; a replayed one reads the buckets of
the generations that it repeats, and nothing of the table itself.

Generations have an owner (the job that appends).  ``MERGE_AT`` generations of one
owner and level are merged into one of the next level, so their number grows with
the logarithm of the appends and each key is rewritten as often.  A generation
counts from the moment its marker exists, written last; what a failed append left
behind is replaced by its replay or deleted.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.sources import folders

KEY = "EventKey"
BUCKETS = 64
#: Bits of a filter block: the size of the engine's bitmaps.  32 bits a key and 12 probes: one new key in a million passes.
BLOCK_BITS = 32_768
BLOCK_KEYS = 1_024
PROBES = 12
MERGE_AT = 8

KEYS = f"{KEY} string"
FILTERS = "Bucket int, Block bigint, Bits binary"


@dataclass(frozen=True)
class Generation:
    """One entry of the index: ``owner.level.blocks.name`` is its folder's name."""

    owner: str
    level: int
    blocks: int
    name: str

    @property
    def folder(self) -> str:
        return f"{self.owner}.{self.level}.{self.blocks}.{self.name}"

    @classmethod
    def of(cls, folder: str) -> Generation:
        owner, level, blocks, name = folder.split(".", 3)
        return cls(owner, int(level), int(blocks), name)


def generations(spark: SparkSession, index: str) -> list[Generation]:
    """Complete generations: those with a marker."""
    return [Generation.of(n) for n in folders.children(spark, f"{index}/complete") if not n.startswith((".", "_"))]


def bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), blocks)


def probes(key: Column) -> Column:
    """The key's bit positions in its block: four 15-bit slices of each of three hashes."""
    return F.array(*_positions(_hashes(key)))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key, F.lit(f"probe {i}")).alias(f"_h{i}") for i in range(PROBES // 4)]


def _positions(hashes: list[Column]) -> list[Column]:
    return [F.shiftrightunsigned(h, 15 * part).bitwiseAND(F.lit(BLOCK_BITS - 1)) for h in hashes for part in range(4)]


#: A key's three hashes, which are shuffled in place of its twelve positions.
_HELD = [f"_h{i}" for i in range(PROBES // 4)]


def filter_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter over ``keys`` as ``FILTERS``: a key is shuffled and sorted once, as its hashes, and sets one bit in each of ``PROBES`` bitmaps of its block, which are then united."""
    key = F.col(KEY)
    placed = keys.select(bucket(key).alias("Bucket"), block(key, F.lit(blocks)).alias("Block"), *_hashes(key)).repartition("Bucket", "Block")
    bits = [F.bitmap_construct_agg(p).alias(f"_b{i}") for i, p in enumerate(_positions([F.col(h) for h in _HELD]))]
    each = placed.groupBy("Bucket", "Block").agg(*bits)
    united = each.select("Bucket", "Block", F.explode(F.array(*[F.col(f"_b{i}") for i in range(len(bits))])).alias("_b"))
    return united.groupBy("Bucket", "Block").agg(F.bitmap_or_agg("_b").alias("Bits"))


def all_set(bits: Column, positions: Column) -> Column:
    """Whether a block's bitmap has all of the positions."""
    def is_set(p: Column) -> Column:
        octet = F.conv(F.hex(F.substr(bits, (F.shiftright(p, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return octet.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (p % 8 + 1).cast("int"))) > 0

    return F.forall(positions, is_set)


def add(keys: DataFrame, index: str, owner: str, name: str, level: int = 0, count: int | None = None) -> None:
    """Enter the rows of ``keys`` (column ``KEY``, distinct and stored: they are read twice) as one generation, replacing what a failed attempt left."""
    spark = keys.sparkSession
    count = keys.count() if count is None else count
    drop(spark, index, [g for g in _left_behind(spark, index) if (g.owner, g.name) == (owner, name)])
    entry = Generation(owner, level, max(1, -(-count // (BUCKETS * BLOCK_KEYS))), name)
    hashed = keys.select(KEY, bucket(F.col(KEY)).alias("Bucket"))
    if count:
        # Keys of a bucket lie together, in several files where they are many.
        hashed.hint("rebalance", "Bucket").write.mode("overwrite").partitionBy("Bucket").parquet(f"{index}/keys/{entry.folder}")
        filter_blocks(keys, entry.blocks).write.mode("overwrite").parquet(f"{index}/filters/{entry.folder}")
    folders.mark(spark, f"{index}/complete/{entry.folder}")


def _left_behind(spark: SparkSession, index: str) -> list[Generation]:
    """Every generation that has a folder or a marker."""
    names = {n for part in ("complete", "keys", "filters") for n in folders.children(spark, f"{index}/{part}") if not n.startswith((".", "_"))}
    return [Generation.of(n) for n in sorted(names)]


def drop(spark: SparkSession, index: str, entries: list[Generation]) -> None:
    for entry in entries:
        for part in ("complete", "filters", "keys"):
            folders.delete(spark, f"{index}/{part}/{entry.folder}")


def may_hold(keys: DataFrame, index: str, entries: list[Generation]) -> list[str]:
    """Folders of keys (one per generation and bucket) that may hold one of ``keys``, by their filters alone."""
    spark = keys.sparkSession
    entries = [e for e in entries if folders.exists(spark, f"{index}/filters/{e.folder}")]
    if not entries:
        return []
    key = F.col(KEY)
    known = F.array(*[F.struct(F.lit(i).alias("Generation"), F.lit(e.blocks).cast("bigint").alias("Blocks")) for i, e in enumerate(entries)])
    hashed = keys.select(bucket(key).alias("Bucket"), F.xxhash64(key, F.lit("block")).alias("_block"), *_hashes(key), F.explode(known).alias("_known"))
    probed = hashed.select("_known.Generation", "Bucket", F.pmod("_block", "_known.Blocks").alias("Block"), *_HELD)
    filters = None
    for i, e in enumerate(entries):
        one = spark.read.schema(FILTERS).parquet(f"{index}/filters/{e.folder}").withColumn("Generation", F.lit(i))
        filters = one if filters is None else filters.unionByName(one)
    positions = F.array(*_positions([F.col(h) for h in _HELD]))
    hit = probed.join(filters, ["Generation", "Bucket", "Block"]).where(all_set(F.col("Bits"), positions)).select("Generation", "Bucket").distinct()
    found = [(entries[r[0]].folder, r[1]) for r in hit.collect()]  # at most generations x buckets
    return sorted(f"{index}/keys/{folder}/Bucket={b}" for folder, b in found)


def unseen(batch: DataFrame, index: str, entries: list[Generation] | None = None) -> DataFrame:
    """The rows of ``batch`` (read twice) whose key no generation (of ``entries``) holds."""
    spark = batch.sparkSession
    found = may_hold(batch.select(KEY), index, generations(spark, index) if entries is None else entries)
    if not found:
        return batch
    return batch.join(_keys_in(spark, found), KEY, "left_anti")


def _keys_in(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The keys of folders, whatever generation and bucket they are of."""
    return spark.read.schema(KEYS).option("recursiveFileLookup", "true").parquet(*paths)


def merge(spark: SparkSession, index: str, keep: str | None = None) -> None:
    """Merge each level's generations of an owner once there are ``MERGE_AT``; those named ``keep`` stay as they are."""
    merged = True
    while merged:
        merged = False
        by_level: dict[tuple[str, int], list[Generation]] = {}
        for g in generations(spark, index):
            if g.name != keep:
                by_level.setdefault((g.owner, g.level), []).append(g)
        for (owner, level), group in by_level.items():
            if len(group) < MERGE_AT:
                continue
            name = hashlib.md5("|".join(sorted(g.folder for g in group)).encode()).hexdigest()[:12]
            with_keys = [f"{index}/keys/{g.folder}" for g in group if folders.exists(spark, f"{index}/keys/{g.folder}")]
            if with_keys:
                add(_keys_in(spark, with_keys), index, owner, name, level + 1)
            drop(spark, index, group)
            merged = True
