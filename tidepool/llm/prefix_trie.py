"""Prefix trie of conversations, built by van Emde Boas recursion over its depth.

A sequence is a conversation's turns; a node is a distinct sequence of first
turns, so all conversations that begin alike share it.  A trie of height h is cut
at half depth: the prefixes that end at the cut get names, the part above them is
a trie of half the height, the parts below are forests of half the height, each
under the name it hangs on, and all parts of one height are worked on in one job.
The recursion ends at blocks of ``BLOCK`` depths, which are one row each.

Down: the name of a cut prefix is the hash of the name at its part's root and of
the segment between, and segments of doubling height are named from their halves.
So the names at all cuts of a conversation of any length take a logarithmic
number of joins on (conversation, place), and no conversation ever meets in one
task.  In a block the names follow turn by turn.

Up: a node's totals first hold what lies below it in its own block.  Then, for
heights that double, the totals at the entry of each lower part are grafted: they
are added to the nodes above it in the upper part, which are those on the path of
any conversation that passes the entry (its smallest member is taken).

Names are SHA-256 of what they stand for: equal for equal prefixes, everywhere.

Defined cases: rows without a conversation id belong to none and are left out; a
null role or text is empty; turns are ordered by number (null first), then, where
numbers repeat, by the hash of role and text; repeated rows are turns of their
own; a conversation without turns is a member of the root; texts and
conversations of any length are taken whole; no conversations give no nodes, not
even a root; other columns are not read, so their names don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm import common
from tidepool.operators.ranking import global_rank

#: Depths of a block, as a power of two, and of the blocks (or turns) that a join key may stand for.
BLOCK_BITS = 4
BLOCK = 1 << BLOCK_BITS
KEY_BITS = 12
#: Characters of ids that are joined in one row on the way to an ``ends`` hash.
ENDS_CHARS = 1 << 20

# The rebuilding rule: ids by the hundred share an opening of up to OPENING_TURNS - 1 turns.
OPENING_TURNS = 6
OPENING_IDS = 100


def _name(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def _root() -> Column:
    return _name(F.lit(""))


def ordered_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv``, place ``r`` (from 1), name ``t`` of role and text, and the text's code points ``chars``, per turn."""
    role, text = (F.coalesce(common.column(df, c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = df.where(common.column(df, conv_col).isNotNull()).select(
        common.column(df, conv_col).cast("bigint").alias("conv"), common.column(df, turn_col).alias("turn"),
        _name(F.concat_ws(":", F.char_length(role).cast("string"), role, text)).alias("t"), F.char_length(text).cast("bigint").alias("chars"))
    return global_rank(rows, [F.col("turn").asc_nulls_first(), F.col("t")], name="r", group_cols=["conv"]).drop("turn")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) where each conversation opens with the first turns of the one its id's hundred begins with.

    Turns are ``conv``, depth ``d`` (from 1), ``t``, ``chars``; conversations ``conv`` and ``turns``, their number.
    """
    opening = F.crc32(F.col("conv").cast("string")) % OPENING_TURNS
    first = (
        turns.where((F.col("conv") % OPENING_IDS == 0) & (F.col("r") < OPENING_TURNS))
        .groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(F.struct("r", "t", "chars"))).alias("lead"))
    )
    held = turns.groupBy("conv").agg(F.max("r").alias("n")).withColumn("h", opening).withColumn("base", F.col("conv") - F.col("conv") % OPENING_IDS)
    # The hint keeps a base's up to 199 conversations from a broadcast that grows with them.
    convs = common.stored(
        held.hint("merge").join(first, "base", "left")
        .withColumn("lead", F.expr("slice(coalesce(lead, array()), 1, cast(h AS int))"))
        .select("conv", "n", "h", "lead", (F.size("lead") - F.col("h")).alias("shift"),
                (F.size("lead") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).cast("bigint").alias("turns")), "conversations")
    # A long conversation's turns meet its row in parts.
    shifts = convs.where("n > h").select("conv", "h", "shift", F.explode(F.sequence(F.lit(0), F.shiftright(F.col("n"), 16))).alias("part"))
    own = turns.withColumn("part", F.shiftright("r", 16)).join(shifts, ["conv", "part"]).where("r > h")
    opened = convs.select("conv", F.explode("lead").alias("l")).select("conv", F.col("l.r").cast("bigint").alias("d"), "l.t", "l.chars")
    return own.select("conv", (F.col("r") + F.col("shift")).cast("bigint").alias("d"), "t", "chars").unionByName(opened), convs.select("conv", "turns")


def _full(size: Column, c: Column) -> Column:
    """Whether a block holds a turn for all of its depths (block 0 begins with the root, which is no turn)."""
    return size == F.when(c == 0, BLOCK - 1).otherwise(BLOCK)


def _cut_names(blocks: DataFrame, top: int) -> DataFrame:
    """``conv``, ``c``, ``name`` of the prefix in front of block ``c``, for every block that all blocks before it fill."""
    whole = F.array_join(F.transform("turns", lambda x: F.hex(x["t"])), "")
    segment = common.stored(blocks.where(_full(F.size("turns"), F.col("c"))).select("conv", F.col("c").alias("i"), _name(whole).alias("s")), "segments-0")
    levels, segments = (top + 1).bit_length(), []
    for k in range(levels):
        segments.append(segment)
        if k + 1 < levels:
            half = [F.max(F.when(F.col("i") % 2 == side, F.col("s"))).alias(name) for side, name in ((0, "left"), (1, "right"))]
            pairs = segment.groupBy("conv", F.shiftright("i", 1).alias("j")).agg(*half).where("left IS NOT NULL AND right IS NOT NULL")
            segment = common.stored(pairs.select("conv", F.col("j").alias("i"), _name(F.concat("left", "right")).alias("s")), f"segments-{k + 1}")
    known = blocks.where("c = 0").select("conv", "c", _root().alias("name"))
    for k in reversed(range(levels)):
        cut = segments[k].where("i % 2 = 0").select("conv", F.shiftleft("i", k).alias("c"), "s")
        below = known.join(cut, ["conv", "c"]).select("conv", (F.col("c") + (1 << k)).alias("c"), _name(F.concat("name", "s")).alias("name"))
        known = common.stored(known.unionByName(below), f"cuts-{k}")
    return known


def _paths(turns: DataFrame) -> tuple[DataFrame, int]:
    """Blocks of ``conv`` and ``c`` with ``nodes`` (``d``, ``name``, ``parent``, ``chars`` for its depths); and the last ``c``."""
    blocks = common.stored(
        turns.groupBy("conv", F.shiftright("d", BLOCK_BITS).alias("c")).agg(F.sort_array(F.collect_list(F.struct("d", "t", "chars"))).alias("turns")), "blocks")
    full = F.max(F.when(_full(F.size("turns"), F.col("c")), F.col("c")))
    top, last_full = blocks.agg(F.max("c"), full).first()
    if last_full is None:
        named = blocks.withColumn("name", _root()).withColumn("end", F.lit(None).cast("binary"))
    else:
        cuts = _cut_names(blocks, top)
        ends = cuts.select("conv", (F.col("c") - 1).alias("c"), F.col("name").alias("end"))
        named = blocks.join(cuts, ["conv", "c"]).join(ends, ["conv", "c"], "left")
    names = F.aggregate("turns", F.array("name"), lambda held, x: F.array_append(held, _name(F.concat(F.element_at(held, -1), x["t"]))))
    # The last node of a full block goes by its cut's name, as the root of what hangs on it.
    own = F.when(F.col("end").isNotNull() & _full(F.size("turns"), F.col("c")), F.array_append(F.slice("names", 1, F.size("turns")), F.col("end"))).otherwise(F.col("names"))
    node = F.transform("turns", lambda x, i: F.struct(x["d"].alias("d"), F.get("names", i + 1).alias("name"), F.get("names", i).alias("parent"), x["chars"].alias("chars")))
    return common.stored(named.withColumn("names", names).withColumn("names", own).select("conv", "c", node.alias("nodes")), "paths"), top or 0


def _with_root(nodes: str = "nodes") -> Column:
    """Depths and names of a block's nodes, the root's included in block 0."""
    own = F.transform(nodes, lambda x: F.struct(x["d"].alias("d"), x["name"].alias("name")))
    return F.when(F.col("c") == 0, F.concat(F.array(F.struct(F.lit(0).cast("bigint").alias("d"), _root().alias("name"))), own)).otherwise(own)


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _subtree_totals(paths: DataFrame, nodes: DataFrame, top: int) -> DataFrame:
    """``name``, ``leaves`` and ``saved`` summed over each node's subtree; ``nodes`` has ``conv`` (smallest member), ``d``, ``leaf`` and ``weight``."""
    # In its block: each node gets what the nodes at or below it bring, each on its smallest member's path.
    brought = nodes.where("d > 0").groupBy("conv", F.shiftright("d", BLOCK_BITS).alias("c")).agg(F.collect_list(F.struct("d", "leaf", "weight")).alias("brought"))

    def below(field: str):
        return lambda v: F.aggregate(F.filter("brought", lambda u: u["d"] >= v["d"]), F.lit(0).cast("bigint"), lambda held, u: held + u[field])

    sums = F.transform(_with_root(), lambda v: F.struct(v["name"].alias("name"), below("leaf")(v).alias("leaves"), below("weight")(v).alias("saved")))
    inside = paths.join(brought, ["conv", "c"]).select(F.explode(sums).alias("s")).select("s.*").where("leaves <> 0 OR saved <> 0")
    totals = _summed(inside.unionByName(nodes.where("d = 0").select("name", F.col("leaf").alias("leaves"), F.col("weight").alias("saved"))))
    for k in range(top.bit_length()):
        totals = common.stored(totals, f"totals-{k}")
        entries = nodes.where((F.col("d") > 0) & (F.col("d") % BLOCK == 0)).withColumn("cut", F.shiftright("d", BLOCK_BITS))
        entries = entries.where(F.col("cut").bitwiseAND(F.lit((2 << k) - 1)) == 1 << k).join(totals, "name")
        parts = F.sequence(F.shiftright(F.col("cut") - (1 << k), KEY_BITS), F.shiftright(F.col("cut") - 1, KEY_BITS))
        upper = paths.where(F.shiftright("c", k) % 2 == 0).select(
            "conv", F.shiftleft(F.shiftright("c", k) + 1, k).alias("cut"), F.shiftright("c", KEY_BITS).alias("part"), F.transform(_with_root(), lambda v: v["name"]).alias("names"))
        grafts = (entries.select("conv", "cut", "leaves", "saved", F.explode(parts).alias("part")).join(upper, ["conv", "cut", "part"])
                  .select(F.explode("names").alias("name"), "leaves", "saved"))
        totals = _summed(totals.unionByName(grafts.select(*totals.columns)))
    return totals


def _ends(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """``name`` and ``ends``: SHA-256 of the ids, ascending and joined by commas, of the conversations that end at a node."""
    last = convs.select("conv", F.shiftright("turns", BLOCK_BITS).alias("c"), "turns").join(paths, ["conv", "c"], "left")
    ended = last.select(F.when(F.col("turns") == 0, _root()).otherwise(F.element_at("nodes", -1)["name"]).alias("name"), "conv")
    joined = pa.schema([("name", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            name, first, ids, size = None, 0, [], 0
            for batch in batches:
                for now, conv in zip(batch["name"].to_pylist(), batch["conv"].to_pylist()):
                    if ids and (now != name or size > ENDS_CHARS):
                        yield name, first, ",".join(ids)
                        ids, size = [], 0
                    if not ids:
                        name, first = now, conv
                    ids.append(str(conv))
                    size += len(ids[-1])
            if ids:
                yield name, first, ",".join(ids)

        yield from common.batches(rows(), joined, 256)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            name, running = None, None
            for batch in batches:
                for now, ids in zip(batch["name"].to_pylist(), batch["ids"].to_pylist()):
                    if running is not None and now == name:
                        running.update(b",")
                    else:
                        if running is not None:
                            yield name, running.hexdigest()
                        name, running = now, hashlib.sha256()
                    running.update(ids.encode())
            if running is not None:
                yield name, running.hexdigest()

        yield from common.batches(rows(), pa.schema([("name", pa.binary()), ("ends", pa.string())]))

    # A node where very many end is joined in parts; only the parts' texts meet, one after the other.
    texts = ended.repartitionByRange("name", "conv").sortWithinPartitions("name", "conv").mapInArrow(join, "name binary, first bigint, ids string")
    return texts.repartition("name").sortWithinPartitions("name", "first").mapInArrow(digest, "name binary, ends string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per node, of ``turns`` and ``convs`` as ``rebuilt`` gives them.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.
    """
    paths, top = _paths(turns)
    least, members = convs.agg(F.min("conv"), F.count("*")).first()
    inner = paths.select("conv", F.explode("nodes").alias("v")).select("conv", "v.*")
    root = convs.sparkSession.range(1 if members else 0).select(
        _root().alias("name"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("bigint").alias("d"), F.lit(0).cast("bigint").alias("chars"),
        F.lit(members).cast("bigint").alias("n_convs"), F.lit(least).cast("bigint").alias("conv"))
    found = common.stored(inner.groupBy("name", "parent", "d", "chars").agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv")).unionByName(root), "nodes")
    children = found.groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children")).where("name IS NOT NULL")
    nodes = common.stored(
        found.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .withColumn("leaf", (F.col("n_children") == 0).cast("bigint")).withColumn("weight", (F.col("n_convs") - 1) * F.col("chars")), "trie")
    # All first turns have the root as parent, whose smallest member is known; others with many children are left to the skew join.
    parents = nodes.where("d > 0 AND n_children > 0").select(F.col("name").alias("parent"), F.col("conv").alias("parent_conv_id"))
    parent = F.when(F.col("d") == 1, F.lit(least)).otherwise(F.col("parent_conv_id"))
    key = F.when(F.col("d") > 1, F.col("parent")).otherwise(F.col("name"))
    totals, ends = _subtree_totals(paths, nodes, top), _ends(paths, convs)
    return (
        nodes.withColumn("parent", key).join(totals, "name").join(ends, "name", "left").join(parents, "parent", "left")
        .select(F.col("conv").alias("conv_id"), F.col("d").alias("depth"), parent.cast("bigint").alias("parent_conv_id"), "n_convs", "n_children",
                F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
    )
