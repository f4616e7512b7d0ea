"""Mixing sources to target weights, in DataFrame operations only.

Every source's documents lie end to end and are cut into blocks of
``block_words`` words.  The mix is a row of slots, one block each, in output
shards of ``shard_slots``:

1. counts: how many slots of a shard each source gets is a multinomial draw with
   the sources' shares, without replacement over the whole mix, so that counts per
   shard vary as draws do while over all shards each source gets its target
   exactly.  A pseudorandom permutation of all places deals them;
2. slots: a shard's counts are its slots.  A source's draws are numbered through
   the shards (running sums of the counts), and a permutation of the shard's places
   says where each slot lies;
3. indices: a source's k-th draw is mapped to a block through a pseudorandom
   permutation of its block numbers, a new one for each pass;
4. blocks are joined by source and index.  The last draw of a source takes only
   the words its target still lacks.

Targets: sources in code point order (null last) have the weights 3, 1, 2, 3,
1, 2, ... and share ``share`` times all words; a source stops at ``cap`` times
its own words and the excess goes to the others by weight.  That is one level
(words per weight) for all that don't stop, found from sums over the sources in
the order in which they would stop.

Permutations are "swap or not" ciphers over any range, so they need no sort.
Positions inside a source, and draws inside a source, are running sums in two
steps (chunks, then chunk totals), so that no source is ever one task.  Slots are
made in a number of tasks that follows from their number.

Defined cases: a null text has no words; documents of no words are in no block
and are taken 0 times; repeated ids are documents of their own, also where one id
has very many rows; texts of any length are in as many blocks as they need; a mix
of no words, or of an empty table, is empty and all targets are 0; other columns
are carried, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm import common

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
BLOCK_WORDS = 256
SHARD_SLOTS = 4096
SEED = 17
ROUNDS = 12
#: Documents in a chunk of a source's running sum, on average; draws made in one step; slots of a task; shards in a chunk of running sums.
CHUNK_ROWS = 2_000
STEP_SLOTS = 4096
TASK_SLOTS = 1 << 16
SHARD_CHUNK = 4096


def permuted(x: Column, n: Column, *seed: Column) -> Column:
    """Place of ``x`` in a pseudorandom permutation of 0 .. n - 1 that ``seed`` names."""
    def swap(at: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(r, *seed), n) - at, n)
        heads = F.xxhash64(F.greatest(at, partner), r, *seed).bitwiseAND(F.lit(1)) == 1
        return F.when(heads, partner).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, range(ROUNDS))), x.cast("bigint"), swap)


def unpermuted(x: Column, n: Column, *seed: Column) -> Column:
    """The number whose ``permuted`` place is ``x``: the same swaps backwards."""
    def swap(at: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(r, *seed), n) - at, n)
        heads = F.xxhash64(F.greatest(at, partner), r, *seed).bitwiseAND(F.lit(1)) == 1
        return F.when(heads, partner).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, reversed(range(ROUNDS)))), x.cast("bigint"), swap)


def sizes(documents: DataFrame) -> DataFrame:
    """``row`` (any different numbers), ``doc_id``, ``source``, ``key`` (source, never null), ``size`` in words; stored."""
    return common.stored(_sized(documents), "sizes")


def _sized(documents: DataFrame, *more: Column) -> DataFrame:
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(common.WORD)).cast("bigint")
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    return documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", key.alias("key"), words.alias("size"), *more)


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """A row per source: ``key``, ``source``, ``source_size``, ``weight``, ``target`` (double)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())  # windows over a row per source
    everything = Window.partitionBy()
    to_stop = Window.orderBy("stops_at", F.col("source").asc_nulls_last())
    before = to_stop.rowsBetween(Window.unboundedPreceding, -1)
    since = to_stop.rowsBetween(0, Window.unboundedFollowing)
    most = F.col("source_size") * F.lit(float(cap))
    level = (F.col("all_words") * float(share) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(since)
    return (
        sized.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
        .withColumn("nth", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("nth") % len(weights) + 1).cast("int")))
        .withColumn("most", most)
        .withColumn("stops_at", F.col("most") / F.col("weight"))
        .withColumn("all_words", F.sum("source_size").over(everything))
        .withColumn("level", level)
        .withColumn("level", F.min(F.when(F.col("stops_at") >= F.col("level"), F.struct("stops_at", "nth", "level"))).over(everything)["level"])
        .withColumn("target", F.least("most", F.coalesce(F.col("weight") * F.col("level"), F.col("most"))))
        .select("key", "source", "source_size", "weight", "target")
    )


def draws(goals: DataFrame, block_words: int, seed: int) -> DataFrame:
    """``goals`` with ``blocks``, the words ``take`` to draw, and the number of ``slots`` they fill."""
    size, take = F.col("source_size"), F.col("take")
    rest = F.pmod(take, size)
    short = F.col("blocks") * block_words - size  # words that the last block lacks
    last_at = unpermuted(F.col("blocks") - 1, F.col("blocks"), F.lit(seed), F.col("key"), F.col("passes"))
    beyond = F.greatest(last_at + 1, F.ceil((F.col("rest") + short) / block_words))
    return (
        goals.withColumn("take", F.round("target").cast("bigint")).where("source_size > 0 AND take > 0")
        .withColumn("blocks", F.ceil(size / block_words))
        .withColumn("passes", F.floor(take / size)).withColumn("rest", rest)
        .withColumn("last_at", last_at)
        .withColumn("slots", F.col("passes") * F.col("blocks") + F.when(F.col("rest") <= F.col("last_at") * block_words, F.ceil(F.col("rest") / block_words)).otherwise(beyond))
        .withColumn("first", F.coalesce(F.sum("slots").over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("all_slots", F.sum("slots").over(Window.partitionBy()))
    )


def tasks(spark: SparkSession, all_slots: int) -> int:
    """Tasks that make so many slots: a stated number, which later merging of small partitions leaves alone."""
    return max(spark.sparkContext.defaultParallelism, -(-all_slots // TASK_SLOTS))


def shard_counts(drawn: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """The draw of sources per output shard: ``shard``, ``key``, ``n`` slots, ``before`` (draws of the source in earlier shards), ``lead`` (slots of the shard before them); stored."""
    spark = drawn.sparkSession
    all_slots = drawn.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    steps = (
        drawn.select("key", "first", "slots", "all_slots", F.explode(F.sequence(F.lit(0), F.ceil(F.col("slots") / STEP_SLOTS) - 1)).alias("step"))
        .repartition(tasks(spark, all_slots), "key", "step")
    )
    draw = steps.select("key", "all_slots", F.explode(F.sequence(F.col("first") + F.col("step") * STEP_SLOTS, F.col("first") + F.least((F.col("step") + 1) * STEP_SLOTS, F.col("slots")) - 1)).alias("draw"))
    dealt = draw.withColumn("place", permuted(F.col("draw"), F.col("all_slots"), F.lit(seed), F.lit("mix")))
    counts = dealt.groupBy(F.floor(F.col("place") / shard_slots).alias("shard"), "key").agg(F.count("*").alias("n"))
    counts = common.stored(counts.withColumn("chunk", F.floor(F.col("shard") / SHARD_CHUNK)), "shard-counts")
    earlier = Window.partitionBy("key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)  # a row per chunk of shards
    chunks = counts.groupBy("key", "chunk").agg(F.sum("n").alias("held")).select("key", "chunk", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("chunk_before"))
    in_chunk = Window.partitionBy("key", "chunk").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    in_shard = Window.partitionBy("shard").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    numbered = counts.withColumn("inside", F.coalesce(F.sum("n").over(in_chunk), F.lit(0))).join(chunks, ["key", "chunk"])
    return common.stored(
        numbered.withColumn("before", F.col("chunk_before") + F.col("inside")).withColumn("lead", F.coalesce(F.sum("n").over(in_shard), F.lit(0)))
        .select("shard", "key", "n", "before", "lead"), "shard-draws")


def slots(drawn: DataFrame, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """A row per slot: ``shard``, ``position``, ``key``, ``block``, ``pass``, and ``words`` to take from the block's front."""
    spark = drawn.sparkSession
    counts = shard_counts(drawn, shard_slots, seed)
    all_slots = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n, nth = F.col("blocks"), F.col("nth")
    short = F.when(nth > F.col("last_at"), n * block_words - F.col("source_size")).otherwise(0)
    left = F.when(F.col("pass") < F.col("passes"), F.lit(block_words)).otherwise(F.least(F.lit(block_words), F.col("rest") - (nth * block_words - short)))
    sources = drawn.select("key", "source_size", "blocks", "passes", "rest", "last_at")
    # The join is of a row per shard and source; the slots are made behind it.
    made = (
        counts.join(sources, "key").repartition(tasks(spark, all_slots), "shard", "key")
        .withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
        .withColumn("k", F.col("before") + F.col("i"))
        .withColumn("pass", F.floor(F.col("k") / n)).withColumn("nth", F.col("k") % n)
        .withColumn("size_", F.least(F.lit(shard_slots).cast("bigint"), F.lit(all_slots) - F.col("shard") * shard_slots))
    )
    made = made.withColumn("block", permuted(nth, n, F.lit(seed), F.col("key"), F.col("pass")))
    made = made.withColumn("place", permuted(F.col("lead") + F.col("i"), F.col("size_"), F.lit(seed), F.lit("shard"), F.col("shard")))
    return made.select("shard", (F.col("shard") * shard_slots + F.col("place")).alias("position"), "key", "block", "pass", left.alias("words"))


def parts(sized: DataFrame, block_words: int) -> DataFrame:
    """A row per document and block: where it begins in the block and in the document, and how many words it has there."""
    rows = sized.where("size > 0")
    n_chunks = max(1, -(-rows.count() // CHUNK_ROWS))
    # Chunks follow from the ids alone, but for an id of very many rows, whose rows are spread.
    hot = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("n") > CHUNK_ROWS).select(F.col("doc_id").alias("hot_id"), F.lit(True).alias("hot"))
    spread = F.when(F.col("hot"), F.col("row")).otherwise(F.lit(0))
    chunked = rows.join(hot, F.col("doc_id").eqNullSafe(F.col("hot_id")), "left").withColumn("chunk", F.pmod(F.xxhash64("doc_id", spread), F.lit(n_chunks))).drop("hot_id", "hot")
    totals = chunked.groupBy("key", "chunk").agg(F.sum("size").alias("total"))
    ahead = F.sum("total").over(Window.partitionBy("key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))  # a row per chunk
    chunk_start = totals.select("key", "chunk", F.coalesce(ahead, F.lit(0)).alias("chunk_start"))
    inside = F.sum("size").over(Window.partitionBy("key", "chunk").orderBy("doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, -1))
    begin, end = F.col("start"), F.col("start") + F.col("size")
    low, high = F.greatest(begin, F.col("block") * block_words), F.least(end, (F.col("block") + 1) * block_words)
    return (
        chunked.withColumn("inside", F.coalesce(inside, F.lit(0))).join(chunk_start, ["key", "chunk"])
        .withColumn("start", F.col("chunk_start") + F.col("inside"))
        .withColumn("block", F.explode(F.sequence(F.floor(begin / block_words), F.floor((end - 1) / block_words))))
        .select("row", "doc_id", "key", "block", (low - F.col("block") * block_words).alias("in_block"), (low - begin).alias("in_doc"), (high - low).alias("n"))
    )


def mix(sized: DataFrame, goals: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """The mix: a row per slot and document part in it: ``shard``, ``position``, ``pass``, ``row``, ``doc_id``, ``in_doc`` (first word), ``words``."""
    dealt = slots(draws(goals, block_words, seed), block_words, shard_slots, seed).withColumnRenamed("words", "limit")
    taken = F.least(F.col("n"), F.col("limit") - F.col("in_block"))
    # The hint keeps the slots from a broadcast: what Spark knows of their size is from before they are made.
    return (
        dealt.hint("merge").join(parts(sized, block_words), ["key", "block"]).withColumn("words", taken).where("words > 0")
        .select("shard", "position", "key", "block", "pass", "row", "doc_id", "in_doc", "words")
    )


def taken_words(documents: DataFrame, **how) -> DataFrame:
    """A row per document: ``doc_id``, ``size``, ``source_size``, ``target`` of its source, ``taken`` words, and the ``first_shard`` that takes some."""
    sized = sizes(documents)
    goals = targets(sized)
    taken = mix(sized, goals, **how).groupBy("row").agg(F.sum("words").alias("taken"), F.min("shard").alias("first_shard"))
    by_source = goals.select("key", "source_size", "target")
    return common.gathered(
        sized.join(taken, "row", "left").join(by_source, "key")
        .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), "first_shard"), sized.count()
    )


def mixed_documents(documents: DataFrame, **how) -> DataFrame:
    """The documents as the mix takes them: a row per document and pass, its text cut to the words taken in that pass.

    A text taken whole stays as it is; of others the words taken stay, in order,
    with the blanks behind them, and ``n_chars`` follows.  Rows are in the order of
    the mix: each lies where the first of its slots does.
    """
    spark = documents.sparkSession
    table = common.stored(_sized(documents, F.struct("*").alias("document")), "mix-documents")
    sized = table.select("row", "doc_id", "source", "key", "size")
    spans = (
        mix(sized, targets(sized), **how).groupBy("row", "pass")
        .agg(F.sort_array(F.collect_list(F.struct("in_doc", "words"))).alias("spans"), F.sum("words").alias("taken"), F.min("position").alias("position"))
    )
    whole = F.col("taken") == F.col("size")
    words = F.regexp_extract_all("document.text", F.lit(f"({common.WORD}" + r"[\x20\x09-\x0D]*)"), F.lit(1))
    cut = F.array_join(F.transform("spans", lambda s: F.array_join(F.slice(F.col("words"), (s["in_doc"] + 1).cast("int"), s["words"].cast("int")), "")), "")
    text = F.when(whole, F.col("document.text")).otherwise(F.col("cut"))
    document = F.col("document").withField("text", text)
    if "n_chars" in documents.columns:
        document = document.withField("n_chars", F.when(whole, F.col("document.n_chars")).otherwise(F.length("cut").cast("bigint")))
    joined = table.select("row", "size", "document").join(spans, "row")
    mixed = joined.withColumn("words", F.when(~whole, words)).withColumn("cut", F.when(~whole, cut)).select("position", "row", document.alias("document"))
    # Places are spread evenly over the mix, so equal ranges of them are known without sampling.
    bound = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] * 2 // how.get("block_words", BLOCK_WORDS) + 2
    ranges = max(2 * spark.sparkContext.defaultParallelism, -(-table.count() // common.PARTITION_ROWS))
    part = F.least(F.floor(F.col("position") * ranges / F.lit(bound)), F.lit(ranges - 1)).cast("int")
    return mixed.repartitionById(ranges, part).sortWithinPartitions("position", "row").select("document.*")
