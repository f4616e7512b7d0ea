"""Exact deduplication as a stream: keyed state on disk that never expires, and full bytes checked on every hit.

Two streaming queries, each with its own checkpoint, and a check.

``land`` reads the documents as they arrive.  A task takes the blanks out of each
text, hashes what is left and writes it, once for all equal texts of the task,
into a content file in the shared folder; per document it yields the digest, the
stable identifier (id, and the place in the task's output) and the locator
(file, offset, length) of the content.  Only these narrow rows are kept in the
landed table.

``settle`` reads that table into a stateful aggregation keyed by digest.  Its
state lies in RocksDB, goes to the checkpoint with every micro-batch and never
expires: the locator of the first content, the identifier of the best row and the
number of rows.  Rows are aggregated before they are shuffled, so that a group of
copies costs a row per task, however large it is.  Every micro-batch puts out
the new state of the digests that it touched.

``check`` then takes every content that came to a digest seen before, a hit,
and compares it byte by byte with the first one.  Digests alone thus never drop a
text: where bytes differ, that digest's texts are told apart by their bytes.

A later run over the same folder goes on where the last one ended; ``resolved``
gives every landed document its group.

Every micro-batch writes a folder of its own, and writes it anew when it is
repeated.  Content files that a lost task attempt wrote are named by no row; they
all are read only by the runs that follow.

Defined cases: a null text is an empty one; texts of blanks only are equal to
it; of equal texts the longest original stays, then the smallest id (null
last), then the first place of rows that are alike, so exactly one row of a
group is kept, of repeated rows too; no documents give no rows; other columns
are not read, so their names don't matter; texts are written and compared whole,
one at a time.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import common

BLANKS = b" \t\n\v\f\r"
CODEC = "zstd"
#: Bytes of new input of a micro-batch of ``land``, and of distinct texts that one of its tasks remembers.
TRIGGER_BYTES = 64 << 30
HELD_BYTES = 64 << 20
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

LANDED = "doc_id bigint, chars bigint, digest string, place bigint, file string, at bigint, stored bigint, length bigint"
LANDED_SCHEMA = pa.schema([("doc_id", pa.int64()), ("chars", pa.int64()), ("digest", pa.string()), ("place", pa.int64()), ("file", pa.string()),
                           ("at", pa.int64()), ("stored", pa.int64()), ("length", pa.int64())])
_LOCATOR = "struct<batch: bigint, file: string, at: bigint, stored: bigint, length: bigint>"
_BEST = "struct<shortness: bigint, unnamed: boolean, doc_id: bigint, file: string, place: bigint>"
SETTLED = f"digest string, group_size bigint, best {_BEST}, first {_LOCATOR}"
#: Where bytes of equal digests differ: each content's variant of its digest, its rows and the best of them.
VARIANTS = f"digest string, file string, at bigint, variant int, rows bigint, best {_BEST}"


def sha256(content: bytes) -> str:
    return hashlib.sha256(content).hexdigest()


def normalised(text: bytes) -> bytes:
    """The text without its blanks (0x20, 0x09-0x0D)."""
    return text.translate(None, BLANKS)


class Contents:
    """Reads contents back by locator; the last file stays open."""

    def __init__(self):
        self.uri = self.file = None

    def read(self, uri: str, at: int, stored: int, length: int) -> bytes:
        if uri != self.uri:
            filesystem, path = common.store_files(uri)
            self.uri, self.file = uri, filesystem.open_input_file(path)
        return pa.decompress(self.file.read_at(stored, at), decompressed_size=length, codec=CODEC, asbytes=True) if length else b""


def _landed(documents: DataFrame, folder: str, id_col: str, text_col: str, digest: Callable[[bytes], str]) -> DataFrame:
    """``LANDED`` of every document, its content written below ``folder``."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.texts"
        out, end, place, held, held_bytes = None, 0, 0, {}, 0
        for batch in batches:
            rows = []
            chars = pc.fill_null(pc.utf8_length(batch["t"]), 0).to_pylist()
            for doc_id, text, n in zip(batch["id"].to_pylist(), batch["t"].cast(pa.binary()).to_pylist(), chars):
                content = normalised(text or b"")
                name = digest(content)
                known = held.get((name, content))
                if known is None:
                    if out is None:
                        filesystem, path = common.store_files(uri)
                        filesystem.create_dir(path.rpartition("/")[0], recursive=True)
                        out = filesystem.open_output_stream(path, compression=None)
                    raw = pa.compress(content, codec=CODEC, asbytes=True) if content else b"\0"  # an offset of its own
                    out.write(raw)
                    known = (uri, end, len(raw), len(content))
                    end += len(raw)
                    held_bytes += len(content)
                    if held_bytes > HELD_BYTES:
                        held, held_bytes = {}, len(content)
                    held[name, content] = known
                rows.append((doc_id, n, name, place, *known))
                place += 1
            yield from common.batches(iter(rows), LANDED_SCHEMA)
        if out is not None:
            out.close()

    rows = documents.select(common.column(documents, id_col).cast("bigint").alias("id"), common.column(documents, text_col).cast("string").alias("t"))
    return rows.mapInArrow(write, LANDED)


def _best() -> Column:
    """Order of the rows of a group: the smallest stays (most code points, smallest id with null last, first place)."""
    return F.struct((-F.col("chars")).alias("shortness"), F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("file"), F.col("place"))


def _settled(landed: DataFrame) -> DataFrame:
    """State of every digest of the stream that a micro-batch touches."""
    locator = F.struct("batch", "file", "at", "stored", "length")
    return landed.groupBy("digest").agg(F.count("*").alias("group_size"), F.min(_best()).alias("best"), F.min(locator).alias("first"))


def _drained(df: DataFrame, mode: str, folder: str, checkpoint: str) -> None:
    """Run a query over all that is there; micro-batch n goes to ``folder/batch=n``."""
    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={n}")

    query = df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _stateful(spark: SparkSession) -> SparkSession:
    """A session of its own, so that no setting of the caller's changes: state in RocksDB, its changes uploaded per micro-batch."""
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # Room for logs isn't allocated ahead: with many partitions that is most of the disk.
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    return own


def _groups(spark: SparkSession, base: str) -> DataFrame:
    """The last state of every digest: a group only grows, so it is the one of the largest size."""
    settled = spark.read.schema(SETTLED).parquet(f"{base}/settled")
    return settled.groupBy("digest").agg(F.max(F.struct("group_size", "best", "first")).alias("g")).select("digest", "g.*")


def _landed_rows(spark: SparkSession, base: str, after: int = -1) -> DataFrame:
    """Landed rows, of micro-batches later than ``after``."""
    return spark.read.schema(LANDED + ", batch bigint").parquet(f"{base}/landed").where(F.col("batch") > after)


def _check(spark: SparkSession, base: str) -> None:
    """Compare the contents of unchecked hits with their digest's first; write the variants of digests where one differs."""
    done = spark.read.parquet(f"{base}/checked").agg(F.max("batch")).first()[0] if _exists(f"{base}/checked") else -1
    last = _landed_rows(spark, base, done).agg(F.max("batch")).first()[0]
    if last is None:
        return
    new = _landed_rows(spark, base, done).select("digest", "file", "at", "stored", "length").distinct()
    firsts = _groups(spark, base).where("group_size > 1").select("digest", "first")
    locator = [F.col(f"first.{c}").alias(f"first_{c}") for c in ("file", "at", "stored", "length")]
    hits = new.join(firsts, "digest").where("file <> first.file OR at <> first.at").select("digest", "file", "at", "stored", "length", *locator)

    def differing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            own, first, known, content = Contents(), Contents(), None, b""
            for batch in batches:
                for digest, file, at, stored, length, *locator in zip(*(c.to_pylist() for c in batch.columns)):
                    if length == locator[3] and locator != known:
                        known, content = locator, first.read(*locator)
                    if length != locator[3] or own.read(file, at, stored, length) != content:
                        yield (digest,)

        yield from common.batches(rows(), pa.schema([("digest", pa.string())]))

    # Dealt by file: a task reads a few files in order, and the hits of one digest are spread.
    ordered = hits.repartitionByRange("file", "at").sortWithinPartitions("file", "at")
    ordered.mapInArrow(differing, "digest string").distinct().write.mode("overwrite").parquet(f"{base}/differing/batch={last}")
    differ = spark.read.schema("digest string").parquet(f"{base}/differing").distinct()
    if not differ.isEmpty():
        rows = _landed_rows(spark, base).join(differ, "digest")
        folded = rows.groupBy("digest", "file", "at", "stored", "length").agg(F.count("*").alias("rows"), F.min(_best()).alias("best"))
        told = folded.groupBy("digest").applyInPandas(_told_apart, "digest string, file string, at bigint, variant int")
        (told.join(folded.select("file", "at", "rows", "best"), ["file", "at"]).select("digest", "file", "at", "variant", "rows", "best")
         .write.mode("overwrite").parquet(f"{base}/variants/batch={last}"))
    spark.range(1).select(F.lit(last).cast("bigint").alias("batch")).write.mode("append").parquet(f"{base}/checked")


def _told_apart(key: tuple, contents: pd.DataFrame) -> pd.DataFrame:
    """The contents of one digest by their bytes: the first of each variant is read again for each of the same length."""
    reader, first, variants = Contents(), [], []
    for row in contents.sort_values(["file", "at"]).itertuples(index=False):
        content = reader.read(row.file, int(row.at), int(row.stored), int(row.length))
        for v, other in enumerate(first):
            if other[3] == row.length and reader.read(*other) == content:
                break
        else:
            v = len(first)
            first.append((row.file, int(row.at), int(row.stored), int(row.length)))
        variants.append((key[0], row.file, int(row.at), v))
    return pd.DataFrame(variants, columns=["digest", "file", "at", "variant"])


def _exists(uri: str) -> bool:
    from pyarrow import fs

    filesystem, path = common.store_files(uri)
    return filesystem.get_file_info(path).type != fs.FileType.NotFound


def run(spark: SparkSession, documents: Callable[[SparkSession], DataFrame], base: str, id_col: str = "doc_id", text_col: str = "text",
        digest: Callable[[bytes], str] = sha256, files_per_trigger: int | None = None) -> None:
    """Drain what is new in the stream ``documents(session)`` into the tables below ``base`` (a URI in the shared folder)."""
    own = _stateful(spark)
    _drained(_landed(documents(own), f"{base}/contents", id_col, text_col, digest), "append", f"{base}/landed", f"{base}/landing-checkpoint")
    if not _exists(f"{base}/landed"):
        return
    new = own.readStream.schema(LANDED + ", batch bigint")
    if files_per_trigger:
        new = new.option("maxFilesPerTrigger", str(files_per_trigger))
    _drained(_settled(new.parquet(f"{base}/landed")), "update", f"{base}/settled", f"{base}/settling-checkpoint")
    _check(spark, base)


def resolved(spark: SparkSession, base: str) -> DataFrame:
    """Every landed document with its group: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``digest``, ``variant``."""
    if not _exists(f"{base}/settled"):
        return spark.createDataFrame([], "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, digest string, variant int")
    landed = _landed_rows(spark, base).select("doc_id", "digest", "place", "file", "at")
    # By way of the contents: a digest with very many rows has few of them, and each has the rows of one task at most.
    contents = landed.select("digest", "file", "at").distinct().join(_groups(spark, base), "digest").select("digest", "file", "at", F.lit(0).alias("variant"), "group_size", "best")
    if _exists(f"{base}/variants"):
        told = spark.read.schema(VARIANTS + ", batch bigint").parquet(f"{base}/variants")
        last = told.groupBy("digest", "file", "at").agg(F.max(F.struct("batch", "variant", "rows", "best")).alias("t")).select("digest", "file", "at", "t.*").drop("batch")
        groups = last.groupBy("digest", "variant").agg(F.sum("rows").alias("group_size"), F.min("best").alias("best"))
        apart = last.select("digest", "file", "at", "variant").join(groups, ["digest", "variant"])
        contents = contents.join(apart.select("digest").distinct(), "digest", "left_anti").unionByName(apart)
    kept = (F.col("file") == F.col("best.file")) & (F.col("place") == F.col("best.place"))
    return landed.drop("digest").join(contents, ["file", "at"]).select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), "digest", "variant")


def drop_contents(base: str) -> None:
    """Delete the content files of a folder that no later run goes on with."""
    if _exists(f"{base}/contents"):
        filesystem, path = common.store_files(f"{base}/contents")
        filesystem.delete_dir(path)


def stream_of(path: str, trigger_bytes: int = TRIGGER_BYTES, files_per_trigger: int | None = None) -> Callable[[SparkSession], DataFrame]:
    """The Parquet files of a folder (or one file) as a stream."""
    def read(spark: SparkSession) -> DataFrame:
        reader = spark.readStream.schema(spark.read.parquet(path).schema)
        limit = ("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else ("maxBytesPerTrigger", trigger_bytes)
        # Spark takes a plain path for a folder; a pattern that only this path fits may be a file too.
        whole = path.rstrip("/")
        return reader.option(limit[0], str(limit[1])).parquet(f"{whole[:-1]}[{whole[-1]}]")

    return read


def deduplicated(spark: SparkSession, documents: Callable[[SparkSession], DataFrame], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One run from nothing in a folder of its own: ``resolved`` of every document."""
    base = common.scratch_uri(spark, "exact-dedup")
    run(spark, documents, base, id_col, text_col)
    drop_contents(base)
    return resolved(spark, base)
