"""Incremental ingestion of JSON access logs with Structured Streaming
(SNK5-SNK7, STR1-STR3).

The file source's checkpoint records every file it has processed, so each
file is read once even when a later file has a smaller path (D3) or two files
share a base name (D4); ``trigger(availableNow=True)`` makes a scheduled job
of it.

The access-log table is a folder ``Generation=.../EventDate=...``: a generation is
what one micro-batch of one checkpoint appends, so a repeated micro-batch
replaces its own rows.  Every row has an ``EventKey``: the ``EventId``, or for
events without one the file, the text and its occurrence there.  Which keys the
table holds is in a key index beside it (``keyindex``, folder
``<table>__keys``): a micro-batch reads filter blocks and the few key buckets that
may hold one of its keys, never the table (STR2).

``dedup_stream`` (STR3) keeps the keys of on-time events in the state store for
as long as the watermark allows, and looks up only late events in the index.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions import jsonlog
from tidepool.sinks.tables import access_log_schema
from tidepool.sources import folders
from tidepool.sources.files import JSON_GLOB, path_exists
from tidepool.streaming import keyindex, late
from tidepool.streaming.runlog import RunLog

BRONZE_SCHEMA = T.StructType([
    T.StructField("RawJson", T.StringType()),
    T.StructField("source_path", T.StringType()),
    T.StructField("landed_at", T.TimestampType()),
])


# A first run over a backlog is cut into micro-batches of about this size.
MAX_BYTES_PER_TRIGGER = 4 << 30


def raw_json_stream(spark: SparkSession, root: str, multiline: bool = True, glob: str = JSON_GLOB,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """STR1 source: new JSON files under ``root`` as (RawJson, source_path).

    A micro-batch holds ``max_files_per_trigger`` files, or without that limit
    about ``MAX_BYTES_PER_TRIGGER``.
    """
    reader = (spark.readStream.format("text")
              .option("recursiveFileLookup", "true")
              .option("pathGlobFilter", glob))
    if multiline:
        reader = reader.option("wholetext", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    else:
        reader = reader.option("maxBytesPerTrigger", str(MAX_BYTES_PER_TRIGGER))
    df = reader.load(root)
    return df.select(F.col("value").alias("RawJson"), F.col("_metadata.file_path").alias("source_path"))


class NoInputFilesError(FileNotFoundError):
    """Strict mode: the source folder holds no matching file."""


def _require_files(spark: SparkSession, root: str, glob: str) -> None:
    from tidepool.sources.files import list_files

    if not path_exists(spark, root) or list_files(spark, root, glob).limit(1).count() == 0:
        raise NoInputFilesError(f"no JSON files under {root}")


def land_files(spark: SparkSession, root: str, bronze_path: str, checkpoint: str,
               multiline: bool = True, max_files_per_trigger: int | None = None) -> None:
    """SNK5-SNK7: copy the text of every not-yet-seen JSON file to the bronze table."""
    src = (raw_json_stream(spark, root, multiline, max_files_per_trigger=max_files_per_trigger)
           .withColumn("landed_at", F.current_timestamp()))
    late.run(src.writeStream.format("parquet").option("path", bronze_path)
         .option("checkpointLocation", checkpoint).outputMode("append"))


def event_keys(batch: DataFrame, key: str = "EventId", path: str = "source_path") -> DataFrame:
    """``batch`` with ``EventKey``, one row per key: of events with one id the
    first by time and text; of events without an id all, told apart by file,
    text and occurrence."""
    order = [c for c in ("EventTimeUtc", "RawJson", path) if c in batch.columns and c != key] or [key]
    told = [F.col(c) for c in batch.columns if c not in (key, "IngestedTimeUtc")]
    own = F.coalesce(F.concat(F.lit("id:"), F.col(key).cast("string")),
                     F.concat(F.lit("text:"), F.sha2(F.to_json(F.struct(*told)), 256)))
    unnamed = F.col(key).isNull()
    return (batch.withColumn("EventKey", own)
            .withColumn("_n", F.row_number().over(Window.partitionBy("EventKey").orderBy(*order)))
            .where(unnamed | (F.col("_n") == 1))
            .withColumn("EventKey", F.when(unnamed, F.concat_ws(":", "EventKey", F.col("_n").cast("string")))
                        .otherwise(F.col("EventKey"))).drop("_n"))


def index_of(target_path: str) -> str:
    """The key index of a table."""
    return f"{target_path.rstrip('/')}__keys"


def owner_of(checkpoint: str) -> str:
    """Short name of the job that a checkpoint belongs to."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:10]


#: Files of a date that one micro-batch writes at most where Spark can't size them itself.
FILES_PER_DATE = 8


def _by_date(rows: DataFrame) -> DataFrame:
    """Rows clustered by date, large dates split, so that a batch writes few files per date.

    ``rebalance`` needs adaptive execution, which Spark turns off in a stateful stream:
    there every shuffle partition would write a file per date, so the dates are dealt out here."""
    if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return rows.hint("rebalance", "EventDate")
    return rows.repartition("EventDate", F.pmod(F.xxhash64(keyindex.KEY), F.lit(FILES_PER_DATE)))


def _append(rows: DataFrame, target_path: str, owner: str, generation: str) -> int:
    """Write one generation of the table, then enter its keys in the index; returns the rows observed."""
    spark, index = rows.sparkSession, index_of(target_path)
    folder = f"{target_path.rstrip('/')}/Generation={generation}"
    seen = Observation("appended")
    observed = _by_date(rows).observe(seen, F.count(F.lit(1)).alias("rows"))
    observed.write.mode("overwrite").partitionBy("EventDate").parquet(folder)
    written = int(seen.get["rows"])
    _enter(spark, index, folder, owner, generation, written)
    return written


def _enter(spark: SparkSession, index: str, folder: str, owner: str, generation: str, rows: int | None = None) -> None:
    keys = spark.read.schema(keyindex.KEYS).parquet(folder).select(keyindex.KEY)
    keyindex.add(keys, index, owner, generation, count=rows)
    folders.mark(spark, f"{index}/entered/{generation}")


def _catch_up(spark: SparkSession, target_path: str, generation: str) -> None:
    """Merge the index where it has grown, and enter generations whose append was cut off before its last step."""
    index = index_of(target_path)
    entered = set(folders.children(spark, f"{index}/entered"))
    for name in folders.values(spark, target_path, "Generation"):
        if name not in entered and name != generation:
            _enter(spark, index, f"{target_path.rstrip('/')}/Generation={name}", name.rpartition("-")[0] or name, name)
    keyindex.merge(spark, index, keep=generation)


def append_unseen(batch: DataFrame, target_path: str, owner: str, generation: str, besides: str | None = None) -> int:
    """Append the rows of ``batch`` (with ``EventKey`` and ``EventDate``, one per key) that the index doesn't know.

    What a failed attempt of the same generation wrote is replaced; generations of
    the owner ``besides`` are not looked up.  Returns the number of rows appended."""
    spark, index = batch.sparkSession, index_of(target_path)
    if path_exists(spark, f"{target_path}/_spark_metadata"):
        raise ValueError(f"{target_path} was written by a file sink, whose log hides other files: take a new target and checkpoint")
    _catch_up(spark, target_path, generation)
    known = [g for g in keyindex.generations(spark, index) if g.name != generation and g.owner != besides]
    if not known:  # nothing to look up: the rows are read once, straight into the table
        return _append(keyindex.unseen(batch, index, known), target_path, owner, generation)
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _append(keyindex.unseen(batch, index, known), target_path, owner, generation)
    finally:
        batch.unpersist()


def dated(batch: DataFrame) -> DataFrame:
    """With the table's ``EventDate``."""
    return batch.withColumn("EventDate", F.to_date("EventTimeUtc"))


def as_generation(flat: DataFrame, generation: str, key: str = "EventId") -> DataFrame:
    """Flattened events with the table's other columns, one row per key, for an append through the catalog."""
    columns = [f.name for f in access_log_schema().fields]
    return event_keys(dated(flat), key).withColumn("Generation", F.lit(generation)).select(*columns)


def idempotent_append(batch: DataFrame, target_path: str, key: str = "EventId", checkpoint: str | None = None, batch_id: int = 0) -> int:
    """STR2: append the events whose key is not yet in the target; returns how many.

    ``checkpoint`` and ``batch_id`` name the generation, which a repeated micro-batch replaces."""
    owner = owner_of(checkpoint or uuid.uuid4().hex)
    return append_unseen(event_keys(dated(batch), key).drop("source_path"), target_path, owner, f"{owner}-{batch_id:09d}")


def normalise_stream(spark: SparkSession, root: str, target_path: str, checkpoint: str,
                     multiline: bool = True, duration_precision: str = "milli",
                     max_files_per_trigger: int | None = None, require_files: bool = False,
                     log: RunLog | None = None, glob: str = JSON_GLOB) -> None:
    """STR1 + STR2: files -> 31-column access-log table, appended without duplicates.

    ``max_files_per_trigger`` bounds a micro-batch (the reference lists at most
    200,000 files per run); ``availableNow`` still drains every file, batch by batch.
    ``require_files`` raises ``NoInputFilesError`` when ``root`` holds no JSON file
    (strict mode); otherwise an empty source simply appends nothing.  With
    ``log``, which must be listening, every micro-batch has its row in the run log.
    """
    if require_files:
        _require_files(spark, root, glob)
    src = raw_json_stream(spark, root, multiline, glob, max_files_per_trigger)
    flat = jsonlog.flatten_access_log(src, duration_precision=duration_precision, carry=["source_path"])

    def sink(batch: DataFrame, batch_id: int) -> None:
        written = idempotent_append(batch, target_path, checkpoint=checkpoint, batch_id=batch_id)
        if log is not None:
            log.note_written(batch_id, written)

    late.run(flat.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint), name=log and log.job)


def normalise_bronze(spark: SparkSession, bronze_path: str, target_path: str, checkpoint: str) -> None:
    """STR1 from the bronze table instead of the raw files."""
    src = spark.readStream.schema(BRONZE_SCHEMA).parquet(bronze_path)
    flat = jsonlog.flatten_access_log(src, carry=["source_path"])

    def sink(batch: DataFrame, batch_id: int) -> None:
        idempotent_append(batch, target_path, checkpoint=checkpoint, batch_id=batch_id)

    late.run(flat.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint))


def dedup_stream(spark: SparkSession, root: str, target_path: str, checkpoint: str,
                 multiline: bool = True, delay: str = "1 hour",
                 max_files_per_trigger: int | None = None, glob: str = JSON_GLOB) -> list[dict]:
    """STR3 job: files -> flatten -> dedup within the watermark -> access-log table.

    Every event is kept once, however the files fall into micro-batches and in
    whatever order of time they come.  Each micro-batch is dealt in two by the
    watermark that holds for it, the latest event of the micro-batches before it
    less ``delay``:

    * events from the watermark on go through the state store
      (``dropDuplicatesWithinWatermark``), which holds their keys until the
      watermark is ``delay`` past them; the table is not read for them, only the
      index of what other jobs and the late part have appended;
    * late events, and those without a valid time, which have no place in a
      watermark, are looked up in the index of all keys, so being late loses none.

    The dealt events are staged below the checkpoint, and each part is a stream of
    its own with its own checkpoint; a staged micro-batch is deleted when both are
    done with it.  Returns the progress of the stateful stream, one per micro-batch.
    """
    own = owner_of(checkpoint)
    src = raw_json_stream(spark, root, multiline, glob, max_files_per_trigger)
    flat = jsonlog.flatten_access_log(src, carry=["source_path"])
    schema = T.StructType([f for f in flat.schema.fields if f.name != "source_path"]).add("EventKey", "string").add("EventDate", "date")
    progress: list[dict] = []

    def keyed(batch: DataFrame) -> DataFrame:
        # An id without a time tells nothing about copies: such events are told apart by their text.
        named = dated(batch).withColumn("_id", F.when(F.col("EventTimeUtc").isNotNull(), F.col("EventId")))
        return event_keys(named, "_id").drop("_id", "source_path")

    def on_time() -> None:
        events = (late.part(spark, checkpoint, schema, late=False)
                  .withWatermark("EventTimeUtc", delay).dropDuplicatesWithinWatermark(["EventKey"]))

        def sink(batch: DataFrame, n: int) -> None:
            if not batch.isEmpty():
                append_unseen(batch, target_path, f"{own}t", f"{own}t-{n:09d}", besides=f"{own}t")

        query = late.run(events.writeStream.foreachBatch(sink).option("checkpointLocation", f"{checkpoint}/on-time"))
        progress.extend(query.recentProgress)

    def behind() -> None:
        def sink(batch: DataFrame, n: int) -> None:
            first = Window.partitionBy("EventKey").orderBy("EventTimeUtc", "RawJson")
            once = batch.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
            append_unseen(once, target_path, f"{own}l", f"{own}l-{n:09d}")

        late.run(late.part(spark, checkpoint, schema, late=True).writeStream.foreachBatch(sink).option("checkpointLocation", f"{checkpoint}/late"))

    late.run_dealt(spark, flat, checkpoint, keyed, [on_time, behind], delay)
    return progress
