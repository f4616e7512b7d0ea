"""Ingestion queries: events are written by Spark as diagnostic JSON files into
a scratch folder under the shared checkpoint folder, then ingested by the
streaming jobs (SRC3, SRC4, SNK5-SNK7, STR1-STR3, FLT2, FLT3)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tidepool.functions import jsonlog
from tidepool.plans.registry import query
from tidepool.session import scratch_path
from tidepool.sources import derived, files, tables
from tidepool.streaming import ingest

# Events before this instant arrive in the first delivery, the rest later.
SECOND_DELIVERY_FROM = "2024-01-16 00:00:00"

_FLAT_COLS = [n for n, p, _ in jsonlog.ACCESS_LOG_COLUMNS if p is not None]


def _events(spark, sf_dir):
    return tables.load(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])


def _write_docs(df, folder):
    derived.diagnostic_docs(df).write.mode("overwrite").json(folder)


def _deliver(spark, sf_dir, root, which="all"):
    ev = _events(spark, sf_dir)
    first = F.col("ts") < F.lit(SECOND_DELIVERY_FROM).cast("timestamp_ntz")
    if which in ("all", "first"):
        _write_docs(ev.where(first), os.path.join(root, "delivery_1"))
    if which in ("all", "second"):
        _write_docs(ev.where(~first), os.path.join(root, "delivery_2"))


@query("ingest_twice_rows", "STR1,STR2,SRC3,SRC4,SNK5,SNK7,D5", sql=derived.diagnostic_flat_sql())
def ingest_twice_rows(spark, sf_dir):
    """Ingesting the same files twice gives every event exactly once."""
    base = scratch_path(spark, "ingest-twice")
    root, target, ck = (os.path.join(base, x) for x in ("src", "target", "ck"))
    _deliver(spark, sf_dir, root)
    for _ in range(2):
        ingest.normalise_stream(spark, root, target, ck, multiline=False)
    return spark.read.parquet(target).select(*_FLAT_COLS)


@query("incremental_new_only", "STR1,STR2,SNK6,FLT2,D3", sql=f"""
SELECT CAST(event_id AS VARCHAR) AS EventId, 'Access.' || event_type AS EventType
FROM events WHERE ts >= TIMESTAMP '{SECOND_DELIVERY_FROM}'
""")
def incremental_new_only(spark, sf_dir):
    """The second run picks up only the second delivery's files."""
    base = scratch_path(spark, "incremental")
    root, target, ck, snap = (os.path.join(base, x) for x in ("src", "target", "ck", "after_run_1"))
    _deliver(spark, sf_dir, root, "first")
    ingest.normalise_stream(spark, root, target, ck, multiline=False)
    spark.read.parquet(target).select("EventId").write.parquet(snap)
    _deliver(spark, sf_dir, root, "second")
    ingest.normalise_stream(spark, root, target, ck, multiline=False)
    after = spark.read.parquet(target)
    return after.join(spark.read.parquet(snap), "EventId", "left_anti").select("EventId", "EventType")


@query("land_bronze_twice", "SNK5,SNK6,SNK7,SRC4,D4", sql="""
SELECT 'Access.' || event_type AS EventType, count(*) AS n_docs FROM events GROUP BY event_type
""")
def land_bronze_twice(spark, sf_dir):
    """Landing twice copies each file's text once; bronze keeps the raw text."""
    base = scratch_path(spark, "landing")
    root, bronze, ck = (os.path.join(base, x) for x in ("src", "bronze", "ck"))
    _deliver(spark, sf_dir, root)
    for _ in range(2):
        ingest.land_files(spark, root, bronze, ck, multiline=False)
    b = spark.read.parquet(bronze)
    return (jsonlog.extract(b, {"EventType": "$.type"})
            .groupBy("EventType").agg(F.count(F.lit(1)).alias("n_docs")))


@query("stream_dedup", "STR3", sql="""
SELECT CAST(event_id AS VARCHAR) AS EventId, ts AS EventTimeUtc FROM events
""")
def stream_dedup(spark, sf_dir):
    """Every event delivered twice; the watermark dedup keeps one of each."""
    base = scratch_path(spark, "dedup")
    root, target, ck = (os.path.join(base, x) for x in ("src", "target", "ck"))
    ev = _events(spark, sf_dir)
    derived.deliver(derived.diagnostic_docs(ev), os.path.join(root, "copy_1"))
    derived.deliver(derived.diagnostic_docs(ev), os.path.join(root, "copy_2"))
    ingest.dedup_stream(spark, root, target, ck, multiline=False, max_files_per_trigger=derived.DELIVERED_FILES, glob=files.GZIP_GLOB)
    return spark.read.parquet(target).select("EventId", "EventTimeUtc")


@query("list_json_files", "SRC3,FLT3,SRT4,AGG7,SRC8", sql=f"""
SELECT delivery, true AS exists_, true AS json_only, true AS sorted_, count(*) AS n_docs FROM (
  SELECT CASE WHEN ts < TIMESTAMP '{SECOND_DELIVERY_FROM}' THEN 'delivery_1' ELSE 'delivery_2' END AS delivery FROM events)
GROUP BY delivery
""")
def list_json_files(spark, sf_dir):
    """Recursive discovery of the delivered JSON files, sorted; documents per delivery folder."""
    base = scratch_path(spark, "listing")
    _deliver(spark, sf_dir, base)
    listed = files.list_files(spark, base)
    # In the listing's own order: each partition's paths after the one before (a row per partition comes back).
    placed = listed.select("path", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i"))
    ends = placed.groupBy("p").agg(F.min("path").alias("low"), F.max("path").alias("high"), F.min_by("path", "i").alias("first"), F.max_by("path", "i").alias("last"),
                                   F.bool_and(F.lower("path").endswith(".json")).alias("json")).orderBy("p").collect()
    in_order = all(r.low == r.first and r.high == r.last for r in ends) and all(a.high <= b.low for a, b in zip(ends, ends[1:]))
    folder = F.element_at(F.split("source_path", "/"), -2)
    docs = files.read_raw_json(spark, base, multiline=False)
    return docs.groupBy(folder.alias("delivery")).agg(
        F.lit(files.path_exists(spark, base)).alias("exists_"), F.lit(all(r.json for r in ends)).alias("json_only"),
        F.lit(in_order).alias("sorted_"), F.count(F.lit(1)).alias("n_docs"))


def _unnamed(df):
    """Documents of odd events without their id."""
    return df.withColumn("id", F.when(F.col("id").cast("bigint") % 2 == 0, F.col("id")))


@query("ingest_events_without_id", "STR1,STR2,D5", sql="""
SELECT CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) END AS EventId, ts AS EventTimeUtc, 'item-' || CAST(user_id AS VARCHAR) AS ItemId
FROM events
""")
def ingest_events_without_id(spark, sf_dir):
    """Half of the documents have no id: all are kept, and a replay with a fresh checkpoint adds none."""
    base = scratch_path(spark, "no-id")
    root, target = os.path.join(base, "src"), os.path.join(base, "target")
    derived.deliver(_unnamed(derived.diagnostic_docs(_events(spark, sf_dir))), root)
    for run in range(2):
        ingest.normalise_stream(spark, root, target, os.path.join(base, f"ck_{run}"), multiline=False, max_files_per_trigger=derived.DELIVERED_FILES, glob=files.GZIP_GLOB)
    return spark.read.parquet(target).select("EventId", "EventTimeUtc", "ItemId")


@query("ingest_id_on_two_dates", "STR1,STR2,D5,D11", sql="""
SELECT CAST(event_id AS VARCHAR) AS EventId, ts AS EventTimeUtc FROM events
""")
def ingest_id_on_two_dates(spark, sf_dir):
    """Every event comes again a week later under the same id: the first delivery's row stays alone."""
    base = scratch_path(spark, "two-dates")
    root, target, ck = (os.path.join(base, x) for x in ("src", "target", "ck"))
    ev = _events(spark, sf_dir)
    derived.deliver(derived.diagnostic_docs(ev), os.path.join(root, "first"))
    ingest.normalise_stream(spark, root, target, ck, multiline=False, max_files_per_trigger=derived.DELIVERED_FILES, glob=files.GZIP_GLOB)
    derived.deliver(derived.diagnostic_docs(ev.withColumn("ts", F.col("ts") + F.expr("INTERVAL 7 DAYS"))), os.path.join(root, "later"))
    ingest.normalise_stream(spark, root, target, ck, multiline=False, max_files_per_trigger=derived.DELIVERED_FILES, glob=files.GZIP_GLOB)
    return spark.read.parquet(target).select("EventId", "EventTimeUtc")


@query("stream_dedup_malformed_time", "STR3", sql="""
SELECT CAST(event_id AS VARCHAR) AS EventId, CASE WHEN event_id % 7 NOT IN (1, 2) THEN ts END AS EventTimeUtc
FROM events
""")
def stream_dedup_malformed_time(spark, sf_dir):
    """Events whose time can't be read have no place in the watermark, and are kept."""
    base = scratch_path(spark, "dedup-damaged")
    root, target, ck = (os.path.join(base, x) for x in ("src", "target", "ck"))
    derived.diagnostic_docs(_events(spark, sf_dir), damaged=True).write.json(root)
    ingest.dedup_stream(spark, root, target, ck, multiline=False)
    return spark.read.parquet(target).select("EventId", "EventTimeUtc")


@query("files_newer_than_mark", "FLT2,SRC3,SNK6,FN7", sql=f"""
SELECT CAST(event_id AS VARCHAR) AS EventId, true AS stamped FROM events WHERE ts >= TIMESTAMP '{SECOND_DELIVERY_FROM}'
""")
def files_newer_than_mark(spark, sf_dir):
    """Only files whose path comes after the first delivery's last one; every row has its ingestion time."""
    base = scratch_path(spark, "newer")
    _deliver(spark, sf_dir, base, "first")
    mark = files.list_files(spark, base).agg(F.max("path")).first()[0]
    _deliver(spark, sf_dir, base, "second")
    # The filter is on the file's path, a column of the scan: no list of files passes the driver.
    newer = files.newer_than(files.read_raw_json(spark, base, multiline=False), mark, "source_path")
    flat = jsonlog.flatten_access_log(newer)
    return flat.select("EventId", F.col("IngestedTimeUtc").isNotNull().alias("stamped"))


@query("multi_line_documents", "SRC4,PRJ1", sql="""
SELECT CAST(event_id AS VARCHAR) AS EventId, 'Access.' || event_type AS EventType, 'item-' || CAST(user_id AS VARCHAR) AS ItemId FROM events
""")
def multi_line_documents(spark, sf_dir):
    """Files that hold pretty-printed documents over many lines (an array of up to 1,000 each), read by the multi-line reader."""
    base = scratch_path(spark, "multi-line")
    docs = derived.diagnostic_docs(_events(spark, sf_dir))
    text = F.to_json(F.struct(*docs.columns), {"pretty": "true"})
    group = F.floor(F.col("id").cast("bigint") / 1000)
    arrays = docs.select(group.alias("g"), text.alias("t")).groupBy("g").agg(
        F.concat(F.lit("[\n"), F.concat_ws(",\n", F.collect_list("t")), F.lit("\n]")).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(base)  # a file per array, in one folder
    typed = files.read_json_typed(spark, base, jsonlog.TYPED_STRUCT, multiline=True, glob="*.txt")
    return typed.select(F.col("id").alias("EventId"), F.col("type").alias("EventType"), F.col("data.itemId").alias("ItemId"))


@query("ingest_twice_count", "STR1,STR2,SNK7,AGG7", sql="""
SELECT 'Access.' || event_type AS EventType, count(*) AS n_events FROM events GROUP BY event_type
""")
def ingest_twice_count(spark, sf_dir):
    """Counts per event type after ingesting the same delivery twice."""
    base = scratch_path(spark, "ingest-count")
    root, target, ck = (os.path.join(base, x) for x in ("src", "target", "ck"))
    _deliver(spark, sf_dir, root)
    for _ in range(2):
        ingest.normalise_stream(spark, root, target, ck, multiline=False)
    return (spark.read.parquet(target).groupBy("EventType")
            .agg(F.count(F.lit(1)).alias("n_events")))


@query("bronze_to_silver", "SNK5,STR1,STR2,SNK8", sql=derived.diagnostic_flat_sql())
def bronze_to_silver(spark, sf_dir):
    """Land raw files in bronze, then normalise the bronze table into silver."""
    base = scratch_path(spark, "medallion")
    root = os.path.join(base, "src")
    bronze, silver = os.path.join(base, "bronze", "diagnostics_raw"), os.path.join(base, "silver", "log_event_access")
    _deliver(spark, sf_dir, root)
    ingest.land_files(spark, root, bronze, os.path.join(base, "control", "ck_landing"), multiline=False)
    ingest.normalise_bronze(spark, bronze, silver, os.path.join(base, "control", "ck_normalise"))
    return spark.read.parquet(silver).select(*_FLAT_COLS)
