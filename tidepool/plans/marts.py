"""Declared-only reporting tables (DCL2-DCL4) over the derived access log."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tidepool.functions import jsonlog
from tidepool.operators import marts, merge
from tidepool.plans.registry import REGISTRY, query
from tidepool.session import scratch_path, stored
from tidepool.sinks import tables as sinks
from tidepool.sources import derived, files, tables
from tidepool.streaming import ingest, sessions
from tidepool.streaming.runlog import RunLog

_FLAT = f"WITH flat AS ({derived.diagnostic_flat_sql()})"


def _log(spark, sf_dir):
    raw = derived.diagnostic_records_from_tables(spark, sf_dir)
    return jsonlog.flatten_access_log(raw, keep_raw=False)


_DIM_ITEM_SQL = """
dim AS (SELECT ItemId, ItemType AS ItemKind, EventTimeUtc AS UpdatedAtUtc FROM (
  SELECT *, row_number() OVER (PARTITION BY ItemId ORDER BY EventTimeUtc DESC NULLS LAST,
                                                        CAST(EventId AS VARCHAR) DESC) AS rn
  FROM flat) WHERE rn = 1)
"""


def _dim_item(log):
    d = marts.latest_per_key(log.select("ItemId", "ItemType", "EventTimeUtc", "EventId"),
                             ["ItemId"], "EventTimeUtc", ["EventId"])
    return d.select("ItemId", F.col("ItemType").alias("ItemKind"), "UpdatedAtUtc")


@query("dim_upsert_latest", "DCL3", sql=f"{_FLAT}, {_DIM_ITEM_SQL} SELECT * FROM dim")
def dim_upsert_latest(spark, sf_dir):
    return _dim_item(_log(spark, sf_dir))


@query("enrich_with_dims", "DCL3", sql=f"""{_FLAT}, {_DIM_ITEM_SQL}
SELECT f.EventId, f.ItemId, d.ItemKind FROM flat f LEFT JOIN dim d ON f.ItemId = d.ItemId
""")
def enrich_with_dims(spark, sf_dir):
    """The log, parsed once, and the dimension made of it."""
    log = stored(_log(spark, sf_dir).select("EventId", "EventTimeUtc", "ItemId", "ItemType"), "log")
    return marts.enrich(log.select("EventId", "ItemId"), _dim_item(log).drop("UpdatedAtUtc"), "ItemId")


def _item_rows(log):
    """Rows of ``dim_item``, one per event, with the id that breaks ties."""
    return log.select("ItemId", F.col("ItemType").alias("ItemKind"), F.col("EventTimeUtc").alias("UpdatedAtUtc"), "EventId")


@query("dim_upsert_two_deliveries", "DCL3", sql=f"{_FLAT}, {_DIM_ITEM_SQL} SELECT * FROM dim")
def dim_upsert_two_deliveries(spark, sf_dir):
    """The dimension kept up by three batches that are not in order of time, one of them twice: the rows of the one-shot result."""
    path = scratch_path(spark, "dim-item")
    rows = _item_rows(stored(_log(spark, sf_dir).select("EventId", "EventTimeUtc", "ItemId", "ItemType"), "log"))
    deal = F.pmod(F.xxhash64("EventId"), F.lit(3))
    for batch in (2, 0, 1, 0):
        merge.upsert_dimension(rows.where(deal == batch), path, ["ItemId"], "UpdatedAtUtc", ["EventId"], buckets=16)
    return merge.read_dimension(spark, path, rows.schema).drop("EventId")


@query("access_mart_daily", "DCL4", sql=f"""{_FLAT}
SELECT CAST(EventTimeUtc AS DATE) AS EventDate, WorkspaceId, count(*) AS events,
       count(DISTINCT ExecutingPrincipalId) AS principals,
       sum(CASE WHEN HttpStatusCode >= 400 THEN 1 ELSE 0 END) / count(*) AS error_share,
       round(quantile_cont(DurationMs, 0.95), 6) AS p95_duration_ms
FROM flat GROUP BY ALL
""")
def access_mart_daily(spark, sf_dir):
    out = marts.access_mart_daily(_log(spark, sf_dir))
    return out.withColumn("p95_duration_ms", F.round("p95_duration_ms", 6))


_MART_SQL = """
SELECT CAST(EventTimeUtc AS DATE) AS EventDate, WorkspaceId, count(*) AS events,
       count(DISTINCT ExecutingPrincipalId) AS principals,
       sum(CASE WHEN HttpStatusCode >= 400 THEN 1 ELSE 0 END) / count(*) AS error_share,
       round(quantile_cont(DurationMs, 0.95), 6) AS p95_duration_ms
FROM flat GROUP BY ALL
"""


@query("access_mart_damaged", "DCL4", sql=f"WITH flat AS ({derived.diagnostic_flat_sql(damaged=True)}) {_MART_SQL}")
def access_mart_damaged(spark, sf_dir):
    """Events whose time can't be read form a day of their own (null), its p95 included."""
    raw = derived.diagnostic_records_from_tables(spark, sf_dir, damaged=True)
    out = marts.access_mart_daily(jsonlog.flatten_access_log(raw, keep_raw=False))
    return out.withColumn("p95_duration_ms", F.round("p95_duration_ms", 6))


@query("access_mart_incremental", "DCL4", sql=f"WITH flat AS ({derived.diagnostic_flat_sql(damaged=True)}) {_MART_SQL}")
def access_mart_incremental(spark, sf_dir):
    """The mart after three deliveries to a log kept by day: each rewrites only the days that it has rows of; equal to the full recompute."""
    base = scratch_path(spark, "mart")
    log_path, mart_path = os.path.join(base, "log"), os.path.join(base, "mart")
    raw = derived.diagnostic_records_from_tables(spark, sf_dir, damaged=True)
    flat = stored(jsonlog.flatten_access_log(raw, keep_raw=False).select("EventId", "EventTimeUtc", "WorkspaceId", "ExecutingPrincipalId", "HttpStatusCode", "DurationMs"), "log")
    rows = flat.withColumn("EventDate", F.to_date("EventTimeUtc"))
    # By day, and two days in two deliveries.
    part = F.when(F.dayofmonth("EventDate") <= 10, 0).when(F.dayofmonth("EventDate") <= 12, F.pmod(F.xxhash64("EventId"), F.lit(2))).otherwise(F.coalesce(F.dayofmonth("EventDate") % 2 + 1, F.lit(2)))
    for n in range(3):
        landed = rows.where(part == n)
        landed.write.mode("append").partitionBy("EventDate").parquet(log_path)
        log = spark.read.schema(rows.schema).parquet(log_path)
        merge.refresh_mart(log, landed, mart_path, marts.access_mart_daily)
    out = spark.read.parquet(mart_path)
    return out.select(F.col("EventDate").cast("date").alias("EventDate"), "WorkspaceId", "events", "principals", "error_share", F.round("p95_duration_ms", 6).alias("p95_duration_ms"))


@query("job_daily", "DCL1", sql=f"""{_FLAT},
e AS (SELECT ItemId, EventTimeUtc AS t, HttpStatusCode FROM flat WHERE EventTimeUtc IS NOT NULL),
s AS (SELECT *, CASE WHEN lag(t) OVER w IS NULL OR t >= lag(t) OVER w + INTERVAL 30 MINUTE THEN 1 ELSE 0 END
                AS new_run
      FROM e WINDOW w AS (PARTITION BY ItemId ORDER BY t)),
g AS (SELECT *, sum(new_run) OVER (PARTITION BY ItemId ORDER BY t, new_run DESC
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM s),
runs AS (SELECT ItemId, run, min(t) AS t0, max(t) AS t1,
                max(CASE WHEN HttpStatusCode >= 500 THEN 1 ELSE 0 END) AS failed
         FROM g GROUP BY ItemId, run)
SELECT ItemId, CAST(t0 AS DATE) AS JobDate, count(*) AS jobs, CAST(sum(failed) AS BIGINT) AS failed_jobs,
       sum(failed) / count(*) AS failure_rate, avg(epoch_us(t1) // 1000 - epoch_us(t0) // 1000) AS avg_duration_ms
FROM runs GROUP BY ALL
""")
def job_daily(spark, sf_dir):
    """Runs of access activity per item (30-minute gap) as job events, per day."""
    return marts.job_daily(marts.job_sessions(_log(spark, sf_dir)))


@query("etl_run_log", "DCL2,SNK10", sql="""
SELECT 'Succeeded' AS Status, count(*) AS RowsRead, count(*) AS RowsWritten FROM events
""")
def etl_run_log(spark, sf_dir):
    """Normalise the derived log to a table and append this run to ``log_etl_run``;
    the counts come from ``observe()`` on the frames (no second pass to count)."""
    import datetime as dt
    import uuid

    from pyspark.sql import Observation

    base = scratch_path(spark, "etl")
    start = dt.datetime.now(dt.timezone.utc)
    read_obs = Observation("read")
    raw = derived.diagnostic_records_from_tables(spark, sf_dir).observe(read_obs, F.count(F.lit(1)).alias("n"))
    written = sinks.overwrite_path(jsonlog.flatten_access_log(raw), os.path.join(base, "log_event_access"))
    end = dt.datetime.now(dt.timezone.utc)
    run = [(uuid.uuid4().hex, "derived-events", None, None, "normalise_access_log", start, end, "Succeeded",
            int(read_obs.get["n"]), int(written["rows"]), None, None, None, end)]
    log_path = os.path.join(base, "log_etl_run")
    spark.createDataFrame(run, sinks.DECLARED_TABLES["log_etl_run"]).write.mode("append").parquet(log_path)
    return spark.read.parquet(log_path).select("Status", "RowsRead", "RowsWritten")


@query("etl_run_per_batch", "DCL2,SNK10,STR1", sql="""
SELECT 'Succeeded' AS Status, 2 * count(*) AS RowsRead, count(*) AS RowsWritten, true AS batches_logged FROM events
""")
def etl_run_per_batch(spark, sf_dir):
    """Every event delivered twice, over several micro-batches: the run log has a row for each, and its sums are the lines read and the rows in the table."""
    base = scratch_path(spark, "run-log")
    log_path, target, ck = (os.path.join(base, x) for x in ("log_etl_run", "log_event_access", "ck"))
    ev = tables.load(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    parts = max(2, -(-ev.count() // derived.DELIVERED_DOCS))
    for copy in (1, 2):
        derived.deliver(derived.diagnostic_docs(ev.repartition(parts)), os.path.join(base, "src", f"copy_{copy}"))
    with RunLog(spark, log_path, "normalise_access_log") as log:
        ingest.normalise_stream(spark, os.path.join(base, "src"), target, ck, multiline=False,
                                max_files_per_trigger=min(parts, derived.DELIVERED_FILES), log=log, glob=files.GZIP_GLOB)
    runs = spark.read.schema(sinks.DECLARED_TABLES["log_etl_run"]).parquet(log_path)
    rows = spark.read.parquet(target).agg(F.count(F.lit(1)).alias("n")).withColumn("Status", F.lit("Succeeded"))
    sums = runs.groupBy("Status").agg(F.sum("RowsRead").alias("RowsRead"), F.sum("RowsWritten").alias("RowsWritten"), F.count_distinct("RunId").alias("runs"), F.count(F.lit(1)).alias("batches"))
    return sums.join(rows, "Status").select("Status", "RowsRead", "RowsWritten", ((F.col("batches") > 1) & (F.col("runs") == F.col("batches")) & (F.col("n") == F.col("RowsWritten"))).alias("batches_logged"))


@query("job_daily_stream", "DCL1,STR3", sql=REGISTRY["job_daily"].sql)
def job_daily_stream(spark, sf_dir):
    """``job_daily`` from a log that grows by three deliveries, the second of them late, read as a stream with state bounded by the watermark."""
    base = scratch_path(spark, "spans")
    log_path = os.path.join(base, "log")
    flat = stored(_log(spark, sf_dir).select("EventId", "EventTimeUtc", "ItemId", "HttpStatusCode"), "log")
    day = F.dayofmonth("EventTimeUtc")
    part = F.when(F.pmod(F.xxhash64("EventId"), F.lit(10)) == 0, 1).when(day <= 15, 0).otherwise(2)
    for n in range(3):
        flat.where(part == n).withColumns({"Generation": F.lit(f"g{n}"), "EventDate": F.to_date("EventTimeUtc")}).write.mode("append").partitionBy("Generation", "EventDate").parquet(log_path)
        sessions.span_stream(spark, log_path, os.path.join(base, "out"), os.path.join(base, "ck"))
    return marts.job_daily(sessions.sessions(spark, os.path.join(base, "out")))
