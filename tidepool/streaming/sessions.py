"""Runs of activity on the stream (DCL1): the access log as it grows, kept as spans that give ``job_daily`` at any time.

The state is a streaming aggregation by (key, half gap of time): first and last
event, number, failures.  Events of one half gap are always in one run, so the
state needs no sessions that meet and merge, and a window leaves it when the
watermark has passed its end.  Every micro-batch puts out the spans that it changed;
late events are aggregated without state and added.  The runs are the spans joined
by the gap rule when they are read: the same for every split into micro-batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators import marts
from tidepool.sinks.tables import access_log_schema
from tidepool.sources import folders
from tidepool.streaming import late

_SPAN = "_t0 timestamp, _t1 timestamp, _n bigint, _f int"


def span_stream(spark: SparkSession, log_path: str, base: str, checkpoint: str, key: str = "ItemId", time_col: str = "EventTimeUtc",
                gap_seconds: int = 1800, delay: str = "1 hour", max_files_per_trigger: int | None = None) -> list[dict]:
    """Drain what is new in the access-log table at ``log_path`` into the spans below ``base``; the progress of the stateful part."""
    reader = spark.readStream.schema(access_log_schema())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    events = reader.parquet(log_path).select(key, time_col, "HttpStatusCode")
    schema = T.StructType(events.schema.fields)
    progress: list[dict] = []

    def spans(rows: DataFrame) -> DataFrame:
        half = F.window(time_col, f"{gap_seconds * 500} milliseconds")
        return marts.span_aggregates(rows.groupBy(key, half.alias("w")), time_col).select(key, F.col("w.start").alias("_half"), "_t0", "_t1", "_n", "_f")

    def on_time() -> None:
        rows = late.part(spark, checkpoint, schema, late=False).withWatermark(time_col, delay)

        def sink(batch: DataFrame, n: int) -> None:
            batch.write.mode("overwrite").parquet(f"{base}/spans/Batch={n}")

        query = late.run(spans(rows).writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", f"{checkpoint}/on-time"))
        progress.extend(query.recentProgress)

    def behind() -> None:
        def sink(batch: DataFrame, n: int) -> None:
            spans(batch).write.mode("overwrite").parquet(f"{base}/late-spans/Batch={n}")

        late.run(late.part(spark, checkpoint, schema, late=True).writeStream.foreachBatch(sink).option("checkpointLocation", f"{checkpoint}/late"))

    late.run_dealt(spark, events, checkpoint, lambda batch: batch.where(F.col(time_col).isNotNull()), [on_time, behind], delay, time_col)
    return progress


def sessions(spark: SparkSession, base: str, key: str = "ItemId", gap_seconds: int = 1800, key_type: str = "string") -> DataFrame:
    """The runs of all events so far, as ``marts.job_sessions`` gives them."""
    schema = f"{key} {key_type}, _half timestamp, {_SPAN}"
    parts = []
    if folders.exists(spark, f"{base}/spans"):
        # A span's number of events only grows: its last state is the largest.
        last = F.max(F.struct("_n", "_t0", "_t1", "_f")).alias("s")
        parts.append(spark.read.schema(schema).parquet(f"{base}/spans").groupBy(key, "_half").agg(last).select(key, "s._t0", "s._t1", "s._n", "s._f"))
    if folders.exists(spark, f"{base}/late-spans"):
        parts.append(spark.read.schema(schema).parquet(f"{base}/late-spans").select(key, "_t0", "_t1", "_n", "_f"))
    found = parts[0] if parts else spark.createDataFrame([], f"{key} {key_type}, {_SPAN}")
    return marts.merged_spans(found.unionByName(parts[1]) if len(parts) > 1 else found, key, gap_seconds)
