"""Streams dealt in two by their watermark, so that a stateful operator may forget and no late row is lost.

Structured Streaming's stateful operators drop rows behind the watermark.  Here
the rows of each micro-batch are first staged in two folders: on time (from the
watermark that holds for this micro-batch on: the latest time of the micro-batches
before it, less the delay) and late (behind it, or without a time).  The
on-time folder is a stream of its own for the stateful operator, whose watermark
is never ahead of ours, since it has seen the same micro-batches: it drops
nothing.  The late folder is a stream for an exact path without state.

Both parts run to the end within the micro-batch that staged their rows, each with
its own checkpoint, and the staged rows are then deleted.  A run that was cut off
between is completed first by the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.sources import folders


def run(writer, available_now: bool = True, name: str | None = None):
    """Start a query, wait for its end, raise what it raised; returns the query."""
    writer = writer.queryName(name) if name else writer
    q = (writer.trigger(availableNow=True) if available_now else writer).start()
    q.awaitTermination()
    ex = q.exception()
    if ex is not None:
        raise RuntimeError(f"streaming query failed: {ex}")
    return q


def _staged(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}/staged"


def part(spark: SparkSession, checkpoint: str, schema: T.StructType, late: bool) -> DataFrame:
    """The on-time or the late rows as a stream."""
    return spark.readStream.schema(schema).parquet(f"{_staged(checkpoint)}/Batch=*/Late={'true' if late else 'false'}")


def deal(rows: DataFrame, checkpoint: str, batch_id: int, delay: str, time_col: str) -> None:
    """Stage a micro-batch's rows, and note its latest time."""
    spark, time, notes = rows.sparkSession, F.col(time_col), f"{checkpoint.rstrip('/')}/watermarks"
    before = None
    if folders.exists(spark, notes):
        earlier = spark.read.schema("latest timestamp, Batch bigint").parquet(notes).where(F.col("Batch") < batch_id)
        before = earlier.agg(F.unix_micros(F.max("latest") - F.expr(f"INTERVAL {delay}"))).first()[0]
    late = time.isNull() if before is None else F.coalesce(time < F.timestamp_micros(F.lit(before)), F.lit(True))
    latest = Observation("latest")
    dealt = rows.withColumn("Late", late).observe(latest, F.unix_micros(F.max(time)).alias("micros"))
    dealt.write.mode("overwrite").partitionBy("Late").parquet(f"{_staged(checkpoint)}/Batch={batch_id}")
    noted = spark.range(1).select(F.timestamp_micros(F.lit(latest.get["micros"]).cast("bigint")).alias("latest"))
    noted.write.mode("overwrite").parquet(f"{notes}/Batch={batch_id}")


def run_dealt(spark: SparkSession, stream: DataFrame, checkpoint: str, prepare: Callable[[DataFrame], DataFrame],
              parts: list[Callable[[], None]], delay: str, time_col: str = "EventTimeUtc") -> None:
    """Drain ``stream``: every micro-batch is made ready by ``prepare``, dealt, and run through ``parts``."""
    staged = _staged(checkpoint)

    def settle() -> None:
        for run_part in parts:
            run_part()

    def route(batch: DataFrame, batch_id: int) -> None:
        if not folders.exists(spark, f"{staged}/Batch={batch_id}/_SUCCESS"):
            deal(prepare(batch), checkpoint, batch_id, delay, time_col)
        settle()
        folders.delete(spark, f"{staged}/Batch={batch_id}")

    if folders.values(spark, staged, "Batch"):
        settle()
    run(stream.writeStream.foreachBatch(route).option("checkpointLocation", f"{checkpoint}/route"))
