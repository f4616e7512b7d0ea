"""Reporting tables the reference declares but never fills (DCL2-DCL4):
latest-per-key dimensions, enrichment of log rows, a daily access mart and
the ETL run log.  Optional work; none of it is reference behaviour."""

from __future__ import annotations

from pyspark.sql import DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from tidepool.operators.joins import null_safe_join
from tidepool.operators.ranking import grouped_quantiles
from tidepool.session import stored


def latest_per_key(df: DataFrame, keys: list[str], time_col: str, tiebreak: list[str],
                   out_time: str = "UpdatedAtUtc") -> DataFrame:
    """DCL3: the most recent row per key (ties: largest ``tiebreak``), stamped
    with its time.  ``row_number() = 1`` gets a partial top-1 before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.col(time_col).desc_nulls_last(), *[F.col(c).desc() for c in tiebreak])
    return (df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
            .withColumnRenamed(time_col, out_time))


def enrich(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """DCL3: left join a dimension; no hint, so AQE broadcasts it by its real bytes or splits hot keys."""
    return facts.join(dim, key, "left")


def access_mart_daily(log: DataFrame) -> DataFrame:
    """DCL4: per day and workspace: events, distinct principals, p95 duration,
    share of error responses (status >= 400)."""
    keys = ["EventDate", "WorkspaceId"]
    # Several passes read these four columns: cut them once from the (parsed) log.
    day = stored(log.select(F.to_date("EventTimeUtc").alias("EventDate"), "WorkspaceId", "ExecutingPrincipalId",
                            "HttpStatusCode", "DurationMs"), "mart")
    base = day.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("ExecutingPrincipalId").alias("principals"),
        (F.sum((F.col("HttpStatusCode") >= 400).cast("int")) / F.count(F.lit(1))).alias("error_share"))
    p95 = grouped_quantiles(day, "DurationMs", keys, [0.95]).select(*keys, F.col("value").alias("p95_duration_ms"))
    return null_safe_join(base, p95, keys, "left")


def job_sessions(log: DataFrame, key: str = "ItemId", time_col: str = "EventTimeUtc",
                 gap_seconds: int = 1800) -> DataFrame:
    """DCL1 source: runs of activity per ``key`` -- consecutive events less than
    ``gap_seconds`` apart belong to one run (Spark ``session_window``).

    Two exact levels so that a hot key is not one task.  Events are first
    aggregated by (key, half gap of time): any two events of one half gap are in
    one run, and the sums are partly formed before the shuffle.  The spans are
    then merged by a ``session_window`` whose gap is each span's own length plus
    ``gap_seconds``: two spans merge exactly when the gap rule would join their
    events.
    """
    ev = log.where(F.col(time_col).isNotNull())
    half = F.floor(F.unix_micros(F.col(time_col).cast("timestamp")) / F.lit(gap_seconds * 500_000))
    return merged_spans(span_aggregates(ev.groupBy(key, half.alias("_b")), time_col), key, gap_seconds)


def span_aggregates(grouped: GroupedData, time_col: str) -> DataFrame:
    """First level of ``job_sessions``: first and last event, number and failure of each group of events that are in one run."""
    return grouped.agg(F.min(time_col).alias("_t0"), F.max(time_col).alias("_t1"), F.count(F.lit(1)).alias("_n"),
                       F.max((F.col("HttpStatusCode") >= 500).cast("int")).alias("_f"))


def merged_spans(part: DataFrame, key: str, gap_seconds: int) -> DataFrame:
    """Second level: spans (any number per run, overlapping or not) joined by the gap rule."""
    span = (F.unix_micros("_t1") - F.unix_micros("_t0") + gap_seconds * 1_000_000) / 1_000_000
    dyn_gap = F.make_interval(secs=span.cast("decimal(18,6)"))
    return part.groupBy(key, F.session_window("_t0", dyn_gap).alias("s")).agg(
        F.min("_t0").alias("JobStartTime"), F.max("_t1").alias("JobEndTime"),
        F.sum("_n").alias("events"), F.max("_f").alias("failed"))


def job_daily(sessions: DataFrame, key: str = "ItemId") -> DataFrame:
    """DCL1: per key and day of the run's start: runs, failed runs, failure
    rate and mean run duration in milliseconds."""
    dur = F.unix_millis("JobEndTime") - F.unix_millis("JobStartTime")
    return sessions.groupBy(key, F.to_date("JobStartTime").alias("JobDate")).agg(
        F.count(F.lit(1)).alias("jobs"),
        F.sum("failed").cast("bigint").alias("failed_jobs"),
        (F.sum("failed") / F.count(F.lit(1))).alias("failure_rate"),
        F.avg(dur).alias("avg_duration_ms"))
