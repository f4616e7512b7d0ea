"""Tables that are kept up instead of rebuilt: copy-on-write upserts of dimensions and partition-wise refreshes of marts (DCL3, DCL4).

A dimension is a folder of hash buckets of its key.  A batch is merged into the
buckets that its keys fall into; the others are neither read nor rewritten.  The
merged buckets are written to a scratch table first and then switched in by
Spark's dynamic partition overwrite, so what is replaced is never what is still
being read, and a failed merge leaves the table as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.marts import latest_per_key
from tidepool.session import stored
from tidepool.sources import folders

BUCKET = "Bucket"
#: Buckets of a dimension: a parameter of the table, the same for all its batches.
BUCKETS = 64


def bucket_of(keys: list[str], buckets: int) -> Column:
    """Bucket of a key; null keys have one too."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _replace(rows: DataFrame, path: str, partition: list[str]) -> None:
    """Overwrite the partitions that ``rows`` has rows of, and only those."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def read_dimension(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a dimension (none where nothing was merged yet)."""
    if not folders.values(spark, path, BUCKET):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def upsert_dimension(batch: DataFrame, path: str, keys: list[str], time_col: str, tiebreak: list[str] | None = None,
                     buckets: int = BUCKETS) -> int:
    """DCL3: merge a batch into the dimension at ``path``: each key's row with the latest ``time_col`` stays (then the largest ``tiebreak``).

    An older row than the dimension's changes nothing, so batches may come in any
    order and more than once.  ``tiebreak`` columns must be columns of the
    dimension.  Returns the number of buckets rewritten: those that hold a key of
    the batch, and where the batch does change a row of theirs.
    """
    spark = batch.sparkSession
    schema = batch.schema
    order = tiebreak or [c for c in batch.columns if c not in (*keys, time_col)]
    # One row per key before anything is read: a hot key is reduced by the partial top-1 of the window.
    newest = stored(latest_per_key(batch, keys, time_col, order, out_time=time_col).withColumn(BUCKET, bucket_of(keys, buckets)), "upsert-batch")
    touched = [r[0] for r in newest.select(BUCKET).distinct().collect()]  # at most ``buckets``
    there = {int(b) for b in folders.values(spark, path, BUCKET)}
    held = [f"{path.rstrip('/')}/{BUCKET}={b}" for b in touched if b in there]
    if held:
        old = spark.read.schema(schema).parquet(*held).select(*schema.names).withColumn(BUCKET, bucket_of(keys, buckets)).withColumn("_old", F.lit(1))
        both = old.unionByName(newest.withColumn("_old", F.lit(0)))
        merged = stored(latest_per_key(both, keys, time_col, [*order, "_old"], out_time=time_col), "upsert-merged")  # of equal rows the old one
        touched = [r[0] for r in merged.where("_old = 0").select(BUCKET).distinct().collect()]
        newest = merged.where(F.col(BUCKET).isin(touched) if touched else F.lit(False)).drop("_old")
    if touched:
        _replace(newest.repartition(max(1, len(touched)), BUCKET), path, [BUCKET])
    return len(touched)


def refresh_mart(log: DataFrame, landed: DataFrame, path: str, build, day: str = "EventDate") -> int:
    """DCL4: rebuild the days of a mart that ``landed`` rows fall on, from all of the log's rows of these days.

    ``log`` must be partitioned by ``day`` (the days become a partition filter of its
    scan); ``build`` makes the mart of a log.  Other days' files stay as they are.
    Returns the number of days; days reach the driver, at most one per partition.
    """
    spark = log.sparkSession
    days = [r[0] for r in landed.select(day).distinct().collect()]
    if not days:
        return 0
    known = [d for d in days if d is not None]
    of_days = F.col(day).isin(known) if known else F.lit(False)
    if len(known) < len(days):
        of_days = of_days | F.col(day).isNull()
    _replace(stored(build(log.where(of_days)), "mart-days"), path, [day])
    return len(days)
