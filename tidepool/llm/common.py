"""Shared helpers: scratch tables in the shared folder, word splitting, shared-store files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.session import checkpoint_dir

#: Words are runs of anything but these: space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows per Arrow batch.  Texts may be long: a batch is held whole on both sides
#: of the Python boundary, and Spark bounds it by rows only.
ARROW_ROWS = 1024

#: Rows of a partition in ``gathered``.
PARTITION_ROWS = 20_000


def prepare(spark: SparkSession) -> None:
    """Lower the Arrow batch size of the session if it is above ``ARROW_ROWS``."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def scratch_uri(spark: SparkSession, name: str) -> str:
    """A fresh folder (as a URI) below ``spark.checkpoint.dir``, which all machines share."""
    base = checkpoint_dir(spark)
    if base.startswith("file:") and not base.startswith("file://"):
        base = "file://" + base[len("file:"):]
    elif base.startswith("/"):
        base = "file://" + base
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_uri(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def gathered(df: DataFrame, rows: int = 0) -> DataFrame:
    """Fewer partitions, and so files, behind a shuffle: two per core, but no fewer than one per ``PARTITION_ROWS`` rows.

    Nothing is shuffled again, and each partition of the shuffle is still sorted
    on its own.  ``rows``: known number of rows, if they are wide or many.
    """
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // PARTITION_ROWS)))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def column(df: DataFrame, name: str):
    """Column by its exact name (names with dots are quoted)."""
    return F.col("`" + name.replace("`", "``") + "`")


def one_per_id(documents: DataFrame, id_col: str, text_col: str, chosen: DataFrame, most_bytes: int) -> DataFrame:
    """For a learning sample: ``t`` of one document of each of ``chosen``'s ids ``k`` (a bounded number), with ``chosen``'s columns.

    Of rows with one id that with the smallest hash of its text; texts above
    ``most_bytes`` are not learned from.  So rows and bytes are bounded, however
    many documents have one id.
    """
    text = column(documents, text_col)
    rows = documents.select(column(documents, id_col).cast("bigint").alias("k"), text.alias("t"))
    rows = rows.where(F.coalesce(F.octet_length("t"), F.lit(0)) <= most_bytes).join(F.broadcast(chosen), "k")
    first = Window.partitionBy("k").orderBy(F.xxhash64("t"), "t")  # a top-1, taken before the shuffle too
    return rows.withColumn("nth_", F.row_number().over(first)).where("nth_ = 1").drop("nth_")


def words_of(text: str) -> list[bytes]:
    """Words of a text as UTF-8 bytes: ``bytes.split`` splits at exactly the six ASCII blanks of ``WORD``."""
    return text.encode("utf-8").split()


def store_files(uri: str):
    """(filesystem, path) of a shared-store URI, for files that Spark's writers don't produce."""
    from pyarrow import fs

    uri = uri.replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri(uri)


def batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Record batches of up to ``size`` of the row tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
