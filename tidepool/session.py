"""Session construction and the shared checkpoint folder.

Lineage is cut with ``DataFrame.checkpoint()`` or written tables under the
folder the cluster names in ``spark.checkpoint.dir``.  The library reads that
setting from the session; only a local-mode session without it (tests, the
bench, the correctness driver) gets a fresh folder under the system temp dir.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours wants; a cluster may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",  # a batch library opens no web page of its own accord
    # Joins carry no hint unless a side is bounded by construction: the
    # automatic threshold stays at Spark's default and AQE picks by real bytes.
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidepool", extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; on a cluster it must name a shared folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidepool-ckpt-"))
    return sc.getCheckpointDir()


# Scratch folders of this driver, by application: what ``release`` deletes.
_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder; it lives until ``release``."""
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    path = os.path.join(base, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stored(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut the lineage with a columnar table in the shared folder: what several passes read is computed once,
    later passes read only their columns, and a lost executor costs nothing that is in the table."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete every scratch folder of this application; frames that read them must be written by then.  Returns how many."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    return len(paths)
