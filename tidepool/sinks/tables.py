"""Table management and writes (SNK1-SNK4, SNK8-SNK10).

Tables are Parquet by default (Delta when its jar is on the classpath and
``TIDEPOOL_TABLE_FORMAT=delta``).  Appends check names and types against the
target first (D1: a mismatched append fails with a clear message instead of
corrupting the table).  Row counts of a write come from ``observe()`` on the
written frame -- the plan does not run a second time to count.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.sources.tables import TABLE_FORMAT

# The lake's zones (reference layout: control, bronze, silver, gold).
ZONES = ("control", "bronze", "silver", "gold")


# The declared logging and dimension tables (column name and type,
# in table order).  log_event_access is the 31-column form (functions.jsonlog).
DECLARED_TABLES = {
    "log_job_event": (
        "Timestamp TIMESTAMP, ItemId STRING, ItemKind STRING, ItemName STRING, WorkspaceId STRING, "
        "WorkspaceName STRING, CapacityId STRING, DurationMs BIGINT, ExecutingPrincipalId STRING, "
        "ExecutingPrincipalType STRING, WorkspaceMonitoringTableName STRING, JobInstanceId STRING, "
        "JobInvokeType STRING, JobType STRING, JobStatus STRING, JobDefinitionObjectId STRING, "
        "JobScheduleTime TIMESTAMP, JobStartTime TIMESTAMP, JobEndTime TIMESTAMP, IngestedTimeUtc TIMESTAMP, "
        "RawJson STRING"),
    "log_etl_run": (
        "RunId STRING, SourceSystem STRING, WorkspaceId STRING, WorkspaceName STRING, PipelineOrJobName STRING, "
        "RunStartUtc TIMESTAMP, RunEndUtc TIMESTAMP, Status STRING, RowsRead BIGINT, RowsWritten BIGINT, "
        "FilesProcessed BIGINT, ErrorMessage STRING, CommitHash STRING, IngestedTimeUtc TIMESTAMP"),
    "dim_workspace": ("WorkspaceId STRING, WorkspaceName STRING, CapacityId STRING, Environment STRING, "
                      "Owner STRING, UpdatedAtUtc TIMESTAMP"),
    "dim_item": ("ItemId STRING, ItemKind STRING, ItemName STRING, WorkspaceId STRING, Domain STRING, "
                 "UpdatedAtUtc TIMESTAMP"),
    "dim_principal": ("PrincipalId STRING, PrincipalType STRING, PrincipalUpn STRING, DisplayName STRING, "
                      "UpdatedAtUtc TIMESTAMP"),
}


class SchemaMismatchError(ValueError):
    pass


def layout(base: str) -> dict[str, str]:
    """SNK8: zone folders under one base path."""
    return {z: f"{base.rstrip('/')}/{z}" for z in ZONES}


def create_table_if_absent(spark: SparkSession, name: str, schema: T.StructType,
                           partition_cols: list[str] | None = None, location: str | None = None,
                           fmt: str | None = None) -> None:
    """SNK1: ``CREATE TABLE IF NOT EXISTS`` from an explicit schema."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {fmt or TABLE_FORMAT}{part}{loc}")


#: Columns that the access-log table has besides the 31 of the log: the event's key and the two partition columns.
ACCESS_LOG_KEY = "EventKey"
ACCESS_LOG_LAYOUT = ["Generation", "EventDate"]


def access_log_schema() -> T.StructType:
    """The access-log table, as the ingestion writes it."""
    from tidepool.functions.jsonlog import ACCESS_LOG_SCHEMA

    return T.StructType([*ACCESS_LOG_SCHEMA.fields, T.StructField(ACCESS_LOG_KEY, T.StringType()),
                         T.StructField("Generation", T.StringType()), T.StructField("EventDate", T.DateType())])


def bootstrap_tables(spark: SparkSession, base: str, prefix: str = "") -> list[str]:
    """SNK1: create the access-log table and the five declared tables if absent,
    each at ``<base>/silver/<name>``; safe to rerun.  Returns the table names.

    The access log has the layout in which the ingestion writes it by path;
    ``refresh_table`` shows what was ingested."""
    silver = layout(base)["silver"]
    schemas = {"log_event_access": access_log_schema(),
               **{n: T.StructType.fromDDL(ddl) for n, ddl in DECLARED_TABLES.items()}}
    names = []
    for name, schema in schemas.items():
        full = f"{prefix}{name}"
        partitions = ACCESS_LOG_LAYOUT if name == "log_event_access" else None
        create_table_if_absent(spark, full, schema, partitions, location=f"{silver}/{name}")
        names.append(full)
    return names


def refresh_table(spark: SparkSession, name: str) -> None:
    """Let a catalog table see what was written to its location by path (new partitions included)."""
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def drop_tables(spark: SparkSession, names: list[str]) -> None:
    """Forget catalog tables; their files, at locations of their own, stay."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def check_schema(df: DataFrame, target: T.StructType) -> None:
    want = [(f.name, f.dataType) for f in target.fields]
    have = [(f.name, f.dataType) for f in df.schema.fields]
    if sorted(want, key=str) != sorted(have, key=str):
        missing = [w for w in want if w not in have]
        extra = [h for h in have if h not in want]
        raise SchemaMismatchError(f"append does not match target: missing {missing}, unexpected {extra}")


def append_table(df: DataFrame, name: str) -> dict:
    """SNK2 + SNK10: checked append to a catalog table; returns observed row count."""
    spark = df.sparkSession
    target = spark.table(name).schema
    check_schema(df, target)
    obs = Observation(f"append_{name.replace('.', '_')}")
    observed = df.select(*[F.col(f.name) for f in target.fields]).observe(obs, F.count(F.lit(1)).alias("rows"))
    observed.write.mode("append").insertInto(name)
    return obs.get


def append_path(df: DataFrame, path: str, partition_cols: list[str] | None = None,
                fmt: str | None = None) -> dict:
    """Append by path; returns the observed row count (SNK10)."""
    obs = Observation("append_path")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").format(fmt or TABLE_FORMAT)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.save(path)
    return obs.get


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath, jvm


def overwrite_path(df: DataFrame, path: str, replace_schema: bool = True, fmt: str | None = None,
                   partition_cols: list[str] | None = None) -> dict:
    """SNK3/SNK4: overwrite a path table; the new schema replaces the old one.

    Parquet has no transactions, so the new version is written next to the old
    one and switched in by two renames: readers never see a half-written table
    (only, between the renames, briefly no table), a failed write leaves the old
    table intact, and a frame that reads the same path can overwrite it.
    (With Delta, ``overwriteSchema`` does this transactionally.)
    """
    fmt = fmt or TABLE_FORMAT
    spark = df.sparkSession
    obs = Observation("overwrite_path")
    stage = f"{path.rstrip('/')}.__staged_{uuid.uuid4().hex[:8]}"
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt)
    if fmt == "delta" and replace_schema:
        w = w.option("overwriteSchema", "true")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.save(stage)
    fs, target, jvm = _fs(spark, path)
    staged = jvm.org.apache.hadoop.fs.Path(stage)
    old = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.__old_{uuid.uuid4().hex[:8]}")
    had_old = fs.exists(target)
    if had_old and not fs.rename(target, old):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(staged, target):
        if had_old:
            fs.rename(old, target)
        raise OSError(f"could not switch {stage} into {path}")
    if had_old:
        fs.delete(old, True)
    return obs.get


def stamp_schema_version(spark: SparkSession, path: str, version: str) -> None:
    """SNK9: append one (stamped_at, version) row to the schema-version table; ``schema_version`` reads the last."""
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    row = spark.createDataFrame([(now, version)], "stamped_at timestamp_ntz, version string")
    row.write.mode("append").parquet(path)


def schema_version(spark: SparkSession, path: str) -> DataFrame:
    """SNK9: the stamp that holds: ``stamped_at`` and ``version`` of the last one (none where nothing was stamped)."""
    stamps = spark.read.schema("stamped_at timestamp_ntz, version string").parquet(path)
    return stamps.groupBy().agg(F.max(F.struct("stamped_at", "version")).alias("s"), F.count(F.lit(1)).alias("stamps")).where("stamps > 0").select("s.*", "stamps")
