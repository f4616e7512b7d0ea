"""Model registry and run log as tables (REG1, REG2).

A registered model is a ``PipelineModel`` saved under its run id, never
overwritten, plus one row in the ``registry`` table.  A version number is taken
by the exclusive creation of a file, so two trainings at once get two numbers.
Every training run appends its parameters and metrics to the ``run_log`` table
(one row per metric).
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_LOG_SCHEMA = ("run_id string, experiment string, model_name string, params map<string,string>, "
                  "metric string, value double, logged_at timestamp_ntz")
REGISTRY_SCHEMA = "name string, version int, path string, run_id string, registered_at timestamp_ntz"


def _now():
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def new_run_id() -> str:
    return uuid.uuid4().hex


def log_run(spark: SparkSession, base: str, experiment: str, run_id: str, model_name: str,
            params: dict, metrics: DataFrame | dict) -> DataFrame:
    """REG1: append (run, model, params, metric, value) rows to ``<base>/run_log``.

    ``metrics`` is a one-row DataFrame of metric columns (computed on the
    executors) or a dict of already computed scalars.
    """
    p = {k: str(v) for k, v in params.items()}
    if isinstance(metrics, dict):
        rows = [(run_id, experiment, model_name, p, k, float(v), _now()) for k, v in metrics.items()]
        out = spark.createDataFrame(rows, RUN_LOG_SCHEMA)
    else:
        cols = metrics.columns
        pm = F.create_map(*[x for k, v in p.items() for x in (F.lit(k), F.lit(v))])
        out = metrics.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in cols
        ])).alias("m")).select(
            F.lit(run_id).alias("run_id"), F.lit(experiment).alias("experiment"),
            F.lit(model_name).alias("model_name"), pm.alias("params"), "m.metric", "m.value",
            F.lit(_now()).cast("timestamp_ntz").alias("logged_at"))
    out.write.mode("append").parquet(os.path.join(base, "run_log"))
    return out


def _take_version(spark: SparkSession, base: str, name: str) -> int:
    """The next free version of ``name``: its marker file is created or belongs to another training."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(os.path.join(base, "versions", name))
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    version = 1 + max((int(f.getPath().getName()) for f in fs.listStatus(folder)), default=0)
    while not fs.createNewFile(jvm.org.apache.hadoop.fs.Path(folder, str(version))):
        version += 1
    return version


def register_model(spark: SparkSession, base: str, name: str, model: PipelineModel,
                   run_id: str | None = None) -> int:
    """REG2: save ``model`` under its run id and give it the next version of ``name``; returns the version."""
    run_id = run_id or new_run_id()
    path = os.path.join(base, "models", name, run_id)
    model.write().save(path)
    version = _take_version(spark, base, name)
    spark.createDataFrame([(name, version, path, run_id, _now())], REGISTRY_SCHEMA) \
        .write.mode("append").parquet(os.path.join(base, "registry"))
    return version


def model_path(spark: SparkSession, base: str, name: str, version: int) -> str:
    row = (spark.read.parquet(os.path.join(base, "registry"))
           .where((F.col("name") == name) & (F.col("version") == version)).select("path").first())
    if row is None:
        raise KeyError(f"model {name}/{version} is not registered")
    return row[0]


def load_model(spark: SparkSession, base: str, name: str, version: int) -> PipelineModel:
    return PipelineModel.load(model_path(spark, base, name, version))


def load_model_of_run(spark: SparkSession, base: str, run_id: str, name: str | None = None) -> PipelineModel:
    """The model that a training run registered (by ``name``, where it registered several)."""
    rows = spark.read.parquet(os.path.join(base, "registry")).where(F.col("run_id") == run_id)
    paths = (rows.where(F.col("name") == name) if name else rows).select("path").limit(2).collect()
    if len(paths) != 1:
        raise KeyError(f"run {run_id} registered {'no' if not paths else 'more than one'} model" + (f" {name}" if name else ""))
    return PipelineModel.load(paths[0][0])
