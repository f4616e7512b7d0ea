"""Table sinks: create-if-absent, checked append, observed counts, overwrite schema."""

import uuid

import pytest

from tidepool.sinks import tables as sinks
from tidepool.sources import files


def test_append_checks_schema_and_counts(spark, tmp_dir):
    name = f"t_{uuid.uuid4().hex[:8]}"
    schema = spark.createDataFrame([], "a long, b string").schema
    sinks.create_table_if_absent(spark, name, schema, location=f"{tmp_dir}/t")
    ok = spark.createDataFrame([(1, "x"), (2, "y")], "a long, b string")
    assert sinks.append_table(ok, name)["rows"] == 2
    bad = spark.createDataFrame([(1, 2)], "a long, b int")
    with pytest.raises(sinks.SchemaMismatchError):
        sinks.append_table(bad, name)
    assert spark.table(name).count() == 2


def test_overwrite_replaces_schema(spark, tmp_dir):
    sinks.overwrite_path(spark.createDataFrame([(1, "x")], "a long, b string"), f"{tmp_dir}/p")
    sinks.overwrite_path(spark.createDataFrame([(2.5,)], "c double"), f"{tmp_dir}/p")
    assert spark.read.parquet(f"{tmp_dir}/p").columns == ["c"]


def test_layout_and_landing_check(spark, tmp_dir):
    z = sinks.layout(tmp_dir)
    assert set(z) == {"control", "bronze", "silver", "gold"}
    assert not files.landing_has(spark, f"{tmp_dir}/nothing.csv")
    sinks.stamp_schema_version(spark, z["control"] + "/schema_version", "v1")
    assert files.landing_has(spark, z["control"] + "/schema_version")


def test_overwrite_from_itself(spark, tmp_dir):
    sinks.overwrite_path(spark.range(5).withColumnRenamed("id", "a"), f"{tmp_dir}/self")
    df = spark.read.parquet(f"{tmp_dir}/self")
    sinks.overwrite_path(df.selectExpr("a * 2 AS a"), f"{tmp_dir}/self")
    assert sorted(r[0] for r in spark.read.parquet(f"{tmp_dir}/self").collect()) == [0, 2, 4, 6, 8]


def test_typed_json_read_mark_filter_and_views(spark, tmp_dir):
    import json
    import os

    from pyspark.sql import types as T

    from tidepool.sources import tables

    os.makedirs(f"{tmp_dir}/j/b", exist_ok=True)
    for name, doc in (("a.json", {"id": "1", "n": 2}), ("b/c.JSON", {"id": "2", "n": 3})):
        with open(f"{tmp_dir}/j/{name}", "w") as fh:
            fh.write(json.dumps(doc, indent=2))
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])
    got = sorted(tuple(r) for r in files.read_json_typed(spark, f"{tmp_dir}/j", schema).collect())
    assert got == [("1", 2), ("2", 3)]
    listed = files.list_files(spark, f"{tmp_dir}/j")
    mark = listed.agg({"path": "max"}).first()[0]
    assert files.newer_than(listed, mark).count() == 0
    assert files.newer_than(listed, None).count() == 2
    tables.register_views(spark, "/root/testdata/sf0.001", ["region"])
    assert spark.sql("SELECT count(*) FROM region").first()[0] == 5


def test_bootstrap_declared_tables(spark, tmp_dir):
    prefix = f"b{uuid.uuid4().hex[:6]}_"
    names = sinks.bootstrap_tables(spark, tmp_dir, prefix)
    assert sinks.bootstrap_tables(spark, tmp_dir, prefix) == names  # rerun is a no-op
    widths = {n[len(prefix):]: len(spark.table(n).columns) for n in names}
    assert widths == {"log_event_access": 34, "log_job_event": 21, "log_etl_run": 14,
                      "dim_workspace": 6, "dim_item": 6, "dim_principal": 5}
