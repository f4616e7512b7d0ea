"""Sketches that are kept, schema drift and damaged CSV."""

import glob
import json
import os

import numpy as np
from pyspark.sql import functions as F

from tidepool.functions import drift
from tidepool.operators import profile, sketches
from tidepool.sources import tables


def test_union_is_the_one_pass_sketch_and_within_its_error(spark, tmp_dir):
    rng = np.random.default_rng(3)
    rows = [(int(p), float(v), f"u{int(u)}") for p, v, u in zip(rng.integers(0, 6, 30_000), rng.normal(size=30_000), rng.integers(0, 20_000, 30_000))]
    df = spark.createDataFrame(rows, "part int, x double, u string")
    df = df.withColumn("x", F.when(F.col("part") == 2, F.lit(float("nan"))).when(F.col("part") != 3, F.col("x")))
    one, many = f"{tmp_dir}/one", f"{tmp_dir}/many"
    sketches.update(df.withColumn("part", F.lit(0)), one, ["x", "u"], "part")
    for upto in (1, 3, 5, 5):
        sketches.update(df.where(F.col("part") <= upto), many, ["x", "u"], "part")
    a, b = ({r["column"]: r for r in sketches.merged(spark, p, [0.1, 0.5, 0.9]).collect()} for p in (one, many))
    exact = {r["column"]: r for r in profile.table_summary(df, ["x", "u"]).collect()}
    for c in ("x", "u"):
        assert a[c]["n_distinct"] == b[c]["n_distinct"]
        for f in ("count", "null_count", "min", "max"):
            assert a[c][f] == b[c][f] == exact[c][f], (c, f)
        assert abs(b[c]["n_distinct"] - exact[c]["n_distinct"]) <= 4 * sketches.DISTINCT_ERROR * exact[c]["n_distinct"]
    assert abs(b["x"]["mean"] - exact["x"]["mean"]) < 1e-12 and abs(b["x"]["stddev"] - exact["x"]["stddev"]) < 1e-9
    values = np.sort([r.x for r in df.where("x IS NOT NULL AND NOT isnan(x)").collect()])
    for p, q in zip((0.1, 0.5, 0.9), b["x"]["quantiles"]):
        assert abs(np.searchsorted(values, q) / len(values) - p) <= sketches.RANK_ERROR
    assert b["u"]["quantiles"] is None and b["u"]["mean"] is None


def test_a_grown_table_reads_only_its_new_parts(spark, tmp_dir):
    table, kept = f"{tmp_dir}/t", f"{tmp_dir}/kept"
    def grow(day, n):
        spark.range(n).select(F.lit(day).alias("day"), F.col("id").cast("double").alias("v")).write.mode("append").partitionBy("day").parquet(table)
        return sketches.update(spark.read.schema("v double, day string").parquet(table), kept, ["v"], "day")

    assert grow("d1", 100) == 1
    # The files of known parts may be gone: they aren't read again.
    for f in glob.glob(f"{table}/day=d1/*.parquet"):
        os.truncate(f, 0)
    assert grow("d2", 50) == 1
    out = sketches.merged(spark, kept).first()
    assert (out["count"], out["min"], out["max"]) == (150, 0.0, 99.0) and out["n_distinct"] == 100


def test_unknown_fields_by_path(spark):
    docs = [
        {"id": "1", "time": "t", "data": {"itemId": "i", "extra": 1}}, {"id": "2", "extra": {"deep": [1, "a"]}, "data": {"extra": "text"}},
        {"id": "3", "data": {"workspaceName": {"nested": 1}, "itemId": ["x"]}}, {"id": "4"}, {"id": "5", "data": None}, {"id": "6", "data": []}, [1, 2], "text", None,
    ]
    raw = spark.createDataFrame([(json.dumps(d),) for d in docs] + [("{broken",), (None,)], "RawJson string")
    found = sorted((r.path, r.kind, r.v) for r in drift.unknown_fields(raw).select("path", "kind", F.to_json("value").alias("v")).collect())
    assert found == [("data.extra", "BIGINT", "1"), ("data.extra", "STRING", '"text"'), ("extra", "OBJECT<deep: ARRAY<VARIANT>>", '{"deep":[1,"a"]}')]
    report = {r.path: (r.documents, r.types) for r in drift.drift_report(raw).collect()}
    assert report == {"data.extra": (2, 2), "extra": (1, 1)}
    assert sorted(map(tuple, drift.misplaced(raw).collect())) == [("data.itemId", 1), ("data.workspaceName", 1)]
    values = drift.parsed(raw).select(drift.value_at(F.col("Document"), "$.data.extra", "int").alias("n"), drift.value_at(F.col("Document"), "$.extra.deep[1]", "string").alias("s"))
    assert [tuple(r) for r in values.where("n IS NOT NULL OR s IS NOT NULL").collect()] == [(1, None), (None, "a")]
    assert drift.drift_report(raw.limit(0)).count() == 0


def test_damaged_lines_are_kept_apart(spark, tmp_dir):
    lines = ["k,v,t", "1,1.5,a", "2,x,b", "3,2.5", "4,3.5,c,more", '5,4.5,"quoted, comma"', "6,,", '"7,5.5,open', "", "8,6.5,d"]
    os.makedirs(f"{tmp_dir}/csv")
    with open(f"{tmp_dir}/csv/a.csv", "w") as f:
        f.write("\n".join(lines))
    good, damaged = tables.read_csv_checked(spark, f"{tmp_dir}/csv", "k bigint, v double, t string")
    assert sorted(map(tuple, good.collect()), key=str) == [(1, 1.5, "a"), (5, 4.5, "quoted, comma"), (6, None, None), (8, 6.5, "d")]
    assert good.select("k").count() == 4  # a pruned count finds the same rows
    kept = [r[tables.DAMAGED] for r in damaged.collect()]
    assert sorted(kept) == sorted(["2,x,b", "3,2.5", "4,3.5,c,more", '"7,5.5,open'])
    assert all(r.source_path.endswith("a.csv") for r in damaged.collect())
    check = {r["column"]: r["verdict"] for r in tables.csv_schema_check(spark, f"{tmp_dir}/csv", "k int, v double, w string").collect()}
    assert check["w"] == "missing" and check["t"] == "unknown"


def test_cache_is_released(spark):
    with tables.cached(spark.range(10)) as df:
        assert df.is_cached and df.count() == 10
    assert not df.is_cached
