"""Dimensions and marts that are kept up: what is rewritten, and what it is equal to."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from tidepool.operators import marts, merge

SCHEMA = "ItemId string, Kind string, At timestamp, EventId string"


def _at(hour):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hour)


def _files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/*=*/**/*.parquet", recursive=True)}


def test_upsert_rewrites_only_touched_buckets(spark, tmp_dir):
    path = f"{tmp_dir}/dim"
    first = spark.createDataFrame([(f"item{i}", "a", _at(10), f"e{i}") for i in range(200)], SCHEMA)
    assert merge.upsert_dimension(first, path, ["ItemId"], "At", ["EventId"], buckets=32) == 32
    before = _files(path)
    changes = spark.createDataFrame([("item3", "newer", _at(11), "x"), ("item4", "older", _at(9), "x"), ("new", "b", _at(1), "x")], SCHEMA)
    assert merge.upsert_dimension(changes, path, ["ItemId"], "At", ["EventId"], buckets=32) == 2  # item4's row is older: its bucket stays
    after = _files(path)
    assert len({os.path.dirname(f) for f in before.keys() - after.keys()}) <= 2
    assert all(after[f] == before[f] for f in before.keys() & after.keys()) and len(before.keys() & after.keys()) >= 30
    rows = {r.ItemId: r.Kind for r in merge.read_dimension(spark, path, first.schema).collect()}
    assert rows == {**{f"item{i}": "a" for i in range(200)}, "item3": "newer", "new": "b"}
    # The same batch again, and one that is older throughout, change nothing.
    assert merge.upsert_dimension(changes, path, ["ItemId"], "At", ["EventId"], buckets=32) == 0
    assert _files(path) == after


def test_batches_in_any_order_equal_one_shot(spark, tmp_dir):
    """Null keys and times, ties and repeated rows, an empty batch, a key with most of the rows."""
    rows = [(k, f"kind{i % 5}", None if i % 17 == 0 else _at(i * 7 % 40), f"e{i:04d}") for i in range(400) for k in [None if i % 23 == 0 else "hot" if i % 3 else f"k{i % 30}"]]
    rows += rows[:20]
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(tuple, marts.latest_per_key(df, ["ItemId"], "At", ["EventId"], out_time="At").collect()), key=str)
    for n, order in enumerate([(0, 1, 2), (2, 1, 0), (1, 0, 2, 1)]):
        path = f"{tmp_dir}/dim{n}"
        for part in order:
            merge.upsert_dimension(df.where(F.pmod(F.xxhash64("EventId"), F.lit(3)) == part), path, ["ItemId"], "At", ["EventId"], buckets=8)
        merge.upsert_dimension(df.limit(0), path, ["ItemId"], "At", ["EventId"], buckets=8)
        assert sorted(map(tuple, merge.read_dimension(spark, path, df.schema).collect()), key=str) == want
    assert merge.read_dimension(spark, f"{tmp_dir}/none", df.schema).count() == 0


def test_mart_rewrites_only_landed_days(spark, tmp_dir):
    schema = "EventTimeUtc timestamp, WorkspaceId string, ExecutingPrincipalId string, HttpStatusCode int, DurationMs bigint"
    rows = [(None if i % 50 == 0 else _at(i % 96), f"w{i % 3}", f"p{i % 7}", 500 if i % 9 == 0 else 200, None if i % 4 == 0 else i) for i in range(600)]
    df = spark.createDataFrame(rows, schema).withColumn("EventDate", F.to_date("EventTimeUtc"))
    log, mart = f"{tmp_dir}/log", f"{tmp_dir}/mart"

    def land(part):
        part.write.mode("append").partitionBy("EventDate").parquet(log)
        return merge.refresh_mart(spark.read.schema(df.schema).parquet(log), part, mart, marts.access_mart_daily)

    first = df.where("DurationMs IS NULL OR DurationMs < 300 OR EventDate <= DATE '2024-01-02'")
    assert land(first) == 5  # four days, and none
    before = _files(mart)
    rest = df.where("NOT (DurationMs IS NULL OR DurationMs < 300 OR EventDate <= DATE '2024-01-02') AND EventDate = DATE '2024-01-03'")
    assert land(rest) == 1
    after = _files(mart)
    changed = {f.split("EventDate=")[1].split("/")[0] for f in before.keys() ^ after.keys()}
    assert changed == {"2024-01-03"}
    assert land(df.limit(0)) == 0
    columns = ["EventDate", "WorkspaceId", "events", "principals", "error_share", "p95_duration_ms"]
    want = marts.access_mart_daily(first.unionByName(rest)).select(columns).collect()
    got = spark.read.parquet(mart).withColumn("EventDate", F.col("EventDate").cast("date")).select(columns).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and any(r.EventDate is None and r.p95_duration_ms is not None for r in got)
