"""Key index, state that is bounded by the watermark, run log and spans of the streaming jobs."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidepool.operators import marts
from tidepool.sinks import tables as sinks
from tidepool.sources import folders
from tidepool.streaming import ingest, keyindex, late, runlog, sessions


def _keys(spark, names):
    return spark.createDataFrame([(n,) for n in names], "EventKey string")


def _write(path, docs, time=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(map(json.dumps, docs)))
    if time is not None:
        os.utime(path, (1_700_000_000 + time, 1_700_000_000 + time))


def _doc(name, time, **data):
    return {"id": name, "time": time, "type": "Access.Read", "data": {"itemId": "i", **data}}


def test_bitmap_bits_are_read_as_they_are_set(spark):
    """Every position that a bitmap was made of is set, and no other."""
    made = spark.range(0, keyindex.BLOCK_BITS, 77).agg(F.bitmap_construct_agg("id").alias("Bits"))
    probe = spark.range(0, 400).select(F.array(F.col("id")).alias("p"), "id")
    got = {r.id for r in probe.crossJoin(made).where(keyindex.all_set(F.col("Bits"), F.col("p"))).collect()}
    assert got == {i for i in range(400) if i % 77 == 0}


def test_filters_hold_every_key_and_few_others(spark, tmp_dir):
    index = f"{tmp_dir}/index"
    known, others = [f"id:{i}" for i in range(20_000)], [f"id:{i}" for i in range(20_000, 60_000)]
    keyindex.add(_keys(spark, known), index, "a", "a-0")
    assert keyindex.unseen(_keys(spark, known), index).count() == 0
    assert len(keyindex.may_hold(_keys(spark, known), index, keyindex.generations(spark, index))) == keyindex.BUCKETS
    # 40,000 new keys at one false hit in a million: hardly ever a bucket is read.
    assert len(keyindex.may_hold(_keys(spark, others), index, keyindex.generations(spark, index))) <= 3
    assert keyindex.unseen(_keys(spark, others + known[:10]), index).count() == 40_000


def test_filter_blocks_sort_a_key_once(spark):
    """The bitmaps are those of all of a key's positions, and what is shuffled and sorted is a row per key, not one per position."""
    keys, blocks = _keys(spark, [f"id:{i}" for i in range(3_000)] + ["twice", "twice"]), 3
    key = F.col(keyindex.KEY)
    rows = keys.select(keyindex.bucket(key).alias("Bucket"), keyindex.block(key, F.lit(blocks)).alias("Block"), F.explode(keyindex.probes(key)).alias("p"))
    want = {(r.Bucket, r.Block): bytes(r.Bits) for r in rows.groupBy("Bucket", "Block").agg(F.bitmap_construct_agg("p").alias("Bits")).collect()}
    made = keyindex.filter_blocks(keys, blocks)
    assert {(r.Bucket, r.Block): bytes(r.Bits) for r in made.collect()} == want
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("bitmap_construct_agg")  # above it: after the keys are one row per block


def test_a_batch_with_nothing_to_look_up_is_not_held(spark, tmp_dir, monkeypatch):
    """The first append reads its rows once, straight into the table; a later one holds them for lookup and append."""
    held = []
    persist = type(spark.range(1)).persist
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda df, *level: held.append(1) or persist(df, *level))
    for n in range(2):
        batch = spark.range(n, n + 3).select(F.concat(F.lit("id:"), "id").alias("EventKey"), F.to_date(F.lit("2024-01-01")).alias("EventDate"))
        assert ingest.append_unseen(batch, f"{tmp_dir}/t", "job", f"job-{n}") == (3, 1)[n]
        assert len(held) == n


def test_on_time_appends_write_few_files_per_date(spark, tmp_dir, monkeypatch):
    """A stateful stream has no adaptive execution: its dates are dealt out, not written by every shuffle partition."""
    monkeypatch.setattr(ingest, "FILES_PER_DATE", 2)
    docs = [_doc(f"e{i}", f"2024-01-{1 + i % 2:02d}T10:{i % 60:02d}:00.000000Z") for i in range(400)]
    _write(f"{tmp_dir}/src/a.json", docs)
    ingest.dedup_stream(spark, f"{tmp_dir}/src", f"{tmp_dir}/t", f"{tmp_dir}/ck", multiline=False)
    table = spark.read.parquet(f"{tmp_dir}/t")
    assert table.select("EventId").distinct().count() == table.count() == 400
    files = table.select("EventDate", F.input_file_name().alias("file")).distinct().groupBy("EventDate").agg(F.count("file").alias("n")).collect()
    assert len(files) == 2 and all(r.n <= 2 for r in files)


def test_only_generations_that_hold_a_key_are_read(spark, tmp_dir):
    index = f"{tmp_dir}/index"
    for g in range(3):
        keyindex.add(_keys(spark, [f"{g}-{i}" for i in range(500)]), index, "job", f"job-{g}")
    found = keyindex.may_hold(_keys(spark, ["1-7", "1-8", "new"]), index, keyindex.generations(spark, index))
    assert {p.split("/")[-2].split(".")[-1] for p in found} == {"job-1"} and len(found) <= 2
    assert all(folders.exists(spark, p) for p in found)


def test_generations_are_merged_by_level(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(keyindex, "MERGE_AT", 3)
    index = f"{tmp_dir}/index"
    for g in range(10):
        keyindex.add(_keys(spark, [f"{g}-{i}" for i in range(40)]), index, "job", f"job-{g}")
        keyindex.merge(spark, index, keep=f"job-{g}")
    held = keyindex.generations(spark, index)
    assert len(held) <= 6 and max(g.level for g in held) >= 1
    assert any(g.name == "job-9" for g in held)  # the running one is never merged
    every = [f"{g}-{i}" for g in range(10) for i in range(40)]
    assert keyindex.unseen(_keys(spark, [*every, "x"]), index).collect() == [("x",)]
    assert sorted(folders.children(spark, f"{index}/keys")) == sorted(g.folder for g in held)


def test_replayed_generation_replaces_itself(spark, tmp_dir):
    """A micro-batch that failed after its append, before or after its index entry, is repeated: its rows are there once."""
    target = f"{tmp_dir}/t"
    rows = spark.createDataFrame([(f"e{i}", dt.datetime(2024, 1, 1, i % 24), f"{{{i}}}", "f") for i in range(50)], "EventId string, EventTimeUtc timestamp, RawJson string, source_path string")
    for _ in range(2):
        assert ingest.idempotent_append(rows, target, checkpoint="/ck", batch_id=3) == 50
    # Cut off between the append and the index entry.
    index = ingest.index_of(target)
    keyindex.drop(spark, index, keyindex.generations(spark, index))
    folders.delete(spark, f"{index}/entered")
    assert ingest.idempotent_append(rows, target, checkpoint="/other", batch_id=0) == 0
    assert spark.read.parquet(target).count() == 50


def test_a_batch_of_new_keys_reads_no_key_and_no_row(spark, tmp_dir, monkeypatch):
    """The scans of an append: filters only, where all keys are new; the repeated keys' buckets, where not; never the table."""
    target, read = f"{tmp_dir}/t", []
    schema = "EventId string, EventTimeUtc timestamp, RawJson string, source_path string"

    def rows(a, b):
        return spark.createDataFrame([(f"e{i}", dt.datetime(2024, 1, 1), f"{{{i}}}", "f") for i in range(a, b)], schema)

    may_hold = keyindex.may_hold
    monkeypatch.setattr(keyindex, "may_hold", lambda *a: read.append(may_hold(*a)) or read[-1])
    plans = []
    append = ingest._append
    monkeypatch.setattr(ingest, "_append", lambda rows, *a: plans.append(rows.inputFiles()) or append(rows, *a))
    ingest.idempotent_append(rows(0, 300), target, checkpoint="/ck", batch_id=0)
    ingest.idempotent_append(rows(300, 600), target, checkpoint="/ck", batch_id=1)
    assert read[-1] == [] and plans[-1] == []
    ingest.idempotent_append(rows(590, 610), target, checkpoint="/ck", batch_id=2)
    assert 1 <= len(read[-1]) <= 10 and all("000000001/" in p for p in read[-1])
    assert plans[-1] and all("__keys/keys/" in p for p in plans[-1])
    assert spark.read.parquet(target).count() == 610


def test_state_is_bounded_by_the_delay(spark, tmp_dir):
    """Two days of hourly files, each event twice, a few late: all kept once, and the state never holds more than the delay's events."""
    src, target = f"{tmp_dir}/src", f"{tmp_dir}/t"
    n = 0
    for hour in range(24):
        time = f"2024-01-{1 + hour // 24:02d}T{hour % 24:02d}:%02d:00Z"
        docs = [_doc(f"h{hour}-{m}", time % m) for m in range(0, 60, 6)] * 2
        if hour >= 5:
            docs += [_doc(f"late-{hour}", f"2024-01-01T{hour - 5:02d}:30:00Z"), _doc(f"h{hour - 4}-6", f"2024-01-01T{hour - 4:02d}:06:00Z")]
        _write(f"{src}/{hour:02d}.json", docs, hour)
        n += 10 + (hour >= 5)
    progress = ingest.dedup_stream(spark, src, target, f"{tmp_dir}/ck", multiline=False, delay="1 hour", max_files_per_trigger=2)
    out = spark.read.parquet(target)
    assert out.count() == out.select("EventId").distinct().count() == n
    held = [s["numRowsTotal"] for p in progress for s in p["stateOperators"]]
    assert len(held) >= 12 and 0 < max(held) <= 45  # of 240 on-time events: two files and the hour before them
    assert sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"]) == 0
    assert folders.values(spark, f"{tmp_dir}/ck/staged", "Batch") == []


def test_on_time_events_look_up_no_own_generation(spark, tmp_dir, monkeypatch):
    looked = []
    unseen = keyindex.unseen
    monkeypatch.setattr(keyindex, "unseen", lambda batch, index, entries: looked.append([g.owner[-1] for g in entries]) or unseen(batch, index, entries))
    for hour in range(4):
        _write(f"{tmp_dir}/src/{hour}.json", [_doc(f"h{hour}", f"2024-01-01T{hour:02d}:00:00Z"), _doc(f"late{hour}", f"2023-01-01T{hour:02d}:00:00Z")], hour)
    ingest.dedup_stream(spark, f"{tmp_dir}/src", f"{tmp_dir}/t", f"{tmp_dir}/ck", multiline=False, max_files_per_trigger=1)
    # The first micro-batch has no watermark yet, and so no late part.
    on_time, behind = [looked[0], *looked[1::2]], looked[2::2]
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 8 and len(looked) == 7
    assert all(set(owners) <= {"l"} for owners in on_time)
    assert all("t" in owners for owners in behind)


def test_cut_off_run_is_completed(spark, tmp_dir, monkeypatch):
    """A run that fails between staging and settling loses nothing and repeats nothing."""
    for hour in range(3):
        _write(f"{tmp_dir}/src/{hour}.json", [_doc(f"h{hour}", f"2024-01-01T{hour:02d}:00:00Z")] * 2, hour)
    append, calls = ingest.append_unseen, []

    def failing(*a, **k):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return append(*a, **k)

    monkeypatch.setattr(ingest, "append_unseen", failing)
    with pytest.raises(Exception, match="lost"):
        ingest.dedup_stream(spark, f"{tmp_dir}/src", f"{tmp_dir}/t", f"{tmp_dir}/ck", multiline=False, max_files_per_trigger=1)
    ingest.dedup_stream(spark, f"{tmp_dir}/src", f"{tmp_dir}/t", f"{tmp_dir}/ck", multiline=False, max_files_per_trigger=1)
    assert sorted(r.EventId for r in spark.read.parquet(f"{tmp_dir}/t").collect()) == ["h0", "h1", "h2"]


def test_run_log_of_batches_and_of_a_failure(spark, tmp_dir):
    for i in range(3):
        _write(f"{tmp_dir}/src/{i}.json", [_doc(f"e{j}", "2024-01-01T00:00:00Z") for j in range(i, i + 4)], i)
    path = f"{tmp_dir}/log"
    with runlog.RunLog(spark, path, "job") as log:
        ingest.normalise_stream(spark, f"{tmp_dir}/src", f"{tmp_dir}/t", f"{tmp_dir}/ck", multiline=False, max_files_per_trigger=1, log=log)
    rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r.RunId)
    assert [(r.Status, r.RowsRead, r.RowsWritten) for r in rows] == [("Succeeded", 4, 4), ("Succeeded", 4, 1), ("Succeeded", 4, 1)]
    assert all(r.RunStartUtc <= r.RunEndUtc and r.PipelineOrJobName == "job" for r in rows)

    def broken(batch, n):
        raise ValueError("sink is gone")

    with runlog.RunLog(spark, f"{tmp_dir}/failed", "broken job"), pytest.raises(Exception):
        late.run(spark.readStream.schema("value string").text(f"{tmp_dir}/src").writeStream.foreachBatch(broken).option("checkpointLocation", f"{tmp_dir}/ck2"), name="broken job")
    failed = spark.read.parquet(f"{tmp_dir}/failed").collect()
    assert [(r.Status, r.RowsRead) for r in failed] == [("Failed", None)] and "sink is gone" in failed[0].ErrorMessage


@pytest.mark.parametrize("files_per_batch", [1, None])
def test_spans_of_any_split_are_the_batch_runs(spark, tmp_dir, files_per_batch):
    """Events in any order over micro-batches, late ones far behind: the runs of the whole log; the state leaves."""
    import random

    rnd = random.Random(5)
    start = dt.datetime(2024, 3, 1)
    events = [("ab"[rnd.randrange(2)], start + dt.timedelta(seconds=rnd.randrange(3 * 86400)), rnd.choice([200, 500]), f"e{i}") for i in range(400)]
    events += [(None, start, 200, "no item"), ("a", None, 200, "no time")]
    order = sorted(events, key=lambda e: (e[1] or start) + dt.timedelta(hours=rnd.choice([0, 0, 0, 1, 30])))
    log = f"{tmp_dir}/log"
    schema = "ItemId string, EventTimeUtc timestamp, HttpStatusCode int, EventId string"
    for g in range(0, len(order), 67):
        part = spark.createDataFrame(order[g: g + 67], schema).withColumns({"Generation": F.lit(f"g{g:04d}"), "EventDate": F.to_date("EventTimeUtc")})
        part.coalesce(1).write.mode("append").partitionBy("Generation", "EventDate").parquet(log)
    progress = sessions.span_stream(spark, log, f"{tmp_dir}/out", f"{tmp_dir}/ck", max_files_per_trigger=files_per_batch)
    want = marts.job_sessions(spark.createDataFrame(events, schema))
    got = sessions.sessions(spark, f"{tmp_dir}/out")
    columns = ["ItemId", "JobStartTime", "JobEndTime", "events", "failed"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))
    if files_per_batch == 1:
        assert max(s["numRowsTotal"] for p in progress for s in p["stateOperators"]) < 150  # of some 290 half gaps


def test_the_stream_fills_the_catalog_table(spark, tmp_dir):
    prefix = "w" + os.path.basename(tmp_dir).replace("-", "").lower()[-8:] + "_"
    names = sinks.bootstrap_tables(spark, tmp_dir, prefix)
    assert spark.table(names[0]).count() == 0
    _write(f"{tmp_dir}/src/a.json", [_doc("e1", "2024-01-01T00:00:00Z"), _doc("e2", None)], 0)
    ingest.normalise_stream(spark, f"{tmp_dir}/src", f"{tmp_dir}/silver/log_event_access", f"{tmp_dir}/ck", multiline=False)
    sinks.refresh_table(spark, names[0])
    rows = spark.table(names[0]).select("EventId", "EventKey", F.col("EventDate").cast("string")).collect()
    assert sorted(map(tuple, rows), key=str) == [("e1", "id:e1", "2024-01-01"), ("e2", "id:e2", None)]
    assert spark.table(names[0]).where("EventDate = DATE '2024-01-01'").count() == 1
    sinks.drop_tables(spark, names)
