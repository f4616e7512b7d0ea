"""Access-log parsing and ingestion on hand-made edge documents (FIXTURES.md §1)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidepool.functions import jsonlog
from tidepool.sources import derived, files
from tidepool.streaming import ingest


def _doc(i, **data):
    d = {"id": f"e{i}", "time": "2024-03-01T10:00:00.250Z", "category": "DataAccess", "type": "Read",
         "schemaVersion": "1.0", "resourceId": "/ws/1"}
    if data:
        d["data"] = data
    return d


EDGE_DOCS = [
    _doc(1),  # no data at all
    _doc(2, durationMs=1500, accessStartTime="2024-03-01T10:00:00Z", accessEndTime="2024-03-01T10:00:09Z"),
    _doc(3, accessStartTime="2024-03-01T10:00:00.100Z", accessEndTime="2024-03-01T10:00:01.350Z"),
    _doc(4, durationMs="x", accessStartTime="2024-03-01T10:00:00Z", accessEndTime="2024-03-01T10:00:02Z"),
    _doc(5, accessStartTime="2024-03-01T10:00:00Z"),  # start without end
    _doc(6, accessStartTime="2024-03-01T10:00:05Z", accessEndTime="2024-03-01T10:00:00Z"),  # end before start
    _doc(7, isShortcut="true"),
    _doc(8, isShortcut=True),
    _doc(9, isShortcut="zz"),
    _doc(10, httpStatusCode=99999999999),
    _doc(11, httpStatusCode=404, unknownField=1),
    _doc(12, workspaceName={"nested": 1}),
]


def _flat(spark, docs, precision="milli"):
    raw = spark.createDataFrame([(json.dumps(d),) for d in docs], "RawJson string")
    return {r["EventId"]: r for r in jsonlog.flatten_access_log(raw, duration_precision=precision).collect()}


def test_edge_values(spark):
    rows = _flat(spark, EDGE_DOCS)
    assert rows["e1"]["TenantId"] is None and rows["e1"]["DurationMs"] is None
    assert rows["e1"]["EventTimeUtc"].microsecond == 250000
    assert rows["e2"]["DurationMs"] == 1500  # explicit field wins
    assert rows["e3"]["DurationMs"] == 1250  # sub-second kept
    assert rows["e4"]["DurationMs"] == 2000  # "x" -> fallback
    assert rows["e5"]["DurationMs"] is None
    assert rows["e6"]["DurationMs"] == -5000
    assert rows["e7"]["IsShortcut"] is True and rows["e8"]["IsShortcut"] is True
    assert rows["e9"]["IsShortcut"] is None
    assert rows["e10"]["HttpStatusCode"] is None
    assert rows["e11"]["HttpStatusCode"] == 404
    assert json.loads(rows["e12"]["WorkspaceName"]) == {"nested": 1}


def test_second_precision_matches_reference_arithmetic(spark):
    rows = _flat(spark, EDGE_DOCS, "second")
    assert rows["e3"]["DurationMs"] == 1000  # whole seconds: 10:00:01 - 10:00:00


def test_malformed_time_is_null_not_error(spark):
    d = _doc(99)
    d["time"] = "2024-13-45T99:00:00Z"
    raw = spark.createDataFrame([(json.dumps(d),), ("{not json",)], "RawJson string")
    out = jsonlog.flatten_access_log(raw).collect()
    assert [r["EventTimeUtc"] for r in out] == [None, None]


def test_extracted_values_equal_the_flatten(spark):
    raw = spark.createDataFrame([(json.dumps(d),) for d in EDGE_DOCS], "RawJson string")
    paths = {n: p for n, p, t in jsonlog.ACCESS_LOG_COLUMNS if p is not None and t == "string" and n != "WorkspaceName"}
    a = jsonlog.flatten_access_log(raw).select(*paths)
    b = jsonlog.extract(raw, paths)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_same_text_without_id_is_kept_and_replayed_once(spark, tmp_dir):
    """Equal documents without an id, in one file and in two, are events of their own; replays add none."""
    doc = json.dumps({"time": "2024-01-01T00:00:00Z", "data": {"itemId": "i"}})
    _write(f"{tmp_dir}/src/a.json", f"{doc}\n{doc}\n")
    _write(f"{tmp_dir}/src/b.json", doc)
    for run in range(2):
        ingest.normalise_stream(spark, f"{tmp_dir}/src", f"{tmp_dir}/t", f"{tmp_dir}/ck{run}", multiline=False)
        assert spark.read.parquet(f"{tmp_dir}/t").count() == 3


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_discovery_suffix_and_recursion(spark, tmp_dir):
    _write(f"{tmp_dir}/a/x.json", "{}")
    _write(f"{tmp_dir}/b/c/Y.JSON", "{}")
    _write(f"{tmp_dir}/b/z.txt", "{}")
    names = [r["path"].rsplit("/", 1)[-1] for r in files.list_files(spark, tmp_dir).collect()]
    assert sorted(names) == ["Y.JSON", "x.json"]


def test_multiline_ingest_twice_is_once_and_late_small_path(spark, tmp_dir):
    src, target, ck = f"{tmp_dir}/src", f"{tmp_dir}/target", f"{tmp_dir}/ck"
    pretty = [json.dumps(d, indent=2) for d in EDGE_DOCS[:3]]
    _write(f"{src}/z/one.json", pretty[0])
    _write(f"{src}/y/one.json", pretty[1])  # same base name, other folder (D4)
    _write(f"{src}/y/empty.json", "")
    ingest.normalise_stream(spark, src, target, ck, multiline=True)
    ingest.normalise_stream(spark, src, target, ck, multiline=True)
    assert spark.read.parquet(target).count() == 2
    _write(f"{src}/a/late.json", pretty[2])  # later file, smaller path (D3)
    dup = dict(EDGE_DOCS[0])
    _write(f"{src}/a/dup.json", json.dumps(dup))  # same id as an ingested event
    ingest.normalise_stream(spark, src, target, ck, multiline=True)
    got = sorted(r[0] for r in spark.read.parquet(target).select("EventId").collect())
    assert got == ["e1", "e2", "e3"]


@pytest.mark.parametrize("files_per_batch", [None, 1])
def test_watermark_dedup(spark, tmp_dir, files_per_batch):
    """Copies in one micro-batch or in separate ones: each event kept once."""
    src, target, ck = f"{tmp_dir}/src", f"{tmp_dir}/target", f"{tmp_dir}/ck"
    lines = "\n".join(json.dumps(d) for d in EDGE_DOCS[:4])
    _write(f"{src}/a.json", lines)
    _write(f"{src}/b.json", lines)
    ingest.dedup_stream(spark, src, target, ck, multiline=False, max_files_per_trigger=files_per_batch)
    assert spark.read.parquet(target).count() == 4


@pytest.mark.parametrize("files_per_batch", [None, 1])
def test_watermark_dedup_of_files_in_falling_time(spark, tmp_dir, files_per_batch):
    """Files that come in falling event time lose no event; copies, late or not, stay out, events without id or time stay in."""
    src, target = f"{tmp_dir}/src", f"{tmp_dir}/target"

    def doc(name, hour):
        return {k: v for k, v in (("id", name), ("time", hour and f"2024-01-15T{hour:02d}:30:00Z"), ("type", "Access.Read")) if v}

    days = [[doc("e20", 20), doc("e20", 20), doc("x20", 20)], [doc("e14", 14), doc("x20", 20)],
            [doc("e08", 8), doc(None, 8), doc(None, 8), doc("no-time", None)], [doc("e08", 8), doc("e14", 14), doc("e21", 21)]]
    for n, docs in enumerate(days):
        _write(f"{src}/{n}.json", "\n".join(map(json.dumps, docs)))
        os.utime(f"{src}/{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    for run in range(2):  # a second checkpoint replays every file
        ingest.dedup_stream(spark, src, target, f"{tmp_dir}/ck{run}", multiline=False, max_files_per_trigger=files_per_batch)
        got = sorted(str(r[0]) for r in spark.read.parquet(target).select("EventId").collect())
        assert got == ["None", "None", "e08", "e14", "e20", "e21", "no-time", "x20"]


def test_rebuild_keeps_values(spark):
    df = spark.createDataFrame([(1, None, 2.5)], "a long, b string, c double")
    out = jsonlog.rebuild_raw_json(df).select("RawJson").first()[0]
    assert json.loads(out) == {"a": 1, "c": 2.5}
    kept = jsonlog.rebuild_raw_json(df, keep_nulls=True).select("RawJson").first()[0]
    assert json.loads(kept) == {"a": 1, "b": None, "c": 2.5}


def test_bounded_micro_batches_drain_everything(spark, tmp_dir):
    src, target, ck = f"{tmp_dir}/src", f"{tmp_dir}/target", f"{tmp_dir}/ck"
    for i, d in enumerate(EDGE_DOCS):
        _write(f"{src}/f{i:02d}.json", json.dumps(d))
    ingest.normalise_stream(spark, src, target, ck, multiline=True, max_files_per_trigger=3)
    assert spark.read.parquet(target).count() == len(EDGE_DOCS)


def test_empty_inputs(spark, tmp_dir):
    empty = spark.createDataFrame([], "RawJson string")
    flat = jsonlog.flatten_access_log(empty)
    assert flat.count() == 0
    assert [(f.name, f.dataType) for f in flat.schema.fields] == \
        [(f.name, f.dataType) for f in jsonlog.ACCESS_LOG_SCHEMA.fields]
    os.makedirs(f"{tmp_dir}/src")
    with pytest.raises(ingest.NoInputFilesError):
        ingest.normalise_stream(spark, f"{tmp_dir}/src", f"{tmp_dir}/t", f"{tmp_dir}/ck", require_files=True)
    ingest.normalise_stream(spark, f"{tmp_dir}/src", f"{tmp_dir}/t", f"{tmp_dir}/ck2")  # lenient: nothing
    assert not files.path_exists(spark, f"{tmp_dir}/t")


def test_typed_struct_reads_numbers_as_numbers(spark, tmp_dir):
    """The multi-line reader with numbers typed: the values of the all-string struct, a misplaced one null and its neighbours kept."""
    docs = [{"id": "1", "data": {"itemId": "a", "durationMs": 12, "httpStatusCode": 200, "isShortcut": True}},
            {"id": "2", "data": {"itemId": "b", "durationMs": "x", "httpStatusCode": 404}}]
    os.makedirs(f"{tmp_dir}/j")
    with open(f"{tmp_dir}/j/a.json", "w") as fh:
        fh.write(json.dumps(docs, indent=1))
    names = ["id", "data.itemId", "data.durationMs", "data.httpStatusCode", "data.isShortcut"]
    typed = files.read_json_typed(spark, f"{tmp_dir}/j", jsonlog.TYPED_STRUCT).select(*names)
    assert [t for _, t in typed.dtypes] == ["string", "string", "bigint", "int", "boolean"]
    assert sorted(map(tuple, typed.collect())) == [("1", "a", 12, 200, True), ("2", "b", None, 404, None)]


def test_compressed_deliveries_are_ingested(spark, tmp_dir):
    """Gzipped JSON lines in files of a bounded number of documents: each event once, and nothing of other files."""
    docs = spark.range(40).selectExpr("CAST(id AS STRING) AS id", "'2024-03-01T10:00:00Z' AS time")
    derived.deliver(docs, f"{tmp_dir}/src/a")
    docs.limit(1).withColumn("id", F.lit("plain")).write.json(f"{tmp_dir}/src/b")
    for _ in range(2):
        ingest.normalise_stream(spark, f"{tmp_dir}/src", f"{tmp_dir}/t", f"{tmp_dir}/ck", multiline=False, max_files_per_trigger=2, glob=files.GZIP_GLOB)
    assert sorted(int(r[0]) for r in spark.read.parquet(f"{tmp_dir}/t").select("EventId").collect()) == list(range(40))
    assert all(n.endswith(".json.gz") for n in os.listdir(f"{tmp_dir}/src/a") if n.startswith("part"))
