"""Stateful exact deduplication against groups by text."""

import hashlib
import json
import os
import re

import pytest

from tidepool.llm import common, exact_dedup
from tidepool.llm.queries import QUERIES
from tidepool.sources.tables import load

BLANKS = re.compile(r"[\x20\x09-\x0D]")
SCHEMA = "doc_id bigint, text string, digest string, file int"

ROWS = [
    (5, "the same  text"), (3, "the same text"), (9, "thesametext\n"), (8, "the same\t\ttext"), (7, "other"), (1, "other"), (2, "other"),
    (None, "other"), (None, None), (4, ""), (6, " \n"), (10, "é 漢"), (11, "é漢"), (12, " "), (13, "\x00"), (14, "word " * 50_000), (15, "word" * 50_000),
    (16, "twice"), (16, "twice"),
]


def brute(rows):
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault(BLANKS.sub("", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0, i))
    out = []
    for text, members in groups.items():
        first = min(members)
        for m in members:
            out.append((None if m[1] else m[2], None if first[1] else first[2], len(members), m == first, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "digest").collect()), key=str)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The rows over several files, with other columns whose names clash."""
    path = str(tmp_path_factory.mktemp("texts"))
    for i in range(0, len(ROWS), 4):
        spark.createDataFrame([(*r, "x", 1) for r in ROWS[i: i + 4]], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


def test_groups(spark, folder):
    assert found(exact_dedup.deduplicated(spark, exact_dedup.stream_of(folder))) == brute(ROWS)


def test_many_micro_batches_and_a_later_run(spark, folder):
    """One file a micro-batch, then files that arrive later: the state goes on, nothing is read twice, and it never expires."""
    base = common.scratch_uri(spark, "test")
    source = exact_dedup.stream_of(folder, files_per_trigger=1)
    settings = dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    exact_dedup.run(spark, source, base, files_per_trigger=1)
    assert found(exact_dedup.resolved(spark, base)) == brute(ROWS)
    more = [(0, "the same text, but"), (17, "the   same     text"), (18, "new"), (19, "w o r d" * 3)]
    spark.createDataFrame([(*r, "x", 1) for r in more], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    exact_dedup.run(spark, source, base, files_per_trigger=1)
    exact_dedup.run(spark, source, base, files_per_trigger=1)
    got = exact_dedup.resolved(spark, base)
    assert found(got) == brute(ROWS + more) and got.where("kept").count() == len({r[-1] for r in brute(ROWS + more)})
    assert settings == (dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.streaming.stateStore.providerClass"))
    # The state is RocksDB's, and has no watermark.
    place = base.removeprefix("file://")
    newest = max((p for p in os.listdir(f"{place}/settling-checkpoint/offsets") if p.isdigit()), key=int)
    meta = open(f"{place}/settling-checkpoint/offsets/{newest}").read().splitlines()[1]
    assert json.loads(meta)["conf"]["spark.sql.streaming.stateStore.providerClass"] == exact_dedup.ROCKSDB


@pytest.mark.parametrize("files", [1, 100])
def test_equal_digests_of_different_texts(spark, tmp_path, files):
    """A digest of one bit: the contents' bytes tell the texts apart, over many micro-batches too."""
    rows = [(i, f"{chr(97 + i % 6)} text {i % 12}" + " " * (i % 3)) for i in range(60)]
    for i in range(0, 60, 15):
        spark.createDataFrame(rows[i: i + 15], "doc_id bigint, text string").coalesce(1).write.mode("append").parquet(str(tmp_path))
    base = common.scratch_uri(spark, "test")
    exact_dedup.run(spark, exact_dedup.stream_of(str(tmp_path), files_per_trigger=files), base, digest=lambda content: str(content[0] % 2), files_per_trigger=files)
    got = exact_dedup.resolved(spark, base).select("doc_id", "keep_id", "group_size", "kept").collect()
    assert sorted(map(tuple, got), key=str) == [r[:4] for r in sorted(brute(rows), key=str)]


def test_one_group_has_one_content_per_task(spark, tmp_path):
    """400 copies in 4 files are written, hashed and checked by the task: at most 4 contents, whatever the copies."""
    for _ in range(4):
        spark.createDataFrame([(i, "copy") for i in range(100)], "doc_id bigint, text string").coalesce(1).write.mode("append").parquet(str(tmp_path))
    base = common.scratch_uri(spark, "test")
    exact_dedup.run(spark, exact_dedup.stream_of(str(tmp_path)), base)
    landed = spark.read.parquet(f"{base}/landed")
    assert landed.count() == 400 and landed.select("file", "at").distinct().count() <= 4
    kept = exact_dedup.resolved(spark, base).where("kept").collect()
    assert [(r.doc_id, r.group_size) for r in kept] == [(0, 400)]


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.mode("overwrite").parquet(str(tmp_path / "none"))
    assert exact_dedup.deduplicated(spark, exact_dedup.stream_of(str(tmp_path / "none"))).count() == 0


def test_the_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in load(spark, sf, "documents").collect()]
    got = QUERIES["op13_exact_dedup"](spark, sf).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
