"""Mixing sources to target weights."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.llm import mixing
from tidepool.llm.queries import QUERIES
from tidepool.sources.tables import load

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, source string, n_chars bigint, row int, key string, size double, words int, spans string"


def goals(size_of):
    """Targets by the contract's own steps: share by weight, stop at twice the size, share the excess again."""
    order = sorted((s for s in size_of if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in size_of else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    stopped: set = set()
    while True:
        left = 1.5 * sum(size_of.values()) - sum(2 * size_of[s] for s in stopped)
        all_weight = sum(w for s, w in weight.items() if s not in stopped)
        more = {s for s in order if s not in stopped and weight[s] * left / all_weight > 2 * size_of[s] * (1 + 1e-12)}
        if not more:
            return {s: 2.0 * size_of[s] if s in stopped else weight[s] * left / all_weight for s in order}
        stopped |= more


def check(rows, out):
    sizes = Counter()
    for _, text, source, *_ in rows:
        sizes[source] += len(WORD.findall(text or ""))
    want = goals(sizes)
    taken = Counter()
    for r in out:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], abs=1e-6)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5001
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in out) == sorted((r[0] is None, r[0] or 0, len(WORD.findall(r[1] or ""))) for r in rows)


def test_permutations(spark):
    for n in (1, 2, 7, 100):
        df = spark.range(n).select("id", F.lit(n).cast("bigint").alias("n"))
        df = df.withColumn("p", mixing.permuted(F.col("id"), F.col("n"), F.lit(3), F.lit("s")))
        df = df.withColumn("q", mixing.unpermuted(F.col("p"), F.col("n"), F.lit(3), F.lit("s")))
        got = df.collect()
        assert sorted(r.p for r in got) == list(range(n)) and all(r.q == r.id for r in got)
    assert [r.p for r in sorted(got, key=lambda r: r.id)] != list(range(100))


ODD = [(k, t, s, 5, 1, "k", 0.5, 2, "x") for k, (t, s) in enumerate([
    (None, "a"), ("", "a"), ("one", "a"), (" lead  and\n trail ", "a"), ("w" * 5000, None), ("a b c " * 2000, "b"), ("\x1cone\xa0two three", "É"),
    ("x y", "z"), ("x y z " * 50, "Z"), ("only", None), ("  ", "blank")])] + [(5, "again again", "b", 5, 1, "k", 0.5, 2, "x")] * 3 + [(None, "no id " * 9, "a", 5, 1, "k", 0.5, 2, "x")] * 2


@pytest.mark.parametrize("block", [1, 4, 256])
def test_taken_words(spark, monkeypatch, block):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 3)
    monkeypatch.setattr(mixing, "STEP_SLOTS", 5 if block > 1 else 4096)
    docs = spark.createDataFrame(ODD, DOCS)
    out = mixing.taken_words(docs, block_words=block).collect()
    check(ODD, out)
    again = mixing.taken_words(docs.repartition(3), block_words=block).collect()
    key = lambda rows: sorted((str(r.doc_id), r.size, r.taken) for r in rows)
    assert Counter(str(r.doc_id) for r in out) == Counter(str(r.doc_id) for r in again)
    same = [k for k in key(out) if k[0] not in ("5", "None")]
    assert same == [k for k in key(again) if k[0] not in ("5", "None")]


def test_nothing_to_mix(spark):
    empty = spark.createDataFrame([], DOCS)
    assert mixing.taken_words(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    blank = spark.createDataFrame([(1, "", "a", 0, 1, "k", 0.5, 2, "x"), (2, None, None, 0, 1, "k", 0.5, 2, "x")], DOCS)
    assert [(r.size, r.source_size, r.target, r.taken) for r in mixing.taken_words(blank).collect()] == [(0, 0, 0.0, 0)] * 2
    assert mixing.mixed_documents(blank).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text, r.source) for r in load(spark, sf, "documents").collect()]
    check(rows, QUERIES["op5_mixing"](spark, sf).collect())


def test_slots_and_shards(spark):
    """Every slot is used once, shards hold draws of all large sources, and no block comes twice in a pass."""
    docs = spark.createDataFrame([(k, "w " * 40, "ab"[k % 2], 0, 1, "k", 0.5, 2, "x") for k in range(400)], DOCS)
    sized = mixing.sizes(docs)
    drawn = mixing.draws(mixing.targets(sized), 16, 1)
    slots = mixing.slots(drawn, 16, 64, 1).collect()
    assert sorted(r.position for r in slots) == list(range(len(slots))) and {r.position // 64 for r in slots} == {r.shard for r in slots}
    assert len({(r.key, r.block, r["pass"]) for r in slots}) == len(slots)
    share = Counter((r.shard, r.key) for r in slots)
    whole = [s for s in range(len(slots) // 64)]
    assert len({share[s, "=a"] for s in whole}) > 3 and all(30 < share[s, "=a"] < 62 for s in whole)


def test_shard_counts_are_a_draw_without_replacement(spark, monkeypatch):
    """Rows and columns of the counts add up exactly, and counts vary as draws do; draws are numbered through the shards."""
    monkeypatch.setattr(mixing, "SHARD_CHUNK", 3)
    docs = spark.createDataFrame([(k, "w " * 40, "abc"[k % 3], 0, 1, "k", 0.5, 2, "x") for k in range(900)], DOCS)
    drawn = mixing.draws(mixing.targets(mixing.sizes(docs)), 4, 1)
    want = {r.key: r.slots for r in drawn.collect()}
    counts = mixing.shard_counts(drawn, 256, 1).collect()
    total = sum(want.values())
    by_key, by_shard = Counter(), Counter()
    for r in counts:
        by_key[r.key] += r.n
        by_shard[r.shard] += r.n
    assert by_key == want and [by_shard[s] for s in sorted(by_shard)] == [256] * (total // 256) + [total % 256] * (total % 256 > 0)
    for key in want:
        at = 0
        for r in sorted((r for r in counts if r.key == key), key=lambda r: r.shard):
            assert r.before == at
            at += r.n
        p, whole = want[key] / total, [r.n for r in counts if r.key == key and by_shard[r.shard] == 256]
        spread = (256 * p * (1 - p)) ** 0.5
        assert 0.5 * spread < np.std(whole) < 1.5 * spread and max(abs(n - 256 * p) for n in whole) < 5 * spread


def test_the_deal_by_brute_force(spark):
    """Slots from counts: the k-th draw of a source is block permuted(k) of its pass, at its own place of the shard."""
    docs = spark.createDataFrame([(k, "w " * (3 + k % 9), "ab"[k % 2], 0, 1, "k", 0.5, 2, "x") for k in range(60)], DOCS)
    drawn = mixing.draws(mixing.targets(mixing.sizes(docs)), 4, 1)
    sources = {r.key: r for r in drawn.collect()}
    counts = mixing.shard_counts(drawn, 16, 1).collect()
    asked = [(r.key, r.before + i, (r.before + i) % sources[r.key].blocks, (r.before + i) // sources[r.key].blocks, sources[r.key].blocks, r.shard, r.lead + i) for r in counts for i in range(r.n)]
    df = spark.createDataFrame(asked, "key string, k bigint, nth bigint, pass bigint, blocks bigint, shard bigint, i bigint")
    total = len(asked)
    size = F.least(F.lit(16), F.lit(total) - F.col("shard") * 16)
    df = df.withColumn("block", mixing.permuted(F.col("nth"), F.col("blocks"), F.lit(1), F.col("key"), F.col("pass")))
    df = df.withColumn("position", F.col("shard") * 16 + mixing.permuted(F.col("i"), size.cast("bigint"), F.lit(1), F.lit("shard"), F.col("shard")))
    want = sorted((r.shard, r.position, r.key, r["pass"], r.block) for r in df.collect())
    got = sorted((r.shard, r.position, r.key, r["pass"], r.block) for r in mixing.slots(drawn, 4, 16, 1).collect())
    assert got == want and [p for _, p, *_ in got] == list(range(total))


def test_slots_are_made_in_many_tasks(spark):
    """A plan test: the slots behind the explosion are in a stated number of partitions, which later merging leaves alone."""
    docs = spark.createDataFrame([(k, "w " * 40, "ab"[k % 2], 0, 1, "k", 0.5, 2, "x") for k in range(400)], DOCS)
    drawn = mixing.draws(mixing.targets(mixing.sizes(docs)), 4, 1)
    made = mixing.slots(drawn, 4, 256, 1)
    assert made.groupBy(F.spark_partition_id()).count().count() >= spark.sparkContext.defaultParallelism
    assert mixing.tasks(spark, 10**9) == -(-10**9 // mixing.TASK_SLOTS)


def test_one_id_on_very_many_rows(spark, monkeypatch):
    """One id (and one text) on most rows is spread over chunks, and all words are dealt with."""
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 50)
    rows = [(7, "same words here", "a", 5, 1, "k", 0.5, 2, "x")] * 700 + [(k, f"other words {k}", "b", 5, 1, "k", 0.5, 2, "x") for k in range(300)]
    docs = spark.createDataFrame(rows, DOCS)
    check(rows, mixing.taken_words(docs, block_words=8).collect())
    sized = mixing.sizes(docs)
    parts = mixing.parts(sized, 8).groupBy("key", "block").agg(F.sum("n").alias("n")).collect()
    assert sum(r.n for r in parts) == 700 * 3 + 300 * 3 and max(r.n for r in parts) == 8


def test_mixed_documents_lie_in_the_order_of_the_mix(spark):
    docs = spark.createDataFrame([(k, " ".join(f"d{k}w{i}" for i in range(64)), "ab"[k % 2], 0, 1, "k", 0.5, 2, "x") for k in range(200)], DOCS)
    place = {}
    sized = mixing.sizes(docs)
    for r in mixing.mix(sized, mixing.targets(sized), block_words=64).collect():
        place.setdefault((r.doc_id, r["pass"]), []).append(r.position)
    out = mixing.mixed_documents(docs, block_words=64).withColumn("p", F.spark_partition_id()).withColumn("i", F.monotonically_increasing_id()).orderBy("p", "i").collect()
    firsts = sorted((min(v), k[0]) for k, v in place.items())
    assert [r.doc_id for r in out] == [d for _, d in firsts]


@pytest.mark.parametrize("block", [2, 256])
def test_mixed_documents(spark, block):
    docs = spark.createDataFrame(ODD, DOCS)
    out = mixing.mixed_documents(docs, block_words=block)
    assert out.columns == docs.columns
    rows, texts = out.collect(), {}
    for r in ODD:
        texts.setdefault((r[0], r[2]), []).append(r[1])
    sizes, taken = Counter(), Counter()
    for _, t, s, *_ in ODD:
        sizes[s] += len(WORD.findall(t or ""))
    for r in rows:
        taken[r.source] += len(WORD.findall(r.text))
        if r.text in texts[r.doc_id, r.source]:
            assert r.n_chars == 5  # whole texts stay as they are
        else:
            assert r.n_chars == len(r.text)
            assert any(Counter(WORD.findall(r.text)) <= Counter(WORD.findall(t or "")) for t in texts[r.doc_id, r.source])
    for s, want in goals(sizes).items():
        assert abs(taken[s] - want) <= 0.5001
