"""The corpus pipeline: every stage against brute force on its own input."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_groups import brute_fp, brute_groups
from test_mixing import goals
from tidepool.llm import common, quality, toxicity
from tidepool.llm.encoding import Encoder, public_tokenizer
from tidepool.sources.tables import load

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output rows of every stage, on documents with odd rows added."""
    docs = load(spark, SF, "documents").withColumns({"key": F.lit("extra"), "quality_verdict": F.lit(1)})
    odd = spark.createDataFrame([
        (None, "a text without an id that is long enough to stay in the corpus for good", "en", None, 3, "odd", 1),
        (90001, None, "en", "src0", 3, "odd", 1), (90002, "", None, "src0", None, "odd", 1),
        (90003, "unlike any other words here, but quite long and without repeats, so it is kept", "xx", "new", 7, "odd", 1),
        (90003, "unlike any other words here, but quite long and without repeats, so it is kept", "xx", "new", 7, "odd", 1),
        (90004, " ".join(f"w{i}" for i in range(30_000)), "en", "new", 7, "odd", 1)], docs.schema)
    now, out = common.stored(docs.unionByName(odd), "test"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = common.stored(stage(spark, now, SF), "test")
        out[name] = (now.collect(), after.collect(), now.columns, after.columns)
        now = after
    return out


def key(r):
    return str(r.doc_id), r.text


def test_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "simhash_near_dedup", "mixing", "best_fit_packing"]
    for name, (_, _, before, after) in steps.items():
        assert name == "best_fit_packing" or before == after


def test_toxicity(spark, steps):
    before, after, *_ = steps["toxicity"]
    model = toxicity.fit(load(spark, SF, "documents"), load(spark, SF, "labels"))
    forms = toxicity.Forms(toxicity.Automaton(model.terms))
    assert sorted(map(key, after), key=str) == sorted((key(r) for r in before if model.score(r.text, forms) < 0.7), key=str)


def test_quality(spark, steps):
    before, after, *_ = steps["quality_rules"]
    counts = np.array([quality.text_counts(r.text) for r in before])
    forest = quality.fit(spark.createDataFrame([(r.doc_id, r.text) for r in before], "doc_id bigint, text string"), load(spark, SF, "labels"))
    keep = ~quality.base_failed(counts) & ~(forest.score(quality.features(counts)) > forest.threshold)
    assert sorted(map(key, after), key=str) == sorted((key(r) for r, k in zip(before, keep) if k), key=str)
    assert {"90003", "90004", "None"} <= {str(r.doc_id) for r in after}


def test_near_duplicates(steps):
    before, after, *_ = steps["simhash_near_dedup"]
    groups = brute_groups([brute_fp(r.text) for r in before], 3)
    low = {}
    for g, r in zip(groups, before):
        low.setdefault(g, set()).add(r.doc_id)
    want = [min((i for i in ids if i is not None), default=None) for ids in low.values()]
    assert sorted(map(str, want)) == sorted(str(r.doc_id) for r in after)
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_mixing(steps):
    before, after, *_ = steps["mixing"]
    sizes, taken, own = Counter(), Counter(), Counter()
    for r in before:
        sizes[r.source] += len(WORD.findall(r.text))
        own[str(r.doc_id)] += len(WORD.findall(r.text))
    each = Counter()
    for r in after:
        taken[r.source] += len(WORD.findall(r.text))
        each[str(r.doc_id)] += len(WORD.findall(r.text))
    assert all(abs(taken[s] - t) <= 0.5001 for s, t in goals(sizes).items())
    assert all(n <= 2 * own[k] for k, n in each.items())


def test_packing(steps):
    before, after, *_ = steps["best_fit_packing"]
    enc = Encoder(public_tokenizer())
    want = Counter()
    for r in before:
        ids = np.append(enc.tokenizer.encode(r.text, add_special_tokens=False).ids, 0).astype("<u4")
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids), 2048), len(ids)]
        want.update((str(r.doc_id), k, a, zlib.crc32(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((str(r.doc_id), r.piece, r.start, r.ids_crc32) for r in after) == want
    used = Counter()
    for r in sorted(after, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used[r.sequence_id]
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048 and len(used) <= -(-sum(used.values()) // 2048) * 1.03 + 1


def test_run_and_no_documents(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(out.columns)
    docs = load(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, SF), "test")
    assert docs.count() == 0
