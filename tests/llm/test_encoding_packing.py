"""Encoding by pieces, token files, best-fit packing."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidepool.llm import encoding, packing, token_store
from tidepool.llm.encoding import Encoder, public_tokenizer
from tidepool.llm.queries import QUERIES
from tidepool.sources.tables import load

ODD = ["\x1f", ",", "...", "a,", "é!?", " ", "  ", "\n", "\n\n", " \n", "\t", "a", "the", "'s", "<|endoftext|>", "é", "1", "23",
       "\xa0", " ", "!", "\x1c", "中文", " <|end", "word", "Ω,", "\r\n"]
TEXTS = [None, "", "one", "Two words.", "a  b\n\nc <|endoftext|> d", "x" * 3000, "long text, " * 5000]
SCHEMA = "doc_id bigint, text string, length int"


@pytest.fixture(scope="module")
def enc():
    return Encoder(public_tokenizer())


def ids_of(enc, text, end):
    found = enc.tokenizer.encode(text or "", add_special_tokens=False).ids
    return np.array([*found, end], dtype="<u4")


@pytest.mark.parametrize("group", [4_000_000, 7])
def test_pieces_give_the_ids_of_whole_texts(enc, monkeypatch, group):
    monkeypatch.setattr(encoding, "GROUP_BYTES", group)
    draw = random.Random(group)
    texts = ["".join(draw.choice(ODD) for _ in range(draw.randint(0, 12))) for _ in range(4000)]
    found = enc.encode(texts)
    assert len(found) == len(texts)
    for text, ids in zip(texts, found):
        assert ids.tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_a_full_cache_changes_nothing():
    small = Encoder(public_tokenizer(), cache_pieces=10)
    texts = [f"word{i} other{i % 7}, more" for i in range(200)]
    for _ in range(2):
        for text, ids in zip(texts, small.encode(pa.array(texts))):
            assert ids.tolist() == small.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 24, 32])
def test_pack_and_unpack(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1001).astype("<u4")
    raw = token_store.pack(ids, bits)
    assert len(raw) == -(-1001 * bits // 8)
    assert np.array_equal(token_store.unpack(raw, 1001, bits), ids)
    with pytest.raises(ValueError):
        token_store.pack(np.array([2**bits], dtype="<u8").astype("<u4") if bits < 32 else np.array([1], "<u4"), bits if bits < 32 else 0)


def test_random_access(tmp_path):
    draw = np.random.default_rng(1)
    docs = [draw.integers(0, 50_000, n).astype("<u4") for n in (0, 5, 1000, 3, 17)]
    path = tmp_path / "a.ids"
    with open(path, "wb") as out:
        writer = token_store.TokenWriter(out, 16, block_ids=64)
        for k, ids in enumerate(docs):
            writer.add(k if k else None, ids)
        writer.close()
    file = token_store.TokenFile(f"file://{path}")
    assert all(np.array_equal(file.document(k), ids) for k, ids in enumerate(docs))
    flat = np.concatenate(docs)
    assert np.array_equal(file.ids(100, 900), flat[100:900])
    for size in (1, 7, 10_000):
        parts = {}
        for k, ids, _ in file.stream(size):
            parts.setdefault(k, []).append(ids)
        assert all(np.array_equal(np.concatenate(parts[k]), ids) for k, ids in enumerate(docs))
    assert file.has_id.tolist() == [False, True, True, True, True]


def test_token_files(spark, enc):
    rows = [(k, t, 1) for k, t in enumerate(TEXTS)] + [(3, "again", 1), (3, "again", 1), (None, "no id", 1)]
    out = token_store.token_ids(spark, spark.createDataFrame(rows, SCHEMA), public_tokenizer(), end_id=2).collect()
    assert [r.doc_id for r in sorted(out, key=lambda r: r.start)] == [None, 0, 1, 2, 3, 3, 3, 4, 5, 6]
    want = sorted((d if d is not None else -1, len(i), zlib.crc32(i)) for d, i in ((d, ids_of(enc, t, 2)) for d, t, _ in rows))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_crc32) for r in out) == want
    at = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert token_store.token_ids(spark, spark.createDataFrame([], SCHEMA), public_tokenizer(), end_id=2).count() == 0


def check_plan(histogram, packed):
    got = np.zeros_like(histogram)
    for config, count in packed:
        assert count > 0 and sum(length * n for length, n in config) < len(histogram)
        for length, n in config:
            got[length] += n * count
    assert np.array_equal(got, histogram)
    return sum(count for _, count in packed)


@pytest.mark.parametrize("seed", range(4))
def test_plans_pack_everything_tightly(seed):
    draw = np.random.default_rng(seed)
    histogram = np.bincount(draw.integers(1, 129, 3000) if seed else draw.integers(60, 70, 3000), minlength=129)
    n = check_plan(histogram, packing.plan(histogram))
    bound = -(-int((histogram * np.arange(129)).sum()) // 128)
    if not seed:  # a pair has one of 60 to 63, or two 64s
        bound = int(histogram.sum() - histogram[60:64].sum() - histogram[64] // 2)
        assert n == bound
    assert n <= bound * 1.05 and n <= packing.best_fit(histogram).total() + 1


def test_plan_where_best_fit_loses():
    histogram = np.zeros(13, dtype=np.int64)
    histogram[[3, 4, 6]] = [200, 100, 100]  # two 3s and a 6, three 4s
    assert check_plan(histogram, packing.plan(histogram)) == -(-(600 + 400 + 600) // 12)


def test_a_thousand_lengths_where_best_fit_alone_is_worse():
    """All lengths come three to a full sequence: configurations cover all of them, and take fewer sequences than best fit."""
    draw = np.random.default_rng(0)
    a, b = draw.integers(300, 980, (2, 3000))
    histogram = np.bincount(np.concatenate((a, b, 2048 - a - b)), minlength=2049)
    assert np.count_nonzero(histogram) >= 1000
    covered = np.zeros(2049)
    for config, times in packing.fractional(histogram).items():
        for length, n in config:
            covered[length] += n * times
    assert np.allclose(covered, histogram)
    assert check_plan(histogram, packing.plan(histogram)) < packing.best_fit(histogram).total()


def test_the_packing_query(spark, enc):
    """``op2`` over its table, against pieces cut one document after the other."""
    sf = "/root/testdata/sf0.001"
    out = QUERIES["op2_best_fit_packing"](spark, sf).collect()
    want = []
    for d in load(spark, sf, "documents").collect():
        ids = ids_of(enc, d.text, 0)
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids), 2048), len(ids)]
        want += [(d.doc_id, k, a, b - a, zlib.crc32(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    used = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0)
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 2048 and len(used) <= -(-sum(used.values()) // 2048) * 1.01 + 1


def test_the_token_file_query(spark, enc):
    """``op8`` over its table, against ids encoded one document after the other."""
    sf = "/root/testdata/sf0.001"
    at = 0
    got = {r.doc_id: r for r in QUERIES["op8_token_files"](spark, sf).collect()}
    for d in sorted(load(spark, sf, "documents").collect(), key=lambda d: d.doc_id):
        ids = ids_of(enc, d.text, 2)
        r = got.pop(d.doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids))
        at += len(ids)
    assert not got


@pytest.mark.parametrize("with_ids", [False, True])
def test_packing(spark, enc, with_ids):
    rows = [(k, t, 1) for k, t in enumerate(TEXTS)] + [(None, "no id", 1)] + [(100 + k % 50, "some words " * (k % 40), 1) for k in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    packed = packing.pack_documents(df, public_tokenizer(), end_id=0, capacity=256, with_ids=with_ids).cache()
    out = packed.collect()
    assert len({(r.sequence_id, r.offset) for r in out}) == len(out)
    used = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0)
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 256
    assert len(used) <= -(-sum(used.values()) // 256) + 1
    want = []
    for d, t, _ in rows:
        ids = ids_of(enc, t, 0)
        cuts = [0, *range(len(ids) % 256 or 256, len(ids), 256), len(ids)]
        want += [(d if d is not None else -1, k, a, b - a, zlib.crc32(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    if with_ids:
        whole = {r.sequence_id: r for r in packing.sequences(packed).collect()}
        for r in out:
            assert whole[r.sequence_id].ids[4 * r.offset: 4 * (r.offset + r.length)] == r.ids


def test_packing_nothing(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA), public_tokenizer()).count() == 0
