"""SimHash near-dedup and components."""

import random

import numpy as np
import pytest
import xxhash

from tidepool.llm import graph, simhash

DOCS = "doc_id bigint, text string, key string, document int, root int"


def brute_fp(text, shingle=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i: i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(fps, max_bits):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


TEXTS = [None, "", " \n", "A", "a", "a b", "a b c", "É b C d", "long " * 3000, "x" * 9000, "one two three four five", "ONE two\tthree four five", "\x1cone\xa0two"]


def test_fingerprints_by_brute_force(monkeypatch):
    draw = random.Random(0)
    texts = TEXTS + [" ".join(draw.choice("abcdefg") for _ in range(draw.randint(0, 60))) for _ in range(100)]
    assert [simhash.fingerprint(t) for t in texts] == [brute_fp(t) for t in texts]
    monkeypatch.setattr(simhash, "TURN", 7)
    assert [simhash.fingerprint(t) for t in texts] == [brute_fp(t) for t in texts]
    assert simhash.fingerprint("a b c d", 2) == brute_fp("a b c d", 2)


def test_close_pairs_share_a_key():
    draw = np.random.default_rng(0)
    masks = [m & (2**64 - 1) for m in simhash.masks(3)]
    assert len(masks) == 20 and all(m.bit_count() >= 31 for m in masks)
    for _ in range(300):
        x = int(draw.integers(0, 2**63))
        y = x
        for bit in draw.choice(64, 3, replace=False):
            y ^= 1 << int(bit)
        assert any(x & m == y & m for m in masks)


@pytest.mark.parametrize("chunk", [2048, 3])
def test_components_of_fingerprints(spark, monkeypatch, chunk):
    """Chains, a dense cluster over many chunks, and strays: the same groups as brute force."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    draw = random.Random(1)
    fps = [draw.getrandbits(64) for _ in range(60)]
    centre = draw.getrandbits(64)
    fps += [centre ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for _ in range(40)]
    at = draw.getrandbits(64)
    for _ in range(40):
        for bit in draw.sample(range(64), 3):
            at ^= 1 << bit
        fps.append(at)
    fps += fps[:5] + [0, 0, 1, 2**64 - 1]
    signed = [x - 2**64 if x >> 63 else x for x in fps]
    rows = spark.createDataFrame([(100 + k, 0, x) for k, x in enumerate(signed)], "doc_id bigint, text_hash bigint, fp bigint")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(rows, 3).collect()}
    assert got == {100 + k: 100 + g for k, g in enumerate(brute_groups(fps, 3))}


def test_dedup_of_odd_tables(spark):
    rows = [(k, t, "key", 1, 2) for k, t in enumerate(TEXTS)]
    rows += [(None, "only without id and quite alone", "n", 1, 2), (None, "only without id and quite alone", "n", 1, 2), (10, TEXTS[10], "again", 1, 2), (10, TEXTS[10], "key", 1, 2), (10, "other text of the same id", "key", 1, 2), (None, "A", "x", 1, 2)]
    docs = spark.createDataFrame(rows, DOCS)
    fps = simhash.fingerprints(docs)
    assert fps.count() == len(rows)
    groups = brute_groups([brute_fp(t) for _, t, *_ in rows], 3)
    kept = simhash.deduplicated(docs).collect()
    assert len(kept) == len(set(groups))
    for g in set(groups):
        own = [rows[k] for k in range(len(rows)) if groups[k] == g]
        ids = [r[0] for r in own if r[0] is not None]
        here = [r for r in kept if tuple(r) in own]
        assert len(here) == 1 and here[0].doc_id == (min(ids) if ids else None)
    assert simhash.deduplicated(docs.limit(0)).count() == 0
    assert simhash.near_duplicates(fps.limit(0)).count() == 0


def test_graph_components(spark):
    draw = random.Random(2)
    edges = [(a, a + 1) for a in range(0, 70)] + [(500, 500 + k) for k in range(1, 60)] + [(draw.randrange(1000, 1100), draw.randrange(1000, 1100)) for _ in range(60)] + [(7, 7), (1, 0)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for start in sorted(near):
        todo = [start]
        while todo and start not in want:
            todo = [start]
            seen = {start}
            while todo:
                for y in near[todo.pop()] - seen:
                    seen.add(y)
                    todo.append(y)
            want |= {x: start for x in seen}
    assert got == want
    assert graph.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
