"""Prefix trie against a dictionary of all prefixes."""

import hashlib
import random
import zlib

import pytest

from tidepool.llm import prefix_trie
from tidepool.llm.queries import QUERIES
from tidepool.sources.tables import load

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    """Turns (role, text) of every conversation, rebuilt."""
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            order = (turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).digest())
            own.setdefault(c, []).append((order, (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    return {c: own.get(c - c % 100, [])[: zlib.crc32(str(c).encode()) % 6] + v[zlib.crc32(str(c).encode()) % 6:] for c, v in own.items()}


def brute(convs):
    members, children = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], set()).add(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, ())
        leaves[node] = sum(leaves[k] for k in below) or 1
        saved[node] = sum(saved[k] for k in below) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
        ends = ",".join(map(str, sorted(c for c in members[node] if len(convs[c]) == len(node))))
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(below),
                    leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def spark_trie(spark, rows, schema=SCHEMA):
    turns = prefix_trie.ordered_turns(spark.createDataFrame(rows, schema))
    return sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie.trie(*prefix_trie.rebuilt(turns)).collect()), key=str)


@pytest.fixture(scope="module")
def odd_rows():
    rnd = random.Random(3)
    rows = []
    for c in [*range(0, 25), *range(100, 130), 300, 301, 302, 555]:
        for turn in range(rnd.randrange(1, 9)):
            rows.append((c, turn, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "bé", "", None, "漢字 x"])))
    rows += [(7, None, "user", "first"), (7, None, "user", "first"), (8, 2, "user", "tie"), (8, 2, "user", "tied"), (None, 1, "user", "nobody's")]
    return rows


def test_against_a_dictionary(spark, odd_rows):
    assert spark_trie(spark, odd_rows) == brute(rebuilt(odd_rows))


def test_deep_conversations_shared_to_many_depths(spark):
    """Blocks, and parts of one, two, four and more blocks; paths that part at every depth, copies, full blocks at the end."""
    rows, stem = [], [("user", f"t{i % 7}") for i in range(150)]
    for c, (shared, own) in enumerate([(150, 0), (150, 0), (149, 3), (127, 40), (111, 0), (96, 1), (95, 2), (80, 0), (79, 30), (64, 0), (63, 5), (48, 9), (47, 0), (33, 1),
                                       (31, 31), (32, 16), (16, 0), (15, 0), (15, 1), (14, 2), (8, 70), (1, 14), (0, 3)]):
        turns = stem[:shared] + [("assistant", f"own {c % 4} {i % 3}") for i in range(own)]
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    assert spark_trie(spark, rows) == brute(rebuilt(rows))


def test_one_conversation_holds_most_rows(spark):
    rows = [(0, i, "user", str(i % 3)) for i in range(3_000)] + [(c, i, "user", str(i)) for c in range(1, 40) for i in range(4)]
    assert spark_trie(spark, rows) == brute(rebuilt(rows))


def test_many_end_at_one_node(spark, monkeypatch):
    """Ids of a node in many parts."""
    monkeypatch.setattr(prefix_trie, "ENDS_CHARS", 20)
    rows = [(c, 0, "user", "same") for c in range(0, 40_000, 13)]
    assert spark_trie(spark, rows) == brute(rebuilt(rows))


def test_no_conversations_and_other_columns(spark, odd_rows):
    assert spark_trie(spark, []) == [] == spark_trie(spark, [(None, 1, "user", "x")])
    named = [(*r, "x", 1, b"") for r in odd_rows[:40]]
    assert spark_trie(spark, named, SCHEMA + ", conv string, name int, r binary") == brute(rebuilt(odd_rows[:40]))


def test_the_query(spark):
    rows = [tuple(r) for r in load(spark, "/root/testdata/sf0.001", "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_prefix_trie"](spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == brute(rebuilt(rows))
