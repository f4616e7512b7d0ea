"""WARC archives, URL filters, nearest neighbours."""

import datetime
import gzip
import hashlib

import numpy as np
import pytest

from tidepool.llm import common, hnsw, url_filters, warc
from tidepool.llm.queries import QUERIES, SQL
from tidepool.sources.tables import load
from tools.oracle_check import compare, duck_connection

SF = "/root/testdata/sf0.01"
PAGES = "page_id bigint, url string, html string, digest string, archive int"


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_sql(spark, name):
    from tidepool.plans.registry import Query

    assert compare(spark, duck_connection(SF), name, Query(name, QUERIES[name], SQL[name], ()), SF)["status"] == "exact"


BIG = "<p>é</p>" * 40
ROWS = [(1, "http://a/1", BIG, "d", 1), (2, "http://ü/ 2\n", BIG, "d", 1), (3, None, "short", "d", 1), (4, "u", "short", "d", 1), (5, "u", None, "d", 1),
        (6, "u", "", "d", 1), (None, "n", BIG, "d", 1), (None, "n", "x" * 200, "d", 1), (7, "u", "y" * 100, "d", 1), (8, "u", "y" * 100, "d", 1),
        (9, "u", "z" * 99, "d", 1), (10, "u", "z" * 99, "d", 1), (7, "u", "y" * 100, "d", 1), (11, "long", "\r\n\r\nWARC/1.1\r\n" * 50_000, "d", 1)]


def expected(rows):
    first = {}
    for k, _, html, *_ in rows:
        raw = (html or "").encode()
        if len(raw) >= 100 and k is not None:
            first[raw] = min(first.get(raw, k), k)
    for k, _, html, *_ in rows:
        raw = (html or "").encode()
        low = first.get(raw)
        again = len(raw) >= 100 and low is not None and k != low
        yield (str(k), len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", low if again else None)


def test_archives_round_trip(spark):
    index = warc.write_archives(spark.createDataFrame(ROWS, PAGES).repartition(3))
    out = warc.read_records(index, with_payload=True).collect()
    key = lambda r: (str(r[0]), r[1], r[2], r[3], str(r[4]))
    got = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out]
    assert sorted(got, key=key) == sorted(expected(ROWS), key=key)
    payload = {str(r[0]): (r[2] or "").encode() for r in ROWS if r[0] is not None}
    assert all(r.payload == (payload[str(r.page_id)] if r.record_type == "response" else b"") for r in out if r.page_id is not None)
    assert {r.url for r in out} == {r[1] for r in ROWS}
    again = warc.read_records(index.repartition(8, "offset"))  # sorted runs that a task holds one after the other
    assert sorted(str(r) for r in again.collect()) == sorted(str(r) for r in again.coalesce(1).collect()) and again.count() == len(ROWS)
    part = warc.read_records(index.where("page_id IN (2, 11)")).collect()  # selected records alone
    assert sorted(r.page_id for r in part) == [2, 11]
    for r in index.select("archive").distinct().collect():  # any gzip reader can read an archive through
        filesystem, path = common.store_files(r.archive)
        assert gzip.decompress(filesystem.open_input_file(path).read()).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    assert warc.read_records(warc.write_archives(spark.createDataFrame([], PAGES))).count() == 0


def test_a_damaged_payload_is_found():
    raw = warc.record(1, "u", b"payload", "0" * 64, False, None)
    assert warc.parse(raw)[2] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(raw[:-3])


DAY = datetime.date(2024, 1, 1)


def day(n):
    return DAY + datetime.timedelta(days=n)


def test_intervals(spark):
    rows = [("l", "block", "a.b", act, day(n)) for act, n in [("remove", 0), ("add", 1), ("add", 3), ("remove", 5), ("remove", 6), ("add", 8), ("remove", 8), ("remove", 9), ("add", 12)]]
    rows += [("l", "block", None, "add", day(1)), ("l", "block", "x.y", "add", None), ("l", "block", "x.y", "noise", day(1))]
    got = url_filters.intervals(spark.createDataFrame(rows, "list string, verdict string, pattern string, action string, dated date")).collect()
    assert sorted((r.since, r.until) for r in got if r.until) == [(day(1), day(5)), (day(8), day(9))]
    assert [r.since for r in got if r.until is None] == [day(12)] and {r.pattern for r in got} == {"a.b"}


def test_url_filters_by_brute_force(spark):
    entries = [("spam", "block", "bad.example.org", "add", 10), ("spam", "block", "bad.example.org", "remove", 20), ("doms", "block", "example.org", "add", 15),
               ("ok", "allow", "good.example.org", "add", 0), ("ok", "allow", "bad.example.org", "add", 12), ("pages", "block", "good.example.org/x", "add", 5)]
    urls = ["http://bad.example.org/", "https://user@BAD.example.org.:80/p?q#f", "http://good.example.org/x/?a=1", "http://good.example.org/xy", "http://www.good.example.org",
            "http://example.org", "http://badexample.org/", None, "", "no url", "http://org/", "http:///x", "x" * 9000]
    rows = [(100 * k + n, u, day(n), "clash", 1) for k, u in enumerate(urls) for n in (0, 9, 10, 11, 12, 15, 19, 20, 25)] + [(9999, urls[0], None, "clash", 1)] * 2
    captures = spark.createDataFrame(rows, "page_id bigint, url string, fetched date, host string, pattern int")
    table = spark.createDataFrame([(a, b, c, d, day(n)) for a, b, c, d, n in entries], "list string, verdict string, pattern string, action string, dated date")
    out = url_filters.judge(captures, table).collect()
    assert len(out) == len(rows)

    def want(url, when):
        name, _, path = (url or "").partition("://")[2].partition("/")
        name = name.rpartition("@")[2].partition(":")[0].lower().rstrip(".")
        path = (name + "/" + path.partition("?")[0].partition("#")[0]).rstrip("/")
        labels = name.split(".")
        keys = {".".join(labels[i:]): len(labels) - i for i in range(max(1, len(labels) - 1))} if name else {}
        keys |= {path: 1000} if name and path != name else {}
        best = None
        for list_, verdict, pattern, action, since in entries:
            ends = [n for a, b, c, d, n in entries if (a, b, c, d) == (list_, verdict, pattern, "remove")]
            if action == "add" and pattern in keys and when is not None and day(since) <= when and not (ends and when >= day(ends[0])):
                found = (-keys[pattern], verdict != "allow", day(since), list_, pattern)
                best = min(best or found, found)
        return (bool(best and best[1]), best and best[3], best and best[4])

    for r in out:
        assert (r.filter.blocked, r.filter.list, r.filter.pattern) == want(r.url, r.fetched), r
        assert r.host == "clash" and r.pattern == 1
    assert {r.filter.blocked for r in out} == {True, False}
    assert not any(r.filter.blocked for r in url_filters.judge(captures, table.limit(0)).collect())
    assert url_filters.judge(captures.limit(0), table).count() == 0


def test_recall_on_real_vectors(spark):
    sf = "/root/testdata/sf0.1"
    rows = load(spark, sf, "embeddings").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    out = {}
    for r in QUERIES["op10_hnsw"](spark, sf).collect():
        out.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(out) == set(ids[ids % 20 == 0].tolist())
    hits = 0
    for q, found in out.items():
        score = vectors @ vectors[ids == q][0]
        others = ids != q
        best = ids[others][np.lexsort((ids[others], -score[others]))][:20]
        assert list(sorted(found)) == list(range(1, 21))
        hits += len(set(best.tolist()) & {v for v, _ in found.values()})
        for v, s in found.values():
            assert s == pytest.approx(float(score[ids == v][0]), rel=1e-12)
        ranked = [(-s, v) for v, s in (found[k] for k in range(1, 21))]
        assert ranked == sorted(ranked)
    assert hits >= 0.95 * 20 * len(out)


@pytest.mark.parametrize("shard_rows", [8192, 60])
def test_copies_and_odd_vectors(spark, shard_rows):
    draw = np.random.default_rng(0)
    base = draw.normal(size=(150, 6))
    rows = [(k, v.tolist()) for k, v in enumerate(base)] + [(200 + k, base[0].tolist()) for k in range(60)] + [(5, base[5].tolist()), (500, base[1].tolist()), (500, base[2].tolist())]
    odd = [(300, None), (301, [0.0] * 6), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] * 6), (304, [float("inf")] + [0.0] * 5), (305, [1.0] * 4), (None, [1.0] * 6), (306, [])]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows + odd], "vec_id bigint, embedding array<double>, node int, rank int").repartition(4)
    valid = hnsw.valid(table)
    out = hnsw.nearest(hnsw.build_index(valid, k=20, shard_rows=shard_rows), valid.where("id % 20 = 0"), k=20).collect()
    found = {}
    for r in sorted(out, key=lambda r: r["rank"]):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = n = 0
    for q in {i for i, _ in rows if i % 20 == 0}:
        best = {}
        for own in [np.array(v) for i, v in rows if i == q]:
            for i, v in rows:
                if i != q:
                    best[i] = max(best.get(i, -np.inf), float(np.dot(own, v)))
        want = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:20]
        assert len(found[q]) == 20
        hits += len({i for i, _ in want} & {i for i, _ in found[q]})
        n += 20
        if q == 0:  # its copies are as near as can be, the smallest ids first
            assert [i for i, _ in found[q]] == [i for i, _ in want]
    assert hits >= 0.95 * n
    assert set(found) == {i for i, _ in rows if i % 20 == 0}


def test_one_id_on_very_many_near_vectors(spark):
    """An id that fills a query's list leaves no place empty: the list grows until it holds enough ids."""
    draw = np.random.default_rng(1)
    near = [(1, (np.array([1.0, 0, 0, 0]) + draw.normal(scale=0.01, size=4)).tolist()) for _ in range(400)]
    others = [(100 + i, draw.normal(scale=0.2, size=4).tolist()) for i in range(301)]
    rows = [(0, [1.0, 0.0, 0.0, 0.0]), *near, *others]
    table = hnsw.valid(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    out = sorted(hnsw.nearest(hnsw.build_index(table, k=20), table.where("id = 0"), k=20).collect(), key=lambda r: r["rank"])
    best = {}
    for i, v in rows[1:]:
        best[i] = max(best.get(i, -9.0), v[0])
    want = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:20]
    assert len(out) == 20 and out[0].vec_id == 1 and len({r.vec_id for r in out} & {i for i, _ in want}) >= 18


def test_shards_grow_with_the_table():
    assert [hnsw.rows_of_shard(n) for n in (100, 16_384, 1_000_000, 10**9)] == [8192, 8192, 64_000, 131_072]


@pytest.mark.parametrize("shard_rows", [300, 1500])
def test_recall_at_two_shard_sizes(spark, shard_rows):
    draw = np.random.default_rng(4)
    vectors = draw.normal(size=(3000, 16)) * draw.uniform(0.5, 2, (3000, 1))
    table = hnsw.valid(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>"))
    found = {}
    for r in hnsw.nearest(hnsw.build_index(table, k=20, shard_rows=shard_rows), table.where("id % 20 = 0"), k=20).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(found[q] & set([i for i in np.argsort(-(vectors @ vectors[q]), kind="stable") if i != q][:20])) for q in range(0, 3000, 20))
    assert hits >= 0.9 * 150 * 20


def test_few_and_no_vectors(spark):
    table = spark.createDataFrame([(20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])], "vec_id bigint, embedding array<float>")
    valid = hnsw.valid(table)
    out = hnsw.nearest(hnsw.build_index(valid, k=20), valid.where("id % 20 = 0"), k=20).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(out, key=lambda r: r["rank"])] == [(20, 1, 1, 0.5), (20, 2, 2, -1.0)]
    none = hnsw.valid(table.limit(0))
    assert hnsw.nearest(hnsw.build_index(none, k=20), none, k=20).count() == 0


def test_runs_in_one_task(spark, monkeypatch):
    """Several sorted runs of one archive in a task, the later bytes first: every record is read once."""
    monkeypatch.setattr(common, "gathered", lambda df, rows=0: df.coalesce(1))
    rows = [(k, f"u{k}", f"<p>{k}</p>" * 30, "d", 1) for k in range(300)]
    index = warc.write_archives(spark.createDataFrame(rows, PAGES))
    assert index.select("archive").distinct().count() == 1
    backwards = index.withColumn("offset", index["offset"])
    out = warc.read_records(backwards).collect()
    assert sorted(r.page_id for r in out) == list(range(300))
    turned = spark.createDataFrame(sorted(index.collect(), key=lambda r: -r.offset), index.schema)
    monkeypatch.setattr(type(turned), "sortWithinPartitions", lambda self, *a, **k: self.coalesce(1))
    monkeypatch.setattr(type(turned), "repartitionByRange", lambda self, *a, **k: self)
    assert sorted(r.page_id for r in warc.read_records(turned).collect()) == list(range(300))
