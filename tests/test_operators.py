"""Properties and edge rows for the churn-analytics operators (FIXTURES.md §3)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.operators import binning, clean, encode, evaluate, oversample, profile, ranking, split

from conftest import SF001


def test_global_rank_equals_row_number_under_any_layout(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_discount")
    # Order and line repeat: all rows are compared, not one of each key.
    want = sorted(tuple(r) for r in li.selectExpr(
        "l_orderkey", "l_linenumber",
        "row_number() OVER (ORDER BY l_discount, l_orderkey, l_linenumber)").collect())
    for n in (1, 7, 64):
        got = ranking.global_rank(li.repartition(n), ["l_discount", "l_orderkey", "l_linenumber"], "r",
                                  num_partitions=n)
        assert sorted(tuple(r) for r in got.select("l_orderkey", "l_linenumber", "r").collect()) == want


def test_grouped_rank_and_hot_key(spark):
    # one key holds most rows: ranks inside it still split across partitions
    rows = [(0 if i % 3 else 1, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, x int")
    got = ranking.global_rank(df, ["x"], "r", ["g"], num_partitions=16)
    per = got.groupBy("g").agg(F.min("r").alias("lo"), F.max("r").alias("hi"), F.count("*").alias("n"))
    for r in per.collect():
        assert r["lo"] == 1 and r["hi"] == r["n"]


def test_exact_quantiles_match_numpy(spark):
    vals = [float(v) for v in np.random.default_rng(7).normal(size=997)]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    for method in ("auto", "rank", "bracket"):  # percentile map, range rank, brackets
        got = {r["p"]: r["value"] for r in ranking.exact_quantiles(df, ["x"], probs, method=method).collect()}
        for p in probs:
            assert got[p] == pytest.approx(float(np.quantile(vals, p)), rel=1e-12, abs=1e-12)


def test_quantile_paths_agree_on_lineitem(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    probs = [0.0, 0.2, 0.5, 0.95, 1.0]
    a = {(r[0], r[1]): r[2] for r in ranking.exact_quantiles(li, cols, probs).collect()}
    for method in ("rank", "bracket"):
        b = {(r[0], r[1]): r[2] for r in ranking.exact_quantiles(li, cols, probs, method=method).collect()}
        assert a.keys() == b.keys()
        for k in a:
            assert a[k] == pytest.approx(b[k], rel=1e-12)


def test_bracket_quantiles_hot_value_and_fallback(spark):
    # a third of the rows hold one value; tiny accuracy forces wide brackets
    vals = [7.0] * 400 + [float(i) for i in range(800)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.3, 0.5, 0.77, 1.0]
    got, failed = ranking._bracket_quantiles(df, ["x"], probs, accuracy=50)
    res = {r["p"]: r["value"] for r in got.collect()} if got is not None else {}
    for p in probs:
        if "x" not in failed:
            assert res[p] == pytest.approx(float(np.quantile(vals, p)), rel=1e-12)
    full = {r["p"]: r["value"] for r in ranking.exact_quantiles(df, ["x"], probs, method="bracket").collect()}
    for p in probs:
        assert full[p] == pytest.approx(float(np.quantile(vals, p)), rel=1e-12)


def test_qcut_edges_and_duplicates(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 14)], "x double")
    out = binning.qcut(df, "x", 5, "b").orderBy("x").collect()
    import pandas as pd
    want = list(pd.qcut(pd.Series(range(1, 14), dtype=float), 5, labels=[1, 2, 3, 4, 5]).astype(int))
    assert [r["b"] for r in out] == want
    const = spark.createDataFrame([(1.0,)] * 10, "x double")
    with pytest.raises(binning.DuplicateEdgesError):
        binning.qcut(const, "x", 4, "b")


def test_rank_first_qcut_is_not_ntile(spark):
    import pandas as pd
    vals = [0.0] * 6 + [1.0, 2.0, 2.0, 3.0, 4.0, 5.0, 6.0]  # N = 13, n = 5, ties
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k int, x double")
    got = [r["b"] for r in binning.qcut_rank_first(df, "x", ["k"], 5, "b").orderBy("k").collect()]
    s = pd.Series(vals)
    want = list(pd.qcut(s.rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int))
    assert got == want


def test_clean_orders_differ_when_first_row_incomplete(spark):
    rows = [(1, 1, None), (1, 2, "b"), (2, 1, "c")]
    df = spark.createDataFrame(rows, "key int, ord int, v string")
    a = clean.clean_data(df, ["key"], ["ord"], [], order="dropna_first").orderBy("key").collect()
    b = clean.clean_data(df, ["key"], ["ord"], [], order="dedup_first").orderBy("key").collect()
    assert [(r.key, r.ord) for r in a] == [(1, 2), (2, 1)]
    assert [(r.key, r.ord) for r in b] == [(2, 1)]


def test_roles_five_and_six_distinct(spark):
    rows = [(i % 5, i % 6, float(i), i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "five int, six int, num double, target int")
    roles = {r["column"]: r["role"] for r in profile.column_roles(df, "target").collect()}
    assert roles == {"five": "categorical", "six": "numeric", "num": "numeric", "target": "target"}


def test_histogram_constant_and_last_bin_closed(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, c double")
    h = {(r["column"], r["bin"]): r["count"] for r in profile.histogram(df, ["a", "c"], 20).collect()}
    assert h[("a", 0)] == 1 and h[("a", 19)] == 1 and sum(v for (c, _), v in h.items() if c == "a") == 3
    assert h[("c", 10)] == 3  # numpy puts a constant column in the middle bin


def test_one_hot_positions_and_nulls(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (2, None, 3.0), (3, "a", 4.0)], "k int, cat string, x double")
    inplace = encode.one_hot(df, ["cat"], in_place=True)
    assert inplace.columns == ["k", "cat_a", "cat_b", "x"]
    appended = encode.one_hot(df, ["cat"])
    assert appended.columns == ["k", "x", "cat_a", "cat_b"]
    row = appended.where("k = 2").first()
    assert row["cat_a"] is False and row["cat_b"] is False


def test_split_disjoint_exact_and_repeatable(spark):
    df = spark.range(1000).withColumnRenamed("id", "key")
    a = split.split_exact(df, ["key"], seed=12345)
    counts = {r[0]: r[1] for r in a.groupBy("split").count().collect()}
    assert counts == {"test": 200, "validation": 200, "train": 600}
    b = split.split_exact(df.repartition(7), ["key"], seed=12345)
    assert a.exceptAll(b).count() == 0


def test_auc_equals_rank_sum_with_ties(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400) + y * 0.3, 1)  # many ties
    df = spark.createDataFrame([("m", int(a), float(b)) for a, b in zip(y, s)], "model string, y int, score double")
    got = evaluate.roc_auc(df).first()["roc_auc"]
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert got == pytest.approx(want, rel=1e-12)


def _brute_knn(vecs, ids, k):
    out = {}
    for i, v in enumerate(vecs):
        d = np.sqrt(((vecs - v) ** 2).sum(axis=1))
        d[i] = np.inf
        order = sorted(range(len(ids)), key=lambda j: (d[j], ids[j]))[:k]
        out[ids[i]] = [ids[j] for j in order]
    return out


def test_knn_exact_with_pruning_and_blocks(spark):
    rng = np.random.default_rng(11)
    centers = rng.normal(scale=10, size=(6, 4))
    vecs = np.vstack([c + rng.normal(size=(50, 4)) for c in centers])
    ids = list(range(len(vecs)))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in zip(ids, vecs)], "id long, v array<double>")
    got = oversample.knn(df, "id", "v", k=5, leaf_rows=16)
    res = {}
    for r in got.orderBy("id", "nbr_rank").collect():
        res.setdefault(r["id"], []).append(r["nbr_id"])
    assert res == _brute_knn(vecs, ids, 5)


def test_smote_balances_and_interpolates(spark):
    rng = np.random.default_rng(5)
    rows = [(i, float(rng.normal()), float(rng.normal()), 1 if i < 40 else 0) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, a double, b double, y int")
    out = oversample.smote(df, "y", ["a", "b"], "k", k=5, seed=1)
    counts = {r[0]: r[1] for r in out.groupBy("y").count().collect()}
    assert counts[0] == counts[1] == 160
    base = {r["k"]: (r["a"], r["b"]) for r in df.where("y = 1").collect()}
    nn = oversample.knn(df.where("y = 1").select("k", F.array("a", "b").alias("v")), "k", "v", k=5)
    nbrs = {}
    for r in nn.collect():
        nbrs.setdefault(r["k"], set()).add(r["nbr_id"])
    for r in out.where("synthetic").collect():
        bx = np.array(base[r["k"]])
        x = np.array([r["a"], r["b"]])
        ok = False
        for n in nbrs[r["k"]]:
            nx = np.array(base[n])
            t = np.dot(x - bx, nx - bx) / max(np.dot(nx - bx, nx - bx), 1e-300)
            if -1e-9 <= t <= 1 + 1e-9 and np.allclose(bx + t * (nx - bx), x, atol=1e-9):
                ok = True
        assert ok


def test_class_balance_share(spark):
    df = spark.createDataFrame([(1,)] * 2 + [(0,)] * 8, "y int")
    got = {r["class"]: (r["count"], r["share"]) for r in profile.class_balance(df, "y").collect()}
    assert got == {1: (2, 0.2), 0: (8, 0.8)}
    assert math.isclose(sum(v[1] for v in got.values()), 1.0)


def test_smote_chunked_quota_equals_plain(spark):
    rng = np.random.default_rng(9)
    rows = [(i, float(rng.normal()), 1 if i < 6 else 0) for i in range(120)]
    df = spark.createDataFrame(rows, "k long, a double, y int")
    plain = oversample.smote(df, "y", ["a"], "k", k=3, seed=4)
    chunked = oversample.smote(df, "y", ["a"], "k", k=3, seed=4, chunk_rows=5)
    assert plain.count() == 228
    assert plain.exceptAll(chunked).count() == 0 and chunked.exceptAll(plain).count() == 0


def test_order_statistics_match_full_rank(spark):
    rows = [(int(v), i) for i, v in enumerate(np.random.default_rng(4).integers(0, 50, 2000))]
    rows += [(7, 5000 + i) for i in range(700)]  # a hot value
    df = spark.createDataFrame(rows, "x long, k long")
    ranks = [1, 333, 900, 1500, 2700]
    want = {r[2]: (r[0], r[1]) for r in ranking.global_rank(df, ["x", "k"], "r").collect() if r[2] in ranks}
    for acc in (100_000, 20):  # wide and narrow brackets
        assert ranking.order_statistics(df, "x", ["k"], ranks, accuracy=acc) == want
    big = 2**53
    typed = df.select("k", (F.col("x") + big).alias("long"), F.expr("date_add(DATE '2020-01-01', CAST(x AS INT))").alias("date"),
                      F.expr("timestamp_micros(x * 1000003)").alias("timestamp"), F.expr("TIMESTAMP_NTZ '2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, x)").alias("ntz"),
                      (F.col("x") / 7).cast("decimal(30,12)").alias("decimal"), F.lpad(F.col("x").cast("string"), 4, "0").alias("text"))
    for c in ("long", "date", "timestamp", "ntz", "decimal", "text"):
        want = {r[2]: (r[0], r[1]) for r in ranking.global_rank(typed.select(c, "k"), [c, "k"], "r").collect() if r[2] in ranks}
        assert ranking.order_statistics(typed, c, ["k"], ranks, accuracy=50) == want, c


def test_grouped_quantiles_bracket_equals_rank(spark):
    rng = np.random.default_rng(8)
    rows = [(int(g), float(v)) for g, v in zip(rng.integers(0, 6, 3000), rng.gamma(2.0, 50.0, 3000))]
    rows += [(9, 1.0)] * 500 + [(9, 2.0)] * 3  # a hot group made of ties
    df = spark.createDataFrame(rows, "g int, v double")
    probs = [0.0, 0.5, 0.95, 1.0]
    a = {(r[0], r[1]): r[2] for r in ranking.grouped_quantiles(df, "v", ["g"], probs, method="bracket").collect()}
    b = {(r[0], r[1]): r[2] for r in ranking.grouped_quantiles(df, "v", ["g"], probs, method="rank").collect()}
    c = {(r[0], r[1]): r[2] for r in ranking.grouped_quantiles(df, "v", ["g"], probs, method="bracket",
                                                                 accuracy=3).collect()}
    assert a.keys() == b.keys() == c.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], rel=1e-12) and c[k] == pytest.approx(b[k], rel=1e-12)


def test_job_sessions_two_levels_equal_plain_gap_rule(spark):
    import datetime as dt

    from tidepool.operators import marts
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    rng = np.random.default_rng(12)
    rows = []
    for item, n in (("hot", 900), ("a", 40), ("b", 25)):
        t = base
        for _ in range(n):
            step = int(rng.choice([60, 600, 1799, 1800, 1801, 5400]))  # around the 30-minute gap
            t = t + dt.timedelta(seconds=step, microseconds=int(rng.integers(0, 999999)))
            rows.append((item, t, int(rng.choice([200, 200, 500]))))
    df = spark.createDataFrame(rows, "ItemId string, EventTimeUtc timestamp, HttpStatusCode int")
    got = sorted((r["ItemId"], r["JobStartTime"], r["JobEndTime"], r["events"], r["failed"])
                 for r in marts.job_sessions(df).collect())
    want = []
    for item in ("hot", "a", "b"):
        ev = sorted((t, s) for i, t, s in rows if i == item)
        cur = [ev[0][0], ev[0][0], 1, int(ev[0][1] >= 500)]
        for t, s in ev[1:]:
            if t - cur[1] >= dt.timedelta(seconds=1800):
                want.append((item, *cur))
                cur = [t, t, 1, int(s >= 500)]
            else:
                cur[1], cur[2], cur[3] = t, cur[2] + 1, max(cur[3], int(s >= 500))
        want.append((item, *cur))
    assert got == sorted(want)


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_results_do_not_depend_on_partitioning(spark, parts):
    rng = np.random.default_rng(21)
    rows = [(i, float(rng.normal()), float(rng.normal()), 1 if rng.random() < 0.3 else 0) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, a double, b double, y int")
    ref_smote = oversample.smote(df.coalesce(1), "y", ["a", "b"], "k", k=5, seed=3)
    ref_split = split.split_exact(df.coalesce(1), ["k"], seed=3)
    ref_bins = binning.qcut_rank_first(df.coalesce(1), "a", ["k"], 5, "bin")
    moved = df.repartition(parts)
    for ref, got in ((ref_smote, oversample.smote(moved, "y", ["a", "b"], "k", k=5, seed=3)),
                     (ref_split, split.split_exact(moved, ["k"], seed=3)),
                     (ref_bins, binning.qcut_rank_first(moved, "a", ["k"], 5, "bin"))):
        assert ref.exceptAll(got).count() == 0 and got.exceptAll(ref).count() == 0


def test_empty_frames_stay_typed(spark):
    df = spark.createDataFrame([], "k long, x double, c string, y int")
    assert clean.clean_data(df, ["k"], ["k"], ["c"]).columns == ["k", "x", "y"]
    assert profile.class_balance(df, "y").count() == 0
    assert {r["column"]: r["n_distinct"] for r in profile.nunique(df, ["x", "c"]).collect()} == {"x": 0, "c": 0}
    assert profile.counts_by_target(df, ["c"], "y").count() == 0
    assert split.split_exact(df, ["k"]).count() == 0


def test_hot_value_is_split_across_range_partitions(spark):
    """A value holding a third of the rows does not land in one partition:
    the range bounds are sampled on (value, tiebreak)."""
    rows = [(7.0 if i % 3 == 0 else float(i), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "x double, k long")
    sizes = (df.repartitionByRange(16, "x", "k").groupBy(F.spark_partition_id().alias("p")).count()
             .agg(F.max("count")).first()[0])
    assert sizes < 2000 / 2  # the 2000 hot rows are spread over several partitions
    ranked = ranking.global_rank(df, ["x", "k"], "r", num_partitions=16)
    assert ranked.agg(F.max("r")).first()[0] == 6000


def test_one_hot_vector_form(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "cat string")
    _, out = encode.one_hot_vector(df, "cat", "v")
    vecs = [r["v"].toArray().tolist() for r in out.collect()]
    assert vecs == [[0.0, 1.0, 0.0], [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]]  # a, b, unseen slot


def test_format_strings(spark):
    from tidepool.operators import report
    df = spark.createDataFrame([(1234567.456,)], "x double")
    row = df.select(report.format_value(F.col("x"), "0").alias("a"),
                    report.format_value(F.col("x"), "#,0").alias("b"),
                    report.format_value(F.col("x"), "0.00").alias("c")).first()
    assert (row.a, row.b, row.c) == ("1234567", "1,234,567", "1234567.46")


def test_qcut_fit_on_train(spark):
    train_rows = spark.createDataFrame([(float(i),) for i in range(1, 101)], "x double")
    all_rows = spark.createDataFrame([(-5.0,), (10.0,), (50.5,), (500.0,)], "x double")
    got = [r["b"] for r in binning.qcut(all_rows, "x", 4, "b", fit_df=train_rows).orderBy("x").collect()]
    # edges 1, 25.75, 50.5, 75.25, 100 from the training rows; bins are closed
    # on the right, so 50.5 is in bin 2
    assert got == [1, 1, 2, 4]


def test_prefix_sums_across_arrow_batches(spark):
    import pandas as pd
    rng = np.random.default_rng(31)
    rows = [(str(g), float(x), int(c)) for g, x, c in zip(rng.choice(["a", "b", "c"], 500),
                                                          rng.integers(0, 50, 500), rng.integers(1, 5, 500))]
    df = spark.createDataFrame(rows, "g string, x double, c long").groupBy("g", "x").agg(F.sum("c").alias("c"))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # groups span many batches
    try:
        for parts in (None, 1, 5):
            got = {(r["g"], r["x"]): r["c_cum"]
                   for r in ranking.prefix_sums(df, ["x"], ["c"], ["g"], num_partitions=parts).collect()}
            pdf = df.toPandas().sort_values(["g", "x"])
            pdf["cum"] = pdf.groupby("g")["c"].cumsum()
            assert got == {(g, x): c for g, x, c in zip(pdf["g"], pdf["x"], pdf["cum"])}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_smote_boolean_features_truncate(spark):
    rng = np.random.default_rng(17)
    rows = [(i, float(rng.normal()), bool(i % 2), 1 if i < 20 else 0) for i in range(100)]
    df = spark.createDataFrame(rows, "k long, a double, flag boolean, y int")
    out = oversample.smote(df, "y", ["a", "flag"], "k", k=3, seed=2)
    assert out.schema["flag"].dataType.simpleString() == "boolean"
    parents = {r["k"]: r["flag"] for r in df.where("y = 1").collect()}
    # a synthetic flag is true only when its base row's flag is true (and its neighbour's)
    for r in out.where("synthetic AND flag").collect():
        assert parents[r["k"]]


def test_metrics_of_any_classes(spark):
    rows = [("m", 0, 0), ("m", 2, 0), ("m", 2, 2), ("n", 1, 1)]
    df = spark.createDataFrame(rows, "model string, y int, p int")
    cells = {(r.model, r.actual, r.predicted): r["count"] for r in evaluate.confusion_matrix(df).collect()}
    assert len(cells) == 2 * 9 and sum(cells.values()) == 4 and cells["m", 2, 0] == 1 and cells["n", 1, 1] == 1
    with pytest.raises(Exception, match="beyond the stated"):
        evaluate.confusion_matrix(df, classes=(0, 1)).collect()
    with pytest.raises(Exception, match="classes 0 and 1"):
        evaluate.confusion_cells(df).collect()
    one = spark.createDataFrame([("m", 1, 0.5), ("m", 1, 0.7)], "model string, y int, score double")
    assert evaluate.roc_auc(one).first()["roc_auc"] is None


def test_smote_refuses_holes_and_too_few_rows(spark):
    rows = [(i, float(i), None if i == 3 else 1.0, int(i < 10)) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, a double, b double, y int")
    with pytest.raises(ValueError, match="null or NaN"):
        oversample.smote(df, "y", ["a", "b"], "k")
    out = oversample.smote(df, "y", ["a", "b"], "k", missing=0.0)
    assert out.where("y = 1").count() == out.where("y = 0").count() == 30
    with pytest.raises(ValueError, match="more than 5"):
        oversample.smote(df.where("k < 4 OR k >= 10"), "y", ["a", "b"], "k", missing=0.0)


def test_neighbours_of_equal_points(spark):
    """Points at one distance: k rows per point and block at most, the smallest ids first."""
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(60)], "id long, v array<double>")
    got = oversample.knn(df, "id", "v", k=3, leaf_rows=16).collect()
    assert len(got) == 180
    for i in range(60):
        assert [r.nbr_id for r in sorted((r for r in got if r.id == i), key=lambda r: r.nbr_rank)] == [x for x in range(4) if x != i][:3]


def test_null_groups_are_groups(spark):
    """Ranks, running sums and quantiles of a null group, alone and beside others, over many partitions."""
    rows = [(None if i % 3 == 0 else f"g{i % 3}", None if i % 2 else i % 5, i, float(i % 7)) for i in range(90)]
    df = spark.createDataFrame(rows, "g string, h int, k int, v double")
    want = {r.k: r.r for r in df.selectExpr("k", "row_number() OVER (PARTITION BY g, h ORDER BY v, k) AS r").collect()}
    got = ranking.global_rank(df.repartition(7), ["v", "k"], "r", ["g", "h"], num_partitions=9)
    assert {r.k: r.r for r in got.collect()} == want
    sums = ranking.prefix_sums(df, ["k"], ["v"], ["g", "h"], num_partitions=5)
    want = {r.k: r.s for r in df.selectExpr("k", "sum(v) OVER (PARTITION BY g, h ORDER BY k) AS s").collect()}
    assert {r.k: r.v_cum for r in sums.collect()} == want
    exact = {(r.g, r.h): r.q for r in df.groupBy("g", "h").agg(F.percentile("v", 0.4).alias("q")).collect()}
    for how in (dict(method="bracket"), dict(method="rank"), dict(accuracy=3)):
        found = {(r.g, r.h): r.value for r in ranking.grouped_quantiles(df, "v", ["g", "h"], [0.4], **how).collect()}
        assert found.keys() == exact.keys() and all(found[k] == pytest.approx(exact[k]) for k in exact)


def test_nan_is_left_out(spark):
    """The probes: quartiles, histogram, bins and ranks with NaN are those without."""
    nan = float("nan")
    df = spark.createDataFrame([(i, float(i)) for i in range(9)] + [(9 + i, nan) for i in range(3)] + [(12, None)], "k int, x double")
    five = profile.five_number(df, ["x"]).first()
    assert (five["min"], five["q1"], five["median"], five["q3"], five["max"]) == (0, 2, 4, 6, 8)
    box = profile.boxplot_stats(df, ["x"]).first()
    assert (box["whisker_low"], box["whisker_high"], box["n_outliers"], box["iqr"]) == (0, 8, 0, 4)
    bins = profile.histogram(df, ["x"], 4).collect()
    assert sum(r["count"] for r in bins) == 9 and max(r["hi"] for r in bins) == 8
    for out in (binning.qcut(df, "x", 4, "b"), binning.qcut_rank_first(df, "x", ["k"], 4, "b"), binning.qcut_many(df, {"x": (4, "b")})):
        got = {r.k: r.b for r in out.collect()}
        assert [got[i] for i in range(9)] == [1, 1, 1, 2, 2, 3, 3, 4, 4] and all(got[i] is None for i in range(9, 13))
    summary = profile.table_summary(df, ["x"]).first()
    assert (summary["count"], summary["null_count"], summary["n_distinct"], summary["max"]) == (9, 4, 9, 8)
    empty = spark.createDataFrame([(nan,), (None,)], "x double")
    assert profile.five_number(empty, ["x"]).count() == 0 == profile.boxplot_stats(empty, ["x"]).count()


def test_null_classes_stay_in_the_matrix(spark):
    df = spark.createDataFrame([(None, 1, 1, 0.9), (None, 0, None, None), (None, None, 1, 0.8), (None, 1, 1, 0.7), (None, 0, 0, 0.1)], "model string, y int, p int, score double")
    cells = {(r.actual, r.predicted): r["count"] for r in evaluate.confusion_matrix(df).collect()}
    assert sum(cells.values()) == 5 and len(cells) == 9 and cells[0, None] == cells[None, 1] == 1
    lines = {r.label: r for r in evaluate.classification_report(df).collect()}
    assert lines["accuracy"].f1 == evaluate.accuracy(df).first()["accuracy"] == 0.6 and lines["null"].support == 1
    out = evaluate.compare_models(df).first()
    assert out["model"] is None and out["roc_auc"] == 1.0
    with pytest.raises(Exception, match="stated"):
        evaluate.confusion_matrix(df, classes=(0, 1)).collect()
    with pytest.raises(Exception, match="classes 0 and 1"):
        evaluate.confusion_cells(df).collect()


def test_many_classes_in_one_grid(spark):
    """Hundreds of classes: the grid is a join, and zero cells are there."""
    df = spark.range(600).selectExpr("'m' AS model", "CAST(id % 120 AS INT) AS y", "CAST((id * 7) % 120 AS INT) AS p")
    got = evaluate.confusion_matrix(df)
    assert got.count() == 120 * 120 and got.agg({"count": "sum"}).first()[0] == 600


def test_summary_of_text_and_tiny_values(spark):
    df = spark.createDataFrame([(1e-7, "a"), (3e-7, None), (None, "a")], "x double, t string")
    got = {r["column"]: r for r in profile.table_summary(df).collect()}
    assert got["x"]["mean"] == pytest.approx(2e-7) and got["t"]["mean"] is None
    assert (got["t"]["count"], got["t"]["null_count"], got["t"]["n_distinct"]) == (2, 1, 1)
