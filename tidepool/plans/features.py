"""Feature queries: equal-frequency bins, tie-broken rank bins, ratio,
one-hot encoding and the repeatable split (PRJ4, BIN1-BIN3, ENC1-ENC2, SPL1)."""

from __future__ import annotations

from tidepool.operators import binning, encode, split
from tidepool.plans.registry import query
from tidepool.sources import tables


def _qcut_sql(table: str, col: str, n: int, keys: list[str]) -> str:
    probs = binning.qcut_probs(n)
    plist = ", ".join(repr(p) for p in probs)
    terms = " + ".join(f"CAST({col} > q[{i + 1}] AS INTEGER)" for i in range(1, n))
    return f"""
WITH e AS (SELECT quantile_cont({col}, [{plist}]) AS q FROM {table})
SELECT {", ".join(keys)}, CASE WHEN {col} IS NOT NULL THEN 1 + {terms} END AS bin
FROM {table}, e
"""


_LI_KEY = ["l_orderkey", "l_linenumber"]


@query("qcut6", "BIN1", sql=_qcut_sql("customer", "c_acctbal", 6, ["c_custkey"]))
def qcut6(spark, sf_dir):
    c = tables.load(spark, sf_dir, "customer", ["c_custkey", "c_acctbal"])
    return binning.qcut(c, "c_acctbal", 6, "bin").select("c_custkey", "bin")


@query("qcut8", "BIN1", sql=_qcut_sql("lineitem", "l_quantity", 8, _LI_KEY))
def qcut8(spark, sf_dir):
    li = tables.load(spark, sf_dir, "lineitem", [*_LI_KEY, "l_quantity"])
    return binning.qcut(li, "l_quantity", 8, "bin").select(*_LI_KEY, "bin")


@query("qcut10", "BIN1", sql=_qcut_sql("lineitem", "l_extendedprice", 10, _LI_KEY))
def qcut10(spark, sf_dir):
    li = tables.load(spark, sf_dir, "lineitem", [*_LI_KEY, "l_extendedprice"])
    return binning.qcut(li, "l_extendedprice", 10, "bin").select(*_LI_KEY, "bin")


def _rank_qcut_sql(n: int) -> str:
    probs = binning.qcut_probs(n)
    terms = " + ".join(f"CAST(rk > 1 + (cnt - 1) * {p!r} AS INTEGER)" for p in probs[1:-1])
    return f"""
WITH r AS (SELECT l_orderkey, l_linenumber,
                  row_number() OVER (ORDER BY l_discount, l_orderkey, l_linenumber) AS rk,
                  count(*) OVER () AS cnt
           FROM lineitem WHERE l_discount IS NOT NULL)
SELECT l_orderkey, l_linenumber, 1 + {terms} AS bin FROM r
"""


@query("rank_first_qcut5", "BIN2,BIN3,D13", sql=_rank_qcut_sql(5))
def rank_first_qcut5(spark, sf_dir):
    li = tables.load(spark, sf_dir, "lineitem", [*_LI_KEY, "l_discount"])
    return binning.qcut_rank_first(li, "l_discount", _LI_KEY, 5, "bin").select(*_LI_KEY, "bin")


@query("rank_first", "BIN2", sql="""
SELECT l_orderkey, l_linenumber,
       row_number() OVER (ORDER BY l_extendedprice, l_orderkey, l_linenumber) AS rank
FROM lineitem
""")
def rank_first(spark, sf_dir):
    li = tables.load(spark, sf_dir, "lineitem", [*_LI_KEY, "l_extendedprice"])
    return binning.rank_first(li, "l_extendedprice", _LI_KEY, "rank").select(*_LI_KEY, "rank")


@query("ratio_feature", "PRJ4,FN11", sql="""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity / l_discount END AS ratio
FROM lineitem
""")
def ratio_feature(spark, sf_dir):
    li = tables.load(spark, sf_dir, "lineitem", [*_LI_KEY, "l_quantity", "l_discount"])
    return binning.ratio(li, "l_quantity", "l_discount", "ratio").select(*_LI_KEY, "ratio")


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("onehot_inplace", "ENC1,PRJ5", sql="SELECT c_custkey, " + ", ".join(
    f"coalesce(c_mktsegment = '{v}', false) AS \"c_mktsegment_{v}\"" for v in _SEGMENTS)
    + ", c_acctbal FROM customer")
def onehot_inplace(spark, sf_dir):
    c = tables.load(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment", "c_acctbal"])
    return encode.one_hot(c, ["c_mktsegment"], in_place=True)


_STATUS = ["F", "O", "P"]
_PRIORITY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("onehot_append", "ENC2", sql="SELECT o_orderkey, o_totalprice, " + ", ".join(
    [f"coalesce(o_orderstatus = '{v}', false) AS \"o_orderstatus_{v}\"" for v in _STATUS]
    + [f"coalesce(o_orderpriority = '{v}', false) AS \"o_orderpriority_{v}\"" for v in _PRIORITY])
    + " FROM orders")
def onehot_append(spark, sf_dir):
    o = tables.load(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"])
    return encode.one_hot(o, ["o_orderstatus", "o_orderpriority"])


_SPLIT_SQL = """
WITH h AS (SELECT o_orderkey,
                  ('0x' || substr(md5('12345' || '|' || CAST(o_orderkey AS VARCHAR)), 1, 13))::BIGINT AS h
           FROM orders),
r AS (SELECT o_orderkey, row_number() OVER (ORDER BY h, o_orderkey) AS rk, count(*) OVER () AS n FROM h),
s AS (SELECT o_orderkey, rk, ceil(0.2 * n) AS n_test, ceil(0.25 * (n - ceil(0.2 * n))) AS n_val FROM r)
SELECT o_orderkey,
       CASE WHEN rk <= n_test THEN 'test' WHEN rk <= n_test + n_val THEN 'validation'
            ELSE 'train' END AS split
FROM s
"""


@query("split_60_20_20", "SPL1,D14", sql=_SPLIT_SQL)
def split_60_20_20(spark, sf_dir):
    o = tables.load(spark, sf_dir, "orders", ["o_orderkey"])
    return split.split_exact(o, ["o_orderkey"], seed=12345)


@query("split_hash_buckets", "SPL1", sql="""
WITH b AS (SELECT o_orderkey,
                  ('0x' || substr(md5('12345' || '|' || CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 100 AS b
           FROM orders)
SELECT o_orderkey, CASE WHEN b < 20 THEN 'test' WHEN b < 40 THEN 'validation' ELSE 'train' END AS split
FROM b
""")
def split_hash_buckets(spark, sf_dir):
    o = tables.load(spark, sf_dir, "orders", ["o_orderkey"])
    return split.split_bucket(o, ["o_orderkey"], seed=12345)
