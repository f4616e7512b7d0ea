"""Neighbour search and SMOTE queries (SMP2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators import oversample
from tidepool.plans.registry import query
from tidepool.sources import tables


@query("smote_neighbours", "SMP2", sql="""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (SELECT a.label, a.vec_id, b.vec_id AS nbr_id, list_distance(a.v, b.v) AS dist
      FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, nbr_id) AS nbr_rank FROM p)
SELECT label, vec_id, CAST(nbr_rank AS INTEGER) AS nbr_rank, nbr_id, round(dist, 9) AS dist
FROM r WHERE nbr_rank <= 5
""")
def smote_neighbours(spark, sf_dir):
    emb = tables.load(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    nn = oversample.knn(emb, "vec_id", "embedding", k=5, group_cols=["label"])
    return nn.withColumn("dist", F.round("dist", 9))


# Churn-like training rows from orders: target = finished order; features are
# the price in thousands, the priority number and the order month.
_ORDER_FEATURES_SQL = """
SELECT o_orderkey,
       o_totalprice / 1000.0 AS price_k,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
       CAST(month(o_orderdate) AS INTEGER) AS month,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label
FROM orders
"""


def order_features(spark, sf_dir):
    o = tables.load(spark, sf_dir, "orders",
                    ["o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate", "o_orderstatus"])
    return o.select("o_orderkey",
                    (F.col("o_totalprice") / 1000.0).alias("price_k"),
                    F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
                    F.month("o_orderdate").alias("month"),
                    (F.col("o_orderstatus") == "F").cast("int").alias("label"))


_SMOTE_SQL = f"""
WITH f AS ({_ORDER_FEATURES_SQL}),
cnt AS (SELECT CAST(sum(label) AS BIGINT) AS n_min, CAST(sum(1 - label) AS BIGINT) AS n_maj FROM f),
m AS (SELECT * FROM f WHERE label = 1),
p AS (SELECT a.o_orderkey AS b, c.o_orderkey AS n,
             sqrt((a.price_k - c.price_k) * (a.price_k - c.price_k)
                  + (a.priority - c.priority) * (a.priority - c.priority)
                  + (a.month - c.month) * (a.month - c.month)) AS dist
      FROM m a JOIN m c ON a.o_orderkey <> c.o_orderkey),
nn AS (SELECT b, n, row_number() OVER (PARTITION BY b ORDER BY dist, n) AS nbr_rank FROM p),
nn5 AS (SELECT * FROM nn WHERE nbr_rank <= 5),
bases AS (SELECT m.*, row_number() OVER (
            ORDER BY ('0x' || substr(md5('12345|' || CAST(o_orderkey AS VARCHAR)), 1, 13))::BIGINT, o_orderkey) AS r
          FROM m),
q AS (SELECT bases.*, (n_maj - n_min) // n_min + CASE WHEN r <= (n_maj - n_min) % n_min THEN 1 ELSE 0 END AS quota
      FROM bases, cnt),
g AS (SELECT q.*, unnest(range(0, quota)) AS j FROM q WHERE quota > 0),
gh AS (SELECT g.*, md5('12345|' || CAST(o_orderkey AS VARCHAR) || '|' || CAST(j AS VARCHAR)) AS hj FROM g),
gs AS (SELECT gh.*, ('0x' || substr(hj, 1, 8))::BIGINT % 5 + 1 AS nbr_rank,
              ('0x' || substr(hj, 9, 8))::BIGINT / 4294967296.0 AS gap FROM gh),
syn AS (SELECT gs.o_orderkey, CAST(gs.j AS INTEGER) AS j,
               gs.price_k + gs.gap * (nb.price_k - gs.price_k) AS price_k,
               CAST(trunc(gs.priority + gs.gap * (nb.priority - gs.priority)) AS INTEGER) AS priority,
               CAST(trunc(gs.month + gs.gap * (nb.month - gs.month)) AS INTEGER) AS month,
               1 AS label, true AS synthetic
        FROM gs JOIN nn5 ON nn5.b = gs.o_orderkey AND nn5.nbr_rank = gs.nbr_rank
                JOIN m nb ON nb.o_orderkey = nn5.n)
SELECT o_orderkey, -1 AS j, price_k, priority, month, label, false AS synthetic FROM f
UNION ALL SELECT * FROM syn
"""


@query("smote_balanced", "SMP2,SMP1", sql=_SMOTE_SQL)
def smote_balanced(spark, sf_dir):
    f = order_features(spark, sf_dir)
    return oversample.smote(f, "label", ["price_k", "priority", "month"], "o_orderkey", minority=1,
                            k=5, seed=12345)


# The same with holes: the price of every fifth order and the month of every
# seventh are null; a hole counts as 0 in distances and new rows.
_HOLES = (_SMOTE_SQL.replace(
    "o_totalprice / 1000.0 AS price_k", "CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice / 1000.0 END AS price_k").replace(
    "CAST(month(o_orderdate) AS INTEGER) AS month", "CASE WHEN o_orderkey % 7 <> 0 THEN CAST(month(o_orderdate) AS INTEGER) END AS month").replace(
    "m AS (SELECT * FROM f WHERE label = 1)", "m AS (SELECT o_orderkey, coalesce(price_k, 0) AS price_k, priority, coalesce(month, 0) AS month, label FROM f WHERE label = 1)"))


@query("smote_with_nulls", "SMP2", sql=_HOLES)
def smote_with_nulls(spark, sf_dir):
    """Features with nulls: none of the synthetic rows is lost."""
    f = order_features(spark, sf_dir)
    key = F.col("o_orderkey")
    f = f.withColumns({"price_k": F.when(key % 5 != 0, F.col("price_k")), "month": F.when(key % 7 != 0, F.col("month"))})
    return oversample.smote(f, "label", ["price_k", "priority", "month"], "o_orderkey", minority=1, k=5, seed=12345, missing=0.0)
