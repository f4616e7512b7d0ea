"""Cleaning and profiling queries (FLT1, DDP1, PRJ2, AGG1-AGG7, AGG10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators import binning, clean, profile, ranking, sketches
from tidepool.plans.registry import query
from tidepool.session import scratch_path
from tidepool.sources import tables

# Conversations stand in for the churn rows: key (conv_id, role) repeats over
# turns, ``turn`` is the row order, and ``note`` is null on every third turn,
# so a key's first row may be incomplete (tells the two cleaning orders apart).
_CONV_SQL = """
SELECT conv_id, role, turn, text,
       CASE WHEN turn % 3 = 0 THEN NULL ELSE role || '-' || CAST(turn AS VARCHAR) END AS note
FROM conversations
"""


def _conversations(spark, sf_dir):
    conv = tables.load(spark, sf_dir, "conversations", ["conv_id", "role", "turn", "text"])
    note = F.when(F.pmod("turn", F.lit(3)) == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.col("role"), F.lit("-"), F.col("turn").cast("string")))
    return conv.withColumn("note", note)


@query("clean_dropna_dedup", "FLT1,DDP1,PRJ2,D10,D11", sql=f"""
WITH c AS ({_CONV_SQL}),
nn AS (SELECT * FROM c WHERE note IS NOT NULL AND text IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS rn FROM nn)
SELECT conv_id, role, turn, note FROM r WHERE rn = 1
""")
def clean_dropna_dedup(spark, sf_dir):
    return clean.clean_data(_conversations(spark, sf_dir), ["conv_id", "role"], ["turn"], ["text"],
                            order="dropna_first")


@query("dedup_dropna_order", "FLT1,DDP1,PRJ2,D10", sql=f"""
WITH c AS ({_CONV_SQL}),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS rn FROM c)
SELECT conv_id, role, turn, note FROM r
WHERE rn = 1 AND note IS NOT NULL AND text IS NOT NULL
""")
def dedup_dropna_order(spark, sf_dir):
    return clean.clean_data(_conversations(spark, sf_dir), ["conv_id", "role"], ["turn"], ["text"],
                            order="dedup_first")


_CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query("nunique_all", "AGG1", sql="""
SELECT 'c_custkey' AS "column", count(DISTINCT c_custkey) AS n_distinct FROM customer
UNION ALL SELECT 'c_name', count(DISTINCT c_name) FROM customer
UNION ALL SELECT 'c_nationkey', count(DISTINCT c_nationkey) FROM customer
UNION ALL SELECT 'c_acctbal', count(DISTINCT c_acctbal) FROM customer
UNION ALL SELECT 'c_mktsegment', count(DISTINCT c_mktsegment) FROM customer
""")
def nunique_all(spark, sf_dir):
    return profile.nunique(tables.load(spark, sf_dir, "customer", _CUSTOMER_COLS))


_PART_ROLE_COLS = ["p_partkey", "p_brand", "p_type", "p_size", "p_retailprice"]


@query("column_roles", "AGG2,D12", sql="""
WITH n AS (
  SELECT 'p_partkey' AS "column", count(DISTINCT p_partkey) AS n_distinct, true AS num FROM part
  UNION ALL SELECT 'p_brand', count(DISTINCT p_brand), false FROM part
  UNION ALL SELECT 'p_type', count(DISTINCT p_type), false FROM part
  UNION ALL SELECT 'p_size', count(DISTINCT p_size), true FROM part
  UNION ALL SELECT 'p_retailprice', count(DISTINCT p_retailprice), true FROM part)
SELECT "column", n_distinct,
       CASE WHEN "column" = 'p_type' THEN 'target'
            WHEN n_distinct <= 5 THEN 'categorical'
            WHEN num THEN 'numeric' ELSE 'other' END AS role
FROM n
""")
def column_roles(spark, sf_dir):
    part = tables.load(spark, sf_dir, "part", _PART_ROLE_COLS)
    return profile.column_roles(part, target="p_type")


_LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


# Digits to which a mean is the same in any order of summation.
_MEAN_DIGITS = {c: 5 if c == "l_extendedprice" else 8 for c in _LI_NUM}

_SUMMARY_SQL = "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, CAST(count(*) - count({c}) AS BIGINT) AS null_count, "
    f"count(DISTINCT {c}) AS n_distinct, round(avg({c}), {_MEAN_DIGITS[c]}) AS mean, "
    f"round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max "
    f"FROM lineitem" for c in _LI_NUM)


@query("table_summary", "AGG3", sql=_SUMMARY_SQL)
def table_summary(spark, sf_dir):
    li = tables.load(spark, sf_dir, "lineitem", _LI_NUM)
    s = profile.table_summary(li, _LI_NUM)
    mean = F.when(F.col("column") == "l_extendedprice", F.round("mean", 5)).otherwise(F.round("mean", 8))
    return s.withColumns({"mean": mean, "stddev": F.round("stddev", 6)})


@query("table_summary_all_columns", "AGG3", sql="\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({x}) AS count, CAST(count(*) - count({x}) AS BIGINT) AS null_count, count(DISTINCT {x}) AS n_distinct, "
    + (f"round(avg({x}), 15) AS mean, round(stddev_samp({x}), 15) AS stddev, CAST(min({x}) AS DOUBLE) AS min, CAST(max({x}) AS DOUBLE) AS max"
       if num else "CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)") + " FROM part"
    for c, x, num in [("tiny", "(p_retailprice * 1e-11)", True), ("p_name", "p_name", False), ("p_type", "p_type", False), ("odd", "nullif(p_brand, 'Brand#13')", False)]))
def table_summary_all_columns(spark, sf_dir):
    """Text columns too, one with nulls, and a measure far below 1e-6."""
    part = tables.load(spark, sf_dir, "part", ["p_name", "p_type", "p_brand", "p_retailprice"])
    part = part.select((F.col("p_retailprice") * 1e-11).alias("tiny"), "p_name", "p_type", F.nullif("p_brand", F.lit("Brand#13")).alias("odd"))
    s = profile.table_summary(part)
    return s.withColumns({c: F.round(c, 15) for c in ("mean", "stddev")})


def _quantile_sql(c: str) -> str:
    return (f"SELECT '{c}' AS \"column\", "
            f"round(quantile_cont({c}, 0.0), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q1, "
            f"round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q3, "
            f"round(quantile_cont({c}, 1.0), 6) AS max FROM lineitem")


@query("five_number", "AGG4", sql="\nUNION ALL ".join(_quantile_sql(c) for c in _LI_NUM))
def five_number(spark, sf_dir):
    li = tables.load(spark, sf_dir, "lineitem", _LI_NUM)
    out = profile.five_number(li, _LI_NUM)
    return out.select("column", *[F.round(c, 6).alias(c) for c in profile.FIVE_NAMES])


@query("boxplot_stats", "AGG4", sql="""
WITH long AS (
  SELECT 'l_quantity' AS "column", l_quantity AS v FROM lineitem
  UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem
  UNION ALL SELECT 'l_discount', l_discount FROM lineitem
  UNION ALL SELECT 'l_tax', l_tax FROM lineitem),
q AS (SELECT "column", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM long GROUP BY "column"),
j AS (SELECT long."column", v, q1, median, q3,
             v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) AS inside
      FROM long JOIN q ON long."column" = q."column")
SELECT "column", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(q3 - q1, 6) AS iqr,
       min(CASE WHEN inside THEN v END) AS whisker_low,
       max(CASE WHEN inside THEN v END) AS whisker_high,
       CAST(sum(CASE WHEN inside THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers
FROM j GROUP BY "column", q1, median, q3
""")
def boxplot_stats(spark, sf_dir):
    li = tables.load(spark, sf_dir, "lineitem", _LI_NUM)
    out = profile.boxplot_stats(li, _LI_NUM)
    return out.select("column", *[F.round(c, 6).alias(c) for c in ["q1", "median", "q3", "iqr"]],
                      "whisker_low", "whisker_high", "n_outliers")


@query("histogram20", "AGG6", sql="""
WITH long AS (
  SELECT 'l_quantity' AS "column", l_quantity AS v FROM lineitem
  UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem
  UNION ALL SELECT 'l_discount', l_discount FROM lineitem
  UNION ALL SELECT 'l_tax', l_tax FROM lineitem),
r AS (SELECT "column", min(v) AS mn, max(v) AS mx FROM long GROUP BY "column"),
r2 AS (SELECT "column", CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo0,
              CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi0 FROM r),
c AS (SELECT long."column", CAST(least(floor((v - lo0) * 20 / (hi0 - lo0)), 19) AS INTEGER) AS bin,
             count(*) AS cnt
      FROM long JOIN r2 ON long."column" = r2."column" GROUP BY ALL),
g AS (SELECT "column", lo0, hi0, CAST(b AS INTEGER) AS bin FROM r2, range(0, 20) t(b))
SELECT g."column", g.bin, round(lo0 + g.bin * ((hi0 - lo0) / 20), 6) AS lo,
       round(lo0 + (g.bin + 1) * ((hi0 - lo0) / 20), 6) AS hi, coalesce(cnt, 0) AS count
FROM g LEFT JOIN c ON g."column" = c."column" AND g.bin = c.bin
""")
def histogram20(spark, sf_dir):
    li = tables.load(spark, sf_dir, "lineitem", _LI_NUM)
    out = profile.histogram(li, _LI_NUM, 20)
    return out.select("column", "bin", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"), "count")


@query("counts_by_target", "AGG5", sql="""
WITH t AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS target, l_linestatus,
                  l_discount, l_quantity FROM lineitem)
SELECT 'l_linestatus' AS attribute, l_linestatus AS value, target, count(*) AS count FROM t GROUP BY ALL
UNION ALL SELECT 'l_discount', CAST(l_discount AS VARCHAR), target, count(*) FROM t GROUP BY ALL
UNION ALL SELECT 'l_quantity', CAST(l_quantity AS VARCHAR), target, count(*) FROM t GROUP BY ALL
""")
def counts_by_target(spark, sf_dir):
    li = tables.load(spark, sf_dir, "lineitem", ["l_returnflag", "l_linestatus", "l_discount", "l_quantity"])
    li = li.withColumn("target", (F.col("l_returnflag") == "R").cast("int"))
    return profile.counts_by_target(li, ["l_linestatus", "l_discount", "l_quantity"], "target")


@query("class_balance", "AGG10,SMP1", sql="""
SELECT toxic AS class, count(*) AS count, count(*) / sum(count(*)) OVER () AS share
FROM labels GROUP BY toxic
""")
def class_balance(spark, sf_dir):
    return profile.class_balance(tables.load(spark, sf_dir, "labels", ["toxic"]), "toxic")


@query("row_count_max", "AGG7,SNK10", sql="""
SELECT count(*) AS row_count, max(url) AS max_url FROM pages
""")
def row_count_max(spark, sf_dir):
    return profile.row_count_and_max(tables.load(spark, sf_dir, "pages", ["url"]), "url")


# Measures where some rows are NaN (and, for the oracle, null: NaN is left out like null).
_NAN_COLS = ["l_quantity", "l_extendedprice"]
_NAN_SQL = "WITH nan AS (SELECT CASE WHEN l_orderkey % 5 <> 0 THEN l_quantity END AS l_quantity, CASE WHEN l_linenumber <> 3 THEN l_extendedprice END AS l_extendedprice FROM lineitem)"


def _with_nan(spark, sf_dir):
    li = tables.load(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", *_NAN_COLS])
    nan = F.lit(float("nan"))
    return li.select("l_orderkey", "l_linenumber", F.when(F.pmod("l_orderkey", F.lit(5)) != 0, F.col("l_quantity")).otherwise(nan).alias("l_quantity"),
                     F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice")).otherwise(nan).alias("l_extendedprice"))


@query("five_number_nan", "AGG4,AGG3", sql=_NAN_SQL + "\nUNION ALL ".join(
    f"""{' ' if i else ''} SELECT '{c}' AS "column", count({c}) AS count, count(*) - count({c}) AS null_count, round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q1,
    round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q3, round(max({c}), 6) AS max FROM nan""" for i, c in enumerate(_NAN_COLS)))
def five_number_nan(spark, sf_dir):
    """NaN is no value: neither a maximum, nor a rank, nor counted."""
    df = _with_nan(spark, sf_dir)
    five = profile.five_number(df, _NAN_COLS).select("column", *[F.round(c, 6).alias(c) for c in profile.FIVE_NAMES])
    counts = profile.table_summary(df, _NAN_COLS).select("column", "count", "null_count")
    return five.join(counts, "column")


@query("histogram_nan", "AGG6", sql=_NAN_SQL + """,
long AS (SELECT 'l_quantity' AS "column", l_quantity AS v FROM nan WHERE l_quantity IS NOT NULL UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM nan WHERE l_extendedprice IS NOT NULL),
r AS (SELECT "column", min(v) AS lo0, max(v) AS hi0 FROM long GROUP BY "column"),
c AS (SELECT long."column", CAST(least(floor((v - lo0) * 20 / (hi0 - lo0)), 19) AS INTEGER) AS bin, count(*) AS count FROM long JOIN r ON long."column" = r."column" GROUP BY ALL)
SELECT r."column", CAST(b AS INTEGER) AS bin, coalesce(c.count, 0) AS count FROM r CROSS JOIN range(0, 20) t(b) LEFT JOIN c ON c."column" = r."column" AND c.bin = t.b
""")
def histogram_nan(spark, sf_dir):
    return profile.histogram(_with_nan(spark, sf_dir), _NAN_COLS, 20).select("column", "bin", "count")


@query("qcut_nan", "BIN1,BIN3", sql="""
WITH nan AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS x FROM orders),
q AS (SELECT quantile_cont(x, [0.2, 0.4, 0.6, 0.8]) AS e FROM nan),
ranked AS (SELECT o_orderkey, row_number() OVER (ORDER BY x, o_orderkey) AS r, count(*) OVER () AS n FROM nan WHERE x IS NOT NULL)
SELECT o_orderkey, CASE WHEN x IS NOT NULL THEN 1 + CAST(x > e[1] AS INTEGER) + CAST(x > e[2] AS INTEGER) + CAST(x > e[3] AS INTEGER) + CAST(x > e[4] AS INTEGER) END AS bin,
       CASE WHEN r IS NOT NULL THEN 1 + CAST(r > 1 + (n - 1) * 0.25 AS INTEGER) + CAST(r > 1 + (n - 1) * 0.5 AS INTEGER) + CAST(r > 1 + (n - 1) * 0.75 AS INTEGER) END AS rank_bin
FROM nan LEFT JOIN ranked USING (o_orderkey), q
""")
def qcut_nan(spark, sf_dir):
    """Rows of NaN have no bin and move no edge."""
    o = tables.load(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"])
    df = o.select("o_orderkey", F.when(F.pmod("o_orderkey", F.lit(5)) != 0, F.col("o_totalprice")).otherwise(F.lit(float("nan"))).alias("x"))
    df = binning.qcut(df, "x", 5, "bin")
    return binning.qcut_rank_first(df, "x", ["o_orderkey"], 4, "rank_bin").select("o_orderkey", "bin", "rank_bin")


_SKETCHED = ["o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"]


@query("profile_of_grown_table", "AGG1,AGG3", sql="\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, count(*) - count({c}) AS null_count, CAST({m.format(f'min({c})')} AS DOUBLE) AS min, CAST({m.format(f'max({c})')} AS DOUBLE) AS max,
    round({m.format(f'avg({c})')}, 6) AS mean, true AS distinct_fits, {'true' if m == '{}' else 'CAST(NULL AS BOOLEAN)'} AS median_fits FROM orders"""
    for c, m in ((c, "{}" if c != "o_orderpriority" else "NULL") for c in _SKETCHED)))
def profile_of_grown_table(spark, sf_dir):
    """The profile of orders, kept by month: first half of the months, then the others (only these are read).  Estimates against exact figures: within 4 standard errors, and within the rank error."""
    path = scratch_path(spark, "profile")
    orders = tables.load(spark, sf_dir, "orders", [*_SKETCHED, "o_orderdate"]).withColumn("part", F.date_format("o_orderdate", "yyyy-MM"))
    sketches.update(orders.where(F.month("o_orderdate") <= 6), path, _SKETCHED, "part")
    sketches.update(orders, path, _SKETCHED, "part")
    found = sketches.merged(spark, path, [0.5])
    exact = profile.nunique(orders, _SKETCHED).withColumnRenamed("n_distinct", "exact")
    numeric = [c for c in _SKETCHED if c != "o_orderpriority"]
    bounds = ranking.exact_quantiles(orders, numeric, [0.5 - sketches.RANK_ERROR, 0.5 + sketches.RANK_ERROR]).groupBy("column").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    fits = F.abs(F.col("n_distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), 4 * sketches.DISTINCT_ERROR * F.col("exact"))
    return found.join(exact, "column").join(bounds, "column", "left").select(
        "column", "count", "null_count", "min", "max", F.round("mean", 6).alias("mean"), fits.alias("distinct_fits"), F.get("quantiles", F.lit(0)).between(F.col("low"), F.col("high")).alias("median_fits"))
