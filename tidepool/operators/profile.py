"""Profiling aggregates (AGG1-AGG7, AGG10).

Every profile is one or two aggregation jobs over the whole table with
map-side partial aggregation; wide results are unpivoted afterwards (on one
row per column, so the unpivot is free).  Nothing is collected: per-column
ranges and quartiles stay in the plan as one-row-per-column tables joined back
by broadcast (bounded by the number of columns).  NaN is left out as null is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.ranking import exact_quantiles, number

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, _NUMERIC)


def present(df: DataFrame, col: str) -> Column:
    """The column, NaN made null."""
    if isinstance(df.schema[col].dataType, (T.FloatType, T.DoubleType)):
        return F.nanvl(F.col(col), F.lit(None).cast(df.schema[col].dataType))
    return F.col(col)


def _unpivot_one_row(row_df: DataFrame, cols: list[str], fields: list[str]) -> DataFrame:
    """One wide row with ``<col>__<field>`` columns -> one row per column."""
    structs = [F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{f}").alias(f) for f in fields])
               for c in cols]
    return row_df.select(F.explode(F.array(*structs)).alias("_s")).select("_s.*")


def nunique(df: DataFrame, cols: list[str] | None = None, approx: bool = False,
            rsd: float = 0.01) -> DataFrame:
    """AGG1: distinct non-null values per column -> (column, n_distinct).

    ``approx`` uses HyperLogLog++ (fixed memory per column) for very wide or
    very high-cardinality tables.
    """
    cols = cols or df.columns
    if approx:
        aggs = [F.approx_count_distinct(present(df, c), rsd).alias(f"{c}__n_distinct") for c in cols]
    else:
        aggs = [F.count_distinct(present(df, c)).alias(f"{c}__n_distinct") for c in cols]
    return _unpivot_one_row(df.agg(*aggs), cols, ["n_distinct"])


def column_roles(df: DataFrame, target: str, max_categorical: int = 5,
                 cols: list[str] | None = None) -> DataFrame:
    """AGG2: role per column: ``target``, ``categorical`` (at most ``max_categorical``
    distinct values), ``numeric`` (numeric type, more distinct values), else ``other``."""
    cols = cols or df.columns
    counts = nunique(df, cols)
    numeric = [c for c in cols if is_numeric(df, c)]
    role = (F.when(F.col("column") == target, F.lit("target"))
            .when(F.col("n_distinct") <= max_categorical, F.lit("categorical"))
            .when(F.col("column").isin(numeric) if numeric else F.lit(False), F.lit("numeric"))
            .otherwise(F.lit("other")))
    return counts.withColumn("role", role)


def table_summary(df: DataFrame, cols: list[str] | None = None, approx_distinct: bool = False,
                  rsd: float = 0.01) -> DataFrame:
    """AGG3: count, nulls, distinct per column; mean, stddev, min, max of numeric ones (null for others).

    The mean is that of the doubles: its last bits depend on the order of summation.

    The exact distinct count shuffles every distinct value once (partial
    aggregation first); ``approx_distinct`` uses HyperLogLog++ instead.
    """
    cols = cols or df.columns
    fields = ["count", "null_count", "n_distinct", "mean", "stddev", "min", "max"]
    aggs: list[Column] = []
    for c in cols:
        own = present(df, c)
        x = own.cast("double") if is_numeric(df, c) else F.lit(None).cast("double")
        aggs += [
            F.count(own).alias(f"{c}__count"),
            F.count_if(own.isNull()).alias(f"{c}__null_count"),
            (F.approx_count_distinct(own, rsd) if approx_distinct else F.count_distinct(own))
            .alias(f"{c}__n_distinct"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__stddev"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
        ]
    return _unpivot_one_row(df.agg(*aggs), cols, fields)


FIVE = [0.0, 0.25, 0.5, 0.75, 1.0]
FIVE_NAMES = ["min", "q1", "median", "q3", "max"]


def five_number(df: DataFrame, cols: list[str]) -> DataFrame:
    """AGG4: min, quartiles, max per column (exact, linear interpolation)."""
    q = exact_quantiles(df, cols, FIVE)
    aggs = [F.max(F.when(F.col("p") == p, F.col("value"))).alias(nm) for p, nm in zip(FIVE, FIVE_NAMES)]
    return q.groupBy("column").agg(*aggs)


def boxplot_stats(df: DataFrame, cols: list[str], whis: float = 1.5) -> DataFrame:
    """AGG4: box-plot statistics: quartiles, IQR, whiskers (most extreme values
    within ``whis`` IQR of the box) and the number of outliers beyond them.

    The quartiles (three numbers per column) become literals of one last pass of
    conditional aggregates: no row is copied per column.
    """
    quartiles = {r["column"]: r for r in five_number(df, cols).collect()}  # a row per column
    known = [c for c in cols if c in quartiles]
    fields = "column string, q1 double, median double, q3 double, whisker_low double, whisker_high double, n_outliers bigint, iqr double"
    if not known:
        return df.sparkSession.createDataFrame([], fields)
    aggs, box = [], []
    for c in known:
        q, x = quartiles[c], number(c)
        iqr = q["q3"] - q["q1"]
        inside = x.between(F.lit(q["q1"] - whis * iqr), F.lit(q["q3"] + whis * iqr))
        aggs += [F.min(F.when(inside, x)).alias(f"{c}__low"), F.max(F.when(inside, x)).alias(f"{c}__high"), F.count_if(~inside).alias(f"{c}__n")]
        box.append(F.struct(F.lit(c).alias("column"), F.lit(q["q1"]).alias("q1"), F.lit(q["median"]).alias("median"), F.lit(q["q3"]).alias("q3"),
                            F.col(f"{c}__low").alias("whisker_low"), F.col(f"{c}__high").alias("whisker_high"), F.col(f"{c}__n").alias("n_outliers"), F.lit(iqr).alias("iqr")))
    return df.agg(*aggs).select(F.explode(F.array(*box)).alias("b")).select("b.*")


def histogram(df: DataFrame, cols: list[str], bins: int = 20) -> DataFrame:
    """AGG6: equal-width histogram per column -> (column, bin, lo, hi, count).

    Width = (max - min) / bins; the last bin is closed on the right.  A constant
    column gets the range (v - 0.5, v + 0.5) like numpy.  Empty bins appear
    with count 0; nulls and NaN are in none.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), number(c).alias("v")) for c in cols
    ])).alias("_u")).select("_u.*").where(F.col("v").isNotNull())
    rng = long.groupBy("column").agg(F.min("v").alias("_mn"), F.max("v").alias("_mx"))
    rng = (rng.withColumn("_lo0", F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5)
                          .otherwise(F.col("_mn")))
              .withColumn("_hi0", F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5)
                          .otherwise(F.col("_mx"))))
    idx = F.least(F.floor((F.col("v") - F.col("_lo0")) * bins / (F.col("_hi0") - F.col("_lo0"))),
                  F.lit(bins - 1)).cast("int")
    # rng has one row per column: bounded broadcast side.
    counted = (long.join(F.broadcast(rng), "column")
               .groupBy("column", idx.alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    grid = rng.select("column", "_lo0", "_hi0", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("_hi0") - F.col("_lo0")) / bins
    return (grid.join(counted, ["column", "bin"], "left")
            .select("column", "bin",
                    (F.col("_lo0") + F.col("bin") * width).alias("lo"),
                    (F.col("_lo0") + (F.col("bin") + 1) * width).alias("hi"),
                    F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def counts_by_target(df: DataFrame, attrs: list[str], target: str) -> DataFrame:
    """AGG5: rows per (attribute, value, target) for several attributes in one job."""
    long = df.select(F.col(target).alias("target"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("value")) for c in attrs
    ])).alias("_u")).select("_u.attribute", "_u.value", "target")
    return long.groupBy("attribute", "value", "target").agg(F.count(F.lit(1)).alias("count"))


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """AGG10/SMP1: rows per class and the class share of all rows."""
    counts = df.groupBy(F.col(target).alias("class")).agg(F.count(F.lit(1)).alias("count"))
    # The window runs over the aggregated rows only: one row per class.
    total = F.sum("count").over(Window.partitionBy())
    return counts.select("class", "count", (F.col("count") / total).alias("share"))


def row_count_and_max(df: DataFrame, col: str) -> DataFrame:
    """AGG7: row count and greatest value of ``col`` in one pass."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.max(col).alias(f"max_{col}"))
