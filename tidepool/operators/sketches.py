"""Profiles that are kept with the table (AGG1, AGG3): mergeable sketches per part, so that a grown table's profile reads only its new parts.

A part is a value of ``part_col``: a file, a delivery, a day.  For each part and
column the profile table holds exact counts, extremes and sums, a HyperLogLog
sketch for the distinct count and a KLL sketch for quantiles.  ``merged`` unites
them into the profile of the whole; that reads a row per part and column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.profile import is_numeric, present
from tidepool.sources import folders

#: 2^LG_K HyperLogLog registers: relative standard error 1.04 / sqrt(2^LG_K) = 0.8%.
LG_K = 14
#: KLL size: rank error about 1.65% (double-sided, 99%) at 200, falling with k.
KLL_K = 800
DISTINCT_ERROR = 1.04 / 2 ** (LG_K / 2)
RANK_ERROR = 0.005

FIELDS = ["rows", "nulls", "min", "max", "sum", "squares", "distinct", "quantiles"]


def _aggregates(df: DataFrame, col: str) -> list[Column]:
    own = present(df, col)
    x = own.cast("double") if is_numeric(df, col) else F.lit(None).cast("double")
    return [F.count(F.lit(1)).alias(f"{col}__rows"), F.count_if(own.isNull()).alias(f"{col}__nulls"), F.min(x).alias(f"{col}__min"), F.max(x).alias(f"{col}__max"),
            F.sum(x).alias(f"{col}__sum"), F.sum(x * x).alias(f"{col}__squares"), F.hll_sketch_agg(own.cast("string"), LG_K).alias(f"{col}__distinct"),
            F.kll_sketch_agg_double(x, KLL_K).alias(f"{col}__quantiles")]


def part_profiles(df: DataFrame, cols: list[str], part_col: str) -> DataFrame:
    """``part``, ``column`` and ``FIELDS``, from one aggregation (partial before the shuffle)."""
    wide = df.groupBy(F.col(part_col).cast("string").alias("part")).agg(*[a for c in cols for a in _aggregates(df, c)])
    each = F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{f}").alias(f) for f in FIELDS]) for c in cols])
    return wide.select("part", F.explode(each).alias("p")).select("part", "p.*")


def update(df: DataFrame, path: str, cols: list[str], part_col: str) -> int:
    """Profile the parts of ``df`` that the profile table at ``path`` lacks, and add them; returns how many.

    Known parts are left out by a filter on ``part_col``: where that is a partition
    column, or ``_metadata.file_path`` carried as one, their files aren't read.
    """
    spark = df.sparkSession
    known = {r[0] for r in spark.read.parquet(path).select("part").distinct().collect()} if folders.exists(spark, path) else set()  # a row per part
    new = df.where(~F.coalesce(F.col(part_col).cast("string").isin(*known), F.lit(False))) if known else df
    profiles = part_profiles(new, cols, part_col)
    profiles.withColumn("of", F.lit(len(known))).write.mode("append").partitionBy("of").parquet(path)
    return spark.read.parquet(path).select("part").distinct().count() - len(known)


def merged(spark: SparkSession, path: str, probs: list[float] | None = None) -> DataFrame:
    """The whole table's profile: ``column``, ``count``, ``null_count``, ``n_distinct`` (estimate), ``mean``, ``stddev``, ``min``, ``max``, ``quantiles`` (estimates at ``probs``)."""
    parts = spark.read.parquet(path)
    probs = probs or [0.25, 0.5, 0.75]
    n = F.col("rows") - F.col("nulls")
    total = parts.groupBy("column").agg(
        *[F.sum(c).alias(c) for c in ("rows", "nulls", "sum", "squares")], F.min("min").alias("min"), F.max("max").alias("max"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"), F.kll_merge_agg_double("quantiles").alias("sketch"))
    variance = F.when(n > 1, F.greatest(F.lit(0.0), F.col("squares") - F.col("sum") * F.col("sum") / n) / (n - 1))
    at = F.when(F.kll_sketch_get_n_double("sketch") > 0, F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in probs])))
    return total.select("column", n.alias("count"), F.col("nulls").alias("null_count"), "n_distinct", F.try_divide(F.col("sum"), n).alias("mean"),
                        F.sqrt(variance).alias("stddev"), "min", "max", at.alias("quantiles"))
