"""Cleaning: drop rows with nulls, keep the first row per key, drop columns
(FLT1, DDP1, PRJ2).

"First" needs an explicit order column -- Spark rows have no file order.  The
keep-first is ``row_number() = 1`` over the key; Spark plans it with a partial
``WindowGroupLimit`` before the shuffle, so every map task forwards at most one
row per key and a key holding a third of the table does not land in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def drop_na(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """FLT1: drop rows with a null in any (of ``subset``) column."""
    return df.na.drop(how="any", subset=subset)


def keep_first(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """DDP1: one row per key, the first under ``order_cols`` (ties broken by all columns)."""
    tiebreak = [c for c in df.columns if c not in keys and c not in order_cols]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order_cols + tiebreak])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """PRJ2: drop columns by name."""
    return df.drop(*cols)


def clean_data(df: DataFrame, keys: list[str], order_cols: list[str], drop_cols: list[str],
               order: str = "dropna_first") -> DataFrame:
    """D10: the two cleaning orders of the reference.

    ``dropna_first`` (the one that takes effect): drop rows with nulls, then keep
    the first row per key.  ``dedup_first``: keep the first row per key, then drop
    it if it has a null -- the key disappears when its first row is incomplete.
    """
    if order == "dropna_first":
        out = keep_first(drop_na(df), keys, order_cols)
    elif order == "dedup_first":
        out = drop_na(keep_first(df, keys, order_cols))
    else:
        raise ValueError("order must be 'dropna_first' or 'dedup_first'")
    return drop_columns(out, drop_cols)
