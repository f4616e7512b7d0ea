"""Repeatable train / validation / test split (SPL1).

Rows are ordered by a 52-bit number read from ``md5(seed|key)`` (ties by key) --
a pseudo-random permutation that depends only on the row's key, not on
partitioning or file layout, unlike ``randomSplit``.  The exact form cuts that
order at exact ranks (test = ceil(test_frac * N), validation =
ceil(val_frac * rest), like ``train_test_split`` twice).  Only the two rows at
the cut ranks are needed, so they are selected (``order_statistics``) and every
row is labelled by comparing with them -- no sort of the table.  The bucket
form cuts the hash at percentages.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.operators.ranking import order_statistics


def key_hash(key_cols: list[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols]))


def key_hash52(key_cols: list[str], seed: int) -> Column:
    """First 13 hex digits of the key hash as a number (exact in a double)."""
    return F.conv(F.substring(key_hash(key_cols, seed), 1, 13), 16, 10).cast("bigint")


def split_sizes(n: int, test_frac: float, val_frac: float) -> tuple[int, int, int]:
    n_test = math.ceil(test_frac * n)
    n_val = math.ceil(val_frac * (n - n_test))
    return n - n_test - n_val, n_val, n_test


def split_exact(df: DataFrame, key_cols: list[str], seed: int = 12345, test_frac: float = 0.2,
                val_frac: float = 0.25, out_col: str = "split") -> DataFrame:
    """Label each row ``train`` / ``validation`` / ``test`` with exact part sizes.

    Keys must be unique and non-null.
    """
    h = df.withColumn("_h", key_hash52(key_cols, seed))
    n = h.count()
    _, n_val, n_test = split_sizes(n, test_frac, val_frac)
    cuts = order_statistics(h, "_h", key_cols, [r for r in (n_test, n_test + n_val) if r >= 1])
    order = F.struct(F.col("_h"), *[F.col(c) for c in key_cols])

    def at_most(rank: int):
        if rank < 1:
            return F.lit(False)
        bound = cuts[rank]
        return order <= F.struct(*[F.lit(v).cast(h.schema[c].dataType).alias(c)
                                   for v, c in zip(bound, ["_h", *key_cols])])

    label = (F.when(at_most(n_test), F.lit("test"))
             .when(at_most(n_test + n_val), F.lit("validation"))
             .otherwise(F.lit("train")))
    return h.withColumn(out_col, label).drop("_h")


def split_bucket(df: DataFrame, key_cols: list[str], seed: int = 12345, test_pct: int = 20,
                 val_pct: int = 20, out_col: str = "split") -> DataFrame:
    """Hash-bucket form: bucket = first 8 hex digits of the hash mod 100."""
    b = F.pmod(F.conv(F.substring(key_hash(key_cols, seed), 1, 8), 16, 10).cast("bigint"), F.lit(100))
    label = (F.when(b < test_pct, F.lit("test"))
             .when(b < test_pct + val_pct, F.lit("validation"))
             .otherwise(F.lit("train")))
    return df.withColumn(out_col, label)
