"""Join helpers: a broadcast hint only for a side whose size is bounded by construction.

Other joins have no hint: AQE broadcasts a side by its real bytes, and splits hot keys.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(small: DataFrame) -> DataFrame:
    """Broadcast a side whose size is bounded by construction.

    Use only for tables whose row count is fixed by a parameter rather than by
    the data (partition offsets: one row per shuffle partition).
    """
    return F.broadcast(small)


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on columns of one name where null meets null (``=`` would drop null groups); ``left``'s key columns stay.

    Still an equi-join: Spark hashes and sorts on the keys and their null flags.
    """
    other = {k: f"_right_{i}" for i, k in enumerate(keys)}
    renamed = right.select(*[F.col(c).alias(other.get(c, c)) for c in right.columns])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(o)) for k, o in other.items()])
    return left.join(renamed, same, how).drop(*other.values())
