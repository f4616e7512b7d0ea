"""Equal-frequency binning (BIN1-BIN3) and the derived ratio feature (PRJ4).

Edges are exact linear-interpolated quantiles at ``linspace(0, 1, n + 1)``
(pandas ``qcut``); bins are closed on the right and the first bin includes the
minimum, so label = 1 + number of inner edges strictly below the value.  Only
the n + 1 edge values reach the driver; labelling is one JVM-side ``CASE``-free
sum of comparisons.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.ranking import exact_quantiles, global_rank, number, order_statistics


class DuplicateEdgesError(ValueError):
    """Raised when equal-frequency edges coincide (pandas ``duplicates='raise'``)."""


def qcut_probs(n: int) -> list[float]:
    return [float(p) for p in np.linspace(0.0, 1.0, n + 1)]


def label_from_edges(x: Column, inner_edges: list[float]) -> Column:
    """1 + number of inner edges < x; null stays null, and NaN becomes null."""
    x = number(x)
    acc = F.lit(1)
    for e in inner_edges:
        acc = acc + (x > F.lit(float(e))).cast("int")
    return F.when(x.isNotNull(), acc)


def qcut_edges(df: DataFrame, col: str, n: int) -> list[float]:
    q = exact_quantiles(df.select(col), [col], qcut_probs(n)).orderBy("p").collect()
    edges = [r["value"] for r in q]
    if len(set(edges)) != len(edges):
        raise DuplicateEdgesError(f"bin edges of {col!r} are not unique: {edges}")
    return edges


def qcut_many(df: DataFrame, bins: dict[str, tuple[int, str]]) -> DataFrame:
    """BIN1 for several columns, ``{column: (n, output column)}``: all edges from one quantile call."""
    probs = sorted({p for n, _ in bins.values() for p in qcut_probs(n)})
    found = {(r["column"], r["p"]): r["value"] for r in exact_quantiles(df.select(*bins), list(bins), probs).collect()}
    added = {}
    for col, (n, out_col) in bins.items():
        edges = [found[col, p] for p in qcut_probs(n) if (col, p) in found]
        if len(set(edges)) != len(edges):
            raise DuplicateEdgesError(f"bin edges of {col!r} are not unique: {edges}")
        added[out_col] = label_from_edges(F.col(col), edges[1:-1])
    return df.withColumns(added)


def qcut(df: DataFrame, col: str, n: int, out_col: str, fit_df: DataFrame | None = None) -> DataFrame:
    """BIN1: label 1..n by equal-frequency bins of ``col``.

    Edges come from ``df`` itself (the reference's choice, D17) or, with
    ``fit_df``, from another frame such as the training split; values outside
    the fitted range fall into the first or last bin.
    """
    edges = qcut_edges(fit_df if fit_df is not None else df, col, n)
    return df.withColumn(out_col, label_from_edges(F.col(col), edges[1:-1]))


def rank_first(df: DataFrame, col: str, key_cols: list[str], out_col: str = "rank") -> DataFrame:
    """BIN2: rank with ties broken by ``key_cols`` (pandas ``rank(method="first")``
    when the key follows row order)."""
    return global_rank(df, [col, *key_cols], name=out_col)


def qcut_rank_first(df: DataFrame, col: str, key_cols: list[str], n: int, out_col: str) -> DataFrame:
    """BIN3: equal-frequency bins of the tie-broken rank.

    The ranks are 1..N, so the inner edges are e = 1 + (N - 1) * i / n exactly,
    and rank > e exactly when the row is at or after the row of rank
    floor(e) + 1 under (col, *key_cols).  Those n - 1 rows are selected without
    sorting the table (``order_statistics``) and each row is labelled by
    comparing with them.  (``ntile`` differs when N mod n != 0.)
    """
    x = F.col(col)
    present = number(x).isNotNull() if isinstance(df.schema[col].dataType, (T.FloatType, T.DoubleType)) else x.isNotNull()
    valid = df.where(present)
    total = valid.count()
    probs = qcut_probs(n)
    bounds = [int(np.floor(1.0 + (total - 1) * p)) + 1 for p in probs[1:-1]]
    inside = [b for b in bounds if 1 <= b <= total]
    stats = order_statistics(valid, col, key_cols, inside)
    order = F.struct(x, *[F.col(c) for c in key_cols])
    types = {f.name: f.dataType for f in df.schema.fields}
    acc = F.lit(1)
    for b in bounds:
        if b > total:
            continue  # no row reaches this rank
        row = stats[b]
        bound = F.struct(*[F.lit(v).cast(types[c]).alias(c) for v, c in zip(row, [col, *key_cols])])
        acc = acc + (order >= bound).cast("int")
    return df.withColumn(out_col, F.when(present, acc))


def ratio(df: DataFrame, num: str, den: str, out_col: str) -> DataFrame:
    """PRJ4: num / den as double; null where den is 0 or null (pandas gives inf)."""
    return df.withColumn(out_col, F.try_divide(F.col(num).cast("double"), F.col(den).cast("double")))
