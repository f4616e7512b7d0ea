"""Report queries: grouped sum sorted by the measure, metadata-driven default
aggregation, and top-N rows (AGG8, AGG9, SRT1-SRT3).

All three are a single declarative plan: ``HashAggregate`` runs partial
(map-side) then final, so a hot group is reduced before the shuffle; the sort
is a range-partitioned global sort and ``orderBy().limit(n)`` becomes
``TakeOrderedAndProject`` (each task keeps only n rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# summarizeBy values of the semantic model and the Spark aggregate they mean.
_AGGREGATES = {
    "sum": F.sum,
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "average": F.avg,
    "distinctcount": F.count_distinct,
}


def report_table(df: DataFrame, group_cols: list[str], measure: str, agg: str = "sum",
                 descending: bool = True, alias: str | None = None) -> DataFrame:
    """Group by ``group_cols``, aggregate ``measure``, order by the aggregate."""
    name = alias or f"{agg}_{measure}"
    out = df.groupBy(*group_cols).agg(_AGGREGATES[agg](measure).alias(name))
    order = F.col(name).desc() if descending else F.col(name).asc()
    return out.orderBy(order, *group_cols)


def default_aggregation(df: DataFrame, columns: list[str]) -> DataFrame:
    """AGG9: aggregate each selected column by its ``summarizeBy`` metadata.

    Columns whose summarisation is ``none`` become grouping keys; the others
    are aggregated and named ``<agg>_<column>``.
    """
    keys: list[str] = []
    measures: list[Column] = []
    for c in columns:
        how = df.schema[c].metadata.get("summarizeBy", "none")
        if how == "none":
            keys.append(c)
        else:
            measures.append(_AGGREGATES[how](c).alias(f"{how}_{c}"))
    if not measures:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(*measures)


def format_value(c: Column, fmt: str) -> Column:
    """FN13: render a number with a semantic-model format string.

    Supported: ``0`` (integer, no grouping), ``#,0`` (integer with thousands
    separators) and ``0.00``-style fixed decimals.
    """
    if fmt == "0":
        return F.format_string("%d", F.round(c).cast("long"))
    if fmt == "#,0":
        return F.format_number(c, 0)
    if fmt.startswith("0.") and set(fmt[2:]) == {"0"}:
        return F.format_string(f"%.{len(fmt) - 2}f", c.cast("double"))
    raise ValueError(f"unsupported format string {fmt!r}")


def default_aggregation_formatted(df: DataFrame, columns: list[str]) -> DataFrame:
    """AGG9 + FN13: metadata-driven aggregation with each measure rendered by
    its source column's ``formatString``."""
    out = default_aggregation(df, columns)
    for c in columns:
        meta = df.schema[c].metadata
        how, fmt = meta.get("summarizeBy", "none"), meta.get("formatString")
        if how != "none" and fmt:
            out = out.withColumn(f"{how}_{c}", format_value(F.col(f"{how}_{c}"), fmt))
    return out


def top_n(df: DataFrame, n: int, order_by: list[str] | None = None) -> DataFrame:
    """SRT2/SRT3: the first ``n`` rows under an explicit order (the limit is the feature)."""
    cols = order_by or df.columns
    return df.orderBy(*cols).limit(n)
