"""One-hot encoding (ENC1, ENC2).

Levels are the sorted distinct non-null values, found by one aggregation; only
that list (checked against ``max_levels``) reaches the driver.  The indicators
are then plain boolean expressions in one ``select`` -- no join, no UDF.
Indicator names are ``<column>_<level>``; a null value gives all-false.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


class TooManyLevelsError(ValueError):
    pass


def levels(df: DataFrame, col: str, max_levels: int = 1000) -> list:
    """Sorted distinct non-null values of ``col``; raises beyond ``max_levels``."""
    rows = (df.where(F.col(col).isNotNull()).select(col).distinct()
            .orderBy(col).limit(max_levels + 1).collect())
    if len(rows) > max_levels:
        raise TooManyLevelsError(f"{col!r} has more than {max_levels} levels")
    return [r[0] for r in rows]


def text_levels(df: DataFrame, cols: list[str], max_levels: int = 1000) -> dict[str, list]:
    """``levels`` of several text columns in one scan."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in cols]))
    long = df.select(pairs.alias("_p")).select("_p.*").where("v IS NOT NULL").distinct()
    some = long.withColumn("n", F.row_number().over(Window.partitionBy("c").orderBy("v"))).where(F.col("n") <= max_levels + 1)
    out: dict[str, list] = {c: [] for c in cols}
    for r in sorted(some.collect()):  # at most max_levels + 1 per column
        out[r["c"]].append(r["v"])
    if over := [c for c in cols if len(out[c]) > max_levels]:
        raise TooManyLevelsError(f"{over[0]!r} has more than {max_levels} levels")
    return out


def _indicators(col: str, lv: list, sep: str):
    return [F.coalesce(F.col(col) == F.lit(v), F.lit(False)).alias(f"{col}{sep}{v}") for v in lv]


def one_hot(df: DataFrame, cols: list[str], in_place: bool = False, sep: str = "_",
            level_map: dict[str, list] | None = None, max_levels: int = 1000) -> DataFrame:
    """ENC1 (``in_place=True``): indicators take the source column's position.
    ENC2 (default): source columns dropped, indicators appended in column order."""
    level_map = dict(level_map or {})
    text = [c for c in cols if c not in level_map and df.schema[c].dataType == T.StringType()]
    if text:
        level_map |= text_levels(df, text, max_levels)
    for c in cols:
        if c not in level_map:
            level_map[c] = levels(df, c, max_levels)
    if in_place:
        out = []
        for c in df.columns:
            out.extend(_indicators(c, level_map[c], sep) if c in cols else [F.col(c)])
        return df.select(*out)
    keep = [F.col(c) for c in df.columns if c not in cols]
    added = [e for c in cols for e in _indicators(c, level_map[c], sep)]
    return df.select(*keep, *added)


def one_hot_vector(df: DataFrame, col: str, out_col: str):
    """Vector form for ``pyspark.ml``: ``StringIndexer`` (alphabetical) +
    ``OneHotEncoder(dropLast=False)``; returns (fitted model, transformed frame)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    pipe = Pipeline(stages=[
        StringIndexer(inputCol=col, outputCol=f"{col}__idx", stringOrderType="alphabetAsc",
                      handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{col}__idx"], outputCols=[out_col], dropLast=False),
    ])
    model = pipe.fit(df)
    return model, model.transform(df)
