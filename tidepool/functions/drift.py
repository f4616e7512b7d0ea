"""Fields that the declared log schema doesn't name (PRJ1, FN1): kept as VARIANT, queryable by path, reported.

The typed flatten reads the paths it knows; a new or moved field would only
survive in the raw text.  Here the document is parsed once more, into a VARIANT,
and everything off the declared paths is listed with its type.  All of it is
JVM-side: no document is seen by Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.jsonlog import ACCESS_LOG_COLUMNS

#: Declared paths, as ``a`` or ``data.b``.
KNOWN = tuple(path[2:] for _, path, _ in ACCESS_LOG_COLUMNS if path is not None)
CONTAINER = "data"


def parsed(df: DataFrame, raw_col: str = "RawJson", out_col: str = "Document") -> DataFrame:
    """``df`` with the document as a VARIANT; null where the text is not JSON."""
    return df.withColumn(out_col, F.try_parse_json(F.col(raw_col)))


def value_at(document: Column, path: str, typ: str) -> Column:
    """A value of a VARIANT by path, null where it is absent or doesn't convert."""
    return F.try_variant_get(document, path, typ)


def _entries(df: DataFrame, keep: list[str], at: str, prefix: str) -> DataFrame:
    """A row per entry of the object at a path of the document (none where it is no object): its path and value."""
    entries = F.try_variant_get("Document", at, "map<string,variant>")
    return df.select(*keep, F.explode(entries).alias("_entry", "value")).select(*keep, F.concat(F.lit(prefix), F.col("_entry")).alias("path"), "value")


def unknown_fields(df: DataFrame, raw_col: str = "RawJson", keep: list[str] | None = None) -> DataFrame:
    """A row per document and field off the declared paths: ``keep`` columns, ``path``, ``kind`` (its type), ``value`` (VARIANT).

    Fields of the document and of its ``data`` object count; what is nested in an
    unknown field is in its value.
    """
    keep = keep or []
    docs = parsed(df, raw_col).select(*keep, "Document")
    top = _entries(docs, keep, "$", "").where(F.col("path") != CONTAINER)
    both = top.unionByName(_entries(docs, keep, f"$.{CONTAINER}", f"{CONTAINER}."))
    return both.where(~F.col("path").isin(*KNOWN)).select(*keep, "path", F.schema_of_variant("value").alias("kind"), "value")


def drift_report(df: DataFrame, raw_col: str = "RawJson") -> DataFrame:
    """Per unknown path: documents that have it, the one type that holds all its values, and how many types occur."""
    return unknown_fields(df, raw_col).groupBy("path").agg(
        F.count(F.lit(1)).alias("documents"), F.schema_of_variant_agg("value").alias("merged_type"), F.count_distinct("kind").alias("types"))


def misplaced(df: DataFrame, raw_col: str = "RawJson") -> DataFrame:
    """Declared paths that hold an object or array where a scalar is declared: ``path``, ``documents``."""
    docs = parsed(df, raw_col)
    nested = F.filter(F.array(*[
        F.when(F.schema_of_variant(F.try_variant_get("Document", f"$.{p}", "variant")).rlike("^(OBJECT|ARRAY)"), F.lit(p)) for p in KNOWN]), lambda p: p.isNotNull())
    return docs.select(F.explode(nested).alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("documents"))
