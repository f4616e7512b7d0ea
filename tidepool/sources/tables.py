"""Table scans: driver parquet tables, path tables, catalog tables, CSV.

Every reader takes an explicit schema or a column list so that Catalyst can
prune columns at the scan and push filters into the Parquet reader.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.session import stored

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Storage format for tables we write; Delta only when its jar is on the classpath.
TABLE_FORMAT = os.environ.get("TIDEPOOL_TABLE_FORMAT", "parquet")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan one driver table; ``columns`` narrows the ReadSchema."""
    if name not in DRIVER_TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> None:
    """Expose driver tables to ``spark.sql`` under their own names (SRC6)."""
    for n in names:
        load(spark, sf_dir, n).createOrReplaceTempView(n)


def read_path_table(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """SRC5: a table stored by path."""
    return spark.read.format(fmt or TABLE_FORMAT).load(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """SRC1: header CSV. With a schema no inference pass runs over the files."""
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


#: Name of the column that holds a damaged line as it stands.
DAMAGED = "_damaged"


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """SRC1: (good rows, damaged lines) of a CSV with a stated schema.

    A line is damaged if a field doesn't convert or if it has too few or too many
    fields; nothing of it goes into the good rows, and its text is kept whole
    (column ``DAMAGED`` with ``source_path``) for a quarantine table.  The files are
    parsed once, every column of them (what a pruned scan doesn't parse it can't
    find damaged), into a scratch table that both frames read.
    """
    stated = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = (spark.read.schema(T.StructType([*stated.fields, T.StructField(DAMAGED, T.StringType())]))
            .option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", DAMAGED)
            .option("columnPruning", False).csv(path))
    parsed = stored(rows.select(*stated.names, DAMAGED, F.col("_metadata.file_path").alias("source_path")), "parsed-csv")
    return parsed.where(F.col(DAMAGED).isNull()).select(*stated.names), parsed.where(F.col(DAMAGED).isNotNull()).select(DAMAGED, "source_path")


def csv_schema_check(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True, sampling: float = 1.0) -> DataFrame:
    """SRC1: what inference finds against the stated schema, a row per column: ``column``, ``stated``, ``inferred``, ``verdict``.

    ``verdict``: ``same``, ``wider`` (every value converts to the stated type's
    wider form: the inferred type holds more), ``narrower``, ``other``, ``missing``
    (stated, not in the files) or ``unknown`` (in the files, not stated).
    """
    stated = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    found = spark.read.option("header", header).option("inferSchema", True).option("samplingRatio", sampling).csv(path).schema
    ladder = ["int", "bigint", "double", "string"]

    def verdict(a: str | None, b: str | None) -> str:
        if a is None or b is None:
            return "unknown" if a is None else "missing"
        if a == b:
            return "same"
        if a in ladder and b in ladder:
            return "wider" if ladder.index(b) > ladder.index(a) else "narrower"
        return "other"

    types = [({f.name: f.dataType.simpleString() for f in s.fields}) for s in (stated, found)]
    names = [*types[0], *[n for n in types[1] if n not in types[0]]]
    rows = [(n, types[0].get(n), types[1].get(n), verdict(types[0].get(n), types[1].get(n))) for n in names]
    return spark.createDataFrame(rows, "column string, stated string, inferred string, verdict string")


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """SRC2: ``df`` kept in memory (and on disk beyond it) for what a block does with it, and released after."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


# The report's semantic table ``accounts`` (id, Category, Company_Name,
# Headquarters, Primary_Segment, Estimated_Revenue_USD, Production_Capacity)
# stands in on the driver's ``part`` table.  Column metadata carries the
# default summarisation of the semantic model (id: sum, others: none).
ACCOUNTS_SQL = """
SELECT p_partkey AS id,
       p_type AS Category,
       p_brand AS Company_Name,
       CAST(p_size AS STRING) AS Headquarters,
       p_type AS Primary_Segment,
       CAST(CAST(FLOOR(p_retailprice / 25) * 25 AS BIGINT) AS STRING) AS Estimated_Revenue_USD,
       CAST(p_size * 10 AS STRING) AS Production_Capacity
FROM part
"""


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part",
                ["p_partkey", "p_type", "p_brand", "p_size", "p_retailprice"])
    df = part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_type").alias("Category"),
        F.col("p_brand").alias("Company_Name"),
        F.col("p_size").cast("string").alias("Headquarters"),
        F.col("p_type").alias("Primary_Segment"),
        (F.floor(F.col("p_retailprice") / 25) * 25).cast("bigint").cast("string")
        .alias("Estimated_Revenue_USD"),
        (F.col("p_size") * 10).cast("string").alias("Production_Capacity"),
    )
    # The semantic model's column properties (id: sum, format "0").
    summarize = {"id": "sum"}
    formats = {"id": "0"}
    for field in df.schema.fields:
        meta = {"summarizeBy": summarize.get(field.name, "none")}
        if field.name in formats:
            meta["formatString"] = formats[field.name]
        df = df.withMetadata(field.name, meta)
    return df
