"""Column functions for diagnostic access-log JSON (FN1-FN8, PRJ1).

The normalised table has 31 columns.  Instead of one ``get_json_object`` call
per column (each of which parses the document again), the flatten parses the
raw text once with ``from_json`` into an all-string struct and converts types
with the ``try_*`` family, so malformed values become null under ANSI mode
instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The target schema of the normalised access-log table, in
# table order, as (column, JSON path, type).  Path None = not from the JSON.
# ---------------------------------------------------------------------------
ACCESS_LOG_COLUMNS = [
    ("EventId", "$.id", "string"),
    ("EventTimeUtc", "$.time", "timestamp"),
    ("IngestedTimeUtc", None, "timestamp"),
    ("Category", "$.category", "string"),
    ("EventType", "$.type", "string"),
    ("SchemaVersion", "$.schemaVersion", "string"),
    ("ResourceId", "$.resourceId", "string"),
    ("TenantId", "$.data.tenantId", "string"),
    ("CapacityId", "$.data.capacityId", "string"),
    ("WorkspaceId", "$.data.workspaceId", "string"),
    ("WorkspaceName", "$.data.workspaceName", "string"),
    ("ItemId", "$.data.itemId", "string"),
    ("ItemType", "$.data.itemType", "string"),
    ("DirectoryId", "$.data.directory", "string"),
    ("Resource", "$.data.resource", "string"),
    ("ServiceEndpoint", "$.data.serviceEndpoint", "string"),
    ("IsShortcut", "$.data.isShortcut", "boolean"),
    ("OperationCategory", "$.data.operationCategory", "string"),
    ("OperationName", "$.data.operationName", "string"),
    ("AccessStartTime", "$.data.accessStartTime", "timestamp"),
    ("AccessEndTime", "$.data.accessEndTime", "timestamp"),
    ("DurationMs", "$.data.durationMs", "bigint"),
    ("ExecutingPrincipalId", "$.data.executingPrincipalId", "string"),
    ("ExecutingPrincipalType", "$.data.executingPrincipalType", "string"),
    ("PrincipalUpn", "$.data.executingPrincipalUpn", "string"),
    ("AuthType", "$.data.authType", "string"),
    ("CallerIpAddress", "$.data.callerIpAddress", "string"),
    ("HttpStatusCode", "$.data.httpStatusCode", "int"),
    ("CorrelationId", "$.data.correlationId", "string"),
    ("OriginatingApp", "$.data.originatingApp", "string"),
    ("RawJson", None, "string"),
]

_SPARK_TYPES = {"string": T.StringType(), "timestamp": T.TimestampType(),
                "boolean": T.BooleanType(), "bigint": T.LongType(), "int": T.IntegerType()}

ACCESS_LOG_SCHEMA = T.StructType([
    T.StructField(name, _SPARK_TYPES[typ], True) for name, _, typ in ACCESS_LOG_COLUMNS
])


def _struct_schema(types: dict[str, T.DataType]) -> T.StructType:
    """Struct mirroring the JSON paths, top-level keys + ``data``: fields whose column type is in ``types`` have that, others are strings."""
    top: list[T.StructField] = []
    data: list[T.StructField] = []
    for _, path, typ in ACCESS_LOG_COLUMNS:
        if path is None:
            continue
        parts = path[2:].split(".")
        (top if len(parts) == 1 else data).append(T.StructField(parts[-1], types.get(typ, T.StringType())))
    return T.StructType([*top, T.StructField("data", T.StructType(data))])


RAW_STRUCT = _struct_schema({})
#: The same with numbers and truth values as such: where a number is read as a string, Spark's
#: multi-line reader opens the file once more for its text.
TYPED_STRUCT = _struct_schema({"bigint": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType()})


def extract(df: DataFrame, paths: dict[str, str], raw_col: str = "RawJson") -> DataFrame:
    """FN1: a few values of a JSON text column as text, by column name and path
    (objects come back as their JSON text); other columns of ``df`` are dropped.

    Each path parses the document once more: for many, use the one-parse flatten.
    """
    return df.select(*[F.get_json_object(raw_col, path).alias(name) for name, path in paths.items()])


def duration_ms(start: Column, end: Column, precision: str = "milli") -> Column:
    """FN6: end - start in milliseconds.

    ``precision="milli"`` keeps the sub-second part; ``"second"`` subtracts whole
    epoch seconds and multiplies by 1000 (the reference's arithmetic).
    """
    if precision == "milli":
        return F.unix_millis(end) - F.unix_millis(start)
    if precision == "second":
        return ((F.unix_timestamp(end) - F.unix_timestamp(start)) * 1000).cast("bigint")
    raise ValueError("precision must be 'milli' or 'second'")


def basename(path: Column) -> Column:
    """FN8: last component of a slash-separated path."""
    return F.element_at(F.split(path, "/"), -1)


def has_suffix_ci(path: Column, suffix: str = ".json") -> Column:
    """FLT3: case-insensitive suffix test."""
    return F.lower(path).endswith(suffix.lower())


def _typed(c: Column, typ: str) -> Column:
    if typ == "string":
        return c
    if typ == "timestamp":
        return F.try_to_timestamp(c)
    return c.try_cast(typ)


def flatten_access_log(df: DataFrame, raw_col: str = "RawJson",
                       ingested: Column | None = None,
                       duration_precision: str = "milli",
                       keep_raw: bool = True, carry: list[str] | None = None) -> DataFrame:
    """PRJ1: raw JSON text column -> the 31-column typed access-log table.

    The document is parsed once; ``DurationMs`` prefers the explicit field and
    falls back to end - start (FN5/FN6).  ``carry`` names columns of ``df`` to keep
    behind them.  ``ingested`` defaults to
    ``current_timestamp()`` (FN7).
    """
    parsed = F.from_json(F.col(raw_col), RAW_STRUCT)
    carry = carry or []
    base = df.select(parsed.alias("_j"), F.col(raw_col).alias("_raw"), *carry)
    exprs: list[Column] = []
    for name, path, typ in ACCESS_LOG_COLUMNS:
        if name == "IngestedTimeUtc":
            exprs.append((ingested if ingested is not None else F.current_timestamp()).alias(name))
            continue
        if name == "RawJson":
            if keep_raw:
                exprs.append(F.col("_raw").alias(name))
            continue
        parts = path[2:].split(".")
        field = F.col("_j").getField(parts[0])
        for p in parts[1:]:
            field = field.getField(p)
        if name == "DurationMs":
            start = F.try_to_timestamp(F.col("_j.data.accessStartTime"))
            end = F.try_to_timestamp(F.col("_j.data.accessEndTime"))
            exprs.append(F.coalesce(field.try_cast("bigint"),
                                    duration_ms(start, end, duration_precision)).alias(name))
            continue
        exprs.append(_typed(field, typ).alias(name))
    return base.select(*exprs, *carry)


def rebuild_raw_json(df: DataFrame, out_col: str = "RawJson", keep_nulls: bool = False) -> DataFrame:
    """FN2: serialise every column of a parsed record back to JSON text.

    Null fields are dropped unless ``keep_nulls``; timestamps keep microseconds.
    """
    cols = [F.col(c) for c in df.columns if c != out_col]
    opts = {
        "ignoreNullFields": "false" if keep_nulls else "true",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    }
    return df.withColumn(out_col, F.to_json(F.struct(*cols), opts))
