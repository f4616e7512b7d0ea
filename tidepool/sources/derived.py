"""Stand-in inputs derived from the driver tables by Spark.

The reference reads diagnostic JSON files and a churn CSV that the driver
does not ship; these builders derive equivalent inputs from the given tables
so that every query's work grows with them.  Each builder has a DuckDB SQL
twin (``*_SQL``) that the oracle queries use, so both sides start from the
same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.sources import tables

_ISO_MICRO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _event_end(ts: Column, value: Column) -> Column:
    """Access end time = start + ``value`` seconds, rounded to microseconds."""
    return F.timestamp_micros(F.unix_micros(ts.cast("timestamp"))
                              + F.round(value * 1000000).cast("bigint"))


def _doc_struct(damaged: bool) -> Column:
    """One diagnostic access-log document per event, as a struct column.

    Invented but fixed mapping: ``durationMs`` is present for click/view events
    and absent otherwise (so the duration falls back to end - start).  With
    ``damaged`` some fields carry text the typed columns must turn into null:
    bad times, ``isShortcut`` as text, an out-of-range status, ``durationMs = "x"``.
    """
    ts = F.col("ts").cast("timestamp")
    end = _event_end(F.col("ts"), F.col("value"))
    uid = F.col("user_id")
    eid = F.col("event_id")
    et = F.col("event_type")
    has_duration = et.isin("click", "view")
    time_txt = F.date_format(ts, _ISO_MICRO)
    is_short = F.col("value") > 250
    status = F.when(et == "error", F.lit(500)).otherwise(F.lit(200))
    duration = F.when(has_duration, F.round(F.col("value") * 1000).cast("bigint"))
    if damaged:
        bucket = F.pmod(eid, F.lit(7))
        time_txt = F.when(bucket == 1, F.lit("not-a-time")).when(
            bucket == 2, F.concat(F.lit("2024-13-45T"), F.date_format(ts, "HH:mm:ss"), F.lit("Z"))
        ).otherwise(time_txt)
        is_short = F.when(bucket == 3, F.lit("zz")).otherwise(is_short.cast("string"))
        status = F.when(bucket == 4, F.lit("99999999999")).otherwise(status.cast("string"))
        duration = F.when(bucket == 5, F.lit("x")).otherwise(duration.cast("string"))
    data = F.struct(
        F.lit("tenant-0").alias("tenantId"),
        F.concat(F.lit("cap-"), F.pmod(uid, F.lit(3)).cast("string")).alias("capacityId"),
        F.concat(F.lit("ws-"), F.pmod(uid, F.lit(10)).cast("string")).alias("workspaceId"),
        F.concat(F.lit("Workspace "), F.pmod(uid, F.lit(10)).cast("string")).alias("workspaceName"),
        F.concat(F.lit("item-"), uid.cast("string")).alias("itemId"),
        F.upper(et).alias("itemType"),
        F.concat(F.lit("dir-"), F.pmod(uid, F.lit(5)).cast("string")).alias("directory"),
        F.concat(F.lit("Tables/t"), F.pmod(eid, F.lit(20)).cast("string")).alias("resource"),
        F.when(F.pmod(eid, F.lit(2)) == 0, F.lit("dfs")).otherwise(F.lit("blob")).alias("serviceEndpoint"),
        is_short.alias("isShortcut"),
        F.when(et.isin("purchase", "signup"), F.lit("Write")).otherwise(F.lit("Read")).alias("operationCategory"),
        et.alias("operationName"),
        time_txt.alias("accessStartTime"),
        F.date_format(end, _ISO_MICRO).alias("accessEndTime"),
        duration.alias("durationMs"),
        F.concat(F.lit("p-"), uid.cast("string")).alias("executingPrincipalId"),
        F.lit("User").alias("executingPrincipalType"),
        F.concat(F.lit("user"), uid.cast("string"), F.lit("@example.com")).alias("executingPrincipalUpn"),
        F.lit("OAuth").alias("authType"),
        F.concat(F.lit("10.0."), F.pmod(uid, F.lit(256)).cast("string"), F.lit("."),
                 F.pmod(eid, F.lit(256)).cast("string")).alias("callerIpAddress"),
        status.alias("httpStatusCode"),
        F.concat(F.lit("corr-"), eid.cast("string")).alias("correlationId"),
        F.lit("tidepool").alias("originatingApp"),
    )
    doc = F.struct(
        eid.cast("string").alias("id"),
        time_txt.alias("time"),
        F.lit("DataAccess").alias("category"),
        F.concat(F.lit("Access."), et).alias("type"),
        F.lit("1.0").alias("schemaVersion"),
        F.concat(F.lit("/workspaces/ws-"), F.pmod(uid, F.lit(10)).cast("string")).alias("resourceId"),
        data.alias("data"),
    )
    return doc


def diagnostic_records(events: DataFrame, damaged: bool = False) -> DataFrame:
    """One diagnostic document per event as JSON text (column ``RawJson``)."""
    return events.select(F.to_json(_doc_struct(damaged)).alias("RawJson"))


def diagnostic_docs(events: DataFrame, damaged: bool = False) -> DataFrame:
    """The same documents as nested columns, ready for ``write.json``."""
    return events.select(_doc_struct(damaged).alias("d")).select("d.*")


#: Documents of a compressed file at most (it is read by one task), and files of a micro-batch: some 4 GB of text.
DELIVERED_DOCS = 50_000
DELIVERED_FILES = 100


def deliver(docs: DataFrame, folder: str) -> None:
    """Documents as gzipped JSON lines, as logs are delivered: a tenth of their text."""
    docs.write.option("compression", "gzip").option("maxRecordsPerFile", DELIVERED_DOCS).json(folder)


# DuckDB twin of the flattened (typed) diagnostic table, straight from events.
# Columns in the order of ACCESS_LOG_COLUMNS without IngestedTimeUtc/RawJson.
def diagnostic_flat_sql(damaged: bool = False, duration_precision: str = "milli") -> str:
    b = "(event_id % 7)"
    end = "make_timestamp(epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT))"
    start_ok = "ts"
    if damaged:
        start = f"CASE WHEN {b} IN (1, 2) THEN NULL ELSE ts END"
        is_short = f"CASE WHEN {b} = 3 THEN NULL ELSE value > 250 END"
        status = f"CASE WHEN {b} = 4 THEN NULL WHEN event_type = 'error' THEN 500 ELSE 200 END"
        dur_explicit = (f"CASE WHEN {b} = 5 THEN NULL WHEN event_type IN ('click', 'view') "
                        "THEN CAST(round(value * 1000) AS BIGINT) END")
    else:
        start = start_ok
        is_short = "value > 250"
        status = "CASE WHEN event_type = 'error' THEN 500 ELSE 200 END"
        dur_explicit = "CASE WHEN event_type IN ('click', 'view') THEN CAST(round(value * 1000) AS BIGINT) END"
    if duration_precision == "milli":
        # unix_millis floors to the millisecond (DuckDB's epoch_ms rounds)
        fallback = f"epoch_us({end}) // 1000 - epoch_us({start}) // 1000"
    else:
        fallback = f"(epoch_us({end}) // 1000000 - epoch_us({start}) // 1000000) * 1000"
    return f"""
SELECT CAST(event_id AS VARCHAR) AS EventId,
       {start} AS EventTimeUtc,
       'DataAccess' AS Category,
       'Access.' || event_type AS EventType,
       '1.0' AS SchemaVersion,
       '/workspaces/ws-' || CAST(user_id % 10 AS VARCHAR) AS ResourceId,
       'tenant-0' AS TenantId,
       'cap-' || CAST(user_id % 3 AS VARCHAR) AS CapacityId,
       'ws-' || CAST(user_id % 10 AS VARCHAR) AS WorkspaceId,
       'Workspace ' || CAST(user_id % 10 AS VARCHAR) AS WorkspaceName,
       'item-' || CAST(user_id AS VARCHAR) AS ItemId,
       upper(event_type) AS ItemType,
       'dir-' || CAST(user_id % 5 AS VARCHAR) AS DirectoryId,
       'Tables/t' || CAST(event_id % 20 AS VARCHAR) AS Resource,
       CASE WHEN event_id % 2 = 0 THEN 'dfs' ELSE 'blob' END AS ServiceEndpoint,
       {is_short} AS IsShortcut,
       CASE WHEN event_type IN ('purchase', 'signup') THEN 'Write' ELSE 'Read' END AS OperationCategory,
       event_type AS OperationName,
       {start} AS AccessStartTime,
       {end} AS AccessEndTime,
       coalesce({dur_explicit}, {fallback}) AS DurationMs,
       'p-' || CAST(user_id AS VARCHAR) AS ExecutingPrincipalId,
       'User' AS ExecutingPrincipalType,
       'user' || CAST(user_id AS VARCHAR) || '@example.com' AS PrincipalUpn,
       'OAuth' AS AuthType,
       '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) AS CallerIpAddress,
       CAST({status} AS INTEGER) AS HttpStatusCode,
       'corr-' || CAST(event_id AS VARCHAR) AS CorrelationId,
       'tidepool' AS OriginatingApp
FROM events
"""


def diagnostic_records_from_tables(spark: SparkSession, sf_dir: str, damaged: bool = False) -> DataFrame:
    ev = tables.load(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return diagnostic_records(ev, damaged)


# ---------------------------------------------------------------------------
# Churn-shaped customers (the reference's churn.csv columns) from customer and
# that customer's orders.  Invented but fixed mapping: a customer whose last
# order is before 2000-09-01 has "exited"; one active after 2001-01-01 is an
# active member.  Customers without orders get nulls (dropped by cleaning).
# ---------------------------------------------------------------------------
CHURN_EXIT_BEFORE = "2000-09-01 00:00:00"
CHURN_ACTIVE_FROM = "2001-01-01 00:00:00"

CHURN_SQL = f"""
SELECT CAST(c.c_custkey + 1 AS BIGINT) AS RowNumber,
       c.c_custkey AS CustomerId,
       c.c_name AS Surname,
       CAST(300 + 20 * c.c_nationkey + 10 * least(o.n_orders, 20) AS INTEGER) AS CreditScore,
       c.c_mktsegment AS Geography,
       CASE WHEN c.c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS Gender,
       CAST(18 + floor(date_diff('day', o.first_d, o.last_d) / 60) AS INTEGER) AS Age,
       CAST(o.n_years - 1 AS INTEGER) AS Tenure,
       c.c_acctbal AS Balance,
       CAST(least(o.n_urgent + 1, 4) AS INTEGER) AS NumOfProducts,
       CAST(c.c_acctbal > 0 AS INTEGER) AS HasCrCard,
       CAST(o.last_d >= TIMESTAMP '{CHURN_ACTIVE_FROM}' AS INTEGER) AS IsActiveMember,
       o.total / 10 AS EstimatedSalary,
       CAST(o.last_d < TIMESTAMP '{CHURN_EXIT_BEFORE}' AS INTEGER) AS Exited
FROM customer c LEFT JOIN (
  SELECT o_custkey, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
         min(o_orderdate) AS first_d,
         max(o_orderdate) AS last_d, count(DISTINCT year(o_orderdate)) AS n_years,
         sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS n_urgent
  FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
"""


def churn_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tables.load(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    o = tables.load(spark, sf_dir, "orders", ["o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"])
    per = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        # exact decimal sum: the same double whatever the summation order
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
        F.min("o_orderdate").alias("first_d"), F.max("o_orderdate").alias("last_d"),
        F.count_distinct(F.year("o_orderdate")).alias("n_years"),
        F.sum((F.col("o_orderpriority") == "1-URGENT").cast("int")).alias("n_urgent"))
    j = c.join(per, c.c_custkey == per.o_custkey, "left")
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    return j.select(
        (F.col("c_custkey") + 1).cast("bigint").alias("RowNumber"),
        F.col("c_custkey").alias("CustomerId"),
        F.col("c_name").alias("Surname"),
        (300 + 20 * F.col("c_nationkey") + 10 * F.least("n_orders", F.lit(20))).cast("int").alias("CreditScore"),
        F.col("c_mktsegment").alias("Geography"),
        F.when(F.pmod("c_custkey", F.lit(2)) == 0, "Female").otherwise("Male").alias("Gender"),
        (18 + F.floor(F.datediff("last_d", "first_d") / 60)).cast("int").alias("Age"),
        (F.col("n_years") - 1).cast("int").alias("Tenure"),
        F.col("c_acctbal").alias("Balance"),
        F.least(F.col("n_urgent") + 1, F.lit(4)).cast("int").alias("NumOfProducts"),
        (F.col("c_acctbal") > 0).cast("int").alias("HasCrCard"),
        (F.col("last_d") >= ts(CHURN_ACTIVE_FROM)).cast("int").alias("IsActiveMember"),
        (F.col("total") / 10).alias("EstimatedSalary"),
        (F.col("last_d") < ts(CHURN_EXIT_BEFORE)).cast("int").alias("Exited"),
    )
