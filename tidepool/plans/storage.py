"""Source and sink queries: CSV scan, catalog table create/append/scan,
schema-replacing overwrite, simple casts (SRC1, SRC2, SRC6, SNK1-SNK4,
SNK8, SNK9, PRJ3, FN9, FN10)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tidepool.functions import jsonlog
from tidepool.plans.registry import query
from tidepool.session import scratch_path, stored
from tidepool.sinks import tables as sinks
from tidepool.sources import derived, files, tables
from tidepool.streaming import ingest

_CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("csv_scan", "SRC1,SRC2", sql="SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan(spark, sf_dir):
    """Customer written as header CSV by Spark, read back with a fixed schema and cached for its two uses; the cache is released."""
    path = scratch_path(spark, "csv")
    tables.load(spark, sf_dir, "customer").write.option("header", True).csv(path)
    with tables.cached(tables.read_csv(spark, path, _CUSTOMER_SCHEMA)) as df:
        if df.count() == 0:  # reused below
            raise ValueError("no rows")
        return stored(df, "csv-rows")


# Lines of customer.csv: every 11th has text for its balance, every 13th lacks its last field, every 17th has one too many.
_LINE_SQL = """
SELECT c_custkey, concat_ws(',', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), CASE WHEN c_custkey % 11 = 0 THEN 'n/a' ELSE '12.5' END)
       || CASE WHEN c_custkey % 13 = 0 THEN '' WHEN c_custkey % 17 = 0 THEN ',' || c_mktsegment || ',extra' ELSE ',' || c_mktsegment END AS line FROM customer
"""


def _damaged_csv(spark, sf_dir):
    c, key = tables.load(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]), F.col("c_custkey")
    head = F.concat_ws(",", key.cast("string"), "c_name", F.col("c_nationkey").cast("string"), F.when(key % 11 == 0, "n/a").otherwise("12.5"))
    tail = F.when(key % 13 == 0, "").when(key % 17 == 0, F.concat(F.lit(","), "c_mktsegment", F.lit(",extra"))).otherwise(F.concat(F.lit(","), "c_mktsegment"))
    path = scratch_path(spark, "damaged-csv")
    c.select(F.concat(head, tail).alias("value")).write.text(path)
    return path


@query("csv_quarantine", "SRC1", sql=f"""
WITH l AS ({_LINE_SQL}), bad AS (SELECT *, c_custkey % 11 = 0 OR c_custkey % 13 = 0 OR c_custkey % 17 = 0 AS damaged FROM l)
SELECT CASE WHEN NOT damaged THEN c.c_custkey END AS c_custkey, CASE WHEN NOT damaged THEN c_name END AS c_name, CASE WHEN NOT damaged THEN 12.5::DOUBLE END AS balance,
       CASE WHEN NOT damaged THEN c_mktsegment END AS c_mktsegment, CASE WHEN damaged THEN line END AS quarantined
FROM bad JOIN customer c ON c.c_custkey = bad.c_custkey
""")
def csv_quarantine(spark, sf_dir):
    """A CSV with damaged lines: good rows typed, damaged lines whole in a quarantine table, none in both."""
    good, damaged = tables.read_csv_checked(spark, _damaged_csv(spark, sf_dir), "c_custkey bigint, c_name string, c_nationkey int, balance double, c_mktsegment string", header=False)
    quarantine = scratch_path(spark, "quarantine")
    sinks.append_path(damaged, quarantine)
    kept = spark.read.parquet(quarantine)
    none = F.lit(None)
    return good.select("c_custkey", "c_name", "balance", "c_mktsegment", none.cast("string").alias("quarantined")).unionByName(kept.select(
        none.cast("bigint").alias("c_custkey"), none.cast("string").alias("c_name"), none.cast("double").alias("balance"), none.cast("string").alias("c_mktsegment"),
        F.col(tables.DAMAGED).alias("quarantined")))


@query("csv_schema_check", "SRC1", sql="""
SELECT * FROM (VALUES ('c_custkey', 'bigint', 'int', 'narrower'), ('c_name', 'string', 'string', 'same'), ('c_acctbal', 'int', 'double', 'wider'),
                      ('c_phone', 'string', NULL, 'missing'), ('c_mktsegment', NULL, 'string', 'unknown')) t("column", stated, inferred, verdict)
WHERE EXISTS (SELECT 1 FROM customer)
""")
def csv_schema_check(spark, sf_dir):
    """Inference over the whole CSV against a stated schema that is off in four ways."""
    path = scratch_path(spark, "csv-check")
    tables.load(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]).write.option("header", True).csv(path)
    return tables.csv_schema_check(spark, path, "c_custkey bigint, c_name string, c_acctbal int, c_phone string")


@query("catalog_table_append", "SNK1,SNK2,SNK8,SRC6,PRJ3,D1", sql=f"""
SELECT EventId, EventTimeUtc, EventType, DurationMs, HttpStatusCode
FROM ({derived.diagnostic_flat_sql()})
""")
def catalog_table_append(spark, sf_dir):
    """Bootstrap the six tables (CREATE TABLE IF NOT EXISTS, twice: idempotent), checked append to the access log, SQL scan."""
    base = scratch_path(spark, "lake")
    prefix = f"t{uuid.uuid4().hex[:8]}_"
    sinks.bootstrap_tables(spark, base, prefix)
    names = sinks.bootstrap_tables(spark, base, prefix)
    name = f"{prefix}log_event_access"
    flat = jsonlog.flatten_access_log(derived.diagnostic_records_from_tables(spark, sf_dir))
    sinks.append_table(ingest.as_generation(flat, "derived-0"), name)
    out = stored(spark.sql(f"SELECT EventId, EventTimeUtc, EventType, DurationMs, HttpStatusCode FROM {name}"), "scan")
    sinks.drop_tables(spark, names)
    return out


@query("access_log_filled_by_stream", "SNK1,STR1,STR2,SNK6,SRC6", sql="""
SELECT CAST(ts AS DATE) AS EventDate, count(*) AS events, count(DISTINCT event_id) AS keys FROM events GROUP BY ALL
""")
def access_log_filled_by_stream(spark, sf_dir):
    """The bootstrapped access-log table is what the stream appends to by path: read by SQL after two deliveries, the second replayed."""
    base = scratch_path(spark, "filled")
    prefix = f"f{uuid.uuid4().hex[:8]}_"
    names = sinks.bootstrap_tables(spark, base, prefix)
    target, ck = f"{sinks.layout(base)['silver']}/log_event_access", os.path.join(base, "control", "ck")
    ev = tables.load(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    late = F.col("ts") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    for part, rows in (("first", ev.where(~late)), ("second", ev.where(late)), ("replayed", ev.where(late))):
        derived.deliver(derived.diagnostic_docs(rows), os.path.join(base, "landing", part))
        ingest.normalise_stream(spark, os.path.join(base, "landing"), target, ck, multiline=False, max_files_per_trigger=derived.DELIVERED_FILES, glob=files.GZIP_GLOB)
    sinks.refresh_table(spark, names[0])
    out = stored(spark.sql(f"SELECT EventDate, count(*) AS events, count(DISTINCT EventKey) AS keys FROM {names[0]} GROUP BY EventDate"), "scan")
    sinks.drop_tables(spark, names)
    return out


@query("schema_stamp", "SNK9", sql="""
SELECT 'access-log v2' AS version, CAST(2 AS BIGINT) AS stamps, count(*) AS written_under FROM events
""")
def schema_stamp(spark, sf_dir):
    """Two versions stamped, the last one read back with the rows written under it."""
    control = sinks.layout(scratch_path(spark, "stamp"))["control"]
    sinks.stamp_schema_version(spark, f"{control}/schema_version", "access-log v1")
    sinks.stamp_schema_version(spark, f"{control}/schema_version", "access-log v2")
    written = sinks.append_path(derived.diagnostic_records_from_tables(spark, sf_dir), f"{control}/rows")["rows"]
    return sinks.schema_version(spark, f"{control}/schema_version").select("version", "stamps", F.lit(written).cast("bigint").alias("written_under"))


@query("overwrite_replace_schema", "SNK3,SNK4,SRC5", sql="""
SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice FROM orders
""")
def overwrite_replace_schema(spark, sf_dir):
    """A path table overwritten with a different schema keeps only the new one."""
    path = scratch_path(spark, "df_clean")
    o = tables.load(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    sinks.overwrite_path(o, path)
    sinks.overwrite_path(o.select("o_orderkey", "o_orderstatus",
                                  F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice")), path)
    return tables.read_path_table(spark, path)


@query("trim_lower_cast", "FN9,FN10", sql="""
SELECT c_custkey, trim(c_name) AS name, lower(c_mktsegment) AS segment,
       CAST(CAST(c_nationkey AS VARCHAR) AS INTEGER) AS nationkey_roundtrip,
       CAST(c_nationkey AS VARCHAR) AS nationkey_text
FROM customer
""")
def trim_lower_cast(spark, sf_dir):
    c = tables.load(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment", "c_nationkey"])
    return c.select("c_custkey", F.trim("c_name").alias("name"), F.lower("c_mktsegment").alias("segment"),
                    F.col("c_nationkey").cast("string").cast("int").alias("nationkey_roundtrip"),
                    F.col("c_nationkey").cast("string").alias("nationkey_text"))
