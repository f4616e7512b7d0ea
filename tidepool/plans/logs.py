"""Access-log queries: JSON extraction, the typed flatten, rebuild, durations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.functions import drift, jsonlog
from tidepool.plans.registry import query
from tidepool.sources import derived, tables

_FLAT_COLS = [n for n, p, _ in jsonlog.ACCESS_LOG_COLUMNS if p is not None]


@query("json_extract_props", "FN1", sql="""
SELECT event_id,
       json_extract_string(props, '$.k') AS k_text,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events
""")
def json_extract_props(spark, sf_dir):
    ev = tables.load(spark, sf_dir, "events", ["event_id", "props"])
    k = F.get_json_object("props", "$.k")
    return ev.select("event_id", k.alias("k_text"), k.try_cast("int").alias("k"))


@query("json_typed_flatten", "PRJ1,FN3,FN4,FN5,FN6,FN7", sql=derived.diagnostic_flat_sql())
def json_typed_flatten(spark, sf_dir):
    raw = derived.diagnostic_records_from_tables(spark, sf_dir)
    return jsonlog.flatten_access_log(raw).select(*_FLAT_COLS)


@query("json_path_extract", "FN1,FN3,PRJ1", sql=f"""
SELECT EventId, EventTimeUtc, ItemId, CAST(HttpStatusCode AS VARCHAR) AS status, CorrelationId FROM ({derived.diagnostic_flat_sql()})
""")
def json_path_extract(spark, sf_dir):
    """A few values by path, the time typed."""
    raw = derived.diagnostic_records_from_tables(spark, sf_dir)
    few = jsonlog.extract(raw, {"EventId": "$.id", "EventTimeUtc": "$.time", "ItemId": "$.data.itemId",
                                "status": "$.data.httpStatusCode", "CorrelationId": "$.data.correlationId"})
    return few.withColumn("EventTimeUtc", F.try_to_timestamp("EventTimeUtc"))


@query("duration_seconds_form", "FN5,FN6", sql=f"""
SELECT EventId, DurationMs FROM ({derived.diagnostic_flat_sql(duration_precision='second')})
""")
def duration_seconds_form(spark, sf_dir):
    raw = derived.diagnostic_records_from_tables(spark, sf_dir)
    return jsonlog.flatten_access_log(raw, duration_precision="second").select("EventId", "DurationMs")


@query("duration_ms", "FN5,FN6", sql=f"""
SELECT EventId, DurationMs FROM ({derived.diagnostic_flat_sql()})
""")
def duration_ms(spark, sf_dir):
    raw = derived.diagnostic_records_from_tables(spark, sf_dir)
    return jsonlog.flatten_access_log(raw).select("EventId", "DurationMs")


@query("malformed_to_null", "FN3,FN4,FN12,D8", sql=derived.diagnostic_flat_sql(damaged=True))
def malformed_to_null(spark, sf_dir):
    raw = derived.diagnostic_records_from_tables(spark, sf_dir, damaged=True)
    return jsonlog.flatten_access_log(raw).select(*_FLAT_COLS)


@query("json_rebuild", "FN2,D6", sql="""
SELECT event_id, ts, user_id, event_type, value, props FROM events
""")
def json_rebuild(spark, sf_dir):
    """Rebuild RawJson from every column, then parse it back: values survive."""
    ev = tables.load(spark, sf_dir, "events")
    rebuilt = jsonlog.rebuild_raw_json(ev).select("RawJson")
    parsed = F.from_json("RawJson", ev.schema, {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    return rebuilt.select(parsed.alias("r")).select("r.*")


@query("path_basename", "FN8,FLT3", sql="""
SELECT page_id,
       string_split(url, '/')[-1] AS base_name,
       lower(url) LIKE '%.html' AS is_html
FROM pages
""")
def path_basename(spark, sf_dir):
    pages = tables.load(spark, sf_dir, "pages", ["page_id", "url"])
    return pages.select("page_id", jsonlog.basename(F.col("url")).alias("base_name"),
                        jsonlog.has_suffix_ci(F.col("url"), ".html").alias("is_html"))


# Documents with fields that the schema doesn't name: a nested object, a number in data that is sometimes text, and a declared scalar that became an object.
def _drifted(spark, sf_dir):
    ev = tables.load(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    doc = derived.diagnostic_docs(ev).withColumn("n", F.col("id").cast("bigint"))
    retry = F.when(F.col("n") % 4 == 0, F.concat(F.lit("n"), F.col("n").cast("string"))).otherwise((F.col("n") % 5).cast("string"))
    data = F.to_json("data")
    # The documents' text is put together from JSON parts, so that one field can be a number here and text there.
    number = F.when(F.col("n") % 4 == 0, F.concat(F.lit('"'), retry, F.lit('"'))).otherwise(retry)
    data = F.when(F.col("n") % 2 == 0, F.concat(F.expr("left(to_json(data), length(to_json(data)) - 1)"), F.lit(',"retryCount":'), number, F.lit("}"))).otherwise(data)
    data = F.when(F.col("n") % 10 == 9, F.regexp_replace(data, '"workspaceName":"([^"]*)"', '"workspaceName":{"label":"$1"}')).otherwise(data)
    region = F.when(F.col("n") % 3 == 0, F.concat(F.lit(',"region":{"code":'), (F.col("n") % 4).cast("string"), F.lit("}"))).otherwise(F.lit(""))
    head = F.to_json(F.struct("id", "time", "category", "type", "schemaVersion", "resourceId"))
    text = F.concat(F.expr("left(to_json(struct(id, time, category, type, schemaVersion, resourceId)), length(to_json(struct(id, time, category, type, schemaVersion, resourceId))) - 1)"),
                    region, F.lit(',"data":'), data, F.lit("}"))
    return doc.select(F.when(F.col("n") % 101 == 100, F.concat(F.lit("{broken "), head)).otherwise(text).alias("RawJson"), F.col("n").alias("event_id"))


@query("json_drift_report", "PRJ1,FN1", sql="""
WITH e AS (SELECT * FROM events WHERE event_id % 101 <> 100)
SELECT 'region' AS path, count(*) AS documents, 'OBJECT<code: BIGINT>' AS merged_type, 1 AS types FROM e WHERE event_id % 3 = 0 HAVING count(*) > 0
UNION ALL SELECT 'data.retryCount', count(*), 'VARIANT', 2 FROM e WHERE event_id % 2 = 0 HAVING count(*) > 0
""")
def json_drift_report(spark, sf_dir):
    """Fields off the declared paths, with the type that holds all their values; damaged documents have none."""
    return drift.drift_report(_drifted(spark, sf_dir)).withColumn("types", F.col("types").cast("int"))


@query("json_unknown_values", "PRJ1,FN1,FN3", sql="""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 4 AS INTEGER) END AS region_code,
       CASE WHEN event_id % 2 = 0 AND event_id % 4 <> 0 THEN CAST(event_id % 5 AS INTEGER) END AS retries,
       CASE WHEN event_id % 10 = 9 THEN 'Workspace ' || CAST(user_id % 10 AS VARCHAR) END AS moved_label
FROM events WHERE event_id % 101 <> 100
""")
def json_unknown_values(spark, sf_dir):
    """Undeclared fields by path and type; what doesn't convert is null."""
    doc = F.col("Document")
    return drift.parsed(_drifted(spark, sf_dir)).where(doc.isNotNull()).select(
        "event_id", drift.value_at(doc, "$.region.code", "int").alias("region_code"), drift.value_at(doc, "$.data.retryCount", "int").alias("retries"),
        drift.value_at(doc, "$.data.workspaceName.label", "string").alias("moved_label"))


@query("json_misplaced_fields", "PRJ1", sql="""
SELECT 'data.workspaceName' AS path, count(*) AS documents FROM events WHERE event_id % 10 = 9 AND event_id % 101 <> 100 HAVING count(*) > 0
""")
def json_misplaced_fields(spark, sf_dir):
    """Declared scalars that hold an object."""
    return drift.misplaced(_drifted(spark, sf_dir))
