"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [name ...]

Comparison: same column names (sorted), same row count, same multiset of rows.
Rows are compared exactly and, separately, with floats rounded to 6 digits so
that last-bit summation noise is told apart from real differences.
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidepool.session import build_session  # noqa: E402
from tidepool.sources.tables import DRIVER_TABLES, table_path  # noqa: E402


def _canon(v, digits=None):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits) if digits is not None else v
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _canon(v.item(), digits)
        except (ValueError, AttributeError):
            pass
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if isinstance(v, datetime.datetime) and v.tzinfo is not None:
        return v.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_canon(x, digits) for x in v)
    if hasattr(v, "tolist"):
        return tuple(_canon(x, digits) for x in v.tolist())
    return v


def _rows(tbl, digits=None):
    cols = sorted(tbl.column_names)
    data = tbl.select(cols).to_pylist()
    out = [tuple(_canon(r[c], digits) for c in cols) for r in data]
    return cols, sorted(out, key=repr)


def _tname(t) -> str:
    """Arrow type name with timestamp unit/zone and string flavours folded."""
    import pyarrow as pa

    if pa.types.is_timestamp(t):
        return "timestamp"
    if pa.types.is_large_string(t) or pa.types.is_string(t):
        return "string"
    if pa.types.is_large_list(t) or pa.types.is_list(t):
        return f"list<{_tname(t.value_type)}>"
    return str(t)


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def compare(spark, con, name, q, sf_dir):
    t0 = time.time()
    sdf = q.fn(spark, sf_dir)
    spdf = sdf.toArrow()
    ts = time.time() - t0
    if q.sql is None:
        return {"name": name, "status": "rows-only", "rows": spdf.num_rows, "sec": round(ts, 2)}
    opdf = con.sql(q.sql).arrow()
    if hasattr(opdf, "read_all"):
        opdf = opdf.read_all()
    res = {"name": name, "rows_spark": spdf.num_rows, "rows_oracle": opdf.num_rows, "sec": round(ts, 2)}
    sc, sr = _rows(spdf)
    oc, orows = _rows(opdf)
    if sc != oc:
        res["status"] = f"COLUMNS spark={sc} oracle={oc}"
        return res
    if len(sr) != len(orows):
        res["status"] = "ROWCOUNT"
        return res
    st = {f.name: _tname(f.type) for f in spdf.schema}
    ot = {f.name: _tname(f.type) for f in opdf.schema}
    if st != ot:
        res["types"] = {c: (st[c], ot[c]) for c in st if st[c] != ot.get(c)}
    if sr == orows:
        res["status"] = "exact"
        return res
    _, sr6 = _rows(spdf, 6)
    _, or6 = _rows(opdf, 6)
    if sr6 == or6:
        res["status"] = "approx6"
        return res
    diff = [(a, b) for a, b in zip(sr6, or6) if a != b][:3]
    res["status"] = "VALUES"
    res["diff"] = diff
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/") and not a.startswith("--")]
    from tidepool.plans import REGISTRY
    if "--plain" in argv:  # a session with Spark's defaults only, like an outside caller's
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    else:
        spark = build_session("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false"})
    if "--ansi-off" in argv:
        spark.conf.set("spark.sql.ansi.enabled", "false")
    if "--aqe-off" in argv:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connection(sf_dir)
    bad = 0
    items = list(REGISTRY.items())
    if "--reverse" in argv:  # catch order dependencies between queries in one session
        items.reverse()
    for name, q in items:
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, q, sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("exact", "approx6", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
