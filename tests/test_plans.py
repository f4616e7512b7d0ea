"""Plan shapes that the scale design relies on (checked on the physical plan)."""

from pyspark.sql import functions as F

from tidepool.operators import clean, marts
from tidepool.plans import REGISTRY

from conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns(spark):
    plan = _plan(REGISTRY["report_sum_desc"].fn(spark, SF001))
    assert "ReadSchema: struct<p_partkey:bigint,p_brand:string,p_type:string,p_retailprice:double>" in plan


def test_filter_reaches_parquet(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").where(F.col("l_discount") > 0.05).select("l_orderkey")
    assert "PushedFilters: [IsNotNull(l_discount), GreaterThan(l_discount,0.05)]" in _plan(li)


def test_keep_first_is_limited_before_the_shuffle(spark):
    conv = spark.read.parquet(f"{SF001}/conversations.parquet")
    plan = _plan(clean.keep_first(conv, ["conv_id"], ["turn"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_latest_per_key_is_limited_before_the_shuffle(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    plan = _plan(marts.latest_per_key(ev, ["user_id"], "ts", ["event_id"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_grouped_aggregates_are_partial(spark):
    plan = _plan(REGISTRY["counts_by_target"].fn(spark, SF001))
    assert plan.count("HashAggregate") >= 2  # partial (map side) and final


def test_small_label_side_is_broadcast(spark):
    plan = _plan(REGISTRY["accuracy"].fn(spark, SF001))
    assert "BroadcastHashJoin" in plan
