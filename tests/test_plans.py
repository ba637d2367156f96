"""Plan inspection: pruning, pushdown, no cartesian or nested-loop joins."""
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

HEADLINE = ["q_features_all", "q_features_keyed", "q_anomaly_type", "q_anomaly_records",
            "q_confidence", "q_upsert_snapshot", "q_catchup", "q_category_share"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", HEADLINE)
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_feature_scan_is_pruned(spark):
    from riskspark.operators.features import system_features
    from riskspark.plans.common import logs
    system, _ = logs(spark, SF_SMALL)
    plan = _plan(system_features(system, "5 minutes"))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_table_scan_prunes_partitions(spark, scratch):
    from riskspark.plans.ml_queries import land_tables
    from riskspark.sources import tables as TB
    land_tables(spark, SF_SMALL, scratch)
    st = spark.read.parquet(f"{scratch}/system_logs")
    plan = _plan(TB.scan_since(st, "2024-01-29 00:00:00", TB.SYSTEM_SCAN_COLS))
    assert "PartitionFilters: [isnotnull(dt" in plan and "GreaterThanOrEqual(timestamp" in plan
