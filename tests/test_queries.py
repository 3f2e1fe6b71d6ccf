"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, duck

CHECKED = sorted(oracle_sql())
UNCHECKED = sorted(set(queries()) - set(CHECKED))


@pytest.fixture(scope="module")
def connection(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", CHECKED)
def test_equals_sql(spark, sf_small, connection, name):
    frame = queries()[name](spark, sf_small)
    assert compare(frame, [tuple(row) for row in frame.collect()], connection, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", UNCHECKED)
def test_has_rows(spark, sf_small, name):
    assert queries()[name](spark, sf_small).count() > 0


@pytest.mark.parametrize("name", ["f_rolling_24h", "a_daily_summary", "m_extract_24h", "m_extract_range"])
def test_time_bounds_reach_the_scan(spark, sf_small, name):
    plan = queries()[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-" in plan
    assert "props" not in plan and "event_type" not in plan


def test_no_query_uses_a_cross_join(spark, sf_small):
    for name in ("a_daily_summary", "j_readings_anomalies", "g_retrain_needed", "m_promotion_decision"):
        plan = queries()[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_checks_belong_to_queries():
    assert set(CHECKED) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 13


def test_forest_checks_fail_on_other_scores(spark, sf_small, connection):
    """The SQL of the forest is no formality: scores that only look like scores differ from it."""
    frame = queries()["m_forest_score"](spark, sf_small).withColumn("score", F.round(F.xxhash64("row_id") / 2.0**64 + 0.5, 9))
    assert "rows differ" in compare(frame, [tuple(row) for row in frame.collect()], connection, oracle_sql()["m_forest_score"])
    nodes = queries()["m_forest_fit"](spark, sf_small).withColumn("threshold", F.col("threshold") * 1.000001)
    assert "rows differ" in compare(nodes, [tuple(row) for row in nodes.collect()], connection, oracle_sql()["m_forest_fit"])
