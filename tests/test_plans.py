"""Plan shapes that matter at scale."""

import re

import __spark_entry__ as E
import pytest
from conftest import SF_SMALL


def final_plan(spark, key):
    return E.queries()[key](spark, SF_SMALL)._jdf.queryExecution().toString()


@pytest.mark.parametrize("key", ["refresh_outcomes", "reuse_detection", "family_revoke", "revoked_per_family"])
def test_refresh_history_is_a_small_plan(spark, key):
    """The per-token states are stored; what is left is one join of the log at most."""
    plan = final_plan(spark, key).split("== Physical Plan ==")[1]
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 5
    assert len(re.findall(r"FileScan parquet", plan)) <= 1


def test_a_hot_token_is_cut_before_the_exchange(spark):
    """The ranked limit of the first events runs on both sides of the exchange."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(1000).select((F.col("id") % 3).alias("token"), "id")
    r = df.withColumn("rn", F.row_number().over(Window.partitionBy("token").orderBy("id"))).where("rn <= 2")
    assert r._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


@pytest.mark.parametrize("key", ["route_requests", "trigram_search", "top_n_per_query", "attribute_filter", "gate_entry"])
def test_no_nested_loops_over_data(spark, key):
    assert "NestedLoop" not in final_plan(spark, key) and "Cartesian" not in final_plan(spark, key)
