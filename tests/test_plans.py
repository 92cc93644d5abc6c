"""Plan checks over every registered query, and a property test of the rule list."""

import datetime as dt
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF001, plan_text, trips_df
from tiertrip.operators import quality as q
from tiertrip.plans import registry

WRITES = {"roundtrip_curated", "land_months", "ingest_manifest", "validate_gold", "stream_land_months",
          "dq_job_summary"}


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - WRITES))
def test_no_python_and_pruned_scans(spark, name):
    plan = plan_text(registry.QUERIES[name](spark, SF001))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|FlatMapGroupsInPandas|MapInPandas", plan)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # every parquet scan names the columns it reads
    for scan in re.findall(r"\(\d+\) Scan parquet.*?ReadSchema: (struct<[^\n]*>)", plan, re.S):
        assert scan.count(":") <= 23


def test_gold_scan_reads_only_needed_columns(spark, lake):
    plan = plan_text(lake.daily())
    schema = re.search(r"ReadSchema: (struct<[^\n]*>)", plan).group(1)
    assert "dispatching_base_num" not in schema and "wav_match_flag" not in schema


T0 = dt.datetime(2024, 1, 1, 12, 0, 0)
maybe = lambda s: st.one_of(st.none(), s)
row = st.fixed_dictionaries({
    "pickup_datetime": maybe(st.just(T0)),
    "dropoff_datetime": maybe(st.sampled_from([T0 - dt.timedelta(seconds=1), T0, T0 + dt.timedelta(seconds=1)])),
    "PULocationID": maybe(st.integers(0, 300)),
    "DOLocationID": maybe(st.integers(0, 300)),
    "trip_miles": maybe(st.sampled_from([-1.0, 0.0, 0.01, 199.99, 200.0, 1e9, float("nan")])),
    "base_passenger_fare": maybe(st.sampled_from([-5.0, 0.0, 0.01, 499.99, 500.0, float("nan")])),
    "trip_time": maybe(st.sampled_from([-1, 0, 1, 14399, 14400, 10 ** 9])),
})


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=30))
def test_tag_and_filter_agree(spark, rows):
    df = q.tag(trips_df(spark, rows)).withColumn("keep", F.coalesce(q.keep_expr(), F.lit(False)))
    got = df.select(F.col(q.REASON).isNull().alias("good"), "keep").collect()
    assert all(r.good == r.keep for r in got)
