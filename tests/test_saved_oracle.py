"""Saved queries (DataFrame vs SQL text) and every registered query against its DuckDB oracle."""

import os

import duckdb
import pytest
from pyspark.sql import types as T

import __spark_entry__ as E
from scripts.oracle_check import digest
from tests.conftest import SF001
from tiertrip.plans import registry, saved
from tiertrip.plans.registry import BOROUGH, SPECIAL_ZONES


def test_saved_sql_matches_dataframe(spark, lake):
    daily, hourly, routes = lake.daily(sort=False), lake.hourly(sort=False), lake.routes(sort=False)
    saved.register_views(spark, daily, hourly, routes)
    sql = saved.run_sql(spark, BOROUGH, SPECIAL_ZONES)
    frames = {
        "q1": saved.q1_daily_revenue(daily), "q2": saved.q2_rush_hour(hourly, BOROUGH), "q3": saved.q3_tipping(hourly),
        "q4": saved.q4_top_routes(routes), "q5": saved.q5_special_zone_routes(routes, SPECIAL_ZONES),
        "q6": saved.q6_monthly_revenue(daily), "q7": saved.q7_wait(hourly),
    }
    for k, df in frames.items():
        assert df.collect() == sql[k].collect(), k


DUCK_TYPE = {T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.DoubleType: "DOUBLE", T.StringType: "VARCHAR",
             T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP", T.BooleanType: "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("lineitem", "nation", "region"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF001, t + '.parquet')}')")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_against_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(rows) >= 1
        return
    rel = duck.sql(sql)
    cols = rel.columns
    spark_types = {f.name: DUCK_TYPE.get(type(f.dataType), str(f.dataType)) for f in df.schema.fields}
    assert spark_types == dict(zip(cols, map(str, rel.types)))
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(cols, drows)[0]


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["pickup_date", "pickup_borough"]
