"""Data-quality rules at their boundaries, rule priority, and tag/filter agreement."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_text, trips_df
from tiertrip.operators import quality as q

T0 = dt.datetime(2024, 3, 4, 10, 0, 0)


def good_row(**kw):
    row = dict(hvfhs_license_num="HV0005", pickup_datetime=T0, dropoff_datetime=T0 + dt.timedelta(minutes=10),
               request_datetime=T0 - dt.timedelta(minutes=3), PULocationID=1, DOLocationID=2, trip_miles=3.0,
               trip_time=600, base_passenger_fare=20.0, tips=1.0, shared_match_flag="N")
    row.update(kw)
    return row


def reasons(spark, rows):
    df = q.tag(trips_df(spark, rows))
    return [r[q.REASON] for r in df.collect()]


@pytest.mark.parametrize("kw,expected", [
    ({}, None),
    ({"trip_miles": 0.0}, "zero_trip_miles"),
    ({"trip_miles": 0.01}, None),
    ({"trip_miles": 199.99}, None),
    ({"trip_miles": 200.0}, "excessive_trip_miles"),
    ({"trip_miles": float("nan")}, "excessive_trip_miles"),  # NaN sorts above every number in Spark
    ({"trip_miles": None}, "zero_trip_miles"),
    ({"base_passenger_fare": 0.0}, "zero_or_negative_fare"),
    ({"base_passenger_fare": 0.01}, None),
    ({"base_passenger_fare": 499.99}, None),
    ({"base_passenger_fare": 500.0}, "excessive_fare"),
    ({"base_passenger_fare": None}, "null_fare"),
    ({"trip_time": 0}, "zero_trip_time"),
    ({"trip_time": 1}, None),
    ({"trip_time": 14399}, None),
    ({"trip_time": 14400}, "excessive_trip_time"),
    ({"trip_time": None}, "zero_trip_time"),
    ({"dropoff_datetime": T0}, "invalid_timestamps"),
    ({"dropoff_datetime": None}, "invalid_timestamps"),
    ({"pickup_datetime": None}, "null_pickup_datetime"),
    ({"PULocationID": None}, "null_pu_location"),
    ({"DOLocationID": None}, "null_do_location"),
])
def test_rule_boundaries(spark, kw, expected):
    assert reasons(spark, [good_row(**kw)]) == [expected]


def test_first_failed_rule_wins(spark):
    assert reasons(spark, [good_row(pickup_datetime=None, base_passenger_fare=None)]) == ["null_pickup_datetime"]
    assert reasons(spark, [good_row(trip_miles=500.0, trip_time=0)]) == ["excessive_trip_miles"]


def test_rule_order_is_fixed():
    assert q.RULE_NAMES == (
        "null_pickup_datetime", "null_pu_location", "null_do_location", "invalid_timestamps", "zero_trip_miles",
        "excessive_trip_miles", "null_fare", "zero_or_negative_fare", "excessive_fare", "zero_trip_time",
        "excessive_trip_time")


def test_tag_null_iff_keep_true(spark, lake):
    """Property over the whole sf0.001 bronze table plus hand-made edge rows."""
    edge = trips_df(spark, [good_row(trip_miles=float("nan")), good_row(dropoff_datetime=None),
                            good_row(trip_miles=None, trip_time=None), good_row()])
    for df in (lake.bronze(), edge):
        both = q.tag(df).withColumn("keep", F.coalesce(q.keep_expr(), F.lit(False)))
        bad = both.filter(F.col(q.REASON).isNull() != F.col("keep")).count()
        assert bad == 0


def test_split_partitions_rows(lake):
    good, rejected = q.split(lake.bronze())
    assert good.count() + rejected.count() == lake.bronze().count()
    assert q.REASON not in good.columns


def test_rule_counts_match_individual_filters(lake):
    counts = {r["rule"]: r["failed_rows"] for r in q.rule_counts(lake.bronze()).collect()}
    for rule in q.RULES:
        assert counts[rule.name] == lake.bronze().filter(rule.fails(q.DEFAULT_THRESHOLDS)).count()


def test_keep_is_pushed_to_parquet(lake):
    plan = plan_text(q.keep(lake.bronze()))
    assert "PushedFilters" in plan and "GreaterThan(trip_miles,0.0)" in plan
