"""Derived columns: weekend edges, waits, flags, speed from the rounded duration."""

import datetime as dt

from tests.conftest import trips_df
from tiertrip.operators import derive as dv


def derived(spark, **kw):
    base = dict(pickup_datetime=dt.datetime(2024, 3, 4, 10, 0, 0), request_datetime=dt.datetime(2024, 3, 4, 9, 57, 0),
                trip_miles=3.0, trip_time=600, shared_match_flag="N")
    base.update(kw)
    return dv.derive(trips_df(spark, [base])).first()


def test_weekend_edges(spark):
    sat = derived(spark, pickup_datetime=dt.datetime(2024, 3, 2, 23, 59, 59))
    sun = derived(spark, pickup_datetime=dt.datetime(2024, 3, 3, 0, 0, 0))
    mon = derived(spark, pickup_datetime=dt.datetime(2024, 3, 4, 0, 0, 0))
    assert (sat.pickup_day_of_week, sat.is_weekend, sat.pickup_hour) == (7, 1, 23)
    assert (sun.pickup_day_of_week, sun.is_weekend, sun.pickup_hour) == (1, 1, 0)
    assert (mon.pickup_day_of_week, mon.is_weekend) == (2, 0)
    assert sat.pickup_date == dt.date(2024, 3, 2)


def test_wait_negative_and_null(spark):
    assert derived(spark).wait_time_minutes == 3.0
    later = derived(spark, request_datetime=dt.datetime(2024, 3, 4, 10, 1, 30))
    assert later.wait_time_minutes == -1.5
    assert derived(spark, request_datetime=None).wait_time_minutes is None


def test_shared_flag(spark):
    assert derived(spark, shared_match_flag="Y").is_shared_ride == 1
    assert derived(spark, shared_match_flag="N").is_shared_ride == 0
    assert derived(spark, shared_match_flag=None).is_shared_ride == 0


def test_speed_uses_rounded_duration(spark):
    # 61 s -> 1.02 min (rounded); speed = 1 / (1.02 / 60) = 58.82, not 1 / (61 / 3600) = 59.02
    r = derived(spark, trip_time=61, trip_miles=1.0)
    assert r.trip_duration_minutes == 1.02
    assert r.speed_mph == 58.82


def test_speed_null_for_zero_duration(spark):
    r = derived(spark, trip_time=0)
    assert r.trip_duration_minutes == 0.0 and r.speed_mph is None


def test_speed_filter_bounds(spark):
    rows = [dict(pickup_datetime=dt.datetime(2024, 3, 4), trip_miles=m, trip_time=t) for m, t in
            [(1.0, 59), (1.0, 60), (1.0, 14400), (1.0, 14401), (100.0, 3600), (80.0, 3600), (None, 600)]]
    kept = dv.speed_filter(dv.derive(trips_df(spark, rows))).select("trip_miles", "trip_time").collect()
    assert sorted((r.trip_miles or -1, r.trip_time) for r in kept) == [(-1, 600), (1.0, 60), (1.0, 14400), (80.0, 3600)]


def test_results_do_not_depend_on_session_time_zone(spark, lake):
    """Wall-clock (TIMESTAMP_NTZ) arithmetic: the same rows under UTC and a zone with DST."""
    from tiertrip.operators import reports as rp
    prev = spark.conf.get("spark.sql.session.timeZone")
    frames = lambda: [lake.derived(), rp.monthly_dq(lake.tagged()), lake.hourly(sort=False)]
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        utc = [sorted(map(tuple, f.collect()), key=str) for f in frames()]
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        ny = [sorted(map(tuple, f.collect()), key=str) for f in frames()]
        # a wait across the spring-forward hour is still the wall-clock difference
        r = derived(spark, request_datetime=dt.datetime(2024, 3, 10, 1, 50),
                    pickup_datetime=dt.datetime(2024, 3, 10, 3, 10))
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert utc == ny
    assert r.wait_time_minutes == 80.0
