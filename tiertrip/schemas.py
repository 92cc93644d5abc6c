"""Explicit schemas for every layer; nothing is inferred at run time."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
TS, DT = T.TimestampNTZType(), T.DateType()


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Bronze trips, 23 columns. Ids are read as bigint so months written as int and as bigint both
# load; enrichment casts them to int.
RAW_TRIP = _struct(
    ("hvfhs_license_num", S), ("dispatching_base_num", S), ("originating_base_num", S),
    ("request_datetime", TS), ("pickup_datetime", TS), ("dropoff_datetime", TS),
    ("PULocationID", L), ("DOLocationID", L), ("trip_miles", D), ("trip_time", L),
    ("base_passenger_fare", D), ("tolls", D), ("bcf", D), ("sales_tax", D),
    ("congestion_surcharge", D), ("airport_fee", D), ("tips", D), ("driver_pay", D),
    ("shared_request_flag", S), ("shared_match_flag", S), ("access_a_ride_flag", S),
    ("wav_request_flag", S), ("wav_match_flag", S),
)

# Zone dimension as stored (CSV with header).
ZONE = _struct(("LocationID", I), ("Borough", S), ("Zone", S), ("service_zone", S))

# Silver, 36 columns in the order analysts see them.
CURATED = _struct(
    # time (7)
    ("request_datetime", TS), ("pickup_datetime", TS), ("dropoff_datetime", TS), ("pickup_date", DT),
    ("pickup_hour", I), ("pickup_day_of_week", I), ("is_weekend", I),
    # trip (4)
    ("trip_miles", D), ("trip_time", L), ("trip_duration_minutes", D), ("speed_mph", D),
    # sharing and wait (2)
    ("is_shared_ride", I), ("wait_time_minutes", D),
    # pickup location (4)
    ("PULocationID", I), ("pickup_borough", S), ("pickup_zone", S), ("pickup_service_zone", S),
    # dropoff location (4)
    ("DOLocationID", I), ("dropoff_borough", S), ("dropoff_zone", S), ("dropoff_service_zone", S),
    # fare (8)
    ("base_passenger_fare", D), ("tolls", D), ("bcf", D), ("sales_tax", D),
    ("congestion_surcharge", D), ("airport_fee", D), ("tips", D), ("driver_pay", D),
    # metadata (7)
    ("dispatching_base_num", S), ("originating_base_num", S), ("shared_request_flag", S),
    ("shared_match_flag", S), ("access_a_ride_flag", S), ("wav_request_flag", S), ("wav_match_flag", S),
)

DAILY = _struct(
    ("pickup_date", DT), ("pickup_borough", S), ("total_trips", L), ("total_revenue", D),
    ("avg_fare", D), ("avg_tip", D), ("avg_trip_miles", D), ("avg_trip_duration_minutes", D),
    ("avg_speed_mph", D),
)

HOURLY = _struct(
    ("pickup_hour", I), ("is_weekend", I), ("pickup_borough", S), ("is_shared_ride", I),
    ("total_trips", L), ("avg_fare", D), ("avg_trip_miles", D), ("avg_tip_percentage", D),
    ("avg_speed_mph", D), ("avg_wait_time_minutes", D),
)

ROUTE = _struct(
    ("pickup_borough", S), ("pickup_zone", S), ("dropoff_borough", S), ("dropoff_zone", S),
    ("total_trips", L), ("avg_fare", D), ("avg_trip_miles", D), ("avg_trip_duration_minutes", D),
)

QUALITY_SUMMARY = _struct(
    ("rejection_reason", S), ("record_count", L), ("pct_of_total", D), ("status", S),
)

MONTHLY_DQ = _struct(
    ("month", S), ("total", L), ("good", L), ("rejected", L), ("rejection_rate_pct", D),
)

MANIFEST = _struct(
    ("file", S), ("source_url", S), ("target", S), ("row_count", L), ("size_bytes", L),
    ("size_mb", D), ("status", S), ("error", S),
)
