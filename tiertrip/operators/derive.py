"""Derived trip columns and the post-derivation sanity filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiertrip.config import DEFAULT_THRESHOLDS, Thresholds
from tiertrip.functions import trip as tf
from tiertrip.functions.numeric import round_value_fast, rounds_to_at_most

DERIVED = ("trip_duration_minutes", "pickup_date", "pickup_hour", "pickup_day_of_week", "is_weekend",
           "speed_mph", "is_shared_ride", "wait_time_minutes")


def derive(df: DataFrame) -> DataFrame:
    """Add the 8 derived columns. Speed uses the rounded duration, as the source pipeline does."""
    pickup = F.col("pickup_datetime")
    first = df.withColumns({
        "trip_duration_minutes": tf.duration_minutes(F.col("trip_time")),
        "pickup_date": F.to_date(pickup),
        "pickup_hour": F.hour(pickup),
        "pickup_day_of_week": F.dayofweek(pickup),
        "is_weekend": tf.weekend_flag(pickup),
        "is_shared_ride": tf.yes_flag(F.col("shared_match_flag")),
        "wait_time_minutes": tf.minutes_between(pickup, F.col("request_datetime")),
    })
    raw = first.withColumn("__speed", tf.raw_speed(F.col("trip_miles"), F.col("trip_duration_minutes")))
    return raw.withColumn("speed_mph", round_value_fast(F.col("__speed"), 2)).drop("__speed")


def speed_ok(thresholds: Thresholds = DEFAULT_THRESHOLDS):
    dur = F.col("trip_duration_minutes")
    # coalesce(speed <= max, TRUE) is "speed NULL or <= max" with the speed evaluated once; the speed's
    # rounding is in the limit, since Catalyst copies the whole expression below the derivation
    return (F.coalesce(rounds_to_at_most(tf.raw_speed(F.col("trip_miles"), dur), thresholds.max_speed_mph), F.lit(True))
            & (dur >= F.lit(thresholds.min_duration_minutes))
            & (dur <= F.lit(thresholds.max_duration_minutes)))


def speed_filter(df: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Keep speed NULL or <= 80 mph, and duration in [1, 240] minutes."""
    return df.filter(speed_ok(thresholds))
