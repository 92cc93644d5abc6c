"""Silver -> gold rollups. Each is one ``groupBy().agg()``: partial hash aggregation before the
shuffle, so the exchange carries one row per group per task however skewed a group is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiertrip.config import DEFAULT_THRESHOLDS, Thresholds
from tiertrip.functions.numeric import shared_parts

DAILY_KEYS = ("pickup_date", "pickup_borough")
HOURLY_KEYS = ("pickup_hour", "is_weekend", "pickup_borough", "is_shared_ride")
ROUTE_KEYS = ("pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone")


def tip_percentage():
    fare = F.col("base_passenger_fare")
    return F.when(fare > 0, F.col("tips") / fare * F.lit(100.0))


_COLUMN = {"fare": "base_passenger_fare", "tip": "tips", "miles": "trip_miles", "minutes": "trip_duration_minutes",
           "speed": "speed_mph", "wait": "wait_time_minutes"}


#: Measures that the quality rules and the sanity filter keep small (fare, miles, minutes, speed limits).
NARROW = ("fare", "miles", "minutes", "speed")


def _parts(curated: DataFrame, keys: tuple[str, ...], *names: str):
    """Group keys and the exact parts of the named measures, projected once per row."""
    return shared_parts(curated, list(keys), NARROW, **{n: tip_percentage() if n == "tip_pct" else F.col(_COLUMN[n]) for n in names})


def daily_borough_summary(curated: DataFrame, sort: bool = True) -> DataFrame:
    rows, m = _parts(curated, DAILY_KEYS, "fare", "tip", "miles", "minutes", "speed")
    out = rows.groupBy(*DAILY_KEYS).agg(
        F.count(F.lit(1)).alias("total_trips"),
        m["fare"].sum().alias("total_revenue"),
        m["fare"].avg().alias("avg_fare"),
        m["tip"].avg().alias("avg_tip"),
        m["miles"].avg().alias("avg_trip_miles"),
        m["minutes"].avg().alias("avg_trip_duration_minutes"),
        m["speed"].avg().alias("avg_speed_mph"),
    )
    return out.orderBy(*DAILY_KEYS) if sort else out


def hourly_pattern_summary(curated: DataFrame, sort: bool = True) -> DataFrame:
    rows, m = _parts(curated, HOURLY_KEYS, "fare", "miles", "tip_pct", "speed", "wait")
    out = rows.groupBy(*HOURLY_KEYS).agg(
        F.count(F.lit(1)).alias("total_trips"),
        m["fare"].avg().alias("avg_fare"),
        m["miles"].avg().alias("avg_trip_miles"),
        m["tip_pct"].avg().alias("avg_tip_percentage"),
        m["speed"].avg().alias("avg_speed_mph"),
        m["wait"].avg().alias("avg_wait_time_minutes"),
    )
    return out.orderBy("pickup_borough", "is_weekend", "pickup_hour", "is_shared_ride") if sort else out


def route_summary(curated: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS, sort: bool = True) -> DataFrame:
    rows, m = _parts(curated, ROUTE_KEYS, "fare", "miles", "minutes")
    out = (rows.groupBy(*ROUTE_KEYS).agg(
        F.count(F.lit(1)).alias("total_trips"),
        m["fare"].avg().alias("avg_fare"),
        m["miles"].avg().alias("avg_trip_miles"),
        m["minutes"].avg().alias("avg_trip_duration_minutes"),
    ).filter(F.col("total_trips") >= F.lit(thresholds.min_route_trips)))
    return out.orderBy(F.col("total_trips").desc(), *ROUTE_KEYS) if sort else out


GOLD_SETS = {"daily": DAILY_KEYS, "hourly": HOURLY_KEYS, "routes": ROUTE_KEYS}
GOLD_KEYS = tuple(dict.fromkeys(DAILY_KEYS + HOURLY_KEYS + ROUTE_KEYS))
GOLD_MEASURES = {
    "daily": ("total_trips", "total_revenue", "avg_fare", "avg_tip", "avg_trip_miles",
              "avg_trip_duration_minutes", "avg_speed_mph"),
    "hourly": ("total_trips", "avg_fare", "avg_trip_miles", "avg_tip_percentage", "avg_speed_mph",
               "avg_wait_time_minutes"),
    "routes": ("total_trips", "avg_fare", "avg_trip_miles", "avg_trip_duration_minutes"),
}


def _gid(keys: tuple[str, ...]) -> int:
    """Spark's grouping_id for a grouping set: bit set for every key *not* grouped on."""
    n = len(GOLD_KEYS)
    return sum(1 << (n - 1 - i) for i, c in enumerate(GOLD_KEYS) if c not in keys)


def gold_one_pass(curated: DataFrame) -> DataFrame:
    """All three gold groupings from one scan and one shuffle, as GROUPING SETS.

    Each silver row feeds three partial aggregates (an Expand, CPU only); the exchange carries
    partial rows of all three tables at once. Exact aggregates make the rows identical to
    the three separate rollups. Split with :func:`split_gold`."""
    rows, m = _parts(curated, GOLD_KEYS, "fare", "tip", "miles", "minutes", "speed", "tip_pct", "wait")
    return rows.groupingSets([list(k) for k in GOLD_SETS.values()], *GOLD_KEYS).agg(
        F.count(F.lit(1)).alias("total_trips"),
        m["fare"].sum().alias("total_revenue"),
        m["fare"].avg().alias("avg_fare"),
        m["tip"].avg().alias("avg_tip"),
        m["miles"].avg().alias("avg_trip_miles"),
        m["minutes"].avg().alias("avg_trip_duration_minutes"),
        m["speed"].avg().alias("avg_speed_mph"),
        m["tip_pct"].avg().alias("avg_tip_percentage"),
        m["wait"].avg().alias("avg_wait_time_minutes"),
        F.grouping_id().alias("gold_set"),
    )


def busy_routes(combined: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """:func:`gold_one_pass` without the routes under the trip limit."""
    return combined.filter((F.col("gold_set") != F.lit(_gid(ROUTE_KEYS)))
                           | (F.col("total_trips") >= F.lit(thresholds.min_route_trips)))


def split_gold(combined: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> dict[str, DataFrame]:
    """The three gold tables out of :func:`gold_one_pass` (or its written copy)."""
    out = {}
    for name, keys in GOLD_SETS.items():
        part = combined.filter(F.col("gold_set") == F.lit(_gid(keys))).select(*keys, *GOLD_MEASURES[name])
        if name == "routes":
            part = part.filter(F.col("total_trips") >= F.lit(thresholds.min_route_trips))
        out[name] = part
    return out
