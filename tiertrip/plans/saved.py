"""The seven saved SQL queries over the gold tables, as DataFrame functions and as SQL text.

The text runs with ``spark.sql`` once the gold tables are registered as views (``register_views``)
or catalog tables; tests check that both forms agree. Place names are parameters: the source
queries name real places; the fixture uses its own borough and zone names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiertrip.functions.numeric import round_avg, round_avg_sql, round_sum, round_sum_sql


def q1_daily_revenue(daily: DataFrame) -> DataFrame:
    return (daily.select("pickup_date", "pickup_borough", "total_trips", "total_revenue", "avg_fare")
            .orderBy("pickup_date", F.col("total_revenue").desc(), F.col("pickup_borough").asc_nulls_first()))


def q2_rush_hour(hourly: DataFrame, borough: str) -> DataFrame:
    return (hourly.filter(F.col("pickup_borough") == F.lit(borough))
            .select("pickup_hour", "is_weekend", "is_shared_ride", "total_trips", "avg_fare",
                    "avg_speed_mph", "avg_wait_time_minutes")
            .orderBy("pickup_hour", "is_weekend", "is_shared_ride"))


def q3_tipping(hourly: DataFrame) -> DataFrame:
    return (hourly.groupBy("pickup_hour", "is_shared_ride").agg(
        F.sum("total_trips").alias("trips"),
        round_avg("avg_tip_percentage").alias("avg_tip_pct"),
        round_avg("avg_fare").alias("avg_fare"),
    ).orderBy("pickup_hour", "is_shared_ride"))


def q4_top_routes(routes: DataFrame, n: int = 10, with_duration: bool = True) -> DataFrame:
    cols = ["pickup_zone", "dropoff_zone", "pickup_borough", "dropoff_borough", "total_trips", "avg_fare",
            "avg_trip_miles"] + (["avg_trip_duration_minutes"] if with_duration else [])
    keys = [F.col(c).asc_nulls_first() for c in ("pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone")]
    return routes.orderBy(F.col("total_trips").desc(), *keys).limit(n).select(*cols)


def q5_special_zone_routes(routes: DataFrame, zones: list[str]) -> DataFrame:
    return (routes.filter(F.col("pickup_zone").isin(zones) | F.col("dropoff_zone").isin(zones))
            .select("pickup_zone", "dropoff_zone", "total_trips", "avg_fare", "avg_trip_miles")
            .orderBy(F.col("total_trips").desc(), F.col("pickup_zone").asc_nulls_first(),
                     F.col("dropoff_zone").asc_nulls_first()))


def q6_monthly_revenue(daily: DataFrame) -> DataFrame:
    return (daily.groupBy(F.trunc("pickup_date", "month").alias("month"), "pickup_borough").agg(
        F.sum("total_trips").alias("monthly_trips"),
        round_sum("total_revenue").alias("monthly_revenue"),
        round_avg("avg_fare").alias("avg_fare"),
    ).orderBy("month", F.col("monthly_revenue").desc(), F.col("pickup_borough").asc_nulls_first()))


def q7_wait(hourly: DataFrame) -> DataFrame:
    return (hourly.groupBy("pickup_borough", "is_shared_ride").agg(
        F.sum("total_trips").alias("total_trips"),
        round_avg("avg_wait_time_minutes").alias("avg_wait_min"),
    ).orderBy(F.col("pickup_borough").asc_nulls_first(), "is_shared_ride"))


def _avg(x: str) -> str:
    return round_avg_sql(x)


def _sum(x: str) -> str:
    return round_sum_sql(x)


def sql_text(borough: str, zones: list[str], db: str = "") -> dict[str, str]:
    """Spark SQL text of the saved queries, with the same exact micro-unit rounding as the
    DataFrame forms (the SQL is generated from the same recipe; tested equal)."""
    p = f"{db}." if db else ""
    zl = ", ".join("'" + z.replace("'", "''") + "'" for z in zones)
    b = borough.replace("'", "''")
    return {
        "q1": f"""SELECT pickup_date, pickup_borough, total_trips, total_revenue, avg_fare
FROM {p}daily_borough_summary ORDER BY pickup_date, total_revenue DESC, pickup_borough""",
        "q2": f"""SELECT pickup_hour, is_weekend, is_shared_ride, total_trips, avg_fare, avg_speed_mph, avg_wait_time_minutes
FROM {p}hourly_pattern_summary WHERE pickup_borough = '{b}' ORDER BY pickup_hour, is_weekend, is_shared_ride""",
        "q3": f"""SELECT pickup_hour, is_shared_ride, SUM(total_trips) AS trips,
       {_avg('avg_tip_percentage')} AS avg_tip_pct, {_avg('avg_fare')} AS avg_fare
FROM {p}hourly_pattern_summary GROUP BY pickup_hour, is_shared_ride ORDER BY pickup_hour, is_shared_ride""",
        "q4": f"""SELECT pickup_zone, dropoff_zone, pickup_borough, dropoff_borough, total_trips, avg_fare, avg_trip_miles,
       avg_trip_duration_minutes
FROM {p}route_summary
ORDER BY total_trips DESC, pickup_borough, pickup_zone, dropoff_borough, dropoff_zone LIMIT 10""",
        "q5": f"""SELECT pickup_zone, dropoff_zone, total_trips, avg_fare, avg_trip_miles
FROM {p}route_summary WHERE pickup_zone IN ({zl}) OR dropoff_zone IN ({zl})
ORDER BY total_trips DESC, pickup_zone, dropoff_zone""",
        "q6": f"""SELECT TRUNC(pickup_date, 'month') AS month, pickup_borough, SUM(total_trips) AS monthly_trips,
       {_sum('total_revenue')} AS monthly_revenue, {_avg('avg_fare')} AS avg_fare
FROM {p}daily_borough_summary GROUP BY 1, 2 ORDER BY month, monthly_revenue DESC, pickup_borough""",
        "q7": f"""SELECT pickup_borough, is_shared_ride, SUM(total_trips) AS total_trips,
       {_avg('avg_wait_time_minutes')} AS avg_wait_min
FROM {p}hourly_pattern_summary GROUP BY pickup_borough, is_shared_ride ORDER BY pickup_borough, is_shared_ride""",
    }


def register_views(spark: SparkSession, daily: DataFrame, hourly: DataFrame, routes: DataFrame) -> None:
    daily.createOrReplaceTempView("daily_borough_summary")
    hourly.createOrReplaceTempView("hourly_pattern_summary")
    routes.createOrReplaceTempView("route_summary")


def run_sql(spark: SparkSession, borough: str, zones: list[str], db: str = "") -> dict[str, DataFrame]:
    return {k: spark.sql(v) for k, v in sql_text(borough, zones, db).items()}
