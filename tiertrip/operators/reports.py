"""Quality and validation reports as lazy DataFrames.

Stage counts that the source pipeline takes with one action per stage are fused into a single
aggregate (``count_if`` per stage), so the trips are scanned once. Reports whose totals are needed
as denominators take them from a tiny grouped result (one row per rule), never from the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiertrip import schemas
from tiertrip.config import (DEFAULT_THRESHOLDS, PASSED_REASON, PROVIDER_LYFT, STATUS_PASSED,
                             STATUS_REJECTED, Thresholds)
from tiertrip.functions.numeric import pct, round_avg, round_sum, round_value, shared_parts
from tiertrip.functions.trip import month_label
from tiertrip.operators import derive as dv
from tiertrip.operators import quality as q

REASON = q.REASON


def _stage_flags(bronze: DataFrame, provider: str, thresholds: Thresholds) -> tuple[DataFrame, Column, Column, Column]:
    """Bronze with derived columns plus the three cumulative stage predicates."""
    prov = F.col("hvfhs_license_num") == F.lit(provider)
    dq = prov & q.keep_expr(thresholds=thresholds)
    cur = dq & dv.speed_ok(thresholds)
    return dv.derive(bronze), prov, dq, cur


def stage_funnel(bronze: DataFrame, provider: str = PROVIDER_LYFT,
                 thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """RPT-1/RPT-3: raw -> provider -> quality filter -> speed filter counts in one pass.

    Zone lookups are left joins on a unique key, so they do not change counts."""
    df, prov, dq, cur = _stage_flags(bronze, provider, thresholds)
    c = df.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(prov).alias("provider_rows"),
        F.count_if(dq).alias("dq_rows"),
        F.count_if(cur).alias("curated_rows"),
    )
    return c.select(
        "raw_rows", "provider_rows",
        pct("provider_rows", "raw_rows", 1).alias("provider_share_pct"),
        (F.col("provider_rows") - F.col("dq_rows")).alias("removed_by_dq"),
        pct(F.col("provider_rows") - F.col("dq_rows"), "provider_rows", 2).alias("removed_by_dq_pct"),
        "dq_rows",
        (F.col("dq_rows") - F.col("curated_rows")).alias("removed_by_speed"),
        "curated_rows",
    )


def transformation_summary(bronze: DataFrame, provider: str = PROVIDER_LYFT,
                           thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """RPT-2 + AGG-15: raw, provider and curated counts, retention, date partitions, column count."""
    df, prov, _, cur = _stage_flags(bronze, provider, thresholds)
    c = df.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(prov).alias("provider_rows"),
        F.count_if(cur).alias("curated_rows"),
        F.count_distinct(F.when(cur, F.col("pickup_date"))).alias("date_partitions"),
    )
    return c.select(
        "raw_rows", "provider_rows", "curated_rows",
        pct("curated_rows", "raw_rows", 1).alias("retention_pct"),
        "date_partitions",
        F.lit(len(schemas.CURATED.fields)).alias("curated_columns"),
    )


def dq_totals(tagged: DataFrame) -> DataFrame:
    """RPT-4: total, good, rejected, pass and rejection rates (2 dp); an empty input gives 0 / 100."""
    return _dq_totals(tagged.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(REASON).isNull()).alias("good")))


def _dq_totals(c: DataFrame) -> DataFrame:
    rej = F.col("total") - F.col("good")
    rate = F.coalesce(F.try_divide(rej.cast("double"), F.col("total")) * F.lit(100.0), F.lit(0.0))
    return c.select(
        "total", "good", rej.alias("rejected"),
        round_value(F.lit(100.0) - rate, 2).alias("pass_rate_pct"),
        round_value(rate, 2).alias("rejection_rate_pct"),
    )


def reason_counts(tagged: DataFrame) -> DataFrame:
    """AGG-7 over all rows: one row per rule that fired plus the NULL (good) group."""
    return tagged.groupBy(REASON).agg(F.count(F.lit(1)).alias("record_count"))


def rejection_breakdown(tagged: DataFrame) -> DataFrame:
    """AGG-7/AGG-8: rejected rows per reason with their share of *all* rows (4 dp)."""
    counts = reason_counts(tagged)
    # The window spans the grouped result: at most one row per rule plus one, so a single
    # partition is bounded by the rule list, not by the data.
    total = F.sum("record_count").over(Window.partitionBy())
    out = (counts.withColumn("total", total)
           .filter(F.col(REASON).isNotNull())
           .select(REASON, "record_count", pct("record_count", "total", 4).alias("pct_of_total"),
                   F.lit(STATUS_REJECTED).alias("status")))
    return out.orderBy(F.col("record_count").desc(), REASON)


def quality_summary(tagged: DataFrame) -> DataFrame:
    """RPT-5: the PASSED row (always present, also for empty input) on top of the rejection rows.

    The PASSED share is ``100 - rejection rate`` as in the source job; both branches reuse one
    shuffle of the grouped counts."""
    counts = reason_counts(tagged)
    tot = counts.agg(
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col(REASON).isNull(), F.col("record_count"))), F.lit(0)).alias("good"),
    )
    rej_rate = F.coalesce(F.try_divide((F.col("total") - F.col("good")).cast("double"), F.col("total"))
                          * F.lit(100.0), F.lit(0.0))
    passed = tot.select(
        F.lit(PASSED_REASON).alias(REASON), F.col("good").cast("long").alias("record_count"),
        round_value(F.lit(100.0) - rej_rate, 4).alias("pct_of_total"), F.lit(STATUS_PASSED).alias("status"),
    )
    rejected = rejection_breakdown(tagged).select(*schemas.QUALITY_SUMMARY.fieldNames())
    out = passed.unionByName(rejected)
    return out.orderBy(F.when(F.col("status") == STATUS_PASSED, 0).otherwise(1),
                       F.col("record_count").desc(), REASON)


def monthly_dq(tagged: DataFrame) -> DataFrame:
    """RPT-6: per pickup month (NULL month is a row): total, good, rejected, rejection % (2 dp)."""
    out = tagged.groupBy(month_label(F.col("pickup_datetime")).alias("month")).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(REASON).isNull()).alias("good"),
        F.count_if(F.col(REASON).isNotNull()).alias("rejected"),
    )
    return out.withColumn("rejection_rate_pct", pct("rejected", "total", 2)).orderBy("month")


def monthly_counts(df: DataFrame, ts_col: str) -> DataFrame:
    """AGG-9/AGG-10: trips per ``yyyy-MM`` of a timestamp or date column."""
    return (df.groupBy(month_label(F.col(ts_col)).alias("month"))
            .agg(F.count(F.lit(1)).alias("trip_count")).orderBy("month"))


def provider_breakdown(bronze: DataFrame) -> DataFrame:
    """AGG-11: trips per licence number, busiest first."""
    return (bronze.groupBy("hvfhs_license_num").agg(F.count(F.lit(1)).alias("trip_count"))
            .orderBy(F.col("trip_count").desc(), "hvfhs_license_num"))


DQ_SETS = ("month", "hvfhs_license_num")


def dq_one_pass(tagged: DataFrame) -> DataFrame:
    """Every report of the quality job besides the reasons' counts, from one scan and one shuffle: trips, and
    good trips, by month, by provider and in all, as grouping sets (``dq_set`` tells them apart, since
    NULL is a month and a provider of its own). Split with :func:`split_dq`."""
    rows = tagged.select(month_label(F.col("pickup_datetime")).alias("month"), "hvfhs_license_num",
                         F.col(REASON).isNull().alias("passed"))
    return rows.groupingSets([[k] for k in DQ_SETS] + [[]], *DQ_SETS).agg(
        F.count(F.lit(1)).alias("total"), F.count_if("passed").alias("good"), F.grouping_id().alias("dq_set"))


def _dq_set(name: str | None) -> int:
    """Spark's grouping_id of one key's grouping set (a bit for each key not grouped on), or of the total."""
    return sum(1 << (len(DQ_SETS) - 1 - i) for i, k in enumerate(DQ_SETS) if k != name)


def split_dq(combined: DataFrame) -> dict[str, DataFrame]:
    """``totals``, ``monthly``, ``providers`` and ``monthly_raw`` out of :func:`dq_one_pass` (or its written copy)."""
    part = lambda name: combined.where(F.col("dq_set") == F.lit(_dq_set(name)))
    rejected = (F.col("total") - F.col("good")).alias("rejected")
    monthly = part("month").select("month", "total", "good", rejected)
    return {
        # a table without rows has no grouping set either; its totals are zero
        "totals": _dq_totals(part(None).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "good")])),
        "monthly": monthly.withColumn("rejection_rate_pct", pct("rejected", "total", 2)).orderBy("month"),
        "providers": part("hvfhs_license_num").select("hvfhs_license_num", F.col("total").alias("trip_count"))
        .orderBy(F.col("trip_count").desc(), "hvfhs_license_num"),
        "monthly_raw": part("month").select("month", F.col("total").alias("trip_count")).orderBy("month"),
    }


def borough_distribution(curated: DataFrame, n: int = 10) -> DataFrame:
    """AGG-12: top-n pickup boroughs by trips (ties by name, NULL first)."""
    return (curated.groupBy("pickup_borough").agg(F.count(F.lit(1)).alias("trip_count"))
            .orderBy(F.col("trip_count").desc(), F.col("pickup_borough").asc_nulls_first()).limit(n))


def shared_breakdown(curated: DataFrame) -> DataFrame:
    """AGG-13: shared vs solo trips."""
    return (curated.groupBy(F.col("is_shared_ride").alias("shared"))
            .agg(F.count(F.lit(1)).alias("trip_count")).orderBy("shared"))


def fare_statistics(curated: DataFrame) -> DataFrame:
    """AGG-14: fare and trip statistics, one global aggregate."""
    rows, m = shared_parts(curated, ["base_passenger_fare"], ("fare", "miles", "minutes"), fare=F.col("base_passenger_fare"), miles=F.col("trip_miles"),
                           minutes=F.col("trip_duration_minutes"), wait=F.col("wait_time_minutes"))
    return rows.agg(
        m["fare"].avg().alias("avg_fare"),
        round_value(F.min("base_passenger_fare"), 2).alias("min_fare"),
        round_value(F.max("base_passenger_fare"), 2).alias("max_fare"),
        m["miles"].avg().alias("avg_miles"),
        m["minutes"].avg().alias("avg_duration_min"),
        m["wait"].avg().alias("avg_wait_min"),
    )


def daily_coverage(daily: DataFrame) -> DataFrame:
    """AGG-16/DST-1: date range and distinct counts of the daily gold table."""
    return daily.agg(
        F.min("pickup_date").alias("earliest_date"), F.max("pickup_date").alias("latest_date"),
        F.count_distinct("pickup_date").alias("distinct_dates"),
        F.count_distinct("pickup_borough").alias("distinct_boroughs"),
    )


def borough_revenue_rank(daily: DataFrame, n: int = 6) -> DataFrame:
    """AGG-17: re-aggregate daily gold by borough; top-n by revenue."""
    return (daily.groupBy("pickup_borough").agg(
        round_sum("total_revenue").alias("total_6m_revenue"),
        F.sum("total_trips").alias("total_6m_trips"),
    ).orderBy(F.col("total_6m_revenue").desc(), F.col("pickup_borough").asc_nulls_first()).limit(n))


def shared_vs_solo_metrics(hourly: DataFrame) -> DataFrame:
    """AGG-18: unweighted averages of the hourly averages, by shared flag (as the source does)."""
    return hourly.groupBy("is_shared_ride").agg(
        round_avg("avg_fare").alias("avg_fare"),
        round_avg("avg_wait_time_minutes").alias("avg_wait_min"),
        round_avg("avg_tip_percentage").alias("avg_tip_pct"),
        F.sum("total_trips").alias("total_trips"),
    ).orderBy("is_shared_ride")


def top_revenue_days(daily: DataFrame, n: int = 10) -> DataFrame:
    """TOP-1: the n (date, borough) rows with the most revenue; group keys break ties."""
    return daily.orderBy(F.col("total_revenue").desc(), "pickup_date",
                         F.col("pickup_borough").asc_nulls_first()).limit(n)


def top_routes(routes: DataFrame, n: int = 10) -> DataFrame:
    """TOP-2: the n busiest routes; the four zone keys break ties."""
    keys = [F.col(c).asc_nulls_first() for c in ("pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone")]
    return routes.orderBy(F.col("total_trips").desc(), *keys).limit(n)


def weekday_borough_hours(hourly: DataFrame, borough: str) -> DataFrame:
    """FLT-8: one borough on weekdays, by hour (the preview of the hourly table)."""
    return (hourly.filter((F.col("pickup_borough") == F.lit(borough)) & (F.col("is_weekend") == 0))
            .orderBy("pickup_hour", "is_shared_ride"))
