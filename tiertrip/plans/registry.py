"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus the DuckDB oracle text.

Every query reads the driver's tables through :class:`TripLake` (bronze and zones derived from
``lineitem``/``nation``/``region``), over the whole tables. Place names used by the saved queries
and the look-back dates are fixture parameters, stated once below.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiertrip.checks import oracle as o
from tiertrip.checks.oracle import avg2, pct, r, sum2, with_
from tiertrip.operators import derive as dv
from tiertrip.operators import enrich as en
from tiertrip.operators import quality as qu
from tiertrip.operators import reports as rp
from tiertrip.functions.numeric import round_sum
from tiertrip.operators import zones as zn
from tiertrip.plans import medallion as md
from tiertrip.plans import saved
from tiertrip.plans.lake import TripLake
from tiertrip.session import run_path
from tiertrip import schemas
from tiertrip.sinks import catalog
from tiertrip.sinks import landing as ld
from tiertrip.sinks.writers import write_counted, write_partitioned
from tiertrip.sources import months as mo
from tiertrip.sources import fixtures, readers

# Fixture parameters: the fixture's own borough and zone names stand in for the real places.
BOROUGH = "ASIA"
SPECIAL_ZONES = ["NATION_1", "NATION_2"]
LATEST_AS_OF, LATEST_START, LATEST_MAX, LATEST_N = "2024-08-15", 2, 14, 6
MISSING_AS_OF, MISSING_START, MISSING_MAX = "2024-09-01", 1, 10
MANIFEST_BASE_URL = "landing/nyctlc"
MANIFEST_TARGET = "raw/nyctlc/fhvhv_tripdata"
GENERATED_AT = "1970-01-01T00:00:00+00:00"
ZONE_SOURCE = "raw/nyctlc/taxi_zone_lookup"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Callable[[TripLake], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(TripLake.from_testdata(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _run_dir(lake: TripLake, what: str) -> str:
    """A folder of its own for each call, so that no later call overwrites what a frame still reads."""
    return run_path(lake.spark, uuid.uuid4().hex, what)


B, S = o.BASE, o.SILVER  # CTE stacks: bronze trips; trips through silver
NF = "ASC NULLS FIRST"

# ---------------------------------------------------------------- sources
@query("scan_trips", with_(B, "SELECT * FROM trips"))
def scan_trips(lake):
    """SRC-1: multi-month bronze scan under the explicit 23-column schema."""
    return lake.bronze()


@query("scan_zones", with_([o.ZONES], "SELECT * FROM zones"))
def scan_zones(lake):
    """SRC-2: zone CSV with header; the text N/A stays a string."""
    return lake.zones()


@query("scan_zones_na", with_([o.ZONES, o.ZONES_NA], "SELECT * FROM zones_na"))
def scan_zones_na(lake):
    """SRC-3: zone CSV with pandas NA semantics (N/A and the other default tokens -> NULL)."""
    return lake.zones_na()


@query("roundtrip_curated", with_(S, "SELECT * FROM curated"))
def roundtrip_curated(lake):
    """SRC-4/SNK-1: write silver partitioned by pickup_date, read it back with partition discovery."""
    path = _run_dir(lake, "curated")
    write_partitioned(lake.curated(), path, "pickup_date")
    return readers.scan_curated(lake.spark, path)


_AVAIL = """avail AS (SELECT DISTINCT CAST(date_trunc('month', pickup_datetime) AS DATE) AS month FROM trips
            WHERE pickup_datetime IS NOT NULL)"""


def _spine(as_of: str, start: int, stop: int) -> str:
    return f"""spine AS (SELECT CAST(o AS INTEGER) AS months_back,
                 CAST(date_trunc('month', DATE '{as_of}') - to_months(CAST(o AS INTEGER)) AS DATE) AS month
          FROM range({start}, {stop + 1}) t(o))"""


_MONTH_COLS = """months_back, strftime(month, '%Y-%m') AS month,
       'fhvhv_tripdata_' || strftime(month, '%Y-%m') || '.parquet' AS file"""


@query("latest_months", with_(B + [_AVAIL, _spine(LATEST_AS_OF, LATEST_START, LATEST_MAX)], f"""SELECT {_MONTH_COLS}
FROM spine WHERE month IN (SELECT month FROM avail) ORDER BY spine.month DESC LIMIT {LATEST_N}"""))
def latest_months(lake):
    """SRC-7: newest 6 months present within 2..14 months before the as-of date."""
    return mo.latest_months(mo.available_months(lake.spark, lake.landing_path()), LATEST_AS_OF, LATEST_START, LATEST_MAX, LATEST_N)


@query("missing_months", with_(B + [_AVAIL, _spine(MISSING_AS_OF, MISSING_START, MISSING_MAX)], f"""SELECT {_MONTH_COLS}
FROM spine WHERE month NOT IN (SELECT month FROM avail)"""))
def missing_months(lake):
    """SRC-8: months in the look-back window that the data does not have."""
    return mo.missing_months(mo.available_months(lake.spark, lake.landing_path()), MISSING_AS_OF, MISSING_START, MISSING_MAX)


# ---------------------------------------------------------------- landing
def _landed_path(lake: TripLake, what: str) -> str:
    path = _run_dir(lake, what)
    files = mo.month_files(lake.spark, lake.landing_path())
    ld.land_months(lake.spark, [p for p, _ in files.values()], path)
    return path


# A trip belongs to the month of its file, which its derivation sets, NULL pickup times included.
_FILE_MONTH = f"SELECT strftime({o.at('p')}, '%Y-%m') AS source_month, count(*) AS landed_rows FROM li GROUP BY 1"


@query("land_months", with_([o.LI], _FILE_MONTH))
def land_months(lake):
    """SNK-5: land the monthly files whole by source month (dynamic overwrite) and count what landed."""
    return ld.landed_summary(ld.read_landed(lake.spark, _landed_path(lake, "landed")))


@query("stream_land_months", with_([o.LI], _FILE_MONTH))
def stream_land_months(lake):
    """SNK-6: an availableNow Structured Streaming run picks up the landing files (each file once,
    tracked in its checkpoint) and lands them by source month; rows per landed month."""
    from tiertrip.streaming.landing import run_landing_once
    out, ckpt = _run_dir(lake, "streamed"), _run_dir(lake, "streamed_checkpoint")
    run_landing_once(lake.spark, lake.landing_path(), out, ckpt)
    return ld.landed_summary(ld.read_landed(lake.spark, out))


@query("ingest_manifest", with_([o.LI], f"""SELECT 'fhvhv_tripdata_' || source_month || '.parquet' AS file,
       '{MANIFEST_BASE_URL}/fhvhv_tripdata_' || source_month || '.parquet' AS source_url,
       '{MANIFEST_TARGET}/source_month=' || source_month || '/' AS target,
       landed_rows AS row_count, 'SUCCESS' AS status
FROM ({_FILE_MONTH})"""))
def ingest_manifest(lake):
    """SNK-7: per landed month: file, source URL, target, rows by the footers, status (sizes are unit-tested)."""
    return ld.ingest_manifest(lake.spark, _landed_path(lake, "landed_manifest"), MANIFEST_BASE_URL, MANIFEST_TARGET,
                              with_sizes=False)


_ZONE_FILE = ZONE_SOURCE.rsplit("/", 1)[-1]
_CHOSEN = [_AVAIL, _spine(LATEST_AS_OF, LATEST_START, LATEST_MAX), f"""chosen AS (
  SELECT {_MONTH_COLS} FROM spine WHERE month IN (SELECT month FROM avail) ORDER BY spine.month DESC LIMIT {LATEST_N})"""]


def _ingest(lake: TripLake, bronze: str, zones_target: str, months: int = LATEST_N, **kw) -> DataFrame:
    return md.ingest_job(lake.spark, lake.landing_path(), bronze, LATEST_AS_OF, LATEST_START, LATEST_MAX, months,
                         base_url=MANIFEST_BASE_URL, zones_path=lake.zones_path, zones_target=zones_target, **kw)


@query("ingest_dry_run", with_(B + _CHOSEN, f"""SELECT file, '{MANIFEST_BASE_URL}/' || file AS source_url,
       '{MANIFEST_TARGET}/source_month=' || month || '/' AS target, 'DRY_RUN' AS status FROM chosen
UNION ALL SELECT '{_ZONE_FILE}', '{MANIFEST_BASE_URL}/{_ZONE_FILE}', '{ZONE_SOURCE}', 'DRY_RUN'"""))
def ingest_dry_run(lake):
    """SNK-8/PIP-5: what the ingest would land, the zone table with it; nothing is written (sizes are unit-tested)."""
    return _ingest(lake, MANIFEST_TARGET, ZONE_SOURCE, dry_run=True).select("file", "source_url", "target", "status")


@query("ingest_run", with_(B + _CHOSEN, f"""SELECT file, landed_rows AS row_count, 'SUCCESS' AS status,
       CAST(NULL AS VARCHAR) AS error FROM chosen JOIN ({_FILE_MONTH}) f ON f.source_month = chosen.month
UNION ALL SELECT '{_ZONE_FILE}', NULL, 'SUCCESS', NULL"""))
def ingest_run(lake):
    """PIP-5/SNK-5/SNK-7: the ingest job, month by month, with the zone table: rows by the footers, status, error."""
    return _ingest(lake, _run_dir(lake, "ingested"), _run_dir(lake, "zones")).select("file", "row_count", "status", "error")


@query("ingest_history", with_(B + _CHOSEN, """SELECT 'run' || k AS run_id, 'SUCCESS' AS status, false AS dry_run,
       least(k, (SELECT count(*) FROM chosen)) + 1 AS files_uploaded, least(k, (SELECT count(*) FROM chosen)) + 1 AS files_total
FROM range(1, 3) t(k)"""))
def ingest_history(lake):
    """AGG-23/SNK-7: the history of two runs, of one month and of two, the second one repeated: an entry a run,
    files uploaded and in all."""
    bronze, zones, history = (_run_dir(lake, d) for d in ("ingested", "zones", "history"))
    for k in (1, 2, 2):
        _ingest(lake, bronze, zones, months=k, history_path=history, run_at=GENERATED_AT, run_id=f"run{k}")
    return ld.read_history(lake.spark, history).select("run_id", "status", "dry_run", "files_uploaded", "files_total")


# ---------------------------------------------------------------- filters and tags
@query("provider_filter", with_(B + [o.PROVIDER], "SELECT * FROM provider"))
def provider_filter(lake):
    """FLT-1: one provider's trips."""
    return lake.provider_trips()


@query("dq_filter", with_(B + [o.PROVIDER, o.DQ_OK], "SELECT * FROM dq_ok"))
def dq_filter(lake):
    """FLT-2: the conjunctive quality filter after the provider filter."""
    return qu.keep(lake.provider_trips(), thresholds=lake.thresholds)


@query("dq_tag", with_(B + [o.TAGGED], "SELECT * FROM tagged"))
def dq_tag(lake):
    """FLT-3: first failed rule per row over all providers (NULL = good)."""
    return lake.tagged()


@query("dq_good", with_(B, f"SELECT * FROM trips WHERE {o.GOOD_FILTER}"))
def dq_good(lake):
    """FLT-4/PRJ-5: untagged rows without the tag column; the oracle is the plain filter, so this
    also checks that tag IS NULL exactly when the filter is TRUE."""
    return qu.good(lake.tagged())


@query("dq_rejected", with_(B + [o.TAGGED], "SELECT * FROM tagged WHERE rejection_reason IS NOT NULL"))
def dq_rejected(lake):
    """FLT-5: tagged rows."""
    return qu.rejected(lake.tagged())


_RULE_SQL = [
    ("null_pickup_datetime", "pickup_datetime IS NULL"),
    ("null_pu_location", "PULocationID IS NULL"),
    ("null_do_location", "DOLocationID IS NULL"),
    ("invalid_timestamps", "dropoff_datetime IS NULL OR dropoff_datetime <= pickup_datetime"),
    ("zero_trip_miles", "trip_miles IS NULL OR trip_miles <= 0"),
    ("excessive_trip_miles", "trip_miles >= 200"),
    ("null_fare", "base_passenger_fare IS NULL"),
    ("zero_or_negative_fare", "base_passenger_fare <= 0"),
    ("excessive_fare", "base_passenger_fare >= 500"),
    ("zero_trip_time", "trip_time IS NULL OR trip_time <= 0"),
    ("excessive_trip_time", "trip_time >= 14400"),
]


@query("dq_rule_counts", with_(B, "\nUNION ALL\n".join(
    f"SELECT '{n}' AS rule, CAST({i + 1} AS INTEGER) AS rule_order, CAST(count_if({c}) AS BIGINT) AS failed_rows FROM trips"
    for i, (n, c) in enumerate(_RULE_SQL))))
def dq_rule_counts(lake):
    """FLT-10: rows failing each rule on its own, one pass."""
    return qu.rule_counts(lake.bronze(), thresholds=lake.thresholds)


@query("derived_columns", with_(B + [o.PROVIDER, o.DQ_OK, o.DERIVED], "SELECT * FROM derived"))
def derived_columns(lake):
    """PRJ-3/SCL-1..9: the 8 derived columns on quality-filtered provider trips."""
    return lake.derived()


@query("speed_filter", with_(B + [o.PROVIDER, o.DQ_OK, o.DERIVED, o.SANE], "SELECT * FROM sane"))
def speed_filter(lake):
    """FLT-6: speed NULL or <= 80 and duration in [1, 240]."""
    return dv.speed_filter(lake.derived(), lake.thresholds)


ENRICH_COLS = ["PULocationID", "DOLocationID", "pickup_datetime", "trip_miles", "trip_time", "pickup_borough",
               "pickup_zone", "pickup_service_zone", "dropoff_borough", "dropoff_zone", "dropoff_service_zone"]


@query("zone_enrichment", with_(S, f"SELECT {', '.join(ENRICH_COLS)} FROM curated"))
def zone_enrichment(lake):
    """JOI-1/JOI-2/PRJ-2: both trip ends left-joined to the zone dimension (size-checked broadcast)."""
    trips = dv.speed_filter(lake.derived(), lake.thresholds)
    return en.enrich(trips, lake.lookup(), checked=True).select(*ENRICH_COLS)


@query("curated_trips", with_(S, "SELECT * FROM curated"))
def curated_trips(lake):
    """PIP-1/PRJ-1: the 36-column silver table."""
    return lake.curated()


# ---------------------------------------------------------------- gold
@query("daily_borough_summary", with_(S + [o.DAILY], "SELECT * FROM daily"))
def daily_borough_summary(lake):
    """AGG-2: per date and pickup borough: trips, revenue and rounded averages."""
    return lake.daily()


@query("hourly_pattern_summary", with_(S + [o.HOURLY], "SELECT * FROM hourly"))
def hourly_pattern_summary(lake):
    """AGG-3/AGG-5: per hour, weekend flag, borough and shared flag."""
    return lake.hourly()


@query("route_summary", with_(S + [o.ROUTES], "SELECT * FROM routes"))
def route_summary(lake):
    """AGG-4/FLT-7: zone pairs with at least 10 trips, busiest first."""
    return lake.routes()


def _wide_price(k: str) -> str:
    return f"CAST(CAST(l_extendedprice * 1e9::DOUBLE AS VARCHAR) AS DECIMAL(38,6)){k}"


@query("wide_value_totals", f"""SELECT l_returnflag, l_linestatus, count(*) AS lines,
       CAST(round(CAST(sum({_wide_price('')}) AS DECIMAL(38,6)), 2) AS DOUBLE) AS total_scaled_price,
       CAST(round(CAST(sum({_wide_price('')}) AS DECIMAL(38,6)), 2) AS DOUBLE) / count(*) > 1e12 AS above_limit
FROM lineitem GROUP BY 1, 2""")
def wide_value_totals(lake):
    """SCL-1 on values past 10^12: the exact sum of prices scaled by 10^9, none dropped."""
    lines = fixtures.read_table(lake.spark, lake.sf_dir, "lineitem")
    total = round_sum(F.col("l_extendedprice") * F.lit(1e9))
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines"), total.alias("total_scaled_price"),
        (total / F.count(F.lit(1)) > 1e12).alias("above_limit"))


# ---------------------------------------------------------------- reports
@query("stage_funnel", with_(S, f"""SELECT raw_rows, provider_rows,
       {pct('provider_rows', 'raw_rows', 1)} AS provider_share_pct,
       provider_rows - dq_rows AS removed_by_dq,
       {pct('provider_rows - dq_rows', 'provider_rows', 2)} AS removed_by_dq_pct,
       dq_rows, dq_rows - curated_rows AS removed_by_speed, curated_rows
FROM (SELECT (SELECT count(*) FROM trips) AS raw_rows, (SELECT count(*) FROM provider) AS provider_rows,
             (SELECT count(*) FROM dq_ok) AS dq_rows, (SELECT count(*) FROM sane) AS curated_rows)"""))
def stage_funnel(lake):
    """RPT-1/RPT-3/AGG-1: stage counts in one pass over the trips."""
    return rp.stage_funnel(lake.bronze(), lake.provider, lake.thresholds)


@query("transformation_summary", with_(S, f"""SELECT raw_rows, provider_rows, curated_rows,
       {pct('curated_rows', 'raw_rows', 1)} AS retention_pct, date_partitions,
       CAST(36 AS INTEGER) AS curated_columns
FROM (SELECT (SELECT count(*) FROM trips) AS raw_rows, (SELECT count(*) FROM provider) AS provider_rows,
             (SELECT count(*) FROM sane) AS curated_rows,
             (SELECT count(DISTINCT pickup_date) FROM curated) AS date_partitions)"""))
def transformation_summary(lake):
    """RPT-2/AGG-15: counts, retention, date partitions and column count."""
    return rp.transformation_summary(lake.bronze(), lake.provider, lake.thresholds)


_RATE = "CASE WHEN total > 0 THEN CAST(total - good AS DOUBLE) / total * 100 ELSE 0.0 END"


@query("dq_totals", with_(B + [o.TAGGED], f"""SELECT total, good, total - good AS rejected,
       {r(f'100.0::DOUBLE - ({_RATE})')} AS pass_rate_pct, {r(_RATE)} AS rejection_rate_pct
FROM (SELECT count(*) AS total, count(*) FILTER (WHERE rejection_reason IS NULL) AS good FROM tagged)"""))
def dq_totals(lake):
    """RPT-4/SCL-18: total, good, rejected, pass and rejection rates."""
    return rp.dq_totals(lake.tagged())


_BREAKDOWN = f"""SELECT g.rejection_reason, g.cnt AS record_count, {pct('g.cnt', 't.total', 4)} AS pct_of_total,
       'REJECTED' AS status
FROM (SELECT rejection_reason, count(*) AS cnt FROM tagged GROUP BY rejection_reason) g,
     (SELECT count(*) AS total FROM tagged) t
WHERE g.rejection_reason IS NOT NULL"""


@query("rejection_breakdown", with_(B + [o.TAGGED], _BREAKDOWN))
def rejection_breakdown(lake):
    """AGG-7/AGG-8: rejected rows per reason with their share of all rows."""
    return rp.rejection_breakdown(lake.tagged())


@query("quality_summary", with_(B + [o.TAGGED], f"""SELECT 'PASSED_ALL_RULES' AS rejection_reason, good AS record_count,
       {r(f'100.0::DOUBLE - ({_RATE})', 4)} AS pct_of_total, 'PASSED' AS status
FROM (SELECT count(*) AS total, count(*) FILTER (WHERE rejection_reason IS NULL) AS good FROM tagged)
UNION ALL
{_BREAKDOWN}"""))
def quality_summary(lake):
    """RPT-5/SET-1/SRT-3/PRJ-4: PASSED row plus one row per reason."""
    return rp.quality_summary(lake.tagged())


@query("dq_job_summary", ORACLE["quality_summary"])
def dq_job_summary(lake):
    """PIP-3: the quality job's written summary, rejected rows written and read back."""
    return md.dq_check(lake.spark, lake.bronze_path, _run_dir(lake, "rejected"), _run_dir(lake, "quality_summary"),
                       lake.thresholds)


@query("monthly_dq", with_(B + [o.TAGGED], f"""SELECT month, total, good, rejected,
       {pct('rejected', 'total', 2)} AS rejection_rate_pct
FROM (SELECT strftime(pickup_datetime, '%Y-%m') AS month, count(*) AS total,
             count(*) FILTER (WHERE rejection_reason IS NULL) AS good,
             count(*) FILTER (WHERE rejection_reason IS NOT NULL) AS rejected
      FROM tagged GROUP BY 1)"""))
def monthly_dq(lake):
    """RPT-6/AGG-6: quality by pickup month."""
    return rp.monthly_dq(lake.tagged())


@query("quality_job_reports", with_(B + [o.TAGGED], """SELECT month, hvfhs_license_num, total, good, dq_set FROM (
  SELECT month, hvfhs_license_num, count(*) AS total, count(*) FILTER (WHERE rejection_reason IS NULL) AS good,
         CAST(GROUPING(month, hvfhs_license_num) AS BIGINT) AS dq_set
  FROM (SELECT strftime(pickup_datetime, '%Y-%m') AS month, hvfhs_license_num, rejection_reason FROM tagged)
  GROUP BY GROUPING SETS ((month), (hvfhs_license_num), ()))"""))
def quality_job_reports(lake):
    """PIP-3 (RPT-4, RPT-6, AGG-9, AGG-11): every report of the quality job from one scan, as grouping sets."""
    return rp.dq_one_pass(lake.tagged())


@query("monthly_raw_counts", with_(B, "SELECT strftime(pickup_datetime, '%Y-%m') AS month, count(*) AS trip_count FROM trips GROUP BY 1"))
def monthly_raw_counts(lake):
    """AGG-9/SCL-10: raw trips per pickup month."""
    return rp.monthly_counts(lake.bronze(), "pickup_datetime")


@query("monthly_curated_counts", with_(S, "SELECT strftime(pickup_date, '%Y-%m') AS month, count(*) AS trip_count FROM curated GROUP BY 1"))
def monthly_curated_counts(lake):
    """AGG-10: curated trips per pickup month."""
    return rp.monthly_counts(lake.curated(), "pickup_date")


@query("provider_breakdown", with_(B, "SELECT hvfhs_license_num, count(*) AS trip_count FROM trips GROUP BY 1"))
def provider_breakdown(lake):
    """AGG-11: trips per provider licence."""
    return rp.provider_breakdown(lake.bronze())


@query("borough_distribution", with_(S, f"""SELECT pickup_borough, count(*) AS trip_count FROM curated GROUP BY 1
ORDER BY trip_count DESC, pickup_borough {NF} LIMIT 10"""))
def borough_distribution(lake):
    """AGG-12: top 10 pickup boroughs."""
    return rp.borough_distribution(lake.curated())


@query("shared_breakdown", with_(S, "SELECT is_shared_ride AS shared, count(*) AS trip_count FROM curated GROUP BY 1"))
def shared_breakdown(lake):
    """AGG-13: shared vs solo trips."""
    return rp.shared_breakdown(lake.curated())


@query("fare_statistics", with_(S, f"""SELECT {avg2('base_passenger_fare')} AS avg_fare,
       {r('min(base_passenger_fare)')} AS min_fare, {r('max(base_passenger_fare)')} AS max_fare,
       {avg2('trip_miles')} AS avg_miles, {avg2('trip_duration_minutes')} AS avg_duration_min,
       {avg2('wait_time_minutes')} AS avg_wait_min
FROM curated"""))
def fare_statistics(lake):
    """AGG-14/PRJ-7: fare and trip statistics."""
    return rp.fare_statistics(lake.curated())


@query("daily_coverage", with_(S + [o.DAILY], """SELECT min(pickup_date) AS earliest_date, max(pickup_date) AS latest_date,
       count(DISTINCT pickup_date) AS distinct_dates, count(DISTINCT pickup_borough) AS distinct_boroughs FROM daily"""))
def daily_coverage(lake):
    """AGG-16/DST-1: date range and distinct counts of the daily table."""
    return rp.daily_coverage(lake.gold("daily"))


@query("borough_revenue_rank", with_(S + [o.DAILY], f"""SELECT pickup_borough, {sum2('total_revenue')} AS total_6m_revenue,
       CAST(sum(total_trips) AS BIGINT) AS total_6m_trips
FROM daily GROUP BY 1 ORDER BY total_6m_revenue DESC, pickup_borough {NF} LIMIT 6"""))
def borough_revenue_rank(lake):
    """AGG-17: revenue per borough re-aggregated from the daily table; top 6."""
    return rp.borough_revenue_rank(lake.gold("daily"))


@query("shared_vs_solo_metrics", with_(S + [o.HOURLY], f"""SELECT is_shared_ride, {avg2('avg_fare')} AS avg_fare,
       {avg2('avg_wait_time_minutes')} AS avg_wait_min, {avg2('avg_tip_percentage')} AS avg_tip_pct,
       CAST(sum(total_trips) AS BIGINT) AS total_trips
FROM hourly GROUP BY 1"""))
def shared_vs_solo_metrics(lake):
    """AGG-18: unweighted averages of the hourly averages by shared flag."""
    return rp.shared_vs_solo_metrics(lake.gold("hourly"))


@query("top_revenue_days", with_(S + [o.DAILY], f"""SELECT * FROM daily
ORDER BY total_revenue DESC, pickup_date, pickup_borough {NF} LIMIT 10"""))
def top_revenue_days(lake):
    """TOP-1: ten (date, borough) rows with the most revenue."""
    return rp.top_revenue_days(lake.gold("daily"))


_ROUTE_ORDER = f"total_trips DESC, pickup_borough {NF}, pickup_zone {NF}, dropoff_borough {NF}, dropoff_zone {NF}"


@query("top_routes", with_(S + [o.ROUTES], f"SELECT * FROM routes ORDER BY {_ROUTE_ORDER} LIMIT 10"))
def top_routes(lake):
    """TOP-2: ten busiest routes."""
    return rp.top_routes(lake.gold("routes"))


@query("weekday_borough_hours", with_(S + [o.HOURLY], f"SELECT * FROM hourly WHERE pickup_borough = '{BOROUGH}' AND is_weekend = 0"))
def weekday_borough_hours(lake):
    """FLT-8: one borough's weekday hours."""
    return rp.weekday_borough_hours(lake.gold("hourly"), BOROUGH)


# ---------------------------------------------------------------- zone dimension
ZNA = [o.ZONES, o.ZONES_NA]


@query("zone_sample", with_([o.ZONES], "SELECT * FROM zones ORDER BY LocationID LIMIT 5"))
def zone_sample(lake):
    """TOP-3: first five zones by id."""
    return zn.zone_sample(lake.zones())


@query("zones_per_borough", with_(ZNA, "SELECT Borough, count(Zone) AS zone_count FROM zones_na WHERE Borough IS NOT NULL GROUP BY 1"))
def zones_per_borough(lake):
    """AGG-19: zones per borough (pandas semantics)."""
    return zn.zones_per_borough(lake.zones_na())


@query("zones_per_service_zone", with_(ZNA, "SELECT service_zone, count(Zone) AS zone_count FROM zones_na WHERE service_zone IS NOT NULL GROUP BY 1"))
def zones_per_service_zone(lake):
    """AGG-20: zones per service zone (pandas semantics)."""
    return zn.zones_per_service_zone(lake.zones_na())


@query("top_borough", with_(ZNA, """SELECT Borough AS borough, count(Zone) AS zone_count FROM zones_na
WHERE Borough IS NOT NULL GROUP BY 1 ORDER BY zone_count DESC, borough LIMIT 1"""))
def top_borough(lake):
    """AGG-21: borough with the most zones."""
    return zn.top_borough(lake.zones_na())


@query("zone_totals", with_(ZNA, "SELECT count(*) AS total_zones, count(DISTINCT Borough) AS total_boroughs FROM zones_na"))
def zone_totals(lake):
    """AGG-22: zone rows and borough groups."""
    return zn.zone_totals(lake.zones_na())


def _text(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), 'null')"


_ZONE_COUNTS = "\nUNION ALL\n".join(
    f"""SELECT '{section}' AS section, {col} AS "key", CAST(count(Zone) AS VARCHAR) AS "value" FROM zones_na
WHERE {col} IS NOT NULL GROUP BY {col}""" for section, col in (("zones_per_borough", "Borough"),
                                                             ("zones_per_service_zone", "service_zone")))


@query("zone_summary", with_(ZNA, f"""SELECT 'totals' AS section, 'total_zones' AS "key", CAST(count(*) AS VARCHAR) AS "value" FROM zones_na
UNION ALL SELECT 'totals', 'total_boroughs', CAST(count(DISTINCT Borough) AS VARCHAR) FROM zones_na
UNION ALL SELECT 'borough_with_most_zones', Borough, CAST(n AS VARCHAR) FROM
  (SELECT Borough, count(Zone) AS n FROM zones_na WHERE Borough IS NOT NULL GROUP BY 1 ORDER BY n DESC, Borough LIMIT 1)
UNION ALL {_ZONE_COUNTS}
UNION ALL SELECT 'sample_records', {_text('LocationID')},
  {_text('Borough')} || '|' || {_text('Zone')} || '|' || {_text('service_zone')}
FROM (SELECT * FROM zones_na ORDER BY LocationID LIMIT 5)"""))
def zone_summary(lake):
    """RPT-8/PIP-4: the one-row summary document (maps, array, structs), as flat rows."""
    return zn.zone_summary_rows(zn.zone_summary(lake.zones_na(), ZONE_SOURCE, GENERATED_AT))


@query("zone_summary_json", o.zone_summary_json(GENERATED_AT, ZONE_SOURCE))
def zone_summary_json(lake):
    """SNK-4/JSN-1: the summary as one JSON string."""
    return zn.zone_summary_json(zn.zone_summary(lake.zones_na(), ZONE_SOURCE, GENERATED_AT))


# ---------------------------------------------------------------- saved SQL queries
@query("saved_q1_daily_revenue", with_(S + [o.DAILY], "SELECT pickup_date, pickup_borough, total_trips, total_revenue, avg_fare FROM daily"))
def saved_q1(lake):
    """SQL-1: daily revenue trend by borough."""
    return saved.q1_daily_revenue(lake.gold("daily"))


@query("saved_q2_rush_hour", with_(S + [o.HOURLY], f"""SELECT pickup_hour, is_weekend, is_shared_ride, total_trips, avg_fare,
       avg_speed_mph, avg_wait_time_minutes FROM hourly WHERE pickup_borough = '{BOROUGH}'"""))
def saved_q2(lake):
    """SQL-2: rush-hour pattern of one borough."""
    return saved.q2_rush_hour(lake.gold("hourly"), BOROUGH)


@query("saved_q3_tipping", with_(S + [o.HOURLY], f"""SELECT pickup_hour, is_shared_ride, CAST(sum(total_trips) AS BIGINT) AS trips,
       {avg2('avg_tip_percentage')} AS avg_tip_pct, {avg2('avg_fare')} AS avg_fare
FROM hourly GROUP BY 1, 2"""))
def saved_q3(lake):
    """SQL-3: tipping by hour and ride type."""
    return saved.q3_tipping(lake.gold("hourly"))


@query("saved_q4_top_routes", with_(S + [o.ROUTES], f"""SELECT pickup_zone, dropoff_zone, pickup_borough, dropoff_borough,
       total_trips, avg_fare, avg_trip_miles, avg_trip_duration_minutes
FROM routes ORDER BY {_ROUTE_ORDER} LIMIT 10"""))
def saved_q4(lake):
    """SQL-4: top ten routes."""
    return saved.q4_top_routes(lake.gold("routes"))


_ZL = ", ".join(f"'{z}'" for z in SPECIAL_ZONES)


@query("saved_q5_special_zone_routes", with_(S + [o.ROUTES], f"""SELECT pickup_zone, dropoff_zone, total_trips, avg_fare, avg_trip_miles
FROM routes WHERE pickup_zone IN ({_ZL}) OR dropoff_zone IN ({_ZL})"""))
def saved_q5(lake):
    """SQL-5/FLT-9: routes touching the given zones."""
    return saved.q5_special_zone_routes(lake.gold("routes"), SPECIAL_ZONES)


@query("saved_q6_monthly_revenue", with_(S + [o.DAILY], f"""SELECT CAST(date_trunc('month', pickup_date) AS DATE) AS month,
       pickup_borough, CAST(sum(total_trips) AS BIGINT) AS monthly_trips,
       {sum2('total_revenue')} AS monthly_revenue, {avg2('avg_fare')} AS avg_fare
FROM daily GROUP BY 1, 2"""))
def saved_q6(lake):
    """SQL-6/SCL-11: monthly revenue by borough."""
    return saved.q6_monthly_revenue(lake.gold("daily"))


@query("saved_q7_wait", with_(S + [o.HOURLY], f"""SELECT pickup_borough, is_shared_ride, CAST(sum(total_trips) AS BIGINT) AS total_trips,
       {avg2('avg_wait_time_minutes')} AS avg_wait_min FROM hourly GROUP BY 1, 2"""))
def saved_q7(lake):
    """SQL-7: wait by ride type and borough."""
    return saved.q7_wait(lake.gold("hourly"))


# ---------------------------------------------------------------- validation
def _validate_gold_sql() -> str:
    from tiertrip import schemas
    parts = []
    for name, cte, schema in (("daily", "daily", schemas.DAILY), ("hourly", "hourly", schemas.HOURLY),
                              ("routes", "routes", schemas.ROUTE)):
        k = len(schema.fields)
        parts.append(f"""SELECT '{name}' AS "table", count(*) AS rows_written, count(*) AS rows_read,
       {k} AS columns, {k} AS expected_columns, 'OK' AS status FROM {cte}""")
    return with_(S + [o.DAILY, o.HOURLY, o.ROUTES], "\nUNION ALL\n".join(parts))


@query("validate_gold", _validate_gold_sql())
def validate_gold(lake):
    """RPT-7: write the three gold tables, read them back, compare rows and columns. The oracle
    states the expected report: every table holds one row per group of its rollup."""
    out = md.GoldPaths(_run_dir(lake, "gold/daily"), _run_dir(lake, "gold/hourly"), _run_dir(lake, "gold/routes"))
    written = md.write_gold_one_pass(lake.spark, lake.curated(), out, lake.thresholds)
    return md.validate_gold(lake.spark, out, written)


@query("silver_partitions", with_(S, "SELECT pickup_date, count(*) AS rows_written, count(*) AS rows_read FROM curated GROUP BY 1"))
def silver_partitions(lake):
    """RPT-7/SNK-3: rows of each silver partition as the write counted them, and as they are read back."""
    path = _run_dir(lake, "silver")
    _, parts = write_counted(lake.curated(), path, "pickup_date")
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.col("key"))
    wrote = lake.spark.createDataFrame(sorted(parts.items()), "key int, rows_written long").select(day.alias("pickup_date"), "rows_written")
    found = readers.scan_curated(lake.spark, path).groupBy("pickup_date").agg(F.count(F.lit(1)).alias("rows_read"))
    return wrote.join(found, "pickup_date", "full")


@query("catalog_daily", with_(S + [o.DAILY], "SELECT * FROM daily"))
def catalog_daily(lake):
    """SNK-9: daily gold registered with its first partitions, and again after the others were written beside them;
    read by its table name."""
    path, split = _run_dir(lake, "daily"), F.dayofmonth("pickup_date") <= 10
    for part in (split, ~split):
        write_partitioned(lake.gold("daily").where(part), path, "pickup_date", dynamic=True)
        name = catalog.register_table(lake.spark, "default", f"daily_{path.rsplit('/', 2)[-2]}", path, partitioned=True)
    return lake.spark.table(name).select(*schemas.DAILY.fieldNames())
