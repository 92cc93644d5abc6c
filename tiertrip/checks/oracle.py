"""DuckDB restatement of every registered query, for the correctness gate.

The SQL is written independently of the Spark code: its own CASE chains, its own joins, the raw
10-conjunct filter instead of the rule list. Every statement derives the trips from the
pre-registered ``lineitem``/``nation``/``region`` views as CTEs.

Rounding follows the recipe in tiertrip.functions.numeric: averages and sums in DECIMAL(18,6),
and half-up rounding of a double's decimal text (the VARCHAR detour), which is how Spark rounds.
"""

from __future__ import annotations


def r(x: str, n: int = 2) -> str:
    """Half-up rounding of a double by its decimal text."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,17)), {n}) AS DOUBLE)"


def avg2(x: str, n: int = 2) -> str:
    return f"CAST(round(CAST(CAST(avg(CAST(({x}) AS DECIMAL(18,6))) AS VARCHAR) AS DECIMAL(38,17)), {n}) AS DOUBLE)"


def sum2(x: str, n: int = 2) -> str:
    return f"CAST(round(CAST(sum(CAST(({x}) AS DECIMAL(18,6))) AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def pct(part: str, whole: str, n: int) -> str:
    return r(f"CAST({part} AS DOUBLE) / {whole} * 100", n)


def at(e: str) -> str:
    return f"(TIMESTAMP '2024-01-01 00:00:00' + to_seconds({e}))"


LI = """li AS (
  SELECT l_returnflag, l_suppkey, l_partkey, l_linenumber, l_quantity, l_discount,
         l_orderkey*31 + l_partkey*17 + l_suppkey*7 + l_linenumber AS m,
         (l_orderkey % 182)*86400 + (l_orderkey*7919 + l_partkey*104729 + l_linenumber*31) % 86400 AS p,
         20 + (l_partkey*37 + l_suppkey*101) % 5400 AS tt,
         floor(l_extendedprice) AS fp
  FROM lineitem)"""

TRIPS = f"""trips AS (
  SELECT
    CASE WHEN l_returnflag = 'R' THEN 'HV0003' ELSE 'HV0005' END AS hvfhs_license_num,
    'B' || CAST(10000 + l_suppkey AS VARCHAR) AS dispatching_base_num,
    CASE WHEN m % 37 = 0 THEN NULL ELSE 'B' || CAST(10000 + l_suppkey AS VARCHAR) END AS originating_base_num,
    CASE WHEN m % 13 = 0 THEN NULL ELSE {at("p - (l_suppkey*11) % 900")} END AS request_datetime,
    CASE WHEN m % 211 = 0 THEN NULL ELSE {at("p")} END AS pickup_datetime,
    CASE WHEN m % 233 = 0 THEN NULL WHEN m % 229 = 0 THEN {at("p - 60")} ELSE {at("p + tt")} END AS dropoff_datetime,
    CAST(CASE WHEN m % 223 = 0 THEN NULL ELSE (l_suppkey*13 + l_linenumber) % 27 END AS BIGINT) AS PULocationID,
    CAST(CASE WHEN m % 227 = 0 THEN NULL WHEN m % 50 = 0 THEN m % 27 ELSE l_partkey % 9 END AS BIGINT) AS DOLocationID,
    CAST(CASE WHEN m % 239 = 0 THEN NULL WHEN m % 241 = 0 THEN 0 WHEN m % 251 = 0 THEN 250
              ELSE l_quantity / 4.0::DOUBLE END AS DOUBLE) AS trip_miles,
    CAST(CASE WHEN m % 271 = 0 THEN NULL WHEN m % 277 = 0 THEN 0 WHEN m % 281 = 0 THEN 20000 ELSE tt END AS BIGINT) AS trip_time,
    CAST(CASE WHEN m % 257 = 0 THEN NULL WHEN m % 263 = 0 THEN -5 WHEN m % 269 = 0 THEN 750
              ELSE fp / 512.0::DOUBLE END AS DOUBLE) AS base_passenger_fare,
    CAST(CASE WHEN m % 9 = 0 THEN 6.5 ELSE 0 END AS DOUBLE) AS tolls,
    fp / 16384.0::DOUBLE AS bcf,
    fp / 8192.0::DOUBLE AS sales_tax,
    CAST(CASE WHEN m % 2 = 0 THEN 2.75 ELSE 0 END AS DOUBLE) AS congestion_surcharge,
    CAST(CASE WHEN m % 20 = 0 THEN 2.5 ELSE 0 END AS DOUBLE) AS airport_fee,
    l_discount * 10.0::DOUBLE AS tips,
    fp / 1024.0::DOUBLE AS driver_pay,
    CASE WHEN l_linenumber >= 6 THEN 'Y' ELSE 'N' END AS shared_request_flag,
    CASE WHEN l_linenumber = 7 THEN 'Y' WHEN m % 31 = 0 THEN NULL ELSE 'N' END AS shared_match_flag,
    ' ' AS access_a_ride_flag,
    CASE WHEN m % 40 = 0 THEN 'Y' ELSE 'N' END AS wav_request_flag,
    CASE WHEN m % 80 = 0 THEN 'Y' ELSE 'N' END AS wav_match_flag
  FROM li)"""

ZONES = """zones AS (
  SELECT CAST(n_nationkey AS INTEGER) AS LocationID,
         CASE WHEN n_nationkey = 24 THEN 'N/A' ELSE r_name END AS Borough,
         CASE WHEN n_nationkey = 23 THEN 'N/A' ELSE n_name END AS Zone,
         CASE n_regionkey WHEN 0 THEN 'Boro Zone' WHEN 1 THEN 'Yellow Zone' WHEN 2 THEN 'Airports'
                          WHEN 3 THEN 'EWR' ELSE 'N/A' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

NA_LIST = ("'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
           "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'")

ZONES_NA = f"""zones_na AS (
  SELECT LocationID,
         CASE WHEN Borough IN ({NA_LIST}) THEN NULL ELSE Borough END AS Borough,
         CASE WHEN Zone IN ({NA_LIST}) THEN NULL ELSE Zone END AS Zone,
         CASE WHEN service_zone IN ({NA_LIST}) THEN NULL ELSE service_zone END AS service_zone
  FROM zones)"""

GOOD_FILTER = """trip_miles > 0 AND trip_miles < 200
    AND base_passenger_fare > 0 AND base_passenger_fare < 500
    AND trip_time > 0 AND trip_time < 14400
    AND pickup_datetime IS NOT NULL AND dropoff_datetime > pickup_datetime
    AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL"""

PROVIDER = "provider AS (SELECT * FROM trips WHERE hvfhs_license_num = 'HV0005')"

DQ_OK = f"dq_ok AS (SELECT * FROM provider WHERE {GOOD_FILTER})"

DERIVED = f"""derived0 AS (
  SELECT *,
    {r("trip_time / 60.0::DOUBLE")} AS trip_duration_minutes,
    CAST(pickup_datetime AS DATE) AS pickup_date,
    CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
    CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS pickup_day_of_week,
    CASE WHEN dayofweek(pickup_datetime) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN shared_match_flag = 'Y' THEN 1 ELSE 0 END AS is_shared_ride,
    CASE WHEN request_datetime IS NOT NULL
         THEN {r("(epoch(pickup_datetime) - epoch(request_datetime)) / 60.0::DOUBLE")} END AS wait_time_minutes
  FROM dq_ok),
derived AS (
  SELECT *, CASE WHEN trip_duration_minutes > 0
                 THEN {r("trip_miles / (trip_duration_minutes / 60.0::DOUBLE)")} END AS speed_mph
  FROM derived0)"""

SANE = """sane AS (
  SELECT * FROM derived
  WHERE (speed_mph IS NULL OR speed_mph <= 80) AND trip_duration_minutes >= 1 AND trip_duration_minutes <= 240)"""

CURATED_COLS = """d.request_datetime, d.pickup_datetime, d.dropoff_datetime, d.pickup_date, d.pickup_hour,
    d.pickup_day_of_week, d.is_weekend, d.trip_miles, d.trip_time, d.trip_duration_minutes, d.speed_mph,
    d.is_shared_ride, d.wait_time_minutes,
    CAST(d.PULocationID AS INTEGER) AS PULocationID, pz.Borough AS pickup_borough, pz.Zone AS pickup_zone,
    pz.service_zone AS pickup_service_zone,
    CAST(d.DOLocationID AS INTEGER) AS DOLocationID, dz.Borough AS dropoff_borough, dz.Zone AS dropoff_zone,
    dz.service_zone AS dropoff_service_zone,
    d.base_passenger_fare, d.tolls, d.bcf, d.sales_tax, d.congestion_surcharge, d.airport_fee, d.tips,
    d.driver_pay, d.dispatching_base_num, d.originating_base_num, d.shared_request_flag, d.shared_match_flag,
    d.access_a_ride_flag, d.wav_request_flag, d.wav_match_flag"""

CURATED = f"""curated AS (
  SELECT {CURATED_COLS}
  FROM sane d
  LEFT JOIN zones pz ON CAST(d.PULocationID AS INTEGER) = pz.LocationID
  LEFT JOIN zones dz ON CAST(d.DOLocationID AS INTEGER) = dz.LocationID)"""

DAILY = f"""daily AS (
  SELECT pickup_date, pickup_borough, count(*) AS total_trips,
         {sum2("base_passenger_fare")} AS total_revenue,
         {avg2("base_passenger_fare")} AS avg_fare,
         {avg2("tips")} AS avg_tip,
         {avg2("trip_miles")} AS avg_trip_miles,
         {avg2("trip_duration_minutes")} AS avg_trip_duration_minutes,
         {avg2("speed_mph")} AS avg_speed_mph
  FROM curated GROUP BY pickup_date, pickup_borough)"""

HOURLY = f"""hourly AS (
  SELECT pickup_hour, is_weekend, pickup_borough, is_shared_ride, count(*) AS total_trips,
         {avg2("base_passenger_fare")} AS avg_fare,
         {avg2("trip_miles")} AS avg_trip_miles,
         {avg2("CASE WHEN base_passenger_fare > 0 THEN tips / base_passenger_fare * 100.0::DOUBLE END")} AS avg_tip_percentage,
         {avg2("speed_mph")} AS avg_speed_mph,
         {avg2("wait_time_minutes")} AS avg_wait_time_minutes
  FROM curated GROUP BY pickup_hour, is_weekend, pickup_borough, is_shared_ride)"""

ROUTES = f"""routes AS (
  SELECT pickup_borough, pickup_zone, dropoff_borough, dropoff_zone, count(*) AS total_trips,
         {avg2("base_passenger_fare")} AS avg_fare,
         {avg2("trip_miles")} AS avg_trip_miles,
         {avg2("trip_duration_minutes")} AS avg_trip_duration_minutes
  FROM curated GROUP BY pickup_borough, pickup_zone, dropoff_borough, dropoff_zone
  HAVING count(*) >= 10)"""

TAGGED = """tagged AS (
  SELECT *, CASE
      WHEN pickup_datetime IS NULL THEN 'null_pickup_datetime'
      WHEN PULocationID IS NULL THEN 'null_pu_location'
      WHEN DOLocationID IS NULL THEN 'null_do_location'
      WHEN dropoff_datetime IS NULL OR dropoff_datetime <= pickup_datetime THEN 'invalid_timestamps'
      WHEN trip_miles IS NULL OR trip_miles <= 0 THEN 'zero_trip_miles'
      WHEN trip_miles >= 200 THEN 'excessive_trip_miles'
      WHEN base_passenger_fare IS NULL THEN 'null_fare'
      WHEN base_passenger_fare <= 0 THEN 'zero_or_negative_fare'
      WHEN base_passenger_fare >= 500 THEN 'excessive_fare'
      WHEN trip_time IS NULL OR trip_time <= 0 THEN 'zero_trip_time'
      WHEN trip_time >= 14400 THEN 'excessive_trip_time'
      ELSE NULL END AS rejection_reason
  FROM trips)"""

BASE = [LI, TRIPS]
SILVER = BASE + [ZONES, PROVIDER, DQ_OK, DERIVED, SANE, CURATED]


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def zone_summary_json(generated_at: str, source: str) -> str:
    """RPT-8 + JSN-1 restated: one JSON string built from scalar subqueries over ``zones_na``."""
    return with_([ZONES, ZONES_NA], f"""
, per_b AS (SELECT Borough AS k, count(Zone) AS v FROM zones_na WHERE Borough IS NOT NULL GROUP BY 1)
, per_s AS (SELECT service_zone AS k, count(Zone) AS v FROM zones_na WHERE service_zone IS NOT NULL GROUP BY 1)
, top AS (SELECT k AS borough, v AS zone_count FROM per_b ORDER BY v DESC, k LIMIT 1)
, samp AS (SELECT * FROM zones_na ORDER BY LocationID NULLS LAST, Zone LIMIT 5)
SELECT CAST(to_json(struct_pack(
  generated_at := '{generated_at}',
  source := '{source}',
  total_zones := (SELECT count(*) FROM zones_na),
  total_boroughs := (SELECT count(DISTINCT Borough) FROM zones_na),
  borough_with_most_zones := (SELECT struct_pack(borough := borough, zone_count := zone_count) FROM top),
  zones_per_borough := (SELECT map_from_entries(list(struct_pack(k := k, v := v) ORDER BY v DESC, k)) FROM per_b),
  zones_per_service_zone := (SELECT map_from_entries(list(struct_pack(k := k, v := v) ORDER BY v DESC, k)) FROM per_s),
  sample_records := (SELECT list(struct_pack(LocationID := LocationID, Borough := Borough, Zone := Zone,
                                             service_zone := service_zone) ORDER BY LocationID NULLS LAST, Zone)
                     FROM samp))) AS VARCHAR) AS json""")
