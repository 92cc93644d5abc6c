"""Trip-shaped bronze tables derived by Spark from the driver's TPC-H-style tables.

``lineitem`` becomes one trip per line over six months from 2024-01-01, with faults injected by
divisibility so every data-quality rule fires; ``nation`` joined to ``region`` becomes the zone
dimension. The derivation is a pure projection (no shuffle), and both results are written once
per input under the shared working folder, so every query starts from Parquet with an explicit
schema, the way the real bronze layer is read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiertrip import schemas
from tiertrip.config import MONTH_FILE_PREFIX, MONTH_FILE_SUFFIX
from tiertrip.session import list_path, path_exists, path_signature, remove_path, rename_path, scratch_path
from tiertrip.sinks.writers import files_open

FIXTURE_VERSION = "1"
EPOCH = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"


def _at(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, F.expr(EPOCH))


def _case(*branches: tuple[Column, Column], otherwise: Column) -> Column:
    out = None
    for cond, val in branches:
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(otherwise)




def _pickup_seconds() -> Column:
    ok, pk, ln = (F.col(c).cast("bigint") for c in ("l_orderkey", "l_partkey", "l_linenumber"))
    return (ok % 182) * 86400 + (ok * 7919 + pk * 104729 + ln * 31) % 86400


def trips_from_lineitem(lineitem: DataFrame, *keep: str) -> DataFrame:
    """Project ``lineitem`` to the 23 bronze trip columns (see FIXTURES.md), and ``keep`` as it is."""
    ok, pk, sk, ln = (F.col(c).cast("bigint") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    m = ok * 31 + pk * 17 + sk * 7 + ln
    p = _pickup_seconds()
    tt = 20 + (pk * 37 + sk * 101) % 5400
    price = F.floor("l_extendedprice")
    NULL = F.lit(None)

    def div(k: int) -> Column:
        return m % k == 0

    base = F.concat(F.lit("B"), (F.lit(10000) + sk).cast("string"))
    cols = {
        "hvfhs_license_num": F.when(F.col("l_returnflag") == "R", F.lit("HV0003")).otherwise(F.lit("HV0005")),
        "dispatching_base_num": base,
        "originating_base_num": F.when(div(37), NULL).otherwise(base),
        "request_datetime": F.when(div(13), NULL).otherwise(_at(p - (sk * 11) % 900)),
        "pickup_datetime": F.when(div(211), NULL).otherwise(_at(p)),
        "dropoff_datetime": _case((div(233), NULL), (div(229), _at(p - 60)), otherwise=_at(p + tt)),
        "PULocationID": F.when(div(223), NULL).otherwise((sk * 13 + ln) % 27),
        "DOLocationID": _case((div(227), NULL), (div(50), m % 27), otherwise=pk % 9),
        "trip_miles": _case((div(239), NULL), (div(241), F.lit(0.0)), (div(251), F.lit(250.0)),
                            otherwise=F.col("l_quantity") / 4),
        "trip_time": _case((div(271), NULL), (div(277), F.lit(0)), (div(281), F.lit(20000)), otherwise=tt),
        "base_passenger_fare": _case((div(257), NULL), (div(263), F.lit(-5.0)), (div(269), F.lit(750.0)),
                                     otherwise=price / 512),
        "tolls": F.when(div(9), F.lit(6.5)).otherwise(F.lit(0.0)),
        "bcf": price / 16384,
        "sales_tax": price / 8192,
        "congestion_surcharge": F.when(div(2), F.lit(2.75)).otherwise(F.lit(0.0)),
        "airport_fee": F.when(div(20), F.lit(2.5)).otherwise(F.lit(0.0)),
        "tips": F.col("l_discount") * 10,
        "driver_pay": price / 1024,
        "shared_request_flag": F.when(ln >= 6, F.lit("Y")).otherwise(F.lit("N")),
        "shared_match_flag": _case((ln == 7, F.lit("Y")), (div(31), NULL), otherwise=F.lit("N")),
        "access_a_ride_flag": F.lit(" "),
        "wav_request_flag": F.when(div(40), F.lit("Y")).otherwise(F.lit("N")),
        "wav_match_flag": F.when(div(80), F.lit("Y")).otherwise(F.lit("N")),
    }
    return lineitem.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in schemas.RAW_TRIP.fields], *keep)


def zones_from_nation(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Zone dimension: one row per nation (25 rows; ids 25 and 26 of the trips have no match)."""
    # Service zone by region key.
    service = _case(
        (F.col("n_regionkey") == 0, F.lit("Boro Zone")),
        (F.col("n_regionkey") == 1, F.lit("Yellow Zone")),
        (F.col("n_regionkey") == 2, F.lit("Airports")),
        (F.col("n_regionkey") == 3, F.lit("EWR")),
        otherwise=F.lit("N/A"),
    )
    # No hint: Catalyst broadcasts region only while its measured size is under
    # spark.sql.autoBroadcastJoinThreshold, and plans a shuffle join otherwise.
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey, "inner")
    return joined.select(
        F.col("n_nationkey").cast("int").alias("LocationID"),
        F.when(F.col("n_nationkey") == 24, F.lit("N/A")).otherwise(F.col("r_name")).alias("Borough"),
        F.when(F.col("n_nationkey") == 23, F.lit("N/A")).otherwise(F.col("n_name")).alias("Zone"),
        service.alias("service_zone"),
    )


def _input_key(spark: SparkSession, sf_dir: str, *tables: str) -> str:
    """Cache key of a derived fixture: the input files with their sizes and modification times."""
    h = hashlib.sha1(FIXTURE_VERSION.encode())
    for t in tables:
        path = f"{sf_dir.rstrip('/')}/{t}.parquet"
        h.update(path.encode())
        h.update(path_signature(spark, path).encode())
    return h.hexdigest()[:16]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze_trips_target(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the trip fixture, named by the files it is made from (it need not be there yet)."""
    return scratch_path(spark, "fixtures", _input_key(spark, sf_dir, "lineitem"), "fhvhv_tripdata")


def bronze_trips_path(spark: SparkSession, sf_dir: str) -> str:
    """Write the trip fixture once per input and return its folder (Parquet, RAW_TRIP schema)."""
    target = bronze_trips_target(spark, sf_dir)
    if not path_exists(spark, f"{target}/_SUCCESS"):
        trips_from_lineitem(_spread(read_table(spark, sf_dir, "lineitem"))).write.mode("overwrite").parquet(target)
    return target


def _spread(lines: DataFrame) -> DataFrame:
    """A small input of few row groups is spread over the cores, before its lines become wider trips. One that
    already runs on more than half of the cores is not shuffled: on small splits of a large input a core
    or two may be left over, which is no reason to move all rows."""
    cores = max(lines.sparkSession.sparkContext.defaultParallelism, 1)
    return lines.repartition(cores) if 2 * lines.rdd.getNumPartitions() <= cores else lines


def landing_path(spark: SparkSession, sf_dir: str) -> str:
    """Write the landing fixture once per input: the same trips, one Parquet folder per month, named as
    the monthly files are. A trip whose pickup time is NULL lies in the file of the month it was
    derived from. A task keeps a file open for each month and sorts nothing."""
    target = scratch_path(spark, "fixtures", _input_key(spark, sf_dir, "lineitem"), "landing")
    if not path_exists(spark, f"{target}/_SUCCESS"):
        lines = _spread(read_table(spark, sf_dir, "lineitem"))
        name = F.concat(F.lit(MONTH_FILE_PREFIX), F.date_format(_at(_pickup_seconds()), "yyyy-MM"), F.lit(MONTH_FILE_SUFFIX))
        build = f"{target}_building"
        remove_path(spark, target)
        trips = trips_from_lineitem(lines.withColumn("file", name), "file")
        with files_open(spark):
            trips.write.mode("overwrite").partitionBy("file").parquet(build)
        for path, _, _ in list_path(spark, build):
            part, eq, file = path.rsplit("/", 1)[-1].partition("=")
            if eq:
                rename_path(spark, path, f"{build}/{file}")
        rename_path(spark, build, target)
    return target


def zones_csv_path(spark: SparkSession, sf_dir: str) -> str:
    """Write the zone fixture once per input as CSV with header (the dimension's raw format)."""
    target = scratch_path(spark, "fixtures", _input_key(spark, sf_dir, "nation", "region"), "taxi_zone_lookup")
    if not path_exists(spark, f"{target}/_SUCCESS"):
        zones = zones_from_nation(read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region"))
        # A dimension of a few hundred rows: one file, as the source ships it.
        zones.coalesce(1).write.mode("overwrite").option("header", True).csv(target)
    return target
