"""Role-playing zone lookup: the same dimension joined once per trip end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLE_KEYS = {"pickup": "PULocationID", "dropoff": "DOLocationID"}


class DuplicateKeyError(ValueError):
    pass


def validate_dimension(zones: DataFrame, key: str = "LocationID") -> int:
    """Check the lookup has a unique non-NULL key (so a left join cannot multiply trips) and
    return its row count. One small aggregate over the dimension; the fact table is not touched."""
    stats = zones.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.col(key)).alias("k"),
                      F.count(F.col(key)).alias("nn")).first()
    if stats["k"] != stats["nn"]:
        raise DuplicateKeyError(f"zone dimension has duplicate {key} values ({stats['nn']} rows, {stats['k']} keys)")
    return int(stats["n"])


def check_dimension(zones: DataFrame, key: str = "LocationID") -> DataFrame:
    """Validate the lookup and return it. No hint: Catalyst and AQE broadcast it while its measured
    size is under ``spark.sql.autoBroadcastJoinThreshold``, and plan a shuffle join otherwise."""
    validate_dimension(zones, key)
    return zones


def zones_as(zones: DataFrame, role: str) -> DataFrame:
    """Rename the dimension for one role: ``LocationID -> PULocationID``, ``Borough -> pickup_borough`` ..."""
    return zones.select(
        F.col("LocationID").try_cast("int").alias(ROLE_KEYS[role]),
        F.col("Borough").alias(f"{role}_borough"),
        F.col("Zone").alias(f"{role}_zone"),
        F.col("service_zone").alias(f"{role}_service_zone"),
    )


def enrich(trips: DataFrame, zones: DataFrame, checked: bool = False) -> DataFrame:
    """Left-join both trip ends to the zone dimension; unmatched ids keep the trip with NULL names, and
    an id that is no int becomes NULL."""
    dim = zones if checked else check_dimension(zones)
    out = trips
    for role, key in ROLE_KEYS.items():
        out = out.withColumn(key, F.col(key).try_cast("int")).join(zones_as(dim, role), on=key, how="left")
    return out
