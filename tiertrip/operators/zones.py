"""Zone-dimension summary (the pandas job re-aimed as Spark aggregates).

Input is the dimension read with pandas NA semantics (``scan_zones_na``): NULL boroughs are not a
group and NULL zone names are not counted, so a borough whose zones are all NULL stays with 0.
All aggregates are over the dimension; maps and the sample are built from already-grouped or
already-limited rows, so no group ever holds more than one row per borough / service zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiertrip.sinks.writers import json_document


def zones_per(zones: DataFrame, key: str) -> DataFrame:
    """AGG-19/AGG-20: ``key, zone_count`` with NULL keys dropped, most zones first."""
    return (zones.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count("Zone").alias("zone_count"))
            .orderBy(F.col("zone_count").desc(), key))


def zones_per_borough(zones: DataFrame) -> DataFrame:
    return zones_per(zones, "Borough")


def zones_per_service_zone(zones: DataFrame) -> DataFrame:
    return zones_per(zones, "service_zone")


def top_borough(zones: DataFrame) -> DataFrame:
    """AGG-21: borough with most zones; a tie goes to the alphabetically first borough."""
    return (zones_per_borough(zones).limit(1)
            .select(F.col("Borough").alias("borough"), "zone_count"))


def zone_totals(zones: DataFrame) -> DataFrame:
    """AGG-22: all rows, and the number of (non-NULL) borough groups."""
    return zones.agg(F.count(F.lit(1)).alias("total_zones"),
                     F.count_distinct("Borough").alias("total_boroughs"))


def zone_sample(zones: DataFrame, n: int = 5) -> DataFrame:
    """TOP-3: the first n zones, by id (made deterministic)."""
    return zones.orderBy(F.col("LocationID").asc_nulls_last(), "Zone").limit(n)


def _as_map(counts: DataFrame, key: str) -> DataFrame:
    """One-row ``map<string,long>`` ordered most zones first (counts has one row per key)."""
    entries = F.array_sort(
        F.collect_list(F.struct((-F.col("zone_count")).alias("o"), F.col(key).alias("k"), F.col("zone_count").alias("v"))))
    return counts.agg(F.map_from_entries(
        F.transform(entries, lambda e: F.struct(e["k"], e["v"]))).alias("m"))


def zone_summary(zones: DataFrame, source: str, generated_at: str, sample: int = 5) -> DataFrame:
    """RPT-8: one row: generated_at, source, totals, top borough, two maps, sample records.

    Each part is a one-row frame; they are stacked with ``unionByName`` (missing columns NULL) and
    folded by one global ``first(ignorenulls)`` aggregate, so no join is needed."""
    totals = zone_totals(zones)
    top = top_borough(zones).select(F.struct("borough", "zone_count").alias("borough_with_most_zones"))
    by_borough = _as_map(zones_per(zones, "Borough"), "Borough").withColumnRenamed("m", "zones_per_borough")
    by_service = _as_map(zones_per(zones, "service_zone"), "service_zone").withColumnRenamed("m", "zones_per_service_zone")
    sample_rows = zone_sample(zones, sample).select(
        F.struct(F.col("LocationID"), "Borough", "Zone", "service_zone").alias("rec"))
    sample_arr = sample_rows.agg(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("rec.LocationID").alias("id"), F.col("rec").alias("rec")))),
        lambda e: e["rec"]).alias("sample_records"))
    parts = [totals, top, by_borough, by_service, sample_arr]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p, allowMissingColumns=True)
    cols = ["total_zones", "total_boroughs", "borough_with_most_zones", "zones_per_borough",
            "zones_per_service_zone", "sample_records"]
    folded = stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])
    return folded.select(F.lit(generated_at).alias("generated_at"), F.lit(source).alias("source"), *cols)


def zone_summary_rows(summary: DataFrame) -> DataFrame:
    """The summary document as flat rows ``section, key, value``; absent values are the text null."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit("null"))

    def row(section: str, key, value):
        return F.struct(F.lit(section).alias("section"), text(key).alias("key"), text(value).alias("value"))

    def pairs(section: str):
        return F.transform(F.map_entries(section), lambda e: row(section, e["key"], e["value"]))

    top = F.col("borough_with_most_zones")
    single = F.array(row("totals", F.lit("total_zones"), F.col("total_zones")),
                     row("totals", F.lit("total_boroughs"), F.col("total_boroughs")),
                     row("borough_with_most_zones", top["borough"], top["zone_count"]))
    sample = F.transform("sample_records", lambda r: row("sample_records", r["LocationID"], F.concat_ws(
        "|", text(r["Borough"]), text(r["Zone"]), text(r["service_zone"]))))
    every = F.concat(single, pairs("zones_per_borough"), pairs("zones_per_service_zone"), sample)
    return summary.select(F.explode(every).alias("r")).select("r.section", "r.key", "r.value")


def zone_summary_json(summary: DataFrame) -> DataFrame:
    """SNK-4 payload: the summary row as one JSON document string, as the sink writes it."""
    return json_document(summary)
