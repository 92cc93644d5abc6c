"""Command line for the batch jobs over one lake root.

    python -m tiertrip raw-to-curated   --lake s3a://bucket/lake
    python -m tiertrip curated-to-gold  --lake ...
    python -m tiertrip dq-check         --lake ...
    python -m tiertrip zone-summary     --lake ... --generated-at 2024-07-01T00:00:00Z
    python -m tiertrip ingest           --lake ... --landing ... --as-of 2024-08-15 [--dry-run]
    python -m tiertrip register         --lake ...
    python -m tiertrip report           --lake ...           (silver and gold validation reports)
    python -m tiertrip saved-query      --lake ... --name q4 (saved SQL over the registered tables)

Layer paths come from :class:`tiertrip.config.LakePaths`; the Spark session is whatever
``spark-submit`` provides (only the UTC session zone is set, which the derivations assume).
"""

from __future__ import annotations

import argparse
import datetime
import json
import sys

from pyspark.sql import functions as F

from tiertrip.config import STATUS_FAILED, LakePaths
from tiertrip.plans import medallion as md
from tiertrip.session import clear_run, list_path
from tiertrip.sinks import catalog


def _session():
    from pyspark.sql import SparkSession
    spark = SparkSession.builder.appName("tiertrip").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _now() -> str:
    """The time of a run, as its result document records it; jobs themselves never read the clock."""
    return datetime.datetime.now(datetime.timezone.utc).isoformat()


def main(argv: list[str] | None = None) -> int:
    """Run one job. In a session that it started, the job's intermediate tables go when it ends."""
    from pyspark.sql import SparkSession
    own = SparkSession.getActiveSession() is None
    spark = _session()
    try:
        return _run(spark, argv)
    finally:
        if own:
            clear_run(spark)


def _run(spark, argv: list[str] | None) -> int:
    p = argparse.ArgumentParser(prog="tiertrip")
    p.add_argument("job", choices=["raw-to-curated", "curated-to-gold", "dq-check", "zone-summary", "ingest",
                                   "register", "report", "saved-query"])
    p.add_argument("--lake", required=True, help="lake root (raw/, curated/, aggregated/, rejected/, processed/)")
    p.add_argument("--source", default="nyctlc")
    p.add_argument("--landing", help="landing folder of monthly trip files (ingest)")
    p.add_argument("--zones-landing", help="zone CSV to land in the same run (ingest)")
    p.add_argument("--as-of", help="reference date for the month look-back (ingest)")
    p.add_argument("--start-offset", type=int, default=2)
    p.add_argument("--max-lookback", type=int, default=14)
    p.add_argument("--months", type=int, default=6)
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--generated-at", default="", help="timestamp recorded in the zone summary and the ingest result "
                                                      "(for ingest the clock if not given)")
    p.add_argument("--name", choices=[f"q{i}" for i in range(1, 8)], help="saved query (saved-query)")
    p.add_argument("--borough", default="Manhattan", help="borough of saved query q2")
    p.add_argument("--zones", default="JFK Airport,LaGuardia Airport", help="zones of saved query q5")
    a = p.parse_args(argv)
    lp = LakePaths(a.lake, a.source)
    if a.job == "raw-to-curated":
        out = md.raw_to_curated(spark, lp.path("trips_raw"), lp.path("zones_raw"), lp.path("curated"))
        print(json.dumps(out.__dict__))
    elif a.job == "curated-to-gold":
        gold = md.GoldPaths(lp.path("daily"), lp.path("hourly"), lp.path("routes"))
        md.curated_to_gold(spark, lp.path("curated"), gold).show(truncate=False)
    elif a.job == "dq-check":
        for df in md.dq_job(spark, lp.path("trips_raw"), lp.path("rejected"), lp.path("quality_summary")).values():
            df.show(truncate=False)
    elif a.job == "zone-summary":
        md.zone_summary_job(spark, lp.path("zones_raw"), lp.path("zone_summary"), a.generated_at)
    elif a.job == "ingest":
        if not (a.landing and a.as_of):
            p.error("ingest needs --landing and --as-of")
        manifest = md.ingest_job(spark, a.landing, lp.path("trips_raw"), a.as_of, a.start_offset, a.max_lookback,
                                 a.months, base_url=a.landing, dry_run=a.dry_run, zones_path=a.zones_landing,
                                 zones_target=lp.path("zones_raw"), manifest_path=lp.path("manifest"),
                                 history_path=lp.path("history"), run_at=a.generated_at or _now())
        manifest.show(truncate=False)
        return 1 if manifest.filter(F.col("status") == STATUS_FAILED).limit(1).count() else 0
    elif a.job == "register":
        print(catalog.register_table(spark, f"{a.source}_raw", "taxi_zone_lookup", lp.path("zones_raw"),
                                     csv_schema="LocationID INT, Borough STRING, Zone STRING, service_zone STRING"))
        by_month = any("=" in path.rsplit("/", 1)[-1] for path, _, _ in list_path(spark, lp.path("trips_raw")))
        for db, table, key, part in [
            (f"{a.source}_raw", "fhvhv_tripdata", "trips_raw", by_month),
            (f"{a.source}_curated", "fhvhv_trips_curated", "curated", True),
            (f"{a.source}_aggregated", "daily_borough_summary", "daily", True),
            (f"{a.source}_aggregated", "hourly_pattern_summary", "hourly", False),
            (f"{a.source}_aggregated", "route_summary", "routes", False),
            (f"{a.source}_rejected", "fhvhv_tripdata_rejected", "rejected", True),
            (f"{a.source}_rejected", "quality_summary", "quality_summary", False),
        ]:
            print(catalog.register_table(spark, db, table, lp.path(key), partitioned=part))
    elif a.job == "report":
        from tiertrip import schemas
        from tiertrip.operators import reports as rp
        from tiertrip.sources import readers
        silver = readers.scan_curated(spark, lp.path("curated"))
        daily = spark.read.schema(schemas.DAILY).parquet(lp.path("daily"))
        hourly = spark.read.schema(schemas.HOURLY).parquet(lp.path("hourly"))
        routes = spark.read.schema(schemas.ROUTE).parquet(lp.path("routes"))
        print(json.dumps({"curated_rows": md.footer_rows(spark, lp.path("curated")),
                          "date_partitions": md.partition_folders(spark, lp.path("curated"), "pickup_date")}))
        for df in (rp.borough_distribution(silver), rp.shared_breakdown(silver), rp.fare_statistics(silver),
                   rp.monthly_counts(silver, "pickup_date"), rp.daily_coverage(daily),
                   rp.borough_revenue_rank(daily), rp.shared_vs_solo_metrics(hourly),
                   # previews of the three gold tables
                   rp.top_revenue_days(daily), rp.weekday_borough_hours(hourly, a.borough), rp.top_routes(routes, 20)):
            df.show(24, truncate=False)
    elif a.job == "saved-query":
        from tiertrip.plans import saved
        text = saved.sql_text(a.borough, a.zones.split(","), db=f"{a.source}_aggregated")[a.name]
        spark.sql(text).show(50, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
