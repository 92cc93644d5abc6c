"""Thresholds, provider codes and lake layout.

All numbers that decide which trips are kept live here, so a deployment can change them without
touching operator code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the source pipeline's for identical results.
PROVIDER_LYFT = "HV0005"
PROVIDER_UBER = "HV0003"
PASSED_REASON = "PASSED_ALL_RULES"
STATUS_PASSED = "PASSED"
STATUS_REJECTED = "REJECTED"
STATUS_SUCCESS = "SUCCESS"
STATUS_FAILED = "FAILED"
STATUS_PARTIAL = "PARTIAL"
MONTH_FILE_PREFIX = "fhvhv_tripdata_"
MONTH_FILE_SUFFIX = ".parquet"
# Tokens pandas.read_csv turns into NaN by default (its documented na_values list).
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@dataclass(frozen=True)
class Thresholds:
    """Data-quality and curation limits (fixed values of the source pipeline)."""

    max_trip_miles: float = 200.0        # rule excessive_trip_miles: miles >= this
    max_fare: float = 500.0              # rule excessive_fare: fare >= this
    max_trip_seconds: int = 14400        # rule excessive_trip_time: seconds >= this
    max_speed_mph: float = 80.0          # curation: speed <= this (or NULL)
    min_duration_minutes: float = 1.0    # curation: duration >= this
    max_duration_minutes: float = 240.0  # curation: duration <= this
    min_route_trips: int = 10            # route_summary HAVING total_trips >= this


DEFAULT_THRESHOLDS = Thresholds()


@dataclass(frozen=True)
class LakePaths:
    """Layer roots under one lake root: ``raw``, ``curated``, ``aggregated``, ``rejected``, ``processed``."""

    root: str
    source: str = "nyctlc"
    tables: dict = field(default_factory=lambda: {
        "trips_raw": "raw/{src}/fhvhv_tripdata",
        "zones_raw": "raw/{src}/taxi_zone_lookup",
        "curated": "curated/{src}/fhvhv_trips_curated",
        "daily": "aggregated/{src}/daily_borough_summary",
        "hourly": "aggregated/{src}/hourly_pattern_summary",
        "routes": "aggregated/{src}/route_summary",
        "rejected": "rejected/{src}/fhvhv_tripdata_rejected",
        "quality_summary": "rejected/{src}/quality_summary",
        "zone_summary": "processed/{src}/zone_summary",
        "manifest": "processed/{src}/ingest_manifest",
        "history": "processed/{src}/ingest_history",
    })

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{self.tables[table].format(src=self.source)}"
