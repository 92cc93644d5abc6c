"""One place that knows where each layer of a trip lake comes from.

``TripLake`` builds lazy DataFrames for every layer from a bronze trip folder and a zone CSV
folder. ``TripLake.from_testdata`` derives both from the driver's tables (written once per input,
see :mod:`tiertrip.sources.fixtures`). Each layer's lazy plan is built once per lake and shared by
the queries composed on it; each query still executes as one plan from the Parquet scan, so
Catalyst prunes columns and pushes filters for that query. No data is kept in memory.
"""

from __future__ import annotations

import hashlib
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tiertrip import schemas
from tiertrip.config import DEFAULT_THRESHOLDS, PROVIDER_LYFT, Thresholds
from tiertrip.operators import curate as cu
from tiertrip.operators import derive as dv
from tiertrip.operators import enrich as en
from tiertrip.operators import quality as q
from tiertrip.operators import rollup as ru
from tiertrip.session import path_exists, scratch_path
from tiertrip.sources import fixtures, readers


class TripLake:
    def __init__(self, spark: SparkSession, bronze_path: str, zones_path: str,
                 thresholds: Thresholds = DEFAULT_THRESHOLDS, provider: str = PROVIDER_LYFT):
        self.spark, self._bronze_path, self.zones_path = spark, bronze_path, zones_path
        self.thresholds, self.provider = thresholds, provider
        self.sf_dir: str | None = None

    _cache: dict = {}

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, **kw) -> "TripLake":
        # The fixture folders are named by the files they were made from, so changed input is a new lake.
        bronze, zones = fixtures.bronze_trips_target(spark, sf_dir), fixtures.zones_csv_path(spark, sf_dir)
        key = (id(spark), sf_dir, bronze, zones, tuple(sorted(kw.items())))
        lake = cls._cache.get(key)
        if lake is None or lake.spark is not spark:
            lake = cls(spark, bronze, zones, **kw)
            lake.sf_dir = sf_dir
            cls._cache[key] = lake
        return lake

    def _memo(self, key, build):
        """Build each layer's lazy plan once per lake: file listing and analysis happen once, and
        every query composes on the same plan object. (No data is cached by this.)"""
        memo = self.__dict__.setdefault("_plans", {})
        if key not in memo:
            memo[key] = build()
        return memo[key]

    @cached_property
    def bronze_path(self) -> str:
        """Folder of the bronze trips (from test data: written on first use, so a query over the monthly
        landing files alone does not write them too)."""
        return fixtures.bronze_trips_path(self.spark, self.sf_dir) if self.sf_dir else self._bronze_path

    def landing_path(self) -> str:
        """Folder of the monthly landing files (test data only; written on first use)."""
        return fixtures.landing_path(self.spark, self.sf_dir)

    # bronze
    def bronze(self) -> DataFrame:
        return self._memo("bronze", lambda: readers.scan_trips(self.spark, self.bronze_path))

    def zones(self) -> DataFrame:
        return self._memo("zones", lambda: readers.scan_zones(self.spark, self.zones_path))

    def zones_na(self) -> DataFrame:
        return self._memo("zones_na", lambda: readers.pandas_na(self.zones()))

    @cached_property
    def _lookup(self) -> DataFrame:
        """The zone dimension, validated once per lake. Catalyst broadcasts it by its measured size."""
        return en.check_dimension(self.zones())

    def lookup(self) -> DataFrame:
        return self._lookup

    # silver
    def provider_trips(self) -> DataFrame:
        return self._memo("provider", lambda: q.provider_filter(self.bronze(), self.provider))

    def tagged(self) -> DataFrame:
        return self._memo("tagged", lambda: q.tag(self.bronze(), thresholds=self.thresholds))

    def curated(self) -> DataFrame:
        return self._memo("curated", lambda: cu.curate(self.bronze(), self._lookup, self.provider,
                                                       self.thresholds, zones_checked=True))

    def derived(self) -> DataFrame:
        """Provider + quality filter + derived columns, before the sanity filter and lookups."""
        return self._memo("derived", lambda: dv.derive(q.keep(self.provider_trips(), thresholds=self.thresholds)))

    # gold
    def daily(self, sort: bool = True) -> DataFrame:
        return self._memo(("daily", sort), lambda: ru.daily_borough_summary(self.curated(), sort=sort))

    def hourly(self, sort: bool = True) -> DataFrame:
        return self._memo(("hourly", sort), lambda: ru.hourly_pattern_summary(self.curated(), sort=sort))

    def routes(self, sort: bool = True) -> DataFrame:
        return self._memo(("routes", sort), lambda: ru.route_summary(self.curated(), self.thresholds, sort=sort))

    def gold(self, name: str) -> DataFrame:
        """A gold table as PIP-2 wrote it: ``daily``, ``hourly`` or ``routes``. The three are written once per
        input, limits and provider (the bronze folder is named by the files it was made from)."""
        from tiertrip.plans import medallion as md
        key = hashlib.sha1(repr((self.bronze_path, self.zones_path, self.thresholds, self.provider)).encode()).hexdigest()
        root = scratch_path(self.spark, "fixtures", "gold", key[:16])
        out = md.GoldPaths(*(f"{root}/{t}" for t in ("daily", "hourly", "routes")))
        if not all(path_exists(self.spark, f"{p}/_SUCCESS") for p in (out.daily, out.hourly, out.routes)):
            md.write_gold_one_pass(self.spark, self.curated(), out, self.thresholds)
        schema = {"daily": schemas.DAILY, "hourly": schemas.HOURLY, "routes": schemas.ROUTE}[name]
        return self._memo(("gold", name), lambda: self.spark.read.schema(schema).parquet(getattr(out, name))
                          .select(*schema.fieldNames()))
