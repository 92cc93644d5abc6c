"""Bronze -> silver as one lazy plan: provider filter, quality filter, derivation, sanity filter,
zone enrichment and the fixed 36-column projection. One scan; Catalyst pushes both filters into
Parquet and collapses the projections."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tiertrip import schemas
from tiertrip.config import DEFAULT_THRESHOLDS, PROVIDER_LYFT, Thresholds
from tiertrip.operators import derive as dv
from tiertrip.operators import enrich as en
from tiertrip.operators import quality as q


def select_curated(df: DataFrame) -> DataFrame:
    return df.select(*schemas.CURATED.fieldNames())


def curate(bronze: DataFrame, zones: DataFrame, provider: str | None = PROVIDER_LYFT,
           thresholds: Thresholds = DEFAULT_THRESHOLDS, zones_checked: bool = False) -> DataFrame:
    df = bronze if provider is None else q.provider_filter(bronze, provider)
    df = q.keep(df, thresholds=thresholds)
    df = dv.speed_filter(dv.derive(df), thresholds)
    df = en.enrich(df, zones, checked=zones_checked)
    return select_curated(df)
