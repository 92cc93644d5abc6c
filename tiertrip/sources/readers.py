"""Scans of the bronze and silver layers, always under an explicit schema."""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiertrip import schemas
from tiertrip.config import PANDAS_NA_TOKENS
from tiertrip.sources import footers


def scan_trips(spark: SparkSession, path: str | list[str], merge_schema: bool = False,
               add: dict[str, Column] | None = None) -> DataFrame:
    """Multi-month bronze scan. The 23 known columns come first, under their schema: months whose ids
    were written as int or bigint are read alike, and a column that a month lacks is NULL there.

    With ``merge_schema`` any further columns of any month follow, so a new column reaches the tables
    that keep whole rows. Their types come from one pass over the footers; a column with different
    types in different files gets the widest of them, or text (:func:`footers.widest`): files of one
    set of types are read together, cast, and put under one another, still one scan of each file.

    ``add`` names columns to compute from each file's rows (they may use ``_metadata``)."""
    paths = [re.sub("^file:/+", "file:/", p) for p in ([path] if isinstance(path, str) else path)]
    if not merge_schema:
        return _scan(spark, paths, schemas.RAW_TRIP, add)
    more, groups = _new_columns(spark, paths)
    if len(groups) < 2:
        return _scan(spark, paths, T.StructType(schemas.RAW_TRIP.fields + list(more.values())), add)
    parts = []
    for (root, found), files in sorted(groups.items()):
        types = dict(found)
        fields = [T.StructField(f.name, _type(types[n]) if n in types else f.dataType) for n, f in more.items()]
        part = _scan(spark, files, T.StructType(schemas.RAW_TRIP.fields + fields), add, root)
        parts.append(part.withColumns({f.name: F.col(f"`{f.name}`").cast(more[f.name.lower()].dataType) for f in fields
                                       if f.dataType != more[f.name.lower()].dataType}))
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _scan(spark: SparkSession, paths: list[str], schema: T.StructType, add: dict[str, Column] | None,
          root: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema)
    if root:  # partition columns are those below the folder that was asked for
        reader = reader.option("basePath", root)
    df = reader.parquet(*paths)
    return df.withColumns(add) if add else df


def _type(name: str) -> T.DataType:
    return T.StructType.fromDDL(f"c {name}").fields[0].dataType


def _new_columns(spark: SparkSession, paths: list[str]) -> tuple[dict[str, T.StructField], dict]:
    """(lower-case name -> resolved field of the columns beyond the known ones, in order of first file;
    (folder asked for, types of the columns on which files differ) -> files or whole folders to read).

    The footers are read by one job; what comes to the driver is a row for each folder and set of types."""
    asked = {p: footers.data_files(spark, p) for p in paths}
    known = [f.name.lower() for f in schemas.RAW_TRIP.fields]
    new = F.filter("columns", lambda c: ~F.lower(c["name"]).isin(known))
    facts = footers.footers(spark, [f for files in asked.values() for f in files]).select("file", "folder", new.alias("new"))
    sets = facts.groupBy("folder", "new").agg(F.min("file").alias("file")).orderBy("file").collect()
    names: dict[str, str] = {}
    kinds: dict[str, set[str]] = {}
    for r in sets:
        for c in r["new"]:
            names.setdefault(c["name"].lower(), c["name"])
            kinds.setdefault(c["name"].lower(), set()).add(c["type"])
    more = {n: T.StructField(names[n], _type(footers.widest(sorted(kinds[n])))) for n in names}
    differ = {n for n in kinds if len(kinds[n]) > 1}
    if not differ:
        return more, {}
    sign = lambda new: tuple(sorted((c["name"].lower(), c["type"]) for c in new if c["name"].lower() in differ))
    by_folder: dict[str, set] = {}
    for r in sets:
        by_folder.setdefault(r["folder"], set()).add(sign(r["new"]))
    mixed = [d for d, found in by_folder.items() if len(found) > 1]  # folders whose own files differ
    of_file = {r["file"]: sign(r["new"]) for r in facts.where(F.col("folder").isin(mixed)).collect()} if mixed else {}
    groups: dict[tuple[str | None, tuple], dict[str, None]] = {}  # places in order, each once
    for p, files in asked.items():
        folder = p.rstrip("/")
        root = None if any(f.endswith(folder) for f, _, _ in files) else p  # a single file has no folder below it
        for file, d, _ in files:
            found = of_file.get(file) or next(iter(by_folder[d]))
            groups.setdefault((root, found), {})[file if d in mixed or root is None else d] = None
    return more, {key: list(places) for key, places in groups.items()}


def scan_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone CSV with header; Spark semantics: the text ``N/A`` stays a string. The header names are
    checked against the schema (``enforceSchema=false``), so a reordered file fails instead of
    silently shifting columns."""
    return (spark.read.schema(schemas.ZONE).option("header", True).option("enforceSchema", False)
            .option("mode", "PERMISSIVE").csv(path))


def pandas_na(df: DataFrame) -> DataFrame:
    """Apply pandas ``read_csv`` NA semantics: any default NA token in a string column is NULL.

    Spark's ``nullValue`` option takes one token only, so the mapping is a projection."""
    tokens = list(PANDAS_NA_TOKENS)
    return df.select(*[
        F.when(~F.col(f.name).isin(tokens), F.col(f.name)).alias(f.name)
        if f.dataType == schemas.S else F.col(f.name)
        for f in df.schema.fields
    ])


def scan_zones_na(spark: SparkSession, path: str) -> DataFrame:
    """Zone CSV read the way the pandas summary job reads it (``N/A`` -> NULL)."""
    return pandas_na(scan_zones(spark, path))


def scan_curated(spark: SparkSession, path: str) -> DataFrame:
    """Silver read-back with partition discovery. The explicit schema keeps ``pickup_date`` a DATE
    and lets an empty table (only ``_SUCCESS``) be read."""
    df = spark.read.schema(schemas.CURATED).parquet(path)
    return df.select(*schemas.CURATED.fieldNames())
