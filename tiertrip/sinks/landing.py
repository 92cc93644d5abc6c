"""Monthly landing of raw trip files into the bronze layer, and its manifest.

The source job streams one file per month from a web server into the object store, replacing the
same key and carrying on past a failed file. Here the landing folder is already readable; a Spark
job copies whole monthly files into bronze partitioned by ``source_month`` with dynamic overwrite
(a re-run replaces only the months it carries), and ``_metadata`` supplies the file lineage for the
manifest. A row's source month is its file's month, whatever its pickup time says, so no row is
lost and none is moved; the copy needs no shuffle and, with a file open for each month, no sort.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiertrip import schemas
from tiertrip.config import STATUS_FAILED, STATUS_PARTIAL, STATUS_SUCCESS
from tiertrip.session import list_path, make_dir, path_exists, remove_path, rename_path
from tiertrip.sinks import catalog
from tiertrip.sinks.publish import publish
from tiertrip.sinks.writers import write_json_document, write_partitioned
from tiertrip.sources import footers
from tiertrip.sources.months import MONTH_PATTERN, month_file
from tiertrip.sources.readers import scan_trips

MONTH_COL = "source_month"
DRY_RUN = "DRY_RUN"


def source_month(ts_col: str = "pickup_datetime") -> Column:
    """The month in the name of the row's file; its pickup month where the file is not named by month."""
    named = F.regexp_extract(F.col("_metadata.file_path"), MONTH_PATTERN, 1)
    return F.when(named != "", named).otherwise(F.date_format(F.col(ts_col), "yyyy-MM"))


def with_source_month(df: DataFrame, ts_col: str = "pickup_datetime") -> DataFrame:
    """``df`` (read from files) with :func:`source_month`."""
    return df.withColumn(MONTH_COL, source_month(ts_col))


def land_months(spark: SparkSession, paths: list[str], target: str) -> int:
    """SNK-5: land all rows of the given monthly files into ``target`` partitioned by
    ``source_month``, replacing only those months; returns the rows written."""
    df = scan_trips(spark, paths, merge_schema=True, add={MONTH_COL: source_month()})
    return write_partitioned(df, target, MONTH_COL, dynamic=True, rebalance=False, few=True)


def pickup_months(spark: SparkSession, files: list[str], target: str, label: str) -> int:
    """Add files that are not named by month to the months of their pickups. The rows lie under files named by
    ``label``, which replace those of an earlier attempt under the same label."""
    df = scan_trips(spark, files, merge_schema=True, add={MONTH_COL: source_month()})
    stage = f"{target.rstrip('/')}/_staging-{label}"
    if path_exists(spark, stage):  # an attempt was cut off: what it moved goes
        for file, _, _ in list_path(spark, target, recursive=True):
            if file.rsplit("/", 1)[-1].startswith(f"{label}-"):
                remove_path(spark, file)
        remove_path(spark, stage)
    rows = write_partitioned(df, stage, MONTH_COL, mode="append", rebalance=False, few=True)
    for folder, _, _ in list_path(spark, stage):
        if "=" in folder.rsplit("/", 1)[-1]:
            to = f"{target.rstrip('/')}/{folder.rstrip('/').rsplit('/', 1)[-1]}"
            make_dir(spark, to)
            for file, _, _ in list_path(spark, folder):
                if file.endswith(".parquet"):
                    rename_path(spark, file, f"{to}/{label}-{file.rsplit('/', 1)[-1]}")
    remove_path(spark, stage)
    return rows


def land_each_month(spark: SparkSession, files: dict[str, str], target: str) -> dict[str, str | None]:
    """SNK-5 with per-month isolation: one job per monthly file (``month -> path``, bounded by the
    look-back window), replacing only its own partition. A month whose job fails is reported with
    its error and the other months still land. Returns month -> error (None on success)."""
    out: dict[str, str | None] = {}
    for month, path in files.items():
        try:
            land_months(spark, [path], target)
            out[month] = None
        except Exception as exc:  # noqa: BLE001 - reported per month, as the manifest's error
            out[month] = f"{type(exc).__name__}: {exc}"
    return out


def read_landed(spark: SparkSession, target: str) -> DataFrame:
    """Landed bronze with partition discovery plus per-row file lineage."""
    schema = T.StructType(schemas.RAW_TRIP.fields + [T.StructField(MONTH_COL, T.StringType())])
    df = spark.read.schema(schema).parquet(target)
    return df.select("*", F.col("_metadata.file_name").alias("source_file"),
                     F.col("_metadata.file_size").alias("source_file_size"))


def landed_summary(landed: DataFrame) -> DataFrame:
    """Rows per landed month."""
    return (landed.groupBy(MONTH_COL).agg(F.count(F.lit(1)).alias("landed_rows"))
            .orderBy(F.col(MONTH_COL).asc_nulls_first()))


def ingest_manifest(spark: SparkSession, bronze: str, base_url: str, target_root: str, months: list[str] | None = None,
                    with_sizes: bool = True, status: str = STATUS_SUCCESS) -> DataFrame:
    """SNK-7/AGG-23: one row per landed month (of ``months``, or all): file, source_url, target, row_count,
    sizes, status. Rows are counted by the footers of the month's files and sizes by the listing; no
    row is read.

    Sizes depend on how the landing job split its output, so ``with_sizes=False`` leaves them out for
    exact comparisons."""
    files = [f for f in footers.data_files(spark, bronze) if f"/{MONTH_COL}=" in f[0]]
    month = F.regexp_extract("folder", f"{MONTH_COL}=([^/]*)$", 1)
    if months is not None:
        files = [f for f in files if f[1].rsplit("=", 1)[-1] in months]
    per_month = footers.footers(spark, files).groupBy(
        F.when(month != catalog.NO_VALUE, month).alias(MONTH_COL)).agg(
        F.sum("rows").alias("row_count"), F.sum("bytes").alias("size_bytes"))
    file = month_file(F.to_date(F.concat(F.col(MONTH_COL), F.lit("-01"))))
    cols = [
        file.alias("file"),
        F.concat(F.lit(base_url.rstrip("/") + "/"), file).alias("source_url"),
        F.concat(F.lit(target_root.rstrip("/") + f"/{MONTH_COL}="), F.col(MONTH_COL), F.lit("/")).alias("target"),
        F.col("row_count").cast("long").alias("row_count"),
    ]
    if with_sizes:
        cols += [F.col("size_bytes").cast("long").alias("size_bytes"),
                 F.round(F.col("size_bytes") / F.lit(1024.0 ** 2), 1).alias("size_mb")]
    cols.append(F.lit(status).alias("status"))
    return per_month.select(*cols).orderBy("file")


def failed_manifest(spark: SparkSession, errors: dict[str, str | None], base_url: str, target_root: str) -> DataFrame:
    """Manifest rows (status FAILED, with the error) for months whose landing job failed."""
    rows = [(m, e) for m, e in errors.items() if e is not None]
    df = spark.createDataFrame(rows, "month string, error string")
    file = month_file(F.to_date(F.concat(F.col("month"), F.lit("-01"))))
    return df.select(
        file.alias("file"), F.concat(F.lit(base_url.rstrip("/") + "/"), file).alias("source_url"),
        F.concat(F.lit(target_root.rstrip("/") + f"/{MONTH_COL}="), F.col("month"), F.lit("/")).alias("target"),
        F.lit(None).cast("long").alias("row_count"), F.lit(None).cast("long").alias("size_bytes"),
        F.lit(None).cast("double").alias("size_mb"), F.lit(STATUS_FAILED).alias("status"), F.col("error"))


def dry_run_manifest(months: DataFrame, base_url: str, target_root: str, sizes: dict[str, int] | None = None) -> DataFrame:
    """SNK-8: what would be landed (status DRY_RUN), with file sizes from the listing; no row is read
    and nothing is written."""
    file = F.col("file")
    size = F.lit(None).cast("long")
    for month, n in (sizes or {}).items():
        size = F.when(F.col("month") == month, F.lit(n).cast("long")).otherwise(size)
    return months.withColumn("size_bytes", size).select(
        file, "size_bytes", F.round(F.col("size_bytes") / F.lit(1024.0 ** 2), 1).alias("size_mb"), F.concat(F.lit(base_url.rstrip("/") + "/"), file).alias("source_url"),
        F.concat(F.lit(target_root.rstrip("/") + f"/{MONTH_COL}="), F.col("month"), F.lit("/")).alias("target"),
        F.lit(DRY_RUN).alias("status"),
    )


def manifest_totals(manifest: DataFrame) -> DataFrame:
    """AGG-23: files with status SUCCESS, and all files."""
    return manifest.agg(F.count_if(F.col("status") == STATUS_SUCCESS).alias("files_uploaded"),
                        F.count(F.lit(1)).alias("files_total"))


def result_document(manifest: DataFrame, dry_run: bool, run_at: str, run_id: str | None = None) -> DataFrame:
    """One row: overall status, the run's id and time (given, never the clock), dry-run flag, files uploaded
    and in total, errors, and the files: one entry per chosen month, and the zone table."""
    files = manifest
    for c, kind in (("error", "string"), ("size_kb", "double"), ("row_count", "long")):
        if c not in files.columns:
            files = files.withColumn(c, F.lit(None).cast(kind))
    failed, n = F.count_if(F.col("status") == STATUS_FAILED), F.count(F.lit(1))
    status = (F.when(failed == 0, STATUS_SUCCESS).when(failed == n, STATUS_FAILED).otherwise(STATUS_PARTIAL))
    return files.agg(
        status.alias("status"), F.lit(run_id or run_at).alias("run_id"), F.lit(run_at).alias("timestamp"),
        F.lit(dry_run).alias("dry_run"),
        F.count_if(F.col("status") == STATUS_SUCCESS).alias("files_uploaded"), n.alias("files_total"),
        F.array_sort(F.collect_list("error")).alias("errors"),
        F.array_sort(F.collect_list(F.struct("file", *[c for c in files.columns if c != "file"]))).alias("files"))


def append_history(document: DataFrame, path: str, run_id: str) -> None:
    """Add a run's result document to the history of all runs: a folder for each run id, so that runs
    never touch one another and a run that is repeated under its id is there once."""
    name = re.sub(r"[^A-Za-z0-9._-]", "_", run_id)
    write_json_document(document, f"{path.rstrip('/')}/run={name}")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All runs, oldest first: ``run_id, timestamp, status, dry_run, files_uploaded, files_total, json``."""
    kinds = "status string, run_id string, timestamp string, dry_run boolean, files_uploaded long, files_total long"
    runs = spark.read.schema("value string").text(path)
    return runs.select(F.from_json("value", kinds).alias("r"), F.col("value").alias("json")).select(
        "r.run_id", "r.timestamp", "r.status", "r.dry_run", "r.files_uploaded", "r.files_total", "json").orderBy("timestamp", "run_id")


def zone_entry(spark: SparkSession, zones_path: str, target: str, base_url: str, status: str,
               error: str | None = None) -> DataFrame:
    """The zone table's manifest row: its size in KB is that of the source, from the listing."""
    size = sum(n for _, n, _ in list_path(spark, zones_path, recursive=True))
    name = zones_path.rstrip("/").rsplit("/", 1)[-1]
    return spark.createDataFrame(
        [(name, f"{base_url.rstrip('/')}/{name}", target, size, round(size / 1024, 1), status, error)],
        "file string, source_url string, target string, size_bytes long, size_kb double, status string, error string")


def land_zone_table(spark: SparkSession, zones_path: str, target: str, base_url: str) -> DataFrame:
    """The zone table, copied beside the trips in the same ingest (staged and moved in): its manifest row."""
    from tiertrip.sources.readers import scan_zones
    status, error = STATUS_SUCCESS, None
    try:
        # A dimension of a few hundred rows: one file, as the source ships it.
        zones = scan_zones(spark, zones_path).coalesce(1)
        publish(spark, target, lambda to: zones.write.option("header", True).csv(to))
    except Exception as exc:  # noqa: BLE001 - reported in the manifest
        status, error = STATUS_FAILED, f"{type(exc).__name__}: {exc}"
    return zone_entry(spark, zones_path, target, base_url, status, error)
