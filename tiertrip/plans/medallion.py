"""The batch jobs: raw -> curated, curated -> gold, quality check, zone summary, monthly ingest.

Each job reads its inputs once per output it writes. Stage counts ride along the write as
``Observation`` metrics instead of separate count actions; read-back validation compares them
with the rows found on storage.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiertrip import schemas
from tiertrip.config import (DEFAULT_THRESHOLDS, PASSED_REASON, PROVIDER_LYFT, STATUS_PASSED, STATUS_REJECTED,
                             Thresholds)
from tiertrip.operators import curate as cu
from tiertrip.operators import derive as dv
from tiertrip.operators import enrich as en
from tiertrip.operators import quality as q
from tiertrip.operators import reports as rp
from tiertrip.operators import rollup as ru
from tiertrip.operators import zones as zn
from tiertrip.sinks import landing as ld
from tiertrip.sinks.publish import recover
from tiertrip.sinks.writers import observed, partition_key, write_counted, write_json_document, write_partitioned, write_table
from tiertrip.sources import footers
from tiertrip.sources import months as mo
from tiertrip.session import list_path, remove_path, run_path
from tiertrip.sources import readers


class ValidationError(RuntimeError):
    pass


@dataclass
class FunnelCounts:
    raw_rows: int
    provider_rows: int
    dq_rows: int
    curated_rows: int
    date_partitions: int = 0  # as found on storage
    columns: int = 0


def footer_rows(spark: SparkSession, path: str) -> int:
    """Rows of all data files at or below ``path``, from their footers."""
    return int(footers.footers(spark, footers.data_files(spark, path)).agg(F.sum("rows")).first()[0] or 0)


def read_back(spark: SparkSession, path: str, expected: T.StructType, written: int | None) -> tuple[DataFrame, int, str]:
    """What lies at ``path``, read without a schema: (rows as a frame, their count, status). The status is OK
    when the count (unless ``written`` is None), the column names and the column types are those
    expected. A table written with no row may have no file to take columns from; then it has none and passes."""
    if not written and not any(f.endswith(".parquet") for f, _, _ in list_path(spark, path, recursive=True)):
        return spark.createDataFrame([], expected), 0, "OK"
    back = spark.read.parquet(path)
    n = back.count()
    types = lambda schema: sorted((f.name, f.dataType.simpleString()) for f in schema.fields)
    return back, n, "OK" if n == (n if written is None else written) and types(back.schema) == types(expected) else "MISMATCH"


def check_partitions(spark: SparkSession, path: str, column: str, kind: str, expected: dict[int, int] | None,
                     whole: bool) -> list[str]:
    """Partitions of ``path`` whose rows are not those that a write counted (:func:`write_counted`): by
    name, with both counts. With ``whole`` a partition that the write did not carry is wrong too; without,
    it belongs to an earlier run. Reads no column, only the partition folders and their footers."""
    if expected is None:
        return []
    found: dict[int, int] = {}
    names: dict[int, list[str]] = {}
    if any(f.endswith(".parquet") for f, _, _ in list_path(spark, path, recursive=True)):
        back = spark.read.parquet(path)
        counts = back.groupBy(F.col(f"`{column}`").cast("string").alias("name"),
                              partition_key(back, column, kind).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        for r in counts.collect():  # one row a partition
            found[r["key"]] = found.get(r["key"], 0) + r["n"]
            names.setdefault(r["key"], []).append(str(r["name"]))
    wrong = [k for k, n in expected.items() if found.get(k, 0) != n] + [k for k in found if whole and k not in expected]
    return [f"{column}={'/'.join(names.get(k, [f'key {k}']))}: {found.get(k, 0)} rows of {expected.get(k, 0)}" for k in sorted(wrong)]


def partition_folders(spark: SparkSession, path: str, column: str) -> int:
    """AGG-15: the partitions of a written layer, counted in its listing."""
    names = [p.rstrip("/").rsplit("/", 1)[-1] for p, _, _ in list_path(spark, path)]
    return sum(n.startswith(f"{column}=") for n in names)


def raw_to_curated(spark: SparkSession, bronze_path: str, zones_path: str, curated_path: str,
                   provider: str = PROVIDER_LYFT, thresholds: Thresholds = DEFAULT_THRESHOLDS,
                   dynamic: bool = False, rebalance: bool = True) -> FunnelCounts:
    """PIP-1 in one pass over the trips: the stage counts are observed during the write, on the scan,
    and rows are derived only after they have passed the quality filter. Silver is read back: names and
    types, and the rows of every partition against those the write counted. With ``dynamic`` the
    partitions of earlier runs stay, and those that this run carries are compared.

    The observed counts are taken before the rebalance shuffle (a map stage); the curated count after
    it (exactly once). If the observed total is not the row count in the files' footers, a map stage
    was re-run after an executor loss and its metrics were double-counted, so the funnel is counted
    again with the one-pass aggregate (retry-safe, one more scan)."""
    recover(spark, bronze_path)
    recover(spark, zones_path)
    bronze = readers.scan_trips(spark, bronze_path)
    zones = en.check_dimension(readers.scan_zones(spark, zones_path))
    prov = F.col("hvfhs_license_num") == F.lit(provider)
    dq = prov & q.keep_expr(thresholds=thresholds)
    seen, obs = observed(bronze, "funnel", raw_rows=F.count(F.lit(1)), provider_rows=F.count_if(prov),
                         dq_rows=F.count_if(dq))
    passed = dv.speed_filter(dv.derive(seen.filter(dq)), thresholds)
    curated = cu.select_curated(en.enrich(passed, zones, checked=True))
    written, parts = write_counted(curated, curated_path, "pickup_date", dynamic=dynamic, rebalance=rebalance)
    m = dict(obs.get) | {"curated_rows": written}
    if int(m["raw_rows"]) != footer_rows(spark, bronze_path):
        f = rp.stage_funnel(bronze, provider, thresholds).first()
        m = f.asDict()
    wrong = check_partitions(spark, curated_path, "pickup_date", "date", parts, whole=not dynamic)
    back, found, status = read_back(spark, curated_path, schemas.CURATED, None if dynamic else written)
    if wrong or status != "OK":
        raise ValidationError(f"silver read-back mismatch: {found} rows, {written} written, {wrong[:5]}, columns {back.dtypes}")
    return FunnelCounts(*(int(m[k]) for k in ("raw_rows", "provider_rows", "dq_rows", "curated_rows")),
                        date_partitions=partition_folders(spark, curated_path, "pickup_date"), columns=len(back.columns))


@dataclass
class GoldPaths:
    daily: str
    hourly: str
    routes: str


GOLD_COLUMNS = sorted(set(ru.DAILY_KEYS + ru.HOURLY_KEYS + ru.ROUTE_KEYS) | {
    "base_passenger_fare", "tips", "trip_miles", "trip_duration_minutes", "speed_mph", "wait_time_minutes"})


def build_gold(curated: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> dict[str, DataFrame]:
    return {
        "daily": ru.daily_borough_summary(curated, sort=False),
        "hourly": ru.hourly_pattern_summary(curated, sort=False),
        "routes": ru.route_summary(curated, thresholds, sort=False),
    }


def write_gold(gold: dict[str, DataFrame], out: GoldPaths) -> dict[str, int]:
    """Write the three gold tables; returns the row count each write observed (exactly once). AQE merges
    the output tasks of the bounded hourly table (24 x 2 x boroughs x 2 rows) into one file."""
    return {
        # daily is one row per (date, borough): a few rows per date, so rebalancing by date is cheap
        "daily": write_partitioned(gold["daily"], out.daily, "pickup_date"),
        "hourly": write_table(gold["hourly"], out.hourly, rebalance=True),
        "routes": write_table(gold["routes"], out.routes, rebalance=True),
    }


GOLD_STAGE = T.StructType(
    [schemas.CURATED[c] for c in ru.GOLD_KEYS]
    + [T.StructField(m, T.LongType() if m == "total_trips" else T.DoubleType()) for m in dict.fromkeys(
        ru.GOLD_MEASURES["daily"] + ru.GOLD_MEASURES["hourly"] + ru.GOLD_MEASURES["routes"])]
    + [T.StructField("gold_set", T.LongType())])


def write_gold_one_pass(spark: SparkSession, curated: DataFrame, out: GoldPaths,
                        thresholds: Thresholds = DEFAULT_THRESHOLDS) -> dict[str, int]:
    """One scan of ``curated`` -> combined GROUPING SETS result written under the shared folder
    (a lineage cut), one folder per grouping set -> the three gold tables, each from its own folder.
    Routes under the trip limit are dropped before the stage is written; the stage folder goes after use."""
    stage = run_path(spark, "gold", uuid.uuid4().hex)
    combined = ru.busy_routes(ru.gold_one_pass(curated.select(*GOLD_COLUMNS)), thresholds)
    try:
        write_partitioned(combined, stage, "gold_set", rebalance=False, few=True)
        staged = spark.read.schema(GOLD_STAGE).parquet(stage)
        return write_gold(ru.split_gold(staged, thresholds), out)
    finally:
        remove_path(spark, stage)


def validate_gold(spark: SparkSession, out: GoldPaths, written: dict[str, int]) -> DataFrame:
    """RPT-7: read each table back without a schema and compare its row count, column names and
    column types with what was written."""
    rows = []
    for name, path, schema in (("daily", out.daily, schemas.DAILY), ("hourly", out.hourly, schemas.HOURLY),
                               ("routes", out.routes, schemas.ROUTE)):
        back, n, status = read_back(spark, path, schema, int(written[name]))
        rows.append((name, int(written[name]), int(n), len(back.columns), len(schema.fields), status))
    return spark.createDataFrame(rows, "table string, rows_written long, rows_read long, columns int, "
                                       "expected_columns int, status string")


def curated_to_gold(spark: SparkSession, curated_path: str, out: GoldPaths,
                    thresholds: Thresholds = DEFAULT_THRESHOLDS, one_pass: bool = True,
                    persist: bool = False) -> DataFrame:
    """PIP-2.

    ``one_pass`` (default): one column-pruned scan of silver feeds all three rollups as GROUPING
    SETS; the small combined result is written once under the shared working folder (cutting the
    lineage), and the three tables are split from that copy. Otherwise each rollup scans silver on
    its own, or, with ``persist``, the needed columns (not all 36) are kept on executors' memory and
    disk for the three plans."""
    recover(spark, curated_path)
    curated = readers.scan_curated(spark, curated_path)
    if one_pass:
        written = write_gold_one_pass(spark, curated, out, thresholds)
    else:
        if persist:
            curated = curated.select(*GOLD_COLUMNS).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            written = write_gold(build_gold(curated, thresholds), out)
        finally:
            if persist:
                curated.unpersist()
    report = validate_gold(spark, out, written)
    bad = [r for r in report.collect() if r["status"] != "OK"]  # three rows
    if bad:
        raise ValidationError(f"gold read-back mismatch: {bad}")
    return report


def dq_check(spark: SparkSession, bronze_path: str, rejected_path: str, summary_path: str,
             thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """PIP-3: tag once; write the rejected rows (columns that only some months have included) partitioned
    by reason while observing the count of every reason; the quality summary is built from those
    observed counts (a dozen numbers), so the raw trips are read once. If the observed total is not the
    row count in the files' footers, or the observed rejects are not the rows written (a map stage
    re-run after an executor loss), the counts are taken again with a retry-safe aggregate. The
    rejected table is read back, each reason's rows compared."""
    recover(spark, bronze_path)
    bronze = readers.scan_trips(spark, bronze_path, merge_schema=True)
    tagged = q.tag(bronze, thresholds=thresholds)
    metrics = {"total": F.count(F.lit(1)), "good": F.count_if(F.col(q.REASON).isNull())}
    for i, name in enumerate(q.RULE_NAMES):
        metrics[f"r{i}"] = F.count_if(F.col(q.REASON) == F.lit(name))
    observed_tagged, obs = observed(tagged, "dq", **metrics)
    written, parts = write_counted(q.rejected(observed_tagged), rejected_path, q.REASON)
    m = obs.get
    per_reason = [(name, int(m[f"r{i}"])) for i, name in enumerate(q.RULE_NAMES)]
    good = int(m["good"])
    if int(m["total"]) != footer_rows(spark, bronze_path) or sum(c for _, c in per_reason) != written:
        exact = {r[q.REASON]: r["record_count"] for r in rp.reason_counts(tagged).collect()}  # <= 12 rows
        good = int(exact.pop(None, 0))
        per_reason = [(name, int(exact.get(name, 0))) for name in q.RULE_NAMES]
    wrong = check_partitions(spark, rejected_path, q.REASON, "string", parts, whole=True)
    _, found, status = read_back(spark, rejected_path, q.rejected(tagged).schema, written)
    if wrong or status != "OK":
        raise ValidationError(f"rejected read-back mismatch: {found} rows of {written}, {wrong[:5]}")
    counts = spark.createDataFrame([(None, good)] + [(n, c) for n, c in per_reason if c],
                                   "rejection_reason string, record_count long")
    write_table(_summary_from_counts(counts), summary_path, rebalance=True)
    return spark.read.schema(schemas.QUALITY_SUMMARY).parquet(summary_path).orderBy(
        F.when(F.col("status") == STATUS_PASSED, 0).otherwise(1), F.col("record_count").desc(), q.REASON)


def dq_job(spark: SparkSession, bronze_path: str, rejected_path: str, summary_path: str,
           thresholds: Thresholds = DEFAULT_THRESHOLDS) -> dict[str, DataFrame]:
    """PIP-3 with its reports: the written summary, totals, the quality of each month, and trips by month
    and by provider before the rules. The trips are read twice: once by :func:`dq_check`, which writes the
    rejected rows, and once for all reports together, as grouping sets whose few rows are written and read."""
    summary = dq_check(spark, bronze_path, rejected_path, summary_path, thresholds)
    tagged = q.tag(readers.scan_trips(spark, bronze_path), thresholds=thresholds)
    stage = run_path(spark, uuid.uuid4().hex, "quality_reports")
    combined = rp.dq_one_pass(tagged)
    write_table(combined, stage, rebalance=True)
    return {"summary": summary} | rp.split_dq(spark.read.schema(combined.schema).parquet(stage))


def _summary_from_counts(counts: DataFrame) -> DataFrame:
    """Quality summary from per-reason counts (``NULL`` reason = good rows)."""
    tot = F.sum("record_count").over(Window.partitionBy())  # one row per rule plus one
    good = F.sum(F.when(F.col(q.REASON).isNull(), F.col("record_count"))).over(Window.partitionBy())
    base = counts.select(q.REASON, "record_count", tot.alias("total"), F.coalesce(good, F.lit(0)).alias("good"))
    rej_rate = F.coalesce(F.try_divide((F.col("total") - F.col("good")).cast("double"), F.col("total")) * 100.0,
                          F.lit(0.0))
    is_good = F.col(q.REASON).isNull()
    return base.select(
        F.coalesce(F.col(q.REASON), F.lit(PASSED_REASON)).alias(q.REASON),
        F.col("record_count"),
        F.when(is_good, F.round(F.lit(100.0) - rej_rate, 4))
         .otherwise(F.round(F.try_divide(F.col("record_count").cast("double"), F.col("total")) * 100.0, 4))
         .alias("pct_of_total"),
        F.when(is_good, F.lit(STATUS_PASSED)).otherwise(F.lit(STATUS_REJECTED)).alias("status"),
    )


def zone_summary_job(spark: SparkSession, zones_path: str, out_path: str, generated_at: str) -> DataFrame:
    """PIP-4: zone CSV (pandas NA semantics) -> one summary row -> one JSON document."""
    summary = zn.zone_summary(readers.scan_zones_na(spark, zones_path), zones_path, generated_at)
    write_json_document(summary, out_path)
    return summary


class NoMonthsError(RuntimeError):
    pass


def ingest_job(spark: SparkSession, landing_path: str, bronze_path: str, as_of: str,
               start_offset: int = 2, max_lookback: int = 14, n: int = 6, base_url: str = "landing",
               dry_run: bool = False, isolate_months: bool = True, zones_path: str | None = None,
               zones_target: str | None = None, manifest_path: str | None = None,
               history_path: str | None = None, run_at: str = "", run_id: str | None = None) -> DataFrame:
    """PIP-5: choose the newest months by the file names in the landing folder, land their whole files
    into bronze (each month replaced as a whole), and return the manifest.

    ``isolate_months`` (default) lands month by month so that one failing month does not stop the
    others (it is reported FAILED with its error); otherwise all chosen months land in one
    job. The chosen-month list is at most ``n`` rows. With ``zones_path`` and ``zones_target`` the zone
    table is landed too. ``manifest_path`` gets the result document of this run, and ``history_path``
    one entry a run that no later run replaces, under ``run_id`` (by default the run's time ``run_at``).

    A dry run (SNK-8) writes nothing anywhere: it returns what would be landed, the zone table with it,
    with sizes from the listing and status DRY_RUN."""
    recover(spark, bronze_path) if not dry_run else None
    files = mo.month_files(spark, landing_path)
    chosen = mo.latest_months(mo.available_months(spark, landing_path), as_of, start_offset, max_lookback, n)
    months = [r["month"] for r in chosen.collect()]  # bounded by n
    if not months:
        raise NoMonthsError(f"no monthly file {start_offset} to {max_lookback} months before {as_of} in {landing_path}")
    zones = bool(zones_path and zones_target)
    if dry_run:
        manifest = ld.dry_run_manifest(chosen, base_url, bronze_path, {m: files[m][1] for m in months})
        extra = ld.zone_entry(spark, zones_path, zones_target, base_url, ld.DRY_RUN) if zones else None
    else:
        if isolate_months:
            errors = ld.land_each_month(spark, {m: files[m][0] for m in months}, bronze_path)
        else:
            ld.land_months(spark, [files[m][0] for m in months], bronze_path)
            errors = dict.fromkeys(months)
        manifest = ld.failed_manifest(spark, errors, base_url, bronze_path)
        ok = [m for m in months if errors[m] is None]
        if ok:
            done = ld.ingest_manifest(spark, bronze_path, base_url, bronze_path, ok)
            manifest = done.withColumn("error", F.lit(None).cast("string")).unionByName(manifest)
        extra = ld.land_zone_table(spark, zones_path, zones_target, base_url) if zones else None
    if extra is not None:
        manifest = manifest.unionByName(extra, allowMissingColumns=True)
    if not dry_run and (manifest_path or history_path):
        # a row for each month and the zone table: written once, so that both documents say the same
        rows = manifest.collect()
        manifest = spark.createDataFrame(rows, manifest.schema)
        document = ld.result_document(manifest, dry_run, run_at, run_id)
        if manifest_path:
            write_json_document(document, manifest_path)
        if history_path:
            ld.append_history(document, history_path, run_id or run_at)
    return manifest.orderBy("file")
