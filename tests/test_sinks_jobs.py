"""Writes, read-back, dynamic overwrite, catalog registration, schema drift and the batch jobs."""

import datetime as dt
import re
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_text, trips_df
from tiertrip import schemas
from tiertrip.operators import reports as rp
from tiertrip.plans import medallion as md
from tiertrip.sinks import catalog, landing
from tiertrip.sinks.writers import write_partitioned
from tiertrip.sources import readers


def test_partitioned_roundtrip_with_null_partition(spark, tmp_path):
    p = str(tmp_path / "t")
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, None)], "v int, d date")
    write_partitioned(df, p, "d")
    back = spark.read.parquet(p)
    assert back.columns == ["v", "d"] and dict(back.schema.fields[1].jsonValue())["type"] == "date"
    assert sorted(back.collect(), key=lambda r: r.v) == [(1, dt.date(2024, 1, 1)), (2, None)]


def test_dynamic_overwrite_keeps_other_partitions(spark, tmp_path):
    p = str(tmp_path / "t")
    write_partitioned(spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string"), p, "k")
    write_partitioned(spark.createDataFrame([(3, "b")], "v int, k string"), p, "k", dynamic=True)
    assert sorted(tuple(r) for r in spark.read.parquet(p).collect()) == [(1, "a"), (3, "b")]
    # rerunning is idempotent
    write_partitioned(spark.createDataFrame([(3, "b")], "v int, k string"), p, "k", dynamic=True)
    assert spark.read.parquet(p).count() == 2


def test_empty_partitioned_write_reads_with_schema(spark, tmp_path):
    p = str(tmp_path / "c")
    empty = spark.createDataFrame([], schemas.CURATED)
    write_partitioned(empty, p, "pickup_date")
    back = readers.scan_curated(spark, p)
    assert back.count() == 0 and back.columns == schemas.CURATED.fieldNames()


def test_schema_drift_int_and_bigint_months(spark, tmp_path):
    a, b = str(tmp_path / "m1"), str(tmp_path / "m2")
    spark.createDataFrame([(1, 2, 3.0)], "PULocationID int, DOLocationID int, trip_miles double").write.parquet(a)
    spark.createDataFrame([(4, 5, 6.0, "Y")], "PULocationID bigint, DOLocationID bigint, trip_miles double, "
                                               "wav_match_flag string").write.parquet(b)
    rows = readers.scan_trips(spark, [a, b]).select("PULocationID", "trip_miles", "wav_match_flag").collect()
    assert sorted(rows, key=lambda r: r.PULocationID) == [(1, 3.0, None), (4, 6.0, "Y")]


def test_catalog_registration(spark, tmp_path):
    p = str(tmp_path / "daily")
    write_partitioned(spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))],
                                            "total_trips long, pickup_date date"), p, "pickup_date")
    name = catalog.register_table(spark, "nyctlc_aggregated", "daily_t", p, partitioned=True)
    assert spark.table(name).count() == 2


def test_raw_to_curated_and_gold_jobs(spark, lake, tmp_path):
    cur = str(tmp_path / "curated")
    counts = md.raw_to_curated(spark, lake.bronze_path, lake.zones_path, cur)
    f = rp.stage_funnel(lake.bronze()).first()
    assert (counts.raw_rows, counts.provider_rows, counts.dq_rows, counts.curated_rows) == \
           (f.raw_rows, f.provider_rows, f.dq_rows, f.curated_rows)
    back = readers.scan_curated(spark, cur)
    assert back.count() == counts.curated_rows
    assert back.exceptAll(lake.curated()).count() == 0
    # partition pruning on the date
    plan = plan_text(back.filter(F.col("pickup_date") == "2024-02-01"))
    assert "PartitionFilters: [isnotnull(pickup_date" in plan
    out = md.GoldPaths(str(tmp_path / "d"), str(tmp_path / "h"), str(tmp_path / "r"))
    assert (counts.date_partitions, counts.columns) == (back.select("pickup_date").distinct().count(), 36)
    for one_pass, persist in ((True, False), (False, False), (False, True)):
        report = md.curated_to_gold(spark, cur, out, one_pass=one_pass, persist=persist).collect()
        assert all(r.status == "OK" for r in report) and len(report) == 3
    assert spark.read.parquet(out.daily).count() == lake.daily().count()


def test_dq_check_job(spark, lake, tmp_path):
    summary = md.dq_check(spark, lake.bronze_path, str(tmp_path / "rej"), str(tmp_path / "qs")).collect()
    expect = rp.quality_summary(lake.tagged()).collect()
    assert [tuple(r) for r in summary] == [tuple(r) for r in expect]
    rej = spark.read.parquet(str(tmp_path / "rej"))
    assert rej.count() == sum(r.record_count for r in summary if r.status == "REJECTED")
    assert set(os.listdir(tmp_path / "rej")) >= {"rejection_reason=null_fare"}


def test_zone_summary_job_writes_json(spark, lake, tmp_path):
    out = str(tmp_path / "zs")
    md.zone_summary_job(spark, lake.zones_path, out, "2024-01-01T00:00:00+00:00")
    text = "".join(open(os.path.join(out, f)).read() for f in os.listdir(out) if f.startswith("part-"))
    doc = json.loads(text)
    assert doc["source"] == lake.zones_path and doc["total_zones"] == 25
    assert doc["sample_records"][4]["service_zone"] is None  # NULL fields stay, as null
    assert all(set(r) == {"LocationID", "Borough", "Zone", "service_zone"} for r in doc["sample_records"])


def test_ingest_job_and_dry_run(spark, lake, tmp_path):
    bronze, doc = str(tmp_path / "bronze"), str(tmp_path / "doc")
    dry = md.ingest_job(spark, lake.landing_path(), bronze, "2024-08-15", 2, 4, 2, dry_run=True).collect()
    assert [r.status for r in dry] == ["DRY_RUN", "DRY_RUN"] and not os.path.exists(bronze)
    assert all(r.size_bytes > 0 for r in dry)
    man_df = md.ingest_job(spark, lake.landing_path(), bronze, "2024-08-15", 2, 4, 2, zones_path=lake.zones_path,
                           zones_target=str(tmp_path / "zones"), manifest_path=doc)
    man = [r for r in man_df.collect() if r.file != "taxi_zone_lookup"]
    assert [r.file for r in man] == ["fhvhv_tripdata_2024-05.parquet", "fhvhv_tripdata_2024-06.parquet"]
    assert all(r.status == "SUCCESS" and r.size_bytes > 0 and r.size_mb >= 0 for r in man)
    landed = landing.read_landed(spark, bronze)
    assert landed.count() == sum(r.row_count for r in man)
    tot = landing.manifest_totals(man_df).first()
    assert (tot.files_uploaded, tot.files_total) == (3, 3)
    assert readers.scan_zones(spark, str(tmp_path / "zones")).count() == 25
    written = json.loads("".join(open(os.path.join(doc, f)).read() for f in os.listdir(doc) if f.startswith("part-")))
    assert (written["status"], written["dry_run"], written["files_uploaded"], written["errors"]) == ("SUCCESS", False, 3, [])
    zone = next(f for f in written["files"] if f["file"] == "taxi_zone_lookup")
    assert zone["size_kb"] > 0 and zone["error"] is None
    # a later run that chooses one month reports that month alone, landed in one job
    again = md.ingest_job(spark, lake.landing_path(), bronze, "2024-06-15", 2, 4, 1, isolate_months=False).collect()
    assert [(r.file, r.status) for r in again] == [("fhvhv_tripdata_2024-04.parquet", "SUCCESS")]


def test_ingest_keeps_every_row_of_a_file(spark, tmp_path):
    land, bronze = str(tmp_path / "land"), str(tmp_path / "bronze")
    t = dt.datetime(2024, 4, 3, 9, 0, 0)
    rows = [dict(pickup_datetime=t), dict(pickup_datetime=None, trip_miles=1.0), dict(pickup_datetime=t.replace(year=2031))]
    trips_df(spark, rows).withColumn("new_column", F.lit("x")).write.parquet(f"{land}/fhvhv_tripdata_2024-04.parquet")
    trips_df(spark, rows[:1]).write.parquet(f"{land}/fhvhv_tripdata_2024-05.parquet")
    trips_df(spark, rows[:1]).write.parquet(f"{land}/other_2024-03.parquet")
    man = md.ingest_job(spark, land, bronze, "2024-06-15", 1, 14, 6).collect()
    assert [(r.file[-15:-8], r.row_count) for r in man] == [("2024-04", 3), ("2024-05", 1)]
    assert landing.read_landed(spark, bronze).filter("pickup_datetime IS NULL AND source_month = '2024-04'").count() == 1
    # the new column of one month reaches the rejected rows
    md.dq_check(spark, bronze, str(tmp_path / "rej"), str(tmp_path / "qs"))
    rej = spark.read.parquet(str(tmp_path / "rej"))
    assert rej.filter("new_column = 'x'").count() == 3 and rej.count() == 4


def test_ingest_without_months(spark, tmp_path):
    os.makedirs(tmp_path / "land")
    with pytest.raises(md.NoMonthsError, match="no monthly file"):
        md.ingest_job(spark, str(tmp_path / "land"), str(tmp_path / "b"), "2024-06-15")


def test_landing_plan_has_no_shuffle(spark, lake):
    files = [p for p, _ in md.mo.month_files(spark, lake.landing_path()).values()]
    plan = plan_text(landing.with_source_month(readers.scan_trips(spark, files, merge_schema=True)))
    assert "Exchange" not in plan and len(files) == 6
    assert "Scan parquet" not in plan_text(md.mo.available_months(spark, lake.landing_path()))


@pytest.mark.parametrize("damage", ["junk", "missing", "type"])
def test_gold_validation_fails_on_columns(spark, lake, tmp_path, damage):
    out = md.GoldPaths(str(tmp_path / "d"), str(tmp_path / "h"), str(tmp_path / "r"))
    written = md.write_gold_one_pass(spark, lake.curated(), out)
    assert {r.status for r in md.validate_gold(spark, out, written).collect()} == {"OK"}
    good = spark.read.parquet(out.hourly)
    bad = {"junk": spark.range(written["hourly"]).select(F.col("id").alias("junk")), "missing": good.drop("avg_fare"),
           "type": good.withColumn("avg_fare", F.col("avg_fare").cast("string"))}[damage]
    bad = spark.createDataFrame(bad.collect(), bad.schema)
    bad.write.mode("overwrite").parquet(out.hourly)
    status = {r.table: r.status for r in md.validate_gold(spark, out, written).collect()}
    assert status == {"daily": "OK", "hourly": "MISMATCH", "routes": "OK"}


def test_one_bad_row_does_not_end_a_job(spark, lake, tmp_path):
    t = dt.datetime(2024, 4, 3, 9, 0, 0)
    good = dict(hvfhs_license_num="HV0005", pickup_datetime=t, dropoff_datetime=t.replace(minute=20), PULocationID=1,
                DOLocationID=2, trip_miles=3.0, base_passenger_fare=9.0, trip_time=1200, request_datetime=t)
    rows = [good, good | {"trip_time": 2 ** 62}, good | {"PULocationID": 2 ** 31}, good | {"trip_time": -2 ** 63}]
    bronze = str(tmp_path / "bronze")
    trips_df(spark, rows).coalesce(1).write.parquet(bronze)
    counts = md.raw_to_curated(spark, bronze, lake.zones_path, str(tmp_path / "cur"))
    assert (counts.raw_rows, counts.dq_rows, counts.curated_rows) == (4, 2, 2)
    f = rp.stage_funnel(readers.scan_trips(spark, bronze)).first()
    assert (f.raw_rows, f.dq_rows, f.curated_rows) == (4, 2, 2)
    back = readers.scan_curated(spark, str(tmp_path / "cur")).collect()
    assert sorted((r.PULocationID, r.pickup_borough is None) for r in back if r.PULocationID) == [(1, False)]
    summary = md.dq_check(spark, bronze, str(tmp_path / "rej"), str(tmp_path / "qs")).collect()
    assert sum(r.record_count for r in summary) == 4


def test_dq_job_reports(spark, lake, tmp_path):
    out = md.dq_job(spark, lake.bronze_path, str(tmp_path / "rej"), str(tmp_path / "qs"))
    assert out["totals"].collect() == rp.dq_totals(lake.tagged()).collect()
    assert sum(r.trip_count for r in out["monthly_raw"].collect()) == lake.bronze().count()
    assert set(out) == {"summary", "totals", "monthly", "providers", "monthly_raw"}


def test_landing_stream_available_now(spark, tmp_path):
    from tiertrip.streaming.landing import run_landing_once
    src, dst, ck = str(tmp_path / "src"), str(tmp_path / "dst"), str(tmp_path / "ck")
    t = dt.datetime(2024, 1, 5, 8, 0, 0)
    trips_df(spark, [dict(pickup_datetime=t, trip_miles=float(i)) for i in range(20)]).coalesce(1) \
        .write.mode("append").parquet(src)
    assert run_landing_once(spark, src, dst, ck) == 20
    trips_df(spark, [dict(pickup_datetime=t.replace(month=2), trip_miles=1.0) for _ in range(5)]).coalesce(1) \
        .write.mode("append").parquet(src)
    assert run_landing_once(spark, src, dst, ck) == 5  # only the new file
    for i in range(3):  # one batch per file: all are counted
        trips_df(spark, [dict(pickup_datetime=t, trip_miles=1.0)] * 2).coalesce(1).write.mode("append").parquet(src)
    assert run_landing_once(spark, src, dst, ck, max_files_per_trigger=1) == 6
    back = spark.read.parquet(dst)
    assert back.count() == 31 and {r.source_month for r in back.select("source_month").distinct().collect()} == \
        {"2024-01", "2024-02"}


def test_funnel_recounted_when_map_stage_metrics_disagree(spark, lake, tmp_path, monkeypatch):
    """Simulate a re-run map stage whose tasks hold neither curated nor rejected rows: the total alone is off."""
    real = md.observed

    class Doubled:
        def __init__(self, obs):
            self.obs = obs

        @property
        def get(self):
            m = dict(self.obs.get)
            return m | {k: m[k] + 7 for k in ("raw_rows", "total", "provider_rows", "good") if k in m}

    def rerun(df, name, **metrics):
        out, obs = real(df, name, **metrics)
        return out, Doubled(obs)

    monkeypatch.setattr(md, "observed", rerun)
    counts = md.raw_to_curated(spark, lake.bronze_path, lake.zones_path, str(tmp_path / "c"))
    f = rp.stage_funnel(lake.bronze()).first()
    assert (counts.raw_rows, counts.curated_rows) == (f.raw_rows, f.curated_rows)
    summary = md.dq_check(spark, lake.bronze_path, str(tmp_path / "rej"), str(tmp_path / "qs")).collect()
    assert [tuple(r) for r in summary] == [tuple(r) for r in rp.quality_summary(lake.tagged()).collect()]


def test_cli_runs_the_layers(spark, lake, tmp_path):
    import shutil
    from tiertrip.config import LakePaths
    from tiertrip.plans import cli
    root = str(tmp_path / "lake")
    lp = LakePaths(root)
    shutil.copytree(lake.bronze_path, lp.path("trips_raw"))
    shutil.copytree(lake.zones_path, lp.path("zones_raw"))
    for job in ("raw-to-curated", "curated-to-gold", "dq-check", "zone-summary", "register", "report"):
        assert cli.main([job, "--lake", root]) == 0
    assert cli.main(["saved-query", "--lake", root, "--name", "q5", "--zones", "NATION_1,NATION_2"]) == 0
    assert spark.table("nyctlc_aggregated.daily_borough_summary").count() == lake.daily().count()


def test_one_pass_gold_equals_separate_rollups(spark, lake):
    from tiertrip.operators import rollup as ru
    split = ru.split_gold(ru.gold_one_pass(lake.curated()))
    for name, sep in (("daily", lake.daily(sort=False)), ("hourly", lake.hourly(sort=False)),
                      ("routes", lake.routes(sort=False))):
        one = split[name]
        assert one.columns == sep.columns
        assert one.exceptAll(sep).count() == 0 and sep.exceptAll(one).count() == 0, name
    plan = plan_text(ru.gold_one_pass(lake.curated()))
    assert len(re.findall(r"\(\d+\) Scan parquet", plan)) == 1 and "Expand" in plan


def test_jobs_on_empty_input(spark, lake, tmp_path):
    bronze, zones = str(tmp_path / "bronze"), lake.zones_path
    trips_df(spark, []).write.parquet(bronze)
    cur = str(tmp_path / "cur")
    counts = md.raw_to_curated(spark, bronze, zones, cur)
    assert (counts.raw_rows, counts.curated_rows) == (0, 0)
    assert readers.scan_curated(spark, cur).count() == 0
    out = md.GoldPaths(str(tmp_path / "d"), str(tmp_path / "h"), str(tmp_path / "r"))
    report = md.curated_to_gold(spark, cur, out).collect()
    assert [(r.table, r.rows_read, r.status) for r in report] == [("daily", 0, "OK"), ("hourly", 0, "OK"),
                                                                   ("routes", 0, "OK")]
    summary = md.dq_check(spark, bronze, str(tmp_path / "rej"), str(tmp_path / "qs")).collect()
    assert [tuple(r) for r in summary] == [("PASSED_ALL_RULES", 0, 100.0, "PASSED")]


def test_rerun_is_idempotent(spark, lake, tmp_path):
    cur = str(tmp_path / "cur")
    first = md.raw_to_curated(spark, lake.bronze_path, lake.zones_path, cur)
    a = readers.scan_curated(spark, cur).collect()
    second = md.raw_to_curated(spark, lake.bronze_path, lake.zones_path, cur)
    b = readers.scan_curated(spark, cur).collect()
    assert first == second and sorted(a, key=str) == sorted(b, key=str)


def test_ingest_one_failed_month_does_not_stop_the_rest(spark, lake, tmp_path, monkeypatch):
    from tiertrip.sinks import landing as ld
    bronze = str(tmp_path / "bronze")
    real = ld.write_partitioned

    def flaky(df, target, col, **kw):
        months = {r[0] for r in df.select(col).distinct().collect()}
        if "2024-05" in months:
            raise OSError("simulated failure for 2024-05")
        return real(df, target, col, **kw)

    monkeypatch.setattr(ld, "write_partitioned", flaky)
    man = md.ingest_job(spark, lake.landing_path(), bronze, "2024-08-15", 2, 6, 3).collect()
    status = {r.file: (r.status, r.error) for r in man}
    assert status["fhvhv_tripdata_2024-05.parquet"][0] == "FAILED"
    assert "simulated failure" in status["fhvhv_tripdata_2024-05.parquet"][1]
    assert status["fhvhv_tripdata_2024-06.parquet"] == ("SUCCESS", None)
    assert status["fhvhv_tripdata_2024-04.parquet"] == ("SUCCESS", None)
    landed = {r.source_month for r in landing.read_landed(spark, bronze).select("source_month").distinct().collect()}
    assert landed == {"2024-04", "2024-06"}


class _StubConf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _StubSession:
    """Only what ``shared_dir`` reads when spark.checkpoint.dir is unset."""

    def __init__(self, master):
        self.conf = _StubConf({"spark.master": master})

    @property
    def sparkContext(self):
        raise RuntimeError("no context")


def test_shared_dir_needs_a_checkpoint_dir_on_a_cluster():
    from tiertrip.session import shared_dir
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_StubSession("yarn"))


def test_shared_dir_is_the_configured_checkpoint_dir(spark):
    from tiertrip.session import shared_dir
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
