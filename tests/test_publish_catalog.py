"""Staged publication, per-partition validation, one-pass quality reports, catalog updates in place."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_text, trips_df
from tiertrip import schemas
from tiertrip.operators import quality as q
from tiertrip.operators import reports as rp
from tiertrip.plans import medallion as md
from tiertrip.sinks import catalog, publish
from tiertrip.sinks.writers import write_counted, write_json_document, write_partitioned, write_table
from tiertrip.sources import readers


def rows(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).collect())


def left(tmp_path):
    return sorted(n for n in os.listdir(tmp_path) if n.startswith("_"))


class Killed(BaseException):
    pass


@pytest.mark.parametrize("dynamic", [False, True])
def test_a_failed_write_leaves_the_old_layer_whole(spark, tmp_path, dynamic):
    p = str(tmp_path / "t")
    write_partitioned(spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string"), p, "k")
    bad = spark.range(40).select(F.when(F.col("id") < 39, F.col("id")).otherwise(F.raise_error(F.lit("boom"))).cast("int").alias("v"),
                                 F.lit("b").alias("k")).repartition(8)
    with pytest.raises(Exception, match="boom"):
        write_partitioned(bad, p, "k", dynamic=dynamic)
    assert rows(spark, p) == [(1, "a"), (2, "b")] and left(tmp_path) == []
    with pytest.raises(Exception, match="boom"):
        write_table(bad, p)
    assert rows(spark, p) == [(1, "a"), (2, "b")]


def test_a_job_killed_in_its_write_leaves_the_old_layer_whole(spark, tmp_path, monkeypatch):
    p = str(tmp_path / "t")
    write_table(spark.createDataFrame([(1,)], "v int"), p)
    real = publish.write_text

    def killed(spark, path, text):  # the process ends after the write, before the publication begins
        raise Killed

    monkeypatch.setattr(publish, "write_text", killed)
    with pytest.raises(Killed):
        write_table(spark.createDataFrame([(2,)], "v int"), p)
    assert rows(spark, p) == [(1,)] and not publish.recover(spark, p)
    monkeypatch.setattr(publish, "write_text", real)
    write_table(spark.createDataFrame([(3,)], "v int"), p)
    assert rows(spark, p) == [(3,)]


@pytest.mark.parametrize("dynamic", [False, True])
@pytest.mark.parametrize("moves", [0, 1, 2, 3])
def test_a_publication_cut_off_is_finished(spark, tmp_path, monkeypatch, dynamic, moves):
    p = str(tmp_path / "t")
    write_partitioned(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "v int, k string"), p, "k")
    real, done = publish.rename_path, []

    def cut(spark, path, to):
        if len(done) == moves:
            raise Killed
        done.append(to)
        real(spark, path, to)

    monkeypatch.setattr(publish, "rename_path", cut)
    new = spark.createDataFrame([(4, "b"), (5, "c"), (6, "d")], "v int, k string")
    try:
        write_partitioned(new, p, "k", dynamic=dynamic)
    except Killed:
        pass
    monkeypatch.setattr(publish, "rename_path", real)
    publish.recover(spark, p)
    kept = [(1, "a")] if dynamic else []
    assert rows(spark, p) == kept + [(4, "b"), (5, "c"), (6, "d")] and left(tmp_path) == []
    assert not publish.recover(spark, p)


def test_a_layer_may_be_written_from_itself(spark, tmp_path):
    p = str(tmp_path / "t")
    write_table(spark.range(5).toDF("v"), p)
    write_table(spark.read.parquet(p).filter("v > 1"), p)
    assert [v for v, in rows(spark, p)] == [2, 3, 4]
    doc = str(tmp_path / "doc")
    for n in (1, 2):
        write_json_document(spark.createDataFrame([(n,)], "n int"), doc)
    assert [r.value for r in spark.read.text(doc).collect()] == ['{"n":2}'] and left(tmp_path) == []


def test_counts_of_each_partition_ride_along_the_write(spark, tmp_path):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    data = [(i, day(i % 7) if i % 10 else None) for i in range(500)]
    n, parts = write_counted(spark.createDataFrame(data, "v int, d date").repartition(5), str(tmp_path / "d"), "d")
    want = {}
    for _, d in data:
        key = -(1 << 31) if d is None else (d - dt.date(1970, 1, 1)).days
        want[key] = want.get(key, 0) + 1
    assert (n, parts) == (500, want)
    assert md.check_partitions(spark, str(tmp_path / "d"), "d", "date", parts, whole=True) == []
    n, parts = write_counted(spark.createDataFrame([(1, "2024"), (2, "b/c"), (3, None), (4, "b/c")], "v int, k string"), str(tmp_path / "k"), "k")
    assert sorted(parts.values()) == [1, 1, 2]
    assert md.check_partitions(spark, str(tmp_path / "k"), "k", "string", parts, whole=True) == []
    assert write_counted(spark.createDataFrame([], "v int, k string"), str(tmp_path / "e"), "k") == (0, {})
    assert md.check_partitions(spark, str(tmp_path / "e"), "k", "string", {}, whole=True) == []


def test_more_partitions_than_are_counted(spark, tmp_path, monkeypatch):
    from tiertrip.sinks import writers
    monkeypatch.setattr(writers, "COUNTED_PARTITIONS", 4)
    n, parts = write_counted(spark.range(9).selectExpr("id", "cast(id as string) k"), str(tmp_path / "k"), "k")
    assert (n, parts) == (9, None) and md.check_partitions(spark, str(tmp_path / "k"), "k", "string", None, whole=True) == []


def silver_input(spark, tmp_path, days, name):
    t = dt.datetime(2024, 4, 1, 9, 0, 0)
    good = dict(hvfhs_license_num="HV0005", PULocationID=1, DOLocationID=2, trip_miles=3.0, base_passenger_fare=9.0, trip_time=1200)
    trips = [good | dict(request_datetime=t, pickup_datetime=t.replace(day=d), dropoff_datetime=t.replace(day=d, minute=20)) for d in days]
    trips_df(spark, trips).write.parquet(str(tmp_path / name))
    return str(tmp_path / name)


@pytest.mark.parametrize("damage", ["lost rows", "lost partition", "none"])
def test_dynamic_validation_sees_a_wrong_partition(spark, lake, tmp_path, monkeypatch, damage):
    cur = str(tmp_path / "cur")
    md.raw_to_curated(spark, silver_input(spark, tmp_path, [1, 1, 2, 3], "a"), lake.zones_path, cur)
    real = md.write_counted

    def write(*a, **kw):
        out = real(*a, **kw)
        part = f"{cur}/pickup_date=2024-04-05"
        for f in os.listdir(part):
            if damage != "none":
                os.remove(f"{part}/{f}")
        if damage == "lost rows":
            spark.read.parquet(f"{cur}/pickup_date=2024-04-01").limit(1).write.mode("append").parquet(part)
        return out

    monkeypatch.setattr(md, "write_counted", write)
    second = silver_input(spark, tmp_path, [2, 5, 5], "b")
    if damage == "none":  # older partitions lie beside the new ones
        counts = md.raw_to_curated(spark, second, lake.zones_path, cur, dynamic=True)
        assert (counts.curated_rows, counts.date_partitions) == (3, 4)
        assert readers.scan_curated(spark, cur).groupBy("pickup_date").count().orderBy("pickup_date").toPandas()["count"].tolist() == [2, 1, 1, 2]
    else:
        with pytest.raises(md.ValidationError, match="pickup_date=2024-04-05: 1 rows of 2" if damage == "lost rows" else "0 rows of 2"):
            md.raw_to_curated(spark, second, lake.zones_path, cur, dynamic=True)


def test_partition_count_comes_from_the_listing(spark, lake, tmp_path):
    cur = str(tmp_path / "cur")
    counts = md.raw_to_curated(spark, lake.bronze_path, lake.zones_path, cur)
    assert counts.date_partitions == rp.transformation_summary(lake.bronze()).first().date_partitions
    for part in os.listdir(cur):  # no file is opened
        if "=" in part:
            for f in os.listdir(f"{cur}/{part}"):
                os.truncate(f"{cur}/{part}/{f}", 0)
    assert md.partition_folders(spark, cur, "pickup_date") == counts.date_partitions


def test_quality_reports_come_from_one_scan(spark, lake, tmp_path):
    tagged = lake.tagged()
    combined = rp.dq_one_pass(tagged)
    plan = plan_text(combined)
    assert len(re.findall(r"\(\d+\) Scan parquet", plan)) == 1 and len(re.findall(r"\(\d+\) Exchange", plan)) == 1
    parts = rp.split_dq(combined)
    assert parts["totals"].collect() == rp.dq_totals(tagged).collect()
    assert parts["monthly"].collect() == rp.monthly_dq(tagged).collect()
    assert parts["providers"].collect() == rp.provider_breakdown(lake.bronze()).collect()
    assert parts["monthly_raw"].collect() == rp.monthly_counts(lake.bronze(), "pickup_datetime").collect()
    empty = rp.split_dq(rp.dq_one_pass(q.tag(trips_df(spark, []))))
    assert [tuple(r) for r in empty["totals"].collect()] == [(0, 0, 0, 100.0, 0.0)] and empty["monthly"].count() == 0


def test_quality_job_reads_the_trips_twice(spark, lake, tmp_path, monkeypatch):
    scans = []
    real = readers.scan_trips
    monkeypatch.setattr(readers, "scan_trips", lambda *a, **kw: scans.append(a) or real(*a, **kw))
    out = md.dq_job(spark, lake.bronze_path, str(tmp_path / "rej"), str(tmp_path / "qs"))
    assert len(scans) == 2
    place = lake.bronze_path.rsplit("/", 1)[-1]
    for name, df in out.items():  # the reports are read from what the two scans wrote
        df.collect()
        assert f"{place}]" not in plan_text(df), name


def test_a_new_month_is_added_in_place(spark, tmp_path, monkeypatch):
    p = str(tmp_path / "layer")
    write = lambda ds, **kw: write_partitioned(spark.createDataFrame([(d, dt.date(2024, 1, d)) for d in ds], "n int, day date"), p, "day", **kw)
    write([1, 2])
    name = catalog.register_table(spark, "cat_test", "layer", p, partitioned=True)
    assert spark.table(name).count() == 2
    ran = []
    real = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **kw: ran.append(text) or real(self, text, *a, **kw))
    monkeypatch.setattr(type(spark.catalog), "recoverPartitions", lambda *a: pytest.fail("all partitions listed again"))
    write([3], dynamic=True)
    catalog.register_table(spark, "cat_test", "layer", p, partitioned=True)
    assert spark.table(name).count() == 3
    changes = [t for t in ran if t.startswith(("ALTER", "DROP", "CREATE TABLE"))]
    assert len(changes) == 1 and changes[0].endswith("ADD IF NOT EXISTS PARTITION (`day` = '2024-01-03')")
    ran.clear()
    catalog.register_table(spark, "cat_test", "layer", p, partitioned=True)  # nothing new
    assert not [t for t in ran if t.startswith(("ALTER", "DROP", "CREATE TABLE"))]
    write([2, 4])  # the whole layer anew: days 1 and 3 are gone
    catalog.register_table(spark, "cat_test", "layer", p, partitioned=True)
    assert sorted(r.n for r in spark.table(name).collect()) == [2, 4]
    assert {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()} == {"day=2024-01-02", "day=2024-01-04"}


def test_a_null_partition_and_odd_values_are_added(spark, tmp_path):
    p = str(tmp_path / "layer")
    write_partitioned(spark.createDataFrame([(1, "a")], "n int, k string"), p, "k")
    name = catalog.register_table(spark, "cat_test", "odd", p, partitioned=True)
    write_partitioned(spark.createDataFrame([(2, "b/c d'e"), (3, None)], "n int, k string"), p, "k", dynamic=True)
    catalog.register_table(spark, "cat_test", "odd", p, partitioned=True)
    assert sorted((r.n, r.k) for r in spark.table(name).collect()) == [(1, "a"), (2, "b/c d'e"), (3, None)]


def test_new_columns_follow_and_other_changes_make_the_table_anew(spark, tmp_path, monkeypatch):
    p, other = str(tmp_path / "t"), str(tmp_path / "u")
    write_table(spark.createDataFrame([(1,)], "a int"), p)
    name = catalog.register_table(spark, "cat_test", "plain", p)
    write_table(spark.createDataFrame([(1, "x")], "a int, b string"), p)
    catalog.register_table(spark, "cat_test", "plain", p)
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, "x")]
    write_table(spark.createDataFrame([("one",)], "a string"), other)
    for place, want in ((other, [("one",)]), (p, [(1, "x")])):  # moved, with another type
        catalog.register_table(spark, "cat_test", "plain", place)
        assert [tuple(r) for r in spark.table(name).collect()] == want
    csv = str(tmp_path / "csv")
    spark.createDataFrame([(1, "z")], "LocationID int, Zone string").write.option("header", True).csv(csv)
    for _ in range(2):
        t = catalog.register_table(spark, "cat_test", "zones", csv, csv_schema="LocationID INT, Zone STRING")
        assert [tuple(r) for r in spark.table(t).collect()] == [(1, "z")]


def test_schema_of_silver_is_still_checked(spark, lake, tmp_path):
    cur = str(tmp_path / "cur")
    md.raw_to_curated(spark, silver_input(spark, tmp_path, [1], "a"), lake.zones_path, cur)
    assert md.read_back(spark, cur, schemas.CURATED, None)[2] == "OK"
    spark.read.parquet(cur).drop("tips").write.parquet(str(tmp_path / "bad"))
    assert md.read_back(spark, str(tmp_path / "bad"), schemas.CURATED, None)[2] == "MISMATCH"


def test_a_run_can_be_cleared(spark):
    from tiertrip.session import clear_run, path_exists, run_path, scratch_path
    place = run_path(spark, "some", "table")
    spark.range(3).write.parquet(place)
    other = scratch_path(spark, "runs", "app-of-another-run", "t")
    spark.range(3).write.parquet(other)
    clear_run(spark, "app-of-another-run")
    assert not path_exists(spark, other) and spark.read.parquet(place).count() == 3
    from pyspark.sql import SparkSession
    assert run_path(spark).endswith(SparkSession.active().sparkContext.applicationId)
