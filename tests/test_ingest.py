"""The streamed and the batch ingest: schema merge, type resolution, replacement, replay, manifests, dry run."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import plan_text, trips_df
from tiertrip import schemas
from tiertrip.plans import medallion as md
from tiertrip.sinks import landing
from tiertrip.sources import footers, readers
from tiertrip.streaming import landing as stream

T0 = dt.datetime(2024, 4, 3, 9, 0, 0)


def month(spark, place, name, n, **extra):
    df = trips_df(spark, [dict(pickup_datetime=T0, trip_miles=float(i)) for i in range(n)])
    for k, v in extra.items():
        df = df.withColumn(k, v)
    df.coalesce(1).write.parquet(f"{place}/fhvhv_tripdata_{name}.parquet")


def by_month(spark, bronze):
    return {r["source_month"]: r["landed_rows"] for r in landing.landed_summary(landing.read_landed(spark, bronze)).collect()}


def test_stream_keeps_new_columns_and_resolves_their_types(spark, tmp_path):
    src, dst, ck = (str(tmp_path / d) for d in ("src", "dst", "ck"))
    month(spark, src, "2024-01", 3)
    month(spark, src, "2024-02", 2, new_col=F.lit(7), text=F.lit("x"))
    assert stream.run_landing_once(spark, src, dst, ck) == 5
    month(spark, src, "2024-03", 4, new_col=F.lit("seven"))
    assert stream.run_landing_once(spark, src, dst, ck) == 4
    assert stream.run_landing_once(spark, src, dst, ck) == 0  # nothing new
    rows = readers.scan_trips(spark, dst, merge_schema=True).select("source_month", "new_col", "text").distinct().collect()
    assert {tuple(r) for r in rows} == {("2024-01", None, None), ("2024-02", "7", "x"), ("2024-03", "seven", None)}


def test_stream_replaces_a_month_delivered_again(spark, tmp_path):
    src, dst, ck = (str(tmp_path / d) for d in ("src", "dst", "ck"))
    month(spark, src, "2024-01", 3)
    month(spark, src, "2024-02", 2)
    stream.run_landing_once(spark, src, dst, ck)
    month(spark, f"{src}/again", "2024-01", 8)
    assert stream.run_landing_once(spark, src, dst, ck) == 8
    assert by_month(spark, dst) == {"2024-01": 8, "2024-02": 2}
    # two deliveries of one month in one batch: the newer one counts
    month(spark, f"{src}/x", "2024-03", 5)
    month(spark, f"{src}/y", "2024-03", 6)
    for file in os.listdir(f"{src}/x/fhvhv_tripdata_2024-03.parquet"):
        os.utime(f"{src}/x/fhvhv_tripdata_2024-03.parquet/{file}", (2e9, 2e9))
    assert stream.run_landing_once(spark, src, dst, ck) == 5
    assert by_month(spark, dst) == {"2024-01": 8, "2024-02": 2, "2024-03": 5}


def test_stream_completes_a_folder_split_over_batches(spark, tmp_path):
    src, dst, ck = (str(tmp_path / d) for d in ("src", "dst", "ck"))
    trips_df(spark, [dict(pickup_datetime=T0)] * 9).repartition(3).write.parquet(f"{src}/fhvhv_tripdata_2024-01.parquet")
    stream.run_landing_once(spark, src, dst, ck, max_files_per_trigger=1)
    assert by_month(spark, dst) == {"2024-01": 9}


@pytest.mark.parametrize("cut", ["before the record", "after the record"])
def test_replayed_batch_changes_nothing(spark, tmp_path, cut):
    src, dst, ck = (str(tmp_path / d) for d in ("src", "dst", "ck"))
    month(spark, src, "2024-01", 3)
    trips_df(spark, [dict(pickup_datetime=T0)] * 2).coalesce(1).write.parquet(f"{src}/loose.parquet")
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet") \
        .load(src).select("path", "modificationTime")
    assert stream.land_batch(spark, names, 0, dst, ck) == 5
    want = sorted(str(r) for r in readers.scan_trips(spark, dst).collect())
    if cut == "before the record":
        os.remove(f"{ck}/landed/0.json")
        os.makedirs(f"{dst}/_staging-batch0/left", exist_ok=True)
    stream.land_batch(spark, names, 0, dst, ck)
    assert sorted(str(r) for r in readers.scan_trips(spark, dst).collect()) == want and by_month(spark, dst) == {"2024-01": 3, "2024-04": 2}


def test_stream_reads_names_only(spark, tmp_path):
    month(spark, str(tmp_path), "2024-01", 1)
    names = spark.read.format("binaryFile").schema(stream.FILES_SCHEMA).option("recursiveFileLookup", "true").load(str(tmp_path))
    assert "content" not in plan_text(names.select("path", "modificationTime")).split("ReadSchema")[1]


def test_int_in_one_month_and_text_in_another_reach_the_rejected_table(spark, tmp_path):
    land, bronze = str(tmp_path / "land"), str(tmp_path / "bronze")
    month(spark, land, "2024-04", 2, score=F.lit(5), level=F.lit(1), price=F.lit(1).cast("decimal(5,2)"), day=F.lit("2024-01-01").cast("date"))
    month(spark, land, "2024-05", 1, score=F.lit("high"), level=F.lit(2 ** 40), price=F.lit(2.5), day=F.lit("2024-01-02 03:00:00").cast("timestamp"),
          nested=F.struct(F.lit(1).alias("a")))
    month(spark, land, "2024-06", 1, nested=F.lit("plain"))
    man = md.ingest_job(spark, land, bronze, "2024-07-15", 1, 14, 6).collect()
    assert [(r.file[-15:-8], r.row_count, r.status) for r in man] == [("2024-04", 2, "SUCCESS"), ("2024-05", 1, "SUCCESS"), ("2024-06", 1, "SUCCESS")]
    md.dq_check(spark, bronze, str(tmp_path / "rej"), str(tmp_path / "qs"))
    rej = spark.read.parquet(str(tmp_path / "rej"))
    kinds = dict(rej.dtypes)
    assert [kinds[c] for c in ("score", "level", "price", "day", "nested", "source_month")] == \
        ["string", "bigint", "double", "timestamp", "string", "string"]
    rows = rej.select("source_month", "score", "level", "price", F.col("day").cast("string"), "nested").distinct().collect()
    assert {tuple(r) for r in rows} == {("2024-04", "5", 1, 1.0, "2024-01-01 00:00:00", None),
                                        ("2024-05", "high", 2 ** 40, 2.5, "2024-01-02 03:00:00", "{1}"),
                                        ("2024-06", None, None, None, None, "plain")}


def test_types_that_differ_inside_one_folder(spark, tmp_path):
    p = str(tmp_path / "bronze")
    for n, v in ((1, F.lit(1)), (2, F.lit("b"))):
        trips_df(spark, [dict(pickup_datetime=T0)] * n).withColumn("extra", v).coalesce(1).write.mode("append").parquet(p)
    rows = readers.scan_trips(spark, p, merge_schema=True)
    assert sorted(r.extra for r in rows.collect()) == ["1", "b", "b"] and rows.columns == [*schemas.RAW_TRIP.fieldNames(), "extra"]


def test_same_types_are_read_in_one_scan(spark, tmp_path):
    land = str(tmp_path)
    month(spark, land, "2024-04", 1, extra=F.lit(1))
    month(spark, land, "2024-05", 1, extra=F.lit(2))
    df = readers.scan_trips(spark, [f"{land}/fhvhv_tripdata_2024-0{k}.parquet" for k in (4, 5)], merge_schema=True)
    assert plan_text(df).count("Scan parquet") == 2 and "Union" not in plan_text(df)  # the tree and its detail
    assert sorted(r.extra for r in df.collect()) == [1, 2]


@pytest.mark.parametrize("kinds,want", [
    (["int", "bigint"], "bigint"), (["tinyint"], "tinyint"), (["int", "double"], "double"), (["float", "bigint"], "double"),
    (["decimal(5,2)", "decimal(10,0)"], "decimal(12,2)"), (["decimal(5,2)", "int"], "decimal(12,2)"),
    (["decimal(38,2)", "bigint"], "decimal(38,2)"), (["decimal(38,30)", "bigint"], "string"), (["decimal(5,2)", "float"], "double"), (["date", "timestamp"], "timestamp"),
    (["date", "timestamp_ntz"], "timestamp_ntz"), (["timestamp", "timestamp_ntz"], "string"), (["int", "string"], "string"),
    (["boolean", "int"], "string"), (["struct<a:int>", "int"], "string"), (["void", "int"], "int"), (["void"], "string")])
def test_widest_type(kinds, want):
    assert footers.widest(kinds) == want == footers.widest(kinds[::-1])


def test_footers_match_what_spark_reads(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq
    p = str(tmp_path / "t")
    spark.range(10).select("id", F.lit(T0).alias("at"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ntz"),
                           F.lit(1).cast("decimal(7,3)").alias("d"), F.array(F.lit(1)).alias("a")).repartition(3).write.parquet(p)
    pq.write_table(pa.table({"id": pa.array([1], pa.int32()), "ts": pa.array([0], pa.timestamp("us", "UTC")),
                             "ntz": pa.array([0], pa.timestamp("us")), "s": ["x"]}), f"{p}/other.parquet")
    (tmp_path / "t" / "_hidden").mkdir()
    pq.write_table(pa.table({"z": [1]}), f"{p}/_hidden/z.parquet")
    files = footers.data_files(spark, p)
    facts = footers.footers(spark, files).collect()
    assert sum(r.rows for r in facts) == 11 and len(facts) == len(files) == 4
    for r in facts:
        read = spark.read.parquet(r.file).schema
        assert {c["name"]: c["type"] for c in r.columns} == {f.name: f.dataType.simpleString() for f in read.fields}
    # a store that only Spark's reader knows: the reader answers
    monkeypatch.setattr(footers, "reachable", lambda files: False)
    assert sum(r.rows for r in footers.footers(spark, files).collect()) == 11


def test_two_runs_leave_two_entries(spark, lake, tmp_path):
    bronze, doc, hist = (str(tmp_path / d) for d in ("bronze", "doc", "hist"))
    run = lambda as_of, at, **kw: md.ingest_job(spark, lake.landing_path(), bronze, as_of, 2, 4, 1, zones_path=lake.zones_path,
                                                zones_target=str(tmp_path / "zones"), manifest_path=doc, history_path=hist, run_at=at, **kw)
    run("2024-08-15", "2024-08-15T01:00:00+00:00")
    run("2024-07-15", "2024-08-16T01:00:00+00:00")
    run("2024-07-15", "2024-08-16T01:00:00+00:00")  # the same run again
    runs = landing.read_history(spark, hist).collect()
    assert [(r.timestamp[:10], r.status, r.files_uploaded, r.files_total) for r in runs] == \
        [("2024-08-15", "SUCCESS", 2, 2), ("2024-08-16", "SUCCESS", 2, 2)]
    assert [json.loads(r.json)["files"][0]["file"] for r in runs] == ["fhvhv_tripdata_2024-06.parquet", "fhvhv_tripdata_2024-05.parquet"]
    written = json.loads("".join(open(os.path.join(doc, f)).read() for f in os.listdir(doc) if f.startswith("part-")))
    assert written["timestamp"] == "2024-08-16T01:00:00+00:00" and not written["dry_run"]
    # a dry run lists the zone table too and leaves every document as it is
    before = sorted((str(p), p.stat().st_mtime) for p in tmp_path.rglob("*"))
    listed = run("2024-08-15", "2024-08-17T01:00:00+00:00", dry_run=True)
    dry = listed.collect()
    assert [(r.file, r.status) for r in dry] == [("fhvhv_tripdata_2024-06.parquet", "DRY_RUN"), ("taxi_zone_lookup", "DRY_RUN")]
    assert dry[1].size_kb == round(dry[1].size_bytes / 1024, 1) > 0 and dry[1].target == str(tmp_path / "zones")
    assert sorted((str(p), p.stat().st_mtime) for p in tmp_path.rglob("*")) == before
    summary = landing.result_document(listed, True, "2024-08-17T01:00:00+00:00").first()
    assert (summary.files_uploaded, summary.files_total, summary.dry_run) == (0, 2, True)


def test_manifest_reads_footers_and_no_rows(spark, lake, tmp_path):
    bronze = str(tmp_path / "bronze")
    files = md.mo.month_files(spark, lake.landing_path())
    landing.land_months(spark, [p for p, _ in files.values()], bronze)
    man = landing.ingest_manifest(spark, bronze, "base", "target")
    assert "Scan parquet" not in plan_text(man)
    assert {r.file[-15:-8]: r.row_count for r in man.collect()} == by_month(spark, bronze)
    one = landing.ingest_manifest(spark, bronze, "base", "target", months=["2024-03"]).collect()
    size = sum(os.path.getsize(f"{bronze}/source_month=2024-03/{f}") for f in os.listdir(f"{bronze}/source_month=2024-03") if f.endswith(".parquet"))
    assert [(r.target, r.size_bytes) for r in one] == [("target/source_month=2024-03/", size)]
    assert isinstance(man.schema["row_count"].dataType, T.LongType)
