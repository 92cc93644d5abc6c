"""Zone summary (pandas NA semantics) and month selection."""

import json

from tiertrip.operators import zones as zn
from tiertrip.sources import months as mo
from tiertrip.sources import readers


def zones(spark, rows):
    return spark.createDataFrame(rows, "LocationID int, Borough string, Zone string, service_zone string")


def test_na_semantics(spark, tmp_path):
    p = str(tmp_path / "z")
    zones(spark, [(1, "N/A", "a", "EWR"), (2, "Queens", "N/A", "NA"), (3, "Queens", "b", "")]) \
        .coalesce(1).write.option("header", True).csv(p)
    spark_rows = {r.LocationID: r for r in readers.scan_zones(spark, p).collect()}
    assert spark_rows[1].Borough == "N/A"
    na = {r.LocationID: r for r in readers.scan_zones_na(spark, p).collect()}
    assert na[1].Borough is None and na[2].Zone is None and na[2].service_zone is None


def test_all_null_zones_count_zero_and_ties(spark):
    z = zones(spark, [(1, "B", None, "x"), (2, "A", "a", "x"), (3, "C", "c", "y"), (4, None, "d", "y")])
    per = {r.Borough: r.zone_count for r in zn.zones_per_borough(z).collect()}
    assert per == {"A": 1, "C": 1, "B": 0}
    top = zn.top_borough(z).first()
    assert (top.borough, top.zone_count) == ("A", 1)  # tie broken by name
    t = zn.zone_totals(z).first()
    assert (t.total_zones, t.total_boroughs) == (4, 3)


def test_zone_summary_document(spark, lake):
    s = zn.zone_summary(lake.zones_na(), "src", "2024-01-01T00:00:00+00:00")
    doc = json.loads(zn.zone_summary_json(s).first().json)
    assert doc["total_zones"] == 25 and doc["total_boroughs"] == 5
    assert list(doc["zones_per_borough"].values()) == sorted(doc["zones_per_borough"].values(), reverse=True)
    assert sum(doc["zones_per_borough"].values()) == 23  # one NULL borough, one NULL zone name
    assert [r["LocationID"] for r in doc["sample_records"]] == [0, 1, 2, 3, 4]
    assert doc["borough_with_most_zones"]["zone_count"] == max(doc["zones_per_borough"].values())
    # a NULL field stays in the record as null (zone 4's service zone is 'N/A')
    assert all(set(r) == {"LocationID", "Borough", "Zone", "service_zone"} for r in doc["sample_records"])
    assert doc["sample_records"][4]["service_zone"] is None


def test_latest_and_missing_months(spark):
    # months present at -2, -3 and -5 from 2024-08; ask for 3 in range 2..4
    avail = spark.createDataFrame([("2024-06-01",), ("2024-05-01",), ("2024-03-01",)], "m string") \
        .selectExpr("to_date(m) AS month")
    got = [r.month for r in mo.latest_months(avail, "2024-08-20", 2, 4, 3).collect()]
    assert got == ["2024-06", "2024-05"]
    miss = [r.month for r in mo.missing_months(avail, "2024-08-20", 2, 4).collect()]
    assert miss == ["2024-04"]
    first_hit = mo.latest_months(avail, "2024-08-20", 2, 4, 1).first()
    assert (first_hit.months_back, first_hit.file) == (2, "fhvhv_tripdata_2024-06.parquet")


def test_reordered_zone_header_fails(spark, tmp_path):
    import pytest
    p = str(tmp_path / "bad")
    spark.createDataFrame([("Queens", 1, "a", "x")], "Borough string, LocationID int, Zone string, service_zone string") \
        .coalesce(1).write.option("header", True).csv(p)
    with pytest.raises(Exception):
        readers.scan_zones(spark, p).collect()
