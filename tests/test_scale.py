"""What must not grow with the rows: methods the JVM compiles, writes without a sort, no table that is not read."""

import datetime as dt
import math
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001, method_sizes, trips_df
from tiertrip.functions.numeric import Exact, Narrow, rounds_to_at_most, shared_parts
from tiertrip.operators import rollup as ru
from tiertrip.plans import medallion as md
from tiertrip.plans import registry
from tiertrip.plans.lake import TripLake
from tiertrip.sinks import landing as ld
from tiertrip.sinks import writers
from tiertrip.sources import fixtures

#: HotSpot interprets methods of more bytes.
COMPILED = 8000
OPEN = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture()
def row_plans(spark, lake):
    """Plans whose first stage runs once a row, without AQE, so that the whole plan is there before it runs."""
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    own = TripLake(spark, lake.bronze_path, lake.zones_path)
    yield own
    spark.conf.set("spark.sql.adaptive.enabled", was)


def scan_methods(df):
    """Sizes for the parts that run on the rows of the scan, before any exchange of them."""
    return [size for part, size in method_sizes(df) if "FileScan parquet" in part and not re.search(r"Exchange (hashp|rangep|SingleP)", part)]


def test_f1_curated_row_method_is_compiled(row_plans):
    sizes = scan_methods(row_plans.curated())
    assert sizes and max(sizes) <= COMPILED


def test_f1_speed_limit_without_rounding(spark):
    rnd = random.Random(3)
    near = [v for lim in (80.0, 79.99, 0.0, 0.29, 12.345) for k in (0, 1, 2) for v in (
        round(lim * 100 + k - 0.5) / 100 + 0.005, lim + 0.005, math.nextafter(lim + 0.005, 0), math.nextafter(lim + 0.005, 99), lim)]
    xs = near + [rnd.uniform(-5, 100) for _ in range(3000)] + [float(f"{rnd.randrange(200000)}.5e-2") for _ in range(500)]
    xs += [None, float("nan"), float("inf"), float("-inf"), -0.0, 1e300]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for limit in (80.0, 79.99, 0.0, 0.29, 12.345, 1e10, -1.0):
        wrong = df.where(~rounds_to_at_most("x", limit).eqNullSafe(F.round("x", 2) <= F.lit(limit)))
        assert wrong.count() == 0, (limit, wrong.collect())


@pytest.mark.parametrize("name", ["one pass", "daily", "hourly", "routes"])
def test_f4_f5_rollup_row_method_is_compiled(row_plans, name):
    df = {"one pass": lambda: ru.gold_one_pass(row_plans.curated().select(*md.GOLD_COLUMNS)), "daily": row_plans.daily,
          "hourly": row_plans.hourly, "routes": row_plans.routes}[name]()
    sizes = scan_methods(df)
    assert sizes and max(sizes) <= COMPILED


def test_f4_parts_in_steps_are_those_of_one_expression(spark):
    rnd = random.Random(4)
    xs = [0.0, -0.0, 0.5e-6, -0.5e-6, 1.0000005, 2.0 ** 20, -2.0 ** 20, 2.0 ** 40, -2.0 ** 40 - 0.1, 2.0 ** 92, 2.0 ** 93, -1e300, None,
          float("nan"), float("inf"), float("-inf")] + [rnd.uniform(-1, 1) * 10.0 ** rnd.randrange(-8, 30) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(xs)), "id int, x double")
    for kind, narrow in ((Exact, ()), (Narrow, ("m",))):
        one, m = kind.of("x"), shared_parts(df, ["id", "x"], narrow, m=F.col("x"))
        rows, p = m[0], m[1]["m"]
        pairs = [(one.micro, p.micro), (one.odd, p.odd)] + ([(F.coalesce(one.blocks, F.when(F.col("x").isNotNull(), 0)), p.blocks)] if kind is Exact else [])
        for a, b in pairs:
            assert rows.where(~a.eqNullSafe(b)).count() == 0


def test_f2_months_are_listed_without_the_bronze_table(spark, tmp_path):
    for t in ("lineitem", "nation", "region"):
        spark.read.parquet(f"{SF001}/{t}.parquet").limit(50).write.parquet(f"{tmp_path}/{t}.parquet")
    got = [r.month for r in registry.QUERIES["latest_months"](spark, str(tmp_path)).collect()]
    assert got == sorted(got, reverse=True) and got
    bronze = fixtures.bronze_trips_target(spark, str(tmp_path))
    assert not os.path.exists(bronze)
    assert registry.QUERIES["scan_trips"](spark, str(tmp_path)).count() == 50 and os.path.exists(bronze)


def test_f2_large_input_is_not_shuffled_for_a_core_left_over(spark):
    cores = spark.sparkContext.defaultParallelism
    busy, idle = spark.range(0, 100, 1, cores - 1), spark.range(0, 100, 1, 1)
    assert fixtures._spread(busy).rdd.getNumPartitions() == cores - 1
    assert fixtures._spread(idle).rdd.getNumPartitions() == cores


def test_f3_landing_opens_a_file_a_month_and_sorts_nothing(spark, tmp_path, monkeypatch):
    pick = [dt.datetime(2024, 1 + i % 3, 1 + i % 5, i % 24) for i in range(60)]
    src = f"{tmp_path}/in"
    trips_df(spark, [dict(pickup_datetime=t, trip_time=i) for i, t in enumerate(pick)]).coalesce(1).write.parquet(src)
    seen, publish = [], writers.publish

    def spy(session, path, write, **kw):
        def watched(to):
            save = type(session.range(1).write).parquet
            with monkeypatch.context() as m:
                m.setattr(type(session.range(1).write), "parquet", lambda w, *a, **k: (seen.append(session.conf.get(OPEN)), save(w, *a, **k))[1])
                write(to)
        publish(session, path, watched, **kw)

    monkeypatch.setattr(writers, "publish", spy)
    before = spark.conf.get(OPEN)
    assert ld.land_months(spark, [src], f"{tmp_path}/out") == 60
    assert seen == [str(writers.OPEN_FILES)] and spark.conf.get(OPEN) == before
    landed = ld.read_landed(spark, f"{tmp_path}/out").select("trip_time", "source_month").collect()
    assert sorted((r[0], r[1]) for r in landed) == [(i, t.strftime("%Y-%m")) for i, t in enumerate(pick)]
