import os
import re
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession
    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    wh = str(tmp_path_factory.mktemp("warehouse"))
    s = (SparkSession.builder.master("local[4]").appName("tiertrip-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.checkpoint.dir", ckpt)
         .config("spark.sql.warehouse.dir", wh)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def lake(spark):
    from tiertrip.plans.lake import TripLake
    return TripLake.from_testdata(spark, SF001)


def trips_df(spark, rows):
    """Bronze rows from dicts; missing columns are NULL."""
    from tiertrip import schemas
    names = schemas.RAW_TRIP.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schemas.RAW_TRIP)


def plan_text(df, mode="formatted"):
    """The physical plan as text (the same string ``df.explain(mode)`` prints)."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def method_sizes(df):
    """For each whole-stage part of the plan: (its plan, bytes of its largest generated method)."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.initialPlan()
    debug = getattr(getattr(df.sparkSession._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    text = debug.codegenString(plan)
    return [(part, int(size)) for size, part in
            re.findall(r"== Subtree \d+ / \d+ \(maxMethodCodeSize:(\d+)(.*?)Generated code:", text, re.S)]
