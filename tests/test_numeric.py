"""Exact aggregation helpers against Python's exact arithmetic, and the whole-seconds rounding
against Spark's own ``round``."""

import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from tiertrip.functions import trip as tf
from tiertrip.functions.numeric import round_avg, round_sum


def _micro(x):
    """Millionths of the binary value, half up."""
    m = math.floor(abs(Fraction(x)) * 10 ** 6 + Fraction(1, 2))
    return -m if x < 0 else m


def _half_up(fr, scale=2):
    q = math.floor(abs(fr) * 10 ** scale + Fraction(1, 2))
    return float(Fraction(-q if fr < 0 else q, 10 ** scale))


def _want(xs):
    """(average, sum) of the values, as exact fractions; NaN and infinities as doubles add them."""
    xs = [x for x in xs if x is not None]
    odd = [x for x in xs if not math.isfinite(x)]
    if odd:
        return sum(odd), sum(odd)
    us = [_micro(x) for x in xs]
    return (_half_up(Fraction(sum(us), len(us) * 10 ** 6)), _half_up(Fraction(sum(us), 10 ** 6))) if us else (None, None)


INF, NAN = float("inf"), float("nan")


def test_round_avg_and_sum_are_exact(spark):
    rnd = random.Random(11)
    makers = [
        lambda: round(rnd.uniform(-100, 500), 2),          # money
        lambda: rnd.randint(0, 500000) / 512,              # long binary fractions
        lambda: rnd.uniform(-1e9, 1e9),                    # large magnitudes
        lambda: rnd.choice([None, 0.005, 0.015, -0.005, 2.675, 5e11, 2e12, -1e12, 1e15, 3.5e17, 1e12 + 0.25, 1e20, -(2.0 ** 90)]),
        lambda: rnd.randint(-10 ** 6, 10 ** 6) / 1000 + 0.0005,  # ties at the 4th decimal
        lambda: rnd.choice([None, 1.0, NAN, INF, -INF, 1e13]),
    ]
    rows = [(g, makers[g % 6]()) for g in range(120) for _ in range(rnd.choice([1, 2, 3, 9, 60]))]
    got = {r.g: (r.a, r.s) for r in spark.createDataFrame(rows, "g int, x double").repartition(7)
           .groupBy("g").agg(round_avg("x").alias("a"), round_sum("x").alias("s")).collect()}
    groups = {}
    for g, x in rows:
        groups.setdefault(g, []).append(x)
    for g, xs in groups.items():
        assert repr(got[g]) == repr(_want(xs)), (g, xs)


def test_no_value_is_dropped(spark):
    cases = [[1e12, 1.0], [2e12, 5.0], [1e15, 0.25, None], [-1e12, 1e12, 0.5], [NAN, 1.0], [INF, 1.0], [INF, -INF, 1.0],
             [None], [999999999999.99, 1e12], [2.0 ** 40, -(2.0 ** 40)], [2.0 ** 40 - 0.5, 3.0]]
    rows = [(i, x) for i, xs in enumerate(cases) for x in xs]
    for r in spark.createDataFrame(rows, "g int, x double").groupBy("g").agg(
            round_avg("x").alias("a"), round_sum("x").alias("s")).collect():
        assert repr((r.a, r.s)) == repr(_want(cases[r.g])), cases[r.g]


def test_narrow_parts_equal_exact_ones(spark):
    from tiertrip.functions.numeric import shared_parts
    rnd = random.Random(3)
    makers = [lambda: round(rnd.uniform(-100, 500), 2), lambda: rnd.randint(0, 500000) / 512, lambda: rnd.choice([None, 0.005, -0.005, 2.675]),
              lambda: rnd.randint(-10 ** 6, 10 ** 6) / 1000 + 0.0005, lambda: None, lambda: rnd.choice([1.0, NAN, INF])]
    rows = [(g, makers[g % 6]()) for g in range(60) for _ in range(rnd.choice([1, 2, 9, 60]))]
    df = spark.createDataFrame(rows, "g int, x double").repartition(5)
    both = []
    for narrow in ((), ("x",)):
        parts, m = shared_parts(df, ["g"], narrow, x=F.col("x"))
        both.append(sorted(repr(tuple(r)) for r in parts.groupBy("g").agg(m["x"].avg(), m["x"].sum()).collect()))
    assert both[0] == both[1]
    wide = [1e9, 2.0 ** 20, -3e30, 0.25, None]
    parts, m = shared_parts(spark.createDataFrame([(x,) for x in wide], "x double"), [], ("x",), x=F.col("x"))
    r = parts.agg(m["x"].avg().alias("a"), m["x"].sum().alias("s")).first()
    assert math.isclose(r.s, sum(wide[:4]), rel_tol=1e-12) and math.isclose(r.a, sum(wide[:4]) / 4, rel_tol=1e-12)


def test_huge_values_do_not_end_the_query(spark):
    """Past the exact range the result is that of a double sum; the rest of the row's group still counts."""
    from tiertrip.functions.numeric import round_avg_sql, round_sum_sql
    cases = [[1e33, 1.0], [1e33, -1e33, 2.5], [1e300, 1e300], [1.7e308, 1.7e308], [-1e40, 3.0, None], [2.0 ** 93, 1.0],
             [2.0 ** 102] * 40, [2.0 ** 93 - 2.0 ** 41, 5.0]]
    df = spark.createDataFrame([(i, x) for i, xs in enumerate(cases) for x in xs], "g int, x double")
    df.createOrReplaceTempView("huge_case")
    by_col = df.groupBy("g").agg(round_avg("x").alias("a"), round_sum("x").alias("s")).collect()
    for r in by_col:
        xs = [x for x in cases[r.g] if x is not None]
        assert math.isclose(r.s, sum(xs), rel_tol=1e-12) and math.isclose(r.a, sum(xs) / len(xs), rel_tol=1e-12, abs_tol=0.005), cases[r.g]
    by_sql = spark.sql(f"SELECT g, {round_avg_sql('x')} AS a, {round_sum_sql('x')} AS s FROM huge_case GROUP BY g").collect()
    assert sorted(map(repr, map(tuple, by_col))) == sorted(map(repr, map(tuple, by_sql)))


def test_exact_sum_over_many_rows(spark):
    df = spark.range(0, 3_000_000, numPartitions=4).select(F.lit(499.99).alias("x"))
    r = df.agg(round_avg("x").alias("a"), round_sum("x").alias("s")).first()
    assert (r.a, r.s) == (499.99, 1_499_970_000.0)


def test_whole_seconds_match_spark_round(spark):
    df = spark.range(-100_000, 400_000).select(F.col("id").alias("s"))
    same = tf.whole_seconds_to_minutes(F.col("s")).eqNullSafe(F.round(F.col("s") / F.lit(60.0), 2))
    assert df.filter(~same).count() == 0
    edge = spark.createDataFrame([(v,) for v in (None, 0, 30, 90, 14399, 10 ** 12 + 3, -90)], "s bigint")
    assert edge.filter(~tf.whole_seconds_to_minutes(F.col("s")).eqNullSafe(
        F.round(F.col("s") / F.lit(60.0), 2))).count() == 0


def test_sql_text_equals_column_helpers(spark):
    from tiertrip.functions.numeric import round_avg_sql, round_sum_sql
    rnd = random.Random(5)
    rows = [(g, rnd.choice([None, NAN if g % 5 == 0 else 7e15, round(rnd.uniform(-50, 500), 2), rnd.randint(0, 9999) / 512, 3e12]))
            for g in range(40) for _ in range(rnd.randint(1, 30))]
    df = spark.createDataFrame(rows, "g int, x double")
    df.createOrReplaceTempView("numeric_case")
    by_col = df.groupBy("g").agg(round_avg("x").alias("a"), round_sum("x").alias("s"))
    by_sql = spark.sql(f"SELECT g, {round_avg_sql('x')} AS a, {round_sum_sql('x')} AS s FROM numeric_case GROUP BY g")
    assert sorted(map(repr, map(tuple, by_col.collect()))) == sorted(map(repr, map(tuple, by_sql.collect())))


def test_fast_round_equals_spark_round(spark):
    from tiertrip.functions.numeric import round_value_fast
    r = F.rand(9)
    df = spark.range(0, 300_000).select(F.when(F.col("id") % 3 == 0, (r - 0.5) * 400)
                                        .when(F.col("id") % 3 == 1, F.floor((r - 0.5) * 2e6) / 1000)
                                        .otherwise(F.pow(F.lit(10.0), r * 24 - 12)).alias("x"))
    assert df.filter(~round_value_fast("x").eqNullSafe(F.round("x", 2))).count() == 0
    edge = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, -0.001, -0.005, 0.005, 1.005, 2.675,
            0.285, -2.675, 1e10 + 0.125, 80.005, 79.995]
    rows = spark.createDataFrame([(v,) for v in edge], "x double").select(
        round_value_fast("x").alias("f"), F.round("x", 2).alias("s")).collect()
    assert [repr(x.f) for x in rows] == [repr(x.s) for x in rows]
