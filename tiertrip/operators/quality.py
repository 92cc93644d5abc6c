"""Data-quality rules: one ordered rule list drives the tagger, the filter and the counts.

``tag`` gives each row the first rule it fails (NULL = good). ``keep`` is the conjunction of the
negated rules; because every rule whose test can be NULL comes after a rule that catches that NULL,
``tag IS NULL`` holds exactly when ``keep`` is TRUE. ``keep`` is written as plain comparisons so
Catalyst pushes it into the Parquet scan.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiertrip.config import DEFAULT_THRESHOLDS, Thresholds

REASON = "rejection_reason"


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Callable[[Thresholds], Column]


def _c(name: str) -> Column:
    return F.col(name)


# Rule names and their priority order (first failed rule wins).
RULES: tuple[Rule, ...] = (
    Rule("null_pickup_datetime", lambda t: _c("pickup_datetime").isNull()),
    Rule("null_pu_location", lambda t: _c("PULocationID").isNull()),
    Rule("null_do_location", lambda t: _c("DOLocationID").isNull()),
    Rule("invalid_timestamps",
         lambda t: _c("dropoff_datetime").isNull() | (_c("dropoff_datetime") <= _c("pickup_datetime"))),
    Rule("zero_trip_miles", lambda t: _c("trip_miles").isNull() | (_c("trip_miles") <= 0)),
    Rule("excessive_trip_miles", lambda t: _c("trip_miles") >= F.lit(t.max_trip_miles)),
    Rule("null_fare", lambda t: _c("base_passenger_fare").isNull()),
    Rule("zero_or_negative_fare", lambda t: _c("base_passenger_fare") <= 0),
    Rule("excessive_fare", lambda t: _c("base_passenger_fare") >= F.lit(t.max_fare)),
    Rule("zero_trip_time", lambda t: _c("trip_time").isNull() | (_c("trip_time") <= 0)),
    Rule("excessive_trip_time", lambda t: _c("trip_time") >= F.lit(t.max_trip_seconds)),
)

RULE_NAMES = tuple(r.name for r in RULES)


def reason_expr(rules=RULES, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    """``CASE WHEN fails_1 THEN name_1 ... ELSE NULL END`` (first match wins)."""
    out = None
    for r in rules:
        cond, name = r.fails(thresholds), F.lit(r.name)
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise(F.lit(None).cast("string"))


def keep_expr(rules=RULES, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    """Conjunction of negated rules; NULL comparisons drop the row, as a filter does."""
    return functools.reduce(lambda a, b: a & b, [~r.fails(thresholds) for r in rules])


def tag(df: DataFrame, rules=RULES, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    return df.withColumn(REASON, reason_expr(rules, thresholds))


def keep(df: DataFrame, rules=RULES, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    return df.filter(keep_expr(rules, thresholds))


def good(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNotNull())


def split(df: DataFrame, rules=RULES, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> tuple[DataFrame, DataFrame]:
    t = tag(df, rules, thresholds)
    return good(t), rejected(t)


def rule_counts(df: DataFrame, rules=RULES, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Rows failing each rule on its own (not first-match), in one pass: ``rule, rule_order, failed_rows``.

    A rule whose test is NULL for a row (e.g. ``trip_miles >= 200`` on NULL miles) does not count."""
    one = df.agg(*[F.count_if(r.fails(thresholds)).alias(f"r{i}") for i, r in enumerate(rules)])
    pairs = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(i + 1).alias("rule_order"), F.col(f"r{i}").alias("failed_rows"))
        for i, r in enumerate(rules)
    ])
    return one.select(F.inline(pairs))


def provider_filter(df: DataFrame, provider: str) -> DataFrame:
    return df.filter(F.col("hvfhs_license_num") == F.lit(provider))
