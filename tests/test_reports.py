"""Quality and validation reports, including empty input."""

import re

from pyspark.sql import functions as F

from tests.conftest import plan_text, trips_df
from tiertrip.operators import quality as q
from tiertrip.operators import reports as rp


def test_quality_summary_properties(lake):
    tagged = lake.tagged()
    qs = rp.quality_summary(tagged).collect()
    assert qs[0].status == "PASSED" and qs[0].rejection_reason == "PASSED_ALL_RULES"
    total = lake.bronze().count()
    assert sum(r.record_count for r in qs) == total
    assert abs(sum(r.pct_of_total for r in qs) - 100.0) < 0.01
    assert [r.record_count for r in qs[1:]] == sorted((r.record_count for r in qs[1:]), reverse=True)


def test_dq_totals_add_up(lake):
    t = rp.dq_totals(lake.tagged()).first()
    assert t.good + t.rejected == t.total
    assert abs(t.pass_rate_pct + t.rejection_rate_pct - 100) < 0.011


def test_empty_input(spark):
    empty = q.tag(trips_df(spark, []))
    t = rp.dq_totals(empty).first()
    assert (t.total, t.good, t.rejected, t.pass_rate_pct, t.rejection_rate_pct) == (0, 0, 0, 100.0, 0.0)
    qs = rp.quality_summary(empty).collect()
    assert len(qs) == 1 and qs[0].record_count == 0 and qs[0].pct_of_total == 100.0
    assert rp.monthly_dq(empty).count() == 0
    f = rp.stage_funnel(trips_df(spark, [])).first()
    assert f.raw_rows == 0 and f.provider_share_pct is None


def test_funnel_matches_separate_counts(lake):
    f = rp.stage_funnel(lake.bronze()).first()
    assert f.raw_rows == lake.bronze().count()
    assert f.provider_rows == lake.provider_trips().count()
    assert f.curated_rows == lake.curated().count()


def test_monthly_dq_null_month_is_a_row(lake):
    m = rp.monthly_dq(lake.tagged())
    assert m.filter(F.col("month").isNull()).count() == 1


def test_one_scan_for_funnel(lake):
    plan = plan_text(rp.stage_funnel(lake.bronze()))
    assert len(re.findall(r"\(\d+\) Scan parquet", plan)) == 1


def test_quality_summary_reuses_the_grouped_shuffle(lake):
    df = rp.quality_summary(lake.tagged())
    df.collect()
    plan = plan_text(df)
    assert "Reused" in plan or len(re.findall(r"\(\d+\) Scan parquet", plan)) == 1
