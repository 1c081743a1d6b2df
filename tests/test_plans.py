"""Plan properties that matter at scale (checked on the physical plan, not just results)."""

import re

import pytest

from bazaar.plans.catalog import load_all
from tests.conftest import SF_SMALL

QUERIES = load_all()
# windows without PARTITION BY are allowed only over calendar months / cohorts (bounded by time),
# and global one-row aggregates end in a single partition by definition
BOUNDED = {"v5_revenue_monthly_trend", "v6_cohort_retention", "x16_latest_trend_months", "x13_search_orders_total",
           "g4_global_aggregate", "m2q_review_facets", "q1_constraint_audit", "q5_null_count",
           "x14b_gold_refresh_report"}


def _plan(spark, name):
    return QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def _gathers(plan: str) -> bool:
    """Whether a single-partition exchange carries rows: one that carries a task's partial sums of a global aggregate
    (a row per task) does not."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = next((x for x in lines[i + 1:] if re.search(r"[A-Z]\w+", x) and "InputAdapter" not in x and "WholeStage" not in x), "")
            if not re.search(r"Aggregate\(keys=\[\], functions=\[partial_", below):
                return True
    return False


@pytest.mark.parametrize("name", ["v7_product_sales_ranking", "x11_pareto_abc", "x14_gold_summary_backfill",
                                  "x3_top3_products_per_vendor", "v4_vendor_performance", "d2_weighted_text_search"])
def test_no_single_partition_exchange(spark, name):
    assert not _gathers(_plan(spark, name))


def test_single_partition_only_where_bounded(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        offenders = [n for n in QUERIES if n not in BOUNDED
                     and _gathers(_plan(spark, n))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert offenders == []


def test_scan_pushdown_and_pruning(spark):
    plan = _plan(spark, "p9_half_open_day")
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_no_python_in_relational_queries(spark):
    for name in ["v1_order_detail", "v7_product_sales_ranking", "x9_province_category_vendor_cube", "m1q_review_summary",
                 "d2_weighted_text_search", "r8_restock_changes"]:
        plan = _plan(spark, name)
        assert "EvalPython" not in plan and "MapInPandas" not in plan, name


def test_small_files_of_many_rows_are_no_broadcasts(spark, tmp_path):
    """A table of a million rows in a file of some MB is not planned as a broadcast from its file's size."""
    from bazaar.session import configure
    configure(spark)
    spark.range(1_000_000).selectExpr("id", "id % 3 AS w").coalesce(1).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    plan = t.join(t.selectExpr("id", "w AS v"), "id")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
