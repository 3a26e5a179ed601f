"""Physical plans keep the promises that matter at scale."""

from __spark_entry__ import queries
from shelfwise.plans.catalog import products, table

SF = "/root/testdata/sf0.001"
def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_catalogue_reads_only_what_is_asked(spark):
    plan = plan_of(products(spark, SF).select("product_id", "price"))
    assert "l_shipdate" not in plan and "s_name" not in plan
    plan = plan_of(products(spark, SF).where("category = 'PROMO'").select("product_id", "rating"))
    assert "EqualTo(p_type,PROMO)" in plan


def test_part_columns_need_no_lines(spark):
    plan = plan_of(products(spark, SF).select("product_id", "name", "category", "price"))
    assert "l_partkey" not in plan and "s_suppkey" not in plan
    for name in ("products_by_price", "category_distribution", "filter_price_category"):
        assert "l_partkey" not in plan_of(queries()[name](spark, SF)), name


def test_limits_before_sorting_and_windows(spark):
    assert "TakeOrderedAndProject" in plan_of(queries()["top_k"](spark, SF))
    assert "TakeOrderedAndProject" in plan_of(queries()["fetch_latest"](spark, SF))
    assert "WindowGroupLimit" in plan_of(queries()["top_per_category"](spark, SF))
    assert "WindowGroupLimit" in plan_of(queries()["recent_turns"](spark, SF))


def test_multi_pass_queries_read_the_lines_once(spark):
    # the catalogue was written before, so the plan itself has no line scan left
    for name in ("top_k", "zscore", "price_outliers", "vendor_ranking"):
        assert "l_partkey" not in plan_of(queries()[name](spark, SF))


def test_partial_aggregation_before_the_shuffle(spark):
    plan = plan_of(queries()["dedupe_latest"](spark, SF))
    assert plan.index("Exchange") < plan.rindex("partial_max_by")
    assert "Window" not in plan


def test_snapshot_filter_reaches_the_scan(spark):
    from shelfwise.plans.products import early

    assert "LessThan(l_shipdate" in plan_of(early(spark, SF).select("product_id"))
    assert table(spark, SF, "lineitem").columns
