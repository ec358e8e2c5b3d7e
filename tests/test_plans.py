"""Physical plan checks: push-down, pruning, no-exchange layouts, partial top-N."""

import pytest

from shelfwise import catalog
from shelfwise.plans import evidence as P

SF = "/root/testdata/sf0.001"


def _q(spark, key):
    return catalog.queries()[key](spark, SF)


def test_half_open_range_is_pushed_to_the_scan(spark):
    pushed = " ".join(P.pushed_filters(_q(spark, "filter_half_open")))
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed


def test_sargable_rewrite_pushes_both_bounds(spark):
    pushed = " ".join(P.pushed_filters(_q(spark, "pf_sargable_rewrite")))
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed


def test_column_pruning_reads_only_used_columns(spark):
    cols = P.scanned_columns(_q(spark, "pf_column_pruning"))
    assert cols == [["o_orderkey", "o_orderstatus", "o_orderpriority"]]


def test_bucketed_join_has_no_exchange(spark):
    # With broadcast off (as for two large tables) the bucketed sides join
    # by sort-merge and neither side nor the aggregate shuffles.
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = _q(spark, "pf_join_layout")
        text = P.plan_text(df)
        assert "SortMergeJoin" in text
        assert P.exchanges(df) == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_top_n_inserts_partial_window_group_limit(spark):
    assert "WindowGroupLimit" in P.plan_text(_q(spark, "win_top_n"))


def test_monthly_kpis_prune_lineitem_columns(spark):
    cols = P.scanned_columns(_q(spark, "rp_monthly_kpis"))
    li = [c for c in cols if "l_orderkey" in c][0]
    assert sorted(li) == sorted(["l_orderkey", "l_quantity", "l_extendedprice", "l_discount"])


def test_plan_facts_frame(spark):
    facts = P.plan_facts(_q(spark, "rp_monthly_kpis"))
    assert facts.filter("fact = 'ReadSchema'").count() >= 2


def test_valid_item_bounds_are_pushed(spark):
    pushed = " ".join(P.pushed_filters(_q(spark, "rp_monthly_kpis")))
    assert "GreaterThan(l_quantity,0.0)" in pushed and "GreaterThanOrEqual(l_extendedprice,0.0)" in pushed


@pytest.mark.parametrize("key,most", [("rp_above_benchmark_products", 2), ("pf_same_result", 2), ("rp_inventory_risk", 2), ("rp_volume_vs_revenue", 1)])
def test_fact_is_scanned_so_often_at_most(spark, key, most):
    cols = P.scanned_columns(_q(spark, key))
    assert sum(any(c.startswith("l_") for c in names) for names in cols) <= most


def test_each_bucket_is_one_file(spark, tmp_path):
    import glob
    P.write_bucketed(spark.range(1000).repartition(5), "shelfwise_bucket_test", str(tmp_path / "b"), 4, "id")
    assert len(glob.glob(str(tmp_path / "b" / "*.parquet"))) == 4
    P.drop_bucketed(spark, "shelfwise_bucket_test")
    assert not (tmp_path / "b").exists() and not spark.catalog.tableExists("shelfwise_bucket_test")


def test_same_result_check(spark):
    r = _q(spark, "pf_same_result").collect()[0]
    assert r.same_rows and r.only_in_a == 0 and r.only_in_b == 0


# Nested-loop joins are allowed only where one side is bounded by construction:
# a one-row aggregate (benchmark, boundary, total, NULL guard) or a literal relation.
BOUNDED_NESTED_LOOPS = {
    "anti_recency_range", "dq_reconcile", "join_cross_benchmark", "not_in_null_trap", "rp_inventory_risk", "rp_inventory_priority",
    "rp_above_benchmark_products", "rp_days_above_average", "rp_inactive_customers", "sub_scalar_filter",
    "sub_scalar_select", "win_pct_of_total", "win_total",
}


def test_no_cartesian_products_and_only_bounded_nested_loops(spark):
    offenders = []
    for key, build in sorted(catalog.queries().items()):
        tree = P.plan_text(build(spark, SF)).split("\n\n")[0]
        if "CartesianProduct" in tree:
            offenders.append((key, "CartesianProduct"))
        if "BroadcastNestedLoopJoin" in tree and key not in BOUNDED_NESTED_LOOPS:
            offenders.append((key, "BroadcastNestedLoopJoin"))
    assert offenders == []
