"""Cross-operator invariants on the driver tables."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise import catalog
from shelfwise.functions.metrics import money
from shelfwise.operators import quality as Q
from shelfwise.operators import reports as rp
from shelfwise.operators import sales
from shelfwise.operators import windows as W
from shelfwise.plans import evidence as P
from shelfwise.sources.driver import load
from shelfwise.sources.model import from_driver

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tm(spark):
    t = load(spark, SF)
    return t, from_driver(t)


def _q(spark, key):
    return catalog.queries()[key](spark, SF)


def test_view_rows_equal_source_rows(tm):
    _, m = tm
    r = sales.reconcile(sales.valid_sales_view(m), sales.source_sales(m)).collect()[0]
    assert r.row_difference == 0 and r.revenue_difference == 0.0 and r.view_rows > 0


def test_running_total_ends_at_group_total(tm):
    _, m = tm
    o = m.orders.select("order_id", "customer_id", "order_date", money("order_total").alias("v"))
    run = W.running(o, "v", ["order_date", "order_id"], by=["customer_id"])
    last = run.withColumn("_rk", F.row_number().over(
        Window.partitionBy("customer_id").orderBy(F.col("order_date").desc(), F.col("order_id").desc())))
    last = last.filter("_rk = 1").select("customer_id", F.col("running_total").alias("last"))
    tot = o.groupBy("customer_id").agg(F.sum("v").alias("tot"))
    assert last.join(tot, "customer_id").filter(F.col("last") != F.col("tot")).count() == 0


def test_dedup_partitions_rows(tm):
    _, m = tm
    p = m.products.select("product_id", "product_name")
    key = F.lower(F.trim("product_name"))
    surv = Q.dedup(p, key, "product_id")
    cand = Q.dedup_candidates(p, key, ["product_id"])
    assert surv.count() == p.select(key).distinct().count()
    assert surv.count() + cand.count() == p.count()
    assert surv.join(cand, "product_id").count() == 0


def test_shares_sum_to_100(spark):
    r = _q(spark, "win_pct_of_total").agg(F.sum("pct_of_total"), F.count(F.lit(1))).collect()[0]
    assert abs(r[0] - 100) <= 0.005 * r[1]  # each share is rounded to 2 dp


def test_monthly_revenue_sums_to_view_total(spark, tm):
    _, m = tm
    r = _q(spark, "rp_monthly_kpis").agg(F.sum("gross_revenue"), F.count(F.lit(1))).collect()[0]
    total = _q(spark, "dq_reconcile").collect()[0].view_gross_revenue
    assert abs(r[0] - total) <= 0.005 * r[1] + 1e-6  # each month is rounded to 2 dp


def test_layout_and_bucketing_keep_rows(spark, tm):
    t, m = tm
    direct = (m.orders.filter((F.col("status") == "F") & (F.col("order_date") >= F.lit("1996-03-01").cast("timestamp_ntz"))
                              & (F.col("order_date") < F.lit("1996-04-01").cast("timestamp_ntz")))
              .select("order_id", "order_date", "customer_id"))
    assert P.same_rows(_q(spark, "pf_layout_for_filter"), direct).collect()[0].same_rows
    plain = (m.items.join(m.orders.filter("status = 'F'").select("order_id"), "order_id").groupBy("order_id")
             .agg(F.round(F.sum("gross_revenue"), 2).cast("double").alias("revenue")))
    assert P.same_rows(_q(spark, "pf_join_layout"), plain).collect()[0].same_rows


def test_unsold_products_are_the_zero_rows_of_coverage(spark):
    unsold = _q(spark, "rp_unsold_products").select("product_id")
    zero = _q(spark, "rp_catalog_coverage").filter("units_sold = 0").select("product_id")
    assert P.same_rows(unsold, zero).collect()[0].same_rows


def test_refund_scope_completed_is_a_subset(tm):
    _, m = tm
    every = rp.refunds(m, "all").count()
    done = rp.refunds(m, "completed").count()
    assert 0 < done < every


def test_top_product_ties_keep_all_winners(tm):
    _, m = tm
    single = rp.top_product_per_store(m, ties=False)
    ties = rp.top_product_per_store(m, ties=True)
    assert single.count() == single.select("store_id").distinct().count()
    assert ties.count() >= single.count()


def test_growth_by_product_and_category(tm):
    _, m = tm
    assert rp.growth_mom(m, "product_id").filter("prior_month_revenue IS NULL").count() == \
        rp.growth_mom(m, "product_id").select("product_id").distinct().count()
    assert rp.growth_mom(m, "category_name").count() > 0
