"""Reporting jobs RP-01..RP-38 built from the primitives.

Every report takes a :class:`~shelfwise.sources.model.Model` and returns a
lazy DataFrame.  The recurring physical shape is: filter the fact and
orders at the scan, join them on ``order_id`` once, aggregate at the
fact's own keys (partial aggregation before the shuffle), and only then
attach dimension labels to the much smaller aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from shelfwise.functions.exprs import band as _band
from shelfwise.functions.exprs import in_period
from shelfwise.functions.metrics import (above_mean, diff_from_mean_half_up, mean_half_up, month_label,
                                        ratio_half_up, round_money, safe_ratio, weekday_name)
from shelfwise.operators import joins as J
from shelfwise.operators import windows as W
from shelfwise.operators.sales import completed_orders, order_totals, sales_lines, valid_items
from shelfwise.sources.model import Model


def monthly_kpis(m: Model) -> DataFrame:
    """RP-02: month -> completed orders, units, revenue, revenue per order.

    Lines are first reduced to one row per order (a partial aggregate that
    shuffles on ``order_id``); the join with orders then reuses that
    partitioning, and COUNT(DISTINCT order_id) becomes a plain count
    because each order appears once.
    """
    per_order = (valid_items(m).groupBy("order_id")
                 .agg(F.sum("quantity").alias("units"), F.sum("gross_revenue").alias("revenue")))
    per_order = per_order.join(completed_orders(m).select("order_id", "sales_month"), "order_id")
    return (per_order.groupBy("sales_month")
            .agg(F.count(F.lit(1)).alias("completed_orders"), F.sum("units").cast("bigint").alias("units_sold"),
                 F.sum("revenue").alias("_rev"))
            .select("sales_month", "completed_orders", "units_sold",
                    round_money("_rev").alias("gross_revenue"),
                    ratio_half_up("_rev", "completed_orders", 2).alias("revenue_per_order")))


# ---------------------------------------------------------------- shared aggregates


_R2 = DecimalType(38, 2)


def _r2(c):
    """ROUND(x, 2) kept exact (DECIMAL) for later arithmetic."""
    return F.round(F.col(c) if isinstance(c, str) else c, 2).cast(_R2)


def product_totals(m: Model, lines: DataFrame | None = None) -> DataFrame:
    """Per product: valid completed item rows, units and exact revenue."""
    lines = lines if lines is not None else sales_lines(m)
    return lines.groupBy("product_id").agg(F.count(F.lit(1)).alias("sold_item_rows"),
                                           F.sum("quantity").cast("bigint").alias("units_sold"),
                                           F.sum("gross_revenue").alias("revenue"))


def store_month_totals(m: Model) -> DataFrame:
    """Per store and month: distinct orders, units, exact revenue (store decides region)."""
    return order_totals(m, ["store_id", "sales_month"])


# ---------------------------------------------------------------- RP-03..RP-08


def store_month(m: Model) -> DataFrame:
    """RP-03: store x month orders, units, revenue (labels attached after the aggregate)."""
    sm = store_month_totals(m).join(m.stores.select("store_id", "store_name"), "store_id")
    return sm.select("store_name", "sales_month", "completed_orders", "units",
                     round_money("revenue").alias("gross_revenue"))


def region_store_channel(m: Model) -> DataFrame:
    """RP-04: month x region x store x channel (grouped at store_id, store decides region)."""
    g = order_totals(m, ["sales_month", "store_id", "channel"])
    g = g.join(m.stores.select("store_id", "store_name", "region_name"), "store_id")
    return g.select("sales_month", "region_name", "store_name", "channel", "completed_orders", F.col("units").alias("units_sold"),
                    round_money("revenue").alias("gross_revenue"))


def region_store(m: Model) -> DataFrame:
    """RP-05: region x store, distinct orders recomputed from detail (AG-16)."""
    g = order_totals(m, ["store_id"])
    g = g.join(m.stores.select("store_id", "store_name", "region_name"), "store_id")
    return g.select("region_name", "store_name", "completed_orders", round_money("revenue").alias("gross_revenue"))


def department_category(m: Model) -> DataFrame:
    """RP-06: department x category units and revenue (products aggregated first)."""
    p = product_totals(m).join(m.products.select("product_id", "department", "category_name"), "product_id")
    g = p.groupBy("department", "category_name").agg(F.sum("units_sold").cast("bigint").alias("units_sold"),
                                                     F.sum("revenue").alias("_r"))
    return g.select("department", "category_name", "units_sold", round_money("_r").alias("gross_revenue"))


def top_products(m: Model, n: int = 10) -> DataFrame:
    """RP-07: the n products with the most revenue (product_id breaks ties, T14)."""
    p = product_totals(m)
    top = W.top_k(p, [F.col("revenue").desc(), F.col("product_id")], n)
    top = top.join(m.products.select("product_id", "product_name", "category_name"), "product_id")
    return top.select("product_id", "product_name", "category_name", "units_sold",
                      round_money("revenue").alias("gross_revenue"))


def product_threshold(m: Model, min_units: int = 300) -> DataFrame:
    """RP-08: products with at least ``min_units`` units (HAVING)."""
    p = product_totals(m).filter(F.col("units_sold") >= min_units)
    p = p.join(m.products.select("product_id", "product_name"), "product_id")
    return p.select("product_id", "product_name", "units_sold", round_money("revenue").alias("gross_revenue"))


# ---------------------------------------------------------------- RP-09..RP-16


def product_month(m: Model) -> DataFrame:
    return sales_lines(m).groupBy("product_id", "sales_month").agg(F.sum("gross_revenue").alias("revenue"))


def product_vs_own_avg(m: Model) -> DataFrame:
    """RP-09: product-month revenue vs the product's own monthly average.

    As the reference: month revenue rounded first, the average of the
    rounded values rounded again, the difference from the rounded average.
    """
    pm = product_month(m).withColumn("revenue", _r2("revenue"))
    # A product has at most one row per calendar month, so a window over the
    # product is bounded by the calendar and avoids aggregating pm twice.
    per_product = Window.partitionBy("product_id")
    avg = mean_half_up(F.sum("revenue").over(per_product), F.count("revenue").over(per_product), 2)
    pa = pm.withColumn("avg_monthly_revenue", avg.cast(_R2))
    out = pa.join(m.products.select("product_id", "product_name"), "product_id")
    return out.select("product_id", "product_name", "sales_month", F.col("revenue").cast("double").alias("revenue"),
                      F.col("avg_monthly_revenue").cast("double").alias("avg_monthly_revenue"),
                      (F.col("revenue") - F.col("avg_monthly_revenue")).cast("double").alias("difference_from_average"))


def product_above_avg_months(m: Model) -> DataFrame:
    """RP-10: only the months in which a product beat its own (unrounded) monthly average."""
    per_product = Window.partitionBy("product_id")  # bounded: one row per calendar month
    pm = product_month(m).withColumns({"_s": F.sum("revenue").over(per_product),
                                       "_n": F.count(F.lit(1)).over(per_product)})
    out = pm.filter(above_mean("revenue", "_s", "_n"))
    out = out.join(m.products.select("product_id", "product_name"), "product_id")
    return out.select("product_id", "product_name", "sales_month", round_money("revenue").alias("revenue"))


def department_top(m: Model, n: int = 3) -> DataFrame:
    """RP-11: products with DENSE_RANK <= n of rounded revenue inside their department."""
    p = product_totals(m).withColumn("revenue", _r2("revenue"))
    p = p.join(m.products.select("product_id", "product_name", "department", "category_name"), "product_id")
    top = W.top_n(p, ["department"], [F.col("revenue").desc()], n, ties=True, out="department_revenue_rank")
    return top.select("department", "category_name", "product_id", "product_name",
                      F.col("revenue").cast("double").alias("revenue"), "department_revenue_rank")


def category_leaders(m: Model) -> DataFrame:
    """RP-12: the revenue leader(s) of each category (DENSE_RANK = 1, ties kept)."""
    p = product_totals(m).join(m.products.select("product_id", "product_name", "category_name"), "product_id")
    top = W.top_n(p, ["category_name"], [F.col("revenue").desc()], 1, ties=True, out="revenue_rank")
    return top.select("category_name", "product_id", "product_name", round_money("revenue").alias("revenue"),
                      "revenue_rank")


def _mom(df: DataFrame, key: str, order: str = "sales_month") -> DataFrame:
    d = W.pct_change(df, "revenue", [order], by=[key], prior="prior_month_revenue", bounded=True)
    return d.withColumn("pct_change", F.col("pct_change").cast("double"))


def store_mom(m: Model) -> DataFrame:
    """RP-13: store-month revenue (rounded), the prior row's revenue and % change."""
    sm = store_month_totals(m).select("store_id", "sales_month", _r2("revenue").alias("revenue"))
    d = _mom(sm, "store_id").join(m.stores.select("store_id", "store_name"), "store_id")
    return d.select("store_name", "sales_month", F.col("revenue").cast("double").alias("revenue"),
                    F.col("prior_month_revenue").cast("double").alias("prior_month_revenue"), "pct_change")


def growth_mom(m: Model, entity: str = "category_name") -> DataFrame:
    """RP-14: month-over-month % change per product or category (``entity``)."""
    g = product_month(m)  # lines are summed before any label is attached
    if entity != "product_id":
        g = g.join(m.products.select("product_id", entity), "product_id")
    g = g.groupBy(entity, "sales_month").agg(_r2(F.sum("revenue")).alias("revenue"))
    d = _mom(g, entity)
    return d.select(entity, "sales_month", F.col("revenue").cast("double").alias("revenue"),
                    F.col("prior_month_revenue").cast("double").alias("prior_month_revenue"), "pct_change")


def store_vs_region(m: Model) -> DataFrame:
    """RP-15: store-month revenue vs the average of the region's stores that month."""
    sm = store_month_totals(m).select("store_id", "sales_month", _r2("revenue").alias("revenue"))
    sm = sm.join(m.stores.select("store_id", "store_name", "region_name"), "store_id")
    d = W.vs_peers(sm, "revenue", ["region_name", "sales_month"], "region_store_average",
                   "difference_from_region_average")
    return d.select("region_name", "store_name", "sales_month", F.col("revenue").cast("double").alias("revenue"),
                    "region_store_average", "difference_from_region_average")


def store_vs_company(m: Model) -> DataFrame:
    """RP-16: store-month revenue vs the company's average store that month."""
    sm = store_month_totals(m).select("store_id", "sales_month", "revenue")
    d = W.vs_peers(sm, "revenue", ["sales_month"], "company_store_average", "difference_from_average")
    d = d.join(m.stores.select("store_id", "store_name"), "store_id")
    return d.select("store_name", F.col("sales_month").alias("order_month"), round_money("revenue").alias("revenue"),
                    "company_store_average", "difference_from_average")


# ---------------------------------------------------------------- RP-17..RP-22


def refunds(m: Model, refund_scope: str = "all") -> DataFrame:
    """Returns with their refund month; ``refund_scope='completed'`` keeps refunds of completed orders only."""
    r = m.returns
    if refund_scope == "completed":
        r = r.join(m.orders.filter(F.col("status") == m.completed).select("order_id"), "order_id", "left_semi")
    return r.withColumn("refund_month", month_label("return_date"))


def net_revenue(m: Model, refund_scope: str = "all") -> DataFrame:
    """RP-17: gross by sales month, refunds booked in the return month, net.

    Months come from the sales side (LEFT JOIN), as the reference does; a
    refund in a month without sales is therefore not shown here but by
    :func:`unmatched_refunds`.
    """
    gross = (sales_lines(m).groupBy("sales_month").agg(_r2(F.sum("gross_revenue")).alias("gross_revenue")))
    ref = (refunds(m, refund_scope).groupBy("refund_month").agg(_r2(F.sum("refund_amount")).alias("refund_amount")))
    out = gross.join(ref, gross.sales_month == ref.refund_month, "left")
    refund = F.coalesce(F.col("refund_amount"), F.lit(0).cast(_R2))
    return out.select("sales_month", F.col("gross_revenue").cast("double").alias("gross_revenue"),
                      refund.cast("double").alias("refund_amount"),
                      (F.col("gross_revenue") - refund).cast("double").alias("net_revenue"))


def unmatched_refunds(m: Model, refund_scope: str = "all") -> DataFrame:
    """Refund months that no sales month matches: what RP-17's months leave out, so that its refunds reconcile."""
    ref = refunds(m, refund_scope).groupBy("refund_month").agg(F.count(F.lit(1)).alias("refund_rows"), F.sum("refund_amount").alias("_f"))
    months = sales_lines(m).select(F.col("sales_month").alias("refund_month")).distinct()
    return ref.join(months, "refund_month", "left_anti").select("refund_month", "refund_rows", round_money("_f").alias("refund_amount"))


def return_rate(m: Model) -> DataFrame:
    """RP-18: per product - units, revenue, returned rows, refunds and return-row rate %."""
    sold = product_totals(m)
    ret = m.returns.groupBy("product_id").agg(F.count(F.lit(1)).alias("returned_item_rows"),
                                              F.sum("refund_amount").alias("_refund"))
    out = sold.join(ret, "product_id", "left").join(m.products.select("product_id", "product_name"), "product_id")
    returned = F.coalesce(F.col("returned_item_rows"), F.lit(0))
    return out.select("product_id", "product_name", "units_sold", round_money("revenue").alias("gross_revenue"),
                      returned.alias("returned_item_rows"),
                      round_money(F.coalesce(F.col("_refund"), F.lit(0))).alias("refund_amount"),
                      safe_ratio(returned, "sold_item_rows", 2, scale=100).alias("return_row_rate_pct"))


def inventory_snapshots(m: Model) -> DataFrame:
    """Monthly stock snapshots derived from the shipments (no inventory table in the driver data).

    One row per (store, product, month shipped): ``on_hand_quantity`` is the
    quantity shipped that month, ``reorder_point`` is 20 + 10 x (product_id
    mod 5).  Both are deterministic functions of the tables.
    """
    return _snapshots(m.items)


def latest_inventory(m: Model) -> DataFrame:
    """The snapshots of the latest month only: the lines are cut to that month before they are grouped."""
    latest = m.items.agg(F.trunc(F.max(F.to_date("ship_date")), "MM").alias("_month"))
    lines = m.items.crossJoin(F.broadcast(latest)).filter(F.to_date("ship_date") >= F.col("_month"))
    return _snapshots(lines)


def _snapshots(items: DataFrame) -> DataFrame:
    it = items.select("store_id", "product_id", F.trunc(F.to_date("ship_date"), "MM").alias("snapshot_date"), "quantity")
    g = it.groupBy("store_id", "product_id", "snapshot_date").agg(F.sum("quantity").cast("int").alias("on_hand_quantity"))
    return g.withColumn("reorder_point", (F.lit(20) + (F.col("product_id") % 5) * 10).cast("int"))


def inventory_risk(m: Model, snapshots: DataFrame | None = None) -> DataFrame:
    """RP-19: store x product below its reorder point in the single latest snapshot."""
    latest = J.latest(snapshots, "snapshot_date") if snapshots is not None else latest_inventory(m)
    latest = latest.filter(F.col("on_hand_quantity") < F.col("reorder_point"))
    out = (latest.join(m.stores.select("store_id", "store_name"), "store_id")
           .join(m.products.select("product_id", "product_name"), "product_id"))
    return out.select("store_id", "store_name", "product_id", "product_name", "snapshot_date", "on_hand_quantity",
                      "reorder_point", (F.col("on_hand_quantity") - F.col("reorder_point")).alias("quantity_gap"))


def inventory_priority(m: Model, snapshots: DataFrame | None = None) -> DataFrame:
    """RP-20: inventory risk rows with the product's revenue rank (1 = best seller)."""
    risk = inventory_risk(m, snapshots)
    ranked = W.dist_ranks(product_totals(m).select("product_id", "revenue"), "revenue",
                          rank_out="product_revenue_rank", dense_out="_dense")
    out = risk.join(ranked.select("product_id", "product_revenue_rank"), "product_id", "left")
    return out.select("store_name", "product_id", "product_name", "quantity_gap", "product_revenue_rank")


def inactive_customers(m: Model, days: int = 45) -> DataFrame:
    """RP-21: customers with no completed order in (latest - days, latest].

    ``latest`` is the latest order date over all orders, any status (B8); it is
    a one-row aggregate broadcast to the orders (mixed equi/range NOT EXISTS).
    """
    o = m.orders.select("customer_id", "status", F.to_date("order_date").alias("d"))
    boundary = o.agg(F.max("d").alias("latest"))
    recent = (o.filter(F.col("status") == m.completed).crossJoin(F.broadcast(boundary))
              .filter((F.col("d") > F.date_sub("latest", days)) & (F.col("d") <= F.col("latest")))
              .select("customer_id"))
    return J.anti(m.customers.select("customer_id", "customer_name", "segment"), recent, "customer_id")


def never_completed(m: Model) -> DataFrame:
    """RP-22: customers without any completed order (NOT EXISTS)."""
    done = m.orders.filter(F.col("status") == m.completed).select("customer_id")
    return J.anti(m.customers.select("customer_id", "customer_name"), done, "customer_id")


# ---------------------------------------------------------------- RP-23..RP-29


def order_population(m: Model) -> DataFrame:
    """RP-23: order counts by status and by channel, stacked: grouping sets over one scan of the orders."""
    g = m.orders.groupingSets([["status"], ["channel"]], "status", "channel").agg(
        F.count(F.lit(1)).alias("order_count"), (F.grouping("status") == 0).alias("_by_status"))
    return g.select(F.when(F.col("_by_status"), "status").otherwise("channel").alias("dimension"),
                    F.when(F.col("_by_status"), F.col("status")).otherwise(F.col("channel")).alias("value"), "order_count")


def _period_orders(m: Model, start: str, end: str) -> DataFrame:
    return m.orders.filter((F.col("status") == m.completed) & in_period("order_date", start, end)).select("order_id")


def unsold_products(m: Model, start: str, end: str) -> DataFrame:
    """RP-24: products without a valid line on a completed order in [start, end).

    The reference's two LEFT JOINs with predicates in ON and HAVING
    COUNT(order) = 0, as an anti join; ``valid_completed_item_rows`` is the
    reference's COUNT(item) (valid item rows of any order).
    """
    valid = valid_items(m).select("order_id", "product_id")
    per_product = valid.groupBy("product_id").agg(F.count(F.lit(1)).alias("valid_completed_item_rows"))
    sold = valid.join(_period_orders(m, start, end), "order_id").select("product_id")
    unsold = J.anti(m.products.select("product_id", "product_name"), sold, "product_id")
    return (unsold.join(per_product, "product_id", "left")
            .select("product_id", "product_name",
                    F.coalesce("valid_completed_item_rows", F.lit(0)).alias("valid_completed_item_rows")))


def catalog_coverage(m: Model, start: str, end: str) -> DataFrame:
    """RP-25: every product with units and revenue in [start, end), zero when unsold."""
    lines = valid_items(m).join(_period_orders(m, start, end), "order_id")
    p = lines.groupBy("product_id").agg(F.sum("quantity").alias("_u"), F.sum("gross_revenue").alias("_r"))
    out = J.coverage(m.products.select("product_id", "product_name"), "product_id", p, {})
    return out.select("product_id", "product_name", F.coalesce("_u", F.lit(0)).cast("bigint").alias("units_sold"),
                      round_money(F.coalesce(F.col("_r"), F.lit(0))).alias("gross_revenue"))


def above_benchmark_products(m: Model) -> DataFrame:
    """RP-26: products whose revenue beats the average product revenue, and by how much."""
    p = product_totals(m).select("product_id", "revenue")
    bench = p.agg(F.sum("revenue").alias("_s"), F.count("revenue").alias("_n"))
    out = J.attach_scalar(p, bench, "average product revenue").filter(above_mean("revenue", "_s", "_n"))
    out = out.join(m.products.select("product_id", "product_name"), "product_id")
    return out.select("product_id", "product_name", round_money("revenue").alias("revenue"),
                      mean_half_up("_s", "_n").alias("avg_product_revenue"),
                      diff_from_mean_half_up("revenue", "_s", "_n").alias("above_by"))


def daily_sales(m: Model) -> DataFrame:
    return sales_lines(m).groupBy("order_date").agg(F.sum("gross_revenue").alias("revenue"))


def days_above_average(m: Model) -> DataFrame:
    """RP-27: days whose revenue beats the average daily revenue."""
    d = daily_sales(m)
    bench = d.agg(F.sum("revenue").alias("_s"), F.count("revenue").alias("_n"))
    out = J.attach_scalar(d, bench, "average day").filter(above_mean("revenue", "_s", "_n"))
    return out.select("order_date", round_money("revenue").alias("revenue"),
                      mean_half_up("_s", "_n").alias("avg_daily_revenue"),
                      diff_from_mean_half_up("revenue", "_s", "_n").alias("above_by"))


def product_category_share(m: Model) -> DataFrame:
    """RP-28: a product's share (%) of its category's revenue (category total by aggregate + join)."""
    p = product_totals(m).join(m.products.select("product_id", "category_name"), "product_id")
    p = W.with_group_total(p, "revenue", ["category_name"], "category_revenue")
    return p.select("product_id", "category_name", round_money("revenue").alias("revenue"),
                    round_money("category_revenue").alias("category_revenue"),
                    safe_ratio("revenue", "category_revenue", 2, scale=100).alias("pct_of_category"))


def daily_performance(m: Model) -> DataFrame:
    """RP-29: per day - revenue, running revenue, previous day, change, revenue rank."""
    d = daily_sales(m)  # one row per calendar day: a bounded series
    d = W.running(d, "revenue", ["order_date"], frame="rows", out="running_revenue", bounded=True)
    d = W.lagged(d, "revenue", ["order_date"], out="previous_day_revenue", bounded=True)
    d = W.dist_ranks(d, "revenue", rank_out="revenue_rank", dense_out="_dense", bounded=True)
    return d.select("order_date", round_money("revenue").alias("revenue"),
                    round_money("running_revenue").alias("running_revenue"),
                    round_money("previous_day_revenue").alias("previous_day_revenue"),
                    round_money(F.col("revenue") - F.col("previous_day_revenue")).alias("change"), "revenue_rank")


# ---------------------------------------------------------------- RP-30..RP-38


def category_month_band(m: Model, bands=((600000, "High"), (300000, "Medium")), else_: str = "Low") -> DataFrame:
    """RP-30: month x category revenue with a CASE band over the aggregate."""
    pm = product_month(m).join(m.products.select("product_id", "category_name"), "product_id")
    g = pm.groupBy("sales_month", "category_name").agg(F.sum("revenue").alias("_r"))
    return g.select("sales_month", "category_name", round_money("_r").alias("revenue"),
                    _band("_r", list(bands), else_).alias("revenue_band"))


def product_band(m: Model, bands=((500000, "High"), (250000, "Medium")), else_: str = "Low") -> DataFrame:
    """RP-31: product revenue bands."""
    p = product_totals(m).join(m.products.select("product_id", "product_name"), "product_id")
    return p.select("product_id", "product_name", round_money("revenue").alias("revenue"),
                    _band("revenue", list(bands), else_).alias("revenue_band"))


def weekday_revenue(m: Model) -> DataFrame:
    """RP-32: revenue by full weekday name of the order date."""
    g = (sales_lines(m).groupBy(weekday_name("order_date").alias("weekday_name"))
         .agg(F.count_distinct("order_id").alias("completed_orders"), F.sum("gross_revenue").alias("_r")))
    return g.select("weekday_name", "completed_orders", round_money("_r").alias("gross_revenue"))


def sales_labels(m: Model, bands=((50000, "High"), (20000, "Medium")), else_: str = "Low") -> DataFrame:
    """RP-33: each valid completed line with a label, year, month, weekday and revenue band."""
    lines = sales_lines(m, ("product",))
    return lines.select("order_id", "line_number", F.upper(F.trim("product_name")).alias("product_label"),
                        F.year("order_date").alias("order_year"), F.month("order_date").alias("order_month"),
                        weekday_name("order_date").alias("weekday"),
                        F.col("gross_revenue").cast("double").alias("row_revenue"),
                        _band("gross_revenue", list(bands), else_).alias("revenue_band"))


def volume_vs_revenue(m: Model) -> DataFrame:
    """RP-34: product rank by units beside rank by revenue (RANK, ties share)."""
    p = product_totals(m).select("product_id", "units_sold", "revenue")
    p = W.dist_ranks(p, "units_sold", rank_out="units_rank", dense_out="_du")
    p = W.dist_ranks(p, "revenue", rank_out="revenue_rank", dense_out="_dr")
    return p.select("product_id", "units_sold", round_money("revenue").alias("revenue"), "units_rank", "revenue_rank")


def top_product_per_store(m: Model, ties: bool = False) -> DataFrame:
    """RP-35: the best-selling product per store; one winner (product_id breaks ties) or all tied."""
    sp = sales_lines(m).groupBy("store_id", "product_id").agg(F.sum("gross_revenue").alias("revenue"))
    order = [F.col("revenue").desc()] + ([] if ties else [F.col("product_id")])
    top = W.top_n(sp, ["store_id"], order, 1, ties=ties, out="store_rank")
    top = top.join(m.stores.select("store_id", "store_name"), "store_id")
    return top.select("store_id", "store_name", "product_id", round_money("revenue").alias("revenue"), "store_rank")


def category_shortlist(m: Model, start: str, end: str, min_units: int, min_revenue: float) -> DataFrame:
    """RP-36: categories in [start, end) with units >= min_units AND revenue > min_revenue."""
    lines = valid_items(m).join(_period_orders(m, start, end), "order_id")
    p = lines.groupBy("product_id").agg(F.sum("quantity").alias("_u"), F.sum("gross_revenue").alias("_r"))
    p = p.join(m.products.select("product_id", "category_name"), "product_id")
    g = p.groupBy("category_name").agg(F.sum("_u").cast("bigint").alias("units_sold"), F.sum("_r").alias("_r"))
    g = g.filter((F.col("units_sold") >= min_units) & (F.col("_r") > min_revenue))
    return g.select("category_name", "units_sold", round_money("_r").alias("revenue"))


def customer_fields(m: Model, as_of: str, accepted: Sequence[str]) -> DataFrame:
    """RP-37: cleaned name, normalised segment ('Unknown' otherwise), first order and tenure at ``as_of``.

    Where the customers have an email and a birth date: the cleaned email, its quality and the age as well.
    """
    from shelfwise.functions.metrics import normalize_tier
    from shelfwise.operators.quality import email_quality
    first = m.orders.groupBy("customer_id").agg(F.min(F.to_date("order_date")).alias("first_order_date"))
    c = m.customers.join(first, "customer_id", "left")
    contact = []
    if "email" in m.customers.columns:  # models with contact data also give the cleaned email and its quality
        contact += [F.lower(F.trim("email")).alias("clean_email"), email_quality("email").alias("email_quality")]
    if "birth_date" in m.customers.columns:
        contact.append(F.expr(f"timestampdiff(YEAR, birth_date, DATE'{as_of}')").alias("age_years"))
    return c.select("customer_id", F.trim("customer_name").alias("clean_name"),
                    normalize_tier("segment", "Unknown", accepted).alias("normalized_segment"), "first_order_date",
                    F.expr(f"timestampdiff(YEAR, first_order_date, DATE'{as_of}')").alias("tenure_years"), *contact)


def net_by_dimensions(m: Model, dims: Sequence[str] = ("sales_month", "region_name", "department")) -> DataFrame:
    """RP-38: net sales (gross minus the refunds of the same item) by any dimensions.

    Where items carry their refund (the driver mapping: a returned line's own
    revenue) it is taken from the line.  Otherwise refunds are summed per item
    and joined on the item key, so several returns of an item count once each.
    """
    need = tuple(x for x, cols in (("store", ("region_name", "store_name", "store_id", "city")),
                                   ("product", ("department", "category_name", "product_name")))
                 if any(d in cols for d in dims))
    lines = sales_lines(m, need)
    if "item_refund" not in lines.columns:
        per_item = m.returns.groupBy("order_item_id").agg(F.sum("refund_amount").alias("item_refund"))
        lines = lines.join(per_item, "order_item_id", "left")
    refund = F.coalesce(F.col("item_refund"), F.lit(0))
    g = lines.groupBy(*dims).agg(F.count_distinct("order_id").alias("completed_orders"),
                                 F.sum("quantity").cast("bigint").alias("units_sold"),
                                 F.sum("gross_revenue").alias("_g"), F.sum(refund).alias("_f"))
    return g.select(*dims, "completed_orders", "units_sold", round_money("_g").alias("gross_revenue"),
                    round_money("_f").alias("refund_amount"), round_money(F.col("_g") - F.col("_f")).alias("net_revenue"))
