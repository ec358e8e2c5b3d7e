"""Registered window functions and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.catalog.base import register
from shelfwise.catalog.frames import (CUSTOMER_SPEND_SQL, DAILY_SQL, PRODUCT_SALES_SQL, STORE_MONTH_SQL,
                                      customer_spend, daily_purchases, product_sales, store_month)
from shelfwise.catalog.sqlkit import REV, div_round, money
from shelfwise.functions.metrics import money as money_col
from shelfwise.functions.metrics import round_money
from shelfwise.operators import windows as W
from shelfwise.operators.sales import sales_lines


def _dbl(c):
    return F.col(c).cast("double")


@register("win_total", "WN-01", oracle=f"""
WITH {DAILY_SQL}
SELECT day, CAST(revenue AS DOUBLE) AS revenue, CAST(SUM(revenue) OVER () AS DOUBLE) AS grand_total FROM daily
""")
def _wn01(t, m):
    d = W.with_total(daily_purchases(t), "revenue")
    return d.select("day", _dbl("revenue").alias("revenue"), _dbl("grand_total").alias("grand_total"))


@register("win_partition_total", "WN-02", oracle="""
SELECT event_id, user_id, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id) AS DOUBLE) AS user_total
FROM events WHERE event_type = 'purchase'
""")
def _wn02(t, m):
    e = t.events.filter(F.col("event_type") == "purchase").select("event_id", "user_id",
                                                                  F.col("value").cast("decimal(18,2)").alias("v"))
    d = W.with_group_total(e, "v", ["user_id"], "user_total")
    return d.select("event_id", "user_id", _dbl("v").alias("value"), _dbl("user_total").alias("user_total"))


@register("win_running_rows", "WN-03", oracle="""
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) OVER (
            PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
FROM orders
""")
def _wn03(t, m):
    o = m.orders.select("order_id", "customer_id", "order_date", money_col("order_total").alias("v"))
    r = W.running(o, "v", ["order_date", "order_id"], by=["customer_id"], frame="rows")
    return r.select("order_id", "customer_id", _dbl("running_total").alias("running_total"))


@register("win_running_range", "WN-04", oracle="""
SELECT o_orderkey AS order_id, o_orderdate AS order_date,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) OVER (ORDER BY o_orderdate) AS DOUBLE) AS running_total
FROM orders
""")
def _wn04(t, m):
    o = m.orders.select("order_id", "order_date", money_col("order_total").alias("v"))
    r = W.running(o, "v", ["order_date"], frame="range")
    return r.select("order_id", "order_date", _dbl("running_total").alias("running_total"))


@register("win_row_number", "WN-05", oracle="""
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS order_seq
FROM orders
""")
def _wn05(t, m):
    o = m.orders.select("order_id", "customer_id", "order_date")
    return W.number(o, ["order_date", "order_id"], by=["customer_id"], out="order_seq").drop("order_date")


@register("win_rank_dense_rank", "WN-06", oracle=f"""
WITH {PRODUCT_SALES_SQL}
SELECT product_id, units, CAST(RANK() OVER (ORDER BY units DESC) AS BIGINT) AS units_rank,
       CAST(DENSE_RANK() OVER (ORDER BY units DESC) AS BIGINT) AS units_dense_rank
FROM ps
""")
def _wn06(t, m):
    ps = product_sales(m).select("product_id", "units")
    return W.dist_ranks(ps, "units", rank_out="units_rank", dense_out="units_dense_rank")


@register("win_rank_in_group", "WN-07", oracle=f"""
WITH {PRODUCT_SALES_SQL}
SELECT ps.product_id, p.p_type AS department, ps.units,
       CAST(RANK() OVER (PARTITION BY p.p_type ORDER BY ps.units DESC) AS BIGINT) AS units_rank,
       CAST(DENSE_RANK() OVER (PARTITION BY p.p_type ORDER BY ps.units DESC) AS BIGINT) AS units_dense_rank,
       CAST(ROW_NUMBER() OVER (PARTITION BY p.p_type ORDER BY ps.units DESC, ps.product_id) AS BIGINT) AS position
FROM ps JOIN part p ON p.p_partkey = ps.product_id
""")
def _wn07(t, m):
    ps = product_sales(m).select("product_id", "units").join(m.products.select("product_id", "department"), "product_id")
    r = W.dist_ranks(ps, "units", by=["department"], rank_out="units_rank", dense_out="units_dense_rank")
    return W.number(r, [F.col("units").desc(), F.col("product_id")], by=["department"], out="position")


@register("win_top_n", "WN-08", oracle=f"""
WITH {PRODUCT_SALES_SQL},
r AS (SELECT ps.product_id, p.p_type AS department, ps.revenue,
             ROW_NUMBER() OVER (PARTITION BY p.p_type ORDER BY ps.revenue DESC, ps.product_id) AS rn
      FROM ps JOIN part p ON p.p_partkey = ps.product_id)
SELECT product_id, department, {money('revenue')} AS revenue, CAST(rn AS INTEGER) AS rank_in_group FROM r WHERE rn <= 3
""")
def _wn08(t, m):
    ps = product_sales(m).join(m.products.select("product_id", "department"), "product_id")
    top = W.top_n(ps, ["department"], [F.col("revenue").desc(), F.col("product_id")], 3)
    return top.select("product_id", "department", round_money("revenue").alias("revenue"), "rank_in_group")


@register("win_top_n_ties", "WN-09", oracle=f"""
WITH {PRODUCT_SALES_SQL},
r AS (SELECT ps.product_id, p.p_type AS department, ps.units,
             DENSE_RANK() OVER (PARTITION BY p.p_type ORDER BY ps.units DESC) AS dr
      FROM ps JOIN part p ON p.p_partkey = ps.product_id)
SELECT product_id, department, units, CAST(dr AS INTEGER) AS rank_in_group FROM r WHERE dr <= 3
""")
def _wn09(t, m):
    ps = product_sales(m).select("product_id", "units").join(m.products.select("product_id", "department"), "product_id")
    return W.top_n(ps, ["department"], [F.col("units").desc()], 3, ties=True)


@register("win_lag", "WN-10", oracle=f"""
WITH {DAILY_SQL}
SELECT day, CAST(revenue AS DOUBLE) AS revenue, CAST(LAG(revenue) OVER (ORDER BY day) AS DOUBLE) AS prior_revenue
FROM daily
""")
def _wn10(t, m):
    d = W.lagged(daily_purchases(t), "revenue", ["day"], out="prior_revenue", bounded=True)
    return d.select("day", _dbl("revenue").alias("revenue"), _dbl("prior_revenue").alias("prior_revenue"))


@register("win_lead", "WN-11", oracle=f"""
WITH {DAILY_SQL}
SELECT day, purchases, LEAD(purchases) OVER (ORDER BY day) AS next_purchases FROM daily
""")
def _wn11(t, m):
    d = W.lagged(daily_purchases(t), "purchases", ["day"], lead=True, out="next_purchases", bounded=True)
    return d.select("day", "purchases", "next_purchases")


@register("win_change", "WN-12", oracle=f"""
WITH {STORE_MONTH_SQL}
SELECT store_id, sales_month, {money('revenue')} AS revenue,
       {money('revenue - LAG(revenue) OVER (PARTITION BY store_id ORDER BY sales_month)')} AS change
FROM sm
""")
def _wn12(t, m):
    d = W.change(store_month(m), "revenue", ["sales_month"], by=["store_id"], bounded=True)
    return d.select("store_id", "sales_month", round_money("revenue").alias("revenue"), round_money("change").alias("change"))


@register("win_pct_change", "WN-13", oracle=f"""
WITH {DAILY_SQL},
c AS (SELECT day, revenue, LAG(revenue) OVER (ORDER BY day) AS prior FROM daily)
SELECT day, CAST(revenue AS DOUBLE) AS revenue, CAST(prior AS DOUBLE) AS prior_revenue,
       {div_round('100 * (revenue - prior) * 100', 'CAST(prior * 100 AS BIGINT)', 1)} AS pct_change
FROM c
""")
def _wn13(t, m):
    d = W.pct_change(daily_purchases(t), "revenue", ["day"], prior="prior_revenue", bounded=True)
    return d.select("day", _dbl("revenue").alias("revenue"), _dbl("prior_revenue").alias("prior_revenue"),
                    _dbl("pct_change").alias("pct_change"))


@register("win_moving_avg", "WN-14", oracle=f"""
WITH {DAILY_SQL},
c AS (SELECT day, revenue,
             SUM(revenue) OVER (ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS s,
             COUNT(*) OVER (ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS n FROM daily)
SELECT day, CAST(revenue AS DOUBLE) AS revenue, {div_round('s', 'n', 3, 2)} AS moving_avg_3d FROM c
""")
def _wn14(t, m):
    d = W.moving_avg(daily_purchases(t), "revenue", ["day"], 3, out="moving_avg_3d", bounded=True)
    return d.select("day", _dbl("revenue").alias("revenue"), F.round("moving_avg_3d", 3).cast("double").alias("moving_avg_3d"))


# Series as long as the data: one of all orders, and one per product of which any may hold a third of the lines.


@register("win_neighbours_of_orders", "WN-10", oracle="""
SELECT o_orderkey AS order_id, o_totalprice AS order_total,
       LAG(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey) AS prior_order_total,
       LEAD(o_totalprice, 2) OVER (ORDER BY o_orderdate, o_orderkey) AS second_next_total
FROM orders
""")
def _wn10_orders(t, m):
    o = m.orders.select("order_id", "order_date", "order_total")
    o = W.lagged(o, "order_total", ["order_date", "order_id"], out="prior_order_total")
    o = W.lagged(o, "order_total", ["order_date", "order_id"], offset=2, lead=True, out="second_next_total")
    return o.select("order_id", "order_total", "prior_order_total", "second_next_total")


@register("win_change_of_items", "WN-12", oracle="""
SELECT l_partkey AS product_id, l_orderkey AS order_id, l_linenumber AS line_number,
       l_quantity - LAG(l_quantity) OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber) AS change
FROM lineitem
""")
def _wn12_items(t, m):
    i = t.lineitem.select(F.col("l_partkey").alias("product_id"), F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"), "l_shipdate", "l_quantity")
    return W.change(i, "l_quantity", ["l_shipdate", "order_id", "line_number"], by=["product_id"]).select("product_id", "order_id", "line_number", "change")


@register("win_moving_avg_of_items", "WN-14", oracle="""
SELECT l_suppkey AS store_id, l_orderkey AS order_id, l_linenumber AS line_number,
       CAST(SUM(CAST(l_quantity AS BIGINT)) OVER w AS DOUBLE) / COUNT(*) OVER w AS moving_avg_5
FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
""")
def _wn14_items(t, m):
    i = t.lineitem.select(F.col("l_suppkey").alias("store_id"), F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"), "l_shipdate",
                          F.col("l_quantity").cast("bigint").alias("quantity"))
    return W.moving_avg(i, "quantity", ["l_shipdate", "order_id", "line_number"], 5, by=["store_id"], out="moving_avg_5").select("store_id", "order_id", "line_number", "moving_avg_5")


@register("win_peer_avg", "WN-15", oracle=f"""
WITH {CUSTOMER_SPEND_SQL},
j AS (SELECT cs.customer_id, c.c_mktsegment AS segment, cs.total_spend FROM cs JOIN customer c ON c.c_custkey = cs.customer_id),
g AS (SELECT segment, SUM(total_spend) AS s, COUNT(*) AS n FROM j GROUP BY segment)
SELECT j.customer_id, j.segment, {money('j.total_spend')} AS total_spend,
       {div_round('g.s', 'g.n', 2, 4)} AS peer_average,
       {div_round('j.total_spend * g.n - g.s', 'g.n', 2, 4)} AS difference_from_peers
FROM j JOIN g USING (segment)
""")
def _wn15(t, m):
    j = customer_spend(m).join(m.customers.select("customer_id", "segment"), "customer_id")
    d = W.vs_peers(j, "total_spend", ["segment"])
    return d.select("customer_id", "segment", round_money("total_spend").alias("total_spend"),
                    "peer_average", "difference_from_peers")


@register("win_pct_of_total", "WN-16", oracle=f"""
WITH {PRODUCT_SALES_SQL},
tot AS (SELECT SUM(revenue) AS total FROM ps)
SELECT product_id, {money('revenue')} AS revenue,
       {div_round('CAST(100 * revenue * 100000000 AS HUGEINT)', 'CAST(total * 100000000 AS HUGEINT)', 2)} AS pct_of_total
FROM ps CROSS JOIN tot
""")
def _wn16(t, m):
    d = W.share(product_sales(m).select("product_id", "revenue"), "revenue")
    return d.select("product_id", round_money("revenue").alias("revenue"), "pct_of_total")


@register("win_rank_over_agg", "WN-17", oracle=f"""
WITH {STORE_MONTH_SQL},
st AS (SELECT store_id, SUM(revenue) AS r FROM sm GROUP BY store_id)
SELECT store_id, {money('r')} AS revenue, CAST(RANK() OVER (ORDER BY r DESC) AS BIGINT) AS revenue_rank FROM st
""")
def _wn17(t, m):
    st = sales_lines(m).groupBy("store_id").agg(F.sum("gross_revenue").alias("r"))
    d = W.dist_ranks(st, "r", rank_out="revenue_rank", dense_out="_dense")
    return d.select("store_id", round_money("r").alias("revenue"), "revenue_rank")


# ------------------------------------------------------------------ sorts


@register("sort_multi", "SO-01", oracle="""
SELECT o_orderkey AS order_id, o_orderpriority AS channel, o_totalprice AS order_total FROM orders
ORDER BY channel ASC, order_total DESC, order_id
""")
def _so01(t, m):
    return (m.orders.select("order_id", "channel", "order_total")
            .orderBy(F.col("channel").asc(), F.col("order_total").desc(), F.col("order_id")))


@register("sort_top_k", "SO-02", oracle=f"""
SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id,
       CAST({REV} AS DOUBLE) AS gross_item_revenue
FROM lineitem l WHERE l_quantity > 0 AND l_extendedprice >= 0
ORDER BY {REV} DESC, order_id, line_number, product_id LIMIT 20
""")
def _so02(t, m):
    it = m.items.filter(F.col("quantity") > 0).filter(F.col("unit_price") >= 0)
    top = W.top_k(it, [F.col("gross_revenue").desc(), "order_id", "line_number", "product_id"], 20)
    return top.select("order_id", "line_number", "product_id", _dbl("gross_revenue").alias("gross_item_revenue"))


@register("sort_argmax", "SO-03", oracle=f"""
SELECT o.o_orderpriority AS channel, {money(f'SUM({REV})')} AS gross_revenue
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE o.o_orderstatus = 'F' AND l.l_quantity > 0 AND l.l_extendedprice >= 0
GROUP BY o.o_orderpriority ORDER BY SUM({REV}) DESC, channel LIMIT 1
""")
def _so03(t, m):
    g = sales_lines(m).groupBy("channel").agg(F.sum("gross_revenue").alias("r"))
    return W.top_k(g, [F.col("r").desc(), "channel"], 1).select("channel", round_money("r").alias("gross_revenue"))


@register("sort_nulls", "SO-04", oracle="""
SELECT conv_id, turn, parent_role,
       ROW_NUMBER() OVER (ORDER BY parent_role ASC NULLS FIRST, conv_id DESC NULLS LAST, turn) AS position
FROM (
SELECT c.conv_id, c.turn, p.role AS parent_role
FROM conversations c LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1
) h
ORDER BY position
""")
def _so04(t, m):
    c = t.conversations
    parent = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("parent_role"))
    h = c.select("conv_id", "turn").join(parent, ["conv_id", "turn"], "left")
    order = [F.col("parent_role").asc_nulls_first(), F.col("conv_id").desc_nulls_last(), F.col("turn")]
    return W.number(h, order, out="position").orderBy("position")
