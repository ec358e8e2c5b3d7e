"""Registered aggregates, set operations and subqueries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.catalog.base import register
from shelfwise.catalog.frames import CUSTOMER_SPEND_SQL, customer_spend, store_month, STORE_MONTH_SQL
from shelfwise.catalog.sqlkit import REV, VIEW, div_round, money
from shelfwise.functions.exprs import band
from shelfwise.functions.metrics import money as money_col
from shelfwise.functions.metrics import above_mean, mean_half_up, month_label, ratio_half_up, round_money
from shelfwise.operators import aggs as A
from shelfwise.operators.sales import dealt, sales_lines, valid_sales_view

_LINES = """lines AS (
  SELECT o.o_orderkey AS order_id, o.o_orderpriority AS channel, o.o_custkey AS customer_id, l.l_quantity AS quantity,
         CAST(l.l_extendedprice AS DECIMAL(18,4)) * (1 - CAST(l.l_discount AS DECIMAL(18,4))) AS gross_revenue
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  WHERE o.o_orderstatus = 'F' AND l.l_quantity > 0 AND l.l_extendedprice >= 0)"""


@register("agg_global_kpis", "AG-01", oracle=f"""
WITH {_LINES}
SELECT COUNT(*) AS item_rows, COUNT(DISTINCT order_id) AS completed_orders, CAST(SUM(quantity) AS BIGINT) AS units_sold,
       {money('SUM(gross_revenue)')} AS gross_revenue,
       {div_round('SUM(gross_revenue)', 'COUNT(*)', 2, 8)} AS avg_line_revenue
FROM lines
""")
def _ag01(t, m):
    return (sales_lines(m).agg(F.count(F.lit(1)).alias("item_rows"), F.count_distinct("order_id").alias("completed_orders"),
                               F.sum("quantity").cast("bigint").alias("units_sold"), F.sum("gross_revenue").alias("_r"))
            .select("item_rows", "completed_orders", "units_sold", round_money("_r").alias("gross_revenue"),
                    ratio_half_up("_r", "item_rows", 2).alias("avg_line_revenue")))


@register("agg_count_family", "AG-02", oracle="""
SELECT COUNT(*) AS row_count, COUNT(NULLIF(l_discount, 0)) AS non_null_count,
       COUNT(DISTINCT NULLIF(l_discount, 0)) AS distinct_count FROM lineitem
""")
def _ag02(t, m):
    return A.counts(m.items.withColumn("discount_or_null", F.nullif(F.col("discount"), F.lit(0.0))), "discount_or_null")


@register("agg_min_max_range", "AG-03", oracle="""
SELECT MIN(o_orderdate) AS first_order_at, MAX(o_orderdate) AS last_order_at, COUNT(*) AS order_rows,
       MIN(o_totalprice) AS min_total, MAX(o_totalprice) AS max_total FROM orders
""")
def _ag03(t, m):
    return m.orders.agg(F.min("order_date").alias("first_order_at"), F.max("order_date").alias("last_order_at"),
                        F.count(F.lit(1)).alias("order_rows"), F.min("order_total").alias("min_total"),
                        F.max("order_total").alias("max_total"))


@register("agg_case_sum", "AG-04", oracle="""
SELECT CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned_rows,
       CAST(SUM(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS accepted_rows,
       CAST(SUM(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS none_rows FROM lineitem
""")
def _ag04(t, m):
    f = F.col("return_flag")
    return A.count_where(m.items, {"returned_rows": f == "R", "accepted_rows": f == "A", "none_rows": f == "N"},
                         as_case=True)


@register("agg_bool_sum", "AG-05", oracle="""
SELECT COUNT(*) FILTER (WHERE l_discount = 0) AS zero_discount_rows,
       COUNT(*) FILTER (WHERE l_quantity > 45) AS bulk_rows,
       COUNT(*) FILTER (WHERE l_returnflag = 'R' AND l_linestatus = 'F') AS returned_closed_rows FROM lineitem
""")
def _ag05(t, m):
    li = t.lineitem
    return A.count_where(li, {"zero_discount_rows": F.col("l_discount") == 0,
                              "bulk_rows": F.col("l_quantity") > 45,
                              "returned_closed_rows": (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")})


@register("agg_filtered_kpi", "AG-06", oracle=f"""
SELECT COUNT(*) AS order_count, {money('SUM(CAST(o_totalprice AS DECIMAL(18,4)))')} AS total_value,
       {div_round('SUM(CAST(o_totalprice AS DECIMAL(18,4)))', 'COUNT(*)', 2, 4)} AS avg_value
FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def _ag06(t, m):
    return (m.orders.filter(F.col("channel") == "1-URGENT")
            .agg(F.count(F.lit(1)).alias("order_count"), F.sum(money_col("order_total")).alias("_s"))
            .select("order_count", round_money("_s").alias("total_value"),
                    ratio_half_up("_s", "order_count", 2).alias("avg_value")))


def _flag_kpis(df, by):
    return A.group_kpis(df, by, [F.count(F.lit(1)).alias("line_rows"), F.sum("quantity").cast("bigint").alias("units"),
                                 F.sum("gross_revenue").alias("_r")]).withColumn("gross_revenue", round_money("_r")).drop("_r")


@register("agg_group_one", "AG-07", oracle=f"""
SELECT l_returnflag AS return_flag, COUNT(*) AS line_rows, CAST(SUM(l_quantity) AS BIGINT) AS units,
       {money(f'SUM({REV})')} AS gross_revenue FROM lineitem l GROUP BY l_returnflag
""")
def _ag07(t, m):
    return _flag_kpis(m.items, ["return_flag"])


@register("agg_group_multi", "AG-08", oracle=f"""
SELECT l_returnflag AS return_flag, l_linestatus AS line_status, COUNT(*) AS line_rows,
       CAST(SUM(l_quantity) AS BIGINT) AS units, {money(f'SUM({REV})')} AS gross_revenue
FROM lineitem l GROUP BY l_returnflag, l_linestatus
""")
def _ag08(t, m):
    li = t.lineitem.select(F.col("l_returnflag").alias("return_flag"), F.col("l_linestatus").alias("line_status"),
                           F.col("l_quantity").alias("quantity"),
                           (money_col("l_extendedprice") * (1 - money_col("l_discount"))).alias("gross_revenue"))
    return _flag_kpis(li, ["return_flag", "line_status"])


@register("agg_group_expr", "AG-09", oracle=f"""
SELECT strftime(l_shipdate, '%Y-%m') AS ship_month, dayname(l_shipdate) AS ship_weekday, COUNT(*) AS line_rows,
       CAST(SUM(l_quantity) AS BIGINT) AS units, {money(f'SUM({REV})')} AS gross_revenue
FROM lineitem l GROUP BY 1, 2
""")
def _ag09(t, m):
    return _flag_kpis(m.items, [month_label("ship_date").alias("ship_month"),
                                F.date_format("ship_date", "EEEE").alias("ship_weekday")])


@register("agg_having", "AG-10", oracle=f"""
SELECT o_custkey AS customer_id, COUNT(*) AS order_count, {money('SUM(CAST(o_totalprice AS DECIMAL(18,4)))')} AS total_spend
FROM orders GROUP BY o_custkey HAVING SUM(CAST(o_totalprice AS DECIMAL(18,4))) > 3000000
""")
def _ag10(t, m):
    g = m.orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("order_count"),
                                             F.sum(money_col("order_total")).alias("_s"))
    return A.having(g, F.col("_s") > 3000000).select("customer_id", "order_count", round_money("_s").alias("total_spend"))


@register("agg_where_having", "AG-11", oracle=f"""
SELECT o_custkey AS customer_id, COUNT(*) AS order_count, {money('SUM(CAST(o_totalprice AS DECIMAL(18,4)))')} AS total_spend
FROM orders WHERE o_orderstatus = 'F'
GROUP BY o_custkey HAVING COUNT(*) >= 5 AND SUM(CAST(o_totalprice AS DECIMAL(18,4))) > 1500000
""")
def _ag11(t, m):
    g = customer_spend(m)
    return (A.having(g, (F.col("order_count") >= 5) & (F.col("total_spend") > 1500000))
            .select("customer_id", "order_count", round_money("total_spend").alias("total_spend")))


@register("agg_having_alias", "AG-12", oracle="""
SELECT o_custkey AS customer_id, COUNT(*) AS order_count FROM orders GROUP BY o_custkey HAVING COUNT(*) >= 17
""")
def _ag12(t, m):
    return t.spark.sql("SELECT o_custkey AS customer_id, COUNT(*) AS order_count FROM {orders} "
                       "GROUP BY customer_id HAVING order_count >= 17", orders=t.orders)


@register("agg_having_distinct", "AG-13", oracle="""
SELECT p_name AS normalized_name, COUNT(*) AS item_rows, COUNT(DISTINCT p_type) AS raw_variants
FROM part GROUP BY p_name HAVING COUNT(DISTINCT p_type) >= 6
""")
def _ag13(t, m):
    return A.variants(t.part, "p_type", key=F.col("p_name"), min_variants=6)


@register("agg_two_level", "AG-14", oracle=f"""
WITH {_LINES},
per_customer AS (SELECT channel, customer_id, SUM(gross_revenue) AS s FROM lines GROUP BY channel, customer_id)
SELECT channel, {div_round('SUM(s)', 'COUNT(*)', 2, 8)} AS avg_customer_revenue, COUNT(*) AS customers
FROM per_customer GROUP BY channel
""")
def _ag14(t, m):
    out = A.avg_of_sums(sales_lines(m), ["customer_id"], "gross_revenue", outer=["channel"])
    return out.select("channel", mean_half_up("sum_of_group_totals", "groups").alias("avg_customer_revenue"),
                      F.col("groups").alias("customers"))


@register("agg_ratio", "AG-15", oracle=f"""
WITH {_LINES}
SELECT channel, COUNT(DISTINCT order_id) AS completed_orders,
       {div_round('SUM(gross_revenue)', 'COUNT(DISTINCT order_id)', 2, 8)} AS revenue_per_order
FROM lines GROUP BY channel
""")
def _ag15(t, m):
    g = sales_lines(m).groupBy("channel").agg(F.count_distinct("order_id").alias("completed_orders"),
                                             F.sum("gross_revenue").alias("_r"))
    return g.select("channel", "completed_orders",
                    ratio_half_up("_r", "completed_orders", 2).alias("revenue_per_order"))


@register("agg_regroup_coarser", "AG-16", oracle=f"""
WITH {VIEW}
SELECT region_name, COUNT(DISTINCT order_id) AS completed_orders, {money('SUM(gross_revenue)')} AS gross_revenue
FROM v GROUP BY region_name
""")
def _ag16(t, m):
    """The region grain out of the state of the store grain: distinct orders are merged, never summed."""
    lines, = dealt("order_id", sales_lines(m, ("store",), by_order=True))
    state = A.distinct_state(lines, ["store_id", "region_name"], "order_id", ["gross_revenue"])
    out = A.from_state(state, ["region_name"], "order_id", {"_r": "gross_revenue"})
    return out.select("region_name", F.col("distinct_order_ids").alias("completed_orders"),
                      round_money("_r").alias("gross_revenue"))


@register("agg_band", "AG-17", oracle=f"""
WITH {CUSTOMER_SPEND_SQL}
SELECT customer_id, {money('total_spend')} AS total_spend,
       CASE WHEN total_spend >= 2000000 THEN 'High' WHEN total_spend >= 800000 THEN 'Medium' ELSE 'Low' END AS spend_band
FROM cs
""")
def _ag17(t, m):
    g = customer_spend(m)
    return g.select("customer_id", round_money("total_spend").alias("total_spend"),
                    band("total_spend", [(2000000, "High"), (800000, "Medium")], "Low").alias("spend_band"))


# ------------------------------------------------------------------ set operations


@register("union_all", "ST-01", oracle="""
SELECT o_orderkey AS order_id, 'urgent' AS reason FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL
SELECT o_orderkey AS order_id, 'large' AS reason FROM orders WHERE o_totalprice > 400000
""")
def _st01(t, m):
    a = m.orders.filter(F.col("channel") == "1-URGENT").select("order_id", F.lit("urgent").alias("reason"))
    b = m.orders.filter(F.col("order_total") > 400000).select("order_id", F.lit("large").alias("reason"))
    return A.stack([a, b])


@register("union_distinct", "ST-02", oracle="""
SELECT o_custkey AS customer_id FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
UNION
SELECT o_custkey AS customer_id FROM orders WHERE o_totalprice > 400000
""")
def _st02(t, m):
    a = m.orders.filter((F.col("channel") == "1-URGENT") & (F.col("status") == "F")).select("customer_id")
    b = m.orders.filter(F.col("order_total") > 400000).select("customer_id")
    return A.stack([a, b], distinct=True)


# ------------------------------------------------------------------ subqueries, CTEs, views


@register("sub_scalar_filter", "SV-01", oracle="""
SELECT p_partkey AS product_id, p_retailprice AS list_price FROM part
WHERE CAST(p_retailprice AS DECIMAL(18,4)) * (SELECT COUNT(*) FROM part)
      > (SELECT SUM(CAST(p_retailprice AS DECIMAL(18,4))) FROM part)
""")
def _sv01(t, m):
    p = m.products.select("product_id", "list_price", money_col("list_price").alias("_price"))
    return A.above_avg(p, "_price").drop("_price")


@register("sub_scalar_select", "SV-02", oracle=f"""
WITH b AS (SELECT SUM(CAST(s_acctbal AS DECIMAL(18,4))) AS s, COUNT(*) AS n FROM supplier)
SELECT s_suppkey AS store_id, s_acctbal AS balance, {div_round('b.s', 'b.n', 2, 4)} AS avg_balance
FROM supplier CROSS JOIN b
""")
def _sv02(t, m):
    from shelfwise.operators.joins import attach_scalar
    s = t.supplier.select(F.col("s_suppkey").alias("store_id"), F.col("s_acctbal").alias("balance"))
    bench = s.agg(F.sum(money_col("balance")).alias("_s"), F.count("balance").alias("_n"))
    return attach_scalar(s, bench).select("store_id", "balance", mean_half_up("_s", "_n").alias("avg_balance"))


@register("sub_correlated_scalar", "SV-03", oracle="""
WITH g AS (SELECT p_type, SUM(CAST(p_retailprice AS DECIMAL(18,4))) AS s, COUNT(*) AS n FROM part GROUP BY p_type)
SELECT p.p_partkey AS product_id, p.p_type AS department, p.p_retailprice AS list_price
FROM part p JOIN g ON g.p_type = p.p_type
WHERE CAST(p.p_retailprice AS DECIMAL(18,4)) * g.n > g.s
""")
def _sv03(t, m):
    p = m.products.select("product_id", "department", "list_price", money_col("list_price").alias("_price"))
    return A.above_group_avg(p, "_price", ["department"]).select("product_id", "department", "list_price")


@register("sub_derived_table", "SV-04", oracle="""
SELECT customer_id, order_count FROM (
  SELECT o_custkey AS customer_id, COUNT(*) AS order_count FROM orders GROUP BY o_custkey) d
WHERE order_count >= 15
""")
def _sv04(t, m):
    d = m.orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("order_count"))
    return d.filter(F.col("order_count") >= 15)


@register("cte_chain", "SV-05", oracle=f"""
WITH {STORE_MONTH_SQL},
store_avg AS (SELECT store_id, AVG(revenue) AS avg_rev, SUM(revenue) AS s, COUNT(*) AS n FROM sm GROUP BY store_id)
SELECT sm.store_id, sm.sales_month, {money('sm.revenue')} AS revenue
FROM sm JOIN store_avg a ON a.store_id = sm.store_id
WHERE sm.revenue * a.n > a.s
""")
def _sv05(t, m):
    sm = store_month(m)
    store_avg = sm.groupBy("store_id").agg(F.sum("revenue").alias("_s"), F.count("revenue").alias("_n"))
    above = sm.join(store_avg, "store_id").filter(above_mean("revenue", "_s", "_n"))
    return above.select("store_id", "sales_month", round_money("revenue").alias("revenue"))


_VIEW_NAME = "shelfwise_monthly_kpis_v"


@register("view_create_replace", "SV-06", oracle=f"""
WITH {VIEW}
SELECT sales_month, COUNT(DISTINCT order_id) AS completed_orders, {money('SUM(gross_revenue)')} AS gross_revenue
FROM v GROUP BY sales_month
""")
def _sv06(t, m):
    from shelfwise.operators.views import register_view
    lines = sales_lines(m)
    kpis = lines.groupBy("sales_month").agg(F.count_distinct("order_id").alias("completed_orders"),
                                            F.sum("gross_revenue").alias("_r"))
    register_view(t.spark, _VIEW_NAME, kpis.select("sales_month", "completed_orders", round_money("_r").alias("gross_revenue")))
    return t.spark.table(_VIEW_NAME)


@register("view_layered", "SV-07", oracle=f"""
WITH {VIEW},
dept AS (SELECT department, CAST(SUM(quantity) AS BIGINT) AS units, SUM(gross_revenue) AS r FROM v GROUP BY department)
SELECT department, units, {money('r')} AS gross_revenue,
       CAST(RANK() OVER (ORDER BY r DESC) AS BIGINT) AS revenue_rank
FROM dept WHERE units > 1000
""")
def _sv07(t, m):
    from shelfwise.operators.views import register_view
    from shelfwise.operators.windows import dist_ranks
    register_view(t.spark, "shelfwise_valid_sales_v", valid_sales_view(m))
    v = t.spark.table("shelfwise_valid_sales_v")
    dept = v.groupBy("department").agg(F.sum("quantity").cast("bigint").alias("units"), F.sum("gross_revenue").alias("r"))
    ranked = dist_ranks(dept.filter(F.col("units") > 1000), "r", rank_out="revenue_rank", dense_out="_d")
    return ranked.select("department", "units", round_money("r").alias("gross_revenue"), "revenue_rank")


@register("view_restricted_columns", "SV-08", oracle="""
SELECT c.c_custkey AS customer_id, c.c_name AS customer_name, n.n_name AS city, c.c_mktsegment AS segment
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
""")
def _sv08(t, m):
    from shelfwise.operators.views import restrict
    return restrict(m.customers, ["customer_id", "customer_name", "city", "segment"])


@register("view_drop", "SV-09", oracle="""
SELECT 'shelfwise_orders_v' AS view_name, TRUE AS existed_before, FALSE AS exists_after, COUNT(*) AS table_rows
FROM orders
""")
def _sv09(t, m):
    from shelfwise.operators.views import drop_view, register_view
    name = "shelfwise_orders_v"
    register_view(t.spark, name, t.orders)
    before = t.spark.catalog.tableExists(name)
    drop_view(t.spark, name)
    after = t.spark.catalog.tableExists(name)
    return t.orders.agg(F.count(F.lit(1)).alias("table_rows")).select(
        F.lit(name).alias("view_name"), F.lit(before).alias("existed_before"), F.lit(after).alias("exists_after"),
        "table_rows")
