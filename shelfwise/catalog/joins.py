"""Registered join operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.catalog.base import register
from shelfwise.catalog.sqlkit import REV, div_round, money
from shelfwise.functions.metrics import money as money_col
from shelfwise.functions.metrics import diff_from_mean_half_up, mean_half_up, round_money
from shelfwise.functions.exprs import in_period
from shelfwise.operators import joins as J
from shelfwise.operators.sales import valid_items
from shelfwise.sources import literals


@register("join_inner", "JN-01", oracle="""
SELECT l_orderkey AS order_id, l_linenumber AS line_number, p_partkey AS product_id, p_name AS product_name,
       p_brand AS category_name
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
""")
def _jn01(t, m):
    return (m.items.select("order_id", "line_number", "product_id")
            .join(m.products.select("product_id", "product_name", "category_name"), "product_id"))


@register("join_star", "JN-02", oracle="""
SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_number, CAST(o.o_orderdate AS DATE) AS order_date,
       c.c_name AS customer_name, s.s_name AS store_name, r.r_name AS region_name, p.p_name AS product_name,
       p.p_type AS department, l.l_quantity AS quantity
FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
JOIN supplier s ON s.s_suppkey = l.l_suppkey
LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
JOIN part p ON p.p_partkey = l.l_partkey
""")
def _jn02(t, m):
    o = m.orders.select("order_id", "customer_id", F.to_date("order_date").alias("order_date"))
    out = J.star(m.items.select("order_id", "line_number", "product_id", "store_id", "quantity"), [
        (o, "order_id", "inner"),
        (m.customers.select("customer_id", "customer_name"), "customer_id", "left"),
        (m.stores.select("store_id", "store_name", "region_name"), "store_id", "inner"),
        (m.products.select("product_id", "product_name", "department"), "product_id", "inner"),
    ])
    return out.select("order_id", "line_number", "order_date", "customer_name", "store_name", "region_name",
                      "product_name", "department", "quantity")


_Q1 = ("1995-01-01", "1995-04-01")


@register("join_left_zero_fill", "JN-03", oracle=f"""
WITH sold AS (
  SELECT l.l_suppkey AS store_id, SUM(l.l_quantity) AS units, SUM({REV}) AS revenue
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  WHERE o.o_orderstatus = 'F' AND l.l_quantity > 0 AND l.l_extendedprice >= 0
    AND o.o_orderdate >= TIMESTAMP '{_Q1[0]}' AND o.o_orderdate < TIMESTAMP '{_Q1[1]}'
  GROUP BY l.l_suppkey)
SELECT s.s_suppkey AS store_id, s.s_name AS store_name, CAST(COALESCE(sold.units, 0) AS BIGINT) AS units_sold,
       {money('COALESCE(sold.revenue, 0)')} AS gross_revenue
FROM supplier s LEFT JOIN sold ON sold.store_id = s.s_suppkey
""")
def _jn03(t, m):
    o = m.orders.filter((F.col("status") == m.completed) & in_period("order_date", *_Q1)).select("order_id")
    sold = (valid_items(m).join(o, "order_id").groupBy("store_id")
            .agg(F.sum("quantity").alias("units"), F.sum("gross_revenue").alias("revenue")))
    out = J.coverage(m.stores.select("store_id", "store_name"), "store_id", sold, {})
    return out.select("store_id", "store_name", F.coalesce(F.col("units"), F.lit(0)).cast("bigint").alias("units_sold"),
                      round_money(F.coalesce(F.col("revenue"), F.lit(0))).alias("gross_revenue"))


@register("join_right", "JN-04", oracle="""
SELECT p.p_partkey AS product_id, p.p_name AS product_name, l.l_orderkey AS order_id, l.l_linenumber AS line_number
FROM (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1995-02-01') l
RIGHT JOIN part p ON p.p_partkey = l.l_partkey
""")
def _jn04(t, m):
    it = m.items.filter(in_period("ship_date", "1995-01-01", "1995-02-01")).select("order_id", "line_number", "product_id")
    return (it.join(m.products.select("product_id", "product_name"), "product_id", "right")
            .select("product_id", "product_name", "order_id", "line_number"))


@register("join_self_hierarchy", "JN-05", oracle="""
SELECT c.conv_id, c.turn, c.role, p.role AS parent_role
FROM conversations c LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1
""")
def _jn05(t, m):
    c = t.conversations
    parent = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("parent_role"))
    return c.select("conv_id", "turn", "role").join(parent, ["conv_id", "turn"], "left")


@register("join_cross_benchmark", "JN-06", oracle=f"""
WITH b AS (SELECT SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS s, COUNT(*) AS n FROM orders)
SELECT o.o_orderkey AS order_id, o.o_totalprice AS order_total,
       {div_round('b.s', 'b.n', 2, 4)} AS avg_order_total,
       {div_round('b.n * CAST(o.o_totalprice AS DECIMAL(18,4)) - b.s', 'b.n', 2, 4)} AS diff_from_avg
FROM orders o CROSS JOIN b
""")
def _jn06(t, m):
    bench = m.orders.agg(F.sum(money_col("order_total")).alias("_s"), F.count("order_total").alias("_n"))
    out = J.attach_scalar(m.orders.select("order_id", "order_total"), bench, "order benchmark")
    return out.select("order_id", "order_total", mean_half_up("_s", "_n").alias("avg_order_total"),
                      diff_from_mean_half_up(money_col("order_total"), "_s", "_n").alias("diff_from_avg"))


@register("semi_in", "JN-07", oracle="""
SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
                     AND o_totalprice > 300000)
""")
def _jn07(t, m):
    sub = m.orders.filter((F.col("channel") == "1-URGENT") & (F.col("status") == "F") & (F.col("order_total") > 300000))
    return J.semi(m.customers.select("customer_id", "customer_name"), sub.select("customer_id"), "customer_id")


@register("semi_exists", "JN-08", oracle="""
SELECT p.p_partkey AS product_id, p.p_name AS product_name FROM part p
WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey AND l.l_quantity >= 49 AND l.l_discount >= 0.09)
""")
def _jn08(t, m):
    sub = m.items.filter((F.col("quantity") >= 49) & (F.col("discount") >= 0.09)).select("product_id")
    return J.semi(m.products.select("product_id", "product_name"), sub, "product_id")


@register("anti_not_exists", "JN-09", oracle="""
SELECT p.p_partkey AS product_id, p.p_name AS product_name FROM part p
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey AND l.l_returnflag = 'R'
                   AND l.l_quantity >= 40)
""")
def _jn09(t, m):
    sub = m.items.filter((F.col("return_flag") == "R") & (F.col("quantity") >= 40)).select("product_id")
    return J.anti(m.products.select("product_id", "product_name"), sub, "product_id")


@register("anti_left_null", "JN-10", oracle="""
SELECT o.o_orderkey AS order_id, o.o_orderstatus AS status
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE l.l_orderkey IS NULL
""")
def _jn10(t, m):
    return J.anti_left_null(m.orders.select("order_id", "status"), m.items, "order_id", "order_id")


@register("anti_recency_range", "JN-11", oracle="""
WITH b AS (SELECT MAX(CAST(l_shipdate AS DATE)) AS latest FROM lineitem)
SELECT s.s_suppkey AS store_id, s.s_name AS store_name
FROM supplier s CROSS JOIN b
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_suppkey = s.s_suppkey
                  AND CAST(l.l_shipdate AS DATE) > b.latest - 7 AND CAST(l.l_shipdate AS DATE) <= b.latest)
""")
def _jn11(t, m):
    ship = m.items.select("store_id", F.to_date("ship_date").alias("ship_day"))
    boundary = ship.agg(F.max("ship_day").alias("latest"))
    recent = (ship.crossJoin(F.broadcast(boundary))
              .filter((F.col("ship_day") > F.date_sub("latest", 7)) & (F.col("ship_day") <= F.col("latest")))
              .select("store_id"))
    return J.anti(m.stores.select("store_id", "store_name"), recent, "store_id")


@register("left_join_filter_in_on", "JN-12", oracle=f"""
SELECT s.s_suppkey AS store_id, s.s_name AS store_name, COUNT(l.l_orderkey) AS valid_item_rows
FROM supplier s
LEFT JOIN lineitem l ON l.l_suppkey = s.s_suppkey AND l.l_quantity > 0 AND l.l_extendedprice >= 0
                    AND l.l_shipdate >= TIMESTAMP '1995-01-01' AND l.l_shipdate < TIMESTAMP '1995-03-01'
LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F'
GROUP BY s.s_suppkey, s.s_name
HAVING COUNT(o.o_orderkey) = 0
""")
def _jn12(t, m):
    it = valid_items(m).filter(in_period("ship_date", "1995-01-01", "1995-03-01")).select("order_id", "store_id")
    per_store = it.groupBy("store_id").agg(F.count(F.lit(1)).alias("valid_item_rows"))
    sold = it.join(m.orders.filter(F.col("status") == m.completed).select("order_id"), "order_id").select("store_id")
    unsold = J.anti(m.stores.select("store_id", "store_name"), sold, "store_id")
    return (unsold.join(per_store, "store_id", "left")
            .select("store_id", "store_name", F.coalesce("valid_item_rows", F.lit(0)).alias("valid_item_rows")))


@register("not_in_null_trap", "JN-13", oracle="""
SELECT (SELECT COUNT(*) FROM customer WHERE c_custkey NOT IN (
          SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END FROM orders
          WHERE o_orderpriority = '1-URGENT')) AS not_in_rows,
       (SELECT COUNT(*) FROM customer c WHERE NOT EXISTS (
          SELECT 1 FROM orders o WHERE o.o_orderpriority = '1-URGENT' AND o.o_orderstatus <> 'P'
          AND o.o_custkey = c.c_custkey)) AS not_exists_rows
""")
def _jn13(t, m):
    other = (m.orders.filter(F.col("channel") == "1-URGENT")
             .select(F.when(F.col("status") == "P", F.lit(None)).otherwise(F.col("customer_id")).alias("buyer")))
    return J.not_in_vs_anti(m.customers.select("customer_id"), "customer_id", other, "buyer")


@register("range_join_promotion", "JN-14", oracle=f"""
SELECT o.o_orderkey AS order_id, CAST(o.o_orderdate AS DATE) AS order_day, p.promotion_id, p.promotion_name
FROM orders o LEFT JOIN {literals.promotions_sql("p")}
  ON CAST(o.o_orderdate AS DATE) BETWEEN p.start_date AND p.end_date
""")
def _jn14(t, m):
    o = m.orders.select("order_id", F.to_date("order_date").alias("order_day"))
    promos = literals.promotions(t.spark).select("promotion_id", "promotion_name", "start_date", "end_date")
    return J.range_attribute(o, "order_day", promos).select("order_id", "order_day", "promotion_id", "promotion_name")


@register("latest_snapshot_join", "JN-15", oracle="""
WITH latest AS (SELECT MAX(l_shipdate) AS d FROM lineitem)
SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_number, l.l_shipdate AS ship_date, l.l_quantity AS quantity
FROM lineitem l JOIN latest ON latest.d = l.l_shipdate
""")
def _jn15(t, m):
    return J.latest(m.items.select("order_id", "line_number", "ship_date", "quantity"), "ship_date")


@register("join_text_key", "JN-16", oracle="""
WITH f AS (SELECT lower(trim(p.p_name)) AS match_name, COUNT(*) AS fact_rows
           FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1),
     d AS (SELECT lower(trim(p_name)) AS match_name, COUNT(*) AS dim_matches FROM part GROUP BY 1)
SELECT f.match_name, f.fact_rows, COALESCE(d.dim_matches, 0) AS dim_matches,
       CASE WHEN COALESCE(d.dim_matches, 0) = 0 THEN 'missing' WHEN d.dim_matches = 1 THEN 'unique'
            ELSE 'ambiguous' END AS match_status
FROM f LEFT JOIN d USING (match_name)
""")
def _jn16(t, m):
    lines = m.items.groupBy("product_id").agg(F.count(F.lit(1)).alias("lines"))
    names = lines.join(m.products.select("product_id", "product_name"), "product_id")
    return J.join_by_name(names, "product_name", m.products, "product_name", rows="lines")


@register("normalize_fact", "JN-17", oracle="""
WITH f AS (SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, p.p_partkey, p.p_name, p.p_brand, p.p_type
           FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
     d AS (SELECT p_name, p_brand, p_type, MIN(p_partkey) AS attr_key FROM f GROUP BY p_name, p_brand, p_type)
SELECT f.l_orderkey AS order_id, f.l_linenumber AS line_number, d.attr_key, f.l_extendedprice AS unit_price
FROM f JOIN d USING (p_name, p_brand, p_type)
""")
def _jn17(t, m):
    fact = m.items.select("order_id", "line_number", "product_id", "unit_price")
    attrs = ["product_name", "category_name", "department"]
    _dim, slim = J.normalize(fact, "product_id", attrs, entities=m.products.select("product_id", *attrs))
    return slim.select("order_id", "line_number", "attr_key", "unit_price")


@register("join_cardinality_check", "JN-18", oracle="""
WITH f AS (SELECT p.p_name AS k, l.l_quantity AS q FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
     lk AS (SELECT k, COUNT(*) AS ln, SUM(q) AS ls FROM f GROUP BY k),
     rk AS (SELECT p_name AS k, COUNT(*) AS rn FROM part GROUP BY p_name),
     pk AS (SELECT lk.ln, lk.ls, COALESCE(rk.rn, 0) AS rn FROM lk LEFT JOIN rk USING (k))
SELECT CAST(SUM(ln) AS BIGINT) AS left_rows, CAST(SUM(ln * rn) AS BIGINT) AS joined_rows,
       COUNT(*) FILTER (WHERE rn > 1) AS keys_repeated_on_right,
       CAST(SUM(ls) AS BIGINT) AS left_measure, CAST(SUM(ls * rn) AS BIGINT) AS joined_measure
FROM pk
""")
def _jn18(t, m):
    per_product = m.items.groupBy("product_id").agg(F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("quantity"))
    left = per_product.join(m.products.select("product_id", "product_name"), "product_id")
    out = J.join_check(left, m.products.select("product_name"), "product_name", "quantity", rows="lines")
    return out.select("left_rows", "joined_rows", "keys_repeated_on_right",
                      F.col("left_measure").cast("bigint").alias("left_measure"),
                      F.col("joined_measure").cast("bigint").alias("joined_measure"))
