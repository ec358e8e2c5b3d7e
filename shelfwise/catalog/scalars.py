"""Registered projections, predicates and scalar functions.

Each is a projection or filter over a whole driver table, keyed by the
table's own key so the result can be compared row for row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.catalog.base import register
from shelfwise.catalog.sqlkit import REV, div_round, money
from shelfwise.functions import exprs as X
from shelfwise.functions.metrics import money as money_col
from shelfwise.functions.metrics import month_label, round_money, valid_item, weekday_name
from shelfwise.operators.params import run_sql

# ---------------------------------------------------------------- projections


@register("project_columns", "PRJ-01", oracle="""
SELECT o_orderkey AS order_id, o_orderdate AS order_date, o_orderpriority AS channel, o_orderstatus AS status
FROM orders
""")
def _prj01(t, m):
    return m.orders.select("order_id", "order_date", "channel", "status")


@register("computed_column", "PRJ-02", oracle=f"""
SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_quantity AS quantity,
       l_extendedprice AS unit_price, l_discount AS discount, CAST({REV} AS DOUBLE) AS gross_item_revenue
FROM lineitem l WHERE l_quantity > 0 AND l_extendedprice >= 0
""")
def _prj02(t, m):
    return (m.items.filter(valid_item())
            .select("order_id", "line_number", "quantity", "unit_price", "discount",
                    F.col("gross_revenue").cast("double").alias("gross_item_revenue")))


@register("case_band", "PRJ-03", oracle="""
SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_quantity AS quantity,
       CASE WHEN l_quantity >= 40 THEN 'large' WHEN l_quantity >= 20 THEN 'medium' ELSE 'small' END AS quantity_band
FROM lineitem
""")
def _prj03(t, m):
    return m.items.select("order_id", "line_number", "quantity",
                          X.band("quantity", [(40, "large"), (20, "medium")], "small").alias("quantity_band"))


# ---------------------------------------------------------------- filters


@register("filter_compare", "FLT-01", oracle="""
SELECT o_orderkey AS order_id, o_orderdate AS order_date, o_orderpriority AS channel
FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000
""")
def _flt01(t, m):
    return (m.orders.filter((F.col("status") == "F") & (F.col("order_total") > 100000))
            .select("order_id", "order_date", "channel"))


@register("filter_compound", "FLT-02", oracle="""
SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_quantity AS quantity, l_discount AS discount,
       l_returnflag AS return_flag
FROM lineitem WHERE (l_quantity >= 45 OR l_discount = 0) AND NOT (l_returnflag = 'R')
""")
def _flt02(t, m):
    return (m.items.filter(((F.col("quantity") >= 45) | (F.col("discount") == 0)) & ~(F.col("return_flag") == "R"))
            .select("order_id", "line_number", "quantity", "discount", "return_flag"))


@register("filter_in_list", "FLT-03", oracle="""
SELECT o_orderkey AS order_id, o_orderpriority AS channel FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def _flt03(t, m):
    return m.orders.filter(F.col("channel").isin("1-URGENT", "2-HIGH")).select("order_id", "channel")


@register("filter_between", "FLT-04", oracle="""
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_day FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-03-31'
""")
def _flt04(t, m):
    d = F.to_date("order_date")
    return (m.orders.filter(d.between(F.lit("1996-01-01").cast("date"), F.lit("1996-03-31").cast("date")))
            .select("order_id", d.alias("order_day")))


@register("filter_half_open", "FLT-05", oracle="""
SELECT o_orderkey AS order_id, o_orderdate AS order_date, o_orderpriority AS channel FROM orders
WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1996-04-01'
""")
def _flt05(t, m):
    return (m.orders.filter((F.col("status") == "F") & X.in_period("order_date", "1996-03-01", "1996-04-01"))
            .select("order_id", "order_date", "channel"))


@register("filter_like", "FLT-06", oracle="""
SELECT doc_id, n_chars, text LIKE '%@%.%' AS looks_like_email FROM documents
WHERE text LIKE '%@%.%' OR lang NOT LIKE 'e%'
""")
def _flt06(t, m):
    d = t.documents
    return (d.filter(F.col("text").like("%@%.%") | ~F.col("lang").like("e%"))
            .select("doc_id", "n_chars", F.col("text").like("%@%.%").alias("looks_like_email")))


@register("filter_null_or_blank", "FLT-07", oracle="""
SELECT c_custkey AS customer_id, c_mktsegment AS segment FROM customer
WHERE NULLIF(c_mktsegment, 'BUILDING') IS NULL OR TRIM(NULLIF(c_mktsegment, 'BUILDING')) = ''
   OR TRIM(COALESCE(NULLIF(c_mktsegment, 'MACHINERY'), '')) = ''
""")
def _flt07(t, m):
    seg = F.nullif(F.col("segment"), F.lit("BUILDING"))
    seg2 = F.nullif(F.col("segment"), F.lit("MACHINERY"))
    return (m.customers.filter(X.is_blank(seg) | (F.trim(F.coalesce(seg2, F.lit(""))) == ""))
            .select("customer_id", "segment"))


@register("filter_not_accepted", "FLT-08", oracle="""
SELECT o_orderkey AS order_id, o_orderpriority AS channel FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') OR o_orderpriority IS NULL
""")
def _flt08(t, m):
    return (m.orders.filter(X.not_accepted("channel", ["1-URGENT", "2-HIGH", "3-MEDIUM"]))
            .select("order_id", "channel"))


@register("filter_changed_values", "FLT-09", oracle="""
SELECT p_partkey AS product_id, p_name AS old_name, REPLACE(p_name, 'plate', 'dish') AS new_name FROM part
WHERE p_name <> REPLACE(p_name, 'plate', 'dish')
""")
def _flt09(t, m):
    new = F.replace(F.col("product_name"), F.lit("plate"), F.lit("dish"))
    return (m.products.select("product_id", F.col("product_name").alias("old_name"), new.alias("new_name"))
            .filter(X.changed("old_name", "new_name")))


@register("param_query", "FLT-10", oracle="""
SELECT o_orderkey AS order_id, o_orderdate AS order_date, o_totalprice AS order_total FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '1998-01-01'
""")
def _flt10(t, m):
    return run_sql(
        t.spark,
        "SELECT o_orderkey AS order_id, o_orderdate AS order_date, o_totalprice AS order_total FROM {orders} "
        "WHERE o_orderstatus = :status AND o_orderpriority = :channel AND o_orderdate >= :start",
        args={"status": "F", "channel": "1-URGENT", "start": "1998-01-01 00:00:00"},
        tables={"orders": t.orders}, order_by="order_date", allowed_order=("order_date", "order_id"))


# ---------------------------------------------------------------- scalar functions


@register("fn_trim", "FN-01", oracle="""
SELECT doc_id, CAST(LENGTH(text) AS INTEGER) AS text_chars, CAST(LENGTH(TRIM(text)) AS INTEGER) AS trimmed_chars,
       CAST(LENGTH(TRIM('  ' || lang || '  ')) AS INTEGER) AS padded_lang_chars FROM documents
""")
def _fn01(t, m):
    return t.documents.select("doc_id", F.length("text").alias("text_chars"),
                              F.length(F.trim("text")).alias("trimmed_chars"),
                              F.length(F.trim(F.concat(F.lit("  "), "lang", F.lit("  ")))).alias("padded_lang_chars"))


@register("fn_lower_upper", "FN-02", oracle="""
SELECT p_partkey AS product_id, LOWER(p_brand) AS brand_lower, UPPER(p_name) AS name_upper FROM part
""")
def _fn02(t, m):
    return t.part.select(F.col("p_partkey").alias("product_id"), F.lower("p_brand").alias("brand_lower"),
                         F.upper("p_name").alias("name_upper"))


@register("fn_concat", "FN-03", oracle="""
SELECT c_custkey AS customer_id, c_name || ' (' || c_mktsegment || ')' AS label,
       c_name || NULLIF(c_mktsegment, 'BUILDING') AS label_or_null FROM customer
""")
def _fn03(t, m):
    c = t.customer
    return c.select(F.col("c_custkey").alias("customer_id"),
                    F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(")")).alias("label"),
                    F.concat("c_name", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))).alias("label_or_null"))


@register("fn_concat_ws", "FN-04", oracle="""
SELECT c_custkey AS customer_id,
       CONCAT_WS(', ', c_name, NULLIF(c_mktsegment, 'BUILDING'), CAST(c_nationkey AS VARCHAR)) AS label FROM customer
""")
def _fn04(t, m):
    return t.customer.select(F.col("c_custkey").alias("customer_id"),
                             F.concat_ws(", ", "c_name", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")),
                                         F.col("c_nationkey").cast("string")).alias("label"))


@register("fn_left_substring", "FN-05", oracle="""
SELECT p_partkey AS product_id, UPPER(LEFT(p_name, 1)) || LOWER(SUBSTRING(p_name, 2)) AS display_name,
       LEFT(p_brand, 5) AS brand_prefix FROM part
""")
def _fn05(t, m):
    return t.part.select(F.col("p_partkey").alias("product_id"), X.first_upper("p_name").alias("display_name"),
                         F.left("p_brand", F.lit(5)).alias("brand_prefix"))


@register("fn_lpad", "FN-06", oracle="""
SELECT c_custkey AS customer_id, 'C' || LPAD(CAST(c_custkey AS VARCHAR), 6, '0') AS customer_code FROM customer
""")
def _fn06(t, m):
    return t.customer.select(F.col("c_custkey").alias("customer_id"),
                             F.concat(F.lit("C"), F.lpad(F.col("c_custkey").cast("string"), 6, "0"))
                             .alias("customer_code"))


@register("fn_replace", "FN-07", oracle="""
SELECT c_custkey AS customer_id, REPLACE(c_name, 'Customer#', 'CUST-') AS short_name FROM customer
""")
def _fn07(t, m):
    return t.customer.select(F.col("c_custkey").alias("customer_id"),
                             F.replace(F.col("c_name"), F.lit("Customer#"), F.lit("CUST-")).alias("short_name"))


@register("fn_date_parts", "FN-08", oracle="""
SELECT o_orderkey AS order_id, CAST(YEAR(o_orderdate) AS INTEGER) AS order_year,
       CAST(MONTH(o_orderdate) AS INTEGER) AS order_month, CAST(DAY(o_orderdate) AS INTEGER) AS order_day
FROM orders
""")
def _fn08(t, m):
    return m.orders.select("order_id", F.year("order_date").alias("order_year"),
                           F.month("order_date").alias("order_month"), F.dayofmonth("order_date").alias("order_day"))


@register("fn_to_date", "FN-09", oracle="""
SELECT event_id, CAST(ts AS DATE) AS event_date FROM events
""")
def _fn09(t, m):
    return t.events.select("event_id", F.to_date("ts").alias("event_date"))


@register("fn_month_label", "FN-10", oracle="""
SELECT o_orderkey AS order_id, strftime(o_orderdate, '%Y-%m') AS sales_month FROM orders
""")
def _fn10(t, m):
    return m.orders.select("order_id", month_label("order_date").alias("sales_month"))


@register("fn_weekday_name", "FN-11", oracle="""
SELECT event_id, dayname(ts) AS weekday_name FROM events
""")
def _fn11(t, m):
    return t.events.select("event_id", weekday_name("ts").alias("weekday_name"))


_SHIP = """
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey"""


def _shipments(t):
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


@register("fn_datediff", "FN-12", oracle=f"""
SELECT l_orderkey AS order_id, l_linenumber AS line_number,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days_to_ship {_SHIP}
""")
def _fn12(t, m):
    return _shipments(t).select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"),
                                F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).alias("days_to_ship"))


# Whole months between two midnights (T4): month count minus one when the
# end's day of month has not reached the start's.
_MONTHS = """((YEAR(l_shipdate) * 12 + MONTH(l_shipdate)) - (YEAR(o_orderdate) * 12 + MONTH(o_orderdate))
   - CASE WHEN (YEAR(l_shipdate) * 12 + MONTH(l_shipdate)) > (YEAR(o_orderdate) * 12 + MONTH(o_orderdate))
               AND DAY(l_shipdate) < DAY(o_orderdate) THEN 1
          WHEN (YEAR(l_shipdate) * 12 + MONTH(l_shipdate)) < (YEAR(o_orderdate) * 12 + MONTH(o_orderdate))
               AND DAY(l_shipdate) > DAY(o_orderdate) THEN -1 ELSE 0 END)"""


@register("fn_timestampdiff", "FN-13", oracle=f"""
SELECT l_orderkey AS order_id, l_linenumber AS line_number,
       CAST(date_diff('day', o_orderdate, l_shipdate) AS BIGINT) AS days_between,
       CAST({_MONTHS} AS BIGINT) AS months_between,
       CAST(TRUNC({_MONTHS} / 12) AS BIGINT) AS years_between {_SHIP}
""")
def _fn13(t, m):
    return _shipments(t).select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"),
                                X.timestampdiff("DAY", "o_orderdate", "l_shipdate").alias("days_between"),
                                X.timestampdiff("MONTH", "o_orderdate", "l_shipdate").alias("months_between"),
                                X.timestampdiff("YEAR", "o_orderdate", "l_shipdate").alias("years_between"))


@register("fn_date_sub", "FN-14", oracle="""
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) - 30 AS window_start FROM orders
""")
def _fn14(t, m):
    return m.orders.select("order_id", F.date_sub(F.to_date("order_date"), 30).alias("window_start"))


@register("fn_date_add", "FN-15", oracle="""
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) + 30 AS due_date,
       CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS next_month_date FROM orders
""")
def _fn15(t, m):
    d = F.to_date("order_date")
    return m.orders.select("order_id", F.date_add(d, 30).alias("due_date"), F.add_months(d, 1).alias("next_month_date"))


@register("fn_make_timestamp", "FN-16", oracle="""
SELECT o_orderkey AS order_id,
       make_timestamp(YEAR(o_orderdate), MONTH(o_orderdate), DAY(o_orderdate),
                      CAST(o_orderkey % 24 AS BIGINT), CAST(o_orderkey % 60 AS BIGINT), 0) AS order_at
FROM orders
""")
def _fn16(t, m):
    return m.orders.select("order_id", X.make_ts("order_date", (F.col("order_id") % 24).cast("int"),
                                                 (F.col("order_id") % 60).cast("int"), F.lit(0)).alias("order_at"))


AS_OF = "2002-01-01"


@register("fn_as_of_date", "FN-17", oracle=f"""
SELECT o_orderkey AS order_id, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS INTEGER)
       AS days_before_as_of FROM orders
""")
def _fn17(t, m):
    as_of = F.lit(AS_OF).cast("date")
    return m.orders.select("order_id", F.datediff(as_of, F.to_date("order_date")).alias("days_before_as_of"))


@register("fn_coalesce", "FN-18", oracle="""
SELECT c_custkey AS customer_id, COALESCE(NULLIF(c_mktsegment, 'BUILDING'), 'UNASSIGNED') AS segment FROM customer
""")
def _fn18(t, m):
    return m.customers.select("customer_id", F.coalesce(F.nullif(F.col("segment"), F.lit("BUILDING")),
                                                        F.lit("UNASSIGNED")).alias("segment"))


@register("fn_nullif", "FN-19", oracle="""
SELECT l_orderkey AS order_id, l_linenumber AS line_number, NULLIF(l_discount, 0) AS discount_or_null FROM lineitem
""")
def _fn19(t, m):
    return m.items.select("order_id", "line_number", F.nullif(F.col("discount"), F.lit(0.0)).alias("discount_or_null"))


@register("fn_round", "FN-20", oracle=f"""
SELECT l_orderkey AS order_id, l_linenumber AS line_number, {money(REV, 1)} AS revenue_1dp,
       {money(REV, 0)} AS revenue_0dp FROM lineitem l
""")
def _fn20(t, m):
    return m.items.select("order_id", "line_number", round_money("gross_revenue", 1).alias("revenue_1dp"),
                          round_money("gross_revenue", 0).alias("revenue_0dp"))


@register("fn_ceil_floor_mod", "FN-21", oracle="""
SELECT l_orderkey AS order_id, l_linenumber AS line_number, CAST(CEIL(l_quantity / 3) AS BIGINT) AS ceil_third,
       CAST(FLOOR(l_quantity / 3) AS BIGINT) AS floor_third, l_orderkey % 7 AS order_mod_7 FROM lineitem
""")
def _fn21(t, m):
    return m.items.select("order_id", "line_number", F.ceil(F.col("quantity") / 3).cast("bigint").alias("ceil_third"),
                          F.floor(F.col("quantity") / 3).cast("bigint").alias("floor_third"),
                          (F.col("order_id") % 7).alias("order_mod_7"))


@register("fn_greatest", "FN-22", oracle="""
SELECT l_orderkey AS order_id, l_linenumber AS line_number,
       CASE WHEN NULLIF(l_quantity, 50) IS NULL THEN NULL ELSE GREATEST(NULLIF(l_quantity, 50) - 25, 0) END
       AS units_over_25 FROM lineitem
""")
def _fn22(t, m):
    return m.items.select("order_id", "line_number",
                          X.greatest_strict(F.nullif(F.col("quantity"), F.lit(50.0)) - 25, F.lit(0.0))
                          .alias("units_over_25"))


@register("fn_arithmetic", "FN-23", oracle=f"""
SELECT l_orderkey AS order_id, l_linenumber AS line_number,
       CAST(l_quantity AS BIGINT) + 1 AS qty_plus_one, CAST(l_quantity AS BIGINT) - 1 AS qty_minus_one,
       CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * 2 AS DOUBLE) AS double_price,
       {div_round('CAST(l_extendedprice AS DECIMAL(18,4))', 'CAST(NULLIF(l_quantity, 0) AS BIGINT)', 2, 4)}
       AS price_per_unit
FROM lineitem
""")
def _fn23(t, m):
    q = F.col("quantity").cast("bigint")
    return m.items.select("order_id", "line_number", (q + 1).alias("qty_plus_one"), (q - 1).alias("qty_minus_one"),
                          (money_col("unit_price") * 2).cast("double").alias("double_price"),
                          round_money(money_col("unit_price") / F.nullif(q, F.lit(0))).alias("price_per_unit"))


@register("fn_case_if", "FN-24", oracle="""
SELECT l_orderkey AS order_id, l_linenumber AS line_number,
       CASE WHEN l_returnflag = 'R' THEN 'returned' WHEN l_linestatus = 'O' THEN 'open' ELSE 'closed' END AS line_state,
       CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'none' ELSE 'returned' END AS flag_label,
       IF(l_discount > 0.05, 'deep', 'shallow') AS discount_depth
FROM lineitem
""")
def _fn24(t, m):
    li = t.lineitem
    return li.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"),
        F.when(F.col("l_returnflag") == "R", "returned").when(F.col("l_linestatus") == "O", "open")
        .otherwise("closed").alias("line_state"),
        F.when(F.col("l_returnflag") == "A", "accepted").when(F.col("l_returnflag") == "N", "none")
        .otherwise("returned").alias("flag_label"),
        F.expr("if(l_discount > 0.05, 'deep', 'shallow')").alias("discount_depth"))
