"""Registered plan-evidence and layout jobs."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.catalog.base import register
from shelfwise.catalog.sqlkit import REV, VIEW, money
from shelfwise.functions.exprs import in_period
from shelfwise.functions.metrics import month_label, round_money
from shelfwise.operators import reports as rp
from shelfwise.operators.sales import sales_lines
from shelfwise.plans import evidence as P
from shelfwise.session import scratch_dir


@register("pf_sargable_rewrite", "PF-02", oracle="""
SELECT o_orderkey AS order_id, o_orderdate AS order_date FROM orders
WHERE o_orderstatus = 'F' AND YEAR(o_orderdate) = 1997
""")
def _pf02(t, m):
    """The half-open range form of ``YEAR(order_date) = 1997`` (both bounds reach the scan)."""
    return (m.orders.filter((F.col("status") == "F") & in_period("order_date", "1997-01-01", "1998-01-01"))
            .select("order_id", "order_date"))


_LAYOUT_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("order_date", T.TimestampNTZType()),
    T.StructField("customer_id", T.LongType()), T.StructField("order_day", T.DateType()), T.StructField("status", T.StringType()),
    T.StructField("order_month", T.StringType()),
])


@register("pf_layout_for_filter", "PF-03", oracle="""
SELECT o_orderkey AS order_id, o_orderdate AS order_date, o_custkey AS customer_id FROM orders
WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1996-04-01'
""")
def _pf03(t, m):
    """Orders written partitioned by (status, month) and sorted by day, then filtered; the day skips row groups, a timestamp can't."""
    path = scratch_dir(t.spark, "orders_by_status_month")
    src = m.orders.select("order_id", "order_date", "customer_id", "status", F.to_date("order_date").alias("order_day"),
                          month_label("order_date").alias("order_month"))
    P.write_layout(src, path, ["status", "order_month"], ["order_day", "customer_id"])
    back = P.read_layout(t.spark, path, _LAYOUT_SCHEMA)
    days = (F.col("order_day") >= F.lit(date(1996, 3, 1))) & (F.col("order_day") < F.lit(date(1996, 4, 1)))
    return (back.filter((F.col("status") == "F") & (F.col("order_month") == "1996-03") & days)
            .select("order_id", "order_date", "customer_id"))


@register("pf_column_pruning", "PF-04", oracle="""
SELECT o_orderkey AS order_id, o_orderpriority AS channel FROM orders WHERE o_orderstatus = 'P'
""")
def _pf04(t, m):
    """A two-column projection: the scan's ReadSchema holds only the columns used."""
    return m.orders.filter(F.col("status") == "P").select("order_id", "channel")


@register("pf_join_layout", "PF-05", oracle=f"""
SELECT o.o_orderkey AS order_id, {money(f'SUM({REV})')} AS revenue
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderstatus = 'F'
GROUP BY o.o_orderkey
""")
def _pf05(t, m):
    """Orders and lines bucketed by order key: the join and the aggregate need no exchange."""
    n = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    names = [f"shelfwise_{x}_{uuid.uuid4().hex[:12]}" for x in ("orders", "items")]
    o = P.write_bucketed(m.orders.select("order_id", "status"), names[0], scratch_dir(t.spark, "orders_bucketed"), n, "order_id")
    i = P.write_bucketed(m.items.select("order_id", "gross_revenue"), names[1], scratch_dir(t.spark, "items_bucketed"), n, "order_id")
    j = i.join(o.filter(F.col("status") == "F"), "order_id")
    out = j.groupBy("order_id").agg(round_money(F.sum("gross_revenue")).alias("revenue"))
    for table in names:  # the result still reads their files, in the scratch folder; the catalog keeps nothing
        P.forget_bucketed(t.spark, table)
    return out


@register("pf_same_result", "PF-06", oracle=f"""
WITH {VIEW},
per_order AS (SELECT order_id, sales_month, SUM(gross_revenue) AS r FROM v GROUP BY order_id, sales_month),
a AS (SELECT sales_month, COUNT(*) AS n, ROUND(SUM(r), 2) AS gross FROM per_order GROUP BY sales_month),
b AS (SELECT sales_month, COUNT(DISTINCT order_id) AS n, ROUND(SUM(gross_revenue), 2) AS gross FROM v GROUP BY sales_month),
d AS (SELECT (SELECT COUNT(*) FROM a) AS a_rows, (SELECT COUNT(*) FROM b) AS b_rows,
             (SELECT COUNT(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS only_in_a,
             (SELECT COUNT(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS only_in_b)
SELECT a_rows, b_rows, only_in_a, only_in_b, only_in_a = 0 AND only_in_b = 0 AS same_rows FROM d
""")
def _pf06(t, m):
    """The pre-aggregated monthly KPI plan against the plain view aggregate: identical rows."""
    a = rp.monthly_kpis(m).select("sales_month", "completed_orders", "gross_revenue")
    v = sales_lines(m)
    b = v.groupBy("sales_month").agg(F.count_distinct("order_id").alias("completed_orders"),
                                     round_money(F.sum("gross_revenue")).alias("gross_revenue"))
    return P.same_rows(a, b)
