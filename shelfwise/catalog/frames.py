"""Shared intermediate frames for registered queries, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from shelfwise.catalog.sqlkit import REV
from shelfwise.operators.sales import order_totals, sales_lines

CENTS = DecimalType(18, 2)


def daily_purchases(t) -> DataFrame:
    """One row per day of purchase events: purchases and exact revenue."""
    e = t.events.filter(F.col("event_type") == "purchase")
    return (e.groupBy(F.to_date("ts").alias("day"))
            .agg(F.count(F.lit(1)).alias("purchases"), F.sum(F.col("value").cast(CENTS)).alias("revenue")))


DAILY_SQL = """daily AS (
  SELECT CAST(ts AS DATE) AS day, COUNT(*) AS purchases, SUM(CAST(value AS DECIMAL(18,2))) AS revenue
  FROM events WHERE event_type = 'purchase' GROUP BY CAST(ts AS DATE))"""


def product_sales(m) -> DataFrame:
    """Completed valid sales per product (aggregated before any dimension join)."""
    return (sales_lines(m).groupBy("product_id")
            .agg(F.sum("quantity").cast("bigint").alias("units"), F.sum("gross_revenue").alias("revenue")))


PRODUCT_SALES_SQL = f"""ps AS (
  SELECT l.l_partkey AS product_id, CAST(SUM(l.l_quantity) AS BIGINT) AS units, SUM({REV}) AS revenue
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  WHERE o.o_orderstatus = 'F' AND l.l_quantity > 0 AND l.l_extendedprice >= 0
  GROUP BY l.l_partkey)"""


def store_month(m) -> DataFrame:
    """Completed valid revenue per store and month."""
    return order_totals(m, ["store_id", "sales_month"])


STORE_MONTH_SQL = f"""sm AS (
  SELECT l.l_suppkey AS store_id, strftime(o.o_orderdate, '%Y-%m') AS sales_month,
         COUNT(DISTINCT o.o_orderkey) AS completed_orders, CAST(SUM(l.l_quantity) AS BIGINT) AS units,
         SUM({REV}) AS revenue
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  WHERE o.o_orderstatus = 'F' AND l.l_quantity > 0 AND l.l_extendedprice >= 0
  GROUP BY 1, 2)"""


def customer_spend(m) -> DataFrame:
    """Completed order value per customer (exact)."""
    return (m.orders.filter(F.col("status") == m.completed).groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("order_count"),
                 F.sum(F.col("order_total").cast(DecimalType(18, 4))).alias("total_spend")))


CUSTOMER_SPEND_SQL = """cs AS (
  SELECT o_custkey AS customer_id, COUNT(*) AS order_count, SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS total_spend
  FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)"""
