"""DuckDB-dialect fragments shared by the oracle statements.

They restate the mapping of :mod:`shelfwise.sources.model` in SQL so the
oracle is computed independently of the Spark code.
"""

from __future__ import annotations

# Exact line revenue: price x (1 - discount) in DECIMAL.
REV = "CAST(l.l_extendedprice AS DECIMAL(18,4)) * (1 - CAST(l.l_discount AS DECIMAL(18,4)))"


def money(expr: str, digits: int = 2) -> str:
    """ROUND in DECIMAL once, then DOUBLE (same as ``round_money``)."""
    return f"CAST(ROUND({expr}, {digits}) AS DOUBLE)"


def div_round(num: str, den: str, digits: int, num_scale: int = 0) -> str:
    """HALF_UP(num / den, digits) computed on exact integers, as DOUBLE.

    ``num`` is exact with ``num_scale`` decimals (an integer when 0); ``den``
    is a non-negative integer; a zero denominator gives NULL (T5).
    DuckDB's own decimal division returns DOUBLE, whose rounding at exact
    half-cent ties differs from Spark's DECIMAL HALF_UP.
    """
    a = f"CAST(({num}) * {10 ** num_scale} AS HUGEINT)"
    shift = num_scale - digits
    if shift >= 0:
        d = f"(CAST({den} AS HUGEINT) * {10 ** shift})"
    else:
        a = f"({a} * {10 ** (-shift)})"
        d = f"CAST({den} AS HUGEINT)"
    return f"(CAST(SIGN({a}) * ((2 * ABS({a}) + {d}) // NULLIF(2 * {d}, 0)) AS DOUBLE) / {10 ** digits})"


# One row per valid line of a completed order with every dimension (RP-01).
VIEW = f"""
v AS (
  SELECT o.o_orderkey AS order_id,
         CAST(o.o_orderdate AS DATE) AS order_date,
         strftime(o.o_orderdate, '%Y-%m') AS sales_month,
         o.o_orderpriority AS channel,
         r.r_regionkey AS region_id, r.r_name AS region_name,
         s.s_suppkey AS store_id, s.s_name AS store_name, n.n_name AS store_city,
         o.o_custkey AS customer_id, c.c_name AS customer_name,
         p.p_partkey AS product_id, p.p_name AS product_name,
         p.p_brand AS category_name, p.p_type AS department,
         l.l_linenumber AS line_number, l.l_quantity AS quantity,
         l.l_extendedprice AS unit_price, l.l_discount AS discount, l.l_returnflag AS return_flag,
         {REV} AS gross_revenue
  FROM orders o
  JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON s.s_suppkey = l.l_suppkey
  LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN part p ON p.p_partkey = l.l_partkey
  WHERE o.o_orderstatus = 'F' AND l.l_quantity > 0 AND l.l_extendedprice >= 0
)"""
