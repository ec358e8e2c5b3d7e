"""Registered sources, sinks and table management."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.catalog.base import register
from shelfwise.catalog.quality import _LOG_SQL, CHECKED_AT, _log_rows
from shelfwise.catalog.sqlkit import VIEW, money
from shelfwise.operators import reports as rp
from shelfwise.operators.quality import map_labels
from shelfwise.session import scratch_dir
from shelfwise.sources import driver as D
from shelfwise.sources import layers as L
from shelfwise.sources import literals



@register("scan_tables", "SRC-01", oracle="\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in D.TABLE_NAMES))
def _src01(t, m):
    return D.scan_tables(t)


def _schema_sql() -> str:
    parts = []
    for name, schema in D.SCHEMAS.items():
        for f in schema.fields:
            parts.append(f"SELECT '{name}' AS table_name, '{f.name}' AS column_name, "
                         f"(SELECT typeof({f.name}) FROM {name} LIMIT 1) AS data_type, "
                         f"COUNT(*) - COUNT({f.name}) AS null_count FROM {name}")
    return "\nUNION ALL\n".join(parts)


@register("declared_schema", "SRC-02", oracle=_schema_sql())
def _src02(t, m):
    """Every declared column with its SQL type and NULL count, read with the declared schema (one pass per table)."""
    out = None
    for name in D.SCHEMAS:
        d = L.describe_with_rows(t.table(name)).select(
            F.lit(name).alias("table_name"), "column_name", "data_type",
            (F.col("row_count") - F.col("non_null_count")).alias("null_count"))
        out = d if out is None else out.unionByName(d)
    return out


@register("literal_rows", "SRC-03", oracle=f"""
SELECT s.status_label, COUNT(o.o_orderkey) AS order_count
FROM {literals.status_labels_sql("s")} LEFT JOIN orders o ON o.o_orderstatus = s.status_code
GROUP BY s.status_label
""")
def _src03(t, m):
    """Orders per status label, the labels being an inline VALUES relation (broadcast: fixed size)."""
    labels = literals.status_labels(t.spark)
    counts = m.orders.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    j = F.broadcast(labels).join(counts, labels.status_code == counts.status, "left")
    return j.select("status_label", F.coalesce(F.col("n"), F.lit(0)).alias("order_count"))


@register("staging_copy", "SRC-05", oracle="SELECT * FROM customer")
def _src05(t, m):
    return L.stage(t.customer, scratch_dir(t.spark, "customer_staging"))


_GROUPS = {"Value": ("economy", "promo"), "Core": ("standard", "medium", "small")}


@register("clean_layer", "SRC-06", oracle="""
SELECT p_partkey AS product_id, TRIM(p_name) AS product_name,
       CASE WHEN LOWER(TRIM(p_type)) IN ('economy', 'promo') THEN 'Value'
            WHEN LOWER(TRIM(p_type)) IN ('standard', 'medium', 'small') THEN 'Core'
            ELSE TRIM(p_type) END AS department
FROM part
""")
def _src06(t, m):
    p = m.products.select("product_id", "product_name", "department")
    rules = {"product_name": F.trim("product_name"), "department": map_labels("department", _GROUPS)}
    return L.build_clean(p, rules, scratch_dir(t.spark, "products_clean"))


@register("append_log", "SRC-07", oracle=_LOG_SQL)
def _src07(t, m):
    """Cleaning-log rows appended one rule at a time (INSERT ... SELECT), a run repeated, then read back."""
    path = scratch_dir(t.spark, "cleaning_log")
    rows = _log_rows(t, m)
    for rule in ("negative balance", "non-completed status", "invalid metric row"):
        for _ in range(2):  # the repeated run adds nothing
            L.append(rows.filter(F.col("rule_name") == rule), path, run_id=f"{CHECKED_AT} {rule}")
    return L.read_table(t.spark, path, rows.schema)


@register("reset_overwrite", "SRC-08", oracle=f"""
WITH {VIEW}
SELECT sales_month, COUNT(DISTINCT order_id) AS completed_orders, CAST(SUM(quantity) AS BIGINT) AS units_sold,
       {money('SUM(gross_revenue)')} AS gross_revenue
FROM v GROUP BY sales_month
""")
def _src08(t, m):
    """Publishing twice to one path leaves one copy (DROP IF EXISTS + CREATE)."""
    path = scratch_dir(t.spark, "monthly_kpis")
    k = rp.monthly_kpis(m).select("sales_month", "completed_orders", "units_sold", "gross_revenue")
    L.publish(k, path)
    return L.publish(k, path)


@register("describe_table", "SRC-09", oracle="""
SELECT 'o_orderkey' AS column_name, 'BIGINT' AS data_type, TRUE AS nullable, COUNT(o_orderkey) AS non_null_count FROM orders
UNION ALL SELECT 'o_custkey', 'BIGINT', TRUE, COUNT(o_custkey) FROM orders
UNION ALL SELECT 'o_orderstatus', 'VARCHAR', TRUE, COUNT(o_orderstatus) FROM orders
UNION ALL SELECT 'o_totalprice', 'DOUBLE', TRUE, COUNT(o_totalprice) FROM orders
UNION ALL SELECT 'o_orderdate', 'TIMESTAMP', TRUE, COUNT(o_orderdate) FROM orders
UNION ALL SELECT 'o_orderpriority', 'VARCHAR', TRUE, COUNT(o_orderpriority) FROM orders
""")
def _src09(t, m):
    return L.describe(t.orders)


@register("export_result", "SRC-10", oracle="""
SELECT 'status' AS dimension, o_orderstatus AS value, COUNT(*) AS order_count FROM orders GROUP BY o_orderstatus
UNION ALL
SELECT 'channel', o_orderpriority, COUNT(*) FROM orders GROUP BY o_orderpriority
""")
def _src10(t, m):
    return L.export(rp.order_population(m), scratch_dir(t.spark, "order_population_csv"), "csv")
