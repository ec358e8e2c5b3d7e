"""Registered data-quality jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.catalog.base import register
from shelfwise.catalog.sqlkit import REV, VIEW, div_round, money
from shelfwise.functions import metrics as B
from shelfwise.operators import quality as Q
from shelfwise.operators import sales
from shelfwise.operators.aggs import variants
from shelfwise.session import scratch_dir


@register("dq_reconcile", "DQ-27", oracle=f"""
WITH {VIEW},
a AS (SELECT COUNT(*) AS view_rows, SUM(gross_revenue) AS va FROM v),
b AS (SELECT COUNT(*) AS source_rows, SUM({REV}) AS sa
      FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
      WHERE o.o_orderstatus = 'F' AND l.l_quantity > 0 AND l.l_extendedprice >= 0)
SELECT view_rows, source_rows, {money('va')} AS view_gross_revenue, {money('sa')} AS source_gross_revenue,
       view_rows - source_rows AS row_difference,
       {money('COALESCE(va, 0) - COALESCE(sa, 0)')} AS revenue_difference
FROM a CROSS JOIN b
""")
def _dq27(t, m):
    return sales.reconcile(sales.valid_sales_view(m), sales.source_sales(m))


@register("dq_locate_differences", "DQ-27", oracle="""
SELECT o_orderkey AS order_id, 1 AS left_rows, CASE WHEN o_orderstatus = 'P' AND o_orderkey % 4 = 0 THEN 0 ELSE 1 END AS right_rows,
       CASE WHEN o_orderstatus = 'P' AND o_orderkey % 4 = 0 THEN 'only_left' ELSE 'changed' END AS difference
FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 4 < 2
""")
def _dq27_where(t, m):
    """Orders against a copy in which some pending ones were lost and others relabelled: the keys that differ."""
    o = m.orders.select("order_id", "customer_id", "status")
    pending = F.coalesce(F.col("status") == "P", F.lit(False))
    copy = o.filter(~(pending & (F.col("order_id") % 4 == 0))).withColumn("status", F.when(pending & (F.col("order_id") % 4 == 1), "F").otherwise(F.col("status")))
    return sales.locate_differences(o, copy, "order_id", ["customer_id", "status"])


# ------------------------------------------------------------------ profiles and tests


AS_OF = "2002-01-01"
CHECKED_AT = "2002-01-01 09:00:00"


def _orders_profiled(t):
    o = t.orders
    return o.select("o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate",
                    F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status_not_pending"))


@register("dq_profile_table", "DQ-01", oracle="""
WITH o AS (SELECT o_custkey, o_orderstatus, o_orderpriority, o_orderdate, NULLIF(o_orderstatus, 'P') AS status_not_pending
           FROM orders)
SELECT 'o_custkey' AS column_name, COUNT(*) AS row_count, COUNT(o_custkey) AS present,
       COUNT(*) - COUNT(o_custkey) AS missing, COUNT(DISTINCT o_custkey) AS distinct_values FROM o
UNION ALL SELECT 'o_orderstatus', COUNT(*), COUNT(o_orderstatus), COUNT(*) - COUNT(o_orderstatus),
       COUNT(DISTINCT o_orderstatus) FROM o
UNION ALL SELECT 'o_orderpriority', COUNT(*), COUNT(o_orderpriority), COUNT(*) - COUNT(o_orderpriority),
       COUNT(DISTINCT o_orderpriority) FROM o
UNION ALL SELECT 'o_orderdate', COUNT(*), COUNT(o_orderdate), COUNT(*) - COUNT(o_orderdate),
       COUNT(DISTINCT o_orderdate) FROM o
UNION ALL SELECT 'status_not_pending', COUNT(*), COUNT(status_not_pending), COUNT(*) - COUNT(status_not_pending),
       COUNT(DISTINCT status_not_pending) FROM o
""")
def _dq01(t, m):
    return Q.profile(_orders_profiled(t), ["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate",
                                          "status_not_pending"])


@register("dq_profile_metrics", "DQ-02", oracle="""
SELECT COUNT(*) AS item_rows,
       COUNT(*) FILTER (WHERE l_quantity IS NULL) AS null_quantity_rows,
       COUNT(*) FILTER (WHERE l_quantity <= 0) AS non_positive_quantity_rows,
       COUNT(*) FILTER (WHERE l_extendedprice IS NULL) AS null_price_rows,
       COUNT(*) FILTER (WHERE l_extendedprice < 0) AS negative_price_rows,
       COUNT(*) FILTER (WHERE l_discount < 0) AS negative_discount_rows,
       COUNT(*) FILTER (WHERE l_discount = 0) AS zero_discount_rows
FROM lineitem
""")
def _dq02(t, m):
    q, p, d = F.col("quantity"), F.col("unit_price"), F.col("discount")
    return Q.profile_counts(m.items, {
        "null_quantity_rows": q.isNull(), "non_positive_quantity_rows": q <= 0, "null_price_rows": p.isNull(),
        "negative_price_rows": p < 0, "negative_discount_rows": d < 0, "zero_discount_rows": d == 0}, "item_rows")


@register("dq_profile_customers", "DQ-03", oracle="""
SELECT COUNT(*) AS customer_rows,
       COUNT(*) FILTER (WHERE c.c_acctbal < 0) AS negative_balance_rows,
       COUNT(*) FILTER (WHERE c.c_mktsegment IS NULL OR TRIM(c.c_mktsegment) = '') AS missing_segment_rows,
       COUNT(*) FILTER (WHERE n.n_name IS NULL OR TRIM(n.n_name) = '') AS blank_city_rows,
       COUNT(*) FILTER (WHERE c.c_name IS NOT NULL AND c.c_name NOT LIKE 'Customer#%') AS suspicious_name_rows
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
""")
def _dq03(t, m):
    c = m.customers
    return Q.profile_counts(c, {
        "negative_balance_rows": F.col("balance") < 0,
        "missing_segment_rows": F.col("segment").isNull() | (F.trim("segment") == ""),
        "blank_city_rows": F.col("city").isNull() | (F.trim("city") == ""),
        "suspicious_name_rows": F.col("customer_name").isNotNull() & ~F.col("customer_name").like("Customer#%"),
    }, "customer_rows")


@register("dq_profile_products", "DQ-04", oracle="""
SELECT COUNT(*) AS products_total,
       COUNT(*) FILTER (WHERE p_brand IS NULL OR TRIM(p_brand) = '') AS missing_categories,
       COUNT(*) FILTER (WHERE p_retailprice IS NULL OR p_retailprice < 0) AS invalid_current_prices,
       COUNT(*) FILTER (WHERE p_retailprice > 1500) AS premium_price_rows
FROM part
""")
def _dq04(t, m):
    p = m.products
    return Q.profile_counts(p, {
        "missing_categories": F.col("category_name").isNull() | (F.trim("category_name") == ""),
        "invalid_current_prices": F.col("list_price").isNull() | (F.col("list_price") < 0),
        "premium_price_rows": F.col("list_price") > 1500}, "products_total")


@register("dq_problem_rows", "DQ-05", oracle="""
SELECT c_custkey AS customer_id, c_name AS customer_name, c_acctbal AS balance FROM customer
WHERE c_acctbal IS NULL OR c_acctbal < 0
""")
def _dq05(t, m):
    c = m.customers
    return c.filter(F.col("balance").isNull() | (F.col("balance") < 0)).select("customer_id", "customer_name", "balance")


@register("dq_category_counts", "DQ-06", oracle="""
SELECT o_orderpriority AS value, COUNT(*) AS row_count FROM orders GROUP BY o_orderpriority
""")
def _dq06(t, m):
    return Q.value_counts(m.orders, "channel")


@register("dq_duplicate_values", "DQ-07", oracle="""
SELECT MIN(doc_id) AS first_doc_id, COUNT(*) AS duplicate_count, MAX(n_chars) AS n_chars
FROM documents GROUP BY TRIM(text) HAVING COUNT(*) > 1
""")
def _dq07(t, m):
    return Q.exact_duplicates(t.documents, F.trim("text"),
                              [F.min("doc_id").alias("first_doc_id"), F.max("n_chars").alias("n_chars")])


def _words(t):
    d = t.documents.select(F.explode(F.split(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")), " ")).alias("word"))
    return d.filter(F.col("word") != "")


@register("dq_name_variants", "DQ-08", oracle="""
WITH w AS (SELECT unnest(string_split(replace(text, chr(10), ' '), ' ')) AS word FROM documents)
SELECT lower(trim(word)) AS normalized_name, COUNT(*) AS item_rows, COUNT(DISTINCT word) AS raw_variants
FROM w WHERE word <> '' GROUP BY lower(trim(word)) HAVING COUNT(DISTINCT word) > 1
""")
def _dq08(t, m):
    return variants(_words(t), "word")


@register("dq_row_validation", "DQ-09", oracle="""
SELECT c_custkey AS customer_id, c_acctbal AS balance,
       CASE WHEN c_acctbal IS NULL THEN 'Missing balance' WHEN c_acctbal < 0 THEN 'Negative balance'
            WHEN c_acctbal < 100 THEN 'Low balance' ELSE 'Valid' END AS validation_result
FROM customer WHERE c_acctbal IS NULL OR c_acctbal < 100
""")
def _dq09(t, m):
    b = F.col("balance")
    c = m.customers.filter(b.isNull() | (b < 100))
    return c.select("customer_id", "balance", Q.label_failures(
        [("Missing balance", b.isNull()), ("Negative balance", b < 0), ("Low balance", b < 100)]).alias("validation_result"))


@register("dq_flag_valid_rows", "DQ-10", oracle="""
SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_number, l.l_partkey AS product_id,
       TRIM(p.p_name) AS clean_product_name, l.l_quantity AS quantity, l.l_extendedprice AS unit_price,
       CASE WHEN l.l_quantity IS NULL OR l.l_quantity <= 0 OR l.l_extendedprice IS NULL OR l.l_extendedprice < 0
                 OR l.l_discount > 0.09 THEN 0 ELSE 1 END AS valid_metric_row
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
""")
def _dq10(t, m):
    it = m.items.join(m.products.select("product_id", "product_name"), "product_id")
    ok = B.valid_item() & (F.col("discount") <= 0.09)
    return it.select("order_id", "line_number", "product_id", F.trim("product_name").alias("clean_product_name"),
                     "quantity", "unit_price", Q.flag(ok).alias("valid_metric_row"))


@register("dq_email_quality", "DQ-11", oracle="""
SELECT doc_id, CASE WHEN text IS NULL OR TRIM(text) = '' THEN 'missing email'
                    WHEN text NOT LIKE '%@%.%' THEN 'invalid email' ELSE 'usable email' END AS email_quality
FROM documents
""")
def _dq11(t, m):
    return t.documents.select("doc_id", Q.email_quality("text").alias("email_quality"))


# The accepted market segments of the driver customers.
ACCEPTED_SEGMENTS = ("building", "furniture", "machinery", "household")
_SEG_SQL = ", ".join(f"'{s}'" for s in ACCEPTED_SEGMENTS)
_CAP = "UPPER(LEFT(TRIM(c_mktsegment), 1)) || LOWER(SUBSTRING(TRIM(c_mktsegment), 2))"
_SEG_FIX = f"CASE WHEN LOWER(TRIM(c_mktsegment)) IN ({_SEG_SQL}) THEN {_CAP} ELSE NULL END"


def _segment_fix():
    return B.normalize_tier("segment", accepted=ACCEPTED_SEGMENTS)


@register("dq_normalize_tier", "DQ-12", oracle=f"""
SELECT c_custkey AS customer_id, c_mktsegment AS raw_segment, {_SEG_FIX} AS staging_segment,
       COALESCE({_SEG_FIX}, 'Unknown') AS report_segment FROM customer
""")
def _dq12(t, m):
    return m.customers.select("customer_id", F.col("segment").alias("raw_segment"), _segment_fix().alias("staging_segment"),
                              B.normalize_tier("segment", "Unknown", ACCEPTED_SEGMENTS).alias("report_segment"))


# Synonyms of part types mapped to canonical department groups.
TYPE_GROUPS = {"Value": ("economy", "promo"), "Core": ("standard", "medium", "small")}


@register("dq_map_synonyms", "DQ-13", oracle="""
SELECT p_partkey AS product_id, p_type AS department,
       CASE WHEN LOWER(TRIM(p_type)) IN ('economy', 'promo') THEN 'Value'
            WHEN LOWER(TRIM(p_type)) IN ('standard', 'medium', 'small') THEN 'Core'
            ELSE TRIM(p_type) END AS department_group
FROM part
""")
def _dq13(t, m):
    return m.products.select("product_id", "department", Q.map_labels("department", TYPE_GROUPS).alias("department_group"))


def _customer_rules():
    return {"customer_name": F.nullif(F.trim("customer_name"), F.lit("")), "segment": _segment_fix()}


_CUST_FIXED = f"""SELECT c_custkey AS customer_id, NULLIF(TRIM(c_name), '') AS customer_name, {_SEG_FIX} AS segment
FROM customer"""


@register("dq_preview_corrections", "DQ-14", oracle=f"""
SELECT c_custkey AS customer_id, c_name AS old_customer_name, NULLIF(TRIM(c_name), '') AS corrected_customer_name,
       c_mktsegment AS old_segment, {_SEG_FIX} AS corrected_segment
FROM customer
WHERE c_name <> NULLIF(TRIM(c_name), '') OR c_mktsegment <> {_SEG_FIX} OR c_name IS NULL OR c_mktsegment IS NULL
""")
def _dq14(t, m):
    return Q.preview(m.customers, ["customer_id"], _customer_rules())


@register("dq_apply_corrections", "DQ-15", oracle=_CUST_FIXED)
def _dq15(t, m):
    return Q.correct(m.customers, _customer_rules()).select("customer_id", "customer_name", "segment")


def _after_checks():
    seg = F.col("segment")
    return {"segment_issues_after": seg.isNull(),
            "unexpected_segment_rows": ~seg.isin([s.capitalize() for s in ACCEPTED_SEGMENTS]),
            "name_issues_after": F.col("customer_name").isNull() | (F.col("customer_name") == "")}


@register("dq_validate_after", "DQ-16", oracle=f"""
WITH s AS ({_CUST_FIXED})
SELECT COUNT(*) AS customer_rows,
       COUNT(*) FILTER (WHERE segment IS NULL) AS segment_issues_after,
       COUNT(*) FILTER (WHERE segment NOT IN ('Building', 'Furniture', 'Machinery', 'Household')) AS unexpected_segment_rows,
       COUNT(*) FILTER (WHERE customer_name IS NULL OR customer_name = '') AS name_issues_after
FROM s
""")
def _dq16(t, m):
    staged = Q.correct(m.customers, _customer_rules())
    return Q.profile_counts(staged, _after_checks(), "customer_rows")


@register("dq_write_audit_publish", "DQ-17", oracle=_CUST_FIXED)
def _dq17(t, m):
    # segments outside the label map become NULL, which the job states as allowed instead of leaving the check out
    src = m.customers.select("customer_id", "customer_name", "segment")
    return Q.write_audit_publish(t.spark, src, _customer_rules(), _after_checks(),
                                 scratch_dir(t.spark, "customers_staging"), scratch_dir(t.spark, "customers_clean"),
                                 max_failures={"segment_issues_after": None})


@register("test_not_null", "DQ-18", oracle="""
SELECT 'o_custkey not null' AS test_name, COUNT(*) AS failures FROM orders WHERE o_custkey IS NULL
""")
def _dq18(t, m):
    return Q.test_not_null(t.orders, "o_custkey")


@register("test_unique", "DQ-19", oracle="""
SELECT 'l_orderkey, l_linenumber unique' AS test_name, COUNT(*) AS failures FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1) d
""")
def _dq19(t, m):
    return Q.test_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@register("test_accepted_values", "DQ-20", oracle="""
SELECT 'o_orderstatus accepted values' AS test_name, COUNT(*) AS failures FROM orders
WHERE o_orderstatus NOT IN ('F', 'O') OR o_orderstatus IS NULL
""")
def _dq20(t, m):
    return Q.test_accepted(t.orders, "o_orderstatus", ["F", "O"])


_RELATIONS = (("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
              ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("orders", "o_custkey", "customer", "c_custkey"),
              ("customer", "c_nationkey", "nation", "n_nationkey"), ("labels", "doc_id", "documents", "doc_id"),
              ("orders", "o_orderkey", "lineitem", "l_orderkey"))


def _rel_sql(c, ck, p, pk):
    return (f"SELECT '{c}.{ck} -> {p}.{pk}' AS test_name, COUNT(*) AS failures FROM {c} x "
            f"WHERE x.{ck} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{pk} = x.{ck})")


@register("test_relationships", "DQ-21", oracle="\nUNION ALL\n".join(_rel_sql(*r) for r in _RELATIONS))
def _dq21(t, m):
    return Q.quality_report([Q.test_relationship(t.table(c), ck, t.table(p), pk, f"{c}.{ck} -> {p}.{pk}")
                             for c, ck, p, pk in _RELATIONS])


@register("test_range", "DQ-22", oracle="""
SELECT 'l_discount between 0 and 0.08' AS test_name, COUNT(*) AS failures FROM lineitem
WHERE NOT COALESCE(l_discount BETWEEN 0 AND 0.08, FALSE)
UNION ALL
SELECT 'c_acctbal between 0 and 9000', COUNT(*) FROM customer WHERE NOT COALESCE(c_acctbal BETWEEN 0 AND 9000, FALSE)
""")
def _dq22(t, m):
    return Q.quality_report([Q.test_range(t.lineitem, "l_discount", 0, 0.08),
                             Q.test_range(t.customer, "c_acctbal", 0, 9000)])


@register("dq_quality_report", "DQ-23", oracle="""
SELECT 'o_custkey not null' AS test_name, COUNT(*) AS failures FROM orders WHERE o_custkey IS NULL
UNION ALL SELECT 'l_orderkey, l_linenumber unique', COUNT(*) FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1) d
UNION ALL SELECT 'o_orderstatus accepted values', COUNT(*) FROM orders
  WHERE o_orderstatus NOT IN ('F', 'O') OR o_orderstatus IS NULL
UNION ALL SELECT 'orders.o_custkey -> customer.c_custkey', COUNT(*) FROM orders x
  WHERE x.o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer y WHERE y.c_custkey = x.o_custkey)
UNION ALL SELECT 'c_acctbal between 0 and 9000', COUNT(*) FROM customer
  WHERE NOT COALESCE(c_acctbal BETWEEN 0 AND 9000, FALSE)
""")
def _dq23(t, m):
    return Q.quality_report([
        Q.test_not_null(t.orders, "o_custkey"), Q.test_unique(t.lineitem, ["l_orderkey", "l_linenumber"]),
        Q.test_accepted(t.orders, "o_orderstatus", ["F", "O"]),
        Q.test_relationship(t.orders, "o_custkey", t.customer, "c_custkey", "orders.o_custkey -> customer.c_custkey"),
        Q.test_range(t.customer, "c_acctbal", 0, 9000)])


@register("dq_dedup_candidates", "DQ-24", oracle="""
WITH r AS (SELECT p_partkey AS product_id, LOWER(TRIM(p_name)) AS normalized_key,
                  ROW_NUMBER() OVER (PARTITION BY LOWER(TRIM(p_name)) ORDER BY p_partkey) AS duplicate_rank
           FROM part)
SELECT product_id, normalized_key, CAST(duplicate_rank AS BIGINT) AS duplicate_rank FROM r WHERE duplicate_rank > 1
""")
def _dq24(t, m):
    p = m.products.select("product_id", "product_name")
    return Q.dedup_candidates(p, F.lower(F.trim("product_name")), ["product_id"]).select(
        "product_id", "normalized_key", "duplicate_rank")


@register("dq_dedup_survivors", "DQ-25", oracle="""
WITH r AS (SELECT p_partkey AS product_id, LOWER(TRIM(p_name)) AS normalized_key, p_brand AS category_name,
                  ROW_NUMBER() OVER (PARTITION BY LOWER(TRIM(p_name)) ORDER BY p_partkey) AS rn FROM part)
SELECT normalized_key, product_id, category_name FROM r WHERE rn = 1
""")
def _dq25(t, m):
    p = m.products.select("product_id", "category_name", "product_name")
    return Q.dedup(p, F.lower(F.trim("product_name")), "product_id").select("normalized_key", "product_id",
                                                                            "category_name")


def _log_rows(t, m):
    return Q.quality_report([
        Q.log_rule(m.customers, "customer", "negative balance", F.col("balance") < 0, "flagged, kept in raw",
                   CHECKED_AT),
        Q.log_rule(m.orders, "orders", "non-completed status", F.col("status") != m.completed,
                   "excluded from sales view", CHECKED_AT),
        Q.log_rule(m.items, "lineitem", "invalid metric row", ~B.holds(B.valid_item()), "excluded from sales view", CHECKED_AT),
    ])


_LOG_SQL = f"""
SELECT 'customer' AS table_name, 'negative balance' AS rule_name, COUNT(*) FILTER (WHERE c_acctbal < 0) AS issue_count_before,
       'flagged, kept in raw' AS action_taken, TIMESTAMP '{CHECKED_AT}' AS checked_at FROM customer
UNION ALL SELECT 'orders', 'non-completed status', COUNT(*) FILTER (WHERE o_orderstatus <> 'F'), 'excluded from sales view',
       TIMESTAMP '{CHECKED_AT}' FROM orders
UNION ALL SELECT 'lineitem', 'invalid metric row',
       COUNT(*) FILTER (WHERE NOT COALESCE(l_quantity > 0 AND l_extendedprice >= 0, FALSE)), 'excluded from sales view',
       TIMESTAMP '{CHECKED_AT}' FROM lineitem
"""


@register("dq_cleaning_log", "DQ-26", oracle=_LOG_SQL)
def _dq26(t, m):
    return _log_rows(t, m)


@register("dq_freshness", "DQ-28", oracle=f"""
SELECT MAX(CAST(o_orderdate AS DATE)) AS latest_date,
       CAST(date_diff('day', MAX(CAST(o_orderdate AS DATE)), DATE '{AS_OF}') AS INTEGER) AS days_since_latest
FROM orders
""")
def _dq28(t, m):
    return Q.freshness(m.orders, "order_date", AS_OF)


@register("dq_distribution", "DQ-29", oracle=f"""
SELECT p_type AS department, COUNT(*) AS row_count, MIN(p_retailprice) AS min_value, MAX(p_retailprice) AS max_value,
       {div_round('SUM(CAST(p_retailprice AS DECIMAL(18,4)))', 'COUNT(*)', 3, 4)} AS avg_value
FROM part GROUP BY p_type
""")
def _dq29(t, m):
    return Q.distribution(m.products, "department", "list_price")
