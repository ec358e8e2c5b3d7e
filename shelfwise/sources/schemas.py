"""Declared schemas of the reference's own schemas (SRC-02).

Types follow SURVEY 1.2: INT -> IntegerType, VARCHAR -> StringType,
DECIMAL(p,s) -> DecimalType(p,s), DATE -> DateType, DATETIME ->
TimestampNTZType.  Nullability is declared per column; a NOT NULL column
that arrives NULL is a quality failure, checked by the DQ tests rather
than by the reader.
"""

from __future__ import annotations

from pyspark.sql import types as T

I, S, D, TS = T.IntegerType(), T.StringType(), T.DateType(), T.TimestampNTZType()


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def schema(*cols: tuple) -> T.StructType:
    return T.StructType([T.StructField(c[0], c[1], c[2] if len(c) > 2 else True) for c in cols])


COFFEE = {
    "products": schema(("product_id", I, False), ("product_name", S, False), ("category", S, False),
                       ("price", dec(6, 3), False)),
    "orders": schema(("order_id", I, False), ("product_name", S, False), ("category", S, False),
                     ("quantity", I, False), ("unit_price", dec(6, 3), False), ("order_date", D, False)),
    "orders_keyed": schema(("order_id", I, False), ("product_id", I, False), ("quantity", I, False),
                           ("unit_price", dec(6, 3), False), ("order_date", D, False)),
}

CAPSTONE = {
    "stores": schema(("store_id", I, False), ("store_name", S, False), ("city", S, False)),
    "customers": schema(("customer_id", I, False), ("customer_name", S, False), ("email", S), ("signup_date", D, False)),
    "products": schema(("product_id", I, False), ("product_name", S, False), ("category", S),
                       ("current_price", dec(8, 3))),
    "orders": schema(("order_id", I, False), ("store_id", I, False), ("customer_id", I), ("order_date", D, False),
                     ("status", S, False)),
    "order_items": schema(("order_item_id", I, False), ("order_id", I, False), ("product_id", I, False),
                          ("raw_product_name", S), ("quantity", I), ("unit_price", dec(8, 3))),
}

RETAIL = {
    "regions": schema(("region_id", I, False), ("region_name", S, False)),
    "stores": schema(("store_id", I, False), ("store_name", S, False), ("region_id", I, False), ("city", S),
                     ("opened_date", D), ("store_format", S)),
    "employees": schema(("employee_id", I, False), ("employee_name", S, False), ("store_id", I), ("manager_id", I),
                        ("job_title", S), ("hire_date", D), ("active_flag", T.BooleanType())),
    "product_categories": schema(("category_id", I, False), ("category_name", S, False), ("department", S)),
    "products": schema(("product_id", I, False), ("sku", S), ("product_name", S, False), ("category_id", I),
                       ("brand", S), ("standard_cost", dec(9, 2)), ("list_price", dec(9, 2)), ("launch_date", D),
                       ("discontinued_flag", T.BooleanType())),
    "customers": schema(("customer_id", I, False), ("customer_name", S), ("email", S), ("phone", S), ("city", S),
                        ("signup_date", D), ("loyalty_tier", S), ("birth_date", D)),
    "promotions": schema(("promotion_id", I, False), ("promotion_name", S), ("start_date", D), ("end_date", D),
                         ("discount_pct", dec(5, 2))),
    "orders": schema(("order_id", I, False), ("store_id", I, False), ("customer_id", I), ("employee_id", I),
                     ("order_date", TS, False), ("channel", S), ("status", S, False), ("payment_method", S),
                     ("promotion_id", I)),
    "order_items": schema(("order_item_id", I, False), ("order_id", I, False), ("product_id", I, False),
                          ("quantity", I), ("unit_price", dec(9, 2)), ("discount_amount", dec(9, 2)),
                          ("raw_product_name", S)),
    "returns": schema(("return_id", I, False), ("order_item_id", I, False), ("return_date", D), ("return_reason", S),
                      ("refund_amount", dec(9, 2))),
    "inventory_snapshots": schema(("snapshot_id", I, False), ("store_id", I), ("product_id", I), ("snapshot_date", D),
                                  ("on_hand_quantity", I), ("reorder_point", I)),
    "customer_feedback": schema(("feedback_id", I, False), ("order_id", I), ("rating", I), ("comment_text", S),
                                ("submitted_at", TS)),
    "raw_customer_import": schema(("import_id", I, False), ("raw_name", S), ("raw_email", S), ("raw_phone", S),
                                  ("raw_city", S), ("raw_loyalty_tier", S), ("import_batch", S)),
}

KEYS = {
    "regions": ("region_id",), "stores": ("store_id",), "employees": ("employee_id",),
    "product_categories": ("category_id",), "products": ("product_id",), "customers": ("customer_id",),
    "promotions": ("promotion_id",), "orders": ("order_id",), "order_items": ("order_item_id",),
    "returns": ("return_id",), "inventory_snapshots": ("snapshot_id",), "customer_feedback": ("feedback_id",),
    "raw_customer_import": ("import_id",),
}
