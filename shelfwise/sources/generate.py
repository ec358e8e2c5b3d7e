"""Deterministic retail data generator (SRC-04).

Builds every table of the retail schema (:data:`shelfwise.sources.schemas.RETAIL`)
from ``spark.range`` and integer arithmetic on the row id, so the same
``scale`` always yields the same rows, on any number of executors.  Fact
tables grow linearly with ``scale``; the small dimensions grow with it too
(stores, products, customers), so nothing is built on the driver except
the handful of literal dimension rows.

Dirt is planted on purpose and at known rates (see ``DIRT``): NULL and
non-positive quantities, negative prices, NULL / padded / upper-case
emails, blank cities, lower-case or missing loyalty tiers, padded and
upper-case raw product names, non-completed orders, anonymous orders,
out-of-range ratings and returns on non-completed orders.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.sources.literals import rows
from shelfwise.sources.schemas import RETAIL

BASE = {"stores": 6, "products": 18, "customers": 250, "orders": 1800, "items_per_order": 3}
START = dt.date(2026, 1, 1)
DAYS = 181  # January .. June

# Fixed values (own invention): regions, categories and their departments, channels, statuses.
REGIONS = ((1, "North"), (2, "South"), (3, "East"), (4, "West"))
CATEGORIES = ((1, "Hot Drinks", "Beverages"), (2, "Cold Drinks", "Beverages"), (3, "Bakery", "Food"),
              (4, "Sandwiches", "Food"), (5, "Snacks", "Food"), (6, "Beans", "Retail"), (7, "Mugs", "Retail"),
              (8, "Gift Cards", "Retail"))
CHANNELS = ("Store", "Pickup", "Delivery", "Kiosk")
TIERS = ("Gold", "Silver", "Bronze", "gold", None)
PROMOTIONS = ((1, "New Year", dt.date(2026, 1, 1), dt.date(2026, 1, 10), 10),
              (2, "Winter Warmers", dt.date(2026, 2, 1), dt.date(2026, 2, 14), 15),
              (3, "Spring", dt.date(2026, 3, 20), dt.date(2026, 4, 5), 5),
              (4, "Mothers Day", dt.date(2026, 5, 1), dt.date(2026, 5, 10), 20),
              (5, "Summer Start", dt.date(2026, 6, 15), dt.date(2026, 6, 30), 10))
FORMATS = ("Flagship", "Express", "Kiosk")

# Planted dirt: (modulus, remainder) on the row id.
DIRT = {
    "order_cancelled": (50, 1), "order_pending": (70, 2), "order_refunded": (97, 3), "order_anonymous": (41, 0),
    "item_null_quantity": (900, 5), "item_negative_quantity": (1100, 7), "item_negative_price": (1000, 9),
    "item_discount": (10, 0), "item_upper_name": (17, 0), "item_padded_name": (19, 0), "item_returned": (40, 0),
    "customer_null_email": (37, 0), "customer_padded_email": (11, 0), "customer_blank_city": (13, 0),
    "feedback_null_rating": (90, 0), "feedback_rating_six": (100, 1),
}


def _hit(col: Column, name: str) -> Column:
    mod, rem = DIRT[name]
    return (col % mod) == rem


def _pick(idx: Column, values) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (idx % len(values) + 1).cast("int"))


def generate_retail(spark: SparkSession, scale: int = 1, hot_share: int = 0) -> dict[str, DataFrame]:
    """All retail tables for ``scale`` (1 = 1,800 orders, 5,400 items, 250 customers).

    ``hot_share=k`` (k >= 2) sends every k-th item to product 1, so one key
    holds 1/k of all items - for testing skew handling.
    """
    n_st, n_pr = BASE["stores"] * scale, BASE["products"] * scale
    n_cu, n_or = BASE["customers"] * scale, BASE["orders"] * scale
    n_it = n_or * BASE["items_per_order"]
    t: dict[str, DataFrame] = {}

    t["regions"] = rows(spark, RETAIL["regions"], REGIONS)
    t["product_categories"] = rows(spark, RETAIL["product_categories"], CATEGORIES)

    s = spark.range(1, n_st + 1).select(F.col("id").cast("int").alias("store_id"))
    t["stores"] = s.select(
        "store_id", F.concat(F.lit("Store "), F.lpad(F.col("store_id").cast("string"), 3, "0")).alias("store_name"),
        ((F.col("store_id") - 1) % 4 + 1).cast("int").alias("region_id"),
        F.concat(F.lit("City "), ((F.col("store_id") - 1) % 5 + 1).cast("string")).alias("city"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("store_id") * 97 % 1500).cast("int")).alias("opened_date"),
        _pick(F.col("store_id"), FORMATS).alias("store_format"))

    e = spark.range(1, 2 * n_st + 3).select(F.col("id").cast("int").alias("employee_id"))
    t["employees"] = e.select(
        "employee_id", F.concat(F.lit("Employee "), F.col("employee_id").cast("string")).alias("employee_name"),
        ((F.col("employee_id") - 1) % n_st + 1).cast("int").alias("store_id"),
        F.when(F.col("employee_id") == 1, F.lit(None)).otherwise(((F.col("employee_id") - 2) / 3 + 1).cast("int"))
        .cast("int").alias("manager_id"),
        F.when(F.col("employee_id") == 1, "Regional Manager").otherwise("Associate").alias("job_title"),
        F.date_add(F.lit("2022-01-01").cast("date"), (F.col("employee_id") * 53 % 900).cast("int")).alias("hire_date"),
        (F.col("employee_id") % 9 != 0).alias("active_flag"))

    p = spark.range(1, n_pr + 1).select(F.col("id").cast("int").alias("product_id"))
    price = (F.lit(1.50) + (F.col("product_id") % 7) * F.lit(0.75)).cast("decimal(9,2)")
    t["products"] = p.select(
        "product_id", F.concat(F.lit("SKU-"), F.lpad(F.col("product_id").cast("string"), 5, "0")).alias("sku"),
        F.concat(F.lit("Product "), F.col("product_id").cast("string")).alias("product_name"),
        ((F.col("product_id") - 1) % 8 + 1).cast("int").alias("category_id"),
        F.concat(F.lit("Brand "), ((F.col("product_id") - 1) % 4 + 1).cast("string")).alias("brand"),
        (price * F.lit(0.55)).cast("decimal(9,2)").alias("standard_cost"), price.alias("list_price"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("product_id") * 31 % 700).cast("int")).alias("launch_date"),
        (F.col("product_id") % 18 == 0).alias("discontinued_flag"))

    c = spark.range(1, n_cu + 1).select(F.col("id").cast("int").alias("customer_id"))
    cid = F.col("customer_id")
    email = F.concat(F.lit("customer"), cid.cast("string"), F.lit("@example.com"))
    t["customers"] = c.select(
        "customer_id", F.concat(F.lit("Customer "), cid.cast("string")).alias("customer_name"),
        F.when(_hit(cid, "customer_null_email"), F.lit(None))
        .when(_hit(cid, "customer_padded_email"), F.concat(F.lit("  "), F.upper(email), F.lit(" ")))
        .otherwise(email).alias("email"),
        F.when(cid % 23 == 0, F.lit(" ")).otherwise(F.concat(F.lit("555-"), F.lpad(cid.cast("string"), 4, "0"))).alias("phone"),
        F.when(_hit(cid, "customer_blank_city"), F.lit("")).otherwise(
            F.concat(F.lit("City "), (cid % 5 + 1).cast("string"))).alias("city"),
        F.date_add(F.lit("2024-06-01").cast("date"), (cid * 13 % 500).cast("int")).alias("signup_date"),
        _pick(cid, TIERS).alias("loyalty_tier"),
        F.date_add(F.lit("1960-01-01").cast("date"), (cid * 211 % 15000).cast("int")).alias("birth_date"))

    t["promotions"] = rows(spark, RETAIL["promotions"], [
        (pid, name, a, b, Decimal(pct)) for pid, name, a, b, pct in PROMOTIONS])

    o = spark.range(1, n_or + 1).select(F.col("id").cast("int").alias("order_id"))
    oid = F.col("order_id")
    day = F.date_add(F.lit(START).cast("date"), (oid * 7919 % DAYS).cast("int"))
    status = (F.when(_hit(oid, "order_cancelled"), "cancelled").when(_hit(oid, "order_pending"), "pending")
              .when(_hit(oid, "order_refunded"), "refunded").otherwise("completed"))
    orders = o.select(
        "order_id", ((oid * 5 - 1) % n_st + 1).cast("int").alias("store_id"),
        F.when(_hit(oid, "order_anonymous"), F.lit(None)).otherwise((oid * 37 % n_cu + 1)).cast("int").alias("customer_id"),
        ((oid - 1) % (2 * n_st + 2) + 1).cast("int").alias("employee_id"),
        F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day), (oid % 12 + 8).cast("int"),
                             (oid * 7 % 60).cast("int"), F.lit(0)).alias("order_date"),
        _pick(oid, CHANNELS).alias("channel"), status.alias("status"),
        _pick(oid, ("card", "cash", "wallet")).alias("payment_method"),
        F.lit(None).cast("int").alias("promotion_id"))
    promos = t["promotions"].select("promotion_id", "start_date", "end_date")
    d = F.to_date("order_date")
    t["orders"] = (orders.drop("promotion_id")
                   .join(F.broadcast(promos), (d >= F.col("start_date")) & (d <= F.col("end_date")), "left")
                   .select(*[c_ for c_ in RETAIL["orders"].fieldNames()]))

    i = spark.range(1, n_it + 1).select(F.col("id").cast("int").alias("order_item_id"))
    iid = F.col("order_item_id")
    items = i.select("order_item_id", (((iid - 1) / 3).cast("int") + 1).alias("order_id"),
                     (F.when(F.lit(hot_share >= 2) & (iid % max(hot_share, 2) == 0), F.lit(1))
                      .otherwise((iid * 7) % n_pr + 1)).cast("int").alias("product_id"),
                     (F.lit(1) + iid % 4).alias("_q"))
    items = items.join(t["products"].select("product_id", "product_name", "list_price"), "product_id")
    qty = (F.when(_hit(iid, "item_null_quantity"), F.lit(None)).when(_hit(iid, "item_negative_quantity"), F.lit(-1))
           .otherwise(F.col("_q"))).cast("int")
    unit = F.when(_hit(iid, "item_negative_price"), F.lit(-2.00).cast("decimal(9,2)")).otherwise(F.col("list_price"))
    raw = (F.when(_hit(iid, "item_upper_name"), F.upper("product_name"))
           .when(_hit(iid, "item_padded_name"), F.concat(F.lit(" "), F.lower("product_name"), F.lit("  ")))
           .otherwise(F.col("product_name")))
    t["order_items"] = items.select(
        "order_item_id", "order_id", "product_id", qty.alias("quantity"), unit.cast("decimal(9,2)").alias("unit_price"),
        F.when(_hit(iid, "item_discount"), F.lit(0.50)).otherwise(F.lit(0.00)).cast("decimal(9,2)").alias("discount_amount"),
        raw.alias("raw_product_name"))

    ret = (t["order_items"].filter(_hit(iid, "item_returned"))
           .join(t["orders"].select("order_id", "order_date"), "order_id"))
    refund = F.greatest(F.coalesce(F.col("quantity"), F.lit(0)) * F.col("unit_price") - F.col("discount_amount"),
                        F.lit(0).cast("decimal(9,2)"))
    t["returns"] = ret.select(
        (F.col("order_item_id") / 40).cast("int").alias("return_id"), "order_item_id",
        F.date_add(F.to_date("order_date"), (F.col("order_item_id") % 20 + 1).cast("int")).alias("return_date"),
        _pick(F.col("order_item_id"), ("damaged", "wrong item", "changed mind")).alias("return_reason"),
        refund.cast("decimal(9,2)").alias("refund_amount"))

    # store x product x month, enumerated from one range (no join): id -> (store, product, month)
    snap = spark.range(0, n_st * n_pr * 6).select(
        (F.col("id") + 1).cast("int").alias("snapshot_id"),
        (F.col("id") / (n_pr * 6) + 1).cast("int").alias("store_id"),
        ((F.col("id") / 6).cast("long") % n_pr + 1).cast("int").alias("product_id"),
        (F.col("id") % 6).cast("int").alias("m"))
    t["inventory_snapshots"] = snap.select(
        "snapshot_id", "store_id", "product_id", F.add_months(F.lit(START).cast("date"), F.col("m")).alias("snapshot_date"),
        ((F.col("store_id") * 7 + F.col("product_id") * 13 + F.col("m") * 5) % 60).cast("int").alias("on_hand_quantity"),
        (F.lit(15) + (F.col("product_id") % 4) * 5).cast("int").alias("reorder_point"))

    fb = spark.range(1, n_or // 4 + 1).select(F.col("id").cast("int").alias("feedback_id"))
    fid = F.col("feedback_id")
    t["customer_feedback"] = fb.select(
        "feedback_id", (fid * 4 - 1).cast("int").alias("order_id"),
        F.when(_hit(fid, "feedback_null_rating"), F.lit(None)).when(_hit(fid, "feedback_rating_six"), F.lit(6))
        .otherwise(fid % 5 + 1).cast("int").alias("rating"),
        F.when(fid % 6 == 0, F.lit("  ")).otherwise(F.concat(F.lit("comment "), fid.cast("string"))).alias("comment_text"),
        F.make_timestamp_ntz(F.lit(2026), (fid % 6 + 1).cast("int"), (fid % 28 + 1).cast("int"), F.lit(12), F.lit(0),
                             F.lit(0)).alias("submitted_at"))

    t["raw_customer_import"] = rows(spark, RETAIL["raw_customer_import"], [
        (1, "  Dana Reyes ", "DANA@EXAMPLE.COM ", "555-0101", "City 1", " gold", "batch-1"),
        (2, "Eli Park", "eli.example.com", "", "City 2", "Silver", "batch-1"),
        (3, "Fay Moss", None, "555-0103", " ", "platinum", "batch-1"),
        (4, "dana reyes", "dana@example.com", "555-0101", "City 1", "Gold", "batch-2"),
        (5, "Gil Hart", "gil@example.com", None, "City 3", None, "batch-2"),
        (6, "Hana Ito", "hana@example", "555-0106", "City 4", "BRONZE", "batch-2"),
        (7, " ", "", "555-0107", "City 5", "silver ", "batch-2")])
    return t


def retail_model(t: dict[str, DataFrame]):
    """The :class:`~shelfwise.sources.model.Model` over generated tables."""
    from shelfwise.sources.model import from_retail_tables
    return from_retail_tables(t["orders"], t["order_items"], t["stores"], t["products"], t["customers"],
                              t["returns"], t["regions"], t["product_categories"])
