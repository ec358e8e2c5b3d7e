"""Literal fixture rows of the reference's coffee and capstone schemas.

Fixed values: these rows must equal the reference's data so that its
published totals (21 units, 45.800 revenue; 21 valid completed rows,
121.050 revenue) can be asserted.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from shelfwise.sources.literals import rows
from shelfwise.sources.schemas import CAPSTONE, COFFEE


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def m(x) -> Decimal | None:
    return None if x is None else Decimal(str(x))


# coffee_shop products and denormalised sale lines.
COFFEE_PRODUCTS = [
    (1, "Iced Latte", "Coffee", "2.750"), (2, "Cold Brew", "Coffee", "3.000"), (3, "Croissant", "Pastry", "1.500"),
    (4, "Brownie", "Dessert", "1.750"), (5, "Matcha Latte", "Tea", "2.900"), (6, "Americano", "Coffee", "1.250"),
]
COFFEE_ORDERS = [
    (1, "Iced Latte", "Coffee", 2, "2.750", "2026-06-20"), (2, "Cold Brew", "Coffee", 1, "3.000", "2026-06-20"),
    (3, "Croissant", "Pastry", 3, "1.500", "2026-06-20"), (4, "Brownie", "Dessert", 2, "1.750", "2026-06-21"),
    (5, "Iced Latte", "Coffee", 1, "2.750", "2026-06-21"), (6, "Matcha Latte", "Tea", 2, "2.900", "2026-06-21"),
    (7, "Americano", "Coffee", 4, "1.250", "2026-06-22"), (8, "Cold Brew", "Coffee", 2, "3.000", "2026-06-22"),
    (9, "Croissant", "Pastry", 1, "1.500", "2026-06-22"), (10, "Iced Latte", "Coffee", 3, "2.750", "2026-06-23"),
]

# beanroute_capstone stores, customers, products, orders and items.
CAP_STORES = [(1, "Central", "Kuwait City"), (2, "Marina", "Salmiya"), (3, "Campus", "Shuwaikh")]
CAP_CUSTOMERS = [
    (1, "Amina Saleh", "amina@example.com", "2025-11-02"), (2, "Omar Ali", "omar@example.com", "2025-12-12"),
    (3, "Layla Noor", "layla@example.com", "2026-01-08"), (4, "Yousef Sami", None, "2026-01-20"),
    (5, "Mariam Adel", "mariam@example.com", "2026-02-10"), (6, "Hamad Essa", "hamad@example.com", "2026-02-15"),
    (7, "Noor Fahad", "noor@example.com", "2026-03-01"), (8, "Sara Nabil", "sara@example.com", "2026-03-05"),
]
CAP_PRODUCTS = [
    (1, "Iced Latte", "Coffee", "2.750"), (2, "Cold Brew", "Coffee", "3.000"), (3, "Croissant", "Pastry", "1.500"),
    (4, "Brownie", "Dessert", "1.750"), (5, "Matcha Latte", "Tea", "2.900"), (6, "Americano", "Coffee", "1.250"),
    (7, "Turkey Sandwich", "Food", "3.800"), (8, "Berry Bowl", "Food", "4.200"), (9, "Seasonal Tea", "", None),
]
CAP_ORDERS = [
    (101, 1, 1, "2026-01-05", "completed"), (102, 1, 2, "2026-01-18", "completed"),
    (103, 2, 3, "2026-01-20", "cancelled"), (104, 3, 4, "2026-01-29", "completed"),
    (105, 2, 5, "2026-02-02", "completed"), (106, 1, 1, "2026-02-09", "completed"),
    (107, 3, 6, "2026-02-14", "pending"), (108, 2, 2, "2026-02-21", "completed"),
    (109, 3, 7, "2026-02-26", "completed"), (110, 1, 3, "2026-03-03", "completed"),
    (111, 2, 5, "2026-03-08", "completed"), (112, 3, 1, "2026-03-12", "cancelled"),
    (113, 1, None, "2026-03-18", "completed"), (114, 2, 6, "2026-03-22", "completed"),
    (115, 3, 4, "2026-03-28", "completed"), (116, 1, 2, "2026-04-04", "completed"),
    (117, 2, 3, "2026-04-11", "completed"), (118, 3, 7, "2026-04-19", "completed"),
]
CAP_ITEMS = [
    (1, 101, 1, "Iced Latte", 2, "2.750"), (2, 101, 3, "Croissant", 1, "1.500"), (3, 102, 2, "Cold Brew", 2, "3.000"),
    (4, 103, 5, "Matcha Latte", 2, "2.900"), (5, 104, 6, "Americano", 4, "1.250"),
    (6, 105, 7, "Turkey Sandwich", 2, "3.800"), (7, 105, 2, "Cold Brew", 1, "3.000"),
    (8, 106, 1, " iced latte ", 3, "2.750"), (9, 107, 8, "Berry Bowl", 2, "4.200"),
    (10, 108, 5, "Matcha Latte", 2, "2.900"), (11, 109, 3, "Croissant", 5, "1.500"), (12, 109, 4, "Brownie", 2, "1.750"),
    (13, 110, 7, "Turkey Sandwich", 1, "3.800"), (14, 110, 1, "Iced Latte", 2, "2.750"),
    (15, 111, 8, "Berry Bowl", 2, "4.200"), (16, 112, 2, "Cold Brew", 3, "3.000"), (17, 113, 6, "Americano", 5, "1.250"),
    (18, 114, 5, "MATCHA LATTE", 1, "2.900"), (19, 114, 4, "Brownie", 3, "1.750"), (20, 115, 3, "Croissant", None, "1.500"),
    (21, 116, 1, "Iced Latte", 4, "2.500"), (22, 116, 7, "Turkey Sandwich", 2, "3.800"),
    (23, 117, 2, "Cold Brew", 2, "3.000"), (24, 117, 8, "Berry Bowl", 1, "4.200"), (25, 118, 6, "Americano", 6, "1.250"),
    (26, 118, 3, "Croissant", 3, "-1.500"),
]


def coffee(spark):
    p = rows(spark, COFFEE["products"], [(a, b, c, m(x)) for a, b, c, x in COFFEE_PRODUCTS])
    o = rows(spark, COFFEE["orders"], [(a, b, c, q, m(x), d(y)) for a, b, c, q, x, y in COFFEE_ORDERS])
    return p, o


def capstone(spark):
    return {
        "stores": rows(spark, CAPSTONE["stores"], CAP_STORES),
        "customers": rows(spark, CAPSTONE["customers"], [(a, b, c, d(x)) for a, b, c, x in CAP_CUSTOMERS]),
        "products": rows(spark, CAPSTONE["products"], [(a, b, c, m(x)) for a, b, c, x in CAP_PRODUCTS]),
        "orders": rows(spark, CAPSTONE["orders"], [(a, b, c, d(x), s) for a, b, c, x, s in CAP_ORDERS]),
        "order_items": rows(spark, CAPSTONE["order_items"], [(a, b, c, n, q, m(x)) for a, b, c, n, q, x in CAP_ITEMS]),
    }
