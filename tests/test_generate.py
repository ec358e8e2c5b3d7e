"""SRC-04: the deterministic retail generator, checked against a pure-Python restatement."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import quality as Q
from shelfwise.operators import reports as rp
from shelfwise.operators import sales
from shelfwise.sources.generate import BASE, DAYS, DIRT, START, generate_retail, retail_model
from shelfwise.sources.schemas import RETAIL


def hit(i, name):
    mod, rem = DIRT[name]
    return i % mod == rem


def py_status(o):
    for name, label in (("order_cancelled", "cancelled"), ("order_pending", "pending"), ("order_refunded", "refunded")):
        if hit(o, name):
            return label
    return "completed"


def py_items(scale=1):
    n_pr = BASE["products"] * scale
    out = []
    for i in range(1, BASE["orders"] * scale * 3 + 1):
        pid = (i * 7) % n_pr + 1
        q = None if hit(i, "item_null_quantity") else (-1 if hit(i, "item_negative_quantity") else 1 + i % 4)
        price = Decimal("-2.00") if hit(i, "item_negative_price") else Decimal("1.50") + (pid % 7) * Decimal("0.75")
        disc = Decimal("0.50") if hit(i, "item_discount") else Decimal("0.00")
        out.append(((i - 1) // 3 + 1, pid, q, price, disc))
    return out


@pytest.fixture(scope="module")
def gen(spark):
    return generate_retail(spark, 1)


def test_row_counts_and_schemas(gen):
    counts = {k: v.count() for k, v in gen.items()}
    assert counts == {"regions": 4, "product_categories": 8, "stores": 6, "employees": 14, "products": 18,
                      "customers": 250, "promotions": 5, "orders": 1800, "order_items": 5400, "returns": 135,
                      "inventory_snapshots": 648, "customer_feedback": 450, "raw_customer_import": 7}
    for name, df in gen.items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in RETAIL[name]], name


def test_scale_grows_facts(spark):
    g2 = generate_retail(spark, 2)
    assert g2["orders"].count() == 3600 and g2["order_items"].count() == 10800


def test_status_population(gen):
    got = {r.status: r["count"] for r in gen["orders"].groupBy("status").count().collect()}
    exp = {}
    for o in range(1, 1801):
        exp[py_status(o)] = exp.get(py_status(o), 0) + 1
    assert got == exp


def test_item_dirt_profile(gen):
    p = Q.profile_counts(gen["order_items"], {
        "null_quantity_rows": F.col("quantity").isNull(), "non_positive_quantity_rows": F.col("quantity") <= 0,
        "negative_price_rows": F.col("unit_price") < 0}).collect()[0]
    items = py_items()
    assert p.null_quantity_rows == sum(1 for _o, _p, q, _pr, _d in items if q is None)
    assert p.non_positive_quantity_rows == sum(1 for _o, _p, q, _pr, _d in items if q is not None and q <= 0)
    assert p.negative_price_rows == sum(1 for *_x, pr, _d in items if pr < 0)


def test_valid_completed_totals_match_python(gen):
    m = retail_model(gen)
    r = sales.reconcile(sales.valid_sales_view(m), sales.source_sales(m)).collect()[0]
    rows_, total = 0, Decimal(0)
    for o, _pid, q, price, disc in py_items():
        if py_status(o) == "completed" and q is not None and q > 0 and price >= 0:
            rows_ += 1
            total += q * price - disc
    assert r.view_rows == r.source_rows == rows_
    assert Decimal(str(r.view_gross_revenue)) == total.quantize(Decimal("0.01"))
    months = rp.monthly_kpis(m)
    assert months.count() == 6
    assert round(sum(x.gross_revenue for x in months.collect()), 2) == float(total)


def test_customer_dirt(gen):
    p = Q.profile_counts(gen["customers"], {
        "missing_email": F.col("email").isNull() | (F.trim("email") == ""),
        "blank_city": F.col("city").isNull() | (F.trim("city") == ""),
        "lower_gold": F.col("loyalty_tier") == "gold"}).collect()[0]
    ids = range(1, 251)
    assert p.missing_email == sum(1 for c in ids if hit(c, "customer_null_email"))
    assert p.blank_city == sum(1 for c in ids if hit(c, "customer_blank_city"))
    assert p.lower_gold == sum(1 for c in ids if c % 5 == 3)


def test_inactive_customers_45_days(gen):
    m = retail_model(gen)
    got = {r.customer_id for r in rp.inactive_customers(m, 45).collect()}
    dates = {o: START + dt.timedelta(days=o * 7919 % DAYS) for o in range(1, 1801)}
    latest = max(dates.values())
    active = {o * 37 % 250 + 1 for o in range(1, 1801)
              if py_status(o) == "completed" and not hit(o, "order_anonymous")
              and latest - dt.timedelta(days=45) < dates[o] <= latest}
    assert got == set(range(1, 251)) - active


def test_inventory_risk_on_generated_snapshots(gen):
    m = retail_model(gen)
    risk = rp.inventory_risk(m, gen["inventory_snapshots"])
    exp = sum(1 for s in range(1, 7) for p in range(1, 19)
              if (s * 7 + p * 13 + 5 * 5) % 60 < 15 + (p % 4) * 5)
    assert risk.count() == exp
    assert risk.agg(F.max("quantity_gap")).collect()[0][0] < 0
