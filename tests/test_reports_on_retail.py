"""Every report also runs on tables shaped like the reference's own retail schema."""

import pytest

from shelfwise.operators import reports as rp
from shelfwise.operators import sales
from shelfwise.sources.generate import generate_retail, retail_model

H1 = ("2026-01-01", "2026-04-01")
CALLS = {
    "RP-01": lambda m, t: sales.valid_sales_view(m),
    "RP-02": lambda m, t: rp.monthly_kpis(m),
    "RP-03": lambda m, t: rp.store_month(m),
    "RP-04": lambda m, t: rp.region_store_channel(m),
    "RP-05": lambda m, t: rp.region_store(m),
    "RP-06": lambda m, t: rp.department_category(m),
    "RP-07": lambda m, t: rp.top_products(m, 10),
    "RP-08": lambda m, t: rp.product_threshold(m, 300),
    "RP-09": lambda m, t: rp.product_vs_own_avg(m),
    "RP-10": lambda m, t: rp.product_above_avg_months(m),
    "RP-11": lambda m, t: rp.department_top(m, 3),
    "RP-12": lambda m, t: rp.category_leaders(m),
    "RP-13": lambda m, t: rp.store_mom(m),
    "RP-14": lambda m, t: rp.growth_mom(m, "product_id"),
    "RP-15": lambda m, t: rp.store_vs_region(m),
    "RP-16": lambda m, t: rp.store_vs_company(m),
    "RP-17": lambda m, t: rp.net_revenue(m, "completed"),
    "RP-18": lambda m, t: rp.return_rate(m),
    "RP-19": lambda m, t: rp.inventory_risk(m, t["inventory_snapshots"]),
    "RP-21": lambda m, t: rp.inactive_customers(m, 45),
    "RP-22": lambda m, t: rp.never_completed(m),
    "RP-23": lambda m, t: rp.order_population(m),
    "RP-24": lambda m, t: rp.unsold_products(m, *H1),
    "RP-25": lambda m, t: rp.catalog_coverage(m, *H1),
    "RP-26": lambda m, t: rp.above_benchmark_products(m),
    "RP-27": lambda m, t: rp.days_above_average(m),
    "RP-28": lambda m, t: rp.product_category_share(m),
    "RP-29": lambda m, t: rp.daily_performance(m),
    "RP-30": lambda m, t: rp.category_month_band(m, ((3000, "High"), (1000, "Medium"))),
    "RP-31": lambda m, t: rp.product_band(m, ((4000, "High"), (2000, "Medium"))),
    "RP-32": lambda m, t: rp.weekday_revenue(m),
    "RP-33": lambda m, t: rp.sales_labels(m, ((10, "High"), (5, "Medium"))),
    "RP-34": lambda m, t: rp.volume_vs_revenue(m),
    "RP-35": lambda m, t: rp.top_product_per_store(m, ties=True),
    "RP-36": lambda m, t: rp.category_shortlist(m, *H1, 100, 500),
    "RP-37": lambda m, t: rp.customer_fields(m, "2026-07-01", ("gold", "silver", "bronze")),
    "RP-38": lambda m, t: rp.net_by_dimensions(m, ("sales_month", "region_name", "department")),
}


@pytest.fixture(scope="module")
def retail(spark):
    t = generate_retail(spark, 1)
    return t, retail_model(t)


@pytest.mark.parametrize("rid", sorted(CALLS))
def test_report_runs_on_retail_schema(retail, rid):
    t, m = retail
    df = CALLS[rid](m, t)
    n = df.count()
    assert n > 0 or rid == "RP-24"  # every generated product sells in the period


def test_net_by_dimensions_refunds_equal_those_of_valid_completed_items(retail):
    t, m = retail
    items = t["order_items"].filter("quantity > 0 AND unit_price >= 0")
    done = t["orders"].filter("status = 'completed'").select("order_id")
    kept = items.join(done, "order_id", "left_semi").select("order_item_id")
    want = t["returns"].join(kept, "order_item_id", "left_semi").agg({"refund_amount": "sum"}).first()[0]
    got = rp.net_by_dimensions(m, ("sales_month", "region_name", "department")).collect()
    assert want > 0 and abs(sum(r["refund_amount"] for r in got) - float(want)) < 0.01
    gross = {r["sales_month"]: r["gross_revenue"] for r in rp.monthly_kpis(m).collect()}
    for month in gross:
        mine = [r for r in got if r["sales_month"] == month]
        assert abs(sum(r["gross_revenue"] for r in mine) - gross[month]) < 0.05
        assert all(abs(r["gross_revenue"] - r["refund_amount"] - r["net_revenue"]) < 0.011 for r in mine)


def test_refunds_reconcile(retail):
    t, m = retail
    shown = sum(r["refund_amount"] for r in rp.net_revenue(m).collect())
    rest = sum(r["refund_amount"] for r in rp.unmatched_refunds(m).collect())
    total = t["returns"].agg({"refund_amount": "sum"}).first()[0]
    assert abs(shown + rest - float(total)) < 0.01


def test_customer_fields_with_contact_data(retail):
    t, m = retail
    src = {r["customer_id"]: r for r in t["customers"].collect()}
    got = rp.customer_fields(m, "2026-07-01", ("gold", "silver", "bronze"))
    assert {"clean_email", "email_quality"} <= set(got.columns) or "email" not in t["customers"].columns
    if "email" in t["customers"].columns:
        for r in got.collect():
            e = src[r["customer_id"]]["email"]
            assert r["clean_email"] == (e.strip(" ").lower() if e is not None else None)
            assert r["email_quality"] == ("missing email" if e is None or not e.strip(" ") else "usable email" if "@" in e and "." in e.split("@", 1)[1] else "invalid email")


def test_inventory_priority_on_retail_schema(retail):
    t, m = retail
    pr = rp.inventory_priority(m, t["inventory_snapshots"])
    assert pr.count() == rp.inventory_risk(m, t["inventory_snapshots"]).count() > 0
    assert pr.filter("product_revenue_rank IS NULL").count() == 0
