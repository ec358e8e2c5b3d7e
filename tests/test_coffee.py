"""Published coffee-shop values (21 units, 45.800 revenue and the lesson tables)."""

from decimal import Decimal

from pyspark.sql import functions as F

from fixtures import coffee
from shelfwise.functions.metrics import gross_line_revenue
from shelfwise.operators import aggs as A
from shelfwise.operators import joins as J
from shelfwise.operators import windows as W


def _lines(spark):
    _, o = coffee(spark)
    return o.withColumn("revenue", gross_line_revenue("quantity", "unit_price"))


def test_control_totals(spark):
    r = _lines(spark).agg(F.sum("quantity").alias("u"), F.sum("revenue").alias("r")).collect()[0]
    assert r.u == 21 and r.r == Decimal("45.800")


def test_coffee_category_and_date_range(spark):
    o = _lines(spark)
    coffee_total = o.filter(F.col("category") == "Coffee").agg(F.sum("revenue")).collect()[0][0]
    assert coffee_total == Decimal("30.500")
    ranged = (o.filter((F.col("category") == "Coffee") & F.col("order_date").between("2026-06-20", "2026-06-22"))
              .agg(F.sum("revenue")).collect()[0][0])
    assert ranged == Decimal("22.250")


def test_revenue_by_product(spark):
    g = {r.product_name: r.rev for r in _lines(spark).groupBy("product_name").agg(F.sum("revenue").alias("rev")).collect()}
    assert g == {"Iced Latte": Decimal("16.500"), "Cold Brew": Decimal("9.000"), "Croissant": Decimal("6.000"),
                 "Matcha Latte": Decimal("5.800"), "Americano": Decimal("5.000"), "Brownie": Decimal("3.500")}


def test_daily_running_and_rank(spark):
    daily = _lines(spark).groupBy("order_date").agg(F.sum("revenue").alias("revenue"))
    d = W.running(daily, "revenue", ["order_date"], frame="rows")
    d = W.dist_ranks(d, "revenue", rank_out="rk", dense_out="drk")
    got = [(str(r.order_date), r.revenue, r.running_total, r.rk) for r in d.orderBy("order_date").collect()]
    assert got == [("2026-06-20", Decimal("13.000"), Decimal("13.000"), 1),
                   ("2026-06-21", Decimal("12.050"), Decimal("25.050"), 3),
                   ("2026-06-22", Decimal("12.500"), Decimal("37.550"), 2),
                   ("2026-06-23", Decimal("8.250"), Decimal("45.800"), 4)]


def test_average_product_revenue_and_above(spark):
    per = _lines(spark).groupBy("product_name").agg(F.sum("revenue").alias("rev"))
    bench = per.agg(F.avg("rev").alias("avg_rev"))
    assert round(float(bench.collect()[0].avg_rev), 3) == 7.633
    above = J.attach_scalar(per, bench).filter(F.col("rev") > F.col("avg_rev"))
    got = {r.product_name: round(float(r.rev - r.avg_rev), 3) for r in above.collect()}
    assert got == {"Iced Latte": 8.867, "Cold Brew": 1.367}


def test_items_sold_vs_revenue(spark):
    per = _lines(spark).groupBy("product_name").agg(F.sum("quantity").alias("items_sold"), F.sum("revenue").alias("rev"))
    r = W.dist_ranks(per, "items_sold", rank_out="units_rank", dense_out="_u")
    r = W.dist_ranks(r, "rev", rank_out="revenue_rank", dense_out="_r")
    got = {x.product_name: (x.units_rank, x.revenue_rank) for x in r.collect()}
    assert got["Americano"][0] < got["Matcha Latte"][0]  # more units
    assert got["Matcha Latte"][1] < got["Americano"][1]  # but less revenue


def test_normalize_fact_keeps_history(spark):
    _, o = coffee(spark)
    dim, slim = J.normalize(o, "order_id", ["product_name", "category"], key_name="product_key")
    assert dim.count() == 6
    assert slim.count() == 10 and "unit_price" in slim.columns
    back = slim.join(dim, "product_key").groupBy("product_name").agg(F.sum("quantity").alias("q"))
    assert {r.product_name: r.q for r in back.collect()}["Iced Latte"] == 6


def test_union_all_keeps_duplicates(spark):
    _, o = coffee(spark)
    a = o.select("product_name").filter(F.col("category") == "Coffee")
    assert A.stack([a, a]).count() == 12
    assert A.stack([a, a], distinct=True).count() == 3
