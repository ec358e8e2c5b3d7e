"""A hot key holding a third of all rows: results stay exact and the hot key is split."""

from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise.operators import quality as Q
from shelfwise.operators import reports as rp
from shelfwise.operators import windows as W
from shelfwise.sources.generate import generate_retail, retail_model
from test_generate import hit, py_status


@pytest.fixture(scope="module")
def hot(spark):
    t = generate_retail(spark, 2, hot_share=3)
    return t, retail_model(t)


def test_hot_product_holds_a_third(hot):
    t, _ = hot
    items = t["order_items"]
    assert items.filter("product_id = 1").count() * 3 >= items.count()


def test_product_totals_exact_under_skew(hot):
    _, m = hot
    got = {r.product_id: Decimal(str(r.gross_revenue)) for r in rp.return_rate(m).collect()}
    exp = {}
    n_pr = 36
    for i in range(1, 3600 * 3 + 1):
        pid = 1 if i % 3 == 0 else (i * 7) % n_pr + 1
        q = None if hit(i, "item_null_quantity") else (-1 if hit(i, "item_negative_quantity") else 1 + i % 4)
        price = Decimal("-2.00") if hit(i, "item_negative_price") else Decimal("1.50") + (pid % 7) * Decimal("0.75")
        disc = Decimal("0.50") if hit(i, "item_discount") else Decimal(0)
        if py_status((i - 1) // 3 + 1) == "completed" and q is not None and q > 0 and price >= 0:
            exp[pid] = exp.get(pid, Decimal(0)) + q * price - disc
    assert got == {k: v.quantize(Decimal("0.01")) for k, v in exp.items()}


def test_row_numbers_on_the_hot_key_match_a_window(hot):
    t, _ = hot
    items = t["order_items"].select("order_item_id", "product_id")
    got = W.number(items, ["order_item_id"], by=["product_id"], out="rn")
    w = Window.partitionBy("product_id").orderBy("order_item_id")
    exp = items.withColumn("rn", F.row_number().over(w))
    assert got.exceptAll(exp.select(*got.columns)).count() == 0 and got.count() == exp.count()


def test_hot_key_is_split_across_scan_slices(spark, hot):
    t, _ = hot
    items = t["order_items"].select("product_id", "order_item_id")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = (items.repartitionByRange(n, "product_id", "order_item_id").withColumn("_pid", F.spark_partition_id())
             .filter("product_id = 1").select("_pid").distinct().count())
    assert parts > 1


def test_dedup_and_ranks_under_skew(hot):
    t, _ = hot
    items = t["order_items"].select("order_item_id", "product_id", "raw_product_name")
    key = F.lower(F.trim("raw_product_name"))
    surv = Q.dedup(items, key, "order_item_id")
    assert surv.count() == items.select(key).distinct().count()
    ranked = W.dist_ranks(items, "product_id", descending=False)
    w = Window.orderBy("product_id")
    exp = items.select("order_item_id", F.rank().over(w).alias("rank"), F.dense_rank().over(w).alias("dense_rank"))
    assert ranked.select("order_item_id", "rank", "dense_rank").exceptAll(exp).count() == 0
