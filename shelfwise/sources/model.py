"""Retail data model over the driver tables.

Operators in :mod:`shelfwise.operators` are written against retail names
(orders, items, stores, products, customers, returns).  This adapter maps
the driver's star schema onto them with projections and small dimension
joins only; every mapped frame stays lazy, so Catalyst prunes the unused
columns and pushes filters down into the parquet scans.

Mapping (fixed):
  order      orders (o_orderkey, o_custkey, o_orderdate, o_orderstatus)
  completed  o_orderstatus = 'F'
  channel    o_orderpriority
  item       lineitem (one row per line; store = supplier of the line)
  revenue    l_extendedprice x (1 - l_discount), exact DECIMAL
  product    part: category = p_brand, department = p_type
  store      supplier -> nation (city) -> region
  customer   customer -> nation (city); segment = c_mktsegment
  return     lineitem with l_returnflag = 'R', dated l_shipdate, refund = revenue
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.metrics import net_line_revenue
from shelfwise.sources.driver import Tables

# Fixed values of the mapping.
COMPLETED = "F"
RETURNED = "R"


@dataclass
class Model:
    """Retail-named frames plus the status value that means 'completed'."""

    orders: DataFrame
    items: DataFrame
    stores: DataFrame
    products: DataFrame
    customers: DataFrame
    returns: DataFrame
    regions: DataFrame
    completed: str = "completed"
    extra: dict = field(default_factory=dict)


def regions(t: Tables) -> DataFrame:
    return t.region.select(F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name"))


def _nations(t: Tables, with_region: bool = True) -> DataFrame:
    # nation (25 rows) and region (5 rows) are fixed-size dimensions of the
    # TPC-H schema at every scale factor: broadcasting them is size-bounded.
    n = t.nation.select("n_nationkey", F.col("n_name").alias("city"), F.col("n_regionkey").alias("region_id"))
    return F.broadcast(n.join(F.broadcast(regions(t)), "region_id", "left") if with_region else n)


def stores(t: Tables) -> DataFrame:
    s = t.supplier.select(F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"), "s_nationkey")
    return (s.join(_nations(t), s.s_nationkey == F.col("n_nationkey"), "left")
            .select("store_id", "store_name", "region_id", "region_name", "city"))


def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("category_name"), F.col("p_type").alias("department"),
        F.col("p_retailprice").alias("list_price"))


def customers(t: Tables) -> DataFrame:
    c = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
                          "c_nationkey", F.col("c_mktsegment").alias("segment"),
                          F.col("c_acctbal").alias("balance"))
    return (c.join(_nations(t, with_region=False), c.c_nationkey == F.col("n_nationkey"), "left")
            .select("customer_id", "customer_name", "city", "segment", "balance"))


def orders(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"), F.col("o_orderpriority").alias("channel"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("order_total"))


def items(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("unit_price"),
        F.col("l_discount").alias("discount"),
        net_line_revenue("l_extendedprice", "l_discount").alias("gross_revenue"),
        F.col("l_returnflag").alias("return_flag"), F.col("l_shipdate").alias("ship_date"),
        F.when(F.col("l_returnflag") == RETURNED, net_line_revenue("l_extendedprice", "l_discount")).alias("item_refund"))


def returns(t: Tables) -> DataFrame:
    return (t.lineitem.filter(F.col("l_returnflag") == RETURNED)
            .select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
                    F.col("l_suppkey").alias("store_id"), F.col("l_shipdate").alias("return_date"),
                    net_line_revenue("l_extendedprice", "l_discount").alias("refund_amount")))


def from_driver(t: Tables) -> Model:
    return Model(orders=orders(t), items=items(t), stores=stores(t), products=products(t),
                 customers=customers(t), returns=returns(t), regions=regions(t), completed=COMPLETED)


# ---------------------------------------------------------------- the reference's own retail schemas


def from_retail_tables(orders: DataFrame, order_items: DataFrame, stores: DataFrame, products: DataFrame,
                       customers: DataFrame | None = None, returns: DataFrame | None = None,
                       regions: DataFrame | None = None, categories: DataFrame | None = None,
                       completed: str = "completed") -> Model:
    """A :class:`Model` over tables shaped like the reference's retail/capstone schemas.

    The store sits on the order there, so it is carried onto each item
    (one join on ``order_id``); revenue is ``quantity x unit_price`` minus
    ``discount_amount`` when that column exists (B3/B4).
    """
    spark = orders.sparkSession
    oi = order_items
    disc = F.coalesce(F.col("discount_amount"), F.lit(0)) if "discount_amount" in oi.columns else F.lit(0)
    rev = F.col("quantity") * F.col("unit_price") - disc
    items_ = (oi.join(orders.select("order_id", "store_id"), "order_id", "left")
              .select("order_id", F.col("order_item_id").alias("line_number"), "order_item_id", "product_id",
                      "store_id", "quantity", "unit_price", disc.alias("discount"), rev.alias("gross_revenue"),
                      F.lit(None).cast("string").alias("return_flag"), F.lit(None).cast("timestamp_ntz").alias("ship_date"),
                      *([F.col("raw_product_name")] if "raw_product_name" in oi.columns else [])))
    if regions is None:
        regions = spark.createDataFrame([], "region_id int, region_name string")
    st = stores
    if "region_id" not in st.columns:
        st = st.withColumn("region_id", F.lit(None).cast("int"))
    st = st.join(regions, "region_id", "left").select("store_id", "store_name", "region_id", "region_name",
                                                      F.col("city") if "city" in st.columns else F.lit(None).alias("city"))
    pr = products
    if categories is not None and "category_id" in pr.columns:
        pr = pr.join(categories, "category_id", "left")
    if "category_name" not in pr.columns:
        pr = pr.withColumn("category_name", F.col("category"))
    if "department" not in pr.columns:
        pr = pr.withColumn("department", F.col("category_name"))
    price = "list_price" if "list_price" in pr.columns else ("current_price" if "current_price" in pr.columns else "price")
    pr = pr.select("product_id", "product_name", "category_name", "department", F.col(price).alias("list_price"))
    if customers is None:
        customers = spark.createDataFrame([], "customer_id int, customer_name string")
    cu = customers.select("customer_id", "customer_name",
                          (F.col("city") if "city" in customers.columns else F.lit(None).cast("string")).alias("city"),
                          (F.col("loyalty_tier") if "loyalty_tier" in customers.columns
                           else F.lit(None).cast("string")).alias("segment"),
                          F.lit(None).cast("double").alias("balance"),
                          *[F.col(c) for c in ("email", "phone", "birth_date") if c in customers.columns])
    od = orders.select("order_id", "customer_id", F.col("order_date").cast("timestamp_ntz").alias("order_date"),
                       (F.col("channel") if "channel" in orders.columns else F.lit(None).cast("string")).alias("channel"),
                       "status", F.lit(None).cast("double").alias("order_total"))
    if returns is None:
        rt = spark.createDataFrame([], "order_item_id int, order_id int, product_id int, store_id int, return_date date, "
                                       "refund_amount decimal(9,2)")
    else:
        rt = (returns.join(items_.select("order_item_id", "order_id", "product_id", "store_id"), "order_item_id")
              .select("order_item_id", "order_id", "product_id", "store_id", "return_date", "refund_amount"))
    return Model(orders=od, items=items_, stores=st, products=pr, customers=cu, returns=rt, regions=regions,
                 completed=completed)
