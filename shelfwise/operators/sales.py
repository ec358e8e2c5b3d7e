"""The trusted sales layer (RP-01) and its reconciliation (DQ-27).

Scale notes
-----------
* The fact (items) joins orders on ``order_id`` once; both sides are
  filtered first (completed orders, valid items) so the filters reach the
  parquet scans.
* Dimensions are attached only when a caller asks for them.  Reports
  aggregate at the fact's keys first and attach labels afterwards, so the
  dimension joins see one row per key instead of one row per line.
* No explicit broadcast of a dimension that grows with the data: AQE
  turns a join into a broadcast at runtime only when the measured size is
  under ``spark.sql.autoBroadcastJoinThreshold``.
* Reports that count orders deal the lines by order (:func:`dealt`): the
  orders of a group are then counted without a second shuffle of the lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.metrics import completed, month_label, round_money, valid_item
from shelfwise.sources.model import Model


def completed_orders(m: Model) -> DataFrame:
    return (m.orders.filter(completed("status", m.completed))
            .select("order_id", "customer_id", "channel",
                    F.to_date("order_date").alias("order_date"),
                    month_label("order_date").alias("sales_month")))


def valid_items(m: Model) -> DataFrame:
    return m.items.filter(valid_item("quantity", "unit_price"))


#: Stored bytes behind one partition of :func:`dealt`; sources that cannot tell their size claim more than MOST_BYTES.
PART_BYTES, MOST_BYTES = 4 << 20, 1 << 50


def dealt(key: str, *dfs: DataFrame) -> list[DataFrame]:
    """Each frame dealt by ``key``, all into one partition for every PART_BYTES of their sources.

    Adaptive execution merges shuffle partitions up to a size of its own (64 MB
    compressed unless set), and a task's sorts and hash tables with them.  Here
    their size stays as the tables grow, and frames dealt together join without
    another shuffle.  Without a known size the session's number of partitions holds.
    """
    leaves = [df._jdf.queryExecution().optimizedPlan().collectLeaves() for df in dfs]
    size = sum(int(str(some.apply(i).stats().sizeInBytes())) for some in leaves for i in range(some.size()))
    parts = [] if size > MOST_BYTES else [max(1, -(-size // PART_BYTES))]
    return [df.repartition(*parts, key) for df in dfs]


def sales_lines(m: Model, dims: tuple[str, ...] = (), by_order: bool = False) -> DataFrame:
    """Valid lines of completed orders, with the requested dimensions.

    ``dims`` may hold ``store``, ``product``, ``customer``.  Stores and
    products join inner (the reference view drops lines without them);
    customers join left (anonymous sales stay).  ``by_order`` deals the lines
    by order in small partitions.
    """
    items, orders = valid_items(m), completed_orders(m)
    if by_order:
        items, orders = dealt("order_id", items, orders)
    lines = items.join(orders, "order_id")
    if "store" in dims:
        lines = lines.join(m.stores, "store_id")
    if "product" in dims:
        lines = lines.join(m.products, "product_id")
    if "customer" in dims:
        lines = lines.join(m.customers.select("customer_id", "customer_name"), "customer_id", "left")
    return lines


def order_totals(m: Model, by: Sequence[str]) -> DataFrame:
    """Per group of valid completed lines: distinct ``completed_orders``, ``units`` and exact ``revenue``.

    The lines are dealt by order, so one row per order and group needs no
    shuffle; its rows are counted and only these partial results shuffle.
    """
    per_order = (sales_lines(m, by_order=True).groupBy("order_id", *by)
                 .agg(F.sum("quantity").alias("units"), F.sum("gross_revenue").alias("revenue")))
    return per_order.groupBy(*by).agg(F.count(F.lit(1)).alias("completed_orders"), F.sum("units").cast("bigint").alias("units"),
                                      F.sum("revenue").alias("revenue"))


VIEW_COLUMNS = ("order_id", "order_date", "sales_month", "channel", "region_id", "region_name", "store_id",
                "store_name", "store_city", "customer_id", "customer_name", "product_id", "product_name",
                "category_name", "department", "line_number", "quantity", "unit_price", "discount",
                "gross_revenue")


def valid_sales_view(m: Model) -> DataFrame:
    """RP-01: one row per valid item line of a completed order, all dimensions."""
    lines = sales_lines(m, ("store", "product", "customer"))
    return lines.select(*[F.col("city").alias("store_city") if c == "store_city" else F.col(c)
                          for c in VIEW_COLUMNS])


def reconcile(view: DataFrame, source: DataFrame, measure: str = "gross_revenue") -> DataFrame:
    """DQ-27: row count and total of the view against the source logic.

    Each side is one global aggregate (partial per task, one final row);
    the two one-row results are combined with a cross join of one row.
    """
    a = view.agg(F.count(F.lit(1)).alias("view_rows"), F.sum(measure).alias("_va"))
    b = source.agg(F.count(F.lit(1)).alias("source_rows"), F.sum(measure).alias("_sa"))
    return (a.crossJoin(b)
            .select("view_rows", "source_rows",
                    round_money("_va").alias("view_gross_revenue"),
                    round_money("_sa").alias("source_gross_revenue"),
                    (F.col("view_rows") - F.col("source_rows")).alias("row_difference"),
                    round_money(F.coalesce(F.col("_va"), F.lit(0)) - F.coalesce(F.col("_sa"), F.lit(0)))
                    .alias("revenue_difference")))


def source_sales(m: Model) -> DataFrame:
    """The reconciliation's second path: orders x items only, no dimensions."""
    return valid_items(m).join(m.orders.filter(completed("status", m.completed)).select("order_id"), "order_id")


#: Ranges into which a level of :func:`locate_differences` cuts each range that differs, and how many it narrows further.
FAN, MOST_RANGES = 256, 256


def _fingerprints(df: DataFrame, key: str, cols: Sequence[str], cell: Column) -> DataFrame:
    """Per ``_cell``: rows, and two order-free combinations of the rows' 64-bit hashes."""
    h = F.xxhash64(key, *cols)
    return df.groupBy(cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n"), F.bit_xor(h).alias("_x"), F.sum(h.cast("decimal(20,0)")).alias("_s"))


def _unequal(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    """The cells whose fingerprints differ or that one side lacks."""
    a, b = (x.select(on, F.struct("_n", "_x", "_s").alias(side)) for x, side in ((a, "_a"), (b, "_b")))
    return a.join(b, on, "full").filter(~F.col("_a").eqNullSafe(F.col("_b")))


def _within(df: DataFrame, key: str, ranges: Sequence[tuple[int, int]]) -> DataFrame:
    """Rows of some key ranges; neighbouring ranges are one condition, which reaches the scan."""
    joined: list[list[int]] = []
    for lo, hi in sorted(ranges):
        if joined and joined[-1][1] + 1 >= lo:
            joined[-1][1] = max(joined[-1][1], hi)
        else:
            joined.append([lo, hi])
    cond = F.lit(False)
    for lo, hi in joined:
        cond = cond | F.col(key).between(lo, hi)
    return df.filter(cond)


def locate_differences(left: DataFrame, right: DataFrame, key: str, cols: Sequence[str], leaf: int = 1024) -> DataFrame:
    """DQ-27: the keys at which two tables differ, found through hashes of key ranges.

    The key range is cut into FAN ranges, each side reduces its rows to a
    count and two order-free hashes per range, and only ranges that are not
    equal are cut and read again, until they are ``leaf`` keys wide; the key
    condition reaches the scans.  When more than MOST_RANGES ranges of a
    level differ, narrowing stops and the differing part is compared as it
    is.  Then the rows of what is left are compared per key:
    ``key, left_rows, right_rows, difference`` with ``changed``,
    ``only_left`` or ``only_right``.  Keys are integers and may repeat (a
    key differs when its rows do, as a multiset); NULL keys are one key.
    At most FAN x MOST_RANGES range numbers of a level reach the driver.
    """
    bounds = left.select(key).unionByName(right.select(key)).agg(F.min(key), F.max(key)).first()
    a, b = left, right
    if bounds[0] is not None:
        ranges = [(int(bounds[0]), int(bounds[1]))]
        width = ranges[0][1] - ranges[0][0] + 1
        base, whole = ranges[0][0], ranges
        while width > leaf:
            width = -(-width // FAN)
            cell = F.expr(f"(`{key}` - {base}) div {width}")
            a, b = _within(left, key, whole), _within(right, key, whole)
            bad = _unequal(_fingerprints(a, key, cols, cell), _fingerprints(b, key, cols, cell), "_cell").select("_cell").limit(MOST_RANGES + 1).collect()
            if len(bad) > MOST_RANGES:
                break
            whole = [(base + r["_cell"] * width, base + (r["_cell"] + 1) * width - 1) for r in bad]
        a, b = (x.filter(F.col(key).isNull()).unionByName(_within(x, key, whole)) for x in (left, right))
    sides = [_fingerprints(x, key, cols, F.col(key)).withColumn("_none", F.col("_cell").isNull()).fillna({"_cell": 0}) for x in (a, b)]
    l, r = (x.select("_cell", "_none", F.struct("_n", "_x", "_s").alias(n)) for x, n in zip(sides, ("_a", "_b")))
    out = l.join(r, ["_cell", "_none"], "full").filter(~F.col("_a").eqNullSafe(F.col("_b")))
    said = F.when(F.col("_b").isNull(), "only_left").when(F.col("_a").isNull(), "only_right").otherwise("changed")
    return out.select(F.when(~F.col("_none"), F.col("_cell")).alias(key), F.coalesce("_a._n", F.lit(0)).alias("left_rows"), F.coalesce("_b._n", F.lit(0)).alias("right_rows"), said.alias("difference"))
