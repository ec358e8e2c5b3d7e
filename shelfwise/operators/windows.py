"""Window operators WN-01..WN-17 and sorts SO-01..SO-04.

Skew and scale
--------------
A plain ``Window.partitionBy(k)`` puts every row of one key into one task,
and a window without ``partitionBy`` puts the whole input into one task.
So:

* totals beside detail rows (WN-01, WN-02, WN-15, WN-16) are grouped
  aggregates joined back (partial aggregation; one-row totals broadcast);
* running sums and row numbers over detail rows (WN-03/04/05/07) use
  :func:`prefix_sum`, a distributed scan: range-partition on (key, order),
  run the window inside each (partition, key) slice, then add the totals of
  the earlier slices of the same key.  No task ever holds more than one
  range partition, whatever the key skew;
* top-N per group filters a rank (Spark inserts a partial
  ``WindowGroupLimit`` before the shuffle, so a hot group sends only N rows
  per task);
* LAG/LEAD/changes/moving averages use :func:`with_halo`: range partitions
  that borrow the few rows before and after them, so a series as long as the
  data, or a key with a third of the rows, is still worked on by every task.
  ``bounded=True`` marks series whose length the calendar bounds (a row per
  day or month), for which a plain window is cheaper.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.metrics import diff_from_mean_half_up, mean_half_up, ratio_half_up
from shelfwise.session import ensure_checkpoint_dir


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _names(cols) -> list[str]:
    return [c for c in cols if isinstance(c, str)]


# ------------------------------------------------------------------ totals


def with_total(df: DataFrame, measure: str, out: str = "grand_total") -> DataFrame:
    """WN-01: each row beside the grand total (``OVER ()``), via a broadcast one-row aggregate."""
    tot = df.agg(F.sum(measure).alias(out))
    return df.crossJoin(F.broadcast(tot))


def with_group_total(df: DataFrame, measure: str, by: Sequence[str], out: str = "group_total",
                     fn=F.sum) -> DataFrame:
    """WN-02/WN-15: each row beside its group's aggregate, as aggregate + join.

    Equivalent to ``fn(measure) OVER (PARTITION BY by)`` but skew-safe.
    """
    g = df.groupBy(*by).agg(fn(measure).alias(out))
    return df.join(g, list(by))


def share(df: DataFrame, measure: str, out: str = "pct_of_total", digits: int = 2) -> DataFrame:
    """WN-16: ``100 * x / SUM(x) OVER ()`` with a broadcast total."""
    t = with_total(df, measure, "_total")
    return t.withColumn(out, ratio_half_up(measure, "_total", digits, scale=100)).drop("_total")


# ------------------------------------------------------------------ scans


def prefix_sum(df: DataFrame, value: Column | str | dict, order: Sequence, by: Sequence[str] = (), frame: str = "rows",
               out: str = "running_total", partitions: int | None = None) -> DataFrame:
    """Running ``SUM(value)`` per ``by`` in ``order`` without a per-key task.

    ``value`` may be a dict ``{output name: column}`` to run several sums in
    one scan.  ``frame="rows"`` needs ``order`` to be a total order inside a
    key (add a unique tiebreaker); ``frame="range"`` gives peers (ties) the
    same total, the SQL default frame (T12): peers are first summed to one row
    per (key, order value), those rows are scanned, and the totals join back,
    so no task holds all peers of one value.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = value if isinstance(value, dict) else {out: value}
    if frame == "range":
        return _range_sum(df, values, order, by, n)
    vcols = {f"_v{i}": (name, _c(v)) for i, (name, v) in enumerate(values.items())}
    order_cols = [_c(o) for o in order]
    sort_keys = [F.col(b) for b in by] + order_cols
    parted = (df.withColumns({k: c for k, (_n, c) in vcols.items()}).repartitionByRange(n, *sort_keys)
              .withColumn("_pid", F.spark_partition_id()))
    # The slice id is read twice below (local sums and slice totals).  Range
    # bounds come from a sample seeded by the RDD id, so two executions could
    # cut differently: a reliable checkpoint (in the shared checkpoint folder,
    # surviving executor loss) fixes one assignment for both readers.
    ensure_checkpoint_dir(spark)
    parted = parted.checkpoint(eager=True)
    w = Window.partitionBy("_pid", *by).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = parted.withColumns({f"_l{k}": F.sum(k).over(w) for k in vcols})
    totals = local.groupBy("_pid", *by).agg(*[F.sum(k).alias(f"_s{k}") for k in vcols])
    wo = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *by, *[F.coalesce(F.sum(f"_s{k}").over(wo), F.lit(0)).alias(f"_o{k}")
                                            for k in vcols])
    res = local.join(offsets, ["_pid", *by])
    res = res.withColumns({name: F.col(f"_l{k}") + F.col(f"_o{k}") for k, (name, _c2) in vcols.items()})
    return res.drop("_pid", *vcols, *[f"_l{k}" for k in vcols], *[f"_o{k}" for k in vcols])


def _range_sum(df: DataFrame, values: dict, order: Sequence, by: Sequence[str], n: int) -> DataFrame:
    """Running sums shared by peers, from one row per (key, order value)."""
    names = [*by, *[o for o in order if isinstance(o, str)]]
    if len(names) != len(by) + len(order):
        raise ValueError("frame='range' orders by column names")
    peers = df.groupBy(*names).agg(*[F.sum(_c(v)).alias(name) for name, v in values.items()])
    scanned = prefix_sum(peers, {f"_run_{name}": F.coalesce(F.col(name), F.lit(0)) for name in values}, list(order), by, "rows", partitions=n)
    right = scanned.select(*[F.col(c).alias(f"_peer_{c}") for c in names], *[F.col(f"_run_{name}").alias(name) for name in values])
    cond = [df[c].eqNullSafe(right[f"_peer_{c}"]) for c in names]
    return df.join(right, cond).drop(*[f"_peer_{c}" for c in names])


def running(df: DataFrame, measure: str, order: Sequence, by: Sequence[str] = (), frame: str = "rows",
            out: str = "running_total", bounded: bool = False) -> DataFrame:
    """WN-03 (ROWS) / WN-04 (RANGE, ties share the total) running totals.

    ``bounded=True`` is for series whose length is fixed by the calendar or a
    dimension (a row per day or month), not by the data: a plain window is
    then cheaper than the distributed scan.
    """
    if bounded:
        w = (Window.partitionBy(*by) if by else Window).orderBy(*[_c(o) for o in order])
        w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow) if frame == "rows" else \
            w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(out, F.sum(measure).over(w))
    return prefix_sum(df, measure, order, by, frame, out)


def number(df: DataFrame, order: Sequence, by: Sequence[str] = (), out: str = "row_num") -> DataFrame:
    """WN-05: ROW_NUMBER as a distributed running count (``order`` must be total)."""
    return prefix_sum(df, F.lit(1), order, by, "rows", out).withColumn(out, F.col(out).cast("bigint"))


# ------------------------------------------------------------------ ranks


def top_n(df: DataFrame, by: Sequence[str], order: Sequence, n: int, ties: bool = False,
          out: str = "rank_in_group") -> DataFrame:
    """WN-08 (ROW_NUMBER, single winner) / WN-09 (DENSE_RANK, keeps ties).

    ``order`` must end in a unique key when ``ties`` is False (T14).
    """
    w = Window.partitionBy(*by).orderBy(*[_c(o) for o in order])
    fn = F.dense_rank() if ties else F.row_number()
    return df.withColumn(out, fn.over(w)).filter(F.col(out) <= n)


# ------------------------------------------------------------------ series


def with_halo(df: DataFrame, order: Sequence, by: Sequence[str] = (), before: int = 0, after: int = 0) -> DataFrame:
    """``df`` in range partitions of (by, order), each with the rows it borrows from its neighbours.

    Adds ``_part`` and ``_halo``: a window over ``_part, by`` that looks
    ``before`` rows back and ``after`` rows ahead gives every row that is not
    borrowed (``_halo`` false) what the window over ``by`` alone would give.
    A slice is the rows of one key in one partition.  Only keys with several
    slices lend rows, so at most 2 x partitions slices do, and what they lend
    is ``before + after`` rows each; rows from further away are lent where the
    neighbour holds too few.  Partitions are fixed by a checkpoint, because
    range bounds are sampled.  Rows that tie on the order stay together.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [f"_k{i}" for i in range(len(by))]
    parts = df.withColumns({k: F.col(c) for k, c in zip(keys, by)})
    order = [_c(o) for o in order]
    parts = parts.repartitionByRange(n, *[F.col(k) for k in keys], *order).withColumn("_part", F.spark_partition_id()).checkpoint()
    slices = parts.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    of_key = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("_part")
    slices = slices.withColumn("_at", F.row_number().over(of_key)).withColumn("_upto", F.sum("_n").over(of_key))
    slices = slices.withColumn("_last", F.lead("_at").over(of_key).isNull()).filter((F.col("_at") > 1) | ~F.col("_last")).checkpoint()

    # the first and last rows of the slices that lend, with their place in the whole key
    lend = slices.select(*[F.col(k).alias(f"_l{k}") for k in keys], F.col("_part").alias("_from"), "_at", "_n", "_upto")
    cond = F.col("_part") == F.col("_from")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_l{k}"))
    edge = parts.join(F.broadcast(lend), cond)  # at most 2 x partitions rows
    edge = edge.withColumn("_place", F.row_number().over(Window.partitionBy("_part", *keys).orderBy(*order)))
    edge = edge.filter((F.col("_place") > F.col("_n") - before) | (F.col("_place") <= after))
    edge = edge.withColumn("_place", F.col("_upto") - F.col("_n") + F.col("_place")).drop(*[f"_l{k}" for k in keys], "_from", "_n", "_upto", "_part")
    steps = [j for j in range(-after, before + 1) if j]
    edge = edge.withColumn("_to", F.explode(F.array(*[F.col("_at") + F.lit(j) for j in steps])) if steps else F.lit(None).cast("int")).drop("_at")
    take = slices.select(*[F.col(k).alias(f"_t{k}") for k in keys], F.col("_at").alias("_slot"), F.col("_part"),
                         (F.col("_upto") - F.col("_n")).alias("_lo"), F.col("_upto").alias("_hi"))
    cond = F.col("_to") == F.col("_slot")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_t{k}"))
    near = ((F.col("_place") > F.col("_lo") - before) & (F.col("_place") <= F.col("_lo"))) | ((F.col("_place") > F.col("_hi")) & (F.col("_place") <= F.col("_hi") + after))
    halo = edge.join(F.broadcast(take), cond & near).select(*parts.columns, F.lit(True).alias("_halo"))
    return parts.withColumn("_halo", F.lit(False)).unionByName(halo)


def _over_series(df: DataFrame, order: Sequence, by: Sequence[str], before: int, after: int, bounded: bool, value, out: str) -> DataFrame:
    """``value(window)`` as the column ``out``; the window is ordered and partitioned, without a frame."""
    if bounded:
        w = (Window.partitionBy(*by) if by else Window).orderBy(*[_c(o) for o in order])
        return df.withColumn(out, value(w))
    near = with_halo(df, order, by, before, after)
    keys = [c for c in near.columns if c.startswith("_k") and c[2:].isdigit()]
    w = Window.partitionBy("_part", *keys).orderBy(*[_c(o) for o in order])
    return near.withColumn(out, value(w)).filter(~F.col("_halo")).drop("_halo", "_part", *keys)


def lagged(df: DataFrame, measure: str, order: Sequence, by: Sequence[str] = (), offset: int = 1,
           lead: bool = False, out: str | None = None, bounded: bool = False) -> DataFrame:
    """WN-10/11: previous (or next) *row*'s value; the first is NULL (T13)."""
    fn = F.lead if lead else F.lag
    return _over_series(df, order, by, 0 if lead else offset, offset if lead else 0, bounded,
                        lambda w: fn(measure, offset).over(w), out or (f"next_{measure}" if lead else f"prior_{measure}"))


def change(df: DataFrame, measure: str, order: Sequence, by: Sequence[str] = (), out: str = "change", bounded: bool = False) -> DataFrame:
    """WN-12: value - LAG(value)."""
    d = lagged(df, measure, order, by, out="_prev", bounded=bounded)
    return d.withColumn(out, F.col(measure) - F.col("_prev")).drop("_prev")


def pct_change(df: DataFrame, measure: str, order: Sequence, by: Sequence[str] = (), prior: str = "prior",
               out: str = "pct_change", digits: int = 1, bounded: bool = False) -> DataFrame:
    """WN-13: ``ROUND(100 * (x - prev) / NULLIF(prev, 0), 1)``; first row NULL."""
    d = lagged(df, measure, order, by, out=prior, bounded=bounded)
    return d.withColumn(out, ratio_half_up(F.col(measure) - F.col(prior), prior, digits, scale=100))


def moving_avg(df: DataFrame, measure: str, order: Sequence, k: int = 3, by: Sequence[str] = (),
               out: str = "moving_avg", bounded: bool = False) -> DataFrame:
    """WN-14: AVG over ROWS (k-1) PRECEDING .. CURRENT ROW."""
    return _over_series(df, order, by, k - 1, 0, bounded,
                        lambda w: F.avg(measure).over(w.rowsBetween(-(k - 1), Window.currentRow)), out)


def vs_peers(df: DataFrame, measure: str, by: Sequence[str], avg_out: str = "peer_average",
             diff_out: str = "difference_from_peers", digits: int = 2) -> DataFrame:
    """WN-15: AVG over the peer group and the difference from it, both rounded.

    The group's sum and count come from an aggregate joined back (skew-safe);
    the average and the difference are rounded exactly from them.
    """
    g = df.groupBy(*by).agg(F.sum(measure).alias("_ps"), F.count(measure).alias("_pn"))
    out = df.join(g, list(by))
    return (out.withColumn(avg_out, mean_half_up("_ps", "_pn", digits))
            .withColumn(diff_out, diff_from_mean_half_up(measure, "_ps", "_pn", digits)).drop("_ps", "_pn"))


# ------------------------------------------------------------------ sorts


def top_k(df: DataFrame, order: Sequence, k: int) -> DataFrame:
    """SO-02/SO-03: ORDER BY ... LIMIT k (TakeOrderedAndProject: a per-task top-k, then merge)."""
    return df.orderBy(*[_c(o) for o in order]).limit(k)


def dist_ranks(df: DataFrame, order_col: str, by: Sequence[str] = (), descending: bool = True,
               rank_out: str = "rank", dense_out: str = "dense_rank", bounded: bool = False) -> DataFrame:
    """RANK and DENSE_RANK of ``order_col`` per ``by`` without a per-group task.

    Rows are reduced to one row per (group, value) with its count; ranks
    come from two distributed prefix sums over those values (rows at or
    before the value, and distinct values at or before it), then join back
    on (group, value).  Equivalent to ``rank()``/``dense_rank()`` over
    ``PARTITION BY by ORDER BY order_col [DESC]``; NULL values sort last
    when descending and first when ascending, as Spark does.  ``bounded=True``
    uses plain rank windows, for inputs whose size is fixed by the calendar.
    """
    o = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_first()
    if bounded:
        w = (Window.partitionBy(*by) if by else Window).orderBy(o)
        return df.withColumn(rank_out, F.rank().over(w).cast("bigint")).withColumn(dense_out, F.dense_rank().over(w).cast("bigint"))
    # the input is read twice below: computed once, it is a row per entity
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint()
    vals = df.groupBy(*by, order_col).agg(F.count(F.lit(1)).alias("_n"))
    vals = prefix_sum(vals, {"_cum": F.col("_n"), "_dense": F.lit(1)}, [o], by, "rows")
    vals = vals.select(*by, order_col, (F.col("_cum") - F.col("_n") + 1).cast("bigint").alias(rank_out),
                       F.col("_dense").cast("bigint").alias(dense_out))
    # eqNullSafe keeps rows whose value is NULL (they get the NULL value's rank).
    keys = [*by, order_col]
    r = vals.select(*[F.col(c).alias(f"_r_{c}") for c in keys], rank_out, dense_out)
    cond = [df[c].eqNullSafe(r[f"_r_{c}"]) for c in keys]
    return df.join(r, cond).drop(*[f"_r_{c}" for c in keys])
