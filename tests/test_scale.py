"""Mechanisms that keep work near rows plus results: halo windows, interval bins, single scans, merged states, narrowed comparison."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise.catalog.base import REGISTRY
from shelfwise.operators import aggs as A
from shelfwise.operators import joins as J
from shelfwise.operators import quality as Q
from shelfwise.operators import reports as rp
from shelfwise.operators import sales as S
from shelfwise.operators import windows as W
from shelfwise.plans import evidence as P
from shelfwise.sources.driver import load
from shelfwise.sources.model import from_driver

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


# ------------------------------------------------------------------ halo


@pytest.fixture(scope="module")
def series(spark):
    """A hot key with a third of the rows, a NULL key, keys of one and two rows, NULL orders and measures."""
    rnd = random.Random(2)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rnd.randint(0, 900)}"
        data.append((key, None if i == 17 else (i * 7919) % 100_003, i, None if i % 11 == 0 else rnd.randint(-50, 50)))
    return spark.createDataFrame(data, "k string, o int, id int, v int").cache()


@pytest.mark.parametrize("by", [["k"], []])
@pytest.mark.parametrize("down", [False, True])
def test_halo_windows_equal_plain_windows(series, by, down):
    order = [F.col("o").desc_nulls_first() if down else "o", "id"]
    w = (Window.partitionBy(*by) if by else Window).orderBy(*[F.col(c) if isinstance(c, str) else c for c in order])
    for offset in (1, 4):
        for lead in (False, True):
            got = W.lagged(series, "v", order, by, offset=offset, lead=lead, out="x")
            want = series.withColumn("x", (F.lead if lead else F.lag)("v", offset).over(w))
            assert got.columns == want.columns and rows(got) == rows(want)
    got = W.moving_avg(series, "v", order, 5, by, out="x")
    assert rows(got) == rows(series.withColumn("x", F.avg("v").over(w.rowsBetween(-4, 0))))
    assert rows(W.change(series, "v", order, by, out="x")) == rows(series.withColumn("x", F.col("v") - F.lag("v").over(w)))


def test_a_halo_reaches_over_short_neighbours(spark):
    """More partitions than rows of a key: borrowed rows come from several slices away."""
    df = spark.range(12).selectExpr("id", "id * 10 AS v")
    w = Window.orderBy("id")
    for offset in (3, 7, 30):
        assert rows(W.lagged(df, "v", ["id"], offset=offset, out="x")) == rows(df.withColumn("x", F.lag("v", offset).over(w)))
        assert rows(W.lagged(df, "v", ["id"], offset=offset, lead=True, out="x")) == rows(df.withColumn("x", F.lead("v", offset).over(w)))
    assert W.lagged(df.limit(0), "v", ["id"], out="x").count() == 0


def test_the_hot_key_is_worked_on_in_slices(spark, series):
    near = W.with_halo(series, ["o", "id"], ["k"], before=2)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = near.filter("k = 'hot' AND NOT _halo").groupBy("_part").count().collect()
    assert len(hot) > 1 and max(r["count"] for r in hot) <= 2 * 3000 / parts
    assert near.filter("NOT _halo").count() == 3000 and near.filter("_halo").count() <= 2 * 2 * parts
    text = plan(W.lagged(series, "v", ["o", "id"], ["k"], out="x"))
    assert "SinglePartition" not in text and re.search(r"Window \[lag.*\], \[_part#\d+, _k0#\d+\]", text)


# ------------------------------------------------------------------ interval join


def test_interval_join_against_every_pair(spark):
    rnd = random.Random(5)
    day = dt.date(1990, 1, 1)
    periods = [(i, day + dt.timedelta(a), day + dt.timedelta(a + n)) for i, (a, n) in enumerate([(rnd.randint(-400, 9000), rnd.choice([0, 0, 1, 6, 30, 31, 400, 7300])) for _ in range(300)])]
    periods += [(900, None, day), (901, day, None), (902, day + dt.timedelta(5), day), (903, day, day)]
    dates = [day + dt.timedelta(rnd.randint(-30, 9000)) for _ in range(400)] + [day, day, None]
    p = spark.createDataFrame(periods, "pid int, a date, b date")
    d = spark.createDataFrame([(i, x) for i, x in enumerate(dates)], "id int, d date")
    want = set()
    for i, x in enumerate(dates):
        hit = [q for q, a, b in periods if x and a and b and a <= x <= b]
        want |= {(i, q) for q in hit} or {(i, None)}
    got = [(r["id"], r["pid"]) for r in J.range_attribute(d, "d", p, "a", "b").collect()]
    assert len(got) == len(want) and set(got) == want
    stamps = d.withColumn("d", (F.col("d").cast("timestamp") + F.expr("INTERVAL 13 HOURS")).cast("timestamp_ntz"))
    got = J.range_attribute(stamps, "d", p.withColumn("b", F.col("b").cast("timestamp_ntz")), "a", "b")
    assert rows(got.select("id", "pid")) == rows(stamps.join(p, (F.col("d") >= F.col("a")) & (F.col("d") <= F.col("b").cast("timestamp_ntz")), "left").select("id", "pid"))


def test_interval_bins_do_not_grow_with_the_length_of_a_period(spark):
    """Twenty years are two rows; a month with 10,000 periods of a day makes no more candidates than matches."""
    day = dt.date(1992, 3, 1)
    p = spark.createDataFrame([(i, day + dt.timedelta(i % 31), day + dt.timedelta(i % 31)) for i in range(10_000)] + [(-1, dt.date(1980, 1, 1), dt.date(2000, 1, 1))], "pid int, a date, b date")
    bins = J.period_bins(p, "a", "b").cache()
    assert bins.count() <= 2 * p.count() and bins.filter("pid = -1").count() <= 2
    d = spark.range(31).select(F.date_add(F.lit(day), F.col("id").cast("int")).alias("d"))
    levels = d.select("d", F.explode(F.sequence(F.lit(0), F.lit(J.RANGE_LEVELS))).alias("l")).withColumn("x", F.expr("shiftright(unix_date(d), l)"))
    candidates = levels.join(bins, (F.col("l") == F.col("_level")) & (F.col("x") == F.col("_bin"))).count()
    results = J.range_attribute(d, "d", p, "a", "b").count()
    assert results == 10_000 + 31 and candidates <= results + 31
    assert "NestedLoop" not in plan(J.range_attribute(d, "d", p, "a", "b")) and "Cartesian" not in plan(J.range_attribute(d, "d", p, "a", "b"))


# ------------------------------------------------------------------ single scans


def test_profile_scans_once_and_counts_exactly(spark):
    schema = "a int, b string, c double, d date"
    df = spark.createDataFrame([(1, "x", 0.0, None), (1, None, -0.0, dt.date(2020, 1, 1)), (None, "", float("nan"), dt.date(2020, 1, 1)), (2, "it's", None, None)], schema)
    got = {r["column_name"]: tuple(r)[1:] for r in Q.profile(df, df.columns).collect()}
    assert got == {"a": (4, 3, 1, 2), "b": (4, 3, 1, 3), "c": (4, 3, 1, 2), "d": (4, 2, 2, 1)}
    assert {tuple(r)[1:] for r in Q.profile(df.limit(0), df.columns).collect()} == {(0, 0, 0, 0)}
    t = load(spark, SMALL)
    assert plan(Q.profile(t.orders, t.orders.columns)).count("FileScan") == 1


def test_order_population_scans_the_orders_once(spark):
    assert plan(rp.order_population(from_driver(load(spark, SMALL)))).count("FileScan") == 1


def test_survivors_are_found_on_narrow_columns(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("A", 1, "y"), ("a", 1, "b"), (None, 5, "n"), (None, None, "m"), ("z", None, "only")], "name string, id int, rest string")
    out = Q.dedup(df, F.lower("name"), "id")
    assert out.columns == ["normalized_key", "name", "id", "rest"]
    # of rows that tie on the order the smallest other columns survive: 'A' sorts before 'a'
    assert sorted(map(str, out.select("normalized_key", "name", "id").collect())) == sorted(map(str, spark.createDataFrame(
        [("a", "A", 1), (None, None, 5), ("z", "z", None)], "normalized_key string, name string, id int").collect()))
    t = load(spark, SMALL)
    text = plan(Q.dedup(t.part, F.lower(F.trim("p_name")), "p_partkey"))
    assert "SortAggregate" not in text and "ObjectHash" not in text and "min(p_partkey" in text


# ------------------------------------------------------------------ merged states


def test_a_coarser_grain_needs_no_second_scan(spark):
    rnd = random.Random(9)
    df = spark.createDataFrame([(f"s{rnd.randint(0, 9)}", rnd.choice(["n", "s", None]), rnd.choice([None, *range(0, 200_000, 7919)]), rnd.randint(0, 9)) for _ in range(4000)],
                               "store string, region string, oid bigint, v int")
    state = A.distinct_state(df, ["store", "region"], "oid", ["v"])
    for cols in (["store", "region"], ["region"], ["store"], []):
        assert rows(A.from_state(state, cols, "oid", {"t": "v"})) == rows(A.rollup_report(df, cols, "oid", {"t": "v"}))
    t = load(spark, SMALL)
    kept = A.distinct_state(t.lineitem, ["l_suppkey", "l_returnflag"], "l_orderkey", ["l_quantity"]).checkpoint()
    for cols in (["l_suppkey"], ["l_returnflag"]):  # both grains from what one scan left
        assert "FileScan" not in plan(A.from_state(kept, cols, "l_orderkey", {"q": "l_quantity"}))
        assert rows(A.from_state(kept, cols, "l_orderkey", {"q": "l_quantity"})) == rows(A.rollup_report(t.lineitem, cols, "l_orderkey", {"q": "l_quantity"}))


def test_the_state_of_scattered_values_is_no_larger_than_the_detail(spark):
    """Many fine groups that each hold a few values, far apart: nothing of fixed size per group and stretch of values."""
    df = spark.range(6000).select((F.col("id") % 300).alias("store"), (F.col("id") % 3).alias("region"), (F.col("id") * 40_009).alias("oid"), F.lit(2).alias("v"))
    state = A.distinct_state(df, ["store", "region"], "oid", ["v"])
    held = state.agg(F.sum(sum((F.octet_length(F.col(c).cast("binary") if t == "string" else F.col(c)) if t in ("string", "binary") else F.lit(16) for c, t in state.dtypes), F.lit(0)))).first()[0]
    assert state.count() <= 6000 and held < 6000 * 100
    assert rows(A.from_state(state, ["region"], "oid", {"t": "v"})) == rows(A.rollup_report(df, ["region"], "oid", {"t": "v"}))


def test_dealt_partitions_keep_their_size(spark, tmp_path, monkeypatch):
    spark.range(200_000).select((F.col("id") * 7919 % 200_003).alias("k")).repartition(1).write.parquet(str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    four = spark.read.parquet(*[str(tmp_path / "one")] * 4)
    monkeypatch.setattr(S, "PART_BYTES", 100_000)
    (a,), (b,), both = S.dealt("k", one), S.dealt("k", four), S.dealt("k", one, four)
    n, m = a.rdd.getNumPartitions(), b.rdd.getNumPartitions()
    assert n > 1 and 4 * n - 4 <= m <= 4 * n and len({x.rdd.getNumPartitions() for x in both}) == 1
    assert b.count() == 800_000 and rows(a.agg(F.sum("k"))) == rows(one.agg(F.sum("k")))
    unknown = spark.createDataFrame([(1,), (None,)], "k long").checkpoint()
    assert rows(S.dealt("k", unknown)[0]) == rows(unknown)


def test_orders_of_a_group_are_counted_where_the_lines_lie(spark, monkeypatch):
    """Orders that come twice (with another month or not), null keys and groups: as a distinct count of the joined lines."""
    rnd = random.Random(4)
    day = dt.datetime(2001, 1, 20)
    orders = [(rnd.choice([None, *range(60)]), 1, rnd.choice("FFO"), day + dt.timedelta(days=rnd.choice([0, 0, 30])), rnd.choice([None, "a", "b"])) for _ in range(150)]
    lines = [(rnd.choice([None, *range(60)]), 1, rnd.choice([None, *range(5)]), 1, float(rnd.randint(0, 9)), rnd.choice([None, 10.25, 7.5]), 0.05) for _ in range(900)]
    t = load(spark, SMALL)
    t._cache["orders"] = spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string").withColumn("o_totalprice", F.lit(1.0))
    t._cache["lineitem"] = (spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double")
                            .withColumns({"l_tax": F.lit(0.0), "l_returnflag": F.lit("N"), "l_linestatus": F.lit("O"), "l_shipdate": F.lit(day)}))
    m = from_driver(t)
    for by in (["sales_month", "store_id", "channel"], ["store_id", "sales_month"], ["store_id"]):
        exp = S.sales_lines(m).groupBy(*by).agg(F.count_distinct("order_id").alias("completed_orders"), F.sum("quantity").cast("bigint").alias("units"), F.sum("gross_revenue").alias("revenue"))
        assert rows(S.order_totals(m, by)) == rows(exp) != []
    monkeypatch.setattr(S, "PART_BYTES", 4_000)
    for key in ("rp_region_store_channel", "rp_region_store", "rp_store_month", "agg_regroup_coarser"):
        shuffles = {x for x in re.findall(r"hashpartitioning\(([^)]*)\)", plan(REGISTRY[key].build(spark, SMALL))) if "order" in x}
        # lines and orders meet by order alone, in partitions that the session did not set; no second shuffle by group and order
        assert shuffles and all(re.fullmatch(r"\w*order\w*#\d+L, (?!8$)\d+", x) for x in shuffles), shuffles


# ------------------------------------------------------------------ narrowed comparison


def test_one_changed_row_among_a_million(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "a")
    spark.range(0, 1_000_000, 1, 8).selectExpr("id", "id * 3 AS v").write.parquet(path)
    a = spark.read.parquet(path)
    b = a.withColumn("v", F.when(F.col("id") == 765_432, F.lit(-1)).otherwise(F.col("v"))).filter("id <> 12")
    read, real = [], S._within

    def within(df, key, ranges):
        read.append(sum(hi - lo + 1 for lo, hi in ranges))
        return real(df, key, ranges)

    monkeypatch.setattr(S, "_within", within)
    got = sorted(map(tuple, S.locate_differences(a, b, "id", ["v"]).collect()))
    assert got == [(12, 1, 0, "only_left"), (765_432, 1, 1, "changed")]
    assert read[0] == 1_000_000 and max(read[2:]) <= 2 * -(-1_000_000 // S.FAN)  # only differing ranges are read again
    assert "PushedFilters: [Or" in plan(real(a, "id", [(1, 5), (900, 1000)]))
    assert S.locate_differences(a, a, "id", ["v"]).count() == 0


def test_differences_of_repeated_null_and_missing_keys(spark, monkeypatch):
    schema = "id bigint, v string"
    a = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "n"), (-5, None)], schema)
    b = spark.createDataFrame([(1, "a"), (2, "b"), (None, "m"), (9 * 10**9, "far"), (-5, None)], schema)
    want = sorted(map(str, [(1, 2, 1, "changed"), (None, 1, 1, "changed"), (9 * 10**9, 0, 1, "only_right")]))
    assert sorted(str(tuple(r)) for r in S.locate_differences(a, b, "id", ["v"]).collect()) == want
    monkeypatch.setattr(S, "MOST_RANGES", 0)  # too many differ to narrow further
    assert sorted(str(tuple(r)) for r in S.locate_differences(a, b, "id", ["v"]).collect()) == want
    assert S.locate_differences(a.limit(0), a.limit(0), "id", ["v"]).count() == 0
    assert S.locate_differences(a, a.limit(0), "id", ["v"]).filter("difference = 'only_left'").count() == 4


# ------------------------------------------------------------------ bucketed tables


def test_bucketed_tables_go_with_their_block(spark):
    from shelfwise import catalog
    before = {t.name for t in spark.catalog.listTables()}
    got = catalog.queries()["pf_join_layout"](spark, SMALL).count()
    assert got > 0 and {t.name for t in spark.catalog.listTables()} == before
    with pytest.raises(ZeroDivisionError), P.bucketed_scope(spark) as write:
        write(spark.range(10), "shelfwise_block", 2, "id")
        1 / 0
    assert {t.name for t in spark.catalog.listTables()} == before
