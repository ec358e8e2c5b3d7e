"""Edge cases the driver data cannot exercise."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise.functions import exprs as X
from shelfwise.functions import metrics as B
from shelfwise.operators import aggs as A
from shelfwise.operators import joins as J
from shelfwise.operators import quality as Q
from shelfwise.operators import windows as W


def test_count_if_on_empty_input_is_zero(spark):  # T1
    df = spark.createDataFrame([], "x int")
    r = A.count_where(df, {"neg": F.col("x") < 0}).collect()[0]
    assert r.neg == 0


def test_weekday_full_name(spark):  # T3
    df = spark.createDataFrame([(dt.date(2026, 6, 22),)], "d date")
    assert df.select(B.weekday_name("d")).collect()[0][0] == "Monday"


def test_month_end_whole_months(spark):  # T4
    df = spark.createDataFrame([(dt.datetime(2026, 1, 31), dt.datetime(2026, 2, 28))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(X.timestampdiff("MONTH", "a", "b")).collect()[0][0] == 0


def test_zero_denominator_is_null(spark):  # T5
    df = spark.createDataFrame([(5, 0)], "n int, d int")
    assert df.select(B.safe_ratio("n", "d", 2)).collect()[0][0] is None


def test_greatest_propagates_null(spark):  # T6
    df = spark.createDataFrame([(None,), (3,)], "q int")
    got = [r[0] for r in df.select(X.greatest_strict("q", F.lit(0))).collect()]
    assert got == [None, 3]


def test_not_in_with_null_returns_nothing(spark):  # T11
    a = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    b = spark.createDataFrame([(1,), (None,)], "k2 int")
    r = J.not_in_vs_anti(a, "k", b, "k2").collect()[0]
    assert (r.not_in_rows, r.not_exists_rows) == (0, 2)


def test_running_total_ties_range_vs_rows(spark):  # T12
    df = spark.createDataFrame([(1, "2026-01-01", 10), (2, "2026-01-01", 5), (3, "2026-01-02", 1)], "id int, d string, v int")
    rng = {r.id: r.running_total for r in W.running(df, "v", ["d"], frame="range").collect()}
    rows = {r.id: r.running_total for r in W.running(df, "v", ["d", "id"], frame="rows").collect()}
    assert rng == {1: 15, 2: 15, 3: 16}
    assert rows == {1: 10, 2: 15, 3: 16}


def test_lag_is_previous_row_not_previous_month(spark):  # T13
    df = spark.createDataFrame([("2026-01", 10), ("2026-03", 30)], "m string, v int")
    got = {r.m: r.prior_v for r in W.lagged(df, "v", ["m"]).collect()}
    assert got == {"2026-01": None, "2026-03": 10}


def test_ranks_with_ties_match_window(spark):
    data = [(i, g, v) for i, (g, v) in enumerate([("a", 5), ("a", 5), ("a", 3), ("a", None), ("b", 7), ("b", 7), ("b", 7)])]
    df = spark.createDataFrame(data, "id int, g string, v int")
    got = {r.id: (r.rank, r.dense_rank) for r in W.dist_ranks(df, "v", by=["g"]).collect()}
    w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    exp = {r.id: (r.rk, r.drk) for r in df.select("id", F.rank().over(w).alias("rk"),
                                                  F.dense_rank().over(w).alias("drk")).collect()}
    assert got == exp


def test_prefix_sum_on_a_hot_key_matches_window(spark):
    # one key holds half the rows: the scan splits it across range partitions
    rows = [(0 if i % 2 == 0 else i % 7 + 1, i, i % 13) for i in range(4000)]
    df = spark.createDataFrame(rows, "k int, t int, v int")
    got = {(r.k, r.t): r.running_total for r in W.running(df, "v", ["t"], by=["k"]).collect()}
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    exp = {(r.k, r.t): r.s for r in df.select("k", "t", F.sum("v").over(w).alias("s")).collect()}
    assert got == exp
    nums = W.number(df, ["t"], by=["k"]).filter("k = 0").agg(F.max("row_num"), F.count(F.lit(1))).collect()[0]
    assert nums[0] == nums[1] == 2000


def test_case_only_and_trailing_space_variants(spark):  # T2
    df = spark.createDataFrame([("Gold",), ("gold",), ("GOLD ",), ("Gold",)], "tier string")
    plain = {r.normalized_name: r.raw_variants for r in A.variants(df, "tier").collect()}
    assert plain == {"gold": 3}
    ci = {r.normalized_name: r.raw_variants for r in A.variants(df, "tier", ci=True).collect()}
    assert ci == {"gold": 2}  # 'GOLD ' keeps its trailing space


def test_duplicate_dimension_key_inflates_join(spark):
    fact = spark.createDataFrame([(1, 10), (2, 5)], "k int, m int")
    dim = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    r = J.join_check(fact, dim, "k", "m").collect()[0]
    assert (r.left_rows, r.joined_rows, r.keys_repeated_on_right) == (2, 3, 1)
    assert (r.left_measure, r.joined_measure) == (15, 25)


def test_orphan_child_key(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "pid int")
    parent = spark.createDataFrame([(1,)], "id int")
    r = Q.test_relationship(child, "pid", parent, "id").collect()[0]
    assert r.failures == 1


def test_price_zero_is_valid_null_is_not(spark):  # B2
    df = spark.createDataFrame([(1, Decimal("0.00")), (1, None), (0, Decimal("1.00"))], "quantity int, unit_price decimal(9,2)")
    assert [r[0] for r in df.select(B.holds(B.valid_item())).collect()] == [True, False, False]


def test_attach_scalar_rejects_a_benchmark_with_two_rows(spark):
    df = spark.createDataFrame([(1,)], "x int")
    bench = spark.createDataFrame([(1,), (2,)], "b int")
    with pytest.raises(Exception, match="exactly one row"):
        J.attach_scalar(df, bench).collect()


def test_dedup_survivors_equal_distinct_keys(spark):
    df = spark.createDataFrame([(3, "A "), (1, "a"), (2, "b"), (4, "B")], "id int, name string")
    key = F.lower(F.trim("name"))
    surv = {r.normalized_key: r.id for r in Q.dedup(df, key, "id").collect()}
    assert surv == {"a": 1, "b": 2}
    cands = sorted(r.id for r in Q.dedup_candidates(df, key, ["id"]).collect())
    assert cands == [3, 4]


def test_shares_sum_to_100(spark):
    df = spark.createDataFrame([(i, Decimal(i)) for i in range(1, 8)], "k int, v decimal(10,0)")
    total = W.share(df, "v").agg(F.sum("pct_of_total")).collect()[0][0]
    assert abs(total - 100) < 0.05


def test_normalize_tier_staging_vs_report(spark):  # B11
    df = spark.createDataFrame([(" gold",), ("SILVER",), ("platinum",), (None,)], "t string")
    got = df.select(B.normalize_tier("t").alias("s"), B.normalize_tier("t", "Unknown").alias("r")).collect()
    assert [(r.s, r.r) for r in got] == [("Gold", "Gold"), ("Silver", "Silver"), (None, "Unknown"), (None, "Unknown")]


def test_preview_shows_null_and_changed_rows_only(spark):
    df = spark.createDataFrame([(1, "a@x.io"), (2, " B@X.IO "), (3, None)], "id int, email string")
    p = Q.preview(df, ["id"], {"email": F.nullif(F.lower(F.trim("email")), F.lit(""))})
    assert sorted(r.id for r in p.collect()) == [2, 3]


def test_range_attribute_keeps_gaps(spark):
    from shelfwise.sources.literals import promotions
    df = spark.createDataFrame([(dt.date(1995, 3, 10),), (dt.date(1995, 5, 1),)], "d date")
    got = [r.promotion_id for r in J.range_attribute(df, "d", promotions(spark)).orderBy("d").collect()]
    assert got == [1, None]


def test_layers_refuse_raw_targets(spark):
    from shelfwise.sources import layers as L
    from shelfwise.plans import evidence as P
    from shelfwise.sources import raw
    from shelfwise.sources.driver import load
    load(spark, "/root/testdata/sf0.001")  # what tables are loaded from is raw
    df = spark.createDataFrame([(1,)], "x int")
    for target in ("/root/testdata/sf0.001/x.parquet", "file:///root/testdata/sf0.001", "/root/testdata/../testdata/sf0.001/a"):
        for write in (lambda p: L.stage(df, p), lambda p: L.export(df, p), lambda p: P.write_layout(df, p, ["x"], []),
                      lambda p: P.write_bucketed(df, "shelfwise_never", p, 2, "x"),
                      lambda p: Q.write_audit_publish(spark, df, {}, {"no": F.lit(False)}, "/tmp/shelfwise-never", p)):
            with pytest.raises(ValueError, match="raw layer"):
                write(target)
    raw.guard("/root/testdata/sf0.0011/x")  # another folder whose name begins alike


def test_range_total_splits_peers(spark):
    from shelfwise.operators import windows as W
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id % 11 END AS o", "1 AS v")
    got = {(r["id"], r["t"]) for r in W.running(df, "v", ["o"], frame="range", out="t").select("id", "t").collect()}
    want = {(r["id"], r["t"]) for r in df.selectExpr("id", "SUM(v) OVER (ORDER BY o) AS t").collect()}
    assert got == want


def test_write_audit_publish_blocks_failing_checks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "")], "id int, name string")
    rules = {"name": F.nullif(F.trim("name"), F.lit(""))}
    target = str(tmp_path / "clean")
    with pytest.raises(ValueError, match="blocked"):
        Q.write_audit_publish(spark, df, rules, {"blank_names": F.col("name").isNull()}, str(tmp_path / "stg"), target)
    import os
    assert not os.path.exists(target)
    ok = Q.write_audit_publish(spark, df, rules, {"blank_names": F.col("name").isNull()}, str(tmp_path / "stg2"),
                               target, max_failures={"blank_names": 1})
    assert ok.count() == 2


def test_not_in_three_valued_logic(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    no_null = spark.createDataFrame([(1,)], "k2 int")
    empty = spark.createDataFrame([], "k2 int")
    assert sorted(r.k for r in J.not_in(a, "k", no_null, "k2").collect()) == [2]
    assert sorted((r.k is None, r.k) for r in J.not_in(a, "k", empty, "k2").collect()) == [(False, 1), (False, 2), (True, None)]
    with_null = spark.createDataFrame([(1,), (None,)], "k2 int")
    assert J.not_in(a, "k", with_null, "k2").count() == 0
    # same answers as Spark SQL's own NOT IN
    a.createOrReplaceTempView("ni_a")
    no_null.createOrReplaceTempView("ni_b")
    sql = spark.sql("SELECT k FROM ni_a WHERE k NOT IN (SELECT k2 FROM ni_b)").collect()
    assert sorted(r.k for r in sql) == [2]


def test_range_join_equals_the_plain_condition(spark):
    from shelfwise.sources.literals import promotions
    days = spark.range(0, 3000).select(F.date_add(F.lit("1995-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    promos = promotions(spark)
    got = J.range_attribute(days, "d", promos)
    plain = days.join(F.broadcast(promos), (F.col("d") >= F.col("start_date")) & (F.col("d") <= F.col("end_date")), "left")
    cols = ["d", "promotion_id"]
    assert sorted(got.select(*cols).collect(), key=str) == sorted(plain.select(*cols).collect(), key=str)
    assert got.filter(F.col("promotion_id").isNotNull()).count() == 46 + 61 + 27 + 42 + 30


def test_ratio_half_up_is_exact(spark):
    """Rounded ratios equal exact rational rounding, including values just below a half-way point."""
    import random
    from fractions import Fraction

    random.seed(7)
    rows = [(Decimal(random.randint(-10 ** 9, 10 ** 9)) / 10 ** 4,
             Decimal(random.choice([1, -1]) * random.randint(1, 10 ** 6)) / 10 ** 4) for _ in range(2000)]
    rows += [(Decimal("1.2345"), Decimal("0")), (Decimal("0.185"), Decimal("1")), (Decimal("-0.185"), Decimal("1")),
             (Decimal("703529.7399"), Decimal("380286852.0001"))]
    df = spark.createDataFrame(rows, "n decimal(28,8), d decimal(28,8)")
    got = [r[0] for r in df.select(B.ratio_half_up("n", "d", 2, scale=100)).collect()]
    for (n, d), g in zip(rows, got):
        if d == 0:
            assert g is None
            continue
        fr = Fraction(n) * 100 / Fraction(d)
        q = (2 * abs(fr) * 100 + 1) // 2
        assert g == (-1 if fr < 0 else 1) * int(q) / 100


def test_literal_rows_keep_values_and_are_small(spark):
    from pyspark.sql import types as T
    from shelfwise.sources.literals import promotions, rows
    schema = T.StructType([T.StructField("s", T.StringType()), T.StructField("d", T.DateType()),
                           T.StructField("x", T.DecimalType(9, 2)), T.StructField("b", T.BooleanType())])
    data = [("O'Brien \\ co", dt.date(2026, 1, 2), Decimal("-2.50"), True), (None, None, None, None)]
    df = rows(spark, schema, data)
    assert df.schema.fieldNames() == ["s", "d", "x", "b"] and [f.dataType for f in df.schema] == [f.dataType for f in schema]
    assert [tuple(r) for r in df.collect()] == data
    assert "LocalTableScan" in P_plan(promotions(spark))


def P_plan(df):
    from shelfwise.plans.evidence import plan_text
    return plan_text(df)


def test_range_join_has_one_plan_and_ignores_bad_periods(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, 31),), (dt.date(2024, 2, 1),), (dt.date(2025, 5, 5),), (None,)], "day date")
    periods = spark.createDataFrame(
        [("a", dt.date(2024, 1, 15), dt.date(2024, 2, 10)), ("inverted", dt.date(2024, 3, 1), dt.date(2024, 1, 1)),
         ("open", dt.date(2024, 1, 1), None)], "name string, start_date date, end_date date")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in ("100MB", "-1", before):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            got = {(r["day"], r["name"]) for r in J.range_attribute(days, "day", periods).collect()}
            assert got == {(dt.date(2024, 1, 31), "a"), (dt.date(2024, 2, 1), "a"), (dt.date(2025, 5, 5), None), (None, None)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_above_mean_of_very_large_sums(spark):
    from shelfwise.functions.metrics import above_mean, diff_from_mean_half_up
    rows = [(Decimal("9000000000000.12345678"), Decimal("9000000000001.00000000"), 2), (Decimal("2000000000000"), Decimal("9e15"), 2400)]
    df = spark.createDataFrame(rows, "x decimal(30,8), s decimal(30,8), n bigint")
    got = df.select(above_mean("x", "s", "n").alias("a"), diff_from_mean_half_up("x", "s", "n").alias("d")).collect()
    assert [r["a"] for r in got] == [True, False]
    assert [r["d"] for r in got] == [float(round(x - s / n, 2)) for x, s, n in rows]


def test_scalar_of_two_rows_raises(spark):
    two = spark.createDataFrame([(1,), (2,)], "b int")
    with pytest.raises(Exception, match="exactly one row"):
        J.attach_scalar(spark.range(3), two).collect()
    assert J.attach_scalar(spark.range(3), two.limit(1)).count() == 3


def test_exact_duplicates_two_phase(spark):
    df = spark.createDataFrame([(1, "same text"), (2, "same text "), (3, "other"), (4, "same text"), (5, "x")],
                               "id int, t string")
    got = Q.exact_duplicates(df, F.trim("t"), [F.min("id").alias("first_id")]).collect()
    assert [(r.first_id, r.duplicate_count) for r in got] == [(1, 3)]
