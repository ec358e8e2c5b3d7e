"""What scans and shuffles really move: row groups skipped, lines dropped before a shuffle."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import catalog
from shelfwise.plans import evidence as P
from shelfwise.sources.driver import load
from shelfwise.sources.model import from_driver

SF = "/root/testdata/sf0.01"
BLOOM = "spark.sql.optimizer.runtime.bloomFilter."
LAYOUT = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("order_day", T.DateType()),
                       T.StructField("status", T.StringType())])


@pytest.fixture
def settings(spark):
    old = {}

    def put(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            old.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield put
    for key, value in old.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "orders")
    orders = from_driver(load(spark, SF)).orders.select("order_id", F.to_date("order_date").alias("order_day"), "status")
    P.write_layout(orders, path, ["status"], ["order_day"], partitions=4, row_group_bytes=8192)
    return path


def _days(lo, hi):
    return (F.col("order_day") >= F.lit(lo)) & (F.col("order_day") < F.lit(hi))


def _groups(path):
    """(least day, greatest day, rows) of every row group written for status F."""
    out = []
    for name in glob.glob(f"{path}/status=F/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index("order_day")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            out.append((stats.min, stats.max, meta.row_group(g).num_rows))
    return out


def test_a_range_filter_reads_only_the_row_groups_it_meets(spark, layout):
    lo, hi = dt.date(1997, 3, 1), dt.date(1997, 4, 1)
    groups = _groups(layout)
    met = [n for a, b, n in groups if b >= lo and a < hi]
    assert 0 < len(met) < len(groups) / 2
    df = P.read_layout(spark, layout, LAYOUT).filter((F.col("status") == "F") & _days(lo, hi))
    (scan,) = [x for x in P.run_facts(df) if x["kind"] == "scan"]
    assert df.count() <= scan["rows"] <= sum(met) < sum(n for *_, n in groups) / 2


def test_a_filter_that_meets_nothing_reads_nothing(spark, layout):
    df = P.read_layout(spark, layout, LAYOUT).filter((F.col("status") == "F") & _days(dt.date(2050, 1, 1), dt.date(2050, 2, 1)))
    assert [x["rows"] for x in P.run_facts(df) if x["kind"] == "scan"] == [0]


def test_partitions_that_a_filter_excludes_are_not_listed(spark, layout):
    whole = P.run_facts(P.read_layout(spark, layout, LAYOUT))[0]
    part = P.run_facts(P.read_layout(spark, layout, LAYOUT).filter("status = 'P'"))[0]
    assert part["files"] == len(glob.glob(f"{layout}/status=P/*.parquet")) < whole["files"]
    assert part["bytes"] < whole["bytes"] and whole["rows"] == spark.read.parquet(f"{SF}/orders.parquet").count()


def _shuffled_lines(df):
    """Lines that enter the join with orders: the largest shuffle that carries order and product keys."""
    return max(x["rows"] for x in P.run_facts(df) if x["kind"] == "exchange" and {"order_id", "product_id"} <= set(x["columns"]))


@pytest.mark.parametrize("key", ["rp_unsold_products", "rp_catalog_coverage", "rp_category_shortlist"])
def test_period_reports_shuffle_the_periods_lines_only(spark, settings, key):
    query = lambda: catalog.queries()[key](spark, SF)
    # as for tables of which neither side can be broadcast
    settings(**{"spark__sql__autoBroadcastJoinThreshold": "-1", f"{BLOOM}applicationSideScanSizeThreshold": "0", f"{BLOOM}enabled": "false"})
    plain, rows = _shuffled_lines(query()), sorted(map(tuple, query().collect()))
    settings(**{f"{BLOOM}enabled": "true"})
    assert "might_contain" in P.plan_text(query())
    assert _shuffled_lines(query()) < plain / 4
    assert sorted(map(tuple, query().collect())) == rows
