"""Plan evidence and data layout (PF-01..PF-06).

The reference teaches EXPLAIN and indexes.  On Spark the same questions
are answered by the formatted physical plan (scanned columns, pushed and
partition filters, join strategies, exchanges) and by the file layout
(partitioned + sorted parquet, bucketed tables).  Plan text is read
before execution; only node names are matched, never ids (AQE renumbers).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import scratch_dir
from shelfwise.sources.raw import guard

FACT_KEYS = ("PushedFilters", "PartitionFilters", "ReadSchema", "Join type", "Join condition", "Location")

PLAN_FACT_SCHEMA = T.StructType([
    T.StructField("node_id", T.IntegerType(), False),
    T.StructField("node", T.StringType(), False),
    T.StructField("fact", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
])


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as text (same as ``df.explain(mode)``)."""
    try:
        return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
    except Exception:  # noqa: BLE001 - e.g. Spark Connect: capture what explain() prints
        import contextlib
        import io
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(mode)
        return buf.getvalue()


def parse_plan(text: str) -> list[tuple[int, str, str | None, str | None]]:
    """(node_id, node name, fact, value) for every node detail of interest."""
    rows: list[tuple[int, str, str | None, str | None]] = []
    node_id, node = None, None
    for line in text.splitlines():
        m = re.match(r"^\((\d+)\) (.+?)\s*(\[codegen id : \d+\])?$", line.strip())
        if m:
            node_id, node = int(m.group(1)), m.group(2).strip()
            rows.append((node_id, node, None, None))
            continue
        if node_id is None:
            continue
        for key in FACT_KEYS:
            if line.startswith(f"{key}:") or line.startswith(f"{key} "):
                value = line.split(":", 1)[1].strip() if ":" in line else ""
                rows.append((node_id, node, key, value))
    return rows


def plan_facts(df: DataFrame) -> DataFrame:
    """PF-01/PF-04: plan facts of a query as a small DataFrame (one row per fact).

    The result is bounded by the plan's size, not by the data.
    """
    return df.sparkSession.createDataFrame(parse_plan(plan_text(df)), PLAN_FACT_SCHEMA)


def scanned_columns(df: DataFrame) -> list[list[str]]:
    """Column names of every parquet scan (from ReadSchema)."""
    out = []
    for _i, _n, fact, value in parse_plan(plan_text(df)):
        if fact == "ReadSchema":
            out.append(re.findall(r"(\w+):", value))
    return out


def pushed_filters(df: DataFrame) -> list[str]:
    return [v for _i, _n, f, v in parse_plan(plan_text(df)) if f == "PushedFilters"]


def exchanges(df: DataFrame) -> int:
    """Number of shuffle exchanges in the physical plan."""
    return sum(1 for _i, n, f, _v in parse_plan(plan_text(df)) if f is None and n.startswith("Exchange"))


def _nodes(plan) -> Iterator[tuple[str, object]]:
    """Class name and node of an executed plan, through the stages of adaptive execution."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from _nodes(plan.executedPlan())
        return
    yield kind, plan
    if kind.endswith("QueryStageExec"):
        yield from _nodes(plan.plan())
    below = plan.children()
    for i in range(below.size()):
        yield from _nodes(below.apply(i))


def run_facts(df: DataFrame) -> list[dict]:
    """PF-01 after a run: what each scan read and each shuffle wrote, from the plan's own metrics.

    The query is run in full and its rows go nowhere.  ``kind`` is ``scan``
    (``rows`` behind partition, row-group and page skipping, ``files``,
    ``bytes``) or ``exchange`` (``rows`` written); ``columns`` names the node's output.
    """
    run = df.select("*")._jdf.queryExecution()  # a plan of its own, so earlier runs don't add to the metrics
    run.toRdd().count()
    out = []
    for kind, node in _nodes(run.executedPlan()):
        names = {"FileSourceScanExec": {"rows": "numOutputRows", "files": "numFiles", "bytes": "filesSize"},
                 "ShuffleExchangeExec": {"rows": "shuffleRecordsWritten"}}.get(kind)
        if names:
            attributes = node.output()
            out.append({"kind": "scan" if "files" in names else "exchange",
                        "columns": [attributes.apply(i).name() for i in range(attributes.size())],
                        **{k: node.metrics().apply(v).value() for k, v in names.items()}})
    return out


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """PF-06: one row proving two results are identical multisets.

    Rows of both are counted per distinct row in one group (NULLs equal), so
    each side is read once; what one side has more of is only in that side.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = a.withColumns({"_a": one, "_b": none}).unionByName(b.withColumns({"_a": none, "_b": one}))
    per_row = both.groupBy(*a.columns).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    more = lambda x, y: F.coalesce(F.sum(F.greatest(F.col(x) - F.col(y), F.lit(0))), F.lit(0)).cast("bigint")
    out = per_row.agg(F.coalesce(F.sum("_a"), none).alias("a_rows"), F.coalesce(F.sum("_b"), none).alias("b_rows"),
                      more("_a", "_b").alias("only_in_a"), more("_b", "_a").alias("only_in_b"))
    return out.withColumn("same_rows", (F.col("only_in_a") == 0) & (F.col("only_in_b") == 0))


def write_layout(df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str],
                 partitions: int | None = None, row_group_bytes: int | None = None) -> None:
    """PF-03: the re-aimed composite index - partitioned by the filter columns, sorted inside.

    Rows are range-partitioned on (partition columns, sort columns) before
    the write, so no task gets a whole hot partition value and each file is
    sorted (tight min/max statistics for row-group skipping).  Smaller row
    groups skip more and cost more footers; None keeps Parquet's size.
    :func:`run_facts` shows what a filter still reads.
    Spark doesn't compare TIMESTAMP_NTZ columns with Parquet's statistics
    (measured with :func:`run_facts`: all rows of a partition are read), so
    sort and filter by a date, number or string column.
    """
    guard(path)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*partition_by, *sort_by]
    out = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).write.mode("overwrite")
    if row_group_bytes:
        out = out.option("parquet.block.size", str(row_group_bytes))
    out.partitionBy(*partition_by).parquet(path)


def read_layout(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Re-read a partitioned layout with its declared schema (partition columns included)."""
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str) -> DataFrame:
    """PF-05: the re-aimed join-key index - a bucketed, sorted table at ``path``.

    Two tables bucketed the same way on the join key join without an
    exchange on either side.  Rows are dealt by the key first, so each bucket
    is one file, not one per task.  :func:`drop_bucketed` removes the table.
    """
    guard(path)
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def forget_bucketed(spark: SparkSession, table: str) -> None:
    """Take a bucketed table out of the catalog and leave its files; results that were planned on it can still be read."""
    spark.sql(f"DROP TABLE {table}")


def drop_bucketed(spark: SparkSession, table: str) -> None:
    """Forget a bucketed table and delete its folder."""
    at = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first()["data_type"]
    spark.sql(f"DROP TABLE {table}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def bucketed_scope(spark: SparkSession) -> Iterator[Callable[[DataFrame, str, int, str], DataFrame]]:
    """PF-05: ``write(df, name, buckets, key)`` for tables that live as long as the block; table and files go at its end.

    Results that must outlive the block are checkpointed or written inside it.
    """
    made: list[str] = []

    def write(df: DataFrame, name: str, buckets: int, key: str) -> DataFrame:
        table = f"{name}_{uuid.uuid4().hex[:12]}"
        made.append(table)
        return write_bucketed(df, table, scratch_dir(spark, table), buckets, key)

    try:
        yield write
    finally:
        for table in made:
            if spark.catalog.tableExists(table):
                drop_bucketed(spark, table)
