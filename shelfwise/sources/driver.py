"""Driver tables: declared schemas and loading (SRC-01, SRC-02).

Schemas are declared up front and passed to the reader, never inferred.
Each table is one parquet dataset; column pruning and filter push-down
happen in the scan because every operator selects and filters lazily.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.sources.raw import protect

_L, _I, _D, _S, _TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", _I), ("r_name", _S)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _schema(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I), ("c_acctbal", _D), ("c_mktsegment", _S)),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "part": _schema(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S), ("p_size", _I), ("p_retailprice", _D)),
    "orders": _schema(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S), ("o_totalprice", _D),
                      ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _schema(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L), ("l_linenumber", _I),
                        ("l_quantity", _D), ("l_extendedprice", _D), ("l_discount", _D), ("l_tax", _D),
                        ("l_returnflag", _S), ("l_linestatus", _S), ("l_shipdate", _TS)),
    "events": _schema(("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S), ("value", _D), ("props", _S)),
    "documents": _schema(("doc_id", _L), ("text", _S), ("lang", _S), ("source", _S), ("n_chars", _L)),
    "labels": _schema(("doc_id", _L), ("quality", _I), ("toxic", _I)),
    "embeddings": _schema(("vec_id", _L), ("embedding", T.ArrayType(T.FloatType())), ("label", _I)),
    "pages": _schema(("page_id", _L), ("url", _S), ("html", _S)),
    "benchmark": _schema(("item_id", _L), ("text", _S)),
    "conversations": _schema(("conv_id", _L), ("turn", _L), ("role", _S), ("text", _S)),
}

# Key columns per table (the declared grain).  ``lineitem`` has no unique key
# in the driver data: (l_orderkey, l_linenumber) repeats, which DQ tests report.
KEYS: dict[str, tuple[str, ...]] = {
    "region": ("r_regionkey",),
    "nation": ("n_nationkey",),
    "customer": ("c_custkey",),
    "supplier": ("s_suppkey",),
    "part": ("p_partkey",),
    "orders": ("o_orderkey",),
    "lineitem": ("l_orderkey", "l_linenumber"),
    "events": ("event_id",),
    "documents": ("doc_id",),
    "labels": ("doc_id",),
    "embeddings": ("vec_id",),
    "pages": ("page_id",),
    "benchmark": ("item_id",),
    "conversations": ("conv_id", "turn"),
}

TABLE_NAMES = tuple(SCHEMAS)


class Tables:
    """Lazily read driver tables from one folder with declared schemas."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        protect(self.root)
        self._cache: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in SCHEMAS:
            raise AttributeError(name)
        return self.table(name)


def load(spark: SparkSession, root: str) -> Tables:
    return Tables(spark, root)


def scan_tables(t: Tables, names: tuple[str, ...] = TABLE_NAMES) -> DataFrame:
    """SRC-01: one row per table with its row count (a union of counts)."""
    parts = [t.table(n).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SQL_TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE", "boolean": "BOOLEAN",
    "array<float>": "FLOAT[]",
}


def sql_type_name(dt: T.DataType) -> str:
    return SQL_TYPE_NAMES.get(dt.simpleString(), dt.simpleString().upper())
