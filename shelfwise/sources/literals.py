"""Inline literal relations (SRC-03): ``INSERT ... VALUES`` / ``VALUES``.

Literal relations are small by construction (their size is fixed in the
code), so joining them by broadcast is size-bounded.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _sql_literal(v, dt: T.DataType) -> str:
    if v is None:
        return f"CAST(NULL AS {dt.simpleString()})"
    if isinstance(dt, T.StringType):
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(dt, T.DateType):
        return f"DATE '{v.isoformat()}'"
    if isinstance(dt, (T.TimestampNTZType, T.TimestampType)):
        kind = "TIMESTAMP_NTZ" if isinstance(dt, T.TimestampNTZType) else "TIMESTAMP"
        return f"{kind} '{v.isoformat(sep=' ')}'"
    if isinstance(dt, T.BooleanType):
        return "TRUE" if v else "FALSE"
    return f"CAST('{v}' AS {dt.simpleString()})"


def rows(spark: SparkSession, schema: T.StructType, tuples: Iterable[Sequence]) -> DataFrame:
    """A DataFrame from literal tuples with a declared schema (never inferred).

    Built as a SQL ``VALUES`` relation, so the plan holds the rows as a local
    relation with an exact size estimate: the planner (and
    :func:`shelfwise.operators.joins.broadcast_if_small`) can see it is small.
    """
    data = list(tuples)
    if not data:
        return spark.createDataFrame([], schema=schema)
    fields = schema.fields
    values = ", ".join("(" + ", ".join(_sql_literal(v, f.dataType) for v, f in zip(row, fields)) + ")" for row in data)
    cols = ", ".join(f"_c{i}" for i in range(len(fields)))
    df = spark.sql(f"SELECT * FROM VALUES {values} AS t({cols})")
    return df.select(*[df[f"_c{i}"].cast(f.dataType).alias(f.name) for i, f in enumerate(fields)])


PROMOTION_SCHEMA = T.StructType([
    T.StructField("promotion_id", T.IntegerType(), False),
    T.StructField("promotion_name", T.StringType(), False),
    T.StructField("start_date", T.DateType(), False),
    T.StructField("end_date", T.DateType(), False),
    T.StructField("discount_pct", T.DecimalType(5, 2), False),
])

# Promotion calendar over the driver's order dates, with gaps.
PROMOTIONS = (
    (1, "Spring Launch", dt.date(1995, 3, 1), dt.date(1995, 4, 15), 10),
    (2, "Summer Sale", dt.date(1996, 6, 1), dt.date(1996, 7, 31), 15),
    (3, "Back to School", dt.date(1997, 8, 15), dt.date(1997, 9, 10), 5),
    (4, "Holiday", dt.date(1998, 11, 20), dt.date(1998, 12, 31), 20),
    (5, "Clearance", dt.date(2000, 1, 2), dt.date(2000, 1, 31), 25),
)


def promotions(spark: SparkSession) -> DataFrame:
    from decimal import Decimal
    return rows(spark, PROMOTION_SCHEMA, [(a, b, c, d, Decimal(e)) for a, b, c, d, e in PROMOTIONS])


def promotions_sql(alias: str = "promotions") -> str:
    """The same promotions as a SQL VALUES list (for oracles and SQL users)."""
    vals = ", ".join(f"({a}, '{b}', DATE '{c}', DATE '{d}', CAST({e} AS DECIMAL(5,2)))" for a, b, c, d, e in PROMOTIONS)
    return f"(VALUES {vals}) AS {alias}(promotion_id, promotion_name, start_date, end_date, discount_pct)"


STATUS_SCHEMA = T.StructType([
    T.StructField("status_code", T.StringType(), False),
    T.StructField("status_label", T.StringType(), False),
])

# Order status codes of the driver tables and their labels.
STATUS_LABELS = (("F", "completed"), ("O", "open"), ("P", "pending"))


def status_labels(spark: SparkSession) -> DataFrame:
    return rows(spark, STATUS_SCHEMA, STATUS_LABELS)


def status_labels_sql(alias: str = "status_labels") -> str:
    vals = ", ".join(f"('{a}', '{b}')" for a, b in STATUS_LABELS)
    return f"(VALUES {vals}) AS {alias}(status_code, status_label)"
