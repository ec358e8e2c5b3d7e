"""Join operators JN-01..JN-18.

Physical notes
--------------
* Only relations with a proven size bound are broadcast explicitly: a
  one-row aggregate, or a literal relation.  Everything else is left to
  the planner, and AQE broadcasts it at runtime only when the measured
  size is below ``spark.sql.autoBroadcastJoinThreshold``.
* Semi/anti joins (EXISTS / NOT EXISTS) never multiply rows, and AQE
  splits skewed partitions of the probe side.
* Fan-out questions (how many rows would this join produce) are answered
  from per-key counts on each side, never by materialising the pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def star(fact: DataFrame, dims: Sequence[tuple[DataFrame, str | Column, str]]) -> DataFrame:
    """JN-02: chain fact -> dimension joins, keeping the fact's grain."""
    out = fact
    for dim, on, how in dims:
        out = out.join(dim, on, how)
    return out


def coverage(dim: DataFrame, key: str, fact_agg: DataFrame, fill: dict) -> DataFrame:
    """JN-03: every dimension row with its aggregates, missing ones as zero.

    ``fact_agg`` is aggregated at ``key`` before the join, so the left join
    sees one row per key.
    """
    out = dim.join(fact_agg, key, "left")
    return out.fillna(fill)


def attach_scalar(df: DataFrame, bench: DataFrame, what: str = "benchmark") -> DataFrame:
    """JN-06 / SV-02: put the single row of ``bench`` beside every row of ``df``.

    One global aggregate reads the benchmark once, giving its values and its
    row count; only that one row is broadcast, whatever was passed in, and a
    count other than one raises instead of duplicating rows.
    """
    one = bench.agg(F.count(F.lit(1)).alias("_rows"), *[F.first(f"`{c}`").alias(c) for c in bench.columns])
    one = one.withColumn("_rows", F.when(F.col("_rows") == 1, F.lit(1)).otherwise(
        F.raise_error(F.lit(f"{what} must have exactly one row")).cast("int")))
    return df.crossJoin(F.broadcast(one)).filter(F.col("_rows") == 1).drop("_rows")


def semi(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """JN-07/08: ``IN (subquery)`` / ``EXISTS`` as a left semi join."""
    return df.join(other, on, "left_semi")


def anti(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """JN-09/11: ``NOT EXISTS`` as a left anti join."""
    return df.join(other, on, "left_anti")


def anti_left_null(df: DataFrame, other: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """JN-10: ``LEFT JOIN ... WHERE right.key IS NULL`` (right side reduced to distinct keys)."""
    keys = other.select(F.col(right_key).alias("_rk")).distinct()
    return (df.join(keys, F.col(left_key) == F.col("_rk"), "left")
            .filter(F.col("_rk").isNull()).drop("_rk"))


def not_in(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """``key NOT IN (SELECT other_key ...)`` with SQL's three-valued logic (T11).

    A row is kept only when the list holds no NULL and the key is absent;
    a NULL key is kept only when the list is empty.  Planned as a hash anti
    join plus a broadcast one-row guard, instead of the null-aware anti join
    Spark would run as a nested loop when the list is too big to broadcast.
    """
    guard = other.agg(F.count_if(F.col(other_key).isNull()).alias("_nulls"),
                      F.count(F.lit(1)).alias("_list_rows"))
    absent = df.join(other.select(F.col(other_key).alias("_ok")).filter(F.col("_ok").isNotNull()).distinct(),
                     F.col(key) == F.col("_ok"), "left_anti")
    keep = (F.col("_nulls") == 0) & (F.col(key).isNotNull() | (F.col("_list_rows") == 0))
    return absent.crossJoin(F.broadcast(guard)).filter(keep).drop("_nulls", "_list_rows")


def not_in_vs_anti(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """JN-13: rows kept by ``NOT IN`` next to rows kept by ``NOT EXISTS``.

    ``NOT IN`` keeps nothing once the list holds a NULL (T11); ``NOT EXISTS``
    ignores NULL keys.
    """
    n_in = not_in(df, key, other, other_key).agg(F.count(F.lit(1)).alias("not_in_rows"))
    n_ex = anti(df, other.filter(F.col(other_key).isNotNull()),
                F.col(key) == F.col(other_key)).agg(F.count(F.lit(1)).alias("not_exists_rows"))
    return n_in.crossJoin(n_ex)


#: Period lengths are told apart by powers of two of days, up to this one (about 180,000 years).
RANGE_LEVELS = 26


def period_bins(periods: DataFrame, start: str, end: str) -> DataFrame:
    """Each period once or twice with ``_level`` and ``_bin``: bins of 2^level days, the least level as long as the period.

    A period that ends before it starts, or with a NULL end, has no bin.
    """
    lo, hi = F.unix_date(F.to_date(start)), F.unix_date(F.to_date(end))
    days = (hi - lo + 1).cast("bigint")
    level = sum((F.when(days > (1 << k), F.lit(1)).otherwise(F.lit(0)) for k in range(RANGE_LEVELS)), F.lit(0))
    p = periods.filter(F.col(start) <= F.col(end)).withColumn("_level", level)
    ends = [F.expr(f"shiftright(unix_date(to_date(`{c}`)), _level)") for c in (start, end)]
    return p.withColumn("_bin", F.explode(F.array_distinct(F.array(*ends))))


def range_attribute(df: DataFrame, date_col: str, periods: DataFrame, start: str = "start_date",
                    end: str = "end_date") -> DataFrame:
    """JN-14: attach every period whose inclusive [start, end] contains the date (LEFT join).

    One plan for every size, by adaptive bins: a period lies in at most two
    bins of its own length class, so a period of twenty years is two rows,
    and a date meets only periods of which it lies within a few lengths.
    The distinct dates are matched first (one bin per length class), then
    the rows take up their date's periods by an equi-join, which AQE splits
    on a hot date.  So the work grows with the rows, the periods and the
    matches; no month or bin holds all periods.  The planner broadcasts a
    side by itself where it is small.  A period with a NULL end or with its
    end before its start matches nothing.
    """
    bins = period_bins(periods, start, end)
    dates = df.select(F.col(date_col).alias("_date")).filter(F.col("_date").isNotNull()).distinct()
    levels = F.explode(F.sequence(F.lit(0), F.lit(RANGE_LEVELS))).alias("_on_level")
    dates = dates.select("_date", levels).withColumn("_on_bin", F.expr("shiftright(unix_date(to_date(_date)), _on_level)"))
    inside = (F.col("_level") == F.col("_on_level")) & (F.col("_bin") == F.col("_on_bin")) & (F.col("_date") >= F.col(start)) & (F.col("_date") <= F.col(end))
    matches = dates.join(bins, inside).drop("_level", "_bin", "_on_level", "_on_bin")
    return df.join(matches, F.col(date_col) == F.col("_date"), "left").drop("_date")


def latest(df: DataFrame, date_col: str) -> DataFrame:
    """JN-15: rows at the maximum ``date_col`` (join to a one-row aggregate)."""
    mx = df.agg(F.max(date_col).alias("_latest"))
    return df.join(F.broadcast(mx), F.col(date_col) == F.col("_latest")).drop("_latest")


def join_by_name(fact_names: DataFrame, name_col: str, dim: DataFrame, dim_name_col: str,
                 rows: str | None = None) -> DataFrame:
    """JN-16: how many dimension rows each (normalised) fact name matches.

    Both sides are reduced to per-name counts before joining, so a name
    shared by many dimension rows never fans out the fact.  ``rows`` names a
    column of counts when ``fact_names`` is aggregated already.
    """
    norm = lambda c: F.lower(F.trim(F.col(c)))
    n = F.sum(rows).cast("bigint") if rows else F.count(F.lit(1))
    f = fact_names.groupBy(norm(name_col).alias("match_name")).agg(n.alias("fact_rows"))
    d = dim.groupBy(norm(dim_name_col).alias("match_name")).agg(F.count(F.lit(1)).alias("dim_matches"))
    out = f.join(d, "match_name", "left").fillna({"dim_matches": 0})
    status = (F.when(F.col("dim_matches") == 0, "missing").when(F.col("dim_matches") == 1, "unique")
              .otherwise("ambiguous"))
    return out.withColumn("match_status", status)


def normalize(fact: DataFrame, source_key: str, attrs: Sequence[str], key_name: str = "attr_key",
              entities: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """JN-17: split repeated attributes into a keyed dimension + slim fact.

    The surrogate key is the smallest source key in the fact that carries the
    attribute combination.  With ``entities`` (the attributes, one row per
    source key) it is found on those, so the fact is joined once, on its own
    key, and never shuffled on text columns; without, the fact itself holds
    the attributes.
    """
    if entities is None:
        dim = fact.groupBy(*attrs).agg(F.min(source_key).alias(key_name))
        return dim, fact.join(dim, list(attrs)).drop(*attrs)
    used = entities.join(fact.select(source_key).distinct(), source_key)
    dim = used.groupBy(*attrs).agg(F.min(source_key).alias(key_name))
    same = [F.col(f"e.{a}").eqNullSafe(F.col(f"d.{a}")) for a in attrs]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    keys = used.alias("e").join(dim.alias("d"), cond).select(f"e.{source_key}", key_name)
    return dim, fact.join(keys, source_key)


def join_check(left: DataFrame, right: DataFrame, key: str, measure: str, rows: str | None = None) -> DataFrame:
    """JN-18: rows and measure total before/after an equi join on ``key``.

    Computed from per-key counts on both sides (no pair materialised):
    joined_rows = sum(left_n x right_n), joined_measure = sum(left_sum x right_n).
    ``rows`` names a column of row counts when ``left`` is aggregated already.
    """
    n = F.sum(rows) if rows else F.count(F.lit(1))
    l = left.groupBy(key).agg(n.alias("_ln"), F.sum(measure).alias("_ls"))
    r = right.groupBy(key).agg(F.count(F.lit(1)).alias("_rn"))
    per_key = l.join(r, key, "left").fillna({"_rn": 0})
    return per_key.agg(
        F.sum("_ln").cast("bigint").alias("left_rows"),
        F.sum(F.col("_ln") * F.col("_rn")).cast("bigint").alias("joined_rows"),
        F.count_if(F.col("_rn") > 1).alias("keys_repeated_on_right"),
        F.sum("_ls").alias("left_measure"),
        F.sum(F.col("_ls") * F.col("_rn")).alias("joined_measure"),
    )
