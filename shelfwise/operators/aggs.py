"""Aggregation operators AG-01..AG-17, set operations ST-* and subqueries SV-*.

Every aggregate is a hash aggregate with a partial (map-side) phase, so a
hot group key is combined inside each task before the shuffle; DISTINCT
counts are planned by Spark as a two-level aggregate over (group, value).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.metrics import above_mean


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def counts(df: DataFrame, col: str) -> DataFrame:
    """AG-02: COUNT(*), COUNT(col) and COUNT(DISTINCT col) side by side."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.count(col).alias("non_null_count"),
                  F.count_distinct(col).alias("distinct_count"))


def count_where(df: DataFrame, conds: Mapping[str, Column], as_case: bool = False) -> DataFrame:
    """AG-04/AG-05: one count per named condition in one pass.

    ``as_case`` spells ``SUM(CASE WHEN c THEN 1 ELSE 0 END)``; the default
    is ``count_if`` (T1: Spark rejects ``SUM(boolean)``; empty input gives 0).
    """
    if as_case:
        aggs = [F.sum(F.when(c, 1).otherwise(0)).alias(n) for n, c in conds.items()]
    else:
        aggs = [F.count_if(c).alias(n) for n, c in conds.items()]
    return df.agg(*aggs)


def group_kpis(df: DataFrame, by: Sequence, aggs: Sequence[Column]) -> DataFrame:
    """AG-07/08/09: GROUP BY columns or expressions."""
    return df.groupBy(*[_c(b) for b in by]).agg(*aggs)


def having(agg_df: DataFrame, pred: Column) -> DataFrame:
    """AG-10: a threshold on aggregated values (a filter after the aggregate)."""
    return agg_df.filter(pred)


def variants(df: DataFrame, raw: str, key: Column | None = None, min_variants: int = 2, ci: bool = False) -> DataFrame:
    """AG-13 / DQ-08: normalised keys with several raw spellings.

    ``ci=True`` counts spellings under a case- and accent-insensitive
    collation (T2) instead of byte equality.
    """
    key = key if key is not None else F.lower(F.trim(F.col(raw)))
    spelled = F.collate(F.col(raw), "UNICODE_CI_AI") if ci else F.col(raw)
    return (df.groupBy(key.alias("normalized_name"))
            .agg(F.count(F.lit(1)).alias("item_rows"), F.count_distinct(spelled).alias("raw_variants"))
            .filter(F.col("raw_variants") >= min_variants))


def avg_of_sums(df: DataFrame, group: Sequence[str], measure: str, outer: Sequence[str] = ()) -> DataFrame:
    """AG-14: the sum and number of per-group sums, from which their average is taken exactly.

    Two aggregates; the inner one is partial per task.
    """
    inner = df.groupBy(*outer, *group).agg(F.sum(measure).alias("_group_total"))
    return inner.groupBy(*outer).agg(F.sum("_group_total").alias("sum_of_group_totals"),
                                     F.count(F.lit(1)).alias("groups"))


def distinct_state(detail: DataFrame, fine: Sequence[str], distinct_col: str, sums: Sequence[str]) -> DataFrame:
    """AG-16: what a fine grain must keep so that any coarser one needs no second scan of the detail.

    One row per fine group and value of ``distinct_col``, with the partial
    sums: never more rows than the detail, whatever the number of groups and
    the spread of the values.  Where ``detail`` is dealt by ``distinct_col``,
    neither this aggregate nor the merge in :func:`from_state` shuffles these rows.
    """
    return detail.groupBy(*fine, F.col(distinct_col).alias("_value")).agg(*[F.sum(c).alias(c) for c in sums])


def from_state(state: DataFrame, cols: Sequence[str], distinct_col: str, sums: Mapping[str, str]) -> DataFrame:
    """AG-16: the distinct count and sums at the grain ``cols``, merged upwards from :func:`distinct_state`."""
    merged = state.groupBy(*cols, "_value").agg(*[F.sum(c).alias(f"_s{i}") for i, c in enumerate(sums.values())])
    return merged.groupBy(*cols).agg(F.count("_value").alias(f"distinct_{distinct_col}s"), *[F.sum(f"_s{i}").alias(n) for i, n in enumerate(sums)])


def rollup_report(detail: DataFrame, cols: Sequence[str], distinct_col: str, sums: Mapping[str, str]) -> DataFrame:
    """AG-16: a coarser grain recomputed from detail (distinct counts never summed)."""
    return detail.groupBy(*cols).agg(F.count_distinct(distinct_col).alias(f"distinct_{distinct_col}s"),
                                     *[F.sum(c).alias(n) for n, c in sums.items()])


# ------------------------------------------------------------------ set ops


def stack(dfs: Sequence[DataFrame], distinct: bool = False) -> DataFrame:
    """ST-01/ST-02: UNION ALL by column name; ``distinct`` makes it UNION."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out.distinct() if distinct else out


# ------------------------------------------------------------------ subqueries


def above_avg(df: DataFrame, col: str) -> DataFrame:
    """SV-01: rows whose ``col`` exceeds the (scalar) average over all rows.

    The average is a one-row aggregate, broadcast to the filter.
    """
    bench = df.agg(F.sum(col).alias("_s"), F.count(col).alias("_n"))
    return df.crossJoin(F.broadcast(bench)).filter(above_mean(col, "_s", "_n")).drop("_s", "_n")


def above_group_avg(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """SV-03: correlated ``col > AVG(col) of the row's own group``.

    Decorrelated as a grouped aggregate joined back on the group key: the
    aggregate is partial per task and the join splits a hot key under AQE
    (no window that would put a whole hot group in one task).
    """
    g = df.groupBy(*by).agg(F.sum(col).alias("_gs"), F.count(col).alias("_gn"))
    return df.join(g, list(by)).filter(above_mean(col, "_gs", "_gn")).drop("_gs", "_gn")
