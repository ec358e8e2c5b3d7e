"""Data-quality jobs DQ-01..DQ-29: profile, test, correct, deduplicate, log.

Every profile is one aggregate pass (``count_if`` per rule, partial per
task).  Tests return the failing count (or rows); nothing is collected
except the one-row verdict of a write-audit-publish gate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.functions.exprs import changed
from shelfwise.operators import windows as W
from shelfwise.sources import versions
from shelfwise.sources.raw import guard


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ------------------------------------------------------------------ profiles


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """DQ-01: per column - rows, present, missing, distinct - from one scan.

    A row becomes one (column, value) row per column, counted per task before
    the shuffle; only distinct values with their counts move, and a hot value
    is one row per task.  Values are compared as binary (their text is one to
    one within a column's type).
    """
    zero = {f.name for f in df.schema.fields if f.dataType.typeName() in ("float", "double")}  # adding it makes -0.0 and 0.0 one value
    text = [(F.col(c) + F.lit(0.0) if c in zero else F.col(c)).cast("string") for c in cols]
    pairs = F.array(*[F.struct(F.lit(i).alias("_col"), v.alias("_value")) for i, v in enumerate(text)])
    values = df.select(F.explode(pairs).alias("_p")).select("_p.*").groupBy("_col", "_value").agg(F.count(F.lit(1)).alias("_n"))
    per = values.groupBy("_col").agg(F.sum("_n").alias("row_count"), F.coalesce(F.sum(F.when(F.col("_value").isNotNull(), F.col("_n"))), F.lit(0)).alias("present"),
                                     F.count("_value").alias("distinct_values"))
    names = df.sparkSession.sql("SELECT * FROM VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(c.replace("'", "''") for c in cols)) + " AS t(_col, column_name)")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))  # noqa: E731  an empty table has no values
    return F.broadcast(names).join(per, "_col", "left").select("column_name", n("row_count").alias("row_count"), n("present").alias("present"),
                                                              (n("row_count") - n("present")).alias("missing"), n("distinct_values").alias("distinct_values"))


def profile_counts(df: DataFrame, rules: Mapping[str, Column], rows_name: str = "row_count") -> DataFrame:
    """DQ-02/03/04/16: row count plus one ``count_if`` per named rule (T1: empty input gives 0)."""
    return df.agg(F.count(F.lit(1)).alias(rows_name), *[F.count_if(c).alias(n) for n, c in rules.items()])


def value_counts(df: DataFrame, col) -> DataFrame:
    """DQ-06: distinct values with their row counts."""
    return df.groupBy(_c(col).alias("value")).agg(F.count(F.lit(1)).alias("row_count"))


def duplicates(df: DataFrame, key: Column, name: str = "normalized_value", min_count: int = 2) -> DataFrame:
    """DQ-07: normalised key values occurring at least ``min_count`` times."""
    return (df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("duplicate_count"))
            .filter(F.col("duplicate_count") >= min_count))


def exact_duplicates(df: DataFrame, key: Column, aggs: Sequence[Column], min_count: int = 2) -> DataFrame:
    """DQ-07 for long keys (whole texts): groups of rows whose ``key`` is identical.

    Rows are grouped by the SHA-256 of the key: one partial aggregate whose
    shuffle carries 32 bytes per distinct text of a task, never the text, and
    a text that a third of the rows share is one row per task.
    """
    out = df.groupBy(F.unhex(F.sha2(key, 256)).alias("_k")).agg(F.count(F.lit(1)).alias("duplicate_count"), *aggs)
    return out.filter(F.col("duplicate_count") >= min_count).drop("_k")


def label_failures(rules: Sequence[tuple[str, Column]], valid_label: str = "Valid") -> Column:
    """DQ-09: the first failing rule's label (in list order), else ``valid_label``."""
    out = None
    for label, cond in rules:
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(valid_label))


def flag(cond: Column) -> Column:
    """DQ-10: 1 when the row passes ``cond``, else 0 (NULL fails); the row is kept."""
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(1)).otherwise(F.lit(0))


def email_quality(email) -> Column:
    """DQ-11: 'missing email' / 'invalid email' / 'usable email'."""
    e = _c(email)
    return (F.when(e.isNull() | (F.trim(e) == ""), F.lit("missing email"))
            .when(~e.like("%@%.%"), F.lit("invalid email")).otherwise(F.lit("usable email")))


def map_labels(col, mapping: Mapping[str, Sequence[str]], normalize: bool = True, else_: Column | None = None) -> Column:
    """DQ-13: many raw labels -> one canonical label (``else_`` defaults to TRIM(col))."""
    x = _c(col)
    key = F.lower(F.trim(x)) if normalize else x
    out = None
    for canon, raws in mapping.items():
        cond = key.isin([r.lower() for r in raws] if normalize else list(raws))
        out = F.when(cond, F.lit(canon)) if out is None else out.when(cond, F.lit(canon))
    return out.otherwise(else_ if else_ is not None else F.trim(x))


# ------------------------------------------------------------------ corrections


def preview(df: DataFrame, keys: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """DQ-14: old and corrected values for rows a correction would change.

    A row shows when any rule changes its value or its old value is NULL,
    as the reference preview does.
    """
    cols = [F.col(k) for k in keys]
    for c, new in rules.items():
        cols += [F.col(c).alias(f"old_{c}"), new.alias(f"corrected_{c}")]
    out = df.select(*cols)
    cond = None
    for c in rules:
        ch = changed(f"old_{c}", f"corrected_{c}") | F.col(f"old_{c}").isNull()
        cond = ch if cond is None else cond | ch
    return out.filter(cond)


def correct(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """DQ-15: apply correction rules (the reference UPDATEs a staging copy)."""
    return df.withColumns(dict(rules))


def write_audit_publish(spark: SparkSession, df: DataFrame, rules: Mapping[str, Column], checks: Mapping[str, Column],
                        staging_path: str, target_path: str, max_failures: Mapping[str, int] | None = None) -> DataFrame:
    """DQ-17: stage -> correct -> validate -> publish only if checks pass.

    The corrected rows are written to ``staging_path`` (a new folder; the
    source is never overwritten while it is read) and validated with one
    aggregate over the written rows.  Only then the folder is moved among the
    data folders of the versioned table ``target_path``, where no reader sees
    it, and one commit makes exactly those rows the table
    (:mod:`shelfwise.sources.versions`).  A failed check raises and leaves
    the version as it was (the reference's ROLLBACK), and so does a job that
    dies at any step, or another writer that published meanwhile.
    ``max_failures`` states how many failures of a check are allowed (None:
    any number).  Both paths must lie outside the raw layer, on one file
    system.  The only value reaching the driver is the one-row check result.
    """
    guard(staging_path)
    guard(target_path)
    before = versions.current(spark, target_path)
    corrected = correct(df, rules)
    corrected.write.mode("overwrite").parquet(staging_path)
    staged = spark.read.schema(corrected.schema).parquet(staging_path)
    verdict = profile_counts(staged, checks).collect()[0].asDict()
    limits = dict(max_failures or {})
    bad = {k: v for k, v in verdict.items() if k in checks and limits.get(k, 0) is not None and v > limits.get(k, 0)}
    if bad:
        raise ValueError(f"write-audit-publish blocked, failing checks: {bad}")
    name = versions.adopt(spark, target_path, staging_path)
    versions.commit(spark, target_path, [name], [], before)
    versions.vacuum(spark, target_path)
    return versions.read(spark, target_path, corrected.schema)


# ------------------------------------------------------------------ tests


def _test(name: str, failures: DataFrame) -> DataFrame:
    return failures.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("test_name"), "failures")


def test_not_null(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """DQ-18: rows whose ``col`` is NULL."""
    return _test(name or f"{col} not null", df.filter(F.col(col).isNull()))


def test_unique(df: DataFrame, cols: Sequence[str], name: str | None = None) -> DataFrame:
    """DQ-19: key values that occur more than once."""
    dup = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return _test(name or f"{', '.join(cols)} unique", dup)


def test_accepted(df: DataFrame, col: str, values: Sequence, name: str | None = None) -> DataFrame:
    """DQ-20: values outside the allow-list (NULL fails)."""
    return _test(name or f"{col} accepted values", df.filter(~F.col(col).isin(list(values)) | F.col(col).isNull()))


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """DQ-21 (list): child rows whose non-NULL key has no parent (anti join)."""
    keys = parent.select(F.col(parent_key).alias("_pk"))
    return child.filter(F.col(child_key).isNotNull()).join(keys, F.col(child_key) == F.col("_pk"), "left_anti")


def test_relationship(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str,
                      name: str | None = None) -> DataFrame:
    """DQ-21 (count): failures = orphan child rows, from the counts of the child's keys."""
    keys = child.groupBy(child_key).agg(F.count(F.lit(1)).alias("_n"))
    lost = orphans(keys, child_key, parent, parent_key)
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures")).select(F.lit(name or f"{child_key} -> {parent_key}").alias("test_name"), "failures")


def test_range(df: DataFrame, col: str, lo, hi, name: str | None = None) -> DataFrame:
    """DQ-22: values outside [lo, hi]; NULL fails."""
    ok = F.coalesce(F.col(col).between(lo, hi), F.lit(False))
    return _test(name or f"{col} between {lo} and {hi}", df.filter(~ok))


def quality_report(tests: Sequence[DataFrame]) -> DataFrame:
    """DQ-23: all tests stacked as (test_name, failures)."""
    out = tests[0]
    for t in tests[1:]:
        out = out.unionByName(t)
    return out


# ------------------------------------------------------------------ dedup


def dedup_candidates(df: DataFrame, key: Column, order: Sequence, key_name: str = "normalized_key",
                     rank_name: str = "duplicate_rank") -> DataFrame:
    """DQ-24: ROW_NUMBER per normalised key under the survivor order; rank > 1.

    The numbering is the distributed scan of :func:`windows.number`, so a
    key shared by a third of the rows is still split across tasks.
    """
    numbered = W.number(df.withColumn(key_name, key), order, by=[key_name], out=rank_name)
    return numbered.filter(F.col(rank_name) > 1)


def dedup(df: DataFrame, key: Column, order_col: str, key_name: str = "normalized_key") -> DataFrame:
    """DQ-25: one survivor per normalised key: the row with the smallest ``order_col``.

    The smallest order value per key is a hash aggregate over two narrow
    columns; only the rows that hold it are joined back, and AQE splits a
    hot key in that join.  ``order_col`` is expected to be unique within a
    key; of rows that tie on it the one with the smallest other columns
    survives (compared in their order), so the result never depends on the
    plan.  A NULL order value comes after all others.
    """
    k = df.withColumn(key_name, key)
    others = [c for c in k.columns if c != key_name]
    first = k.groupBy(key_name).agg(F.min(order_col).alias("_first"))
    first = first.select(F.col(key_name).alias("_key"), "_first")
    held = k.join(first, k[key_name].eqNullSafe(F.col("_key")) & k[order_col].eqNullSafe(F.col("_first"))).drop("_key", "_first")
    # ties: few rows are left per key, compared by all their columns
    ranked = held.withColumn("_rank", F.row_number().over(Window.partitionBy(key_name).orderBy(*others)))
    return ranked.filter(F.col("_rank") == 1).select(key_name, *others)


# ------------------------------------------------------------------ log, freshness, distribution


def log_rule(df: DataFrame, table_name: str, rule_name: str, cond: Column, action: str, checked_at) -> DataFrame:
    """DQ-26: one cleaning-log row: table, rule, issue count before, action, time.

    ``checked_at`` is passed in (a literal or ``current_timestamp()``) so a
    rerun can reproduce the row.
    """
    at = checked_at if isinstance(checked_at, Column) else F.lit(checked_at).cast("timestamp_ntz")
    return df.agg(F.count_if(cond).alias("issue_count_before")).select(
        F.lit(table_name).alias("table_name"), F.lit(rule_name).alias("rule_name"), "issue_count_before",
        F.lit(action).alias("action_taken"), at.alias("checked_at"))


def freshness(df: DataFrame, col: str, as_of) -> DataFrame:
    """DQ-28: latest date and days since it, at ``as_of`` (default: today)."""
    ref = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return df.agg(F.max(F.to_date(col)).alias("latest_date")).select(
        "latest_date", F.datediff(ref, F.col("latest_date")).alias("days_since_latest"))


def distribution(df: DataFrame, by: str, col: str, digits: int = 3) -> DataFrame:
    """DQ-29: count/min/max/avg of ``col`` per ``by`` (avg exact, rounded once)."""
    from shelfwise.functions.metrics import mean_half_up
    g = df.groupBy(by).agg(F.count(F.lit(1)).alias("row_count"), F.min(col).alias("min_value"),
                           F.max(col).alias("max_value"), F.sum(F.col(col).cast("decimal(18,4)")).alias("_s"),
                           F.count(col).alias("_n"))
    return g.withColumn("avg_value", mean_half_up("_s", "_n", digits)).drop("_s", "_n")
