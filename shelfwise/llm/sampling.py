"""Bounded, repeatable samples of labelled rows for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled texts longer than this many bytes are not taken into a fitting sample (they are scored like all others).
SAMPLE_TEXT_BYTES = 64 << 10


def held_out(id_col: Column, folds: int) -> Column:
    """True where crc32 of the id as text is divisible by ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % folds == 0


def per_label(rows: DataFrame, label: str, key: str, most: int) -> DataFrame:
    """Rows thinned by a hash of ``key`` to about ``1.5 * most`` of each label (all, where there are fewer).

    Only the count of each label reaches the driver, one row per label.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    u = F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    keep = F.lit(False)
    for value, n in counts.items():
        keep = keep | ((F.col(label) == F.lit(value)) & (u < min(1.0, 1.5 * most / max(n, 1))))
    return rows.where(keep)


def at_most(rows: list, label: str, most: int) -> list:
    """The first ``most`` rows of each label in the given order."""
    seen: dict = {}
    out = []
    for r in rows:
        seen[r[label]] = seen.get(r[label], 0) + 1
        if seen[r[label]] <= most:
            out.append(r)
    return out
