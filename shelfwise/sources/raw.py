"""The raw layer: folders that no writer may touch.

A folder becomes raw when tables are loaded from it, or when the session
names it in ``shelfwise.raw.roots`` (comma-separated).
"""

from __future__ import annotations

import posixpath

from pyspark.sql import SparkSession

SETTING = "shelfwise.raw.roots"
_loaded: set[str] = set()


def _parts(path: str) -> list[str]:
    scheme, _, rest = path.rpartition(":")
    if scheme in ("", "file"):
        rest = posixpath.normpath("/" + rest.lstrip("/"))
    return rest.rstrip("/").split("/")


def protect(root: str) -> None:
    _loaded.add(root)


def roots() -> list[str]:
    spark = SparkSession.getActiveSession()
    named = spark.conf.get(SETTING, "") if spark is not None else ""
    return [*_loaded, *filter(None, (r.strip() for r in (named or "").split(",")))]


def guard(path: str) -> None:
    """Raise if ``path`` is a raw folder or lies in one (compared part by part)."""
    mine = _parts(path)
    for root in roots():
        raw = _parts(root)
        if mine[: len(raw)] == raw:
            raise ValueError(f"refusing to write into the raw layer: {path}")
