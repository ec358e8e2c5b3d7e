"""Inputs that once were lost silently."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import decontam, kdtree


def plain_top(rows, k):
    out = []
    for q, x in rows:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def test_search_keeps_vectors_of_any_finite_size(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(v)) for v in rng.normal(0, 1, 2)]) for i in range(200)]
    rows[7] = (7, [300_000.0, 1.0])
    rows[11] = (11, [2.0**40, -3.0])
    rows[13] = (13, [2.0**40, -2.0**33])
    rows[50] = (50, [-70_000.0, 2.0])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ints = [(i, [int(np.floor(v * 256)) if abs(v) < 2**40 else int(v) * 256 for v in x]) for i, x in rows]
    got = kdtree.top_k(df, F.col("vec_id") % 50 == 0, shard_rows=64).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == plain_top(ints, 5)


def test_a_score_that_no_long_can_hold_raises(spark):
    df = spark.createDataFrame([(0, [1e20, 1.0]), (1, [1e20, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception):
        kdtree.top_k(df, F.col("vec_id") == 0).collect()


def test_decontamination_keys_that_would_not_fit_one_integer(spark, monkeypatch):
    """Rows are searched in halves, down to one row, with the same result."""
    rng = np.random.default_rng(4)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9)))
    items = [(i, " ".join(word() for _ in range(12))) for i in range(15)]
    texts = [" ".join([word() for _ in range(30)] + ([items[i % 15][1]] if i % 3 else []) + [word() for _ in range(9)]) for i in range(60)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame(items, "item_id long, text string")
    index = decontam.Index([t for _, t in items], 8, 10)
    chars = [np.frombuffer(t.encode(), np.uint8).astype(np.uint32) for t in texts[:60]]
    flat, offs = np.concatenate(chars), np.append(0, np.cumsum([len(c) for c in chars]))
    whole = [x.tolist() for x in index.candidates(flat, offs)]
    monkeypatch.setattr(decontam, "MOST_KEYS", 100_000)
    halves = [x.tolist() for x in index.candidates(flat, offs)]
    one = [(r, i, b) for r, i, b in zip(*whole)]
    assert {(r, i) for r, i, _ in one} == set(zip(*halves[:2])) and len(one) > 0
    found = {(r["doc_id"], r["item"]) for r in decontam.find_passages(docs, bench).collect()}
    assert found >= {(i, i % 15) for i in range(60) if i % 3}
