"""Vector codes against plain Python, the SQL, and unusual vectors."""

import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import registry, vector_codes
from shelfwise.llm.vector_codes import Codebooks, encode, integers, nearest, sequency, walsh

SMALL = "/root/testdata/sf0.001"


def brute(rows, parts, entries, rounds, scale):
    """``{(id, vector): (code, error)}`` and the codebooks of rows (id, vector of floats) by plain integers."""
    longest = max(len(v) for _, v in rows)
    width = -(-longest // parts)
    ints = [(k, [math.floor(scale * x) if abs(x) < 2**50 else int(x) * scale for x in v] + [0] * (parts * width - len(v))) for k, v in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))
    books = [[ints[i][1][p * width: (p + 1) * width] for i in order[:entries]] for p in range(parts)]

    def assign():
        out = []
        for _, x in ints:
            mine = []
            for p in range(parts):
                d = [(sum((a - b) ** 2 for a, b in zip(x[p * width: (p + 1) * width], e)), i) for i, e in enumerate(books[p])]
                mine.append(min(d))
            out.append(mine)
        return out

    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [x[p * width: (p + 1) * width] for (_, x), g in zip(ints, got) if g[p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    return [(k, "".join(f"{e:02x}" for _, e in g), sum(d for d, _ in g)) for (k, _), g in zip(ints, assign())], books


def test_sequency_counts_sign_changes():
    for n in (1, 2, 8, 32):
        rows = walsh(np.eye(n, dtype=np.int64)).T  # row s: the s-th coefficient's pattern
        assert [int((np.diff(r) != 0).sum()) for r in rows] == list(range(n))
        assert sorted(sequency(n)) == list(range(n))


def test_transform_keeps_scaled_distances():
    rng = np.random.default_rng(3)
    for width in (1, 3, 8, 11):
        x, e = rng.integers(-5000, 5000, (200, width)), rng.integers(-5000, 5000, (9, width))
        e[4] = e[2]  # a tie
        n = 1 << (width - 1).bit_length()
        want = ((x[:, None] - e[None]) ** 2).sum(2)
        code, d = nearest(walsh(x), walsh(e))
        assert (code == want.argmin(1)).all() and (d == n * want.min(1)).all()


def test_integers_are_floors_of_any_size():
    vals = [0.1, -0.1, -1e-300, 3e38, -3e38, 1e300, 2.0**53 + 2, 5e-324]
    want = [math.floor(v * 4096) if abs(v) < 1e15 else int(v) * 4096 for v in vals]
    assert integers(np.array(vals), 4096).tolist() == want
    assert integers(np.array(vals[:3]), 4096).tolist() == want[:3]


@pytest.mark.parametrize("dim,parts", [(16, 8), (10, 4), (24, 8)])
def test_against_plain_python(spark, dim, parts):
    rng = np.random.default_rng(dim)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 1, dim)]) for i in rng.permutation(90)]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (None, rows[5][1])]
    df = spark.createDataFrame([(k, v, None if k is None else k % 4) for k, v in rows], "vec_id long, embedding array<float>, label int")
    out, books = encode(df.repartition(5), parts=parts, entries=7, rounds=4)
    want, want_books = brute(rows, parts, 7, 4, 4096)
    got = sorted(((r["vec_id"], r["code"], r["error"]) for r in out.collect()), key=str)
    assert got == sorted(want, key=str)
    assert books.books == want_books
    label = {}
    for k, _, e in want:
        label[None if k is None else k % 4] = label.get(None if k is None else k % 4, 0) + e
    assert all(r["label_error"] == label[r["label"]] for r in out.collect())


def test_values_beyond_64_bits_are_exact(spark):
    rows = [(i, [3e38 if i % 2 else -3e38, float(i % 2), 0.5, 0.25]) for i in range(12)]
    df = spark.createDataFrame([(k, v, 1) for k, v in rows], "vec_id long, embedding array<double>, label int")
    out, books = encode(df, parts=2, entries=2, rounds=3)
    want, want_books = brute(rows, 2, 2, 3, 4096)
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in out.collect()) == sorted(want)
    assert books.books == want_books and abs(books.books[0][0][0]) > 2**100
    assert books.sha256() == hashlib.sha256(",".join(str(v) for b in want_books for e in b for v in e).encode()).hexdigest()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    schema = "vec_id long, embedding array<float>, label string, code int, row string, lab int"
    rows = [(1, [1.0, 2.0, 3.0], "a", 1, "x", 2), (2, None, "a", 1, "x", 2), (3, [1.0, None, 2.0], "a", 1, "x", 2), (4, [nan, 1.0, 1.0], None, 1, "x", 2),
            (5, [inf, 1.0, 1.0], None, 1, "x", 2), (6, [], None, None, None, None), (7, [2.5], None, 1, "x", 2), (None, [1.0, 2.0, 3.0], "b", 1, "x", 2)]
    out, books = encode(spark.createDataFrame(rows, schema), parts=2, entries=4)
    assert out.columns == ["vec_id", "label", "row", "lab", "code", "error", "label_error"]
    got = {r["vec_id"]: r for r in out.collect()}
    assert set(got) == {1, 6, 7, None} and len(books.books[0]) == 4
    assert got[1]["code"] == got[None]["code"] and all(r["error"] == 0 == r["label_error"] for r in got.values())
    assert [float(x) for x in vector_codes.decode(got[7]["code"], books)] == [2.5, 0, 0, 0]
    none, books = encode(spark.createDataFrame([], schema))
    assert none.count() == 0 and books.sha256() == hashlib.sha256(b"").hexdigest()
    blank, _ = encode(spark.createDataFrame([(1, [], None, 1, "x", 2)], schema))
    assert [(r["code"], r["error"]) for r in blank.collect()] == [("00" * 8, 0)]
    plain, _ = encode(spark.createDataFrame(rows, schema), label_col=None, parts=2)
    assert plain.columns == ["vec_id", "label", "row", "lab", "code", "error"] and plain.count() == 4


def test_hot_label_is_summed_not_gathered(spark):
    df = spark.range(600).select(F.col("id").alias("vec_id"), F.array(*[(F.col("id") * k % 7).cast("float") for k in range(8)]).alias("embedding"),
                                 F.when(F.col("id") % 3 > 0, F.lit(1)).alias("label"))
    rows = encode(df, rounds=1)[0].collect()
    for label in (1, None):
        assert {r["label_error"] for r in rows if r["label"] == label} == {sum(r["error"] for r in rows if r["label"] == label)}


def test_entries_of_one_book_need_not_be_used():
    books = Codebooks([[[0, 0], [0, 0], [9, 9]]], 2)
    code, error = books.assign(np.array([[0, 1], [8, 9]]))
    assert code.tolist() == [[0], [2]] and error.tolist() == [1, 1]


def test_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    cur = con.execute(registry.ORACLES["op12_vector_codes"])
    names = [d[0] for d in cur.description]
    out = registry.op12_vector_codes(spark, SMALL)
    assert sorted(tuple(r[n] for n in names) for r in out.collect()) == sorted(cur.fetchall())
