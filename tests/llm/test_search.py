"""KD-tree search, license scan and decontamination against brute force; the pipeline stage by stage."""

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwise.llm import decontam, kdtree, licenses, registry

SMALL = "/root/testdata/sf0.001"


def top_brute(rows, k, asks):
    good = {}
    for i, x in rows:
        if i is None or not x or any(c is None or not np.isfinite(c) for c in x):
            continue
        v = tuple(int(np.floor(256 * float(np.float32(c)))) for c in x)
        good[i] = min(good.get(i, v), v)
    out = set()
    for q, v in good.items():
        if asks(q):
            best = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in good.items() if j != q and len(w) == len(v))[:k]
            out |= {(q, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    return out


@pytest.mark.parametrize("shard_rows", [7, 50, 4096])
def test_top_k(spark, shard_rows):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1.0, -0.25, 0.0, 0.5, 1.0]) for _ in range(5)]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 5) for i in range(150)]  # ties
    rows += [(2000, None), (2001, [None] * 5), (2002, [float("nan")] * 5), (2003, [float("inf")] * 5), (2004, []), (None, [1.0] * 5)]
    rows += [(2010, [1.0, 2.0]), (2020, [0.5, 1.0]), (2030, [1.0, 2.0, 3.0]), (0, rows[0][1]), (10, [0.0] * 5)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("x")).withColumn("x", F.lit(1))
    got = kdtree.top_k(vectors.repartition(4), F.col("vec_id") % 10 == 0, k=5, shard_rows=shard_rows).collect()
    assert {tuple(r) for r in got} == top_brute(rows, 5, lambda q: q % 10 == 0)


def test_top_k_of_an_empty_table(spark):
    assert kdtree.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") == 0).count() == 0


def test_tree_bounds_hold():
    rng = np.random.default_rng(0)
    x, q = rng.integers(-50, 50, (500, 6)).astype(float), rng.integers(-50, 50, (20, 6)).astype(float)
    tree = kdtree.Tree(x, np.arange(500), leaf=8)
    bound = tree.bounds(q)
    for n, (a, b) in enumerate(tree.span):
        assert ((tree.x[a:b] @ q.T).max(0) <= bound[:, n]).all()


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**17 + i), -float(2**16 - i), 3.0]) for i in range(40)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in kdtree.top_k(vectors, F.col("vec_id") == 0, k=3).collect()}
    v = {i: [int(256 * c) for c in x] for i, x in rows}
    best = sorted((-sum(a * b for a, b in zip(v[0], w)), j) for j, w in v.items() if j)[:3]
    assert got == {(0, r + 1, j, -s) for r, (s, j) in enumerate(best)}


LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def scan_brute(text):
    w = WORD.findall((text or "").translate(LOWER))
    starts, base, every, score = [], set(), set(), 0.0
    for t in licenses.templates():
        for i in range(len(w)):
            if w[i:i + len(t["must"])] == t["must"]:
                if t["base"]:
                    starts.append(i)
                    base.add(t["label"])
                every.add(t["label"])
                s = i - t["at"]
                score = max(score, sum(0 <= s + j < len(w) and w[s + j] == x for j, x in enumerate(t["words"])) / len(t["words"]))
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(every)), round(score, 9)


TEXTS = ["MIT License. mit-license, MIT\nLICENSE", "The GNU General Public License, version 3.", "general public general public license license", "mit é license",
         "Licensed under CC BY-NC 4.0.", "mit", "", None, "Apache License, Version 2.0 " * 400, "Affero General Public License; GNU Lesser General Public License",
         "permission is hereby granted, free of charge, to any person", "License MIT", "KIT lİcense mıt lıcense"]


def test_license_scan(spark, small_docs, small_texts):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn("words", F.lit(1)).withColumn("places", F.lit("p"))
    out = licenses.scan(docs)
    got = {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], round(r["score"], 9)) for r in out.collect()}
    assert got == {i: scan_brute(t) for i, t in enumerate(TEXTS)}
    got = {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], round(r["score"], 9))
           for r in licenses.scan(small_docs, carry=["doc_id"]).collect()}
    assert got == {i: scan_brute(t) for i, t in small_texts.items()}
    assert licenses.scan(docs.limit(0)).count() == 0


def test_license_scan_edges(edge_docs):
    out = licenses.scan(edge_docs, carry=["doc_id"])
    assert out.count() == edge_docs.count() and out.where("n_base > 0").count() == 1


def distance_brute(item, text):
    """The least edits of the item at any place of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def plain(t):
    return re.sub(r"[ \t\n\r\x0b\x0c]+", " ", "".join(c.lower() if len(c.lower()) == 1 else c for c in t or ""))


def test_passages_against_alignment(spark):
    rng = random.Random(6)
    voc = "abcdeé "
    rand = lambda n: "".join(rng.choice(voc) for _ in range(n))
    items = [rand(rng.choice([9, 20, 40, 90])).strip() + "z" for _ in range(12)] + ["", None, "short", "x" * 30]
    docs = []
    for _ in range(60):
        t = rand(rng.randint(0, 150))
        for _ in range(rng.randint(0, 2)):
            p = list(rng.choice(items[:12]))
            for _ in range(rng.choice([0, 1, 2, 5, 9])):
                k, what = rng.randrange(len(p)), rng.random()
                p[k:k + 1] = [rng.choice(voc)] if what < 0.4 else [] if what < 0.7 else [p[k], rng.choice(voc)]
                p = p or ["a"]
            t += "".join(p).upper() + rand(rng.randint(0, 60)).replace(" ", " \n ")
        docs.append(t)
    docs += ["", None, "x" * 500]
    bench = spark.createDataFrame([*enumerate(items), (0, items[0])], "item_id long, text string")
    out = decontam.find_passages(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(2), bench, q=4).collect()
    got = {(r["doc_id"], r["item"]): r["edits"] for r in out}
    assert len(got) == len(out)
    want = {}
    for d, t in enumerate(docs):
        for i, x in enumerate(items):
            x = plain(x).strip()
            if len(x) >= 4 and t:
                budget = max(min(len(x) // 10, (len(x) - 4) // 4), 0)
                e = distance_brute(x, plain(t))
                if e <= budget:
                    want[d, i] = e
    assert got == want
    for r in out:
        part, item = plain(docs[r["doc_id"]][r["start_char"]:r["end_char"]]), plain(items[r["item"]]).strip()
        assert distance_brute(item, part) == r["edits"]


def test_passages_small_table(spark, small_docs, small_texts):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    got = {(r["doc_id"], r["item"]) for r in decontam.find_passages(small_docs, bench).collect()}
    items = {r["item_id"]: plain(r["text"]).strip() for r in bench.collect()}
    assert got >= {(d, i) for d, t in small_texts.items() for i, x in items.items() if x in plain(t)}


def test_passages_edges(spark, edge_docs):
    bench = spark.createDataFrame([(None, "the quick brown fox jumps over the lazy dog"), (1, None)], "item_id long, text string")
    out = decontam.find_passages(edge_docs, bench)
    assert out.count() == 5  # documents 1, 2 twice, 9 and the one without an id
    assert decontam.find_passages(edge_docs, bench.limit(0)).count() == 0
    assert decontam.find_passages(edge_docs.limit(0), bench).count() == 0


def test_benchmark_in_several_indexes(spark, small_docs, monkeypatch):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    one = decontam.find_passages(small_docs, bench, carry=["doc_id"]).collect()
    monkeypatch.setattr(decontam, "INDEX_CHARS", 1000)
    assert sorted(one) == sorted(decontam.find_passages(small_docs, bench, carry=["doc_id"]).collect())


def test_oracle_of_the_search(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    want = con.execute(registry.ORACLES["op1_kd_search"]).fetchall()
    got = [tuple(r) for r in registry.op1_kd_search(spark, SMALL).collect()]
    assert sorted(got) == sorted(want) and len(got) == 50


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{corpus_pipeline.scratch_dir(spark, 'test')}/{name}"
        stage(spark, kept, SMALL).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == docs.columns
        assert after.select("doc_id").exceptAll(kept.select("doc_id")).count() == 0
        kept = after
    assert kept.count() > 0.7 * docs.count()
    assert kept.where(F.char_length("text") != F.col("n_chars")).count() <= docs.where(F.char_length("text") != F.col("n_chars")).count()
    got = corpus_pipeline.run(spark, SMALL)
    assert {r[0] for r in got.select("doc_id").distinct().collect()} == {r[0] for r in kept.select("doc_id").collect()}


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stage_edges(spark, edge_docs, stage):
    out = stage(spark, edge_docs, SMALL)
    out.collect()
    if stage is not corpus_pipeline.packed:
        assert out.columns == edge_docs.columns
    assert stage(spark, edge_docs.limit(0), SMALL).count() == 0
