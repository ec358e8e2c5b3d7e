"""Repeated windows and byte strings, and the similarity join, against plain Python over whole texts."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import decontam, jaccard, packing
from shelfwise.llm.components import components
from shelfwise.llm.jaccard import Parts, divide_skip, keep_one, link_documents
from shelfwise.llm.substring import COVERS, cover_for, remove_repeated_windows
from shelfwise.llm.suffix import RESOLVED, anchored, remove_repeated_bytes, repeated_starts, suffix_array

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile("[^\x20\x09-\x0D]+")


def windows_brute(texts, size):
    split = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(ws[i:i + size]) for ws in split for i in range(len(ws) - size + 1))
    out = []
    for ws in split:
        gone = [False] * len(ws)
        for i in range(len(ws) - size + 1):
            if seen[tuple(ws[i:i + size])] > 1:
                gone[i:i + size] = [True] * size
        out.append((len(ws), sum(gone), " ".join(w for w, g in zip(ws, gone) if not g)))
    return out


def bytes_brute(texts, size):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + size] for b in raw for i in range(len(b) - size + 1))
    out = []
    for b in raw:
        gone = [False] * len(b)
        for i in range(len(b) - size + 1):
            if seen[b[i:i + size]] > 1:
                gone[i:i + size] = [True] * size
        spans = [i for i in range(len(b)) if gone[i] and not (i and gone[i - 1])]
        out.append((len(b), sum(gone), len(spans), bytes(c for c, g in zip(b, gone) if not g)))
    return out


def links_brute(texts, k, num, den):
    sets = []
    for t in texts:
        ws = WORD.findall((t or "").translate(LOWER))
        sets.append(frozenset(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)) if len(ws) >= k else frozenset([tuple(ws)] if ws else []))
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
             and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])]
    return sets, pairs


def groups(n, pairs):
    top = list(range(n))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        top[b] = a
    return [root(x) for x in range(n)]


def noisy_texts(seed, n=60):
    """Copies, near copies, shared passages, runs of one word, short and empty texts."""
    rng = random.Random(seed)
    voc = ["a", "bb", "Ccc", "dé", "eee", "ff", "g", "東"]
    rand = lambda k: [rng.choice(voc) for _ in range(k)]
    passage, texts = rand(30), []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.2 and texts:
            texts.append(rng.choice(texts))
        elif kind < 0.5 and texts:
            ws = rng.choice(texts).split()
            for _ in range(rng.randint(1, 2)):
                if ws:
                    ws[rng.randrange(len(ws))] = rng.choice(voc)
            texts.append(" ".join(ws))
        elif kind < 0.7:
            texts.append(" ".join(rand(rng.randint(0, 20)) + passage[rng.randint(0, 5):rng.randint(20, 30)] + rand(rng.randint(0, 20))))
        elif kind < 0.8:
            texts.append(rng.choice(voc) * rng.randint(0, 90) + "\n" + (rng.choice(voc) + " ") * rng.randint(0, 50))
        else:
            texts.append(" ".join(rand(rng.randint(0, 70))))
    return texts + ["", None, " \t", "one"]


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("period,cover", COVERS)
def test_covers_hold_every_difference(period, cover):
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("window", [1, 2, 3, 7, 12, 35, 50])
def test_cover_leaves_an_anchor(window):
    period, _ = cover_for(window)
    assert 1 <= period <= window


@pytest.mark.parametrize("size,seed", [(5, 1), (12, 2), (35, 3)])
def test_repeated_windows(spark, size, seed):
    texts = noisy_texts(seed)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in remove_repeated_windows(frame(spark, texts), size).collect()}
    assert got == dict(enumerate(windows_brute(texts, size)))


def test_repeated_windows_small_table(spark, small_docs, small_texts):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in remove_repeated_windows(small_docs).collect()}
    assert got == dict(zip(small_texts, windows_brute(small_texts.values(), 35)))


def test_suffix_array():
    rng = random.Random(4)
    for _ in range(800):
        t = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 40))] + [0]
        assert suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


def peak_mb(f):
    tracemalloc.start()
    try:
        f()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_suffix_task_memory():
    """A block of 2 MB is worked on in short runs, and strings are resolved some at a time: a task stays below 50 MB."""
    rng = np.random.default_rng(8)
    texts = pa.array(["".join(map(chr, rng.integers(97, 123, 2000))) for _ in range(1000)])
    assert peak_mb(lambda: [a.cores() for _, _, a in anchored(texts, 200, 60, 16)]) < 50
    core = np.sort(rng.integers(0, RESOLVED // 4, RESOLVED).astype(np.uint64))
    side = [bytes(rng.integers(97, 123, 30, dtype=np.uint8)) for _ in range(RESOLVED)]
    assert peak_mb(lambda: repeated_starts(core, side, side[::-1], np.ones(RESOLVED, np.int32), 60)) < 50


def test_run_memory():
    """Packing with small caches, the search for benchmark texts and the shingles' parts work on short runs of a batch's texts."""
    rng = np.random.default_rng(9)
    some = np.array(["".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(2, 9, 3000)])
    texts = [" ".join(some[rng.integers(0, len(some), 350)]) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "txt"])
    flipped = batch.select(["txt", "doc_id"])
    pack = packing.packer(public_tokenizers.path("word_bpe_49k.json"), 2048, 1, False, False)
    assert peak_mb(lambda: list(pack(iter([batch])))) < 40
    search = decontam._searcher([1], [" ".join(texts[7].split()[20:40])], 8, 10, "int")
    assert peak_mb(lambda: list(search(iter([flipped])))) < 55
    parts = jaccard._postings(5, 4, 5, 8, np.zeros(0, np.uint64))
    assert peak_mb(lambda: list(parts(iter([flipped])))) < 60


@pytest.mark.parametrize("size,seed", [(1, 5), (3, 6), (20, 7), (60, 8), (150, 9)])
def test_repeated_bytes(spark, size, seed):
    texts = noisy_texts(seed)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in remove_repeated_bytes(frame(spark, texts), size).collect()}
    assert got == dict(enumerate(bytes_brute(texts, size)))


def test_repeated_bytes_small_table(spark, small_docs, small_texts):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in remove_repeated_bytes(small_docs).collect()}
    assert got == dict(zip(small_texts, bytes_brute(small_texts.values(), 400)))


@pytest.mark.parametrize("k,num,den,seed", [(4, 85, 100, 1), (5, 4, 5, 2), (2, 1, 2, 3), (1, 85, 100, 4)])
def test_links(spark, k, num, den, seed):
    texts = noisy_texts(seed, 150)
    sets, pairs = links_brute(texts, k, num, den)
    degree = Counter(x for p in pairs for x in p)
    want = {i: (len(sets[i]), g, degree[i]) for i, g in enumerate(groups(len(texts), pairs))}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in link_documents(frame(spark, texts), k, num, den).collect()}
    assert got == want
    assert {r["doc_id"] for r in keep_one(frame(spark, texts), k, num, den).collect()} == {i for i, (_, g, _) in want.items() if g == i}


def test_links_of_one_large_cluster(spark):
    """More near copies than a chunk holds: their links meet across chunks."""
    rng = random.Random(9)
    ws = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(300):
        mine = list(ws)
        for _ in range(rng.randint(1, 4)):
            mine[rng.randrange(len(mine))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(mine))
    sets, pairs = links_brute(texts, 4, 85, 100)
    got = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in link_documents(frame(spark, texts)).collect()}
    degree = Counter(x for p in pairs for x in p)
    assert got == {i: (g, degree[i]) for i, g in enumerate(groups(len(texts), pairs))}


def sent_bytes(plan):
    """Bytes of the rows that the exchanges of an executed plan have dealt out."""
    own = plan.metrics().get("dataSize").get().value() if plan.nodeName() == "Exchange" else 0
    return own + sum(sent_bytes(plan.children().apply(i)) for i in range(plan.children().size()))


def test_links_of_chained_texts(spark, monkeypatch):
    """Texts that only share a passage with the next one, near copies of some, and a large group of near copies.

    What is sent to the search grows with the sets, not with the square of a cluster.
    """
    rng = random.Random(12)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]

    def near(ws):
        ws = list(ws)
        ws[rng.randrange(len(ws))] = f"x{rng.randrange(10**6)}"
        return ws

    shared = [words(12) for _ in range(301)]
    chain = [shared[i] + words(60) + shared[i + 1] for i in range(300)]
    chain += [near(chain[i]) for i in range(0, 300, 10) for _ in range(2)]
    base = words(120)
    texts = [" ".join(ws) for ws in chain + [near(near(base)) for _ in range(250)]]
    texts += texts[::40]
    sets, pairs = links_brute(texts, 5, 4, 5)
    degree = Counter(x for p in pairs for x in p)
    plans, inner = [], jaccard.cluster_links

    def watched(*args):
        plans.append(inner(*args))
        return plans[-1]

    monkeypatch.setattr(jaccard, "cluster_links", watched)
    monkeypatch.setattr(jaccard, "CHUNK", 16)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in link_documents(frame(spark, texts), 5, 4, 5).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == {i: (g, degree[i]) for i, g in enumerate(groups(len(texts), pairs))}
    assert sum(sent_bytes(x._jdf.queryExecution().executedPlan()) for x in plans) < 7 * 8 * sum(map(len, sets))


def test_links_of_repeated_rows_in_a_large_cluster(spark, monkeypatch):
    rng = random.Random(13)
    base = [f"w{i}" for i in range(90)]
    texts = [" ".join(base[:i] + [f"x{rng.randrange(10**6)}"] + base[i + 1:]) for i in rng.choices(range(90), k=40)]
    texts += texts[:15]
    ids = [*range(40), *range(15)]  # rows 40 .. 54 repeat the first ones
    sets, pairs = links_brute(texts, 5, 4, 5)
    degree = Counter(x for p in pairs for x in p)
    monkeypatch.setattr(jaccard, "CHUNK", 8)
    got = link_documents(spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string"), 5, 4, 5).collect()
    assert sorted((r["doc_id"], r["n_links"]) for r in got) == sorted((i, degree[x]) for x, i in enumerate(ids))


def test_clustered_anew_loses_no_link(spark):
    """Sets at the threshold and below, with shingles that many share, stay together if they link."""
    rng = np.random.default_rng(14)
    common = np.unique(rng.integers(0, 2**63, 40).astype(np.uint64))
    sets = []
    for i in range(120):
        n = int(rng.integers(1, 60))
        x = np.concatenate([rng.integers(0, 2**63, n).astype(np.uint64), rng.choice(common, rng.integers(0, 30), replace=False)])
        sets += [np.unique(x), np.unique(x[: -(-4 * len(x) // 5)]), np.unique(np.append(x[1:], rng.integers(0, 2**63, 1).astype(np.uint64)))]
    rows = [(int(i) + 1, len(x), bytearray(x.tobytes())) for i, x in enumerate(sets)]
    got = {r["node"]: r["root"] for r in jaccard.clustered_anew(spark.createDataFrame(rows, "c_cls long, n long, elements binary"), 4, 5).collect()}
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))]
    assert len(links) > 200 and all(got[i + 1] == got[j + 1] for i, j in links)


def test_packed_sets():
    rng = np.random.default_rng(15)
    base = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
    sets = [np.sort(np.append(rng.choice(base, 280, replace=False), rng.integers(0, 2**63, 9).astype(np.uint64))) for _ in range(100)] + [base[:1], base]
    keys, copies = np.arange(102) - 50, np.arange(102) + 1
    packed = jaccard.pack_sets(keys, copies, sets)
    assert len(packed) < sum(x.nbytes for x in sets) / 5
    for want, got in zip((keys, copies), jaccard.unpack_sets(packed)):
        assert want.tolist() == got.tolist()
    assert all(np.array_equal(x, y) for x, y in zip(sets, jaccard.unpack_sets(packed)[2], strict=True))


def test_parts_meet_for_every_linking_pair():
    """Two sets at the threshold share a signature, whichever elements differ."""
    rng = np.random.default_rng(1)
    for n in [*range(2, 60), 200, 999]:
        x = rng.integers(0, 2**63, n).astype(np.uint64)
        drop = 15 * n // 100
        y = x[drop:]
        if 100 * len(y) < 85 * n or not drop:
            continue
        h = np.concatenate([np.sort(x), np.sort(y)])
        for share in (0, 0.3, 0.9, 1):  # whatever part of the shingles is frequent
            frequent = np.sort(x[rng.random(n) < share])
            sig, row = Parts(85, 100).signatures(h, np.array([0, n, n + len(y)]), frequent)
            assert set(sig[row == 0].tolist()) & set(sig[row == 1].tolist()), (n, share)


def test_divide_skip():
    rng = random.Random(3)
    for _ in range(30):
        sets = [np.array(sorted(rng.sample(range(25), rng.randint(1, 12))), np.uint64) for _ in range(40)]
        want = {(i, j) for i in range(40) for j in range(i + 1, 40) if 10 * len(np.intersect1d(sets[i], sets[j])) >= 6 * len(np.union1d(sets[i], sets[j]))}
        every = list(range(40))
        assert set(divide_skip(every, every, sets, 6, 10)) == want
        assert set(divide_skip(every[:20], every[20:], sets, 6, 10)) == {p for p in want if p[0] < 20 <= p[1]}


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(300 + i, 301 + i) for i in range(60)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    want = groups(400, real)
    assert got == {x: want[x] for p in real for x in p}


def test_edges_of_windows_and_bytes(spark, edge_docs):
    out = remove_repeated_windows(edge_docs, 35)
    assert out.columns == [c for c in edge_docs.columns if c != "text"] + ["n_words", "n_removed", "kept_text"]
    assert out.count() == edge_docs.count()
    rows = {r["doc_id"]: r for r in out.where("doc_id is not null").collect()}
    assert rows[3]["n_words"] == rows[4]["n_words"] == rows[5]["n_words"] == 0
    assert rows[8]["n_removed"] == 30_000
    out = remove_repeated_bytes(edge_docs, 400)
    assert out.count() == edge_docs.count()
    rows = {r["doc_id"]: r for r in out.where("doc_id is not null").collect()}
    assert rows[3]["n_bytes"] == 0 and rows[8]["n_removed"] == 150_000 and rows[1]["n_removed"] == rows[1]["n_bytes"]


def test_edges_of_links(spark, edge_docs):
    out = link_documents(edge_docs)
    assert out.count() == edge_docs.count()
    assert out.where("doc_id = 3").first()["component_id"] == 3
    assert {r["component_id"] for r in out.where("doc_id in (1, 2)").collect()} == {1}
    kept = keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(r[0] for r in kept.where("doc_id is not null").select("doc_id").collect()) == [1, 3, 4, 5, 6, 7, 8, 9, 10]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeated_windows(none).count() == remove_repeated_bytes(none).count() == link_documents(none).count() == keep_one(none).count() == 0
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    nulls = spark.createDataFrame([(None, None), (None, None)], "doc_id long, text string")
    assert remove_repeated_windows(nulls).count() == remove_repeated_bytes(nulls).count() == link_documents(nulls).count() == keep_one(nulls).count() == 2


def test_equal_rows_keep_one(spark):
    rows = [(1, "one two three four five six")] * 3 + [(1, "quite another text of some words")]
    assert keep_one(spark.createDataFrame(rows, "doc_id long, text string")).where(F.col("doc_id") == 1).count() == 2


def test_links_without_ids(spark):
    """Rows without an id, or with a shared one, link as rows with ids of their own do, and only with what their texts say."""
    rng = np.random.default_rng(3)
    common = " ".join(f"w{x}" for x in rng.integers(0, 10_000, 200))
    texts = [f"{common} tail{i}" for i in range(60)] + [" ".join(f"v{x}" for x in rng.integers(0, 10_000, 50)) for _ in range(20)] + [common, common, "", None]
    sets = [{tuple(ws[i:i + 4]) for i in range(len(ws) - 3)} for ws in (WORD.findall(t or "") for t in texts)]
    links = [sum(i != j and bool(x) and 100 * len(x & y) >= 85 * len(x | y) for j, y in enumerate(sets)) for i, x in enumerate(sets)]
    ids = [(None, 7, i)[i % 3] for i in range(len(texts))]
    got = link_documents(spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")).collect()
    assert sorted((r["n_shingles"], r["n_links"]) for r in got) == sorted((len(s), n) for s, n in zip(sets, links)) and max(links) == 61
    assert {r["component_id"] for r in got if r["n_links"]} == {min(x for x, n in zip(ids, links) if n and x is not None)}
