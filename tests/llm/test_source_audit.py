"""Source divergence against plain Python and SQL; runs, merges and corrections by themselves."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import registry, source_audit
from shelfwise.llm.source_audit import Block, divergence, excess, share

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least_docs=3, top=200):
    """Result rows of (text, lang, source), term by term."""
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        ws = [w.translate(LOWER) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups[lang].add(source)
        count[lang, source].update(ws)
        docs[lang].update(set(ws))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        v = len(kept)
        n = {s: sum(count[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: 1 + 10**9 * (count[lang, s][t] + 1) // (n[s] + v) for t in kept} for s in sources}
        q = {t: 1 + 10**9 * (sum(count[lang, s][t] for s in sources) + 1) // (sum(n.values()) + v) for t in kept}
        for s in sources:
            pairs = [(sum((p[s][w] - p[t][w]) ** 2 // p[t][w] for w in kept), t) for t in sources if t != s]
            terms = [((p[s][w] - q[w]) ** 2 // q[w], w) for w in kept if count[lang, s][w] and p[s][w] > q[w]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found)]
    return sorted(out)


def made(docs, **kw):
    return sorted(tuple(r) for r in divergence(docs, **kw).collect())


def test_against_plain_python_and_sql(spark, small_docs):
    rows = [(r["text"], r["lang"], r["source"]) for r in small_docs.collect()]
    got = made(small_docs)
    assert got == brute(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    assert got == sorted(con.execute(registry.ORACLES["op11_source_audit"]).fetchall())


@pytest.mark.parametrize("block,fan,tile,pairs,step", [(40, 2, 2, 7, 30), (7, 3, 100, 10**6, 10**6)])
def test_small_blocks_many_merges_and_tiles(spark, small_docs, monkeypatch, block, fan, tile, pairs, step):
    """Spills, merge levels, tiles of sources and steps of terms change nothing."""
    docs = small_docs.limit(60).select("text", "lang", F.concat("source", F.lit("-é")).alias("source")).repartition(9).cache()
    for name, value in (("BLOCK_POSTINGS", block), ("FAN", fan), ("TILE", tile), ("PAIRS", pairs), ("STEP_POSTINGS", step), ("SHARD_BYTES", 20_000), ("PIECE", 50)):
        monkeypatch.setattr(source_audit, name, value)
    rows = [(r["text"], r["lang"], r["source"]) for r in docs.collect()]
    assert made(docs, least_docs=2, top_terms=5) == brute(rows, 2, 5)


def test_edges(spark, edge_docs):
    rows = [(r["text"], r["lang"], r["source"]) for r in edge_docs.collect()]
    for least in (1, 3):
        assert made(edge_docs, least_docs=least) == brute(rows, least)
    empty = spark.createDataFrame([], edge_docs.schema)
    assert divergence(empty).count() == 0
    blank = spark.createDataFrame([(None, None, "a"), ("", None, "b"), ("1 2 _", "", None)], "text string, lang string, source string")
    assert made(blank) == brute([(None, None, "a"), ("", None, "b"), ("", "", None)]) and len(made(blank)) == 6


def test_terms_are_letters_and_whatever_is_beyond_ascii():
    text = "Ünder_Score x2Y\tÀB-[z]{~}日本 \u212a"
    assert [w.decode() for ws in source_audit.terms_of(text.encode()) for w in ws] == ["Ünder", "score", "x", "y", "Àb", "z", "日本", "\u212a"]


def test_runs_are_sorted_and_merge_to_the_counts(monkeypatch):
    rng = np.random.default_rng(1)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    whole, batches = Counter(), []
    for part in range(3):
        block = Block()
        for _ in range(40):
            key = ("en", f"s{rng.integers(4)}")
            ws = rng.choice(words, rng.integers(0, 30)).tolist()
            block.add(key, " ".join(ws).encode())
            whole.update((w, *key) for w in ws)
        batches.append(block.run(3, part))
    got = Counter()
    for shard in range(3):
        mine = pa.Table.from_batches(batches).filter(pa.compute.equal(pa.Table.from_batches(batches).column("shard"), shard))
        assert all(t.split(b" ") == sorted(t.split(b" ")) for t in mine.column("terms").to_pylist())
        once = source_audit._merge_runs(mine)
        for table in (mine, once):
            last = b""
            for term, total, names in source_audit.merged(table):
                assert term > last
                last = term
                if table is once:
                    got.update({(term.decode(), *names[g]): c for g, (c, _) in total.items()})
    assert got == whole
    assert Block().run(4, 0) is None


def test_shares_are_exact_for_large_counts():
    total = np.array([9_000_000_000_000_000, 10**15 + 7, 3, 1], np.int64)
    count = np.array([8_999_999_999_999_998, 10**14, 1, 0], np.int64)
    assert share(count, total).tolist() == [1 + 10**9 * (c + 1) // t for c, t in zip(count.tolist(), total.tolist())]
    p, q = np.array([10**9 + 1, 1, 5]), np.array([1, 10**9 + 1, 5])
    assert excess(p, q).tolist() == [(a - b) ** 2 // b for a, b in zip(p.tolist(), q.tolist())]


def test_a_language_in_one_source_and_a_hot_source(spark):
    rows = [("alpha beta", "en", "hot")] * 300 + [("alpha gamma", "en", f"s{i % 30}") for i in range(90)] + [("uno", "es", "only")] * 4
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert made(docs) == brute(rows)
