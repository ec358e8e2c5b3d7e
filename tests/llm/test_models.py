"""Trained operators: language ID, quality, language model; packing round trips."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfwise.llm import gru_lm, langid, packing, quality
from shelfwise.llm.sampling import held_out

DATA = "/root/testdata/sf0.01"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def test_held_out_is_crc32_of_the_id_as_text(spark):
    got = spark.range(50).select("id", held_out(F.col("id"), 5).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in got)


def test_language_of_held_out_documents(spark, docs):
    model = langid.fit(docs, ~held_out(docs["doc_id"], 5), per_class=200)
    out = langid.predict(docs, model, carry=["doc_id", "lang"])
    got = out.where(held_out(F.col("doc_id"), 5)).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97
    assert all(0 <= r["lang_score"] <= 1 for r in got)
    assert out.count() == docs.count()


def test_language_edges(spark, docs, edge_docs):
    model = langid.fit(docs, F.lit(True), per_class=60)
    out = langid.predict(edge_docs, model)
    assert out.columns == edge_docs.columns + ["lang_pred", "lang_score"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert all(rows[k]["lang_pred"] == "und" and rows[k]["lang_score"] == 0 for k in (3, 4, 5))
    assert rows[8]["lang_pred"] in model.labels
    empty = spark.createDataFrame([], edge_docs.schema)
    assert langid.fit(empty, F.lit(True)) is None
    assert langid.predict(empty, model).count() == 0
    assert {r["lang_pred"] for r in langid.predict(edge_docs, None).collect()} == {"und"}


def test_language_score_does_not_depend_on_the_batch(docs):
    model = langid.fit(docs, F.lit(True), per_class=40)
    texts = ["El niño y la ciudad.", "", "Ça va?", "der die das"]
    raw = [t.encode() for t in texts]
    offs = np.append(0, np.cumsum([len(b) for b in raw]))
    together, _ = model.logits(np.frombuffer(b"".join(raw), np.uint8), offs)
    alone = np.vstack([model.logits(np.frombuffer(b, np.uint8), np.array([0, len(b)]))[0] for b in raw])
    assert np.allclose(together, alone, atol=1e-4)


def test_document_frequencies(spark):
    texts = spark.createDataFrame([("ab",), ("ab ab",), (None,), ("c",)], "txt string")
    df, rows = langid.document_frequencies(texts)
    assert rows == 4 and df.max() == 2


def test_quality_of_held_out_documents(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    big = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = quality.fit(big, labels, lambda k: ~held_out(k, 5), per_class=400)
    got = quality.score(big, model, carry=["doc_id"]).where(held_out(F.col("doc_id"), 5)).join(labels, "doc_id").select("quality_score", "quality").collect()
    good, bad = ([r[0] for r in got if r[1] == v] for v in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert all(0 <= r[0] <= 1 for r in got)


def test_quality_edges(spark, docs, edge_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0), (6, None, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(edge_docs, labels, lambda k: F.lit(True))
    out = quality.score(edge_docs, model)
    assert out.columns == edge_docs.columns + ["quality_score"] and out.count() == edge_docs.count()
    assert out.where("quality_score is null or isnan(quality_score)").count() == 0
    none = quality.fit(edge_docs, labels.limit(0), lambda k: F.lit(True))
    assert {r["quality_score"] for r in quality.score(edge_docs, none).collect()} == {0.5}
    assert quality.score(edge_docs.limit(0), none).count() == 0


def test_language_model_counts_and_gain(spark, docs):
    out = gru_lm.score_documents(docs, ~held_out(docs["doc_id"], 10), carry=["doc_id"], updates=150).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    split = {d: (t or "").encode().lower().split() + [b" "] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in texts}
    c = Counter(w for d, ws in split.items() if not held[d] for w in ws)
    n, v = sum(c.values()), len(c)
    gain = 0.0
    for r in out:
        ws = split[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(w in c for w in ws), n)
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert abs(base - r["base_score"]) < 1e-6 * abs(base) + 1e-9
        if held[r["doc_id"]]:
            gain += r["score"] - r["base_score"]
    assert len(out) == len(texts) and gain > 0


def _vocabulary():
    counts = np.array([50, 40, 30, 20, 10, 9, 8, 7, 5, 3, 2, 1], float)
    return gru_lm.Vocabulary([f"w{i}" for i in range(12)], counts, int(counts.sum()) + 20, 20, ["w1", "w2"], np.array([4.0, 6.0, 10.0]), np.array([2.0, 3.0, 3.0]))


def test_state_is_carried_across_windows():
    v = _vocabulary()
    net = gru_lm.Network(v)
    rng = np.random.default_rng(2)
    ids, cls, inside, _ = v.tables(v.words, v.counts)
    docs = [rng.integers(0, 12, n) for n in (1, 200, 7, 64, 65, 128)]
    first = np.append(0, np.cumsum([len(d) for d in docs]))
    tokens = np.concatenate(docs)
    whole = net.score(tokens, first, ids, cls, inside, window=1000)
    assert np.allclose(whole, net.score(tokens, first, ids, cls, inside, window=5), rtol=1e-5)
    alone = [net.score(d, np.array([0, len(d)]), ids, cls, inside)[0] for d in docs]
    assert np.allclose(whole, alone, rtol=1e-4)


def test_output_sums_to_one():
    v = _vocabulary()
    net = gru_lm.Network(v)
    h = np.random.default_rng(0).normal(0, 0.5, (1, gru_lm.STATE)).astype(np.float32)
    short = sum(math.exp(net.log_probs(h, np.array([i]), np.array([v.short_class[i]]))[0][0]) for i in range(v.short))
    others = sum(math.exp(net.log_probs(h, np.array([0]), np.array([c]))[0][0]) for c in range(v.n_short, v.n_class))
    assert abs(short + others - 1) < 1e-4


def test_gradients_match_differences():
    """Truncated backpropagation over one window equals numeric derivatives of its loss."""
    v = _vocabulary()
    cls_of = np.append(v.short_class, v.n_short + np.arange(3))
    text = np.random.default_rng(1).integers(0, 12, 12)

    def loss(net):
        h, total = np.zeros((1, gru_lm.STATE), np.float64), 0.0
        for t in text[:6]:
            total -= net.log_probs(h, np.array([t]), np.array([cls_of[t]]))[0][0]
            h = net.step(np.array([t]), h)[0]
        return total

    net = gru_lm.Network(v)
    net.p = {k: x.astype(np.float64) for k, x in net.p.items()}
    before = {k: x.copy() for k, x in net.p.items()}
    # a plain first step of Adam moves every touched parameter against its gradient's sign
    net2 = gru_lm.Network(v)
    net2.p = {k: x.copy() for k, x in before.items()}
    net2.train([text[:6]], cls_of, streams=1, steps=6, updates=1, rate=1e-3)
    for name, at in (("u", (2, 5)), ("cls", (1, 0)), ("gates", (int(text[0]), 45)), ("out", (int(text[3]), 3))):
        moved = net2.p[name][at] - before[name][at]
        up = {k: x.copy() for k, x in before.items()}
        up[name][at] += 1e-5
        net.p = up
        hi = loss(net)
        up[name][at] -= 2e-5
        slope = (hi - loss(net)) / 2e-5
        if abs(slope) > 1e-4:
            assert moved * slope < 0, name


def test_language_model_edges(spark, edge_docs):
    out = gru_lm.score_documents(edge_docs, F.lit(True), updates=5)
    assert out.columns.count("score") == 1 and dict(out.dtypes)["score"] == "double"
    assert out.count() == edge_docs.count()
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[3]["n_tokens"] == rows[4]["n_tokens"] == rows[5]["n_tokens"] == 1 and rows[8]["n_tokens"] == 30_001
    nothing = gru_lm.score_documents(edge_docs, F.lit(False), updates=5).collect()
    assert [r for r in nothing if r["n_known"] or r["score"] != r["base_score"]] == []
    assert gru_lm.score_documents(edge_docs.limit(0), F.lit(True)).count() == 0


def test_language_model_learns_from_every_row(spark):
    """More rows than any sample, long, empty, null and repeated texts: each is read to its end, in every layout."""
    texts = [f"w{i % 7} w{i % 5} end" for i in range(1500)] + ["one two " * 20_000, "", None] + ["the same text"] * 400
    rows = spark.createDataFrame([(t,) for t in texts], "txt string").repartition(5).withColumn("mark", F.xxhash64("txt"))
    v = gru_lm.vocabulary(gru_lm.word_counts(rows.select("txt")))
    assert v.tokens == sum(len((t or "").split()) + 1 for t in texts)
    assert gru_lm.train_network(rows, v, updates=1)[1] == v.tokens
    gru_lm.TASK_TOKENS, before = 1000, gru_lm.TASK_TOKENS
    try:
        assert gru_lm.train_network(rows, v, updates=1)[1] == v.tokens
    finally:
        gru_lm.TASK_TOKENS = before


def test_language_model_learns_from_long_texts(spark):
    """A corpus of long texts only; words that follow each other strictly cost far less than by their counts."""
    docs = spark.createDataFrame([(i, "one two three four " * 6000) for i in range(4)], "doc_id long, text string")
    for r in gru_lm.score_documents(docs, F.lit(True), updates=100).collect():
        assert r["score"] > 0.5 * r["base_score"]


def test_streams_read_whole_texts():
    v = _vocabulary()
    cls_of = np.append(v.short_class, v.n_short + np.arange(3))
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, 12, n) for n in (1, 3, 500, 7, 20, 21, 64, 2)]
    for streams in (1, 3, 50):
        net = gru_lm.Network(v)
        assert net.train(iter(docs), cls_of, streams=streams, steps=5) == sum(map(len, docs))
        assert all(np.isfinite(x).all() for x in net.p.values())
    assert gru_lm.Network(v).train([], cls_of) == 0


def test_streams_read_texts_in_the_order_dealt():
    """Windows of a pool that is packed anew equal streams that hold their texts one by one; a text's first token is marked."""
    rng = np.random.default_rng(6)
    docs = [rng.integers(0, 2000, n) for n in [*rng.integers(1, 90, 3000).tolist(), 0, 200_000, 40_000]]
    reader, queue = gru_lm._Streams(docs, 16), iter(docs)
    held = [np.zeros(0, np.int64) for _ in range(16)]
    while True:
        ids, size = reader.window(20)
        for i in range(16):
            while len(held[i]) < 20 and (doc := next(queue, None)) is not None:
                held[i] = np.concatenate([held[i], ~doc[:1], doc[1:]])
            n = min(20, len(held[i]))
            assert size[i] == n and ids[:n, i].tolist() == held[i][:n].tolist() and not ids[n:, i].any()
            held[i] = held[i][n:]
        if not size.any():
            break
    assert not reader.more and len(reader.pool) < 200_000 + 300_000


def test_sums_by_id():
    rng = np.random.default_rng(7)
    for ids in (rng.zipf(1.3, 5000) % 700, np.zeros(200, np.int64), np.arange(40), np.array([3])):
        rows = rng.normal(0, 1, (len(ids), 6))
        order, runs, levels, read = gru_lm._by_place(ids)
        got, want = np.zeros((2, 700, 6))
        got[read] = gru_lm._sums(rows[order], runs, levels, len(read))
        np.add.at(want, ids, rows)
        assert sorted(order.tolist()) == list(range(len(ids))) and np.allclose(got, want, atol=1e-12)


def test_logits_made_in_parts_are_the_same(monkeypatch):
    """Log-probabilities and gradients of many states, whole and in parts, against plain numpy."""
    v = _vocabulary()
    net = gru_lm.Network(v)
    net.p = {k: x.astype(np.float64) for k, x in net.p.items()}
    cls_of = np.append(v.short_class, v.n_short + np.arange(3))
    rng = np.random.default_rng(8)
    ids = rng.integers(0, 15, 400)
    cls, h = cls_of[ids], rng.uniform(-1, 1, (400, gru_lm.STATE))
    want, flow = np.zeros(400), {k: np.zeros_like(x) for k, x in net.p.items()}
    for j, (i, c) in enumerate(zip(ids, cls)):
        heads = [(net.p["cls"].T, net.p["cls_b"], int(c), "cls", slice(None))]
        if i < v.short:
            a, b = int(v.first[c]), int(v.first[c + 1])
            heads.append((net.p["out"][a:b], net.p["out_b"][a:b], int(i) - a, "out", slice(a, b)))
        for w, bias, k, name, at in heads:
            z = w @ h[j] + bias
            p = np.exp(z) / np.exp(z).sum()
            want[j] += math.log(p[k])
            p[k] -= 1
            flow[name][at if name == "out" else (slice(None), at)] += np.outer(p, h[j]) if name == "out" else np.outer(h[j], p)
            flow[name + "_b"][at] += p
    for rows, cells in ((gru_lm.HEAD_ROWS, gru_lm.HEAD_CELLS), (7, 10)):
        monkeypatch.setattr(gru_lm, "HEAD_ROWS", rows)
        monkeypatch.setattr(gru_lm, "HEAD_CELLS", cells)
        assert np.allclose(net.log_probs(h, ids, cls)[0], want, atol=1e-10)
        grads = {k: np.zeros_like(x) for k, x in net.p.items()}
        net.log_probs(h, ids, cls, grads)
        assert all(np.allclose(grads[k], flow[k], atol=1e-9) for k in ("cls", "cls_b", "out", "out_b"))


def test_suffix_keys_are_of_the_last_two_characters():
    words = ["a", "ab", "xab", "é", "aé", "xaé", "日本", "語日本", "🙂🙂", "x🙂🙂", "🙂a", "b"]
    spans = gru_lm._joined([w.encode() for w in words])
    keys = gru_lm._suffix_keys(*spans).tolist()
    assert all((a[-2:] == b[-2:]) == (j == k) for a, j in zip(words, keys) for b, k in zip(words, keys))
    some = ["ab", "日本", "b", "🙂🙂"]
    assert gru_lm._Suffixes(some).find(*spans).tolist() == [some.index(w[-2:]) if w[-2:] in some else 4 for w in words]
    assert gru_lm._Suffixes([]).find(*spans).tolist() == [0] * len(words)


def test_words_of_a_reply_are_read_from_its_bytes():
    """Also from several chunks; the replacement character comes last, whether words came or not."""
    for chunks in ([["ab", "é"], [], ["日本語"]], [[]]):
        data, ends = gru_lm._text_bytes(pa.chunked_array([pa.array(c, pa.string()) for c in chunks]))
        words = [*sum(chunks, []), "\ufffd"]
        assert [data[a:b].tobytes().decode() for a, b in zip([0, *ends.tolist()], ends.tolist())] == words
    assert gru_lm._strings([b"a", "é".encode()]).to_pylist() == ["a", "é"] and gru_lm._strings([b"a", b"\xff"]).to_pylist() == ["a", "\ufffd"]


@pytest.mark.parametrize("n", [1, 2, 3, 2047, 2048, 2049, 10_000])
def test_cut_is_the_binary_form(n):
    sizes = packing.cut(n, 2048)
    assert sum(sizes) == n and all(s & (s - 1) == 0 and s <= 2048 for s in sizes) and sizes == sorted(sizes, reverse=True)


def check_pieces(rows, texts):
    tok = Tokenizer.from_file(TOKENIZER)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert set(by) == set(texts)
    for d, t in texts.items():
        want = tok.encode(t or "", add_special_tokens=False).ids + [1]
        mine = sorted(by[d], key=lambda r: r["start"])
        got = [i for r in mine for i in r["ids"]]
        assert got == want and [r["start"] for r in mine] == list(np.cumsum([0] + [r["length"] for r in mine])[:-1])
        for r in mine:
            part = np.array(want[r["start"]: r["start"] + r["length"]], "<u4")
            assert r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["doc_tokens"] == len(want)
            assert r["length"] == 1 << r["bucket"] and r["offset"] == 0
    ids = [r["sequence_id"] for r in rows]
    assert len(set(ids)) == len(ids)


def test_packing_round_trip(small_docs, small_texts):
    check_pieces(packing.power_of_two_pieces(small_docs, TOKENIZER, with_ids=True).collect(), small_texts)


def test_packing_word_cache_is_exact(spark):
    texts = ["Don't stop; it's 3.14<|endoftext|>x <|startoftext|>", "été ÉTÉ   İstanbul ΣΑΣ", "\x1c\x85 tab\there\x0bthere", "", None, "🙂🙂 ́ a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check_pieces(packing.power_of_two_pieces(docs, TOKENIZER, with_ids=True).collect(), dict(enumerate(texts)))


def test_packing_edges(spark, edge_docs, tmp_path):
    out = packing.power_of_two_pieces(edge_docs, TOKENIZER)
    assert out.where("doc_id = 3").count() == 1 and out.where("doc_id = 2 and start = 0").count() == 2
    assert packing.power_of_two_pieces(edge_docs.limit(0), TOKENIZER).count() == 0
    packing.write_buckets(out, str(tmp_path / "buckets"))
    assert spark.read.parquet(str(tmp_path / "buckets")).count() == out.count()
    with pytest.raises(ValueError):
        packing.power_of_two_pieces(edge_docs, TOKENIZER, seq_len=1000)


def test_word_encoder_with_a_full_cache():
    small, large = packing.WordEncoder(TOKENIZER, cache_words=2), packing.WordEncoder(TOKENIZER)
    texts = [b"one two three", b"two four <|endoftext|>", b"", b"five one"]
    assert small(texts[:1]) + small(texts[1:]) == large(texts)
