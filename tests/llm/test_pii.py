"""Personal data against the plain forms, the method against plain counts, and odd rows."""

import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from shelfwise.llm import pii, registry
from shelfwise.llm.pii import ADDED, CONTEXT, KINDS, STEM, find, sanitise

FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
SMALL = "/root/testdata/sf0.001"


def plain_luhn(digits):
    twice = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in twice) % 10 == 0


def plain_base(text):
    out = []
    for kind in KINDS:
        for m in re.finditer(FORMS[kind], text):
            digits = re.sub(r"[^0-9]", "", m.group())
            if kind == "ip" and max(map(int, m.group().split("."))) > 255:
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and plain_luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def plain_spans(texts, threshold=pii.THRESHOLD, least=pii.LEAST_DOCS):
    """All spans of each text, by counting over all texts."""
    n = len(texts)
    words, near, docs = [], [], defaultdict(set)
    n_c, n_ct, n_cs = defaultdict(set), defaultdict(set), defaultdict(set)
    for i, text in enumerate(texts):
        base = plain_base(text)
        for w in re.findall(r"[A-Za-z\x80-\U0010ffff]+", text):
            w = low(w)
            docs[w].add(i)
            if len(w) > STEM:
                docs["stem", w[:STEM]].add(i)
        bare = list(text)
        for _, a, b in base:
            bare[a:b] = " " * (b - a)
        words.append([(m.start(), m.end(), low(m.group())) for m in re.finditer(r"[A-Za-z\x80-\U0010ffff]+", "".join(bare))])
        mine = []
        for kind, a, b in base:
            value = text[a:b]
            c = (kind, low(value) if kind == "email" else value if kind == "ip" else re.sub("[^0-9]", "", value))
            n_c[c].add(i)
            before, after = [w for w in words[i] if w[0] < a][-CONTEXT:], [w for w in words[i] if w[0] >= b][:CONTEXT]
            for w in before + after:
                mine.append((c, w))
                n_ct[c, w[2]].add(i)
                if len(w[2]) > STEM:
                    n_cs[c, w[2][:STEM]].add(i)
        near.append(mine)

    def tells(c, n_t, together):
        return len(n_c[c]) < n and math.log(n * len(together) / (len(n_c[c]) * len(n_t))) / math.log(n / len(n_c[c])) >= threshold

    out = []
    for i, text in enumerate(texts):
        found = {}
        for c, (_, _, w) in near[i]:
            if len(n_c[c]) >= least and len(n_ct[c, w]) >= least and tells(c, docs[w], n_ct[c, w]):
                stays = len(w) > STEM and not tells(c, docs["stem", w[:STEM]], n_cs[c, w[:STEM]])
                found[w] = max(found.get(w, ""), ADDED[0] if stays else ADDED[1])
        out.append(plain_base(text) + sorted((found[w], a, b) for a, b, w in words[i] if w in found))
    return out


def low(w):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)


@pytest.mark.parametrize("alphabet", ["a1.@-+ ", "0123456789 .-", "+12 ().-\n", "aé@.b1☃-", "@.ab"])
def test_forms_of_random_texts(alphabet):
    rnd = random.Random(alphabet)
    texts = ["".join(rnd.choices(alphabet, k=rnd.randint(0, 60))) for _ in range(4000)]
    texts += ["4111 1111-1111 1111", "x4111111111111111@a.b", "1.2.3.4.5.6.7.8", "999.1.1.1.1", "a.b@c@d.e@f.g", "+1 (499) 555-6503", "0000255.1.1.1"]
    raw = [t.encode() for t in texts]
    data, offs = np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw]))
    kind, start, end = pii.base_spans(data, offs)
    got = defaultdict(list)
    for k, a, b in zip(kind.tolist(), start.tolist(), end.tolist()):
        row = int(np.searchsorted(offs, a, "right")) - 1
        at = [len(raw[row][: x - offs[row]].decode()) for x in (a, b)]
        got[row].append((KINDS[k], *at))
    for i, t in enumerate(texts):
        assert got.get(i, []) == plain_base(t), t


def test_long_runs_take_linear_time():
    for t in ("1" * 300_000, "a" * 300_000 + "@", "1 " * 200_000, "+1" + "2" * 300_000, "1." * 150_000, "a@" * 100_000):
        raw = np.frombuffer(t.encode(), np.uint8)
        pii.base_spans(raw, np.array([0, len(raw)]))


def corpus():
    rnd = random.Random(4)
    common = ["alpha", "beta", "gamma", "delta", "of", "the", "né", "Strasse"]
    filler = lambda k: " ".join(rnd.choices(common, k=k))
    texts = [filler(rnd.randint(0, 40)) for _ in range(120)]
    for i in range(9):  # zanzibar stands near one address only; zanzig shares its stem with many words
        texts.append(f"{filler(5)} Zanzibar mail.{'A' if i % 2 else 'a'}@x.org, quixote né {filler(20)} zanzibar far away")
    texts += [f"quilt quick {filler(9)}" for _ in range(30)]
    texts += [f"{filler(3)} +1 (499) 555-6503 xy {filler(3)}" for _ in range(5)]
    texts += ["card 4111 1111 1111 1111 rare only once", "", "ip 10.0.0.1 and 10.0.0.1 Ümlaut", "10.0.0.1 ümlaut Ümlaut", "10.0.0.1 Ümlaut"] + ["vast " * 3000 + "10.0.0.1"]
    return texts


def test_method_against_plain_counts(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    kinds = set()
    for threshold, least in ((pii.THRESHOLD, 3), (0.5, 2)):
        want = plain_spans(texts, threshold, least)
        got = {r["doc_id"]: r for r in find(docs, threshold=threshold, least_docs=least, with_text=True).collect()}
        assert len(got) == len(texts)
        for i, t in enumerate(texts):
            assert got[i]["spans"] == joined(want[i]), t
            assert got[i]["base_spans"] == joined(plain_base(t))
            assert [got[i][f"n_{k}"] for k in KINDS + ADDED] == [sum(s[0] == k for s in want[i]) for k in KINDS + ADDED]
            assert got[i]["sanitised"] == sanitise(t, got[i]["spans"]) and got[i]["text"] == t
        kinds |= {s[0] for w in want for s in w}
    assert kinds >= {"generalise", "remove", "email", "phone"}
    assert sanitise(texts[120], got[120]["spans"]).lower().count("zanzibar") == 0


def test_marks_of_overlapping_spans():
    assert sanitise("call +1 555 123 4567 Zanzibar é", "phone:5:20,generalise:21:29,remove:30:31") == "call [PHONE] Zan* [REMOVE]"
    assert sanitise("abcdef", "email:0:4,card:2:6") == "[EMAIL][CARD]"
    assert sanitise("ab", "") == "ab"


def test_edges(spark, edge_docs):
    out = find(edge_docs)
    assert out.columns == [c for c in edge_docs.columns if c != "text"] + [f"n_{k}" for k in KINDS + ADDED] + ["base_spans", "spans"]
    assert out.count() == edge_docs.count() and {r["spans"] for r in out.collect()} == {""}
    empty = spark.createDataFrame([], edge_docs.schema)
    assert find(empty).count() == 0
    clash = spark.createDataFrame([(1, "a@b.cd x", 5, "s", 2.0), (1, "a@b.cd x", 5, "s", 2.0), (None, None, None, None, None)], "id long, text string, n_email int, spans string, ent double")
    rows = find(clash, with_text=True).collect()
    assert sorted((r["id"] or 0, r["n_email"], r["spans"], r["text"]) for r in rows) == [(0, 0, "", ""), (1, 1, "email:0:6", "a@b.cd x"), (1, 1, "email:0:6", "a@b.cd x")]


def test_query_on_the_small_table(spark, small_texts):
    ids = sorted(small_texts)
    want = dict(zip(ids, plain_spans([small_texts[i] or "" for i in ids])))
    rows = registry.op13_pii(spark, SMALL).collect()
    assert len(rows) == len(ids)
    for r in rows:
        base = plain_base(small_texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(joined(base).encode()).hexdigest()
        assert r["spans"] == joined(want[r["doc_id"]])
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in base) for k in KINDS]
