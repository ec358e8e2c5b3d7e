"""Personal data, and the terms that give it away.

Mail and IP addresses, card and phone numbers are found by their form.  Each
value is a protected entity.  How strongly a term reveals an entity is estimated
from the corpus: with n documents, a term in n_t of them, an entity in n_c and
the two within a few words of each other in n_ct, the term discloses

    PMI(c; t) / IC(c) = log(n * n_ct / (n_c * n_t)) / log(n / n_c)

of the entity's information; 1 says that the term stands in no other document.
A term near an entity that discloses too much is removed from the whole document,
or generalised to its first characters if those, counted over the corpus in the
same way, disclose less than the threshold.  Terms and texts are told apart by
fingerprints of 64 and 128 bits.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.blocks import possible, row_struct
from shelfwise.llm.text import LOWER, loose, mix, signed, slices, unsigned, word_hashes, word_spans
from shelfwise.session import ensure_checkpoint_dir

#: The forms, in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")
#: What the method adds, listed after them.
ADDED = ("generalise", "remove")

#: The four forms, written so that a failing place is left at once.
#: email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ from its sign on; the part before it is read backwards.
MAIL_END = re.compile(rb"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
MAIL_NAME = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(rb"[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")

#: Documents that must hold entity and term side by side before the estimate counts.
LEAST_DOCS = 3
#: Share of an entity's information from which a term gives too much away.
THRESHOLD = 0.9
#: Words on each side of an entity that are taken as its context.
CONTEXT = 8
#: Characters that a generalised term keeps.
STEM = 3
#: Bits of the filters of terms and texts (1 MB, whatever their number).
FILTER_BITS = 23
#: Terms whose counts a task holds before it sends them on.
HELD_KEYS = 500_000
#: Context rows that leave a task together.
CTX_ROWS = 20_000

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
STEM_SALT = np.uint64(0x51ED270B0B1F39C5)


def luhn(digits: bytes) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = (d - 48) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _mails(buf: bytes) -> Iterator[tuple[int, int]]:
    done = 0
    for m in MAIL_END.finditer(buf):
        at = m.start()
        while at > done and buf[at - 1] in MAIL_NAME:
            at -= 1
        if at < m.start():
            done = m.end()
            yield at, done


def _ips(buf: bytes, runs: list[int]) -> Iterator[tuple[int, int]]:
    done = 0
    for at in runs:  # a match starts with a run of digits and ends with one
        if at >= done and (m := IP.match(buf, at)):
            done = m.end()
            if all(len(p := x.lstrip(b"0")) <= 3 and int(p or b"0") <= 255 for x in m.group().split(b".")):
                yield at, done


def _cards(buf: bytes, runs: list[int]) -> Iterator[tuple[int, int]]:
    done = 0
    for at in runs:
        if at >= done and (m := CARD.match(buf, at)):
            done = m.end()
            digits = m.group().translate(None, b" -")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield at, done


def _phones(buf: bytes) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(buf):
        if 9 <= sum(48 <= b < 58 for b in m.group()) <= 15:
            yield m.span()


def base_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kind, start and end (bytes) of the personal data in a run of rows, ordered by kind and start; no span crosses rows."""
    rows, size = len(offs) - 1, np.diff(offs)
    # a line break, which no form holds, goes between the rows
    joined = np.full(len(data) + rows, 10, np.uint8)
    shift = np.repeat(np.arange(rows), size)
    joined[np.arange(len(data)) + shift] = data
    buf = joined.tobytes()
    digit = DIGIT[joined]
    begin = digit.copy()
    begin[1:] &= ~digit[:-1]
    begin = np.flatnonzero(begin)
    after = np.minimum(begin[:, None] + np.arange(1, 4), len(joined) - 1) if len(begin) else np.zeros((0, 3), np.int64)
    next_byte = joined[after]
    # a run of up to three digits shows at once whether a dot, a separator or a fourth digit follows
    dot, mark = (next_byte == 46).any(1) | DIGIT[next_byte].all(1), (DIGIT[next_byte] | (next_byte == 32) | (next_byte == 45)).any(1)
    found_ = [list(f) for f in (_mails(buf), _ips(buf, begin[dot].tolist()), _cards(buf, begin[mark].tolist()), _phones(buf))]
    kind = np.repeat(np.arange(len(KINDS)), [len(f) for f in found_])
    span = np.array([s for f in found_ for s in f], np.int64).reshape(-1, 2)
    row = np.searchsorted(offs[1:] + np.arange(rows), span[:, 0], "right")  # row r ends before its line break
    return kind, span[:, 0] - row, span[:, 1] - row


def entity_hash(kind: int, value: bytes) -> int:
    """Signed 64-bit fingerprint of a value; mail addresses in lower case, cards and phones by their digits."""
    value = value.lower() if kind == 0 else value if kind == 1 else re.sub(rb"[^0-9]", b"", value)
    return int.from_bytes(hashlib.blake2b(b"%d:" % kind + value, digest_size=8).digest(), "little", signed=True)


class Words:
    """The words (letters and characters beyond ASCII) of a run of rows, their fingerprints and those of their stems."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, inside: np.ndarray):
        self.data = LOWER[data]
        self.starts, self.ends, self.first = word_spans(data, offs, inside)
        self.lead = (data & 0xC0) != 0x80
        self.chars = np.append(0, np.cumsum(self.lead))  # characters before a byte
        self.at = np.flatnonzero(self.lead)

    def hashes(self, which) -> np.ndarray:
        return word_hashes(self.data, self.starts[which], self.ends[which])

    def stems(self, which) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints of the first STEM characters, and which words are longer than that."""
        nth = self.chars[self.starts[which]] + STEM
        end = np.where(nth < len(self.at), self.at[np.minimum(nth, len(self.at) - 1)] if len(self.at) else 0, len(self.data))
        longer = end < self.ends[which]
        return mix(word_hashes(self.data, self.starts[which], np.minimum(end, self.ends[which])) ^ STEM_SALT), longer


DOC = "id long, k1 long, k2 long, row {row}, n_email long, n_ip long, n_card long, n_phone long, base string, {text}ent array<long>, term array<long>, stem array<long>, once array<boolean>, at array<long>, upto array<long>"


def _contexts(words: Words, offs: np.ndarray, start: np.ndarray, end: np.ndarray, entity: np.ndarray):
    """Row, entity, term, stem, first of its kind in the row, start and end (characters) of the words near the entities."""
    row = np.searchsorted(offs[1:], start, "right")
    before, after = np.searchsorted(words.starts, start), np.searchsorted(words.starts, end)
    w = np.concatenate([before[:, None] - 1 - np.arange(CONTEXT), after[:, None] + np.arange(CONTEXT)], 1)
    good = (w >= words.first[row][:, None]) & (w < words.first[row + 1][:, None])
    which, place = w[good], np.repeat(np.arange(len(start)), good.sum(1))
    first = np.unique(np.stack([entity[place].view(np.uint64), which.astype(np.uint64)], 1), axis=0, return_index=True)[1]
    which, place = which[first], place[first]
    term = words.hashes(which)
    stem, longer = words.stems(which)
    r, e = row[place], entity[place]
    once = np.zeros(len(which), bool)
    once[np.unique(np.stack([r.astype(np.uint64), e.view(np.uint64), term], 1), axis=0, return_index=True)[1]] = True
    at = words.chars[words.starts[which]] - words.chars[offs[:-1]][r]
    upto = words.chars[words.ends[which]] - words.chars[offs[:-1]][r]
    return r, e, term, stem, longer, once, at, upto


def _scan(with_text: bool):
    """A row for every document with its base spans, and rows of its entities and the words near them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            kind_of_row = batch.schema.field(3).type
            for i, j, data, offs in slices(batch.column(0)):
                kind, start, end = base_spans(data, offs)
                row = np.searchsorted(offs[1:], start, "right")
                inside = LETTER[data]
                for a, b in zip(start.tolist(), end.tolist()):
                    inside[a:b] = False
                words = Words(data, offs, inside)
                chars = words.chars
                zero = chars[offs[:-1]]
                order = np.lexsort((start, kind, row))
                kind, start, end, row = kind[order], start[order], end[order], row[order]
                ids = np.arange(number, number + j - i)
                number += j - i
                count = np.zeros((j - i, len(KINDS)), np.int64)
                np.add.at(count, (row, kind), 1)
                listed = [f"{KINDS[k]}:{a}:{b}" for k, a, b in zip(kind.tolist(), (chars[start] - zero[row]).tolist(), (chars[end] - zero[row]).tolist())]
                cut = np.searchsorted(row, np.arange(j - i + 1)).tolist()
                base = [",".join(listed[a:b]) for a, b in zip(cut[:-1], cut[1:])]
                none = [pa.nulls(j - i, t) for t in CTX_KINDS]
                mine = batch.slice(i, j - i)
                text = [mine.column(0)] if with_text else []
                yield pa.RecordBatch.from_arrays([pa.array(ids), mine.column(1), mine.column(2), loose(mine.column(3)), *[pa.array(count[:, k]) for k in range(len(KINDS))], pa.array(base, pa.string()), *text, *none],
                                                 names=_names(with_text))
                if not len(kind):
                    continue
                raw = data.tobytes()
                entity = np.array([entity_hash(k, raw[a:b]) for k, a, b in zip(kind.tolist(), start.tolist(), end.tolist())], np.int64)
                r, e, term, stem, longer, once, at, upto = _contexts(words, offs, start, end, entity)
                # a row without a term for each entity of a document
                own = np.unique(np.stack([row.astype(np.uint64), entity.view(np.uint64)], 1), axis=0)
                r = np.append(r, own[:, 0].astype(np.int64))
                e = np.append(e, own[:, 1].view(np.int64))
                n, k = len(term), len(own)
                term = pa.array(np.append(term.view(np.int64), np.zeros(k, np.int64)), mask=np.arange(n + k) >= n)
                stem = pa.array(np.append(stem.view(np.int64), np.zeros(k, np.int64)), mask=np.append(~longer, np.ones(k, bool)))
                cols = [pa.array(e), term, stem, pa.array(np.append(once, np.ones(k, bool))), pa.array(np.append(at, np.full(k, -1))), pa.array(np.append(upto, np.full(k, -1)))]
                by_row = np.argsort(r, kind="stable")
                cols, r = [c.take(pa.array(by_row)) for c in cols], r[by_row]
                edges = np.unique(np.concatenate([np.flatnonzero(np.append(True, r[1:] != r[:-1])), np.arange(0, len(r), CTX_ROWS), [len(r)]]))
                lists = [pa.ListArray.from_arrays(pa.array(edges, pa.int32()), c) for c in cols]
                m = len(edges) - 1
                blank = [pa.nulls(m, kind_of_row), *[pa.nulls(m, pa.int64()) for _ in KINDS], pa.nulls(m, pa.string()), *[pa.nulls(m, pa.string()) for _ in text]]
                of = pa.array(r[edges[:-1]])
                yield pa.RecordBatch.from_arrays([pa.array(ids).take(of), mine.column(1).take(of), mine.column(2).take(of), *[loose(b) for b in blank], *lists], names=_names(with_text))
    return run


CTX_KINDS = (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.list_(pa.int64()))


def _names(with_text: bool) -> list[str]:
    return ["id", "k1", "k2", "row", *[f"n_{k}" for k in KINDS], "base", *["txt"] * with_text, "ent", "term", "stem", "once", "at", "upto"]


class Filter:
    """A bitmap of fixed size of 64-bit keys; what it lets pass is joined with the keys themselves."""

    def __init__(self, keys: DataFrame):
        bit = keys.select(F.pmod("key", F.lit(1 << FILTER_BITS)).alias("b"))
        words = bit.groupBy((F.col("b") / 64).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("v"))
        self.bits = np.zeros((1 << FILTER_BITS) // 64, np.uint64)
        for r in words.collect():  # at most 2^17 rows
            self.bits[r["w"]] = np.uint64(r["v"] & (2**64 - 1))

    def __call__(self, h: np.ndarray) -> np.ndarray:
        at = h & np.uint64((1 << FILTER_BITS) - 1)
        return (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def document_counts(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """``key, n_t``: the documents that hold each of the ``keys``, fingerprints of terms or stems."""
    sent = texts.sparkSession.sparkContext.broadcast(Filter(keys))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value
        key, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for i, j, data, offs in slices(batch.column(0)):
                words = Words(data, offs, LETTER[data])
                every = slice(None)
                row = np.repeat(np.arange(j - i), np.diff(words.first))
                h = words.hashes(every)
                stem, longer = words.stems(every)
                got = [(x[ok], row[ok]) for x, ok in ((h, wanted(h)), (stem, longer & wanted(stem)))]
                h, row = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
                order = np.lexsort((row, h))
                h, row = h[order], row[order]
                new = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])) if len(h) else np.zeros(0, bool)
                new, many = np.unique(h[new], return_counts=True)
                both, n = np.append(key, new), np.append(n, many)
                key, at = np.unique(both, return_inverse=True)
                n = np.bincount(at, n, len(key)).astype(np.int64)  # exact up to 2^53
                if len(key) > HELD_KEYS:
                    yield pa.RecordBatch.from_arrays([signed(key), pa.array(n)], names=["key", "n"])
                    key, n = key[:0], n[:0]
        yield pa.RecordBatch.from_arrays([signed(key), pa.array(n)], names=["key", "n"])

    got = texts.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n_t"))
    return got.join(keys, "key", "left_semi")


def occurrences(texts: DataFrame, hits: DataFrame) -> DataFrame:
    """``k1, k2, term, at, upto``: where the terms of ``hits`` (k1, k2, term) stand in their texts, outside the forms; equal texts answer for each other."""
    spark = texts.sparkSession
    sent = spark.sparkContext.broadcast((Filter(hits.select(F.col("k1").alias("key"))), Filter(hits.select(F.col("k1").bitwiseXOR(F.col("term")).alias("key")))))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, pair = sent.value
        for batch in batches:
            batch = batch.filter(pa.array(text(unsigned(batch.column(1)))))
            for i, j, data, offs in slices(batch.column(0)):
                _, start, end = base_spans(data, offs)
                inside = LETTER[data]
                for a, b in zip(start.tolist(), end.tolist()):
                    inside[a:b] = False
                words = Words(data, offs, inside)
                row = np.repeat(np.arange(i, j), np.diff(words.first))
                h = words.hashes(slice(None))
                ok = np.flatnonzero(pair(h ^ unsigned(batch.column(1))[row]))
                zero = words.chars[offs[:-1]][row[ok] - i]
                of = pa.array(row[ok])
                yield pa.RecordBatch.from_arrays([batch.column(1).take(of), batch.column(2).take(of), signed(h[ok]), pa.array(words.chars[words.starts[ok]] - zero), pa.array(words.chars[words.ends[ok]] - zero)],
                                                 names=["k1", "k2", "term", "at", "upto"])

    return texts.mapInArrow(places, "k1 long, k2 long, term long, at long, upto long").distinct()


def disclosure(n: Column, n_c: Column, n_t: Column, n_ct: Column) -> Column:
    """PMI / IC; null for an entity that every document holds."""
    return F.log(n * n_ct / (n_c * n_t)) / F.when(n_c < n, F.log(n / n_c))


def revealing_terms(context: DataFrame, texts: DataFrame, n_docs: int, threshold: float, least_docs: int) -> DataFrame:
    """``ent, term, kind``: terms that disclose too much of an entity, and whether their stem may stay."""
    n = F.lit(float(n_docs))

    def tells(n_t: str, n_ct: str) -> Column:
        return F.coalesce(disclosure(n, F.col("n_c"), F.col(n_t), F.col(n_ct)) >= threshold, F.lit(False))

    def near(name: str) -> DataFrame:
        """Documents that hold a term near any entity: no more than hold it at all, so what discloses too little by this count does so by the whole one."""
        return context.where(F.col(name).isNotNull()).select(name, "id").distinct().groupBy(name).agg(F.count(F.lit(1)).alias(f"near_{name}"))

    once = context.where("once")
    entities = once.where("term is null").groupBy("ent").agg(F.count(F.lit(1)).alias("n_c")).where(F.col("n_c") >= least_docs)
    pairs = once.where("term is not null").groupBy("ent", "term").agg(F.count(F.lit(1)).alias("n_ct"), F.first("stem", ignorenulls=True).alias("stem"))
    pairs = pairs.where(F.col("n_ct") >= least_docs).join(entities, "ent").join(near("term"), "term").where(tells("near_term", "n_ct")).checkpoint()
    # a stem's documents near an entity: those of all words with the stem, each document once
    met = context.where("stem is not null").join(pairs.select("ent", "stem").distinct(), ["ent", "stem"], "left_semi")
    stems = met.select("ent", "stem", "id").distinct().groupBy("ent", "stem").agg(F.count(F.lit(1)).alias("n_cs"))
    pairs = pairs.join(stems, ["ent", "stem"], "left").join(near("stem"), "stem", "left").withColumn("may", F.col("stem").isNotNull() & tells("near_stem", "n_cs")).checkpoint()
    keys = pairs.select(F.col("term").alias("key")).unionByName(pairs.where("may").select(F.col("stem").alias("key"))).distinct()
    df = document_counts(texts, keys).checkpoint()
    out = pairs.join(df.withColumnRenamed("key", "term"), "term").where(tells("n_t", "n_ct")).drop("n_t")
    out = out.join(df.withColumnRenamed("key", "stem"), "stem", "left")
    gone = F.col("stem").isNull() | (F.col("may") & tells("n_t", "n_cs"))
    return out.select("ent", "term", F.when(gone, F.lit(ADDED[1])).otherwise(F.lit(ADDED[0])).alias("kind"))


def find(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, threshold: float = THRESHOLD, least_docs: int = LEAST_DOCS, with_text: bool = False) -> DataFrame:
    """The carried columns of every row (all but the text, if None), then ``n_email, n_ip, n_card, n_phone, n_generalise,
    n_remove long, base_spans, spans string`` and, with ``with_text``, ``text string`` and ``sanitised string``.

    Spans are ``kind:start:end`` in characters, the end exclusive, comma-joined by kind and start; ``base_spans`` has
    the four forms alone.  Forms may overlap each other; words in them are never terms.  Added spans are all occurrences of
    a word that stands within CONTEXT words of an entity of the same document and reveals it; nothing else is marked.
    A null or empty text has no spans; repeated rows are documents of their own; an empty table gives no rows; carried
    columns named like a result give way to it.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    results = (*[f"n_{k}" for k in KINDS + ADDED], "base_spans", "spans", "sanitised", *["text"] * with_text)
    txt = F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit(""))
    keyed = [txt.alias("txt"), F.xxhash64(txt).alias("k1"), F.xxhash64(txt, F.lit(1)).alias("k2")]
    base = docs.select(*keyed, row_struct(docs, text_col, carry, results).alias("row"))
    kind = base.schema["row"].dataType.simpleString()
    seen = base.mapInArrow(_scan(with_text), DOC.format(row=kind, text="txt string, " if with_text else "")).checkpoint()
    zipped = F.explode(F.arrays_zip("ent", "term", "stem", "once", "at", "upto")).alias("x")
    context = seen.where("ent is not null").select("id", "k1", "k2", zipped).select("id", "k1", "k2", "x.*")
    whole = seen.where("ent is null").drop("ent", "term", "stem", "once", "at", "upto")
    flagged = revealing_terms(context, docs.select(txt.alias("txt")), whole.count(), threshold, least_docs).checkpoint()
    near = possible(context.where("term is not null").select("k1", "k2", "ent", "term"), F.xxhash64("ent", "term"), flagged, F.xxhash64("ent", "term"))
    hits = near.where("possible").join(flagged, ["ent", "term"]).groupBy("k1", "k2", "term").agg(F.max("kind").alias("kind")).checkpoint()  # removing wins
    added = occurrences(docs.select(*keyed), hits).join(hits, ["k1", "k2", "term"]).groupBy("k1", "k2").agg(
        F.array_sort(F.collect_list(F.struct("kind", "at", "upto"))).alias("added"), *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ADDED])
    out = whole.join(added, ["k1", "k2"], "left")
    more = F.transform("added", lambda x: F.concat_ws(":", x["kind"], x["at"].cast("string"), x["upto"].cast("string")))
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.array_join(more, ","))
    cols = ["row.*", *[f"n_{k}" for k in KINDS], *[F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k in ADDED], F.col("base").alias("base_spans"), spans.alias("spans")]
    if not with_text:
        return out.select(*cols)
    out = out.select(*cols, F.col("txt").alias("text"))
    return out.mapInArrow(_replace, f"{_ddl(out)}, sanitised string")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def sanitise(text: str, spans: str) -> str:
    """The text with a mark for every span: forms and removed terms by name, generalised terms by their first characters."""
    cuts = sorted((int(a), -int(b), kind) for kind, a, b in (s.split(":") for s in spans.split(",") if s))
    out, done = [], 0
    for a, b, kind in cuts:
        a, b = max(a, done), -b
        if a < b:
            out += [text[done:a], text[a: a + STEM] + "*" if kind == ADDED[0] else f"[{kind.upper()}]"]
            done = b
    return "".join(out) + text[done:]


def _replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, spans = batch.column("text").to_pylist(), batch.column("spans").to_pylist()
        clean = pa.array([sanitise(t, s) if s else t for t, s in zip(texts, spans)], pa.string())
        yield pa.RecordBatch.from_arrays([*[loose(c) for c in batch.columns], clean], names=[*batch.schema.names, "sanitised"])
