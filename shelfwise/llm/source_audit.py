"""Divergence of the sources of each language, from an index built by single-pass in-memory indexing.

1. Every task reads its documents once and keeps block postings in memory:
   (term, source) with its occurrences and documents.  When the block is full it
   is spilled as a run sorted by term, cut into hash shards of the terms.
2. The runs of a shard are heap-merged into frequencies.  Many runs are merged in
   several levels of FAN, so a term that every run holds is summed on the way and
   no task sees more than FAN postings of a source.
3. The divergence of two sources is the sum over all kept terms.  Where neither
   source has a term it is one constant; where one has it, a value per count.  So
   the constant is taken for every term, corrected by each source's histogram of
   counts, and once more for the pairs of sources in the postings of a term.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.blocks import text_bytes
from shelfwise.llm.text import slices, word_hashes
from shelfwise.session import ensure_checkpoint_dir

#: Postings that a task holds before it spills them as a run.
BLOCK_POSTINGS = 500_000
#: Bytes of text for each hash shard of the terms.
SHARD_BYTES = 8 << 20
#: Tasks whose runs one merge takes.
FAN = 64
#: Postings of one step of the pair corrections, sources on a side of it, and pairs computed together.
STEP_POSTINGS, TILE, PAIRS = 400_000, 1000, 400_000
#: Bytes of a long text that are split at once.
PIECE = 4 << 20
SCALE = 1_000_000_000

#: Lower-cases A-Z; bytes that belong to no term become spaces.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

RUN = "shard int, part int, n long, terms binary, langs array<string>, sources array<string>, grp binary, cnt binary, docs binary"


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in pieces of bounded size."""
    text, at = text.translate(TERM_BYTES), 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        if end < len(text):
            end = text.find(b" ", end)
            end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _pack(x: np.ndarray) -> bytes:
    most = int(x.max(initial=0))
    return x.astype(next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(k).max)).tobytes()


def _unpack(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}")


class Block:
    """Postings of the documents read so far."""

    def __init__(self):
        self.count: dict[tuple[str, str], Counter[bytes]] = {}
        self.docs: dict[tuple[str, str], Counter[bytes]] = {}
        self.size = 0

    def add(self, key: tuple[str, str], text: bytes) -> None:
        c = self.count.setdefault(key, Counter())
        before, seen = len(c), set()
        for ws in terms_of(text):
            c.update(ws)
            seen.update(ws)
        self.docs.setdefault(key, Counter()).update(seen)
        self.size += len(c) - before

    def run(self, shards: int, part: int) -> pa.RecordBatch | None:
        """The block as one run: a row for each shard that it reaches, its postings sorted by term."""
        keys = [k for k in self.count if self.count[k]]
        if not keys:
            return None
        words = pa.array([w for k in keys for w in self.count[k]], pa.large_binary())
        grp = np.repeat(np.arange(len(keys)), [len(self.count[k]) for k in keys])
        cnt = np.fromiter((c for k in keys for c in self.count[k].values()), np.int64, len(words))
        docs = np.fromiter((n for k in keys for n in map(self.docs[k].__getitem__, self.count[k])), np.int64, len(words))
        offs = np.frombuffer(words.buffers()[1], np.int64)[: len(words) + 1]
        shard = (word_hashes(np.frombuffer(words.buffers()[2], np.uint8), offs[:-1], offs[1:]) % np.uint64(shards)).astype(np.int32)
        order = np.asarray(pc.sort_indices(pa.table({"s": shard, "w": words, "g": grp}), [("s", "ascending"), ("w", "ascending"), ("g", "ascending")]))
        shard = shard[order]
        cuts = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(shard))
        rows = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            at = order[a:b]
            rows.append(_row(int(shard[a]), part, b" ".join(words.take(pa.array(at)).to_pylist()), grp[at], keys, cnt[at], docs[at]))
        return _batch(rows)


def _row(shard: int, part: int, terms: bytes, grp: np.ndarray, keys: list[tuple[str, str]], cnt: np.ndarray, docs: np.ndarray) -> tuple:
    there, at = np.unique(grp, return_inverse=True)
    return (shard, part, len(grp), terms, [keys[g][0] for g in there], [keys[g][1] for g in there], _pack(at), _pack(cnt), _pack(docs))


RUN_KINDS = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary())
RUN_NAMES = ["shard", "part", "n", "terms", "langs", "sources", "grp", "cnt", "docs"]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), RUN_KINDS)], names=RUN_NAMES)


def merged(table: pa.Table) -> Iterator[tuple[bytes, dict[int, list[int]], list[tuple[str, str]]]]:
    """Each term of the runs with ``{group: [occurrences, documents]}`` and the names of the groups, by one heap-merge."""
    keys: dict[tuple[str, str], int] = {}
    names: list[tuple[str, str]] = []
    runs = []
    for r in table.to_pylist():
        own = []
        for k in zip(r["langs"], r["sources"]):
            if k not in keys:
                keys[k] = len(names)
                names.append(k)
            own.append(keys[k])
        grp = np.array(own)[_unpack(r["grp"], r["n"])]
        runs.append(zip(r["terms"].split(b" "), grp.tolist(), _unpack(r["cnt"], r["n"]).tolist(), _unpack(r["docs"], r["n"]).tolist()))
    first = itemgetter(0)
    for term, postings in groupby(heapq.merge(*runs, key=first), key=first):
        total: dict[int, list[int]] = {}
        for _, g, c, d in postings:
            if (t := total.get(g)) is None:
                total[g] = [c, d]
            else:
                t[0] += c
                t[1] += d
        yield term, total, names


def _merge_runs(table: pa.Table) -> pa.Table:
    """The runs of a shard and of FAN tasks as one run."""
    terms, grp, cnt, docs, names = [], [], [], [], []
    for term, total, names in merged(table):
        for g in sorted(total):
            terms.append(term)
            grp.append(g)
            cnt.append(total[g][0])
            docs.append(total[g][1])
    part = table.column("part")[0].as_py() // FAN
    return pa.Table.from_batches([_batch([_row(table.column("shard")[0].as_py(), part, b" ".join(terms), np.array(grp), names, np.array(cnt), np.array(docs))])])


def _kept_terms(least_docs: int):
    """The terms that enough documents of a language hold, with the occurrences in its sources."""

    def run(table: pa.Table) -> pa.Table:
        langs, terms, sources, counts = [], [], [], []
        for term, total, names in merged(table):
            by_lang: dict[str, list] = {}
            for g, (c, d) in total.items():
                mine = by_lang.setdefault(names[g][0], [0, [], []])
                mine[0] += d
                mine[1].append(names[g][1])
                mine[2].append(c)
            for lang, (d, s, c) in by_lang.items():
                if d >= least_docs:
                    langs.append(lang)
                    terms.append(term.decode("utf-8", "replace"))
                    sources.append(s)
                    counts.append(c)
        shard = pa.array(np.full(len(langs), table.column("shard")[0].as_py(), np.int32))
        return pa.table({"shard": shard, "lang": pa.array(langs, pa.string()), "term": pa.array(terms, pa.string()),
                         "sources": pa.array(sources, pa.list_(pa.string())), "counts": pa.array(counts, pa.list_(pa.int64()))})
    return run


def index(docs: DataFrame, least_docs: int = 3, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``shard int, lang, term string, sources array<string>, counts array<long>`` of the terms that at least ``least_docs`` documents of a language hold."""
    shards = max(1, -(-text_bytes(docs, text_col) // SHARD_BYTES))

    def spill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId(), Block()
        for batch in batches:
            keys = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            for i, _, data, offs in slices(batch.column(0)):
                raw = data.tobytes()
                for r, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist())):
                    block.add(keys[i + r], raw[a:b])
                    if block.size >= BLOCK_POSTINGS:
                        yield block.run(shards, part)
                        block = Block()
        if (last := block.run(shards, part)) is not None:
            yield last

    base = docs.select(*[F.coalesce(docs[f"`{c}`"].cast("string"), F.lit("")).alias(n) for c, n in ((text_col, "txt"), (lang_col, "lang"), (source_col, "source"))])
    parts = base.rdd.getNumPartitions()
    runs = base.mapInArrow(spill, RUN)
    while parts > FAN:
        runs = runs.groupBy("shard", F.floor(F.col("part") / FAN).alias("of")).applyInArrow(_merge_runs, RUN)
        parts = -(-parts // FAN)
    return runs.groupBy("shard").applyInArrow(_kept_terms(least_docs), "shard int, lang string, term string, sources array<string>, counts array<long>")


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 * (count + 1) / total), by long division in base 1000 (64 bits do for totals up to 9 * 10^15)."""
    q, r = np.divmod(count.astype(np.int64) + 1, total)
    for _ in range(3):
        d, r = np.divmod(r * 1000, total)
        q = q * 1000 + d
    return q + 1


def excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


def _pair_sums(term: np.ndarray, source: np.ndarray, p: np.ndarray, zero: np.ndarray, n_terms: int, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Sums of ``excess`` over all terms for the sources ``rows`` (p) against ``cols`` (q).

    ``term, source, p`` are the postings ordered by term; ``zero`` holds each source's share of a term it lacks.
    """
    at_row, at_col = (np.full(len(zero), -1) for _ in range(2))
    at_row[rows], at_col[cols] = np.arange(len(rows)), np.arange(len(cols))
    z_row, z_col = zero[rows], zero[cols]
    none = excess(z_row[:, None], z_col[None, :])
    out = none * n_terms
    # histogram of counts: the postings of a source with equal shares
    kinds, many = np.unique(np.stack([source, p], 1), axis=0, return_counts=True)
    for s, v, n in zip(kinds[:, 0], kinds[:, 1], many):
        if (i := at_row[s]) >= 0:
            out[i] += n * (excess(v, z_col) - none[i])
        if (j := at_col[s]) >= 0:
            out[:, j] += n * (excess(z_row, v) - none[:, j])
    left, right = np.flatnonzero(at_row[source] >= 0), np.flatnonzero(at_col[source] >= 0)
    begin, end = np.searchsorted(term[right], term[left], "left"), np.searchsorted(term[right], term[left], "right")
    upto = np.append(0, np.cumsum(end - begin))
    lo, flat = 0, out.reshape(-1)
    while lo < len(left):
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + PAIRS, "right")) - 1)
        n = (end - begin)[lo:hi]
        x = np.repeat(left[lo:hi], n)
        y = right[np.arange(int(n.sum())) - np.repeat(upto[lo:hi] - upto[lo], n) + np.repeat(begin[lo:hi], n)]
        ps, pt, zs, zt = p[x], p[y], zero[source[x]], zero[source[y]]
        np.add.at(flat, at_row[source[x]] * len(cols) + at_col[source[y]], excess(ps, pt) - excess(ps, zt) - excess(zs, pt) + excess(zs, zt))
        lo = hi
    return out


def _corrections(tiles: int, top_terms: int):
    """Part sums of all pairs of one tile, and the best terms of its sources, over some of a language's terms."""

    def run(key, kept: pa.Table, groups: pa.Table) -> pa.Table:
        lang, tile = key[0].as_py(), key[2].as_py()
        kept = kept.sort_by("term")
        names = groups.column("source").combine_chunks()
        total, own = np.asarray(groups.column("total")), np.asarray(groups.column("tile"))
        lists = kept.column("sources").combine_chunks()
        term = np.repeat(np.arange(len(kept)), np.diff(np.asarray(lists.offsets)))
        source = np.asarray(pc.index_in(lists.flatten(), value_set=names)).astype(np.int64)
        count = np.asarray(kept.column("counts").combine_chunks().flatten()).astype(np.int64)
        p, zero = share(count, total[source]), share(np.zeros(len(total), np.int64), total)
        rows, cols = np.flatnonzero(own == tile // tiles), np.flatnonzero(own == tile % tiles)
        out_source, out_item, out_value = [], [], []
        if len(kept):
            sums = _pair_sums(term, source, p, zero, len(kept), rows, cols)
            i, j = np.nonzero(rows[:, None] != cols[None, :])
            out_source.append(names.take(pa.array(rows[i])))
            out_item.append(names.take(pa.array(cols[j])))
            out_value.append(sums[i, j])
        n_pairs = sum(map(len, out_value))
        if len(kept) and tile % tiles == 0:
            q = share(np.add.reduceat(count, np.searchsorted(term, np.arange(len(kept)))), np.full(1, groups.column("lang_total")[0].as_py()))[term]
            best = np.flatnonzero((p > q) & (own[source] == tile // tiles))
            value = excess(p[best], q[best])
            best, value = (x[np.lexsort((term[best], -value, source[best]))] for x in (best, value))
            first = np.searchsorted(source[best], np.arange(len(names)))
            best, value = (x[np.arange(len(x)) - first[source[best]] < top_terms] for x in (best, value))
            out_source.append(names.take(pa.array(source[best])))
            out_item.append(kept.column("term").combine_chunks().take(pa.array(term[best])))
            out_value.append(value)
        value = np.concatenate(out_value) if out_value else np.zeros(0, np.int64)
        part = pa.array(np.where(np.arange(len(value)) < n_pairs, "pair", "term"), pa.string())
        return pa.table({"lang": pa.array([lang] * len(value), pa.string()), "source": pa.concat_arrays(out_source) if out_source else pa.array([], pa.string()),
                         "part": part, "item": pa.concat_arrays(out_item) if out_item else pa.array([], pa.string()), "value": pa.array(value, pa.int64())})
    return run


def divergence(docs: DataFrame, least_docs: int = 3, top_terms: int = 200, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, part, item string, value long, rank int``: how the sources of each language differ.

    Terms are runs of ASCII letters (A-Z lower-cased) and characters beyond ASCII; a language keeps those that at least
    ``least_docs`` of its documents hold.  A group's share of a term is p = 1 + floor(10^9 * (count + 1) / (N + V)), with
    N its occurrences of kept terms and V the kept terms; f = floor((p - q)^2 / q).  Part ``pair``: f summed over all
    kept terms against each other source of the language (0 where no term is kept).  Part ``term``: kept terms of the
    source with a share above the language's, the first ``top_terms``.  Ranks count from 1 in each group and part, by
    falling value, then by item as UTF-8 bytes.  Null texts, languages and sources count as empty strings; a group
    without terms has its pairs; repeated rows are documents of their own; an empty table gives no rows.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    names = [F.coalesce(docs[f"`{c}`"].cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))]
    present = docs.select(*names).distinct()
    kept = index(docs, least_docs, text_col, lang_col, source_col).checkpoint()
    posting = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")).select("lang", F.col("x.sources").alias("source"), F.col("x.counts").alias("c"))
    own = posting.groupBy("lang", "source").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("postings"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    groups = present.join(own, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v", "postings")]).checkpoint()
    by_lang = groups.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count(F.lit(1)).alias("sources"))
    most, postings = groups.agg(F.max("v"), F.sum("postings")).first()
    widest = by_lang.agg(F.max("sources")).first()[0] or 1
    steps, tiles = max(1, -(-int(postings or 0) // STEP_POSTINGS)), -(-int(widest) // TILE)
    stats = groups.join(by_lang, "lang").where("v > 0").select(
        "lang", "source", (F.col("n") + F.col("v")).alias("total"), (F.col("lang_n") + F.col("v")).alias("lang_total"),
        F.pmod(F.xxhash64("source"), F.lit(tiles)).cast("int").alias("tile"))
    each_step = F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("step")
    each_tile = F.explode(F.sequence(F.lit(0), F.lit(tiles * tiles - 1))).alias("of")
    right = stats.select("*", each_step).select("*", each_tile)
    left = kept.select("lang", "term", "sources", "counts", F.pmod(F.xxhash64("term"), F.lit(steps)).cast("int").alias("step"), each_tile)
    found = left.groupBy("lang", "step", "of").cogroup(right.groupBy("lang", "step", "of")).applyInArrow(
        _corrections(tiles, top_terms), "lang string, source string, part string, item string, value long").checkpoint()
    sums = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = pairs.join(sums, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [x.withColumn("rank", F.row_number().over(order)) for x in (pairs, found.where("part = 'term'"))]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top_terms)).select("lang", "source", "part", "item", "value", "rank")
