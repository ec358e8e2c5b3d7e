"""Self-join of documents on the Jaccard similarity of their word shingles by T-occurrence search.

1. Texts with the same set are one class, found by a fingerprint of the set.
2. Two sets that link differ in at most H shingles, where H follows from their
   sizes.  Their shingles are hashed into more than H parts, so some part is
   equal in both; part fingerprints that meet put classes into one cluster.
   This loses no link, and a shared passage does not bring documents together.
3. Sets that meet by chance chain a cluster up as the input grows, so the classes
   of a large one are clustered anew: by the rarest shingles of each, of which
   two sets that link share one.  A class whose shingles mostly stand in no
   other set links with nothing and goes.  This loses no link either.
4. In a cluster, T-occurrence search: the inverted lists of a set are split into
   long and short ones (DivideSkip), the short ones are merged with a heap, and
   each candidate is completed by binary probes for the long ones.  A cluster
   that is still large is cut into chunks, each pair of chunks is searched by
   itself, and the sets of a chunk travel as one table of shingles and places in it.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.blocks import possible, row_struct
from shelfwise.llm.components import components
from shelfwise.llm.text import LOWER, Rolling, found, give_back, mix, signed, slices, trim, unsigned, word_hashes, word_spans
from shelfwise.session import ensure_checkpoint_dir

#: Classes of a cluster that one task compares among themselves; of a larger cluster two such chunks meet in a task.
CHUNK = 128
#: Pairs of chunks that one task searches, about.
PAIRS = 8
#: Sets of a search after which freed memory goes back.
TRIMMED = 32


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a run of rows, ordered by row and value, and each row's offsets among them."""
    starts, ends, first = word_spans(data, offs)
    roll = Rolling(word_hashes(LOWER[data], starts, ends))
    count = np.diff(first)
    left = np.repeat(first[1:], count) - np.arange(len(starts))
    at = np.flatnonzero(left >= k)
    row = np.repeat(np.arange(len(count)), count)[at]
    short = np.flatnonzero((count > 0) & (count < k))
    h = np.concatenate([roll.windows(at, k), roll.windows(first[:-1][short], count[short])])
    row = np.concatenate([row, short])
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], np.searchsorted(row[new], np.arange(len(count) + 1))


def set_keys(h: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A fingerprint of each row's set (0 for an empty one)."""
    n = np.diff(offs)
    out = np.zeros(len(n), np.uint64)
    some = n > 0
    if some.any():
        out[some] = mix(np.add.reduceat(mix(h ^ np.uint64(0xA5A5A5A55A5A5A5A)), offs[:-1][some]) + n[some].astype(np.uint64))
    return out


class Parts:
    """Length classes and, for each, the number of parts its sets are hashed into."""

    def __init__(self, num: int, den: int):
        self.num, self.den, self.low, self.parts, self.spare = num, den, [1], [], []

    def _grow(self, n: int) -> None:
        """Class i holds sizes low[i] .. low[i + 1] - 1; partners of a size lie in its class or the next."""
        while len(self.low) < 3 or self.low[-3] <= n:
            self.low.append(self.low[-1] * self.den // self.num + 1)
        while len(self.parts) < len(self.low) - 1:
            i = len(self.parts)
            top = self.low[i + 1] - 1
            differ = (self.den - self.num) * 2 * top // (self.num + self.den)
            # some parts may be empty in both sets; `spare` more parts leave a filled one among the equal ones
            empty = (differ + 1) * math.exp(-self.num * self.low[i] / self.den / (differ + 1))
            spare = int(empty + 5 * math.sqrt(empty) + 0.1 * differ) + 1 if differ else 0
            self.parts.append(differ + 1 + spare)
            self.spare.append(spare)

    def signatures(self, h: np.ndarray, offs: np.ndarray, frequent: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Part fingerprints and the row of each.  A scheme of one part is left out: it finds equal sets only.

        ``frequent`` shingles say little: two sets without them differ in no more places than with them, so parts of
        the remaining shingles do as well.  A row of which too many parts are then empty sends its parts of all
        shingles too; two rows that agree only in parts that are empty are both such rows.
        """
        if frequent is not None and len(frequent) and len(h):
            row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
            rare = ~found(h, frequent)
            part_offs = np.append(0, np.cumsum(np.bincount(row[rare], minlength=len(offs) - 1)))
            sig, who, poor = self._sent(h[rare], part_offs, np.diff(offs), 1)
            again = np.flatnonzero(poor)
            some = poor[row]
            more_offs = np.append(0, np.cumsum(np.diff(offs)[again]))
            sig2, who2, _ = self._sent(h[some], more_offs, np.diff(offs)[again], 0)
            return np.concatenate([sig, sig2]), np.concatenate([who, again[who2]])
        return self._sent(h, offs, np.diff(offs), 0)[:2]

    def _sent(self, h: np.ndarray, offs: np.ndarray, whole: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints, their rows, and the rows with too many empty parts; ``whole`` holds the sizes that choose the scheme.

        Rows with too many empty parts send those as well when ``kind`` is 0; with 1 they are only named.
        """
        n = whole
        poor = np.zeros(len(n), bool)
        if not len(n) or not n.max(initial=0):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), poor
        self._grow(int(n.max()))
        own = np.searchsorted(np.array(self.low), n, "right") - 1
        lo, hi = (h & np.uint64(0xFFFFFFFF)).astype(float), (h >> np.uint64(32)).astype(float)
        sigs, rows = [], []
        for more in (0, 1):
            scheme = np.maximum(own, 0) + more
            m, spare = np.array(self.parts)[scheme], np.array(self.spare)[scheme]
            m = np.where((n > 0) & (m > 1), m, 0)
            base = np.append(0, np.cumsum(m))
            if not base[-1]:
                continue
            row = np.repeat(np.arange(len(n)), np.diff(offs))
            use = m[row] > 0
            slot = base[row[use]] + (mix(h[use]) >> np.uint64(20)).astype(np.int64) % m[row[use]]
            total = np.bincount(slot, lo[use], base[-1]).astype(np.uint64) + (np.bincount(slot, hi[use], base[-1]).astype(np.uint64) << np.uint64(32))
            filled = np.bincount(slot, minlength=base[-1])
            owner = np.repeat(np.arange(len(n)), m)
            part = np.arange(base[-1]) - base[owner]
            empties = np.bincount(owner, filled == 0, len(n))
            lacking = (empties > spare) & (m > 0)
            poor |= lacking
            sent = filled > 0
            if kind == 0:
                sent |= lacking[owner]
            salt = mix(scheme[owner].astype(np.uint64) * np.uint64(1 << 40) + part.astype(np.uint64) + np.uint64(kind << 62))
            sigs.append(mix(total + salt + (filled == 0) * np.uint64(77))[sent])
            rows.append(owner[sent])
        if not sigs:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), poor
        return np.concatenate(sigs), np.concatenate(rows), poor


def least_overlap(x: int, y: int, num: int, den: int) -> int:
    """The smallest intersection of sets of x and y elements with den * intersection >= num * union."""
    return -(-num * (x + y) // (num + den))


def divide_skip(queries: list[int], index: list[int], sets: list[np.ndarray], num: int, den: int) -> Iterator[tuple[int, int]]:
    """Pairs (query, indexed set) that reach the similarity; a pair of the same list comes once."""
    inside = queries is index
    lists: dict[int, list[int]] = {}
    for y in index:
        for s in sets[y].tolist():
            lists.setdefault(s, []).append(y)
    for x in queries:
        mine = sets[x]
        n = len(mine)
        need = -(-num * n // den)  # no partner shares fewer
        got = sorted(((lists[s], s) for s in mine.tolist() if s in lists), key=lambda p: len(p[0]))
        if len(got) < need:
            continue
        most = len(got[-1][0])
        n_long = max(0, min(need - 1, int(need / (0.0085 * math.log(most + 1) + 1))))
        short, long = got[: len(got) - n_long], got[len(got) - n_long:]
        probes = np.sort(np.array([s for _, s in long], np.uint64)) if long else None
        for y, run in groupby(heapq.merge(*[p[0] for p in short])):
            if y == x or inside and y < x:
                continue
            other = sets[y]
            t = least_overlap(n, len(other), num, den)
            if t > min(n, len(other)):
                continue
            c = sum(1 for _ in run)
            if c + len(long) < t:
                continue
            if c < t and len(long):
                k = np.searchsorted(other, probes)
                k[k == len(other)] = 0
                c += int((other[k] == probes).sum())
            if c >= t:
                yield x, y


#: Bytes of a part fingerprint (beside its bucket) and of a class that go through the shuffle.  They only bring classes
#: together; a false meeting costs a comparison and changes no result.
SENT = 5
SENT_MASK = (1 << 8 * SENT) - 1
#: Fingerprints that a task holds before it sends them on, and shingles that it counts together.
HELD, COUNTED = 400_000, 1_500_000
#: Bytes of texts whose shingles are made at once.
RUN_BYTES = 512 << 10
#: Frequent shingles that every task knows.
FREQUENT = 1 << 17
#: Shingles whose part fingerprints one bucket takes.
BUCKET_SHINGLES = 300_000


def _pack(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :SENT].tobytes()


def _unpack(parts: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, SENT)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :SENT] = raw
    return out.view(np.uint64).ravel()


def _least_of(sig: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct fingerprints, the smallest class of each, and the distinct pairs of another class and that one."""
    order = np.lexsort((cls, sig))
    sig, cls = sig[order], cls[order]
    new = np.ones(len(sig), bool)
    new[1:] = sig[1:] != sig[:-1]
    least = cls[new][np.cumsum(new) - 1] if len(cls) else cls
    other = cls != least
    return sig[new], cls[new], np.unique(np.stack([cls[other], least[other]], 1), axis=0)


def frequent_shingles(docs: DataFrame, txt: Column, k: int) -> np.ndarray:
    """Shingles of many documents: at most FREQUENT, by the counts of those in a thousandth of the rows counted together.

    They only steer which classes meet; no result depends on which ones are found.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(hs: list[np.ndarray], rows: int) -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(hs), return_counts=True)
            many = n >= max(4, rows // 1000)
            return pa.RecordBatch.from_arrays([signed(h[many]), pa.array(n[many].astype(np.int64))], names=["h", "n"])

        hs, rows, held = [], 0, 0
        for batch in batches:
            for i, j, data, offs in slices(batch.column(0), RUN_BYTES):
                hs.append(shingle_sets(data, offs, k)[0])
                rows, held = rows + j - i, held + len(hs[-1])
                if held >= COUNTED:
                    yield out(hs, rows)
                    hs, rows, held = [], 0, 0
        if hs:
            yield out(hs, rows)
        give_back()

    counts = docs.select(txt.alias("txt")).mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).checkpoint()
    bins = sorted(counts.groupBy(F.floor(F.log2("n") * 8).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
    least, taken = None, 0
    for b in bins:
        taken += b["n"]
        if taken > FREQUENT:
            break
        least = b["b"]
    if least is None:
        return np.zeros(0, np.uint64)
    got = counts.where(F.floor(F.log2("n") * 8) >= least).select("h").collect()
    return np.sort(np.array([r["h"] for r in got], np.int64).view(np.uint64))


def _postings(k: int, num: int, den: int, buckets: int, frequent: np.ndarray):
    """Part fingerprints with a class of each, dealt into buckets; classes that meet in a task come as pairs.

    Of HELD fingerprints each leaves once, with its smallest class, so a large group of near copies makes no large bucket.
    """

    def sent(sig: list[np.ndarray], cls: list[np.ndarray]) -> pa.RecordBatch | None:
        s, c, pair = _least_of(np.concatenate(sig), np.concatenate(cls))
        to = ((s >> np.uint64(8 * SENT)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        s, c, to = s[order], c[order], to[order]
        there, at = np.unique(to, return_index=True)
        ends = np.append(at[1:], len(to))
        rows = [(int(b), _pack(s[x:y]), _pack(c[x:y]), False) for b, x, y in zip(there, at, ends)]
        if len(pair):
            rows.append((int(pair[0, 0] % np.uint64(buckets)), _pack(pair[:, 0]), _pack(pair[:, 1]), True))
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary(), pa.bool_()))],
                                          names=["bucket", "a", "b", "pairs"]) if rows else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = Parts(num, den)
        sig, cls, held = [], [], 0
        for batch in batches:
            for _, _, data, offs in slices(batch.column(0), RUN_BYTES):
                h, o = shingle_sets(data, offs, k)
                s, row = parts.signatures(h, o, frequent)
                sig.append(s)
                cls.append(set_keys(h, o)[row] & np.uint64(SENT_MASK))
                held += len(s)
                if held >= HELD and (out := sent(sig, cls)) is not None:
                    yield out
                    sig, cls, held = [], [], 0
        if sig and (out := sent(sig, cls)) is not None:
            yield out
        give_back()
    return run


def _meetings(table: pa.Table) -> pa.Table:
    """Pairs of classes of one bucket that share a part fingerprint, each with the smallest class of it."""
    pairs = np.asarray(table.column("pairs"), bool)
    a, b = table.column("a").to_pylist(), table.column("b").to_pylist()
    sent = [i for i in range(len(pairs)) if not pairs[i]]
    _, _, met = _least_of(_unpack([a[i] for i in sent]), _unpack([b[i] for i in sent]))
    near = [i for i in range(len(pairs)) if pairs[i]]
    x = np.concatenate([met[:, 0], _unpack([a[i] for i in near])])
    y = np.concatenate([met[:, 1], _unpack([b[i] for i in near])])
    trim()
    return pa.table({"a": signed(x), "b": signed(y)})


def link_documents(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100, text_col: str = "text", id_col: str = "doc_id",
                   carry: list[str] | None = None) -> DataFrame:
    """The columns named in ``carry`` (all but the text, if None), then ``n_shingles, component_id, n_links, group_key``.

    Texts link when ``den * intersection >= num * union`` of their sets of ``k``-word shingles (A-Z lower-cased);
    a text of fewer words is one shingle.  ``component_id`` is the smallest non-null id reachable by links, the
    row's own id included; ``group_key`` is equal within a component, null without shingles; ``n_links`` counts the other rows a row links with, copies included.  Null, empty and
    blank texts have no shingles and link with nothing.  Rows that repeat link with each other.  An empty table
    gives no rows.  Sets are compared by 64-bit fingerprints of their shingles.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    txt = F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit(""))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, key = [], []
            for _, _, data, offs in slices(batch.column(0), RUN_BYTES):
                h, o = shingle_sets(data, offs, k)
                n.append(np.diff(o))
                key.append(set_keys(h, o))
            if n:
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(np.concatenate(n).astype(np.int64)), signed(np.concatenate(key))],
                                                 names=[*batch.schema.names[1:], "n", "cls"])

    base = docs.select(txt.alias("txt"), docs[f"`{id_col}`"].alias("id"), F.xxhash64(txt).alias("mark"), row_struct(docs, text_col, carry, ("n_shingles", "component_id", "n_links", "group_key")).alias("row"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in base.schema.fields[1:])
    meta = base.mapInArrow(describe, f"{kinds}, n long, cls long").withColumn("cls", F.when(F.col("n") > 0, F.col("cls"))).checkpoint()
    classes = meta.where("cls is not null").groupBy("cls").agg(F.min("id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"),
                                                                 F.coalesce(F.min_by("mark", "id"), F.min("mark")).alias("mark"))  # the text of a row with the least id

    shingles = classes.agg(F.sum(F.col("n"))).first()[0] or 0
    buckets = max(1, -(-int(shingles) // BUCKET_SHINGLES))
    posted = docs.select(txt.alias("txt")).mapInArrow(_postings(k, num, den, buckets, frequent_shingles(docs, txt, k)), "bucket int, a binary, b binary, pairs boolean")
    near = components(posted.groupBy("bucket").applyInArrow(_meetings, "a long, b long"))
    member = near.join(classes.withColumn("node", F.col("cls").bitwiseAND(F.lit(SENT_MASK))), "node")
    member = member.select("cls", "root", "least_id", "mark", "copies").checkpoint()
    links_of = cluster_links(docs, member, k, num, den, text_col, id_col).checkpoint()
    comp = components(links_of.where("b is not null").select("a", "b"))
    links = links_of.where("b is null").groupBy("a").agg(F.sum("w").alias("w"))
    named = comp.join(classes.select(F.col("cls").alias("node"), "least_id"), "node")
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_class = (classes.join(comp.join(least, "root").select(F.col("node").alias("cls"), "root", "component_id"), "cls", "left")
                .join(links.withColumnRenamed("a", "cls"), "cls", "left")
                .select("cls", F.coalesce("root", "cls").alias("group_key"), F.coalesce("component_id", "least_id").alias("component_id"), (F.coalesce("w", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    out = meta.join(by_class, "cls", "left")
    return out.select("row.*", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "group_key")


def element_sets(docs: DataFrame, cand: DataFrame, k: int, text_col: str, id_col: str) -> DataFrame:
    """``c_cls, root, copies, n, elements``: the shingle sets of the classes of ``cand``; repeated rows of one id bring a class twice."""

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offs in slices(batch.column(0), RUN_BYTES):
                h, o = shingle_sets(data, offs, k)
                mine = batch.slice(i, j - i)
                same = pa.array(set_keys(h, o).view(np.int64) == np.asarray(mine.column(1)))
                cut = pa.array([h[a:b].tobytes() for a, b in zip(o[:-1], o[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([*mine.columns[1:], pa.array(np.diff(o).astype(np.int64)), cut],
                                                 names=[*mine.schema.names[1:], "n", "elements"]).filter(same)
        give_back()

    # an id alone would bring every row without one, or with a shared one, to all classes of that id
    right = cand.select(F.col("least_id").alias("id"), F.col("mark").alias("c_mark"), F.col("cls").alias("c_cls"), "root", "copies")
    left = docs.select(docs[f"`{text_col}`"].cast("string").alias("txt"), docs[f"`{id_col}`"].alias("key")).withColumn("mark", F.xxhash64("txt"))
    left = possible(left, F.xxhash64("key", "mark"), right, F.xxhash64("id", "c_mark")).where("possible").drop("possible")
    texts = left.join(right, left["key"].eqNullSafe(right["id"]) & (left["mark"] == right["c_mark"])).select("txt", "c_cls", "root", "copies")
    return texts.mapInArrow(to_sets, "c_cls long, root long, copies long, n long, elements binary")


def _dealt(buckets: int):
    """Shingles of sets with the class of each, dealt into buckets."""

    def sent(h: list[np.ndarray], cls: list[np.ndarray]) -> pa.RecordBatch:
        h, cls = np.concatenate(h), np.concatenate(cls)
        to = (mix(h) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(to, kind="stable")
        h, cls, to = h[order], cls[order], to[order]
        there, at = np.unique(to, return_index=True)
        ends = np.append(at[1:], len(to))
        packed = [pa.array([_pack(v[x:y]) for x, y in zip(at, ends)], pa.binary()) for v in (h, cls)]
        return pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), *packed], names=["bucket", "h", "cls"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hs, cls, held = [], [], 0
        for batch in batches:
            for c, e in zip(unsigned(batch.column(0)), batch.column(1)):
                hs.append(np.frombuffer(e.as_py(), np.uint64))
                cls.append(np.full(len(hs[-1]), c))
                held += len(hs[-1])
                if held >= HELD:
                    yield sent(hs, cls)
                    hs, cls, held = [], [], 0
        if held:
            yield sent(hs, cls)
        give_back()
    return run


def _shared(owners: int):
    """The shingles of one bucket that several sets hold, with each class that has them, dealt by class.

    A shingle's key orders the rare before the frequent, and is the same for all classes.
    """

    def run(table: pa.Table) -> pa.Table:
        h, cls = (_unpack(table.column(c).to_pylist()) for c in ("h", "cls"))
        order = np.argsort(h, kind="stable")
        h, cls = h[order], cls[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        held = np.repeat(np.diff(np.append(first, len(h))), np.diff(np.append(first, len(h))))
        some = held > 1
        bucket = np.uint64(table.column("bucket")[0].as_py() & 0xFF)
        key = (np.minimum(held[some], 0xFFFF).astype(np.uint64) << np.uint64(48)) | (bucket << np.uint64(40)) | h[some]
        cls = cls[some]
        to = (cls % np.uint64(owners)).astype(np.int32)
        order = np.argsort(to, kind="stable")
        cls, key, to = cls[order], key[order], to[order]
        there, at = np.unique(to, return_index=True)
        ends = np.append(at[1:], len(to))
        trim()
        return pa.table({"owner": pa.array(there, pa.int32()), "cls": pa.array([_pack(cls[x:y]) for x, y in zip(at, ends)], pa.binary()),
                         "key": pa.array([key[x:y].tobytes() for x, y in zip(at, ends)], pa.binary())})
    return run


def _rarest(num: int, den: int):
    """The classes of one owner with their rarest shingles, of which two sets that link have one in common.

    Sets of n link only if they share ``num / den`` of n, so in any order of the shingles one is among the first
    ``n - share + 1`` of both; one more is kept for shingles that fell together.  Those that no other set holds come
    first, and a set that has so many of them goes.
    """

    def run(shared: pa.Table, sizes: pa.Table) -> pa.Table:
        cls, at = np.unique(unsigned(sizes.column("c_cls")), return_index=True)
        n = np.asarray(sizes.column("n"))[at]
        node, at, several = np.unique(cls & np.uint64(SENT_MASK), return_index=True, return_counts=True)
        n = n[at]
        mine = _unpack(shared.column("cls").to_pylist())
        key = np.frombuffer(b"".join(shared.column("key").to_pylist()), np.uint64)
        order = np.lexsort((key, mine))
        mine, key = mine[order], key[order]
        new = np.ones(len(mine), bool)
        new[1:] = (mine[1:] != mine[:-1]) | (key[1:] != key[:-1])
        mine, key = mine[new], key[new]
        begin, end = np.searchsorted(mine, node), np.searchsorted(mine, node, "right")
        take = n + num * n // -den + 2 - (n - (end - begin))
        take = np.where(several > 1, end - begin, np.clip(take, 0, end - begin))  # classes that are one in the bytes sent keep all
        whose = np.searchsorted(node, mine)
        kept = np.arange(len(mine)) - begin[whose] < take[whose]
        trim()
        return pa.table({"node": signed(mine[kept]), "key": signed(key[kept])})
    return run


def clustered_anew(sets: DataFrame, num: int, den: int) -> DataFrame:
    """``node, root``: clusters of the classes of ``sets`` whose rarest shingles meet; a class without a partner is left out."""
    total = int(sets.agg(F.sum("n")).first()[0] or 0)
    buckets = max(1, -(-total // BUCKET_SHINGLES))
    node = F.col("c_cls").bitwiseAND(F.lit(SENT_MASK))
    shared = sets.select("c_cls", "elements").mapInArrow(_dealt(buckets), "bucket int, h binary, cls binary")
    shared = shared.groupBy("bucket").applyInArrow(_shared(buckets), "owner int, cls binary, key binary")
    sizes = sets.select((node % F.lit(buckets)).cast("int").alias("owner"), "c_cls", "n")
    rare = shared.groupBy("owner").cogroup(sizes.groupBy("owner")).applyInArrow(_rarest(num, den), "node long, key long")
    rare = rare.withColumn("least", F.min("node").over(Window.partitionBy("key")))
    return components(rare.where("least < node").select(F.col("node").alias("a"), F.col("least").alias("b")))


def linked(keys: np.ndarray, copies: list[int], sets: list[np.ndarray], left: list[int], right: list[int], num: int, den: int) -> pa.Table:
    """``a, b`` for a spanning forest of the links between ``left`` and ``right``, and ``a, w`` (b null) for the rows a class links with."""
    top, degree = list(range(len(sets))), [0] * len(sets)

    def root(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for x, y in divide_skip(left, right, sets, num, den):
        degree[x] += copies[y]
        degree[y] += copies[x]
        x, y = sorted((root(x), root(y)))
        top[y] = x
    a, b, w = [], [], []
    for x in range(len(sets)):
        if degree[x]:
            a += [keys[x]]
            b += [None]
            w += [degree[x]]
            if root(x) != x:
                a += [keys[x]]
                b += [keys[root(x)]]
                w += [None]
    if len(sets) > TRIMMED:
        trim()
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "w": pa.array(w, pa.int64())})


def pack_sets(keys: np.ndarray, copies: np.ndarray, sets: list[np.ndarray]) -> bytes:
    """Sets as one table of their shingles, the common ones first, and each set's steps in it, compressed."""
    h, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(-count, kind="stable")
    rank = np.empty(len(h), np.int64)
    rank[order] = np.arange(len(h))
    sizes = np.array([len(x) for x in sets], np.int64)
    row = np.repeat(np.arange(len(sets)), sizes)
    place = rank[place]
    by = np.lexsort((place, row))
    steps = np.diff(place[by], prepend=0)
    steps[(np.cumsum(sizes) - sizes)[sizes > 0]] = place[by][(np.cumsum(sizes) - sizes)[sizes > 0]]
    head = np.array([len(keys), len(h)], np.int64)
    raw = b"".join(np.ascontiguousarray(x).tobytes() for x in (head, keys, copies, sizes, h[order], steps.astype(np.uint32)))
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack_sets(blob: bytes) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    n, shingles = np.frombuffer(raw, np.int64, 2)
    keys, copies, sizes = np.frombuffer(raw, np.int64, 3 * n, 16).reshape(3, n)
    h = np.frombuffer(raw, np.uint64, shingles, 16 + 24 * n)
    steps = np.frombuffer(raw, np.uint32, offset=16 + 24 * n + 8 * shingles).astype(np.int64)
    ends = np.cumsum(sizes)
    return keys, copies, [np.sort(h[np.cumsum(steps[e - m: e])]) for m, e in zip(sizes, ends)]


def cluster_links(docs: DataFrame, cand: DataFrame, k: int, num: int, den: int, text_col: str, id_col: str) -> DataFrame:
    """Links within the clusters: ``a, b`` for a spanning forest, and ``a, w`` (b null) for the rows a class links with."""
    sizes = cand.groupBy("root").agg(F.count(F.lit(1)).alias("classes"))
    cand = cand.join(sizes, "root")
    whole = element_sets(docs, cand.where(F.col("classes") <= CHUNK), k, text_col, id_col)
    large = None
    if sizes.where(F.col("classes") > CHUNK).limit(1).count():
        sets = element_sets(docs, cand.where(F.col("classes") > CHUNK), k, text_col, id_col).checkpoint()
        anew = sets.select("c_cls", "n").distinct().withColumn("node", F.col("c_cls").bitwiseAND(F.lit(SENT_MASK)))
        anew = anew.join(clustered_anew(sets, num, den), "node").select("c_cls", "n", "root")
        anew = anew.join(anew.groupBy("root").agg(F.count(F.lit(1)).alias("classes")), "root").checkpoint()
        whole = whole.unionByName(sets_of(sets, anew.where(F.col("classes") <= CHUNK).select("c_cls", "root", "n")))
        if anew.where(F.col("classes") > CHUNK).limit(1).count():
            large = chunk_links(sets, anew.where(F.col("classes") > CHUNK), num, den)

    def search(table: pa.Table) -> pa.Table:
        keys, copies, sets = table_sets(table)
        every = list(range(len(sets)))
        return linked(keys, copies.tolist(), sets, every, every, num, den)

    out = whole.groupBy("root").applyInArrow(search, "a long, b long, w long")
    return out if large is None else out.unionByName(large)


def sets_of(sets: DataFrame, some: DataFrame) -> DataFrame:
    """The sets of the classes of ``some``, with its columns."""
    some = some.withColumnRenamed("c_cls", "_cls")
    left = possible(sets.select("c_cls", "copies", "elements"), F.xxhash64("c_cls"), some, F.xxhash64("_cls")).where("possible").drop("possible")
    return left.join(some, left["c_cls"] == some["_cls"]).drop("_cls")


def table_sets(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Classes, copies and sets of a table; a class that comes twice is taken once."""
    keys, first = np.unique(np.asarray(table.column("c_cls")), return_index=True)
    table = table.take(pa.array(first))
    return keys, np.asarray(table.column("copies")), [np.frombuffer(b, np.uint64) for b in table.column("elements").to_pylist()]


def chunk_links(sets: DataFrame, some: DataFrame, num: int, den: int) -> DataFrame:
    """As ``cluster_links``, by pairs of chunks of a cluster; ``some`` names the classes, their clusters and sizes."""
    # sets that link differ by less than one step of this scale, so only neighbouring steps of a cluster are compared
    step = F.floor(F.log(F.col("n").cast("double")) / (math.log(den / num) * 1.001)).cast("int")
    some = some.select("c_cls", "root", step.alias("step"))
    sizes = some.groupBy("root", "step").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks")).checkpoint()
    some = some.join(sizes, ["root", "step"]).select("c_cls", "root", "step", F.pmod(F.xxhash64("c_cls", F.lit(3)), F.col("chunks")).cast("int").alias("mine"))

    def pack(table: pa.Table) -> pa.Table:
        return pa.table({**{c: table.column(c).slice(0, 1) for c in ("root", "step", "mine")}, "packed": pa.array([pack_sets(*table_sets(table))], pa.binary())})

    packed = sets_of(sets, some).groupBy("root", "step", "mine").applyInArrow(pack, "root long, step int, mine int, packed binary")
    for name, shift in (("below", -1), ("above", 1)):
        sizes = sizes.join(sizes.select("root", (F.col("step") - shift).alias("step"), F.col("chunks").alias(name)), ["root", "step"], "left")
    packed = packed.join(sizes, ["root", "step"])
    pairs = int(sizes.agg(F.sum(F.expr("chunks * (chunks + 1L) / 2 + chunks * coalesce(above, 0L)"))).first()[0] or 0)

    def each(n: Column) -> Column:
        return F.when(F.coalesce(n, F.lit(0)) > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.expr("cast(array() as array<int>)"))

    def block(step: Column, across: Column, i: Column, j: Column, first: Column) -> Column:
        return F.struct(step.alias("step"), across.alias("across"), i.cast("int").alias("i"), j.cast("int").alias("j"), first.alias("first"))

    # two chunks of one step, or a chunk of a step (first) and one of the next
    yes, no, at, mine = F.lit(True), F.lit(False), F.col("step"), F.col("mine")
    own = F.transform(each(F.col("chunks")), lambda c: block(at, no, F.least(mine, c), F.greatest(mine, c), mine <= c))
    up = F.transform(each(F.col("above")), lambda c: block(at, yes, mine, c, yes))
    down = F.transform(each(F.col("below")), lambda c: block(at - 1, yes, c, mine, no))
    blocks = packed.select("root", "packed", F.explode(F.concat(own, up, down)).alias("b")).select("root", "b.*", "packed")
    key = ["root", "step", "across", "i", "j"]  # dealt by number, since small rows mean much work here

    def search(table: pa.Table) -> pa.Table:
        keys, copies, sets, sides = [], [], [], ([], [])
        for packed, first in zip(table.column("packed").to_pylist(), table.column("first").to_pylist()):
            more = unpack_sets(packed)
            sides[not first].extend(range(len(sets), len(sets) + len(more[2])))
            keys.append(more[0])
            copies += more[1].tolist()
            sets += more[2]
        alone = not table.column("across")[0].as_py() and table.column("i")[0].as_py() == table.column("j")[0].as_py()
        return linked(np.concatenate(keys), copies, sets, sides[0], sides[0] if alone else sides[1], num, den)

    return blocks.repartition(max(1, -(-pairs // PAIRS)), *key).groupBy(*key).applyInArrow(search, "a long, b long, w long")


def keep_one(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, one of each group of linked documents: the one with the smallest id.

    A null id comes after all others, and the smallest fingerprint of the text decides between equal ids.  Of rows that
    are equal in id and text one stays.  Documents without words are linked with nothing and stay.
    """
    names = docs.columns
    text, key = docs[f"`{text_col}`"].cast("string"), docs[f"`{id_col}`"]
    ids = docs.select(key.alias("id"), text.alias("txt"), F.xxhash64(text).alias("mark"))
    linked = link_documents(ids, k, num, den, text_col="txt", id_col="id").where("group_key is not null")
    each = linked.groupBy("group_key", "id", "mark").agg(F.count(F.lit(1)).alias("rows"))
    first = each.groupBy("group_key").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("x"))
    judged = each.join(first, "group_key").withColumn("stays", F.col("id").eqNullSafe(F.col("x.id")) & (F.col("mark") == F.col("x.mark")))
    # the few rows that go, or that stay once of several equal ones; only they and what shares their bits is shuffled
    judged = judged.where("not stays or rows > 1").select(F.col("id").alias("j_id"), F.col("mark").alias("j_mark"), "stays").checkpoint()
    row = docs.select(F.struct(*[docs[f"`{c}`"].alias(c) for c in names]).alias("row"), key.alias("id"), F.xxhash64(text).alias("mark"))
    row = possible(row, F.xxhash64("id", "mark"), judged, F.xxhash64("j_id", "j_mark"))
    met = row.where("possible").join(judged, row["id"].eqNullSafe(judged["j_id"]) & (F.col("mark") == F.col("j_mark")), "left")
    again = met.where("stays").dropDuplicates(["id", "mark"]).select("row")
    return row.where("not possible").select("row").unionByName(met.where("stays is null").select("row")).unionByName(again).select("row.*")
