"""Exact removal of repeated byte strings with suffix arrays.

Every window of ``window`` bytes has an anchor: the smallest fingerprint among
its first ``reach + 1`` short grams.  Equal windows have the anchor at the same
place and share the core that starts there.  Cores that occur twice are
partitioned by their fingerprint; in each partition the strings around the cores
(left rest, core as one symbol, right rest) make a generalised suffix array, and
the longest common prefix of a suffix with its neighbours tells whether the
window that starts there occurs elsewhere.

The suffix array is built by linear grouping: suffixes are grouped by their
Lyndon prefix in descending order of groups, each group extending the groups of
its previous-smaller positions; a second pass emits the order inside the groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.blocks import blocked, whole_groups
from shelfwise.llm.text import BYTE, Rolling, distinct_counts, found, give_back, loose, mix, signed, slices, unsigned

#: The largest number of places before a core at which a window may start (a mask has 64 bits).
REACH = 60
GRAM = 16
#: Bytes of a run of texts whose anchors are made at once (some 100 bytes of arrays for each), and strings resolved at once.
RUN_BYTES = 256 << 10
RESOLVED = 10_000


def suffix_array(text: list[int]) -> list[int]:
    """The suffix array of a sequence whose last element is its only smallest one.

    First pass: groups of suffixes, from the highest to the lowest.  A member's previous-smaller pointer names the
    nearest place to its left in a lower group.  Places named by l members of the group are extended by its prefix
    l times, so they leave their group for a new one right above it, the larger l the higher.
    Second pass: in ascending order, each suffix puts the suffixes whose prefix ends where it starts at the next
    free place of their groups.
    """
    n = len(text)
    if n < 2:
        return list(range(n))
    t = np.asarray(text)
    order = np.argsort(t, kind="stable")
    ranked = t[order]
    heads = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    size = [0] * n
    for a, b in zip(heads.tolist(), np.append(heads[1:], n).tolist()):
        size[a] = b - a
    start = np.empty(n, np.int64)
    start[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    group = start.tolist()  # the first place of a suffix's group
    sa = order.tolist()
    place = [0] * n
    for i, s in enumerate(sa):
        place[s] = i
    before = [-1] * n
    end = n
    while end > 0:
        g = group[sa[end - 1]]
        members = sa[g:end]
        if len(members) > 1:
            members.sort()
        named: dict[int, int] = {}
        for s in members:
            p = s - 1
            while p >= 0 and group[p] >= g:
                p = before[p]
            before[s] = p
            if p >= 0:
                named[p] = named.get(p, 0) + 1
        if named:
            if len(named) == 1:
                levels = [list(named)]
            else:
                by: dict[int, list[int]] = {}
                for p, c in named.items():
                    by.setdefault(c, []).append(p)
                levels = [by[c] for c in sorted(by, reverse=True)]
            for ps in levels:
                moved: dict[int, list[int]] = {}
                for p in ps:
                    o = group[p]
                    last = o + size[o] - 1
                    size[o] -= 1
                    other, at = sa[last], place[p]
                    sa[at], place[other] = other, at
                    sa[last], place[p] = p, last
                    moved.setdefault(o, []).append(p)
                for o, mine in moved.items():
                    new = o + size[o]
                    size[new] = len(mine)
                    for p in mine:
                        group[p] = new
        end = g
    out = [0] * n
    free = list(range(n))
    out[0] = n - 1
    for i in range(n):
        s = out[i]
        g = group[s]
        j = s - 1
        while j >= 0 and group[j] >= g:
            k = group[j]
            out[free[k]] = j
            free[k] += 1
            j = before[j]
    return out


def neighbour_lcp(text: np.ndarray, sa: np.ndarray, stop: int) -> np.ndarray:
    """For each place, the longest common prefix of its suffix with a neighbour's in the array, ended by symbols <= stop."""
    a, b = sa[:-1].copy(), sa[1:].copy()
    got = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    while len(live):
        x = text[a[live]]
        live = live[(x == text[b[live]]) & (x > stop)]
        got[live] += 1
        a[live] += 1
        b[live] += 1
    best = np.zeros(len(text), np.int64)
    np.maximum.at(best, sa[:-1], got)
    np.maximum.at(best, sa[1:], got)
    return best


class _Anchors:
    """Anchors of a run of rows: place, first and last window start served, and fingerprints."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, window: int, reach: int, gram: int):
        self.core = window - reach
        n = len(data)
        self.m = self.lo = self.hi = np.zeros(0, np.int64)
        self.roll = None
        start = np.repeat(offs[1:], np.diff(offs)) - np.arange(n) >= window
        p = np.flatnonzero(start)
        if not len(p):
            return
        self.roll = Rolling(BYTE[data])
        at = np.arange(n - gram + 1)
        key = (self.roll.windows(at, gram) >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)
        width = reach + 1
        rows = -(-len(key) // width) + 1
        pad = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
        pad[: len(key)] = key
        pad = pad.reshape(rows, width)
        ahead = np.minimum.accumulate(pad, axis=1).ravel()
        back = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
        m = (np.minimum(back[p], ahead[p + reach]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.append(True, m[1:] != m[:-1]))
        self.m, self.lo = m[first], p[first]
        self.hi = p[np.append(first[1:], len(p)) - 1]
        self.window = window

    def cores(self) -> np.ndarray:
        return self.roll.windows(self.m, self.core) if len(self.m) else np.zeros(0, np.uint64)

    def strings(self, some: np.ndarray) -> np.ndarray:
        """Fingerprints of the bytes around some anchors, with the anchor's place in them."""
        lo, hi, m = self.lo[some], self.hi[some], self.m[some]
        return mix(self.roll.windows(lo, hi + self.window - lo) + (m - lo).astype(np.uint64)) if len(some) else np.zeros(0, np.uint64)


def anchored(texts: pa.Array, window: int, reach: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, _Anchors]]:
    """Bytes, row offsets and anchors of runs of texts; a text longer than a run makes one of its own."""
    for _, _, data, offs in slices(texts, RUN_BYTES):
        yield data, offs, _Anchors(data, offs, window, reach, gram)


def _agree(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Length of the common prefix of two byte rows, whose lengths are nx and ny."""
    same = np.logical_and.accumulate(x == y, axis=1).sum(1)
    return np.minimum(same, np.minimum(nx, ny))


def _nearest(rows: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each row, the longest common prefix with another row of its group."""
    best = np.zeros(len(rows), np.int64)
    tag = np.ascontiguousarray(group.astype(">u4")).view(np.uint8).reshape(-1, 4)
    order = np.argsort(np.ascontiguousarray(np.hstack([tag + np.uint8(0), rows])).view(f"S{rows.shape[1] + 4}").ravel(), kind="stable")
    # byte strings compare without trailing zeros; equal groups stay together since sorting is by the group first
    order = order[np.argsort(group[order], kind="stable")]
    a, b = order[:-1], order[1:]
    same = np.where(group[a] == group[b], _agree(rows[a], size[a], rows[b], size[b]), 0)
    np.maximum.at(best, a, same)
    np.maximum.at(best, b, same)
    return best


def repeated_starts(core: np.ndarray, left: list[bytes], right: list[bytes], many: np.ndarray, reach: int) -> np.ndarray:
    """For each distinct (core, left rest, right rest), ordered by core: a mask of the starts whose window occurs elsewhere.

    Bit t stands for the window that starts t bytes before the core and so needs ``reach - t`` bytes after it.
    """
    n = len(core)
    lens, rens = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    lrow = np.frombuffer(b"".join([x[::-1].ljust(reach, b"\0") for x in left]), np.uint8).reshape(n, reach)
    rrow = np.frombuffer(b"".join([x.ljust(reach, b"\0") for x in right]), np.uint8).reshape(n, reach)
    first = np.flatnonzero(np.append(True, core[1:] != core[:-1]))
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
    of = first[group]
    # what all strings of a group share beside the core belongs to the core's symbol; beyond the first byte
    # that no other string of the group shares, a string cannot match
    lc = np.minimum.reduceat(_agree(lrow, lens, lrow[of], lens[of]), first)[group]
    rc = np.minimum.reduceat(_agree(rrow, rens, rrow[of], rens[of]), first)[group]
    lcut = np.minimum(lens, _nearest(lrow, lens, group) + 1)
    rcut = np.minimum(rens, _nearest(rrow, rens, group) + 1)
    text: list[int] = []
    at = np.zeros(n, np.int64)
    sizes = np.diff(np.append(first, n))[group]
    for i, (lo, hi, ro, rhi, g) in enumerate(zip(lc.tolist(), lcut.tolist(), rc.tolist(), rcut.tolist(), group.tolist())):
        l = left[i]
        text.extend(b + 2 for b in l[max(0, len(l) - hi): len(l) - lo])
        at[i] = len(text)
        text.append(258 + g)
        text.extend(b + 2 for b in right[i][ro:rhi])
        text.append(1)
    text.append(0)
    t = np.array(text, np.int64)
    best = neighbour_lcp(t, np.array(suffix_array(text), np.int64), 1)
    kept = np.maximum(lcut - lc, 0)
    mask = np.zeros(n, np.uint64)
    shared = rc + best[at] - 1  # bytes after the core that some other string of the group has too
    for k in range(reach + 1):
        need = reach - k
        near = (k <= lc) & (sizes > 1) & (shared >= need)
        out = np.flatnonzero((k > lc) & (k - lc <= kept))
        far = np.zeros(n, bool)
        far[out] = best[at[out] - (k - lc[out])] >= (k - lc[out]) + 1 + np.maximum(0, need - rc[out])
        on = ((many > 1) | near | far) & (k <= lens) & (need <= rens)
        mask |= on.astype(np.uint64) << np.uint64(k)
    return mask


def remove_repeated_bytes(docs: DataFrame, window: int = 400, text_col: str = "text", carry: list[str] | None = None,
                          as_text: bool = False) -> DataFrame:
    """The carried columns of every row, then ``n_bytes, n_removed, n_spans long, kept binary, spans array<struct<start, end>>``.

    A byte goes when a string of ``window`` bytes that covers it starts at any other place of the table, in the
    same text too; texts are never joined, and strings are judged on the input.  Spans are the maximal removed
    runs.  Null texts count as empty, rows that repeat are copies of each other, an empty table gives no rows.
    ``carry`` (all columns but the text) is passed through untouched.  With ``as_text``, ``kept`` is a string without
    the characters that a cut splits.
    """
    reach = min(REACH, window // 2)
    gram = max(1, min(GRAM, window - reach))
    base = blocked(docs, text_col, carry, ("n_bytes", "n_removed", "n_spans", "kept", "spans"))

    def runs(table: pa.Table):
        return anchored(table.column("txt").combine_chunks(), window, reach, gram)

    def send_cores(table: pa.Table) -> pa.Table:
        got = [a.cores() for _, _, a in runs(table)]
        h, many = distinct_counts(np.concatenate(got) if got else np.zeros(0, np.uint64))
        return pa.table({"h": signed(h), "blk": pa.array(np.full(len(h), table.column("blk")[0].as_py(), np.int32)),
                         "n": pa.array(many.astype(np.int32) + 1)})

    def send_strings(table: pa.Table, reply: pa.Table) -> pa.Table:
        cols: list[list] = [[], [], [], [], []]
        matched = np.sort(unsigned(reply.column("h")))
        if table.num_rows and len(matched):
            hs, keys, lefts, rights = [], [], [], []
            for data, _, a in runs(table):
                h = a.cores()
                some = np.flatnonzero(found(h, matched))
                raw = data.tobytes()
                hs.append(h[some])
                keys.append(a.strings(some))
                lefts += [raw[x:y] for x, y in zip(a.lo[some].tolist(), a.m[some].tolist())]
                rights += [raw[x:y] for x, y in zip((a.m[some] + a.core).tolist(), (a.hi[some] + window).tolist())]
            key = np.concatenate(keys)
            _, at, count = np.unique(key, return_index=True, return_counts=True)
            cols = [np.concatenate(hs)[at].view(np.int64), key[at].view(np.int64), [lefts[x] for x in at], [rights[x] for x in at], np.minimum(count, 2)]
        return pa.table({"h": pa.array(cols[0], pa.int64()), "key": pa.array(cols[1], pa.int64()), "before": pa.array(cols[2], pa.binary()),
                         "after": pa.array(cols[3], pa.binary()), "n": pa.array(np.asarray(cols[4], np.int32)),
                         "blk": pa.array(np.full(len(cols[0]), table.column("blk")[0].as_py() if table.num_rows else 0, np.int32))})

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "h", RESOLVED):
            h, key = unsigned(table.column("h")), unsigned(table.column("key"))
            order = np.lexsort((key, h))
            new = np.append(True, (key[order][1:] != key[order][:-1]) | (h[order][1:] != h[order][:-1]))
            head = order[new]
            many = np.add.reduceat(table.column("n").to_numpy()[order], np.flatnonzero(new))
            left, right = table.column("before").take(pa.array(head)).to_pylist(), table.column("after").take(pa.array(head)).to_pylist()
            mask = repeated_starts(h[head], left, right, many, reach)
            every = np.zeros(len(h), np.uint64)
            every[order] = mask[np.cumsum(new) - 1]
            yes = np.flatnonzero(every)
            yield pa.RecordBatch.from_arrays([table.column("blk").take(pa.array(yes)).combine_chunks(), signed(key[yes]), signed(every[yes])],
                                             names=["blk", "key", "mask"])
        give_back()

    def remove(table: pa.Table, reply: pa.Table) -> pa.Table:
        keys, mask = unsigned(reply.column("key")), unsigned(reply.column("mask"))
        order = np.argsort(keys)
        keys, mask = keys[order], mask[order]
        total, removed, spans, kept = [], [], [], []
        out = (lambda b: b.decode("utf-8", "ignore")) if as_text else bytes
        for data, offs, a in runs(table):
            step = np.zeros(len(data) + 1, np.int64)
            if len(keys) and len(a.m):
                mine = a.strings(np.arange(len(a.m)))
                hit = np.flatnonzero(found(mine, keys))
                bits = mask[np.searchsorted(keys, mine[hit])]
                for t in range(reach + 1):
                    p = a.m[hit[(bits >> np.uint64(t)) & np.uint64(1) > 0]] - t
                    np.add.at(step, p, 1)
                    np.add.at(step, p + window, -1)
            gone = np.cumsum(step[:-1]) > 0
            raw = data.tobytes()
            for x, y in zip(offs[:-1].tolist(), offs[1:].tolist()):
                cut = gone[x:y]
                total.append(y - x)
                removed.append(int(cut.sum()))
                if not removed[-1]:
                    spans.append([])
                    kept.append(out(raw[x:y]))
                    continue
                edge = np.flatnonzero(np.diff(np.concatenate([[False], cut, [False]]).astype(np.int8)))
                spans.append([{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2])])
                kept.append(out(data[x:y][~cut].tobytes()))
        return pa.table({"row": loose(table.column("row")), "n_bytes": pa.array(total, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                         "n_spans": pa.array([len(s) for s in spans], pa.int64()), "kept": pa.array(kept, pa.string() if as_text else pa.binary()),
                         "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))})

    matched = (base.groupBy("blk").applyInArrow(send_cores, "h long, blk int, n int")
               .withColumn("n", F.sum("n").over(Window.partitionBy("h"))).where("n > 1").select("blk", "h"))
    strings = base.groupBy("blk").cogroup(matched.groupBy("blk")).applyInArrow(
        send_strings, "h long, key long, before binary, after binary, n int, blk int")
    reply = strings.repartition("h").sortWithinPartitions("h").mapInArrow(resolve, "blk int, key long, mask long")
    kind = base.schema["row"].dataType.simpleString()
    out = base.groupBy("blk").cogroup(reply.groupBy("blk")).applyInArrow(
        remove, f"row {kind}, n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}, spans array<struct<start: long, end: long>>")
    return out.select("row.*", "n_bytes", "n_removed", "n_spans", "kept", "spans")
