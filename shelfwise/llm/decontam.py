"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

A benchmark text of m characters that stands in a document with at most k edits
shares at least m - q + 1 - k * q of its q-grams with that place, and all of
them on diagonals (document place minus benchmark place) within k of one
another.  Shared q-grams are counted in overlapping bands of diagonals; bands
that reach the bound are verified by an alignment that stays inside the band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.blocks import row_struct
from shelfwise.llm.text import give_back, lower_points, slices

#: Benchmark characters that one index may hold; a larger benchmark is searched in several indexes.
INDEX_CHARS = 8_000_000
FILTER_BITS = 21
#: Bands are first counted in so many hashed bins.
COUNT_BITS = 18
#: Bytes of texts that are searched at once.
RUN_BYTES = 256 << 10


_PLAIN: list[np.ndarray] = []


def _plain() -> np.ndarray:
    """Code point -> lower case, white space -> a space."""
    if not _PLAIN:
        out = lower_points().copy()
        out[9:14] = 32
        _PLAIN.append(out)
    return _PLAIN[0]


def normalised(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased characters with white space runs as one space, the rows' offsets, and each one's place in its text."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    heads = np.append(0, np.cumsum((data & 0xC0) != 0x80))[offs]
    points = _plain()[points]
    space = points == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    keep[heads[:-1][heads[:-1] < len(keep)]] = True
    place = np.arange(len(points)) - np.repeat(heads[:-1], np.diff(heads))
    kept = np.append(0, np.cumsum(keep))
    return points[keep], kept[heads], place[keep]


def qgrams(chars: np.ndarray, q: int) -> np.ndarray:
    """A fingerprint of the q characters from each place on; halves are combined, so log2(q) passes make it."""
    if len(chars) < q:
        return np.zeros(0, np.uint64)
    if q == 1:
        return (chars.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    half = q // 2
    left = qgrams(chars, half)
    right = left if q == 2 * half else qgrams(chars, q - half)
    n = len(chars) - q + 1
    out = left[:n] * np.uint64(0xD1342543DE82EF95 + 2 * q)
    out += right[half: half + n]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out


#: Keys of (row, item, band) stay below this; more rows are searched in halves.
MOST_KEYS = 1 << 62


class Index:
    """The q-grams of benchmark texts with their places, the edit budget and the least shared q-grams of each text."""

    def __init__(self, texts: list[str], q: int, per_edit: int):
        self.q = q
        items = []
        for t in texts:
            raw = np.frombuffer(t.encode("utf-8"), np.uint8)
            chars = normalised(raw, np.array([0, len(raw)]))[0]
            ends = np.flatnonzero(chars != 32)
            items.append(chars[ends[0]: ends[-1] + 1] if len(ends) else chars[:0])
        self.items = items
        m = np.array([len(x) for x in items])
        # an edit destroys up to q q-grams; the budget always leaves at least one to count
        self.budget = np.maximum(np.minimum(m // per_edit, (m - q) // q), 0)
        self.least = m - q + 1 - self.budget * q
        grams = [qgrams(x, q) for x in items]
        key = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(items)), [len(g) for g in grams])
        at = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.first = np.unique(key[order], return_index=True)
        self.first = np.append(self.first, len(key))
        self.item, self.at = item[order], at[order]
        # keys are sorted by their leading bits, so those of one slot are neighbours
        slot = (self.keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
        self.seen = np.zeros(1 << FILTER_BITS, bool)
        self.seen[slot] = True
        self.slot = np.searchsorted(slot, np.arange((1 << FILTER_BITS) + 1)).astype(np.int32)
        self.deepest = int(np.diff(self.slot).max(initial=0))
        self.longest = int(m.max(initial=0))
        #: bands overlap by half: any 2 * budget + 1 neighbouring diagonals lie in one of them
        self.half = 2 * self.budget + 1
        self.step = 1.0 / self.half

    def candidates(self, chars: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, item, first diagonal of a band) where a band holds enough shared q-grams; diagonals count from the row's start."""
        none = np.zeros(0, np.int64)
        rows, wide = len(offs) - 1, int(chars.size + 2 * self.longest + 4)
        if rows > 1 and rows * len(self.items) * wide >= MOST_KEYS:  # (row, item, band) would not fit one integer
            half = rows // 2
            parts = [self.candidates(chars[offs[a]: offs[b]], offs[a: b + 1] - offs[a]) for a, b in ((0, half), (half, rows))]
            return tuple(np.concatenate([parts[0][k], parts[1][k] + (half if k == 0 else 0)]) for k in range(3))
        key = qgrams(chars, self.q)
        slot = key >> np.uint64(64 - FILTER_BITS)
        hit = np.flatnonzero(self.seen[slot])
        if not len(hit) or not len(self.keys):
            return none, none, none
        want, slot = key[hit], slot[hit]
        k, last = self.slot[slot], self.slot[slot + np.uint64(1)] - 1
        for _ in range(self.deepest - 1):
            k = np.where((self.keys[k] != want) & (k < last), k + 1, k)
        good = self.keys[k] == want
        row = np.searchsorted(offs, hit, "right") - 1
        good &= hit + self.q <= offs[row + 1]
        hit, k, row = hit[good], k[good], row[good]
        if not len(hit):
            return none, none, none
        count = self.first[k + 1] - self.first[k]
        post = np.arange(int(count.sum()))
        post += np.repeat(self.first[k] - (np.cumsum(count) - count), count)
        item = self.item[post]
        # counted from the row's start and never negative; a band starts at every half width
        diagonal = np.repeat(hit - offs[row] + self.longest, count) - self.at[post]
        band = ((diagonal + 0.5) * self.step[item]).astype(np.int64)
        # rows x items x bands in one integer; a diagonal lies in the band that starts at its half step and in the one before
        one = np.repeat(row * len(self.items), count)
        one += item
        one *= wide
        one += band + 1
        # hashed counts never fall short of a band's own, so bands that stay below the bound are gone before anything is sorted
        small = ((one.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - COUNT_BITS)).astype(np.int64)
        before = (((one - 1).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - COUNT_BITS)).astype(np.int64)
        total = np.bincount(small, minlength=1 << COUNT_BITS) + np.bincount(before, minlength=1 << COUNT_BITS)
        least = self.least[item]
        here, also = total[small] >= least, total[before] >= least
        at = self.at[post]
        # a place of the benchmark text counts once, however often its q-gram stands in the band
        band_of, dense = np.unique(np.concatenate([one[here], one[also] - 1]), return_inverse=True)
        pair = np.unique(dense * (self.longest + 1) + np.concatenate([at[here], at[also]]))  # a band's number, not its key, so it can't wrap
        value, n = np.unique(pair // (self.longest + 1), return_counts=True)
        value = band_of[value]
        rest, band = np.divmod(value, wide)
        band -= 1
        row, item = np.divmod(rest, len(self.items))
        ok = n >= self.least[item]
        row, item, band = row[ok], item[ok], band[ok]
        return row, item, band * self.half[item] - self.longest


def banded(item: np.ndarray, texts: list[np.ndarray], budget: int) -> list[tuple[int, int, int] | None]:
    """For each piece of document: (edits, start, end) of the best place of ``item`` with at most ``budget`` edits.

    Row by row over the item; a cell holds edits and, below them, how late the place starts, so the least edits
    and then the shortest place win.  Cells outside the band of the piece are never made.
    """
    m = len(item)
    wide = max((len(t) for t in texts), default=0)
    band = wide - m + 2 * budget + 1  # cells of a row: document places i - budget .. i - budget + band - 1
    if band < 1 or not texts:
        return [None] * len(texts)
    one = np.int64(1) << 32
    far = one * (m + wide + 2)
    pad = np.full((len(texts), m + band + budget + 1), np.uint32(0xFFFFFFFF), np.uint32)  # column c is document place c - budget
    for r, t in enumerate(texts):
        pad[r, budget: budget + len(t)] = t
    size = np.array([len(t) for t in texts])
    cols = np.arange(band)
    # row 0: nothing of the item is placed; start anywhere in the piece
    at = cols - budget
    cell = np.where((at >= 0)[None, :] & (at[None, :] <= size[:, None]), (wide - at)[None, :].astype(np.int64), far)
    step = cols * one
    live = np.arange(len(texts))
    for i in range(1, m + 1):
        if i % 16 == 0:  # a piece is given up once every cell of a row is over the budget
            good = cell.min(axis=1) >> 32 <= budget
            if not good.all():
                cell, pad, size, live = cell[good], pad[good], size[good], live[good]
                if not len(live):
                    break
        at = cols + i - budget  # document characters consumed in this row's cells
        same = pad[:, i - 1: i - 1 + band] == item[i - 1]
        new = cell + np.where(same, 0, one)
        up = np.full_like(cell, far)
        up[:, :-1] = cell[:, 1:] + one
        new = np.minimum(new, up)
        new = np.where((at >= 0)[None, :] & (at[None, :] <= size[:, None]), new, far)
        new = np.minimum.accumulate(new - step, axis=1) + step
        cell = np.where((at >= 0)[None, :] & (at[None, :] <= size[:, None]), new, far)
    out: list[tuple[int, int, int] | None] = [None] * len(texts)
    for r, c in zip(range(len(live)), cell.argmin(axis=1).tolist()):
        v = int(cell[r, c])
        if v >> 32 <= budget:
            out[int(live[r])] = (v >> 32, wide - (v & 0xFFFFFFFF), c + m - budget)
    return out


def find_passages(docs: DataFrame, benchmark: DataFrame, q: int = 8, per_edit: int = 10, text_col: str = "text", carry: list[str] | None = None,
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The carried columns (all but the text, if None), then ``item, edits int, start_char, end_char long``: a row for each
    document and benchmark text that stands in it.

    Characters are compared in lower case, and white space runs as one space.  A benchmark text of m characters
    may have ``min(m // per_edit, (m - q) // q)`` edits; of several places the one with the fewest edits counts, then the
    first.  Null, empty and shorter benchmark texts than ``q`` characters are no passages; null and empty documents
    hold none.  A benchmark row that repeats counts once; repeated documents have a row each.  Empty tables give no rows.
    """
    base = docs.where(F.octet_length(docs[f"`{text_col}`"].cast("string")) >= q).select(
        docs[f"`{text_col}`"].cast("string").alias("txt"), row_struct(docs, text_col, carry, ("item", "edits", "start_char", "end_char")).alias("row"))
    kind = base.schema["row"].dataType.simpleString()
    items = benchmark.select(benchmark[f"`{item_id}`"].alias("item"), benchmark[f"`{item_text}`"].cast("string").alias("txt"))
    id_kind = items.schema["item"].dataType.simpleString()
    items = items.where(F.char_length("txt") >= q).distinct()
    total = items.agg(F.sum(F.char_length("txt"))).first()[0] or 0
    groups = max(1, -(-int(total) // INDEX_CHARS))
    schema = f"row {kind}, item {id_kind}, edits int, start_char long, end_char long"
    found = None
    for g in range(groups):
        some = items.where(F.pmod(F.xxhash64("txt"), F.lit(groups)) == g).orderBy("item", "txt").collect()  # about INDEX_CHARS at most
        part = base.mapInArrow(_searcher([r["item"] for r in some], [r["txt"] for r in some], q, per_edit, id_kind), schema)
        found = part if found is None else found.unionByName(part)
    return found.select("row.*", "item", "edits", "start_char", "end_char")


def _searcher(names: list, texts: list[str], q: int, per_edit: int, id_kind: str):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        index = Index(texts, q, per_edit)
        for batch in batches:
            waiting: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}  # item -> (row, piece, its places in the text)
            best: dict[tuple[int, int], tuple[int, int, int]] = {}

            def verify(it: int) -> None:
                pieces = waiting.pop(it)
                for (r, _, place), got in zip(pieces, banded(index.items[it], [p for _, p, _ in pieces], int(index.budget[it]))):
                    if got:
                        mine = (got[0], int(place[got[1]]), int(place[got[2] - 1]) + 1)
                        best[r, it] = min(best.get((r, it), mine), mine)

            for i, j, data, offs in slices(batch.column(0), RUN_BYTES):
                chars, offs, place = normalised(data, offs)
                for r, it, low in zip(*(x.tolist() for x in index.candidates(chars, offs))):
                    k, a, b = int(index.budget[it]), int(offs[r]), int(offs[r + 1])
                    lo = min(max(a + low - k, a), b)
                    hi = min(b, a + low + 2 * int(index.half[it]) + len(index.items[it]) + k)
                    if hi > lo:
                        waiting.setdefault(it, []).append((i + r, chars[lo:hi].copy(), place[lo:hi].copy()))
                        if len(waiting[it]) == 64:
                            verify(it)
            for it in list(waiting):
                verify(it)
            if best:
                keys = sorted(best)
                hits = [best[x] for x in keys]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).take(pa.array([r for r, _ in keys], pa.int64())), pa.array([names[t] for _, t in keys]), pa.array([h[0] for h in hits], pa.int32()),
                     pa.array([h[1] for h in hits], pa.int64()), pa.array([h[2] for h in hits], pa.int64())],
                    names=["row", "item", "edits", "start_char", "end_char"])
    return search
