"""Exact removal of repeated word windows by difference-cover anchors.

Positions p of a document with p mod v in a difference cover D are anchors.
For any two equal windows there is one shift under v at which both have an
anchor, so hashing the ``window - v + 1`` words at anchors alone finds every
pair.  Each anchor that occurs twice is then extended: the full windows around
it are hashed and counted, and the words of the windows that occur twice go.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.blocks import blocked
from shelfwise.llm.text import Rolling, distinct_counts, found, loose, signed, slices, unsigned, word_hashes, word_spans

#: Difference covers (period, members); every difference modulo the period occurs among the members.
COVERS = ((21, (0, 1, 4, 14, 16)), (13, (0, 1, 3, 9)), (7, (0, 1, 3)), (3, (0, 1)), (1, (0,)))


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The longest period that leaves at least two fifths of the window to an anchor."""
    return next(c for c in COVERS if c[0] == 1 or 5 * (window - c[0] + 1) >= 2 * window)


class _Block:
    """Words of a run of rows, their fingerprints, and the starts of whole windows."""

    def __init__(self, data, offs, window: int, period: int, cover: tuple[int, ...]):
        self.starts, self.ends, self.first = word_spans(data, offs)
        self.roll = Rolling(word_hashes(data, self.starts, self.ends))
        n = len(self.starts)
        count = np.diff(self.first)
        place = np.arange(n) - np.repeat(self.first[:-1], count)
        left = np.repeat(self.first[1:], count) - np.arange(n)
        size = window - period + 1
        self.whole = left >= window
        self.at = np.flatnonzero((left >= size) & np.isin(place % period, cover))
        self.anchors = self.roll.windows(self.at, size)

    def candidates(self, matched: np.ndarray, window: int, period: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of windows that hold a matched anchor within the first ``period`` places, and their fingerprints."""
        hit = np.zeros(len(self.starts) + period, np.int64)
        hit[self.at[found(self.anchors, matched)]] = 1
        seen = np.append(0, np.cumsum(hit))
        near = seen[period: period + len(self.starts)] - seen[: len(self.starts)]
        at = np.flatnonzero((near > 0) & self.whole)
        return at, self.roll.windows(at, window)


def _sent(h: list[np.ndarray], blk: int) -> pa.Table:
    values, many = distinct_counts(np.concatenate(h) if h else np.zeros(0, np.uint64))
    return pa.table({"h": signed(values), "blk": pa.array(np.full(len(values), blk, np.int32)), "n": pa.array(many.astype(np.int32) + 1)})


def remove_repeated_windows(docs: DataFrame, window: int = 35, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns of every row, then ``n_words, n_removed long, kept_text string``.

    A word goes when a window of ``window`` words that covers it occurs anywhere else, in the same document
    too; windows are judged on the input.  Kept words are joined by one space.  Null and empty texts have no
    words and keep the empty text; rows that repeat are documents of their own, so each is a copy of the
    other; an empty table gives no rows.  ``carry`` (all columns but the text) is passed through untouched.
    """
    period, cover = cover_for(window)
    base = blocked(docs, text_col, carry, ("n_words", "n_removed", "kept_text"))

    def runs(table: pa.Table):
        for i, j, data, offs in slices(table.column("txt").combine_chunks()):
            yield i, data, offs, _Block(data, offs, window, period, cover)

    def send_anchors(table: pa.Table) -> pa.Table:
        blk = table.column("blk")[0].as_py()
        return _sent([b.anchors for _, _, _, b in runs(table)], blk)

    def send_windows(table: pa.Table, reply: pa.Table) -> pa.Table:
        if not table.num_rows or not reply.num_rows:
            return _sent([], 0)
        matched = np.sort(unsigned(reply.column("h")))
        return _sent([b.candidates(matched, window, period)[1] for _, _, _, b in runs(table)], table.column("blk")[0].as_py())

    row_type = base.schema["row"].dataType

    def remove(table: pa.Table, reply: pa.Table) -> pa.Table:
        h, once = unsigned(reply.column("h")), np.asarray(reply.column("once"), bool)
        matched, alone = np.sort(h[~once]), np.sort(h[once])
        words, removed, kept = [], [], []
        for _, data, offs, b in runs(table):
            at, wh = b.candidates(matched, window, period)
            at = at[~found(wh, alone)]
            step = np.zeros(len(b.starts) + 1, np.int64)
            np.add.at(step, at, 1)
            np.add.at(step, at + window, -1)
            keep = np.cumsum(step[:-1]) == 0
            raw = data.tobytes()
            for k in range(len(offs) - 1):
                ws = raw[offs[k]: offs[k + 1]].split()
                mine = keep[b.first[k]: b.first[k + 1]]
                words.append(len(ws))
                removed.append(int(len(ws) - mine.sum()))
                kept.append(b" ".join(ws if mine.all() else [ws[x] for x in np.flatnonzero(mine)]).decode("utf-8"))
        return pa.table({"row": loose(table.column("row")), "n_words": pa.array(words, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                         "kept_text": pa.array(kept, pa.string())})

    sent = "h long, blk int, n int"
    everywhere = Window.partitionBy("h")
    matched = (base.groupBy("blk").applyInArrow(send_anchors, sent)
               .withColumn("n", F.sum("n").over(everywhere)).where("n > 1").select("blk", "h"))
    alone = (base.groupBy("blk").cogroup(matched.groupBy("blk")).applyInArrow(send_windows, sent)
             .withColumn("n", F.sum("n").over(everywhere)).where("n = 1").select("blk", "h"))
    reply = matched.withColumn("once", F.lit(False)).unionByName(alone.withColumn("once", F.lit(True)))
    out = base.groupBy("blk").cogroup(reply.groupBy("blk")).applyInArrow(
        remove, f"row {row_type.simpleString()}, n_words long, n_removed long, kept_text string")
    return out.select("row.*", "n_words", "n_removed", "kept_text")
