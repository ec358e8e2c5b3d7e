"""Product codes of integer vectors, fitted and assigned exactly by integer Walsh-Hadamard transforms.

A vector is cut into equal parts, and every part position has a small codebook.
Parts and entries are zero-padded to a power of two and transformed; the squared
distance of two parts, times that length, is the sum of the squared differences
of their coefficients.  Coefficients are added in sequency order, the coarse
shape of a part first, so most entries exceed the distance to a promising entry
after a few terms and drop out.  Everything is integer arithmetic: 64 bits where
the values allow it, Python integers beyond.

A round is one map over the vectors with the codebooks in the closure (parts x
entries rows of integers) and a sum over parts, entries and places; nothing that
grows with the vectors reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.blocks import row_struct
from shelfwise.llm.text import loose
from shelfwise.session import ensure_checkpoint_dir

#: Rows whose distances are computed together.
CHUNK = 2048
#: Sums travel in signed limbs of so many bits, so that 64-bit sums over all tasks are exact.
LIMB = 32
#: Label sums up to this many rows are broadcast to the vectors; more are joined by a shuffle.
BROADCAST_LABELS = 100_000


def sequency(n: int) -> np.ndarray:
    """Places of the Hadamard coefficients by rising number of sign changes; n is a power of two."""
    bits = n.bit_length() - 1
    s = np.arange(n)
    gray, out = s ^ (s >> 1), np.zeros(n, np.int64)
    for b in range(bits):
        out |= ((gray >> b) & 1) << (bits - 1 - b)
    return out


def walsh(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of the rows of ``x`` (zero-padded to a power of two), in sequency order."""
    rows, width = x.shape
    n = 1 << max(width - 1, 0).bit_length()
    y = np.zeros((rows, n), x.dtype)
    y[:, :width] = x
    h = 1
    while h < n:
        y = y.reshape(rows, n // (2 * h), 2, h)
        y = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2)
        h *= 2
    return y.reshape(rows, n)[:, sequency(n)]


def nearest(x: np.ndarray, entries: np.ndarray, first: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row (ties to the lower index) and the scaled squared distance; both in coefficients.

    ``first`` coefficients choose a promising entry, whose whole distance is the bound.  A partial sum only grows, so
    an entry beyond the bound can neither win nor tie.
    """
    rows, n = x.shape
    if not rows:
        return np.zeros(0, np.int64), x[:, 0]
    first = min(first, n)
    part = np.zeros((rows, len(entries)), x.dtype)
    for s in range(first):
        d = x[:, s: s + 1] - entries[None, :, s]
        part = part + d * d
    guess = np.argmin(part, axis=1)
    d = x - entries[guess]
    bound = (d * d).sum(axis=1)
    row, entry = np.nonzero(part <= bound[:, None])
    total = part[row, entry]
    for s in range(first, n):
        d = x[row, s] - entries[entry, s]
        total = total + d * d
        stays = total <= bound[row]
        if not stays.all():
            row, entry, total = row[stays], entry[stays], total[stays]
    starts = np.searchsorted(row, np.arange(rows))
    least = np.minimum.reduceat(total, starts)
    winners = np.flatnonzero(total == least[row])
    return entry[winners[np.searchsorted(row[winners], np.arange(rows))]], least


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * value), exactly; ``scale`` is a power of two.  Python integers where 64 bits could overflow."""
    if not len(values) or np.abs(values).max() < 2.0**40:
        return np.floor(values * float(scale)).astype(np.int64)
    out = [int(v) * scale if abs(v) >= 2.0**53 else int(np.floor(v * scale)) for v in values.tolist()]
    return np.array(out, dtype=object)


class Codebooks:
    """Entries of every part position: ``books[part][entry]`` is a list of integers."""

    def __init__(self, books: list[list[list[int]]], width: int):
        self.books, self.width = books, width
        self.n = 1 << max(width - 1, 0).bit_length()
        self.largest = max((abs(v) for b in books for e in b for v in e), default=0)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(v) for b in self.books for e in b for v in e).encode()).hexdigest()

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes (rows, parts) and the squared distances summed over the parts, of integer vectors (rows, parts * width)."""
        parts = len(self.books)
        code = np.zeros((len(x), parts), np.int64)
        error = np.zeros(len(x), x.dtype)
        if not self.width:
            return code, error
        big = max(self.largest, int(np.abs(x).max()) if x.size else 0)
        kind = np.int64 if x.dtype != object and parts * 4 * (self.n * big) ** 2 < 1 << 62 else object
        x, error = x.astype(kind), error.astype(kind)
        tables = [walsh(np.array(b, dtype=kind)) for b in self.books]
        for at in range(0, len(x), CHUNK):
            mine = x[at: at + CHUNK]
            for p in range(parts):
                code[at: at + CHUNK, p], d = nearest(walsh(mine[:, p * self.width: (p + 1) * self.width]), tables[p])
                error[at: at + CHUNK] += d // self.n
        return code, error


def _matrix(col: pa.Array, width: int, scale: int) -> np.ndarray:
    """The vectors of a batch as integer rows, zero-padded on the right to ``width``."""
    size = np.diff(np.asarray(col.offsets))
    vals = integers(np.asarray(col.flatten(), np.float64), scale)
    if len(size) and (size == width).all():
        return vals.reshape(len(size), width)
    out = np.zeros((len(size), width), vals.dtype)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(vals)) - np.repeat(np.cumsum(size) - size, size)] = vals
    return out


def _limbs(v: int) -> list[int]:
    sign, v, out = (-1 if v < 0 else 1), abs(v), []
    while v:
        out.append(sign * (v & ((1 << LIMB) - 1)))
        v >>= LIMB
    return out


def usable(vec: Column) -> Column:
    """True for vectors that are not null and hold neither nulls nor values that are not finite."""
    bad = F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(True))


def encode(vectors: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id", label_col: str | None = "label", parts: int = 8,
           entries: int = 16, rounds: int = 6, scale: int = 4096, carry: list[str] | None = None) -> tuple[DataFrame, Codebooks]:
    """Codes of all vectors, and the codebooks.

    The rows are the carried columns (all but the vector, if None) with ``code string`` (two hex digits a part),
    ``error long`` and, with a label column, ``label_error long`` (the errors of equal labels, nulls together).
    Components become floor(scale * x), x as double.  The codebooks start from the rows with the smallest ids (null ids
    last, equal ids by rising vector; fewer rows than ``entries`` make fewer entries), and each of ``rounds`` rounds puts
    floor(sum / count) of an entry's parts in its place; an entry without parts stays.  Rows whose vector is null or holds
    null or non-finite components are dropped.  Shorter vectors count as zero-padded on the right to the longest, whose
    length is filled up by zeros to a multiple of ``parts``.  Repeated rows come out once each.  An empty table gives no
    rows.  An error or sum that no long can hold raises.
    """
    if not 1 <= entries <= 256 or parts < 1 or scale < 1 or scale & (scale - 1):
        raise ValueError("1 to 256 entries, at least one part and a scale that is a power of two are needed")
    ensure_checkpoint_dir(vectors.sparkSession)
    results = ("code", "error", "label_error")
    label = vectors[f"`{label_col}`"] if label_col else F.lit(None).cast("int")
    vec = vectors[f"`{vec_col}`"].cast("array<double>")
    base = vectors.select(vec.alias("vec"), vectors[f"`{id_col}`"].alias("id"), label.alias("lab"), row_struct(vectors, vec_col, carry, results).alias("row"))
    base = base.where(usable(F.col("vec")))
    longest = base.agg(F.max(F.size("vec"))).first()[0] or 0
    width = -(-longest // parts)
    seeds = base.select("id", "vec").orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).collect()
    start = [integers(np.array(r["vec"] + [0.0] * (parts * width - len(r["vec"]))), scale).tolist() for r in seeds]
    books = Codebooks([[e[p * width: (p + 1) * width] for e in start] for p in range(parts)], width)

    for _ in range(rounds if seeds and width else 0):
        books = _next_round(base, books, scale)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, error = books.assign(_matrix(batch.column(0), parts * width, scale))
            hexed = [bytes(c).hex() for c in code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column(1), loose(batch.column(2)), pa.array(hexed, pa.string()), pa.array(error.tolist(), pa.int64())],
                                             names=["lab", "row", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in base.schema.fields}
    out = base.select("vec", "lab", "row").mapInArrow(codes, f"lab {kinds['lab']}, row {kinds['row']}, code string, error long")
    if not label_col:
        return out.select("row.*", "code", "error"), books
    out = out.checkpoint()
    sums = out.groupBy("lab").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error")).withColumnRenamed("lab", "of").checkpoint()
    if sums.count() <= BROADCAST_LABELS:
        sums = F.broadcast(sums)
    out = out.join(sums, out["lab"].eqNullSafe(sums["of"]))
    return out.select("row.*", "code", "error", "label_error"), books


def _next_round(base: DataFrame, books: Codebooks, scale: int) -> Codebooks:
    """The codebooks after one assignment of all parts."""
    parts, width = len(books.books), books.width
    count_at = width  # the place after the components counts the parts

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, len(books.books[0]), width + 1), object)
        for batch in batches:
            x = _matrix(batch.column(0), parts * width, scale)
            code, _ = books.assign(x)
            for p in range(parts):
                mine = x[:, p * width: (p + 1) * width]
                for e in np.unique(code[:, p]):
                    at = code[:, p] == e
                    # two halves, so that a batch's 64-bit sums can't overflow
                    high, low = (mine[at] >> 20), (mine[at] & ((1 << 20) - 1))
                    total[p, e, :width] += high.sum(axis=0).astype(object) * (1 << 20) + low.sum(axis=0).astype(object)
                    total[p, e, count_at] += int(at.sum())
        rows = [(p, e, i, k, limb) for p, e, i in np.ndindex(total.shape) for k, limb in enumerate(_limbs(int(total[p, e, i])))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(),) * 4 + (pa.int64(),))],
                                             names=["part", "entry", "place", "limb", "value"])

    found = base.select("vec").mapInArrow(sums, "part int, entry int, place int, limb int, value long")
    total: dict[tuple[int, int, int], int] = {}
    for r in found.groupBy("part", "entry", "place", "limb").agg(F.sum("value").alias("value")).collect():  # at most parts x entries x places x limbs
        key = (r["part"], r["entry"], r["place"])
        total[key] = total.get(key, 0) + (r["value"] << (LIMB * r["limb"]))
    new = [[[total.get((p, e, i), 0) // n for i in range(width)] if (n := total.get((p, e, count_at), 0)) else old
            for e, old in enumerate(book)] for p, book in enumerate(books.books)]
    return Codebooks(new, width)


def decode(code: str, books: Codebooks, scale: int = 4096) -> list[Decimal]:
    """The vector that a code stands for."""
    raw = bytes.fromhex(code)
    return [Decimal(v) / scale for p, e in enumerate(raw) for v in books.books[p][e]]
