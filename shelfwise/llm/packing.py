"""Packing by power-of-two decomposition.

Every document is cut into pieces whose lengths are powers of two: as many of
``seq_len`` as fit, then the binary digits of the rest, longest first.  A piece
is a sequence of its own, so no sequence crosses documents and none is padded;
``bucket`` (the exponent) groups sequences of equal length for batching.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.text import give_back, slices, word_hashes, word_spans

#: Words, and parts of words, of one generation of the caches of a Python worker; the generation before is kept as well.
CACHE_WORDS, CACHE_PIECES = 200_000, 500_000
SMALL_CACHES = (60_000, 150_000)
#: Bytes of texts whose ids are made at once, with all caches and with the small ones.
RUN_BYTES, SMALL_RUN_BYTES = 8 << 20, 256 << 10
#: Words of printable ASCII without apostrophes and of the letters of Latin-1, and, in lower case, their pre-tokens.
SIMPLE = re.compile(rb"(?:[!-&(-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
PIECES = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+|[0-9]|[^a-z0-9\x80-\xff]+")


class Generations:
    """A cache that forgets what was not asked for since the last change of generations."""

    def __init__(self, most: int):
        self.most, self.now, self.before = most, {}, {}

    def missing(self, keys) -> list[bytes]:
        """The keys that have to be worked out; what the last generation knows is taken over."""
        if len(self.now) > self.most:
            self.now, self.before = {}, self.now
        now, before = self.now, self.before
        new = [k for k in keys if k not in now]
        again = {k: v for k in new if (v := before.get(k)) is not None}
        now.update(again)
        return [k for k in new if k not in again]

    def clear(self) -> None:
        self.now, self.before = {}, {}


class WordEncoder:
    """Token ids of whole texts through a cache of words.

    The tokenizer's pre-tokens never cross white space, so the ids of a text are the ids of its words in order.
    SIMPLE words are cut into PIECES, which recur more often than words; pieces of ASCII go straight to the tokenizer's
    model, which spares them its normaliser and patterns.  That holds for a tokenizer that gives the same ids for a
    list of probes; other words, words with added tokens, and all words of other tokenizers take the tokenizer's own way.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS, cache_pieces: int = CACHE_PIECES):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.words, self.pieces = Generations(cache_words), Generations(cache_pieces)
        added = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.added = re.compile(b"|".join(map(re.escape, added)), re.IGNORECASE) if added else re.compile(rb"(?!)")
        self.simple = True
        self.simple = self._agrees()
        self.forget()

    def _agrees(self) -> bool:
        marks = [chr(c) for c in range(33, 127) if chr(c) != "'"]
        letters = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
        probes = [f"{a}{b}{m}{a}{m}{m}{b}7{m}12{m}" for m in marks for a, b in (("a", "Zq"), ("The", "s"), ("T", "re"), ("\xe9", "\xc9t"))]
        probes += [x + y for x in marks for y in marks] + marks + [a + c + b for c in letters for a, b in (("", ""), ("e", "n"), ("1", "!"))] + ["the", "THE", "o0o", "1234"]
        try:
            got = self.learn([w.encode() for w in probes])
        except Exception:  # no such model, or a piece that the model alone can't take
            return False
        return all(got[w.encode()] == p for w, p in zip(probes, self._plain(probes)))

    def _plain(self, texts: list[str]) -> list[bytes]:
        encode = getattr(self.tok, "encode_batch_fast", self.tok.encode_batch)
        return [np.array(e.ids, "<u4").tobytes() for e in encode(texts, add_special_tokens=False)]

    def learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        fits, holds_added, cut = SIMPLE.fullmatch, self.added.search, PIECES.findall
        simple = [w for w in words if fits(w) and not holds_added(w)] if self.simple else []
        parts: set[bytes] = set()
        for w in simple:
            parts.update(cut(w.lower()))
        new = self.pieces.missing(parts)
        known, model = self.pieces.now, self.tok.model.tokenize
        for p in new:
            if p.isascii():
                known[p] = b"".join([t.id.to_bytes(4, "little") for t in model(p.decode())])
        wide = [p for p in new if not p.isascii()]
        known.update(zip(wide, self._plain([p.decode() for p in wide])))
        of = known.__getitem__
        out = {w: b"".join(map(of, cut(w.lower()))) for w in simple}
        rest = [w for w in words if w not in out]
        out.update(zip(rest, self._plain([w.decode("utf-8") for w in rest])))
        return out

    def lookup(self, words: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of distinct words."""
        new = self.words.missing(words)
        known = self.words.now
        known.update(self.learn(new))
        return [known[w] for w in words]

    def ids(self, data: np.ndarray, offs: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a run of rows, each followed by ``end_id``, and the rows' offsets among them.

        Only the distinct words of the run, told apart by 64-bit fingerprints, are looked up.
        """
        rows = len(offs) - 1
        starts, ends, first = word_spans(data, offs)
        _, at, which = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        raw = data.tobytes()
        found = self.lookup([raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        table = np.frombuffer(b"".join(found), "<u4")
        n = size[which]
        upto = np.append(0, np.cumsum(n))
        offsets = upto[first] + np.arange(rows + 1)
        source = np.repeat((np.cumsum(size) - size)[which] - upto[:-1], n) + np.arange(upto[-1])
        out = np.empty(int(offsets[-1]), "<u4")
        out[np.arange(upto[-1]) + np.repeat(np.arange(rows), np.diff(upto[first]))] = table[source]
        out[offsets[1:] - 1] = end_id
        return out, offsets

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        offs = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
        out, edge = self.ids(np.frombuffer(b"".join(texts), np.uint8), offs, 0)
        return [out[a: b - 1].tobytes() for a, b in zip(edge[:-1], edge[1:])]

    def forget(self) -> None:
        self.words.clear()
        self.pieces.clear()


_ENCODERS: dict[tuple, WordEncoder] = {}


def encoder(path: str, *sizes: int) -> WordEncoder:
    if (path, *sizes) not in _ENCODERS:
        _ENCODERS[path, *sizes] = WordEncoder(path, *sizes)
    return _ENCODERS[path, *sizes]


def cut(n: int, seq_len: int) -> list[int]:
    """Piece lengths of a document of n tokens."""
    top = seq_len.bit_length() - 1
    return [seq_len] * (n >> top) + [1 << b for b in range(top - 1, -1, -1) if n >> b & 1]


def packer(tokenizer_path: str, seq_len: int, end_id: int, with_ids: bool, keep_words: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The work of a task of ``power_of_two_pieces`` on batches of key and text."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keep_words:
            give_back()
        enc = encoder(tokenizer_path, *(() if keep_words else SMALL_CACHES))
        for batch in batches:
            keys = batch.column(0)
            for i, j, data, offs in slices(batch.column(1), RUN_BYTES if keep_words else SMALL_RUN_BYTES):
                row, start, length, crc, total, ids = [], [], [], [], [], []
                every, edge = enc.ids(data, offs, end_id)
                every, edge = every.tobytes(), edge.tolist()
                for r in range(j - i):
                    n, at = edge[r + 1] - edge[r], 0
                    for size in cut(n, seq_len):
                        piece = every[4 * (edge[r] + at): 4 * (edge[r] + at + size)]
                        row.append(i + r)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(piece))
                        total.append(n)
                        if with_ids:
                            ids.append(np.frombuffer(piece, "<u4").astype(np.int32))
                        at += size
                cols = [keys.take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()), pa.array(total, pa.int64())]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    cols.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)
        if not keep_words:
            enc.forget()
            give_back()

    return pack


def power_of_two_pieces(docs: DataFrame, tokenizer_path: str, seq_len: int = 2048, end_id: int = 1, id_col: str = "doc_id",
                        text_col: str = "text", with_ids: bool = False, keep_words: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket`` (and ``ids``).

    A null or empty text is the end id alone.  Rows that repeat are packed once each; null ids stay null.
    An empty table gives no rows.  Other columns of ``docs`` are not read.  One map over the scan: nothing is shuffled.
    ``keep_words`` leaves the word cache in the Python worker for its next task; without, a task works with small caches
    and gives its memory back, for a worker that other stages have filled.
    """
    if seq_len < 1 or seq_len & (seq_len - 1):
        raise ValueError("seq_len must be a power of two")

    pack = packer(tokenizer_path, seq_len, end_id, with_ids, keep_words)
    key = docs.select(docs[f"`{id_col}`"].alias("doc_id"), docs[f"`{text_col}`"].cast("string").alias("txt"))
    kind = key.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    out = key.mapInArrow(pack, schema)
    return out.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long")).withColumn(
        "bucket", F.round(F.log2("length")).cast("int"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write the sequences with one folder per length."""
    pieces.write.partitionBy("bucket").parquet(path)
