"""Document log-likelihood under a gated recurrent language model, written in numpy.

Counts of all training words are gathered on Spark.  The most frequent words
form a shortlist whose words are binned into classes of about equal
root-frequency; every other word belongs to a class by its last two characters.
The output is factored: the state gives the class and, within a shortlist class,
the word; within the other classes a word has its smoothed share of the class's
counts over the whole corpus.  The recurrent part starts from the corpus counts,
that is, from the unigram model, and learns from all training rows on Spark: in
each of a few rounds every task runs truncated backpropagation over its whole
texts of that round, from the broadcast weights, and a tree of weighted means
makes the weights of the next round.  Training and scoring carry the state across
windows, so a document of any length is learned and scored in full.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.blocks import blocked, row_struct
from shelfwise.llm.text import LOWER, give_back, loose, mix, slices, word_hashes, word_spans
from shelfwise.session import ensure_checkpoint_dir

#: The end of a document; no word holds a space.
END = " "
#: Words whose counts every task holds; the counts of others come by a join.
TOP_WORDS = 131_072
SHORTLIST = 2000
SHORT_CLASSES = 32
SUFFIX_CLASSES = 40
STATE = 20
#: States, a one for the bias and zeros: products of such rows take whole vector registers.
PADDED = -(-(STATE + 1) // 8) * 8
#: Training: texts side by side and tokens of a window; the learning rates of the rounds, each with its share of the rows.
STREAMS, STEPS = 256, 20
RATES = (0.02, 0.015, 0.008, 0.003)
#: A task learns from at least about so many tokens, so that the means are taken over tasks that have learned something.
TASK_TOKENS = 2_000_000
#: Rows and numbers of the logits made at once, and parameters of a step of Adam, so that they stay in a core's cache.
HEAD_ROWS, HEAD_CELLS, ADAM_CELLS = 2048, 131_072, 16_384
#: The rows of an input that stands more often in a window are summed as one run, the others place by place.
LONG = 32
#: Weights travel in pieces of so many numbers, and so many tasks' pieces meet in one mean.
PIECE, FAN = 16_384, 32
#: Bytes of a run of texts whose words are fingerprinted at once.
RUN_BYTES = 256 << 10
#: Large blocks keep many documents in step, so a few long ones cost little.
BLOCK_BYTES = 6 << 20
#: A window of scoring has at most so many places, and tokens unless one place has more.
WINDOW, WINDOW_TOKENS = 1024, 40_000


def words(text: bytes) -> list[bytes]:
    return text.lower().split()  # both of ASCII letters and white space only


def _strings(some: list[bytes]) -> pa.Array:
    out = pa.array(some, pa.binary())
    try:
        return out.cast(pa.string())
    except pa.ArrowInvalid:  # bytes that are no text
        return pa.array([w.decode("utf-8", "replace") for w in some], pa.string())


def word_counts(texts: DataFrame, flush: int = 300_000) -> DataFrame:
    """``w string, c long`` of one text column's words and ends (one per row)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            return pa.RecordBatch.from_arrays([_strings(list(seen)), pa.array(list(seen.values()), pa.int64())], names=["w", "c"])

        seen: Counter[bytes] = Counter()
        for batch in batches:
            for i, j, data, offs in slices(batch.column(0), RUN_BYTES):
                raw = data.tobytes()
                for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
                    seen.update(words(raw[a:b]))
                seen[END.encode()] += j - i
                if len(seen) > flush:
                    yield out()
                    seen = Counter()
        if seen:
            yield out()
        seen = Counter()
        give_back()

    return texts.mapInArrow(count, "w string, c long").groupBy("w").agg(F.sum("c").alias("c"))


def suffix(w: str) -> str:
    return w[-2:]


@dataclass
class Vocabulary:
    """What every task knows of the words: the frequent ones and the totals of each class."""

    words: list[str]  # by falling count, then by word
    counts: np.ndarray
    tokens: int  # N
    types: int  # V
    suffixes: list[str]
    mass: np.ndarray  # tokens of each suffix class that are not in the shortlist; the last class has all other suffixes
    kinds: np.ndarray  # and their distinct words

    def __post_init__(self):
        self.short = min(SHORTLIST, len(self.words))
        root = np.sqrt(self.counts[: self.short].astype(float))
        share = (np.cumsum(root) - root / 2) / max(root.sum(), 1e-9)
        self.short_class = np.unique(np.minimum((share * SHORT_CLASSES).astype(int), SHORT_CLASSES - 1), return_inverse=True)[1] if self.short else np.zeros(0, int)
        self.n_short = int(self.short_class.max()) + 1 if self.short else 0
        self.n_class = self.n_short + len(self.suffixes) + 1
        self.by_suffix = {s: self.n_short + i for i, s in enumerate(self.suffixes)}
        self.first = np.searchsorted(self.short_class, np.arange(self.n_short + 1))

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.tokens + 0.1 * (self.types + 1)))

    def tables(self, ws: list[str], c: np.ndarray, start: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For words that take the places from ``start`` on: input, class, log-probability in the class (0 for the shortlist), base."""
        return self.tables_of(np.array([self.by_suffix.get(suffix(w), self.n_class - 1) for w in ws], np.int64), c, start)

    def tables_of(self, cls: np.ndarray, c: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same for words whose suffix classes are known; they may change."""
        place = np.arange(start, start + len(cls))
        short = place < self.short
        cls[short] = self.short_class[place[short]]
        r = np.maximum(cls - self.n_short, 0)
        inside = np.where(short, 0.0, np.log((c + 0.1) / (self.mass[r] + 0.1 * (self.kinds[r] + 1))))
        return np.where(short, place, self.short + r).astype(np.int32), cls.astype(np.int32), inside.astype(np.float32), self.base(c)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """At most TOP_WORDS words and SUFFIX_CLASSES suffixes reach the driver."""
    tokens, types = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    # the least count that at most TOP_WORDS words reach, from a histogram of some hundred bins
    scale = F.floor(F.log2("c") * 16)
    bins = sorted(counts.groupBy(scale.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
    taken = np.cumsum([r["n"] for r in bins])
    fit = [r["b"] for r, n in zip(bins, taken) if n <= TOP_WORDS]
    top = sorted(counts.where(scale >= fit[-1]).collect(), key=lambda r: (-r["c"], r["w"])) if fit else []
    ends = counts.groupBy(F.substring("w", -2, 2).alias("s")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n"))
    most = ends.orderBy(F.desc("c"), "s").limit(SUFFIX_CLASSES).collect()
    names = [r["s"] for r in most]
    mass = np.array([r["c"] for r in most] + [int(tokens or 0) - sum(r["c"] for r in most)], float)
    kinds = np.array([r["n"] for r in most] + [int(types) - sum(r["n"] for r in most)], float)
    at = {s: i for i, s in enumerate(names)}
    for r in top[:SHORTLIST]:
        i = at.get(suffix(r["w"]), len(names))
        mass[i] -= r["c"]
        kinds[i] -= 1
    return Vocabulary([r["w"] for r in top], np.array([r["c"] for r in top], float), int(tokens or 0), int(types), names, mass, kinds)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """Of the values whose negatives are given, in place."""
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class _Streams:
    """What streams read of the texts that are dealt to them, whole and one after the other; a text's first token is its complement.

    What a stream has not yet read lies in one place of a pool, which is packed anew when it is full.
    """

    def __init__(self, docs: Iterable[np.ndarray], streams: int):
        self.docs, self.more = iter(docs), True
        self.pool, self.used = np.zeros(1, np.int32), 0
        self.at, self.left = np.zeros((2, streams), np.int64)

    def keep(self, some: np.ndarray) -> None:
        self.at, self.left = self.at[some], self.left[some]

    def window(self, wide: int) -> tuple[np.ndarray, np.ndarray]:
        """The next tokens, places by streams, and how many of them each stream has."""
        for i in np.flatnonzero(self.left < wide).tolist():
            if not self.more:
                break
            n = int(self.left[i])
            parts = [self.pool[self.at[i]: self.at[i] + n]]
            while n < wide:
                if (doc := next(self.docs, None)) is None:
                    self.more = False
                    break
                if len(doc):
                    parts += [~doc[:1], doc[1:]]
                    n += len(doc)
            self._put(i, parts, n)
        size = np.minimum(self.left, wide)
        places = np.arange(wide)[:, None]
        ids = self.pool.take(self.at + places, mode="clip").astype(np.int64)
        if size.min(initial=wide) < wide:
            ids[places >= size] = 0
        self.at, self.left = self.at + size, self.left - size
        return ids, size

    def _put(self, i: int, parts: list[np.ndarray], n: int) -> None:
        self.left[i] = 0
        if self.used + n > len(self.pool):
            live = int(self.left.sum()) + n
            pool, self.used = np.empty(live + max(live // 4, 1 << 16), np.int32), 0
            for j in np.flatnonzero(self.left).tolist():
                a, m = int(self.at[j]), int(self.left[j])
                pool[self.used: self.used + m] = self.pool[a: a + m]
                self.at[j] = self.used
                self.used += m
            self.pool = pool
        self.at[i], self.left[i] = self.used, n
        np.concatenate(parts, out=self.pool[self.used: self.used + n], casting="same_kind")
        self.used += n


def _by_place(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """An order of rows by id for ``_sums``, the lengths of its runs and of its levels, and the id of each sum.

    Ids that stand more than LONG times make a run each; of the others come all first rows, then all second ones, and so on.
    """
    order = np.argsort(ids.astype(np.uint16), kind="stable")
    ranked = ids[order]
    head = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    size = np.diff(np.append(head, len(ids)))
    by = np.argsort(-size, kind="stable")
    head, size = head[by], size[by]
    few = int(np.searchsorted(-size, -LONG, "left"))
    runs, short = size[:few], size[few:]
    levels = np.searchsorted(-short, -np.arange(int(short.max(initial=0))), "left")  # ids that have a row at each level
    level = np.repeat(np.arange(len(levels)), levels)
    lone = np.arange(len(level)) - np.repeat(np.cumsum(levels) - levels, levels)
    at = np.concatenate([np.repeat(head[:few] - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum()), head[few:][lone] + level])
    return order[at], runs, levels, ranked[head]


def _sums(rows: np.ndarray, runs: np.ndarray, levels: np.ndarray, n: int) -> np.ndarray:
    """The n sums over ids of rows in the order of ``_by_place``."""
    out, at = np.zeros((n, rows.shape[1]), rows.dtype), 0
    for i, m in enumerate(runs.tolist()):
        np.add.reduce(rows[at: at + m], axis=0, out=out[i])
        at += m
    rest = out[len(runs):]
    for m in levels.tolist():
        rest[:m] += rows[at: at + m]
        at += m
    return out


class Network:
    """Gated recurrent units with a class-factored output; all parameters are float32 arrays."""

    def __init__(self, v: Vocabulary, seed: int = 5):
        rng = np.random.default_rng(seed)
        n_in, s = v.short + len(v.suffixes) + 1, STATE
        self.v = v
        class_mass = np.append(np.array([v.counts[a:b].sum() for a, b in zip(v.first[:-1], v.first[1:])]), v.mass + 0.1 * (v.kinds + 1))
        self.p = {
            "gates": rng.normal(0, 0.3, (n_in, 3 * s)), "u": rng.normal(0, 1 / math.sqrt(s), (s, 3 * s)),
            "cls": rng.normal(0, 0.05, (s, v.n_class)), "cls_b": np.log(np.maximum(class_mass, 0.1) / max(class_mass.sum(), 1)),
            "out": rng.normal(0, 0.05, (max(v.short, 1), s)), "out_b": np.log(np.maximum(v.counts[: v.short], 1) / max(v.tokens, 1)) if v.short else np.zeros(1),
        }
        self.p = {k: x.astype(np.float32) for k, x in self.p.items()}

    def gates(self) -> tuple[np.ndarray, np.ndarray]:
        """The weights of update, reset and candidate one after the other, each contiguous; the first two negated for the sigmoid."""
        both = tuple(np.ascontiguousarray(self.p[k].reshape(-1, 3, STATE).swapaxes(0, 1)) for k in ("gates", "u"))
        for w in both:
            np.negative(w[:2], out=w[:2])
        return both

    def heads(self) -> tuple[np.ndarray, np.ndarray, bool]:
        """Class and word weights with the bias as a state more and zeros behind, and whether a logit can leave +-60, where float32 overflows or vanishes."""
        s, p = STATE, self.p
        top, low = np.zeros((PADDED, p["cls"].shape[1]), p["cls"].dtype), np.zeros((len(p["out"]), PADDED), p["out"].dtype)
        top[:s], top[s], low[:, :s], low[:, s] = p["cls"], p["cls_b"], p["out"], p["out_b"]
        most = np.ones(PADDED, top.dtype)  # a state lies within +-1
        return top, low, max((most @ np.abs(top)).max(), (np.abs(low) @ most).max()) > 60

    def step(self, ids: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states of streams that read ``ids``, and the values of update, reset and candidate."""
        inputs, u = self.gates()
        x = inputs.take(ids, axis=1)
        return self._advance(x, h, u), x

    @staticmethod
    def _advance(x: np.ndarray, h: np.ndarray, u: np.ndarray, hu: np.ndarray | None = None) -> np.ndarray:
        """The next states; ``x`` (inputs of update, reset and candidate, see ``gates``) becomes the gates' values, ``hu`` what the states add."""
        hu = np.matmul(h, u, out=hu)
        zr = x[:2]
        zr += hu[:2]
        _sigmoid(zr)
        n = x[2]
        n += zr[1] * hu[2]
        np.tanh(n, out=n)
        new = h - n
        new *= zr[0]
        new += n
        return new

    def log_probs(self, h: np.ndarray, ids: np.ndarray, cls: np.ndarray, grads: dict | None = None, heads: tuple | None = None):
        """Natural log-probability of classes and shortlist words in given states; with ``grads``, what flows back instead.

        The words of a class are as wide as the class has words, so the logits of several classes lie one after the other.
        """
        top, low, clip = heads or self.heads()
        s, n = STATE, len(h)
        hb = np.zeros((n, PADDED), h.dtype)
        hb[:, :s], hb[:, s] = h, 1
        out = np.zeros(n, h.dtype) if grads is None else None
        back = None if grads is None else np.empty((n, s), h.dtype)

        def exponents(z, k):
            """Powers of all logits, in place, and the logits at k, where they are asked for."""
            if clip:
                np.clip(z, -60, 60, out=z)
            at = z.take(k) if grads is None else None
            return np.exp(z, out=z), at

        wide, ones = top.shape[1], np.ones(top.shape[1], h.dtype)
        z = np.empty((min(n, HEAD_ROWS), wide), h.dtype)
        steps = np.arange(len(z)) * wide
        for lo in range(0, n, HEAD_ROWS):
            x = hb[lo: lo + HEAD_ROWS]
            m = len(x)
            k = steps[:m] + cls[lo: lo + m]
            e = np.matmul(x, top, out=z[:m])
            flat, at = exponents(e.reshape(-1), k)
            total = e @ ones
            if grads is None:
                out[lo: lo + m] = at - np.log(total)
                continue
            flat[k] -= total
            inv = 1 / total[:, None]
            np.multiply(np.matmul(e, top[:s].T), inv, out=back[lo: lo + m])
            weights = (x * inv).T @ e
            grads["cls"] += weights[:s]
            grads["cls_b"] += weights[s]
        order = np.argsort(cls.astype(np.uint16), kind="stable")
        edges = np.searchsorted(cls[order], np.arange(self.v.n_short + 1))
        order = order[: edges[-1]]
        hs, places = hb.take(order, axis=0), ids[order]
        width, rows = np.diff(self.v.first), np.diff(edges)
        cells = np.append(0, np.cumsum(rows * width))
        inside = np.empty(len(order), h.dtype) if grads is None else np.empty((len(order), s), h.dtype)
        c = 0
        while c < len(rows):  # some classes, or one large one
            d = max(c + 1, int(np.searchsorted(cells, cells[c] + HEAD_CELLS, "right")) - 1)
            lo, hi, from_, to = int(edges[c]), int(edges[d]), int(self.v.first[c]), int(self.v.first[d])
            z = np.empty(int(cells[d] - cells[c]), h.dtype)
            blocks = []
            for k in range(c, d):
                a, b, i, j = int(self.v.first[k]), int(self.v.first[k + 1]), int(edges[k]), int(edges[k + 1])
                if i < j:
                    e = z[cells[k] - cells[c]: cells[k + 1] - cells[c]].reshape(-1, b - a)
                    np.matmul(hs[i:j], low[a:b].T, out=e)
                    blocks.append((a, b, i, j, e))
            if blocks:
                of = np.repeat(width[c:d], rows[c:d])
                start = np.cumsum(of) - of
                k = start + places[lo:hi] - np.repeat(self.v.first[c:d], rows[c:d])
                z, at = exponents(z, k)
                total = np.add.reduceat(z, start)
                if grads is None:
                    inside[lo:hi] = at - np.log(total)
                else:
                    z[k] -= total
                    inv = 1 / total[:, None]
                    scaled = hs[lo:hi] * inv
                    weights = np.zeros((to - from_, PADDED), h.dtype)
                    for a, b, i, j, e in blocks:
                        np.matmul(e, low[a:b, :s], out=inside[i:j])
                        np.matmul(e.T, scaled[i - lo: j - lo], out=weights[a - from_: b - from_])
                    grads["out"][from_:to] += weights[:, :s]
                    grads["out_b"][from_:to] += weights[:, s]
                    inside[lo:hi] *= inv
            c = d
        if grads is None:
            out[order] += inside
        else:
            back[order] += inside
        return out, back

    def train(self, docs: Iterable[np.ndarray], cls_of: np.ndarray, streams: int = STREAMS, steps: int = STEPS, updates: int | None = None, rate: float = 0.01) -> int:
        """Adam over windows of ``steps`` tokens of parallel streams, until every text is read or for so many updates; the tokens learned from.

        Each stream reads whole texts one after the other; gradients stop at a window's start, the state does not.
        When no more texts come, the streams left have longer windows, and a small window makes a small step.
        """
        weights = self.flat()
        self.p = self._views(weights)
        adam = np.zeros((3, len(weights)), weights.dtype)
        g = self._views(adam[0])
        reader = _Streams(docs, streams)
        h = np.zeros((streams, STATE), np.float32)
        learned = k = 0
        while len(h) and (updates is None or k < updates):
            left = reader.left
            ids, size = reader.window(steps if reader.more else min(max(steps, streams * steps // len(left)), 32 * steps, int(left.max())))
            if len(live := np.flatnonzero(size)) < len(size):
                ids, size, h = ids[:, live], size[live], h[live]
                reader.keep(live)
            if not len(live):
                break
            ids = ids[: size.max()]
            fresh = ids < 0
            real = np.flatnonzero((np.arange(len(ids))[:, None] < size).ravel())
            k += 1
            learned += len(real)
            h = self._update(h, np.where(fresh, ~ids, ids), fresh, real, cls_of, weights, adam, g, k, rate * min(1.0, len(real) / (streams * steps)))
            if not reader.more:
                left = np.flatnonzero(reader.left)
                reader.keep(left)
                h = h[left]
        return learned

    def _update(self, h, ids, fresh, real, cls_of, weights, adam, g, k: int, rate: float) -> np.ndarray:
        """One step of Adam on a window (places by streams, of which ``real`` hold tokens); the states behind it.

        ``weights`` holds all parameters one after the other, ``adam`` the gradient (whose views are ``g``) and both moments, of which the first is 10 and the second 100 times the mean.
        """
        wide, n = ids.shape
        s = STATE
        adam[0] = 0
        inputs, u = self.gates()
        hs = np.empty((wide + 1, n, s), weights.dtype)
        hs[0] = h
        new = fresh.any(1).tolist()
        x, hu = np.empty((2, wide, 3, n, s), weights.dtype)
        for t in range(wide):
            if new[t]:
                hs[t][fresh[t]] = 0
            inputs.take(ids[t], axis=1, out=x[t], mode="clip")
            hs[t + 1] = self._advance(x[t], hs[t], u, hu[t])
        flat, old = ids.ravel(), hs[:-1]
        if len(real) == len(flat):
            back = self.log_probs(old.reshape(-1, s), flat, cls_of[flat], g)[1]
        else:
            tok = flat[real]
            back = np.zeros((wide * n, s), hs.dtype)
            back[real] = self.log_probs(old.reshape(-1, s)[real], tok, cls_of[tok], g)[1]
        back = back.reshape(wide, n, s)
        # what a unit of gradient on the next state gives to each gate, for the whole window at once
        z, r, c = x.swapaxes(0, 1)
        keep = 1 - z
        to_z = old - c
        to_z *= z
        to_z *= keep
        to_n = 1 - c * c
        to_n *= keep
        to_r = np.subtract(1, r, out=keep)
        to_r *= r
        to_r *= hu[:, 2]
        du, dn = np.empty((3, wide, n, s), hs.dtype), np.empty((wide, n, s), hs.dtype)
        carry, ut = np.zeros((n, s), hs.dtype), np.ascontiguousarray(u.swapaxes(1, 2))
        np.negative(ut[:2], out=ut[:2])
        sent = np.empty((3, n, s), hs.dtype)
        for t in reversed(range(wide)):
            d = np.multiply(to_n[t], carry, out=dn[t])
            np.multiply(to_z[t], carry, out=du[0, t])
            np.multiply(to_r[t], d, out=du[1, t])
            np.multiply(r[t], d, out=du[2, t])
            carry *= z[t]
            np.matmul(du[:, t], ut, out=sent)
            for x in sent:
                carry += x
            carry += back[t]
            if new[t]:
                carry[fresh[t]] = 0
        before = old.reshape(-1, s).T
        order, runs, lengths, read = _by_place(flat)
        dx = du.transpose(1, 2, 0, 3).reshape(-1, 3 * s)
        np.matmul(before, dx, out=g["u"])
        dx[:, 2 * s:] = dn.reshape(-1, s)
        g["gates"][read] = _sums(dx.take(order, axis=0), runs, lengths, len(read))
        norm = math.sqrt(float(np.vdot(adam[0], adam[0]))) / len(real)
        scale = min(1.0, 1.0 / max(norm, 1e-9)) / len(real)
        size = math.sqrt(1 - 0.99**k)
        for a in range(0, len(weights), ADAM_CELLS):
            d, m, q = adam[:, a: a + ADAM_CELLS]
            d *= scale
            m *= 0.9
            m += d
            d *= d
            q *= 0.99
            q += d
            np.sqrt(q, out=d)
            d += 1e-6 * size
            np.divide(m, d, out=d)
            d *= rate * size / (1 - 0.9**k)
            weights[a: a + ADAM_CELLS] -= d
        return hs[-1]

    def _views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        ends = np.cumsum([x.size for x in self.p.values()]).tolist()
        return {k: flat[b - x.size: b].reshape(x.shape) for b, (k, x) in zip(ends, self.p.items())}

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.p.values()])

    def put(self, flat: np.ndarray) -> None:
        self.p = self._views(flat.astype(np.float32))

    def score(self, tokens: np.ndarray, first: np.ndarray, ids: np.ndarray, cls: np.ndarray, inside: np.ndarray, window: int = WINDOW) -> np.ndarray:
        """log10-probability of each document: ``tokens`` from ``first[i]`` to ``first[i + 1]``, through tables by token."""
        size = np.diff(first)
        order = np.argsort(-size, kind="stable")
        size, start = size[order], first[:-1][order]
        total = np.zeros(len(size))
        h, hu = np.zeros((len(size), STATE), np.float32), np.empty((3, len(size), STATE), np.float32)
        (inputs, u), heads = self.gates(), self.heads()
        longest = int(size.max(initial=0))
        alive = np.searchsorted(-size, -np.arange(longest), "left")  # documents that have a token at each place
        edges = np.append(0, np.cumsum(alive))
        at = 0
        while at < longest:  # a window of all documents that reach it
            end = max(at + 1, min(at + window, int(np.searchsorted(edges, edges[at] + WINDOW_TOKENS, "right")) - 1))
            ends = edges[at: end + 1] - edges[at]
            doc = np.arange(ends[-1]) - np.repeat(ends[:-1], alive[at:end])
            tok = tokens[start[doc] + np.repeat(np.arange(at, end), alive[at:end])]
            x, states = inputs.take(ids[tok], axis=1), np.empty((len(tok), STATE), np.float32)
            bounds = ends.tolist()
            for a, b in zip(bounds[:-1], bounds[1:]):
                now = states[a:b] = h[: b - a]
                h[: b - a] = self._advance(x[:, a:b], now, u, hu[:, : b - a])
            lp = self.log_probs(states, ids[tok], cls[tok], heads=heads)[0] + inside[tok]
            total += np.bincount(doc, lp, len(size))
            at = end
        out = np.zeros(len(size))
        out[order] = total / math.log(10)
        return out


def _joined(some: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words one after the other: bytes, starts and ends."""
    size = np.array([len(w) for w in some], np.int64)
    ends = np.cumsum(size)
    return np.frombuffer(b"".join(some), np.uint8), ends - size, ends


def _hashes(some: list[str]) -> np.ndarray:
    return word_hashes(*_joined([w.encode() for w in some]))


def _suffix_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A fingerprint of the last two characters (or fewer) of each word; a word has a byte at least."""
    at = ends
    for _ in range(2):
        at = np.maximum(at - 1, starts)
        inner = np.flatnonzero((data[at] & 0xC0 == 0x80) & (at > starts))
        while len(inner):  # inside a character
            at[inner] -= 1
            inner = inner[(data[at[inner]] & 0xC0 == 0x80) & (at[inner] > starts[inner])]
    size = ends - at
    key = np.zeros(len(at), np.uint64)
    some = slice(None)
    for i in range(min(8, int(size.max(initial=0)))):
        key[some] |= data[at[some] + i].astype(np.uint64) << np.uint64(8 * i)
        some = np.flatnonzero(size > i + 1)
    return mix(key + mix(size.astype(np.uint64)))


def _text_bytes(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings of a column and of a replacement character behind them, and where each ends."""
    parts, ends, at = [], [], 0
    for _, _, data, offs in slices(column):
        parts.append(data)
        ends.append(offs[1:] + at)
        at += len(data)
    last = np.frombuffer("\ufffd".encode(), np.uint8)
    return np.concatenate([*parts, last]), np.concatenate([*ends, [at + len(last)]])


class _Words:
    """The place of each word in a list of fingerprints, looked up for many words at once.

    Most places stand in a table of slots, in which the first word of a slot wins; the others are searched for.
    """

    def __init__(self, h: np.ndarray):
        self.h = h
        n = len(self.h)
        bits = max(n, 1).bit_length() + 3
        self.shift = np.uint64(64 - bits)
        slot, place = self.h >> self.shift, np.arange(n, dtype=np.int32)
        self.slots = np.full(1 << bits, -1, np.int32)
        self.slots[slot[::-1]] = place[::-1]
        lost = np.flatnonzero(self.slots[slot] != place)
        self.rest = lost[np.argsort(self.h[lost])].astype(np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The places, -1 for words that the list does not have."""
        if not len(self.h):
            return np.full(len(h), -1, np.int32)
        out = self.slots[h >> self.shift]
        miss = np.flatnonzero(self.h[out] != h)
        out[miss] = -1
        if len(self.rest):
            k = np.minimum(np.searchsorted(self.h[self.rest], h[miss]), len(self.rest) - 1)
            out[miss] = np.where(self.h[self.rest][k] == h[miss], self.rest[k], -1)
        return out


def _with_ends(places: np.ndarray, first: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of a run's words with the end's place behind each text, and where the texts start (rows + 1 entries)."""
    rows = np.arange(len(first))
    out = np.full(len(places) + len(first) - 1, end, places.dtype)
    out[np.arange(len(places)) + np.repeat(rows[:-1], np.diff(first))] = places
    return out, first + rows


class _Suffixes:
    """The place of a word's last two characters in a list, the length of the list for others."""

    def __init__(self, some: list[str]):
        keys = _suffix_keys(*_joined([s.encode() for s in some]))
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts) or not len(self.keys):
            return np.full(len(starts), len(self.keys), np.int64)
        key = _suffix_keys(data, starts, ends)
        k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[k] == key, self.order[k], len(self.keys))


class _Inputs:
    """Texts -> what the network reads: the place of a shortlist word, else its suffix."""

    def __init__(self, v: Vocabulary):
        self.short = _Words(_hashes(v.words[: v.short]))
        self.rare, self.suffixes = v.short, _Suffixes(v.suffixes)
        self.end = self.places(*_joined([END.encode()]))[0]

    def places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = self.short.find(word_hashes(data, starts, ends))
        miss = np.flatnonzero(out < 0)
        out[miss] = self.rare + self.suffixes.find(data, starts[miss], ends[miss])
        return out

    def texts(self, column: pa.Array) -> list[np.ndarray]:
        """The inputs of every text, the longest first, so that a long one does not remain when the others are read."""
        out: list[np.ndarray] = []
        for _, _, data, offs in slices(column, RUN_BYTES):
            data = LOWER[data]
            starts, ends, first = word_spans(data, offs)
            ids, at = _with_ends(self.places(data, starts, ends), first, self.end)
            out += np.split(ids, at[1:-1])
        return sorted(out, key=len, reverse=True)


def _means(table: pa.Table) -> pa.Table:
    """The weighted mean of one piece over the tasks of one group."""
    order = np.argsort(table.column("part").to_numpy(), kind="stable")
    weight = table.column("weight").to_numpy()[order]
    vals = table.column("vals").combine_chunks()
    total = 0.0
    for i, w in zip(order.tolist(), weight.tolist()):
        total = total + w * np.frombuffer(vals[i].as_buffer(), np.float32).astype(np.float64)
    mean = (total / weight.sum()).astype(np.float32)
    return pa.table({"piece": table.column("piece")[:1], "part": pa.array([table.column("part")[0].as_py() // FAN], pa.int32()),
                     "weight": pa.array([weight.sum()], pa.float64()), "vals": pa.array([mean.tobytes()], pa.binary())})


def train_network(rows: DataFrame, v: Vocabulary, updates: int) -> tuple[Network, int]:
    """The network after all rounds over ``txt string, mark long``, and the tokens it has learned from.

    ``mark`` says in which round a row takes part.  Every row is read to its end once, or more often where all rows
    have fewer tokens than ``updates`` windows of 64 x 20.
    """
    spark = rows.sparkSession
    net = Network(v)
    cls_of = np.append(v.short_class, v.n_short + np.arange(len(v.suffixes) + 1))
    passes = max(1, min(updates, -(-updates * 1280 // max(v.tokens, 1))))
    parts = max(1, min(rows.rdd.getNumPartitions(), v.tokens // TASK_TOKENS))
    rows = rows.coalesce(parts)
    schema = "piece int, part int, weight double, vals binary"
    learned = 0
    for k, rate in enumerate(RATES):
        now = spark.sparkContext.broadcast((net, cls_of))

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            net, cls_of = now.value
            mine = Network.__new__(Network)  # the broadcast one is shared by the tasks of a worker
            mine.v, mine.p = net.v, {key: x.copy() for key, x in net.p.items()}
            inputs = _Inputs(net.v)

            def texts():
                for batch in batches:
                    yield from inputs.texts(batch.column(0))

            if passes == 1:
                n = mine.train(texts(), cls_of, rate=rate)
            else:  # fewer tokens than the least number asked for
                kept = list(texts())
                n = mine.train((x for _ in range(passes) for x in kept), cls_of, rate=rate)
            if n:
                flat = mine.flat()
                pieces = [flat[i: i + PIECE].tobytes() for i in range(0, len(flat), PIECE)]
                c, part = len(pieces), TaskContext.get().partitionId()
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(c, dtype=np.int32)), pa.array(np.full(c, part, np.int32)),
                                                  pa.array(np.full(c, float(n))), pa.array(pieces, pa.binary())], names=["piece", "part", "weight", "vals"])
            del mine, inputs
            give_back()

        out = rows.where(F.pmod("mark", F.lit(len(RATES))) == k).select("txt").mapInArrow(learn, schema)
        left = parts
        while left > 1:
            out = out.groupBy("piece", (F.col("part") / FAN).cast("int")).applyInArrow(_means, schema)
            left = -(-left // FAN)
        got = sorted(out.collect(), key=lambda r: r["piece"])  # one row for each piece of the weights
        if got:
            learned += int(round(got[0]["weight"]))
            net.put(np.concatenate([np.frombuffer(r["vals"], np.float32) for r in got]))
        now.unpersist()
    return net, learned


def score_documents(docs: DataFrame, train: Column, text_col: str = "text", carry: list[str] | None = None, updates: int = 1100) -> DataFrame:
    """The carried columns of every row (all but the text, if None), then ``n_tokens, n_known, train_tokens long,
    base_score, score double``.

    Words are lower-cased in A-Z; every text ends with one end token.  ``train`` says which rows to learn from; counts
    and the network's training cover all of them.  ``base_score`` is the smoothed unigram log10-probability, ``score`` the network's; words that no
    training text has share one unknown word in each class, as in the base.  A null or empty text is the end token
    alone; repeated rows get equal scores; without training rows both scores are the base's; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    results = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    learned = docs.where(F.coalesce(train, F.lit(False))).select(docs[f"`{text_col}`"].cast("string").alias("txt"), row_struct(docs, text_col, carry, results).alias("row"))
    learned = learned.select("txt", F.xxhash64("txt", "row").alias("mark"))
    counts = word_counts(learned.select("txt")).checkpoint()
    v = vocabulary(counts)
    top_tables = v.tables(v.words, v.counts)
    net = None
    if v.short:
        net, _ = train_network(learned, v, updates)
    base = blocked(docs, text_col, carry, results, BLOCK_BYTES)
    model = spark.sparkContext.broadcast((v, top_tables, net))  # bounded by TOP_WORDS and the network's sizes
    places: list[_Words] = []
    endings: list[_Suffixes] = []

    def known() -> _Words:
        if not places:
            places.append(_Words(_hashes(model.value[0].words)))
            endings.append(_Suffixes(model.value[0].suffixes))
        return places[0]

    def hashed(table: pa.Table):
        """Of each run of texts: bytes, starts and ends of the words, the first word of each text, fingerprints and places."""
        for _, _, data, offs in slices(table.column("txt").combine_chunks(), RUN_BYTES):
            data = LOWER[data]
            starts, ends, first = word_spans(data, offs)
            h = word_hashes(data, starts, ends)
            yield data, starts, ends, first, h, known().find(h)

    def ask(table: pa.Table) -> pa.Table:
        asked: dict[int, bytes] = {}
        for data, starts, ends, _, h, place in hashed(table):
            miss = np.flatnonzero(place < 0)
            new, at = np.unique(h[miss], return_index=True)
            raw, at = data.tobytes(), miss[at]
            asked.update(zip(new.tolist(), [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]))
        return pa.table({"w": _strings(list(asked.values())),
                         "blk": pa.array(np.full(len(asked), table.column("blk")[0].as_py(), np.int32))})

    def score(table: pa.Table, reply: pa.Table) -> pa.Table:
        v, tables, net = model.value
        end = int(known().find(_hashes([END]))[0])
        data, ends = _text_bytes(reply.column("w"))  # and, at last, bytes that are no text, so that their word came back as another
        spans = data, np.append(0, ends[:-1]), ends
        local, nowhere, c = _Words(word_hashes(*spans)[:-1]), len(v.words) + reply.num_rows, np.append(reply.column("c").to_numpy(), 0.0)
        ids, cls, inside, base10 = (np.concatenate(x) for x in zip(tables, v.tables_of(v.n_short + endings[0].find(*spans), c, len(v.words))))
        seen = np.concatenate([np.ones(len(v.words), bool), c > 0])
        toks, size = [], []
        for _, _, _, first, h, place in hashed(table):
            miss = np.flatnonzero(place < 0)
            found = local.find(h[miss])
            place[miss] = np.where(found < 0, nowhere, found + len(v.words))
            toks.append(_with_ends(place, first, end)[0])
            size += (np.diff(first) + 1).tolist()
        first = np.append(0, np.cumsum(size)).astype(np.int64)
        tokens = np.concatenate(toks) if toks else np.zeros(0, np.int32)
        unknown_end = end < 0  # nothing was learned
        if unknown_end:
            base10, seen = np.append(base10, v.base(np.zeros(1))), np.append(seen, False)
        total = np.add.reduceat(base10[tokens], first[:-1]) if toks else np.zeros(0)
        kept = np.add.reduceat(seen[tokens].astype(np.int64), first[:-1]) if toks else np.zeros(0, np.int64)
        lp = net.score(tokens, first, ids, cls, inside) if net is not None else total
        n = len(size)
        return pa.table({"row": loose(table.column("row")), "n_tokens": pa.array(np.array(size, np.int64)), "n_known": pa.array(kept),
                         "train_tokens": pa.array(np.full(n, v.tokens, np.int64)), "base_score": pa.array(total), "score": pa.array(lp)})

    asked = base.groupBy("blk").applyInArrow(ask, "w string, blk int")
    reply = asked.join(counts, "w", "left").select("blk", "w", F.coalesce("c", F.lit(0)).cast("double").alias("c"))
    kind = base.schema["row"].dataType.simpleString()
    out = base.groupBy("blk").cogroup(reply.groupBy("blk")).applyInArrow(
        score, f"row {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.select("row.*", "n_tokens", "n_known", "train_tokens", "base_score", "score")
