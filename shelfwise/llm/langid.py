"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

N-grams of one to three characters (letters lower-cased, all else a space) are
hashed into a fixed number of features.  Document frequencies are counted over
every training text on Spark.  The weights are fitted by
follow-the-regularised-leader with elastic-net penalties on a bounded sample;
a temperature fitted on held-back sample rows calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.blocks import row_struct
from shelfwise.llm.sampling import SAMPLE_TEXT_BYTES, at_most, per_label
from shelfwise.llm.text import give_back, lower_points, slices

BITS = 15
FEATURES = 1 << BITS
ORDERS = 3
UNDETERMINED = "und"


def _letters() -> np.ndarray:
    """Code point -> lower-cased letter, or a space for anything that is no letter."""
    alpha = np.fromiter((chr(c).isalpha() for c in range(0x33480)), bool, 0x33480)
    out = np.full(0x110000, 32, np.uint32)
    out[: len(alpha)][alpha] = lower_points()[: len(alpha)][alpha]
    return out


_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(_letters())
    return _LETTERS[0]


def chars_of(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters or spaces of a run of rows, and the rows' offsets in characters."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    heads = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    return letters()[points], heads[offs]


def grams(chars: np.ndarray, offs: np.ndarray) -> Iterator[np.ndarray]:
    """For each order, the feature that starts at each character; ``FEATURES`` where there is none."""
    row_end = np.repeat(offs[1:], np.diff(offs))
    at = np.arange(len(chars))
    key = np.zeros(len(chars), np.uint64)
    for n in range(1, ORDERS + 1):
        key = key * np.uint64(0x110003)
        key[: len(chars) - n + 1] += chars[n - 1:].astype(np.uint64) + np.uint64(n)
        feat = ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)
        feat[(at + n > row_end) | ((chars == 32) & (n == 1))] = FEATURES
        yield feat


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of the rows (one text column) each feature occurs, and the number of rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows = np.zeros(FEATURES + 1, np.int64), 0
        for batch in batches:
            for _, _, data, offs in slices(batch.column(0), 1 << 20):
                n = len(offs) - 1
                chars, offs = chars_of(data, offs)
                row = np.repeat(np.arange(n), np.diff(offs))
                for lo in range(0, n, 512):
                    part = slice(int(offs[lo]), int(offs[min(lo + 512, n)]))
                    seen = np.zeros((min(512, n - lo), FEATURES + 1), bool)
                    for feat in grams(chars[part], offs[lo: lo + 513] - offs[lo]):
                        seen[row[part] - lo, feat] = True
                    df += seen.sum(0)
                rows += n
        df[FEATURES] = rows
        give_back()
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(df[some])], names=["f", "n"])

    df = np.zeros(FEATURES + 1, np.int64)
    for f, n in texts.mapInArrow(count, "f int, n long").groupBy("f").agg(F.sum("n")).collect():  # one row per feature
        df[f] = n
    return df[:FEATURES], int(df[FEATURES])


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # FEATURES + 1 rows (the last all zero), a column per label; holds the IDF
    bias: np.ndarray
    temperature: float

    def logits(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logits of each row, and whether it has a letter."""
        chars, offs = chars_of(data, offs)
        k, n = len(self.labels), len(offs) - 1
        total, count, some = np.zeros((n, k)), np.zeros(n), np.zeros(n, bool)
        full = np.flatnonzero(np.diff(offs) > 0)
        if len(full):
            at = offs[:-1][full]
            some[full] = np.add.reduceat((chars != 32).astype(np.int64), at) > 0
            for feat in grams(chars, offs):
                total[full] += np.add.reduceat(self.weights[feat], at, axis=0)
                count[full] += np.add.reduceat((feat < FEATURES).astype(np.int64), at)
        return total / np.maximum(count, 1)[:, None] + self.bias, some

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def _sparse(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    chars, offs = chars_of(data, np.array([0, len(data)]))
    feat = np.concatenate([f[f < FEATURES] for f in grams(chars, offs)]) if len(chars) else np.zeros(0, np.int64)
    f, n = np.unique(feat, return_counts=True)
    return f, n / max(len(feat), 1) * idf[f]


def _ftrl(rows: list, y: np.ndarray, k: int, alpha: float, beta: float, l1: float, l2: float, epochs: int, seed: int):
    """Weights (FEATURES x k) and biases after online proximal updates, one row at a time."""
    z, n = np.zeros((FEATURES + 1, k)), np.zeros((FEATURES + 1, k))  # the last row is the bias, which has no penalty

    def weights(zf, nf, a1):
        return np.where(np.abs(zf) <= a1, 0.0, -(zf - np.sign(zf) * a1) / ((beta + np.sqrt(nf)) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            f, x = rows[i]
            f, x = np.append(f, FEATURES), np.append(x, 1.0)
            zf, nf = z[f], n[f]
            w = weights(zf, nf, l1)
            w[-1] = weights(zf[-1], nf[-1], 0.0)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y[i]] -= 1.0
            g = x[:, None] * p
            more = nf + g * g
            z[f] = zf + g - (np.sqrt(more) - np.sqrt(nf)) / alpha * w
            n[f] = more
    w = weights(z, n, l1)
    return w[:FEATURES], weights(z[FEATURES], n[FEATURES], 0.0)


def fit(docs: DataFrame, train: Column, label_col: str = "lang", text_col: str = "text", per_class: int = 700, alpha: float = 2.0,
        beta: float = 1.0, l1: float = 0.002, l2: float = 0.002, epochs: int = 4, seed: int = 11) -> Model | None:
    """Fit on the rows where ``train`` holds and text and label are not null; None if there are none.

    Document frequencies cover all of these rows.  The weights come from at most ``per_class`` texts of each
    label, of at most SAMPLE_TEXT_BYTES each, chosen by a hash of the text; a quarter of them only calibrates.
    """
    rows = docs.where(train & docs[f"`{text_col}`"].isNotNull() & docs[f"`{label_col}`"].isNotNull()).select(
        docs[f"`{text_col}`"].cast("string").alias("txt"), docs[f"`{label_col}`"].cast("string").alias("label"))
    small = per_label(rows.where(F.octet_length("txt").between(1, SAMPLE_TEXT_BYTES)), "label", "txt", per_class)
    sample = at_most(sorted(small.select("txt", "label").collect()), "label", per_class)
    if not sample:
        return None
    df, total = document_frequencies(rows.select("txt"))
    idf = np.log((1 + total) / (1 + df)) + 1
    labels = sorted({r["label"] for r in sample})
    y = np.array([labels.index(r["label"]) for r in sample])
    x = [_sparse(r["txt"], idf) for r in sample]
    back = np.random.default_rng(seed).random(len(x)) < 0.25
    if back.all() or not back.any():
        back[:] = False
    fitted = np.flatnonzero(~back)
    w, bias = _ftrl([x[i] for i in fitted], y[fitted], len(labels), alpha, beta, l1, l2, epochs, seed)
    held = np.flatnonzero(back)
    temperature = 1.0
    if len(held):
        s = np.array([v @ w[f] for f, v in (x[i] for i in held)]) + bias

        def loss(t):
            z = s / t
            z = z - z.max(axis=1, keepdims=True)
            return -(z[np.arange(len(held)), y[held]] - np.log(np.exp(z).sum(axis=1))).mean()

        temperature = float(min(np.geomspace(0.1, 10, 80), key=loss))
    return Model(labels, np.vstack([w * idf[:, None], np.zeros((1, len(labels)))]).astype(np.float32), bias, temperature)


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", carry: list[str] | None = None, pred_name: str = "lang_pred",
            score_name: str = "lang_score") -> DataFrame:
    """The columns of ``docs`` named in ``carry`` (all, the text too, if None), then the label and its probability.

    A null text or one without a letter gets ``und`` and the score 0; so does every row when there was nothing to
    learn from.  Repeated rows get the same result.  An empty table gives no rows.
    """
    keep = docs.columns if carry is None else carry
    with_text = text_col in keep and text_col not in (pred_name, score_name)  # sent once, not in the row too

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offs in slices(batch.column(0), max(1 << 16, (2 << 20) // max(4, len(model.labels) if model else 4))):
                if model is None:
                    pred, score = [UNDETERMINED] * (j - i), np.zeros(j - i)
                else:
                    logits, some = model.logits(data, offs)
                    p = model.probabilities(logits)
                    best = p.argmax(axis=1)
                    pred = [model.labels[b] if s else UNDETERMINED for b, s in zip(best, some)]
                    score = np.where(some, p[np.arange(len(p)), best], 0.0)
                kept = [batch.column(0).slice(i, j - i)] if with_text else []
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(i, j - i), pa.array(pred, pa.string()), pa.array(score), *kept],
                                                 names=["row", "pred", "score", *["txt"] * with_text])
        give_back()

    base = docs.select(docs[f"`{text_col}`"].cast("string").alias("txt"), row_struct(docs, text_col, keep, (pred_name, score_name)).alias("row"))
    out = base.mapInArrow(run, f"row {base.schema['row'].dataType.simpleString()}, pred string, score double" + ", txt string" * with_text)
    named = [F.col("txt").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in keep if c.lower() not in (pred_name, score_name)]
    return out.select(*named, F.col("pred").alias(pred_name), F.col("score").alias(score_name))
