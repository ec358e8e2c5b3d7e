"""Quality by compression: zstandard dictionaries of good and of bad text.

A text that shares more with the bad dictionary compresses better with it.  The
difference of the two compressed sizes, normalised by the larger, and the
compression ratio go through a logistic curve fitted on labelled texts that the
dictionaries have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.blocks import row_struct
from shelfwise.llm.sampling import SAMPLE_TEXT_BYTES, at_most, per_label
from shelfwise.llm.text import slices

LEVEL = 3


@dataclass
class Model:
    good: bytes
    bad: bytes
    curve: np.ndarray

    def sizer(self):
        import zstandard as z

        tools = []
        for raw in (self.good, self.bad):
            d = z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_AUTO if raw else z.DICT_TYPE_RAWCONTENT)
            if raw:
                d.precompute_compress(level=LEVEL)
            tools.append(z.ZstdCompressor(level=LEVEL, dict_data=d if raw else None, write_checksum=False, write_content_size=False,
                                          write_dict_id=False))
        return lambda t: (len(tools[0].compress(t)), len(tools[1].compress(t)))

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.curve, -30, 30)))


def features(raw: np.ndarray, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Normalised size difference, logarithm of the compression ratio, and their low powers."""
    most = np.maximum(np.maximum(good, bad), 1)
    d = 10.0 * (bad - good) / most
    r = np.log((np.minimum(good, bad) + 8.0) / (raw + 8.0))
    return np.column_stack([np.ones(len(d)), d, np.abs(d), r, r * r, d * r])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, steps: int = 40) -> np.ndarray:
    """Newton's method with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _dictionary(samples: list[bytes], size: int) -> bytes:
    import zstandard as z

    if len(samples) >= 20 and sum(map(len, samples)) > 20_000:
        try:
            return z.train_dictionary(min(size, sum(map(len, samples)) // 4), samples).as_bytes()
        except z.ZstdError:
            pass
    return b"".join(samples)[-size:]  # too little text to train on: the text itself


def fit(docs: DataFrame, labels: DataFrame, train, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality",
        per_class: int = 1200, dictionary_bytes: int = 112_640) -> Model:
    """Fit on the labelled rows where ``train(id column)`` holds.

    At most ``per_class`` labelled texts of each class (0 and 1), of at most SAMPLE_TEXT_BYTES each, chosen by a
    hash of the id; half of them make the dictionaries, half the curve.  Without a label of both classes every score
    is the share of good labels (0.5 without any).
    """
    lab = labels.select(labels[f"`{id_col}`"].alias("id"), labels[f"`{label_col}`"].cast("int").alias("label"))
    lab = lab.where(F.col("label").isin(0, 1) & F.col("id").isNotNull())
    lab = lab.where(train(F.col("id")))
    counts = {r[0]: r[1] for r in lab.groupBy("label").count().collect()}
    picked = per_label(lab, "label", "id", per_class)
    text = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text_col}`"].cast("string").alias("txt"))
    text = text.where(F.octet_length("txt").between(1, SAMPLE_TEXT_BYTES))
    # the picked labels are at most about 1.5 * per_class rows of each of two classes
    rows = text.join(F.broadcast(picked), "id").select("label", F.xxhash64("id").alias("h"), "txt").collect()
    sample = at_most(sorted(rows, key=lambda r: (r["h"], r["txt"])), "label", per_class)
    good, bad = ([r["txt"].encode() for r in sample if r["label"] == v] for v in (1, 0))
    known = sum(counts.values())
    base = (counts.get(1, 0) + 0.5) / (known + 1) if known else 0.5
    if len(good) < 2 or len(bad) < 2:
        return Model(b"", b"", np.array([np.log(base / (1 - base)), 0, 0, 0, 0, 0]))
    model = Model(_dictionary(good[::2], dictionary_bytes), _dictionary(bad[::2], dictionary_bytes), np.zeros(6))
    size = model.sizer()
    held = good[1::2] + bad[1::2]
    y = np.array([1.0] * len(good[1::2]) + [0.0] * len(bad[1::2]))
    got = np.array([size(t) for t in held], float)
    curve = _logistic(features(np.array([len(t) for t in held], float), got[:, 0], got[:, 1]), y)
    # the sample is balanced; the intercept goes back to the classes' true shares
    curve[0] += np.log(base / (1 - base)) - np.log(y.mean() / (1 - y.mean()))
    return Model(model.good, model.bad, curve)


def score(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None, name: str = "quality_score") -> DataFrame:
    """The columns named in ``carry`` (all, if None), then the score from 0 to 1; higher means label 1 is likelier.

    Null texts count as empty, and empty texts are scored like all others.  Repeated rows get the same score.  An
    empty table gives no rows.
    """
    keep = docs.columns if carry is None else carry

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = model.sizer()
        for batch in batches:
            out = []
            for _, _, data, offs in slices(batch.column(0)):
                raw = data.tobytes()
                got = np.array([size(raw[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())], float)
                out.append(model.scores(features(np.diff(offs).astype(float), got[:, 0], got[:, 1])))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(np.concatenate(out) if out else np.zeros(0))], names=["row", "score"])

    base = docs.select(docs[f"`{text_col}`"].cast("string").alias("txt"), row_struct(docs, "", keep, (name,)).alias("row"))
    out = base.mapInArrow(run, f"row {base.schema['row'].dataType.simpleString()}, score double")
    return out.select("row.*", F.col("score").alias(name))
