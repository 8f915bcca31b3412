"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

The score of a document is a linear part plus all pairwise interactions of its
features, with low-rank interaction weights.  By the sum-of-squares identity
the pairs cost as much as the features: ``sum_{i<j} <v_i, v_j> x_i x_j =
1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``.

Fitted on the driver with a bounded labelled sample (``PER_LABEL`` rows of each
label, weighted back to the labels' shares); all texts are scored whole in
Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcore
from .learning import bounded_sample, held_out, sigmoid

WORD_BITS = 11  # hashed words: 2048 features
RANK = 6
PER_LABEL = 1500  # labelled rows of each label in the fit
EPOCHS = 30
THRESHOLD = 0.3
_ROWS = 64  # texts whose dense features are held together

_CLASSES = np.zeros(256, dtype=np.uint8)  # 1 lower, 2 upper, 3 digit, 4 white space, 5 other ASCII, 6 beyond ASCII
_CLASSES[:128] = 5
_CLASSES[128:] = 6
_CLASSES[97:123] = 1
_CLASSES[65:91] = 2
_CLASSES[48:58] = 3
_CLASSES[[0x20, 9, 10, 11, 12, 13]] = 4
_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[list(b".,;:'\"?-()")] = True

#: structure statistics, each cut at fixed edges into one-hot features
EDGES = {
    "upper": (0.02, 0.05, 0.1, 0.2, 0.4, 0.6),  # share of letters
    "symbols": (0.005, 0.01, 0.02, 0.04, 0.08, 0.16),  # non-punctuation signs per byte
    "punctuation": (0.002, 0.005, 0.01, 0.02, 0.04, 0.08),
    "digits": (0.001, 0.005, 0.01, 0.03, 0.1),
    "word_length": (2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 10.0),
    "n_words": (5, 20, 50, 100, 200, 400, 800, 1600),
    "distinct": (0.2, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9),  # share of words that are new
    "line_words": (3, 6, 10, 15, 20, 30, 60),
    "repeated_lines": (0.05, 0.2, 0.4, 0.7),
    "n_chars": (20, 100, 400, 1000, 2500, 6000, 15000),  # metadata column
}
N_STRUCTURE = sum(len(e) + 1 for e in EDGES.values())
N_FEATURES = (1 << WORD_BITS) + N_STRUCTURE


def _structure(text: bytes, hashes: np.ndarray, n_chars: float | None) -> list[float]:
    kinds = np.bincount(_CLASSES[np.frombuffer(text, dtype=np.uint8)], minlength=7)
    size, letters = max(1, len(text)), max(1, kinds[1] + kinds[2])
    marks = int(_PUNCTUATION[np.frombuffer(text, dtype=np.uint8)].sum())
    lines = [x for x in text.splitlines() if x.strip()]
    n = len(hashes)
    return [
        kinds[2] / letters,
        (kinds[5] - marks) / size,
        marks / size,
        kinds[3] / size,
        (size - kinds[4]) / max(1, n),
        n,
        len(np.unique(hashes)) / max(1, n),
        n / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)),
        n_chars if n_chars is not None else -1.0,
    ]


def features(texts, n_chars) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, dense features) of runs of texts: unit-length word part, one-hot structure."""
    n_chars = n_chars.to_pylist()
    for part in textcore.words(texts, lower=True):
        total = len(part.offsets) - 1
        buckets = (part.hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
        _, bounds = textcore.text_buffers(texts.slice(part.first, total))
        for lo in range(0, total, _ROWS):
            hi = min(lo + _ROWS, total)
            a, b = part.offsets[lo], part.offsets[hi]
            row = np.repeat(np.arange(hi - lo), np.diff(part.offsets[lo : hi + 1]))
            words = np.bincount((row << WORD_BITS) + buckets[a:b], minlength=(hi - lo) << WORD_BITS)
            words = np.log1p(words.reshape(hi - lo, -1).astype(np.float32))
            words /= np.maximum(np.sqrt((words**2).sum(axis=1, keepdims=True)), 1e-6)
            x = np.zeros((hi - lo, N_FEATURES), dtype=np.float32)
            x[:, : 1 << WORD_BITS] = words
            stats = np.array(
                [
                    _structure(
                        part.raw[bounds[i] : bounds[i + 1]].tobytes(),
                        part.hashes[part.offsets[i] : part.offsets[i + 1]],
                        n_chars[part.first + i],
                    )
                    for i in range(lo, hi)
                ]
            )
            at = 1 << WORD_BITS
            for value, edges in zip(stats.T, EDGES.values()):
                x[np.arange(hi - lo), at + np.searchsorted(edges, value, side="right")] = 1.0
                at += len(edges) + 1
            yield part.first + lo, x


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray  # features x rank

    def margin(self, x: np.ndarray) -> np.ndarray:
        sums = x @ self.factors
        pairs = 0.5 * ((sums**2).sum(axis=1) - (x**2) @ (self.factors**2).sum(axis=1))
        return self.bias + x @ self.linear + pairs

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> FactorisationMachine:
        """Logistic loss by mini-batches with adaptive steps; L2 on words is stronger than on structure."""
        rng = np.random.default_rng(seed)
        n, d = x.shape
        params = [np.zeros(1), np.zeros(d), rng.normal(0, 0.02, (d, RANK))]
        decay = np.full(d, 2e-3)
        decay[1 << WORD_BITS :] = 2e-4
        first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(epochs):
            for rows in np.array_split(rng.permutation(n), max(1, n // 128)):
                xb, w = x[rows].astype(np.float64), weight[rows] / weight[rows].sum()
                model = cls(float(params[0][0]), params[1], params[2])
                error = (sigmoid(model.margin(xb)) - y[rows]) * w
                sums = xb @ params[2]
                grads = [
                    np.array([error.sum()]),
                    xb.T @ error + decay * params[1],
                    xb.T @ (error[:, None] * sums) - ((xb**2).T @ error)[:, None] * params[2] + decay[:, None] * params[2],
                ]
                step += 1
                for p, g, m, s in zip(params, grads, first, second):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    p -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
        return cls(float(params[0][0]), params[1].astype(np.float32), params[2].astype(np.float32))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_label: int = PER_LABEL, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> FactorisationMachine | None:
    """Model from labelled rows that are not held out; None without documents of both labels."""
    known = labels.filter(~held_out("doc_id") & F.col(label).isNotNull())
    known = known.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__label")).distinct()
    counts = {r["__label"]: r["count"] for r in known.groupBy("__label").count().collect()}
    if set(counts) != {0, 1}:
        return None
    sample = bounded_sample(known, "__label", per_label, "__id")
    rows = docs.select(
        F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text"), F.col(chars_col).cast("double").alias("n_chars")
    )
    rows = rows.join(F.broadcast(sample), "__id").select("__id", "__label", "text", "n_chars")  # PER_LABEL rows of each label

    def extract(batches):
        for batch in batches:
            for first, x in features(batch.column(2), batch.column(3)):
                part = batch.slice(first, len(x))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), part.column(1), pa.array([v.astype(np.float16).tobytes() for v in x], pa.binary())],
                    names=["id", "label", "x"],
                )

    found = rows.mapInArrow(extract, "id long, label int, x binary").toPandas().sort_values(["id", "label", "x"])
    if set(found["label"]) != {0, 1}:
        return None
    x = np.stack([np.frombuffer(v, dtype=np.float16) for v in found["x"]]).astype(np.float32)
    y = found["label"].to_numpy()
    taken = {k: max(1, int((y == k).sum())) for k in counts}
    weight = np.array([counts[k] / taken[k] for k in y])
    return FactorisationMachine.fit(x, y.astype(float), weight / weight.mean())


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    model: FactorisationMachine | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    chars_col: str = "n_chars",
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; ``predicted`` is 1 from ``THRESHOLD`` on.

    Null and empty texts are scored as texts without words.  A null ``n_chars``
    counts as below all its edges.  Repeated labels count once, contradicting
    ones both; null labels are not learned; rows with a null id are never
    learned from and count as held out.  Without labels of both kinds every
    score is 0.5.  Other columns are not read; an empty table gives no rows.
    """
    model = model or fit(docs, labels, id_col=id_col, text_col=text_col, chars_col=chars_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        held_out(id_col).alias("held_out"),
        F.col(text_col).cast("string").alias("text"),
        F.col(chars_col).cast("double").alias("n_chars"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, x in features(batch.column(2), batch.column(3)):
                score = sigmoid(model.margin(x).astype(float)) if model else np.full(len(x), 0.5)
                part = batch.slice(first, len(x))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
