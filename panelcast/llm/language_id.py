"""Language identification by error-correcting output codes.

Every language has a codeword.  One binary classifier per bit, on hashed byte
n-grams, predicts that bit; a text goes to the codeword with the least
weighted loss over all bits, so that some wrong bits do no harm.  A text whose
two nearest codewords are about as far is flagged as ambiguous.

The classifiers are fitted on the driver with a bounded labelled sample
(``PER_LANGUAGE`` rows of each language); all texts are scored in Spark tasks,
from their whole bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcore
from .learning import bounded_sample, fit_logistic, held_out

BITS = 12  # hashed n-gram features: 4096
PER_LANGUAGE = 500  # labelled rows of each language in the fit
FULL_LANGUAGES = 64  # beyond, each language gives fewer rows, so that the sample on the driver stays bounded
AMBIGUOUS = 0.2  # of the mean loss per bit between the two nearest codewords
UNKNOWN = "und"
_SLICE = 1 << 20  # bytes of one text that are counted at once
_ROWS = 64  # texts counted together

_LETTER = regex.compile(r"\p{L}")
_FOLD = np.full(256, 0x20, dtype=np.uint8)  # ASCII other than letters counts as a space
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _grams(raw: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(n, feature of the n-gram at each position) for n = 1, 2, 3."""
    b = _FOLD[raw].astype(np.uint32)
    if len(b) > 1:  # lower-case the Latin-1 letters too
        capital = np.flatnonzero((b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[1:] != 0x97)) + 1
        b[capital] += 0x20
    code = b * np.uint32(0x9E3779B1)
    shift = np.uint32(32 - BITS)
    yield 1, code >> shift
    code = (code[:-1] ^ (b[1:] + np.uint32(0x1000))) * np.uint32(0x85EBCA77)
    yield 2, code >> shift
    code = (code[:-1] ^ (b[2:] + np.uint32(0x2000))) * np.uint32(0xC2B2AE3D)
    yield 3, code >> shift


def _count(raw: np.ndarray, bounds: np.ndarray, out: np.ndarray) -> None:
    """Add the n-gram counts of texts ``raw[bounds[i]:bounds[i + 1]]`` to the rows of ``out``."""
    rows = len(bounds) - 1
    seg = raw[bounds[0] : bounds[-1]]
    at = np.repeat(np.arange(rows, dtype=np.int64) << BITS, np.diff(bounds))
    ends = bounds[1:] - bounds[0]
    for n, feature in _grams(seg):
        inside = np.ones(len(feature), dtype=bool)
        for back in range(1, n):  # grams that run over a text's end
            stop = ends[(ends - back >= 0) & (ends - back < len(feature))] - back
            inside[stop] = False
        # short texts: the mark may lie before their start, in the text before; positions are per text
        left = np.repeat(ends, np.diff(bounds))[: len(feature)] - np.arange(len(feature))
        inside &= left >= n
        out += np.bincount((at[: len(feature)] + feature)[inside], minlength=rows << BITS).reshape(rows, -1)


def features(column) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, unit-length features) of runs of texts; empty texts are all zero."""
    raw, offsets = textcore.text_buffers(column)
    total, row = len(offsets) - 1, 0
    while row < total:
        stop = int(np.searchsorted(offsets, offsets[row] + _SLICE, side="right")) - 1
        stop = min(max(stop, row + 1), row + _ROWS, total)
        out = np.zeros((stop - row, 1 << BITS))
        if stop == row + 1:  # one text, perhaps a long one: slices that overlap by nothing
            for lo in range(int(offsets[row]), int(offsets[stop]), _SLICE):
                _count(raw, np.array([lo, min(lo + _SLICE, int(offsets[stop]))]), out)
        else:
            _count(raw, offsets[row : stop + 1], out)
        sums = out.sum(axis=1, keepdims=True)
        yield row, np.sqrt(out / np.maximum(sums, 1)).astype(np.float32)
        row = stop


def codewords(n: int) -> np.ndarray:
    """(n, bits) matrix of +1/-1: the exhaustive code up to 5 languages, else the best of seeded random codes."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 5:
        columns = [[1] + [1 if c >> i & 1 else -1 for i in range(n - 1)] for c in range(2 ** (n - 1) - 1)]
        return np.array(columns, dtype=float).T
    bits, rng, best = int(np.ceil(10 * np.log2(n))), np.random.default_rng(17), (-1, None)
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], size=(n, bits))
        apart = (bits - code @ code.T) / 2 + np.eye(n) * bits
        mixed = np.abs(code.sum(axis=0)).max() < n
        if mixed and apart.min() > best[0]:
            best = (apart.min(), code)
    return best[1]


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # features x bits
    bias: np.ndarray
    trust: np.ndarray  # weight of each bit's loss

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Weighted loss of every codeword for each row."""
        margin = x @ self.weights + self.bias
        return np.stack([(np.logaddexp(0, -margin * c) * self.trust).sum(axis=1) for c in self.code], axis=1)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> LanguageModel | None:
    """Model from the labelled rows that are not held out; None when there are none."""
    rows = docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    )

    def extract(batches):
        for batch in batches:
            for first, x in features(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(x)), pa.array([v.astype(np.float16).tobytes() for v in x], pa.binary())],
                    names=["lang", "x"],
                )

    known = rows.select("lang").distinct().count()
    per_language = max(1, min(per_language, per_language * FULL_LANGUAGES // max(1, known)))
    sample = bounded_sample(rows, "lang", per_language, "doc_id").select("lang", "text")
    found = sample.mapInArrow(extract, "lang string, x binary").toPandas().sort_values(["lang", "x"])
    languages = sorted(found["lang"].unique())
    if not languages:
        return None
    x = np.stack([np.frombuffer(v, dtype=np.float16) for v in found["x"]]).astype(np.float32)
    code = codewords(len(languages))
    bits = code[found["lang"].map({k: i for i, k in enumerate(languages)}).to_numpy()] > 0
    weights, bias = fit_logistic(x, bits.astype(float))
    right = (((x @ weights + bias) > 0) == bits).mean(axis=0)
    trust = np.maximum(2 * right - 1, 0.05)
    return LanguageModel(languages, code, weights.astype(np.float32), bias, trust / trust.mean())


def judge(model: LanguageModel | None, column) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, language, score, ambiguous) of runs of texts."""
    for first, x in features(column):
        texts = column.slice(first, len(x)).to_pylist()
        letters = np.array([t is not None and _LETTER.search(t) is not None for t in texts], dtype=bool)
        names, score, unsure = np.full(len(x), UNKNOWN, dtype=object), np.zeros(len(x)), np.ones(len(x), dtype=bool)
        if model is not None:
            loss = model.losses(x)
            order = np.argsort(loss, axis=1, kind="stable")
            score = 1 / np.exp(loss.min(axis=1, keepdims=True) - loss).sum(axis=1)
            names = np.array(model.languages, dtype=object)[order[:, 0]]
            unsure = np.zeros(len(x), dtype=bool)
            if len(model.languages) > 1:
                ranked = np.take_along_axis(loss, order[:, :2], axis=1)
                unsure = ranked[:, 1] - ranked[:, 0] < AMBIGUOUS * loss.mean(axis=1)
        yield first, np.where(letters, names, UNKNOWN), np.where(letters, score, 0.0), np.where(letters, unsure, True)


def predict_language(docs: DataFrame, model: LanguageModel | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) of every row.

    Without a ``model`` one is fitted on the rows themselves.  A null text or
    one without letters is ``und`` with score 0; so is every text when no row
    has a language to learn.  With one language known, all other texts get it.
    Rows with a null id are never learned from and count as held out.  Other
    columns are not read; an empty table gives no rows.
    """
    model = model or fit(docs, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, names, score, unsure in judge(model, batch.column(2)):
                part = batch.slice(first, len(names))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(score), pa.array(unsure)],
                    names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, ambiguous boolean")


def drop_unknown_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the texts that no language fits (``und``), all columns kept.

    With a model these are the texts without letters.  Without one (no row has
    a language to learn) texts with letters are kept as well.
    Judged on each row's own text inside the task, so rows need no id and no
    row is shuffled.
    """
    model = fit(docs, id_col, text_col, lang_col)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                yield batch.filter(pa.array([t is not None and _LETTER.search(t) is not None for t in batch.column(at).to_pylist()], pa.bool_()))
                continue
            for first, names, _, _ in judge(model, batch.column(at)):
                yield batch.slice(first, len(names)).filter(pa.array(names != UNKNOWN))

    return docs.mapInArrow(run, docs.schema)
