"""Substring dedup: repeated fixed-length token windows, merged into removal spans.

Every run of ``width`` consecutive words gets a Rabin-Karp hash.  Spark deals
the hashes out by their high bits, in packed blocks; the task of a hash range
sees all windows with the same hash together, keeps the earliest and reports
the others.  A task sends each hash once only - its own later occurrences are
repeats already - so that a window in a third of all places is one entry per
block.  Per document the reported windows merge into maximal spans.

Hashes have 62 bits or more (the range's bits and 56 of the rest), so that a
false repeat among ``n`` windows has a chance of about n^2 / 2^63.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcore

WIDTH = 20
FLUSH = 1 << 19  # windows that a task holds before it sends its blocks
RANGE_WINDOWS = 4 << 20  # windows meant for one hash range
_NULL_ID = np.iinfo(np.int64).max  # a null id sorts after all others

# a row is a block of windows of one hash range, or (hashes null) a document's repeats found within a task
_BLOCK = "bucket int, n int, hashes binary, doc_ids binary, per_doc binary, steps binary, doc_id long, starts binary"
_REPEAT = "doc_id long, starts binary"


def _planes(values: np.ndarray) -> bytes:
    """Byte planes of fixed-width numbers: equal high bytes compress well in the shuffle."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _unplanes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def _per_document(doc_ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (id, first, end) of each document's run in rows ordered by id and start."""
    cut = np.flatnonzero(np.append(True, doc_ids[1:] != doc_ids[:-1])) if len(doc_ids) else np.zeros(0, int)
    return doc_ids[cut], cut, np.append(cut[1:], len(doc_ids))


def _repeat_batch(doc_ids: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    ids, lo, hi = _per_document(doc_ids, starts)
    starts = starts.astype(np.uint32)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array([starts[a:b].tobytes() for a, b in zip(lo, hi)], pa.binary())],
        names=["doc_id", "starts"],
    )


def _blocks(width: int, bits: int):
    """Map side: packed window blocks per hash range, and repeats within the task."""

    def pack(ids: np.ndarray, rows: np.ndarray, starts: np.ndarray, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        doc = ids[rows]
        if np.any(doc[1:] < doc[:-1]):  # rows in document order, so that an index is an order
            by = np.lexsort((starts, doc))
            doc, starts, hashes = doc[by], starts[by], hashes[by]
        order = np.argsort(hashes)
        ordered = hashes[order]
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        keep = np.minimum.reduceat(order, first)
        if len(keep) < len(hashes):
            # a later place repeats the first one unless it is the same place of a repeated row
            origin = np.empty(len(hashes), dtype=np.int64)
            origin[order] = np.repeat(keep, np.diff(np.append(first, len(order))))
            later = np.flatnonzero((doc != doc[origin]) | (starts != starts[origin]))
            if len(later):
                repeats = _repeat_batch(doc[later], starts[later])
                empty = [pa.nulls(len(repeats), t) for t in (pa.int32(), *[pa.binary()] * 4)]
                spread = pa.array((repeats.column(0).to_numpy() & ((1 << bits) - 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([spread, *empty, *repeats.columns], schema=schema)
        keep = np.sort(keep)
        bucket = (hashes[keep] >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32)
        keep = keep[np.argsort(bucket, kind="stable")]
        bucket = (hashes[keep] >> np.uint64(64 - bits)).astype(np.int32)
        cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        columns: list[list] = [[] for _ in range(6)]
        for a, b in zip(cut, np.append(cut[1:], len(bucket))):
            part = keep[a:b]
            some, lo, hi = _per_document(doc[part], starts[part])
            steps = np.diff(starts[part], prepend=0)
            steps[lo] = starts[part][lo]
            raw = hashes[part].view(np.uint8).reshape(-1, 8)[:, :7]
            values = (
                int(bucket[a]), len(part), np.ascontiguousarray(raw).tobytes(),
                _planes(np.diff(some, prepend=0)), _planes((hi - lo).astype(np.uint32)), _planes(steps.astype(np.uint32)),
            )
            for column, value in zip(columns, values):
                column.append(value)
        arrays = [pa.array(c, t.type) for c, t in zip(columns, schema)]
        yield pa.RecordBatch.from_arrays(
            [*arrays, pa.nulls(len(arrays[0]), pa.int64()), pa.nulls(len(arrays[0]), pa.binary())], schema=schema
        )

    names = [x.split() for x in _BLOCK.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[t]) for n, t in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, starts, hashes, held, docs = [], [], [], [], 0, 0
        for batch in batches:
            batch_ids = batch.column(0).fill_null(_NULL_ID).to_numpy(zero_copy_only=False)
            for part in textcore.words(batch.column(1)):
                counts = np.diff(part.offsets)
                windows = np.maximum(counts - width + 1, 0)
                total = int(windows.sum())
                if not total:
                    continue
                row = np.repeat(np.arange(len(windows), dtype=np.int32), windows)
                start = np.arange(total, dtype=np.int64) - np.repeat(np.cumsum(windows) - windows, windows)
                hashes.append(textcore.rolling(part.hashes, width)[part.offsets[row] + start])
                ids.append(batch_ids[part.first : part.first + len(windows)])
                rows.append(row + np.int32(docs))
                starts.append(start.astype(np.int64))
                docs, held = docs + len(windows), held + total
                if held >= FLUSH:
                    yield from pack(*map(np.concatenate, (ids, rows, starts, hashes)))
                    ids, rows, starts, hashes, held, docs = [], [], [], [], 0, 0
        if held:
            yield from pack(*map(np.concatenate, (ids, rows, starts, hashes)))

    return run


def _later_windows(pdf: pd.DataFrame) -> pd.DataFrame:
    """Windows of one hash range whose hash also occurs earlier."""
    known = pdf["hashes"].isna()
    within = pdf.loc[known, ["doc_id", "starts"]].astype({"doc_id": np.int64})
    hashes, docs, starts = [], [], []
    for block in pdf[~known].itertuples():
        n = int(block.n)
        wide = np.zeros((n, 8), dtype=np.uint8)
        wide[:, :7] = np.frombuffer(block.hashes, dtype=np.uint8).reshape(-1, 7)
        hashes.append(wide.reshape(-1).view(np.uint64))
        per_doc = _unplanes(block.per_doc, np.uint32).astype(np.int64)
        docs.append(np.repeat(np.cumsum(_unplanes(block.doc_ids, np.int64)), per_doc))
        steps = np.cumsum(_unplanes(block.steps, np.uint32).astype(np.int64))
        before = np.cumsum(per_doc) - per_doc  # each document's steps begin anew
        starts.append((steps - np.repeat(np.where(before > 0, steps[before - 1], 0), per_doc)).astype(np.uint32))
    del pdf
    if not hashes:
        return within
    hashes, docs, starts = map(np.concatenate, (hashes, docs, starts))
    order = np.argsort(hashes)
    ordered = hashes[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    size = np.diff(np.append(first, len(order)))
    many = order[np.repeat(size > 1, size)]
    del order, ordered
    if not len(many):
        return within
    hashes, docs, starts = hashes[many], docs[many], starts[many]
    order = np.lexsort((starts, docs, hashes))
    hashes, docs, starts = hashes[order], docs[order], starts[order]
    head = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    origin = np.repeat(head, np.diff(np.append(head, len(hashes))))
    later = (docs != docs[origin]) | (starts != starts[origin])
    docs, starts = docs[later], starts[later]
    order = np.lexsort((starts, docs))
    across = _repeat_batch(docs[order], starts[order]).to_pandas()
    return pd.concat([within, across]) if len(within) else across


def repeated_windows(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, starts): packed uint32 starts of windows whose words also start earlier."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = slim.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    bits = min(24, max(6, int(size // 6 // RANGE_WINDOWS).bit_length()))
    return slim.mapInArrow(_blocks(width, bits), _BLOCK).groupBy("bucket").applyInPandas(_later_windows, _REPEAT)


def _cut_text(width: int):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ("kept_text", pa.large_string()),
        ]
    )

    def one(text: bytes, starts: list[bytes] | None) -> tuple[int, list, bytes]:
        tokens = text.split()  # bytes split at exactly the separators 20, 09-0D
        if not starts:
            return len(tokens), [], b" ".join(tokens)
        edge = np.zeros(len(tokens) + width + 1, dtype=np.int32)
        at = np.unique(np.frombuffer(b"".join(starts), dtype=np.uint32)).astype(np.int64)
        at = at[at + width <= len(tokens)]
        edge[at] += 1
        edge[at + width] -= 1
        gone = np.cumsum(edge[: len(tokens)]) > 0
        step = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
        spans = list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()))
        kept, last = [], 0
        for a, b in [*spans, (len(tokens), len(tokens))]:
            kept.extend(tokens[last:a])
            last = b
        return len(tokens), [{"start": a, "end": b} for a, b in spans], b" ".join(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, len(batch) // max(1, batch.nbytes // textcore.CHUNK))
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                texts = part.column(1).cast(pa.large_binary())
                out = [one(t.as_py() or b"", s) for t, s in zip(texts, part.column(2).to_pylist())]
                counts, spans, kept = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(counts, pa.int64()),
                        pa.array(spans, schema.field("spans").type),
                        pa.array(kept, pa.large_binary()).cast(pa.large_string()),
                    ],
                    schema=schema,
                )

    return run


def substring_dedup(
    docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_words, spans, kept_text): maximal word spans to remove, and the text without them.

    A word goes when a window of ``width`` words covers it whose words also
    start earlier: in a smaller id, or earlier in the same document.  Windows
    are judged on the input.  ``spans`` has word positions [start, end);
    ``kept_text`` has the kept words joined by one space.  Null and empty texts
    have no words; texts shorter than a window lose none.  A null id sorts
    last.  An id names one document: rows that repeat it are never repeats of
    each other at the same place, and share their removals.  Other columns are
    not read; an empty table gives no rows.
    """
    repeats = (
        repeated_windows(docs, width, id_col, text_col)
        .groupBy("doc_id")
        .agg(F.collect_list("starts").alias("__starts"))
        .select(F.col("doc_id").alias("__doc"), "__starts")
    )
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__text"))
    joined = texts.join(repeats, F.coalesce("doc_id", F.lit(int(_NULL_ID))) == F.col("__doc"), "left")
    return joined.select("doc_id", "__text", "__starts").mapInArrow(
        _cut_text(width),
        "doc_id long, n_words long, spans array<struct<start:long,end:long>>, kept_text string",
    )
