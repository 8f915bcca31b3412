"""Exact dedup with counting quotient filters, merged losslessly in Spark.

A 64-bit fingerprint splits into a quotient (its high bits: the slot) and a
remainder.  Each input partition builds one counting quotient filter per
quotient range and sends it as a block; all filters of a range meet in one
task, where they merge by their sorted remainders, counts added.  Fingerprints
that a merged filter counts more than once are only candidates: their rows go
on to a comparison of the texts' bytes, all other rows are unique at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_stage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RANGE_BITS = 12  # quotient ranges: 4096 blocks, about 60 MB each at 3e10 documents
FLUSH = 1 << 20  # fingerprints that a task holds before it sends its filters


@dataclass
class QuotientFilter:
    """Counting quotient filter of one quotient range.

    ``occupied`` has the quotients in use in ascending order and ``run_end``
    the end of each one's run in ``remainders``, which ascend within a run;
    ``counts`` are the multiplicities.  Quotient and remainder together are the
    whole fingerprint, so nothing is lost in building, sending or merging.
    """

    occupied: np.ndarray
    run_end: np.ndarray
    remainders: np.ndarray
    counts: np.ndarray

    QUOTIENT_BITS = 32  # high half of the fingerprint, its range bits included

    @classmethod
    def of_sorted(cls, fingerprints: np.ndarray, counts: np.ndarray) -> QuotientFilter:
        """Filter of strictly ascending fingerprints."""
        quotient = (fingerprints >> np.uint64(32)).astype(np.uint32)
        last = np.flatnonzero(np.append(quotient[1:] != quotient[:-1], True)) if len(quotient) else np.zeros(0, int)
        return cls(
            quotient[last],
            (last + 1).astype(np.uint32),
            (fingerprints & np.uint64(0xFFFFFFFF)).astype(np.uint32),
            counts.astype(np.uint64),
        )

    def fingerprints(self) -> np.ndarray:
        """All fingerprints in ascending order."""
        runs = np.diff(self.run_end.astype(np.int64), prepend=0)
        return (np.repeat(self.occupied.astype(np.uint64), runs) << np.uint64(32)) | self.remainders

    def merge(self, other: QuotientFilter) -> QuotientFilter:
        """Sorted merge of both remainder sequences; equal entries add their counts."""
        return QuotientFilter.build(
            np.concatenate([self.fingerprints(), other.fingerprints()]),
            np.concatenate([self.counts, other.counts]),
        )

    @classmethod
    def build(cls, fingerprints: np.ndarray, counts: np.ndarray | None = None) -> QuotientFilter:
        """Filter of any fingerprints, repeats allowed."""
        if counts is None:
            values, counts = np.unique(fingerprints, return_counts=True)
            return cls.of_sorted(values, counts)
        order = np.argsort(fingerprints, kind="stable")  # runs already sorted: a merge
        values, counts = fingerprints[order], counts[order]
        first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, int)
        return cls.of_sorted(values[first], np.add.reduceat(counts, first) if len(first) else counts)

    def to_bytes(self) -> bytes:
        head = np.array([len(self.occupied), len(self.remainders)], dtype=np.uint64)
        return b"".join(x.tobytes() for x in (head, self.occupied, self.run_end, self.remainders, self.counts))

    @classmethod
    def from_bytes(cls, data: bytes) -> QuotientFilter:
        slots, entries = (int(x) for x in np.frombuffer(data, dtype=np.uint64, count=2))
        at, parts = 16, []
        for n, kind in ((slots, np.uint32), (slots, np.uint32), (entries, np.uint32), (entries, np.uint64)):
            parts.append(np.frombuffer(data, dtype=kind, count=n, offset=at))
            at += n * np.dtype(kind).itemsize
        return cls(*parts)


def _partition_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One filter per quotient range of what this task has read."""

    def blocks(parts: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        ranges = (values >> np.uint64(64 - RANGE_BITS)).astype(np.int32)
        cut = np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1]))
        ends = np.append(cut[1:], len(values))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ranges[cut]),
                pa.array([QuotientFilter.of_sorted(values[a:b], counts[a:b]).to_bytes() for a, b in zip(cut, ends)], pa.binary()),
            ],
            names=["range", "filter"],
        )

    held: list[np.ndarray] = []
    for batch in batches:
        held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
        if sum(map(len, held)) >= FLUSH:
            yield blocks(held)
            held = []
    if sum(map(len, held)):
        yield blocks(held)


def _merge_range(pdf: pd.DataFrame) -> pd.DataFrame:
    """Merged filter of one range; its fingerprints with a count above one."""
    filters = [QuotientFilter.from_bytes(x) for x in pdf["filter"]]
    while len(filters) > 1:  # a tree of pairwise sorted merges
        filters = [a.merge(b) for a, b in zip(filters[::2], filters[1::2])] + filters[len(filters) // 2 * 2 :]
    values, counts = filters[0].fingerprints(), filters[0].counts
    more = counts > 1
    return pd.DataFrame({"fp": values[more].view(np.int64), "fp_count": counts[more].astype(np.int64)})


def repeated_fingerprints(fingerprints: DataFrame) -> DataFrame:
    """(fp, fp_count) of every 64-bit fingerprint in the one column that occurs more than once."""
    return (
        fingerprints.mapInArrow(_partition_filters, "range int, filter binary")
        .groupBy("range")
        .applyInPandas(_merge_range, "fp long, fp_count long")
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its group of equal texts and the row that stays.

    Texts are equal when identical after lower-casing A-Z only; null counts as
    empty, so null and empty texts are one group.  The largest id stays.  Rows
    that repeat an id are the same document: each counts in ``group_size`` and
    has the same ``kept``.  A null id never stays before a real one; where a
    group has only null ids, ``keep_id`` is null and ``kept`` true.  Other
    columns are not read.  An empty table gives no rows.
    """
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, UPPER.lower())
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("norm"))
    slim = write_stage(
        docs.select(
            "doc_id",
            F.xxhash64("norm").alias("fp"),
            F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"),
        ),
        "exact-slim",
    )
    candidates = write_stage(repeated_fingerprints(slim.select("fp")).select("fp"), "exact-candidates")
    # byte verification: only rows of repeated fingerprints, grouped by the text itself
    texts = (
        docs.withColumn("fp", F.xxhash64("norm"))
        .join(candidates, "fp", "left_semi")
        .groupBy("fp", "norm")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("fp", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"), "keep_id", "group_size")
    )
    groups = (
        texts.groupBy("fp", "sha")
        .agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.count("*").alias("texts"))
        .filter((F.col("group_size") > 1) | (F.col("texts") > 1))
        .withColumn(
            "group_size",
            F.when(F.col("texts") == 1, F.col("group_size")).otherwise(
                F.raise_error(F.lit("two texts share both fingerprint and SHA-256")).cast("long")
            ),
        )
        .select("fp", "sha", "keep_id", "group_size")
    )
    groups = write_stage(groups, "exact-groups")
    return slim.join(groups, ["fp", "sha"], "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`exact_groups` marks as dropped, all columns kept.

    Rows with a null id are kept: no other table can name them.
    """
    dropped = write_stage(
        exact_groups(docs, id_col, text_col)
        .filter(~F.col("kept") & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").alias("__dropped"))
        .distinct(),
        "exact-dropped",
    )
    return docs.join(dropped, docs[id_col].cast("long") == dropped["__dropped"], "left_anti")
