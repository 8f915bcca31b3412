"""Periodic runs of words by recompression.

A run is a stretch of consecutive words with smallest period q, at least
``min_exponent`` periods and ``min_length`` words long, that no neighbouring
word extends.

*Grammar.*  The word sequence of a group of texts is rewritten level by level:
block compression turns every maximal block ``a a ... a`` into one symbol
(a, k); pair compression deals the symbols into left and right ones and turns
every "left right" into one symbol.  Both look at neighbours only, so equal
stretches are rewritten equally but for their ends, and each pair of levels
shortens the sequence by a constant factor.  The levels, with the block lengths
kept as run lengths, form a run-length grammar.  A unique wall symbol between
texts is never rewritten, so nothing reaches across texts.

*Extensions.*  The longest common extension of two places climbs the levels
while both places begin a symbol of the next level and symbols agree, then
descends from the first difference: at most three steps a level, blocks
crossed by their run lengths.  Many pairs of places are answered together.  The
same levels read from the other end give backward extensions.

*Candidates.*  A run of period q holds ``length - q`` consecutive places i with
word i = word i + q, so every multiple of ``max(min_length - q,
(min_exponent - 1) q)`` is tried: n ln n places in all for a text of n words.
Forward and backward extension give the exact ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 24
MIN_EXPONENT = 3
GROUP_WORDS = 1 << 18  # words of whole texts rewritten together, or one longer text
PARTITIONS = 4  # left/right dealings tried per level, the one with most pairs is taken
TOP_SYMBOLS = 4  # symbols of a text at which rewriting ends

_ODD = np.uint64(0x9E3779B97F4A7C15)


# ---- grammar -------------------------------------------------------------------------------
@dataclass
class Level:
    """One sequence and its grouping into the symbols of the next level, read in one direction."""

    symbols: np.ndarray
    parent: np.ndarray | None = None  # place in the next level's sequence
    begin: np.ndarray | None = None  # first place of each group, one more at the end
    blocks: bool = False

    def starts(self, at: np.ndarray) -> np.ndarray:
        return self.begin[self.parent[at]] == at

    def rest(self, at: np.ndarray) -> np.ndarray:
        return self.begin[self.parent[at] + 1] - at

    def backward(self) -> Level:
        if self.parent is None:
            return Level(self.symbols[::-1])
        n, groups = len(self.symbols), len(self.begin) - 1
        return Level(self.symbols[::-1], groups - 1 - self.parent[::-1], n - self.begin[::-1], self.blocks)


def _grouped(symbols: np.ndarray, head: np.ndarray, names: np.ndarray, walls: np.ndarray, blocks: bool):
    """The level of ``symbols`` with groups that begin at ``head``, and the next sequence."""
    begin = np.flatnonzero(head)
    level = Level(symbols, np.cumsum(head) - 1, np.append(begin, len(symbols)), blocks)
    return level, pd.factorize(names)[0].astype(np.int64), walls[begin]


def _sides(symbols: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (symbols.astype(np.uint64) + np.uint64(seed + 1)) * _ODD
        x = (x ^ (x >> np.uint64(29))) * _ODD
    return (x >> np.uint64(40)) & np.uint64(1) == 1


def grammar(symbols: np.ndarray, walls: np.ndarray) -> list[Level]:
    """Levels of a sequence; ``walls`` marks the places of unique symbols between texts.

    Level 0 is the sequence itself; the last one has no grouping.
    """
    levels = []
    while True:
        at = np.flatnonzero(walls)
        if np.diff(at).max(initial=0) - 1 <= TOP_SYMBOLS:
            return [*levels, Level(symbols)]
        head = np.append(True, symbols[1:] != symbols[:-1])
        if not head.all():
            begin = np.flatnonzero(head)
            times = np.diff(np.append(begin, len(symbols)))
            level, symbols, walls = _grouped(symbols, head, symbols[begin] * (int(times.max()) + 1) + times, walls, True)
            levels.append(level)
        best = np.zeros(len(symbols), dtype=bool)
        free = ~walls[1:] & ~walls[:-1]
        for seed in range(PARTITIONS):
            left = _sides(symbols, seed + PARTITIONS * len(levels))
            joined = np.append(False, left[:-1] & ~left[1:] & free)  # second symbols of pairs
            if joined.sum() > best.sum():
                best = joined
        begin = np.flatnonzero(~best)
        second = np.append(best[1:], False)[begin]
        names = symbols[begin] * (int(symbols.max()) + 2)
        names[second] += symbols[np.minimum(begin + 1, len(symbols) - 1)[second]] + 1
        level, symbols, walls = _grouped(symbols, ~best, names, walls, False)
        levels.append(level)


def extend(levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal symbols of level 0 from places ``a`` and ``b`` on (a != b, a wall after each text)."""
    begin_a, a, b = a, a.copy(), b.copy()
    top = len(levels) - 1
    stopped = np.full(len(a), top)  # level of the first difference
    alive = np.arange(len(a))
    for h, level in enumerate(levels[:-1]):
        climbing, here = [], alive
        while len(here):
            p, q = a[here], b[here]
            both = level.starts(p) & level.starts(q)
            climbing.append(here[both])
            here, p, q = here[~both], p[~both], q[~both]
            same = level.symbols[p] == level.symbols[q]
            stopped[here[~same]] = h
            here, p, q = here[same], p[same], q[same]
            step = np.minimum(level.rest(p), level.rest(q)) if level.blocks else 1
            a[here], b[here] = p + step, q + step
        alive = np.concatenate(climbing) if climbing else alive[:0]
        a[alive], b[alive] = level.parent[a[alive]], level.parent[b[alive]]
        if not len(alive):
            break
    last = levels[top].symbols
    while len(alive):
        alive = alive[last[a[alive]] == last[b[alive]]]
        a[alive] += 1
        b[alive] += 1
    for h in range(top - 1, -1, -1):
        level, here = levels[h], np.flatnonzero(stopped > h)
        p, q = level.begin[a[here]], level.begin[b[here]]
        same = level.symbols[p] == level.symbols[q]
        step = np.minimum(level.rest(p), level.rest(q)) if level.blocks else 1
        a[here], b[here] = p + same * step, q + same * step
    return a - begin_a


# ---- runs ----------------------------------------------------------------------------------
@lru_cache(maxsize=512)
def _grid(n: int, min_length: int, min_exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods to try in a text of n words."""
    period = np.arange(1, n // min_exponent + 1 if n >= min_length else 1)
    step = np.maximum(min_length - period, (min_exponent - 1) * period)
    count = (n - period + step - 1) // step
    first = np.cumsum(count) - count
    place = (np.arange(count.sum()) - np.repeat(first, count)) * np.repeat(step, count)
    return place, np.repeat(period, count)


def _candidates(codes: np.ndarray, start: np.ndarray, sizes: np.ndarray, min_length: int, min_exponent: int):
    places, periods = [], []
    for base, n in zip(start, sizes):
        if n < min_length:
            continue
        place, period = (_grid if n <= 4096 else _grid.__wrapped__)(int(n), min_length, min_exponent)
        here = codes[base : base + n]
        hit = here[place] == here[place + period]
        places.append(place[hit] + base)
        periods.append(period[hit])
    if not places:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(places), np.concatenate(periods)


def runs_of(codes: np.ndarray, sizes: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, in order, of consecutive texts of ``sizes`` words."""
    texts = len(sizes)
    # a wall before, between and after the texts
    until = np.cumsum(sizes)
    start = until - sizes + np.arange(texts) + 1
    total = int(sizes.sum()) + texts + 1
    walls = np.ones(total, dtype=bool)
    walls[np.arange(int(sizes.sum())) + np.repeat(np.arange(texts) + 1, sizes)] = False
    symbols = np.empty(total, dtype=np.int64)
    symbols[~walls] = codes
    symbols[walls] = codes.max(initial=0) + 1 + np.arange(texts + 1)
    place, period = _candidates(symbols, start, sizes, min_length, min_exponent)
    if not len(place):
        return np.zeros((0, 4), dtype=np.int64)
    forth = grammar(symbols, walls)
    ahead = extend(forth, place, place + period)
    behind = extend([level.backward() for level in forth], total - place, total - place - period)
    length = ahead + behind + period
    long = length >= np.maximum(min_length, min_exponent * period)
    begin, length, period = (place - behind)[long], length[long], period[long]
    order = np.lexsort((period, length, begin))
    begin, length, period = begin[order], length[order], period[order]
    # equal ends: the smallest period is the stretch's own, others are its multiples
    new = np.append(True, (begin[1:] != begin[:-1]) | (length[1:] != length[:-1]))[: len(begin)]
    begin, length, period = begin[new], length[new], period[new]
    text = np.searchsorted(start, begin, side="right") - 1
    out = np.stack([text, begin - start[text], length, period], axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _groups(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    first, words = 0, 0
    for i, n in enumerate(sizes):
        if words and words + n > most:
            yield first, i
            first, words = i, 0
        words += int(n)
    if first < len(sizes):
        yield first, len(sizes)


def _finder(min_length: int, min_exponent: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = batch.column(1).offsets.to_numpy().astype(np.int64)
            for a, b in _groups(np.diff(offsets), most):
                sizes, words = np.diff(offsets[a : b + 1]), batch.column(1).values.slice(offsets[a], offsets[b] - offsets[a])
                codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
                found = runs_of(codes, sizes, min_length, min_exponent)
                local = np.concatenate([[0], np.cumsum(sizes)])
                # dropped words: the union of each run after its first period
                edge = np.zeros(len(codes) + 1, dtype=np.int64)
                np.add.at(edge, local[found[:, 0]] + found[:, 1] + found[:, 3], 1)
                np.add.at(edge, local[found[:, 0]] + found[:, 1] + found[:, 2], -1)
                kept = np.cumsum(edge[:-1]) == 0
                left = np.concatenate([[0], np.cumsum(kept)])[local]
                texts = pa.ListArray.from_arrays(pa.array(left, pa.int32()), words.filter(pa.array(kept)))
                runs = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in (1, 2, 3)], names=["start", "length", "period"])
                bounds = np.searchsorted(found[:, 0], np.arange(len(sizes) + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(sizes), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs),
                     pc.binary_join(texts, " ")],
                    names=["id", "n_words", "runs", "collapsed"])

    return run


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def find_runs(
    docs: DataFrame, words: Column, id_col: str = "doc_id", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> DataFrame:
    """(``id_col``, n_words, runs array<struct<start, length, period>>, collapsed) for every row.

    ``words`` is an array of words (``words_of`` gives those of a text); a null
    array counts as empty, null words are left out.  ``runs`` are
    ordered by start, then period.  ``collapsed`` has the words kept, joined by
    one space: a word goes if any run contains it after that run's first period.
    Rows are independent: null and repeated ids keep theirs, other columns are
    left out, an empty table gives an empty result.
    """
    if min_exponent < 2 or min_length < 1:
        raise ValueError("a run has at least two periods and one word")
    known = F.filter(F.coalesce(words, F.array().cast("array<string>")), lambda w: w.isNotNull())
    given = docs.select(F.col(id_col).alias("id"), known.alias("words"))
    kind = given.schema["id"].dataType.simpleString()
    out = given.mapInArrow(
        _finder(min_length, min_exponent, GROUP_WORDS),
        f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return out.withColumnRenamed("id", id_col)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period, then smallest start and period; null without runs."""
    def better(best, r):
        mine, its = r["length"] * best["period"], best["length"] * r["period"]
        first = (mine == its) & ((r["start"] < best["start"]) | ((r["start"] == best["start"]) & (r["period"] < best["period"])))
        return F.when((mine > its) | first, r).otherwise(best)

    return F.when(F.size(runs) > 0, F.aggregate(runs, F.get(runs, F.lit(0)), better))
