"""Vectorised word hashing over Arrow string columns.

Words are ``[^\\x20\\x09-\\x0D]+`` on the UTF-8 bytes (the separators are ASCII,
so byte and character splitting agree).  Work runs on whole Arrow buffers in
bounded segments; a long text is cut at separators, never inside a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 20  # bytes hashed at once
CHUNK = 2 << 20  # bytes of text handed out at once (or one longer text)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)

# odd 64-bit multipliers: word mixing, and the base of the rolling polynomial
_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xD6E8FEB86659FD93)
_BASE = 0xC6A4A7935BD1E995
_BASE_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(32))
    x = x * _M1
    x ^= x >> np.uint64(29)
    x = x * _M2
    x ^= x >> np.uint64(32)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, dtype=np.uint64)
    step = base
    while len(out) < n:  # doubling: out ++ out * base^len
        out = np.concatenate([out, out * np.uint64(step)])
        step = step * step % (1 << 64)
    return out[:n]


_POW: dict[str, np.ndarray] = {}


def _table(name: str, base: int, n: int) -> np.ndarray:
    if name not in _POW or len(_POW[name]) < n:
        _POW[name] = _powers(base, 1 << max(16, int(n - 1).bit_length()))
    return _POW[name]


def _word_bounds(seg: np.ndarray, cuts: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of every word; ``cuts`` are text starts."""
    ink = ~space[seg]
    start = ink.copy()
    start[1:] &= ~ink[:-1]
    cuts = cuts[cuts < len(seg)]
    start[cuts] = ink[cuts]
    end = np.zeros(len(seg) + 1, dtype=bool)
    end[1:] = ink
    end[1:-1] &= ~ink[1:] | start[1:]
    return np.flatnonzero(start), np.flatnonzero(end)


def _hash_words(seg: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, eight bytes at a time."""
    padded = np.zeros(len(seg) + 8, dtype=np.uint8)
    padded[: len(seg)] = seg
    lanes = np.ndarray(shape=(len(seg) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    length = ends - starts
    h = mix(length.astype(np.uint64) ^ (lanes[starts] & _MASK[np.minimum(length, 8)]))
    done, rest = 8, np.flatnonzero(length > 8)
    while len(rest):
        left = length[rest] - done
        lane = lanes[starts[rest] + done] & _MASK[np.minimum(left, 8)]
        h[rest] = mix(h[rest] * _M2 ^ lane)
        done += 8
        rest = rest[left > 8]
    return h


def hash_spans(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64-bit hash of each of the spans that ``offsets`` cut from ``raw``; an empty span has one too."""
    return _hash_words(raw, offsets[:-1], offsets[1:])


def _segments(raw: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int]]:
    while hi - lo > SEGMENT:
        end = lo + SEGMENT
        window = np.flatnonzero(_SPACE[raw[lo:end]])
        if len(window):
            end = lo + int(window[-1]) + 1
        else:  # one word longer than a segment: go on to its end
            while end < hi and not _SPACE[raw[end]]:
                end += 1
        yield lo, end
        lo = end
    if lo < hi:
        yield lo, hi


@dataclass
class Words:
    """Word hashes of consecutive texts: text ``i`` owns ``hashes[offsets[i]:offsets[i + 1]]``."""

    first: int
    hashes: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray  # byte positions in ``raw``
    ends: np.ndarray
    raw: np.ndarray
    lower: bool

    def leading_bytes(self) -> np.ndarray:
        """First eight bytes of each word as a little-endian number, zeros after its end."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        lo = int(self.starts[0])
        seg = self.raw[lo : int(self.ends[-1])]
        padded = np.zeros(len(seg) + 8, dtype=np.uint8)
        padded[: len(seg)] = _LOWER[seg] if self.lower else seg
        lanes = np.ndarray(shape=(len(seg) + 1,), dtype="<u8", buffer=padded, strides=(1,))
        return lanes[self.starts - lo] & _MASK[np.minimum(self.ends - self.starts, 8)]


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, offsets


def words(column, lower: bool = False, chunk: int = CHUNK, space: np.ndarray = _SPACE) -> Iterator[Words]:
    """Hashes of all words of all texts, whole texts in bounded runs of rows.

    ``space`` marks the bytes that separate words; ASCII white space must be in it.
    """
    if not len(column):
        return
    raw, offsets = text_buffers(column)
    row = 0
    while row < len(offsets) - 1:
        stop = int(np.searchsorted(offsets, offsets[row] + chunk, side="right")) - 1
        stop = max(stop, row + 1)
        lo, hi = int(offsets[row]), int(offsets[stop])
        bounds = offsets[row : stop + 1]
        parts, places, stops = [], [], []
        for a, b in _segments(raw, lo, hi):
            seg = _LOWER[raw[a:b]] if lower else raw[a:b]
            cuts = bounds[(bounds >= a) & (bounds < b)] - a
            s, e = _word_bounds(seg, cuts, space)
            parts.append(_hash_words(seg, s, e))
            places.append(s + a)
            stops.append(e + a)
        hashes = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
        at = np.concatenate(places) if places else np.zeros(0, dtype=np.int64)
        ends = np.concatenate(stops) if stops else np.zeros(0, dtype=np.int64)
        yield Words(row, hashes, np.searchsorted(at, bounds), at, ends, raw, lower)
        row = stop


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of each run of ``width`` consecutive word hashes.

    ``H_i = sum_j h[i + j] * B^j mod 2^64`` from prefix sums; runs that cross a
    text boundary are the caller's to leave out.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * _table("pow", _BASE, len(hashes))[: len(hashes)], out=total[1:])
    return mix((total[width:] - total[:n]) * _table("inv", _BASE_INV, n)[:n])


def hash_of(word: str) -> int:
    """Hash of one word, as ``words`` computes it."""
    part = next(words(pa.array([word], pa.large_string())))
    if len(part.hashes) != 1:
        raise ValueError(f"not a single word: {word!r}")
    return int(part.hashes[0])
