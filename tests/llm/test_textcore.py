import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelcast.llm import textcore

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab AZ\t\n\x0b\x1f éß中", max_size=60)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(texts, st.integers(1, 80))
def test_words_match_the_regex_at_any_chunk_size(rows, chunk):
    before, textcore.SEGMENT = textcore.SEGMENT, 16
    try:
        got = [None] * len(rows)
        for part in textcore.words(pa.array(rows, pa.string()), chunk=chunk):
            for i in range(len(part.offsets) - 1):
                got[part.first + i] = part.hashes[part.offsets[i] : part.offsets[i + 1]].tolist()
    finally:
        textcore.SEGMENT = before
    want = [[textcore.hash_of(w) for w in WORD.findall(t or "")] for t in rows]
    assert got == want


def test_hashes_tell_long_words_apart():
    stem = "a" * 64
    assert len({textcore.hash_of(stem[:n]) for n in range(1, 65)}) == 64
    assert textcore.hash_of(stem + "b") != textcore.hash_of(stem + "c")


def test_rolling_equals_equal_runs_only():
    values = np.random.default_rng(1).integers(0, 6, 400).astype(np.uint64)
    hashes = textcore.mix(values + np.uint64(1))
    rolled = textcore.rolling(hashes, 3)
    runs = [tuple(values[i : i + 3]) for i in range(len(rolled))]
    assert len(set(zip(runs, rolled.tolist()))) == len(set(runs)) == len(set(rolled.tolist()))


def test_hash_of_rejects_several_words():
    with pytest.raises(ValueError):
        textcore.hash_of("two words")
