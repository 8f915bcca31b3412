from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from panelcast.llm import sentencepiece_chunks as S

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = open(PATH, "rb").read()
WHOLE = sentencepiece.SentencePieceProcessor(model_file=PATH)
TEXTS = [
    None, "", " ", "  ", "a", "a ", " a", "  two  spaces   ", "a▁b ▁ c", "▁", "tab\tnew\n\nline\r\n", " x", "ﬁne ①",
    "<s>a</s> <unk> <0x0A>", "日本語テキスト", "a​b ퟿ 😀👩‍👩‍👧", "nul\x00 char", "x" * 5000, "ab " * 4000, "� ﻿", "é é",
]


def brute(rows):
    out = []
    for doc_id, text in rows:
        ids = WHOLE.encode(text or "", add_eos=True)
        out.append((doc_id, tuple(ids), WHOLE.decode(ids)))
    return Counter(out)


def encoded(df, **kw):
    return Counter((r[0], tuple(r["ids"]), r["decoded"]) for r in S.encode(df, MODEL, **kw).collect())


def test_matches_the_library(make_docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3, "twice"), (3, "twice"), (3, None)]
    assert encoded(make_docs(rows).repartition(3)) == brute(rows)


def test_small_blocks_and_tables_give_the_same(make_docs, spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(["the", "Ω-word", "longer", "x" * 300, "ça", "1234"], 30))) for i in range(40)]
    monkeypatch.setattr(S, "BLOCK_BYTES", 500)
    monkeypatch.setattr(S, "TABLE_BYTES", 300)
    monkeypatch.setattr(S, "SPREAD", 4)
    assert encoded(make_docs(rows).repartition(4)) == brute(rows)


def test_empty_table(make_docs):
    out = S.encode(make_docs([]), MODEL)
    assert out.columns == ["doc_id", "ids", "decoded"] and out.count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab e▁\t\n日😀1.<> \x00"), max_size=40))
def test_chunks_are_segmented_on_their_own(text):
    pieces = S.Segmenter.of(MODEL)
    chunks, counts = S.cut(pa.array(["", text, ""], pa.large_string()))
    assert counts.tolist() == [0, len(chunks), 0]
    parts = pieces.encode(chunks.to_pylist())
    ids = [i for p in parts for i in p]
    assert ids == WHOLE.encode(text)
    assert "".join(pieces.surfaces(parts))[1:] == WHOLE.decode(ids)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**40) | st.integers(0, 300), max_size=50))
def test_numbers_come_back(values):
    z = S._Zip()
    assert z.read_numbers(z.numbers(np.array(values, dtype=np.int64))).tolist() == values


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), min_size=1, max_size=6), min_size=1, max_size=8), st.lists(st.integers(1, 4), min_size=1, max_size=5))
def test_chunks_and_places_come_back(places, spaces):
    z = S._Zip()
    chunks = [" " * n + w for n in spaces for w in ("", "a", "é\n", "x\x00")]
    assert z.read_chunks(z.chunks(chunks)) == chunks
    firsts = np.cumsum([p[0] for p in places])  # chunks come in the order of their first places
    full = [np.cumsum([f, *[x + 1 for x in p[1:]]]) for f, p in zip(firsts, places)]
    hits = np.array([len(p) for p in full])
    flat = np.concatenate(full)
    assert S._places(S._steps(flat, np.cumsum(hits) - hits), hits).tolist() == flat.tolist()


def test_other_models_are_refused():
    spec = S.proto.ModelProto()
    spec.ParseFromString(MODEL)
    spec.pieces[5000].piece = f"a{S.MARK}b"
    with pytest.raises(ValueError):
        S.check_model(spec.SerializeToString())
