"""Queries of op11 to op13 against brute force over whole small tables."""

import hashlib
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import sentencepiece
from pyspark.sql import functions as F

from panelcast.llm import queries as Q

from .test_embedding_whitening import brute, same_rows, table
from .test_periodic_runs import brute_runs, collapse

SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def texts(spark, sf_dir):
    return [(r["doc_id"], r["text"]) for r in Q.read(spark, sf_dir, "documents").select("doc_id", "text").collect()]


def repeating(doc_id, text):
    words = (text or "").split()
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_op11(spark, tmp_path, make_docs):
    rows = [r for r in texts(spark, SMALL) if len((r[1] or "").split()) <= 1200]
    assert len(rows) > 150
    rows += [(None, "a b " * 20), (7_000_000, None), (7_000_003, ""), (7_000_004, "\t\n")]
    make_docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    want = Counter()
    for doc_id, text in rows:
        words = repeating(doc_id, text)
        runs = sorted(brute_runs(words, 24, 3), key=lambda r: (r[0], r[2]))
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        want[doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
             sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapse(words, runs))] += 1
    got = Counter(tuple(r) for r in Q.op11_periodic_runs(spark, str(tmp_path)).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect())
    assert got == want
    assert sum(1 for r in want if r[1]) > 15


def test_op12(spark):
    whole = sentencepiece.SentencePieceProcessor(model_file=Q.PIECES)
    want = Counter()
    for doc_id, text in texts(spark, SMALL):
        ids = whole.encode(text or "", add_eos=True)
        want[doc_id, len(ids), sha(" ".join(map(str, ids))), sha(whole.decode(ids))] += 1
    assert Counter(map(tuple, Q.op12_sentencepiece_chunks(spark, SMALL).collect())) == want


def test_op13(spark):
    given = Q.read(spark, SMALL, "embeddings").collect()
    want, n, shares = brute([(r["vec_id"], r["embedding"]) for r in given])
    same_rows(Q.op13_whitening_feast(spark, SMALL).collect(), want, n, shares)
