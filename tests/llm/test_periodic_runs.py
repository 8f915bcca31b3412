from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelcast.llm import periodic_runs as R


def brute_runs(words, min_length, min_exponent):
    """Every maximal stretch of every period, by comparing all words q apart."""
    n, found = len(words), {}
    for q in range(1, n):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_length, min_exponent * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, length, q) for (s, length), q in found.items())


def collapse(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def runs_of(texts, min_length, min_exponent):
    names = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    codes = np.array([names[w] for t in texts for w in t], dtype=np.int64)
    rows = R.runs_of(codes, np.array([len(t) for t in texts], dtype=np.int64), min_length, min_exponent)
    out = [[] for _ in texts]
    for text, *run in rows.tolist():
        out[text].append(tuple(run))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def periodic(rng, n, letters):
    parts = []
    while sum(map(len, parts)) < n:
        unit = list(rng.choice(letters, rng.integers(1, 9)))
        parts.append((unit * 40)[: rng.integers(1, 60)])
    return [w for p in parts for w in p][:n]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60) | st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=4),
       st.integers(1, 12), st.integers(2, 4))
def test_small_alphabets(texts, min_length, min_exponent):
    assert runs_of(texts, min_length, min_exponent) == [sorted(brute_runs(t, min_length, min_exponent), key=lambda x: (x[0], x[2])) for t in texts]


def test_planted_periods():
    rng = np.random.default_rng(7)
    texts = [periodic(rng, int(n), list("abcde")) for n in rng.integers(0, 500, 40)] + [["a"] * 700, list("ab") * 300 + ["a"] * 90, []]
    for least, times in ((24, 3), (8, 2)):
        assert runs_of(texts, least, times) == [sorted(brute_runs(t, least, times), key=lambda x: (x[0], x[2])) for t in texts]


def test_extensions_are_exact():
    rng = np.random.default_rng(3)
    for letters in (1, 2, 30):
        codes = rng.integers(0, letters, 600)
        codes[300:550] = codes[20:270]
        symbols = np.concatenate([[90], codes, [91]]).astype(np.int64)
        walls = np.isin(symbols, [90, 91])
        levels = R.grammar(symbols, walls)
        a, b = rng.integers(1, 601, (2, 2000))
        a, b = a[a != b], b[a != b]
        want = [next(k for k in range(602) if symbols[x + k] != symbols[y + k]) for x, y in zip(a, b)]
        assert R.extend(levels, a, b).tolist() == want
        assert letters == 1 or len(levels) > 6


def test_find_runs_matches_brute_force(make_docs, monkeypatch):
    monkeypatch.setattr(R, "GROUP_WORDS", 400)
    rng = np.random.default_rng(5)
    texts = [None, "", "  \t\n ", "one", "x " * 500, *[" ".join(periodic(rng, int(n), ["the", "a", "ça"])) for n in rng.integers(10, 400, 25)]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "y\n" * 30), (2, "again " * 24), (2, "again " * 24)]
    got = Counter()
    for r in R.find_runs(make_docs(rows).repartition(3), R.words_of(F.col("text"))).collect():
        got[r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"]] += 1
    want = Counter()
    for doc_id, text in rows:
        words = (text or "").split()
        runs = sorted(brute_runs(words, 24, 3), key=lambda x: (x[0], x[2]))
        want[doc_id, len(words), tuple(runs), collapse(words, runs)] += 1
    assert got == want


def test_strongest_run_and_ties(spark):
    rows = [([],), ([(5, 30, 10), (0, 27, 9)],), ([(0, 24, 2), (9, 36, 3), (9, 24, 2)],), ([(1, 61, 20), (90, 28, 9)],)]
    df = spark.createDataFrame(rows, "runs array<struct<start: long, length: long, period: long>>")
    assert [r[0] and tuple(r[0]) for r in df.select(R.strongest(F.col("runs"))).collect()] == [None, (0, 27, 9), (0, 24, 2), (90, 28, 9)]


def test_empty_table(make_docs):
    assert R.find_runs(make_docs([]), R.words_of(F.col("text"))).count() == 0
