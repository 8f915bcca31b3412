import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from panelcast.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    sized = [(i, s, len(WORD.findall(t or ""))) for i, t, s in rows]
    sources = sorted({s for _, s, _ in sized}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(n for _, x, n in sized if x == s) for s in sources}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}
    capped: set = set()
    while True:
        rest = 1.5 * sum(total.values()) - sum(2 * total[s] for s in capped)
        free = sum(weight[s] for s in sources if s not in capped)
        level = rest / free if free else 0.0
        more = {s for s in sources if 2 * total[s] <= weight[s] * level} | capped
        if more == capped:
            break
        capped = more
    target = {s: float(2 * total[s]) if s in capped else weight[s] * level for s in sources}
    out = []
    for source in sources:
        docs = [(hashlib.md5(("null" if i is None else str(i)).encode()).hexdigest(), i is not None, i or 0, n) for i, s, n in sized if s == source]
        left = int(target[source])
        epochs, rest = divmod(left, total[source]) if total[source] else (0, 0)
        for _, known, i, n in sorted(docs):
            cut = min(n, max(0, rest))
            rest -= n
            out.append((i if known else None, n, source, total[source], round(target[source], 6), epochs * n + cut))
    return Counter(out)


def rows_of(mix):
    cols = mix.select("doc_id", "size", "source", "source_size", F.round("target", 6).alias("t"), "taken")
    return Counter(tuple(r) for r in cols.collect())


def test_matches_brute_force(make_docs):
    rows = []
    for i in range(300):
        source = "hot" if i % 3 == 0 else ("é" if i % 7 == 0 else (None if i % 11 == 0 else f"s{i % 5}"))
        rows.append((i, " ".join(["w"] * (i % 23)), source))
    rows += [(1000, None, "s1"), (1001, "", "empty"), (1002, "w " * 5000, "s2"), (None, "a b c", "s3"), (5, "a b", "s0"), (5, "a b", "s0")]
    docs = make_docs([(i, t, "en", s) for i, t, s in rows]).repartition(6)
    mix = mixing.mix_sources(docs)
    assert rows_of(mix) == brute(rows)
    per_source = {r.source: (r.taken, r.target) for r in mix.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()}
    assert all(taken == int(target) for taken, target in per_source.values())
    assert mix.filter("taken > 2 * size").count() == 0


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (2, None, "b")], [(1, "a b", "s")]])
def test_small_and_empty_tables(make_docs, rows):
    mix = mixing.mix_sources(make_docs([(i, t, "en", s) for i, t, s in rows]))
    assert rows_of(mix) == brute(rows)


def test_mixed_documents_keep_columns(make_docs):
    docs = make_docs([(i, "w " * (i + 1), "en", "a" if i % 2 else None) for i in range(20)])
    mixed = mixing.mix_documents(docs)
    assert set(mixed.columns) == set(docs.columns)
    want = {r.doc_id: r.taken for r in mixing.mix_sources(docs).collect() if r.taken}
    assert {r.doc_id: r.mix_taken for r in mixed.collect()} == want
