import hashlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from panelcast.llm import exact_dedup as E


def lower(text):
    return (text or "").translate(str.maketrans(E.UPPER, E.UPPER.lower()))


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[lower(text)].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[lower(text)]
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256(lower(text).encode()).hexdigest()))
    return Counter(out)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 5), max_size=30), min_size=1, max_size=5))
def test_merged_filters_lose_nothing(parts):
    filters = [E.QuotientFilter.build(np.array(p, dtype=np.uint64)) for p in parts]
    merged = filters[0]
    for f in filters[1:]:
        merged = E.QuotientFilter.from_bytes(merged.merge(f).to_bytes())
    want = Counter(x for p in parts for x in p)
    assert dict(zip(merged.fingerprints().tolist(), merged.counts.tolist())) == dict(want)


def test_groups_match_brute_force(make_docs):
    rows = [(i, f"text {i % 7}".upper() if i % 2 else f"text {i % 7}") for i in range(60)]
    rows += [(100, None), (101, ""), (102, "É"), (103, "é"), (104, "x " * 50000), (105, "X " * 50000)]
    rows += [(5, "text 5"), (None, "text 1"), (None, "only null"), (None, "Only Null"), (106, " ")]
    got = E.exact_groups(make_docs(rows)).collect()
    assert Counter(tuple(r) for r in got) == brute(rows)


def test_candidates_are_only_repeated_fingerprints(spark):
    df = spark.createDataFrame([(v,) for v in (1, -5, 7, 7, -5, -5, 9)], "fp long").repartition(3)
    got = {(r.fp, r.fp_count) for r in E.repeated_fingerprints(df).collect()}
    assert got == {(7, 2), (-5, 3)}


def test_filter_keeps_columns_and_null_ids(make_docs):
    docs = make_docs([(1, "a"), (2, "A"), (None, "a"), (3, "b")])
    got = E.drop_exact_copies(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == [(False, 2), (False, 3), (True, 0)]


def test_empty_table(make_docs):
    assert E.exact_groups(make_docs([])).collect() == []
