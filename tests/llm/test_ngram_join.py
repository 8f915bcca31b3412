import random
import re

import pytest
from pyspark.sql import functions as F

from panelcast.llm import components, ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed):
    rng = random.Random(seed)
    line = " ".join(f"boiler{i}" for i in range(12))
    rows = []
    for i in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 90))]
        for _ in range(rng.randrange(1, 9)):
            words = list(base)
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(1000)}"
            text = " ".join(words)
            rows.append((len(rows) * 13 % 997, (line + "\n" + text) if rng.random() < 0.5 else text.upper()))
    # a chain: each text is near the next one only
    chain = [f"c{i}" for i in range(60)]
    for k in range(12):
        rows.append((2000 + k, " ".join(chain[k:] + [f"d{i}" for i in range(k)])))
    return rows + [(3000, None), (3001, ""), (3002, "one"), (3003, "ONE"), (3004, "two words"), (3005, line), (3006, line), (3007, "é É")]


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80)])
def test_components_match_brute_force(make_docs, width, percent):
    rows = corpus(width)
    got = ngram_join.jaccard_components(make_docs(rows).repartition(4), width, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, width, percent)
    assert len(got) == len(rows)


def test_large_cluster_of_distinct_near_copies(make_docs):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(150):
        words = list(base)
        words[rng.randrange(80)] = f"edit{i}"
        rows.append((i, " ".join(words)))
    got = ngram_join.jaccard_components(make_docs(rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 4, 85)


def test_near_copies_that_do_not_link_make_few_pairs(make_docs, monkeypatch):
    """150 texts that share most shingles, none linked with all: the exact pass must not make a row for each pair."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(130)]
    rows = []
    for i in range(150):
        words = list(base)
        for k in rng.sample(range(4, 126), 2):
            words[k] = f"edit{i}x{k}"
        rows.append((i, " ".join(words)))
    made, before = [], ngram_join._pairs_apart

    def counted(sides, percent):
        pairs = before(sides, percent)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(ngram_join, "_pairs_apart", counted)
    got = ngram_join.jaccard_components(make_docs(rows)).collect()
    want = brute(rows, 4, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) > 50  # many are alone
    assert len(made) == 1 and made[0] < 20 * len(rows), made  # 150 * 149 / 2 pairs share about ten shingles each


def test_texts_that_share_many_shingles_meet_few_times(make_docs, monkeypatch):
    """Long texts too far apart to link, too long for their parity bits to tell: one row a pair, not one for each shared shingle."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(4000)]
    rows = []
    for i in range(24):
        words = list(base)
        a = 150 * i
        words[a : a + 280] = [f"x{i}y{k}" for k in range(280)]
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(rng.sample(base, 40))) for i in range(10)]
    made, before = [], ngram_join._pairs_apart

    def counted(sides, percent):
        pairs = before(sides, percent)
        made.append((pairs.count(), pairs.select("gid1", "gid2").distinct().count()))
        return pairs

    monkeypatch.setattr(ngram_join, "_pairs_apart", counted)
    got = ngram_join.jaccard_components(make_docs(rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 4, 85)
    (lines, pairs), = made
    assert pairs > 20 and lines < 4 * pairs, made


def test_pairs_that_meet_once_are_all_found(spark):
    """Every two groups of different components that share a shingle are found, whatever earlier shingles they have."""
    rng = random.Random(3)
    sets, root = {}, {}
    for gid in range(1, 121):
        common = [t for t in range(12) if rng.random() < 0.6] if gid % 3 else []
        sets[gid] = set(common) | {rng.randrange(100, 160) for _ in range(rng.randrange(6))} | {1000 + gid % 7}
        root[gid] = gid % 5 and gid
    repeated = {9, 10, 11}  # several groups of one id: each has a part of these shingles
    rows = [(g, t, 500, 0, 0, root[g], root[g] if g % 11 else 500) for g in sets for t in sets[g]]
    frame = spark.createDataFrame(rows, "gid long, token long, n long, pos int, rank int, lo long, hi long")
    several = spark.createDataFrame([(g,) for g in repeated], "gid long")
    sides = ngram_join._with_earlier(frame, several).withColumn("in_main", F.expr("lo = 0 and hi = 0"))
    assert sides.filter("known > 0").count() > 300 and sides.filter("seen > 0").count() > 300
    assert sides.filter("seen > 0").join(several, "gid").count() == 0
    bits = [f"{v}{c}" for v in ("", "v") for c in ngram_join._PARITY_COLUMNS]
    found = ngram_join._pairs_apart(sides.withColumns({c: F.lit(0).cast("long") for c in bits}), 85).collect()
    place = {g: (root[g], root[g] if g % 11 else 500) for g in sets}
    want = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] & sets[b] and not (place[a] == place[b] and place[a][0] == place[a][1])
    ]
    assert {tuple(sorted((r.gid1, r.gid2))) for r in found} == set(want)
    assert len(found) < sum(len(sets[a] & sets[b]) for a, b in want) / 2


def test_links_of_a_repeated_id_with_several_texts(make_docs):
    rng = random.Random(21)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(80):
        words = list(base) if i % 2 else [f"v{k}" if k % 40 else f"w{k}" for k in range(90)]
        for k in rng.sample(range(90), 3):
            words[k] = f"edit{i}x{k}"
        rows.append((i // 2 if i < 40 else i, " ".join(words)))
    parts = brute([(k, t) for k, (_, t) in enumerate(rows)], 4, 85)
    least = {i: i for i, _ in rows}
    for _ in rows:  # ids and texts name each other's components until nothing changes
        best = {}
        for k, (i, _) in enumerate(rows):
            c = parts[k][1]
            best[c] = min(best.get(c, least[i]), least[i])
        least = {i: min(best[parts[k][1]] for k, (j, _) in enumerate(rows) if j == i) for i in least}
    got = ngram_join.jaccard_components(make_docs(rows)).collect()
    assert {(r.doc_id, r.component_id) for r in got} == set(least.items())


def test_groups_of_several_sets_keep_their_links(make_docs):
    """Sets of one prefix and size that differ elsewhere: parity bits that vary within a group decide nothing."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(70)]
    rows = []
    for i in range(60):
        words = list(base)
        a = rng.randrange(4, 60)
        words[a : a + 6] = words[a : a + 6][::-1] if rng.random() < 0.5 else [f"v{rng.randrange(3)}"] * 6
        if rng.random() < 0.5:
            words[rng.randrange(70)] = f"x{rng.randrange(4)}"
        rows.append((i, " ".join(words)))
    for width, percent in ((4, 85), (1, 90)):
        got = ngram_join.jaccard_components(make_docs(rows), width, percent).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, width, percent)


def test_nulls_repeats_and_empty(make_docs):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(4, text), (4, text), (None, text), (7, text), (9, "other words are here now")]
    got = ngram_join.jaccard_components(make_docs(rows)).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (4, 4), (4, 4), (7, 4), (9, 9)]
    assert ngram_join.jaccard_components(make_docs([])).collect() == []
    docs = make_docs(rows)
    kept = ngram_join.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 4, 4, 9]


def test_connected_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(0, 40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    got = components.connected_components(spark.createDataFrame(path + star + [(7, 7)], "a long, b long"))
    assert {r.id: r.root for r in got.collect()} == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
