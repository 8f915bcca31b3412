import random
import re

from panelcast.llm import substring_dedup as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width):
    """{doc_id: (n_words, removed positions, kept text)}"""
    words = {i: WORD.findall(t or "") for i, t in rows}
    first, gone = {}, {i: set() for i in words}
    for i in sorted(words):
        for s in range(len(words[i]) - width + 1):
            key = tuple(words[i][s : s + width])
            if key in first:
                gone[i].update(range(s, s + width))
            else:
                first[key] = (i, s)
    return {i: (len(w), gone[i], " ".join(x for k, x in enumerate(w) if k not in gone[i])) for i, w in words.items()}


def check(docs, rows, width):
    want = brute(rows, width)
    got = S.substring_dedup(docs, width).collect()
    assert len(got) == len(rows)
    for r in got:
        n, gone, kept = want[r.doc_id]
        positions = {p for s in r.spans for p in range(s["start"], s["end"])}
        assert (r.n_words, positions, r.kept_text) == (n, gone, kept), r.doc_id
        ends = [(s["start"], s["end"]) for s in r.spans]
        assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))  # maximal: spans never touch


def test_matches_brute_force(make_docs):
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for i in range(60):
        words = [rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(rng.randrange(0, 40))]
        if i % 3 == 0:
            at = rng.randrange(0, len(words) + 1)
            words[at:at] = passage[rng.randrange(0, 8) :]
        rows.append((i * 7 % 60, rng.choice([" ", "\n", "\t \x0b"]).join(words)))
    rows += [(100, None), (101, ""), (102, "z " * 200), (103, "z z " * 30), (104, rows[0][1]), (105, rows[0][1].upper())]
    check(make_docs(rows).repartition(5), rows, 5)


def test_blocks_across_flushes_and_unordered_ids(make_docs, monkeypatch):
    monkeypatch.setattr(S, "FLUSH", 50)
    rng = random.Random(4)
    rows = [(500 - i, " ".join(rng.choice(["u", "v", "w"]) for _ in range(30))) for i in range(40)]
    check(make_docs(rows).repartition(3), rows, 6)


def test_repeated_rows_and_null_ids(make_docs):
    text = " ".join(f"w{i}" for i in range(25))
    got = S.substring_dedup(make_docs([(1, text), (1, text), (None, text), (2, text)]))
    removed = sorted((r.doc_id is None, r.doc_id or 0, sum(s["end"] - s["start"] for s in r.spans)) for r in got.collect())
    assert removed == [(False, 1, 0), (False, 1, 0), (False, 2, 25), (True, 0, 25)]


def test_empty_table(make_docs):
    assert S.substring_dedup(make_docs([])).collect() == []
