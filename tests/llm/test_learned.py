"""Held-out accuracy of the learned scorers, and their edge cases."""

import zlib

import numpy as np
import pytest

from panelcast.llm import language_id, learning, quality_fm, queries, toxicity

SF = "/root/testdata/sf0.01"


def joined(result, labels, key, value):
    known = {r[key]: r[value] for r in labels.collect() if r[value] is not None}
    return [(r, known[r[key]]) for r in result.collect() if r[key] in known]


def test_language_held_out_accuracy_and_folds(spark):
    docs = queries.read(spark, SF, "documents")
    rows = joined(queries.op6_language_id(spark, SF), docs, "doc_id", "lang")
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r, _ in rows)
    held = [r.lang_pred == want for r, want in rows if r.held_out]
    assert len(held) > 100 and np.mean(held) > 0.97
    assert all(0 <= r.score <= 1 for r, _ in rows)


def test_quality_held_out_accuracy(spark):
    rows = joined(queries.op10_quality_fm(spark, SF), queries.read(spark, SF, "labels"), "doc_id", "quality")
    held = [(r.predicted, want) for r, want in rows if r.held_out]
    assert np.mean([p == w for p, w in held]) > 0.93
    assert all(r.predicted == int(r.score >= 0.3) for r, _ in rows)


def test_toxicity_held_out_precision(spark):
    rows = joined(queries.op5_toxicity(spark, SF), queries.read(spark, SF, "labels"), "doc_id", "toxic")
    held = [(r.predicted, want) for r, want in rows if r.held_out]
    assert sum(p for p, w in held if w == 0) <= 1
    assert sum(p for p, w in held if w == 1) >= 0.5 * sum(w for _, w in held)


def test_scores_never_see_labels_of_held_out_rows(spark, make_docs):
    """Contradicting labels in fold 0 change nothing."""
    docs = make_docs([(i, ("you idiot " if i % 2 else "fine day ") * 5) for i in range(60)])
    fold0 = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 0]
    first = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    other = spark.createDataFrame([(i, 1 - i % 2 if i in fold0 else i % 2) for i in range(60)], "doc_id long, toxic int")
    a, b = (sorted(map(tuple, toxicity.score_toxicity(docs, x).collect())) for x in (first, other))
    assert a == b and all(row[3] == row[0] % 2 for row in a)


def test_edge_rows_of_all_scorers(spark, make_docs):
    rows = [(i, ("der hund und die katze " if i % 2 else "the dog and the cat ") * 8, "de" if i % 2 else "en") for i in range(40)]
    rows += [(100, None, "en"), (101, "", None), (102, "123 !!!", "en"), (103, "é", None), (None, "the dog", "en"), (104, "the cat " * 40000, None), (1, rows[1][1], "de")]
    docs = make_docs(rows)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)] + [(None, 1, 1), (3, None, None), (5, 1, 1)], "doc_id long, quality int, toxic int")
    lang = language_id.predict_language(docs).collect()
    assert len(lang) == len(rows)
    by_id = {r.doc_id: r for r in lang}
    assert [by_id[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and by_id[104].lang_pred == "en"
    assert by_id[None].held_out and by_id[1].lang_pred == "de"
    kept = language_id.drop_unknown_language(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()}.isdisjoint({100, 101, 102}) and kept.count() == len(rows) - 3
    for score in (quality_fm.score_quality, toxicity.score_toxicity):
        got = score(docs, labels).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        assert score(make_docs([]), labels).collect() == []
        assert len(score(docs, labels.limit(0)).collect()) == len(rows)
    assert language_id.predict_language(make_docs([])).collect() == []
    assert {r.lang_pred for r in language_id.predict_language(make_docs([(1, "text"), (2, "more")])).collect()} == {"und"}


def test_features_do_not_depend_on_neighbours_or_slices(monkeypatch):
    import pyarrow as pa

    texts = ["Straße und Ärger", "a", "", None, "b c", "ñandú " * 50]
    together = np.vstack([x for _, x in language_id.features(pa.array(texts))])
    alone = np.vstack([next(language_id.features(pa.array([t], pa.string())))[1] for t in texts])
    assert np.array_equal(together, alone)
    assert np.allclose((together**2).sum(axis=1), [1, 1, 0, 0, 1, 1], atol=1e-3)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 9, 30])
def test_codewords_are_apart(n):
    code = language_id.codewords(n)
    apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
    assert code.shape[0] == n and (not apart or min(apart) >= max(1, 2 ** (n - 2) if n <= 5 else 8))


def test_a_wrong_bit_is_corrected():
    code = language_id.codewords(4)
    model = language_id.LanguageModel(list("abcd"), code, np.eye(7), np.zeros(7), np.ones(7))
    margins = code[2].copy() * 3
    margins[1] *= -1
    assert model.losses(margins[None])[0].argmin() == 2


def test_sum_of_squares_identity():
    rng = np.random.default_rng(2)
    x, w, v = rng.random((5, 9)), rng.random(9), rng.random((9, 3))
    pairs = [sum(v[i] @ v[j] * r[i] * r[j] for i in range(9) for j in range(i)) for r in x]
    assert np.allclose(quality_fm.FactorisationMachine(0.5, w, v).margin(x), 0.5 + x @ w + pairs)


def test_clause_grammar():
    word = {"insult": toxicity.INSULT, "threat": toxicity.THREAT, "you": toxicity.TARGET, "not": toxicity.NEGATION, "said": toxicity.REPORT}

    def patterns(text):
        return dict(toxicity.clause_patterns([word.get(w, 0) for w in text.split()]))

    assert patterns("you are an insult") == {"insult": 1, "insult_target": 1}
    assert patterns("insult of you") == {"insult": 1, "insult_target": 1}
    assert patterns("an insult") == {"insult": 1}
    assert patterns("not an insult") == {"insult_negated": 1}
    assert patterns("he said that insult") == {"insult_reported": 1}
    assert patterns("i will threat you") == {"threat_target": 1}
    assert patterns("threat the long winter evening you") == {}
    assert patterns("will not threat you") == {"threat_negated": 1}


def test_bounded_sample_is_stable(spark):
    rows = spark.range(5000).selectExpr("id AS doc_id", "CAST(id % 10 = 0 AS INT) AS y")
    sample = learning.bounded_sample(rows, "y", 300, "doc_id")
    sizes = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    assert 230 < sizes[0] < 370 and 230 < sizes[1] < 370
    assert {r.doc_id for r in sample.collect()} == {r.doc_id for r in learning.bounded_sample(rows.repartition(7), "y", 300, "doc_id").collect()}


def test_language_stage_without_labels_keeps_lettered_texts(make_docs):
    kept = language_id.drop_unknown_language(make_docs([(1, "some text"), (2, "123 !"), (3, None), (4, "é")]))
    assert {r.doc_id for r in kept.collect()} == {1, 4}


def test_many_languages_are_learned(make_docs):
    rows = [(k * 8 + i, (chr(0x4E00 + 7 * k) + chr(0x5E00 + 11 * k) + " ") * 12, f"l{k:02d}") for k in range(70) for i in range(8)]
    got = language_id.predict_language(make_docs(rows)).collect()
    want = {r[0]: r[2] for r in rows}
    assert len(got) == len(rows) and np.mean([r.lang_pred == want[r.doc_id] for r in got]) > 0.9


def patterns_of(text, stems=("schwac",)):
    import pyarrow as pa

    ((_, x),) = toxicity.features(toxicity.Lexicon.of(list(stems)), pa.array([text]))
    return {name: round(float(v), 3) for name, v in zip(toxicity.PATTERNS, x[0]) if v}


def test_learned_insults_pass_scope_target_and_report():
    direct = patterns_of("du bist ein schwachkopf")
    assert {"learned", "learned_target", "learned_density"} <= set(direct)
    assert set(patterns_of("he said you are a schwachkopf")) == {"learned_reported"}
    assert set(patterns_of("du bist nicht schwachkopf")) == {"learned_negated"}
    assert "learned_target" not in patterns_of("der schwachkopf")


def test_reports_reach_across_colons_and_quotation_marks():
    for text in ("he said: you are an idiot", "he said: \"you are an idiot\"", "he said: “you are an idiot”", "he said « you idiot »"):
        assert set(patterns_of(text)) == {"insult_reported"}, text
    assert "insult_target" in patterns_of("he said. you are an idiot")


def test_punctuation_beyond_ascii_parts_words():
    for text in ("you «idiot»", "you idiot—he left", "you “idiot”…", "you　idiot。", "¡you idiot!"):
        assert "insult_target" in patterns_of(text), text
    assert set(patterns_of("I don’t call you idiot")) == {"insult_negated"}
    assert patterns_of("naïve façade") == {}
