import pytest

from panelcast.llm import decontamination as D

ITEM = "The train left the old station with 120 people and then 35 km later it met Maria who had walked 35 km from the town of Anna"


@pytest.fixture
def bench(spark):
    def make(items):
        return spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, doc_id string")

    return make


def leaks(docs, benchmark):
    return {(r.doc_id, r.item_id): (r.matched, r.exact, r.item_windows) for r in D.find_leaks(docs, benchmark).collect()}


def test_exact_reparameterised_and_inconsistent(make_docs, bench):
    pad = "some quiet words before it all , "
    changed = ITEM.replace("120", "77").replace("35", "48").replace("Maria", "Olga").replace("Anna", "Berta")
    torn = changed.replace("walked 48", "walked 49")  # one benchmark value, two document values
    docs = make_docs(
        [
            (1, pad + ITEM + " and more"),
            (2, pad + changed),
            (3, pad + torn),
            (4, "Nothing of the kind is written in this clean text about a train and a station and a town"),
            (5, ITEM.upper()),
            (6, " ".join(ITEM.split()[:9])),
            (7, None),
            (8, ""),
            (None, ITEM),
            (1, pad + ITEM + " and more"),
            (9, ("x " * 30000) + ITEM),
        ]
    )
    got = leaks(docs, bench([(50, ITEM), (51, None), (52, ""), (None, ITEM)]))
    windows = len(ITEM.split()) - 7
    assert got[(1, 50)] == (windows, windows, windows) or got[(1, 50)][1] >= windows - 8
    assert got[(9, 50)][1] >= windows - 8
    assert (2, 50) in got and got[(2, 50)][1] < got[(2, 50)][0]  # same template, other values
    assert (3, 50) not in got
    assert not {k for k in got if k[0] in (4, 6, 7, 8, None)} and not {k for k in got if k[1] != 50}


def test_short_items_match_whole_texts_only(make_docs, bench):
    docs = make_docs([(1, "What is it"), (2, "What is it then"), (3, "what is, it?")])
    assert set(leaks(docs, bench([(1, "What is it?")]))) == {(1, 1), (3, 1)}


def test_placeholders_alone_match_nothing(make_docs, bench):
    docs = make_docs([(1, "1 2 3 4 5 6 7 8 9 10 11 12"), (2, "clean words")])
    assert leaks(docs, bench([(1, "21 22 23 24 25 26 27 28 29 30 31 32")])) == {}


def test_shuffled_join_gives_the_same(make_docs, bench, monkeypatch):
    docs = make_docs([(i, f"lead {i} " + (ITEM if i % 3 == 0 else "clean " * 30)) for i in range(12)])
    small = leaks(docs, bench([(1, ITEM)]))
    monkeypatch.setattr(D, "BROADCAST_WINDOWS", 0)
    assert leaks(docs, bench([(1, ITEM)])) == small and {k[0] for k in small} == {0, 3, 6, 9}


def test_empty_tables_and_filter(make_docs, bench):
    assert leaks(make_docs([]), bench([(1, ITEM)])) == {} == leaks(make_docs([(1, ITEM)]), bench([]))
    docs = make_docs([(1, ITEM), (2, "clean"), (None, "clean too")])
    kept = D.drop_leaks(docs, bench([(1, ITEM)]))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {2, None}


def test_short_items_are_found_inside_longer_texts(make_docs, bench):
    item = "What is the capital of France?"
    docs = make_docs([(1, item), (2, "Some words before. " + item + " Paris, of course, and more."), (3, "What is the capital of the firm?")])
    got = leaks(docs, bench([(1, item), (2, ITEM)]))
    assert set(got) == {(1, 1), (2, 1)} and got[(2, 1)] == (1, 1, 1)


def test_items_of_many_numbers_are_found(make_docs, bench):
    series = " ".join(str(2 * n) for n in range(1, 17))
    item = "Continue the series: " + series
    docs = make_docs([(1, "Well. " + item + " and so on"), (2, "Continue the series: " + series.replace("2", "3")), (3, "5 6 7 8 9 " * 9), (4, series)])
    got = leaks(docs, bench([(1, item), (2, series)]))
    assert {(1, 1), (2, 1), (1, 2), (4, 2)} <= set(got) and not {k for k in got if k[0] == 3 or k == (2, 2)}
    assert got[(1, 1)] == (12, 12, 12)


def test_names_at_sentence_starts_are_slots(make_docs, bench):
    item = "Alice has 5 apples. Alice gives 2 to Bob. How many apples does Alice have left?"
    changed = item.replace("Alice", "Carol").replace("Bob", "Dave").replace("5", "9").replace("2", "3")
    assert set(leaks(make_docs([(1, changed), (2, changed.lower()[:30])]), bench([(1, item)]))) == {(1, 1)}


def test_numbers_with_separators_and_units_are_one_slot(make_docs, bench):
    item = "a farmer sells 1,200 eggs at 3.50 each and buys 5kg of corn for them"
    docs = make_docs([(1, item.replace("1,200", "850").replace("3.50", "4").replace("5kg", "7 kg")), (2, "a farmer sells eggs and buys corn for them")])
    assert set(leaks(docs, bench([(1, item)]))) == {(1, 1)}


def test_a_clash_voids_its_windows_only(make_docs, bench):
    item = "a box holds 5 red balls and 3 blue ones in it so that we can count them all again later on"
    both = item.replace("5", "4").replace("3", "4")  # two benchmark values, one document value
    late = "a box of 5 has the red balls and the blue ones in it so that we can count them all again later on with 5 more"
    torn = late.replace("of 5", "of 6").replace("with 5", "with 7")
    got = leaks(make_docs([(1, both), (2, torn)]), bench([(1, item), (2, late)]))
    assert (1, 1) in got and (2, 2) in got and got[(2, 2)][0] < got[(2, 2)][2]
