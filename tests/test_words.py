"""Word lists in whole texts against plain search."""

import random

import pytest

from leadloom.operators import words as W


@pytest.fixture(scope="module")
def case():
    draw = random.Random(2)
    letters = "abcdeé漢 "
    word = lambda n: "".join(draw.choice(letters) for _ in range(n))
    listed = [word(draw.randrange(2, 7)) for _ in range(400)] + ["", None, "ABC", "abc"]
    texts = [None, "", "abc", *(word(draw.randrange(1, 300)).upper() for _ in range(60))]
    return listed, texts


def frames(spark, case):
    listed, texts = case
    return spark.createDataFrame([(w,) for w in listed], "word string"), spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)], "id int, text string, word string")


@pytest.mark.parametrize("limits", [{}, {"few": 10_000}, {"most_chars": 500}, {"few": 0, "most_chars": 100}])
def test_equals_plain_search(spark, case, limits):
    listed, texts = case
    words, rows = frames(spark, case)
    known = {w.lower() for w in listed if w}
    want = {i: sorted(w for w in known if t and w in t.lower()) for i, t in enumerate(texts)}
    assert {r.id: r.hits for r in W.with_words(rows, "text", words, **limits).collect()} == want
    assert sorted(r.id for r in W.without_words(rows, "text", words, **limits).collect()) == [i for i, h in want.items() if not h]


def test_no_words(spark, case):
    _, rows = frames(spark, case)
    none = spark.createDataFrame([], "word string")
    assert W.without_words(rows, "text", none).count() == rows.count() and all(r.hits == [] for r in W.with_words(rows, "text", none).collect())


def test_a_hundred_thousand_words_in_long_texts():
    draw = random.Random(3)
    known = {"".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randrange(6, 14))) for _ in range(100_000)}
    machine = W.automaton(sorted(known))
    held = draw.sample(sorted(known), 50)
    ws = ["".join(draw.choice("qrstuvwxyz") for _ in range(5)) for _ in range(20_000)]
    for k, w in enumerate(held):
        ws[k * 300] = w
    found = W.found_in(machine, " ".join(ws))
    assert set(held) <= set(found) and all(any(w in x for x in held) for w in found)
