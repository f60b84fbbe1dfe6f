import itertools

import numpy as np
import pytest

from leadloom.llm import toxicity as T

from . import frames

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize(
    ("text", "marks"),
    [
        ("You are an idiot.", "insult targeted"), ("What a moron", "insult"), ("You are not an idiot.", "insult targeted negated"), ("He said you are stupid", "insult targeted reported"),
        ('She wrote: "worthless scum" on it.', "insult reported"), ("“Loser” was the title.", "insult reported"), ('"Fine." You idiot.', "insult targeted"), ("I will kill you", "threat"), ("You deserve to die.", "threat"),
        ("I will not kill you", "threat negated"), ("They said: we shall hurt them", "threat reported"), ("kill them all", "menace"), ("He said so. You moron", "insult targeted"), ("never mind all that you idiot", "insult targeted"),
    ],
)
def test_grammar(text, marks):
    found = T.Lexicon().matches(text)
    assert [m for _, m, _ in found] == [marks] * len(found) and found


@pytest.mark.parametrize("text", ["", "kill the process", "beat the eggs", "a rate of 4", "You. Kill. Them."])
def test_no_match(text):
    assert T.Lexicon().matches(text) == [] and abs(T.Lexicon().score(text) - T.P_NONE) < 1e-12


def test_clean_and_toxic_texts():
    known = T.Lexicon()
    for text in ("take out the trash on monday", "You are not an idiot.", "not stupid at all"):
        assert known.score(text) < 0.3, text
    for text in ("You are trash.", "IDIOT!", "they are vermin", "I will murder you"):
        assert known.score(text) >= 0.3, text


def test_composed_table_equals_the_cascade():
    """Each transducer run on the whole output of the one before, instead of the composed table."""
    bad = {"insult", "threat"}
    parts = [T.scope({"target"}, bad, "targeted", 4, frozenset({T.END, T.OPEN, "said"})), T.scope({"intent"}, {"threat"}, "intended", 4), T.scope({"not"}, bad, "negated", 3), T.scope({"said"}, bad, "reported", None), T.quotation(bad, "reported"), T.reach(3)]
    draw = np.random.default_rng(3)
    for _ in range(300):
        classes = draw.choice(len(T.ALPHABET), 40)
        symbols = [T.ALPHABET[c] for c in classes]
        for part in parts:
            state, out = part.start, []
            for s in symbols:
                state, y = part.step(state, s)
                out.append(y)
            symbols = out
        want = [T.MATCHES.index(y) if y in T.GIVEN else 0 for y in symbols]
        state, got = 0, []
        for c in classes:
            got.append(T._OUT[state][c])
            state = T._TO[state][c]
        assert got == want


def test_stems_are_found_and_chance_is_not():
    draw = np.random.default_rng(5)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]

    def text(extra=()):
        ws = ["".join(draw.choice(syllables, draw.integers(1, 4))) for _ in range(80)]
        return " ".join([*ws, *extra])

    held = [T.beginnings(text(["zorg" + draw.choice(syllables) for _ in range(2)])) for _ in range(12)] + [T.beginnings(text()) for _ in range(8)]
    clean = {}
    for _ in range(300):
        for s in T.beginnings(text()):
            clean[s] = clean.get(s, 0) + 1
    tried = {s for h in held for s in h}
    assert list(T.choose_stems(held, clean, 20 / 320, len(tried))) == ["zorg*"]
    assert T.choose_stems(held[12:], clean, 20 / 320, len(tried)) == {}


def test_fit_does_not_blame_what_another_word_explains():
    lexicon = T.Lexicon(stems={"foo": 0.6})
    rows = [(True, ["fooa", "idiot"], ["insult"] * 2)] * 30 + [(False, ["fooa"], ["insult"])] * 10 + [(True, ["foob"], ["insult"])] * 20 + [(False, [], [])] * 60
    got = T.fit(rows, lexicon)
    assert got.words["fooa"] < 0.3 < 0.7 < got.words["foob"] and got.words["idiot"] > 0.8 and got.none < 0.05


def test_held_out_accuracy(spark):
    got = T.op12_toxicity(spark, SF).toPandas()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = got[got.held_out].merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    assert len(held) > 50 and (held.predicted == held.toxic).mean() > 0.93
    assert ((got.score >= 0) & (got.score <= 1)).all() and (got.predicted == (got.score >= 0.3)).all()
    again = T.op12_toxicity(spark, SF).toPandas().set_index("doc_id").score
    assert (again.loc[got.doc_id].values == got.score.values).all()


def test_held_out_rows_are_never_learned_from(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("toxic", (labels.toxic + T.held_out(labels.doc_id).cast("int")) % 2)
    a, b = T.learn(docs, labels, sample_rows=200), T.learn(docs, flipped, sample_rows=200)
    assert (a.words, a.stems, a.by_marks, a.none) == (b.words, b.stems, b.by_marks, b.none)


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(3, 1), (4, 0), (4, 1), (None, 1), (6, None), (1, 0)], "doc_id long, toxic int")
    docs = frames.awkward(spark)
    lexicon = T.learn(docs, labels)
    got = T.score(docs, lexicon).collect()
    assert len(got) == 8 and all(0 <= r.score <= 1 for r in got)
    assert T.score(frames.empty(spark), lexicon).count() == 0
    assert T.learn(frames.empty(spark), labels).by_marks == T.GIVEN
    toxic = T.score(frames.docs(spark, ["you idiot " * 60_000, None, "x"]), lexicon).orderBy("doc_id").collect()
    assert [r.predicted for r in toxic] == [1, 0, 0] and toxic[0].n_words == 1 and toxic[0].marks == "insult targeted"


def test_every_state_of_the_table_is_reachable():
    seen, queue = {0}, [0]
    for s in queue:
        for to in itertools.chain(T._TO[s]):
            if to not in seen:
                seen.add(to)
                queue.append(to)
    assert seen == set(range(len(T._TO)))
