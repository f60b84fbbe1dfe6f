from hypothesis import given, settings
from hypothesis import strategies as st

from leadloom.llm import token_counts as T

from . import frames

ALPHABET = st.sampled_from(list("ab'st  \n\té9.,#漢") + ["'ll", "  ", "re"])
TEXT = st.lists(ALPHABET, max_size=60).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(-1, 70), st.integers(-1, 9), TEXT), max_size=5), st.sampled_from([2, 3, 128]))
def test_edits_equal_a_recount(text, edits, leaf):
    tokens, T.LEAF = T.counter(T.VOCABULARY), leaf
    full = lambda s: len(tokens.encoding.encode_ordinary(s))
    tree = T.TokenTree(text, tokens)
    assert tree.total == full(text)
    for at, remove, insert in edits:
        a = min(max(at, 0), len(text))
        text = text[:a] + insert + text[a + max(remove, 0) :]
        tree.edit(at, remove, insert)
        assert tree.text == text and tree.total == full(text) and tree.chars[1] == len(text)
    T.LEAF = 128


def test_little_is_encoded_again():
    tree = T.TokenTree("some words of text " * 5000, T.counter(T.VOCABULARY))
    tree.edit(40_000, 3, "new")
    assert 0 < tree.reencoded < 60


def test_rows(spark):
    got = {(r.doc_id, r.n_tokens_before) for r in T.edited_counts(T.derived_edits(frames.awkward(spark))).collect()}
    assert (1, 0) in got and (2, 0) in got and any(i == 3 and n >= 60_000 for i, n in got)
    assert T.edited_counts(T.derived_edits(frames.empty(spark))).count() == 0
    edits = spark.createDataFrame([(4, 2, 0, 0, "b"), (4, 1, 0, 4, "a"), (2, 1, 9, 9, "xy")], "doc_id long, seq int, at int, remove int, insert string")
    rows = T.edited_counts(T.with_edits(frames.awkward(spark).select("doc_id", "text"), edits)).collect()
    assert {r.doc_id: r.n_chars for r in rows if r.doc_id in (2, 4)} == {2: 2, 4: 12} and len(rows) == 8


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tokens = T.counter(T.VOCABULARY)
    want = {}
    for r in T.derived_edits(docs).collect():
        text = r.text
        for e in r.edits:
            text = text[: e["at"]] + e["insert"] + text[e["at"] + e["remove"] :]
        want[r.doc_id] = (len(tokens.encoding.encode_ordinary(r.text)), len(tokens.encoding.encode_ordinary(text)), len(text))
    got = {r.doc_id: (r.n_tokens_before, r.n_tokens, r.n_chars) for r in T.op3_edit_counts(spark, "/root/testdata/sf0.001").collect()}
    assert got == want
