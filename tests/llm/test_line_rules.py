from collections import Counter, defaultdict

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leadloom.llm import line_rules as R

from .. import oracle
from . import frames


def brute_repeat(ws):
    count = Counter(zip(ws, ws[1:], ws[2:], strict=False))
    return len({i + k for i in range(len(ws) - 2) if count[tuple(ws[i : i + 3])] > 1 for k in range(3)})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=20))
def test_repeat_words(ws):
    assert R.repeat_words(ws) == brute_repeat(ws)


def brute_verdicts(rows, min_docs, copies_once=False):
    """(removed characters, kept) per row (host, id, text), from sets of whole lines."""
    norm = lambda line: b" ".join(line.lower().split())
    chars = lambda x: sum(len(w.decode()) for w in x.split())
    rows = [(host, k if i is None else ("id", i), (text or "").encode()) for k, (host, i, text) in enumerate(rows)]
    held = defaultdict(set)
    for host, i, t in rows:
        for x in t.split(b"\n"):
            if x.split():
                held[host, norm(x)].add(t if copies_once else i)
    out = []
    for host, _, t in rows:
        gone = sum(chars(x) for x in t.split(b"\n") if x.split() and len(held[host, norm(x)]) > min_docs)
        ws = t.split()
        out.append((gone, len(ws) >= 50 and 100 * brute_repeat(ws) <= 50 * len(ws) and 2 * gone <= chars(t)))
    return out


def own(i, n):
    return " ".join(f"w{i}x{k}" for k in range(n))


NOTE = "Subscribe to our  NEWS letter today"


@pytest.mark.parametrize("copies_once", [False, True])
def test_frequent_lines_are_removed_and_depleted_documents_rejected(spark, copies_once):
    texts = [f"{own(i, 60)}\n{NOTE}" for i in range(12)] + [f"{own(99, 50)}\n" + "\n".join([NOTE] * 40), own(7, 60), own(8, 10), None, f"{own(0, 60)}\n{NOTE}"] + [own(50, 70)] * 8
    sources = ["a"] * 13 + ["b"] * 3 + ["a"] + ["c"] * 8
    docs = frames.docs(spark, texts, sources)
    got = {r.doc_id: (r.removed_chars, r.kept) for r in R.judge(docs, min_docs=5, copies_once=copies_once).collect()}
    assert got == dict(enumerate(brute_verdicts(list(zip(sources, range(len(texts)), texts, strict=True)), 5, copies_once)))
    assert not got[12][1] and got[0][1] and got[20][1] == copies_once
    kept = R.clean(docs, min_docs=5, copies_once=copies_once)
    assert kept.columns == docs.columns
    rows = {r.doc_id: r for r in kept.collect()}
    assert sorted(rows) == sorted(i for i, (_, k) in got.items() if k)
    assert rows[0].text == own(0, 60) and rows[0].n_chars == len(rows[0].text)


def test_a_documents_rows_count_once(spark):
    rows = [(1 if i < 30 else None if i < 33 else i, f"{own(i, 60)}\n{NOTE}", "en", "s", 1) for i in range(35)]
    docs = frames.with_clashes(spark.createDataFrame(rows, frames.DOCS))
    want = brute_verdicts([(s, i, t) for i, t, _, s, _ in rows], 5)
    for limit in (5, 6):  # one id thirty times, three rows without an id, two ids
        want = brute_verdicts([(s, i, t) for i, t, _, s, _ in rows], limit)
        assert sorted((r.removed_chars, r.kept) for r in R.judge(docs, min_docs=limit).collect()) == sorted(want)
        assert (want[0][0] > 0) == (limit == 5)


def test_lines_of_other_white_space_have_words(spark):
    texts = [f"{own(i, 60)}\n\u00a0\u00a0" for i in range(4)]
    docs = frames.docs(spark, texts)
    assert {r.removed_chars for r in R.judge(docs, min_docs=3).collect()} == {2}
    assert sorted(r.text for r in R.clean(docs, min_docs=3).collect()) == sorted(own(i, 60) for i in range(4))


def test_repeated_and_missing_ids_against_sql(spark, tmp_path):
    rows = [(None if i % 7 == 0 else i % 40, f"{own(i % 50, 60)}\n{NOTE}\nLine {i % 3}", "en", None if i % 5 == 0 else "s", 1) for i in range(120)]
    spark.createDataFrame(rows, frames.DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    oracle.assert_same(R.op8_line_rules(spark, str(tmp_path)), con, R.OP8_SQL)


def test_awkward_rows(spark):
    got = {(r.doc_id, r.n_words, r.word_chars, r.base_failed, r.kept) for r in R.judge(frames.awkward(spark)).collect()}
    assert (1, 0, 0, True, False) in got and (3, 60_000, 240_000, True, False) in got and (6, 4, 14, True, False) in got and (None, 2, 4, True, False) in got
    assert R.judge(frames.awkward(spark)).count() == 8
    assert R.judge(frames.empty(spark)).count() == 0 and R.clean(frames.empty(spark)).count() == 0
