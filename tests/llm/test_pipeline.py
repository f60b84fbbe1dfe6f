"""Every stage on the one before, against brute force: no function of the library decides here but the model's features."""

import duckdb
import numpy as np
import pytest

import corpus_pipeline as P
from leadloom.llm import decontaminate, mixing, quality_fm

from .. import oracle
from . import frames, test_decontaminate, test_line_rules, test_minhash_join

SF = "/root/testdata/sf0.001"


def score_by_pairs(model, text, n_chars):
    """The factorisation machine with every pair of features written out."""
    idx, val = quality_fm.features((text or "").encode(), n_chars)
    x = model.v[idx].astype(np.float64) * val[:, None]
    pairs = x @ x.T
    z = model.bias + float(model.w[idx].astype(np.float64) @ val) + float(np.triu(pairs, 1).sum())
    return 1 / (1 + np.exp(-z))


def stage_by_hand(spark, k, docs):
    """doc_id to text of the documents that a stage must keep."""
    if k == 0:
        model = quality_fm.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
        return {r.doc_id: r.text for r in docs if score_by_pairs(model, r.text, r.n_chars) >= 0.7}
    if k == 1:
        kept = test_line_rules.brute_verdicts([(r.source, r.doc_id, r.text) for r in docs], 20, copies_once=True)
        assert not any(gone for gone, _ in kept)  # no line is so frequent in so small a table
        return {r.doc_id: r.text for r, (_, ok) in zip(docs, kept, strict=True) if ok}
    if k == 2:
        first = {c for _, _, _, c in test_minhash_join.brute([(r.doc_id, r.text) for r in docs])}
        return {r.doc_id: r.text for r in docs if r.doc_id in first}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    return {r.doc_id: r.text for r in docs if not test_decontaminate.brute(r.text, items)[4]}


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "quality_rules", "near_duplicates", "decontamination", "mixing"]
    for k, (_, stage) in enumerate(P.STAGES):
        before = docs.collect()
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert after.columns == columns
            rows, want = after.collect(), stage_by_hand(spark, k, before)
            assert sorted(r.doc_id for r in rows) == sorted(want)
            assert all(r.text == want[r.doc_id] for r in rows if k < 3) and all(r.n_chars == len(r.text) for r in rows)
        else:
            con = duckdb.connect()
            con.sql(f"create view documents as select * from '{tmp_path}/3/*.parquet'")
            oracle.assert_same(after.drop("expected"), con, mixing.OP9_SQL)
        docs = after
    assert {r.doc_id: r.taken for r in P.run(spark, SF).collect()} == {r.doc_id: r.taken for r in docs.collect()}


def test_frequent_lines_leave_the_kept_texts(spark):
    """The rules stage on a table in which a line is frequent, and a page is copied often."""
    line = "Read all about it here"
    texts = [f"{test_line_rules.own(i, 60)}\n{line}" for i in range(25)] + [test_line_rules.own(99, 80)] * 30
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in P.apply_rules(spark, docs, SF).collect()}
    assert got == {i: t.removesuffix(f"\n{line}") for i, t in enumerate(texts)}


def test_light_hits_are_cut(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    passage = max((t for _, t in items), key=lambda t: len(t.split()))
    texts = [test_line_rules.own(1, 60) + " " + passage, test_line_rules.own(2, 20 * len(passage.split())) + "\n" + passage]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    (r,) = P.drop_contaminated(spark, docs, SF).collect()
    assert r.doc_id == 1 and r.n_chars == len(r.text) < len(texts[1])
    assert decontaminate.scan_documents(spark.createDataFrame([r]), spark.read.parquet(f"{SF}/benchmark.parquet")).first().n_hit == 0


def test_working_tables_go(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (_, stage) in enumerate(P.STAGES[1:4]):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        since = P.live_cuts() if k == 0 else since
        assert len(P.live_cuts()) <= len(since)


def awkward(spark):
    """Awkward rows, with good texts among them: two equal rows, a copy under another id, a null source and no length."""
    good = [test_line_rules.own(i, 90) for i in range(6)]
    rows = [(20, good[0], "en", "s", len(good[0])), (20, good[0], "en", "s", len(good[0])), (21, good[0], "en", "s", len(good[0])), (None, good[1], "en", "s", None), (None, good[2], None, None, len(good[2])), (22, good[3], "en", None, len(good[3])), (22, good[4], "en", "t", len(good[4]))]
    return frames.awkward(spark).unionByName(frames.with_clashes(spark.createDataFrame(rows, frames.DOCS)))


@pytest.mark.parametrize("k", range(5))
def test_awkward_rows_of_a_stage(spark, tmp_path, k):
    """Nulls in any column, long and empty texts, repeated rows and clashing columns; results as the docstring defines them."""
    docs = awkward(spark)
    rows = docs.collect()
    P.STAGES[k][1](spark, docs, SF).write.parquet(f"{tmp_path}/out")
    out = spark.read.parquet(f"{tmp_path}/out")
    got = out.collect()
    if k == 4:
        assert len(got) == len(rows) and all(0 <= r.taken <= 3 * r.size for r in got)
        return
    assert out.columns == docs.columns and all(r.kept == "clash" and r._id == "clash" for r in got)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text is not None, (r.text or "")[:60])
    ids = sorted(map(key, got))
    if k == 1:
        assert ids == sorted(key(r) for r in rows if r.text and len(r.text.split()) >= 50 and len(set(r.text.split())) > 1)
    if k == 2:  # one of the equal rows and their copy; other rows without links stay, null texts each
        assert ids == sorted(map(key, [r for i, r in enumerate(rows) if r.doc_id != 21 and r not in rows[:i]]))
    if k == 3:
        assert ids == sorted(map(key, rows))


@pytest.mark.parametrize("k", range(5))
def test_empty_table_of_a_stage(spark, tmp_path, k):
    docs = frames.empty(spark)
    P.STAGES[k][1](spark, docs, SF).write.parquet(f"{tmp_path}/out")
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == 0 and (k == 4 or out.columns == docs.columns)
