import numpy as np

from leadloom.llm import quality_fm as Q

from . import frames

SF = "/root/testdata/sf0.01"


def test_linear_time_score_equals_all_pairs():
    rows = [Q.features(t.encode(), n) for t, n in (("a few words here", 16), ("###", None), ("", 0))]
    model = Q.FactorisationMachine()
    model.fitted, model.bias = True, 0.3
    model.w = np.random.default_rng(1).normal(size=len(model.w)).astype(np.float32)
    for (idx, val), z in zip(rows, model.logit(rows), strict=True):
        want = model.bias + sum(model.w[i] * x for i, x in zip(idx, val, strict=True))
        for a in range(len(idx)):
            for b in range(a):
                want += float(model.v[idx[a]] @ model.v[idx[b]]) * val[a] * val[b]
        assert abs(z - want) < 1e-4


def test_held_out_accuracy(spark):
    got = Q.op4_quality_fm(spark, SF).toPandas().merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert len(held) > 50
    assert (held.predicted == held.quality).mean() > 0.95
    assert ((got.score >= 0) & (got.score <= 1)).all() and (got.predicted == (got.score >= 0.7)).all()
    again = Q.op4_quality_fm(spark, SF).toPandas().set_index("doc_id").score
    assert (again.loc[got.doc_id].values == got.score.values).all()


def test_held_out_rows_are_never_learned_from(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", (labels.quality + Q.held_out(labels.doc_id).cast("int")) % 2)
    a, b = Q.train(docs, labels, sample_rows=200), Q.train(docs, flipped, sample_rows=200)
    assert np.array_equal(a.w, b.w) and np.array_equal(a.v, b.v)


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(3, 1), (4, 0), (4, 1), (None, 1), (6, None)], "doc_id long, quality int")
    docs = frames.awkward(spark)
    model = Q.train(docs, labels)
    got = Q.score(docs, model).collect()
    assert len(got) == 8 and all(0 <= r.score <= 1 for r in got)
    assert Q.score(frames.empty(spark), model).count() == 0
    unfitted = Q.train(frames.empty(spark), labels)
    assert {r.score for r in Q.score(docs, unfitted).collect()} == {0.5}
    assert Q.keep_good(docs, model, cut=0.0).count() == 8 and Q.keep_good(docs, model).columns == docs.columns
