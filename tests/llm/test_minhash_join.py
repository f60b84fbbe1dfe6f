import random
from collections import Counter

import numpy as np
import pytest

from leadloom.llm import minhash_join as M
from leadloom.llm.graph import components

from . import frames


def brute(rows):
    """(copy_id, n_links, class_id) per (id, text) by comparing all pairs of texts."""
    hashes = M.WordHashes()
    first = {}
    for i, t in rows:
        if t is not None:
            first[t] = min(first.get(t, i), i)
    texts = list(first)
    sets = [set(M.shingles(t.encode(), hashes).tolist()) for t in texts]
    links = {t: set() for t in texts}
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                links[texts[a]].add(texts[b])
                links[texts[b]].add(texts[a])
    klass = {}
    for t in texts:
        if t not in klass:
            group, todo = {t}, [t]
            while todo:
                for x in links[todo.pop()] - group:
                    group.add(x)
                    todo.append(x)
            for x in group:
                klass[x] = min(first[y] for y in group)
    return sorted((i, i, 0, i) if t is None else (i, first[t], len(links[t]), klass[t]) for i, t in rows)


def joined(spark, rows):
    df = frames.with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    return sorted((r.doc_id, r.copy_id, r.n_links, r.class_id) for r in M.similarity_classes(df).collect())


def corpus(seed, groups, size):
    draw, rows = random.Random(seed), []
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    for _ in range(groups):
        base = [word() for _ in range(draw.choice([40, 120, 400]))]
        for _ in range(size):
            ws = list(base)
            for _ in range(draw.choice([0, 1, len(ws) // 60, len(ws) // 20])):
                ws[draw.randrange(len(ws))] = word()
            rows.append((len(rows), " ".join(ws)))
    return rows


def test_equals_brute_force(spark):
    rows = corpus(1, 25, 6) + [(1000, None), (1001, None), (1002, ""), (1003, ""), (1004, "two words"), (1005, "Two, words!"), (1006, "...")]
    assert joined(spark, rows) == brute(rows)


def test_large_groups_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_TEXTS", 8)
    rows = corpus(2, 2, 60)
    assert joined(spark, rows) == brute(rows)


def test_ids_that_repeat_or_are_null(spark):
    got = joined(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (1, "u v w x y z")])
    assert got == [(1, 1, 0, 1)] * 3
    df = spark.createDataFrame([(None, "a b c d e f"), (5, "a b c d e f"), (None, None)], "doc_id long, text string")
    assert M.similarity_classes(df).count() == 3


def test_very_long_and_empty_tables(spark):
    assert joined(spark, [(1, frames.LONG), (2, frames.LONG + "word")]) == brute([(1, frames.LONG), (2, frames.LONG + "word")])
    assert joined(spark, []) == []


def test_one_of_each_class_stays(spark):
    rows = corpus(3, 8, 5)
    df = frames.docs(spark, [t for _, t in rows] + [rows[0][1]])
    kept = M.keep_one(df)
    assert kept.columns == df.columns
    want = {c for _, _, _, c in brute([*rows, (len(rows), rows[0][1])])}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    twice = df.union(df)
    assert sorted(r.doc_id for r in M.keep_one(twice).collect()) == sorted(want)


def test_banding_reaches_the_recall():
    bands, rows = M.bands_for(0.8, 0.9995)
    assert bands * rows <= M.MAX_HASHES and 1 - (1 - 0.8**rows) ** bands >= 0.9995
    with pytest.raises(ValueError, match="no banding"):
        M.bands_for(0.01, 0.9999999, 4)


def test_components(spark):
    draw = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 300, (260, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2300)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def test_recall_of_every_hundredth_document_against_all(spark):
    """Links of the documents with an id divisible by 100 to all others at sf0.1, by full comparison: none is lost."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    hashes, texts = M.WordHashes(), {}
    for r in docs.orderBy("doc_id").collect():
        texts.setdefault(r.text, r.doc_id)
    sets = {t: M.shingles(t.encode(), hashes) for t in texts if t is not None}
    asked = [t for t, i in texts.items() if i % 100 == 0 and t is not None]
    holders = {}
    for k, t in enumerate(asked):
        for h in sets[t].tolist():
            holders.setdefault(h, []).append(k)
    want = dict.fromkeys(range(len(asked)), 0)
    for t, own in sets.items():
        both = Counter(k for h in own.tolist() for k in holders.get(h, ()))
        for k, n in both.items():
            if asked[k] != t and n >= 0.8 * (len(own) + len(sets[asked[k]]) - n) - 1e-9:
                want[k] += 1
    got = {r.doc_id: r.n_links for r in M.similarity_classes(docs).where("doc_id % 100 = 0").collect()}
    found, links = sum(got[texts[t]] for t in asked), sum(want.values())
    assert links >= 1 and found >= 0.99 * links
    assert all(got[texts[t]] <= want[k] for k, t in enumerate(asked))


def test_buckets_of_large_components_equal_brute_force(spark, monkeypatch):
    """A chain of texts, each alike to the next: a large component whose buckets are small, and a dense one beside it."""
    monkeypatch.setattr(M, "BLOCK_TEXTS", 4)
    parts, by_bucket = [], M._by_bucket
    monkeypatch.setattr(M, "_by_bucket", lambda *a: parts.append(by_bucket(*a)) or parts[-1])
    draw = random.Random(8)
    ws = [f"w{k}" for k in range(300)]
    rows = []
    for _ in range(200):
        rows.append((len(rows), " ".join(ws)))
        at = draw.randrange(280)
        ws[at : at + 12] = [f"n{len(rows)}x{k}" for k in range(12)]
    rows += [(1000 + i, t) for i, t in corpus(5, 1, 25)]
    assert joined(spark, rows) == brute(rows)
    assert len(parts) == 1 and parts[0] is not None
