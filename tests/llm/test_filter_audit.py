import re
from collections import Counter, defaultdict
from itertools import permutations

from leadloom.llm import filter_audit as A

from . import frames


def brute(docs, labels):
    """Every document through every order of the filters."""
    marks = defaultdict(lambda: [False, False])
    for i, q, t in labels:
        if i is not None:
            marks[i][0] |= q == 1
            marks[i][1] |= t == 1
    rows = []
    for i, text, source in docs:
        t = text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        twin = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs)
        failed = {"A": len(ws) < 50, "B": 100 * len(set(ws)) < 65 * len(ws), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": twin}
        rows.append((source or "", failed, *(marks[i] if i is not None else (False, False))))
    out, removed_in_all = {}, Counter()
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            alive = [r for r in rows if r[0] == part]
            for step, x in enumerate(order, 1):
                gone = [r for r in alive if r[1][x]]
                alive = [r for r in alive if not r[1][x]]
                fails = [r for r in rows if r[0] == part and r[1][x]]
                only = sum(sum(r[1].values()) == 1 for r in fails)
                removed_in_all[part, x] += len(gone)
                out[part, "".join(order), step] = [len(alive), len(gone), len(fails) - len(gone), only, sum(r[2] for r in gone), sum(r[3] for r in gone)]
    return {k: (*v, removed_in_all[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def run(spark, docs, labels):
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in A.audit(A.cells(docs, labels)).collect()}


def test_equals_every_order_applied(spark):
    words = " ".join(f"w{i}" for i in range(60))
    texts = [words, words, words.upper(), words + " #", "a b " * 40, "short", "", None, "ONE $", words.upper() + " *", "a b " * 40, None, "SHORT & SHORT", words + " \x0b x"]
    rows = [(i, t, "en", None if i % 5 == 4 else ("" if i % 5 == 3 else "s"), None) for i, t in enumerate(texts)]
    rows += [rows[1], rows[5], (None, words, "en", "s", None), (None, words, "en", "t", None)]
    labels = [(i, i % 2, (i // 2) % 2) for i in range(0, 14, 3)] + [(1, None, 1), (1, 1, 0), (None, 1, 1)]
    docs = frames.with_clashes(spark.createDataFrame(rows, frames.DOCS))
    want = brute([(r[0], r[1], r[3]) for r in rows], labels)
    got = run(spark, docs, labels)
    assert len(got) == 3 * 600 and got == want


def test_awkward_rows(spark):
    docs = frames.awkward(spark)
    labels = [(3, 1, None), (4, 0, 1), (4, 1, 0), (99, 1, 1)]
    assert run(spark, docs, labels) == brute([(r.doc_id, r.text, r.source) for r in docs.collect()], labels)
    assert run(spark, frames.empty(spark), labels) == {}
    assert run(spark, docs, [])["s", "ABCDE", 1][4:6] == (0, 0)


def test_potential_of_other_numbers_of_filters(spark):
    cells = spark.createDataFrame([("p", 1, True, False, 3), ("p", 3, False, False, 2), ("p", 0, True, False, 5), ("p", 6, True, True, 1)], "part string, fails int, good boolean, toxic boolean, n long")
    got = {(r.filter_order, r.step): r for r in A.audit(cells, "XYZ").collect()}
    assert len(got) == 18
    first = [got[o, 1].removed for o in ("XYZ", "YXZ", "ZXY")]
    assert first == [5, 3, 1]
    for x in "XYZ":
        total = sum(r.removed for (o, k), r in got.items() if o[k - 1] == x)
        assert {r.shapley for (o, k), r in got.items() if o[k - 1] == x} == {total}
