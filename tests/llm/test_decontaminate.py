import hashlib
import pickle
import random
import re

import pytest

from leadloom.llm import decontaminate as D

from . import frames


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, width=13):
    ws, hit, names = tokens(text), set(), set()
    for i, item in items:
        own = tokens(item)
        n = min(width, len(own))
        for a in range(len(own) - n + 1 if own else 0):
            for b in range(len(ws) - n + 1):
                if ws[b : b + n] == own[a : a + n]:
                    hit |= set(range(b, b + n))
                    if i is not None:
                        names.add(str(i))
    sha = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    return len(ws), len(hit), len(names), sha, bool(hit) and 20 * len(hit) >= len(ws)


def case(seed=4):
    draw = random.Random(seed)
    word = lambda: draw.choice("alpha beta gamma delta Eps zeta".split()) + str(draw.randrange(30))
    items = [(i, " ".join(word() for _ in range(draw.choice([3, 13, 20, 30])))) for i in range(12)] + [(3, "other text of a repeated id"), (None, "no id but windows"), (99, None), (98, " ,. ")]
    texts = []
    for _ in range(40):
        ws = [word() for _ in range(draw.choice([5, 40, 300]))]
        if draw.random() < 0.7:
            own = draw.choice(items[:14])[1].split()
            a = draw.randrange(len(own))
            at = draw.randrange(len(ws))
            ws[at:at] = own[a : a + draw.choice([12, 13, 25])]
        texts.append(", ".join(ws).upper() if draw.random() < 0.3 else " ".join(ws))
    return texts, items


def test_both_ways_equal_brute_force(spark):
    texts, items = case()
    docs, bench = frames.docs(spark, [*texts, None, ""]), spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, digest string")
    want = {i: brute(t, items) for i, t in enumerate([*texts, None, ""])}
    assert any(w[4] for w in want.values()) and any(w[1] and not w[4] for w in want.values())
    for limit in (D.INDEX_WORDS, 0):
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in D.scan_documents(docs, bench, index_words=limit).collect()}
        assert got == want


def test_spans_are_cut_and_contaminated_documents_go(spark):
    item = " ".join(f"q{k}" for k in range(15))
    light = "Intro. " + " ".join(f"w{k}" for k in range(400)) + f"; {item.upper()}! Outro"
    docs, bench = frames.docs(spark, [light, item, "clean words"]), spark.createDataFrame([(1, item)], "item_id long, text string")
    for limit in (D.INDEX_WORDS, 0):
        rows = {r.doc_id: r for r in D.decontaminate(docs, bench, index_words=limit).collect()}
        assert sorted(rows) == [0, 2]
        assert rows[0].text == light.replace(item.upper(), "") and rows[0].n_chars == len(rows[0].text) and rows[2].text == "clean words"


def test_awkward_rows(spark):
    bench = spark.createDataFrame([(1, "word word word"), (2, "同 文")], "item_id long, text string")
    for limit in (D.INDEX_WORDS, 0):
        got = {(r.doc_id, r.n_words, r.n_hit) for r in D.scan_documents(frames.awkward(spark), bench, index_words=limit).collect()}
        assert {(1, 0, 0), (2, 0, 0), (3, 60_000, 60_000), (4, 3, 0)} <= got
        assert D.scan_documents(frames.empty(spark), bench, index_words=limit).count() == 0
        assert D.scan_documents(frames.awkward(spark), bench.limit(0), index_words=limit).where("n_hit > 0").count() == 0


@pytest.mark.parametrize("filter_bits", [1 << 20, 1 << 27])
def test_hot_windows_texts_and_full_filters(spark, monkeypatch, filter_bits):
    """Passages that many documents share, items that share passages, and copies of one text: all keys are hot."""
    monkeypatch.setattr("leadloom.llm.common.HOT_SHARE", 5)
    monkeypatch.setattr(D, "FILTER_BITS", filter_bits)
    passage = " ".join(f"p{k}" for k in range(20))
    items = [(i, passage + f" tail {i}") for i in range(30)] + [(100, "short item"), (None, "nameless item of few words")]
    texts = [f"{passage} own {i} short item" for i in range(40)] + [passage] * 30 + ["Nameless ITEM of few words, " * 3, None]
    docs, bench = frames.docs(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    want = {i: brute(t, items) for i, t in enumerate(texts)}
    for limit in (D.INDEX_WORDS, 0):
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in D.scan_documents(docs, bench, index_words=limit).collect()}
        assert got == want


def test_index_size_is_as_stated():
    draw = random.Random(1)
    items = [(i, " ".join(f"w{draw.randrange(20_000)}" for _ in range(50))) for i in range(2000)]
    assert len(pickle.dumps(D.WindowIndex(items))) < D.BYTES_PER_WORD * 100_000
