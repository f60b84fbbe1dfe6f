import random
import re
import time

import regex

from leadloom.llm import license_scan as S

from . import frames


def brute(text, notices=S.NOTICES):
    """Base figures and fuzzy labels without seeds or grams: every notice's pattern over the whole text."""
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    places = [(i, label) for phrase, label in S.PHRASES for i in range(len(ws)) if ws[i : i + len(phrase.split())] == phrase.split()]
    fuzzy = []
    for notice, label in notices:
        for m in regex.finditer(f"(?b)(?:{regex.escape(notice, literal_spaces=True)}){{e<={len(notice) // S.CHARS_PER_ERROR}}}", " ".join(ws)):
            fuzzy.append((label, notice, m.start(), m.end(), sum(m.fuzzy_counts)))
    return len(ws), places, {x[0] for x in S.best_of(fuzzy)}


def test_seeds_find_what_the_whole_search_finds():
    draw, find = random.Random(3), S.finder(S.NOTICES, S.CHARS_PER_ERROR)
    for k in range(62):
        notice = S.NOTICES[k][0]
        chars = list(notice)
        for _ in range(draw.randint(0, len(notice) // S.CHARS_PER_ERROR)):
            i = draw.randrange(len(chars))
            chars[i : i + 1] = draw.choice([[], ["q"], [chars[i], "z"]])
        text = f"Intro words {k}. {''.join(chars).upper()} and the MIT License, ünd more."
        n, places, labels = brute(text)
        got = S.scan_text(text.encode(), find)
        assert (got[0], got[1]) == (n, len(places))
        assert set(filter(None, got[5].split(","))) == labels | {label for _, label in places}


def test_spans_and_edits():
    find = S.finder(S.NOTICES, S.CHARS_PER_ERROR)
    text = "ünï: Relesed under te MIT Licence. Bye"
    *_, score, hits = S.scan_text(text.encode(), find)
    assert [(h["label"], text[h["start"] : h["end"]]) for h in hits] == []  # three edits are more than 30 characters allow
    *_, hits = S.scan_text("ünï: Relesed under the MIT Licence. Bye".encode(), find)
    assert [(h["label"], h["edits"]) for h in hits] == [("mit", 2)]
    assert "ünï: Relesed under the MIT Licence. Bye"[hits[0]["start"] : hits[0]["end"]] == "Relesed under the MIT Licence"
    assert S.scan_text("Licensed under CC BY-NC 4.0.".encode(), find)[5] == "cc-by-nc"
    assert S.scan_text("Licensed under CC BY-SA 4.0.".encode(), find)[5] == "cc-by-sa"
    assert 0 <= score <= 1


def test_places():
    got = S.scan_text(b"MIT License mit license. Apache, License; GENERAL public-license", S.finder(S.NOTICES, S.CHARS_PER_ERROR))
    assert got[:6] == (9, 4, 0, 6, "apache,gpl,mit", "apache,gpl,mit") and got[6] == 1.0


def test_query_equals_brute_force(spark):
    """Base figures of all documents; labels of those that a word of a license stands in and of some others, by patterns over whole texts."""
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    told = [i for i, t in sorted(docs.items()) if re.search("(?i)licen|permission|redistribut|gnu|creative", t)]
    fuzzy = {*[i for i in told if len(docs[i]) < 3000][:12], *[i for i, t in sorted(docs.items()) if len(t) < 1200][:8]}
    for r in S.op6_license_scan(spark, "/root/testdata/sf0.001").collect():
        n, places, labels = brute(docs[r.doc_id], S.NOTICES if r.doc_id in fuzzy else ())
        starts = [p for p, _ in places]
        base = {label for _, label in places}
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(places), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted(base)) and (r.doc_id not in fuzzy or r.labels == ",".join(sorted(base | labels)))


def test_awkward_rows(spark):
    got = {(r.doc_id, r.n_words, r.labels, r.score) for r in S.scan_licenses(frames.awkward(spark)).collect()}
    assert (1, 0, "", 0.0) in got and (2, 0, "", 0.0) in got and (3, 60_000, "", 0.0) in got
    assert S.scan_licenses(frames.empty(spark)).count() == 0


def spans_without_seeds(text, notice):
    """Best match of the whole text, then the same before and behind it."""
    pattern = regex.compile(f"(?b)(?:{regex.escape(notice, literal_spaces=True)}){{e<={len(notice) // S.CHARS_PER_ERROR}}}")

    def look(a, b):
        m = pattern.search(text, a, b)
        return [*look(a, m.start()), (m.start(), m.end(), sum(m.fuzzy_counts)), *look(m.end(), b)] if m else []

    return look(0, len(text))


def test_a_worse_match_before_the_best_stays():
    text = "relesed under the mit license a released under the mit license"
    *_, hits = S.scan_text(text.encode(), S.finder(S.NOTICES, S.CHARS_PER_ERROR))
    assert [(text[h["start"] : h["end"]], h["edits"]) for h in hits] == [("relesed under the mit license", 1), ("released under the mit license", 0)]


def test_spans_of_near_by_notices():
    draw = random.Random(5)
    for _ in range(15):
        notice, label = draw.choice(S.NOTICES)
        find, words = S.finder(((notice, label),), S.CHARS_PER_ERROR), []
        for _ in range(draw.randint(2, 5)):
            chars = list(notice)
            for _ in range(draw.randint(0, len(notice) // S.CHARS_PER_ERROR)):
                i = draw.randrange(len(chars))
                chars[i : i + 1] = draw.choice([[], ["q"], [chars[i], "z"]])
            words += ["".join(chars), draw.choice(["foo", "and more of this", "a"])]
        text = " ".join(" ".join(words).split())
        got = [(a, b, e) for _, _, a, b, e in find.find(text)]
        assert got == spans_without_seeds(text, notice)


def test_time_is_linear_in_a_text():
    find, notice = S.finder(S.NOTICES, S.CHARS_PER_ERROR), "licensed under the gnu general public license under the terms of the gnu general public license "
    for text, n in (("mit license " * 87_000, 87_000), (notice * 1100, 2200), ("relesed under the mit license and " * 3000, 3000)):
        began = time.process_time()
        got = S.scan_text(text.encode(), find)
        assert time.process_time() - began < 2
        assert got[1] == n
    assert len(got[7]) == 3000 and {h["edits"] for h in got[7]} == {1}
