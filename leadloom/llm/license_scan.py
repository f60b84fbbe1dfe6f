"""License scans by fuzzy short-notice search.

A text is reduced to its lower-cased words joined by single spaces. Each notice
may differ by up to k = length // ``chars_per_error`` edits (inserted, deleted or
changed characters). Cut into k + 1 pieces, a notice that occurs with at most k
edits holds one of its pieces unchanged (pigeonhole principle), so an
Aho-Corasick automaton over all pieces finds every candidate in one pass over the
text. An edit changes at most q of a notice's grams of q characters, so a window that holds fewer of them than
that leaves can't be a match and is passed over. Around the other candidates only, the regex library's bounded-error matching
verifies the edits and gives the span. Each candidate is searched in a window of
its own, no longer than the notice and a few times k, so the time is linear in the
text whatever repeats in it. Of one notice's matches that overlap the best stays,
the first of equal ones; what is left of a window beside better matches is searched
again.

Besides, plain phrases are counted exactly, word by word (``PHRASES``).

Defined cases: a null text is an empty one; texts without hits have empty labels
and score 0. Every row gives one row, repeated rows included, an empty table none. Matches of one notice don't overlap. Other columns play no part.
"""

from __future__ import annotations

import bisect
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces_of, table, words

#: Phrases that are counted exactly, and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Notices that are searched with errors, as lower-case words of the licenses' own texts, and their labels.
NOTICES = (
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("the above copyright notice and this permission notice shall be included in all copies", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("unless required by applicable law or agreed to in writing software distributed under the license", "apache"),
    ("licensed under the gnu general public license", "gpl"),
    ("under the terms of the gnu general public license", "gpl"),
    ("you should have received a copy of the gnu general public license", "gpl"),
    ("this program is free software you can redistribute it and or modify", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("gnu free documentation license", "gfdl"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("under the terms of the eclipse public license", "epl"),
    ("common development and distribution license", "cddl"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("redistributions of source code must retain the above copyright notice", "bsd"),
    ("redistributions in binary form must reproduce the above copyright notice", "bsd"),
    ("may be used to endorse or promote products derived from this software without specific prior written permission", "bsd"),
    ("released under the bsd license", "bsd"),
    ("licensed under the bsd license", "bsd"),
    ("bsd 3 clause license", "bsd"),
    ("bsd 2 clause license", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("released under the isc license", "isc"),
    ("altered source versions must be plainly marked as such", "zlib"),
    ("the origin of this software must not be misrepresented", "zlib"),
    ("distributed under the boost software license", "bsl-1.0"),
    ("boost software license version 1 0", "bsl-1.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("creative commons attribution noderivatives", "cc-by-nd"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under a creative commons attribution", "cc-by"),
    ("creative commons attribution 4 0 international license", "cc-by"),
    ("cc0 1 0 universal public domain dedication", "cc0"),
    ("has waived all copyright and related or neighboring rights", "cc0"),
    ("free and unencumbered software released into the public domain", "unlicense"),
    ("do what the fuck you want to public license", "wtfpl"),
    ("licensed under the sil open font license", "ofl"),
    ("sil open font license version 1 1", "ofl"),
    ("under the terms of the artistic license", "artistic"),
    ("the artistic license 2 0", "artistic"),
    ("european union public licence", "eupl"),
    ("microsoft public license", "ms-pl"),
    ("microsoft reciprocal license", "ms-rl"),
    ("licensed under the academic free license", "afl"),
    ("licensed under the open software license", "osl"),
    ("python software foundation license", "psf"),
    ("released under the postgresql license", "postgresql"),
    ("licensed under the educational community license", "ecl"),
    ("open data commons open database license", "odbl"),
    ("open data commons attribution license", "odc-by"),
    ("server side public license", "sspl"),
    ("business source license 1 1", "busl"),
    ("licensed under the elastic license", "elastic"),
    ("licensed under the university of illinois ncsa open source license", "ncsa"),
)
CHARS_PER_ERROR = 12
CELL = 128
#: Characters of the grams that a window must share with its notice.
GRAM = 5

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
HITS = pa.list_(pa.struct([("label", pa.string()), ("notice", pa.string()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())]))
FIELDS = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("hits", HITS)]
DDL = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, hits array<struct<label:string,notice:string,start_word:long,end_word:long,start:long,end:long,edits:int>>"


def pieces(notice: str, errors: int) -> list[tuple[int, str]]:
    """The notice cut into errors + 1 pieces of like length, with their offsets."""
    edges = [len(notice) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, notice[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


class Finder:
    """The automaton over all pieces, and the bounded-error pattern of each notice."""

    def __init__(self, notices: tuple[tuple[str, str], ...], chars_per_error: int):
        self.notices, self.grams, self.known, seeds = [], [], {}, {}
        for at, (notice, label) in enumerate(notices):
            errors = len(notice) // chars_per_error
            self.notices.append((notice, label, errors, regex.compile(f"(?b)(?:{regex.escape(notice, literal_spaces=True)}){{e<={errors}}}")))
            grams = [notice[i : i + GRAM] for i in range(len(notice) - GRAM + 1)]
            self.grams.append((grams, len(grams) - GRAM * errors))
            for offset, piece in pieces(notice, errors):
                seeds.setdefault(piece, []).append((at, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in seeds.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()

    def candidates(self, text: str) -> dict[int, list[tuple[int, int]]]:
        """Per notice, the windows of text in which it may lie, each for seeds whose places agree up to the errors."""
        starts: dict[int, set[int]] = {}
        for end, (size, owners) in self.automaton.iter(text):
            for at, offset in owners:
                starts.setdefault(at, set()).add(end + 1 - size - offset)
        out = {}
        for at, found in starts.items():
            notice, _, errors, _ = self.notices[at]
            windows, first = [], None
            for p in sorted(found):
                if first is None or p > first + errors:
                    first = p
                    windows.append((p, p))
                else:
                    windows[-1] = (first, p)
            out[at] = [(max(0, a - errors), min(len(text), b + len(notice) + errors)) for a, b in windows]
        return out

    def best_in(self, at: int, part: str) -> tuple[int, int, int] | None:
        """(start, end, edits) of a notice's best match in a short text; remembered, because windows repeat."""
        if (at, part) in self.known:
            return self.known[at, part]
        grams, least = self.grams[at]
        held = {part[i : i + GRAM] for i in range(len(part) - GRAM + 1)}
        m = self.notices[at][3].search(part) if sum(g in held for g in grams) >= least else None
        if len(self.known) > 20_000:
            self.known.clear()
        self.known[at, part] = found = (m.start(), m.end(), sum(m.fuzzy_counts)) if m else None
        return found

    def find(self, text: str) -> list[tuple[str, str, int, int, int]]:
        """(label, notice, start, end, edits) of verified matches."""
        out = []
        for at, windows in self.candidates(text).items():
            notice, label, errors, _ = self.notices[at]
            heap: list[tuple[int, int, int, int, int]] = []

            def look(a: int, b: int, at=at, least=len(notice) - errors, heap=heap):
                if b - a >= least and (m := self.best_in(at, text[a:b])):
                    heapq.heappush(heap, (m[2], a + m[0], a + m[1], a, b))

            for a, b in windows:
                look(a, b)
            taken: list[tuple[int, int]] = []  # in order, not overlapping
            while heap:
                edits, first, last, a, b = heapq.heappop(heap)
                near = bisect.bisect_left(taken, (first, first))
                before, behind = taken[near - 1] if near else None, taken[near] if near < len(taken) else None
                over = before if before and before[1] > first else behind if behind and behind[0] < last else None
                if over is None:
                    taken.insert(near, (first, last))
                    out.append((label, notice, first, last, edits))
                    over = first, last
                look(a, min(b, over[0]))
                look(max(a, over[1]), b)
        return sorted(best_of(out), key=lambda x: (x[2], x[3], x[0], x[1]))


def best_of(found: list[tuple[str, str, int, int, int]]) -> list[tuple[str, str, int, int, int]]:
    """Where matches of different labels overlap, those with the fewest edits a character; ties all stay."""
    kept: list[tuple[str, str, int, int, int]] = []
    cells: dict[int, list] = {}  # kept matches by the stretches of CELL characters that they touch
    for x in sorted(found, key=lambda x: (x[4] / len(x[1]), -len(x[1]), x[2], x[1])):
        rate, own = x[4] / len(x[1]), range(x[2] // CELL, x[3] // CELL + 1)
        if all(y[0] == x[0] or y[3] <= x[2] or x[3] <= y[2] or y[4] / len(y[1]) == rate for c in own for y in cells.get(c, ())):
            kept.append(x)
            for c in own:
                cells.setdefault(c, []).append(x)
    return kept


@lru_cache(4)
def finder(notices: tuple[tuple[str, str], ...], chars_per_error: int) -> Finder:
    return Finder(notices, chars_per_error)


def phrase_places(joined: bytes, phrase: str) -> list[int]:
    """Word positions at which the phrase's words stand; joined: the words between single spaces, one at either end too."""
    key, out, at, last, n = b" " + phrase.encode() + b" ", [], -1, 0, 0
    while (at := joined.find(key, at + 1)) >= 0:
        n += joined.count(b" ", last, at)
        last = at
        out.append(n)
    return out


def scan_text(raw: bytes | None, search: Finder, phrases=PHRASES) -> tuple:
    ws = words(raw or b"")
    flat = b" ".join(ws)
    joined = b" " + flat + b" "
    places = [(p, label) for phrase, label in phrases for p in phrase_places(joined, phrase)]
    text, hits = flat.decode(), []
    found = search.find(text)
    if found:
        at = [m.span() for m in _WORD.finditer(raw.decode())]
        spaces = [m.start() for m in re.finditer(" ", text)]
        for label, notice, a, b, edits in found:
            first, last = bisect.bisect_left(spaces, a), bisect.bisect_left(spaces, max(a, b - 1))
            hits.append({"label": label, "notice": notice, "start_word": first, "end_word": last + 1, "start": at[first][0], "end": at[last][1], "edits": edits})
    base = {label for _, label in places}
    score = 1.0 if places else max((1 - h["edits"] / len(h["notice"]) for h in hits), default=0.0)
    starts = [p for p, _ in places]
    return len(ws), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | {h["label"] for h in hits})), score, hits


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", notices=NOTICES, phrases=PHRASES, chars_per_error: int = CHARS_PER_ERROR) -> DataFrame:
    """Per row: exact phrase figures, labels, score, and the verified spans (word and character positions, edits)."""
    src = docs.select(F.col(id_col), F.col(text_col))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = finder(notices, chars_per_error)
        for b in pieces_of(batches):
            rows = [scan_text(raw, search, phrases) for raw in b.column(1).cast(pa.binary()).to_pylist()]
            cols = list(zip(*rows, strict=True)) or [[]] * len(FIELDS)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, (_, t) in zip(cols, FIELDS, strict=True))], names=[id_col, *(n for n, _ in FIELDS)])

    return src.mapInArrow(scan, f"`{id_col}` {src.schema[0].dataType.simpleString()}, {DDL}")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("hits")
