"""Many words in whole texts: which of them a text holds.

A word is held where its characters stand in the lower-cased text, as part of longer words too. Up to
``FEW`` words are tested one by one inside the engine. More are one Aho-Corasick automaton,
which reads a text once whatever their number; the words, not the automaton, are broadcast, and every
Python worker builds it once, in some hundred bytes a character. Lists of more than ``BLOCK_CHARS`` characters are taken in blocks
of about that size by a hash of the word, one scan each: the rows lie still, no text is shuffled,
and only one block is on the driver and in a worker at a time.

Null texts hold nothing; null and empty words are none.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.stages import stage

FEW = 50
BLOCK_CHARS = 2_000_000
#: Rows that a worker turns into Python objects at a time.
PIECE_ROWS = 128


def automaton(words: list[str]):
    out = ahocorasick.Automaton()
    for w in words:
        out.add_word(w, w)
    out.make_automaton()
    return out


def found_in(machine, text: str | None) -> list[str]:
    """The distinct words of the automaton that the text holds, sorted."""
    return sorted({w for _, w in machine.iter(text.lower())}) if text and len(machine) else []


def _known(words: DataFrame, column: str) -> DataFrame:
    return words.select(F.lower(F.col(column)).alias("word")).where("word <> ''").distinct()


def blocks(words: DataFrame, column: str = "word", most_chars: int = BLOCK_CHARS) -> Iterator[list[str]]:
    """The distinct lower-cased words in lists of about most_chars characters at most, each sorted."""
    known = stage(_known(words, column), "words")
    total = known.agg(F.sum(F.length("word"))).first()[0] or 0
    n = -(-total // most_chars)
    for k in range(n):
        yield sorted(r[0] for r in known.where(F.pmod(F.xxhash64("word"), F.lit(n)) == k).collect())  # about most_chars characters


def _few(words: list[str], text: Column) -> Column:
    return F.filter(F.array(*(F.lit(w) for w in words)), lambda w: F.coalesce(F.contains(F.lower(text), w), F.lit(False)))


def _scan(df: DataFrame, text: str, words: list[str], hits: str | None) -> DataFrame:
    """The rows with the words they hold added to the array ``hits``, or, without it, the rows that hold none."""
    shared, at, place = df.sparkSession.sparkContext.broadcast(words), df.columns.index(text), df.columns.index(hits) if hits else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(shared.value)
        for b in batches:
            for start in range(0, b.num_rows, PIECE_ROWS):
                piece = b.slice(start, PIECE_ROWS)
                found = [found_in(machine, x) for x in piece.column(at).to_pylist()]
                if hits is None:
                    yield piece.filter(pa.array([not x for x in found]))
                else:
                    old = piece.column(place).to_pylist()
                    yield piece.set_column(place, hits, pa.array([sorted({*o, *x}) for o, x in zip(old, found, strict=True)], pa.list_(pa.string())))

    return df.mapInArrow(run, df.schema)


def with_words(df: DataFrame, text: str, words: DataFrame, column: str = "word", hits: str = "hits", most_chars: int = BLOCK_CHARS, few: int = FEW) -> DataFrame:
    """Adds ``hits``: the words of the list that the text holds, sorted."""
    out = df.withColumn(hits, F.array().cast("array<string>"))
    for k, block in enumerate(blocks(words, column, most_chars)):
        if k == 0 and len(block) <= few:
            out = out.withColumn(hits, F.array_sort(_few(block, F.col(text))))
        else:
            out = _scan(out if k == 0 else stage(out, "words"), text, block, hits)
    return out


def without_words(df: DataFrame, text: str, words: DataFrame, column: str = "word", most_chars: int = BLOCK_CHARS, few: int = FEW) -> DataFrame:
    """The rows whose text holds no word of the list."""
    out = df
    for k, block in enumerate(blocks(words, column, most_chars)):
        if k == 0 and len(block) <= few:
            out = out.where(F.size(_few(block, F.col(text))) == 0)
        else:
            out = _scan(out if k == 0 else stage(out, "words"), text, block, None)
    return out
