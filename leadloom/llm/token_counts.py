"""Edit-aware token counts with a pre-token segment tree per document.

A byte-level BPE first cuts a text into pre-tokens by a pattern and then encodes
each for itself, so a document's count is the sum over its pre-tokens. They are
kept in leaves of bounded size under a tree of sums. An edit goes down the tree
to its place; pre-tokens are cut again only from the one before the edit until
a cut falls on an old boundary behind it; only these are encoded, and the sums on
the leaf's path are updated. The pattern never looks back, so from
a common boundary on all cuts are the old ones, and the result equals a full
recount.

The vocabulary's path is a parameter; the driver reads the file and broadcasts it, so
executors don't need it. The counts of common pre-tokens are remembered within a
Python worker, up to a bound.

Defined cases: a null text is empty and has no tokens. Edits (position, characters
deleted, text inserted) are applied in order, each to the text that the ones
before left; positions and lengths beyond the text are cut down to it; a null
edit or null field counts as nothing. Every row gives one row, an empty table none. Other columns play no part.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces_of, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pre-token pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF = 128
EDIT = "struct<at:int,remove:int,insert:string>"
FIELDS = [("n_tokens_before", pa.int64()), ("n_tokens", pa.int64()), ("n_chars", pa.int64()), ("n_reencoded", pa.int64())]
DDL = "n_tokens_before long, n_tokens long, n_chars long, n_reencoded long"


class Counter(dict):
    """Tokens of a pre-token, remembered."""

    def __init__(self, vocabulary: bytes):
        super().__init__()
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.encoding = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cut = regex.compile(PATTERN)

    def __missing__(self, piece: str) -> int:
        if len(self) > 300_000:
            self.clear()
        self[piece] = n = len(self.encoding.encode_ordinary(piece))
        return n


@lru_cache(2)
def counter_of(vocabulary: bytes) -> Counter:
    return Counter(vocabulary)


def counter(path: str) -> Counter:
    with open(path, "rb") as f:
        return counter_of(f.read())


class TokenTree:
    """A text as leaves of (length, tokens) pre-tokens below a tree of character and token sums."""

    def __init__(self, text: str, tokens: Counter):
        self.text, self.tokens = text, tokens
        pieces = tokens.cut.findall(text)
        cells = [(len(p), tokens[p]) for p in pieces]
        self.reencoded = 0
        self._build([cells[i : i + LEAF] for i in range(0, len(cells), LEAF)] or [[]])

    def _build(self, leaves: list[list[tuple[int, int]]]) -> None:
        self.leaves, n = leaves, 1
        while n < len(leaves):
            n *= 2
        self.width = n
        self.chars, self.counts = [0] * (2 * n), [0] * (2 * n)
        for i, leaf in enumerate(leaves):
            self.chars[n + i], self.counts[n + i] = sum(c for c, _ in leaf), sum(t for _, t in leaf)
        for i in range(n - 1, 0, -1):
            self.chars[i], self.counts[i] = self.chars[2 * i] + self.chars[2 * i + 1], self.counts[2 * i] + self.counts[2 * i + 1]

    @property
    def total(self) -> int:
        return self.counts[1]

    def _find(self, at: int) -> tuple[int, int]:
        """(leaf, its first character) of the leaf that holds position at."""
        i, start = 1, 0
        while i < self.width:
            i *= 2
            if at >= start + self.chars[i] and self.chars[i + 1]:
                start += self.chars[i]
                i += 1
        return i - self.width, start

    def _set(self, leaf: int, cells: list[tuple[int, int]]) -> None:
        self.leaves[leaf] = cells
        i = leaf + self.width
        self.chars[i], self.counts[i] = sum(c for c, _ in cells), sum(t for _, t in cells)
        while i > 1:
            i //= 2
            self.chars[i], self.counts[i] = self.chars[2 * i] + self.chars[2 * i + 1], self.counts[2 * i] + self.counts[2 * i + 1]

    def edit(self, at: int, remove: int, insert: str) -> None:
        at = min(max(at, 0), len(self.text))
        remove = min(max(remove, 0), len(self.text) - at)
        if not remove and not insert:
            return
        old_end, shift = at + remove, len(insert) - remove
        new = self.text[:at] + insert + self.text[old_end:]
        # restart at the first pre-token that ends one character before the edit or later: white space in front
        # of a word gives its last character back after it has looked at the word
        leaf, start = self._find(max(0, at - 2))
        k, pos = 0, start
        cells = self.leaves[leaf]
        while k < len(cells) and pos + cells[k][0] < at - 1:
            pos += cells[k][0]
            k += 1
        first_leaf, kept, restart = leaf, cells[:k], pos
        # walk the old boundaries and the new cuts until they meet behind the edit
        old, cuts, new_pos = restart, [], restart
        matches = self.tokens.cut.finditer(new, restart)
        while True:
            while old < old_end or old + shift < new_pos:
                while k >= len(self.leaves[leaf]):
                    if leaf + 1 >= len(self.leaves):
                        break
                    leaf, k = leaf + 1, 0
                if k >= len(self.leaves[leaf]):
                    break
                old += self.leaves[leaf][k][0]
                k += 1
            if old >= old_end and old + shift == new_pos and new_pos >= at + len(insert):
                break
            m = next(matches, None)
            if m is None:
                break
            piece = m[0]
            cuts.append((len(piece), self.tokens[piece]))
            self.reencoded += len(piece)
            new_pos = m.end()
        self.text = new
        last = self.leaves[leaf][k:]
        cells = kept + cuts + last
        for gone in range(first_leaf + 1, leaf + 1):
            self._set(gone, [])
        self._set(first_leaf, cells)
        if len(cells) > 4 * LEAF:  # split an overfull leaf: the tree is built anew
            flat = [x for y in self.leaves for x in y]
            self._build([flat[i : i + LEAF] for i in range(0, len(flat), LEAF)])


def count_edited(text: str | None, edits: list[dict] | None, tokens: Counter) -> tuple[int, int, int, int]:
    tree = TokenTree(text or "", tokens)
    before = tree.total
    for e in edits or []:
        if e is not None:
            tree.edit(e["at"] or 0, e["remove"] or 0, e["insert"] or "")
    return before, tree.total, len(tree.text), tree.reencoded


def with_edits(docs: DataFrame, edits: DataFrame, *, id_col: str = "doc_id", seq_col: str = "seq") -> DataFrame:
    """The documents with the column edits, gathered in order of seq from a table (id, seq, at, remove, insert).

    A document's edits come into one row with it, in which they are applied one
    after the other; the edits of one id aren't split further.
    """
    own = edits.groupBy(F.col(id_col).alias("_id")).agg(F.transform(F.sort_array(F.collect_list(F.struct(F.col(seq_col).alias("seq"), "at", "remove", "insert"))), lambda e: F.struct(e["at"].cast("int").alias("at"), e["remove"].cast("int").alias("remove"), e["insert"].alias("insert"))).alias("edits"))
    return docs.join(own, docs[id_col] == own["_id"], "left").drop(own["_id"])


def edited_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits", vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row: tokens before and after the edits, characters after them, and the characters encoded again."""
    src = docs.select(F.col(id_col), F.col(text_col), F.col(edits_col))
    with open(vocabulary, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter_of(shared.value)
        for b in pieces_of(batches):
            rows = [count_edited(t, e, tokens) for t, e in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            cols = list(zip(*rows, strict=True)) or [[]] * len(FIELDS)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, (_, t) in zip(cols, FIELDS, strict=True))], names=[id_col, *(n for n, _ in FIELDS)])

    return src.mapInArrow(run, f"`{id_col}` {src.schema[0].dataType.simpleString()}, {DDL}")


def derived_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with three edits each, derived from the id and the text: an insertion, a deletion, a replacement."""
    size = F.length(F.coalesce(F.col(text_col), F.lit("")))

    def place(k: int):
        return F.pmod(F.xxhash64(F.col(id_col), F.lit(k)), size + 1).cast("int")

    def edit(k: int, remove: int, insert):
        return F.struct(place(k).alias("at"), F.lit(remove).alias("remove"), insert.alias("insert"))

    opening = F.substring(F.coalesce(F.col(text_col), F.lit("")), 1, 24)
    return docs.withColumn("edits", F.array(edit(1, 0, opening), edit(2, 12, F.lit("")), edit(3, 7, F.lit("[removed]"))))


def op3_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_counts(derived_edits(table(spark, sf_dir, "documents").select("doc_id", "text")))
