"""Benchmark decontamination with a broadcast set of normalised word windows.

Every benchmark item gives its windows of ``width`` words (an item of fewer
words, but not none, is one window). The windows go to the executors as one
compact index; each document is scanned once, candidate windows are found by a
rolling hash and verified word by word.

The index takes about a hundred bytes a benchmark word, on the driver and in every
Python worker, so it is broadcast only for a benchmark of up to ``index_words``
words. A larger one stays a table: a bit filter of its window hashes, of fixed size,
is broadcast instead, and only the windows of documents that pass it are joined
with the benchmark's by digest. Items are named once per set of items and
combination of sets, not per hit. Both ways give the same rows.

Defined cases: a null or wordless text has no words and no hits. Benchmark rows
with a null item_id still mark words as hit but are no item. A repeated item_id
is one item with the windows of all its rows. Every document row gives one
result row, repeated rows included, an empty table none; an empty benchmark hits nothing. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, free_names, hot_join, live_cuts, pieces_of, table, tidy, words

WIDTH = 13
#: Largest benchmark, in words, whose windows are broadcast: an index of 50 MB.
INDEX_WORDS = 500_000
BYTES_PER_WORD = 100
#: Bits of the filter for larger ones: 16 MB.
FILTER_BITS = 1 << 27

#: A word in a text whose A-Z are not lower-cased yet.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCAN = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<struct<start:int,end:int>>"


class WindowIndex:
    """All windows of a benchmark as arrays: per length, sorted hashes with the words and the items of each."""

    def __init__(self, items: Iterable[tuple[object, str | None]], width: int = WIDTH):
        self.vocab: dict[bytes, int] = {}
        names: dict[str | None, int] = {}
        by_len: dict[int, list[tuple[np.ndarray, int]]] = {}
        for item_id, text in items:
            ws = words((text or "").encode())
            if ws:
                ids = np.fromiter((self.vocab.setdefault(x, len(self.vocab)) for x in ws), np.int32, len(ws))
                n = min(width, len(ws))
                by_len.setdefault(n, []).append((np.lib.stride_tricks.sliding_window_view(ids, n), names.setdefault(None if item_id is None else str(item_id), len(names))))
        self.names, sets = list(names), {}
        self.tables = [self._table(n, rows, sets) for n, rows in sorted(by_len.items())]
        self.groups = [sorted(x for i in g if (x := self.names[i]) is not None) for g in sets]

    @staticmethod
    def _table(n: int, rows: list[tuple[np.ndarray, int]], sets: dict[tuple, int]):
        owners = np.repeat(np.array([i for _, i in rows], np.int32), [len(w) for w, _ in rows])
        matrix, back = np.unique(np.concatenate([w for w, _ in rows]), axis=0, return_inverse=True)
        pairs = np.unique(np.stack((back.reshape(-1).astype(np.int32), owners), axis=1), axis=0)
        of = np.split(pairs[:, 1], np.flatnonzero(np.diff(pairs[:, 0])) + 1)
        owner = np.fromiter((sets.setdefault(tuple(x.tolist()), len(sets)) for x in of), np.int32, len(matrix))
        for seed in range(100):
            mult = np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.uint64) | np.uint64(1)
            hashes = np.zeros(len(matrix), np.uint64)
            for k in range(n):
                hashes += (matrix[:, k].astype(np.uint64) + np.uint64(1)) * mult[k]
            order = np.argsort(hashes)
            if len(matrix) < 2 or (np.diff(hashes[order]) != 0).all():
                break
        else:
            raise ValueError("window hashes collide under every seed")
        bits = np.zeros(1 << 20, dtype=bool)
        bits[(hashes >> np.uint64(44)).astype(np.int64)] = True
        return n, mult, hashes[order], matrix[order], owner[order], bits

    def scan(self, ws: list[bytes]) -> tuple[np.ndarray, list[str]]:
        """Starts and ends (word positions) of the maximal hit stretches, and the sorted ids of the items found."""
        get = self.vocab.get
        ids = np.fromiter((get(w, -1) for w in ws), np.int64, len(ws))
        unknown = np.concatenate(([0], np.cumsum(ids < 0)))
        edge, found = np.zeros(len(ws) + 1, np.int64), []
        for n, mult, hashes, matrix, owner, bits in self.tables:
            if len(ws) < n:
                continue
            at = np.flatnonzero(unknown[n:] == unknown[:-n])
            if not len(at):
                continue
            h = np.zeros(len(at), np.uint64)
            for k in range(n):
                h += (ids[at + k].astype(np.uint64) + np.uint64(1)) * mult[k]
            seen = bits[(h >> np.uint64(44)).astype(np.int64)]
            at, h = at[seen], h[seen]
            place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            ok = hashes[place] == h
            at, place = at[ok], place[ok]
            if len(at):  # verified on the words themselves
                ok = (ids[at[:, None] + np.arange(n)] == matrix[place]).all(axis=1)
                at, place = at[ok], place[ok]
                np.add.at(edge, at, 1)
                np.add.at(edge, at + n, -1)
                found.append(owner[place])
        if not found:
            return np.zeros((0, 2), np.int64), []
        hit = np.concatenate(([False], np.cumsum(edge) > 0, [False]))
        turn = np.flatnonzero(hit[1:] != hit[:-1]).reshape(-1, 2)
        names = {x for g in np.unique(np.concatenate(found)) for x in self.groups[g]}
        return turn, sorted(names)


def digest_of(names: list[str]) -> tuple[int, str]:
    """How many items there are, and the digest of their sorted names."""
    return len(names), hashlib.sha256(",".join(names).encode()).hexdigest()


def verdict(n_words: int, stretches: np.ndarray, items: tuple[int, str]) -> tuple:
    n_hit = int((stretches[:, 1] - stretches[:, 0]).sum())
    return n_words, n_hit, *items, n_hit > 0 and 20 * n_hit >= n_words


def char_spans(text: str, stretches: np.ndarray) -> list[tuple[int, int]]:
    """Character offsets of stretches given in word positions."""
    if not len(stretches):
        return []
    at = [m.span() for m in _WORD.finditer(text)]
    return [(at[a][0], at[b - 1][1]) for a, b in stretches.tolist()]


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans."""
    keep, last = [], 0
    for a, b in spans:
        keep.append(text[last:a])
        last = b
    return "".join([*keep, text[last:]])


def load_index(benchmark: DataFrame, item_col: str, text_col: str, width: int, index_words: int) -> WindowIndex | None:
    """The index, or None when the benchmark is above the bound."""
    items = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).alias("t")).where("t is not null")
    n_words, size = items.agg(F.sum(F.regexp_count("t", F.lit(_WORD.pattern))), F.sum(F.octet_length("t") + 16)).first()
    if (n_words or 0) > index_words or (size or 0) > BYTES_PER_WORD * index_words:
        return None
    return WindowIndex(((r.i, r.t) for r in items.distinct().toLocalIterator()), width)


FIELDS = pa.schema([("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def _locator(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text_col: str, width: int, index_words: int):
    """(docs, find): find(row batch) yields (text, words, stretches, number and digest of items) of each row.

    Below the bound the broadcast index finds them; above it the documents come
    with three more columns at the end, the places, the items' number and their
    digest, from a join on window digests.
    """
    at, index = docs.columns.index(text_col), load_index(benchmark, item_col, item_text_col, width, index_words)
    if index is not None:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def scan(b: pa.RecordBatch):
            found = shared.value
            for text in b.column(at):
                ws = words(text.cast(pa.binary()).as_py()) if text.is_valid else []
                stretches, names = found.scan(ws)
                yield text.as_py(), ws, stretches, digest_of(names)

        return docs, scan

    def gather(b: pa.RecordBatch):
        for text, places, n, sha in zip(b.column(at).to_pylist(), *(b.column(b.num_columns - k).to_pylist() for k in (3, 2, 1)), strict=True):
            merged: list[list[int]] = []
            for p in places or []:
                if merged and p["at"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], p["to"])
                else:
                    merged.append([p["at"], p["to"]])
            yield text, words((text or "").encode()), np.array(merged, np.int64).reshape(-1, 2), digest_of([]) if n is None else (n, sha)

    return _hits_by_join(docs, text_col, benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("t")), width), gather


def window_hashes(ws: list[bytes], n: int) -> np.ndarray:
    """A 64-bit hash of each window of n words."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))
    m = max(0, len(ws) - n + 1)
    out = np.full(m, n, np.uint64)
    for k in range(n):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[k : k + m]
    return out ^ (out >> np.uint64(32))


def window_digest(ws: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(ws), digest_size=16).digest()


def bit_filter(targets: DataFrame) -> np.ndarray:
    """FILTER_BITS bits, those set at which a target's hash lies: a fixed size, added up by the executors."""
    place = F.expr(f"(hash & {FILTER_BITS - 1}) + 1")
    parts = targets.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in parts.collect():
        out[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def _hits_by_join(docs: DataFrame, text_col: str, benchmark: DataFrame, width: int) -> DataFrame:
    """The documents with the places (word positions) of the windows that they share with a benchmark of any size, and their items' number and digest."""
    spark, since = docs.sparkSession, live_cuts()

    def windows_of(batches):
        for b in pieces_of(batches):
            ids, sizes, keys, digests = [], [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ws = words((t or "").encode())
                n = min(width, len(ws))
                if n:
                    own = window_hashes(ws, n)
                    ids += [i] * len(own)
                    sizes += [n] * len(own)
                    keys.append(own)
                    digests += [window_digest(ws[k : k + n]) for k in range(len(own))]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(sizes, pa.int32()), pa.array(np.concatenate([*keys, np.zeros(0, np.uint64)]).view(np.int64)), pa.array(digests, pa.binary())], names=["item", "size", "hash", "digest"])

    targets = cut(benchmark.mapInArrow(windows_of, "item string, size int, hash long, digest binary").distinct())
    sizes = sorted(r[0] for r in targets.select("size").distinct().collect())  # at most `width` values
    shared = spark.sparkContext.broadcast(bit_filter(targets.select("hash").distinct()))

    def windows_in(batches):
        bits = shared.value
        for b in pieces_of(batches):
            docs_, ats, digests = [], [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                ws = words(t or b"")
                for n in sizes:
                    place = (window_hashes(ws, n) & np.uint64(FILTER_BITS - 1)).astype(np.int64)
                    at = np.flatnonzero(bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).tolist()
                    docs_ += [k] * len(at)
                    ats += at
                    digests += [window_digest(ws[i : i + n]) for i in at]
            yield pa.RecordBatch.from_arrays([pa.array(docs_, pa.binary()), pa.array(ats, pa.int32()), pa.array(digests, pa.binary())], names=["doc", "at", "digest"])

    key = F.unhex(F.md5(F.col(text_col)))
    keyed = docs.select(key.alias("doc"), F.col(text_col).alias("text")).where("doc is not null")
    passed = cut(keyed.mapInArrow(windows_in, "doc binary, at int, digest binary").distinct())  # texts don't travel, equal ones give their windows once
    # windows of the same items share one set of items
    owned = targets.groupBy("digest").agg(F.first("size").alias("size"), F.sort_array(F.collect_set("item")).alias("items")).withColumn("set", F.md5(F.concat_ws(",", "items")))
    owned = cut(owned)
    wanted = passed.groupBy(F.col("digest").alias("_digest")).agg(F.count("*").alias("n")).join(owned.select("digest", "size", "set"), F.col("digest") == F.col("_digest")).select("digest", "size", "set", "n")
    hits = cut(hot_join(passed, wanted, ["digest"], "n", passed.count()))
    places = F.array_sort(F.collect_set(F.struct("at", (F.col("at") + F.col("size")).alias("to"))))
    per_text = cut(hits.groupBy("doc").agg(places.alias("places"), F.sort_array(F.collect_set("set")).alias("sets")))
    # combinations of sets are resolved once, whatever number of texts has them
    combos = per_text.select("sets").distinct()
    sets = owned.groupBy("set").agg(F.first("items").alias("items"))
    named = combos.select("sets", F.explode("sets").alias("_set")).join(sets, F.col("set") == F.col("_set")).select("sets", F.explode_outer("items").alias("item"))
    named = named.groupBy("sets").agg(F.sort_array(F.collect_set("item")).alias("items")).select("sets", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("sha"))
    weight = per_text.groupBy("sets").agg(F.count("*").alias("n_texts")).withColumnRenamed("sets", "_sets")
    named = named.join(weight, F.col("sets") == F.col("_sets")).drop("_sets")
    copies = keyed.groupBy(F.col("doc").alias("_doc")).agg(F.count("*").alias("copies"))
    resolved = hot_join(per_text, named, ["sets"], "n_texts", per_text.count()).join(copies, F.col("doc") == F.col("_doc"))

    doc, n_copies, places_, n_items, sha = free_names(docs, "_doc", "_copies", "_places", "_items", "_sha")
    right = resolved.select(F.col("doc").alias(doc), F.col("copies").alias(n_copies), F.col("places").alias(places_), F.col("n_items").alias(n_items), F.col("sha").alias(sha))
    out = hot_join(docs.withColumn(doc, key), right, [doc], n_copies, docs.count(), "left")
    tidy(spark, since, out)
    return out.drop(doc, n_copies)


def scan_documents(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH, index_words: int = INDEX_WORDS) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated and the character spans hit.

    contaminated: n_hit > 0 and at least a twentieth of the words are hit.
    items_sha256 is of the empty string when no item is found.
    """
    src, find = _locator(docs.select(F.col(id_col), F.col(text_col)), benchmark, text_col, item_col, item_text_col, width, index_words)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches):
            out = []
            for text, ws, stretches, items in find(b):
                spans = char_spans(text, stretches) if len(stretches) else []
                out.append((*verdict(len(ws), stretches, items), [{"start": x, "end": y} for x, y in spans]))
            cols = list(zip(*out, strict=True)) or [[]] * len(FIELDS)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, f.type) for c, f in zip(cols, FIELDS, strict=True))], names=[id_col, *FIELDS.names])

    return src.mapInArrow(scan, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, {SCAN}")


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", length_col: str | None = "n_chars", item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH, index_words: int = INDEX_WORDS) -> DataFrame:
    """The documents without contaminated ones, and without the hit spans in the others; all columns stay.

    ``length_col``, if the documents have it, becomes the new text's length where spans went.
    """
    src, find = _locator(docs, benchmark, text_col, item_col, item_text_col, width, index_words)
    n, at, length_at = len(docs.columns), docs.columns.index(text_col), docs.columns.index(length_col) if length_col in docs.columns else None

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches):
            keep, texts, lengths = [], [], b.column(length_at).to_pylist() if length_at is not None else None
            for i, (text, ws, stretches, items) in enumerate(find(b)):
                bad = verdict(len(ws), stretches, items)[4]
                keep.append(not bad)
                if len(stretches) and not bad:
                    text = cut_spans(text, char_spans(text, stretches))
                    if lengths is not None:
                        lengths[i] = len(text)
                texts.append(text)
            cols = list(b.columns[:n])
            cols[at] = pa.array(texts, b.schema.field(at).type)
            if lengths is not None:
                cols[length_at] = pa.array(lengths, b.schema.field(length_at).type)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:n]).filter(pa.array(keep, pa.bool_()))

    return src.mapInArrow(clean, docs.schema)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of the scan over all documents."""
    return scan_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


OP10_SQL = r"""
with d as (
  select row_number() over () as r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
  from documents),
b as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where text is not null),
bw as (
  select distinct item_id, least(len(w), 13) as n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') as win
  from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from b where len(w) > 0)),
sizes as (select distinct n from bw),
dw as (
  select r, i, n, array_to_string(w[i : i + n - 1], ' ') as win
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)),
hits as (select r, i, dw.n, item_id from dw join bw on dw.n = bw.n and dw.win = bw.win),
hw as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hits) group by r),
hi as (select r, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct r, cast(item_id as varchar) as item from hits where item_id is not null) group by r)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(d.w) as contaminated
from d left join hw using (r) left join hi using (r)
"""
