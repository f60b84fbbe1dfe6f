"""Quality rules with cross-document line frequency.

Every \\n-split line with a word is normalised (A-Z lower-cased, white space runs
to one space, trimmed) and hashed. Per host, the number of distinct documents
(ids) that hold a line is counted; a line in more than ``min_docs`` of them is
removed. A document that loses more than half of its word characters is depleted
and rejected.

With ``copies_once`` exact copies of a text within a host count as one document,
so a page copied a thousand times doesn't make its own lines frequent and go as a
whole; that is for pipelines in which a later stage keeps one of the copies.

Only a hash of each distinct line travels, the counts are added up before the
shuffle, and the verdict is keyed by (host, text), so groups of copies are judged
once.

Defined cases: a null or wordless text has no words and fails the base rules. A
null host is a host of its own. Every row gives one row, repeated rows included;
rows with one id are one document, each row without an id is one. White space is
ASCII's alone, so a line of U+00A0 has a word. Other columns of the documents play
no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, free_names, hot_join, live_cuts, pieces_of, table, tidy

#: A line may stand in so many documents of a host.
MIN_DOCS = 20
SYMBOLS = b"#*$%&|<>"

LINES = pa.list_(pa.struct([("line", pa.binary()), ("chars", pa.int64())]))
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, lines array<struct<line:binary,chars:long>>"
_FIELDS = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("lines", LINES)]


def code_points(raw: bytes) -> int:
    """Characters in valid UTF-8: bytes that don't continue a character."""
    return len(raw) if raw.isascii() else len(raw.decode())


def normal(line: bytes) -> bytes:
    return b" ".join(line.lower().split())


def line_key(line: bytes) -> bytes:
    return xxhash.xxh3_128_digest(normal(line))


def repeat_words(ws: list[bytes], width: int = 3) -> int:
    """Words that stand in a window of ``width`` words found twice or more."""
    if len(ws) <= width:
        return 0
    code: dict[bytes, int] = {}
    ids = np.fromiter((code.setdefault(w, len(code)) for w in ws), np.int64, len(ws))
    n = len(ws) - width + 1
    key = ids[:n]
    for k in range(1, width):  # re-coded at each step, so the product never overflows
        key = np.unique(key, return_inverse=True)[1] * len(code) + ids[k : k + n]
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    edge = np.zeros(len(ws) + 1, np.int64)
    at = np.flatnonzero(count[back] > 1)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return int((np.cumsum(edge) > 0).sum())


def measure(raw: bytes | None) -> tuple:
    """The base figures of one text, and its distinct normalised lines with the word characters each takes up."""
    raw = raw or b""
    ws, seen, dup, lines = raw.split(), set(), 0, {}
    for line in raw.split(b"\n"):
        parts = line.split()
        if parts:
            dup += line in seen
            seen.add(line)
            key = line_key(line)
            lines[key] = lines.get(key, 0) + sum(map(code_points, parts))
    n, repeated = len(ws), repeat_words(ws)
    symbols = sum(raw.count(bytes([c])) for c in SYMBOLS)
    return n, sum(lines.values()), symbols, dup, repeated, n < 50 or 100 * repeated > 50 * n, [{"line": k, "chars": v} for k, v in lines.items()]


def measure_documents(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text") -> DataFrame:
    """Per row: id, host, a digest of the text, the base figures and the line hashes."""
    src = docs.select(F.col(id_col), F.col(host_col).cast("string").alias("host"), F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))).alias("text_key"), F.col(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches):
            rows = [measure(raw) for raw in b.column(3).cast(pa.binary()).to_pylist()]
            cols = list(zip(*rows, strict=True)) or [[]] * len(_FIELDS)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *(pa.array(c, t) for c, (_, t) in zip(cols, _FIELDS, strict=True))], names=[id_col, "host", "text_key", *(n for n, _ in _FIELDS)])

    return src.mapInArrow(run, f"`{id_col}` {src.schema[0].dataType.simpleString()}, host string, text_key binary, {STATS}")


def counted_twice(measured: DataFrame, id_col: str) -> DataFrame:
    """(host, line, n_docs, n_texts): what must be added to counts of rows where several rows of one id hold a line."""
    known = measured.where(F.col(id_col).isNotNull())
    repeated = known.groupBy("host", id_col).agg(F.count("*").alias("n_rows")).where("n_rows > 1")
    held = hot_join(known, repeated, ["host", id_col], "n_rows", known.count()).select("host", id_col, F.explode("lines.line").alias("line"))
    return held.groupBy("host", id_col, "line").agg((1 - F.count("*")).alias("n_docs")).select("host", "line", "n_docs", F.lit(0).cast("long").alias("n_texts"))


def line_verdicts(measured: DataFrame, id_col: str, min_docs: int = MIN_DOCS, copies_once: bool = False) -> DataFrame:
    """Per (host, text_key) that loses a line: its copies, removed_chars and the hashes of the lines to remove."""
    texts = cut(measured.groupBy("host", "text_key").agg(F.first("lines").alias("lines"), F.count("*").alias("copies")))
    lines = texts.select("host", "text_key", "copies", F.explode("lines").alias("l")).select("host", "text_key", "copies", "l.line", "l.chars")
    one = F.lit(1).cast("long")
    held = lines.select("host", "line", (one if copies_once else F.col("copies")).alias("n_docs"), one.alias("n_texts"))
    if not copies_once:
        held = held.unionByName(counted_twice(measured, id_col))
    frequent = held.groupBy("host", "line").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_texts").alias("n_texts")).where(F.col("n_docs") > min_docs).drop("n_docs")
    total = texts.agg(F.sum(F.size("lines"))).first()[0] or 0
    hit = hot_join(lines, frequent, ["host", "line"], "n_texts", total)
    return hit.groupBy("host", "text_key").agg(F.first("copies").alias("copies"), F.sum("chars").alias("removed_chars"), F.collect_set("line").alias("removed"))


def judge(docs: DataFrame, *, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS, copies_once: bool = False) -> DataFrame:
    """Per row: the base figures, base_failed, removed_chars, depleted and kept, with host, text_key and the removed lines' hashes."""
    since = live_cuts()
    measured = cut(measure_documents(docs, id_col, host_col, text_col))
    out = hot_join(measured.drop("lines"), line_verdicts(measured, id_col, min_docs, copies_once), ["host", "text_key"], "copies", measured.count(), "left")
    tidy(docs.sparkSession, since, measured, out)
    removed = F.coalesce("removed_chars", F.lit(0))
    depleted = 2 * removed > F.col("word_chars")
    return out.drop("copies").withColumn("removed_chars", removed).withColumn("depleted", depleted).withColumn("kept", ~F.col("base_failed") & ~depleted)


def clean(docs: DataFrame, *, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text", length_col: str | None = "n_chars", min_docs: int = MIN_DOCS, copies_once: bool = False) -> DataFrame:
    """The kept documents with all their columns, their text without the frequent lines."""
    since = live_cuts()
    verdicts = judge(docs, id_col=id_col, host_col=host_col, text_col=text_col, min_docs=min_docs, copies_once=copies_once)
    host, key, copies, kept_, removed = free_names(docs, "_host", "_key", "_copies", "_kept", "_removed")
    v = verdicts.groupBy(F.col("host").alias(host), F.col("text_key").alias(key)).agg(F.count("*").alias(copies), F.first("kept").alias(kept_), F.first("removed").alias(removed)).where(kept_)
    keyed = docs.withColumn(host, F.col(host_col).cast("string")).withColumn(key, F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    joined = hot_join(keyed, v, [host, key], copies, docs.count())
    tidy(docs.sparkSession, since, joined)
    kept = joined.drop(host, key, copies, kept_)
    at, length_at = docs.columns.index(text_col), docs.columns.index(length_col) if length_col in docs.columns else None

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches):
            texts, lengths = b.column(at).to_pylist(), b.column(length_at).to_pylist() if length_at is not None else None
            for i, gone in enumerate(b.column(b.num_columns - 1).to_pylist()):
                if gone:
                    gone = set(gone)
                    texts[i] = "\n".join(x for x in texts[i].split("\n") if not x.encode().split() or line_key(x.encode()) not in gone)
                    if lengths is not None:
                        lengths[i] = len(texts[i])
            cols = list(b.columns[:-1])
            cols[at] = pa.array(texts, b.schema.field(at).type)
            if lengths is not None:
                cols[length_at] = pa.array(lengths, b.schema.field(length_at).type)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-1])

    return kept.mapInArrow(strip, docs.schema)


def op8_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "removed_chars", "kept")


OP8_SQL = r"""
with d as (
  select row_number() over () as r, doc_id, source as host, coalesce(text, '') as text from documents),
w as (
  select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from d),
tri as (
  select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as t from (select r, w, unnest(range(1, len(w) - 1)) as i from w where len(w) > 2)),
rep as (
  select r, count(distinct p) as n from (select tri.r, unnest([i, i + 1, i + 2]) as p from tri join (select r, t from tri group by r, t having count(*) > 1) x on tri.r = x.r and tri.t = x.t) group by r),
lines as (
  select r, doc_id, host, text, k, line, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') as norm,
         length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) as chars
  from (select r, doc_id, host, text, unnest(range(1, len(l) + 1)) as k, unnest(l) as line from (select r, doc_id, host, text, string_split(text, chr(10)) as l from d))),
worded as (select * from lines where chars > 0),
dup as (select r, sum(n - 1) as n from (select r, line, count(*) as n from worded group by r, line) group by r),
freq as (select host, norm from worded group by host, norm having count(distinct doc_id) + count(distinct case when doc_id is null then r end) > 20),
gone as (select r, sum(chars) as n from worded join freq on worded.norm = freq.norm and worded.host is not distinct from freq.host group by r),
base as (
  select w.r, w.doc_id, len(w.w) as n_words, length(regexp_replace(w.text, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
         len(regexp_extract_all(w.text, '[#*$%&|<>]')) as n_symbols, coalesce(dup.n, 0) as n_dup_lines, coalesce(rep.n, 0) as n_repeat_words, coalesce(gone.n, 0) as removed_chars
  from w left join dup using (r) left join rep using (r) left join gone using (r))
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
       cast(n_repeat_words as bigint) as n_repeat_words, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, cast(removed_chars as bigint) as removed_chars,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and not (2 * removed_chars > word_chars) as kept
from base
"""
