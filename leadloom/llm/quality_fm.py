"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

    z(x) = b + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

The sum-of-squares identity scores all pairwise interactions in time linear in
the features. Features are hashed lower-cased words (log counts, unit length),
structure statistics of the text in bins (share of symbols, capitals, digits,
repeated lines and word triples, word and line lengths ...) and the length given
as metadata. The label, language, source and id are never inputs.

The model is fitted on at most ``sample_rows`` labelled rows with at most
``sample_features`` features, those with the smallest hash of their id; it has a
fixed size and is broadcast. Scoring runs
over every whole text.

Defined cases: a null text counts as an empty one and gets a score like any
other; a null id is not held out and never learned from; several labels of one
id: the lowest counts; without labelled rows every score is 0.5. Every row gives one row, repeated
rows included, an empty table none; other columns play no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, free_names, live_cuts, pieces_of, table, tidy
from .line_rules import repeat_words

#: Bound on the labelled rows that a model is fitted on.
SAMPLE_ROWS = 8000
#: Bound on their features together: 8 bytes each on the driver.
SAMPLE_FEATURES = 16_000_000
HASH_BITS = 15
FACTORS = 8
CUT = 0.7

_EDGES = np.array([1e-9, 0.002, 0.005, 0.01, 0.02, 0.04, 0.07, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.75, 0.9])
_SHARES, _SIZES = 11, 4
N_STRUCTURE = (_SHARES + _SIZES) * 32
_PLAIN = bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + b" \t\n\v\f\r.,"
_MARKS = bytes(c for c in range(33, 127) if c not in _PLAIN)
_UPPER, _DIGIT = bytes(range(65, 91)), bytes(range(48, 58))


def _count(raw: bytes, chars: bytes) -> int:
    return len(raw) - len(raw.translate(None, chars))


def features(raw: bytes | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of one text's features; never empty."""
    raw = raw or b""
    ws, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, size = max(1, len(ws)), max(1, len(raw))
    counts = Counter(raw.lower().split())
    same = sum(a == b for a, b in zip(ws, ws[1:], strict=False))
    marked = sum(w[-1:] in b"#$%&*!|" for w in ws)
    shares = (
        _count(raw, _MARKS) / size, _count(raw, b"|") / size, _count(raw, b"!") / size, _count(raw, _UPPER) / size, _count(raw, _DIGIT) / size, _count(raw, b".") / n,
        1 - len(set(lines)) / max(1, len(lines)), repeat_words(ws) / n, same / n, 1 - len(counts) / n, marked / n,
    )
    sizes = (len(ws), len(raw) / n, len(ws) / max(1, len(lines)), n_chars or 0)
    bins = [*np.searchsorted(_EDGES, shares, "right"), *np.minimum(31, 2 * np.log2(np.maximum(1, sizes))).astype(int)]
    structure = (1 << HASH_BITS) + np.arange(_SHARES + _SIZES) * 32 + np.array(bins)
    words = np.fromiter((crc32(w) & ((1 << HASH_BITS) - 1) for w in counts), np.int64, len(counts))
    weight = 1 + np.log(np.fromiter(counts.values(), np.float64, len(counts)))
    weight /= np.sqrt((weight**2).sum()) or 1
    return np.concatenate((structure, words)).astype(np.int32), np.concatenate((np.ones(len(structure)), weight)).astype(np.float32)


def stack(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices, values and the start of each row."""
    starts = np.concatenate(([0], np.cumsum([len(i) for i, _ in rows])[:-1])).astype(np.int64)
    return np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]), starts


class FactorisationMachine:
    def __init__(self, factors: int = FACTORS, seed: int = 7):
        size = (1 << HASH_BITS) + N_STRUCTURE
        self.bias, self.w = 0.0, np.zeros(size, np.float32)
        self.v = np.random.default_rng(seed).normal(0, 0.05, (size, factors)).astype(np.float32)
        self.fitted = False

    def _forward(self, idx, val, starts):
        vx = self.v[idx] * val[:, None]
        total = np.add.reduceat(vx, starts)
        pairs = 0.5 * (total**2 - np.add.reduceat(vx**2, starts)).sum(axis=1)
        return self.bias + np.add.reduceat(self.w[idx] * val, starts) + pairs, vx, total

    def logit(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        if not rows or not self.fitted:
            return np.zeros(len(rows))
        return self._forward(*stack(rows))[0].astype(np.float64)

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12, batch: int = 256, rate: float = 0.08, decay: float = 1e-4, seed: int = 7) -> FactorisationMachine:
        """Logistic loss, Adagrad steps on the features of each batch."""
        if not len(rows):
            return self
        self.fitted = True
        gw, gv, gb = np.full(len(self.w), 1e-3, np.float32), np.full(len(self.w), 1e-3, np.float32), 1e-3
        draw = np.random.default_rng(seed)
        for _ in range(epochs):
            order = draw.permutation(len(rows))
            for k in range(0, len(rows), batch):
                part = order[k : k + batch]
                idx, val, starts = stack([rows[i] for i in part])
                z, vx, total = self._forward(idx, val, starts)
                err = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[part]) / len(part)).astype(np.float32)
                of = np.repeat(np.arange(len(part)), np.diff(np.append(starts, len(idx))))
                step_w = err[of] * val
                step_v = step_w[:, None] * (total[of] - vx)
                by = np.argsort(idx, kind="stable")
                at = np.flatnonzero(np.diff(idx[by], prepend=-1))
                own = idx[by][at]
                dw = np.add.reduceat(step_w[by], at) + decay * self.w[own]
                dv = np.add.reduceat(step_v[by], at) + decay * self.v[own]
                gw[own] += dw**2
                gv[own] += (dv**2).mean(axis=1)
                self.w[own] -= rate * dw / np.sqrt(gw[own])
                self.v[own] -= (rate * dv / np.sqrt(gv[own])[:, None]).astype(np.float32)
                gb += float(err.sum()) ** 2
                self.bias -= rate * float(err.sum()) / gb**0.5
        return self


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces_of(batches):
        rows = [features(t, n) for t, n in zip(b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), pa.array([i for i, _ in rows], pa.list_(pa.int32())), pa.array([v for _, v in rows], pa.list_(pa.float32()))], names=["key", "label", "idx", "val"])


def train(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS, sample_features: int = SAMPLE_FEATURES
) -> FactorisationMachine:
    """A model fitted on a bounded sample of the labelled rows that are not held out.

    The sample is that of the ids with the smallest hashes: at most sample_rows of
    them, and in that order no more than have sample_features features together, so
    that it fits the driver whatever the texts' lengths. Of several rows with one id
    the one whose text has the smallest digest counts.
    """
    since = live_cuts()
    key, label = free_names(docs, "_key", "_label")
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    sample = usable.groupBy(F.col(id_col).alias(key)).agg(F.min(label_col).cast("int").alias(label)).orderBy(F.xxhash64(key), key).limit(sample_rows)
    found = docs.join(F.broadcast(sample), docs[id_col] == sample[key]).select(F.col(key).alias("id"), F.col(text_col).alias("text"), F.col(length_col).cast("long").alias("n_chars"), F.col(label).alias("label"))
    one = found.groupBy("id", "label").agg(F.min_by(F.struct("text", "n_chars"), F.struct(F.md5("text"), "n_chars")).alias("t"))
    rows = cut(one.select(F.xxhash64("id").alias("key"), F.col("t.text").alias("text"), F.col("t.n_chars").alias("n_chars"), "label").mapInArrow(_featurise, "key long, label int, idx array<int>, val array<float>"))
    room, last = sample_features, None
    for r in rows.select("key", F.size("idx").alias("n")).orderBy("key").collect():  # sample_rows at most
        room -= r["n"]
        if room < 0:
            break
        last = r["key"]
    got = rows.where(F.col("key") <= F.lit(last).cast("long")).orderBy("key").toArrow()
    tidy(docs.sparkSession, since)
    return FactorisationMachine().fit([(i.values.to_numpy(), v.values.to_numpy()) for i, v in zip(got["idx"], got["val"], strict=True)], np.array(got["label"].to_pylist(), np.float32))


def _probability(model: FactorisationMachine, texts: pa.Array, lengths: pa.Array) -> np.ndarray:
    rows = [features(t, n) for t, n in zip(texts.cast(pa.binary()).to_pylist(), lengths.to_pylist(), strict=True)]
    return 1 / (1 + np.exp(-np.clip(model.logit(rows), -60, 60)))


def score(docs: DataFrame, model: FactorisationMachine, *, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", cut: float = CUT) -> DataFrame:
    """Per row: id, held_out, score and predicted (1 where the score reaches ``cut``)."""
    src = docs.select(F.col(id_col), F.col(text_col), F.col(length_col).cast("long").alias("n_chars"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_probability(shared.value, b.column(1), b.column(2)))], names=[id_col, "score"])

    out = src.mapInArrow(run, f"`{id_col}` {src.schema[0].dataType.simpleString()}, score double")
    return out.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: FactorisationMachine, *, text_col: str = "text", length_col: str = "n_chars", cut: float = CUT) -> DataFrame:
    """The documents whose score reaches ``cut``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at, length_at = docs.columns.index(text_col), docs.columns.index(length_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches):
            yield b.filter(pa.array(_probability(shared.value, b.column(at), b.column(length_at).cast(pa.int64())) >= cut))

    return docs.mapInArrow(run, docs.schema)


def op4_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
