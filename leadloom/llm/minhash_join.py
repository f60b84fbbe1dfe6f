"""Similarity self-join on word n-grams: MinHash banding, verified on the full n-gram sets.

1. Every text gives its set of ``width``-word shingles (a shorter text, but not
   one without words, is one shingle) and a MinHash signature in bands. The
   number of bands and rows follows from the similarity and the recall wanted.
2. Equal texts are one class from here on. Classes meet by shuffling on band
   hashes; each bucket links its members to its smallest one, which is linear in
   the bucket, and components of these links hold all candidate pairs.
3. Texts of one component come together, a large component in pairs of bounded
   blocks. There every pair is verified on the full sets inside the task, which
   emits per text the number of its verified links and the smallest text it
   hangs together with: rows linear in the texts, never a row per pair.

Defined cases: a null text is a class of its own per row, without links. Texts
without words have no shingles; equal ones are one class, without links. Repeated
rows are copies. Ties don't arise: classes are named by their smallest id. No
candidate is dropped and no bucket is capped. An empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, free_names, hot_join, live_cuts, pieces_of, table, tidy, words
from .graph import components

WIDTH = 5
SIMILARITY = 0.8
RECALL = 0.9995
MAX_HASHES = 128
#: Texts and bytes of text in a block of a large component.
BLOCK_TEXTS, BLOCK_BYTES = 512, 8_000_000


def bands_for(similarity: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the longest rows with which a pair at the similarity meets with the recall wanted."""
    for rows in range(max_hashes, 0, -1):
        p = similarity**rows
        bands = 1 if p >= 1 else int(np.ceil(np.log1p(-recall) / np.log1p(-p)))
        if bands * rows <= max_hashes:
            return bands, rows
    raise ValueError("no banding within max_hashes reaches the recall")


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(raw: bytes, hashes: WordHashes, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's shingles."""
    ws = words(raw)
    if not ws:
        return np.zeros(0, np.uint64)
    h = np.fromiter((hashes[w] for w in ws), np.uint64, len(ws))
    k = min(width, len(h))
    n = len(h) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(out)


class Signer:
    def __init__(self, bands: int, rows: int, seed: int = 11):
        draw = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = draw.integers(1, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = draw.integers(0, 2**63, bands * rows, dtype=np.uint64)
        self.c = draw.integers(1, 2**63, (bands, rows), dtype=np.uint64) | np.uint64(1)

    def keys(self, sh: np.ndarray) -> list[int]:
        """One 64-bit key per band; none without shingles."""
        if not len(sh):
            return []
        least = np.full(len(self.a), np.iinfo(np.uint64).max)
        for at in range(0, len(sh), 1024):
            least = np.minimum(least, (sh[at : at + 1024, None] * self.a + self.b).min(axis=0))
        return _mix((_mix(least).reshape(self.bands, self.rows) * self.c).sum(axis=1, dtype=np.uint64)).view(np.int64).tolist()


def text_key(col: str) -> F.Column:
    return F.unhex(F.md5(F.col(col)))


def sign(docs: DataFrame, id_col: str, text_col: str, width: int, bands: int, rows: int) -> DataFrame:
    """Per row: id, a digest of the text, its size in bytes and its band keys."""
    src = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("key"), F.octet_length(F.col(text_col)).cast("long").alias("bytes"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, signer = WordHashes(), Signer(bands, rows)
        for b in pieces_of(batches):
            keys = [signer.keys(shingles(raw or b"", hashes, width)) for raw in b.column(3).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(keys, pa.list_(pa.int64()))], names=["id", "key", "bytes", "bands"])

    return src.mapInArrow(run, f"id {src.schema[0].dataType.simpleString()}, key binary, bytes long, bands array<long>")


def candidate_edges(texts: DataFrame) -> DataFrame:
    """(u, v): each text and the smallest of every bucket that it shares with another."""
    total = texts.agg(F.sum(F.size("bands"))).first()[0] or 0
    buckets = texts.select(F.explode("bands").alias("bucket"), "key")
    least = buckets.groupBy("bucket").agg(F.min("key").alias("v"), F.count("*").alias("n")).where("n > 1")
    return hot_join(buckets, least, ["bucket"], "n", total).where("key != v").select(F.col("key").alias("u"), "v").distinct()


def in_common(sets: list[np.ndarray], chunk: int = 4096) -> np.ndarray:
    """How many elements each two of the sets (sorted, distinct) have in common; the diagonal has no meaning."""
    if len(sets) == 2:
        return len(np.intersect1d(sets[0], sets[1], assume_unique=True)) * (1.0 - np.eye(2))
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, col, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1  # an element of one set alone adds to no intersection
    rank = np.cumsum(shared) - 1
    keep = shared[col]
    owner, col = owner[keep], rank[col[keep]]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    both = np.zeros((len(sets), len(sets)))
    for at in range(0, int(shared.sum()), chunk):
        a, b = np.searchsorted(col, [at, at + chunk])
        m = np.zeros((len(sets), chunk), np.float32)
        m[owner[a:b], col[a:b] - at] = 1
        both += m @ m.T
    return both


def linked(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which pairs of shingle sets reach the Jaccard similarity, as a symmetric matrix with an empty diagonal."""
    size, both = np.array([len(s) for s in sets], np.float64), in_common(sets)
    out = both >= similarity * (size[:, None] + size[None, :] - both) - 1e-9
    np.fill_diagonal(out, False)
    return out


def roots(adjacent: np.ndarray) -> np.ndarray:
    """The smallest index that each index hangs together with."""
    root = np.full(len(adjacent), -1)
    for i in range(len(adjacent)):
        if root[i] < 0:
            front = np.zeros(len(adjacent), bool)
            front[i] = True
            while front.any():
                root[front] = i
                front = adjacent[front].any(axis=0) & (root < 0)
    return root


def _verify_group(rows: dict[bytes, tuple[int, list[int], bytes]], within: bool, bucket: int | None, width: int, similarity: float, hashes: WordHashes):
    """Links among the texts of two blocks that share a bucket; in a bucket's own group, those that share no earlier one."""
    keys = sorted(rows)
    adjacent = linked([shingles(rows[k][2], hashes, width) for k in keys], similarity)
    if not within:
        block = np.array([rows[k][0] for k in keys])
        adjacent &= block[:, None] != block[None, :]
    if adjacent.any():
        buckets = [np.unique(np.array(rows[k][1], np.int64)) for k in keys]
        adjacent &= in_common(buckets) > 0 if bucket is None else in_common([x[x < bucket] for x in buckets]) == 0
    root = roots(adjacent)
    return keys, adjacent.sum(axis=1), [keys[r] for r in root]


def _blocks(n: F.Column, size: F.Column) -> F.Column:
    return F.greatest(F.ceil(n / BLOCK_TEXTS), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("int")


def _by_bucket(named: DataFrame, large: DataFrame, total: int) -> DataFrame | None:
    """Where buckets are the cheaper way, the members of large components as (part, n_parts, key, first_id, bytes, bucket, buckets); else none.

    Buckets with the same members count once. A component is left whole if its
    buckets hold as many pairs as it has itself.
    """
    members = cut(hot_join(named, large.select("part", "n"), ["part"], "n", total).withColumnRenamed("n", "n_part"))
    buckets = members.select("part", "n_part", "key", F.explode(F.array_distinct("bands")).alias("bucket"))
    one, two = F.xxhash64("key").cast("decimal(38,0)"), F.xxhash64("key", F.lit(1)).cast("decimal(38,0)")
    held = buckets.groupBy("part", "n_part", "bucket").agg(F.count("*").alias("n"), F.sum(one).alias("h1"), F.sum(two).alias("h2")).where("n > 1")
    kept = cut(held.groupBy("part", "n_part", "n", "h1", "h2").agg(F.min("bucket").alias("bucket")))
    cheap = kept.groupBy("part").agg(F.sum(F.expr("n * (n - 1)")).alias("pairs"), F.first("n_part").alias("size"), F.count("*").alias("rows")).where("pairs < size * (size - 1)").select("part", "rows")
    chosen = hot_join(kept, cheap, ["part"], "rows", kept.count())
    rows = members.select("part", "n_part", "key", "first_id", "bytes", F.explode(F.array_distinct("bands")).alias("bucket"))
    own = cut(hot_join(rows, chosen.select("bucket", "n"), ["bucket"], "n", buckets.count()))
    if own.isEmpty():
        return None
    return own.join(own.groupBy(F.col("key").alias("_key")).agg(F.collect_list("bucket").alias("buckets")), F.col("key") == F.col("_key")).drop("_key")


def verified_links(docs: DataFrame, texts: DataFrame, members: DataFrame, id_col: str, text_col: str, width: int, similarity: float) -> DataFrame:
    """(key, links, root, whole) of candidate texts, one row per group and block pair that a text is in.

    members: (node, root) of the candidate components. A component of one block is
    a group; a larger one is cut into its buckets if these hold fewer pairs than it
    has, else into blocks. links counts verified links inside the group, root is
    the smallest text reached there, whole says that the group is a whole component.
    """
    columns = ["key", "first_id", "bytes", "bucket", "buckets"]
    named = cut(members.join(texts.select("key", "bytes", "first_id", "bands"), members["node"] == texts["key"]).select("key", F.col("root").alias("part"), "bytes", "first_id", "bands"))
    total = named.count()
    sizes = cut(named.groupBy("part").agg(F.count("*").alias("n"), F.sum("bytes").alias("size")).withColumn("blocks", _blocks(F.col("n"), F.col("size"))))
    large = sizes.where("blocks > 1")
    own = None if large.isEmpty() else _by_bucket(named, large, total)
    whole = named.select("part", "key", "first_id", "bytes", F.lit(None).cast("long").alias("bucket"), F.col("bands").alias("buckets"))
    if own is not None:
        split = own.groupBy("part").agg(F.first("n_part").alias("n_part"))
        whole = hot_join(whole, split, ["part"], "n_part", total, "left").where("n_part is null").drop("n_part")
    placed = hot_join(whole, sizes.select("part", "n", "blocks"), ["part"], "n", total).select(*columns, "part", "blocks", (F.col("blocks") == 1).alias("whole"))
    if own is not None:
        own = own.select(*columns, F.unhex(F.lpad(F.hex("bucket"), 16, "0")).alias("part"))
        sized = own.groupBy("part").agg(F.count("*").alias("n"), F.sum("bytes").alias("size"))
        placed = placed.unionByName(hot_join(own, sized, ["part"], "n", own.count()).select(*columns, "part", _blocks(F.col("n"), F.col("size")).alias("blocks"), F.lit(False).alias("whole")))
    placed = placed.withColumn("block", F.expr("cast(pmod(xxhash64(key), blocks) as int)"))
    source = docs.select(F.col(id_col).alias("_id"), text_key(text_col).alias("_key"), F.col(text_col).alias("text"))
    # one row of each text: by id and text, so that many copies of a text don't meet in one task
    found = source.join(cut(placed), (F.col("key") == F.col("_key")) & F.col("first_id").eqNullSafe(F.col("_id")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = found.select("part", "block", "whole", "bucket", "buckets", other.alias("other"), "key", "text")
    spread = spread.select("part", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "whole", "bucket", "buckets", "key", "text")
    grouped = spread.repartition("part", "i", "j").sortWithinPartitions("part", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, at, rows = WordHashes(), None, {}

        def done():
            keys, links, root = _verify_group(rows, at[1] == at[2], at[4], width, similarity, hashes)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(links, pa.int64()), pa.array(root, pa.binary()), pa.array([at[3]] * len(keys), pa.bool_())], names=["key", "links", "root", "whole"])

        for b in pieces_of(batches):
            cols = [b.column(k).to_pylist() for k in range(8)]
            for part, i, j, block, whole_, bucket, buckets, key, raw in zip(*cols, b.column(8).cast(pa.binary()).to_pylist(), strict=True):
                if (part, i, j, whole_, bucket) != at:
                    if rows:
                        yield done()
                    at, rows = (part, i, j, whole_, bucket), {}
                rows[key] = (block, buckets, raw)
        if rows:
            yield done()

    return grouped.mapInArrow(run, "key binary, links long, root binary, whole boolean")


def similarity_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """Per row: id, key (digest of the text), copy_id, n_links and class_id.

    copy_id: the smallest id of the equal texts. n_links: the number of different
    texts whose Jaccard similarity with this one reaches the threshold. class_id:
    the smallest id of all texts that hang together by such links.
    """
    since = live_cuts()
    bands, rows = bands_for(similarity, recall)
    signed = cut(sign(docs, id_col, text_col, width, bands, rows))
    texts = cut(signed.where("key is not null").groupBy("key").agg(F.count("*").alias("copies"), F.min("id").alias("first_id"), F.first("bytes").alias("bytes"), F.first("bands").alias("bands")))
    members = cut(components(candidate_edges(texts)))
    checked = cut(verified_links(docs, texts, members, id_col, text_col, width, similarity))
    whole = checked.where("whole").select("key", "root")
    split = components(checked.where("not whole").select(F.col("key").alias("u"), F.col("root").alias("v"))).select(F.col("node").alias("key"), "root")
    links = checked.groupBy("key").agg(F.sum("links").alias("n_links"))
    rooted = links.join(whole.unionByName(split), "key", "left").select("key", "n_links", F.coalesce("root", "key").alias("root"))
    known = cut(rooted.join(texts.select("key", "first_id"), "key"))
    classes = known.groupBy("root").agg(F.min("first_id").alias("class_id"), F.count("*").alias("n"))
    linked_ = hot_join(known, classes, ["root"], "n", members.count()).select("key", "n_links", "class_id")
    per_text = texts.select("key", "first_id", "copies").join(linked_, "key", "left").select("key", "copies", F.col("first_id").alias("copy_id"), F.coalesce("n_links", F.lit(0)).alias("links"), F.coalesce("class_id", "first_id").alias("class"))
    out = hot_join(signed.select("id", "key"), per_text, ["key"], "copies", signed.count(), "left")
    tidy(docs.sparkSession, since, signed, out)
    alone = F.col("key").isNull()
    return out.select(F.col("id").alias(id_col), "key", F.when(alone, F.col("id")).otherwise(F.col("copy_id")).alias("copy_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.when(alone, F.col("id")).otherwise(F.col("class")).alias("class_id"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One document of each class, that with the smallest id, with all its columns; every row with a null text stays."""
    since = live_cuts()
    classes = similarity_classes(docs, id_col=id_col, text_col=text_col, width=width, similarity=similarity, recall=recall)
    id_, key, n = free_names(docs, "_id", "_key", "_n")
    first = cut(classes.where(F.col(id_col).eqNullSafe(F.col("class_id"))).groupBy(F.col(id_col).alias(id_), F.col("key").alias(key)).agg(F.count("*").alias(n)))
    tidy(docs.sparkSession, since, first)
    kept = docs.join(first, docs[id_col].eqNullSafe(first[id_]) & text_key(text_col).eqNullSafe(first[key]), "left_semi")
    if first.where(F.col(n) > 1).where(F.col(key).isNotNull()).isEmpty():
        return kept
    # rows repeated with their id; null texts have no copies
    return kept.where(F.col(text_col).isNull()).unionByName(kept.where(F.col(text_col).isNotNull()).dropDuplicates([id_col, text_col]))


def op7_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(table(spark, sf_dir, "documents")).drop("key")
