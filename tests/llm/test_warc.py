import gzip
import hashlib
import zlib

import duckdb
import pytest

from leadloom.llm import warc as W

from .. import oracle

PAGES = "page_id long, url string, html string, path string"


def through(spark, rows, tmp_path, **own):
    df = spark.createDataFrame([(*r, "clash") for r in rows], PAGES).repartition(3)
    written = W.write_monolithic(df, f"file://{tmp_path}/whole", **own)
    index = W.normalise(written, f"file://{tmp_path}/members")
    return written, index, {(r.page_id, r.record_type): r for r in W.read_archives(index).collect()}


def test_round_trip_and_revisits(spark, tmp_path):
    rows = [(9, "http://a/", "same"), (3, "http://b/", "same"), (5, "http://c\n/", "ünique " * 50_000), (7, None, None), (2, "u", ""), (8, "u", "other")]
    written, index, got = through(spark, rows, tmp_path)
    assert {(k[0], k[1], r.refers_to) for k, r in got.items()} == {("9", "revisit", "3"), ("3", "response", None), ("5", "response", None), ("7", "revisit", "2"), ("2", "response", None), ("8", "response", None)}
    for page, _, html in rows:
        r = next(r for k, r in got.items() if k[0] == str(page))
        raw = (html or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(raw), W.base32_sha1(raw))
    # each archive before is one stream, each record after a member at its offset
    for path in {r.path for r in written.collect()}:
        z = zlib.decompressobj(31)
        z.decompress(open(path.removeprefix("file://"), "rb").read())
        assert z.eof and not z.unused_data
    for r in index.collect():
        member = open(r.path.removeprefix("file://"), "rb").read()[r.offset : r.offset + r.length]
        assert gzip.decompress(member).startswith(b"WARC/1.1\r\n") and f"WARC-Type: {r.record_type}".encode() in gzip.decompress(member)
        assert any(line.split("\t")[0] == str(r.offset) for line in open(r.path.removeprefix("file://") + ".idx"))


def test_small_files_repeated_rows_and_null_ids(spark, tmp_path):
    rows = [(1, "u", "x"), (1, "u", "x"), (None, "u", "x"), (None, "u", "only"), *((i, "u", "y" * i) for i in range(2, 40))]
    written, index, _ = through(spark, rows, tmp_path, file_bytes=2000)
    assert written.select("path").distinct().count() > 3 and index.count() == len(rows)
    kinds = [(r.page_id, r.record_type, r.refers_to) for r in W.read_archives(index).collect()]
    assert sorted((k for k in kinds if k[0] in ("1", None)), key=str) == sorted([("1", "response", None), ("1", "response", None), (None, "revisit", "1"), (None, "response", None)], key=str)
    assert {k[1] for k in kinds if k[0] not in ("1", None)} == {"response"} and len(kinds) == len(rows)


def test_empty_table(spark, tmp_path):
    assert through(spark, [], tmp_path)[2] == {}


def test_streams_of_several_members_and_broken_ones():
    a, b = W.make_record("1", "u", b"one"), W.make_record("2", "u", b"two")
    assert [h["x-page-id"] for h, _ in W.split_records(W.inflate(iter([gzip.compress(a) + gzip.compress(b)])))] == ["1", "2"]
    blob = gzip.compress(a + b)
    assert [r for _, r in W.split_records(W.inflate(iter(blob[i : i + 7] for i in range(0, len(blob), 7))))] == [a, b]
    with pytest.raises(ValueError, match="inside a record"):
        list(W.split_records(iter([a[:-10]])))
    revisit = W.as_revisit(a, "0")
    (head, _), = W.split_records(iter([revisit]))
    assert head["warc-type"] == "revisit" and hashlib.sha1(b"one").digest() and W.read_record(gzip.compress(revisit))[1:] == (3, W.base32_sha1(b"one"), "revisit", "0")


def test_equal_empty_and_null_payloads_against_sql(spark, tmp_path):
    rows = [(i, f"http://h/{i}", ["same", None, "", "ünï", f"own {i}"][i % 5]) for i in range(60, 0, -1)] + [(70, None, "x" * 400_000), (71, "u", "x" * 400_000), (72, "u", "own 4")]
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    got = W.op5_warc_normalise(spark, str(tmp_path))
    oracle.assert_same(got, con, W.OP5_SQL)
    assert got.where("record_type = 'revisit'").count() > 30


def test_one_id_with_several_payloads(spark, tmp_path):
    rows = [(1, "u", "a"), (5, "u", "a"), (5, "u", "b"), (6, "u", "b")]
    written = W.write_monolithic(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), f"file://{tmp_path}/whole")
    got = sorted((r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in W.read_archives(W.normalise(written, f"file://{tmp_path}/members")).collect())
    a, b = W.base32_sha1(b"a"), W.base32_sha1(b"b")
    assert got == sorted([("1", a, "response", None), ("5", a, "revisit", "1"), ("5", b, "response", None), ("6", b, "revisit", "5")])


def test_hot_payloads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("leadloom.llm.common.HOT_SHARE", 4)
    rows = [(i, "u", "hot" if i % 2 else f"own {i % 9}") for i in range(40)]
    _, _, got = through(spark, rows, tmp_path)
    assert sum(k[1] == "response" for k in got) == 1 + len({h for _, _, h in rows if h != "hot"})
    assert {r.refers_to for k, r in got.items() if k[1] == "revisit" and int(k[0]) % 2} == {"1"}


def test_text_ids(spark, tmp_path):
    """Ids with blanks, line ends, forged fields and other scripts come back as they are; the smallest by code point is the response."""
    rows = [(" a", "u", "same"), ("b ", "u", "same"), ("a", "u", "same"), ("x\r\nX-Page-ID: y\r\nWARC-Type: evil", "u", "same"), (None, "u", "same"), ("", "u", "own"), ("None", "u", None), (None, "u", ""), ("漢 %20", "u", "own"), ("\r\n", "u", "lone")]
    spark.createDataFrame(rows, "page_id string, url string, html string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    got = W.op5_warc_normalise(spark, str(tmp_path))
    oracle.assert_same(got, con, W.OP5_SQL)
    assert {(r.page_id, r.refers_to) for r in got.collect() if r.record_type == "response"} == {(" a", None), ("", None), ("None", None), ("\r\n", None)}


def test_whole_archives_are_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "fresh_path", lambda spark, label: f"file://{tmp_path}/{label}")
    spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert W.op5_warc_normalise(spark, str(tmp_path)).count() == 1
    assert not (tmp_path / "warc" / "whole").exists() and (tmp_path / "warc" / "members").exists()
