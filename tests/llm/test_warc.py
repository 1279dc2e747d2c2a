import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from tidemark.llm import archives, warc
from tidemark.llm.queries import QUERIES


def sha1(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(rows):
    best = {}
    for key, _, html in rows:
        data = (html or "").encode()
        best[data] = max(best.get(data, -1), -1 if key is None else key)
    out = []
    for key, _, html in rows:
        data = (html or "").encode()
        mine = (-1 if key is None else key) == best[data]
        out.append((key, len(data), sha1(data), "response" if mine else "revisit", None if mine else best[data]))
    return sorted(out, key=str)


ROWS = [(1, "http://a/", "<p>é🙂</p>"), (2, "http://b/\r\nX: y", "<p>é🙂</p>"), (3, None, None), (4, "http://c/", ""), (5, "u", "x\r\n\r\ny" * 5000),
        (6, "u", "WARC/1.1\r\n\r\n"), (7, "u", "long " * 400_000), (None, "u", "<p>é🙂</p>"), (8, "u", "same"), (8, "v", "same"), (9, "w", "other")]


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, "page_id bigint, url string, html string").withColumn("payload", F.lit(1)).withColumn("sha1", F.lit("x")).repartition(3)
    archives.write_pages(pages, str(tmp_path / "w"))
    assert sorted((tuple(r) for r in archives.read_pages(spark, str(tmp_path / "w")).collect()), key=str) == expected(ROWS)
    files = sorted((tmp_path / "w").glob("*.warc.gz"))
    assert gzip.open(files[0]).read().startswith(b"WARC/1.1\r\n")


def test_predicates_reach_the_source_and_payloads_are_skipped(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, "page_id bigint, url string, html string")
    for compression in ("gzip", "none"):
        path = str(tmp_path / compression)
        warc.register(spark)
        archives.page_records(pages).coalesce(1).write.format("warc").option("compression", compression).option("fileBytes", 2000).mode("append").save(path)
        read = spark.read.format("warc").option("payload", "false").load(path).where("record_type = 'revisit' AND target_uri IN ('http://a/', 'u')")
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "Filter (" not in plan and "Filter isnotnull" not in plan
        assert all(r.payload is None and r.record_type == "revisit" for r in read.collect()) and read.count() == 2
        one = spark.read.format("warc").option("header.WARC-Record-ID", "<urn:page:7>").load(path).collect()
        assert len(one) == 1 and one[0].payload.decode() == ROWS[6][2] and one[0].headers["warc-type"] == "response"
        everything = spark.read.format("warc").option("bundleBytes", 1000).load(path)
        assert everything.count() == len(ROWS) and everything.rdd.getNumPartitions() > 1


def test_skipping_does_not_read_on():
    data = warc.member(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5000000\r\n\r\n" + bytes(range(256)) * 19531 + bytes(64) + b"\r\n\r\n", level=0)
    second = warc.member(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nok\r\n\r\n")

    class Counted(io.BytesIO):
        total = 0

        def readinto(self, b):
            n = super().readinto(b)
            Counted.total += n
            return n

    source = io.BufferedReader(Counted(data + second), 4096)
    found = list(warc.records(source, True, lambda h: h["warc-type"] == "warcinfo", True))
    assert [(h["warc-type"], body) for _, h, _, body in found] == [("warcinfo", b"ok")] and Counted.total < 200_000
    plain = gzip.compress(b"WARC/1.1\r\nWARC-Type: a\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\n") * 2  # members without skip lengths
    assert [b for *_, b in warc.records(io.BufferedReader(io.BytesIO(plain)), True, lambda h: True, True)] == [b"xyz"] * 2


def test_uncommitted_files_are_not_read_and_damage_is_noticed(spark, tmp_path):
    pages = spark.createDataFrame(ROWS[:2], "page_id bigint, url string, html string")
    path = tmp_path / "w"
    archives.write_pages(pages, str(path))
    (path / "part-99999-lost.warc.gz").write_bytes(b"half a file")
    assert archives.read_pages(spark, str(path)).count() == 2
    archives.write_pages(pages, str(path))
    assert archives.read_pages(spark, str(path)).count() == 4
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "a.warc").write_bytes(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:X\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\n")
    with pytest.raises(Exception, match="digest"):
        spark.read.format("warc").option("verify", "true").load(str(bad)).collect()


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    archives.write_pages(pages, str(tmp_path / "w"))
    assert archives.read_pages(spark, str(tmp_path / "w")).count() == 0


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted((tuple(r) for r in QUERIES["op6_warc_round_trip"](spark, sf).collect()), key=str) == expected(rows)


def test_schemes_of_folders(monkeypatch):
    asked = []
    monkeypatch.setattr(warc.fs, "FileSystem", type("Files", (), {"from_uri": staticmethod(lambda uri: asked.append(uri))}))
    for uri in ("s3a://crawl/a", "s3n://crawl/a", "s3://crawl/a", "hdfs://name/a", "file:/tmp/a"):
        warc.open_folder(uri)
    assert asked == ["s3://crawl/a"] * 3 + ["hdfs://name/a", "file:///tmp/a"]
