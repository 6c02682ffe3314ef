import gzip
import io

import pytest
from pyspark.sql import functions as F

from corpusmill.sources import texts, warc

INFO = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Date: 2014-03-18T17:47:38Z\r\nContent-Type: application/warc-fields\r\nContent-Length: 5\r\nX: a\r\n  b\r\nX2: 1\r\nX2: 2\r\n\r\nhello\r\n\r\n"


def read(data):
    return [r for _, r, _ in warc.read_records(io.BytesIO(data))]


def test_record():
    (r,) = read(INFO)
    assert r.content == b"hello" and r.headers["X"] == "a  b" and r.headers["X2"] == "2" and "WARC-Target-URI" not in r.headers


@pytest.mark.parametrize("cut", range(1, len(INFO)))
def test_a_truncated_tail_ends_the_file(cut):
    assert len(read(INFO + INFO[:-cut])) == 1


@pytest.mark.parametrize("bad", [INFO.replace(b"WARC/1.0", b"WARX/1.0"), INFO.replace(b"X2: 1", b"X2 1"), INFO.replace(b"X2: 1", b"X2: " + b"y" * 10_001), INFO.replace(b"Content-Length: 5", b"Content-Length: x"), INFO[:-4] + b"abcd"])
def test_malformed_records_are_errors(bad):
    with pytest.raises(warc.WarcError):
        read(bad)


def test_serialize_sets_the_length_and_refuses_line_ends():
    data = warc.serialize([("WARC-Type", "response"), ("Content-Length", "99"), ("None", None)], b"abc")
    (r,) = read(data)
    assert r.headers == {"WARC-Type": "response", "Content-Length": "3"} and r.content == b"abc"
    with pytest.raises(warc.WarcError):
        warc.serialize([("A", "b\nc")], b"")


def test_data_source(spark, tmp_path):
    warc.register(spark)
    (tmp_path / "a.warc").write_bytes(INFO + INFO.replace(b"warcinfo", b"response"))
    with open(tmp_path / "b.warc.gz", "wb") as f:
        f.write(gzip.compress(INFO) + gzip.compress(INFO))
    df = spark.read.format("warc").load(f"{tmp_path}/*.warc,{tmp_path}/b.warc.gz")
    assert df.count() == 4
    assert df.where("warc_type = 'response'").count() == 1
    assert {r.record_no for r in df.select("record_no").collect()} == {1, 2}
    pushing = spark.read.format("warc").option("pushFilters", "true")
    assert pushing.load(f"{tmp_path}/a.warc").where("warc_type = 'response' and content_length < 9").count() == 1
    assert pushing.load(f"{tmp_path}/a.warc").where("content_length <= 4").count() == 0
    (tmp_path / "c.warc").write_bytes(INFO + b"junk\r\n" + INFO)
    with pytest.raises(Exception):  # noqa: B017
        spark.read.format("warc").load(f"{tmp_path}/c.warc").count()
    rows = spark.read.format("warc").option("mode", "PERMISSIVE").load(f"{tmp_path}/c.warc").collect()
    assert [r.warc_type == "broken" for r in rows] == [False, True]  # the cut is not silent


def test_segments_and_prefixes(spark, tmp_path):
    warc.register(spark)
    rows = [(f"<urn:{i}>", "response", "x" * 500, "en" if i % 2 else "de") for i in range(40)]
    df = spark.createDataFrame(rows, "record_id string, warc_type string, text string, prefix string").coalesce(1)
    out = str(tmp_path / "out")
    df.write.format("warc").mode("append").options(path=out, segmentSize="2000", compression="none").save()
    names = sorted(p.name for p in (tmp_path / "out").iterdir())
    assert len([n for n in names if n.startswith("en.")]) > 2 and all(n.endswith(".warc") for n in names)
    back = spark.read.format("warc").load(out)
    assert {(r.record_id, bytes(r.content).decode()) for r in back.collect()} == {(a, c) for a, _, c, _ in rows}


def test_document_lines(spark):
    docs = [("b", 3, -7, "en"), ("a", 2, 9, None)]
    df = spark.createDataFrame([(docs,)], "d array<struct<doc_id:string,doc_len:int,simhash:bigint,lang:string>>")
    line = df.select(texts.format_documents(F.col("d")).alias("line"))
    assert line.first()["line"] == "[b;3;-7;en,a;2;9;]"
    assert [tuple(x) for x in line.select(texts.parse_documents(F.col("line"))).first()[0]] == docs
    old = spark.createDataFrame([("[a,2,9;b,3,-7]",)], "line string").select(texts.parse_documents(F.col("line"))).first()[0]
    assert [(x.doc_id, x.doc_len, x.simhash, x.lang) for x in old] == [("a", 2, 9, None), ("b", 3, -7, None)]


def test_line_groups_and_lists(spark, tmp_path):
    (tmp_path / "t.txt").write_text("a\nb\nc\n")
    got = sorted((r.first_line, r.value) for r in texts.line_groups(spark, str(tmp_path / "t.txt"), 2).collect())
    assert got == [(1, "a\nb"), (3, "c")]
    (tmp_path / "u.tsv").write_text("x\thttp://a/\ny\thttp://a/\nz\n")
    assert [r.url for r in texts.url_list(spark, str(tmp_path / "u.tsv")).collect()] == ["http://a/"]
    assert texts.whole_texts(spark, str(tmp_path / "t.txt")).first()["value"] == "a\nb\nc\n"
    assert texts.lines(spark, f"{tmp_path}/t.txt, {tmp_path}/u.tsv").count() == 6
