import os

import pytest

import __spark_entry__ as entry
from corpusmill import cli
from corpusmill.queries import QUERIES, SQL

TINY = "/root/testdata/sf0.001"


def test_contract():
    assert set(SQL) <= set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(TINY), reason="needs the test tables")
def test_entry(spark):
    assert entry.entry(spark).columns == ["lang", "n"]


@pytest.mark.skipif(not os.path.isdir(TINY), reason="needs the test tables")
@pytest.mark.parametrize("name", ["languages_without_copies", "near_links", "word_count", "http_fields", "license_table", "paragraph_classes", "paragraph_texts", "tag_licenses", "domain_count", "functions_in_sql", "warc_corpus_round_trip"])
def test_sql_gives_the_same(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(TINY):
        con.execute(f"create view {f[:-8]} as select * from '{TINY}/{f}'")
    found = QUERIES[name](spark, TINY)
    columns = sorted(found.columns)
    got = sorted(str([r[c] for c in columns]) for r in found.collect())
    want = con.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    assert got == sorted(str([dict(zip(names, r))[c] for c in columns]) for r in want.fetchall())


def test_html_command(tmp_path):
    text = "The long walk along the river went past the mill and the old school, and nobody minded the rain. " * 3
    (tmp_path / "a.html").write_text(f"<p>{text}</p>")
    cli.main(["html", str(tmp_path / "a.html"), str(tmp_path / "a.txt")])
    assert (tmp_path / "a.txt").read_text() == text.strip()
