import os

import itertools
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import boilerplate
from corpusmill.functions.language import Identifier, train
from corpusmill.operators import dedup, evaluation
from corpusmill.operators import statistics as stats
from corpusmill.plans import pipeline
from corpusmill.streaming import streams


def doubled(word):
    both = word | word << 32
    return both - (1 << 64) if both >> 63 else both


def bits(a, b):
    return bin((a ^ b) & (1 << 64) - 1).count("1")


@pytest.fixture(scope="module")
def prints(spark):
    rng = random.Random(5)
    words = [rng.getrandbits(32) for _ in range(30)]
    words += [w ^ 1 << rng.randrange(32) for w in words[:15]] + [words[0] ^ 1, words[0] ^ 2, words[0]] + words[:4] + [0, 0, 0]
    rows = [(f"d{i:03d}", rng.randrange(5, 9), doubled(w)) for i, w in enumerate(words)]
    return rows, spark.createDataFrame(rows, "doc_id string, doc_len int, simhash bigint")


def test_pairs_links_and_deletions_equal_brute_force(prints):
    rows, df = prints
    near = [(a, b) for a, b in itertools.combinations(rows, 2) if bits(a[2], b[2]) <= 3]
    want = {tuple(sorted((a[2], b[2]))) for a, b in near if a[2] != b[2]}
    distinct = df.select("simhash").distinct()
    assert {(r.a, r.b) for r in dedup.near_fingerprints(distinct).collect()} == want
    assert sorted((r.a, r.b) for r in dedup.band_candidates(distinct).collect()) == sorted(want)
    links = {d[0]: 0 for d in rows}
    for a, b in near:
        links[a[0]] += 1
        links[b[0]] += 1
    assert {r.doc_id: r.n_near for r in dedup.link_counts(df).collect()} == links
    gone = {min(a, b, key=lambda d: (d[1], d[0]))[0] for a, b in near}
    assert {r.doc_id for r in dedup.ids_to_delete(df).collect()} == gone


def test_components(spark, prints):
    rows, df = prints
    distinct = df.select("simhash").distinct()
    got = {r.simhash: r.component for r in dedup.connected(distinct, dedup.near_fingerprints(distinct)).collect()}
    for a, b in itertools.combinations({d[2] for d in rows}, 2):
        if bits(a, b) <= 3:
            assert got[a] == got[b]
    assert all(got[c] == c for c in set(got.values()))


def test_components_of_any_length(spark):
    """A chain of one bit more each time: the smallest fingerprint, -1, is at its end, a step of 32 away from 0."""
    chain = [doubled((1 << k) - 1) for k in range(33)]
    alone = doubled(0b10101)
    df = spark.createDataFrame([(p,) for p in [*chain, alone]], "simhash bigint")
    got = {r.simhash: r.component for r in dedup.connected(df, dedup.near_fingerprints(df)).collect()}
    assert got == dict.fromkeys(chain, -1) | {alone: alone}


def test_components_of_paths_stars_and_random_edges(spark):
    rng = random.Random(7)
    names = rng.sample(range(-500, 500), 300)
    edges = list(itertools.pairwise(names[:100])) + [(names[100], n) for n in names[101:140]] + [tuple(rng.sample(names[140:], 2)) for _ in range(75)] + [(names[0], names[0])]
    want = {n: n for n in names}
    for _ in names:  # the smaller goes to the larger until nothing does
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
    prints, pairs = spark.createDataFrame([(n,) for n in names], "simhash bigint"), spark.createDataFrame(edges, "a bigint, b bigint")
    rows = [(r.simhash, r.component) for r in dedup.connected(prints, pairs).collect()]
    assert sorted(rows) == sorted(want.items())


def test_near_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id string, doc_len int, simhash bigint")
    assert dedup.ids_to_delete(empty).count() == dedup.link_counts(empty).count() == 0
    nulls = spark.createDataFrame([("a", 1, None), ("b", None, 0), (None, 1, 0)], "doc_id string, doc_len int, simhash bigint")
    assert dedup.ids_to_delete(nulls).count() <= 1


def test_exact(spark):
    df = spark.createDataFrame([("b", "x", 1, 5), ("a", "x", 1, 6), ("c", "y", 1, 7), ("d", None, None, 8)], "record_id string, text string, simhash int, extra int")
    got = dedup.exact_duplicates(df, F.octet_length("text"), F.col("simhash"))
    assert {r.record_id for r in got.collect()} == {"a", "d"}


def test_remove_ids(spark):
    df = spark.createDataFrame([("a", "en"), ("a", "en"), ("b", None), ("c", "en"), ("d", "en")], "record_id string, language string")
    ids = spark.createDataFrame([("d",), ("zz",)], "doc_id string")
    assert [r.record_id for r in dedup.remove_ids(df, ids).collect()] == ["c"]


def test_greedy():
    kept, gone = dedup.greedy_selection([[(3, "a"), (2, "b")], [(2, "b"), (1, "c")]])
    assert "a" in kept and {"b"} <= gone
    assert dedup.greedy_selection([]) == (set(), set())


def test_spearman(spark):
    gold = spark.createDataFrame([("a", 4), ("b", 3), ("c", 2), ("d", 1)], "token string, n bigint")
    same = stats.vocabulary_correlation(gold, gold, 4).first()
    assert same.words == 4 and abs(same.rho - 1) < 1e-12
    other = spark.createDataFrame([("a", 1), ("b", 2)], "token string, n bigint")
    # ranks 1 2 3 4 against 2 1 3.5 3.5
    assert abs(stats.vocabulary_correlation(gold, other, 4).first().rho - 0.7378647873726218) < 1e-9
    with pytest.raises(Exception):  # noqa: B017
        stats.vocabulary_correlation(gold, other, 9).collect()
    assert abs(stats.student_p(0.5, 10) - 0.14111) < 1e-4 and stats.student_p(1.0, 10) == 0.0
    p = stats.vocabulary_correlation(gold, other, 4).first().p
    assert abs(p - stats.student_p(0.7378647873726218, 4)) < 1e-9


def test_spearman_of_all_pairs(spark):
    gold = spark.createDataFrame([("a", 4), ("b", 3), ("c", 2), ("d", 1)], "token string, n bigint")
    other = spark.createDataFrame([("a", 1), ("b", 2)], "token string, n bigint")
    got = {(r.gold, r.other, r.top): r for r in stats.vocabulary_correlations({"x": gold, "y": other}, (2, 4)).collect()}
    assert set(got) == {(a, b, n) for a, b in (("x", "y"), ("y", "x")) for n in (2, 4)}
    assert abs(got["x", "y", 4].rho - 0.7378647873726218) < 1e-9 and got["y", "x", 4].rho is None and got["y", "x", 4].words == 2


def test_counts_of_nothing(spark):
    docs = spark.createDataFrame([(None,), ("",)], "text string")
    assert stats.word_count(docs).count() == stats.vocabulary(docs).count() == stats.match_count(docs, "a").count() == 0
    assert stats.domain_count(spark.createDataFrame([(None,), ("no uri",), ("http://192.0.2.1/",)], "target_uri string")).count() == 0


def test_license_table(spark):
    rows = [("en", "by", 2, 10), ("de", "none", 1, 3)]
    wide = stats.license_table(spark.createDataFrame(rows, "language string, license string, documents bigint, tokens bigint"), ["by", "none"])
    assert wide.columns == ["language", "docs by", "docs none", "tokens by", "tokens none"]
    assert {r["language"]: r["docs by"] for r in wide.collect()} == {"en": 2, "de": 0}


def test_license_scores(spark):
    rows = [("by", "by"), ("none", "none"), ("none", "by"), ("by", "none"), ("by", "by-sa"), ("cc-unspecified", "none"), (None, "by")]
    r = evaluation.license_scores(spark.createDataFrame(rows, "gold string, predicted string")).first()
    assert (r.tp, r.tn, r.fp, r.fn, r.precision) == (1, 1, 1, 1, 0.5)


def test_cleaning_scores(spark):
    rows = [("a", "URL: x\n<h>Head\n<p>one two three", "Head\none two"), ("b", "", "")]
    counts = evaluation.cleaning_counts(spark.createDataFrame(rows, "file string, gold string, text string"))
    got = {(r.file, r.unit): (r.tp, r.fp, r.fn) for r in counts.collect()}
    assert got[("a", "words")] == (3, 0, 1) and got[("a", "segments")] == (1, 1, 1) and got[("b", "words")] == (0, 0, 0)
    assert {r.unit for r in evaluation.cleaning_scores(counts).collect()} == {"words", "segments"}


def test_language(spark):
    rows = [("en", "the old bridge over the river is closed because of the wind"), ("de", "die alte Brücke über den Fluss ist wegen des Windes gesperrt"), ("fr", "le vieux pont sur la rivière est fermé à cause du vent")]
    who = Identifier.of(train(spark.createDataFrame(rows * 3, "lang string, text string")))
    assert who.identify("the wind over the bridge") == "en" and who.identify("wegen des Windes über den Fluss") == "de"
    assert who.identify("") == who.identify(None) == who.identify("12345 !!") == "unknown"


PAGE = "<html><body><p>" + "The long walk along the river went past the mill and the old school, and nobody minded the rain. " * 4 + "</p></body></html>"


def raw(spark, n=3):
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    rows = [(f"r{i}", "http://h/", "s", "2016", "application/http; msgtype=response", 100, bytearray(head + PAGE.encode()), i) for i in range(n)]
    rows.append(("bad", None, "s", None, "application/http; msgtype=request", 5, bytearray(b"x"), 9))
    rows.append(("none", None, None, None, None, None, None, 10))
    return spark.createDataFrame(rows, "record_id string, target_uri string, source_path string, warc_date string, content_type string, content_length int, content binary, record_no bigint")


def test_pipeline(spark):
    first = pipeline.clean(raw(spark))
    assert first.count() == 3
    row = first.first()
    assert row.license == "none" and row.content_length == len(row.text.encode()) and row.content_type == "text/html"
    whole = pipeline.run_all(raw(spark).where("record_id <> 'none'"))
    assert whole.count() == 0  # no language: such records are dropped
    assert pipeline.drop_exact(first).count() == 1
    assert pipeline.strip_warc(raw(spark)).count() == 3


def test_phase_five(spark, tmp_path):
    df = spark.createDataFrame([("a", "by", "en", True, False, "x", None, "o")], "record_id string, license string, language string, no_boilerplate boolean, minimal_html boolean, text string, source_path string, register string")
    fixed = pipeline.repair_fields(df).first()
    assert fixed.source_path == "o" and fixed.register is None
    pipeline.write_parquet(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).first()["language"] == "en"
    assert pipeline.with_prefix(df).first()["prefix"] == "Lic_by_Lang_en_NoBoilerplate_true_MinHtml_false"
    with pytest.raises(Exception):  # noqa: B017
        pipeline.with_prefix(df.withColumn("language", F.lit(None).cast("string"))).collect()
    with pytest.raises(Exception):  # noqa: B017
        pipeline.require(df.withColumn("license", F.lit(None).cast("string")), "license").collect()


def test_stream(spark, tmp_path):
    df = spark.createDataFrame([("a b", "en", "by", 1, "2016-01-01 10:00:00"), ("a b", "en", "by", 1, "2016-01-01 11:00:00")], "text string, language string, license string, simhash bigint, t string").withColumn("ingested_at", F.to_timestamp("t"))
    df.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    job = streams.drop_exact_stream(source).writeStream.format("memory").queryName("kept").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    job.awaitTermination()
    assert spark.table("kept").count() == 1


def test_functions_in_sql(spark):
    from corpusmill import surface
    from corpusmill.functions.simhash import simhash_of

    surface.register(spark)
    page = "<p>" + "The long walk along the river went past the mill and the old school. " * 4 + "</p><a href='x'>Home</a><a href=\"http://creativecommons.org/licenses/by-sa/3.0/\">l</a>"
    spark.createDataFrame([("a", page), ("nil", None)], "id string, html string").createOrReplaceTempView("sql_pages")
    row = {r.id: r for r in spark.sql("SELECT id, boilerplate_text(html) AS t, boilerplate_html(html) AS h, cc_license(html) AS l, simhash64(html) AS s, detect_charset(encode(html, 'utf-8'), null) AS c FROM sql_pages").collect()}
    assert row["a"].l == "by-sa" and row["a"].t.startswith("The long walk") and row["a"].h.startswith("<p>") and row["a"].s == simhash_of(page) and row["a"].c == "utf-8"
    assert row["nil"].l is None and row["nil"].t is None and row["nil"].s is None
    found = spark.sql("SELECT id, p.idx, p.class FROM sql_pages, LATERAL paragraphs(html) p ORDER BY idx").collect()
    assert [(r.id, r.idx) for r in found] == [("a", i) for i in range(len(found))] and found[0]["class"] == "good" and len(found) >= 2
    hosts = spark.sql("SELECT registrable_domain('a.b.co.uk') AS x, registrable_domain('www.A.example') AS y, registrable_domain('localhost') AS z").first()
    assert tuple(hosts) == ("b.co.uk", "a.example", "localhost")


def test_blocks_of_given_pages(spark):
    long = "The long walk along the river went past the mill and the old school, and nobody minded. " * 4
    rows = [("r", 0, "Menu", 4, "ul.li.", False), ("r", 1, "A title", 0, "h1.", True), ("r", 2, long, 0, "p.", False), ("r", 2, long, 0, "p.", False), ("r", 3, "short one", 0, "p.", False), ("r", 4, long, 0, "p.", None), ("nil", 0, None, None, None, None), (None, 0, "x", 0, "p.", False)]
    blocks = spark.createDataFrame(rows, "record_id string, idx int, text string, link_chars int, tag_path string, is_heading boolean")
    got = {(r.record_id, r.idx): (r.cf_class, r["class"]) for r in boilerplate.classify_blocks(blocks).collect()}
    assert got == {("r", 0): ("bad", "bad"), ("r", 1): ("short", "good"), ("r", 2): ("good", "good"), ("r", 3): ("short", "good"), ("r", 4): ("good", "good"), ("nil", 0): ("bad", "bad")}
    text = boilerplate.text_of_blocks(boilerplate.classify_blocks(blocks)).collect()
    assert [(r.record_id, r.text.split("\n")[0], r.text.count("\n")) for r in text] == [("r", "A title", 3)]
    assert boilerplate.classify_blocks(blocks.limit(0)).count() == 0


def test_found_fields_come_back_from_warc(spark, tmp_path):
    from corpusmill.sources import warc

    warc.register(spark)
    columns = "record_id string, target_uri string, source_path string, license string, language string, no_boilerplate boolean, minimal_html boolean, simhash bigint, text string"
    rows = [(f"r{i}", None, "s.gz", "by", "en" if i % 2 else "de", True, False, -5 - i, "grün " * i) for i in range(8)]
    pipeline.write_warc(spark.createDataFrame(rows, columns), str(tmp_path / "w"))
    back = pipeline.corpus_of(spark.read.format("warc").load(str(tmp_path / "w")))
    assert {tuple(r[c] for c in columns.replace(",", "").split()[::2]) for r in back.collect()} == set(rows)
    assert not [f for f in os.listdir(tmp_path / "w") if f.endswith(".part")]
    assert pipeline.drop_near(pipeline.drop_exact(back)).count() > 0  # later phases start from what was written


def test_intermediate_tables_can_be_cleared(spark):
    from corpusmill.plans import shared

    shared._written.pop(spark.sparkContext.applicationId, None)
    before = set(os.listdir(shared.shared_dir(spark)))
    assert shared.materialize(spark.range(3), "three").count() == 3
    made = set(os.listdir(shared.shared_dir(spark))) - before
    assert len(made) == 1 and shared.clear(spark) == 1
    assert not made & set(os.listdir(shared.shared_dir(spark))) and shared.clear(spark) == 0
