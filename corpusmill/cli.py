"""Command line: ``python -m corpusmill.cli COMMAND ...`` for local files and whole runs."""

from __future__ import annotations

import argparse
from pathlib import Path

from corpusmill.functions import boilerplate


def html(source: str, target: str, minimal: bool) -> None:
    """One HTML file to text, UTF-8 both."""
    Path(target).write_text(boilerplate.clean(Path(source).read_text("utf-8"), minimal) or "", "utf-8")


def records(source: str, target: str, minimal: bool) -> None:
    """WARC files to WARC files with the contents of responses cleaned and lengths set anew."""
    from pyspark.sql import functions as F

    from corpusmill.plans import pipeline
    from corpusmill.plans.shared import session, ship
    from corpusmill.sources import warc

    spark = session("strip")
    ship(spark)
    warc.register(spark)
    raw = spark.read.format("warc").load(source)
    texts = pipeline.strip_warc(raw, minimal).select("record_id", "record_no", F.encode("text", "utf-8").alias("content"))
    out = raw.drop("content").join(texts, ["record_id", "record_no"])
    out.drop("source_path").write.format("warc").mode("append").options(path=target).save()


def corpus(source: str, target: str, samples: str | None, minimal: bool) -> None:
    """All phases: WARC files to a clean corpus as Parquet by licence and language."""
    from corpusmill.functions.language import Identifier, train
    from corpusmill.plans import pipeline
    from corpusmill.plans.shared import session, ship
    from corpusmill.sources import warc

    spark = session("corpus")
    ship(spark)
    warc.register(spark)
    languages = Identifier.of(train(spark.read.parquet(samples))) if samples else None
    options = pipeline.Options(minimal_html=minimal)
    unreadable = spark.sparkContext.accumulator(0)
    raw = spark.read.format("warc").option("mode", "PERMISSIVE").load(source)
    broken = raw.where("warc_type = 'broken'").count()
    pipeline.write_parquet(pipeline.run_all(raw.where("warc_type <> 'broken' or warc_type is null"), languages, options, unreadable), target, options)
    print(f"files cut at a malformed record: {broken}; pages that could not be read: {unreadable.value}")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="corpusmill")
    sub = p.add_subparsers(dest="command", required=True)
    for name, text in (("html", html.__doc__), ("records", records.__doc__), ("corpus", corpus.__doc__)):
        c = sub.add_parser(name, help=text)
        c.add_argument("source")
        c.add_argument("target")
        c.add_argument("--minimal-html", action="store_true")
        if name == "corpus":
            c.add_argument("--samples", help="Parquet table of labelled texts (lang, text)")
    a = p.parse_args(argv)
    if a.command == "html":
        html(a.source, a.target, a.minimal_html)
    elif a.command == "records":
        records(a.source, a.target, a.minimal_html)
    else:
        corpus(a.source, a.target, a.samples, a.minimal_html)


if __name__ == "__main__":
    main()
