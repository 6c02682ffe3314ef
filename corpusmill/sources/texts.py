"""Plain-text sources and sinks: lines, lists of addresses, document information and tables with semicolons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def lines(spark: SparkSession, paths: str) -> DataFrame:
    """(value): the lines of comma-separated paths with globs."""
    return spark.read.text([p.strip() for p in paths.split(",") if p.strip()])


def line_groups(spark: SparkSession, paths: str, n: int) -> DataFrame:
    """(file, first_line, value): every ``n`` lines of a file as one value, in order."""
    rows = lines(spark, paths).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"), "value")
    rows = rows.withColumn("no", F.row_number().over(W.partitionBy("file").orderBy("at")) - 1)
    grouped = rows.groupBy("file", F.floor(F.col("no") / n).alias("g")).agg(F.array_sort(F.collect_list(F.struct("no", "value"))).alias("v"))
    return grouped.select("file", (F.col("g") * n + 1).alias("first_line"), F.array_join(F.transform("v", lambda x: x["value"]), "\n").alias("value"))


def whole_texts(spark: SparkSession, paths: str) -> DataFrame:
    """(path, value): a row a file."""
    return spark.read.text([p.strip() for p in paths.split(",")], wholetext=True).select(F.input_file_name().alias("path"), "value")


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """(url): the different second fields of tab-separated lines."""
    return spark.read.text(path).select(F.get(F.split("value", "\t"), 1).alias("url")).where("url is not null").distinct()


def format_documents(docs: Column) -> Column:
    """``[id;length;hash;language, ...]`` from an array of structs (doc_id, doc_len, simhash, lang)."""
    one = F.transform(docs, lambda d: F.concat_ws(";", d["doc_id"], d["doc_len"].cast("string"), d["simhash"].cast("string"), F.coalesce(d["lang"], F.lit(""))))
    return F.concat(F.lit("["), F.array_join(one, ","), F.lit("]"))


def parse_documents(line: Column) -> Column:
    """The array of structs behind such a line; older lines without language, with semicolons between, are read too."""
    inner = F.regexp_replace(line, r"^\[|\]$", "")
    newer = F.split(inner, ",")
    older = F.split(inner, ";")
    is_old = F.size(F.split(newer[0], ";")) < 4

    def make(a: Column, b: Column, c: Column, d: Column) -> Column:
        return F.struct(a.alias("doc_id"), b.cast("int").alias("doc_len"), c.cast("bigint").alias("simhash"), d.alias("lang"))

    def new(x: Column) -> Column:
        p = F.split(F.trim(x), ";")
        return make(F.get(p, 0), F.get(p, 1), F.get(p, 2), F.nullif(F.get(p, 3), F.lit("")))

    def old(x: Column) -> Column:
        p = F.split(F.trim(x), ",")
        return make(F.get(p, 0), F.get(p, 1), F.get(p, 2), F.lit(None).cast("string"))

    return F.when(is_old, F.transform(older, old)).otherwise(F.transform(newer, new))


def write_tsv(df: DataFrame, path: str, compression: str = "none") -> None:
    df.write.mode("overwrite").option("compression", compression).csv(path, sep="\t")


def semicolon_table(df: DataFrame, row: str, columns: list[str]) -> DataFrame:
    """(at, value): a header line ``;c1;c2;`` and a line a row, all with a closing semicolon; nulls are 0. ``at`` orders them."""
    header = df.sparkSession.createDataFrame([(None, ";" + "".join(f"{c};" for c in columns))], "at string, value string")
    body = df.select(F.col(row).alias("at"), F.concat_ws(";", F.col(row), *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("0")) for c in columns), F.lit("")).alias("value"))
    return header.unionByName(body).orderBy(F.col("at").asc_nulls_first())
