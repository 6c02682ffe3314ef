"""Sizes in tokens of a public tokenizer; its file is a parameter and is read where it lies."""

from __future__ import annotations

import base64
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.textkit import batches


@lru_cache(maxsize=4)
def encoding(path: str | None = None):
    """A tiktoken encoding from a file of ranks; without one, the byte-level vocabulary that is installed."""
    import public_tokenizers
    import tiktoken

    name = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(name, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("of_file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def count(text: str | None, path: str | None = None) -> int:
    """Tokens of a whole text; 0 for null."""
    return len(encoding(path).encode_ordinary(text)) if text else 0


def source_name(column: Column) -> Column:
    """One spelling a source: lower case, trimmed, hyphens; null becomes the empty name."""
    return F.coalesce(F.regexp_replace(F.lower(F.trim(column)), r"[\s_]+", "-"), F.lit(""))


def token_table(documents: DataFrame, path: str | None = None, doc: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, tokens); null and empty texts have no tokens."""
    schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("tokens", pa.int64())])

    def run(batch: list[dict]) -> list[dict]:
        return [{"doc_id": r["doc_id"], "source": r["source"], "tokens": count(r["text"], path)} for r in batch]

    rows = documents.select(F.col(doc).alias("doc_id"), source_name(F.col(source)).alias("source"), F.col(text).alias("text"))
    return rows.mapInArrow(batches(run, schema), "doc_id long, source string, tokens long")
