"""WARC files as a Spark data source, ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading: one partition a file (gzip members are a stream); paths may be several, separated by commas, with globs. A file
that ends within a record ends there. ``mode``: FAILFAST (default) raises on a malformed record, PERMISSIVE leaves
the rest of that file out and gives a row of the type ``broken`` with the reason as content in its place. With ``pushFilters`` true, filters on warc_type, content_type and content_length go to the reader, which then
holds no content of records that they leave out; Spark keeps them with the loaded DataFrame, so such a DataFrame must be
filtered in one way only.

Writing: segments ``<prefix>.seg-00000.warc.gz``, a new one once ``segmentSize`` bytes are written (compressed, as they
lie on disk). Content-Length is always that of the content. A column ``prefix`` names the output of each record.
"""

from __future__ import annotations

import glob
import gzip
import io
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = (
    "source_path string, record_no bigint, warc_type string, warc_date string, record_id string, content_type string, "
    "target_uri string, content_length int, headers map<string,string>, header_order array<string>, content binary"
)
MAX_LINE = 10_000
_VERSION = re.compile(rb"WARC/[0-9.]+")


class WarcError(OSError):
    """A record that isn't well formed."""


class Truncated(Exception):
    """The file ends within a record."""


@dataclass
class Record:
    headers: dict[str, str] = field(default_factory=dict)
    content: bytes = b""

    def get(self, name: str) -> str | None:
        return self.headers.get(name)


def _line(stream) -> bytes:
    line = stream.readline(MAX_LINE + 2)
    if not line.endswith(b"\n"):
        if len(line) > MAX_LINE:
            raise WarcError(f"a header line is longer than {MAX_LINE} bytes")
        raise Truncated
    return line[:-2] if line.endswith(b"\r\n") else line[:-1]


def read_record(stream, keep=lambda headers: True) -> Record | None:
    """The next record, or None at the end of the stream. ``keep`` sees the headers and decides whether the content is held."""
    first = stream.readline(MAX_LINE + 2)
    if not first:
        return None
    if not first.endswith(b"\n"):
        raise Truncated
    if not _VERSION.fullmatch(first.rstrip(b"\r\n")):
        raise WarcError(f"no WARC version line: {first[:80]!r}")
    headers: dict[str, str] = {}
    last = None
    while True:
        line = _line(stream)
        if not line:
            break
        text = line.decode("utf-8", "replace")
        if text[0] in " \t":
            if last is None:
                raise WarcError("the first header line is a continuation")
            headers[last] += text
            continue
        name, colon, value = text.partition(":")
        if not colon:
            raise WarcError(f"no colon in header line {text[:80]!r}")
        last = name.strip()
        headers[last] = value.strip()
    try:
        length = int(headers["Content-Length"])
    except (KeyError, ValueError):
        raise WarcError("Content-Length is missing or no number") from None
    if keep(headers):
        content = stream.read(length)
        if len(content) < length:
            raise Truncated
    else:
        content, left = None, length
        while left:
            piece = stream.read(min(left, 1 << 20))
            if not piece:
                raise Truncated
            left -= len(piece)
    end = stream.read(4)
    if len(end) < 4:
        raise Truncated
    if end != b"\r\n\r\n":
        raise WarcError("a record does not end with two line ends")
    return Record(headers, content) if content is not None else Record(headers, b"")


def read_records(stream, keep=lambda headers: True) -> Iterator[tuple[int, Record, bool]]:
    """(number from 1, record, whether it was kept); a truncated last record ends the stream."""
    no = 0
    while True:
        kept = []

        def test(headers, kept=kept):
            kept.append(keep(headers))
            return kept[-1]

        try:
            record = read_record(stream, test)
        except (Truncated, EOFError):
            return
        if record is None:
            return
        no += 1
        yield no, record, kept[-1]


def serialize(headers: list[tuple[str, str]], content: bytes) -> bytes:
    """A record's bytes. Null headers are left out; Content-Length is set; line ends in a header are refused."""
    out = [b"WARC/1.0\r\n"]
    named = False
    for name, value in headers:
        if value is None:
            continue
        if "\r" in value or "\n" in value or "\r" in name or "\n" in name:
            raise WarcError(f"a line end in header {name!r}")
        if name == "Content-Length":
            value, named = str(len(content)), True
        out.append(f"{name}: {value}\r\n".encode())
    if not named:
        out.append(f"Content-Length: {len(content)}\r\n".encode())
    return b"".join([*out, b"\r\n", content, b"\r\n\r\n"])


def expand(paths: str) -> list[str]:
    """Files of comma-separated paths with globs; folders stand for the WARC files in them."""
    out: list[str] = []
    for path in filter(None, (p.strip() for p in paths.split(","))):
        path = path.removeprefix("file://")
        found = sorted(glob.glob(path))
        if not found:
            raise FileNotFoundError(path)
        for f in found:
            if os.path.isdir(f):
                out += sorted(x for x in glob.glob(os.path.join(f, "**", "*"), recursive=True) if x.endswith((".warc", ".warc.gz")))
            else:
                out.append(f)
    return out


@dataclass
class FilePartition(InputPartition):
    path: str

    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.paths = options.get("path") or options.get("paths") or ""
        self.mode = options.get("mode", "FAILFAST").upper()
        self.equal: dict[str, str] = {}
        self.below: int | None = None

    def partitions(self):
        return [FilePartition(p) for p in expand(self.paths)]

    def _wanted(self, headers: dict[str, str]) -> bool:
        if "warc_type" in self.equal and headers.get("WARC-Type") != self.equal["warc_type"]:
            return False
        if "content_type" in self.equal and headers.get("Content-Type") != self.equal["content_type"]:
            return False
        try:
            return self.below is None or int(headers.get("Content-Length", "0")) < self.below
        except ValueError:
            return True

    def read(self, partition):
        path = partition.path
        with open(path, "rb") as f:
            stream = io.BufferedReader(gzip.GzipFile(fileobj=f), 1 << 16) if path.endswith(".gz") else f
            no = 0
            try:
                for no, r, kept in read_records(stream, self._wanted):
                    if kept:
                        yield (
                            path, no, r.get("WARC-Type"), r.get("WARC-Date"), r.get("WARC-Record-ID"), r.get("Content-Type"),
                            r.get("WARC-Target-URI"), int(r.headers["Content-Length"]), r.headers, list(r.headers), r.content,
                        )
            except WarcError as e:
                if self.mode != "PERMISSIVE":
                    raise
                # what follows can't be found any more; the cut shows as a record of its own
                yield path, no + 1, "broken", None, None, None, None, None, None, None, str(e).encode()


class PushingWarcReader(WarcReader):
    def pushFilters(self, filters):
        for f in filters:
            name = ".".join(f.attribute) if hasattr(f, "attribute") else None
            if isinstance(f, EqualTo) and name in ("warc_type", "content_type"):
                self.equal[name] = f.value
            elif isinstance(f, (LessThan, LessThanOrEqual)) and name == "content_length":
                limit = f.value + isinstance(f, LessThanOrEqual)
                self.below = limit if self.below is None else min(self.below, limit)
            yield f  # Spark tests again; here only contents are spared


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class _Segments:
    """The open segment of one prefix."""

    def __init__(self, folder: str, prefix: str, task: str, compress: bool, limit: int):
        self.folder, self.prefix, self.task, self.compress, self.limit = folder, prefix, task, compress, limit
        self.no, self.raw, self.out, self.files, self.pending = 0, None, None, [], 0

    def write(self, data: bytes) -> None:
        if self.raw is not None and self.raw.tell() >= self.limit:
            self.close()
        if self.raw is None:
            name = f"{self.prefix}.{self.task}.seg-{self.no:05d}.warc{'.gz' if self.compress else ''}"
            hidden = os.path.join(self.folder, f".{name}.part")
            self.raw = open(hidden, "wb")  # noqa: SIM115
            self.out = gzip.GzipFile(fileobj=self.raw, mode="wb", filename="") if self.compress else self.raw
            self.files.append((hidden, os.path.join(self.folder, name)))
            self.no += 1
        self.out.write(data)
        self.pending += len(data)
        # the size on disk is known after a flush only; one a megabyte keeps segments near their limit and the compression good
        if self.compress and self.pending >= min(1 << 20, self.limit // 8):
            self.out.flush()
            self.pending = 0

    def close(self) -> None:
        if self.raw is not None:
            if self.compress:
                self.out.close()
            self.raw.close()
            self.raw = self.out = None


class WarcWriter(DataSourceWriter):
    """Columns: content, and header_order with headers or any of the promoted columns; optionally prefix."""

    PROMOTED = [("warc_type", "WARC-Type"), ("warc_date", "WARC-Date"), ("record_id", "WARC-Record-ID"), ("content_type", "Content-Type"), ("target_uri", "WARC-Target-URI")]
    #: Headers that carry what the pipeline found out.
    FOUND = [("license", "c4_license"), ("language", "c4_language"), ("no_boilerplate", "c4_noBoilerplate"), ("minimal_html", "c4_minimalHtml"), ("simhash", "c4_simhash"), ("source_path", "c4_originalLocation")]

    def __init__(self, schema: StructType, options, overwrite: bool):
        self.folder = (options.get("path") or "").removeprefix("file://")
        self.prefix = options.get("prefix", "part")
        self.compress = options.get("compression", "gzip").lower() != "none"
        self.limit = int(options.get("segmentSize", 1_000_000_000))
        self.names = schema.fieldNames()
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex[:8]
        if "content" not in self.names and "text" not in self.names:
            raise ValueError("a column content (binary) or text (string) is needed")
        os.makedirs(self.folder, exist_ok=True)

    def _headers(self, row: dict) -> list[tuple[str, str]]:
        given = dict(row.get("headers") or {})
        order = [h for h in (row.get("header_order") or list(given)) if h in given]
        out = [(h, given[h]) for h in order]
        for column, name in [*self.PROMOTED, *self.FOUND]:
            value = row.get(column)
            if value is not None and name not in given:
                out.append((name, str(value).lower() if isinstance(value, bool) else str(value)))
        return out

    def write(self, iterator):
        task = f"{self.job}-{uuid.uuid4().hex[:12]}"
        all_: dict[str, _Segments] = {}
        current = None
        for row in iterator:
            row = row.asDict(recursive=False)
            prefix = row.get("prefix") or self.prefix
            if prefix not in all_:
                all_[prefix] = _Segments(self.folder, re.sub(r"[^\w.=-]", "_", prefix), task, self.compress, self.limit)
            if current is not None and current != prefix:
                all_[current].close()  # one file is open at a time; rows sorted by prefix, as the pipeline's are, open each once
            current = prefix
            content = row.get("content")
            data = bytes(content) if content is not None else (row.get("text") or "").encode()
            all_[prefix].write(serialize(self._headers(row), data))
        files = []
        for s in all_.values():
            s.close()
            files += s.files
        return Written(files)

    def commit(self, messages):
        old = [f for f in os.listdir(self.folder) if f.endswith((".warc", ".warc.gz"))] if self.overwrite else []
        for f in old:
            os.remove(os.path.join(self.folder, f))
        for m in messages:
            for hidden, name in m.files if m else []:
                os.replace(hidden, name)
        self._sweep()

    def _sweep(self) -> None:
        """Parts that tasks of this job left behind when they were killed."""
        for f in os.listdir(self.folder):
            if f.endswith(".part") and f".{self.job}-" in f:
                os.remove(os.path.join(self.folder, f))

    def abort(self, messages):
        for m in messages:
            for hidden, _ in m.files if m else []:
                if os.path.exists(hidden):
                    os.remove(hidden)
        self._sweep()


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return PushingWarcReader(self.options) if self.options.get("pushFilters", "false").lower() == "true" else WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(schema, self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
