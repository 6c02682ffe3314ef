"""Problem 4: missing or wrong language labels, and foreign lines of mixed texts.

Method: compression classification. For each language a zstandard raw-content dictionary is made from lang_samples;
a text goes to the language whose dictionary makes it smallest, and to none where the margin to the next is narrow.

A page's language is that of most of its characters: the sizes of its lines, notices aside, under each dictionary are
added up. A line is first tried with the page's own dictionary and only if it stays
larger than such lines do in prose of that language, with the others: the same rule, as a line that the page's own
dictionary packs well cannot be packed much better by another one.

Defined results: null and empty texts and texts without letters get no language; labels in upper case, of three
letters or with a region count as their language; other labels are wrong as soon as the text has a language.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.pages import ARROW, SCHEMA as PROFILE, Seen, profile
from corpusmill.llm.textkit import Lexicon, batches, blanked, clean, common_words, notice

#: ISO 639-2 codes of the languages, both forms where there are two.
THREE = {"eng": "en", "deu": "de", "ger": "de", "fra": "fr", "fre": "fr", "spa": "es", "ita": "it", "por": "pt", "nld": "nl", "dut": "nl", "pol": "pl", "rus": "ru"}

SCHEMA = "record_id string, line_no int, lang string, confidence double, chars int"


def label(column: Column) -> Column:
    """The language that a label means: two lower-case letters, or null for none."""
    code = F.regexp_extract(F.lower(F.trim(column)), r"^([a-z]{2,3})(?:[-_].*)?$", 1)
    table = F.create_map(*(F.lit(x) for kv in THREE.items() for x in kv))
    code = F.coalesce(F.try_element_at(table, code), code)
    return F.when(code.isin("", "unk", "un", "und", "xx", "zxx"), None).otherwise(code)


def dictionaries(rows: Iterable, most: int = 110_000) -> dict[str, bytes]:
    """Raw-content dictionaries from (lang, text); ``most`` bytes a language, the documented bound of the model: texts
    are taken in turn until it is reached."""
    out: dict[str, bytearray] = {}
    for lang, text in rows:
        if lang and text:
            b = out.setdefault(lang.strip().lower()[:2], bytearray())
            if len(b) < most:
                b += b"\n" + normal(text)
    return {k: bytes(v[:most]) for k, v in sorted(out.items())}


_NOT_LETTERS = re.compile(r"[^\w\s'’]+|\d+")
_SPACES = re.compile(r"\s+")
#: The same character by character; line breaks stay.
_plain = blanked(_NOT_LETTERS)


def normal(text: str) -> bytes:
    """What is compressed: lower-case words; digits and marks tell nothing about a language."""
    return b" " + _SPACES.sub(" ", _NOT_LETTERS.sub(" ", text.lower())).strip().encode() + b" "


class Classifier:
    """Sizes of texts under the dictionaries; made once in a Python worker."""

    def __init__(self, dicts: dict[str, bytes], level: int = 1):
        self.langs = list(dicts)
        #: sizes by dictionary of what was packed since ``forget``
        self.known: dict[str, dict[bytes, int]] = {k: {} for k in dicts}
        params = zstd.ZstdCompressionParameters.from_level(level, write_checksum=False, write_content_size=False, write_dict_id=False)
        self.packers = {}
        for k, v in dicts.items():
            d = zstd.ZstdCompressionDict(v, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.packers[k] = zstd.ZstdCompressor(dict_data=d, compression_params=params)

    def forget(self) -> None:
        """To be called before each page or batch: its lines are packed more than once, those of others hardly ever."""
        for known in self.known.values():
            known.clear()

    def size(self, data: bytes, lang: str) -> int:
        known = self.known[lang]
        n = known.get(data)
        if n is None:
            n = known[data] = len(self.packers[lang].compress(data))
        return n

    def fill(self, pieces: list[bytes]) -> None:
        """Packs the pieces of many pages under one dictionary after another, so that each stays in the processor's cache;
        to change the dictionary with each piece takes about twice as long."""
        for k in self.packers:
            for data in pieces:
                self.size(data, k)

    def sizes(self, data: bytes) -> dict[str, int]:
        return {k: self.size(data, k) for k in self.packers}

    def best(self, data: bytes, margin: float = 0.02) -> tuple[str | None, float]:
        """(language, confidence); the confidence is how much larger the second smallest is, and the language is None
        where that is narrow."""
        return self.pick(self.sizes(data), len(data), margin)

    @staticmethod
    def blocks(pieces: list[bytes], block: int = 900) -> list[bytes]:
        """A text in pieces as blocks of about ``block`` bytes."""
        out, held, size = [], [], 0
        for i, piece in enumerate(pieces):
            held.append(piece)
            size += len(piece)
            if size >= block or i == len(pieces) - 1:
                out.append(b"".join(held))
                held, size = [], 0
        return out

    def best_of(self, pieces: list[bytes]) -> tuple[str | None, float]:
        """The same for a text in pieces. They are packed in blocks, as in a longer one the text's own words would soon
        serve as the dictionary; the sizes of all blocks are added up."""
        total = dict.fromkeys(self.langs, 0)
        blocks = self.blocks(pieces)
        for data in blocks:
            for k, v in self.sizes(data).items():
                total[k] += v
        return self.pick(total, sum(map(len, blocks)))

    @staticmethod
    def pick(sizes: dict[str, int], n: int, margin: float = 0.02) -> tuple[str | None, float]:
        order = sorted(sizes.items(), key=lambda x: (x[1], x[0]))
        (lang, a), b = order[0], order[1][1] if len(order) > 1 else order[0][1]
        lead = (b - a) / max(1, n)
        confidence = (b - a) / max(1, b)
        return (lang if lead >= margin and b - a >= 3 else None), round(confidence, 6)


def lines_of(text: str | None, seen: Seen | None = None) -> list[tuple[int, bytes, int]]:
    """(line number from 1, what is compressed, letters) of the lines that have words and are no notices; ``seen`` where
    it is at hand, as it knows the notices."""
    if not text:
        return []
    text, low = (clean(text), None) if seen is None else (seen.text, seen.low)
    plain = _plain(text.lower() if low is None else low).split("\n")
    out = []
    for no, (raw, line) in enumerate(zip(text.split("\n"), plain), 1):
        line = " ".join(line.split())
        if line and not (notice(raw.strip().lower()) if seen is None else no in seen.notices):
            out.append((no, f" {line} ".encode(), len(line) - line.count(" ")))
    return out


def confirmed(lines: list[tuple[int, bytes, int]], lang: str, c: Classifier, ratios: dict[str, float]) -> bool:
    """Whether the dictionary of a language packs every line of a page as well as it packs its own language."""
    limit = ratios.get(lang, 0.0)
    return bool(lines) and all(c.size(data, lang) <= limit * len(data) + 8 for _, data, _ in lines)


def classify_page(record_id: str, text: str | None, c: Classifier, ratios: dict[str, float], lines: list[tuple[int, bytes, int]] | None = None) -> list[dict]:
    """Row 0 has the page's language, further rows the lines in another one."""
    lines = lines_of(text) if lines is None else lines
    if not lines:
        return []
    total = sum(n for _, _, n in lines)
    lang, confidence = c.best_of([d for _, d, _ in lines])
    if lang is None and len(lines) > 1:
        # two languages in nearly equal parts: the one that most of the letters stand in, line by line
        each = [(c.best(d, 0.05), n) for _, d, n in lines]
        sums = {k: sum(n for (x, _), n in each if x == k) for k in {x for (x, _), _ in each if x is not None}}
        lang = max(sums, key=lambda k: (sums[k], k)) if sums and max(sums.values()) >= 0.5 * total else None
    if lang is None:
        return [{"record_id": record_id, "line_no": 0, "lang": None, "confidence": confidence, "chars": total}]
    out = []
    by = {}
    for no, data, n in lines:
        own = c.size(data, lang)
        if len(lines) == 1 or own <= ratios.get(lang, 0.5) * len(data) + 8:
            by[lang] = by.get(lang, 0) + n
            continue
        other, sure = c.best(data, 0.05)
        if other is not None:
            by[other] = by.get(other, 0) + n
            out.append({"record_id": record_id, "line_no": no, "lang": other, "confidence": sure, "chars": n})
        else:
            by[lang] = by.get(lang, 0) + n
    most = max(by.items(), key=lambda x: (x[1], x[0]))[0] if by else lang
    if most != lang:
        # the sum of all lines leans to another language than most of the characters: judge every line anew
        out = []
        for no, data, n in lines:
            other, sure = c.best(data, 0.05)
            if other is not None and other != most:
                out.append({"record_id": record_id, "line_no": no, "lang": other, "confidence": sure, "chars": n})
        lang = most
    out = [x for x in out if x["lang"] != lang]
    return [{"record_id": record_id, "line_no": 0, "lang": lang, "confidence": confidence, "chars": total}, *out]


def wrong_of(batch: list[tuple[str, str | None, list[tuple[int, bytes, int]]]], c: Classifier, ratios: dict[str, float]) -> list[list[dict]]:
    """What is wrong on each page of a batch of (record_id, label, lines): the rows of ``classify_page`` that its label
    does not have. The verdicts are those of the pages one by one; what they need is packed for all together."""
    c.forget()
    by: dict[str | None, list[int]] = {}
    for i, (_, given, _) in enumerate(batch):
        by.setdefault(given if given in c.packers else None, []).append(i)
    left = by.pop(None, [])
    for given, at in by.items():
        left += [i for i in at if not confirmed(batch[i][2], given, c, ratios)]
    c.fill([b for i in left for b in c.blocks([d for _, d, _ in batch[i][2]])])
    leant: dict[str | None, list[int]] = {}
    for i in left:
        if len(batch[i][2]) > 1:
            leant.setdefault(c.best_of([d for _, d, _ in batch[i][2]])[0], []).append(i)
    # the lines that classify_page will try under all dictionaries
    tried = [d for i in leant.pop(None, []) for _, d, _ in batch[i][2]]
    for lang, at in leant.items():
        tried += [d for i in at for _, d, _ in batch[i][2] if c.size(d, lang) > ratios.get(lang, 0.5) * len(d) + 8]
    c.fill(tried)
    out: list[list[dict]] = [[] for _ in batch]
    for i in left:
        record_id, given, lines = batch[i]
        out[i] = [x for x in classify_page(record_id, None, c, ratios, lines) if x["lang"] is not None and (x["line_no"] > 0 or x["lang"] != given)]
    return out


def samples(lang_samples: DataFrame, most: int = 5000) -> list[tuple[str, str]]:
    """The labelled texts on the driver, at most ``most`` of them: the bounded sample that the model is fitted on."""
    rows = lang_samples.where("lang is not null and text is not null").orderBy("sample_id").limit(most).collect()
    return [(r["lang"], r["text"]) for r in rows]


def own_ratios(dicts: dict[str, bytes], texts: list[tuple[str, str]]) -> dict[str, float]:
    """By language, the ratio under its own dictionary that nearly all lines of held-out halves of the samples stay below,
    set so that it is far below what lines of another language get."""
    half = {k: v[: len(v) // 2] for k, v in dicts.items()}
    c = Classifier(half)
    own: dict[str, list[float]] = {}
    foreign: dict[str, list[float]] = {}
    by_lang: dict[str, list[str]] = {}
    for lang, text in texts:
        by_lang.setdefault(lang.strip().lower()[:2], []).append(text)
    # the last third of each language, which its half of a dictionary doesn't have
    for lang, text in ((k, t) for k, v in by_lang.items() for t in v[-max(1, len(v) // 3) :]):
        for line in text.split("\n"):
            data = normal(line)
            if len(data) < 40:
                continue
            for k, n in c.sizes(data).items():
                (own if k == lang else foreign).setdefault(k, []).append((n - 8) / len(data))
    out = {}
    for k in dicts:
        a, b = sorted(own.get(k, [0.4])), sorted(foreign.get(k, [0.6]))
        low = b[len(b) // 100]
        out[k] = min(0.5 * (a[len(a) // 2] + low), low)
    return out


def languages(corpus: DataFrame, lang_samples: DataFrame, text: str = "text", record: str = "record_id") -> DataFrame:
    """(record_id, line_no, lang, confidence, chars): line_no 0 for the page, and a row a line in another language."""
    dicts, ratios = _model(lang_samples)
    schema = pa.schema([("record_id", pa.string()), ("line_no", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64()), ("chars", pa.int32())])
    cache: dict = {}

    def run(batch: list[dict]) -> list[dict]:
        if "c" not in cache:
            cache["c"] = Classifier(dicts)
        out = []
        for r in batch:
            cache["c"].forget()
            out += classify_page(r["record_id"], r["text"], cache["c"], ratios)
        return out

    rows = corpus.where(F.col(record).isNotNull()).select(F.col(record).alias("record_id"), F.col(text).alias("text"))
    return rows.mapInArrow(batches(run, schema), SCHEMA)


def _model(lang_samples: DataFrame):
    texts = samples(lang_samples)
    dicts = dictionaries(texts)
    return dicts, own_ratios(dicts, texts)


def wrong_labels(corpus: DataFrame, lang_samples: DataFrame, keep: tuple[str, ...] = (), words_table: DataFrame | None = None) -> DataFrame:
    """A row a page whose label is missing or wrong or that has lines in another language: record_id, the columns
    named by ``keep``, and found, an array of (line_no, lang, confidence) with line_no 0 for the label.

    A page whose every line its label's dictionary packs as well as text of that language is right as it is and needs no other dictionary.

    With ``words_table``, common_words, every page has a row, right or not, which has the columns of its profile besides,
    so that one pass over the texts makes both; found and what is kept are null where nothing is wrong.
    """
    dicts, ratios = _model(lang_samples)
    words = Lexicon(common_words(words_table)) if words_table is not None else None
    spark_types = {f.name: f.dataType.simpleString() for f in corpus.schema}
    arrow = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    found = pa.list_(pa.struct([("line_no", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64())]))
    schema = pa.schema([*(ARROW if words else [ARROW.field("record_id")]), *((k, arrow[spark_types[k]]) for k in keep), ("found", found)])
    cache: dict = {}

    def run(batch: list[dict]) -> list[dict]:
        if "c" not in cache:
            cache["c"] = Classifier(dicts)
        seen = [Seen(r["text"], words) if words else None for r in batch]
        wrongs = wrong_of([(r["record_id"], r["_given"], lines_of(r["text"], s)) for r, s in zip(batch, seen)], cache["c"], ratios)
        out = []
        for r, s, wrong in zip(batch, seen, wrongs):
            row = profile(r["record_id"], None, words, s) if s else {"record_id": r["record_id"]}
            if wrong:
                row |= {k: r[k] for k in keep}
                row["found"] = [{k: x[k] for k in ("line_no", "lang", "confidence")} for x in wrong]
            if wrong or s:
                out.append(row)
        return out

    rows = corpus.where("record_id is not null").select("record_id", *(k for k in dict.fromkeys((*keep, "text"))), label(F.col("language")).alias("_given"))
    columns = "".join(f", `{k}` {spark_types[k]}" for k in keep)
    first = PROFILE if words else "record_id string"
    return rows.mapInArrow(batches(run, schema), f"{first}{columns}, found array<struct<line_no:int,lang:string,confidence:double>>")
