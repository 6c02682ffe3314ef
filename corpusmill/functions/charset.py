"""The character set of bytes, and their text."""

from __future__ import annotations

import codecs

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Fixed value: how many bytes are enough where a guess from the start of a page is wanted.
SAMPLE = 8000

#: One-byte code pages that are told apart by their letters, the commonest first.
GUESSES = ["windows-1252", "windows-1251", "koi8-r", "windows-1250", "iso-8859-2", "windows-1253", "windows-1254", "windows-1256", "iso-8859-7"]
_MARKS = [(codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF32_LE, "utf-32le"), (codecs.BOM_UTF32_BE, "utf-32be"), (codecs.BOM_UTF16_LE, "utf-16le"), (codecs.BOM_UTF16_BE, "utf-16be")]


def _known(name: str | None) -> str | None:
    try:
        return codecs.lookup(name.strip().lower()).name if name else None
    except LookupError:
        return None


def _is_utf8(data: bytes) -> bool:
    try:
        data.decode("utf-8")
        return True
    except UnicodeDecodeError as e:
        # a character may be cut off at the end of the sample
        return e.start >= len(data) - 3 and e.reason == "unexpected end of data"


def _letters(text: str) -> float:
    """How much of what lies beyond ASCII reads like letters within words: case changes inside a word count against it."""
    score = 0.0
    before = " "
    for c in text:
        if c >= "\x80":
            if c.isalpha():
                # accented Latin letters seldom stand side by side; those of other scripts do, but not in a word of Latin ones
                crowded = c < "\u0250" and before >= "\x80" and before.isalpha()
                mixed = c >= "\u0370" and before.isascii() and before.isalpha()
                score += -1.0 if mixed else -0.5 if crowded else 1.0 if c.islower() or not before.isalpha() else -1.0
            elif c < "\xa0" or c in "¤¦¬¯´¸":
                score -= 2.0
            elif before.isalpha():
                score -= 0.5
        before = c
    return score


def detect(data: bytes | None, declared: str | None = None, most: int | None = None) -> str:
    """The character set by byte-order mark, strict UTF-8, declaration (if the bytes fit it) or letters; else utf-8. All
    bytes are looked at, or ``most`` of them, such as SAMPLE, where what comes later may be decoded wrongly."""
    if not data:
        return "utf-8"
    sample = bytes(data if most is None else data[:most])
    for mark, name in _MARKS:
        if sample.startswith(mark):
            return name
    if _is_utf8(sample):
        return "utf-8"
    known = _known(declared)
    if known and not known.startswith(("utf-16", "utf-32", "utf-8", "utf_")):
        try:
            if _letters(sample.decode(known)) >= 0:
                return declared.strip().lower()
        except UnicodeDecodeError:
            pass
    best, name = float("-inf"), "utf-8"
    for guess in GUESSES:
        try:
            score = _letters(sample.decode(guess))
        except UnicodeDecodeError:
            continue
        if score > best:
            best, name = score, guess
    # letters that stand alike in both are called by the older name
    return "iso-8859-1" if name == "windows-1252" and not any(0x80 <= b < 0xA0 for b in sample) else name


def decode(data: bytes | None, declared: str | None = None) -> str | None:
    if data is None:
        return None
    name = detect(data, declared)
    return bytes(data).decode(name, "replace").removeprefix("\ufeff")


@F.pandas_udf(StringType())
def detect_charset(content: pd.Series, declared: pd.Series) -> pd.Series:
    return pd.Series([None if c is None else detect(c, d) for c, d in zip(content, declared)], dtype=object)


def page_html(content: bytes | None, declared: str | None = None) -> str | None:
    """The HTML of a response: decoded, without the HTTP header; all of it where the header has no end."""
    text = decode(content, declared)
    if text is None:
        return None
    head, sep, rest = text.partition("\r\n\r\n")
    return rest if sep else text


@F.pandas_udf(StringType())
def html_of(content: pd.Series, declared: pd.Series) -> pd.Series:
    return pd.Series([page_html(c, d) for c, d in zip(content, declared)], dtype=object)
