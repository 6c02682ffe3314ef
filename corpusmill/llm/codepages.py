"""Code pages, the bytes behind their characters, and UTF-8 that was read as one of them."""

from __future__ import annotations

import re
from functools import lru_cache

#: Code pages that UTF-8 is often read as, and one-byte code pages often taken for one another.
READ_AS = ["cp1252", "latin-1", "cp1250", "cp1251", "mac_roman", "cp437", "iso8859-2", "koi8-r", "cp866"]
ONE_BYTE = ["cp1252", "latin-1", "cp1250", "iso8859-2", "cp1251", "koi8-r", "iso8859-5", "cp866", "mac_cyrillic", "mac_roman", "cp437", "cp850"]

#: What texts in the nine languages are written with, beside ASCII.
LETTERS = "áéíóúñüàèìòùâêîôûäöëïßçãõœæøåýąćęłńśźżÁÉÍÓÚÑÜÀÈÌÒÙÂÊÎÔÛÄÖËÏÇÃÕŒÆØÅĄĆĘŁŃŚŹŻабвгдежзийклмнопрстуфхцчшщъыьэюяёАБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯЁ"
MARKS = "–—‘’‚“”„«»…•€£©®™°§¡¿ºª·½¼¾²³±×\u00a0\u2009\u202f№"
PLAUSIBLE = frozenset(LETTERS + MARKS)
_HALFWAY = frozenset(bytes(b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)).decode("cp1252"))


@lru_cache
def bytes_of(page: str) -> dict[str, int]:
    """The byte behind each character of a code page; bytes without one are kept as the control character of that number."""
    out = {}
    for b in range(128, 256):
        try:
            c = bytes([b]).decode(page)
        except UnicodeDecodeError:
            c = chr(b)
        out.setdefault(c, b)
    return out


@lru_cache
def runs() -> list[tuple[str, re.Pattern, dict[str, int]]]:
    out = []
    for page in READ_AS:
        of = bytes_of(page)
        lead2 = "".join(re.escape(c) for c, b in of.items() if 0xC2 <= b <= 0xDF)
        lead3 = "".join(re.escape(c) for c, b in of.items() if 0xE0 <= b <= 0xEF)
        tail = "".join(re.escape(c) for c, b in of.items() if 0x80 <= b <= 0xBF)
        out.append((page, re.compile(f"(?:[{lead2}][{tail}]|[{lead3}][{tail}][{tail}])"), of))
    return out


_LEADS = re.compile("[" + "".join(re.escape(c) for c in sorted({c for p in READ_AS for c, b in bytes_of(p).items() if 0xC2 <= b <= 0xEF})) + "][^\x00-\x7f]")


def undo(run: str, of: dict[str, int]) -> str | None:
    """The character behind a run of misread bytes, or None where that isn't plausible."""
    try:
        c = bytes(of[x] for x in run).decode("utf-8")
    except (KeyError, UnicodeDecodeError):
        return None
    # what was misread twice shows signs of Latin-1 and its neighbours after the first turn
    return c if c in PLAUSIBLE or "\x80" <= c <= "\xff" or c in _HALFWAY and "а" not in of else None


def misread(text: str) -> tuple[str | None, int]:
    """(code page, number of runs) of UTF-8 read as a code page; None where there is none."""
    best: tuple[str | None, int] = (None, 0)
    if not _LEADS.search(text):
        return best
    for page, pattern, of in runs():
        n = latin = 0
        for m in pattern.finditer(text):
            c = undo(m[0], of)
            if c is not None:
                n += 1
                latin += not ("а" <= c.lower() <= "ё" and page in ("cp1251", "koi8-r", "cp866"))
        # letters of one alphabet may stand for one another by chance
        if n > best[1] and (latin or n >= 3):
            best = (page, n)
    return best


def restore_utf8(text: str, rounds: int = 3) -> str:
    """UTF-8 misreadings undone, repeatedly where the text was misread twice."""
    for _ in range(rounds):
        page, n = misread(text)
        if page is None:
            break
        _, pattern, of = next(x for x in runs() if x[0] == page)
        fixed = pattern.sub(lambda m: undo(m[0], of) or m[0], text)
        if fixed == text:
            break
        text = fixed
    return text
