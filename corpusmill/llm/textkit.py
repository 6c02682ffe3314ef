"""What the per-page operators share: the form of a line, notices, words. Plain Python for Arrow batches."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa

from corpusmill.llm.lines import BLANKS, INVISIBLE

_HIDDEN = re.compile(f"[{INVISIBLE}]")
_ODD = BLANKS.replace("\t", "")
_BLANK = re.compile(f"[{_ODD}]")


def clean(text: str) -> str:
    """Without invisible characters; every odd blank but the tab is a space."""
    if text.isascii():
        return text.replace("\r", " ") if "\r" in text else text
    # to look for each character alone takes far less than a pattern over the text
    if any(c in text for c in INVISIBLE):
        text = _HIDDEN.sub("", text)
    return _BLANK.sub(" ", text) if any(c in text for c in _ODD) else text


def blanked(off: re.Pattern, usual: int = 0x3000) -> Callable[[str], str]:
    """A function that makes blanks of the characters that ``off`` matches one by one; line breaks stay. Characters below
    ``usual`` are looked up, and texts that have others go through the pattern."""
    table = np.array([32 if i != 10 and off.fullmatch(chr(i)) else i for i in range(usual)], np.uint32)
    ascii_only = {i: " " for i in range(128) if table[i] != i}

    def run(text: str) -> str:
        if text.isascii():
            return text.translate(ascii_only)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if int(codes.max()) >= usual:
            return "\n".join(off.sub(" ", x) for x in text.split("\n"))
        return table[codes].tobytes().decode("utf-32-le", "surrogatepass")

    return run

#: Wording of site notices and share prompts in nine languages, as lower-case text; anywhere in a line, and at its start.
NOTICE_IN = (
    "©", "(c) 19", "(c) 20", "all rights reserved", "alle rechte vorbehalten", "alle rechten voorbehouden", "tous droits réservés", "todos los derechos", "tutti i diritti", "todos os direitos", "wszelkie prawa", "все права защищены",
    "newsletter", "lettre d'information", "boletín", "boletim", "nieuwsbrief", "biuletyn", "рассылк",
    "artikel teilen", "tell your friends", "follow us", "like what you read", "support independent writing",
    "post a reply", "leave a comment", "leave a reply", "einen kommentar zu schreiben", "laisser un commentaire", "dejar un comentario", "lasciare un commento", "para comentar", "reactie te plaatsen", "dodać komentarz", "оставить комментарий",
    "last updated", "registered office", "company number", "views expressed", "do not reflect the opinion",
    "reproduction in whole", "toute reproduction", "prohibida la reproducción", "riproduzione riservata", "reprodução proibida",
    "people found this", "fanden diese seite", "ont trouvé cette page", "was this page useful",
)
NOTICE_AT = (
    "share ", "teilen", "partager", "compartir", "condividi", "partilhar", "compartilhar", "deel dit", "udostępnij", "поделиться",
    "filed under", "posted on", "posted by", "zuletzt geändert", "mis à jour", "última actualización", "última atualização", "ultimo aggiornamento", "laatst bijgewerkt", "laatst gewijzigd", "ostatnia aktualizacja", "ostatnia zmiana", "обновлено",
    "text and pictures", "nachdruck",
)
_BYLINE = re.compile(r"(?:by|von|par|por|di|door|autora?:?|автор:?) (?:.{3,60}\d{4}[\d\W]*|[^\W\d_][\w'’-]+(?: [\w.'’-]+){1,2})$")
_BY = ("by ", "von ", "par ", "por ", "di ", "door ", "autor", "автор")

_notices = ahocorasick.Automaton()
for _x in NOTICE_IN:
    _notices.add_word(_x, _x)
_notices.make_automaton()


_SENTENCES = re.compile(r"(?<=[.!?…;])\s+")
#: The sign of a copyright stands alone; beside letters it is a spoiled character.
_SIGN = re.compile(r"(?:^|[\s(|·•–—-])©")


def _told(low: str) -> bool:
    if low.startswith(NOTICE_AT):
        return True
    return any(x != "©" or _SIGN.search(low) is not None for _, x in _notices.iter(low))


def notice(low: str, told: Callable[[str], bool] = _told) -> bool:
    """Whether a lower-case line is a site notice, a share prompt or a byline: the sentences with such wording are a third
    of it or more, whatever its length."""
    if low.startswith(_BY) and _BYLINE.match(low) is not None:
        return True
    if not told(low):
        return False
    pieces = _SENTENCES.split(low)
    return len(pieces) == 1 or sum(len(x) for x in pieces if told(x)) >= 0.3 * sum(map(len, pieces))


WORD = re.compile(r"[^\W\d_]+")
_worded = blanked(re.compile(r"[\W\d_]"))
_SHAPED = frozenset("\t|{}=<>#[]@%;•»+*^~_")
_URL = re.compile(r"^\W*(?:https?://|www\.)\S+\W*$")
_LINKED = re.compile(r"\[[^\]\n]{1,80}\]\([^)\s]{1,200}\)")
_SITE_END = re.compile(r"\s[-–|»>]\s*(?:[\w-]+\.)+[a-z]{2,}\W*$")
_HASHTAG = re.compile(r"#[^\W\d]\w+")
_TAGS = re.compile(r"^(?:tags?|keywords?|schlagw[oö]rter|mots-clés|etiquetas|parole chiave|palavras-chave|trefwoorden|słowa kluczowe|теги|метки)\s*:", re.I)
_BULLET = re.compile(r"^(?:[-–*•·▪]\s|\d{1,4}[.)]\s|\(\d+\)\s|\[\d+\]\s|\d+(?:[.,]\d+)?\s?(?:g|kg|ml|cl|dl|l|x|tbsp|tsp|el|tl|cup|cups)\s)")
_INDEX = re.compile(r"\.{3,}\s*\d+|…\s*\d+\s*(?:$|[•·])")
_CODE = re.compile(r"function\s*\(|=>|\bvar \w+|;\s*\}|\{[\w-]+\s*:|\}\s*;?$|</?\w+[^>]*>|^\s*(?:if|for|while|return|import|def|class|const|let|public|private)\b.*[;{(:]\s*$|^\S+\s*=\s*\S+;$")
_LOG = re.compile(r"^\W*\d{4}-\d\d-\d\d[T ]\d\d:\d\d\S*\s|^\d{1,3}(?:\.\d{1,3}){3} |\[(?:INFO|WARN|ERROR|DEBUG|TRACE|FATAL)\]")
_TIMES = re.compile(r"\b\d{1,2}:\d\d\b")
_NUMBER = re.compile(r"\d+(?:[.,]\d+)*")
_SENTENCE = re.compile(r"[^\W\d][.!?…] [^\W\da-zа-я]|[.!?…] \(\d")
_VOWEL = re.compile(r"[aeiouyáéíóúàèìòùâêîôûäëïöüãõåæœøąęóаеёиоуыэюяіAEIOUYАЕЁИОУЫЭЮЯ]", re.I)


def words_of(text: str) -> list[str]:
    """All that WORD finds in a text."""
    return _worded(text).split()


LINK, TAGS, LIST, TABLE, JUNK, PROSE, NOTE = "link", "tags", "list", "table", "junk", "prose", "note"


def form(line: str) -> str:
    """The form of one stripped, non-empty line: prose unless its shape says otherwise; verse and dialogue are prose."""
    n = len(line)
    if notice(line.lower()):
        return NOTE
    if n > 40 and line[-1] in ".!?…" and line[0].isalpha() and _SHAPED.isdisjoint(line) and ".." not in line and "   " not in line and "http" not in line and n < 20 * (line.count(" ") + 1) and line.count(",") == line.count(", "):
        return PROSE
    if _URL.match(line):
        return LINK
    linked = sum(len(x) for x in _LINKED.findall(line))
    if linked > 0.6 * n or _SITE_END.search(line):
        return LINK
    if _TAGS.match(line):
        return TAGS
    if line.count("#") >= 2 and sum(len(x) for x in _HASHTAG.findall(line)) > 0.6 * n:
        return TAGS
    # a character that was lost stood in a word
    solid = sum(map(str.isalnum, line)) + line.count("\ufffd")
    blank = line.count(" ")
    worded = n > 60 and solid >= 0.8 * (n - blank) and blank >= n / 12
    if not worded and (_LOG.search(line) or _CODE.search(line)):
        return JUNK
    if line.count("\t") >= 2:
        return TABLE
    if n >= 8 and solid < 0.55 * (n - blank):
        return JUNK
    numbers = _NUMBER.findall(line)
    if line.count("|") >= 3 and len(numbers) >= 2 or len(_TIMES.findall(line)) >= 2 and ("  " in line or n < 80):
        return TABLE
    if (line.count(",") >= 3 or line.count(";") >= 3) and blank <= n / 20 and numbers:
        return TABLE
    commas = line.count(", ")
    inner = _SENTENCE.search(line) is not None
    if line.count(",") >= 3 and ", " not in line and numbers:
        return TABLE
    if _BULLET.match(line) or _INDEX.search(line):
        # a dash before a sentence opens a line of dialogue
        return PROSE if line[0] in "–—" and line[-1] in ".!?…”»" else LIST
    if line.count("; ") >= 3 and line[-1] not in ".!?":
        return LIST
    words = line.split()
    if max(map(len, words)) >= 40 and blank <= n / 30:
        return JUNK
    if commas >= 4 and not inner and line[-1] not in ".!?…" and len(words) <= 5 * (commas + 1):
        return TAGS
    bars = 0 if inner else len(re.findall(r" [|»>•·–-] ", line))
    if bars >= 3 and len(words) - bars <= 7 * (bars + 1) and line[-1] not in ".!?…":
        return TAGS
    if n >= 20:
        letters = WORD.findall(line)
        size = sum(map(len, letters))
        if size and "\ufffd" not in line and len(_VOWEL.findall(line)) < 0.15 * size:
            return JUNK
        # encoded text: long words in which case and digits change inside
        odd = sum(len(w) for w in words if len(w) >= 12 and re.search(r"[a-z][A-Z].*[a-z][A-Z]|\d[A-Za-z]+\d|[A-Z][a-z]+\d", w))
        if odd > 0.6 * n:
            return JUNK
        if sum(map(len, numbers)) > 0.35 * (n - blank) and len(numbers) >= 3:
            return TABLE
    return PROSE


def parts(text: str | None) -> Iterator[tuple[int, str, str]]:
    """(line number from 1, stripped line, form) of the non-blank lines of a text that was cleaned."""
    for no, raw in enumerate(text.split("\n") if text else (), 1):
        line = raw.strip()
        if line:
            yield no, line, form(line)


def batches(fn: Callable[[list[dict]], list[dict]], schema: pa.Schema, rows: int = 500) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function from one over lists of rows. Only ``rows`` of a batch are Python objects at a time."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for at in range(0, batch.num_rows, rows):
                out = fn(batch.slice(at, rows).to_pylist())
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


class Lexicon:
    """The common words of all languages, arranged so that the words of a page are counted by language in one go."""

    def __init__(self, words: dict[str, tuple[str, ...]]):
        self.sets = sorted(set(words.values()))
        at = {langs: i for i, langs in enumerate(self.sets)}
        self.at = {w: at[langs] for w, langs in words.items()}
        self.words = self.at.keys()

    def _hits(self, sums: dict[int | None, int]) -> dict[str, int]:
        hits: dict[str, int] = {}
        for i, n in sums.items():
            if i is not None:
                for lang in self.sets[i]:
                    hits[lang] = hits.get(lang, 0) + n
        return hits

    def share(self, tokens: list[str]) -> float:
        """The share of the common words of the language that has most of them."""
        return max(self._hits(Counter(map(self.at.get, tokens))).values(), default=0) / max(1, len(tokens))

    def of(self, tokens: list[str], counts: Counter) -> tuple[str | None, int, int]:
        """The language with the most common words among the tokens, how many of them are its common words, and how
        often the most frequent word of three letters or more comes that is common in no language."""
        at, sums, top = self.at.get, {}, 0
        for w, n in counts.items():
            i = at(w)
            if i is not None:
                sums[i] = sums.get(i, 0) + n
            elif n > top and len(w) > 2:
                top = n
        hits = self._hits(sums)
        if not hits:
            return None, 0, top
        best = max(hits.items(), key=lambda x: (x[1], x[0]))
        return best[0], best[1], top


def word_table(rows: list) -> dict[str, tuple[str, ...]]:
    """word -> languages, from common_words; a table of fixed size (some hundred words a language)."""
    out: dict[str, set[str]] = {}
    for r in rows:
        if r["word"] and r["lang"]:
            out.setdefault(r["word"].lower(), set()).add(r["lang"].strip().lower()[:2])
    return {w: tuple(sorted(v)) for w, v in out.items()}


def common_words(df) -> dict[str, tuple[str, ...]]:
    """The table common_words on the driver; refused beyond 200,000 rows, as it is sent to every task."""
    rows = df.select("lang", "word").limit(200_001).collect()
    if len(rows) > 200_000:
        raise ValueError("common_words is meant to be a short list of frequent words")
    return word_table(rows)
