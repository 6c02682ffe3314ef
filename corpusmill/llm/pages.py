"""One pass over the page texts: the narrow profile from which problems 2, 5 and 6 are decided.

A row of the profile is a few numbers, whatever the length of the text. Texts are read whole. Null and empty texts
have a profile of zeros; a null record id is left out; equal rows of an id give equal profiles and are merged.
"""

from __future__ import annotations

import re
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.textkit import JUNK, LINK, LIST, NOTE, PROSE, TABLE, TAGS, Lexicon, batches, clean, common_words, notice, parts, words_of

SCHEMA = (
    "record_id string, lang string, n_words int, n_types int, curve array<struct<f:int,m:int>>, top_word double, top_pair double, common double, "
    "chars int, note int, link int, tags int, list int, table int, junk int, prose int, word_len double, symbols double, closed double, digits double, upper double, "
    "slots int, said int, filler int, said_lines int"
)

ARROW = pa.schema(
    [("record_id", pa.string()), ("lang", pa.string()), ("n_words", pa.int32()), ("n_types", pa.int32()), ("curve", pa.list_(pa.struct([("f", pa.int32()), ("m", pa.int32())])))]
    + [(k, pa.float64()) for k in ("top_word", "top_pair", "common")]
    + [(k, pa.int32()) for k in ("chars", "note", "link", "tags", "list", "table", "junk", "prose")]
    + [(k, pa.float64()) for k in ("word_len", "symbols", "closed", "digits", "upper")]
    + [(k, pa.int32()) for k in ("slots", "said", "filler", "said_lines")]
)

# --- evidence of problem 6 -------------------------------------------------------------------------------------------

_NAME = r"[A-Za-z][A-Za-z0-9_]*(?:[._ -][A-Za-z0-9_]+){0,3}"
#: The ways in which template languages write a slot.
SLOT = re.compile(
    rf"\{{\{{\{{?\s*{_NAME}(?:\s*\|\s*\w+)?\s*\}}?\}}\}}|\{{%-?\s*{_NAME}\s*-?%\}}|<%[=-]?\s*{_NAME}\s*-?%>|\$\{{{_NAME}\}}|#\{{{_NAME}\}}|\[\[{_NAME}\]\]|@@{_NAME}@@|##{_NAME}##"
    rf"|%[A-Za-z]+(?:_[A-Za-z]+)*%|\$[a-z][a-z0-9_]+\$|(?<!\w)__[A-Z][A-Z0-9_]*?__(?!\w)|!!missing {_NAME}!!|\?\?\?{_NAME}\?\?\?|\[insert {_NAME} here\]|\[YOUR [A-Z_ ]+\]|\[object Object\]"
    r"|(?<![\w.])label\.\w+(?:\.\w+)+|(?<=\s)&[a-z]+_?[a-z]+;(?=[\s.,]|$)|(?<=\s)<[A-Z][A-Z_ ]+>(?=[\s.,]|$)|(?<!\w)undefined(?! behavio)(?!\w)"
)
_ESCAPED = re.compile("%[0-9A-Fa-f]{2}%[0-9A-Fa-f]{2}")
_SLOT_HINTS = ("{{", "{%", "${", "#{", "[[", "@@", "##", "%", "$", "__", "!!", "???", "[insert", "[YOUR", "[object", "label.", "&", "<", "undefined")
#: Words of sentences that write about slots rather than leave one unfilled.
ABOUT = re.compile(r"\b(?:slots?|placeholders?|handbook|manual|template language|syntax|variables?|platzhalter|handbuch|marcador|plantilla|manuale?l?|segnaposto|plaatshouder|sjabloon|handleiding|podręcznik|symbol zastępczy|шаблон\w*|руководств\w*|gabarit|modèle|espace réservé|marque-page)\b", re.I)

#: Error and access messages, by their wording, in nine languages.
SAID_IN = (
    "access denied", "access is denied", "zugriff verweigert", "accès refusé", "acceso denegado", "accesso negato", "acesso negado", "toegang geweigerd", "odmowa dostępu", "brak dostępu", "доступ запрещ", "доступ закрыт",
    "do not have permission", "keine berechtigung", "n'avez pas l'autorisation", "no tiene permiso", "non ha l'autorizzazione", "non hai l'autorizzazione", "non dispone dell'autorizzazione", "não tem permissão", "geen toegang", "geen toestemming", "nie masz uprawnień", "nie ma uprawnień", "нет прав",
    "no se ha encontrado la página", "nie znaleziono strony", "strona nie została znaleziona", "não foi encontrada a página", "may have been moved or deleted", "check the address and try again",
    "bandwidth limit exceeded", "bad gateway", "internal server error", "service unavailable", "gateway timeout", "gateway time-out", "too many requests", "too many connections", "database connection failed", "account has been suspended", "not available at present",
    "wewnętrzny błąd", "erreur interne du", "interner serverfehler", "error interno", "errore interno", "erro interno", "interne serverfout", "внутренняя ошибка",
    "session has expired", "sitzung ist abgelaufen", "session a expiré", "sesión ha caducado", "sesión ha expirado", "sessione è scaduta", "sessão expirou", "sessie is verlopen", "sesja wygasła", "сессия истек", "сеанс истек", "срок сессии",
    "something went wrong", "etwas ist schiefgelaufen", "une erreur est survenue", "une erreur s'est produite", "algo salió mal", "algo ha salido mal", "qualcosa è andato storto", "algo correu mal", "er is iets misgegaan", "coś poszło nie tak", "что-то пошло не так", "could not complete your request",
    "down for maintenance", "under maintenance", "service will be back", "wegen wartungsarbeiten ist", "est en maintenance et", "está en mantenimiento. ", "è in manutenzione", "em manutenção. ", "in onderhoud. ", "trwają prace konserwacyjne", "trwa konserwacja", "ведутся технические работы", "на техническом обслуживании",
    "content requires script", "content requires javascript", "requires javascript", "javascript is required", "javascript is disabled", "browser is out of date", "cookies turned off", "cannot be shown without them", "checking your browser before", "wymaga javascript", "требуется javascript",
)
_ERROR_NO = re.compile(r"(?:error|fehler|erreur|errore|erro|fout|foutmelding|błąd|ошибка)\s*(?:code|nr\.?|n[°º])?\s*:?\s*\d{3,}\W*$")
_SWITCH_ON = re.compile(
    r"(?:enable|activate|switch on|turn on|aktivieren|einschalten|schalten sie|activer|active[rz]?|activar|habilit\w+|attiv\w+|abilit\w+|ative|schakel|inschakelen|activeer|włącz\w*|включите|включить)\b.{0,50}(?:java ?script|cookies|scripts?)\b"
)
_NOT_FOUND = re.compile(
    r"(?:page|seite|página|pagina|strona|страница|url|file|datei|fichier)\b.{0,80}(?:could not be found|was not found|not found|nicht gefunden|introuvable|encontrad[ao]|(?:è stata|è stato) trovat[ao]|niet gevonden|nie (?:została )?znalezion|не найден)"
)
_FOUND = ("be found", "not found", "nicht gefunden", "introuvable", "encontrad", "trovat", "gevonden", "znalezion", "найден")

#: Texts that a site builder leaves for its owner to replace, by their wording; below, whole lines.
FILLER_IN = (
    "lorem ipsum", "blindtext", "sample page", "sample text", "replace this text", "replace this page", "edit or delete this", "is a placeholder", "placeholder for", "freshly installed", "coming soon", "content will be added", "only here to show how", "goes here", "write a short description of your", "body text body text",
    "hier steht ihr text", "ersetzen sie ihn", "beschreiben sie hier", "befindet sich im aufbau", "seite im aufbau",
    "texte d'exemple", "à remplacer par", "décrivez ici", "votre texte ici", "page en construction", "texto de muestra", "texto de ejemplo", "texto de exemplo", "describa aquí", "escriba aquí", "página en construcción", "su texto aquí",
    "testo di esempio", "testo di prova", "inserisci qui", "inserite qui", "scrivi qui", "scrivete qui", "descrivi qui", "descriva qui", "pagina in costruzione", "il tuo testo qui", "escreva aqui", "descreva aqui", "página em construção", "seu texto aqui", "insira aqui",
    "voorbeeldtekst", "uw tekst hier", "hier komt uw tekst", "beschrijf hier", "pagina is in opbouw", "in aanbouw", "przykładowy tekst", "tekst przykładowy", "wpisz tutaj", "twój tekst tutaj", "opisz tutaj", "strona w budowie",
    "пример текста", "введите текст", "введите здесь", "ваш текст здесь", "опишите здесь", "страница в разработке", "сайт в разработке",
)
FILLER_LINES = frozenset("title subtitle headline heading untitled titel untertitel titre sous-titre título subtítulo titolo sottotitolo tytuł podtytuł заголовок подзаголовок".split())
_ADD_HERE = re.compile(r"(?:insert|add|enter|type|write|put) (?:your|a|an|the) .{0,40}(?:here|below|in this (?:place|box|field))\b|under construction\W*$|^caption of image \d+\W*$")
_ADD = ("insert", "add ", "enter ", "type ", "write ", "put ", "under con", "caption")

_phrases = ahocorasick.Automaton()
for _kind, _of in (("said", SAID_IN), ("filler", FILLER_IN)):
    for _x in _of:
        _phrases.add_word(_x, _kind)
_phrases.make_automaton()


def slots(line: str) -> int:
    """Unfilled template slots of a line; a sentence that explains slots has none."""
    if not any(x in line for x in _SLOT_HINTS):
        return 0
    n = 0
    for m in SLOT.finditer(line):
        if _ESCAPED.match(line, m.start()):  # bytes of an encoded address
            continue
        start = max(line.rfind(". ", 0, m.start()), line.rfind("! ", 0, m.start()), line.rfind("? ", 0, m.start())) + 1
        end = min((x for x in (line.find(". ", m.end()), line.find("! ", m.end()), line.find("? ", m.end())) if x >= 0), default=len(line))
        if not ABOUT.search(line[start:end].replace(m[0], " ")):
            n += 1
    return n


def evidence(line: str) -> str | None:
    """'said' for an error or access message or a demand for browser features, 'filler' for text left to be replaced."""
    n = len(line)
    low = line.lower()
    for _, kind in _phrases.iter(low):
        return kind
    if n < 40 and (_ERROR_NO.match(low) or low.strip(" .:!") in FILLER_LINES):
        return "said" if low[-1].isdigit() or any(map(str.isdigit, low)) else "filler"
    if ("script" in low or "cookies" in low) and _SWITCH_ON.search(low) or any(x in low for x in _FOUND) and _NOT_FOUND.search(low):
        return "said"
    if n < 120 and low.startswith(_ADD) and _ADD_HERE.search(low):
        return "filler"
    return None


#: A sentence, or as much of one as may hold a message.
_PIECE = re.compile(r"\S.{0,398}?(?:[.!?…](?=\s|$)|$)\s*|\S.{0,398}(?:\s+|$)|\S{1,400}")


def evident(line: str, most: int = 400) -> tuple[str | None, int]:
    """(kind of evidence, its characters). A line of up to ``most`` characters is evidence as a whole; of a longer one
    the sentences are that have it, and its beginning up to ``most`` characters where it opens with one."""
    what = evidence(line)
    if what is None or len(line) <= most:
        return what, len(line) if what else 0
    sums = {"said": 0, "filler": 0}
    opening = None
    for m in _PIECE.finditer(line):
        kind = evidence(m[0].strip())
        if m.start() == 0:
            opening = kind
        if kind or opening and m.end() <= most:
            sums[kind or opening] += len(m[0])
    what = max(sums, key=lambda k: sums[k])
    return (what, sum(sums.values())) if sums[what] else (None, 0)


#: Parts of the wordings above that a text must hold in lower case for any line to be looked at.
_HINTS = ("script", "cookies", "construction", "caption of image", *_FOUND)
_hints = ahocorasick.Automaton()
for _x in {*SAID_IN, *FILLER_IN, *_HINTS, *(x.strip() for x in ("error", "fehler", "erreur", "errore", "erro", "fout", "błąd", "ошибка")), *FILLER_LINES, *(f"\n{x}" for x in _ADD)}:
    _hints.add_word(_x, 1)
_hints.make_automaton()


_EDGES = re.compile(r"\n\s+")


def hinted(text: str, low: str | None = None) -> bool:
    """Whether any line of a text, cleaned of invisible characters, can be evidence or have a slot; those without need no
    look at single lines. ``low`` is the text in lower case where it is at hand."""
    if any(x in text for x in _SLOT_HINTS):
        return True
    return next(_hints.iter(_EDGES.sub("\n", f"\n{text.lower() if low is None else low}")), None) is not None


def monotone(counts: Counter, total: int) -> bool:
    """Whether a text says one or two things over and over, as typed filler does."""
    return total >= 8 and len(counts) <= 2 + 0.15 * total and sum(n for _, n in counts.most_common(2)) >= 0.85 * total


def pseudo(counts: Counter, n: int, hits: int, top: float, pair: float, closed: int, lines: int) -> bool:
    """Whether sentences are put together from the words of no language: closed like prose, but with few of any
    language's common words, and without a word or phrase that stands out; in a short text four times is not often."""
    return closed >= 0.6 * lines and len(counts) >= 12 and hits < 0.25 * n and top < max(0.12, 5.5 / n) and pair < max(0.06, 2.5 / n)


_CLOSING = frozenset(".!?…”»\"'")


class Seen:
    """What a page says about itself, line by line and as a whole."""

    def __init__(self, text: str | None, words: Lexicon):
        size = dict.fromkeys((PROSE, NOTE, LINK, TAGS, LIST, TABLE, JUNK), 0)
        #: (line number, characters, form, evidence in it, slots) of each non-blank line
        self.lines: list[tuple[int, int, str, int, int]] = []
        body: list[str] = []
        closed = told = self.said = self.filler = self.slots = self.said_lines = 0
        #: the cleaned text, also in lower case, and the numbers of its notices
        self.text = text = clean(text) if text else text
        self.low = text.lower() if text else text
        self.notices: set[int] = set()
        look = text is not None and hinted(text, self.low)
        for no, line, kind in parts(text):
            if kind == NOTE:
                self.notices.add(no)
            n, what, here, holes = len(line), None, 0, 0
            if look:
                # whether messages make up most of the page is judged once its host's recurrent lines are known, not here
                what, here = evident(line)
                if what and kind in (PROSE, NOTE, LIST, JUNK):
                    if here > 0.5 * n:
                        kind = PROSE
                        self.said_lines += 1
                    if kind == PROSE:
                        told += here
                holes = slots(line)
                self.slots += holes
            size[kind] += n
            self.lines.append((no, n, kind, here, holes))
            if kind == NOTE:
                continue
            if what == "said":
                self.said += here
            elif what == "filler":
                self.filler += here
            closed += line[-1] in _CLOSING
            body.append(line)
        self.size, self.whole = size, "\n".join(body)
        tokens = words_of(self.whole.lower())
        counts = Counter(tokens)
        n, lines = len(tokens), len(body)
        lang, hits, top = words.of(tokens, counts)
        share = top / n if n else 0.0
        pair = Counter(zip(tokens, tokens[1:])).most_common(1)[0][1] / n if n > 30 and share >= 0.04 else 0.0
        self.n, self.counts, self.lang, self.hits, self.share, self.pair, self.tokens = n, counts, lang, hits, share, pair, tokens
        self.closed = closed / lines if lines else 0.0
        #: sentences of no language, or one thing over and over: all prose of the page is filler
        self.faked = False
        if size[PROSE] - told > 0.5 * len(self.whole) and n >= 8:
            self.faked = monotone(counts, n)
            if not self.faked and n >= 20 and pseudo(counts, n, hits, share, pair, closed, lines):
                odd = int((np.frombuffer(self.whole.encode("utf-32-le", "surrogatepass"), np.uint32) > 127).sum())
                self.faked = odd < 0.02 * len(self.whole)
        if self.faked:
            self.filler += size[PROSE] - told


def unsuspicious(text: str, words: Lexicon) -> bool:
    """Whether a text surely holds no evidence: none of its lines can, and its words, notices aside, are those of a language
    and not always the same. What this says no to is looked at closely."""
    text = clean(text)
    if hinted(text):
        return False
    body = [low for x in text.lower().split("\n") if (low := x.strip()) and not notice(low)]
    whole = "\n".join(body)
    tokens = words_of(whole)
    n = len(tokens)
    if n < 8:
        return True
    # beyond some characters outside ASCII sentences of no language are not told from garbled ones, as in Seen
    foreign = not whole.isascii() and len(whole) - len(whole.encode("ascii", "ignore")) >= 0.02 * len(whole) + 1
    return len(set(tokens)) > 2 + 0.15 * n and (foreign or words.share(tokens) >= 0.25)


_BLANK_BYTES, _DIGIT_BYTES, _UPPER_BYTES = bytes(range(33)), bytes(range(48, 58)), bytes(range(65, 91))


def profile(record_id: str, text: str | None, words: Lexicon, seen: Seen | None = None) -> dict:
    """The profile of a text; ``seen`` where it is at hand."""
    p = Seen(text, words) if seen is None else seen
    n, whole, size = p.n, p.whole, p.size
    letters = sum(map(len, p.tokens))
    # a byte of UTF-8 below 128 is always a character of its own
    raw = whole.encode("utf-8", "surrogatepass")
    solid = max(1, len(whole) - len(raw) + len(raw.translate(None, _BLANK_BYTES)))
    digits = len(raw) - len(raw.translate(None, _DIGIT_BYTES))
    upper = len(raw) - len(raw.translate(None, _UPPER_BYTES))
    if b"\xd0" in raw:
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        upper += int(((codes >= 0x410) & (codes <= 0x42F)).sum())
    return {
        "record_id": record_id,
        "lang": p.lang,
        "n_words": n,
        "n_types": len(p.counts),
        "curve": [{"f": f, "m": m} for f, m in sorted(Counter(p.counts.values()).items(), reverse=True)],
        "top_word": p.share,
        "top_pair": p.pair,
        "common": p.hits / n if n else 0.0,
        "chars": len(whole),
        "note": size[NOTE], "link": size[LINK], "tags": size[TAGS], "list": size[LIST], "table": size[TABLE], "junk": size[JUNK], "prose": size[PROSE],
        "word_len": letters / n if n else 0.0,
        "symbols": max(0.0, 1 - (letters + digits) / solid) if whole else 0.0,
        "closed": p.closed,
        "digits": digits / solid if whole else 0.0,
        "upper": upper / solid if whole else 0.0,
        "slots": p.slots, "said": p.said, "filler": p.filler, "said_lines": p.said_lines,
    }


def page_profiles(corpus: DataFrame, words_table: DataFrame, text: str = "text", record: str = "record_id") -> DataFrame:
    """The profile of each record; see SCHEMA. One Arrow pass, no shuffle."""
    words = Lexicon(common_words(words_table))
    rows = corpus.where(F.col(record).isNotNull()).select(F.col(record).alias("record_id"), F.col(text).alias("text"))
    return rows.mapInArrow(batches(lambda batch: [profile(r["record_id"], r["text"], words) for r in batch], ARROW), SCHEMA)
