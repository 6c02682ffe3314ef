"""Problem 10: personal information inside free text, found and replaced by typed surrogates.

Finding: e-mail addresses, phone numbers, identity numbers and street addresses by their notation and the words before
them; names of persons by a lexicon that is learned from the corpus itself. Pairs of capitalised words are counted over
all documents; given names and family names are the two sides of the pairs that combine freely with one another,
unlike places and firms. Words of common use are no names. Wording that introduces a person is accepted for names that
the lexicon doesn't have.

Replacing: every word of a name has a surrogate made from a keyed hash of its normal form, and every other entity one of
its own, so it is the same wherever the entity comes (coreference) without any shared state. First letters are
exchanged by a keyed permutation of the alphabet, so "J. Smith" and "John Smith" keep a common initial; given names keep
their gender as far as titles in the corpus or their ending tell it; script, letter case and the pattern of digits
stay. Within a document no two words and no two entities share a surrogate: a later one in order of the text is hashed
again. The placeholder names the type: ``[NAME Tova Brelden]``. Found pieces come from the same pass.

Defined results: null and empty texts have nothing to find and stay as they are; of overlapping findings the first
kind in the order e-mail, address, identity number, phone, name stands.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.textkit import batches, common_words
from corpusmill.plans.shared import materialize

_DOT = r"(?:\.|\s?[(\[{]\s?dot\s?[)\]}]\s?|(?-i: DOT ))"
_AT = r"(?:\s?[@＠]\s?|\s?[(\[{]\s?at\s?[)\]}]\s?|(?-i: AT ))"
EMAIL = re.compile(rf"(?<![\w.+-])[\w+-]+(?:{_DOT}[\w+-]+)*{_AT}[\w-]+(?:{_DOT}[\w-]+)*{_DOT}[^\W\d_]{{2,}}(?![\w@])|(?<![\w.+-])[\w.+-]+ at [\w-]+(?: dot [\w-]+)+(?!\w)", re.I)

#: Kinds of streets, by where they stand: after the name, before it with the number first, at the end of a word, before it with the number last.
_STREET_EN = "Street|St|Road|Rd|Lane|Ln|Avenue|Ave|Close|Row|Bank|Drive|Dr|Court|Ct|Place|Pl|Square|Sq|Way|Hill|Gate|Terrace|Crescent|Gardens|Grove|Mews|Quay|Walk|Boulevard|Blvd|Highway|Parade|Green"
_STREET_FR = "rue|avenue|av\\.|place|quai|boulevard|bd|chemin|allée|impasse|cours|route|square|passage|faubourg|sentier|ruelle|esplanade"
_STREET_DE = "straße|strasse|str\\.|weg|allee|platz|gasse|ufer|damm|ring|hof|graben|steig|chaussee|markt|straat|laan|plein|gracht|kade|dijk|steeg|singel|pad"
_STREET_ES = "Calle|C/|Paseo|Plaza|Avenida|Avda\\.|Camino|Ronda|Travesía|Carrera|Cuesta|Via|Viale|Piazza|Piazzale|Corso|Vicolo|Largo|Strada|Rua|Praça|Travessa|Estrada|Alameda|Beco|ul\\.|ulica|al\\.|aleja|pl\\.|plac|ул\\.|улица|пр\\.|проспект|пер\\.|переулок"
_CAP = r"[A-ZÀ-ÖØ-ÞĄĆĘŁŃÓŚŹŻА-ЯЁ]"
_NUMBER = re.compile(r"(?<![\w.,/-])\d{1,5}(?![\d])")
_EN_ON = re.compile(rf"\d{{1,5}}(?:\s?[A-Za-z])?(?:\s?[-/]\s?\d+)?,?\s(?:[NSEW]\.\s)?(?:{_CAP}[\w'’-]*\s){{1,3}}(?i:{_STREET_EN})(?![\w'’])")
_FR_ON = re.compile(rf"\d{{1,5}}(?:\s?(?:bis|ter|quater|[A-Z]))?,?\s(?i:{_STREET_FR})\s(?i:de la |de l['’]|des |du |de |d['’]|la |le |les |l['’])?{_CAP}[\w'’-]*(?:[\s-](?:(?:de|du|des|la|le)\s)?{_CAP}[\w'’-]*){{0,3}}")
_DE_BACK = re.compile(rf"{_CAP}[\wäöüß'’-]*(?i:{_STREET_DE})\s$")
_ES_BACK = re.compile(rf"(?<!\w)(?i:{_STREET_ES})\s(?i:(?:de las|de los|de la|del|della|delle|dei|degli|dell['’]|das|dos|da|do|de|di)\s?)?{_CAP}?[\w'’-]+(?:\s(?:(?:de|del|la|da|do|di|y|e)\s)?{_CAP}[\w'’-]*){{0,3}},?\s(?:n[.ºo°]{{1,3}}\s?|núm\.\s?|nr\.?\s?|д\.\s?)?$")
_FLAT = re.compile(r"(?:Flat|Apt\.?|Apartment|Unit|Suite|Wohnung|Whg\.?|App(?:t|artement)?\.?|Piso|Apto\.?|Int(?:erno)?\.?)\s(?:n[°º.]\s?)?\d+\s?[A-Za-z]?,\s$", re.I)
#: What may follow: a flat and the place with its code, which belong to the address.
_REST = re.compile(rf"(?:,\s(?i:Flat|Apt\.?|Unit|Wohnung|appt\.?|piso)\s?\d+\w?|,\s\d{{1,2}}\.º\s\w)?(?:(?:,\s|\n)(?:\d{{4,5}}\s)?{_CAP}[\w'’-]+(?: {_CAP}[\w'’-]+)?(?: \d{{4,5}})?(?=[.,;\n]|\s[a-z]|$))?")
_street_hints = ahocorasick.Automaton()
for _x in "calle |c/|paseo |plaza |avenida |avda. |camino |ronda |travesía |carrera |cuesta |via |viale |piazza |piazzale |corso |vicolo |largo |strada |rua |praça |travessa |estrada |alameda |beco |ul. |ulica |al. |aleja |pl. |plac |ул. |улица |пр. |проспект |пер. |переулок ".split("|"):
    _street_hints.add_word(_x, 1)
_street_hints.make_automaton()

#: Words that say that an identity number follows, and words that say that another number does.
ID_WORD = re.compile(
    r"\b(?:passports?|passeports?|pasaportes?|passaport[oei]s?|paspoort|reisepass\w*|paszport\w*|паспорт\w*|(?:personal)?ausweis\w*|identity cards?|identity number|id card|social security number|ssn|(?:national )?insurance number|versicherungsnummer|sozialversicherung\w*|rentenversicherung\w*|sécurité sociale|carte d['’]identité|documento de identidad|documento d['’]identità|carta d['’]identità|seguridad social|dni|nie|nif|codice fiscale|tessera sanitaria|cartão de cidadão|bilhete de identidade|segurança social|contribuinte|bsn|burgerservicenummer|identiteitskaart|identiteitsbewijs|rijksregisternummer|sofinummer|pesel|dowód osobisty|dowodu osobistego|снилс|инн|tax (?:file |identification )?number|tax id|steuer(?:identifikations)?nummer|steuer-id|numéro fiscal|numéro d['’]identité|número fiscal|id)\b(?:[ :#.(№]|n[°º]|nr\.?|no\.?|number|nummer|lautet|lauten|ist|is|est|es|el|è|é|o|il|le|la|numero|número|numer|номер|hat die|has the|,){0,8}?[ :(]*$",
    re.I,
)
ID_SHAPE = re.compile(r"(?<![\w])(?:[A-Z]{1,3}[ -]?)?\d[\dA-Z]*(?:[ .\-/](?:\d[\dA-Z]*|[A-Z](?![\w'’])))*")
NO_PHONE = re.compile(
    r"\b(?:order|article|artikel\w*|ticket|ref(?:erence)?|book|isbn|issn|commande|pedido|bestell\w*|rechnung\w*|invoice|facture|factura|fattura|ordine|encomenda|bestelling|zamówieni\w*|form|formular\w*|formulaire|server|iban|konto\w*|account|serial|patent|seri\w*|model|art\.?|item|lot|version|from|until|заказ\w*|артикул\w*)\b[^\n.;]{0,24}$",
    re.I,
)
_D = r"[ .\-/]?\d"
PHONE = re.compile(
    "|".join(
        (
            rf"\(?\+\d{{1,3}}\)?[ .\-/]?(?:\(0\)[ ]?)?(?:\(\d{{2,4}}\)[ .\-/]?)?\d(?:{_D}){{5,13}}(?:\s?(?:ext|x|app|poste)\.?\s?\d{{1,5}})?",
            rf"\(\d{{2,5}}\)[ .\-/]?\d(?:{_D}){{4,11}}(?:\s?(?:ext|x)\.?\s?\d{{1,5}})?",
            rf"00\d{{2}}[ .\-]?(?:\(0\)[ ]?)?\d(?:{_D}){{6,12}}",
            r"(?:1[\-. ])?\d{3}[\-. ]\d{3}[\-. ]\d{4}(?:\s?(?:ext|x)\.?\s?\d{1,5})?",
            rf"0\d(?:{_D}){{7,11}}",
            r"[2-9]\d{9}(?!\d)",
            r"[5-9]\d{2}[ \-.]?\d{2,3}[ \-.]?\d{2,3}(?:[ \-.]?\d{2})?(?!\d)",
        )
    )
)
_LONG = re.compile(r"[(+]{0,2}\d(?:[ .\-/()]{0,2}[\dA-Z]){5}")
PHONE_WORD = re.compile(r"\b(?:tel|tél|phone|telephone|telefon\w*|teléfono|téléphone|telefone|telefoon|mobile|mobil|handy|cell|fax|call|ring|reach|number is|joindre|appel\w*|llamar|llame|chiam\w*|telefonare|ligue|ligar|bel|bellen|anruf\w*|zadzwoń|dzwonić|тел|телефон\w*|звон\w*)\b[^\n]{0,60}$", re.I)

_WORD = re.compile(rf"{_CAP}[\w'’]*(?:-{_CAP}[\w'’]*)*")
_CUE = re.compile(
    r"(?:\b(?:I am|I'm|My name is|Je m['’]appelle|Je suis|Ich heiße|Mein Name ist|Me llamo|Mi nombre es|Mi chiamo|Ik heet|Mijn naam is|Chamo-me|O meu nome é|Nazywam się|Меня зовут"
    r"|You can reach|pouvez joindre|belongs to|gehört|appartient à|pertence a|è di|is van|sagte|ask for|the form to|llamar a|wenden Sie sich an|contact op met|Ansprechpartner(?:in)?:|Contact:|Kontakt:)\s)"
    rf"((?:{_CAP}[^\W\d_]+(?:-{_CAP}[^\W\d_]+)*\s(?:{_CAP}\.\s)?{_CAP}[^\W\d_]{{2,}}(?:-{_CAP}[^\W\d_]+)*)|(?:{_CAP}[^\W\d_]{{2,}}(?:-{_CAP}[^\W\d_]+)*,\s{_CAP}[^\W\d_]+)|(?:{_CAP}\.\s{_CAP}[^\W\d_]{{2,}}(?:-{_CAP}[^\W\d_]+)*))"
)
_cues = ahocorasick.Automaton()
for _x in "I am |I'm |name is|m'appelle|m’appelle|Je suis|heiße|Name ist|llamo|nombre es|chiamo|heet|naam is|Chamo-me|nome é|Nazywam|зовут|reach|joindre|belongs|gehört|appartient|pertence| è di | is van |sagte|ask for|form to|llamar a|wenden Sie|contact op|partner|Contact:|Kontakt:".split("|"):
    _cues.add_word(_x, 1)
_cues.make_automaton()
_NO_NAME = frozenset("street road lane avenue close row bank foundation prize brothers ltd gmbh sons company stiftung university school".split())


# --- the lexicon of names --------------------------------------------------------------------------------------------


def name_tables(documents: DataFrame, words_table: DataFrame, text: str = "text", partners: int = 3) -> tuple[DataFrame, DataFrame]:
    """((w, g), (w)): all given names with their gender, f, m or null, and all family names, in lower case.

    Counts are over all documents and combined before each shuffle.
    """
    common = sorted(common_words(words_table))
    word = r"\p{Lu}\p{Ll}[\p{L}'’]*(?:-\p{Lu}[\p{L}'’]*)?"
    row = rf"(?<![\p{{L}}\p{{N}}.'’-]){word}(?: (?:\p{{Lu}}[.] )?{word})+(?![\p{{L}}\p{{N}}])"
    found = documents.select(F.explode(F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(row), F.lit(0)))).alias("p"))
    found = found.groupBy("p").agg(F.count("*").alias("n"))  # few different ones, combined on the map side
    words = F.filter(F.split(F.lower("p"), " "), lambda w: ~F.endswith(w, F.lit(".")))
    found = found.select(words.alias("w"), "n").where("size(w) > 1")
    found = found.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.struct(F.element_at("w", i).alias("a"), F.element_at("w", i + 1).alias("b")))).alias("s"), "n")
    known = documents.sparkSession.createDataFrame([(w,) for w in common], "w string")
    pairs = found.select("s.a", "s.b", "n").where(F.length("b") > 2)
    every = materialize(pairs.groupBy("a", "b").agg(F.sum("n").alias("n")), "word-pairs")
    pairs = every.join(F.broadcast(known), F.col("a") == F.col("w"), "left_anti").join(F.broadcast(known), F.col("b") == F.col("w"), "left_anti")

    def side(of: DataFrame, one: str, other: str) -> DataFrame:
        return of.groupBy(one).agg(F.count("*").alias("k")).where(F.col("k") >= partners)

    family = side(pairs, "b", "a").select("b")
    given = side(pairs.join(family, "b", "left_semi"), "a", "b").select("a")
    family = side(pairs.join(given, "a", "left_semi"), "b", "a").select(F.col("b").alias("w"))
    # titles before a given name vote for its gender
    title = F.when(F.col("a").isin(*TITLES["f"]), 1).when(F.col("a").isin(*TITLES["m"]), -1)
    votes = every.where(F.col("a").isin(*TITLES["f"], *TITLES["m"])).groupBy("b").agg(F.sum(title * F.col("n")).alias("v"))
    given = given.join(votes, F.col("a") == F.col("b"), "left").select(F.col("a").alias("w"), F.when(F.col("v") > 0, "f").when(F.col("v") < 0, "m").alias("g"))
    return materialize(given, "given-names"), materialize(family, "family-names")


#: Titles before names that tell a gender, lower case.
TITLES = {
    "f": ["mrs", "ms", "miss", "madam", "lady", "sister", "frau", "madame", "mademoiselle", "mme", "mlle", "señora", "señorita", "doña", "signora", "signorina", "senhora", "dona", "mevrouw", "pani", "госпожа"],
    "m": ["mr", "sir", "lord", "brother", "herr", "herrn", "monsieur", "señor", "don", "signor", "signore", "senhor", "meneer", "heer", "pan", "pana", "господин"],
}


class Lexicon:
    """Given and family names, and the genders that are known of given names."""

    def __init__(self, given: Iterable[str], family: Iterable[str], genders: dict[str, str] | None = None):
        self.given, self.family, self.genders = frozenset(given), frozenset(family), genders or {}


def with_names(documents: DataFrame, words_table: DataFrame, doc: str, text: str, lexicon: Lexicon | None = None, most: int = 200_000) -> tuple[DataFrame, Lexicon | None]:
    """((doc_id, text, names), lexicon): the documents, and the names either as a lexicon for all tasks or, where it has
    more than ``most`` names of a kind, as an array of the names in each document (w, g, given) from a join; nothing is
    cut, both ways find the same."""
    rows = documents.where(F.col(doc).isNotNull()).select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    none = F.lit(None).cast("array<struct<w:string,g:string,given:boolean>>")
    if lexicon is not None:
        return rows.withColumn("names", none), lexicon
    given, family = name_tables(documents, words_table, text)
    few = [t.limit(most + 1).collect() for t in (given, family)]
    if max(map(len, few)) <= most:
        return rows.withColumn("names", none), Lexicon((r["w"] for r in few[0]), (r["w"] for r in few[1]), {r["w"]: r["g"] for r in few[0] if r["g"]})
    names = given.select("w", "g", F.lit(True).alias("given")).unionByName(family.select("w", F.lit(None).cast("string").alias("g"), F.lit(False).alias("given")))
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}[\p{L}\p{N}_'’]*(?:-\p{L}[\p{L}\p{N}_'’]*)*"), F.lit(0))
    each = rows.select("doc_id", F.explode(F.array_distinct(F.flatten(F.array(words, F.split(F.concat_ws("-", words), "-"))))).alias("w"))
    held = each.join(names, "w").groupBy("doc_id").agg(F.collect_set(F.struct("w", "g", "given")).alias("names"))  # at most the words of a document
    return rows.join(held, "doc_id", "left"), None


def _lexicon_of(row: dict, shared: Lexicon | None) -> Lexicon:
    if shared is not None:
        return shared
    names = row["names"] or []
    return Lexicon((x["w"] for x in names if x["given"]), (x["w"] for x in names if not x["given"]), {x["w"]: x["g"] for x in names if x["g"]})


# --- finding ---------------------------------------------------------------------------------------------------------


def _is_given(word: str, given: frozenset) -> bool:
    low = word.lower()
    return low in given or "-" in low and all(p in given for p in low.split("-"))


def names_in(text: str, given: frozenset, family: frozenset) -> list[tuple[int, int]]:
    words = [(m.start(), m.end(), m[0]) for m in _WORD.finditer(text)]
    out: list[tuple[int, int]] = []
    n = len(words)
    for i, (start, end, word) in enumerate(words):
        if word.lower() not in family:
            continue
        if text[end : end + 1] in ("@", "＠", "+") or text[start - 1 : start] in ("@", "＠", ".", "+", "_") and text[start - 2 : start - 1] != " " and not text[max(0, start - 2) : start].isspace():
            continue
        begin = None
        # given name or initial before it, with further initials between
        j, at = i - 1, start
        while j >= 0 and i - j <= 4:
            a, b, w = words[j]
            gap = text[b:at]
            if len(w) == 1 and gap in (". ", ".\u00a0", ".\n"):
                begin, at = a, a
                j -= 1
                continue
            if gap in (" ", "\u00a0", "\n", "  ") and _is_given(w, given):
                begin, at = a, a
                break
            break
        if begin is not None:
            out.append((begin, end))
            continue
        # family name first, a comma, the given name
        if i + 1 < n:
            a, b, w = words[i + 1]
            if text[end:a] in (", ", ",\u00a0") and (_is_given(w, given) or len(w) == 1 and text[b : b + 1] == "."):
                out.append((start, b if len(w) > 1 else b + 1))
            elif text[end:a] in (" ", "\u00a0") and _is_given(w, given) and not (i + 2 < n and words[i + 2][2].lower() in family and text[b : words[i + 2][0]] in (" ", "\u00a0")):
                out.append((start, b))
    return out


def find(text: str | None, given: frozenset, family: frozenset) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pieces of personal information in a text, in order."""
    if not text:
        return []
    out: list[tuple[int, int, str]] = []
    taken = bytearray(len(text))

    def add(start: int, end: int, kind: str) -> None:
        if 1 not in taken[start:end]:
            taken[start:end] = b"\x01" * (end - start)
            out.append((start, end, kind))

    if "@" in text or "＠" in text or " AT " in text or "at)" in text or "at]" in text or "at}" in text or " dot " in text:
        for m in EMAIL.finditer(text):
            piece = m[0]
            # the words at and dot count as signs only in capitals or brackets
            if "@" not in piece and "＠" not in piece and not re.search(r"[(\[{]\s?at\s?[)\]}]", piece, re.I) and " AT " not in piece and " dot " not in piece:
                continue
            add(m.start(), m.end(), "email")
    southern = None
    for m in _NUMBER.finditer(text):
        start = m.start()
        before = text[max(0, start - 80) : start]
        p = _EN_ON.match(text, start) or _FR_ON.match(text, start)
        begin, end = start, p.end() if p else m.end()
        if p is None and text[start - 1 : start] in " ºo.°":
            q = _DE_BACK.search(before[-40:])
            if q is not None:
                begin = start - len(before[-40:]) + q.start()
            else:
                if southern is None:
                    southern = next(_street_hints.iter(text.lower()), None) is not None
                q = _ES_BACK.search(before) if southern else None
                if q is None:
                    continue
                begin = start - len(before) + q.start()
            if re.match(r"\s?[a-zA-Z](?!\w)", text[end : end + 3]):
                end = end + re.match(r"\s?[a-zA-Z](?!\w)", text[end : end + 3]).end()
        elif p is None:
            continue
        flat = _FLAT.search(text[max(0, begin - 30) : begin])
        if flat:
            begin -= len(flat[0])
        rest = _REST.match(text, end)
        add(begin, rest.end() if rest else end, "address")
    seen = -1
    for m in _LONG.finditer(text):
        start = m.start()
        if start < seen or start and (text[start - 1].isalnum() and not (text[start - 1].isupper() and text[start].isdigit()) or text[start - 1] in ".,@#/+-" and text[start - 2 : start - 1].isalnum()):
            continue
        line = text.rfind("\n", 0, start) + 1
        before = text[max(line, start - 70) : start]
        # letters of an identity number may stand before its first digit, so the word is sought before them
        lead = re.search(r"(?:^|[\s(])([A-Z]{1,3}[ -]?)$", before)
        done = False
        for cut in (before[: lead.start(1)] if lead else None, before):
            if cut is None or not ID_WORD.search(cut):
                continue
            at = start - (len(before) - len(cut))
            p = ID_SHAPE.match(text, at + (text[at] == "("))
            if p and sum(map(str.isdigit, p[0])) >= 5:
                add(p.start(), p.end(), "id_number")
                seen = p.end()
                done = True
            break
        if done or start and text[start - 1].isalnum():
            continue
        p = PHONE.match(text, start)
        if p is None or not 8 <= sum(map(str.isdigit, p[0])) <= 18 or text[p.end() : p.end() + 1].isalnum() or re.match(r"[.\-/,]\d", text[p.end() : p.end() + 2]):
            continue
        bare = before.strip() == ""
        shaped = p[0][0] in "+(0" or re.search(r"\d[ .\-]\d", p[0]) is not None or len(p[0]) == 10
        if PHONE_WORD.search(before) or (shaped if bare else not NO_PHONE.search(before)):
            add(p.start(), p.end(), "phone")
            seen = p.end()
    for a, b in names_in(text, given, family):
        add(a, b, "name")
    for m in _CUE.finditer(text) if next(_cues.iter(text), None) is not None else ():
        words = re.split(r"[\s,]+", m[1])
        if not any(w.lower() in _NO_NAME for w in words):
            add(m.start(1), m.end(1), "name")
    out.sort()
    return out


# --- surrogates ------------------------------------------------------------------------------------------------------

_ONSETS = "b br c d dr f g gl h j k kl l m n p pr r s st t tr v w z".split()
_NUCLEI = "a e i o u".split()
_CODAS = ["", "l", "n", "r", "s"]
_CYRILLIC = str.maketrans("abcdefghijklmnoprstuvwz", "абцдефгхийклмнопрстувуз")


def normal_form(piece: str, kind: str) -> str:
    """What two mentions of one entity have in common."""
    if kind == "name":
        last, comma, first = piece.partition(",")
        if comma:
            piece = f"{first.strip()} {last}"
        piece = unicodedata.normalize("NFKD", piece)
        return " ".join("".join(c for c in piece if not unicodedata.combining(c)).lower().split())
    if kind == "email":
        low = re.sub(r"\s?[(\[{]\s?(at|dot)\s?[)\]}]\s?", lambda m: "@" if m[1].lower() == "at" else ".", piece, flags=re.I)
        low = re.sub(r" at ", "@", re.sub(r" dot ", ".", low, flags=re.I), flags=re.I)
        return re.sub(r"\s", "", low.replace("＠", "@").lower())
    if kind in ("phone", "id_number"):
        return re.sub(r"[^\dA-Z]", "", piece.upper())
    return " ".join(piece.lower().split())


_LATIN = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_CYRILLIC_FIRST = "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"


class Surrogates:
    """Replacements from a secret key, for all documents alike."""

    def __init__(self, key: bytes):
        if not key:
            raise ValueError("surrogates need a secret key")
        self.key = key
        self.first = {letters: self._permuted(letters) for letters in (_LATIN, _CYRILLIC_FIRST)}

    def stream(self, kind: str, entity: str, turn: int) -> Iterator[int]:
        block = 0
        while True:
            digest = hashlib.blake2b(f"{kind}|{entity}|{turn}|{block}".encode(), key=self.key[:64], digest_size=32).digest()
            yield from digest
            block += 1

    def _permuted(self, letters: str) -> dict[str, str]:
        bits, to = self.stream("letters", letters, 0), list(letters)
        for i in range(len(to) - 1, 0, -1):
            j = (next(bits) << 8 | next(bits)) % (i + 1)
            to[i], to[j] = to[j], to[i]
        return dict(zip(letters, to))

    def initial(self, word: str) -> str:
        """The first letter of the surrogates of all words that begin like this one."""
        c = unicodedata.normalize("NFKD", word[:1].upper())[:1]
        for to in self.first.values():
            if c in to:
                return to[c]
        return _LATIN[next(self.stream("letter", c, 0)) % 26]

    def syllable(self, bits: Iterator[int], onset: bool = True) -> str:
        return (_ONSETS[next(bits) % len(_ONSETS)] if onset else "") + _NUCLEI[next(bits) % 5] + _CODAS[next(bits) % 5]

    def word(self, like: str, turn: int = 0, gender: str | None = None) -> str:
        """A surrogate of a word of a name, with its script and case; ``gender`` sets how a given name ends."""
        bits = self.stream("word", normal_form(like, "name"), turn)
        first = self.initial(like).lower()
        out = first + ("" if first in "aeiouаеиоэюя" else self.syllable(bits, onset=False))
        out += "".join(self.syllable(bits) for _ in range(1 if len(like) < 9 else 2))
        vowel = out[-1] in "aeiou"
        if gender == "f":
            out = (out[:-1] if vowel else out) + "a"
        elif gender == "m":
            out += "lnrs"[next(bits) % 4] if vowel else ""
        if re.search("[а-яё]", like.lower()):
            out = out.translate(_CYRILLIC)
        return out.upper() if like.isupper() and len(like) > 1 else out.capitalize() if like[:1].isupper() else out

    def code(self, kind: str, piece: str, turn: int = 0) -> str:
        """A surrogate of anything but a name, in its format."""
        entity = normal_form(piece, kind)
        bits = self.stream(kind, entity, turn)
        if kind == "email":
            host = ("example.com", "example.org", "example.net")[next(bits) % 3]
            return "".join(self.syllable(bits) for _ in range(2)) + "." + "".join(self.syllable(bits) for _ in range(2)) + "@" + host
        if kind in ("phone", "id_number"):
            return "".join(str(next(bits) % 10) if c.isdigit() else chr(65 + next(bits) % 26) if kind == "id_number" and c.isupper() else c for c in piece)
        return re.sub(r"[^\W\d_]{4,}|\d", lambda m: str(1 + next(bits) % 9) if m[0].isdigit() else self.word(m[0], next(bits)), piece)


def gender_of(word: str, genders: dict[str, str]) -> str | None:
    """What titles in the corpus say, or else the ending: -a is that of women's names in the nine languages, a consonant or
    -o that of men's more often than not; others tell nothing."""
    low = normal_form(word, "name")
    told = genders.get(word.lower()) or genders.get(low)
    return told or ("f" if low[-1:] in "aа" else "m" if low[-1:] not in "aeiouyаеиоуыэюя" or low[-1:] == "o" else None)


class Page:
    """The surrogates of one document: distinct ones for distinct words and entities, the same for the same."""

    def __init__(self, maker: Surrogates, genders: dict[str, str]):
        self.maker, self.genders = maker, genders
        self.words: dict[str, int] = {}
        self.codes: dict[tuple[str, str], str] = {}
        self.used: dict[str, str] = {}

    def word(self, word: str, given: bool) -> str:
        form = normal_form(word, "name")
        gender = gender_of(word, self.genders) if given else None
        turn = self.words.get(form, 0)
        while True:
            made = self.maker.word(word, turn, gender)
            low = made.lower()
            if low != word.lower() and self.used.setdefault(low, form) == form:
                self.words[form] = turn
                return made
            turn += 1

    def name(self, piece: str) -> str:
        parts = re.split(r"(\.?,?\s+|\.?-|\.$)", piece)
        words = [i for i, w in enumerate(parts) if w and w[0].isalnum()]
        # the family name stands first before a comma, and last otherwise; a double name is one
        comma = next((i for i, w in enumerate(parts) if "," in w), None)
        blanks = [i for i, w in enumerate(parts) if w.isspace() or w[:1] == "." and w.strip(".").isspace()]
        family = [i for i in words if i < comma] if comma is not None else [i for i in words if not blanks or i > blanks[-1]]
        out = list(parts)
        for i in words:
            out[i] = self.maker.initial(parts[i]) if len(parts[i]) == 1 else self.word(parts[i], i not in family)
        return "".join(out)

    def replace(self, piece: str, kind: str) -> str:
        if kind == "name":
            return self.name(piece)
        entity = (kind, normal_form(piece, kind))
        if entity not in self.codes:
            turn = 0
            while True:
                made = self.maker.code(kind, piece, turn)
                if made != piece and self.used.setdefault(made.lower(), str(entity)) == str(entity):
                    break
                turn += 1
            self.codes[entity] = made
        return self.codes[entity]


def redact(text: str, pieces: list[tuple[int, int, str]], maker: Surrogates, genders: dict[str, str] | None = None) -> tuple[str, list[str]]:
    """The text with every piece replaced by ``[KIND surrogate]``, what lies between staying as it is; and the surrogates."""
    page, out, made, at = Page(maker, genders or {}), [], [], 0
    for start, end, kind in pieces:
        made.append(page.replace(text[start:end], kind))
        out += [text[at:start], f"[{kind.upper()} {made[-1]}]"]
        at = end
    return "".join(out) + text[at:], made


def redacted(documents: DataFrame, words_table: DataFrame, key: str | bytes, doc: str = "doc_id", text: str = "text", lexicon: Lexicon | None = None) -> DataFrame:
    """(doc_id, text, pieces): each document with its personal information replaced by surrogates under the secret
    ``key``, and the pieces found, with their normal form and surrogate, in order of the text."""
    rows, shared = with_names(documents, words_table, doc, text, lexicon)
    piece = [("start_char", pa.int32()), ("end_char", pa.int32()), ("kind", pa.string()), ("entity", pa.string()), ("surrogate", pa.string())]
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("pieces", pa.list_(pa.struct(piece)))])
    maker = Surrogates(key.encode() if isinstance(key, str) else key)

    def run(batch: list[dict]) -> list[dict]:
        out = []
        for r in batch:
            names, text = _lexicon_of(r, shared), r["text"]
            found = find(text, names.given, names.family)
            new, made = redact(text, found, maker, names.genders) if found else (text, [])
            pieces = [{"start_char": a, "end_char": b, "kind": k, "entity": normal_form(text[a:b], k), "surrogate": x} for (a, b, k), x in zip(found, made)]
            out.append({"doc_id": r["doc_id"], "text": new, "pieces": pieces})
        return out

    return rows.mapInArrow(batches(run, schema), "doc_id long, text string, pieces array<struct<start_char:int,end_char:int,kind:string,entity:string,surrogate:string>>")


def entities(redacted_documents: DataFrame) -> DataFrame:
    """A row a piece of personal information: doc_id, start_char, end_char, kind, entity, surrogate."""
    return redacted_documents.select("doc_id", F.explode("pieces").alias("p")).select("doc_id", "p.*")


def coreference(found: DataFrame) -> DataFrame:
    """By kind: mentions, entities and surrogates by document, entities of a document that got more than one surrogate, and
    surrogates of a document that stand for more than one entity. Case and word order of names do not count."""
    plain = F.lower(F.when((F.col("kind") == "name") & F.contains("surrogate", F.lit(",")), F.regexp_replace("surrogate", r"^([^,]*),\s*(.*)$", "$2 $1")).otherwise(F.col("surrogate")))
    each = found.select("doc_id", "kind", F.xxhash64("entity").alias("e"), F.xxhash64(F.regexp_replace(plain, r"[\s\u00a0]+", " ")).alias("s"))
    pairs = each.groupBy("doc_id", "kind", "e", "s").agg(F.count("*").alias("mentions"))
    by_entity = pairs.groupBy("doc_id", "kind", "e").agg(F.sum("mentions").alias("mentions"), F.count("*").alias("k")).groupBy("kind").agg(F.sum("mentions").alias("mentions"), F.count("*").alias("entities"), F.sum((F.col("k") > 1).cast("int")).alias("split_entities"))
    by_surrogate = pairs.groupBy("doc_id", "kind", "s").agg(F.count("*").alias("k")).groupBy("kind").agg(F.count("*").alias("surrogates"), F.sum((F.col("k") > 1).cast("int")).alias("shared_surrogates"))
    return by_entity.join(by_surrogate, "kind")
