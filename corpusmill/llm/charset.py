"""Problem 3: garbled text from a wrong character encoding, found and restored.

Method: for each source the damage is a substitution cipher on symbols (see ``ciphers``). One pass takes from each text
the contexts of symbols that no language's letter bigrams account for; their counts by source go through EM, which
learns how the source's text was misread and which letter each symbol stands for. A record is found if one of its
contexts is much likelier under the learned rates than as it is written (``gain``); an exact check of signs follows, as
rare but correct characters of other languages are unlikely, too.

Restoring: UTF-8 read as a code page is undone exactly, run by run; symbols of one code page read as another are
replaced by the learned mapping of their source with translate(). Characters that were replaced by U+FFFD or question
marks can't be restored from the text; where warc_raw has the page's bytes, these are decoded by the code page under
which they read most like a language, and the line that fits what is left of the damaged one is taken.

Defined results: null and empty texts are sound; rare but correct characters are no damage; rows without a source are
one source; rows without an id are left out.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.ciphers import LOST, Bigrams, Judge, counted, learn
from corpusmill.llm.codepages import LETTERS, ONE_BYTE, bytes_of, misread, restore_utf8
from corpusmill.llm.textkit import batches
from corpusmill.plans.shared import materialize

_REPLACED = re.compile(r"[\ufffd\x80-\x9f]")
_IN_WORD = re.compile(r"[^\W\d_][¹²³±¶¸¼½¾¿¡£¥§¨¤¢¦¬¯´µ×÷‡†‰ˆ˜˘ˇ˝˛∂∑∏∫Ω√≈∆◊∞≤≥≠ˆ⌐╝╜╛╢╣║╗└┴├─┼╞╟╚╔╩╦╠═╬╧╨╤╥╙╘╒╓╫╪┘┌█▄▌▐▀░▒▓│┤╡╖╕¬][^\W\d_]")
_AFTER_WORD = re.compile(r"[^\W\d_]{3}[¹³±¶¸¼¾¿¡£¥¤¢¦¬¯´‡†ˆ˜˘ˇ˝˛∂∑∏∫√≈∆◊≤≥├─╤╥](?!\w)|(?<!\w)[¹³¶±¼][^\W\d_]{3}")
_LIGATURE = re.compile(r"[^\W\d_][ﬁﬂπΩ][^\W\d_]")
_UPPER_IN = re.compile(r"[a-zß-öø-ÿ]{2}[À-ÖØ-ÞĄĆĘŁŃŚŹŻŞŢŽŠŸ\x80-\x9f](?:[a-zß-öø-ÿ]|(?!\w))")
_ACCENTS = re.compile(r"[À-ÖØ-öø-ÿ]{4,}")
_CASE_FLIP = re.compile(r"(?<![^\W\d_])[а-яё][А-ЯЁЈ╦]{2,}(?![^\W\d_])")
_ASKED = re.compile(r"[^\W\d_]\?{1,3}[^\W\d_]")
_LONE = re.compile(r"(?<= )[‡ñÑ](?= [a-zà-ÿ])")
#: English contractions and quotation marks whose sign became a letter.
_SIGN = re.compile(r"\b(?:[Ii]t|[Tt]hat|[Ww]hat|[Tt]here|[Hh]e|[Ss]he|[Ww]e|[Tt]hey|[Yy]ou|I|[Dd]on|[Dd]oesn|[Dd]idn|[Ii]sn|[Cc]an|[Ww]on|[Ww]asn|[Ll]et)[íÕ](?:s|t|m|re|ve|ll|d)\b|(?<!\w)[ìÒ][A-Z]|[a-z][,.!?][îÓ](?!\w)")


#: The euro sign of one code page in another.
_EURO = re.compile(r"(?<!\w)[ÄÛ](?=\d)")


def swapped(line: str) -> int:
    """Signs in a line of one code page read as another."""
    n = 2 * len(_ACCENTS.findall(line)) + 2 * len(_CASE_FLIP.findall(line))
    n += 2 * (len(_IN_WORD.findall(line)) + len(_LIGATURE.findall(line))) + 2 * len(_AFTER_WORD.findall(line))
    return n + len(_UPPER_IN.findall(line)) + len(_EURO.findall(line)) + 2 * len(_LONE.findall(line)) + 2 * len(_SIGN.findall(line))


#: Characters that no kind of damage is made of alone; a text with no others is sound unless bytes of a dash or quote show.
_SAFE = "áéíóúñüàèìòùêîôûäöëïßçãõœæąćęłńśźżабвгдежзийклмнопрстуфхцчшщъыьэюяёАБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯЁ–—‘’“”„«»…•€©®\u00a0\u200b\u200c\u200d\u2060\ufeffâ"
_UNSAFE = re.compile(f"[^\x00-\x7f{_SAFE}]|â€|[àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß]{{4}}| [ñ] |[a-z]í(?:s|t|m|re|ve|ll|d)\\b|\\bì[A-Z]")


def damage(text: str | None, model: Callable[[], Bigrams] | None = None) -> str | None:
    """'utf8', 'swap' or 'lost', the kind of damage of a text, or None for a sound one. A single sign of a swap counts
    where the letter bigrams of ``model`` tell that its word is one of another code page."""
    if not text:
        return None
    if text.isascii():
        return "lost" if "?" in text and _asked(text) else None
    if "\ufffd" in text:
        return "lost"
    if _UNSAFE.search(text) is None:
        if len(_CASE_FLIP.findall(text)) >= 1:
            return "swap"
        return "lost" if "?" in text and _asked(text) else None
    page, n = misread(text)
    if page is not None:
        return "utf8"
    signs = sum(map(swapped, text.split("\n")))
    if signs >= 2 or signs and model is not None and any(likelier(w, model()) for w in _WORDS.findall(text) if _UPPER_IN.search(w)):
        return "swap"
    if _REPLACED.search(text):
        return "utf8"
    return "lost" if "?" in text and _asked(text) else None


def _asked(text: str) -> bool:
    """Whether question marks stand inside words, links aside, again and again."""
    return sum(1 for w in text.split() if "/" not in w and "=" not in w and "]" not in w and _ASKED.search(w) and "???" not in w) >= 2


_WORDS = re.compile(r"[^\W\d_]+")


def likelier(word: str, model: Bigrams, gain: float = 5.0) -> bool:
    """Whether a swap of code pages makes a word likelier by the bigrams of some language than it is in any."""
    odd = {c for c in word if not c.isascii()}

    def fit(w: str) -> float:
        seq = [model.index(c) for c in f" {w} "]
        return float(model.log[:, seq[:-1], seq[1:]].sum(1).max())

    as_it_is = fit(word)
    for wrong in ONE_BYTE:
        of = bytes_of(wrong)
        if odd <= of.keys():
            for right in ONE_BYTE:
                other = "".join(bytes([of[c]]).decode(right, "replace") if c in odd else c for c in word) if right != wrong else word
                if other != word and all(c in LETTERS for c in other if not c.isascii()) and fit(other) > as_it_is + gain:
                    return True
    return False


#: Labelled texts, or the counts of their bigrams.
Samples = list[tuple[str, str]] | dict[str, dict[str, int]]


def bigram_counts(lang_samples: DataFrame) -> dict[str, dict[str, int]]:
    """What the letter model is fitted on: by language, how often each bigram comes in all labelled texts. They are
    counted where they are; the driver gets a row a language and bigram, however many texts there are."""
    schema = pa.schema([("lang", pa.string()), ("pair", pa.string()), ("n", pa.int64())])

    def run(batch: list[dict]) -> list[dict]:
        return [{"lang": k, "pair": pair, "n": n} for k, of in counted((r["lang"], r["text"]) for r in batch).items() for pair, n in of.items()]

    rows = lang_samples.where("lang is not null and text is not null").select("lang", "text")
    out: dict[str, dict[str, int]] = {}
    for r in rows.mapInArrow(batches(run, schema), "lang string, pair string, n bigint").groupBy("lang", "pair").agg(F.sum("n").alias("n")).collect():
        out.setdefault(r["lang"], {})[r["pair"]] = r["n"]
    return out


def _lazy(samples: Samples | None) -> Callable[[], Bigrams] | None:
    """The letter model, made in a worker when it is asked for first."""
    made: list[Bigrams] = []

    def model() -> Bigrams:
        if not made:
            made.append(Bigrams(samples))
        return made[0]

    return model if samples else None


_CONTEXTS = "array<struct<a:string,s:string,b:string,n:int>>"


def unlikely(corpus: DataFrame, samples: Samples, record: str = "record_id", text: str = "text", source: str = "source_path") -> DataFrame:
    """(record_id, source, kind, contexts): the records with contexts that no language accounts for, and the kind of damage
    by their signs, null for none. One Arrow pass without a shuffle; sound records give no row."""
    model = _lazy(samples)
    held: list[Judge] = []
    schema = pa.schema(
        [("record_id", pa.string()), ("source", pa.string()), ("kind", pa.string()), ("contexts", pa.list_(pa.struct([("a", pa.string()), ("s", pa.string()), ("b", pa.string()), ("n", pa.int32())])))]
    )

    def run(batch: list[dict]) -> list[dict]:
        if not held:
            held.append(Judge(model()))
        out = []
        for r in batch:
            found = held[0].text(r["text"])
            if found:
                out.append({"record_id": r["record_id"], "source": r["source"], "kind": damage(r["text"], model), "contexts": [{"a": a, "s": s, "b": b, "n": n} for (a, s, b), n in found.items()]})
        return out

    rows = corpus.where(F.col(record).isNotNull()).select(F.col(record).alias("record_id"), F.coalesce(F.col(source), F.lit("")).alias("source"), F.col(text).alias("text"))
    # plain ASCII without a question mark inside a word can't be damaged; that test stays in the JVM
    rows = rows.where(F.regexp_like("text", F.lit(r"[^\x00-\x7f]|[A-Za-z]\?+[A-Za-z]")))
    return rows.mapInArrow(batches(run, schema), f"record_id string, source string, kind string, contexts {_CONTEXTS}")


def rates(seen: DataFrame, samples: Samples) -> DataFrame:
    """(source, a, s, b, gain, letter, rate) from EM over each source's contexts. The contexts are counted before the
    grouping, so a source brings as many rows as there are different contexts, whatever its size."""
    counts = seen.select("source", F.explode("contexts").alias("c")).groupBy("source", "c.a", "c.s", "c.b").agg(F.sum("c.n").alias("n"))
    model = _lazy(samples)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        contexts = Counter({(a, s, b): int(n) for a, s, b, n in zip(pdf["a"], pdf["s"], pdf["b"], pdf["n"])})
        gain, best = learn(contexts, model())
        source = pdf["source"].iloc[0]
        rows = [(source, *k, g, *best.get(k[1], (None, 0.0))) for k, g in gain.items()]
        rows += [(source, None, s, None, None, *best[s]) for s in best.keys() - {k[1] for k in gain}]
        return pd.DataFrame(rows, columns=["source", "a", "s", "b", "gain", "letter", "rate"])

    # the rows are small, the work on them is not: they are not to be coalesced by size
    n = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return counts.repartition(n, "source").groupBy("source").applyInPandas(fit, "source string, a string, s string, b string, gain double, letter string, rate double")


def judged(seen: DataFrame, learned: DataFrame, least: float = 3.0) -> DataFrame:
    """(record_id, kind, gain) of the damaged records: the gain of a context is ``least`` or more in logarithms, and the signs agree."""
    each = seen.where("kind is not null").select("record_id", "kind", "source", F.explode("contexts").alias("c")).select("record_id", "kind", "source", "c.a", "c.s", "c.b")
    gains = each.join(learned.select("source", "a", "s", "b", "gain"), ["source", "a", "s", "b"]).groupBy("record_id").agg(F.min("kind").alias("kind"), F.max("gain").alias("gain"))
    return gains.where(F.col("gain") >= least)


def find_damaged(corpus: DataFrame, samples: Samples, **columns: str) -> DataFrame:
    """(record_id, kind, gain) of the records that are damaged."""
    seen = materialize(unlikely(corpus, samples, **columns), "contexts")
    return judged(seen, rates(seen, samples))


_TAG = re.compile(r"<[^>]*>")
_BREAK = re.compile(r"[\r\n]+|</?(?:p|div|li|td|th|tr|h\d|br|blockquote|title|body|ul|ol|table|section|article|pre)\b[^>]*>", re.I)


def decoded(content: bytes, model: Bigrams) -> str:
    """The body of a response as text: strictly as UTF-8, or else by the code page under which its letters are likeliest."""
    head, _, body = bytes(content).partition(b"\r\n\r\n")
    body = body or head
    try:
        return body.decode("utf-8")
    except UnicodeDecodeError:
        pass
    best, out = -1e300, ""
    for page in ONE_BYTE:
        text = body.decode(page, "replace")
        x = np.array([model.index(c) for c in text])
        odd = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) > 127)
        odd = odd[(odd > 0) & (odd < len(x) - 1)]
        fit = float(model.fit(x[odd - 1], x[odd], x[odd + 1]).sum())
        if fit > best:
            best, out = fit, text
    return out


def page_lines(content: bytes | None, model: Bigrams) -> list[str]:
    """The lines of a page's text from its bytes."""
    if not content:
        return []
    text = decoded(content, model)
    return [x for x in (" ".join(html.unescape(_TAG.sub("", line)).split()) for line in _BREAK.split(text)) if x]


_GAP = re.compile("\ufffd+|(?<=[^\\W\\d_])\\?{1,3}(?=[^\\W\\d_])")


def from_page(line: str, page: list[str]) -> str:
    """The line of the page that has what is left of a damaged line, with other characters in the gaps; the line as it is
    where none or several different ones fit."""
    gaps = [m for m in _GAP.finditer(line)]
    if not gaps:
        return line
    pattern, at = "", 0
    for m in gaps:
        pattern += r"\s+".join(map(re.escape, re.split(r"\s+", line[at : m.start()]))) + "[^\x00-\x7f]{1,%d}" % (3 * len(m[0]))
        at = m.end()
    pattern += r"\s+".join(map(re.escape, re.split(r"\s+", line[at:])))
    whole = re.compile(pattern.strip())
    found = {m[0] for x in page if (m := whole.search(x))}
    lead, trail = line[: len(line) - len(line.lstrip())], line[len(line.rstrip()) :]
    return lead + found.pop().strip() + trail if len(found) == 1 else line


def repair(corpus: DataFrame, lang_samples: DataFrame, warc_raw: DataFrame | None = None) -> DataFrame:
    """(record_id, kind, text, restored) of the damaged records: the text as far as it can be restored, and whether no
    damage is left. The letter model is fitted on all samples."""
    samples = bigram_counts(lang_samples)
    seen = materialize(unlikely(corpus, samples), "contexts")
    learned = materialize(rates(seen, samples), "rates")
    found = materialize(judged(seen, learned).select("record_id", "kind"), "damaged")
    model = _lazy(samples)
    theirs = corpus.select("record_id", F.coalesce("source_path", F.lit("")).alias("source"), "text").join(found, "record_id").dropDuplicates(["record_id"])
    # one row a source: the symbols that are one character and stand for one letter most of the time
    single = learned.where((F.length("s") == 1) & (F.col("s") != LOST) & (F.col("rate") > 0.5) & (F.length("letter") == 1)).select("source", "s", "letter").distinct()
    swaps = single.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("s", "letter"))).alias("m"))  # at most as many as a code page has
    swaps = swaps.select("source", F.array_join("m.s", "").alias("old"), F.array_join("m.letter", "").alias("new"))
    joined = theirs.join(swaps, "source", "left")
    joined = joined.withColumn("text", F.when((F.col("kind") == "swap") & F.col("old").isNotNull(), F.array_join(F.transform(F.split("text", "\n"), _mapped), "\n")).otherwise(F.col("text")))
    if warc_raw is not None:
        raw = warc_raw.where("content is not null").select("record_id", "content").join(found.where("kind = 'lost'").select("record_id"), "record_id", "left_semi").dropDuplicates(["record_id"])
        joined = joined.join(raw, "record_id", "left")
    else:
        joined = joined.withColumn("content", F.lit(None).cast("binary"))
    schema = pa.schema([("record_id", pa.string()), ("kind", pa.string()), ("text", pa.string()), ("restored", pa.bool_())])

    def run(batch: list[dict]) -> list[dict]:
        out = []
        for r in batch:
            text = restore_utf8(r["text"])
            if r["content"] and _GAP.search(text):
                sound = page_lines(r["content"], model())
                text = "\n".join(from_page(x, sound) for x in text.split("\n"))
            out.append({"record_id": r["record_id"], "kind": r["kind"], "text": text, "restored": damage(text, model) is None})
        return out

    return joined.select("record_id", "kind", "text", "content").mapInArrow(batches(run, schema), "record_id string, kind string, text string, restored boolean")


#: The signs of ``swapped`` for the JVM; sound lines of a source are not to be translated.
_SIGNS = (
    r"[\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]{4,}|(?<!\p{L})[а-яё][А-ЯЁЈ╦]{2,}(?!\p{L})|\p{L}[^\x00-\x7f\p{L}\p{M}\p{Z}\p{Cf}\u2010-\u2026\u00ab\u00bb](?:\p{L}|(?!\w))"
    r"|\p{Ll}{2}[\u00c0-\u00d6\u00d8-\u00de\u0160\u0178\u017d](?:\p{Ll}|(?![\p{L}\d]))|\p{L}[ﬁﬂπΩ]\p{L}"
)


def _mapped(line):
    return F.when(F.regexp_like(line, F.lit(_SIGNS)), F.call_function("translate", line, F.col("old"), F.col("new"))).otherwise(line)
