"""Problem 1: lines repeated across one source's documents, kept as incremental line counts.

The state is tables that only grow: ``seen`` (source, rec), the records counted so far, and ``counts`` (source, key, n), in
how many different records of a source a line key occurs, as one set of rows a partition; and, rewritten with each
partition, ``records`` (source, records) and ``frequent`` (source, key), the lines over the threshold now. A new partition of records becomes a delta of the first two. ``advance`` looks
only at the keys of the delta and at the frequent keys of sources whose threshold rose with their records, tells which
crossed the threshold in either direction, and leaves all other rows as they are; ``rebuild`` touches only documents
that hold a crossed line. ``fold`` takes the partitions one after another.

Defined results: null and empty texts have no lines; lines without letters and digits, which are all separators, are the same; a null
source is a source of its own; rows without a record id are left out; repeated rows of an id count once, in the first
partition that has them; rows without a time of ingestion come first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.plans.shared import materialize

#: Characters that show nothing, and the white space that is read as one blank.
INVISIBLE = "\u200b\u200c\u200d\u2060\ufeff\u00ad\u200e\u200f\u180e\u061c"
BLANKS = "\t\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000\r\u000b\u000c"

#: Names of the months, full and short, by language.
MONTHS = {
    "en": "january february march april may june july august september october november december jan feb mar apr jun jul aug sep sept oct nov dec",
    "de": "januar jänner februar märz april mai juni juli august september oktober november dezember mrz okt dez",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre janv févr avr juil déc",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre setiembre octubre noviembre diciembre ene abr ago dic",
    "it": "gennaio febbraio marzo aprile maggio giugno luglio agosto settembre ottobre novembre dicembre gen mag giu lug set ott dic",
    "pt": "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro fev abr ago out dez",
    "nl": "januari februari maart april mei juni juli augustus september oktober november december mrt okt",
    "pl": "stycznia lutego marca kwietnia maja czerwca lipca sierpnia września października listopada grudnia",
    "ru": "января февраля марта апреля мая июня июля августа сентября октября ноября декабря",
}


def _any_of(words: set[str]) -> str:
    """A pattern for any of the words, by common beginnings, so that a search is done with most places after one letter."""
    rest: dict[str, set[str]] = {}
    for w in words:
        if w:
            rest.setdefault(w[0], set()).add(w[1:])
    found = "|".join(c + _any_of(tails) for c, tails in sorted(rest.items()))
    if not found:
        return ""
    return f"(?:{found}){'?' if '' in words else ''}" if len(rest) > 1 or "" in words else found


_NAMES = {m for v in MONTHS.values() for m in v.split()}
#: What stands in front of a month is taken in and given back, which is cheaper than to look behind at every place.
_MONTH = rf"(^|[^\p{{L}}])(?:{_any_of(_NAMES)})(?!\p{{L}})"

#: Wording around a slot that holds a name, a site or a section, as lower-case text with numbers already written #.
_SLOTS = [
    (r"^ ?(by|von|par|por|di|door|da|autora?|auteur|autore|автор) ?:? [^#|]{3,60}?,? ?(?:le |am |el |il |em |op |dnia )?#[# .,:/\-]*[^\p{L}#]*$", "$1 ~ #"),
    (r"^ ?(by|von|par|por|door|autor|автор) ?:? \p{L}[\p{L}'’.\-]+(?: \p{L}[\p{L}'’.\-]*){1,3}[^\p{L}#]*$", "$1 ~"),
    (r"^ ?(posted|published|veröffentlicht|publié|publicado|pubblicato) (on|am|le|el|il|em) #[# .,:/\-]* (by|von|par|por|da) .{3,60}? in \p{L}+[^\p{L}]*$", "$1 $2 # $3 ~ in ~"),
    (r"^ ?((?:text|words|photos?|pictures|fotos?|bilder|texte|testo|foto)(?: (?:and|und|et|y|e|en|i) \p{L}+)?) ?: .{3,60}$", "$1 ~"),
    (r"^ ?(filed under|category|kategorie|catégorie|categoría|categoria|rubrik|рубрика) ?: [\p{L} &]{2,40}?( \W.*)?$", "$1 ~$2"),
    (r"^ ?(?:©|\(c\)|copyright) ?#? ?[^.#|]{2,60}[.] ?(\p{L}.*)$", "© # ~ $1"),
    (r"(registered office of|opinions? of|views of|sitz der|siège de) [^;#|.]{2,60}", "$1 ~"),
]


#: How a line with one of the anchored wordings above begins, and what stands in a line with the other.
_SLOT_START = r"^ ?(?:by|von|par|por|di|door|da|aut|автор|posted|published|veröff|publi|pubbl|text|words|photo|picture|foto|bild|testo|filed|cat|kategor|rubrik|рубрик|©|\(c\)|copyr)"
_SLOT_INSIDE = ("registered office of", "opinion of", "opinions of", "views of", "sitz der", "siège de")


def keyed(rows: DataFrame, line: str = "line", name: str = "key") -> DataFrame:
    """Adds the fixed wording of a line: case, spacing, invisible characters, separators and closing marks do not count,
    and what is filled in (numbers, dates, times, names, sites, sections) is one mark. Null stays null.

    A DataFrame step, as the text is made in stages that are used more than once: each is computed once a line.
    """
    t = F.translate(F.lower(line), BLANKS + INVISIBLE, " " * len(BLANKS))
    t = F.regexp_replace(F.regexp_replace(t, r"\p{Nd}+", "#"), _MONTH, "$1#")
    rows = rows.withColumn(name, F.regexp_replace(t, r" {2,}", " "))
    # the wordings are tried only where their beginning or a part of them is there, whatever the length of the line
    tried = F.col(name)
    for pattern, by in _SLOTS:
        tried = F.regexp_replace(tried, pattern, by)
    inside = F.lit(False)
    for part in _SLOT_INSIDE:
        inside = inside | F.contains(F.col(name), F.lit(part))
    rows = rows.withColumn(name, F.when(F.regexp_like(F.substring(name, 1, 12), F.lit(_SLOT_START)) | inside, tried).otherwise(F.col(name)))
    t = F.trim(F.regexp_replace(name, r"[^\p{L}\p{M}\p{Nd}#~]+", " "))
    return rows.withColumn(name, F.regexp_replace(t, r"#(?: (?:(?:de|do|di|st|nd|rd|th) )?#)+", "#"))


#: The first three words of a lower-case line with what stands between and before them. Invisible characters are taken
#: for letters, as the key is without them and joins what they part.
_BEGIN = rf"^[^\p{{L}}\p{{M}}{INVISIBLE}]*[\p{{L}}\p{{M}}{INVISIBLE}]+(?:[^\p{{L}}\p{{M}}{INVISIBLE}]+[\p{{L}}\p{{M}}{INVISIBLE}]+){{0,2}}"
#: What the key may not leave as it is there: numbers, marks, invisible characters, months, and words that open a wording with a slot.
_UNSURE = rf"[\p{{Nd}}#~©{INVISIBLE}]|{_MONTH}|^[^\p{{L}}\p{{M}}]*(?:by|von|par|por|di|door|da|aut|автор|posted|published|veröff|publi|pubbl|text|words|photo|picture|foto|bild|testo|filed|cat|kategor|rubrik|рубрик|copyr|c[^\p{{L}}])"


def opening(line: str = "line") -> Column:
    """The first three words of a line, which are those of its key, too (``opening_of_key``), at a fraction of the cost of
    the key; null where that is not sure or the line has no words. So lines of other openings than a key's have other keys."""
    low = F.lower(line)
    begin = F.regexp_extract(low, _BEGIN, 0)
    unsure = (begin == "") | F.regexp_like(begin, F.lit(_UNSURE))
    for word in sorted({part.split(" ")[0] for part in _SLOT_INSIDE}):
        unsure = unsure | F.contains(low, F.lit(word))
    return F.when(~unsure, F.trim(F.regexp_replace(begin, r"[^\p{L}\p{M}]+", " ")))


def opening_of_key(key: str = "key") -> Column:
    return F.trim(F.regexp_replace(F.regexp_extract(key, _BEGIN, 0), r"[^\p{L}\p{M}]+", " "))


def line_table(docs: DataFrame, source: str = "source_path", record: str = "record_id", text: str = "text", part: Column | None = None) -> DataFrame:
    """(source, rec, record_id, line_no, key, part): every non-blank line, numbered from 1 with blank lines counted;
    ``part`` names the partition of the record."""
    lines = docs.where(F.col(record).isNotNull()).select(
        F.col(source).alias("source"), F.col(record).alias("record_id"), (F.lit("0") if part is None else part).alias("part"), F.posexplode(F.split(F.col(text), "\n")).alias("at", "line")
    )
    lines = keyed(lines.where(F.regexp_like("line", F.lit(r"[^\s\p{Z}\p{Cf}]"))))
    return lines.select(
        F.xxhash64("source").alias("source"), F.xxhash64("record_id").alias("rec"), "record_id", (F.col("at") + 1).cast("int").alias("line_no"), F.xxhash64("key").alias("key"), "part"
    )


@dataclass
class LineCounts:
    """The state after some partitions; the tables may live in any storage. ``counts`` has a row a key and partition."""

    seen: DataFrame
    counts: DataFrame
    records: DataFrame
    frequent: DataFrame


def totals(seen: DataFrame) -> DataFrame:
    return seen.groupBy("source").agg(F.count("*").alias("records"))


def delta(lines: DataFrame, seen: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(seen, counts) that a partition adds; records that were counted before add nothing. Rows are combined before each shuffle."""
    fresh = lines.select("source", "rec", "key")
    if seen is not None:
        fresh = fresh.join(seen, ["source", "rec"], "left_anti")
    once = fresh.groupBy("source", "key", "rec").agg(F.lit(1).alias("one"))
    return fresh.select("source", "rec").distinct(), once.groupBy("source", "key").agg(F.count("*").alias("n"))


def _need(records: str, least: int, share: float) -> Column:
    """In how many records a line must occur."""
    return F.greatest(F.lit(float(least)), F.col(records) * F.lit(share))


def over(counts: DataFrame, records: DataFrame, least: int = 8, share: float = 0.05) -> DataFrame:
    """(source, key) of lines in at least ``least`` records and at least ``share`` of the source's records."""
    often = counts.where(F.col("n") >= least)
    return often.join(records, "source").where(F.col("n") >= _need("records", least, share)).select("source", "key")


def advance(state: LineCounts | None, lines: DataFrame, least: int = 8, share: float = 0.05) -> tuple[LineCounts, DataFrame]:
    """The state with a partition merged in, and the (source, key, now) whose verdict changed, ``now`` being the new one."""
    seen, counts = (materialize(x, name) for x, name in zip(delta(lines, state.seen if state else None), ("seen", "counts")))
    more = totals(seen)
    if state is None:
        frequent = materialize(over(counts, more, least, share), "frequent")
        return LineCounts(seen, counts, materialize(more, "records"), frequent), frequent.withColumn("now", F.lit(True))
    records = materialize(state.records.unionByName(more).groupBy("source").agg(F.sum("records").alias("records")), "records")
    # a row a source of the delta: how many records it has now, and whether a line needs more of them than before
    after = more.select("source").join(records, "source").join(state.records.withColumnRenamed("records", "before"), "source", "left")
    after = after.select("source", "records", (_need("records", least, share) > F.coalesce(_need("before", least, share), F.lit(float(least)))).alias("rose"))
    shaky = state.frequent.join(after.where("rose").select("source"), "source", "left_semi")
    touched = counts.select("source", "key").unionByName(shaky).distinct()
    known = state.counts.join(touched, ["source", "key"], "left_semi")
    n = known.unionByName(counts).groupBy("source", "key").agg(F.sum("n").alias("n"))
    now = n.join(after, "source").select("source", "key", (F.col("n") >= _need("records", least, share)).alias("now"))
    was = state.frequent.withColumn("was", F.lit(True))
    changed = materialize(now.join(was, ["source", "key"], "left").where(F.col("now") != F.coalesce("was", F.lit(False))).select("source", "key", "now"), "changed")
    frequent = state.frequent.join(changed.where("not now"), ["source", "key"], "left_anti").unionByName(changed.where("now").select("source", "key"))
    return LineCounts(state.seen.unionByName(seen), state.counts.unionByName(counts), records, materialize(frequent, "frequent")), changed


def period(column: str = "ingested_at", unit: str = "quarter") -> Column:
    """The partition of a record: the stretch of time in which it was ingested."""
    return F.coalesce(F.date_format(F.date_trunc(unit, F.col(column)), "yyyy-MM-dd"), F.lit("0"))


def fold(lines: DataFrame, least: int = 8, share: float = 0.05) -> LineCounts:
    """The state after all partitions of a line table, merged one after another in order of their names."""
    parts = sorted(r["part"] for r in lines.select("part").distinct().collect())  # a row a stretch of time
    state = None
    for part in parts:
        state, _ = advance(state, lines.where(F.col("part") == part), least, share)
    return state or advance(None, lines, least, share)[0]


def repeated_lines(docs: DataFrame, least: int = 8, share: float = 0.05, part: Column | None = None, **columns: str) -> DataFrame:
    """(record_id, line_no) of the lines repeated within their source, by folding the partitions that ``part`` names."""
    lines = materialize(line_table(docs, part=part, **columns), "lines", by="part")
    return lines.join(fold(lines, least, share).frequent, ["source", "key"], "left_semi").select("record_id", "line_no").distinct()


def rebuild(docs: DataFrame, repeated: DataFrame, record: str = "record_id", text: str = "text") -> DataFrame:
    """The documents that hold a repeated line, one row each, without those lines; all other rows stay untouched elsewhere.

    A document whose lines all go has the empty text.
    """
    gone = repeated.groupBy("record_id").agg(F.collect_set("line_no").alias("gone")).withColumnRenamed("record_id", "__id")
    hit = docs.select(F.col(record).alias("__record"), F.col(text).alias("__text")).join(gone, F.col("__record") == F.col("__id"))
    # F.filter has the position as the second argument, from 0
    kept = F.filter(F.split(F.col("__text"), "\n"), lambda line, at: ~F.array_contains(F.col("gone"), at + 1))
    return hit.select(F.col("__record").alias(record), F.array_join(kept, "\n").alias("text")).dropDuplicates([record])
