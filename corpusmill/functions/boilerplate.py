"""Boilerplate removal: a page is cut into paragraphs, which are classified by length, links and stop words and then by
their neighbours; what is good stays. The state of the neighbour search lives within one page, so a page's result doesn't
depend on which pages a worker saw before.

Three steps, each usable alone: ``segment`` (HTML to paragraphs), ``classify`` (paragraphs to classes), ``render_text`` and
``render_html``. Lengths are in UTF-16 units.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusmill.functions.text import DASH_POINTS, DOUBLE_QUOTES, SINGLE_QUOTES, SPACE_POINTS

#: Elements that open a block; all others are inline.
BLOCK = frozenset(
    "html head body frameset script noscript style meta link title frame noframes section nav aside hgroup header footer p h1 h2 h3 h4 h5 h6 ul ol pre div blockquote hr address figure figcaption form fieldset ins del dl dt dd li table caption thead tfoot tbody colgroup col tr th td video audio canvas details menu plaintext template article main svg math center".split()
)
#: Elements without content, and elements whose text isn't markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Which open elements an opening tag closes, up to a container of theirs.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "a": ({"a"}, {"td", "th", "table", "div"}),
}
#: Opening tags that end an open paragraph.
ENDS_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: Elements that don't show in a path, one of them in a row at a time.
SKIPPED_IN_PATH = frozenset("b u i br".split())
_COMMENT = re.compile(r"<!--(.*?)-->")
_BLANK = re.compile(r"[ \t\n\f\r]+")

GOOD, BAD, SHORT, NEARGOOD = "good", "bad", "short", "neargood"


@dataclass
class Paragraph:
    text: str = ""
    link_chars: int = 0
    tag_path: str = ""
    cf_class: str = ""
    kind: str = ""

    @property
    def is_heading(self) -> bool:
        return re.search(r"\.h\d\.$", self.tag_path) is not None

    @property
    def length(self) -> int:
        return units(self.text)


def units(text: str) -> int:
    """The length in UTF-16 units."""
    return len(text) + sum(ord(c) > 0xFFFF for c in text) if not text.isascii() else len(text)


@dataclass
class _Element:
    tag: str
    dropped: bool = False
    filled: bool = False


@dataclass
class _Leaf:
    kind: str  # "text", or the name of what it is
    text: str
    above: list[_Element] = field(repr=False)


class _Leaves(HTMLParser):
    """The leaves of a page in document order, each with the elements above it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [_Element("html", filled=True), _Element("body", filled=True)]
        self.leaves: list[_Leaf] = []
        self.pending: list[str] = []
        self.in_head = False

    def _dropped(self) -> bool:
        return self.in_head or any(e.dropped for e in self.stack)

    def _leaf(self, kind: str, text: str = "", above: list[_Element] | None = None) -> None:
        self.leaves.append(_Leaf(kind, text, list(self.stack if above is None else above)))

    def _text(self) -> None:
        text = "".join(self.pending)
        self.pending.clear()
        if not text:
            return
        self.stack[-1].filled = True
        if _BLANK.sub("", text) and not self._dropped():
            self._leaf("text", _BLANK.sub(" ", text))

    def _pop(self) -> None:
        self._text()
        e = self.stack.pop()
        if not e.filled and not self._dropped() and not e.dropped:
            self._leaf(e.tag)
        if not e.dropped:
            self.stack[-1].filled = True

    def _close_to(self, at: int) -> None:
        while len(self.stack) > at:
            self._pop()

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            self.in_head = self.in_head and tag != "body"
            return
        if tag == "head":
            self.in_head = True
            return
        if self.in_head and tag in BLOCK and tag not in ("meta", "link", "title", "style", "script", "noscript", "template"):
            self.in_head = False  # the head ends where the body's elements begin
        self._text()
        if tag in CLOSES:
            ends, within = CLOSES[tag]
            at = None
            for i in range(len(self.stack) - 1, 1, -1):
                if self.stack[i].tag in within:
                    break
                if self.stack[i].tag in ends:
                    at = i
            if at is not None:
                self._close_to(at)
        if tag in ENDS_P:
            for i in range(len(self.stack) - 1, 1, -1):
                if self.stack[i].tag in ("table", "td", "th", "button"):
                    break
                if self.stack[i].tag == "p":
                    self._close_to(i)
                    break
        if tag == "tr" and self.stack[-1].tag == "table":
            self._open("tbody", ())
        self._open(tag, attrs)
        if tag in VOID:
            self._pop()

    def _open(self, tag, attrs):
        self.stack[-1].filled = True
        classes = next((v or "" for k, v in attrs if k == "class"), "").split()
        self.stack.append(_Element(tag, dropped=tag in ("script", "embedded") or "hidden" in classes))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag):
        if tag == "head":
            self.in_head = False
            return
        if tag in ("html", "body") or tag in VOID:
            if tag == "br":
                self.handle_starttag("br", ())
            return
        for i in range(len(self.stack) - 1, 1, -1):
            if self.stack[i].tag == tag:
                self._close_to(i)
                return
            if self.stack[i].tag in ("table", "td", "th") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th"):
                return

    def handle_data(self, data):
        self.pending.append(data)

    def handle_comment(self, data):
        self._text()
        if not self._dropped():
            self.stack[-1].filled = True
            self._leaf("#comment")

    def handle_decl(self, decl):
        self._text()
        self._leaf("#doctype", above=[])

    def finish(self) -> list[_Leaf]:
        self._text()
        self._close_to(2)
        return self.leaves


def _path(above: list[_Element]) -> str:
    tags = [e.tag for e in above]
    out = []
    while tags:
        if tags[-1] in SKIPPED_IN_PATH:
            tags.pop()
        if tags:
            out.append(tags.pop())
    return "".join(t + "." for t in reversed(out))


def _breaks(last: _Leaf, leaf: _Leaf) -> bool:
    """Whether a block lies between two leaves on the way to what they have in common."""
    a, b = last.above, leaf.above
    i = 0
    while i < len(a) and i < len(b) and a[i] is b[i]:
        i += 1
    return any(e.tag in BLOCK for e in a[i:]) or any(e.tag in BLOCK for e in b[i:])


def _escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace(chr(0xA0), "&nbsp;")


def segment(page: str | None) -> list[Paragraph]:
    """The paragraphs of a page. A leaf that is no text and opens a paragraph leaves it empty; the first text of a
    paragraph is decoded, further ones are appended as markup. What can't be parsed has none."""
    if not page:
        return []
    parser = _Leaves()
    try:
        parser.feed(_COMMENT.sub("", page))
        parser.close()
        leaves = parser.finish()
    except (AssertionError, ValueError):
        return []
    out: list[Paragraph] = []
    last: _Leaf | None = None
    for leaf in leaves:
        linked = leaf.kind == "text" and any(e.tag in ("a", "link") for e in leaf.above)
        if last is None or leaf.kind == last.kind == "br" or _breaks(last, leaf):
            p = Paragraph()
            if leaf.kind == "text":
                p.text = leaf.text.replace("<br>", "").strip()
                p.tag_path = _path(leaf.above)
                p.link_chars = units(leaf.text) if linked else 0
            out.append(p)
        elif leaf.kind == "text":
            out[-1].text += " " + _escaped(leaf.text)
            if linked:
                out[-1].link_chars += units(leaf.text)
        last = leaf
    return out


@dataclass(frozen=True)
class Thresholds:
    length_low: int = 70
    length_high: int = 200
    stopwords_low: float = 0.30
    stopwords_high: float = 0.32
    max_link_density: float = 0.20
    max_heading_distance: int = 200
    reach: int = 10


def context_free(p: Paragraph, stop: frozenset[str] | None, t: Thresholds) -> str:
    """The class of a paragraph by itself. Densities are single-precision quotients held against double-precision limits."""
    n = p.length
    density = float(np.float32(p.link_chars) / np.float32(n)) if n else 0.0
    if density > t.max_link_density or "\\xa9" in p.text or "&copy" in p.text:
        return BAD
    if n < t.length_low:
        return BAD if p.link_chars > 0 or n == 0 else SHORT
    if stop is None:
        return GOOD if n > t.length_high else NEARGOOD
    words = p.text.split()
    share = float(np.float32(sum(w.lower() in stop for w in words)) / np.float32(len(words))) if words else 0.0
    if share >= t.stopwords_high:
        return GOOD if n > t.length_high else NEARGOOD
    return NEARGOOD if share >= t.stopwords_low else BAD


class _Neighbours:
    """The nearest settled paragraph on either side. What a side found last is kept: a later search that meets a short
    paragraph between itself and that place takes it from there."""

    def __init__(self, kinds: list[str], reach: int):
        self.kinds, self.reach = kinds, reach
        self.kept: dict[int, tuple[int, str] | None] = {-1: None, 1: None}

    def find(self, at: int, step: int, settled_only: bool) -> str:
        n = len(self.kinds)
        tries = n if step < 0 else self.reach
        i = at + step
        while 0 <= i < n and tries:
            kind = self.kinds[i]
            kept = self.kept[step]
            if kind in (GOOD, BAD):
                self.kept[step] = (i, kind)
                return kind
            if kind == NEARGOOD and not settled_only:
                return kind
            if kept and kind == SHORT and (i - kept[0]) * step < 0:
                return kept[1]
            if step > 0 and kept is None and i == n - 1:
                self.kept[step] = (i, BAD)
                return BAD
            i += step
            tries -= 1
        return BAD


def _rescue_headings(paragraphs: list[Paragraph], kinds: list[str], picked: list[int], to: str, far: int) -> None:
    """Headings that a good paragraph follows within ``far`` characters become ``to``."""
    for i in picked:
        gone = 0
        for j in range(i + 1, len(paragraphs)):
            if gone > far:
                break
            if kinds[j] == GOOD:
                kinds[i] = to
                break
            gone += paragraphs[j].length


def context_sensitive(paragraphs: list[Paragraph], free: list[str], t: Thresholds = Thresholds(), headings: list[bool] | None = None) -> list[str]:
    """The final classes from the context-free ones; ``headings`` where it is known otherwise what is a heading."""
    kinds = list(free)
    heads = [i for i, p in enumerate(paragraphs) if (headings[i] if headings is not None else p.is_heading)]
    _rescue_headings(paragraphs, kinds, [i for i in heads if kinds[i] == SHORT], NEARGOOD, t.max_heading_distance)
    near = _Neighbours(kinds, t.reach)
    settled = {}
    for i, kind in enumerate(kinds):
        if kind != SHORT:
            continue
        before, after = near.find(i, -1, True), near.find(i, 1, True)
        if before == after:
            settled[i] = before
        else:
            almost = before == BAD and near.find(i, -1, False) == NEARGOOD or after == BAD and near.find(i, 1, False) == NEARGOOD
            settled[i] = GOOD if almost else BAD
    for i, kind in settled.items():
        kinds[i] = kind
    for i, kind in enumerate(kinds):
        if kind == NEARGOOD:
            before, after = near.find(i, -1, True), near.find(i, 1, True)
            kinds[i] = BAD if before == after == BAD else GOOD
    _rescue_headings(paragraphs, kinds, [i for i in heads if kinds[i] == BAD and free[i] != BAD], GOOD, t.max_heading_distance)
    return kinds


def classify(paragraphs: list[Paragraph], stop: frozenset[str] | None = None, t: Thresholds = Thresholds()) -> list[Paragraph]:
    """Sets the classes. Without a stop list every long paragraph with few links is good or nearly so."""
    for p in paragraphs:
        p.cf_class = context_free(p, stop, t)
    for p, kind in zip(paragraphs, context_sensitive(paragraphs, [p.cf_class for p in paragraphs], t)):
        p.kind = kind
    return paragraphs


_ODD_SPACE = re.compile("[" + "".join(map(chr, SPACE_POINTS)) + "]+")
_DASH = re.compile("[" + "".join(map(chr, DASH_POINTS)) + "]+")
_QUOTES = str.maketrans(dict.fromkeys(DOUBLE_QUOTES, '"') | dict.fromkeys(SINGLE_QUOTES, "'") | {chr(0x2026): "..."})
_EDGE = "".join(map(chr, range(33)))


def normalized(text: str) -> str:
    """``text.normalize_text`` for one string."""
    t = re.sub(r"\n+", "\n", text)
    t = re.sub(r"[\x00-\x09\x0b\x0c\x0e-\x1f\x7f]", "", t)
    t = _ODD_SPACE.sub(" ", t)
    t = re.sub(r" *\n *", "\n", t)
    return _DASH.sub("-", t).translate(_QUOTES).strip(_EDGE)


def render_text(paragraphs: list[Paragraph]) -> str:
    """The good paragraphs as plain text, one a line."""
    return "\n".join(html.unescape(normalized(p.text)).strip(_EDGE) for p in paragraphs if p.kind == GOOD).strip(_EDGE)


def render_html(paragraphs: list[Paragraph]) -> str:
    """The good paragraphs, each in its element; those without a path in ``p``, empty ones not at all."""
    out = []
    for p in paragraphs:
        text = normalized(p.text)
        if p.kind == GOOD and text:
            tag = p.tag_path.rstrip(".").rpartition(".")[2] or "p"
            out.append(f"<{tag}>{text}</{tag}>\n")
    return "".join(out).strip(_EDGE)


def clean(page: str | None, minimal_html: bool = False, stop: frozenset[str] | None = None) -> str | None:
    """The main text of a page, plain or with minimal markup; null stays null, an empty page is empty."""
    if page is None:
        return None
    paragraphs = classify(segment(page), stop)
    return render_html(paragraphs) if minimal_html else render_text(paragraphs)


@F.pandas_udf(StringType())
def boilerplate_text(pages: pd.Series) -> pd.Series:
    return pages.map(clean, na_action="ignore")


@F.pandas_udf(StringType())
def boilerplate_html(pages: pd.Series) -> pd.Series:
    return pages.map(lambda x: clean(x, True), na_action="ignore")


def paragraphs_of(pages: DataFrame, id: str = "record_id", page: str = "html", stop: frozenset[str] | None = None) -> DataFrame:
    """A row a paragraph: id, idx, text, link_chars, tag_path, is_heading, cf_class, class."""
    kind = dict(pages.dtypes)[id]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for key, text in zip(frame["id"], frame["page"]):
                for i, p in enumerate(classify(segment(text), stop)):
                    rows.append((key, i, p.text, p.link_chars, p.tag_path, p.is_heading, p.cf_class, p.kind))
            yield pd.DataFrame(rows, columns=[id, "idx", "text", "link_chars", "tag_path", "is_heading", "cf_class", "class"])

    schema = f"`{id}` {kind}, idx int, text string, link_chars int, tag_path string, is_heading boolean, cf_class string, class string"
    return pages.select(F.col(id).alias("id"), F.col(page).alias("page")).mapInPandas(run, schema)


def pages_of(frames: Iterator[pd.DataFrame]) -> Iterator[list[dict]]:
    """The blocks of each page out of frames that are sorted by record_id and idx; of repeated ones the first."""
    page: list[dict] = []
    for frame in frames:
        for row in frame.to_dict("records"):
            if page and page[-1]["record_id"] != row["record_id"]:
                yield page
                page = []
            if not page or page[-1]["idx"] != row["idx"]:
                page.append(row)
    if page:
        yield page


def classify_blocks(blocks: DataFrame, stop: frozenset[str] | None = None, t: Thresholds = Thresholds()) -> DataFrame:
    """(record_id, idx, text, cf_class, class) of pages that are given block by block; class is good, bad or as good as it
    gets. Repeated blocks of one idx count once; null texts are empty; rows without record_id or idx are left out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for page in pages_of(frames):
            found = []
            for b in page:
                p = Paragraph()
                p.text, p.tag_path = b["text"] or "", b["tag_path"] or ""
                p.link_chars = 0 if pd.isna(b["link_chars"]) else int(b["link_chars"])
                p.cf_class = context_free(p, stop, t)
                found.append(p)
            heads = [b["is_heading"] is not None and not pd.isna(b["is_heading"]) and bool(b["is_heading"]) for b in page]
            kinds = context_sensitive(found, [p.cf_class for p in found], t, heads)
            yield pd.DataFrame({"record_id": [b["record_id"] for b in page], "idx": [b["idx"] for b in page], "text": [b["text"] for b in page], "cf_class": [p.cf_class for p in found], "class": kinds})

    rows = blocks.where("record_id is not null and idx is not null").select("record_id", "idx", "text", "link_chars", "tag_path", "is_heading")
    # one shuffle brings the blocks of a page together, sorted on disk; a task holds one page
    ordered = rows.repartition("record_id").sortWithinPartitions("record_id", "idx", "text", "tag_path")
    return ordered.mapInPandas(run, "record_id string, idx int, text string, cf_class string, class string")


def text_of_blocks(classes: DataFrame) -> DataFrame:
    """(record_id, text): the good blocks of each page in order, one a line; pages without any have no row."""

    @F.pandas_udf(StringType())
    def plain(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: html.unescape(normalized(x or "")).strip(_EDGE))

    good = classes.where(F.col("class") == GOOD).select("record_id", "idx", plain(F.col("text")).alias("t"))
    rows = good.groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct("idx", "t"))).alias("b"))  # the blocks of a page
    joined = F.array_join(F.transform("b", lambda x: x["t"]), "\n")
    return rows.select("record_id", F.regexp_replace(joined, r"^[\x00-\x20]+|[\x00-\x20]+$", "").alias("text"))
