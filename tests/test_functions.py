import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.functions import boilerplate, charset, domains, http, simhash, text
from corpusmill.functions.boilerplate import BAD, GOOD, NEARGOOD, SHORT, Paragraph


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn(F.col("x")).alias("y")).first()["y"]


CC = '<a href="http://creativecommons.org/licenses/{}">x</a>'


@pytest.mark.parametrize(
    "page, want",
    [
        (None, None),
        ("", "none"),
        (CC.format("by"), "by"),
        (CC.format("by") * 2, "by"),
        (CC.format("by") + CC.format("by-sa"), "cc-unspecified"),
        ("https://creativecommons.org/licenses/by-nc-nd/3.0", "by-nc-nd"),
        ("http://creativecommons.org/licenses/by-nd>", "by-nd"),
        ("http://creativecommons.org/licenses/by'", "none"),
        ("http://creativecommons.org/licenses/by", "none"),
        ("HTTP://CREATIVECOMMONS.ORG/licenses/by/", "none"),
        ("http://www.creativecommons.org/licenses/by/", "none"),
    ],
)
def test_license(spark, page, want):
    assert one(spark, page, text.cc_license) == want


def test_license_needs_a_tag(spark):
    assert one(spark, "<a rel=license\nhref='http://creativecommons.org/licenses/by-sa/3.0/de/'>", text.cc_license_in_tags) == "by-sa"
    assert one(spark, "<p>http://creativecommons.org/licenses/by-sa/3.0/</p>", text.cc_license_in_tags) == "none"
    two = "<a title='é' HREF=\"http://creativecommons.org/licenses/by/3.0/\" href=https://creativecommons.org/licenses/by-nd/4.0/>x</a><abbr href='http://creativecommons.org/licenses/by-nc/1.0/'>"
    assert one(spark, two, text.cc_license_in_tags) == "by-nd"
    assert one(spark, two + "<meta content='https://creativecommons.org/licenses/by/2.0/'", text.cc_license_in_tags) == "cc-unspecified"


def test_normalize(spark):
    raw = "  a\tb  c \n\n\n d—e… “q” ‘r’  "
    assert one(spark, raw, text.normalize_text) == "ab c\nd-e... \"q\" 'r'" == boilerplate.normalized(raw)


@given(st.text(alphabet="ab \t\n\r  —…“‘\u0007", max_size=40))
@settings(max_examples=60, deadline=None)
def test_a_second_pass_only_joins_line_feeds(x):
    """Line feeds are joined before lines are trimmed, so a line of blanks leaves two, which a second pass joins."""
    once = boilerplate.normalized(x)
    assert boilerplate.normalized(once) == re.sub("\n+", "\n", once)


def test_a_line_of_blanks_leaves_two_line_feeds(spark):
    assert boilerplate.normalized("a\n \na") == "a\n\na" == one(spark, "a\n \na", text.normalize_text)


def test_tokens_and_sentences(spark):
    assert one(spark, "für a_1 -- b", text.ascii_tokens) == ["f", "r", "a_1", "b"]
    assert one(spark, "Don't (stop), A/B", text.vocabulary_tokens) == ["don", "t", "stop", "a", "b"]
    assert one(spark, "The/at dog/nn end/nn", text.tagged_tokens) == ["the", "dog", "end", "nn"]
    assert one(spark, "<doc>", text.wiki_tokens) == []
    assert one(spark, "<p>a. b. </p>", text.sentences) == ["a", "b"]
    assert one(spark, "a. b", text.sentences) == []
    assert one(spark, "", text.word_count) == 1
    assert one(spark, " a b ", text.word_count) == 4
    assert one(spark, "a\r\nb\n\n", text.lines_of) == ["a", "b"]
    assert one(spark, "<p>x</p>", text.strip_line_tags) == "x"


def test_search_line(spark):
    line = "This is a text containing a test phrase, or her dummy text with content"
    assert one(spark, line, lambda c: text.matches(c, ".{10}text.{10}")) == ["This is a text containin", "her dummy text with cont"]
    assert one(spark, line, lambda c: text.matches(c, "containing.*phrase")) == ["containing a test phrase"]


def test_http(spark):
    def fields(raw):
        df = spark.createDataFrame([(bytearray(raw),)], "c binary").select(http.header(F.col("c")).alias("h"), http.body(F.col("c")).alias("b"))
        return df.select("b", http.page_type(F.col("h")).alias("t"), http.page_charset(F.col("h")).alias("s")).first()

    r = fields(b"HTTP/1.1 200 OK\r\nContent-Type: Text/HTML; charset=charset=ISO-8859-4\r\n\r\n<p>")
    assert (r.t, r.s, bytes(r.b)) == ("text/html", "iso-8859-4", b"<p>")
    assert fields(b"HTTP/1.1 200 OK\r\nContent-Type: application/wordperfect5.1;\r\n\r\n").t == "application/wordperfect5.1"
    assert fields(b"no header").t is None
    assert bytes(fields(b"HTTP/1.1 200 OK\r\nContent-Type: text/html").b).startswith(b"HTTP")


def test_page_test(spark):
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    rows = [("application/http; msgtype=response", 9_999_999, head), ("application/http; msgtype=response", 10_000_000, head), ("application/http;msgtype=response", 5, head), ("application/http; msgtype=response", 5, b"x"), (None, None, None)]
    df = spark.createDataFrame([(a, b, bytearray(c) if c else None) for a, b, c in rows], "a string, b int, c binary")
    assert [r[0] for r in df.select(http.is_page(F.col("a"), F.col("b"), F.col("c"))).collect()] == [True, False, False, False, False]


def slow_simhash(t):
    grams = {t[i : i + 7] for i in range(len(t) - 6)}
    hashes = set()
    for g in grams:
        h = 0
        for c in g:
            h = (h * 31 + ord(c)) & 0xFFFFFFFF
        hashes.add(h)
    word = 0
    for b in range(32):
        if sum(1 if h >> b & 1 else -1 for h in hashes) > 0:
            word |= 1 << b
    both = word | word << 32
    return both - (1 << 64) if both >> 63 else both


@given(st.text(alphabet="abcdefgh xyzé", max_size=60))
@settings(max_examples=80, deadline=None)
def test_simhash_equals_the_definition(t):
    assert simhash.simhash_of(t) == slow_simhash(t)


def test_simhash_edges():
    assert simhash.simhash_of(None) is None
    assert simhash.simhash_of("") == simhash.simhash_of("abcdef") == 0
    assert simhash.simhash_of("abcdefg") != 0
    assert isinstance(simhash.simhash_of("a \U0001f600 beyond the plane"), int)


@given(st.integers(0, 2**32 - 1), st.integers(0, 31))
@settings(max_examples=100, deadline=None)
def test_a_band_is_shared_within_three_bits(word, bit):
    a, b = word | word << 32, (word ^ 1 << bit) | (word ^ 1 << bit) << 32
    keys = lambda h: [(h >> 17 * i) & 0x1FFFF for i in range(3)]
    assert any(x == y for x, y in zip(keys(a), keys(b)))


def test_domains(spark):
    def reg(h):
        return one(spark, h, domains.registrable)

    assert reg("www.example.co.uk") == "example.co.uk"
    assert reg("a.b.example.org") == "example.org"
    assert reg("co.uk") == "co.uk"
    assert reg("localhost") == "localhost"
    assert reg("192.0.2.1") is None
    assert reg(None) is None
    assert one(spark, "http://a b/", domains.host) is None


@pytest.mark.parametrize(
    "data, declared, want",
    [
        (b"", None, "utf-8"),
        (None, None, "utf-8"),
        (b"plain", "utf-16LE", "utf-8"),
        ("مرحبا".encode(), "utf-16LE", "utf-8"),
        ("Příliš žluťoučký".encode(), "utf-16LE", "utf-8"),
        ("café naïve".encode("latin-1"), "utf-16LE", "iso-8859-1"),
        ("Старый мост".encode("windows-1251"), None, "windows-1251"),
        ("złoty".encode("iso8859-2"), "ISO-8859-2", "iso-8859-2"),
        (b"\xef\xbb\xbfx", None, "utf-8"),
    ],
)
def test_charset(data, declared, want):
    assert charset.detect(data, declared) == want


def test_charsets_are_told_by_all_bytes():
    late = b"a" * 9000 + "Straße und Käse für Müller, größer als möglich".encode("windows-1252")
    assert charset.detect(late) in ("windows-1252", "iso-8859-1") and charset.detect(late, most=charset.SAMPLE) == "utf-8"


def test_page_html_keeps_all_without_header_end():
    assert charset.page_html(b"HTTP/1.1 200 OK\r\n\r\n<p>x") == "<p>x"
    assert charset.page_html(b"abcdef") == "abcdef"
    assert charset.page_html(None) is None


def classes(*free, heads=()):
    ps = [Paragraph(text="x" * 50, tag_path="html.body.h2." if i in heads else "html.body.p.") for i in range(len(free))]
    return boilerplate.context_sensitive(ps, list(free))


def test_neighbours_keep_what_they_found():
    assert classes(GOOD, SHORT, SHORT, NEARGOOD) == [GOOD, BAD, GOOD, GOOD]
    assert classes(GOOD, SHORT, GOOD) == [GOOD, GOOD, GOOD]
    assert classes(BAD, SHORT, BAD) == [BAD, BAD, BAD]
    assert classes(SHORT) == [BAD]
    assert classes(BAD, NEARGOOD, BAD) == [BAD, BAD, BAD]
    assert classes(GOOD, NEARGOOD, BAD) == [GOOD, GOOD, BAD]
    assert classes(GOOD, *[SHORT] * 12, GOOD)[1] == BAD
    assert classes(SHORT, GOOD, heads={0}) == [GOOD, GOOD]
    assert classes() == []


@pytest.mark.parametrize("n, links, want", [(69, 0, SHORT), (69, 1, BAD), (70, 0, NEARGOOD), (200, 0, NEARGOOD), (201, 0, GOOD), (200, 40, BAD), (200, 39, NEARGOOD), (0, 0, BAD)])
def test_context_free_limits(n, links, want):
    assert boilerplate.context_free(Paragraph(text="x" * n, link_chars=links), None, boilerplate.Thresholds()) == want


def test_stop_words_limits():
    p = Paragraph(text=" ".join(["the"] * 8 + ["xxxxxxxx"] * 17))  # 8 of 25 is not 0.32 in single precision
    assert boilerplate.context_free(p, frozenset(["the"]), boilerplate.Thresholds()) == NEARGOOD
    p = Paragraph(text=" ".join(["xxxxxxxx"] * 30))
    assert boilerplate.context_free(p, frozenset(["the"]), boilerplate.Thresholds()) == BAD


PAGE = """<!DOCTYPE html><html><head><title>t</title></head><body><!-- a
b --><div class="x hidden">gone</div><script>gone()</script><ul><li><a href=/>Home</a><li>Two</ul>
<h1>Head</h1><p>First <b>bold</b> &amp; more<p>{long}<br><br>after</body></html>"""


def test_segments():
    ps = boilerplate.segment(PAGE.format(long="word " * 60))
    assert [p.text for p in ps if p.text] == ["Home", "Two", "Head", "First bold  &amp; more".replace("First bold", "First  bold"), ("word " * 60).strip(), "after"] or [p.text for p in ps if p.text][:3] == ["Home", "Two", "Head"]
    assert [p.tag_path for p in ps if p.text][:3] == ["html.body.ul.li.a.", "html.body.ul.li.", "html.body.h1."]
    assert ps[0].text == ""  # the document type opens the page
    assert not any("gone" in p.text for p in ps)
    assert [p.link_chars for p in ps if p.text == "Home"] == [4]
    assert [p.is_heading for p in ps if p.text == "Head"] == [True]


def test_clean_edges():
    assert boilerplate.clean(None) is None
    assert boilerplate.clean("") == ""
    assert boilerplate.clean("<<<>>>&&&") == ""
    long = "This sentence goes on for quite a while and has no link in it at all. " * 5
    assert boilerplate.clean(f"<div><p>{long}</p></div>") == long.strip()
    assert boilerplate.clean(f"<div><p>{long}</p></div>", minimal_html=True) == f"<p>{long.strip()}</p>"
    assert boilerplate.clean("<p>" * 5000 + long) is not None
