import os
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import charset, ciphers, langlabel, lines, pages, quality, residue, spam
from corpusmill.llm.textkit import WORD, Lexicon, blanked, form, word_table, words_of

CORPUS = "record_id string, target_uri string, source_path string, text string, language string"


def corpus(spark, rows):
    return spark.createDataFrame([(r, "http://a.example/" + str(r), s, t, lang) for r, s, t, lang in rows], CORPUS)


# --- 1 ---------------------------------------------------------------------------------------------------------------


def key(spark, line):
    return lines.keyed(spark.createDataFrame([(line,)], "x string"), "x", "k").first()["k"]


@pytest.mark.parametrize(
    "a, b",
    [
        ("Share this | Print", "  share​ this · PRINT »"),
        ("By Ann Lee, 3 May 2011", "by JANE DOE-ROE, 2012-01-30"),
        ("Posted on May 3, 2011 by Ann Lee in Town", "Posted on 2009-01-18 by Bo Li in Sport"),
        ("© 2016 Old Mill. All rights reserved.", "© 2011 New Post. All rights reserved"),
        ("Filed under: Sport | Leave a comment (12)", "Filed under: Town | Leave a comment (1)"),
        ("Zuletzt geändert am 8. Juni 2014 um 14:20 Uhr", "zuletzt geändert am 01.02.2015 um 03:04 uhr"),
        ("12 people found this helpful.", "7 people found this helpful"),
        ("Registered office of Old Mill; company number 12.", "Registered office of Far Post; company number 7."),
        ("---", "***"),
    ],
)
def test_same_wording(spark, a, b):
    assert key(spark, a) == key(spark, b)


LEGAL = " No part of what is shown here may be copied, kept or passed on in any form without the written word of the owner, who answers for no loss that comes of its use, be it direct or not, and who may change these terms at any time."


@pytest.mark.parametrize(
    "a, b",
    [
        ("© 2016 Old Mill." + LEGAL, "© 2011 New Post." + LEGAL),
        ("Registered office of Old Mill;" + LEGAL, "Registered office of Far Post;" + LEGAL),
        ("These terms hold from March 5, 2021 on." + LEGAL, "These terms hold from June 17, 2009 on." + LEGAL),
        ("Diese Fassung gilt ab dem 3. Mai 2014." + LEGAL, "Diese Fassung gilt ab dem 03.11.2012." + LEGAL),
    ],
)
def test_same_wording_of_long_lines(spark, a, b):
    assert min(len(a), len(b)) > 200
    assert key(spark, a) == key(spark, b)


@pytest.mark.parametrize("word", sorted({m for v in lines.MONTHS.values() for m in v.split()}))
def test_every_month_is_known(word):
    # the pattern is one for Java, but for the letter class
    pattern = re.compile(lines._MONTH.replace(r"\p{L}", r"[^\W\d_]"))
    assert pattern.sub("#", f"{word}, x{word} {word}x") == f"#, x{word} {word}x"


def test_other_wording(spark):
    assert len({key(spark, x) for x in ("Share this", "Share that", "Print", "The mill by the river is old.", "The bridge by the river is old.")}) == 5
    assert key(spark, None) is None


def some_lines(seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(160):
        source = ["a", "b", "c", None][min(3, int(rng.random() ** 2 * 5))]
        name = "".join(chr(97 + int(d)) for d in str(i))
        body = [f"Text {name} goes on about {rng.choice('pqrstuv') * 5}{name}x."]
        if rng.random() < 0.4:
            body.append("Share this page")
        if rng.random() < 0.12:
            body.append("ABOUT US")
        if rng.random() < 0.05:
            body += ["", "Rare notice"]
        rows.append((f"r{i}", source, "\n".join(body), "en"))
    return rows + rows[:20] + [("empty", "a", "", "en"), ("null", "a", None, "en"), (None, "a", "Share this page", "en")]


def brute(rows, least, share):
    per, of = defaultdict(set), defaultdict(set)
    for r, s, t, _ in rows:
        if r is None or not t:
            continue
        for x in t.split("\n"):
            if x.strip():
                per[s, x.lower()].add(r)
                of[s].add(r)
    hot = {k for k, v in per.items() if len(v) >= least and len(v) >= share * len(of[k[0]])}
    return {(r, i) for r, s, t, _ in rows if r is not None and t for i, x in enumerate(t.split("\n"), 1) if (s, x.lower()) in hot}


def test_repeated_lines_equal_brute_force(spark):
    rows = some_lines()
    got = {tuple(r) for r in lines.repeated_lines(corpus(spark, rows)).collect()}
    assert got == brute(rows, 8, 0.05) and len(got) > 30


@pytest.mark.parametrize("seed, cuts", [(7, [(0, 60), (60, 120), (110, None)]), (8, [(0, 1), (1, 200), (0, 30), (150, None)]), (9, [(0, None), (0, None)])])
def test_deltas_add_up(spark, seed, cuts):
    rows = some_lines(seed)
    state, on = None, set()
    for i, j in cuts:
        state, changed = lines.advance(state, lines.line_table(corpus(spark, rows[i:j])))
        for r in changed.collect():
            (on.add if r.now else on.discard)((r.source, r.key))
    every = rows[min(i for i, _ in cuts) :]
    whole, _ = lines.advance(None, lines.line_table(corpus(spark, every)))
    assert on == {tuple(r) for r in whole.frequent.collect()} == {tuple(r) for r in state.frequent.collect()}
    merged = state.counts.groupBy("source", "key").agg(F.sum("n").alias("n"))
    assert {tuple(r) for r in merged.collect()} == {tuple(r) for r in whole.counts.collect()}


def test_folding_equals_one_batch(spark):
    rows = some_lines(11)
    docs = corpus(spark, rows).withColumn("ingested_at", F.expr("case when hash(record_id, text) % 5 = 0 then null else timestamp'2016-01-15' + make_interval(0, 2 * abs(hash(record_id) % 4)) end"))
    assert docs.select(lines.period()).distinct().count() > 3
    got = {tuple(r) for r in lines.repeated_lines(docs, part=lines.period()).collect()}
    assert got == brute(rows, 8, 0.05) == {tuple(r) for r in lines.repeated_lines(docs).collect()}


def test_rebuild(spark):
    docs = corpus(spark, [("r", "s", "a\nShare\n\nb", "en"), ("q", "s", "c", "en")]).withColumn("gone", F.lit(1))
    got = lines.rebuild(docs, spark.createDataFrame([("r", 2)], "record_id string, line_no int")).collect()
    assert [(r.record_id, r.text) for r in got] == [("r", "a\n\nb")]


# --- 2, 5, 6 ---------------------------------------------------------------------------------------------------------

WORDS = [("en", w) for w in "the of and a to in is was it that for on with as he be at by his had not from they which were an or but all one there her".split()]
PROSE = "The old bridge was closed for the winter, and the people of the village had to take the long way by the mill. It was not easy, but they had done it before. "
SPAM = {
    "tags": "Tags: " + ", ".join(f"cheap {w}" for w in "boots tent drone ring sofa lamp mat case tea oil".split() * 3),
    "hash": " ".join("#cheap" + w for w in "boots tent drone ring sofa lamp".split() * 6),
    "urls": "\n".join(f"http://shop{i}.test/cheap-boots/{i}" for i in range(30)),
    "ads": "\n".join(f"Cheap boots sale Town - shop{i}.test" for i in range(30)),
    "dressed": "Looking for cheap boots? Our cheap boots shop sells cheap boots to every cheap boots buyer. Click cheap boots for cheap boots and cheap boots price. " * 4,
    "bare": "cheap boots best tent cheap boots cheap boots best tent used drone best tent cheap boots used drone used drone best tent cheap boots " * 6,
}
HONEST = {
    "prices": "\n".join(f"Item {i}\t{i}.50\t{i}%\t19{i:02d}" for i in range(10, 40)),
    "times": "\n".join(f"Town      1{i % 10}:20   1{i % 7}:05  *  bus" for i in range(30)),
    "recipe": "\n".join(f"{i * 10} g of the flour of the mill" for i in range(1, 30)),
    "code": "\n".join(f"var x{i}=function(y){{return a[{i}]||!1;}};" for i in range(30)),
    "refs": "\n".join(f"{i}. The history of the mill ({1900 + i})" for i in range(1, 30)),
    "csv": "\n".join(f"mill{i},4{i}1,yes,0.3{i},boots" for i in range(10, 40)),
    "prose": PROSE * 6,
    "verse": "\n".join(["the bridge was closed for the winter,", "and they had not from the mill,"] * 8),
}


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(1)
    rows = [(f"p{i}", "s", " ".join(rng.sample(PROSE.split() * 3, 60)) + ". " + PROSE * (1 + i % 4), "en") for i in range(120)]
    rows += [(f"spam-{k}", "s", v, "en") for k, v in SPAM.items()] + [(f"fine-{k}", "s", v, "en") for k, v in HONEST.items()]
    rows += [("void", "s", "", "en"), ("nil", None, None, None), (None, "s", "x", "en")]
    found = pages.page_profiles(corpus(spark, rows + rows[:3]), spark.createDataFrame(WORDS, "lang string, word string")).dropDuplicates(["record_id"]).cache()
    yield found
    found.unpersist()


def test_spam(judged):
    got = {r.record_id for r in spam.spam(judged).where("is_spam").collect()}
    assert got == {f"spam-{k}" for k in SPAM}


@pytest.mark.parametrize("figures, kept", [(spam.CURVE, False), (["common", "closed"], True), (list(spam.FIGURES), None)])
def test_spam_needs_the_deviations(judged, figures, kept, monkeypatch):
    """Without the deviations of a group of figures, what only they tell is not found; without any, nothing is."""
    real = spam.against_prose
    monkeypatch.setattr(spam, "against_prose", lambda *a, **k: real(*a, **k).withColumns({f"z_{x}": F.lit(0.0) for x in figures}))
    got = {r.record_id for r in spam.spam(judged).where("is_spam").collect()}
    assert got < {f"spam-{k}" for k in SPAM}
    assert not got if kept is None else ("spam-dressed" in got) == kept


def test_prose_in_no_language_is_no_reference(spark, judged):
    """Pages of tags in no language are found however many pages of sentences in no language there are."""
    rng = random.Random(2)
    made = ["".join(rng.sample("bdfgklmnprstvz", 5)) for _ in range(400)]
    odd = [(f"odd{i}", "s", " ".join(" ".join(rng.sample(made, 12)) + "." for _ in range(8)), None) for i in range(25)]
    tags = [(f"tags{i}", "s", "Tags: " + ", ".join(rng.sample(made, 100)), None) for i in range(3)]
    more = pages.page_profiles(corpus(spark, odd + tags), spark.createDataFrame(WORDS, "lang string, word string"))
    got = {r.record_id for r in spam.spam(judged.unionByName(more)).where("is_spam").collect()}
    assert {f"tags{i}" for i in range(3)} <= got


def test_quality_needs_the_distance(judged, monkeypatch):
    monkeypatch.setattr(quality, "fit", lambda stats: {})
    assert quality.quality(judged).where("not natural").count() == 0


def test_curve_is_a_least_squares_fit(spark):
    import numpy as np

    counts = [9, 5, 5, 2, 1, 1, 1]
    text = " ".join(w for w, n in zip("abcdefg", counts) for _ in range(n))
    p = pages.page_profiles(corpus(spark, [("r", "s", text, "en")]), spark.createDataFrame(WORDS, "lang string, word string"))
    got = spam.curves(p).first()
    steps = [(9, 1, 1), (5, 2, 3), (2, 1, 4), (1, 3, 7)]
    x = np.log([upto - (m - 1) / 2 for _, m, upto in steps])
    y, w = np.log([f for f, _, _ in steps]), np.array([m for _, m, _ in steps], float)
    slope, start = np.polyfit(x, y, 1, w=np.sqrt(w))
    assert abs(got.slope - slope) < 1e-9
    assert abs(got.residual - np.sqrt((w * (y - slope * x - start) ** 2).sum() / w.sum())) < 1e-9


def test_quality(judged):
    rows = {r.record_id: r for r in quality.quality(judged).collect()}
    assert {k for k, r in rows.items() if not r.natural} == {f"fine-{k}" for k in ("prices", "times", "recipe", "code", "refs", "csv")}
    for r in rows.values():
        assert abs(sum(r[f"part_{k}"] for k in quality.STATS) - r.distance2) < 1e-6 * max(1, r.distance2)
    assert rows["void"].natural and rows["nil"].n_words == 0


def test_quality_and_spam_of_nothing(spark):
    none = pages.page_profiles(corpus(spark, []), spark.createDataFrame(WORDS, "lang string, word string"))
    assert quality.quality(none).count() == spam.spam(none).count() == 0


@pytest.mark.parametrize(
    "line, want",
    [("- a plan for the station", "list"), ("– We went to the mill that day.", "prose"), ("3 x a bowl of soup", "list"), ("Town ... 241 • the market", "list"), ("a | 1 | 2 | 3 | b", "table"), ("QFGPunFYWjrh78zAU80Cu4yFU2TW2uUWbF4ml1Td7GMlqtekWJ", "junk"), ("zwqpvbj xjjffzz jpkphf bvvk xqxqj", "junk"), ("#^*&+ =-|#;~ <>%", "junk"), (".a{margin:1px;color:#fff}", "junk"), ("© 2016 Old Mill.", "note"), ("Hello there", "prose")],
)
def test_forms(line, want):
    assert form(line) == want


SLOTS = ["{{ name2 }}", "{{{LINK}}}", "{{ item.summary | default }}", "{% title %}", "<%= city %>", "${title}", "#{date}", "[[AUTHOR_NAME]]", "@@PRICE@@", "##SECTION##", "%PRICE_FROM%", "$price$", "__TITLE__", "!!missing city!!", "???companyName???", "[insert date here]", "[YOUR SECTION]", "[object Object]", "label.price.text", "&teaser;", "<TEASER>", "undefined"]


@pytest.mark.parametrize("slot", SLOTS)
def test_slots(slot):
    assert pages.slots(f"The old bridge {slot} was closed for the winter.") == 1


@pytest.mark.parametrize("line", ["In the handbook a slot written as {{ name }} is filled in later.", "This is undefined behaviour.", "It rose by 5 % and 6 % more", "He paid $5 and $6.", "Tom & Ann; more", "a < b and c > d", "snake__case__x"])
def test_no_slots(line):
    assert pages.slots(line) == 0


@pytest.mark.parametrize("line", ["Error 404", "Access denied", "You need to enable JavaScript to run this app.", "Bitte aktivieren Sie JavaScript in Ihrem Browser, um diese Seite anzuzeigen.", "Active JavaScript en su navegador para poder ver esta página.", "La page /a/b.html que vous demandez est introuvable.", "Bad gateway.", "Fehler 500"])
def test_messages(line):
    assert pages.evidence(line) == "said"


@pytest.mark.parametrize("line", ["Your headline goes here.", "Insert your text here and tell visitors what you offer.", "Add a price below.", "Title", "Dies ist ein Blindtext. Ersetzen Sie ihn.", "Página en construcción."])
def test_fillers(line):
    assert pages.evidence(line) == "filler"


@pytest.mark.parametrize("line", ["An error 404 seldom amuses a reader, says the manual.", "The bridge is closed for maintenance until the water has fallen, the council wrote.", "The course explains why a page should still be readable when JavaScript is switched off.", "The letter was marked as not found in the oldest catalogue of the library."])
def test_writing_about(line):
    assert pages.evidence(line) is None


def test_residue(spark):
    rows = [(f"n{i}", "s", PROSE * 2 + f"\nAll the news from our long old street, every single day number {i}", "en") for i in range(30)]
    notice = "All the news from our long old street, every single day number 99"
    rows += [("msg", "s", f"Access denied\n{notice}", "en"), ("slot", "s", PROSE + "We met {{ name2 }} there.", "en"), ("about", "s", PROSE * 3 + "\nAccess denied", "en"), ("asdf", "s", "asdf " * 30, "en"), ("void", "s", "", "en"), ("nil", None, None, None)]
    docs = corpus(spark, rows + rows[-6:])
    words = spark.createDataFrame(WORDS, "lang string, word string")
    assert {r.record_id for r in residue.residue(docs, words).collect()} == {"msg", "slot", "asdf"}
    # without the counts of the host the notice below the message outweighs it
    assert {r.record_id for r in residue.residue(docs, words, least=10**6).collect()} == {"slot", "asdf"}


def residue_of(spark, rows):
    return {r.record_id for r in residue.residue(corpus(spark, rows), spark.createDataFrame(WORDS, "lang string, word string")).collect()}


def test_message_below_recurrent_lines(spark):
    menu = "All the news from our long old street, every single day\nThe people of the village and all that they had by the mill"
    rows = [(f"n{i}", "s", f"{menu}\n{PROSE * 2}", "en") for i in range(20)]
    rows += [("late", "s", f"{menu}\nAccess denied", "en"), ("early", "s", f"Access denied\n{menu}", "en"), ("about", "s", f"{menu}\n{PROSE * 3}\nAccess denied", "en")]
    assert residue_of(spark, rows) == {"late", "early"}


@pytest.mark.parametrize("line", ["Posted by {{author}} on {{date}}", "(c) {{year}} {{site}}", "Tags: boots, {{tag_name}}, tent", "http://a.example/{{path}}/"])
def test_slots_of_notices_and_links(line):
    assert pages.profile("r", PROSE + "\n" + line, Lexicon({}))["slots"] >= 1


@pytest.mark.parametrize("line", ["http://a.example/%D0%BC%D0%BA%D0%AA%BC%BC%D0", "https://a.example/%aa%bb%cc"])
def test_encoded_addresses_have_no_slots(line):
    assert pages.slots(line) == 0


@pytest.mark.parametrize("line", ["Access\u200b denied", "Er\u00adror 404", "  Enter your name here", "Lorem\u00a0ipsum"])
def test_evidence_is_seen_through_odd_characters(line):
    words = Lexicon(dict(map(reversed, ((("en",), w) for _, w in WORDS))))
    assert not pages.unsuspicious(PROSE + "\n" + line, words)
    assert pages.unsuspicious(PROSE * 2 + "\nThe people of the mill had not said why it was so.", words)


@pytest.mark.parametrize("n", [1, 3, 5, 12])
def test_notices_of_any_length(n):
    notice = "© 2016 Old Mill. All rights reserved. "
    assert form((notice * n).strip()) == "note"
    assert form((PROSE * n + "Sign up for the newsletter. ").strip()) == ("note" if n < 1 else "prose")


@pytest.mark.parametrize("pad", [0, 30, 90, 91, 190])
def test_messages_at_the_old_limits(pad):
    """Texts of 200, 201, 400 and 401 characters and others with the same wording have the same verdict."""
    message = "Access denied. You do not have permission to view this page. " + "x" * pad
    for n in (200, 201, 400, 401, 800):
        text = (message + " ") * (n // len(message) + 1)
        kind, told = pages.evident(text.strip())
        assert kind == "said" and told > 0.5 * len(text)


def test_messages_in_long_lines(spark):
    message = "Access denied. You do not have permission to view this page. " + "The people of the mill had not said why it was so, and it was for all that they had done. " * 4
    demand = "This content requires JavaScript to be on in what you read it with, and it is off. " * 7
    about = PROSE * 4 + "The old page said access denied. " + PROSE * 2
    assert min(map(len, (message, demand, about))) > 400
    rows = [("message", "s", message.strip(), "en"), ("demand", "s", demand.strip(), "en"), ("about", "s", about.strip(), "en")]
    assert residue_of(spark, rows) == {"message", "demand"}


# --- 3 ---------------------------------------------------------------------------------------------------------------

TEXTS = {
    "de": "Die Müller müssen über die Brücke, während der Käse für die Gäste im Gewächshaus süß und heiß wird. ",
    "fr": "La société a préparé près de la rivière un déjeuner très agréable où l'été s'achève. ",
    "es": "El niño pagó después la canción más fácil de la estación, según él. ",
    "pl": "Ścieżka do górnego jeziora była dość długa, więc chłopiec zgubił żółtą książkę. ",
    "ru": "Старый мост через реку закрыли на зиму, поэтому жители деревни шли в город мимо мельницы. ",
}


#: As many letters as some pages of each language have.
LETTER_SAMPLES = [(i, k, v * 40) for i, (k, v) in enumerate(TEXTS.items())]


def misread(text, was, read):
    return bytes(text, was).decode(read, "replace") if read not in ("cp1252",) else "".join(bytes([b]).decode("cp1252") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in text.encode(was))


@pytest.mark.parametrize("lang", TEXTS)
@pytest.mark.parametrize("read", ["cp1252", "latin-1", "cp1250", "cp1251", "mac_roman", "cp437"])
def test_utf8_read_as_a_code_page_is_found_and_undone(lang, read):
    bad = misread(TEXTS[lang] * 3, "utf-8", read)
    assert charset.damage(bad) in ("utf8", "lost")
    if "�" not in bad:
        assert charset.restore_utf8(bad) == TEXTS[lang] * 3


def test_twice_misread():
    bad = misread(misread(TEXTS["fr"], "utf-8", "cp1252"), "utf-8", "cp1252")
    assert charset.restore_utf8(bad) == TEXTS["fr"]


@pytest.mark.parametrize("lang, was, read", [("ru", "koi8-r", "cp1251"), ("ru", "cp1251", "koi8-r"), ("ru", "cp1251", "latin-1"), ("fr", "cp1252", "mac_roman"), ("fr", "mac_roman", "cp1252"), ("pl", "iso8859-2", "latin-1"), ("pl", "cp1250", "cp1252")])
def test_swapped_code_pages_are_learned(spark, lang, was, read):
    sound = TEXTS[lang] * 4
    bad = misread(sound, was, read)
    assert charset.damage(bad) in ("swap", "utf8")
    samples = spark.createDataFrame(LETTER_SAMPLES, "sample_id long, lang string, text string")
    fixed = charset.repair(corpus(spark, [("r", "s", bad, lang), ("ok", "s", sound, lang)]), samples).collect()
    assert [r.record_id for r in fixed] == ["r"]
    same = sum(a == b for a, b in zip(fixed[0].text, sound)) / len(sound)
    assert same > 0.97


@pytest.mark.parametrize("text", [*TEXTS.values(), "In the phonetics class they drew ə, ŋ and ð on the board.", "The Ångström unit, the letter Ð and the name Ærø.", "¿Qué tal? ½ price, 25 °C, § 4 and a ™.", "“Yes,” it’s 5 € – no…", "25 m³, 3 km²", "Why? Because.", None, ""])
def test_sound_texts(text):
    assert charset.damage(text) is None


def test_a_single_spoiled_word(spark):
    samples = [("es", (TEXTS["es"] + "El niño del año, la señora y el otoño, el pequeño sueño; 5 € o £3.") * 40), *((k, v) for _, k, v in LETTER_SAMPLES)]
    rows = [("one", "s", "La calle de San OrdoÒo era larga.", "es"), ("euro", "s", "It was £483 or Ä66, then £532 or Ä98.", "en"), ("brand", "s", "The shop of MacÉwan was shut.", "en")]
    assert {r.record_id for r in charset.find_damaged(corpus(spark, rows), samples=samples).collect()} == {"one", "euro"}


def test_lost_characters_come_from_the_page(spark):
    good = "Le café de la société est fermé."
    raw = spark.createDataFrame([("r", bytearray(b"HTTP/1.1 200 OK\r\n\r\n<p>" + good.encode() + b"</p>"))], "record_id string, content binary")
    samples = spark.createDataFrame(LETTER_SAMPLES, "sample_id long, lang string, text string")
    docs = corpus(spark, [("r", "s", re.sub("é", "�", good), "fr"), ("x", "s", "caf�", "fr")])
    got = {r.record_id: (r.text, r.restored) for r in charset.repair(docs, samples, raw).collect()}
    assert got == {"r": (good, True), "x": ("caf�", False)}


@pytest.mark.parametrize("lang, page", [("fr", "cp1252"), ("pl", "iso8859-2"), ("ru", "cp1251"), ("ru", "koi8-r")])
def test_pages_declared_wrongly_are_decoded_by_their_letters(spark, lang, page):
    good = TEXTS[lang].strip()
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n<h1>A</h1><p>" + good.encode(page) + b"</p><p>other</p>"
    raw = spark.createDataFrame([("r", bytearray(body))], "record_id string, content binary")
    docs = corpus(spark, [("r", "s", good.encode(page).decode("utf-8", "replace"), lang)])
    got = charset.repair(docs, spark.createDataFrame(LETTER_SAMPLES, "sample_id long, lang string, text string"), raw).collect()
    assert [(r.text, r.restored) for r in got] == [(good, True)]


def test_the_mapping_is_learned_by_the_rounds():
    """Without rounds the rates are those of the start; with them the letters of the code page that was used stand out."""
    model = ciphers.Bigrams([(k, v) for _, k, v in LETTER_SAMPLES])
    contexts = ciphers.Judge(model).text(misread(TEXTS["pl"] * 4, "cp1250", "cp1252"))
    want = {bytes([b]).decode("cp1252"): bytes([b]).decode("cp1250") for b in "ąęłńśźż".encode("cp1250") if b not in (0x9D, 0x8D, 0x8F, 0x90, 0x81)}
    _, none = ciphers.learn(contexts, model, rounds=0)
    _, best = ciphers.learn(contexts, model)
    seen = [c for c in want if c in best]
    assert len(seen) >= 4 and all(best[c][0] == want[c] and best[c][1] > 0.5 for c in seen)
    assert all(rate <= 0.5 for _, rate in none.values())


def test_letters_are_counted_in_all_samples(spark):
    """The model of many samples is that of all of their texts, those beyond the first 5,000 included."""
    rows = [("en", "the mill")] * 5000 + [("PL ", "żółć, gęśl"), ("pl", "ź"), ("en", "")]
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)] + [(9000, None, "x"), (9001, "en", None)], "sample_id long, lang string, text string")
    got, want = ciphers.Bigrams(charset.bigram_counts(table)), ciphers.Bigrams(rows)
    assert got.langs == ["en", "pl"] and got.alphabet == want.alphabet and (got.log == want.log).all()
    ż, ó = got.at["ż"], got.at["ó"]
    assert got.log[1, ż, ó] > got.log[0, ż, ó] + 1


def test_other_scripts_have_few_contexts():
    model = ciphers.Bigrams([(k, v) for _, k, v in LETTER_SAMPLES])
    judge = ciphers.Judge(model)
    assert not judge.text("漢字仮名交じり文の長い文章です。 日本語の文字 " * 3)
    mixed = judge.text("漢é字 仮é名")
    assert {c for k in mixed for c in k} <= {"é", ciphers.OTHER, " "}


def test_nothing_is_found_without_a_gain(spark):
    seen = charset.unlikely(corpus(spark, [("r", "s", misread(TEXTS["fr"], "utf-8", "cp1252"), "fr")]), [(k, v) for _, k, v in LETTER_SAMPLES])
    learned = charset.rates(seen, [(k, v) for _, k, v in LETTER_SAMPLES])
    assert charset.judged(seen, learned).count() == 1
    assert charset.judged(seen, learned.withColumn("gain", F.lit(0.0))).count() == 0


# --- 4 ---------------------------------------------------------------------------------------------------------------

SAMPLES = {
    "en": "the old bridge over the river is closed because of the wind and the people walk the long way past the mill to the town every day of the week",
    "de": "die alte brücke über den fluss ist wegen des windes gesperrt und die leute gehen jeden tag der woche den langen weg an der mühle vorbei in die stadt",
    "fr": "le vieux pont sur la rivière est fermé à cause du vent et les gens font chaque jour de la semaine le long chemin près du moulin vers la ville",
}


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, k.upper() if i % 2 else k, v) for i, (k, v) in enumerate(list(SAMPLES.items()) * 4)]
    return spark.createDataFrame(rows, "sample_id long, lang string, text string")


def test_labels(spark):
    given = {"EN": "en", "eng": "en", "de-DE": "de", "fr_XX": "fr", "": None, " ": None, "unknown": None, "zh-cn": "zh", None: None, "ger": "de"}
    df = spark.createDataFrame([(k,) for k in given], "x string").select("x", langlabel.label(F.col("x")).alias("y"))
    assert {r.x: r.y for r in df.collect()} == given


def test_wrong_labels_and_foreign_lines(spark):
    path = "/root/testdata/sf0.001/lang_samples.parquet"
    if not os.path.exists(path):
        pytest.skip("needs the labelled samples")
    labelled = spark.read.parquet(path)
    held = {k: [r.text.replace("\n", " ") for r in labelled.where(f"lower(lang) = '{k}'").orderBy("sample_id").limit(9).collect()] for k in ("en", "de", "fr")}
    known = [t for v in held.values() for t in v]
    labelled = labelled.where(~F.replace("text", F.lit("\n"), F.lit(" ")).isin(known))
    en, de, fr = ("\n".join(held[k][:3]) for k in ("en", "de", "fr"))
    rows = [("ok", "s", en, "en-GB"), ("none", "s", de, None), ("wrong", "s", fr, "en"), ("mixed", "s", en + "\n\n" + held["de"][5], "en"), ("void", "s", "", None), ("nil", "s", None, None), ("digits", "s", "1 2 3", None), (None, "s", en, None)]
    got = {(r.record_id, f["line_no"], f["lang"]) for r in langlabel.wrong_labels(corpus(spark, rows), labelled).collect() for f in r.found}
    assert got == {("none", 0, "de"), ("wrong", 0, "fr"), ("mixed", 5, "de")}


def test_every_page_has_a_language(spark, labelled):
    rows = [(k, "s", v, None) for k, v in SAMPLES.items()]
    got = {r.record_id: r.lang for r in langlabel.languages(corpus(spark, rows), labelled).where("line_no = 0").collect()}
    assert got == {k: k for k in SAMPLES}


def test_limits_do_not_depend_on_the_order_of_the_languages():
    rng = random.Random(2)
    texts = [(k, " ".join(rng.sample(v.split(), 20))) for k, v in SAMPLES.items() for _ in range(12)]
    mixed = sorted(enumerate(texts), key=lambda x: (x[0] % 12, x[0]))
    dicts = langlabel.dictionaries(texts)
    assert langlabel.own_ratios(dicts, texts) == langlabel.own_ratios(dicts, [t for _, t in mixed])


def test_lines_are_packed_once(labelled):
    """A page that its label does not confirm is classified without packing a line again under a dictionary."""
    texts = [(r.lang, r.text) for r in labelled.collect()]
    c = langlabel.Classifier(langlabel.dictionaries(texts))
    packed = []

    class Packer:
        def __init__(self, lang, real):
            self.lang, self.real = lang, real

        def compress(self, data):
            packed.append((self.lang, data))
            return self.real.compress(data)

    c.packers = {k: Packer(k, v) for k, v in c.packers.items()}
    lines = langlabel.lines_of(SAMPLES["en"] + "\n" + SAMPLES["de"] + "\n\n" + SAMPLES["en"])
    ratios = dict.fromkeys(c.packers, 0.2)
    assert not langlabel.confirmed(lines, "en", c, ratios)
    rows = langlabel.classify_page("r", None, c, ratios, lines)
    assert [(r["line_no"], r["lang"]) for r in rows] == [(0, "en"), (2, "de")]
    assert len(packed) == len(set(packed))


@pytest.mark.parametrize("text", ["A  b\t1,2 c's\r\n\x1cD-e_f\x0b G", "Ä  b\t1,2 c’s\r\n\x1cD-e_f\x0b\u00a0G"])
def test_plain_lines(text):
    """What is packed of a line: words in lower case with single blanks between them, in ASCII as in other texts."""
    assert [(no, d.decode()) for no, d, _ in langlabel.lines_of(text)] == [(1, f" {text[0].lower()} b c{text[10]}s "), (2, " d e_f g ")]


def test_word_table():
    assert word_table([{"lang": "EN", "word": "The"}, {"lang": None, "word": "x"}]) == {"the": ("en",)}


def test_labels_of_pages_that_are_no_prose_by_the_whole_corpus(spark, labelled, tmp_path):
    from corpusmill.llm import problems

    rng = random.Random(1)
    rows = [(f"p{i}", "s", " ".join(rng.sample(PROSE.split() * 3, 60)) + ". " + PROSE * (1 + i % 4), "en") for i in range(120)]
    # the only page with something to correct is no prose by what the sound pages look like
    rows += [("refs", "s", HONEST["refs"], None)]
    corpus(spark, rows).write.parquet(f"{tmp_path}/corpus.parquet")
    labelled.write.parquet(f"{tmp_path}/lang_samples.parquet")
    spark.createDataFrame(WORDS, "lang string, word string").write.parquet(f"{tmp_path}/common_words.parquet")
    assert {r.record_id for r in langlabel.wrong_labels(spark.read.parquet(f"{tmp_path}/corpus.parquet"), labelled).collect()} >= {"refs"}
    assert "refs" in {r.record_id for r in problems.p5_found(spark, str(tmp_path)).collect()}
    assert {(r.record_id, r.line_no, r.lang) for r in problems.p4_found(spark, str(tmp_path)).collect() if r.line_no == 0} == set()


@pytest.mark.parametrize("off", [r"[\W\d_]", r"[^\w\s'’]"])
@pytest.mark.parametrize("text", ["", "a_b 1c\n\nd-e", "Œuvre d’été ½ x²\n\x1c ж٣­　", "日本 wörd\n� 7"])
def test_blanked(text, off):
    """Line by line the same words as by the pattern, in ASCII, in usual characters and in all others."""
    assert [x.split() for x in blanked(re.compile(off))(text).split("\n")] == [re.sub(off, " ", x).split() for x in text.split("\n")]
    assert words_of(text) == WORD.findall(text)


def test_wrong_labels_of_a_batch(labelled):
    """Pages judged together come out as one by one, and the dictionaries are not changed with every piece."""
    texts = [(r.lang, r.text) for r in labelled.collect()]
    dicts = langlabel.dictionaries(texts)
    ratios = dict.fromkeys(dicts, 0.2)
    mixed = SAMPLES["en"] + "\n" + SAMPLES["de"] + "\n\n" + SAMPLES["en"]
    pages_ = [("a", "en", mixed), ("b", "fr", SAMPLES["en"]), ("c", None, mixed), ("d", "en", None), ("e", "xx", SAMPLES["de"]), ("f", "de", SAMPLES["de"] + "\n" + SAMPLES["en"])]
    batch = [(f"{i}{n}", given, langlabel.lines_of(t and f"{t} {'ab' * n}")) for n in range(10) for i, given, t in pages_]
    c, packed = langlabel.Classifier(dicts), []

    class Packer:
        def __init__(self, lang, real):
            self.lang, self.real = lang, real

        def compress(self, data):
            packed.append(self.lang)
            return self.real.compress(data)

    c.packers = {k: Packer(k, v) for k, v in c.packers.items()}
    got = langlabel.wrong_of(batch, c, ratios)
    assert len(packed) > 50 and sum(a != b for a, b in zip(packed, packed[1:])) <= 4 * len(dicts)
    for (i, given, lines_), rows in zip(batch, got):
        alone = langlabel.Classifier(dicts)
        one = [] if given in dicts and langlabel.confirmed(lines_, given, alone, ratios) else langlabel.classify_page(i, None, alone, ratios, lines_)
        assert rows == [x for x in one if x["lang"] is not None and (x["line_no"] > 0 or x["lang"] != given)]


def test_one_pass_makes_labels_and_profiles(spark, labelled):
    docs = corpus(spark, [("a", "s", SAMPLES["en"] + "\n© 2011 Old Mill", "en"), ("b", "s", SAMPLES["de"], "en"), ("c", "s", None, None)])
    words = spark.createDataFrame(WORDS, "lang string, word string")
    both = {r.record_id: r.asDict() for r in langlabel.wrong_labels(docs, labelled, ("text",), words).collect()}
    assert {k: v["text"] for k, v in both.items()} == {"a": None, "b": SAMPLES["de"], "c": None}
    assert {k: v["found"] for k, v in both.items() if v["found"]} == {r.record_id: r.found for r in langlabel.wrong_labels(docs, labelled).collect()}
    for r in pages.page_profiles(docs, words).collect():
        assert r.asDict() == {k: both[r.record_id][k] for k in r.asDict()}


OPENINGS = [
    "The mill is open in May", "the­ mill is open", "The mi​ll is open", "Open at​ noon​ time today", "• The  mill | is open", "may we ask you", "Set out at dawn", "12 de may de 2011", "By Ann Lee, 3 May 2011",
    "(c) 2011 Old Mill. All rights", "© Old Mill. All rights reserved", "The views of Ann Lee are hers", "Photo: Ann Lee", "3D mills # de # open", "a~b c", "ÉTÉ À LA MER ici", "été a la mer", "---", "", "  x", "Maŕ y sol", "Die Mühle", "ΑΣ'Α ΟΔΟΣ",
]


@pytest.mark.parametrize("around", ["{}", "​ {} ", "» {} !", "{} {}", "x {}"])
def test_openings_are_those_of_the_key(spark, around):
    """A line whose opening is told has it in its key, too, so lines that open otherwise have other keys."""
    rows = lines.keyed(spark.createDataFrame([(around.replace("{}", x),) for x in OPENINGS], "line string"))
    rows = rows.select("line", lines.opening().alias("a"), lines.opening_of_key().alias("b")).collect()
    assert [r for r in rows if r.a is not None and r.a != r.b] == []
    assert sum(r.a is not None for r in rows) >= (0 if "\u200b" in around else 3)


def test_disputed_records_are_judged_by_all_lines(spark, monkeypatch):
    """Records whose verdict hangs on what recurs are found as by the counts of all lines, but lines that open otherwise are not
    counted."""
    said = "Access denied. You do not have permission to open this page."
    often = ["The old mill has a new roof and a wheel of oak that turns in the river all day.", "Share this page with all of your friends in town | Print | E-mail | and so on."]
    rows = [("hit", "s", "\n".join([said, *often]), None), ("not", "t", said + "\n" + often[0] * 3 + "\nA field of rye lies behind the mill.", None), ("slot", "s", "Dear {{ name }}\n" + PROSE, None), ("none", "s", PROSE, None)]
    rows += [(f"r{i}", "s", f"- {often[0]}\n{often[1].upper()}\n{PROSE} {i}", None) for i in range(5)]
    docs, words = corpus(spark, rows), spark.createDataFrame(WORDS, "lang string, word string")
    docs = docs.withColumn("target_uri", F.lit(None).cast("string"))
    expected = {r.record_id for r in residue.residue(docs, words).collect()}
    counted = []
    real = residue.recurrent
    monkeypatch.setattr(residue, "recurrent", lambda found, *a, **k: (counted.append(found.count()), real(found, *a, **k))[1])
    assert {r.record_id for r in residue.residue_among(docs, words, docs).collect()} == expected == {"hit", "slot"}
    every = docs.select(F.explode(F.split("text", "\n"))).count()
    assert counted and counted[0] < every
    among = docs.where("record_id in ('slot', 'none')")
    assert {r.record_id for r in residue.residue_among(docs, words, among).collect()} == {"slot"} and len(counted) == 1
