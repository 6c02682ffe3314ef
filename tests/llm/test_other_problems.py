import itertools
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import mainbody, mixing, packing, pii, tokens

# --- 7 ---------------------------------------------------------------------------------------------------------------


@given(st.lists(st.integers(-4, 4), min_size=1, max_size=8), st.integers(0, 10**6))
@settings(max_examples=80, deadline=None)
def test_the_cut_is_minimal(cost, seed):
    rng = random.Random(seed)
    n = len(cost)
    edges = [(i, j, rng.randrange(4)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]

    def energy(main):
        return sum(-c if m and c < 0 else c if not m and c > 0 else 0 for c, m in zip(cost, main)) + sum(w for i, j, w in edges if main[i] != main[j])

    best = min(energy(m) for m in itertools.product([False, True], repeat=n))
    assert abs(energy(mainbody.min_cut([float(c) for c in cost], edges)) - best) < 1e-9


LONG = "The old bridge was closed for the winter, and the people of the village had to take the long way by the mill. " * 2
PAGE = [
    ("We use cookies to improve your visit.", 0, "html.body.div.p.", False, False),
    ("Home | News | Shop", 12, "html.body.div.div.", False, False),
    ("Home > Town > The old bridge", 10, "html.body.div.div.", False, False),
    ("The old bridge", 0, "html.body.main.article.h1.", True, True),
    ("By Ann Lee, 3 May 2011", 0, "html.body.main.article.p.", False, False),
    (LONG, 0, "html.body.main.article.p.", False, True),
    ("Background", 0, "html.body.main.article.h3.", True, True),
    (LONG, 30, "html.body.main.article.p.", False, True),
    ("You may also like", 0, "html.body.aside.ul.h3.", True, False),
    ("Another story about the mill and the river that goes on for a while.", 68, "html.body.aside.ul.li.", False, False),
    (LONG, 0, "html.body.aside.ul.li.", False, False),
    ("Back to top", 0, "html.body.footer.p.", False, False),
    ("© 2016 Old Mill. All rights reserved.", 0, "html.body.footer.p.", False, False),
]


def test_the_classifier_is_fitted_on_the_regions():
    """Blocks that the regions label give the weights; held-out blocks without a region are told by them."""
    rng = random.Random(3)

    def page(region):
        main = [(LONG[: rng.randrange(60, 200)], rng.randrange(3), "article.p." if region else "div.p.", True) for _ in range(6)]
        edge = [(LONG[: rng.randrange(5, 45)], 30, "nav.li." if region else "div.li.", False) for _ in range(5)]
        return [{"text": t, "link_chars": min(n, len(t)), "tag_path": "html.body." + p, "is_heading": False, "cf_class": "neargood", "recurs": False, "main": m} for t, n, p, m in main + edge]

    labelled = [page(True) for _ in range(60)]
    weights = mainbody.fit(mainbody.np.concatenate([mainbody.features(p) for p in labelled]), trust=10.0)
    prior = mainbody.np.array(list(mainbody.PRIOR.values()))
    at = mainbody.FEATURES.index
    assert weights[at("length")] > prior[at("length")] and weights[at("mostly_links")] < prior[at("mostly_links")]
    assert all(weights[at(k)] == mainbody.PRIOR[k] for k in mainbody.KEPT)
    held = [page(False) for _ in range(40)]
    right = [m == b["main"] for p in held for b, m in zip(p, mainbody.label_page(p, weights))]
    assert sum(right) > 0.97 * len(right)
    assert (mainbody.fit(mainbody.np.zeros((0, len(prior)))) == prior).all()


def test_main_body(spark):
    schema = "record_id string, idx int, text string, link_chars int, tag_path string, is_heading boolean, cf_class string, class string, key string, recurs int"
    rows = [("r", i, t, n, p, h, "good", None, "k", 1) for i, (t, n, p, h, _) in enumerate(PAGE)]
    rows += rows[:4] + [("nil", 0, None, None, None, None, None, None, None, None), (None, 0, "x", 0, "p.", False, "", None, None, None), ("q", None, "x", 0, "p.", False, "", None, None, None)]
    got = {(r.record_id, r.idx): r.main for r in mainbody.main_body(spark.createDataFrame(rows, schema)).collect()}
    assert [got["r", i] for i in range(len(PAGE))] == [m for *_, m in PAGE]
    assert got["nil", 0] is False and len(got) == len(PAGE) + 1
    assert mainbody.main_body(spark.createDataFrame([], schema)).count() == 0


# --- 8 ---------------------------------------------------------------------------------------------------------------


@given(st.lists(st.tuples(st.integers(0, 60), st.sampled_from("abc")), max_size=60), st.integers(1, 30))
@settings(max_examples=80, deadline=None)
def test_packing_keeps_everything(items, capacity):
    items = [(i, s, n) for i, (n, s) in enumerate(items)]
    placed = packing.pack(items, capacity, {"a": 0.5, "b": 0.3, "c": 0.2})
    load, pieces = {}, {}
    for b, i, p, first, n in placed:
        load[b] = load.get(b, 0) + n
        pieces.setdefault(i, []).append((p, first, n))
    assert max(load.values(), default=0) <= capacity
    for i, _, size in items:
        got = sorted(pieces[i])
        assert sum(n for *_, n in got) == size and [f for _, f, _ in got] == [sum(n for *_, n in got[:k]) for k in range(len(got))]
        assert len(got) == 1 or size > capacity
    assert set(load) == set(range(len(load)))


def test_packing_fills_and_mixes():
    rng = random.Random(2)
    items = [(i, "abc"[i % 3], rng.randrange(1, 400)) for i in range(3000)]
    total = {s: sum(n for _, k, n in items if k == s) for s in "abc"}
    whole = sum(total.values())
    placed = packing.pack(items, 2048, {s: n / whole for s, n in total.items()})
    bins = max(p[0] for p in placed) + 1
    assert 1 - whole / (bins * 2048) < 0.01
    source = {i: s for i, s, _ in items}
    near = 0
    for b in range(bins - 20):
        shares = dict.fromkeys("abc", 0)
        for p in placed:
            if p[0] == b:
                shares[source[p[1]]] += p[4]
        near += all(abs(shares[s] / 2048 - total[s] / whole) < 0.2 for s in "abc")
    assert near > 0.9 * (bins - 20)


@pytest.mark.parametrize("capacity", [64, 256, 2048])
def test_windows_are_mixed_from_the_first_to_the_last(capacity):
    """Split items are spread, too: in every quarter each source has nearly its share of all tokens."""
    rng = random.Random(5)
    items = [(i, rng.choice("aaaabbc"), rng.choice([rng.randrange(1, 60), rng.randrange(100, 1500)])) for i in range(6000)]
    total = {s: sum(n for _, k, n in items if k == s) for s in "abc"}
    whole = sum(total.values())
    placed = packing.pack(items, capacity, {s: n / whole for s, n in total.items()})
    bins = max(p[0] for p in placed) + 1
    source = {i: s for i, s, _ in items}
    for quarter in range(4):
        here = dict.fromkeys("abc", 0)
        for b, i, _, _, n in placed:
            if b * 4 // bins == quarter:
                here[source[i]] += n
        assert sum(abs(here[s] / sum(here.values()) - total[s] / whole) for s in "abc") / 2 < 0.05


def test_packing_in_parts(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", None]), rng.randrange(0, 300)) for i in range(500)]
    df = spark.createDataFrame([(i, s or "", n) for i, s, n in rows] + [(None, "a", 5), (3, "a", 9)], "doc_id long, source string, tokens long").dropDuplicates(["doc_id"])
    boxes = spark.createDataFrame([(1, 100), (2, 256)], "container_id int, capacity_tokens int")
    got = packing.packing(df, boxes, part_tokens=10_000)
    want = sum(r.tokens for r in df.where("doc_id is not null").collect())
    for r in packing.fill_report(got).collect():
        assert r.tokens == want and r.unused < 0.1
    assert got.where("container_id = 1").select("doc_id").distinct().count() == 500
    assert all(r.distance < 0.15 for r in packing.mixture_report(got, df).collect() if r.quarter < 2)
    assert packing.packing(df.limit(0), boxes).count() == 0
    with pytest.raises(ValueError):
        packing.packing(df, spark.createDataFrame([(1, None)], "container_id int, capacity_tokens int"))


# --- 9 ---------------------------------------------------------------------------------------------------------------


def test_exponent():
    budget, a, _ = mixing.solve({"x": 0.5, "y": 0.5, "gone": 0.3, "out": None}, {"x": 100, "y": 1000})
    assert a == 1.0 and abs(budget["x"] - 100) < 1e-6 and abs(budget["y"] - 100) < 1e-6
    budget, a, _ = mixing.solve({"x": 0.5, "y": 0.5}, {"x": 100, "y": 1000}, total=600)
    assert 0 < a < 1 and abs(sum(budget.values()) - 600) < 1e-3 and abs(budget["x"] - 100) < 1
    assert mixing.solve({}, {})[0] == {}
    budget, a, _ = mixing.solve({"x": 0.5, "y": 0.5}, {"x": 100, "y": 1000}, total=5000)
    assert abs(sum(budget.values()) - 1100) < 1e-6


def test_temperature():
    have, twice = {"x": 100, "y": 1000, "z": 5000}, {"x": 2, "y": 2, "z": 2}
    wanted = mixing.entropy_of({"x": 0.2, "y": 0.3, "z": 0.5})
    natural = mixing.entropy_of({s: n / 6100 for s, n in have.items()})
    budget, a, entropy = mixing.temperature(have, {"x": 50, "y": 50, "z": 50}, 6100, wanted)
    assert 0 < a < 1 and natural < wanted and abs(entropy - wanted) < 1e-6 and abs(sum(budget.values()) - 6100) < 1e-3
    # the limit of repeats raises the exponent of a given total, so the mix comes nearer to the natural one
    budget, b, entropy = mixing.temperature(have, twice, 6100, wanted)
    assert a < b < 1 and natural < entropy < wanted and abs(max(budget[s] / have[s] for s in have) - 2) < 1e-3
    # without a total the exponent stays, and the source that is scarcest is used as often as it may
    budget, c, entropy = mixing.temperature(have, twice)
    assert 0 < c < 1 and abs(entropy - (natural + mixing.math.log(3)) / 2) < 1e-6 and abs(max(budget[s] / have[s] for s in have) - 2) < 1e-6
    assert mixing.temperature(have, twice, entropy=0.0)[1] > 1 - 1e-6 and mixing.temperature({}, {}) == ({}, 1.0, 0.0)
    budget, a, _ = mixing.temperature({"x": 10, "y": 10}, {}, entropy=5.0)
    assert a == 0.0 and budget == {"x": 10.0, "y": 10.0}


def test_mix(spark):
    rng = random.Random(3)
    rows = [(i, s, rng.randrange(20, 60)) for i, s in enumerate(["a"] * 200 + ["b"] * 60 + ["c"] * 30 + ["d"] * 5)] + [(1000, "a", 0), (None, "a", 4), (1, "a", 30)]
    df = spark.createDataFrame(rows, "doc_id long, source string, tokens long")
    goals = spark.createDataFrame([("A", 0.5, 2), ("b", 0.3, 2), ("c ", 0.2, 3), ("d", None, None), ("nobody", 0.1, 4)], "source string, target_share double, max_repeats int")
    uses, report = mixing.mix(df, goals, block_tokens=500)
    got = {r.source: r for r in report.collect()}
    for s, share in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
        assert abs(got[s].actual_share - share) < 0.02
        assert got[s].most_uses <= got[s].max_repeats
    assert got["d"].mixed_tokens == got["nobody"].mixed_tokens == 0
    times = {}
    for r in uses.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert max(times.values()) <= 3 and 1000 not in times and None not in times
    again = {tuple(r) for r in mixing.mix(df.repartition(7), goals, block_tokens=500)[0].collect()}
    assert again == {tuple(r) for r in uses.collect()} or len(again) == uses.count()
    assert mixing.mix(df.limit(0), goals)[0].count() == 0
    _, report = mixing.mix(df, goals, block_tokens=500, tempered=True)
    got = {r.source: r for r in report.collect()}
    assert 0 < got["a"].exponent < 1 and got["c"].actual_share > got["c"].natural_share + 0.02 and got["a"].actual_share < got["a"].natural_share - 0.02
    assert all(r.most_uses <= (r.max_repeats or 1) for r in got.values()) and got["d"].mixed_tokens == 0


def test_tokens(spark):
    docs = spark.createDataFrame([(1, "A_b", "hello world"), (2, None, None), (3, " X ", "")], "doc_id long, source string, text string")
    assert {(r.doc_id, r.source, r.tokens) for r in tokens.token_table(docs).collect()} == {(1, "a-b", 2), (2, "", 0), (3, "x", 0)}


# --- 10 --------------------------------------------------------------------------------------------------------------

GIVEN, FAMILY = frozenset(["ann", "bo", "jörg"]), frozenset(["lee", "lindqvist", "doe-roe"])
CASES = [
    ("email", "Write to ⟦ann.lee@mail.example.org⟧."),
    ("email", "Write to ⟦ann+x＠example.org⟧ now"),
    ("email", "Mail: ⟦info (at) old-mill (dot) example⟧"),
    ("email", "Mail: ⟦ann DOT lee AT mill DOT example⟧"),
    ("phone", "Call ⟦+44 (0)20 7946-0481⟧."),
    ("phone", "Tel: ⟦2025550143⟧"),
    ("phone", "Tel: ⟦1-613-555-0102 ext. 64⟧"),
    ("phone", "Telefon ⟦030/23125-882⟧"),
    ("phone", "al ⟦(+34) 600000610⟧"),
    ("phone", "⟦01.99.00.03.48⟧"),
    ("id_number", "Passport ⟦QQ 11 99 75 B⟧ was found"),
    ("id_number", "my insurance number (⟦X35008324⟧), which"),
    ("id_number", "mon numéro de sécurité sociale est ⟦2 52 09 99 034 996 83⟧."),
    ("id_number", "Meine Ausweisnummer lautet ⟦LW2652S40C⟧."),
    ("address", "I live at ⟦Flat 25, 131 Old Ferry Rd⟧."),
    ("address", "I live at ⟦182A W. Thistle Ave⟧ and"),
    ("address", "à ⟦217 bis impasse de l'Ancre⟧."),
    ("address", "wohne in der Wohnung ⟦Lindenweg 220⟧."),
    ("address", "a ⟦Calle del Olmo, 121⟧."),
    ("name", "Then ⟦Ann Lee⟧ came"),
    ("name", "Dr. ⟦Bo T. Lindqvist⟧ came"),
    ("name", "⟦B. Lee⟧ came"),
    ("name", "As ⟦Lee, Ann⟧ said"),
    ("name", "⟦ANN-BO DOE-ROE⟧ came"),
    ("name", "I am ⟦Zyx Qwertz⟧ and I live here"),
]
NOTHING = ["Order 487-214-014 was shipped", "The book has the number 978-0-00-187-36", "from 2014-06-8 until 2016-09-77", "The server answered from 192.0.2.15.", "Article number 60002000661", "La commande n° 094-99-13", "says @tidewatch92.", "The Lee Foundation paid", "On Saint Ann's Day", "Our cat Bo sleeps", "in der Hafenstraße.", "The rate fell from 0.345596 to 0.751282.", "about 30 metres", "", None]


@pytest.mark.parametrize("kind, marked", CASES)
def test_pieces(kind, marked):
    start = marked.index("⟦")
    text = marked.replace("⟦", "").replace("⟧", "")
    got = pii.find(text, GIVEN, FAMILY)
    assert [(a, k) for a, _, k in got] == [(start, kind)]
    if kind != "address":
        assert text[got[0][0] : got[0][1]] == marked[start + 1 : marked.index("⟧")]


@pytest.mark.parametrize("text", NOTHING)
def test_no_pieces(text):
    assert pii.find(text, GIVEN, FAMILY) == []


def test_redaction_changes_nothing_else():
    maker = pii.Surrogates(b"k")
    text = "Ann Lee (ann.lee@example.org, 202-555-0143) met Bo Lee and ANN LEE. Ann Lee left, said A. Lee and Lee, Ann."
    found = pii.find(text, GIVEN, FAMILY)
    out, made = pii.redact(text, found, maker)
    names = re.findall(r"\[NAME ([^\]]+)\]", out)
    assert names[0] == names[3] and names[2] == names[0].upper() and names[1] != names[0]
    assert names[0].split()[1] == names[1].split()[1]  # one family keeps one name
    assert names[4] == f"{names[0][0]}. {names[0].split()[1]}"  # an initial stays that of the name
    assert names[5] == ", ".join(reversed(names[0].split()))
    rest = re.sub(r"\[[A-Z_]+ [^\]]+\]", "#", out)
    assert rest == "# (#, #) met # and #. # left, said # and #."
    assert pii.redact(text, found, maker) == (out, made) != pii.redact(text, found, pii.Surrogates(b"other"))
    with pytest.raises(ValueError):
        pii.Surrogates(b"")


def test_surrogates_keep_distinct_people_apart():
    maker = pii.Surrogates(b"k")
    page = pii.Page(maker, {})
    made = {page.replace(f"Person{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]} Family{'abcdefghij'[i // 100]}{'klmnopqrst'[i % 10]}", "name") for i in range(1000)}
    assert len(made) == 1000
    phone = maker.code("phone", "+44 (0)20 7946-0481")
    assert len(phone) == 19 and phone[0] == "+" and phone != "+44 (0)20 7946-0481"


def test_surrogates_keep_gender_script_and_case():
    page = pii.Page(pii.Surrogates(b"k"), {"ingrid": "f", "robert": "m", "andrea": "m"})
    assert page.replace("Ingrid Holm", "name").split()[0].endswith("a") and not page.replace("Andrea Holm", "name").split()[0].endswith("a")
    assert page.replace("Robert Holm", "name").split()[0][-1] not in "aeiou"
    assert re.fullmatch("[А-Я][а-я]+ [А-Я][а-я]+", page.replace("Анна Петрова", "name")) and page.replace("ROBERT HOLM", "name").isupper()
    assert page.replace("Mary-Ann Holm", "name").count("-") == 1 and re.fullmatch(r"[A-Z]\. [A-Z]\. \w+", page.replace("R. J. Holm", "name"))


def test_names_are_learned(spark):
    rng = random.Random(1)
    givens, families = [f"{c}ra{d}" for c in "BCDF" for d in "nmk"], [f"{c}olm{d}" for c in "GHJK" for d in "er"]
    rows = [(i, f"Yesterday {rng.choice(givens)} {rng.choice(families)} met us in Port Selwick. The Mill was shut.") for i in range(200)] + [(999, None), (998, "")]
    rows += [(1000 + i, f"Mrs {givens[0]} {families[0]} and Herr {givens[1]} {families[1]} left.") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = spark.createDataFrame([("en", "the"), ("en", "yesterday"), ("en", "mrs"), ("de", "herr")], "lang string, word string")
    given, family = pii.name_tables(docs, words)
    assert {r.w: r.g for r in given.collect()} == {g.lower(): {givens[0]: "f", givens[1]: "m"}.get(g) for g in givens}
    assert {r.w for r in family.collect()} == {f.lower() for f in families}
    out = pii.redacted(docs, words, "secret")
    found = {tuple(r) for r in pii.entities(out).collect()}
    assert len(found) == 206 and out.where("doc_id >= 998 and doc_id < 1000 and size(pieces) = 0").count() == 2
    # more names than are sent to all tasks come by a join, with the same result
    rows, shared = pii.with_names(docs, words, "doc_id", "text", most=3)
    assert shared is None
    got = {(r.doc_id, a, k) for r in rows.collect() for a, _, k in pii.find(r.text, *(lambda x: (x.given, x.family))(pii._lexicon_of(r.asDict(recursive=True), None)))}
    assert got == {(x[0], x[1], x[3]) for x in found}
    report = {r.kind: r for r in pii.coreference(pii.entities(out)).collect()}
    assert report["name"].split_entities == report["name"].shared_surrogates == 0 and report["name"].mentions == 206
    assert pii.redacted(docs.limit(0), words, "secret").count() == 0
