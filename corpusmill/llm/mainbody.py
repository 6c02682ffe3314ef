"""Problem 7: main body and boilerplate of pages, by minimum cut.

Each block is a node. A classifier's cost of calling it main body or boilerplate becomes the capacity of its edges to
the two terminals; edges between blocks, neighbours in the page and the nearest earlier block of the same DOM path,
carry the cost of telling them apart. The minimum cut labels the page. The classifier is a logistic regression on link
density, length, wording of notices and teaser headings, and how many records have the same block. It is fitted on a
bounded sample of pages, by the blocks that a region of the DOM labels (article and main against nav, header, footer and
aside), with a prior around the weights stated below, which decide where no page has regions.

Defined results: blocks repeated under one (record_id, idx) count once; null texts are empty blocks and boilerplate;
a page of one block is judged by its own costs; rows without record_id or idx are left out.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.codepages import restore_utf8
from corpusmill.llm.lines import keyed
from corpusmill.llm.textkit import clean, notice
from corpusmill.plans.shared import materialize

#: Headings of teasers, advertisements and side columns in nine languages, lower case.
ASIDE = frozenset(
    """you may also like|advertisement|advertising|latest comments|recent comments|archive by month|related stories|related articles|our partners|popular tags|most read|read more|more stories|sponsored|categories|archives|tag cloud|recent posts
das könnte sie auch interessieren|anzeige|werbung|neueste kommentare|letzte kommentare|archiv nach monaten|ähnliche artikel|verwandte artikel|unsere partner|beliebte schlagwörter|beliebte themen|meistgelesen|weiterlesen
vous aimerez aussi|à lire aussi|publicité|derniers commentaires|commentaires récents|archives par mois|articles liés|articles similaires|nos partenaires|mots-clés populaires|les plus lus
también le puede interesar|también te puede interesar|le puede interesar|publicidad|últimos comentarios|archivo por meses|archivo mensual|artículos relacionados|nuestros socios|nuestros colaboradores|etiquetas populares|lo más leído
potrebbe interessarti anche|potrebbe interessarti|ti potrebbe interessare|pubblicità|ultimi commenti|archivio per mese|articoli correlati|i nostri partner|tag popolari|i più letti
também pode gostar|poderá também gostar|publicidade|últimos comentários|arquivo por mês|artigos relacionados|os nossos parceiros|etiquetas populares|mais lidos|os mais lidos
misschien vindt u dit ook leuk|lees ook|advertentie|laatste reacties|recente reacties|archief per maand|verwante artikelen|gerelateerde artikelen|onze partners|populaire tags|meest gelezen
może cię zainteresować|może ci się spodobać|zobacz także|reklama|najnowsze komentarze|ostatnie komentarze|archiwum według miesięcy|podobne artykuły|powiązane artykuły|nasi partnerzy|popularne tagi|najczęściej czytane
вам также может понравиться|читайте также|реклама|последние комментарии|архив по месяцам|похожие статьи|похожие материалы|наши партнёры|популярные метки|популярные теги|самое читаемое""".replace("\n", "|").split("|")
)
#: Wording of cookie and legal notices and of footers, lower case, anywhere in a block.
LEGAL = (
    "cookie", "small files on your device", "your privacy matters", "accepts no liability", "keine haftung", "décline toute responsabilité", "no se hace responsable", "non si assume", "declina ogni responsabilità", "não se responsabiliza", "niet aansprakelijk", "aanvaardt geen aansprakelijkheid", "nie ponosi odpowiedzialności", "не несёт ответственности", "не несет ответственности",
    "site built and looked after", "printed from the online edition", "terms of use", "nutzungsbedingungen", "conditions d'utilisation", "condiciones de uso", "condizioni d'uso", "condições de utilização", "termos de utilização", "gebruiksvoorwaarden", "warunki korzystania", "regulamin", "условия использования",
    "datenschutz |", "| datenschutz", "aviso legal", "mentions légales", "note legali", "aviso de privacidade", "polityka prywatności", "конфиденциальность", "speichern auf ihrem gerät", "dateien auf ihrem gerät", "plików cookie", "файлы cookie", "einverstanden",
)
TOP = frozenset("back to top|nach oben|haut de page|volver arriba|torna su|torna all'inizio|voltar ao topo|voltar ao início|terug naar boven|naar boven|do góry|powrót do góry|wróć na górę|наверх|к началу страницы|вернуться наверх".split("|"))
_AD = re.compile(r"^(?:advertisement|anzeige|werbung|publicité|publicidad|pubblicità|publicidade|advertentie|reklama|реклама|sponsored)\s*:", re.I)
_CRUMB = re.compile(r"^[^\n>»›/]{1,30}(?: [>»›/] [^\n>»›/]{1,60}){1,6}$")
_MENU = re.compile(r"^[^|\n]{1,32}(?: \| [^|\n]{1,32}){2,}$")
_ITEM = re.compile(r"^(?:[-–*•·]|\d{1,3}[.)])\s\S")
_HEADING = re.compile(r"h[1-6]\.$")


def base(path: str) -> str:
    """The DOM path without a closing heading, so that a heading stands with the blocks under it."""
    return _HEADING.sub("", path)


def legal(low: str) -> bool:
    """Whether a piece of text has the wording of a cookie or legal notice or of a footer."""
    return any(x in low for x in LEGAL)


#: What the classifier sees of a block, with the weights that it starts from: positive for main body.
PRIOR = {
    "length": 1.0, "links": -2.0, "mostly_links": -3.0, "good": 0.5, "quote": 1.0, "empty": -2.0,
    "title": 4.0, "heading": 2.0, "aside_heading": -6.0, "under_aside": -4.0, "notice": -9.0, "legal": -9.0, "advert": -8.0, "crumbs": -6.0, "cut_off": -2.5,
    "recurs_long": -5.0, "recurs_linked": -2.0, "recurs_short": -0.7, "item": 1.2, "short": -0.6,
    "edge_region": -3.5, "main_region": 2.0,
}
FEATURES = list(PRIOR)
#: The regions of the DOM: where there are any, they label blocks for the fit of all other weights. What recurs among pages
#: is known from other pages, not from a block's own, so its weights stay, too.
REGIONS = ("edge_region", "main_region")
KEPT = (*REGIONS, "recurs_long", "recurs_linked", "recurs_short")


def features(blocks: list[dict]) -> np.ndarray:
    """A row a block in page order, a column a feature."""
    at = {k: i for i, k in enumerate(FEATURES)}
    out = np.zeros((len(blocks), len(FEATURES)))
    under: str | None = None  # DOM path of the blocks under a teaser heading
    waiting = False
    title_at: str | None = None  # container of the page's title
    for row, b in zip(out, blocks):

        def put(name: str, value: float = 1.0, row=row) -> None:
            row[at[name]] = value

        text, path, n = b["text"], b["tag_path"], len(b["text"])
        low = text.lower()
        dense = b["link_chars"] / n if n else 1.0
        if waiting:
            under, waiting = base(path), False
        elif under is not None and base(path) != under:
            under = None
        title = low.strip(" .:»>|…-–")
        if not n:
            put("empty")
        if dense < 0.6:
            put("length", min(2.6, n / 80))
            put("links", dense)
        else:
            put("mostly_links", dense)
        if b["cf_class"] == "good":
            put("good")
        if "nav." in path or "footer." in path or "aside." in path or "header." in path:
            put("edge_region")
        if "article." in path or "main." in path:
            put("main_region")
        if "blockquote." in path:
            put("quote")
        if b["is_heading"] and title not in ASIDE:
            put("title" if path.endswith(("h1.", "h2.")) else "heading")
            title_at = title_at or base(path)
        if title in ASIDE:
            put("aside_heading")
            # a label inside the article's own container stands over no list of teasers
            inside = b["is_heading"] and title_at is not None and base(path) == title_at
            under, waiting = None, not inside
        elif under is not None:
            put("under_aside")
        if notice(low.strip()):
            put("notice")
        if title in TOP or notice(low, legal):
            put("legal")
        if _AD.match(text) or ":" in low[:40] and low.split(":")[0].strip() in ASIDE:
            put("advert")
        if dense > 0 and _CRUMB.match(text) or _MENU.match(text):
            put("crumbs")
        if low.endswith(("…", "...")) and n <= 90:
            put("cut_off")
        if b["recurs"]:
            put("recurs_long" if n >= 60 else "recurs_linked" if dense > 0 else "recurs_short")
        if n < 40 and not b["is_heading"] and dense < 0.2:
            # an item of a list without links belongs to the text around it
            put("item" if _ITEM.match(text) and dense == 0 and under is None else "short")
    return out


def fit(x: np.ndarray, trust: float = 100.0, rounds: int = 50) -> np.ndarray:
    """Weights of the features by logistic regression on the blocks that a region of the DOM labels, as the most likely
    ones under a normal prior around PRIOR; ``trust`` is its precision in labelled blocks of a feature.

    Regions and recurrence are left out of the regression; their own weights stay. Blocks of the main
    region that their wording gives away are no main body wherever they stand, so these label nothing.
    """
    prior = np.array([PRIOR[k] for k in FEATURES])
    edge, main = (x[:, FEATURES.index(k)] > 0 for k in REGIONS)
    told = (x[:, [FEATURES.index(k) for k in ("notice", "legal", "advert", "aside_heading", "under_aside", "crumbs")]] > 0).any(1)
    used = edge ^ main & ~told
    y = (main & ~edge)[used].astype(float)
    z = x[used].copy()
    z[:, [FEATURES.index(k) for k in KEPT]] = 0.0
    if not len(z):
        return prior
    w = prior.copy()
    for _ in range(rounds):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (y - p) - trust * (w - prior)
        hessian = (z * (p * (1 - p))[:, None]).T @ z + trust * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w


def costs(blocks: list[dict], weights: np.ndarray | None = None) -> list[float]:
    """Evidence for main body (positive) or boilerplate (negative) of each block in page order, in log odds."""
    w = np.array([PRIOR[k] for k in FEATURES]) if weights is None else weights
    return (features(blocks) @ w).tolist()


def min_cut(cost: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side of the minimum cut: main body. Dinic's algorithm."""
    n = len(cost)
    s, t = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    cap: list[float] = []

    def add(a: int, b: int, c: float, back: float) -> None:
        head[a].append(len(to))
        to.append(b)
        cap.append(c)
        head[b].append(len(to))
        to.append(a)
        cap.append(back)

    for i, c in enumerate(cost):
        if c > 0:
            add(s, i, c, 0.0)
        elif c < 0:
            add(i, t, -c, 0.0)
    for a, b, w in edges:
        add(a, b, w, w)
    eps = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            v = queue.popleft()
            for e in head[v]:
                if cap[e] > eps and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        at = [0] * (n + 2)
        while True:  # a blocking flow, path by path, without recursion
            path: list[int] = []
            v = s
            while v != t:
                while at[v] < len(head[v]):
                    e = head[v][at[v]]
                    if cap[e] > eps and level[to[e]] == level[v] + 1:
                        break
                    at[v] += 1
                if at[v] < len(head[v]):
                    path.append(head[v][at[v]])
                    v = to[path[-1]]
                elif v == s:
                    break
                else:
                    e = path.pop()
                    v = to[e ^ 1]
                    at[v] += 1
            if v != t:
                break
            flow = min(cap[e] for e in path)
            for e in path:
                cap[e] -= flow
                cap[e ^ 1] += flow


def smoothness(blocks: list[dict], cost: list[float], near: float = 0.5, same: float = 1.3) -> list[tuple[int, int, float]]:
    """Neighbours in the page, more where they share the DOM path; and the nearest earlier block of the same path.
    A block that its wording gives away, such as a byline, says little about its neighbours."""
    edges = []
    told = [0.15 if c <= -6.0 else 1.0 for c in cost]
    last: dict[str, int] = {}
    for i, b in enumerate(blocks):
        p = base(b["tag_path"])
        if i:
            q = base(blocks[i - 1]["tag_path"])
            edges.append((i - 1, i, told[i - 1] * told[i] * (same if p == q else near if p.split(".")[:3] == q.split(".")[:3] else near / 2)))
        j = last.get(p)
        if j is not None and j < i - 1:
            edges.append((j, i, told[i] * told[j] * near / (1 + 0.5 * (i - j - 1))))
        if told[i] == 1.0:
            last[p] = i
    return edges


def label_page(blocks: list[dict], weights: np.ndarray | None = None) -> list[bool]:
    """Which blocks are main body."""
    cost = costs(blocks, weights)
    return min_cut(cost, smoothness(blocks, cost))




def _page(rows: list[dict]) -> list[dict]:
    """The blocks of a page out of its rows. A row with ``recurs`` says that the block of its idx recurs; of several blocks
    of one idx the smallest by text and path counts."""
    page: list[dict] = []
    recurs = {r["idx"] for r in rows if r["recurs"]}
    for r in rows:
        if r["recurs"]:
            continue
        if page and page[-1]["idx"] == r["idx"]:
            if ((r["text"] or ""), (r["tag_path"] or "")) < ((page[-1]["text"] or ""), (page[-1]["tag_path"] or "")):
                page[-1] = r
        else:
            page.append(r)
    for b in page:
        text = b["text"] or ""
        b["recurs"] = b["idx"] in recurs
        b["text"] = clean(text if text.isascii() else restore_utf8(text)).strip()
        b["tag_path"] = (b["tag_path"] or "") + ("" if (b["tag_path"] or "").endswith(".") else ".")
        b["link_chars"] = b["link_chars"] or 0
        b["is_heading"] = bool(b["is_heading"])
    return page


def _by_page(done: Callable[[list[dict]], list[dict]], schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function over sorted batches from one over the blocks of a page; a page is held, not a batch of pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[dict] = []
        for batch in batches:
            out: list[dict] = []
            for at in range(0, batch.num_rows, 1000):
                for row in batch.slice(at, 1000).to_pylist():
                    if rest and rest[-1]["record_id"] != row["record_id"]:
                        out += done(_page(rest))
                        rest = []
                    rest.append(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if rest:
            yield pa.RecordBatch.from_pylist(done(_page(rest)), schema=schema)

    return run


_COLUMNS = ("text", "link_chars", "tag_path", "is_heading", "cf_class")


def main_body(paragraphs: DataFrame, often: int = 5, sample: int = 1000) -> DataFrame:
    """(record_id, idx, main). A block whose wording ``often`` or more records have counts as recurring.

    Texts are shuffled once, to bring the blocks of a page together. Wordings are counted by hash: what recurs comes as
    further narrow rows of the page, so no text goes through a join or an aggregation. The classifier is fitted on
    ``sample`` pages, those with the smallest hashes of their ids; that is the bound of its labelled sample.
    """
    rows = paragraphs.where("record_id is not null and idx is not null").select("record_id", F.col("idx").cast("int").alias("idx"), "text", F.col("link_chars").cast("int").alias("link_chars"), "tag_path", "is_heading", "cf_class")
    wordings = keyed(rows.select("record_id", "idx", F.coalesce("text", F.lit("")).alias("line")))
    narrow = materialize(wordings.select("record_id", "idx", F.xxhash64("key").alias("key")), "block-keys")
    once = narrow.groupBy("key", F.xxhash64("record_id").alias("rec")).agg(F.lit(1).alias("one"))
    often_keys = once.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= often).select("key")
    marks = materialize(narrow.join(often_keys, "key", "left_semi").select("record_id", "idx"), "recurring")
    none = {c: F.lit(None).cast(rows.schema[c].dataType) for c in _COLUMNS}

    def paged(of: DataFrame, marked: DataFrame) -> DataFrame:
        both = of.withColumn("recurs", F.lit(False)).unionByName(marked.select("record_id", "idx", *(v.alias(c) for c, v in none.items()), F.lit(True).alias("recurs")))
        return both.repartition("record_id").sortWithinPartitions("record_id", "idx")

    picked = [r["record_id"] for r in narrow.select("record_id").distinct().orderBy(F.xxhash64("record_id")).limit(sample).collect()]
    few = rows.sparkSession.createDataFrame([(x,) for x in picked], "record_id string")
    schema = pa.schema([("x", pa.list_(pa.float64()))])
    seen = paged(rows.join(F.broadcast(few), "record_id", "left_semi"), marks.join(F.broadcast(few), "record_id", "left_semi"))
    table = seen.mapInArrow(_by_page(lambda page: [{"x": x.tolist()} for x in features(page)], schema), "x array<double>").collect()
    weights = fit(np.array([r["x"] for r in table]).reshape(-1, len(FEATURES)))

    def label(page: list[dict]) -> list[dict]:
        return [{"record_id": b["record_id"], "idx": b["idx"], "main": m} for b, m in zip(page, label_page(page, weights))]

    out = pa.schema([("record_id", pa.string()), ("idx", pa.int32()), ("main", pa.bool_())])
    return paged(rows, marks).mapInArrow(_by_page(label, out), "record_id string, idx int, main boolean")
