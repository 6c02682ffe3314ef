"""Code-page damage as substitution ciphers, one a source, learned by expectation-maximization against letter bigrams.

A text is a row of symbols: letters, and runs of characters whose bytes are one character of UTF-8, so that UTF-8 read
as a code page is a substitution of symbols like any other. What is looked at are contexts (symbol before, symbol,
symbol after) that no language's bigrams account for. For each source the hidden variable of a context is how it was
misread: not at all, UTF-8 as a code page, one code page as another (every pair), or lost. EM learns from the counts of
a source's contexts how often each happened and with which rate each symbol stands for each letter; the likelihood of a
context under these rates against the one as it is written is its gain.

Fixed values are the code pages and letters of ``codepages``; the bigrams come from labelled samples.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Mapping

import numpy as np

from corpusmill.llm.codepages import LETTERS, MARKS, ONE_BYTE, PLAUSIBLE, bytes_of, runs, undo
from corpusmill.llm.lines import INVISIBLE

_RUN = re.compile("|".join(p.pattern for _, p, _ in runs()))
_ASKED = re.compile(r"[^\W\d_]\?{1,3}[^\W\d_]")
LOST = "�"


#: What is counted besides letters.
_KEPT = frozenset((*LETTERS, *MARKS))


def counted(rows: Iterable[tuple[str, str]]) -> dict[str, Counter]:
    """How often two characters follow each other in the texts of each language; a text's first one counts alone, too.
    What is neither a letter nor a known mark is a blank."""
    out: dict[str, Counter] = {}
    for lang, text in rows:
        of = out.setdefault(lang.strip().lower()[:2], Counter())
        if text:
            text = text.translate({ord(c): " " for c in set(text) if not c.isalpha() and c not in _KEPT})
            of[text[0]] += 1
            of.update(map("".join, zip(text, text[1:])))
    return out


class Bigrams:
    """Log probabilities of letter bigrams of each language, from labelled texts or from what ``counted`` gives for them.
    Case is kept. Index 0 stands for a blank and ASCII that is no letter, the last index for characters that no text is
    written with; other marks are letters of their own, or a mark would pass for the end of a word anywhere."""

    def __init__(self, rows: Iterable[tuple[str, str]] | Mapping[str, Mapping[str, int]], back: float = 4.0, floor: float = -12.0):
        counts = rows if isinstance(rows, Mapping) else counted(rows)
        letters = sorted({c for of in counts.values() for pair in of for c in pair if c.isalpha()} | set(LETTERS) | set(MARKS) | set(map(chr, (*range(65, 91), *range(97, 123)))))
        self.alphabet = " " + "".join(letters)
        self.at = {c: i for i, c in enumerate(self.alphabet)}
        k = self.odd = len(self.alphabet)
        self.langs = sorted(counts)
        self.log = np.full((max(1, len(counts)), k + 1, k + 1), floor)
        for i, lang in enumerate(self.langs):
            m = np.zeros((k, k))
            for pair, n in counts[lang].items():
                if len(pair) == 2:
                    m[self.at.get(pair[0], 0), self.at.get(pair[1], 0)] += n
            # what a letter was seldom seen before is likely as far as it is frequent in the language
            alone = m.sum(0) + 0.02
            alone /= alone.sum()
            self.log[i, :k, :k] = np.maximum(np.log((m + back * alone) / (m.sum(1, keepdims=True) + back)), floor)

    def index(self, c: str) -> int:
        """The place of a character in the alphabet."""
        i = self.at.get(c)
        return i if i is not None else 0 if c.isascii() or c in INVISIBLE else self.odd

    def chain(self, text: str) -> float:
        """Log likelihood of a row of characters after its first one."""
        x = np.array([self.index(c) for c in text])
        each = self.log[:, x[:-1], x[1:]].sum(1)
        return float(each.max() + np.log(np.exp(each - each.max()).mean()))

    def fit(self, a: np.ndarray, s: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Log likelihood of contexts, the languages being equally likely; the context before is given."""
        each = self.log[:, a, s] + self.log[:, s, b]
        top = each.max(0)
        return top + np.log(np.exp(each - top).mean(0))


def symbols(word: str) -> list[str]:
    """The characters of a word, runs of misread UTF-8 being one symbol; a lost character in a word is LOST."""
    if word.isascii():
        return [LOST if c == "?" and 0 < i < len(word) - 1 and word[i - 1].isalpha() | (word[i - 1] == "?") and (word[i + 1].isalpha() or word[i + 1] == "?") else c for i, c in enumerate(word)]
    out, at = [], 0
    for m in _RUN.finditer(word):
        if letter_of(m[0]) is not None:
            out += [*word[at : m.start()], m[0]]
            at = m.end()
    return out + [*word[at:]]


_undone: dict[str, str | None] = {}


def letter_of(run: str) -> str | None:
    """The letter that a run of misread UTF-8 stands for, by the first code page that gives a plausible one; what was
    misread twice or more is undone to the end."""
    if run not in _undone:
        found = None
        for _, pattern, of in runs():
            if pattern.fullmatch(run) and (c := undo(run, of)) is not None:
                found = c
                if c in PLAUSIBLE:
                    break
        _undone[run] = found
    return _undone[run]


def swaps() -> list[dict[str, str]]:
    """For each pair of code pages, the letters behind the characters of one that was read as the other."""
    out = []
    for right in ONE_BYTE:
        for wrong in ONE_BYTE:
            if right != wrong:
                table = {c: bytes([b]).decode(right, "replace") for c, b in bytes_of(wrong).items()}
                out.append({c: x for c, x in table.items() if x != c})
    return out


SWAPS = swaps()
#: The characters that any way of misreading makes; no other can be a symbol of a cipher.
MADE = frozenset(c for table in SWAPS for c in table) | {LOST}
#: Stands for any character beside a symbol that is neither a letter of the languages nor made by misreading, so that
#: texts in other scripts have few different contexts.
OTHER = "\ue000"


class Judge:
    """Which contexts of a text are unlikely as they are written; made once in a Python worker."""

    def __init__(self, model: Bigrams, least: float = -12.5, held: int = 200_000):
        self.model, self.least, self.held = model, least, held
        self.known: dict[str, tuple] = {}

    def contexts(self, word: str) -> tuple:
        """The unlikely contexts of a word, as (before, symbol, after)."""
        got = self.known.get(word)
        if got is None:
            if len(self.known) >= self.held:
                self.known.clear()
            got = self.known[word] = self._contexts(word)
        return got

    def _contexts(self, word: str) -> tuple:
        parts = [" ", *symbols(word), " "]
        at = [i for i, x in enumerate(parts) if len(x) > 1 or x in MADE and not x.isascii()]
        if not at:
            return ()
        parts = [x if len(x) > 1 or x in MADE or self.model.index(x) < self.model.odd else OTHER for x in parts]
        index = [self.model.odd if len(x) > 1 or x == LOST else self.model.index(x) for x in parts]
        x = np.array(index)
        p = np.array(at)
        p = p[p < len(parts) - 1]
        fit = self.model.fit(x[p - 1], x[p], x[p + 1])
        return tuple((parts[i - 1], parts[i], parts[i + 1]) for i, f in zip(p, fit) if f < self.least)

    def text(self, text: str) -> Counter:
        out: Counter = Counter()
        words = text.split()
        odd = [w for w in words if not w.isascii()]
        if "?" in text:
            odd += [w for w in words if "?" in w and w.isascii() and _ASKED.search(w)]
        for word, n in Counter(odd).items():
            for c in self.contexts(word):
                out[c] += n
        return out


def learn(contexts: Counter, model: Bigrams, rounds: int = 12) -> tuple[dict[tuple, float], dict[str, tuple[str, float]]]:
    """(gain of each context, letter and rate of each symbol) by EM over one source's contexts.

    Hidden in a context is the way it was misread; the ways begin equally likely, being written as meant more so. In
    each round a context is dealt out over the ways by how likely they make it, times the rates with which they happen
    and with which its symbol stands for the letter; the rates are then what was dealt out.
    """
    keys = sorted(contexts)
    if not keys:
        return {}, {}
    counts = np.array([contexts[k] for k in keys], float)
    seen = sorted({x for k in keys for x in k})
    at = {x: i for i, x in enumerate(seen)}
    a, s, b = (np.array([at[k[j]] for k in keys]) for j in range(3))

    def written(x: str) -> int:
        return model.odd if len(x) > 1 or x == LOST else model.index(x)

    def utf8(x: str) -> str:
        return letter_of(x) or x if len(x) > 1 else x

    ways: list[tuple[str, list[str]]] = [("utf8", [utf8(x) for x in seen])]
    known = {tuple(ways[0][1]), tuple(seen)}
    for table in SWAPS:
        to = [table.get(x, x) for x in seen]
        if tuple(to) not in known:
            known.add(tuple(to))
            ways.append(("swap", to))
    fits = [model.fit(*(np.array([written(x) for x in seen])[i] for i in (a, s, b)))]
    for i, (x, y, z) in enumerate(keys):
        if len(y) > 1:  # as it is written a run is all of its characters
            fits[0][i] = model.chain(x[-1] + y + z[0])
    letters = [seen]
    for kind, to in ways:
        index = np.array([model.index(x) if len(x) == 1 else model.odd for x in to])
        changed = np.array([x != y for x, y in zip(seen, to)])
        # a way that leaves the symbol as it is does not explain the context
        fits.append(np.where(changed[s], model.fit(index[a], index[s], index[b]), -40.0))
        letters.append(to)
    # lost characters: the likeliest letter in their place
    every = np.array([model.at[c] for c in LETTERS if c in model.at])
    plain = np.array([written(x) for x in seen])
    lost = np.full(len(keys), -40.0)
    guess = [""] * len(keys)
    for i in np.flatnonzero(np.array([seen[j] == LOST for j in s])):
        f = model.fit(np.full(len(every), plain[a[i]]), every, np.full(len(every), plain[b[i]]))
        lost[i], guess[i] = f.max(), model.alphabet[every[int(f.argmax())]]
    fits.append(lost)
    fit = np.array(fits)
    rate = np.full(len(fit), 0.5 / (len(fit) - 1))
    rate[0] = 0.5
    # which letter of a symbol each way gives, as a column of the table of rates by symbol
    options: dict[tuple[int, str], int] = {}
    column = np.zeros((len(fit), len(keys)), int)
    central = sorted({int(i) for i in s})
    of = np.zeros(len(seen), int)
    for w, to in enumerate(letters):
        for i in central:
            of[i] = options.setdefault((i, to[i]), len(options))
        column[w] = of[s]
    for i in range(len(keys)):
        column[-1, i] = options.setdefault((int(s[i]), guess[i]), len(options))
    owner = np.array([k[0] for k in options])
    per = np.bincount(owner, minlength=len(seen))
    stands = 1.0 / per[owner]
    for _ in range(rounds):
        joint = fit + np.log(rate + 1e-12)[:, None] + np.log(stands[column] + 1e-9)
        joint -= joint.max(0)
        dealt = np.exp(joint)
        dealt /= dealt.sum(0)
        dealt *= counts
        rate = dealt.sum(1) / counts.sum()
        stands = np.bincount(column.ravel(), weights=dealt.ravel(), minlength=len(options))
        stands = (stands + 0.01) / (np.bincount(owner, weights=stands, minlength=len(seen))[owner] + 0.01 * per[owner])
    weighed = fit[1:] + np.log(stands[column[1:]] + 1e-9)
    gain = weighed.max(0) - fit[0]
    best: dict[str, tuple[str, float]] = {}
    for (i, c), k in options.items():
        if c and c != seen[i] and stands[k] > best.get(seen[i], ("", 0.0))[1]:
            best[seen[i]] = (c, float(stands[k]))
    # symbols that are seen beside others only follow the pair of code pages that happened most
    swapped = [w for w in range(2, len(fit) - 1)]
    if swapped and (most := max(swapped, key=lambda w: rate[w])) and rate[most] > 0:
        share = float(rate[most] / sum(rate[w] for w in swapped))
        for x, c in zip(seen, letters[most]):
            if x != c and not x.isascii() and x not in {seen[i] for i, _ in options}:
                best[x] = (c, share)
    return {k: float(g) for k, g in zip(keys, gain)}, best
