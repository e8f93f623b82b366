"""Toxicity by a learned lexicon, matched with its misspellings, in context.

Terms are words that toxic examples use outside quotations in several different
contexts and other examples hardly at all, and stems that several such words
begin with. Each is judged by its own numbers of texts. They form a trie; a word's Levenshtein automaton (as
bit masks, a mask for each number of edits) is run along the trie, which finds
all terms within the allowed distance. A window of words around each match
tells quotation from abuse: quotation marks about it, and the words' learned
log-odds. A logistic regression on the counts of matches gives the score.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from os.path import commonprefix
from unicodedata import category

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that the model is fitted on, about, of each class (the documented sample bound; twice that at most).
SAMPLE_TOXIC, SAMPLE_OTHER = 1500, 3000
#: Words on each side of a match that are its context.
WINDOW = 8
#: Different contexts that a term has at least, how much likelier toxic examples use it.
LEAST_CONTEXTS, LEAST_ODDS = 4, 20.0
#: Code points of the terms that are looked for in runs of letters of scripts written without spaces.
GRAMS = (1, 2, 3, 4)
#: Share of words among the terms that toxic examples have by mere chance, at most about; share of words that makes contexts alike.
FALSE_TERMS, ALIKE = 0.05, 2 / 3
#: Lengths of stems; words and contexts that a stem has at least.
STEM_CHARS, STEM_WORDS, STEM_CONTEXTS = (4, 5, 6), 3, 12
CACHE_WORDS = 400_000
_EDGE = ".,;:!?()[]{}<>\"'“”«»„‘’*_-…"
#: Signs that stand for letters: they do not end a word.
_LEET = frozenset("!@$€£|+*#%&")
_MARKS = frozenset("\"“”«»„")


def word_of(token: str) -> str:
    return token.strip(_EDGE).lower()


def _is_letter(c: str) -> bool:
    return c.isalnum() or category(c)[0] == "M"  # marks are parts of letters


def _unspaced(c: str) -> bool:
    """Letters of scripts written without spaces between words: Thai, Lao, Myanmar, Khmer, Han, Kana."""
    return ("\u0e00" <= c <= "\u0eff" or "\u1000" <= c <= "\u109f" or "\u1780" <= c <= "\u17ff" or "\u3005" <= c <= "\u30ff"
            or "\u3400" <= c <= "\u9fff" or "\uf900" <= c <= "\ufaff" or "\U00020000" <= c <= "\U0003ffff")


def _grams(run: str) -> list[str]:
    """Runs of 1 to 4 letters within the parts of ``run`` that are in a script without spaces."""
    if run.isascii():
        return []
    parts = "".join(c if _unspaced(c) else " " for c in run).split()
    return [p[i:i + n] for p in parts for n in GRAMS for i in range(len(p) - n + 1)]


def parts_of(token: str) -> list[tuple[str, list[str]]]:
    """The words of a token cut at its signs, signs like letters kept inside, each with its runs of letters and digits."""
    word = word_of(token)
    if word.isalnum() or not word:
        return [(word, [word])] if word else []
    out = []
    for piece in "".join(c if _is_letter(c) or c in _LEET else " " for c in word).split():
        if runs := "".join(c if _is_letter(c) else " " for c in piece).split():
            first, last = piece.index(runs[0]), piece.rindex(runs[-1]) + len(runs[-1])
            out.append((piece[first:last], runs))
    return out


def words_of(token: str) -> set[str]:
    """All words that a token holds: the whole, its parts, and short runs of letters in scripts without spaces."""
    parts = parts_of(token)
    return ({w for piece, runs in parts for w in (piece, *runs)} | ({word_of(token)} - {""})
            | {g for _, runs in parts for x in runs for g in _grams(x)})


class Words(dict):
    """``words_of`` of the tokens of a sample, each worked out once."""

    def __missing__(self, token: str) -> tuple[str, ...]:
        self[token] = found = tuple(words_of(token))
        return found


def edits_allowed(term: str) -> int:
    """Edits of a misspelling: none of terms under five code points (one would meet too many other words), then one, from nine on two."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Trie:
    """Terms as nested dicts; "" holds the term that ends at a node, None the stem: it matches a word's beginning."""

    def __init__(self, terms: list[str], stems: list[str] = ()) -> None:
        self.root: dict = {}
        self.most = max(map(edits_allowed, [*terms, *stems]), default=0)
        self.stems, self.stem_sizes = set(stems), sorted({len(x) for x in stems})
        self.parts: set[tuple[int, str]] = set()
        misspelled = [x for x in stems if edits_allowed(x)]
        for t, end in [*((t, "") for t in terms), *((x, None) for x in misspelled)]:
            node = self.root
            for c in t:
                node = node.setdefault(c, {})
            node[end] = t
            # Of k + 1 parts of a term, k edits leave one as it is.
            k = edits_allowed(t)
            for i in range(k + 1):
                a, b = len(t) * i // (k + 1), len(t) * (i + 1) // (k + 1)
                self.parts |= {(a + d, t[a:b]) for d in range(-min(a, k), k + 1)}  # moved by k places at most
        self.part_sizes = sorted({len(x) for _, x in self.parts})
        self.least = min((len(t) - edits_allowed(t) for t in [*terms, *misspelled]), default=1)
        self.longest = float("inf") if misspelled else max((len(t) + edits_allowed(t) for t in terms), default=0)

    def stem(self, word: str) -> str | None:
        return next((word[:n] for n in self.stem_sizes if word[:n] in self.stems), None)

    def may_match(self, word: str) -> bool:
        """False only if no term, and no stem of the word's beginning, is within its distance."""
        return self.least <= len(word) <= self.longest and not all(
            self.parts.isdisjoint([(i, word[i:i + n]) for i in range(len(word) - n + 1)]) for n in self.part_sizes)

    def nearest(self, word: str) -> tuple[str, int] | None:
        """The term or stem with the fewest edits (ties: code point order) among those within their distance.

        A stem's edits are those to the beginning of the word that is nearest to it.
        """
        if (stem := self.stem(word)) is not None:
            return stem, 0
        if not self.may_match(word):
            return None
        place = defaultdict(int)
        for i, c in enumerate(word):
            place[c] |= 1 << (i + 1)
        # Bit i of state e: the path so far may be word[:i] with e edits.
        found, full = None, 1 << len(word)
        states = [1]
        for _ in range(self.most):
            states.append(states[-1] | states[-1] << 1)
        stack = [(self.root, states)]
        while stack:
            node, states = stack.pop()
            for end, places in (("", full), (None, 2 * full - 1)):
                if (term := node.get(end)) is None:
                    continue
                e = next((e for e, s in enumerate(states) if s & places), None)
                if e is not None and e <= edits_allowed(term) and (found is None or (e, term) < (found[1], found[0])):
                    found = (term, e)
            for c, child in node.items():
                if c:
                    nxt = [states[0] << 1 & place[c]]
                    for e in range(1, len(states)):
                        # same letter; another letter of the word; a letter left out; one put in
                        nxt.append(states[e] << 1 & place[c] | states[e - 1] << 1 | states[e - 1] | nxt[e - 1] << 1)
                    mask = 2 * full - 1
                    if nxt[-1] & mask:
                        stack.append((child, [s & mask for s in nxt]))
        return found


def _outside(tokens: list[str]) -> list[int]:
    """Places that are not within a quotation (see ``Model._quoted``)."""
    marks = [sum(c in _MARKS for c in t) for t in tokens]
    if not any(marks):
        return list(range(len(tokens)))
    sums = [0]
    for m in marks:
        sums.append(sums[-1] + m)
    return [i for i, t in enumerate(tokens)
            if (sums[i] - sums[max(0, i - WINDOW)] + (t[:1] in _MARKS)) % 2 == 0
            or sums[min(len(tokens), i + 1 + WINDOW)] - sums[i + 1] + (t[-1:] in _MARKS) == 0]


def _by_chance(n: int, of: int, share: float) -> float:
    """Chance that at least n of ``of`` texts are toxic if each is with chance ``share``."""
    if not 0 < share < 1:
        return float(share >= 1 or n == 0)
    each = (math.lgamma(of + 1) - math.lgamma(i + 1) - math.lgamma(of - i + 1) + i * math.log(share) + (of - i) * math.log1p(-share)
            for i in range(n, of + 1))
    return min(1.0, sum(map(math.exp, each)))


def _contexts(texts: list[tuple[str, ...]], least: dict[str, int], words_in: Words) -> set[str]:
    """Words and beginnings of words found in ``least`` texts with different windows; near copies of a text are alike."""
    found: dict[str, list[list[frozenset]]] = {u: [] for u in least}
    sizes = (None, *STEM_CHARS)
    for ws in texts:
        words = [word_of(t) for t in ws]
        places = defaultdict(list)
        for i in _outside(ws):
            for u in {w[:n] for w in words_in[ws[i]] for n in sizes if n is None or len(w) >= n}:
                if u in found and len(found[u]) < least[u]:
                    places[u].append(i)
        for u, at in places.items():
            # In scripts without spaces the rest of the token is context too.
            windows = [frozenset((*Model._window(words, i), *(g for g in _grams(words[i]) if len(g) == 2))) for i in at]
            if not any(len(a & b) >= ALIKE * max(len(a), len(b)) for a in windows for kept in found[u] for b in kept):
                found[u].append(windows)
    return {u for u, kept in found.items() if len(kept) >= least[u]}


def _lexicon(tokens: list[list[str]], labels: list[int]) -> tuple[list[str], list[str], set[str]]:
    """Terms, stems, and all words of other examples. Copies of a text count once."""
    texts: list[dict[tuple[str, ...], None]] = [{}, {}]
    for ws, y in zip(tokens, labels):
        texts[y][tuple(ws)] = None
    n, clean, words_in = [Counter(), Counter()], set(), Words()
    for y in (0, 1):
        for ws in texts[y]:
            n[y].update({w for t in {ws[i] for i in _outside(ws)} for w in words_in[t]})
    for ws in texts[0]:
        clean.update(w for t in set(ws) for w in words_in[t])
    docs = [max(1, len(t)) for t in texts]
    strong = {w: _by_chance(k, k + n[0][w], docs[1] / sum(docs)) for w, k in n[1].items()
              if k >= LEAST_CONTEXTS and (k / docs[1]) / ((n[0][w] + 0.1) / docs[0]) >= LEAST_ODDS}
    # As many words are tested as are in enough texts of either kind; a term stands if few like it are expected by chance.
    tested = sum(k + n[0][w] >= LEAST_CONTEXTS for w, k in n[1].items()) + sum(k >= LEAST_CONTEXTS for w, k in n[0].items() if w not in n[1])
    chances = sorted(strong.values())
    limit = max((c for i, c in enumerate(chances, 1) if c * tested <= FALSE_TERMS * i), default=-1.0)
    terms = [w for w, c in strong.items() if c <= limit]
    # Beginnings that only toxic examples use: several words, many contexts, no shorter one does.
    taken = {w[:k] for w in n[0] for k in STEM_CHARS}
    begun = Counter(w[:k] for w in n[1] if all(map(_is_letter, w)) for k in STEM_CHARS if len(w) >= k and w[:k] not in taken)
    stems = [p for p, k in begun.items() if k >= STEM_WORDS]
    good = _contexts(list(texts[1]), dict.fromkeys(stems, STEM_CONTEXTS), words_in)
    different = _contexts(list(texts[1]), dict.fromkeys(terms, LEAST_CONTEXTS), words_in)
    short = [p for p in good if not any(p[:k] in good for k in STEM_CHARS if k < len(p))]
    # As long as all its words agree: a short stem would meet words of other texts.
    stems = sorted({commonprefix([w for w in n[1] if w.startswith(p) and all(map(_is_letter, w))]) for p in short})
    return sorted((w for w in terms if w in different), key=lambda w: (-n[1][w], w)), stems, clean


class Model:
    """Lexicon, innocent look-alikes, context weights and regression weights, learned from examples."""

    def __init__(self, texts: list[str], labels: list[int]) -> None:
        self._bound = set()
        self._known: dict[str, int] = {}
        self.hits: dict[str, list[int]] = {}
        tokens = [t.split() for t in texts]
        self.terms, self.stems, clean = _lexicon(tokens, labels)
        self.trie = Trie(self.terms, self.stems)
        # What other examples write is no misspelling.
        own = set(self.terms)
        self._short = {t for t in own if all(map(_unspaced, t))}
        self.innocent = {w for w in clean if w not in own and self.trie.nearest(w)}
        around = [Counter(), Counter()]
        for ws, y in zip(tokens, labels):
            for i, _, _ in self.matches(ws):
                around[y].update(set(map(word_of, self._window(ws, i))))
        total = [sum(a.values()) + 1 for a in around]
        # Only words seen about matches of both kinds say anything; others are neutral.
        self.context = {w: float(np.log((around[1][w] + 1) / total[1]) - np.log((around[0][w] + 1) / total[0]))
                        for w in around[0] if around[0][w] + around[1][w] >= 5}
        x = np.array([self.features(ws) for ws in tokens]).reshape(len(tokens), -1)
        self.weights = _logistic(x, np.array(labels, float))

    def _kind(self, word: str) -> int:
        """0: no match, 1: a term, 2: a misspelled term."""
        if word not in self._known:
            near = None if word in self.innocent else self.trie.nearest(word)
            self._known[word] = 0 if near is None else 1 if near[1] == 0 else 2
        return self._known[word]

    def _kinds(self, token: str) -> list[int]:
        """The kind of each match in a token."""
        out = []
        for piece, runs in parts_of(token):
            whole = self._kind(piece)
            inside = [kind for w in runs if (kind := self._kind(w))] if len(runs) > 1 else []
            # A word with signs inside is one match, unless a run of its letters fits better.
            out += inside if 1 in inside and whole != 1 else [whole] if whole else inside
        if not out and (word := word_of(token)) and (whole := self._kind(word)):
            out = [whole]
        if not out and self._short and not token.isascii():
            out = [1 for _, runs in parts_of(token) for x in runs for g in _grams(x) if g in self._short]
        return out

    def matches(self, tokens: list[str]) -> list[tuple[int, int, bool]]:
        """(place, kind, quoted) of each match."""
        if len(self._bound) > CACHE_WORDS:
            self._bound, self.hits, self._known = set(), {}, {}
        new = set(tokens) - self._bound
        for t in new:
            if kinds := self._kinds(t):
                self.hits[t] = kinds
        self._bound |= new
        hits = self.hits
        return [(i, kind, quoted) for i, t in enumerate(tokens) if t in hits for quoted in (self._quoted(tokens, i),) for kind in hits[t]]

    @staticmethod
    def _window(tokens: list[str], i: int) -> list[str]:
        return tokens[max(0, i - WINDOW):i] + tokens[i + 1:i + 1 + WINDOW]

    @staticmethod
    def _quoted(tokens: list[str], i: int) -> bool:
        """Within the window, a quotation opens before the match and closes after it."""
        opens = sum(c in _MARKS for t in tokens[max(0, i - WINDOW):i] for c in t) + (tokens[i][:1] in _MARKS)
        closes = sum(c in _MARKS for t in tokens[i + 1:i + 1 + WINDOW] for c in t) + (tokens[i][-1:] in _MARKS)
        return opens % 2 == 1 and closes >= 1

    def features(self, tokens: list[str]) -> list[float]:
        """Constant; any and number of terms and of misspelled terms, outside and inside quotations; context."""
        n = Counter()
        context = 0.0
        for i, kind, quoted in self.matches(tokens):
            n[kind, quoted] += 1
            context += sum(self.context.get(word_of(t), 0.0) for t in self._window(tokens, i)) / (2 * WINDOW)
        out = [1.0]
        for key in ((1, False), (2, False), (1, True), (2, True)):
            out += [float(n[key] > 0), min(n[key], 5) / 5]
        return [*out, float(np.tanh(context))]

    def score(self, text: str | None) -> float:
        z = float(np.dot(self.weights, self.features((text or "").split())))
        return 1 / (1 + float(np.exp(-np.clip(z, -30, 30))))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_bound": set(), "hits": {}, "_known": {}}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 30) -> np.ndarray:
    """Newton's method with a ridge on all weights but the constant."""
    w, keep = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    keep[0] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * w)
    return w


def fit(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, other: int = SAMPLE_OTHER) -> Model | None:
    """A model from texts ``docs`` (doc_id, text) with ``labels`` (doc_id, toxic).

    Null ids, texts and labels are no examples; a repeated label counts as
    its largest. About ``toxic`` and ``other`` labelled rows, chosen by a hash
    of the id, are the bound of the fit, which runs on the driver (beyond twice
    that, the first by hash). Terms are as many as the sample bears out: words
    of any length, and runs of 1 to 4 letters of scripts without spaces. None
    without examples of both kinds.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    draw = F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, min(1.0, toxic / counts[1])).otherwise(min(1.0, other / counts[0]))
    picked = known.where("toxic IN (0, 1)").where(draw < share).orderBy(draw, "doc_id").limit(2 * (toxic + other))
    rows = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(picked), "doc_id").toPandas()
    rows = rows.sort_values(["doc_id", "text"], kind="stable").drop_duplicates("doc_id")
    if rows["toxic"].nunique() < 2:
        return None
    return Model(list(rows["text"]), [int(x) for x in rows["toxic"]])


def score(spark, model: Model | None, text: Column) -> Column:
    """Toxicity from 0 to 1 of each whole text; null and empty texts as a text without matches. Without a model: 0."""
    if model is None:
        return F.lit(0.0)
    sent = spark.sparkContext.broadcast(model)
    name = f"{spark.sparkContext.applicationId}-{sent._jbroadcast.id()}"

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from cellscope.llm.common import held
        for part in parts:
            own = held(("toxicity", name), lambda: sent.value)
            yield pd.Series([own.score(t) for t in part], dtype=float)
    return run(text)
