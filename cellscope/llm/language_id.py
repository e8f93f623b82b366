"""Language ID by a linear-chain conditional random field over words.

Each word of a text is labelled with a language by forward-backward, so a
text that switches between languages is split at the switches; the text's
language is the one with the largest sum of word marginals.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscope.llm import crf

UNDETERMINED = "und"
BUCKETS = 1 << 16  # the top 16 bits of a hash
#: Documents a language that the model is fitted on, about (the documented sample bound; twice that at most).
SAMPLE_DOCS = 150
#: Words of a training sequence at most.
PIECE_WORDS = 400
#: Words a language that the learned lexicon holds.
LEXICON_WORDS = 5000
#: Words scored at once, and words whose scores are kept between batches.
CHUNK_WORDS, CACHE_WORDS = 300_000, 200_000


#: All marks come after it.
_FIRST_MARK = "\u02ff"


def letters(token: str) -> str:
    """The letters of a token with their marks, in lower case; marks without a letter are no word."""
    if not token.isalpha():
        token = "".join(c for c in token if c.isalpha() or c > _FIRST_MARK and unicodedata.category(c)[0] == "M")
        if not any(map(str.isalpha, token)):
            return ""
    return token.lower()


def features(words: list[str], lexicon: dict[str, bytes]) -> crf.Features:
    """Buckets of the words' affixes, character n-grams and lexicon entries."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    chars = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), sizes)
    ends = np.cumsum(sizes)
    left = ends[owner] - np.arange(len(chars))  # characters to the end of the word
    gram, idx, owners = np.zeros(len(chars), np.uint64), [], []
    for n in (1, 2, 3, 4):
        # A rolling hash of the n characters from each place.
        gram = gram * np.uint64(1_000_003) + np.concatenate([chars[n - 1:], np.zeros(min(n - 1, len(chars)), np.uint64)])
        at = np.nonzero(left >= n)[0]
        first, last = (ends - sizes)[sizes >= n], (ends - n)[sizes >= n]
        for kind, places in ((1, at if n in (2, 3) else at[:0]), (2, first if n > 1 else first[:0]), (3, last if n > 1 else last[:0])):
            h = (gram[places] * np.uint64(31) + np.uint64(kind * 7 + n)) * np.uint64(0x9E3779B97F4A7C15)
            idx.append((h >> np.uint64(48)).astype(np.int64))
            owners.append(owner[places])
    known = [(i, x) for i, w in enumerate(words) if w in lexicon for x in lexicon[w] * 3]
    idx.append(np.array([x for _, x in known], np.int64))  # buckets of their own are not needed: few
    owners.append(np.array([i for i, _ in known], np.int64))
    return crf.Features(np.concatenate(idx), np.concatenate(owners), len(words))


class Model:
    """What a fit learns: languages, lexicon, weights."""

    def __init__(self, texts: list[str], langs: list[str]) -> None:
        self.langs = sorted(set(langs))
        k = len(self.langs)
        words = [[w for w in map(letters, t.split()) if w] for t in texts]
        label = np.array([self.langs.index(x) for x in langs], np.int64)
        # The field is trained on pieces of a bounded length; no word is left out.
        pieces = [(w[i:i + PIECE_WORDS], y) for w, y in zip(words, label) for i in range(0, len(w), PIECE_WORDS)]
        words, label = [w for w, _ in pieces], np.array([y for _, y in pieces], np.int64)
        counts = [Counter(chain.from_iterable(w for w, y in zip(words, label) if y == j)) for j in range(k)]
        self.lexicon: dict[str, bytes] = {}
        for j in range(k):
            for w, n in counts[j].most_common(LEXICON_WORDS):
                # A language and how exclusively it has the word, in four steps.
                share = n / sum(c[w] for c in counts)
                if n > 1:
                    self.lexicon[w] = self.lexicon.get(w, b"") + bytes([4 * j % 256 + int(3 * share)])
        number = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(words)))}
        word_of = np.fromiter((number[w] for w in chain.from_iterable(words)), np.int64)
        fit = crf.train(word_of, np.array([len(w) for w in words], np.int64), label, features(list(number), self.lexicon), k, BUCKETS)
        self.w, self.trans, self.start = fit.w.astype(np.float32), fit.trans, fit.start


class Scorer:
    """Applies a model; keeps the scores of words it has seen, up to a bound."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.langs)))

    def _learn(self, tokens: set[str]) -> None:
        new = [t for t in tokens if t not in self.at]
        words = [letters(t) for t in new]
        own = features([w for w in words if w], self.model.lexicon)
        n = len(self.scores)
        self.scores = np.concatenate([self.scores, own.scores(self.model.w)])
        for t, w in zip(new, words):
            self.at[t] = n if w else -1
            n += bool(w)

    def _chunk(self, tokens: list[list[str]]) -> list[tuple[str, float]]:
        if len(self.at) > CACHE_WORDS:
            self._clear()
        self._learn(set(chain.from_iterable(tokens)))
        each = [np.fromiter(map(self.at.__getitem__, t), np.int64, len(t)) for t in tokens]
        each = [x[x >= 0] for x in each]
        tokens.clear()
        lay = crf.Layout(np.array([len(x) for x in each], np.int64))
        gamma, _, _ = crf.forward_backward(self.scores[np.concatenate(each)], lay, self.model.trans, self.model.start)
        sums = np.stack([np.bincount(lay.seq, g, len(each)) for g in gamma.T], axis=1)
        best = sums.argmax(1)
        return [(self.model.langs[b], float(min(1.0, s[b] / len(x)))) if len(x) else (UNDETERMINED, 0.0)
                for b, s, x in zip(best, sums, each)]

    def __call__(self, texts: pd.Series) -> list[tuple[str, float]]:
        out, part, size = [], [], 0
        for text in texts:
            part.append(text.split() if text else [])
            size += len(part[-1])
            if size > CHUNK_WORDS:
                out += self._chunk(part)
                part, size = [], 0
        return out + (self._chunk(part) if part else [])


def sample(train: DataFrame, per_lang: int = SAMPLE_DOCS) -> pd.DataFrame:
    """About ``per_lang`` different rows (text, lang) of each language, chosen by a hash of the text; all if fewer.

    Copies count once. Of a language, the first 2 * per_lang by hash at most.
    """
    rows = train.where("text IS NOT NULL AND lang IS NOT NULL")
    different = rows.select("lang", F.xxhash64("text").alias("h"), F.xxhash64("text", F.lit(5)).alias("h5")).distinct()
    counts = {r["lang"]: r["count"] for r in different.groupBy("lang").count().collect()}
    if not counts:
        return pd.DataFrame({"text": [], "lang": []})
    draw = F.pmod(F.xxhash64("text", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, per_lang / n))))
    drawn = rows.where(draw < share[F.col("lang")]).select("text", "lang").distinct().withColumn("draw", draw)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text"))
    picked = drawn.withColumn("place", place).where(F.col("place") <= 2 * per_lang).select("text", "lang").toPandas()
    return picked.sort_values(["lang", "text"], kind="stable")


def fit(train: DataFrame, per_lang: int = SAMPLE_DOCS) -> Model | None:
    """A model from rows (text, lang); null texts and languages are no examples. None without examples.

    The rows sampled (about ``per_lang`` a language) are the bound of the
    fit, which runs on the driver; languages are counted over all rows, copies once.
    """
    picked = sample(train.select("text", "lang"), per_lang)
    return Model(list(picked["text"]), list(picked["lang"])) if len(picked) else None


def predict(spark, model: Model | None, text: Column) -> Column:
    """struct(lang_pred, score) of each whole text.

    lang_pred: a learned language, ``und`` (score 0) if the text is null or
    has no letter, or if nothing was learned. score: mean marginal of that
    language over the text's words. Equal sums go to the first language in
    code point order.
    """
    if model is None:
        return F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = spark.sparkContext.broadcast(model)
    name = f"{spark.sparkContext.applicationId}-{sent._jbroadcast.id()}"

    @F.pandas_udf("lang_pred string, score double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from cellscope.llm.common import held, task
        from cellscope.llm.language_id import Scorer
        with task():
            for part in parts:
                scorer = held(("language_id", name), lambda: Scorer(sent.value))
                yield pd.DataFrame(scorer(part), columns=["lang_pred", "score"])
    return run(text)
