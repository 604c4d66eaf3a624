"""Language detection by ranked character n-grams.

A profile is the list of a language's ``TOP`` most frequent n-grams (one to three
characters of lower-cased words, a word's ends marked by ``_``), learnt from labelled
texts by a distributed count: words are counted first, so an n-gram is spelled out
once for each distinct word of a language. A text scores, in every language, the sum over
all its n-grams of ``TOP + 1 - rank``; n-grams outside a profile score nothing.

The profiles (``TOP`` rows a language) are small and go to the tasks; a text is scored
where it is read, in Arrow batches, without any shuffle. A task scores a word once
and remembers it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOP = 400
LONGEST = 3
MIN_SHARE = 4  # at least one n-gram in four has to be in the profile of the language
CACHE_WORDS = 200_000
TRAIN_ROWS = 2000  # labelled texts that profiles are learnt from
UNKNOWN = "unknown"

# Names of the languages whose codes the labels carry.
LANGUAGE_NAMES = {"de": "German", "en": "English", "es": "Spanish", "fr": "French"}


def letters(text: Column) -> Column:
    """Lower-cased words of letters, one space between them; NULL gives ''."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+", " "))


def explode_grams(words: DataFrame, keep: list[str]) -> DataFrame:
    """A row (``keep``, gram) for each n-gram of ``word``, whose ends are marked; the marks alone are none."""
    at = words.select(*keep, F.concat(F.lit("_"), "word", F.lit("_")).alias("_m"),
                      F.explode(F.sequence(F.lit(1), F.length("word") + 2)).alias("_i"))
    of = lambda n: F.when(F.col("_i") + n - 1 <= F.length("_m"), F.substring("_m", F.col("_i"), F.lit(n)))
    rows = at.select(*keep, F.explode(F.array(*[of(n) for n in range(1, LONGEST + 1)])).alias("gram"))
    return rows.where(F.col("gram").isNotNull() & (F.col("gram") != "_"))


def training_rows(texts: DataFrame, key: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """At most ``rows`` labelled texts to learn from: those whose keys have the smallest md5.
    The keys are chosen alone; the texts follow by a join with that bounded list."""
    order = F.md5(F.col(key).cast("string"))
    chosen = texts.select(key).where(F.col(key).isNotNull()).distinct().orderBy(order, key).limit(rows)
    return texts.join(F.broadcast(chosen), key)


def learn_profiles(texts: DataFrame, language: str, text: str, top: int = TOP) -> DataFrame:
    """(language, gram, rank) of labelled texts; ties in the count go by gram. Rows
    without a label or a text are left out."""
    words = (texts.where(F.col(language).isNotNull())
             .select(F.col(language).alias("language"), F.explode(F.split(letters(F.col(text)), " ")).alias("word"))
             .where(F.col("word") != "").groupBy("language", "word").agg(F.count(F.lit(1)).alias("n")))
    counts = explode_grams(words, ["language", "n"]).groupBy("language", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("language").orderBy(F.col("n").desc(), "gram"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= top).select("language", "gram", "rank")


def collect_profiles(profiles: DataFrame) -> dict[str, dict[str, int]]:
    """{language: {gram: rank}}; ``TOP`` entries for each language."""
    out: dict[str, dict[str, int]] = {}
    for r in profiles.collect():
        out.setdefault(r.language, {})[r.gram] = r.rank
    return out


_BITS = 21  # of a character: an n-gram of up to three is one number


def _gram_key(gram: str) -> int:
    return sum(ord(c) << _BITS * i for i, c in enumerate(gram))


class Scorer:
    """Languages of texts that :func:`letters` has prepared.

    Row w of ``rows`` has, for word w of the table, the score in each language, the n-grams
    found in each and the number of n-grams. The table starts anew when it is full."""

    def __init__(self, profiles: dict[str, dict[str, int]], top: int = TOP):
        self.languages = sorted(profiles)  # a tie goes to the first name
        k = len(self.languages)
        known = sorted({g for p in profiles.values() for g in p}, key=_gram_key)
        self.keys = np.array([-1, *map(_gram_key, known)], np.int64)
        # line 0: n-grams of no profile; the last line: no n-gram
        self.weight = np.zeros((len(known) + 2, 2 * k + 1), np.int64)
        self.weight[:-1, -1] = 1
        line = {g: i for i, g in enumerate(known, 1)}
        for j, lang in enumerate(self.languages):
            for g, rank in profiles[lang].items():
                self.weight[line[g], j] = top + 1 - rank
                self.weight[line[g], k + j] = 1
        self._clear()

    def _clear(self) -> None:
        self.words: dict[str, int] = {}
        self.rows = np.zeros((0, self.weight.shape[1]), np.int64)

    def _learn(self, words: list[str]) -> None:
        # all words in one line, "_one_two_": the n-grams that begin at a place belong to the word that
        # the place is in or, if it is a mark, to the next one
        codes = np.frombuffer(f"_{'_'.join(words)}_".encode("utf-32-le"), np.uint32).astype(np.int64)
        mark = codes == ord("_")
        rows = np.zeros((len(codes) - 1, self.weight.shape[1]), np.int64)
        key = np.zeros(len(codes), np.int64)
        for n in range(1, LONGEST + 1):
            size = len(codes) - n + 1
            key = key[:size] | codes[n - 1:] << _BITS * (n - 1)
            at = np.searchsorted(self.keys, key)
            at = np.where(self.keys[np.minimum(at, len(self.keys) - 1)] == key, at, 0)
            at[mark[:size] if n == 1 else mark[1:1 + size] & (n > 2)] = len(self.weight) - 1
            rows[:size] += self.weight[at[:len(rows)]]
        first = np.flatnonzero(mark[:-1])
        self.words.update(zip(words, range(len(self.rows), len(self.rows) + len(words))))
        self.rows = np.vstack((self.rows, np.add.reduceat(rows, first)))

    def of(self, texts: list[str]) -> list[str]:
        split = [t.split() for t in texts]
        new = list({w: 0 for own in split for w in own if w not in self.words})
        if len(self.words) + len(new) > CACHE_WORDS and self.words:
            self._clear()
            new = list({w: 0 for own in split for w in own})
        if new:
            self._learn(new)
        k = len(self.languages)
        total = np.zeros((len(texts), 2 * k + 1), np.int64)
        for i, own in enumerate(split):
            if own:
                total[i] = self.rows[np.fromiter(map(self.words.__getitem__, own), np.int64, len(own))].sum(0)
        if not k:
            return [UNKNOWN] * len(texts)
        best = total[:, :k].argmax(1)
        line = np.arange(len(texts))
        known = (total[line, best] > 0) & (MIN_SHARE * total[line, k + best] >= total[:, -1])
        return [self.languages[j] if ok else UNKNOWN for j, ok in zip(best.tolist(), known.tolist())]


def detector(profiles: dict[str, dict[str, int]]) -> Callable[[Column], Column]:
    """Column function text → language. ``unknown`` for NULL and texts without letters, without
    any n-gram of a profile, or with fewer than one n-gram in ``MIN_SHARE`` known to the best
    language (other scripts, mostly). Whole texts are read; ties go to the first name."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(profiles)
        for b in batches:
            # a few texts at once: they may be long
            yield pd.Series([x for at in range(0, len(b), 64) for x in scorer.of(b[at:at + 64].tolist())], dtype=object)

    scored = F.pandas_udf(run, "string")
    return lambda text: scored(letters(text))


def detect_language(df: DataFrame, key: str, text: str, profiles: dict[str, dict[str, int]]) -> DataFrame:
    """(key, language) per row, see :func:`detector`."""
    return df.select(key, detector(profiles)(F.col(text)).alias("language"))
