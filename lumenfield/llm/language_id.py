"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: n-grams of 1 to 3 characters; ranks beyond this many count as absent.
TOP = 300
#: Characters taken at once; bounds the memory that one very long text takes.
BLOCK = 1 << 20
#: Distinct words gathered before their n-grams are counted.
WORDS = 1 << 17
UNKNOWN = "und"
#: No letter, and not 0, so that codes of n-grams of different lengths differ.
BLANK = 1


@lru_cache(1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def codes(text: str, before: bool = True, after: bool = True) -> np.ndarray:
    """Code points of the lower-case text with each run of other characters than letters as one ``BLANK``, also at an end that is one of a word."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    raw = np.concatenate(([BLANK] * before, np.where(letters()[raw], raw, BLANK), [BLANK] * after)).astype(np.int64)
    keep = np.ones(len(raw), bool)
    keep[1:] = (raw[1:] != BLANK) | (raw[:-1] != BLANK)
    return raw[keep]


def grams(c: np.ndarray, known: int = 0) -> np.ndarray:
    """Codes of the n-grams inside single words, where a word is padded with a blank on both sides; those that end in the first ``known`` codes left out."""
    one = c[known:]
    one = one[one != BLANK]
    two = ((c[:-1] << 21) | c[1:])[max(known - 1, 0) :]
    mid = c[1:-1] != BLANK
    three = ((c[:-2] << 42) | (c[1:-1] << 21) | c[2:])[max(known - 2, 0) :][mid[max(known - 2, 0) :]]
    return np.concatenate((one, two, three)) if len(c) > 1 else one


def blocks(text: str) -> Iterator[tuple[str, bool, bool]]:
    """A text in blocks of about ``BLOCK`` characters, and whether each begins and ends at a border of words; only in a run of letters longer than that does one not."""
    start, begins = 0, True
    while start < len(text):
        end = start + BLOCK
        while end < min(len(text), start + 2 * BLOCK) and text[end - 1].isalpha():
            end += 1
        ends = end >= len(text) or not text[end - 1].isalpha()
        yield text[start:end], begins, ends
        start, begins = end, ends


def continued(held: np.ndarray, block: str, begins: bool, ends: bool) -> np.ndarray:
    """The codes of a block after the last two of the word that it goes on with."""
    c = codes(block, begins, ends)
    return np.concatenate((held, c[1:] if len(held) and held[-1] == BLANK and len(c) and c[0] == BLANK else c))


def block_grams(text: str) -> Iterator[np.ndarray]:
    """The n-grams of a text, block by block. A word that is cut goes on with its last two codes, so each of its n-grams comes once."""
    held = np.zeros(0, np.int64)
    for block, begins, ends in blocks(text):
        c = continued(held, block, begins, ends)
        yield grams(c, len(held))
        held = c[:0] if ends else c[-2:]


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of the whole text and their counts, block by block."""
    found, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for some in block_grams(text):
        g, k = np.unique(some, return_counts=True)
        if len(found):
            g, back = np.unique(np.concatenate((found, g)), return_inverse=True)
            k = np.bincount(back.ravel(), np.concatenate((n, k))).astype(np.int64)
        found, n = g, k
    return found, n


def ranked(found: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The most frequent n-grams, most frequent first; ties by code."""
    return found[np.argsort(-n, kind="stable")[:TOP]]


def weighted(words: list[str], counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of words of letters, each n-gram counted as often as its word."""
    c = codes(" ".join(words))
    word = np.cumsum(c == BLANK) - 1  # a blank belongs to the word after it
    at = np.concatenate((word[c != BLANK], word[:-1], word[:-2][c[1:-1] != BLANK])) if words else np.zeros(0, np.int64)
    found, back = np.unique(grams(c), return_inverse=True) if words else (np.zeros(0, np.int64), at)
    return found, np.bincount(back.ravel(), np.array(counts, float)[at], len(found)).astype(np.int64)


def merged(parts: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    total: Counter = Counter()
    for found, n in parts:
        for g in found.tolist():
            total[g] += n
    return np.array(list(total), np.int64), np.array(list(total.values()), np.int64)


WORD = re.compile(r"[^\W\d_]+")


def gram_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows ``(lang, gram, n)``: the n-grams of each word once, times how often the word occurs. No row where there is no word."""
    words: dict[str, Counter] = {}

    def flush() -> Iterator[pd.DataFrame]:
        for lang, own in words.items():
            for some in (True, False):  # what is no letter would split a word
                part = {w: n for w, n in own.items() if w.isalpha() == some}
                if part:
                    found, n = weighted(list(part), list(part.values())) if some else merged([(grams(codes(w)), n) for w, n in part.items()])
                    yield pd.DataFrame({"lang": lang, "gram": found, "n": n})
        words.clear()

    for pdf in batches:
        for lang, text in zip(pdf.lang, pdf.text):
            own, held = words.setdefault(lang, Counter()), np.zeros(0, np.int64)
            for block, begins, ends in blocks(text):
                if begins and ends:
                    own.update(WORD.findall(block.lower()))
                else:
                    # part of a word longer than a block, and whatever stands beside it
                    c = continued(held, block, begins, ends)
                    found, n = np.unique(grams(c, len(held)), return_counts=True)
                    held = c[:0] if ends else c[-2:]
                    yield pd.DataFrame({"lang": lang, "gram": found, "n": n})
                if sum(map(len, words.values())) > WORDS:
                    yield from flush()
                    own = words.setdefault(lang, Counter())
    yield from flush()


def fit_profiles(labelled: DataFrame, top: int = TOP) -> dict[str, np.ndarray]:
    """For each language its ``top`` n-grams by frequency over all of ``labelled`` (``lang``, ``text``); nulls are left out.

    What comes to the driver, and goes with the tasks, is ``top`` numbers a language, so ``lang`` has to be a label of
    languages (at most some thousands of values), not free text. An empty table gives no profile.
    """
    rows = labelled.select("lang", "text").dropna().mapInPandas(gram_counts, "lang string, gram long, n long")
    total = rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    kept = total.withColumn("rank", rank).filter(F.col("rank") <= top).orderBy("lang", "rank").select("lang", "gram").toPandas()
    return {lang: own.gram.to_numpy(np.int64) for lang, own in kept.groupby("lang")}


def predict(df: DataFrame, profiles: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``.

    The distance of a profile is the sum, over the text's most frequent n-grams, of the difference of their ranks, and of
    ``TOP`` for an n-gram that the profile lacks. ``score`` is 1 less the distance's share of its maximum. Ties go
    to the language that is first by name. A text that is null or has no letter is ``und`` with score 0; so is every
    text if no profile was learned. Repeated rows get the same prediction each. A very long text is counted in blocks, also
    inside a word that is longer than one.
    """
    langs = sorted(profiles)
    order = {lang: np.argsort(profiles[lang], kind="stable") for lang in langs}
    sorted_grams = {lang: profiles[lang][order[lang]] for lang in langs}

    def best(text: str | None) -> tuple[str, float]:
        own = ranked(*counted(text)) if text else ()
        if not len(own) or not langs:
            return UNKNOWN, 0.0
        near = []
        for lang in langs:
            at = np.minimum(np.searchsorted(sorted_grams[lang], own), len(sorted_grams[lang]) - 1)
            there = sorted_grams[lang][at] == own
            near.append(np.where(there, np.abs(order[lang][at] - np.arange(len(own))), TOP).sum())
        k = int(np.argmin(near))
        return langs[k], 1.0 - float(near[k]) / (TOP * len(own))

    @F.pandas_udf("struct<lang_pred: string, score: double>")
    def guess(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([best(t) for t in texts], columns=["lang_pred", "score"])

    out = df.withColumn("__guess", guess(F.col(text_col)))
    return out.withColumns({"lang_pred": F.col("__guess.lang_pred"), "score": F.col("__guess.score")}).drop("__guess")
