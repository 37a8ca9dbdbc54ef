"""Quality rules: base rules on word counts, then gradient-boosted trees over document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfield.llm.common import BLANKS, sample_of

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = "#*$%&|<>"
#: Features of the trees, all from BASE and cheap counts, with the direction in which each may move the score.
FEATURES = (
    ("log_words", 0),
    ("chars_per_word", 0),
    ("symbols_per_word", -1),
    ("dup_lines_per_line", -1),
    ("repeat_words_share", -1),
    ("upper_share", 0),
    ("marks_per_word", 0),
    ("digits_share", 0),
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Labelled rows that the trees are fitted on, at most.
MAX_TRAIN_ROWS = 8000


def repeat_words(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more in the text, the first occurrence included."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    n = np.int64(len(number))
    if n < 2_000_000:
        code = (ids[:-2] * n + ids[1:-1]) * n + ids[2:]
    else:
        code = np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]], axis=1), axis=0, return_inverse=True)[1].ravel()
    _, back, count = np.unique(code, return_inverse=True, return_counts=True)
    again = count[back.ravel()] > 1
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[k : k + len(again)] |= again
    return int(hit.sum())


def statistics(text: str | None) -> tuple:
    """BASE, then lines with a word, upper-case letters, sentence marks and digits."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    chars = len(text) - sum(text.count(c) for c in BLANKS)
    upper = sum(map(str.isupper, text)) if not text.isascii() else len(text) - len(text.translate(UPPER))
    return (
        len(words),
        chars,
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
        upper,
        sum(text.count(c) for c in ".!?"),
        sum(text.count(c) for c in "0123456789"),
    )


UPPER = {c: None for c in range(ord("A"), ord("Z") + 1)}
STATS = (*BASE, "n_lines", "n_upper", "n_marks", "n_digits")
def features(stats: pd.DataFrame) -> np.ndarray:
    words, chars = np.maximum(stats.n_words.to_numpy(float), 1), np.maximum(stats.word_chars.to_numpy(float), 1)
    return np.stack(
        [
            np.log1p(stats.n_words.to_numpy(float)),
            stats.word_chars / words,
            stats.n_symbols / words,
            stats.n_dup_lines / np.maximum(stats.n_lines, 1),
            stats.n_repeat_words / words,
            stats.n_upper / chars,
            stats.n_marks / words,
            stats.n_digits / chars,
        ],
        axis=1,
    ).astype(float)


@dataclass
class Trees:
    """Trees as flat node arrays, one row a tree. A leaf points to itself, so every row takes ``depth`` steps."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of good quality of each row of ``x``."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, left, right, v in zip(self.feature, self.threshold, self.left, self.right, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = np.where(x[rows, f[at]] <= t[at], left[at], right[at])
            total += v[at]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, monotone: list[int], rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 64, ridge: float = 1.0, least: int = 10) -> Trees:
    """Boosted trees for the logistic loss over binned features.

    Where ``monotone`` is 1 or -1 the score never falls or never rises with that feature: a split must order its
    sides' values so, and what lies below each side stays beyond the middle of the two.
    """
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    rate_of = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    base = float(np.log(rate_of / (1 - rate_of)))
    raw, nodes = np.full(len(y), base), 2 ** (depth + 1) - 1
    made = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        tree = {k: np.zeros(nodes, d) for k, d in (("feature", np.int64), ("threshold", float), ("value", float))}
        tree["left"], tree["right"] = np.arange(nodes), np.arange(nodes)
        todo = [(0, np.arange(len(y)), -np.inf, np.inf, 0)]
        while todo:
            node, own, low, high, level = todo.pop()
            value = np.clip(g[own].sum() / (h[own].sum() + ridge), low, high)
            best = best_split(binned, g, h, own, edges, monotone, (low, high), ridge, least) if level < depth else None
            if best is None:
                tree["value"][node] = rate * value
                raw[own] += rate * value
                continue
            f, cut, a, b = best
            goes = binned[own, f] <= cut
            tree["feature"][node], tree["threshold"][node] = f, edges[f][cut]
            tree["left"][node], tree["right"][node] = 2 * node + 1, 2 * node + 2
            mid = (a + b) / 2
            bounds = {0: ((low, high), (low, high)), 1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}[monotone[f]]
            todo.append((2 * node + 1, own[goes], *bounds[0], level + 1))
            todo.append((2 * node + 2, own[~goes], *bounds[1], level + 1))
        made.append(tree)
    return Trees(*(np.stack([t[k] for t in made]) for k in ("feature", "threshold", "left", "right", "value")), base, depth)


def best_split(binned, g, h, own, edges, monotone, bounds, ridge, least):
    """``(feature, last bin on the left, value of the left, value of the right)`` of the best allowed split."""
    best, found = 1e-6, None
    all_g, all_h = g[own].sum(), h[own].sum()
    for f, cuts in enumerate(edges):
        if not len(cuts):
            continue
        b = binned[own, f]
        n, sg, sh = (np.bincount(b, w, len(cuts) + 1).cumsum()[:-1] for w in (np.ones(len(own)), g[own], h[own]))
        left, right = sg / (sh + ridge), (all_g - sg) / (all_h - sh + ridge)
        left, right = np.clip(left, *bounds), np.clip(right, *bounds)
        gain = sg**2 / (sh + ridge) + (all_g - sg) ** 2 / (all_h - sh + ridge) - all_g**2 / (all_h + ridge)
        gain[(n < least) | (len(own) - n < least) | (monotone[f] * (right - left) < 0)] = -1
        if (k := int(gain.argmax())) is not None and gain[k] > best:
            best, found = gain[k], (f, k, left[k], right[k])
    return found


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> Trees | None:
    """Trees fitted on at most ``max_rows`` labelled documents, chosen by a seeded hash; None without both classes."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = F.broadcast(sample_of(known, "doc_id", max_rows))  # max_rows rows of two numbers at most

    @F.pandas_udf("struct<" + ", ".join(f"{x}: bigint" for x in STATS) + ">")
    def statistics_of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics(t) for t in texts], columns=list(STATS), dtype="int64")

    rows = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "quality", statistics_of("text").alias("s"))
    # an id that repeats often must not lift the bound
    rows = rows.select("doc_id", "quality", "s.*").orderBy(F.xxhash64("doc_id"), *STATS).limit(max_rows).toPandas()
    if rows.quality.nunique() < 2:
        return None
    return fit_trees(features(rows), rows.quality.to_numpy(float), [m for _, m in FEATURES])


def quality_rules(docs: DataFrame, labels: DataFrame, least: float = 0.5, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """``docs`` with ``quality_stats`` (a struct of BASE), ``base_failed``, ``quality_score`` and ``kept``.

    ``base_failed``: under 50 words, or over half of the words in repeated 3-word windows. ``kept``: the base rules
    hold and the trees give ``least`` or more. A null or empty text has no words and so fails. Without labels of both
    classes the base rules decide alone (score null). Repeated rows get the same result each, and an empty table none; a very long text is read
    as a whole, one at a time. Columns of ``docs`` with these names are replaced.
    """
    trees = fit_quality(docs, labels, max_rows)

    @F.pandas_udf(f"struct<{', '.join(f'{x}: bigint' for x in BASE)}, score: double>")
    def scored(texts: pd.Series) -> pd.DataFrame:
        stats = pd.DataFrame([statistics(t) for t in texts], columns=list(STATS), dtype="int64")
        out = stats[list(BASE)].copy()
        out["score"] = trees.score(features(stats)) if trees is not None else None
        return out

    made = {"quality_stats": scored(F.col("text"))}
    out = docs.withColumns(made)
    n, again = F.col("quality_stats.n_words"), F.col("quality_stats.n_repeat_words")
    out = out.withColumn("base_failed", (n < MIN_WORDS) | (100 * again > MAX_REPEAT_PERCENT * n))
    out = out.withColumn("quality_score", F.col("quality_stats.score"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("quality_score", F.lit(1.0)) >= least))
