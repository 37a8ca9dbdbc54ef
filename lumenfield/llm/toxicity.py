"""Toxicity by a classifier chain of linear models over the presence of learned terms."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfield.llm.common import sample_of

TERM = re.compile(r"[^\W\d_]+|[^\w\s]+")
#: Labelled rows that the chain is fitted on, at most.
MAX_TRAIN_ROWS = 12000
#: Terms kept for each category.
TERMS = 128
FOLDS = 5
#: A term with a lower log-likelihood ratio is left out.
LEAST_RATIO = 3.0


def terms_of(text: str | None) -> set[str]:
    """Words and runs of marks, and the beginnings (5 and 7 letters) of longer words, as inflected and compound words share them."""
    whole = set(TERM.findall((text or "").lower()))
    return whole | {f"{w[:k]}-" for w in whole for k in (5, 7) if len(w) > k}


@dataclass
class Chain:
    """Linear models in order; model ``k`` sees the terms and the probabilities of the categories before it."""

    categories: list[str]
    terms: dict[str, int]
    weights: list[np.ndarray]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), 0))
        for w in self.weights:
            out = np.column_stack([out, sigmoid(design(x, out) @ w)])
        return out

    def matrix(self, texts: Iterable[str | None], rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Which terms each text has with the logarithm of how many distinct ones there are, and whether there are any; texts are read
        one at a time. The last lets a model expect chance hits in long texts."""
        x, some = np.zeros((rows, len(self.terms) + 1), np.float32), np.zeros(rows, bool)
        for i, text in enumerate(texts):
            own = terms_of(text)
            some[i] = bool(own)
            x[i, -1] = np.log1p(len(own)) / 5
            for t in own & self.terms.keys():
                x[i, self.terms[t]] = 1
        return x, some


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def design(x: np.ndarray, before: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(x)), before, x])


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps; the intercept isn't shrunk."""
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_chain(x: np.ndarray, y: np.ndarray, fold: np.ndarray, categories: Sequence[str], terms: dict[str, int]) -> Chain:
    """Later models are trained on out-of-fold probabilities of the earlier ones, as these are what unseen texts get."""
    before, weights = np.zeros((len(x), 0)), []
    for k in range(len(categories)):
        full = design(x, before)
        weights.append(fit_linear(full, y[:, k]))
        held = np.zeros(len(x))
        for f in np.unique(fold):
            out = fold == f
            held[out] = sigmoid(full[out] @ (fit_linear(full[~out], y[~out, k]) if (~out).any() else weights[-1]))
        before = np.column_stack([before, held])
    return Chain(list(categories), terms, weights)


def labelled_rows(docs: DataFrame, labels: DataFrame, categories: Sequence[str]) -> DataFrame:
    """All documents with a label in each category; a repeated label counts as its greatest value.

    The labels grow with the documents, so at every size the two meet by a shuffle, in which only the few numbers of a label are held.
    ``text`` is each text's distinct words, which have the same terms, as no term goes across ASCII white space; so repeated words aren't shuffled.
    """
    words = F.array_join(F.array_distinct(F.split("text", r"[\x20\x09-\x0D]+")), " ").alias("text")
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*(F.max(c).cast("int").alias(c) for c in categories))
    return docs.select("doc_id", words).join(known.dropna(subset=list(categories)).hint("shuffle_hash"), "doc_id")


def training_rows(docs: DataFrame, labels: DataFrame, categories: Sequence[str], max_rows: int) -> DataFrame:
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*(F.max(c).cast("int").alias(c) for c in categories))
    known = known.dropna(subset=list(categories))
    chosen = F.broadcast(sample_of(known, "doc_id", max_rows))  # max_rows rows of a few numbers at most
    return docs.select("doc_id", "text").join(chosen, "doc_id")


#: Distinct terms that a task counts before it hands them on.
HELD = 1 << 18


def term_counts(categories: Sequence[str]):
    """mapInPandas function: labelled texts to terms and how many texts, and how many of each category, have them."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, hits = Counter(), [Counter() for _ in categories]

        def made() -> pd.DataFrame:
            out = pd.DataFrame({"term": list(n), "n": list(n.values())} | {f"n_{c}": [h[t] for t in n] for c, h in zip(categories, hits)})
            for x in (n, *hits):
                x.clear()
            return out

        for pdf in batches:
            for text, *y in zip(pdf.text, *(pdf[c] for c in categories)):
                own = terms_of(text)
                n.update(own)
                for h, v in zip(hits, y):
                    if v:
                        h.update(own)
                if len(n) > HELD:
                    yield made()
        if n:
            yield made()

    return rows


def choose_terms(rows: DataFrame, categories: Sequence[str], per_category: int) -> dict[str, int]:
    """The terms with the highest log-likelihood ratio for each category, counted over all of ``rows``.

    Only terms that are at least twice as common in the category's texts count: others tell a language or a length, not a category.
    """
    total = rows.agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in categories)).first()
    schema = "term string, n long, " + ", ".join(f"n_{c} long" for c in categories)
    counts = rows.mapInPandas(term_counts(categories), schema).groupBy("term").agg(F.sum("n").alias("n"), *(F.sum(f"n_{c}").alias(f"n_{c}") for c in categories))
    counts = counts.filter("n >= 5").persist()
    chosen: dict[str, int] = {}
    for c in categories:
        if not total[c] or total[c] == total["n"]:
            continue
        k, n = F.col(f"n_{c}").cast("double"), F.col("n").cast("double")
        rate = F.lit(total[c] / total["n"])
        part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
        ratio = part(k, n * rate) + part(n - k, n * (1 - rate))
        marks = counts.filter((k >= 2 * n * rate) & (ratio >= LEAST_RATIO))
        for row in marks.orderBy(ratio.desc(), "term").limit(per_category).collect():
            chosen.setdefault(row["term"], len(chosen))
    counts.unpersist()
    return chosen


def fit_toxicity(docs: DataFrame, labels: DataFrame, categories: Sequence[str], max_rows: int = MAX_TRAIN_ROWS, per_category: int = TERMS) -> Chain:
    """A chain fitted on at most ``max_rows`` labelled documents, over terms that are counted in all of them; folds are by crc32 of the id."""
    terms = choose_terms(labelled_rows(docs, labels, categories), categories, per_category)
    rows = training_rows(docs, labels, categories, max_rows)
    chain = Chain(list(categories), terms, [])

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x, _ = chain.matrix(pdf.text, len(pdf))
            yield pdf.drop(columns="text").assign(terms=[np.flatnonzero(r[:-1]).tolist() for r in x], size=x[:, -1].astype(float))

    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)).cast("int")
    schema = ", ".join(["doc_id string", *(f"{c} int" for c in categories), "terms array<int>", "size double"])
    small = rows.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(present, schema)
    small = small.orderBy(F.xxhash64("doc_id"), F.hash("terms", "size")).limit(max_rows).withColumn("fold", fold).toPandas()
    if not len(small):
        return Chain(list(categories), {}, [np.array([-30.0] + [0.0] * (k + 1)) for k in range(len(categories))])
    x = np.zeros((len(small), len(terms) + 1), np.float32)
    x[:, -1] = small["size"]
    for i, own in enumerate(small.terms):
        x[i, list(own)] = 1
    return fit_chain(x, small[list(categories)].to_numpy(float), small.fold.to_numpy(), categories, terms)


def toxicity(docs: DataFrame, labels: DataFrame, categories: Sequence[str] = ("low_quality", "toxic"), least: float = 0.35, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """``docs`` with a probability ``p_<category>`` for each category and the boolean ``toxic`` (the last one's is ``least`` or more).

    ``labels`` has ``doc_id`` and a 0/1 column for each category, in the order of the chain. A null or empty text, or
    one without a term, is never toxic. Without labels every probability is near 0. Repeated rows get the same result each, and an empty table none; a very long text
    is read as a whole, one at a time. Columns of ``docs`` with the same names are replaced.
    """
    chain = fit_toxicity(docs, labels, categories, max_rows)
    names = [f"p_{c}" for c in categories]

    @F.pandas_udf("struct<" + ", ".join(f"{n}: double" for n in [*names, "empty"]) + ">")
    def scored(texts: pd.Series) -> pd.DataFrame:
        x, some = chain.matrix(texts, len(texts))
        return pd.DataFrame(chain.probabilities(x), columns=names).assign(empty=1.0 - some)

    out = docs.withColumn("__toxicity", scored(F.col("text")))
    out = out.withColumns({n: F.col(f"__toxicity.{n}") for n in names})
    hit = (F.col(f"__toxicity.{names[-1]}") >= least) & (F.col("__toxicity.empty") == 0)
    return out.withColumn("toxic", hit).drop("__toxicity")


def category_labels(labels: DataFrame) -> DataFrame:
    """The categories of the chain from the table ``labels``: junk first, as toxic junk differs from toxic prose."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), F.col("toxic"))
