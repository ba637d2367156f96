"""Toxicity by non-negative positive-unlabelled learning.

A linear numpy classifier is trained from confirmed toxic texts (P) and
unlabelled texts (U) with the class-prior-corrected, non-negative risk

    prior * mean_P loss(+f) + max(0, mean_U loss(-f) - prior * mean_P loss(-f)),

where loss is the logistic loss.  Texts labelled as harmless are not used.
Features are the presence of words, and of word beginnings and ends in one,
two or three different words; those kept are much commoner in P than in U.

The fit reads at most about ``most_positive`` and ``most_unlabelled`` texts,
chosen by a hash of the id.  Feature counts are summed by Spark; the driver
gets the chosen features and the feature indices of the sample only.  Every
text is scored whole, where it is read.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, id_and_text, ident, sampled, stored

MOST_POSITIVE = 5_000
MOST_UNLABELLED = 20_000
#: Features: so many at most, in so many texts of P at least, so much commoner there
#: than in other texts, and by chance with a probability of exp(-16) at most.
MOST_FEATURES, LEAST_TEXTS, LEAST_LIFT, LEAST_SURPRISE = 1024, 5, 3.0, 16.0
#: So many of the most telling features bound the class prior.
TELLING = 10
THRESHOLD = 0.3
WORD = re.compile(r"\w+")
#: Words a worker remembers as having no feature.
CACHE_WORDS = 400_000
AFFIXES = (4, 5, 6)


def features_of(word: str) -> list[str]:
    out = ["=" + word]
    for n in AFFIXES:
        if len(word) > n:
            out += ["<" + word[:n], ">" + word[-n:]]
    return out


def text_features(text: str) -> set[str]:
    """Features of a text: of each of its words, and (marked 2 or 3) beginnings and
    ends that two, or three, different words share."""
    times = Counter(f for w in set(WORD.findall(text.lower())) for f in features_of(w))
    return {*times, *("2" + f for f, n in times.items() if n > 1),
            *("3" + f for f, n in times.items() if n > 2)}


@dataclass
class Model:
    """Weights by feature, and the weight of every text."""
    weights: dict[str, float]
    bias: float

    def __post_init__(self):
        self._plain: set[str] = set()
        self._single = {f.lstrip("23") for f in self.weights}

    def score(self, text: str) -> float:
        words = set(WORD.findall(text.lower())) - self._plain
        found: Counter = Counter()
        for w in words:
            own = [f for f in features_of(w) if f in self._single]
            if own:
                found.update(own)
            else:
                self._plain.add(w)
        if len(self._plain) > CACHE_WORDS:
            self._plain.clear()
        f = self.bias + sum(self.weights.get(mark + x, 0.0) for x, n in sorted(found.items())
                            for mark in ("", "2", "3")[:n])
        return float(1.0 / (1.0 + np.exp(-np.clip(f, -30.0, 30.0))))


def held_out(id_col: str = "doc_id"):
    """Rows whose labels nothing may learn from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(ident(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def nnpu(p: np.ndarray, u: np.ndarray, prior: float, steps: int = 800, rate: float = 0.05,
         decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias that lower the non-negative risk (Adam, whole batches).

    Where the corrected negative part falls below nought, the step goes back
    along its gradient instead, as the method has it.
    """
    d = p.shape[1]
    w, m, v = np.zeros(d + 1), np.zeros(d + 1), np.zeros(d + 1)
    w[-1] = np.log(prior / (1.0 - prior))
    p1, u1 = np.hstack([p, np.ones((len(p), 1))]), np.hstack([u, np.ones((len(u), 1))])
    for step in range(1, steps + 1):
        sp, su = 1.0 / (1.0 + np.exp(-p1 @ w)), 1.0 / (1.0 + np.exp(-u1 @ w))
        positive = prior * (p1.T @ (sp - 1.0)) / len(p1)
        negative = u1.T @ su / len(u1) - prior * (p1.T @ sp) / len(p1)
        risk = -np.log1p(-np.clip(su, 0, 1 - 1e-12)).mean() + prior * np.log1p(
            -np.clip(sp, 0, 1 - 1e-12)).mean()
        g = positive + negative if risk >= 0 else -negative
        g[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", most_positive: int = MOST_POSITIVE,
        most_unlabelled: int = MOST_UNLABELLED) -> Model:
    """The classifier from toxic rows of ``labels`` that are not held out.

    The class prior is the share of toxic rows among those, or less if U has fewer
    of the most telling features than that share says.  Without a toxic row, or
    without any text, the model has no features and scores 0.01.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    known = labels.where(~held_out(id_col)).select(
        ident(id_col).alias("doc_id"), (ident(label_col) == 1).alias("toxic")).dropna()
    n, positives = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("toxic").cast("long")), F.lit(0))).first()
    if not positives:
        return Model({}, float(np.log(0.01 / 0.99)))
    prior = min(max(positives / n, 1e-3), 0.5)
    rows = id_and_text(docs, id_col, text_col)
    ids = known.where("toxic").where(sampled("doc_id", positives, most_positive)).select("doc_id").distinct()
    p = rows.join(F.broadcast(ids), "doc_id").select("text", F.lit(1).alias("p"))
    u = (rows.where(~held_out() & sampled("doc_id", docs.count(), most_unlabelled))
         .select("text", F.lit(0).alias("p")))
    sample = stored(p.unionByName(u), "toxicity-sample")
    sizes = {r.p: r.n for r in sample.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}
    np_, nu = sizes.get(1, 0), sizes.get(0, 0)
    if not np_ or not nu:
        return Model({}, float(np.log(0.01 / 0.99)))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found: Counter = Counter()
            for t, y in zip(b["text"], b["p"], strict=True):
                found.update((f, y) for f in text_features(t))
            yield pd.DataFrame({"feature": [f for f, _ in found], "p": [y for _, y in found],
                                "n": list(found.values())})

    counted = sample.mapInPandas(count, "feature string, p int, n long").groupBy("feature").agg(
        F.sum(F.when(F.col("p") == 1, F.col("n")).otherwise(0)).alias("in_p"),
        F.sum(F.when(F.col("p") == 0, F.col("n")).otherwise(0)).alias("in_u"))
    a, b = (F.col("in_p") + 0.5) / (np_ + 1.0), (F.col("in_u") + 0.5) / (nu + 1.0)
    b = F.greatest((b - prior * a) / (1.0 - prior), F.lit(0.5 / (nu + 1.0)))  # U without its toxic share
    # Chernoff: so many texts of P have a feature of rate b with probability exp(-surprise) at most
    surprise = np_ * (a * F.log(a / b) + (1 - a) * F.log((1 - a) / (1 - b)))
    chosen = [r.feature for r in counted.where(
        (F.col("in_p") >= LEAST_TEXTS) & (a / b >= LEAST_LIFT) & (surprise >= LEAST_SURPRISE))
        .orderBy(surprise.desc(), "feature").limit(MOST_FEATURES).select("feature").collect()]
    if not chosen:
        return Model({}, float(np.log(0.01 / 0.99)))
    index = {f: i for i, f in enumerate(chosen)}

    def indexed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"p": b["p"], "found": [
                sorted(index[f] for f in text_features(t) if f in index) for t in b["text"]]})

    got = sample.mapInPandas(indexed, "p int, found array<int>").collect()  # the bounded sample
    x = {1: np.zeros((np_, len(chosen)), np.float32), 0: np.zeros((nu, len(chosen)), np.float32)}
    at = {0: 0, 1: 0}
    for r in sorted(got, key=lambda r: (r.p, r.found)):
        x[r.p][at[r.p], r.found] = 1.0
        at[r.p] += 1
    # U has the share ``prior`` of P's features and more: the most telling ones bound the prior
    # from above, should toxic texts be labelled more often than others.
    hits = {y: float(x[y][:, :TELLING].any(axis=1).mean()) for y in x}
    if hits[1] > 0:
        prior = min(prior, max(hits[0] / hits[1], 1e-3))
    w, bias = nnpu(x[1], x[0], prior)
    return Model({f: float(w[i]) for f, i in index.items()}, bias)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``score`` (0 to 1, higher: toxic likelier).

    Null and empty texts have the score of a text without features.  Rows
    with equal or null ids are kept, an empty table gives an empty table,
    other columns are ignored, texts of any length are read whole.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return texts.map(_shared(model).score)

    rows = id_and_text(docs, id_col, text_col)
    return rows.select("doc_id", scored("text").alias("score"))


def clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``; all columns stay."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("boolean")
    def harmless(texts: pd.Series) -> pd.Series:
        return texts.map(_shared(model).score) < threshold

    return docs.where(harmless(F.coalesce(ident(text_col), F.lit(""))))


_MODELS: dict[tuple, Model] = {}


def _shared(model: Model) -> Model:
    """One copy of a model in each worker, so that its word memory lasts over tasks."""
    key = (model.bias, len(model.weights), sum(model.weights.values()))
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = model
    return _MODELS[key]
