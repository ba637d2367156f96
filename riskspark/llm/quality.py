"""Quality rules as weak supervision, in DataFrame functions.

Each rule looks at a text's counts and votes for quality (1), against it (-1)
or abstains (0).  No rule decides alone: expectation-maximisation over all
documents' votes estimates how often each rule votes either way on good and
on bad texts, and the posterior probability of quality gives the verdict.

Documents with equal votes are summed up before the estimation, which then
sees at most 3 ** rules rows (8 rules: 6,561), whatever the corpus.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, stored

SPACE = "[ \\t-\\r]+"
#: Verdict: kept from this posterior probability on.
LEAST_QUALITY = 0.5
ROUNDS, PRIOR = 100, 0.8
#: Pseudo-counts of the votes (against, abstain, for) on bad and on good texts, a share of
#: the documents.  They say which class is which (most rules find nothing wrong with a bad
#: text, but votes against good ones are rare), and keep a rule from being certain.
BELIEF, BAD, GOOD = 0.01, (0.25, 0.15, 0.6), (0.005, 0.25, 0.745)
#: Known of every rule, whatever the estimate: it votes against a good text this rarely, and
#: for a bad one this often, as a bad text mostly fails one or two rules and passes the rest.
MOST_WRONG, LEAST_PASSED = 0.002, 0.8


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words in windows of three words that are found twice or more in the text.

    Windows are hashed, sorted with their places, and compared with their
    neighbours; the places found cover three words each, less what they share.
    """
    n = F.size(words)
    two = F.zip_with(F.slice(words, 1, F.greatest(n - 2, F.lit(0))), F.slice(words, 2, F.greatest(n - 2, F.lit(0))),
                     lambda a, b: F.struct(a, b))
    three = F.zip_with(two, F.slice(words, 3, F.greatest(n - 2, F.lit(0))), lambda ab, c: F.xxhash64(ab, c))

    def covered(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(placed, again))

    def again(p: Column) -> Column:
        own = F.transform(p, lambda x: x["h"])
        size = F.size(p)
        found = _let(own, lambda h: F.filter(F.transform(p, lambda x, i: F.when(
            ((i > 0) & (F.get(h, i - 1) == x["h"])) | ((i < size - 1) & (F.get(h, i + 1) == x["h"])), x["i"])),
            lambda x: x.isNotNull()))
        return _let(F.array_sort(found), lambda at: F.aggregate(
            F.zip_with(F.slice(at, 1, F.greatest(F.size(at) - 1, F.lit(0))),
                       F.slice(at, 2, F.greatest(F.size(at) - 1, F.lit(0))),
                       lambda a, b: F.least(b - a, F.lit(3))), F.lit(3), lambda s, x: s + x))

    return F.when(n < 3, F.lit(0)).otherwise(_let(three, covered)).cast("long")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of every text: ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``n_capitals``, ``n_stops`` and ``n_different``."""
    rows = id_and_text(docs, id_col, text_col)
    text = F.col("text")
    words = F.array_remove(F.split(text, SPACE), "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.regexp_replace(x, SPACE, "")) > 0)

    def counted(w: Column) -> Column:
        joined = F.array_join(w, "")
        return F.struct(
            F.size(w).cast("long").alias("n_words"), F.length(joined).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
            F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long").alias("n_capitals"),
            F.length(F.regexp_replace(text, "[^.,;:?]+", "")).cast("long").alias("n_stops"),
            F.size(F.array_distinct(w)).cast("long").alias("n_different"))

    return rows.select("doc_id", _let(words, counted).alias("m")).select("doc_id", "m.*")


def rules() -> dict[str, Column]:
    """Vote of each rule: -1, 0 or 1."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")

    def by(value: Column, good, bad) -> Column:
        return F.when(good(value), F.lit(1)).when(bad(value), F.lit(-1)).otherwise(F.lit(0))

    return {
        "length": by(F.col("n_words"), lambda x: x >= 100, lambda x: x < 30),
        "word_length": by(chars / n, lambda x: (x >= 3.5) & (x <= 8), lambda x: (x < 2.5) | (x > 11)),
        "symbols": by(F.col("n_symbols") / chars, lambda x: x < 0.01, lambda x: x > 0.1),
        "lines": by(F.col("n_dup_lines"), lambda x: x == 0, lambda x: x > 3),
        "repeats": by(F.col("n_repeat_words") / n, lambda x: x < 0.15, lambda x: x > 0.4),
        "capitals": by(F.col("n_capitals") / chars, lambda x: x < 0.15, lambda x: x > 0.35),
        "stops": by(F.col("n_stops") / n, lambda x: (x > 0.03) & (x < 0.4), lambda x: (x < 0.005) | (x > 0.8)),
        "variety": by(F.col("n_different") / n, lambda x: (n < 200) & (x > 0.5) | (x > 0.3), lambda x: x < 0.1),
    }


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> tuple[float, list[dict[int, float]]]:
    """EM over (votes, documents): the log-odds of quality, and what each vote of each
    rule adds to them."""
    total = sum(n for _, n in patterns)
    k = len(patterns[0][0]) if patterns else 0
    values = (-1, 0, 1)
    rate = {c: [dict(zip(values, b, strict=True)) for _ in range(k)] for c, b in ((0, BAD), (1, GOOD))}
    prior = PRIOR
    for _ in range(rounds):
        mass = {0: 0.0, 1: 0.0}
        votes = {c: [{v: BELIEF * total * b for v, b in zip(values, belief, strict=True)} for _ in range(k)]
                 for c, belief in ((0, BAD), (1, GOOD))}
        for p, n in patterns:
            like = [math.log(1 - prior), math.log(prior)]
            for c in (0, 1):
                like[c] += sum(math.log(rate[c][r][v]) for r, v in enumerate(p))
            good = 1.0 / (1.0 + math.exp(min(max(like[0] - like[1], -700.0), 700.0)))
            for c, share in ((0, 1.0 - good), (1, good)):
                mass[c] += n * share
                for r, v in enumerate(p):
                    votes[c][r][v] += n * share
        prior = min(max(mass[1] / max(total, 1), 0.01), 0.99)
        for c in (0, 1):
            for r in range(k):
                s = sum(votes[c][r].values())
                if s > 0:
                    got = {v: x / s for v, x in votes[c][r].items()}
                    rate[c][r] = (_held(got, -1, min(got[-1], MOST_WRONG)) if c
                                  else _held(got, 1, max(got[1], LEAST_PASSED)))
    return (math.log(prior / (1 - prior)),
            [{v: math.log(rate[1][r][v] / rate[0][r][v]) for v in values} for r in range(k)])


def _held(rate: dict[int, float], vote: int, value: float) -> dict[int, float]:
    """``rate`` with that of one vote set, the others in proportion."""
    rest = sum(x for v, x in rate.items() if v != vote)
    return {v: value if v == vote else max(x * (1.0 - value) / rest, 1e-9) if rest > 0 else 1e-9
            for v, x in rate.items()}


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          least_quality: float = LEAST_QUALITY) -> DataFrame:
    """One row per input row: the counts, each rule's vote (``vote_<rule>``), ``quality``
    (posterior probability) and ``kept``.

    Null and empty texts have no words: their counts are 0.  Rows with equal or
    null ids are kept as they are, an empty table gives an empty table, other
    columns are ignored, and texts of any length are read whole.
    """
    votes = rules()
    names = [f"vote_{r}" for r in votes]
    seen = stored(measures(docs, id_col, text_col).select("*", *[v.alias(f"vote_{r}") for r, v in votes.items()]),
                  "votes")
    patterns = sorted((tuple(r[c] for c in names), r["n"]) for r in seen.groupBy(*names).agg(
        F.count(F.lit(1)).alias("n")).collect())
    base, weights = estimate(patterns)
    odds = F.lit(base)
    for name, w in zip(names, weights, strict=False):
        odds = odds + F.when(F.col(name) == 1, F.lit(w[1])).when(F.col(name) == -1, F.lit(w[-1])).otherwise(F.lit(w[0]))
    quality = F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))
    return seen.withColumn("quality", quality).withColumn("kept", F.col("quality") >= least_quality)
