"""Secret scan: pattern rules plus two character Markov models.

The rules find assignments, access keys and long hex strings.  Two first-order
Markov models over characters, one of random strings and one of ordinary
identifiers, add strings that no rule names: what the rules leave of a run of
key characters is a secret if its log-likelihood ratio (random against
ordinary) is high enough, and otherwise so are the words of its maximal
segments (Ruzzo and Tompa) whose ratio is.

The models are fitted on labelled samples: values that the rules find are
random strings, the other words of the same documents are ordinary.  The
fit reads a bounded sample of documents (``sample_docs``, chosen by a hash of
the id) and gathers one table of transition counts, of fixed size.  The scan
reads every text whole.
"""
from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, id_and_text, ident, sampled

#: Characters of keys; the models' states are these and the start (fixed values).
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
START = len(ALPHABET)
CODE = np.full(128, START, dtype=np.int64)
CODE[[ord(c) for c in ALPHABET]] = np.arange(START)

#: Rules in their order: kind, pattern, group whose length counts, least length (fixed values).
RULES = (
    ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                          r"([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]{32,}"), 0, 32),
)
KINDS = ("assign", "access", "hex", "markov")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
#: Characters that join the words of a run.
JOINERS = "+/_=-"
VALUE = re.compile(r"[:=]\x20*[\"']?")
WORD = re.compile(r"[A-Za-z0-9+/_.=-]{4,}")

SAMPLE_DOCS = 20_000
#: Least log-likelihood ratio, in nats, of an added span.
LEAST_RATIO = 12.0
#: Runs of fewer different characters (rulers, padding) are no candidates.
LEAST_DIFFERENT = 8
REDACTED = "[SECRET]"


@dataclass(frozen=True)
class Models:
    """``ratio[a, b]``: log P(b after a, random) - log P(b after a, ordinary)."""
    ratio: np.ndarray

    def gains(self, runs: list[str]) -> list[np.ndarray]:
        """The ratio of every character of every run, after the one before it in the run."""
        codes = CODE[np.frombuffer("\0".join(["", *runs]).encode("ascii"), np.uint8)]
        before, after = codes[:-1], codes[1:]
        inside = after < START
        gains = self.ratio[before[inside], after[inside]]
        return np.split(gains, np.cumsum([len(r) for r in runs])[:-1])

    def score(self, s: str) -> float:
        return float(self.gains([s])[0].sum())


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every rule match, leftmost and non-overlapping per kind."""
    out = []
    for k, (_, pattern, group, least) in enumerate(RULES):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), k, m.end()))
    return out


def all_spans(text: str, models: Models, least: float = LEAST_RATIO) -> list[tuple[int, int, int]]:
    """Rule matches, and key-like strings outside them with a high enough ratio, in order."""
    found = sorted(rule_spans(text))
    parts = [(s, e) for s, e in uncovered(text, _merged(found)) if len(set(text[s:e])) >= LEAST_DIFFERENT]
    added = []
    if parts:
        for (s, e), gains in zip(parts, models.gains([text[s:e] for s, e in parts]), strict=True):
            if gains.sum() >= least:
                added.append((s, e))
            elif np.maximum(gains, 0.0).sum() >= least:
                added += [(s + i, s + j) for i, j in best_words(text[s:e], gains.tolist(), least)]
    return sorted(found + [(s, KINDS.index("markov"), e) for s, e in added])


def uncovered(text: str, covered: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What the covered parts leave of every run of key characters."""
    begins = [s for s, _ in covered]
    for m in CANDIDATE.finditer(text):
        at = m.start()
        for s, e in covered[max(bisect.bisect_right(begins, at) - 1, 0):bisect.bisect_left(begins, m.end())]:
            if s > at:
                yield at, s
            at = max(at, e)
        if at < m.end():
            yield at, m.end()


def best_words(run: str, gains: list[float], least: float) -> list[tuple[int, int]]:
    """Maximal segments of at least ``least``, widened to whole words, without overlap."""
    out: list[tuple[int, int]] = []
    for i, j in maximal_segments(gains, least):
        while i and run[i - 1] not in JOINERS:
            i -= 1
        while j < len(run) and run[j] not in JOINERS:
            j += 1
        if out and i < out[-1][1]:
            i = out.pop()[0]
        out.append((i, j))
    return [(i, j) for i, j in out if len(set(run[i:j])) >= LEAST_DIFFERENT]


def maximal_segments(gains: list[float], least: float) -> list[tuple[int, int]]:
    """All maximal-sum segments of at least ``least``, in order, in linear time."""
    found: list[tuple[float, float, int, int, int]] = []  # sums before and after, ends, the one that begins lower
    total = 0.0
    for k, x in enumerate(gains):
        if x > 0:
            low, high, i = total, total + x, k
            last = len(found) - 1
            while True:
                while last >= 0 and found[last][0] >= low:
                    last = found[last][4]
                if last < 0 or found[last][1] >= high:
                    break
                low, _, i, _, before = found[last]
                del found[last:]
                last = before
            found.append((low, high, i, k + 1, last))
        total += x
    return [(i, j) for low, high, i, j, _ in found if high - low >= least]


def _merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The covered parts of a text, without overlap, in order."""
    out: list[tuple[int, int]] = []
    for s, _, e in spans:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def transitions(texts: list[str]) -> np.ndarray:
    """Counts [label, before, after] of a few texts; label 1: random strings."""
    counts = np.zeros((2, START + 1, START), dtype=np.int64)

    def add(label: int, words: list[str]) -> None:
        if words:
            joined = CODE[np.frombuffer("\0".join(["", *words]).encode("ascii"), np.uint8)]
            a, b = joined[:-1], joined[1:]
            inside = b < START
            np.add.at(counts[label], (a[inside], b[inside]), 1)

    for t in texts:
        spans = sorted(rule_spans(t))
        add(1, [VALUE.split(t[s:e], maxsplit=1)[-1] for s, _, e in spans])
        at = 0
        for s, e in [*_merged(spans), (len(t), len(t))]:
            add(0, [m[0] for m in WORD.finditer(t, at, s)])
            at = e
    return counts


def models_from(counts: np.ndarray) -> Models:
    """Ordinary transitions are smoothed by one each, random ones by 100 a state, evenly:
    the rules' values are mostly hexadecimal and other random strings are not."""
    random = counts[1] + 100.0 / START
    usual = counts[0] + 1.0
    return Models(np.log(random / random.sum(1, keepdims=True))
                  - np.log(usual / usual.sum(1, keepdims=True)))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        sample_docs: int = SAMPLE_DOCS) -> Models:
    """Both models from about ``sample_docs`` documents, chosen by a hash of the id.

    An empty sample gives models that differ in nothing, so that no span is added.
    """
    bounded_batches(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col)
    chosen = rows.where(sampled("doc_id", docs.count(), sample_docs))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, START + 1, START), dtype=np.int64)
        for b in batches:
            total += transitions(b["text"].tolist())
        label, before, after = np.nonzero(total)
        yield pd.DataFrame({"label": label, "before": before, "after": after,
                            "n": total[label, before, after]})

    summed = (chosen.select("text").mapInPandas(count, "label long, before long, after long, n long")
              .groupBy("label", "before", "after").agg(F.sum("n").alias("n")))
    counts = np.zeros((2, START + 1, START), dtype=np.int64)
    for r in summed.collect():  # 2 x 69 x 68 rows at most
        counts[r.label, r.before, r.after] = r.n
    return models_from(counts)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], REDACTED]
        at = max(at, e)
    return "".join(out) + text[at:]


def scan(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text",
         least_ratio: float = LEAST_RATIO) -> DataFrame:
    """One row per input row: ``doc_id`` and ``spans``, an array of
    (kind, start, end) in code points, end exclusive, by start and then kind.

    Null and empty texts have no spans.  Rows with equal or null ids are kept
    as they are, an empty table gives an empty table, other columns are
    ignored, and texts of any length are scanned whole.  There is no shuffle.
    """
    bounded_batches(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "spans": [
                [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in all_spans(t, models, least_ratio)]
                for t in b["text"]]})

    return rows.selectExpr("CAST(doc_id AS STRING) AS doc_id", "text").mapInPandas(
        find, "doc_id string, spans array<struct<kind: string, start: int, end: int>>").withColumn(
        "doc_id", F.col("doc_id").cast(rows.schema["doc_id"].dataType))


def redacted(docs: DataFrame, models: Models, text_col: str = "text", size_col: str | None = "n_chars",
             least_ratio: float = LEAST_RATIO) -> DataFrame:
    """``docs`` with every span of every text replaced by ``[SECRET]``.

    Rows and columns stay; ``size_col``, if there, becomes the new length in
    code points.  A null text stays null (and its size as it was).
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else redact(t, all_spans(t, models, least_ratio)))

    out = docs.withColumn(text_col, clean(ident(text_col)))
    if size_col in docs.columns:
        out = out.withColumn(size_col, F.when(
            ident(text_col).isNotNull(), F.length(ident(text_col))).otherwise(ident(size_col))
            .cast(docs.schema[size_col].dataType))
    return out
