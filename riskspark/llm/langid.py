"""Language of web pages by Bayesian fusion of evidence.

For every page and language four things are multiplied:

* the likelihood of the visible text under a character-trigram model, which is
  trained from documents of known language (a bounded sample, chosen by a hash);
* the probability of the language that the markup declares;
* the probability of the address's suffix;
* the prior of the host, smoothed over its registered domain and that over all
  pages: a host with few pages leans on its domain, a domain on the whole.

The last three are grouped sums, over all pages, of the posterior that the
text alone gives; a page's own share is taken out of its host's sums again.
"""
from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, ident, sampled, stored

SAMPLE_DOCS, MOST_GRAMS = 20_000, 30_000
#: Trigrams of one text are not independent: so many count at most.
MOST_EVIDENCE = 60.0
#: Pages that a domain counts for in its hosts' priors, and all pages in a domain's.
STRENGTH = 5.0
#: What begins a tag, and where that which is not shown ends.
TAG = re.compile(r"(?i)<(?:(?P<script>script\b)|(?P<style>style\b)|(?P<nav>nav\b)|(?P<comment>!--))?")
CLOSING = {k: re.compile(rf"(?i)</{k}\s*>") for k in ("script", "style", "nav")} | {"comment": re.compile("-->")}
NO_LETTER = re.compile(r"[\W\d_]+")


def visible(page: str) -> str:
    """The text between tags, without scripts, styles, navigation and comments.  What is never
    closed is looked for once, so that the time grows with the page, whatever is in it."""
    out, at, never = [], 0, set()
    while (i := page.find("<", at)) >= 0:
        tag, end = TAG.match(page, i), -1
        if tag.lastgroup and tag.lastgroup not in never:
            closing = CLOSING[tag.lastgroup].search(page, tag.end())
            if closing:
                end = closing.end()
            else:
                never.add(tag.lastgroup)
        if end < 0 and ">" not in never:
            end = page.find(">", i) + 1 or -1
            if end < 0:
                never.add(">")
        if end < 0:
            out.append(page[at:i + 1])
            at = i + 1
        else:
            out += page[at:i], " "
            at = end
    return entities.unescape("".join(out) + page[at:])


def grams(text: str) -> Counter:
    s = " " + NO_LETTER.sub(" ", text.lower()).strip() + " "
    return Counter(map("".join, zip(s, s[1:], s[2:], strict=False))) if len(s) > 2 else Counter()


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: dict[str, np.ndarray]  # log-probabilities of a trigram, by language

    def evidence(self, text: str) -> list[float]:
        """Log-probability of each language, evenly likely before, given the text."""
        k = len(self.languages)
        total, n = np.zeros(k), 0
        for g, times in grams(text).items():
            w = self.weights.get(g)
            if w is not None:
                total += times * w
                n += times
        if not n or not k:
            return [-float(np.log(max(k, 1)))] * k
        total *= min(n, MOST_EVIDENCE) / n
        total -= total.max()
        return (total - np.log(np.exp(total).sum())).tolist()


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        sample_docs: int = SAMPLE_DOCS, most_grams: int = MOST_GRAMS) -> Model:
    """The text model from about ``sample_docs`` documents; rows without text or language
    teach nothing.  Its trigrams are the ``most_grams`` commonest of the sample."""
    bounded_batches(docs.sparkSession)
    rows = docs.where(sampled(id_col, docs.count(), sample_docs)).select(
        ident(text_col).alias("text"), ident(lang_col).cast("string").alias("lang")).dropna()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found: dict[str, Counter] = {}
            for t, lang in zip(b["text"], b["lang"], strict=True):
                found.setdefault(lang, Counter()).update(grams(t))
            for lang, c in found.items():
                yield pd.DataFrame({"lang": lang, "gram": list(c), "n": list(c.values())})

    counted = rows.mapInPandas(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    by_gram = (counted.groupBy("gram").agg(F.sum("n").alias("all"), F.map_from_entries(
        F.collect_list(F.struct("lang", "n"))).alias("by")).orderBy(F.desc("all"), "gram").limit(most_grams).collect())
    languages = sorted({x for r in by_gram for x in r.by})
    if not languages:
        return Model([], {})
    counts = np.array([[r.by.get(x, 0) for x in languages] for r in by_gram], dtype=float) + 0.5
    logs = np.log(counts / counts.sum(axis=0))
    return Model(languages, {r.gram: logs[i] for i, r in enumerate(by_gram)})


def identify(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url",
             html_col: str = "html") -> DataFrame:
    """One row per input row: ``page_id``, ``lang``, ``probability``, and what it comes from:
    ``text_lang``, ``declared``, ``suffix`` and ``host``.

    A null or empty page has no text evidence, a page without declaration or
    address the declaration or host "", which counts as a value like others.
    Equal probabilities: the first language by name.  Rows with equal or null
    ids are kept, an empty table gives an empty table, other columns are
    ignored; texts are read whole.  A model without languages gives nulls.
    """
    bounded_batches(pages.sparkSession)
    page, url = F.coalesce(ident(html_col), F.lit("")), F.coalesce(ident(url_col), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(ident(id_col).alias("page_id"), host.alias("host"), page.alias("page"), F.lower(
        F.regexp_extract(page, r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([a-z]{2})", 1)).alias("declared"))
    languages = model.languages
    if not languages:
        return rows.select("page_id", F.lit(None).cast("string").alias("lang"),
                           F.lit(None).cast("double").alias("probability"),
                           F.lit(None).cast("string").alias("text_lang"), "declared",
                           F.element_at(F.split("host", r"\."), -1).alias("suffix"), "host")

    @F.pandas_udf("array<double>")
    def heard(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: model.evidence(visible(t)))

    names = F.split("host", r"\.")
    known = F.when((F.col("declared") == "") | F.col("declared").isin(languages), F.col("declared")).otherwise(F.lit("?"))
    seen = stored(rows.select(
        "page_id", "host", "declared", known.alias("declares"), heard("page").alias("text"),
        F.element_at(names, -1).alias("suffix"),
        F.array_join(F.slice(names, F.greatest(F.size(names) - 1, F.lit(1)), 2), ".").alias("domain")), "page-evidence")
    every = range(len(languages))

    def sums(by: list[str], name: str) -> DataFrame:
        return seen.groupBy(*by).agg(F.array(*[F.sum(F.exp(F.col("text")[k])) for k in every]).alias(name))

    whole = sums([], "n").first()[0]
    whole = [x or 0.0 for x in whole]
    n = sum(whole) or 1.0
    prior = [(x + 1.0) / (n + len(languages)) for x in whole]

    def smoothed(counts: Column, above: list[Column], own: Column | None = None) -> Column:
        taken = [counts[k] - (F.exp(own[k]) if own is not None else F.lit(0.0)) for k in every]
        total = sum(taken[1:], taken[0])
        return F.array(*[(F.greatest(taken[k], F.lit(0.0)) + STRENGTH * above[k]) / (total + STRENGTH) for k in every])

    def likelihood(counts: Column) -> Column:
        """P(value | language) up to a factor that all languages share."""
        return F.array(*[(counts[k] + F.lit(prior[k])) / F.lit(whole[k] + 1.0) for k in every])

    domains = sums(["domain"], "in_domain")
    hosts = sums(["domain", "host"], "in_host").join(domains, "domain").select(
        "host", "in_host", smoothed(F.col("in_domain"), [F.lit(p) for p in prior]).alias("domain_prior"))
    suffixes = sums(["suffix"], "by_suffix")
    declarations = F.broadcast(sums(["declares"], "by_declared"))  # one row a language, and two
    text = F.col("text")
    joined = seen.join(declarations, "declares").join(suffixes, "suffix").join(hosts, "host")
    host_prior = smoothed(F.col("in_host"), [F.col("domain_prior")[k] for k in every], text)
    fused = joined.select("page_id", "host", "declared", "suffix", "text", host_prior.alias("p"),
                          likelihood(F.col("by_declared")).alias("d"), likelihood(F.col("by_suffix")).alias("s"))
    judged = fused.withColumn("odds", F.array(*[
        text[k] + F.log(F.col("p")[k]) + F.log(F.col("d")[k]) + F.log(F.col("s")[k]) for k in every]))
    best, heard_best = F.array_max("odds"), F.array_max("text")
    shares = F.aggregate("odds", F.lit(0.0), lambda a, x: a + F.exp(x - best))
    names = F.array(*[F.lit(x) for x in languages])
    return judged.select(
        "page_id", F.element_at(names, F.array_position("odds", best).cast("int")).alias("lang"),
        (F.lit(1.0) / shares).alias("probability"),
        F.element_at(names, F.array_position("text", heard_best).cast("int")).alias("text_lang"),
        "declared", "suffix", "host")
