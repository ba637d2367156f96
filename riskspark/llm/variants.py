"""Spelling variants: words one edit apart, found in a frequency-vector trie.

The letters are dealt into groups; a word's vector counts its letters of each
group.  One edit changes the vector by a surplus of one at most (a letter more)
and a deficit of one at most (a letter less).  The trie branches on the counts,
group by group.  The levels at its top have large groups and are the keys by which
Spark deals words to tasks: a word goes to its own key, and as a query to each
key that is one surplus and one deficit away at most (of two keys, the smaller
one's words are the queries, so that a pair is met once).  Below that, the groups
are small, and a task searches its part of the trie depth first; a letter counts
in one group of either kind, so that the budget is one and one in both.  At the
leaves the words themselves are compared.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .classes import _flat
from .common import bounded_batches, id_and_text, stored
from .packs import batch, by_key, groups

#: Letters of a run, and the numbers of the contract (fixed values).
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLIP, SHORTEST, RAREST, TIMES = 199, 6, 5, 5

#: Levels at the top of the trie, by which words are dealt: the counts of these split words evenly.
TOP = ["eot", "anl", "irc", "sud"]
#: Levels below; all letters that have no group here are one level more.
LEVELS = ["e", "o", "a", "n", "i", "r", "s", "u", "l", "d", "mw", "pb", "ghj", "fvz", "kqyx"]
#: Search states, or pairs to compare, in one go.
STATES = 1 << 17
#: Longer words are compared one pair at a time.
LONG = 40


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of all texts and how often they occur.

    A run of letters loses one of them if SLIP divides the checksum of its id and
    itself; results under SHORTEST letters or RAREST occurrences are no words.
    """
    rows = id_and_text(docs, id_col, text_col)
    run = F.translate("run", CAPITALS, SMALL)
    rows = (rows.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"({RUN})"))).alias("run"))
            .where(F.length("run") >= SHORTEST).select("doc_id", run.alias("run")))
    check = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    at = F.pmod("check", F.length("run")).cast("int")
    word = F.when(F.col("check") % SLIP == 0, F.concat(
        F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))).otherwise(F.col("run"))
    return (rows.withColumn("check", check).withColumn("at", at).select(word.alias("word"))
            .where(F.length("word") >= SHORTEST)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= RAREST))


def _count(letters: str) -> Column:
    """How many letters of the group a word has."""
    return (F.length("word") - F.length(F.translate("word", letters, ""))).cast("int")


def dealt(vocabulary: DataFrame, spread: int = len(TOP)) -> DataFrame:
    """(key, query, word, n): every word under its own key and, as a query, under the larger
    keys that its budget reaches.  A key is the counts of the first ``spread`` levels."""
    own = F.array(*[_count(g) for g in TOP[:spread]])
    steps = [[0] * spread]
    for more in range(-1, spread):
        for less in range(-1, spread):
            step = [(k == more) - (k == less) for k in range(spread)]
            if next((x for x in step if x), 0) > 0:
                steps.append(step)
    keyed = vocabulary.select("word", "n", own.alias("own"), F.explode(F.array(*[
        F.array(*[F.lit(x) for x in s]) for s in steps])).alias("step"))
    key = F.zip_with("own", "step", lambda a, b: a + b)
    return (keyed.select(key.alias("key"), (F.array_max(F.transform("step", F.abs)) > 0).cast("int").alias("query"), "word", "n")
            .where(F.array_min("key") >= 0)
            .select(F.array_join("key", ",").alias("key"), "query", "word", "n"))


class Words:
    """Words as rows of Latin-1 letters, with their vectors."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        raw = [t.encode("latin-1") for t in texts]
        self.length = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(self.length)
        letters = np.frombuffer(b"".join(raw), np.uint8)
        self.letters = np.zeros((len(raw), LONG), np.uint8)  # of the long ones only a beginning
        row = np.repeat(np.arange(len(raw)), self.length)
        column = np.arange(len(letters)) - np.repeat(ends - self.length, self.length)
        short = column < LONG
        self.letters[row[short], column[short]] = letters[short]
        self.vector = np.zeros((len(raw), len(LEVELS) + 1), np.int64)
        rest = np.ones(256, bool)
        for k, group in enumerate([*LEVELS, None]):
            of = rest
            if group is not None:
                of = np.zeros(256, bool)
                of[list(group.encode("latin-1"))] = True
                rest &= ~of
            self.vector[:, k] = np.bincount(row[of[letters]], minlength=len(raw))


class Trie:
    """The part of the trie below one key, as sorted arrays of children."""

    def __init__(self, own: Words):
        counts = own.vector
        self.order = np.lexsort(counts.T[::-1])
        counts = counts[self.order]
        self.base = int(counts.max(initial=0)) + 2
        self.children = []
        node = np.zeros(len(counts), np.int64)
        for c in counts.T:
            edge = node * self.base + c
            new = np.diff(edge, prepend=-1) != 0
            self.children.append(edge[new])
            node = np.cumsum(new) - 1
        self.leaf = np.append(np.flatnonzero(new), len(counts)) if len(counts) else np.zeros(1, np.int64)

    def search(self, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, word) indexes, some at a time, of the words that a budget of one and one reaches.

        A stack holds states (query, node, surplus and deficit left) of one level each;
        the deepest are taken first, at most STATES at a time, which bounds the memory.
        """
        one = np.ones(len(counts), np.int64)
        stack = [(0, np.arange(len(counts)), 0 * one, one, one)]
        while stack:
            level, query, node, more, less = stack.pop()
            if len(query) > STATES:
                stack.append((level, query[STATES:], node[STATES:], more[STATES:], less[STATES:]))
                query, node, more, less = query[:STATES], node[:STATES], more[:STATES], less[:STATES]
            if level == len(self.children):
                n = self.leaf[node + 1] - self.leaf[node]
                for part in np.split(np.arange(len(n)), np.flatnonzero(np.diff(np.cumsum(n) // STATES)) + 1):
                    k = n[part]
                    at = np.repeat(self.leaf[node[part]] - (np.cumsum(k) - k), k) + np.arange(k.sum())
                    yield np.repeat(query[part], k), self.order[at]
                continue
            edges, count = self.children[level], counts[query, level]
            found = []
            for step in (-1, 0, 1):
                go = np.flatnonzero((count + step >= 0) & (count + step < self.base)
                                    & ((more > 0) if step > 0 else (less > 0) if step < 0 else True))
                edge = node[go] * self.base + count[go] + step
                child = np.minimum(np.searchsorted(edges, edge), len(edges) - 1)
                here = edges[child] == edge
                go, child = go[here], child[here]
                found.append((query[go], child, more[go] - (step > 0), less[go] - (step < 0)))
            query, node, more, less = map(np.concatenate, zip(*found, strict=True))
            if len(query):
                stack.append((level + 1, query, node, more, less))


def one_edit(a: str, b: str) -> bool:
    """Do two texts differ by exactly one inserted, deleted or replaced character?"""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def verified(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """:func:`one_edit` of the words ``a[i]`` and ``b[j]``, pair by pair."""
    swap = a.length[i] > b.length[j]
    x, y = a.letters[i], b.letters[j]
    x[swap], y[swap] = y[swap], x[swap]
    short, long = np.minimum(a.length[i], b.length[j]), np.maximum(a.length[i], b.length[j])
    differ = x != y
    same = short == long
    ok = same & (differ.sum(axis=1) == 1)
    # one longer: from the first difference on, the longer word is shifted by one
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), LONG)
    shifted = x[:, :-1] != y[:, 1:]
    last = np.where(shifted.any(axis=1), LONG - 2 - shifted[:, ::-1].argmax(axis=1), -1)
    ok |= (long == short + 1) & (last < first)
    for k in np.flatnonzero(long > LONG):
        ok[k] = one_edit(a.texts[i[k]], b.texts[j[k]])
    return ok


PAIR = "word string, n long, near string, near_n long"


def near(vocabulary: DataFrame, spread: int = len(TOP)) -> DataFrame:
    """(word, n, near, near_n): all pairs of words one edit apart, each in both directions."""
    bounded_batches(vocabulary.sparkSession)

    def run(batches):
        for rows in groups(batches, "key"):
            own = [r for r in rows if not r["query"]]
            asking = [r for r in rows if r["query"]]
            if not own:
                continue
            have = Words([r["word"] for r in own])
            trie = Trie(have)
            for mine, these in ((True, own), (False, asking)):
                if not these:
                    continue
                asks = have if mine else Words([r["word"] for r in these])
                for q, w in trie.search(asks.vector):
                    ok = verified(asks, q, have, w)
                    q, w = q[ok], w[ok]
                    left = [these[k] for k in q.tolist()], [own[k] for k in w.tolist()]
                    for x, y in (left,) if mine else (left, left[::-1]):
                        if x:
                            yield batch(PAIR, [[r["word"] for r in x], [r["n"] for r in x],
                                               [r["word"] for r in y], [r["n"] for r in y]])

    return by_key(dealt(vocabulary, spread), "key", "query").mapInArrow(run, PAIR)


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spread: int = len(TOP)) -> DataFrame:
    """One row per word of the texts: ``word``, ``n``, ``n_near`` (words one edit apart),
    ``form`` (the most frequent of these, of equal ones the least, if it is TIMES as
    frequent as the word; else null), ``form_n`` and ``root``, the end of the chain of forms.

    Null and empty texts have no words; a null id counts as an empty one.  Repeated
    rows count each time.  An empty table, or one without words, gives an empty
    table.  Other columns are ignored.  A run of letters of any length is one word.
    ``spread``: levels of the trie by which words are dealt to tasks; more of them
    make more and smaller tasks and more copies of a word.
    """
    vocabulary = stored(words(docs, id_col, text_col), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    of = near(vocabulary, spread).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    formed = F.col("n") * TIMES <= -F.col("best.n")
    found = stored(vocabulary.join(of, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(formed, F.col("best.word")).alias("form"), F.when(formed, -F.col("best.n")).alias("form_n")), "forms")
    # A form is TIMES as frequent as its word, so that chains are short and end.
    roots = _flat(found.where("form IS NOT NULL").select(F.col("word").alias("node"), F.col("form").alias("parent")))
    return found.join(roots.select(F.col("node").alias("word"), F.col("parent").alias("root")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
