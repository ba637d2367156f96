"""Alignment of two tokenizers by sparse products of token-byte incidence matrices.

Rows of ``A`` and ``B`` are the tokens of the two tokenizers, columns the bytes of
the texts.  ``A * B^T`` (Gustavson's product, row by row) has an entry for every
pair of tokens with a byte in common: the *links*.  Bytes at which tokens of both
end cut a text into *groups*; the product of the group incidences with ones
counts the pairs that share a group without making them.

Every pack of documents keeps its own matrix (document x id pair, entries: links).
How many documents have an id pair is a grouped sum over all packs, and which
pair is the most frequent of its A id a grouped maximum.  Both go back to the
packs, where a product of the matrix with each of them gives a document's sums.
"""
from __future__ import annotations

import json
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_alphabet
from .common import bounded_batches, id_and_text, slices, stored
from .packs import batch, by_key, groups, none, numbered, opened, shut

PACK_BYTES = 8_000_000
BATCH_BYTES = 1_000_000
Csr = tuple[np.ndarray, np.ndarray, np.ndarray, int]  # row starts, columns, values, number of columns


def product(a: Csr, b: Csr) -> Csr:
    """Gustavson's product: row i is the sum of the rows of ``b`` that row i of ``a`` names."""
    start, column, value, _ = a
    row = np.repeat(np.arange(len(start) - 1), np.diff(start))
    n = np.diff(b[0])[column]
    term = np.repeat(np.arange(len(column)), n)
    at = np.repeat(b[0][column] - (np.cumsum(n) - n), n) + np.arange(len(term))
    row, column, value = row[term], b[1][at], value[term] * b[2][at]
    key = row * b[3] + column
    if len(key) and (np.diff(key) < 0).any():
        order = np.argsort(key, kind="stable")
        key, row, column, value = key[order], row[order], column[order], value[order]
    new = np.flatnonzero(np.diff(key, prepend=-1))
    value = np.add.reduceat(value, new) if len(new) else value
    starts = np.searchsorted(row[new], np.arange(len(start)))
    return starts, column[new], value, b[3]


def times(a: Csr, x: np.ndarray) -> np.ndarray:
    """The product of a matrix and a vector."""
    seen = np.concatenate([[0], np.cumsum(a[2] * x[a[1]])])
    return seen[a[0][1:]] - seen[a[0][:-1]]


def incidence(ends: np.ndarray) -> Csr:
    """Tokens x bytes, of tokens that lie side by side and end there."""
    n = int(ends[-1]) if len(ends) else 0
    return np.concatenate([[0], ends]), np.arange(n), np.ones(n, np.int64), n


def transposed(ends: np.ndarray) -> Csr:
    """Bytes x tokens: of every byte, the token that has it."""
    n = int(ends[-1]) if len(ends) else 0
    return np.arange(n + 1), np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0)), np.ones(n, np.int64), len(ends)


def membership(of: np.ndarray, n: int) -> Csr:
    """Tokens x groups."""
    return np.arange(len(of) + 1), of, np.ones(len(of), np.int64), n


class Pair:
    """The two tokenizers, and the bytes of each of their ids."""

    def __init__(self, path_a: str, path_b: str):
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        back = {c: b for b, c in enumerate(byte_alphabet())}
        added = {t["content"] for t in spec.get("added_tokens", [])}
        ids = {t: i for t, i in spec["model"]["vocab"].items() if t not in added}
        pieces = {i: bytes(back[c] for c in t) for t, i in ids.items()}
        self.a = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
        # Ids grow in the order of the merges, so that they serve as merge ranks; the ids are
        # those of the file's own library (compared over all code points), in a fifth of the time.
        self.a_model = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks={b: i for i, b in pieces.items()}, special_tokens={})
        self.b_model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.b = [bytes([int(p[3:5], 16)]) if self.b_model.is_byte(i) else p.replace("▁", " ").encode()
                  for i, p in enumerate(map(self.b_model.id_to_piece, range(self.b_model.get_piece_size())))]
        self.size_a, self.size_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a, self.b))
        # an id as it is written inside a group, and at its end
        self.names = [f"{i}{end}" for x, last in ((self.a, "|"), (self.b, ";")) for end in (",", last) for i in range(len(x))]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both for each text; none where the bytes of either are not space and text."""
        a = [self.a_model.encode_ordinary(" " + t) for t in texts]
        b = self.b_model.encode(texts, num_threads=1)
        for k, t in enumerate(texts):
            whole = b" " + t.encode()
            if not t or b"".join(map(self.a.__getitem__, a[k])) != whole or b"".join(map(self.b.__getitem__, b[k])) != whole:
                a[k], b[k] = [], []
        return a, b


_LOADED: dict[tuple[str, str], Pair] = {}


def loaded(path_a: str, path_b: str) -> Pair:
    """The tokenizers of two files, built once in each worker process."""
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Pair(path_a, path_b)
    return _LOADED[path_a, path_b]


class Aligned:
    """The alignment of some texts: their tokens lie side by side, as if they were one text."""

    def __init__(self, pair: Pair, texts: list[str]):
        a, b = pair.encode(texts)
        self.a, self.b = (np.fromiter((i for ids in x for i in ids), np.int64) for x in (a, b))
        self.n_a, self.n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        ends_a, ends_b = np.cumsum(pair.size_a[self.a]), np.cumsum(pair.size_b[self.b])
        self.links = product(incidence(ends_a), transposed(ends_b))
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        self.of_a, self.of_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        n = len(cuts)
        in_b = np.bincount(self.of_b, minlength=n)
        #: Of every A token, the pairs with B tokens of its group.
        self.shared = times(membership(self.of_a, n), in_b)
        self.begin_a, self.begin_b = (np.concatenate([[0], np.cumsum(x)]) for x in (self.n_a, self.n_b))
        self.doc_a = np.repeat(np.arange(len(texts)), self.n_a)
        first = np.diff(self.of_a, prepend=-1) > 0
        self.n_groups = np.bincount(self.doc_a[first], minlength=len(texts))

    def written(self, pair: Pair) -> Iterator[str]:
        """The groups of each text, as `a1,a2|b1;a3|b2,b3`."""
        size = len(pair.a)
        last_a = np.append(np.diff(self.of_a) > 0, True)[:len(self.a)]
        last_b = np.append(np.diff(self.of_b) > 0, True)[:len(self.b)]
        name = np.concatenate([self.a + size * last_a, 2 * size + self.b + len(pair.b) * last_b])
        order = np.argsort(np.concatenate([2 * self.of_a, 2 * self.of_b + 1]), kind="stable")
        names = name[order].tolist()
        begin = (self.begin_a + self.begin_b).tolist()
        for i, j in zip(begin[:-1], begin[1:], strict=True):
            yield "".join(map(pair.names.__getitem__, names[i:j]))[:-1]

    def linked_ids(self, ids_b: int) -> tuple[np.ndarray, np.ndarray]:
        """Of every link: the text, and the pair of ids as one number."""
        token = np.repeat(np.arange(len(self.a)), np.diff(self.links[0]))
        return self.doc_a[token], self.a[token] * ids_b + self.b[self.links[1]]


PACK = ("pack long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
        "n_shared array<long>, digests binary, starts binary, columns binary, links binary, pairs binary")
GROUPED = "doc_id long, n_a long, n_b long, groups string"


def _texts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list, list]]:
    for b in batches:
        for s in slices(iter([b]), most=most):
            yield s.column("doc_id").to_pylist(), s.column("text").to_pylist()


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))


def grouped(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, groups) of every row: ``groups`` has the ids of both tokenizers
    between common ends, as in `a1,a2|b1;a3|b2,b3` (edge rows as in :func:`align`)."""
    def run(batches):
        pair = loaded(path_a, path_b)
        for ids, texts in _texts(batches, BATCH_BYTES):
            x = Aligned(pair, texts)
            yield batch(GROUPED, [ids, x.n_a, x.n_b, list(x.written(pair))])

    return _rows(docs, id_col, text_col).mapInArrow(run, GROUPED)


def _packs(rows: DataFrame, path_a: str, path_b: str) -> DataFrame:
    def run(batches):
        pair, numbers = loaded(path_a, path_b), numbered()
        held: list = []

        def out():
            fields = list(zip(*[h[0] for h in held], strict=True))
            starts = np.concatenate([[0], *[h[1] for h in held]])
            pairs, column = np.unique(np.concatenate([h[2] for h in held]), return_inverse=True)
            starts = np.cumsum(starts)
            # columns ascend in a row: their steps are small numbers
            step = np.diff(column, prepend=0)
            at = starts[:-1][np.diff(starts) > 0]
            step[at] = column[at]
            ids, *counts, digests = fields
            return batch(PACK, [[next(numbers)], [sum(ids, [])], *[[np.concatenate(c)] for c in counts], [shut(b"".join(sum(digests, [])))],
                                [shut(starts, 3)], [shut(step.astype(np.int32), 3)],
                                [shut(np.concatenate([h[3] for h in held]).astype(np.int32), 3)], [shut(pairs, 3)]])

        size = 0
        for ids, texts in _texts(batches, BATCH_BYTES):
            x = Aligned(pair, texts)
            doc, code = x.linked_ids(len(pair.b))
            order = np.lexsort((code, doc))
            doc, code = doc[order], code[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])
            at = np.flatnonzero(new)
            shared = np.bincount(x.doc_a, x.shared, len(ids)).astype(np.int64)
            digests = [sha256(g.encode()).digest() if g else bytes(32) for g in x.written(pair)]
            held.append(((ids, x.n_a, x.n_b, x.n_groups, np.bincount(doc, minlength=len(ids)), shared, digests),
                         np.bincount(doc[at], minlength=len(ids)), code[at], np.diff(at, append=len(doc))))
            size += sum(map(len, texts))
            if size > PACK_BYTES:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    return stored(rows.mapInArrow(run, PACK), "alignment")


def _matrix(row: dict) -> tuple[Csr, np.ndarray]:
    starts, column = opened(row["starts"], np.int64), opened(row["columns"], np.int32).astype(np.int64)
    pairs = opened(row["pairs"], np.int64)
    at = starts[:-1][np.diff(starts) > 0]
    if len(at):
        seen = np.cumsum(column)
        column = seen - np.repeat(seen[at] - column[at], np.diff(np.append(at, len(column))))
    return (starts, column, opened(row["links"], np.int32).astype(np.int64), len(pairs)), pairs


COUNTED = "pack long, pair long, n long"
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_shared long, n_best long, count_sum long, groups_sha256 string"


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: tokens of both tokenizers, groups, links, pairs that share a
    group (``n_shared``), links whose id pair is in as many documents as any of its A id
    (``n_best``), the documents of each link's id pair summed (``count_sum``), and the
    SHA-256 of the groups as text (of no tokens: '').

    ``path_a``: a byte-level BPE file of the tokenizers library, ``path_b``: a sentencepiece
    model, both at the same path on every machine.  Strings of special tokens are plain text.

    Null and empty texts, and those whose tokens of either kind do not spell space and
    text, have no tokens and only zeros.  Rows with equal or null ids are documents of
    their own.  An empty table gives an empty table.  Other columns are ignored.  Long
    texts are aligned whole.
    """
    packs = _packs(_rows(docs, id_col, text_col), path_a, path_b)

    def count(batches):
        for (row,) in groups(batches, "pack"):
            (_, column, _, n), pairs = _matrix(row)
            yield batch(COUNTED, [np.full(n, row["pack"]), pairs, np.bincount(column, minlength=n)])

    ids_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    has = packs.select("pack", "starts", "columns", "links", "pairs").mapInArrow(count, COUNTED)
    total = stored(has.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    id_a = F.expr(f"pair div {ids_b}")
    most = total.groupBy(id_a.alias("a")).agg(F.max("n").alias("most"))
    best = total.join(most, id_a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    # Back to the packs: the pairs of a pack in the order of its matrix, some to a row.
    told = (has.select("pack", "pair").join(best, "pair")
            .select("pack", "pair", F.when(F.col("best"), F.col("n")).otherwise(-F.col("n")).alias("n")))
    names = [f.split()[0] for f in PACK.split(", ")]
    kinds = dict(f.split() for f in PACK.split(", "))
    rows = (packs.select(F.lit(1).alias("kind"), none("long").alias("pair"), none("long").alias("n"), *names)
            .unionByName(told.select(F.lit(0).alias("kind"), "pair", "n", "pack", *[
                none(kinds[c]).alias(c) for c in names if c != "pack"])))

    def finish(batches):
        values: list[np.ndarray] = []
        for b in batches:
            kind = b.column("kind").to_numpy()
            n = b.column("n").fill_null(0).to_numpy()
            last = 0
            for k in np.flatnonzero(kind == 1).tolist():
                values.append(n[last:k])
                (row,) = b.slice(k, 1).to_pylist()
                matrix, _ = _matrix(row)
                count = np.concatenate(values)
                digests = opened(row["digests"], np.uint8).tobytes()
                yield batch(ALIGNED, [
                    row["doc_ids"], row["n_a"], row["n_b"], row["n_groups"], row["n_links"], row["n_shared"],
                    times(matrix, (count > 0).astype(np.int64)), times(matrix, np.abs(count)),
                    [digests[i:i + 32].hex() if m else "" for i, m in zip(range(0, len(digests), 32), row["n_a"], strict=True)]])
                values, last = [], k + 1
            values.append(n[last:])

    return by_key(rows, "pack", "kind", "pair").mapInArrow(finish, ALIGNED)
