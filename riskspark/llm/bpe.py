"""Byte-level BPE encoding and decoding by per-prefix dynamic programming.

Let ``last[e]`` be the last token of the encoding of the first ``e`` bytes of
a word.  It is unique: of all vocabulary tokens that end at ``e`` (an
automaton with suffix links lists them), it is the one that is *compatible*
with the last token of the prefix before it.  Two tokens are compatible if
undoing their merges, newest first, never uncovers a pair over the seam that
would have merged earlier.  Following the back-pointers from the end gives
the ids that the merge loop gives, in time linear in the word.

Words are cut by the vocabulary's own pattern.  Each worker keeps the ids of
words it has met, in a cache of fixed size; that changes the time only.
"""
from __future__ import annotations

import itertools
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, ident, slices

#: The word pattern and white-space class of byte-level vocabularies (fixed values).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

#: Pieces of text (words with the white space before them) a worker remembers.
CACHE_PIECES = 800_000
PAIR_BITS = 20  # log2 of the slots for pair tests
#: Longer words (in characters) are encoded one by one and not remembered.
LONG_WORD = 48

OUT = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        if b in shown:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class ByteBpe:
    """Encoder and decoder of one vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*self.ids.values(), *self.added.values()])
        self.size = size
        self.left, self.right, self.rank = [-1] * size, [-1] * size, [-1] * size
        self.pair_rank: dict[int, int] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            i, j, k = self.ids[a], self.ids[b], self.ids[a + b]
            self.pair_rank[i * size + j] = r
            if self.rank[k] < 0:
                self.left[k], self.right[k], self.rank[k] = i, j, r
        alphabet = byte_alphabet()
        self.to_char = dict(enumerate(alphabet))
        back = {c: b for b, c in enumerate(alphabet)}
        self.pieces = [b""] * size
        for t, i in self.ids.items():
            self.pieces[i] = bytes(back[c] for c in t)
        for t, i in self.added.items():
            self.pieces[i] = t.encode()
        self.pair_keys = np.full(1 << PAIR_BITS, -1, np.int64)
        self.pair_known = np.zeros(1 << PAIR_BITS, bool)
        self.whole: dict[int, bool] = {}
        self.cache: dict[str, bytes] = {}
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for t, i in self.ids.items():
            if t not in self.added:
                self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        self.lengths = np.zeros(size, np.int64)
        for t, i in self.ids.items():
            self.lengths[i] = len(t)
        self.length_list = self.lengths.tolist()
        self.alone = np.array([self.stands_alone(i) for i in range(size)])
        self.byte_sizes = np.fromiter(map(len, self.pieces), np.int64, size)
        self.byte_starts = np.cumsum(self.byte_sizes) - self.byte_sizes
        self.bytes = np.frombuffer(b"".join(self.pieces), dtype=np.uint8)
        self.words = regex.compile(WORD_PATTERN)
        self.cut = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
        self.special = re.compile("(" + "|".join(
            re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None

    # -- pair compatibility -------------------------------------------------
    def compatible(self, a: int, b: int) -> bool:
        """Do ``a`` and ``b`` stay two tokens when their texts stand side by side?"""
        rank, size = self.rank, self.size
        limit = len(self.pair_rank)
        while True:
            if self.pair_rank.get(a * size + b, limit) < limit:
                return False
            ra, rb = rank[a], rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, self.right[a]
            else:  # of equal merges the left one comes first, so the right one is undone first
                limit, b = rb + 1, self.left[b]

    def stands_alone(self, t: int) -> bool:
        """Is the text of ``t`` encoded as ``t`` itself?  (Its two halves stand alone
        and nothing merges over their seam before they do.)"""
        known = self.whole.get(t)
        if known is None:
            known = self.rank[t] < 0 or (
                self.stands_alone(self.left[t]) and self.stands_alone(self.right[t])
                and self._seam_holds(t))
            self.whole[t] = known
        return known

    def _seam_holds(self, t: int) -> bool:
        a, b, size = self.left[t], self.right[t], self.size
        limit = self.rank[t]
        while True:
            ra, rb = self.rank[a], self.rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = min(limit, ra), self.right[a]
            else:
                limit, b = min(limit, rb + 1), self.left[b]
            if self.pair_rank.get(a * size + b, limit) < limit:
                return False

    # -- encoding -----------------------------------------------------------
    def encode_word(self, word: str) -> list[int]:
        """Ids of one word: forward over prefixes, then back from the end."""
        s = "".join(map(self.to_char.__getitem__, word.encode("utf-8", "replace")))
        n = len(s)
        last, lengths = [-1] * (n + 1), self.length_list
        for end, t in self.automaton.iter(s):
            if last[end + 1] < 0:
                start = end + 1 - lengths[t]
                if self.compatible(last[start], t) if start and last[start] >= 0 else not start and self.alone[t]:
                    last[end + 1] = t
        out, e = [], n
        while e > 0:
            if last[e] < 0:
                raise ValueError("a byte is not in the vocabulary")
            out.append(last[e])
            e -= lengths[last[e]]
        out.reverse()
        return out

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of many short words: the same recurrence, one prefix length at a time
        for all words together, as arrays."""
        texts = ["".join(map(self.to_char.__getitem__, w.encode("utf-8", "replace"))) for w in words]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(sizes + 1, out=begin[1:])  # a line feed, which no token has, between words
        found = np.fromiter(itertools.chain.from_iterable(self.automaton.iter("\n".join(texts))),
                            np.int64).reshape(-1, 2)
        end, token = found[:, 0] + 1, found[:, 1]
        word = np.searchsorted(begin, end - 1, side="right") - 1
        at = end - begin[word]
        order = np.argsort(at, kind="stable")
        end, token, at = end[order], token[order], at[order]
        start = end - self.lengths[token]
        first = start == begin[word[order]]
        last = np.full(begin[-1] + 1, -1, np.int64)  # by the end of the prefix
        bounds = np.searchsorted(at, np.arange(1, (at[-1] if len(at) else 0) + 2))
        for i, j in itertools.pairwise(bounds.tolist()):
            t, before = token[i:j], last[start[i:j]]
            ok = np.where(first[i:j], self.alone[t], False)
            inner = np.flatnonzero(~first[i:j] & (before >= 0))
            ok[inner] = self._compatible_many(before[inner] * self.size + t[inner])
            last[end[i:j][ok]] = t[ok]
        out, last = [], last.tolist()
        lengths = self.length_list
        for b, n in zip(begin.tolist(), sizes.tolist(), strict=False):
            e, ids = b + n, []
            while e > b:
                t = last[e]
                if t < 0:
                    raise ValueError("a byte is not in the vocabulary")
                ids.append(t)
                e -= lengths[t]
            ids.reverse()
            out.append(ids)
        return out

    def _compatible_many(self, keys: np.ndarray) -> np.ndarray:
        """Pair tests ``a * size + b``; a direct-mapped table remembers results."""
        slot = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - PAIR_BITS)
                ).astype(np.int64)
        out, missed = self.pair_known[slot], np.flatnonzero(self.pair_keys[slot] != keys)
        if len(missed):
            new, back = np.unique(keys[missed], return_inverse=True)
            size = self.size
            ok = np.array([self.compatible(k // size, k % size) for k in new.tolist()], dtype=bool)
            out[missed] = ok[back]
            self.pair_keys[slot[missed]] = keys[missed]
            self.pair_known[slot[missed]] = out[missed]
            # two keys may share a slot: the one written last stays, with its own result
            wrong = self.pair_keys[slot[missed]] != keys[missed]
            if wrong.any():
                kept = self.pair_keys[slot[missed[wrong]]]
                self.pair_known[slot[missed[wrong]]] = ok[np.searchsorted(new, kept)]
        return out

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of pieces that are not in the cache."""
        cut = {p: self.words.findall(p) for p in pieces}
        words = list({w for ws in cut.values() for w in ws})
        short = [w for w in words if len(w) <= LONG_WORD]
        ids = dict(zip(short, self._encode_words(short), strict=True)) if short else {}
        ids.update((w, self.encode_word(w)) for w in words if len(w) > LONG_WORD)
        new = {p: array("i", itertools.chain.from_iterable(map(ids.__getitem__, ws))).tobytes()
               for p, ws in cut.items()}
        if len(self.cache) + len(new) > CACHE_PIECES:
            self.cache.clear()
        self.cache.update((p, v) for p, v in new.items() if len(p) <= LONG_WORD)
        return new

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts; strings of added tokens in them are those tokens."""
        parts: list[list[str | tuple[str]]] = []  # of each text
        for t in texts:
            if self.special is None or not self.special.search(t):
                parts.append(self.cut.findall(t))
            else:
                own = []
                for k, x in enumerate(self.special.split(t)):
                    own.extend([(x,)] if k % 2 else self.cut.findall(x))  # an added token is no text
                parts.append(own)
        cache = self.cache
        got = [list(map(cache.get, own)) for own in parts]
        missed = {p for own, g in zip(parts, got, strict=True) if None in g
                  for p, v in zip(own, g, strict=True) if v is None}
        new = {p: array("i", [self.added[p[0]]]).tobytes() for p in missed if isinstance(p, tuple)}
        if missed:
            new.update(self._learn(missed - new.keys()))
            for own, g in zip(parts, got, strict=True):
                if None in g:
                    g[:] = [new[p] if v is None else v for p, v in zip(own, g, strict=True)]
        return [np.frombuffer(b"".join(g), dtype=np.int32) for g in got]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text])[0]

    # -- decoding -----------------------------------------------------------
    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: their bytes side by side (bytes that are not UTF-8 become U+FFFD)."""
        n = self.byte_sizes[ids]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.byte_starts[ids] - (ends - n), n) + np.arange(total)
        return self.bytes[at].tobytes().decode("utf-8", "replace")


_LOADED: dict[str, ByteBpe] = {}


def loaded(path: str) -> ByteBpe:
    """The vocabulary at ``path``, built once in each worker process."""
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


def _convert(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    bpe = loaded(path)
    for b in slices(batches):
        ids = bpe.encode_many(b.column("text").to_pylist())
        ends = np.zeros(len(ids) + 1, dtype=np.int32)
        np.cumsum([len(x) for x in ids], out=ends[1:])
        values = np.concatenate(ids) if ids else np.zeros(0, "<i4")
        yield pa.RecordBatch.from_arrays([
            b.column("doc_id").cast(pa.int64()),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32())),
            pa.array([bpe.decode(x) for x in ids], pa.string()), *b.columns[2:]],
            schema=pa.schema([*OUT, *list(b.schema)[2:]]))


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id",
                  text_col: str = "text", ship: bool = False, keep: str | None = None) -> DataFrame:
    """One row per input row: ``doc_id``, ``ids`` (array<int>) and ``decoded``,
    and the column ``keep`` as it is.

    ``vocabulary``: a vocabulary file of the tokenizers library (byte-level BPE),
    at the same path on every machine; with ``ship`` the session sends the
    driver's copy to the executors.

    Null and empty texts give no ids and an empty decoded text.  Rows with
    equal or null ids are kept as they are; an empty table gives an empty
    table.  Other columns are ignored.  Long texts are encoded whole, in linear
    time.  There is no shuffle: every row is converted where it is read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(ident(id_col).cast("long").alias("doc_id"), F.coalesce(ident(text_col), F.lit("")).alias("text"),
                       *([ident(keep)] if keep else []))
    kept = f", `{keep}` {rows.schema[keep].dataType.simpleString()}" if keep else ""
    if ship:
        spark.sparkContext.addFile(vocabulary)
        name = vocabulary.rsplit("/", 1)[-1]

        def run(batches):
            return _convert(batches, SparkFiles.get(name))
    else:
        def run(batches):
            return _convert(batches, vocabulary)
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>, decoded string" + kept)
