"""Passages that repeat over documents, by merging Burrows-Wheeler transforms of shards.

A *shard* is a pack of documents, of a size that does not grow with the data.  Every window of ``LEAST`` bytes has an anchor,
the least hash of the ``GRAM``-byte strings in it; windows side by side with one
anchor are a *string* of at most 2 * LEAST bytes.  Equal windows have equal
anchors, so strings are dealt by anchor to *lots*, some of which are a bucket, and:

1. per anchor and shard, digests of its strings go to the anchor's bucket, which
   says what at least two documents have and which shard sends each different string;
2. each shard sorts the suffixes of the strings it sends and sends their
   Burrows-Wheeler transform;
   A string that is the only one with its anchor, in however many documents, has
   nothing to be merged with and is not sent;
3. each bucket merges the transforms of all shards.  A round of the interleave
   refinement deals the rows, in the order that holds for h bytes, by the byte
   before them, which gives the order for h + 1 bytes; no suffix is sorted again.
   A row that parts from all others has its longest common prefix and goes.  After
   LEAST rounds, rows that have not parted are a repeated interval; the least id
   in it is where that window is found first;
4. each shard removes what is found in a document with a smaller id.

An anchor with more than ``CROWDED`` different strings (a line or passage in a
large share of all documents, with another text around it each time) sends
single windows, dealt by their own hash: equal ones are one row per shard, the
others are spread.  Strings are told apart by 64-bit digests.

A shard and a bucket tell each other all they have to in one row, lot by lot, so
that rows are few; a bucket works on some lots at a time, so that its arrays are small.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, stored
from .packs import batch, buckets, by_bucket, by_key, cut, groups, none, opened, packed, runs, shut

LEAST = 50
GRAM = 20
CROWDED = 4096
#: Positions hashed, and rows sorted, in one go.
CHUNK = 1 << 15
#: Byte for the end of a string in a transform: UTF-8 has no such byte.
END = 255
#: Lots of a bucket.  Strings that a bucket compares, and rows that it merges, in one go (one lot at least).
LOTS = 16
TOGETHER = 1 << 20
MERGED = 1 << 19
#: What a bucket says of a shard's string: of one document only, send it, crowded, another
#: shard sends it, no other string has its anchor.
ALONE, SEND, SPLIT, KNOWN, EQUAL = range(5)
BASE = 0x9E3779B97F4A7C15
#: Mark of a string that is sent, beside its number of windows (LEAST + 1 at most).
SENDS = 128
LARGEST = np.iinfo(np.int64).max


def _powers(base: int, n: int) -> np.ndarray:
    x = np.full(n, base, np.uint64)
    x[:1] = 1
    return np.cumprod(x)


POWERS, INVERSE = _powers(BASE, CHUNK + LEAST), _powers(pow(BASE, -1, 1 << 64), CHUNK + LEAST)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _sums(buf: np.ndarray) -> np.ndarray:
    """Sums of the first bytes, each over its power: two of them give a polynomial hash (:func:`_between`)."""
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf + np.uint64(1)) * INVERSE[:len(buf)], out=out[1:])
    return out


def _between(sums: np.ndarray, at: np.ndarray | slice, to: np.ndarray | slice) -> np.ndarray:
    """Hashes of the bytes from ``at`` to ``to``; they depend on these bytes alone."""
    return (sums[to] - sums[at]) * POWERS[:len(sums)][to]


def window_hashes(buf: np.ndarray, *starts: np.ndarray) -> list[np.ndarray]:
    """Hashes of the windows that start at these places; in each array they ascend."""
    out, chunks = [np.empty(len(at), np.uint64) for at in starts], np.arange(0, len(buf) + CHUNK, CHUNK)
    places = [np.searchsorted(at, chunks) for at in starts]
    for c in range(len(chunks) - 1):
        i, own = c * CHUNK, [slice(p[c], p[c + 1]) for p in places]
        if any(o.start < o.stop for o in own):
            sums = _sums(buf[i:i + CHUNK + LEAST - 1])
            for found, at, o in zip(out, starts, own, strict=True):
                k = at[o] - i
                found[o] = _between(sums, k, k + LEAST)
    return out


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


class Strings:
    """The strings of a shard: windows side by side in one document that have one anchor."""

    def __init__(self, buf: np.ndarray, ends: np.ndarray, lots: int):
        begin = np.concatenate([[0], ends])
        cuts = [self._cut(buf[begin[i]:begin[j]], ends[i:j] - begin[i]) for i, j in runs(ends)]
        moved = [(start + begin[i], size, doc + i, anchor) for (i, _), (start, size, doc, anchor) in zip(runs(ends), cuts, strict=True)]
        no = np.zeros(0, np.int64)
        #: Where a string starts, its windows, its document.
        self.start, self.size, self.doc, anchor = map(
            np.concatenate, zip((no, no, no, no.astype(np.uint64)), *moved, strict=True))
        key = _mixed(anchor + np.uint64(BASE))
        self.lot = (key % np.uint64(lots)).astype(np.int64)
        self.bits = 63 - lots.bit_length()
        self.anchor = (key >> np.uint64(40)).astype(np.uint32) & np.uint32(0xFFFFFE)
        one, last = window_hashes(buf, self.start, self.start + self.size - 1)
        self.digest = _mixed(one * np.uint64(0xD6E8FEB86659FD93) + last * np.uint64(0xA0761D6478BD642F) + self.size.astype(np.uint64))

    @staticmethod
    def _cut(buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start, windows, document and anchor of the strings of some documents."""
        count = max(len(buf) - LEAST + 1, 0)
        anchor = np.empty(count, np.uint64)
        for i in range(0, count, CHUNK):  # a cache's worth at a time
            j = min(i + CHUNK, count)
            sums = _sums(buf[i:j + LEAST - 1])
            grams = _between(sums, slice(None, -GRAM), slice(GRAM, None))
            anchor[i:j] = _least(_mixed(grams), LEAST - GRAM + 1)
        inside, first = np.ones(count, bool), np.ones(count, bool)
        np.not_equal(anchor[1:], anchor[:-1], out=first[1:])
        for k in range(LEAST):  # a window that begins in the last LEAST - 1 bytes of a document goes on in another one
            at = ends - k
            at = at[(at >= 0) & (at < count)]
            first[at] = True
            if k:
                inside[at] = False
        at = np.flatnonzero(first)
        own = inside[at]
        start, size = at[own], np.diff(at, append=count)[own]
        parts = -(-size // (LEAST + 1))  # a string has LEAST + 1 windows at most: two of them cover it
        again = np.repeat(np.arange(len(start)), parts)
        k = np.arange(len(again)) - np.repeat(np.cumsum(parts) - parts, parts)
        at = start[again] + k * (LEAST + 1)
        doc = np.repeat(np.arange(len(ends)), np.diff(np.searchsorted(at, ends), prepend=0))
        return at, np.minimum(size[again] - k * (LEAST + 1), LEAST + 1), doc, anchor[at]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """One string of each digest, in the order of the lots: its index; the index into
        these of every string; whether its anchor is in several documents of this shard; lot."""
        n = len(self.start)
        key = self.lot << 24 | self.anchor
        order = np.argsort(key)
        at = np.flatnonzero(np.diff(key[order], prepend=-1))
        several = np.empty(n, bool)
        if n:
            doc = self.doc[order]
            several[order] = np.repeat(np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at), np.diff(at, append=n))
        order, new = _by_lot(self.lot, self.digest, self.bits)
        of = np.empty(n, np.int64)
        of[order] = np.cumsum(new) - 1
        one = order[new]
        return one, of, several[one], self.lot[one]


def _by_lot(lot: np.ndarray, digest: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order by lot and digest, and where in it another string comes than before.
    (Digests that agree in the bits that fit may alternate: then a string is told of twice.)"""
    order = np.argsort(lot << bits | (digest >> np.uint64(64 - bits)).astype(np.int64))
    d, t = digest[order], lot[order]
    new = np.ones(len(order), bool)
    new[1:] = (d[1:] != d[:-1]) | (t[1:] != t[:-1])
    return order, new


def _stable(x: np.ndarray) -> np.ndarray:
    """Stable order; small numbers take a radix sort."""
    return np.argsort(x.astype(np.uint16) if x.size and x.max() < 1 << 16 else x, kind="stable")


def transform(buf: np.ndarray, start: np.ndarray, length: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Burrows-Wheeler transforms of strings, one per bucket, side by side in the order
    of the buckets (``bucket`` ascends), and the bucket of each row.  A string's end is
    below all bytes; of equal suffixes that of the earlier string comes first."""
    sizes = length + 1
    base = np.cumsum(sizes) - sizes
    n = int(sizes.sum())
    if not n:
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    which = np.repeat(np.arange(len(start)), sizes)
    offset = np.arange(n) - base[which]
    left = length[which] - offset
    at = start[which] + offset
    symbol = np.where(left > 0, buf[np.minimum(at, len(buf) - 1)].astype(np.int64) + 1, 0)
    key, far = symbol.copy(), 7
    for k in range(1, far):  # seven symbols of nine bits
        key <<= 9
        key[:n - k] |= np.where(left[:n - k] >= k, symbol[k:], 0)
    order = np.argsort(key)
    new = np.ones(n, bool)
    new[1:] = np.diff(key[order]) != 0
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    while True:  # rows that are equal so far: by what follows
        slot = np.flatnonzero(~(new & np.append(new[1:], True)))
        slot = slot[left[order[slot]] >= far]
        if not len(slot):
            break
        row = order[slot]
        key = rank[row] * (n + 1) + rank[row + far]
        by = np.argsort(key)
        row, key = row[by], key[by]
        order[slot] = row
        new[slot[1:]] |= np.diff(key) != 0
        rank[row] = slot[np.maximum.accumulate(np.where(new[slot], np.arange(len(slot)), 0))]
        far *= 2
    slot = np.flatnonzero(~(new & np.append(new[1:], True)))
    row = order[slot]
    order[slot] = row[np.argsort(rank[row] * n + row)]
    number = np.cumsum(np.diff(bucket, prepend=bucket[0]) != 0)
    order = order[_stable(number[which[order]])]
    before = np.where(offset > 0, buf[np.maximum(at - 1, 0)], END).astype(np.uint8)
    return before[order], bucket[which[order]]


def transforms(buf: np.ndarray, start: np.ndarray, length: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`transform` of some buckets at a time."""
    at = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
    rows = np.concatenate([[0], np.cumsum(length + 1)])
    out, i = [(np.zeros(0, np.uint8), np.zeros(0, np.int64))], 0
    while i < len(at) - 1:
        j = max(i + 1, int(np.searchsorted(rows[at], rows[at[i]] + CHUNK, side="right")) - 1)
        own = slice(at[i], at[j])
        out.append(transform(buf, start[own], length[own], bucket[own]))
        i = j
    return tuple(map(np.concatenate, zip(*out, strict=True)))


class Merged:
    """The merge of the transforms of shards, refined for ``depth`` bytes.

    ``reach``: how many bytes, ``depth`` at most, a row (they are numbered shard by
    shard) has in common with some other row.  ``rows``: those that reach ``depth``,
    in the merged order; ``blocks``: where the intervals of equal prefixes begin in it.
    ``sizes``: the rows of each transform, where ``transforms`` holds several side by
    side.  ``deep``: a row that ends before its string has ``depth`` bytes more cannot
    lead to one that reaches ``depth``, and is left out (of ``reach`` too).
    """

    def __init__(self, transforms: list[np.ndarray], depth: int = LEAST, sizes: np.ndarray | None = None, deep: bool = False):
        text = np.concatenate(transforms)
        sizes = np.array([len(t) for t in transforms], np.int64) if sizes is None else sizes
        shard = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        base = np.cumsum(sizes) - sizes
        n = len(text)
        ended = text == END
        strings = np.bincount(shard[ended], minlength=len(sizes))
        #: The row of a string's end; strings are numbered shard by shard.
        self.ends = np.repeat(base - (np.cumsum(strings) - strings), strings) + np.arange(strings.sum())
        order = np.flatnonzero(~ended)
        order = order[np.argsort(text[order], kind="stable")]
        order = order[_stable(shard[order])]
        own = shard[order]
        per = np.bincount(own, minlength=len(sizes))
        back = np.zeros(n, np.int32)  # the row of the suffix that is longer by the byte before
        back[order] = (base + strings - (np.cumsum(per) - per))[own] + np.arange(len(order))
        self.text, self.back = text, back
        rows = np.arange(n, dtype=np.int32)
        if deep:
            self.string, self.length = self.places()
            whole = np.empty(len(self.ends), np.int32)
            whole[self.string[ended]] = self.length[ended]
            rows = rows[self.length <= whole[self.string] - depth]
        block = np.zeros(len(rows), np.int32)
        self.reach = np.zeros(n, np.uint8)
        for h in range(depth):
            c = text[rows]
            by = np.argsort(c, kind="stable")[:len(c) - np.count_nonzero(c == END)]
            c, rows, block = c[by], back[rows[by]], block[by]
            new = np.ones(len(rows) + 1, bool)
            np.not_equal(block[1:], block[:-1], out=new[1:-1])
            new[1:-1] |= c[1:] != c[:-1]
            several = np.flatnonzero(~(new[:-1] & new[1:]))
            rows, block = rows[several], np.cumsum(new[several], dtype=np.int32)
            self.reach[rows] = h + 1
        self.rows = rows
        self.blocks = np.flatnonzero(np.diff(block, prepend=-1))

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """The string and the length of every row's suffix: all strings are walked back from their ends."""
        string, length = np.empty(len(self.text), np.int32), np.empty(len(self.text), np.int32)
        which, row, k = np.arange(len(self.ends), dtype=np.int32), self.ends, 0
        while len(row):
            string[row], length[row] = which, k
            go = self.text[row] != END
            which, row, k = which[go], self.back[row[go]], k + 1
        return string, length


def _spans(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Lots side by side that come to ``most`` together (one at least): from and to."""
    total, i, out = np.cumsum(sizes), 0, []
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + most, side="right")))
        out.append((i, j))
        i = j
    return out


class Told:
    """What some shards have told a bucket: rows of values, lot by lot."""

    def __init__(self, rows: list[dict], counts: str):
        self.rows = rows
        #: Of a row and a lot, how many values come before its own and after them.
        self.at = np.zeros((len(rows), LOTS + 1), np.int64)
        np.cumsum([np.frombuffer(r[counts], np.uint32) for r in rows], axis=1, out=self.at[:, 1:])
        self.sizes = np.diff(self.at, axis=1)

    def of(self, values: list[np.ndarray], i: int, j: int) -> np.ndarray:
        """The values of the lots from i to j, row by row."""
        return np.concatenate([v[a:b] for v, a, b in zip(values, self.at[:, i].tolist(), self.at[:, j].tolist(), strict=True)])

    def owner(self, i: int, j: int) -> np.ndarray:
        """The row of each of them."""
        return np.repeat(np.arange(len(self.rows), dtype=np.int32), self.at[:, j] - self.at[:, i])

    def back(self, kind: str) -> list[np.ndarray]:
        """The values of a column, for :meth:`of`."""
        return [np.frombuffer(r[kind], np.uint64 if kind == "digests" else np.int64 if kind == "firsts" else np.uint8) for r in self.rows]


def _by_bucket(lot: np.ndarray, parts: int, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """How many entries the lots have, as a row of them for each bucket that has any; and these buckets."""
    counts = np.bincount(lot, weight, parts * LOTS).astype(np.uint32).reshape(parts, LOTS)
    own = np.flatnonzero(counts.any(axis=1))
    return counts[own], own


ASKED = "bucket int, pack long, counts binary, anchors binary, digests binary"


def _asked(docs: DataFrame, parts: int) -> DataFrame:
    """Digests of a shard's strings, and what anchors they have, for the bucket of these."""
    def run(batches):
        for (row,) in groups(batches, "pack"):
            strings = Strings(opened(row["bytes"], np.uint8), np.array(row["ends"], np.int64), parts * LOTS)
            one, _, several, lot = strings.entries()
            counts, own = _by_bucket(lot, parts)
            n = counts.sum(axis=1, dtype=np.int64)
            anchor = (strings.anchor[one] | several).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
            yield batch(ASKED, [own, np.full(len(own), row["pack"]), cut(counts.ravel(), np.full(len(own), LOTS)),
                                cut(anchor.ravel(), 3 * n), cut(strings.digest[one], n)])

    return docs.mapInArrow(run, ASKED)


def _answers(asked: DataFrame, parts: int, crowded: int) -> DataFrame:
    """(pack, bucket, bytes): what to do with each of the strings that a shard has told of."""
    schema = "pack long, bucket int, bytes binary"

    def run(batches):
        for rows in groups(batches, "bucket"):
            told = Told(rows, "counts")
            anchors = [x.reshape(-1, 3) for x in told.back("anchors")]
            digests = told.back("digests")
            said = [np.empty(n, np.uint8) for n in told.at[:, -1]]
            for i, j in _spans(told.sizes.sum(axis=0), TOGETHER):
                three, digest, pack = told.of(anchors, i, j), told.of(digests, i, j), told.owner(i, j)
                if not len(digest):
                    continue
                lot = np.repeat(np.tile(np.arange(j - i, dtype=np.uint64), len(rows)), told.sizes[:, i:j].ravel())
                key = lot << np.uint64(24) | three[:, 0] & np.uint64(254) | three[:, 1].astype(np.uint64) << np.uint64(8) | three[:, 2].astype(np.uint64) << np.uint64(16)
                # (digests that agree in the bits that fit may alternate: then several shards send a string)
                order = np.argsort(key << np.uint64(35) | digest >> np.uint64(29))
                a, d, p = key[order], digest[order], pack[order]
                anew = np.ones(len(a), bool)
                anew[1:] = a[1:] != a[:-1]
                new = anew.copy()
                new[1:] |= d[1:] != d[:-1]
                at, of = np.flatnonzero(anew), np.cumsum(anew) - 1
                shared = np.minimum.reduceat(p, at) != np.maximum.reduceat(p, at)
                shared |= np.maximum.reduceat(three[order, 0] & 1, at) > 0
                strings = np.add.reduceat(new.astype(np.int64), at)[of]
                own = np.where(new, SEND, KNOWN).astype(np.uint8)
                own[strings == 1] = EQUAL
                own[strings > crowded] = SPLIT
                own[~shared[of]] = ALONE
                back = np.empty(len(a), np.uint8)
                back[order] = own
                ends = np.cumsum(told.at[:, j] - told.at[:, i])
                for x, lo, hi, piece in zip(said, told.at[:, i].tolist(), told.at[:, j].tolist(), np.split(back, ends[:-1]), strict=True):
                    x[lo:hi] = piece
            answers = [(r["pack"], r["bucket"], shut(x)) for r, x in zip(rows, said, strict=True) if x.any()]
            if answers:
                yield batch(schema, [list(c) for c in zip(*answers, strict=True)])

    return by_bucket(asked, parts, "bucket", "pack").mapInArrow(run, schema)


class Chosen:
    """The strings of a shard that the buckets have asked for: whole ones, and single
    windows of crowded anchors; one of each digest, in the order (lot, digest)."""

    def __init__(self, row: dict, told: list[dict], parts: int):
        self.buf, self.ends = opened(row["bytes"], np.uint8), np.array(row["ends"], np.int64)
        self.ids = np.array([LARGEST if i is None else i for i in row["doc_ids"]], np.int64)
        strings = Strings(self.buf, self.ends, parts * LOTS)
        one, of, _, lot = strings.entries()
        said = np.zeros(len(one), np.uint8)
        own = np.array([r["bucket"] for r in told], np.int64)
        for r, lo, hi in zip(told, np.searchsorted(lot, own * LOTS), np.searchsorted(lot, (own + 1) * LOTS), strict=True):
            said[lo:hi] = opened(r["bytes"], np.uint8)
        mine = said[of]
        whole = np.flatnonzero((mine != ALONE) & (mine != SPLIT))
        crowd = np.flatnonzero(mine == SPLIT)
        n = strings.size[crowd]
        single = np.repeat(strings.start[crowd] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        digest = np.concatenate([strings.digest[whole], _mixed(*window_hashes(self.buf, single))])
        lot = np.concatenate([strings.lot[whole], (digest[len(whole):] % np.uint64(parts * LOTS)).astype(np.int64)])
        order, new = _by_lot(lot, digest, strings.bits)
        at = np.flatnonzero(new)
        #: Of every occurrence: where it starts, its document, and which string it is.
        self.start = np.concatenate([strings.start[whole], single])[order]
        self.doc = np.concatenate([strings.doc[whole], np.repeat(strings.doc[crowd], n)])[order]
        self.entry = np.cumsum(new) - 1
        #: Of every string: lot, digest, windows, whether to send it, the least id here.
        one = order[at]
        self.lot, self.digest = lot[one], digest[one]
        self.size = np.concatenate([strings.size[whole], np.ones(len(single), np.int64)])[one]
        self.sends = np.concatenate([mine[whole] == SEND, np.ones(len(single), bool)])[one]
        self.first = np.minimum.reduceat(self.ids[self.doc], at) if len(at) else at
        self.begin = self.start[at]


def _by_pack(shards: DataFrame, *told: DataFrame) -> DataFrame:
    """What was told (pack, bucket, bytes) to each pack, and after that the pack itself."""
    rows = shards.select("pack", F.lit(len(told)).alias("kind"), none("int").alias("bucket"), "doc_ids", "ends", "bytes")
    for k, t in enumerate(told):
        rows = rows.unionByName(t.select("pack", F.lit(k).alias("kind"), "bucket", none("array<long>").alias("doc_ids"),
                                         none("array<long>").alias("ends"), "bytes"))
    return by_key(rows, "pack", "kind", "bucket")


SENT = "bucket int, pack long, counts binary, digests binary, sizes binary, firsts binary, lines binary, bytes binary"


def _sent(shards: DataFrame, answers: DataFrame, parts: int) -> DataFrame:
    """A shard's strings in each bucket, with the transforms of those it sends, lot by lot."""
    def run(batches):
        for *told, row in groups(batches, "pack"):
            if not told:
                continue
            x = Chosen(row, told, parts)
            sends, length = x.sends, x.size + LEAST - 1
            text, _ = transforms(x.buf, x.begin[sends], length[sends], x.lot[sends])
            counts, own = _by_bucket(x.lot, parts)
            lines = _by_bucket(x.lot, parts, np.where(sends, length + 1, 0))
            rows = np.zeros((len(own), LOTS), np.uint32)
            rows[np.searchsorted(own, lines[1])] = lines[0]
            n, of = counts.sum(axis=1, dtype=np.int64), np.full(len(own), LOTS)
            ends = np.cumsum(rows.sum(axis=1, dtype=np.int64))
            yield batch(SENT, [own, np.full(len(own), row["pack"]), cut(counts.ravel(), of), cut(x.digest, n),
                               cut((x.size + SENDS * sends).astype(np.uint8), n), cut(x.first, n), cut(rows.ravel(), of),
                               [shut(t, 3) for t in np.split(text, ends[:-1])] if len(own) else []])

    return _by_pack(shards, answers).mapInArrow(run, SENT)


def _found_first(sent: DataFrame, parts: int) -> DataFrame:
    """(pack, bucket, bytes): the least id that has each window of a shard's strings in a bucket:
    that of each string's first window, whether its others differ, and all windows of those that do."""
    schema = "pack long, bucket int, bytes binary"

    def run(batches):
        for rows in groups(batches, "bucket"):
            told, lines = Told(rows, "counts"), Told(rows, "lines")
            digests, sizes, firsts = told.back("digests"), told.back("sizes"), told.back("firsts")
            texts = [opened(r["bytes"], np.uint8) for r in rows]
            out: list = [[] for _ in rows]
            for i, j in _spans(lines.sizes.sum(axis=0) + told.sizes.sum(axis=0), MERGED):
                digest, size = told.of(digests, i, j), told.of(sizes, i, j)
                if not len(digest):
                    continue
                # the least id of each different string, over the shards that have it
                order = np.argsort(digest)
                new = np.ones(len(digest), bool)
                new[1:] = digest[order[1:]] != digest[order[:-1]]
                at, of = np.flatnonzero(new), np.empty(len(digest), np.int64)
                of[order] = np.cumsum(new) - 1
                least = np.minimum.reduceat(told.of(firsts, i, j)[order], at)
                count = (size[order[at]] & (SENDS - 1)).astype(np.int64)
                begin = np.cumsum(count) - count
                found = np.repeat(least, count)
                sender = of[size >= SENDS]  # of the strings in the transforms, in their order
                if len(sender):
                    merged = Merged([lines.of(texts, i, j)], sizes=lines.sizes[:, i:j].ravel(), deep=True)
                    string = sender[merged.string[merged.rows]]
                    in_block = np.minimum.reduceat(least[string], merged.blocks) if len(string) else least[:0]
                    # the window's place in its string: from the end, a suffix of LEAST bytes is the last window
                    window = begin[string] + count[string] - 1 - (merged.length[merged.rows] - LEAST)
                    found[window] = np.repeat(in_block, np.diff(merged.blocks, append=len(string)))
                same = np.minimum.reduceat(found, begin) == np.maximum.reduceat(found, begin)
                ends = np.cumsum(told.at[:, j] - told.at[:, i])
                for pieces, own in zip(out, np.split(of, ends[:-1]), strict=True):
                    mixed = own[~same[own]]
                    n = count[mixed]
                    at = np.repeat(begin[mixed] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    pieces.append((found[begin[own]], ~same[own], found[at]))
            yield batch(schema, [[r["pack"] for r in rows], [r["bucket"] for r in rows], [
                shut(np.concatenate([x for kind in zip(*pieces, strict=True) for x in kind])) for pieces in out]])

    return by_bucket(sent, parts, "bucket", "pack").mapInArrow(run, schema)


RESULT = "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary"


def _cleared(shards: DataFrame, answers: DataFrame, firsts: DataFrame, parts: int) -> DataFrame:
    """The documents of every shard without what is found in a document with a smaller id."""
    def run(batches):
        for *told, row in groups(batches, "pack"):
            found = [opened(r["bytes"], np.int64) for r in told if r["kind"] == 1]
            if found:
                x = Chosen(row, [r for r in told if r["kind"] == 0], parts)
                buf, ends = x.buf, x.ends
                k = np.bincount(np.searchsorted([r["bucket"] for r in told if r["kind"] == 1], x.lot // LOTS), minlength=len(found))
                first = np.concatenate([f[:m] for f, m in zip(found, k, strict=True)])
                mixed = np.concatenate([f[m:2 * m] for f, m in zip(found, k, strict=True)]) > 0
                single = np.concatenate([f[2 * m:] for f, m in zip(found, k, strict=True)])
                count = np.where(mixed, x.size, 0)
                before = np.cumsum(count) - count
                place = np.argsort(x.start)
                starts = x.start[place]
            else:
                buf, ends = opened(row["bytes"], np.uint8), np.array(row["ends"], np.int64)
            for i, j in runs(ends):
                at, to = int(ends[i - 1]) if i else 0, int(ends[j - 1])
                gone = np.zeros(to - at, bool)
                if found:
                    own = place[slice(*np.searchsorted(starts, [at, to]))]
                    start, entry, own_id = x.start[own] - at, x.entry[own], x.ids[x.doc[own]]
                    whole = ~mixed[entry] & (first[entry] < own_id)
                    lo, hi = start[whole], start[whole] + x.size[entry[whole]] + LEAST - 1
                    some = np.flatnonzero(mixed[entry])
                    n = count[entry[some]]
                    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    window = (np.repeat(start[some], n) + k)[
                        single[np.repeat(before[entry[some]], n) + k] < np.repeat(own_id[some], n)]
                    edge = (np.bincount(np.concatenate([lo, window]), minlength=len(gone) + 1)
                            - np.bincount(np.concatenate([hi, window + LEAST]), minlength=len(gone) + 1))
                    gone = np.cumsum(edge[:-1]) > 0
                yield batch(RESULT, [row["doc_ids"][i:j], *_kept(buf[at:to], ends[i:j] - at, gone)])

    return _by_pack(shards, answers, firsts).mapInArrow(run, RESULT)


def _kept(buf: np.ndarray, ends: np.ndarray, gone: np.ndarray) -> list:
    """Of documents side by side: bytes, where runs that are gone start and end, and the other bytes."""
    n, begin = len(buf), ends - np.diff(ends, prepend=0)
    at_begin = np.zeros(n + 1, bool)
    at_begin[begin] = True
    before = np.concatenate([[False], gone[:-1]]) & ~at_begin[:n] if n else gone
    after = np.concatenate([gone[1:], [False]]) & ~at_begin[1:] if n else gone
    starts, stops = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after) + 1
    parts = np.searchsorted(starts, np.append(begin, n))
    kept, keep = buf[~gone], np.concatenate([[0], np.cumsum(~gone)])
    docs_of = list(zip(begin, ends, parts[:-1], parts[1:], strict=True))
    return [ends - begin, [starts[i:j] - b if b != e else [] for b, e, i, j in docs_of],
            [stops[i:j] - b if b != e else [] for b, e, i, j in docs_of], cut(kept, keep[ends] - keep[begin])]


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowded: int = CROWDED) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_bytes``, the removed runs of bytes
    (``starts``, ``ends``) and ``kept``, the other bytes side by side (a cut may
    part a character, so that they need not be UTF-8).

    A byte goes if a string of LEAST bytes that covers it also starts in a document
    with a smaller id.  Texts are judged as they came in.  Null and empty texts, and
    those under LEAST bytes, lose nothing.  Rows with equal ids take nothing from
    each other, but all lose what a smaller id has; a null id is above all others.
    Repeated rows stay rows.  An empty table gives an empty table.  Other columns
    are ignored.  Texts of any length are treated whole.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    shards = packed(rows)
    parts = buckets(shards)
    answers = stored(_answers(_asked(shards.select("pack", "ends", "bytes"), parts), parts, crowded), "answers")
    return _cleared(shards, answers, _found_first(_sent(shards, answers, parts), parts), parts)
