"""Near-duplicate classes by ProbMinHash signatures, banding and verification.

A text is a weighted set: its shingles of five words, one that occurs n times
with weight 1 + ln n (with weight n, a phrase repeated hundreds of times would
make copies of texts that have nothing else in common).  Two texts are near copies if their probability Jaccard
similarity

    sum over d in both of 1 / sum over d' of max(x[d'] / x[d], y[d'] / y[d])

is 0.8 or more (for equal weights this is the Jaccard similarity).

*Signature.*  Each shingle is a Poisson process whose rate is its weight.  Its
arrivals, taken from a hash of the shingle, fall on registers at random; a
register keeps the shingle that arrived at it first.  A shingle stops as soon
as its next arrival comes later than the last of all registers' first ones.
Two registers agree with the probability above.

*Banding.*  25 bands of 5 registers: a pair at 0.8 meets in a band with a
probability over 0.9999.  Texts are compared as *different texts*, equal ones
having been folded into one by a strong digest.  Within a bucket, every text
is first compared with up to three hubs (the text that meets most others, and
two chosen by hashes), which is linear in the bucket.  Classes are formed;
only buckets that still hold several classes go on, and there every pair from
different classes is compared by its signature, and verified if the estimate
is within three standard errors of the threshold.  A pair inside one class
needs no comparison, as no link between its texts can change a class.

*Verification.*  The similarity is computed from the whole texts' shingles.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .classes import linked_classes
from .common import bounded_batches, id_and_text, ident, slices, stored

WORDS = 5
SIMILARITY = 0.8
REGISTERS, BANDS, ROWS = 256, 25, 5
#: Least share of equal registers of a pair that is verified: 0.8 less three standard errors.
LEAST_EQUAL = 0.725
#: Most different lowest bits of registers, for a first look: 25.6 are expected at 0.8, and
#: this is three and a half standard errors more.
MOST_BITS = 42
SHINGLE_BITS = 50
MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (fixed constants of the public splitmix generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def weighted_shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, shingle, weight) of a batch, by text and shingle.

    Words are what white space separates.  A text of one to four words is one
    shingle; a text without words has none.
    """
    words = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(texts))
    flat = words.flatten()
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    coded = flat.dictionary_encode()
    hashes = pd.util.hash_array(np.array(coded.dictionary.to_pylist(), dtype=object))
    h = hashes[coded.indices.to_numpy(zero_copy_only=False)] if len(flat) else np.zeros(0, np.uint64)
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    owner, h = owner[full], h[full]
    if not len(h):
        return owner.astype(np.int64), h, np.zeros(0)
    n = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(n) - n
    rolled = np.zeros(len(h), np.uint64)
    for k in range(WORDS):  # a polynomial of the next words; texts that are shorter end sooner
        ok = np.flatnonzero(np.arange(len(h)) + k < (first + n)[owner])
        rolled[ok] = rolled[ok] * MIX + h[ok + k]
    place = np.arange(len(h)) - first[owner]
    starts = (place == 0) | (place + WORDS <= n[owner])
    key = _mixed(rolled[starts]) >> np.uint64(64 - SHINGLE_BITS)
    key = np.sort(key | (owner[starts].astype(np.uint64) << np.uint64(SHINGLE_BITS)))
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    weight = np.diff(np.concatenate((new, [len(key)])))
    key = key[new]
    return ((key >> np.uint64(SHINGLE_BITS)).astype(np.int64),
            key & np.uint64((1 << SHINGLE_BITS) - 1), 1.0 + np.log(weight))


def signatures(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int) -> np.ndarray:
    """ProbMinHash of every text of a batch: [text, register] first shingles (16 bits of them)."""
    first = np.full(texts * REGISTERS, np.inf)
    kept = np.zeros(texts * REGISTERS, np.uint64)
    seed, time, at = _mixed(shingle * MIX + np.uint64(1)), np.zeros(len(shingle)), owner
    while len(seed):
        seed = seed + MIX
        u = _mixed(seed)
        time = time - np.log(((u >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / weight
        register = at * REGISTERS + ((u & np.uint64(0x7FF)) * np.uint64(REGISTERS) >> np.uint64(11)).astype(np.int64)
        np.minimum.at(first, register, time)
        won = first[register] == time
        kept[register[won]] = shingle[won]
        last = first.reshape(texts, REGISTERS).max(axis=1)
        goes_on = np.flatnonzero(time < last[at])  # later arrivals of the others come too late
        seed, time, at, weight, shingle = seed[goes_on], time[goes_on], at[goes_on], weight[goes_on], shingle[goes_on]
    return (kept & np.uint64(0xFFFF)).astype(np.uint16).view(np.int16).reshape(texts, REGISTERS)


def similarity(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Probability Jaccard of two weighted sets with sorted elements."""
    every = np.union1d(a, b)
    wx, wy = np.zeros(len(every)), np.zeros(len(every))
    wx[np.searchsorted(every, a)] = x
    wy[np.searchsorted(every, b)] = y
    both = (wx > 0) & (wy > 0)
    if not both.any():
        return 0.0
    with np.errstate(divide="ignore"):
        ratio = np.where(wy > 0, wx / np.where(wy > 0, wy, 1.0), np.inf)
    order = np.argsort(ratio, kind="stable")
    sx = np.concatenate((np.cumsum(wx[order][::-1])[::-1], [0.0]))  # of elements from here on
    sy = np.concatenate(([0.0], np.cumsum(wy[order])))              # of elements before
    k = np.searchsorted(ratio[order], ratio[both], side="left")     # from k on, x's ratio is larger
    return float((1.0 / (sx[k] / wx[both] + sy[k] / wy[both])).sum())


SKETCH = "doc_id {id}, node binary, signature array<smallint>, bits array<bigint>"


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``node`` (128 bits of the text's digest), ``signature`` (null without
    words) and ``bits``, the lowest bits of its registers."""
    bounded_batches(docs.sparkSession)
    rows = _nodes(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, most=4_000_000):
            owner, shingle, weight = weighted_shingles(b.column("text"))
            made = signatures(owner, shingle, weight, b.num_rows)
            some = np.zeros(b.num_rows, bool)
            some[owner] = True
            ends = np.arange(b.num_rows + 1, dtype=np.int32) * REGISTERS
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(made.ravel()))
            packed = np.packbits(made & 1, axis=1).view(np.int64)
            ends = np.arange(b.num_rows + 1, dtype=np.int32) * packed.shape[1]
            bits = pa.ListArray.from_arrays(pa.array(ends), pa.array(packed.ravel()))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("node"), pc.if_else(pa.array(some), lists, None), bits],
                names=["doc_id", "node", "signature", "bits"])

    return rows.mapInArrow(run, SKETCH.format(id=rows.schema["doc_id"].dataType.simpleString()))


def _nodes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = id_and_text(docs, id_col, text_col)
    return rows.select("doc_id", _node("text").alias("node"), "text")


def _node(text):
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _equal(a: str, b: str):
    """Share of registers in which two signatures agree."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, F.lit(1)).otherwise(F.lit(0))),
                       F.lit(0), lambda n, x: n + x) / F.lit(float(REGISTERS))


def _alike(a: str, b: str):
    """A first look at two signatures: do few enough of their lowest bits differ?"""
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(REGISTERS // 64)),
               F.lit(0)) <= MOST_BITS


def _verified(pairs: DataFrame, shingles: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""
    def side(n: str) -> DataFrame:
        return shingles.select(F.col("node").alias(n), F.col("shingles").alias(f"s{n}"),
                               F.col("weights").alias(f"w{n}"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            ok = [similarity(*v) >= SIMILARITY - 1e-9 for v in zip(p["sa"], p["wa"], p["sb"], p["wb"], strict=True)]
            yield p.loc[ok, ["a", "b"]]

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "wa", "sb", "wb")
    return both.mapInPandas(run, "a binary, b binary")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``node`` and ``class_id``, the least id of
    the documents that a chain of near copies or copies joins.

    A null text is empty.  A text without words is in a class of its own, also
    beside other such texts.  Rows with equal ids may have different texts, and
    a class whose ids are all null has a null class id.  An empty table gives an
    empty table; other columns are ignored.  Texts are read whole; a bucket or a
    group of copies may hold any share of the rows.
    """
    spark = docs.sparkSession
    made = stored(sketches(docs, id_col, text_col), "sketches")
    texts = stored(made.where("signature IS NOT NULL").groupBy("node").agg(
        F.first("signature").alias("signature"), F.first("bits").alias("bits")), "texts")

    keys = F.array(*[F.xxhash64(F.lit(k), *[F.col("signature")[k * ROWS + i] for i in range(ROWS)])
                     for k in range(BANDS)])
    banded = texts.select("node", F.posexplode(keys).alias("band", "key"))
    buckets = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(banded.join(buckets, "key"), "members")

    met = members.groupBy("node").agg(F.sum("n").alias("met"))
    ranked = members.join(met, "node")
    hubs = ranked.groupBy("key").agg(F.array_distinct(F.array(
        F.max(F.struct("met", "node"))["node"],
        F.max(F.struct(F.xxhash64(F.lit(1), "node"), "node"))["node"],
        F.max(F.struct(F.xxhash64(F.lit(2), "node"), "node"))["node"])).alias("hubs"))
    near_hub = (members.join(hubs, "key").select("node", F.explode("hubs").alias("hub"))
                .where("node != hub")
                .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())

    # Shingles of the texts that share a bucket with another text, once.
    wanted = met.select("node")
    whole = (_nodes(docs, id_col, text_col).join(wanted, "node", "left_semi")
             .groupBy("node").agg(F.first("text").alias("text")))

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, most=4_000_000):
            owner, shingle, weight = weighted_shingles(b.column("text"))
            ends = pa.array(np.searchsorted(owner, np.arange(b.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), pa.ListArray.from_arrays(ends, pa.array(shingle.astype(np.int64))),
                 pa.ListArray.from_arrays(ends, pa.array(weight))],
                names=["node", "shingles", "weights"])

    shingles = stored(whole.mapInArrow(shingled, "node binary, shingles array<bigint>, weights array<double>"),
                      "shingles")
    signed = texts.select(F.col("node").alias("a"), F.col("signature").alias("qa"))
    signed_b = texts.select(F.col("node").alias("b"), F.col("signature").alias("qb"))
    likely = (near_hub.join(signed, "a").join(signed_b, "b")
              .where(_equal("qa", "qb") >= LEAST_EQUAL).select("a", "b"))
    links = stored(_verified(likely, shingles), "hub-links")
    roots = linked_classes(links)

    placed = members.join(roots, "node", "left").select(
        "key", "band", "node", F.coalesce("root", "node").alias("root"))
    several = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi")
    still_open = stored(placed.join(several.select("key"), "key", "left_semi").join(texts.withColumn("keys", keys), "node"), "open")
    a = still_open.select("key", "band", F.col("keys").alias("ka"), F.col("node").alias("a"), F.col("root").alias("ra"),
                          F.col("signature").alias("qa"), F.col("bits").alias("ba"))
    b = still_open.select("key", F.col("keys").alias("kb"), F.col("node").alias("b"), F.col("root").alias("rb"),
                          F.col("signature").alias("qb"), F.col("bits").alias("bb"))
    # A pair that meets in several bands is taken up in the first of them.
    meet = F.array_position(F.zip_with("ka", "kb", lambda x, y: x == y), True) == F.col("band") + 1
    across = (a.join(b, (a["key"] == b["key"]) & (F.col("ra") < F.col("rb")) & meet
                     & F.when(_alike("ba", "bb"), _equal("qa", "qb") >= LEAST_EQUAL).otherwise(False))
              .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    more = stored(_verified(stored(across, "across").join(likely, ["a", "b"], "left_anti"), shingles), "more-links")
    if not more.isEmpty():
        roots = linked_classes(links.unionByName(more))

    placed = made.join(roots, "node", "left").select(
        "doc_id", "node", F.coalesce("root", "node").alias("root"), F.col("signature").isNotNull().alias("words"))
    least = placed.where("words").groupBy("root").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "root", "left").select(
        "doc_id", "node", F.when(F.col("words"), F.col("least")).otherwise(F.col("doc_id")).alias("class_id"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: that of the least id.  All columns stay.

    Of repeated rows (the same id and text) one stays; texts without words all stay.
    """
    found = near_classes(docs, id_col, text_col)
    keep = (found.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
            .select(F.col("doc_id").alias("__id"), F.col("node").alias("__node")).distinct())
    names = docs.columns
    rows = docs.withColumn("__text_node", _node(F.coalesce(ident(text_col), F.lit(""))))
    kept = rows.join(keep, (rows["__text_node"] == keep["__node"])
                     & ident(id_col).eqNullSafe(F.col("__id")), "left_semi")
    return kept.dropDuplicates([id_col, "__text_node"]).select(*[ident(c) for c in names])
