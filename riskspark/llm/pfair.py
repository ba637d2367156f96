"""Mixing sources to target weights by Pfair scheduling.

Every source is cut into blocks of about equal size.  With target weights
``w`` that add up to one, the j-th block of a source has release time
``floor((j - 1) / w)`` and deadline ``ceil(j / w)``; each slot takes, of the
blocks that are released, the one with the earliest deadline.  After any
number ``t`` of slots every source has had ``w * t`` blocks to within less than
one block.

Weights are rational numbers and taken as they are: windows are worked out in
whole numbers, without rounding, whatever the number of sources.  The table of
slots, one row a block, is made by one task that holds a few numbers per
source; the documents, however many, get their slots by a join.  A *phase* ends
with the last block of a source; the others go on with their weights scaled up.
Nothing is dropped or repeated.
"""
from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator, Mapping
from fractions import Fraction
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ident, stored

#: Slots of a period in whole shares (``in_period``).
PERIOD = 1_000
#: Rows of the table of slots that its task holds at a time.
SLOT_ROWS = 100_000
#: Characters in a block, and documents in a bucket of a source (a bucket is ordered by one task).
BLOCK_CHARS, BUCKET_ROWS = 1_000_000, 5_000
#: A source's default target weight is its size to this power, scaled to a sum of one.
TEMPER = 0.7


def tempered(sizes: Mapping[str, int], power: float = TEMPER) -> dict[str, float]:
    """Target weights from sizes: small sources come up, large ones down."""
    raw = {s: n ** power for s, n in sizes.items() if n > 0}
    return {s: x / sum(raw.values()) for s, x in raw.items()}


def in_period(weights: Mapping[str, float], period: int = PERIOD) -> dict[str, int]:
    """Blocks of each source in a period: largest remainders, at least one each.

    A rounded form of the weights; the schedule does not use it.
    """
    period = max(period, len(weights))
    total = sum(weights.values())
    spare = period - len(weights)
    exact = {s: spare * w / total for s, w in weights.items()}
    got = {s: 1 + int(x) for s, x in exact.items()}
    late = sorted(weights, key=lambda s: (int(exact[s]) - exact[s], s))
    for s in late[:period - sum(got.values())]:
        got[s] += 1
    return got


def earliest(shares: Mapping[str, int], blocks: Mapping[str, int],
             end: int) -> Iterator[tuple[int, str, int, int, int]]:
    """(slot, source, place, release, deadline) of the slots before ``end``, earliest deadline first.

    A source's weight is its share of the sum of ``shares``.  Equal deadlines:
    the heavier source, then its name, comes first.
    """
    total = sum(shares.values())
    waiting = [(0, s, 1) for s in shares]          # by release
    heapq.heapify(waiting)
    ready: list[tuple[int, int, str, int, int]] = []    # by deadline
    for slot in range(end):
        while waiting and waiting[0][0] <= slot:
            release, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-j * total // shares[s]), -shares[s], s, j, release))
        if not ready:
            return
        deadline, _, s, j, release = heapq.heappop(ready)
        yield slot, s, j - 1, release, deadline
        if j < blocks[s]:
            heapq.heappush(waiting, (j * total // shares[s], s, j + 1))


def one_period(blocks: Mapping[str, int]) -> list[tuple[str, int, int, int, int]]:
    """(source, place, slot, release, deadline) of a period of whole shares."""
    return [(s, place, slot, release, deadline) for slot, s, place, release, deadline
            in earliest(blocks, blocks, sum(blocks.values()))]


def whole(weights: Mapping[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the proportion of the weights."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(x.denominator for x in exact.values()))
    return {s: int(x * scale) for s, x in exact.items()}


def timetable(groups: Iterable[tuple[Mapping[str, int], Mapping[str, float]]]
              ) -> Iterator[tuple[str, int, int, int, int, int]]:
    """(source, block, phase, slot, release, deadline) of every block, in the order of slots.

    ``groups``, one after the other: the number of blocks and the weight of each source.
    A phase ends at the first deadline of a source's last block.  Up to the slot
    before it every source has a block for each of its windows, so that no slot is
    empty; the last slot may find none, and then the phase is a slot shorter.
    """
    start = number = 0
    for blocks, weights in groups:
        left = {s: n for s, n in blocks.items() if n > 0}
        done = dict.fromkeys(left, 0)
        shares = whole({s: weights[s] for s in left})
        while left:
            total = sum(shares[s] for s in left)
            end = min(-(-n * total // shares[s]) for s, n in left.items())
            used = dict.fromkeys(left, 0)
            for slot, s, place, release, deadline in earliest({s: shares[s] for s in left}, left, end):
                used[s] += 1
                # A deadline beyond a long is that of a weight next to nothing.
                yield s, done[s] + place, number, start + slot, release, min(deadline, 2 ** 63 - 1)
            for s, n in used.items():
                done[s] += n
            left = {s: n - used[s] for s, n in left.items() if n > used[s]}
            start += sum(used.values())
            number += 1


def blocks_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source", block_chars: int = BLOCK_CHARS,
              bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``doc_id``, ``source``, ``digest``, ``chars`` and ``block`` (from 0) of every row.

    Within a source documents are ordered by a hash of id and text; a
    document is in the block in which its first character falls.  The order is
    built from buckets of about ``bucket_rows`` documents, ranges of the hash,
    so that a source with most of the rows is spread over many tasks.
    """
    text = F.coalesce(ident(text_col), F.lit(""))
    rows = docs.select(
        ident(id_col).alias("doc_id"), F.coalesce(ident(source_col).cast("string"), F.lit("")).alias("source"),
        F.xxhash64(text).alias("digest"), F.greatest(F.length(text), F.lit(1)).cast("long").alias("chars"))
    rows = rows.withColumn("rank", F.shiftrightunsigned(F.xxhash64(F.lit(6), "doc_id", "digest"), 1))
    sizes = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    # One row a source, which the driver holds as well: small enough to be sent to every task.
    rows = rows.join(F.broadcast(sizes.select(
        "source", F.ceil(F.col("n") / bucket_rows).cast("double").alias("cuts"))), "source")
    rows = rows.withColumn("bucket", F.floor(F.col("rank") / F.lit(2.0 ** 63) * F.col("cuts")).cast("long"))
    totals = rows.groupBy("source", "bucket").agg(F.sum("chars").alias("total"))
    before = totals.select("source", "bucket", (F.sum("total").over(
        Window.partitionBy("source").orderBy("bucket")) - F.col("total")).alias("before"))
    inside = Window.partitionBy("source", "bucket").orderBy("rank", "doc_id", "digest").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (rows.withColumn("upto", F.sum("chars").over(inside)).join(before, ["source", "bucket"])
            .select("doc_id", "source", "digest", "chars", "rank",
                    F.floor((F.col("before") + F.col("upto") - F.col("chars")) / F.lit(block_chars))
                    .cast("long").alias("block")))


def schedule(docs: DataFrame, weights: Mapping[str, float] | None = None, id_col: str = "doc_id",
             text_col: str = "text", source_col: str = "source",
             block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per input row: ``doc_id``, ``source``, ``digest``, ``block``, ``phase``,
    ``slot``, ``release`` and ``deadline`` (counted from the phase's first slot).

    ``weights``: target weight by source (any scale); without it, the sources'
    sizes to the power 0.7.  A source that it does not name, or gives nothing,
    comes after the others, in proportion to size.  A null source is the
    source "".  A null or empty text counts one character.  Equal rows get
    equal places; an empty table gives an empty table; other columns are ignored.
    The driver and the task that makes the table of slots hold a few numbers per
    source; that task takes one step a block, and one a source for every phase.
    """
    spark = docs.sparkSession
    blocks = blocks_of(docs, id_col, text_col, source_col, block_chars)
    sizes = {r.source: (r.blocks, r.chars) for r in blocks.groupBy("source").agg(
        (F.max("block") + 1).alias("blocks"), F.sum("chars").alias("chars")).collect()}
    named = {s: w for s, w in (weights or {}).items() if s in sizes and w > 0}
    target = named or tempered({s: c for s, (_, c) in sizes.items()})
    rest = tempered({s: c for s, (_, c) in sizes.items() if s not in target}, 1.0)

    groups = [({s: sizes[s][0] for s in part}, part) for part in (target, rest)]

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _ in batches:
            rows = timetable(groups)
            while some := list(islice(rows, SLOT_ROWS)):
                yield pd.DataFrame(some, columns=["source", "block", "phase", "slot", "release", "deadline"])

    # Stored, so that it is made once and the join knows its size.
    slots = stored(spark.range(0, 1, 1, 1).mapInPandas(
        make, "source string, block long, phase int, slot long, release long, deadline long"), "slots")
    return blocks.join(slots, ["source", "block"]).select(
        "doc_id", "source", "digest", "chars", "rank", "block", "phase", "slot", "release", "deadline")


def mixed(docs: DataFrame, weights: Mapping[str, float] | None = None, id_col: str = "doc_id",
          text_col: str = "text", source_col: str = "source",
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` in the order of the schedule: partitions are ranges of slots, and rows
    are in order within them.  All rows and columns stay."""
    names = docs.columns
    plan = (schedule(docs, weights, id_col, text_col, source_col, block_chars)
            .groupBy("doc_id", "digest").agg(F.min("slot").alias("__slot"), F.min("rank").alias("__rank"))
            .select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "__slot", "__rank"))
    rows = docs.withColumn("__text_digest", F.xxhash64(F.coalesce(ident(text_col), F.lit(""))))
    placed = rows.join(plan, ident(id_col).eqNullSafe(F.col("__id"))
                       & (rows["__text_digest"] == plan["__digest"]))
    return (placed.repartitionByRange("__slot", "__rank").sortWithinPartitions("__slot", "__rank")
            .select(*[ident(c) for c in names]))
