"""Shards of repeated passages: what they and the buckets tell each other, and the parts of their work."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm import bwtmerge, packs
from riskspark.llm.common import id_and_text


def joined(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(b) for b in raw])


def test_rows_told_do_not_grow_with_the_square_of_the_data(spark):
    """Each shard tells a shuffle partition of its strings in one row, and a shard holds many megabytes."""
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(250)), lambda k: F.sha2(F.concat_ws(":", "doc_id", k), 256)))
    rows = id_and_text(spark.range(600).withColumnRenamed("id", "doc_id").withColumn("text", text).coalesce(1))
    shards = packs.packed(rows)
    parts = packs.buckets(shards)
    assert shards.agg(F.sum(F.array_max("ends"))).first()[0] > 9_000_000
    asked = bwtmerge._asked(shards.select("pack", "ends", "bytes"), parts)
    assert asked.count() <= 2 * max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def test_buckets_where_the_setting_does_not_grow(spark):
    packed = spark.range(101, numPartitions=1)
    assert packs.buckets(packed) == 51 and packs.buckets(packed.limit(1)) == max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def test_packs_hold_their_rows_in_order(spark):
    texts = ["", "é" * 30, "x" * 70_000, None, "a b c"] * 40
    rows = id_and_text(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1))
    found = []
    for r in packs.packed(rows).orderBy("pack").collect():
        buf, ends = packs.opened(r["bytes"], np.uint8), np.array(r["ends"])
        found += [(i, bytes(buf[a:b])) for i, a, b in zip(r["doc_ids"], ends - np.diff(ends, prepend=0), ends, strict=True)]
    assert found == [(i, (t or "").encode()) for i, t in enumerate(texts)]


def test_runs_and_spans_hold_everything_once():
    ends = np.cumsum([0, 10, 5_000, 0, 3, 700, 0])
    for most in (1, 500, 10_000):
        for found in (list(packs.runs(ends, most)), bwtmerge._spans(np.diff(ends, prepend=0), most)):
            assert [k for i, j in found for k in range(i, j)] == list(range(len(ends)))
    assert list(packs.runs(ends[:0])) == [] and len(list(packs.runs(ends, 1))) == len(ends)


@pytest.mark.parametrize("most", [1, 300, 1 << 30])
def test_strings_do_not_depend_on_runs(monkeypatch, most):
    rng = random.Random(4)
    texts = ["".join(rng.choices("ab ", k=rng.choice((0, 3, 49, 50, 51, 120, 400)))) for _ in range(80)] + ["z" * 500, "x" * 49, ""]
    monkeypatch.setattr(bwtmerge, "runs", lambda ends: packs.runs(ends, most))
    buf, ends = joined(texts)
    got = bwtmerge.Strings(buf, ends, 128)
    windows = [(d, p) for d, (b, e) in enumerate(zip([0, *ends[:-1]], ends, strict=True)) for p in range(b, e - bwtmerge.LEAST + 1)]
    assert [(d, p) for d, s, n in zip(got.doc, got.start, got.size, strict=True) for p in range(s, s + n)] == windows
    own: dict = {}
    for s, n, lot, anchor, digest in zip(got.start, got.size, got.lot, got.anchor, got.digest, strict=True):
        assert 0 < n <= bwtmerge.LEAST + 1 and 0 <= lot < 128
        string = bytes(buf[s:s + n + bwtmerge.LEAST - 1])
        assert own.setdefault(digest, string) == string
        for k in range(n):  # equal windows are in one lot, with one anchor
            assert own.setdefault(string[k:k + bwtmerge.LEAST], (lot, anchor)) == (lot, anchor)
    assert len({own[d] for d in got.digest}) == len(set(got.digest.tolist()))


def test_window_hashes_depend_on_the_window_alone():
    rng = np.random.default_rng(1)
    buf = rng.integers(0, 256, 3 * bwtmerge.CHUNK, np.uint8)
    buf[70_000:70_400] = buf[100:500]
    buf[bwtmerge.CHUNK - 30:bwtmerge.CHUNK + 70] = buf[100:200]
    at = np.array([100, 101, bwtmerge.CHUNK - 30, bwtmerge.CHUNK - 29, bwtmerge.CHUNK, 70_000, 70_001, len(buf) - 50])
    first, none = bwtmerge.window_hashes(buf, at, at[:0])
    alone = [bwtmerge.window_hashes(buf[p:p + 50].copy(), np.array([0]))[0][0] for p in at]
    assert first.tolist() == alone and len(none) == 0
    assert first[0] == first[2] == first[5] and first[1] == first[3] == first[6] and len(set(alone)) == 4


def test_a_merge_of_several_lots_from_rows_that_lead_to_windows():
    """Lots side by side, and only rows that can reach LEAST bytes: the same intervals of windows."""
    rng = random.Random(6)
    pool = ["".join(rng.choices("abc", k=60)) for _ in range(6)]
    lots = [[("".join(rng.choices(pool, k=2)) + "q" * rng.randint(0, 9)).encode()[rng.randint(0, 40):] for _ in range(n)] for n in (5, 1, 9, 4)]
    lots = [[s[:100] for s in strings] for strings in lots]
    lines = []
    for strings in lots:
        buf, length = joined([s.decode() for s in strings])
        length = np.diff(length, prepend=0)
        lines.append(bwtmerge.transform(buf, np.cumsum(length) - length, length, np.zeros(len(strings), np.int64))[0])
    flat = [s for strings in lots for s in strings]

    def windows(merged, string, length):
        suffix = [flat[s][len(flat[s]) - n:][:bwtmerge.LEAST] for s, n in zip(string[merged.rows], length[merged.rows], strict=True)]
        return suffix, [sorted(zip(string[b].tolist(), length[b].tolist(), strict=True)) for b in np.split(merged.rows, merged.blocks[1:])]

    whole = bwtmerge.Merged(lines)
    deep = bwtmerge.Merged([np.concatenate(lines)], sizes=np.array([len(t) for t in lines]), deep=True)
    want, got = windows(whole, *whole.places()), windows(deep, deep.string, deep.length)
    assert got == want and len(want[0]) > 20 and want[0] == sorted(want[0])
