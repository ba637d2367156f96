"""Packs: rows that hold the texts of some documents, side by side, for work on whole arrays.

A pack is what one task holds and tells of in one go; a longer text is a pack of its
own.  Tasks work on its *runs* (some documents side by side), so that the arrays made
on the way have a bound.  Packs are stored, so that their numbers stay what they are
when an executor is lost.
"""
from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, slices, stored

PACK_BYTES = 16_000_000
RUN_BYTES = 2_000_000
#: What a document counts for in a pack and a run besides its text: there may be many empty ones.
ROW_BYTES = 200
PACKED = "pack long, doc_ids array<long>, ends array<long>, bytes binary"
ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(),
         "array<long>": pa.list_(pa.int64())}


@functools.cache
def _coder(level: int | None) -> zstandard.ZstdCompressor | zstandard.ZstdDecompressor:
    """Made once a worker: for small pieces, to make one takes longer than to use it."""
    return zstandard.ZstdDecompressor() if level is None else zstandard.ZstdCompressor(level=level)


def shut(x, level: int = 1) -> bytes:
    return _coder(level).compress(np.ascontiguousarray(x).data if isinstance(x, np.ndarray) else x)


def opened(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(_coder(None).decompress(x), kind)


def cut(x: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Binary values: the bytes of the first items of an array, of those after them, and so on."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    offsets[1:] = np.cumsum(counts) * x.itemsize
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(x))])


def runs(ends: np.ndarray, most: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Documents side by side that come to ``most`` bytes together (one at least): from and to."""
    weight, i = ends + ROW_BYTES * np.arange(1, len(ends) + 1), 0
    while i < len(ends):
        before = weight[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(weight, before + most, side="right")))
        yield i, j
        i = j


def batch(schema: str, columns: list) -> pa.RecordBatch:
    """An Arrow batch of the columns; the schema is written as for mapInArrow."""
    kinds = pa.schema([(name, ARROW[kind]) for name, kind in map(str.split, schema.split(", "))])
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts (none null) side by side, and the end of each."""
    n, offsets = len(texts), np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32)
    offsets = offsets[texts.offset:texts.offset + n + 1].astype(np.int64)
    whole = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets[1:] - offsets[0]


def numbered() -> Iterator[int]:
    """Numbers that no other task of the same stage gives, and a repeated task gives again."""
    k = TaskContext.get().partitionId() << 32
    while True:
        yield k
        k += 1


def packed(rows: DataFrame) -> DataFrame:
    """Stored packs of (doc_id, text) rows without null texts; ``bytes`` are zstd-compressed."""
    bounded_batches(rows.sparkSession)

    def run(batches):
        numbers, ids, texts, sizes, weight = numbered(), [], [], [], 0

        def made():
            return batch(PACKED, [[next(numbers)], [ids], [np.cumsum(np.concatenate(sizes))], [shut(np.concatenate(texts), 3)]])

        for b in batches:
            for s in slices(iter([b]), most=RUN_BYTES):
                buf, ends = text_bytes(s.column("text"))
                more = len(buf) + ROW_BYTES * len(ends)
                if ids and weight + more > PACK_BYTES:
                    yield made()
                    ids, texts, sizes, weight = [], [], [], 0
                ids += s.column("doc_id").to_pylist()
                texts.append(buf)
                sizes.append(np.diff(ends, prepend=0))
                weight += more
        if ids:
            yield made()

    return stored(rows.mapInArrow(run, PACKED), "packs")


def by_key(rows: DataFrame, *key: str) -> DataFrame:
    """Rows of a key together in one task, in the order of the key's columns (the first one deals)."""
    return rows.repartition(F.col(key[0])).sortWithinPartitions(*key)


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Runs of rows with an equal key, from batches that :func:`by_key` has sorted."""
    held: list[dict] = []
    for b in batches:
        for row in b.to_pylist():
            if held and held[-1][key] != row[key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def by_bucket(rows: DataFrame, parts: int, *key: str) -> DataFrame:
    """Rows of a bucket (their first column of the key: 0 to ``parts`` - 1) as a task of their own, in the order of the key."""
    return rows.repartitionById(parts, F.col(key[0])).sortWithinPartitions(*key)


def buckets(packs: DataFrame) -> int:
    """Tasks that keys are dealt to: the number of shuffle partitions, a setting that grows with
    the data, and where it does not, one for two packs, so that what a task holds has a bound."""
    return max(8, int(packs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), -(-packs.count() // 2))


def none(kind: str) -> Column:
    return F.lit(None).cast(kind)
