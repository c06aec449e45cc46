"""Repeated windows of a fixed width, found through content-chosen anchors.

Every window of ``width`` symbols picks one anchor inside it: of all runs of
``core`` symbols the one of the smallest hash, the leftmost of equals. Equal
windows pick equal anchors at equal offsets, so windows need to meet only those
that picked the same anchor. Consecutive windows of one anchor form a run, the
locally compacted path of the graph whose nodes are overlapping windows; the
symbols that a run covers are its hull.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantlens.llm.common import cut, sized
from plantlens.llm.hashing import BASE, BYTE, BYTE2, SLAB, mix, powers, word_hashes

BACK = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Spans of at most this many rows are broadcast to the texts, beyond that both are shuffled.
BROADCAST_SPANS = 2_000_000


@dataclass(frozen=True)
class Shape:
    width: int
    core: int
    words: bool  # symbols are words, else bytes


def symbols(data: bytes | None, words: bool, twin: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit values for each symbol."""
    data = data or b""
    if words:
        return word_hashes(data), word_hashes(data, BYTE2) if twin else None
    values = np.frombuffer(data, np.uint8)
    return BYTE[values], BYTE2[values] if twin else None


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    m = len(a)
    blocks = np.full(-(-m // w) * w, np.iinfo(np.uint64).max, np.uint64)
    blocks[:m] = a
    blocks = blocks.reshape(-1, w)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: m - w + 1], before[w - 1 : m])


class Hasher:
    """Hashes of ranges of one slab of symbols."""

    _power: np.ndarray | None = None
    _inverse: np.ndarray | None = None

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        if Hasher._power is None or len(Hasher._power) < n:
            size = max(n, 1 << 16)
            Hasher._power = powers(size)
            inverse = np.full(size, BACK)
            inverse[:1] = 1
            Hasher._inverse = np.multiply.accumulate(inverse)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * Hasher._power[:n], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * Hasher._inverse[start], seed)

    def fixed(self, k: int) -> np.ndarray:
        n = len(self.sums) - 1
        return mix((self.sums[k:] - self.sums[: n - k + 1]) * Hasher._inverse[: n - k + 1], k)


def slabs(n: int, shape: Shape):
    """(from, to) of symbols so that each window lies whole in exactly one slab."""
    for at in range(0, max(0, n - shape.width + 1), SLAB):
        yield at, min(n, at + SLAB + shape.width - 1)


def runs_of(one: np.ndarray, two: np.ndarray | None, shape: Shape):
    """Per slab arrays: anchor hash, first window, windows, offset of the anchor in the first, hull hashes."""
    for a, b in slabs(len(one), shape):
        first = Hasher(one[a:b])
        cores = first.fixed(shape.core)
        at = np.arange(len(cores), dtype=np.uint64)
        low = np.uint64((1 << 31) - 1)
        chosen = (sliding_min((cores & ~low) | at, shape.width - shape.core + 1) & low).astype(np.int64)
        start = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
        end = np.concatenate((start[1:], [len(chosen)])) - 1
        anchor = cores[chosen[start]]
        if two is None:
            yield anchor, None
            continue
        reach = end + shape.width
        yield anchor, (start + a, end - start + 1, chosen[start] - start, first.ranges(start, reach, 3), Hasher(two[a:b]).ranges(start, reach, 5))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def anchors_of(docs: DataFrame, shape: Shape) -> DataFrame:
    """(anchor) of every run."""

    def run(batches):
        for batch in batches:
            for data in batch.column("text").cast(pa.binary()).to_pylist():
                for anchor, _ in runs_of(symbols(data, shape.words, False)[0], None, shape):
                    yield pa.RecordBatch.from_arrays([_signed(anchor)], names=["anchor"])

    return docs.select("text").mapInArrow(_gathered(run), "anchor long")


def _gathered(run, rows: int = 50_000):
    """Joins the small batches that ``run`` gives into larger ones."""

    def joined(batches):
        held, n = [], 0
        for b in run(batches):
            held.append(b)
            n += b.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return joined


def hulls_of(docs: DataFrame, shape: Shape) -> DataFrame:
    """(anchor, key, start, windows, off, h1, h2) of every run."""

    def run(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for key, data in zip(keys, batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                for anchor, (start, n, off, h1, h2) in runs_of(*symbols(data, shape.words), shape):
                    yield pa.RecordBatch.from_arrays(
                        [_signed(anchor), pa.array(np.full(len(anchor), key, np.int64)), pa.array(start), pa.array(n.astype(np.int32)),
                         pa.array(off.astype(np.int32)), _signed(h1), _signed(h2)],
                        names=["anchor", "key", "start", "windows", "off", "h1", "h2"])

    return docs.select("key", "text").mapInArrow(
        _gathered(run), "anchor long, key long, start long, windows int, off int, h1 long, h2 long")


HULL = ["anchor", "off", "windows", "h1", "h2"]


def copies_of(rows: DataFrame) -> DataFrame:
    """(key, first, members) of the texts that several documents have."""
    texts = cut(rows.filter("text is not null").select("key", F.md5(F.col("text").cast("binary")).alias("hash")), "texts")
    groups = texts.groupBy("hash").agg(F.min("key").alias("first"), F.count("*").alias("members")).filter("members > 1")
    return cut(texts.join(cut(groups, "groups"), "hash").select("key", "first", "members"), "copies")


def repeated_runs(docs: DataFrame, shape: Shape) -> tuple[DataFrame, DataFrame]:
    """Runs of anchors that occur more than once, and their distinct hulls.

    (anchor, key, start, windows, off, h1, h2), and HULL with n (occurrences),
    first (key, start) and kinds (distinct hulls of the anchor). Both are written.
    """
    shared = cut(anchors_of(docs, shape).groupBy("anchor").count().filter("count > 1").select("anchor"), "anchors")
    runs = cut(hulls_of(docs, shape).join(sized(shared), "anchor"), "runs")
    hulls = cut(runs.groupBy(*HULL).agg(F.count("*").alias("n"), F.min(F.struct("key", "start")).alias("first")), "hulls")
    # written first: a join of two exchanges is one whose hot keys Spark can split
    kinds = cut(hulls.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "branching")
    hulls = cut(hulls.join(kinds, "anchor", "left").select(*HULL, "n", "first", F.coalesce("kinds", F.lit(1)).alias("kinds")), "kinds")
    return runs, hulls


def merged(spans: DataFrame) -> DataFrame:
    """(key, start, end): touching and overlapping spans of a document as one."""
    order = Window.partitionBy("key").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("_new", F.when(F.col("start") <= reach, 0).otherwise(1))
    grouped = marked.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy("key", "_run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_run")


def with_spans(rows: DataFrame, spans: DataFrame, copies: DataFrame) -> DataFrame:
    """``rows`` with spans (array of start, end) and first, members of their copies."""
    spans = cut(spans, "spans")
    n = spans.count()
    per = spans.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    return rows.join(sized(per, n, BROADCAST_SPANS), "key", "left").join(sized(copies), "key", "left")
