"""Removal of byte strings that occur more than once, across and within documents.

A sorted order of all byte suffixes would shuffle every position of the corpus
many times over. Here only content-chosen anchors (about one in 180 bytes) take
part: windows of 400 bytes can equal only windows of the same anchor, which are
then told apart by ever shorter chunks of their common neighbourhood.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.llm.anchors import HULL, Hasher, Shape, _gathered, _signed, copies_of, merged, repeated_runs, symbols, with_spans
from plantlens.llm.common import cut, keyed, restored, sized

WIDTH, CORE = 400, 32
#: Windows are told apart in chunks of so many neighbouring offsets.
CHUNKS = (64, 8, 1)


def texts_of(docs: DataFrame, wanted: DataFrame, shape: Shape) -> DataFrame:
    """(id, data): the bytes of the hulls of ``wanted`` (id, key, start, windows)."""
    n = wanted.count()
    per = wanted.groupBy("key").agg(F.collect_list(F.struct("id", "start", "windows")).alias("runs"))

    def run(batches):
        for batch in batches:
            runs = batch.column("runs")
            for i, data in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                own = runs[i].values
                ids, starts, counts = (own.field(c).to_pylist() for c in ("id", "start", "windows"))
                cuts = [data[s : s + c - 1 + shape.width] for s, c in zip(starts, counts, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(cuts, pa.binary())], names=["id", "data"])

    return docs.join(sized(per, n), "key").select("key", "text", "runs").mapInArrow(_gathered(run, 5000), "id long, data binary")


def chunks_of(items: DataFrame, shape: Shape, size: int) -> DataFrame:
    """(id, anchor, chunk, lo, hi, core1, core2, hull1, hull2) of (id, anchor, off, lo, hi, data).

    The window at offset o covers [-o, width - o) around the anchor. A chunk is
    ``size`` neighbouring offsets; its core is what all its windows share, so any
    equal windows of two runs need equal cores; its hull is what the run's own
    windows of the chunk, lo to hi, cover: equal hulls are equal windows.
    """

    def run(batches):
        for batch in batches:
            anchor, off, lo, hi, ids = (batch.column(c).to_numpy() for c in ("anchor", "off", "lo", "hi", "id"))
            out = []
            for i, data in enumerate(batch.column("data").to_pylist()):
                one, two = (Hasher(s) for s in symbols(data, False))
                q = np.arange(lo[i] // size, hi[i] // size + 1)
                low, high = np.maximum(q * size, lo[i]), np.minimum((q + 1) * size - 1, hi[i])
                a = off[i] - q * size, off[i] - (q + 1) * size + 1 + shape.width
                b = off[i] - high, off[i] - low + shape.width
                out.append((np.full(len(q), ids[i]), np.full(len(q), anchor[i]), q, low, high,
                            one.ranges(*a, 11), two.ranges(*a, 13), one.ranges(*b, 17), two.ranges(*b, 19)))
            if out:
                cols = [np.concatenate(c) for c in zip(*out, strict=True)]
                kinds = ["id", "anchor", "chunk", "lo", "hi", "core1", "core2", "hull1", "hull2"]
                arrays = [pa.array(c.astype(np.int32)) if k in ("chunk", "lo", "hi") else _signed(c) for c, k in zip(cols, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=kinds)

    return items.select("id", "anchor", "off", "lo", "hi", "data").mapInArrow(
        run, "id long, anchor long, chunk int, lo int, hi int, core1 long, core2 long, hull1 long, hull2 long")


CORE_KEY = ["anchor", "chunk", "core1", "core2"]
HULL_KEY = [*CORE_KEY, "lo", "hi", "hull1", "hull2"]


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(key, start, end) of byte spans whose windows of ``width`` bytes occur more than once."""
    shape = Shape(width, CORE, False)
    runs, hulls = repeated_runs(docs, shape)
    whole = runs.join(hulls.filter("n > 1").select(*HULL), HULL).select(
        "key", "start", (F.col("start") + F.col("windows") - 1 + width).alias("end"))
    # one run of each kind stands for all of them; those of one occurrence may still repeat in part
    kinds = cut(hulls.filter("kinds > 1").select(
        F.monotonically_increasing_id().alias("id"), "anchor", "off", "windows", F.col("first.key").alias("key"), F.col("first.start").alias("start")), "runs")
    data = cut(texts_of(docs, kinds.select("id", "key", "start", "windows"), shape), "bytes")
    places = kinds.select("id", "anchor", "off", "key", F.col("start").alias("first"))
    items = kinds.select("id", (F.col("off") - F.col("windows") + 1).alias("lo"), F.col("off").alias("hi"))
    found = whole
    for size in CHUNKS:
        rows = items.join(data, "id").join(places.select("id", "anchor", "off"), "id")
        rows = cut(chunks_of(rows, shape, size), "chunks")
        same = cut(rows.groupBy(*HULL_KEY).agg(F.count("*").alias("n"), F.min("id").alias("id")), "same")
        alike = cut(same.groupBy(*CORE_KEY).agg(F.count("*").alias("kinds")), "kinds")
        same = cut(same.join(alike, CORE_KEY).filter("n > 1 or kinds > 1"), "alike")
        again = rows.join(same.filter("n > 1").select(*HULL_KEY), HULL_KEY).select("id", "lo", "hi")
        at = again.join(places, "id").select(
            "key", (F.col("first") + F.col("off") - F.col("hi")).alias("start"), (F.col("first") + F.col("off") - F.col("lo") + width).alias("end"))
        found = found.unionByName(cut(at, "found"))
        items = same.filter("kinds > 1").select("id", "lo", "hi")
    return found


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, spans (start, end), kept (bytes), kept_sha256.

    Removes each UTF-8 byte covered by a string of ``width`` bytes that starts
    anywhere else too, in the same document as well, overlaps included; the first
    occurrence goes with the others. Texts of several documents, told by their
    hash, go whole if they are long enough, and one of them stands for all in the
    search. Null, empty and short texts lose nothing. Equal rows of one doc_id
    are documents of their own, so long ones remove each other. Only doc_id and
    text are read.
    """
    rows = keyed(docs)
    copies = copies_of(rows)
    others = copies.filter("key <> first").select("key")
    own = rows.join(sized(others), "key", "left_anti").select("key", "text")
    table = with_spans(rows, merged(cut(repeated_spans(own, width), "repeats")), copies)

    def run(batches):
        for batch in batches:
            spans, first, copies = batch.column("spans"), batch.column("first").to_pylist(), batch.column("copies").to_pylist()
            out = []
            for i, data in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                data, gone = data or b"", []
                if (first[i] is not None or copies[i] > 1) and len(data) >= width:
                    gone = [(0, len(data))]
                elif spans[i].is_valid:
                    own = spans[i].values
                    gone = list(zip(own.field("start").to_pylist(), own.field("end").to_pylist(), strict=True))
                edges = [0, *[x for s in gone for x in s], len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((len(data), len(data) - len(kept), [{"start": a, "end": b} for a, b in gone], kept, hashlib.sha256(kept).hexdigest()))
            n, removed, gone, kept, sha = zip(*out, strict=True) if out else ((), (), (), (), ())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(gone, kind), pa.array(kept, pa.binary()),
                 pa.array(sha, pa.string()), batch.column("copies")],
                names=["doc_id", "n_bytes", "n_removed", "spans", "kept", "kept_sha256", "copies"])

    return restored(table.select("doc_id", "text", "spans", "first", "copies").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary, kept_sha256 string, copies long"))
