"""Removal of repeated passages of words: compacted paths of a De Bruijn graph."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantlens.llm.anchors import (
    HULL, Hasher, Shape, _gathered, _signed, copies_of, merged, repeated_runs, symbols, with_spans,
)
from plantlens.llm.common import cut, keyed, restored, sized
from plantlens.llm.hashing import word_spans

WIDTH, CORE = 20, 5


def windows_of(docs: DataFrame, wanted: DataFrame, shape: Shape) -> DataFrame:
    """(h1, h2, key, start) of each window of the ``wanted`` runs (key, start, windows)."""
    n = wanted.count()
    per = wanted.groupBy("key").agg(F.collect_list(F.struct("start", "windows")).alias("runs"))

    def run(batches):
        for batch in batches:
            keys, runs = batch.column("key").to_numpy(), batch.column("runs")
            for i, data in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                one, two = symbols(data, shape.words)
                own = runs[i].values
                start, count = own.field("start").to_numpy(), own.field("windows").to_numpy()
                at = np.unique(np.concatenate([np.arange(s, s + c) for s, c in zip(start, count, strict=True)]))
                h1, h2 = Hasher(one).ranges(at, at + shape.width, 3), Hasher(two).ranges(at, at + shape.width, 5)
                yield pa.RecordBatch.from_arrays(
                    [_signed(h1), _signed(h2), pa.array(np.full(len(at), keys[i], np.int64)), pa.array(at)], names=["h1", "h2", "key", "start"])

    return docs.join(sized(per, n), "key").select("key", "text", "runs").mapInArrow(
        _gathered(run), "h1 long, h2 long, key long, start long")


def repeated_paths(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(key, start, end, source, source_start): word spans that stand earlier elsewhere, with where.

    Windows of ``width`` words are the edges of the graph. Runs of windows of one
    anchor, which are nonbranching paths, are compared whole: of equal ones the
    first stays, and all others repeat it. Only the first ones of anchors with
    several different runs, where paths branch, are compared window by window.
    Neighbouring repeats that follow one source at one distance are joined to
    long paths.
    """
    shape = Shape(width, CORE, True)
    runs, hulls = repeated_runs(docs, shape)
    several = hulls.filter("n > 1").select(*HULL, "first")
    whole = runs.join(several, HULL).filter("not (key = first.key and start = first.start)").select(
        "key", "start", (F.col("start") + F.col("windows") - 1 + width).alias("end"),
        F.col("first.key").alias("source"), F.col("first.start").alias("source_start"))
    branching = cut(hulls.filter("kinds > 1").select("first.key", "first.start", "windows"), "branching")
    singles = cut(windows_of(docs, branching, shape), "singles")
    firsts = singles.groupBy("h1", "h2").agg(F.min(F.struct("key", "start")).alias("first"), F.count("*").alias("n"))
    firsts = cut(firsts.filter("n > 1").drop("n"), "firsts")
    single = singles.join(firsts, ["h1", "h2"]).filter("not (key = first.key and start = first.start)").select(
        "key", "start", (F.col("start") + width).alias("end"), F.col("first.key").alias("source"), F.col("first.start").alias("source_start"))
    return whole.unionByName(single)


def compacted(paths: DataFrame) -> DataFrame:
    """Paths that continue each other in the text and in their source, joined to one."""
    lane = paths.withColumn("shift", F.col("source_start") - F.col("start"))
    order = Window.partitionBy("key", "source", "shift").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    lane = lane.withColumn("_new", F.when(F.col("start") <= reach, 0).otherwise(1))
    lane = lane.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = lane.groupBy("key", "source", "shift", "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return joined.select("key", "start", "end", "source", (F.col("start") + F.col("shift")).alias("source_start"))


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept (words joined by a blank), kept_sha256, source.

    Removes each word in a window of ``width`` words that also starts earlier: in
    a smaller doc_id or before in the same document. Texts that equal an earlier
    one whole are told from their hash (``source`` is its key) and need no
    windows. Null, empty and short texts lose nothing. Equal rows of one doc_id
    count as one document and get its result; different texts of one doc_id are
    ordered by text, null ids first. Only doc_id and text are read.
    """
    rows = keyed(docs)
    copies = copies_of(rows).filter("key <> first")
    own = rows.join(sized(copies.select("key")), "key", "left_anti").select("key", "text")
    spans = merged(cut(compacted(repeated_paths(own, width)), "paths"))
    table = with_spans(rows, spans, copies)

    def run(batches):
        for batch in batches:
            spans, first = batch.column("spans"), batch.column("first").to_pylist()
            out = []
            for i, data in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                data = data or b""
                start, end = word_spans(data)
                n = len(start)
                keep = np.ones(n, bool)
                if first[i] is not None and n >= width:
                    keep[:] = False
                elif spans[i].is_valid:
                    own = spans[i].values
                    for s, e in zip(own.field("start").to_pylist(), own.field("end").to_pylist(), strict=True):
                        keep[s:e] = False
                kept = b" ".join(data.split() if keep.all() else [w for w, k in zip(data.split(), keep.tolist(), strict=True) if k])
                out.append((n, int(n - keep.sum()), kept.decode(), hashlib.sha256(kept).hexdigest()))
            n, removed, kept, sha = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
                 pa.array(sha, pa.string()), batch.column("first"), batch.column("copies")],
                names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256", "source", "copies"])

    table = table.select("doc_id", "text", "spans", "first", "copies")
    return restored(table.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string, source long, copies long"))
