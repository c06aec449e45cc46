"""Near-duplicate documents by an exact Jaccard join on word shingles.

The global order of shingles, rare ones first, is vertically partitioned. Its
first fragment of each document, the prefix, gives candidates; overlaps are
counted for each fragment on its own and summed per pair.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import components, cut, keyed, lean, restored, sized
from plantlens.llm.hashing import mix, shingles, word_hashes

#: Links need intersection / union of at least NUM / DEN.
NUM, DEN = 4, 5
WIDTH = 5
#: Fragments of the order of hashes that overlaps are counted in.
FRAGMENTS = 8
#: The most frequent shingles, by documents that have them, come last in the order.
#: The list only orders, so its bound costs time where there are more of them, never a link.
HOT_SHINGLES, HOT_DOCS = 131_072, 16
#: Shingles that a task counts at once.
COUNTED = 2_000_000
#: Shingles are also counted by the first bits of their hash, a byte for each bucket, up to FULL. The size
#: follows the number of shingles and ends at 64 MB; fuller buckets tell rare shingles less well, and lose no link.
SKETCH_BITS, FULL = (16, 26), 255
#: Buckets that travel together.
CHUNK = 1 << 16


def sets_of(batch: pa.RecordBatch):
    """(row, sorted distinct shingle hashes) of each text."""
    for i, data in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
        yield i, shingles(word_hashes((data or b"").lower()), WIDTH)


def counts_of(docs: DataFrame, bits: int) -> DataFrame:
    """Counts of one pass over all texts: rows (token, count), and rows (chunk, counts) of a task's sketch.

    The first are the shingles that stand in several documents of one stretch of
    COUNTED shingles. Each task counts its own stretches, so a shingle of more
    documents than there are stretches is always found, and unique ones never move.
    """
    schema = pa.schema([("token", pa.int64()), ("count", pa.int64()), ("chunk", pa.int32()), ("counts", pa.binary())])

    def counted(held, sketch):
        found = np.concatenate(held)
        held.clear()
        found.sort()
        first = np.flatnonzero(np.append(True, found[1:] != found[:-1])[: len(found)])
        token, n = found[first], np.diff(np.append(first, len(found)))
        del found
        if len(token):
            bucket = token >> np.uint64(64 - bits)
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            at = bucket[first]
            sketch[at] = np.minimum(sketch[at] + np.add.reduceat(n, first), FULL)
        token, n = token[n > 1], n[n > 1]
        none = pa.nulls(len(token))
        return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n), none.cast(pa.int32()), none.cast(pa.binary())], schema=schema)

    def run(batches):
        held, n, sketch = [], 0, np.zeros(1 << bits, np.uint8)
        for batch in batches:
            for _, s in sets_of(batch):
                held.append(s)
                n += len(s)
                if n >= COUNTED:
                    yield counted(held, sketch)
                    n = 0
        if held:
            yield counted(held, sketch)
        for i, part in enumerate(sketch.reshape(-1, CHUNK)):
            if part.any():
                yield pa.RecordBatch.from_pylist([{"chunk": i, "counts": zlib.compress(part, 1)}], schema=schema)

    return docs.select("text").mapInArrow(lean(run), "token long, count long, chunk int, counts binary")


def sketch_of(counts: DataFrame, bits: int) -> np.ndarray:
    """The sum of all tasks' sketches; no shingle stands in more documents than its bucket says, up to FULL."""

    def summed(table: pa.Table) -> pa.Table:
        total = np.zeros(CHUNK, np.uint8)
        for data in table.column("counts"):
            part = np.frombuffer(zlib.decompress(data.as_buffer()), np.uint8)
            total = total + np.minimum(part, FULL - total)
        return pa.table({"chunk": table.column("chunk")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros(1 << bits, np.uint8)
    parts = counts.filter("chunk is not null").select("chunk", "counts").groupBy("chunk")
    for r in parts.applyInArrow(summed, "chunk int, counts binary").toLocalIterator():
        out[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(r["counts"], np.uint8)
    return out


def prefix_size(n: int) -> int:
    return n - (NUM * n + DEN - 1) // DEN + 1


def meta_of(docs: DataFrame) -> DataFrame:
    """(key, n, h1, h2): size and 128-bit hash of each document's shingle set."""

    def run(batches):
        for batch in batches:
            rows = [(len(s), mix(s, 1).sum(dtype=np.uint64), mix(s, 2).sum(dtype=np.uint64)) for _, s in sets_of(batch)]
            n, h1, h2 = (np.array(x, t) for x, t in zip(zip(*rows, strict=True), (np.int64, np.uint64, np.uint64), strict=True)) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(n, pa.int64()), pa.array(np.asarray(h1, np.uint64).view(np.int64)),
                 pa.array(np.asarray(h2, np.uint64).view(np.int64))], names=["key", "n", "h1", "h2"])

    return docs.select("key", "text").mapInArrow(lean(run), "key long, n long, h1 long, h2 long")


def prefixes_of(docs: DataFrame, hot: np.ndarray, sketch: Broadcast) -> DataFrame:
    """(key, n, share, token, pos): the first fragment of each document, without shingles known to be its alone.

    Shingles of lower buckets of the sketch come first, ``hot`` ones (rarest
    first) last. ``share`` is the thousandths of the document's shingles that are hot.
    """
    order = np.argsort(hot)
    ranked = hot[order]

    def run(batches):
        counts = sketch.value
        shift = np.uint64(64 - (len(counts).bit_length() - 1))
        for batch in batches:
            keys = batch.column("key").to_numpy()
            key, size, share, token, pos = [], [], [], [], []
            for i, s in sets_of(batch):
                if not len(s):
                    continue
                p = prefix_size(len(s))
                seen = counts[s >> shift]
                is_hot = np.zeros(len(s), bool)
                if len(ranked):
                    at = np.minimum(np.searchsorted(ranked, s), len(ranked) - 1)
                    is_hot = ranked[at] == s
                cold = np.flatnonzero(~is_hot)
                cold = cold[np.argsort(seen[cold], kind="stable")][:p]
                part, at_part = s[cold], np.flatnonzero(seen[cold] > 1)
                if len(part) < p:
                    last = hot[np.sort(order[at[is_hot]])][: p - len(part)]
                    at_part = np.append(at_part, np.arange(len(part), p))
                    part = np.append(part, last)
                token.append(part[at_part])
                share.append(np.full(len(at_part), 1000 * int(is_hot.sum()) // len(s), np.int32))
                pos.append(at_part.astype(np.int32))
                key.append(np.full(len(at_part), keys[i]))
                size.append(np.full(len(at_part), len(s), np.int64))
            if token:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(key), pa.int64()), pa.array(np.concatenate(size)), pa.array(np.concatenate(share)),
                     pa.array(np.concatenate(token).view(np.int64)), pa.array(np.concatenate(pos))],
                    names=["key", "n", "share", "token", "pos"])

    return docs.select("key", "text").mapInArrow(lean(run), "key long, n long, share int, token long, pos int")


def fragments_of(docs: DataFrame) -> DataFrame:
    """(key, n, part, hashes): each document's set, cut at fixed places of the order of hashes."""
    cuts = np.array([(i << 64) // FRAGMENTS for i in range(1, FRAGMENTS)], np.uint64)

    def run(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy()
            rows = []
            for i, s in sets_of(batch):
                at = [0, *np.searchsorted(s, cuts), len(s)]
                rows += [(keys[i], len(s), f, s[at[f] : at[f + 1]].view(np.int64)) for f in range(FRAGMENTS) if at[f + 1] > at[f]]
            if rows:
                key, n, part, hashes = zip(*rows, strict=True)
                offsets = np.concatenate(([0], np.cumsum([len(h) for h in hashes])))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(hashes)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.int64()), pa.array(n, pa.int64()), pa.array(part, pa.int32()), lists],
                    names=["key", "n", "part", "hashes"])

    return docs.select("key", "text").mapInArrow(lean(run), "key long, n long, part int, hashes array<long>")


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) that link: partial overlaps of equal fragments, summed per pair."""
    pairs = cut(pairs, "promising")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    parts = cut(fragments_of(docs.join(sized(ends), "key", "left_semi")), "parts")
    left = parts.select(F.col("key").alias("a"), "part", F.col("hashes").alias("ha"))
    right = parts.select(F.col("key").alias("b"), "part", F.col("hashes").alias("hb"))
    partial = pairs.join(left, "a").join(right, ["b", "part"]).select(
        "a", "b", "na", "nb", F.size(F.array_intersect("ha", "hb")).alias("overlap"))
    summed = partial.groupBy("a", "b", "na", "nb").agg(F.sum("overlap").alias("overlap"))
    return summed.filter(DEN * F.col("overlap") >= NUM * (F.col("na") + F.col("nb") - F.col("overlap"))).select("a", "b")


def promising(pairs: DataFrame, heads: DataFrame) -> DataFrame:
    """Pairs whose overlap can still reach the threshold, given the shared part of their prefixes.

    With c shared prefix shingles the overlap is at most c plus what one of the
    two has behind its prefix.
    """
    left = heads.select(F.col("key").alias("a"), F.col("head").alias("ha"))
    right = heads.select(F.col("key").alias("b"), F.col("head").alias("hb"))
    behind = lambda n: F.ceil(F.lit(NUM) * F.col(n) / DEN) - 1
    bound = F.size(F.array_intersect("ha", "hb")) + F.greatest(behind("na"), behind("nb"))
    need = (NUM + DEN) * bound >= NUM * (F.col("na") + F.col("nb"))
    return pairs.join(left, "a").join(right, "b").filter(need).select("a", "b", "na", "nb")


def meets(x: str, y: str) -> str:
    """SQL: two documents of similar size meet in a block as they need to in one of their blocks.

    The overlap of linked documents is at least 8/9 of the smaller one (the one
    of smaller key, of equals), so among its first shingles up to that share is
    one that the larger one has in its prefix.
    """
    early = "{0}.pos < {0}.n - (8 * {0}.n + 8) div 9 + 1"
    return (f"{DEN} * least({x}.n, {y}.n) >= {NUM} * greatest({x}.n, {y}.n) and "
            f"if({x}.n < {y}.n or ({x}.n = {y}.n and {x}.key < {y}.key), {early.format(x)}, {early.format(y)})")


def pairs_of(rows: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) out of (x, nx, y, ny)."""
    low = F.col("x") < F.col("y")
    return rows.select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"),
        F.when(low, F.col("nx")).otherwise(F.col("ny")).alias("na"),
        F.when(low, F.col("ny")).otherwise(F.col("nx")).alias("nb")).distinct()


def linked(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(node, root): components of more than one class among the documents with ``keys`` (key, n), one for each class.

    A block is the documents that share a prefix shingle. First each is compared
    with its block's leaders, so that a large group of near copies costs one pair
    for each member. Then every pair of a block that is not yet in one component
    is compared: no link that could join two components is left out.
    """
    reps = docs.join(sized(keys), "key", "left_semi")
    shingles = keys.agg(F.sum("n").alias("n")).first()["n"] or 0
    bits = min(max(shingles.bit_length(), SKETCH_BITS[0]), SKETCH_BITS[1])
    counts = cut(counts_of(reps, bits), "counts")
    frequent = counts.filter("token is not null").groupBy("token").agg(F.sum("count").alias("count"))
    top = frequent.filter(F.col("count") >= HOT_DOCS).orderBy(F.desc("count"), "token").limit(HOT_SHINGLES).collect()
    hot = np.array([r["token"] for r in reversed(top)], np.int64).view(np.uint64)
    # prefix shingles of one document alone lead to no other
    sketch = docs.sparkSession.sparkContext.broadcast(sketch_of(counts, bits))
    first = cut(prefixes_of(reps, hot, sketch), "prefixes")
    sketch.destroy()
    shared = cut(first.groupBy("token").count().filter("count > 1").select("token"), "shared")
    posts = cut(first.join(sized(shared), "token").select("token", "key", "n", "pos", "share"), "posts")
    heads = cut(posts.groupBy("key").agg(F.collect_list("token").alias("head")), "heads")
    # leaders: of the most hot shingles, as the text that the others were made from has, and by a hash alike in all blocks
    ends = F.struct("key", "n", "pos")
    order = F.xxhash64("key")
    lead = posts.groupBy("token").agg(
        F.count("*").alias("members"), F.min(F.struct(-F.col("share"), order, ends.alias("end"))).alias("l0"),
        F.min(F.struct(order, ends.alias("end"))).alias("l1"))
    lead = lead.filter("members > 1").select("token", F.explode(F.array_distinct(F.array("l0.end", "l1.end"))).alias("l"))
    lead = lead.select("token", "l.*").alias("v")
    met = posts.alias("u").join(lead, F.expr(f"u.token = v.token and u.key <> v.key and {meets('u', 'v')}"))
    pairs = cut(pairs_of(met.selectExpr("u.key as x", "u.n as nx", "v.key as y", "v.n as ny")), "pairs")
    links = cut(verified(promising(pairs, heads), docs), "links")
    roots = components(links, "near")
    named = posts.join(roots, F.col("key") == F.col("node"), "left").select(
        "token", "key", "n", "pos", F.coalesce("root", "key").alias("root"))
    mixed = named.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("token")
    blocks = cut(named.join(mixed, "token"), "blocks")
    one, two = blocks.alias("u"), blocks.alias("v")
    rows = one.join(two, F.expr(f"u.token = v.token and u.root < v.root and {meets('u', 'v')}"))
    rest = pairs_of(rows.selectExpr("u.key as x", "u.n as nx", "v.key as y", "v.n as ny")).join(pairs, ["a", "b"], "left_anti")
    more = cut(verified(promising(rest, heads), docs), "links")
    return components(links.unionByName(more), "near") if more.limit(1).count() else roots


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, class_id, component_id.

    class_id is the smallest doc_id of the same shingle set, component_id the
    smallest one reachable over links. Texts without words, empty and null texts
    have no shingle and stand alone. Repeated rows are copies of each other; a
    null doc_id takes part, but names no group that has other ids. An empty
    table gives an empty result. Only doc_id and text are read.
    """
    rows = keyed(docs)
    meta = cut(meta_of(rows), "sets")
    same = ["n", "h1", "h2"]
    classes = meta.filter("n > 0").groupBy(*same).agg(F.min("key").alias("rep"))
    classes = cut(classes, "classes")
    roots = linked(rows.select("key", "text"), classes.select(F.col("rep").alias("key"), "n"))
    classes = cut(classes.join(roots, F.col("rep") == F.col("node"), "left").select(
        *same, "rep", F.coalesce("root", "rep").alias("root")), "rooted")
    named = meta.join(classes, same, "left").select(
        "key", "n", F.coalesce("rep", "key").alias("rep"), F.coalesce("root", "key").alias("root"))
    ids = rows.select("key", "doc_id", "copies")
    if "text" in rows.columns:
        named = named.join(ids, "key")
    # the smallest key of a group has its smallest doc_id, nulls apart
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    leader = named.groupBy("rep").agg(F.min("doc_id").alias("class_id"))
    out = named.join(least, "root").join(leader, "rep")
    return restored(out.select(
        "doc_id", F.col("n").alias("n_shingles"), "class_id", "component_id", "copies"))
