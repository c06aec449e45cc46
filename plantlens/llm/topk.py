"""Exact top-k search by inner product over vectors in buckets of similar length."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantlens.llm.common import cut

SCALE = 64
#: Vectors of a bucket, queries of a block, and buckets that one task compares with a block.
BUCKET, BLOCK, SPAN = 2048, 512, 16
#: Coordinates that pruning looks at, and the least local threshold (cosine) for which it pays.
FOCUS, LEAST_COSINE = 4, 0.55


def scaled(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def usable(vector: Column) -> Column:
    """Not null, with components that are all present and finite."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, fine)


def packed(rows: DataFrame, size: int, group: str, kind: type) -> DataFrame:
    """(group, longest, dim, ids, matrix): neighbours in the order of length in groups of up to ``size``.

    Ranges of lengths are spread over tasks; each cuts its own range, so that no
    task holds more than its share of the table. Vectors of other dimensions go
    to groups of their own.
    """

    def run(frames):
        for frame in frames:
            for dim, same in frame.groupby("dim", sort=True):
                same = same.sort_values(["norm", "vec_id"], ascending=[False, True])
                for at in range(0, len(same), size):
                    part = same.iloc[at : at + size]
                    yield pd.DataFrame({
                        "longest": [part.norm.iloc[0]], "dim": [dim], "ids": [part.vec_id.to_numpy(np.int64).tobytes()],
                        "matrix": [np.stack(part.ints.to_list()).astype(kind).tobytes() if dim else b""]})

    groups = rows.select("vec_id", "ints", "norm", F.size("ints").alias("dim")).mapInPandas(
        run, "longest double, dim int, ids binary, matrix binary")
    return groups.withColumn(group, F.monotonically_increasing_id())


def _pruned(query: np.ndarray, q_norm: np.ndarray, least: np.ndarray, bucket: np.ndarray, longest: float) -> np.ndarray:
    """Which rows of the bucket any query of the block may still need.

    A product of at least ``least`` asks for a cosine of least / (|q| longest):
    above 1 the whole bucket is too short for the query (length pruning). For high
    ones each coordinate of a normalised candidate has to lie near the query's own
    (coordinate pruning): (q_f c_f + sqrt((1 - q_f^2)(1 - c_f^2))) bounds it.
    """
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(q_norm * longest > 0, least / (q_norm * longest), np.where(least > 0, np.inf, -np.inf))
    alive = cosine <= 1
    if not alive.any():
        return np.zeros(len(bucket), bool)
    cosine, query, q_norm = cosine[alive], query[alive], q_norm[alive]
    if cosine.min() < LEAST_COSINE:
        return np.ones(len(bucket), bool)
    keep = np.zeros(len(bucket), bool)
    norm = np.sqrt((bucket.astype(float) ** 2).sum(axis=1))
    unit = bucket / np.maximum(norm, 1e-300)[:, None]
    own = query / np.maximum(q_norm, 1e-300)[:, None]
    for i in range(len(own)):
        fine = np.ones(len(bucket), bool)
        for f in np.argsort(-np.abs(own[i]))[:FOCUS]:
            fine &= own[i, f] * unit[:, f] + np.sqrt(np.maximum(0, (1 - own[i, f] ** 2) * (1 - unit[:, f] ** 2))) >= cosine[i] - 1e-9
        keep |= fine
        if keep.all():
            break
    return keep


def _best(ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -score))[:k]
    return ids[order], score[order]


def _compare(q_ids, query, exact: bool, buckets, least: np.ndarray, k: int):
    """The best k of the buckets for each query of a block; thresholds rise from bucket to bucket."""
    wide = np.float64 if exact else object
    q_norm = np.sqrt((query.astype(float) ** 2).sum(axis=1)) * (1 + 1e-12)
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(q_ids)
    least = least.copy()
    for longest, ids, matrix in buckets:
        use = _pruned(query, q_norm, least, matrix, longest)
        if not use.any():
            continue
        ids, part = ids[use], matrix[use]
        score = query.astype(wide) @ part.astype(wide).T
        for i in range(len(q_ids)):
            row = score[i]
            can = (row >= least[i]) & (ids != q_ids[i])
            if can.any():
                found = np.concatenate((best[i][0], ids[can])), np.concatenate((best[i][1], row[can].astype(np.int64)))
                best[i] = _best(*found, k)
                if len(best[i][1]) == k:
                    least[i] = max(least[i], best[i][1][-1])
    return best, least


def top_k(vectors: DataFrame, queries: Column, k: int = 20, scale: int = SCALE, vector: str = "embedding") -> DataFrame:
    """Per query and rank: query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id.

    Scores are exact inner products of floor(scale * x). Each query meets every
    row but those of its own id. Vectors that are null or hold null or non-finite
    components take no part, as candidates or queries, nor do null ids; vectors
    of other dimensions than the query's have no product with it. Equal rows
    are candidates of their own; a query id that stands on several rows has one
    result for each distinct vector it stands for. An empty vector has products of
    0 with empty ones. An empty table gives no row.
    """
    rows = vectors.filter(usable(F.col(vector)) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col(vector), scale).alias("ints"), queries.alias("asks"))
    norm = F.sqrt(F.aggregate("ints", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = cut(rows.withColumn("norm", norm), "vectors")
    n = rows.count()
    names = ["query_id", "rank", "vec_id", "score"]
    if not n:
        return rows.selectExpr("vec_id as query_id", "cast(0 as int) as rank", "vec_id", "vec_id as score").limit(0)
    parts = max(1, n // (4 * BUCKET))
    # large values need whole numbers of any size
    exact = bool(rows.agg(F.max("norm")).first()[0] < 2.0**26)
    kind = np.int32 if exact else np.int64
    buckets = cut(packed(rows.repartitionByRange(parts, F.desc("norm"), "vec_id"), BUCKET, "bucket", kind), "buckets")
    order = Window.partitionBy("dim").orderBy(F.desc("longest"), "bucket")  # one row for each bucket of vectors
    placed = buckets.select("bucket", "dim", (F.row_number().over(order) - 1).alias("place"))
    buckets = cut(buckets.join(placed.select("bucket", "place"), "bucket"), "placed")
    asked = rows.filter("asks")
    blocks = packed(asked.dropDuplicates(["vec_id", "ints"]).repartitionByRange(max(1, parts // 16), F.desc("norm"), "vec_id"), BLOCK, "block", kind)
    blocks = cut(blocks.select("block", F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"), F.col("longest").alias("q_longest")), "blocks")

    def first(frames):
        for frame in frames:
            for r in frame.itertuples():
                q_ids, query = np.frombuffer(r.q_ids, np.int64), np.frombuffer(r.q_matrix, kind).reshape(len(r.q_ids) // 8, r.q_dim)
                ids, matrix = np.frombuffer(r.ids, np.int64), np.frombuffer(r.matrix, kind).reshape(len(r.ids) // 8, r.q_dim)
                _, least = _compare(q_ids, query, exact, [(r.longest, ids, matrix)], np.full(len(q_ids), -np.inf), k)
                yield pd.DataFrame({"block": [r.block], "least": [least.tobytes()], "low": [float(least.min())]})

    # thresholds: the k-th best of the bucket of the longest vectors
    top = blocks.join(buckets.filter("place = 0"), F.col("q_dim") == F.col("dim"))
    least = cut(top.select("block", "q_ids", "q_matrix", "q_dim", "longest", "ids", "matrix").mapInPandas(first, "block long, least binary, low double"), "least")
    spans = buckets.groupBy("dim").agg(F.max("place").alias("last"))
    tasks = blocks.select("block", F.col("q_dim").alias("dim")).join(spans, "dim").withColumn(
        "place", F.explode(F.expr("sequence(0, last)"))).withColumn("span", F.floor(F.col("place") / SPAN))
    # a bucket too short for the least demanding query of a block never moves
    reach = F.col("longest") * F.col("q_longest") * (1 + 1e-9) >= F.col("low")
    tasks = tasks.join(least.select("block", "low"), "block").join(blocks.select("block", "q_longest"), "block").join(
        buckets.select("dim", "place", "longest"), ["dim", "place"]).filter(reach)
    tasks = cut(tasks.select("block", "dim", "place", "span"), "tasks")
    work = tasks.join(buckets, ["dim", "place"]).select(
        F.col("block").alias("b"), F.col("span").alias("s"), F.col("place").alias("at"), "longest", "ids", "matrix")

    def search(key, heads: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        head = heads.iloc[0] if len(heads) else None
        if head is None or not len(found):
            return pd.DataFrame({"query_id": [], "row": [], "vec_id": [], "score": []})
        q_ids = np.frombuffer(head.q_ids, np.int64)
        dim = int(head.q_dim)
        query = np.frombuffer(head.q_matrix, kind).reshape(len(q_ids), dim)
        found = found.sort_values("at")
        buckets = ((r.longest, np.frombuffer(r.ids, np.int64), np.frombuffer(r.matrix, kind).reshape(len(r.ids) // 8, dim)) for r in found.itertuples())
        best, _ = _compare(q_ids, query, exact, buckets, np.frombuffer(head.least, float), k)
        size = [len(b[0]) for b in best]
        return pd.DataFrame({
            "query_id": np.repeat(q_ids, size), "row": np.repeat(np.arange(len(q_ids)), size) + (int(head.block) << 20),
            "vec_id": np.concatenate([b[0] for b in best]), "score": np.concatenate([b[1] for b in best])})

    heads = blocks.join(least, "block").join(tasks.select("block", "span").distinct(), "block")
    partial = heads.groupBy("block", "span").cogroup(work.groupBy("b", "s")).applyInPandas(
        search, "query_id long, row long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return partial.withColumn("rank", rank).filter(F.col("rank") <= k).select(*names)
