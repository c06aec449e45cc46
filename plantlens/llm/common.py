"""Helpers that the corpus operators share."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plantlens.session import work_dir

#: Rows of an id-sized table that may be broadcast (8 to 16 bytes each on the wire).
BROADCAST_ROWS = 4_000_000


#: Rows that a Python worker gets at once: whole texts, so that few bound its memory.
BATCH_ROWS = 1000


def bounded(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut that survives lost executors."""
    spark = df.sparkSession
    path = work_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized(small: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``small`` marked for broadcast if it has at most ``limit`` rows, else as it is.

    Beyond the limit Spark shuffles both sides, and splits hot keys at run time.
    """
    n = small.count() if rows is None else rows
    return F.broadcast(small) if n <= limit else small


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """(key, doc_id, text, copies): documents under a unique key in the order of (doc_id, text).

    Where doc_id is unique and not null, which one narrow aggregate over the ids
    finds out, it is the key itself and no text moves. Otherwise equal rows
    collapse into one with a number of ``copies``, and a sorted, written table
    gives the keys; null ids come first.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    odd = plain.groupBy("doc_id").count().filter("count > 1 or doc_id is null").limit(1).count()
    if not odd:
        return plain.select(F.col("doc_id").alias("key"), "doc_id", "text", F.lit(1).cast("long").alias("copies"))
    rows = plain.groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
    rows = rows.orderBy(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    return cut(rows.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text", "copies"), "keyed")


def restored(rows: DataFrame) -> DataFrame:
    """One row for each of the ``copies`` that ``keyed`` collapsed."""
    return rows.withColumn("_n", F.explode(F.expr("sequence(1L, copies)"))).drop("_n", "copies")


def thinned(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows of a larger table, by a hash of ``key``: where samples for fitting are picked from."""
    n = df.count()
    if n <= rows:
        return df
    return df.filter(F.xxhash64(key) < F.lit(int(2**64 * (rows / n)) - 2**63))


def crc_of(col: str) -> Column:
    return F.crc32(F.col(col).cast("string").cast("binary"))


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has a link (a, b).

    Alternates hooking larger roots under smaller ones with pointer jumping over
    written tables, so a chain of length n takes about log n rounds; each round
    is a join on the node, and hubs combine before the shuffle.
    """
    edges = cut(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), f"{name}-edges")
    label = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    label = cut(label.select("node", F.least("node", "low").alias("root")), f"{name}-root")
    while True:
        # jump: the root of my root; hook: the lowest root among neighbours, told to my root as well
        jumped = label.alias("x").join(label.alias("y"), F.col("x.root") == F.col("y.node")).select(
            F.col("x.node").alias("node"), F.col("x.root").alias("was"), F.col("y.root").alias("root"))
        near = edges.join(label, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near"))
        seen = cut(jumped.join(near, F.col("node") == F.col("a")).select(
            "node", "was", F.least("root", "near").alias("root")), f"{name}-seen")
        told = seen.groupBy(F.col("was").alias("node")).agg(F.min("root").alias("told"))
        label = cut(seen.join(told, "node", "left").select(
            "node", "was", F.least("root", F.coalesce("told", "root")).alias("root")), f"{name}-root")
        if not label.filter("root <> was").limit(1).count():
            return label.select("node", "root")
        label = label.select("node", "root")


def lean(run, memo: str | None = None):
    """``run`` over a task's batches; what it held goes back to the system at its end.

    Workers live on for later tasks, of other operators too, and would keep it. Only
    ``memo`` stays: a task of another operator drops it.
    """

    def wrapped(batches):
        import ctypes
        import gc

        import pyarrow as pa

        forget(memo)
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return wrapped


def memos() -> dict[str, dict]:
    home = sys.modules.setdefault("_plantlens_memo", types.ModuleType("_plantlens_memo"))
    return vars(home).setdefault("memos", {})


def worker_memo(name: str) -> dict:
    """A dict that lives in the Python process of a worker over all its tasks, until one of another operator comes."""
    return memos().setdefault(name, {})


def forget(but: str | None) -> None:
    """Drops the memos that other operators have left in this worker."""
    for name in [n for n in memos() if n != but]:
        del memos()[name]


def numbered_by(df: DataFrame, group: list[str], order: list[str], name: str, at: str = "at") -> DataFrame:
    """``df`` with ``at``: the place of each row from 0 in its ``group`` by ``order``, nulls first.

    A range-partitioned, written sort; counts of (group, range) and their sums
    over ranges give the offsets, so a group of any size is spread over tasks.
    """
    spread = [*group, *order]
    rows = df.repartitionByRange(*spread).sortWithinPartitions(*spread)
    rows = cut(rows.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), name)
    counts = rows.groupBy(*group, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut(counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))), f"{name}-counts")
    same = F.col("r._part") == F.col("c._part")
    for g in group:
        same &= F.col(f"r.{g}").eqNullSafe(F.col(f"c.{g}"))
    place = F.col("_at") - F.col("_first") + F.col("_before")
    return rows.alias("r").join(sized(counts).alias("c"), same).select(*(F.col(f"r.{c}") for c in df.columns), place.alias(at))
