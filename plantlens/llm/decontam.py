"""Benchmark decontamination: a prefix-filtered set join in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import cut, keyed, restored, sized

#: Words are runs of anything but ASCII characters other than letters and digits. A-Z counts as a-z, which comes later.
NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Windows of up to 64 words of text are joined by broadcast up to this many rows.
BROADCAST_WINDOWS = 200_000


def words_of(text: Column) -> Column:
    """Words as they stand in the text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), NO_WORD), "")


def joined(words: Column) -> Column:
    """The words with A-Z lower-cased, joined by a blank, which no word holds."""
    return F.translate(F.array_join(words, " "), UPPER, LOWER)


def item_windows(benchmark: DataFrame, width: int) -> DataFrame:
    """(item_id, window): each run of ``width`` item words; a shorter item is one window."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
    items = items.filter("size(words) > 0 and item_id is not null")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - width + 1))
    return items.select("item_id", "words", F.explode(starts).alias("at")).select(
        "item_id", joined(F.slice("words", F.col("at"), width)).alias("window"))


def hits(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """(key, first, last, item_ids): where a window stands in a document (1-based word positions).

    ``docs`` has key and text. A window in a document shares all its words with
    it, so one word is a necessary prefix: the rarest by its number in all
    documents. Document words that are the rarest of a window give candidates;
    the window's place in the text follows from the word's offset (positional
    bound), it has to fit between first and last word (length bound), and the
    words there have to equal the window (exact check, in the join itself, so
    that candidates are never rows). The candidate search folds case in full,
    the check A-Z alone. ``explode_outer`` keeps Spark from splitting each text
    a second time for an inferred filter.
    """
    windows = item_windows(benchmark, width).groupBy("window").agg(F.collect_set("item_id").alias("item_ids"))
    windows = cut(windows.withColumn("window_id", F.monotonically_increasing_id()), "windows")
    text = docs.select("key", words_of(F.col("text")).alias("words"))
    parts = F.split(F.lower("window"), " ")
    vocabulary = windows.select(F.explode(parts).alias("word")).distinct()
    every = text.select(F.explode_outer("words").alias("word")).select(F.lower("word").alias("word"))
    counts = every.join(sized(vocabulary), "word").groupBy("word").count()
    offsets = windows.select("window_id", F.posexplode(parts).alias("offset", "word")).join(counts, "word", "left")
    rarest = offsets.groupBy("window_id").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "word", "offset")).alias("low"))
    prefix = cut(windows.join(rarest, "window_id").filter("low.n > 0").select(
        F.col("low.word").alias("rare"), F.col("low.offset").alias("offset"), "window", "item_ids",
        F.size(parts).alias("width")), "prefix")
    first = F.col("pos") - F.col("offset")
    place = (F.lower("word") == F.col("rare")) & (first >= 0) & (first + F.col("width") <= F.col("n_words"))
    if prefix.count() <= BROADCAST_WINDOWS:
        at = text.select("key", "words", F.size("words").alias("n_words"), F.posexplode_outer("words").alias("pos", "word"))
        found = at.join(F.broadcast(prefix), place & equal(first)).withColumn("first", first)
    else:
        # words move without their texts; a text then meets its candidates
        at = text.select("key", F.size("words").alias("n_words"), F.posexplode_outer("words").alias("pos", "word"))
        found = at.join(prefix, place).select("key", first.alias("first"), "width", "window", "item_ids")
        found = found.join(text, "key").filter(equal(F.col("first")))
    return found.select("key", (F.col("first") + 1).alias("first"), (F.col("first") + F.col("width")).alias("last"), "item_ids")


def equal(first: Column) -> Column:
    """Whether the words from ``first`` (0-based) on are the window's."""
    return joined(F.slice("words", first + 1, F.col("width"))) == F.col("window")


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, item_ids, contaminated.

    A word inside any occurrence of an item's window is hit. Null and empty
    texts, and texts of no words, have no hit; null items and items of no words
    or of null id have no window; an empty benchmark hits nothing. Repeated rows
    each get their result. Only doc_id and text, item_id and text are read.
    """
    rows = keyed(docs)
    per = hits(rows, benchmark, width).groupBy("key").agg(
        F.array_sort(F.collect_set(F.struct("first", "last"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("item_ids"))
    # spans ascend by first word: each adds what lies beyond the furthest word so far
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))
    covered = F.aggregate("spans", start, lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(s["first"] - 1, acc["reach"]))).cast("int").alias("n"),
        F.greatest(acc["reach"], s["last"]).cast("int").alias("reach")))
    per = cut(per.select("key", covered["n"].alias("n_hit"), "item_ids"), "contaminated")
    count = F.size(words_of(F.col("text")))
    out = rows.select("key", "doc_id", "copies", count.alias("n_words")).join(sized(per), "key", "left")
    hit, items = F.coalesce("n_hit", F.lit(0)), F.coalesce("item_ids", F.expr("cast(array() as array<string>)"))
    return restored(out.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), hit.cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"), items.alias("item_ids"), (hit > 0).alias("contaminated"), "copies"))
