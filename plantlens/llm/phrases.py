"""Phrase collocations: word pairs counted in tiles of frequency-ranked ids, frequent pairs ranked and paired again."""

from __future__ import annotations

from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantlens.llm.common import bounded, cut, lean, numbered_by, sized

#: Side of a tile of the pair matrix; a tile with a count for at least one in 16 cells is dense.
TILE = 1024
DENSE = TILE * TILE // 16
#: Pairs that a task holds before it counts them, and words before it passes their counts on.
PAIRS_HELD, WORDS_HELD = 2_000_000, 300_000
#: Rows of a table of ids that tasks hold at once; a larger one is gone through slice by slice.
WORD_SLICE, PAIR_SLICE = 1_000_000, 4_000_000
#: Codes of a stored row.
ROW_CODES = 1 << 16
#: Rows of a table of phrases that may be broadcast (a few hundred bytes each).
BROADCAST_PHRASES = 200_000
#: Parts that the best of a language are picked in before they meet.
PARTS = 16

#: A-Z in lower case, marks that end a piece as a byte that no text holds, tab as blank.
_BREAK = b"\xff"
_PLAIN = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0a\x0b\x0c\x0d\x09", b"abcdefghijklmnopqrstuvwxyz" + _BREAK * 10 + b" ")


def tokens(text: bytes) -> list[bytes]:
    """The words of a text, with a break between pieces."""
    return text.translate(_PLAIN).replace(_BREAK, b" \xff ").split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n): occurrences of each word in each language; ``docs`` has lang and text, not null."""

    def run(batches):
        held: dict[str, Counter] = {}

        def out():
            for lang, counts in held.items():
                counts.pop(_BREAK, None)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()),
                    pa.array(list(counts.values()), pa.int64())], ["lang", "word", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                held.setdefault(lang, Counter()).update(tokens(text))
                if sum(map(len, held.values())) > WORDS_HELD:
                    yield from out()
        yield from out()

    counts = docs.select("lang", "text").mapInArrow(lean(run), "lang string, word binary, n long")
    return counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def packed_rows(rows: list[np.ndarray]) -> pa.ListArray:
    """Rows of codes; long ones are cut at breaks. Only runs of two codes or more can hold a pair; each ends with one break."""
    out = []
    for codes in rows:
        on = np.concatenate(([False], codes >= 0, [False]))
        valid = on[1:-1] & (on[:-2] | on[2:])
        ended = ~valid & np.concatenate(([False], valid[:-1]))
        codes = np.where(valid, codes, -1)[valid | ended]
        if len(codes) and codes[-1] >= 0:
            codes = np.append(codes, np.int32(-1))
        if len(codes) > ROW_CODES:
            ends = np.flatnonzero(codes < 0) + 1
            cuts = np.unique(ends[np.searchsorted(ends, np.arange(ROW_CODES, len(codes), ROW_CODES))])
            out += [c for c in np.split(codes, cuts) if len(c)]
        elif len(codes):
            out.append(codes)
    return listed(out)


def listed(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)])
    values = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.astype(np.int32), pa.int32()))


def rows_of(column: pa.ListArray) -> list[np.ndarray]:
    flat, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
    return np.split(flat, ends[1:-1] - ends[0]) if len(ends) > 1 else []


def coded_words(docs: DataFrame, vocabulary: DataFrame, n: int) -> DataFrame:
    """(codes): every text as ids of its frequent words, -1 where a piece ends or a rarer word stands.

    The vocabulary (lang, word, id from 0 to n - 1) goes to tasks in slices of
    bounded size; all but the last pass keep the texts beside their codes so far.
    """
    spark, rows = docs.sparkSession, docs.select("lang", "text")
    for low in range(0, n, WORD_SLICE):
        last = low + WORD_SLICE >= n
        part = vocabulary.filter((F.col("id") >= low) & (F.col("id") < low + WORD_SLICE)).select("lang", "word", "id").toArrow()
        ids: dict[str, dict[bytes, int]] = {}
        for lang, word, i in zip(*(c.to_pylist() for c in part.columns)):
            ids.setdefault(lang, {})[word] = i
        known = spark.sparkContext.broadcast(ids)

        def run(batches, known=known, last=last):
            for batch in batches:
                langs, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
                rows = []
                for lang, text in zip(langs, texts):
                    words = tokens(text)
                    words.append(_BREAK)
                    got = map(known.value.get(lang, {}).get, words, repeat(-1))
                    rows.append(np.fromiter(got, np.int32, len(words)))
                if batch.num_columns > 2:
                    rows = [np.maximum(a, b) for a, b in zip(rows, rows_of(batch.column(2)))]
                if last:
                    yield pa.RecordBatch.from_arrays([packed_rows(rows)], ["codes"])
                else:
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), listed(rows)], ["lang", "text", "codes"])

        schema = "codes array<int>" if last else "lang string, text string, codes array<int>"
        rows = cut(rows.mapInArrow(lean(run), schema), "word-codes")
    return rows


def coded_pairs(codes: DataFrame, pairs: DataFrame, m: int, n: int) -> DataFrame:
    """(codes): the id of the pair that starts at each place, -1 where it is not frequent.

    ``pairs``: left, right (ids below m), id from 0 to n - 1; in slices as for words.
    """
    spark, rows = codes.sparkSession, codes
    for low in range(0, n, PAIR_SLICE):
        last = low + PAIR_SLICE >= n
        part = pairs.filter((F.col("id") >= low) & (F.col("id") < low + PAIR_SLICE)).select("left", "right", "id").toArrow()
        left, right, ids = (c.to_numpy() for c in part.columns)
        order = np.argsort(left * m + right)
        known = spark.sparkContext.broadcast(((left * m + right)[order], ids[order].astype(np.int32)))

        def look(codes, known):
            keys, ids = known.value
            out = np.full(len(codes), -1, np.int32)
            at = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0))
            key = codes[at].astype(np.int64) * m + codes[at + 1]
            place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[place] == key
            out[at[hit]] = ids[place[hit]]
            return out

        def run(batches, known=known, last=last):
            for batch in batches:
                held = rows_of(batch.column(0))
                if not held:
                    continue
                every = look(np.concatenate(held), known)  # each row ends with a break
                rows = np.split(every, np.cumsum([len(h) for h in held])[:-1])
                if batch.num_columns > 1:
                    rows = [np.maximum(a, b) for a, b in zip(rows, rows_of(batch.column(1)))]
                if last:
                    yield pa.RecordBatch.from_arrays([packed_rows(rows)], ["codes"])
                else:
                    yield pa.RecordBatch.from_arrays([batch.column(0), listed(rows)], ["codes", "found"])

        rows = cut(rows.mapInArrow(lean(run), "codes array<int>" if last else "codes array<int>, found array<int>"), "pair-codes")
    return rows


def tiled_counts(a: np.ndarray, b: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs (a, b) of ids below m with their counts, tile by tile.

    Ids are ranks, so frequent ids share the first tiles: a well-filled tile is
    counted by direct address, the pairs of all other tiles as sorted coordinates.
    """
    side = -(-m // TILE)
    tile = (a // TILE) * side + b // TILE
    tiles, size = np.unique(tile, return_counts=True)
    out, rest = [], np.ones(len(a), bool)
    for t in tiles[size >= DENSE]:
        here = tile == t
        rest &= ~here
        n = np.bincount(a[here] % TILE * TILE + b[here] % TILE, minlength=TILE * TILE)
        cell = np.flatnonzero(n)
        out.append((t // side * TILE + cell // TILE, t % side * TILE + cell % TILE, n[cell]))
    key, n = np.unique(a[rest] * m + b[rest], return_counts=True)
    out.append((key // m, key % m, n))
    return tuple(np.concatenate(x) for x in zip(*out))


def pair_counts(codes: DataFrame, m: int) -> DataFrame:
    """(left, right, n): occurrences of each two ids that stand side by side."""

    def run(batches):
        held, size = [], 0

        def out():
            every = np.concatenate(held)
            at = np.flatnonzero((every[:-1] >= 0) & (every[1:] >= 0))
            a, b, n = tiled_counts(every[at].astype(np.int64), every[at + 1].astype(np.int64), m)
            held.clear()
            for i in range(0, len(a), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(x[i : i + (1 << 17)]) for x in (a, b, n)], ["left", "right", "n"])

        for batch in batches:
            held.append(batch.column(0).flatten().to_numpy())
            size += len(held[-1])
            if size >= PAIRS_HELD:
                yield from out()
                size = 0
        if held:
            yield from out()

    counts = codes.select("codes").mapInArrow(lean(run), "left long, right long, n long")
    return counts.groupBy("left", "right").agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, least: int, words: int) -> tuple[list[DataFrame], DataFrame]:
    """Tables of phrases of 1, 2, ... words with at least ``least`` occurrences, and (lang, n) of all words.

    A table has id, lang, phrase (array of words), f, left and right (ids in the
    table before it of the phrase without its last and its first word), first
    and last (f of its first and of its last 1, 2, ... words).
    """
    counts = cut(word_counts(docs), "words")
    total = cut(counts.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    ranked = numbered_by(counts.filter(F.col("n") >= least).withColumn("_down", -F.col("n")), [], ["_down", "lang", "word"], "vocabulary", "id")
    level = cut(ranked.select(
        "id", "lang", "word", F.array("word").alias("phrase"), F.col("n").alias("f"), F.array("n").alias("first"), F.array("n").alias("last")), "level-1")
    out, m = [level], level.count()
    codes = coded_words(docs, level, m) if m else None
    while m and len(out) < words:
        pairs = pair_counts(codes, m).filter(F.col("n") >= least).withColumn("_down", -F.col("n"))
        pairs = cut(numbered_by(pairs, [], ["_down", "left", "right"], "pairs", "id"), "pairs")
        n = pairs.count()
        side = sized(level.select("id", "lang", "phrase", "first", "last"), m, BROADCAST_PHRASES)
        f = F.array(F.col("p.n"))
        level = cut(pairs.alias("p").join(side.alias("l"), F.col("p.left") == F.col("l.id")).join(
            side.alias("r"), F.col("p.right") == F.col("r.id")).select(
            "p.id", "l.lang", "p.left", "p.right", F.concat("l.phrase", F.slice("r.phrase", -1, 1)).alias("phrase"),
            F.col("p.n").alias("f"), F.concat("l.first", f).alias("first"), F.concat("r.last", f).alias("last")), f"level-{len(out) + 1}")
        out.append(level)
        if n and len(out) < words:
            codes = coded_pairs(codes, pairs, m, n)
        m = n
    return out, total


def collocations(docs: DataFrame, least: int = 100, words: int = 5, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of each language by the score of their weakest cut: lang, rank, phrase, a, l, r, n, score.

    Phrases have 2 to ``words`` words and at least ``least`` occurrences within
    pieces. A phrase that nearly always stands inside a longer one (its count is
    no smaller) goes; that is seen at the phrases of one word more, whose counts
    lie between. Null text has no words, null lang counts as ``und``; a language
    without such phrases, and an empty table, give no rows. Repeated rows count
    as often as they stand. Ties go by count, then by the phrase's bytes. Sums
    are whole numbers, products have up to 38 digits, beyond which the query
    fails. Only lang and text are read.
    """
    bounded(docs.sparkSession)
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    levels, total = frequent_phrases(rows, least, words)
    found = None
    for k, level in enumerate(levels[1:], 2):
        kept = level
        if k < len(levels):
            longer = levels[k].select(F.explode(F.array("left", "right")).alias("part"), "f")
            longer = longer.groupBy("part").agg(F.max("f").alias("longer"))
            kept = level.join(longer, F.col("id") == F.col("part"), "left").filter("longer is null or longer < f")
        cuts = F.transform(F.sequence(F.lit(1), F.lit(k - 1)), lambda j: F.struct(
            j.alias("k"), F.get("first", j - 1).alias("l"), F.get("last", F.lit(k - 1) - j).alias("r")))
        kept = kept.select("lang", "phrase", F.col("f").alias("a"), cuts.alias("cuts"))
        found = kept if found is None else found.union(kept)
    if found is None:
        found = levels[0].select("lang", "phrase", F.col("f").alias("a"), F.expr(
            "cast(array() as array<struct<k: int, l: bigint, r: bigint>>)").alias("cuts")).limit(0)
    found = found.join(sized(total), "lang")
    scored = found.withColumn("best", F.array_min(F.transform("cuts", lambda x: F.struct(
        score_of(F.col("a"), F.col("n"), x["l"], x["r"]).alias("score"), x["k"].alias("k"), x["l"].alias("l"), x["r"].alias("r")))))
    text = F.array_join(F.transform("phrase", lambda w: w.cast("string")), " ")
    scored = scored.select("lang", text.alias("phrase"), "a", "best.l", "best.r", "n", "best.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    some = scored.withColumn("_part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
    some = some.filter(F.col("rank") <= top).drop("rank", "_part")
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def score_of(a, n, left, right):
    """floor(1000 a n / (l r)) in whole numbers."""
    wide = lambda c: c.cast("decimal(18,0)")
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (wide(a) * wide(n)), wide(left) * wide(right))
