"""Packing of tokenised documents into sequences by cutting-stock column generation."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plantlens.llm.common import cut, keyed, lean, sized, worker_memo

CAPACITY = 2048
END = 1
#: Encodings of words kept by a worker, and their greatest length; those met after that are encoded each time.
CACHED_WORDS, CACHED_LENGTH = 600_000, 48
#: Words whose new ones are encoded together.
GROUP_WORDS = 200_000
#: Documents for each bucket that ranks are counted in.
BUCKET_ROWS = 20_000


def size_classes(capacity: int) -> np.ndarray:
    """Upper sizes of the classes of the length histogram: exact while small, then steps of up to 1 in 128."""
    sizes, at = [], 0
    while at < capacity:
        at = min(capacity, at + max(1, at // 128))
        sizes.append(at)
    return np.array(sizes)


def memo_name(path: str) -> str:
    return f"words {path}"


class WordEncoder:
    """Ids of texts, from ids of their words.

    The vocabulary's own splitting ends at white space, and between letters and
    marks. So a word between ASCII white space is encoded on its own, and one of
    Latin letters with marks behind as those two. Frequent ones are kept for all
    tasks of a worker; new ones are encoded many at a time.
    """

    MARKS = b".,!?:;%*#&$|\"'()"
    SUFFIX = "</w>"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; a pool's threads keep memory of their own
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.last = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)  # ids that end a word
        self.last[[i for token, i in vocabulary.items() if token.endswith(self.SUFFIX)]] = True
        self.memo = worker_memo(memo_name(path))  # of words, and of the parts that others consist of

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, runs: list[str]) -> list[bytes]:
        """Runs of letters, joined by blanks: the last id of each is one that ends a word, and no other is."""
        out: list[bytes] = []
        for at in range(0, len(runs), 2000):
            some = runs[at : at + 2000]
            found = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0]
            ids = np.array(found.ids, "<u4")
            cuts = np.flatnonzero(self.last[ids]) + 1
            if len(cuts) == len(some) and cuts[-1] == len(ids):
                data, edges = ids.tobytes(), (4 * np.append(0, cuts)).tolist()
                out += [data[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
            else:
                out += self._each(some)
        return out

    def known(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of the words that the memo lacks, of which it takes up what it has room for."""
        split: dict[bytes, tuple[bytes, bytes]] = {}
        runs, others = {}, []
        for w in words:
            head = w.rstrip(self.MARKS)
            tail = w[len(head) :]
            low = head.decode().lower()
            if head and low.isalpha() and (low.isascii() or max(low) < "\u0250"):
                key = low.encode()
                split[w] = key, tail
                if key not in self.memo:
                    runs[key] = low
                if tail and tail not in self.memo:
                    others.append(tail)
            else:
                others.append(w)
        fresh = dict(zip(runs, self._letters(list(runs.values())), strict=True))
        others = list(dict.fromkeys(others))
        fresh |= dict(zip(others, self._each([w.decode() for w in others]), strict=True))
        new = {}
        for w in words:
            if w in split:
                key, tail = split[w]
                ids = fresh[key] if key in fresh else self.memo[key]
                new[w] = ids + (fresh[tail] if tail in fresh else self.memo[tail]) if tail else ids
            else:
                new[w] = fresh[w]
        for found in (fresh, new):
            for w, ids in found.items():
                if len(self.memo) >= CACHED_WORDS:
                    break
                if len(w) <= CACHED_LENGTH:
                    self.memo[w] = ids
        return new

    def documents(self, texts: list[bytes | None]):
        """The ids of each text and the end mark, as little-endian bytes."""
        end = np.array([END], "<u4").tobytes()
        held: list[list[bytes]] = []
        n = 0
        for i, data in enumerate(texts):
            held.append((data or b"").split())
            n += len(held[-1])
            if n >= GROUP_WORDS or i == len(texts) - 1:
                missing = {w for words in held for w in words if w not in self.memo}
                new = self.known(missing) if missing else {}
                lookup = self.memo.get
                for words in held:
                    yield b"".join([lookup(w) or new.get(w) or b"" for w in words]) + end
                held, n = [], 0


def encoded(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """(key, doc_tokens, pieces): lengths and checksums of each document's pieces.

    A document is cut after each ``capacity`` ids.
    """

    def run(batches):
        words = WordEncoder(tokenizer_path)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64())]))
        for batch in batches:
            total, pieces = [], []
            for ids in words.documents(batch.column("text").cast(pa.binary()).to_pylist()):
                n = len(ids) // 4
                total.append(n)
                pieces.append([{"start": at, "length": min(capacity, n - at), "crc": zlib.crc32(ids[4 * at : 4 * (at + capacity)])} for at in range(0, n, capacity)])
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(total, pa.int64()), pa.array(pieces, kind)], names=["key", "doc_tokens", "pieces"])

    return docs.select("key", "text").mapInArrow(lean(run, memo_name(tokenizer_path)), "key long, doc_tokens long, pieces array<struct<start: long, length: long, crc: long>>")


def best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The fullest-valued pattern by unbounded knapsack over capacities: (value, count of each size)."""
    use = np.flatnonzero(values > 1e-12)
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = use[np.argsort(sizes[use])]
    s, v = sizes[order], values[order]
    fits = np.searchsorted(s, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if k := fits[c]:
            gain = best[c - s[:k]] + v[:k]
            i = int(gain.argmax())
            if gain[i] > best[c]:
                best[c], choice[c] = gain[i], i
    counts, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            counts[order[choice[c]]] += 1
            c -= s[choice[c]]
    return float(best[capacity]), counts


def greedy_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[list[np.ndarray], np.ndarray]:
    """First-fit decreasing on fractions: one pattern for each class, which it uses up, and its share.

    Later patterns leave used-up classes out, so the patterns are a triangular,
    feasible basis.
    """
    left, patterns, share = demand.astype(float), [], []
    by_size = np.argsort(-sizes)
    while len(patterns) < len(sizes):
        room, pattern = capacity, np.zeros(len(sizes), np.int64)
        for i in by_size:
            if left[i] > 0:
                n = min(max(1, int(left[i])), room // sizes[i])
                pattern[i], room = n, room - n * sizes[i]
        held = np.flatnonzero(pattern)
        ratio = left[held] / pattern[held]
        low = int(ratio.argmin())
        n = ratio[low]
        left[held] = np.maximum(left[held] - n * pattern[held], 1e-12)
        left[held[low]] = 0
        patterns.append(pattern)
        share.append(n)
    return patterns, np.array(share)


def cutting_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 250) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used, so that every class's demand is met exactly.

    Revised simplex on the linear program over patterns: its columns are priced
    by the knapsack, starting from first-fit decreasing. The solution is rounded
    down; what is left over, at most one sequence's worth of items for each
    pattern, is packed first-fit decreasing.
    """
    m = len(sizes)
    if not m:
        return []
    patterns, x = greedy_patterns(sizes, demand, capacity)
    inverse = np.linalg.inv(np.array(patterns, float).T)
    last = np.inf
    for turn in range(rounds):
        value, column = best_pattern(sizes, inverse.sum(axis=0), capacity)
        if value <= 1 + 1e-7:
            break
        if turn % 50 == 49:  # little more to win
            if last - x.sum() < 2e-5 * x.sum():
                break
            last = x.sum()
        step = inverse @ column
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        x = np.maximum(x - ratio[out] * step, 0)
        x[out] = ratio[out]
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        patterns[out] = column
    left = demand.astype(np.int64).copy()
    used: list[tuple[np.ndarray, int]] = []
    for i in np.argsort(-x):
        held = patterns[i] > 0
        n = int(min(np.floor(x[i] + 1e-6), (left[held] // patterns[i][held]).min()))
        if n > 0:
            used.append((patterns[i], n))
            left -= n * patterns[i]
    # the rest, largest first, each pattern as often as the rest allows
    while left.any():
        room, pattern = capacity, np.zeros(m, np.int64)
        for i in np.argsort(-sizes):
            n = min(left[i], room // sizes[i])
            pattern[i], room = n, room - n * sizes[i]
        held = pattern > 0
        n = int((left[held] // pattern[held]).min())
        used.append((pattern, n))
        left -= n * pattern
    return used


def ranks(rows: DataFrame, group: str, buckets: int) -> DataFrame:
    """Adds ``rank`` (from 0) within ``group``: counts of hash buckets first, then rows inside a bucket."""
    rows = rows.withColumn("_b", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    counts = rows.groupBy(group, "_b").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy(group).orderBy("_b")) - F.col("_n"))
    inside = Window.partitionBy(group, "_b").orderBy("key")
    return rows.join(before.drop("_n"), [group, "_b"]).withColumn(
        "rank", F.row_number().over(inside) - 1 + F.col("_before")).drop("_b", "_before")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each document's ids end with id 1; null and empty texts have that id alone.
    Whole sequences' worth of ids fill a sequence each; what is left of each
    document is one item of the cutting-stock problem, whose size class is the
    row of a linear program, so nothing but the histogram of the classes comes to
    the driver. Equal rows are documents of their own; an empty table gives no
    piece. Only doc_id and text are read.
    """
    spark: SparkSession = docs.sparkSession
    rows = keyed(docs)
    table = encoded(rows, tokenizer_path, capacity)
    copies = rows.select("key", "doc_id", "copies")
    odd = copies.filter("copies > 1").limit(1).count()
    if odd:
        table = table.join(copies, "key").withColumn("_n", F.explode(F.expr("sequence(1L, copies)")))
        table = table.select(F.xxhash64("key", "_n").alias("key"), "doc_id", "doc_tokens", "pieces")
    elif "text" in docs.columns and rows.filter("doc_id is null or key <> doc_id").limit(1).count():
        table = table.join(copies, "key").select("key", "doc_id", "doc_tokens", "pieces")
    else:
        table = table.withColumn("doc_id", F.col("key"))
    table = cut(table, "encoded")
    classes = size_classes(capacity)
    limits = F.array(*[F.lit(int(c)) for c in classes])
    piece = table.select("key", "doc_id", "doc_tokens", F.explode("pieces").alias("p")).select(
        "key", "doc_id", "doc_tokens", "p.start", "p.length", F.col("p.crc").alias("ids_crc32"))
    full, items = piece.filter(F.col("length") == capacity), piece.filter(F.col("length") < capacity)
    # the smallest class that holds the item, by counting the smaller limits
    steps = spark.createDataFrame([(int(n), int(np.searchsorted(classes, n))) for n in range(1, capacity)], "length long, class int")
    items = items.join(F.broadcast(steps), "length")
    histogram = {r["class"]: r["count"] for r in items.groupBy("class").count().collect()}
    present = np.array(sorted(histogram), np.int64)
    used = cutting_stock(classes[present], np.array([histogram[c] for c in present], np.int64), capacity) if len(present) else []
    slots, sequence, taken = [], 0, dict.fromkeys(present.tolist(), 0)
    for pattern, n in used:
        for i in np.flatnonzero(pattern):
            c, each = int(present[i]), int(pattern[i])
            slots.append((c, taken[c], taken[c] + n * each, sequence, each))
            taken[c] += n * each
        sequence += n
    total = max(1, table.count())
    buckets = max(1, total // BUCKET_ROWS)
    plan = spark.createDataFrame(slots, "slot_class int, low long, high long, first long, each long")
    ranked = ranks(items, "class", buckets)
    placed = ranked.join(F.broadcast(plan), (F.col("class") == F.col("slot_class")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    placed = placed.withColumn("sequence_id", F.col("first") + F.floor((F.col("rank") - F.col("low")) / F.col("each")))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "key", "start")
    placed = placed.withColumn("offset", F.sum("length").over(inside) - F.col("length"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    # whole sequences follow, numbered by bucket and row
    full = full.withColumn("key", F.xxhash64("key", "start")).withColumn("all", F.lit(0))
    full = ranks(full, "all", buckets * 4).withColumn("sequence_id", F.col("rank") + F.lit(sequence)).withColumn("offset", F.lit(0).cast("long"))
    return placed.select(*names).unionByName(full.select(*names))
