"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

Labels belong to documents, insults to words: a document is a bag of units
(words, and runs of single letters), and its toxicity that of its worst unit.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantlens.llm.common import crc_of, lean, thinned, worker_memo

#: Labelled documents that the model is fitted on, in the order of a hash of doc_id.
FIT_TOXIC, FIT_CLEAN = 1200, 2400
#: Labels that those are picked from.
POOL_ROWS = 2_000_000
#: Length of the subsequences that the kernel counts, and the weight of each symbol they span.
LENGTH, DECAY = 3, 0.7
#: The normalised kernel is taken to this power, which is a kernel again and tells near spellings better apart.
POWER = 3
#: Symbols of a unit; longer ones are scored in overlapping pieces.
UNIT, OVERLAP = 16, 8
LANDMARKS = 48
#: Margins that a worker keeps, of pieces and of tokens; those met after that are worked out each time.
CACHED_UNITS = 200_000
#: Tokens whose new ones are worked out together.
GROUP_TOKENS = 100_000
MARGIN_FLOOR = -2.0
MARKS = ".,!?:;%*#&$|\"'()"
_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def codes(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters as numbers, one row for each unit, padded; marks and digits never match and are negative."""
    size = np.array([min(len(u), UNIT) for u in units])
    out = np.full((len(units), max(1, int(size.max(initial=0)))), -1, np.int32)
    for i, u in enumerate(units):
        out[i, : size[i]] = [ord(c) if c.isalpha() else -1 for c in u[:UNIT]]
    return out, size


def _subsequences(equal, rows: int, shape: tuple[int, ...]) -> np.ndarray:
    """Kernel values of pairs: ``equal(i)`` tells where symbol i of the left strings meets those of the right ones.

    A common subsequence of three symbols weighs DECAY to the number of symbols
    it spans in either string. ``one`` and ``two`` hold the sums over its first
    one and two symbols, decayed up to the present place of both strings.
    """
    decay, square = np.float32(DECAY), np.float32(DECAY * DECAY)
    one, two = np.zeros(shape, np.float32), np.zeros(shape, np.float32)
    total = np.zeros(shape[1:], np.float32)
    for i in range(rows):
        hit = equal(i) * square
        total += (hit[1:] * two[:-1]).sum(axis=0)
        grown = hit.copy()
        grown[0] = 0
        grown[1:] *= one[:-1]
        for table, new in ((two, grown), (one, hit)):
            for j in range(1, shape[0]):
                new[j] += decay * new[j - 1]
            table *= decay
            table += new
    return total


def kernel(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Gap-weighted common subsequences of LENGTH symbols, for all pairs of rows."""
    places = np.ascontiguousarray(right.T)[:, None, :]
    return _subsequences(
        lambda i: ((left[:, i][None, :, None] == places) & (left[:, i] >= 0)[None, :, None]).astype(np.float32),
        left.shape[1], (right.shape[1], len(left), len(right)))


def self_kernel_rows(x: np.ndarray) -> np.ndarray:
    """The kernel of each row with itself."""
    places = np.ascontiguousarray(x.T)
    return _subsequences(lambda i: ((x[:, i][None, :] == places) & (x[:, i] >= 0)[None, :]).astype(np.float32), x.shape[1], (x.shape[1], len(x)))


def units_of(token: str) -> list[str]:
    """A token without outer marks, cut into overlapping pieces if it is long."""
    core = token.strip(MARKS)
    if not core.isalpha():
        core = _EDGE.sub("", core)
    if len(core) <= UNIT:
        return [core] if len(core) >= LENGTH else []
    return [core[at : at + UNIT] for at in range(0, len(core) - OVERLAP, UNIT - OVERLAP)]


def tokens_of(text: str) -> list[str]:
    """Lower-cased tokens, and runs of three or more single letters as one token more."""
    tokens = text.lower().split()
    run: list[str] = []
    more = []
    for t in [t if len(t) < 3 else "" for t in tokens] if any(len(t) == 1 for t in tokens) else []:
        if t and sum(map(str.isalpha, t)) == 1:
            run.append(t)
        else:
            if len(run) > 2:
                more += [" ".join(run)]
            run = []
    if len(run) > 2:
        more += [" ".join(run)]
    return tokens + more


def letters_of(x: np.ndarray) -> np.ndarray:
    """The letters of each row as bits."""
    bit = np.left_shift(np.uint64(1), (x % 64).astype(np.uint64))
    return np.bitwise_or.reduce(np.where(x >= 0, bit, np.uint64(0)), axis=1)


@dataclass
class Model:
    landmarks: np.ndarray
    insults: int  # the first landmarks are insults
    norms: np.ndarray
    root: np.ndarray
    weights: np.ndarray
    bias: float
    name: str = ""
    slope: float = 1.0
    offset: float = 0.0

    def features(self, units: list[str]) -> np.ndarray:
        out = np.zeros((len(units), self.root.shape[1]), np.float32)
        order = np.argsort([len(u) for u in units], kind="stable")
        for at in range(0, len(units), 256):
            part = order[at : at + 256]
            x, _ = codes([units[i] for i in part])
            own = np.sqrt(np.maximum(self_kernel_rows(x), 1e-12))
            out[part] = (kernel(x, self.landmarks) / own[:, None] / self.norms) ** POWER @ self.root
        return out

    def margins(self, units: list[str]) -> np.ndarray:
        """Decision values; units that lack letters of every insult (one may lack in long ones) are not compared."""
        out = np.full(len(units), MARGIN_FLOOR)
        if not units:
            return out
        own = letters_of(self.landmarks[: self.insults])
        size = np.bitwise_count(own).astype(int)
        have = letters_of(codes(units)[0])
        use = np.flatnonzero((np.bitwise_count(have[:, None] & own) >= size - (size > 5)).any(axis=1))
        if len(use):
            out[use] = np.maximum(MARGIN_FLOOR, self.features([units[i] for i in use]) @ self.weights + self.bias)
        return out

    def fill(self, tokens: list[str], known: dict[str, float]) -> dict[str, float]:
        """Margins of tokens, each that of its worst piece; ``known`` keeps those of pieces while it has room."""
        pieces = [units_of(t) for t in tokens]
        new = list(dict.fromkeys(u for p in pieces for u in p if u not in known))
        fresh = dict(zip(new, self.margins(new).tolist(), strict=True))
        for u, m in fresh.items():
            if len(known) >= CACHED_UNITS:
                break
            known[u] = m
        return {t: max((fresh[u] if u in fresh else known[u] for u in p), default=MARGIN_FLOOR) for t, p in zip(tokens, pieces, strict=True)}

    def worst(self, text: str | None, known: dict[str, float]) -> float:
        return self.worst_each([text], known, {})[0]

    def worst_each(self, texts: list[str | None], known: dict[str, float], seen: dict[str, float]) -> list[float]:
        """The highest margin of each text's tokens; ``seen`` keeps those of tokens, ``known`` those of pieces.

        New tokens of several texts are worked out together.
        """
        out: list[float] = []
        held: list[set[str]] = []
        n = 0
        for i, text in enumerate(texts):
            held.append(set(tokens_of(text)) if text else set())
            n += len(held[-1])
            if n < GROUP_TOKENS and i < len(texts) - 1:
                continue
            found = self.fill(list({t for tokens in held for t in tokens if t not in seen}), known)
            for tokens in held:
                out.append(max((found[t] if t in found else seen[t] for t in tokens), default=MARGIN_FLOOR))
            if len(seen) < CACHED_UNITS:
                seen.update(found)
            held, n = [], 0
        return out

    def score(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -50, 50))))


def altered(unit: str, rng: np.random.Generator) -> list[str]:
    """Spellings with inserted marks, gaps and doubled letters."""
    marks = "-.*_ "
    out = [" ".join(unit), "-".join(unit), ".".join(unit)]
    for _ in range(8):
        at = rng.integers(1, len(unit))
        out.append(unit[:at] + marks[rng.integers(len(marks))] + unit[at:])
        at = rng.integers(0, len(unit))
        out.append(unit[: at + 1] + unit[at] + unit[at + 1 :])
        out.append(unit[:at] + chr(97 + rng.integers(26)) + unit[at:])
    return out


def heads(bag: set[str]) -> set[str]:
    """The units and their beginnings, since insults also come with varying ends."""
    return bag | {u[:n] for u in bag for n in range(LENGTH + 2, min(len(u), 9))}


def witnesses(toxic: list[set[str]], clean: list[set[str]]) -> list[str]:
    """Units and beginnings of units that are frequent in toxic documents and all but missing elsewhere.

    Near copies count once: documents of one least hash among their long units.
    Of units that begin alike the most frequent counts, of equal ones the longest.
    """
    groups: dict[int, set[str]] = {}
    for d in toxic:
        groups.setdefault(min((zlib.crc32(u.encode()) for u in d if len(u) > 6), default=-1), set()).update(d)
    n = len(groups)
    seen = Counter(u for d in groups.values() for u in heads(d))
    least = max(3, 0.02 * n)
    frequent = {u for u, c in seen.items() if c >= least}
    other = Counter(u for d in clean for u in heads(d) & frequent)
    odds = {u: np.log((seen[u] + 0.5) / (n + 1)) - np.log((other[u] + 0.5) / (len(clean) + 1)) for u in frequent}
    chosen: list[str] = []
    for u in sorted((u for u, o in odds.items() if o > 3.5 and seen[u] > 3 * other[u]), key=lambda u: (-seen[u], -len(u), u)):
        if not any(u.startswith(c) or c.startswith(u) for c in chosen):
            chosen.append(u)
    return chosen[: LANDMARKS // 2]


def support_vectors(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 10.0) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, by Newton steps on the active rows."""
    x1 = np.hstack((x, np.ones((len(x), 1))))
    ridge = np.eye(x1.shape[1])
    ridge[-1, -1] = 1e-3
    w = np.zeros(x1.shape[1])
    for _ in range(30):
        on = y * (x1 @ w) < 1
        a = x1[on] * (cost * weight[on])[:, None]
        new = np.linalg.solve(ridge + a.T @ x1[on], a.T @ y[on])
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w[:-1], float(w[-1])


def fit(texts: list[str], labels: list[int]) -> Model | None:
    """A model of labelled documents; None where they tell nothing apart."""
    rng = np.random.default_rng(5)
    bags = [{u for t in set(tokens_of(s or "")) for u in units_of(t)} for s in texts]
    toxic = [b for b, y in zip(bags, labels, strict=True) if y]
    other = [b for b, y in zip(bags, labels, strict=True) if not y]
    clean = Counter(u for b in other for u in b)
    bad = witnesses(toxic, other)
    if not bad or not clean:
        return None
    common = [u for u, _ in clean.most_common(LANDMARKS - len(bad))]
    marks, _ = codes(bad + common)
    norms = np.sqrt(np.maximum(self_kernel_rows(marks), 1e-12))
    gram = (kernel(marks, marks) / norms[:, None] / norms) ** POWER
    values, vectors = np.linalg.eigh(gram.astype(np.float64))
    keep = values > 1e-6
    root = (vectors[:, keep] / np.sqrt(values[keep])).astype(np.float32)
    model = Model(marks, len(bad), norms.astype(np.float32), root, np.zeros(root.shape[1]), 0.0)
    good = [u for u, _ in sorted(clean.items(), key=lambda x: (-x[1], x[0]))[:12_000]]
    near = (model.features(good) @ root.T[:, : len(bad)]) if len(good) else np.zeros((0, 1))
    hard = [good[i] for i in np.argsort(-near.max(axis=1))[:3000]]
    negatives = list(dict.fromkeys(hard + good[:3000]))
    longer = sorted({u for b in toxic for u in b if u not in clean and u.startswith(tuple(bad)) and u not in bad})[:1000]
    positives = [(u, 1.0) for u in bad] + [(u, 0.5) for u in longer] + [(v, 0.2) for u in bad for v in altered(u, rng)]
    units = [u for u, _ in positives] + negatives
    y = np.array([1.0] * len(positives) + [-1.0] * len(negatives))
    weight = np.array([w for _, w in positives] + [float(clean[u]) for u in negatives])
    weight /= weight[len(positives) :].mean()
    weight[: len(positives)] *= len(negatives) / weight[: len(positives)].sum() / 4
    model.weights, model.bias = support_vectors(model.features(units).astype(np.float64), y, weight)
    # Platt's sigmoid on documents and altered insults
    known: dict[str, float] = {}
    m, t = np.array(model.worst_each(texts, known, {})), np.array(labels, float)
    # toxic documents without an insult tell nothing of margins; altered spellings of the insults do
    told = (t == 0) | (m > 0)
    spelled = model.margins([v for u in bad for v in altered(u, rng)])
    m, t = np.concatenate((m[told], spelled)), np.concatenate((t[told], np.ones(len(spelled))))
    a, b = 1.0, 0.0
    x = np.column_stack((m, np.ones(len(m))))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -50, 50)))
        s = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve(x.T @ (x * s[:, None]) + np.diag([1e-2, 1e-2]), x.T @ (t - p) - 1e-2 * np.array([a, b]))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    model.slope, model.offset, model.name = float(a), float(b), uuid.uuid4().hex
    return model


def fit_on(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model of up to FIT_TOXIC and FIT_CLEAN documents whose crc32(doc_id) mod 5 is not 0."""
    marked = thinned(labels, "doc_id", POOL_ROWS).filter("toxic is not null and doc_id is not null").filter(crc_of("doc_id") % 5 != 0)
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ranked = marked.withColumn("_at", F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")))
    chosen = ranked.filter(F.col("_at") <= F.when(F.col("toxic") == 1, FIT_TOXIC).otherwise(FIT_CLEAN)).filter(F.col("_at") <= max(FIT_TOXIC, FIT_CLEAN))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id", "toxic")), "doc_id").collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["text"] or ""))
    return fit([r["text"] for r in rows], [int(r["toxic"] == 1) for r in rows]) if rows else None


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Null and empty texts score as texts without any unit. Very long texts are
    scored whole. Without a model, as without labels, every score is 0. Equal
    texts score alike. Only doc_id and text are read.
    """

    def run(batches):
        memo = worker_memo("toxicity")
        if model and memo.get("name") != model.name:
            memo.update(name=model.name, units={}, tokens={})
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = [model.score(m) for m in model.worst_each(texts, memo["units"], memo["tokens"])] if model else [0.0] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(found, pa.float64()), pa.array([int(s >= 0.5) for s in found], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(crc_of("doc_id") % 5 == 0, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(lean(run, "toxicity"), "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, fit_on(docs, labels))
