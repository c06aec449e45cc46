"""Language identification by interpolated Kneser-Ney character models."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantlens.llm.common import crc_of, lean

#: Labelled documents of each language that the models are fitted on, in the order of a hash of doc_id.
FIT_ROWS = 500
ORDER = 4
DISCOUNT = 0.75
#: Characters scored at once.
SLAB = 1 << 20
#: A document is rejected if its cross-entropy passes the highest one of the calibration documents times this.
SLACK = 1.6
#: Documents of fewer letters are not rejected by their cross-entropy.
MIN_LETTERS = 100
UNDETERMINED = "und"


_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """For each code unit below 65536: the lower-cased letter, or a blank; 65535 stands for letters above."""
    if _FOLD:
        return _FOLD[0]
    fold = np.full(65536, 32, np.uint16)
    for c in range(65536):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            fold[c] = ord(low) if len(low) == 1 and ord(low) < 65536 else c
    _FOLD.append(fold)
    return fold


def symbols(text: str) -> np.ndarray:
    """Lower-cased letters, with one blank for anything between them, and one at either end."""
    code = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    high = code > 65535
    out = _fold()[np.where(high, 32, code)]
    if high.any():
        at = np.flatnonzero(high)
        out[at] = np.where([chr(c).isalpha() for c in code[at]], 65535, 32)
    out = np.concatenate((np.array([32], np.uint16), out, np.array([32], np.uint16)))
    blank = out == 32
    return out[np.concatenate(([True], ~(blank[1:] & blank[:-1])))]


def grams(s: np.ndarray, n: int) -> np.ndarray:
    """Keys of the n-grams that end at each symbol from the ORDER-th on: 16 bits for each symbol."""
    key = np.zeros(max(0, len(s) - ORDER + 1), np.uint64)
    for j in range(n):
        at = ORDER - n + j
        key = (key << np.uint64(16)) | s[at : at + len(key)].astype(np.uint64)
    return key


def padded(text: str) -> np.ndarray:
    return np.concatenate((np.full(ORDER - 1, 32, np.uint16), symbols(text)))


@dataclass
class Models:
    """Sorted keys with one column for each language.

    ``log_p[n]`` belongs to ``keys[n]``: log probabilities of the n-grams seen in
    any language. ``log_back[n]`` belongs to ``contexts[n]``: log weights of
    falling back from order n, zero where a language has not seen the context.
    """

    langs: list[str]
    keys: dict[int, np.ndarray] = field(default_factory=dict)
    log_p: dict[int, np.ndarray] = field(default_factory=dict)
    contexts: dict[int, np.ndarray] = field(default_factory=dict)
    log_back: dict[int, np.ndarray] = field(default_factory=dict)
    unseen: float = np.log(1e-6)
    limits: np.ndarray | None = None

    def _find(self, table: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(table):
            return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        at = np.minimum(np.searchsorted(table, key), len(table) - 1)
        return at, table[at] == key

    def log_probs(self, s: np.ndarray, n: int = ORDER) -> np.ndarray:
        """(symbols, languages) of a padded run."""
        return self._log_probs(grams(s, ORDER), n)

    def _log_probs(self, key: np.ndarray, n: int) -> np.ndarray:
        mask = np.uint64((1 << (16 * n)) - 1) if n < 4 else np.uint64(0xFFFFFFFFFFFFFFFF)
        key = key & mask
        at, seen = self._find(self.keys[n], key)
        out = self.log_p[n][at] if len(self.keys[n]) else np.full((len(key), len(self.langs)), self.unseen, np.float32)
        if not seen.all():
            rest = np.flatnonzero(~seen)
            if n == 1:
                out[rest] = self.unseen
            else:
                low = self._log_probs(key[rest], n - 1)
                c_at, c_seen = self._find(self.contexts[n], key[rest] >> np.uint64(16))
                low[c_seen] += self.log_back[n][c_at[c_seen]]
                out[rest] = low
        return out

    def entropies(self, text: str) -> tuple[np.ndarray, int]:
        """Nats for each symbol under each language, and the number of letters."""
        s = padded(text)
        letters = int((s != 32).sum())
        if not letters:
            return np.zeros(len(self.langs)), 0
        total = np.zeros(len(self.langs))
        n = len(s) - ORDER + 1
        for at in range(0, n, SLAB):
            total += self.log_probs(s[at : at + SLAB + ORDER - 1]).sum(axis=0, dtype=np.float64)
        return -total / n, letters


def fit(texts: dict[str, list[str]]) -> Models:
    """Interpolated Kneser-Ney models; every fifth document calibrates the rejection instead."""
    langs = sorted(texts)
    models = Models(langs, limits=np.full(len(langs), np.inf))
    if not langs:
        return models
    counts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for lang in langs:
        own = [t for i, t in enumerate(texts[lang]) if i % 5 != 4 or len(texts[lang]) < 5]
        runs = [padded(t) for t in own]
        top = np.unique(np.concatenate([grams(s, ORDER) for s in runs]), return_counts=True)
        for n in range(ORDER, 0, -1):
            counts.setdefault(n, []).append(top)
            # continuation counts: how many different symbols stand before a shorter gram
            if n > 1:
                top = np.unique(top[0] & np.uint64((1 << (16 * (n - 1))) - 1), return_counts=True)
    for n in range(1, ORDER + 1):
        models.keys[n] = np.unique(np.concatenate([k for k, _ in counts[n]]))
        models.log_p[n] = np.zeros((len(models.keys[n]), len(langs)), np.float32)
        context = lambda k: k >> np.uint64(16)
        if n > 1:
            models.contexts[n] = np.unique(context(models.keys[n]))
            models.log_back[n] = np.zeros((len(models.contexts[n]), len(langs)), np.float32)
        for j, (k, c) in enumerate(counts[n]):
            mine = np.searchsorted(models.keys[n], k)
            if n == 1:
                p = np.full(len(models.keys[1]), np.exp(models.unseen))
                p[mine] = np.maximum(c / c.sum(), np.exp(models.unseen))
            else:
                heads, at = np.unique(context(k), return_inverse=True)
                total = np.bincount(at, c)
                back = np.zeros(len(models.contexts[n]))
                where = np.searchsorted(models.contexts[n], heads)
                back[where] = np.log(DISCOUNT * np.bincount(at) / total)
                models.log_back[n][:, j] = back
                low = models._log_probs(models.keys[n], n - 1)[:, j].astype(np.float64)
                p = np.exp(low + back[np.searchsorted(models.contexts[n], context(models.keys[n]))])
                p[mine] += (c - DISCOUNT) / total[at]
            models.log_p[n][:, j] = np.log(p)
    for j, lang in enumerate(langs):
        found = [models.entropies(t) for t in texts[lang][4::5]]
        found = [h[j] for h, letters in found if letters >= MIN_LETTERS]
        if found:
            models.limits[j] = SLACK * max(found)
    return models


def labelled_sample(docs: DataFrame, rows: int = FIT_ROWS) -> dict[str, list[str]]:
    """Up to ``rows`` texts of each language, the ids picked before any text is read.

    All rows take part, so rare languages are learned on tables of any size;
    each task passes on at most ``rows`` ids of a language.
    """
    ranked = docs.filter("lang is not null and text is not null").withColumn(
        "_at", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")))
    chosen = ranked.filter(F.col("_at") <= rows).select("doc_id").distinct()
    texts = docs.filter("lang is not null and text is not null").select("doc_id", "lang", "text").join(F.broadcast(chosen), "doc_id")
    out: dict[str, list[str]] = {}
    for r in sorted(texts.collect(), key=lambda r: (r["lang"], str(r["doc_id"]), r["text"])):
        out.setdefault(r["lang"], []).append(r["text"])
    return {k: v for k, v in out.items() if any(len(symbols(t)) > 1 for t in v)}


def identify(docs: DataFrame, models: Models, *keep: str) -> DataFrame:
    """Adds lang_pred, score, cross_entropy and rejected to doc_id, text's other named columns.

    lang_pred is ``und`` (score 0, rejected) for null texts, texts without a
    letter, and where no language was learned. rejected also marks texts of a
    cross-entropy beyond the calibrated limit of their language. Very long texts
    are scored in slabs, whole. Equal rows give equal results; equal entropies go
    to the first language by name.
    """
    fields = [docs.schema[c] for c in keep]

    def run(batches):
        for batch in batches:
            lang, score, entropy, rejected = [], [], [], []
            for text in batch.column("text").to_pylist():
                h, letters = models.entropies(text) if text and models.langs else (np.zeros(0), 0)
                if not letters:
                    lang.append(UNDETERMINED), score.append(0.0), entropy.append(None), rejected.append(True)
                    continue
                best = int(h.argmin())
                lang.append(models.langs[best])
                score.append(float(1 / np.exp((h[best] - h) * min(letters, 100)).sum()))
                entropy.append(float(h[best]))
                rejected.append(bool(letters >= MIN_LETTERS and h[best] > models.limits[best]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(entropy, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[*keep, "lang_pred", "score", "cross_entropy", "rejected"])

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    rows = docs.select(*keep, *([] if "text" in keep else ["text"]))
    return rows.mapInArrow(lean(run), f"{names}, lang_pred string, score double, cross_entropy double, rejected boolean")


def fit_on(docs: DataFrame) -> Models:
    """Models of the documents with a language whose crc32(doc_id) mod 4 is not 2."""
    return fit(labelled_sample(docs.filter(F.coalesce(crc_of("doc_id") % 4 != 2, F.lit(True)))))


def language_of(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, cross_entropy, rejected."""
    held = docs.select("doc_id", "text", F.coalesce(crc_of("doc_id") % 4 == 2, F.lit(False)).alias("held_out"))
    return identify(held, fit_on(docs), "doc_id", "held_out")
