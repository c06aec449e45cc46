"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions that adds to them."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import lean, thinned
from plantlens.llm.lstm import Adam, BiLSTM

#: The kinds in their order, and their patterns.
KINDS = ["email", "ip", "card", "phone"]
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")

#: Documents with a candidate character that the network is fitted on, in the order of a hash of doc_id.
FIT_ROWS = 400
#: Characters of a window, and of its step to the next one.
WINDOW, STEP = 96, 48
#: A span holds a digit, an @, or a written-out at with a dot behind it (see ``plausible``); the rest is outside by constraint.
TRIGGER = re.compile(r"[0-9@]")
DOTS = ["dot", "punkt", "punto", "point"]
DOT_WORD = re.compile(r"[\s(\[{](?:dot|punkt|punto|point)[\s)\]}]", re.I)
#: Written-out forms of an address's @ and dot.
_AT = re.compile(r"@|\s?[\[({]\s?at\s?[\])}]\s?|\sat\s", re.I)
_DOT = re.compile(r"\.|\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s", re.I)
#: The longest address. All of it is read, however far from its at.
LONGEST = 120
#: Written-out forms of an address's @ and dots that the network is taught.
SPELLINGS = [(" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", "."), (" @ ", ".")]
#: Stretches that are read together, and about the most characters of them.
GROUP, GROUP_CHARACTERS = 200, 60_000
HIDDEN, EPOCHS, BATCH = 24, 14, 32
#: Added spans need this mean probability, and each kind its own least form.
CONFIDENCE = 0.9
_SYMBOLS = "abcdefghijklmnopqrstuvwxyz0@._-+()[]{}:/,;=\"'#*!?%&$|<>\n "
_INDEX = {c: i + 1 for i, c in enumerate(_SYMBOLS)}
VOCABULARY = 2 * len(_SYMBOLS) + 3


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost addresses, walking from one @ to the next: linear in the text."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.match(text[start - 1]):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)]
    if not re.search("[0-9]", text):
        return out
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) < 4 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return out


def codes(text: str) -> np.ndarray:
    """Letters (upper case apart), one code for all digits, marks of their own, the rest by class."""
    out = np.empty(len(text), np.int64)
    for i, c in enumerate(text):
        if "0" <= c <= "9":
            out[i] = _INDEX["0"]
        elif c in _INDEX:
            out[i] = _INDEX[c]
        elif "A" <= c <= "Z":
            out[i] = len(_SYMBOLS) + _INDEX[c.lower()]
        else:
            out[i] = VOCABULARY - 1 if c.isalpha() else VOCABULARY - 2 if not c.isspace() else _INDEX[" "]
    return out


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches around candidate characters and written-out addresses, joined where they touch."""
    found = [(m.start() - STEP, m.end() + STEP) for m in TRIGGER.finditer(text)]
    low = text.lower()
    if any(w in low for w in DOTS):
        found += [(m.start() - STEP, m.end() + STEP) for m in DOT_WORD.finditer(text)]
    for m in _AT.finditer(text):
        # an address around this at ends within its greatest length, and has a dot there
        if _DOT.search(text, m.end(), m.start() + LONGEST):
            found.append((m.start() - LONGEST, m.start() + LONGEST + STEP))
    out: list[list[int]] = []
    for a, b in sorted(found):
        a, b = max(0, a), min(len(text), b)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def crf_loss(moves: np.ndarray, tags: np.ndarray, mask: np.ndarray, kept: dict):
    """Negative log likelihood per sequence; leaves the gradient of ``moves`` in ``kept``."""

    def loss(e: np.ndarray):
        steps, b, k = e.shape
        alpha, beta = np.zeros_like(e, np.float64), np.zeros_like(e, np.float64)
        alpha[0] = e[0]
        for t in range(1, steps):
            new = log_sum(alpha[t - 1][:, :, None] + moves, 1) + e[t]
            alpha[t] = np.where(mask[t][:, None] > 0, new, alpha[t - 1])
        for t in range(steps - 2, -1, -1):
            new = log_sum(moves[None] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
            beta[t] = np.where(mask[t + 1][:, None] > 0, new, beta[t + 1])
        z = log_sum(alpha[-1], 1)
        p = np.exp(alpha + beta - z[None, :, None]) * mask[:, :, None]
        one = np.eye(k)[tags] * mask[:, :, None]
        gold = (one * e).sum()
        d_moves = np.zeros_like(moves)
        for t in range(1, steps):
            on = mask[t] > 0
            pair = np.exp(alpha[t - 1][on][:, :, None] + moves + (e[t] + beta[t])[on][:, None, :] - z[on][:, None, None])
            d_moves += pair.sum(axis=0)
            np.add.at(d_moves, (tags[t - 1][on], tags[t][on]), -1)
            gold += moves[tags[t - 1][on], tags[t][on]].sum()
        kept["moves"] = (d_moves / b).astype(np.float32)
        return float((z.sum() - gold) / b), ((p - one) / b).astype(np.float32)

    return loss


@dataclass
class Model:
    net: BiLSTM
    moves: np.ndarray

    def emissions(self, texts: list[str]) -> list[np.ndarray]:
        """Emissions of each text: overlapping windows, each place taken mostly from the window it is most central in."""
        places, total = [], [np.zeros((len(t), self.moves.shape[0])) for t in texts]
        weight = [np.zeros((len(t), 1)) for t in texts]
        coded = [codes(t) for t in texts]
        for i, t in enumerate(texts):
            last = max(0, len(t) - WINDOW)
            places += [(i, a) for a in sorted({*range(0, last, STEP), last})]
        bell = (1 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1]))[:, None] ** 2.0
        for at in range(0, len(places), 256):
            some = places[at : at + 256]
            x, mask = np.zeros((WINDOW, len(some)), np.int64), np.zeros((WINDOW, len(some)), np.float32)
            for j, (i, a) in enumerate(some):
                part = coded[i][a : a + WINDOW]
                x[: len(part), j], mask[: len(part), j] = part, 1
            e = self.net.emissions(x, mask)
            for j, (i, a) in enumerate(some):
                n = min(WINDOW, len(texts[i]) - a)
                total[i][a : a + n] += bell[:n] * e[:n, j]
                weight[i][a : a + n] += bell[:n]
        return [t / np.maximum(w, 1e-9) for t, w in zip(total, weight, strict=True)]

    def decode_each(self, emissions: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The best path over each whole stretch, and each place's probability of its tag."""
        size = np.array([len(e) for e in emissions])
        n, k, steps = len(emissions), self.moves.shape[0], int(size.max())
        e = np.zeros((steps, n, k))
        for j, one in enumerate(emissions):
            e[: len(one), j] = one
        alpha, back = np.zeros((steps, n, k)), np.zeros((steps, n, k), np.int64)
        best = alpha[0] = e[0]
        at, rows = np.arange(k)[None, :], np.arange(n)
        for t in range(1, steps):
            on = (t < size)[:, None]
            score = best[:, :, None] + self.moves
            back[t] = np.where(on, score.argmax(axis=1), at)  # behind its end a stretch keeps its tag
            best = np.where(on, score.max(axis=1) + e[t], best)
            alpha[t] = np.where(on, log_sum(alpha[t - 1][:, :, None] + self.moves, 1) + e[t], alpha[t - 1])
        path, sure = np.zeros((steps, n), np.int64), np.zeros((steps, n))
        path[-1] = best.argmax(axis=1)
        beta, z = np.zeros((n, k)), log_sum(alpha[-1], 1)
        for t in range(steps - 1, -1, -1):
            sure[t] = np.exp(alpha[t, rows, path[t]] + beta[rows, path[t]] - z)
            if t:
                path[t - 1] = back[t, rows, path[t]]
                new = log_sum(self.moves[None] + (e[t] + beta)[:, None, :], 2)
                beta = np.where((t < size)[:, None], new, beta)
        return [(path[:m, j], sure[:m, j]) for j, m in enumerate(size)]

    def added(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        return self.added_each([text], [base])[0]

    def added_each(self, texts: list[str], bases: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
        """Spans of each text by the network that touch no span of the patterns and have the form of their kind.

        Stretches of similar length of all texts are read together.
        """
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        stretches = sorted(((i, a, b) for i, text in enumerate(texts) for a, b in regions(text)), key=lambda s: s[2] - s[1])
        at = 0
        while at < len(stretches):
            part = stretches[at : at + 1]
            for s in stretches[at + 1 : at + GROUP]:
                if (s[2] - s[1]) * (len(part) + 1) > GROUP_CHARACTERS:
                    break
                part.append(s)
            at += len(part)
            found = self.decode_each(self.emissions([texts[i][a:b] for i, a, b in part]))
            for (i, a, _), (path, sure) in zip(part, found, strict=True):
                edge = np.flatnonzero(np.diff(np.concatenate(([0], path, [0]))))
                for s, t in zip(edge[:-1], edge[1:], strict=True):
                    if path[s]:
                        span = trimmed(texts[i], a + int(s), a + int(t))
                        if span and sure[s:t].mean() >= CONFIDENCE and plausible(int(path[s]) - 1, texts[i][span[0] : span[1]]):
                            out[i].append((int(path[s]) - 1, *span))
        return [self._free(sorted(found), base) for found, base in zip(out, bases, strict=True)]

    @staticmethod
    def _free(found: list[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        taken = sorted((s, e) for _, s, e in base)
        starts = np.array([s for s, _ in taken])
        reach = np.maximum.accumulate(np.array([e for _, e in taken])) if taken else np.zeros(0, int)
        free = []
        for kind, s, e in found:
            i = int(np.searchsorted(starts, e)) - 1  # the last that starts before this one ends
            if i < 0 or reach[i] <= s:
                free.append((kind, s, e))
        return free


def trimmed(text: str, start: int, end: int) -> tuple[int, int] | None:
    """Without outer white space and marks; widened to whole runs of digits and letters."""
    while start < end and not (text[start].isalnum() or text[start] in "+("):
        start += 1
    while end > start and not text[end - 1].isalnum():
        end -= 1
    if start >= end:
        return None
    while start > 0 and text[start - 1].isascii() and text[start - 1].isalnum() and text[start].isalnum():
        start -= 1
    while end < len(text) and text[end].isascii() and text[end].isalnum():
        end += 1
    return start, end


def plausible(kind: int, span: str) -> bool:
    digits = re.sub(r"[^0-9]", "", span)
    if kind == 0:
        at = _AT.search(span)
        return bool(at and at.start() and _DOT.search(span, at.end())) and len(span) <= LONGEST
    if kind == 1:
        parts = re.findall(r"[0-9]+", span)
        return len(parts) == 4 and all(int(p) <= 255 for p in parts) and len(digits) < len(span) <= 40
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits) and len(span) <= 40
    return 9 <= len(digits) <= 15 and not re.search(r"[A-Za-z]", span) and len(digits) < len(span) <= 30


def renamed(rng: np.random.Generator) -> str:
    """An address of made-up names, mostly without a digit."""
    name = lambda least, most: "".join("aeiourstnlbcdfghjkmpqvwxyz"[int(rng.integers(10 if rng.random() < 0.6 else 26))] for _ in range(int(rng.integers(least, most))))
    local = name(2, 9) + ["", f"{'._-'[rng.integers(3)]}{name(1, 9)}", str(rng.integers(100))][rng.choice(3, p=[0.35, 0.5, 0.15])]
    domain = name(2, 9) + ["", f"-{name(2, 6)}", f".{name(2, 6)}"][rng.choice(3, p=[0.6, 0.2, 0.2])]
    return f"{local}@{domain}.{['com', 'org', 'net', 'de', 'fr', 'es', 'it', 'io', 'edu', 'info', 'co.uk'][rng.integers(11)]}"


def variants(kind: int, span: str) -> list[str]:
    """All other spellings of a span, as labelled examples."""
    if kind == 0:
        return [span.replace(".", dot).replace("@", at) for at, dot in SPELLINGS]
    if kind == 1:
        return [span.replace(".", dot) for dot in (" . ", "[.]", "(.)")]
    digits = re.sub(r"[^0-9]", "", span)
    if kind == 2:
        return [sep.join(digits[i : i + 4] for i in range(0, len(digits), 4)) for sep in (".", "  ", "_", " - ")]
    body = digits[-10:]
    forms = ["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "({}){}-{}", "00" + digits[:1] + " {} {} {}"]
    return [form.format(body[:3], body[3:6], body[6:]) for form in forms]


def examples(texts: list[str], seed: int = 3) -> list[tuple[str, np.ndarray]]:
    """Labelled windows: pattern matches, their other spellings in place, and stretches without any."""
    rng = np.random.default_rng(seed)
    out = []
    found = sum(len(base_spans(t)) for t in texts)
    rounds = max(2, min(10, 400 // max(1, found)))  # few spans are spelled more often
    for text in texts:
        spans = sorted(base_spans(text), key=lambda s: (s[1], -s[2]))
        tags = np.zeros(len(text), np.int64)
        for kind, s, e in spans:
            if not tags[s:e].any():
                tags[s:e] = kind + 1
        near = regions(text)
        for a, b in near[:6]:
            for at in range(a, max(a + 1, b - STEP), STEP):
                out.append((text[at : at + WINDOW], tags[at : at + WINDOW]))
        for kind, s, e in spans[:4]:
            last = text[s:e], kind
            names = [renamed(rng) if kind == 0 and n % 2 else text[s:e] for n in range(rounds)]
            for other in [text[s:e], *(v for name in names for v in variants(kind, name))]:
                left, right = s, e
                if rng.random() < 0.5:  # at another place, between two words
                    right = text.find(" ", int(rng.integers(len(text))))
                    left = right + 1 if right >= 0 else s
                    right = right if right >= 0 else e
                lead, tail = max(0, left - int(rng.integers(0, 45))), right + int(rng.integers(0, 51))
                tag = np.concatenate((tags[lead:left], np.full(len(other), kind + 1), tags[right:tail]))
                before = text[lead:left]
                if rng.random() < 0.3:  # behind another span, as in lists
                    gap = [" or ", ", ", " and ", "; ", " / ", " "][rng.integers(6)]
                    before = before[-12:] + last[0] + gap
                    tag = np.concatenate((tags[left - len(text[lead:left][-12:]) : left], np.full(len(last[0]), last[1] + 1), np.zeros(len(gap), np.int64), tag[left - lead :]))
                last = other, kind
                out.append(((before + other + text[right:tail])[:WINDOW], tag[:WINDOW]))
    return out


def fit(texts: list[str]) -> Model | None:
    rows = examples(texts)
    if not any(t.any() for _, t in rows):
        return None
    rng = np.random.default_rng(7)
    pick = rng.permutation(len(rows))[:2400]
    rows = [rows[i] for i in pick]
    model = Model(BiLSTM(VOCABULARY, HIDDEN, len(KINDS) + 1), np.zeros((len(KINDS) + 1, len(KINDS) + 1), np.float32))
    adam, x = Adam(0.02), [codes(t) for t, _ in rows]
    for epoch in range(max(3, min(EPOCHS, EPOCHS * 1000 // len(rows)))):
        adam.rate = 0.02 / (1 + epoch / 4)
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            seq, mask = np.zeros((WINDOW, len(some)), np.int64), np.zeros((WINDOW, len(some)), np.float32)
            tags = np.zeros((WINDOW, len(some)), np.int64)
            for j, i in enumerate(some):
                n = len(x[i])
                seq[:n, j], mask[:n, j], tags[:n, j] = x[i], 1, rows[i][1]
            kept: dict[str, np.ndarray] = {}
            _, grads = model.net.gradients(seq, mask, crf_loss(model.moves, tags, mask, kept))
            model.net.p["moves"] = model.moves
            adam.step(model.net.p, grads | kept)
    model.net.p.pop("moves", None)
    return model


def fit_on(docs: DataFrame) -> Model | None:
    """A network of up to FIT_ROWS documents that hold digits or an @ next to other characters."""
    held = thinned(docs, "doc_id", 200 * FIT_ROWS).filter(F.col("text").rlike(r"[0-9]{3}|@")).select("doc_id", "text")
    rows = held.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(FIT_ROWS).collect()
    return fit([r["text"] for r in rows])


SPANS = "spans array<struct<kind: string, start: long, end: long, added: boolean>>"


def detect(docs: DataFrame, model: Model | None, *keep: str) -> DataFrame:
    """Adds ``spans`` (kind, start, end, added), by kind as listed, then start, to the columns named in ``keep``.

    Offsets are code points, ends exclusive. Pattern spans always stay; the
    network adds spans that touch none of them. Null and empty texts have none;
    very long texts are read whole: every stretch that can hold a span by
    ``plausible`` goes through the network in overlapping windows. Without a model, as where no document has a pattern, nothing is
    added. Repeated rows each get their spans.
    """
    fields = [docs.schema[c] for c in keep]

    def run(batches):
        for batch in batches:
            out = []
            texts = [text or "" for text in batch.column("text").to_pylist()]
            bases = [base_spans(text) for text in texts]
            added = model.added_each(texts, bases) if model else [[] for _ in texts]
            for base, more in zip(bases, added, strict=True):
                spans = sorted([(*s, False) for s in base] + [(*s, True) for s in dict.fromkeys(more)])
                out.append([{"kind": KINDS[k], "start": a, "end": b, "added": x} for k, a, b, x in spans])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(out, kind)], names=[*keep, "spans"])

    names = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    return docs.select(*keep, *([] if "text" in keep else ["text"])).mapInArrow(lean(run), names + SPANS)


def joined(spans, base_only: bool):
    """kind:start:end of the spans, comma-joined."""
    own = F.filter(spans, lambda s: ~s["added"]) if base_only else spans
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(docs: DataFrame, model: Model | None, *keep: str) -> DataFrame:
    """``docs`` with each span in text replaced by its kind in angle brackets; of overlapping spans the first counts."""
    at = detect(docs, model, *keep)

    def run(batches):
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                if spans:
                    parts, end = [], 0
                    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
                        if s["start"] >= end:
                            parts += [text[end : s["start"]], f"<{s['kind']}>"]
                            end = s["end"]
                        elif s["end"] > end:
                            end = s["end"]
                    text = "".join([*parts, text[end:]])
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in keep], names=list(keep))

    names = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return at.mapInArrow(lean(run), names)
