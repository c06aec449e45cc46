"""Main text of web pages: a recurrent labeller over the leaf blocks of a page."""

from __future__ import annotations

import html as references
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import thinned
from plantlens.llm.lstm import Adam, BiLSTM

#: Pages that the labeller is fitted on, in the order of a hash of page_id.
FIT_PAGES = 300
HIDDEN, EPOCHS, BATCH = 24, 10, 16
#: Hash places for tags and classes of the path, and for words.
PATH_PLACES, WORD_PLACES = 96, 48
#: Blocks of a stretch that is labelled at once, and its overlap with the next.
STRETCH, LAP = 400, 40

#: Elements that start a block of their own, that hold no text, and that have no end tag.
BLOCKS = set("address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
SILENT = {"script", "style", "noscript", "template", "head", "title", "svg", "iframe", "object", "canvas", "textarea"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that an open paragraph or item ends before.
CLOSES = {"p": BLOCKS - {"body", "html"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "noscript", "template", "svg", "iframe", "object")}
NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

#: Words in names of elements that tell boilerplate and content to the teacher.
NOT_MAIN = "nav menu header footer sidebar side aside ad ads advert banner promo sponsor cookie notice consent popup modal newsletter subscribe signup login form search share social related recommend comment comments reply discussion breadcrumb pagination widget toolbar legal copyright".split()
MAIN = "article main content post entry story text body-text article-body post-content".split()


@dataclass
class Block:
    text: str
    path: list[str]  # words of the elements around it, outermost first
    linked: float  # share of the text inside links
    element: str


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks in page order: runs of text between starts and ends of block elements."""
    out: list[Block] = []
    stack: list[tuple[str, list[str]]] = []
    parts: list[str] = []
    linked = [0, 0]  # characters in links, in all

    def flush() -> None:
        text = " ".join(references.unescape("".join(parts)).split())
        if text:
            path = [w for tag, names in stack for w in (f"<{tag}>", *names)]
            out.append(Block(text, path, linked[0] / max(1, linked[1]), next((t for t, _ in reversed(stack) if t in BLOCKS), "")))
        parts.clear()
        linked[:] = 0, 0

    def say(text: str) -> None:
        if text:
            parts.append(text)
            n = len(text) - text.count(" ")
            linked[1] += n
            if any(t == "a" for t, _ in stack):
                linked[0] += n

    def close(depth: int) -> None:
        if any(t in BLOCKS for t, _ in stack[depth:]):
            flush()
        del stack[depth:]

    page = page or ""
    at = 0
    silent = 0
    while at < len(page):
        m = TAG.search(page, at)
        if not silent:
            say(page[at : m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                say(references.escape(m[0][9:].removesuffix("]]>")))
            continue
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                close(depth)
                silent = sum(t in SILENT for t, _ in stack)
            elif tag in BLOCKS:
                flush()
            continue
        if tag in ("br", "wbr", "img"):
            say(" " if tag == "br" else "")
            continue
        if tag == "svg" and (m[3] or "").rstrip().endswith("/"):
            continue
        if tag in RAW_END:
            end = RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "body" and silent:  # an unclosed head
            del stack[:]
            silent = 0
        if tag in BLOCKS:
            for depth in range(len(stack) - 1, -1, -1):
                held = stack[depth][0]
                if held in CLOSES and tag in CLOSES[held]:
                    close(depth)
                    break
                if held in ("ul", "ol", "dl", "table", "div", "article", "section", "td", "body"):
                    break
            flush()
        if tag not in VOID and not (m[3] or "").rstrip().endswith("/"):
            names = [w for n in NAMES.findall(m[3] or "") for w in re.split(r"[^a-z0-9]+", "".join(n).lower()) if w]
            stack.append((tag, names))
            silent += tag in SILENT
    flush()
    return out


def _place(word: str, places: int) -> int:
    return zlib.crc32(word.encode()) % places


NUMBERS = 10


def vectors(page: list[Block], start: int = 0, n: int | None = None) -> np.ndarray:
    """One row for each of ``n`` blocks: hashed tag path, hashed words, and numbers of its form and place."""
    blocks = page[start : len(page) if n is None else start + n]
    out = np.zeros((len(blocks), PATH_PLACES + WORD_PLACES + NUMBERS), np.float32)
    for i, b in enumerate(blocks):
        for w in b.path:
            out[i, _place(w, PATH_PLACES)] = 1
        words = b.text.lower().split()
        for w in words:
            out[i, PATH_PLACES + _place(w, WORD_PLACES)] += 1
        out[i, PATH_PLACES : PATH_PLACES + WORD_PLACES] /= max(1, len(words))
        ends = sum(map(b.text.count, ".!?"))
        out[i, -NUMBERS:] = (
            np.log1p(len(words)) / 5, b.linked, min(1.0, ends / max(1, len(words)) * 8), b.element == "p", b.element == "li",
            b.element in ("h1", "h2", "h3"), (start + i) / len(page), (len(page) - start - i) / len(page),
            "©" in b.text or "copyright" in b.text.lower(), min(1.0, sum(map(b.text.count, "0123456789")) / max(1, len(b.text)) * 4))
    return out


def taught(block: Block) -> int:
    """The teacher's label of a block: what the nearest telling element around it says."""
    for w in reversed(block.path):
        name = w.strip("<>")
        if name in NOT_MAIN:
            return 0
        if name in MAIN:
            return 1
    return 0


def with_clutter(blocks: list[Block], rng: np.random.Generator) -> list[Block]:
    """A page with more kinds of clutter around and in its article, made of its own words."""
    words = " ".join(b.text for b in blocks).split()[:400] or ["text"]
    some = lambda n: " ".join(words[int(i)] for i in rng.integers(0, len(words), n))
    word = lambda: NOT_MAIN[int(rng.integers(len(NOT_MAIN)))]
    names = [*[(["<div>", word()], ["p", "div", "li"][int(rng.integers(3))]) for _ in range(12)], (["<aside>"], "p"), (["<nav>"], "li"), (["<footer>"], "p"), (["<div>", "sidebar"], "li"), (["<div>", "comments"], "p"), (["<section>", "comment"], "p"), (["<form>"], "div"),
             (["<div>", "cookie", "notice"], "div"), (["<header>"], "div"), (["<div>", "related"], "li"), (["<div>", "advert"], "div"), (["<div>", "share"], "li"),
             (["<div>", "newsletter"], "p"), (["<ul>", "menu"], "li"), (["<div>", "footer"], "p"), (["<div>", "promo", "banner"], "p")]
    wrapped = ["<article>", "<main>"] if rng.random() < 0.5 else ["<div>", ["content", "post", "entry", "story"][rng.integers(4)]]
    base = ["<html>", "<body>"]
    out, inside = [], False
    main = [i for i, b in enumerate(blocks) if taught(b)]
    for i, b in enumerate(blocks):
        if taught(b):
            tail = [w for w in b.path if w in ("<p>", "<h1>", "<h2>", "<b>", "<li>", "<ul>", "<blockquote>")]
            element = b.element
            if rng.random() < 0.2:
                element = ["blockquote", "li", "h2", "h3", "pre", "td", "div"][rng.integers(7)]
                tail = [f"<{element}>"]
            b = Block(b.text, base + wrapped + tail, b.linked, element)
            if rng.random() < 0.12:
                path, element = names[rng.integers(len(names))]
                out.append(Block(some(int(rng.integers(2, 30))), base + wrapped + path + [f"<{element}>"], float(rng.random() < 0.4), element))
            inside = True
        out.append(b)
        if inside and i == main[-1] or i == 0:
            for _ in range(int(rng.integers(0, 4))):
                path, element = names[rng.integers(len(names))]
                for _ in range(int(rng.integers(1, 5))):
                    out.append(Block(some(int(rng.integers(2, 40))), base + path + [f"<{element}>"], float(rng.random() < 0.4), element))
    return out


@dataclass
class Labeller:
    net: BiLSTM

    def main(self, pages: list[list[Block]]) -> list[list[bool]]:
        """Which blocks of each page are main text; long pages are read in overlapping stretches."""
        total, weight = [np.zeros(len(p)) for p in pages], [np.zeros(len(p)) for p in pages]
        places = [(i, at, min(STRETCH, len(p) - at)) for i, p in enumerate(pages) if p for at in range(0, max(1, len(p) - LAP), STRETCH - LAP)]
        places.sort(key=lambda p: p[2])
        for start in range(0, len(places), 64):
            some = places[start : start + 64]
            steps = some[-1][2]
            x, mask = np.zeros((steps, len(some), PATH_PLACES + WORD_PLACES + NUMBERS), np.float32), np.zeros((steps, len(some)), np.float32)
            for j, (i, at, n) in enumerate(some):
                x[:n, j], mask[:n, j] = vectors(pages[i], at, n), 1
            e = self.net.emissions(x, mask)
            for j, (i, at, n) in enumerate(some):
                bell = 1.0 + np.minimum(np.arange(n), np.arange(n)[::-1])
                total[i][at : at + n] += bell * (e[:n, j, 1] - e[:n, j, 0])
                weight[i][at : at + n] += bell
        return [(t > 0).tolist() for t in total]


def fit(pages: list[str]) -> Labeller | None:
    rng = np.random.default_rng(11)
    data = []
    for page in pages:
        blocks = blocks_of(page)
        for version in (blocks, with_clutter(blocks, rng), with_clutter(blocks, rng)) if blocks else ():
            version = version[:STRETCH]
            data.append((vectors(version), np.array([taught(b) for b in version])))
    if not any(y.any() for _, y in data):
        return None
    net = BiLSTM(PATH_PLACES + WORD_PLACES + NUMBERS, HIDDEN, 2)
    adam = Adam(0.01)
    data.sort(key=lambda d: len(d[1]))
    groups = [data[i : i + BATCH] for i in range(0, len(data), BATCH)]
    for epoch in range(EPOCHS):
        adam.rate = 0.01 / (1 + epoch / 3)
        for g in rng.permutation(len(groups)):
            group = groups[g]
            steps = max(len(y) for _, y in group)
            x = np.zeros((steps, len(group), data[0][0].shape[1]), np.float32)
            mask, y = np.zeros((steps, len(group)), np.float32), np.zeros((steps, len(group)), np.int64)
            for j, (v, labels) in enumerate(group):
                x[: len(labels), j], mask[: len(labels), j], y[: len(labels), j] = v, 1, labels

            def loss(e):
                p = np.exp(e - e.max(axis=2, keepdims=True))
                p /= p.sum(axis=2, keepdims=True)
                one = np.eye(2, dtype=np.float32)[y]
                n = mask.sum()
                return float(-(np.log(np.maximum((p * one).sum(axis=2), 1e-9)) * mask).sum() / n), ((p - one) * mask[:, :, None] / n).astype(np.float32)

            _, grads = net.gradients(x, mask, loss)
            adam.step(net.p, grads)
    return Labeller(net)


def fit_on(pages: DataFrame) -> Labeller | None:
    """A labeller of up to FIT_PAGES pages, labelled by a teacher that reads telling element names."""
    rows = thinned(pages, "page_id", 50 * FIT_PAGES).filter("html is not null").select("page_id", "html").orderBy(F.xxhash64("page_id"), "page_id", F.xxhash64("html")).limit(FIT_PAGES).collect()
    return fit([r["html"] for r in rows])


def extract(pages: DataFrame, model: Labeller | None) -> DataFrame:
    """Per page: page_id, url, text (main blocks joined by empty lines), n_chars, n_blocks, n_main.

    Null and empty pages, and pages without a main block, have empty text. White
    space of a block becomes single blanks; nothing else is dropped or cut.
    Without a model, as where no page teaches anything, nothing is extracted.
    Repeated rows each get their text. Only page_id, url and html are read.
    """

    def run(batches):
        for batch in batches:
            out = []
            pages = [blocks_of(page) for page in batch.column("html").to_pylist()]
            for blocks, main in zip(pages, model.main(pages) if model else pages, strict=True):
                kept = [b.text for b, m in zip(blocks, main, strict=True) if m] if model else []
                text = "\n\n".join(kept)
                out.append((text, len(text), len(blocks), len(kept)))
            text, chars, n, kept = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array(chars, pa.int64()), pa.array(n, pa.int64()), pa.array(kept, pa.int64())],
                names=["page_id", "url", "text", "n_chars", "n_blocks", "n_main"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long, n_main long")
