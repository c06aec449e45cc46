"""Trained operators: held-out accuracy, base patterns against their expressions, packing round trip, pages, pipeline."""

import html
import random
import re

import brute
import numpy as np
import pytest

import corpus_pipeline
from plantlens.llm import langid, lstm, packing, pages, pii, queries, toxicity
from plantlens.llm.common import read

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0, 0.5, "x") for i, t, lang in rows], DOCS)


ODD = [(900, None, "en"), (901, "", "en"), (902, "123 !!", None), (903, "word", None), (904, "lang " * 20_000, "en"), (904, "lang " * 20_000, "en"), (None, "null id", "en")]


def test_language(spark):
    docs = read(spark, SMALL, "documents").select(*[f.split()[0] for f in DOCS.split(", ")[:5]])
    out = langid.language_of(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in out) >= 0.9 * len(out)
    models = langid.fit_on(docs)
    found = {r.doc_id: r for r in langid.identify(frame(spark, ODD), models, "doc_id").collect()}
    assert [found[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and all(0 <= r.score <= 1 for r in found.values())
    assert len(found) == 6
    none = langid.language_of(frame(spark, [(1, "some text", None)])).collect()
    assert (none[0].lang_pred, none[0].score) == ("und", 0.0)
    assert langid.language_of(frame(spark, [])).count() == 0


def test_rare_language_is_learned(spark, monkeypatch):
    """A language of a few documents is sampled whole from a table beyond any pool."""
    monkeypatch.setattr(langid, "POOL_ROWS", 40, raising=False)
    rows = [(i, f"plain words {i} here", "en") for i in range(2000)] + [(5000 + i, f"quelques mots {i}", "fr") for i in range(8)]
    found = langid.labelled_sample(frame(spark, rows))
    assert len(found["en"]) == langid.FIT_ROWS and len(found["fr"]) == 8


def test_kneser_ney_sums_to_one():
    models = langid.fit({"a": ["the cat sat on the mat and the hat"] * 3, "b": ["le chat est sur la table et le chapeau"] * 3})
    letters = models.keys[1].astype(np.uint16)
    for context in ("   ", " th", "cat", "zzz"):
        lead = np.array([ord(c) for c in context], np.uint16)
        p = np.exp(np.concatenate([models.log_probs(np.append(lead, c)) for c in letters]).astype(float)).sum(axis=0)
        assert np.allclose(p, 1, atol=0.02)


def test_toxicity(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("tanresoil") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for i in range(400):
        text = [rng.choice(words) for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            text[rng.randrange(40)] = rng.choice(["dumbkopf", "grumpfick", "wazzock"])
        rows.append((i, " ".join(text), "en"))
        labels.append((i, 1, int(bad)))
    docs = frame(spark, rows + ODD)
    marks = spark.createDataFrame(labels + [(None, 1, 1), (901, 0, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit_on(docs, marks)
    out = {(r.doc_id): r for r in toxicity.scored(docs, model).collect()}
    held = [r for i, r in out.items() if i is not None and i < 400 and r.held_out]
    assert held and sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in out.values()) and out[900].score == out[901].score
    gapped = ["some dumb-kopf here", "waz.zock", "g r u m p f i c k", "dumbbkopf"]
    assert all(model.score(model.worst(t, {})) >= 0.5 for t in gapped)
    nothing = toxicity.toxicity(docs, marks.filter("false")).collect()
    assert {r.score for r in nothing} == {0.0}


def test_string_kernel_counts_subsequences():
    def plain(s, t):
        spots = lambda x: [(i, j, k) for i in range(len(x)) for j in range(i + 1, len(x)) for k in range(j + 1, len(x))]
        return sum(
            toxicity.DECAY ** (a[2] - a[0] + 1 + b[2] - b[0] + 1)
            for a in spots(s) for b in spots(t) if all(s[p] == t[q] for p, q in zip(a, b)))

    left, right = ["abcab", "xyz", "banana"], ["acb", "nab", "zyx", "ananas"]
    found = toxicity.kernel(toxicity.codes(left)[0], toxicity.codes(right)[0])
    assert np.allclose(found, [[plain(s, t) for t in right] for s in left], rtol=1e-4)
    assert np.allclose(toxicity.self_kernel_rows(toxicity.codes(left)[0]), [plain(s, s) for s in left], rtol=1e-4)


def test_lstm_gradients():
    rng = np.random.default_rng(0)
    net = lstm.BiLSTM(7, 4, 3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, mask = rng.integers(0, 7, (6, 2)), np.ones((6, 2))
    mask[4:, 1] = 0
    tags, moves, kept = rng.integers(0, 3, (6, 2)), rng.normal(size=(3, 3)), {}
    loss = pii.crf_loss(moves, tags, mask, kept)
    _, grads = net.gradients(x, mask, loss)
    value = lambda: loss(net.emissions(x, mask))[0]
    for name, at in (("xf", (3, 5)), ("hb", (1, 2)), ("out", (4, 1)), ("cf", (3,))):
        old = net.p[name][at]
        net.p[name][at] = old + 1e-3
        up = value()
        net.p[name][at] = old - 1e-3
        down = value()
        net.p[name][at] = old
        assert abs((up - down) / 2e-3 - grads[name][at]) < 2e-3


def test_base_spans():
    rng = random.Random(1)
    parts = ["a.b@c.de", "@", "..", "1.2.3.4", "300.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111111111111112", "+1 (523) 555-1055", "+12", "x", " ", "@a.b@c.d", "é", "0", "-", "1111-", "00001.2.3.4", "+49 30.1234567-"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text)] == brute.spans(text), text


def test_pii_spans(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    model = pii.fit_on(docs)
    odd = frame(spark, [*ODD, (905, "call 310-555-4510 or (310) 555-4510, mail j (at) site (dot) com", "en"), (906, "7" * 30_000, "en"), (907, "a@" * 20_000, "en")])
    rows = {r.doc_id: r for r in pii.detect(odd, model, "doc_id").collect()}
    assert rows[900].spans == rows[901].spans == [] and any(s.added for s in rows[905].spans)
    texts = {i: t for i, t, _ in ODD}
    for i, r in rows.items():
        if i in texts and i is not None:
            assert [(s.kind, s.start, s.end) for s in r.spans if not s.added] == brute.spans(texts[i])
    masked = {r.doc_id: r.text for r in pii.masked(odd.select("doc_id", "text"), model, "doc_id", "text").collect()}
    assert masked[900] is None and masked[903] == "word" and "555" not in masked[905]
    assert pii.detect(frame(spark, []), None, "doc_id").count() == 0


def test_pii_spellings(spark):
    """Each taught spelling is found in prose without digits around, and all that has a span's form is in a region."""
    model = pii.fit_on(read(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text"))
    forms = [(k, v) for k, s in enumerate(("jane.doe@site.com", "10.20.30.40", "4111111111111111", "+1 523 555 1055")) for v in pii.variants(k, s)]
    assert len(forms) == 5 + 3 + 4 + 5
    rows = [(i, f"This was written here and they said that you may write to {v} whenever there is need.", "en") for i, (_, v) in enumerate(forms)]
    rows += [(100, "mail jane.doe [at] site.com", "en"), (101, "jane (at) site.com", "en")]
    found = {r.doc_id: r.spans for r in pii.detect(frame(spark, rows), model, "doc_id").collect()}
    missed = [forms[i][1] for i in range(5) if not any(s.kind == "email" for s in found[i])]
    missed += [forms[i][1] for i in range(5, len(forms)) if not found[i]]
    assert missed == [] and found[100] and found[101]
    for at in ("@", " at ", "(at)", "[ AT ]", "{at}"):
        for dot in (".", " dot ", "(dot)", "[ DOT ]"):
            span = f"{'j' * 50}{at}{'s' * 40}{dot}com"
            text = "word " * 60 + span + " word" * 60
            assert pii.plausible(0, span) and any(a <= 300 and 300 + len(span) <= b for a, b in pii.regions(text))


def test_packing(spark):
    from tokenizers import Tokenizer

    docs = read(spark, SMALL, "documents").select("doc_id", "text").limit(60)
    odd = [(i, t) for i, t, _ in ODD if i is not None] + [(950, "<|endoftext|> it's A.B,c don't ÉCOLE İx ſt 中文 é " * 700)]
    docs = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    out = packing.pack(docs, queries.tokenizer_path()).toPandas()
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    tokenizer.encode_special_tokens = True
    for doc_id, text in {r.doc_id: r.text for r in docs.collect()}.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        own = out[out.doc_id == doc_id].sort_values(["start", "sequence_id"])
        assert set(own.doc_tokens) == {len(ids)} and own.length.sum() % len(ids) == 0
        for r in own.itertuples():
            assert r.ids_crc32 == brute.crc(ids[r.start : r.start + r.length])
    out = out.sort_values(["sequence_id", "offset"])
    assert (out.groupby("sequence_id").length.cumsum() - out.length == out.offset).all()
    assert out.groupby("sequence_id").length.sum().max() <= 2048
    assert packing.pack(docs.limit(0), queries.tokenizer_path()).count() == 0


def test_joined_words_are_encoded_once(monkeypatch):
    """Runs of letters get their ids from one encoding of all, and a task starts no threads of the tokenizer's."""
    import os

    from tokenizers import Tokenizer

    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "true")
    words = packing.WordEncoder(queries.tokenizer_path())
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
    apart = []
    each = words._each
    monkeypatch.setattr(words, "_each", lambda texts: apart.extend(texts) or each(texts))
    rng = random.Random(5)
    runs = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzäéßøñçšž", k=rng.randint(1, 30))) for _ in range(4500)]
    plain = Tokenizer.from_file(queries.tokenizer_path())
    assert words._letters(runs) == [np.array(plain.encode(r, add_special_tokens=False).ids, "<u4").tobytes() for r in runs]
    assert not apart


def test_cutting_stock():
    rng = np.random.default_rng(3)
    lengths = np.minimum(2047, rng.lognormal(6.3, 0.9, 5000).astype(int) + 1)
    sizes = packing.size_classes(2048)
    demand = np.bincount(np.searchsorted(sizes, lengths), minlength=len(sizes))
    present = np.flatnonzero(demand)
    used = packing.cutting_stock(sizes[present], demand[present], 2048)
    assert (sum(p * n for p, n in used) == demand[present]).all()
    assert all((p * sizes[present]).sum() <= 2048 for p, _ in used)
    assert 1 - lengths.sum() / 2048 / sum(n for _, n in used) < 0.02


def test_pages(spark):
    rows = read(spark, SMALL, "pages")
    model = pages.fit_on(rows)
    odd = spark.createDataFrame([(1, None, "u", 1), (2, "", "u", 1), (3, "<article><p>One &amp; two<br>three</p> \n<p>F&ouml;ur</article><nav>x</nav>", None, 1), (3, "<b", "u", 1)], "page_id long, html string, url string, text int")
    found = [(r.page_id, r.n_blocks) for r in pages.extract(odd, model).collect()]
    assert sorted(found) == [(1, 0), (2, 0), (3, 0), (3, 3)]
    assert [b.text for b in pages.blocks_of("<p>One &amp; two<br>three</p> \n<p>F&ouml;ur</article><nav>x</nav>")] == ["One & two three", "Föur", "x"]
    wrong = 0
    for r in pages.extract(rows, model).join(rows.select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub("</?b>", "", p))).split()) for p in re.split(r"</?(?:h1|p)>", article)]
        text = "\n\n".join(p for p in parts if p)
        wrong += r.text != text or r.n_chars != len(text)
    assert wrong <= 1
    assert pages.extract(rows.limit(0), model).count() == 0


def test_pages_read_whole():
    """Outer containers, all words of long blocks, and text behind an empty svg."""
    deep = lambda name: f"<div class='{name}'>" + "<div class='a b c d'>" * 9 + "<p>some words here</p>" + "</div>" * 10
    one, two = (pages.vectors(pages.blocks_of(deep(name))) for name in ("comments", "content"))
    assert (one != two).any()
    many = " ".join(f"c{i}" for i in range(20))
    assert "comments" in pages.blocks_of(f"<div class='{many} comments'><p>x</p></div>")[0].path
    words = ["even", "odd"] * 60
    words[1] = "special"
    one, two = (pages.vectors(pages.blocks_of(f"<p>{' '.join(w)}</p>")) for w in (words, ["even", "odd"] * 60))
    assert (one != two).any()
    assert [b.text for b in pages.blocks_of("<p>a<svg class='i' /> b</p><p>c</p><svg><text>no</text></svg><p>d</p>")] == ["a b", "c", "d"]


def test_pipeline(spark):
    """Each stage against a plain version over the rows it was given."""
    docs = read(spark, SMALL, "documents")
    steps = dict(corpus_pipeline.STAGES)
    told = steps["language"](spark, docs, SMALL)
    first = [(r.doc_id, r.text) for r in told.collect()]
    assert len(first) >= 0.97 * docs.count() and told.columns == docs.columns
    one = steps["near_duplicates"](spark, told, SMALL)
    second = [(r.doc_id, r.text) for r in one.collect()]
    assert sorted(i for i, _ in second) == sorted(i for i, (_, c) in brute.jaccard(first).items() if i == c)
    bench = [(r.item_id, r.text) for r in read(spark, SMALL, "benchmark").collect()]
    clean = steps["decontamination"](spark, one, SMALL)
    want = brute.decontaminated(second, bench)
    third = {r.doc_id: r.text for r in clean.collect()}
    assert sorted(third) == sorted(i for i, r in want.items() if not r[-1])
    private = {r.doc_id: r for r in steps["personal_data"](spark, clean, SMALL).collect()}
    assert sorted(private) == sorted(third)
    assert all(not brute.spans(r.text) and r.n_chars == len(r.text) for r in private.values())
    assert all(private[i].text == t for i, t in third.items() if not re.search("[0-9@]", t))


def test_pipeline_keeps_shared_and_null_ids(spark):
    """Unlinked texts of one doc_id, or of none, stay; a contaminated one goes alone."""
    text = lambda name, n=40: " ".join(f"{name}{i}" for i in range(n))
    near = text("a").replace("a39", "b39")
    item = read(spark, SMALL, "benchmark").filter("length(text) > 200").orderBy("item_id").first().text
    rows = [(7, text("a")), (7, text("c")), (None, text("d")), (None, text("e")), (None, near), (8, near), (None, text("f")), (None, text("f")),
            (9, text("g")), (9, text("g")), (5, ""), (5, ""), (5, text("h")), (6, text("i")), (6, text("i").replace("i39", "j39"))]
    docs = frame(spark, [(i, t, "en") for i, t in rows])
    steps = dict(corpus_pipeline.STAGES)
    out = steps["near_duplicates"](spark, docs, SMALL)
    assert out.columns == docs.columns
    got = sorted((str(r.doc_id), r.text) for r in out.collect())
    want = [(7, text("a")), (7, text("c")), (None, text("d")), (None, text("e")), (None, text("f")), (9, text("g")), (5, ""), (5, text("h"))]
    assert [g for g in got if g[0] != "6"] == sorted((str(i), t) for i, t in want)
    assert len(got) == len(want) + 1
    rows = [(7, item), (7, "clean"), (None, item), (None, "clean too"), (None, None), (8, "other"), (9, item)]
    docs = frame(spark, [(i, t, "en") for i, t in rows])
    clean = steps["decontamination"](spark, docs, SMALL)
    assert clean.columns == docs.columns
    assert sorted(map(str, (tuple(r) for r in clean.select("doc_id", "text").collect()))) == sorted(str((i, t)) for i, t in rows if t != item)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run(spark, name):
    out = queries.QUERIES[name](spark, SMALL)
    assert out.count() > 0 and len(set(out.columns)) == len(out.columns)


def test_workers_forget_memos_of_other_operators():
    """What packing has kept of words goes when the worker takes up a task of another operator."""
    from plantlens.llm.common import lean, worker_memo

    worker_memo("words a")[b"w"] = b"ids"
    assert list(lean(lambda batches: batches, "words a")([1])) == [1]
    assert worker_memo("words a") == {b"w": b"ids"}
    assert list(lean(lambda batches: batches)([1])) == [1]
    assert worker_memo("words a") == {}
