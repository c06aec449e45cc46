"""Merkle manifest, phrase collocations and license scan against brute force."""

import random

import brute
import numpy as np
import pytest

from plantlens.llm import licenses, merkle, phrases

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree long, at long, id long, word string, _row long, score double"
EXTRA = (1, 2, 3, "w", 4, 0.5)  # columns that the operators use inside


def corpus(seed=5, n=2300):
    rng = random.Random(seed)
    say = lambda k: " ".join(rng.choice(["the", "License", "mit", "of", "a", "new", "york", "city", "Él", "b|c"]) for _ in range(k))
    rows = [
        (None, None, None, None, None), (None, "s", None, 3, "x"), (None, "s", None, 3, "x"), (7, "s", "", 2**63 - 1, ""),
        (8, "é", "und", -1, "a\x0bb\tc  d"), (8, "é", "und", -1, "a\x0bb\tc  d"), (8, "é", "en", 5, "new york, new york! new york"),
        (9, "s", "ünd", 1, "New York city " * 3000), (10, None, "alone", None, "the mit license " * 50),
    ]
    rows += [(i, f"s{i % 3}", rng.choice(["en"] * 8 + ["de", None]), i, say(rng.randint(0, 12))) for i in range(100, 100 + n)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


def frame(spark, rows):
    return spark.createDataFrame([r + EXTRA for r in rows], SCHEMA)


def test_manifest(spark, rows):
    out = merkle.manifest(frame(spark, rows)).collect()
    got = [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in out]
    assert sorted(got, key=str) == brute.merkle(rows)
    assert {r.verified for r in out} == {True, False}


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_manifest_of_small_blocks(spark, rows, monkeypatch, broadcast):
    """Several stored levels to climb, by broadcast and by shuffle."""
    monkeypatch.setattr(merkle, "HOP", 3)
    monkeypatch.setattr(merkle, "BROADCAST_NODES", broadcast)
    few = rows[:140]
    got = [tuple(r) for r in merkle.manifest(frame(spark, few)).drop("proof").collect()]
    assert sorted(got, key=str) == brute.merkle(few)


def test_manifest_of_one_and_none(spark):
    one = [(3, "a", "en", 1, "x")]
    assert [tuple(r) for r in merkle.manifest(frame(spark, one)).drop("proof").collect()] == brute.merkle(one)
    assert merkle.manifest(frame(spark, [])).collect() == []


@pytest.mark.parametrize("word_slice, pair_slice", [(10**6, 10**6), (4, 7)])
def test_collocations(spark, rows, monkeypatch, word_slice, pair_slice):
    monkeypatch.setattr(phrases, "WORD_SLICE", word_slice)
    monkeypatch.setattr(phrases, "PAIR_SLICE", pair_slice)
    out = phrases.collocations(frame(spark, rows), least=12).collect()
    got = sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in out)
    assert got == brute.collocations([(r[2], r[4]) for r in rows], 12)
    assert max(len(g[2].split()) for g in got) == 5


def test_collocations_cut_off_and_empty(spark, rows):
    out = phrases.collocations(frame(spark, rows), least=20, top=5).collect()
    got = sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in out)
    assert got == brute.collocations([(r[2], r[4]) for r in rows], 20, top=5)
    assert phrases.collocations(frame(spark, [])).collect() == []
    assert phrases.collocations(frame(spark, rows[:6])).collect() == []


def test_tiles():
    rng = np.random.default_rng(3)
    m = 3 * phrases.TILE + 5
    a = np.concatenate([rng.integers(0, 300, 200_000), rng.integers(0, m, 5000)])
    b = np.concatenate([rng.integers(0, 300, 200_000), rng.integers(0, m, 5000)])
    key, n = np.unique(a * m + b, return_counts=True)
    x, y, got = phrases.tiled_counts(a, b, m)
    assert dict(zip((x * m + y).tolist(), got.tolist())) == dict(zip(key.tolist(), n.tolist()))


def test_long_rows_are_cut_at_breaks():
    codes = np.tile(np.array([1, 2, 3, -1, 4, -1, 5, 6], np.int32), 40_000)
    rows = phrases.rows_of(phrases.packed_rows([codes, np.array([1, -1, 2], np.int32), np.zeros(0, np.int32)]))
    pairs = lambda c: sum((x >= 0) & (y >= 0) for x, y in zip(c[:-1].tolist(), c[1:].tolist()))
    assert max(map(len, rows)) < phrases.ROW_CODES + 10 and len(rows) > 2
    assert sum(map(pairs, rows)) == pairs(codes) and all(r[-1] == -1 for r in rows)


def test_license_places(spark, rows):
    texts = [r[4] for r in rows] + [
        "Apache License, Version 2.0. THE MIT LICENSE; the mit the mit license", "CC-BY-NC 4.0 cc by nc", "tHe Mıt license", "the mit\x00license",
        "the Kit license apache license version 2", "x " * 200_000 + "the MIT License"]
    docs = spark.createDataFrame([(i // 2, t, 1, "k", 2) for i, t in enumerate(texts)], "doc_id long, text string, template int, key string, at int")
    out = licenses.scan(docs).collect()
    want = [brute.license_places(t, licenses.BASE) for t in texts]
    key = lambda x: (x[0], str(x))
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, tuple(r.base_labels)) for r in out]
    assert sorted(got, key=key) == sorted(((
        i // 2, n, len(p), p[0][0] if p else None, p[-1][0] if p else None, tuple(sorted({lab for _, lab in p})))
        for i, (n, p) in enumerate(want)), key=key)
    assert all(0 <= r.score <= 1 and set(r.base_labels) <= set(r.labels) for r in out)
    assert licenses.scan(docs.limit(0)).collect() == []


def test_notices_give_their_labels(spark):
    """Each notice in prose, with two words put in; phrases that must stand are missing from the last."""
    rng = random.Random(1)
    prose = " ".join(rng.choice(["river", "stone", "walks", "of", "the", "any"]) for _ in range(80))
    texts = [f"{prose}\n{notice.replace(' license ', ' big license ', 1).title() if not any('license' in k for k in keys) else notice}\n{prose}"
             for _, notice, keys in licenses.NOTICES]
    texts += [prose, "permission is hereby given free of charge to any person obtaining a copy"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in licenses.scan(docs).collect()}
    for i, (label, *_) in enumerate(licenses.NOTICES):
        assert label in out[i].labels and out[i].score >= 0.5, texts[i]
    for i in (len(texts) - 2, len(texts) - 1):
        assert out[i].labels == [] and out[i].n_base == 0
    assert out[len(texts) - 2].score == 0
