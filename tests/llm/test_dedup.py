"""Substring dedup, n-gram Jaccard join, byte-string dedup, decontamination and top-k against brute force."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from plantlens.llm import debruijn, decontam, jaccard, suffixes, topk

DOCS = "doc_id long, text string, lang string, n long, count long, key long, start long, spans string"


def texts(seed, n=90):
    """Prose with exact and near copies, shared passages, periodic and very long texts, blanks and nulls."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    say = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passage, base = say(60), say(150)
    out = [None, "", "  \n", "one", "A b", "ab " * 700, "x" * 1500, "Zoë " * 30]
    for _ in range(n - len(out)):
        kind = rng.random()
        if kind < 0.2:
            words = base.split()
            for _ in range(rng.randint(0, 6)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            out.append(" ".join(words))
        elif kind < 0.4:
            out.append(f"{say(rng.randint(0, 40))} {passage}\n{say(rng.randint(0, 40))}")
        elif kind < 0.5:
            out.append(rng.choice(out))
        elif kind < 0.55:
            out.append(say(4000))
        else:
            out.append(say(rng.randint(1, 200)).title())
    return list(enumerate(out))


@pytest.fixture(scope="module")
def rows():
    return texts(4)


def frame(spark, rows):
    # columns that operators use inside have to be harmless on the way in
    return spark.createDataFrame([(i, t, "en", 1, 2, 3, 4, "s") for i, t in rows], DOCS)


def test_substring_dedup(spark, rows):
    out = debruijn.without_repeats(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out} == brute.substring_dedup(rows)


def test_jaccard(spark, rows):
    out = jaccard.near_duplicates(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute.jaccard(rows)


def test_jaccard_chain_and_hub(spark):
    """A chain whose ends do not link, and copies that link to their source alone."""
    words = [f"w{i}" for i in range(100)]
    chain = [" ".join(words[i : i + 60]) for i in range(0, 30, 3)]
    hub = ["h%d" % i for i in range(80)]
    copies = [" ".join(hub)] + [" ".join(hub[:i] + [f"n{i}"] + hub[i + 1 :]) for i in range(5, 80, 5)]
    rows = list(enumerate(chain + copies))
    out = jaccard.near_duplicates(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute.jaccard(rows)


def test_byte_dedup(spark, rows):
    out = suffixes.without_repeats(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in out} == brute.byte_dedup(rows)


@pytest.mark.parametrize("limit", [decontam.BROADCAST_WINDOWS, 0])
def test_decontamination(spark, rows, limit, monkeypatch):
    """The broadcast and the shuffled form."""
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", limit)
    items = [(1, rows[20][1]), (2, "one"), (3, None), (4, "!!"), (5, "zoë ZOË, Zoë"), (11, rows[30][1]), (11, rows[40][1]), (None, "a")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontam.contamination(frame(spark, rows), bench).collect()
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, brute.sha(",".join(r.item_ids)), r.contaminated) for r in out}
    assert got == brute.decontaminated(rows, [i for i in items if i[0] is not None])


def test_repeated_and_null_ids(spark):
    text = " ".join(f"w{i % 37}x{i}" for i in range(120))
    rows = [(7, text), (7, text), (7, "other words here"), (None, text), (None, None), (9, text)]
    docs = frame(spark, rows)
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in debruijn.without_repeats(docs).collect())
    assert got == sorted([("7", 120, 120), ("7", 120, 120), ("7", 3, 0), ("None", 120, 0), ("None", 0, 0), ("9", 120, 120)])
    near = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()]
    assert sorted(map(str, near)) == sorted(map(str, [(7, 116, 7), (7, 116, 7), (7, 1, 7), (None, 116, 7), (None, 0, None), (9, 116, 7)]))
    got = [(r.n_bytes > 400, r.n_removed == r.n_bytes) for r in suffixes.without_repeats(docs).collect() if r.n_bytes]
    assert all(long == gone for long, gone in got) and len(got) == 5
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    assert sum(r.contaminated for r in decontam.contamination(docs, bench).collect()) == 4


def test_empty_tables(spark):
    docs = frame(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    assert debruijn.without_repeats(docs).count() == 0
    assert jaccard.near_duplicates(docs).count() == 0
    assert suffixes.without_repeats(docs).count() == 0
    assert decontam.contamination(docs, bench).count() == 0
    out = decontam.contamination(frame(spark, [(1, "a b")]), bench).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in out] == [(2, 0, False)]
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(none, F.lit(True)).count() == 0


def test_top_k(spark):
    rng = random.Random(2)
    good = [(i, [rng.gauss(0, 1) * (1 + i % 7) for _ in range(8)]) for i in range(300)]
    good += [(300 + i, good[i][1]) for i in range(40)]  # ties
    bad = [(1000, None), (1020, [None] * 8), (1040, [float("nan")] * 8), (1060, [float("inf")] + [0.0] * 7), (None, good[0][1])]
    vectors = spark.createDataFrame([(i, v, 1) for i, v in good + bad], "vec_id long, embedding array<double>, norm int")
    out = topk.top_k(vectors, F.col("vec_id") % 20 == 0)
    ints = [(i, [int((64 * x) // 1) for x in v]) for i, v in good]
    want = brute.top_k(ints, {i for i, _ in good if i % 20 == 0})
    assert sorted(tuple(r) for r in out.collect()) == want


def test_top_k_prunes_exactly():
    """Pruned rows of a bucket never hold a score that a query still needs."""
    import numpy as np

    rng = np.random.default_rng(1)
    bucket, query = rng.integers(-90, 90, (500, 6)), rng.integers(-90, 90, (9, 6))
    longest = float(np.sqrt((bucket**2).sum(axis=1)).max())
    q_norm = np.sqrt((query.astype(float) ** 2).sum(axis=1))
    for share in (0.3, 0.7, 0.9, 0.99):
        least = share * q_norm * longest
        keep = topk._pruned(query, q_norm, least, bucket, longest)
        assert not ((bucket[~keep] @ query.T) >= least).any()


def test_top_k_of_empty_other_and_repeated_vectors(spark):
    """Empty vectors have products of 0 with each other, other dimensions none; a repeated row is a candidate of its own."""
    rows = [(100, []), (101, []), (120, []), (140, [1.0, 2.0]), (141, [3.0, 1.0]), (160, [1.0] * 5), (141, [3.0, 1.0])]
    rows += [(200 + i, [100.0 / (i + 1), 0.5]) for i in range(60)]  # lengths that prune
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(vectors, F.col("vec_id") % 20 == 0).collect())
    ints = [(i, [int((64 * x) // 1) for x in v]) for i, v in rows]
    want = []
    for q, v in sorted({(i, tuple(v)) for i, v in ints if i % 20 == 0}):
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ints if i != q and len(w) == len(v))[:20]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert out == sorted(want)


def test_jaccard_blocks_hold_rare_shingles(spark, monkeypatch):
    """Documents that share common shingles without linking do not meet: pairs grow with the links."""
    line = ["c%d" % i for i in range(12)]
    rows = [(i, " ".join([f"u{i}x{k}" for k in range(30)] + line)) for i in range(10)]  # each shares 8 of 38 shingles
    rows += [(100 + i, rows[i][1].replace(f"u{i}x0 ", f"v{i} ")) for i in range(3)]
    sizes, plain = {}, jaccard.cut

    def counted(df, name):
        out = plain(df, name)
        sizes.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard, "cut", counted)
    out = jaccard.near_duplicates(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute.jaccard(rows)
    assert sizes["pairs"] == [3]


def test_jaccard_order_loses_no_link(spark, rows, monkeypatch):
    """Full buckets, in which no shingle is told from another."""
    monkeypatch.setattr(jaccard, "FULL", 2)
    monkeypatch.setattr(jaccard, "HOT_DOCS", 3)
    out = jaccard.near_duplicates(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute.jaccard(rows)
