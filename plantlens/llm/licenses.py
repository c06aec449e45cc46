"""License scan: a positional index of rare license words, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plantlens.llm.common import cut, sized
from plantlens.llm.decontam import LOWER, UPPER, words_of

#: A template is indexed by so many of its rarest words.
RARE = 6
#: Words of a template may be so many places nearer or farther than they stand in it.
SLACK = 16
#: A place counts for the score from this share of the template's weight on.
SHARE = 0.5

# fixed values: phrases whose places are reported (label, phrase)
BASE = [
    ("mit", "the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
# fixed values: notices by their usual words (label, notice, phrases of it that have to stand in the text)
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction",
     ["permission is hereby granted free of charge", "deal in the software without restriction"]),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
     ["you may not use this file except in compliance with the license"]),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("gpl-3", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
     "software foundation either version 3 of the license or at your option any later version",
     ["gnu general public license as published by", "either version 3 of the license"]),
    ("gpl-2", "this work is licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl-2", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
     "software foundation either version 2 of the license or at your option any later version",
     ["gnu general public license as published by", "either version 2 of the license"]),
    ("lgpl", "under the terms of the gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl-3", "under the terms of the gnu affero general public license version 3", ["gnu affero general public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
     "conditions are met", ["redistribution and use in source and binary forms", "provided that the following conditions are met"]),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license v 2"]),
    ("mpl-2", "licensed under the mozilla public license version 2 0", ["mozilla public license version 2"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ["distribute this software for any purpose with or without fee"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
    ("cc0", "cc0 1 0 universal public domain dedication", ["cc0 1 0 universal"]),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4 0 international"]),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", ["creative commons attribution sharealike"]),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license",
     ["creative commons attribution noncommercial"]),
    ("cc-by-sa", "licensed under cc by sa", ["cc by sa"]),
    ("all-rights-reserved", "all rights reserved", ["all rights reserved"]),
]


def template_rows(base=BASE, notices=NOTICES) -> tuple[list, list]:
    """(template, label, base, at, word) of each template word, (template, key, at, words) of each phrase that has to stand."""
    words, keys = [], []
    for t, (label, notice, phrases) in enumerate([(lab, text, [text]) for lab, text in base] + list(notices)):
        said = notice.split()
        words += [(t, label, t < len(base), i, w) for i, w in enumerate(said)]
        for k, phrase in enumerate(phrases):
            part = phrase.split()
            at = next(i for i in range(len(said)) if said[i : i + len(part)] == part)
            keys.append((t, k, at, part))
    return words, keys


def fixed(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A short list as a table of literals."""
    names = [c.split() for c in schema.split(", ")]
    structs = [F.struct(*(F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(row, names))) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, also where ``body`` uses it for each element of an array."""
    return F.get(F.transform(F.array(value), body), 0)


def plain(word: Column) -> Column:
    return F.translate(word, UPPER, LOWER)


def index_of(docs: DataFrame, words: list, keys: list) -> DataFrame:
    """Template words with the number of documents that hold them: template, label, base, at, word, df, weight.

    The weight is ln((documents + 1) / (df + 1)), over all documents.
    """
    spark: SparkSession = docs.sparkSession
    table = fixed(spark, words, "template int, label string, base boolean, at int, word string")
    lexicon = sorted({w[4] for w in words})
    own = F.filter(words_of(F.col("text")), lambda w: F.lower(w).isin(lexicon))
    seen = docs.select(F.explode(F.array_distinct(F.transform(own, plain))).alias("word"))
    df = seen.groupBy("word").agg(F.count("*").alias("df"))
    n = docs.count()
    out = table.join(F.broadcast(df), "word", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    return out.withColumn("weight", F.log(F.lit(n + 1.0) / (F.col("df") + 1)))


def hits(docs: DataFrame, rare: list[str], keys: list) -> DataFrame:
    """(_row, doc_id, n_words, rares, found): places of rare words, and of phrases that stand whole. Written.

    ``keys``: number, anchor word, its offset in the phrase, phrase words. Where
    the anchor, the phrase's rarest word, stands in a text, the words around it
    are compared with the phrase by their relative position. Full case folding
    finds candidates, A-Z alone decides.
    """
    table = F.array(*(F.struct(
        F.lit(n).alias("key"), F.lit(anchor).alias("anchor"), F.lit(offset).alias("offset"), F.array(*map(F.lit, words)).alias("words"))
        for n, anchor, offset, words in keys))
    anchors = sorted({k[1] for k in keys})

    def stands(ws, w, i):
        return F.transform(
            F.filter(table, lambda k: (k["anchor"] == plain(w)) & (i >= k["offset"]) & (
                F.transform(F.slice(ws, F.greatest(F.lit(1), i - k["offset"] + 1), F.size(k["words"])), plain) == k["words"])),
            lambda k: F.struct(k["key"].alias("key"), (i - k["offset"]).alias("place")))

    def scanned(ws):
        at_rare = F.transform(ws, lambda w, i: F.when(F.lower(w).isin(rare), F.struct(plain(w).alias("word"), i.alias("pos"))))
        at_key = F.transform(ws, lambda w, i: F.when(F.lower(w).isin(anchors), stands(ws, w, i)))
        return F.struct(
            F.size(ws).cast("long").alias("n_words"), F.filter(at_rare, lambda x: x.isNotNull()).alias("rares"),
            F.flatten(F.filter(at_key, lambda x: F.size(x) > 0)).alias("found"))

    rows = docs.select("doc_id", let(words_of(F.col("text")), scanned).alias("x")).select("doc_id", "x.*")
    return cut(rows.withColumn("_row", F.monotonically_increasing_id()), "license-hits")


def scan(docs: DataFrame, base=BASE, notices=NOTICES) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels (arrays), score.

    Templates are indexed by their words that fewest documents hold; each
    document's occurrences of these words are looked up, and postings of one
    template meet where their place minus that in the template agrees (up to
    ``SLACK`` words). A notice gives its label where all phrases that it has to
    hold stand there. ``base`` phrases count wherever they stand. The score is
    the greatest share of a template's weight that stands in one place, from
    ``SHARE`` on, 1 for a base phrase, else 0. Null and empty texts have no
    words; repeated rows and rows of null doc_id get results of their own; an
    empty table gives no rows. Only doc_id and text are read. Templates are a
    short list, which alone goes through the driver.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    words, phrases = template_rows(base, notices)
    order = Window.partitionBy("template").orderBy("df", "at")
    index = index_of(docs, words, phrases).withColumn("rank", F.row_number().over(order)).collect()
    held = {(r.template, r.at): r for r in index}
    keys = []  # (template, key, place in the template, anchor, offset, words)
    for t, k, at, part in phrases:
        low = min(range(len(part)), key=lambda j: (held[t, at + j].df, j))
        keys.append((t, k, at, part[low], low, part))
    rare = [r for r in index if not r.base and r.rank <= RARE]
    rows = hits(docs, sorted({r.word for r in rare}), [(n, a, o, p) for n, (_, _, _, a, o, p) in enumerate(keys)])

    spark = docs.sparkSession
    whole = {}
    for r in rare:
        whole[r.template] = whole.get(r.template, 0.0) + r.weight
    postings = F.broadcast(fixed(
        spark, [(r.word, r.template, r.at, r.weight / whole[r.template] if whole[r.template] else 0.0) for r in rare],
        "word string, template int, at int, weight double"))
    places = F.broadcast(fixed(
        spark, [(n, t, k, at, t < len(base)) for n, (t, k, at, *_) in enumerate(keys)], "key int, template int, k int, at int, base boolean"))
    needs = {}
    for t, k, *_ in keys:
        needs[t] = max(needs.get(t, 0), k + 1)
    labels = F.broadcast(fixed(
        spark, [(t, lab, needs[t]) for t, lab in {(w[0], w[1]) for w in words}], "template int, label string, needs int"))

    words_at = rows.select("_row", F.inline("rares")).join(postings, "word").select(
        "_row", "template", (F.col("pos") - F.col("at")).alias("start"), "at", "weight", F.lit(None).cast("int").alias("k"))
    stood = rows.select("_row", F.inline("found")).join(places, "key")
    keys_at = stood.filter("not base").select(
        "_row", "template", (F.col("place") - F.col("at")).alias("start"), F.lit(None).cast("int").alias("at"),
        F.lit(0.0).alias("weight"), "k")
    near = F.floor(F.col("start") / SLACK)
    votes = words_at.union(keys_at).withColumn("near", F.explode(F.array(near, near + 1)))
    votes = votes.groupBy("_row", "template", "near", "at", "k").agg(F.max("weight").alias("weight"))
    met = votes.groupBy("_row", "template", "near").agg(F.sum("weight").alias("share"), F.count("k").alias("keys")).join(labels, "template")
    share = F.round(F.least(F.max("share"), F.lit(1.0)), 6)
    noticed = met.groupBy("_row").agg(
        F.collect_set(F.when(F.col("keys") >= F.col("needs"), F.col("label"))).alias("own"), share.alias("share"))
    based = stood.filter("base").join(labels, "template").groupBy("_row").agg(
        F.count("*").alias("n_base"), F.min("place").cast("long").alias("first_word"), F.max("place").cast("long").alias("last_word"),
        F.collect_set("label").alias("base_labels"))
    per = cut(noticed.join(based, "_row", "full"), "licenses")
    none = F.expr("cast(array() as array<string>)")
    sure = F.coalesce("base_labels", none)
    out = rows.select("_row", "doc_id", "n_words").join(sized(per), "_row", "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.array_sort(sure).alias("base_labels"), F.array_sort(F.array_union(sure, F.coalesce("own", none))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).when(F.col("share") >= SHARE, F.col("share")).otherwise(0.0).alias("score"))
