"""The registered queries of the corpus operators, and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.llm import debruijn, decontam, jaccard, langid, licenses, merkle, packing, pages, phrases, pii, suffixes, topk, toxicity
from plantlens.llm.common import read


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = debruijn.without_repeats(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.language_of(docs).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.without_repeats(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.detect(docs, pii.fit_on(docs), "doc_id")
    count = lambda k: F.size(F.filter("spans", lambda s: ~s["added"] & (s["kind"] == k))).cast("long").alias(f"n_{k}")
    every = pii.joined("spans", False)
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(pii.joined("spans", True), 256).alias("base_sha256"), every.alias("spans"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return out.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "pages")
    return pages.extract(rows, pages.fit_on(rows)).select("page_id", "url", "text", "n_chars")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read(spark, sf_dir, "documents")).drop("proof")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan(read(spark, sf_dir, "documents"))
    return out.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


QUERIES = {
    "op13_license_scan": op13_license_scan,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op10_html_text": op10_html_text,
    "op6_pii": op6_pii,
    "op4_toxicity": op4_toxicity,
    "op5_exact_topk": op5_exact_topk,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op1_substring_dedup": op1_substring_dedup,
    "op8_packing": op8_packing,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op9_language_id": op9_language_id,
    "op7_decontamination": op7_decontamination,
}

OP7_SQL = r"""
with doc as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as w
  from documents),
item as (
  select cast(item_id as varchar) as item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as w
  from benchmark),
win as (
  select distinct item_id, least(10, len(w)) as n, array_to_string(w[i:i + 9], ' ') as g
  from (select item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) as i from item where len(w) > 0)),
gram as (
  select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as g
  from (select doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) as i
        from doc, (select distinct n from win) where len(w) >= n)),
hit as (select doc_id, i, gram.n as n, item_id from gram join win on gram.g = win.g and gram.n = win.n),
pos as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(generate_series(i, i + n - 1)) as p from (select distinct doc_id, i, n from hit))
  group by doc_id),
ids as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as s
  from (select distinct doc_id, item_id from hit) group by doc_id)
select doc.doc_id, cast(len(doc.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(s, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from doc left join pos on pos.doc_id = doc.doc_id left join ids on ids.doc_id = doc.doc_id
"""

OP1_SQL = r"""
with doc as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (
  select doc_id, i, array_to_string(w[i:i + 19], ' ') as g
  from (select doc_id, w, unnest(generate_series(1, len(w) - 19)) as i from doc where len(w) >= 20)),
again as (
  select doc_id, i from (select doc_id, i, row_number() over (partition by g order by doc_id, i) as rn from win) where rn > 1),
gone as (select distinct doc_id, p from (select doc_id, unnest(generate_series(i, i + 19)) as p from again)),
word as (select doc_id, unnest(w) as x, unnest(generate_series(1, len(w))) as p from doc),
kept as (
  select word.doc_id, string_agg(word.x, ' ' order by word.p) as s
  from word anti join gone on gone.doc_id = word.doc_id and gone.p = word.p group by word.doc_id),
lost as (select doc_id, count(*) as n from gone group by doc_id)
select doc.doc_id, cast(len(doc.w) as bigint) as n_words, cast(coalesce(lost.n, 0) as bigint) as n_removed,
  sha256(coalesce(kept.s, '')) as kept_sha256
from doc left join kept on kept.doc_id = doc.doc_id left join lost on lost.doc_id = doc.doc_id
"""

OP2_SQL = r"""
with recursive doc as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
gram as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as g
  from (select doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) as i from doc where len(w) > 0)),
size as (select doc_id, count(*) as n from gram group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from gram a join gram b on a.g = b.g and a.doc_id <> b.doc_id group by all),
link as (
  select o.a, o.b from common o join size x on x.doc_id = o.a join size y on y.doc_id = o.b
  where 100 * o.c >= 80 * (x.n + y.n - o.c)),
reach as (
  select doc_id, doc_id as r from size union select link.b, reach.r from reach join link on link.a = reach.doc_id),
root as (select doc_id, min(r) as component_id from reach group by doc_id)
select doc.doc_id, cast(coalesce(size.n, 0) as bigint) as n_shingles, coalesce(root.component_id, doc.doc_id) as component_id
from doc left join size on size.doc_id = doc.doc_id left join root on root.doc_id = doc.doc_id
"""

OP5_SQL = """
with vec as (
  select vec_id, [floor(64 * x::double) for x in embedding] as v from embeddings
  where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0)
select query_id, cast(rank as integer) as rank, vec_id, cast(score as bigint) as score
from (
  select q.vec_id as query_id, c.vec_id as vec_id, list_dot_product(q.v, c.v) as score,
    row_number() over (partition by q.vec_id order by list_dot_product(q.v, c.v) desc, c.vec_id) as rank
  from vec q join vec c on c.vec_id <> q.vec_id where q.vec_id % 20 = 0)
where rank <= 20
"""

OP11_SQL = r"""
with recursive doc as (
  select *, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(cast(doc_id as varchar), ''),
      lambda ch: list_transform(range(8), lambda k: (ascii(ch) >> cast(k as integer)) & 1)))),
      lambda c, b: xor(c >> 1, 3988292384 * xor(c & 1, b))), 4294967295) % 7 = 0 as odd
  from documents),
said as (
  select doc_id, lang, odd,
    coalesce(strlen(cast(doc_id as varchar)) || ':' || cast(doc_id as varchar), '-')
      || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') as head,
    coalesce(strlen(cast(n_chars as varchar)) || ':' || cast(n_chars as varchar), '-') as n,
    coalesce(strlen(cast(n_chars::hugeint + 1 as varchar)) || ':' || cast(n_chars::hugeint + 1 as varchar), '-') as more,
    coalesce(strlen(text) || ':' || text, '-') as tail
  from doc),
leaf as (
  select doc_id, lang, sha256(head || n || tail) as leaf,
    sha256(head || case when odd then more else n end || tail) as changed from said),
lang_no as (select lang, row_number() over (order by lang nulls first) - 1 as tree, count(*) as n from leaf group by lang),
placed as (
  select doc_id, tree, n, leaf, changed, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos
  from leaf join lang_no on leaf.lang is not distinct from lang_no.lang),
node as (
  select tree, 0 as level, pos, n, leaf as h from placed
  union all
  select tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' order by pos)) from node where n > 1
  group by tree, level, pos // 2, n),
top as (
  select 0 as level, tree as pos, (select count(*) from lang_no) as n, h from node where n = 1
  union all
  select level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' order by pos)) from top where n > 1
  group by level, pos // 2, n),
climb as (
  select doc_id, tree, leaf, 0 as level, pos, n, '' as proof, changed as h from placed
  union all
  select c.doc_id, c.tree, c.leaf, c.level + 1, c.pos // 2, (c.n + 1) // 2, c.proof || coalesce(o.h, ''),
    sha256(case when c.pos % 2 = 1 then o.h || c.h else c.h || coalesce(o.h, '') end)
  from climb c left join node o on o.tree = c.tree and o.level = c.level and o.pos = xor(c.pos, 1)
  where c.n > 1),
rise as (
  select doc_id, tree, leaf, 0 as level, tree as pos, (select count(*) from lang_no) as n, proof, h from climb where n = 1
  union all
  select c.doc_id, c.tree, c.leaf, c.level + 1, c.pos // 2, (c.n + 1) // 2, c.proof || coalesce(o.h, ''),
    sha256(case when c.pos % 2 = 1 then o.h || c.h else c.h || coalesce(o.h, '') end)
  from rise c left join top o on o.level = c.level and o.pos = xor(c.pos, 1)
  where c.n > 1)
select rise.doc_id, rise.leaf, node.h as subroot, top.h as root, sha256(rise.proof) as proof_sha256, rise.h as folded_root,
  rise.h = top.h as verified
from rise join node on node.tree = rise.tree and node.n = 1 join top on top.n = 1
where rise.n = 1
"""

OP12_SQL = r"""
with piece as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as p
  from documents),
said as (select lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda w: w <> '') as w from piece),
total as (select lang, cast(sum(len(w)) as bigint) as n from said group by lang),
gram as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as g
  from (select lang, w, k, unnest(generate_series(1, len(w) - k + 1)) as i
        from said, (select unnest([1, 2, 3, 4, 5]) as k) where len(w) >= k)),
often as (select lang, k, g, count(*) as f from gram group by all having count(*) >= 100),
part as (
  select lang, g, f, string_split(g, ' ') as w, k, unnest(generate_series(1, k - 1)) as j from often where k > 1),
cutting as (
  select part.lang, part.g, part.f as a, part.j, x.f as l, y.f as r, n,
    cast((1000 * part.f::hugeint * n) // (x.f::hugeint * y.f) as bigint) as score
  from part join total on total.lang = part.lang
  join often x on x.lang = part.lang and x.k = part.j and x.g = array_to_string(part.w[1:part.j], ' ')
  join often y on y.lang = part.lang and y.k = part.k - part.j and y.g = array_to_string(part.w[part.j + 1:], ' ')),
weakest as (
  select * from (select *, row_number() over (partition by lang, g order by score, j) as o from cutting) where o = 1),
kept as (
  select * from weakest c where not exists (
    select 1 from often o where o.lang = c.lang and 100 * o.f >= 100 * c.a and strlen(o.g) > strlen(c.g)
      and contains(' ' || o.g || ' ', ' ' || c.g || ' '))),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, encode(g)) as place from kept)
select lang, place as rank, g as phrase, a, l, r, n, score from ranked where place <= 2000
"""


def op13_sql() -> str:
    """The same templates as rows of values."""
    words, keys = licenses.template_rows()
    said = ", ".join(f"({t}, '{lab}', {str(base).lower()}, {at}, '{w}')" for t, lab, base, at, w in words)
    need = ", ".join(f"({t}, {k}, {at}, {part})" for t, k, at, part in keys)
    return OP13_SQL.replace("$WORDS", said).replace("$KEYS", need)


OP13_SQL = r"""
with doc as (
  select row_number() over () as no, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as w
  from documents),
said(t, label, base, j, word) as (values $WORDS),
need(t, k, j, part) as (values $KEYS),
tok as (
  select no, word, pos from (
    select no, unnest(w) as word, unnest(generate_series(0, len(w) - 1)) as pos from doc where len(w) > 0)
  where word in (select word from said)),
held as (select word, count(distinct no) as df from tok group by word),
weighed as (
  select said.*, ln(((select count(*) from documents) + 1.0) / (coalesce(df, 0) + 1)) as weight,
    row_number() over (partition by t order by coalesce(df, 0), j) as o
  from said left join held on held.word = said.word),
rare as (select *, weight / sum(weight) over (partition by t) as part_of from weighed where o <= 6 and not base),
stood as (
  select tok.no, need.t, need.k, need.j, tok.pos as place
  from need join tok on tok.word = need.part[1] join doc on doc.no = tok.no
  where doc.w[tok.pos + 1:tok.pos + len(need.part)] = need.part),
vote as (
  select no, t, floor((pos - j) / 16.0) as b, j, null as k, part_of as p from tok join rare on rare.word = tok.word
  union all
  select no, t, floor((place - j) / 16.0), null, k, 0.0 from stood where t not in (select t from said where base)),
near as (select no, t, b, j, k, p from vote union all select no, t, b + 1, j, k, p from vote),
met as (
  select no, t, b, sum(p) as share, count(k) as keys
  from (select no, t, b, j, k, max(p) as p from near group by all) group by all),
noticed as (
  select no, list(distinct label) filter (where keys >= needs) as own, round(least(1.0, max(share)), 6) as share
  from met join (select t, max(k) + 1 as needs from need group by t) n on n.t = met.t
  join (select distinct t, label from said) l on l.t = met.t group by no),
based as (
  select no, count(*) as n_base, min(place) as first_word, max(place) as last_word, list(distinct label) as labels
  from stood join (select distinct t, label from said where base) l on l.t = stood.t group by no)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_base, 0) as n_base, cast(first_word as bigint) as first_word,
  cast(last_word as bigint) as last_word, array_to_string(list_sort(coalesce(based.labels, [])), ',') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(based.labels, []), coalesce(own, [])))), ',') as labels,
  cast(case when n_base > 0 then 1 when share >= 0.5 then share else 0 end as double) as score
from doc left join noticed on noticed.no = doc.no left join based on based.no = doc.no
"""

#: The others are trained, or too slow in SQL over whole tables (byte strings); their tests hold them against brute force.
ORACLE_SQL = {
    "op1_substring_dedup": OP1_SQL,
    "op2_ngram_jaccard": OP2_SQL,
    "op5_exact_topk": OP5_SQL,
    "op7_decontamination": OP7_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op12_phrase_collocations": OP12_SQL,
    "op13_license_scan": op13_sql(),
}
