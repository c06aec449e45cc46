"""Merkle manifest of a table: built levels as stored rows, proofs by a recursive query that climbs from every leaf."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import crc_of, cut, numbered_by, sized

#: Levels that are built, stored and climbed at once: a stored row holds a subtree of 2 ** HOP leaves.
HOP = 10
#: The columns of a leaf in their order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree over the languages' roots.
TOP = -1
#: Node rows (up to HOP digests each) that may be broadcast to the climb.
BROADCAST_NODES = 100_000


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_of(row: dict[str, Column]) -> Column:
    """The digest of a row: each field as its byte count, a colon and its text; null is a hyphen."""
    said = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
            for c in row.values()]
    return digest(F.concat(*said))


def leaves_of(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, tampered): the last is the leaf of n_chars + 1 where 7 divides the crc32 of doc_id, else null."""
    c = {f: F.col(f) for f in FIELDS}
    more = (c["n_chars"].cast("decimal(38,0)") + 1).cast("decimal(38,0)")
    tampered = F.when(crc_of("doc_id") % 7 == 0, leaf_of(c | {"n_chars": more}))
    return docs.select("doc_id", "lang", leaf_of(c).alias("leaf"), tampered.alias("tampered"))


def parents(nodes: Column) -> Column:
    """The level above: the digest of every two consecutive nodes, or of the last one alone."""
    pairs = F.sequence(F.lit(0), shifted(F.size(nodes) - 1, F.lit(1)))
    return F.transform(pairs, lambda i: digest(F.concat(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit("")))))


def shifted(j: Column, k: Column) -> Column:
    return F.call_function("shiftright", j, k)


def height(n: Column) -> Column:
    """Levels to climb from a level of ``n`` nodes: HOP, or fewer if one node remains earlier."""
    out = F.lit(HOP)
    for h in reversed(range(HOP)):
        out = F.when(n <= 2**h, F.lit(h)).otherwise(out)
    return out


def built(rows: DataFrame, name: str) -> DataFrame:
    """Blocks of up to 2 ** HOP consecutive nodes of a tree: (tree, n, block, members, levels).

    ``rows``: tree, n (nodes of this level of the tree), at, hash, and more
    columns that stay in ``members``. ``levels`` has the block's own nodes and
    every level above, as far as a block reaches. Written.
    """
    more = [c for c in rows.columns if c not in ("tree", "n")]
    blocks = rows.groupBy("tree", "n", F.shiftright("at", HOP).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct(*more))).alias("members"))
    climbed = F.aggregate(
        F.filter(F.sequence(F.lit(1), F.lit(HOP)), lambda k: k <= height(F.col("n"))),
        F.array(F.col("members.hash")), lambda acc, _: F.concat(acc, F.array(parents(F.element_at(acc, -1)))))
    return cut(blocks.select("tree", "n", "block", "members", climbed.alias("levels")), name)


def top_of(blocks: DataFrame) -> DataFrame:
    """(tree, n, at, hash): the node that a block becomes."""
    return blocks.select(
        "tree", F.ceil(F.col("n") / 2**HOP).alias("n"), F.col("block").alias("at"),
        F.element_at(F.element_at("levels", -1), 1).alias("hash"))


def hops(blocks: DataFrame, level: int) -> DataFrame:
    """One row for each member, linked to the node that its block becomes, with the siblings in between.

    The last node of a language's tree is a leaf of the top tree; its root has no link.
    """
    path = lambda j: F.transform(F.sequence(F.lit(0), F.size("levels") - 2), lambda k: F.struct(
        (shifted(j, k) % 2 == 1).alias("left"),
        F.unhex(F.get(F.get("levels", k), F.when(shifted(j, k) % 2 == 1, shifted(j, k) - 1).otherwise(shifted(j, k) + 1))).alias("sibling")))
    none = F.expr("cast(array() as array<struct<left: boolean, sibling: binary>>)")
    each = F.transform("members", lambda m, j: F.struct(m.alias("member"), F.when(F.size("levels") > 1, path(j)).otherwise(none).alias("path")))
    last = F.col("n") <= 2**HOP
    in_top = F.col("tree") == TOP
    up = {
        "up_tree": F.when(~last, F.col("tree")).when(~in_top, F.lit(TOP)),
        "up_level": F.when(~last, F.lit(level + HOP)).when(~in_top, F.lit(0)),
        "up_at": F.when(~last, F.col("block")).when(~in_top, F.col("tree")),
    }
    rows = blocks.select("tree", *(v.alias(k) for k, v in up.items()), F.explode(each).alias("m"))
    return rows.select("tree", F.lit(level).alias("level"), "m.member.*", "up_tree", "up_level", "up_at", "m.path")


def grown(rows: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of all levels over ``rows`` (tree, n, at, hash, ...), and (tree, hash) of the roots."""
    levels, roots = [], []
    most = rows.agg(F.max("n")).first()[0] or 0
    while True:
        blocks = built(rows, f"{name}-{len(levels)}")
        levels.append(blocks)
        rows = top_of(blocks)
        roots.append(rows.filter("n = 1").select("tree", "hash"))
        rows = rows.filter("n > 1")
        if most <= 2**HOP:
            break
        most = -(-most // 2**HOP)
    out = roots[0]
    for r in roots[1:]:
        out = out.union(r)
    return levels, out


CLIMB = """
with recursive climb as (
  select doc_id, leaf, own, up_tree as tree, up_level as level, up_at as at,
    {siblings} as siblings, {folded} as folded
  from {leaves}
  union all
  select {hint} c.doc_id, c.leaf, c.own, n.up_tree, n.up_level, n.up_at,
    concat(c.siblings, {siblings_above}), {folded_above}
  from climb c join {nodes} n on c.tree = n.tree and c.level = n.level and c.at = n.at)
select doc_id, leaf, own, siblings, folded from climb where tree is null"""


def siblings(path: str) -> str:
    return f"aggregate({path}, cast('' as binary), (s, x) -> concat(s, coalesce(x.sibling, cast('' as binary))))"


def folded(start: str, path: str) -> str:
    """Each level's digest of what came up and its sibling, which stands left or right of it."""
    other = "coalesce(lower(hex(x.sibling)), '')"
    return f"aggregate({path}, {start}, (h, x) -> sha2(if(x.left, concat({other}, h), concat(h, {other})), 256))"


def manifest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof (binary siblings), proof_sha256, folded_root, verified.

    Every row is a leaf of the tree of its lang, in the order of doc_id; the
    trees' roots in the order of lang are the leaves of the last tree. Levels are
    stored as blocks of nodes with links to the node above; a recursive query
    climbs from every leaf, appends the siblings and folds the tampered leaf. A
    null field counts as such: null doc_id and null lang come first, and a row of
    null doc_id is not tampered with. Repeated rows are leaves of their own,
    equal doc_ids follow their digests. An empty table gives no rows. Only the
    five columns of a leaf are read.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    rows = numbered_by(leaves_of(docs), ["lang"], ["doc_id", "leaf"], "leaves")
    langs = cut(rows.groupBy("lang").agg(F.count("*").alias("n")), "langs")
    trees = cut(numbered_by(langs, [], ["lang"], "trees", at="tree"), "trees")
    same = F.col("r.lang").eqNullSafe(F.col("t.lang"))
    rows = rows.alias("r").join(sized(trees).alias("t"), same).select(
        "tree", "n", "at", F.col("leaf").alias("hash"), "doc_id", "tampered")
    levels, subroots = grown(rows, "levels")
    subroots = cut(subroots, "subroots")
    n = subroots.count()
    top, root = grown(subroots.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(n).cast("long").alias("n"), F.col("tree").alias("at"), "hash"), "top")
    first = root.select("hash").head(1)
    root = F.lit(first[0][0] if first else None).cast("string")
    above = [hops(b, HOP * (i + 1)).drop("hash") for i, b in enumerate(levels[1:])] + [
        hops(b, HOP * i).drop("hash") for i, b in enumerate(top)]
    nodes = above[0]
    for a in above[1:]:
        nodes = nodes.union(a)
    nodes = cut(nodes, "nodes")
    leaves = hops(levels[0], 0).select(
        "doc_id", F.col("hash").alias("leaf"), "tampered", F.col("tree").alias("own"), "up_tree", "up_level", "up_at", "path")
    said = {
        "siblings": siblings("path"), "folded": folded("coalesce(tampered, leaf)", "path"),
        "siblings_above": siblings("n.path"), "folded_above": folded("c.folded", "n.path"),
        "hint": "/*+ broadcast(n) */" if nodes.count() <= BROADCAST_NODES else "",
    }
    sql = CLIMB
    for k, v in said.items():
        sql = sql.replace("{%s}" % k, v)
    climbed = spark.sql(sql, leaves=leaves, nodes=nodes)
    proof = F.lower(F.hex("siblings"))
    return climbed.join(sized(subroots), F.col("own") == F.col("tree")).select(
        "doc_id", "leaf", F.col("hash").alias("subroot"), root.alias("root"), F.col("siblings").alias("proof"),
        digest(proof).alias("proof_sha256"), F.col("folded").alias("folded_root"),
        F.coalesce(F.col("folded") == root, F.lit(False)).alias("verified"))
