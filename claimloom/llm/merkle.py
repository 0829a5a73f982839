"""Merkle manifest of a dataset, with a proof for every row, by a butterfly exchange.

Each group (a source) is a tree over its leaves in order of their key; the roots of the groups, in order of the groups, are the leaves
of the tree above, whose root names the dataset. A node is H of its children's digests written one after the other.

1. Leaves are dealt by range, so ranks come from row numbers within partitions and a small table of counts: no group, however
   large, is sorted in one task. `fanout ** depth` leaves with consecutive ranks are a block, which hashes its own levels.
2. Butterfly: in round j the blocks of each `fanout` neighbouring subtrees of `fanout ** j` blocks swap subtree roots. A block sends to the
   blocks at its own place in the other subtrees, and so every block hashes its ancestors itself and
   holds the siblings of its path when the rounds end; no pass goes back down. Where the last subtree is smaller, its
   blocks take over the places that it lacks. A round is one shuffle of a few rows per block.
3. The same is done with the roots of the groups, and each block appends the path of its group.

A path is a list of (left, right): the digests of the siblings before and after a node in its run, as one text each.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import Stages

#: Levels that a block hashes itself: 3 ** 6 leaves.
DEPTH = 6
PATH = "array<struct<left:string,right:string>>"


def h(text: Column) -> Column:
    return F.sha2(text, 256)


def coded(*values: Column) -> Column:
    """H of the values written one after the other: `-` for null, else the UTF-8 length, a colon and the value."""
    texts = [v.cast("string") for v in values]
    return h(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def folded(leaf: Column, path: Column) -> Column:
    """Root that a leaf and the siblings of its path lead to."""
    return F.aggregate(path, leaf, lambda node, s: h(F.concat(s["left"], node, s["right"])))


def proof(path: Column) -> Column:
    """H of all siblings, level by level, left to right."""
    return h(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))))


def ranked(stages: Stages, name: str, rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows` with `rank` from 0 and `total` within `grp`, in the order of grp and then `order`, nulls first."""
    dealt = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    dealt = dealt.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    dealt = stages.keep(f"{name}-dealt", dealt)
    # One row for each group in each partition.
    held = dealt.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    held = stages.keep(f"{name}-held", held)
    # Leaves of a group in the partitions before: a group lies in consecutive partitions, of which few rows are sorted here.
    before = held.selectExpr("grp", "part", "first", "n", "coalesce(sum(n) OVER (PARTITION BY grp ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before")
    totals = held.groupBy("grp").agg(F.sum("n").alias("total"))
    before = before.join(totals, before["grp"].eqNullSafe(totals["grp"])).select(before["grp"].alias("g"), F.col("part").alias("p"), "first", "before", "total")
    found = dealt.join(before, F.col("grp").eqNullSafe(F.col("g")) & (F.col("part") == F.col("p")))
    return found.withColumn("rank", F.col("at") - F.col("first") + F.col("before")).drop("part", "at", "g", "p", "first", "before")


def _parents(level: Column, fanout: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(level), F.lit(fanout)), lambda at: h(F.concat_ws("", F.slice(level, at, fanout))))


def _levels(leaves: Column, alone: Column, fanout: int, depth: int) -> Column:
    """All levels of a block, its leaves first: `depth` of them above the leaves, or up to its root if the block is the whole tree."""

    def up(levels: Column, _: Column) -> Column:
        top = F.element_at(levels, -1)
        return F.when(alone & (F.size(top) == 1), levels).otherwise(F.concat(levels, F.array(_parents(top, fanout))))

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.array(leaves), up)


def _siblings(level: Column, at: Column, fanout: int) -> Column:
    """(left, right) of the node number `at` (from 0) of a level."""
    place = at % fanout
    left = F.concat_ws("", F.slice(level, at - place + 1, place))
    right = F.concat_ws("", F.slice(level, at + 2, F.lit(fanout - 1) - place))
    return F.struct(left.alias("left"), right.alias("right"))


def _own_path(levels: Column, at: Column, fanout: int) -> Column:
    """Siblings of leaf number `at` on the levels of its block."""
    below = F.slice(levels, 1, F.size(levels) - 1)
    return F.transform(below, lambda level, j: _siblings(level, F.floor(at / F.pow(F.lit(float(fanout)), j)).cast("int"), fanout))


def _round(blocks: DataFrame, width: int, fanout: int) -> DataFrame:
    """Blocks (grp, block, blocks, root, path), root being that of the subtree of `width` blocks in which a block lies, one level up."""
    subtree, place = F.expr(f"block div {width}"), F.expr(f"block % {width}")

    def size(tree: Column) -> Column:
        return F.least(F.lit(width), F.col("blocks") - tree * width)

    first = subtree - subtree % fanout
    run = F.sequence(first, F.least(first + fanout - 1, F.expr(f"(blocks - 1) div {width}")))
    # The places that a block serves in another subtree: its own, and if its own subtree is smaller those that lie whole sizes above.
    served = F.transform(
        run,
        lambda tree: F.when(tree == subtree, F.array(F.col("block"))).otherwise(
            F.when(place < size(tree), F.transform(F.sequence(place, size(tree) - 1, size(subtree)), lambda q: tree * width + q)).otherwise(F.array().cast("array<bigint>"))
        ),
    )
    sent = blocks.withColumn("subtree", subtree).withColumn("to", F.explode(F.flatten(served)))
    own = F.col("block") == F.col("to")
    met = sent.groupBy("grp", F.col("to").alias("block")).agg(
        F.max("blocks").alias("blocks"),
        F.array_sort(F.collect_list(F.struct("subtree", "root"))).alias("roots"),
        F.max(F.when(own, F.col("path"))).alias("path"),
    )
    before = F.concat_ws("", F.filter("roots", lambda r: r["subtree"] < subtree).getField("root")).alias("left")
    after = F.concat_ws("", F.filter("roots", lambda r: r["subtree"] > subtree).getField("root")).alias("right")
    root = h(F.concat_ws("", F.col("roots.root"))).alias("root")
    return met.select("grp", "block", "blocks", root, F.concat("path", F.array(F.struct(before, after))).alias("path"))


def butterfly(stages: Stages, name: str, blocks: DataFrame, fanout: int) -> DataFrame:
    """(grp, block, root, path) for (grp, block, blocks, root): the root of the whole group, and the siblings above each block."""
    state = blocks.select("grp", "block", "blocks", "root", F.array().cast(PATH).alias("path"))
    most = state.agg(F.max("blocks")).first()[0] or 0
    width, number, kept = 1, 0, None
    while width < most:
        # Groups of at most `width` blocks have their root already.
        going = _round(state.where(F.col("blocks") > width), width, fanout)
        state = stages.keep(f"{name}-round-{number}", state.where(F.col("blocks") <= width).unionByName(going))
        if kept:
            stages.drop(kept)
        kept, number, width = f"{name}-round-{number}", number + 1, width * fanout
    return state.select("grp", "block", "root", "path")


def _forest(stages: Stages, name: str, leaves: DataFrame, order: list[str], fanout: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """One tree for each grp over (grp, leaf, ...): its blocks (grp, block, items, levels), and what the butterfly made of them."""
    size = fanout**depth
    rows = ranked(stages, name, leaves, order)
    item = F.struct("rank", "leaf", *[c for c in leaves.columns if c not in ("grp", "leaf")])
    block = F.expr(f"rank div {size}").alias("block")
    blocks = rows.groupBy("grp", block).agg(F.first("total").alias("total"), F.array_sort(F.collect_list(item)).alias("items"))
    count = F.expr(f"(total + {size - 1}) div {size}")
    levels = _levels(F.col("items.leaf"), count == 1, fanout, depth)
    blocks = stages.keep(f"{name}-blocks", blocks.select("grp", "block", count.alias("blocks"), "items", levels.alias("levels")))
    heads = blocks.select("grp", "block", "blocks", F.element_at(F.element_at("levels", -1), 1).alias("root"))
    stages.drop(f"{name}-dealt", f"{name}-held")
    return blocks, butterfly(stages, name, heads, fanout)


def merkle_proofs(leaves: DataFrame, fanout: int = 3, depth: int = DEPTH) -> DataFrame:
    """(key, leaf, carried, grp, subroot, root, path) for each row of (grp, key, leaf, carried).

    Leaves of a group ascend by key, nulls first, then by digest; groups ascend likewise, texts by their UTF-8 bytes. While several nodes
    remain, each `fanout` consecutive ones (the last run may have fewer, even one) become their H; a lone leaf is its own root. Rows
    that are equal get neighbouring places. `carried` is any value that travels with its row and takes no part in the order.
    A block holds `fanout ** depth` rows at most. An empty table has no rows and so no root.
    """
    assert fanout >= 2 and depth >= 1
    stages = Stages(leaves.sparkSession)
    leaves = stages.keep("leaves", leaves.select("grp", "key", "leaf", "carried"))
    blocks, state = _forest(stages, "rows", leaves, ["key", "leaf"], fanout, depth)
    roots = state.where("block = 0").select(F.lit(0).alias("grp"), F.col("grp").alias("key"), F.col("root").alias("leaf"))
    tops, above = _forest(stages, "groups", roots, ["key"], fanout, depth)

    def opened(trees: DataFrame, state: DataFrame) -> DataFrame:
        """(grp, item, root, path) for each leaf of the blocks; a block's levels are used up before its rows part."""
        ends = state.select(F.col("grp").alias("g"), F.col("block").alias("b"), "root", F.col("path").alias("upper"))
        both = trees.join(ends, F.col("grp").eqNullSafe(F.col("g")) & (F.col("block") == F.col("b")))
        with_path = F.transform("items", lambda item, at: F.struct(item.alias("item"), F.concat(_own_path(F.col("levels"), at, fanout), F.col("upper")).alias("path")))
        return both.select("grp", "root", F.explode(with_path).alias("one")).select("grp", "root", "one.item", "one.path")

    groups = opened(tops, above).select(F.col("item.key").alias("g2"), F.col("root").alias("top"), F.col("path").alias("top_path"))
    groups = stages.keep("groups", groups)
    found = state.join(groups, F.col("grp").eqNullSafe(F.col("g2")))
    found = found.select("grp", "block", F.concat("path", "top_path").alias("path"), F.struct(F.col("root").alias("subroot"), F.col("top").alias("root")).alias("root"))
    rows = opened(blocks, stages.keep("paths", found))
    return rows.select("item.key", "item.leaf", "item.carried", "grp", "root.subroot", "root.root", "path")


def document_leaf(text: Column) -> Column:
    """Leaf of a row of `documents`, with this text."""
    return coded(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)


def verified_manifest(docs: DataFrame, fanout: int = 3, depth: int = DEPTH) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A tree for each source. Documents whose crc32(doc_id as text) is even are tampered with by deleting line feeds from their text;
    folded_root comes from the tampered leaf, else from the original one, and the original siblings, so `verified` tells whether the
    manifest catches it and whether every other row leads back to the root. Nulls
    in any column are written `-` and stay null; a row without doc_id is not tampered with. Rows that repeat a doc_id are leaves of
    their own. Other columns are not read and may have any name. An empty table gives an empty result.
    """
    text = F.col("text").cast("string")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even & F.contains(text, F.lit("\n")), document_leaf(F.replace(text, F.lit("\n"), F.lit(""))))
    leaves = docs.select(F.col("source").cast("string").alias("grp"), F.col("doc_id").cast("long").alias("key"), document_leaf(text).alias("leaf"), tampered.alias("carried"))
    rows = merkle_proofs(leaves, fanout, depth)
    # The leaf is carried only where tampering changed it; every row is folded, so that a wrong path shows in any of them.
    again = folded(F.coalesce("carried", "leaf"), F.col("path"))
    rows = rows.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), again.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


# crc32 bit by bit: a byte is xored in, then eight steps (marked -1) shift it out.
_CRC_SQL = (
    "xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''), "
    "lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), "
    "lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"
)

MANIFEST_SQL = r"""
    WITH RECURSIVE texts AS (
        SELECT doc_id, source, text,
               {coded} AS head,
               CASE WHEN {crc} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed
        FROM documents
    ), hashed AS (
        SELECT *, sha256(head || coalesce(octet_length(encode(text))::VARCHAR || ':' || text, '-')) AS leaf,
               sha256(head || coalesce(octet_length(encode(changed))::VARCHAR || ':' || changed, '-')) AS tampered
        FROM texts
    ), leaves AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, row_number() OVER () AS r FROM hashed
    ), nodes(level, source, idx, node, n) AS (
        SELECT 0, source, rank, leaf, count(*) OVER (PARTITION BY source) FROM leaves
        UNION ALL
        SELECT level + 1, source, idx // 3, sha256(string_agg(node, '' ORDER BY idx)), (n + 2) // 3 FROM nodes WHERE n > 1 GROUP BY level, source, idx // 3, n
    ), subroots AS (
        SELECT source, node AS subroot, level AS height, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS rank FROM nodes WHERE n = 1
    ), tops(level, idx, node, n) AS (
        SELECT 0, rank, subroot, count(*) OVER () FROM subroots
        UNION ALL
        SELECT level + 1, idx // 3, sha256(string_agg(node, '' ORDER BY idx)), (n + 2) // 3 FROM tops WHERE n > 1 GROUP BY level, idx // 3, n
    ), siblings AS (
        SELECT l.r, n.level, coalesce(string_agg(n.node, '' ORDER BY n.idx) FILTER (WHERE n.idx < l.rank // (3 ** n.level)::BIGINT), '') AS lefts,
               coalesce(string_agg(n.node, '' ORDER BY n.idx) FILTER (WHERE n.idx > l.rank // (3 ** n.level)::BIGINT), '') AS rights
        FROM leaves l JOIN nodes n ON l.source IS NOT DISTINCT FROM n.source AND n.n > 1 AND n.idx // 3 = l.rank // (3 ** (n.level + 1))::BIGINT
        GROUP BY l.r, n.level
        UNION ALL
        SELECT l.r, s.height + t.level, coalesce(string_agg(t.node, '' ORDER BY t.idx) FILTER (WHERE t.idx < s.rank // (3 ** t.level)::BIGINT), ''),
               coalesce(string_agg(t.node, '' ORDER BY t.idx) FILTER (WHERE t.idx > s.rank // (3 ** t.level)::BIGINT), '')
        FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source JOIN tops t ON t.n > 1 AND t.idx // 3 = s.rank // (3 ** (t.level + 1))::BIGINT
        GROUP BY l.r, s.height, t.level
    ), folds(r, level, node) AS (
        SELECT r, 0, tampered FROM leaves
        UNION ALL
        SELECT f.r, f.level + 1, sha256(s.lefts || f.node || s.rights) FROM folds f JOIN siblings s ON s.r = f.r AND s.level = f.level
    ), ends AS (
        SELECT r, arg_max(node, level) AS folded_root FROM folds GROUP BY r
    ), proofs AS (
        SELECT r, sha256(string_agg(lefts || rights, '' ORDER BY level)) AS proof FROM siblings GROUP BY r
    )
    SELECT l.doc_id, l.leaf, s.subroot, (SELECT node FROM tops WHERE n = 1) AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
           e.folded_root, e.folded_root = (SELECT node FROM tops WHERE n = 1) AS verified
    FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source JOIN ends e USING (r) LEFT JOIN proofs p USING (r)
""".replace("{coded}", " || ".join(f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars"))).replace("{crc}", _CRC_SQL)
