"""A Merkle manifest of a dataset: every row's leaf, each group's root, one root over all, and a proof for each row.

Rows of a group lie in the order of their ids. They are cut into blocks of fan ** levels
leaves, and a block is one row with an array: sequence, transform, slice and aggregate collapse
it level by level, natively. The blocks' roots are the leaves of the next round, until each group has
one node left; the groups' roots are a last group of their own. Proofs go the way back:
a block gets its own proof once and passes it on to its members, so that no
row is joined to its group, however many rows that has.

Positions come from a range partitioning: each partition counts its rows of a group, and
only these counts, a row for each group and partition, are added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

FAN = 3
#: Levels that a block collapses at once; a block has FAN ** LEVELS leaves.
LEVELS = 6
PATH = "array<struct<left:string,right:string>>"


def leaf_digest(*values: Column) -> Column:
    """sha256 of all values: `-` for null, else length in bytes, `:` and the value as text."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def proof_digest(path: Column) -> Column:
    """sha256 of all siblings, from the leaf's to the root's, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def _whole(x: Column, by: int | Column) -> Column:
    return F.floor(x / by).cast("int")


def _levels(leaves: Column, height: Column, fan: int) -> Column:
    """The nodes of a block by level, from its leaves up to `height` levels above them."""
    kind = "array<array<string>>"

    def up(done: Column, _: Column) -> Column:
        below = F.element_at(done, -1)
        runs = F.sequence(F.lit(0), _whole(F.size(below) - 1, fan))
        above = F.transform(runs, lambda run: F.sha2(F.array_join(F.slice(below, run * fan + 1, F.lit(fan)), ""), 256))
        return F.concat(done, F.array(above)).cast(kind)

    steps = F.when(height > 0, F.sequence(F.lit(1), F.greatest(height, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, F.array(leaves).cast(kind), up)


def _path(at: Column, levels: Column, fan: int) -> Column:
    """The siblings of the block's leaf number `at`, one entry for each level below the last."""

    def step(nodes: Column, level: Column) -> Column:
        own = _whole(at, F.pow(F.lit(fan), level))
        inside = own % fan
        left = F.array_join(F.slice(nodes, own - inside + 1, inside), "")
        right = F.array_join(F.slice(nodes, own + 2, F.lit(fan) - 1 - inside), "")
        return F.struct(left.alias("left"), right.alias("right"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), step).cast(PATH)


def _numbered(rows: DataFrame, order: list[str], scratch: Scratch) -> DataFrame:
    """rows with _pos, from 0 in their _group, and _n, the rows of the group."""
    keys = [F.col(c).asc_nulls_first() for c in ["_group", *order]]
    lined = scratch.table(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    runs = lined.groupBy("_group", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_own"))
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = runs.withColumn("_before", F.sum("_own").over(before) - F.col("_own")).withColumn("_n", F.sum("_own").over(Window.partitionBy("_group")))
    joined = lined.withColumn("_part", part).join(runs, ["_group", "_part"])
    return joined.withColumn("_pos", F.col("_before") + F.col("_at") - F.col("_first")).drop("_part", "_at", "_first", "_own", "_before")


def _up(nodes: DataFrame, carried: list[str], fan: int, levels: int, scratch: Scratch) -> list[DataFrame]:
    """Blocks of (_group, _pos, _n, _node, carried), of their roots, and so on to one block for each group."""
    size, stack = fan**levels, []
    while True:
        item = F.struct("_pos", "_node", *carried)
        blocks = nodes.groupBy("_group", F.floor(F.col("_pos") / size).alias("_block")).agg(F.sort_array(F.collect_list(item)).alias("_items"), F.max("_n").alias("_n"))
        # a group of one block ends as soon as one node is left; others go up by all levels
        height = sum(((F.col("_n") > fan**k).cast("int") for k in range(1, levels)), (F.col("_n") > 1).cast("int"))
        blocks = scratch.table(blocks.withColumn("_levels", _levels(F.col("_items")["_node"], height, fan)), "blocks")
        stack.append(blocks)
        if (blocks.agg(F.max("_n")).first()[0] or 0) <= size:
            return stack
        root = F.element_at(F.element_at("_levels", -1), 1)
        nodes, carried = blocks.select("_group", F.col("_block").alias("_pos"), F.ceil(F.col("_n") / size).alias("_n"), root.alias("_node")), []


def _down(stack: list[DataFrame], above: DataFrame, carried: list[str], fan: int) -> DataFrame:
    """(_group, _pos, carried, _node, _above) of the lowest nodes; above: (_group, _above) of each group, _above a struct that has a `path`."""
    above = above.withColumn("_block", F.lit(0).cast("long"))
    for blocks in reversed(stack):
        own = carried if blocks is stack[0] else []
        joined = blocks.join(above, ["_group", "_block"])
        found = F.explode(F.transform("_items", lambda item, at: F.struct(item.alias("item"), _path(at, F.col("_levels"), fan).alias("path"))))
        rows = joined.select("_group", "_above", found.alias("_found"))
        item, path = F.col("_found")["item"], F.concat(F.col("_found")["path"], F.col("_above")["path"])
        rows = rows.select("_group", item["_pos"].alias("_block"), item["_node"].alias("_node"), *(item[c].alias(c) for c in own), F.col("_above").withField("path", path).alias("_above"))
        above = rows.select("_group", "_block", "_above")
    return rows


def merkle_manifest(docs: DataFrame, *, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), claim: Column | None = None, fan: int = FAN, levels: int = LEVELS, id_col: str = "doc_id", group_col: str = "source") -> DataFrame:
    """(id, group, leaf, subroot, root, path, claim) per row of docs.

    leaf is the digest of the row's `columns`; every `fan` consecutive nodes of a group become their digest (the
    last run may have fewer, even one) until one, the subroot, is left; the subroots, by group, give the root in the
    same way. path lists the siblings left and right of the row's node, from its leaf to the root. claim
    is a digest over the columns of docs that is passed along, such as that of a copy that is to be verified (null if not given).
    Groups go by code point, null first and a group of its own; rows by id, null
    first; rows that share an id by their leaf. A lone leaf is its group's subroot, and a lone subroot the root. Columns that
    are not named take no part. An empty table gives no rows. All columns are read as text.
    """
    scratch = Scratch(docs.sparkSession, "merkle")
    group = F.when(docs[group_col].isNull(), F.lit("")).otherwise(F.concat(F.lit("="), docs[group_col].cast("string")))
    leaves = docs.select(group.alias("_group"), docs[id_col].alias("_id"), leaf_digest(*(docs[c] for c in columns)).alias("_node"), (F.lit(None).cast("string") if claim is None else claim).alias("_claim"))
    nodes = _numbered(scratch.table(leaves, "leaves"), ["_id", "_node", "_claim"], scratch)
    stack = _up(nodes, ["_id", "_claim"], fan, levels, scratch)

    subroots = stack[-1].select(F.lit("").alias("_group"), F.col("_group").alias("_name"), F.element_at(F.element_at("_levels", -1), 1).alias("_node"))
    upper = _up(_numbered(subroots, ["_name"], scratch), ["_name"], fan, levels, scratch)
    top = upper[-1].select("_group", F.struct(F.array().cast(PATH).alias("path"), F.element_at(F.element_at("_levels", -1), 1).alias("root")).alias("_above"))
    groups = _down(upper, top, ["_name"], fan)
    above = groups.select(F.col("_name").alias("_group"), F.col("_above").withField("subroot", F.col("_node")).alias("_above"))
    rows = _down(stack, scratch.table(above, "groups"), ["_id", "_claim"], fan)
    name = F.when(F.col("_group") != "", F.expr("substring(_group, 2)"))
    return rows.select(F.col("_id").alias(id_col), name.alias(group_col), F.col("_node").alias("leaf"), F.col("_above")["subroot"].alias("subroot"), F.col("_above")["root"].alias("root"), F.col("_above")["path"].alias("path"), F.col("_claim").alias("claim"))


def verified_manifest(docs: DataFrame) -> DataFrame:
    """Proofs of documents, and what they say of copies in which some documents have lost their line breaks.

    The documents whose id, in decimal, has an even crc32 come without \\n; a null id has none, and its text is left as it is.
    """
    lost = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    claim = leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), lost)
    out = merkle_manifest(docs, claim=claim).withColumn("folded_root", folded(F.col("claim"), F.col("path")))
    return out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


#: Levels are counted over the whole tree of a source; each row keeps its node's place and its proof.
OP13_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, text, lang, n_chars,
    CASE WHEN doc_id IS NOT NULL AND list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c) + 1000, 0, 0, 0, 0, 0, 0, 0, 0]))),
      lambda a, b: CASE WHEN b >= 1000 THEN xor(a, b - 1000) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) % 2 = 1 THEN replace(text, chr(10), '') ELSE text END AS lost FROM documents),
f AS (SELECT doc_id, source,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS body, coalesce(strlen(lost) || ':' || lost, '-') AS lost FROM d),
h AS (SELECT doc_id, source, sha256(head || body) AS leaf, sha256(head || lost) AS claim FROM f),
l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id ASC NULLS FIRST, leaf) - 1 AS pos FROM h),
t AS (SELECT source, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM l GROUP BY source
  UNION ALL SELECT source, level + 1, list_transform(range((len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[i * 3 + 1 : i * 3 + 3], ''))) FROM t WHERE len(nodes) > 1),
s AS (SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source ASC NULLS FIRST) - 1 AS place FROM t WHERE len(nodes) = 1),
u AS (SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM s
  UNION ALL SELECT level + 1, list_transform(range((len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[i * 3 + 1 : i * 3 + 3], ''))) FROM u WHERE len(nodes) > 1),
a AS (SELECT l.doc_id, l.source, l.leaf, l.pos, l.claim, 0 AS level, '' AS proof, l.claim AS node, l.pos AS at FROM l
  UNION ALL SELECT a.doc_id, a.source, a.leaf, a.pos, a.claim, a.level + 1,
    a.proof || array_to_string(t.nodes[a.at // 3 * 3 + 1 : a.at], '') || array_to_string(t.nodes[a.at + 2 : a.at // 3 * 3 + 3], ''),
    sha256(array_to_string(t.nodes[a.at // 3 * 3 + 1 : a.at], '') || a.node || array_to_string(t.nodes[a.at + 2 : a.at // 3 * 3 + 3], '')), a.at // 3
  FROM a JOIN t ON a.source IS NOT DISTINCT FROM t.source AND a.level = t.level WHERE len(t.nodes) > 1),
b AS (SELECT a.doc_id, a.leaf, s.subroot, a.proof, a.node, s.place AS at, 0 AS level FROM a JOIN s ON a.source IS NOT DISTINCT FROM s.source JOIN (SELECT source, max(level) AS level FROM t GROUP BY source) e ON a.source IS NOT DISTINCT FROM e.source AND a.level = e.level
  UNION ALL SELECT b.doc_id, b.leaf, b.subroot,
    b.proof || array_to_string(u.nodes[b.at // 3 * 3 + 1 : b.at], '') || array_to_string(u.nodes[b.at + 2 : b.at // 3 * 3 + 3], ''),
    sha256(array_to_string(u.nodes[b.at // 3 * 3 + 1 : b.at], '') || b.node || array_to_string(u.nodes[b.at + 2 : b.at // 3 * 3 + 3], '')), b.at // 3, b.level + 1
  FROM b JOIN u ON b.level = u.level WHERE len(u.nodes) > 1),
r AS (SELECT level, nodes[1] AS root FROM u WHERE len(nodes) = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified FROM b JOIN r ON b.level = r.level
"""
