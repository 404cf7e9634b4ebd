"""Stamps of a build's tables: digests of key ranges in a tree, compared from the root down to the ranges that differ.

A digest is of sums over rows, so a node's is that of its children's sums, and the root's that of the whole table
(`answers.table_digest`), whatever the order and partitioning of the rows. Ranges are fixed by the keys alone; a build and the present
tables have the same ones.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.answers import digest_of, fingerprint, hash_sums, row_hash, stale

from .shared import cut

#: Positions in a leaf, children of a node, and levels below the root.
WIDTH, FAN, LEVELS = 4096, 64, 4
#: Ranges of a table that an error names.
NAMED = 20


def position(df: DataFrame, key: str) -> Column:
    """Where a row's key lies: whole numbers as they are, dates by day, all else by 32 bits of its text's MD5; null has no position."""
    kind, c = df.schema[key].dataType, F.col(f"`{key}`")
    if isinstance(kind, T.IntegralType):
        return c.cast("long")
    return F.unix_date(c).cast("long") if isinstance(kind, T.DateType) else F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("long")


def digest_tree(df: DataFrame, key: str, width: int = WIDTH, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """(level, node, rows, digest): level 0 has leaves of `width` positions, each level above nodes of `fan` children, and level `levels` the root.

    A node is named by its positions' quotient. Rows without a key make a branch whose nodes are null, the root is null as well. Keys need not be
    unique; a range with very many rows is no more work, as rows are added up before the shuffle. The table is read once, its leaves are added up for all
    levels together. An empty table has only a root.
    """
    at = [F.floor(F.col("position") / F.lit(width * fan**i)).cast("long") for i in range(levels)]
    leaves = df.select(position(df, key).alias("position"), row_hash(df.columns).alias("h")).groupBy(at[0].alias("n0")).agg(F.count("*").alias("rows"), *hash_sums("h"))
    names = [f"n{i}" for i in range(levels)]
    # an empty leaf, so that an empty table has a root too
    zero = df.sparkSession.range(1).select(F.lit(None).cast("long").alias("n0"), F.lit(0).cast("long").alias("rows"), *(F.lit(0).cast("decimal(38,0)").alias(s) for s in ("s1", "s16")))
    path = leaves.unionByName(zero).withColumns({f"n{i}": F.floor(F.col("n0") / F.lit(fan**i)).cast("long") for i in range(1, levels)})
    # a level's rows have the columns of the levels below rolled up
    level = F.bit_count(F.grouping_id())
    added = path.rollup(*reversed(names)).agg(level.alias("level"), F.sum("rows").alias("rows"), *(F.sum(s).cast("decimal(38,0)").alias(s) for s in ("s1", "s16")))
    node = F.coalesce(*(F.when(F.col("level") == i, F.col(n)) for i, n in enumerate(names)))
    return added.where((F.col("rows") > 0) | (F.col("level") == levels)).select("level", node.alias("node"), "rows", digest_of("rows", "s1", "s16").alias("digest"))


def changed_ranges(built: DataFrame, now: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """(node, built_rows, rows) of the leaves that differ between two trees; no leaf has zero rows.

    Each level reads only the children of nodes that differ above. Both trees are read once for each level: give written or checkpointed
    ones, as a tree that is only planned would read its table as often.
    """
    differ = None
    for level in range(levels, -1, -1):
        sides = []
        for tree in (built, now):
            nodes = tree.where(F.col("level") == level).select("node", "rows", "digest")
            if differ is not None:
                # the root has all nodes below it, with and without a position
                above = F.lit(True) if level == levels - 1 else F.floor(nodes["node"] / F.lit(fan)).cast("long").eqNullSafe(differ["above"])
                nodes = nodes.join(differ, above, "left_semi")
            sides.append(nodes)
        old, new = sides[0].alias("old"), sides[1].alias("new")
        both = old.join(new, F.col("old.node").eqNullSafe(F.col("new.node")), "full_outer").where(~F.col("old.digest").eqNullSafe(F.col("new.digest")))
        found = both.select(F.coalesce("old.node", "new.node").alias("node"), *(F.coalesce(f"{s}.rows", F.lit(0).cast("long")).alias(n) for s, n in (("old", "built_rows"), ("new", "rows"))))
        differ = found.select(F.col("node").alias("above"))
    return found


@dataclass(frozen=True)
class Stamp:
    """Where a build's stamp is, a key column for each table, and all else that answers depend on: versions, hashes of schemas and files."""

    path: str
    keys: Mapping[str, str]
    parts: Mapping[str, str] = field(default_factory=dict)


def _trees(spark: SparkSession, path: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{path}/trees/{table}")


def write_stamp(tables: Mapping[str, DataFrame], stamp: Stamp) -> str:
    """Write the trees of all tables, then the parts with their fingerprint, without which a stamp does not count; a stamp is written once.

    Trees are in folders by level, so that a comparison reads only the levels that it comes to.
    """
    spark = next(iter(tables.values())).sparkSession
    parts = dict(stamp.parts)
    for name, key in sorted(stamp.keys.items()):
        digest_tree(tables[name], key).write.partitionBy("level").mode("errorifexists").parquet(f"{stamp.path}/trees/{name}")
        parts[f"table {name}"] = _trees(spark, stamp.path, name).where(F.col("level") == LEVELS).first().digest
    made = fingerprint(parts)
    spark.createDataFrame([*parts.items(), ("fingerprint", made)], "part string, value string").coalesce(1).write.mode("errorifexists").parquet(f"{stamp.path}/parts")
    return made


def differences(tables: Mapping[str, DataFrame], stamp: Stamp) -> list[str]:
    """What differs between a stamp and the present tables and parts, with the first ranges of positions of each table; empty if the build is fresh."""
    spark = next(iter(tables.values())).sparkSession
    built = {r.part: r.value for r in spark.read.parquet(f"{stamp.path}/parts").collect()}
    made = built.pop("fingerprint", None)
    out = [] if made == fingerprint(built) else ["the stamp's fingerprint is not that of its parts"]
    tables_of = {k.removeprefix("table "): v for k, v in built.items() if k.startswith("table ")}
    out += stale({k: v for k, v in built.items() if not k.startswith("table ")}, stamp.parts)
    out += [f"{name}: the stamp has no such table" for name in sorted(set(stamp.keys) - set(tables_of))]
    for name, digest in sorted(tables_of.items()):
        if name not in tables or name not in stamp.keys:
            out.append(f"{name}: the table is missing")
            continue
        old = _trees(spark, stamp.path, name)
        if old.where(F.col("level") == LEVELS).first().digest != digest:
            out.append(f"{name}: the stamp's tree is not that of its parts")
        now = cut(digest_tree(tables[name], stamp.keys[name]))
        found = changed_ranges(old, now).orderBy("node").limit(NAMED + 1).collect()
        said = [f"{'without a key' if r.node is None else f'{r.node * WIDTH} to {(r.node + 1) * WIDTH - 1}'} ({r.built_rows} rows, now {r.rows})" for r in found[:NAMED]]
        out += [f"{name}: " + ", ".join(said) + (" and more" if len(found) > NAMED else "")] if said else []
    return out


def require_fresh_tables(tables: Mapping[str, DataFrame], stamp: Stamp) -> None:
    """An error that names what changed since the stamp."""
    if found := differences(tables, stamp):
        raise RuntimeError("the build is stale: " + "; ".join(found))
