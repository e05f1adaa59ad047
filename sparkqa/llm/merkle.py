"""Merkle manifest of a dataset: a nested-struct rollup over the digits of each row's rank.

Every row becomes a leaf digest.  Inside its group (a language) rows are ranked by id; the rank is a
block number and ``BITS`` binary digits.  A block is rolled up by grouping the last digit away, then
the one before it, and so on: each grouping nests two child structs into their parent's struct and
hashes their digests.  Rows are dealt by (group, block) once, and all groupings of a block run where
its rows are.  A rolled-up block is one row of at most ``2 ** BITS`` leaves, however large a group
is.  The blocks' own digests are ranked by block number and rolled up alike until a group has one
block left; then the groups' roots are.  On the way back a block's struct is taken apart by nested
transforms, which know the siblings at every level, and exploded into its children with their proofs;
what a block needs from above reaches it by a grouping of (block, path from above).  Nothing is joined
on a leaf.

Edge cases: nulls hash as ``-`` in any column; rows that repeat an id are ordered by their leaf's
digest, equal rows in any order (each has its own place and proof); null ids come first in their
language and are never tampered with; null languages come first; an empty table gives an empty
result; columns that are not leaf columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkqa.llm.common import materialize, parallel
from sparkqa.operators.util import global_row_number

BITS = 8
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FEW = 100_000  # rows of partition offsets that are broadcast; joined beyond
_STEPS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(c: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaves(docs: DataFrame, columns: tuple[str, ...] = LEAF_COLUMNS, key: str = "doc_id", group: str = "lang",
           tampered: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """key, group, leaf, tampered_leaf: one narrow row a row.  ``tampered`` has the changed value of
    columns; the changed leaf is null except ``where``."""
    own = [F.col(c) for c in columns]
    changed = [(tampered or {}).get(c, F.col(c)) for c in columns]
    other = F.when(F.coalesce(where, F.lit(False)), digest(*map(field, changed))) if where is not None else F.lit(None).cast("string")
    return docs.select(F.col(key).alias("key"), F.col(group).cast("string").alias("group"), digest(*map(field, own)).alias("leaf"),
                       other.alias("tampered_leaf"))


def ranked(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` (key, group, leaf, ...) with ``g`` (the group's number, by name, null first), ``rank`` (from 0
    inside the group, by key and leaf) and ``n`` (the group's size), and ``groups`` (group, g, n).

    Rows are range-sorted over the cluster; a group's ranks start anew from the counts of its parts
    in the partitions before, so no task holds a whole group.
    """
    spark = rows.sparkSession
    rows = materialize(rows, "merkle-leaves")
    order = [F.col("group").asc_nulls_first(), F.col("key").asc_nulls_first(), "leaf", "spread"]
    # equal rows are told apart, so that any number of them can be cut by the range bounds
    spread = rows.withColumn("spread", F.monotonically_increasing_id())
    placed = spread.repartitionByRange(parallel(spark), *order).sortWithinPartitions(*order).drop("spread")
    placed = materialize(placed.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "merkle-ranked")
    parts = placed.groupBy("group", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    sizes = parts.groupBy("group").agg(F.sum("rows").alias("n"))
    groups = materialize(global_row_number(sizes, [F.col("group").asc_nulls_first()], "g"), "merkle-groups")
    before = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("off", F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")) \
        .join(groups.select(F.col("group").alias("_g"), "g", "n"), F.col("group").eqNullSafe(F.col("_g"))) \
        .select(F.col("group").alias("_group"), F.col("part").alias("_part"), "off", "g", "n")
    parts = materialize(parts, "merkle-parts")
    if parts.count() <= FEW:
        parts = F.broadcast(parts)
    same = F.col("group").eqNullSafe(F.col("_group")) & (F.col("part") == F.col("_part"))
    out = placed.join(parts, same).withColumn("rank", F.col("at") + F.col("off"))
    return out.drop("part", "at", "off", "_group", "_part"), groups


def roll(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """``g, block, n, tree``: nodes (g, n, rank, node struct with ``digest``) rolled up into blocks of ``2 ** bits``.

    A tree is a struct (digest, children); a child is a struct (digit, node), and nodes at the bottom
    are those given.  A level of a group that has a single node left is passed through, unhashed.
    """
    digits = [f"d{j}" for j in range(bits)]
    d = nodes.select("g", F.shiftright("rank", bits).alias("block"), "n",
                     *[F.shiftright("rank", j).bitwiseAND(F.lit(1)).cast("tinyint").alias(x) for j, x in enumerate(digits)], "node")
    d = d.repartition(parallel(nodes.sparkSession), "g", "block")
    for j, x in enumerate(digits):
        child = F.sort_array(F.collect_list(F.struct(F.col(x).alias("digit"), F.col("node"))))
        d = d.groupBy("g", "block", "n", *digits[j + 1:]).agg(child.alias("children"))
        below = F.transform("children", lambda c: c["node"]["digest"])
        # of n nodes, 2 ** j to one are left here; a lone one is not hashed again
        own = F.when(F.col("n") > F.lit(1 << j), digest(F.array_join(below, ""))).otherwise(below[0])
        d = d.select("g", "block", "n", *digits[j + 1:], F.struct(own.alias("digest"), F.col("children")).alias("node"))
    return d.withColumnRenamed("node", "tree")


def unroll(blocks: DataFrame, bits: int = BITS) -> DataFrame:
    """The bottom nodes of ``blocks`` (g, block, n, tree, above) as ``g, rank, node, steps, above``: the siblings left and
    right of the way from the node up to the group's root, the part inside the block in front."""

    def down(tree: Column, level: int, at: Column, steps: Column) -> Column:
        """array<struct<node, rank, steps>> of what is below ``tree``, whose children are at ``level``."""
        def one(c: Column) -> Column:
            side = lambda d: F.array_join(F.transform(F.filter(tree["children"], lambda s: s["digit"] == d), lambda s: s["node"]["digest"]), "")
            own = c["digit"].cast("bigint")
            step = F.struct(F.when(own == 1, side(0)).otherwise(F.lit("")).alias("left"), F.when(own == 0, side(1)).otherwise(F.lit("")).alias("right"))
            here = F.concat(F.when(F.col("n") > F.lit(1 << level), F.array(step)).otherwise(F.array().cast(_STEPS)), steps)
            place = at * 2 + own
            if level == 0:
                return F.array(F.struct(c["node"].alias("node"), place.alias("rank"), here.alias("steps")))
            return down(c["node"], level - 1, place, here)
        return F.flatten(F.transform(tree["children"], one))

    d = blocks.select("g", "above", F.explode(down(F.col("tree"), bits - 1, F.col("block"), F.col("above")["steps"])).alias("x"))
    return d.select("g", F.col("x.rank").alias("rank"), F.col("x.node").alias("node"), F.col("x.steps").alias("steps"), "above")


def _meet(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Blocks with what their place above tells them: rows of (g, block) grouped, one of each side."""
    kinds = {f.name: f.dataType for f in blocks.schema.fields} | {"above": paths.schema["above"].dataType}
    fill = lambda d: d.select(*[F.col(c) if c in d.columns else F.lit(None).cast(kinds[c]).alias(c) for c in ("g", "block", "n", "tree", "above")])
    both = fill(blocks).unionByName(fill(paths))
    return both.groupBy("g", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "tree", "above")])


def _climb(nodes: DataFrame, most: int, bits: int) -> list[DataFrame]:
    """Rolled-up blocks, level by level, until each group (of at most ``most`` nodes) has one block."""
    levels = []
    while True:
        level = materialize(roll(nodes, bits), "merkle-blocks")
        levels.append(level)
        most = -(-most >> bits)
        if most <= 1:
            return levels
        nodes = level.select("g", ((F.col("n") + F.lit((1 << bits) - 1)) / F.lit(1 << bits)).cast("bigint").alias("n"),
                             F.col("block").alias("rank"), F.struct(F.col("tree.digest").alias("digest")).alias("node"))


def _descend(levels: list[DataFrame], above: DataFrame, bits: int) -> DataFrame:
    """``unroll`` of the lowest level; ``above`` (g, block, above) is for the top one."""
    for level in reversed(levels):
        out = unroll(_meet(level, above), bits)
        steps = F.col("above").withField("steps", F.col("steps"))
        above = out.select("g", F.col("rank").alias("block"), steps.alias("above"))
    return out


def manifest(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """The manifest of ``leaves`` rows: key, group, leaf, subroot, root, steps (struct<left, right> from the leaf to the root),
    proof_sha256, folded_root (from the tampered leaf, else the leaf), verified."""
    placed, groups = ranked(rows)
    nodes = placed.select("g", "n", "rank", F.struct(F.col("leaf").alias("digest"), "key", "group", "tampered_leaf").alias("node"))
    most, count = groups.agg(F.max("n"), F.count(F.lit(1))).first()
    levels = _climb(nodes, most or 0, bits)
    # the groups' roots are the nodes of one tree more
    tops = levels[-1].select(F.lit(0).cast("bigint").alias("g"), F.lit(count).cast("bigint").alias("n"), F.col("g").alias("rank"),
                             F.struct(F.col("tree.digest").alias("digest")).alias("node"))
    over = _climb(tops, count, bits)
    none = F.lit(None).cast("string")
    start = over[-1].select("g", "block", F.struct(F.array().cast(_STEPS).alias("steps"), none.alias("subroot"), F.col("tree.digest").alias("root")).alias("above"))
    roots = _descend(over, start, bits)
    paths = roots.select(F.col("rank").alias("g"), F.lit(0).cast("bigint").alias("block"),
                         F.struct("steps", F.col("node.digest").alias("subroot"), F.col("above.root").alias("root")).alias("above"))
    out = _descend(levels, paths, bits)
    proof = F.transform("steps", lambda s: F.concat(s["left"], s["right"]))
    folded = F.aggregate("steps", F.coalesce("node.tampered_leaf", "node.digest"), lambda x, s: digest(s["left"], x, s["right"]))
    d = out.select(F.col("node.key").alias("key"), F.col("node.group").alias("group"), F.col("node.digest").alias("leaf"), "above.subroot", "above.root", "steps",
                   digest(F.array_join(proof, "")).alias("proof_sha256"), folded.alias("folded_root"))
    return d.withColumn("verified", F.col("folded_root") == F.col("root"))


def proven(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """The manifest of a documents table in which every seventh id (by CRC-32) claims one character more."""
    crc = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8"))
    rows = leaves(docs, tampered={"n_chars": F.col("n_chars") + 1}, where=(crc % 7 == 0) & F.col("n_chars").isNotNull())
    return manifest(rows, bits).withColumnRenamed("key", "doc_id").withColumnRenamed("group", "lang")
