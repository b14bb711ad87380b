"""Merkle manifest of a dataset, with inclusion proofs by pointer jumping.

Every row is a leaf; leaves of a group are numbered in order and every two
consecutive nodes become the hash of both, level by level, up to the group's
subroot.  Subroots, in the order of their groups, form the top tree.

The trees are built ``STEP`` levels at a time from blocks of 2**STEP
neighbouring nodes, a bounded group whatever the data; only hashes move.  Each
node at the bottom of a block then holds a *pointer*: the ancestor at the top of
its block and the segment of siblings on the way there.  Repeated self-joins
replace a pointer by the pointer of the ancestor that it points to and append
that one's segment, so that the distance doubles from round to round: STEP,
2 STEP, 4 STEP levels, until every leaf reaches the root.  A subroot's pointer
continues in the top tree.

Nodes are named (tree, level, place): trees are numbered by the order of the
groups, and the top tree is -1.  Proofs hold binary digests, null where a node
has no sibling; the bits of a leaf's place tell left from right.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.common import staged
from tiffin.operators.ordered import with_position

#: Levels that one block of nodes spans.
STEP = 4
TOP = -1
NODE = ["tree", "level", "place"]


def digest(text: Column) -> Column:
    """SHA-256 as binary; children are hashed as lowercase hex text."""
    return F.unhex(F.sha2(text, 256))


def hex_of(node: Column) -> Column:
    return F.lower(F.hex(node))


def field(value: Column) -> Column:
    """A field as a leaf hashes it: its length in bytes, a colon and the value; a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, fields: list[str], group_col: str, id_col: str, claimed: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, grp, node (digest of its fields) and claim.

    ``claimed`` replaces some fields' values; the digest with these is the
    claim that a proof is to verify, null where it would be the same.
    """
    def hashed(other: dict[str, Column]) -> Column:
        return digest(F.concat(*[field(other.get(f, F.col(f"`{f}`"))) for f in fields]))
    changed = [~v.eqNullSafe(F.col(f"`{f}`")) for f, v in (claimed or {}).items()]
    claim = F.when(reduce(lambda x, y: x | y, changed, F.lit(False)), hashed(claimed or {}))
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{group_col}`").cast("string").alias("grp"),
                       hashed({}).alias("node"), claim.alias("claim"))


# ---- places -------------------------------------------------------------------------------------

def places(rows: DataFrame) -> DataFrame:
    """Add tree (rank of the group, null first), place (from 0 within it) and n (leaves of the group).

    Leaves ascend by doc_id, nulls first, then by digest.  They are dealt by
    ranges of (group, doc_id, digest), so that a group of any size is spread;
    a range's rows are numbered in it and shifted by what the ranges before
    hold of the same group, a frame of one row per range and group.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("grp", "doc_id", "node")]
    dealt = staged(rows.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "merkle-leaves")
    held = dealt.groupBy("part", "grp").agg(F.count(F.lit(1)).alias("held"))
    groups = with_position(held.groupBy("grp").agg(F.sum("held").alias("n")), [F.col("grp").asc_nulls_first()], "tree")
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("part", "grp", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("shift"))
    held = held.alias("h").join(groups.alias("g"), F.expr("h.grp <=> g.grp")).select(
        F.col("h.part").alias("of_part"), F.col("h.grp").alias("of_grp"), "shift", "n", (F.col("tree") - 1).alias("tree"))
    within = F.row_number().over(Window.partitionBy("part", "grp").orderBy(*keys[1:])) - 1
    return dealt.withColumn("at", within).join(
        held, (F.col("part") == F.col("of_part")) & F.col("grp").eqNullSafe(F.col("of_grp"))).select(
        *rows.columns, "tree", (F.col("shift") + F.col("at")).cast("long").alias("place"), "n")


# ---- trees --------------------------------------------------------------------------------------

def _above(nodes: Column) -> Column:
    """The next level over a block's nodes: every two become one, a last single one too."""
    def parent(i: Column) -> Column:
        right = F.get(nodes, 2 * i + 1)
        return digest(F.concat(hex_of(F.get(nodes, 2 * i)), F.coalesce(hex_of(right), F.lit(""))))
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int")), parent)


def blocks(nodes: DataFrame) -> DataFrame:
    """One row per block of 2**STEP neighbours: tree, level, block, n, the nodes, levels 0 to STEP and the height.

    ``nodes`` has tree, level, place, n (nodes of that tree at that level)
    and node.  The block of a tree that holds no other one ends at its root.
    """
    held = nodes.groupBy("tree", "level", "n", F.shiftright("place", STEP).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("place", "node"))).alias("held"))
    held = held.select("tree", "level", "n", "block", F.col("held.node").alias("l0"))
    # levels up to the top of the block or the root of the tree
    height = reduce(lambda out, k: F.when(F.col("n") <= (1 << k), k).otherwise(out), range(STEP - 1, -1, -1), F.lit(STEP))
    held = held.withColumn("height", height)
    for k in range(STEP):
        held = held.withColumn(f"l{k + 1}", F.when(F.col("height") > k, _above(F.col(f"l{k}"))))
    return held


def block_tops(held: DataFrame) -> DataFrame:
    """The nodes at the tops of the blocks."""
    top = F.coalesce(*[F.col(f"l{k}") for k in range(STEP, -1, -1)])
    return held.select("tree", (F.col("level") + F.col("height")).alias("level"), F.col("block").alias("place"),
                       F.shiftright(F.col("n") + (1 << STEP) - 1, STEP).alias("n"), F.get(top, 0).alias("node"))


def block_pointers(held: DataFrame) -> DataFrame:
    """For each node at the bottom of a block: tree, level, place, node, its ancestor at the top and the siblings there."""
    def segment(i: Column) -> Column:
        def sibling(k: int) -> Column:
            return F.when(F.col("height") > k, F.array(F.get(F.col(f"l{k}"), F.shiftright(i, k).bitwiseXOR(F.lit(1)))))
        return F.flatten(F.filter(F.array(*[sibling(k) for k in range(STEP)]), lambda x: x.isNotNull()))
    inside = F.transform("l0", lambda node, i: F.struct(i.alias("i"), node.alias("node"), segment(i).alias("segment")))
    return held.select("tree", "level", "block", "height", F.inline(inside)).select(
        "tree", "level", (F.col("block") * (1 << STEP) + F.col("i")).alias("place"), "node", "segment",
        F.col("tree").alias("to_tree"), (F.col("level") + F.col("height")).alias("to_level"), F.col("block").alias("to_place"))


def build(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Pointers of all block bottoms, a frame for each pass from the leaves up, and the roots (tree, node)."""
    pointers, roots = [], []
    level = 0
    while True:
        held = staged(blocks(nodes), f"merkle-{name}-{level}")
        pointers.append(block_pointers(held))
        tops = block_tops(held)
        done = F.col("n") == 1
        roots.append(tops.where(done).select("tree", "level", "node"))
        nodes, level = tops.where(~done), level + STEP
        if nodes.isEmpty():
            return pointers, reduce(DataFrame.union, roots)


def jump(pointers: DataFrame, inner: DataFrame) -> DataFrame:
    """Pointers that point to where their ancestors' pointers do, with both segments one after the other."""
    to = inner.select(*[F.col(c).alias(f"in_{c}") for c in NODE], F.col("segment").alias("more"),
                      *[F.col(f"to_{c}").alias(f"next_{c}") for c in NODE], F.col("subroot").alias("in_subroot"))
    on = reduce(lambda a, b: a & b, [F.col(f"to_{c}") == F.col(f"in_{c}") for c in NODE])
    kept = [c for c in pointers.columns if c not in ("segment", "subroot", *[f"to_{c}" for c in NODE])]
    return pointers.join(to, on).select(
        *kept, F.concat("segment", "more").alias("segment"), F.coalesce("subroot", "in_subroot").alias("subroot"),
        *[F.col(f"next_{c}").alias(f"to_{c}") for c in NODE])


# ---- manifest -----------------------------------------------------------------------------------

def manifest(rows: DataFrame) -> DataFrame:
    """One row per leaf of ``leaves``: its columns, tree, place, n, subroot, root and proof.

    ``proof`` holds the binary digests of the siblings from the leaf's level
    up to the root, null where a node has no sibling; subroot and root are
    binary too.  A null group comes first, the others by their UTF-8 bytes.
    Leaves of a group ascend by doc_id, nulls first; ties are ordered by their
    digests, and rows equal throughout are leaves of their own.  Null fields
    hash as a dash, empty ones as ``0:``.  A group of one leaf has it as its
    subroot, and with one group the subroot is the root.  An empty table gives
    an empty result; columns that are no field are not read.  Texts are hashed
    where they are read and never move; only digests do.
    """
    numbered = staged(places(rows), "merkle-places")
    last_tree = numbered.agg(F.max("tree")).first()[0]
    if last_tree is None:
        none = [F.lit(None).cast("binary").alias(c) for c in ("subroot", "root")]
        return numbered.select("*", *none, F.array().cast("array<binary>").alias("proof"))
    bottom, subroots = build(numbered.select("tree", F.lit(0).alias("level"), "place", "n", "node"), "groups")
    subroots = staged(subroots, "merkle-subroots")
    tops, root = build(subroots.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("place"),
        F.lit(last_tree + 1).alias("n"), "node"), "top")
    root = root.first()  # the one root

    def pointers(df: DataFrame, ends: Column) -> DataFrame:
        return df.select(*NODE, "segment", F.lit(None).cast("binary").alias("subroot"),
                         *[F.when(~ends, F.col(f"to_{c}")).alias(f"to_{c}") for c in NODE])
    # a subroot's pointer has no siblings: it is the same node, as a leaf of the top tree
    links = subroots.select(
        "tree", "level", F.lit(0).cast("long").alias("place"), F.array().cast("array<binary>").alias("segment"),
        F.col("node").alias("subroot"), F.lit(TOP).cast("long").alias("to_tree"), F.lit(0).alias("to_level"),
        F.col("tree").alias("to_place"))
    inner = [pointers(p, F.lit(False)) for p in bottom[1:]] + [pointers(p, F.col("to_level") == root["level"]) for p in tops]
    inner = staged(reduce(DataFrame.unionByName, inner, links), "merkle-pointers")

    named = numbered.select(*rows.columns, "n", F.col("tree").alias("of_tree"), F.col("place").alias("of_place"))
    pending = named.join(pointers(bottom[0], F.lit(False)), F.expr("tree = of_tree AND place = of_place")).drop("of_tree", "of_place")
    done, ended = [], F.col("to_tree").isNull()
    while True:
        pending = staged(jump(pending, inner), "merkle-leaf-pointers")
        done.append(pending.where(ended))
        pending = pending.where(~ended)
        if pending.isEmpty():
            break
        inner = staged(jump(inner.where(~ended), inner).unionByName(inner.where(ended)), "merkle-pointers")
    return reduce(DataFrame.unionByName, done).select(
        *rows.columns, "tree", "place", "n", "subroot", F.lit(bytes(root["node"])).alias("root"), F.col("segment").alias("proof"))


def fold(leaf: Column, place: Column, n: Column, tree: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give: lowercase hex."""
    # levels of the group's tree: the bits of n - 1
    height = F.length(F.regexp_replace(F.bin(n - 1), "^0$", ""))
    level = F.struct(hex_of(leaf).alias("node"), F.lit(0).alias("k"))

    def up(acc: Column, sibling: Column) -> Column:
        low = acc["k"] < height
        at = F.when(low, place).otherwise(tree)
        right = F.getbit(at, F.when(low, acc["k"]).otherwise(acc["k"] - height)) == 1
        other = F.coalesce(hex_of(sibling), F.lit(""))
        text = F.when(right, F.concat(other, acc["node"])).otherwise(F.concat(acc["node"], other))
        return F.struct(F.sha2(text, 256).alias("node"), (acc["k"] + 1).alias("k"))
    return F.aggregate(proof, level, up, lambda acc: acc["node"])


def proof_text(proof: Column) -> Column:
    """The siblings of a proof as one hex text, level by level."""
    return F.array_join(F.transform(F.filter(proof, lambda s: s.isNotNull()), hex_of), "")
