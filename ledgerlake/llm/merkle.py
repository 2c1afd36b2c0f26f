"""Merkle manifest of a table, and versions of it by path copying.

Rows are leaves, hashed over their columns.  The leaves of a group (a source)
ascend by id; every 16 consecutive nodes become one, until one is left: the
group's subroot.  The subroots, by group, become the root in the same way.

The tree is persistent: no node is ever changed.  A tampered leaf makes a
version of its own, which shares all untouched nodes and copies the ancestors
of its leaf only.  Nodes live in aligned blocks of 256 (two levels).  A block is
one small group of a Spark task, which builds its nodes, or copies the ancestors
of its leaves; the blocks' tops are the nodes of the next tier, until each group
has one.  Going down again, each block learns the path above it (the siblings
of its ancestors, a few KB), so a version goes on from the top of its block to
the root wherever its row lies: no task gathers the versions of an upper node.

Every digest is SHA-256 in lower-case hex over concatenated text; digests enter
as hex text.  Nulls are leaves' values like others; a null group comes first.
Rows with equal ids are ordered by their leaf; equal rows are leaves each.  An
empty table has no leaf and no root.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import materialise
from ledgerlake.llm.places import places

FAN = 16
BLOCK = FAN * FAN
HEX = 64
STEP = "array<struct<tree string, level int, place long, left string, right string>>"


def leaf_of(columns: list[Column]) -> Column:
    """The leaf of a row: each value as its number of UTF-8 bytes, ``:`` and the value; ``-`` for null."""
    def part(c: Column) -> Column:
        own = c.cast("string")
        return F.when(own.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(own).cast("string"), F.lit(":"), own))
    return F.sha2(F.concat(*map(part, columns)).cast("binary"), 256)


def tree_of(group: Column) -> Column:
    """A name of the group that orders like it, null first."""
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), group.cast("string")))


def digest(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def raise_block(nodes: list[bytes], size: int) -> list[list[bytes]]:
    """The nodes of one block, level by level up: two levels, or as many as its tree has left.
    ``size``: nodes of the whole tree on the block's level."""
    out = [nodes]
    while len(out) < 3 and size > 1:
        below = out[-1]
        out.append([digest(*below[i:i + FAN]) for i in range(0, len(below), FAN)])
        size = -(-size // FAN)
    return out


def tier_above(size: int) -> int:
    """Nodes that a tree has above its blocks."""
    for _ in range(2):
        size = -(-size // FAN) if size > 1 else size
    return size


@dataclass
class Forest:
    """Trees by tiers: ``tiers[t]`` holds (tree, place, size, digest) on level 2 t, written tables;
    ``inner[t]`` the nodes between tier t and the next, (tree, level, place, digest)."""
    tiers: list[DataFrame] = field(default_factory=list)
    inner: list[DataFrame] = field(default_factory=list)

    def tops(self) -> DataFrame:
        """(tree, digest, tier) of each tree's last node."""
        out = None
        for t, nodes in enumerate(self.tiers):
            own = nodes.where("size = 1").select("tree", "digest", F.lit(t).alias("tier"))
            out = own if out is None else out.unionByName(own)
        return out


def _in_order(table: pa.Table) -> tuple[list[int], list[bytes]]:
    at = table.column("place").to_pylist()
    own = table.column("digest").to_pylist()
    order = sorted(range(len(at)), key=at.__getitem__)
    return order, [own[i].encode() for i in order]


def grow(leaves: DataFrame, name: str) -> Forest:
    """The trees of written ``leaves`` (tree, place, size, digest), a tier a job.  A task takes
    blocks of at most 256 nodes, so a tree of any size is spread over all of them."""
    forest = Forest([leaves])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, own = _in_order(table)
        tree, block = (x.as_py() for x in key)
        size = table.column("size")[0].as_py()
        levels = raise_block(own, size)
        middle = [x.decode() for x in levels[1]] if len(levels) == 3 else None
        return pa.table({"tree": [tree], "place": [block], "size": [tier_above(size)], "digest": [levels[-1][0].decode()],
                         "middle": pa.array([middle], pa.list_(pa.string()))})

    most = leaves.agg(F.max("size")).first()[0] or 0
    while most > 1:
        t, nodes = len(forest.tiers) - 1, forest.tiers[-1]
        made = materialise(
            nodes.where("size > 1").withColumn("block", F.expr(f"place div {BLOCK}")).groupBy("tree", "block")
            .applyInArrow(run, "tree string, place long, size long, digest string, middle array<string>"), f"{name}-tier")
        forest.tiers.append(made.drop("middle"))
        below = made.select("tree", F.lit(2 * t + 1).alias("level"), (F.col("place") * FAN).alias("first"),
                            F.posexplode("middle").alias("i", "digest"))
        forest.inner.append(below.select("tree", "level", (F.col("first") + F.col("i")).alias("place"), "digest"))
        most = tier_above(most)
    return forest


def steps_of(own: list[bytes], first: int, size: int, level: int, tree: str | None) -> list[list[tuple]]:
    """For each node of a block, its way to the block's top: (tree, level, place, left, right) of each
    ancestor, with the text of the siblings at its sides."""
    out: list[list[tuple]] = [[] for _ in own]
    for up, nodes in enumerate(raise_block(own, size)[:-1]):
        for run in range(0, len(nodes), FAN):
            text = b"".join(nodes[run:run + FAN]).decode()
            parent = (first // FAN ** (up + 1)) + run // FAN
            for j in range(run, min(run + FAN, len(nodes))):
                step = (tree, level + up + 1, parent, text[:HEX * (j - run)], text[HEX * (j - run + 1):])
                width = FAN ** up
                for i in range(j * width, min((j + 1) * width, len(own))):
                    out[i].append(step)
    return out


def _steps(table: pa.Table) -> list[tuple]:
    """The path above a block, from its one row."""
    if table.num_rows != 1:
        raise ValueError("a block without the one path above it")
    return [tuple(x.values()) for x in table.column("path")[0].as_py()]


def paths(forest: Forest, above: DataFrame, name: str, down_to: int = 0, tree: bool = True) -> DataFrame:
    """(tree, place, path) of each node of tier ``down_to``: all its ancestors to the root, each with the
    siblings on the way.  ``above``: (tree, path, tier) of each tree's last node, whose tier names where it is."""
    def on_level(level: int):
        def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            order, own = _in_order(left)
            at, size = left.column("place").to_pylist(), left.column("size")[0].as_py()
            rest = _steps(right)
            own_steps = steps_of(own, at[order[0]], size, level, key[0].as_py() if tree else None)
            rows = [[dict(zip(("tree", "level", "place", "left", "right"), s, strict=True)) for s in [*steps, *rest]] for steps in own_steps]
            return pa.table({"tree": [key[0].as_py()] * len(own), "place": [at[i] for i in order], "path": pa.array(rows, PATH)})
        return run

    found = None
    for t in range(len(forest.tiers) - 1, down_to - 1, -1):
        blocks = _by_block(forest.tiers[t], _from_above(found, above, t))
        found = materialise(blocks.applyInArrow(on_level(2 * t), f"tree string, place long, path {STEP}"), f"{name}-paths")
    return found


PATH = pa.list_(pa.struct([("tree", pa.string()), ("level", pa.int32()), ("place", pa.int64()),
                           ("left", pa.string()), ("right", pa.string())]))


def _from_above(found: DataFrame | None, above: DataFrame, t: int) -> DataFrame:
    """Paths that the blocks of tier t go on with: of the nodes above, or of trees that end on this tier."""
    ended = above.where(F.col("tier") == t).select("tree", F.lit(0).cast("long").alias("block"), "path")
    return ended if found is None else ended.unionByName(found.withColumnRenamed("place", "block"))


def _by_block(nodes: DataFrame, above: DataFrame):
    blocks = nodes.withColumn("block", F.expr(f"place div {BLOCK}"))
    return blocks.groupBy("tree", "block").cogroup(above.groupBy("tree", "block"))


@dataclass
class Manifest:
    """``leaves``: the given columns with ``tree``, ``place``, ``size``, ``digest``, a written table."""
    leaves: DataFrame
    forest: Forest
    upper: Forest
    subroots: DataFrame     # tree, place (among the subroots), size, digest, tier (of the forest)

    def root(self) -> str | None:
        top = self.upper.tops().first()
        return top["digest"] if top else None

    def nodes(self) -> DataFrame:
        """(tree, level, place, digest) of every node; the tree of the subroots and above is null."""
        out = None
        for forest, name in ((self.forest, F.col("tree")), (self.upper, F.lit(None).cast("string"))):
            for t, tier in enumerate(forest.tiers):
                own = [tier.select(name.alias("tree"), F.lit(2 * t).alias("level"), "place", "digest", "size")]
                if t:       # a tree that ended half-way up the block before has its last node one level lower
                    before = forest.tiers[t - 1].where("size > 1").groupBy("tree").agg(F.first("size").alias("before"))
                    low = F.when(F.col("before") <= FAN, 2 * t - 1).otherwise(2 * t)
                    own = [tier.join(before, "tree").select(name.alias("tree"), low.alias("level"), "place", "digest", "size"),
                           forest.inner[t - 1].select(name.alias("tree"), "level", "place", "digest", F.lit(0).cast("long").alias("size"))]
                for x in own:
                    out = x if out is None else out.unionByName(x)
        return out.drop("size")


def build(rows: DataFrame, id_col: str, group_col: str, leaf_col: str = "leaf", keep: tuple[str, ...] = (),
          name: str = "merkle") -> Manifest:
    """The manifest of ``rows``: their leaves ascend by ``id_col`` in each ``group_col``."""
    named = rows.select(F.col(f"`{id_col}`").alias("id"), tree_of(F.col(f"`{group_col}`")).alias("tree"),
                        F.col(f"`{leaf_col}`").alias("digest"), *[F.col(f"`{c}`") for c in keep])
    leaves = materialise(places(named, "tree", ["id", "digest"], f"{name}-leaves"), f"{name}-placed")
    forest = grow(leaves.select("tree", "place", "size", "digest"), name)
    tops = forest.tops().withColumn("all", F.lit("all"))
    subroots = materialise(places(tops, "all", ["tree"], f"{name}-tops").drop("all"), f"{name}-subroots")
    upper = grow(subroots.select(F.lit("").alias("tree"), "place", "size", "digest"), f"{name}-upper")
    return Manifest(leaves, forest, upper, subroots)


def versions(manifest: Manifest, changed_col: str | None = None, name: str = "merkle") -> DataFrame:
    """One row per leaf: ``id``, ``leaf``, ``subroot``, ``root``, ``proof`` (the siblings' digests, level by level
    to the root, left to right, as text), ``folded_root``, and ``copies``.

    A leaf with a digest in ``changed_col`` (a kept column of the leaves) makes a version: ``copies`` are its
    nodes (tree, level, place, digest), the new leaf's ancestors; every other node is shared with the manifest.
    ``folded_root`` is the version's root; of other leaves, the root as it comes from the leaf and its siblings.
    """
    none = manifest.upper.tops().select("tree", "tier", F.expr(f"cast(array() as {STEP})").alias("path"))
    over = paths(manifest.upper, none, f"{name}-upper", tree=False).select("place", "path")
    above = manifest.subroots.select("tree", "place", "digest", "tier").join(over, "place").select("tree", "tier", "digest", "path")
    above = materialise(above, f"{name}-above")
    found = None
    if len(manifest.forest.tiers) > 1:
        found = paths(manifest.forest, above.select("tree", "tier", "path"), name, down_to=1)
    blocks = _from_above(found, above.select("tree", "tier", "path"), 0)
    blocks = blocks.join(above.select("tree", F.col("digest").alias("subroot")), "tree")
    root = manifest.root()
    id_type = dict(manifest.leaves.dtypes)["id"]
    kind = pa.list_(pa.struct([("tree", pa.string()), ("level", pa.int32()), ("place", pa.int64()), ("digest", pa.string())]))

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        order, own = _in_order(left)
        size, first = left.column("size")[0].as_py(), left.column("place")[order[0]].as_py()
        rest = _steps(right)
        rest_sides = [(s[3].encode(), s[4].encode()) for s in rest]
        rest_proof = b"".join(a + b for a, b in rest_sides)
        new = left.column("changed").to_pylist()
        proof, folded, copies = [], [], []
        for i, leaf, steps in zip(order, own, steps_of(own, first, size, 0, key[0].as_py()), strict=True):
            sides = [(s[3].encode(), s[4].encode()) for s in steps]
            proof.append((b"".join(a + b for a, b in sides) + rest_proof).decode())
            at, path = leaf if new[i] is None else new[i].encode(), []
            for a, b in [*sides, *rest_sides]:
                at = digest(a, at, b)
                path.append(at.decode())
            folded.append(at.decode())
            copies.append(None if new[i] is None else [
                {"tree": s[0], "level": s[1], "place": s[2], "digest": d} for s, d in zip([*steps, *rest], path, strict=True)])
        subroot = right.column("subroot")[0].as_py()
        return pa.table({"id": left.column("id").take(pa.array(order)), "leaf": pa.array([x.decode() for x in own], pa.string()),
                         "subroot": [subroot] * len(own), "root": [root] * len(own), "proof": proof, "folded_root": folded,
                         "copies": pa.array(copies, kind)})

    changed = F.col(f"`{changed_col}`") if changed_col else F.lit(None).cast("string")
    leaves = manifest.leaves.select("id", "tree", "place", "size", "digest", changed.alias("changed"))
    return _by_block(leaves, blocks).applyInArrow(
        run, f"id {id_type}, leaf string, subroot string, root string, proof string, folded_root string, "
             "copies array<struct<tree string, level int, place long, digest string>>")
