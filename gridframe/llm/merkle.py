"""A Merkle manifest of a dataset: one tree of row digests per group, one tree over the groups' roots.

Rows get dense positions in their group's tree. Aligned blocks of positions, whole subtrees, are folded by one task
each; the roots of the blocks are the leaves of the next round, until every group has one root. What each block has
above it (the siblings on its way to the root) is then handed down the same rounds.

Blocks are persistent trees: nodes are only ever added. A changed leaf makes a version of its block by copying its own
ancestors and sharing all other nodes; the version goes on above its block along the siblings handed down, in the task
of the block, so the versions of a dataset are spread as its leaves are and no upper node gathers them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.session import cut

#: Columns that building and proving make.
_PLACE = ("tree", "pos", "total", "digest")
_PROOF = ("subroot", "root", "proof_sha256", "folded_root", "copied")

_NODE = "tree string, pos long, total long, digest string"


def row_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of the values' texts, each as its number of bytes, a colon and the text, or ``-`` for null."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def join_digests(digests: Sequence[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def rounds_up(total: int, fan: int, most: int) -> int:
    """Levels from ``total`` nodes to one, at most ``most``."""
    up = 0
    while total > 1 and up < most:
        total, up = -(-total // fan), up + 1
    return up


class Block:
    """A subtree whose nodes are numbered as they are added and never changed; a version is the number of its root."""

    def __init__(self, digests: Sequence[str], fan: int, up: int) -> None:
        self.fan, self.up = fan, up
        self.digests = list(digests)
        self.children: list[tuple[int, ...]] = [()] * len(self.digests)
        level = range(len(self.digests))
        for _ in range(up):
            level = [self._add(tuple(level[i : i + fan])) for i in range(0, len(level), fan)]
        self.root = level[0]

    def _add(self, children: tuple[int, ...]) -> int:
        self.children.append(children)
        self.digests.append(join_digests([self.digests[c] for c in children]))
        return len(self.digests) - 1

    def way(self, root: int, at: int) -> list[tuple[int, int]]:
        """Nodes above leaf ``at``, the lowest first, each with the place of the child on the way."""
        node, found = root, []
        for level in range(self.up - 1, -1, -1):
            place = at // self.fan**level % self.fan
            found.append((node, place))
            node = self.children[node][place]
        return found[::-1]

    def siblings(self, root: int, at: int) -> list[tuple[str, str]]:
        """Digests left and right of the way from leaf ``at`` to the root, level by level."""
        found = []
        for node, place in self.way(root, at):
            digests = [self.digests[c] for c in self.children[node]]
            found.append(("".join(digests[:place]), "".join(digests[place + 1 :])))
        return found

    def replaced(self, root: int, at: int, digest: str) -> int:
        """A version of ``root`` with another digest at leaf ``at``: the leaf and its ancestors are new, the rest is
        shared."""
        way = self.way(root, at)
        self.children.append(())
        self.digests.append(digest)
        node = len(self.digests) - 1
        for above, place in way:
            children = self.children[above]
            node = self._add((*children[:place], node, *children[place + 1 :]))
        return node


def fold(digest: str, siblings: Sequence[tuple[str, str]]) -> str:
    for left, right in siblings:
        digest = join_digests([left, digest, right])
    return digest


def _written(siblings: Sequence[tuple[str, str]]) -> str:
    return "".join(f"{left},{right};" for left, right in siblings)


def _read(path: str) -> list[tuple[str, str]]:
    return [tuple(step.split(",")) for step in path.split(";")[:-1]]


@dataclass(frozen=True)
class Manifest:
    """``levels[0]`` are the rows with their place, ``levels[k]`` the roots of the k-th round of blocks (``tree, pos,
    total, digest``); ``top`` is the same for the tree over the groups' roots, in which ``name`` is the group."""

    levels: list[DataFrame]
    top: list[DataFrame]
    fan: int
    depth: int

    def root(self) -> str | None:
        """The digest of the whole dataset; none without rows."""
        row = self.top[-1].select("digest").first()
        return row["digest"] if row else None


def _placed(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` with their dense position in their tree and the tree's size.

    One sort by tree and order splits a tree that holds most rows over many tasks; the rows before each part of a tree
    are counted from one row per part.
    """
    sorted_ = cut(nodes.orderBy("tree", *order).withColumn("_seq", F.monotonically_increasing_id()))
    part, at = F.shiftright("_seq", 33), F.col("_seq").bitwiseAND(F.lit((1 << 33) - 1))
    rows = sorted_.select(*nodes.columns, part.alias("_part"), at.alias("_at"))
    runs = rows.groupBy("tree", "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_low"))
    tree = Window.partitionBy("tree")
    before = F.sum("_n").over(tree.orderBy("_part")) - F.col("_n") - F.col("_low")
    runs = runs.select("tree", "_part", before.alias("_shift"), F.sum("_n").over(tree).alias("total"))
    placed = rows.join(runs, ["tree", "_part"])
    return placed.select(*nodes.columns, (F.col("_at") + F.col("_shift")).alias("pos"), "total")


def _in_blocks(nodes: DataFrame, fan: int, depth: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / F.lit(fan**depth)).cast("long"))


def _climb(leaves: DataFrame, fan: int, depth: int) -> list[DataFrame]:
    """The leaves and, round by round, the roots of their blocks, up to one node per tree."""

    def folded(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        total = table["total"][0].as_py()
        block = Block(table["digest"].to_pylist(), fan, rounds_up(total, fan, depth))
        row = [[key[0].as_py()], [key[1].as_py()], [-(-total // fan**depth)], [block.digests[block.root]]]
        return pa.table(dict(zip(("tree", "pos", "total", "digest"), row)))

    levels = [leaves]
    while (levels[-1].agg(F.max("total")).first()[0] or 0) > 1:
        nodes = _in_blocks(levels[-1].select("tree", "pos", "total", "digest"), fan, depth)
        levels.append(cut(nodes.groupBy("tree", "block").applyInArrow(folded, _NODE)))
    return levels


def build(rows: DataFrame, tree: str, order: Sequence[str], digest: str = "leaf", fan: int = 2, depth: int = 12) -> Manifest:
    """The manifest of ``rows``, which hold a digest each.

    The leaves of a tree ascend by ``order``, then by digest: rows that repeat whole are neighbours, and which of them
    comes first changes nothing. Trees are ordered by the bytes of their name, null first, and a null name is a tree of
    its own. While a tree has several nodes, every ``fan`` consecutive ones (the last run may have fewer) become their
    digest. A block is ``fan ** depth`` leaves, what one task holds at a time. No rows give no root. Columns named like
    those made here or by :func:`prove` are replaced.
    """
    name = F.coalesce(F.concat(F.lit("1"), F.col(tree)), F.lit("0"))
    kept = [c for c in rows.columns if c not in (*_PLACE, *_PROOF)]
    leaves = rows.select(*kept, F.col(digest).alias("digest"), name.alias("tree"))
    levels = _climb(cut(_placed(leaves, [*order, "digest"])), fan, depth)
    groups = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    return Manifest(levels, _climb(cut(_placed(groups, ["name"])), fan, depth), fan, depth)


def _above(nodes: DataFrame, above: DataFrame, fan: int, depth: int) -> DataFrame:
    """``nodes`` with what each has above it, from what its block has above it."""

    def handed_down(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("pos")
        block = Block(left["digest"].to_pylist(), fan, rounds_up(left["total"][0].as_py(), fan, depth))
        head = {c: right[c][0] for c in ("subroot", "root", "path")}
        paths = [_written(block.siblings(block.root, at)) + head["path"].as_py() for at in range(len(left))]
        out = left.drop_columns(["block"])
        for c in ("subroot", "root"):
            out = out.append_column(c, pa.array([head[c].as_py()] * len(left), pa.string()))
        return out.append_column("path", pa.array(paths, pa.string()))

    schema = T.StructType([*nodes.schema.fields, *[T.StructField(c, T.StringType()) for c in ("subroot", "root", "path")]])
    cells = _in_blocks(nodes, fan, depth).groupBy("tree", "block")
    return cells.cogroup(above.withColumnRenamed("pos", "block").groupBy("tree", "block")).applyInArrow(handed_down, schema)


def _handed_down(levels: list[DataFrame], above: DataFrame, fan: int, depth: int) -> DataFrame:
    """What the blocks of the leaves have above them, from what the trees' roots have above them."""
    for nodes in levels[:0:-1][1:]:
        above = cut(_above(nodes.select("tree", "pos", "total", "digest"), above, fan, depth).select("tree", "pos", "subroot", "root", "path"))
    return above


def prove(manifest: Manifest, changed: str | None = None) -> DataFrame:
    """The rows of the manifest with ``subroot, root, proof_sha256, folded_root, copied``.

    ``proof_sha256`` is the digest of the siblings on the way from the leaf to the root, ``folded_root`` what the way
    gives from the row's digest or, where ``changed`` names a column that holds one, from that digest: then a version of
    the row's block is made, ``copied`` nodes of which are new up to the dataset's root (0 otherwise).
    """
    fan, depth = manifest.fan, manifest.depth
    top = manifest.top[-1].select("tree", "pos", F.col("digest").alias("subroot"), F.col("digest").alias("root"), F.lit("").alias("path"))
    groups = _above(manifest.top[0], _handed_down(manifest.top, top, fan, depth), fan, depth)
    tops = groups.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), F.col("digest").alias("subroot"), "root", "path")
    above = _handed_down(manifest.levels, cut(tops), fan, depth)
    leaves = manifest.levels[0]
    kept = [c for c in leaves.columns if c not in _PLACE]

    def proven(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("pos")
        digests = left["digest"].to_pylist()
        block = Block(digests, fan, rounds_up(left["total"][0].as_py(), fan, depth))
        upper = _read(right["path"][0].as_py())
        others = left[changed].to_pylist() if changed else [None] * len(digests)
        proofs, roots, copied = [], [], []
        for at, (digest, other) in enumerate(zip(digests, others)):
            siblings = block.siblings(block.root, at)
            proofs.append(join_digests([side for step in [*siblings, *upper] for side in step]))
            if other is None:
                roots.append(fold(digest, [*siblings, *upper]))
                copied.append(0)
            else:
                size = len(block.digests)
                version = block.replaced(block.root, at, other)
                roots.append(fold(block.digests[version], upper))
                copied.append(len(block.digests) - size + len(upper))
        out = left.select(kept)
        for c in ("subroot", "root"):
            out = out.append_column(c, pa.array([right[c][0].as_py()] * len(digests), pa.string()))
        out = out.append_column("proof_sha256", pa.array(proofs, pa.string()))
        return out.append_column("folded_root", pa.array(roots, pa.string())).append_column("copied", pa.array(copied, pa.int64()))

    texts = [T.StructField(c, T.StringType()) for c in ("subroot", "root", "proof_sha256", "folded_root")]
    schema = T.StructType([*leaves.select(*kept).schema.fields, *texts, T.StructField("copied", T.LongType())])
    cells = _in_blocks(leaves, fan, depth).groupBy("tree", "block")
    return cells.cogroup(above.withColumnRenamed("pos", "block").groupBy("tree", "block")).applyInArrow(proven, schema)
