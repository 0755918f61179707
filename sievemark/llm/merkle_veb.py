"""Merkle manifest of a table: one tree per part, aligned blocks stored in van Emde Boas order.

Every row is a leaf, the SHA-256 of its length-prefixed fields. The leaves of a part, in key order, are cut
into aligned blocks of ``2**BLOCK_BITS``; a block keeps all digests of its subtree in one byte string in van
Emde Boas order: the tree is split at half its height, the top half comes first, then the bottom subtrees
from left to right, each laid out alike. Arithmetic on that order finds a node in any depth, when a block is
built and when siblings are read. The roots of the blocks are the leaves of the next blocks, until one is
left per part, and the roots of the parts make a tree of their own.

A node is the SHA-256 of its children's hexadecimal digests; a last node without a neighbour is hashed alone.
No task holds more than one block, whatever the size of a part. Rows that are equal in part, key and digest
may stand in any order; equal keys with different digests stand in the order of their digests. NULL keys and
NULL parts come first. An empty table has no leaves, hence no root. A NULL field counts as ``-``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sievemark.session import cut_lineage

BLOCK_BITS = 12
DIGEST = 32
_LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` (from the left) of one depth in a perfect tree of ``levels`` levels."""
    index = np.asarray(index, "int64")
    place = np.zeros_like(index)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        depth -= top
        below = levels - top
        subtree, index = index >> depth, index & ((1 << depth) - 1)
        place = place + ((1 << top) - 1) + subtree * ((1 << below) - 1)
        levels = below
    return place


@cache
def _addresses(height: int) -> list[np.ndarray]:
    """The places of all nodes by their distance from the leaves."""
    return [address(height + 1, height - up, np.arange(1 << (height - up))) for up in range(height + 1)]


def height_of(leaves: int) -> int:
    """Number of levels above the leaves until one node is left."""
    return max(int(leaves) - 1, 0).bit_length()


def node(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class Block:
    """The digests of one aligned subtree; nodes without leaves below them are absent."""

    def __init__(self, height: int, count: int, cells: np.ndarray):
        self.height, self.count, self.cells = height, count, cells

    @classmethod
    def build(cls, leaves: Sequence[str], height: int) -> Block:
        cells = np.zeros(((1 << (height + 1)) - 1, DIGEST), "uint8")
        places, level = _addresses(height), list(leaves)
        for up in range(height + 1):
            cells[places[up][: len(level)]] = np.frombuffer(bytes.fromhex("".join(level)), "uint8").reshape(-1, DIGEST)
            if up < height:
                level = [node(*level[i : i + 2]) for i in range(0, len(level), 2)]
        return cls(height, len(leaves), cells)

    @classmethod
    def read(cls, height: int, count: int, cells: bytes) -> Block:
        return cls(height, count, np.frombuffer(cells, "uint8").reshape(-1, DIGEST))

    def level(self, up: int) -> list[str]:
        """Digests of the nodes ``up`` levels above the leaves, from the left."""
        n = -(-self.count // (1 << up))
        text = self.cells[_addresses(self.height)[up][:n]].tobytes().hex()
        return [text[i : i + 2 * DIGEST] for i in range(0, len(text), 2 * DIGEST)]

    def root(self) -> str:
        return self.cells[0].tobytes().hex()

    def steps(self) -> list[list[str]]:
        """Per leaf, its steps to the root: ``L`` or ``R`` and the digest of the sibling on that side, or ``-``."""
        up_from: list[list[str]] = [[] for _ in range(self.count)]
        for up in range(self.height):
            nodes = self.level(up)
            last = len(nodes) - 1
            own = ["-" if i == last and not i & 1 else "L" + nodes[i - 1] if i & 1 else "R" + nodes[i + 1] for i in range(last + 1)]
            for i in range(self.count):
                up_from[i].append(own[i >> up])
        return up_from


def fold(leaf: str, steps: Sequence[str]) -> str:
    """The digest that a leaf and its siblings lead to."""
    for s in steps:
        leaf = node(leaf) if s == "-" else node(s[1:], leaf) if s[0] == "L" else node(leaf, s[1:])
    return leaf


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of the fields, each as its UTF-8 length in bytes, a colon and its text; ``-`` if NULL."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


@dataclass
class Manifest:
    """Ranked leaves, the blocks of all parts by level, those of the tree over the parts by level, and part roots."""

    leaves: DataFrame  # _tree, _rank, _n, _key, _leaf, and what was kept with them
    blocks: list[DataFrame]  # _tree, _block, _n, height, count, cells, root
    top: list[DataFrame]
    roots: DataFrame  # _tree, _subroot


def build_manifest(rows: DataFrame, part: str, key: str, leaf: str, keep: Sequence[str] = ()) -> Manifest:
    """Trees over the rows: one per value of ``part``, in the order of ``key``, over the hexadecimal digests ``leaf``."""
    tree = F.when(F.col(part).isNotNull(), F.concat(F.lit("="), F.col(part).cast("string"))).otherwise("")
    # Small rows from here on: texts are read once, and sampling for the ranges reads the checkpoint.
    own = rows.select(tree.alias("_tree"), F.col(key).alias("_key"), F.unhex(leaf).alias("_leaf"), *[F.col(f"`{c}`") for c in keep])
    leaves = _ranked(cut_lineage(own), ["_tree", "_key", "_leaf"])
    blocks = _forest(leaves)
    roots = cut_lineage(_union([b.filter(F.col("_n") <= 1 << BLOCK_BITS).select("_tree", F.col("root").alias("_leaf")) for b in blocks]))
    subroots = _ranked(roots.select(F.lit("").alias("_tree"), F.col("_tree").alias("_key"), "_leaf"), ["_tree", "_key", "_leaf"])
    return Manifest(leaves, blocks, _forest(subroots), subroots.select(F.col("_key").alias("_tree"), F.col("_leaf").alias("_subroot"), "_rank"))


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows with their place in their tree (from 0) and the size of the tree, without a task that sorts a whole tree."""
    tie = F.monotonically_increasing_id()  # equal rows need not stay together
    placed = rows.withColumn("_tie", tie).repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    placed = cut_lineage(placed.withColumn("_spot", F.monotonically_increasing_id()))
    part = F.shiftright("_spot", _LOCAL_BITS)
    sizes = placed.groupBy(F.col("_tree").alias("_t"), part.alias("_p")).agg(F.min("_spot").alias("_first"), F.count("*").alias("_c"))
    # At most one row per tree and partition.
    of_tree = Window.partitionBy("_t")
    before = F.coalesce(F.sum("_c").over(of_tree.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_t", "_p", (before - F.col("_first")).alias("_shift"), F.sum("_c").over(of_tree).alias("_n"))
    out = placed.withColumn("_own", part).join(starts, (F.col("_tree") == F.col("_t")) & (F.col("_own") == F.col("_p")))
    return out.withColumn("_rank", F.col("_spot") + F.col("_shift")).drop("_t", "_p", "_own", "_shift", "_spot")


def _forest(leaves: DataFrame) -> list[DataFrame]:
    """Blocks of all trees, level by level; each level has a row for every 4,096 of the one below."""
    levels, rows = [], leaves.select("_tree", "_rank", "_n", "_leaf")
    while True:
        blocks = cut_lineage(_blocks(rows))
        levels.append(blocks)
        more = blocks.filter(F.col("_n") > 1 << BLOCK_BITS)
        if not more.limit(1).count():
            return levels
        above = F.ceil(F.col("_n") / (1 << BLOCK_BITS)).cast("bigint")
        rows = more.select("_tree", F.col("_block").alias("_rank"), above.alias("_n"), F.col("root").alias("_leaf"))


_BLOCK = "_tree string, _block bigint, _n bigint, height int, count int, cells binary, root binary"


def _blocks(rows: DataFrame) -> DataFrame:
    schema = T._parse_datatype_string(_BLOCK)
    arrow = to_arrow_schema(schema)

    def build(t: pa.Table) -> pa.Table:
        t = t.sort_by("_rank")
        n = t.column("_n")[0].as_py()
        block = Block.build([d.hex() for d in t.column("_leaf").to_pylist()], min(height_of(n), BLOCK_BITS))
        values = [t.column("_tree")[0].as_py(), t.column("_rank")[0].as_py() >> BLOCK_BITS, n]
        values += [block.height, block.count, block.cells.tobytes(), bytes.fromhex(block.root())]
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(values, arrow)], schema=arrow)

    return rows.withColumn("_block", F.shiftright("_rank", BLOCK_BITS)).groupBy("_tree", "_block").applyInArrow(build, schema)


def _paths(levels: Sequence[DataFrame], above: DataFrame) -> DataFrame:
    """(_tree, _block, _path): the steps from the root of each lowest block up, given those from each tree's root up.

    A path is one text, its steps separated by blanks.
    """
    paths = None
    for k in reversed(range(len(levels))):
        ends = levels[k].filter(F.col("_n") <= 1 << BLOCK_BITS).select("_tree", "_block")
        here = ends.join(above, "_tree").select("_tree", "_block", "_path")
        paths = here if paths is None else here.unionByName(paths)
        if k:
            paths = _descend(levels[k].join(paths, ["_tree", "_block"]))
    return paths


def _descend(blocks: DataFrame) -> DataFrame:
    """Paths of the members of each block, which are blocks themselves."""
    schema = T._parse_datatype_string("_tree string, _block bigint, _path string")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tree, block, height, count, cells, path in zip(*[b.column(i) for i in range(6)]):
                steps = Block.read(height.as_py(), count.as_py(), cells.as_py()).steps()
                first = block.as_py() << BLOCK_BITS
                columns = [[tree.as_py()] * len(steps), [first + i for i in range(len(steps))], [" ".join([*s, path.as_py()]).strip() for s in steps]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return blocks.select("_tree", "_block", "height", "count", "cells", "_path").mapInArrow(run, schema)


def prove(manifest: Manifest, checked: str) -> DataFrame:
    """Every leaf with its part's root, the root, the digest of its siblings, and the root that ``checked`` leads to.

    ``checked`` is a kept column with the digest to verify in place of the leaf, NULL for the leaf itself. The
    siblings are read from the stored blocks: those of the leaf's own block, then those of the blocks above.
    """
    of_part = _top_paths(manifest)
    paths = _paths(manifest.blocks, of_part)
    right = manifest.blocks[0].join(paths, ["_tree", "_block"]).join(of_part.select("_tree", "_subroot", "_root"), "_tree")
    left = manifest.leaves.withColumn("_block", F.shiftright("_rank", BLOCK_BITS)).select("_tree", "_block", "_rank", "_key", "_leaf", F.col(checked).alias("_checked"))
    schema = T.StructType([T.StructField("_key", manifest.leaves.schema["_key"].dataType)])
    for name in ("leaf", "subroot", "root", "proof_sha256", "folded_root"):
        schema.add(name, T.StringType())
    schema.add("verified", T.BooleanType())
    arrow = to_arrow_schema(schema)

    def run(leaves: pa.Table, block: pa.Table) -> pa.Table:
        b = {c: block.column(c)[0].as_py() for c in ("height", "count", "cells", "_path", "_subroot", "_root")}
        leaves = leaves.sort_by("_rank")
        own, root, above = [d.hex() for d in leaves.column("_leaf").to_pylist()], b["_root"].hex(), b["_path"].split()
        proofs, folded = [], []
        tail = "".join(s[1:] for s in above)
        for leaf, other, steps in zip(own, leaves.column("_checked").to_pylist(), Block.read(b["height"], b["count"], b["cells"]).steps()):
            proofs.append(node(*[s[1:] for s in steps], tail))
            folded.append(fold(fold(leaf if other is None else other.hex(), steps), above))
        n = len(own)
        columns = [own, [b["_subroot"].hex()] * n, [root] * n, proofs, folded, [f == root for f in folded]]
        arrays = [leaves.column("_key").combine_chunks().cast(arrow.field(0).type)] + [pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:])]
        return pa.Table.from_arrays(arrays, schema=arrow)

    keys = ("_tree", "_block")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def _top_paths(manifest: Manifest) -> DataFrame:
    """(_tree, _path, _subroot, _root) per part: the steps from its root to the root of all."""
    top = manifest.top
    root = F.col("root").alias("_root")
    last = top[-1].select(F.col("_tree").alias("_all"), root)  # one row
    ends = last.select(F.col("_all").alias("_tree"), F.lit("").alias("_path"))
    lowest = _descend(top[0].join(_paths(top, ends), ["_tree", "_block"])).select(F.col("_tree").alias("_all"), F.col("_block").alias("_r"), "_path")
    parts = manifest.roots.join(lowest, F.col("_rank") == F.col("_r"))
    return cut_lineage(parts.join(last, "_all").select("_tree", "_path", "_subroot", "_root"))


DOCUMENT_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def document_proofs(docs: DataFrame, tampered: Column) -> DataFrame:
    """Proofs of all documents in trees per ``lang``; where ``tampered`` holds, one is added to n_chars before verifying."""
    fields = {c: F.col(c) for c in DOCUMENT_FIELDS}
    changed = fields | {"n_chars": F.col("n_chars") + 1}
    rows = docs.select(
        "lang",
        "doc_id",
        leaf_digest(*fields.values()).alias("_l"),
        F.when(tampered & F.col("n_chars").isNotNull(), F.unhex(leaf_digest(*changed.values()))).alias("_tampered"),
    )
    return prove(build_manifest(rows, "lang", "doc_id", "_l", keep=["_tampered"]), "_tampered").withColumnRenamed("_key", "doc_id")
