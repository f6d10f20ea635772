"""Merkle manifest of a dataset by incremental witnesses.

Each row is a leaf; a group's leaves form a tree of ARITY children a node, the groups' roots form one more. A witness of a leaf holds,
from its run upwards, the siblings to the left and right on each level.

1. Leaves are numbered within their group by a distributed sort and cut into aligned blocks of BLOCK. In a block leaves are appended in
   turn: open subtrees hold their children and the partial witnesses below them; a subtree that gets its last sibling closes, extends
   those witnesses by its children and becomes a child of the next open one.
2. Roots of blocks are rows, and are appended the same way, in blocks again, until a group has one root; then the groups' roots are.
3. The witness of a block's root extends those of its leaves, by one join on the block.

`append` adds a later batch: full blocks stay as they are, with their witnesses; only a group's open block is taken up again.

Rules: NULL fields are told apart from empty texts. A NULL group sorts first and is one of its own; NULL keys come first within a group. Rows with
equal keys follow by leaf; equal rows are leaves of their own. Texts of any length are hashed whole. An empty table gives no
rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import numbered_within, scratch

ARITY, LEVELS = 8, 3
BLOCK = ARITY ** LEVELS
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEPS = "array<struct<before:string,after:string>>"
STEP_TYPE = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def digest(fields: list[Column]) -> Column:
    """Digest of one row: each field as `-` where NULL, else its number of UTF-8 bytes, a colon and its value."""
    said = [F.coalesce(F.concat(F.octet_length(f.cast("string")), F.lit(":"), f.cast("string")), F.lit("-")) for f in fields]
    return F.sha2(F.concat(*said), 256)


def leaves_of(docs: DataFrame, key: str = "doc_id", group: str = "lang",
              fields: tuple = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """(key, grp, leaf, tampered): grp orders as the group does, NULL first; tampered is the digest with the last field's letters A-Z
    lower-cased where 3 divides the key's CRC-32, else NULL."""
    own = [F.col(f"`{f}`") for f in fields]
    changed = F.crc32(F.col(f"`{key}`").cast("string")) % 3 == 0
    return docs.select(
        F.col(f"`{key}`").alias("key"), F.coalesce(F.concat(F.lit("v"), F.col(f"`{group}`").cast("string")), F.lit("-")).alias("grp"),
        digest(own).alias("leaf"), F.when(changed, digest([*own[:-1], F.translate(own[-1], UPPER, LOWER)])).alias("tampered"))


class Frontier:
    """Open subtrees of one block. `open[k]` holds the children so far at level k: (digest, first leaf, end of leaves)."""

    def __init__(self):
        self.open, self.witnesses = [[]], []

    def append(self, leaf: str) -> None:
        self.witnesses.append([])
        n = len(self.witnesses)
        self._add(0, (leaf, n - 1, n))

    def _add(self, level: int, node: tuple) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(node)
        if len(self.open[level]) == ARITY:
            self._close(level)

    def _close(self, level: int) -> None:
        nodes, self.open[level] = self.open[level], []
        digests = [d for d, _, _ in nodes]
        for i, (_, first, end) in enumerate(nodes):
            step = {"before": "".join(digests[:i]), "after": "".join(digests[i + 1:])}
            for witness in self.witnesses[first:end]:
                witness.append(step)
        parent = hashlib.sha256("".join(digests).encode()).hexdigest()
        self._add(level + 1, (parent, nodes[0][1], nodes[-1][2]))

    def root(self, levels: int | None) -> str:
        """Closes what is open: up to `levels`, or where None until one node remains."""
        level = 0
        while True:
            if level == levels or (levels is None and len(self.open[level]) == 1 and not any(self.open[level + 1:])):
                return self.open[level][0][0]
            if self.open[level]:
                self._close(level)
            level += 1


def _fold(key: tuple, table: pa.Table) -> pa.Table:
    table = table.sort_by("index")
    frontier = Frontier()
    for leaf in table.column("digest").to_pylist():
        frontier.append(leaf)
    # The first block ends where one node remains; each later one has blocks before it and so reaches their level.
    root = frontier.root(None if key[1].as_py() == 0 else LEVELS)
    steps = pa.array(frontier.witnesses, STEP_TYPE)
    return table.append_column("steps", steps).append_column("root", pa.array([root] * table.num_rows, pa.string()))


def fold(nodes: DataFrame) -> DataFrame:
    """`nodes` (grp, index, digest, ...) with their block, the steps up to its root, and that root."""
    placed = nodes.withColumn("block", F.expr(f"index div {BLOCK}"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema) + f", steps {STEPS}, root string"
    return placed.groupBy("grp", "block").applyInArrow(_fold, schema)


def _block_roots(folded: DataFrame) -> DataFrame:
    return folded.where(f"index % {BLOCK} = 0").select("grp", F.col("block").alias("index"), F.col("root").alias("digest"))


def _extended(folded: DataFrame, upper: DataFrame) -> DataFrame:
    """Witnesses extended by those of their blocks; root is the one these reach."""
    above = upper.select("grp", F.col("index").alias("block"), F.col("steps").alias("_above"), F.col("root").alias("_root"))
    return (folded.join(above, ["grp", "block"]).withColumns({"steps": F.concat("steps", "_above"), "root": F.col("_root")})
            .drop("_above", "_root"))


def to_the_root(nodes: DataFrame) -> DataFrame:
    """`nodes` (grp, index, digest) with whole witnesses within their group and the group's root, one round a power of BLOCK."""
    folded = scratch(fold(nodes), "folded")
    roots = _block_roots(folded)
    return folded if roots.where("index > 0").isEmpty() else scratch(_extended(folded, to_the_root(roots)), "folded")


def manifest(docs: DataFrame, **columns) -> DataFrame:
    """Table (key, grp, index, digest, tampered, block, steps, root) of a dataset: one row per leaf with its witness within its block."""
    placed = numbered_within(leaves_of(docs, **columns), "grp", ["key", "leaf"], "index")
    return scratch(fold(placed.withColumnRenamed("leaf", "digest")), "manifest")


def append(stored: DataFrame, docs: DataFrame, **columns) -> DataFrame:
    """The manifest of `stored`'s rows and `docs`, whose keys must all follow the stored ones of their group. Rows of full blocks are taken over
    unread by the fold."""
    new = leaves_of(docs, **columns)
    last = scratch(stored.groupBy("grp").agg(F.count("*").alias("_n"), F.max("key").alias("_last")), "manifest")
    first = new.groupBy("grp").agg(F.min("key").alias("_first"), F.max(F.col("key").isNull()).alias("_null"))
    if not first.join(last, "grp").where("_first <= _last or _null").isEmpty():
        raise ValueError("append: keys must be greater than the stored ones of their group")
    placed = numbered_within(new, "grp", ["key", "leaf"], "index").withColumnRenamed("leaf", "digest").join(last, "grp", "left")
    placed = placed.withColumn("index", F.col("index") + F.coalesce("_n", F.lit(0))).drop("_n", "_last")
    old = stored.join(last, "grp").withColumn("_open", F.expr(f"block = _n div {BLOCK}")).drop("_n", "_last")
    again = old.where("_open").drop("_open", "block", "steps", "root")
    done = old.where("not _open").drop("_open")
    return scratch(done.unionByName(fold(again.unionByName(placed))), "manifest")


def witnesses(stored: DataFrame) -> DataFrame:
    """(key, grp, index, digest, tampered, steps, subroot, root) from a manifest: whole witnesses up to the dataset's root."""
    blocks = to_the_root(_block_roots(stored))
    groups = blocks.where("index = 0").select("grp", F.col("root").alias("digest"))
    order = numbered_within(groups.withColumn("_all", F.lit("all")), "_all", ["grp"], "index").withColumnRenamed("grp", "name")
    top = to_the_root(order.select(F.col("_all").alias("grp"), "index", "digest", "name"))
    top = top.select(F.col("name").alias("grp"), F.col("steps").alias("_steps"), F.col("root").alias("_top"))
    blocks = blocks.join(top, "grp").select("grp", F.col("index").alias("block"), F.concat("steps", "_steps").alias("_above"),
                                            F.col("root").alias("subroot"), F.col("_top").alias("_root"))
    return (stored.join(scratch(blocks, "manifest"), ["grp", "block"])
            .select("key", "grp", "index", "digest", "tampered", F.concat("steps", "_above").alias("steps"), "subroot",
                    F.col("_root").alias("root")))


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its witness lead to."""
    return F.aggregate(steps, leaf, lambda got, s: F.sha2(F.concat(s["before"], got, s["after"]), 256))


def proof_digest(steps: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(steps, lambda s: F.concat(s["before"], s["after"]))), 256)


def audit(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): a copy of the data with some letters lower-cased, checked
    against the manifest of the original."""
    found = witnesses(manifest(docs))
    back = folded(F.coalesce("tampered", "digest"), F.col("steps"))
    return found.select(F.col("key").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root",
                        proof_digest(F.col("steps")).alias("proof_sha256"), back.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
