"""Merkle manifest of a table: one tree per group, one tree over the groups, a proof and its check for every row."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import numbered
from tagloom.session import written

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 2
# A superblock holds the leaves below one node this many levels up.
BLOCK_LEVELS = 8

# A node's siblings up to the root of its tree: its place in each run and the run's other digests.
PATH = "array<struct<nth: int, others: array<string>>>"


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 over the values' texts, each led by its length in bytes and a colon; NULL is a dash."""
    texts = [value.cast("string") for value in values]
    return F.sha2(
        F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256
    )


def _levels(digests: list[str], n: int, arity: int, block_levels: int) -> list[list[str]]:
    """A superblock's digests level by level, up to its one node; ``n`` are all nodes of its tree."""
    levels = [digests]
    if n > arity**block_levels:
        steps = block_levels
    else:
        steps = next(step for step in range(n + 1) if arity**step >= n)
    for _ in range(steps):
        below = levels[-1]
        levels.append([_sha256("".join(below[at : at + arity])) for at in range(0, len(below), arity)])
    return levels


def _siblings(levels: list[list[str]], at: int, arity: int) -> list[tuple[int, list[str]]]:
    """Place and others of the run that a node, and each node above it in the superblock, lies in."""
    path = []
    for level in levels[:-1]:
        first, nth = at - at % arity, at % arity
        path.append((nth, [digest for place, digest in enumerate(level[first : first + arity]) if place != nth]))
        at //= arity
    return path


def _by_block(nodes: DataFrame, arity: int, block_levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"position div {arity**block_levels}"))


def tree_levels(nodes: DataFrame, arity: int = ARITY, block_levels: int = BLOCK_LEVELS) -> list[DataFrame]:
    """Nodes (tree, position, n, digest) of every ``block_levels``-th level, from the leaves to one node per tree.

    Each step reduces a superblock of at most ``arity ** block_levels`` nodes in a task.
    """

    def top(held: pd.DataFrame) -> pd.DataFrame:
        held = held.sort_values("position")
        n = int(held["n"].iloc[0])
        digest = _levels(held["digest"].tolist(), n, arity, block_levels)[-1][0]
        blocks = -(-n // arity**block_levels)
        return pd.DataFrame({"tree": held["tree"].iloc[0], "position": held["block"].iloc[0], "n": blocks, "digest": [digest]})

    levels = [nodes.select("tree", "position", "n", "digest")]
    while not levels[-1].filter("n > 1").isEmpty():
        tops = _by_block(levels[-1], arity, block_levels).groupBy("tree", "block").applyInPandas(
            top, "tree string, position long, n long, digest string"
        )
        levels.append(written(tops, "merkle-level"))
    return levels


def paths_down(
    levels: list[DataFrame], outer: DataFrame, arity: int = ARITY, block_levels: int = BLOCK_LEVELS
) -> DataFrame:
    """(tree, block, path): what every superblock of leaves needs from outside, given the paths of the trees' own roots.

    Level by level downwards, the nodes and the paths of their superblocks'
    top nodes are cogrouped by superblock.
    """

    def extend(nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("position")
        held = _levels(nodes["digest"].tolist(), int(nodes["n"].iloc[0]), arity, block_levels)
        further = _as_path(above["path"].iloc[0])
        paths = [_as_rows(_siblings(held, at, arity) + further) for at in range(len(nodes))]
        return pd.DataFrame({"tree": nodes["tree"].tolist(), "block": nodes["position"].tolist(), "path": paths})

    for nodes in reversed(levels[1:]):
        # A tree's one node is the whole of its superblock: its path stays as it is.
        nodes = _by_block(nodes, arity, block_levels)
        outer = written(
            nodes.groupBy("tree", "block")
            .cogroup(outer.groupBy("tree", "block"))
            .applyInPandas(extend, f"tree string, block long, path {PATH}"),
            "merkle-paths",
        )
    return outer


def _as_path(rows) -> list[tuple[int, list[str]]]:
    return [(int(step["nth"]), list(step["others"])) for step in rows]


def _as_rows(path: list[tuple[int, list[str]]]) -> list[dict]:
    return [{"nth": nth, "others": others} for nth, others in path]


def folded(digest: str, path: list[tuple[int, list[str]]]) -> str:
    """The root that a leaf and its siblings give."""
    for nth, others in path:
        digest = _sha256("".join([*others[:nth], digest, *others[nth:]]))
    return digest


def manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = COLUMNS,
    key: str = "doc_id",
    group: str = "lang",
    number: str = "n_chars",
    every: int = 7,
    arity: int = ARITY,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of ``docs``.

    A leaf is the digest of the row's ``columns``. The leaves of a group, in
    the order of key and leaf, are hashed in runs of ``arity`` (the last may be
    shorter, even one) until one node remains: the group's subroot. Subroots,
    ordered by group (NULL first, then by UTF-8 bytes), give the root likewise.
    A row's proof is the digest of its siblings, level by level up to the root;
    without siblings, of nothing. Rows whose key's CRC-32 (of its decimal text)
    ``every`` divides are tampered with: one is added to ``number`` (NULL stays)
    after the trees are made, so that folding their proof gives another root; it
    is a whole number of at most 64 bits.

    A NULL key comes first in its group and is not tampered with; repeated rows
    are leaves of their own. No rows give no rows. Other columns are ignored.

    Texts are read where they are, for their leaf; what moves is digests.
    Leaves and the nodes that their superblock needs from outside are cogrouped
    by superblock, and one pass finishes the superblock's own levels, joins them
    to the outer nodes, and folds every row's proof.
    """
    leaves = docs.select(
        F.col(key).alias("key"),
        F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group).cast("string"))).alias("tree"),
        leaf_digest([F.col(name) for name in columns]).alias("digest"),
        F.when(
            (F.crc32(F.col(key).cast("string")) % every == 0) & F.col(number).isNotNull(),
            # As a decimal, so that the largest long has a next one.
            leaf_digest([F.col(name).cast("decimal(20,0)") + 1 if name == number else F.col(name) for name in columns]),
        ).alias("tampered"),
    )
    # Written first: dealing by range looks at its input twice.
    leaves = numbered(written(leaves, "merkle-digests"), "tree", ["key", "digest"], "merkle-leaves")
    levels = tree_levels(leaves, arity, block_levels)
    subroots = levels[-1].select("tree", F.col("digest").alias("subroot"))

    tops = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), F.col("subroot").alias("digest")), "tree", ["group"], "merkle-subroots")
    top_levels = tree_levels(tops, arity, block_levels)
    roots = [row.digest for row in top_levels[-1].select("digest").collect()]  # one, or none without rows
    nothing = F.expr(f"CAST(array() AS {PATH})")
    start = top_levels[-1].select("tree", F.lit(0).cast("long").alias("block"), nothing.alias("path"))
    above = paths_down(top_levels, written(start, "merkle-paths"), arity, block_levels)

    def own_paths(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("position")
        held = _levels(nodes["digest"].tolist(), int(nodes["n"].iloc[0]), arity, block_levels)
        further = _as_path(outer["path"].iloc[0])
        paths = [_as_rows(_siblings(held, at, arity) + further) for at in range(len(nodes))]
        return pd.DataFrame({"tree": nodes["group"].tolist(), "path": paths})

    of_groups = written(
        _by_block(tops, arity, block_levels)
        .groupBy("tree", "block")
        .cogroup(above.groupBy("tree", "block"))
        .applyInPandas(own_paths, f"tree string, path {PATH}"),
        "merkle-group-paths",
    )
    outer = paths_down(levels, of_groups.select("tree", F.lit(0).cast("long").alias("block"), "path"), arity, block_levels)
    # One row for every superblock, so what joins here is a small part of the leaves.
    outer = outer.join(subroots, "tree").withColumn("root", F.lit(roots[0] if roots else None).cast("string"))

    def finish(nodes: pd.DataFrame, needed: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("position")
        digests = nodes["digest"].tolist()
        held = _levels(digests, int(nodes["n"].iloc[0]), arity, block_levels)
        subroot, top = needed["subroot"].iloc[0], needed["root"].iloc[0]
        further = _as_path(needed["path"].iloc[0])
        proofs, roots = [], []
        for at, (digest, tampered) in enumerate(zip(digests, nodes["tampered"])):
            path = _siblings(held, at, arity) + further
            proofs.append(_sha256("".join(digest for _, others in path for digest in others)))
            roots.append(folded(tampered if isinstance(tampered, str) else digest, path))
        return pd.DataFrame(
            {
                "key": nodes["key"],
                "leaf": digests,
                "subroot": subroot,
                "root": top,
                "proof_sha256": proofs,
                "folded_root": roots,
                "verified": [found == top for found in roots],
            }
        )

    # Numbers go through pandas as text: beside a NULL it would make doubles of them.
    kind = docs.schema[key].dataType
    through = "string" if isinstance(kind, T.NumericType) else kind.simpleString()
    checked = (
        _by_block(leaves.withColumn("key", F.col("key").cast(through)), arity, block_levels)
        .groupBy("tree", "block")
        .cogroup(outer.groupBy("tree", "block"))
        .applyInPandas(
            finish,
            f"key {through}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
        )
    )
    return checked.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)
