"""Merkle manifest of a dataset, with an Octopus multiproof for any set of its rows.

Every row is a leaf.  The leaves of a group (a language) stand in order; runs of eight
consecutive nodes are hashed together, level by level, up to the group's subroot, and the
subroots likewise up to the root.  A node has the coordinates (tree, level, pos); tree -1 is
the one above the subroots.

Trees are built in blocks of 512 consecutive nodes, which gives three levels in one pass.  To
prove rows, the rows of a block work out together which coordinates they need that they can't
derive themselves, once each; all blocks look theirs up in one join; and each block derives the
interior nodes that its rows share and expands the proof of every row from them.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from entityframe.llm.common import load, ship, stage
from entityframe.operators.paging import numbered

FANOUT = 8
#: Levels that one pass over blocks builds, and nodes of a block.
STRIDE = 3
BLOCK = FANOUT**STRIDE
TOP = -1

_NODE = "tree long, level int, pos long, size long, digest string"
_ABSENT = "-"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def row_digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of all values, each with its length in UTF-8 bytes before it, `-` where null."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit(_ABSENT))

    return F.sha2(F.concat(*map(part, values)).cast("binary"), 256)


def node_digest(digests: Iterable[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def _above(size: int) -> int:
    """Nodes on the level above one of `size` nodes."""
    return -(-size // FANOUT)


def depth(size: int) -> int:
    """Levels above the leaves of a tree of `size` leaves."""
    levels = 0
    while size > 1:
        size, levels = _above(size), levels + 1
    return levels


def missing_nodes(known: Iterable[int], size: int) -> list[tuple[int, int]]:
    """The (level, pos) that the leaves at `known` need for their proofs and can't derive: on
    each level the other nodes of the runs that hold a node derived so far."""
    need, held, level = [], set(known), 0
    while size > 1:
        runs = {pos // FANOUT for pos in held}
        for run in sorted(runs):
            need += [(level, pos) for pos in range(run * FANOUT, min((run + 1) * FANOUT, size)) if pos not in held]
        held, size, level = runs, _above(size), level + 1
    return need


class SharedProof:
    """What the leaves of one multiproof share: nodes fetched once and interiors derived once."""

    def __init__(self, tree: int, size: int, leaves: dict[int, str], fetched: dict[tuple[int, int, int], str]):
        self.tree, self.sizes = tree, [size]
        while self.sizes[-1] > 1:
            self.sizes.append(_above(self.sizes[-1]))
        self.digests = [dict(leaves)] + [{} for _ in self.sizes[1:]]
        for (of, level, pos), digest in fetched.items():
            if of == tree:
                self.digests[level].setdefault(pos, digest)
        derived = set(leaves)
        for level in range(len(self.sizes) - 1):
            derived = {pos // FANOUT for pos in derived}
            for run in derived:
                self.digests[level + 1][run] = node_digest(self.digests[level][p] for p in self._run(level, run))
        self._tails: dict[tuple[int, int], str] = {}

    def _run(self, level: int, run: int) -> range:
        return range(run * FANOUT, min((run + 1) * FANOUT, self.sizes[level]))

    def siblings(self, level: int, pos: int) -> str:
        """The proof of the node at (level, pos): the digests beside its path, from left to right, level by level."""
        if level == len(self.sizes) - 1:
            return ""
        beside = "".join(self.digests[level][p] for p in self._run(level, pos // FANOUT) if p != pos)
        above = (level + 1, pos // FANOUT)
        if above not in self._tails:
            self._tails[above] = self.siblings(*above)
        return beside + self._tails[above]

    def fold(self, pos: int, digest: str) -> str:
        """The root that follows from a leaf `digest` at `pos` and the siblings of its path."""
        for level in range(len(self.sizes) - 1):
            run = pos // FANOUT
            if digest == self.digests[level][pos]:
                # The hash of just these nodes has been derived.
                digest = self.digests[level + 1][run]
            else:
                digest = node_digest(digest if p == pos else self.digests[level][p] for p in self._run(level, run))
            pos = run
        return digest


def _block(pos: str) -> Column:
    return F.call_function("div", F.col(pos), F.lit(BLOCK).cast("bigint"))


def _build_block(nodes: pd.DataFrame) -> pd.DataFrame:
    """The up to three levels above one block of consecutive nodes of a level."""
    first = nodes.iloc[0]
    tree, level, size = int(first["tree"]), int(first["level"]), int(first["size"])
    held, out = dict(zip(nodes["pos"], nodes["digest"], strict=True)), []
    for _ in range(STRIDE):
        if size == 1:
            break
        runs: dict[int, list[str]] = {}
        for pos in sorted(held):
            runs.setdefault(pos // FANOUT, []).append(held[pos])
        held = {run: node_digest(digests) for run, digests in runs.items()}
        level, size = level + 1, _above(size)
        out += [(tree, level, pos, size, digest) for pos, digest in held.items()]
    return pd.DataFrame(out, columns=["tree", "level", "pos", "size", "digest"])


def build_nodes(leaves: DataFrame) -> DataFrame:
    """All nodes above the given ones (tree, pos, size, digest), and these at level 0.

    The given ones are read by every pass and by what comes after, so they should be stored.
    """
    built = leaves.select("tree", F.lit(0).alias("level"), "pos", "size", "digest")
    nodes, most = built, built.agg(F.max("size")).first()[0] or 0
    for level in range(0, depth(most), STRIDE):
        lower = built.filter((F.col("level") == level) & (F.col("size") > 1)).withColumn("block", _block("pos"))
        built = stage(lower.groupBy("tree", "block").applyInPandas(_build_block, _NODE), "nodes")
        nodes = nodes.unionByName(built)
    return nodes


@dataclass(frozen=True)
class Manifest:
    """A dataset's leaves (with the columns given to `build`, tree, pos, size), trees and nodes."""

    leaves: DataFrame
    trees: DataFrame
    nodes: DataFrame

    @property
    def root(self) -> str | None:
        """None for a dataset without rows."""
        found = self.nodes.filter((F.col("tree") == TOP) & (F.col("size") == 1)).first()
        return found["digest"] if found else None

    def write(self, path: str) -> None:
        """Parquet tables under `path`; `read_manifest` gives the manifest back."""
        self.leaves.write.parquet(f"{path}/leaves")
        self.trees.write.parquet(f"{path}/trees")
        self.nodes.write.parquet(f"{path}/nodes")


def read_manifest(spark, path: str) -> Manifest:
    return Manifest(*(spark.read.parquet(f"{path}/{name}") for name in ("leaves", "trees", "nodes")))


def build(leaves: DataFrame, group: str, order: str, digest: str = "leaf") -> Manifest:
    """The manifest of rows that carry their `digest`: one tree per value of `group` (null is a
    group, the first one), leaves by `order`, nulls first, equal ones by digest.

    Rows that agree in all three are exchangeable: whichever comes first, each proof that
    exists is the same.  Other columns are carried along in `leaves`; its own columns tree, pos
    and size must not be among them.
    """
    if taken := {"tree", "pos", "size"} & {c.lower() for c in leaves.columns}:
        raise ValueError(f"rename the columns {sorted(taken)}")
    ship(leaves.sparkSession)
    # The last column only spreads repeated rows over the tasks of the sort.
    spread = stage(leaves, "leaves").withColumn("__spread", F.monotonically_increasing_id())
    first = lambda name: F.col(name).asc_nulls_first()
    # What `numbered` returns is a stored table with a small one beside it, and needs no copy.
    placed = numbered(spread, [first(group), first(order), digest, "__spread"], "__at").drop("__spread")
    groups = placed.groupBy(group).agg(F.min("__at").alias("__start"), F.count(F.lit(1)).alias("size"))
    # A tree per group, numbered in the order of the groups.
    found = numbered(groups, ["__start"], "tree").select(F.col(group).alias("__group"), "__start", "size", "tree")
    # Stored, so that Spark knows how small it is: few groups are broadcast, not dealt out by group.
    found = stage(found, "groups")
    owned = placed.join(found, F.col(group).eqNullSafe(F.col("__group")))
    owned = stage(owned.withColumn("pos", F.col("__at") - F.col("__start")).drop("__group", "__start", "__at"), "owned")
    nodes = build_nodes(owned.select("tree", "pos", "size", F.col(digest).alias("digest")))
    subroots = nodes.filter(F.col("size") == 1).select("tree", F.col("digest").alias("subroot"))
    trees = stage(found.join(subroots, "tree").select("tree", "size", "subroot", F.col("__group").alias("group")), "trees")
    count = trees.count()
    top = trees.select(F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("pos"), F.lit(count).cast("bigint").alias("size"), F.col("subroot").alias("digest"))
    return Manifest(owned, trees, nodes.unionByName(build_nodes(top)))


_COORDINATE = "tree long, block long, need_tree long, need_level int, need_pos long"


def _asker(trees: int):
    def ask(rows: pd.DataFrame) -> pd.DataFrame:
        tree, block, size = (int(rows.iloc[0][c]) for c in ("tree", "block", "size"))
        own = [(tree, block, tree, level, pos) for level, pos in missing_nodes(rows["pos"].tolist(), size)]
        above = [(tree, block, TOP, level, pos) for level, pos in missing_nodes([tree], trees)]
        return pd.DataFrame(own + above, columns=["tree", "block", "need_tree", "need_level", "need_pos"])

    return ask


def _expander(trees: int, root: str, schema_names: list[str]):
    def expand(rows: pd.DataFrame, fetched: pd.DataFrame) -> pd.DataFrame:
        tree, size, subroot = int(rows.iloc[0]["tree"]), int(rows.iloc[0]["size"]), rows.iloc[0]["subroot"]
        nodes = {
            (int(t), int(level), int(pos)): digest
            for t, level, pos, digest in zip(fetched["need_tree"], fetched["need_level"], fetched["need_pos"], fetched["digest"], strict=True)
        }
        own = SharedProof(tree, size, dict(zip(rows["pos"], rows["leaf"], strict=True)), nodes)
        # Subroots are fetched like every other node of the tree above them.
        above = SharedProof(TOP, trees, {tree: subroot}, nodes)
        tail = above.siblings(0, tree)
        proofs, folded = [], []
        for pos, claim in zip(rows["pos"], rows["claim"], strict=True):
            proofs.append(node_digest((own.siblings(0, pos), tail)))
            folded.append(above.fold(tree, own.fold(pos, claim)))
        out = rows.assign(root=root, proof_sha256=proofs, folded_root=folded)
        out["verified"] = out["folded_root"] == root
        return out[schema_names]

    return expand


def prove(manifest: Manifest, wanted: DataFrame) -> DataFrame:
    """`wanted` with subroot, root, proof_sha256, folded_root and verified for every row.

    `wanted` has rows of `manifest.leaves` with its columns, any share of them, and a column
    `claim`: the digest that each row is said to have, which is folded with the proof.
    """
    root = manifest.root
    if root is None:
        extra = {c: F.lit(None).cast("string") for c in ("subroot", "root", "proof_sha256", "folded_root")}
        return wanted.withColumns({**extra, "verified": F.lit(None).cast("boolean")})
    # One node per group and one number of groups; the rest of the work is per block.
    trees = manifest.trees.count()
    rows = stage(wanted.withColumn("block", _block("pos")), "wanted")
    asked = stage(rows.select("tree", "block", "size", "pos").groupBy("tree", "block").applyInPandas(_asker(trees), _COORDINATE), "asked")
    least = asked.agg(F.min("need_level")).first()[0] or 0
    nodes = manifest.nodes.filter(F.col("level") >= least).select(
        F.col("tree").alias("need_tree"), F.col("level").alias("need_level"), F.col("pos").alias("need_pos"), "digest"
    )
    fetched = asked.join(nodes, ["need_tree", "need_level", "need_pos"])
    rows = rows.join(manifest.trees.select("tree", "subroot"), "tree")
    carried = [f for f in wanted.schema.fields]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried)
    made = "subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    names = [f.name for f in carried] + ["subroot", "root", "proof_sha256", "folded_root", "verified"]
    pairs = rows.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block"))
    return pairs.applyInPandas(_expander(trees, root, names), f"{ddl}, {made}")


def document_manifest(docs: DataFrame) -> Manifest:
    """The manifest of a table of documents: a tree per lang, leaves by doc_id.

    Needs doc_id, source, lang, n_chars and text; other columns are ignored.  A null in any of
    them is hashed as `-` and differs from an empty text (`0:`); a null lang is a group of its
    own, the first; null doc_ids come first in their group.  Repeated rows are leaves of their
    own.  Texts of any length are hashed whole.  An empty table has no root.  `tampered` is the
    digest of a row whose text is lower-cased (A to Z), for rows whose doc_id has a CRC-32
    divisible by 3; other rows, and those without a doc_id, have their leaf there.
    """
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = row_digest(*head, F.col("text"))
    lowered = row_digest(*head, F.translate("text", _UPPER, _LOWER))
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = docs.select("doc_id", "lang", leaf.alias("leaf"), F.when(picked, lowered).otherwise(leaf).alias("tampered"))
    return build(leaves, "lang", "doc_id")


def op13_merkle_manifest(spark, sf):
    manifest = document_manifest(load(spark, sf, "documents"))
    claimed = manifest.leaves.select("doc_id", "leaf", "tree", "pos", "size", F.col("tampered").alias("claim"))
    proofs = prove(manifest, claimed)
    return proofs.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


_PART = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_HEAD = " || ".join(_PART.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
_CRC = """xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

OP13_SQL = f"""
WITH RECURSIVE row AS (
  SELECT row_number() OVER () AS id, *, sha256({_HEAD} || {_PART.format("text")}) AS leaf,
         sha256({_HEAD} || {_PART.format(f"translate(text, '{_UPPER}', '{_LOWER}')")}) AS lowered,
         coalesce({_CRC} % 3 = 0, false) AS picked
  FROM documents
), leaf AS (
  SELECT id, doc_id, leaf, CASE WHEN picked THEN lowered ELSE leaf END AS claim,
         dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM row
), node AS (
  SELECT tree, 0 AS level, pos, n, leaf AS digest FROM leaf
  UNION ALL
  SELECT tree, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
  FROM node WHERE n > 1 GROUP BY tree, level, pos // 8, n
), subroot AS (
  SELECT tree, digest AS subroot FROM node WHERE n = 1
), top AS (
  SELECT 0 AS level, tree AS pos, count(*) OVER () AS n, subroot AS digest FROM subroot
  UNION ALL
  SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 8, n
), walk AS (
  SELECT id, tree, 0 AS level, pos, n, claim AS h, '' AS proof FROM leaf
  UNION ALL
  SELECT w.id, w.tree, w.level + 1, w.pos // 8, (w.n + 7) // 8,
         sha256(string_agg(CASE WHEN o.pos = w.pos THEN w.h ELSE o.digest END, '' ORDER BY o.pos)),
         w.proof || coalesce(string_agg(o.digest, '' ORDER BY o.pos) FILTER (o.pos <> w.pos), '')
  FROM walk w JOIN node o ON o.tree = w.tree AND o.level = w.level AND o.pos // 8 = w.pos // 8
  WHERE w.n > 1 GROUP BY w.id, w.tree, w.level, w.pos, w.n, w.proof
), climb AS (
  SELECT id, 0 AS level, tree AS pos, (SELECT count(*) FROM subroot) AS n, h, proof FROM walk WHERE n = 1
  UNION ALL
  SELECT w.id, w.level + 1, w.pos // 8, (w.n + 7) // 8,
         sha256(string_agg(CASE WHEN o.pos = w.pos THEN w.h ELSE o.digest END, '' ORDER BY o.pos)),
         w.proof || coalesce(string_agg(o.digest, '' ORDER BY o.pos) FILTER (o.pos <> w.pos), '')
  FROM climb w JOIN top o ON o.level = w.level AND o.pos // 8 = w.pos // 8
  WHERE w.n > 1 GROUP BY w.id, w.level, w.pos, w.n, w.proof
)
SELECT l.doc_id, l.leaf, s.subroot, t.digest AS root, sha256(c.proof) AS proof_sha256, c.h AS folded_root, c.h = t.digest AS verified
FROM leaf l JOIN subroot s USING (tree) JOIN climb c ON c.id = l.id AND c.n = 1 JOIN top t ON t.n = 1
"""
