"""Merkle manifest of a dataset: a digest per row, a tree per group, a tree over the groups, and proofs.

A leaf is the sha256 of the row's encoded columns. A group's leaves ascend by doc_id; while more than one node
remains, each run of ARITY consecutive nodes (the last run may be shorter, even one) becomes the sha256 of their
digests as hex text. What remains is the group's root; the groups' roots, in the order of the groups, make the
dataset's root in the same way. A row's proof is, level by level, its place in its run and the run's others.

Storage is a van Emde Boas layout. A tree is cut into aligned blocks of LEVELS levels (729 leaves), one row of a
table each; the roots of the blocks are the leaves of the next tier of blocks, and so on until one is left. In a
block the nodes lie in one array: the upper half of its levels first, then the subtrees below one after another,
each half laid out in the same way. `address` computes where a node lies from its depth and index; nothing points.

Construction goes up the tiers: rows are dealt by (group, block), sorted, and a task builds one block after
another from a stream. Retrieval goes down them: a block is met by those below it (at last by the rows), sorted
behind it, and each takes its siblings from the block's array. A task holds one block; a group of any size is
many blocks; the tables shrink by 729 a tier, and only one root goes to the driver.

Defined cases: null group first, null doc_id first; rows with equal doc_ids stand in the order of their digests;
a lone leaf is its group's root, a lone group's root the dataset's; a table without rows has root None and no
proofs; extra columns pass through whatever their names. Null and empty text have different leaves.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from feedlake.llm.common import numbered, packed, small_batches, stored, table, unpacked

ARITY = 3
#: Levels of hashing in a block: 3 ** 6 = 729 leaves.
LEVELS = 6
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
DIGEST = 32
#: The name of the tree over the groups.
TOP = -1


# ------------------------------------------------------------------ leaves


def encoded(c: str | Column) -> Column:
    """`-` for null, else the UTF-8 byte count, `:` and the value."""
    value = (F.col(f"`{c}`") if isinstance(c, str) else c).cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(columns: list) -> Column:
    return F.sha2(F.concat(*map(encoded, columns)), 256)


# ------------------------------------------------------------------ one block


def tree_size(levels: int) -> int:
    """Nodes of a whole tree of that many node levels."""
    return (ARITY**levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index):
    """Where node `index` of `depth` (root: 0) lies in the layout of a whole tree of `levels` node levels. An index may
    be an array."""
    if levels == 1:
        return index * 0
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    below = ARITY ** (depth - top)
    return tree_size(top) + index // below * tree_size(levels - top) + address(levels - top, depth - top, index % below)


def joined(digests: list[bytes]) -> bytes:
    """The digest of a run: sha256 of its digests as hex text."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def height(n: int) -> int:
    """Levels of hashing above n nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def laid_out(leaves: list[bytes], levels: int) -> bytes:
    """The block of these leaves in van Emde Boas order; places without a node hold zeros."""
    out, rows = np.zeros((tree_size(levels + 1), DIGEST), np.uint8), leaves
    for up in range(levels + 1):
        at = address(levels + 1, levels - up, np.arange(len(rows)))
        out[at] = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, DIGEST)
        rows = [joined(rows[k : k + ARITY]) for k in range(0, len(rows), ARITY)]
    return out.tobytes()


def siblings(block: bytes, n: int, levels: int, index: int) -> list[tuple[int, list[bytes]]]:
    """Of a leaf of a block with n leaves, level by level: its place in its run and the run's others."""
    path = []
    for depth in range(levels, 0, -1):
        first = index // ARITY * ARITY
        run = [address(levels + 1, depth, k) * DIGEST for k in range(first, min(first + ARITY, n)) if k != index]
        path.append((index - first, [block[a : a + DIGEST] for a in run]))
        index, n = index // ARITY, -(-n // ARITY)
    return path


def packed_path(path: list[tuple[int, list[bytes]]]) -> bytes:
    return b"".join(bytes((at, len(others))) + b"".join(others) for at, others in path)


def unpacked_path(path: bytes) -> list[tuple[int, list[bytes]]]:
    out, k = [], 0
    while k < len(path):
        at, n, k = path[k], path[k + 1], k + 2
        out.append((at, [path[k + j * DIGEST : k + (j + 1) * DIGEST] for j in range(n)]))
        k += n * DIGEST
    return out


def folded(digest: bytes, path: list[tuple[int, list[bytes]]]) -> bytes:
    """The root that a leaf and its proof lead to."""
    for at, others in path:
        digest = joined([*others[:at], digest, *others[at:]])
    return digest


# ------------------------------------------------------------------ construction


@dataclass
class Manifest:
    """leaves: row__, tree, n, i, digest. tiers: the blocks (tree, block, n, levels, count, nodes, root) of the groups' trees,
    tier by tier; roots: tree, root, i of each group, and tops: the blocks of the tree over them. root: hex, or None
    of an empty table. levels: of hashing in a block."""

    leaves: DataFrame
    tiers: list[DataFrame]
    roots: DataFrame
    tops: list[DataFrame]
    root: str | None
    levels: int


BLOCK = "tree long, block long, n long, levels int, count int, nodes binary, root binary"


def _dealt(df: DataFrame, *then) -> DataFrame:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, "tree", "block").sortWithinPartitions("tree", "block", *then)


def _blocks(most_levels: int):
    """Rows (tree, block, n, i, digest), sorted, to blocks."""

    def made(key, n, digests):
        levels = min(most_levels, height(n))
        nodes = laid_out(digests, levels)
        root = address(levels + 1, 0, 0) * DIGEST
        return *key, n, levels, len(digests), nodes, nodes[root : root + DIGEST]

    def record(rows):
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["tree", "block", "n", "levels", "count", "nodes", "root"])

    def run(batches):
        key, n, digests = None, 0, []
        for batch in batches:
            done = []
            for tree, block, size, digest in zip(*(batch.column(c).to_pylist() for c in ("tree", "block", "n", "digest"))):
                if key != (tree, block):
                    if key is not None:
                        done.append(made(key, n, digests))
                    key, n, digests = (tree, block), size, []
                digests.append(digest)
            if done:
                yield record(done)
        if key is not None:
            yield record([made(key, n, digests)])

    return run


def build_tiers(nodes: DataFrame, name: str, levels: int = LEVELS) -> list[DataFrame]:
    """nodes (tree, n: the tree's leaves, i, digest): the blocks of all trees, tier by tier, each written out."""
    per, tiers = ARITY**levels, []
    while True:
        rows = nodes.withColumn("block", F.floor(F.col("i") / per).cast("long")).select("tree", "block", "n", "i", "digest")
        blocks = stored(_dealt(rows, "i").mapInArrow(_blocks(levels), BLOCK), f"{name}{len(tiers)}")
        tiers.append(blocks)
        nodes = blocks.where(F.col("n") > per).select("tree", F.ceil(F.col("n") / per).cast("long").alias("n"), F.col("block").alias("i"), F.col("root").alias("digest"))
        if nodes.isEmpty():
            return tiers


def tree_roots(tiers: list[DataFrame], levels: int) -> DataFrame:
    """(tree, root) of every tree: the root of its only block in the last tier that it reaches."""
    out = None
    for blocks in tiers:
        ends = blocks.where(F.col("n") <= ARITY**levels).select("tree", "root")
        out = ends if out is None else out.unionByName(ends)
    return out


def manifest(docs: DataFrame, columns: list[str] | None = None, group: str = "source", order: str = "doc_id",
             keep: list[str] | None = None, levels: int = LEVELS) -> Manifest:
    """The trees of docs. Groups are ordered by code point, null first."""
    small_batches(docs.sparkSession)
    digest = F.unhex(leaf(columns or COLUMNS))
    rows = packed(docs, docs.columns if keep is None else keep, F.col(f"`{group}`").alias("group_"), F.col(f"`{order}`").alias("order_"), digest.alias("digest"))
    placed = numbered(rows, "merkle-leaves", F.asc_nulls_first("group_"), F.asc_nulls_first("order_"), "digest", at="place")
    groups = stored(placed.groupBy("group_").agg(F.min("place").alias("tree"), F.count(F.lit(1)).alias("n")), "merkle-groups")
    same = F.col("group_").eqNullSafe(F.col("group__"))
    leaves = placed.join(groups.withColumnRenamed("group_", "group__"), same).withColumn("i", F.col("place") - F.col("tree"))
    leaves = stored(leaves.select("row__", "tree", "n", "i", "digest"), "merkle-rows")
    tiers = build_tiers(leaves, "merkle-tier", levels)
    roots = numbered(tree_roots(tiers, levels), "merkle-roots", "tree", at="i")  # a tree is named by its first row's place
    n = F.lit(roots.count()).cast("long")
    tops = build_tiers(roots.select(F.lit(TOP).cast("long").alias("tree"), n.alias("n"), "i", F.col("root").alias("digest")), "merkle-top", levels)
    root = tree_roots(tops, levels).first()
    return Manifest(leaves, tiers, roots, tops, root and bytes(root["root"]).hex(), levels)


# ------------------------------------------------------------------ retrieval


def _descend(schema: pa.Schema, emit):
    """Rows sorted by (tree, block, below): a block with its own path first, then those below it, of which emit makes the
    new columns from (the row's number in the batch, path, subroot)."""

    def run(batches):
        held = None
        for batch in batches:
            below, at, new = batch.column("below").to_pylist(), [], []
            per = {c: batch.column(c) for c in ("i", "count", "levels", "nodes", "path", "subroot")}
            for k, low in enumerate(below):
                if not low:
                    held = {c: per[c][k].as_py() for c in per}
                    continue
                path = packed_path(siblings(held["nodes"], held["count"], held["levels"], per["i"][k].as_py())) + held["path"]
                at.append(k)
                new.append(emit(batch, k, path, held["subroot"]))
            if at:
                rows = batch.take(pa.array(at))
                made = dict(zip(new[0], zip(*(r.values() for r in new))))
                yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) if f.name in made else rows.column(f.name) for f in schema], schema=schema)

    return run


def _met(blocks: DataFrame, low: DataFrame, per: int, out, emit) -> DataFrame:
    """blocks (with path and subroot) and the rows `low` (tree, i, ...) under them: those of low with what emit adds."""
    own = F.floor(F.col("i") / per).cast("long")
    inside = F.col("i") - own * per
    low = low.withColumn("block", own).withColumn("i", inside).withColumn("below", F.lit(True))
    high = blocks.select("tree", "block", "count", "levels", "nodes", "path", "subroot").withColumn("below", F.lit(False))
    both = _dealt(high.unionByName(low, allowMissingColumns=True), "below", "i")
    target = T.StructType.fromDDL(out) if isinstance(out, str) else out
    return both.mapInArrow(_descend(to_arrow_schema(target), emit), target)


def with_paths(tiers: list[DataFrame], tops: DataFrame, per: int) -> DataFrame:
    """The blocks of the lowest tier, each with the path of its root to the dataset's root, and its tree's root.
    tops (tree, path, subroot): the paths of the trees' roots."""
    upper = None
    for k in range(len(tiers) - 1, -1, -1):
        blocks = tiers[k]
        whole = blocks.where(F.col("n") <= per).join(tops, "tree")
        if upper is not None:
            low = blocks.where(F.col("n") > per).select("tree", F.col("block").alias("i"), F.col("block").alias("own"))
            paths = _met(upper, low, per, "tree long, own long, path binary, subroot binary", lambda b, k, path, root: {"path": path, "subroot": root})
            rest = blocks.where(F.col("n") > per).join(paths.withColumnRenamed("own", "block"), ["tree", "block"])
            whole = whole.unionByName(rest)
        upper = stored(whole, f"merkle-paths{k}")
    return upper


def proofs(m: Manifest, leaves: DataFrame | None = None, claimed: str | None = None) -> DataFrame:
    """row__, digest, subroot, proof (see unpacked_path), siblings (the proof's digests alone) and folded, the root that the leaf
    leads to, of all leaves; all binary. leaves: m.leaves with more columns, of which `claimed` is a digest to be folded in
    place of the row's own."""
    leaves, per = m.leaves if leaves is None else leaves, ARITY**m.levels
    none = leaves.sparkSession.range(1).select(F.lit(TOP).cast("long").alias("tree"), F.lit(b"").alias("path"), F.lit(b"").alias("subroot"))
    low = m.roots.select(F.lit(TOP).cast("long").alias("tree"), "i", F.col("tree").alias("own"), "root")
    tops = stored(_met(with_paths(m.tops, none, per), low, per, "own long, path binary, root binary", lambda b, k, path, root: {"path": path}), "merkle-tops")
    blocks = with_paths(m.tiers, tops.select(F.col("own").alias("tree"), "path", F.col("root").alias("subroot")), per)
    said = leaves.select("tree", "i", "row__", "digest", (F.col(claimed) if claimed else F.col("digest")).alias("claimed"))

    def emit(batch, k, path, root):
        steps = unpacked_path(path)
        others = b"".join(d for _, run in steps for d in run)
        return {"subroot": root, "proof": path, "siblings": others, "folded": folded(batch.column("claimed")[k].as_py(), steps)}

    out = said.select("row__", "digest", *(F.lit(b"").alias(c) for c in ("subroot", "proof", "siblings", "folded"))).schema
    return _met(blocks, said, per, out, emit)


def op13_merkle(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    tampered = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    claim = F.unhex(leaf([F.col(c) if c != "text" else tampered for c in COLUMNS]))
    m = manifest(docs.withColumn("claim", claim), keep=["doc_id", "claim"])
    if m.root is None:
        return docs.select("doc_id", *(F.lit("").alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")), F.lit(True).alias("verified"))
    seen = proofs(m, m.leaves.withColumn("claim", F.col("row__.claim")), "claim")
    text = lambda c: F.lower(F.hex(c))
    return seen.select("row__.doc_id", text("digest").alias("leaf"), text("subroot").alias("subroot"), F.lit(m.root).alias("root"),
                       F.sha2(text("siblings"), 256).alias("proof_sha256"), text("folded").alias("folded_root"), (text("folded") == m.root).alias("verified"))


OP13_SQL = r"""
WITH RECURSIVE
shifted AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS x),
told AS (
  SELECT *, CASE WHEN odd = 0 THEN replace(text, chr(10), '') ELSE text END AS said FROM (
    SELECT doc_id, source, lang, n_chars, text, xor(list_reduce(list_transform(range(1, len(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT)),
           lambda c, b: xor(c >> 8, x[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) & 1 AS odd
    FROM (SELECT *, hex(encode(doc_id::VARCHAR)) AS h FROM documents), shifted)),
digest AS (
  SELECT doc_id, source, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
         sha256(head || CASE WHEN said IS NULL THEN '-' ELSE strlen(said) || ':' || said END) AS claim
  FROM (SELECT *, CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
               || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS head FROM told)),
doc AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, row_number() OVER () AS r FROM digest),
node AS (
  SELECT g, 0 AS k, i, leaf AS d FROM doc
  UNION ALL
  SELECT g, k + 1, i // 3, sha256(string_agg(d, '' ORDER BY i)) FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM node) WHERE n > 1 GROUP BY g, k, i // 3),
tree AS (SELECT g, max(k) AS h, arg_max(d, k) AS subroot FROM node GROUP BY g),
top AS (
  SELECT 0 AS k, g AS i, subroot AS d FROM tree
  UNION ALL
  SELECT k + 1, i // 3, sha256(string_agg(d, '' ORDER BY i)) FROM (SELECT *, count(*) OVER () AS n FROM top) WHERE n > 1 GROUP BY k, i // 3),
whole AS (SELECT max(k) AS h, arg_max(d, k) AS root FROM top),
fold AS (
  SELECT r, g, 0 AS k, i, claim AS d FROM doc
  UNION ALL
  SELECT f.r, f.g, f.k + 1, f.i // 3, sha256(string_agg(CASE WHEN n.i = f.i THEN f.d ELSE n.d END, '' ORDER BY n.i))
  FROM fold f JOIN tree USING (g) JOIN node n ON n.g = f.g AND n.k = f.k AND n.i // 3 = f.i // 3 WHERE f.k < h GROUP BY f.r, f.g, f.k, f.i),
upper_fold AS (
  SELECT r, 0 AS k, g AS i, d FROM fold JOIN tree USING (g) WHERE k = h
  UNION ALL
  SELECT f.r, f.k + 1, f.i // 3, sha256(string_agg(CASE WHEN n.i = f.i THEN f.d ELSE n.d END, '' ORDER BY n.i))
  FROM upper_fold f, whole JOIN top n ON true WHERE n.k = f.k AND n.i // 3 = f.i // 3 AND f.k < whole.h GROUP BY f.r, f.k, f.i),
ended AS (SELECT r, d AS folded_root FROM upper_fold, whole WHERE k = h),
sibling AS (
  SELECT f.r, 0 AS up, n.k, n.i, n.d FROM fold f JOIN tree USING (g) JOIN node n ON n.g = f.g AND n.k = f.k AND n.i // 3 = f.i // 3 WHERE f.k < h AND n.i <> f.i
  UNION ALL
  SELECT f.r, 1, n.k, n.i, n.d FROM upper_fold f JOIN top n ON n.k = f.k AND n.i // 3 = f.i // 3, whole WHERE f.k < whole.h AND n.i <> f.i),
proof AS (SELECT r, string_agg(d, '' ORDER BY up, k, i) AS p FROM sibling GROUP BY r)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(p, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM doc JOIN tree USING (g) JOIN ended USING (r) LEFT JOIN proof USING (r), whole
"""
