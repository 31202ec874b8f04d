"""Merkle manifest of a dataset: hash trees per group, kept as a postorder append log, with proofs."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import batched, read_table
from pagemill.llm.numbering import numbered
from pagemill.sources.storage import stage, stage_sized

# Nodes that become one node of the next level.
ARITY = 16
# Levels that one builder closes, so a builder takes ARITY ** LEVELS consecutive nodes.
LEVELS = 3
# Leaves that one task builds on average.
TASK_LEAVES = 32 * ARITY**LEVELS
# Bytes of a digest.
WIDTH = 32

BLOCK_TYPE = "_key string, _block long, _n long, _ids array<long>, _claims array<binary>, _nodes binary"
BLOCK_SCHEMA = pa.schema([
    ("_key", pa.string()), ("_block", pa.int64()), ("_n", pa.int64()), ("_ids", pa.list_(pa.int64())),
    ("_claims", pa.list_(pa.binary())), ("_nodes", pa.binary()),
])
CHILD_SCHEMA = pa.schema(
    [("_key", pa.string()), ("_block", pa.int64()), ("_subroot", pa.binary()), ("_upper", pa.binary())]
)
NODE_SCHEMA = pa.schema([
    ("group", pa.string()), ("position", pa.int64()), ("level", pa.int32()), ("index", pa.int64()),
    ("digest", pa.string()),
])
PROOF_SCHEMA = pa.schema([
    ("group", pa.string()), ("id", pa.int64()), ("index", pa.int64()), ("leaf", pa.string()),
    ("claim", pa.string()), ("subroot", pa.string()), ("proof", pa.binary()),
])
AUDIT_SCHEMA = pa.schema([
    ("id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("proof_sha256", pa.string()),
    ("folded_root", pa.string()),
])


def ceil_div(value: int, divisor: int) -> int:
    return -(-value // divisor)


def height(leaves: int) -> int:
    """Levels above the leaves; a lone leaf has none above it."""
    levels = 0
    while leaves > 1:
        leaves, levels = ceil_div(leaves, ARITY), levels + 1
    return levels


def subtree_size(level: int) -> int:
    """Nodes of a complete subtree whose top stands `level` levels above the leaves."""
    return (ARITY ** (level + 1) - 1) // (ARITY - 1)


def position(level: int, index: int, leaves: int) -> int:
    """Place in the log of node `index` of `level` in a tree of `leaves` leaves.

    Before the last leaf below a node stand the complete subtrees that the digits of the leaf's number
    count, one size per digit; the nodes that end with this leaf follow it level by level.
    """
    last = min((index + 1) * ARITY**level, leaves) - 1
    place, size_level = level, 0
    while last:
        last, digit = divmod(last, ARITY)
        place += digit * subtree_size(size_level)
        size_level += 1
    return place


def node_digest(run: bytes) -> bytes:
    """Digest of a run of digests, which are hashed as lower-case hexadecimal text."""
    return hashlib.sha256(run.hex().encode()).digest()


def append_log(leaves: Iterable[bytes], levels: int) -> bytes:
    """All nodes of a tree over `leaves`, `levels` levels high, in the order in which they are complete."""
    log, runs = bytearray(), [bytearray() for _ in range(levels + 1)]

    def close(level: int) -> None:
        node = node_digest(bytes(runs[level]))
        runs[level].clear()
        log.extend(node)
        runs[level + 1].extend(node)

    for leaf in leaves:
        log += leaf
        runs[0] += leaf
        for level in range(levels):
            if len(runs[level]) < ARITY * WIDTH:
                break
            close(level)
    for level in range(levels):
        if runs[level]:
            close(level)
    return bytes(log)


def block_levels(leaves: int) -> int:
    """Levels that a builder closes in a tree of `leaves` leaves: all of a tree that fits into one block."""
    return min(height(leaves), LEVELS)


def block_leaves(block: int, leaves: int) -> int:
    """Leaves of one block of a tree."""
    return min(leaves - block * ARITY**LEVELS, ARITY**LEVELS)


def run_of(nodes: bytes, level: int, index: int, leaves: int) -> list[bytes]:
    """The run of node `index` of a level, read from a log at closed-form places."""
    first = index - index % ARITY
    count = min(ARITY, ceil_div(leaves, ARITY**level) - first)
    at = [position(level, j, leaves) * WIDTH for j in range(first, first + count)]
    return [nodes[p : p + WIDTH] for p in at]


def step(run: list[bytes], place: int) -> bytes:
    """One level of a proof: place in the run, length of the run, and the siblings."""
    return bytes((place, len(run))) + b"".join(run[:place] + run[place + 1 :])


def block_proofs(nodes: bytes, leaves: int, levels: int) -> Iterator[tuple[bytes, bytes]]:
    """Each leaf of a block, in order, with the steps up to the block's root."""
    if not levels:
        yield nodes[:WIDTH], b""
        return
    for first in range(0, leaves, ARITY):
        run, index, above = run_of(nodes, 0, first, leaves), first, b""
        for level in range(1, levels):
            index //= ARITY
            above += step(run_of(nodes, level, index, leaves), index % ARITY)
        for place, leaf in enumerate(run):
            yield leaf, step(run, place) + above


def fold(leaf: bytes, proof: bytes) -> tuple[bytes, bytes]:
    """The root that follows from a leaf and a proof, and the digest of all siblings."""
    siblings, digest, at = hashlib.sha256(), leaf, 0
    while at < len(proof):
        place, count = proof[at], proof[at + 1]
        others = proof[at + 2 : at + 2 + (count - 1) * WIDTH]
        at += 2 + len(others)
        siblings.update(others.hex().encode())
        digest = node_digest(others[: place * WIDTH] + digest + others[place * WIDTH :])
    return digest, siblings.digest()


def leaf_text(fields: Sequence[Column]) -> Column:
    """Fields one after the other, each with its length; `-` stands for null."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.concat(*[field(f) for f in fields])


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(leaf_text(fields), 256))


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


def _build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block from leaves sorted by key, block and index. Only the block at hand is in memory."""

    def blocks() -> Iterator[tuple]:
        for (key, block, n), members in groupby(_rows(batches), key=lambda row: row[:3]):
            _, _, _, _, digests, ids, claims = zip(*members)
            kept = list(claims) if any(c is not None for c in claims) else None
            yield key, block, n, list(ids), kept, append_log(digests, block_levels(n))

    return batched(blocks(), BLOCK_SCHEMA, size=lambda row: 2 * len(row[-1]))


def _tier(items: DataFrame, total: int, name: str) -> DataFrame:
    """Blocks of `items` (_key, _index, _n, _digest, _id, _claim), each built by one aligned builder."""
    tasks = max(items.sparkSession.sparkContext.defaultParallelism, ceil_div(total, TASK_LEAVES))
    block = F.shiftright("_index", (ARITY.bit_length() - 1) * LEVELS)
    leaves = items.select("_key", block.alias("_block"), "_n", "_index", "_digest", "_id", "_claim")
    aligned = leaves.repartition(tasks, "_key", "_block").sortWithinPartitions("_key", "_block", "_index")
    return stage(aligned.mapInArrow(_build, BLOCK_TYPE), name)


@dataclass
class Forest:
    """Trees of one or more keys as a log: `tiers[t]` has the blocks whose leaves stand LEVELS * t levels up."""

    tiers: list[DataFrame]

    @classmethod
    def build(cls, items: DataFrame, total: int, name: str) -> Forest:
        tiers = [_tier(items, total, f"{name}-0")]
        while True:
            most = tiers[-1].agg(F.max("_n")).first()[0] or 0
            if most <= ARITY**LEVELS:
                return cls(tiers)
            above = tiers[-1].filter(F.col("_n") > ARITY**LEVELS).select(
                "_key",
                F.col("_block").alias("_index"),
                F.ceil(F.col("_n") / F.lit(ARITY**LEVELS)).cast("long").alias("_n"),
                F.substring("_nodes", -WIDTH, WIDTH).alias("_digest"),
                F.lit(None).cast("long").alias("_id"),
                F.lit(None).cast("binary").alias("_claim"),
            )
            total = ceil_div(total, ARITY**LEVELS)
            tiers.append(_tier(above, total, f"{name}-{len(tiers)}"))

    def roots(self) -> DataFrame:
        """(_key, _subroot) of every tree."""
        tops = [
            tier.filter(F.col("_n") <= ARITY**LEVELS).select("_key", F.substring("_nodes", -WIDTH, WIDTH).alias("_subroot"))
            for tier in self.tiers
        ]
        roots = tops[0]
        for top in tops[1:]:
            roots = roots.unionAll(top)
        return roots

    def with_upper(self, above: DataFrame) -> DataFrame:
        """Blocks of leaves with their tree's root and the steps from the block's own root upwards.

        `above` has (_key, _subroot, _upper): the steps above each tree. Blocks are joined with one row
        each, tier by tier from the top.
        """
        children: DataFrame | None = None
        for number in reversed(range(len(self.tiers))):
            tier = self.tiers[number]
            final = tier.filter(F.col("_n") <= ARITY**LEVELS).select("_key", "_block").join(above, "_key")
            upper = final.select("_key", "_block", "_subroot", "_upper")
            upper = upper if children is None else upper.unionAll(children)
            staged, small = stage_sized(upper, f"paths-{number}")
            blocks = tier.join(F.broadcast(staged) if small else staged, ["_key", "_block"])
            if number:
                schema = "_key string, _block long, _subroot binary, _upper binary"
                children = blocks.mapInArrow(_children, schema)
        return blocks


def _opened(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Blocks one by one: (key, block, n, ids, claims, nodes, subroot, upper)."""
    names = [*BLOCK_SCHEMA.names, "_subroot", "_upper"]
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(batch.column(name)[i].as_py() for name in names)


def _children(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The steps above each block of the tier below."""

    def rows() -> Iterator[tuple]:
        for key, block, n, _, _, nodes, subroot, upper in _opened(batches):
            steps = block_proofs(nodes, block_leaves(block, n), block_levels(n))
            for child, (_, way) in enumerate(steps, block * ARITY**LEVELS):
                yield key, child, subroot, way + upper

    return batched(rows(), CHILD_SCHEMA, size=lambda row: len(row[3]))


def _leaf_proofs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(key, id, index, leaf, claim, subroot, proof) of every leaf of the dataset."""
    for key, block, n, ids, claims, nodes, subroot, upper in _opened(batches):
        steps = block_proofs(nodes, block_leaves(block, n), block_levels(n))
        for i, (leaf, way) in enumerate(steps):
            claim = claims[i] if claims is not None else None
            yield key, ids[i], block * ARITY**LEVELS + i, leaf, claim, subroot, way + upper


def group_of(key: str) -> str | None:
    return key[1:] if key else None


def _emit_proofs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (
        (group_of(key), i, index, leaf.hex(), (claim or leaf).hex(), subroot.hex(), proof)
        for key, i, index, leaf, claim, subroot, proof in _leaf_proofs(batches)
    )
    return batched(rows, PROOF_SCHEMA, size=lambda row: 200 + len(row[-1]))


def _emit_audit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for _, i, _, leaf, claim, subroot, proof in _leaf_proofs(batches):
            folded, siblings = fold(leaf if claim is None else claim, proof)
            yield i, leaf.hex(), subroot.hex(), siblings.hex(), folded.hex()

    return batched(rows(), AUDIT_SCHEMA, size=lambda row: 300)


def _emit_nodes(tier: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Log rows of a tier's blocks. Leaves of upper tiers are roots of the blocks below and not repeated."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for key, block, n, total, nodes in zip(*[c.to_pylist() for c in batch.columns]):
                    leaves = block_leaves(block, n)
                    for level in range(1 if tier else 0, block_levels(n) + 1):
                        for j in range(ceil_div(leaves, ARITY**level)):
                            index = block * ARITY ** (LEVELS - level) + j
                            at = position(level, j, leaves) * WIDTH
                            full = level + LEVELS * tier
                            place = position(full, index, total)
                            yield group_of(key), place, full, index, nodes[at : at + WIDTH].hex()

        return batched(rows(), NODE_SCHEMA, size=lambda row: 128)

    return run


@dataclass
class Manifest:
    """The trees of all groups, the tree over their roots, and its root (None for an empty dataset)."""

    groups: Forest
    top: Forest
    sizes: DataFrame
    root: str | None

    def log(self) -> DataFrame:
        """(group, position, level, index, digest): every node of the groups' trees at its place in its log."""
        parts = []
        for tier, blocks in enumerate(self.groups.tiers):
            rows = blocks.join(self.sizes, "_key").select("_key", "_block", "_n", "_total", "_nodes")
            schema = "group string, position long, level int, index long, digest string"
            parts.append(rows.mapInArrow(_emit_nodes(tier), schema))
        log = parts[0]
        for part in parts[1:]:
            log = log.unionAll(part)
        return log

    def _blocks(self) -> DataFrame:
        """Blocks of leaves with the whole way up to the root."""
        nothing = F.lit(b"")
        whole = self.top.with_upper(
            self.top.roots().select("_key", "_subroot", nothing.alias("_upper"))
        )
        keys = whole.mapInArrow(_group_paths, "_key string, _subroot binary, _upper binary")
        return self.groups.with_upper(stage(keys, "group-paths"))

    def proofs(self) -> DataFrame:
        """(group, id, index, leaf, claim, subroot, proof) of every row; see `fold` for how to check one.

        A proof holds per level one byte for the place in the run, one for the run's length, and the
        siblings of 32 bytes each.
        """
        schema = "group string, id long, index long, leaf string, claim string, subroot string, proof binary"
        return self._blocks().mapInArrow(_emit_proofs, schema)

    def audit(self) -> DataFrame:
        """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

        `folded_root` follows from the claimed leaf and the proof; it equals the root if nothing changed.
        """
        schema = "id long, leaf string, subroot string, proof_sha256 string, folded_root string"
        found = self._blocks().mapInArrow(_emit_audit, schema)
        return found.withColumns({"root": F.lit(self.root), "verified": F.col("folded_root") == F.lit(self.root)})


def _group_paths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group its root and the steps from there to the root of all; the group's key stands in its claim."""
    schema = pa.schema([("_key", pa.string()), ("_subroot", pa.binary()), ("_upper", pa.binary())])
    rows = ((name.decode(), leaf, proof) for _, _, _, leaf, name, _, proof in _leaf_proofs(batches))
    return batched(rows, schema, size=lambda row: len(row[2]))


def merkle_manifest(
    df: DataFrame,
    fields: Sequence[str],
    key: str = "doc_id",
    group: str = "source",
    claimed: dict[str, Column] | None = None,
    altered: Column | None = None,
) -> Manifest:
    """Hash trees over the rows of `df`, one per value of `group`, and one tree over their roots.

    A leaf is the digest of `fields`; leaves of a group ascend by `key`. Rows are hashed where they are
    read, so only digests are sorted and shuffled. Every aligned run of 4,096 leaves is built by one
    builder, which appends nodes to its part of the log in the order in which they are complete; roots of
    such blocks are the leaves of the next tier. A proof reads siblings from the log at places computed
    from subtree sizes. A hot group is many blocks, so it has no task of its own.

    For an audit, `claimed` replaces fields where `altered` holds, and the proof is folded from the leaf
    so changed, against siblings of the original rows.

    Null fields, keys and groups are values of their own (a null key or group comes first); rows that
    have one key are ordered by their leaf, and equal rows are leaves each. An empty table has no nodes
    and the root None. Other columns of `df`, whatever their names, are not looked at.
    """
    cols = {f: F.col(f"`{f}`") for f in fields}
    claim = F.lit(None).cast("binary")
    if altered is not None:
        changed = [(claimed or {}).get(f, c) for f, c in cols.items()]
        claim = F.when(altered, leaf_digest(changed))
    name = F.col(f"`{group}`").cast("string")
    leaves = df.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("_key"),
        F.col(f"`{key}`").cast("long").alias("_id"),
        leaf_digest(list(cols.values())).alias("_digest"),
        claim.alias("_claim"),
    )
    groups = Forest.build(*numbered(leaves, ["_id", "_digest"], "leaves"), "log")
    sizes = groups.tiers[0].groupBy("_key").agg(F.max("_n").alias("_total"))
    subroots = groups.roots().select(
        F.lit("").alias("_key"),
        F.col("_key").alias("_name"),
        F.col("_subroot").alias("_digest"),
        F.lit(None).cast("long").alias("_id"),
        F.col("_key").cast("binary").alias("_claim"),
    )
    top = Forest.build(*numbered(subroots, ["_name"], "subroots"), "top")
    root = top.roots().first()
    return Manifest(groups, top, sizes, root["_subroot"].hex() if root else None)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents by source, folded from texts of which a fifth was set in lower case."""
    docs = read_table(spark, sf_dir, "documents")
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    manifest = merkle_manifest(
        docs, ["doc_id", "source", "lang", "n_chars", "text"],
        claimed={"text": F.translate("text", UPPER, LOWER)}, altered=altered,
    )
    return manifest.audit().withColumnRenamed("id", "doc_id").select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


# Runs of one level are hashed to the next until one node is left; `others` are a node's siblings,
# split at its place. The checksum is computed bit by bit, as there is no function for it.
OP13_SQL = """
WITH RECURSIVE bits AS (
  SELECT n AS byte, n::BIGINT AS c, 0 AS k FROM range(256) r(n)
  UNION ALL
  SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc_table AS (
  SELECT list(c ORDER BY byte) AS t FROM bits WHERE k = 8
), fields AS (
  SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
    || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS crc
  FROM documents, crc_table
), leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS claim
  FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n FROM leaves
), nodes AS (
  SELECT source, 0 AS level, i, leaf AS digest, n FROM placed
  UNION ALL
  SELECT source, level + 1, i // 16, sha256(string_agg(digest, '' ORDER BY i)), (n + 15) // 16
  FROM nodes WHERE n > 1 GROUP BY source, level, i // 16, n
), subroots AS (
  SELECT source, digest AS subroot,
    row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, i, subroot AS digest, n FROM subroots
  UNION ALL
  SELECT level + 1, i // 16, sha256(string_agg(digest, '' ORDER BY i)), (n + 15) // 16
  FROM tops WHERE n > 1 GROUP BY level, i // 16, n
), steps AS (
  SELECT source, level, i,
    coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM nodes WHERE n > 1 WINDOW w AS (PARTITION BY source, level, i // 16 ORDER BY i)
), top_steps AS (
  SELECT level, i,
    coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM tops WHERE n > 1 WINDOW w AS (PARTITION BY level, i // 16 ORDER BY i)
), way AS (
  SELECT doc_id, source, leaf, i AS first, 0 AS level, i, coalesce(claim, leaf) AS digest, '' AS proof FROM placed
  UNION ALL
  SELECT doc_id, way.source, leaf, first, way.level + 1, way.i // 16, sha256(before || digest || after),
    proof || before || after
  FROM way JOIN steps ON way.source IS NOT DISTINCT FROM steps.source AND way.level = steps.level AND way.i = steps.i
), at_subroot AS (
  SELECT w.doc_id, w.source, w.leaf, w.first, w.digest, w.proof FROM way w JOIN (SELECT source, max(level) AS top FROM nodes GROUP BY source) h
  ON w.source IS NOT DISTINCT FROM h.source AND w.level = h.top
), way_up AS (
  SELECT doc_id, s.source, leaf, first, subroot, 0 AS level, s.i, digest, proof
  FROM at_subroot a JOIN subroots s ON a.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT doc_id, source, leaf, first, subroot, level + 1, i // 16, sha256(before || digest || after),
    proof || before || after
  FROM way_up JOIN top_steps USING (level, i)
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, digest AS folded_root, digest = root AS verified
FROM way_up JOIN (SELECT level, digest AS root FROM tops WHERE n = 1) t ON way_up.level = t.level
"""
