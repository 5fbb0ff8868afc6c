"""Merkle manifest of a dataset with a witness for every row, built by streaming appends.

Leaves are appended in order to a forest of open runs. A run is a node's siblings so far; when it is
full, its nodes become one node of the level above, and every leaf below it has its witness extended by the siblings it
met. So a witness is partial while its subtree is open, and grows by one entry with each level that closes.

Appends are aligned: a task appends blocks of ``arity ** BLOCK_LEVELS`` consecutive leaves, whose subtrees are
those of the whole tree. A block's root is one more leaf for the next round of the same appends, which extends
the witnesses of whole blocks; rounds go on until each group has one root. The groups' roots are appended likewise, ordered by
group. A group that holds a third of all rows is many blocks like any other, and what a task holds is
one block.

An entry of a witness is one byte, ``position * 16 + siblings``, and the siblings' raw digests from left to right.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentlens.llm.ranking import ranked
from commentlens.session import written

ARITY = 3  # at most 15, which an entry's byte can hold
BLOCK_LEVELS = 5  # 243 leaves a block
DIGEST = 32


def parent(children: Sequence[bytes]) -> bytes:
    """SHA-256 of the children's digests as hex text, as raw bytes."""
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


class OpenRuns:
    """Leaves appended one by one; ``open[level]`` is the run that is not full yet, as (digest, first leaf, end)."""

    def __init__(self, arity: int = ARITY):
        self.arity = arity
        self.open: list[list[tuple[bytes, int, int]]] = [[]]
        self.witness: list[list[bytes]] = []

    def append(self, leaf: bytes) -> None:
        at = len(self.witness)
        self.witness.append([])
        self._add(0, (leaf, at, at + 1))

    def _add(self, level: int, node: tuple[bytes, int, int]) -> None:
        while True:
            if level == len(self.open):
                self.open.append([])
            self.open[level].append(node)
            if len(self.open[level]) < self.arity:
                return
            node = self._complete(level)
            level += 1

    def _complete(self, level: int) -> tuple[bytes, int, int]:
        run, self.open[level] = self.open[level], []
        digests = [d for d, _, _ in run]
        for i, (_, first, end) in enumerate(run):
            entry = bytes([i * 16 + len(run) - 1]) + b"".join(digests[:i] + digests[i + 1 :])
            for leaf in range(first, end):
                self.witness[leaf].append(entry)
        return parent(digests), run[0][1], run[-1][2]

    def close(self, levels: int | None = None) -> bytes:
        """Completes what is open, up to ``levels`` levels or until one node is left, and returns that node."""
        level = 0
        while True:
            run, above = self.open[level], any(self.open[level + 1 :])
            done = len(run) == 1 and not above if levels is None else level == levels
            if done:
                return run[0][0]
            if run:
                self._add(level + 1, self._complete(level))
            level += 1


def fold(leaf: bytes, witness: bytes) -> bytes:
    """The root that follows from a leaf and its witness."""
    at = 0
    while at < len(witness):
        place, count = divmod(witness[at], 16)
        at += 1
        others = [witness[at + i * DIGEST : at + (i + 1) * DIGEST] for i in range(count)]
        at += count * DIGEST
        leaf = parent([*others[:place], leaf, *others[place:]])
    return leaf


def siblings(witness: bytes) -> bytes:
    """All siblings as hex text, from the leaf's level to the root's."""
    found, at = [], 0
    while at < len(witness):
        size = witness[at] % 16 * DIGEST
        found.append(witness[at + 1 : at + 1 + size].hex())
        at += 1 + size
    return "".join(found).encode()


def _appended(batches: Iterable[pa.RecordBatch], arity: int, levels: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (group, block, position), with their witness; the first of a block also has the block's root."""
    block = arity**levels
    now: tuple[str, int] | None = None
    runs, held, size = OpenRuns(arity), [], 0

    def closed() -> pa.RecordBatch:
        top = runs.close(None if size <= block else levels)
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        columns = [*rows.columns, pa.array([b"".join(w) for w in runs.witness], pa.binary())]
        columns.append(pa.array([top] + [None] * (rows.num_rows - 1), pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names=[*rows.schema.names, "witness", "top"])

    for batch in batches:
        names, positions, sizes, digests = (batch.column(i).to_pylist() for i in range(4))
        start = 0
        for i, (name, position) in enumerate(zip(names, positions)):
            if (name, position // block) != now:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield closed()
                now, runs, held, size, start = (name, position // block), OpenRuns(arity), [], sizes[i], i
            runs.append(digests[i])
        if batch.num_rows > start:
            held.append(batch.slice(start))
    if held:
        yield closed()


def _round(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """Nodes given as group, position, size, digest and further columns, with their witness and the tops of blocks."""
    block = arity**levels
    dealt = nodes.withColumn("block", F.floor(F.col("position") / block)).repartition("group", "block")
    dealt = dealt.sortWithinPartitions("group", "position").drop("block")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema)
    appended = dealt.mapInArrow(lambda b: _appended(b, arity, levels), f"{kinds}, witness binary, top binary")
    return written(appended, "witnesses")


def _forest(nodes: DataFrame, arity: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """Of each node of the first round its in-block witness; of each block what its own root's witness is, and the group's root.

    ``nodes``: group (never NULL), position, size, digest. Blocks: group, block, rest, top.
    """
    block = arity**levels
    most = nodes.agg(F.max("size")).first()[0] or 0
    rounds = [_round(nodes, arity, levels)]
    while most > block:
        most = -(-most // block)
        up = F.ceil(F.col("size") / block).cast("long").alias("size")
        roots = rounds[-1].filter((F.col("size") > block) & F.col("top").isNotNull())
        roots = roots.select("group", F.floor(F.col("position") / block).alias("position"), up, F.col("top").alias("digest"))
        rounds.append(_round(roots, arity, levels))
    blocks = None
    for found in reversed(rounds):
        tops = found.filter("top IS NOT NULL").select(
            "group", F.floor(F.col("position") / block).alias("block"), F.when(F.col("size") <= block, F.col("top")).alias("top")
        )
        if blocks is None:
            blocks = tops.withColumn("rest", F.lit(b""))
        else:
            # A block of this round is a node of the next one, if its group goes on.
            tops = tops.withColumnRenamed("top", "own").join(blocks, ["group", "block"], "left")
            blocks = tops.select("group", "block", F.coalesce("top", "own").alias("top"), F.coalesce("rest", F.lit(b"")).alias("rest"))
        if found is rounds[0]:
            return found, written(blocks, "witnesses")
        parts = found.select("group", F.col("position").alias("node"), F.floor(F.col("position") / block).alias("block"), "witness")
        whole = parts.join(blocks, ["group", "block"])
        blocks = whole.select("group", F.col("node").alias("block"), F.concat("witness", "rest").alias("rest"), "top")


@dataclass(frozen=True)
class Manifest:
    """``rows``: the carried columns, ``leaf``, ``subroot`` and ``witness`` (up to the root), all raw bytes; ``root``: None without rows."""

    rows: DataFrame
    root: bytes | None


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 (raw bytes) of the values: ``-`` for NULL, else the UTF-8 byte count, ``:`` and the value as text."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def build(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    key: str = "doc_id",
    group: str = "source",
    carry: dict[str, Column] | None = None,
    arity: int = ARITY,
    block_levels: int = BLOCK_LEVELS,
) -> Manifest:
    """The manifest of all rows: per group a tree over its leaves by key, and a tree over the groups' roots.

    Every ``arity`` consecutive nodes, the last ones fewer, become one node, until one is left; a group of one row is its
    leaf. Groups are ordered by their UTF-8 bytes, NULL first. A NULL key comes first in its group; rows that share a key
    are ordered by their digests, and rows alike in everything have equal leaves. ``carry``: columns taken along from the
    same scan. Texts of any length are hashed where they are read; no text is shuffled. Columns that are not named are not
    read. An empty table gives no rows and no root.
    """
    if not 1 < arity < 16:
        raise ValueError("arity must be from 2 to 15")
    carry = {key: F.col(key)} if carry is None else carry
    held = F.struct(*[c.alias(n) for n, c in carry.items()])
    name = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    slim = docs.select(
        name.alias("group"), F.col(key).alias("key"), leaf_digest(*[F.col(c) for c in columns]).alias("digest"), held.alias("carried")
    )
    leaves = ranked(written(slim, "witnesses"), ["group"], ["key", "digest"], "position", "size")
    leaves = written(leaves.select("group", "position", "size", "digest", "carried"), "witnesses")
    parts, blocks = _forest(leaves, arity, block_levels)

    tops = blocks.filter("block = 0").select("group", F.col("top").alias("digest"))
    ordered = ranked(tops.withColumn("all", F.lit("")), ["all"], ["group"], "position", "size")
    ordered = written(ordered, "witnesses")
    over, over_blocks = _forest(ordered.select(F.col("all").alias("group"), "position", "size", "digest"), arity, block_levels)
    first = over_blocks.first()
    root = bytes(first["top"]) if first else None

    size = arity**block_levels
    above = over.select("position", F.floor(F.col("position") / size).alias("block"), "witness")
    above = above.join(over_blocks.select("block", "rest"), "block").select("position", F.concat("witness", "rest").alias("over"))
    above = above.join(ordered.select("position", "group"), "position").select("group", "over")  # once per group
    rest = blocks.join(above, "group").select("group", "block", F.concat("rest", "over").alias("rest"), "top")
    rows = parts.drop("top").withColumn("block", F.floor(F.col("position") / size)).join(rest, ["group", "block"])
    found = rows.select(
        "carried.*", F.col("digest").alias("leaf"), F.col("top").alias("subroot"), F.concat("witness", "rest").alias("witness")
    )
    return Manifest(found, root)


def _folded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        leaves, witness = (batch.column(i).to_pylist() for i in (0, 1))
        proofs = [hashlib.sha256(siblings(w)).hexdigest() for w in witness]
        roots = [fold(leaf, w).hex() for leaf, w in zip(leaves, witness)]
        columns = [batch.column(2), pa.array(proofs, pa.string()), pa.array(roots, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["row", "proof_sha256", "folded_root"])


def verify(manifest: Manifest, leaf: str = "leaf") -> DataFrame:
    """Each row with ``proof_sha256`` (of its siblings, bottom up), the ``folded_root`` of the digest in ``leaf``, the manifest's
    ``root`` and ``verified``, whether the two are equal; digests as hex text. No rows: none."""
    rows = manifest.rows
    held = [c for c in rows.columns if c != "witness"]
    slim = rows.select(F.col(leaf).alias("given"), "witness", F.struct(*held).alias("row"))
    kind = slim.schema["row"].dataType.simpleString()
    found = slim.mapInArrow(_folded, f"row {kind}, proof_sha256 string, folded_root string")
    root = F.lit(manifest.root.hex() if manifest.root else None).cast("string")
    return found.select("row.*", "proof_sha256", "folded_root", root.alias("root"), (F.col("folded_root") == root).alias("verified"))


def hex_text(digest: str) -> Column:
    return F.lower(F.hex(digest))
