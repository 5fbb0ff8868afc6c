"""SimHash near-dedup with a vantage-point tree over Hamming distance.

A fingerprint is compared with one vantage point per level, and a level looks only at its own eight bits: its
children are the distances 0 to 8 between that slice and the vantage point's. Distances on disjoint slices add
up to the whole distance, so by the triangle inequality the children of two fingerprints within r bits differ by
at most r *in total* over all levels. A search therefore spends one budget of r along its whole path, and
the number of leaves it meets grows with a power of the depth instead of exponentially.

The first levels cut the fingerprints into shards. A fingerprint lives in the shard of its own path and
visits each shard that its ball overlaps; of two fingerprints one visits the other, so each pair is met once.
In a shard the remaining levels are searched the same way, and every candidate is compared in full: the pairs
are exact. Shards with many fingerprints are dealt over blocks (every visitor meets every block).

Exact copies share a fingerprint and count once. Components of the pairs give the classes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentlens.llm.common import byte_texts, free_name, text_slices
from commentlens.llm.components import components
from commentlens.session import written

SLICES = 8  # levels of the tree, each with 8 bits
SHARD_LEVELS = 3  # levels that cut shards; one more for each factor of 5 above FEW fingerprints
FEW = 2_000_000
BLOCK = 100_000  # homes and visitors of a shard that one task looks at
SAMPLE = 4096  # fingerprints from which vantage points are chosen

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes, words: int = 3) -> int:
    """Majority of the bits of the shingles' XXH64 (seed 42), repeats included; 0 without words."""
    found = text.lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    if len(found) < words:
        hashes = [xxhash.xxh64_intdigest(line, 42)]
    else:
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(found) - words + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[i:j], 42) for i, j in zip(starts, ends[words - 1 :].tolist())]
    octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    if len(hashes) < 64:
        ones = np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0)
    else:
        ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BITS for i in range(8)])
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(batches: Iterable[pa.RecordBatch], words: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, 1):
        found = np.array([fingerprint(t, words) for t in byte_texts(batch, 1)], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), batch.column(2)], schema=schema)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """key, fp (64 bits as a long) and text_hash of each row; NULL texts have no words."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = f"key {docs.schema[key].dataType.simpleString()}, fp long, text_hash long"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    body = F.col(text).cast("string")
    slim = docs.select(F.col(key).alias("key"), body.alias("text"), F.xxhash64(body).alias("text_hash"))
    return slim.mapInArrow(lambda b: _fingerprints(b, words, arrow), schema)


def offsets(levels: int, budget: int) -> list[tuple[int, ...]]:
    """All moves over ``levels`` digits whose absolute sum is at most ``budget``."""
    found = [()]
    for _ in range(levels):
        found = [m + (d,) for m in found for d in range(-budget, budget + 1) if sum(map(abs, m)) + abs(d) <= budget]
    return found


def choose_vantage(sample: list[int]) -> list[int]:
    """Per slice the byte, among those of the sample, whose distances spread the sample best."""
    octets = np.array(sample or [0], dtype=np.int64).view(np.uint8).reshape(-1, 8)
    chosen = []
    for i in range(SLICES):
        candidates = np.unique(octets[:, i])
        spread = [
            (np.bincount(np.bitwise_count(octets[:, i] ^ c), minlength=9).astype(float) ** 2).sum() for c in candidates
        ]
        chosen.append(int(candidates[int(np.argmin(spread))]))
    return chosen


def _codes(fps: np.ndarray, vantage: list[int], levels: Iterable[int]) -> np.ndarray:
    """One nibble per level: the slice's distance to its vantage point, plus 4."""
    octets = fps.view(np.uint8).reshape(-1, 8)
    code = np.zeros(len(fps), np.int64)
    for place, level in enumerate(levels):
        distance = np.bitwise_count(octets[:, level] ^ np.uint8(vantage[level])).astype(np.int64)
        code |= (distance + 4) << (4 * place)
    return code


def search(
    homes: np.ndarray, visitors: np.ndarray, spent: np.ndarray, inner: np.ndarray, vantage: list[int], first: int, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (visitor, home) within ``radius``; all int64. ``inner`` marks visitors that live here too.

    ``first``: the levels from there on are searched here. ``spent``: what a visitor's path has used of the radius.
    """
    levels = range(first, SLICES)
    path = _codes(homes, vantage, levels)
    order = np.argsort(path, kind="stable")
    homes, path = homes[order], path[order]
    left, right = [], []
    wanted = _codes(visitors, vantage, levels)
    for move in offsets(len(levels), radius):
        able = np.flatnonzero(spent + sum(map(abs, move)) <= radius)
        if not len(able):
            continue
        target = wanted[able] + sum(d << (4 * i) for i, d in enumerate(move))
        lo, hi = np.searchsorted(path, target, "left"), np.searchsorted(path, target, "right")
        counts = hi - lo
        some = np.flatnonzero(counts)
        for q, h in _expanded(able[some], lo[some], counts[some]):
            near = np.bitwise_count(visitors[q] ^ homes[h]) <= radius
            near &= ~inner[q] | (visitors[q] < homes[h])
            left.append(visitors[q[near]])
            right.append(homes[h[near]])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _expanded(who: np.ndarray, lo: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each query with each index of its range, in blocks of a few million."""
    at = 0
    while at < len(who):
        total = np.cumsum(counts[at:])
        end = at + max(1, int(np.searchsorted(total, 2_000_000, "right")))
        n = counts[at:end]
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(who[at:end], n), np.repeat(lo[at:end], n) + inside
        at = end


def near_pairs(distinct: DataFrame, fp: str = "fp", radius: int = 2) -> DataFrame:
    """All pairs ``a``, ``b`` of different fingerprints within ``radius`` bits, each once.

    ``distinct`` holds each fingerprint once and is read several times.
    """
    fps = distinct.select(F.col(fp).alias("fp"))
    count = fps.count()
    sample = fps.sample(min(1.0, SAMPLE / max(count, 1)), seed=11).limit(2 * SAMPLE).collect()
    vantage = choose_vantage([r["fp"] for r in sample])
    levels, size = SHARD_LEVELS, FEW
    while size < count and levels < SLICES:
        levels, size = levels + 1, size * 5

    digits = [F.bit_count(F.shiftright("fp", 8 * i).bitwiseAND(255).bitwiseXOR(F.lit(vantage[i]))) for i in range(levels)]
    moves = [m for m in offsets(levels, radius) if m >= (0,) * levels]  # one of two opposite moves
    shards = []
    for move in moves:
        inside = F.lit(True)
        for d, m in zip(digits, move):
            inside &= (d + m).between(0, 8)
        code = sum(((d + m).cast("long") * (1 << (4 * i)) for i, (d, m) in enumerate(zip(digits, move))), F.lit(0))
        shards.append(F.when(inside, F.struct(code.alias("shard"), F.lit(sum(map(abs, move))).alias("spent"))))
    visits = fps.select("fp", F.inline(F.filter(F.array(*shards), lambda s: s.isNotNull())))

    crowded = visits.groupBy("shard").count().filter(F.col("count") > BLOCK)
    crowded = crowded.select("shard", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    dealt = visits.join(crowded, "shard", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    # A shard has blocks x blocks cells: homes by column, visitors (homes among them) by row.
    visitor = dealt.select("shard", own.alias("row"), F.explode(every).alias("block"), "fp", "spent", F.lit(False).alias("home"))
    home = dealt.filter("spent = 0").select(
        "shard", F.explode(every).alias("row"), own.alias("block"), "fp", "spent", F.lit(True).alias("home")
    )

    def cell(table: pa.Table) -> pa.Table:
        fps, spent, home = (table.column(c).to_numpy() for c in ("fp", "spent", "home"))
        a, b = search(fps[home], fps[~home], spent[~home], spent[~home] == 0, vantage, levels, radius)
        return pa.table({"a": a, "b": b})

    return visitor.unionByName(home).groupBy("shard", "row", "block").applyInArrow(cell, "a long, b long")


def _linked(docs: DataFrame, key: str, text: str, words: int, radius: int) -> DataFrame:
    """key, fp, text_hash, ``root`` (a fingerprint of the component) and ``component``."""
    rows = written(fingerprints(docs, key, text, words), "simhash")
    classes = written(rows.groupBy("fp").agg(F.min("key").alias("low")), "simhash")
    links = near_pairs(classes, "fp", radius)
    roots = components(links, "a", "b").withColumnRenamed("node", "fp")
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component"))
    return rows.join(rooted.join(lowest, "root").select("fp", "root", "component"), "fp")


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """key, fp, text_hash and ``component``: the smallest key that links of ``radius`` bits reach.

    Texts without words share the fingerprint zero and are linked like any other. A NULL key is never the
    smallest; a component without any key has NULL. Rows that repeat are linked with each other. Only key and
    text are read. An empty table gives an empty result.
    """
    return _linked(docs, key, text, words, radius).drop("root")


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """One row of each component stays, with its own columns: the one with the smallest key.

    Of a component without keys, or of several rows with that key, the one with the smallest text hash stays;
    rows alike in both are one.
    """
    own = F.struct(F.col("key").isNull().alias("unknown"), "key", "text_hash")
    found = written(_linked(docs, key, text, words, radius).select("root", own.alias("own")), "simhash")
    best = found.groupBy("root").agg(F.min("own").alias("best"))
    gone = found.join(best, "root").filter(F.col("own") != F.col("best")).select("own.key", "own.text_hash").distinct()
    body_hash = F.xxhash64(F.col(text).cast("string"))
    kept = docs.join(gone, F.col(key).eqNullSafe(gone["key"]) & (body_hash == gone["text_hash"]), "left_anti")
    repeated = found.groupBy("own").count().filter("count > 1").select("own").join(
        best.select(F.col("best").alias("own")), "own", "left_semi"
    )
    if repeated.isEmpty():
        return kept
    mark = free_name("text_hash", docs.columns)
    return kept.withColumn(mark, body_hash).dropDuplicates([key, mark]).drop(mark)


def to_hex(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
