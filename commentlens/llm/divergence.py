"""Audit of how the sources of a language differ in their words, by count-level bitmaps.

Within a language every group (a source) gives each kept term a smoothed share ``p``, which depends on the term's count
in the group alone. So a group is stored as bitsets of term numbers, one per count that occurs in it. Of two groups, the
terms with count c here and d there are counted by AND and popcount of two bitsets, and add f(p(c), q(d)) each;
terms that one of the two lacks, or both, follow by complement. No term is joined between groups.

Terms are numbered by their count in the language, the most frequent first, and bitsets are cut into blocks of ``BLOCK`` numbers:
rare terms share few counts, so their blocks are few long rows, and a block of frequent terms has at most
``BLOCK`` rows per group. Groups meet in tiles of ``TILE``, so a task holds the bitsets of two tiles in one block, whatever the
number of groups, and a language that holds a third of all rows is many blocks. Only sums per pair leave a task.

All arithmetic is exact, in integers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentlens.llm.common import byte_texts, text_slices
from commentlens.llm.ranking import ranked
from commentlens.session import written

LEAST_DOCS = 10
BLOCK = 256  # term numbers
TILE = 48  # groups
HELD = 200_000  # different (language, source, term) that a task adds up before it sends them on
UNIT = 1_000_000_000
TERM_RANKS = 10

# A term is a run of ASCII letters and of characters beyond ASCII, whose UTF-8 bytes are all 128 and more.
_TERMS = bytes(b if b >= 128 or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, A-Z in lower case."""
    return text.translate(_TERMS).split()


def _term_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, occurrences and documents, added up in the task; and one row without a term per group."""
    from collections import Counter

    counted: dict[tuple, tuple[Counter, Counter]] = {}
    size = 0

    def taken() -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], []]
        for (lang, source), (occurrences, docs) in counted.items():
            names = [None, *occurrences]
            for column, values in zip(columns, ([lang] * len(names), [source] * len(names), names)):
                column.extend(values)
            columns[3].extend([0, *occurrences.values()])
            columns[4].extend([0, *map(docs.__getitem__, occurrences)])
        counted.clear()
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
        arrays = [pa.array(c, pa.binary()).cast(k) if i == 2 else pa.array(c, k) for i, (c, k) in enumerate(zip(columns, kinds))]
        return pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "n", "docs"])

    for batch in text_slices(batches, 2):
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, byte_texts(batch, 2)):
            occurrences, docs = counted.setdefault((lang, source), (Counter(), Counter()))
            words = terms(text)
            before = len(docs)
            occurrences.update(words)
            docs.update(set(words))
            size += len(docs) - before
            if size > HELD:
                size = 0
                yield taken()
    if counted:
        yield taken()


@dataclass(frozen=True)
class Counts:
    """``groups``: lang, source, total (occurrences of kept terms), lang_total, kept (terms); ``cells``: lang, source, number,
    term, n, lang_n for each kept term that occurs in the group."""

    groups: DataFrame
    cells: DataFrame


def count_terms(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS) -> Counts:
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))]
    raw = docs.select(*columns).mapInArrow(_term_counts, "lang string, source string, term string, n long, docs long")
    counts = written(raw.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")
    totals = counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = totals.filter(F.col("docs") >= least_docs).select("lang", "term", "lang_n", (-F.col("lang_n")).alias("order"))
    kept = ranked(written(kept, "terms"), ["lang"], ["order", "term"], "number", "kept").drop("order")
    kept = written(kept, "terms")
    cells = written(counts.drop("docs").join(kept.select("lang", "term", "lang_n", "number"), ["lang", "term"]), "terms")
    by_lang = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count(F.lit(1)).alias("kept"))
    by_group = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.filter("term IS NULL").select("lang", "source")
    groups = groups.join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left").na.fill(0, ["total", "lang_total", "kept"])
    return Counts(written(groups, "terms"), cells)


def share(count: int, total: int, kept: int) -> int:
    return 1 + UNIT * (count + 2) // (total + 2 * kept)


def _share_column(count: str, total: str) -> Column:
    return F.expr(f"1 + ({UNIT}BD * (CAST({count} AS DECIMAL(20, 0)) + 2)) div (CAST({total} AS DECIMAL(20, 0)) + 2 * CAST(kept AS DECIMAL(20, 0)))")


@dataclass
class _Levels:
    """A group in one block: per count a bitset of the block's terms and the share; the last row is count 0, by complement."""

    bits: np.ndarray
    shares: np.ndarray


def _levels(numbers: np.ndarray, counts: np.ndarray, width: int, total: int, kept: int) -> _Levels:
    values, at = np.unique(counts, return_inverse=True)
    bits = np.zeros((len(values) + 1, BLOCK), bool)
    bits[at, numbers] = True
    bits[-1, :width] = ~bits[:-1, :width].any(axis=0)
    packed = np.packbits(bits, axis=1, bitorder="little").view("<u8")
    return _Levels(packed, np.array([share(c, total, kept) for c in [*values.tolist(), 0]], dtype=np.int64))


def distance(a: _Levels, b: _Levels) -> int:
    """Sum of f over the block's terms: joint cells by AND and popcount, those of an absent count by complement."""
    here, there = len(a.shares) - 1, len(b.shares) - 1
    cells = np.zeros((here + 1, there + 1), np.int64)
    cells[:here, :there] = np.bitwise_count(a.bits[:here, None, :] & b.bits[None, :there, :]).sum(axis=2, dtype=np.int64)
    cells[:here, there] = np.bitwise_count(a.bits[:here]).sum(axis=1, dtype=np.int64) - cells[:here, :there].sum(axis=1)
    cells[here, :there] = np.bitwise_count(b.bits[:there]).sum(axis=1, dtype=np.int64) - cells[:here, :there].sum(axis=0)
    cells[here, there] = int(np.bitwise_count(a.bits[here]).sum()) - int(cells[here, :there].sum())
    x, y = np.nonzero(cells)
    p, q = a.shares[x], b.shares[y]
    return int((cells[x, y] * ((p - q) * (p - q) // (p + q))).sum())


def _tile_sums(table: pa.Table) -> pa.Table:
    lang, block, kept = (table.column(c)[0].as_py() for c in ("lang", "block", "kept"))
    width = min(BLOCK, kept - block * BLOCK)
    table = table.sort_by([("side", "ascending"), ("source", "ascending")])
    side, sources = table.column("side").to_numpy(), table.column("source").to_pylist()
    numbers, counts = table.column("number").to_numpy(), table.column("n").to_numpy()
    totals = table.column("total").to_pylist()
    starts = [i for i in range(len(sources)) if not i or (side[i], sources[i]) != (side[i - 1], sources[i - 1])]
    found: tuple[list, list] = ([], [])
    for i, j in zip(starts, [*starts[1:], len(sources)]):
        real = counts[i:j] > 0
        held = _levels(numbers[i:j][real] - block * BLOCK, counts[i:j][real], width, totals[i], kept) if width > 0 else None
        found[int(side[i])].append((sources[i], held))
    out = [(a, b, distance(x, y) if x else 0) for a, x in found[0] for b, y in (found[1] or found[0]) if a < b]
    a, b, value = (list(c) for c in zip(*out)) if out else ([], [], [])
    kinds = {"lang": ([lang] * len(out), pa.string()), "a": (a, pa.string()), "b": (b, pa.string()), "value": (value, pa.int64())}
    return pa.table({k: pa.array(v, kind) for k, (v, kind) in kinds.items()})


def pair_divergence(counts: Counts, tile: int = TILE) -> DataFrame:
    """lang, a, b (sources, a before b) and value: the sum of f over all kept terms of the language, 0 if it has none."""
    numbered = ranked(counts.groups, ["lang"], ["source"], "place", "sources")
    numbered = numbered.select("lang", "source", "total", "kept", F.floor(F.col("place") / tile).alias("tile"), F.ceil(F.col("sources") / tile).alias("tiles"))
    numbered = written(numbered, "terms")
    # Every group takes part in every block of its language, also where it has no term.
    last = F.greatest(F.ceil(F.col("kept") / BLOCK), F.lit(1)) - 1
    empty = numbered.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    empty = empty.withColumns({"number": F.col("block") * BLOCK, "n": F.lit(0).cast("long")})
    held = counts.cells.select("lang", "source", "number", "n").join(numbered, ["lang", "source"])
    held = held.withColumn("block", F.floor(F.col("number") / BLOCK))
    rows = held.unionByName(empty)
    # Tile t is the first side of (t, u) for u >= t, and the second side of (s, t) for s < t; (t, t) has one side.
    first = F.transform(F.sequence(F.col("tile"), F.col("tiles") - 1), lambda u: F.struct(F.col("tile").alias("s"), u.alias("u"), F.lit(0).alias("side")))
    before = F.when(F.col("tile") > 0, F.sequence(F.lit(0).cast("long"), F.col("tile") - 1)).otherwise(F.array().cast("array<bigint>"))
    second = F.transform(before, lambda s: F.struct(s.alias("s"), F.col("tile").alias("u"), F.lit(1).alias("side")))
    dealt = rows.select("lang", "source", "block", "number", "n", "total", "kept", F.inline(F.concat(first, second)))
    sums = dealt.groupBy("lang", "block", "s", "u").applyInArrow(_tile_sums, "lang string, a string, b string, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def term_divergence(counts: Counts, ranks: int = TERM_RANKS) -> DataFrame:
    """lang, source, term, value and rank: the terms that a group uses more than its language, by f, the first ``ranks``."""
    cells = counts.cells.join(counts.groups, ["lang", "source"]).withColumns(
        {"p": _share_column("n", "total"), "q": _share_column("lang_n", "lang_total")}
    )
    valued = cells.filter("p > q").select("lang", "source", "term", F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    return valued.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= ranks)


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, source, part, item, value, rank of each group.

    Part ``pair``: all other sources of the language, the most different first. Part ``term``: the group's ten most
    distinctive terms. Ties go by the item's UTF-8 bytes. NULL text, language and source are empty texts; a group whose texts
    have no term is compared all the same, and a language without kept terms gives pairs of value 0. Rows that repeat count
    each; ids are not read. Texts of any length are counted where they are read. An empty table gives no rows.
    """
    counts = count_terms(docs, text, lang, source, least_docs)
    pairs = pair_divergence(counts)
    both = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    pairs = pairs.select("lang", "value", F.inline(both))
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by).alias("rank"))
    found = term_divergence(counts).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(found)
