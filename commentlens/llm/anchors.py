"""Places that equal strings agree on, and which of them occur twice.

All windows of ``span`` items of a sequence are looked at. Each is represented by its *anchor*: of the
k-grams in it the one with the smallest hash, the leftmost of several. Equal windows have the same anchor
at the same offset, so two windows can only be equal if their anchors are; and an anchor that occurs once in
the corpus proves that none of its windows is repeated. One anchor stands for a run of windows, about half as
many as a window has k-grams.

The anchors of a block of documents are counted in the task that reads it: those that occur twice there are
known to be shared, and one entry per anchor and block is enough for the rest of the corpus. These entries are
sorted by anchor across the cluster, where neighbours tell. So an anchor that a third of all documents hold sends one
row per block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentlens.llm.common import byte_texts, text_slices
from commentlens.session import written

BLOCK = 1_000_000  # anchors of a block
ODD = np.uint64(0x9E3779B97F4A7C15)
_POSITION = 31  # bits of a key that hold the place
ENTRY = "anchor long, ord long, place long"
ALONE, SHARED, TOLD = range(3)  # kinds of entries
OFFSETS = 1 << 12  # a window reaches less than this before its anchor


def check_offsets(span: int, gram: int) -> None:
    """Refuse windows whose offsets from their anchor do not fit the byte that the operators pack them into."""
    if span - gram > 255:
        raise ValueError("span and gram may differ by at most 255")


def in_order(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``ord``, ``key`` and ``text`` of each row; ``ord`` is unique and ascends with the key.

    Where whole-number keys are unique they are the order themselves. Otherwise rows with the same key
    follow each other by the hash of their text, NULL keys come last, and the order is written once.
    """
    slim = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    if isinstance(docs.schema[key].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        several = slim.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR key IS NULL")
        if several.isEmpty():
            return slim.select(F.col("key").cast("long").alias("ord"), "key", "text")
    ordered = slim.orderBy(F.col("key").asc_nulls_last(), F.xxhash64("text"))
    return written(ordered.select(F.monotonically_increasing_id().alias("ord"), "key", "text"), "order")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads each bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``size`` powers of an odd number modulo 2^64, and of its inverse."""
    if len(_POWERS[0]) < size:
        for i, base in enumerate((int(ODD), pow(int(ODD), -1, 2**64))):
            _POWERS[i] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(2 * size, base, np.uint64)]))
    return _POWERS[0][:size], _POWERS[1][:size]


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` values (uint64), by doubling; the last ``k - 1`` places are left out."""
    done, out, power, factor = 0, None, values, ODD
    length, rest = 1, k
    while rest:
        if rest & 1:
            out = power if out is None else out[: len(power) - done] * factor + power[done:]
            done += length
            out = out[: len(values) - done + 1]
        rest >>= 1
        if rest:
            power = power[: len(power) - length] * factor + power[length:]
            factor = np.uint64(int(factor) ** 2 % 2**64)
            length *= 2
    return mix64(out)


def anchors(hashes: np.ndarray, counts: np.ndarray, k: int, span: int) -> tuple[np.ndarray, ...]:
    """Place, document, and lowest and highest offset of a window's start before it, of all anchors.

    ``hashes``: of the k-grams of all documents, one after the other; ``counts``: their numbers of items.
    """
    wide = span - k + 1
    ends = np.cumsum(counts)
    begins = ends - counts
    many = np.maximum(counts - span + 1, 0)
    if not many.sum():
        none = np.zeros(0, np.int64)
        return none, none, none, none
    padded = np.full(-(-len(hashes) // wide) * wide + wide, np.iinfo(np.uint64).max)
    place = np.uint64((1 << _POSITION) - 1)
    padded[: len(hashes)] = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
    cells = padded.reshape(-1, wide)
    before = np.minimum.accumulate(cells, axis=1).reshape(-1)
    after = np.minimum.accumulate(cells[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(after[: len(hashes)], before[wide - 1 : wide - 1 + len(hashes)])
    doc = np.repeat(np.arange(len(counts)), many)
    start = np.arange(len(doc)) + np.repeat(begins - (np.cumsum(many) - many), many)
    at = (least[start] & place).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return at[first], doc[first], at[first] - start[last], at[first] - start[first]


Sequencer = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


def _entries(
    batches: Iterable[pa.RecordBatch], sequence: Sequencer, k: int, span: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []

    def block() -> pa.RecordBatch:
        anchor, ord_, p, low, high = (np.concatenate(c) for c in zip(*held))
        held.clear()
        order = np.argsort(anchor, kind="stable")
        same = anchor[order][1:] == anchor[order][:-1]
        known = np.zeros(len(order), bool)
        known[1:] |= same
        known[:-1] |= same
        lead = known.copy()
        lead[1:] &= ~same
        # Entries known to be shared need no neighbour; one per anchor tells the others.
        shared = np.empty(len(order), bool)
        shared[order] = known
        told = anchor[order][lead]
        alias = np.where(shared, mix64(ord_.view(np.uint64) * ODD + p.astype(np.uint64)), anchor)
        columns = (
            np.concatenate([alias, told]).view(np.int64),
            np.concatenate([ord_, np.zeros(len(told), np.int64)]),
            np.concatenate([packed(p, low, high, np.where(shared, SHARED, ALONE)), np.full(len(told), TOLD)]),
        )
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    size = 0
    for batch in text_slices(batches, 1, most=500_000):
        values, counts = sequence(byte_texts(batch, 1))
        if len(values) < span:
            continue
        hashes = gram_hashes(values, k)
        at, doc, low, high = anchors(hashes, counts, k, span)
        begins = np.cumsum(counts) - counts
        ords = batch.column(0).to_numpy(zero_copy_only=False)
        held.append((hashes[at], ords[doc], at - begins[doc], low, high))
        size += len(at)
        if size >= BLOCK:
            yield block()
            size = 0
    if size:
        yield block()


def packed(p: np.ndarray, low: np.ndarray, high: np.ndarray, kind: np.ndarray | int) -> np.ndarray:
    """Place, offsets and kind as one number."""
    return (p.astype(np.int64) << 26) | (low.astype(np.int64) << 14) | (high.astype(np.int64) << 2) | kind


def unpacked(place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Place, lowest and highest offset."""
    return place >> 26, (place >> 14) & (OFFSETS - 1), (place >> 2) & (OFFSETS - 1)


def _repeated(batches: Iterable[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Entries, sorted by anchor, that are shared or have a neighbour with the same anchor."""

    def kept(anchor: np.ndarray, ord_: np.ndarray, place: np.ndarray, left: int | None, most: int) -> pa.RecordBatch:
        same = anchor[1:] == anchor[:-1]
        keep = (place & 3) == SHARED
        keep[1:] |= same
        keep[:-1] |= same
        if left is not None:
            keep[0] |= anchor[0] == left
        keep &= (place & 3) != TOLD
        keep[most:] = False
        return pa.RecordBatch.from_arrays([pa.array(ord_[keep]), pa.array(place[keep])], schema=schema)

    held: tuple[np.ndarray, ...] | None = None  # the last entry so far, whose right neighbour is not known yet
    left = None  # the anchor before it
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = tuple(c.to_numpy() for c in batch.columns)
        if held is not None:
            columns = tuple(np.concatenate(x) for x in zip(held, columns))
        most = len(columns[0]) - 1
        if most:
            yield kept(*columns, left, most)
            left = int(columns[0][-2])
        held = tuple(c[most:] for c in columns)
    if held is not None:
        yield kept(*held, left, 1)


def shared_anchors(ordered: DataFrame, sequence: Sequencer, k: int, span: int) -> DataFrame:
    """For each document with shared anchors: ord and ``places``, a list of packed (p, low, high), written.

    A window that starts ``o`` items before place ``p`` of its document, ``low <= o <= high``, has its anchor there.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    if span - k >= OFFSETS:
        raise ValueError(f"span and k-gram may differ by less than {OFFSETS}")
    arrow = to_arrow_schema(T.StructType.fromDDL(ENTRY))
    found = ordered.select("ord", "text").mapInArrow(lambda b: _entries(b, sequence, k, span, arrow), ENTRY)
    dealt = found.repartition("anchor").sortWithinPartitions("anchor")
    slim = to_arrow_schema(T.StructType.fromDDL("ord long, place long"))
    repeated = dealt.mapInArrow(lambda b: _repeated(b, slim), "ord long, place long")
    return written(repeated.groupBy("ord").agg(F.collect_list("place").alias("places")), "anchors")


def places_of(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Row, place, lowest and highest offset of each entry of a list column of packed places."""
    sizes = column.value_lengths().fill_null(0).to_numpy()
    return np.repeat(np.arange(len(sizes)), sizes), *unpacked(column.flatten().to_numpy())


def place_arrays(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Row of each entry of a list column of structs, and the structs' fields."""
    sizes = column.value_lengths().fill_null(0).to_numpy()
    fields = column.flatten()
    return np.repeat(np.arange(len(sizes)), sizes), *(f.to_numpy(zero_copy_only=False) for f in fields.flatten())


MATCH = "h1 long, h2 long, ord long, start int, n int, ref_ord long, ref_start int, known boolean"
RUN = "ord long, start int, n int, ref_ord long, ref_start int"


def _first_seen(batches: Iterable[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Known matches, and all windows but the first of those with the same hash; sorted by hash and place."""
    last = None  # hash and place of the first window with the hash met last
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, ord_, start, n, ref_ord, ref_start, known = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        if last is not None and h1[0] == last[0] and h2[0] == last[1]:
            new[0] = False
        first = np.maximum.accumulate(np.where(new, np.arange(len(h1)), -1))
        to_ord = np.where(first >= 0, ord_[first], 0 if last is None else last[2])
        to_start = np.where(first >= 0, start[first], 0 if last is None else last[3])
        out = known | ~new
        at = [np.where(known, a, b)[out] for a, b in ((ref_ord, to_ord), (ref_start, to_start))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, f.type) for x, f in zip([ord_[out], start[out], n[out], *at], schema)], schema=schema
        )
        last = (h1[-1], h2[-1], to_ord[-1], to_start[-1])


def later_windows(found: DataFrame) -> DataFrame:
    """For each document: ord and ``matches``, a list of (start, n, ref_ord, ref_start) of windows seen earlier.

    ``found`` (``MATCH``) holds windows by a hash of 128 bits, which are sorted and compared with their neighbour,
    and matches known already, whose hash is any number that spreads them.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(T.StructType.fromDDL(RUN))
    dealt = found.repartition("h1").sortWithinPartitions("h1", "h2", "ord", "start")
    runs = dealt.mapInArrow(lambda b: _first_seen(b, schema), RUN)
    return runs.groupBy("ord").agg(F.collect_list(F.struct("start", "n", "ref_ord", "ref_start")).alias("matches"))


def spread(ord_: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Numbers that spread known matches over the partitions."""
    return mix64(ord_.astype(np.int64).view(np.uint64) * ODD + start.astype(np.uint64)).view(np.int64)


def with_lists(ordered: DataFrame, lists: DataFrame) -> DataFrame:
    """ord, key, text and the list of each document, NULL if it has none.

    An operator joins twice, for its lookups and for its result. As both read the same columns, Spark shuffles
    the texts once and uses them again.
    """
    return ordered.join(lists, "ord", "left")


def covered(starts: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` items lie in any of the ranges."""
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0
