"""Substring dedup by a distributed merge sort of suffixes that never compares a known prefix twice.

The suffixes sorted are those that begin at a shared anchor (see ``anchors``); every repeated string of
``span`` bytes holds one, at the same offset in all its places. A suffix is cut at ``span`` bytes and followed by
the bytes before the anchor, backwards, so one record has all that the strings around its anchor are made of.

Each block of documents sorts its records and cuts them at sampled splitters into runs, one for each range.
A run is exchanged front-coded: per record the length of the prefix it shares with the one before, and the rest.
Where a range's runs meet, a loser tree merges them. Each run's head knows the prefix it shares with the record that
left the tree last; of two heads the one that shares more is smaller, and only when both share the same are
bytes compared, from there on. The merged order comes with its common prefixes, and these tell which
records agree on the right of the anchor; among those, hashes of the bytes on the left tell which strings are equal.

Equal records of a block travel once. Splitters lie between different k-grams, so the strings of an anchor meet
in one task; a group over ``GROUP`` records, which no task should hold, hands its strings on to a second
exchange, by string.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentlens.llm import anchors
from commentlens.llm.common import byte_texts, ranges, shuffle_partitions, text_slices

SPAN = 100
GRAM = 40
BLOCK = 150_000  # records sorted at a time
CHUNK = 30_000  # merged records looked at together, if no group is larger
GROUP = 300_000
SAMPLE_PER_RANGE = 40
SAMPLE = 100_000  # k-grams the splitters are taken from, at most
EXCHANGE = "range int, run binary, ord long, start int, n int"

_BYTE = anchors.mix64(np.arange(1, 257, dtype=np.uint64) * anchors.ODD)


def byte_values(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return _BYTE[np.frombuffer(b"".join(texts), np.uint8)], np.fromiter(map(len, texts), np.int64, len(texts))


def records(
    texts: list[bytes], doc: np.ndarray, p: np.ndarray, low: np.ndarray, high: np.ndarray, span: int, gram: int
) -> np.ndarray:
    """One row per place: the bytes from it on, then those before it, backwards, as far as its windows reach; else 0.

    Two records are only compared where windows of both reach, so the zeros are never taken for text.
    """
    octets = np.frombuffer(b"".join([*texts, b"\0"]), np.uint8)
    counts = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(counts) - counts
    reach = np.concatenate([np.arange(span), -1 - np.arange(span - gram)])
    out = np.empty((len(p), len(reach)), np.uint8)
    for a in range(0, len(p), 20_000):
        rows = slice(a, a + 20_000)
        local = p[rows, None].astype(np.int64) + reach
        inside = np.where(reach >= 0, reach < span - low[rows, None], -reach <= high[rows, None])
        out[rows] = octets[np.where(inside, local + begins[doc[rows], None], len(octets) - 1)]
        out[rows][~inside] = 0
    return out


def prefixes(rows: np.ndarray) -> np.ndarray:
    """Bytes that each row shares with the one before; 0 for the first."""
    shared = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        shared[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return shared


def encode_run(rows: np.ndarray, shared: np.ndarray, ord_: np.ndarray, p: np.ndarray, low: np.ndarray, high: np.ndarray) -> bytes:
    """A sorted run, front-coded."""
    shared = shared.copy()
    shared[:1] = 0
    rest = rows[np.arange(rows.shape[1]) >= shared[:, None]]
    parts = [np.array([len(rows)], "<i8"), ord_.astype("<i8"), p.astype("<i4"), shared.astype("<u2"), low.astype("u1"), high.astype("u1"), rest]
    return zlib.compress(b"".join(x.tobytes() for x in parts), 1)


class Run:
    """A front-coded run that is read record by record."""

    def __init__(self, coded: bytes, width: int):
        coded = zlib.decompress(coded)
        n = int(np.frombuffer(coded, "<i8", 1)[0])
        at = 8
        fields = []
        for kind, size in (("<i8", 8), ("<i4", 4), ("<u2", 2), ("u1", 1), ("u1", 1)):
            fields.append(np.frombuffer(coded, kind, n, at))
            at += size * n
        self.ord, self.p, shared, self.low, self.high = fields
        self.shared = shared.tolist()
        self.coded, self.at, self.width, self.n, self.next = coded, at, width, n, 0
        self.record = b""

    def advance(self) -> int:
        """Moves to the next record and tells its shared prefix, -1 at the end."""
        if self.next == self.n:
            return -1
        shared = self.shared[self.next]
        end = self.at + self.width - shared
        self.record = self.record[:shared] + self.coded[self.at : end]
        self.at = end
        self.next += 1
        return shared


def merge(runs: list[Run], width: int) -> Iterator[tuple[bytes, int, int, int]]:
    """(record, bytes shared with the record before, run, index in the run) in sorted order."""
    heads = [run.advance() for run in runs]  # bytes that each run's head shares with the last winner
    count = len(runs)

    def beaten(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser then knows what it shares with the winner."""
        x, y = heads[a], heads[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        one, two = runs[a].record, runs[b].record
        if one == two:
            heads[b] = width
            return a, b
        differ = int.from_bytes(one[x:], "big") ^ int.from_bytes(two[x:], "big")
        shared = width - (differ.bit_length() + 7) // 8
        if one < two:
            heads[b] = shared
            return a, b
        heads[a] = shared
        return b, a

    losers = [0] * count
    winners = [0] * count + list(range(count))
    for node in range(count - 1, 0, -1):
        winners[node], losers[node] = beaten(winners[2 * node], winners[2 * node + 1])
    best = winners[1]
    while heads[best] >= 0:
        run = runs[best]
        yield run.record, heads[best], best, run.next - 1
        heads[best] = run.advance()
        node = (best + count) >> 1
        while node:
            best, losers[node] = beaten(best, losers[node])
            node >>= 1


def later_strings(
    rows: np.ndarray, shared: np.ndarray, ord_: np.ndarray, p: np.ndarray, low: np.ndarray, high: np.ndarray, span: int
) -> np.ndarray:
    """[record, offset] is True where the string of ``span`` bytes that starts ``offset`` before the anchor starts
    earlier as well. The records are sorted, with common prefixes, and hold whole groups of an anchor."""
    n, wide = len(rows), rows.shape[1] - span + 1
    found = np.zeros((n, wide), bool)
    place = np.arange(n)
    left = np.zeros(n, np.uint64)
    for o in range(wide):
        if o:
            left = (left ^ _BYTE[rows[:, span + o - 1]]) * anchors.ODD
            left ^= left >> np.uint64(29)
        has = np.flatnonzero((low <= o) & (o <= high))
        if len(has) < 2:
            continue
        # Records from one whose prefix is too short to the next such agree on the right of the anchor.
        right = np.maximum.accumulate(np.where(shared < span - o, place, 0))[has]
        mark = anchors.mix64(left[has] + right.astype(np.uint64) * anchors.ODD)
        order = np.argsort(mark, kind="stable")
        same = mark[order][1:] == mark[order][:-1]
        if not same.any():
            continue
        some = np.zeros(len(order), bool)
        some[1:] |= same
        some[:-1] |= same
        order = order[some]
        order = order[np.lexsort((p[has[order]], ord_[has[order]], mark[order]))]
        found[has[order[1:][mark[order][1:] == mark[order][:-1]]], o] = True
    return found


def _joined(ord_: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of window starts that touch, as one."""
    order = np.lexsort((start, ord_))
    ord_, start, n = ord_[order], start[order], n[order]
    begin = np.ones(len(order), bool)
    begin[1:] = (ord_[1:] != ord_[:-1]) | (start[1:] != start[:-1] + n[:-1])
    first = np.flatnonzero(begin)
    return ord_[first], start[first], np.add.reduceat(n, first)


def _exchange(schema: pa.Schema, **columns: np.ndarray | list) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema
    )


def _sorted_block(
    held: list[tuple[np.ndarray, ...]], splitters: list[bytes], schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    rows, ord_, p, low, high = (np.concatenate(c) for c in zip(*held))
    held.clear()
    width = rows.shape[1]
    whole = rows.tobytes()
    texts = [whole[i : i + width] for i in range(0, len(whole), width)]
    del whole
    order = np.array(sorted(range(len(texts)), key=texts.__getitem__), np.int64)
    rows, ord_, p, low, high = rows[order], ord_[order], p[order], low[order], high[order]
    shared = prefixes(rows)
    alike = np.cumsum((shared < width))
    order = np.lexsort((p, ord_, high, low, alike))
    first = np.ones(len(order), bool)
    for x in (alike, low, high):
        first[1:] &= x[order][1:] == x[order][:-1]
    first[1:] = ~first[1:]
    later = order[~first]
    if len(later):
        known, start, n = _joined(ord_[later], p[later] - high[later], high[later] - low[later] + 1)
        yield _exchange(schema, range=anchors.spread(known, start) % (len(splitters) + 1), ord=known, start=start, n=n)
    stay = np.sort(order[first])
    rows, ord_, p, low, high = rows[stay], ord_[stay], p[stay], low[stay], high[stay]
    shared = prefixes(rows)
    texts = [rows[i].tobytes() for i in range(len(rows))]
    edges = [0, *(bisect_left(texts, s) for s in splitters), len(texts)]
    for place, (a, b) in enumerate(zip(edges, edges[1:])):
        if b > a:
            run = encode_run(rows[a:b], shared[a:b], ord_[a:b], p[a:b], low[a:b], high[a:b])
            yield _exchange(schema, range=[place], run=[run])


def _sorted_runs(
    batches: Iterable[pa.RecordBatch], span: int, gram: int, splitters: list[bytes], schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in text_slices(batches, 2, most=1_000_000):
        batch = batch.filter(batch.column(3).is_valid())
        if not batch.num_rows:
            continue
        texts = byte_texts(batch, 2)
        ords = batch.column(0).to_numpy()
        doc, p, low, high = anchors.places_of(batch.column(3))
        for a in range(0, len(p), BLOCK):
            cut = slice(a, a + BLOCK)
            held.append((records(texts, doc[cut], p[cut], low[cut], high[cut], span, gram), ords[doc[cut]], p[cut].astype(np.int64), low[cut], high[cut]))
            size += len(held[-1][1])
            if size >= BLOCK:
                yield from _sorted_block(held, splitters, schema)
                size = 0
    if held:
        yield from _sorted_block(held, splitters, schema)


def _intervals(found: np.ndarray, ord_: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, ...]:
    """ord, first window start and number of windows of each run of True in a row."""
    edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    return ord_[row], p[row] - (end - 1), end - first


def _match(schema: pa.Schema, h1, h2, ord_, start, n, known: bool) -> pa.RecordBatch:
    size = len(ord_)
    nothing = np.zeros(size, np.int64)
    columns = [h1, h2, ord_, start, n, nothing, nothing, np.full(size, known)]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _merged(batches: Iterable[pa.RecordBatch], span: int, gram: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    width = 2 * span - gram
    runs: list[Run] = []
    for batch in batches:
        lone = batch.filter(batch.column(1).is_null())
        if lone.num_rows:
            ord_, start, n = (lone.column(i).to_numpy() for i in (2, 3, 4))
            yield _match(schema, anchors.spread(ord_, start), np.zeros(len(n), np.int64), ord_, start, n, True)
        runs += [Run(x, width) for x in batch.column(1).to_pylist() if x is not None]
    if not runs:
        return
    chunk: list[tuple[bytes, int, int, int]] = []
    begin = 0  # of the group that is not complete
    crowded = False  # the group's first records have left already, as strings

    def columns(part: list) -> tuple[np.ndarray, ...]:
        texts, shared, run, index = zip(*part)
        rows = np.frombuffer(b"".join(texts), np.uint8).reshape(-1, width)
        run, index = np.array(run), np.array(index)
        fields = [np.empty(len(run), np.int64) for _ in range(4)]
        for r in np.unique(run):
            own = run == r
            for field, source in zip(fields, (runs[r].ord, runs[r].p, runs[r].low, runs[r].high)):
                field[own] = source[index[own]]
        return rows, np.array(shared), *fields

    def resolved(part: list) -> pa.RecordBatch:
        rows, shared, ord_, p, low, high = columns(part)
        found = later_strings(rows, shared, ord_, p, low, high, span)
        ord_, start, n = _intervals(found, ord_, p)
        if len(n):
            ord_, start, n = _joined(ord_, start, n)
        return _match(schema, anchors.spread(ord_, start), np.zeros(len(n), np.int64), ord_, start, n, True)

    def as_strings(part: list) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(part), 10_000):
            rows, _, ord_, p, low, high = columns(part[a : a + 10_000])
            line = np.concatenate([rows[:, span:][:, ::-1], rows[:, :span]], axis=1)
            many = high - low + 1
            who = np.repeat(np.arange(len(p)), many)
            before = ranges(low, many)
            values = _BYTE[line]
            second = anchors.mix64(values ^ np.uint64(0x5851F42D4C957F2D))
            at = who * width + (span - gram) - before
            hashes = [anchors.gram_hashes(v.reshape(-1), span)[at].view(np.int64) for v in (values, second)]
            yield _match(schema, *hashes, ord_[who], p[who] - before, np.ones(len(who), np.int64), False)

    for item in merge(runs, width):
        if item[1] < gram:
            if crowded:
                yield from as_strings(chunk)
                chunk, crowded = [], False
            elif len(chunk) >= CHUNK:
                yield resolved(chunk)
                chunk = []
            begin = len(chunk)
        chunk.append(item)
        if len(chunk) - begin >= GROUP:
            if begin:
                yield resolved(chunk[:begin])
            yield from as_strings(chunk[begin:])
            chunk, begin, crowded = [], 0, True
    if crowded:
        yield from as_strings(chunk)
    elif chunk:
        yield resolved(chunk)


def _splitters(ordered: DataFrame, places: DataFrame, gram: int, count: int) -> list[bytes]:
    """At most ``count - 1`` k-grams that cut the shared anchors' order evenly, from a sample of them."""
    size = places.agg(F.sum(F.size("places"))).first()[0] or 0
    want = min(SAMPLE_PER_RANGE * count, SAMPLE)
    if not size or count < 2:
        return []
    cells = 1 << 40
    chosen = int(min(1.0, want / size) * cells)
    picked = F.filter("places", lambda x: F.pmod(F.xxhash64("ord", x), F.lit(cells)) < chosen)
    some = places.select("ord", picked.alias("places")).filter(F.size("places") > 0)

    def grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 0):
            texts = byte_texts(batch, 0)
            doc, p, *_ = anchors.places_of(batch.column(1))
            found = [texts[d][i : i + gram] for d, i in zip(doc.tolist(), p.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["gram"])

    sampled = ordered.select("ord", "text").join(some, "ord").select("text", "places").mapInArrow(grams, "gram binary")
    found = sorted(bytes(r["gram"]) for r in sampled.collect())
    return sorted({found[i * len(found) // count] for i in range(1, count)}) if found else []


def _cut(batches: Iterable[pa.RecordBatch], span: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, 2, most=4_000_000):
        texts = byte_texts(batch, 2)
        doc, start, n, *_ = anchors.place_arrays(batch.column(3))
        ends = np.cumsum(np.bincount(doc, minlength=len(texts)))
        sizes, removed, kept, spans = [], [], [], []
        for i, text in enumerate(texts):
            own = slice(ends[i - 1] if i else 0, ends[i])
            sizes.append(len(text))
            if own.start == own.stop:
                removed.append(0)
                kept.append(text)
                spans.append([])
                continue
            gone = anchors.covered(start[own], n[own] + span - 1, len(text))
            kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
            removed.append(len(text) - len(kept[-1]))
            edge = np.diff(np.concatenate([[0], gone, [0]]).astype(np.int8))
            first, last = np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()
            spans.append([{"start": a, "length": b - a} for a, b in zip(first, last)])
        values = [sizes, removed, kept, spans]
        columns = [batch.column(1), *(pa.array(v, f.type) for v, f in zip(values, list(schema)[1:]))]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """key, n_bytes, n_removed, ``kept`` (the bytes that stay) and ``spans`` (start and length of each removed run).

    A byte goes if a string of ``span`` bytes that covers it starts earlier as well: in a document with a smaller
    key, or before in the same. Strings never cross documents, may overlap, and are judged on the input. A NULL text is
    empty; texts under ``span`` bytes keep all. Rows that share a key are documents one after the other, by the
    hash of their text; NULL keys come last. Only key and text are read. An empty table gives an empty result.
    """
    anchors.check_offsets(span, gram)
    from pyspark.sql.pandas.types import to_arrow_schema

    ordered = anchors.in_order(docs, key, text)
    places = anchors.shared_anchors(ordered, byte_values, gram, span)
    splitters = _splitters(ordered, places, gram, shuffle_partitions(docs))
    exchange, match = (to_arrow_schema(T.StructType.fromDDL(x)) for x in (EXCHANGE, anchors.MATCH))
    with_places = anchors.with_lists(ordered, places).select("ord", "key", "text", "places")
    runs = with_places.mapInArrow(lambda b: _sorted_runs(b, span, gram, splitters, exchange), EXCHANGE)
    dealt = runs.repartitionById(len(splitters) + 1, F.col("range"))
    found = dealt.mapInArrow(lambda b: _merged(b, span, gram, match), anchors.MATCH)
    out = (
        f"key {docs.schema[key].dataType.simpleString()}, n_bytes long, n_removed long, kept binary, "
        "spans array<struct<start:long,length:long>>"
    )
    arrow = to_arrow_schema(T.StructType.fromDDL(out))
    matched = anchors.with_lists(ordered, anchors.later_windows(found)).select("ord", "key", "text", "matches")
    return matched.mapInArrow(lambda b: _cut(b, span, arrow), out)
