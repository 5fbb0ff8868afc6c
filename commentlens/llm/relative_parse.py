"""Substring dedup by relative Lempel-Ziv parsing.

The reference of a document is all text that starts earlier: in documents with a smaller key, or before in the
document itself. The reference lies in blocks. Each block of documents is indexed in the task that reads it, by its
*phrases*: the windows of ``span`` words that share an anchor (see ``anchors``) lie next to each other and make one
phrase, so phrases cover every window once. A phrase that repeats inside its block is matched there; of each
different one a block hands one entry to the index of the whole corpus, which is dealt by anchor over the shuffle
partitions. There every block's entries meet. A phrase seen earlier is matched whole. An anchor with a
single phrase settles that all its windows start there; only where an anchor has several phrases, as at
the ends of a repeated passage, are their windows looked up one by one in a second index.

Back at the document, the parse is greedy: from the first window that the reference holds, a factor (start,
length, place in the reference) goes on as long as document and reference go on alike. Windows that cross the
end of a factor were looked up like all others, so what a factor missed there starts the next one. All words
of the factors are removed; a factor has ``span`` words at least.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentlens.llm import anchors
from commentlens.llm.common import byte_texts, ranges, text_slices
from commentlens.session import written

SPAN = 20
GRAM = 8
BLOCK = 1_000_000  # windows, or phrases, of a reference block
ALONE, SEVERAL, TOLD, SETTLED = range(4)  # kinds of entries
ENTRY = "key long, phrase long, ord long, place long, ref_ord long, ref_start int"
FOUND = "ord long, start int, n int, ref_ord long, ref_start int, settled boolean"


def word_values(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of all texts, and the number of words of each."""
    split = [t.split() for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    words = [w for s in split for w in s]
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)), counts


def _packed(p: np.ndarray, low: np.ndarray, high: np.ndarray, kind: np.ndarray | int) -> np.ndarray:
    return (p.astype(np.int64) << 18) | (low.astype(np.int64) << 10) | (high.astype(np.int64) << 2) | kind


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, ...]:
    return place >> 18, (place >> 10) & 255, (place >> 2) & 255, place & 3


def _joined_runs(ord_: np.ndarray, start: np.ndarray, n: np.ndarray, to_ord: np.ndarray, to_start: np.ndarray) -> tuple[np.ndarray, ...]:
    """Matches of neighbouring windows along one diagonal as one match."""
    order = np.lexsort((start, ord_))
    ord_, start, n, to_ord, to_start = (x[order] for x in (ord_, start, n, to_ord, to_start))
    begin = np.ones(len(order), bool)
    begin[1:] = (
        (ord_[1:] != ord_[:-1])
        | (start[1:] != start[:-1] + n[:-1])
        | (to_ord[1:] != to_ord[:-1])
        | (to_start[1:] != to_start[:-1] + n[:-1])
    )
    first = np.flatnonzero(begin)
    total = np.add.reduceat(n, first) if len(first) else n
    return ord_[first], start[first], total, to_ord[first], to_start[first]


def _batch(schema: pa.Schema, columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _index_of(held: list[tuple[np.ndarray, ...]], schema: pa.Schema) -> pa.RecordBatch:
    """One block's entries for the index, and the matches inside the block.

    The phrases of an anchor that has several here are spread by phrase; one entry per such anchor tells
    the phrases of other blocks that it has.
    """
    anchor, phrase, ord_, p, low, high = (np.concatenate(c) for c in zip(*held))
    held.clear()
    order = np.lexsort((p, ord_, phrase, anchor))
    anchor, phrase, ord_, p, low, high = (x[order] for x in (anchor, phrase, ord_, p, low, high))
    place = np.arange(len(order))
    new_anchor, new = np.ones(len(order), bool), np.ones(len(order), bool)
    new_anchor[1:] = anchor[1:] != anchor[:-1]
    new[1:] = new_anchor[1:] | (phrase[1:] != phrase[:-1])
    first = np.maximum.accumulate(np.where(new, place, 0))[~new]
    later = np.flatnonzero(~new)
    runs = _joined_runs(ord_[later], (p - high)[later], (high - low + 1)[later], ord_[first], (p - high)[first])

    group = np.cumsum(new_anchor) - 1
    several = (np.bincount(group, weights=new) > 1)[group]
    lone, many = np.flatnonzero(new & ~several), np.flatnonzero(new & several)
    told = np.flatnonzero(new_anchor & several)
    zero = np.zeros(len(runs[0]), np.int64)
    parts = [
        (anchor[lone].view(np.int64), phrase[lone], ord_[lone], _packed(p[lone], low[lone], high[lone], ALONE)),
        (anchors.mix64(anchor[many] + phrase[many].view(np.uint64) * anchors.ODD).view(np.int64), phrase[many], ord_[many],
         _packed(p[many], low[many], high[many], SEVERAL)),
        (anchor[told].view(np.int64), phrase[told], np.full(len(told), np.iinfo(np.int64).max), np.full(len(told), TOLD, np.int64)),
        # A settled match: its number of windows stands in the place of the offsets.
        (anchors.spread(runs[0], runs[1]), runs[2], runs[0], (runs[1] << 18) | SETTLED),
    ]
    columns = [np.concatenate(c) for c in zip(*parts)]
    before = np.zeros(len(columns[0]) - len(zero), np.int64)
    return _batch(schema, [*columns, np.concatenate([before, runs[3]]), np.concatenate([before, runs[4]])])


def _phrases(batches: Iterable[pa.RecordBatch], span: int, gram: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in text_slices(batches, 1, most=1_000_000):
        values, counts = word_values(byte_texts(batch, 1))
        if len(values) < span:
            continue
        hashes = anchors.gram_hashes(values, gram)
        at, doc, low, high = anchors.anchors(hashes, counts, gram, span)
        if not len(at):
            continue
        # The hash of all words that a phrase's windows cover, from running sums of powers.
        power = anchors.powers(len(values))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(anchors.mix64(values) * power[0])])
        begin, end = at - high, at - low + span
        phrase = (sums[end] - sums[begin]) * power[1][begin]
        phrase = anchors.mix64(phrase + low.astype(np.uint64) * np.uint64(257) + high.astype(np.uint64)).view(np.int64)
        ords = batch.column(0).to_numpy()
        held.append((hashes[at], phrase, ords[doc], at - (np.cumsum(counts) - counts)[doc], low, high))
        size += len(at)
        if size >= BLOCK:
            yield _index_of(held, schema)
            size = 0
    if held:
        yield _index_of(held, schema)


def _settled(batches: Iterable[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Matches of whole phrases, and phrases whose windows must be looked up.

    Entries come sorted by key, phrase and place. An anchor has one or two entries per block, so the entries of the
    last key of a batch are held until the next.
    """

    def answer(table: pa.RecordBatch) -> pa.RecordBatch:
        key, phrase, ord_, place, ref_ord, ref_start = (c.to_numpy() for c in table.columns)
        p, low, high, kind = _unpacked(place)
        row = np.arange(len(key))
        new_key, new = np.ones(len(key), bool), np.ones(len(key), bool)
        new_key[1:] = key[1:] != key[:-1]
        new[1:] = new_key[1:] | (phrase[1:] != phrase[:-1])
        group = np.cumsum(new_key) - 1
        open_ = (np.bincount(group, weights=new) > 1) | (np.bincount(group, weights=(kind == TOLD) | (kind == SEVERAL)) > 0)
        first = np.maximum.accumulate(np.where(new, row, 0))
        real = (kind == ALONE) | (kind == SEVERAL)
        later, ask, known = np.flatnonzero(real & ~new), np.flatnonzero(real & new & open_[group]), np.flatnonzero(kind == SETTLED)
        first = first[later]
        n = high - low + 1
        parts = [
            (ord_[later], (p - high)[later], n[later], ord_[first], (p - high)[first], np.ones(len(later), bool)),
            (ord_[ask], (p - high)[ask], n[ask], np.zeros(len(ask), np.int64), np.zeros(len(ask), np.int64), np.zeros(len(ask), bool)),
            (ord_[known], p[known], phrase[known], ref_ord[known], ref_start[known].astype(np.int64), np.ones(len(known), bool)),
        ]
        return _batch(schema, [np.concatenate(c) for c in zip(*parts)])

    held: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        key = batch.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1], "left"))
        if cut:
            yield answer(batch.slice(0, cut))
        held = batch.slice(cut)
    if held is not None:
        yield answer(held)


def _block_matches(held: list[tuple[np.ndarray, ...]], schema: pa.Schema) -> pa.RecordBatch:
    """Matches of windows inside the block as runs along a diagonal, and one entry for each different window."""
    h1, h2, ord_, start = (np.concatenate(c) for c in zip(*held))
    held.clear()
    order = np.lexsort((start, ord_, h2, h1))
    h1, h2, ord_, start = h1[order], h2[order], ord_[order], start[order]
    new = np.ones(len(h1), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(h1)), 0))[~new]
    later = np.flatnonzero(~new)
    runs = _joined_runs(ord_[later], start[later], np.ones(len(later), np.int64), ord_[first], start[first])
    zero = np.zeros(int(new.sum()), np.int64)
    known = _known(runs)
    asked = [h1[new].view(np.int64), h2[new].view(np.int64), ord_[new], start[new], zero + 1, zero, zero, zero > 0]
    return _batch(schema, [np.concatenate(c) for c in zip(asked, known)])


def _known(runs: tuple[np.ndarray, ...]) -> list[np.ndarray]:
    size = len(runs[0])
    return [anchors.spread(runs[0], runs[1]), np.zeros(size, np.int64), *runs, np.ones(size, bool)]


def _lookups(batches: Iterable[pa.RecordBatch], span: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in text_slices(batches, 2, most=1_000_000):
        batch = batch.filter(batch.column(3).is_valid())
        if not batch.num_rows:
            continue
        ords = batch.column(0).to_numpy()
        doc, start, many, ref_ord, ref_start, settled = anchors.place_arrays(batch.column(3))
        start, many, ref_start = (x.astype(np.int64) for x in (start, many, ref_start))
        if settled.any():
            known = (x[settled] for x in (ords[doc], start, many, ref_ord, ref_start))
            yield _batch(schema, _known(_joined_runs(*known)))
        if settled.all():
            continue
        values, counts = word_values(byte_texts(batch, 2))
        first = anchors.gram_hashes(values, span)
        second = anchors.gram_hashes(anchors.mix64(values ^ np.uint64(0x5851F42D4C957F2D)), span)
        doc, start, many = doc[~settled], start[~settled], many[~settled]
        start = ranges(start, many)
        doc = np.repeat(doc, many)
        at = (np.cumsum(counts) - counts)[doc] + start
        held.append((first[at], second[at], ords[doc], start))
        size += len(at)
        if size >= BLOCK:
            yield _block_matches(held, schema)
            size = 0
    if held:
        yield _block_matches(held, schema)


def factors(start: np.ndarray, n: np.ndarray, ref_ord: np.ndarray, ref_start: np.ndarray, span: int) -> list[tuple[int, ...]]:
    """(start, length, ref_ord, ref_start): matches of windows joined as long as text and reference go on alike."""
    order = np.argsort(start, kind="stable")
    start, n, ref_ord, ref_start = start[order], n[order], ref_ord[order], ref_start[order]
    begin = np.ones(len(start), bool)
    begin[1:] = (
        (start[1:] != start[:-1] + n[:-1]) | (ref_ord[1:] != ref_ord[:-1]) | (ref_start[1:] != ref_start[:-1] + n[:-1])
    )
    first = np.flatnonzero(begin)
    length = np.add.reduceat(n, first) + span - 1 if len(first) else n
    return list(zip(start[first].tolist(), length.tolist(), ref_ord[first].tolist(), ref_start[first].tolist()))


def _parsed(batches: Iterable[pa.RecordBatch], span: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, 2, most=2_000_000):
        rows = [[], [], [], []]
        lists = batch.column(3)
        doc, *fields = anchors.place_arrays(lists)
        ends = np.cumsum(np.bincount(doc, minlength=batch.num_rows))
        for i, text in enumerate(byte_texts(batch, 2)):
            words = text.split()
            own = slice(ends[i - 1] if i else 0, ends[i])
            found = factors(*(f[own] for f in fields), span)
            if found:
                starts, lengths = (np.array(x) for x in list(zip(*found))[:2])
                gone = anchors.covered(starts, lengths, len(words))
                kept = [w for w, g in zip(words, gone.tolist()) if not g]
            else:
                kept = words
            for column, value in zip(rows, (len(words), len(words) - len(kept), b" ".join(kept), found)):
                column.append(value)
        columns = [batch.column(1)]
        for value, field in zip(rows, list(schema)[1:]):
            if pa.types.is_list(field.type):
                names = [f.name for f in field.type.value_type]
                value = [[dict(zip(names, v)) for v in vs] for vs in value]
            elif pa.types.is_string(field.type):
                value = pa.array(value, pa.binary()).cast(pa.string())
            columns.append(value if isinstance(value, pa.Array) else pa.array(value, field.type))
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """key, n_words, n_removed, kept_text (the words that stay, joined by a space) and the ``factors`` removed.

    A word goes if a window of ``span`` words that covers it starts earlier as well; windows never cross
    documents and are judged on the input. Words lie between ASCII white space and are compared as bytes. A NULL or
    empty text has no words; fewer than ``span`` words are never removed. Rows that share a key are documents
    one after the other, by the hash of their text; NULL keys come last. Only key and text are read. An
    empty table gives an empty result. ``factors`` name the place in the reference by the document's rank
    (``anchors.in_order``), which is its key where whole-number keys are unique.
    """
    anchors.check_offsets(span, gram)
    from pyspark.sql.pandas.types import to_arrow_schema

    ordered = anchors.in_order(docs, key, text)
    entry, found, match = (to_arrow_schema(T.StructType.fromDDL(x)) for x in (ENTRY, FOUND, anchors.MATCH))
    entries = ordered.select("ord", "text").mapInArrow(lambda b: _phrases(b, span, gram, entry), ENTRY)
    dealt = entries.repartition("key").sortWithinPartitions("key", "phrase", "ord", "place")
    phrases = dealt.mapInArrow(lambda b, schema=found: _settled(b, schema), FOUND)
    each = F.struct("start", "n", "ref_ord", "ref_start", "settled")
    places = written(phrases.groupBy("ord").agg(F.collect_list(each).alias("places")), "phrases")
    with_places = anchors.with_lists(ordered, places).select("ord", "key", "text", "places")
    found = with_places.mapInArrow(lambda b: _lookups(b, span, match), anchors.MATCH)
    out = (
        f"key {docs.schema[key].dataType.simpleString()}, n_words long, n_removed long, kept_text string, "
        "factors array<struct<start:long,length:long,ref:long,ref_start:long>>"
    )
    arrow = to_arrow_schema(T.StructType.fromDDL(out))
    matched = anchors.with_lists(ordered, anchors.later_windows(found)).select("ord", "key", "text", "matches")
    return matched.mapInArrow(lambda b: _parsed(b, span, arrow), out)
