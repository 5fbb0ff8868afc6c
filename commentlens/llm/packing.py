"""Bounded-space online packing of token sequences.

Each partition reads its documents once and keeps a fixed number of windows open. A document is cut into
full windows as long as it is longer than one; what is left goes to the open window it fits best. When none
fits and no further window may be opened, the fullest is emitted, topped off with the head of the document if its
gap is worth a cut. What is still open at the end of the partitions is merged in rounds of bounded size.

Only the first round sees tokens. Its pieces are written to the shared folder; the merge moves pieces whole
and so needs their lengths alone.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentlens.llm.common import byte_texts, ranges, text_slices, worker_store
from commentlens.session import written

WINDOW = 2048
OPEN_WINDOWS = 32
LEAST_CUT = 32  # a gap below this many tokens is padded, not filled with a piece of a document
SLICE = 1_000_000  # bytes of text that are encoded at once
KNOWN_CHUNKS = 100_000  # chunks whose ids a worker remembers; others are looked up for their slice alone
KNOWN_WORDS = 200_000  # as well, words
AFRESH = 20  # times that many forgotten ones, and it starts afresh: the texts may have changed
# How a word tokenizer cuts a text, and what it appends to the last letter.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
# The same for UTF-8 texts of ASCII and of the letters U+00C0 to U+00FF.
_LETTER = rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])"
_find_words = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|" + _LETTER + rb"+|[0-9]|\n|[\x00-\x09\x0b-/:-`{-\x7f]+").findall
_only_letters = re.compile(_LETTER + rb"+").fullmatch
_plain = re.compile(rb"(?:[\x00-\x7f]|" + _LETTER + rb")*").fullmatch
MERGE = 32  # partitions whose leftovers meet in one task of the next round
PIECE = "doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, closed boolean, part int"

Encoder = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


class _Numbers(dict):
    """Numbers keys as they come; ``new`` lists those that were met for the first time."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, key: bytes) -> int:
        self.new.append(key)
        self[key] = number = len(self)
        return number


class _Ids:
    """Token ids of byte strings, in growing arrays. ``learn`` gives the ids of strings that are new, and their number each.

    Frequent strings come early. So the first ``most`` stay, and what is new beyond them is forgotten after each call.
    """

    def __init__(self, most: int, learn: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]) -> None:
        self.most, self.learn = most, learn
        self.forget()

    def forget(self) -> None:
        self.known = _Numbers()
        self.starts, self.lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ids, self.used, self.lost = np.zeros(4096, np.uint32), 0, 0

    def get(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of each key."""
        if self.lost > AFRESH * self.most:
            self.forget()
        first, used = len(self.known), self.used
        at = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))
        new, self.known.new = self.known.new, []
        if new:
            self._add(first, *self.learn(new))
        lengths = self.lengths[at]
        found = self.ids[ranges(self.starts[at], lengths)]
        kept = max(self.most - first, 0)
        if len(new) > kept:
            for key in new[kept:]:
                del self.known[key]
            self.used = int(self.starts[self.most]) if kept else used
            self.lost += len(new) - kept
        return found, lengths

    def _add(self, first: int, ids: np.ndarray, lengths: np.ndarray) -> None:
        end, most = first + len(lengths), self.used + len(ids)
        while len(self.starts) < end:
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while len(self.ids) < most:
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.lengths[first:end] = lengths
        self.starts[first:end] = self.used + np.cumsum(lengths) - lengths
        self.ids[self.used : most] = ids
        self.used = most


def _totals(lengths: np.ndarray, counts: list[int]) -> np.ndarray:
    """Sums of the first ``counts[0]`` lengths, of the next ``counts[1]``, and so on."""
    return np.diff(np.concatenate([[0], np.cumsum(lengths)])[np.cumsum([0, *counts])])


class ChunkEncoder:
    """Token ids of whole texts, from the ids of their chunks between ASCII white space.

    Holds for tokenizers that drop white space and never join over it. Chunks repeat, so their ids are remembered. Where the
    tokenizer is known to cut texts by ``WORD_PATTERN`` and to mark word ends, chunks of ASCII and Latin-1 letters are put together
    from their words, which repeat more often, and many new words are encoded as one text.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.ends = self._word_ends(json.loads(tokenizer_json))
        self.words = _Ids(KNOWN_WORDS, self._of_words)
        self.chunks = _Ids(KNOWN_CHUNKS, self._whole if self.ends is None else self._of_chunks)

    def _word_ends(self, spec: dict) -> np.ndarray | None:
        """Which ids end a word; None if chunks can only be encoded whole."""
        steps = [spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}]
        names = [[x.get("type") for x in s.get("normalizers") or s.get("pretokenizers") or []] for s in steps]
        split = (steps[1].get("pretokenizers") or [{}])[0]
        vocabulary = spec["model"]["vocab"]
        known = names == [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]] and not spec.get("post_processor")
        if not known or split.get("pattern", {}).get("Regex") != WORD_PATTERN or spec["model"].get("end_of_word_suffix") != WORD_END:
            return None
        self.special = [x["content"].encode() for x in spec.get("added_tokens") or []]
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        return ends

    def _whole(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lists = [e.ids for e in self.tokenizer.encode_batch_fast([k.decode() for k in keys], add_special_tokens=False)]
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter((i for x in lists for i in x), np.uint32, int(lengths.sum())), lengths

    def _of_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lettered = [w.isalpha() or bool(_only_letters(w)) for w in words]
        plain, other = ([w for w, x in zip(words, lettered) if x is want] for want in (True, False))
        found = self._whole(other)
        if plain:
            lines = [b" ".join(plain[i : i + 500]).decode() for i in range(0, len(plain), 500)]
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)])
            lengths = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
            plain_ids = (ids, lengths) if len(lengths) == len(plain) else self._whole(plain)
            found = tuple(np.concatenate(x) for x in zip(plain_ids, found))
        # Back to the order of the words: letters came first.
        ids, lengths = found
        place = np.empty(len(words), np.int64)
        mask = np.array(lettered, bool)
        place[mask], place[~mask] = np.arange(len(plain)), len(plain) + np.arange(len(other))
        starts = (np.cumsum(lengths) - lengths)[place]
        return ids[ranges(starts, lengths[place])], lengths[place]

    def _of_chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Plain chunks are cut into words all at once, one a line; a chunk with other characters or a special token is one word."""
        plain = [c.isascii() or bool(_plain(c)) for c in chunks]
        joined = b"\n".join(chunks)
        if any(s in joined for s in self.special):
            plain = [p and not any(s in c for s in self.special) for p, c in zip(plain, chunks)]
        flat = _find_words(b"\n".join([c if p else b"" for c, p in zip(chunks, plain)]).lower() + b"\n")
        ends = np.flatnonzero(np.fromiter(map(b"\n".__eq__, flat), bool, len(flat)))
        counts = np.diff(ends, prepend=-1) - 1
        for i in np.flatnonzero(counts == 0).tolist():
            flat[ends[i]] = chunks[i]  # in place of the end of its empty line
        kept = np.ones(len(flat), bool)
        kept[ends[counts > 0]] = False
        ids, lengths = self.words.get([w for w, k in zip(flat, kept.tolist()) if k])
        return ids, _totals(lengths, np.maximum(counts, 1).tolist())

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of each text."""
        split = [t.split() for t in texts]
        ids, lengths = self.chunks.get([c for s in split for c in s])
        return ids, _totals(lengths, list(map(len, split)))


class OpenWindows:
    """A fixed number of windows that pieces are placed in; full ones leave through ``emit``."""

    def __init__(self, window: int, most: int, emit: Callable[[list], None]):
        self.window, self.most, self.emit = window, most, emit
        self.open: list[list] = []  # [free, pieces]

    def _best(self, need: int) -> int:
        best, free = -1, self.window + 1
        for i, (gap, _) in enumerate(self.open):
            if need <= gap < free:
                best, free = i, gap
        return best

    def place(self, doc: int, start: int, length: int) -> None:
        while length:
            at = self._best(length)
            if at < 0 and len(self.open) < self.most:
                self.open.append([self.window, []])
                at = len(self.open) - 1
            if at >= 0:
                self._put(at, doc, start, length)
                return
            fullest = min(range(len(self.open)), key=lambda i: self.open[i][0])
            gap = self.open[fullest][0]
            if gap >= LEAST_CUT:
                self._put(fullest, doc, start, gap)
                start, length = start + gap, length - gap
            else:
                self.emit(self.open.pop(fullest)[1])

    def _put(self, at: int, doc: int, start: int, length: int) -> None:
        entry = self.open[at]
        entry[1].append((doc, start, length, self.window - entry[0]))
        entry[0] -= length
        if not entry[0]:
            self.emit(self.open.pop(at)[1])


def _first_round(
    batches: Iterable[pa.RecordBatch], tokenizer_json: str, window: int, most: int, end_id: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    store = worker_store("packing")
    mark = zlib.crc32(tokenizer_json.encode())
    if mark not in store:
        store.clear()
        store[mark] = ChunkEncoder(tokenizer_json)
    encode: Encoder = store[mark]
    part = TaskContext.get().partitionId()
    rows: list[tuple] = []
    number = 0
    facts: dict[int, tuple] = {}  # of a document's piece in an open window: id, doc_tokens and its ids

    def emit(pieces: list, closed: bool = True) -> None:
        nonlocal number
        sequence = (part << 32) | number
        number += 1
        for doc, start, length, offset in pieces:
            name, total, first, ids = facts[doc]
            crc = zlib.crc32(ids[start - first : start - first + length].tobytes())
            rows.append((name, start, length, crc, total, sequence, offset, closed, part))

    def taken() -> pa.RecordBatch:
        columns = list(zip(*rows))
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    windows = OpenWindows(window, most, emit)
    doc = 0
    for batch in text_slices(batches, 1, most=SLICE):
        names = batch.column(0).to_pylist()
        ids, counts = encode(byte_texts(batch, 1))
        at = 0
        for name, count in zip(names, counts.tolist()):
            own = np.append(ids[at : at + count], np.uint32(end_id)).astype("<u4")
            at += count
            total = len(own)
            full = total // window * window
            facts[doc] = (name, total, 0, own)
            for start in range(0, full, window):
                emit([(doc, start, window, 0)])
            if total > full:
                facts[doc] = (name, total, full, own[full:].copy())  # the rest may stay open for long
                windows.place(doc, full, total - full)
            doc += 1
        held = {d for _, pieces in windows.open for d, *_ in pieces}
        facts = {d: facts[d] for d in held}
        if rows:
            yield taken()
    for _, pieces in windows.open:
        emit(pieces, closed=False)
    if rows:
        yield taken()


def _merge_round(batches: Iterable[pa.RecordBatch], window: int, turn: int, last: bool, most: int) -> Iterator[pa.RecordBatch]:
    """Best fit of whole pieces, longest first; all but ``most`` of the windows are closed, in the last round all."""
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    table = pa.Table.from_batches(tables)
    order = sorted(
        zip(*(table.column(n).to_pylist() for n in ("length", "sequence_id", "offset")), range(table.num_rows)),
        key=lambda x: (-x[0], x[1], x[2]),
    )
    free: list[int] = []
    at_free: dict[int, list[int]] = {}
    gaps: list[int] = []  # sorted, each gap once
    placed: list[tuple[int, int, int]] = []
    from bisect import bisect_left, insort

    for length, _, _, row in order:
        i = bisect_left(gaps, length)
        if i < len(gaps):
            gap = gaps[i]
            w = at_free[gap].pop()
            if not at_free[gap]:
                del at_free[gap], gaps[i]
        else:
            gap, w = window, len(free)
            free.append(window)
        placed.append((row, w, window - gap))
        free[w] = gap - length
        if free[w]:
            if free[w] not in at_free:
                insort(gaps, free[w])
            at_free.setdefault(free[w], []).append(w)
    by_gap = sorted(range(len(free)), key=lambda w: (-free[w], w))
    still_open = set() if last else {w for w in by_gap[:most] if free[w]}
    part = TaskContext.get().partitionId()
    rows, numbers, offsets = zip(*placed)
    out = table.take(pa.array(rows))
    values = {
        "sequence_id": [(turn << 56) | (part << 32) | w for w in numbers],
        "offset": offsets,
        "closed": [w not in still_open for w in numbers],
        "part": [part] * len(numbers),
    }
    for name, value in values.items():
        i = out.schema.get_field_index(name)
        out = out.set_column(i, out.schema.field(i), pa.array(value, out.schema.field(i).type))
    yield from out.to_batches()


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    end_id: int = 1,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its text's ids and then ``end_id``, so a NULL or empty text is one token. Each id lies in
    exactly one piece; pieces of a sequence follow each other without gaps. Rows that repeat, also with
    the same key, are packed each for itself; a NULL key is kept as it is. Texts of any length are cut into full
    windows. Columns beside key and text are not read. An empty table gives no pieces.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = PIECE.format(kind=docs.schema[key].dataType.simpleString())
    slim = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    first = written(
        slim.mapInArrow(lambda b: _first_round(b, spec.value, window, open_windows, end_id, arrow), schema), "packing"
    )
    result = first.filter("closed")
    left = first.filter("NOT closed")
    parts = (first.agg(F.max("part")).first()[0] or 0) + 1
    turn = 1
    while True:
        parts = -(-parts // MERGE)
        last = parts == 1
        dealt = left.repartitionById(parts, F.col("part") % parts)
        merged = dealt.mapInArrow(lambda b, t=turn, e=last: _merge_round(b, window, t, e, open_windows), schema)
        if last:
            return result.unionByName(merged).drop("closed", "part")
        merged = written(merged, "packing")
        result, left = result.unionByName(merged.filter("closed")), merged.filter("NOT closed")
        turn += 1


def padding(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Sequences, tokens and padding; a sequence whose length is a power of two needs none."""
    by = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    pad = F.when(F.bit_count("n") == 1, 0).otherwise(window - F.col("n"))
    return by.agg(F.count(F.lit(1)).alias("sequences"), F.sum("n").alias("tokens"), F.sum(pad).alias("padding"))
