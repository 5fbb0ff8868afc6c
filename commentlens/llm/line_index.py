"""Line dedup by a sharded minimal perfect hash over distinct line hashes.

A line's key is hashed to 128 bits. The keys of a document count once; tasks add up their keys before the shuffle, so a line
that every document holds is one row per task. Keys found in ``KEPT_FROM`` documents and more are dealt to shards of about
``SHARD`` keys. A shard is three arrays: the bits of a minimal perfect hash, which gives each of its keys a slot
of its own, and per slot a fingerprint and a document count. A key that is not in the index meets some slot too, and the
fingerprint of 64 bits tells it apart; the other 64 bits choose shard and slot.

Documents probe the arrays; no line is joined. An index of at most ``BROADCAST`` bytes, as measured, is sent to the tasks that
read the documents. A larger one stays where it is: the documents' keys go to the shards, those of a much probed shard dealt
over several tasks, and only what a document has to drop comes back. The answers are the same.

The perfect hash: keys are thrown into twice as many places as there are keys; who is alone in its place keeps it,
the others try again in the next level. A slot is the number of taken places before one's own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentlens.llm.common import byte_texts, free_name, text_slices
from commentlens.session import written

SHARD = 65_536  # keys
KEPT_FROM = 2  # documents; a line of one document is never repeated
BROADCAST = 32_000_000  # bytes of arrays that may be sent to every task
PROBES = 200_000  # probes of a shard that one task looks at
HELD = 200_000  # different keys that a task adds up before it sends them on
_KEY = np.dtype([("place", "<u8"), ("mark", "<u8")])
_COUNTED = np.dtype([("place", "<u8"), ("mark", "<u8"), ("n", "<i8")])


def line_key(line: bytes) -> bytes:
    """Without ASCII white space at both ends, A-Z in lower case."""
    return line.strip(b" \t\n\r\x0b\x0c").lower()


def key_hashes(lines: list[bytes]) -> list[bytes]:
    """Sixteen bytes for each line; none (empty) for a line without a key."""
    digest = xxhash.xxh3_128_digest
    keys = [line_key(x) for x in lines]
    return [digest(k) if k else b"" for k in keys]


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """Another 64-bit number of each key for each level."""
    with np.errstate(over="ignore"):
        x = keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Slots 0 to n - 1 for n different 64-bit keys, from about three bits a key."""

    def __init__(self, words: np.ndarray, sizes: list[int]):
        self.words, self.sizes = words, sizes
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        parts, sizes, level = [], [], 0
        while len(keys):
            size = -(-2 * len(keys) // 64) * 64
            at = (_mixed(keys, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            parts.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            keys, level = keys[~alone[at]], level + 1
        return cls(np.concatenate([np.zeros(0, "<u8"), *parts]), sizes)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; of a key that is not in the set any slot, or -1."""
        found = np.full(len(keys), -1, np.int64)
        open_, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = (_mixed(keys[open_], level) % np.uint64(size)).astype(np.int64) + start
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            taken = (self.words[word] >> bit & np.uint64(1)).astype(bool)
            below = self.words[word[taken]] & ((np.uint64(1) << bit[taken]) - np.uint64(1))
            found[open_[taken]] = self.before[word[taken]] + np.bitwise_count(below)
            open_, start = open_[~taken], start + size
        return found


class Shard:
    """Document counts of the keys of a shard. ``twins``: keys whose 64 bits of place another key has as well."""

    def __init__(self, bits: bytes, sizes: list[int], marks: bytes, counts: bytes, twins: bytes):
        self.hash = PerfectHash(np.frombuffer(bits, "<u8"), list(sizes))
        self.marks, self.counted = np.frombuffer(marks, "<u8"), np.frombuffer(counts, "<i8")
        self.twins = np.frombuffer(twins, _COUNTED)

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """How many documents hold each key; 0 for keys that are not in the index."""
        found = np.zeros(len(keys), np.int64)
        slots = self.hash.slots(keys["place"])
        known = np.flatnonzero(slots >= 0)
        known = known[self.marks[slots[known]] == keys["mark"][known]]
        found[known] = self.counted[slots[known]]
        for twin in self.twins:
            found[(keys["place"] == twin["place"]) & (keys["mark"] == twin["mark"])] = twin["n"]
        return found


def _key_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counted: dict[bytes, int] = {}

    def taken() -> pa.RecordBatch:
        keys = np.frombuffer(b"".join(counted), _KEY)
        columns = [np.ascontiguousarray(keys[n]).view(np.int64) for n in ("place", "mark")]
        columns.append(np.fromiter(counted.values(), np.int64, len(counted)))
        counted.clear()
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["place", "mark", "n"])

    for batch in text_slices(batches, 0):
        for text in byte_texts(batch, 0):
            for key in set(key_hashes(text.split(b"\n"))):
                if key:
                    counted[key] = counted.get(key, 0) + 1
            if len(counted) > HELD:
                yield taken()
    if counted:
        yield taken()


def _shard_arrays(table: pa.Table) -> pa.Table:
    columns = [table.column(c).to_numpy() for c in ("place", "mark", "n")]
    rows = np.empty(table.num_rows, _COUNTED)
    for name, column in zip(_COUNTED.names, columns):
        rows[name] = column.view(_COUNTED[name])
    _, first = np.unique(rows["place"], return_index=True)
    twins = np.delete(rows, first)
    rows = rows[first]
    found = PerfectHash.of(rows["place"])
    slots = found.slots(rows["place"])
    marks, counts = np.zeros(len(rows), "<u8"), np.zeros(len(rows), "<i8")
    marks[slots], counts[slots] = rows["mark"], rows["n"]
    row = {"shard": table.column("shard")[:1], "bits": [found.words.tobytes()], "sizes": [found.sizes]}
    return pa.table({**row, "marks": [marks.tobytes()], "counts": [counts.tobytes()], "twins": [twins.tobytes()]})


def _shard_of(places: np.ndarray, shards: int) -> np.ndarray:
    """As ``pmod(place, shards)`` on the signed number."""
    return np.mod(places.view(np.int64), shards)


INDEX = "shard long, bits binary, sizes array<long>, marks binary, counts binary, twins binary"


def build_index(docs: DataFrame, text: str = "text", kept_from: int = KEPT_FROM, shard: int = SHARD) -> tuple[DataFrame, int]:
    """The shards' arrays, a row for each shard that has keys, and the number of shards.

    Keys of fewer than ``kept_from`` documents are not in it.
    """
    slim = docs.select(F.col(text).cast("string").alias("text"))
    counted = slim.mapInArrow(_key_counts, "place long, mark long, n long").groupBy("place", "mark").agg(F.sum("n").alias("n"))
    kept = written(counted.filter(F.col("n") >= kept_from), "lines")
    shards = max(1, -(-kept.count() // shard))
    dealt = kept.withColumn("shard", F.pmod("place", F.lit(shards)).cast("long"))
    return written(dealt.groupBy("shard").applyInArrow(_shard_arrays, INDEX), "lines"), shards


def _dropped(lines: list[bytes], gone: Iterable[bool]) -> tuple[int, int, bytes]:
    kept = [x for x, g in zip(lines, gone) if not g]
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


def _result(batch: pa.RecordBatch, rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    n_lines, n_dropped, kept = zip(*rows)
    columns = [batch.column(1), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["row", "n_lines", "n_dropped", "kept_text"])


def _probed(batches: Iterable[pa.RecordBatch], arrays: list[tuple], shards: int, least: int) -> Iterator[pa.RecordBatch]:
    known = {row[0]: Shard(*row[1:]) for row in arrays}
    for batch in text_slices(batches, 0):
        split = [t.split(b"\n") for t in byte_texts(batch, 0)]
        hashes = key_hashes([x for lines in split for x in lines])
        held = np.fromiter(map(len, hashes), np.int64, len(hashes)) > 0
        keys = np.frombuffer(b"".join(hashes), _KEY)
        counts, of = np.zeros(len(keys), np.int64), _shard_of(keys["place"], shards)
        for number in np.unique(of).tolist():
            if number in known:
                counts[of == number] = known[number].counts(keys[of == number])
        gone = np.zeros(len(hashes), bool)
        gone[held] = counts >= least
        ends = np.cumsum([0, *map(len, split)]).tolist()
        yield _result(batch, [_dropped(lines, gone[a:b].tolist()) for lines, a, b in zip(split, ends, ends[1:])])


def _probes(batches: Iterable[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Per text and shard the keys to look up, as packed hashes."""
    for batch in text_slices(batches, 0):
        at, numbers, packed = [], [], []
        for i, text in enumerate(byte_texts(batch, 0)):
            keys = np.unique(np.frombuffer(b"".join(set(key_hashes(text.split(b"\n")))), _KEY))
            of = _shard_of(keys["place"], shards)
            order = np.argsort(of, kind="stable")
            cuts = np.flatnonzero(np.diff(of[order])) + 1
            for part in np.split(order, cuts) if len(order) else []:
                at.append(i)
                numbers.append(int(of[part[0]]))
                packed.append(keys[part].tobytes())
        taken = [batch.column(c).take(pa.array(at, pa.int64())) for c in (1, 2)]
        yield pa.RecordBatch.from_arrays([*taken, pa.array(numbers, pa.int64()), pa.array(packed, pa.binary())], names=["a", "b", "shard", "keys"])


def _answered(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, its arrays first: per text the keys that are dropped."""
    number, shard = None, None
    for batch in batches:
        a, b, of, keys, *arrays = (batch.column(i) for i in range(9))
        out: tuple[list, list, list] = ([], [], [])
        for i, s in enumerate(of.to_pylist()):
            if arrays[0][i].is_valid:
                number, shard = s, Shard(*[x[i].as_py() for x in arrays])
            elif s == number:
                probes = np.frombuffer(keys[i].as_py(), _KEY)
                gone = probes[shard.counts(probes) >= least]
                if len(gone):
                    for values, value in zip(out, (a[i].as_py(), b[i].as_py(), gone.tobytes())):
                        values.append(value)
        kinds = (pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names=["a", "b", "gone"])


def _with_answers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, 0):
        rows = []
        for text, answer in zip(byte_texts(batch, 0), batch.column(2).to_pylist()):
            gone = {p[i : i + 16] for p in answer or [] for i in range(0, len(p), 16)}
            lines = text.split(b"\n")
            rows.append(_dropped(lines, [k in gone for k in key_hashes(lines)] if gone else [False] * len(lines)))
        yield _result(batch, rows)


def drop_repeated_lines(
    docs: DataFrame,
    text: str = "text",
    carry: list[str] | None = None,
    least: int = 10,
    shard: int = SHARD,
    broadcast: int = BROADCAST,
) -> DataFrame:
    """Each row's ``carry`` columns (all but the text if not given), ``n_lines``, ``n_dropped`` and ``kept_text``.

    Lines whose key ``least`` documents hold, a document counted once, go in every document; lines without a key (white space only)
    stay. A NULL or empty text is one empty line. Rows that repeat count each. Texts and lines may be of any length. Carried columns
    that have the name of a result column are left out. An empty table gives no rows.
    """
    if least < KEPT_FROM:
        raise ValueError(f"least must be {KEPT_FROM} or more")
    results = {"n_lines", "n_dropped", "kept_text"}
    carry = [c for c in (carry if carry is not None else [c for c in docs.columns if c != text]) if c.lower() not in results]
    index, shards = build_index(docs, text, shard=shard)
    size = index.agg(F.sum(F.octet_length("bits") + F.octet_length("marks") + F.octet_length("counts"))).first()[0] or 0
    body = F.col(text).cast("string")
    held = F.struct(*[F.col(_quoted(c)) for c in carry]) if carry else F.struct(F.lit(True).alias(free_name("row", results)))
    rows = docs.select(body.alias("text"), held.alias("row"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, n_lines long, n_dropped long, kept_text string"
    if size <= broadcast:
        arrays = [tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in index.collect()]
        sent = docs.sparkSession.sparkContext.broadcast(arrays)
        found = rows.mapInArrow(lambda b: _probed(b, sent.value, shards, least), schema)
    else:
        found = _routed(rows, index, shards, least, schema)
    return found.select(*[f"row.{_quoted(c)}" for c in carry], "n_lines", "n_dropped", "kept_text")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _routed(rows: DataFrame, index: DataFrame, shards: int, least: int, schema: str) -> DataFrame:
    """Keys go to the shards; a text (by its hash, so that exact copies ask once) gets back what it has to drop."""
    first, second = F.xxhash64("text"), F.xxhash64(F.lit(1), "text")
    texts = rows.select("text", first.alias("a"), second.alias("b"))
    probes = texts.mapInArrow(lambda b: _probes(b, shards), "a long, b long, shard long, keys binary")
    probes = written(probes.groupBy("a", "b", "shard").agg(F.first("keys").alias("keys")), "lines")
    crowded = probes.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / PROBES).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int").alias("block")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    asked = probes.join(crowded, "shard").select("a", "b", "shard", own, "keys")
    arrays = index.join(crowded, "shard").select("shard", every, "bits", "sizes", "marks", "counts", "twins")
    both = asked.unionByName(arrays, allowMissingColumns=True).repartition("shard", "block")
    both = both.sortWithinPartitions("shard", "block", F.col("bits").isNull())
    both = both.select("a", "b", "shard", "keys", "bits", "sizes", "marks", "counts", "twins")
    answers = both.mapInArrow(lambda b: _answered(b, least), "a long, b long, gone binary")
    answers = answers.groupBy("a", "b").agg(F.collect_list("gone").alias("gone"))
    told = rows.withColumns({"a": first, "b": second}).join(answers, ["a", "b"], "left").select("text", "row", "gone")
    return told.mapInArrow(_with_answers, schema)
