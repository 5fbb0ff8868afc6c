"""Chat formatting: schema fingerprints select declarative mappings to canonical turns.

A record's nested field paths, as far as any mapping knows them, are sorted and hashed. The hash is looked up in a
table made of the declared mappings, and the mapping found says where the turns lie: in a list of messages,
in prompt and answer fields, in an instruction with optional input, or one turn per row. A mapping is data, not
code; further layouts are added by declaring them. Typed tables are fingerprinted once, by their schema; JSON
records one by one, inside the JVM.

Turns become text by a template that marks each turn and its role. In texts and roles every place where a control string
could be read, such as ``</s>``, ``[INST]``, ``<|`` or ``|>``, gets a backslash after its first character, also
when backslashes stand there already; taking one away restores the text exactly. Formatting is per turn and so a map;
a conversation is the concatenation of its turns' segments, and reading back streams through them in order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentlens.llm.common import free_name

# Openers that a control string can start with, and what would make them one.
_OPENER = r"([<\[|])"
_REST = r"(?=\||/s>|s>|/?INST\]|>)"
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
TURN = re.compile(r"<\|((?:[^|]|\|(?!>))*)\|>\n((?:[^<]|<(?!/s>))*)</s>\n", re.S)
TRAINED = "assistant"


@dataclass(frozen=True)
class Turns:
    """A list of messages at ``path`` with the names of their role and text."""

    path: str
    role: str
    text: str


@dataclass(frozen=True)
class Fields:
    """Turns in fixed fields: (role, paths whose non-empty texts are joined by a blank line)."""

    turns: tuple[tuple[str, tuple[str, ...]], ...]


@dataclass(frozen=True)
class Row:
    """One turn per record; such turns are canonical already, so their roles stay as they stand."""

    order: str
    role: str
    text: str


Mapping = Turns | Fields | Row

MAPPINGS: tuple[Mapping, ...] = (
    Turns("messages", "role", "content"),
    Turns("conversations", "from", "value"),
    Turns("turns", "role", "text"),
    Row("turn", "role", "text"),
    Fields((("user", ("prompt",)), ("assistant", ("completion",)))),
    Fields((("user", ("prompt",)), ("assistant", ("response",)))),
    Fields((("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Fields((("user", ("question",)), ("assistant", ("answer",)))),
    Fields((("user", ("instruction",)), ("assistant", ("output",)))),
    Fields((("user", ("instruction", "input")), ("assistant", ("output",)))),
    Fields((("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
)


def paths_of(mapping: Mapping) -> tuple[str, ...]:
    if isinstance(mapping, Turns):
        return f"{mapping.path}[].{mapping.role}", f"{mapping.path}[].{mapping.text}"
    if isinstance(mapping, Row):
        return mapping.order, mapping.role, mapping.text
    return tuple(p for _, paths in mapping.turns for p in paths)


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def table_of(mappings: tuple[Mapping, ...]) -> dict[str, Mapping]:
    found: dict[str, Mapping] = {}
    for mapping in mappings:
        if found.setdefault(fingerprint(paths_of(mapping)), mapping) != mapping:
            raise ValueError(f"two mappings have the same paths: {paths_of(mapping)}")
    return found


def schema_paths(schema: T.DataType, prefix: str = "") -> list[str]:
    """The paths of all leaves; lists add ``[]``."""
    if isinstance(schema, T.StructType):
        return [p for f in schema for p in schema_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(schema, T.ArrayType):
        return schema_paths(schema.elementType, prefix + "[]")
    return [prefix]


def _turn(role: Column, text: Column, place: Column) -> Column:
    return F.struct(
        place.cast("long").alias("turn"),
        F.coalesce(role.cast("string"), F.lit("")).alias("role"),
        F.coalesce(text.cast("string"), F.lit("")).alias("text"),
    )


def _canonical(role: Column) -> Column:
    """Names that stand for another role are replaced; others are kept as they are written."""
    known = F.lower(F.trim(F.coalesce(role.cast("string"), F.lit(""))))
    names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, known), role.cast("string"))


def _mapped(mapping: Mapping, get) -> Column:
    """The record's turns as a list; ``get`` gives the column of a top-level path."""
    if isinstance(mapping, Turns):
        listed = F.coalesce(get(mapping.path), F.array().cast(f"array<struct<`{mapping.role}`:string,`{mapping.text}`:string>>"))
        return F.transform(listed, lambda m, i: _turn(_canonical(m[mapping.role]), m[mapping.text], i))
    if isinstance(mapping, Row):
        return F.array(_turn(get(mapping.role), get(mapping.text), get(mapping.order)))
    made = []
    for i, (role, paths) in enumerate(mapping.turns):
        parts = [F.when(get(p).cast("string") != "", get(p).cast("string")) for p in paths]
        made.append(_turn(F.lit(role), F.concat_ws("\n\n", *parts), F.lit(i)))
    # A system turn without text is no turn.
    return F.filter(F.array(*made), lambda t: (t["role"] != "system") | (t["text"] != ""))


def from_table(table: DataFrame, key: str, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """key, turn, role, text of a typed table; columns that no mapping knows are ignored.

    The fingerprint of the schema's known paths is looked up, as ``from_json`` does for each record. A table that holds
    the paths of several mappings together has none of their fingerprints: of those it holds whole, the mapping with
    the most paths is taken, the first declared of equals. None held whole: an error that names the paths.
    """
    known = table_of(mappings)
    have = set(schema_paths(table.schema))
    mapping = known.get(fingerprint(have & {p for m in mappings for p in paths_of(m)}))
    if mapping is None:
        held = [m for m in known.values() if set(paths_of(m)) <= have]
        if not held:
            raise ValueError(f"no mapping for the fields {sorted(have)}")
        mapping = max(held, key=lambda m: len(set(paths_of(m))))
    turns = _mapped(mapping, lambda path: F.col(f"`{path}`"))
    return table.select(F.col(key).alias("key"), F.inline(turns))


def _prefixed(names: Column, prefix: str) -> Column:
    return F.transform(names, lambda name: F.concat(F.lit(prefix), name))


def record_paths(record: Column, mappings: tuple[Mapping, ...] = MAPPINGS) -> Column:
    """The known paths that a JSON record holds, sorted: those of fields, and of fields of its listed messages."""
    top = F.coalesce(F.json_object_keys(record), F.array().cast("array<string>"))
    listed = sorted({m.path for m in mappings if isinstance(m, Turns)})
    inner = []
    for path in listed:
        first = F.get_json_object(record, f"$.{path}[0]")
        keys = F.coalesce(F.json_object_keys(first), F.array().cast("array<string>"))
        inner.append(_prefixed(keys, f"{path}[]."))
    all_paths = F.concat(top, *inner) if inner else top
    vocabulary = sorted({p for m in mappings for p in paths_of(m)})
    return F.array_sort(F.array_intersect(all_paths, F.array(*[F.lit(p) for p in vocabulary])))


def from_json(records: DataFrame, key: str, payload: str, mappings: tuple[Mapping, ...] = MAPPINGS) -> tuple[DataFrame, DataFrame]:
    """Turns of JSON records of any declared layouts, and the records that fit none (key, payload, paths).

    A record is of the layout whose fingerprint equals that of its known paths; fields no mapping knows do not
    count, and NULL or missing optional texts are empty. A list of messages without a first message, broken
    JSON and NULL payloads fit none.
    """
    known = table_of(mappings)
    paths, mark, own = (free_name(n, records.columns) for n in ("paths", "fingerprint", "key"))
    seen = records.withColumn(paths, record_paths(F.col(payload), mappings))
    seen = seen.withColumn(mark, F.sha2(F.concat_ws("\n", F.col(paths)), 256))
    out = []
    for name, mapping in known.items():
        if isinstance(mapping, Turns):
            shape = f"`{mapping.path}` array<struct<`{mapping.role}`:string,`{mapping.text}`:string>>"
        else:
            shape = ", ".join(f"`{p}` string" for p in dict.fromkeys(paths_of(mapping)))
        body = F.from_json(F.col(payload), T.StructType.fromDDL(shape))
        turns = _mapped(mapping, lambda path, body=body: body[path])
        out.append((name, turns))
    turns = F.when(F.lit(False), out[0][1])
    for name, listed in out:
        turns = turns.when(F.col(mark) == name, listed)
    fits = F.col(mark).isin(list(known))
    mapped = seen.filter(fits).select(F.col(key).alias("key"), F.inline(turns))
    return mapped, seen.filter(~fits).select(F.col(key).alias("key"), F.col(payload).alias("payload"), F.col(paths).alias("paths"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _OPENER + r"(\\*)" + _REST, r"$1\\$2")


def unescape(text: str) -> str:
    return re.sub(_OPENER + r"\\(\\*)" + _REST, r"\1\2", text)


def format_turns(turns: DataFrame) -> DataFrame:
    """key, turn, ``segment`` and the code points of it that are trained on: ``loss_start``, ``loss_length``.

    A conversation is its segments in the order of turn, role and text, one after the other. NULL roles and texts
    are empty. Nothing is shuffled.
    """
    head = F.concat(F.lit("<|"), escape(F.coalesce("role", F.lit(""))), F.lit("|>\n"))
    body = escape(F.coalesce("text", F.lit("")))
    trained = F.coalesce(F.col("role") == TRAINED, F.lit(False))
    return turns.select(
        "key",
        "turn",
        F.concat(head, body, F.lit("</s>\n")).alias("segment"),
        F.length(head).alias("loss_start"),
        F.when(trained, F.length(body)).otherwise(0).alias("loss_length"),
        trained.alias("trained"),
    )


def read_segment(segment: str) -> list[tuple[str, str]]:
    """The turns of a formatted text, as (role, text)."""
    found, at = [], 0
    while at < len(segment):
        turn = TURN.match(segment, at)
        if not turn:
            raise ValueError(f"not a formatted turn at {at}")
        found.append((unescape(turn[1]), unescape(turn[2])))
        at = turn.end()
    return found


class _Digest:
    """What is read back of one conversation."""

    def __init__(self) -> None:
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, start: int, length: int, trained: bool) -> None:
        self.chars += len(segment)
        for role, text in read_segment(segment):
            self.turns += 1
            for part in (role, "\n", text, "\n"):
                self.all.update(part.encode())
        if trained:
            text = unescape(segment[start : start + length])
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self, key) -> tuple:
        return key, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from its segments alone: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Segments are sorted by conversation and turn and read one at a time, so a conversation of any length
    needs no more memory than its longest turn. Turns with the same number follow each other by their segment;
    NULL numbers come last. A NULL key is a conversation of its own.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([formatted.schema["key"], *T.StructType.fromDDL(
        "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )])
    arrow = to_arrow_schema(schema)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, done = None, None, []

        def flushed() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*done), arrow)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        for batch in batches:
            for own, segment, start, length, trained in zip(*(c.to_pylist() for c in batch.columns)):
                if digest is None or own != key:
                    if digest is not None:
                        done.append(digest.row(key))
                    key, digest = own, _Digest()
                digest.add(segment, start, length, trained)
            if len(done) >= 10_000:
                yield flushed()
        if digest is not None:
            done.append(digest.row(key))
        if done:
            yield flushed()

    order = [F.col("key").asc_nulls_last(), F.col("turn").asc_nulls_last(), F.col("segment")]
    sorted_ = formatted.repartition("key").sortWithinPartitions(*order)
    return sorted_.select("key", "segment", "loss_start", "loss_length", "trained").mapInArrow(read, schema)
