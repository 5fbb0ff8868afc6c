"""CSV whose quoted fields hold line breaks, read by many tasks a file.

Where a block of a file starts, inside a quoted field or outside, depends on all before it. A first pass
works out for each block, by itself, how it ends for either start; these answers, two per block, are put
one after the other. A second pass then cuts each block into records, and only records that lie on the edge
of a block are shuffled. Fields are parsed by Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What lies between the quotes of a field that is open; a doubled quote is part of the text.
INSIDE = re.compile(r'[^"]*(?:""[^"]*)*')
CHUNK = 2000  # records handed on at once


def ends_open(line: str, is_open: bool) -> bool:
    """Whether a quoted field is open behind ``line``, if one was (or was not) before it.

    A quote opens a field only as its first character; anywhere else it is a character like others.
    """
    if '"' not in line:
        return is_open
    place, length = 0, len(line)
    while True:
        if not is_open and line[place : place + 1] == '"':
            is_open, place = True, place + 1
        if is_open:
            place = INSIDE.match(line, place).end()
            if place == length:
                return True
            is_open, place = False, place + 1
        comma = line.find(",", place)
        if comma < 0:
            return False
        place = comma + 1


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    """Path, block and line, in the order of the file; a task reads its blocks one after the other."""
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in ("path", "block", "line")))


def _block_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: is a field open at its end if none was, or if one was, at its start; does a record end if one was."""
    found: dict[tuple[str, int], list[bool]] = {}
    for path, block, line in _rows(batches):
        state = found.setdefault((path, block), [False, True, False])
        state[0], state[1] = ends_open(line, state[0]), ends_open(line, state[1])
        state[2] = state[2] or not state[1]
    rows = [{"path": p, "block": b, "shut": s[0], "open": s[1], "ends": s[2]} for (p, b), s in found.items()]
    if rows:
        yield pa.RecordBatch.from_pylist(rows)


def block_starts(ends: list[tuple]) -> dict[tuple[str, int], int]:
    """Per block the block in which the record open at its start began, or -1 where none is open."""
    owners: dict[tuple[str, int], int] = {}
    before, owner = None, -1
    for path, block, shut, open_, has_end in sorted(ends):
        owner = owner if path == before else -1
        before = path
        owners[path, block] = owner
        if owner < 0:
            owner = block if shut else -1
        elif not open_:
            owner = -1
        elif has_end:  # the open record ended, and another began
            owner = block
    return owners


SCHEMA = pa.schema(
    [("path", pa.string()), ("block", pa.int64()), ("owner", pa.int64()), ("head", pa.bool_()), ("record", pa.string())]
)
PIECES = "path string, block bigint, owner bigint, head boolean, record string"


def _cutter(owners: dict[tuple[str, int], int]):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        held: list[str] = []
        current, owner, is_open, at_head = None, -1, False, False

        def piece(whole: bool) -> dict:
            """What is held: a whole record, or, with an owner, a part of one that spans blocks."""
            path, block = current
            part_of = owner if owner >= 0 else None if whole else block
            return {"path": path, "block": block, "owner": part_of, "head": at_head, "record": "\n".join(held)}

        for path, block, line in _rows(batches):
            if (path, block) != current:
                if held:
                    out.append(piece(False))
                    held.clear()
                if (path, block) not in owners:
                    raise RuntimeError(f"{path} is now cut into other blocks; read it again, or fix spark.sql.files.minPartitionNum")
                current, owner = (path, block), owners[path, block]
                is_open, at_head = owner >= 0, block == 0
            held.append(line)
            is_open = ends_open(line, is_open)
            if not is_open:
                if owner >= 0 or len(held) > 1 or line.rstrip("\r"):  # blank lines are no records
                    out.append(piece(True))
                    at_head = False
                held.clear()
                owner = -1
            if len(out) >= CHUNK:
                yield pa.RecordBatch.from_pylist(out, SCHEMA)
                out.clear()
        if held:
            out.append(piece(False))
        if out:
            yield pa.RecordBatch.from_pylist(out, SCHEMA)

    return cut


def records(spark: SparkSession, path: str) -> DataFrame:
    """``(path, head, record)``: the records of all files, with their line breaks; ``head`` is true for a file's first.

    Lines end with a line feed. Blank lines are no records; a quoted field that is never closed ends with its file.
    To the driver come three bits and a path per block of the files (128 MB by Spark's default). The files
    are read three times: for the blocks' ends, for whole records, and for the pieces of those that span blocks.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line")
    )
    ends = lines.mapInArrow(_block_ends, "path string, block bigint, shut boolean, open boolean, ends boolean")
    pieces = lines.mapInArrow(_cutter(block_starts([tuple(r) for r in ends.collect()])), PIECES)
    whole = pieces.filter(F.col("owner").isNull()).select("path", "head", "record")
    parts = F.array_sort(F.collect_list(F.struct("block", "record")))  # of one record, however many blocks it spans
    cut = pieces.filter(F.col("owner").isNotNull()).groupBy("path", "owner").agg(F.max("head").alias("head"), parts.alias("p"))
    return whole.unionByName(cut.select("path", "head", F.array_join("p.record", "\n").alias("record")))


def read_quoted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of CSV files with a header each; ``schema`` names and types their fields."""
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    text = F.regexp_replace("record", r"\r$", "")
    rows = records(spark, path).filter(~F.col("head")).select(F.from_csv(text, ddl, options).alias("row"))
    return rows.select("row.*")
